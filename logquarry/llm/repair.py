"""Repair of conversations: the cheapest edits that give well-formed turns.

Turns are kept, given another role, deleted or inserted so that their initials read ``(s?(ua)+)?``.
What the rest of a conversation still costs is a vector over the four states between turns, found
backwards row by row. A conversation's rows lie in chunks: each chunk but the last starts from a
speculative vector, and fix-up passes run a chunk again from its neighbour's vector until old and
new vectors differ by a constant only, from where on they decide alike. With the true vectors of
each chunk the least audit is traced forwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from logquarry.llm.common import stage

SPACE = " \t\n\v\f\r"
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
# Rows in a chunk at most.
CHUNK_ROWS = 1 << 15
# After so many fix-up passes the chunks still open are settled through their cost matrices.
FIXUPS = 4
# A row's code: the kind of its role (s, u, a, other), plus 4 if truncated; the others are deleted.
BLANK, DUPLICATE, DROPPED = 8, 9, 10
# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
_INITIALS = "sua"
_ROLES = {USER: b"user", ASSISTANT: b"assistant"}
_FOLLOWS = (USER, USER, ASSISTANT, USER)
_NEVER = 1 << 20
SPECULATIVE = (0, 0, 0, 0)
LAST = (0, 2 * INSERT, INSERT, 0)


# --- costs -----------------------------------------------------------------------------
class Costs:
    """Steps of the cost vectors, each worked out once: there are few vectors but for a constant."""

    def __init__(self):
        self._steps: dict[tuple, tuple] = {}

    def step(self, after: tuple, code: int) -> tuple[tuple, int, tuple]:
        """The vector before a row of ``code``, taken down to a least entry of 0, what was taken
        off, and for each state the row's edits (ASCII-least of the cheapest), next state and cost."""
        found = self._steps.get((after, code))
        if found is None:
            found = self._steps[after, code] = self._made(after, code)
        return found

    @staticmethod
    def _moves(after: tuple, code: int, state: int) -> list[tuple[int, str, int, int]]:
        """``(total, edit, next state, cost)`` of each edit of the row itself, edits in ASCII order."""
        kind, extra = code % 4, TRUNCATED if code >= 4 else 0
        moves = [(DELETE + after[state], "D", state, DELETE)]
        keeps_to = {0: SYSTEM if state == START else None, 1: USER if state != USER else None,
                    2: ASSISTANT if state == USER else None, 3: None}[kind]
        if keeps_to is not None:
            moves.append((extra + after[keeps_to], "K", keeps_to, extra))
        to = _FOLLOWS[state]
        moves.append((REROLE + extra + after[to], "R", to, REROLE + extra))
        return moves

    def _made(self, after: tuple, code: int) -> tuple:
        moves = [self._moves(after, code, q) for q in range(4)]
        best = [min(m)[0] for m in moves]
        for _ in range(2):
            best = [min(b, INSERT + best[_FOLLOWS[q]]) for q, b in enumerate(best)]
        decided = []
        for state in range(4):
            edits, at, cost = "", state, 0
            while (first := next((m for m in moves[at] if m[0] == best[at]), None)) is None or (
                first[1] != "D" and INSERT + best[_FOLLOWS[at]] == best[at]
            ):
                edits, at, cost = edits + "I", _FOLLOWS[at], cost + INSERT
            _, edit, to, more = first
            decided.append((edits + edit, to, cost + more))
        least = min(best)
        return tuple(min(b - least, _NEVER) for b in best), least, tuple(decided)

    def back(self, codes: list[int], after: tuple) -> tuple:
        """The vector before a chunk from the one after it."""
        for code in reversed(codes):
            if code < BLANK:
                after = self.step(after, code)[0]
        return after

    def again(self, codes: list[int], old: tuple, old_before: tuple, new: tuple) -> tuple:
        """As :meth:`back` from ``new``, up to where it differs from the run from ``old`` by a constant."""
        for code in reversed(codes):
            if old == new:
                return old_before
            if code < BLANK:
                old, new = self.step(old, code)[0], self.step(new, code)[0]
        return new

    def matrix(self, codes: list[int]) -> list[int]:
        """The cost of going through the chunk from each state (rows) to each (columns)."""
        columns = []
        for to in range(4):
            vector, total = tuple(0 if q == to else _NEVER for q in range(4)), 0
            for code in reversed(codes):
                if code < BLANK:
                    vector, off, _ = self.step(vector, code)
                    total += off
            columns.append([min(v + total, _NEVER) if v < _NEVER else _NEVER for v in vector])
        return [columns[to][q] for q in range(4) for to in range(4)]

    def traced(self, codes: list[int], after: tuple) -> list[tuple]:
        """For each row that has a choice, in order, its decisions by state."""
        out = []
        for code in reversed(codes):
            if code < BLANK:
                after, _, decided = self.step(after, code)
                out.append(decided)
        out.reverse()
        return out


# --- rows ------------------------------------------------------------------------------
def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, n, dropped`` of the damaged turns, equal ones as one row ``n`` times."""
    blank_if_null = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(blank_if_null("conv_id"), F.lit(":"), blank_if_null("turn")).cast("binary")) % 20
    rows = turns.select(
        "conv_id", "turn", blank_if_null("role").alias("role"), blank_if_null("text").alias("text"), fate.alias("fate")
    )
    gone = F.col("fate") == 0
    text = (
        F.when(gone | (F.col("fate") == 1), "")
        .when(F.col("fate") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    return (
        rows.select(
            "conv_id",
            F.when(~gone, F.col("turn")).alias("turn"),
            F.when(gone, "").when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
            text.alias("text"),
            gone.alias("dropped"),
            F.when(F.col("fate") == 3, 2).otherwise(1).cast("long").alias("times"),
        )
        .groupBy("conv_id", "turn", "role", "text", "dropped")
        .agg(F.sum("times").alias("n"))
    )


def _code() -> Column:
    """The code of a row, duplicates not told yet."""
    solid = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    cut_off = F.when(F.right(solid, F.lit(1)).isin(".", "!", "?"), 0).otherwise(4)
    return F.when(F.col("dropped"), DROPPED).when(solid == "", BLANK).otherwise(kind + cut_off).cast("int")


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` in the order of conversations and turns, with ``code`` and a rising ``place``.

    Range partitions cut also a conversation that holds a large share of all rows.
    """
    keys = ["conv_id", F.col("turn").asc_nulls_first(), "role"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(
        rows.repartitionByRange(parts, *keys, F.left("text", F.lit(100)))
        .sortWithinPartitions(*keys, "text")
        .select("conv_id", "turn", "role", "text", "n", _code().alias("code"), F.sha2("text", 256).alias("sign"),
                F.monotonically_increasing_id().alias("place")),
        "turns",
    )


def coded(turns: DataFrame) -> DataFrame:
    """``conv_id, place, code`` of :func:`placed` rows, where all but the first of equal ones are duplicates."""
    solid = turns.filter(F.col("code") < BLANK)
    first = (
        solid.groupBy("conv_id", "role", "sign")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("sign").alias("s"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("sign") == F.col("s"))
    later = (F.col("code") < BLANK) & (F.col("place") > F.col("first"))
    return turns.select("conv_id", "place", "role", "sign", "code").join(first, same, "left").select(
        "conv_id", "place", F.when(later, DUPLICATE).otherwise(F.col("code")).alias("code")
    )


# --- chunks ----------------------------------------------------------------------------
_VECTOR = "array<int>"


def _mapped(rows: DataFrame, fn, name: str, *taken: str) -> DataFrame:
    """``conv_id, k`` and, as ``name``, what ``fn`` makes of the ``taken`` columns of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]):
        costs = Costs()
        for batch in batches:
            chunks = zip(*(batch.column(c).to_pylist() for c in taken), strict=True)
            made = pa.array([fn(costs, *chunk) for chunk in chunks], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("k"), made], ["conv_id", "k", name])

    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.select("conv_id", "k", *taken).mapInArrow(run, f"conv_id {kind}, k int, {name} {_VECTOR}")


def _scan(rows: DataFrame, fn, start: tuple, backwards: bool, name: str) -> DataFrame:
    """What reaches each chunk when ``fn(value, matrix)`` carries ``start`` through the conversation.

    Rows are one per chunk; a task streams them and holds one value.
    """

    def run(batches):
        own, value = (None,), start
        for batch in batches:
            out = []
            for conv, matrix in zip(batch.column("conv_id").to_pylist(), batch.column("matrix").to_pylist(), strict=True):
                if own != (conv,):
                    own, value = (conv,), start
                out.append(value)
                value = fn(value, matrix)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("k"), pa.array([list(v) for v in out], pa.list_(pa.int32()))],
                ["conv_id", "k", name],
            )

    kind = rows.schema["conv_id"].dataType.simpleString()
    order = F.col("k").desc() if backwards else F.col("k").asc()
    return (
        rows.select("conv_id", "k", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", order)
        .mapInArrow(run, f"conv_id {kind}, k int, {name} {_VECTOR}")
    )


def _through(after: tuple, matrix: list[int]) -> tuple:
    sums = [min(after[to] + matrix[4 * q + to] for to in range(4)) for q in range(4)]
    least = min(sums)
    return tuple(min(s - least, _NEVER) for s in sums)


def _same_chunk(a: str, b: str, step: int = 0) -> Column:
    return F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id")) & (F.col(f"{a}.k") + step == F.col(f"{b}.k"))


def vectors(linked: DataFrame, fixups: int = FIXUPS) -> DataFrame:
    """``conv_id, k, codes, after``: the true cost vector after each chunk, but for a constant.

    ``linked`` has ``conv_id, k, codes, ends`` of the chunks of conversations that have several.
    """
    last = F.array(*[F.lit(x) for x in LAST])
    guess = F.when(F.col("ends"), last).otherwise(F.array(*[F.lit(x) for x in SPECULATIVE]))
    tried = linked.withColumn("after", guess)
    run = _mapped(tried, lambda costs, codes, after: costs.back(codes, tuple(after)), "before", "codes", "after")
    held = stage(tried.alias("a").join(run.alias("b"), _same_chunk("a", "b")).select("a.*", "b.before"), "tried")
    for _ in range(fixups):
        given = held.alias("a").join(held.select("conv_id", "k", "before").alias("b"), _same_chunk("a", "b", 1), "left").select(
            "a.*", F.coalesce("b.before", last).alias("given")
        )
        changed = stage(given.filter("after <> given"), "to-fix")
        if changed.isEmpty():
            return held.select("conv_id", "k", "codes", "after")
        fixed = _mapped(
            changed,
            lambda costs, codes, after, before, given: costs.again(codes, tuple(after), tuple(before), tuple(given)),
            "fixed", "codes", "after", "before", "given",
        )
        new = changed.alias("a").join(fixed.alias("b"), _same_chunk("a", "b")).select("a.conv_id", "a.k", "a.given", "b.fixed")
        held = stage(
            held.alias("a").join(new.alias("b"), _same_chunk("a", "b"), "left").select(
                "a.conv_id", "a.k", "a.codes", "a.ends",
                F.coalesce("b.given", "a.after").alias("after"), F.coalesce("b.fixed", "a.before").alias("before"),
            ),
            "fixed",
        )
    matrices = _mapped(linked, lambda costs, codes: costs.matrix(codes), "matrix", "codes")
    settled = _scan(matrices, _through, LAST, True, "after")
    return linked.alias("a").join(settled.alias("b"), _same_chunk("a", "b")).select("a.conv_id", "a.k", "a.codes", "b.after")


def _leaves(costs: Costs, codes: list[int], after: list[int]) -> list[int]:
    """The state in which a chunk is left, for each in which it is entered."""
    out = []
    rows = costs.traced(codes, tuple(after))
    for state in range(4):
        for decided in rows:
            state = decided[state][1]
        out.append(state)
    return out


def _chunks(turns: DataFrame, chunk_rows: int, fixups: int) -> DataFrame:
    """``conv_id, chunk, codes, after, enters`` of every chunk of :func:`coded` rows."""
    chunks = stage(
        turns.groupBy("conv_id", F.expr(f"place div {chunk_rows}").alias("chunk"))
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "code"))), lambda x: x["code"]).alias("codes")),
        "chunks",
    )
    several = chunks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("chunks")).filter("chunks > 1")
    several = stage(several, "several")
    own = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))
    default = {"after": F.array(*[F.lit(x) for x in LAST]), "enters": F.lit(START)}
    singles = chunks.alias("a").join(several.alias("b"), own, "left_anti").withColumns(default)
    if several.isEmpty():
        return chunks.withColumns(default)
    numbered = Window.partitionBy("conv_id").orderBy("chunk")
    linked = stage(
        chunks.alias("a").join(several.alias("b"), own).select("a.*", "b.chunks")
        .withColumn("k", F.row_number().over(numbered)).withColumn("ends", F.col("k") == F.col("chunks")),
        "linked",
    )
    true = stage(vectors(linked.select("conv_id", "k", "codes", "ends"), fixups), "vectors")
    states = _mapped(true, _leaves, "matrix", "codes", "after")
    entered = _scan(states, lambda state, leaves: (leaves[state[0]],), (START,), False, "enters")
    joined = (
        linked.select("conv_id", "k", "chunk", "codes").alias("a")
        .join(true.alias("b"), _same_chunk("a", "b")).select("a.*", "b.after").alias("a")
        .join(entered.alias("b"), _same_chunk("a", "b"))
        .select("a.conv_id", "a.chunk", "a.codes", "a.after", F.col("b.enters")[0].alias("enters"))
    )
    return singles.unionByName(joined)


# --- repaired conversations ------------------------------------------------------------
class _Repaired:
    """One conversation as its rows pass by; texts go into the digest and are not kept."""

    LEGAL = {b"su", b"ua", b"au"}

    def __init__(self):
        self.least = self.most = self.turn = self.initial = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.digest, self.begun = hashlib.sha256(), False
        self.state = START

    def _write(self, role: bytes, text: bytes) -> None:
        if self.begun:
            self.digest.update(b"\n")
        self.begun = True
        self.digest.update(role + b":")
        self.digest.update(text)

    def _insert(self) -> None:
        self.state = _FOLLOWS[self.state]
        self._write(_ROLES[self.state], b"")

    def row(self, turn, role: bytes, text: bytes, n: int, code: int, decided) -> None:
        initial = role.decode("utf-8", "replace")[:1].encode()
        if self.initial is not None and self.initial + initial not in self.LEGAL:
            self.illegal += 1
        self.illegal += n - 1
        self.initial = initial
        if turn is not None:
            self.turns += self.turn != turn
            self.least = turn if self.least is None else self.least
            self.turn = self.most = turn
        if code == BLANK:
            self.blank += n
        else:
            self.duplicate += n - (code != DUPLICATE)
            self.truncated += 4 <= code < BLANK
        copies = n
        if decided is not None:
            edits, to, cost = decided[self.state]
            self.audit.append(edits)
            self.cost += cost
            for _ in edits[:-1]:
                self._insert()
            if edits[-1] != "D":
                self.state = to
                self._write(role if edits[-1] == "K" else _ROLES[to], text)
            copies -= 1
        self.audit.append("D" * copies)
        self.cost += DELETE * copies

    def result(self) -> tuple:
        while self.state in (SYSTEM, USER):
            self._insert()
            self.audit.append("I")
            self.cost += INSERT
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit),
                self.digest.hexdigest())


_RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _repair_rows(kind: pa.DataType):
    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) if done else [[] for _ in range(9)]
        kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["conv_id", *_RESULT]
        )

    def run(batches):
        costs, own, at, decided, codes_here = Costs(), None, None, iter(()), iter(())
        for batch in batches:
            done = []
            for conv, turn, role, text, n, codes, after, enters in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if own != (conv,):
                    if own is not None:
                        done.append((own[0], *at.result()))
                    own, at = (conv,), _Repaired()
                if codes is not None:
                    decided, codes_here = iter(costs.traced(codes, tuple(after))), iter(codes)
                    at.state = enters
                elif (code := next(codes_here)) != DROPPED:
                    at.row(turn, role, text, n, code, next(decided) if code < BLANK else None)
            yield batch_of(done)
        if own is not None:
            yield batch_of([(own[0], *at.result())])

    return run


def repair(turns: DataFrame, chunk_rows: int = CHUNK_ROWS, fixups: int = FIXUPS) -> DataFrame:
    """The cheapest repair of each damaged conversation of ``conv_id, turn, role, text``.

    Damage, faults, edits and their costs are those of the contract in the README. Returns
    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``, one row per
    ``conv_id``, a null one included. Null roles and texts count as one space, null turns come first.
    Turns of equal number go by role, then text; rows that repeat a turn whole are duplicates of it.
    Only ``user``, ``assistant`` and other roles' first letters count. A conversation without rows
    after the damage has zeros and the digest of the empty text; an empty table gives no rows;
    further columns are ignored. A conversation's texts pass through one task, as a digest needs
    them in order, but are not held there.
    """
    parts = placed(damaged(turns.select("conv_id", "turn", "role", "text")))
    heads = _chunks(coded(parts), chunk_rows, fixups).withColumn("place", F.lit(-1).cast("long"))
    rows = parts.drop("code", "sign").withColumn("chunk", F.expr(f"place div {chunk_rows}"))
    both = rows.unionByName(heads, allowMissingColumns=True)
    in_order = both.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "place")
    field = turns.schema["conv_id"].dataType.simpleString()
    return in_order.select(
        "conv_id", F.col("turn").cast("long"), F.col("role").cast("binary"), F.col("text").cast("binary"),
        "n", "codes", "after", "enters",
    ).mapInArrow(
        _repair_rows(to_arrow_type(turns.schema["conv_id"].dataType)),
        f"conv_id {field}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
        " audit string, repaired_sha256 string",
    )
