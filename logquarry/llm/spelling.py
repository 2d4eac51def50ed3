"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

A word is cut into two disjoint chunks; one edit leaves one of them whole. The other word of a pair
gives its grams of the chunks' lengths with their positions. What follows an edit is shifted by the
difference of the lengths, zero or one, so that of the positional grams within shift one those at
the two ends, for the word's own length and for one less, are all that can meet a chunk. What lies
beside chunk and gram is then verified. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import stage, text_of

LEAST_LENGTH = 5
LEAST_COUNT = 3
SLIP_EVERY = 97
RATIO = 2
RUN = "([A-Za-zÀ-ÿ]{%d,})"
# Grams met by more words than this are told apart by a chunk of what lies beside them as well.
LARGE_GRAM = 512
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# --- words -----------------------------------------------------------------------------
def _folded(run: Column) -> Column:
    """A-Z in lower case and no other letter."""
    ascii_only = F.octet_length(run) == F.char_length(run)
    return F.when(ascii_only, F.lower(run)).otherwise(F.translate(run, _UPPER, _UPPER.lower()))


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: words of ``least_length`` code points and ``least_count`` occurrences at least.

    Of a run whose check sum with the id is a multiple of ``SLIP_EVERY`` one code point is left out.
    Shorter runs cannot give such words and are not taken up.
    """
    run = F.explode(F.regexp_extract_all(text_of(), F.lit(RUN % least_length), F.lit(1)))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    rows = rows.select("id", _folded(F.col("run")).alias("run"))
    rows = rows.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.char_length("run")).cast("int")
    slipped = F.concat(F.left("run", at), F.substr("run", at + 2))
    word = F.when(F.col("h") % SLIP_EVERY == 0, slipped).otherwise(F.col("run"))
    return (
        rows.select(word.alias("word"))
        .filter(F.char_length("word") >= least_length)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= least_count)
    )


# --- pairs -----------------------------------------------------------------------------
def _cut(word: Column, at: Column, from_left: bool) -> tuple[Column, Column]:
    """A word's first ``at`` code points and the others, the part named first in front."""
    left, right = F.left(word, at), F.substr(word, at + 1)
    return (left, right) if from_left else (right, left)


def _sides(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The chunks of each word and the grams of each word, with what lies beside them.

    ``len`` is the length of the word that gives the chunk, ``part`` tells if it is the first one.
    """
    word, size = F.col("word"), F.char_length("word").cast("int")
    half = F.floor(size / 2).cast("int")

    def entry(length: Column, part: int, own: Column, beside: Column) -> Column:
        return F.struct(length.alias("len"), F.lit(part).alias("part"), own.alias("gram"), beside.alias("beside"))

    chunks = [entry(size, part, *_cut(word, half, part == 0)) for part in (0, 1)]
    grams = []
    for shorter in (0, 1):
        length = (size - shorter).cast("int")
        first = F.floor(length / 2).cast("int")
        for part in (0, 1):
            grams.append(entry(length, part, *_cut(word, first if part == 0 else first + shorter, part == 0)))
    spread = lambda entries: words.select("word", "n", F.inline(F.array(*entries)))
    return spread(chunks), spread(grams)


def _deeper(rows: DataFrame) -> DataFrame:
    """Entries cut once more: one of two chunks of what lies beside is whole too."""
    first = F.floor(F.col("len") / 2).cast("int")
    size = F.when(F.col("part") == 0, F.col("len") - first).otherwise(first)
    at = F.floor(size / 2).cast("int")
    longer = F.char_length("beside").cast("int") - size
    both = F.array(
        *[
            F.struct(F.lit(sub).alias("sub"), *[c.alias(n) for c, n in zip(_cut(F.col("beside"), at if sub == 0 else at + longer, sub == 0), ("inner", "outer"), strict=True)])
            for sub in (0, 1)
        ]
    )
    return rows.select("*", F.inline(both))


def _begins_alike(a: str, b: str) -> Column:
    """Whether the shorter of two columns begins the other: then the first chunk is whole as well."""
    return F.col(b).startswith(F.col(a))


def pairs(words: DataFrame, large_gram: int = LARGE_GRAM) -> DataFrame:
    """``a, n_a, b, n_b``: every two of the distinct ``word, n`` that are one edit apart, once."""
    chunks, grams = _sides(words)
    a = chunks.withColumnsRenamed({"word": "a", "n": "n_a", "beside": "beside_a"})
    b = grams.withColumnsRenamed({"word": "b", "n": "n_b", "beside": "beside_b"})
    key = ["len", "part", "gram"]
    met = grams.groupBy(*key).count().filter(F.col("count") > large_gram).select(*key)
    large = stage(met, "large-grams")
    # A pair of one length is met from both sides, and one whose chunks are both met, by either.
    once = ((F.char_length("b") > F.col("len")) | (F.col("a") < F.col("b"))) & (
        (F.col("part") == 0) | ~_begins_alike("beside_a", "beside_b")
    )
    columns = ["a", "n_a", "b", "n_b"]
    any_large = not large.isEmpty()
    rest = a.join(large, key, "left_anti") if any_large else a
    near = F.levenshtein("beside_a", "beside_b", 1) == 1
    found = rest.join(b, key).filter(once & near).select(*columns)
    if any_large:
        deep_a = _deeper(a.withColumnRenamed("beside_a", "beside").join(large, key, "left_semi")).withColumnsRenamed(
            {"beside": "beside_a", "outer": "outer_a"}
        )
        deep_b = _deeper(b.withColumnRenamed("beside_b", "beside").join(large, key, "left_semi")).withColumnsRenamed(
            {"beside": "beside_b", "outer": "outer_b"}
        )
        near = F.levenshtein("outer_a", "outer_b", 1) == 1
        inner_once = (F.col("sub") == 0) | ~_begins_alike("outer_a", "outer_b")
        more = deep_a.join(deep_b, [*key, "sub", "inner"]).filter(once & inner_once & near)
        found = found.unionByName(more.select(*columns))
    return found


# --- groups ----------------------------------------------------------------------------
def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words with a form, by doubling: a form has twice its word's count at
    least, so that few passes are needed."""
    links = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(
            links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "roots",
        )
        links = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return links


def variants(docs: DataFrame, ratio: int = RATIO, large_gram: int = LARGE_GRAM) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts of ``doc_id, text``.

    Words are the runs of letters of :func:`vocabulary`. Two are near if one inserted, deleted or
    replaced code point makes them equal. ``form`` is the near word of largest count (ties: the first
    in code-point order) if that is ``ratio`` times the word's or more; ``root`` follows forms to the
    last. Null texts have no words; a null id counts as empty in the check sum; repeated rows count
    each. An empty table gives no rows; further columns are ignored.
    """
    words = stage(vocabulary(docs), "vocabulary")
    found = stage(pairs(words, large_gram), "spelling-pairs")
    both = F.inline(
        F.array(
            F.struct(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form")).alias("near")),
            F.struct(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("less"), F.col("a").alias("form")).alias("near")),
        )
    )
    best = found.select(both).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("near"))
    larger = -F.col("near.less") >= ratio * F.col("n")
    formed = stage(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(larger, F.col("near.form")).alias("form"), F.when(larger, -F.col("near.less")).alias("form_n"),
        ),
        "formed",
    )
    roots = _roots(formed.filter("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
