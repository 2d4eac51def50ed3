"""Odd rows, brute-force versions and laws of the operators for training data."""

import random
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logquarry.llm import (
    chat,
    exact_dedup,
    langid,
    mixing,
    packing,
    queries,
    sharding,
    simhash,
    substring,
    topk,
    toxicity,
)

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, shard int,"
    " slot int, size int, bucket int, keep_id long, fp long, target double, key string"
)
LONG = " ".join(f"word{i % 5000} tail" for i in range(60_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, clashing columns."""
    rows = [
        (1, "the same text here"), (2, "the same text here"), (2, "the same text here"), (3, None), (4, ""),
        (None, "text without id"), (None, None), (5, LONG), (6, "  \t\n "), (7, "12 34 !!"), (8, "Ünï cödé ἀβ 日本"),
    ]
    full = [
        (i, t, "en" if i and i % 2 else None, "a" if i and i % 3 else None, None, 1.0, 1, 1, 1, 1, 1, 1, 1.0, "k")
        for i, t in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def run_all(spark, docs):
    labels = docs.select("doc_id", F.lit(None).cast("int").alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    half = F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False))
    sized = docs.withColumn("size", F.length("text"))
    return {
        "dedup": exact_dedup.exact_dedup(docs.filter(half), docs.filter(~half)),
        "mix": mixing.mix(docs),
        "langid": langid.identify(docs, langid.fit(langid.training_rows(docs)), docs.columns),
        "shards": sharding.shuffled_shards(sized, bucket_bytes=1 << 12),
        "toxicity": toxicity.score(docs, toxicity.fit(docs, labels)),
        "substring": substring.remove_repeats(docs),
        "packing": packing.pack(docs, queries.tokenizer_path()),
        "simhash": simhash.near_duplicates(docs),
    }


def test_odd_rows(spark, odd):
    found = {k: v.collect() for k, v in run_all(spark, odd).items()}
    for name, rows in found.items():
        assert len(rows) == 11 or name == "packing", name
    kept = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in found["dedup"]}
    assert (1, 2, 3, False) in kept and (2, 2, 3, True) in kept and (4, 4, 3, True) in kept and (3, 4, 3, False) in kept
    assert {r.lang_pred for r in found["langid"] if r.doc_id in (3, 4, 6, 7)} == {"und"}
    assert all(r.size == 0 and r.taken == 0 for r in found["mix"] if r.doc_id in (3, 4, 6))
    gone = {r.doc_id: (r.n_words, r.n_removed) for r in found["substring"]}
    assert gone[5][0] == 120_000 and gone[5][1] == 120_000 and gone[3] == (0, 0)
    prints = {r.doc_id: (r.fp, r.component_id) for r in found["simhash"] if r.doc_id}
    assert prints[3] == prints[4] == prints[6] == (0, 3) and prints[2][1] == 1
    assert sum(r.length for r in found["packing"] if r.doc_id == 3) == 1


def test_empty_tables(spark, odd):
    for name, df in run_all(spark, odd.limit(0)).items():
        assert df.count() == 0, name


def test_chat_and_search_on_odd_rows(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "bot", "b"),
         (4, None, None, None), (None, 0, "user", None), (5, 0, "user", "x"), (5, 0, "user", "x")],
        "conv_id long, turn long, role string, text string",
    ).withColumn("n_turns", F.lit(9))
    found = {r.conv_id: (r.n_turns, r.snapshots) for r in chat.format_chats(turns).collect()}
    assert found == {1: (2, 2), 4: (1, 1), None: (1, 1), 5: (2, 1)}
    assert chat.format_chats(turns.limit(0)).count() == 0
    vectors = spark.createDataFrame(
        [(20, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]),
         (6, [0.1]), (None, [1.0, 1.0]), (7, [])],
        "vec_id long, embedding array<float>",
    )
    v = topk.quantised(vectors)
    rows = topk.search(v, v.filter("vec_id % 20 = 0")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in rows] == [(1, 64 * 64 + 32 * 32), (2, 64 * 64 + 32 * 32), (6, 64 * 6), (7, 0)]
    assert topk.search(v, v.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        duck.execute(f"create view {file.stem} as select * from '{file}'")
    result = duck.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    ours = queries.QUERIES[name](spark, sf_dir)
    assert sorted(ours.columns) == sorted(columns)
    assert Counter(map(tuple, ours.select(*columns).collect())) == Counter(result.fetchall())


def test_search_over_several_shards(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(0, 0.3, (400, 16))
    v = topk.quantised(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "vec_id long, embedding array<double>"))
    found = topk.search(v, v.filter("vec_id % 20 = 0"), k=7, shard_vectors=90, query_block=6).collect()
    q = np.floor(m * 64).astype(int)
    for own in range(0, 400, 20):
        scores = sorted((-int(q[own] @ q[j]), j) for j in range(400) if j != own)[:7]
        mine = sorted((r.rank, -r.score, r.vec_id) for r in found if r.query_id == own)
        assert [x[1:] for x in mine] == scores


def test_filter_holds_every_key():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 10, 1000, 60_000):
        keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        made = exact_dedup.build_filter(keys)
        assert exact_dedup.accepts(keys, *made).all()
        if n >= 1000:
            assert exact_dedup.accepts(rng.integers(0, 1 << 63, 10_000, dtype=np.uint64), *made).mean() < 0.02


def test_a_hot_key_has_more_buckets(spark):
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit(36).alias("size"), F.col("id").alias("n")
    )
    sharded = rows.withColumn("shard", sharding.shard_of(F.col("doc_id"), 10))
    hot = sharded.filter("doc_id is null").first()["shard"]
    counts = sharding.bucket_counts(sharded.withColumn("weight", F.col("size") + sharding.ROW_BYTES), 10, 1_000)
    assert counts[hot] >= 30 and max(c for i, c in enumerate(counts) if i != hot) < 15
    found = sharding.shuffled_shards(rows, shards=10, bucket_bytes=1_000).collect()
    assert sorted(r.n for r in found) == list(range(900))
    for s in range(10):
        mine = sorted(r.slot for r in found if r.shard == s)
        assert mine == list(range(len(mine)))


def test_shards_obey_their_law(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(100).alias("size"))
    found = sharding.shuffled_shards(rows, shards=10, bucket_bytes=5_000).withColumn(
        "grown", sharding.shard_of(F.col("doc_id"), 11)
    ).collect()
    assert len(found) == 3000
    for s in range(10):
        mine = sorted(r.slot for r in found if r.shard == s)
        assert mine == list(range(len(mine))) and 200 < len(mine) < 400
        in_order = [r.doc_id for r in sorted((r for r in found if r.shard == s), key=lambda r: r.slot)]
        assert in_order != sorted(in_order)
    assert all(r.grown in (r.shard, 10) for r in found) and any(r.grown == 10 for r in found)


@pytest.mark.parametrize("large_entry", [256, 1])
def test_links_against_all_pairs(spark, large_entry):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = {b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 3))) for b in base for _ in range(12)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {frozenset((r.a, r.b)) for r in simhash.links(df, large_entry).collect()}
    wanted = {
        frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2
    }
    assert found == wanted and wanted
    roots = {r.node: r.root for r in simhash.components(simhash.links(df, large_entry)).collect()}
    least = {p: p for p in signed}
    for _ in range(len(signed)):
        for a, b in map(tuple, wanted):
            least[a] = least[b] = min(least[a], least[b])
    assert roots == {p: r for p, r in least.items() if any(p in pair for pair in wanted)}


def test_fingerprint_against_plain_version():
    import xxhash

    for text in ("A b  C\td", "one", "x y", "Ä Ö ü a b c a b c a b c", ""):
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
        runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
        assert simhash.fingerprint(text.encode()) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_repeats_in_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(substring, "PIECE_WORDS", 50)
    rng = random.Random(2)
    words = [f"w{rng.randint(0, 400)}" for _ in range(700)]
    texts = [words[:300] + words[100:160] + words[300:], words[400:440] + ["end"], words[10:44]]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    runs = Counter(tuple(t[i : i + 35]) for t in texts for i in range(len(t) - 34))
    for row in substring.remove_repeats(df).collect():
        t = texts[row.doc_id]
        gone = {j for i in range(len(t) - 34) if runs[tuple(t[i : i + 35])] > 1 for j in range(i, i + 35)}
        assert row.n_removed == len(gone)
        assert row.kept_text == " ".join(w for j, w in enumerate(t) if j not in gone)


def test_packed_ids_are_the_tokenizers(spark, sf_dir):
    path = queries.tokenizer_path()
    plain = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    whole, spans = {}, {}
    for r in packing.pack(docs, path, window=512, with_ids=True).collect():
        whole.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, pieces in whole.items():
        ids = [i for _, piece, _ in sorted(pieces) for i in piece]
        assert ids == [*plain.encode(texts[doc_id], add_special_tokens=False).ids, 2] and pieces[0][2] == len(ids)
    assert whole.keys() == texts.keys()
    for rows in spans.values():
        ends = [0, *np.cumsum([n for _, n in sorted(rows)]).tolist()]
        assert [o for o, _ in sorted(rows)] == ends[:-1] and ends[-1] <= 512
    total = sum(n for rows in spans.values() for _, n in rows)
    assert len(spans) <= total / 512 * 1.03 + 1


def test_odd_texts_are_encoded_as_by_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, encoder = Tokenizer.from_file(path), packing.WordEncoder(path, remembered=50)
    rng = random.Random(4)
    letters = "abcdefgéèüßñ'.,!0189ABC$%-_<>|İΣ½́ "
    texts = ["<|endoftext|> a<|startoftext|>b", "it's I'LL don't", "", " ", "日本語 😀 \x85k a\xadb", "x" * 300]
    texts += ["".join(rng.choice(letters) for _ in range(60)) for _ in range(300)]
    for group in (texts[:3], texts[3:6], texts[6:]):
        ids, starts = encoder.encode([t.encode() for t in group])
        for text, s, e in zip(group, starts[:-1], starts[1:], strict=True):
            assert ids[s:e].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(6)
    lengths = sorted((rng.randint(1, 64) for _ in range(500)), reverse=True)
    windows, offsets = packing.best_fit_decreasing(lengths, 64)
    room = []
    for n, w, o in zip(lengths, windows, offsets, strict=True):
        fits = [r for r in room if r >= n]
        if w == len(room):
            assert not fits
            room.append(64)
        else:
            assert room[w] == min(fits)
        assert o == 64 - room[w]
        room[w] -= n


def test_segments_against_all_spans():
    rng = random.Random(8)
    for _ in range(200):
        n = rng.randint(1, 14)
        x = [rng.choice([-0.1, -0.1, -0.1, 0.25, 1.0]) for _ in range(n)]
        hits = [i for i, s in enumerate(x) if s > 0]
        found = toxicity.maximal_segments(hits, [x[i] for i in hits], 0.1)
        total = lambda a, b: sum(x[a : b + 1])
        assert all(abs(total(a, b) - s) < 1e-9 for a, b, s in found)
        assert all(a[1] < b[0] for a, b in zip(found, found[1:]))
        if hits:
            best = max(total(a, b) for a in range(n) for b in range(a, n))
            assert abs(max(s for *_, s in found) - best) < 1e-9


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = queries.QUERIES["op4_language_id"](spark, folder).filter("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in found) > 0.97 * len(found)
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = queries.QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.1").filter("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted and r.toxic for r in found)
    assert right > 0.9 * sum(r.toxic for r in found) and right > 0.75 * sum(r.predicted for r in found)
