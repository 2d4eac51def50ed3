"""One row, or one id, on most of a table: buckets, samples and slots."""

import random
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from logquarry.llm import langid, mixing, sharding, toxicity
from pyspark.sql import functions as F


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def plain_shard(key, shards):
    """The shard of highest hash; Spark hashes one value after the other, each seeded by the last."""
    best = []
    for s in range(shards):
        h = 42
        for data in ([] if key is None else [struct.pack("<q", key)]) + [struct.pack("<i", s), struct.pack("<i", sharding.SEED)]:
            h = xxhash.xxh64_intdigest(data, h)
        best.append((signed(h), s))
    return max(best)[1]


def test_shards_against_a_plain_version(spark):
    keys = [None, 0, 1, -1, 2**62, *range(100, 160)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").withColumn("s", sharding.shard_of(F.col("k"), 40))
    assert {r.k: r.s for r in df.collect()} == {k: plain_shard(k, 40) for k in keys}


@pytest.fixture(scope="module")
def equal_rows(spark):
    """20,000 of 30,000 rows are one row."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("the same").alias("text"),
        F.lit(100).alias("size"),
    )


def test_equal_rows_are_dealt_over_buckets(spark, equal_rows, monkeypatch):
    sizes = []
    collect = F.collect_list
    monkeypatch.setattr(F, "collect_list", lambda c: (sizes.append(c), collect(c))[1])
    found = sharding.shuffled_shards(equal_rows, shards=4, bucket_bytes=40_000)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert sizes and "shuffle" in plan
    rows = found.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in equal_rows.collect())
    for s in range(4):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    # How many rows each bucket takes up.
    hashed = equal_rows.select(F.lit(0).alias("shard"), F.xxhash64(F.struct("doc_id", "text", "size"), F.lit(7)).alias("mixed"),
                               F.struct("doc_id", "text", "size").alias("record"), F.col("size").alias("row_size"))
    spread = sharding._spread(hashed.drop("row_size"), sharding._weights(hashed, "row_size"))
    largest = spread.groupBy(F.pmod(F.xxhash64("mixed", "nth"), F.lit(100))).count().agg(F.max("count")).first()[0]
    assert spread.count() == 30_000 and largest < 400


def test_slots_do_not_follow_settings(spark, equal_rows):
    seen = []
    for parts in ("8", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            found = sharding.shuffled_shards(equal_rows.repartition(int(parts)), shards=5, bucket_bytes=100_000)
            seen.append(sorted((r.shard, r.slot, r.doc_id, r.text) for r in found.collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert seen[0] == seen[1]


def test_files_of_a_shard_follow_its_slots(spark, equal_rows, tmp_path):
    path = f"{tmp_path}/shards"
    sharding.write_shards(sharding.shuffled_shards(equal_rows, shards=3, bucket_bytes=100_000), path)
    for folder in sorted((tmp_path / "shards").glob("shard=*")):
        slots = [r.slot for f in sorted(folder.glob("*.parquet")) for r in spark.read.parquet(str(f)).collect()]
        assert slots == list(range(len(slots)))


def test_one_id_on_most_of_the_mix(spark):
    """Equal rows are one run; rows of one id with texts of their own lie in many buckets."""
    texts = [(7, "a b c", "x")] * 3000 + [(7, f"w{i} v", "x") for i in range(3000)] + [(None, f"u{i} v", "y") for i in range(2000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    rows = mixing.mix(docs, rows_per_bucket=500).collect()
    plain = mixing.mix(docs, rows_per_bucket=10**6).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, plain)) and len(rows) == 8000
    key = F.md5(F.concat_ws(":", F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5("text")))
    place = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    largest = docs.distinct().groupBy("source", F.shiftright(place * 11, 32)).count().agg(F.max("count")).first()[0]
    assert largest < 500
    order = mixing.mixed_order(docs, rows_per_bucket=500).orderBy("position").collect()
    assert len(order) == sum(r.copies for r in rows)
    assert all(a.finish <= b.finish and a.position < b.position for a, b in zip(order, order[1:]))


def test_one_id_does_not_fill_the_language_sample(spark, monkeypatch):
    rows = [(1, f"same id text {i}", "xx") for i in range(3000)] + [(i, f"other text {i}", "yy") for i in range(2, 40)]
    rows += [(5000 + i, f"rare {i}", "zz") for i in range(3)] + [(6000, "copied", "yy")] * 2000
    seen = []
    monkeypatch.setattr(langid, "train", lambda texts, langs: seen.append(Counter(langs)))
    langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), documents=30, each=5)
    assert sum(seen[0].values()) == 30 and seen[0]["zz"] == 3 and seen[0]["xx"] == 1


def test_one_id_does_not_fill_the_toxicity_sample(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(1, " ".join(rng.choice("abcdefgh") * 3 for _ in range(20))) for _ in range(2000)]
    rows += [(i, f"text number {i} has words of its own {i * 7}") for i in range(2, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.range(1, 300).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    sizes = []
    staged = toxicity.stage
    monkeypatch.setattr(toxicity, "stage", lambda df, name: (lambda out: (sizes.append((name, out.count())), out)[1])(staged(df, name)))
    toxicity.fit(docs, labels, documents=80)
    assert dict(sizes)["sample"] <= 80


def test_the_language_network_against_plain_loops():
    """Scores of whole texts, and the steps of training, without tables or windows views."""
    rng = np.random.default_rng(5)
    net = langid.Network(
        tuple(rng.normal(0, 0.3, (w, 256, langid.FILTERS)).astype(np.float32) for w in langid.WIDTHS),
        tuple(rng.normal(0, 0.1, langid.FILTERS).astype(np.float32) for _ in langid.WIDTHS),
        rng.normal(0, 0.3, (langid.FILTERS * len(langid.WIDTHS), 3)).astype(np.float32),
        rng.normal(0, 0.1, 3).astype(np.float32), ("a", "b", "c"),
    )
    texts = [b"", b"ab", bytes(rng.integers(1, 255, 700).tolist()), bytes(rng.integers(1, 255, 1500).tolist())]
    langs, probs = langid.Scorer(net)(texts)
    step = langid.WINDOW - max(langid.WIDTHS) + 1
    for text, lang, prob in zip(texts, langs, probs, strict=True):
        logs = []
        for at in range(0, max(1, len(text)), step):
            window = text[at : at + langid.WINDOW].ljust(langid.WINDOW, b"\0")
            pooled = []
            for weights, bias in zip(net.filters, net.biases, strict=True):
                w = weights.shape[0]
                sums = [sum(weights[o][window[i + o]] for o in range(w)) for i in range(langid.WINDOW - w + 1)]
                pooled.append(np.max(sums, axis=0) + bias)
            z = np.maximum(np.concatenate(pooled), 0) @ net.out + net.out_bias
            e = np.exp(z - z.max())
            logs.append(np.log(e / e.sum() + 1e-9))
        z = np.mean(logs, axis=0)
        p = np.exp(z - z.max())
        p /= p.sum()
        assert lang == net.langs[int(p.argmax())] and abs(prob - p.max()) < 1e-4


def plain_maximal(x):
    """All maximal scoring segments, by their definition: the best segment, then the same left and right of it."""
    best = max(((sum(x[a : b + 1]), -(b - a), a, b) for a in range(len(x)) for b in range(a, len(x))), default=(0, 0, 0, 0))
    if best[0] <= 0:
        return []
    score, _, a, b = best
    left, right = plain_maximal(x[:a]), plain_maximal(x[b + 1 :])
    return left + [(a, b, score)] + [(i + b + 1, j + b + 1, s) for i, j, s in right]


def test_every_maximal_segment_by_definition():
    rng = random.Random(3)
    for _ in range(300):
        x = [rng.choice([-0.1, -0.1, rng.uniform(0.05, 1)]) for _ in range(rng.randint(1, 12))]
        hits = [i for i, s in enumerate(x) if s > 0]
        found = toxicity.maximal_segments(hits, [x[i] for i in hits], 0.1)
        wanted = plain_maximal(x)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in wanted]
        assert all(abs(f[2] - w[2]) < 1e-9 for f, w in zip(found, wanted, strict=True))


def test_toxicity_scores_by_hand(spark):
    """Law, evidence and probability of whole texts from their definitions."""
    clean = [(100, [0.5, 1.5]), (50, [1.0]), (20, [])]
    rate, density = toxicity._law(clean)
    assert abs(rate - 4 / ((0 + 1.0 + 0.5) + 1.0)) < 1e-12
    assert abs(density - 4 * np.exp(rate * 0.5) / 171) < 1e-12
    x = toxicity.evidence(30, [2.0, 0.1], rate, density)
    assert abs(x - np.log1p(sum(max(0.0, rate * s - np.log(density * 30)) for s in (2.0, 0.1)))) < 1e-12
    words = ["vile", "awful"]
    hashes, _, _ = toxicity._tokens([" ".join(words).encode()])
    order = np.argsort(hashes)
    model = toxicity.Model(toxicity.Lexicon(hashes[order], np.array([2.0, 3.0])[order]), rate, density, 1.5, -2.0)
    texts = ["calm words only", "calm vile awful words", "", "vile " + "calm " * 40 + "awful"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.score(df, model).collect():
        tokens = texts[r.doc_id].split()
        values = [{"vile": 2.0, "awful": 3.0}.get(t, -toxicity.PENALTY) for t in tokens]
        segments = [s for _, _, s in plain_maximal(values)]
        wanted = 1 / (1 + np.exp(-(1.5 * toxicity.evidence(len(tokens), segments, rate, density) - 2.0)))
        assert abs(r.score - wanted) < 1e-9 and r.predicted == int(wanted >= 0.3)
