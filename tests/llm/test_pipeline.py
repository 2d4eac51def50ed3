"""The stages of the corpus pipeline, each against a plain version on its own input."""

import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from logquarry.llm import queries
from pyspark.sql import functions as F
from tokenizers import Tokenizer

EXTRA = ("text_hash", "gone_id", "score", "mixed_id", "pipeline_key", "decided_id", "node", "key", "lang_pred", "rejected", "position")


def key_of(row):
    """Of what decides: id, text and source, with the row's own extra column to tell rows apart."""
    return (row["doc_id"], row["text"], row["source"])


def plain_language(rows):
    return [r for r in rows if any(c.isalpha() for c in r["text"] or "")]


def plain_exact(rows):
    best = {}
    for r in rows:
        t = r["text"] or ""
        order = (r["doc_id"] is not None, r["doc_id"] or 0)
        if t not in best or order > best[t][0]:
            best[t] = (order, r)
    return [r for _, r in best.values()]


def shingle_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_near(rows):
    sets = [shingle_set(r["text"]) for r in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if both >= 0.8 * (len(a) + len(b) - both):
                group[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    order = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    for i, r in enumerate(rows):
        g = root(i)
        if g not in least or order(r) < order(least[g]):
            least[g] = r
    return list(least.values())


def plain_mix(rows):
    """Rows in the order of the mix, as often as it takes them."""
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size(r) for r in rows if r["source"] == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    target, open_ones, rest = {}, set(sources), float(sum(total.values()))
    while open_ones:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_ones) for s in open_ones}
        over = {s for s in open_ones if share[s] >= 3 * total[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * total[s]
            rest -= target[s]
        open_ones -= over
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    named = lambda r: "" if r["doc_id"] is None else str(r["doc_id"])
    copies = []
    for rank, s in enumerate(sources):
        mine = sorted((md5(f"mix:{named(r)}:{md5(r['text'] or '')}"), i) for i, r in enumerate(rows) if r["source"] == s)
        words = 0
        for key, i in mine:
            words += size(rows[i])
            if size(rows[i]):
                copies += [((total[s] * e + words) / target[s], rank, key, i) for e in range(3)]
    out, used = [], 0
    for *_, i in sorted(copies):
        used += size(rows[i])
        if used > sum(total.values()):
            break
        out.append(rows[i])
    return out


@pytest.fixture(scope="module")
def odd_docs(spark, sf_dir):
    rng = random.Random(9)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    word = lambda: f"w{rng.randint(0, 9999)}"
    base = [word() for _ in range(120)]
    texts = [" ".join(base)]
    for n in (1, 2, 3, 5, 8):
        edited = base.copy()
        for i in rng.sample(range(120), n):
            edited[i] = word()
        texts.append(" ".join(edited))
    texts += [None, "", " \t", "12 34", "only", "Only", "the same", "the same", "word " * 30_000, "ünï cödé", " x"]
    odd = [{"doc_id": 10**6 + i, "text": t, "lang": "en" if i % 2 else None, "source": ("new", None, "web")[i % 3], "n_chars": None}
           for i, t in enumerate(texts)]
    odd += [{**odd[0], "doc_id": None}, {**odd[1], "doc_id": None}, odd[2], {**odd[3], "source": "other"}, {**odd[12], "doc_id": None, "text": "no id"}]
    odd += [odd[13]] * 5
    full = [(*(r[c] for c in docs.columns), *[f"x{i}"] * len(EXTRA)) for i, r in enumerate(rows + odd)]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return spark.createDataFrame(full, types + "".join(f", `{c}` string" for c in EXTRA))


PLAIN = {"language_id": plain_language, "exact_dedup": plain_exact, "near_dedup": plain_near}


def test_stages_against_plain_versions(spark, odd_docs):
    docs = odd_docs.cache()
    for name, made in corpus_pipeline.STAGES[:4]:
        before = [r.asDict() for r in docs.collect()]
        after = made(spark, docs, "").cache()
        assert after.columns == odd_docs.columns
        found = [r.asDict() for r in after.collect()]
        if name == "mixing":
            assert [key_of(r) for r in found] == [key_of(r) for r in plain_mix(before)], name
        else:
            assert Counter(map(key_of, found)) == Counter(map(key_of, PLAIN[name](before))), name
        # Whole rows come through, with whatever they carry.
        carried = {tuple(r.values()) for r in before}
        assert all(tuple(r.values()) in carried for r in found), name
        assert found and len(found) != len(before), name
        docs = after
    plain = Tokenizer.from_file(queries.tokenizer_path())
    wanted = Counter()
    for r in docs.collect():
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 2]
        wanted.update((r.doc_id, at, tuple(ids[at : at + 4096])) for at in range(0, len(ids), 4096))
    got = Counter()
    for r in corpus_pipeline.STAGES[4][1](spark, docs, "").collect():
        got[r.doc_id, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())] += 1
    assert got == wanted


def test_repeated_rows_in_every_stage(spark, odd_docs):
    """Each stage on an input that no earlier one has cleaned."""
    docs = odd_docs.filter("doc_id is null or doc_id >= 1000000")
    before = [r.asDict() for r in docs.collect()]
    texts = lambda rows: {(r["doc_id"], r["text"]) for r in rows}
    near = [r.asDict() for r in corpus_pipeline.dedup_near(spark, docs, "").collect()]
    assert texts(near) == texts(plain_near(before))
    mixed = [r.asDict() for r in corpus_pipeline.mix_sources(spark, docs, "").collect()]
    pair = lambda r: (r["doc_id"], r["text"])
    assert Counter(map(pair, mixed)) == Counter(map(pair, plain_mix(before)))


def test_empty_table(spark, odd_docs):
    for name, made in corpus_pipeline.STAGES:
        assert made(spark, odd_docs.limit(0), "").count() == 0, name


def test_run_is_its_stages(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and all(r.length == len(r.ids) // 4 for r in rows)


def test_near_stage_looks_at_simhash_components(spark, monkeypatch):
    """Similar texts are joined by their fingerprints alone, where they share no key of minimum hashes; texts
    of one fingerprint that are not similar stay."""
    rng = random.Random(21)
    base = " ".join([f"w{rng.random()}" for _ in range(41)] * 20)
    line = " ".join(f"common{i}" for i in range(7))
    texts = [base, base + " end", *[f"{line} " * 60 + " ".join(f"u{rng.random()}" for _ in range(12)) for _ in range(6)]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    prints = {r.doc_id: r.component_id for r in corpus_pipeline.simhash.near_duplicates(docs).collect()}
    assert prints[0] == prints[1] and len({prints[i] for i in range(2, 8)}) == 1
    sketched = corpus_pipeline.similar.sketches
    none = F.filter("keys", lambda _: F.lit(False)).alias("keys")
    monkeypatch.setattr(corpus_pipeline.similar, "sketches", lambda *a: sketched(*a).select("doc_id", "text_hash", "node", "n", none))
    left = corpus_pipeline.dedup_near(spark, docs, "").collect()
    assert sorted(r.doc_id for r in left) == [0, *range(2, 8)]
