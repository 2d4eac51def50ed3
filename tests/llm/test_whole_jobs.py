"""The operators on whole documents, against plain versions."""

import random
from collections import Counter

import corpus_pipeline
import numpy as np
from logquarry.llm import queries, sharding, similar
from tokenizers import Tokenizer


def edited_copies():
    """Texts of 40 to 400 words, each with copies of which more and more words are changed."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randint(0, 50_000)}"
    texts = ["", " \n", "one two", "One  two", "one three"]
    for n in (40, 100, 200, 400):
        for _ in range(8):
            base = [word() for _ in range(n)]
            texts.append(" ".join(base))
            for share in (0.005, 0.01, 0.015, 0.02, 0.03, 0.05):
                changed = base.copy()
                for i in rng.sample(range(n), max(1, round(n * share))):
                    changed[i] = word()
                texts.append(" ".join(changed))
    common = [word() for _ in range(60)]
    texts += [" ".join(common + [word() for _ in range(60)]) for _ in range(40)]
    return dict(enumerate(texts))


def shingle_set(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_near_copies_against_all_pairs(spark):
    texts = edited_copies()
    sets = {i: shingle_set(t) for i, t in texts.items()}
    least = {i: i for i in texts}
    pairs = [(a, b) for a in texts for b in texts if a < b and jaccard(sets[a], sets[b]) >= 0.8]
    assert len(pairs) > 150
    for _ in texts:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = similar.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in found} == least
    assert {r.doc_id for r in found if r.stays} == set(least.values())
    sizes = Counter(least.values())
    assert all(r.component_size == sizes[r.component_id] for r in found)
    left = corpus_pipeline.dedup_near(spark, docs, "").collect()
    assert sorted(r.doc_id for r in left) == sorted(set(least.values()))
    assert similar.near_duplicates(docs.limit(0)).count() == 0


def test_sharding_moves_whole_documents(spark, sf_dir, monkeypatch):
    written = []
    write = sharding.write_shards
    monkeypatch.setattr(sharding, "write_shards", lambda df, path: (written.append(path), write(df, path)))
    rows = queries.QUERIES["op6_sharding"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    back = spark.read.parquet(written[0])
    assert Counter(map(tuple, back.select(*docs.columns).collect())) == Counter(map(tuple, docs.collect()))
    places = {(r.doc_id, r.shard, r.slot) for r in back.collect()}
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == places and len(rows) == docs.count()


def test_packed_windows_hold_the_tokens_of_all_copies(spark):
    texts = [(1, "some words here"), (1, "some words here"), (2, None), (3, "longer " * 5000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    plain = Tokenizer.from_file(queries.tokenizer_path())
    wanted, sequences, found = Counter(), {}, Counter()
    for _, text in texts:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        wanted.update(tuple(ids[i : i + 4096]) for i in range(0, len(ids), 4096))
    for r in corpus_pipeline.pack_windows(spark, docs, "").collect():
        ids = tuple(np.frombuffer(r.ids, "<u4").tolist())
        found[ids] += 1
        assert len(ids) == r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert found == wanted
    for rows in sequences.values():
        assert [o for o, _ in sorted(rows)] == [0, *np.cumsum([n for _, n in sorted(rows)]).tolist()][:-1]


def test_a_family_below_the_bound_is_not_compared_in_pairs(spark, monkeypatch):
    """300 texts that share 170 of 210 words: none is similar, and few pairs are looked at."""
    rng = random.Random(1)
    common = [f"c{i}" for i in range(170)]
    texts = [" ".join(common + [f"u{rng.random()}" for _ in range(40)]) for _ in range(300)]
    texts += [texts[0] + " end", texts[7] + " end"]
    compared = []
    verified = similar._verified
    monkeypatch.setattr(similar, "_verified", lambda pairs, *a: (compared.append(pairs.count()), verified(pairs, *a))[1])
    found = similar.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id for r in found if not r.stays} == {300, 301}
    assert sum(compared) < 3 * len(texts)
