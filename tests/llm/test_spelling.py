"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from logquarry.llm import spelling

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def texts_of(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(5, 9))) for _ in range(60)] + ["straße", "ÀÉÎÕÜ", "x×y÷zz", "aaaaa", "aaaaaa"]
    words = base + [w[:i] + rng.choice(["", "a", "é", "bb"]) + w[i + 1 :] for w in base for i in range(len(w))]
    words += [w.upper() for w in base]
    rows = [(i, " ".join(rng.choice(words) for _ in range(400))) for i in range(30)]
    chain = ["chains"] * 40 + ["chainz"] * 15 + ["cainz"] * 5  # a form that has a form itself
    rows += [(100 + i, " ".join(chain)) for i in range(3)]
    return rows + [(None, "abcab abcab ABCAB"), (3, None), (4, ""), (5, "ab, cd; é"), (1, rows[1][1]), (7, "longword" * 20_000)]


@pytest.mark.parametrize("large", [512, 1])
def test_against_all_pairs(spark, large):
    rows = texts_of(3)
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    found = {tuple(r) for r in spelling.variants(docs, large_gram=large).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    wanted = plain(rows)
    assert found == wanted
    assert any(f and f != r for _, f, r, *_ in wanted)


def test_empty_table(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
