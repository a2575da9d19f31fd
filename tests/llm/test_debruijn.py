"""Repeated passages of words against a dictionary of all windows."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from retail_layers.llm import debruijn, queries

N = debruijn.WINDOW


def brute(rows):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + N]) for w in texts for i in range(len(w) - N + 1))
    out = []
    for (name, _), w in zip(rows, texts):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - N + 1):
            if seen[tuple(w[i:i + N])] > 1:
                gone[i:i + N] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((name, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    rows = debruijn.without_repeats(df).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in rows), key=str)


def made(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def pieced(seed, n=80):
    """Texts of shared parts that are cut, doubled, changed in one word, or periodic, and of own words."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdeé"), rng.integers(1, 5)))
    shared = [[word() for _ in range(int(rng.integers(20, 120)))] for _ in range(6)]
    out = []
    for i in range(n):
        words = []
        for _ in range(int(rng.integers(0, 6))):
            part = list(shared[rng.integers(0, 6)])
            kind = rng.integers(0, 6)
            if kind == 0:
                part = part[rng.integers(0, len(part)):]
            elif kind == 1:
                part = part[:rng.integers(0, len(part))]
            elif kind == 2:
                part[rng.integers(0, len(part))] = word()
            elif kind == 3:
                part = part[:int(rng.integers(1, 5))] * int(rng.integers(1, 40))
            elif kind == 4:
                part = [word() for _ in range(int(rng.integers(1, 60)))]
            words += part
        out.append((i, [" ", "\n", " \t "][i % 3].join(words)))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_texts_of_shared_parts(spark, seed):
    rows = pieced(seed) + [(200 + i, t) for i, t in pieced(seed)[:20]]
    want = brute(rows)
    assert sum(r[2] for r in want) > 1000 and sum(r[1] - r[2] for r in want) > 1000
    assert got(made(spark, rows).repartition(5)) == want


def test_long_chains_compact_into_whole_passages(spark):
    """One long passage in two texts is one path, one with a third text inside it is three."""
    words = [f"w{i}" for i in range(3000)]
    other = [f"v{i}" for i in range(600)]
    texts = ["x1 " + " ".join(words) + " y1", "x2 " + " ".join(words) + " y2",
             " ".join(other), "z1 " + " ".join(other) + " z2", "z3 " + " ".join(other[200:300]) + " z4"]
    found = debruijn.spans(made(spark, list(enumerate(texts)))).collect()
    per_passage = Counter((r["passage"], r["stop"] - r["start"]) for r in found)
    assert sorted((n, size) for (_, size), n in per_passage.items()) == [(2, 234), (2, 334), (2, 3000), (3, 100)]


def test_odd_rows(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert got(odd) == brute(rows)
    long = " ".join(f"u{i}" for i in range(34))
    rows = [(1, long), (1, long), (None, long + " end"), (None, long + " end"), (2, None), (3, ""), (4, long + " fin"), (5, "a " * 36), (6, "b " * 34)]
    clash = made(spark, rows).selectExpr("*", "'x' as tag", "1 as twin", "2 as anchor", "3 as spans", "4 as kept", "5 as f")
    assert got(clash) == brute(rows)


def test_no_documents(spark):
    assert got(made(spark, [])) == []


def test_given_documents(spark, given):
    rows = [tuple(r) for r in given("documents").select("doc_id", "text").collect()]
    want = brute(rows)
    assert sum(r[2] for r in want) > 0
    assert sorted((tuple(r) for r in queries.op11_passages(spark, "/root/testdata/sf0.001").collect()), key=str) == want
