"""Ranked search against scoring every document in plain integers."""

import math
from collections import Counter

import numpy as np
import pytest

from retail_layers.llm import balltree, queries


def brute(documents, items, k=10):
    docs = [(i, Counter(balltree.terms(t))) for i, t in documents]
    docs = [(i, c) for i, c in docs if c]
    total = sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in set(items):
        asked = Counter(balltree.terms(text))
        scored = []
        for i, c in docs:
            m = 25 + (75 * sum(c.values()) * len(docs)) // total
            score = sum(times * math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t, times in asked.items() if t in c)
            if score > 0:
                scored.append((-score, i is not None, i or 0))
        out += [(item, rank, i if there else None, -score) for rank, (score, there, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(spark, rows, key):
    return spark.createDataFrame(rows, f"{key} bigint, text string")


def texts(seed, n=300):
    """Few topics with common words, copies, and texts of very different lengths."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        topic = rng.integers(0, 6)
        if i % 5 == 4:
            out.append(out[rng.integers(0, len(out))])
            continue
        words = [f"w{rng.zipf(1.5) % 40}" if rng.random() < 0.5 else f"t{topic}x{rng.integers(0, 30)}"
                 for _ in range(int(rng.integers(1, 60)) * (20 if i == 7 else 1))]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("block", "leaf", "group_terms"), [(64, 4, 50_000), (1000, 1, 30), (7, 3, 1)])
def test_every_block_leaf_and_group_size(spark, block, leaf, group_terms):
    docs = [(i * 3 % 301, t) for i, t in enumerate(texts(3))]
    items = [(i, " ".join(t.split()[:12])) for i, t in enumerate(texts(4, 12))]
    df = balltree.search(made(spark, docs, "doc_id").repartition(5), made(spark, items, "item_id"), block=block, leaf=leaf, group_terms=group_terms)
    assert got(df) == brute(docs, items)


def test_bounds_hold_and_leave_out_leaves():
    """No score lies above a bound of a ball around it, and most balls of other topics are never scored."""
    rng = np.random.default_rng(5)
    width, n = 400, 2000
    rows = []
    for i in range(n):
        topic = i % 20
        cols = np.unique(np.r_[rng.integers(0, 10, 3), 10 + topic * 19 + rng.integers(0, 19, 8)])
        rows.append((cols, rng.integers(1, 900_000, len(cols))))
    begin = np.r_[0, np.cumsum([len(c) for c, _ in rows])]
    sparse = balltree.Sparse(begin, np.concatenate([c for c, _ in rows]), np.concatenate([v for _, v in rows]).astype(float))
    asked = [(np.array([1, 10 + t * 19, 11 + t * 19, 15 + t * 19]), np.array([5, 9000, 8000, 7000])) for t in range(20)]
    q = balltree.Queries(np.r_[0, np.cumsum([4] * 20)], np.concatenate([t for t, _ in asked]), np.concatenate([w for _, w in asked]))
    tree = balltree.BallTree(sparse, q, width, leaf=16)
    leaves = [b for b, held in enumerate(tree.leaf) if held is not None]
    assert sorted(np.concatenate([tree.leaf[b] for b in leaves]).tolist()) == list(range(n))
    for ball in leaves:
        for k, (words, weights) in enumerate(asked):
            assert tree.scores(ball, words, weights).max() <= tree.bounds[ball][k]
    met = [tree.search(k, q, [], 10, [(-1, -i) for i in range(n)]) for k in range(20)]
    assert max(met) < len(leaves) / 2


def test_large_sums_stay_exact():
    rows = balltree.Sparse(np.array([0, 2]), np.array([0, 1]), np.array([999_999.0, 3.0]))
    q = balltree.Queries(np.array([0, 2]), np.array([0, 1]), np.array([2**40, 1]))
    assert balltree.BallTree(rows, q, 2).scores(0, *q.of(0)).tolist() == [999_999 * 2**40 + 3]


def test_odd_rows(spark, odd):
    items = [(1, "one TWO twelve"), (1, "one TWO twelve"), (1, "token"), (None, "word"), (2, None), (3, " ,; "), (4, "unknown"), (5, "lé 你好 ß"),
             (6, "one " * 2000)]
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    clash = made(spark, items, "item_id").selectExpr("*", "1 as doc_id", "2 as rank", "'x' as terms")
    assert got(balltree.search(odd, clash)) == brute(docs, [i for i in items if i[1] is not None])


def test_empty_tables(spark, odd):
    none = made(spark, [], "item_id")
    assert got(balltree.search(odd, none)) == []
    assert got(balltree.search(made(spark, [], "doc_id"), made(spark, [(1, "a")], "item_id"))) == []
    assert got(balltree.search(made(spark, [(1, None), (2, "--")], "doc_id"), made(spark, [(1, "a")], "item_id"))) == []


def test_given_documents(spark, given):
    docs, items = ([tuple(r) for r in given(n).select(k, "text").collect()] for n, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    want = brute(docs, items)
    assert len(want) > 100 and got(queries.op12_ranked(spark, "/root/testdata/sf0.001")) == want
