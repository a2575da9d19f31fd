"""Language codes and neighbour search: codes, accuracy, recall against brute force, odd rows."""

import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retail_layers.llm import language, neighbours, queries

SF01 = "/root/testdata/sf0.01"


def test_codewords_are_far_apart_and_correct_one_bit():
    for n in (2, 3, 4, 5, 9, 30):
        words = language.codewords(n)
        apart = [(a != b).sum() for i, a in enumerate(words) for b in words[:i]]
        assert min(apart) >= (1 if n == 2 else 2) and np.abs(words.sum(0)).max() < n
    words = language.codewords(4)
    codes = language.Codes(list("abcd"), words, np.eye(words.shape[1]), np.zeros(words.shape[1]), np.ones(words.shape[1]))
    for k in range(4):
        for flip in range(words.shape[1]):
            x = 4.0 * words[k].copy()
            x[flip] *= -1
            assert codes.decode(x[None, :])[0] == ["abcd"[k]]
    assert codes.decode(np.zeros((1, words.shape[1])))[2][0]


def test_language_on_the_held_out_fold(spark, given):
    known = {r["doc_id"]: r["lang"] for r in given("documents", SF01).collect()}
    rows = queries.op6_language(spark, SF01).collect()
    out = [r for r in rows if r["held_out"]]
    assert len(rows) == len(known) and all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in out)
    assert np.mean([r["lang_pred"] == known[r["doc_id"]] for r in out]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_tables(spark, odd):
    codes = language.train(odd)
    got = odd.select("doc_id", "text", language.identify(F.col("text"), codes).alias("l")).collect()
    assert len(got) == odd.count()
    assert all((r["l"]["lang_pred"], r["l"]["score"]) == ("und", 0) for r in got if not language.has_letter(r["text"]))
    assert all(r["l"]["lang_pred"] == "en" for r in got if language.has_letter(r["text"]))
    assert language.train(odd.limit(0)) is None
    assert {r[0] for r in odd.select(language.identify(F.col("text"), None).alias("l")).select("l.lang_pred").collect()} == {"und"}


def exact(ids, x, query, k=20):
    at = ids.index(query)
    score = x @ x[at]
    score[at] = -np.inf
    order = np.lexsort((ids, -score))[:k]
    return [(ids[j], score[j]) for j in order if np.isfinite(score[j])]


def test_recall_and_scores_on_given_vectors(spark, given):
    rows = given("embeddings", "/root/testdata/sf0.1").collect()
    ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in queries.op1_neighbours(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"], r["score"]
    assert set(got) == {i for i in ids if i % 20 == 0}
    place = {v: k for k, v in enumerate(ids)}
    recall = []
    for q, found in got.items():
        assert sorted(found) == list(range(1, 21)) and q not in {v for v, _ in found.values()}
        ranked = [found[k] for k in range(1, 21)]
        assert ranked == sorted(ranked, key=lambda v: (-v[1], v[0]))
        assert [s for _, s in ranked] == pytest.approx([x[place[v]] @ x[place[q]] for v, _ in ranked], abs=1e-12)
        recall.append(len({v for v, _ in ranked} & {v for v, _ in exact(ids, x, q)}) / 20)
    assert np.mean(recall) >= 0.95


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 3.0]), (20, [1.0, 0.0]), (21, [1.0, 0.0]), (21, [1.0, 0.0]),
            (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]),
            (40, [0.0, -1.0]), (60, None), (80, [0.0, 0.0]), (9, [])]
    rows += [(1000 + i, [0.5, 0.5]) for i in range(70)]  # many equal vectors
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as node", "2 as v", "'x' as query_id")
    valid = dict((i, v) for i, v in rows if i is not None and v and len(v) == 2 and None not in v and np.isfinite(v).all() and any(v))
    ids, x = list(valid), np.array(list(valid.values()))
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == {q: exact(ids, x, q) for q in ids if q % 20 == 0}
    assert neighbours.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    two = df.where("vec_id in (0, 1)")
    assert [tuple(r) for r in neighbours.search(two, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 2.0)]


def random_vectors(spark, path, n, every, seed=5):
    import pyarrow as pa
    import pyarrow.parquet as pq
    x = np.random.default_rng(seed).normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    vectors = pa.ListArray.from_arrays(np.arange(0, n * 64 + 1, 64, dtype=np.int32), x.ravel())
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": vectors}), f"{path}/v.parquet")
    got = {}
    for r in neighbours.search(spark.read.parquet(f"{path}/v.parquet"), F.col("vec_id") % every == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    ids = list(range(n))
    return np.mean([len(got[q] & {v for v, _ in exact(ids, x, q)}) / 20 for q in range(0, n, every)])


def test_recall_does_not_fall_with_the_size_of_the_table(spark, tmp_path):
    assert random_vectors(spark, tmp_path, 40_000, 500) >= 0.9


def test_leaves_grow_until_the_true_neighbours_are_met():
    rng = np.random.default_rng(3)
    x = neighbours._lifted(rng.normal(size=(3000, 24)), 200.0)
    forest = neighbours.plant(x, 12, 4)
    q = np.c_[rng.normal(size=(20, 24)), np.zeros(20)]
    true = [x[np.argsort(-(x[:, :24] @ one[:24]))[:20]] for one in q]
    wanted = forest.needed(q, true, 0.9)

    def met(n):
        return np.mean([np.isin(forest.leaves(t), p).any(1).mean() for t, p in zip(true, forest.probes(q, n))])

    assert met(wanted) >= 0.9 > met(wanted // 2) and 16 < wanted < forest.n_leaves


@pytest.mark.parametrize("n", [399, 3000])
def test_equal_products_go_to_the_smaller_ids(spark, n):
    """All inner products of the query are equal: by trees or not, the smallest ids are the nearest."""
    rows = [(i, [1.0, float(i)]) for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(7)
    found = neighbours.search(df, F.col("vec_id") == 0, sample_rows=50_000).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == list(range(1, 21)) and {r["score"] for r in found} == {1.0}


def test_scores_do_not_depend_on_the_block(spark):
    """Copies of a vector under other lengths of the block keep one score, and ties by id hold at the edge."""
    rng = np.random.default_rng(3)
    v = rng.normal(size=(300, 64)).astype(np.float32)
    held = pd.DataFrame({"node": np.arange(300), "least": np.arange(300)[::-1].copy(), "v": list(v)})
    asked = pd.DataFrame({"node": np.arange(40), "v": list(v[:40])})
    whole = neighbours._scored(held, asked, 20)
    parts = pd.concat([neighbours._scored(held.iloc[a:a + 37], asked, 20) for a in range(0, 300, 37)])
    merged = whole.merge(parts, on=["query", "node"], suffixes=("", "_part"))
    assert len(merged) == len(whole) == 40 * 21 and (merged["score"] == merged["score_part"]).all()
