"""Near duplicates against all pairs; streaming of buckets; components."""

import re

import numpy as np
import pyarrow as pa
import pytest

from retail_layers.llm import neardup, queries

SF01 = "/root/testdata/sf0.01"


def shingle_set(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def brute(rows):
    """doc_id, n_shingles, component_id, kept over all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    pairs = {(i, j) for held in by.values() for i in held for j in held if i < j}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= 75 * len(sets[i] | sets[j]):
            up[root(i)] = root(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[root(i)] = min(name, least.get(root(i), name))
    out = [(name, len(s), least.get(root(i), name) if s else name) for i, ((name, _), s) in enumerate(zip(rows, sets))]
    return sorted(((*x, x[0] is not None and x[0] == x[2]) for x in out), key=str)


def linked(df):
    return sorted((tuple(r) for r in neardup.link(df).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def test_given_documents_against_all_pairs(spark, given):
    got = sorted((tuple(r) for r in queries.op9_neardup(spark, SF01).collect()), key=str)
    assert got == brute([tuple(r) for r in given("documents", SF01).select("doc_id", "text").collect()])
    assert 0 < sum(not r[3] for r in got) < len(got)


def test_odd_tables(spark, odd):
    assert linked(odd) == brute([tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert linked(odd.limit(0)) == []
    kept = neardup.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted("1 3 4 5 None 6 7 7 8".split())


@pytest.mark.parametrize("n", [40, 150])
def test_chains_and_large_groups_lose_no_link(spark, n):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in rng.integers(0, 9000, 80)]
    rows, words = [], list(base)
    for i in range(n):  # each text differs a little from the one before, and at last wholly from the first
        rows.append((i, " ".join(words)))
        words[rng.integers(0, 80)] = f"n{i}"
    for i in range(n):  # near copies of one text
        other = list(base)
        other[i % 80] = f"m{i}"
        rows.append((1000 + i, " ".join(other)))
    rows += [(5000 + i, " ".join(base[:40]) + " " + " ".join(f"u{i}_{k}" for k in range(40))) for i in range(n)]
    assert linked(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)) == brute(rows)


def test_bucket_stream_is_the_same_in_any_batches():
    rng = np.random.default_rng(1)
    key = np.sort(np.concatenate([rng.integers(0, 30, 100), np.full(60, 7)]))
    node = np.concatenate([np.sort(rng.choice(10_000, (key == k).sum(), replace=False)) for k in np.unique(key)])

    def edges(size):
        table = pa.table({"key": key, "node": node})
        out = pa.Table.from_batches(list(neardup._edges(iter(table.to_batches(max_chunksize=size)))))
        return {tuple(x.values()) for x in out.to_pylist()}

    whole = edges(10_000)
    assert all(edges(size) == whole for size in (1, 3, 17, 50))
    for k in np.unique(key):
        held = node[key == k]
        if len(held) <= neardup.FULL:
            assert {(a, b, None) for i, a in enumerate(held) for b in held[i + 1:]} <= whole
        else:
            assert {(None, b, k) for b in held} <= whole and {(held[0], b, None) for b in held[1:]} <= whole


def test_components_of_a_long_chain(spark):
    order = np.random.default_rng(2).permutation(60).tolist()
    edges = spark.createDataFrame([*zip(order, order[1:]), (100, 101), (101, 100), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in neardup.components(edges).collect()}
    assert got == {**{k: 0 for k in range(60)}, 100: 100, 101: 100}


def test_signature_agreement_follows_similarity():
    h = neardup.Hashing()
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 1200, dtype=np.uint64)
    a, b = np.unique(pool[:1000]), np.unique(pool[200:])
    shared = np.mean([(h.band_keys(neardup.mixed(a + np.uint64(k))) == h.band_keys(neardup.mixed(b + np.uint64(k)))).mean()
                      for k in range(20)])
    assert shared == pytest.approx((800 / 1200) ** neardup.ROWS, abs=0.04)
    assert np.array_equal(neardup.unpack(neardup.pack(a)), a >> np.uint64(16))
