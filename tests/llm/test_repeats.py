"""Repeated byte strings against a plain dictionary of all windows."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from retail_layers.llm import queries, repeats

N = repeats.LENGTH


def brute(rows):
    """doc_id, n_bytes, n_removed, n_spans, digest of what is left."""
    first = {}
    raws = [((d is not None, d or 0), (t or "").encode()) for d, t in rows]
    for d, raw in sorted(raws):
        for i in range(len(raw) - N + 1):
            w = raw[i:i + N]
            first[w] = min(first.get(w, (d, i)), (d, i))
    out = []
    for (d, raw), (name, _) in zip(raws, rows):
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - N + 1):
            if first[raw[i:i + N]] < (d, i):
                gone[i:i + N] = True
        gone = gone[:len(raw)]
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        n_spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out.append((name, len(raw), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, **how):
    rows = repeats.without_repeats(df, **how).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
                   for r in rows), key=str)


def test_given_documents(spark, given):
    rows = [tuple(r) for r in given("documents").select("doc_id", "text").collect()]
    want = brute(rows)
    from_query = sorted((tuple(r) for r in queries.op3_repeats(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert from_query == want and sum(r[2] for r in want) > 0


def made_up(seed, n=60):
    """Texts pieced together from a few long parts, periodic stretches and own words."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdeé"), rng.integers(1, 9)))
    shared = [" ".join(word() for _ in range(rng.integers(10, 60))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.integers(0, 6)):
            kind = rng.integers(0, 4)
            part = shared[rng.integers(0, 6)]
            cut = rng.integers(0, len(part))
            parts.append([word(), part, part[cut:], (word() + " ") * rng.integers(1, 80)][kind])
        out.append((int(rng.integers(0, 200)) if i % 7 else i, "".join(parts)))
    seen = set()
    return [r for r in out if not (r[0] in seen or seen.add(r[0]))]


@pytest.mark.parametrize("seed,limit", [(0, 20_000), (1, 20_000), (2, 1), (3, 0)])
def test_made_up_texts_with_and_without_large_groups(spark, monkeypatch, seed, limit):
    rows = made_up(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got(df, max_contexts=limit) == brute(rows)


def test_many_texts_without_id_or_under_one_id(spark):
    """Rows of one id are compared by their starts, so each text is cut by its own stretches."""
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(2, 9)))
    shared = [" ".join(word() for _ in range(30)) for _ in range(8)]
    rows = []
    for i in range(400):
        parts = [shared[k] for k in rng.integers(0, 8, rng.integers(0, 3))] + [" ".join(word() for _ in range(rng.integers(1, 40)))]
        rows.append((None if i % 2 else 7, " ".join(parts[::-1] if i % 3 else parts)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got(df) == brute(rows)
    assert got(df, max_contexts=0) == brute(rows)


def test_texts_of_one_id_that_begin_alike_in_any_batches():
    table = pa.table({"anchor": [5] * 5, "context": [1, 1, 1, 1, 2], "doc": [3, 3, 3, 4, 2], "place": [7] * 5,
                      "tag": [10, 10, 11, 12, 13]})
    for size in (1, 2, 3, 5):
        rows = pa.Table.from_batches(list(repeats._settle(iter(table.to_batches(max_chunksize=size))))).to_pylist()
        found = {(r["doc"], r["tag"], r["anchor"]) for r in rows}
        assert found == {(3, 10, 5), (3, 11, 5), (4, 12, None), (2, 13, 5)}


def test_odd_tables(odd):
    rows = [tuple(r) for r in odd.select("doc_id", "text").where("not (doc_id <=> 7)").collect()]
    assert got(odd.where("not (doc_id <=> 7)")) == brute(rows)
    long_ones = {r[1]: r for r in got(odd) if r[0] == 7}
    assert long_ones[300_000][2] == 300_000 - 5  # all but the first period is covered by an earlier start
    assert got(odd.limit(0)) == []


def test_stream_is_the_same_in_any_batches():
    rng = np.random.default_rng(4)
    n = 300
    table = pa.table({"anchor": rng.integers(0, 25, n), "context": rng.integers(0, 3, n),
                      "doc": rng.integers(0, 40, n), "place": rng.integers(0, 50, n) << 17 | 7})
    table = table.sort_by([(c, "ascending") for c in table.column_names])

    def out(size):
        rows = pa.Table.from_batches(list(repeats._settle(iter(table.to_batches(max_chunksize=size))))).to_pylist()
        return sorted(((r["doc"], r["place"], r["anchor"]) for r in rows), key=str)

    whole = out(n)
    assert all(out(size) == whole for size in (1, 2, 5, 11, 64))
    assert any(r[2] is None for r in whole) and any(r[2] is not None for r in whole)


def test_run_index_gives_true_neighbours_and_lengths():
    rng = np.random.default_rng(6)
    text = np.concatenate([np.tile(rng.integers(1, 4, 40), 5), [0], rng.integers(1, 3, 150), [0]]).astype(np.uint16)
    index = repeats.RunIndex(text)
    order = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert repeats.suffix_array(text).tolist() == order and index.runs < len(text) * 0.7
    previous, shared = index.statistics()
    for a, b in zip(order, order[1:]):
        same = next((k for k in range(len(text)) if max(a, b) + k >= len(text) or text[a + k] != text[b + k]), 0)
        assert previous[b] == a and shared[b] == same
