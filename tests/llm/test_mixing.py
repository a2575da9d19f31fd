"""Mixing against a plain schedule, and its promises."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from retail_layers.llm import mixing, queries

SF01 = "/root/testdata/sf0.01"


def goals(size_of):
    """Targets by pouring again and again what the full sources cannot take."""
    names = sorted(size_of, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = sum(size_of.values()), dict.fromkeys(names, 0.0), set(names)
    while open_:
        left = total - sum(target[s] for s in names if s not in open_)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * size_of[s]}
        target.update({s: 3.0 * size_of[s] for s in full} if full else share)
        open_ = open_ - full if full else set()
    return names, target


def plain_mix(rows, slots):
    sizes = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, s in rows]
    size_of = Counter()
    for _, s, n in sizes:
        size_of[s] += n
    names, target = goals(size_of)
    total = sum(size_of.values())
    block = max(1, -(-total // slots))
    edges, at = [], 0.0
    for s in names:
        at += target[s]
        edges.append(at)
    rank, times = Counter(), Counter()
    for i in range(1, -(-total // block) + 1 if total else 1):
        point = i * mixing.GOLDEN % 1
        s = next(names[k] for k, e in enumerate(edges) if point < e / at)
        blocks = -(-size_of[s] // block)
        if rank[s] < 3 * blocks:
            times[s, rank[s] % blocks] += 1
        rank[s] += 1
    out, place = [], defaultdict(int)
    for d, s, n in sorted(sizes, key=lambda r: (hashlib.md5(str(r[0] if r[0] is not None else "").encode()).hexdigest(),
                                                r[0] is not None, r[0] or 0, r[2])):
        begin, place[s] = place[s], place[s] + n
        taken = sum(times[s, (begin + k) // block] for k in range(n))
        out.append((d, n, size_of[s], target[s], taken))
    return sorted(out, key=str)


def mixed(df, slots=mixing.SLOTS):
    return sorted((tuple(r) for r in mixing.mix(df, slots).drop("source").collect()), key=str)


def same(got, want):
    assert [(r[0], r[1], r[2], r[4]) for r in got] == [(r[0], r[1], r[2], r[4]) for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])


@pytest.mark.parametrize("slots", [mixing.SLOTS, 5000])
def test_given_documents_against_a_plain_schedule(given, slots):
    documents = given("documents")
    rows = [tuple(r) for r in documents.select("doc_id", "text", "source").collect()]
    key = lambda r: (r[0], r[1])
    same(sorted(mixed(documents, slots), key=key), sorted(plain_mix(rows, slots), key=key))


def test_promises_on_the_given_documents(spark):
    rows = queries.op7_mixing(spark, SF01).collect()
    taken, size_of, target = Counter(), {}, {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        key = r["source_size"], r["target"]
        taken[key] += r["taken"]
    for (size, goal), n in taken.items():
        assert abs(n - goal) <= 0.01 * goal + 5 and goal <= 3 * size
    assert sum(t for (_, t) in taken) == pytest.approx(sum(s for (s, _) in taken))
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.op7_mixing(spark, SF01).collect()))


def test_odd_tables(odd):
    rows = [tuple(r) for r in odd.select("doc_id", "text", "source").collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[4])
    same(sorted(mixed(odd), key=key), sorted(plain_mix(rows, mixing.SLOTS), key=key))
    assert mixed(odd.limit(0)) == []
    assert mixed(odd.where("text is null")) == [(3, 0, 0, 0.0, 0)]


def test_small_sources_of_a_large_corpus_come_near_their_targets(spark, monkeypatch):
    """A block of the large sources holds 247 words here, more than the smallest source has."""
    monkeypatch.setattr(mixing, "SHARE", 16, raising=False)
    size_of = {"a": 1000, "b": 3_000_000, "c": 40, "d": 5000, "e": 1_000_000, "f": 30_000}
    rows = [(1000 * k + i, "w " * (n // 20), s) for k, (s, n) in enumerate(size_of.items()) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken, target = Counter(), {}
    for r in mixing.mix(df, 1 << 14).collect():
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    names, want = goals(size_of)
    assert [target[s] for s in names] == pytest.approx([want[s] for s in names])
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] + 5 for s in names), (taken, want)


def test_plan_is_native(spark):
    plan = queries.op7_mixing(spark, SF01)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
