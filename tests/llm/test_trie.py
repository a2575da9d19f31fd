"""The burst trie against a dictionary of all beginnings."""

import hashlib
import zlib

import numpy as np
import pytest

from retail_layers.llm import queries, trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def n_words(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return len([w for w in text.split(" ") if w])


def brute_rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0), role, digest, text))
    own = {c: [(r, t) for _, r, _, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, held in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in members)]
        saved = sum((len(members[n]) - 1) * n_words(n[-1][1]) for n in below if n)
        ends = ",".join(str(c) for c in sorted(c for c in held if len(convs[c]) == len(node)))
        out.append((min(held), len(node), min(members[node[:-1]]) if node else None, len(held), len(children),
                    len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def made(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def branching(seed, n=60):
    """Conversations over few different turns, copies and beginnings of one another included."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        kind = rng.integers(0, 4)
        length = [3, 9, int(rng.integers(1, 6)), 6][kind]
        for t in range(length):
            word = "same" if kind == 1 or t < 2 and kind else f"{'abc'[rng.integers(0, 3)]} z"
            rows.append((int(c * rng.integers(1, 3)) if kind == 2 else c, t, "user" if t % 2 == 0 else "bot", word))
    return rows


@pytest.mark.parametrize(("burst", "seed"), [(1, 1), (7, 2), (30, 1), (20_000, 2)])
def test_nodes_at_any_container_size(spark, burst, seed):
    rows = branching(seed)
    convs = trie.rebuilt(trie.sequences(made(spark, rows)))
    want = brute(brute_rebuilt(rows))
    assert max(r[1] for r in want) >= 9
    assert got(trie.trie(convs, burst=burst, shard=20)) == want


def test_one_beginning_for_a_third_and_many_copies(spark):
    rows = [(c, t, "user", f"turn {t}" if c % 3 or t < 5 else f"turn {t} of {c}") for c in range(90) for t in range(7)]
    rows += [(1000 + c, t, "user", f"{c} {t}") for c in range(40) for t in range(3)]
    convs = trie.sequences(made(spark, rows))
    plain = {}
    for c, t, r, x in rows:
        plain.setdefault(c, []).append((r, x))
    assert got(trie.trie(convs, burst=10)) == brute(plain)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "belongs to nothing"), (0, 0, "user", "a b"), (0, None, None, None), (0, 1, "", ""), (0, 1, "", ""),
        (7, 2, "user", "tie"), (7, 2, "assistant", "tie"), (7, 2, "user", "other"), (-3, 0, "user", "negative"), (-20, 1, "x", "y z"),
        (21, 0, "user", "no first one"), (40, 0, "user", "word " * 50_000), (41, 0, "user", "one turn only"), (45, 0, "user", ""),
    ]
    clash = made(spark, rows).selectExpr("*", "'x' as seq", "1 as n", "'y' as key", "2 as depth", "3 as words", "0 as conv")
    assert got(trie.trie(trie.rebuilt(trie.sequences(clash)))) == brute(brute_rebuilt(rows))


def test_no_conversations(spark):
    assert got(trie.trie(trie.rebuilt(trie.sequences(made(spark, []))))) == []


def test_given_conversations(spark, given):
    rows = [tuple(r) for r in given("conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op13_trie(spark, "/root/testdata/sf0.001")) == brute(brute_rebuilt(rows))
