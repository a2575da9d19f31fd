"""Quality, decontamination and secrets against plain versions of the same rules."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from retail_layers.llm import decontaminate, quality, queries, secrets
from retail_layers.llm.common import held_out

SF01 = "/root/testdata/sf0.01"


# quality ---------------------------------------------------------------------------------

def test_quality_is_learned_outside_the_held_out_fold(spark, given):
    rows = queries.op5_quality(spark, SF01).join(given("labels", SF01), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r["held_out"]]
    right = sum(r["predicted"] == r["quality"] for r in out) / len(out)
    good = [r for r in out if r["quality"] == 1]
    assert right > 0.9 and sum(r["predicted"] for r in good) / len(good) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)


def test_quality_ignores_held_out_labels(spark, given):
    documents, labels = given("documents"), given("labels")
    flipped = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.train(documents, x) for x in (labels, flipped))
    assert all(np.array_equal(x, y) for x, y in zip(a.tables, b.tables))


def test_quality_bounds_its_sample_and_bears_odd_tables(spark, odd, given):
    labels = given("labels")
    assert len(quality.training_rows(given("documents"), labels, max_rows=10)) == 10
    some = spark.createDataFrame([(1, 1), (6, 0), (7, 0), (8, 1), (1, 0), (None, 1), (4, None)], "doc_id bigint, quality int")
    for x in (some, some.limit(0)):
        model = quality.train(odd, x)
        got = odd.select(quality.score(F.col("text"), model).alias("s")).collect()
        assert len(got) == odd.count() and all(0 <= r["s"] <= 1 for r in got)
    assert odd.limit(0).select(quality.score(F.col("text"), model)).count() == 0


def test_additive_model_adds_tables_and_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = np.zeros((4000, len(quality.FEATURES)))
    x[:, :3] = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    at = model.bins(x[:1])[0]
    total = model.base + sum(t[k] for t, k in zip(model.tables, at)) + sum(t[at[a], at[b]] for a, b, t in model.pairs)
    assert model.score(x[:1])[0] == pytest.approx(1 / (1 + np.exp(-total)))


# decontamination -------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_marks(documents, items, length=10):
    windows = {}
    for name, text in items:
        ws = split(text)
        n = min(length, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[i:i + n]), set()).add(None if name is None else str(name))
    sizes = {len(w) for w in windows}
    out = []
    for name, text in documents:
        ws, hit, found = split(text), set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                names = windows.get(tuple(ws[i:i + n]))
                if names is not None:
                    hit |= set(range(i, i + n))
                    found |= names
        found.discard(None)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((name, len(ws), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def test_decontamination_equals_a_plain_search(spark, given):
    got = [tuple(r) for r in queries.op10_decontamination(spark, SF01).collect()]
    docs = given("documents", SF01).select("doc_id", "text").collect()
    assert sorted(got, key=str) == plain_marks(docs, given("benchmark", SF01).select("item_id", "text").collect())
    assert any(r[5] for r in got)


ITEMS = [(10, "three FOUR five, six seven eight nine ten eleven twelve thirteen"), (2, "x"), (3, None), (4, "!!"),
         (10, "seven eight"), (None, "one two"), (9, "two three two three two"), (8, "three two three two")]


@pytest.mark.parametrize("shard_words", [1, 12, 1000])
def test_decontamination_of_odd_tables_in_any_shards(spark, odd, shard_words):
    more = spark.createDataFrame([(20, "two three two three two three two x Three-four"), (21, "two three two")],
                                 "doc_id bigint, text string")
    documents = odd.select("doc_id", "text").union(more)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = decontaminate.mark(documents, items, "_m", shard_words=shard_words).select(
        "doc_id", "_m.n_words", "_m.n_hit", F.size("_m.items"), F.sha2(F.array_join("_m.items", ","), 256), F.col("_m.n_hit") > 0)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_marks(documents.collect(), ITEMS)


def test_decontaminated_documents_lose_hit_words_only(spark, odd):
    items = spark.createDataFrame([(1, "three four five six")], "item_id bigint, text string")
    kept = decontaminate.decontaminate(odd, items, max_share=0.5)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    row = kept.where("doc_id = 2").first()
    assert row["text"].split() == "ONE two seven eight nine ten eleven twelve".split() and row["n_chars"] == len(row["text"])
    assert decontaminate.decontaminate(odd, items, max_share=0.1).count() == odd.count() - 4
    assert decontaminate.decontaminate(odd, items.limit(0)).count() == odd.count()


# secrets ---------------------------------------------------------------------------------

ANY = "".join  # keywords in either case, beyond which nothing folds


def either(word):
    return ANY(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile("(" + "|".join(map(either, ("password", "passwd", "secret", "token"))) + "|" + either("api") + "_?"
                    + either("key") + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
PLAIN = [(ASSIGN, lambda m: len(m[2]) >= 8), (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
         (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
         (re.compile("-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"), lambda m: True),
         (re.compile("xox[abprs]-[A-Za-z0-9-]{10,}"), lambda m: True)]


def plain_spans(text):
    found = [(k, m.start(), m.end()) for k, (rule, ok) in enumerate(PLAIN) for m in rule.finditer(text or "") if ok(m)]
    return sorted(found, key=lambda x: (x[1], x[0]))


PARTS = ["password", "PassWd", "token", "secret", "api_key", "apikey", '"', "'", " ", "  ", "=", ":", "==", "abcdef12",
         "deadbeef" * 4, "AKIA", "AKIAABCDEFGHIJKL12", "é", "ſ", "\n", "x", "A" * 20, "0123456789abcdef",
         "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "xoxb-", "xoxb-123-", "-", "_", "\0"]


def test_secrets_equal_regular_expressions_on_made_up_texts(monkeypatch):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(PARTS, rng.integers(0, 60))) for _ in range(4000)]
    texts += ["a" * 70_000 + "é" + "f" * 100 + "token=abcdefghij", None, ""]
    dfa = secrets.build()
    for piece in (997, 1 << 22):
        monkeypatch.setattr(secrets, "PIECE", piece)
        assert secrets.scan(texts, dfa) == [plain_spans(t) for t in texts]


def test_automaton_is_minimal_on_a_known_rule():
    dfa = secrets.build((secrets.Rule("a", "ab(c|d)"),))
    assert dfa.n_states == 4 and dfa.n_classes == 6  # border, a, b, c, d, any other


def test_secrets_of_the_given_documents(spark, given):
    texts = {r["doc_id"]: r["text"] for r in given("documents", SF01).collect()}
    rows = queries.op8_secrets(spark, SF01).collect()
    assert len(rows) == len(texts) and sum(r["n_assign"] + r["n_access"] + r["n_hex"] for r in rows) > 0
    for r in rows:
        spans = plain_spans(texts[r["doc_id"]])
        base = secrets.listed([x for x in spans if x[0] < 3])
        assert (r["spans"], r["base_sha256"]) == (secrets.listed(spans), hashlib.sha256(base.encode()).hexdigest())
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x[0] == k for x in spans) for k in range(3)]


def test_secrets_of_odd_tables(spark, odd):
    got = odd.select("doc_id", secrets.find(F.col("text")).alias("f"), secrets.redact(F.col("text")).alias("t")).collect()
    assert len(got) == odd.count()
    row = next(r for r in got if r["doc_id"] == 8)
    assert row["f"]["n_assign"] == row["f"]["n_access"] == row["f"]["n_hex"] == 1
    assert row["t"] == "lé ß 你好 \U0001f600 [assign] [access] [hex]"
    assert next(r for r in got if r["doc_id"] == 3)["t"] is None
    assert odd.limit(0).select(secrets.find(F.col("text"))).count() == 0
