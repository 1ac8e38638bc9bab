"""Secret scans: candidates against Python's pattern, held-out accuracy on planted secrets, odd inputs."""

import random
import re

from carelake.llm import secrets as S


def plain(text):
    return [(m.start(), m.end(), m[0]) for m in re.finditer(r"[A-Za-z0-9+/_=.~-]{16,}", text or "") if re.search("[0-9]|[a-z][A-Z]", m[0])]


def test_candidates(spark, small_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    rows += [(-1, None), (-2, ""), (-3, "\U0001f600 " + "a1" * 40_000 + "é" + "x" * 15 + " " + "camelCaseNameOfThing")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("value", S.F.lit("clash"))
    got = {}
    for r in S.candidates(df).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.stop, r.value))
    assert got == {i: plain(t) for i, t in rows if plain(t)}


def test_accuracy_on_reviewed_findings(spark):
    """Reviewed findings train the forest; others of the same kinds are told apart."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice(["lan", "mor", "tis", "ven", "pra", "do"]) for _ in range(rng.randrange(2, 5)))
    key = lambda: "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(rng.randrange(24, 44)))

    def secret():
        return f'{word()} {rng.choice(["password", "api_key", "token", "client"])} {rng.choice(["= ", ": ", "is "])}"{key()}" {word()}'

    def harmless():
        return rng.choice([f"{word()} {word()}{rng.randrange(99)}-{word()}-{word()}_{word()} {word()}", f"see /usr/{word()}/{word()}{rng.randrange(9)}/{word()}.txt {word()}", f"order {rng.randrange(10**18, 10**19)} {word()}", f"mail {word()}@{word()}{rng.randrange(9)}.{word()}.example.com {word()}", f"{word()}{word().title()}{word().title()}{word().title()}Of {word()}"])

    rows = [(i, secret() if i % 3 == 0 else harmless()) for i in range(900)]
    truth = dict(rows)
    label = {v: float("example.com" not in t and i % 3 == 0) for i, t in truth.items() for _, _, v in plain(t)}
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    reviewed = spark.createDataFrame(list(label.items()), "value string, label double")
    found = S.candidates(df)
    model = S.train(found.where("doc_id < 600"), labelled=lambda rows: rows.join(reviewed, "value"))
    out = S.scan(found.where("doc_id >= 600"), model).collect()
    right = sum(r.is_secret == (label[r.value] > 0) for r in out) / len(out)
    assert len(out) > 250 and right >= 0.97


def test_corpus(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = S.op1_secrets(spark, sf).collect()
    assert len(rows) == sum(len(plain(t)) for t in docs.values())
    for r in rows:
        assigned = docs[r.doc_id][: r.start].lower().endswith('token = "')
        assert r.is_secret == assigned and 0 <= r.score <= 1


def test_odd_training(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    found = S.candidates(empty)
    assert S.scan(found, S.train(found)).count() == 0
    one = S.candidates(spark.createDataFrame([(1, "1" * 20), (1, "1" * 20)], "doc_id bigint, text string"))
    assert [r.score for r in S.scan(one, S.train(one)).collect()] == [0.0, 0.0]
