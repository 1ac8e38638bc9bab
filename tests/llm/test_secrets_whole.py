"""Secrets that are rare among candidates still train the forest."""

import random

from carelake.llm import secrets as S


def test_rare_labels_are_sampled(spark):
    rng = random.Random(3)
    key = lambda: "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(40))
    rows = [(i, f"order {rng.randrange(10**18, 10**19)} of the list") for i in range(1500)]
    rows += [(2000 + i, f'our token = "{key()}" here') for i in range(6)]
    found = S.candidates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    model = S.train(found, max_findings=40)
    assert model.forest is not None
    assert {r.doc_id for r in S.scan(found, model).where("is_secret").collect()} == set(range(2000, 2006))


def test_assigned_values_of_any_form(spark):
    texts = {
        'password = "Tr0ub4dor"': ["Tr0ub4dor"],
        "pwd: 'p@ss!w%rd & more'": ["p@ss!w%rd & more"],
        '{"api_key": "abc#1$2%3&4*5:6abc#1$2%3&4*5:6", "n": 1}': ["abc#1$2%3&4*5:6abc#1$2%3&4*5:6"],
        "DB_PASSWORD=qwertyuiopasdfgh.": ["qwertyuiopasdfgh"],
        "a secret => x;": ["x"],
        'token = "abcdefgh!ABCDEFGHIJKLMNOP1234"': ["abcdefgh!ABCDEFGHIJKLMNOP1234"],
        'token = "ABCDEFGHIJKLMNOP1234"': ["ABCDEFGHIJKLMNOP1234"],
        'password = ""': [], "no token here": [], "token == 1": [],
        '\U0001f600 secret = "\U0001f600' + "é!" * 30_000 + '"': ["\U0001f600" + "é!" * 30_000],
    }
    rows = list(enumerate(texts))
    got = {}
    for r in S.candidates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        assert rows[r.doc_id][1][r.start : r.stop] == r.value
        got.setdefault(r.doc_id, []).append(r.value)
    assert [got.get(i, []) for i, _ in rows] == list(texts.values())
