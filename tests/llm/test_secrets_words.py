"""Neighbour words take part where the rules label: all but the credentials' names, by which the rules go."""

import random

from carelake.llm import secrets as S


def test_seeded_forest_hears_other_words(spark):
    """Values that look alike, decided by their neighbours: names of credentials are not heard, other words are."""
    rng = random.Random(5)
    key = lambda: "".join(rng.choice("abcdefghijkmnopqrstuvwxyz23456789") for _ in range(32)) + "7"
    rows = []
    for i in range(900):
        good = i % 2 == 0
        rows.append((i, f'staging vault token = "{key()}" rotated' if good else f"ledger mail @{key()} archived"))
    rows += [(1000 + i, f"staging vault {key()} rotated") for i in range(50)] + [(2000 + i, f"ledger mail {key()} archived") for i in range(50)]
    found = S.candidates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    model = S.train(found)
    assert {*S.NEAR} <= {*model.features} and not {*S.CONTEXT} & {*model.features}
    score = {r.doc_id: r.score for r in S.scan(found, model).collect()}
    assert min(score[1000 + i] for i in range(50)) > 0.5 > max(score[2000 + i] for i in range(50))


def test_names_of_credentials_are_not_heard(spark):
    row = spark.createDataFrame([("my api_key and the tokens of passwords here", "my and the of here")], "a string, b string")
    r = row.select(S.neighbours(S.F.col("a"), named=False).alias("a"), S.neighbours(S.F.col("b")).alias("b"), S.neighbours(S.F.col("a")).alias("c")).first()
    assert r.a == r.b and len(r.c) > len(r.a)
