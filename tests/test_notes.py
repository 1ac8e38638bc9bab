"""Denial-note classification, JSON parsing, anomaly text."""

import pandas as pd

from carelake.plans import notes as N
from carelake.oracle import LABELLED_NOTES


def test_rules_match_hand_labels(spark):
    labelled = {t: (c, v) for t, c, v in LABELLED_NOTES}
    assert len(labelled) >= 60 and {c for c, _ in labelled.values()} == set(N.CATEGORIES)
    df = spark.createDataFrame([(t, t) for t in labelled] + [("n", None), ("e", "  ")], "claim_id string, note string")
    got = {r.claim_id: (r.category, r.confidence) for r in N.classify_denial_notes(df).collect()}
    assert got == labelled | {"n": ("OTHER", 0.0), "e": ("OTHER", 0.0)}


def test_custom_scorer(spark):
    df = spark.createDataFrame([("1", "anything")], "claim_id string, note string")

    def scorer(notes: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"category": ["OTHER"] * len(notes), "confidence": [0.42] * len(notes)})

    r = N.classify_denial_notes(df, scorer=scorer).first()
    assert (r.category, r.confidence) == ("OTHER", 0.42)


def test_parse_classifications(spark):
    bad = [
        None, "", '[{"note": "trunc', '{"error":"rate limited"}', "[null]", "3", '[{"note":"x","category":"BANANA","confidence":0.7}]',
        '[{"note":"x","category":"OTHER","confidence":7}]', '[{"note":"x","category":"OTHER","confidence":"high"}]',
        '[{"category":"OTHER","confidence":0.5}]', '[{"note":null,"category":"OTHER","confidence":0.5}]',
        '[{"note":"y","category":"OTHER","confidence":0.5}, 1]',
    ]
    rows = [
        ("a", '[{"note":"x","category":"CODING_ERROR","confidence":0.9},{"note":"y","category":"OTHER","confidence":0, "more": 1}]'),
        ("b", " [] "),
        *[(f"c{i}", t) for i, t in enumerate(bad)],
    ]
    df = spark.createDataFrame(rows, "reply_id string, response string")
    got = sorted((tuple(r) for r in N.parse_classifications(df, id_col="reply_id").collect()), key=str)
    want = [("a", "ok", None, "x", "CODING_ERROR", 0.9), ("a", "ok", None, "y", "OTHER", 0.0), ("b", "empty", None, None, None, None)]
    assert got == sorted([*want, *[(f"c{i}", "malformed", t, None, None, None) for i, t in enumerate(bad)]], key=str)


def test_summary_text(spark, data_path):
    from carelake.sources.files import read_claims_csv

    r = N.executive_summary_text(read_claims_csv(spark, data_path("claims_fixture.csv"))).first()
    assert r.denial_attention is True and r.anomaly_attention is True
    assert r.summary_text.startswith("15 claims processed: 11 paid, 2 denied (13.33% denial rate).")
    assert "Paid $24,620.00 of $35,525.00 billed." in r.summary_text
