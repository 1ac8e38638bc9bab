"""Disclosing terms over whole texts: far from the value, in copies, in documents without the entity, logs of many addresses."""

import test_pii

from carelake.llm import pii as P


def rows_():
    """Terms far from the value; an entity in one document, in two, in many, and in copies of one passage."""
    far = lambda i: " ".join(f"plain{'abcdefgh'[(i + j) % 8] * 4}" for j in range(60))
    rows = [(i, far(i)) for i in range(400)]
    rows[5] = (5, f"uniqueword {far(5)} one@rare.org")
    for i in range(6, 13):
        rows[i] = (i, f"10.1.2.3 {far(i)} sevenword {far(i + 3)} number{'abcdefghijklm'[i]}")
    rows += [(1000 + i, f"copiedword {far(1)} many@copies.org {far(2)}") for i in range(30)]
    return rows + [(None, None), (2000, ""), (2001, "no address, a Sevenword")]


def test_whole_texts_and_evidence(spark):
    rows = rows_()
    told = test_pii.told_by(rows)
    assert set(told) == {"sevenword"}  # one document, or copies of one, are no evidence; plain words are everywhere
    got = P.find_private(spark.createDataFrame(rows, "doc_id bigint, text string"), carry=("text",)).collect()
    test_pii.check_found(got, rows, told)
    assert {r.doc_id: r.sanitised for r in got}[2001] == "no address, a [NAME]"


def test_logs_of_many_addresses_are_one_class(spark):
    log = " ".join(f"10.{i // 250}.{i % 250}.7 host{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(2000))
    rows = [(i, f"log {log} day{'abcd'[i]}") for i in range(4)] + [(10 + i, f"words {'abcdefghij'[i % 10] * 4}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = df.select("text", P.F.concat(*[P.spans_of(P.F.col("text"), k) for k in P.KINDS]).alias("base"))
    of_term = df.select(P.F.explode(P.terms_in(P.F.col("text"))).alias("term")).select(P.F.xxhash64("term").alias("t")).groupBy("t").agg(P.F.count("*").alias("of_term"))
    pairs, classes = P.judged_pairs(found, of_term, 3)
    assert pairs.count() == 1 and classes.count() > 600  # 2,000 addresses and 677 words, one pair of classes
    got = P.find_private(df, carry=("text",)).collect()
    assert len(got) == 304 and all("[WORD]" in r.sanitised and "host" not in r.sanitised for r in got if r.doc_id < 4)
