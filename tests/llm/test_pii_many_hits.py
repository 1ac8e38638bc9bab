"""Texts with very many hits, and overlapping marks against plain versions."""

import random
import re
import time

from carelake.llm import pii as P

F = P.F


def test_ten_megabytes_with_many_hits(spark):
    rng = random.Random(9)
    filler = " ".join("lorem ipsum dolor sit amet".split() * 3)
    text = " ".join(f"{filler} user{rng.randrange(10**6)}@x{i % 7}.org" for i in range(100_000))
    assert len(text) > 9_000_000
    df = spark.createDataFrame([(1, text), (2, "nothing here")], "doc_id bigint, text string")
    begun = time.monotonic()
    got = {r.doc_id: r for r in P.find_private(df).collect()}
    took = time.monotonic() - begun
    want = [("email", m.start(), m.end(), m[0]) for m in re.finditer(r"user\d+@x\d\.org", text)]
    assert [tuple(s) for s in got[1].base] == want and got[2].sanitised is None
    assert got[1].sanitised == re.sub(r"user\d+@x\d\.org", "[EMAIL]", text)
    assert took < 120


def plain_rewrite(text, marks):
    out, at = [], 0
    for start, stop, put in sorted(marks):
        if start >= at:
            out += [text[at:start], put]
        at = max(at, stop)
    return "".join(out) + text[at:]


def test_marks_against_plain(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        text = "".join(rng.choice("aé\U0001f600b ") for _ in range(rng.choice([0, 5, 400])))
        span = lambda most: (lambda a: (a, min(len(text), a + rng.randrange(1, most))))(rng.randrange(max(1, len(text))))
        spans = lambda n, most: sorted({span(most) for _ in range(n)}) if text else []
        n = rng.choice([0, 1, 90])
        rows.append((i, text, spans(n, 6), [(*s, "w", False) for s in spans(n, 9)]))
    df = spark.createDataFrame(rows, "i int, text string, base array<struct<start:int,stop:int>>, own " + P.PLACE)
    base = F.transform("base", lambda s: F.struct(F.lit("k").alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), F.lit("v").alias("value")))
    marks = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.concat(F.lit("<"), s["start"].cast("string"), F.lit(">")).alias("put")))
    out = df.select("i", P.clear_of(F.col("own"), base).alias("free"), P.rewritten(F.col("text"), marks).alias("new")).collect()
    for r in out:
        _, text, fixed, own = rows[r.i]
        assert [tuple(x) for x in r.free] == [o for o in own if not any(a < o[1] and o[0] < b for a, b in fixed)]
        assert r.new == plain_rewrite(text, [(a, b, f"<{a}>") for a, b in fixed])


def test_due_words(spark):
    text = "Anna met BEN, anna; ben2 Ünal_x " * 40
    due, gone = ["anna", "ünal", "never"], ["ünal"]
    row = spark.createDataFrame([(text, due, gone)], "t string, due array<string>, gone array<string>").select(P.places(F.col("t"), F.col("due"), F.col("gone")).alias("p")).first()
    want = [(m.start(), m.end(), m[0], m[0].lower() in gone) for m in re.finditer(r"[^\W\d_]+", text) if m[0].lower() in due]
    assert [tuple(x) for x in row.p] == want
