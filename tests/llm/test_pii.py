"""Base spans against Python's patterns, disclosing terms against a plain count, odd texts."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from carelake.llm import pii as P

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def plain(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end(), m[0]))
    return out


def texts():
    rng = random.Random(5)
    good = "4539578763621486"
    out = [
        None, "", "a@b", "a@b.c_d@e.f x", "x.@.a@b-.c..d", "a@b@c.d", "é\U0001f600 joe@x.org,\U0001f600 1.2.3.4", "1.2.3.4.5 256.1.1.1 0001.2.3.255 1.2.3", f"{good} {good[:4]} {good[4:8]}-{good[8:12]} {good[12:]}",
        f"x{good}9 4539 5787 6362 1487", "+1 (555) 123-4567. +12 +1234567 +1 234 567 8 +1-2--3.4(5)6 7 8 9 0 1 2 3 4 5 6", "1" * 30_000, "a." * 20_000 + "@b.c", "1." * 20_000, "q" * 60_000, "+1" + " 2" * 20_000, "a@" + "b." * 20_000 + "c", "7 " * 20_000,
    ]
    for _ in range(400):
        out.append("".join(rng.choice(["a", "b.c", "@", ".", "+", "1", "23", " ", "-", "(", ")", "%", "é", good, "255", "+4 ", "@x.y", "\n"]) for _ in range(rng.randrange(40))))
    return out


def test_base_spans(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("spans", P.F.lit(1))
    got = {r.doc_id: [tuple(s) for s in r.base] for r in P.find_private(df).collect()}
    for i, t in rows:
        assert got[i] == plain(t), repr((t or "")[:100])


def words(text):
    return {w for w in re.findall(r"[^\W\d_]+", (text or "").lower()) if len(w) >= 3}


def told_by(rows, generalise=1.0, remove=0.25, support=2):
    """term -> removed, by plain counts of every pair; and the pairs judged, classes of equal documents once."""
    n, of_term, of_entity, of_text = len(rows), Counter(), Counter(), Counter(t or "" for _, t in rows)
    holds = {t: {(k, v.lower()) for k, _, _, v in plain(t)} for t in of_text}
    where, has = defaultdict(set), defaultdict(set)
    for t, m in of_text.items():
        for w in words(t):
            of_term[w] += m
            has[w].add(t)
        for e in holds[t]:
            of_entity[e] += m
            where[e].add(t)
    bar = 2**-generalise
    least = max(support, math.ceil(P.Z**2 * bar / (1 - bar)))
    many = {e: frozenset(d) for e, d in where.items() if len(d) >= least}
    inside = set().union(*many.values()) if many else set()
    terms = {w: frozenset(d & inside) for w, d in has.items() if len(d & inside) >= least}
    pairs = {(e, w) for e, d in many.items() for w, x in terms.items() if len(d & x) >= least}
    judged = len({(many[e], terms[w], of_term[w]) for e, w in pairs})
    told = {}
    for e, w in pairs:
        both = where[e] & has[w]
        p = sum(of_text[t] for t in both) / of_term[w]
        seen, z2, q = len(both) / p, P.Z * P.Z, of_entity[e] / n
        share = (p + z2 / (2 * seen) - P.Z * math.sqrt(p * (1 - p) / seen + z2 / (4 * seen * seen))) / (1 + z2 / seen)
        apart = seen * (p * math.log(p / q) + ((1 - p) * math.log((1 - p) / (1 - q)) if p < 1 else 0)) if p > q else 0
        if -math.log2(share) <= generalise and apart >= math.log(judged / 0.05):
            told[w] = told.get(w, False) or -math.log2(share) <= remove
    return told


def put(word, removed):
    return "" if removed else "[CAPS]" if word.isupper() else "[NAME]" if word[0].isupper() else "[WORD]"


def check_found(got, rows, told):
    text = Counter((i, t) for i, t in rows)
    assert Counter((r.doc_id, r.text) for r in got) == text
    for r in got:
        base = plain(r.text)
        more = [("term", m.start(), m.end(), m[0]) for m in re.finditer(r"[^\W\d_]+", r.text or "") if m[0].lower() in told and not any(a < m.end() and m.start() < b for _, a, b, _ in base)]
        assert [tuple(s) for s in r.spans] == base + more
        out, at = "", 0
        for k, a, b, v in sorted(base + more, key=lambda s: (s[1], s[2])):
            if a >= at:
                out += r.text[at:a] + (put(v, told[v.lower()]) if k == "term" else f"[{k.upper()}]")
            at = max(at, b)
        assert r.sanitised == (out + r.text[at:] if base + more else None)


def test_disclosing_terms(spark):
    rng = random.Random(1)
    vocab = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ("lan", "mor", "tis", "ven")]
    rows = []
    for i in range(600):
        w = [rng.choice(vocab) for _ in range(rng.randrange(30, 60))]
        if i % 30 == 3:
            w[10:10] = ["Zorblatt", "ann@secret.org", rng.choice(vocab), "QUUXLY"]
        if i in (7, 8):
            w[5:5] = ["zorblatt"]  # no entity here: found all the same
        if i % 60 == 1:
            w[3:3] = ["10.0.0.1", "rarely"]
        if i % 150 == 5:
            w[3:3] = ["10.0.0.%d" % i, "onlyonce%s" % "abcdefgh"[i // 150]]  # one document: no evidence
        if i % 4 == 2:
            w[3:3] = ["1.1.1.1", "everywhere"]
        rows.append((i, " ".join(w)))
    rows += [rows[3]] * 5 + [(9000 + i, "copied passage bob@copies.org") for i in range(40)] + [(None, None), (1000, "")]
    told = told_by(rows)
    assert told["quuxly"] and told["zorblatt"] is False and "rarely" in told and "everywhere" in told
    assert not {"copied", "passage", *vocab} & set(told) and not any(w.startswith("onlyonce") for w in told)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    check_found(P.find_private(df, carry=("text",)).collect(), rows, told)


def test_the_bar_does_not_move_with_the_corpus(spark):
    near = [(i, f"Zorblatt lives here {'abcdefgh'[i]}xyz ann@secret.org") for i in range(4)]
    fill = lambda n: [(100 + i, f"other words {'abcdefghij'[i % 10] * 5} again") for i in range(n)]
    for n in (300, 6000):
        rows = near + fill(n)
        told = told_by(rows)
        assert {"zorblatt", "lives"} <= set(told) and "again" not in told
        check_found(P.find_private(spark.createDataFrame(rows, "doc_id bigint, text string"), carry=("text",)).collect(), rows, told)


def test_corpus_and_plan(spark, small_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    df = P.op7_pii(spark, small_dir)
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().toString())
    rows = df.collect()
    assert len(rows) == len(docs) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 0
    for r in rows:
        base = plain(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, *_ in base) for x in PATTERNS]
        said = ",".join(f"{k}:{a}:{b}" for k, a, b, _ in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest() and r.spans.startswith(said)
    assert P.op7_pii(spark, small_dir).where("doc_id < 0").count() == 0
    assert P.find_private(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
