"""The dictionary of all texts, learned neighbour words, and precision and recall on forms that no rule labels."""

import random
from collections import Counter

from carelake.llm import secrets as S


def test_dictionary_counts_all_texts(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abCD é1\n") for _ in range(rng.randrange(60))) for _ in range(300)] + [None, "", "ab"]
    want = Counter(t[i : i + 3].lower() for t in texts if t for i in range(len(t) - 2) if all("a" <= c <= "z" for c in t[i : i + 3].lower()))
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = S.dictionary_of(df, share=0.02)
    triple = lambda i: "".join(chr(97 + i // 26**k % 26) for k in (2, 1, 0))
    assert {triple(i) for i, b in enumerate(got) if b} == {t for t, n in want.items() if n >= max(2, 0.02 * want.total())}
    shares = df.where("length(text) > 2").select("text", S.ordinary_share(S.F.col("text"), got).alias("s")).collect()
    for r in shares:
        own = {r.text[i : i + 3].lower() for i in range(len(r.text) - 2)}
        own = {t for t in own if all("a" <= c <= "z" for c in t)}
        assert r.s == sum(want[t] >= max(2, 0.02 * want.total()) for t in own) / max(1, len(own))


def test_neighbour_words_are_learned(spark):
    """The values look alike; only words that stand in no list tell them apart."""
    rng = random.Random(8)
    key = lambda: "".join(rng.choice("abcdefghijkmnopqrstuvwxyz23456789") for _ in range(32)) + "7"
    noise = lambda: " ".join(rng.choice(["lan", "mor", "tis", "ven", "pra", "dolu"]) for _ in range(3))
    rows, truth = [], {}
    for i in range(1200):
        good = rng.random() < 0.3
        value = key()
        truth[value] = float(good)
        word = rng.choice(["losung", "schluessel", "kennwort"] if good else ["pruefsumme", "kennung", "abdruck"])
        rows.append((i, f"{noise()} {word} {value} {noise()}"))
    found = S.candidates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    reviewed = spark.createDataFrame(list(truth.items()), "value string, label double")
    model = S.train(found.where("doc_id < 800"), labelled=lambda rows: rows.join(reviewed, "value"))
    out = S.scan(found.where("doc_id >= 800"), model).collect()
    hit = sum(r.is_secret and truth[r.value] > 0 for r in out)
    precision, recall = hit / max(1, sum(r.is_secret for r in out)), hit / sum(truth[r.value] > 0 for r in out)
    print(f"precision {precision:.3f} recall {recall:.3f} of {len(out)}")
    assert len(out) == 400 and precision >= 0.95 and recall >= 0.95


def test_precision_and_recall_without_reviewers(spark):
    """The rules label quoted assignments only; keys in headers, links and letters-only ones are told by what was learned."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice(["lan", "mor", "tis", "ven", "pra", "do"]) for _ in range(rng.randrange(2, 5)))
    key = lambda: "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(rng.randrange(24, 44)))
    rows, truth, sure = [], {}, 1500
    for i in range(sure + 600):
        if i < sure:
            text = rng.choice([f'the {word()} token = "{key()}" {word()}', f"see /usr/{word()}/{word()}9/{word()}.txt for {word()}", f"order {rng.randrange(10**18, 10**19)} of {word()}", f"{word()}-{word()}-{word()}-{word()}2 {word()}"])
        else:
            secret = i % 2 == 0
            value = key() if secret else rng.choice([f"{word()}_{word()}_{word()}_{word()}{rng.randrange(9)}", f"{word()}{word().title()}{word().title()}{word().title()}Of", f"{rng.randrange(10**9)}-{rng.randrange(10**9)}"])
            truth[i] = secret
            text = rng.choice([f"Authorization: Bearer {value} then {word()}", f"https {word()} key={value} {word()}", f"token is {value} {word()}"])
        rows.append((i, text))
    found = S.candidates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    out = [r for r in S.scan(found, S.train(found)).collect() if r.doc_id >= sure]
    hit = sum(r.is_secret and truth[r.doc_id] for r in out)
    precision, recall = hit / max(1, sum(r.is_secret for r in out)), hit / sum(truth[r.doc_id] for r in out)
    print(f"precision {precision:.3f} recall {recall:.3f} of {len(out)}")
    assert len(out) >= 500 and precision >= 0.9 and recall >= 0.9
