"""Secret scans: candidate strings, and a random forest that removes false positives.

A candidate is a run of 16 or more letters, digits and + / _ = . ~ - with a
digit in it or a capital after a small letter; or a value of any length and
characters assigned to a credential's name: what stands in quotes on its line,
or without quotes all up to a space, less closing marks at its end. A value
inside such a run is part of it, a run inside a value part of the value. The
forest (Spark ML) sees its
length, shares of character classes, transitions between classes, entropy,
dictionary coverage (share of its letter triples that are ordinary), path marks
and its neighbouring words. It is trained from labelled
findings: a table of ``measured`` candidates with a label. Without reviewers'
labels ``seed_labels`` gives sure ones only: a quoted value assigned to a
credential's name is a secret unless made of ordinary triples; bare numbers, host names behind an @, paths and
strings made of ordinary triples are none; the rest stays unlabelled and is
what the forest decides. It then sees the values and the words near them, but
not the context by which the rules call them secrets (``CONTEXT``, and the
credentials' names among the words), so it finds such values in other contexts too.

All distinct candidates are labelled; training takes at most ``max_findings`` of
the labelled ones in hash order, half of them from each label (more of one if
the other has fewer), weighted so that the labels keep their shares. Scanning
covers all text.

The dictionary is counted over the words of all texts given: every letter triple
that makes up at least ``ORDINARY`` of all triples (there are 26^3 at most). What
neighbouring words say is learned from the labelled findings: each word, hashed to
one of ``BUCKETS``, weighs the logarithm of how much likelier it stands near a
secret than near another finding. A training row is measured with the weights of
the other half of the findings, so that it doesn't see its own label.

Cases: a null or empty text has no candidates; a candidate of any length is
taken whole; equal rows give equal findings each; findings of one label only
give that label's share as every score, no findings 0; an empty table gives an
empty result; only doc_id and text are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import ensure_checkpoint_dir, read_table, stage, text_slices
from carelake.llm.pii import SPAN, Kind, spans_of
from carelake.llm.words import join_texts

CANDIDATE = Kind("secret", r"[A-Za-z0-9+/_=.~-]{16,}+", lambda t: t.rlike(r"[A-Za-z0-9+/_=.~-]{16}"), lambda m: m.rlike("[0-9]|[a-z][A-Z]"))
NAMES = r"token|secret|passw(?:or)?d|pwd|credential|api[_-]?key|access[_-]?key|private[_-]?key"
HEAD = rf"(?i:{NAMES})[A-Za-z0-9_-]*+[\"']?\s*+(?:=>|:=|[:=](?!=))\s*+"
ASSIGNED = Kind("assigned", HEAD + r"""(?:"(?!")[^\r\n]+?(?<!\\)"|'(?!')[^\r\n]+?(?<!\\)'|[^\s"']\S*+)""", lambda t: t.rlike(f"(?i)(?:{NAMES})"), lambda m: F.lit(True))
REACH = 40
WORDS = r"\p{L}{2,}"
FEATURES = ("length", "digit", "upper", "lower", "other", "changes", "entropy", "longest_letters", "hex", "coverage", "slashes", "dots", "path", "assigned", "quoted", "behind_at", "words_near")
#: What neighbouring words say: the nearest before, all before, all after.
NEAR = ("near", "words_before", "words_after")
#: What ``seed_labels`` calls a secret by; a forest seeded from it doesn't see these, or it would learn the rules back.
CONTEXT = ("assigned", "quoted", "words_near")
#: Share of all letter triples that an ordinary one makes up; hashed words that have a weight.
ORDINARY, BUCKETS = 1e-5, 4096
_LETTER = np.full(256, -1, np.int16)
_LETTER[65:91] = _LETTER[97:123] = np.arange(26)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, start, stop, value, before, after: one row per candidate, positions in code points."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("_text"))
    rows = rows.select("doc_id", "_text", spans_of(F.col("_text"), CANDIDATE).alias("runs"), assigned_in(F.col("_text")).alias("assigned"))
    within = lambda a, b: (b["start"] <= a["start"]) & (a["stop"] <= b["stop"])
    rows = rows.withColumn("assigned", F.filter("assigned", lambda a: (a["start"] < a["stop"]) & ~F.exists("runs", lambda r: within(a, r))))
    rows = rows.select("doc_id", "_text", F.explode(F.concat(F.filter("runs", lambda r: ~F.exists("assigned", lambda a: within(r, a))), "assigned")).alias("s"))
    start = F.col("s.start")
    before = F.substring(F.col("_text"), F.greatest(F.lit(1), start + 1 - REACH), F.least(F.lit(REACH), start))
    return rows.select("doc_id", start.alias("start"), F.col("s.stop").alias("stop"), F.col("s.value").alias("value"), before.alias("before"), F.substring(F.col("_text"), F.col("s.stop") + 1, F.lit(REACH)).alias("after"))


def assigned_in(text: Column) -> Column:
    """Spans of the values assigned to credentials' names."""

    def value(s: Column) -> Column:
        head = F.regexp_extract(s["value"], f"^{HEAD}[\"']?", 0)
        rest = F.substring(s["value"], F.length(head) + 1, F.length(s["value"]))
        own = F.when(head.rlike("[\"']$"), F.substring(rest, F.lit(1), F.length(rest) - 1)).otherwise(F.regexp_replace(rest, r"""[.,;)\]}"']+$""", ""))
        start = s["start"] + F.length(head)
        return F.struct(s["kind"].alias("kind"), start.alias("start"), (start + F.length(own)).alias("stop"), own.alias("value"))

    return F.transform(spans_of(text, ASSIGNED), value).cast(SPAN)


def triples(value: Column) -> Column:
    """Distinct letter triples, small letters."""
    small = F.lower(value)
    at = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(value) - 2))
    return F.array_distinct(F.filter(F.transform(at, lambda i: F.substring(small, i, F.lit(3))), lambda t: t.rlike("^[a-z]{3}$")))


def triple_counts(texts: list[str]) -> np.ndarray:
    """How often every letter triple occurs, small and capital letters alike."""
    buf, _ = join_texts(texts)
    code = _LETTER[buf]
    if len(code) < 3:
        return np.zeros(26**3, np.int64)
    one, two, three = code[:-2], code[1:-1], code[2:]
    whole = (one >= 0) & (two >= 0) & (three >= 0)
    return np.bincount((one[whole].astype(np.int64) * 26 + two[whole]) * 26 + three[whole], minlength=26**3)


def dictionary_of(texts: DataFrame, share: float = ORDINARY) -> bytes:
    """A byte for each of the 26^3 triples, 1 for ordinary ones. ``texts``: their column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(26**3, np.int64)
        for batch in batches:
            for _, part in text_slices(batch, "_text"):
                total += triple_counts(part)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["triple", "n"])

    counts = texts.select(F.col("text").alias("_text")).mapInArrow(run, "triple bigint, n bigint").groupBy("triple").agg(F.sum("n").alias("n"))
    rows = counts.collect()  # 26^3 at most
    least = max(2.0, share * sum(r.n for r in rows))
    known = np.zeros(26**3, np.uint8)
    known[[r.triple for r in rows if r.n >= least]] = 1
    return known.tobytes()


def ordinary_share(value: Column, dictionary: bytes) -> Column:
    """Share of a value's distinct triples that are ordinary."""
    place = lambda t: sum(((F.ascii(F.substring(t, i + 1, 1)) - 97) * 26 ** (2 - i) for i in range(3)), F.lit(1))
    known = F.lit(bytearray(dictionary))
    ordinary = lambda t: F.substring(known, place(t), F.lit(1)) == F.lit(bytearray(b"\x01"))
    own = triples(value)
    return F.size(F.filter(own, ordinary)) / F.greatest(F.lit(1), F.size(own)).cast("double")


def neighbours(text: Column, named: bool = True) -> Column:
    """Buckets of the words of a stretch of text, in order; without ``named``, of those that are no credential's name."""
    heard = F.lower(text) if named else F.regexp_replace(F.lower(text), rf"\p{{L}}*(?:{NAMES})\p{{L}}*", " ")
    return F.transform(F.regexp_extract_all(heard, F.lit(WORDS), F.lit(0)), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def word_weights(rows: DataFrame, named: bool = True) -> list[list[float]]:
    """Weights of all buckets from the findings of the first half, of the second half, and of both.

    ``rows``: before, after, label, weight, half (0 or 1).
    """
    heard = rows.select("half", "label", "weight", F.explode(F.array_distinct(F.concat(neighbours(F.col("before"), named), neighbours(F.col("after"), named)))).alias("bucket"))
    counts = heard.groupBy("half", "label", "bucket").agg(F.sum("weight").alias("n")).collect()  # 4 x BUCKETS at most
    n = np.zeros((2, 2, BUCKETS))
    for r in counts:
        n[r.half, int(r.label), r.bucket] = r.n
    out = []
    for part in (n[0], n[1], n[0] + n[1]):
        likely = (part + 0.5) / (part.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
        out.append([round(float(x), 4) for x in np.where(part.sum(axis=0) > 0, np.log(likely[1] / likely[0]), 0.0)])
    return out


def with_neighbours(rows: DataFrame, weights: list[float], other: list[float] | None = None, named: bool = True) -> DataFrame:
    """Candidates with NEAR; with ``other``, rows of half 1 by those weights."""
    table = lambda w: F.split(F.lit(",".join(map(str, w))), ",").cast("array<double>")  # noqa: E731  one folded literal

    def measures(weights: list[float]) -> Column:
        of = lambda text: F.transform(neighbours(text, named), lambda b: F.get(table(weights), b))
        mean = lambda x: F.coalesce(F.try_divide(F.aggregate(x, F.lit(0.0), lambda a, b: a + b), F.size(x)), F.lit(0.0))
        before = of(F.col("before"))
        return F.struct(F.coalesce(F.try_element_at(before, F.lit(-1)), F.lit(0.0)).alias("near"), mean(before).alias("words_before"), mean(of(F.col("after"))).alias("words_after"))

    got = measures(weights) if other is None else F.when(F.col("half") == 1, measures(other)).otherwise(measures(weights))
    return rows.withColumn("_m", got).select("*", "_m.*").drop("_m")


def measured(found: DataFrame, dictionary: bytes) -> DataFrame:
    """Candidates with FEATURES."""
    v = F.col("value")
    n = F.length(v).cast("double")
    share = lambda keep: F.length(F.regexp_replace(v, keep, "")) / n
    kind = F.translate(F.regexp_replace(v, "[^A-Za-z0-9]", "."), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "A" * 26 + "a" * 26 + "0" * 10)
    runs = F.regexp_count(kind, F.lit("A+|a+|0+|[.]+"))
    chars = F.array_distinct(F.split(v, ""))
    entropy = F.aggregate(F.transform(F.filter(chars, lambda c: c != ""), lambda c: (F.length(v) - F.length(F.replace(v, c, F.lit("")))) / n), F.lit(0.0), lambda a, p: a - p * F.log2(p))
    letters = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(v, F.lit("[A-Za-z]+"), F.lit(0)), F.length)), F.lit(0))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return found.withColumns({
        "length": n, "digit": share("[^0-9]"), "upper": share("[^A-Z]"), "lower": share("[^a-z]"), "other": share("[A-Za-z0-9]"),
        "changes": runs / n, "entropy": entropy, "longest_letters": letters / n, "hex": flag(v.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "coverage": ordinary_share(v, dictionary),
        "slashes": F.regexp_count(v, F.lit("/")).cast("double"), "dots": F.regexp_count(v, F.lit(r"[.]")).cast("double"),
        "path": flag(v.rlike(r"^[.~]{0,2}/|\.[a-z]{2,4}$") | F.col("before").rlike("[:/]/$")),
        "assigned": flag(F.col("before").rlike(r"""[:=]\s*["']?$""")), "quoted": flag(F.col("before").rlike("""["']$""") & F.col("after").rlike("""^["']""")),
        "behind_at": flag(F.col("before").rlike("@$")), "words_near": F.regexp_count(F.concat_ws(" | ", "before", "after"), F.lit(WORDS)).cast("double"),
    })


def seed_labels(rows: DataFrame) -> DataFrame:
    """Measured candidates with label 1.0 or 0.0 where it is sure, null elsewhere."""
    secret = F.col("before").rlike(rf"""(?i)(?:{NAMES})["']?\s*[:=]\s*["']?$""") & (F.col("entropy") >= 2.5)
    ordinary = (F.col("coverage") >= 0.9) & (F.col("longest_letters") >= 0.6)
    none = F.col("value").rlike("^[0-9.+-]+$") | (F.col("behind_at") > 0) | (F.col("path") > 0) | ordinary
    return rows.withColumn("label", F.when(secret & ~ordinary, 1.0).when(none & ~secret, 0.0))


@dataclass
class SecretModel:
    dictionary: bytes
    forest: object | None
    weights: list[float]
    features: tuple[str, ...] = (*FEATURES, *NEAR)
    constant: float = 0.0
    #: Whether credentials' names count among the neighbouring words.
    named: bool = True


def train(found: DataFrame, labelled=seed_labels, max_findings: int = 10_000, trees: int = 40, depth: int = 8, texts: DataFrame | None = None) -> SecretModel:
    """Forest from labelled findings. ``labelled``: from measured candidates to the same with a label (null: unknown);
    ``texts``: what the dictionary is counted over (without it, the text around all candidates)."""
    seen = tuple(f for f in (*FEATURES, *NEAR) if labelled is not seed_labels or f not in CONTEXT)
    known = stage(found.select("value", "before", "after").distinct(), "secret-distinct")
    dictionary = dictionary_of(known.select(F.concat_ws(" ", "before", "after").alias("text")) if texts is None else texts)
    rows = labelled(measured(known, dictionary)).where("label is not null").select("value", "before", "after", *FEATURES, "label")
    rows = stage(rows.withColumn("half", F.pmod(F.xxhash64("value", F.lit("half")), F.lit(2)).cast("int")), "secret-labelled")
    of_label = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}  # two rows
    if len(of_label) < 2:
        return SecretModel(dictionary, None, [], constant=float(next(iter(of_label), 0.0)))
    order = F.xxhash64("value", "before", "after")
    parts = []
    for label, n in of_label.items():
        take = min(n, max(max_findings // 2, max_findings - (sum(of_label.values()) - n)))
        part = rows.where(F.col("label") == label).orderBy(order, "value", "before", "after").limit(take)
        parts.append(part.withColumn("weight", F.lit(n / take)))
    sample = stage(reduce(DataFrame.unionByName, parts), "secret-sample")
    named = labelled is not seed_labels  # the rules label by these names

    def grown(rows: DataFrame, features: list[str]):
        one = VectorAssembler(inputCols=features, outputCol="features").transform(rows.orderBy("value", "before", "after").coalesce(1))
        return RandomForestClassifier(labelCol="label", featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=depth, seed=11).fit(one)

    heard = sample
    if not named:
        # what the rules leave open speaks for its neighbours too: as a forest that sees the values decides it
        values = [f for f in seen if f not in NEAR]
        some = measured(known.orderBy(order, "value", "before", "after").limit(max_findings), dictionary)
        told = grown(sample, values).transform(VectorAssembler(inputCols=values, outputCol="features").transform(some))
        heard = told.select("value", "before", "after", F.col("prediction").alias("label"), F.lit(1.0).alias("weight"), F.pmod(F.xxhash64("value", F.lit("half")), F.lit(2)).cast("int").alias("half"))
    first, second, both = word_weights(heard, named)
    forest = grown(with_neighbours(sample, second, first, named), list(seen))
    # read back, so that no plan that scores carries the training's summary and its table
    path = f"{ensure_checkpoint_dir(found.sparkSession).rstrip('/')}/llm/secret-forest-{uuid.uuid4().hex}"
    forest.save(path)
    return SecretModel(dictionary, RandomForestClassificationModel.load(path), both, seen, named=named)


def scan(found: DataFrame, model: SecretModel) -> DataFrame:
    """Candidates with their features, score (0 to 1) and is_secret."""
    rows = measured(found, model.dictionary)
    if model.forest is None:
        rows = rows.withColumn("score", F.lit(model.constant))
    else:
        rows = with_neighbours(rows, model.weights, named=model.named)
        rows = model.forest.transform(VectorAssembler(inputCols=list(model.features), outputCol="features").transform(rows))
        rows = rows.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")
    return rows.withColumn("is_secret", F.col("score") >= 0.5)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of ``documents``: its place, a digest instead of the value, score and decision."""
    docs = read_table(spark, sf_dir, "documents")
    found = stage(candidates(docs), "secret-candidates")
    out = scan(found, train(found, texts=docs))
    return out.select("doc_id", "start", "stop", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), F.round("score", 6).alias("score"), "is_secret")
