"""A trained classifier of denial notes (Spark ML), for wordings that no rule foresees.

A note becomes its words cut to six letters and the pairs of neighbouring ones,
hashed and weighted by inverse document frequency; a multinomial logistic
regression gives the category. Every distinct labelled wording counts once per
category, and the categories weigh alike, however often a wording is sent.

The confidence is calibrated: the labelled wordings are dealt into folds by
their hash, each fold is scored by a model that has not seen it, and the
temperature that makes these out-of-fold probabilities likeliest divides the
scores. The same predictions give ``held_out``, the accuracy on unseen wordings.

Labels are any table of notes and categories: reviewers' decisions, parsed
replies of a service (``notes.parse_classifications``), or ``rule_labels``.

Blank and null notes are OTHER with confidence 0, as with the rules. Labels
outside the taxonomy, null or blank notes take no part in training; labels of
one category only give that category with confidence 1; without any, training
is refused. Scoring runs in the JVM, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.plans.notes import CATEGORIES, EMPTY_CONFIDENCE, classify_denial_notes
from carelake.session import discard, written

#: Letters kept of a word: endings differ between wordings.
STEM = 6
BUCKETS = 1 << 16
TEMPERATURES = tuple(0.25 * 2 ** (k / 4) for k in range(21))  # 0.25 to 8
_TOKENS, _LABEL, _WEIGHT = "_tokens", "_label", "_weight"


@dataclass(frozen=True)
class NoteModel:
    #: Categories by the index that the regression predicts.
    categories: tuple[str, ...]
    #: None where only one category is labelled.
    pipeline: PipelineModel | None
    temperature: float = 1.0
    #: Accuracy on wordings kept out of training; None without folds.
    held_out: float | None = None


def wording(note: Column) -> Column:
    """What makes two notes the same wording: letters and digits, in lower case, single spaces."""
    return F.array_join(F.regexp_extract_all(F.lower(note), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), " ")


def tokens(note: Column) -> Column:
    """Cut words and pairs of neighbours."""
    cut = F.transform(F.filter(F.split(wording(note), " "), lambda w: w != ""), lambda w: F.substring(w, 1, STEM))
    pairs = F.when(F.size(cut) > 1, F.zip_with(F.slice(cut, F.lit(1), F.size(cut) - 1), F.slice(cut, F.lit(2), F.size(cut) - 1), lambda a, b: F.concat_ws("_", a, b)))
    return F.coalesce(F.concat(cut, F.coalesce(pairs, F.array().cast("array<string>"))), F.array().cast("array<string>"))


def rule_labels(notes: DataFrame, note_col: str = "note", least: float = 0.85) -> DataFrame:
    """note, category: what the rules say where they are at least so sure, and OTHER where none applies."""
    ruled = classify_denial_notes(notes.select(F.col(note_col).alias("note")))
    return ruled.where((F.col("confidence") >= least) | ((F.col("category") == "OTHER") & (F.col("confidence") > EMPTY_CONFIDENCE))).select("note", "category")


def _fit(rows: DataFrame, buckets: int, reg: float) -> PipelineModel:
    steps = [
        HashingTF(inputCol=_TOKENS, outputCol="_tf", numFeatures=buckets, binary=True),
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol=_LABEL, weightCol=_WEIGHT, family="multinomial", regParam=reg, maxIter=60, rawPredictionCol="_raw", probabilityCol="_p", predictionCol="_at"),
    ]
    fitted = Pipeline(stages=steps).fit(rows)
    # of two categories the summary of the training holds the session, which no task can take once it has observed a query
    fitted.stages[-1]._java_obj.setSummary(rows.sparkSession._jvm.scala.Option.empty())
    return fitted


def _softmax(raw: Column, temperature: float) -> Column:
    """Probabilities from scores, the largest subtracted first."""
    scaled = F.transform(raw, lambda x: (x - F.array_max(raw)) / F.lit(temperature))
    total = F.aggregate(scaled, F.lit(0.0), lambda a, x: a + F.exp(x))
    return F.transform(scaled, lambda x: F.exp(x) / total)


def train_note_model(labelled: DataFrame, note_col: str = "note", category_col: str = "category", folds: int = 3, buckets: int = BUCKETS, reg: float = 0.01) -> NoteModel:
    """Classifier from a table of notes and categories, with calibrated confidence."""
    text = wording(F.col(note_col))
    known = labelled.where(F.col(category_col).isin(CATEGORIES) & (F.coalesce(text, F.lit("")) != ""))
    known = written(known.select(text.alias("note"), F.col(category_col).alias("category")).distinct(), "note-labels")
    counts = {r.category: r["count"] for r in known.groupBy("category").count().collect()}  # one row a category
    categories = tuple(c for c in CATEGORIES if c in counts)
    if not categories:
        raise ValueError("no labelled note with a category of the taxonomy")
    if len(categories) == 1:
        discard(known)
        return NoteModel(categories, None)
    most = max(counts.values())
    pick = lambda values, t: F.element_at(F.array(*[F.lit(v) for v in values]).cast(f"array<{t}>"), F.col("_i"))
    rows = known.withColumn("_i", F.array_position(F.array(*[F.lit(c) for c in categories]), F.col("category")).cast("int"))
    rows = rows.select(tokens(F.col("note")).alias(_TOKENS), (F.col("_i") - 1).cast("double").alias(_LABEL), pick([most / counts[c] for c in categories], "double").alias(_WEIGHT), F.pmod(F.xxhash64("note"), F.lit(max(folds, 1))).alias("_fold"))
    rows = written(rows, "note-rows")

    scored = None
    for fold in range(folds if folds > 1 else 0):
        inside = rows.where(F.col("_fold") != fold)
        if inside.select(_LABEL).distinct().count() < len(categories):
            scored = None
            break  # too few wordings to keep some out
        part = _fit(inside, buckets, reg).transform(rows.where(F.col("_fold") == fold)).select(vector_to_array("_raw").alias("raw"), F.col(_LABEL).cast("int").alias("at"), _WEIGHT)
        scored = part if scored is None else scored.unionByName(part)
    temperature, held_out = 1.0, None
    if scored is not None:
        loss = lambda t: F.sum(-F.log(F.greatest(F.element_at(_softmax(F.col("raw"), t), F.col("at") + 1), F.lit(1e-12))) * F.col(_WEIGHT))
        right = F.avg((F.array_position("raw", F.array_max("raw")) == F.col("at") + 1).cast("double"))
        row = scored.agg(right.alias("right"), *[loss(t).alias(f"t{k}") for k, t in enumerate(TEMPERATURES)]).first()
        if row["right"] is not None:
            temperature, held_out = min(TEMPERATURES, key=lambda t: row[f"t{TEMPERATURES.index(t)}"]), row["right"]
    pipeline = _fit(rows, buckets, reg)
    discard(rows)
    discard(known)
    return NoteModel(categories, pipeline, temperature, held_out)


def classify_by_model(notes: DataFrame, model: NoteModel, note_col: str = "note") -> DataFrame:
    """``notes`` with ``category`` and the calibrated ``confidence``."""
    blank = F.coalesce(wording(F.col(note_col)), F.lit("")) == ""
    if model.pipeline is None:
        category, confidence, rows = F.lit(model.categories[0]), F.lit(1.0), notes
    else:
        rows = model.pipeline.transform(notes.withColumn(_TOKENS, tokens(F.col(note_col)))).withColumn("_q", _softmax(vector_to_array("_raw"), model.temperature))
        category = F.element_at(F.array(*[F.lit(c) for c in model.categories]), F.col("_at").cast("int") + 1)
        confidence = F.array_max("_q")
    return rows.select(
        *[F.col(f"`{c}`") for c in notes.columns if c not in ("category", "confidence")],
        F.when(blank, "OTHER").otherwise(category).alias("category"),
        F.when(blank, EMPTY_CONFIDENCE).otherwise(confidence).alias("confidence"),
    )


def judge(classified: DataFrame, truth_col: str) -> DataFrame:
    """Per true category: notes, right ones, accuracy, and mean confidence beside it."""
    right = (F.col("category") == F.col(truth_col)).cast("int")
    return classified.groupBy(F.col(truth_col).alias("true_category")).agg(
        F.count("*").alias("notes"), F.sum(right).alias("right"), F.avg(right).alias("accuracy"), F.avg("confidence").alias("mean_confidence")
    )


def save_note_model(spark: SparkSession, model: NoteModel, path: str) -> None:
    facts = spark.createDataFrame([(list(model.categories), model.pipeline is not None, model.temperature, model.held_out)], _FACTS)
    if model.pipeline is not None:
        model.pipeline.write().overwrite().save(f"{path}/pipeline")
    facts.coalesce(1).write.mode("overwrite").json(f"{path}/facts")


def load_note_model(spark: SparkSession, path: str) -> NoteModel:
    r = spark.read.schema(_FACTS).json(f"{path}/facts").first()
    return NoteModel(tuple(r.categories), PipelineModel.load(f"{path}/pipeline") if r.fitted else None, r.temperature, r.held_out)


_FACTS = "categories array<string>, fitted boolean, temperature double, held_out double"
