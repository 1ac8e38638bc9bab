"""Trained note classifier: wordings it has not seen, calibration, odd labels, saving."""

import pytest
from pyspark.sql import functions as F

from carelake.oracle import LABELLED_NOTES
from carelake.plans import note_model as M
from carelake.plans import notes as N

NOTES = "note string, category string"


def read(spark, path):
    return spark.read.schema(NOTES).option("header", True).csv(path)


@pytest.fixture(scope="module")
def labelled(spark, data_path):
    return read(spark, data_path("notes_training.csv")).unionByName(spark.createDataFrame([(t, c) for t, c, _ in LABELLED_NOTES], NOTES))


@pytest.fixture(scope="module")
def model(labelled):
    return M.train_note_model(labelled)


def accuracy(classified):
    return classified.agg(F.avg((F.col("category") == F.col("truth")).cast("double"))).first()[0]


def test_wordings_not_seen_in_training(spark, data_path, labelled, model):
    held = read(spark, data_path("notes_held_out.csv")).withColumnRenamed("category", "truth")
    seen = {r.w for r in labelled.select(M.wording(F.col("note")).alias("w")).collect()}
    assert not seen & {r.w for r in held.select(M.wording(F.col("note")).alias("w")).collect()}
    by_model, by_rules = M.classify_by_model(held, model).cache(), N.classify_denial_notes(held)
    got = accuracy(by_model), accuracy(by_rules)
    print("held-out accuracy: model %.3f, rules %.3f" % got, "folds", model.held_out, "temperature", model.temperature, "mean confidence", by_model.agg(F.avg("confidence")).first()[0])
    assert got[0] > got[1] and got[0] >= 0.7
    per = {r.true_category: r for r in M.judge(by_model, "truth").collect()}
    assert set(per) == set(N.CATEGORIES) and all(r.notes == 5 and r.right == round(r.accuracy * 5) for r in per.values())


def test_confidence_is_calibrated(spark, data_path, model):
    held = M.classify_by_model(read(spark, data_path("notes_held_out.csv")).withColumnRenamed("category", "truth"), model)
    conf, right = held.agg(F.avg("confidence"), F.avg((F.col("category") == F.col("truth")).cast("double"))).first()
    assert abs(conf - right) < 0.15
    assert held.where("confidence < 0 or confidence > 1 or confidence is null").isEmpty()


def test_blank_notes_extra_and_clashing_columns(spark, model):
    rows = [(1, None, "x"), (2, "  ", "x"), (3, "...", "x"), (4, "Duplicate of an earlier bill", "x"), (5, "w " * 100_000, "x")]
    out = M.classify_by_model(spark.createDataFrame(rows, "id int, note string, category string"), model)
    got = {r.id: (r.category, r.confidence) for r in out.collect()}
    assert out.columns == ["id", "note", "category", "confidence"] and len(got) == 5
    assert all(got[i] == ("OTHER", 0.0) for i in (1, 2, 3)) and got[4][0] == "DUPLICATE_CLAIM"
    assert M.classify_by_model(spark.createDataFrame([], "note string"), model).count() == 0
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_odd_labels(spark):
    one = M.train_note_model(spark.createDataFrame([("late", "TIMELY_FILING"), ("late", "TIMELY_FILING"), (None, "OTHER"), ("x", "BANANA"), ("y", None)], NOTES))
    assert one.pipeline is None and one.categories == ("TIMELY_FILING",)
    got = M.classify_by_model(spark.createDataFrame([("any",), (None,)], "note string"), one).collect()
    assert [(r.category, r.confidence) for r in got] == [("TIMELY_FILING", 1.0), ("OTHER", 0.0)]
    two = M.train_note_model(spark.createDataFrame([("late", "TIMELY_FILING"), ("twice", "DUPLICATE_CLAIM")], NOTES))
    assert two.held_out is None and two.temperature == 1.0  # too few to keep some out
    assert [r.category for r in M.classify_by_model(spark.createDataFrame([("Twice!",)], "note string"), two).collect()] == ["DUPLICATE_CLAIM"]
    with pytest.raises(ValueError):
        M.train_note_model(spark.createDataFrame([], NOTES))


def test_repeated_wordings_count_once_and_models_are_kept(spark, labelled, model, tmp_path):
    again = M.train_note_model(labelled.unionByName(labelled.where("category = 'OTHER'")).unionByName(labelled.select(F.upper("note").alias("note"), "category")))
    assert again.held_out == model.held_out and again.temperature == model.temperature
    M.save_note_model(spark, model, str(tmp_path / "model"))
    loaded = M.load_note_model(spark, str(tmp_path / "model"))
    rows = lambda m: sorted((r.note, r.category, round(r.confidence, 9)) for r in M.classify_by_model(labelled, m).collect())
    assert rows(loaded) == rows(model) and loaded.held_out == model.held_out
