"""Mixing sources to target weights with Efraimidis-Spirakis sampling.

Sizes are words. All sources together get ``share`` times their words, dealt by
weight; a source gets ``cap`` times its own words at most, and what is above
goes to the others by weight until none is above. A source's target is taken
as complete epochs of all its documents first, then as a selection for the
rest: every document draws the key -ln(u) / quality, documents are ordered by
key within their source, and sizes are summed along that order up to the
budget. A document is taken if the middle of its words lies before the budget,
so a source misses its target by half a document at most. u comes from the
document's id alone, so reruns agree.

The order is never made over a whole source: keys fall into ``bands`` ranges,
sizes are summed per source and band first, and only the one band of a source
in which its budget ends is sorted, so a source with most rows is no larger a
task than any other.

Cases: a null or empty text has size 0 and is repeated or selected like any
other; a null source is a source, last in order; rows that repeat a doc_id
draw the same key, and of such ties the smaller size comes first (equal rows
are interchangeable); a source without words has target 0; an empty table
gives an empty result; only doc_id, source and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm.common import WORD, read_table, stage

WEIGHTS, SHARE, CAP, BANDS = (3, 1, 2), 1.5, 2.0, 4096
#: A word that is letters, perhaps with a punctuation mark behind.
CLEAN = r"(?<![^\x20\x09-\x0D])\p{L}+[.,;:!?]?(?![^\x20\x09-\x0D])"


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def quality_weight(text: Column, words: Column) -> Column:
    """0.05 to 1: the share of clean words."""
    clean = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(CLEAN))
    return F.when(words > 0, 0.05 + 0.95 * (clean / words)).otherwise(F.lit(1.0))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number between 0 and 1, both excluded, that the id and the seed determine."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per source: source_size and target. Its input has source and size."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on; the order over sources needs them together.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighted = sums.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    leveled = weighted.withColumn("most", cap * F.col("source_size")).withColumn("budget", share * F.sum("source_size").over(everything))
    leveled = leveled.withColumn("full", (F.col("budget") - before) / left > F.col("most") / F.col("weight"))
    used = F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(everything)
    level = (F.col("budget") - used) / F.nullif(open_weight, F.lit(0.0))
    target = F.when(F.col("full"), F.col("most")).otherwise(F.least(F.col("most"), F.coalesce(level, F.lit(0.0)) * F.col("weight")))
    return leveled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = "mix", bands: int = BANDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken, and the columns named in ``carry``."""
    kept = [f"_carry{i}" for i in range(len(carry))]
    words = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.col("text"), *[F.col(c).alias(k) for k, c in zip(kept, carry)])
    keyed = words.select("doc_id", "source", "size", *kept, (-F.ln(uniform(F.col("doc_id"), seed)) / quality_weight(F.col("text"), F.col("size"))).alias("key"))
    keyed = keyed.withColumn("band", F.least(F.floor(bands * (1 - F.exp(-F.col("key")))), F.lit(bands - 1)).cast("int"))
    sized = stage(keyed.drop(*kept), "mix")

    target = source_targets(sized, weights, share, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    target = target.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    running = Window.partitionBy("source").orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    sums = sized.groupBy("source", "band").agg(F.sum("size").alias("band_size")).withColumn("until", F.sum("band_size").over(running))
    plan = sums.alias("b").join(target.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).select("b.source", "b.band", "t.source_size", "t.target", "t.epochs", "t.rest", (F.col("until") - F.col("band_size")).alias("begin"), "until")

    # Carried columns aren't written: sizes and keys follow from the row and are made again beside them.
    rows = (keyed if kept else sized).alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.band") == F.col("p.band")))
    rows = rows.select("d.doc_id", "d.source", "d.size", *[f"d.{k}" for k in kept], "d.key", "d.band", "p.source_size", "p.target", "p.epochs", "p.rest", "p.begin", "p.until")
    ends_here = (F.col("begin") < F.col("rest")) & (F.col("rest") < F.col("until"))
    whole = rows.where(~ends_here).withColumn("chosen", F.col("until") <= F.col("rest"))
    order = Window.partitionBy("source", "band").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    part = rows.where(ends_here).withColumn("chosen", F.col("begin") + F.sum("size").over(order) - F.col("size") / 2 < F.col("rest"))
    copies = (F.col("epochs") + F.when(F.col("chosen") & (F.col("rest") > 0), 1).otherwise(0)).cast("int")
    return whole.unionByName(part).select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), *[F.col(k).alias(c) for k, c in zip(kept, carry)])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: The same in DuckDB's SQL: one order over each whole source.
OP3_SQL = r"""
WITH words AS (
  SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), sized AS (
  SELECT doc_id, source, len(w)::BIGINT AS size,
    (CAST(('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496 AS u,
    CASE WHEN len(w) > 0
      THEN 0.05::DOUBLE + 0.95::DOUBLE * (len(list_filter(w, lambda x: regexp_full_match(x, '\p{L}+[.,;:!?]?')))::DOUBLE / len(w)) ELSE 1.0::DOUBLE END AS q
  FROM words
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, ([3.0, 1.0, 2.0])[(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS most FROM sums
), ratio AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS budget,
    coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used_before,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM weighted WINDOW o AS (ORDER BY most / weight, source ASC NULLS LAST)
), marked AS (
  SELECT *, (budget - used_before) / weight_left > most / weight AS is_full FROM ratio
), level AS (
  SELECT *, sum(CASE WHEN is_full THEN most ELSE 0 END) OVER () AS used, sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () AS open_weight FROM marked
), target AS (
  SELECT source, source_size, CASE WHEN is_full THEN most ELSE least(most, coalesce((budget - used) / nullif(open_weight, 0), 0) * weight) END AS target FROM level
), epoch AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM target
), ordered AS (
  SELECT s.doc_id, s.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY -ln(u) / q, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
  FROM sized s JOIN epoch e ON s.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
  ((epochs + CASE WHEN rest > 0 AND until - size / 2 < rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM ordered
"""
