"""A corpus made ready for training: five stages over ``documents``, each by one operator of carelake.llm.

1. quality: lines are labelled good or bad by the field trained on ``labels``; documents that score below 0.3 go.
2. near_duplicates: documents link with a Jaccard similarity of 0.8 of their five-word shingles; of each connected
   group the document with the smallest doc_id stays. Documents without words stay.
3. private: personal data and the terms that disclose it are replaced in the text.
4. mix: sources get their target weights; a document is repeated for each of its copies and goes with none.
5. tokens: ids of every text, and the digest of the text decoded from them.

Rows may be null in any column; a table without rows gives a result without rows. Columns beyond those of
``documents`` are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm.bpe import bpe_encode
from carelake.llm.common import WORD, discard, read_table, stage
from carelake.llm.mixing import mix
from carelake.llm.pii import find_private
from carelake.llm.quality_crf import score_documents, train
from carelake.llm.shingle_join import join_shingles

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more. A null or empty text is scored like any other; repeated rows are judged alike."""
    docs = docs.select(*COLUMNS)
    field = train(docs, read_table(spark, sf_dir, "labels"))
    return score_documents(docs, field).where("quality_score >= 0.3").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the smallest doc_id (null last; ties by source, lang, n_chars). Texts without words stay."""
    docs = docs.select(*COLUMNS)
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    of = join_shingles(docs.where(worded), size=5, least=80)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = of.groupBy("component").agg(F.min(place).alias("p")).select(F.col("p.doc_id").alias("_id"), F.col("p.text_key").alias("_key"))
    rows = docs.where(worded).withColumn("_key", F.xxhash64("text"))
    kept = rows.join(first.withColumnRenamed("_key", "_first"), rows["doc_id"].eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_first")), "left_semi")
    # equal ids and texts are one document: the same row on every run
    order = Window.partitionBy("doc_id", "_key").orderBy("source", "lang", "n_chars")
    kept = kept.withColumn("_r", F.row_number().over(order)).where("_r = 1")
    return kept.select(*COLUMNS).unionByName(docs.where(~worded))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, private spans replaced; n_chars is that of the new text. A null text stays null."""
    found = find_private(docs.select(*COLUMNS), carry=COLUMNS[1:])
    changed = F.col("sanitised").isNotNull()
    text = F.when(changed, F.col("sanitised")).otherwise(F.col("text"))
    n_chars = F.when(changed, F.length("sanitised").cast("long")).otherwise(F.col("n_chars"))
    return found.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes; the null source comes last in the weights."""
    taken = mix(docs.select(*COLUMNS), carry=("text", "lang", "n_chars")).where("copies > 0")
    return taken.select("*", F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("_")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text (null as empty) and the digest of the text decoded from them."""
    coded = bpe_encode(docs)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("private", private), ("mix", mixed), ("tokens", tokens)]

#: The trained classifier and the tokenizer cannot be stated in SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    done = None
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        if done is not None:
            discard(done)  # its successor is written
        done = docs
    return STAGES[-1][1](spark, docs, sf_dir)
