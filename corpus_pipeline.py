"""A training-data pipeline over the documents table, made of the corpus operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.llm import decontaminate, mixing, ngram_jaccard, quality, secret_scan
from terravane.llm.queries import MIX_SHARE, MIX_WEIGHTS, table
from terravane.llm.storage import discard, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows that the quality model predicts as good. A null text is scored as an empty one; rows that repeat, and
    rows of one id or of none, are decided each; without labelled rows the model says 0.5 and all rows stay."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs.select(*COLUMNS), model).filter("predicted = 1").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates (null ids count as largest; of one id, the
    least text key; of rows of one id and key, the least by text, lang, source and n_chars, nulls first). Groups are of
    texts, so null ids and ids of several texts lose no group. Null and empty texts are equal here: one of them stays."""
    keyed = docs.select(*COLUMNS, ngram_jaccard.text_key("text").alias("key"))
    groups = ngram_jaccard.similar_groups(keyed, id_col="key").distinct()
    rows = written(keyed.select("doc_id", "key").join(groups.select("key", "class_id"), "key"), "group-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first")
    keep = rows.groupBy("class_id").agg(first).select(F.col("first.doc_id").alias("keep_id"), F.col("first.key").alias("keep_key"))
    kept = keyed.join(keep, (F.col("key") == F.col("keep_key")) & F.col("doc_id").eqNullSafe(F.col("keep_id")), "left_semi")
    if rows.groupBy("doc_id", "key").count().filter("count > 1").isEmpty():
        return kept.select(*COLUMNS)
    least = kept.groupBy("doc_id", "key").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("row"))
    return least.select("doc_id", "row.*").select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark passage: rows are told by their texts, whatever their ids, so that null
    and repeated ids neither save nor drop another row. Null texts stay; an empty benchmark drops nothing."""
    keyed = docs.select(*COLUMNS, ngram_jaccard.text_key("text").alias("key"))
    found = decontaminate.find_contamination(keyed, table(spark, sf_dir, "benchmark"), id_col="key").select("key").distinct()
    return keyed.join(found, "key", "left_anti").select(*COLUMNS)


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts [secret] in the place of every secret; n_chars follows. No row is dropped, a null text stays null."""
    scanned = secret_scan.scan_secrets(docs.select(*COLUMNS), mask="[secret]")
    changed = F.size("secret_spans") > 0
    return scanned.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents and epochs that meet the target weights. Null languages and sources count as an empty name, null texts
    as no tokens; rows that repeat are counted and selected each; an empty table gives no rows."""
    return mixing.mix_sources(docs, MIX_WEIGHTS, MIX_SHARE)


STAGES = [
    ("quality classifier", classify_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", decontaminated),
    ("secret scans", secrets_masked),
    ("mixing sources to target weights", mixed),
]
#: A fitted model and similarity groups are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; a stage's table is deleted once the next one is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"stage{i}")
        if last is not None:
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
