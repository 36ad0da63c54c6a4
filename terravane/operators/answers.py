"""Answers of services as a table: each request is known by a digest of its content, so that a stage that runs again asks only
for what has no answer yet.

A log holds rows (sku, key, request, value, at, seq); it grows by appending, and the last write of a key counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import written


def request_json(fields: Sequence[str]) -> Column:
    """A request's content, its fields in order of their names, nulls written out."""
    return F.to_json(F.struct(*sorted(fields)), {"ignoreNullFields": "false"})


def requests_of(df: DataFrame, sku: str, fields: Sequence[str]) -> DataFrame:
    """(sku, key, request): the different requests that some columns of df's rows make."""
    asked = df.select(F.lit(sku).alias("sku"), request_json(fields).alias("request")).distinct()
    return asked.select("sku", F.sha1(F.col("request").cast("binary")).alias("key"), "request")


def answer_log(log: DataFrame) -> DataFrame:
    """(sku, key, request, value, at, writes): the last write of each key, by at (null first), seq and value, whatever the
    order of arrival; how many writes there were. A null value stays in the log: it says that the answer was forgotten.
    Writes are combined before the shuffle, so that a key with many is one row a task."""
    last = F.max(F.struct("at", "seq", "value")).alias("last")
    found = log.groupBy("sku", "key").agg(F.min("request").alias("request"), last, F.count("*").alias("writes"))
    return found.select("sku", "key", "request", "last.value", "last.at", "writes")


def pending_requests(requests: DataFrame, log: DataFrame) -> DataFrame:
    """The requests (sku, key, request) without an answer: never written, or forgotten since."""
    answered = answer_log(log).filter("value is not null").select("sku", "key")
    return requests.join(answered, ["sku", "key"], "left_anti")


def append_answers(spark: SparkSession, path: str, answers: DataFrame) -> None:
    """Adds answers (sku, key, request, value, at, seq) to the log at path; a file for each task, none is changed."""
    answers.select("sku", "key", "request", "value", "at", "seq").write.mode("append").partitionBy("sku").parquet(path)


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    schema = "key string, request string, value string, at timestamp, seq long, sku string"
    return spark.read.schema(schema).parquet(path)


def compacted(log: DataFrame) -> DataFrame:
    """The log with one row for each key, written anew in the shared folder."""
    last = answer_log(log).withColumn("seq", F.lit(0).cast("long"))
    return written(last.select("sku", "key", "request", "value", "at", "seq"), "answers")


def fetched_range(log: DataFrame, day: str = "at") -> DataFrame:
    """(first, last): the days of the earliest and the latest answer, as text; empty and null days do not count."""
    each = log.select(F.nullif(F.date_format(day, "yyyy-MM-dd"), F.lit("")).alias("d"))
    return each.agg(F.min("d").alias("first"), F.max("d").alias("last"))
