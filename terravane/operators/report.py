"""Reports on data quality: distributions, extremes, near duplicates, measures that say the same."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.storage import written
from ..functions.text import half_even
from .ranks import long_form, percentile_of, quantiles, running_counts

POINTS = [0.0, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
NAMES = ["min", "p25", "p50", "p75", "p90", "p99", "max"]
NOT_MEASURES = {"place_id", "lat", "lng", "keep", "keep_auto", "is_new", "rank", "dup_count", "ord"}


def measure_columns(df: DataFrame, skip: set[str] = NOT_MEASURES) -> list[str]:
    """Numeric columns that hold any value, in one pass."""
    numeric = [f.name for f in df.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal") and f.name not in skip]
    counts = df.agg(*(F.count(f"`{c}`").alias(c) for c in numeric)).first().asDict() if numeric else {}
    return [c for c in numeric if counts[c]]


def distribution(df: DataFrame, cols: Sequence[str], key: str = "place_id") -> DataFrame:
    """(measure, n, n_null, n_zero, min, p25, p50, p75, p90, p99, max), quantiles to 2 places."""
    every = df.agg(F.count("*").alias("n"), *(F.count(f"`{c}`").alias(f"c_{c}") for c in cols), *(F.count_if(F.col(f"`{c}`") == 0).alias(f"z_{c}") for c in cols))
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("measure"), F.col("n"), (F.col("n") - F.col(f"`c_{c}`")).alias("n_null"), F.col(f"`z_{c}`").alias("n_zero")) for c in cols)))
    counts = every.select(cells.alias("x")).select("x.*")
    points = quantiles(written(long_form(df, key, cols), "values"), POINTS)
    wide = points.groupBy("measure").agg(*(half_even(F.max(F.when(F.col("point") == p, F.col("value"))), 2).alias(n) for p, n in zip(POINTS, NAMES, strict=True)))
    return counts.join(wide, "measure", "left")


def mostly_zero(df: DataFrame, cols: Sequence[str], least: float = 0.6) -> DataFrame:
    """(measure, share): measures of which zeros are `least` of all rows or more, nulls counted as rows."""
    shares = df.agg(*(F.avg(F.when(F.col(f"`{c}`") == 0, 1.0).otherwise(0.0)).alias(c) for c in cols))
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("measure"), F.col(f"`{c}`").alias("share")) for c in cols)))
    return shares.select(cells.alias("x")).select("x.*").filter(F.col("share") >= least)


def top_values(df: DataFrame, cols: Sequence[str], n: int = 8, key: str = "place_id") -> DataFrame:
    """(measure, pos, place_id, value): the n largest values of each measure, ties by key."""
    order = W.partitionBy("measure").orderBy(F.desc("value"), "key")
    return long_form(df, key, cols).withColumn("pos", F.row_number().over(order)).filter(F.col("pos") <= n).select("measure", "pos", F.col("key").alias(key), "value")


def same_names(df: DataFrame) -> DataFrame:
    """(name, n): trimmed lower-case names that several places have."""
    return df.groupBy(F.lower(F.trim(F.coalesce("name", F.lit("")))).alias("name")).agg(F.count("*").alias("n")).filter("n > 1")


def spearman(df: DataFrame, cols: Sequence[str], key: str = "place_id") -> DataFrame:
    """(a, b, r): rank correlation of each pair of measures over the rows that have both, of measures with over 10 values
    and over 2 unlike ones."""
    facts = df.agg(*(F.count(f"`{c}`").alias(f"n_{c}") for c in cols), *(F.count_distinct(f"`{c}`").alias(f"d_{c}") for c in cols)).first()
    good = [c for c in cols if facts[f"n_{c}"] > 10 and facts[f"d_{c}"] > 2]
    spark = df.sparkSession
    if len(good) < 2:
        return spark.createDataFrame([], "a string, b string, r double")
    pairs = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}`").cast("double").alias("x"), F.col(f"`{b}`").cast("double").alias("y")) for a, b in combinations(good, 2))))
    both = written(df.select(pairs.alias("p")).select("p.*").filter("x is not null and y is not null").withColumns({"mx": F.concat_ws("\x01", "a", "b", F.lit("x")), "my": F.concat_ws("\x01", "a", "b", F.lit("y"))}), "pairs")
    values = both.select(F.col("mx").alias("measure"), F.col("x").alias("value")).unionByName(both.select(F.col("my").alias("measure"), F.col("y").alias("value")))
    ranks = written(percentile_of(running_counts(values)), "pair-ranks")
    side = lambda m, v, r: ranks.select(F.col("measure").alias(m), F.col("value").alias(v), F.col("pct").alias(r))
    return both.join(side("mx", "x", "rx"), ["mx", "x"]).join(side("my", "y", "ry"), ["my", "y"]).groupBy("a", "b").agg(F.corr("rx", "ry").alias("r"))


def redundant(df: DataFrame, cols: Sequence[str], least: float = 0.85, key: str = "place_id") -> DataFrame:
    """(a, b, r): pairs whose |r| reaches `least`, r to 2 places."""
    return spearman(df, cols, key).filter(F.abs("r") >= least).select("a", "b", half_even(F.col("r"), 2).alias("r"))


def merge_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("dup_count") > 0).alias("n_sites"), F.coalesce(F.sum("dup_count"), F.lit(0)).alias("n_listings"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(F.coalesce(F.col(col), F.lit("")).alias(col)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col)


def markdown(df: DataFrame) -> str:
    """A table of all rows of a report: one for each measure, pair of measures, or of a part that has its own limit."""
    rows = df.toLocalIterator()
    line = lambda cells: "| " + " | ".join("" if c is None else f"{c:g}" if isinstance(c, float) else str(c) for c in cells) + " |"
    return "\n".join([line(df.columns), "|" + "---|" * len(df.columns), *map(line, rows)])


def quality_report(features: DataFrame, ranked: DataFrame | None = None, raw_count: int | None = None) -> str:
    """All parts of the report as one text."""
    cols = measure_columns(features)
    n = features.count()
    out = [f"# {n} sites" + ("" if raw_count is None else f" of {raw_count} listings")]
    part = lambda title, df: out.append(f"\n## {title}\n\n{markdown(df)}")
    if "dup_count" in features.columns:
        part("Merged listings", merge_summary(features))
        part("Sites that absorbed others", features.filter("dup_count > 0").select("name", "place_id", "dup_names", "dup_ids", "dup_count").orderBy(F.desc("dup_count")))
    part("Mostly zero", mostly_zero(features, cols))
    part("Distributions", distribution(features, cols))
    part("Largest values", top_values(features, cols).orderBy("measure", "pos"))
    part("Same names", same_names(features).orderBy(F.desc("n"), "name").limit(30))
    part("Measures that say the same", redundant(features, cols).orderBy(F.desc(F.abs("r"))).limit(60))
    if ranked is not None:
        points = ["score", *(c for c in ranked.columns if c.startswith("pillar_"))]
        part("Scores", distribution(ranked, points))
        part("Pillar correlation", spearman(ranked, points[1:]))
        part("Tiers", value_counts(ranked, "tier"))
        part("Profiles", value_counts(ranked, "profile"))
        part("Top 25", ranked.orderBy("rank").select("rank", "tier", "name", *points).limit(25))
        part("Bottom 10", ranked.orderBy(F.desc("rank")).select("rank", "tier", "name", *points).limit(10))
    return "\n".join(out)
