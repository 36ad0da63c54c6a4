"""Features of a site, and its rank by a grouped weighted score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.storage import written
from ..functions.text import first_rule, half_even
from .dedupe import dedupe
from .ranks import percentiles

# Measures that stand for a derived column; least share of sites below for each tier.
ALIASES = {"reviews": "reviews_log", "rating": "rating_adj"}
TIERS = [(0.9, "A"), (0.7, "B"), (0.4, "C")]
LAST_TIER = "D"


@dataclass(frozen=True)
class Pillar:
    measures: Mapping[str, float]
    weight: float = 0.0
    label: str = ""
    tag: str = ""
    notes: Mapping[str, str] = field(default_factory=dict)


def with_ratings(df: DataFrame, prior: float = 30) -> DataFrame:
    """df with reviews_log (unknown stays unknown) and rating_adj: ratings drawn towards their mean as if `prior` reviews
    had given it."""
    mean = df.agg(F.coalesce(F.avg("rating"), F.lit(0.0)).alias("_mean"))
    n = F.coalesce(F.col("reviews"), F.lit(0))
    adjusted = F.try_divide(F.lit(float(prior)) * F.col("_mean") + n * F.col("rating"), F.lit(float(prior)) + n)
    return df.join(F.broadcast(mean), F.lit(True)).withColumns({"reviews_log": F.log1p(F.col("reviews").cast("double")), "rating_adj": half_even(adjusted, 6)}).drop("_mean")  # one row


def build_features(sites: DataFrame, details: DataFrame, surroundings: DataFrame, prior: float = 30, same_site_m: float | None = 40, similar_name_m: float = 150, by_name: bool = True) -> DataFrame:
    """Sites with details and surroundings (left joins on place_id), without closed ones, listings of one place merged
    (unless same_site_m is None), with derived ratings."""
    df = sites.join(details, "place_id", "left").join(surroundings, "place_id", "left")
    if "business_status_now" in df.columns:
        df = df.filter(~F.coalesce("business_status_now", F.lit("")).isin("CLOSED_PERMANENTLY", "CLOSED_TEMPORARILY"))
    if same_site_m is not None:
        df = dedupe(df, same_site_m, similar_name_m, by_name)
    return with_ratings(df, prior)


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """df's cols as their place between the least and the largest value; 0.5 where those are equal, and for null."""
    ends = df.agg(*(f(c).cast("double").alias(f"_{k}_{c}") for c in cols for k, f in (("lo", F.min), ("hi", F.max))))
    place = lambda c: F.coalesce(F.when(F.col(f"_hi_{c}") > F.col(f"_lo_{c}"), (F.col(c) - F.col(f"_lo_{c}")) / (F.col(f"_hi_{c}") - F.col(f"_lo_{c}"))), F.lit(0.5))
    return df.join(F.broadcast(ends), F.lit(True)).select(*(c for c in df.columns if c not in cols), *(place(c).alias(c) for c in cols))  # one row


def usable(df: DataFrame, pillars: Mapping[str, Pillar], log=print) -> dict[str, dict[str, float]]:
    """Measures by pillar that have a weight, a column and any value, of pillars with a weight; one pass over df."""
    wanted = {ALIASES.get(m, m) for p in pillars.values() for m, w in p.measures.items() if w} & set(df.columns)
    counts = df.agg(*(F.count(f"`{c}`").alias(c) for c in sorted(wanted))).first().asDict() if wanted else {}
    out = {}
    for name, p in pillars.items():
        good = {m: w for m, w in p.measures.items() if w and counts.get(ALIASES.get(m, m))}
        for m in sorted(k for k, w in p.measures.items() if w and k not in good):
            log(f"measure {m} of pillar {name} has no data")
        if good and p.weight:
            out[name] = good
        elif p.weight:
            log(f"pillar {name} has no usable measure")
    if not out:
        raise ValueError("no pillar has a usable measure")
    return out


def tier(pct: Column) -> Column:
    return first_rule([(pct >= cut, name) for cut, name in TIERS], LAST_TIER)


def mean_of(values: Sequence[tuple[Column, float]]) -> Column:
    """Weighted mean; negative weights count against, by their size in the denominator."""
    total = values[0][0] * float(values[0][1])
    for v, w in values[1:]:
        total = total + v * float(w)
    return total / float(sum(abs(w) for _, w in values))


def score(df: DataFrame, pillars: Mapping[str, Pillar], top_pct: float = 30, scales: Mapping[str, str] | None = None, key: str = "place_id", log=print) -> DataFrame:
    """df ranked: rank, score, pillar_<key> (0 to 100, 1 place), profile, why, tier. Unknown values count 0.5."""
    scales = scales or {}
    df = written(df, "features")
    parts = usable(df, pillars, log)
    measures = list(dict.fromkeys(m for ms in parts.values() for m in ms))
    named = df.select(F.col(key), *(F.col(f"`{ALIASES.get(m, m)}`").cast("double").alias(f"m_{m}") for m in measures))
    ranked = [f"m_{m}" for m in measures if scales.get(m) != "minmax"]
    scaled = [f"m_{m}" for m in measures if scales.get(m) == "minmax"]
    values = named.select(key)
    if ranked:
        values = values.join(percentiles(named, key, ranked, stored=True), key)
    if scaled:
        values = values.join(min_max(named.select(key, *scaled), scaled), key)
    value = lambda m: F.coalesce(F.col(f"`m_{m}`"), F.lit(0.5))
    points = written(values.select(key, *(mean_of([(value(m), w) for m, w in ms.items()]).alias(f"p_{p}") for p, ms in parts.items())), "pillars")
    total = half_even(mean_of([(F.col(f"`p_{p}`"), pillars[p].weight) for p in parts]) * 100, 1)
    rounded = points.withColumn("score", total)
    tagged = [p for p in parts if pillars[p].tag]
    pct = percentiles(rounded, key, ["score", *(f"p_{p}" for p in tagged)], stored=True)
    pct = pct.select(key, F.col("score").alias("_pct"), *(F.col(f"`p_{p}`").alias(f"t_{p}") for p in tagged))
    cut = 1 - top_pct / 100
    profile = F.concat_ws(", ", *(F.when(F.col(f"`t_{p}`") >= cut, F.lit(pillars[p].tag)) for p in tagged)) if tagged else F.lit("")
    shares = F.array(*(F.struct((-F.col(f"`p_{p}`") * float(pillars[p].weight)).alias("c"), F.lit(i).alias("i"), F.lit(pillars[p].tag or pillars[p].label or p).alias("label")) for i, p in enumerate(parts)))
    out = rounded.join(pct, key).select(
        key, "score", *(half_even(F.col(f"`p_{p}`") * 100, 1).alias(f"pillar_{p}") for p in parts), profile.alias("profile"),
        F.array_join(F.transform(F.slice(F.array_sort(shares), 1, 2), lambda x: x["label"]), ", ").alias("why"), tier(F.col("_pct")).alias("tier"))
    return with_rank(df.join(out, key), key)


def with_rank(df: DataFrame, key: str = "place_id") -> DataFrame:
    """rank from 1 by score, the largest first, ties by key. Ranks are put together from ranges of (score, key): how many
    rows come before a range, and the place inside it."""
    spark = df.sparkSession
    order = [F.desc("score"), F.asc(key)]
    ranged = written(df.select(key, "score").repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).withColumn("_part", F.spark_partition_id()), "ranked")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    place = F.row_number().over(W.partitionBy("_part").orderBy(*order))
    ranks = ranged.withColumn("_place", place).join(before, "_part").select(key, (F.col("_before") + F.col("_place")).cast("long").alias("rank"))
    return df.join(ranks, key).select("rank", *df.columns)
