"""Use of metered services by month: what is used, left and allowed; what a plan would cost."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usage(recorded: DataFrame, caps: DataFrame, month: str, seed: DataFrame | None = None) -> DataFrame:
    """(sku, used, cap, remaining, allowed) for every sku with a cap or any use (recorded and seed: month, sku, n); a sku
    without a cap has no limit."""
    every = recorded.select("month", "sku", "n") if seed is None else recorded.select("month", "sku", "n").unionByName(seed.select("month", "sku", "n"))
    used = every.filter(F.col("month") == month).groupBy("sku").agg(F.sum("n").alias("used"))
    joined = used.join(caps.select("sku", "cap"), "sku", "full").withColumn("used", F.coalesce("used", F.lit(0)).cast("long"))
    return joined.select("sku", "used", "cap", F.greatest(F.col("cap") - F.col("used"), F.lit(0)).alias("remaining"), F.coalesce(F.col("used") < F.col("cap"), F.lit(True)).alias("allowed"))


def usage_lines(report: DataFrame) -> list[str]:
    return [f"{r.sku:<26} {r.used:>6} / {'-' if r.cap is None else r.cap}" for r in report.orderBy("sku").collect()]


def estimate(n_tiles: int, n_keywords: int, n_sites: int, radii: Mapping[str, Sequence[int]], free: Mapping[str, int], price_per_1000: float = 10.0) -> dict:
    """Calls and cost of a plan: searches between one and three pages each, one detail call a site, one count call for
    each site, feature and radius."""
    per_site = sum(len(r) for r in radii.values())
    counts = n_sites * per_site
    over = max(0, counts - free["aggregate"])
    return {
        "search_min": n_tiles * n_keywords, "search_max": 3 * n_tiles * n_keywords, "details": n_sites, "aggregate": counts,
        "over": over, "cost": over / 1000 * price_per_1000, "free_sites": free["aggregate"] // per_site if per_site else None,
    }


def budget_line(name: str, used: int, cap: int) -> str:
    return f"{'✓' if used <= cap else '✗'} {name}: {used:,} / {cap:,}"
