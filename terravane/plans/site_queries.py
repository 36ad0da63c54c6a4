"""The site-selection operators over the driver's tables, and the same as DuckDB SQL.

The tables hold no places, so places are derived from keys by arithmetic that reads alike in both engines: customers
are sites, suppliers and parts are points around them, events are opening hours, orders are reviews.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, text
from ..functions.storage import written
from ..operators import answers, dedupe, discover, hours, metering, ranks, report, score, surround

# lat and lng of a key, in a box of a tenth of a degree
LAT = "13e0 + (({k} * 7919) % 10007) / 10007e0 * 0.1e0"
LNG = "100.9e0 + (({k} * 104729) % 10009) / 10009e0 * 0.1e0"
RADII = (500, 1500)

SITES_EXPR = [
    "c_custkey AS ord", "cast(c_custkey AS string) AS place_id", "concat('Site ', cast(c_custkey % 701 AS string)) AS name", f"{LAT.format(k='c_custkey')} AS lat", f"{LNG.format(k='c_custkey')} AS lng",
    "CASE c_custkey % 5 WHEN 0 THEN 'market' WHEN 1 THEN 'lodging' WHEN 2 THEN 'flea_market' WHEN 3 THEN 'store' ELSE '' END AS primary_type",
]
DETAILS_EXPR = ["place_id", "CASE WHEN ord % 11 = 0 THEN NULL ELSE 1 + (ord * 31 % 41) / 10e0 END AS rating"]

_SITES_SQL = f"""sites AS (
  SELECT c_custkey AS ord, CAST(c_custkey AS VARCHAR) AS place_id, 'Site ' || (c_custkey % 701) AS name, {LAT.format(k='c_custkey')} AS lat, {LNG.format(k='c_custkey')} AS lng,
    CASE c_custkey % 5 WHEN 0 THEN 'market' WHEN 1 THEN 'lodging' WHEN 2 THEN 'flea_market' WHEN 3 THEN 'store' ELSE '' END AS primary_type
  FROM customer)"""
_SHOPS_SQL = f"shops AS (SELECT p_partkey AS ord, p_name AS name, {LAT.format(k='(p_partkey + 17)')} AS lat, {LNG.format(k='(p_partkey + 17)')} AS lng, p_type AS category FROM part)"
_ESTATES_SQL = f"estates AS (SELECT s_suppkey AS ord, s_name AS name, {LAT.format(k='(s_suppkey + 5)')} AS lat, {LNG.format(k='(s_suppkey + 5)')} AS lng, s_acctbal AS workers FROM supplier)"
_D = "2 * 6371000e0 * asin(sqrt(least(1e0, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2))))"
_REVIEWED_SQL = "reviewed AS (SELECT s.*, CASE WHEN ord % 11 = 0 THEN NULL ELSE 1 + (ord * 31 % 41) / 10e0 END AS rating, n AS reviews FROM sites s LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = ord)"


def _even(x: str, places: int) -> str:
    return f"(round_even(({x}) * 1e{places}, 0) / 1e{places})"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer").selectExpr(*SITES_EXPR)


def shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "(p_partkey + 17)"
    return _read(spark, sf_dir, "part").selectExpr("p_partkey AS ord", "p_name AS name", f"{LAT.format(k=k)} AS lat", f"{LNG.format(k=k)} AS lng", "p_type AS category")


def estates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "(s_suppkey + 5)"
    return _read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS ord", "s_name AS name", f"{LAT.format(k=k)} AS lat", f"{LNG.format(k=k)} AS lng", "s_acctbal AS workers")


def reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites with rating and reviews (orders of the customer)."""
    n = _read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("ord")).agg(F.count("*").alias("reviews"))
    s = sites(spark, sf_dir)
    return s.withColumn("rating", F.expr(DETAILS_EXPR[1].rsplit(" AS ", 1)[0])).join(n, "ord", "left")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


_TILES = "SELECT i * 9 + j AS tile, CASE WHEN i = 0 THEN 12.55e0 ELSE round(12.55e0 + i * 0.1e0, 6) END AS south, CASE WHEN j = 0 THEN 100.78e0 ELSE round(100.78e0 + j * 0.1e0, 6) END AS west, CASE WHEN i = 10 THEN 13.62e0 ELSE round(12.55e0 + (i + 1) * 0.1e0, 6) END AS north, CASE WHEN j = 8 THEN 101.62e0 ELSE round(100.78e0 + (j + 1) * 0.1e0, 6) END AS east FROM (SELECT unnest(range(11)) AS i) CROSS JOIN (SELECT unnest(range(9)) AS j)"


@query(_TILES)
def site_tiles(spark, sf_dir):
    return geo.tiles(spark, 12.55, 13.62, 100.78, 101.62, 0.1)


@query(f"""WITH t AS ({_TILES})
SELECT tile, q AS quadrant, CASE WHEN q < 2 THEN south ELSE (south + north) / 2 END AS south, CASE WHEN q % 2 = 0 THEN west ELSE (west + east) / 2 END AS west,
  CASE WHEN q < 2 THEN (south + north) / 2 ELSE north END AS north, CASE WHEN q % 2 = 0 THEN (west + east) / 2 ELSE east END AS east
FROM t CROSS JOIN (SELECT CAST(unnest(range(4)) AS INTEGER) AS q)""")
def tile_quadrants(spark, sf_dir):
    return geo.subdivide(site_tiles(spark, sf_dir))


_GRID = (13.0, 13.1, 100.9, 101.0, 0.05)  # south, north, west, east, step
_DEPTH = 3


@query(f"""WITH RECURSIVE {_SITES_SQL}, boxes AS (
  SELECT i * 2 + j AS tile, '' AS path, 0 AS depth, CASE WHEN i = 0 THEN 13e0 ELSE 13.05e0 END AS south, CASE WHEN j = 0 THEN 100.9e0 ELSE 100.95e0 END AS west,
    CASE WHEN i = 0 THEN 13.05e0 ELSE 13.1e0 END AS north, CASE WHEN j = 0 THEN 100.95e0 ELSE 101e0 END AS east
  FROM (SELECT unnest(range(2)) AS i) CROSS JOIN (SELECT unnest(range(2)) AS j)
  UNION ALL
  SELECT tile, path || q, depth + 1, CASE WHEN q < 2 THEN south ELSE (south + north) / 2 END, CASE WHEN q % 2 = 0 THEN west ELSE (west + east) / 2 END,
    CASE WHEN q < 2 THEN (south + north) / 2 ELSE north END, CASE WHEN q % 2 = 0 THEN (west + east) / 2 ELSE east END
  FROM boxes CROSS JOIN (SELECT unnest(range(4)) AS q) WHERE depth < {_DEPTH}
), counted AS (
  SELECT b.tile, path, depth, south, west, north, east, count(s.ord) AS n FROM boxes b LEFT JOIN sites s
    ON s.lat >= south AND s.lng >= west AND (s.lat < north OR north = 13.1e0 AND s.lat = north) AND (s.lng < east OR east = 101e0 AND s.lng = east)
  GROUP BY ALL
), visited AS (
  SELECT * FROM counted WHERE depth = 0
  UNION ALL
  SELECT c.* FROM visited v JOIN counted c ON c.tile = v.tile AND c.depth = v.depth + 1 AND starts_with(c.path, v.path) WHERE v.n >= {discover.TILE_FULL}
)
SELECT *, CASE WHEN n < {discover.TILE_FULL} THEN 'leaf' WHEN depth < {_DEPTH} THEN 'split' ELSE 'capped' END AS state FROM visited""")
def adaptive_tiles(spark, sf_dir):
    """The tiles of a search over all sites that splits full ones."""
    return discover.adaptive_tiles(sites(spark, sf_dir), *_GRID, _DEPTH)


def _hits(spark, sf_dir):
    """A hit for each part: its place is one of a seventh as many, its keyword the first word of its name."""
    return _read(spark, sf_dir, "part").selectExpr("split(p_name, ' ')[0] AS keyword", "p_partkey AS seq", "concat('h', cast(p_partkey % 293 AS string)) AS place_id", "p_name AS name", "concat(p_brand, ' Road, ', p_type) AS address", "CASE WHEN p_partkey % 13 = 0 THEN 'CLOSED_PERMANENTLY' ELSE 'OPERATIONAL' END AS business_status")


_HITS_SQL = "hits AS (SELECT split_part(p_name, ' ', 1) AS keyword, p_partkey AS seq, 'h' || (p_partkey % 293) AS place_id, p_name AS name, p_brand || ' Road, ' || p_type AS address, CASE WHEN p_partkey % 13 = 0 THEN 'CLOSED_PERMANENTLY' ELSE 'OPERATIONAL' END AS business_status FROM part)"
_REASON_SQL = "CASE WHEN NOT (contains(lower(address), 'brand#1') OR contains(lower(address), 'small')) THEN 'outside_area' WHEN NOT regexp_matches(name, 'ring|bolt|gear|widget', 'i') OR regexp_matches(name, 'red', 'i') THEN 'name_filter' WHEN business_status = 'CLOSED_PERMANENTLY' THEN 'closed' END"


def _reasoned(spark, sf_dir):
    return _hits(spark, sf_dir).withColumn("reason", discover.reject_reason(["Brand#1", "SMALL"], "ring|bolt|gear|widget", "red"))


@query(f"WITH {_HITS_SQL} SELECT coalesce({_REASON_SQL}, 'good') AS reason, count(*) AS n FROM hits GROUP BY 1")
def hits_filter_reasons(spark, sf_dir):
    return _reasoned(spark, sf_dir).groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"""WITH {_HITS_SQL}, good AS (SELECT * FROM hits WHERE ({_REASON_SQL}) IS NULL)
SELECT place_id, arg_min(name, seq) AS name, arg_min(address, seq) AS address, arg_min(business_status, seq) AS business_status, string_agg(DISTINCT keyword, '|' ORDER BY keyword) AS keywords FROM good GROUP BY place_id""")
def hits_dedup_keywords(spark, sf_dir):
    return discover.merge_hits(_reasoned(spark, sf_dir).filter("reason is null").drop("reason"))


RULES = discover.KeepRules(("lodging", "parking"), "^Site [1-3]0", "7$", "Site 6", ("market", "flea_market"))
_RULES_SQL = """ruled AS (
  SELECT *, CASE WHEN primary_type IN ('lodging', 'parking') THEN 0 WHEN regexp_matches(name, '^Site [1-3]0', 'i') THEN 1 WHEN regexp_matches(name, '7$', 'i') THEN 0 WHEN primary_type IN ('market', 'flea_market') THEN 1 ELSE 0 END AS keep,
    CASE WHEN primary_type IN ('lodging', 'parking') THEN 'not a market: ' || primary_type WHEN regexp_matches(name, '^Site [1-3]0', 'i') THEN '' WHEN regexp_matches(name, '7$', 'i') THEN 'name looks like a shop branch/residence'
      WHEN primary_type IN ('market', 'flea_market') THEN '' ELSE 'not a market type: ' || coalesce(nullif(primary_type, ''), '(none)') END AS note
  FROM sites)"""


@query(f"WITH {_SITES_SQL}, {_RULES_SQL} SELECT place_id, keep, keep AS keep_auto, note FROM ruled")
def keep_rules(spark, sf_dir):
    return discover.keep_rules(sites(spark, sf_dir), RULES).select("place_id", "keep", "keep_auto", "note")


_OLD = ["place_id", "cast(CASE WHEN ord % 9 = 0 THEN NULL ELSE ord % 2 END AS string) AS keep", "CASE WHEN ord % 10 < 8 THEN 1 END AS keep_auto", "concat('old ', place_id) AS note", "ord"]


@query(f"""WITH {_SITES_SQL}, {_RULES_SQL}, old AS (SELECT ord, CASE WHEN ord % 9 = 0 THEN NULL ELSE ord % 2 END AS keep, CASE WHEN ord % 10 < 8 THEN 1 END AS keep_auto, 'old ' || place_id AS note FROM sites WHERE ord % 4 < 3)
SELECT place_id, CAST(CASE WHEN o.keep IS NOT NULL AND o.keep IS DISTINCT FROM o.keep_auto THEN o.keep ELSE r.keep END AS INTEGER) AS keep,
  CASE WHEN o.keep IS NOT NULL AND o.keep IS DISTINCT FROM o.keep_auto THEN o.note ELSE r.note END AS note, CAST(o.ord IS NULL AS INTEGER) AS is_new
FROM ruled r LEFT JOIN old o USING (ord)""")
def keep_carry_over(spark, sf_dir):
    s = sites(spark, sf_dir)
    return discover.carry_over(discover.keep_rules(s, RULES), s.filter("ord % 4 < 3").selectExpr(*_OLD)).select("place_id", "keep", "note", "is_new")


def _review(spark, sf_dir):
    """Two rows for some sites, of which the later counts."""
    s = sites(spark, sf_dir)
    first = s.filter("ord % 6 = 0").selectExpr("place_id", "'1' AS keep", "'first' AS note", "ord")
    return first.unionByName(s.filter("ord % 12 = 0 or ord % 7 = 0").selectExpr("place_id", "CASE WHEN ord % 2 = 0 THEN '0' ELSE 'x' END AS keep", "CASE WHEN ord % 3 = 0 THEN '' ELSE 'second' END AS note", "ord + 1000000000 AS ord"))


_REVIEW_SQL = """review AS (SELECT place_id, arg_max(keep, o) AS keep, arg_max(note, o) AS note FROM (
  SELECT place_id, 1 AS keep, 'first' AS note, ord AS o FROM sites WHERE ord % 6 = 0
  UNION ALL SELECT place_id, CASE WHEN ord % 2 = 0 THEN 0 ELSE -1 END, CASE WHEN ord % 3 = 0 THEN '' ELSE 'second' END, ord + 1000000000 FROM sites WHERE ord % 12 = 0 OR ord % 7 = 0) GROUP BY place_id),
final AS (SELECT place_id, CAST(coalesce(nullif(v.keep, -1), r.keep) AS INTEGER) AS keep, coalesce(nullif(v.note, ''), r.note) AS note FROM ruled r LEFT JOIN review v USING (place_id))"""


@query(f"WITH {_SITES_SQL}, {_RULES_SQL}, {_REVIEW_SQL} SELECT * FROM final")
def keep_review_override(spark, sf_dir):
    return discover.apply_review(discover.keep_rules(sites(spark, sf_dir), RULES), _review(spark, sf_dir)).select("place_id", "keep", "note")


@query(f"WITH {_SITES_SQL}, {_RULES_SQL}, {_REVIEW_SQL} SELECT place_id, note FROM final WHERE keep = 0")
def excluded_sites(spark, sf_dir):
    return discover.excluded_sites(keep_review_override(spark, sf_dir)).select("place_id", "note")


@query(f"WITH {_SITES_SQL}, {_RULES_SQL} SELECT coalesce(nullif(primary_type, ''), '(none)') AS primary_type, count(*) AS n, string_agg(name, ' · ' ORDER BY ord) FILTER (WHERE k <= 4) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY primary_type ORDER BY ord) AS k FROM ruled WHERE keep = 1) GROUP BY 1")
def type_report(spark, sf_dir):
    kept = discover.kept_sites(discover.keep_rules(sites(spark, sf_dir), RULES))
    return discover.type_report(kept.withColumn("primary_type", F.nullif("primary_type", F.lit(""))), order="ord")


@query(f"WITH {_HITS_SQL}, m AS (SELECT place_id, string_agg(DISTINCT keyword, '|' ORDER BY keyword) AS keywords FROM hits GROUP BY 1) SELECT keywords, count(*) AS n FROM m WHERE keywords <> '' AND NOT contains(keywords, '|') GROUP BY 1")
def single_keyword_report(spark, sf_dir):
    return discover.single_keyword_report(discover.merge_hits(_hits(spark, sf_dir)))


@query(f"WITH {_SITES_SQL}, {_RULES_SQL} SELECT note, count(*) AS n FROM ruled WHERE keep = 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def note_report(spark, sf_dir):
    return discover.note_report(discover.excluded_sites(discover.keep_rules(sites(spark, sf_dir), RULES)))


def _periods(spark, sf_dir):
    """Opening periods by user, of every event."""
    e = _read(spark, sf_dir, "events")
    e = e.withColumn("s", F.expr("(dayofweek(ts) - 1) * 1440 + hour(ts) * 60 + minute(ts)")).withColumn("e", F.expr("(s + 20 + (event_id * 37) % 630) % 10080"))
    point = lambda c: F.struct(F.expr(f"cast({c} div 1440 as int)").alias("day"), F.expr(f"cast({c} % 1440 div 60 as int)").alias("hour"), F.expr(f"cast({c} % 60 as int)").alias("minute"))
    return e.groupBy(F.col("user_id").cast("string").alias("place_id")).agg(F.collect_list(F.struct(point("s").alias("open"), point("e").alias("close"))).alias("periods"))


_DAY_COUNT = "sum(CASE WHEN n{k} >= 60 THEN 1 ELSE 0 END) / 7e0"


@query(f"""WITH p AS (SELECT CAST(user_id AS VARCHAR) AS place_id, dayofweek(ts) * 1440 + hour(ts) * 60 + minute(ts) AS s, 20 + (event_id * 37) % 630 AS n FROM events),
minutes AS (SELECT DISTINCT place_id, (s + i) % 10080 AS m FROM p, LATERAL (SELECT unnest(range(0, n)) AS i)),
days AS (SELECT place_id, d, count_if(m // 1440 = d) AS n0, count_if(m >= d * 1440 + 360 AND m < d * 1440 + 600) AS n1, count_if(m >= d * 1440 + 960 AND m < d * 1440 + 1200) AS n2,
    count_if((m - d * 1440 - 1200 + 20160) % 10080 < 360) AS n3 FROM minutes CROSS JOIN (SELECT unnest(range(7)) AS d) GROUP BY place_id, d)
SELECT place_id, 1 AS hours_known, {_DAY_COUNT.format(k=0)} AS days_open, string_agg(CASE WHEN n0 >= 60 THEN '1' ELSE '0' END, '' ORDER BY d) AS open_days,
  {_DAY_COUNT.format(k=1)} AS open_morning, {_DAY_COUNT.format(k=2)} AS open_evening, {_DAY_COUNT.format(k=3)} AS open_night FROM days GROUP BY place_id""")
def hours_features(spark, sf_dir):
    return hours.hours_features(_periods(spark, sf_dir), "place_id")


@query(f"""WITH p AS (SELECT CAST(user_id AS VARCHAR) AS place_id, dayofweek(ts) * 1440 + hour(ts) * 60 + minute(ts) AS s, 20 + (event_id * 37) % 630 AS n FROM events),
minutes AS (SELECT DISTINCT place_id, (s + i) % 10080 AS m FROM p, LATERAL (SELECT unnest(range(0, n)) AS i)),
days AS (SELECT place_id, m // 1440 AS d FROM minutes GROUP BY 1, 2 HAVING count(*) >= 60)
SELECT place_id, coalesce(string_agg(['{"', '".join(text.DAY_LETTERS)}'][CAST(d + 1 AS BIGINT)], ' ' ORDER BY d), '') AS letters FROM (SELECT DISTINCT place_id FROM p) LEFT JOIN days USING (place_id) GROUP BY place_id""")
def open_day_letters(spark, sf_dir):
    return hours_features(spark, sf_dir).select("place_id", text.day_letters(F.col("open_days")).alias("letters"))


def _all_periods(spark, sf_dir):
    """Opening periods of every event; a site is a user and a day of the month, so that sites are not open all week."""
    e = _read(spark, sf_dir, "events")
    e = e.withColumn("s", F.expr("(dayofweek(ts) - 1) * 1440 + hour(ts) * 60 + minute(ts)")).withColumn("e", F.expr("(s + 20 + (event_id * 37) % 630) % 10080"))
    point = lambda c: F.struct(F.expr(f"cast({c} div 1440 as int)").alias("day"), F.expr(f"cast({c} % 1440 div 60 as int)").alias("hour"), F.expr(f"cast({c} % 60 as int)").alias("minute"))
    site = F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "dd"))
    return e.groupBy(site.alias("place_id")).agg(F.collect_list(F.struct(point("s").alias("open"), point("e").alias("close"))).alias("periods"))


_ALL_MINUTES_SQL = """p AS (SELECT user_id || '-' || strftime(ts, '%d') AS place_id, dayofweek(ts) * 1440 + hour(ts) * 60 + minute(ts) AS s, 20 + (event_id * 37) % 630 AS n FROM events),
minutes AS (SELECT DISTINCT place_id, (s + i) % 10080 AS m FROM p, LATERAL (SELECT unnest(range(0, n)) AS i))"""


@query(f"""WITH {_ALL_MINUTES_SQL}, days AS (SELECT place_id, d, count_if(m // 1440 = d) AS n0, count_if(m >= d * 1440 + 360 AND m < d * 1440 + 600) AS n1, count_if(m >= d * 1440 + 960 AND m < d * 1440 + 1200) AS n2,
    count_if((m - d * 1440 - 1200 + 20160) % 10080 < 360) AS n3 FROM minutes CROSS JOIN (SELECT unnest(range(7)) AS d) GROUP BY place_id, d)
SELECT place_id, 1 AS hours_known, {_DAY_COUNT.format(k=0)} AS days_open, string_agg(CASE WHEN n0 >= 60 THEN '1' ELSE '0' END, '' ORDER BY d) AS open_days,
  {_DAY_COUNT.format(k=1)} AS open_morning, {_DAY_COUNT.format(k=2)} AS open_evening, {_DAY_COUNT.format(k=3)} AS open_night FROM days GROUP BY place_id""")
def hours_of_all_events(spark, sf_dir):
    return hours.hours_features(_all_periods(spark, sf_dir), "place_id")


@query(f"""WITH {_ALL_MINUTES_SQL}, days AS (SELECT place_id, m // 1440 AS d FROM minutes GROUP BY 1, 2 HAVING count(*) >= 60)
SELECT place_id, coalesce(string_agg(['{"', '".join(text.DAY_LETTERS)}'][CAST(d + 1 AS BIGINT)], ' ' ORDER BY d), '') AS letters FROM (SELECT DISTINCT place_id FROM p) LEFT JOIN days USING (place_id) GROUP BY place_id""")
def day_letters_of_all_events(spark, sf_dir):
    return hours_of_all_events(spark, sf_dir).select("place_id", text.day_letters(F.col("open_days")).alias("letters"))


@query(f"""WITH {_SITES_SQL}, {_RULES_SQL}, {_REVIEW_SQL} SELECT place_id, keep, note FROM final WHERE keep <> 0""")
def sites_after_review(spark, sf_dir):
    """What each stage reads: the review file applied, then the kept ones."""
    return discover.kept_sites(keep_review_override(spark, sf_dir))


_FEW_HITS_SQL = """few AS (SELECT split_part(p_name, ' ', 1) AS keyword, 'h' || (p_partkey * 7 // 11) AS place_id FROM part),
found AS (SELECT place_id, string_agg(DISTINCT keyword, '|' ORDER BY keyword) AS keywords FROM few GROUP BY 1)"""


@query(f"WITH {_FEW_HITS_SQL} SELECT keywords, count(*) AS n FROM found WHERE keywords <> '' AND NOT contains(keywords, '|') GROUP BY 1")
def single_keyword_places(spark, sf_dir):
    """As single_keyword_report, where a place has one or two hits."""
    hits = _hits(spark, sf_dir).withColumn("place_id", F.expr("concat('h', cast(seq * 7 div 11 as string))"))
    return discover.single_keyword_report(discover.merge_hits(hits))


def _around_sql(pois: str, value: str, radii=RADII) -> str:
    return ", ".join(f"{value.format(r=r)} AS v{r}" for r in radii)


@query(f"""WITH {_SITES_SQL}, {_SHOPS_SQL}, near AS (SELECT a.place_id, {_D} AS d FROM sites a CROSS JOIN shops b), c AS (SELECT place_id, {', '.join(f'CAST(count_if(d <= {r}) AS DOUBLE) AS v{r}' for r in RADII)} FROM near GROUP BY place_id)
{' UNION ALL '.join(f"SELECT place_id, 'shop_{r}' AS col, v{r} AS value FROM c" for r in RADII)}""")
def radius_count(spark, sf_dir):
    return surround.radius_measures(sites(spark, sf_dir), shops(spark, sf_dir).drop("category"), RADII, "shop")


@query(f"""WITH {_SITES_SQL}, {_ESTATES_SQL}, near AS (SELECT a.place_id, b.workers, {_D} AS d FROM sites a CROSS JOIN estates b)
SELECT place_id, 'workers_3000' AS col, {_even('coalesce(sum(workers) FILTER (WHERE d <= 3000), 0)', 2)} AS value FROM near GROUP BY place_id""")
def radius_sum(spark, sf_dir):
    found = surround.radius_measures(sites(spark, sf_dir), estates(spark, sf_dir), (3000,), "workers", "workers")
    return found.withColumn("value", text.half_even(F.col("value"), 2))


@query(f"""WITH {_SITES_SQL}, {_SHOPS_SQL}, near AS (SELECT a.place_id, lower(b.category) AS cat, {_D} AS d FROM sites a CROSS JOIN shops b), c AS (SELECT place_id, cat, {', '.join(f'CAST(count_if(d <= {r}) AS DOUBLE) AS v{r}' for r in RADII)} FROM near GROUP BY place_id, cat)
{' UNION ALL '.join(f"SELECT place_id, 'shop_' || cat || '_{r}' AS col, v{r} AS value FROM c UNION ALL SELECT place_id, 'shop_{r}', sum(v{r}) FROM c GROUP BY place_id" for r in RADII)}""")
def radius_category(spark, sf_dir):
    return surround.radius_measures(sites(spark, sf_dir), shops(spark, sf_dir), RADII, "shop")


@query(f"""WITH {_SITES_SQL}, {_SHOPS_SQL}, near AS (SELECT a.place_id, lower(b.category) AS feature, {_D} AS d FROM sites a CROSS JOIN shops b WHERE b.category IN ('SMALL', 'PROMO')), c AS (SELECT place_id, feature, {', '.join(f'CAST(count_if(d <= {r}) AS DOUBLE) AS v{r}' for r in RADII)} FROM near GROUP BY place_id, feature)
{' UNION ALL '.join(f"SELECT place_id, feature || '_{r}' AS col, v{r} AS value FROM c" for r in RADII)}""")
def layer_counts(spark, sf_dir):
    points = shops(spark, sf_dir).select("lat", "lng", F.lower("category").alias("feature"))
    return surround.layer_measures(sites(spark, sf_dir), points, ["small", "promo"], RADII)


@query(f"""WITH {_SITES_SQL}, {_SHOPS_SQL}, near AS (SELECT a.place_id, b.*, {_D} AS d FROM sites a CROSS JOIN shops b), r AS (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY d, ord) AS pos FROM near WHERE d <= 1500)
SELECT place_id, 'shop_1500' AS col, CAST(pos AS INTEGER) AS pos, name, CAST(round_even(d, 0) AS INTEGER) AS metres, CAST(NULL AS DOUBLE) AS extra, round(lat, 6) AS lat, round(lng, 6) AS lng FROM r WHERE pos <= 50""")
def nearest_items_topk(spark, sf_dir):
    return surround.nearest_items(sites(spark, sf_dir), shops(spark, sf_dir).drop("category"), (1500,), "shop")


@query(f"WITH {_SITES_SQL} SELECT a.place_id AS place_id_a, b.place_id AS place_id_b, CAST(round_even({_D}, 0) AS INTEGER) AS metres FROM sites a JOIN sites b ON a.ord < b.ord WHERE {_D} <= 150")
def near_duplicate_pairs(spark, sf_dir):
    pairs = dedupe.near_pairs(sites(spark, sf_dir), 150.0, ("place_id",))
    return pairs.select("place_id_a", "place_id_b", F.rint("d").cast("int").alias("metres"))


_GROUPS_SQL = f"""edges AS (SELECT a.ord AS x, b.ord AS y FROM reviewed a JOIN reviewed b ON a.ord < b.ord WHERE {_D} <= 150),
links AS (SELECT x, y FROM edges UNION SELECT y, x FROM edges),
reach AS (SELECT ord AS node, ord AS root FROM reviewed UNION SELECT b.y, r.root FROM reach r JOIN links b ON b.x = r.node),
grouped AS (SELECT r.*, g.root FROM reviewed r JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) g ON g.node = r.ord),
picked AS (SELECT *, first_value(ord) OVER (PARTITION BY root ORDER BY coalesce(reviews, -1) DESC, ord) AS rep FROM grouped)"""
_MERGED_SQL = f"""merged AS (SELECT root AS ord, max(CASE WHEN ord = rep THEN place_id END) AS place_id, max(CASE WHEN ord = rep THEN name END) AS name, max(CASE WHEN ord = rep THEN lat END) AS lat, max(CASE WHEN ord = rep THEN lng END) AS lng, CAST(sum(reviews) AS BIGINT) AS reviews,
  CASE WHEN sum(reviews) FILTER (WHERE rating IS NOT NULL AND reviews > 0) > 0 THEN {_even("sum(rating * reviews) FILTER (WHERE rating IS NOT NULL AND reviews > 0) / sum(reviews) FILTER (WHERE rating IS NOT NULL AND reviews > 0)", 2)} ELSE max(CASE WHEN ord = rep THEN rating END) END AS rating,
  CAST(count(*) - 1 AS INTEGER) AS dup_count, coalesce(string_agg(name, ' | ' ORDER BY ord) FILTER (WHERE ord <> rep), '') AS dup_names, coalesce(string_agg(place_id, ' | ' ORDER BY ord) FILTER (WHERE ord <> rep), '') AS dup_ids FROM picked GROUP BY root)"""
_MERGED_COLUMNS = ["ord", "place_id", "name", "lat", "lng", "reviews", "rating", "dup_count", "dup_names", "dup_ids"]


@query(f"WITH RECURSIVE {_SITES_SQL}, {_REVIEWED_SQL}, {_GROUPS_SQL}, {_MERGED_SQL} SELECT * FROM merged")
def dedupe_same_site(spark, sf_dir):
    return dedupe.dedupe(reviewed(spark, sf_dir), 150, 150, by_name=False).select(*_MERGED_COLUMNS)


def _norm_sql(name: str) -> str:
    return f"regexp_replace(regexp_replace(lower(coalesce({name}, '')), '{'|'.join(text.GENERIC_WORDS)}', ' ', 'g'), '[^0-9a-zก-๙]+', '', 'g')"


def _similar_sql(places: str) -> str:
    """Tables up to edges (x, y): places (ord, name, lat, lng) within 150 m of like names, by the rule of the longest match:
    of two names the longest common run, the first of several, and then the same to its left and its right."""
    return f"""near_by AS (SELECT a.ord AS x, b.ord AS y, {_norm_sql("a.name")} AS p, {_norm_sql("b.name")} AS q, {_D} AS d FROM {places} a JOIN {places} b ON a.ord < b.ord WHERE {_D} <= 150),
names AS (SELECT DISTINCT p, q FROM near_by WHERE p <> '' AND q <> ''),
spots AS (SELECT p, q, i, unnest(range(1, len(q) + 1)) AS j FROM (SELECT p, q, unnest(range(1, len(p) + 1)) AS i FROM names)),
runs AS (SELECT p, q, i, j, list_max(list_filter(range(1, least(len(p) - i, len(q) - j) + 2), lambda k: p[i:i + k - 1] = q[j:j + k - 1])) AS k FROM spots WHERE p[i] = q[j]),
parts AS (
  SELECT p, q, 1 AS a, len(p) + 1 AS b, 1 AS c, len(q) + 1 AS d FROM names
  UNION ALL
  SELECT p, q, CASE side WHEN 0 THEN a ELSE m.i + m.k END, CASE side WHEN 0 THEN m.i ELSE b END, CASE side WHEN 0 THEN c ELSE m.j + m.k END, CASE side WHEN 0 THEN m.j ELSE d END
  FROM (SELECT s.p, s.q, a, b, c, d, arg_max({{'i': i, 'j': j, 'k': least(k, b - i, d - j)}}, least(k, b - i, d - j) * 1000000 - i * 1000 - j) AS m
    FROM parts s JOIN runs r ON r.p = s.p AND r.q = s.q AND i >= a AND i < b AND j >= c AND j < d GROUP BY s.p, s.q, a, b, c, d) CROSS JOIN (SELECT unnest([0, 1]) AS side)),
matched AS (SELECT p, q, sum(k) AS k FROM (SELECT s.p, s.q, a, b, c, d, max(least(k, b - i, d - j)) AS k FROM parts s JOIN runs r ON r.p = s.p AND r.q = s.q AND i >= a AND i < b AND j >= c AND j < d GROUP BY ALL) GROUP BY p, q),
alike AS (SELECT n.p, n.q, len(n.p) >= 3 AND len(n.q) >= 3 AND (contains(n.p, n.q) OR contains(n.q, n.p)) OR 2e0 * coalesce(k, 0) / (len(n.p) + len(n.q)) >= 0.6e0 AS alike FROM names n LEFT JOIN matched m ON m.p = n.p AND m.q = n.q)"""


_NEAR_SHOPS_SQL = "near_shops AS (SELECT ord, name, lat, lng FROM shops)"


_GLOBE = {"lat": "(({k} * 7919) % 18001) / 100e0 - 90e0", "lng": "(({k} * 104729) % 36001) / 100e0 - 180e0"}
_GLOBE_RADIUS = 90_000


@query(f"""WITH a AS (SELECT c_custkey AS a, {_GLOBE["lat"].format(k="c_custkey")} AS lat, {_GLOBE["lng"].format(k="c_custkey")} AS lng FROM customer),
b AS (SELECT p_partkey AS b, {_GLOBE["lat"].format(k="(p_partkey + 17)")} AS lat, {_GLOBE["lng"].format(k="(p_partkey + 17)")} AS lng FROM part)
SELECT a, b, CAST(round_even({_D}, 0) AS INTEGER) AS metres FROM a JOIN b ON {_D} <= {_GLOBE_RADIUS}""")
def radius_pairs_global(spark, sf_dir):
    """Customers and parts within 90 km, spread over the globe, its poles and the antimeridian."""
    spread = lambda t, key, name, k: _read(spark, sf_dir, t).selectExpr(f"{key} AS {name}", *(f"{e.format(k=k)} AS {c}" for c, e in _GLOBE.items()))
    pairs = geo.radius_pairs(spread("customer", "c_custkey", "a", "c_custkey"), spread("part", "p_partkey", "b", "(p_partkey + 17)"), float(_GLOBE_RADIUS))
    return pairs.select("a", "b", F.rint("d").cast("int").alias("metres"))


@query(f"""WITH RECURSIVE {_SHOPS_SQL}, {_NEAR_SHOPS_SQL}, {_similar_sql("near_shops")}
SELECT x AS a, y AS b FROM near_by LEFT JOIN alike USING (p, q) WHERE d <= 20 OR alike""")
def similar_name_edges(spark, sf_dir):
    """Shops within 20 m of each other, or within 150 m with names that mean the same."""
    return dedupe.same_place_edges(shops(spark, sf_dir).select("ord", "name", "lat", "lng"), 20, 150)


_REST_SQL = _GROUPS_SQL.split("\n", 1)[1]  # all but the edges


@query(f"""WITH RECURSIVE {_SITES_SQL}, {_REVIEWED_SQL}, {_similar_sql("reviewed")},
edges AS (SELECT x, y FROM near_by LEFT JOIN alike USING (p, q) WHERE d <= 40 OR alike),
{_REST_SQL}, {_MERGED_SQL} SELECT * FROM merged""")
def dedupe_similar_name(spark, sf_dir):
    return dedupe.dedupe(reviewed(spark, sf_dir), 40, 150).select(*_MERGED_COLUMNS)


@query(f"WITH RECURSIVE {_SITES_SQL}, {_REVIEWED_SQL}, {_GROUPS_SQL}, {_MERGED_SQL} SELECT CAST(count_if(dup_count > 0) AS BIGINT) AS n_sites, CAST(sum(dup_count) AS BIGINT) AS n_listings FROM merged")
def merge_summary(spark, sf_dir):
    return report.merge_summary(dedupe_same_site(spark, sf_dir))


_BAYES_SQL = f"rated AS (SELECT *, ln(1 + CAST(reviews AS DOUBLE)) AS reviews_log, {_even('(30e0 * (SELECT coalesce(avg(rating), 0) FROM reviewed) + coalesce(reviews, 0) * rating) / (30e0 + coalesce(reviews, 0))', 6)} AS rating_adj FROM reviewed)"


@query(f"WITH {_SITES_SQL}, {_REVIEWED_SQL}, {_BAYES_SQL} SELECT place_id, {_even('reviews_log', 6)} AS reviews_log, rating_adj FROM rated")
def bayes_rating(spark, sf_dir):
    return score.with_ratings(reviewed(spark, sf_dir)).select("place_id", text.half_even(F.col("reviews_log"), 6).alias("reviews_log"), "rating_adj")


def _pct(v: str) -> str:
    """Mean rank by number of values; null stays null."""
    return f"CASE WHEN {v} IS NOT NULL THEN (rank() OVER (ORDER BY {v}) - 1 + (count(*) OVER (PARTITION BY {v}) + 1) / 2e0) / count({v}) OVER () END"


def _features(spark, sf_dir):
    """Sites with ratings, shops and workers around them."""
    facts = radius_count(spark, sf_dir).unionByName(radius_sum(spark, sf_dir))
    s = score.with_ratings(reviewed(spark, sf_dir))
    df = s.join(surround.pivot_wide(s, facts, FACTS), "place_id").withColumn("size", F.expr("CASE WHEN ord % 3 = 0 THEN NULL ELSE ord * 7 % 13 END"))
    return written(df, "site-features")  # reports read it several times


FACTS = ["shop_500", "shop_1500", "workers_3000"]
_FEATURES_SQL = f"""{_SITES_SQL}, {_SHOPS_SQL}, {_ESTATES_SQL}, {_REVIEWED_SQL}, {_BAYES_SQL},
s_near AS (SELECT a.place_id, {_D} AS d FROM sites a CROSS JOIN shops b), s_count AS (SELECT place_id, CAST(count_if(d <= 500) AS DOUBLE) AS shop_500, CAST(count_if(d <= 1500) AS DOUBLE) AS shop_1500 FROM s_near GROUP BY 1),
e_near AS (SELECT a.place_id, b.workers, {_D} AS d FROM sites a CROSS JOIN estates b), e_sum AS (SELECT place_id, {_even('coalesce(sum(workers) FILTER (WHERE d <= 3000), 0)', 2)} AS workers_3000 FROM e_near GROUP BY 1),
features AS (SELECT *, CASE WHEN ord % 3 = 0 THEN NULL ELSE ord * 7 % 13 END AS size FROM rated JOIN s_count USING (place_id) JOIN e_sum USING (place_id))"""


@query(f"WITH {_FEATURES_SQL} SELECT place_id, shop_500, shop_1500, workers_3000 FROM features")
def feature_pivot_wide(spark, sf_dir):
    return _features(spark, sf_dir).select("place_id", *FACTS)


@query(f"WITH {_FEATURES_SQL} SELECT place_id, {_pct('rating_adj')} AS rating_adj, {_pct('size')} AS size, {_pct('shop_500')} AS shop_500 FROM features")
def measure_percentile(spark, sf_dir):
    return ranks.percentiles(_features(spark, sf_dir), "place_id", ["rating_adj", "size", "shop_500"])


def _scaled(v: str) -> str:
    return f"coalesce(CASE WHEN max({v}) OVER () > min({v}) OVER () THEN ({v} - min({v}) OVER ()) / (max({v}) OVER () - min({v}) OVER ()) END, 0.5e0)"


@query(f"WITH {_SITES_SQL}, {_REVIEWED_SQL}, f AS (SELECT *, CAST(reviews AS DOUBLE) AS n, 1e0 AS same FROM reviewed) SELECT place_id, {_scaled('n')} AS n, {_scaled('rating')} AS rating, {_scaled('same')} AS same FROM f")
def measure_minmax(spark, sf_dir):
    df = reviewed(spark, sf_dir).select("place_id", F.col("reviews").cast("double").alias("n"), "rating", F.lit(1.0).alias("same"))
    return score.min_max(df, ["n", "rating", "same"])


PILLARS = {
    "market": score.Pillar({"rating": 1, "size": 2}, 2, "popular", "known"),
    "activity": score.Pillar({"shop_500": 2, "shop_1500": -1, "absent": 3}, 1, "busy", "busy area"),
    "workers": score.Pillar({"workers_3000": 1}, 1, "work"),
    "unused": score.Pillar({"shop_500": 1}, 0, "unused", "never"),
}
_RANKED_SQL = f"""{_FEATURES_SQL}, v AS (SELECT place_id, coalesce({_pct('rating_adj')}, 0.5e0) AS a, coalesce({_scaled('CAST(size AS DOUBLE)')}, 0.5e0) AS b, {_pct('shop_500')} AS c, {_pct('shop_1500')} AS d, {_pct('workers_3000')} AS e FROM features),
p AS (SELECT place_id, (a * 1e0 + b * 2e0) / 3e0 AS market, (c * 2e0 + d * -1e0) / 3e0 AS activity, (e * 1e0) / 1e0 AS workers FROM v),
s AS (SELECT *, {_even('((market * 2e0 + activity * 1e0) + workers * 1e0) / 4e0 * 100', 1)} AS score FROM p),
t AS (SELECT *, {_pct('score')} AS sp, {_pct('market')} AS mp, {_pct('activity')} AS ap FROM s),
c AS (SELECT place_id, string_agg(label, ', ' ORDER BY x DESC, i) AS why FROM (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY x DESC, i) AS k FROM (
  SELECT place_id, market * 2e0 AS x, 0 AS i, 'known' AS label FROM p UNION ALL SELECT place_id, activity * 1e0, 1, 'busy area' FROM p UNION ALL SELECT place_id, workers * 1e0, 2, 'work' FROM p)) WHERE k <= 2 GROUP BY place_id),
ranked AS (SELECT row_number() OVER (ORDER BY score DESC, place_id) AS rank, place_id, score, {_even('market * 100', 1)} AS pillar_market, {_even('activity * 100', 1)} AS pillar_activity, {_even('workers * 100', 1)} AS pillar_workers,
  concat_ws(', ', CASE WHEN mp >= 1 - 30 / 100e0 THEN 'known' END, CASE WHEN ap >= 1 - 30 / 100e0 THEN 'busy area' END) AS profile, why,
  CASE WHEN sp >= 0.9e0 THEN 'A' WHEN sp >= 0.7e0 THEN 'B' WHEN sp >= 0.4e0 THEN 'C' ELSE 'D' END AS tier FROM t JOIN c USING (place_id))"""
_RANKED = ["rank", "place_id", "score", "pillar_market", "pillar_activity", "pillar_workers", "profile", "why", "tier"]


@query(f"WITH {_RANKED_SQL} SELECT * FROM ranked")
def ranked_sites(spark, sf_dir):
    return score.score(_features(spark, sf_dir), PILLARS, 30, {"size": "minmax"}, log=lambda _: None).select(*_RANKED)


@query(f"WITH {_RANKED_SQL} SELECT place_id, pillar_market, pillar_activity, pillar_workers, score FROM ranked")
def pillar_score(spark, sf_dir):
    return ranked_sites(spark, sf_dir).select("place_id", "pillar_market", "pillar_activity", "pillar_workers", "score")


@query(f"WITH {_RANKED_SQL} SELECT place_id, tier, profile, why FROM ranked")
def tier_profile_why(spark, sf_dir):
    return ranked_sites(spark, sf_dir).select("place_id", "tier", "profile", "why")


@query(f"WITH {_RANKED_SQL} SELECT r.place_id, rank <= 50 AS is_top, CASE WHEN score >= 75 THEN '#1a9850' WHEN score >= 55 THEN '#91cf60' WHEN score >= 40 THEN '#fee08b' ELSE '#d73027' END AS band, CAST(CASE WHEN rank <= 50 THEN 9 ELSE 4 END AS INTEGER) AS radius FROM ranked r")
def map_markers(spark, sf_dir):
    top = F.col("rank") <= 50
    return ranked_sites(spark, sf_dir).select("place_id", top.alias("is_top"), text.score_band(F.col("score")).alias("band"), F.when(top, 9).otherwise(4).alias("radius"))


@query(f"WITH {_SITES_SQL} SELECT {_even('avg(lat)', 6)} AS lat, {_even('avg(lng)', 6)} AS lng FROM sites")
def map_centre(spark, sf_dir):
    return sites(spark, sf_dir).agg(text.half_even(F.avg("lat"), 6).alias("lat"), text.half_even(F.avg("lng"), 6).alias("lng"))


_QA_COLS = ["rating", "size", "shop_500", "workers_3000"]


@query(f"WITH {_FEATURES_SQL} " + " UNION ALL ".join(f"SELECT '{c}' AS measure, count(*) AS n, count(*) - count({c}) AS n_null, CAST(count_if({c} = 0) AS BIGINT) AS n_zero, " + ", ".join(f"{_even(f'quantile_cont(CAST({c} AS DOUBLE), {p})', 2)} AS \"{n}\"" for p, n in zip(report.POINTS, report.NAMES, strict=True)) + " FROM features" for c in _QA_COLS))
def qa_distribution(spark, sf_dir):
    return report.distribution(_features(spark, sf_dir), _QA_COLS)


@query(f"WITH {_FEATURES_SQL} SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS measure, avg(CASE WHEN {c} = 0 THEN 1e0 ELSE 0e0 END) AS share FROM features" for c in ["size", "shop_500", "workers_3000"]) + ") WHERE share >= 0.05e0")
def qa_mostly_zero(spark, sf_dir):
    return report.mostly_zero(_features(spark, sf_dir), ["size", "shop_500", "workers_3000"], 0.05)


@query(f"WITH {_FEATURES_SQL} SELECT measure, CAST(pos AS INTEGER) AS pos, place_id, value FROM (SELECT *, row_number() OVER (PARTITION BY measure ORDER BY value DESC, place_id) AS pos FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS measure, place_id, CAST({c} AS DOUBLE) AS value FROM features WHERE {c} IS NOT NULL" for c in _QA_COLS) + ")) WHERE pos <= 8")
def qa_top_values(spark, sf_dir):
    return report.top_values(_features(spark, sf_dir), _QA_COLS)


@query(f"WITH {_SITES_SQL} SELECT lower(trim(name)) AS name, count(*) AS n FROM sites GROUP BY 1 HAVING count(*) > 1")
def qa_same_name(spark, sf_dir):
    return report.same_names(sites(spark, sf_dir))


def _spearman_sql(a: str, b: str) -> str:
    rank = lambda v: f"(rank() OVER (ORDER BY {v}) + (count(*) OVER (PARTITION BY {v}) - 1) / 2e0)"
    return f"SELECT '{a}' AS a, '{b}' AS b, {_even('corr(x, y)', 6)} AS r FROM (SELECT {rank(a)} AS x, {rank(b)} AS y FROM features WHERE {a} IS NOT NULL AND {b} IS NOT NULL) HAVING (SELECT " + " AND ".join(f"count({v}) > 10 AND count(DISTINCT {v}) > 2" for v in (a, b)) + " FROM features)"


@query(f"WITH {_FEATURES_SQL} " + " UNION ALL ".join(_spearman_sql(a, b) for i, a in enumerate(_QA_COLS) for b in _QA_COLS[i + 1 :]))
def qa_spearman(spark, sf_dir):
    return report.spearman(_features(spark, sf_dir), _QA_COLS).withColumn("r", text.half_even(F.col("r"), 6))


@query("""WITH used AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS sku, count(*) AS n FROM orders GROUP BY 1, 2), now AS (SELECT sku, CAST(sum(n) AS BIGINT) AS used FROM (SELECT month, sku, n FROM used UNION ALL SELECT '1996-03', '1-URGENT', 40) WHERE month = '1996-03' GROUP BY 1),
caps AS (SELECT * FROM (VALUES ('1-URGENT', 60), ('2-HIGH', 20), ('9-NONE', 10)) t(sku, cap))
SELECT sku, coalesce(used, 0) AS used, CAST(coalesce(cap, -1) AS BIGINT) AS cap, CAST(greatest(cap - coalesce(used, 0), 0) AS BIGINT) AS remaining, coalesce(coalesce(used, 0) < cap, true) AS allowed FROM now FULL JOIN caps USING (sku)""".replace("CAST(greatest(cap - coalesce(used, 0), 0) AS BIGINT)", "CASE WHEN cap IS NULL THEN 0 ELSE CAST(greatest(cap - coalesce(used, 0), 0) AS BIGINT) END"))
def usage_ledger(spark, sf_dir):
    recorded = _read(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderpriority").alias("sku")).agg(F.count("*").alias("n"))
    caps = spark.createDataFrame([("1-URGENT", 60), ("2-HIGH", 20), ("9-NONE", 10)], "sku string, cap long")
    return metering.usage(recorded, caps, "1996-03", spark.createDataFrame([("1996-03", "1-URGENT", 40), ("1996-04", "2-HIGH", 4)], "month string, sku string, n long")).withColumns({"remaining": F.coalesce("remaining", F.lit(0)), "cap": F.coalesce("cap", F.lit(-1))})


@query(f"WITH t AS ({_TILES}), s AS (SELECT count(*) AS n FROM customer) SELECT (SELECT count(*) FROM t) * 8 AS search_min, (SELECT count(*) FROM t) * 24 AS search_max, n AS details, n * 6 AS aggregate, greatest(0, n * 6 - 5000) AS over, greatest(0, n * 6 - 5000) / 1000e0 * 10e0 AS cost, CAST(833 AS BIGINT) AS free_sites FROM s")
def call_estimate(spark, sf_dir):
    plan = metering.estimate(site_tiles(spark, sf_dir).count(), 8, _read(spark, sf_dir, "customer").count(), {k: [500] for k in "abcdef"}, {"aggregate": 5000})
    return spark.createDataFrame([plan], "search_min long, search_max long, details long, aggregate long, over long, cost double, free_sites long")


_LONG = "concat(p_name, '-Market ', p_brand, ' ตลาดนัด (', p_type, ')')"


@query(f"""WITH t AS (SELECT p_partkey, {_LONG} AS x FROM part) SELECT p_partkey, coalesce(nullif(lower(trim(regexp_replace(x, '[^0-9a-zA-Zก-๙]+', '_', 'g'), '_')), ''), 'other') AS slug,
  regexp_replace(regexp_replace(lower(x), '{"|".join(text.GENERIC_WORDS)}', ' ', 'g'), '[^0-9a-zก-๙]+', '', 'g') AS norm FROM t""")
def slug_norm_name(spark, sf_dir):
    name = F.expr(_LONG)
    return _read(spark, sf_dir, "part").select("p_partkey", text.slug(name).alias("slug"), text.normal_name(name).alias("norm"))


_PLACE_NAMES = ["Night Market", "ตลาดนัดวัด", "walking street", "ตลาดเช้า", "Plaza", "โต้รุ่ง"]
_ADDRESSES = ["1 Road, Si Racha, Chonburi", "2 ถนน อำเภอ ปลวกแดง ระยอง", "3 Road, Klaeng District, Rayong", "4 Pattaya", "nowhere", "5 อ.เมือง ชลบุรี"]


def _case_sql(c: str, rules: list[tuple[str, str]], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {cond.format(c=c)} THEN {value}" for cond, value in rules) + f" ELSE {other} END"


@query("WITH t AS (SELECT c_custkey, {names}[CAST(c_custkey % 6 + 1 AS BIGINT)] AS name, {addresses}[CAST(c_custkey % 6 + 1 AS BIGINT)] AS address FROM customer) SELECT c_custkey, {kind} AS kind, {district} AS district FROM t".format(
    names=str(_PLACE_NAMES), addresses=str(_ADDRESSES), kind=_case_sql("name", [(f"regexp_matches({{c}}, '{p}', 'i')", f"'{k}'") for p, k in text.KINDS], f"'{text.OTHER_KIND}'"),
    district=_case_sql("address", [*((" OR ".join(f"contains(lower({{c}}), '{a}')" for a in aliases), f"'{d}'") for d, aliases in text.DISTRICTS), (r"regexp_extract({c}, '(?:อำเภอ|อ\.)\s*([^\s,]+)', 1) <> ''", r"regexp_extract(address, '(?:อำเภอ|อ\.)\s*([^\s,]+)', 1)"), ("regexp_extract({c}, '([A-Za-z][A-Za-z ]+?) District', 1) <> ''", "trim(regexp_extract(address, '([A-Za-z][A-Za-z ]+?) District', 1))")], f"'{text.NO_DISTRICT}'")))
def kind_district(spark, sf_dir):
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("c_custkey") % 6 + 1).cast("int"))
    return _read(spark, sf_dir, "customer").select("c_custkey", text.market_kind(pick(_PLACE_NAMES)).alias("kind"), text.district(pick(_ADDRESSES)).alias("district"))


@query(f"""WITH {_SITES_SQL}, {_SHOPS_SQL}, near AS (SELECT a.place_id, a.ord AS o, b.*, {_D} AS d FROM sites a CROSS JOIN shops b), r AS (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY d, ord) AS pos FROM near WHERE d <= 500)
SELECT name, lat, lng, n, row_number() OVER (ORDER BY first) - 1 AS place
FROM (SELECT name, round(lat, 6) AS lat, round(lng, 6) AS lng, count(*) AS n, min({{'p': place_id, 'pos': pos}}) AS first FROM r WHERE pos <= 50 GROUP BY ALL)""")
def payload_places(spark, sf_dir):
    """The shared table of places that lists point into, with how many do, numbered by first appearance."""
    items = surround.nearest_items(sites(spark, sf_dir), shops(spark, sf_dir).drop("category"), (500,), "shop")
    return surround.place_dictionary(items)


def _rings(spark, sf_dir):
    """Rectangles from suppliers' keys, about 200 to 600 m wide, some of which overlap."""
    e = estates(spark, sf_dir).withColumns({"h": F.expr("0.0009e0 + (ord % 5) * 0.0004e0"), "w": F.expr("0.0009e0 + (ord % 3) * 0.0007e0")})
    corner = lambda a, b: F.struct((F.col("lng") + b * F.col("w")).alias("lng"), (F.col("lat") + a * F.col("h")).alias("lat"))
    return e.select(F.col("ord").alias("ring_id"), "name", F.array(corner(-1, -1), corner(-1, 1), corner(1, 1), corner(1, -1)).alias("ring"))


@query()
def landuse_items(spark, sf_dir):
    return surround.area_items(sites(spark, sf_dir), _rings(spark, sf_dir), RADII, "industrial")


_RECTS_SQL = """rects AS (SELECT ord AS ring_id, lat - h AS y0, lat + h AS y1, lng - w AS x0, lng + w AS x1
  FROM (SELECT *, 0.0009e0 + (ord % 5) * 0.0004e0 AS h, 0.0009e0 + (ord % 3) * 0.0007e0 AS w FROM estates))"""


def _flat(lat: str, lng: str, site: str = "a") -> str:
    """Metres from a place to the rectangle r in a site's flat projection, as SQL."""
    east = f"greatest(r.x0 - {lng}, {lng} - r.x1, 0) * {surround.FLAT_M}e0 * cos(radians({site}.lat))"
    north = f"greatest(r.y0 - {lat}, {lat} - r.y1, 0) * {surround.FLAT_M}e0"
    return f"sqrt(pow({east}, 2) + pow({north}, 2))"


# Half the height of the polygon of 256 sides at x, and where it is y high: both as SQL; lengths are parts of the radius.
_SIDE = "(2 * pi() / 256)"
_AT = f"(SELECT k, cos(k * {_SIDE}) AS c, cos((k + 1) * {_SIDE}) AS d, sin(k * {_SIDE}) AS s, sin((k + 1) * {_SIDE}) AS t FROM (SELECT unnest(range(128)) AS k))"


@query(f"""WITH {_SITES_SQL}, {_ESTATES_SQL}, {_RECTS_SQL}, sides AS {_AT}, radii AS (SELECT unnest({list(RADII)}) AS m),
local AS (SELECT a.place_id, m, greatest((r.x0 - a.lng) * k, -m) / m AS x0, least((r.x1 - a.lng) * k, m) / m AS x1, (r.y0 - a.lat) * {surround.FLAT_M}e0 / m AS y0, (r.y1 - a.lat) * {surround.FLAT_M}e0 / m AS y1
  FROM (SELECT *, {surround.FLAT_M}e0 * cos(radians(lat)) AS k FROM sites) a JOIN rects r ON abs(r.y0 - a.lat) < 0.03 AND abs(r.x0 - a.lng) < 0.03 CROSS JOIN radii),
near AS (SELECT * FROM local WHERE x0 < x1 AND y0 < 1 AND y1 > -1),
bounds AS (SELECT place_id, m, min(x0) AS lo, max(x1) AS hi FROM near GROUP BY ALL),
levels AS (SELECT DISTINCT place_id, m, abs(unnest([y0, y1])) AS y FROM near),
cuts AS (
  SELECT place_id, m, unnest([x0, x1]) AS x FROM near
  UNION SELECT place_id, m, c FROM bounds CROSS JOIN sides WHERE c > lo AND c < hi
  UNION SELECT place_id, m, unnest([c + (d - c) * (y - s) / (t - s), -(c + (d - c) * (y - s) / (t - s))]) FROM levels JOIN sides ON y >= s AND y < t AND k < 64),
slabs AS (SELECT place_id, m, x, lead(x) OVER (PARTITION BY place_id, m ORDER BY x) AS e FROM cuts),
mids AS (SELECT place_id, m, (x + e) / 2 AS x, e - x AS w FROM slabs WHERE e > x),
high AS (SELECT place_id, m, x, w, s + (t - s) * (x - c) / (d - c) AS h FROM mids JOIN sides ON x <= c AND x > d),
pieces AS (SELECT h.place_id, h.m, h.x, h.w, greatest(n.y0, -h) AS lo, least(n.y1, h) AS hi FROM high h JOIN near n ON n.place_id = h.place_id AND n.m = h.m AND h.x > n.x0 AND h.x < n.x1),
joined AS (SELECT *, max(hi) OVER (PARTITION BY place_id, m, x ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM pieces WHERE hi > lo),
areas AS (SELECT place_id, m, sum(w * greatest(0, hi - greatest(lo, coalesce(last, lo)))) AS a FROM joined GROUP BY ALL)
SELECT place_id, 'industrial_ha_' || m AS col, coalesce({_even("a * m * m / 10000", 2)}, 0) AS value FROM (SELECT place_id, m FROM sites CROSS JOIN radii) LEFT JOIN areas USING (place_id, m)""")
def landuse_hectares(spark, sf_dir):
    return surround.land_area(sites(spark, sf_dir), _rings(spark, sf_dir), RADII, "industrial")


@query(f"""WITH {_SITES_SQL}, {_ESTATES_SQL}, {_RECTS_SQL}, d AS (SELECT a.place_id, r.ring_id, {_flat("a.lat", "a.lng")} AS d FROM sites a CROSS JOIN rects r)
SELECT place_id, ring_id, CAST(round_even(d, 0) AS INTEGER) AS metres FROM d WHERE d <= 1500""")
def ring_metres(spark, sf_dir):
    """Which polygons meet a site's circle, and how far they are."""
    return surround.ring_metres(sites(spark, sf_dir), _rings(spark, sf_dir), 1500)


# Rings that are not simple, in metres from a place: a spike, two rectangles that overlap, a bow, corners that repeat, a hole.
_ODD_RINGS = [
    "0,0 w,0 w+30,0 w,0 w,h 0,h",
    "0,0 w,0 w,h 0,h 0,0 -20,0 -20,-10 40,-10 40,50 -20,50 -20,0",
    "0,0 w,0 w,2*h 2*w,2*h 2*w,h 0,h",
    "0,0 0,0 w,0 w,h w,h 0,h 0,0",
    "0,0 w,0 w,h 0,h 0,0 0,20 20,20 20,50 60,50 60,20 20,20 0,20",
]


def _odd_ring(i: int, point: str, listed: str) -> str:
    """Points of a pattern, as SQL."""
    return listed.format(", ".join(point.format(x=x, y=y) for x, y in (p.split(",") for p in _ODD_RINGS[i].split())))


def _by_pattern(point: str, listed: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {_odd_ring(i, point, listed)}" for i in range(len(_ODD_RINGS)))
    return f"CASE ord % {len(_ODD_RINGS)} {cases} END"


@query(f"""WITH {_ESTATES_SQL}, shapes AS (
  SELECT ord AS ring_id, ord % {len(_ODD_RINGS)} AS kind, {_by_pattern("{{'x': {x}, 'y': {y}}}", "[{}]")} AS pts FROM (SELECT ord, 100 + ord % 7 * 10 AS w, 80 + ord % 4 * 15 AS h FROM estates)),
sides AS (SELECT ring_id, kind, unnest(range(1, len(pts) + 1)) AS i, pts FROM shapes),
uprights AS (SELECT ring_id, pts[i].x AS x, least(pts[i].y, pts[1 + i % len(pts)].y) AS lo, greatest(pts[i].y, pts[1 + i % len(pts)].y) AS hi FROM sides WHERE pts[i].x = pts[1 + i % len(pts)].x AND pts[i].y <> pts[1 + i % len(pts)].y),
slabs AS (SELECT ring_id, y, lead(y) OVER (PARTITION BY ring_id ORDER BY y) AS e FROM (SELECT DISTINCT ring_id, unnest([lo, hi]) AS y FROM uprights)),
crossed AS (SELECT s.ring_id, (e - s.y) * x * CASE WHEN row_number() OVER (PARTITION BY s.ring_id, s.y ORDER BY x) % 2 = 0 THEN 1 ELSE -1 END AS a FROM slabs s JOIN uprights u ON u.ring_id = s.ring_id AND u.lo <= s.y AND u.hi >= e)
SELECT ring_id, {_even("sum(a) / 10000e0", 3)} AS hectares, CAST(CASE WHEN kind IN (1, 2) THEN 2 ELSE 1 END AS BIGINT) AS parts, CAST(CASE kind WHEN 4 THEN 1 ELSE 0 END AS BIGINT) AS holes
FROM crossed JOIN shapes USING (ring_id) GROUP BY ring_id, kind""")
def ring_repair(spark, sf_dir):
    """Rings that cross or touch themselves as simple ones: their area by the even-odd rule, parts and holes."""
    point = "named_struct('lng', lng + ({x}) / k, 'lat', lat + ({y}) / m)"
    sized = estates(spark, sf_dir).selectExpr("*", "100 + ord % 7 * 10 AS w", "80 + ord % 4 * 15 AS h", f"{surround.FLAT_M}e0 AS m", f"{surround.FLAT_M}e0 * cos(radians(lat)) AS k")
    rings = sized.selectExpr("ord AS ring_id", "name", f"{_by_pattern(point, 'array({})')} AS ring")
    parts = surround.repaired_rings(rings).groupBy("ring_id")
    return parts.agg(text.half_even(F.sum("hectares"), 3).alias("hectares"), F.count_if(~F.col("hole")).alias("parts"), F.count_if("hole").alias("holes"))


@query(f"""WITH RECURSIVE {_SITES_SQL}, {_SHOPS_SQL}, {_ESTATES_SQL}, {_RECTS_SQL}, radii AS (SELECT unnest([1500, 3000]) AS m),
touched AS (SELECT a.place_id, m, r.ring_id FROM sites a CROSS JOIN rects r CROSS JOIN radii WHERE {_flat("a.lat", "a.lng")} <= m),
met AS (SELECT r.ring_id AS a, q.ring_id AS b FROM rects r JOIN rects q ON r.x0 < q.x1 AND q.x0 < r.x1 AND r.y0 < q.y1 AND q.y0 < r.y1 AND r.ring_id <> q.ring_id),
edges AS (SELECT t.place_id, t.m, met.a, met.b FROM touched t JOIN met ON met.a = t.ring_id JOIN touched u ON u.place_id = t.place_id AND u.m = t.m AND u.ring_id = met.b),
reach AS (SELECT place_id, m, ring_id, ring_id AS other FROM touched UNION SELECT x.place_id, x.m, x.ring_id, e.b FROM reach x JOIN edges e ON e.place_id = x.place_id AND e.m = x.m AND e.a = x.other),
campuses AS (SELECT place_id, m, count(DISTINCT root) AS n FROM (SELECT place_id, m, ring_id, min(other) AS root FROM reach GROUP BY ALL) GROUP BY ALL),
beside AS (SELECT b.ord, r.* FROM shops b JOIN rects r ON b.lat BETWEEN r.y0 - 0.0001 AND r.y1 + 0.0001 AND b.lng BETWEEN r.x0 - 0.0001 AND r.x1 + 0.0001),
within_r AS (SELECT a.place_id, a.lat, b.ord, b.lat AS nlat, b.lng AS nlng, m FROM sites a CROSS JOIN shops b CROSS JOIN radii WHERE {_D} <= m),
covered AS (SELECT DISTINCT a.place_id, a.m, a.ord FROM within_r a JOIN beside r ON r.ord = a.ord JOIN touched t ON t.place_id = a.place_id AND t.m = a.m AND t.ring_id = r.ring_id WHERE {_flat("a.nlat", "a.nlng")} <= 1),
nodes AS (SELECT place_id, m, count(*) AS n FROM within_r ANTI JOIN covered USING (place_id, m, ord) GROUP BY ALL)
SELECT place_id, 'campus_' || m AS col, CAST(coalesce(c.n, 0) + coalesce(k.n, 0) AS DOUBLE) AS value
FROM (SELECT place_id, m FROM sites CROSS JOIN radii) LEFT JOIN campuses c USING (place_id, m) LEFT JOIN nodes k USING (place_id, m)""")
def campus_count(spark, sf_dir):
    nodes = shops(spark, sf_dir).select("lat", "lng", "name")
    return surround.campus_measures(sites(spark, sf_dir), _rings(spark, sf_dir), nodes, (1500, 3000), "campus")


@query("SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS first, strftime(max(o_orderdate), '%Y-%m-%d') AS last FROM orders")
def fetched_range(spark, sf_dir):
    return answers.fetched_range(_read(spark, sf_dir, "orders"), "o_orderdate")


def _answers(spark, sf_dir):
    """Changes of clients as a log of answers to requests for a client and source; a deletion forgets the answer."""
    c = _read(spark, sf_dir, "client_changes").withColumnRenamed("client_id", "client")
    value = F.when(F.col("op") != "D", F.to_json(F.struct("segment", "city"), {"ignoreNullFields": "false"}))
    request = answers.request_json(["client", "source"])
    return c.select(F.lit("client").alias("sku"), F.sha1(request.cast("binary")).alias("key"), request.alias("request"), value.alias("value"), F.col("valid_at").alias("at"), "seq")


_LOG_SQL = """asked AS (SELECT CAST(to_json({'client': client_id, 'source': source}) AS VARCHAR) AS request, CASE WHEN op <> 'D' THEN CAST(to_json({'segment': segment, 'city': city}) AS VARCHAR) END AS value, valid_at, seq FROM client_changes),
log AS (SELECT request, sha1(request) AS key, value, valid_at AS moment, count(*) OVER (PARTITION BY request) AS writes,
  row_number() OVER (PARTITION BY request ORDER BY valid_at DESC NULLS LAST, seq DESC NULLS LAST, value DESC NULLS LAST) AS nth FROM asked)"""


@query(f"""WITH {_LOG_SQL} SELECT 'client' AS sku, key, request, value, strftime(moment, '%Y-%m-%d %H:%M:%S') AS "at", writes FROM log WHERE nth = 1""")
def answer_log(spark, sf_dir):
    """The last answer to each request."""
    return answers.answer_log(_answers(spark, sf_dir)).withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))


@query(f"""WITH {_LOG_SQL}, wanted AS (SELECT DISTINCT CAST(to_json({{'client': client_id, 'source': source}}) AS VARCHAR) AS request FROM clients)
SELECT 'client' AS sku, sha1(request) AS key, request FROM wanted WHERE request NOT IN (SELECT request FROM log WHERE nth = 1 AND value IS NOT NULL)""")
def pending_requests(spark, sf_dir):
    """What a run over all clients still has to ask."""
    wanted = answers.requests_of(_read(spark, sf_dir, "clients").withColumnRenamed("client_id", "client"), "client", ["client", "source"])
    return answers.pending_requests(wanted, _answers(spark, sf_dir))
