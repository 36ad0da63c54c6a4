"""From search hits to a reviewed list of sites."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import subdivide
from ..functions.storage import written
from ..functions.text import blank, first_rule, found

TILE_FULL = 60  # a search gives no more rows than this; a tile that reaches it is split

HIT = (
    "keyword STRING, seq BIGINT, place STRUCT<id:STRING,displayName:STRUCT<text:STRING>,formattedAddress:STRING,location:STRUCT<latitude:DOUBLE,longitude:DOUBLE>,"
    "types:ARRAY<STRING>,primaryType:STRING,businessStatus:STRING,googleMapsUri:STRING>"
)


def site_row(hits: DataFrame) -> DataFrame:
    """keyword, seq and the flat columns of each hit's place; texts that are absent become empty."""
    p = lambda path: F.col(f"place.{path}")
    return hits.select(
        "keyword", "seq", p("id").alias("place_id"), blank(p("displayName.text")).alias("name"), p("location.latitude").alias("lat"), p("location.longitude").alias("lng"), blank(p("formattedAddress")).alias("address"),
        blank(p("primaryType")).alias("primary_type"), blank(F.array_join(p("types"), ",")).alias("types"), blank(p("businessStatus")).alias("business_status"), blank(p("googleMapsUri")).alias("maps_url"))


def inside_area(address: Column, needles: Sequence[str]) -> Column:
    low = F.lower(blank(address))
    return F.lit(True) if not needles else F.exists(F.array(*(F.lit(n.lower()) for n in needles)), lambda n: low.contains(n))


def reject_reason(needles: Sequence[str], allow: str = "", deny: str = "") -> Column:
    """The first reason against a hit: outside_area, name_filter, closed; null for a good one."""
    name = F.col("name")
    bad_name = (~found(name, allow) if allow else F.lit(False)) | found(name, deny)
    return F.when(~inside_area(F.col("address"), needles), "outside_area").when(bad_name, "name_filter").when(F.col("business_status") == "CLOSED_PERMANENTLY", "closed")


def merge_hits(hits: DataFrame) -> DataFrame:
    """One row for each place: the columns of its first hit (by seq), and the sorted set of keywords that found it."""
    rest = [c for c in hits.columns if c not in ("place_id", "keyword", "seq")]
    merged = hits.groupBy("place_id").agg(F.min_by(F.struct(*rest), "seq").alias("_first"), F.sort_array(F.collect_set("keyword")).alias("_k"))
    return merged.select("place_id", *(F.col(f"_first.{c}").alias(c) for c in rest), F.array_join("_k", "|").alias("keywords"))


@dataclass(frozen=True)
class KeepRules:
    never_types: Sequence[str] = ()
    name_prefix: str = ""
    suspect_name: str = ""
    name_words: str = ""
    market_types: Sequence[str] = ()
    suspect_type: str = ""


def keep_rules(df: DataFrame, rules: KeepRules) -> DataFrame:
    """df with keep, keep_auto and note: the first rule that a site meets decides."""
    name, kind = blank(F.col("name")), blank(F.col("primary_type"))
    inside = name.contains("ตลาด") & ~found(name, r"^\s*ตลาด") & ~found(name, rules.name_words)
    drop = lambda note: F.struct(F.lit(0).alias("keep"), (note if isinstance(note, Column) else F.lit(note)).alias("note"))
    keep = F.struct(F.lit(1).alias("keep"), F.lit("").alias("note"))
    chain = [
        (kind.isin(*rules.never_types) if rules.never_types else F.lit(False), drop(F.concat(F.lit("not a market: "), kind))),
        (found(name, rules.name_prefix), keep),
        (found(name, rules.suspect_name), drop("name looks like a shop branch/residence")),
        (inside, drop("looks like a stall/shop inside a market")),
    ]
    if rules.market_types:
        chain += [(kind.isin(*rules.market_types), keep), (F.lit(True), drop(F.concat(F.lit("not a market type: "), F.coalesce(F.nullif(kind, F.lit("")), F.lit("(none)")))))]
    else:
        chain += [(found(kind, rules.suspect_type), drop(F.concat(F.lit("primary_type="), kind)))]
    return df.withColumn("_rule", first_rule(chain, keep)).withColumns({"keep": F.col("_rule.keep"), "keep_auto": F.col("_rule.keep"), "note": F.col("_rule.note")}).drop("_rule")


def number(c: Column) -> Column:
    """A number in a text, or null: '1.0' is 1."""
    return c.cast("string").try_cast("double")


def is_kept(keep: Column) -> Column:
    """Blank and unreadable counts as kept."""
    return F.coalesce(number(keep), F.lit(1.0)) != 0


def kept_sites(df: DataFrame) -> DataFrame:
    return df.filter(is_kept(F.col("keep"))) if "keep" in df.columns else df


def excluded_sites(df: DataFrame) -> DataFrame:
    return df.filter(~is_kept(F.col("keep"))) if "keep" in df.columns else df.limit(0)


def carry_over(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """new with is_new, and with keep and note of old rows (the first of an id, by ord where there is one) that a person
    has changed: whose keep is given and is not keep_auto. Without keep_auto in old nothing is carried over."""
    if old is None or "place_id" not in old.columns:
        return new.withColumn("is_new", F.lit(1))
    old = old.withColumn("_o", F.col("ord") if "ord" in old.columns else F.monotonically_increasing_id())
    given = F.lit("keep" in old.columns and "keep_auto" in old.columns)
    keep = number(F.col("keep")) if "keep" in old.columns else F.lit(None).cast("double")
    auto = number(F.col("keep_auto")) if "keep_auto" in old.columns else F.lit(None).cast("double")
    note = F.col("note").cast("string") if "note" in old.columns else F.lit(None).cast("string")
    first = old.groupBy("place_id").agg(F.min_by(F.struct(keep.alias("keep"), auto.alias("auto"), blank(note).alias("note")), "_o").alias("_old"))
    edited = given & F.col("_old.keep").isNotNull() & ~F.col("_old.keep").eqNullSafe(F.col("_old.auto"))
    joined = new.join(first, "place_id", "left")
    return joined.withColumns({"keep": F.when(edited, F.col("_old.keep").cast("int")).otherwise(F.col("keep")), "note": F.when(edited, F.col("_old.note")).otherwise(F.col("note")), "is_new": F.col("_old").isNull().cast("int")}).drop("_old")


def apply_review(df: DataFrame, review: DataFrame | None) -> DataFrame:
    """df with the keep and note that a review file gives; the last row of an id counts, by ord (any type that
    sorts, such as files.file_order; rows without one have the order of their tasks, which is no file's)."""
    if review is None:
        return df
    df = df if "keep" in df.columns else df.withColumn("keep", F.lit(1))
    df = df if "note" in df.columns else df.withColumn("note", F.lit(""))
    review = review.withColumn("_o", F.col("ord") if "ord" in review.columns else F.monotonically_increasing_id())
    last = review.filter(F.col("place_id").isNotNull()).groupBy("place_id").agg(F.max_by(F.struct(number(F.col("keep")).alias("keep"), F.nullif(F.col("note").cast("string"), F.lit("")).alias("note")), "_o").alias("_r"))
    return df.join(last, "place_id", "left").withColumns({"keep": F.coalesce(F.col("_r.keep"), number(F.col("keep")), F.lit(1.0)).cast("int"), "note": F.coalesce(F.col("_r.note"), F.col("note"))}).drop("_r")


def adaptive_tiles(points: DataFrame, south: float, north: float, west: float, east: float, step: float, max_depth: int, full: int = TILE_FULL) -> DataFrame:
    """Every tile that a search with subdivision visits: (tile, path, depth, south, west, north, east, n, state).

    Base tiles are a grid over the box; a tile that holds `full` points or more is split into quadrants down to max_depth.
    state is split, leaf (less than full) or capped (full at max_depth: a search may hide points there). path has a digit
    for each quadrant, south-west 0 to north-east 3. A tile holds its south and west edges, the outermost also the others;
    points without coordinates or outside the box are in no tile. Every point counts, those at one place too.

    The points are read once: each goes to its cell at max_depth, cells are counted before the shuffle, and levels follow
    each other over those counts, a written table each."""
    from ..functions.geo import grid_tile, quadrant_path, tiles

    spark = points.sparkSession
    tile, box = grid_tile(F.col("lat"), F.col("lng"), south, north, west, east, step)
    placed = points.select("lat", "lng", tile.alias("tile"), box.alias("box")).filter("tile is not null")
    path = quadrant_path(F.col("lat"), F.col("lng"), F.col("box"), max_depth)
    cells = written(placed.select("tile", path.alias("cell")).groupBy("tile", "cell").agg(F.count("*").alias("n")), "tile-cells")
    level, inside, levels = tiles(spark, south, north, west, east, step).withColumn("path", F.lit("")), cells, []
    for depth in range(max_depth + 1):
        counts = inside.groupBy("tile", F.substring("cell", 1, depth).alias("path")).agg(F.sum("n").alias("n"))
        counted = level.join(counts, ["tile", "path"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
        state = F.when(F.col("n") < full, "leaf").otherwise("split" if depth < max_depth else "capped")
        counted = counted.select("tile", "path", F.lit(depth).alias("depth"), "south", "west", "north", "east", "n", state.alias("state"))
        levels.append(written(counted, f"tiles{depth}"))
        again = levels[-1].filter("state = 'split'")
        if depth == max_depth or again.isEmpty():
            break
        parents = again.select("tile", F.col("path").alias("parent"))
        inside = inside.withColumn("parent", F.substring("cell", 1, depth)).join(parents, ["tile", "parent"], "left_semi").drop("parent")
        level = subdivide(again.drop("depth", "n", "state")).withColumn("path", F.concat("path", F.col("quadrant").cast("string"))).drop("quadrant")
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out


def type_report(df: DataFrame, samples: int = 4, order: str = "place_id") -> DataFrame:
    """(primary_type, n, examples): kept sites by type, the most frequent first, with some names."""
    kind = F.coalesce(F.col("primary_type"), F.lit("(none)"))
    # the least `samples` of each task are enough: no list of a whole type is made
    from pyspark.sql import Window as W

    ranked = df.withColumn("_k", kind).withColumn("_n", F.row_number().over(W.partitionBy("_k").orderBy(order)))
    return ranked.groupBy(F.col("_k").alias("primary_type")).agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_n") <= samples, F.struct("_n", F.col("name").alias("v"))))), lambda x: x["v"]), " · ").alias("examples")).orderBy(F.desc("n"), "primary_type")


def single_keyword_report(df: DataFrame) -> DataFrame:
    return df.filter((F.col("keywords") != "") & ~F.col("keywords").contains("|")).groupBy("keywords").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "keywords")


def note_report(df: DataFrame, most: int = 20) -> DataFrame:
    return df.groupBy(blank(F.col("note")).alias("note")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "note").limit(most)
