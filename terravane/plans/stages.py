"""The stages from hits to pages, each a function from tables to tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import discover, hours, report, score, surround
from ..sources import files, ingest, osm
from .config import pillars_of, point_features, rules_of


def discovered(cfg: Mapping, hits: DataFrame, old: DataFrame | None = None, review: DataFrame | None = None) -> DataFrame:
    """Sites from hits (discover.HIT): filtered, merged, ruled; a person's earlier decisions and the review file win."""
    d, area = cfg["discover"], cfg.get("area") or {}
    rows = discover.site_row(hits)
    rows = rows.withColumn("reason", discover.reject_reason(area.get("address_must_contain") or [], d.get("name_must_match") or "", d.get("name_exclude") or ""))
    merged = discover.merge_hits(rows.filter("reason is null").drop("reason"))
    out = discover.carry_over(discover.keep_rules(merged, rules_of(cfg)), old)
    return discover.apply_review(out, review).orderBy(F.desc("keep"), "name")


def enriched(details: DataFrame) -> DataFrame:
    """Details with features of their opening hours (periods)."""
    return details.drop("periods").join(hours.hours_features(details, "place_id"), "place_id")


def surroundings(cfg: Mapping, sites: DataFrame, layers: DataFrame | None = None, counted: DataFrame | None = None, log=print) -> tuple[DataFrame, DataFrame | None]:
    """(wide table by place_id, item lists or None). counted: long facts of a counting service. Layers come from an extract."""
    sc = cfg["surroundings"]
    if sc["source"] not in ("google_aggregate", "osm"):
        raise ValueError(f"unknown source {sc['source']}")
    radii, spark = sc["radii_m"], sites.sparkSession
    facts, items = [] if counted is None else [counted], []
    if layers is not None:
        if features := list(point_features(sc)):
            points = osm.point_layer(layers)
            facts.append(surround.layer_measures(sites, points, features, radii))
            items += [surround.nearest_items(sites, points.filter(F.col("feature") == f), radii, f) for f in features]
        for name in sc.get("osm_campus") or {}:
            args = (sites, osm.ring_layer(layers, name, "campus"), osm.point_layer(layers, "campus_node").filter(F.col("feature") == name), sc.get("campus_radii_m", radii), name)
            facts.append(surround.campus_measures(*args))
            items.append(surround.campus_items(*args))
        for name in sc.get("osm_area") or {}:
            rings = osm.ring_layer(layers, name)
            facts.append(surround.land_area(sites, rings, radii, name))
            items.append(surround.area_items(sites, rings, radii, name))
    elif any(sc.get(k) for k in ("osm_extra", "osm_area", "osm_campus")):
        log("campuses, areas and lists need an extract; left out")
    for ext in cfg.get("external_pois") or []:
        pois = files.read_points(spark, ext["path"], ext.get("weight"), log)
        if pois is not None:
            args = (sites, pois, ext.get("radii_m", radii), ext["name"], (ext.get("weight") or "").lower() or None)
            facts.append(surround.radius_measures(*args))
            items.append(surround.nearest_items(*args))
    if not facts:
        return sites.select("place_id"), None
    long = facts[0]
    for f in facts[1:]:
        long = long.unionByName(f)
    columns = sorted(r.col for r in long.select("col").distinct().collect())  # names of columns: features by radii
    lists = None
    for i in items:
        lists = i if lists is None else lists.unionByName(i)
    return surround.pivot_wide(sites, long, columns), lists


def covered(surroundings_: Mapping, layers: DataFrame | None) -> bool:
    """Whether no map features are wanted, or the layers of an extract hold all of them."""
    wanted = [*point_features(surroundings_), *(surroundings_.get("osm_area") or {}), *(surroundings_.get("osm_campus") or {})]
    return not wanted or (layers is not None and osm.has_features(layers, wanted))


def source_of(cfg: Mapping, column: str) -> dict:
    """Where a measure's column comes from, by the configuration."""
    sc = cfg.get("surroundings") or {}
    counted = {k: types for k, (types, _) in ingest.specs(sc.get("google_types") or {}, ()).items()}
    counted = counted if sc.get("source") == "google_aggregate" else {}
    named = [e["name"] for e in cfg.get("external_pois") or []]
    return files.feature_source(column, counted, [*(sc.get("osm_campus") or {})], [*(sc.get("osm_area") or {})], [*point_features(sc)] if sc else [], named)


def without(features_: DataFrame, hidden: DataFrame) -> DataFrame:
    """Features without the sites that a person has hidden (place_id), to be scored again."""
    return features_.join(hidden.select("place_id").distinct(), "place_id", "left_anti")


def review_file(review: DataFrame | None, hidden: DataFrame, restored: DataFrame) -> DataFrame:
    """(place_id, keep, note): the review file with the sites that a person has hidden (kept 0) or taken back (kept 1);
    of one id, a person's decision counts, a restored site last."""
    of = lambda df, keep, note, order: df.select("place_id", F.lit(keep).alias("keep"), F.lit(note).alias("note"), F.lit(order).alias("_o"))
    rows = of(hidden, "0", "not a market", 1).unionByName(of(restored, "1", "", 2))
    if review is not None:
        rows = rows.unionByName(review.select("place_id", F.col("keep").cast("string").alias("keep"), "note", F.lit(0).alias("_o")))
    last = F.max_by(F.struct("keep", "note"), "_o").alias("r")
    return rows.filter("place_id is not null").groupBy("place_id").agg(last).select("place_id", "r.keep", "r.note")


def features(cfg: Mapping, sites: DataFrame, details: DataFrame, around: DataFrame) -> DataFrame:
    d = (cfg["discover"].get("dedupe") or {}) if "discover" in cfg else {}
    numbered = sites if "ord" in sites.columns else sites.withColumn("ord", F.xxhash64("place_id"))
    return score.build_features(numbered, details, around, cfg["scoring"].get("rating_prior_reviews", 30), d.get("same_site_m", 40), d.get("similar_name_m", 150))


def ranked(cfg: Mapping, features_: DataFrame, log=print) -> DataFrame:
    sc = cfg["scoring"]
    return score.score(features_, pillars_of(cfg), sc.get("profile_top_pct", 30), sc.get("scales") or {}, log=log)


def page_columns(ranked_: DataFrame) -> DataFrame:
    return ranked_.withColumns({"district": text.district(F.col("address")), "kind": text.market_kind(F.col("name"))})


def filtered(ranked_: DataFrame, profile: str | None = None, kind: str | None = None, district: str | None = None, least_reviews: int = 0, window: str | None = None, day: int | None = None, unknown_hours: bool = True, starred: DataFrame | None = None) -> DataFrame:
    """Sites of a profile tag, kind or district, with so many reviews, open in a window or on a day (0: Sunday), starred
    (place_id)."""
    df = page_columns(ranked_)
    if profile:
        df = df.filter(F.array_contains(F.split("profile", ", "), profile))
    if kind:
        df = df.filter(F.col("kind") == kind)
    if district:
        df = df.filter(F.col("district") == district)
    if least_reviews:
        df = df.filter(F.coalesce("reviews", F.lit(0)) >= least_reviews)
    if starred is not None:
        df = df.join(starred.select("place_id").distinct(), "place_id", "left_semi")
    unknown = (F.coalesce("hours_known", F.lit(0)) == 0) & F.lit(unknown_hours)
    if window:
        df = df.filter(unknown | (F.coalesce(window, F.lit(0.0)) > 0))
    if day is not None:
        df = df.filter(unknown | (F.substring("open_days", day + 1, 1) == "1"))
    return df


def review_text(sites: DataFrame) -> str:
    kept, dropped = discover.kept_sites(sites), discover.excluded_sites(sites)
    parts = [("kept by type", discover.type_report(kept)), ("kept, found by one keyword", discover.single_keyword_report(kept)), ("why not kept", discover.note_report(dropped))]
    return f"# {kept.count()} kept, {dropped.count()} not\n" + "\n".join(f"\n## {t}\n\n{report.markdown(d)}" for t, d in parts)


def session(app: str = "terravane") -> SparkSession:
    return SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").getOrCreate()
