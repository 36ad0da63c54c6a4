"""python -m terravane STAGE --config FILE --data DIR: a stage's name, or all.

Stages read and write Parquet tables in DIR. Hits, details and counts are asked of the metered services where
GOOGLE_MAPS_API_KEY is set (terravane.sources.ingest); without it the tables in DIR are taken. keep --hide ID,ID
--restore ID writes a person's decisions to keep.csv, with a backup; score --hide ranks without some sites once; list
writes the ranked sites that its filters leave.
"""

from __future__ import annotations

import argparse
import itertools
import json
import os
from pathlib import Path

from pyspark.sql import functions as F

from .functions.geo import tiles
from .functions.storage import written
from .operators import metering, surround
from .operators.discover import HIT
from .operators.report import quality_report
from .plans import stages
from .plans.config import load_config, load_env, pillars_of, point_features
from .sources import files, ingest, osm


_TIME = "STRUCT<day: INT, hour: INT, minute: INT>"
DETAILS = f"place_id STRING, rating DOUBLE, reviews BIGINT, business_status_now STRING, hours_text STRING, fetched STRING, periods ARRAY<STRUCT<open: {_TIME}, close: {_TIME}>>"


FACT_NAMES, FACTS = ("place_id", "col", "value"), "place_id STRING, col STRING, value DOUBLE"


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="terravane")
    p.add_argument("stage", choices=["estimate", "review", "extract", "osm-extract", "discover", "enrich", "surround", "score", "map", "dashboard", "qa", "keep", "list", "all"])
    p.add_argument("--config", default="config.yaml")
    p.add_argument("--data", default="data")
    p.add_argument("--xml", "--pbf", dest="extract", help="map extract (XML, or binary if its name ends in .pbf) for the extract stage")
    p.add_argument("--sites", "--markets", dest="sites", type=int, default=400, help="number of sites that estimate assumes")
    p.add_argument("--max-calls", type=int, default=4900, help="calls of metered services in this run")
    p.add_argument("--hide", type=listed, default=[], help="place ids that are no markets: keep writes them to keep.csv, score leaves them out for once")
    p.add_argument("--restore", type=listed, default=[], help="place ids that keep takes back")
    p.add_argument("--profile")
    p.add_argument("--kind")
    p.add_argument("--district")
    p.add_argument("--least-reviews", type=int, default=0)
    p.add_argument("--window", choices=["open_morning", "open_evening", "open_night"])
    p.add_argument("--day", type=int, choices=range(7), help="0: Sunday")
    p.add_argument("--starred", type=listed, help="place ids")
    args = p.parse_args(argv)
    load_env()
    cfg, data = load_config(args.config), args.data.rstrip("/")
    for stage in ["discover", "enrich", "surround", "score", "map", "dashboard"] if args.stage == "all" else [args.stage]:
        run(stage, cfg, data, args)


def listed(ids: str) -> list[str]:
    return [i for i in ids.split(",") if i]


def service(cfg: dict, data: str, most_calls: int) -> ingest.Places | None:
    """The metered services, where GOOGLE_MAPS_API_KEY is set; without it stages take the tables that are there."""
    key = os.environ.get("GOOGLE_MAPS_API_KEY")
    if not key:
        return None
    import requests

    budget = cfg.get("budget") or {}
    ledger = ingest.Ledger(f"{data}/cache/usage.json", budget.get("monthly_caps"), budget.get("already_used"))
    return ingest.Places(requests.Session(), ingest.Cache(f"{data}/cache"), key, most_calls, ledger=ledger)


def map_service(data: str) -> ingest.MapQueries:
    """Map features from a server, for what no extract holds."""
    import requests

    return ingest.map_queries(requests.Session(), ingest.Cache(f"{data}/cache"))


def stored(spark, rows, schema: str, path: str, page: int = 5000) -> None:
    """Rows (dicts) of any number as a table, written page by page."""
    rows, mode = iter(rows), "overwrite"
    while (some := [(json.dumps(r),) for r in itertools.islice(rows, page)]) or mode == "overwrite":
        table = spark.createDataFrame(some, "j STRING").select(F.from_json("j", schema).alias("r")).select("r.*")
        table.write.mode(mode).parquet(path)
        mode = "append"


def append_summary(text: str) -> None:
    """Shown, and added to the step summary of a build server where it names one."""
    print(text)
    if path := os.environ.get("GITHUB_STEP_SUMMARY"):
        with open(path, "a", encoding="utf-8") as out:
            out.write(text + "\n")


def fetch(stage: str, cfg: dict, data: str, client: ingest.Places, spark, kept) -> None:
    """Asks the services for what a stage reads, and writes it as that stage's table."""
    try:
        if stage == "discover":
            b = cfg["area"]["bbox"]
            boxes = [(t.south, t.west, t.north, t.east) for t in tiles(spark, b["south"], b["north"], b["west"], b["east"], cfg["area"]["tile_deg"]).collect()]
            rows = ingest.search_rows(boxes, cfg["discover"]["keywords"], client, cfg["area"].get("max_subdivide_depth", 2))
            stored(spark, rows, HIT, f"{data}/hits")
            return
        kept = kept().select("place_id", "lat", "lng").toLocalIterator()
        if stage == "enrich":
            stored(spark, ingest.detail_rows(kept, client), DETAILS, f"{data}/raw_details")
        elif stage == "surround" and (sc := cfg["surroundings"])["source"] == "google_aggregate":
            rows = ingest.count_rows(kept, client, ingest.specs(sc.get("google_types") or {}, sc["radii_m"]))
            stored(spark, (dict(zip(FACT_NAMES, r, strict=True)) for r in rows), FACTS, f"{data}/counted")
    finally:
        for name, calls, cached in client.usage():
            print(f"{name}: {calls} calls, {cached} from the cache")


def run(stage: str, cfg: dict, data: str, args) -> None:
    spark = stages.session()
    read = lambda name, made_by: files.read_stage(spark, f"{data}/{name}", "", made_by)
    write = lambda df, name: df.write.mode("overwrite").parquet(f"{data}/{name}")
    export = lambda df, name: files.write_csv(df, f"{data}/{name}.csv")
    sc = cfg.get("surroundings") or {}
    review = files.read_review(spark, f"{data}/keep.csv")
    # the review file as it is now counts at each stage that reads sites
    sites = lambda: files.reviewed_sites(spark, f"{data}/sites", review)
    kept = lambda: stages.discover.kept_sites(sites())
    client = service(cfg, data, args.max_calls) if stage in ("discover", "enrich", "surround") else None
    if client is not None:
        fetch(stage, cfg, data, client, spark, kept)
    places = lambda ids: spark.createDataFrame([(i,) for i in ids or []], "place_id string")
    if stage == "keep":
        # the file as it was stays beside the new one; all later stages read the new one
        new = written(stages.review_file(review, places(args.hide), places(args.restore)), "review")
        if Path(f"{data}/keep.csv").exists():
            Path(f"{data}/keep.csv").replace(f"{data}/keep.backup.csv")
        export(new.orderBy("place_id"), "keep")
    elif stage == "list":
        starred = None if args.starred is None else places(args.starred)
        found = stages.filtered(read("ranked", "score"), args.profile, args.kind, args.district, args.least_reviews, args.window, args.day, starred=starred)
        export(found.orderBy("rank"), "listed")
    elif stage == "estimate":
        b = cfg["area"]["bbox"]
        n = tiles(spark, b["south"], b["north"], b["west"], b["east"], cfg["area"]["tile_deg"]).count()
        radii = {k: r for k, (_, r) in ingest.specs(sc.get("google_types") or {}, sc["radii_m"]).items()}
        free = {"search": 5000, "details": 1000, "aggregate": 5000}
        plan = metering.estimate(n, len(cfg["discover"]["keywords"]), args.sites, radii, free)
        print(plan)
        for name, used in (("search", plan["search_max"]), ("details", plan["details"]), ("aggregate", plan["aggregate"])):
            print(metering.budget_line(name, used, free[name]))
    elif stage == "discover":
        old = spark.read.parquet(f"{data}/sites") if files.exists(spark, f"{data}/sites") else None
        found = stages.discovered(cfg, read("hits", "the search"), old, review)
        write(files_safe(found, data), "sites")
        export(spark.read.parquet(f"{data}/sites").orderBy(F.desc("keep"), "name").drop("ord"), "sites")
        append_summary(stages.review_text(sites()))
    elif stage == "enrich":
        write(stages.enriched(read("raw_details", "the detail search")), "details")
        export(read("details", "enrich"), "details")
    elif stage == "review":
        append_summary(stages.review_text(sites()))
    elif stage in ("extract", "osm-extract"):
        if not args.extract or not Path(args.extract).exists():
            raise files.MissingStage("extract needs --pbf FILE or --xml FILE")
        rows = osm.extract(args.extract, cfg["area"]["bbox"], point_features(sc), sc.get("osm_area") or {}, sc.get("osm_campus") or {})
        osm.write_layers(spark, rows, f"{data}/layers")
    elif stage == "surround":
        layers = spark.read.parquet(f"{data}/layers") if files.exists(spark, f"{data}/layers") else None
        counted = spark.read.parquet(f"{data}/counted") if files.exists(spark, f"{data}/counted") else None
        points, areas = point_features(sc), sc.get("osm_area") or {}
        if not stages.covered(sc, layers):
            print("no extract holds all map features: a map server is asked for counts and areas")
            here = kept().select("place_id", "lat", "lng").toLocalIterator()
            rows = ingest.map_rows(here, map_service(data), points, areas, sc["radii_m"])
            stored(spark, (dict(zip(FACT_NAMES, r, strict=True)) for r in rows), FACTS, f"{data}/map_counted")
            asked = spark.read.parquet(f"{data}/map_counted")
            counted, layers = asked if counted is None else counted.unionByName(asked), None
        wide, items = stages.surroundings(cfg, kept(), layers, counted)
        write(wide, "surroundings")
        export(read("surroundings", "surround"), "surroundings")
        if items is not None:
            write(items, "items")
            files.write_items(surround.items_json(spark.read.parquet(f"{data}/items")), f"{data}/items.json")
    elif stage in ("score", "qa"):
        feats = stages.features(cfg, kept(), read("details", "enrich"), read("surroundings", "surround"))
        if getattr(args, "hide", None):
            feats = stages.without(feats, places(args.hide))
        if stage == "qa":
            append_summary(quality_report(feats, stages.ranked(cfg, feats), kept().count()))
        else:
            write(stages.ranked(cfg, feats), "ranked")
            export(read("ranked", "score").orderBy("rank"), "ranked")
    elif stage == "map":
        Path(f"{data}/map.html").write_text(files.map_page(read("ranked", "score"), (cfg.get("output") or {}).get("top_n_map", 50)), "utf-8")
    else:
        ranked = stages.page_columns(read("ranked", "score"))
        items = spark.read.parquet(f"{data}/items") if files.exists(spark, f"{data}/items") else None
        numbers = files.payload_columns(ranked, list(pillars_of(cfg)))
        excluded = stages.discover.excluded_sites(sites()) if files.exists(spark, f"{data}/sites") else None
        scales = cfg["scoring"].get("scales") or {}
        info = lambda c: files.feature_info(c) | stages.source_of(cfg, c)
        found = files.payload(ranked, numbers, pillars_of(cfg), items, excluded, review, info=info, scales=scales)
        Path(f"{data}/dashboard.html").write_text(files.page(found), "utf-8")


def files_safe(df, data: str):
    """A table that does not read the path it is about to be written to."""
    return written(df.withColumn("ord", F.xxhash64("place_id")), "sites")


if __name__ == "__main__":
    main()
