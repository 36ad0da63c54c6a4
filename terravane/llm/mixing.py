"""Source mixing to target weights in a tree of levels (by default domain, language, source), in DataFrame operations only.

1. A leaf can give its tokens max_epochs times; an inner node what its children can give.
2. From the root downward each node's budget is dealt to its children in proportion to their weights. A child that cannot
   use its share gives the rest to its siblings (water filling: the least capacity for its weight is filled first); only
   what no sibling can take has already gone to the ancestors' siblings, as a node never gets more than it can use.
3. A leaf's budget is spent in seeded epochs: each epoch is its own order of the leaf's documents, whole epochs come
   first, of the last one the longest prefix that fits.

A prefix is found without sorting a leaf in one task: an epoch's order is that of a hash, sums by ranges of that hash tell
which ranges are wholly in or out, and only the range that holds the end is summed row by row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import written


def domain_of(source: str = "source") -> Column:
    """d0 to d3 by the number in a source's name; none where there is no number."""
    number = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), "([0-9]{1,9})", 1)
    return F.when(number == "", F.lit("none")).otherwise(F.concat(F.lit("d"), (F.nullif(number, F.lit("")).cast("long") % 4).cast("string")))


def token_count(text: str = "text") -> Column:
    """Runs of characters other than the space and \\x09-\\x0D; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, Mapping[str, float]]) -> Column:
    given = [x for k, v in weights.get(level, {}).items() for x in (F.lit(k), F.lit(float(v)))]
    return F.coalesce(F.try_element_at(F.create_map(*given), F.col(level)), F.lit(1.0)) if given else F.lit(1.0)


def allocate(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], budget: Column) -> DataFrame:
    """leaves (levels, capacity) with their budget. `budget` is the root's; a weight of 0 gets nothing."""
    table = leaves
    for i in range(len(levels), 0, -1):  # what each node can use, bottom up
        inside = F.col("capacity") if i == len(levels) else F.col(f"_cap{i + 1}")
        children = table.select(*levels[:i], inside.alias("_c")) if i == len(levels) else table.select(*levels[: i + 1], inside.alias("_c")).distinct()
        usable = children.groupBy(*levels[:i]).agg(F.sum("_c").alias("_sum")).withColumn(f"_w{i}", _weight(levels[i - 1], weights)).withColumn(f"_cap{i}", F.when(F.col(f"_w{i}") > 0, F.col("_sum")).otherwise(0)).drop("_sum")
        table = table.join(usable, list(levels[:i]))
    # a row for each leaf: written between levels, so that each level's plan starts from a small table
    table = written(table.withColumn("_b0", budget), "mix-capacity")
    for i in range(1, len(levels) + 1):
        nodes = table.select(*levels[:i], f"_w{i}", f"_cap{i}", f"_b{i - 1}").distinct()
        parent = W.partitionBy(*levels[: i - 1]) if i > 1 else W.partitionBy(F.lit(0))
        line = parent.orderBy(F.when(F.col(f"_w{i}") > 0, F.col(f"_cap{i}") / F.nullif(F.col(f"_w{i}"), F.lit(0.0))).asc_nulls_last(), levels[i - 1])
        cap, w = F.col(f"_cap{i}").cast("double"), F.col(f"_w{i}")
        nodes = nodes.withColumns({"_have": F.least(F.col(f"_b{i - 1}").cast("double"), F.sum(cap).over(parent)), "_before": F.sum(cap).over(line.rowsBetween(W.unboundedPreceding, 0)) - cap, "_from": F.sum(w).over(line.rowsBetween(0, W.unboundedFollowing))})
        nodes = nodes.withColumn("_full", (w > 0) & (cap * F.col("_from") <= (F.col("_have") - F.col("_before")) * w))
        nodes = nodes.withColumns({"_left": F.col("_have") - F.sum(F.when(F.col("_full"), cap).otherwise(0.0)).over(parent), "_share": F.sum(F.when(F.col("_full"), 0.0).otherwise(w)).over(parent)})
        given = F.when(F.col("_full"), F.col(f"_cap{i}")).otherwise(F.floor(F.coalesce(F.try_divide(F.col("_left") * w, F.col("_share")), F.lit(0.0))))
        table = table.join(nodes.select(*levels[:i], F.greatest(given, F.lit(0)).cast("long").alias(f"_b{i}")), list(levels[:i]))
        table = written(table, f"mix-budget{i}")
    return table.select(*leaves.columns, F.col(f"_b{len(levels)}").alias("budget"))


def mix_sources(docs: DataFrame, weights: Mapping[str, Mapping[str, float]], share: float = 0.8, levels: Mapping[str, Column] | None = None, id_col: str = "doc_id", text: str = "text", max_epochs: int = 4, seed: str = "mix", digits: int = 3) -> DataFrame:
    """A row for each document and epoch that are selected: id_col, the levels, epoch (from 0), n_tokens.

    weights: by level, the weight of a node among its siblings (1 where none is given, 0: none of it). The root's
    budget is share * all tokens. Null levels count as an empty name, null texts as 0 tokens; rows that repeat are
    counted and selected each; a leaf without tokens gives nothing; an empty table gives no rows. What a leaf's last
    prefix leaves of its budget, less than one document, is not dealt out again. Columns of docs other
    than id, text and those that levels read are not used, so names cannot clash.
    """
    levels = levels or {"domain": domain_of(), "lang": F.col("lang"), "source": F.col("source")}
    names = list(levels)
    base = written(docs.select(F.col(id_col).alias("_id"), *(F.coalesce(c.cast("string"), F.lit("")).alias(k) for k, c in levels.items()), token_count(text).alias("_n")), "mix-base")
    leaves = written(base.groupBy(*names).agg(F.sum("_n").alias("tokens"), (F.sum("_n") * max_epochs).alias("capacity")), "mix-leaves")
    root = leaves.agg(F.floor(F.sum("tokens") * share).alias("_root"))
    leaves = leaves.join(F.broadcast(root), F.lit(True))  # one row
    plan = allocate(leaves, names, weights, F.col("_root")).filter("tokens > 0").select(
        *names, F.expr("cast(budget div tokens as int)").alias("_whole"), F.expr("budget % tokens").alias("_rest"))
    plan = written(plan, "mix-plan")
    docs_in = base.join(plan, names)
    whole = docs_in.filter("_whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_whole") - 1)))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("_whole").cast("string"), F.coalesce(F.col("_id").cast("string"), F.lit(""))))
    last = docs_in.filter("_rest > 0").withColumn("_key", key).withColumn("_range", F.substring("_key", 1, digits))
    sums = last.groupBy(*names, "_range").agg(F.sum("_n").alias("_in"))
    before = F.sum("_in").over(W.partitionBy(*names).orderBy("_range").rowsBetween(W.unboundedPreceding, 0)) - F.col("_in")
    last = last.join(sums.withColumn("_before", before), [*names, "_range"])
    inside = last.filter(F.col("_before") + F.col("_in") <= F.col("_rest"))
    running = F.sum("_n").over(W.partitionBy(*names, "_range").orderBy("_key", "_id", "_n").rowsBetween(W.unboundedPreceding, 0))
    edge = last.filter((F.col("_before") <= F.col("_rest")) & (F.col("_before") + F.col("_in") > F.col("_rest"))).withColumn("_run", F.col("_before") + running).filter("_run <= _rest")
    out = [F.col("_id").alias(id_col), *names]
    rows = [df.select(*out, e.cast("int").alias("epoch"), F.col("_n").alias("n_tokens")) for df, e in ((whole, F.col("epoch")), (inside, F.col("_whole")), (edge, F.col("_whole")))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])
