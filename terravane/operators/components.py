"""Connected components of a graph given as edges, by alternating large and small stars.

Every round is two aggregations and two joins over the edges; the least node of each component ends as its name. No
node, edge or component passes through the driver. A hub's edges need not meet in one task: its minimum is combined
before the shuffle, and it is written before the join back, whose two sides adaptive execution can then split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import discard, written


#: So few edges need no tables inside a round: even if all were a hub's, one task could hold them.
FEW = 1 << 13


def _star(edges: DataFrame, large: bool, few: bool) -> tuple[DataFrame, list[DataFrame]]:
    """Moves each node's larger (large) or not larger neighbours to the least node next to it; and the tables it wrote."""
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    tables = [] if few else [written(least, "least")]
    joined = around.join(tables[0] if tables else least, "a")
    if large:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return moved.filter("a <> b").distinct(), tables


def components(edges: DataFrame, name: str = "components", most_rounds: int = 40, few: int = FEW) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the least node of its component, itself included.

    Edges from a node to itself and null ends are left out. Raises where no fixed point is reached. Each round's table is
    deleted once the next is written; up to `few` edges, a round writes one table only (results do not depend on it)."""
    seen_of = lambda t: t.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    now = written(edges.select("a", "b").filter("a <> b").distinct(), name)
    state = seen_of(now)
    for _ in range(most_rounds):
        once, tables = _star(now, True, state[0] <= few)
        twice, more = _star(once, False, state[0] <= few)
        following = written(twice, name)
        discard(now, *tables, *more)
        now, seen = following, seen_of(following)
        # the same rows as a round before: every component is a star
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
