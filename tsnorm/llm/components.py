"""Connected components of links: union-find by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsnorm.llm import common


def components(links: DataFrame) -> DataFrame:
    """Least id of the component of every id in links (two long columns, any order): id, root.

    Rounds of union: every id hooks onto its neighbour of least rank if that is less than its own,
    and links are drawn between the hooks. Rank is the id itself in odd rounds, in which a star
    vanishes at once, and random in even ones, in which long chains shrink by a constant part. A
    find then follows the hooks back from the last round to the first. All steps are aggregates
    with a map-side part and joins, each round is staged, and links get fewer in every round.
    """
    a, b = links.columns
    links = common.stage(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "links")
    hooks = []
    rounds = 0
    while not links.isEmpty():
        rounds += 1
        rank = F.col("b") if rounds % 2 else F.xxhash64("b", F.lit(rounds))
        own = F.col("a") if rounds % 2 else F.xxhash64("a", F.lit(rounds))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min_by("b", rank).alias("b"), F.min(rank).alias("r"))
        hook = common.stage(hook.select(F.col("a").alias("id"), F.when(F.col("r") < own, F.col("b")).otherwise(F.col("a")).alias("to")), "hooks")
        hooks.append(hook)
        links = common.stage(
            links.join(hook.toDF("a", "x"), "a").join(hook.toDF("b", "y"), "b")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a <> b").distinct(), "links")
    if not hooks:
        return links.select(F.col("a").alias("id"), F.col("b").alias("root"))
    found = hooks[-1]
    for hook in hooks[-2::-1]:
        found = hook.join(found.toDF("to", "further"), "to", "left").select("id", F.coalesce("further", "to").alias("to"))
    found = common.stage(found, "found")
    least = found.groupBy("to").agg(F.min("id").alias("root"))
    return common.stage(found.join(least, "to").select("id", "root"), "components")
