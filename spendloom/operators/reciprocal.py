"""Costs of centres that serve one another, passed on until all of them lie with owners.

Shares form a sparse matrix, a row for each (origin, target).  It is squared, so that after k rounds it tells where
costs are after 2^k steps; what an owner holds stays.  The rounds end when no centre's cost is still with serving
centres, up to ``TOLERANCE``, which is measured.  Periods and lines take no part in this: their sums are
multiplied once, at the end.  Rounds are written tables of at most serving centres times centres.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.session import scratch_folder

TOLERANCE = 1e-13  # the part of a centre's cost that may still move
MOST_ROUNDS = 30


def _shares(weights: DataFrame) -> DataFrame:
    """(origin, target, share): each centre's weights as shares of one; a centre doesn't serve itself."""
    given = weights.where("origin <> target AND weight <> 0").groupBy("origin", "target").agg(F.sum("weight").alias("weight"))
    if (bad := weights.where("weight < 0").first()) is not None:
        raise ValueError(f"negative weight from {bad['origin']}")
    given = given.withColumn("weight", F.col("weight").cast("double"))
    totals = given.groupBy("origin").agg(F.sum("weight").alias("total"))
    return given.join(totals, "origin").select("origin", "target", (F.col("weight") / F.col("total")).alias("share"))


def _written(df: DataFrame) -> DataFrame:
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def final_shares(weights: DataFrame, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """(origin, target, share): what part of each serving centre's cost ends with which owner."""
    shares = _written(_shares(weights))
    serving = shares.select(F.col("origin").alias("target")).distinct()
    for _ in range(most_rounds):
        moving = shares.join(serving, "target", "left_semi").groupBy("origin").agg(F.sum("share").alias("part"))
        most = moving.orderBy(F.desc("part"), "origin").first()
        if most is None or most["part"] <= TOLERANCE:
            return shares.join(serving, "target", "left_anti")
        onward = shares.select(F.col("origin").alias("via"), F.col("target").alias("next"), F.col("share").alias("onward"))
        both = shares.join(onward, F.col("target") == F.col("via"), "left")  # an owner has no row there and keeps its part
        part = F.col("share") * F.coalesce("onward", F.lit(1.0))
        shares = _written(both.groupBy("origin", F.coalesce("next", "target").alias("target")).agg(F.sum(part).alias("share")))
    raise ValueError(f"costs of centre {most['origin']} reach no owner: {most['part']} of them still moves")


def allocate_reciprocal(costs: DataFrame, weights: DataFrame, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """(billing_period, owner, own_cost, allocated_cost) after all serving centres have passed on their cost.

    ``costs`` has (billing_period, centre, cost), ``weights`` (origin, target, weight).  A centre with a weight
    to another one serves; all others are owners.  Costs of a period are conserved up to ``TOLERANCE``.
    Centres that serve only one another never reach an owner: that fails and names one.  Rows of one centre
    are summed, null costs are 0, a null centre is an owner of its own.
    """
    final = final_shares(weights, most_rounds)
    own = costs.groupBy("billing_period", "centre").agg(F.coalesce(F.sum(F.col("cost").cast("double")), F.lit(0.0)).alias("cost"))
    given = own.join(final, F.col("centre") == F.col("origin"), "left")
    ended = given.groupBy("billing_period", F.coalesce("target", "centre").alias("owner"))
    return ended.agg(
        F.sum(F.when(F.col("origin").isNull(), F.col("cost")).otherwise(0.0)).alias("own_cost"),
        F.sum(F.col("cost") * F.coalesce("share", F.lit(1.0))).alias("allocated_cost"),
    )


def allocate_step_down(costs: DataFrame, weights: DataFrame, order: Sequence[str]) -> DataFrame:
    """The same, but each serving centre of ``order`` charges only owners and the serving centres after it.

    Every serving centre must be in ``order``.  Nothing moves in circles then, so the steps end by themselves.
    """
    place = F.create_map(*[F.lit(x) for pair in zip(order, range(len(order))) for x in pair]) if order else F.create_map().cast("map<string,int>")
    origin, target = F.try_element_at(place, "origin"), F.try_element_at(place, "target")
    serving = weights.where("origin <> target")
    if (unknown := serving.where(origin.isNull()).first()) is not None:
        raise ValueError(f"no place in the order for {unknown['origin']}")
    return allocate_reciprocal(costs, serving.where(target.isNull() | (target > origin)))
