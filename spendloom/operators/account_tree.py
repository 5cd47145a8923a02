"""Tags handed down a tree of accounts, by pointers that double their reach.

Each account holds the tags from itself up to an account above it, its pointer.  A round replaces the pointer
by the pointer of that account and adds its tags, so that depth ``d`` takes about ``log2(d)`` rounds, each one
join of a written table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.operators.allocation import inherited_tags
from spendloom.session import scratch_folder


def _written(df: DataFrame) -> DataFrame:
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _further(walked: DataFrame) -> DataFrame:
    """(account, depth, tags, above) with twice the reach; ``above`` is null once a root's tags are in."""
    waiting = walked.where("above IS NOT NULL")
    # Few accounts may be above very many: only they are sent to meet those.
    named = waiting.select(F.col("above").alias("account")).distinct()
    upper = walked.join(named, "account", "left_semi").select(
        F.col("account").alias("above"), F.col("depth").alias("_depth"), F.col("tags").alias("_tags"), F.col("above").alias("_above")
    )
    moved = waiting.join(upper, "above").select(
        "account", (F.col("depth") + F.col("_depth")).alias("depth"), inherited_tags(F.col("tags"), F.col("_tags")).alias("tags"), F.col("_above").alias("above")
    )
    return walked.where("above IS NULL").unionByName(moved)


def tags_of_accounts(accounts: DataFrame) -> DataFrame:
    """(account, depth, tags): each account's tags over those of all accounts above it.

    ``accounts`` has (account, parent, tags); the nearest account that names a tag wins.  An account without a
    parent, or with one that is not listed, is a root.  Accounts that are their own ancestors are below no root:
    the query fails and names one.  Rows of equal account and parent are one (the largest of each tag stays),
    rows that name two parents fail; a null account is dropped.
    """
    entry = F.explode_outer(F.coalesce(F.col("tags"), F.create_map().cast("map<string,string>")))
    each = accounts.where("account IS NOT NULL").select("account", "parent", entry.alias("key", "value"))
    named = each.groupBy("account", "key").agg(F.max("value").alias("value"), F.max("parent").alias("parent"), F.min("parent").alias("other"), F.count("parent").alias("named"), F.count(F.lit(1)).alias("rows"))
    entries = F.filter(F.collect_list(F.struct("key", "value")), lambda e: e["key"].isNotNull())
    one = named.groupBy("account").agg(
        F.max("parent").alias("parent"),
        ((F.min("other") != F.max("parent")) | ((F.sum("named") > 0) & (F.sum("named") < F.sum("rows")))).alias("split"),
        F.map_from_entries(entries).alias("tags"),
    )
    failure = F.raise_error(F.concat(F.lit("two parents of account "), F.col("account").cast("string")))
    one = one.withColumn("parent", F.when(F.coalesce("split", F.lit(False)), failure.cast(one.schema["parent"].dataType)).otherwise(F.col("parent"))).drop("split")
    one = _written(one)
    named = one.where("parent IS NOT NULL").select(F.col("parent").alias("account")).distinct()
    known = one.select("account").join(named, "account", "left_semi").select(F.col("account").alias("parent"), F.col("account").alias("above"))
    linked = one.where("parent IS NOT NULL").join(known, "parent", "left").select("account", "tags", "above")
    linked = linked.unionByName(one.where("parent IS NULL").select("account", "tags", F.col("parent").alias("above")))
    walked = _written(linked.select("account", F.when(F.col("above").isNull(), 0).otherwise(1).cast("bigint").alias("depth"), "tags", "above"))
    reach, accounts_in_all = 1, walked.count()
    while reach < accounts_in_all and not walked.where("above IS NOT NULL").isEmpty():
        walked = _written(_further(walked))
        reach *= 2
    # No path is longer than there are accounts: what still waits never gets to a root.
    lost = F.raise_error(F.concat(F.lit("account "), F.col("account").cast("string"), F.lit(" is above itself")))
    return walked.select(
        "account", F.when(F.col("above").isNotNull(), lost.cast("int")).otherwise(F.col("depth").cast("int")).alias("depth"), "tags"
    )


def tags_of_lines(lines: DataFrame, accounts: DataFrame, account: str, tags: Column) -> DataFrame:
    """Lines with ``all_tags``: their own tags over their account's and those above it."""
    handed = tags_of_accounts(accounts).select(F.col("account").alias("_account"), F.col("tags").alias("_tags"))
    joined = lines.join(handed, lines[account] == F.col("_account"), "left")
    return joined.withColumn("all_tags", inherited_tags(tags, F.col("_tags"))).drop("_account", "_tags")
