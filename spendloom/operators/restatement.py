"""What a restated period changed: two versions of its lines compared as multisets.

A line's fingerprint is a 128-bit digest of all its columns, so lines are counted by (line id, fingerprint), on
the map side first: whatever is equal cancels there, however often it repeats.  What is left is counted by
line id.  Neither step is a join, and no line meets another line of its id in memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.functions.scalars import AMOUNT


def _same_types(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with text where a column's types differ; two types of numbers are left to the union, which widens them."""
    kinds = {field.name: field.dataType for field in new.schema}
    differ = [
        field.name
        for field in old.schema
        if field.name in kinds
        and field.dataType != kinds[field.name]
        and not (isinstance(field.dataType, T.NumericType) and isinstance(kinds[field.name], T.NumericType))
    ]
    text = {name: F.col(f"`{name}`").cast("string") for name in differ}
    return old.withColumns(text), new.withColumns(text)


def restated_lines(old: DataFrame, new: DataFrame, line_id: str, cost: str, watched: Sequence[str] = ()) -> DataFrame:
    """(line id, added, removed, changed, old_cost, new_cost, cost_delta[, changed_columns]) of each id whose lines differ.

    Lines equal in all columns cancel, one for one; a column that a version lacks is null there.  Of what is
    left, an id's lines of the old version pair with its lines of the new one (``changed``), the rest was
    ``added`` or ``removed``.  ``old_cost`` and ``new_cost`` sum the lines that did not cancel (null costs are 0).
    ``changed_columns`` names, in their order, the ``watched`` columns whose values differ between those lines.
    Lines without an id are compared with one another.  Two equal versions give no rows.
    """
    old, new = _same_types(old, new)
    both = old.withColumn("_side", F.lit(-1)).unionByName(new.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    names = sorted(name for name in both.columns if name != "_side")
    # Null fields are left out of the text, so a null and a missing column agree, but values never change places.
    digest = F.unhex(F.md5(F.to_json(F.struct(*[F.col(f"`{name}`") for name in names]))))
    values = F.array(*[F.xxhash64(F.col(f"`{name}`").isNull(), F.col(f"`{name}`")) for name in watched]).cast("array<bigint>")
    lines = both.select(F.col(f"`{line_id}`").alias("line"), digest.alias("digest"), "_side", F.col(f"`{cost}`").cast(AMOUNT).alias("cost"), values.alias("hashes"))
    counted = lines.groupBy("line", "digest").agg(
        F.sum("_side").alias("more"), F.any_value("cost").alias("cost"), F.any_value("hashes").alias("hashes")
    ).where("more <> 0")
    added, removed = F.greatest("more", F.lit(0)), F.greatest(-F.col("more"), F.lit(0))
    amount = F.coalesce("cost", F.lit(0).cast(AMOUNT))
    # The signed sum of a column's hashes is zero when both sides hold the same values as often.
    moved = [F.sum(F.col("hashes")[i].cast("decimal(20,0)") * F.col("more").cast("decimal(18,0)")).alias(f"_moved{i}") for i in range(len(watched))]
    found = counted.groupBy("line").agg(
        F.sum(added).alias("a"), F.sum(removed).alias("r"),
        F.sum(removed * amount).cast(AMOUNT).alias("old_cost"), F.sum(added * amount).cast(AMOUNT).alias("new_cost"), *moved,
    )
    pairs = F.least("a", "r")
    told = [
        F.col("line").alias(line_id), (F.col("a") - pairs).alias("added"), (F.col("r") - pairs).alias("removed"), pairs.alias("changed"),
        "old_cost", "new_cost", (F.col("new_cost") - F.col("old_cost")).cast(AMOUNT).alias("cost_delta"),
    ]
    if watched:
        named = F.array(*[F.when(F.col(f"_moved{i}") != 0, F.lit(name)) for i, name in enumerate(watched)])
        told.append(F.array_compact(named).alias("changed_columns"))
    return found.select(*told)


def restatement_summary(differences: DataFrame) -> DataFrame:
    """One row: the ids that differ, lines added, removed and changed, and the cost they moved."""
    return differences.agg(
        F.count(F.lit(1)).alias("line_ids"), *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("added", "removed", "changed")],
        F.coalesce(F.sum("cost_delta").cast(AMOUNT), F.lit(0).cast(AMOUNT)).alias("cost_delta"),
    )
