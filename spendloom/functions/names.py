"""Column and table names: one canonical form, and the ways the others lead to it."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.functions.fixed_values import (
    AMOUNT_COLUMNS,
    COLUMN_CATEGORIES,
    REQUIRED_REPORT_COLUMNS,
    TABLE_NAME_LENGTH,
    TABLE_NAME_PREFIX,
    TIMESTAMP_COLUMNS,
)

_WORD_START = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")


def canonical_name(raw: str) -> str:
    """``lineItem/UnblendedCost`` (or its ``_`` form) -> ``line_item_unblended_cost``."""
    words = _WORD_START.sub("_", raw)
    return re.sub(r"[^a-z0-9]+", "_", words.lower()).strip("_")


def _known_raw_names() -> list[str]:
    return sorted({*REQUIRED_REPORT_COLUMNS, *AMOUNT_COLUMNS, *TIMESTAMP_COLUMNS})


def name_aliases() -> dict[str, str]:
    """Other spellings of the known columns -> canonical name.

    Squashed (``lineitem_unblendedcost``) always; prefix-less (``unblended_cost``)
    only where no two categories share the short name.
    """
    aliases: dict[str, str] = {}
    short: dict[str, set[str]] = {}
    for raw in _known_raw_names():
        canonical = canonical_name(raw)
        aliases[raw.replace("/", "_").lower()] = canonical
        short.setdefault(canonical_name(raw.split("/", 1)[1]), set()).add(canonical)
    for name, targets in short.items():
        if len(targets) == 1:
            aliases.setdefault(name, next(iter(targets)))
    return aliases


def _reject_collisions(pairs: Iterable[tuple[str, str]]) -> None:
    seen: dict[str, str] = {}
    for old, new in pairs:
        other = seen.setdefault(new.lower(), old)
        if other != old:
            raise ValueError(f"columns {other!r} and {old!r} both become {new!r}")


def clean_columns(df: DataFrame) -> DataFrame:
    """Replace ``/`` by ``_`` in every column name, nothing else."""
    new = [c.replace("/", "_") for c in df.columns]
    _reject_collisions(zip(df.columns, new))
    return df.toDF(*new)


def canonical_columns(
    names: Iterable[str], overrides: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Raw -> canonical for a header; two raw names meeting in one is an error."""
    aliases = name_aliases()
    chosen = overrides or {}
    mapping = {}
    for raw in names:
        name = canonical_name(raw)
        mapping[raw] = chosen.get(raw) or aliases.get(raw.lower()) or aliases.get(name) or name
    _reject_collisions(mapping.items())
    return mapping


def report_column_order(names: Iterable[str]) -> list[str]:
    """Raw report columns by category in report order, alphabetical inside each."""
    rank = {category: i for i, category in enumerate(COLUMN_CATEGORIES)}
    return sorted(
        names,
        key=lambda n: (rank.get(n.split("/", 1)[0], len(rank)) if "/" in n else len(rank), n),
    )


def table_name(name: Column) -> Column:
    """Export name -> safe table name."""
    # Unicode white space plus the four ASCII separators that class leaves out.
    spaced = F.regexp_replace(F.lower(name), r"(?U)[\s\x1c-\x1f\-/\\]+", "_")
    plain = F.regexp_replace(spaced, "[^a-z0-9_]", "")
    lettered = F.when(plain.rlike("^[a-z]"), plain).otherwise(
        F.concat(F.lit(TABLE_NAME_PREFIX), plain)
    )
    single = F.regexp_replace(lettered, "_+", "_")
    return F.substring(F.btrim(single, F.lit("_")), 1, TABLE_NAME_LENGTH)


def period_table_name(export_name: Column, billing_period: Column) -> Column:
    """``{export}_{YYYY}_{MM}``."""
    return F.concat_ws("_", table_name(export_name), F.translate(billing_period, "-", "_"))


def period_of_table(name: Column) -> Column:
    """Billing period from the last two parts of a table name, else ``unknown``."""
    parts = F.split(name, "_")
    return F.when(
        F.size(parts) >= 2,
        F.concat_ws("-", F.element_at(parts, -2), F.element_at(parts, -1)),
    ).otherwise(F.lit("unknown"))
