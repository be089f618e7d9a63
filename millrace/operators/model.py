"""Bringing a data model up to date: conform, keep old readers working, profile, check."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import broadcast_if_small


def conform_schema(df: DataFrame, target: StructType, mapping: dict[str, Column]) -> DataFrame:
    """Exactly the target's names, order and types.

    A required column without a mapping raises here. A value that does not fit
    its type, or a null in a required column, fails the job.
    """
    missing = [f.name for f in target if not f.nullable and f.name not in mapping]
    if missing:
        raise ValueError(f"required columns without a mapping: {missing}")
    unknown = [name for name in mapping if name not in target.names]
    if unknown:
        raise ValueError(f"mapping for columns the target does not have: {unknown}")
    columns = []
    for field in target:
        value = mapping.get(field.name, F.lit(None)).cast(field.dataType)
        if not field.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"null in required {field.name}")))
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def compat_view(
    core: DataFrame, lookups: dict[str, DataFrame], legacy_columns: list[str]
) -> DataFrame:
    """The old table shape on the new tables: each key column joined back to its lookup."""
    joined = core
    for key_name, lookup in lookups.items():
        joined = joined.join(broadcast_if_small(lookup), key_name, "left")
    return joined.select(*legacy_columns)


def profile_columns(df: DataFrame) -> DataFrame:
    """(column_name, row_count, null_count, distinct_count), from one pass over the data."""
    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, name in enumerate(df.columns):
        measures.append(F.count(F.col(name)).alias(f"_filled_{i}"))
        measures.append(F.count_distinct(F.col(name)).alias(f"_distinct_{i}"))
    one_row = df.agg(*measures)
    per_column = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("_rows").alias("row_count"),
            (F.col("_rows") - F.col(f"_filled_{i}")).alias("null_count"),
            F.col(f"_distinct_{i}").alias("distinct_count"),
        )
        for i, name in enumerate(df.columns)
    ]
    return one_row.select(F.inline(F.array(*per_column)))


@dataclass(frozen=True)
class UniqueKey:
    name: str
    table: str
    cols: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    """A child row with a null key part refers to nothing and passes."""

    name: str
    child: str
    child_cols: tuple[str, ...]
    parent: str
    parent_cols: tuple[str, ...]


@dataclass(frozen=True)
class Domain:
    """A predicate on single rows; null passes, as in a CHECK constraint."""

    name: str
    table: str
    predicate: Column


@dataclass(frozen=True)
class CrossTable:
    """A predicate on pairs of rows that share a key, ``right`` being unique on it."""

    name: str
    left: str
    left_cols: tuple[str, ...]
    right: str
    right_cols: tuple[str, ...]
    predicate: Column


Rule = UniqueKey | ForeignKey | Domain | CrossTable


def check_constraints(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """(rule, checked, violations), one row per rule, zero violations included."""
    reports = []
    row_rules: dict[str, list[Domain]] = {}
    for rule in rules:
        if isinstance(rule, Domain):
            row_rules.setdefault(rule.table, []).append(rule)
        elif isinstance(rule, UniqueKey):
            reports.append(_unique_report(tables, rule))
        elif isinstance(rule, ForeignKey):
            reports.append(_foreign_report(tables, rule))
        else:
            reports.append(_cross_report(tables, rule))
    for table, domain_rules in row_rules.items():
        reports.append(_domain_report(tables[table], domain_rules))
    return reduce(DataFrame.unionByName, reports)


def _report(name: str, checked: Column, violations: Column) -> list[Column]:
    return [
        F.lit(name).alias("rule"),
        F.coalesce(checked, F.lit(0)).cast("bigint").alias("checked"),
        F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"),
    ]


def _unique_report(tables: dict[str, DataFrame], rule: UniqueKey) -> DataFrame:
    # As in SQL, and as for foreign keys, a key with a null in it is equal to no other.
    copies = tables[rule.table].groupBy(*rule.cols).agg(F.count(F.lit(1)).alias("_n"))
    filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule.cols])
    surplus = F.when(filled, F.col("_n") - 1).otherwise(0)
    return copies.agg(*_report(rule.name, F.sum("_n"), F.sum(surplus)))


def _foreign_report(tables: dict[str, DataFrame], rule: ForeignKey) -> DataFrame:
    # Counting per key first makes a hot key one row before the join.
    child = tables[rule.child].groupBy(*rule.child_cols).agg(F.count(F.lit(1)).alias("_n"))
    renamed = [f"_parent_{c}" for c in rule.parent_cols]
    parent = tables[rule.parent].select(
        *[F.col(c).alias(r) for c, r in zip(rule.parent_cols, renamed)]
    ).distinct()
    same = reduce(
        lambda a, b: a & b, [F.col(c) == F.col(r) for c, r in zip(rule.child_cols, renamed)]
    )
    joined = child.join(parent, same, "left")
    filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule.child_cols])
    orphan = filled & F.col(renamed[0]).isNull()
    return joined.agg(
        *_report(rule.name, F.sum("_n"), F.sum(F.when(orphan, F.col("_n")).otherwise(0)))
    )


def _cross_report(tables: dict[str, DataFrame], rule: CrossTable) -> DataFrame:
    left, right = tables[rule.left], tables[rule.right]
    same = reduce(
        lambda a, b: a & b,
        [F.col(a) == F.col(b) for a, b in zip(rule.left_cols, rule.right_cols)],
    )
    pairs = left.join(right, same)
    return pairs.agg(*_report(rule.name, F.count(F.lit(1)), F.count_if(~rule.predicate)))


def _domain_report(df: DataFrame, rules: list[Domain]) -> DataFrame:
    counts = [F.count_if(~r.predicate).alias(f"_bad_{i}") for i, r in enumerate(rules)]
    rows = [
        F.struct(*_report(r.name, F.col("_rows"), F.col(f"_bad_{i}")))
        for i, r in enumerate(rules)
    ]
    one_row = df.agg(F.count(F.lit(1)).alias("_rows"), *counts)
    return one_row.select(F.inline(F.array(*rows)))
