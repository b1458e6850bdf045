"""Table-contract checks (NOT NULL, value rules, keys) as aggregate jobs.

Each returns a small DataFrame of violation counts; ``assert_clean`` turns
one into an exception. Every check is one aggregation pass (or one
anti join for foreign keys), never a row-by-row scan on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """One row per column: NULL count."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return agg.selectExpr(f"stack({len(columns)}, {stack}) as (column_name, n_violations)") \
        .withColumn("table_name", F.lit(table)).withColumn("check", F.lit("not_null"))


def duplicate_keys(df: DataFrame, key: Sequence[str], table: str) -> DataFrame:
    """Count of key values occurring more than once (and the extra rows)."""
    dup = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    return dup.agg(F.count(F.lit(1)).alias("n_duplicate_keys"),
                   F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("n_extra_rows")) \
        .withColumns({"table_name": F.lit(table), "key": F.lit(",".join(key))})


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
            table: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent: keys are counted first, so
    the anti join sees one row per distinct key and a hot key is one row."""
    c = (child.select(F.col(child_key).alias("__k")).where(F.col("__k").isNotNull())
         .groupBy("__k").agg(F.count(F.lit(1)).alias("__n")))
    p = parent.select(F.col(parent_key).alias("__k"))
    return c.join(p, "__k", "left_anti").agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("n_orphans")) \
        .withColumns({"table_name": F.lit(table), "fk": F.lit(f"{child_key}->{parent_key}")})


def orphans_many(child: DataFrame, keys: Sequence[tuple[str, DataFrame, str]], table: str) -> DataFrame:
    """:func:`orphans` for several foreign keys ``(child_key, parent, parent_key)``
    in one scan of the child: (key number, value) pairs are counted before the
    shuffle, and one anti join meets the parents' pairs. A row per key, 0 if clean.
    The keys' types must have a common one."""
    pairs = child.select(F.posexplode(F.array(*[F.col(k) for k, _, _ in keys])).alias("__at", "__k"))
    counts = pairs.where(F.col("__k").isNotNull()).groupBy("__at", "__k").agg(F.count(F.lit(1)).alias("__n"))
    parents = None
    for i, (_, parent, parent_key) in enumerate(keys):
        own = parent.select(F.lit(i).alias("__at"), F.col(parent_key).alias("__k"))
        parents = own if parents is None else parents.unionByName(own)
    bad = counts.join(parents, ["__at", "__k"], "left_anti").groupBy("__at").agg(F.sum("__n").alias("__n"))
    found = bad.agg(F.map_from_entries(F.collect_list(F.struct("__at", "__n"))).alias("__found"))
    names = F.array(*[F.lit(f"{c}->{p}") for c, _, p in keys])
    return found.select("__found", F.posexplode(names).alias("__at", "fk")).select(
        F.coalesce(F.try_element_at("__found", F.col("__at")), F.lit(0)).cast("long").alias("n_orphans"),
        F.lit(table).alias("table_name"), "fk")


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """Schema-only check, no job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"table lacks {missing}")


def assert_clean(report: DataFrame, count_col: str) -> None:
    bad = report.where(F.col(count_col) > 0).limit(5).collect()
    if bad:
        raise ValueError(f"Contract violations: {[r.asDict() for r in bad]}")


def one_to_one_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join that must be one-to-one and cover both sides: duplicate
    keys on either side or unmatched rows raise (small aggregate / anti-join
    jobs), otherwise the join is returned."""
    for side, df in (("left", left), ("right", right)):
        d = duplicate_keys(df, list(keys), side).first()
        if d.n_duplicate_keys:
            raise ValueError(f"{side} side has {d.n_duplicate_keys} duplicate keys on {list(keys)}")
    for a, b, name in ((left, right, "left"), (right, left, "right")):
        if not a.select(*keys).join(b.select(*keys), list(keys), "left_anti").isEmpty():
            raise ValueError(f"{name} side has rows without a match on {list(keys)}")
    return left.join(right, list(keys))


def contract_report(df: DataFrame, table: str, not_null: Sequence[str] = (),
                    rules: dict[str, Column] | None = None) -> DataFrame:
    """NOT NULL counts and rule violations of one table in ONE aggregation
    pass, as rows ``(table_name, check, column_name, n_violations)``."""
    rules = rules or {}
    aggs = [F.count_if(F.col(c).isNull()).alias(f"nn__{c}") for c in not_null]
    aggs += [F.count_if(~r).alias(f"rule__{n}") for n, r in rules.items()]
    agg = df.agg(*aggs)
    items = [("not_null", c, f"nn__{c}") for c in not_null] + [("rule", n, f"rule__{n}") for n in rules]
    stack = ", ".join(f"'{k}', '{c}', `{a}`" for k, c, a in items)
    return agg.selectExpr(f"stack({len(items)}, {stack}) as (check, column_name, n_violations)") \
        .select(F.lit(table).alias("table_name"), "check", "column_name",
                F.col("n_violations").cast("long").alias("n_violations"))
