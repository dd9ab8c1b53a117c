"""Join patterns: densification, anti-join, dedupe, hierarchy, expression keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def densify_left(dim: DataFrame, agg: DataFrame, keys: list[str], fill_cols: list[str]) -> DataFrame:
    """Every dimension row kept (zeros when inactive); keys missing from the
    dimension are dropped."""
    return dim.join(agg, keys, "left").fillna(0, subset=fill_cols)


def densify_outer(dim: DataFrame, agg: DataFrame, keys: list[str], fill_cols: list[str]) -> DataFrame:
    """Outer alignment: dimension rows and unknown keys are both kept; null
    key parts equal each other."""
    named = agg.withColumnsRenamed({k: f"_agg_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_agg_{k}"))
    out = dim.withColumn("_in_dim", F.lit(True)).join(named.withColumn("_in_agg", F.lit(True)), same, "full")
    keyed = [F.when(F.col("_in_dim"), F.col(k)).otherwise(F.col(f"_agg_{k}")).alias(k) for k in keys]
    rest = [c for c in dim.columns if c not in keys] + [c for c in agg.columns if c not in keys]
    return out.select(*keyed, *rest).fillna(0, subset=fill_cols)


def untouched(all_keys: DataFrame, active: DataFrame, key: str) -> DataFrame:
    """All minus active (left anti-join; no shuffle of the big side's rows
    beyond its distinct keys)."""
    return all_keys.join(active.select(key).distinct(), key, "left_anti")


def dedupe_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Keep the first row per key under an explicit ascending order (nulls
    first), ties broken by the whole row, so the pick is deterministic
    (unlike ``dropDuplicates``).

    ``min_by`` has map-side partial aggregation (sorted, for rows of text), so a
    key holding a large share of the rows is reduced before the shuffle
    instead of being sorted in one window partition.
    """
    rest = [c for c in df.columns if c not in keys]
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    rank = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order_cols)],
                    *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)])
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), rank).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*df.columns)


def union_slices(slices: list[DataFrame]) -> DataFrame:
    """Bag union by column name; a column missing from a slice is null
    there.  (For slices of one table prefer a single scan with ``isin``.)"""
    out = slices[0]
    for df in slices[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def typed_parent(child: DataFrame, orgs: DataFrame, child_key: str, child_type: str,
                 parent_type: str) -> DataFrame:
    """child -> org of ``child_type`` -> its parent of ``parent_type``.

    The type tests are applied to the right sides *before* the left joins,
    i.e. they stay in the ON clause and unmatched children survive.
    """
    c = orgs.where(F.col("org_type") == child_type).select(
        F.col("org_id").alias("_cid"), F.col("org_name").alias(f"{child_type}_name"),
        F.col("parent_id").alias("_pid"))
    p = orgs.where(F.col("org_type") == parent_type).select(
        F.col("org_id").alias("_pid"), F.col("org_name").alias(f"{parent_type}_name"))
    out = child.join(c, child[child_key] == c["_cid"], "left").join(p, "_pid", "left")
    return out.drop("_cid", "_pid")


def expression_key_join(left: DataFrame, right: DataFrame, key_expr, right_key: str,
                        how: str = "left") -> DataFrame:
    """Join on a computed key (e.g. COALESCE of two columns): materialise the
    key as a column first so the join stays an equi-join."""
    return left.withColumn("_k", key_expr).join(right.withColumnRenamed(right_key, "_k"), "_k", how).drop("_k")
