"""Keyed merging with one rule per column.

* overwrite: the newest value given wins; giving none (null) leaves the old one.
* increment: values add up on top of the last overwrite.
* insert_only: the first value given stays.

`upsert` merges one batch into one table. `as_delta` and `fold` do the same over any number
of stored commits, which is what makes a repeated commit harmless.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OVERWRITE, INCREMENT, INSERT_ONLY = "overwrite", "increment", "insert_only"
SUFFIX = {OVERWRITE: "set", INCREMENT: "add", INSERT_ONLY: "init"}
COMMIT = ("seq", "writer")


def _check(policy: Mapping[str, str]) -> None:
    unknown = set(policy.values()) - set(SUFFIX)
    if unknown:
        raise ValueError(f"unknown merge rule: {sorted(unknown)}")


def _sum_as_given(df: DataFrame, value: Column, name: str) -> Column:
    """Sum cast back to the column's own type; exact types overflow to an error, not a wrap."""
    return F.sum(value).cast(df.schema[name].dataType)


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], policy: Mapping[str, str]) -> DataFrame:
    """Target after the batch. Columns without a rule are kept from the target.

    One grouped union instead of a full outer join: a single shuffle with partial
    aggregation on both inputs, and no join on a key that one side may repeat.
    """
    _check(policy)
    kept = [c for c in target.columns if c not in keys and c not in policy]
    old = target.select(*keys, *kept, *policy, F.lit(0).alias("_new"))
    new = batch.select(*keys, *policy, F.lit(1).alias("_new"))
    rows = old.unionByName(new, allowMissingColumns=True)
    was = lambda c: F.max(F.when(F.col("_new") == 0, F.col(c)))
    now = lambda c: F.max(F.when(F.col("_new") == 1, F.col(c)))
    out = [was(c).alias(c) for c in kept]
    for c, rule in policy.items():
        if rule == INCREMENT:
            out.append(_sum_as_given(target, F.col(c), c).alias(c))
        elif rule == OVERWRITE:
            out.append(F.coalesce(now(c), was(c)).alias(c))
        else:
            out.append(F.coalesce(was(c), now(c)).alias(c))
    return rows.groupBy(*keys).agg(*out).select(*target.columns)


def insert_or_touch(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct batch keys the target does not hold yet."""
    return batch.select(*keys).distinct().join(target.select(*keys), keys, "left_anti")


def zero_stale(current: DataFrame, batch: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """The batch plus a zero for every stored non-zero measure it gives no value for.

    Pass the part of the current table that the batch recomputes. Both sides hold a key once.
    """
    held = lambda m: F.when(F.col(m) != 0, F.lit(0).cast(batch.schema[m].dataType)).alias(f"_zero_{m}")
    rows = batch.unionByName(current.select(*keys, *[held(m) for m in measures]), allowMissingColumns=True)
    others = [c for c in batch.columns if c not in keys and c not in measures]
    return rows.groupBy(*keys).agg(
        *[F.coalesce(F.max(m), F.max(f"_zero_{m}")).alias(m) for m in measures], *[F.max(c).alias(c) for c in others]
    )


def delta_columns(values: Mapping[str, str]) -> dict[str, str]:
    return {f"{c}__{s}": t for c, t in values.items() for s in SUFFIX.values()}


def as_delta(
    batch: DataFrame, keys: Mapping[str, str], values: Mapping[str, str], policy: Mapping[str, str],
    unique: bool = False,
) -> DataFrame:
    """One row per key with each value in the column of its rule; other columns null.

    Repeated keys are merged first, unless the batch is known to hold none.
    """
    _check(policy)
    pick = {OVERWRITE: F.max, INCREMENT: F.sum, INSERT_ONLY: F.min}
    names = {c: f"{c}__{SUFFIX[r]}" for c, r in policy.items()}
    rows = batch.select(
        *[F.col(k).cast(t).alias(k) for k, t in keys.items()],
        *[F.col(c).cast(values[c]).alias(n) for c, n in names.items()],
    )
    if not unique:
        aggs = [pick[policy[c]](n).cast(values[c]).alias(n) for c, n in names.items()]
        rows = rows.groupBy(*keys).agg(*aggs) if aggs else rows.distinct()
    present = set(rows.columns)
    return rows.select(
        *keys, *[F.col(n) if n in present else F.lit(None).cast(t).alias(n) for n, t in delta_columns(values).items()]
    )


def fold(deltas: DataFrame, keys: Mapping[str, str], values: Mapping[str, str]) -> DataFrame:
    """Current table from stored deltas, whatever order they are read in.

    Numbers: last overwrite plus later increments. Other values: last overwrite, else the
    first insert. Every delta holds a key once, so a key has at most one row per commit.
    """
    if not values:
        return deltas.select(*keys).distinct()
    commit = F.struct(*COMMIT)
    numeric = [c for c, t in values.items() if t != "string"]
    rows = deltas
    if numeric:
        per_key = Window.partitionBy(*keys)
        rows = rows.withColumns(
            {f"_last_{c}": F.max(F.when(F.col(f"{c}__set").isNotNull(), commit)).over(per_key) for c in numeric}
        )
    out = []
    for c, t in values.items():
        given = lambda s: F.when(F.col(f"{c}__{s}").isNotNull(), commit)  # noqa: B023, E731
        last = F.max_by(f"{c}__set", given("set"))
        first = F.min_by(f"{c}__init", given("init"))
        value = F.coalesce(last, first)
        if c in numeric:
            newest = F.col(f"_last_{c}")
            later = F.sum(F.when(newest.isNull() | (commit > newest), F.col(f"{c}__add")))
            value = F.when(
                value.isNotNull() | later.isNotNull(), F.coalesce(value, F.lit(0)) + F.coalesce(later, F.lit(0))
            )
        out.append(value.cast(t).alias(c))
    return rows.groupBy(*keys).agg(*out)
