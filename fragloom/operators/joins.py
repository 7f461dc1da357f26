"""Join helpers that hold when one key owns a large share of the rows."""

from pyspark.sql import DataFrame, Window, functions as F

#: Bytes of a lookup, by the optimizer's estimate, up to which it is sent to every task.
BROADCAST_BYTES = 32 << 20
SALTS = 16


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of `df`: no job, and no less than its input sizes say."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def has_at_most(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def lookup_join(big, small, on, how="inner", residual=None, max_bytes=BROADCAST_BYTES, salts=None, grows=False):
    """Join many rows of `big` to a lookup table.

    A lookup that is estimated at up to `max_bytes` is broadcast. Beyond that the plan carries no
    hint: adaptive execution broadcasts it where its real size allows, and splits hot keys of `big`
    in the sort-merge join otherwise. `grows` tells that the lookup holds rows that explode makes or
    long texts: no estimate sees those, that of adaptive execution included, so beyond `max_bytes`
    it is merged by a hint and never sent through the driver. With `salts` both sides are shuffled on
    the keys plus a salt instead, for keys known to be hot: rows of `big` with one key are spread over
    so many tasks and the lookup is repeated for each, so inner, left, left-semi and left-anti results
    stay whole.
    """
    on = list(on)
    hint = lambda df: df.hint("merge") if grows else df
    if planned_bytes(small) <= max_bytes:
        hint = F.broadcast
    elif salts:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), F.lit(salts).cast("long"))
        big = big.withColumn("_salt", salt)
        small = small.withColumn(
            "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        on = on + ["_salt"]
    # Keys of the lookup get names of their own: both sides may share a lineage.
    others = [c for c in small.columns if c not in on]
    lookup = small.select(*[F.col(k).alias(f"_key_{k}") for k in on], *others)
    condition = residual if residual is not None else F.lit(True)
    for key in on:
        condition = condition & (F.col(key) == F.col(f"_key_{key}"))
    joined = big.join(hint(lookup), condition, how)
    return joined.drop("_salt", *[f"_key_{k}" for k in on])


def product_rows(rows: DataFrame, items: DataFrame, shards: int | None = None) -> DataFrame:
    """Every row with every item, for outputs that are defined on the full grid
    (for example a zero for every sample and bin).

    Items are spread over `shards` groups (by default twice the cores of the session) and each
    row visits every group once, so the grid is built by an equi-join on the group number: no
    nested-loop plan, and the work is spread over `shards` tasks even for a single row.
    """
    shards = shards or 2 * rows.sparkSession.sparkContext.defaultParallelism
    grouped = items.withColumn(
        "_shard", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in items.columns]), F.lit(shards)))
    visits = rows.withColumn(
        "_shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    # Merged, not broadcast: estimates of either side may be far too low.
    pairs = grouped.hint("merge").join(visits, "_shard")
    return pairs.select(*[f"`{c}`" for c in [*rows.columns, *items.columns]])


def top_rows_per_group(df, keys, order, k, salts=SALTS, index=None):
    """First `k` rows of each group in the given order.

    Each group is first cut to `k` rows inside `salts` hashed parts, so one hot group
    is never sorted by a single task; the second cut sees at most `salts` x `k` rows.
    """
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts))
    first = Window.partitionBy(*keys, "_part").orderBy(*order)
    second = Window.partitionBy(*keys).orderBy(*order)
    name = index or "_n"
    out = (
        df.withColumn("_part", part)
        .withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= k).drop("_n", "_part")
        .withColumn(name, F.row_number().over(second)).filter(F.col(name) <= k)
    )
    return out if index else out.drop(name)
