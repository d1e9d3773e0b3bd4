"""Order statistics that never put a whole group into one task.

A run step, an account or a second can hold a third of all rows. A plain window or
``percentile`` would bring such a group to one task. The functions here cut every
group into order-preserving buckets: rows are handled per (group, bucket), and only
one small row per bucket is handled per group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

#: For few, large groups; and for very many groups, such as one per second.
BUCKETS_PER_DOUBLING = 256
COARSE_PER_DOUBLING = 8
#: Numbers per stretch of buckets that are linked in one window.
STRETCH = 1024


def value_bucket(value: Column, per_doubling: int = BUCKETS_PER_DOUBLING) -> Column:
    """Order-preserving bucket of a number: by default 256 per power of two, some 6,600 for 0..60,000,000."""
    value = value.cast("double")
    size = F.floor(F.log2(F.abs(value) + F.lit(1.0)) * F.lit(float(per_doubling))).cast("int")
    return F.when(value < 0, -size).otherwise(size)


def value_counts(
    df: DataFrame, keys: Sequence[str], value: str, freq: str | None = None, ranges: Sequence[str] = ()
) -> DataFrame:
    """(keys, value, n): all that a quantile needs. Repeated values collapse before the shuffle.

    ``ranges`` carries the least and greatest of further columns along (``first_<c>``, ``last_<c>``).
    """
    n = F.count(F.lit(1)) if freq is None else F.sum(freq)
    ends = [f(c).alias(f"{name}_{c}") for c in ranges for name, f in (("first", F.min), ("last", F.max))]
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.alias("n"), *ends)


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; the keys appear once, those of the left side."""
    other = _renamed(right, keys)
    return left.join(other, _same_group(left, other, keys), how).drop(*[f"{c}__r" for c in keys])


def join_apart(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` in a shuffle of its own, so that adaptive execution can cut a hot key on the left.

    When ``right`` is an aggregation by the same keys, its partitioning would serve the join as well, and a partition that
    an aggregation has read is never cut. The hash as one more join key asks for a new one on both sides.
    """
    one, two = (df.withColumn("apart__", F.xxhash64(*[F.col(k) for k in keys])) for df in (left, right))
    return one.join(two, [*keys, "apart__"], how).drop("apart__")


def _same_group(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"{c}__r"]) for c in columns])


def _renamed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}__r" for c in columns})


def linear_rank(p: float, n: Column) -> Column:
    """0-based fractional rank of the interpolated quantile."""
    return F.lit(p) * (n - 1).cast("double")


def nearest_rank(p: float, n: Column) -> Column:
    """0-based rank of the nearest-rank quantile: ceil(n p) - 1."""
    return F.greatest(F.lit(0), F.ceil(n.cast("double") * F.lit(p)).cast("bigint") - 1)


def distribution(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    interpolated: dict[str, float] | None = None,
    nearest: dict[str, float] | None = None,
    divisor: float = 1.0,
    freq: str | None = None,
    per_doubling: int = BUCKETS_PER_DOUBLING,
    ranges: Sequence[str] = (),
) -> DataFrame:
    """Exact count, sum, min, max and quantiles of ``value`` per group.

    ``interpolated`` / ``nearest`` map an output column to a share in 0..1. Results are
    divided by ``divisor`` before the interpolation. Nulls do not count.

    Pass 1 counts per (group, bucket); a running count over the buckets finds the few buckets
    that hold a wanted rank. Pass 2 orders the values of those buckets only, so no task sees a
    whole group. Both passes read the same (group, value, n) shuffle. Very many small groups
    take a coarser ``per_doubling``.

    ``ranges`` adds ``first_<c>`` and ``last_<c>``, the ends of further columns, in the same pass.
    """
    keys = list(keys)
    interpolated, nearest = interpolated or {}, nearest or {}
    counts = value_counts(df, keys, value, freq, ranges)
    ranks = _wanted_ranks(interpolated, nearest)
    totals = [*TOTALS, *[f"{end}_{c}" for c in ranges for end in ("first", "last")]]
    found = (
        _reached_in_buckets(counts, keys, value, list(ranks.values()), per_doubling, totals)
        .groupBy(*keys)
        .agg(
            *[F.first(t).alias(t) for t in totals],
            *[F.min(F.when(F.col("reach__") > rank, F.col(value))).alias(name) for name, rank in ranks.items()],
        )
    )

    total = F.col("total_n")

    def scaled(column: Column) -> Column:
        return column.cast("double") / F.lit(divisor) if divisor != 1.0 else column

    outputs = [total.alias("n"), *[scaled(F.col(t)).alias(t[6:]) for t in TOTALS[1:]]]
    for name, p in interpolated.items():
        rank = linear_rank(p, total)
        weight = rank - F.floor(rank).cast("double")
        low, high = scaled(F.col(f"{name}__low")), scaled(F.col(f"{name}__high"))
        outputs.append((low * (F.lit(1.0) - weight) + high * weight).alias(name))
    outputs += [scaled(F.col(f"{name}__at")).alias(name) for name in nearest]
    return found.select(*keys, *outputs, *totals[len(TOTALS):])


TOTALS = ["total_n", "total_sum", "total_min", "total_max"]


def _wanted_ranks(interpolated: dict[str, float], nearest: dict[str, float]) -> dict[str, Column]:
    total = F.col("total_n")
    ranks: dict[str, Column] = {}
    for name, p in interpolated.items():
        low = F.floor(linear_rank(p, total)).cast("bigint")
        ranks[f"{name}__low"] = low
        ranks[f"{name}__high"] = F.least(low + 1, total - 1)
    for name, p in nearest.items():
        ranks[f"{name}__at"] = nearest_rank(p, total)
    return ranks


def _reached_in_buckets(
    counts: DataFrame, keys: list[str], value: str, ranks: list[Column], per_doubling: int, totals: list[str]
) -> DataFrame:
    """The values of the buckets that hold a wanted rank, each with the number of samples up to it."""
    ends = totals[len(TOTALS):]
    least = lambda c: F.min if c.startswith("first_") else F.max
    counts = counts.withColumn("bucket__", value_bucket(F.col(value), per_doubling))
    per_bucket = counts.groupBy(*keys, "bucket__").agg(
        F.sum("n").alias("size__"),
        F.sum(F.col(value) * F.col("n")).alias("sum__"),
        F.min(value).alias("min__"),
        F.max(value).alias("max__"),
        *[least(c)(c).alias(c) for c in ends],
    )
    group = Window.partitionBy(*keys)
    upto = group.orderBy("bucket__").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = per_bucket.select(
        *keys,
        "bucket__",
        "size__",
        F.sum("size__").over(upto).alias("upto__"),
        F.sum("size__").over(group).alias("total_n"),
        F.sum("sum__").over(group).alias("total_sum"),
        F.min("min__").over(group).alias("total_min"),
        F.max("max__").over(group).alias("total_max"),
        *[least(c)(c).over(group).alias(c) for c in ends],
    )

    before = F.col("upto__") - F.col("size__")
    wanted = reduce(lambda a, b: a | b, [(before <= r) & (r < F.col("upto__")) for r in ranks])
    targets = _renamed(
        placed.where(wanted).select(*keys, "bucket__", before.alias("before__"), *totals), [*keys, "bucket__"]
    )
    # The ends are read here too (a condition that always holds): without them the optimiser would drop them
    # from this pass only, and the two passes would no longer share their shuffle.
    for low, high in zip(ends[::2], ends[1::2], strict=True):
        counts = counts.where(F.col(low).isNull() | (F.col(low) <= F.col(high)))
    inside = counts.drop(*ends).join(targets, _same_group(counts, targets, [*keys, "bucket__"])).select(
        *keys, "bucket__", value, "n", "before__", *totals
    )
    running = (
        Window.partitionBy(*keys, "bucket__").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return inside.withColumn("reach__", F.col("before__") + F.sum("n").over(running))


def _openers(last: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``last`` (keys, ``bucket__``, ``last__``) with each ``last__`` moved to the bucket that follows in its group.

    Buckets led by a whole number may be as many as the rows of a group (one row a second), so no window may see them all:
    they are linked within stretches of ``STRETCH`` numbers, and only the ends of stretches, one row each, meet in a window
    over the group.
    """

    def moved(rows: DataFrame, following: Column) -> DataFrame:
        found = rows.select(*keys, following.alias("next__"), "last__").where(F.col("next__").isNotNull())
        return found.select(*keys, F.col("next__.bucket__").alias("bucket__"), "last__")

    bucket, kind = F.struct("bucket__"), last.schema["bucket__"].dataType
    if not isinstance(kind, StructType) or not isinstance(kind[0].dataType, IntegralType):
        return moved(last, F.lead(bucket).over(Window.partitionBy(*keys).orderBy("bucket__")))
    cut = last.withColumn("stretch__", F.floor(F.col("bucket__").getField(kind[0].name) / F.lit(STRETCH)))
    inside = moved(cut, F.lead(bucket).over(Window.partitionBy(*keys, "stretch__").orderBy("bucket__")))
    ends = cut.groupBy(*keys, "stretch__").agg(F.min(bucket).alias("first__"), F.max_by("last__", bucket).alias("last__"))
    return inside.unionByName(moved(ends, F.lead("first__").over(Window.partitionBy(*keys).orderBy("stretch__"))))


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, columns: Sequence[str]
) -> DataFrame:
    """Add ``prev_<column>``: the value in the row before, in ``order`` within ``keys``.

    ``bucket`` must never fall along ``order``. A copy of each bucket's last row opens the next
    bucket, so one window per (group, bucket) sees every predecessor: the rows shuffle once
    and meet no join. A bucket may be a struct led by a whole number; there may be as many of these as rows.
    """
    keys, order = list(keys), list(order)
    cut = df.withColumn("bucket__", bucket)
    carried = list(dict.fromkeys([*order, *columns]))
    last = cut.groupBy(*keys, "bucket__").agg(F.max_by(F.struct(*carried), F.struct(*order)).alias("last__"))
    openers = _openers(last, keys).select(*keys, "bucket__", "last__.*").withColumn("opener__", F.lit(True))
    rows = cut.withColumn("opener__", F.lit(False)).unionByName(openers, allowMissingColumns=True)
    here = Window.partitionBy(*keys, "bucket__").orderBy(*order)
    seen = rows.withColumns({f"prev_{c}": F.lag(c).over(here) for c in columns})
    return seen.where(~F.col("opener__")).select(*df.columns, *[f"prev_{c}" for c in columns])


def _against_limit(df: DataFrame, keys: Sequence[str], order: str, bucket: Column, limits: DataFrame) -> DataFrame:
    """Add ``within__``: whether a row's rank (from 1, in ``order`` within ``keys``) is up to its group's ``limit``.

    ``bucket`` must grow with ``order``. An opening row per bucket brings the number of rows
    before the bucket and the limit; a running sum over the bucket does the rest.
    """
    keys = list(keys)
    cut = df.withColumn("bucket__", bucket)
    sizes = cut.groupBy(*keys, "bucket__").agg(F.count(F.lit(1)).alias("size__"))
    ahead = Window.partitionBy(*keys).orderBy("bucket__").rowsBetween(Window.unboundedPreceding, -1)
    openers = (
        sizes.withColumn("step__", F.coalesce(F.sum("size__").over(ahead), F.lit(0)))
        .join(limits.select(*keys, F.col("limit").alias("limit__")), keys)
        .where(F.col("step__") < F.col("limit__"))
        .drop("size__")
        .withColumn("opener__", F.lit(True))
    )
    rows = cut.withColumns({"opener__": F.lit(False), "step__": F.lit(1).cast("bigint")}).unionByName(
        openers, allowMissingColumns=True
    )
    here = (
        Window.partitionBy(*keys, "bucket__")
        .orderBy(F.col("opener__").desc(), order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = rows.withColumns({"rank": F.sum("step__").over(here), "upto__": F.first("limit__").over(here)})
    within = F.coalesce(F.col("rank") <= F.col("upto__"), F.lit(False))
    return seen.where(~F.col("opener__")).select(*df.columns, "rank", within.alias("within__"))


def first_rows(df: DataFrame, keys: Sequence[str], order: str, bucket: Column, limits: DataFrame) -> DataFrame:
    """The first ``limit`` rows of every group in ``limits`` (keys, ``limit``), with their ``rank``."""
    return _against_limit(df, keys, order, bucket, limits).where("within__").drop("within__")


def rows_after_first(df: DataFrame, keys: Sequence[str], order: str, bucket: Column, limits: DataFrame) -> DataFrame:
    """All other rows: those beyond the limit and those of groups without one."""
    return _against_limit(df, keys, order, bucket, limits).where(~F.col("within__")).select(*df.columns)


def with_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, name: str = "rank") -> DataFrame:
    """Add the rank (from 1) of every row, in ``order`` within ``keys``; ``bucket`` must never fall along ``order``.

    An opening row per bucket brings the number of rows before it, and a running sum over the bucket does the rest.
    """
    keys, order = list(keys), list(order)
    cut = df.withColumn("bucket__", bucket)
    sizes = cut.groupBy(*keys, "bucket__").agg(F.count(F.lit(1)).alias("size__"))
    ahead = Window.partitionBy(*keys).orderBy("bucket__").rowsBetween(Window.unboundedPreceding, -1)
    openers = sizes.withColumn("step__", F.coalesce(F.sum("size__").over(ahead), F.lit(0))).drop("size__").withColumn("opener__", F.lit(True))
    rows = cut.withColumns({"opener__": F.lit(False), "step__": F.lit(1).cast("bigint")}).unionByName(openers, allowMissingColumns=True)
    here = (
        Window.partitionBy(*keys, "bucket__").orderBy(F.col("opener__").desc(), *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.withColumn(name, F.sum("step__").over(here)).where(~F.col("opener__")).select(*df.columns, name)


#: Rows of a block whose sliding frames are taken together.
FRAME_BLOCK = 100_000


def moving_mean(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, value: str, width: int, name: str, block: int = FRAME_BLOCK
) -> DataFrame:
    """Add the mean of ``value`` over a row and the ``width - 1`` rows before it, in ``order`` within ``keys``; nulls do not count.

    A group is cut into blocks of so many ranks. A block's last ``width - 1`` rows also open the next block, so no window
    sees a whole group and every frame is complete.
    """
    block, margin = max(block, width), width - 1
    place = F.col("rank__") - 1
    own = F.floor(place / block)
    both = F.when(F.pmod(place, F.lit(block)) >= block - margin, F.array(own, own + 1)).otherwise(F.array(own))
    rows = with_rank(df, keys, order, bucket, "rank__").withColumn("own__", own).withColumn("block__", F.explode(both))
    frame = Window.partitionBy(*keys, "block__").orderBy("rank__").rowsBetween(-margin, Window.currentRow)
    return rows.withColumn(name, F.avg(value).over(frame)).where(F.col("block__") == F.col("own__")).select(*df.columns, name)
