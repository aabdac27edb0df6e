"""Distributed ranks, running totals and exact quantiles.

None of them puts the rows of one group into one task. A group is cut into value
buckets whose limits are a hash-chosen sample of its own values. The limits depend
on the values alone, so a recomputed partition gets the same bucket numbers.
Row-level windows are always partitioned by (group, bucket); only the per-bucket
totals (a fixed number per group) are ordered inside one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.functions.columns import SHUFFLE_DIGITS, q, shuffle_number

BROADCAST_ROWS = 1_000_000
BUCKET = "__bucket"


def small_side(df: DataFrame, rows: int | None) -> DataFrame:
    """Hint a broadcast only when the caller knows an upper limit of the row count and it is small."""
    if rows is not None and rows <= BROADCAST_ROWS:
        return F.broadcast(df)
    return df


def vector_state(
    state: DataFrame, features: list[str], values: dict[str, str], keys: list[str], rows: int | None
) -> DataFrame:
    """Long state ``(keys..., feature, value columns)`` as one row per key: an array per value whose element i
    belongs to ``features[i]`` (null where the state has no row), so that its use is one array expression
    instead of one expression per feature. ``rows`` is an upper limit of the number of keys, for the broadcast."""
    index = state.sparkSession.createDataFrame(list(enumerate(features)), "__i int, feature string")
    keyed = state.join(small_side(index, len(features)), "feature")
    packed = keyed.groupBy(*[q(k) for k in keys]).agg(
        *[F.map_from_entries(F.collect_list(F.struct(F.col("__i"), q(col)))).alias(f"__map_{name}") for name, col in values.items()]
    )
    every = F.sequence(F.lit(0), F.lit(len(features) - 1))

    def spread(name: str) -> Column:
        return F.transform(every, lambda i: F.element_at(F.col(f"__map_{name}"), i)).alias(name)

    arrays = [spread(name) for name in values]
    return small_side(packed.select(*[q(k) for k in keys], *arrays), rows)


def bucket_count(df: DataFrame) -> int:
    """Buckets per group: follows the shuffle width of the session."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(16, min(1024, width))


def to_long(df: DataFrame, ids: list[str], features: list[str]) -> DataFrame:
    """One row per (record, feature); nulls are kept."""
    wide = df.select(*[q(i) for i in ids], *[q(f).cast("double").alias(f) for f in features])
    return wide.unpivot([q(i) for i in ids], [q(f) for f in features], "feature", "value")


def fold_versions(fold: Column, k: int) -> Column:
    """The model indexes that train on a row of this fold (all but its own)."""
    return F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i != fold)


# --- value buckets -------------------------------------------------------------------------


def with_value_bucket(
    rows: DataFrame, keys: list[str], value: str, groups: int | None, limits_from: DataFrame | None = None
) -> DataFrame:
    """Add ``__bucket``: non-decreasing in ``value`` within ``keys``.

    ``limits_from`` is the frame whose values set the limits (by default ``rows``); ``groups``
    an upper limit of the number of distinct keys, used to check the broadcast.
    """
    n = bucket_count(rows)
    source = rows if limits_from is None else limits_from
    chosen = (
        source.where(q(value).isNotNull())
        .groupBy(*[q(k) for k in keys], F.pmod(F.xxhash64(q(value)), F.lit(n)).alias("__slot"))
        .agg(F.min_by(q(value), F.xxhash64(q(value), F.lit(1))).alias("__v"))
    )
    limits = chosen.groupBy(*[q(k) for k in keys]).agg(F.sort_array(F.collect_set("__v")).alias("__limits"))
    rows = rows.join(small_side(limits, None if groups is None else groups * n // 8), keys)
    rows = rows.withColumn(BUCKET, F.lit(0))
    step = 1 << (n.bit_length() - 1)
    while step:  # binary search: how many limits are below the value
        below = F.get("__limits", F.col(BUCKET) + (step - 1)) < q(value)
        rows = rows.withColumn(BUCKET, F.when(below, F.col(BUCKET) + step).otherwise(F.col(BUCKET)))
        step //= 2
    return rows.drop("__limits")


# --- running totals ------------------------------------------------------------------------


def prefix_sum(
    df: DataFrame, keys: list[str], order: list[str], sums: list[str], bucket: str = BUCKET, descending: bool = False
) -> DataFrame:
    """Inclusive running totals ``cum_<s>`` and group totals ``tot_<s>`` of non-negative ``sums``.

    Rows equal in ``order`` share one total. The bucket totals meet the rows on
    (keys, bucket), the partitioning and order the window already made.
    """
    parts = [q(k) for k in keys] + [q(bucket)]
    direction = (lambda c: c.desc()) if descending else (lambda c: c.asc())
    inside = Window.partitionBy(*parts).orderBy(*[direction(q(o)) for o in order])
    local = df.select("*", *[F.sum(q(s)).over(inside).alias(f"__in_{s}") for s in sums])
    totals = local.groupBy(*parts).agg(*[F.max(f"__in_{s}").alias(f"__sum_{s}") for s in sums])
    across = Window.partitionBy(*[q(k) for k in keys])
    before = across.orderBy(direction(q(bucket))).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *parts,
        *[F.coalesce(F.sum(f"__sum_{s}").over(before), F.lit(0)).alias(f"__off_{s}") for s in sums],
        *[F.sum(f"__sum_{s}").over(across).alias(f"tot_{s}") for s in sums],
    )
    joined = local.join(offsets, [*keys, bucket])
    return joined.select(
        *[q(c) for c in df.columns if c != bucket],
        *[(q(f"__in_{s}") + q(f"__off_{s}")).alias(f"cum_{s}") for s in sums],
        *[q(f"tot_{s}") for s in sums],
    )


def value_totals(
    rows: DataFrame, keys: list[str], value: str, sums: dict[str, Column], groups: int | None, descending: bool = False
) -> DataFrame:
    """Aggregate per (keys, value), then running totals in value order: one row per distinct value."""
    known = rows.where(q(value).isNotNull())
    counts = known.groupBy(*[q(k) for k in keys], q(value)).agg(*[c.alias(n) for n, c in sums.items()])
    bucketed = with_value_bucket(counts, keys, value, groups, limits_from=known)
    return prefix_sum(bucketed, keys, [value], list(sums), descending=descending)


def average_rank(totals: DataFrame, count: str) -> Column:
    """Rank shared by tied values, from the output of ``value_totals``."""
    return F.col(f"cum_{count}") - F.col(count) + (F.col(count) + 1) / 2.0


# --- reproducible random ranks -------------------------------------------------------------


def hash_rank(
    df: DataFrame, seed: int, inst: str, partition: list[str] | None = None, out: str = "rank",
    keep_first: Column | None = None, digits: int = 3,
) -> DataFrame:
    """1-based rank in ``shuffle_key`` order (then by label), within ``partition``.

    The leading hex digits of the key are evenly spread buckets, so no statistics are needed.
    ``keep_first`` keeps only ranks up to that number; whole buckets beyond it are dropped
    before the shuffle.
    """
    parts = partition or []
    keyed = df.withColumn("__key", shuffle_number(seed, q(inst)))
    keyed = keyed.withColumn("__hex", F.shiftright("__key", 4 * (SHUFFLE_DIGITS - digits)).cast("int"))
    sizes = keyed.groupBy(*[q(p) for p in parts], "__hex").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*([q(p) for p in parts] or [F.lit(0)])).orderBy("__hex")
    offsets = sizes.withColumn("__off", F.sum("__n").over(before) - F.col("__n")).drop("__n")
    keys = [*parts, "__hex"]
    if keep_first is not None:
        wanted = offsets.where(F.col("__off") < keep_first)
        keyed = keyed.join(small_side(wanted.select(*keys), 16**digits * 64), keys, "left_semi")
    inside = Window.partitionBy(*[q(k) for k in keys]).orderBy("__key", q(inst))
    ranked = keyed.withColumn("__rn", F.row_number().over(inside)).join(offsets, keys)
    ranked = ranked.withColumn(out, F.col("__rn") + F.col("__off"))
    if keep_first is not None:
        ranked = ranked.where(q(out) <= keep_first)
    return ranked.select(*[q(c) for c in df.columns], q(out))


# --- exact quantiles -----------------------------------------------------------------------


def exact_quantiles(
    rows: DataFrame, keys: list[str], value: str, probs: list[float], groups: int | None,
    holdout: tuple[str, int, str] | None = None, names: list[str] | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles per group without gathering the group.

    Count rows per bucket, find the few buckets that hold a wanted position, and look
    only into those. ``holdout=(fold, k, out)`` gives one result per ``out`` in 0..k-1
    over the rows of all other folds; the copies are made of counts, never of rows.
    """
    names = names or [f"p{int(round(p * 100))}" for p in probs]
    carry = [holdout[0]] if holdout else []
    known = rows.where(q(value).isNotNull()).select(*[q(k) for k in [*keys, *carry]], q(value))
    bucketed = with_value_bucket(known, keys, value, groups)
    per = bucketed.groupBy(*[q(k) for k in [*keys, *carry]], BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    out_keys = list(keys)
    if holdout:
        fold, k, out = holdout
        out_keys = [out, *keys]
        per = (
            per.withColumn(out, F.explode(fold_versions(q(fold), k)))
            .groupBy(*[q(c) for c in out_keys], BUCKET)
            .agg(F.sum("__n").alias("__n"))
        )
    group = Window.partitionBy(*[q(k) for k in out_keys])
    located = per.select(
        *[q(k) for k in out_keys], BUCKET, "__n",
        (F.sum("__n").over(group.orderBy(BUCKET)) - F.col("__n")).alias("__before"),
        F.sum("__n").over(group).alias("__total"),
    )

    def position(p: float) -> Column:
        return (F.col("__total") - 1) * F.lit(float(p))

    def holds(pos: Column, before: Column, count: Column) -> Column:
        return (before <= pos) & (pos < before + count)

    ends = [end(position(p)).cast("long") for p in probs for end in (F.floor, F.ceil)]
    wanted = located.where(
        F.exists(F.array(*ends), lambda e: holds(e, F.col("__before"), F.col("__n")))
    ).select(*[q(k) for k in out_keys], BUCKET, "__before", "__total")
    limit = None if groups is None else groups * len(ends) * (holdout[1] if holdout else 1)
    inside = bucketed.join(small_side(wanted, limit), [*keys, BUCKET])
    if holdout:
        inside = inside.where(q(holdout[0]) != q(holdout[2]))
    cells = inside.groupBy(*[q(k) for k in out_keys], BUCKET, "__before", "__total", q(value)).agg(
        F.count(F.lit(1)).alias("__c")
    )
    run = Window.partitionBy(*[q(k) for k in out_keys], BUCKET).orderBy(q(value))
    cells = cells.withColumn("__start", F.col("__before") + F.sum("__c").over(run) - F.col("__c"))

    def at(end: Column) -> Column:
        return F.max(F.when(holds(end, F.col("__start"), F.col("__c")), q(value)))

    picked = cells.groupBy(*[q(k) for k in out_keys]).agg(
        F.max("__total").alias("__total"), *[at(e).alias(f"__e{i}") for i, e in enumerate(ends)]
    )
    quantile = []
    for i, (p, name) in enumerate(zip(probs, names)):
        low, high = F.col(f"__e{2 * i}"), F.col(f"__e{2 * i + 1}")
        quantile.append((low + (high - low) * (position(p) - F.floor(position(p)))).alias(name))
    return picked.select(*[q(k) for k in out_keys], *quantile)
