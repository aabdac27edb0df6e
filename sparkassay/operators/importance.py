"""Feature scores: mutual information and MultiSURF.

Input is long: key columns, class and value per (record, feature). ``keys`` end with
``feature``; put ``cv`` first to score all model indexes in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.functions.columns import digamma, q
from sparkassay.functions.kernels import prefix_sum, small_side, to_long, with_value_bucket
from sparkassay.session import cut_lineage

BLOCK_ROWS = 50_000


def mi_discrete(long: DataFrame, class_col: str = "class", keys: list[str] | None = None, groups: int | None = None) -> DataFrame:
    """Plug-in mutual information (nats) of each feature's values and the class."""
    keys = keys or ["feature"]
    key = [q(k) for k in keys]
    cells = long.where(F.col("value").isNotNull()).groupBy(*key, "value").agg(
        F.count_if(q(class_col) == 0).alias("n0"), F.count_if(q(class_col) == 1).alias("n1")
    )
    margins = cells.groupBy(*key).agg(F.sum("n0").alias("c0"), F.sum("n1").alias("c1"))
    n, row = F.col("c0") + F.col("c1"), F.col("n0") + F.col("n1")

    def part(count, column):
        return F.when(count > 0, count / n * F.log(count * n / (row * column))).otherwise(F.lit(0.0))

    joined = cells.join(small_side(margins, groups), keys)
    score = F.sum(part(F.col("n0"), F.col("c0")) + part(F.col("n1"), F.col("c1")))
    return joined.groupBy(*key).agg(F.greatest(score, F.lit(0.0)).alias("score"))


def _neighbour_rows(counts: DataFrame, class_col: str, keys: list[str], k: int, groups: int | None, block: int) -> DataFrame:
    """Distinct values per (keys, class), with their number of points ``n``, and the k distinct values on either side.

    Values are numbered, cut into blocks of that number, and every block also gets the
    k values next to it, so a window never spans more than one block.
    """
    own = [*keys, class_col]
    bucketed = with_value_bucket(counts.withColumn("one", F.lit(1).cast("long")), own, "value", groups)
    totals = prefix_sum(bucketed, own, ["value"], ["n", "one"])
    spot = totals.where(F.col("tot_n") > 1).withColumn("__home", F.floor((F.col("cum_one") - 1) / block))
    near = F.array_distinct(F.array(
        F.col("__home"), F.floor((F.col("cum_one") - 1 - k) / block), F.floor((F.col("cum_one") - 1 + k) / block)
    ))
    spread = spot.withColumn("__block", F.explode(near))
    line = Window.partitionBy(*[q(c) for c in own], "__block").orderBy("value")
    sides = []
    for j in range(1, k + 1):
        for side, shift in (("l", F.lag), ("r", F.lead)):
            v = shift("value", j).over(line)
            gap = F.col("value") - v if side == "l" else v - F.col("value")
            sides.append(F.struct(
                gap.alias("d"), F.lit(side).alias("side"), v.alias("v"), shift("n", j).over(line).alias("n")
            ))
    out = spread.select(*[q(c) for c in own], "value", "n", "tot_n", "__home", "__block", F.array(*sides).alias("near"))
    return out.where(F.col("__home") == F.col("__block")).drop("__home", "__block")


def mi_knn(
    long: DataFrame, class_col: str = "class", k: int = 3, keys: list[str] | None = None, groups: int | None = None,
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Nearest-neighbour mutual information of a continuous feature and the class (Ross 2014), at least 0.

    The radius of a point reaches its k-th neighbour of the same class; points of any class
    closer than that are counted by running totals over values and interval ends together.
    """
    keys = keys or ["feature"]
    own = [*keys, class_col]
    known = long.where(F.col("value").isNotNull())
    counts = known.groupBy(*[q(c) for c in own], "value").agg(F.count(F.lit(1)).alias("n"))
    counts = cut_lineage(counts, "counts")  # the copies of the rows are made and read once
    rows = _neighbour_rows(counts, class_col, keys, k, None if groups is None else 2 * groups, block)
    k_own = F.least(F.lit(k), F.col("tot_n") - 1)
    same = F.struct(
        F.lit(0.0).alias("d"), F.lit("").alias("side"), F.col("value").alias("v"), (F.col("n") - 1).alias("n")
    )
    ordered = F.sort_array(F.filter(F.concat(F.array(same), F.col("near")), lambda s: s["v"].isNotNull()))
    rows = rows.withColumn("k_own", k_own).withColumn("line", ordered)
    seen, reached = F.lit(0).cast("long"), None
    for i in range(k + 1):  # nearest first: the value whose points bring the count to k
        step = F.get("line", F.lit(i))
        seen = seen + F.coalesce(step["n"], F.lit(0))
        hit = seen >= F.col("k_own")
        reached = F.when(hit, step) if reached is None else reached.when(hit, step)
    rows = rows.select(*[q(c) for c in [*keys, class_col]], "value", "n", "tot_n", "k_own", reached.alias("far"))
    rows = cut_lineage(rows, "radius")  # read by rows and by bucket totals below
    r, x, v = F.col("far.d"), F.col("value"), F.col("far.v")
    low = F.when(F.col("far.side") == "l", v).otherwise(x - r)
    high = F.when(F.col("far.side") == "r", v).otherwise(x + r)
    flat = r == 0
    zero = F.lit(0).cast("long")

    def event(value, kind, n, sign):
        return F.struct(value.alias("at"), kind.alias("kind"), n.alias("n_points"), F.lit(sign).alias("sign"))

    # Order at one position: ends that exclude it, points, ends that include it.
    events = F.array(
        event(x, F.lit(1), F.col("n"), 0),
        event(low, F.when(flat, F.lit(0)).otherwise(F.lit(2)), zero, -1),
        event(high, F.when(flat, F.lit(2)).otherwise(F.lit(0)), zero, 1),
    )
    lines = rows.select(*[q(c) for c in own], x.alias("value"), "n", "tot_n", "k_own", F.inline(events))
    bucketed = with_value_bucket(lines, keys, "at", groups, limits_from=counts.select(*[q(c) for c in keys], F.col("value").alias("at")))
    counted = prefix_sum(bucketed, keys, ["at", "kind"], ["n_points"])
    within = counted.where(F.col("sign") != 0).groupBy(*[q(c) for c in own], "value", "n", "tot_n", "k_own").agg(
        F.sum(F.col("sign") * F.col("cum_n_points")).alias("m")
    )
    weight = F.col("n").cast("double")
    term = digamma(F.col("k_own").cast("double")) - digamma(F.col("tot_n").cast("double")) - digamma(F.col("m").cast("double"))
    sums = within.groupBy(*[q(c) for c in keys]).agg(F.sum(weight * term).alias("s"), F.sum(weight).alias("all"))
    return sums.select(
        *[q(c) for c in keys], F.greatest(digamma(F.col("all")) + F.col("s") / F.col("all"), F.lit(0.0)).alias("score")
    )


def mutual_information(
    df: DataFrame, kinds: dict[str, list[str]], class_col: str = "class", k: int = 3, ids: list[str] | None = None, versions: int = 1
) -> DataFrame:
    """Plug-in score for categorical features, nearest-neighbour score for quantitative ones."""
    ids = ids or []
    keys = [*ids, "feature"]
    parts = []
    if kinds.get("categorical"):
        long = to_long(df, [*ids, class_col], kinds["categorical"])
        parts.append(mi_discrete(long, class_col, keys, len(kinds["categorical"]) * versions))
    if kinds.get("quantitative"):
        long = to_long(df, [*ids, class_col], kinds["quantitative"])
        parts.append(mi_knn(long, class_col, k, keys, len(kinds["quantitative"]) * versions))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


# --- MultiSURF -----------------------------------------------------------------------------


def _block_pairs(rows: DataFrame, right: DataFrame, blocks: int, task, schema: str) -> DataFrame:
    """Run ``task(left, right)`` for every pair of row blocks of the same cv."""
    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    a = rows.select("*", F.col("blk").alias("i"), F.explode(every).alias("j"))
    b = right.select("*", F.explode(every).alias("i"), F.col("blk").alias("j"))
    # both sides may come from one frame: own names keep their columns apart
    b = b.select(*[F.col(c).alias(f"{c}_b") for c in b.columns])

    def run(left, other):
        return task(left, other.rename(columns=lambda c: c[:-2]))

    return a.groupBy("cv", "i", "j").cogroup(b.groupBy("cv_b", "i_b", "j_b")).applyInPandas(run, schema)


def _distances(a, b, discrete):
    """Sum of feature differences of every row of ``a`` to every row of ``b``, and a per-feature view."""
    import numpy as np

    total = np.zeros((len(a), len(b)))

    def feature(f):
        gap = np.abs(a[:, f][:, None] - b[:, f][None, :])
        gap = (gap > 0).astype("float64") if discrete[f] else gap
        return np.where(np.isnan(gap), 0.0, gap)

    for f in range(a.shape[1]):
        total += feature(f)
    return total, feature


def multisurf(
    df: DataFrame, kinds: dict[str, list[str]], inst: str = "inst_id", class_col: str = "class", block_rows: int = 512,
    rows_bound: int | None = None,
) -> DataFrame:
    """Relief-type scores of rows that carry ``cv`` (already sampled, see ``instance_sample``).

    Neighbours of an instance lie within mean - sd/2 of its distances. Work is quadratic in
    the rows and split into pairs of row blocks: no task sees more than two blocks, and no
    pair of rows ever becomes a data row. The number of blocks follows from the largest row
    count of a model index, unless ``rows_bound`` gives it.
    The sample is read once per block pair and pass, so it is stored first.
    """
    features = [*kinds.get("categorical", []), *kinds.get("quantitative", [])]
    discrete = [f in set(kinds.get("categorical", [])) for f in features]
    df = cut_lineage(df.select("cv", q(inst), q(class_col), *[q(f) for f in features]), "sample")
    if rows_bound is None:
        rows_bound = df.groupBy("cv").count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, -(-rows_bound // block_rows))
    limits = df.groupBy("cv").agg(*[
        (F.max(q(f).cast("double")) - F.min(q(f).cast("double"))).alias(f"__r{i}") for i, f in enumerate(features)
    ])
    scaled = [
        (q(f).cast("double") if discrete[i] else F.when(F.col(f"__r{i}") > 0, q(f) / F.col(f"__r{i}")).otherwise(0.0))
        for i, f in enumerate(features)
    ]
    rows = df.join(small_side(limits, 100), "cv").select(
        "cv", q(inst).cast("string").alias("id"), q(class_col).cast("int").alias("y"), F.array(*scaled).alias("x"),
        F.pmod(F.xxhash64(q(inst)), F.lit(blocks)).cast("int").alias("blk"),
    )

    def matrix(pdf):
        import numpy as np

        return np.array(pdf["x"].tolist(), dtype="float64")

    def spread(left, right):
        import pandas as pd

        if left.empty or right.empty:
            return pd.DataFrame({"cv": [], "id": [], "n": [], "s": [], "ss": []})
        d, _ = _distances(matrix(left), matrix(right), discrete)
        other = left["id"].to_numpy()[:, None] != right["id"].to_numpy()[None, :]
        d = d * other
        return pd.DataFrame({
            "cv": left["cv"], "id": left["id"], "n": other.sum(1).astype("float64"), "s": d.sum(1), "ss": (d * d).sum(1)
        })

    parts = _block_pairs(rows, rows, blocks, spread, "cv int, id string, n double, s double, ss double")
    sums = parts.groupBy("cv", "id").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")])
    mean = F.try_divide("s", "n")
    sd = F.sqrt(F.greatest(F.try_divide("ss", "n") - mean * mean, F.lit(0.0)))
    radius = sums.select("cv", "id", (mean - sd / 2.0).alias("radius"))

    def near(left, right):
        import numpy as np
        import pandas as pd

        names = ["cv", "id", "feature", "hits", "misses", "hit_gap", "miss_gap"]
        if left.empty or right.empty:
            return pd.DataFrame({c: [] for c in names})
        d, feature = _distances(matrix(left), matrix(right), discrete)
        other = left["id"].to_numpy()[:, None] != right["id"].to_numpy()[None, :]
        close = other & (d < left["radius"].to_numpy()[:, None])
        same = left["y"].to_numpy()[:, None] == right["y"].to_numpy()[None, :]
        hit, miss = close & same, close & ~same
        out = []
        for f in range(len(features)):
            gap = feature(f)
            out.append(pd.DataFrame({
                "cv": left["cv"], "id": left["id"], "feature": np.int32(f), "hits": hit.sum(1).astype("float64"),
                "misses": miss.sum(1).astype("float64"), "hit_gap": (gap * hit).sum(1), "miss_gap": (gap * miss).sum(1),
            }))
        return pd.concat(out, ignore_index=True)

    schema = "cv int, id string, feature int, hits double, misses double, hit_gap double, miss_gap double"
    gaps = _block_pairs(rows.join(radius, ["cv", "id"]), rows, blocks, near, schema)
    per = gaps.groupBy("cv", "id", "feature").agg(*[F.sum(c).alias(c) for c in ("hits", "misses", "hit_gap", "miss_gap")])

    def share(gap, count):
        return F.when(F.col(count) > 0, F.col(gap) / F.col(count)).otherwise(F.lit(0.0))

    names = F.array(*[F.lit(f) for f in features])
    scored = per.groupBy("cv", "feature").agg(F.avg(share("miss_gap", "misses") - share("hit_gap", "hits")).alias("score"))
    return scored.select("cv", names[F.col("feature")].alias("feature"), "score")


def turf(df: DataFrame, kinds: dict[str, list[str]], pct: float = 0.5, **options) -> DataFrame:
    """MultiSURF again and again on the better features; each round drops the worst share.

    All model indexes take part in one ranking of the mean score, so they keep the same
    features per round. ``rounds`` tells how long a feature stayed.
    """
    left = {k: list(v) for k, v in kinds.items()}
    rounds = max(1, int(1.0 / pct))
    done: list[tuple] = []
    for number in range(1, rounds + 1):
        scores = multisurf(df, left, **options).collect()
        total: dict[str, float] = {}
        for r in scores:
            total[r["feature"]] = total.get(r["feature"], 0.0) + r["score"]
        order = sorted(total, key=lambda f: (-total[f], f))
        keep = set(order[: max(1, len(order) - int(len(order) * pct))])
        last = number == rounds or len(keep) == len(order)
        done += [
            (r["cv"], r["feature"], r["score"], number) for r in scores if last or r["feature"] not in keep
        ]
        if last:
            break
        left = {k: [f for f in v if f in keep] for k, v in left.items()}
    return df.sparkSession.createDataFrame(done, "cv int, feature string, score double, rounds int")
