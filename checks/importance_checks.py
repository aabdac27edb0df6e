"""Feature scores: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.prep_checks import FILL
from checks.profile_checks import rounded
from checks.sql_tables import FEATURES, sql
from sparkassay.functions.kernels import to_long
from sparkassay.operators import folds, importance, prep

CAT, QUANT, ROLES, K = fx.CATEGORICAL, fx.QUANTITATIVE, fx.ROLES, fx.K
KINDS = {"categorical": CAT, "quantitative": QUANT}


def sampled_train(s, d):
    """2000 filled training rows of model index 0, the sampling cap of the scorer."""
    base = fx.fold(s, d)
    train = folds.train_test(base, 0)[0].withColumn("cv", F.lit(0))
    filled = prep.apply_fill(train, fx.fill_state(s, d), FEATURES, K)
    return folds.instance_sample(filled, 2000, 11, ROLES)


QUERIES = {
    "g1_mi_discrete": lambda s, d: rounded(
        importance.mi_discrete(to_long(fx.fold(s, d), ["class"], CAT), groups=4), "score"
    ),
    "g2_mi_knn": lambda s, d: rounded(
        importance.mi_knn(to_long(fx.fold(s, d), ["class"], QUANT), groups=3), "score"
    ),
    "g2_mi_by_fold": lambda s, d: rounded(
        importance.mutual_information(
            folds.train_rows(fx.fold(s, d), K), KINDS, ids=["cv"], versions=K
        ), "score"
    ),
    "g3_multisurf": lambda s, d: rounded(importance.multisurf(sampled_train(s, d), KINDS), "score"),
    "g4_turf": lambda s, d: rounded(importance.turf(sampled_train(s, d), KINDS), "score"),
}


def mi_plug_in(source, keys):
    k = ", ".join(keys)
    return f"""
cell AS (SELECT {k}, class, value, count(*)::DOUBLE AS n FROM {source}
  WHERE value IS NOT NULL AND feature IN ('{"','".join(CAT)}') GROUP BY ALL),
mi AS (SELECT {k}, greatest(sum(n / t * ln(n * t / (r * c))), 0) AS score FROM (
  SELECT *, sum(n) OVER (PARTITION BY {k}) AS t, sum(n) OVER (PARTITION BY {k}, value) AS r,
    sum(n) OVER (PARTITION BY {k}, class) AS c FROM cell) GROUP BY ALL)"""


def psi(x):
    z = f"({x} + 6.0)"
    return (
        f"(ln({z}) - 0.5 / {z} - 1.0 / (12.0 * {z} ** 2) + 1.0 / (120.0 * {z} ** 4) - 1.0 / (252.0 * {z} ** 6)"
        f" + 1.0 / (240.0 * {z} ** 8) - " + " - ".join(f"1.0 / ({x} + {i}.0)" for i in range(6)) + ")"
    )


def mi_neighbours(source, keys):
    """Rows in order per class: three to each side; counts inside the radius by as-of joins."""
    k = ", ".join(keys)
    near = ", ".join(
        [f"{{'d': value - lag(value, {j}) OVER w, 'side': 'l', 'v': lag(value, {j}) OVER w}}" for j in (1, 2, 3)]
        + [f"{{'d': lead(value, {j}) OVER w - value, 'side': 'r', 'v': lead(value, {j}) OVER w}}" for j in (1, 2, 3)]
    )
    same = " AND ".join(f"q.{x} = t.{x}" for x in keys)
    return f"""
pts AS (SELECT {k}, class, value FROM {source} WHERE value IS NOT NULL AND feature IN ('{"','".join(QUANT)}')),
nb AS (SELECT {k}, class, value, count(*) OVER (PARTITION BY {k}, class) AS nc,
  list_sort(list_filter([{near}], lambda s: s.v IS NOT NULL))[3] AS far
  FROM pts WINDOW w AS (PARTITION BY {k}, class ORDER BY value)),
rng AS (SELECT {k}, value, nc, far.d AS r, CASE WHEN far.side = 'l' THEN far.v ELSE value - far.d END AS lo,
  CASE WHEN far.side = 'r' THEN far.v ELSE value + far.d END AS hi FROM nb),
cum AS (SELECT {k}, value, sum(count(*)) OVER (PARTITION BY {k} ORDER BY value) AS c FROM pts GROUP BY {k}, value),
up AS (SELECT q.*, t.c AS below_hi FROM rng q ASOF JOIN cum t ON {same} AND t.value < q.hi),
m AS (
  SELECT q.*, below_hi - coalesce(t.c, 0) AS cnt
  FROM up q ASOF LEFT JOIN cum t ON {same} AND t.value <= q.lo WHERE r > 0
  UNION ALL
  SELECT q.*, 0, s.n FROM rng q JOIN (SELECT {k}, value, count(*) AS n FROM pts GROUP BY {k}, value) s
    ON {same.replace('t.', 's.')} AND s.value = q.value WHERE r = 0
),
mik AS (SELECT {k}, greatest(0, {psi('count(*)')} + {psi('3.0')} - avg({psi('nc')}) - avg({psi('cnt')})) AS score
  FROM m GROUP BY {k})"""


SURF = f"""
samp AS (SELECT * FROM (SELECT DISTINCT inst_id, class FROM versions WHERE cv = 0 AND part = 'train')
  ORDER BY md5('11|' || CAST(inst_id AS VARCHAR)), inst_id LIMIT 2000),
wide AS (SELECT inst_id, any_value(samp.class) AS y, {', '.join(f"max(value) FILTER (feature = '{f}') AS {f}" for f in FEATURES)}
  FROM versions JOIN samp USING (inst_id) WHERE cv = 0 GROUP BY inst_id),
scl AS (SELECT inst_id, y, {', '.join(CAT)}, {', '.join(f"{f} / (max({f}) OVER () - min({f}) OVER ()) AS {f}" for f in QUANT)} FROM wide),
gaps AS (SELECT a.inst_id, a.y = b.y AS hit, {', '.join(f"(a.{f} <> b.{f})::INTEGER::DOUBLE AS {f}" for f in CAT)},
  {', '.join(f"abs(a.{f} - b.{f}) AS {f}" for f in QUANT)} FROM scl a JOIN scl b ON a.inst_id <> b.inst_id),
dist AS (SELECT *, {' + '.join(FEATURES)} AS d FROM gaps),
lim AS (SELECT inst_id, avg(d) - stddev_pop(d) / 2 AS radius FROM dist GROUP BY inst_id),
avgs AS (SELECT inst_id, hit, {', '.join(f"avg({f}) AS {f}" for f in FEATURES)}
  FROM dist JOIN lim USING (inst_id) WHERE d < radius GROUP BY inst_id, hit)"""

ORACLES = {
    "g1_mi_discrete": sql("long", "SELECT feature, round(score, 6) AS score FROM mi", mi_plug_in("lng", ["feature"])),
    "g2_mi_knn": sql("long", "SELECT feature, round(score, 6) AS score FROM mik", mi_neighbours("lng", ["feature"])),
    "g2_mi_by_fold": sql(
        "train", "SELECT CAST(cv AS INTEGER) AS cv, feature, round(score, 6) AS score FROM mi"
        " UNION ALL SELECT CAST(cv AS INTEGER), feature, round(score, 6) FROM mik",
        mi_plug_in("train", ["cv", "feature"]), mi_neighbours("train", ["cv", "feature"])
    ),
    "g3_multisurf": sql("train", "\nUNION ALL ".join(
        f"SELECT 0 AS cv, '{f}' AS feature, round(sum(CASE WHEN hit THEN -{f} ELSE {f} END)"
        f" / (SELECT count(*) FROM samp), 6) AS score FROM avgs" for f in FEATURES
    ), FILL, SURF),
}
