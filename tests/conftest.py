import random

import pytest

from sparkassay.roles import Roles
from sparkassay.session import build_session

ROLES = Roles("class", "inst_id", "match_id", "fold")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def table_rows(n=240, seed=1):
    """Two informative features, one noise, one small categorical; gaps in two of them."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.35)
        a = rng.gauss(1.5 * y, 1.0)
        b = 2.0 * a + rng.gauss(0.0, 0.2)
        rows.append((
            i, i // 4, y, rng.choice([0, 1, 2]) if y else rng.choice([0, 0, 1]), round(a, 4),
            None if i % 9 == 0 else round(b, 4), rng.gauss(0.0, 1.0) if i % 11 else None,
        ))
    return rows


SCHEMA = "inst_id long, match_id long, class int, cat int, a double, b double, noise double"
FEATURES = ["cat", "a", "b", "noise"]
KINDS = {"categorical": ["cat"], "quantitative": ["a", "b", "noise"]}


@pytest.fixture(scope="session")
def table(spark):
    return spark.createDataFrame(table_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def folded(spark, table):
    from sparkassay.operators.folds import stratified_folds

    return stratified_folds(table, 3, 42, ROLES).cache()
