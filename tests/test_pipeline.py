from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparkassay.operators import prep, replication
from sparkassay.operators.models import fitted as fm
from sparkassay.plans import pipeline, report
from sparkassay.session import scratch_path
from sparkassay.sources import readers, sinks
from sparkassay.streaming.scoring import score_stream
from tests.conftest import FEATURES, KINDS, ROLES, table_rows


def test_text_files(spark, tmp_path):
    (tmp_path / "one.csv").write_text("﻿Inst,Class,Iron (%),Symptoms \n1,0,NA,2\n2,1,3.5,\n", encoding="utf-8")
    (tmp_path / "two.txt").write_text("Inst\tClass\tg\n1\t0\t7\n")
    (tmp_path / "notes.md").write_text("no table")
    found = readers.read_datasets(spark, str(tmp_path))
    assert set(found) == {"one", "two"}
    one = found["one"]
    assert one.columns == ["Inst", "Class", "Iron (%)", "Symptoms "]
    assert one.where("`Iron (%)` is null").count() == 1 and one.where("`Symptoms ` is null").count() == 1
    both = readers.union_datasets(found)
    assert both.count() == 3 and both.where("dataset = 'two' and g = 7").count() == 1
    assert readers.read_dataset(spark, str(tmp_path / "two.txt"), schema="Inst int, Class int, g string").dtypes[2][1] == "string"
    (tmp_path / "list.csv").write_text("a,b c\n")
    assert readers.read_name_list(spark, str(tmp_path / "list.csv")) == ["a", "b c"]
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(ValueError):
        readers.read_datasets(spark, str(empty))


def test_fold_files_prune(spark, folded):
    path = scratch_path(spark, "folds")
    sinks.write_folds(folded, path)
    assert {p.name for p in Path(path).glob("fold=*")} == {"fold=0", "fold=1", "fold=2"}
    df = sinks.read_folds(spark, path).where("fold = 1").select("a")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fold" in plan and "ReadSchema: struct<a:double>" in plan


def test_stages_and_log(spark, folded):
    path = scratch_path(spark, "stage")
    sinks.write_stage(folded.select("a"), path, "one")
    with pytest.raises(Exception):
        sinks.write_stage(folded.select("a"), path, "one", overwrite=False)
    log = scratch_path(spark, "log")
    with sinks.timed(spark, log, "d", "step"):
        pass
    assert sinks.read_run_log(spark, log).first()["component"] == "step"


SETTINGS = pipeline.Settings(
    k=3, algorithms=("NB", "LR", "DT"), n_trials=0, instance_subset=100, n_repeats=2, max_features=3, parallel=3,
)


@pytest.fixture(scope="module")
def finished(spark, table):
    out = scratch_path(spark, "experiment")
    first = pipeline.run_dataset(table, "full", ROLES, SETTINGS, out)
    slim = pipeline.Settings(
        k=3, algorithms=("NB", "LR", "DT"), n_trials=0, scorers=("mi",), iterative_impute=False, n_repeats=2, parallel=3,
        params={},
    )
    second = pipeline.run_dataset(table.drop("a"), "reduced", ROLES, slim, out)
    return first, second


def test_all_phases(finished):
    (run, models), _ = finished
    perf = run.load("performance")
    assert perf.count() == 3 * 3 * 16
    assert set(models) == {(f, a) for f in range(3) for a in ("NB", "LR", "DT")}
    auc = perf.where("metric = 'ROC_AUC'").agg(F.avg("value")).first()[0]
    assert auc > 0.75
    assert run.load("selected").groupBy("fold").count().where("count > 3").count() == 0
    assert run.load("composite_Norm").count() > 0
    assert {"exploratory", "preprocessing", "NB", "Stats"} <= {r["component"] for r in run.load("runtimes").collect()}
    view = run.view(0)
    assert view.select(FEATURES).na.drop().count() == view.count()


def test_compare_two_datasets(finished):
    (first, _), (second, _) = finished
    out = pipeline.compare_runs([first, second])
    assert out["kruskal"].count() == 3 * 16
    assert out["best_mann_whitney"].count() == 16
    tables = report.report_tables(
        first.load("settings"), first.load("counts"),
        first.load("performance").unionByName(second.load("performance")), first.load("run_log"), ["full", "reduced"],
    )
    assert tables["best"].count() == 10 and "best_comparison" in tables


def test_apply_to_new_rows(spark, finished):
    (run, models), _ = finished
    fresh = spark.createDataFrame(
        [(r[0] + 1000, r[2], r[6], r[5], r[4], r[3], 1) for r in table_rows(90, 7)],
        "inst_id long, class int, noise double, b double, a double, cat int, extra int",
    )
    stored = run.apply(fresh, "new")  # models from disk
    direct = run.apply(fresh, "new2", models)
    assert stored["means"].count() == 3
    a = {r["algorithm"]: r["ROC_AUC"] for r in stored["means"].collect()}
    b = {r["algorithm"]: r["ROC_AUC"] for r in direct["means"].collect()}
    assert a == pytest.approx(b) and min(a.values()) > 0.7
    with pytest.raises(ValueError):
        run.apply(fresh.drop("a"), "bad")


def test_stream_equals_batch(spark, folded, tmp_path):
    fill = prep.fit_fill(folded, KINDS, 3)
    scaler = prep.fit_scaler(folded, FEATURES, 3, fill)
    rows = replication.prepare_replication(folded.drop("fold"), ROLES, FEATURES, 3, fill, scaler)
    model = fm.fit("NB", rows.where("cv = 0").drop("cv"), ROLES, FEATURES)
    path = str(tmp_path / "in")
    folded.select("inst_id", "class", *FEATURES).repartition(3).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    query = score_stream(stream, model, FEATURES, 0, fill, scaler).writeStream.format("memory").queryName("scored").start()
    query.processAllAvailable()
    query.stop()
    got = {r["inst_id"]: r["p"] for r in spark.table("scored").collect()}
    want = {r["inst_id"]: r["p"] for r in model.predict(rows.where("cv = 0").drop("cv")).collect()}
    assert got == pytest.approx(want)


def test_shared_folder_comes_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))




def test_tuned_run_fits_every_algorithm(spark, table):
    """With trials, every (fold, algorithm) is tuned on inner folds of rows that carry ``cv`` and ends done."""
    tuned = pipeline.Settings(
        k=3, algorithms=("NB", "LR", "DT"), n_trials=1, scorers=("mi",), iterative_impute=False, n_repeats=1,
        parallel=3,
    )
    run, models = pipeline.run_dataset(table, "tuned", ROLES, tuned, scratch_path(spark, "tuned"))
    log = run.load("training_log").collect()
    assert sorted((r["fold"], r["algorithm"]) for r in log) == sorted((f, a) for f in range(3) for a in ("NB", "LR", "DT"))
    assert {r["status"] for r in log} == {"done"}
    assert set(models) == {(f, a) for f in range(3) for a in ("NB", "LR", "DT")}
