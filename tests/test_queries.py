"""Every query with an SQL equivalent gives the same rows in DuckDB."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
MODELS = [n for n in entry.queries() if n not in entry.oracle_sql()]


@pytest.fixture(scope="module")
def con():
    return connect(SF)

#: One sample per task, and the block reader: their core is Python.
IN_PANDAS = ["gc_correct_lowess", "read_mixed_fragments"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    plan = plan_of(df)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "PythonUDF" not in plan and ("InPandas" not in plan or name in IN_PANDAS)
    assert compare(df, con, entry.oracle_sql()[name], 1e-9) is None


@pytest.mark.parametrize("name", ["model_cv_logistic"])
def test_query_without_sql(spark, name):
    assert name in MODELS
    assert entry.queries()[name](spark, SF).count() > 0


def test_model_queries_run_the_whole_job(spark, monkeypatch):
    from fragloom.operators import model as md
    from fragloom.params import DEFAULTS
    seen = []

    class Stop(Exception):
        pass

    def trained(features, labelled, params=DEFAULTS, size=md.Learner(), candidates=tuple(md.CANDIDATES)):
        seen.append((params, size, tuple(candidates)))
        raise Stop

    def validated(name, vectors, folds, params=DEFAULTS, size=md.Learner()):
        seen.append((params, size, name))
        return vectors

    monkeypatch.setattr(md, "train", trained)
    monkeypatch.setattr(md, "cross_validate", validated)
    for name in ("model_cv_predictions", "model_predict"):
        with pytest.raises(Stop):
            entry.queries()[name](spark, SF)
    for name in ("model_cv_logistic", "model_cv_forest", "model_cv_boosting"):
        entry.queries()[name](spark, SF)
    assert seen == [*[(DEFAULTS, md.Learner(), tuple(md.CANDIDATES))] * 2, *[(DEFAULTS, md.Learner(), c) for c in md.CANDIDATES]]


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from fragloom.catalog.views import fragments
    from fragloom.operators.fragments import filter_mapq
    from fragloom.operators.coverage import bin_counts
    path = str(tmp_path / "f")
    fragments(spark, SF).write.parquet(path)
    table = spark.read.parquet(path)
    plan = plan_of(bin_counts(filter_mapq(table), 100_000))
    assert "GreaterThanOrEqual(mapq,30)" in plan
    assert "strand" not in plan.split("ReadSchema")[1]
