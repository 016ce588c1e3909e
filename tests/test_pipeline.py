"""Stage operators: structural errors, idempotence, schema checks, metric refusals, plans."""

import pytest
from pyspark.sql import functions as F

from censusflow import spec
from censusflow.operators import clean as C
from censusflow.operators import publish as L
from censusflow.operators import transform as T
from censusflow.plans import metrics as M
from censusflow.plans import pipeline


def test_duplicate_headers_after_trim_fail(spark):
    df = spark.createDataFrame([("a", "b")], ["Gender", "Gender "])
    with pytest.raises(ValueError):
        C.clean_headers(df)


def test_missing_source_column_fails(spark, sf_dir):
    raw = C.clean_headers(pipeline.raw_export(spark, sf_dir)).drop("Gender")
    with pytest.raises(KeyError):
        C.rename_columns(raw)


def test_transform_is_idempotent(spark, sf_dir):
    once = pipeline.stage4(spark, sf_dir)
    twice = T.transform_survey(once)
    assert once.columns == twice.columns
    assert once.exceptAll(twice).count() == 0


def test_display_rejects_unknown_column(spark, sf_dir):
    with pytest.raises(KeyError):
        T.display_frame(pipeline.stage4(spark, sf_dir).withColumn("extra", F.lit(1)))


def test_strict_money_raises_with_examples(spark, sf_dir):
    from censusflow.sources.binding import money_defects
    df = T.shorten_names(money_defects(pipeline.stage3(spark, sf_dir)))
    with pytest.raises(ValueError, match="about 2k"):
        T.coerce_money(df, strict=True)


def test_preload_columns_rule(spark, sf_dir):
    df = pipeline.stage4_display(spark, sf_dir)
    assert L.preload_columns(df) == []
    assert L.preload_columns(df.drop("Gender"))[0][0] == "missing"
    rules = [r for r, _ in L.preload_columns(df.select(*reversed(df.columns)).withColumn("x", F.lit(1)))]
    assert rules == ["extra", "reordered"]


@pytest.mark.parametrize("kwargs", [
    dict(measure="nonsense"), dict(measure="allowance", agg="mode"),
    dict(measure="allowance", filters=[("specialization", "MBA")]),
    dict(measure="allowance", filters=[("degree", "PhD")]), dict(measure="allowance", dimensions=["colour"]),
])
def test_metric_refuses(spark, sf_dir, kwargs):
    with pytest.raises(M.MetricError):
        M.metric_query(pipeline.survey_view(spark, sf_dir), **kwargs)


def test_limit_clamp():
    assert M.clamp_limit(None) == 50 and M.clamp_limit(0) == 1 and M.clamp_limit(9999) == 500


def test_report_window_runs_over_aggregated_rows(spark, sf_dir):
    from censusflow.plans.reports import r02_by_degree
    plan = r02_by_degree(pipeline.survey_view(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    # the unpartitioned window sits above the aggregate: its input is one row per degree
    assert plan.index("Window") < plan.index("Aggregate")


def test_published_types(spark, sf_dir):
    pub = pipeline.published(spark, sf_dir)
    types = dict(pub.dtypes)
    assert types["food_expenses"] == "decimal(12,2)" and types["budget_usage_pct"] == "decimal(7,2)"
    assert types["submitted_at"] == "timestamp"
    assert set(pub.columns) == set(spec.PUBLISHED_COLUMNS)
