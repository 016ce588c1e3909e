"""The gated load, the CSV readers and the cached inputs."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from censusflow.operators import quality as Q
from censusflow.plans import pipeline
from censusflow.plans.load import LoadRefused, VerificationFailed, load_survey, preload_problems, verify_with
from censusflow.plans.view import analysis_view
from censusflow.sources import io
from censusflow.sources import versions as V
from censusflow.sources.artifacts import artifact_path, materialize


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return pipeline.raw_export(spark, sf_dir)


def test_bad_labels_are_rejected_not_nulled(spark, raw):
    name = next(c for c in raw.columns if c.strip() == "Monthly Allowance")
    bad = raw.withColumn(name, F.when(F.col("response_id") % 10 == 0, "about 2k").otherwise(F.col(f"`{name}`")))
    out = load_survey(bad, artifact_path(spark, "load-test"), policy="off", as_of="2026-01-01 00:00:00")
    assert {r["reasons"] for r in out.rejected.collect()} == {"money:allowance"}
    assert out.published.filter("allowance is null or student_id % 10 = 0").count() == 0
    assert out.published.count() + out.rejected.count() == pipeline.stage3(spark, os.environ.get("CENSUSFLOW_TEST_SF", "/root/testdata/sf0.001")).count()
    assert out.checks.filter("name = 'generated_columns_consistent'").first()["ok"]
    assert out.published.filter("allowance is null or food_expenses > 3000").count() >= 0


def test_unknown_answers_are_rejected(spark, raw):
    bad = raw.withColumn("Degree", F.when(F.col("response_id") % 10 == 0, "Diploma").otherwise(F.col("Degree")))
    out = load_survey(bad, artifact_path(spark, "load-test"), policy="off", as_of="2026-01-01 00:00:00")
    assert {r["reasons"] for r in out.rejected.collect()} == {"ck_students_budget_degree"}


def test_critical_finding_blocks(spark, raw):
    path = artifact_path(spark, "load-test")
    with pytest.raises(Q.QualityCheckFailed):
        load_survey(raw.unionByName(raw.limit(3)), path, policy="report", as_of="2026-01-01 00:00:00")
    assert not os.path.exists(path)


def _load(raw, path, **kw):
    return load_survey(raw, path, policy="off", as_of="2026-01-01 00:00:00", **kw)


def test_repeated_and_null_keys_are_split_by_row(spark, raw):
    good = raw.filter("response_id >= 0").orderBy("response_id").limit(40)
    ids = [r[0] for r in good.select("response_id").collect()]
    label = next(c for c in raw.columns if c.strip() == "Monthly Allowance")
    again = good.filter(F.col("response_id") == ids[0])
    rows = good.unionByName(again).unionByName(again.withColumn(label, F.lit("about 2k"))).unionByName(
        good.filter(F.col("response_id") == ids[1]).withColumn("response_id", F.lit(None).cast("long")).withColumn("Degree", F.lit("Diploma"))).unionByName(
        good.filter(F.col("response_id") == ids[2]).withColumn("response_id", F.lit(None).cast("long")))
    out = _load(rows, artifact_path(spark, "load-keys"))
    got = sorted((r["student_id"] for r in out.published.collect()), key=lambda x: (x is None, x))
    assert got == sorted([*ids, ids[0]]) + [None]
    assert sorted((str(r["response_id"]), r["reasons"]) for r in out.rejected.collect()) == sorted([(str(ids[0]), "money:allowance"), ("None", "ck_students_budget_degree")])


def test_a_failed_load_leaves_the_old_table(spark, sf_dir, raw, monkeypatch):
    path, table = artifact_path(spark, "load-atomic"), pipeline.published_table(spark, sf_dir)
    n = V.publish_version(table.limit(30), path).count()
    with pytest.raises(VerificationFailed) as e:
        _load(raw.limit(50), path, expected={"row_count": 7})
    assert e.value.checks == ["row_count"]
    assert V.current_version(spark, path) == 1 and V.read_version(spark, path).count() == n == 30
    monkeypatch.setattr(V, "Observation", type("Lost", (V.Observation,), {"get": {"staged": -1}}))
    with pytest.raises(V.LoadCountMismatch):
        V.publish_version(table, path)
    monkeypatch.undo()
    with pytest.raises(V.LoadCountMismatch):
        V.publish_version(table.limit(5), path, expected_rows=6)
    assert V.read_version(spark, path).count() == n
    assert V.publish_version(table.limit(20), path, append=True, verify=verify_with(None)).count() == V.manifest(spark, path)["rows"] == 50
    broken = table.limit(5).withColumn("savings", F.col("savings") + 1)
    with pytest.raises(VerificationFailed):
        V.publish_version(broken, path, append=True, verify=verify_with(None))
    assert V.rollback(spark, path, 1).count() == n and V.current_version(spark, path) == 3
    assert V.vacuum(spark, path, keep=1) == 5 and V.read_version(spark, path).count() == n


def test_of_two_loads_at_once_one_is_refused(spark):
    path = artifact_path(spark, "versions")
    V.publish_version(spark.range(3), path)

    def meanwhile(_):
        V.publish_version(spark.range(5), path)
    with pytest.raises(V.VersionConflict):
        V.publish_version(spark.range(9), path, verify=meanwhile)
    assert V.read_version(spark, path).count() == 5
    with pytest.raises(KeyError):
        io.append_by_name(spark.range(1).withColumnRenamed("id", "x"), path)
    assert V.read_version(spark, path, 1).count() == 3 and V.publish_version(spark.range(0), path).count() == 0
    with pytest.raises(FileNotFoundError):
        V.read_version(spark, artifact_path(spark, "no-such-table"))


def test_refusals_name_examples():
    e = LoadRefused([("domain", "Degree", 2, ["Diploma", "PhD"]), ("negative", "Food", 1, [])])
    assert "such as ['Diploma', 'PhD']" in str(e) and "negative Food (1)" in str(e)


def test_preload_problems_are_found(spark, sf_dir):
    from censusflow.registry import defect_frame
    rules = {r["rule"] for r in preload_problems(defect_frame(spark, sf_dir)).collect()}
    assert {"blank", "domain", "non_numeric"} <= rules
    assert issubclass(LoadRefused, RuntimeError)


def test_future_is_after_now(spark, sf_dir):
    df = pipeline.stage4_display(spark, sf_dir).withColumn("Timestamp", F.lit("2026-03-21 10:00:00"))
    now = {r["name"]: r["passed"] for r in Q.run_quality_checks(df, checks=["timestamps"], examples=False).collect()}
    then = {r["name"]: r["passed"] for r in Q.run_quality_checks(df, as_of="2026-01-01 00:00:00", checks=["timestamps"], examples=False).collect()}
    assert now["timestamp_not_future"] and not then["timestamp_not_future"]


def test_broken_check_is_reported(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(Q, "_outliers", lambda *a: 1 / 0)
    rows = Q.run_quality_checks(pipeline.stage4_display(spark, sf_dir), checks=["outliers", "row_count"], examples=False).collect()
    assert [r["severity"] for r in rows if r["category"] == "internal"] == ["CRITICAL"]
    assert any(r["name"] == "row_count_not_empty" for r in rows)


def test_csv_header_decides(spark):
    folder = tempfile.mkdtemp(prefix="cf-csv-")
    with open(f"{folder}/x.csv", "w") as f:
        f.write('b,a,c\n1,"two\nlines",3\n4,,6\n')
    rows = io.read_raw_csv(spark, folder, ["a", "b"]).collect()
    assert [tuple(r) for r in rows] == [("two\nlines", "1"), (None, "4")]
    with pytest.raises(io.HeaderMismatch):
        io.read_raw_csv(spark, folder, ["a", "d"])


def test_changed_input_is_read_anew(spark):
    folder = tempfile.mkdtemp(prefix="cf-in-")
    spark.range(3).write.mode("overwrite").parquet(f"{folder}/t")
    read = lambda: materialize(lambda: spark.read.parquet(f"{folder}/t"), "changing", folder, spark=spark).count()
    assert read() == 3 and read() == 3
    spark.range(5).write.mode("append").parquet(f"{folder}/t")
    assert read() == 8


def test_view_refuses_fractions(spark, sf_dir):
    pub = pipeline.published(spark, sf_dir).limit(3).withColumn("allowance", F.lit("1000.75").cast("decimal(12,2)"))
    with pytest.raises(Exception, match="not a whole amount"):
        analysis_view(pub).collect()


def test_an_append_is_judged_against_all_rows(spark, raw):
    path, good = artifact_path(spark, "load-merged"), raw.filter("response_id >= 0").orderBy("response_id").limit(60)
    first, second = good.filter("response_id % 2 = 0"), good.filter("response_id % 2 = 1")
    _load(first, path)
    both = _load(second, path, append=True)
    alone = _load(good, artifact_path(spark, "load-whole"))
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert key(both.results) == key(alone.results)
    assert len(V.manifest(spark, path)["notes"]["gate"]) == 2
    # a row of the first load again: no duplicate within the append, but one in the table
    with pytest.raises(Q.QualityCheckFailed) as e:
        load_survey(first.limit(1), path, policy="report", as_of="2026-01-01 00:00:00", append=True)
    assert "exact_duplicate_rows" in e.value.blocking
    assert V.current_version(spark, path) == 2
    # replaced as a whole, the table's earlier rows no longer count; a rollback brings their states back
    _load(first, path)
    assert len(V.manifest(spark, path)["notes"]["gate"]) == 1
    V.rollback(spark, path, 2)
    assert len(V.manifest(spark, path)["notes"]["gate"]) == 2
    with pytest.raises(Q.QualityCheckFailed):
        load_survey(second.limit(1), path, policy="report", as_of="2026-01-01 00:00:00", append=True)


def test_loads_with_own_checks(spark, raw):
    check = Q.OwnCheck("some_rows", lambda f: {"n": (F.count(F.lit(1)), "sum")},
                       lambda s: [Q.Finding("some_rows", "own", "CRITICAL", s["n"] > 50, F.format_string("rows: %d", s["n"]), F.lit(0))])
    path, rows = artifact_path(spark, "load-own"), raw.filter("response_id >= 0").orderBy("response_id").limit(60)
    out = _load(rows.filter("response_id % 2 = 0"), path, own=[check])
    assert not out.results.filter("name = 'some_rows'").first()["passed"]
    out = _load(rows.filter("response_id % 2 = 1"), path, own=[check], append=True)
    assert out.results.filter("name = 'some_rows'").first()["passed"]
    with pytest.raises(ValueError):
        _load(rows, path, append=True)


def test_rows_are_split_without_a_shuffle(spark, raw):
    from censusflow.operators.clean import clean_survey
    from censusflow.plans.load import split_rows
    few = raw.filter("response_id >= 0").orderBy("response_id").limit(30)
    few = few.withColumn("Degree", F.when(F.col("response_id") % 4 == 0, "Diploma").otherwise(F.col("Degree")))
    n = few.filter("Degree = 'Diploma'").count()
    accepted, rejected = split_rows(clean_survey(few))
    for part in (accepted, rejected):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
    assert (accepted.count(), rejected.count()) == (30 - n, n) and n > 0
    assert {r["reasons"] for r in rejected.collect()} == {"ck_students_budget_degree"}
