"""Registry of every implemented operator: key -> (spark, sf_dir) -> DataFrame.

Every entry reads the driver tables (or frames Spark derives from them), so
its work grows with the data.  ``oracle_queries`` holds the DuckDB SQL for the
keys that have one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .plans import pipeline
from .operators import gate_state, quality
from .plans import metrics as M
from .plans.reports import REPORTS
from .sources.artifacts import artifact_path, materialize
from .sources.binding import survey_defects

Query = Callable[[SparkSession, str], DataFrame]


def _report(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pipeline.survey_view(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def defect_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage-4 display frame of the bound survey with the key-derived defects applied.

    Written once as the artifact the gate inspects, then read back by every check.
    """
    return materialize(lambda: survey_defects(pipeline.stage4_display(spark, sf_dir)), "survey_defects", sf_dir,
                       spark=spark)


# dq key -> check group of ``run_quality_checks``
DQ_KEYS = {
    "dq_row_count": "row_count", "dq_columns": "columns", "dq_no_nulls": "no_nulls",
    "dq_populated": "populated", "dq_money_numeric": "money_numeric",
    "dq_non_negative": "non_negative", "dq_integral": "integral", "dq_total": "total",
    "dq_savings": "savings", "dq_usage": "usage", "dq_outliers": "outliers",
    "dq_censored": "censored", "dq_timestamps": "timestamps", "dq_cross_field": "cross_field",
    "dq_domains": "domains", "dq_cardinality": "cardinality",
}
DQ_KEYS.update({"dq_exact_dupes": "exact_duplicates", "dq_name_ts_dupes": "name_timestamp_duplicates",
                "dq_repeated_names": "repeated_names"})

# The fixture's moment of checking: its timestamps are fixed, and so must be what counts as the future.
AS_OF = "2026-01-01 00:00:00"


def _dq(group: str) -> Query:
    # these two only report counts, in their message
    columns = (*quality.COMPARED_COLUMNS, *(["message"] if group in ("censored", "cardinality") else []))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.run_quality_checks(defect_frame(spark, sf_dir), as_of=AS_OF, checks=[group], examples=False).select(*columns)
    return run


def quality_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All check results, written once; report, summary, gate, JSON and explanations read them."""
    return materialize(lambda: quality.run_quality_checks(defect_frame(spark, sf_dir), as_of=AS_OF), "quality_results", sf_dir, spark=spark)


def food_beyond_allowance() -> quality.OwnCheck:
    """A caller's check: food alone costs more than the allowance."""
    def states(f: DataFrame):
        food, allowance = (F.col(c).try_cast("double") for c in ("Food", "Allowance"))
        return {"n": (F.count(F.when(food > allowance, 1)), "sum"), "most": (F.max(F.when(food > allowance, food - allowance)), "max")}

    def findings(s):
        yield quality.Finding("food_beyond_allowance", "own", "WARNING", s["n"] == 0, F.format_string("rows: %d, by up to %s", s["n"], s["most"].cast("string")), s["n"])
    return quality.OwnCheck("food_beyond_allowance", states, findings)


def _own_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_quality_checks(defect_frame(spark, sf_dir), as_of=AS_OF, checks=["row_count", "no_nulls"], examples=False,
                                      own=[food_beyond_allowance()]).select(*quality.COMPARED_COLUMNS)


def _merged_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report from the written states of three loads (dealt by a hash of the key)."""
    df, part = defect_frame(spark, sf_dir), F.pmod(F.xxhash64("response_id"), F.lit(3))
    paths = [gate_state.write_state(gate_state.gate_state(df.filter(part == i), AS_OF), artifact_path(spark, "gate-state")) for i in range(3)]
    return gate_state.state_findings(gate_state.read_states(spark, paths), AS_OF, examples=False).select(*quality.COMPARED_COLUMNS)


def _quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_results(spark, sf_dir).select(*quality.COMPARED_COLUMNS)


def _quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_summary(quality_results(spark, sf_dir))


def _quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_gate(quality_results(spark, sf_dir), policy="strict").drop("seq")


def registered_queries() -> dict[str, Query]:
    q: dict[str, Query] = {"analysis_view": lambda s, d: pipeline.survey_view(s, d)}
    for name, fn in REPORTS.items():
        q[name] = _report(fn)
    for key, group in DQ_KEYS.items():
        q[key] = _dq(group)
    for key, fn in METRICS.items():
        q[key] = _report(fn)
    q.update(_stages())
    q.update(_text_jobs())
    q["quality_report"] = _quality_report
    q["quality_report_own"] = _own_report
    q["quality_report_merged"] = _merged_report
    q["quality_summary"] = _quality_summary
    q["quality_gate"] = _quality_gate
    return q


METRICS = {
    "m_avg": lambda v: M.metric_query(v, "total_expenses", "avg", ["degree"]),
    "m_sum": lambda v: M.metric_query(v, "allowance", "sum", ["accommodation"]),
    "m_count": lambda v: M.metric_query(v, "student_count", dimensions=["year_of_study"]),
    "m_max": lambda v: M.metric_query(v, "total_expenses", "max", ["preferred_payment"]),
    "m_min": lambda v: M.metric_query(v, "allowance", "min", ["background"]),
    "m_median": lambda v: M.metric_query(v, "total_expenses", "median", ["study_focus"]),
    "m_filtered": lambda v: M.metric_query(v, "academic_expenses", "avg", ["accommodation"],
                                           filters=[("degree", "BSc"), ("gender", "Female")]),
    "m_negated": lambda v: M.metric_query(v, "total_expenses", "avg", ["degree"],
                                          filters=[("accommodation", "Hostel", True)]),
    "m_compare": lambda v: M.metric_query(v, "allowance", "avg",
                                          compare=("accommodation", ("Hostel", "Day Scholar"))),
    "m_scalar": lambda v: M.metric_query(v, "food_expenses", "avg", filters=[("background", "Rural")]),
    "m_grouped": lambda v: M.metric_query(v, "overspend_amount", "avg", ["upi_app"], ranking="asc", limit=5),
    "m_two_dims": lambda v: M.metric_query(v, "total_expenses", "avg", ["degree", "gender"], limit=8),
    "m_by_year": lambda v: M.metric_query(v, "total_expenses", "avg", ["year_of_study"]),
    "m_dual_ratio": lambda v: M.metric_query(v, "budget_usage_pct", "avg", ["accommodation"]),
    "m_top_n": lambda v: M.top_n(v, "upi_app", 5),
    "m_extreme": lambda v: M.metric_query(v, "total_expenses", extreme=True),
    "m_detail": lambda v: M.metric_query(v, "total_expenses", detail=True,
                                         filters=[("accommodation", "PG")], limit=10),
    "m_caveats": lambda v: M.measure_caveats(v),
    "m_drift": lambda v: M.drift_check(v),
    "i_group_spread": lambda v: M.group_spread(M.metric_query(v, "total_expenses", "avg", ["degree"]),
                                               "degree", "avg_total_expenses"),
    "i_share": lambda v: M.share_of_rows(v, [("accommodation", "Hostel")]),
    "i_savings": lambda v: M.savings_reading(v),
    "i_overview": lambda v: M.overview(v),
}

def _stages() -> dict[str, Query]:
    """Source, cleaning, transformation and publish keys (each reads the driver tables)."""
    from .functions.money import with_midpoints, with_stripped
    from .operators import clean as C
    from .operators import publish as L
    from .operators import transform as T
    from .sources import binding as B
    from .sources import io
    from .sources.artifacts import artifact_path
    from .plans.view import publish_projection

    raw = pipeline.raw_export
    s3 = pipeline.stage3
    s4 = pipeline.stage4
    money = ("food", "transport", "academic", "other", "allowance")
    long_money = ("food_expenses_monthly", "transport_expenses_monthly", "academic_expenses_monthly",
                  "other_expenses_monthly", "monthly_allowance")

    def scan_raw(spark, d):
        r = raw(spark, d)
        path = io.write_csv(r, artifact_path(spark, "survey_raw_csv"))
        back = io.read_raw_csv(spark, path, r.columns)
        return back.withColumn(B.KEY, F.col(B.KEY).cast("long"))

    def scan_csv_strings(spark, d):
        df = pipeline.stage4_display(spark, d)
        path = io.write_csv(df, artifact_path(spark, "stage4_csv"))
        return io.read_raw_csv(spark, path, df.columns, blank_strings=True)

    def write_roundtrip(spark, d):
        df = s4(spark, d)
        path = io.write_csv(df, artifact_path(spark, "stage4_canonical_csv"))
        return io.read_typed_csv(spark, path, df.schema)

    def publish_table(spark, d):
        return io.publish_table(pipeline.published(spark, d), artifact_path(spark, "students_budget"))

    def append_by_name(spark, d):
        pub = pipeline.published(spark, d)
        path = artifact_path(spark, "students_budget_append")
        io.publish_table(pub.filter(F.col("student_id") % 2 == 0), path)
        odd = pub.filter(F.col("student_id") % 2 != 0)
        return io.append_by_name(odd.select(*reversed(odd.columns)), path)

    def missing_cols(spark, d):
        df = pipeline.stage4_display(spark, d).drop("Background", "Study Focus")
        return publish_projection(T.fill_missing_columns(df))

    def strip(spark, d):
        return with_stripped(s3(spark, d), {f"{m}_text": c for c, m in zip(long_money, money)}).select(B.KEY, *[f"{m}_text" for m in money])

    def parse(spark, d):
        return with_midpoints(s3(spark, d), dict(zip(money, long_money))).select(B.KEY, *money)

    def coerce(spark, d):
        return T.coerce_money(T.shorten_names(s3(spark, d))).select(B.KEY, *money)

    def rejects(spark, d):
        df = T.shorten_names(B.money_defects(s3(spark, d)))
        return T.money_rejects(df).select(B.KEY, F.array_join("failed_columns", ",").alias("failed_columns"))

    def partial(*steps):
        def run(spark, d):
            df = T.coerce_money(T.shorten_names(s3(spark, d)))
            for st in steps:
                df = st(df)
            return df
        return run

    def loader(spark, d):
        return L.loader_frame(defect_frame(spark, d))

    def load_rows(spark, d):
        """A survey with unreadable labels, split into rows to publish and rejects."""
        from .plans.load import split_rows

        def part(i):
            return materialize(lambda: split_rows(B.money_defects(s3(spark, d)))[i], f"load_part_{i}", d, spark=spark)
        return part

    def arithmetic(spark, d):
        return L.preload_arithmetic(loader(spark, d))

    def arithmetic_repaired(spark, d):
        # every row, with 0 where the allowance cannot be read
        readable = F.col("Allowance").rlike(r"^\s*-?\d+(\.\d+)?\s*$")
        return L.preload_arithmetic(loader(spark, d).withColumn("Allowance", F.when(readable, F.col("Allowance")).otherwise("0")))

    def report_json(spark, d):
        report = io.report_envelope(quality_results(spark, d), defect_frame(spark, d).agg(F.count(F.lit(1)).alias("n")), "strict")
        path = io.write_json(report, artifact_path(spark, "quality_report_json"))
        back = spark.read.json(path).select("row_count", "policy", F.col("passed").alias("report_passed"), "summary.*", F.explode("results").alias("r"))
        return back.select("row_count", "policy", "report_passed", F.col("total").alias("results"), "critical", "warning", "info", "skipped",
                           *[f"r.{c}" for c in quality.COMPARED_COLUMNS])

    return {
        "scan_raw": scan_raw,
        "scan_csv_strings": scan_csv_strings,
        "write_roundtrip": write_roundtrip,
        "publish_table": publish_table,
        "publish_frame_missing_cols": missing_cols,
        "append_by_name": append_by_name,
        "quality_report_json": report_json,
        "clean_headers": lambda sp, d: C.clean_headers(raw(sp, d)),
        "drop_junk_rows": lambda sp, d: C.drop_junk_rows(C.clean_headers(raw(sp, d))),
        "rename_columns": lambda sp, d: C.rename_columns(C.drop_junk_rows(C.clean_headers(raw(sp, d)))),
        "fold_specialization": lambda sp, d: C.fold_specialization(
            C.rename_columns(C.drop_junk_rows(C.clean_headers(raw(sp, d))))).select(B.KEY, "specialization"),
        "fill_upi_app": lambda sp, d: C.fill_upi_app(
            C.rename_columns(C.drop_junk_rows(C.clean_headers(raw(sp, d))))).select(B.KEY, "upi_app"),
        "clean_survey": s3,
        "strip_currency": strip,
        "parse_midpoint": parse,
        "coerce_money": coerce,
        "money_rejects": rejects,
        "shorten_names": lambda sp, d: T.shorten_names(s3(sp, d)).select(
            B.KEY, "accommodation", "background", "work_internship", "study_focus", "track_digitally",
            "budget_plan"),
        "add_total": lambda sp, d: partial(T.add_total)(sp, d).select(B.KEY, "total_expenses"),
        "add_savings": lambda sp, d: partial(T.add_total, T.add_savings)(sp, d).select(B.KEY, "savings"),
        "add_usage": lambda sp, d: partial(T.add_total, T.add_usage)(sp, d).select(B.KEY, "budget_usage_pct"),
        "display_frame": pipeline.stage4_display,
        "transform_survey": s4,
        "transform_idempotent": lambda sp, d: T.transform_survey(s4(sp, d)),
        "profile_measures": lambda sp, d: T.profile_measures(s4(sp, d)),
        "value_counts": lambda sp, d: T.value_counts(s4(sp, d), "degree"),
        "publish_projection": pipeline.published,
        "preload_blanks": lambda sp, d: L.preload_blanks(loader(sp, d)),
        "preload_domains": lambda sp, d: L.preload_domains(loader(sp, d)),
        "preload_money": lambda sp, d: L.preload_money(loader(sp, d)),
        "preload_usage": lambda sp, d: L.preload_usage(loader(sp, d)),
        "preload_name": lambda sp, d: L.preload_name(loader(sp, d)),
        "preload_arithmetic": arithmetic,
        "preload_arithmetic_repaired": arithmetic_repaired,
        "load_accepted": lambda sp, d: publish_projection(load_rows(sp, d)(0)),
        "load_rejected": lambda sp, d: load_rows(sp, d)(1),
        "verify_load": lambda sp, d: L.verify_load(pipeline.published(sp, d)),
        "constraint_violations": lambda sp, d: L.constraint_violations(defect_frame(sp, d)),
    }


def _text_jobs() -> dict[str, Query]:
    from .operators import text_jobs as X
    from .sources import binding as B

    from .operators import intents as N
    from .operators.carry_over import carry_over
    from .plans.answers import answer
    from .sources.questions import QUESTIONS

    def qlog(sp, d):
        return B.question_log(sp, d, list(QUESTIONS))

    def mixed(sp, d):
        return B.mixed_questions(sp, d, list(QUESTIONS))

    def parsed(sp, d, log):
        # The intent table is written once and read back by every consumer.
        return materialize(lambda: N.parse_questions(log(sp, d)), f"intents_{log.__name__}", d, spark=sp)

    def texts(sp, d, log):
        return log(sp, d).select("conv_id", "turn", N.question_text(F.col("question")).alias("text"))

    def readings(sp, d, log):
        return N.with_readings(N.read_phrases(log(sp, d)))

    def n_measure(sp, d, log):
        return readings(sp, d, log).select("conv_id", "turn", "measure")

    def n_aggregation(sp, d, log):
        agg = F.coalesce("verb", N.default_aggregation(F.col("measure")), F.when(F.col("detail"), F.lit("")))
        return readings(sp, d, log).select("conv_id", "turn", agg.alias("aggregation"))

    def n_flags(sp, d, log):
        return readings(sp, d, log).select("conv_id", "turn", "ranking", "explicit_limit", "detail", "comparison")

    def n_filters(sp, d, log):
        p = parsed(sp, d, log)
        return p.select("conv_id", "turn", F.posexplode(F.array_union(
            F.col("filters"), F.transform(F.coalesce(F.col("compare_values"), F.array().cast("array<string>")),
                                          lambda v: F.struct(F.col("compare_dim").alias("dim"), v.alias("value"),
                                                             F.lit(False).alias("negated")))))) \
            .select("conv_id", "turn", F.col("pos").cast("long").alias("pos"), F.col("col.dim").alias("dimension"),
                    F.col("col.value").alias("value"), F.col("col.negated").alias("negated"))

    def n_dimensions(sp, d, log):
        return parsed(sp, d, log).select("conv_id", "turn", F.posexplode("dimensions")) \
            .select("conv_id", "turn", F.col("pos").cast("long").alias("pos"), F.col("col").alias("dimension"))

    def n_intents(sp, d, log):
        return N.intents_flat(parsed(sp, d, log))

    def n_carry_over(sp, d, log):
        return carry_over(parsed(sp, d, log))

    def n_answers(sp, d, log):
        return answer(parsed(sp, d, log), pipeline.survey_view(sp, d))

    jobs = {"n_normalise": texts, "n_measure": n_measure, "n_aggregation": n_aggregation, "n_flags": n_flags, "n_filters": n_filters,
            "n_dimensions": n_dimensions, "n_intents": n_intents, "n_carry_over": n_carry_over}

    def on(fn, log):
        return lambda sp, d: fn(sp, d, log)

    return {
        **{key: on(fn, qlog) for key, fn in jobs.items()},
        # the same over the table's own texts, each with a question somewhere inside
        **{f"{key}_texts": on(fn, mixed) for key, fn in jobs.items()},
        "n_answers": on(n_answers, qlog),
        "x_log_triage_texts": lambda sp, d: X.log_triage(B.mixed_log(sp, d, list(X.LOG_TEMPLATES))),
        "x_log_triage": lambda sp, d: X.log_triage(B.pipeline_log(sp, d, list(X.LOG_TEMPLATES))),
        "x_explain_findings": lambda sp, d: X.explain_findings(quality_results(sp, d)).drop("evidence"),
    }


ROWS_ONLY = {"dq_columns"}


def oracle_queries() -> dict[str, str]:
    from . import oracle_stages
    sql = {**oracle.report_sql(), **oracle.quality_sql(), **oracle.metric_sql(), **oracle.text_sql(), **oracle.question_sql(),
           **oracle_stages.stage_sql(), **oracle_stages.loader_sql()}
    sql = {k: v for k, v in sql.items() if k not in ROWS_ONLY}
    keys = registered_queries()
    return {k: v for k, v in sql.items() if k in keys}
