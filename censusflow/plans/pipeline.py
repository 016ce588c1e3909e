"""End-to-end plans: raw export -> cleaned -> transformed -> published -> view.

``raw_export``, ``parsed_export`` and ``published_table`` write their rows when first called (once per
input) and return a scan of them; the others return lazy plans over those scans.  Rows whose money labels
do not convert are not published: ``money_rejected`` has them.  The gated load with its rules and checks is
``load.load_survey``.  ``survey_view`` is the input of every report and of the metric layer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import clean_survey
from ..operators.transform import display_frame, flag_money, shorten_names, transform_survey
from ..sources.artifacts import materialize
from ..sources.binding import survey_raw
from .view import analysis_view, publish_projection


def raw_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw form export, written once as a file (as a real export is) and scanned back.

    Writing it cuts the lineage to the star-schema join and keeps the fixture's
    label rendering out of the cleaning stage's generated code.
    """
    return materialize(lambda: survey_raw(spark, sf_dir), "survey_raw", sf_dir, spark=spark)


def stage3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_survey(raw_export(spark, sf_dir))


def parsed_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage 3 with its amounts parsed and the columns that failed, written once."""
    return materialize(lambda: flag_money(shorten_names(stage3(spark, sf_dir))), "survey_parsed", sf_dir, spark=spark)


def money_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_export(spark, sf_dir).filter("failed_columns <> ''")


def stage4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform_survey(parsed_export(spark, sf_dir).filter("failed_columns = ''").drop("failed_columns"))


def stage4_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display_frame(stage4(spark, sf_dir))


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_projection(stage4_display(spark, sf_dir))


def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published table, written once (the load) and scanned by every report."""
    return materialize(lambda: published(spark, sf_dir), "students_budget", sf_dir, spark=spark)


def survey_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis_view(published_table(spark, sf_dir))
