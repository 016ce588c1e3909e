"""Reports R1-R20 over the analysis view.

Shared rules:

* every sum is exact integer arithmetic and is divided once, rounding half
  away from zero like SQL ``round`` on numerics (``functions.columns``);
* "share of all" windows run **above** the aggregate, so the unpartitioned
  window sees one row per group, never raw rows;
* the per-area reports (R12-R16, R19) aggregate the four expense columns side
  by side and ``stack`` the handful of aggregated rows, instead of unpivoting
  every response (4x the rows) or shuffling by response id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import spec
from ..functions.columns import count_if, median_disc, pct, round_half_up_ratio

AREAS = (("Food", "food_expenses"), ("Transport", "transport_expenses"),
         ("Academic", "academic_expenses"), ("Other", "other_expenses"))
CEILING = spec.CENSORED_EXPENSE


def _all() -> Window:
    """Window over every row; only ever applied to aggregated rows."""
    return Window.partitionBy()


def _usage10() -> Column:
    return F.round(F.col("budget_usage_pct") * 10).cast("long")


def mean2(c: str) -> Column:
    """round(avg(c), 2) on a whole-number column."""
    return round_half_up_ratio(F.sum(c), F.count(c), 2)


def mean_ratio2() -> Column:
    """round(avg(budget_usage_pct), 2), exact via tenths."""
    return round_half_up_ratio(F.sum(_usage10()), F.count(_usage10()) * 10, 2)


def agg_ratio2() -> Column:
    """round(100 * sum(total) / nullif(sum(allowance), 0), 2)."""
    return round_half_up_ratio(F.sum("total_expenses") * 100, F.sum("allowance"), 2)


def students() -> Column:
    return F.count(F.lit(1)).alias("students")


def share_of_all(col: str, scale: int = 1) -> Column:
    """round(100 * col / sum(col) over (), scale) on aggregated rows."""
    return pct(F.col(col), F.sum(col).over(_all()), scale)


# --------------------------------------------------------------------------- #

def r01_baseline(v: DataFrame) -> DataFrame:
    return v.agg(
        F.count(F.lit(1)).alias("respondents"),
        F.sum("total_expenses").cast("long").alias("total_spend"),
        mean2("total_expenses").alias("avg_total_expenses"),
        median_disc("total_expenses").alias("median_total_expenses"),
        F.min("total_expenses").cast("long").alias("min_total_expenses"),
        F.max("total_expenses").cast("long").alias("max_total_expenses"),
        mean2("allowance").alias("avg_allowance"),
        F.sum("allowance").cast("long").alias("total_allowance"),
        agg_ratio2().alias("aggregate_utilisation_pct"),
        mean_ratio2().alias("mean_of_ratios_pct"),
        median_disc("budget_usage_pct").alias("median_of_ratios_pct"),
        mean2("overspend_amount").alias("avg_overspend"),
        F.min("overspend_amount").cast("long").alias("min_overspend"),
        F.max("overspend_amount").cast("long").alias("max_overspend"),
        count_if(F.col("is_overspending")).alias("overspending_students"),
        count_if(~F.col("is_overspending")).alias("saving_students"),
    )


def r02_by_degree(v: DataFrame) -> DataFrame:
    g = v.groupBy("degree").agg(
        students(),
        F.sum("total_expenses").cast("long").alias("total_spend"),
        mean2("total_expenses").alias("avg_total_expenses"),
        median_disc("total_expenses").alias("median_total_expenses"),
        mean2("allowance").alias("avg_allowance"),
        mean_ratio2().alias("mean_of_ratios_pct"),
        agg_ratio2().alias("aggregate_utilisation_pct"),
        mean2("overspend_amount").alias("avg_overspend"),
    )
    return (g.withColumn("share_of_students_pct", share_of_all("students"))
            .select("degree", "students", "share_of_students_pct", "total_spend",
                    "avg_total_expenses", "median_total_expenses", "avg_allowance",
                    "mean_of_ratios_pct", "aggregate_utilisation_pct", "avg_overspend")
            .orderBy(F.desc("avg_total_expenses"), "degree"))


def r03_by_year(v: DataFrame) -> DataFrame:
    g = v.groupBy(F.col("year_of_study_ordinal").alias("year_ordinal"), "year_of_study").agg(
        students(),
        mean2("total_expenses").alias("avg_total_expenses"),
        median_disc("total_expenses").alias("median_total_expenses"),
        mean2("allowance").alias("avg_allowance"),
        mean_ratio2().alias("mean_of_ratios_pct"),
        agg_ratio2().alias("aggregate_utilisation_pct"),
    )
    return (g.withColumn("share_of_students_pct", share_of_all("students"))
            .select("year_ordinal", "year_of_study", "students", "share_of_students_pct",
                    "avg_total_expenses", "median_total_expenses", "avg_allowance",
                    "mean_of_ratios_pct", "aggregate_utilisation_pct")
            .orderBy("year_ordinal"))


def r04_degree_year(v: DataFrame) -> DataFrame:
    return (v.groupBy("degree", F.col("year_of_study_ordinal").alias("year_ordinal"), "year_of_study")
            .agg(students(),
                 mean2("total_expenses").alias("avg_total_expenses"),
                 median_disc("total_expenses").alias("median_total_expenses"),
                 mean2("allowance").alias("avg_allowance"))
            .withColumn("cell_too_small_to_interpret", F.col("students") < 5)
            .orderBy("degree", "year_ordinal"))


def r05_pivot(v: DataFrame, ordinals=(1, 2, 3, 4)) -> DataFrame:
    """Degree x year pivot as conditional aggregation (what ``pivot`` with fixed values expands to)."""
    o = F.col("year_of_study_ordinal")
    t = F.col("total_expenses")
    means = [round_half_up_ratio(F.sum(F.when(o == i, t)), F.count(F.when(o == i, t)), 2)
             .alias(f"yr{i}_avg_expenses") for i in ordinals]
    counts = [count_if(o == i).alias(f"yr{i}_students") for i in ordinals]
    return (v.groupBy("degree").agg(students(), *means, *counts)
            .orderBy(F.desc("students"), "degree"))


def r06_payment_mix(v: DataFrame) -> DataFrame:
    g = v.groupBy("preferred_payment").agg(
        students(),
        F.sum("total_expenses").cast("long").alias("_spend"),
        mean2("total_expenses").alias("avg_total_expenses"),
        median_disc("total_expenses").alias("median_total_expenses"),
        mean_ratio2().alias("mean_of_ratios_pct"),
        agg_ratio2().alias("aggregate_utilisation_pct"),
        count_if(F.col("track_digitally") == "Yes").alias("track_digitally_yes"),
        count_if(F.col("track_digitally") == "No").alias("track_digitally_no"),
    )
    return (g.withColumn("share_of_students_pct", share_of_all("students"))
            .withColumn("share_of_total_spend_pct", share_of_all("_spend"))
            .select("preferred_payment", "students", "share_of_students_pct",
                    "share_of_total_spend_pct", "avg_total_expenses", "median_total_expenses",
                    "mean_of_ratios_pct", "aggregate_utilisation_pct",
                    "track_digitally_yes", "track_digitally_no")
            .orderBy(F.desc("students"), "preferred_payment"))


def r07_top_apps(v: DataFrame) -> DataFrame:
    """Apps among UPI payers naming one; denominators by a window over the aggregated rows (one scan)."""
    g = (v.filter(F.col("pays_by_upi") & F.col("names_a_upi_app"))
         .groupBy("upi_app")
         .agg(students(), F.sum("total_expenses").cast("long").alias("_spend"),
              mean2("total_expenses").alias("avg_total_expenses")))
    return (g.withColumn("share_of_upi_payers_pct", share_of_all("students"))
            .withColumn("share_of_upi_spend_pct", share_of_all("_spend"))
            .select("upi_app", "students", "share_of_upi_payers_pct", "avg_total_expenses",
                    "share_of_upi_spend_pct")
            .orderBy(F.desc("students"), "upi_app"))


def r08_upi_integrity(v: DataFrame) -> DataFrame:
    upi, app = F.col("pays_by_upi"), F.col("names_a_upi_app")
    return v.agg(
        F.count(F.lit(1)).alias("respondents"),
        count_if(upi).alias("upi_payers"),
        count_if(upi & app).alias("upi_payers_naming_an_app"),
        count_if(upi & ~app).alias("upi_payers_with_no_app"),
        count_if(~upi & app).alias("non_upi_payers_naming_an_app"),
        count_if(app).alias("total_naming_an_app"),
    )


def r09_app_reach(v: DataFrame) -> DataFrame:
    g = v.groupBy("upi_app").agg(F.count(F.lit(1)).alias("respondents"),
                                 count_if(F.col("pays_by_upi")).alias("of_which_pay_by_upi"))
    return (g.withColumn("share_of_all_respondents_pct", share_of_all("respondents"))
            .withColumn("pct_of_mentions_that_pay_by_upi", pct(F.col("of_which_pay_by_upi"), F.col("respondents")))
            .select("upi_app", "respondents", "share_of_all_respondents_pct",
                    "of_which_pay_by_upi", "pct_of_mentions_that_pay_by_upi")
            .orderBy(F.desc("respondents"), "upi_app"))


def r10_accommodation(v: DataFrame) -> DataFrame:
    g = v.groupBy("accommodation").agg(
        students(),
        F.sum("total_expenses").cast("long").alias("total_spend"),
        mean2("total_expenses").alias("avg_total_expenses"),
        median_disc("total_expenses").alias("median_total_expenses"),
        mean2("allowance").alias("avg_allowance"),
        agg_ratio2().alias("aggregate_utilisation_pct"),
        mean_ratio2().alias("mean_of_ratios_pct"),
        mean2("overspend_amount").alias("avg_deficit"),
        F.min("overspend_amount").cast("long").alias("best_case_deficit"),
        F.max("overspend_amount").cast("long").alias("worst_case_deficit"),
        count_if(F.col("is_overspending")).alias("overspending_students"),
    )
    return (g.withColumn("share_of_students_pct", share_of_all("students"))
            .select("accommodation", "students", "share_of_students_pct", "total_spend",
                    "avg_total_expenses", "median_total_expenses", "avg_allowance",
                    "aggregate_utilisation_pct", "mean_of_ratios_pct", "avg_deficit",
                    "best_case_deficit", "worst_case_deficit", "overspending_students")
            .orderBy(F.desc("avg_total_expenses"), "accommodation"))


def r11_head_to_head(v: DataFrame, left: str = "Hostel", right: str = "Day Scholar",
                     column: str = "accommodation") -> DataFrame:
    """Two groups side by side with % deltas, in ONE conditional aggregation.

    A missing side gives NULL means and deltas, as the reference's full outer
    join of two one-row aggregates does; no join is planned.
    """
    def side(value: str, p: str) -> list[Column]:
        m = F.col(column) == value
        return [count_if(m).alias(f"{p}_n"),
                F.sum(F.when(m, F.col("total_expenses"))).cast("decimal(38,0)").alias(f"{p}_t"),
                F.sum(F.when(m, F.col("allowance"))).cast("decimal(38,0)").alias(f"{p}_a"),
                F.sum(F.when(m, F.col("overspend_amount"))).cast("decimal(38,0)").alias(f"{p}_o")]

    a = v.agg(*side(left, "h"), *side(right, "d"))
    c = F.col
    return a.select(
        c("h_n").alias("hostel_students"),
        c("d_n").alias("day_scholar_students"),
        round_half_up_ratio(c("h_t"), c("h_n"), 2).alias("hostel_avg_spend"),
        round_half_up_ratio(c("d_t"), c("d_n"), 2).alias("day_scholar_avg_spend"),
        round_half_up_ratio((c("h_t") * c("d_n") - c("d_t") * c("h_n")) * 100,
                            c("h_n") * c("d_t"), 1).alias("spend_delta_pct"),
        round_half_up_ratio(c("h_a"), c("h_n"), 2).alias("hostel_avg_allowance"),
        round_half_up_ratio(c("d_a"), c("d_n"), 2).alias("day_scholar_avg_allowance"),
        round_half_up_ratio((c("h_a") * c("d_n") - c("d_a") * c("h_n")) * 100,
                            c("h_n") * c("d_a"), 1).alias("allowance_delta_pct"),
        round_half_up_ratio(c("h_t") * 100, c("h_a"), 2).alias("hostel_aggregate_utilisation_pct"),
        round_half_up_ratio(c("d_t") * 100, c("d_a"), 2).alias("day_scholar_aggregate_utilisation_pct"),
        round_half_up_ratio((c("h_t") * c("d_a") - c("d_t") * c("h_a")) * 100,
                            c("d_t") * c("h_a"), 1).alias("utilisation_delta_pct"),
        round_half_up_ratio(c("h_o"), c("h_n"), 2).alias("hostel_avg_deficit"),
        round_half_up_ratio(c("d_o"), c("d_n"), 2).alias("day_scholar_avg_deficit"),
    )


def _stack(df: DataFrame, rows: list[tuple[str, list[str]]], names: list[str], keep=()) -> DataFrame:
    """Turn side-by-side aggregate columns into one row per label (few rows)."""
    parts = ", ".join(
        ", ".join([f"'{label}'"] + [f"`{c}`" for c in cols]) for label, cols in rows)
    expr = f"stack({len(rows)}, {parts}) as ({', '.join(names)})"
    return df.selectExpr(*[f"`{k}`" for k in keep], expr)


def r12_mix(v: DataFrame) -> DataFrame:
    """Spend mix per accommodation: aggregate per group first, then stack the 4 areas."""
    g = v.groupBy("accommodation").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_expenses").cast("long").alias("tot"),
        F.count("total_expenses").alias("ntot"),
        *[F.sum(c).cast("long").alias(f"s_{c}") for _, c in AREAS],
        *[F.count(c).alias(f"n_{c}") for _, c in AREAS],
    )
    s = _stack(g, [(a, [f"s_{c}", f"n_{c}"]) for a, c in AREAS], ["area", "amt", "cnt"],
               keep=("accommodation", "tot", "ntot"))
    grp = Window.partitionBy("accommodation")  # partitions of at most 4 aggregated rows
    return (s.select(
        "accommodation", "area",
        round_half_up_ratio(F.col("amt"), F.col("cnt"), 2).alias("avg_per_student"),
        pct(F.col("amt"), F.sum("amt").over(grp)).alias("share_of_group_spend_pct"),
        round_half_up_ratio(F.col("amt").cast("decimal(38,0)") * F.col("ntot") * 100,
                            F.col("cnt").cast("decimal(38,0)") * F.col("tot"), 1).alias("share_of_own_bill_pct"),
    ).orderBy("accommodation", F.desc("avg_per_student")))


def r13_areas(v: DataFrame) -> DataFrame:
    """The 4 areas ranked: one global aggregation of 4 x 7 measures, stacked into 4 rows."""
    aggs = []
    for _, c in AREAS:
        aggs += [F.count(F.lit(1)).alias(f"r_{c}"), F.sum(c).cast("long").alias(f"s_{c}"),
                 F.count(c).alias(f"n_{c}"), median_disc(c).alias(f"m_{c}"),
                 F.min(c).cast("long").alias(f"lo_{c}"), F.max(c).cast("long").alias(f"hi_{c}"),
                 F.count_distinct(c).alias(f"d_{c}")]
    g = v.agg(*aggs)
    s = _stack(g, [(a, [f"r_{c}", f"s_{c}", f"n_{c}", f"m_{c}", f"lo_{c}", f"hi_{c}", f"d_{c}"])
                   for a, c in AREAS],
               ["area", "respondents", "total_spend", "cnt", "median_per_student",
                "min_amount", "max_amount", "distinct_amounts"])
    return (s.select(
        "area", F.col("respondents").cast("long").alias("respondents"),
        F.col("total_spend").cast("long").alias("total_spend"),
        share_of_all("total_spend").alias("share_of_total_spend_pct"),
        round_half_up_ratio(F.col("total_spend"), F.col("cnt"), 2).alias("avg_per_student"),
        F.col("median_per_student").cast("double").alias("median_per_student"),
        F.col("min_amount").cast("long").alias("min_amount"),
        F.col("max_amount").cast("long").alias("max_amount"),
        F.col("distinct_amounts").cast("long").alias("distinct_amounts"),
    ).orderBy(F.desc("total_spend"), "area"))


def _at_ceiling(c: str) -> Column:
    return F.col(c) == CEILING


def r14_ceiling_rows(v: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    any_c = _at_ceiling("academic_expenses") | _at_ceiling("food_expenses") \
        | _at_ceiling("transport_expenses") | _at_ceiling("other_expenses")
    return v.agg(
        n.alias("respondents"),
        pct(count_if(_at_ceiling("academic_expenses")), n).alias("academic_at_ceiling_pct"),
        pct(count_if(_at_ceiling("food_expenses")), n).alias("food_at_ceiling_pct"),
        pct(count_if(_at_ceiling("transport_expenses")), n).alias("transport_at_ceiling_pct"),
        pct(count_if(_at_ceiling("other_expenses")), n).alias("other_at_ceiling_pct"),
        count_if(any_c).alias("rows_touching_the_ceiling"),
        pct(count_if(any_c), n).alias("rows_touching_ceiling_pct"),
    )


def _row_max_and_ties(v: DataFrame) -> DataFrame:
    """Per response: the largest area amount and how many areas share it (row-local)."""
    m = F.greatest(*[F.col(c) for _, c in AREAS])
    ties = sum((F.when(F.col(c) == m, 1).otherwise(0) for _, c in AREAS), F.lit(0))
    return v.select(*[F.col(c) for _, c in AREAS], m.alias("row_max"), ties.alias("areas_tied"))


def r15_top_area(v: DataFrame) -> DataFrame:
    """Each response's top area(s), ties kept; one pass, no shuffle by response id."""
    t = _row_max_and_ties(v)
    aggs = []
    for _, c in AREAS:
        top = F.col(c) == F.col("row_max")
        aggs += [count_if(top).alias(f"n_{c}"),
                 count_if(top & (F.col("areas_tied") == 1)).alias(f"u_{c}"),
                 F.max(F.when(top, F.col("areas_tied"))).alias(f"w_{c}")]
    g = t.agg(*aggs)
    s = _stack(g, [(a, [f"n_{c}", f"u_{c}", f"w_{c}"]) for a, c in AREAS],
               ["top_area", "students_naming_it_top", "students_with_unique_top", "worst_case_tie_size"])
    s = s.filter(F.col("students_naming_it_top") > 0)
    return (s.select(
        "top_area",
        F.col("students_naming_it_top").cast("long").alias("students_naming_it_top"),
        F.col("students_with_unique_top").cast("long").alias("students_with_unique_top"),
        share_of_all("students_naming_it_top").alias("share_of_students_pct"),
        F.col("worst_case_tie_size").cast("long").alias("worst_case_tie_size"),
    ).orderBy(F.desc("students_naming_it_top"), "top_area"))


def _spending(v: DataFrame) -> DataFrame:
    """Long form (response, area, amount): the four expense columns unpivoted."""
    return v.select("student_id", *[F.col(c).alias(a) for a, c in AREAS]).unpivot(
        "student_id", [a for a, _ in AREAS], "area", "amount")


def r15_rank_join(v: DataFrame) -> DataFrame:
    """R15, literal form: rank areas within each response, keep rank 1, count ties, join back.

    Shuffles the long form by the (unique, unskewed) response id; ``r15_top_area``
    computes the same result row-wise without that shuffle.
    """
    w = Window.partitionBy("student_id").orderBy(F.desc("amount"))
    top = _spending(v).withColumn("area_rank", F.rank().over(w)).filter(F.col("area_rank") == 1) \
        .select("student_id", "area")
    ties = top.groupBy("student_id").agg(F.count(F.lit(1)).alias("areas_tied"))
    g = top.join(ties, "student_id").groupBy(F.col("area").alias("top_area")).agg(
        F.count(F.lit(1)).alias("students_naming_it_top"),
        count_if(F.col("areas_tied") == 1).alias("students_with_unique_top"),
        F.max("areas_tied").cast("long").alias("worst_case_tie_size"))
    return (g.withColumn("share_of_students_pct", share_of_all("students_naming_it_top"))
            .select("top_area", "students_naming_it_top", "students_with_unique_top",
                    "share_of_students_pct", "worst_case_tie_size")
            .orderBy(F.desc("students_naming_it_top"), "top_area"))


def r16_window(v: DataFrame) -> DataFrame:
    """R16, literal form: ``max(amount) over (partition by response)`` on the long form."""
    w = Window.partitionBy("student_id")
    per = (_spending(v).withColumn("row_max", F.max("amount").over(w))
           .groupBy("student_id").agg(count_if(F.col("amount") == F.col("row_max")).alias("areas_tied")))
    g = per.groupBy(F.col("areas_tied").cast("long").alias("categories_tied_for_largest")).agg(students())
    return (g.withColumn("share_of_students_pct", share_of_all("students"))
            .orderBy("categories_tied_for_largest"))


def r16_ties(v: DataFrame) -> DataFrame:
    """Histogram of how many areas tie for a response's largest amount."""
    g = (_row_max_and_ties(v).groupBy(F.col("areas_tied").cast("long").alias("categories_tied_for_largest"))
         .agg(students()))
    return (g.withColumn("share_of_students_pct", share_of_all("students"))
            .orderBy("categories_tied_for_largest"))


def r17_focus(v: DataFrame) -> DataFrame:
    g = v.groupBy("study_focus").agg(
        students(),
        mean2("total_expenses").alias("avg_total_expenses"),
        median_disc("total_expenses").alias("median_total_expenses"),
        mean2("academic_expenses").alias("avg_academic_expenses"),
        agg_ratio2().alias("aggregate_utilisation_pct"),
    )
    return (g.withColumn("share_of_students_pct", share_of_all("students"))
            .select("study_focus", "students", "share_of_students_pct", "avg_total_expenses",
                    "median_total_expenses", "avg_academic_expenses", "aggregate_utilisation_pct")
            .orderBy(F.desc("avg_total_expenses"), "study_focus"))


def r18_verify(v: DataFrame, expected: dict | None = None) -> DataFrame:
    """Verification row; the expected count and ranges are parameters (seed values by default)."""
    e = dict(spec.SEED_EXPECTATIONS, **(expected or {}))
    u_lo, u_hi = e["usage_range"]
    s_lo, s_hi = e["savings_range"]
    mism = (F.col("total_expenses") != F.col("food_expenses") + F.col("transport_expenses")
            + F.col("academic_expenses") + F.col("other_expenses")) \
        | (F.col("savings") != F.col("allowance") - F.col("total_expenses"))
    a = v.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("budget_usage_pct").alias("min_usage_pct"),
        F.max("budget_usage_pct").alias("max_usage_pct"),
        F.min("savings").cast("long").alias("min_savings"),
        F.max("savings").cast("long").alias("max_savings"),
        count_if(F.col("is_overspending")).alias("overspending_students"),
        count_if(~F.col("is_overspending")).alias("savers"),
        count_if(mism).alias("generated_column_mismatches"),
    )
    return a.select(
        "row_count",
        (F.col("row_count") == e["row_count"]).alias("row_count_ok"),
        "min_usage_pct", "max_usage_pct",
        ((F.col("min_usage_pct") == u_lo) & (F.col("max_usage_pct") == u_hi)).alias("usage_range_ok"),
        "min_savings", "max_savings",
        ((F.col("min_savings") == s_lo) & (F.col("max_savings") == s_hi)).alias("savings_range_ok"),
        "overspending_students", "savers", "generated_column_mismatches",
    )


def r19_censored_cells(v: DataFrame) -> DataFrame:
    cens = sum((count_if(_at_ceiling(c)) for _, c in AREAS), F.lit(0))
    cells = F.count(F.lit(1)) * len(AREAS)
    return v.agg(cells.alias("expense_cells"), cens.alias("censored_cells"),
                 pct(cens, cells).alias("censored_cells_pct"))


def r20_coverage(v: DataFrame) -> DataFrame:
    a = v.agg(
        F.count(F.lit(1)).alias("respondents"),
        F.min("submitted_at").alias("first_response"),
        F.max("submitted_at").alias("last_response"),
        F.count_distinct("specialization").alias("distinct_specializations"),
        count_if(F.col("track_digitally") == "Yes").alias("track_digitally_yes"),
        count_if(F.col("budget_plan") == "Yes").alias("has_budget_plan"),
        count_if(F.col("work_internship") == "Yes").alias("in_work_or_internship"),
        count_if(F.col("background") == "Rural").alias("rural"),
        count_if(F.col("background") == "Urban").alias("urban"),
    )
    return a.select(
        "respondents", "first_response", "last_response",
        F.datediff(F.to_date("last_response"), F.to_date("first_response")).cast("long")
        .alias("collection_window_days"),
        "distinct_specializations", "track_digitally_yes", "has_budget_plan",
        "in_work_or_internship", "rural", "urban",
    )


REPORTS = {
    "r01_baseline": r01_baseline, "r02_by_degree": r02_by_degree, "r03_by_year": r03_by_year,
    "r04_degree_year": r04_degree_year, "r05_pivot": r05_pivot, "r06_payment_mix": r06_payment_mix,
    "r07_top_apps": r07_top_apps, "r08_upi_integrity": r08_upi_integrity,
    "r09_app_reach": r09_app_reach, "r10_accommodation": r10_accommodation,
    "r11_head_to_head": r11_head_to_head, "r12_mix": r12_mix, "r13_areas": r13_areas,
    "r14_ceiling_rows": r14_ceiling_rows, "r15_top_area": r15_top_area, "r15_rank_join": r15_rank_join,
    "r16_ties": r16_ties, "r16_window": r16_window,
    "r17_focus": r17_focus, "r18_verify": r18_verify, "r19_censored_cells": r19_censored_cells,
    "r20_coverage": r20_coverage,
}
