"""Independent DuckDB SQL for the correctness gate.

The oracle goes from the driver tables straight to bucket midpoints with CASE
(it never touches the label parser), builds the analysis view, and states each
report in SQL.  Rounding uses the same exact integer rule as the Spark side:
``round(n/d, s)`` = ``sign * ((2|n|10^s + |d|) div 2|d|) / 10^s`` (half away from
zero), computed in HUGEINT, so both engines produce identical doubles.
"""

from __future__ import annotations


def rhu(n: str, d: str, s: int) -> str:
    """SQL for round(n/d, s), half away from zero, exact; NULL when d is 0 or NULL."""
    p = 10 ** s
    nn = f"CAST(({n}) AS HUGEINT) * {p}"
    dd = f"CAST(({d}) AS HUGEINT)"
    return (f"(CASE WHEN {dd} = 0 THEN NULL ELSE "
            f"CAST((CASE WHEN ({nn} < 0) <> ({dd} < 0) THEN -1 ELSE 1 END) * "
            f"((2 * abs({nn}) + abs({dd})) // (2 * abs({dd}))) AS DOUBLE) / {p}.0 END)")


def pct(n: str, d: str, s: int = 1) -> str:
    return rhu(f"100 * CAST(({n}) AS HUGEINT)", d, s)


def mean2(c: str) -> str:
    return rhu(f"sum({c})", f"count({c})", 2)


MEAN_RATIO = rhu("sum(usage10)", "10 * count(usage10)", 2)
AGG_RATIO = rhu("100 * sum(total_expenses)", "sum(allowance)", 2)


def median(c: str) -> str:
    return f"CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY {c}) AS DOUBLE)"


def share(expr: str = "count(*)") -> str:
    return pct(expr, f"sum({expr}) OVER ()")


# Survey bound onto the driver tables (FIXTURES C1), plus the analysis view.
SURVEY_CTE = """
li AS (
  SELECT l_orderkey AS k,
    CAST(sum(CASE WHEN l_returnflag='A' THEN CAST(round(l_extendedprice*100) AS BIGINT) ELSE 0 END) AS BIGINT)//3000 AS a,
    CAST(sum(CASE WHEN l_returnflag='N' THEN CAST(round(l_extendedprice*100) AS BIGINT) ELSE 0 END) AS BIGINT)//3000 AS n,
    CAST(sum(CASE WHEN l_returnflag='R' THEN CAST(round(l_extendedprice*100) AS BIGINT) ELSE 0 END) AS BIGINT)//3000 AS r,
    CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS BIGINT)*25 AS q
  FROM lineitem GROUP BY 1),
amt AS (
  SELECT o.*, c.*, nt.n_name, nt.n_nationkey, rg.r_name, rg.r_regionkey,
    coalesce(a,0) AS a, coalesce(n,0) AS n, coalesce(r,0) AS r, coalesce(q,0) AS q,
    CAST(round(o_totalprice*100) AS BIGINT)//10000 AS al
  FROM orders o JOIN customer c ON o_custkey=c_custkey
  JOIN nation nt ON c_nationkey=n_nationkey JOIN region rg ON n_regionkey=r_regionkey
  LEFT JOIN li ON k=o_orderkey),
mid AS (
  SELECT *,
    CASE WHEN a<500 THEN 250 WHEN a<1000 THEN 750 WHEN a<2000 THEN 1500 WHEN a<3000 THEN 2500 WHEN a<4000 THEN 3500 WHEN a<=5000 THEN 4500 ELSE 6250 END AS food_expenses,
    CASE WHEN n<500 THEN 250 WHEN n<1000 THEN 750 WHEN n<2000 THEN 1500 WHEN n<3000 THEN 2500 WHEN n<4000 THEN 3500 WHEN n<=5000 THEN 4500 ELSE 6250 END AS transport_expenses,
    CASE WHEN r<500 THEN 250 WHEN r<1000 THEN 750 WHEN r<2000 THEN 1500 WHEN r<3000 THEN 2500 WHEN r<4000 THEN 3500 WHEN r<=5000 THEN 4500 ELSE 6250 END AS academic_expenses,
    CASE WHEN q<500 THEN 250 WHEN q<1000 THEN 750 WHEN q<2000 THEN 1500 WHEN q<3000 THEN 2500 WHEN q<4000 THEN 3500 WHEN q<=5000 THEN 4500 ELSE 6250 END AS other_expenses,
    CASE WHEN al<500 THEN 250 WHEN al<1500 THEN 1000 WHEN al<=3000 THEN 2250 ELSE 3750 END AS allowance,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'B.Com' WHEN 'AUTOMOBILE' THEN 'BE / B.Tech' WHEN 'FURNITURE' THEN 'BSc'
      WHEN 'HOUSEHOLD' THEN 'MBA' ELSE CASE WHEN o_custkey%2=0 THEN 'ME / M.Tech' ELSE 'Other' END END AS degree
  FROM amt),
sv AS (
  SELECT o_orderkey AS student_id, o_orderdate AS submitted_at, c_name AS student_name,
    CASE WHEN o_custkey%2=0 THEN 'Male' ELSE 'Female' END AS gender, degree,
    CASE WHEN degree='MBA' AND o_orderpriority='3-MEDIUM' THEN '2nd Year'
         WHEN o_orderpriority IN ('1-URGENT','5-LOW') THEN '1st Year' WHEN o_orderpriority='2-HIGH' THEN '2nd Year'
         WHEN o_orderpriority='3-MEDIUM' THEN '3rd Year' ELSE '4th Year' END AS year_of_study,
    CASE o_orderstatus WHEN 'F' THEN 'Hostel' WHEN 'O' THEN 'Day Scholar' ELSE 'PG' END AS accommodation,
    CASE WHEN n_nationkey%2=0 THEN 'Rural' ELSE 'Urban' END AS background,
    CASE WHEN (o_orderkey//7)%5<2 THEN 'Yes' ELSE 'No' END AS work_internship,
    CASE WHEN o_orderkey%50=0 THEN n_name||'; '||r_name ELSE n_name END AS specialization,
    food_expenses, transport_expenses, academic_expenses, other_expenses,
    food_expenses+transport_expenses+academic_expenses+other_expenses AS total_expenses, allowance,
    allowance-(food_expenses+transport_expenses+academic_expenses+other_expenses) AS savings,
    CASE WHEN o_orderkey%20<8 THEN 'UPI' WHEN o_orderkey%20<13 THEN 'Cash' WHEN o_orderkey%20<17 THEN 'Debit/Credit Card' ELSE 'Other' END AS preferred_payment,
    CASE WHEN o_orderkey%11=0 THEN 'Not Applicable' ELSE
      CASE (o_orderkey//20)%8 WHEN 0 THEN 'GPay' WHEN 1 THEN 'GPay' WHEN 2 THEN 'PhonePe' WHEN 3 THEN 'SBI Pay'
        WHEN 4 THEN 'Amazon Pay' WHEN 5 THEN 'BHIM UPI' WHEN 6 THEN 'Airtel Thanks App' ELSE 'Other' END END AS upi_app,
    CASE WHEN (o_orderkey//3)%3=0 THEN 'No' ELSE 'Yes' END AS track_digitally,
    CASE WHEN o_orderkey%7<4 THEN 'Yes' ELSE 'No' END AS budget_plan,
    CASE r_regionkey WHEN 0 THEN 'Online Learning Platforms' WHEN 1 THEN 'Books & Study Materials'
      WHEN 2 THEN 'Internet & Data Packs' WHEN 3 THEN 'Software Tools' ELSE 'Other' END AS study_focus
  FROM mid),
su AS (
  SELECT *, (total_expenses*1000)//allowance
    + CASE WHEN 2*((total_expenses*1000)%allowance) > allowance
             OR (2*((total_expenses*1000)%allowance) = allowance AND ((total_expenses*1000)//allowance)%2 = 1)
           THEN 1 ELSE 0 END AS usage10
  FROM sv),
v AS (
  SELECT CAST(student_id AS BIGINT) AS student_id, CAST(submitted_at AS TIMESTAMP) AS submitted_at,
    student_name, gender, degree, year_of_study, accommodation, background, work_internship,
    specialization, preferred_payment, upi_app, track_digitally, budget_plan, study_focus,
    CAST(CASE year_of_study WHEN '1st Year' THEN 1 WHEN '2nd Year' THEN 2 WHEN '3rd Year' THEN 3
      WHEN '4th Year' THEN 4 END AS INTEGER) AS year_of_study_ordinal,
    CAST(food_expenses AS BIGINT) AS food_expenses, CAST(transport_expenses AS BIGINT) AS transport_expenses,
    CAST(academic_expenses AS BIGINT) AS academic_expenses, CAST(other_expenses AS BIGINT) AS other_expenses,
    CAST(total_expenses AS BIGINT) AS total_expenses, CAST(allowance AS BIGINT) AS allowance,
    CAST(savings AS BIGINT) AS savings, CAST(usage10 AS DOUBLE) / 10.0 AS budget_usage_pct,
    CAST(total_expenses - allowance AS BIGINT) AS overspend_amount,
    total_expenses > allowance AS is_overspending,
    preferred_payment = 'UPI' AS pays_by_upi,
    upi_app <> 'Not Applicable' AS names_a_upi_app,
    CAST(usage10 AS BIGINT) AS usage10
  FROM su)
"""

VIEW_SELECT = """SELECT student_id, submitted_at, student_name, gender, degree, year_of_study,
  accommodation, background, work_internship, specialization, preferred_payment, upi_app,
  track_digitally, budget_plan, study_focus, year_of_study_ordinal, food_expenses,
  transport_expenses, academic_expenses, other_expenses, total_expenses, allowance, savings,
  budget_usage_pct, overspend_amount, is_overspending, pays_by_upi, names_a_upi_app FROM v"""


def with_view(body: str) -> str:
    return "WITH " + SURVEY_CTE.strip() + "\n" + body


AREAS = (("Food", "food_expenses"), ("Transport", "transport_expenses"),
         ("Academic", "academic_expenses"), ("Other", "other_expenses"))
UNPIVOT = " UNION ALL ".join(
    f"SELECT student_id, accommodation, total_expenses, '{a}' AS area, {c} AS amount FROM v"
    for a, c in AREAS)


def report_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["analysis_view"] = with_view(VIEW_SELECT)
    q["r01_baseline"] = with_view(f"""SELECT count(*) AS respondents,
  CAST(sum(total_expenses) AS BIGINT) AS total_spend,
  {mean2('total_expenses')} AS avg_total_expenses, {median('total_expenses')} AS median_total_expenses,
  CAST(min(total_expenses) AS BIGINT) AS min_total_expenses, CAST(max(total_expenses) AS BIGINT) AS max_total_expenses,
  {mean2('allowance')} AS avg_allowance, CAST(sum(allowance) AS BIGINT) AS total_allowance,
  {AGG_RATIO} AS aggregate_utilisation_pct, {MEAN_RATIO} AS mean_of_ratios_pct,
  {median('budget_usage_pct')} AS median_of_ratios_pct, {mean2('overspend_amount')} AS avg_overspend,
  CAST(min(overspend_amount) AS BIGINT) AS min_overspend, CAST(max(overspend_amount) AS BIGINT) AS max_overspend,
  count(*) FILTER (WHERE is_overspending) AS overspending_students,
  count(*) FILTER (WHERE NOT is_overspending) AS saving_students
FROM v""")
    q["r02_by_degree"] = with_view(f"""SELECT degree, count(*) AS students, {share()} AS share_of_students_pct,
  CAST(sum(total_expenses) AS BIGINT) AS total_spend, {mean2('total_expenses')} AS avg_total_expenses,
  {median('total_expenses')} AS median_total_expenses, {mean2('allowance')} AS avg_allowance,
  {MEAN_RATIO} AS mean_of_ratios_pct, {AGG_RATIO} AS aggregate_utilisation_pct,
  {mean2('overspend_amount')} AS avg_overspend
FROM v GROUP BY degree ORDER BY avg_total_expenses DESC, degree""")
    q["r03_by_year"] = with_view(f"""SELECT year_of_study_ordinal AS year_ordinal, year_of_study,
  count(*) AS students, {share()} AS share_of_students_pct, {mean2('total_expenses')} AS avg_total_expenses,
  {median('total_expenses')} AS median_total_expenses, {mean2('allowance')} AS avg_allowance,
  {MEAN_RATIO} AS mean_of_ratios_pct, {AGG_RATIO} AS aggregate_utilisation_pct
FROM v GROUP BY year_of_study_ordinal, year_of_study ORDER BY year_of_study_ordinal""")
    q["r04_degree_year"] = with_view(f"""SELECT degree, year_of_study_ordinal AS year_ordinal, year_of_study,
  count(*) AS students, {mean2('total_expenses')} AS avg_total_expenses,
  {median('total_expenses')} AS median_total_expenses, {mean2('allowance')} AS avg_allowance,
  (count(*) < 5) AS cell_too_small_to_interpret
FROM v GROUP BY degree, year_of_study_ordinal, year_of_study ORDER BY degree, year_ordinal""")
    yr_means = ",\n  ".join(
        rhu(f"sum(total_expenses) FILTER (WHERE year_of_study_ordinal = {i})",
            f"count(total_expenses) FILTER (WHERE year_of_study_ordinal = {i})", 2)
        + f" AS yr{i}_avg_expenses" for i in (1, 2, 3, 4))
    yr_counts = ",\n  ".join(
        f"count(*) FILTER (WHERE year_of_study_ordinal = {i}) AS yr{i}_students" for i in (1, 2, 3, 4))
    q["r05_pivot"] = with_view(f"""SELECT degree, count(*) AS students,
  {yr_means},
  {yr_counts}
FROM v GROUP BY degree ORDER BY students DESC, degree""")
    q["r06_payment_mix"] = with_view(f"""SELECT preferred_payment, count(*) AS students,
  {share()} AS share_of_students_pct, {share('sum(total_expenses)')} AS share_of_total_spend_pct,
  {mean2('total_expenses')} AS avg_total_expenses, {median('total_expenses')} AS median_total_expenses,
  {MEAN_RATIO} AS mean_of_ratios_pct, {AGG_RATIO} AS aggregate_utilisation_pct,
  count(*) FILTER (WHERE track_digitally = 'Yes') AS track_digitally_yes,
  count(*) FILTER (WHERE track_digitally = 'No') AS track_digitally_no
FROM v GROUP BY preferred_payment ORDER BY students DESC, preferred_payment""")
    q["r07_top_apps"] = with_view(f""", upi_payers AS (SELECT * FROM v WHERE pays_by_upi AND names_a_upi_app)
SELECT upi_app, count(*) AS students,
  {pct('count(*)', '(SELECT count(*) FROM upi_payers)')} AS share_of_upi_payers_pct,
  {mean2('total_expenses')} AS avg_total_expenses,
  {pct('sum(total_expenses)', '(SELECT sum(total_expenses) FROM upi_payers)')} AS share_of_upi_spend_pct
FROM upi_payers GROUP BY upi_app ORDER BY students DESC, upi_app""")
    q["r08_upi_integrity"] = with_view("""SELECT count(*) AS respondents,
  count(*) FILTER (WHERE pays_by_upi) AS upi_payers,
  count(*) FILTER (WHERE pays_by_upi AND names_a_upi_app) AS upi_payers_naming_an_app,
  count(*) FILTER (WHERE pays_by_upi AND NOT names_a_upi_app) AS upi_payers_with_no_app,
  count(*) FILTER (WHERE NOT pays_by_upi AND names_a_upi_app) AS non_upi_payers_naming_an_app,
  count(*) FILTER (WHERE names_a_upi_app) AS total_naming_an_app
FROM v""")
    q["r09_app_reach"] = with_view(f"""SELECT upi_app, count(*) AS respondents,
  {share()} AS share_of_all_respondents_pct,
  count(*) FILTER (WHERE pays_by_upi) AS of_which_pay_by_upi,
  {pct('count(*) FILTER (WHERE pays_by_upi)', 'count(*)')} AS pct_of_mentions_that_pay_by_upi
FROM v GROUP BY upi_app ORDER BY respondents DESC, upi_app""")
    q["r10_accommodation"] = with_view(f"""SELECT accommodation, count(*) AS students,
  {share()} AS share_of_students_pct, CAST(sum(total_expenses) AS BIGINT) AS total_spend,
  {mean2('total_expenses')} AS avg_total_expenses, {median('total_expenses')} AS median_total_expenses,
  {mean2('allowance')} AS avg_allowance, {AGG_RATIO} AS aggregate_utilisation_pct,
  {MEAN_RATIO} AS mean_of_ratios_pct, {mean2('overspend_amount')} AS avg_deficit,
  CAST(min(overspend_amount) AS BIGINT) AS best_case_deficit,
  CAST(max(overspend_amount) AS BIGINT) AS worst_case_deficit,
  count(*) FILTER (WHERE is_overspending) AS overspending_students
FROM v GROUP BY accommodation ORDER BY avg_total_expenses DESC, accommodation""")
    side = """SELECT count(*) AS n, sum(total_expenses) AS t, sum(allowance) AS a, sum(overspend_amount) AS o
    FROM v WHERE accommodation = '{0}'"""
    q["r11_head_to_head"] = with_view(f""", h AS ({side.format('Hostel')}), d AS ({side.format('Day Scholar')})
SELECT h.n AS hostel_students, d.n AS day_scholar_students,
  {rhu('h.t', 'h.n', 2)} AS hostel_avg_spend, {rhu('d.t', 'd.n', 2)} AS day_scholar_avg_spend,
  {rhu('100 * (CAST(h.t AS HUGEINT) * d.n - CAST(d.t AS HUGEINT) * h.n)', 'CAST(h.n AS HUGEINT) * d.t', 1)} AS spend_delta_pct,
  {rhu('h.a', 'h.n', 2)} AS hostel_avg_allowance, {rhu('d.a', 'd.n', 2)} AS day_scholar_avg_allowance,
  {rhu('100 * (CAST(h.a AS HUGEINT) * d.n - CAST(d.a AS HUGEINT) * h.n)', 'CAST(h.n AS HUGEINT) * d.a', 1)} AS allowance_delta_pct,
  {rhu('100 * h.t', 'h.a', 2)} AS hostel_aggregate_utilisation_pct,
  {rhu('100 * d.t', 'd.a', 2)} AS day_scholar_aggregate_utilisation_pct,
  {rhu('100 * (CAST(h.t AS HUGEINT) * d.a - CAST(d.t AS HUGEINT) * h.a)', 'CAST(d.t AS HUGEINT) * h.a', 1)} AS utilisation_delta_pct,
  {rhu('h.o', 'h.n', 2)} AS hostel_avg_deficit, {rhu('d.o', 'd.n', 2)} AS day_scholar_avg_deficit
FROM h FULL OUTER JOIN d ON true""")
    q["r12_mix"] = with_view(f""", spending AS ({UNPIVOT})
SELECT accommodation, area, {mean2('amount')} AS avg_per_student,
  {pct('sum(amount)', 'sum(sum(amount)) OVER (PARTITION BY accommodation)')} AS share_of_group_spend_pct,
  {rhu('100 * CAST(sum(amount) AS HUGEINT) * count(total_expenses)', 'CAST(count(amount) AS HUGEINT) * sum(total_expenses)', 1)} AS share_of_own_bill_pct
FROM spending GROUP BY accommodation, area ORDER BY accommodation, avg_per_student DESC""")
    q["r13_areas"] = with_view(f""", spending AS ({UNPIVOT})
SELECT area, count(*) AS respondents, CAST(sum(amount) AS BIGINT) AS total_spend,
  {share('sum(amount)')} AS share_of_total_spend_pct, {mean2('amount')} AS avg_per_student,
  {median('amount')} AS median_per_student, CAST(min(amount) AS BIGINT) AS min_amount,
  CAST(max(amount) AS BIGINT) AS max_amount, count(DISTINCT amount) AS distinct_amounts
FROM spending GROUP BY area ORDER BY total_spend DESC, area""")
    ceil = ["academic_expenses", "food_expenses", "transport_expenses", "other_expenses"]
    any_c = " OR ".join(f"{c} = 6250" for c in ceil)
    q["r14_ceiling_rows"] = with_view(f"""SELECT count(*) AS respondents,
  {pct('count(*) FILTER (WHERE academic_expenses = 6250)', 'count(*)')} AS academic_at_ceiling_pct,
  {pct('count(*) FILTER (WHERE food_expenses = 6250)', 'count(*)')} AS food_at_ceiling_pct,
  {pct('count(*) FILTER (WHERE transport_expenses = 6250)', 'count(*)')} AS transport_at_ceiling_pct,
  {pct('count(*) FILTER (WHERE other_expenses = 6250)', 'count(*)')} AS other_at_ceiling_pct,
  count(*) FILTER (WHERE {any_c}) AS rows_touching_the_ceiling,
  {pct(f'count(*) FILTER (WHERE {any_c})', 'count(*)')} AS rows_touching_ceiling_pct
FROM v""")
    q["r15_top_area"] = with_view(f""", spending AS ({UNPIVOT}),
ranked AS (SELECT student_id, area, amount,
  rank() OVER (PARTITION BY student_id ORDER BY amount DESC) AS area_rank FROM spending),
top_areas AS (SELECT student_id, area FROM ranked WHERE area_rank = 1),
tie_counts AS (SELECT student_id, count(*) AS areas_tied FROM top_areas GROUP BY student_id)
SELECT t.area AS top_area, count(*) AS students_naming_it_top,
  count(*) FILTER (WHERE tc.areas_tied = 1) AS students_with_unique_top,
  {share()} AS share_of_students_pct, CAST(max(tc.areas_tied) AS BIGINT) AS worst_case_tie_size
FROM top_areas AS t JOIN tie_counts AS tc ON tc.student_id = t.student_id
GROUP BY t.area ORDER BY students_naming_it_top DESC, t.area""")
    q["r16_ties"] = with_view(f""", spending AS ({UNPIVOT}),
per_student AS (SELECT student_id, count(*) FILTER (WHERE amount = row_max) AS areas_tied
  FROM (SELECT student_id, amount, max(amount) OVER (PARTITION BY student_id) AS row_max FROM spending) x
  GROUP BY student_id)
SELECT CAST(areas_tied AS BIGINT) AS categories_tied_for_largest, count(*) AS students,
  {share()} AS share_of_students_pct
FROM per_student GROUP BY areas_tied ORDER BY areas_tied""")
    q["r15_rank_join"] = q["r15_top_area"]
    q["r16_window"] = q["r16_ties"]
    q["r17_focus"] = with_view(f"""SELECT study_focus, count(*) AS students, {share()} AS share_of_students_pct,
  {mean2('total_expenses')} AS avg_total_expenses, {median('total_expenses')} AS median_total_expenses,
  {mean2('academic_expenses')} AS avg_academic_expenses, {AGG_RATIO} AS aggregate_utilisation_pct
FROM v GROUP BY study_focus ORDER BY avg_total_expenses DESC, study_focus""")
    q["r18_verify"] = with_view("""SELECT count(*) AS row_count, count(*) = 213 AS row_count_ok,
  min(budget_usage_pct) AS min_usage_pct, max(budget_usage_pct) AS max_usage_pct,
  (min(budget_usage_pct) = 125.0 AND max(budget_usage_pct) = 8600.0) AS usage_range_ok,
  CAST(min(savings) AS BIGINT) AS min_savings, CAST(max(savings) AS BIGINT) AS max_savings,
  (min(savings) = -24000 AND max(savings) = -250) AS savings_range_ok,
  count(*) FILTER (WHERE is_overspending) AS overspending_students,
  count(*) FILTER (WHERE NOT is_overspending) AS savers,
  count(*) FILTER (WHERE total_expenses <> food_expenses + transport_expenses + academic_expenses + other_expenses
                      OR savings <> allowance - total_expenses) AS generated_column_mismatches
FROM v""")
    q["r19_censored_cells"] = with_view(f""", cells AS ({UNPIVOT})
SELECT count(*) AS expense_cells, count(*) FILTER (WHERE amount = 6250) AS censored_cells,
  {pct('count(*) FILTER (WHERE amount = 6250)', 'count(*)')} AS censored_cells_pct
FROM cells""")
    q["r20_coverage"] = with_view("""SELECT count(*) AS respondents, min(submitted_at) AS first_response,
  max(submitted_at) AS last_response,
  CAST(CAST(max(submitted_at) AS DATE) - CAST(min(submitted_at) AS DATE) AS BIGINT) AS collection_window_days,
  count(DISTINCT specialization) AS distinct_specializations,
  count(*) FILTER (WHERE track_digitally = 'Yes') AS track_digitally_yes,
  count(*) FILTER (WHERE budget_plan = 'Yes') AS has_budget_plan,
  count(*) FILTER (WHERE work_internship = 'Yes') AS in_work_or_internship,
  count(*) FILTER (WHERE background = 'Rural') AS rural,
  count(*) FILTER (WHERE background = 'Urban') AS urban
FROM v""")
    return q


# --------------------------------------------------------------------------- #
# Quality checks on the defect fixture (FIXTURES C3)
# --------------------------------------------------------------------------- #

DEFECTS_CTE = """,
d0 AS (
  SELECT student_id AS k, strftime(submitted_at + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS ts,
    student_name AS nm, gender, degree, year_of_study, accommodation, background, work_internship,
    specialization, CAST(food_expenses AS DOUBLE) AS food, CAST(transport_expenses AS DOUBLE) AS transport,
    CAST(academic_expenses AS DOUBLE) AS academic, CAST(other_expenses AS DOUBLE) AS other,
    CAST(total_expenses AS DOUBLE) AS total, CAST(allowance AS DOUBLE) AS allowance,
    CAST(savings AS DOUBLE) AS savings, usage10 / 10.0 AS usage, preferred_payment, upi_app,
    track_digitally, budget_plan, study_focus
  FROM su),
d1 AS (
  SELECT k,
    CASE WHEN k % 127 = 0 THEN 'not a date' WHEN k % 131 = 0 THEN '2999' || substr(ts, 5) ELSE ts END AS ts,
    CASE WHEN k % 79 = 0 THEN NULL WHEN k % 83 = 0 THEN '   ' ELSE nm END AS nm,
    gender, CASE WHEN k % 89 = 0 THEN 'Diploma' ELSE degree END AS degree, year_of_study,
    accommodation, background, work_internship, specialization,
    (CASE WHEN k % 97 = 0 THEN -food ELSE food END) + (CASE WHEN k % 113 = 0 THEN 0.5 ELSE 0 END) AS food,
    transport, academic, other,
    CASE WHEN k % 149 = 0 THEN NULL WHEN k % 107 = 0 THEN total + 10 ELSE total END AS total,
    CASE WHEN k % 109 = 0 THEN NULL ELSE allowance END AS allowance,
    CASE WHEN k % 103 = 0 THEN savings + 1 ELSE savings END AS savings,
    CASE WHEN k % 139 = 0 THEN 20000.0 ELSE usage END AS usage, preferred_payment, upi_app, track_digitally, budget_plan,
    CASE WHEN k % 151 = 0 THEN '' ELSE study_focus END AS study_focus
  FROM d0),
dd AS (SELECT * FROM d1 UNION ALL SELECT * FROM d1 WHERE k % 101 = 0),
tsp AS (SELECT *, try_strptime(ts, '%Y-%m-%d %H:%M:%S') AS tsv FROM dd)
"""

_DQ_TEXT = {"Timestamp": "ts", "Student Name": "nm", "Gender": "gender", "Degree": "degree",
            "Year of Study": "year_of_study", "Accommodation": "accommodation",
            "Preferred Payment": "preferred_payment"}
_DQ_MONEY = {"Food": "food", "Transport": "transport", "Academic": "academic", "Other": "other",
             "Allowance": "allowance", "Total Expenses": "total"}
_DQ_OPTIONAL = {"Specialization": "specialization", "Background": "background",
                "Work/Internship": "work_internship", "Track Digitally": "track_digitally",
                "Budget Plan": "budget_plan", "Study Focus": "study_focus", "UPI App": "upi_app"}
_DQ_DOMAINS = {
    "Accommodation": ("accommodation", ("Day Scholar", "Hostel", "PG")),
    "Background": ("background", ("Rural", "Urban")),
    "Budget Plan": ("budget_plan", ("Yes", "No")),
    "Degree": ("degree", ("B.Com", "BE / B.Tech", "BSc", "MBA", "ME / M.Tech", "Other")),
    "Gender": ("gender", ("Male", "Female")),
    "Preferred Payment": ("preferred_payment", ("UPI", "Cash", "Debit/Credit Card", "Other")),
    "Track Digitally": ("track_digitally", ("Yes", "No")),
    "UPI App": ("upi_app", ("GPay", "PhonePe", "SBI Pay", "Amazon Pay", "BHIM UPI",
                            "Airtel Thanks App", "Other", "Not Applicable")),
    "Work/Internship": ("work_internship", ("Yes", "No")),
    "Year of Study": ("year_of_study", ("1st Year", "2nd Year", "3rd Year", "4th Year")),
}
_ALL_COLS = ("ts, nm, gender, degree, year_of_study, accommodation, background, work_internship, "
             "specialization, food, transport, academic, other, total, allowance, savings, usage, "
             "preferred_payment, upi_app, track_digitally, budget_plan, study_focus")


def _res(name: str, category: str, severity: str, passed: str, offending: str, src: str = "dd") -> str:
    return (f"SELECT '{name}' AS name, '{category}' AS category, {severity} AS severity, "
            f"CAST({passed} AS BOOLEAN) AS passed, CAST({offending} AS BIGINT) AS offending FROM {src}")


def _blank(c: str) -> str:
    return f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')"


def quality_sql() -> dict[str, str]:
    g: dict[str, list[str]] = {}
    g["dq_row_count"] = [_res("row_count_not_empty", "completeness", "'CRITICAL'", "count(*) > 0", "0")]
    g["dq_columns"] = [_res("mandatory_columns_present", "completeness", "'CRITICAL'", "true", "0",
                            "(SELECT 1) t")]
    g["dq_no_nulls"] = [
        _res(f"no_nulls::{h}", "validity", "'CRITICAL'", f"count(*) FILTER (WHERE {_blank(c)}) = 0",
             f"count(*) FILTER (WHERE {_blank(c)})")
        for h, c in list(_DQ_TEXT.items()) + [(h, "(CASE WHEN k % 149 = 0 THEN 0 ELSE total END)" if c == "total" else c) for h, c in _DQ_MONEY.items()]]
    g["dq_populated"] = [
        _res(f"populated::{h}", "validity", "'WARNING'", f"count(*) FILTER (WHERE {_blank(c)}) = 0",
             f"count(*) FILTER (WHERE {_blank(c)})") for h, c in _DQ_OPTIONAL.items()]
    g["dq_money_numeric"] = [_res("money_numeric", "numeric", "'CRITICAL'", "count(*) FILTER (WHERE k % 149 = 0) = 0", "count(*) FILTER (WHERE k % 149 = 0)")]
    g["dq_non_negative"] = [
        _res(f"non_negative::{h}", "numeric", "'CRITICAL'", f"count(*) FILTER (WHERE {c} < 0) = 0",
             f"count(*) FILTER (WHERE {c} < 0)") for h, c in _DQ_MONEY.items()]
    g["dq_integral"] = [
        _res(f"integral::{h}", "numeric", "'WARNING'", f"count(*) FILTER (WHERE {c} % 1 <> 0) = 0",
             f"count(*) FILTER (WHERE {c} % 1 <> 0)") for h, c in _DQ_MONEY.items()]
    tot = "abs(food + transport + academic + other - total) > 0.005"
    g["dq_total"] = [_res("total_expenses_reconciles", "numeric", "'CRITICAL'",
                          f"count(*) FILTER (WHERE {tot}) = 0", f"count(*) FILTER (WHERE {tot})")]
    sav = "abs((allowance - total) - savings) > 0.005"
    g["dq_savings"] = [_res("savings_consistency", "numeric", "'CRITICAL'",
                            f"count(*) FILTER (WHERE {sav}) = 0", f"count(*) FILTER (WHERE {sav})")]
    oor = "usage < 0 OR usage > 10000"
    g["dq_usage"] = [_res("budget_usage_range", "numeric", "'CRITICAL'",
                          f"count(*) FILTER (WHERE {oor}) = 0", f"count(*) FILTER (WHERE {oor})")]
    g["dq_exact_dupes"] = [_res("exact_duplicate_rows", "uniqueness", "'CRITICAL'", "coalesce(sum(c), 0) = 0",
                                "coalesce(sum(c), 0)",
                                f"(SELECT count(*) AS c FROM dd GROUP BY {_ALL_COLS} HAVING count(*) > 1) t")]
    g["dq_name_ts_dupes"] = [_res("duplicate_name_and_timestamp", "uniqueness", "'CRITICAL'",
                                  "coalesce(sum(c), 0) = 0", "coalesce(sum(c), 0)",
                                  "(SELECT count(*) AS c FROM dd GROUP BY nm, ts HAVING count(*) > 1) t")]
    g["dq_repeated_names"] = [_res(
        "repeated_student_name", "uniqueness", "'WARNING'",
        "count(*) FILTER (WHERE nm IS NOT NULL AND c > 1 AND v = 1) = 0",
        "count(*) FILTER (WHERE nm IS NOT NULL AND c > 1 AND v = 1)",
        f"(SELECT nm, count(*) AS c, count(DISTINCT ({_ALL_COLS})) AS v FROM dd GROUP BY nm) t")]
    outl = []
    for h, c in _DQ_MONEY.items():
        src = (f"(SELECT x, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi, q3 - q1 AS iqr, n FROM "
               f"(SELECT {c} AS x FROM dd WHERE {c} IS NOT NULL) a, "
               f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, count({c}) AS n "
               f"FROM dd) b) t")
        skip = "(max(n) < 4 OR max(iqr) <= 0)"
        cnt = "count(*) FILTER (WHERE x < lo OR x > hi)"
        outl.append(_res(f"outliers::{h}", "anomaly",
                         f"CASE WHEN {skip} THEN 'SKIPPED' ELSE 'WARNING' END",
                         f"CASE WHEN {skip} THEN true ELSE {cnt} = 0 END",
                         f"CASE WHEN {skip} THEN 0 ELSE {cnt} END", src))
    g["dq_outliers"] = outl
    g["dq_censored"] = [_res("censored_values", "anomaly", "CASE WHEN count(*) = 0 THEN 'SKIPPED' ELSE 'INFO' END",
                             "true", "0")]
    g["dq_timestamps"] = [
        _res("timestamp_parseable", "anomaly", "'CRITICAL'",
             "count(*) FILTER (WHERE tsv IS NULL AND NOT " + _blank("ts") + ") = 0",
             "count(*) FILTER (WHERE tsv IS NULL AND NOT " + _blank("ts") + ")", "tsp"),
        _res("timestamp_not_future", "anomaly", "'CRITICAL'",
             "count(*) FILTER (WHERE tsv > TIMESTAMP '2026-01-01 00:00:00') = 0",
             "count(*) FILTER (WHERE tsv > TIMESTAMP '2026-01-01 00:00:00')", "tsp"),
        _res("timestamp_span_sane", "anomaly", "'WARNING'",
             "coalesce(floor((epoch_us(max(tsv)) - epoch_us(min(tsv))) / 86400000000.0), 0) <= 365", "0", "tsp"),
    ]
    xf = "preferred_payment IS DISTINCT FROM 'UPI' AND upi_app IS DISTINCT FROM 'Not Applicable'"
    g["dq_cross_field"] = [_res("cross_field_consistency::upi_app_matches_payment", "anomaly", "'WARNING'",
                                f"count(*) FILTER (WHERE {xf}) = 0", f"count(*) FILTER (WHERE {xf})")]
    doms = []
    for h, (c, allowed) in sorted(_DQ_DOMAINS.items()):
        vals = ", ".join("'" + v + "'" for v in allowed)
        bad = f"{c} IS NULL OR {c} NOT IN ({vals})"
        doms.append(_res(f"domain::{h}", "validity", "'CRITICAL'",
                         f"count(DISTINCT coalesce({c}, 'nan')) FILTER (WHERE {bad}) = 0",
                         f"count(DISTINCT coalesce({c}, 'nan')) FILTER (WHERE {bad})"))
    g["dq_domains"] = doms
    g["dq_cardinality"] = [_res("specialization_cardinality", "anomaly", "'INFO'", "true", "0", "(SELECT 1) t")]
    out = {k: with_view(DEFECTS_CTE + "\n" + "\nUNION ALL\n".join(v)) for k, v in g.items()}
    # what these two report is in their message
    cells = " + ".join(f"count(*) FILTER (WHERE {c} = 6250)" for c in ("food", "transport", "academic", "other"))
    out["dq_censored"] = with_view(DEFECTS_CTE + f"""
SELECT 'censored_values' AS name, 'anomaly' AS category, 'INFO' AS severity, true AS passed, CAST(0 AS BIGINT) AS offending,
  printf('expense cells in the open top bucket: %d of %d (%.1f%%), in %d rows', {cells}, 4 * count(*), ({cells}) * 100.0 / (4 * count(*)),
         count(*) FILTER (WHERE food = 6250 OR transport = 6250 OR academic = 6250 OR other = 6250)) AS message FROM dd""")
    out["dq_cardinality"] = with_view(DEFECTS_CTE + """
SELECT 'specialization_cardinality' AS name, 'anomaly' AS category, 'INFO' AS severity, true AS passed, CAST(0 AS BIGINT) AS offending,
  printf('different courses: %d in %d rows (%.0f%%)', count(DISTINCT specialization), count(*), count(DISTINCT specialization) * 100.0 / count(*)) AS message FROM dd""")
    every = [x for k, v in g.items() for x in v]
    report = DEFECTS_CTE + ", rep AS (\n" + "\nUNION ALL\n".join(every) + "\n)\n"
    out["quality_report"] = with_view(report + "SELECT * FROM rep")
    out["quality_report_merged"] = out["quality_report"]
    own = DEFECTS_CTE + ", rep AS (\n" + "\nUNION ALL\n".join(g["dq_row_count"] + g["dq_no_nulls"]) + "\n)\n"
    beyond = "count(*) FILTER (WHERE food > allowance)"
    out["quality_report_own"] = with_view(own + f"""SELECT name, category, severity, passed, offending FROM rep UNION ALL
""" + _res("food_beyond_allowance", "own", "'WARNING'", f"{beyond} = 0", beyond))
    out["quality_report_json"] = with_view(report + """, s AS (SELECT (SELECT count(*) FROM dd) AS row_count,
  count(*) FILTER (WHERE NOT passed AND severity IN ('CRITICAL', 'WARNING')) = 0 AS report_passed, count(*) AS results,
  count(*) FILTER (WHERE NOT passed AND severity = 'CRITICAL') AS critical, count(*) FILTER (WHERE NOT passed AND severity = 'WARNING') AS warning,
  count(*) FILTER (WHERE NOT passed AND severity = 'INFO') AS info, count(*) FILTER (WHERE severity = 'SKIPPED') AS skipped FROM rep)
SELECT s.row_count, 'strict' AS policy, s.report_passed, s.results, s.critical, s.warning, s.info, s.skipped,
  rep.name, rep.category, rep.severity, rep.passed, rep.offending FROM rep, s""")
    out["quality_summary"] = with_view(report + """SELECT count(*) AS total,
  count(*) FILTER (WHERE passed) AS passed,
  count(*) FILTER (WHERE severity = 'SKIPPED') AS skipped,
  count(*) FILTER (WHERE NOT passed AND severity = 'CRITICAL') AS critical,
  count(*) FILTER (WHERE NOT passed AND severity = 'WARNING') AS warning,
  count(*) FILTER (WHERE NOT passed AND severity = 'INFO') AS info
FROM rep""")
    out["quality_gate"] = with_view(report + """SELECT name, severity, offending, 'strict' AS policy, 'BLOCK' AS decision
FROM rep WHERE NOT passed AND severity IN ('CRITICAL', 'WARNING')""")
    return out


# --------------------------------------------------------------------------- #
# Metric layer
# --------------------------------------------------------------------------- #

def _avg(c: str) -> str:
    if c == "budget_usage_pct":
        return "CAST(sum(usage10) AS DOUBLE) / CAST(10 * count(usage10) AS DOUBLE)"
    return f"CAST(sum({c}) AS DOUBLE) / CAST(count({c}) AS DOUBLE)"


_YEAR_ORD = ("CASE year_of_study WHEN '1st Year' THEN 1 WHEN '2nd Year' THEN 2 "
             "WHEN '3rd Year' THEN 3 WHEN '4th Year' THEN 4 END")
_CENS = " + ".join(f"count(*) FILTER (WHERE {c} = 6250)" for c in
                   ("food_expenses", "transport_expenses", "academic_expenses", "other_expenses"))


def metric_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    def grouped(key, value_sql, alias, dims, where="", order=None, limit=50, extra=""):
        dl = ", ".join(dims)
        order = order or f"{alias} DESC, {dl}"
        w = f" WHERE {where}" if where else ""
        q[key] = with_view(f"SELECT {dl}, {value_sql} AS {alias}{extra} FROM v{w} "
                           f"GROUP BY {dl} ORDER BY {order} LIMIT {limit}")

    grouped("m_avg", _avg("total_expenses"), "avg_total_expenses", ["degree"])
    grouped("m_sum", "CAST(sum(allowance) AS BIGINT)", "sum_allowance", ["accommodation"])
    grouped("m_count", "count(*)", "students", ["year_of_study"], order=f"{_YEAR_ORD}, year_of_study")
    grouped("m_max", "max(total_expenses)", "max_total_expenses", ["preferred_payment"])
    grouped("m_min", "min(allowance)", "min_allowance", ["background"])
    grouped("m_median", median("total_expenses"), "median_total_expenses", ["study_focus"])
    grouped("m_filtered", _avg("academic_expenses"), "avg_academic_expenses", ["accommodation"],
            where="degree = 'BSc' AND gender = 'Female'")
    grouped("m_negated", _avg("total_expenses"), "avg_total_expenses", ["degree"],
            where="accommodation <> 'Hostel'")
    grouped("m_compare", _avg("allowance"), "avg_allowance", ["accommodation"],
            where="accommodation IN ('Hostel', 'Day Scholar')")
    q["m_scalar"] = with_view(f"SELECT {_avg('food_expenses')} AS avg_food_expenses FROM v "
                              "WHERE background = 'Rural'")
    grouped("m_grouped", _avg("overspend_amount"), "avg_overspend_amount", ["upi_app"],
            order="avg_overspend_amount ASC, upi_app", limit=5)
    grouped("m_two_dims", _avg("total_expenses"), "avg_total_expenses", ["degree", "gender"], limit=8)
    grouped("m_by_year", _avg("total_expenses"), "avg_total_expenses", ["year_of_study"],
            order=f"{_YEAR_ORD}, year_of_study")
    grouped("m_dual_ratio", _avg("budget_usage_pct"), "avg_budget_usage_pct", ["accommodation"],
            extra=f", {AGG_RATIO} AS aggregate_utilisation_pct")
    q["m_top_n"] = with_view("SELECT upi_app, count(*) AS students FROM v GROUP BY upi_app "
                             "ORDER BY students DESC, upi_app LIMIT 5")
    q["m_extreme"] = with_view("SELECT student_name, degree, year_of_study, accommodation, total_expenses "
                               "FROM v ORDER BY total_expenses DESC, student_id LIMIT 1")
    q["m_detail"] = with_view("SELECT student_name, degree, year_of_study, total_expenses FROM v "
                              "WHERE accommodation = 'PG' ORDER BY total_expenses DESC, student_id LIMIT 10")
    high = "the top answer has no upper end: its midpoint is a floor, so means and totals are too low"
    four = ["food_expenses", "transport_expenses", "academic_expenses", "other_expenses"]
    notes = [("total_expenses", high, " OR ".join(f"{c} = 6250" for c in four)), *[(c, high, f"{c} = 6250") for c in four],
             ("allowance", "its answers are coarser and lower than those on expenses", "total_expenses > allowance"),
             ("overspend_amount", "above zero means more spent than received", "overspend_amount > 0"),
             ("budget_usage_pct", "a ratio, not a share: the mean of ratios differs from the ratio of the sums", "usage10 > 1000"),
             ("savings", "below zero where expenses exceed the allowance: a ranking of savers then says little", "savings < 0")]
    q["m_caveats"] = with_view(" UNION ALL ".join(
        f"SELECT '{m}' AS measure, '{text}' AS caveat, count(*) FILTER (WHERE {cond}) AS affected, count({m}) AS answered, "
        f"{pct(f'count(*) FILTER (WHERE {cond})', f'count({m})')} AS share_pct, count(*) FILTER (WHERE {cond}) > 0 AS applies FROM v"
        for m, text, cond in notes))
    q["m_drift"] = with_view(f""", a AS (SELECT count(*) AS row_count,
  {mean2('total_expenses')} AS mean_total_expenses, {mean2('allowance')} AS mean_allowance,
  {_CENS} AS censored_cells FROM v)
SELECT row_count, row_count = 213 AS row_count_ok, mean_total_expenses, mean_allowance,
  abs(mean_total_expenses - 11461.27) <= 0.01 AS mean_total_expenses_ok,
  abs(mean_allowance - 1578.64) <= 0.01 AS mean_allowance_ok,
  CAST(censored_cells AS BIGINT) AS censored_cells, censored_cells > 0 AS censored_cells_ok FROM a""")
    q["i_group_spread"] = with_view(f""", g AS (SELECT degree, {_avg('total_expenses')} AS val FROM v GROUP BY degree)
SELECT (SELECT count(*) FROM g) AS groups,
  (SELECT degree FROM g ORDER BY val DESC, degree DESC LIMIT 1) AS top_group,
  (SELECT max(val) FROM g) AS top_value,
  (SELECT degree FROM g ORDER BY val ASC, degree ASC LIMIT 1) AS low_group,
  (SELECT min(val) FROM g) AS low_value,
  CASE WHEN (SELECT min(val) FROM g) <> 0 THEN (SELECT max(val) FROM g) / (SELECT min(val) FROM g) END AS spread_ratio,
  CASE WHEN (SELECT max(val) FROM g) / (SELECT min(val) FROM g) >= 1.5 THEN 'wide'
       WHEN (SELECT max(val) FROM g) / (SELECT min(val) FROM g) < 1.15 THEN 'flat' ELSE 'moderate' END AS verdict""")
    q["i_share"] = with_view(f"""SELECT count(*) FILTER (WHERE accommodation = 'Hostel') AS students,
  count(*) AS all_students,
  {pct("count(*) FILTER (WHERE accommodation = 'Hostel')", 'count(*)')} AS share_pct FROM v""")
    q["i_savings"] = with_view(f"""SELECT count(*) AS students, count(*) FILTER (WHERE savings >= 0) AS savers,
  {pct('count(*) FILTER (WHERE savings >= 0)', 'count(*)')} AS savers_pct,
  count(*) FILTER (WHERE savings >= 0) = 0 AS no_savers,
  {mean2('overspend_amount')} AS avg_deficit FROM v""")
    q["i_overview"] = with_view(f"""SELECT count(*) AS students, {mean2('total_expenses')} AS avg_total_expenses,
  {mean2('allowance')} AS avg_allowance, {MEAN_RATIO} AS mean_of_ratios_pct,
  {AGG_RATIO} AS aggregate_utilisation_pct, {pct(_CENS, '4 * count(*)')} AS censored_cells_pct FROM v""")
    return q


# --------------------------------------------------------------------------- #
# Text jobs: log triage (X1) and finding explanations
# --------------------------------------------------------------------------- #

def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# What the fixture's lines are matched by, written out anew: (regular expression, title, cause, fix, severity).
_LOG_ORACLE = (
    ("refusing to drop an existing table", "table kept", "the target exists and replacing it was not allowed", "allow the replacement, or load into another table", "CRITICAL"),
    ("pipeline . blocked", "run held back", "a precondition of the run was not met", "read the lines above this one and clear the precondition", "CRITICAL"),
    ("pipeline . failed", "run broken off", "a stage ended with an error", "rerun that stage alone and read its error", "CRITICAL"),
    ("critical quality failure", "gate closed", "a check of the highest severity failed", "mend the named rows and load again", "CRITICAL"),
    ("warning +quality finding", "gate finding", "a check failed that does not stop a load", "look at the named rows when convenient", "WARNING"),
    ("contains drop table", "script replaces a table", "the schema script starts by removing the table", "save the old rows, or take that statement out", "WARNING"),
    ("pre-load validation problem", "file refused", "the file breaks a rule of the table", "correct the named column and load again", "CRITICAL"),
    ("could not locate the stage 4 output", "input not there", "transformation has not written its result", "run the transformation first", "CRITICAL"),
    ("psycopg2 is required", "driver not there", "the client library of the database is not installed", "install it, or write files only", "CRITICAL"),
    ("connection refused|could not connect", "no connection", "the database is down, elsewhere, or turns this host away", "check host, port and access rules", "CRITICAL"),
    ("insufficientprivilege|permission denied", "access refused", "the account may not do this", "grant the right, or take another account", "CRITICAL"),
    ("relation .* does not exist", "object not there", "the table or view was not created or lies in another schema", "create it, or set the search path", "CRITICAL"),
    ("division by zero", "empty denominator", "a ratio was taken over nothing", "filter such groups, or return null for them", "WARNING"),
    ("dry run complete", "rehearsal only", "the run was asked not to write", "run it again without that option to load", "INFO"),
)
# Title, cause and fix of the checks that fail on the defect fixture.
_CHECK_ORACLE = {
    "no_nulls": ("required cell empty", "an answer was skipped or cleared", "fill it from the form or reject the row"),
    "populated": ("optional cell empty", "the question may be skipped", "nothing, unless a report needs the column"),
    "domain": ("answer not on the list", "a new option or a spelling", "map it to an option or extend the list"),
    "money_numeric": ("amount is text", "a label was not converted", "teach the converter that label"),
    "non_negative": ("amount below zero", "a sign slipped in", "correct the amount"),
    "integral": ("amount with decimals", "the value is not a bucket midpoint", "trace where it came from"),
    "total_expenses_reconciles": ("total does not add up", "a part was changed afterwards", "derive the total again"),
    "savings_consistency": ("savings do not follow", "allowance or total was changed afterwards", "derive the savings again"),
    "budget_usage_range": ("usage out of bounds", "the ratio was taken of wrong amounts", "derive the usage again"),
    "exact_duplicate_rows": ("row occurs again", "a file was read twice", "drop the repeated rows"),
    "duplicate_name_and_timestamp": ("one answer sent twice", "the form was submitted again at once", "keep one of the rows"),
    "repeated_student_name": ("name occurs again", "namesakes or repeated answers", "compare the other columns"),
    "outliers": ("unusual amounts", "real extremes or typing errors", "look at the largest and smallest"),
    "timestamp_parseable": ("unknown time format", "the export's locale differs", "add the format or reformat the column"),
    "timestamp_not_future": ("time after now", "a clock or a year is wrong", "correct the time"),
    "timestamp_span_sane": ("long period", "answers of two surveys are mixed", "separate them by date"),
    "cross_field_consistency": ("answers contradict", "the app question is asked of everybody", "decide which answer counts"),
}


def text_sql() -> dict[str, str]:
    from .operators.text_jobs import LOG_TEMPLATES
    tmpl = ", ".join(f"({i}, {_sq(t)})" for i, t in enumerate(LOG_TEMPLATES))
    cls = "CASE " + " ".join(f"WHEN regexp_matches(line, {_sq(r[0])}, 'i') THEN {i}" for i, r in enumerate(_LOG_ORACLE)) + " END"
    word = lambda k: "CASE pattern_id " + " ".join(f"WHEN {i} THEN {_sq(r[k])}" for i, r in enumerate(_LOG_ORACLE)) + " END"
    found = f"""c AS (SELECT line_id, ts, trim(line) AS evidence, {cls} AS pattern_id FROM lg),
r AS (SELECT *, row_number() OVER (PARTITION BY pattern_id ORDER BY ts, line_id) AS rn,
        count(*) OVER (PARTITION BY pattern_id) AS n FROM c WHERE pattern_id IS NOT NULL)
SELECT CAST(pattern_id AS BIGINT) AS pattern_id, {word(1)} AS title, {word(2)} AS cause, {word(3)} AS fix, {word(4)} AS severity,
  CAST(n AS BIGINT) AS lines, ts AS first_ts, CAST(line_id AS BIGINT) AS first_line_id, evidence
FROM r WHERE rn = 1 ORDER BY pattern_id"""
    q = {}
    q["x_log_triage"] = f"""WITH t(idx, tmpl) AS (VALUES {tmpl}),
lg AS (SELECT event_id AS line_id, ts,
         '[' || event_type || '] user=' || CAST(user_id AS VARCHAR) || ' ' || tmpl AS line
       FROM events JOIN t ON event_id % {len(LOG_TEMPLATES)} = idx),
{found}"""
    words, key = "string_split(coalesce(text, ''), ' ')", "(conv_id * 7 + turn)"
    place = f"(conv_id * 31 + turn * 17) % (len({words}) + 1)"
    q["x_log_triage_texts"] = f"""WITH t(idx, tmpl) AS (VALUES {tmpl}),
lg AS (SELECT conv_id * 1000 + turn AS line_id, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(turn) AS ts,
         CASE WHEN {key} % 3 = 0 THEN array_to_string({words}[1:{place}] || [tmpl] || {words}[{place} + 1:], ' ') ELSE text END AS line
       FROM conversations JOIN t ON {key} % {len(LOG_TEMPLATES)} = idx),
{found}"""
    keys = sorted(_CHECK_ORACLE, key=len, reverse=True)
    match = "CASE " + " ".join(f"WHEN starts_with(name, {_sq(k)}) THEN {_sq(k)}" for k in keys) + " END"
    note = lambda i: "CASE matched_key " + " ".join(f"WHEN {_sq(k)} THEN {_sq(v[i])}" for k, v in _CHECK_ORACLE.items()) + " END"
    rep = quality_sql()["quality_report"]
    q["x_explain_findings"] = rep.replace("SELECT * FROM rep", f"""SELECT name, severity, matched_key,
  {note(1)} AS cause, {note(2)} AS fix, coalesce({note(0)}, 'unrecognised check ' || chr(39) || name || chr(39)) AS title, offending
FROM (SELECT *, {match} AS matched_key FROM rep WHERE NOT passed AND severity <> 'SKIPPED') p""")
    return q


# --------------------------------------------------------------------------- #
# Question text (N1, N2, N3, N6); RE2 has no lookaround, so boundaries are groups
# --------------------------------------------------------------------------- #

def _re2(phrase: str) -> str:
    esc = "".join("\\" + ch if ch in ".+*?()[]{}|^$\\/-%&" else ch for ch in phrase)
    return "(^|[^a-z0-9])" + esc + "([^a-z0-9]|$)"


def question_sql() -> dict[str, str]:
    from .functions import vocabulary as V
    from .sources.questions import QUESTIONS
    qs = ", ".join(f"({i}, {_sq(q)})" for i, q in enumerate(QUESTIONS))
    prot = ", ".join(_sq(w) for w in sorted(V.PROTECTED))
    stop = ", ".join(_sq(w) for w in sorted(V.STOPWORDS))
    base = f"""WITH tq(idx, question) AS (VALUES {qs}),
ql AS (SELECT conv_id, turn, question FROM conversations JOIN tq
       ON (conv_id * 7 + turn) % {len(QUESTIONS)} = idx WHERE role = 'user'),
n0 AS (SELECT conv_id, turn, question, trim(regexp_replace(regexp_replace(replace(lower(coalesce(question, '')), '''', ' '),
         '[^a-z0-9/&+.\\s-]', ' ', 'g'), '\\s+', ' ', 'g')) AS t0 FROM ql),
nt AS (SELECT conv_id, turn, question, array_to_string(list_filter(string_split(t0, ' '), lambda x: x <> '' AND
         (x IN ({prot}) OR regexp_matches(x, '[0-9]') OR x NOT IN ({stop}))), ' ') AS text FROM n0)
"""
    ranked = sorted(((len(s), mi, si, key, s) for mi, (key, _, _, syns) in enumerate(V.MEASURES)
                     for si, s in enumerate(syns)), key=lambda r: (-r[0], r[1], r[2]))
    meas = "CASE " + " ".join(f"WHEN regexp_matches(text, {_sq(_re2(s))}) THEN {_sq(k)}"
                              for _, _, _, k, s in ranked) + " END"
    agg = "CASE " + " ".join(f"WHEN regexp_matches(text, {_sq(_re2(p))}) THEN {_sq(v)}"
                             for p, v in V.AGGREGATION_SYNONYMS) + " END"
    dflt = "CASE m " + " ".join(f"WHEN {_sq(k)} THEN {_sq(a)}" for k, _, a, _ in V.MEASURES) + " END"
    rank = "CASE " + " ".join(f"WHEN regexp_matches(text, {_sq(_re2(p))}) THEN {_sq(v)}"
                              for p, v in V.RANKING_SYNONYMS) + " END"
    detail = "(" + " OR ".join(f"regexp_matches(text, {_sq(_re2(p))})" for p in V.DETAIL_SYNONYMS) + ")"
    comp = "(" + " OR ".join(f"regexp_matches(text, {_sq(_re2(p))})" for p in V.COMPARISON_SYNONYMS) + ")"
    words = "CASE {raw} " + " ".join(f"WHEN {_sq(k)} THEN {v}" for k, v in V.NUMBER_WORDS.items()) + " END"
    lim_parts = []
    for p in V.LIMIT_PATTERNS:
        raw = f"regexp_extract(text, {_sq(p)}, 1)"
        lim_parts.append(f"CASE WHEN regexp_matches({raw}, '^[0-9]+$') THEN CAST({raw} AS INTEGER) "
                         f"ELSE {words.format(raw=raw)} END")
    lim = "coalesce(" + ", ".join(lim_parts) + ")"
    q = {}
    q["n_normalise"] = base + "SELECT conv_id, turn, text FROM nt"
    q["n_measure"] = base + f"SELECT conv_id, turn, {meas} AS measure FROM nt"
    q["n_aggregation"] = base + f"""SELECT conv_id, turn,
  coalesce({agg}, {dflt}, CASE WHEN {detail} THEN '' END) AS aggregation
FROM (SELECT *, {meas} AS m FROM nt) x"""
    q["n_flags"] = base + f"""SELECT conv_id, turn, {rank} AS ranking, CAST({lim} AS BIGINT) AS explicit_limit,
  {detail} AS detail, {comp} AS comparison FROM nt"""
    parse = base + _parse_sql(lim)
    named = "array_to_string(list_transform({}, lambda f: f.dim || CASE WHEN f.neg THEN '!=' ELSE '=' END || f.val), ';')"
    q["n_filters"] = parse + """SELECT conv_id, turn, CAST(k - 1 AS BIGINT) AS pos, f.dim AS dimension, f.val AS value, f.neg AS negated FROM
(SELECT conv_id, turn, unnest(fs) AS f, generate_subscripts(fs, 1) AS k FROM
 (SELECT conv_id, turn, filters || coalesce(list_transform(cmp_values, lambda v: {'dim': cmp_dim, 'val': v, 'neg': false}), []) AS fs FROM p))"""
    q["n_dimensions"] = parse + """SELECT conv_id, turn, CAST(k - 1 AS BIGINT) AS pos, dimension FROM
(SELECT conv_id, turn, unnest(dims) AS dimension, generate_subscripts(dims, 1) AS k FROM p)"""
    q["n_intents"] = parse + f"""SELECT conv_id, turn, measure, aggregation, array_to_string(dims, ',') AS dimensions, {named.format('filters')} AS filters,
  cmp_dim || ':' || array_to_string(cmp_values, '|') AS compare, ranking, row_limit, detail, extreme, list_contains(dims, 'year_of_study') AS sort_ordinal, refused FROM p"""
    confirm = ", ".join(_sq(w) for w in sorted(V.CONFIRMATIONS))
    first = "list_filter({0}, lambda x, i: list_position(list_transform({0}, lambda y: y.dim), x.dim) = i)"
    q["n_carry_over"] = parse.replace("WITH tq", "WITH RECURSIVE tq", 1).replace("WITH ql", "WITH RECURSIVE ql", 1) + f""",
seq AS (SELECT *, measure IS NULL AND NOT detail AS silent, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, question) AS k
        FROM p WHERE NOT refused AND lower(trim(coalesce(question, ''))) NOT IN ({confirm})),
walk AS (SELECT conv_id, k, turn, measure, aggregation, dims, filters, false AS carried FROM seq WHERE k = 1
UNION ALL SELECT conv_id, k, turn, CASE WHEN carried THEN m1 ELSE m0 END, CASE WHEN carried THEN a1 ELSE a0 END, CASE WHEN carried THEN d1 ELSE d0 END,
            CASE WHEN carried THEN f1 ELSE f0 END, carried
 FROM (SELECT *, takes_m OR takes_d OR len(f1) > len(f0) AS carried FROM
 (SELECT s.conv_id, s.k, s.turn, s.measure AS m0, s.aggregation AS a0, s.dims AS d0, s.filters AS f0,
    s.silent AND w.measure IS NOT NULL AS takes_m,
    len(w.dims) > 0 AND ((s.silent AND w.measure IS NULL) OR (len(s.dims) = 0 AND s.cmp_dim IS NULL)) AS takes_d,
    CASE WHEN s.silent AND w.measure IS NOT NULL THEN w.measure ELSE s.measure END AS m1,
    CASE WHEN s.silent AND w.measure IS NOT NULL THEN w.aggregation ELSE s.aggregation END AS a1,
    CASE WHEN (s.silent AND w.measure IS NULL AND (len(w.dims) > 0 OR len(w.filters) > 0)) OR (len(s.dims) = 0 AND s.cmp_dim IS NULL) THEN w.dims ELSE s.dims END AS d1,
    {first.format('(w.filters || s.filters)')} AS f1
  FROM walk w JOIN seq s ON s.conv_id = w.conv_id AND s.k = w.k + 1) x) y)
SELECT conv_id, turn, measure, aggregation, array_to_string(dims, ',') AS dimensions, {named.format('list_sort(filters)')} AS filters, carried FROM walk"""
    q["n_answers"] = _answer_sql(base)
    # the same readings of the table's own texts, each with its question put inside
    words = "string_split(coalesce(c.text, ''), ' ')"
    place = f"(c.conv_id * 31 + c.turn * 17) % (len({words}) + 1)"
    inside = f"array_to_string({words}[1:{place}] || [tq.question] || {words}[{place} + 1:], ' ')"
    real = base[:base.index("ql AS")] + f"""ql AS (SELECT c.conv_id, c.turn, {inside} AS question FROM conversations c JOIN tq
       ON (c.conv_id * 7 + c.turn) % {len(QUESTIONS)} = idx WHERE role = 'user'),\n""" + base[base.index("n0 AS"):]
    plain, mixed = base[base.index("ql AS"):base.index("n0 AS")], real[real.index("ql AS"):real.index("n0 AS")]
    q.update({key + "_texts": sql.replace(plain, mixed) for key, sql in q.items() if key != "n_answers"})
    return q


# What the questions of the log ask, read by hand: kind, measure, aggregation, grouping, SQL condition, direction, limit. Others are refused.
_ASKED = {
    "mean total expenses per degree": ("group", "total_expenses", "avg", ["degree"], "true", "desc", 50),
    "what is the median allowance by gender": ("group", "allowance", "median", ["gender"], "true", "desc", 50),
    "show the ten biggest spenders in hostel": ("count", "", "count", [], "accommodation = 'Hostel'", "desc", 1),
    "which accommodation has the lowest average food expenses": ("group", "food_expenses", "avg", ["accommodation"], "true", "asc", 50),
    "number of students by preferred payment": ("group", "", "count", ["preferred_payment"], "true", "desc", 50),
    "compare food expenses of urban versus rural students": ("group", "food_expenses", "avg", ["background"], "background IN ('Rural', 'Urban')", "desc", 50),
    "top 4 upi apps": ("group", "", "count", ["upi_app"], "preferred_payment = 'UPI'", "desc", 4),
    "maximum transport expenses for 2nd year students": ("extreme", "transport_expenses", "", [], "year_of_study = '2nd Year'", "desc", 1),
    "sum of academic expenses by study focus": ("group", "academic_expenses", "avg", ["study_focus"], "true", "desc", 50),
    "budget usage for day scholars by year of study": ("group", "budget_usage_pct", "avg", ["year_of_study"], "accommodation = 'Day Scholar'", "desc", 50),
    "list female students not living in pg": ("listing", "total_expenses", "", [], "gender = 'Female' AND accommodation <> 'PG'", "desc", 50),
    "how many mba students track digitally": ("count", "", "count", [], "degree = 'MBA' AND track_digitally = 'Yes'", "desc", 1),
    "least allowance among rural students": ("extreme", "allowance", "", [], "background = 'Rural'", "asc", 1),
    "average savings by background": ("group", "savings", "avg", ["background"], "true", "desc", 50),
    "other expenses by degree and gender": ("group", "other_expenses", "avg", ["degree", "gender"], "true", "desc", 50),
    "top three degrees by total spend": ("extreme", "total_expenses", "", [], "true", "desc", 1),
    "now only the rural ones": ("count", "", "count", [], "background = 'Rural'", "desc", 1),
    "just those paying cash": ("count", "", "count", [], "preferred_payment = 'Cash'", "desc", 1),
    "highest allowance": ("extreme", "allowance", "", [], "true", "desc", 1),
}


def _answer_sql(base: str) -> str:
    from .sources.questions import QUESTIONS
    parts = []
    for idx, question in enumerate(QUESTIONS):
        if question not in _ASKED:
            continue
        kind, measure, agg, dims, where, way, limit = _ASKED[question]
        empty = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ("student_name", "degree", "year_of_study", "accommodation"))
        if kind in ("listing", "extreme"):
            home = "accommodation" if kind == "extreme" else "CAST(NULL AS VARCHAR) AS accommodation"
            body = (f"row_number() OVER (ORDER BY {measure} {way}, student_id) AS rank, '' AS groups, '{measure}' AS value_name, CAST({measure} AS DOUBLE) AS value, "
                    f"CAST(NULL AS DOUBLE) AS aggregate_utilisation_pct, student_name, degree, year_of_study, {home} FROM v WHERE {where}")
        else:
            value = "count(*)" if agg == "count" else median(measure) if agg == "median" else _avg(measure)
            name = "students" if agg == "count" else f"{agg}_{measure}"
            order = _YEAR_ORD if dims == ["year_of_study"] else ", ".join([f"{value} {way}", *dims])
            ratio = AGG_RATIO if measure == "budget_usage_pct" else "CAST(NULL AS DOUBLE)"
            body = (f"{f'row_number() OVER (ORDER BY {order})' if dims else 1} AS rank, {' || chr(124) || '.join(dims) or chr(39) * 2} AS groups, '{name}' AS value_name, CAST({value} AS DOUBLE) AS value, "
                    f"{ratio} AS aggregate_utilisation_pct, {empty} FROM v WHERE {where}" + (f" GROUP BY {', '.join(dims)}" if dims else ""))
        parts.append(f"SELECT * FROM (SELECT {idx} AS idx, '{kind}' AS kind, {body}) x WHERE rank <= {limit}")
    log = base[:base.index("n0 AS")].replace("SELECT conv_id, turn, question FROM", "SELECT conv_id, turn, idx FROM").rstrip().rstrip(",")
    union = "\nUNION ALL ".join(parts)
    return with_view(f"""SELECT conv_id, turn, kind, CAST(rank AS INTEGER) AS rank, groups, value_name, value, aggregate_utilisation_pct, student_name, degree, year_of_study, accommodation
FROM ({log} SELECT * FROM ql) l JOIN ({union}) a USING (idx)""")


def _parse_sql(limit: str) -> str:
    """CTEs from ``nt`` to ``p`` (one parsed question a row): every place of every phrase, then the rules in SQL."""
    from .functions import vocabulary as V
    order, rows = sorted(((-len(s), mi, si, k, s) for mi, (k, _, _, syns) in enumerate(V.MEASURES) for si, s in enumerate(syns))), []
    rows += [(s, "measure", i, k, "") for i, (_, _, _, k, s) in enumerate(order)]
    rows += [(s, "verb", i, v, "") for i, (s, v) in enumerate(V.AGGREGATION_SYNONYMS)] + [(s, "rank", i, v, "") for i, (s, v) in enumerate(V.RANKING_SYNONYMS)]
    rows += [(s, "detail", 0, "", "") for s in V.DETAIL_SYNONYMS] + [(s, "compare", 0, "", "") for s in V.COMPARISON_SYNONYMS]
    rows += [(s, "name", 100 * d + i, dim, "") for d, (dim, syns, _) in enumerate(V.DIMENSIONS) for i, s in enumerate(syns)]
    aliases = [(a, dim, v) for dim, _, al in V.DIMENSIONS if dim not in V.UNFILTERABLE for a, v in al]
    rows += [(a, "value", i, dim, v) for i, (a, dim, v) in enumerate(aliases)]
    ph = ",\n".join(f"({_sq(p)}, {_sq(k)}, {o}, {_sq(x)}, {_sq(y)})" for p, k, o, x, y in rows)
    alnum = "regexp_matches({}, '[a-z0-9]')"
    lead = lambda n: f"substr(h.text, greatest(0, h.s - {n}) + 1, least(h.s, {n}))"
    near = lambda n, words: "(" + " OR ".join(f"regexp_matches({lead(n)}, {_sq(_re2(w))})" for w in words) + ")"
    default = "CASE measure0 " + " ".join(f"WHEN {_sq(k)} THEN {_sq(a)}" for k, _, a, _ in V.MEASURES) + " END"
    return f""",
tx AS (SELECT DISTINCT text FROM nt),
ph(p, kind, o, x, y) AS (VALUES {ph}),
inn AS (SELECT text, p, kind, o, x, y FROM tx JOIN ph ON contains(text, p)),
pos AS (SELECT *, unnest(range(0, CAST(length(text) AS BIGINT))) AS s FROM inn),
h AS (SELECT *, s + length(p) AS e FROM pos WHERE substr(text, s + 1, length(p)) = p AND (s = 0 OR NOT {alnum.format('substr(text, s, 1)')})
      AND (s + length(p) = length(text) OR NOT {alnum.format('substr(text, s + length(p) + 1, 1)')})),
one AS (SELECT text, arg_min(x, o) FILTER (WHERE kind = 'measure') AS measure0, arg_min(x, o) FILTER (WHERE kind = 'verb') AS verb,
          arg_min(x, o) FILTER (WHERE kind = 'rank') AS ranking, coalesce(bool_or(kind = 'detail'), false) AS detail, coalesce(bool_or(kind = 'compare'), false) AS cmp FROM h GROUP BY text),
cand AS (SELECT text, s, e, o, x, y, {near(V.NEGATION_WINDOW, V.NEGATIONS)} AS neg, row_number() OVER (PARTITION BY text ORDER BY o, s) AS k FROM h WHERE kind = 'value'),
cl AS (SELECT text, list({{'s': s, 'e': e, 'k': k}} ORDER BY k) AS all_ FROM cand GROUP BY text),
acc AS (SELECT text, list_reduce(list_transform(all_, lambda c: [c]), lambda a, b: CASE WHEN len(list_filter(a, lambda c: b[1].s < c.e AND c.s < b[1].e)) > 0 THEN a ELSE a || b END) AS got FROM cl),
ok AS (SELECT c.text, c.x AS dim, c.y AS val, bool_or(c.neg) AS neg, min(c.k) AS k FROM acc JOIN cand c ON c.text = acc.text AND list_contains(list_transform(got, lambda g: g.k), c.k) GROUP BY ALL),
fl AS (SELECT text, list({{'dim': dim, 'val': val, 'neg': neg}} ORDER BY k) AS found FROM ok GROUP BY text),
nm AS (SELECT h.text, o // 100 AS d, o % 100 AS i, x AS dim, s, {near(V.GROUPING_WINDOW, V.GROUPING_SYNONYMS)} AS grouped FROM h WHERE kind = 'name'),
sub AS (SELECT text, d, min({{'i': i, 's': s}}) AS f FROM nm WHERE NOT grouped GROUP BY text, d),
nd AS (SELECT nm.text, nm.d, nm.dim, bool_or(nm.grouped AND NOT (one.ranking IS NOT NULL AND sub.f IS NOT NULL AND nm.i = sub.f.i AND nm.s > sub.f.s)) AS explicit, any_value(one.ranking) IS NOT NULL AS ranked
       FROM nm JOIN one ON one.text = nm.text LEFT JOIN sub ON sub.text = nm.text AND sub.d = nm.d
       WHERE NOT EXISTS (SELECT 1 FROM ok WHERE ok.text = nm.text AND ok.dim = nm.dim) GROUP BY nm.text, nm.d, nm.dim),
dd AS (SELECT text, list(dim ORDER BY d) FILTER (WHERE explicit) AS ex, list(dim ORDER BY d) FILTER (WHERE ranked) AS ch FROM nd GROUP BY text),
dn(d, dim) AS (VALUES {", ".join(f"({d}, {_sq(dim)})" for d, (dim, _, _) in enumerate(V.DIMENSIONS))}),
tw AS (SELECT text, arg_min(dim, d) AS dim FROM (SELECT text, dim, any_value(d) AS d FROM ok JOIN dn USING (dim) GROUP BY text, dim HAVING count(*) > 1) GROUP BY text),
r AS (SELECT nt.*, measure0, verb, ranking, coalesce(detail, false) AS detail, coalesce(cmp, false) AS cmp, coalesce(found, []) AS found,
        CASE WHEN len(ex) > 0 THEN ex WHEN len(ch) > 0 THEN ch[1:1] WHEN coalesce(cmp, false) AND tw.dim IS NOT NULL THEN [tw.dim] ELSE [] END AS dims, CAST({limit.replace('text', 'nt.text')} AS BIGINT) AS lim
      FROM nt LEFT JOIN one ON one.text = nt.text LEFT JOIN fl ON fl.text = nt.text LEFT JOIN dd ON dd.text = nt.text LEFT JOIN tw ON tw.text = nt.text),
r1 AS (SELECT *, measure0 IS NULL AND len(dims) > 0 AND NOT detail AND verb IS NULL AS counted,
         CASE WHEN cmp THEN list_filter(dims, lambda d: len(list_filter(found, lambda f: f.dim = d)) > 1)[-1] END AS cmp_dim FROM r),
r2 AS (SELECT *, CASE WHEN counted THEN 'student_count' ELSE measure0 END AS measure FROM r1),
p AS (SELECT conv_id, turn, question, measure, CASE WHEN counted THEN 'count' WHEN verb IS NOT NULL THEN verb WHEN measure0 IS NOT NULL THEN {default} WHEN detail THEN '' END AS aggregation,
        dims, CASE WHEN cmp_dim IS NULL THEN found ELSE list_filter(found, lambda f: f.dim <> cmp_dim) END AS filters, cmp_dim,
        CASE WHEN cmp_dim IS NOT NULL THEN list_sort(list_transform(list_filter(found, lambda f: f.dim = cmp_dim), lambda f: f.val)) END AS cmp_values, ranking, detail,
        CASE WHEN lim IS NOT NULL THEN least(greatest(lim, 1), {V.MAX_LIMIT}) WHEN ranking IS NOT NULL AND len(dims) = 0 AND NOT detail THEN 1 ELSE {V.DEFAULT_LIMIT} END AS row_limit,
        ranking IS NOT NULL AND len(dims) = 0 AND NOT detail AND verb IS NULL AND measure IS NOT NULL AND measure <> 'student_count' AS extreme,
        coalesce(trim(question) = '', true) OR NOT (measure IS NOT NULL OR len(dims) > 0 OR len(found) > 0 OR detail) AS refused FROM r2)
"""
