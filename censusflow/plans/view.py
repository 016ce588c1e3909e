"""Published table projection and the analysis view every report reads.

``publish_projection`` maps the 22 display headers of the stage-4 frame onto
the typed table (generated columns recomputed from their components, naive
local timestamps pinned to the source zone and stored as UTC instants).
``analysis_view`` adds the ordinal and the boolean flags.  Both are pure
projections; Catalyst inlines them into each report and prunes what a report
does not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import spec
from ..functions.columns import col_of

MONEY_PUBLISHED = ("food_expenses", "transport_expenses", "academic_expenses",
                   "other_expenses", "allowance")
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd HH:mm:ss",
                     "M/d/yyyy H:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd")


def parse_timestamp(c) -> F.Column:
    """Mixed-format parse of a text timestamp; NULL when no format fits."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in TIMESTAMP_FORMATS])


def publish_projection(stage4: DataFrame, key: str = "response_id") -> DataFrame:
    """Display frame -> published table columns and types.

    ``student_id`` comes from the export's response key; an export without one
    gets ``monotonically_increasing_id`` (unique, assigned without a shuffle).
    """
    cols = set(stage4.columns)
    missing = [h for h in spec.PUBLISHED_NAMES if h not in cols]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    src = {v: col_of(k) for k, v in spec.PUBLISHED_NAMES.items()}
    sid = F.col(key).cast("long") if key in cols else F.monotonically_increasing_id()
    ts = col_of("Timestamp")
    ts_type = dict(stage4.dtypes)["Timestamp"]
    local = ts.cast("timestamp") if ts_type.startswith("timestamp") else parse_timestamp(ts)
    money = {c: src[c].cast("decimal(12,2)") for c in MONEY_PUBLISHED}
    total = (money["food_expenses"] + money["transport_expenses"]
             + money["academic_expenses"] + money["other_expenses"]).cast("decimal(12,2)")
    out = [sid.alias("student_id"),
           F.to_utc_timestamp(local, spec.SOURCE_TIMEZONE).alias("submitted_at")]
    for c in spec.PUBLISHED_NAMES.values():
        if c == "submitted_at":
            continue
        if c in money:
            out.append(money[c].alias(c))
        elif c == "total_expenses":
            out.append(total.alias(c))
        elif c == "savings":
            out.append((money["allowance"] - total).cast("decimal(12,2)").alias(c))
        elif c == "budget_usage_pct":
            out.append(src[c].cast("decimal(7,2)").alias(c))
        else:
            out.append(src[c].cast("string").alias(c))
    return stage4.select(*out)


def year_ordinal(c) -> F.Column:
    out = F.lit(None).cast("int")
    for label, ordinal in reversed(list(spec.YEAR_ORDINALS.items())):
        out = F.when(c == label, F.lit(ordinal)).otherwise(out)
    return out.cast("int")


VIEW_COLUMNS = (
    "student_id", "submitted_at", "student_name", "gender", "degree", "year_of_study",
    "accommodation", "background", "work_internship", "specialization", "preferred_payment",
    "upi_app", "track_digitally", "budget_plan", "study_focus", "year_of_study_ordinal",
    "food_expenses", "transport_expenses", "academic_expenses", "other_expenses",
    "total_expenses", "allowance", "savings", "budget_usage_pct", "overspend_amount",
    "is_overspending", "pays_by_upi", "names_a_upi_app",
)
VIEW_MONEY = ("food_expenses", "transport_expenses", "academic_expenses", "other_expenses",
              "total_expenses", "allowance", "savings")


def analysis_view(published: DataFrame) -> DataFrame:
    """V1-V3: pass-through columns, year ordinal, overspend and UPI flags.

    Money is exposed as whole-rupee ``long`` and ``budget_usage_pct`` as ``double``, so
    every report computes in exact integer arithmetic.  Amounts come from bucket
    midpoints and are whole; one that is not raises instead of losing its decimals.
    """
    p = published
    money = {c: F.when(F.col(c).isNull() | (F.col(c) == F.floor(F.col(c))), F.col(c).cast("long"))
             .otherwise(F.raise_error(F.concat(F.lit(f"{c} is not a whole amount: "), F.col(c).cast("string"))).cast("long")) for c in VIEW_MONEY}
    cols = {
        "student_id": F.col("student_id").cast("long"),
        "submitted_at": F.col("submitted_at"),
        **{c: F.col(c) for c in ("student_name", "gender", "degree", "year_of_study",
                                 "accommodation", "background", "work_internship",
                                 "specialization", "preferred_payment", "upi_app",
                                 "track_digitally", "budget_plan", "study_focus")},
        "year_of_study_ordinal": year_ordinal(F.col("year_of_study")),
        **money,
        "budget_usage_pct": F.col("budget_usage_pct").cast("double"),
        "overspend_amount": money["total_expenses"] - money["allowance"],
        "is_overspending": money["total_expenses"] > money["allowance"],
        "pays_by_upi": F.col("preferred_payment") == "UPI",
        "names_a_upi_app": F.col("upi_app") != spec.NOT_APPLICABLE,
    }
    return p.select(*[cols[c].alias(c) for c in VIEW_COLUMNS])
