"""Survey specification: the single description every operator is generated from.

Everything in the FIXED VALUES block must equal the survey instrument's own
labels, otherwise cleaned data would not match the published schema.  The rest
of the module derives lookups from those lists so that column lists, domains and
money rules are stated once; the operators read them from here and take
overrides (rename map, domains, expectations) as arguments where a rule needs one.
"""

from __future__ import annotations

# --------------------------------------------------------------------------- #
# FIXED VALUES (survey instrument labels, domains, bucket rules)
# --------------------------------------------------------------------------- #

# Raw export header (trimmed) -> cleaned snake_case name, in form order.
RAW_RENAME: dict[str, str] = {
    "Timestamp": "timestamp",
    "Student Name": "student_name",
    "Gender": "gender",
    "Degree": "degree",
    "Year of Study": "year_of_study",
    "Accommodation Type": "accommodation_type",
    "Residential Background": "residential_background",
    "Part-time Work/Internship": "part_time_work_internship",
    "Food Expenses  (Monthly)": "food_expenses_monthly",
    "Transport Expenses  (Monthly)": "transport_expenses_monthly",
    "Academic Expenses  (Monthly)": "academic_expenses_monthly",
    "Other Expenses (Monthly)": "other_expenses_monthly",
    "Preferred Payment": "preferred_payment",
    "If UPI which app you use?": "upi_app",
    "Do you track your expenses digitally?": "track_expenses_digitally",
    "Monthly Allowance": "monthly_allowance",
    "Do you maintain a monthly budget plan?": "maintain_budget_plan",
    "In which study-related areas do you spend the most each month?": "top_academic_spending_area",
}

# The six course questions folded into one answer, in form order.
COURSE_COLUMNS: tuple[str, ...] = (
    "Course Title", "Course Title 2", "Course Title 3",
    "Course Title 4", "Course Title 5", "Course Title 6",
)

# A raw row is junk only if all of these are blank.
IDENTITY_COLUMNS: tuple[str, ...] = ("Timestamp", "Student Name")

NOT_APPLICABLE = "Not Applicable"
FOLD_SEPARATOR = "; "

# Stage-3 output order.
CLEANED_COLUMNS: tuple[str, ...] = (
    "timestamp", "student_name", "gender", "degree", "year_of_study",
    "accommodation_type", "residential_background", "part_time_work_internship",
    "specialization", "food_expenses_monthly", "transport_expenses_monthly",
    "academic_expenses_monthly", "other_expenses_monthly", "preferred_payment",
    "upi_app", "track_expenses_digitally", "monthly_allowance",
    "maintain_budget_plan", "top_academic_spending_area",
)

# Stage-3 name -> short stage-4 name.
SHORT_NAMES: dict[str, str] = {
    "food_expenses_monthly": "food",
    "transport_expenses_monthly": "transport",
    "academic_expenses_monthly": "academic",
    "other_expenses_monthly": "other",
    "monthly_allowance": "allowance",
    "part_time_work_internship": "work_internship",
    "residential_background": "background",
    "accommodation_type": "accommodation",
    "top_academic_spending_area": "study_focus",
    "track_expenses_digitally": "track_digitally",
    "maintain_budget_plan": "budget_plan",
    "total_expenses_monthly": "total_expenses",
}

# Short name -> display header of the stage-4 export.
DISPLAY_NAMES: dict[str, str] = {
    "timestamp": "Timestamp",
    "student_name": "Student Name",
    "gender": "Gender",
    "degree": "Degree",
    "year_of_study": "Year of Study",
    "accommodation": "Accommodation",
    "background": "Background",
    "work_internship": "Work/Internship",
    "specialization": "Specialization",
    "food": "Food",
    "transport": "Transport",
    "academic": "Academic",
    "other": "Other",
    "total_expenses": "Total Expenses",
    "allowance": "Allowance",
    "savings": "Savings",
    "budget_usage_pct": "Budget Usage %",
    "preferred_payment": "Preferred Payment",
    "upi_app": "UPI App",
    "track_digitally": "Track Digitally",
    "budget_plan": "Budget Plan",
    "study_focus": "Study Focus",
}

DERIVED_COLUMNS: tuple[str, ...] = ("total_expenses", "savings", "budget_usage_pct")
MONEY_COLUMNS: tuple[str, ...] = ("food", "transport", "academic", "other", "allowance")
EXPENSE_COLUMNS: tuple[str, ...] = ("food", "transport", "academic", "other")

# Display header -> published table column.
PUBLISHED_NAMES: dict[str, str] = {
    "Timestamp": "submitted_at",
    "Student Name": "student_name",
    "Gender": "gender",
    "Degree": "degree",
    "Year of Study": "year_of_study",
    "Accommodation": "accommodation",
    "Background": "background",
    "Work/Internship": "work_internship",
    "Specialization": "specialization",
    "Food": "food_expenses",
    "Transport": "transport_expenses",
    "Academic": "academic_expenses",
    "Other": "other_expenses",
    "Total Expenses": "total_expenses",
    "Allowance": "allowance",
    "Savings": "savings",
    "Budget Usage %": "budget_usage_pct",
    "Preferred Payment": "preferred_payment",
    "UPI App": "upi_app",
    "Track Digitally": "track_digitally",
    "Budget Plan": "budget_plan",
    "Study Focus": "study_focus",
}
GENERATED_PUBLISHED: tuple[str, ...] = ("total_expenses", "savings")

# Closed categorical domains (display header -> allowed values).
DOMAINS: dict[str, tuple[str, ...]] = {
    "Gender": ("Male", "Female"),
    "Degree": ("B.Com", "BE / B.Tech", "BSc", "MBA", "ME / M.Tech", "Other"),
    "Year of Study": ("1st Year", "2nd Year", "3rd Year", "4th Year"),
    "Accommodation": ("Day Scholar", "Hostel", "PG"),
    "Background": ("Rural", "Urban"),
    "Work/Internship": ("Yes", "No"),
    "Track Digitally": ("Yes", "No"),
    "Budget Plan": ("Yes", "No"),
    "Preferred Payment": ("UPI", "Cash", "Debit/Credit Card", "Other"),
    "UPI App": ("GPay", "PhonePe", "SBI Pay", "Amazon Pay", "BHIM UPI",
                "Airtel Thanks App", "Other", "Not Applicable"),
}

# Money headers the table requires to be non-negative.
NON_NEGATIVE_HEADERS: tuple[str, ...] = ("Food", "Transport", "Academic", "Other", "Allowance")

YEAR_ORDINALS: dict[str, int] = {"1st Year": 1, "2nd Year": 2, "3rd Year": 3, "4th Year": 4}

# Open-ended bucket multipliers: "< x" -> 0.5x, "> x" -> 1.25x.
OPEN_LOW_MULTIPLIER = 0.5
OPEN_HIGH_MULTIPLIER = 1.25
CENSORED_EXPENSE = 6250
CENSORED_ALLOWANCE = 3750

# Currency artefacts removed before and after compatibility folding, in this order.
CURRENCY_ARTEFACTS: tuple[str, ...] = (
    "₹",              # rupee sign
    "â‚¹",  # rupee sign as cp1252 mojibake
    "â,¹",       # hand-edited variant
    "â¹",        # latin-1 mojibake
    "؋",              # afghani sign
    "Rs.",
    "Rs",
    "INR",
    "$",
    "€",              # euro
    "£",              # pound
)

BUDGET_USAGE_MIN = 0
BUDGET_USAGE_MAX = 10000
SOURCE_TIMEZONE = "Asia/Kolkata"
MIN_REASONABLE_ROWS = 100
MAX_EXAMPLES = 5
IQR_MULTIPLIER = 1.5
MAX_SPAN_DAYS = 365
RECONCILE_TOLERANCE = 0.005

# Stage-4 quality checks (display headers).
MANDATORY_HEADERS: tuple[str, ...] = (
    "Timestamp", "Student Name", "Gender", "Degree", "Year of Study",
    "Accommodation", "Preferred Payment",
    "Food", "Transport", "Academic", "Other", "Allowance", "Total Expenses",
)
OPTIONAL_HEADERS: tuple[str, ...] = (
    "Specialization", "Background", "Work/Internship", "Track Digitally",
    "Budget Plan", "Study Focus", "UPI App",
)
MONEY_HEADERS: tuple[str, ...] = ("Food", "Transport", "Academic", "Other", "Allowance", "Total Expenses")
EXPENSE_HEADERS: tuple[str, ...] = ("Food", "Transport", "Academic", "Other")

SEVERITIES: tuple[str, ...] = ("CRITICAL", "WARNING", "INFO")

# Post-load verification expectations of the seed survey (parameters, overridable).
SEED_EXPECTATIONS: dict[str, object] = {
    "row_count": 213,
    "usage_range": (125.0, 8600.0),
    "savings_range": (-24000.0, -250.0),
    "total_range": (1500.0, 25000.0),
}

# --------------------------------------------------------------------------- #
# Derived lookups
# --------------------------------------------------------------------------- #

CANONICAL_COLUMNS: tuple[str, ...] = tuple(DISPLAY_NAMES)
DISPLAY_COLUMNS: tuple[str, ...] = tuple(DISPLAY_NAMES.values())
INSERT_COLUMNS: tuple[str, ...] = tuple(
    c for c in PUBLISHED_NAMES.values() if c not in GENERATED_PUBLISHED
)
PUBLISHED_COLUMNS: tuple[str, ...] = ("student_id",) + tuple(PUBLISHED_NAMES.values())
MONEY_SOURCE_COLUMNS: tuple[str, ...] = tuple(
    k for k, v in SHORT_NAMES.items() if v in MONEY_COLUMNS
)
