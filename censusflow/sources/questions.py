"""Questions of the question-log fixture."""

QUESTIONS: tuple[str, ...] = (
    "mean total expenses per degree",
    "what is the median allowance by gender",
    "show the ten biggest spenders in hostel",
    "which accommodation has the lowest average food expenses",
    "number of students by preferred payment",
    "compare food expenses of urban versus rural students",
    "students without a budget plan",
    "top 4 upi apps",
    "maximum transport expenses for 2nd year students",
    "sum of academic expenses by study focus",
    "budget usage for day scholars by year of study",
    "list female students not living in pg",
    "how many mba students track digitally",
    "least allowance among rural students",
    "average savings by background",
    "other expenses by degree and gender",
    "top three degrees by total spend",
    "is it going to rain tomorrow",
    "qwerty uiop",
    "now only the rural ones",
    "just those paying cash",
    "ok",
    "highest allowance",
)
