"""Question parsing as Spark jobs: hand-written readings of our own questions, and the carry-over rule."""

import random

import pytest

from censusflow.functions import vocabulary as V
from censusflow.operators import intents as N
from censusflow.operators.carry_over import carry_over
from censusflow.sources.questions import QUESTIONS

# question: (measure, aggregation, dimensions, filters, ranking, row limit)
READINGS = {
    "mean total expenses per degree": ("total_expenses", "avg", ["degree"], [], None, 50),
    "what is the median allowance by gender": ("allowance", "median", ["gender"], [], None, 50),
    "number of students by preferred payment": ("student_count", "count", ["preferred_payment"], [], None, 50),
    "maximum transport expenses for 2nd year students": ("transport_expenses", "avg", [], [("year_of_study", "2nd Year", False)], "desc", 1),
    "sum of academic expenses by study focus": ("academic_expenses", "avg", ["study_focus"], [], None, 50),
    "other expenses by degree and gender": ("other_expenses", "avg", ["degree", "gender"], [], None, 50),
    "least allowance among rural students": ("allowance", "avg", [], [("background", "Rural", False)], "asc", 1),
    "students without a budget plan": (None, None, [], [], None, 50),
    "list B.E. and b.sc. students, not PG": (None, "", [], [("degree", "BE / B.Tech", False), ("degree", "BSc", False), ("accommodation", "PG", True)], None, 50),
    "top upi app among students who don't pay cash; apps by apps": ("student_count", "count", ["upi_app"], [("preferred_payment", "UPI", False), ("preferred_payment", "Cash", False)], "desc", 50),
    "xb.e.x 1sty cashier men's": (None, None, [], [("gender", "Male", False)], None, 50),
}


@pytest.fixture(scope="module")
def rows(spark):
    qs = list(dict.fromkeys([*QUESTIONS, *READINGS, "", "list female students not living in pg", "compare food expenses of urban versus rural students", "top 4 upi apps"]))
    df = spark.createDataFrame([(0, i, q) for i, q in enumerate(qs)], "conv_id long, turn long, question string")
    return {qs[r["turn"]]: r for r in N.parse_questions(df).collect()}


@pytest.mark.parametrize("question", sorted(READINGS))
def test_reading(rows, question):
    r = rows[question]
    got = (r["measure"], r["aggregation"], list(r["dimensions"]), [tuple(f) for f in r["filters"]], r["ranking"], r["row_limit"])
    for have, want in zip(got, READINGS[question]):
        assert have == want, (question, got)


def test_details_comparisons_and_refusals(rows):
    r = rows["list female students not living in pg"]
    assert r["detail"] and sorted(tuple(f) for f in r["filters"]) == [("accommodation", "PG", True), ("gender", "Female", False)]
    r = rows["compare food expenses of urban versus rural students"]
    assert r["compare_dim"] == "background" and list(r["compare_values"]) == ["Rural", "Urban"]
    assert rows["top 4 upi apps"]["row_limit"] == 4
    for q in ("is it going to rain tomorrow", "qwerty uiop", ""):
        assert rows[q]["refused"], q


def talk(spark, *turns):
    df = spark.createDataFrame([(1, i, q) for i, q in enumerate(turns)], "conv_id long, turn long, question string")
    return {r["turn"]: r for r in carry_over(N.parse_questions(df)).collect()}


def test_follow_ups_narrow(spark):
    out = talk(spark, "mean total expenses per degree", "now only the rural ones", "ok", "just those paying cash", "qwerty uiop")
    assert set(out) == {0, 1, 3}  # neither a confirmation nor a refused turn is an answer
    assert not out[0]["carried"] and out[0]["filters"] == ""
    assert (out[1]["measure"], out[1]["dimensions"], out[1]["filters"], out[1]["carried"]) == ("total_expenses", "degree", "background=Rural", True)
    assert (out[3]["measure"], out[3]["dimensions"], out[3]["filters"]) == ("total_expenses", "degree", "background=Rural;preferred_payment=Cash")


def test_a_turn_that_inherits_nothing_starts_afresh(spark):
    out = talk(spark, "average expenses by degree urban", "average allowance by gender rural", "and those in hostel")
    assert (out[1]["measure"], out[1]["dimensions"], out[1]["filters"], out[1]["carried"]) == ("allowance", "gender", "background=Rural", False)
    assert (out[2]["filters"], out[2]["dimensions"], out[2]["carried"]) == ("accommodation=Hostel;background=Rural", "gender", True)


def plain(turns):
    """The rule turn by turn, over dicts."""
    out, state = [], None
    for t in turns:
        if t["refused"]:
            continue
        new, why = {"m": t["measure"], "a": t["aggregation"], "d": t["dimensions"], "f": t["filters"]}, []
        if state is not None:
            scoped = dict(new)
            if t["measure"] is None and not t["detail"]:
                if state["m"] is not None:
                    scoped["m"], scoped["a"] = state["m"], state["a"]
                    why.append("measure")
                elif state["f"] or state["d"]:
                    scoped["d"] = state["d"]
                    why += ["grouping"] * bool(state["d"])
            if not scoped["d"] and state["d"] and t["compare_dim"] is None:
                scoped["d"] = state["d"]
                why.append("grouping")
            seen = {}
            for f in state["f"] + t["filters"]:
                seen.setdefault(f[0], f)
            scoped["f"] = list(seen.values())
            if len(seen) > len(t["filters"]):
                why.append("filters")
            new = scoped if why else new
        state = new
        text = ";".join(f"{d}{'!=' if n else '='}{v}" for d, v, n in sorted(state["f"]))
        out.append((t["conv_id"], t["turn"], state["m"], state["a"], ",".join(state["d"]), text, bool(why)))
    return out


PARSED = ("conv_id long, turn long, question string, measure string, aggregation string, dimensions array<string>, "
          "filters array<struct<dim:string,value:string,negated:boolean>>, compare_dim string, detail boolean, refused boolean")


def random_turns(rng, conv, n):
    dims = [d for d, _, _ in V.DIMENSIONS[:4]]
    turns = []
    for k in range(n):
        m = rng.choice([None, None, "allowance", "savings"])
        filters = [(rng.choice(dims), rng.choice("xyz"), rng.random() < 0.3) for _ in range(rng.choice([0, 0, 0, 1, 1, 2, 4]))]
        turns.append({"conv_id": conv, "turn": k, "question": f"q{k}", "measure": m, "aggregation": rng.choice([None, "avg", "sum"]), "dimensions": rng.choice([[], [], ["gender"], ["degree", "gender"]]),
                      "filters": filters, "compare_dim": rng.choice([None, None, "gender"]), "detail": rng.random() < 0.2, "refused": rng.random() < 0.1})
    return turns


@pytest.mark.parametrize("width", [2, 3, 256])
def test_blocked_scan_equals_the_plain_rule(spark, width):
    rng = random.Random(width)
    talks = [random_turns(rng, c, n) for c, n in enumerate([1, 2, 3, 5, 9, 20, 40, 90, 0] + [6] * 25)]
    rows = [t for talk_ in talks for t in talk_]
    rng.shuffle(rows)
    got = carry_over(spark.createDataFrame(rows, PARSED).repartition(5), width=width).collect()
    assert sorted(map(tuple, got)) == sorted(r for talk_ in talks for r in plain(talk_))


def test_a_long_conversation_is_many_blocks(spark):
    turns = random_turns(random.Random(8), None, 800)
    got = carry_over(spark.createDataFrame(turns, PARSED), width=16).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == plain(turns)


def test_no_turns(spark):
    assert carry_over(spark.createDataFrame([], PARSED)).count() == 0


def test_null_empty_and_long_texts(spark):
    turns = [(2, 0, None), (2, 1, "is it going to rain tomorrow"), (2, 2, ""), (3, 0, "so " * 4000 + "what is the median allowance by gender"), (3, 1, "rural " * 3000)]
    rows = {(r.conv_id, r.turn): r for r in N.intents_flat(N.parse_questions(spark.createDataFrame(turns, "conv_id long, turn long, question string"))).collect()}
    assert rows[2, 0].refused and rows[2, 1].refused and rows[2, 2].refused
    assert (rows[3, 0].measure, rows[3, 0].aggregation, rows[3, 0].dimensions) == ("allowance", "median", "gender")
    assert rows[3, 1].filters == "background=Rural" and not rows[3, 1].refused
