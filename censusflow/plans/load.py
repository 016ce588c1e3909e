"""The gated load: clean, transform, split rejects, pre-load rules, quality gate, publish, verify.

Rows that cannot be stored never reach the table: a money label that does not convert, or a broken table
constraint, sends the row to the reject table with its reasons. The rest is checked by the pre-load rules
and the quality gate; a blocking finding raises before anything is published. Nothing is dropped silently:
accepted and rejected rows must add up to the cleaned ones. The table changes in one step, after the written rows were
counted and verified.

``load_survey`` is eager: every step writes its rows, so a lost executor re-reads files, and the gate sees
exactly what is published.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col_of
from ..operators import gate_state as G
from ..operators import publish as L
from ..operators import quality as Q
from ..operators.clean import clean_survey
from ..operators.transform import display_frame, flag_money, shorten_names, transform_survey
from ..sources.artifacts import artifact_path, written
from ..sources.versions import LoadCountMismatch, current_version, manifest, publish_version
from .view import publish_projection

KEY = "response_id"


class LoadRefused(RuntimeError):
    """The frame as a whole breaks a pre-load rule; ``problems`` has (rule, column, offending, up to five examples)."""

    def __init__(self, problems: list[tuple]):
        super().__init__("the load was refused: " + "; ".join(f"{r} {c} ({n}{', such as ' + repr(e) if e else ''})" for r, c, n, e in problems))
        self.problems = problems


@dataclass(frozen=True)
class Load:
    published: DataFrame
    rejected: DataFrame   # key, reasons
    results: DataFrame    # quality results
    alerts: list[str]     # checks that failed without blocking
    checks: DataFrame     # post-load verification


class VerificationFailed(RuntimeError):
    """The table as it would be fails a check of the post-load verification; ``checks`` has their names."""

    def __init__(self, checks: list[str]):
        super().__init__(f"the written table fails: {checks}")
        self.checks = checks


ROW = "load_row"  # a whole row beside its text
#: Folder beside a table's parts, and name in its manifests, of the states of its loads' checks.
GATE = "gate"


def split_rows(cleaned: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(accepted display frame, rejects with ``key`` and ``reasons``) of a cleaned survey.

    Reasons are found row by row and written beside the rows, so repeated and null keys are split like any other, neither
    side evaluates the label parser again, and nothing is shuffled.
    """
    parsed = written(flag_money(shorten_names(cleaned)), "load-parsed")
    readable = parsed.filter("failed_columns = ''").drop("failed_columns")
    display = display_frame(transform_survey(readable), passthrough=(key,))
    whole = display.withColumn(ROW, F.struct(*[col_of(c) for c in display.columns]))
    staged = written(L.checked_rows(L.loader_frame(whole, ROW), ROW).select(f"{ROW}.*", "violations"), "load-staged")
    unread = parsed.filter("failed_columns <> ''").select(key, F.concat(F.lit("money:"), "failed_columns").alias("reasons"))
    broken = staged.filter("violations <> ''").select(key, F.col("violations").alias("reasons"))
    rejected = written(unread.unionByName(broken), "load-rejected")
    return staged.filter("violations = ''").drop("violations"), rejected


def preload_problems(display: DataFrame, key: str = KEY) -> DataFrame:
    """(rule, column, offending) of all pre-load rules that find something."""
    text = L.loader_frame(display, key)
    parts = [L.preload_blanks(text), L.preload_domains(text), L.preload_money(text), L.preload_usage(text), L.preload_name(text), L.preload_arithmetic(text)]
    columns = list(L.PROBLEM_COLUMNS)
    out = parts[0].select(columns)
    for p in parts[1:]:
        out = out.unionByName(p.select(columns))
    return out


def verify_with(expected: dict | None):
    """A verification for ``publish_version``: derived columns must be consistent, and what ``expected`` names must hold."""
    stated = {"row_count": "row_count", "usage_range": "budget_usage_pct_range", "savings_range": "savings_range", "total_range": "total_expenses_range"}
    must = {"generated_columns_consistent", *(stated[k] for k in expected or {} if k in stated)}

    def verify(table: DataFrame) -> None:
        failed = [r["name"] for r in L.verify_load(table, expected).collect() if not r["ok"] and r["name"] in must]
        if failed:
            raise VerificationFailed(failed)
    return verify


def load_survey(raw: DataFrame, path: str, policy: str = "report", as_of: str | None = None, expected: dict | None = None, key: str = KEY,
                append: bool = False, own: Iterable[Q.OwnCheck] = ()) -> Load:
    """Load a raw export into the table at ``path`` (``sources.versions``), replacing it or, with ``append``, adding to it.

    Raises ``KeyError`` for missing columns, ``LoadRefused`` for pre-load problems other than blanks in
    optional columns (those are the gate's business), ``QualityCheckFailed`` where the gate blocks,
    ``LoadCountMismatch`` where rows go missing and ``VerificationFailed`` where the table as it would be is not what
    ``expected`` says. Whatever raises, the table stays as it was.

    Each load leaves the state of its checks (``operators.gate_state``) beside the table, and the gate judges an append
    over all rows by the states of the table's loads. Rows that came into the table otherwise have no state and are not seen. ``own`` are the
    caller's checks; all loads of a table must have the same.
    """
    own = tuple(own)
    cleaned = written(clean_survey(raw), "load-cleaned")
    accepted, rejected = split_rows(cleaned, key)
    accepted = written(accepted, "load-accepted")
    absent = [c for rule, c in L.preload_columns(accepted) if rule == "missing"]
    if absent:
        raise KeyError(f"the table needs columns {absent}")
    n_clean, n_in, n_bad = cleaned.count(), accepted.count(), rejected.count()
    if n_in + n_bad != n_clean:
        raise LoadCountMismatch(f"{n_clean} rows were cleaned, {n_in} accepted and {n_bad} rejected")
    # at most one row per rule and column
    problems = [tuple(r) for r in preload_problems(accepted, key).filter("rule <> 'blank'").collect()]
    if problems:
        examples = {(r["rule"], r["column"]): r["examples"] for r in L.problem_examples(accepted, key=key).collect()}
        raise LoadRefused([(*p, examples.get(p[:2], [])) for p in problems])
    spark = accepted.sparkSession
    state = G.read_states(spark, [G.write_state(G.gate_state(accepted, as_of, key=key, own=own), artifact_path(spark, "load-gate"))])
    number = current_version(spark, path) if append else 0
    before = manifest(spark, path, number).get("notes", {}).get(GATE, []) if number else []
    every = G.union_states([G.read_states(spark, [f"{path.rstrip('/')}/{x}" for x in before]), state]) if before else state
    results = written(G.state_findings(every, as_of, own=own), "load-quality")
    Q.enforce_gate(results, policy)
    blocking = ["CRITICAL", "WARNING"] if policy == "strict" else ["CRITICAL"]
    alerts = [r["name"] for r in results.filter(~F.col("passed") & ~F.col("severity").isin(*blocking) & (F.col("severity") != "INFO")).select("name").collect()]
    kept = f"{GATE}/{uuid.uuid4().hex}"
    G.write_state(state, f"{path.rstrip('/')}/{kept}")
    published = publish_version(publish_projection(accepted, key), path, append=append, verify=verify_with(expected), expected_rows=n_in, notes={GATE: [kept]})
    return Load(published, rejected, results, alerts, L.verify_load(published, expected))
