"""Money range labels -> numeric bucket midpoints, as pure Column expressions.

``strip_currency`` removes currency symbols and their mojibake, folds
compatibility characters, normalises dashes and keeps only what a range label
may contain.  ``parse_midpoint`` turns ``< x`` into ``0.5x``, ``> x`` into
``1.25x`` and ``a - b`` into the mean of the (possibly reversed) bounds.

Spark has no NFKC builtin. What it does to number labels is two tables, built from the
Unicode data at import: every code point whose compatibility form holds a character that
a label may keep, or that a currency artefact is made of.

* One character to one (full-width and mathematical digits, superscripts, no-break
  spaces, ...): one ``translate``. It also maps the dashes U+2010..U+2015 and U+2212 to
  ``-`` (no artefact holds a dash, so before the second artefact pass is as good as after
  it) and the decimal digits of all scripts to ASCII, because a Python ``float`` accepts
  them after NFKC.
* One character to several (two-digit circled numbers, fractions, digits with a point or
  in parentheses, ellipses, the rupee ligature): the table is appended to the text as a
  dictionary, and one pass replaces each such character by what a lookahead finds there.
  Only texts that hold one take this path.

Sequences that compose to another character (``<`` and U+0338) are left as they are.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import spec
from .columns import let


_DASHES = {chr(cp) for cp in (*range(0x2010, 0x2016), 0x2212)}
_SEP = "\x01"


def _build_fold_tables() -> tuple[dict[str, str], dict[str, str]]:
    wanted = set("<>.,- ") | _DASHES | set("".join(spec.CURRENCY_ARTEFACTS))
    one, many = {}, {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        folded = "".join("-" if x in _DASHES else str(unicodedata.decimal(x, x)) for x in unicodedata.normalize("NFKC", ch))
        if folded == ch or not any(x in wanted or x.isdecimal() for x in folded):
            continue
        if len(folded) == 1:
            one[ch] = folded
        elif folded.strip(" ") and any(x in wanted - {" "} or x.isdecimal() for x in folded):
            many[ch] = folded
    return one, many


_FOLD_ONE, _FOLD_MANY = _build_fold_tables()
_FOLD_SRC, _FOLD_DST = "".join(_FOLD_ONE), "".join(_FOLD_ONE.values())


def _char_class(chars) -> str:
    """A regex class of the characters, neighbours as ranges: each entry is a test that every character of a text goes through."""
    cps, out = sorted(map(ord, chars)), []
    for cp in cps:
        if out and out[-1][1] == cp - 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return "[" + "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in out) + "]"


_MANY_CLASS = _char_class(_FOLD_MANY)
_MANY_DICT = "".join(_SEP + ch + folded for ch, folded in _FOLD_MANY.items())
# The dictionary's own entries find no later entry of their character and stay.
_MANY_RE = rf"(?s)({_MANY_CLASS})(?=.*{_SEP}\1([^{_SEP}]*))"
# Any run of characters a label may not keep (whitespace included) becomes one space.
_DROP_RUN = r"(?U)[^\d<>.,\-]+"
_LABEL_RE = (
    r"(?U)^\s*(?:<\s*([\d.,]+)|>\s*([\d.,]+)|([\d.,]+)\s*-\s*([\d.,]+))\s*$"
)


def _overlap(a: str, b: str) -> bool:
    """True when occurrences of ``a`` and ``b`` can overlap without sharing a start."""
    for k in range(1, min(len(a), len(b))):
        if a[-k:] == b[:k] or b[-k:] == a[:k]:
            return True
    return (b in a and not a.startswith(b)) or (a in b and not b.startswith(a))


def _artefact_passes(artefacts) -> list[str]:
    """Group the ordered artefact list into regex alternations equivalent to replacing
    each artefact in turn: a pass never holds two artefacts that can overlap (those
    sharing a start are resolved by alternation order, which is list order)."""
    passes: list[list[str]] = [[]]
    for a in artefacts:
        if any(_overlap(a, b) for b in passes[-1]):
            passes.append([])
        passes[-1].append(a)
    return ["|".join(r"\Q" + a + r"\E" for a in group) for group in passes if group]


_ARTEFACT_PASSES = _artefact_passes(spec.CURRENCY_ARTEFACTS)


# Labels in one of the plain forms, read by one match: at most one artefact before and one after the amounts, no
# other characters. Nothing in them needs folding but the en dash and full-width forms, and no artefact can start inside
# an amount, so the artefact passes would find the same. Atomic groups: an artefact is what the passes' order makes it.
_WIDE_DIGITS = "".join(chr(0xFF10 + i) for i in range(10))
# the wide digits are a range: ten entries of a class are ten tests for every character
_PLAIN_NUM = "([0-9.,\uff10-\uff19]++)"
_ARTEFACT = "(?>" + "|".join(_ARTEFACT_PASSES) + ")"
_PLAIN_RE = (rf"^ *+(?:{_ARTEFACT} *+)?+(?:[<\uff1c] *+{_PLAIN_NUM}|[>\uff1e] *+{_PLAIN_NUM}|{_PLAIN_NUM} *+[-\u2013] *+{_PLAIN_NUM})"
             rf" *+(?:{_ARTEFACT} *+)?+\z")


def _drop_artefacts(c: Column) -> Column:
    for pattern in _ARTEFACT_PASSES:
        c = F.regexp_replace(c, pattern, " ")
    return c


def fold_compat(c: Column, source: Column | None = None) -> Column:
    """NFKC for number labels (see module docstring).

    ``source``, a column whose characters include those of ``c``, tells whether there is one to expand; without
    it ``c`` is computed once more for that.
    """
    folded = F.regexp_replace(F.concat(c, F.lit(_MANY_DICT)), F.lit(_MANY_RE), F.lit("$2"))
    several = F.substring(folded, F.lit(1), F.length(folded) - F.lit(len(_MANY_DICT)))
    return F.translate(F.when(F.regexp_like(c if source is None else source, F.lit(_MANY_CLASS)), several).otherwise(c), _FOLD_SRC, _FOLD_DST)


def strip_currency(c: Column, dtype: str = "string") -> Column:
    """Cleaned label text; a non-text column yields ``''`` as in the reference rule."""
    if dtype != "string":
        return F.lit("")
    # Plain ASCII (bytes = characters) needs no folding, and of its artefacts only the point of "Rs."
    # would survive the last pass.
    plain = F.trim(F.regexp_replace(F.replace(c, F.lit("Rs."), F.lit(" ")), r"[^0-9<>.,\-]+", " "))
    t = _drop_artefacts(c)
    t = fold_compat(t, source=c)  # also maps dashes to '-'
    t = _drop_artefacts(t)
    # "replace every disallowed character by a space, squeeze whitespace, trim" in one
    # pass: afterwards the only whitespace left is single U+0020, which ``trim`` removes.
    t = F.regexp_replace(t, _DROP_RUN, " ")
    return F.coalesce(F.when(F.octet_length(c) == F.length(c), plain).otherwise(F.trim(t)), F.lit(""))


def _num(token: Column) -> Column:
    return F.replace(token, F.lit(","), F.lit("")).try_cast("double")


def label_parts(clean: Column) -> Column:
    """The label's four possible numbers (after ``<``, after ``>``, from, to) from one match; one entry if none matches."""
    return F.split(F.regexp_replace(clean, _LABEL_RE, "$1|$2|$3|$4"), r"\|", -1)


def midpoint_from_parts(p: Column) -> Column:
    """``< x`` -> 0.5x, ``> x`` -> 1.25x, ``a - b`` -> (a + b) / 2; NULL when nothing matched."""
    g1, g2, g3, g4 = (F.get(p, F.lit(i)) for i in range(4))
    return F.when(F.size(p) == 4, F.when(g1 != "", _num(g1) * F.lit(spec.OPEN_LOW_MULTIPLIER))
                  .when(g2 != "", _num(g2) * F.lit(spec.OPEN_HIGH_MULTIPLIER))
                  .when((g3 != "") & (g4 != ""), (_num(g3) + _num(g4)) / F.lit(2.0)))


def _plain_match(c: Column) -> Column:
    """A label beside its one or two numbers with a bar behind the first, if it is in a plain form (else twice)."""
    return F.struct(c.alias("label"), F.regexp_replace(c, _PLAIN_RE, "$1$2$3|$4").alias("match"))


def _midpoint_of_match(m: Column) -> Column:
    """The label's midpoint, without the cleaning chain where ``_plain_match`` read it: by plain cuts, as a list of parts costs more than the match."""
    label, match = m["label"], m["match"]
    narrow = F.when(F.octet_length(match) == F.length(match), match).otherwise(F.translate(match, _WIDE_DIGITS, "0123456789"))
    one = _num(F.substring_index(narrow, "|", 1))
    plain = F.when(~match.endswith("|"), (one + _num(F.substring_index(narrow, "|", -1))) / F.lit(2.0)) \
        .when(label.contains("<") | label.contains("\uff1c"), one * F.lit(spec.OPEN_LOW_MULTIPLIER)).otherwise(one * F.lit(spec.OPEN_HIGH_MULTIPLIER))
    # no plain form holds the bar that a match puts in, so a match is never the label itself
    return F.when(match != label, plain).when(label.isNotNull(), let(label_parts(strip_currency(label)), midpoint_from_parts))


def parse_midpoint(c: Column, dtype: str = "string") -> Column:
    """Midpoint (double) of one money label; numbers pass through; anything else is NULL.

    A single-expression form; for whole columns prefer ``with_midpoints``, which
    evaluates the cleaning chain once per cell.
    """
    if dtype != "string":
        return c.cast("double")
    return F.when(c.isNotNull(), midpoint_from_parts(label_parts(strip_currency(c))))


def _per_cell(columns: list[str], *steps) -> Column:
    """An array with the steps' result for each cell; one copy of the steps, each result computed once.

    The steps are lambdas over an array, so they stay out of the generated code: five copies of the cleaning
    chain made one method of 38,000 bytecodes, and the JVM only interprets methods of more than 8,000.
    """
    cells = F.array(*[F.col(f"`{c}`") for c in columns])
    for step in steps:
        cells = F.transform(cells, step)
    return cells


def with_stripped(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add ``out -> strip_currency(in)`` columns."""
    types = dict(df.dtypes)
    text = [o for o, i in columns.items() if types[i] == "string"]
    out = {o: strip_currency(F.col(f"`{i}`"), types[i]) for o, i in columns.items() if o not in text}
    if not text:
        return df.withColumns(out)
    step = df.withColumn("__cells", _per_cell([columns[o] for o in text], lambda c: strip_currency(c)))
    return step.withColumns({**out, **{o: F.get("__cells", F.lit(k)) for k, o in enumerate(text)}}).drop("__cells")


def with_midpoints(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add ``out -> midpoint(in)`` columns, the labels in two steps per cell: match, compute (from the cleaned label, where no plain form)."""
    types = dict(df.dtypes)
    text = [o for o, i in columns.items() if types[i] == "string"]
    out = {o: F.col(f"`{i}`").cast("double") for o, i in columns.items() if o not in text}
    if not text:
        return df.withColumns(out)
    step = df.withColumn("__cells", _per_cell([columns[o] for o in text], _plain_match, _midpoint_of_match))
    return step.withColumns({**out, **{o: F.get("__cells", F.lit(k)) for k, o in enumerate(text)}}).drop("__cells")
