"""Column-expression helpers shared by every stage.

All helpers return ``pyspark.sql.Column`` objects built from built-in functions,
so they stay inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java regex: (?U) makes \s Unicode-aware, so NBSP and other spaces are trimmed
# (plain ``trim`` only removes U+0020).
_EDGE_SPACE = r"(?U)^\s+|\s+$"
_NONSPACE = r"(?U)\S"

# A plain decimal number as pandas ``to_numeric`` accepts it, without the
# ``1d`` / ``Infinity`` forms that a Spark cast would also take.
NUMBER_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def col_of(name: str) -> Column:
    """Reference a column whose name may hold spaces, dots or slashes."""
    return F.col("`" + name.replace("`", "``") + "`")


def ustrip(c: Column) -> Column:
    """Trim Unicode whitespace at both ends (NULL stays NULL)."""
    return F.regexp_replace(c.cast("string"), _EDGE_SPACE, "")


def is_blank(c: Column) -> Column:
    """NULL or nothing but Unicode whitespace (never NULL itself)."""
    return ~nonblank(c)


def nonblank(c: Column) -> Column:
    # a search that ends at the first character that is no space, instead of a trimmed copy
    return F.coalesce(c.cast("string").rlike(_NONSPACE), F.lit(False))


def blank_to_null(c: Column) -> Column:
    """Trimmed text, NULL when blank."""
    return F.when(nonblank(c), ustrip(c))


def numeric(c: Column, dtype: str = "string") -> Column:
    """Double value of a column: numbers pass through, text is parsed strictly."""
    if dtype != "string":
        return c.cast("double")
    s = c.cast("string")
    return F.when(s.rlike(NUMBER_RE), s.try_cast("double"))


def unparseable(c: Column, dtype: str = "string") -> Column:
    """Non-blank but not a number (what ``to_numeric(errors='coerce')`` turns to NaN)."""
    if dtype != "string":
        return F.lit(False)
    return nonblank(c) & numeric(c, dtype).isNull()


def idiv(a: Column, b: Column) -> Column:
    """SQL integral division (truncating), NULL when ``b`` is 0."""
    return F.when(b != 0, F.call_function("div", a, b))


# Exact intermediate type: 38 digits cover sums of 10^11 rows of 6-digit amounts
# multiplied by a count, which a 64-bit long would not.
_EXACT = "decimal(38,0)"


def let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` computed once, outside the generated code (a method of over 8,000 bytecodes is only interpreted)."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def round_half_even_ratio(num: Column, den: Column, scale: int) -> Column:
    """``round(num/den, scale)``, ties to even, exact for integer inputs; NULL if den is 0."""
    p = 10 ** scale
    given = F.struct(num.cast(_EXACT).alias("n"), den.cast(_EXACT).alias("d"))

    def of(n: Column, d: Column) -> Column:
        a, b = F.abs(n), F.abs(d)

        def rounded(q: Column) -> Column:
            r = a - q * b
            return q + F.when((r * 2 > b) | ((r * 2 == b) & (q % 2 == 1)), 1).otherwise(0)
        sign = F.when((n < 0) != (d < 0), -1).otherwise(1)
        return F.when(d != 0, (sign * let(idiv(a, b), rounded)).cast("double") / F.lit(float(p)))

    def ratio(x: Column) -> Column:
        n, d = x["n"], x["d"]
        # numbers that stay well inside 64 bits need no wide decimals, whose division is some ten times as slow
        limit = F.lit(10 ** (17 - scale))
        small = n.between(-limit, limit) & d.between(-limit, limit)
        longs = F.struct((n.cast("long") * F.lit(p).cast("long")).alias("n"), d.cast("long").alias("d"))
        return F.when(small, let(longs, lambda y: of(y["n"], y["d"]))).otherwise(of(n * F.lit(p), d))
    return let(given, ratio)


def round_half_even_longs(num: Column, den: Column, scale: int) -> Column:
    """``round_half_even_ratio`` of two long columns: plain arithmetic where 64 bits suffice, the wide form elsewhere."""
    p = 10 ** scale
    limit = F.lit(10 ** (17 - scale))
    small = num.between(-limit, limit) & den.between(-limit, limit)
    a, b = F.abs(num * F.lit(p).cast("long")), F.abs(den)
    q, r = idiv(a, b), a % b
    up = F.when((r * 2 > b) | ((r * 2 == b) & (q % 2 == 1)), 1).otherwise(0)
    sign = F.when((num < 0) != (den < 0), -1).otherwise(1)
    return F.when(small, F.when(den != 0, (sign * (q + up)).cast("double") / F.lit(float(p)))) \
        .otherwise(round_half_even_ratio(num, den, scale))


def round_half_up_ratio(num: Column, den: Column, scale: int) -> Column:
    """``round(num/den, scale)``, ties away from zero (SQL ``round``), exact for integers."""
    p = 10 ** scale
    n = num.cast(_EXACT) * F.lit(p)
    d = den.cast(_EXACT)
    a, b = F.abs(n), F.abs(d)
    q = idiv(a * 2 + b, b * 2)
    sign = F.when((n < 0) != (d < 0), -1).otherwise(1)
    return F.when(d != 0, (sign * q).cast("double") / F.lit(float(p)))


def pct(num: Column, den: Column, scale: int = 1) -> Column:
    """``round(100 * num / den, scale)`` half-up on integer counts."""
    return round_half_up_ratio(num.cast(_EXACT) * 100, den, scale)


def any_of(cols: Iterable[Column]) -> Column:
    out = None
    for c in cols:
        out = c if out is None else (out | c)
    return out if out is not None else F.lit(False)


def all_of(cols: Iterable[Column]) -> Column:
    out = None
    for c in cols:
        out = c if out is None else (out & c)
    return out if out is not None else F.lit(True)


def count_if(cond: Column) -> Column:
    """Count rows where ``cond`` is true (NULL counts as false), as long."""
    return F.count(F.when(cond, F.lit(1)))


def median_disc(name: str) -> Column:
    """Exact discrete median of a column (first value whose cumulative share reaches 0.5).

    ``percentile_disc`` keeps a value->count map per group, so its memory grows
    with the number of distinct values, not rows; bucket midpoints have a handful.
    """
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{name}`)").cast("double")
