"""Label cleaning and midpoints (the reference's own vectors), rounding rules."""

from pyspark.sql import functions as F

from censusflow.functions.columns import round_half_even_ratio, round_half_up_ratio
from censusflow.functions.money import parse_midpoint, strip_currency, with_midpoints
from censusflow.oracle_stages import strip_label

# (label, cleaned text, midpoint)
VECTORS = [
    ("1000 - 2000 ₹", "1000 - 2000", 1500.0),
    ("4000 - 5000 ₹", "4000 - 5000", 4500.0),
    ("2000 - 3000 ₹", "2000 - 3000", 2500.0),
    ("500 - 1500 ₹", "500 - 1500", 1000.0),
    ("< 1000 ₹", "< 1000", 500.0),
    ("< 500 ₹", "< 500", 250.0),
    ("> 5000 ₹", "> 5000", 6250.0),
    ("> 3000 ₹", "> 3000", 3750.0),
    ("1,000 - 2,000 ₹", "1,000 - 2,000", 1500.0),
    ("1000 - 2000 â,¹", "1000 - 2000", 1500.0),
    ("not a number", "", None),
    ("1500", "1500", None),                       # bare number text is not a label
    ("Rs. 2000 – 1000", "2000 - 1000", 1500.0),   # en dash, reversed bounds
    ("  1000-2000INR  ", "1000-2000", 1500.0),
    ("１０００ - ２０００", "1000 - 2000", 1500.0),  # full-width digits
    ("＞ ５０００", "> 5000", 6250.0),
    ("₨ 500 - 1000", "500 - 1000", 750.0),       # rupee ligature folds to Rs
    ("1000 - 2000 â‚¹", "1000 - 2000", 1500.0),
    ("$ < 500 €", "< 500", 250.0),
    ("INRs 500 - 1000", "500 - 1000", 750.0),   # Rs goes before INR, as in sequential replacement
]


def test_strip_and_midpoint(spark):
    rows = [(v[0],) for v in VECTORS]
    df = spark.createDataFrame(rows, "label string")
    got = df.select("label", strip_currency(F.col("label")).alias("clean"),
                    parse_midpoint(F.col("label")).alias("mid")).collect()
    for (label, clean, mid), r in zip(VECTORS, got):
        if clean is not None:
            assert r["clean"] == clean, label
            assert r["clean"] == strip_label(label), label  # agrees with true NFKC
        if clean is not None or mid is not None:
            assert r["mid"] == mid, label


def test_artefact_order_matches_sequential_replace(spark):
    # INR must be removed after Rs, exactly as sequential replacement does.
    for label in ("INRs 500 - 1000", "Rs.INR< 500", "â‚¹â¹ 1000 - 2000"):
        r = spark.createDataFrame([(label,)], "label string").select(strip_currency(F.col("label"))).first()[0]
        assert r == strip_label(label), label


def test_numbers_pass_through_and_nulls(spark):
    df = spark.createDataFrame([(1500, None)], "n long, s string")
    r = df.select(parse_midpoint(F.col("n"), "bigint").alias("a"), parse_midpoint(F.col("s")).alias("b")).first()
    assert r["a"] == 1500.0 and r["b"] is None
    m = with_midpoints(df, {"x": "n", "y": "s"}).first()
    assert m["x"] == 1500.0 and m["y"] is None


def test_half_even_and_half_up(spark):
    df = spark.createDataFrame([(1805, 2000), (1815, 2000), (-1805, 2000), (7, 0)], "t long, a long")
    r = df.select(round_half_even_ratio(F.col("t") * 100, F.col("a"), 1).alias("even"),
                  round_half_up_ratio(F.col("t") * 100, F.col("a"), 1).alias("up")).collect()
    assert [x["even"] for x in r] == [90.2, 90.8, -90.2, None]
    assert [x["up"] for x in r] == [90.3, 90.8, -90.3, None]


def test_strip_matches_sequential_rule_on_random_labels(spark):
    # Random mixtures of artefacts, folded forms, dashes, spaces and digits must clean
    # exactly as the sequential replace + NFKC rule does.
    import random
    pieces = ["₹", "â‚¹", "â,¹", "â¹", "؋", "Rs.", "Rs", "R", "s", ".", "INR", "I", "N", "$", "€", "£",
              "₨", "Ｒ", "ｓ", "ＩＮＲ", "＄", "１", "０", "５", "，", "．", "－", "＜", "＞", "¹", "²",
              "–", "—", "−", "‐", " ", "  ", " ", "　", "\t", "<", ">", "-", ",", "0", "1", "5",
              "1000", "2,000", "x", "ab"]
    # (digits of other scripts are left out: the fold maps them to ASCII on purpose, NFKC keeps them)
    rng = random.Random(7)
    labels = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    got = [r[0] for r in df.select(strip_currency(F.col("label"))).collect()]
    bad = [(x, g, strip_label(x)) for x, g in zip(labels, got) if g != strip_label(x)]
    assert not bad, bad[:5]


def test_every_code_point_that_folds_to_kept_characters(spark):
    import sys
    import unicodedata
    keep = lambda s: any(x.isdecimal() or x in "<>.,-\u2010\u2011\u2012\u2013\u2014\u2015\u2212" for x in s)
    points = [chr(cp) for cp in range(0x80, sys.maxunicode + 1)
              if not 0xD800 <= cp <= 0xDFFF and keep(unicodedata.normalize("NFKC", chr(cp)))]
    assert len(points) > 700 and {"\u2469", "\u00bd", "\U0001d7d8", "\u2488"} <= set(points)
    labels = [form.format(ch) for ch in points for form in ("{0}", "< 1{0}", "{0}{0} - 2{0}5", "\x01{0}7")]
    labels += ["\U0001d411\U0001d42c. 500 - 1000", "\u24c7\u24e2. 5", "\u2460\u24ea\u246a\u00bd \u2026 9"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in labels], "label string").select(strip_currency(F.col("label"))).collect()]
    ascii_digits = lambda s: "".join(str(unicodedata.decimal(x, x)) for x in s)
    bad = [(x, g, strip_label(x)) for x, g in zip(labels, got) if g != ascii_digits(strip_label(x))]
    assert not bad, (len(bad), bad[:5])
    mid = spark.createDataFrame([("\u2469\u24ea - \u2473\u24ea",)], "label string").select(parse_midpoint(F.col("label"))).first()[0]
    assert mid == 150.0


def test_plain_labels_skip_the_cleaning_chain_with_the_same_amounts(spark):
    import random

    from censusflow.functions.money import _PLAIN_RE
    from censusflow.sources.binding import ALLOWANCE_BUCKETS, EXPENSE_BUCKETS, _label_renderings
    rendered = _label_renderings(EXPENSE_BUCKETS) + _label_renderings(ALLOWANCE_BUCKETS)
    edges = ["₹", "â‚¹", "â,¹", "â¹", "؋", "Rs.", "Rs", "INR", "$", "€", "", " ", "¹", "\x01", "|", "\n"]
    numbers, signs = ["5", "１０", ".", "1,000", "2.5", ",", ""], ["-", "–", " - ", "<", "> ", "＜", "−", ""]
    rng = random.Random(3)
    mixed = ["".join(rng.choice(x) for x in (edges, signs, numbers, signs, numbers, [" ", ""], edges, edges)) for _ in range(4000)]
    df = spark.createDataFrame([(x,) for x in rendered + mixed], "label string")
    assert df.limit(len(rendered)).filter(~F.regexp_like("label", F.lit(_PLAIN_RE))).count() == 0
    both = with_midpoints(df, {"mid": "label"}).withColumn("chain", parse_midpoint(F.col("label")))
    assert both.filter(~F.col("mid").eqNullSafe(F.col("chain"))).collect() == []


def test_plain_labels_give_their_numbers_by_plain_cuts(spark):
    # a match was four parts behind a mark, split into a list for every label
    from censusflow.functions.money import _plain_match
    labels = {"< 1,000 ₹": ("1,000|", 500.0), "＞ ５０００": ("５０００|", 6250.0), "Rs. 2000 – 1000": ("2000|1000", 1500.0), "１０ - 5": ("１０|5", 7.5),
              ", - 5": (",|5", None), "1.2.3 - 5": ("1.2.3|5", None), "5|": ("5|", None), "1|2": ("1|2", None), "|": ("|", None), "> 5|": ("> 5|", 6.25), "about 2k": ("about 2k", None)}
    df = with_midpoints(spark.createDataFrame([(x,) for x in labels], "label string"), {"mid": "label"})
    got = df.select("label", _plain_match(F.col("label"))["match"].alias("match"), "mid").collect()
    assert {r.label: (r.match, r.mid) for r in got} == labels
    assert df.filter(~F.col("mid").eqNullSafe(parse_midpoint(F.col("label")))).count() == 0


def test_usage_ratio_beyond_64_bits_and_whole_cents(spark):
    import random
    from censusflow.sources.binding import _whole
    rng = random.Random(4)
    pairs = [(rng.randint(-10**e, 10**e), rng.choice([-1, 1]) * rng.randint(1, 10**f)) for e in (2, 5, 12, 16, 17, 18) for f in (1, 4, 16, 18) for _ in range(20)]
    pairs += [(10**16, 1), (10**16 + 1, 3), (-10**16, 7), (25, 100), (35, 100), (0, 5), (5, 0)]
    got = spark.createDataFrame(pairs, "t long, a long").select("t", "a", round_half_even_ratio(F.col("t"), F.col("a"), 1).alias("r")).collect()
    for t, a, r in got:
        if a == 0:
            assert r is None
            continue
        n, d = abs(t) * 10, abs(a)
        q, rest = divmod(n, d)
        q += 2 * rest > d or (2 * rest == d and q % 2 == 1)
        assert r == float(-q if (t < 0) != (a < 0) else q) / 10.0, (t, a)
    values = [0.49999999999999994, -0.49999999999999994, 0.5, -0.5, 1.5, 2.0**52 + 0.5, 2.0**53 + 2, 1e17, None, *(rng.randint(0, 10**7) / 100 * 100 for _ in range(500)), *(i + 0.5 for i in range(-9, 9))]
    v = spark.createDataFrame([(x,) for x in values], "v double")
    assert v.filter(~_whole(F.col("v")).eqNullSafe(F.round("v").cast("long"))).collect() == []


def test_usage_ratio_of_longs(spark):
    import random
    from censusflow.functions.columns import round_half_even_longs
    rnd, edge = random.Random(5), 10 ** 16
    few = [None, 0, 1, -1, 2, -3, 8, 20, edge, -edge, edge + 1, 3 * 10 ** 17]
    pairs = [(t, a) for t in few for a in few] + [(rnd.randrange(-10 ** 6, 10 ** 6), rnd.randrange(-5000, 5000)) for _ in range(2000)]
    df = spark.createDataFrame(pairs, "t long, a long").select(
        round_half_even_longs(F.col("t"), F.col("a"), 1).alias("plain"), round_half_even_ratio(F.col("t"), F.col("a"), 1).alias("wide"))
    assert df.filter(~F.col("plain").eqNullSafe(F.col("wide"))).count() == 0 and df.filter("plain is not null").count() > 2000
