r"""Personal data by weak supervision, in DataFrame functions only.

Candidates are the matches of broad patterns: e-mail, ip, card, phone and secret (keys and passwords). Labelers
vote +1, 0 or -1 on each: a strict form (regex), a checksum, a gazetteer (top-level domains, calling codes,
card issuers, key prefixes), the words around, and the delimiters. Per kind, expectation-maximisation over the
counts of vote patterns (at most 3**5 of them) estimates the labelers' accuracies and the share of true
candidates. Its posteriors then train a naive Bayes span classifier over bucketed features of the span, and a
threshold for each kind: the lowest score from which on the candidates are personal data with ``PRECISION``, as far as the
posteriors tell.

Base spans (valid e-mail, ip, card and phone matches) always stay. The method adds candidates of every kind that reach their
kind's threshold, that a checksum or the words around speak for, and that overlap no base span: phones without a plus or
cut out of a longer run of numbers, e-mail addresses with a written-out at, ip addresses of version 6, card numbers
that fail their checksum, keys and passwords. Runs of digits alone are no secrets. Patterns are written without backtracking or recursion, so that very long texts neither take
quadratic time nor overflow the stack: ``++`` never gives back, and a look-behind keeps a match from starting
inside the run of characters that it begins with (``\G``: unless the match before ended there).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import materialize

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
#: Java patterns; the first four match what the base patterns do.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])(?=[0-9_+/=-]*+[A-Za-z])[A-Za-z0-9_+/=-]{16,}+",
}
#: Further forms of the base kinds. They are never base spans.
FORMS = (
    ("phone", r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:(?:[ .-][0-9]{2}){4}|(?:[ .-][0-9]{3,4}){1,2}+)(?![0-9])"),
    ("phone", r"(?<![0-9+().-])(?<!\+[0-9]{1,3}[ .-])(?:\([0-9]{2,5}\)|[0-9]{2,5})[ ./-][0-9]{3,4}[ .-][0-9]{3,5}(?![0-9]|[.-][0-9])"),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[{](?i:at)[)\]}] ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[{](?i:dot)[)\]}]) ?[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    ("secret", r"(?i:password|passwd|pwd|api[_-]?key)\x20{0,2}[:=]\x20{0,2}[^\s\"',;]{6,64}+"),
)
PRECISION = 0.9
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: What the words before a span may say about it: for and against.
CONTEXT = {
    "email": (r"(?i)mail|contact|write to|reach", r"(?i)git|ssh|scp"),
    "ip": (r"(?i)\bip\b|address|server|host|login|from", r"(?i)version|release|section|chapter"),
    "card": (r"(?i)card|visa|master|amex|credit|pay|charge", r"(?i)isbn|order|serial|invoice|tracking"),
    "phone": (r"(?i)tel|phone|call|mobile|fax|contact", r"(?i)error|version|score"),
    "secret": (r"(?i)password|passwd|secret|token|key|credential", r"(?i)commit|checksum|sha|md5|digest|uuid"),
}
STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}(?:@| ?[(\[{](?i:at)[)\]}] ?)(?:[A-Za-z0-9-]{1,63}(?:\.| ?[(\[{](?i:dot)[)\]}] ?)){1,4}[A-Za-z]{2,12}$",
    "ip": r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7})$",
    "card": r"^(?:[0-9]{12,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$",
    "phone": r"^(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{1,5}\)?(?:[ ./-]?[0-9]{2,5}){1,4}$",
    "secret": r"^(?:AKIA[0-9A-Z]{16}|(?i:password|passwd|pwd|api[_-]?key)\x20{0,2}[:=]\x20{0,2}.{6,}|(?i:password|passwd|token|secret|key)=[^=]{6,}|[0-9a-f]{32,64}|(?:ghp|sk|xox[abp])[_-][A-Za-z0-9_-]{12,})$",
}
GAZETTEER = {
    "email": r"(?i)(?:\.|dot[)\]}] ?)(?:com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|us|ca|ch|at|nl|be)$",
    "ip": r"^(?!0|127|255)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^(?:0|\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]))",
    "secret": r"^(?:AKIA|ASIA|ghp_|sk-|xox|(?i:password|passwd|token|secret)=)",
}
LABELERS, ROUNDS = 5, 25


def _by_kind(kind: Column, of: dict[str, Column]) -> Column:
    out = F.lit(None)
    for k, v in of.items():
        out = F.when(kind == k, v).otherwise(out)
    return out


def _valid(kind: Column, m: Column) -> Column:
    """Whether a match is a span by the base rules; null for secrets."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    return _by_kind(kind, {"email": F.lit(True), "ip": m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$") | m.contains(":"),
                           "card": n.between(12, 19) & F.call_function("luhn_check", F.when(n.between(12, 19), digits).otherwise("1")), "phone": n.between(9, 15)})


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(uid, doc_id) of all rows; (uid, form, kind, m, start, end, before, after) of all candidates, in code points.

    ``form`` is the number of the pattern; the first ones are the base patterns and the general one of secrets.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    digit, marked = F.col("digit"), F.col("marked")
    forms = [*PATTERNS.items(), *FORMS]
    has = [F.contains(t, F.lit("@")), digit, digit, F.contains(t, F.lit("+")), digit, F.contains(t, F.lit("+")), digit, marked, F.contains(t, F.lit(":")), marked]
    # a text's gaps and matches alternate, so their lengths give the places
    found = [F.struct(F.lit(i).alias("form"), F.lit(k).alias("kind"), F.regexp_extract_all(t, F.lit(p), F.lit(0)).alias("m"),
                      F.transform(F.split(t, p, -1), lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(32)).alias("tail"), F.left(g, F.lit(1)).alias("head"))).alias("g"))
             for i, (k, p) in enumerate(forms)]
    found = [F.when(h, f) for h, f in zip(has, found)]
    # most texts have none of these
    test = lambda p: F.coalesce(F.col("text").rlike(p), F.lit(False))
    rows = (docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
            .withColumns({"digit": test("[0-9]"), "marked": test(r"(?i)[(\[{]at[)\]}]|pass|pwd|api[_-]?key")})
            .select("uid", "doc_id", F.when(digit | marked | has[0], F.filter(F.array(*found), lambda f: f.isNotNull() & (F.size(f["m"]) > 0))).alias("found")))
    rows = materialize(rows, "pii-matches")
    each = (rows.filter("size(found) > 0").select("uid", F.explode("found").alias("f"))
            .select("uid", "f.form", "f.kind", F.col("f.g").alias("g"), F.posexplode("f.m").alias("i", "m"))
            .select("uid", "form", "kind", "i", "m", F.col("g")[F.col("i")].alias("gap"), F.col("g")[F.col("i") + 1]["head"].alias("after")))
    upto = Window.partitionBy("uid", "form").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap.n") + F.length("m")).over(upto)
    return rows.select("uid", "doc_id"), each.select("uid", "form", "kind", "m", (end - F.length("m")).cast("long").alias("start"), end.cast("long").alias("end"),
                                                     F.col("gap.tail").alias("before"), "after")


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(cand: DataFrame) -> DataFrame:
    """``cand`` with ``v``, the labelers' votes, and ``base``, whether it is a base span."""
    k, m = F.col("kind"), F.col("m")
    digits = F.regexp_replace(m, "[^0-9]", "")
    valid = _valid(k, m)
    checksum = _by_kind(k, {"email": F.lit(0), "ip": _vote(valid, ~valid), "card": _vote(valid, ~valid), "phone": _vote(valid, ~valid),
                            "secret": _vote(m.rlike("^(?:AKIA[0-9A-Z]{16}|[0-9a-f]{40}|[0-9a-f]{64})$"), F.length(digits) * 10 < F.length(m))})
    strict = _by_kind(k, {x: _vote(m.rlike(p), ~m.rlike(p)) for x, p in STRICT.items()})
    known = _by_kind(k, {x: _vote(m.rlike(p), F.lit(False)) for x, p in GAZETTEER.items()})
    # a secret may name itself: password=...
    near = {x: F.concat("before", "m") if x == "secret" else F.col("before") for x in KINDS}
    words = _by_kind(k, {x: _vote(near[x].rlike(yes), near[x].rlike(no)) for x, (yes, no) in CONTEXT.items()})
    apart = _vote(F.coalesce(F.col("before"), F.lit("")).rlike(r"(?:^|[\s\"'(<:=,;])$") & F.coalesce(F.col("after"), F.lit("")).rlike(r"^(?:$|[\s\"')>.,;!?])"),
                  F.coalesce(F.col("after"), F.lit("")).rlike("^[A-Za-z0-9]"))
    return cand.withColumn("v", F.array(strict, checksum, known, words, apart)).withColumn("base", F.coalesce(valid & (F.col("form") < len(BASE)), F.lit(False)))


def reliabilities(voted: DataFrame) -> DataFrame:
    """(kind, pi, acc): share of true candidates and the labelers' accuracies, by expectation-maximisation.

    One row per kind; a kind's patterns are at most 3**5, so the fold over them is one small expression.
    """
    counts = voted.groupBy("kind", "v").agg(F.count("*").cast("double").alias("n")).groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("pats"))
    steps = f"sequence(0, {LABELERS - 1})"
    posterior = f"1 / (1 + exp(-(ln(s.pi / (1 - s.pi)) + aggregate({steps}, 0D, (a, j) -> a + p.v[j] * ln(s.acc[j] / (1 - s.acc[j]))))))"
    # expectation: the patterns with the posterior of each; maximisation: weighted agreement, with two doubtful votes beside
    accuracy = ("(aggregate(e, 1.4D, (a, p) -> a + if(p.v[j] = 1, p.n * p.q, if(p.v[j] = -1, p.n * (1 - p.q), 0D))) "
                "/ aggregate(e, 2D, (a, p) -> a + if(p.v[j] <> 0, p.n, 0D)))")
    share = "(aggregate(e, 1D, (a, p) -> a + p.n * p.q) / aggregate(e, 2D, (a, p) -> a + p.n))"
    clamp = lambda x, lo, hi: f"least({hi}D, greatest({lo}D, {x}))"
    state = f"named_struct('pi', 0.5D, 'acc', transform({steps}, j -> 0.75D))"
    step = (f"transform(array(transform(pats, p -> named_struct('v', p.v, 'n', p.n, 'q', {posterior}))), "
            f"e -> named_struct('pi', {clamp(share, 0.02, 0.98)}, 'acc', transform({steps}, j -> {clamp(accuracy, 0.55, 0.98)})))[0]")
    return counts.select("kind", F.expr(f"aggregate(sequence(1, {ROUNDS}), {state}, (s, i) -> {step})").alias("s")).select("kind", "s.pi", "s.acc")


def _buckets() -> list[Column]:
    """Bucketed features of a span; each has few values, whatever the text."""
    m = F.col("m")
    share = lambda p: F.floor(F.length(F.regexp_replace(m, p, "")) * 5 / F.greatest(F.length(m), F.lit(1))).cast("string")
    kind_of = lambda c: (F.when(F.coalesce(c, F.lit("")) == "", "none").when(c.rlike(r"\s"), "space").when(c.rlike("[A-Za-z0-9]"), "word").when(c.rlike(r"[\x21-\x7E]"), "sign").otherwise("other"))
    return [F.concat(F.lit("length "), F.least(F.floor(F.log2(F.length(m) + 1)), F.lit(8)).cast("string")), F.concat(F.lit("digits "), share("[^0-9]")),
            F.concat(F.lit("capitals "), share("[^A-Z]")), F.concat(F.lit("before "), kind_of(F.right("before", F.lit(1)))), F.concat(F.lit("after "), kind_of(F.col("after"))),
            F.concat(F.lit("equals "), m.contains("=").cast("string")), F.concat(F.lit("start "), (F.col("start") == 0).cast("string"))]


def _apart_from_base(voted: DataFrame) -> DataFrame:
    """``voted`` without what overlaps a base span of its row, and without equal spans found by several patterns."""
    by = Window.partitionBy("uid").orderBy("start", F.desc("base"))
    before = F.max(F.when(F.col("base"), F.col("end"))).over(by.rowsBetween(Window.unboundedPreceding, -1))
    later = F.min(F.when(F.col("base"), F.col("start"))).over(by.rowsBetween(1, Window.unboundedFollowing))
    free = F.col("base") | ~(F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(later < F.col("end"), F.lit(False)))
    return voted.withColumn("free", free).filter("free").drop("free", "form").dropDuplicates(["uid", "kind", "start", "end"])


def find(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(uid, doc_id) of all rows, and one row per candidate: uid, kind, m, start, end, base, weak, score, accepted.

    ``weak`` is the labelers' posterior, ``score`` the classifier's; accepted are base spans, and others with a score of their
    kind's threshold or more that the checksum or the words around speak for.
    """
    rows, cand = candidates(docs)
    voted = materialize(_apart_from_base(votes(cand)), "pii-votes")
    model = materialize(reliabilities(voted), "pii-model")  # at most one row per kind
    weak = voted.join(F.broadcast(model), "kind").withColumn("weak", F.expr(
        f"1 / (1 + exp(-(ln(pi / (1 - pi)) + aggregate(sequence(0, {LABELERS - 1}), 0D, (a, j) -> a + v[j] * ln(acc[j] / (1 - acc[j]))))))"))
    weak = weak.withColumn("features", F.array(*_buckets()))
    # at most kinds * features * buckets rows
    seen = (weak.select("kind", "weak", F.explode("features").alias("feature")).groupBy("kind", "feature").agg(F.sum("weak").alias("p"), F.sum(1 - F.col("weak")).alias("n")))
    total = weak.groupBy("kind").agg(F.sum("weak").alias("tp"), F.sum(1 - F.col("weak")).alias("tn"))
    ratio = (seen.join(F.broadcast(total), "kind")
             .withColumn("llr", F.log((F.col("p") + 0.5) / (F.col("tp") + 1)) - F.log((F.col("n") + 0.5) / (F.col("tn") + 1)))
             .groupBy("kind").agg(F.map_from_entries(F.collect_list(F.struct("feature", "llr"))).alias("llr"), F.first(F.log((F.col("tp") + 1) / (F.col("tn") + 1))).alias("prior")))
    ratio = materialize(ratio, "pii-classifier")
    # the weak posterior is one more piece of evidence; features are damped, as they depend on each other
    logit = F.expr("prior + aggregate(features, 0D, (a, f) -> a + coalesce(llr[f], 0D)) / 3 + ln(greatest(weak, 1e-6D) / greatest(1 - weak, 1e-6D)) / 2")
    scored = weak.join(F.broadcast(ratio), "kind").withColumn("score", 1 / (1 + F.exp(-logit)))
    # the threshold: the lowest hundredth of the score from which on the mean posterior is high enough; at most 101 rows a kind
    steps = scored.groupBy("kind", F.floor(F.col("score") * 100).alias("step")).agg(F.sum("weak").alias("w"), F.count("*").alias("n"))
    above = Window.partitionBy("kind").orderBy(F.desc("step"))
    cuts = (steps.withColumn("mean", F.sum("w").over(above) / F.sum("n").over(above)).filter(F.col("mean") >= PRECISION)
            .groupBy("kind").agg((F.min("step") / 100).alias("cut")))
    cuts = materialize(cuts, "pii-thresholds")
    spoken = (F.col("v")[1] == 1) | (F.col("v")[3] == 1)
    added = spoken & (F.col("score") >= F.greatest("cut", F.lit(0.5)))
    spans = scored.join(F.broadcast(cuts), "kind", "left").select("uid", "kind", "m", "start", "end", "base", "weak", "score", (F.col("base") | F.coalesce(added, F.lit(False))).alias("accepted"))
    return rows, spans


def pii(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans.

    Spans are ``kind:start:end`` in code points, by start and kind, comma-joined. A null text counts as
    empty; repeated rows each get a row; very long texts are read whole; an empty table gives no rows; other columns are
    not read. The counts and the digest are of base spans; ``n_added`` counts the method's, ``n_spans`` both.
    """
    rows, spans = find(docs)
    rank = _by_kind(F.col("kind"), {k: F.lit(i) for i, k in enumerate(KINDS)})
    entry = F.struct("start", rank.alias("rank"), F.concat_ws(":", "kind", "start", "end").alias("s"))
    joined = lambda cond: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(cond, entry))), lambda x: x["s"]), ",")
    per = spans.filter("accepted").groupBy("uid").agg(
        *[F.count(F.when((F.col("kind") == k) & F.col("base"), 1)).alias(f"n_{k}") for k in BASE],
        joined(F.col("base")).alias("base_spans"), joined(F.lit(True)).alias("spans"), F.count(F.when(~F.col("base"), 1)).alias("n_added"), F.count("*").alias("n_spans"))
    out = rows.join(per, "uid", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", *[zero(f"n_{k}") for k in BASE], F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"), zero("n_added"), zero("n_spans"))
