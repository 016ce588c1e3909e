"""One-pass phrase matching: a token n-gram index of each text against a closed vocabulary.

A text is cut at word borders into alternating runs of letters or digits and of what lies between. Every run that
some phrase begins with offers its n-grams (runs and separators, up to the longest phrase), and a hash set keeps those
that are phrases. What a phrase stands for comes from one constant map. The work follows the length of the text and not
the size of the vocabulary; nothing is joined, exploded or shuffled.

Phrases that begin or end with a separator are no n-grams of runs; the few of them are found by their pattern.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RUN = "abcdefghijklmnopqrstuvwxyz0123456789"


def _pattern(phrase: str) -> str:
    return r"(?<![a-z0-9])\Q" + phrase + r"\E(?![a-z0-9])"


def any_of(phrases) -> str:
    """A pattern for any of the phrases between word borders."""
    return "(?:" + "|".join(_pattern(p) for p in phrases) + ")"


def _starts(t: Column, phrase: str) -> Column:
    """0-based offsets of a phrase's matches, from the lengths of the parts between them."""
    parts = F.split(t, _pattern(phrase), -1)
    before = lambda i: F.aggregate(F.slice(parts, 1, i), F.lit(0), lambda acc, x: acc + F.length(x)) + (i - 1) * len(phrase)
    return F.transform(F.filter(F.sequence(F.lit(1), F.size(parts)), lambda i: i < F.size(parts)), before)


def _runs(phrase: str) -> int:
    """Number of runs of letters and digits; 0 if the phrase does not begin and end with one."""
    if phrase[0] not in _RUN or phrase[-1] not in _RUN:
        return 0
    return sum(c in _RUN and (i == 0 or phrase[i - 1] not in _RUN) for i, c in enumerate(phrase))


def _among(c: Column, words: list[str]) -> Column:
    """Membership of a constant list; Spark makes a hash set of it."""
    return c.isin(list(words))


class Vocabulary:
    """Phrases and what they stand for: a struct of the given schema for each."""

    def __init__(self, entries: dict[str, dict], schema: str):
        self.entries, self.schema = entries, schema
        self.grams = [p for p in entries if _runs(p)]
        self.odd = [p for p in entries if not _runs(p)]
        self.longest = max((_runs(p) for p in self.grams), default=0)

    def _meaning(self, phrase: Column) -> Column:
        # from_json of a literal is folded into one constant map; a map of literals would become a CASE at every lookup
        table = F.from_json(F.lit(json.dumps(self.entries)), f"map<string,struct<{self.schema}>>")
        return F.element_at(table, phrase)

    def match(self, df: DataFrame, text: str, out: str) -> DataFrame:
        """``df`` with ``out``: array of (s, e, k), the places of all phrases by start and end, with their meaning.

        ``text`` must be lower-case and hold no letters beyond a-z. Null texts give null. Steps are projections of
        their own, so that each is computed once for a row.
        """
        pieces, lens, found = F.col("_pieces"), F.col("_lens"), F.col("_found")
        first = sorted({"".join(c if c in _RUN else " " for c in p).split()[0] for p in self.grams})
        df = df.withColumn("_pieces", F.split(F.col(text), r"\b", -1))
        df = df.withColumn("_lens", F.transform(pieces, F.length))

        def grams(i: Column) -> Column:
            sizes = F.filter(F.array(*[F.lit(2 * n + 1) for n in range(self.longest)]), lambda n: i + n - 1 <= F.size(pieces))
            made = F.transform(sizes, lambda n: F.struct(F.array_join(F.slice(pieces, i, n), "").alias("p"), i.alias("i")))
            return F.filter(made, lambda g: _among(g["p"], self.grams))

        heads = F.filter(F.sequence(F.lit(1), F.size(pieces)), lambda i: _among(F.element_at(pieces, i), first))
        df = df.withColumn("_found", F.flatten(F.transform(heads, grams)))
        start = lambda i: F.aggregate(F.slice(lens, 1, i - 1), F.lit(0), lambda acc, n: acc + n)
        placed = F.transform(found, lambda g: F.struct(start(g["i"]).alias("s"), g["p"].alias("p")))
        named = lambda p: lambda s: F.struct(s.cast("int").alias("s"), F.lit(p).alias("p"))
        odd = [F.transform(_starts(F.col(text), p), named(p)) for p in self.odd]
        df = df.withColumn("_found", F.concat(placed, *odd) if odd else placed)
        df = df.withColumn(out, F.transform(found, lambda h: F.struct(h["s"].alias("s"), (h["s"] + F.length(h["p"])).alias("e"), self._meaning(h["p"]).alias("k"))))
        return df.drop("_pieces", "_lens", "_found")
