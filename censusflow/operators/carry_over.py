"""Conversation carry-over (N8) as a blocked scan.

A turn either inherits from the state before it (measure, aggregation, grouping, filters) or starts afresh, and which of
the two depends on that state. Seen over a block of turns this is a function of the state at its start, and a small one:
up to the first fresh turn everything is merged into the incoming state, and from there on the incoming state is
forgotten. The first fresh turn depends on three facts (is there a measure, a grouping, a filter) and on which dimensions the
incoming filters name: a turn of ``n`` filters starts afresh only if no more than ``n`` dimensions are named by
then. So a block's summary is, for each of the eight cases, a short list of (dimensions named, n, state at the end) with
rising ``n``, and the merged state with a mark where the incoming value passes through. Summaries compose.

Turns are sorted and numbered over all conversations, cut into blocks of ``WIDTH`` turns, summarised, and
scanned level by level; then every block is folded from the state that it is given. All of it is DataFrame functions over
arrays of at most ``WIDTH`` elements; a conversation of any length is spread over its blocks.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..sources.artifacts import written

WIDTH = 256
#: Stands in a summary for what the incoming state has.
_IN = "\u0001"
_DIMS = [dim for dim, _, _ in V.DIMENSIONS]

_FILTERS = "array<struct<dim:string,value:string,negated:boolean>>"
_STATE = f"struct<measure:string,aggregation:string,dims:array<string>,filters:{_FILTERS}>"
_ENTRIES = f"array<struct<named:int,n:int,state:{_STATE}>>"
_SUMMARY = f"struct<cases:array<struct<filtered:boolean,fresh:{_ENTRIES},merged:{_STATE}>>,named:int,first:{_STATE}>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _state(measure, aggregation, dims, filters) -> Column:
    return F.struct(measure.alias("measure"), aggregation.alias("aggregation"), dims.alias("dims"), filters.alias("filters"))


def _own(t: Column) -> Column:
    return _state(t["measure"], t["aggregation"], t["dims"], t["filters"])


def _first_by_dimension(fs: Column) -> Column:
    return F.aggregate(fs, F.array().cast(_FILTERS), lambda acc, f: F.when(F.exists(acc, lambda g: g["dim"] == f["dim"]), acc).otherwise(F.array_append(acc, f)))


def _named(fs: Column) -> Column:
    """The dimensions that filters name, as bits."""
    bit = lambda f: F.call_function("shiftleft", F.lit(1), (F.array_position(F.array(*[F.lit(d) for d in _DIMS]), f["dim"]) - 1).cast("int"))
    return F.aggregate(fs, F.lit(0), lambda acc, f: acc.bitwiseOR(bit(f)))


def _inherits(s: Column, t: Column) -> Column:
    """Whether turn ``t`` takes its subject or its grouping from state ``s``."""
    open_ = t["measure"].isNull() & ~t["detail"]
    grouped = F.size(s["dims"]) > 0
    return (open_ & (s["measure"].isNotNull() | grouped)) | (grouped & (F.size(t["dims"]) == 0) & ~t["compares"])


def _merge(s: Column, t: Column, filtered: Column) -> Column:
    """State ``s`` narrowed by turn ``t``. ``filtered``: whether the state before has filters."""
    open_ = t["measure"].isNull() & ~t["detail"]
    takes = open_ & s["measure"].isNotNull()
    lone = open_ & s["measure"].isNull() & (filtered | (F.size(s["dims"]) > 0))
    unnamed = (F.size(t["dims"]) == 0) & (F.size(s["dims"]) > 0) & ~t["compares"]
    return _state(F.when(takes, s["measure"]).otherwise(t["measure"]), F.when(takes, s["aggregation"]).otherwise(t["aggregation"]),
                  F.when(lone | unnamed, s["dims"]).otherwise(t["dims"]), _first_by_dimension(F.concat(s["filters"], t["filters"])))


def _after(s: Column, t: Column) -> Column:
    """(state, carried) after turn ``t`` in state ``s`` (null: no turn before)."""
    def kept(m: Column) -> Column:
        carried = F.coalesce(_inherits(s, t) | (F.size(m["filters"]) > F.size(t["filters"])), F.lit(False))
        return _let(carried, lambda c: F.struct(F.when(c, m).otherwise(_own(t)).alias("state"), c.alias("carried")))
    return F.when(s.isNull(), F.struct(_own(t).alias("state"), F.lit(False).alias("carried"))).otherwise(
        _let(_merge(s, t, F.size(s["filters"]) > 0), kept))


def _case(s: Column, filtered: Column) -> Column:
    return (F.when(s["measure"].isNotNull(), 1).otherwise(0) + F.when(F.size(s["dims"]) > 0, 2).otherwise(0) + F.when(filtered, 4).otherwise(0)).cast("int")


def _empty_summary() -> Column:
    cases = [{"filtered": c >= 4, "fresh": [], "merged": {"measure": _IN if c & 1 else None, "aggregation": _IN, "dims": [_IN] if c & 2 else [], "filters": []}} for c in range(8)]
    return F.from_json(F.lit(json.dumps({"cases": cases, "named": 0, "first": None})), _SUMMARY)


def _last_n(entries: Column) -> Column:
    return F.coalesce(F.try_element_at(entries, F.lit(-1))["n"], F.lit(-1))


def _then_turn(a: Column, t: Column) -> Column:
    """Summary ``a`` followed by one turn."""
    n, named = F.size(t["filters"]), a["named"].bitwiseOR(t["named"])

    def case(x: Column) -> Column:
        moved = F.transform(x["fresh"], lambda e: F.struct(e["named"].alias("named"), e["n"].alias("n"), _after(e["state"], t)["state"].alias("state")))
        opens = ~_inherits(x["merged"], t) & (n > _last_n(x["fresh"]))
        new = F.array(F.struct(named.alias("named"), n.alias("n"), _own(t).alias("state")))
        filtered = x["filtered"] | (F.size(x["merged"]["filters"]) > 0)
        return F.struct(x["filtered"].alias("filtered"), F.concat(moved, F.when(opens, new).otherwise(F.array().cast(_ENTRIES))).alias("fresh"),
                        _merge(x["merged"], t, filtered).alias("merged"))

    return F.struct(F.transform(a["cases"], case).alias("cases"), named.alias("named"), _after(a["first"], t)["state"].alias("first")).cast(_SUMMARY)


def _filled(merged: Column, s: Column) -> Column:
    """A merged state with the incoming state ``s`` in the marked places."""
    passes = merged["measure"].eqNullSafe(F.lit(_IN))
    return _state(F.when(passes, s["measure"]).otherwise(merged["measure"]), F.when(passes, s["aggregation"]).otherwise(merged["aggregation"]),
                  F.when(F.array_contains(merged["dims"], _IN), s["dims"]).otherwise(merged["dims"]), _first_by_dimension(F.concat(s["filters"], merged["filters"])))


def _through(b: Column, s: Column) -> Column:
    """The state after the block of summary ``b``, from state ``s`` (null: no turn before)."""
    def hit(named: Column) -> Column:
        case = F.element_at(b["cases"], _case(s, F.size(s["filters"]) > 0) + 1)
        found = F.try_element_at(F.filter(case["fresh"], lambda e: F.bit_count(named.bitwiseOR(e["named"])) <= e["n"]), F.lit(1))
        return _let(found, lambda e: F.when(e.isNotNull(), e["state"]).otherwise(_filled(case["merged"], s)))
    return F.when(s.isNull(), b["first"]).otherwise(_let(_named(s["filters"]), hit))


def _then_block(a: Column, b: Column) -> Column:
    """Summary ``a`` followed by summary ``b``."""
    def case(x: Column) -> Column:
        moved = F.transform(x["fresh"], lambda e: F.struct(e["named"].alias("named"), e["n"].alias("n"), _through(b, e["state"]).alias("state")))
        filtered = x["filtered"] | (F.size(x["merged"]["filters"]) > 0)

        def joined(y: Column) -> Column:
            later = F.filter(F.transform(y["fresh"], lambda e: F.struct(a["named"].bitwiseOR(e["named"]).alias("named"), e["n"].alias("n"), e["state"].alias("state"))),
                             lambda e: e["n"] > _last_n(x["fresh"]))
            return F.struct(x["filtered"].alias("filtered"), F.concat(moved, later).alias("fresh"), _filled(y["merged"], x["merged"]).alias("merged"))
        return _let(F.element_at(b["cases"], _case(x["merged"], filtered) + 1), joined)

    return F.struct(F.transform(a["cases"], case).alias("cases"), a["named"].bitwiseOR(b["named"]).alias("named"), _through(b, a["first"]).alias("first")).cast(_SUMMARY)


def _grouped(elements: DataFrame, width: int) -> DataFrame:
    """(conv, block, es): the elements of each block of a conversation in order."""
    return elements.groupBy("conv", F.expr(f"pos div {width}").alias("block")).agg(F.sort_array(F.collect_list(F.struct("pos", "e"))).alias("es"))


def _given(groups: DataFrame, states: DataFrame | None) -> DataFrame:
    """``groups`` with the state before each block (null at the start of a conversation)."""
    if states is None:
        return groups.withColumn("state", F.lit(None).cast(_STATE))
    s = states.select(F.col("conv").alias("_conv"), F.col("pos").alias("_block"), "state")
    return groups.join(s, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")), "left")


def _before(blocks: DataFrame, width: int) -> DataFrame:
    """(conv, pos, state): the state before each block, from the summaries (conv, pos, e) numbered from 0 in each conversation."""
    groups = _grouped(blocks, width)
    most = blocks.agg(F.max("pos").alias("p")).first()["p"]
    states = None
    if most is not None and most >= width:
        above = groups.select("conv", F.col("block").alias("pos"), F.aggregate(F.transform("es", lambda x: x["e"]), _empty_summary(), _then_block).alias("e"))
        states = _before(written(above, "carry_summaries"), width)
    out = f"struct<state:{_STATE},out:array<struct<pos:bigint,state:{_STATE}>>>"
    fold = F.aggregate("es", F.struct(F.col("state"), F.array().alias("out")).cast(out), lambda acc, x: F.struct(
        _through(x["e"], acc["state"]).alias("state"), F.array_append(acc["out"], F.struct(x["pos"].alias("pos"), acc["state"].alias("state"))).alias("out")).cast(out))
    return _given(groups, states).select("conv", F.explode(fold["out"]).alias("o")).select("conv", "o.pos", "o.state")


def carry_over(parsed: DataFrame, conv: str = "conv_id", turn: str = "turn", width: int = WIDTH) -> DataFrame:
    """Follow-up turns inherit what they do not state.

    A turn that states no measure (and is no listing) keeps the measure and aggregation of the state, or, where that has
    none, its grouping; a turn without a grouping or comparison keeps the grouping; filters merge, each dimension keeping
    its first value. A turn that inherits nothing by this is read by itself and becomes the state. Refused turns and
    confirmations change nothing and give no row. Null turns come first; equal turns are ordered by their question;
    null conversations are one conversation.
    """
    said = F.lower(F.trim(F.coalesce(F.col("question"), F.lit(""))))
    t = F.struct("measure", "aggregation", F.coalesce("dimensions", F.array().cast("array<string>")).alias("dims"), F.coalesce("filters", F.array().cast(_FILTERS)).alias("filters"),
                 F.col("compare_dim").isNotNull().alias("compares"), F.coalesce("detail", F.lit(False)).alias("detail"))
    rows = parsed.filter(~F.coalesce("refused", F.lit(False)) & ~said.isin(*V.CONFIRMATIONS)) \
        .select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), "question", t.alias("t"))
    rows = rows.withColumn("t", F.col("t").withField("named", _named(F.col("t.filters"))))
    # sorted ranges of all turns; written, so that a row's number never changes
    rows = rows.repartitionByRange("conv", "turn", "question").sortWithinPartitions("conv", "turn", "question")
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), "carry_turns")
    part = F.shiftright("at", 33)
    # one row for each partition: where its numbers start
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    starts, total = [], 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        starts.append((r["part"], total))
        total += r["n"]
    offsets = rows.sparkSession.createDataFrame(starts, "part long, start long")
    numbered = rows.join(F.broadcast(offsets), part == F.col("part")).select("conv", (F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("pos"),
                                                                             F.struct("turn", "t").alias("e"))
    groups = _grouped(numbered, width)
    # only conversations in more than one block need a scan over blocks
    spans = groups.groupBy("conv").agg(F.min("block").alias("low"), F.max("block").alias("high")).filter("high > low").select(F.col("conv").alias("_conv"), "low")
    blocks = groups.join(spans, F.col("conv").eqNullSafe(F.col("_conv"))).select(
        "conv", "low", "block", F.aggregate(F.transform("es", lambda x: x["e"]["t"]), _empty_summary(), _then_turn).alias("e"))
    blocks = written(blocks, "carry_summaries")
    # the number of a conversation's first block goes along, so that states find their way back
    states = _before(blocks.select("conv", (F.col("block") - F.col("low")).alias("pos"), "e"), width)
    low = blocks.groupBy("conv").agg(F.first("low").alias("low")).select(F.col("conv").alias("_c"), "low")
    states = states.join(low, F.col("conv").eqNullSafe(F.col("_c"))).select("conv", (F.col("pos") + F.col("low")).alias("pos"), "state")
    row = f"struct<turn:{parsed.schema[turn].dataType.simpleString()},state:{_STATE},carried:boolean>"
    out = f"struct<state:{_STATE},out:array<{row}>>"
    step = lambda acc, x: _let(_after(acc["state"], x["e"]["t"]), lambda r: F.struct(r["state"].alias("state"), F.array_append(
        acc["out"], F.struct(x["e"]["turn"].alias("turn"), r["state"].alias("state"), r["carried"].alias("carried"))).alias("out"))).cast(out)
    fold = F.aggregate("es", F.struct(F.col("state"), F.array().alias("out")).cast(out), step)
    o, text = F.col("o"), lambda f: F.concat(f["dim"], F.when(f["negated"], F.lit("!=")).otherwise(F.lit("=")), f["value"])
    return _given(groups, states).select("conv", F.explode(fold["out"]).alias("o")).select(
        F.col("conv").alias(conv), o["turn"].alias(turn), o["state"]["measure"].alias("measure"), o["state"]["aggregation"].alias("aggregation"),
        F.array_join(o["state"]["dims"], ",").alias("dimensions"), F.array_join(F.transform(F.array_sort(o["state"]["filters"]), text), ";").alias("filters"), o["carried"].alias("carried"))
