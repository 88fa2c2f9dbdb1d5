"""Backlog: how many cases are open at each cut date, by any grouping.

Comparing every case with every cut date would cost cases x cut dates. Here a
case is two changes on the line of distinct cut moments instead: +1 at the
first moment on or after its START, -1 at the first one after its END. Changes
are summed per group and moment, and a running total over them gives the
counts. The work is linear in the cases at any grain of the cut dates.

Where a date stands among the cut moments is found in one of two ways. A list
of up to LOCAL_ROWS rows is read once while the plan is built and becomes a
calendar: a row per day with the moments of the day, which a hash join and a
binary search of compiled comparisons look up, so cases are not shuffled for
it. A longer list is stored once in the scratch folder; time is cut into bins,
the moments before each bin come from a distributed prefix sum, and within a
bin cases and moments are merged in order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.functions.calendar import micros
from ticketflow.operators.running import dense_running_total, prefix_totals
from ticketflow.sources.sinks import stored

RESERVED = ("START", "END", "CUTPOINT", "COUNT")
STEPS = ("cases", "changes", "backlog")

# Calendars and cut lists up to this many rows (tens of MB) are broadcast;
# longer ones are joined by shuffle.
BROADCAST_ROWS = 500_000

# A cut list up to this many rows is read while the plan is built.
LOCAL_ROWS = 100_000

# Into so many bins the time from the first to the last moment of a longer list is cut.
BINS = 1 << 18


@dataclass(frozen=True)
class _CutList:
    """The distinct cut dates: `cuts` has their columns, how often each stands (`times`) and its number among the
    distinct moments (`nth`, 0 for a missing one). `moments` is the sorted list of moments if it is short."""

    cuts: DataFrame
    dates: int
    rows: int
    missing: bool
    moments: list[dt.datetime] | None
    line: DataFrame | None = None


def _timestamp(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


def _cut_list(cuts: DataFrame, local_rows: int) -> _CutList:
    """`cuts` holds `cut`, `times`, `at` (the moment) and further columns; it is evaluated once."""
    spark = cuts.sparkSession
    short = cuts.limit(local_rows + 1).toArrow()
    if short.num_rows <= local_rows:
        at = short["at"].to_pylist()
        moments = sorted({m for m in at if m is not None})
        number = {m: i + 1 for i, m in enumerate(moments)}
        nth = pa.array([number.get(m, 0) for m in at], pa.int64())
        schema = T.StructType([*cuts.schema.fields, T.StructField("nth", T.LongType())])
        local = spark.createDataFrame(short.append_column("nth", nth), schema).drop("at")
        return _CutList(local, len(moments), len(at), len(moments) < len(set(at)), moments)
    # Derived lists may be costly or change; all that follows reads the same rows.
    kept = stored(cuts)
    line = kept.filter("at IS NOT NULL").select("at").distinct()
    line = prefix_totals(line.withColumn("one", F.lit(1)), "at", "one").select("at", F.col("running_total").alias("nth"))
    numbered = kept.join(line.withColumnRenamed("at", "_at"), F.col("at") == F.col("_at"), "left")
    numbered = numbered.withColumn("nth", F.coalesce("nth", F.lit(0))).drop("at", "_at")
    total = kept.agg(F.count(F.lit(1)), F.max(F.col("at").isNull())).first()
    return _CutList(numbered, line.count(), total[0], total[1], None, line)


def _calendar(spark: SparkSession, moments: list[dt.datetime]) -> DataFrame:
    """Every day from the first to the last moment.

    `before` is the number of moments on earlier days, `times` holds those of
    the day itself, in order.
    """
    by_day: dict[dt.date, list[dt.datetime]] = {}
    for m in moments:
        by_day.setdefault(m.date(), []).append(m)
    days = list(by_day)
    so_far = 0
    rows = []
    for day, following in zip(days, [*days[1:], None]):
        earlier, so_far = so_far, so_far + len(by_day[day])
        # A day without moments has all those of the days before it before it.
        rows.append((day, following or day + dt.timedelta(days=1), earlier, so_far, by_day[day]))
    names = ["day", "next_day", "earlier", "so_far", "times"]
    kinds = [pa.date32(), pa.date32(), pa.int64(), pa.int64(), pa.list_(pa.timestamp("us"))]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    local = spark.createDataFrame(
        pa.table(dict(zip(names, columns))),
        "day date, next_day date, earlier bigint, so_far bigint, times array<timestamp_ntz>",
    )
    spread = local.withColumn("calendar_day", F.explode(F.sequence("day", F.date_sub("next_day", 1))))
    has_cut = F.col("calendar_day") == F.col("day")
    return spread.select(
        "calendar_day",
        F.when(has_cut, F.col("earlier")).otherwise(F.col("so_far")).alias("before"),
        F.when(has_cut, F.col("times")).otherwise(F.array().cast("array<timestamp_ntz>")).alias("times"),
    )


def _search(df: DataFrame, times: str, moment: str, closed: bool, most: int, out: str) -> DataFrame:
    """Column `out`: how many of at most `most` ordered times lie before the moment (up to it, if closed).

    A binary search, one projection per halving, so that each step reads the
    last one's result and all of them compile.
    """
    df = df.withColumn(out, F.lit(0))
    step = 1 << (most.bit_length() - 1)
    while step:
        probe = F.get(F.col(times), F.col(out) + (step - 1))
        hit = probe <= F.col(moment) if closed else probe < F.col(moment)
        df = df.withColumn(out, F.col(out) + F.when(hit, step).otherwise(0))
        step >>= 1
    return df


def _bounded(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _placed_by_calendar(cases: DataFrame, moments: list[dt.datetime]) -> DataFrame:
    """Cases with `opens`, the number of the first moment on or after START, and `closes`, of the first one after END."""
    calendar = _calendar(cases.sparkSession, moments)
    first, last = moments[0].date(), moments[-1].date()
    small = (last - first).days < BROADCAST_ROWS
    per_day: dict[dt.date, int] = {}
    for m in moments:
        per_day[m.date()] = per_day.get(m.date(), 0) + 1
    most = max(per_day.values())
    for date, side, closed in (("START", "opens", False), ("END", "closes", True)):
        # The day is moved into the calendar; comparisons use the moment itself.
        day = F.greatest(F.least(F.to_date(date), F.lit(last)), F.lit(first))
        own = calendar.toDF("_day", "_before", "_times")
        cases = cases.withColumn("_on", day).join(_bounded(own, small), F.col("_on") == F.col("_day"), "left")
        cases = _search(cases, "_times", date, closed, most, "_passed")
        cases = cases.withColumn(side, F.col("_before") + F.col("_passed") + 1)
        cases = cases.drop("_on", "_day", "_before", "_times", "_passed")
    return cases


def _ranked(changes: DataFrame, labels: list[str], line: DataFrame, dates: int) -> DataFrame:
    """Changes per label and moment turned into changes per label and number on the line of moments.

    `changes` holds labels, `place` (twice the microseconds of a date, less one
    for a START, plus one for an END; missing for a group's zero) and `change`.
    A moment stands at twice its microseconds, so no two kinds tie.
    """
    spark = changes.sparkSession
    points = line.select((micros(F.col("at")) * 2).alias("place"))
    bounds = points.agg(F.min("place").alias("low"), F.max("place").alias("high")).first()
    width = (bounds["high"] - bounds["low"]) // BINS + 1
    bins = (bounds["high"] - bounds["low"]) // width + 1

    def bin_of(place: Column) -> Column:
        inside = F.greatest(F.least(place, F.lit(bounds["high"])), F.lit(bounds["low"])) - F.lit(bounds["low"])
        return F.floor(inside / F.lit(width)).cast("bigint")

    counted = points.groupBy(bin_of(F.col("place")).alias("bin")).agg(F.count(F.lit(1)).alias("moments"))
    every = spark.range(bins).withColumnRenamed("id", "bin").join(counted, "bin", "left")
    before = prefix_totals(every.withColumn("moments", F.coalesce("moments", F.lit(0))), "bin", "moments").select(
        F.col("bin").alias("_bin"), (F.col("running_total") - F.col("moments")).alias("before")
    )
    both = (
        changes.filter(F.col("place").isNotNull())
        .withColumn("moment", F.lit(0))
        .unionByName(points.withColumn("moment", F.lit(1)), allowMissingColumns=True)
        .withColumn("bin", bin_of(F.col("place")))
    )
    in_order = Window.partitionBy("bin").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    passed = both.withColumn("_within", F.sum("moment").over(in_order)).filter("moment = 0")
    joined = passed.join(_bounded(before, bins <= BROADCAST_ROWS), F.col("bin") == F.col("_bin"))
    nth = F.col("before") + F.col("_within") + 1
    placed = joined.select(*labels, nth.alias("nth"), "change").filter(F.col("nth") <= dates)
    known = changes.select(*labels, F.lit(0).cast("bigint").alias("nth"), F.lit(0).cast("bigint").alias("change"))
    return _summed(placed.unionByName(known.distinct()), labels, "nth")


def _summed(changes: DataFrame, labels: list[str], place: str) -> DataFrame:
    return changes.groupBy(*labels, place).agg(F.sum("change").alias("change"))


def _check_names(df: DataFrame, cutpoints: DataFrame, group_cols: tuple[str, ...]) -> None:
    for name in group_cols:
        if name.upper() in RESERVED:
            raise ValueError(f"cannot group by {name}: the name is reserved")
        if name not in df.columns and name not in cutpoints.columns:
            raise ValueError(f"no grouping column {name} in the cases or the cut dates")


def _changes(cases: DataFrame, labels: list[str], cut_list: _CutList, strict: bool) -> DataFrame:
    """Summed changes per label combination and number of a moment.

    Every case leaves a row, if only a zero at number 0, so groups without a
    single open case stay known.
    """
    start, end = F.col("START"), F.col("END")
    valid = start.isNotNull() & (end.isNull() | (end >= start))
    # Without a START the answer for a cut date is unknown unless END lies before it.
    problem = F.raise_error(F.lit("interval check on a missing start date")).cast("bigint")
    if cut_list.moments is not None:
        cases = _placed_by_calendar(cases, cut_list.moments)
        opens, closes, last = F.col("opens"), F.col("closes"), F.lit(cut_list.dates)
        unanswered = start.isNull() & (end.isNull() | (closes > 1))
        counts, ends = valid & (opens <= last), valid & end.isNotNull() & (closes <= last)
        nothing, place = F.lit(0).cast("bigint"), "nth"
    else:
        opens, closes = micros(start) * 2 - 1, micros(end) * 2 + 1
        earliest = cut_list.line.agg(F.min("at")).first()[0]
        unanswered = start.isNull() & (end.isNull() | (end >= F.lit(earliest)))
        counts, ends = valid, valid & end.isNotNull()
        nothing, place = F.lit(None).cast("bigint"), "place"
    position = F.when(counts, opens).otherwise(nothing)
    if strict:
        position = F.when(unanswered, problem).otherwise(position)
    plus = F.struct(position.alias("at"), F.when(counts, 1).otherwise(0).cast("bigint").alias("change"))
    minus = F.when(ends, F.struct(closes.alias("at"), F.lit(-1).cast("bigint").alias("change")))
    changes = (
        cases.select(*labels, F.explode(F.array(plus, minus)).alias("c"))
        .filter(F.col("c").isNotNull())
        .select(*labels, F.col("c.at").alias(place), "c.change")
    )
    changes = _summed(changes, labels, place)
    return changes if place == "nth" else _ranked(changes, labels, cut_list.line, cut_list.dates)


def _every_cut(changes: DataFrame, labels: list[str], cut_list: _CutList) -> DataFrame:
    """Each group at each cut date: the running totals stretched over the gaps."""
    totals = dense_running_total(changes, labels, "nth", "change", F.lit(0), F.lit(cut_list.dates))
    return totals.join(_bounded(cut_list.cuts, cut_list.rows <= BROADCAST_ROWS), "nth")


def _matching_cuts(
    changes: DataFrame, totals: DataFrame, labels: list[str], keys: list[str], cuts: DataFrame
) -> DataFrame:
    """Each group at the cut dates of its own keys, NULL meeting NULL.

    `totals` holds each group's sum of all changes: what is open after the last
    cut date. The equi-join with the cut dates makes the result rows and no
    others; what is open at one of them is the total less the later changes.
    """
    cut_keys = [f"cut_{k}" for k in keys]
    keyed = cuts.withColumnsRenamed(dict(zip(keys, cut_keys)))
    on = [F.col(k).eqNullSafe(F.col(c)) for k, c in zip(keys, cut_keys)]
    wanted = totals.join(keyed, on).drop(*cut_keys)
    line = wanted.unionByName(changes, allowMissingColumns=True)
    later = Window.partitionBy(*labels).orderBy(F.col("nth").desc()).rangeBetween(Window.unboundedPreceding, -1)
    open_then = F.col("total") - F.coalesce(F.sum("change").over(later), F.lit(0))
    return line.withColumn("running_total", open_then).filter(F.col("times").isNotNull())


def backlog(
    df: DataFrame,
    cutpoints: DataFrame,
    *group_cols: str,
    strict: bool = False,
    progress: Mapping[str, Observation] | None = None,
    local_rows: int | None = None,
) -> DataFrame:
    """Number of cases open at each cut date: CUTPOINT, the grouping columns, COUNT.

    `df` holds START, END and grouping columns; END may be missing, both ends
    count as open. `cutpoints` holds CUTPOINT. Every group that occurs appears
    at every cut date, with zero where nothing is open. Columns that both
    tables share are matched by value first (NULL meets NULL), and then only
    matching pairs of group and cut date appear. A grouping column may come
    from either table. Repeated cases and repeated cut dates count repeatedly.

    A missing START counts as not open; with `strict` it raises, as does a
    missing CUTPOINT. `progress` maps steps out of `STEPS` to observations that
    receive the number of rows passing that step, without another action.

    Building the plan reads the cut list once: one of up to `local_rows` rows
    (LOCAL_ROWS unless given) is kept by the plan, a longer one is stored in the
    scratch folder. Results are the same either way.
    """
    group_cols = tuple(dict.fromkeys(group_cols))
    _check_names(df, cutpoints, group_cols)
    progress = progress or {}

    def watch(step: str, frame: DataFrame) -> DataFrame:
        if step not in progress:
            return frame
        return frame.observe(progress[step], F.count(F.lit(1)).alias("rows"))

    shared = [c for c in cutpoints.columns if c in df.columns]
    own = [c for c in group_cols if c not in shared and c in df.columns]
    of_cut = [c for c in group_cols if c not in df.columns]

    # Internal names: key_i for shared columns, own_i and cut_i for grouping columns.
    keys = [f"key_{i}" for i in range(len(shared))]
    labels = keys + [f"own_{i}" for i in range(len(own))]
    extra = [f"cutcol_{i}" for i in range(len(of_cut))]
    cases = df.select(
        _timestamp("START").alias("START"),
        _timestamp("END").alias("END"),
        *(F.col(c).alias(n) for c, n in zip(shared + own, labels)),
    )
    cases = watch("cases", cases)
    cut_list = _cut_list(
        cutpoints.select(
            F.col("CUTPOINT").alias("cut"),
            _timestamp("CUTPOINT").alias("at"),
            *(F.col(c).alias(n) for c, n in zip(shared, keys)),
            *(F.col(c).alias(n) for c, n in zip(of_cut, extra)),
        )
        .groupBy("cut", "at", *keys, *extra)
        .agg(F.count(F.lit(1)).alias("times")),
        LOCAL_ROWS if local_rows is None else local_rows,
    )
    if strict and cut_list.missing:
        raise ValueError("interval check on a missing cut date")
    if cut_list.dates == 0:
        # No date at all, or only missing ones: every group counts zero there.
        nothing = F.lit(0).cast("bigint")
        changes = cases.select(*labels).distinct().withColumns({"nth": nothing, "change": nothing})
    else:
        changes = _changes(cases, labels, cut_list, strict)

    if shared:
        # The totals need the same sums as the changes, so both come from one shuffle and one scan.
        totals = changes.groupBy(*labels).agg(F.sum("change").alias("total"))
        at_cuts = _matching_cuts(watch("changes", changes), totals, labels, keys, cut_list.cuts)
    else:
        at_cuts = _every_cut(watch("changes", changes), labels, cut_list)

    names = dict(zip(shared + own, labels)) | dict(zip(of_cut, extra))
    groups = [F.col(names[c]).alias(c) for c in group_cols]
    count = F.col("running_total") * F.col("times")
    if shared:
        # Keys that are not grouping columns are summed over.
        result = at_cuts.groupBy(F.col("cut").alias("CUTPOINT"), *groups).agg(F.sum(count).alias("COUNT"))
    else:
        result = at_cuts.select(F.col("cut").alias("CUTPOINT"), *groups, count.alias("COUNT"))
    return watch("backlog", result)
