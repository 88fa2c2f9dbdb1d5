"""The open cases themselves at each cut date: the pairs behind the backlog.

A binned interval join. Time is cut into bins about as wide as the cut dates
lie apart; the first and the last dates (a share of ENDS each) have bins of their
own width, so a few far dates do not draw all others into one bin. Runs of FAN
bins, of FAN such runs and so on (LEVELS of them) are blocks. The bins a case is
open in are taken apart into the fewest blocks, a cut date lies in one block of
each level, and every pair meets in exactly one block; the interval test turns
few pairs away. Only cases times blocks are shuffled,
about k / FAN ** LEVELS + 2 * FAN * LEVELS rows for a case with k cut dates; the pairs
themselves are made by the join and go straight to what follows. A block has at
most FAN ** LEVELS bins, so the pairs of a task stay in proportion to its rows,
and a block that many cases share is split by adaptive execution. Cases are
dealt out evenly first, for a short cut list is sent to them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.functions.calendar import micros
from ticketflow.sources.sinks import stored

# Bins in a block of the next level, and levels above the bins.
FAN = 4
LEVELS = 4

# With totals, levels are added until at most so many blocks of the highest one hold all bins.
TOP = 64

# The share of the cut dates at either end whose bins have a width of their own.
ENDS = 1 / 256


def _blocks(first: Column, last: Column, levels: int = LEVELS) -> Column:
    """The blocks that make up bins first to last: (level, number), bin b lying in number b // FAN ** level."""
    parts = []
    # Blocks begin to end (exclusive) of a level lie wholly inside; those of the next level take theirs out.
    begin, end = first, last + 1
    for level in range(levels + 1):
        if level == levels:
            ranges = [(begin, end)]
        else:
            up, down = F.ceil(begin / F.lit(FAN)).cast("bigint"), F.floor(end / F.lit(FAN)).cast("bigint")
            ranges = [(begin, F.least(up * FAN, end)), (F.greatest(down * FAN, F.least(up * FAN, end)), end)]
            begin, end = up, F.greatest(up, down)
        for a, b in ranges:
            numbers = F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))
            parts.append(F.transform(numbers, lambda n: F.struct(F.lit(level).alias("level"), n.alias("number"))))
    return F.concat(*parts)


def open_cases(df: DataFrame, cutpoints: DataFrame, totals: tuple[str, ...] | None = None) -> DataFrame:
    """Every case with every cut date it is open at: the columns of `cutpoints`, then the further ones of `df`.

    `df` holds START and END, `cutpoints` CUTPOINT; both ends count as open, a
    missing END is open for good, a case without START is never open, nor is
    any at a missing cut date. Columns that both tables share are matched by
    value (NULL meets NULL). Repeated cases and cut dates give repeated rows,
    so the rows of a cut date and group are as many as its backlog counts.

    With `totals`, further columns of `df`, the same pairs come summed up: per
    distinct row of `cutpoints` that has any, its columns, their number as COUNT
    and the sums of these columns. Cases are then summed per block before they
    meet the cut dates, with levels enough for a case to make at most about
    TOP + 2 * FAN * levels rows; only for the bins in which a case opens and
    closes are pairs made, so the work is linear in the cases unless many cut
    dates share a bin.

    Building the plan stores the cut list once and reads one row of its first and
    last date and those that bound its ends.
    """
    shared = [c for c in cutpoints.columns if c in df.columns]
    at = F.col("CUTPOINT").cast("timestamp_ntz")
    cuts = cutpoints.select(F.struct(*cutpoints.columns).alias("cut"), at.alias("at")).filter(F.col("at").isNotNull())
    cuts = stored(cuts)
    place = micros(F.col("at"))
    total = cuts.agg(
        F.min(place).alias("low"),
        F.max(place).alias("high"),
        F.approx_count_distinct("at").alias("dates"),
        F.percentile_approx(place, [ENDS, 1 - ENDS]).alias("inner"),
    ).first()
    low, high = total["low"] or 0, total["high"] or 0
    inner = total["inner"] or [low, low]
    # Stretches of bins of one width: first moment, width, first bin, bins.
    dates, stretches, bins = max(total["dates"], 1), [], 0
    for begin, until, share in ((low, inner[0], ENDS), (inner[0], inner[1], 1), (inner[1], high + 1, ENDS)):
        if begin < until:
            number = math.ceil(dates * share)
            stretches.append((begin, (until - begin) // number + 1, bins, number))
            bins += number
    levels = LEVELS
    while totals is not None and bins > TOP * FAN**levels:
        levels += 1

    def bin_of(moment: Column) -> Column:
        inside = F.greatest(F.least(micros(moment), F.lit(high)), F.lit(low))
        found = F.lit(None).cast("bigint")
        for begin, width, first, number in stretches:
            part = F.floor((inside - F.lit(begin)) / F.lit(width))
            # A quotient of doubles may round up to the next stretch.
            found = F.when(inside >= begin, F.least(part, F.lit(number - 1)) + first).otherwise(found)
        return found.cast("bigint")

    start, end = F.col("START").cast("timestamp_ntz"), F.col("END").cast("timestamp_ntz")
    cases = df.select(F.struct(*df.columns).alias("case"), start.alias("opened"), end.alias("closed"))
    meets = (micros(F.col("opened")) <= high) & (F.col("closed").isNull() | (micros(F.col("closed")) >= low))
    ends = F.col("closed").isNull() | (F.col("closed") >= F.col("opened"))
    last_bin = F.when(F.col("closed").isNull(), F.lit(bins - 1)).otherwise(bin_of(F.col("closed")))
    cases = cases.filter(meets & ends).withColumns({"_first": bin_of(F.col("opened")), "_last": last_bin})
    in_block = F.floor(F.col("cut_bin") / F.pow(F.lit(FAN), F.col("cut_level"))).cast("bigint")
    every_level = F.explode(F.sequence(F.lit(0), F.lit(levels)))
    by_block = cuts.withColumns({"cut_bin": bin_of(F.col("at")), "cut_level": every_level}).withColumn("cut_number", in_block)
    on = [F.col("level") == F.col("cut_level"), F.col("number") == F.col("cut_number")]
    inside = (F.col("at") >= F.col("opened")) & (F.col("closed").isNull() | (F.col("at") <= F.col("closed")))
    if totals is not None:
        keys = {f"_key_{i}": c for i, c in enumerate(shared)}
        sums = {f"_sum_{i}": c for i, c in enumerate(totals)}
        cases = cases.select(
            "opened", "closed", "_first", "_last", *(F.col(f"case.`{c}`").alias(n) for n, c in [*keys.items(), *sums.items()])
        )
        on += [F.col(n).eqNullSafe(F.col(f"cut.`{c}`")) for n, c in keys.items()]
        # Between its first and its last bin a case is open throughout.
        until = F.when(F.col("closed").isNull(), F.col("_last")).otherwise(F.col("_last") - 1)
        blocks = cases.withColumn("block", F.explode(_blocks(F.col("_first") + 1, until, levels)))
        block_sums = blocks.groupBy(F.col("block.level").alias("level"), F.col("block.number").alias("number"), *keys).agg(
            F.count(F.lit(1)).alias("_count"), *(F.sum(n).alias(n) for n in sums)
        )
        found = block_sums.join(by_block, on).select("cut", "_count", *sums)
        bounds = F.when(F.col("closed").isNull(), F.array("_first")).otherwise(F.array_distinct(F.array("_first", "_last")))
        edges = cases.withColumn("number", F.explode(bounds)).withColumn("level", F.lit(0))
        pairs = edges.join(by_block.filter("cut_level = 0"), [*on, inside]).select("cut", F.lit(1).cast("long").alias("_count"), *sums)
        both = pairs.unionByName(found).groupBy("cut")
        summed = both.agg(F.sum("_count").alias("_count"), *(F.sum(n).alias(n) for n in sums))
        return summed.select("cut.*", F.col("_count").alias("COUNT"), *(F.col(n).alias(c) for n, c in sums.items()))
    on += [F.col(f"case.`{c}`").eqNullSafe(F.col(f"cut.`{c}`")) for c in shared]
    dealt = cases.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = dealt.withColumn("block", F.explode(_blocks(F.col("_first"), F.col("_last"))))
    spread = spread.select("case", "opened", "closed", "block.level", "block.number")
    own = [F.col(f"case.`{c}`").alias(c) for c in df.columns if c not in shared]
    return spread.join(by_block, [*on, inside]).select("cut.*", *own)
