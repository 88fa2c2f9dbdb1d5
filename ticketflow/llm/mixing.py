"""Mixing sources to target weights along a time-varying curriculum.

Each source gets a share of the training words by weight; a target above
`max_repeats` times its source is cut there and the excess is shared anew by
weight. A source's schedule says how its weight varies over training time
[0, 1]. Its documents, in hash order and repeated as often as the target asks,
form its token demand; integrating the schedule and inverting it at a copy's
cumulative demand gives the copy's position in training. The result is sorted
by position with a range shuffle.

Only built-in functions run here. Running totals inside a source are taken in
two levels (hash bucket, then inside the bucket), so a source with a third of
all rows is spread over many tasks. A bucket holds about BUCKET_ROWS rows at
every input size.

Defined cases: a missing text has size 0 and is never taken; a missing source
is a source of its own, sorted last; repeated rows are rows of their own and
rows equal in id and size get equal results up to which comes first; an empty
table gives an empty result; without any word all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketflow.llm.text import cut_lineage, n_words_of

# Fixed by the contract: weights of the sources in turn, and the most often a source may repeat.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3

# Relative weight of a source at the start and the end of training, in turn like WEIGHTS, linear in between:
# the first kind grows, the second stays, the third fades. Each pair has the mean 1.
SCHEDULES = ((0.5, 1.5), (1.0, 1.0), (1.5, 0.5))
BUCKET_ROWS = 5_000


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, kind) from rows (source, size).

    With sources in order of the level max_repeats * size / weight at which
    they are full, a source is full if sharing what the earlier full ones leave
    among it and all later ones would reach its level. That gives the same as
    cutting and sharing anew until no target is too high. The windows run over
    one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    kind = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    per = per.withColumn("kind", kind).withColumn(
        "_weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.col("kind") + 1)
    )
    top = F.lit(max_repeats) * F.col("source_size")
    order = Window.orderBy(top / F.col("_weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum(top).over(before), F.lit(0))
    per = per.withColumn("_level", left / F.sum("_weight").over(after)).withColumn(
        "_full", F.col("_level") * F.col("_weight") >= top
    )
    per = per.withColumn("_share", F.first(F.when(~F.col("_full"), F.col("_level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("_full") | F.col("_share").isNull(), top.cast("double")).otherwise(
        F.col("_share") * F.col("_weight")
    )
    return per.select("source", "source_size", target.alias("target"), "kind")


def _order_key() -> Column:
    return F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))


def _position(demand: Column, start: Column, end: Column) -> Column:
    """Time t with start*t + (end-start)*t*t/2 = demand*(start+end)/2, for demand in [0, 1]."""
    area = demand * (start + end) / 2
    root = F.sqrt(F.greatest(start * start + 2 * (end - start) * area, F.lit(0.0)))
    return F.least(F.greatest(2 * area / (start + root), F.lit(0.0)), F.lit(1.0))


def mix_sources(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    schedules: tuple = SCHEDULES,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per row of `docs` (doc_id, source, text), sorted by training position.

    Columns: doc_id, source, size (words), source_size, target (words of its
    source), copies, taken (size * copies), position (of the first copy, NULL
    if none) and positions (of all copies). Copy j of a document with words
    [c, c + size) of its source is taken if the middle of its words, j *
    source_size + c + size / 2, lies below the target.
    """
    rows = docs.select("doc_id", "source", n_words_of(F.col("text")).alias("size"), _order_key().alias("_key"))
    # Texts are read once: the rest works on one narrow row per document.
    rows = cut_lineage(rows)
    n_buckets = F.ceil(rows.agg(F.count("*")).scalar() / F.lit(bucket_rows))
    rows = rows.withColumn("_n", F.greatest(n_buckets, F.lit(1)).cast("bigint"))
    # 15 hex digits fit a bigint; their share of the whole range gives the bucket, so buckets keep the order.
    whole = float(16**15)
    rows = rows.withColumn(
        "_bucket", F.floor(F.conv(F.substring("_key", 1, 15), 16, 10).cast("bigint") / F.lit(whole) * F.col("_n"))
    ).drop("_n")
    per_bucket = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("size"))
    earlier = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = per_bucket.select(
        F.col("source").alias("_s"),
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("_begin"),
    )
    targets = source_targets(per_bucket.select("source", "size"), weights, max_repeats)
    begins = begins.join(targets, F.col("_s").eqNullSafe(F.col("source"))).drop("source")
    inside = Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size")
    rows = rows.withColumn(
        "_in", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    rows = rows.join(begins, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    middle = F.col("_begin") + F.col("_in") + F.col("size") / 2
    wanted = F.ceil((F.col("target") - middle) / F.col("source_size"))
    copies = F.when(F.col("size") > 0, F.least(F.greatest(wanted, F.lit(0)), F.lit(max_repeats))).otherwise(0)
    rows = rows.withColumn("copies", copies.cast("long")).withColumn("_middle", middle)
    begin = F.element_at(F.array(*(F.lit(float(a)) for a, _ in schedules)), F.col("kind") % len(schedules) + 1)
    end = F.element_at(F.array(*(F.lit(float(b)) for _, b in schedules)), F.col("kind") % len(schedules) + 1)
    rows = rows.withColumn("_from", begin).withColumn("_to", end)
    at = [
        F.when(
            F.col("copies") > j,
            _position((F.lit(j) * F.col("source_size") + F.col("_middle")) / F.col("target"), F.col("_from"), F.col("_to")),
        )
        for j in range(max_repeats)
    ]
    return rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
        at[0].alias("position"),
        F.array_compact(F.array(*at)).alias("positions"),
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")
