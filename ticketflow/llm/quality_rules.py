"""Quality rules: rule counts per text and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed n-grams are counted: one over a trusted target
(documents labelled good), one over the whole raw corpus. A text's score is
the mean log-ratio of its n-grams, so its length does not matter. Every
document gets a verdict from a fixed threshold; nothing is drawn at random.

Only built-in functions run here. The n-grams of a text are its words, its
pairs of consecutive words and the last three characters of its words; the
last say something of rare and invented words too, where counts of whole words
and of pairs stay at one.

Defined cases: a missing or empty text has no words, all counts 0 and score 0
and fails the rules; repeated rows get a verdict each; without any trusted
document the log-ratios are 0 and only the rules decide; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketflow.llm.text import SPACES, set_aside, words_of

BUCKETS = 1 << 13
# The target is fitted on at most so many labelled documents, those with the smallest hash of their id.
TRUSTED = 20_000
# A mean log-ratio below this is rejected: n-grams e**0.5 times rarer in the target than in the raw corpus.
THRESHOLD = -0.5
MIN_WORDS = 50

# Fixed by the contract: characters that count as symbols.
NOT_SYMBOLS = "[^#*$%&|<>]+"


def trusted_ids(labels: DataFrame, bound: int = TRUSTED) -> DataFrame:
    """Ids of documents labelled good: at most `bound`, chosen by hash."""
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def _gram_buckets(word: Column, following: Column) -> list[Column]:
    """The buckets of a word, of its ending, and of it with the word that follows (missing after the last one)."""
    grams = (F.xxhash64(word), F.xxhash64(F.lit("ending"), F.substring(word, -3, 3)), F.xxhash64(word, F.lit("pair"), following))
    return [F.pmod(g, F.lit(BUCKETS)).cast("int") for g in grams]


def log_ratios(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(bucket, ratio) for every bucket that occurs: log of target share over raw share, add-one smoothed."""
    marked = docs.select("doc_id", "text").join(
        F.broadcast(trusted.select(F.col("doc_id").alias("_id"), F.lit(1).alias("_good"))),
        F.col("doc_id") == F.col("_id"),
        "left",
    )
    grams = marked.select(words_of(F.col("text")).alias("_w"), F.coalesce("_good", F.lit(0)).alias("_good"))
    # Words are paired one step earlier, so that exploding and hashing stay in generated code; the outer form keeps
    # the optimizer from testing the array's size first, which would make it twice.
    following = F.slice("_w", 2, F.greatest(F.size("_w") - 1, F.lit(0)))
    grams = grams.select("_good", F.arrays_zip(F.col("_w").alias("w"), following.alias("next")).alias("_pairs"))
    grams = grams.select("_good", F.explode_outer("_pairs").alias("_p")).filter("_p IS NOT NULL")
    buckets = F.array(*_gram_buckets(F.col("_p.w"), F.col("_p.next")))
    grams = grams.select("_good", F.explode(buckets).alias("bucket"))
    counted = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("_good").alias("good"))
    # One row per bucket at most, so this window is bounded by BUCKETS.
    whole = Window.partitionBy()
    good, raw = F.sum("good").over(whole), F.sum("raw").over(whole)
    ratio = F.log((F.col("good") + 1) / (good + BUCKETS)) - F.log((F.col("raw") + 1) / (raw + BUCKETS))
    return counted.select("bucket", F.when(good > 0, ratio).otherwise(0.0).alias("ratio"))


def _ratio_array(ratios: DataFrame) -> Column:
    """The BUCKETS ratios as one array, an uncorrelated scalar subquery; buckets never seen have 0."""
    spine = ratios.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    dense = spine.join(ratios, "bucket", "left").select("bucket", F.coalesce("ratio", F.lit(0.0)).cast("float").alias("ratio"))
    packed = dense.agg(F.array_sort(F.collect_list(F.struct("bucket", "ratio"))).alias("a"))
    return packed.select(F.col("a.ratio").alias("a")).scalar()


def _windows(words: Column) -> Column:
    """Hash of every 3-word window."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )


def _sorted_windows(windows: Column) -> Column:
    """Hash and place of every 3-word window, by hash; nothing if no two windows are equal."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), placed).otherwise(none)


def _repeated(ordered: Column) -> Column:
    """Places, in order, of the sorted windows that equal a neighbour."""
    same = F.filter(
        ordered,
        lambda x, k: (x["h"] == F.get(ordered, k - 1)["h"]) | (x["h"] == F.get(ordered, k + 1)["h"]),
    )
    return F.sort_array(F.transform(same, lambda x: x["i"]))


def _solid_length(text: Column) -> Column:
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return F.length(text)


def rule_counts(docs: DataFrame) -> DataFrame:
    """The columns of `docs` with the rule counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    `_grams`, the buckets of all n-grams."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    step = docs.select(
        "*",
        words_of(F.col("text")).alias("_w"),
        _solid_length(text).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    step = step.select(
        *(c for c in step.columns if c not in ("_w", "_lines")),
        F.size("_w").cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _windows(F.col("_w")).alias("_windows"),
        F.flatten(F.transform("_w", lambda w, i: F.array(*_gram_buckets(w, F.get("_w", i + 1))))).alias("_grams"),
    )
    step = step.withColumn("_sorted", _sorted_windows(F.col("_windows"))).drop("_windows")
    step = step.withColumn("_at", _repeated(F.col("_sorted"))).drop("_sorted")
    covered = F.aggregate(
        F.col("_at"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
    )
    return step.withColumn("n_repeat_words", covered["n"]).drop("_at")


def quality_rules(
    docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, min_words: int = MIN_WORDS
) -> DataFrame:
    """The columns of `docs` and, per row, the rule counts, base_failed, score (mean log-ratio) and kept.

    `trusted` holds the doc_id of target documents, few enough to be sent to
    every executor (see `trusted_ids`). Columns of `docs` named like the new
    ones are replaced.
    """
    new = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")
    ratios = _ratio_array(log_ratios(docs, trusted))
    docs, names = set_aside(docs.drop(*new))
    counted = rule_counts(docs)
    counted = counted.withColumn("_ratios", ratios)
    # The ratios are named once here: named more often, they would be copied into every row.
    total = F.aggregate(F.col("_grams"), F.lit(0.0), lambda acc, b: acc + F.get("_ratios", b))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    score = F.when(F.size("_grams") > 0, total / F.size("_grams")).otherwise(0.0)
    verdict = F.struct(
        failed.alias("base_failed"), score.alias("score"), (~failed & (score >= threshold)).alias("kept")
    )
    # A one-element array taken apart again: a later filter on the verdict stays above it, and the optimizer does not
    # copy the whole computation into the condition.
    scored = counted.select(
        *(c for c in counted.columns if c not in ("_grams", "_ratios")), F.explode(F.array(verdict)).alias("_verdict")
    )
    scored = scored.select(*(c for c in scored.columns if c != "_verdict"), "_verdict.*")
    return scored.withColumnsRenamed(names)
