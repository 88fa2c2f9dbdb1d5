"""One query per operator, over its whole table and with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.llm import collocations, decontaminate, knn_join, line_dedup, lm_scoring, mixing, ngram_jaccard
from ticketflow.llm import quality_classifier, quality_rules, secrets, spelling_variants, substring_dedup, suffix_dedup
from ticketflow.llm.text import read

# Fixed by the contract: the score from which a document counts as good.
GOOD_SCORE = 0.3
# Fixed by the contract: words in a shingle, least similarity in percent.
SHINGLE_WORDS = 3
SIMILARITY = 90
# Fixed by the contract: vectors whose id is a multiple of this are queries.
QUERY_STEP = 50


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_digest(substring_dedup.dedup_substrings(read(spark, sf_dir, "documents")))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, read(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "text")
    return quality_classifier.score(rows, model, GOOD_SCORE).drop("text")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_digest(suffix_dedup.dedup_suffixes(read(spark, sf_dir, "documents")))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.size("leaks").cast("long").alias("n_items"),
        F.col("leaks.item_id").alias("item_ids"),
        F.round(F.coalesce(F.array_max("leaks.coverage"), F.lit(0.0)), 6).alias("coverage"),
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.span_digest(secrets.scan_secrets(read(spark, sf_dir, "documents")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality_rules.trusted_ids(read(spark, sf_dir, "labels"))
    found = quality_rules.quality_rules(read(spark, sf_dir, "documents"), trusted)
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken", "copies", F.round("position", 6).alias("position")
    )


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score_documents(read(spark, sf_dir, "documents"))
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return scored.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round(mean, 6).alias("mean_score"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_join(read(spark, sf_dir, "documents"), SHINGLE_WORDS, SIMILARITY)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(read(spark, sf_dir, "documents"))


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_join.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_quality_classifier,
        op3_line_dedup,
        op4_suffix_dedup,
        op5_decontaminate,
        op6_secret_scan,
        op7_quality_rules,
        op8_source_mixing,
        op9_lm_scoring,
        op10_ngram_jaccard,
        op11_collocations,
        op12_spelling_variants,
        op13_top_k,
    )
}

_LINE_SQL = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), numbered AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM numbered
), often AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT k.*, o.key IS NOT NULL AND k.doc_id <> o.keeper AS gone FROM keyed k LEFT JOIN often o ON k.key = o.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE kind WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 3 * source_size AS top
  FROM per
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY top / w, source NULLS LAST) AS r FROM weighed
), levels AS (
  SELECT a.source, a.source_size, a.kind, a.w, a.top, a.r,
         ((SELECT sum(source_size) FROM per) - coalesce((SELECT sum(b.top) FROM ranked b WHERE b.r < a.r), 0))
         / (SELECT sum(b.w) FROM ranked b WHERE b.r >= a.r) AS level
  FROM ranked a
), shared AS (
  SELECT *, (SELECT l.level FROM levels l WHERE l.level * l.w < l.top ORDER BY l.r LIMIT 1) AS share FROM levels
), targets AS (
  SELECT *, CASE WHEN level * w >= top OR share IS NULL THEN CAST(top AS DOUBLE) ELSE share * w END AS target FROM shared
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.kind,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size ROWS UNBOUNDED PRECEDING)
         - s.size + s.size / 2 AS middle
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), counted AS (
  SELECT *, CASE WHEN size > 0 THEN CAST(least(greatest(ceil((target - middle) / source_size), 0), 3) AS BIGINT)
            ELSE 0 END AS copies,
         CASE kind WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 1.5::DOUBLE END AS a,
         CASE kind WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS b
  FROM placed
), timed AS (
  SELECT *, CASE WHEN copies > 0 THEN middle / target * (a + b) / 2 END AS area FROM counted
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies,
       CASE WHEN area IS NOT NULL THEN
         round(least(greatest(2 * area / (a + sqrt(greatest(a * a + 2 * (b - a) * area, 0))), 0), 1), 6) END AS position
FROM timed
"""

_PHRASE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, s.size AS size, w[t.i : t.i + s.size - 1] AS p
  FROM worded, range(1, 5) s(size), unnest(range(1, CAST(len(w) AS BIGINT) - s.size + 2)) AS t(i)
), f AS (
  SELECT lang, size, p, count(*) AS a FROM grams GROUP BY lang, size, p
), totals AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang
), often AS (
  SELECT * FROM f WHERE size > 1 AND a >= 30
), inner_parts AS (
  SELECT o.lang, o.p[b.i : b.i + s.size - 1] AS part, max(o.a) AS around
  FROM often o, range(2, 4) s(size), unnest(range(1, o.size - s.size + 2)) AS b(i)
  WHERE s.size < o.size GROUP BY 1, 2
), cut AS (
  SELECT o.lang, o.size, o.p, o.a, k.k AS k, l.a AS l, r.a AS r,
         CAST(2000000::HUGEINT * o.a // (l.a + r.a) AS BIGINT) AS score
  FROM often o, unnest(range(1, o.size)) AS k(k), f l, f r
  WHERE l.lang = o.lang AND l.p = o.p[1 : k.k] AND r.lang = o.lang AND r.p = o.p[k.k + 1 : o.size]
), weakest AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), kept AS (
  SELECT w.*, array_to_string(w.p, ' ') AS phrase FROM weakest w
  LEFT JOIN inner_parts i ON i.lang = w.lang AND i.part = w.p
  WHERE i.around IS NULL OR 100 * i.around < 80 * w.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score, CAST(r.k AS INTEGER) AS cut
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""

# The checksum of a text is taken bit by bit; near words share the rest that is left without one code point.
_SPELLING_SQL = r"""
WITH runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), per_document AS (
  SELECT d, run, count(*) AS times FROM runs WHERE length(run) >= 7 GROUP BY d, run
), hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, 2 * octet_length(encode(d || ':' || run)), 2),
      lambda i: CAST(('0x' || substr(hex(encode(d || ':' || run)), CAST(i AS INTEGER), 2)) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)),
      lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS h
  FROM per_document
), damaged AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
                                   || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, times
  FROM hashed
), words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM damaged WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
), lacking AS (
  SELECT word, n, i, substr(word, 1, CAST(i AS INTEGER) - 1) || substr(word, CAST(i AS INTEGER) + 1) AS rest
  FROM words, unnest(range(1, length(word) + 1)) AS t(i)
), near AS (
  SELECT a.word AS word, a.n AS n, b.word AS other, b.n AS m
  FROM lacking a JOIN lacking b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM lacking a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM lacking a JOIN words b ON a.rest = b.word
), judged AS (
  SELECT word, n, count(*) AS n_near,
         first(CASE WHEN m >= 10 * n THEN other END ORDER BY m DESC, encode(other)) AS form,
         first(CASE WHEN m >= 10 * n THEN m END ORDER BY m DESC, encode(other)) AS form_n
  FROM near GROUP BY word, n
), walk AS (
  WITH RECURSIVE steps(word, last) AS (
    SELECT word, form FROM judged WHERE form IS NOT NULL
    UNION ALL SELECT s.word, j.form FROM steps s JOIN judged j ON j.word = s.last WHERE j.form IS NOT NULL
  ) SELECT s.word, s.last FROM steps s LEFT JOIN judged j ON j.word = s.last WHERE j.form IS NULL
)
SELECT w.word, j.form, coalesce(k.last, w.word) AS root, w.n, coalesce(j.n_near, 0) AS n_near, j.form_n
FROM words w LEFT JOIN judged j ON j.word = w.word LEFT JOIN walk k ON k.word = w.word
"""

_NEAREST_SQL = r"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS place
  FROM usable q JOIN usable c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""

LLM_ORACLE: dict[str, str] = {
    "op3_line_dedup": _LINE_SQL,
    "op8_source_mixing": _MIX_SQL,
    "op11_collocations": _PHRASE_SQL,
    "op12_spelling_variants": _SPELLING_SQL,
    "op13_top_k": _NEAREST_SQL,
}
