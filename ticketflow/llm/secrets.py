"""Secret scans weighed by how widely a candidate is owned across the corpus.

Every text is scanned for three kinds of base findings and for free tokens that
look like keys: long runs of key characters with letters and digits mixed. All
candidate values are hashed and counted over the corpus by distinct
repositories and owners. A value that several owners hold, or that stands in
many repositories of one, is a widely copied example; one that stays with few
of both, and whose characters are spread like a key's, looks live. Base
findings always stay; the method adds the free tokens that look live as spans
of the kind `live`.

The value counts are taken in three grouped steps (value, owner and repository;
value and owner; value), each with a partial sum before its shuffle, so a value
that a third of all documents hold meets no single task. Values themselves
never leave the scan: hashes do.

Defined cases: a missing text is empty and has no finding; repeated rows are
scanned each; a missing owner or repository counts as one of its own; equal
names of repositories under two owners are two repositories; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.text import cut_lineage

# Fixed by the contract: kinds, patterns and shortest lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_LENGTH = 12
# A run of the class is found whole or not at all, so the least length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "live")

_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
FREE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
# A value held by more owners than this is a copied example.
MAX_OWNERS = 2
# So is one in more repositories than this, even under one owner: a template or a vendored file, not a leak.
MAX_REPOSITORIES = 10
# Bits of entropy per character that a live-looking key has at least.
MIN_ENTROPY = 3.0

_SPANS = "array<struct<kind:int,first:int,last:int,value:string,bits:float>>"


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def findings(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of all base findings and free tokens of a text, by start and kind."""
    found = []
    lower = text.encode("utf-8", "surrogatepass").lower()
    if any(w in lower for w in _WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_LENGTH:
                found.append((0, m.start(), m.end(), m[2]))
    if "AKIA" in text:
        found.extend((1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text))
    found.extend((2, m.start(), m.end(), m[0]) for m in HEX.finditer(text))
    covered = sorted((a, b) for _, a, b, _ in found)
    begins = [a for a, _ in covered]
    # The furthest end of all base findings up to each one; they may overlap.
    ends = list(accumulate((b for _, b in covered), max))
    for m in FREE.finditer(text):
        value = m[0]
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
            before = bisect_left(begins, m.end())
            if not before or ends[before - 1] <= m.start():
                found.append((3, m.start(), m.end(), value))
    return sorted(found, key=lambda x: (x[1], x[0]))


def _scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        out = []
        for text in texts:
            found = findings(text) if isinstance(text, str) and text else []
            out.append(
                [
                    {
                        "kind": k,
                        "first": a,
                        "last": b,
                        "value": hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest(),
                        "bits": entropy(v),
                    }
                    for k, a, b, v in found
                ]
            )
        yield pd.Series(out)


def ownership(found: DataFrame, owner: str, repository: str) -> DataFrame:
    """(value, n_owners, n_repositories) from rows with _spans, counted over the whole corpus."""
    held = found.select(F.explode("_spans.value").alias("value"), F.col(owner).alias("o"), F.col(repository).alias("r"))
    held = held.groupBy("value", "o", "r").agg(F.lit(1).alias("one"))
    held = held.groupBy("value", "o").agg(F.count("*").alias("n"))
    return held.groupBy("value").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))


def _text_of(spans: Column) -> Column:
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["first"].cast("string"), s["last"].cast("string")),
        ),
        ",",
    )


def scan_secrets(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "doc_id",
    max_owners: int = MAX_OWNERS,
    min_entropy: float = MIN_ENTROPY,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """One row per row of `docs`: doc_id, owner and repository, and `spans`.

    A span is a struct of kind (a number into KINDS), first, last (code
    points, end exclusive), value (SHA-256), bits (entropy per character),
    n_owners, n_repositories and live (held by few owners, in few
    repositories, and key-like). Free tokens that do not look live are left
    out, base findings stay.
    """
    scan = F.pandas_udf(_scan, _SPANS).asNondeterministic()
    keep = list(dict.fromkeys(["doc_id", owner, repository]))
    # Numbered by content, so that a row computed again after a lost executor has the same number.
    found = docs.select(*keep, F.xxhash64(*keep, "text").alias("_row"), scan("text").alias("_spans"))
    found = cut_lineage(found)
    some = found.filter(F.size("_spans") > 0)
    counts = ownership(some, owner, repository).withColumnRenamed("value", "_v")
    each = some.select("_row", F.explode(F.array_distinct("_spans.value")).alias("value")).distinct()
    owned = each.join(counts, F.col("value") == F.col("_v")).groupBy("_row").agg(
        F.map_from_entries(F.collect_list(F.struct("value", F.struct("n_owners", "n_repositories")))).alias("_owned")
    )
    joined = found.join(owned, "_row", "left")
    held = lambda s, count: F.element_at(F.col("_owned"), s["value"])[count]
    spans = F.transform(
        "_spans",
        lambda s: F.struct(
            s["kind"].alias("kind"),
            s["first"].alias("first"),
            s["last"].alias("last"),
            s["value"].alias("value"),
            s["bits"].alias("bits"),
            held(s, "n_owners").alias("n_owners"),
            held(s, "n_repositories").alias("n_repositories"),
            (
                (held(s, "n_owners") <= max_owners)
                & (held(s, "n_repositories") <= max_repositories)
                & (s["bits"] >= min_entropy)
            ).alias("live"),
        ),
    )
    joined = joined.withColumn("_all", spans)
    return joined.select(*keep, F.filter("_all", lambda s: (s["kind"] < 3) | s["live"]).alias("spans"))


def span_digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] < 3)
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        of(0).alias("n_assign"),
        of(1).alias("n_access"),
        of(2).alias("n_hex"),
        F.sha2(_text_of(base).cast("binary"), 256).alias("base_sha256"),
        _text_of(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_copied"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["n_repositories"])), F.lit(0)).cast("long").alias("max_repositories"),
    )
