"""Language of pages by fusing evidence with Bayes' rule.

Four pieces of evidence meet in one posterior per page:
- the text: byte trigrams of the page's visible text under each language's
  trigram model, counted over all documents with a declared language;
- the language that the markup declares, weighed by how often declarations
  of it stand on pages of each language;
- the address suffix and the host, as a prior smoothed level by level:
  all pages, suffix, registered domain, host (each level adds its counts to
  a fixed weight of the level above, without the page itself).
The counts behind the last three come from the text-only posteriors by
grouped aggregation; only per-page numbers are shuffled, never the pages,
and hot hosts are summed before they are.

Defined results: a null html is an empty page, with no declaration and no
text; a null or odd url has a null host, which is a host of its own; with
no documents no language is known and lang is null; equal posteriors go to
the language first by code point; repeated rows get equal rows; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import ready, stored

#: Trigrams are hashed into so many buckets; a page's trigram evidence is
#: tempered, as neighbouring trigrams are not independent, and counts for so
#: many trigrams at most; weight of the level above; smoothing counts.
BUCKETS, TEMPER, MOST_TRIGRAMS, ABOVE, SMOOTH = 1 << 14, 0.08, 400, 10.0, 0.5

#: Elements whose content is not seen.
OPENED = re.compile(r"<(script|style|nav|footer)\b", re.I)
CLOSED = re.compile(r"</(script|style|nav|footer)\s*>", re.I)
DECLARED = r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,8})"
HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def trigrams(data: bytes) -> np.ndarray:
    """Bucket of each byte trigram."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    key = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    return ((key * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def without_markup(page: str) -> str:
    """The page with tags, comments and unseen elements replaced by spaces, in one pass:
    whatever is never closed is looked for once only."""
    ends: dict[str, list[tuple[int, int]]] = {}
    for m in CLOSED.finditer(page):
        ends.setdefault(m[1].lower(), []).append(m.span())
    for spans in ends.values():
        spans.reverse()  # the next one last
    out, at, comments = [], 0, True
    while (k := page.find("<", at)) >= 0:
        out.append(page[at:k])
        end = -1
        if m := OPENED.match(page, k):
            left = ends.get(m[1].lower(), [])
            while left and left[-1][0] < m.end():
                left.pop()
            end = left[-1][1] if left else -1
        elif comments and page.startswith("<!--", k):
            end = page.find("-->", k + 4) + 3
            comments = end > 2
            end = end if comments else -1
        if end < 0:
            end = page.find(">", k) + 1
        if not end:  # no tag ends any more
            out.append(page[k:])
            return "".join(out)
        out.append(" ")
        at = end
    out.append(page[at:])
    return "".join(out)


def visible(page: str) -> bytes:
    return " ".join(entities.unescape(without_markup(page)).lower().split()).encode("utf-8", "replace")


def trigram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all documents; a task adds up its own first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total = seen.setdefault(lang, np.zeros(BUCKETS, np.int64))
                total += np.bincount(trigrams(text.lower().encode()), minlength=BUCKETS)
        for lang, total in seen.items():
            at = np.flatnonzero(total)
            yield pa.record_batch([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(total[at])],
                                  names=["lang", "bucket", "n"])

    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).cast("string"), F.lower(F.col(lang_col).cast("string")))
    return rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n"))


def text_model(counts: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities; a table of at most languages
    times buckets numbers, the same size however many documents."""
    per: dict[str, np.ndarray] = {}
    for r in counts.collect():
        per.setdefault(r["lang"], np.zeros(BUCKETS))[r["bucket"]] = r["n"]
    langs = sorted(per, key=lambda s: s.encode())
    n = np.array([per[k] for k in langs]).reshape(len(langs), BUCKETS)
    return langs, np.log((n + SMOOTH) / (n + SMOOTH).sum(1, keepdims=True)) if langs else n


def page_evidence(pages: DataFrame, langs: list[str], logp: np.ndarray, id_col: str, url_col: str,
                  html_col: str) -> DataFrame:
    """(page_id, declared, host, domain, suffix, ll): ll is the tempered log
    likelihood of the text per language."""
    spark = ready(pages)
    shipped = spark.sparkContext.broadcast(np.ascontiguousarray(logp.T))
    page = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(F.col(url_col).cast("string"), HOST, 1))
    rows = pages.select(F.col(id_col).alias("page_id"),
                        F.nullif(F.lower(F.regexp_extract(page, DECLARED, 1)), F.lit("")).alias("declared"),
                        F.nullif(host, F.lit("")).alias("host"), page.alias("page"))
    names = ["page_id", "declared", "host", "ll"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shipped.value
        for batch in batches:
            ll = []
            for text in batch.column(3).to_pylist():
                at = trigrams(visible(text))
                part = logs[at].sum(0) if len(at) else np.zeros(logs.shape[1])
                ll.append((part * TEMPER * min(1.0, MOST_TRIGRAMS / max(1, len(at)))).tolist())
            yield pa.record_batch([*batch.columns[:3], pa.array(ll, pa.list_(pa.float64()))], names=names)

    kind = pages.schema[id_col].dataType.simpleString()
    got = rows.mapInArrow(score, f"page_id {kind}, declared string, host string, ll array<double>")
    parts = F.split("host", r"\.")
    return got.withColumns({"suffix": F.element_at(parts, -1),
                            "domain": F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), ".")})


def softmax(logs):
    e = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(F.array(e), lambda e: F.transform(
        e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda s, v: s + v)))[0]


def level_sums(rows: DataFrame, key: list[str], value: str, size: int) -> DataFrame:
    sums = rows.groupBy(*key).agg(*[F.sum(F.col(value)[i]).alias(f"s{i}") for i in range(size)])
    return sums.select(*key, F.array(*[F.col(f"s{i}") for i in range(size)]).alias("sums"))


def _above(sums, prior):
    """Level counts with a fixed weight of the level above, as shares."""
    total = F.aggregate(sums, F.lit(0.0), lambda s, v: s + v)
    return F.zip_with(sums, prior, lambda n, p: (n + ABOVE * p) / (total + ABOVE))


def page_language(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """page_id, lang, probability, text_lang, declared, host, suffix."""
    langs, logp = text_model(trigram_counts(docs))
    size = len(langs)
    rows = page_evidence(pages, langs, logp, id_col, url_col, html_col)
    if not size:
        null = F.lit(None).cast("string")
        return rows.select("page_id", null.alias("lang"), F.lit(None).cast("double").alias("probability"),
                           null.alias("text_lang"), "declared", "host", "suffix")
    rows = stored(rows.withColumn("q", softmax(F.col("ll"))), "evidence")
    even = F.array(*[F.lit(1.0 / size)] * size)
    hosts = stored(level_sums(rows, ["host", "domain", "suffix"], "q", size), "hosts")
    levels = {}
    for name in ("domain", "suffix"):
        levels[name] = level_sums(hosts, [name], "sums", size).select(
            F.col(name).alias(f"{name}_"), F.col("sums").alias(f"{name}_sums"))
    whole = hosts.agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size)]).first()
    top = F.array(*[F.lit(((whole[i] or 0.0) + ABOVE / size) / (sum(x or 0.0 for x in whole) + ABOVE))
                    for i in range(size)])
    priors = (hosts.join(levels["suffix"], F.col("suffix").eqNullSafe(F.col("suffix_")))
              .join(levels["domain"], F.col("domain").eqNullSafe(F.col("domain_")))
              .withColumn("prior", _above(F.col("suffix_sums"), top))
              .withColumn("prior", _above(F.col("domain_sums"), F.col("prior")))
              .select(F.col("host").alias("host_"), "sums", "prior"))
    priors = stored(priors, "priors")
    # how often pages of a language declare what they declare
    says = stored(level_sums(rows, ["declared"], "q", size), "declared")
    kinds = says.count() + 1
    says = says.select(F.col("declared").alias("declared_"), F.transform(
        "sums", lambda n, i: F.log((n + SMOOTH) / (F.get(F.array(*[F.lit(float(x or 0.0)) for x in whole]), i)
                                                   + SMOOTH * kinds))).alias("says"))
    less = F.zip_with("sums", "q", lambda n, q: F.greatest(n - q, F.lit(0.0)))  # without the page itself
    own = _above(less, F.col("prior"))
    known = (rows.join(priors, F.col("host").eqNullSafe(F.col("host_")))
             .join(says, F.col("declared").eqNullSafe(F.col("declared_")))
             .withColumn("own", own)
             .withColumn("logs", F.zip_with(F.zip_with("ll", "says", lambda a, b: a + b), "own",
                                            lambda a, p: a + F.log(p))))
    name = F.array(*[F.lit(k) for k in langs])
    best = lambda c: F.element_at(name, F.array_position(c, F.array_max(c)).cast("int"))
    return known.withColumn("post", softmax(F.col("logs"))).select(
        "page_id", best(F.col("post")).alias("lang"), F.array_max("post").alias("probability"),
        best(F.col("q")).alias("text_lang"), "declared", "host", "suffix")
