"""Spelling variants among the words of all texts, found by pivotal grams.

Words that are one edit apart differ on one side only of every bigram that the
edit does not touch.  Each word has its three rarest bigrams as its prefix (with
all others that are equally rare as the last of them), and of those three two
that do not overlap, of least total frequency, as its pivots: a dynamic program
over their positions chooses them.  An edit destroys at most one of two disjoint
bigrams.  So, of two near words, let s be the one whose prefix ends earlier in
the order of rarity: one of its pivots survives in the other word r, and as it is
no later than the end of r's prefix, it is in that prefix.

Pivots are joined with prefixes under position limits.  A surviving bigram has
the edit on its right, and then all on its left is equal in both words and it
stands at the same distance from the start; or on its left, and then all on its
right is equal and it stands at the same distance from the end.  Of the side that
has the edit, of length m in s and m - 1 to m + 1 in r, one half is equal as well
(the edit is in the other).  What is equal on both sides makes the join's key, so
a key's group holds words with most of their letters in common.  Every candidate
pair is then verified by its edit distance.

Words are counted in one pass over the texts, added up in each task before they
are shuffled; long texts are cut between words.  The bigrams' frequencies are a
table of bounded size (the alphabet's square).  Words and their keys are joined by
sorting at every size: Spark takes the keys for as small as the words that they are
made from, or as their files, and would bring millions of them to the driver.

Defined results: null and empty texts have no words; a null id counts as '' where
ids enter; repeated rows count again; a word without near words is its own root;
an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import ready, stored

#: Letters are A-Z, a-z and U+00C0 to U+00FF, of which A-Z are
#: lower-cased; as Latin-1 bytes, all else is a space.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
#: A run whose hash this divides loses one letter; words are at least so long and
#: frequent; a form is at least so many times as frequent as its word.
MISTYPED, LEAST_POINTS, LEAST_TIMES, FORM_TIMES = 199, 6, 5, 5
#: Edits allowed, and bigrams of a prefix (each edit touches two at most).
EDITS, GRAM = 1, 2
PREFIX = GRAM * EDITS + 1
#: Words that a task adds up before it passes them on; characters of a text cut at once.
HELD, SLICE = 200_000, 4_000_000


def runs(text: str) -> Iterator[bytes]:
    """Lower-cased runs of letters of the whole text, as Latin-1 bytes."""
    rest = b""
    for at in range(0, len(text), SLICE):
        part = rest + text[at:at + SLICE].encode("latin-1", "replace").translate(LETTERS)
        rest = b""
        if at + SLICE < len(text):  # the last run may go on in the next slice
            part, _, rest = part.rpartition(b" ") if b" " in part else (b"", b"", part)
        yield from part.split()


def mistyped(word: bytes, seed: int) -> bytes:
    """The run without one letter, if its hash (``seed``: that of '<doc_id>:') says so."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
    if h % MISTYPED:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def passed() -> pa.RecordBatch:
            out = pa.record_batch([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                   pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                seed = zlib.crc32(f"{i.as_py() or ''}:".encode())
                for word, n in Counter(runs(text.as_py() or "")).items():
                    word = mistyped(word, seed)
                    if len(word) >= LEAST_POINTS:
                        held[word] = held.get(word, 0) + n
                if len(held) >= HELD:
                    yield passed()
        if held:
            yield passed()

    ready(docs)
    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(counted, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TIMES)


def gram_order(words: DataFrame) -> list[str]:
    """All bigrams of the words, the rarest first."""
    at = F.explode(F.sequence(F.lit(1), F.length("word") - (GRAM - 1)))
    grams = words.select("word", at.alias("at")).select(F.substring("word", F.col("at"), F.lit(GRAM)).alias("g"))
    return [r["g"] for r in grams.groupBy("g").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "g").collect()]


def pivots(places: list[tuple[int, int]], picks: int = EDITS + 1) -> list[int]:
    """Of (position, cost) in order of position, ``picks`` positions of bigrams that do not
    overlap, of least total cost: best[j][k] is the cheapest choice of j among the first k."""
    none = (float("inf"), ())
    best = [[(0, ())] * (len(places) + 1)] + [[none] * (len(places) + 1) for _ in range(picks)]
    for j in range(1, picks + 1):
        for k, (at, cost) in enumerate(places, 1):
            free = k - 1
            while free and places[free - 1][0] > at - GRAM:
                free -= 1
            before = best[j - 1][free]
            best[j][k] = min(best[j][k - 1], (before[0] + cost, (*before[1], at)))
    return list(best[picks][-1][1])


def prefix_and_pivots(word: str, order: dict[str, int]) -> tuple[list[int], list[int], int]:
    """(positions of the prefix, of the pivots, rank of the prefix' last bigram)."""
    grams = sorted((order[word[k:k + GRAM]], k) for k in range(len(word) - GRAM + 1))
    last = grams[min(PREFIX, len(grams)) - 1][0]
    chosen = pivots(sorted((k, rank) for rank, k in grams[:PREFIX]))
    return [k for rank, k in grams if rank <= last], chosen, last


def keys(word: str, at: int, lengths) -> Iterator[int]:
    """Keys of the bigram at ``at``, for each length (less or more by ``lengths``) that the
    side with the edit may have in the other word: what is equal on both sides."""
    mixed = xxhash.xxh3_64_intdigest
    for tag, equal, edited in (("<", word[:at + GRAM], word[at + GRAM:]), (">", word[at:], word[:at][::-1])):
        # seen from the bigram outwards: the near half is equal, or the far half is
        m = len(edited)
        for other in lengths:
            n = m + other
            if n < 0:
                continue
            near, far = n // 2, n - n // 2
            if near <= m:
                yield mixed(f"{tag}{n},n,{equal},{edited[:near]}".encode()) - (1 << 63)
            if far <= m:
                yield mixed(f"{tag}{n},f,{equal},{edited[m - far:]}".encode()) - (1 << 63)


def gram_keys(words: DataFrame, order: list[str], pivotal: bool) -> DataFrame:
    """(key, word, n, last): of each word's pivots, or of its prefix."""
    shipped = ready(words).sparkContext.broadcast({g: k for k, g in enumerate(order)})
    lengths = (0,) if pivotal else (-1, 0, 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shipped.value
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                found, of, lasts = [], [], []
                for k, word in enumerate(part.column(0).to_pylist()):
                    prefix, chosen, last = prefix_and_pivots(word, order)
                    own = {x for at in (chosen if pivotal else prefix) for x in keys(word, at, lengths)}
                    found += own
                    of += [k] * len(own)
                    lasts += [last] * len(own)
                kept = part.take(pa.array(of, pa.int64()))
                yield pa.record_batch([pa.array(found, pa.int64()), *kept.columns, pa.array(lasts, pa.int32())],
                                      names=["key", "word", "n", "last"])

    return words.select("word", "n").mapInArrow(rows, "key long, word string, n long, last int")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of all words exactly one edit apart, in both directions."""
    order = gram_order(words)
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = words.repartition(parts, "word")  # a word makes dozens of keys: small files are much work
    s = gram_keys(words, order, True).toDF("key", "s", "s_n", "s_last")
    r = gram_keys(words, order, False).toDF("key", "r", "r_n", "r_last")
    pairs = s.join(r.hint("merge"), (s["key"] == r["key"]) & (F.col("s_last") <= F.col("r_last")) & (F.col("s") != F.col("r"))
                   & (F.abs(F.length("s") - F.length("r")) <= EDITS) & (F.levenshtein("s", "r", EDITS) == EDITS))
    both = F.explode(F.array(F.struct(F.col("s").alias("word"), F.col("s_n").alias("n"), F.col("r").alias("other"),
                                      F.col("r_n").alias("other_n")),
                             F.struct(F.col("r").alias("word"), F.col("r_n").alias("n"), F.col("s").alias("other"),
                                      F.col("s_n").alias("other_n"))))
    return pairs.select(both.alias("p")).select("p.*").distinct()


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last.  Each turn doubles the
    steps; a form is several times as frequent as its word, so chains are short."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = now.select(F.col("word").alias("w_"), F.col("root").alias("up"))
        new = stored(now.join(up.hint("merge"), F.col("root") == F.col("w_"), "left").select(
            "word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "roots")
        if new.where("moved").isEmpty():
            return new.drop("moved")
        now = new.drop("moved")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = stored(word_counts(docs, id_col, text_col), "words")
    first = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("w")))
    near = stored(near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.first("n").alias("own"), first.alias("best")).select(
        "word", "n_near", F.when(-F.col("best.m") >= FORM_TIMES * F.col("own"), F.col("best.w")).alias("form"),
        F.when(-F.col("best.m") >= FORM_TIMES * F.col("own"), -F.col("best.m")).alias("form_n")), "near")
    roots = rooted(near.where("form is not null"))
    return words.join(near.hint("merge"), "word", "left").join(roots.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
