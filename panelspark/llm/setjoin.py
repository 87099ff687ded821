"""Exact Jaccard self-join of five-word shingle sets by universe partition.

Sets of r and s shingles link (similarity 0.8 or more) only if they differ
in at most (r + s) / 9 shingles.  The universe of shingles is hashed into
more segments than that, so by the pigeonhole principle linked sets agree
on some segments:

- sizes form bands, each with its own number of segments; a set belongs to
  its band, and also to the band below while that has sets small enough to
  link with it;
- a segment is indexed either exactly (one signature of its content; it
  uses up one unit of the allowed difference) or with its one-deletion
  neighbourhood (signatures of the content and of the content less each
  shingle; agreement up to one shingle, two units);
- how many segments of a band get a neighbourhood is allocated by cost:
  signatures emitted against the pairs that chance agreements would bring,
  from the number of sets in the band;
- of the exact segments a set indexes a subset: linked sets share at least
  (segments - difference) of them, so in any order that all sets use, their
  first (difference + 1) meet.  The order puts large segments first, then
  those whose content is frequent (a bounded list, counted on a fixed sample
  of documents), and empty ones last, so that a passage which many documents
  share is indexed only where little else is left.

Sets that are equal form one class before all this: each task emits a
class's signatures once, and what several tasks emit is made distinct before
classes are compared, so copies are never compared with each other.  Every
text is cut into shingles once for this, in the pass that also indexes it.
Classes that share a signature are candidates, verified exactly on their
shingles.  A class's text is read again for this, and only what may be needed is
shuffled: a bitmap of bounded size screens the texts, which stay where they are (a bounded list
names those that pass without need), and the sets before they meet the pairs, and a parity sketch that grows with
the set rules out nearly all pairs that are not links.  Groups are not expanded into pairs: within a signature's classes
each is first compared with one of them, some rounds over; what that links becomes
a component, and only classes of one signature that are still in different
components are compared with each other, after a parity sketch has ruled out
what differs too much (it never rules out a link).  Classes that are still in
large groups then are grouped anew by the signatures of a second, independently
hashed universe partition, each class once, where linked sets meet as well.
Every pair that could join two components is tested, so the components are
those of all links.

A signature that an unusual share of all rows has (found on the same sample;
it changes the dealing only, never the result) is dealt over several tasks,
whose first classes are then compared with each other.

Defined results: null and empty texts, and texts of white space, have no
shingles, link with nothing and are their own component; fewer than five
words make one shingle; repeated rows are copies; a null id takes part and
is the component's id only where no id is known; an empty table gives an
empty result; further columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import n_words, ready, stored
from panelspark.llm.shingles import WIDTH, Words, mixed, shingle_set
from panelspark.operators.components import connected_components

#: Bands grow by this factor; spare segments, so that empty ones need not be
#: indexed; the assumed share of a set's shingles that an unrelated set has;
#: what verifying a pair costs in signatures.
GROWTH, SPARE, SHARED, PAIR_COST = 4, 1.15, 0.001, 4.0
#: A signature is dealt over several tasks when about so many rows have it; one
#: document in SAMPLE is counted; a content that FREQUENT of those have is indexed
#: late, and the list of them is at most so long.
HOT_ROWS, SALTS, SAMPLE, FREQUENT, LISTED = 200_000, 64, 16, 12, 16_384
#: Places of the parity sketch, and the most of the one that grows with the set; bits
#: of the bitmap that screens rows, of one of its buckets (as Spark has them), places of
#: a row in its bucket, and the most rows that pass unwanted and are listed to be left out;
#: rounds in which a signature's classes are compared with one of them before all that remain are.
PARITY, MOST_PLACES, SCREEN, BUCKET, PLACES, STRANGERS, STARS = 512, 65_536, 1 << 25, 1 << 15, 3, 200_000, 2
#: Groups of open classes above this size are split by further partitions of the
#: universe, at most so often, and dealt over tasks; classes that a task remembers.
GROUP, SPLITS, REMEMBERED = 256, 3, 500_000
#: Bands of the further partitions are narrow: fewer, larger segments agree by chance less.
NARROW = 1.25
_LEVEL, _SEGMENT, _NEAR = (np.uint64(c) for c in (0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15, 0xA0761D6478BD642F))


def band(n: int, growth: float = GROWTH) -> int:
    """Band of a set size: band b holds sizes from growth**b on."""
    b = 0
    while n >= growth ** (b + 1):
        b += 1
    return b


def largest(b: int, growth: float = GROWTH) -> int:
    """The largest size of band ``b``."""
    return math.ceil(growth ** (b + 1)) - 1


def difference(n: int, other: int) -> int:
    """The most shingles in which linked sets of these sizes differ."""
    return (n + other) // 9


def allocate(b: int, sets: int, shared: float = SHARED) -> tuple[int, int]:
    """(exact segments, segments with neighbourhood) of band ``b``."""
    top = GROWTH ** (b + 1) - 1
    most = difference(top, 5 * top // 4)
    mean = (GROWTH ** b + top) / 2

    def cost(near: int) -> float:
        exact = most - 2 * near + 1
        per = mean / (max(0, round(exact * SPARE)) + near)
        chance = lambda size: 1 + PAIR_COST * sets * shared ** max(size, 0)
        return max(0, exact) * chance(per) + near * (per + 1) * chance(per - 1)

    tries = sorted({0, 1, 2, (most + 2) // 4, (most + 2) // 2})
    near = min((x for x in tries if 2 * x <= most + 1), key=cost)
    exact = most - 2 * near + 1
    return (max(exact, round(exact * SPARE + 0.49)) if exact > 0 else 0), near


def roles(n: int, growth: float = GROWTH) -> list[tuple[int, int]]:
    """(band, allowed difference) of each band a set of ``n`` is indexed in."""
    out = [(band(n, growth), difference(n, 5 * n // 4))]
    for b in range(out[0][0] - 1, -1, -1):
        top = largest(b, growth)
        if 5 * top < 4 * n:
            break
        out.append((b, difference(n, top)))
    return out


def signatures(tokens: np.ndarray, plan: dict[int, tuple[int, int]], growth: float = GROWTH,
               late: np.ndarray | None = None, whole: bool = False) -> np.ndarray:
    """The set's signatures, as 64-bit numbers; ``plan`` has each band's segments,
    ``late`` the sorted signatures that come last among those that are not empty.
    ``whole``: all exact ones that are not empty, instead of the first."""
    out, weight = [], mixed(tokens)
    for b, allowed in roles(len(tokens), growth):
        exact, near = plan[b]
        total = exact + near
        segment = (tokens >> np.uint64(7)) % np.uint64(total)
        order = np.argsort(segment, kind="stable")
        seg, w = segment[order], weight[order]
        starts = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
        ids, sums, counts = seg[starts], np.add.reduceat(w, starts), np.diff(np.append(starts, len(seg)))
        base = mixed((np.arange(1, total + 1, dtype=np.uint64) * _SEGMENT) ^ (np.full(total, b + 1, np.uint64) * _LEVEL))
        if near:
            inside = ids < near
            full = np.zeros(near, np.uint64)
            full[ids[inside].astype(int)] = sums[inside]
            out.append(mixed(base[:near] + full + _NEAR))
            less = seg < near
            out.append(mixed(base[seg[less].astype(int)] + full[seg[less].astype(int)] - w[less] + _NEAR))
        need = allowed - 2 * near + 1
        if need > 0:
            at = ids >= near
            sig = mixed(base[ids[at].astype(int)] + sums[at])
            if whole:
                out.append(sig)
                continue
            order = (sig, -counts[at])
            if late is not None and len(late):
                order += (late[np.minimum(np.searchsorted(late, sig), len(late) - 1)] == sig,)
            sig = sig[np.lexsort(order)][:need]
            out.append(sig)
            if len(sig) < need:  # too few that are not empty: empty ones join, in their order
                empty = np.setdiff1d(np.arange(near, total), ids[at].astype(int), assume_unique=True)
                out.append(np.sort(mixed(base[empty]))[:need - len(sig)])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def set_class(tokens: np.ndarray, seed: int) -> tuple[bytes, int]:
    """(digest, 64-bit class) of a set."""
    d = hashlib.blake2b(tokens.tobytes(), digest_size=16, salt=seed.to_bytes(4, "little")).digest()
    return d, int.from_bytes(d[:8], "little", signed=True)


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def indexed(docs: DataFrame, id_col: str, text_col: str, plan: dict[int, tuple[int, int]], late: np.ndarray, seed: int,
            row_col: str | None = None) -> DataFrame:
    """(doc_id, n_shingles, digest, cls, row, text_hash, sigs) of every row; no class without
    shingles, and signatures only where a task meets a class for the first time."""
    kind = docs.schema[id_col].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = Words(), set()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                n, digests, classes, sigs = [], [], [], []
                for text in _texts(batch, 1):
                    tokens = shingle_set(text, words)
                    d, c = set_class(tokens, seed) if len(tokens) else (None, None)
                    n.append(len(tokens))
                    digests.append(d)
                    classes.append(c)
                    if c is None or c in seen:
                        sigs.append(None)
                        continue
                    if len(seen) >= REMEMBERED:
                        seen.clear()  # what comes again is made distinct later
                    seen.add(c)
                    sigs.append(signatures(tokens, plan, late=late).view(np.int64))
                yield pa.record_batch([
                    batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(classes, pa.int64()),
                    batch.column(2), batch.column(3), pa.array(sigs, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "digest", "cls", "row", "text_hash", "sigs"])

    row = F.col(row_col) if row_col else F.lit(None)
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col), text, row.cast("long").alias("row_of_"), F.xxhash64(text).alias("hash_of_")).mapInArrow(
        sets, f"doc_id {kind}, n_shingles long, digest binary, cls long, row long, text_hash long, sigs array<bigint>")


def contents(docs: DataFrame, text_col: str, plan: dict[int, tuple[int, int]], seed: int) -> DataFrame:
    """(sig, cls) of every exact segment of every row that is not empty."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                sets = [t for t in (shingle_set(t, words) for t in _texts(batch.slice(at, 512), 0)) if len(t)]
                sigs = [signatures(t, plan, whole=True).view(np.int64) for t in sets]
                if sigs:
                    yield _columns(sigs, [np.full(len(x), set_class(t, seed)[1]) for t, x in zip(sets, sigs)])

    return docs.select(F.col(text_col).cast("string")).mapInArrow(rows, "sig long, cls long")


def _columns(sigs, classes) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.concatenate(sigs)), pa.array(np.concatenate(classes))], names=["sig", "cls"])


def screened(rows: DataFrame, keys: list[str], wanted: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` without most of those whose ``keys`` are not among the ``names`` of ``wanted``;
    none whose are is lost.  What is broadcast is a bitmap of SCREEN bits, whatever the sizes;
    each key has several places in one of its buckets, all of which must be set."""
    buckets = SCREEN // BUCKET

    def spots(columns: list[str]) -> list:
        h = F.xxhash64(*columns)
        bits = (buckets * BUCKET ** k for k in range(PLACES))
        return [F.pmod(h, F.lit(buckets)), *[F.pmod(F.shiftrightunsigned(h, b.bit_length() - 1), F.lit(BUCKET)) for b in bits]]

    bucket, *at = spots(names)
    maps = wanted.select(bucket.alias("bucket_"), F.explode(F.array(*at)).alias("at_")).groupBy("bucket_").agg(
        F.bitmap_construct_agg("at_").alias("map_"))
    bucket, *at = spots(keys)

    def is_set(place):
        byte = F.conv(F.hex(F.substr("map_", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (place % 8).cast("int")) == 1

    return rows.join(F.broadcast(maps), functools.reduce(lambda x, y: x & y, map(is_set, at), bucket == F.col("bucket_")), "left_semi")


def strangers(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key) of the ``rows`` (doc_id, text_hash) that pass the bitmap of the wanted (first, text_hash) without being wanted."""
    keys = screened(rows, ["doc_id", "text_hash"], wanted, ["first", "text_hash"]).select(
        F.xxhash64("doc_id", "text_hash").alias("key")).distinct()
    return stored(keys.join(wanted.select(F.xxhash64("first", "text_hash").alias("key")), "key", "left_anti"), "strangers")


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, seed: int,
                 rows: DataFrame | None = None) -> DataFrame:
    """(cls, n, bits, fine, tokens) of the wanted (cls, first, text_hash): the text of each
    class's first document is read again where it lies; no text is shuffled.  A class comes
    once from each task that has this document; a few other classes and copies come too
    without the ``rows`` (doc_id, text_hash) of ``docs``, or where more than STRANGERS of them
    pass the bitmap unwanted."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = Words(), set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = {}
                for text in _texts(batch.slice(at, 256), 0):
                    tokens = shingle_set(text, words)
                    c = set_class(tokens, seed)[1]
                    if len(tokens) and c not in seen:
                        found.setdefault(c, tokens)
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.update(found)
                lists = lambda values: pa.array(values, pa.list_(pa.int64()))
                yield pa.record_batch([pa.array(list(found), pa.int64()),
                                       pa.array([len(t) for t in found.values()], pa.int32()),
                                       lists([parity(t) for t in found.values()]),
                                       lists([parity(t, places(len(t))) for t in found.values()]),
                                       lists([t.view(np.int64) for t in found.values()])],
                                      names=["cls", "n", "bits", "fine", "tokens"])

    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("i_"), F.xxhash64(text).alias("h_"), text.alias("t_"))
    texts = screened(texts, ["i_", "h_"], wanted, ["first", "text_hash"])
    if rows is not None:
        unwanted = strangers(rows, wanted)
        if 0 < unwanted.count() <= STRANGERS:
            texts = texts.join(F.broadcast(unwanted), F.xxhash64("i_", "h_") == F.col("key"), "left_anti")
    return texts.select("t_").mapInArrow(
        sets, "cls long, n int, bits array<bigint>, fine array<bigint>, tokens array<bigint>")


def once(sets: DataFrame) -> DataFrame:
    """``sets``, dealt by class only where one comes more than twice, as with rows that are
    repeated whole; a second time changes no result, since pairs are made distinct."""
    most = sets.groupBy("cls").count().agg(F.max("count")).first()[0]
    return sets if (most or 0) <= 2 else stored(sets.dropDuplicates(["cls"]), "sets")


def places(n: int) -> int:
    """Places of the sketch that grows with the set: twice as many as shingles, as a power of two."""
    return min(MOST_PLACES, max(PARITY, 1 << (2 * n - 1).bit_length()))


def parity(tokens: np.ndarray, most: int = PARITY) -> np.ndarray:
    """Whether an odd number of shingles falls on each of ``most`` places, as
    64-bit numbers.  Two sets' parities differ in at most as many places as
    the sets differ in shingles."""
    odd = (np.bincount((tokens >> np.uint64(40)) % np.uint64(most), minlength=most) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def may_link(a: str, b: str):
    """Sizes and parities of two sides (n, bits with these prefixes) leave a
    similarity of 0.8 possible; never false for sets that link."""
    x, y = F.col(f"{a}bits"), F.col(f"{b}bits")
    apart = F.lit(0)
    for k in range(PARITY // 64):
        apart = apart + F.bit_count(x[k].bitwiseXOR(y[k]))
    return near(f"{a}n", f"{b}n") & (9 * apart <= F.col(f"{a}n") + F.col(f"{b}n"))


def near(n: str, m: str):
    return (5 * F.col(n) >= 4 * F.col(m)) & (5 * F.col(m) >= 4 * F.col(n))


def apart(a: str, b: str):
    """Places in which two parities differ, the longer one folded to the length of the
    shorter: sizes that may link differ by less than two, so lengths by two at most."""
    words = F.least(F.size(a), F.size(b))
    short = lambda c: F.transform(F.slice(c, F.lit(1), words), lambda x, k: F.when(
        F.size(c) > words, x.bitwiseXOR(F.get(F.col(c), k + words))).otherwise(x))
    return F.aggregate(F.zip_with(short(a), short(b), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have similarity 0.8 or more.  The sketch that grows
    with the set goes first; it never rules out a link."""
    side = lambda k: sets.select(*[F.col(c).alias(k + c) for c in ("cls", "n", "fine")])
    likely = stored(pairs.join(side("a"), F.col("a") == F.col("acls")).join(side("b"), F.col("b") == F.col("bcls"))
                    .where(near("an", "bn") & (9 * apart("afine", "bfine") <= F.col("an") + F.col("bn")))
                    .select("a", "b"), "likely")
    both = likely.select(F.explode(F.array("a", "b")).alias("cls"))  # one for both sides: Spark deals the sets once
    some = screened(sets.select("cls", "tokens"), ["cls"], both, ["cls"])
    a, b = (some.select(F.col("cls").alias(k), F.col("tokens").alias(f"t{k}")) for k in "ab")
    both = F.size(F.array_intersect("ta", "tb"))
    return likely.join(a, "a").join(b, "b").where(
        9 * both >= 4 * (F.size("ta") + F.size("tb"))).select("a", "b")


def frequent(docs: DataFrame, id_col: str, text_col: str, plan, seed: int) -> list:
    """(sig, n) of the most frequent contents of segments among the documents of the
    sample, LISTED at most."""
    some = docs.where(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(SAMPLE)) == 0)
    return (contents(some, text_col, plan, seed).distinct().groupBy("sig").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "sig").limit(LISTED).collect())


def hot_signatures(spark, found: list, rows: int, total: int, hot_rows: int) -> DataFrame | None:
    """Signatures of an unusual share of rows: at most four for each shuffle
    partition, whatever the input's size."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = max(hot_rows, total // (4 * parts))
    hot = [(r["sig"],) for r in found[:4 * parts] if r["n"] * SAMPLE >= least]
    return spark.createDataFrame(hot, "sig long") if hot and rows >= least else None


def members_of(rows: DataFrame, hot: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Distinct rows of signatures that several classes have, as (sig, cls),
    and the pairs (a, b) of each with its signature's first class."""
    keys = ["sig"]  # no constant beside it: Spark would leave it out of the window and deal the rows twice
    if hot is not None:
        keys = ["sig", "salt"]
        hot = F.broadcast(hot.select(F.col("sig").alias("h_")))  # its size is bounded
        rows = rows.join(hot, F.col("sig") == F.col("h_"), "left").withColumn("salt", F.when(
            F.col("h_").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("cls"), F.lit(SALTS)))).drop("h_")
    w = Window.partitionBy(*keys)
    rows = rows.repartition(*keys).dropDuplicates([*keys, "cls"])  # one exchange with the window's
    rows = rows.withColumns({"first": F.min("cls").over(w), "last": F.max("cls").over(w)})
    rows = stored(rows.where("first < last" if hot is None else "first < last or salt > 0").select(*keys, "cls", "first"), "members")
    pairs = rows.where("first < cls").select(F.col("first").alias("a"), F.col("cls").alias("b"))
    if hot is not None:
        firsts = rows.where("salt > 0").select("sig", "first").distinct()
        firsts = firsts.withColumn("a", F.min("first").over(Window.partitionBy("sig")))
        pairs = pairs.unionByName(firsts.where("a < first").select("a", F.col("first").alias("b")))
    return rows.select("sig", "cls"), pairs.distinct()


def planned(docs: DataFrame, text_col: str, shared: float) -> dict[int, tuple[int, int]]:
    """Each band's segments, from the numbers of words in the texts."""
    size = F.greatest(n_words(F.col(text_col).cast("string")) - (WIDTH - 1), F.lit(1)).cast("double")
    band_of = F.floor(F.log(size) / F.log(F.lit(float(GROWTH))) + 1e-9)
    counts = {int(r["b"]): r["sets"] for r in docs.groupBy(band_of.alias("b")).agg(
        F.count(F.lit(1)).alias("sets")).collect()}  # a row per band
    return {b: allocate(b, counts.get(b, 1), shared) for b in range(max(counts, default=0) + 1)}


def linked_classes(docs: DataFrame, id_col: str, text_col: str, rows: DataFrame, classes: DataFrame, found: list,
                   seed: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(cls, component) of the classes that link with another; ``rows`` as indexed() has them."""
    whole = classes.agg(F.sum("n").alias("tokens"), F.sum("copies").alias("rows")).first()
    hot = hot_signatures(docs.sparkSession, found, whole["rows"] or 0, (whole["tokens"] or 0) // 3, hot_rows)
    members, pairs = members_of(rows.where("sigs is not null").select(F.explode("sigs").alias("sig"), "cls"), hot)
    wanted = stored(members.select("cls").distinct().join(classes.select("cls", "first", "text_hash"), "cls"), "wanted")
    sets = once(stored(shingle_sets(docs, id_col, text_col, wanted, seed, rows), "sets"))
    sketch = sets.select("cls", "n", "bits")
    side = lambda k: sketch.select(*[F.col(c).alias(k + c) for c in ("cls", "n", "bits")])
    first = (pairs.join(side("a"), F.col("a") == F.col("acls")).join(side("b"), F.col("b") == F.col("bcls"))
             .where(may_link("a", "b")).select("a", "b"))
    links = stored(verified(first, sets), "star_links")
    parts = stored(connected_components(wanted.select("cls"), links, "cls", "a", "b"), "star_parts")
    open_ = still_open(members, parts, sketch)
    stars = star(open_, 0)
    for turn in range(1, STARS):
        stars = stars.unionByName(star(open_, turn))
    parts = merged(parts, verified(stars.distinct(), sets))
    open_ = still_open(open_.select("sig", "cls"), parts, sketch)  # the others are in one component
    cross = crossed(narrowed(open_.select(F.col("sig").alias("key"), "cls", "component"), sets), sketch)
    return merged(parts, verified(cross, sets))


def still_open(members: DataFrame, parts: DataFrame, sketch: DataFrame) -> DataFrame:
    """Rows (sig, cls, component, n, bits) of the signatures whose classes
    are still in several components."""
    placed = members.join(parts, "cls")
    split = placed.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return stored(placed.join(split.where("lo < hi").select("sig"), "sig", "left_semi").join(sketch, "cls"), "open")


def star(open_: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each class with one class of its signature, another one
    each turn, where they are in different components and may link."""
    fields = ["cls", "component", "n", "bits"]
    centre = open_.groupBy("sig").agg(F.min(F.struct(
        F.xxhash64("cls", F.lit(turn)).alias("k"), *fields)).alias("m")).select(
        "sig", *[F.col(f"m.{c}").alias("a" + c) for c in fields])
    both = open_.select("sig", *[F.col(c).alias("b" + c) for c in fields]).join(stored(centre, "centres"), "sig")
    return both.where((F.col("acomponent") != F.col("bcomponent")) & may_link("a", "b")).select(
        F.col("acls").alias("a"), F.col("bcls").alias("b")).distinct()


def sized(rows: DataFrame) -> DataFrame:
    """Rows (key, cls, component, size) of the keys that several components have."""
    keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("lo"),
                                   F.max("component").alias("hi")).where("lo < hi").select("key", "size")
    return stored(rows.select("key", "cls", "component").join(keys, "key"), "sized")


def finer(sets: DataFrame, turn: int) -> DataFrame:
    """(cls, fine): signatures in another partition of the universe, all exact;
    linked sets share one."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan: dict[int, tuple[int, int]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for tokens in part.column(1):
                    t = mixed(tokens.values.to_numpy(zero_copy_only=False).view(np.uint64) + np.uint64(turn + 1) * _SEGMENT)
                    plan.update({b: exact_only(b, NARROW) for b, _ in roles(len(t), NARROW) if b not in plan})
                    out.append(np.unique(signatures(t, plan, NARROW)).view(np.int64))
                yield pa.record_batch([part.column(0), pa.array(out, pa.list_(pa.int64()))], names=["cls", "fine"])

    return sets.select("cls", "tokens").mapInArrow(rows, "cls long, fine array<bigint>")


def exact_only(b: int, growth: float) -> tuple[int, int]:
    """As allocate(), without neighbourhoods."""
    top = largest(b, growth)
    exact = difference(top, 5 * top // 4) + 1
    return max(exact, round(exact * SPARE + 0.49)), 0


def narrowed(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (key, cls, component, size) such that linked classes of one key
    and different components in ``rows`` (key, cls, component) still share a
    key.  The classes of large groups are grouped anew, each once, by finer
    signatures, while that at least halves the pairs of large groups."""
    rows, done = sized(rows), []
    for turn in range(SPLITS):
        large = rows.where(F.col("size") > GROUP)
        pairs = large.agg(F.sum("size")).first()[0]
        if not pairs:
            break
        wanted = stored(large.select("cls", "component").distinct(), "large")
        some = screened(sets.select("cls", "tokens"), ["cls"], wanted, ["cls"])
        fine = sized(finer(some.join(wanted, "cls", "left_semi"), turn).join(wanted, "cls").select(
            F.explode("fine").alias("key"), "cls", "component"))
        if 2 * (fine.agg(F.sum("size")).first()[0] or 0) > pairs:
            break
        done.append(rows.where(F.col("size") <= GROUP))
        rows = fine
    for small in done:
        rows = rows.unionByName(small)
    return rows


def crossed(rows: DataFrame, sketch: DataFrame) -> DataFrame:
    """Pairs (a, b) of one key's classes that are in different components and
    may link; a large group's first sides are dealt over tasks."""
    rows = rows.join(sketch, "cls").withColumn("deals", F.ceil(F.col("size") / GROUP).cast("int"))
    side = lambda df, k: df.select("key", "deal", *[F.col(c).alias(k + c) for c in ("cls", "component", "n", "bits")])
    a = rows.withColumn("deal", F.pmod(F.xxhash64("cls"), F.col("deals")).cast("int"))
    b = rows.withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    return (side(a, "a").join(side(b, "b"), ["key", "deal"])
            .where((F.col("acls") < F.col("bcls")) & (F.col("acomponent") != F.col("bcomponent")) & may_link("a", "b"))
            .select(F.col("acls").alias("a"), F.col("bcls").alias("b")).distinct())


def merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts`` with the components joined that ``links`` (a, b) connect."""
    links = stored(links, "links")
    if links.isEmpty():
        return parts
    joins = (links.join(parts.select(F.col("cls").alias("a"), F.col("component").alias("ca")), "a")
             .join(parts.select(F.col("cls").alias("b"), F.col("component").alias("cb")), "b")
             .select("ca", "cb").distinct())
    whole = connected_components(parts.select("component").distinct(), stored(joins, "joins"), "component", "ca", "cb")
    whole = whole.toDF("part", "whole")
    return stored(parts.join(whole, F.col("component") == F.col("part"))
                  .select("cls", F.col("whole").alias("component")), "parts")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shared: float = SHARED, hot_rows: int = HOT_ROWS, row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id; with
    ``row_col``, which numbers the rows, also row and component (a number that
    does not depend on ids; null without shingles)."""
    ready(docs)
    plan = planned(docs, text_col, shared)
    for seed in range(8):
        found = frequent(docs, id_col, text_col, plan, seed)
        late = np.sort(np.array([r["sig"] for r in found], np.int64).view(np.uint64))
        rows = stored(indexed(docs, id_col, text_col, plan, late, seed, row_col), "indexed")
        classes = stored(rows.where("n_shingles > 0").groupBy("digest", "cls").agg(
            F.min("doc_id").alias("first"), F.coalesce(F.min_by("text_hash", "doc_id"), F.min("text_hash")).alias("text_hash"),
            F.first("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies")),
            "classes")
        seen = classes.agg(F.count("cls").alias("n"), F.count_distinct("cls").alias("k")).first()
        if seen["n"] == seen["k"]:  # no two different sets share a class number
            break
    else:
        raise ValueError("class numbers clash under every seed")
    parts = linked_classes(docs, id_col, text_col, rows, classes, found, seed, hot_rows)
    named = classes.select("cls", "first").join(parts, "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))
    ids = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(named.join(ids, "component").select("cls", "component_id", "component"), "components")
    return rows.join(named, "cls", "left").select(
        "doc_id", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"), *(["row", "component"] if row_col else []))


def superfluous(docs: DataFrame, row_col: str, **options) -> DataFrame:
    """(row) of the rows that go when one row of each component stays: the one with the
    smallest id, one without an id last, and among equal ids the first row.  Rows
    without shingles all stay."""
    groups = near_duplicates(docs, row_col=row_col, **options).where("component is not null")
    first = groups.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")).select("first.row")
    return groups.join(first, "row", "left_anti").select("row")


ORACLE = r"""
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT w.doc_id, count(g.g) AS n FROM w LEFT JOIN g USING (doc_id) GROUP BY w.doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS to_id FROM n UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.to_id)
SELECT n.doc_id, n.n AS n_shingles, m.component_id
FROM n JOIN (SELECT id, min(to_id) AS component_id FROM r GROUP BY id) m ON m.id = n.doc_id
"""
