import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from panelspark.llm import spelling


def brute_words(rows):
    count = Counter()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows):
    words = brute_words(rows)
    near = {w: [v for v in words if v != w and one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def edited(rng, word, letters):
    k = rng.randrange(len(word))
    return rng.choice([word[:k] + word[k + 1:], word[:k] + rng.choice(letters) + word[k:],
                       word[:k] + rng.choice(letters) + word[k + 1:]])


def texts(seed, letters, n_words=60):
    """Words over few letters, so that many are near and bigrams repeat, with chains of
    variants of falling frequency."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(7, 12))) for _ in range(n_words)]
    pool = []
    for w in words:
        for times in (400, 60, 9, 5):
            pool += [w] * times
            w = edited(rng, w, letters)
    rng.shuffle(pool)
    return [(k, " ".join(rng.choice([w, w, w.upper(), w.title()]) + rng.choice(["", ".", "7", "ßœ"])
                         for w in pool[k::40])) for k in range(40)]


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = sorted(tuple(r) for r in spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect())
    want = brute(rows)
    assert got == want
    return want


def test_equal_brute_force(spark):
    want = check(spark, texts(1, "abé"))
    assert any(w[2] not in (w[0], w[1]) for w in want) and max(w[4] for w in want) > 3
    check(spark, texts(2, "abcdefghijkÀ×÷", 80))


def test_pairs_of_every_edit_are_found(spark):
    """All one-edit neighbours of words with repeated bigrams, at every place."""
    words = {"aaaaaa", "aaaaaaa", "abababab", "abcabcabc", "zzyyxxww"}
    for w in sorted(words):
        for k in range(len(w) + 1):
            words |= {w[:k] + c + w[k:] for c in "aq"} | {w[:k] + w[k + 1:]} | {w[:k] + c + w[k + 1:] for c in "bq" if k < len(w)}
    words = {w for w in words if len(w) >= 6}
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = {(r["word"], r["other"]) for r in spelling.near_words(df).collect()}
    assert got == {(a, b) for a in words for b in words if a != b and one_edit(a, b)}


def test_keys_never_travel_through_the_driver(spark):
    """Spark takes the keys for about as large as their words: those of a few would be broadcast."""
    words = spark.createDataFrame([("abcdefgh", 5), ("abcdefg", 9)], "word string, n long")
    near = spelling.near_words(words)
    assert near.count() == 2
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in spelling.variants(words.select(F.col("n").alias("doc_id"), F.repeat("word", 5).alias(
        "text")))._jdf.queryExecution().executedPlan().toString()


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = sorted(tuple(r) for r in spelling.variants(odd_docs).collect())
    assert got == brute(rows)
    assert spelling.variants(no_docs).collect() == []
    assert spelling.variants(odd_docs.where("text is null")).collect() == []


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 7)
    text = "Straße naïve’s abcdefghijklmnopqrstuvwxyz, x" * 3
    whole = [w.lower().encode("latin-1") for w in re.findall("[A-Za-zÀ-ÿ]+", text)]
    assert list(spelling.runs(text)) == whole


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(5)
    for _ in range(200):
        places = [(k, rng.randrange(50)) for k in sorted(rng.sample(range(12), 5))]
        want = min(a[1] + b[1] for a in places for b in places if b[0] - a[0] >= 2)
        cost = dict(places)
        got = spelling.pivots(places)
        assert got[1] - got[0] >= 2 and sum(cost[k] for k in got) == want
