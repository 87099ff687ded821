import random

import numpy as np
import pytest

from panelspark.llm import setjoin
from panelspark.llm.shingles import Words, shingle_set


def brute(rows):
    sets = []
    for _, t in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * n >= 80 * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    groups = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            groups[root(k)] = min(i, groups.get(root(k), i))
    return sorted([(i, len(s), groups.get(root(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))], key=str)


def near_copies(seed, n=160):
    rng = random.Random(seed)
    words = [f"v{k}" for k in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(55))
    texts, rows = [], []
    for _ in range(n):
        if texts and rng.random() < 0.7:
            w = rng.choice(texts).split(" ")
            for _ in range(rng.randrange(0, max(2, len(w) // 40))):
                w[rng.randrange(len(w))] = rng.choice(words)
            if rng.random() < 0.3:
                w = w[:len(w) - rng.randrange(0, 1 + len(w) // 6)]
            texts.append(" ".join(w))
        else:
            texts.append(" ".join(rng.choice(words) for _ in range(rng.choice([3, 8, 17, 40, 80, 150, 300, 700])))
                         + (" " + passage if rng.random() < 0.3 else ""))
        rows.append((len(rows), texts[-1]))
    return rows


@pytest.mark.parametrize("seed,shared,hot", [(1, 0.001, 10 ** 6), (2, 0.3, 10 ** 6), (3, 0.001, 1)])
def test_components_equal_brute_force(spark, seed, shared, hot, monkeypatch):
    """Exact segments; neighbourhoods (a high share makes them pay); split
    signatures (the sample is all rows and every signature counts as hot)."""
    monkeypatch.setattr(setjoin, "SAMPLE", 1)
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = setjoin.near_duplicates(docs, shared=shared, hot_rows=hot).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_odd_rows(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(map(tuple, setjoin.near_duplicates(odd_docs).collect()), key=str) == brute(rows)


def test_empty_table(no_docs):
    assert setjoin.near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("shared", [0.001, 0.3])
def test_linked_sets_share_a_signature(shared):
    """The pigeonhole holds at the edge of similarity, across sizes and bands."""
    rng = np.random.default_rng(4)
    plan = {b: setjoin.allocate(b, 10 ** 6, shared) for b in range(8)}
    if shared > 0.1:
        assert any(near for _, near in plan.values())
    for n in [1, 2, 4, 5, 9, 15, 16, 17, 63, 64, 65, 70, 255, 256, 300, 1023, 1024, 1200, 4000]:
        for _ in range(12):
            base = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
            grow = int(rng.integers(0, len(base) // 4 + 1))
            drop = int(rng.integers(0, max(1, (len(base) * 2) // 9 - grow + 1)))
            other = np.unique(np.concatenate([base[drop:], rng.integers(0, 2 ** 63, grow).astype(np.uint64)]))
            both = len(np.intersect1d(base, other))
            if 9 * both >= 4 * (len(base) + len(other)):
                assert set(setjoin.signatures(base, plan).tolist()) & set(setjoin.signatures(other, plan).tolist())
                late = np.sort(rng.permutation(setjoin.signatures(base, plan, whole=True))[:len(base) // 3])
                assert set(setjoin.signatures(base, plan, late=late).tolist()) & set(
                    setjoin.signatures(other, plan, late=late).tolist())


def test_shingles():
    w = Words(most=3)
    assert len(shingle_set(b"", w)) == len(shingle_set(None, w)) == len(shingle_set(b" \t\n", w)) == 0
    assert len(shingle_set(b"a b c", w)) == 1 and len(shingle_set(b"a b c d e f", w)) == 2
    assert (shingle_set(b"A B c d e", w) == shingle_set(b"a\nb  c d e ", w)).all()
    assert (shingle_set("É b".encode(), w) != shingle_set("é b".encode(), w)).all()


def test_parity_never_rules_out_a_link(spark):
    rng = np.random.default_rng(9)
    rows = []
    for n in (1, 5, 40, 300, 2000):
        for _ in range(6):
            base = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
            other = base.copy()
            drop = n // 9
            other = np.unique(np.concatenate([other[drop:], rng.integers(0, 2 ** 63, n // 10).astype(np.uint64)]))
            both = len(np.intersect1d(base, other))
            rows.append((len(base), setjoin.parity(base).tolist(), len(other), setjoin.parity(other).tolist(),
                         9 * both >= 4 * (len(base) + len(other))))
    far = rng.integers(0, 2 ** 63, (2, 200)).astype(np.uint64)
    rows.append((200, setjoin.parity(far[0]).tolist(), 200, setjoin.parity(far[1]).tolist(), False))
    df = spark.createDataFrame(rows, "an int, abits array<bigint>, bn int, bbits array<bigint>, linked boolean")
    got = df.select("linked", setjoin.may_link("a", "b").alias("may")).collect()
    assert any(r["linked"] for r in got) and all(r["may"] for r in got if r["linked"]) and not got[-1]["may"]


def test_copies_are_one_member_of_a_signature(spark):
    """Copies in one task emit a class once; what several tasks emit is made distinct."""
    texts = ["a b c d e f g h"] * 30 + ["one two three four five six"] * 2
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    plan = {b: setjoin.allocate(b, 1) for b in range(3)}
    alone = setjoin.indexed(docs.coalesce(1), "doc_id", "text", plan, np.zeros(0, np.uint64), 0)
    alone = alone.where("sigs is not null").selectExpr("explode(sigs) as sig", "cls")
    assert alone.count() == alone.distinct().count() > 0
    rows = spark.createDataFrame([(1, 5), (1, 5), (1, 5), (1, 7), (2, 5), (2, 5)], "sig long, cls long").repartition(3)
    for hot in (None, spark.createDataFrame([(1,)], "sig long")):
        members, _ = setjoin.members_of(rows, hot)
        assert sorted(map(tuple, members.collect())) == [(1, 5), (1, 7)]


def passages(seed, n=120):
    """Texts that share a passage, some with a near copy that no first comparison finds."""
    rng = random.Random(seed)
    words = [f"v{k}" for k in range(4000)]
    passage = " ".join(rng.choice(words) for _ in range(30))
    rows = []
    for k in range(n):
        own = [rng.choice(words) for _ in range(70)]
        rows.append((len(rows), " ".join(own) + " " + passage))
        if k % 4 == 0:
            own[rng.randrange(70)] = "changed"
            rows.append((len(rows), " ".join(own) + " " + passage))
    return rows


def test_linked_sets_share_a_finer_signature():
    rng = np.random.default_rng(7)
    plan = {b: setjoin.exact_only(b, setjoin.NARROW) for b in range(45)}
    linked = 0
    for n in [1, 2, 3, 4, 5, 6, 9, 10, 15, 16, 24, 25, 63, 64, 65, 100, 156, 300, 1200, 4000]:
        for _ in range(40):
            base = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
            grow = int(rng.integers(0, len(base) // 4 + 1))
            drop = int(rng.integers(0, max(1, (len(base) * 2) // 9 - grow + 1)))
            other = np.unique(np.concatenate([base[drop:], rng.integers(0, 2 ** 63, grow).astype(np.uint64)]))
            if 9 * len(np.intersect1d(base, other)) >= 4 * (len(base) + len(other)):
                linked += 1
                a, b = (set(setjoin.signatures(x, plan, setjoin.NARROW).tolist()) for x in (base, other))
                assert a & b
    assert linked > 200


@pytest.mark.parametrize("seed", [5])
def test_large_open_groups_are_split_without_loss(spark, seed, monkeypatch):
    monkeypatch.setattr(setjoin, "GROUP", 8)
    monkeypatch.setattr(setjoin, "STARS", 1)
    monkeypatch.setattr(setjoin, "FREQUENT", 10 ** 6)  # no content comes late
    rows = passages(seed)
    narrow, sizes = setjoin.narrowed, []

    def watched(open_, sets):
        got = narrow(open_, sets)
        sizes.append((open_.join(open_.groupBy("key").count(), "key").groupBy().sum("count").first()[0] or 0,
                      got.groupBy().sum("size").first()[0] or 0))
        return got
    monkeypatch.setattr(setjoin, "narrowed", watched)
    got = setjoin.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert sizes[0][1] < sizes[0][0] / 2


def test_frequent_contents_are_indexed_late(spark, monkeypatch):
    """With the passage's contents listed, no signature has nearly all texts; the links are the same."""
    monkeypatch.setattr(setjoin, "SAMPLE", 1)
    rows, largest = passages(6), []
    members_of = setjoin.members_of

    def watched(rows_, hot):
        largest.append(rows_.distinct().groupBy("sig").count().groupBy().max("count").first()[0])
        return members_of(rows_, hot)
    monkeypatch.setattr(setjoin, "members_of", watched)
    for least in (10 ** 6, 12):
        monkeypatch.setattr(setjoin, "FREQUENT", least)
        got = setjoin.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted(map(tuple, got), key=str) == brute(rows)
    assert 4 * largest[1] < largest[0]


def test_members_are_dealt_once(spark, monkeypatch):
    """One exchange brings a signature's rows together, with and without hot signatures."""
    plans = []

    def keep(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(setjoin, "stored", keep)
    rows = spark.createDataFrame([(1, 10), (1, 10), (1, 11), (2, 12), (3, 13), (3, 14), (3, 15)], "sig long, cls long")
    for hot in (None, spark.createDataFrame([(3,)], "sig long")):
        members, pairs = setjoin.members_of(rows, hot)
        assert plans[-1].count("Exchange hashpartitioning") == 1
        got = {tuple(r) for r in pairs.collect()}
        if hot is None:
            assert got == {(10, 11), (13, 14), (13, 15)}
            assert sorted(map(tuple, members.collect())) == [(1, 10), (1, 11), (3, 13), (3, 14), (3, 15)]


def test_screen_loses_none_and_drops_most(spark):
    rows = spark.range(20_000).selectExpr("if(id = 7, null, id) as i_", "xxhash64(id) as h_")
    wanted = rows.where("i_ is null or i_ % 100 = 3").toDF("first", "text_hash")
    got = {r["i_"] for r in setjoin.screened(rows, ["i_", "h_"], wanted, ["first", "text_hash"]).collect()}
    want = {None, *range(3, 20_000, 100)}
    assert want <= got and len(got) < len(want) + 100
    assert setjoin.screened(rows, ["i_", "h_"], wanted.where("false"), ["first", "text_hash"]).collect() == []


def test_texts_are_screened_and_not_dealt(spark):
    """Of the texts only those of wanted classes become sets, and none is shuffled, also
    where the ids repeat or are null."""
    docs = spark.createDataFrame([(None if k % 3 else k % 12, f"a{k % 40} b c d e f{k % 40}") for k in range(400)],
                                 "doc_id long, text string").coalesce(4)
    plan = {b: setjoin.allocate(b, 1) for b in range(3)}
    rows = setjoin.indexed(docs, "doc_id", "text", plan, np.zeros(0, np.uint64), 0)
    classes = sorted({r["cls"]: r for r in rows.collect()}.values(), key=lambda r: r["cls"])[:5]
    wanted = spark.createDataFrame([(r["cls"], r["doc_id"], r["text_hash"]) for r in classes], "cls long, first long, text_hash long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sets = setjoin.shingle_sets(docs, "doc_id", "text", wanted, 0)
        text = sets._jdf.queryExecution().executedPlan().toString()
        got = [r["cls"] for r in sets.collect()]
        whole = [r["cls"] for r in setjoin.once(sets).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in text and text.count("Exchange hashpartitioning") == 1  # the bitmap's own
    assert len(got) <= 5 * 4 and set(got) == {r["cls"] for r in classes} and set(whole) == set(got) and len(whole) <= 10


def test_growing_sketch_never_rules_out_a_link_and_rules_out_most_others(spark, monkeypatch):
    rng = np.random.default_rng(12)
    sets, pairs, linked, stored = [], [], [], []
    for n in (1, 5, 40, 250, 300, 511, 600, 1000, 2000, 5000):
        for share in (0.0, 0.05, 0.1, 0.11, 0.15, 0.2, 0.4):
            base = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
            other = np.unique(np.concatenate([base[int(n * share):], rng.integers(0, 2 ** 63, int(n * share)).astype(np.uint64)]))
            a = len(sets)
            for t in (base, other):
                sets.append((len(sets), len(t), setjoin.parity(t, setjoin.places(len(t))).tolist(), t.view(np.int64).tolist()))
            pairs.append((a, a + 1))
            if 9 * len(np.intersect1d(base, other)) >= 4 * (len(base) + len(other)):
                linked.append((a, a + 1))
    monkeypatch.setattr(setjoin, "stored", lambda df, name: stored.append(df) or df)
    frame = spark.createDataFrame(sets, "cls long, n int, fine array<bigint>, tokens array<bigint>")
    got = setjoin.verified(spark.createDataFrame(pairs, "a long, b long"), frame).collect()
    assert sorted(map(tuple, got)) == sorted(linked)
    likely = sorted(map(tuple, stored[0].collect()))
    assert set(linked) <= set(likely) and len(likely) < len(linked) + 10


def test_repeated_rows_and_null_ids_are_read_once(spark):
    """Copies with one id, and documents without any, link as their texts do."""
    w = [f"w{k}" for k in range(60)]
    a, near, other = " ".join(w), " ".join([*w[:30], "changed", *w[31:]]), " ".join(f"x{k}" for k in range(40))
    rows = [(1, a)] * 6 + [(1, near)] * 5 + [(None, near), (None, other), (None, other + " more")] + [(None, other)] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, setjoin.near_duplicates(docs).collect()), key=str)
    assert got == brute(rows)


def test_copies_that_pass_the_bitmap_do_not_deal_the_sets(spark, monkeypatch):
    """Where a small bitmap lets most rows pass, each class still comes once and its set is stored once."""
    monkeypatch.setattr(setjoin, "SCREEN", 1 << 15)
    monkeypatch.setattr(setjoin, "PLACES", 1)
    names, whole = [], setjoin.stored
    monkeypatch.setattr(setjoin, "stored", lambda df, name: names.append(name) or whole(df, name))
    texts = [" ".join(f"w{k}x{j}" for j in range(40)) for k in range(3000)]
    texts += [t + " more" for t in texts]
    rows = [(k, t) for k, t in enumerate(texts + [texts[0]] * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r["doc_id"]: r["component_id"] for r in setjoin.near_duplicates(docs).collect()}
    assert got == {k: 0 if k >= 6000 else k % 3000 for k, _ in rows}
    assert names.count("sets") == 1
