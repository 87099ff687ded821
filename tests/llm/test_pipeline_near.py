import corpus_pipeline


def test_one_row_of_each_component_stays(spark, tmpdir_fresh):
    """Tied and null ids: rows are dropped, not ids."""
    w = [f"w{k}" for k in range(80)]
    a, near = " ".join(w), " ".join([*w[:40], "changed", *w[41:]])
    other, alone = " ".join(f"x{k}" for k in range(60)), " ".join(f"y{k}" for k in range(60))
    rows = [(1, a), (2, near), (2, alone), (None, near), (None, other), (None, other + " more"), (4, None), (None, "")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmpdir_fresh}/docs")
    got = corpus_pipeline.near_duplicates(spark, spark.read.parquet(f"{tmpdir_fresh}/docs"), "").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, a), (2, alone), (None, other), (4, None), (None, "")], key=str)


def _read(spark, df, path):
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_stages_equal_brute_force(spark, odd_docs, no_docs, tmpdir_fresh):
    """Every stage on nulls, ties, repeats, long texts and columns with the stages' own names."""
    import hashlib
    from collections import Counter

    import public_tokenizers
    from tokenizers import Tokenizer

    from panelspark.llm import toxicity
    from test_setjoin import brute

    sf = f"{tmpdir_fresh}/sf"
    labels = [(k, 1, int(k % 2 == 0)) for k in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    bad = spark.createDataFrame([(100 + k, f"die idiot clown {k}", "en", "s1", 1, k, "x", None) for k in range(5)], odd_docs.schema)
    clash = ["row_", "id_", "h_", "k_", "i2_", "times_"]
    docs = odd_docs.unionByName(bad).selectExpr("*", *[f"'{c}' as {c}" for c in clash])
    docs = _read(spark, docs, f"{sf}/documents.parquet")
    key = lambda r: (r["doc_id"], r["text"], r["source"])
    before = docs.collect()
    model = toxicity.trained(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    score = lambda r: model.score(model.slots(toxicity.terms(r["text"] or "")))
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert stage(spark, _read(spark, docs.where("false"), f"{sf}/none-{name}"), sf).collect() == []
        if name != "bpe":
            assert out.columns == docs.columns
        docs = _read(spark, out, f"{sf}/{name}")
        after = frames[name] = docs.collect()
        if name != "bpe":
            assert all(r[c] == c for r in after for c in clash)
        got = Counter(map(key, after)) if name != "bpe" else None
        if name == "toxicity":
            assert got == Counter(key(r) for r in before if score(r) < toxicity.THRESHOLD)
        elif name == "exact_dedup":
            best = {}
            for r in before:
                t = "".join((r["text"] or "").split())
                rank = (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0)
                best[t] = min(best.get(t, (rank, key(r))), (rank, key(r)), key=lambda x: x[0])
            assert {k[:1] for k in got} == {k[:1] for _, k in best.values()} and sum(got.values()) == len(best)
        elif name == "near_duplicates":
            rows = [(k, r["text"]) for k, r in enumerate(before)]
            groups = {}
            for k, n, c in brute(rows):
                groups.setdefault(c if n else ("alone", k), []).append(before[k])
            want = Counter(key(min(g, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))) for g in groups.values())
            assert got == want
        elif name == "mixing":
            assert set(got) <= set(map(key, before)) and max(got.values()) <= 3
        else:
            whole = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
            whole.no_truncation()
            whole.no_padding()
            want = Counter()
            for r in before:
                ids = whole.encode(r["text"] or "", add_special_tokens=False).ids
                packed = b"".join(i.to_bytes(4, "little") for i in ids)
                want[r["doc_id"], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(
                    whole.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
            assert Counter(map(tuple, after)) == want
        before = after
    again = corpus_pipeline.run(spark, sf).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, frames["bpe"]))
