import math
import re

import numpy as np
import pytest

from panelspark.llm import byte_cnn, labelled, language, toxicity, weak_rules


def brute_base(text):
    text = text or ""
    w = [x for x in re.split("[ \t-\r]+", text) if x]
    g = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    twice = {x for x in g if g.count(x) > 1} if len(g) < 5000 else {x for x, n in __import__("collections").Counter(g).items() if n > 1}
    inside = {k + d for k, x in enumerate(g) if x in twice for d in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^ \t-\r]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
            len(w) < 50 or 100 * len(inside) > 50 * len(w))


def test_base_numbers_equal_brute_force(odd_docs):
    got = weak_rules.weak_quality(odd_docs).collect()
    want = [(r["doc_id"], *brute_base(r["text"])) for r in odd_docs.collect()]
    assert sorted([tuple(r)[:7] for r in got], key=str) == sorted(want, key=str)
    assert not any(r["kept"] for r in got if r["base_failed"])


def brute_em(patterns, rounds):
    names = [n for n, *_ in weak_rules.RULES]
    state = {"prior": weak_rules.PRIOR, **{(n, k): weak_rules.START[k] for n in names for k in ("bad", "good")}}
    w = weak_rules.WEIGHT

    def post(votes):
        odds = math.log(state["prior"] / (1 - state["prior"]))
        for n, v in zip(names, votes):
            if v:
                g, b = state[n, "bad" if v < 0 else "good"]
                odds += math.log(g / b)
        return 1 / (1 + math.exp(-odds))
    for _ in range(rounds):
        good = {p: n * post(p) for p, n in patterns.items()}
        total, g = sum(patterns.values()), sum(good.values())
        new = {"prior": (g + w * total * weak_rules.PRIOR) / (total * (1 + w))}
        for j, n in enumerate(names):
            for v, k in ((-1, "bad"), (1, "good")):
                gg = sum(x for p, x in good.items() if p[j] == v)
                bb = sum(patterns[p] - x for p, x in good.items() if p[j] == v)
                new[n, k] = ((gg + w * total * weak_rules.START[k][0]) / (g + w * total),
                             (bb + w * total * weak_rules.START[k][1]) / (total - g + w * total))
        state = new
    return state


def test_em_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    names = [n for n, *_ in weak_rules.RULES]
    rows = [[int(v) for v in rng.choice([-1, 0, 1], len(names), p=[0.1, 0.6, 0.3])] for _ in range(400)]
    patterns = {}
    for r in rows:
        patterns[tuple(r)] = patterns.get(tuple(r), 0) + 1
    model = weak_rules.fit(spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names)), rounds=6)
    want = brute_em(patterns, 6)
    assert model["prior"] == pytest.approx(want["prior"])
    for n in names:
        for k in ("bad", "good"):
            assert model["rules"][n][k] == pytest.approx(want[n, k])


def test_weak_rules_empty_table(no_docs):
    assert weak_rules.weak_quality(no_docs).collect() == []


@pytest.mark.parametrize("op,folds,held", [(byte_cnn.quality, 5, 0), (toxicity.toxicity, 3, 1)])
def test_scores_of_odd_rows(odd_docs, odd_labels, op, folds, held, no_docs):
    import zlib
    got = op(odd_docs, odd_labels).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        i = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["held_out"] == (zlib.crc32(i.encode()) % folds == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] in (0, 1)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(by[3]) <= 2  # repeated rows score alike
    assert op(no_docs, odd_labels).collect() == []
    assert len(op(odd_docs, odd_labels.where("false")).collect()) == odd_docs.count()


def test_sample_is_bounded_and_stable(odd_docs, odd_labels):
    keep = lambda c: labelled.fold(c, 3) != 1
    one = labelled.sample(odd_docs, odd_labels, "toxic", keep, 4, 1000)
    assert one == labelled.sample(odd_docs.repartition(4), odd_labels, "toxic", keep, 4, 1000)
    assert all(len(t.encode()) <= 1000 for t, _ in one)


def test_pairs_of_terms_are_learned():
    """Either word alone is harmless, both together are not."""
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(1500):
        a, b = rng.random() < 0.4, rng.random() < 0.4
        text = " ".join([f"w{rng.integers(0, 30)}"] * 3 + ["grumble"] * a + ["neighbour"] * b)
        rows.append((text.replace("0", "zero"), int(a and b)))
    model = toxicity.fit(rows)
    score = lambda t: model.score(model.slots(toxicity.terms(t)))
    assert score("grumble neighbour") > 0.7 > 0.5 > max(score("grumble"), score("neighbour"))


def test_variants_without_a_rate_of_their_own_are_learned():
    """Many variants of two kinds of word, each as frequent among toxic as among
    clean texts: only whether both kinds or none occur tells."""
    rng = np.random.default_rng(5)
    one, two, other = ([''.join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(n)] for n in (10, 10, 30))

    def texts(n):
        for _ in range(n):
            a, b = rng.random() < 0.5, rng.random() < 0.5
            yield (" ".join([*rng.choice(other, 4), *rng.choice(one, 1)[:a], *rng.choice(two, 1)[:b]]), int(a == b))
    model = toxicity.fit(list(texts(2500)))
    right = [(model.score(model.slots(toxicity.terms(t))) >= 0.5) == bool(v) for t, v in texts(300)]
    assert np.mean(right) > 0.95


def test_network_gradient_learns_a_byte_pattern():
    rng = np.random.default_rng(6)
    rows = []
    for k in range(240):
        words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(rng.integers(2, 150))]
        bad = k % 3 == 0
        rows.append((" ".join(w + "!!" * bad for w in words).encode(), int(not bad)))
    net = byte_cnn.fit(rows[:180])
    p = net.scores([t for t, _ in rows[180:]])
    assert ((p >= 0.5) == [bool(y) for _, y in rows[180:]]).mean() > 0.95


def test_network_sees_the_whole_text_and_blocks_do_not_matter():
    rng = np.random.default_rng(8)
    net = byte_cnn.Network(rng.normal(0, 1, (8, 256, 16)).astype(np.float32), np.zeros(16, np.float32),
                           rng.normal(0, 0.05, 32).astype(np.float32), 0.0)
    texts = [b"", b"a", bytes(rng.integers(1, 255, 5000).astype(np.uint8)), b"tail" * 300 + b"#"]
    together, alone = net.scores(texts), np.concatenate([net.scores([t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-5)
    flat, starts = byte_cnn.laid_out(texts)
    assert starts[-1] * byte_cnn.HALF >= sum(map(len, texts))


def test_language_fusion(spark):
    docs = spark.createDataFrame([("the cat and the dog " * 30, "en"), ("le chat et le chien " * 30, "fr"), (None, "de"),
                                  ("", None)], "text string, lang string")
    html = "<html lang='{}'><body><script>le le</script>{}</body></html>".format
    rows = [(k, "http://a.b.fr/x", html("fr", "le chat")) for k in range(6)] + [
        (10, "http://a.b.fr/y", "<p>the dog and the cat and the dog</p>"), (11, "http://a.b.fr/z", ""),
        (12, None, None), (13, "::odd::", html("xx", "")), (None, "http://c.d.com", html("en", "the dog")),
        *[(20 + k, "http://a.b.fr/w", "le chat et le chien") for k in range(4)], (0, "http://a.b.fr/x", html("fr", "le chat"))]
    pages = spark.createDataFrame([(*r, "q") for r in rows], "page_id long, url string, html string, lang string")
    got = language.page_language(pages, docs).collect()
    assert len(got) == len(rows)
    lang = {r["page_id"]: r for r in got}
    assert lang[0]["lang"] == "fr" and lang[10]["lang"] == "en"  # text against the host
    assert lang[11]["lang"] == "fr" and lang[11]["host"] == "a.b.fr"  # the host alone decides
    assert lang[12]["host"] is None and all(0 < r["probability"] <= 1 for r in got)
    assert language.page_language(pages.where("false"), docs).collect() == []
    assert {r["lang"] for r in language.page_language(pages, docs.where("false")).collect()} == {None}


def test_trigram_counts_equal_brute_force(spark):
    docs = spark.createDataFrame([("abcabc", "en"), ("ABC", "EN"), ("ñu", "es")], "text string, lang string")
    got = {(r["lang"], r["bucket"]): r["n"] for r in language.trigram_counts(docs).collect()}
    want = {}
    for t, k in (("abcabc", "en"), ("abc", "en"), ("ñu", "es")):
        for b in language.trigrams(t.encode()):
            want[k, int(b)] = want.get((k, int(b)), 0) + 1
    assert got == want


def test_markup_is_removed_as_by_the_pattern_and_in_linear_time():
    import random
    import re
    import time
    pattern = re.compile(r"<(script|style|nav|footer)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)
    rng = random.Random(2)
    parts = ["<script>", "<SCRIPT x='1'>", "</script>", "</Script >", "<nav", ">", "<", "</nav>", "<!--", "-->", "<!-->", "text ", "é",
             "<footer>", "</footer>", "<style>", "</style>", "<p>", "<scripts>", "--", "</script"]
    for _ in range(3000):
        page = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        assert language.without_markup(page) == pattern.sub(" ", page), page
    begun = time.time()
    for piece in ("<script>", "<!--", "<", "<nav></script>", "<!-- <style>"):
        language.without_markup(piece * 200_000)
    assert time.time() - begun < 20


def test_posterior_equals_brute_force(spark):
    """Text evidence of a long page and of a short one, from the counts of all documents."""
    docs = spark.createDataFrame([("the cat and the dog " * 30, "en"), ("le chat et le chien " * 30, "fr")], "text string, lang string")
    langs, logp = language.text_model(language.trigram_counts(docs))
    counts = {k: np.full(language.BUCKETS, language.SMOOTH) for k in ("en", "fr")}
    for t, k in (("the cat and the dog " * 30, "en"), ("le chat et le chien " * 30, "fr")):
        np.add.at(counts[k], language.trigrams(t.encode()), 1)
    assert langs == ["en", "fr"]
    for j, k in enumerate(langs):
        assert np.allclose(logp[j], np.log(counts[k] / counts[k].sum()))
    html = ["<p>the cat</p>", "<p>" + "le chat et " * 500 + "</p>", ""]
    pages = spark.createDataFrame([(n, "http://a.b.c/x", h) for n, h in enumerate(html)], "page_id long, url string, html string")
    got = {r["page_id"]: r["ll"] for r in language.page_evidence(pages, langs, logp, "page_id", "url", "html").collect()}
    for n, h in enumerate(html):
        at = language.trigrams(language.visible(h))
        share = language.TEMPER * min(1, language.MOST_TRIGRAMS / max(1, len(at)))
        assert np.allclose(got[n], [sum(logp[j][b] for b in at) * share for j in range(2)])


def test_network_equals_a_plain_convolution(monkeypatch):
    """Every filter at every byte of every chunk, written as loops; slices do not matter."""
    rng = np.random.default_rng(9)
    net = byte_cnn.Network(rng.normal(0, 1, (8, 256, 16)).astype(np.float32), rng.normal(0, 1, 16).astype(np.float32),
                           rng.normal(0, 0.05, 32).astype(np.float32), 0.1)
    texts = [b"", b"abc", bytes(rng.integers(1, 255, 700).astype(np.uint8)), b"xyz" * 300]

    def plain(text):
        data = text.ljust(max(1, -(-len(text) // 256)) * 256, b"\0")
        chunks = []
        for at in range(0, len(data), 256):
            places = range(at, min(at + 512, len(data) - 7))
            r = [[sum(net.table[k, data[p + k], f] for k in range(8)) for f in range(16)] for p in places]
            chunks.append(np.maximum(np.max(r, 0) + net.bias, 0))
        feats = np.concatenate([np.max(chunks, 0), np.mean(chunks, 0)])
        return 1 / (1 + np.exp(-(feats @ net.head + 0.1)))
    want = [plain(t) for t in texts]
    assert np.allclose(net.scores(texts), want, atol=1e-5)
    monkeypatch.setattr(byte_cnn, "SLICE", 2)
    assert np.allclose(net.scores(texts), want, atol=1e-5)


def test_machine_equals_a_plain_sum_over_pairs():
    rng = np.random.default_rng(10)
    model = toxicity.Machine(0.3, {b: k for k, b in enumerate(range(0, 50, 2))}, rng.normal(0, 1, 25), rng.normal(0, 1, (25, 6)))
    found = {0, 4, 7, 20, 48, 99}
    at = [model.slot[b] for b in sorted(found) if b in model.slot]
    want = 0.3 + sum(model.weight[i] for i in at) + sum(
        model.vector[i] @ model.vector[j] for n, i in enumerate(at) for j in at[:n])
    assert abs(model.raw(model.slots(found)) - want) < 1e-9
