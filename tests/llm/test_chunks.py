import hashlib
import random
from collections import defaultdict

import pytest

from panelspark.llm import chunks


def brute(rows):
    groups = defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups["".join(c for c in t or "" if c not in " \t\n\v\f\r")].append((-len(t or ""), i is None, i or 0, k))
    out = []
    for body, members in groups.items():
        keep = min(members[:], key=lambda m: m[:3])
        for m in members:
            i = None if m[1] else m[2]
            out.append((i, None if keep[1] else keep[2], len(members), hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


def test_chunks_cover_and_resynchronise():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(60_000))
    ends = chunks.cut_points(data)
    assert ends[-1] == len(data) and ends == sorted(set(ends))
    assert all(b - a <= chunks.MOST for a, b in zip([0, *ends], ends))
    moved = {p for _, p in chunks.chunk_ids(b"new start " + data, 16)}
    assert len(moved & {p for _, p in chunks.chunk_ids(data, 16)}) > 0.7 * len(ends)
    assert chunks.cut_points(b"a" * 100_000)[-1] == 100_000 and chunks.chunk_ids(b"", 16) == []


@pytest.mark.parametrize("widths", [(16,), (1, 16)])
def test_exact_dedup_equals_brute_force(odd_docs, widths):
    got = chunks.exact_dedup(odd_docs, widths=widths).collect()
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=str) == brute(rows)
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert len(kept) == len(set(kept)) == len({r["text_sha256"] for r in got})


def test_identifiers_that_always_clash_raise(odd_docs):
    with pytest.raises(ValueError, match="clash"):
        chunks.exact_dedup(odd_docs, widths=(1,), least=8, mean_bits=2)


def test_empty_table(no_docs):
    assert chunks.exact_dedup(no_docs).collect() == []
