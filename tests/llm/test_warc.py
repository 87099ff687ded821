import hashlib

import pytest

from panelspark.llm import warc

BIG = "<html>é " + "body " * 60 + "</html>"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(3, "http://a/x", BIG), (1, "http://b/\r\ny", BIG), (1, "http://b/\r\ny", BIG), (2, None, BIG),
            (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (None, "u", BIG), (None, None, None),
            (8, "u", BIG + "x" * 3_000_000), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]
    return spark.createDataFrame([(*r, "p", 0) for r in rows],
                                 "page_id long, url string, html string, payload string, digest int").repartition(2)


def brute(rows):
    first = {}
    for i, _, h, *_ in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    seen = {}
    for i, _, h, *_ in rows:
        seen[h] = seen.get(h, 0) + 1
    out = []
    for i, _, h, *_ in rows:
        b = (h or "").encode()
        again = h in first and seen[h] > 1 and i != first[h]
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response",
                    first[h] if again else None))
    return sorted(out, key=str)


def test_round_trip_equals_brute_force(pages):
    got = warc.round_trip(pages, archive_bytes=2000).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == brute(pages.collect())
    assert {bytes(r["payload"]).decode() for r in got if r["payload"] is not None} >= {BIG, "", "short"}
    assert {r["url"] for r in got} == {None, "u", "http://a/x", "http://b/%0D%0Ay"}


def test_empty_table(pages):
    assert warc.round_trip(pages.where("false")).collect() == []


def archive(n=400):
    recs = [warc.page_record(k, "u", b"page %d " % k * 20, hashlib.sha256(b"page %d " % k * 20).hexdigest(), None, False)
            for k in range(n)]
    return list(warc.archives(iter(recs)))[0][0]


def test_dictionary_leads_and_each_record_has_its_frame():
    data = archive()
    assert int.from_bytes(data[:4], "little") == warc.SKIPPABLE
    got = list(warc.records(data))
    assert len(got) == 401 and got[0][1]["WARC-Type"] == "warcinfo"
    assert warc.page_of(got[7][1], got[7][2])["page_id"] == "6"


@pytest.mark.parametrize("spoil", [lambda d: d[:-9], lambda d: d[:-60] + bytes([d[-60] ^ 255]) + d[-59:],
                                   lambda d: b"\x5d\x2a\x4d\x18\xff\xff\xff\x7f" + d[8:], lambda d: b"WARC/1.1 plain"])
def test_damage_is_found(spoil):
    with pytest.raises(ValueError):
        list(warc.records(spoil(archive())))


def test_headers_and_lengths_are_checked():
    good = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:1>"), ("WARC-Date", "x")], b"block")
    assert warc.parsed(good)[1] == b"block"
    for bad in (good.replace(b"Content-Length: 5", b"Content-Length: 6"), good.replace(b"WARC/1.1", b"WARC/9"),
                good.replace(b"WARC-Date", b"Other"), good[:-2]):
        with pytest.raises(ValueError):
            warc.parsed(bad)
    r = warc.page_record(1, "u", b"data", "0" * 64, None, False)
    with pytest.raises(ValueError, match="digest"):
        warc.page_of(*warc.parsed(r))
