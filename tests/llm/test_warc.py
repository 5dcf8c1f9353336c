import base64
import hashlib

import pytest

from tessera.llm import warc as W

PAGES = "page_id bigint, url string, html string, archive string"


def want(rows, least=0):
    best = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if i is not None and len(p) >= least:
            best[p] = max(i, best.get(p, i))
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        w = best.get(p)
        kind = "response" if w is None or w == i else "revisit"
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), kind, w if kind == "revisit" else None))
    return sorted(out, key=str)


ROWS = (
    [(i, f"https://h{i % 7}.example.com:443/p?q={i}", f"<p>page {i % 90} é</p>" * (i % 5)) for i in range(400)]
    + [(1000, None, None), (1001, "", ""), (1002, "http://a b\n/ü", "x\r\n\r\ny"), (1003, "http://[bad", "z"), (1004, "http://u@h.org:8080", "z"), (None, "http://n.org/", "unlike others")]
    + [(2000 + i, "http://same.org/", "same") for i in range(30)]
    + [(-5, "http://minus.org/", "minus")]
)


@pytest.mark.parametrize("least", [0, 30])
def test_round_trip(spark, monkeypatch, least):
    monkeypatch.setattr(W, "BLOCK_LINES", 7)
    monkeypatch.setattr(W, "FILE_LINES", 60)
    monkeypatch.setattr(W, "ROLL_BYTES", 2000)
    pages = spark.createDataFrame([(*r, "clash") for r in ROWS], PAGES).repartition(3)
    got = sorted(map(tuple, W.archive_and_read(pages, least).collect()), key=str)
    assert got == want(ROWS, least)


def test_repeated_rows_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "x", "")] * 3, PAGES)
    assert [x.record_type for x in W.archive_and_read(pages).collect()] == ["response"] * 3
    assert W.archive_and_read(pages.limit(0)).collect() == []


def test_a_target_that_shares_id_and_url_with_another_payload(spark):
    """The revisit has the size of the payload that it repeats, whichever response of that id and url comes first."""
    rows = [(7, "http://a.org/", "other payload of 21 b"), (7, "http://a.org/", "short"), (3, "http://b.org/", "short"), (4, "http://c.org/", "other payload of 21 b"), (7, "http://d.org/", "short")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], PAGES).repartition(2)
    got = sorted(map(tuple, W.archive_and_read(pages).collect()), key=str)
    assert got == want(rows) and {(r[0], r[1]) for r in got} == {(7, 21), (7, 5), (3, 5), (4, 21)}


def test_frequent_payloads_are_not_shuffled(spark):
    """Captures of a frequent digest keep no payload but the winner's, and long and missing payloads come back whole."""
    rows = [(i, f"http://h{i}.org/", "frequent " * 50) for i in range(300)] + [(900 + i, f"http://e{i}.org/", None if i % 2 else "") for i in range(200)]
    rows += [(5000, "http://long.org/", "long é" * 200_000), (5001, "http://long.org/", "long é" * 200_000), (5002, "http://one.org/", "once")]
    rows += [(None, f"http://n{i}.org/", "frequent " * 50) for i in range(2)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], PAGES).repartition(3)
    decided = W.decide(pages).collect()
    assert sum(x.payload is not None and bytes(x.payload) == b"frequent " * 50 for x in decided) == 1
    assert sorted(map(tuple, W.archive_and_read(pages).collect()), key=str) == want(rows)


def test_keys():
    assert W.reversed_host_key("https://www.Example.com:443/a?b=1") == "com,example,www)/a?b=1"
    assert W.reversed_host_key("http://h.org:81") == "org,h:81)/"


def test_payload_and_headers():
    member = W.record("response", 7, "http://a/", "é\r\n\r\n".encode(), "D", None, "")
    fields, payload = W.parse(member)
    assert payload == "é\r\n\r\n".encode() and fields["Page-ID"] == "7"
