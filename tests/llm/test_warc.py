import hashlib
import io

import pytest
import zstandard

from groundswell.llm import warc


@pytest.fixture
def pages(llm_spark):
    def make(rows):
        return llm_spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, size string").repartition(3)

    return make


def brute(rows):
    newest = {}
    for i, _, h in rows:
        h = h or ""
        if len(h.encode()) >= 1000 and i is not None:
            newest[h] = max(i, newest.get(h, i))
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        to = newest.get(h or "")
        to = None if to == i else to
        out.append((str(i), len(raw), hashlib.sha1(raw).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_round_trip(pages):
    long, other = "<p>é\r\n\r\nWARC/1.1</p>" * 100, "z" * 1000
    rows = [(1, "http://a/", long), (5, "http://b/\r\nX: y z", long), (3, None, long), (4, "u", None), (6, "u", ""), (7, "u", "z" * 999),
            (8, "u", "z" * 999), (9, "u", other), (9, "u", other), (2, "v", other), (None, "w", other), (None, "w", long + "!"),
            (10, "big", "0123456789" * 300_000)]
    found = warc.read_archives(warc.write_archives(pages(rows)), with_payload=True).collect()
    got = [(str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found]
    assert sorted(got, key=str) == brute(rows)
    assert {r["url"] for r in found if r["page_id"] == 5} == {"http://b/%0D%0AX:%20y%20z"}
    for r in found:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
        if r["payload"] is not None:
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]


def test_bundle_seeks_and_is_plain_zstandard():
    made = [(k, warc.record(k, f"u{k}", b"p" * k * 50, hashlib.sha1(b"p" * k * 50).hexdigest(), k * 50, None, "2020")) for k in range(30)]
    raw = b"".join(warc.bundle(iter(made), frame_bytes=2000))
    f = warc.Bundle(io.BytesIO(raw))
    assert len(f.seek) > 5
    assert f.fetch(17)["payload"] == b"p" * 850 and f.fetch(99) is None
    assert [r["page_id"] for r in f.records()] == list(range(30))
    reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True)
    assert reader.read() == b"".join(r for _, r in made)
    broken = bytearray(raw)
    broken[-1] ^= 1
    with pytest.raises(ValueError):
        warc.Bundle(io.BytesIO(bytes(broken)))


def test_changed_payload_is_noticed():
    raw = warc.record(1, None, b"abc", hashlib.sha1(b"abd").hexdigest(), 3, None, "2020")
    with pytest.raises(ValueError, match="digest"):
        warc.parse(raw)


def test_empty_table(pages):
    assert warc.read_archives(warc.write_archives(pages([]))).collect() == []
