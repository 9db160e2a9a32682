import gzip
import hashlib
import io
import random

import pytest

from daymark.llm import warc
from daymark.shared import scratch_path

PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>two é</p>"), (3, None, "<p>one</p>"), (4, "http://a/\r\n4", None), (5, "http://a/5", ""),
    (6, "http://a/6", "x" * 70_000), (7, "http://a/7", "<p>one</p>"), (7, "http://a/7", "<p>one</p>"), (None, "http://a/n", "<p>two é</p>"), (8, "http://a/8", "\r\n\r\nWARC/1.1\r\n"),
]


def brute(pages, least=0):
    out = []
    for page, _, html in pages:
        body = (html or "").encode()
        same = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        first = min(same) if len(body) >= least and same else None
        again = first is not None and (page is None or page > first)
        out.append((page, len(body), warc.digest(body), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("step", [37, 1000, 1 << 24])
@pytest.mark.parametrize("least", [0, 11])
def test_round_trip(corpus, rows_of, step, least):
    pages = corpus.createDataFrame(PAGES, "page_id long, url string, html string").withColumnRenamed("nothing", "else")
    manifest = warc.write(pages.repartition(3), scratch_path(corpus, "warc"), min_payload=least)
    assert manifest.agg({"records": "sum"}).collect()[0][0] == len(PAGES)
    read = warc.read(corpus, manifest, range_bytes=step)
    got = read.select(warc.page_number(read.record_id).alias("p"), "payload_bytes", "payload_digest", "record_type", warc.page_number(read.refers_to_id).alias("r"))
    assert rows_of(got) == brute(PAGES, least)
    bodies = {r["payload_digest"]: bytes(r["payload"]) for r in read.where("record_type = 'response'").collect()}
    assert all(warc.digest(b) == d for d, b in bodies.items())


def test_empty_table(corpus):
    pages = corpus.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(corpus, pages).count() == 0


def test_false_magic_padding_and_other_records():
    rng = random.Random(1)
    info = gzip.compress(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n")
    # stored, not packed, so that the magic shows in the middle of a member
    tricky = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:5>\r\nContent-Length: 60\r\n\r\nHTTP/1.1 200 OK\r\n\r\n" + warc.MAGIC * 2 + bytes(rng.randrange(256) for _ in range(35)) + b"\r\n\r\n"
    parts = [info, gzip.compress(tricky, 0), b"\0" * 5, warc.record("6", "u", b"six", None, "d"), warc.MAGIC, warc.record("7", "u", b"six", "6", "d")]
    whole = b"".join(parts)
    for step in (5, 64, 1 << 20):
        for cut in (1, 13, 100, len(whole)):
            got = [r for start in range(0, len(whole), cut) for r in warc.scan(io.BytesIO(whole), "x", len(whole), start, min(len(whole), start + cut), step=step)]
            assert [r[3] for r in got] == ["urn:page:5", "urn:page:6", "urn:page:7"]
            assert got[2][6:8] == (3, "urn:page:6")


def test_damaged_payload():
    wrong = gzip.compress(gzip.decompress(warc.record("1", "u", b"abc", None, "d")).replace(b"abc", b"abd"))
    with pytest.raises(ValueError, match="digest"):
        list(warc.scan(io.BytesIO(wrong), "x", len(wrong), 0, len(wrong)))


class Counting(io.BytesIO):
    read_bytes = requests = 0

    def read(self, size=-1):
        out = super().read(size)
        self.read_bytes += len(out)
        self.requests += 1
        return out


def test_bytes_are_read_once():
    rng = random.Random(3)
    page = lambda: "".join(rng.choice("abcdefgh <>") for _ in range(rng.randrange(3000))).encode()
    whole = b"".join(warc.record(str(i), "u", page(), None, "d") for i in range(4000))
    for cut in (len(whole), 1 << 20):
        handle = Counting(whole)
        got = [r for start in range(0, len(whole), cut) for r in warc.scan(handle, "x", len(whole), start, min(len(whole), start + cut))]
        assert len(got) == 4000
        assert handle.read_bytes <= 1.2 * len(whole)
        assert handle.requests <= 3 * (len(whole) / warc.READ_BYTES + len(whole) / cut) + 3


def test_records_that_are_not_whole():
    good = [warc.record(str(i), "u", f"page {i} ".encode() * 50, None, "d") for i in range(4)]
    broken = bytearray(good[1])
    broken[-20] ^= 0xFF
    broken[-6] ^= 0xFF
    foreign = lambda name, value: gzip.compress(gzip.decompress(good[2]).replace(b"sha1:" + warc.digest(b"page 2 " * 50).encode(), f"{name}:{value}".encode()))
    right = foreign("sha256", hashlib.sha256(b"page 2 " * 50).hexdigest())
    wrong = foreign("sha-256", "0" * 64)
    other = foreign("blake3", "abc")
    unnumbered = gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:9>\r\nContent-Length: many\r\n\r\nHTTP/1.1 200 OK\r\n\r\n")
    whole = b"".join([good[0], bytes(broken), right, wrong, other, unnumbered, good[3][:-30]])
    for step in (7, 1 << 20):
        for cut in (11, len(whole)):
            got = [r for start in range(0, len(whole), cut) for r in warc.scan(io.BytesIO(whole), "x", len(whole), start, min(len(whole), start + cut), step=step, strict=False)]
            assert [(r[2], r[8]) for r in got] == [
                ("response", None), ("damaged", "damaged"), ("response", None), ("damaged", "wrong digest"), ("response", None), ("damaged", "no length"), ("damaged", "cut off"),
            ]
            assert [r[3] for r in got] == [f"urn:page:{i}" for i in (0, 1, 2, 2, 2, 9, 3)]
    with pytest.raises(ValueError, match="not whole"):
        list(warc.scan(io.BytesIO(whole), "x", len(whole), 0, len(whole)))


def test_incomplete_archives(corpus, tmp_path):
    parts = [warc.record(str(i), "u", b"x" * i, None, "d") for i in range(3)]
    lost = b"\0" * len(parts[1])  # the header is gone, too
    rows = []
    for name, content in (("a", b"".join(parts)), ("b", parts[0] + lost + parts[2])):
        (tmp_path / name).write_bytes(content)
        rows.append((str(tmp_path / name), len(content), 3))
    manifest = corpus.createDataFrame(rows, warc.MANIFEST)
    assert [tuple(r) for r in warc.incomplete(manifest, warc.read(corpus, manifest, strict=False)).collect()] == [(rows[1][0], 3, 2)]
