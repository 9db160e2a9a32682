"""WARC archives: written from pages by Spark tasks, read back by byte ranges.

Every record is a gzip member of its own. A reading task gets a range of an archive's bytes, looks for the gzip magic, inflates the start of each
candidate until a WARC header shows or fails to, and owns the records that begin inside its range, reading on past its end
where the last one goes on. So an archive of any size is read by as many tasks as it has ranges, and no index is needed.

Archives are opened with ``pyarrow.fs``: a local or shared folder, HDFS, S3 and GCS addresses work alike.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm.common import blocks, kept
from daymark.operators.joins import join_splitting
from daymark.shared import scratch_path

#: Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
KNOWN = b"WARC/1."
#: Fixed names of digests, as archives label them.
DIGESTS = ("md5", "sha1", "sha256", "sha512")
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RANGE_BYTES = 16 << 20
READ_BYTES = 1 << 20
#: The first request for what a range's last record has past the range; the next ones double.
PAST_BYTES = 1 << 16
LEVEL = 4
ID_PREFIX = "urn:page:"
FIRST = "__wa_first"
#: Type of rows that tell of a record that isn't whole.
DAMAGED = "damaged"
MANIFEST = "archive string, bytes long, records long"
RECORDS = "archive string, offset long, record_type string, record_id string, target_uri string, payload_digest string, payload_bytes long, refers_to_id string, problem string, payload binary"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: str, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One gzip member: a response with its payload, or a revisit whose HTTP head still tells the payload's length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{ID_PREFIX}{page}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest(payload)}"))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>"), ("WARC-Profile", IDENTICAL)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "replace") + b"\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", body: str = "html", min_payload: int = 0, date: str = "2026-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row, an archive per partition, and return the manifest (archive, bytes, records).

    Of rows whose payloads (``body`` in UTF-8; null as empty) are equal and at least ``min_payload`` bytes long, those with the smallest
    id become responses and the others revisits of it. Rows of a null id are revisits where an equal payload has an id, else
    responses. Repeated rows get records of their own. An empty table gives no records. Archives appear under their final name when they are complete, so a task that is run again
    replaces its own archive by an equal one. Other columns are left aside.
    """
    payload = F.coalesce(F.col(body), F.lit("")).cast("binary")
    named = pages.select(F.col(page_id).cast("string").alias("page"), F.col(page_id).alias("n"), F.col(url).alias("url"), payload.alias("body"), F.sha1(payload).alias("sha1"))
    big = named.where(F.octet_length("body") >= min_payload).select("n", "page", "sha1")
    first = big.groupBy("sha1").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    again = join_splitting(big, first, ["sha1"], "inner").where(F.col("n").isNull() | (F.col("n") > F.col("first")))
    # a short table of ids as a rule; only its written size tells Spark whether to send it to every task
    again = kept(again.where(F.col("first").isNotNull()).select(F.coalesce("page", F.lit("")).alias("key"), "sha1", F.col("first").cast("string").alias(FIRST)).distinct(), "revisits")
    joined = named.withColumn("key", F.coalesce("page", F.lit(""))).join(again, ["key", "sha1"], "left").select("page", "url", "body", FIRST)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}.warc.gz"
        files.create_dir(f"{root}/unfinished", recursive=True)
        draft = f"{root}/unfinished/{name}.{context.taskAttemptId()}"
        size = count = 0
        with files.open_output_stream(draft, compression=None) as out:
            for batch in blocks(batches, "body"):
                columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("page", "url", "body", FIRST)]
                for page, address, content, refers_to in zip(*columns, strict=True):
                    member = record("" if page is None else page, address, content, refers_to, date)
                    out.write(member)
                    size, count = size + len(member), count + 1
        files.move(draft, f"{root}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder.rstrip('/')}/{name}"]), pa.array([size], pa.int64()), pa.array([count], pa.int64())], names=["archive", "bytes", "records"])

    return kept(joined.mapInArrow(store, MANIFEST), "manifest")


class _Bytes:
    """A file as a window that moves forward, read in requests of ``step`` bytes up to ``stop`` and in smaller ones past it."""

    def __init__(self, handle, size: int, stop: int, step: int = READ_BYTES):
        self.handle, self.size, self.stop, self.step, self.start, self.data, self.past = handle, size, stop, step, 0, b"", min(step, PAST_BYTES)

    def at(self, place: int, least: int = 1) -> memoryview:
        """What the window holds from ``place`` on, ``least`` bytes at least unless the file ends. It moves only if it holds less."""
        end = self.start + len(self.data)
        if not self.start <= place <= min(place + least, self.size) <= end:
            # what it holds of these bytes isn't asked for again
            have = self.data[place - self.start :] if self.start <= place < end else b""
            if place + len(have) < self.stop:
                ask = min(self.step, self.stop - place - len(have))
            else:
                ask = self.past
                self.past = min(self.step, 2 * self.past)
            self.handle.seek(place + len(have))
            self.start, self.data = place, have + self.handle.read(min(max(least - len(have), ask), self.size - place - len(have)))
        return memoryview(self.data)[place - self.start :]


def _inflate(window: _Bytes, place: int) -> tuple[bytes, int, str | None] | None:
    """Content of the record at ``place``, where it ends and what is wrong with it. None if no WARC header shows there."""
    unpacker, out, at, head, problem = zlib.decompressobj(31), [], place, b"", None
    while not unpacker.eof:
        piece = window.at(at)[: 1 << 16]
        if not piece:
            problem = "cut off"
            break
        try:
            data = piece
            if len(head) < len(KNOWN):
                # the header first, so that damage behind it doesn't hide it
                head += unpacker.decompress(data, len(KNOWN) - len(head))
                if not head.startswith(KNOWN[: len(head)]):
                    return None
                data = unpacker.unconsumed_tail
            if len(head) == len(KNOWN):
                out.append(unpacker.decompress(data))
        except zlib.error:
            problem = "damaged"
            if b"\r\n\r\n" not in b"".join(out):
                out = [_before_damage(bytes(window.at(place, min(at + len(piece) - place, 1 << 16))))[len(head) :]]
            break
        at += len(piece)
    if head != KNOWN:
        return None
    return head + b"".join(out), at - len(unpacker.unused_data), problem


def _before_damage(data: bytes) -> bytes:
    """What the start of a damaged member holds up to the damage, for its header."""
    unpacker, out = zlib.decompressobj(31), []
    try:
        for k in range(0, len(data), 16):
            out.append(unpacker.decompress(data[k : k + 16]))
    except zlib.error:
        pass
    return b"".join(out)


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    return out


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() else None


def _contradicts(told: str, payload: bytes) -> bool:
    """Whether a digest field (algorithm:value, in base32 or hexadecimal) is of other bytes; one of an unknown algorithm can't tell."""
    name, colon, value = told.partition(":")
    name = name.lower().replace("-", "") if colon else "sha1"
    if name not in DIGESTS:
        return False
    found = hashlib.new(name, payload).digest()
    return (value if colon else told).rstrip("=").lower() not in (found.hex(), base64.b32encode(found).decode().rstrip("=").lower())


def _parsed(content: bytes, archive: str, offset: int, payloads: bool) -> tuple | None:
    head, blank, rest = content.partition(b"\r\n\r\n")
    fields = _fields(head)
    kind = fields.get("warc-type")
    if blank and kind not in ("response", "revisit"):
        return None
    size = _number(fields.get("content-length"))
    block = rest[:size]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = fields.get("warc-payload-digest", "")
    bare = lambda x: None if x is None else x.strip("<>")
    names = (bare(fields.get("warc-record-id")), fields.get("warc-target-uri"))
    problem = "no length" if size is None else "cut off" if len(block) < size else "wrong digest" if kind == "response" and told and _contradicts(told, payload) else None
    if problem:
        return _damaged(archive, offset, problem, *names)
    length = len(payload) if kind == "response" else _number(_fields(b"\r\n" + http).get("content-length"))
    seen = digest(payload) if kind == "response" else told.rpartition(":")[2] or None
    return archive, offset, kind, *names, seen, length, bare(fields.get("warc-refers-to")), None, payload if payloads and kind == "response" else None


def _damaged(archive: str, offset: int, problem: str, record_id: str | None = None, uri: str | None = None) -> tuple:
    return archive, offset, DAMAGED, record_id, uri, None, None, None, problem, None


def scan(handle, archive: str, size: int, start: int, stop: int, payloads: bool = True, step: int = READ_BYTES, strict: bool = True) -> Iterator[tuple]:
    """Records of an archive that begin in [start, stop), each byte read once but for a few past the end; see ``read``."""
    window, place = _Bytes(handle, size, stop, step), start
    while place < stop:
        seen = window.at(place, len(MAGIC))
        if bytes(seen[: len(MAGIC)]) != MAGIC:
            found = bytes(seen).find(MAGIC, 1)
            # the last two bytes may begin a magic that the next window completes
            place += found if found > 0 else max(1, len(seen) - 2)
            continue
        whole = _inflate(window, place)
        if whole is None:
            place += 1
            continue
        content, end, problem = whole
        if problem:
            names = _fields(content.partition(b"\r\n\r\n")[0])
            told = _damaged(archive, place, problem, (names.get("warc-record-id") or "").strip("<>") or None, names.get("warc-target-uri"))
        else:
            told = _parsed(content, archive, place, payloads)
        if told is not None and told[2] == DAMAGED and strict:
            raise ValueError(f"{archive}: the record at {place} is not whole ({told[8]})")
        if told is not None:
            yield told
        # where a member isn't whole the next one may begin anywhere behind its magic
        place = place + 1 if problem else end


def read(spark: SparkSession, manifest: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True, strict: bool = True) -> DataFrame:
    """Response and revisit records of the archives named by ``archive`` and ``bytes``, a task per byte range.

    Other records (warcinfo, metadata, ...) and bytes between members are passed over. A revisit has its payload's length and
    digest but no payload; so have all records without ``payloads``. Digests may be of any of ``DIGESTS``, in base32 or hexadecimal; others aren't checked.

    A record that shows a WARC header but is damaged or cut off, has no length or contradicts its digest is an error, or without ``strict`` a row of
    type ``damaged`` with its ``problem`` and what else could be read of it. A member damaged before its header can't be told from
    bytes between members; ``incomplete`` tells archives that hold fewer records than their manifest says.
    """
    total = manifest.agg(F.sum(F.floor(F.col("bytes") / range_bytes) + 1).alias("n")).collect()[0]["n"] or 1
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    ranges = manifest.select("archive", "bytes", F.explode(starts).alias("start")).repartition(int(min(total, 100_000)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.strip().split(" ") for x in RECORDS.split(","))])
        for batch in batches:
            for r in batch.to_pylist():
                files, path = pafs.FileSystem.from_uri(r["archive"])
                with files.open_input_file(path) as handle:
                    rows, held = [], 0
                    for told in scan(handle, r["archive"], r["bytes"], r["start"], min(r["bytes"], r["start"] + range_bytes), payloads, strict=strict):
                        rows.append(told)
                        held += len(told[-1] or b"") + 200
                        if held > 8 * READ_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)

    return ranges.mapInArrow(run, RECORDS)


def incomplete(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """Archives of a manifest of ``write`` whose whole records, as ``read`` found them, are more or fewer than it says: archive, records, found."""
    found = records.where(F.col("record_type") != DAMAGED).groupBy("archive").agg(F.count(F.lit(1)).alias("found"))
    told = manifest.select("archive", "records").join(found, "archive", "left").fillna(0, ["found"])
    return told.where("records <> found")


def page_number(record_id):
    """The page id in a record id that ``write`` made."""
    number = F.substring_index(record_id, ":", -1)
    return F.when(number != "", number).cast("long")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``pages`` written to archives in the shared folder and read back: what the archives tell about each page."""
    records = read(spark, write(pages, scratch_path(spark, "warc")), payloads=False)
    return records.select(
        page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_number(F.col("refers_to_id")).alias("refers_to"), F.col("target_uri"),
    )


#: The query over ``pages``.
SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, url, strlen(body) AS n, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(generate_series(0, 7), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, (i * 5 + 1)::INT, 5))::BIGINT >> s) & 31) + 1)::INT, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to, url AS target_uri
FROM d
"""
