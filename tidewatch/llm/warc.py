"""WARC archives: one record per page in a gzip member of its own, and a reader that salvages damaged files.

The reader checks every record. After a failed check it looks for the next member
or version line at which a whole valid record starts, goes on from there, and
reports the bytes between as a quarantined gap. Members are searched in the
same way after they are unpacked, as far as that goes.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm.batches import texts
from tidewatch.llm.tables import store

#: Payloads of fewer bytes are always stored in full.
REVISIT_BYTES = 100
DATE = "2024-01-01T00:00:00Z"
_MEMBER_BYTES = 8 << 20   # of uncompressed data: far below 16 MiB, see ``write_archives``
_CHUNK_BYTES = 4 << 20    # of compressed data handed over at once
_CHUNKS_PER_FILE = 8
_FEED = 1 << 16

# Fixed values of the format.
_VERSION = b"WARC/1."
_VERSION_LINE = re.compile(rb"WARC/1\.\d\r\n")
_END = b"\r\n\r\n"
_MAGIC = b"\x1f\x8b\x08"
_IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _record_id(key: str | None) -> str:
    return "<urn:page:" + ("null" if key is None else "id:" + quote(key, safe="")) + ">"


def _key_of(record_id: str) -> str | None:
    name = record_id.strip("<>").removeprefix("urn:page:")
    return unquote(name.removeprefix("id:")) if name.startswith("id:") else None


def record(key: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit that refers to another response."""
    revisit = refers_to is not None
    block = _HTTP if revisit else _HTTP + payload
    headers = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(key)}",
               f"WARC-Date: {DATE}"]
    if url is not None:
        headers.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url))
    headers += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
                f"X-Payload-Length: {len(payload)}"]
    if revisit:
        headers += [f"WARC-Profile: {_IDENTICAL}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    headers += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(headers).encode() + _END + block + _END


def members(whole: bytes) -> bytes:
    """The record as a gzip member; a very long one goes over several, as any gzip reader allows."""
    parts = [whole[lo:lo + _MEMBER_BYTES] for lo in range(0, len(whole), _MEMBER_BYTES)]
    return b"".join(_member(p) for p in parts)


def _member(part: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(part) + packer.flush()


def with_references(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Adds ``digest`` and ``refers_to``: the least key of the rows with an equal payload, for the other rows.

    Only payloads of at least ``REVISIT_BYTES`` that occur more than once are
    looked up; groups are counted before the join, which AQE may split on a hot payload.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    narrow = pages.where(F.octet_length(payload) >= REVISIT_BYTES).select(
        F.sha2(payload, 256).alias("digest"), F.col(key).alias("k"))
    first = narrow.groupBy("digest").agg(F.min("k").alias("first"), F.count(F.lit(1)).alias("n")).where(
        "n > 1 AND first IS NOT NULL").select("digest", "first")
    rows = pages.withColumn("digest", F.sha2(payload, 256)).join(first, "digest", "left")
    return rows.withColumn("refers_to", F.when(~F.col(key).eqNullSafe(F.col("first")), F.col("first"))).drop("first")


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write every row as a record into gzip archives below ``path``; each record is a member.

    Of rows with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the least key
    is a response and the others revisit it; rows that share that key are all
    responses, and so are rows of a group without a non-null key. A null page is
    an empty payload, a null URL is left out, further columns are dropped, and
    an empty table gives no record.

    The files are written by Spark's committer to any file system it knows. Its
    line writer ends each row with a separator; as the last byte of a gzip
    member below 16 MiB is always zero, that byte is the separator.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            keys, urls, digests, refers = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            for k, u, payload, d, r in zip(keys, urls, texts(batch.column(2)), digests, refers):
                held.append(members(record(k, u, payload or b"", d, r)))
                size += len(held[-1])
                if size >= _CHUNK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["value"])

    own = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))
    rows = with_references(own, "key", "html").select(
        F.col("key").cast("string").alias("key"), "url", "html", "digest", F.col("refers_to").cast("string").alias("refers_to"))
    rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value")).write.option(
        "lineSep", "\0").option("maxRecordsPerFile", _CHUNKS_PER_FILE).text(path)


class Found(NamedTuple):
    """A record, or a gap where ``headers`` is None; ``reason`` says what check failed."""

    offset: int
    length: int
    headers: dict[str, str] | None
    block: bytes
    reason: str


class Damaged(ValueError):
    """No whole valid record starts here."""


def _inflate(data: memoryview, at: int) -> tuple[bytes, int, str]:
    """A gzip member's content as far as it can be read, where that ends, and what is wrong: nothing if its checksum holds."""
    unpacker, out, to = zlib.decompressobj(31), [], at
    try:
        while not unpacker.eof:
            if to >= len(data):
                return b"".join(out), to, "cut off member"
            out.append(unpacker.decompress(data[to:to + _FEED]))
            to = min(to + _FEED, len(data))
    except zlib.error:
        again = zlib.decompressobj(31)
        for lo in range(at, to, _FEED):
            again.decompress(data[lo:lo + _FEED])
        try:
            while True:  # byte by byte, as a failed call gives nothing
                out.append(again.decompress(data[to:to + 1]))
                to += 1
        except zlib.error:
            return b"".join(out), to, "broken member"
    return b"".join(out), to - len(unpacker.unused_data), ""


def _parse(content: bytes | memoryview, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``; every check that the record allows is made."""
    view = memoryview(content)
    if not _VERSION_LINE.match(bytes(view[at:at + 16])):
        raise Damaged("no version line")
    reach = _FEED
    while (stop := (head := bytes(view[at:at + reach])).find(_END)) < 0:
        if at + reach >= len(view):
            raise Short("cut off record", max(1, len(view) - at))
        reach *= 4
    headers = {}
    for line in head[:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("broken header")
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = headers.get("content-length", "")
    if not size.isdigit() or "warc-type" not in headers or "warc-record-id" not in headers:
        raise Damaged("broken header")
    start = at + stop + len(_END)
    end = start + int(size)
    if end + len(_END) > len(view):
        raise Short("cut off record", end + len(_END) - len(view))
    if view[end:end + len(_END)] != _END:
        raise Damaged("wrong length")
    block = bytes(view[start:end])
    wanted = headers.get("warc-block-digest", "")
    if wanted.startswith("sha256:") and hashlib.sha256(block).hexdigest() != wanted[7:]:
        raise Damaged("wrong digest")
    return headers, block, end + len(_END)


class Short(Damaged):
    """The record goes on after the bytes at hand, for ``missing`` bytes at least."""

    def __init__(self, reason: str, missing: int) -> None:
        super().__init__(reason)
        self.missing = missing


class _End(NamedTuple):
    """Where to read on after a member; ``wrong`` says what is wrong with it, ``lost`` where its unread bytes start."""

    at: int
    wrong: str
    lost: int
    read: int


def _unpacked(data: memoryview, at: int) -> Iterator[Found | _End]:
    """What the gzip member at ``at`` holds, and those after it that go on with its last record; at last an ``_End``."""
    content, end, wrong = _inflate(data, at)
    base, pos, bad, held = 0, 0, None, None
    spans = [(0, at)]  # of each member: where its content starts, and where it starts itself

    def offset(place: int) -> int:
        return spans[bisect_right(spans, place, key=lambda s: s[0]) - 1][1]

    def until(item: Found | None, to: int) -> list[Found]:
        return [] if item is None else [item._replace(length=to - item.offset)]

    while pos < len(content):
        try:
            headers, block, used = _parse(content, pos)
        except Short as error:
            more, missing, filled = [], error.missing, base + len(content)
            while missing > 0 and not wrong and data[end:end + 3] == _MAGIC:
                part, further, next_wrong = _inflate(data, end)
                if part.startswith(_VERSION):
                    break
                spans.append((filled, end))
                end, wrong = further, next_wrong
                more.append(part)
                filled += len(part)
                missing -= len(part)
            if more:
                content, base, pos = content[pos:] + b"".join(more), base + pos, 0
                continue
            reason = str(error)
        except Damaged as error:
            reason = str(error)
        else:
            if wrong and held is None and bad is None and used == len(content):
                break  # nothing but this record, and the damage is in it
            if bad is not None:
                yield from until(held, offset(bad[0]))
                held = Found(offset(bad[0]), 0, None, b"", bad[1])
            yield from until(held, offset(base + pos))
            held = Found(offset(base + pos), 0, headers, block, "")
            pos, bad = used, None
            continue
        bad = bad or (base + pos, reason)
        pos = content.find(_VERSION, pos + 1)
        pos = pos if pos >= 0 else len(content)
    if wrong:
        lost = at if held is None else offset(bad[0]) if bad else spans[-1][1]
        yield from until(held, lost)
        yield _End(spans[-1][1] + 1, wrong, lost, end)
        return
    if bad is not None or not content:
        start, reason = bad or (0, "no version line")
        yield from until(held, offset(start))
        held = Found(offset(start), 0, None, b"", reason)
    yield from until(held, end)
    yield _End(end, "", end, end)


def salvage(data: bytes) -> Iterator[Found]:
    """All valid records of an archive, plain or compressed, and the gaps between them, in order.

    A gzip member may hold any number of records, and a record may go over
    several members. The offset is that of the member in which the record or gap
    starts, and the length reaches to the next one's offset: of several in one
    member only the last has a length, and all lengths add up to the archive's.
    Of a member that is cut off or broken the records that pass their checks are
    kept, and the rest is a gap; no checksum vouches for those records' headers.
    If it holds one record and nothing else, that one is damaged and not kept.
    """
    view, at, gap, why = memoryview(data), 0, None, ""
    told, until = set(), 0  # what was read from a damaged member, whose bytes are searched once more
    while at < len(data):
        if view[at:at + 3] == _MAGIC:
            names = set()
            for item in _unpacked(view, at):
                if isinstance(item, _End):
                    break
                if gap is not None:
                    yield Found(gap, at - gap, None, b"", why)
                    gap = None
                if item.headers is not None:
                    names.add((item.headers["warc-record-id"], len(item.block)))
                yield item
            at = item.at
            if not item.wrong:
                continue
            if gap is None:
                gap, why = item.lost, item.wrong
            told, until = (told if item.read <= until else set()) | names, max(until, item.read)
        else:
            try:
                headers, block, end = _parse(view, at)
            except Damaged as error:
                if gap is None:
                    gap, why = at, str(error)
                at += 1
            else:
                if at < until and (headers["warc-record-id"], len(block)) in told:
                    at = end  # stored without compression, and told already
                    continue
                if gap is not None:
                    yield Found(gap, at - gap, None, b"", why)
                    gap = None
                yield Found(at, end - at, headers, block, "")
                at = end
                continue
        nexts = [p for p in (data.find(_MAGIC, at), data.find(_VERSION, at)) if p >= 0]
        at = min(nexts, default=len(data))
    if gap is not None:
        yield Found(gap, len(data) - gap, None, b"", why)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Everything in the archives below ``path``: a row per record and a row per quarantined gap.

    Columns: file, offset, length (bytes in the file, see :func:`salvage`), record_type (null for a
    gap), record_id, key, target_uri, payload_bytes, payload_digest, refers_to,
    reason (of a gap) and, if wanted, payload. Length and digest are those of the
    full payload: of a response computed, of a revisit as it states them. An
    empty file gives no row. One file is held in memory at a time.
    """
    names = ["file", "offset", "length", "record_type", "record_id", "key", "target_uri", "payload_bytes",
             "payload_digest", "refers_to", "reason"] + ["payload"] * with_payload
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), *[pa.string()] * 3] + [pa.binary()] * with_payload

    def row(file: str, found: Found) -> tuple:
        if found.headers is None:
            return (file, found.offset, found.length, *[None] * 7, found.reason, *[None] * with_payload)
        get = found.headers.get
        payload = found.block.partition(_END)[2] if get("content-type", "").startswith("application/http") else found.block
        if get("warc-type") == "revisit":
            size, digest = get("x-payload-length", ""), get("warc-payload-digest", "").removeprefix("sha256:")
            size = int(size) if size.isdigit() else None
        else:
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        refers = get("warc-refers-to")
        return (file, found.offset, found.length, get("warc-type"), get("warc-record-id"), _key_of(get("warc-record-id")),
                get("warc-target-uri"), size, digest, refers and _key_of(refers), None, *[payload] * with_payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                file, rows, size = batch.column(0)[i].as_py(), [], 0
                for found in salvage(batch.column(1)[i].as_py()):
                    rows.append(row(file, found))
                    size += len(found.block) * with_payload + 500
                    if size >= _CHUNK_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    schema = ("file string, offset long, length long, record_type string, record_id string, key string, target_uri string, "
              "payload_bytes long, payload_digest string, refers_to string, reason string") + ", payload binary" * with_payload
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


def read_whole(spark: SparkSession, path: str, records: int) -> DataFrame:
    """The rows of archives that must be undamaged and hold so many records; else an error names the first gap or the count."""
    found = store(read_archives(spark, path, with_payload=False), "records").df
    gap = found.where("record_type IS NULL").orderBy("file", "offset").first()
    if gap:
        raise ValueError(f"{gap['file']} is damaged from byte {gap['offset']}: {gap['reason']}")
    if (n := found.count()) != records:
        raise ValueError(f"{n} records in place of {records}")
    return found
