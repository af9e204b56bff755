import gzip
import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st

from tidewatch.llm import warc

SCHEMA = "page_id long, url string, html string, key string, digest string"
BIG = "payload " * 20


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def write(spark, rows, path):
    warc.write_archives(pages(spark, rows), str(path))
    return sorted((f for f in path.iterdir() if f.name.startswith("part-")), key=str)


ROWS = [(5, "http://a/ b\n", BIG), (3, None, BIG), (9, "http://c", BIG), (1, "", None), (2, "x", "short"), (4, "x", "short"),
        (None, "n", BIG), (None, "n", "alone " * 30), (7, "long", "é" * 9_000_000), (8, "v", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\x1f\x8b\x08" * 5)]


def test_round_trip(spark, tmp_path):
    files = write(spark, ROWS, tmp_path / "a")
    plain = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert plain.count(b"WARC-Record-ID: ") == len(ROWS)
    got = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert all(r.reason is None for r in got)
    by_payload = {}
    for k, _, h in ROWS:
        if h and len(h.encode()) >= 100 and k is not None:
            by_payload[h] = min(k, by_payload.get(h, k))
    expected = []
    for k, _, h in ROWS:
        body = (h or "").encode()
        first = by_payload.get(h)
        revisit = first is not None and k != first
        expected.append((None if k is None else str(k), len(body), hashlib.sha256(body).hexdigest(),
                         "revisit" if revisit else "response", str(first) if revisit else None, b"" if revisit else body))
    assert sorted(((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in got), key=str) == sorted(expected, key=str)


def test_long_urls_come_through(spark, tmp_path):
    rows = [(1, "http://h/" + "a b\n" * 100_000, BIG), (2, "http://h/" + "é" * 5_000_000, "short"), (3, "http://h/x", "other")]
    write(spark, rows, tmp_path / "u")
    got = warc.read_archives(spark, str(tmp_path / "u")).collect()
    assert sorted((r.key, r.target_uri, bytes(r.payload).decode()) for r in got) == [
        (str(k), u.replace(" ", "%20").replace("\n", "%0A"), h) for k, u, h in rows]
    plain = warc.record("k", "http://h/" + "x" * 300_000, b"body", "d", None)
    assert read(plain + plain)[0] == ["<urn:page:id:k>"] * 2
    assert read(plain[:200_000])[1] == [(0, 200_000, "cut off record")]


def test_empty_and_repeated(spark, tmp_path):
    write(spark, [], tmp_path / "e")
    assert warc.read_archives(spark, str(tmp_path / "e")).count() == 0
    write(spark, [(1, "u", BIG)] * 2 + [(2, "u", BIG)], tmp_path / "r")
    got = warc.read_archives(spark, str(tmp_path / "r"), with_payload=False).collect()
    assert sorted((r.key, r.record_type) for r in got) == [("1", "response"), ("1", "response"), ("2", "revisit")]


def some_records(n):
    return [warc.record(str(i), f"http://h/{i}", b"body %d " % i * 30, "d", None) for i in range(n)]


def read(data):
    found = list(warc.salvage(data))
    at = 0
    for f in found:  # records and gaps cover the bytes without overlap
        assert f.offset == at
        at += f.length
    assert at == len(data)
    return [f.headers["warc-record-id"] for f in found if f.headers], [(f.offset, f.length, f.reason) for f in found if not f.headers]


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage_after_damage(compressed):
    records = some_records(6)
    parts = [warc.members(r) if compressed else r for r in records]
    names = [f"<urn:page:id:{i}>" for i in range(6)]
    assert read(b"".join(parts)) == (names, [])
    broken = bytearray(b"".join(parts))
    at = len(parts[0]) + len(parts[1]) + 30
    broken[at] ^= 0xFF
    found, gaps = read(bytes(broken))
    assert found == names[:2] + names[3:] and gaps[0][:2] == (len(parts[0]) + len(parts[1]), len(parts[2]))
    found, gaps = read(b"junk" + parts[0] + b"\0\0WARC/1.1 no" + parts[1] + parts[2][:-9])
    assert found == names[:2] and [g[1] for g in gaps] == [4, 13, len(parts[2]) - 9]
    cut = parts[0][:-20] + parts[1] + parts[2]
    assert read(cut)[0] == names[1:3]


def test_embedded_record_is_no_record():
    inner = warc.record("inner", None, b"x" * 200, "d", None)
    outer = warc.record("outer", None, inner * 3, "d", None)
    assert read(outer)[0] == ["<urn:page:id:outer>"]
    assert read(warc.members(outer))[0] == ["<urn:page:id:outer>"]


def test_mixed_forms_and_wrong_digest():
    a, b, c = some_records(3)
    assert len(read(a + warc.members(b) + c)[0]) == 3
    wrong = b.replace(b"body 1 body", b"body X body", 1)
    found, gaps = read(a + wrong + c)
    assert len(found) == 2 and gaps == [(len(a), len(b), "wrong digest")]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.booleans())
def test_random_damage_loses_only_what_is_hit(seed, compressed):
    rng = random.Random(seed)
    parts = [warc.members(r) if compressed else r for r in some_records(5)]
    data = bytearray(b"".join(parts))
    hit = set()
    for _ in range(rng.randint(1, 3)):
        at = rng.randrange(len(data))
        data[at] = rng.randrange(256)
        total = 0
        for i, p in enumerate(parts):
            if total <= at < total + len(p):
                hit.add(i)
            total += len(p)
    found, _ = read(bytes(data))
    assert {f"<urn:page:id:{i}>" for i in range(5) if i not in hit} <= set(found)


def test_gaps_are_logged(spark, tmp_path):
    files = write(spark, [(i, "u", f"text {i} " * 30) for i in range(20)], tmp_path / "g")
    data = bytearray(max((f.read_bytes() for f in files), key=len))
    members = list(warc.salvage(bytes(data)))
    data[members[1].offset + members[1].length // 2] ^= 0x55
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "x.warc.gz").write_bytes(bytes(data))
    rows = warc.read_archives(spark, str(tmp_path / "h"))
    assert rows.where("record_type IS NOT NULL").count() == len(members) - 1
    assert rows.where("record_type IS NULL").select("offset", "length").collect() == [(members[1].offset, members[1].length)]


def names_of(data):
    return read(data)[0]


@pytest.mark.parametrize("level", [0, 6])
def test_members_with_many_records(level):
    """An archive compressed as a whole, in blocks that cut through records, and with damage inside and outside."""
    records = [warc.record(str(i), f"http://h/{i}", random.Random(i).randbytes(30_000).hex().encode(), "d", None) for i in range(12)]
    names = [f"<urn:page:id:{i}>" for i in range(12)]
    plain = b"".join(records)
    whole = gzip.compress(plain, level)
    one = warc.members(records[0])
    found = list(warc.salvage(one + whole))
    assert names_of(one + whole) == [names[0]] + names and not [f for f in found if not f.headers]
    assert [(f.offset, f.length) for f in found[1:]] == [(len(one), 0)] * 11 + [(len(one), len(whole))]
    blocks = [gzip.compress(plain[lo:lo + 50_000], level) for lo in range(0, len(plain), 50_000)]
    assert names_of(b"".join(blocks)) == names

    inside = bytearray(plain)
    inside[len(records[0]) + 1_000] ^= 1
    assert names_of(gzip.compress(bytes(inside), level)) == names[:1] + names[2:]
    assert sum(f.headers is None for f in warc.salvage(gzip.compress(bytes(inside), level))) == 1

    cut = whole[:len(whole) * 3 // 4]
    assert names[:8] == names_of(cut)[:8] and names_of(cut + one)[-1] == names[0]
    assert [(f.offset, f.length) for f in warc.salvage(cut + one) if not f.headers] == [(0, len(cut))]
    broken = bytearray(whole)
    broken[len(whole) * 3 // 4:len(whole) * 3 // 4 + 40] = b"\xff" * 40
    assert names_of(bytes(broken))[:8] == names[:8] and len(set(names_of(bytes(broken)))) == len(names_of(bytes(broken)))
    blocks[5] = blocks[5][:40] + b"\xff" * 20 + blocks[5][60:]
    lost = {i for i in range(12) if sum(map(len, records[:i])) < 300_000 and sum(map(len, records[:i + 1])) > 250_000}
    assert {n for i, n in enumerate(names) if i not in lost} <= set(names_of(b"".join(blocks)))


def test_read_whole_refuses_damage_and_missing_records(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "<p>text</p>" * 30 + str(i)) for i in range(20)], "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), str(tmp_path / "a"))
    assert warc.read_whole(spark, str(tmp_path / "a"), 20).count() == 20
    with pytest.raises(ValueError, match="20 records in place of 21"):
        warc.read_whole(spark, str(tmp_path / "a"), 21)
    file = next(p for p in (tmp_path / "a").iterdir() if p.name.startswith("part-") and p.stat().st_size)
    (tmp_path / "b").mkdir()
    raw = bytearray(file.read_bytes())
    raw[len(raw) // 2:len(raw) // 2 + 9] = b"\0" * 9
    (tmp_path / "b" / "part-0.gz").write_bytes(raw)
    with pytest.raises(ValueError, match="is damaged from byte"):
        warc.read_whole(spark, str(tmp_path / "b"), 20)
