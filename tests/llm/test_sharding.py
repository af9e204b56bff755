import numpy as np
from collections import Counter
from zlib import crc32

from conftest_llm import docs_of
from tidewatch.llm import sharding


def slow_jump(key, shards):
    at, ahead = -1, 0
    while ahead < shards:
        at = ahead
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        ahead = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_hash_and_its_growth():
    keys = np.random.default_rng(1).integers(0, 1 << 64, 4000, dtype=np.uint64)
    before = None
    for n in range(1, 40):
        now = sharding.jump(keys, n)
        assert now.tolist()[:200] == [slow_jump(int(k), n) for k in keys[:200]]
        if before is not None:
            assert ((now == before) | (now == n - 1)).all()
            assert abs((now != before).mean() - 1 / n) < 0.03
        before = now


def slots_are_gapless(rows):
    for shard in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))


def test_documents(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_GROUP_ROWS", 3)
    docs = {r.doc_id: r.text.encode() for r in docs_of(spark, sf_dir).collect()}
    rows = sharding.shard_documents(docs_of(spark, sf_dir), 8).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {d: (len(t) + 1, crc32(t)) for d, t in docs.items()}
    assert {r.shard for r in rows} == set(range(8)) and all(r.grown_shard in (r.shard, 8) for r in rows)
    slots_are_gapless(rows)
    again = {r.doc_id: r.shard for r in sharding.shard_documents(docs_of(spark, sf_dir), 9).collect()}
    assert again == {r.doc_id: r.grown_shard for r in rows}


def test_odd_rows(odd):
    rows = sharding.shard_documents(odd, 3).collect()
    slots_are_gapless(rows)
    assert Counter(r.doc_id for r in rows) == Counter([1, 2, 3, 4, 5, 5, None, None, 6, 7])
    assert len({r.shard for r in rows if r.doc_id == 5}) == 1 == len({r.shard for r in rows if r.doc_id is None})
    assert {r.size for r in rows if r.doc_id in (1, 2)} == {1}
    assert sharding.shard_documents(odd.limit(0), 3).count() == 0


def test_written_shards(spark, odd, tmp_path):
    sharding.write_shards(odd, str(tmp_path / "s"), 4, max_rows=2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == odd.count() and set(back.columns) == {*odd.columns, "shard_id"}
