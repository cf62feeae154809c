"""Byte shards against prefix sums."""

import zlib

from keelson.llm import sharding


def test_contiguous_and_balanced(rows_of, prose):
    found = sharding.byte_shards(sharding.sized(rows_of(prose)), 8, ranges=5).collect()
    ordered = sorted(found, key=lambda r: (r["shard"], r["slot"]))
    assert [r["key"] for r in ordered] == sorted((k for k, _ in prose), key=lambda k: (k is not None, k or 0))
    total = sum(r["size"] for r in found)
    start = 0
    for r in ordered:
        assert (r["start"], r["shard"]) == (start, start * 8 // total)
        start += r["size"]
    for shard in {r["shard"] for r in found}:
        own = [r["slot"] for r in ordered if r["shard"] == shard]
        assert own == list(range(len(own)))
    want = sorted(((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in prose), key=repr)
    assert sorted(((r["key"], r["size"], r["text_crc32"]) for r in found), key=repr) == want


def test_one_key_for_all_rows(rows_of):
    found = sharding.byte_shards(sharding.sized(rows_of([(7, "abc")] * 40)), 4, ranges=6).collect()
    assert sorted((r["shard"], r["slot"]) for r in found) == [(s, k) for s in range(4) for k in range(10)]


def test_few_rows_and_empty_table(rows_of):
    assert sharding.byte_shards(sharding.sized(rows_of([])), 8).count() == 0
    assert [r["slot"] for r in sharding.byte_shards(sharding.sized(rows_of([(1, None), (2, "é")])), 8).collect()] == [0, 0]


def test_texts_are_not_shuffled(rows_of, prose):
    plan = sharding.sized(rows_of(prose))._jdf.queryExecution().toString()
    assert "Python" not in plan
