"""Fingerprints against windows looked at one by one."""

import hashlib
import random

import numpy as np
import pytest

from keelson.llm import winnow
from keelson.llm.winnow import RUN, WINDOW


def hash_of(run):
    return int(winnow.rolling_hashes(np.array([ord(c) for c in run], np.uint32), len(run))[0])


def brute_force(text, k=RUN, w=WINDOW):
    if not text:
        return []
    hashes = [hash_of(text[i:i + k]) for i in range(max(len(text) - k + 1, 1))]
    w = min(w, len(hashes))
    found = {min(range(i, i + w), key=lambda j: (hashes[j] >> 9, -j)) for i in range(len(hashes) - w + 1)}
    return [(j, hashes[j]) for j in sorted(found)]


def likeness(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def texts():
    rng = random.Random(2)
    out = ["", "a", "ab", "a" * 500, "abc" * 200, "é\U0001f600" * 90, "x" * RUN, "x" * (RUN + 1), "\ud800 lone"]
    out += ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (15, 16, 17, 47, 48, 49, 300, 2000)]
    return out


@pytest.mark.parametrize(("k", "w"), [(RUN, WINDOW), (3, 1), (5, 4), (1, 7)])
def test_equals_windows_one_by_one(k, w):
    for text in texts():
        at, hashes = winnow.fingerprint(text, k, w)
        assert list(zip(at.tolist(), hashes.tolist(), strict=True)) == brute_force(text, k, w), text[:20]
        assert winnow.read(winnow.written(at, hashes)) == brute_force(text, k, w)


def test_chunks_make_no_difference(monkeypatch):
    whole = [winnow.written(*winnow.fingerprint(t)) for t in texts()]
    monkeypatch.setattr(winnow, "CHUNK", 7)
    assert [winnow.written(*winnow.fingerprint(t)) for t in texts()] == whole


def test_rightmost_of_ties_is_kept():
    assert winnow.chosen(np.full(9, 512, np.uint64), 4).tolist() == [3, 4, 5, 6, 7, 8]
    assert winnow.chosen(np.array([5, 1, 1, 9], np.uint64) << np.uint64(9), 3).tolist() == [2]
    with pytest.raises(ValueError, match="window"):
        winnow.chosen(np.zeros(3, np.uint64), winnow.LARGEST_WINDOW + 1)


def test_common_passages_are_always_found():
    rng = random.Random(8)
    for _ in range(60):
        shared = "".join(rng.choice("abcdef") for _ in range(RUN + WINDOW - 1))
        a, b = ("".join(rng.choice("ghijkl") for _ in range(rng.randint(0, 200))) + shared
                + "".join(rng.choice("mnopq") for _ in range(rng.randint(0, 200))) for _ in range(2))
        assert {h for _, h in brute_force(a)} & set(winnow.fingerprint(b)[1].tolist())


def expected(rows):
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode("utf-8", "surrogatepass")))
    out = []
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        own, other = brute_force(text), brute_force(edited)
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    "".join(f"{p:08x}{h:016x}" for p, h in own), "".join(f"{p:08x}{h:016x}" for p, h in other),
                    likeness(own, other), likeness(own, brute_force(after))))
    return out


def by_key(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def test_edits_equal_brute_force(spark, rows_of, prose):
    short = [(k, (t or "")[:3000] if t is not None else None) for k, t in prose]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for width in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        try:
            assert by_key(winnow.edits(rows_of(short)).collect()) == by_key(expected(short))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)


def test_small_tables_and_other_names(spark, rows_of):
    assert winnow.edits(rows_of([])).count() == 0
    row = winnow.edits(rows_of([(4, "abcdefgh")])).first()
    assert row["near_next"] == 1.0
    assert row["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    named = spark.createDataFrame([("b", "one two"), ("a", None), (None, "three")], "name string, body string")
    assert [r["key"] for r in winnow.edits(named, "name", "body").collect()] == [None, "a", "b"]
    nulls = spark.createDataFrame([(None, "x" * 30), (None, "y" * 30)], "doc_id long, text string")
    assert {r["n_chars"] for r in winnow.edits(nulls).collect()} == {30}


def test_very_long_text_and_places(spark):
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefgh ") for _ in range(300_000))
    docs = spark.createDataFrame([(1, long), (2, long[1000:]), (3, "")], "doc_id long, text string")
    prints = winnow.fingerprints(docs)
    found = {r["key"]: winnow.read(r["fingerprint"]) for r in prints.collect()}
    assert found[3] == []
    assert max(b[0] - a[0] for a, b in zip(found[1], found[1][1:], strict=False)) <= WINDOW
    shifted = {(p - 1000, h) for p, h in found[1]}
    assert all(pair in shifted for pair in found[2][1:])
    rows = winnow.places(prints).groupBy("key").count().collect()
    assert {r["key"]: r["count"] for r in rows} == {k: len(v) for k, v in found.items() if v}
    one = winnow.places(prints).filter("key = 1").orderBy("position").first()
    assert (one["position"], int(one["hash"], 16)) == found[1][0]
