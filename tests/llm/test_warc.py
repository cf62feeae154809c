"""Archives: round trip, revisits, and damage."""

import hashlib

import pytest
from pyarrow import fs as pafs

from keelson.llm import warc


@pytest.fixture
def pages(spark):
    big, other = "x" * 1500, "é\r\n\r\nWARC/1.1\r\n" * 200
    rows = [(1, "http://a/", big), (9, "http://b/", big), (5, "http://c/\r\nEvil: 1", big), (2, None, other), (3, "u", other),
            (4, "s1", "small"), (6, "s2", "small"), (7, "n", None), (8, "e", ""), (None, "nokey", big), (10, "t", "y" * 1000),
            (10, "t", "y" * 1000), (11, "l", "z" * 999), (12, "l", "z" * 999)]
    return rows, spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, path string, offset int").repartition(3)


def test_revisits(pages):
    rows, df = pages
    found = warc.deduplicate(df).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found if r.page_id is not None}
    for page, _, html in rows:
        data = (html or "").encode()
        if page is not None:
            assert by_id[page].payload_bytes == len(data)
            assert by_id[page].payload_digest == hashlib.sha1(data).hexdigest()
    refers = {p: (r.record_type, r.refers_to) for p, r in by_id.items() if p != 10}
    assert refers == {1: ("revisit", 9), 9: ("response", None), 5: ("revisit", 9), 2: ("revisit", 3), 3: ("response", None),
                      4: ("response", None), 6: ("response", None), 7: ("response", None), 8: ("response", None),
                      11: ("response", None), 12: ("response", None)}
    assert sorted((r.record_type, r.refers_to) for r in found if r.page_id == 10) == [("response", None), ("revisit", 10)]
    assert [(r.record_type, r.refers_to) for r in found if r.page_id is None] == [("revisit", 9)]
    assert by_id[2].uri is None
    assert by_id[5].uri == "http://c/%0D%0AEvil: 1"


def test_records_are_fresh_and_lie_alone(pages):
    first = warc.read_headers(warc.write_pages(pages[1]))
    manifest = warc.write_deduplicated(warc.plan_revisits(first))
    second = warc.read_headers(manifest)
    old, new = ({r.record_id for r in x.collect()} for x in (first, second))
    assert len(old) == len(new) == len(pages[0])
    assert not old & new
    import zlib
    for r in second.collect():
        fs, place = pafs.FileSystem.from_uri(r.path)
        with fs.open_input_file(place) as f:
            headers, block = warc.parse(zlib.decompress(f.read_at(r.length, r.offset), 31))
        assert headers["warc-record-id"] == r.record_id
        assert (r.record_type == "response") == (len(block.partition(b"\r\n\r\n")[2]) == r.payload_bytes or r.payload_bytes == 0)


def test_damage_is_found(pages):
    manifest = warc.write_pages(pages[1])
    path = next(r.path for r in manifest.collect() if r.records)
    fs, place = pafs.FileSystem.from_uri(path)
    data = bytearray(fs.open_input_file(place).read())
    data[len(data) // 2] ^= 0xFF
    with fs.open_output_stream(place, compression=None) as out:
        out.write(bytes(data))
    with pytest.raises(Exception, match=r"damaged|not a record|wrong place|Error -3|decompress"):
        warc.read_headers(manifest).collect()


def test_empty_table(spark):
    assert warc.deduplicate(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archives_that_hold_revisits_already(spark):
    """Deduplicated archives beside new ones, and a revisit whose response is nowhere."""
    kind = "page_id long, url string, html string"
    big, late, small = "x" * 1500, "y" * 2000, "z" * 10
    old = spark.createDataFrame([(1, "a", big), (50, "b", big), (2, "c", late), (3, "d", small)], kind)
    new = spark.createDataFrame([(7, "e", big), (8, "f", late), (60, "g", late), (9, "h", small)], kind)
    before = warc.read_headers(warc.write_deduplicated(warc.plan_revisits(warc.read_headers(warc.write_pages(old)))))
    fresh = warc.read_headers(warc.write_pages(new))
    lost = before.filter("page_id = 50")  # the response of page 1 went away; page 7 holds the payload anew
    mixed = before.unionByName(fresh).join(lost.select("record_id"), "record_id", "left_anti").select(before.columns)
    found = warc.resolve(warc.read_headers(warc.write_deduplicated(warc.plan_revisits(mixed)))).collect()
    got = {r.page_id: (r.record_type, r.refers_to) for r in found}
    assert got == {1: ("revisit", 7), 7: ("response", None), 2: ("revisit", 60), 8: ("revisit", 60), 60: ("response", None),
                   3: ("response", None), 9: ("response", None)}
    alone = warc.resolve(warc.read_headers(warc.write_deduplicated(warc.plan_revisits(before.filter("page_id in (1, 3)"))))).collect()
    assert {r.page_id: (r.record_type, r.refers_to) for r in alone} == {1: ("revisit", None), 3: ("response", None)}
    kept = next(r for r in alone if r.page_id == 1)
    assert kept.refers_to_record == next(r.record_id for r in before.collect() if r.page_id == 50)
    assert kept.payload_bytes == 1500
