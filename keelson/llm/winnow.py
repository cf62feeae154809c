"""Winnowed fingerprints of texts, with positions.

Every run of ``k`` code points has a rolling 64-bit hash.  Of each window of ``w``
consecutive runs that with the smallest hash (by its first 55 bits) is chosen, of equal
ones the rightmost, and each chosen place is kept once, with its position.  Two texts that share ``k + w - 1``
consecutive code points therefore share a chosen hash, whatever stands around them, and
the positions say where; runs shorter than ``k`` are never matched.

A fingerprint is one string: for each chosen place, in order, 8 hexadecimal digits of
its position and 16 of its hash.  A text is read by one task at a time, whole.

``neighbours`` sets each text beside the next one in key order.  Texts are dealt once to
ranges of keys; the first text of every range is also sent to the range before it, so no
range has to wait for another, and the driver sees one key for each range.

Defined results: a null text is empty and has an empty fingerprint; a text shorter than
``k`` is one run, a text with fewer runs than a window is one window; empty fingerprints
are alike (1.0), an empty and another one are not (0.0); null keys come first, rows with
equal keys are ordered by text, so repeated rows stand side by side; the row after the
last is the first, also of a table of one row; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from keelson.llm.frames import named, shuffle_width, text_of
from keelson.llm.wordstream import mix

#: Code points of a hashed run, and runs of a window: common passages of 48 code points are always found.
RUN, WINDOW = 16, 33
#: Runs hashed at a time, so that a very long text needs few arrays of its own length.
CHUNK = 1 << 16

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Low bits of an ordering key that hold a place in two neighbouring blocks, and so the largest window.
_PLACE_BITS = 9
LARGEST_WINDOW = 1 << _PLACE_BITS - 1


def rolling_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` code points from each place on; the last ``k - 1`` places have none.

    Sums of ``point * base**place`` up to each place; a run's sum is the difference of two
    of them, moved to place 0 by a power of the base's inverse modulo 2**64.
    """
    n = len(points) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    terms = (points.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(points))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(terms)])
    return mix((sums[k:] - sums[:n]) * _powers(_INVERSE, n))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def chosen(hashes: np.ndarray, w: int) -> np.ndarray:
    """Places that are the rightmost smallest of some window of ``w`` hashes, in order.

    Blocks of ``w`` hashes: a window is the end of one block and the beginning of the
    next, so its smallest hash is that of one running minimum backwards and one forwards.
    Ordering keys are hashes whose low bits give way to the place, later ones smaller.
    """
    if not 0 < w <= LARGEST_WINDOW:
        raise ValueError(f"a window has 1 to {LARGEST_WINDOW} runs")
    if not len(hashes):
        return np.empty(0, np.int64)
    w = min(w, len(hashes))
    blocks = -(-len(hashes) // w)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    keys = np.full(blocks * w, np.uint64(2**64 - 1))
    place = (np.uint64(w - 1) - np.arange(w, dtype=np.uint64))
    keys[:len(hashes)] = (hashes & ~low)
    keys = keys.reshape(blocks, w) | place
    forwards = np.minimum.accumulate(keys, axis=1).ravel()
    backwards = np.minimum.accumulate(keys[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(len(hashes) - w + 1)
    left, right = backwards[starts], forwards[starts + w - 1]
    # The window from a block's first place on is that block alone; elsewhere the right part is the later one.
    takes_right = (right & ~low) <= (left & ~low)
    block = np.where(takes_right, (starts + w - 1) // w, starts // w)
    at = block * w + (w - 1) - (np.where(takes_right, right, left) & low).astype(np.int64)
    return np.unique(at)


def fingerprint(text: str, k: int = RUN, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the chosen runs of a text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    if len(points) <= k:
        return np.zeros(1, np.int64), rolling_hashes(points, len(points))
    positions, values = [], []
    runs = len(points) - k + 1
    # Neighbouring chunks share w - 1 runs, so that every window lies in one of them.
    for begin in range(0, max(runs - w + 1, 1), CHUNK):
        hashes = rolling_hashes(points[begin:begin + CHUNK + w - 1 + k - 1], k)
        at = chosen(hashes, w)
        positions.append(at + begin)
        values.append(hashes[at])
    at, first = np.unique(np.concatenate(positions), return_index=True)
    return at, np.concatenate(values)[first]


_DIGITS = np.frombuffer("".join(f"{b:02x}" for b in range(256)).encode(), np.uint16)


def written(at: np.ndarray, hashes: np.ndarray) -> str:
    """A fingerprint as a string of 24 hexadecimal digits for each chosen run."""
    rows = np.empty((len(at), 12), np.uint8)
    rows[:, :4] = at.astype(">u4").view(np.uint8).reshape(-1, 4)
    rows[:, 4:] = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    return _DIGITS[rows.ravel()].tobytes().decode("ascii")


def read(fingerprint_: str) -> list[tuple[int, int]]:
    """Positions and hashes of a written fingerprint."""
    return [(int(fingerprint_[k:k + 8], 16), int(fingerprint_[k + 8:k + 24], 16)) for k in range(0, len(fingerprint_), 24)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the distinct hashes of two fingerprints, sorted and without repeats, that both have."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _fingerprints(batches, k, w):
    for batch in batches:
        found = [written(*fingerprint(t or "", k, w)) for t in batch.columns[-1].to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string())],
                                         names=[*batch.schema.names[:-1], "fingerprint"])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = RUN, w: int = WINDOW) -> DataFrame:
    """``key, fingerprint`` of every row; nothing is shuffled."""
    rows = docs.select(*named(key=key, text=text))
    return rows.mapInArrow(lambda batches: _fingerprints(batches, k, w),
                           f"key {rows.schema[0].dataType.simpleString()}, fingerprint string")


def places(prints: DataFrame) -> DataFrame:
    """``key, position, hash``: one row for each chosen run, to be joined or indexed by hash."""
    starts = F.expr("sequence(1, length(fingerprint), 24)")
    return prints.filter("fingerprint <> ''").select("key", "fingerprint", F.explode(starts).alias("at")).select(
        "key", F.conv(F.substring("fingerprint", F.col("at"), F.lit(8)), 16, 10).cast("long").alias("position"),
        F.substring("fingerprint", F.col("at") + 8, F.lit(16)).alias("hash"))


def _range_of(key: Column, cuts: list) -> Column:
    """How many of the ascending ``cuts`` are not above ``key``, by binary search; a null key is below all."""
    array = F.array(*(F.lit(c) for c in cuts))
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    return F.aggregate(F.array(*(F.lit(s) for s in steps)), F.lit(0), lambda low, step: F.when(
        F.try_element_at(array, low + step) <= key, low + step).otherwise(low))


def neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``range, tail, key, text`` dealt by range and sorted, so that the next text follows in the same task.

    A row with ``tail`` is a copy of the text after the range's last one.
    """
    spark = docs.sparkSession
    rows = docs.select(*named(key=key, body=text)).select("key", text_of("body").alias("text"))
    width = shuffle_width(spark)
    # The first key of each range of the keys alone: as many rows as partitions.
    firsts = rows.select("key").filter("key is not null").repartitionByRange(width, "key").groupBy(
        F.spark_partition_id()).agg(F.min("key").alias("key"))
    cuts = sorted(r["key"] for r in firsts.collect())[1:]
    placed = rows.withColumn("range", _range_of(F.col("key"), cuts) if cuts else F.lit(0))
    # Of a cut's rows that with the least text is the first of its range; the least of all follows the last.
    ends = rows.agg(F.count_if(F.col("key").isNull()).alias("nulls"), F.min("key").alias("key")).first()
    least = F.col("key").isNull() if ends["nulls"] else F.col("key") == F.lit(ends["key"])
    copies = rows.filter(least).groupBy("key").agg(F.min("text").alias("text")).withColumn("range", F.lit(len(cuts)))
    if cuts:
        heads = rows.filter(F.col("key").isin(*cuts)).groupBy("key").agg(F.min("text").alias("text"))
        copies = copies.unionByName(heads.withColumn("range", _range_of(F.col("key"), cuts) - 1))
    both = placed.withColumn("tail", F.lit(False)).unionByName(copies.withColumn("tail", F.lit(True)))
    order = ["range", "tail", "key", "text"]
    return both.select(*order).repartitionById(len(cuts) + 1, F.col("range")).sortWithinPartitions(*order)


def _edited(batches, k, w, kind):
    """Each text beside the next row's; see ``edits``."""
    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None
    for batch in batches:
        out = []
        for tail, key, text in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)), strict=True):
            at, hashes = fingerprint(text, k, w)
            distinct = np.unique(hashes)
            if held is not None:
                last_key, last, last_print, last_hashes = held
                cut = len(last) // 4
                edited = last[:len(last) - cut] + text[:cut]
                edited_at, edited_hashes = fingerprint(edited, k, w)
                out.append((last_key, len(last), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                            last_print, written(edited_at, edited_hashes),
                            likeness(last_hashes, np.unique(edited_hashes)), likeness(last_hashes, distinct)))
            held = None if tail else (key, text, written(at, hashes), distinct)
        columns = zip(*out, strict=True) if out else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def edits(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = RUN, w: int = WINDOW) -> DataFrame:
    """How fingerprints bear an edit: each text against itself with another end, and against the next text.

    The edited text has its last quarter of code points replaced by as many of the next
    text's first ones, or all that there are.
    """
    rows = neighbours(docs, key, text)
    field = rows.schema["key"]
    kind = to_arrow_type(field.dataType)
    return rows.mapInArrow(
        lambda batches: _edited(batches, k, w, kind),
        f"key {field.dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")

