"""Stupid-backoff scores of documents under n-gram counts of the whole corpus.

A word after the words ``h`` scores ``c(h w) / c(h)`` if ``h w`` was counted, else
``BACKOFF`` times its score after a history shorter by one word; alone it scores
``c(w) / N``.  All n-grams count; a caller may ask that those of two words and more count
from ``cutoff`` occurrences on only, so that a document does not vouch for its own rare
phrases.  A document's score is the sum of the logarithms over its words.  Words lose the
case of A-Z; n-grams stay inside a document.

Relations carry arrays rather than single n-grams: a block of documents sends each of its
distinct n-grams once, with its count, to the part of the count table that the hash
belongs to.  A part adds up what it got, which is its share of the table, and joins the
totals to the blocks that asked.  Parts are uniform whatever the data, since a block
sends an n-gram once however often it occurs, and their number grows with the words.
Of n-grams of three words and more only those are asked for whose two parts, all words but
the last and all but the first, occur twice or more: any other occurs once, as its rarer
part does.  That is most of them, and their counts need no shuffle.

Defined results: null and empty texts have no words and a score of 0 with a null mean;
repeated rows all count; null keys are carried; an empty table gives no rows.  N-grams are
told apart by 64-bit hashes.
"""

from __future__ import annotations

import os
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.frames import bucketed, named
from keelson.llm.wordstream import join_hashes, pieces
from keelson.session import materialize

BACKOFF = 0.4
CUTOFF = 1
#: Text in a block, and n-grams in a part of the table for which parts are made.
BLOCK_BYTES = 3 << 20
PART_NGRAMS = 1_000_000
#: Bytes before compression, ahead of each packed array.
SIZE = "<I"
#: Arrays of fewer bytes are left to the codec of the shuffle.
LEAST_PACKED = 1024


def packed(values: np.ndarray) -> bytes:
    """Numbers by byte place, so that leading zeros of all of them lie together, as one zstd frame.

    Most counts are ones: entropy coding makes much less of them than the codec of the shuffle.
    A short array stays as it is (size 0): there the frame would cost what it saves.
    """
    size = values.dtype.itemsize
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, size).T).tobytes()
    if len(planes) < LEAST_PACKED:
        return struct.pack(SIZE, 0) + planes
    return struct.pack(SIZE, len(planes)) + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes, kind) -> np.ndarray:
    size, head = np.dtype(kind).itemsize, struct.calcsize(SIZE)
    (length,) = struct.unpack(SIZE, data[:head])
    plain = pa.decompress(data[head:], length, codec="zstd") if length else data[head:]
    planes = np.frombuffer(plain, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


class Block:
    """Words of some documents as codes into a vocabulary of hashes, and what is known of their n-grams."""

    def __init__(self, lengths: np.ndarray, vocabulary: np.ndarray, codes: np.ndarray):
        self.words = vocabulary[codes]
        begin = np.cumsum(lengths) - lengths
        self.place = (np.arange(len(codes)) - np.repeat(begin, lengths)).astype(np.int32)
        self.gram, self.alive = self.words, np.ones(len(codes), bool)
        self.order, self.asked = 1, np.arange(len(codes), dtype=np.int32)
        self.counts = None

    def ask(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams of the present order, ascending, and their counts here."""
        self.distinct, self.of, counts = np.unique(
            self.gram[self.asked], return_inverse=True, return_counts=True)
        return self.distinct, counts

    def answer(self, totals: np.ndarray, cutoff: int) -> None:
        """Totals of the n-grams asked for; others occur once.  Those that do not count have 0."""
        if not hasattr(self, "of"):
            self.ask()
        self.counts = ((self.place >= self.order - 1) & (cutoff <= 1)).astype(np.uint32)
        self.counts[self.asked] = totals[self.of]
        self.alive = self.counts > 0
        del self.of

    def lengthen(self) -> None:
        """Goes on to n-grams longer by a word; both parts of one that is asked for occur twice, if they are known."""
        wanted = self.place >= self.order
        if self.order > 1:
            wanted[1:] &= (self.counts[:-1] > 1) & (self.counts[1:] > 1)
        gram = np.zeros_like(self.gram)
        gram[1:] = join_hashes(self.gram[:-1], self.words[1:])
        self.asked = np.flatnonzero(wanted).astype(np.int32)
        self.gram, self.order = gram, self.order + 1


def _gathered(batches):
    """Batches of about ``BLOCK_BYTES`` of text."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= BLOCK_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _blocks(batches):
    for batch in _gathered(batches):
        words, lengths = [], []
        for piece in pieces(batch.column(1)):
            words.append(piece.word_hashes(lower=True))
            lengths.append(piece.n_words.astype(np.int32))
        distinct, codes, counts = np.unique(np.concatenate(words), return_inverse=True, return_counts=True)
        by_count = np.argsort(-counts, kind="stable")
        rank = np.empty(len(distinct), np.int32)
        rank[by_count] = np.arange(len(distinct), dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([int.from_bytes(os.urandom(8), "little", signed=True)]),
             pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0)),
             pa.array([np.concatenate(lengths)], pa.list_(pa.int32())),
             pa.array([packed(distinct[by_count])], pa.binary()), pa.array([packed(rank[codes])], pa.binary())],
            names=["block", "keys", "lengths", "vocabulary", "codes"])


def _open(batch: pa.RecordBatch, row: int) -> Block:
    at = {name: batch.column(name)[row] for name in ("lengths", "vocabulary", "codes")}
    return Block(at["lengths"].values.to_numpy().astype(np.int64), unpacked(at["vocabulary"].as_py(), np.uint64),
                 unpacked(at["codes"].as_py(), np.int32))


def _totals(batch: pa.RecordBatch, row: int) -> dict[int, np.ndarray]:
    """Answers by order; parts follow one another as hashes do."""
    found: dict[int, list] = {}
    for answer in sorted(batch.column("answers")[row].as_py(), key=lambda a: (a["order"], a["part"])):
        found.setdefault(answer["order"], []).append(unpacked(answer["counts"], np.uint32))
    return {order: np.concatenate(parts) for order, parts in found.items()}


def _replay(block: Block, totals: dict[int, np.ndarray], upto: int, cutoff: int):
    """Brings a block to n-grams of ``upto`` words; yields at each answered order."""
    while block.order < upto:
        block.answer(totals.get(block.order, np.empty(0, np.uint32)), cutoff)
        yield block
        block.lengthen()


def _requests(batches, orders, parts, cutoff):
    for batch in batches:
        for row in range(batch.num_rows):
            yield _requests_of(batch, row, orders, parts, cutoff)


def _requests_of(batch, row, orders, parts, cutoff) -> pa.RecordBatch:
    block, name = _open(batch, row), batch.column("block")[row].as_py()
    if "answers" in batch.schema.names:
        for _ in _replay(block, _totals(batch, row), orders[0], cutoff):
            pass
    out = []
    for order in orders:
        if block.order < order:
            block.lengthen()
        grams, counts = block.ask()
        of = ((grams >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        cuts = np.searchsorted(of, np.arange(parts + 1, dtype=np.uint64))
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[part], cuts[part + 1]
            out.append((part, order, name, packed(np.diff(grams[a:b], prepend=np.uint64(0))),
                        packed(counts[a:b].astype(np.uint32))))
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)],
                                      names=["part", "order", "block", "grams", "counts"])


def _add_up(table: pa.Table, cutoff: int) -> pa.Table:
    """One part of a count table: totals, and the answer to each block that asked."""
    asked = [np.cumsum(unpacked(x, np.uint64), dtype=np.uint64) for x in table.column("grams").to_pylist()]
    counts = [unpacked(x, np.uint32) for x in table.column("counts").to_pylist()]
    order = table.column("order")[0].as_py()
    _, of = np.unique(np.concatenate(asked), return_inverse=True)
    totals = np.bincount(of, weights=np.concatenate(counts))
    totals[totals < (cutoff if order > 1 else 1)] = 0
    totals = np.minimum(totals, 2**32 - 1).astype(np.uint32)
    ends = np.cumsum([len(a) for a in asked])
    answers = [packed(totals[of[end - len(a):end]]) for a, end in zip(asked, ends, strict=True)]
    return pa.table({"block": table.column("block"), "order": table.column("order"), "part": table.column("part"),
                     "counts": pa.array(answers, pa.binary())})


def _score(batches, order, total, backoff, cutoff):
    for batch in batches:
        for row in range(batch.num_rows):
            yield _scores_of(batch, row, order, total, backoff, cutoff)


def _scores_of(batch, row, order, total, backoff, cutoff) -> pa.RecordBatch:
    score, context = None, None
    for level in _replay(_open(batch, row), _totals(batch, row), order + 1, cutoff):
        with np.errstate(divide="ignore", invalid="ignore"):
            if level.order == 1:
                score = np.log(level.counts) - np.log(total)
            else:
                after = np.log(level.counts[1:]) - np.log(context[:-1])
                score = score + np.log(backoff) * (level.place >= level.order - 1)
                score[1:] = np.where(level.alive[1:], after, score[1:])
        context = level.counts
    lengths = batch.column("lengths")[row].values.to_numpy().astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(lengths)])
    sums = [float(score[a:b].sum()) if b > a else 0.0 for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
    means = [s / n if n else None for s, n in zip(sums, lengths.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [batch.column("keys")[row].values, pa.array(lengths), pa.array(sums, pa.float64()), pa.array(means, pa.float64())],
        names=["key", "n_words", "log_score", "mean_log_score"])


def scores(docs: DataFrame, order: int = 3, key: str = "doc_id", text: str = "text", cutoff: int = CUTOFF,
           backoff: float = BACKOFF) -> DataFrame:
    """``key, n_words, log_score, mean_log_score`` of every row."""
    rows = docs.select(*named(key=key, text=text))
    kind = rows.schema[0].dataType.simpleString()
    blocks = bucketed(rows.mapInArrow(
        _blocks, f"block long, keys array<{kind}>, lengths array<int>, vocabulary binary, codes binary"), "block", "blocks")
    total = blocks.select(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, n: s + n))).first()[0] or 0
    parts = max(1, -(-total // PART_NGRAMS))
    asked = "part int, order int, block long, grams binary, counts binary"
    answered = "block long, order int, part int, counts binary"

    def answers_to(requests: DataFrame, name: str) -> DataFrame:
        return materialize(requests.groupBy("order", "part").applyInArrow(lambda t: _add_up(t, cutoff), answered), name)

    def with_answers() -> DataFrame:
        gathered = answers.groupBy("block").agg(F.collect_list(F.struct("order", "part", "counts")).alias("answers"))
        return blocks.join(gathered.hint("merge"), "block", "left").withColumn("answers", F.coalesce("answers", F.array()))

    first = list(range(1, min(order, 2) + 1))
    columns = ["block", "lengths", "vocabulary", "codes"]
    answers = answers_to(blocks.select(*columns).mapInArrow(lambda b: _requests(b, first, parts, cutoff), asked), "answers")
    for longer in range(3, order + 1):
        more = with_answers().select(*columns, "answers").mapInArrow(
            lambda b, longer=longer: _requests(b, [longer], parts, cutoff), asked)
        answers = answers.unionByName(answers_to(more, "answers"))
    return with_answers().select(*columns, "keys", "answers").mapInArrow(
        lambda b: _score(b, order, total, backoff, cutoff), f"key {kind}, n_words long, log_score double, mean_log_score double")
