"""Removal of word passages that also stand elsewhere, by level-wise doubling.

A passage of ``window`` words can only be repeated if all shorter windows in it are.  The
search therefore starts with short windows, keeps the places whose short window is
repeated, and extends those alone to windows of twice the length, level by level, until
the wanted length is reached or no candidate survives.

Below the wanted length a place needs one witness per level, not every window: of the
short windows inside the long one, that with the smallest hash.  Equal passages choose
the same witness, so none is lost, and neighbouring places mostly share one: a first
level of 9 words shuffles one entry in fourteen words.

Equal texts are one text throughout, with a count: all their windows are repeated.  So a
text with any number of copies adds its windows once.  Counts are reduced before their
shuffle; joins back to places can be split where a passage is very frequent.

Defined results: null, empty and short texts lose nothing; repeated rows are copies and
lose everything if they are long enough; keys play no part, so null or repeated keys
are no special case; an empty table gives no rows.  Windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.frames import named, small_side, text_of, tidy
from keelson.llm.wordstream import Piece, pieces, window_hashes, window_minima
from keelson.session import materialize

_SEGMENT = "node binary, begin int, words array<long>, at array<int>, hash array<long>"


def levels(window: int) -> list[int]:
    """Lengths that double up to ``window``; the last step may overlap by a word."""
    out = [window]
    while out[0] > 9:
        out.insert(0, -(-out[0] // 2))
    return out


def _witnesses(words: np.ndarray, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place of a whole window in ``words``: where its witness of ``length`` words is; and all hashes."""
    hashes = window_hashes(words, length)
    return window_minima(hashes, window - length + 1), hashes


def _first_level(batches, length, window):
    for batch in batches:
        for piece in pieces(batch.column(1)):
            hashes = piece.word_hashes()
            place, values = _witnesses(hashes, length, window)
            whole = piece.whole_windows(window)[:len(place)]
            at = np.unique(place[whole])
            text = np.searchsorted(piece.first, at, "right") - 1
            starts = np.searchsorted(text, np.arange(piece.n_texts + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(piece.row, piece.n_texts), pa.array(piece.n_words.astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(starts), pa.array((at - piece.first[text]).astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(starts), pa.array(values[at].view(np.int64)))],
                names=["node", "n_words", "at", "hash"])


def _extended(node, begin: int, words: np.ndarray, repeated: np.ndarray, length: int, longer: int, window: int):
    """Stretches of ``words`` whose places survive ``length``, with the candidates of the next length."""
    place, _ = _witnesses(words, length, window)
    alive = np.flatnonzero(np.isin(place, repeated))
    if not len(alive):
        return
    cuts = np.flatnonzero(np.diff(alive) > 1) + 1
    for run in np.split(alive, cuts):
        part = words[run[0]:run[-1] + window]
        witness, values = _witnesses(part, longer, window)
        at = np.unique(witness)
        yield node, begin + int(run[0]), part.view(np.int64), at.astype(np.int32), values[at].view(np.int64)


def _segments(rows) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                      names=["node", "begin", "words", "at", "hash"])


def _in_batches(rows):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2]) + len(row[3])
        if size > 1_000_000:
            yield _segments(held)
            held, size = [], 0
    yield _segments(held)


def _list(column: pa.Array, row: int, kind) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False).astype(kind, copy=False)


def _from_texts(batches, length, longer, window):
    def rows():
        for batch in batches:
            for piece in pieces(batch.column(1)):
                hashes = piece.word_hashes()
                for t in range(piece.n_texts):
                    row = piece.row + t
                    yield from _extended(batch.column(0)[row].as_py(), 0, hashes[piece.first[t]:piece.first[t + 1]],
                                         _list(batch.column(2), row, np.int64), length, longer, window)
    yield from _in_batches(rows())


def _from_segments(batches, length, longer, window):
    def rows():
        for batch in batches:
            for row in range(batch.num_rows):
                yield from _extended(batch.column(0)[row].as_py(), batch.column(1)[row].as_py(),
                                     _list(batch.column(2), row, np.int64).view(np.uint64),
                                     _list(batch.column(3), row, np.int64), length, longer, window)
    yield from _in_batches(rows())


def _repeated(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, at``: the candidates whose hash occurs at two or more places."""
    flat = candidates.select(*keys, F.explode(F.arrays_zip("at", "hash")).alias("c")).select(
        *keys, F.col("c.at").alias("at"), F.col("c.hash").alias("hash"))
    # Stored, so that both sides of the join are plain shuffles: adaptive execution can then split a hot hash.
    often = materialize(flat.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), "often")
    return flat.join(often.hint("merge"), "hash", "left_semi").groupBy(*keys).agg(F.collect_list("at").alias("at"))


def repeated_places(docs: DataFrame, window: int = 35, text: str = "text") -> DataFrame:
    """``node, copies, n_words, at``: per distinct text, where its repeated windows start.

    ``node`` is the MD5 of the text.  Texts without copies or repeated windows have no row.
    """
    texts = docs.select(*named(text=text)).select(_node(), text_of().alias("text"))
    lengths = levels(window)
    first = texts.mapInArrow(tidy(lambda b: _first_level(b, lengths[0], window)),
                             "node binary, n_words int, at array<int>, hash array<long>")
    nodes = materialize(first.groupBy("node").agg(
        F.count("*").alias("copies"), F.first("n_words").alias("n_words"), F.first("at").alias("at"),
        F.first("hash").alias("hash")), "nodes")
    copies = nodes.filter("copies > 1").select("node", "copies", F.array().cast("array<int>").alias("at"))
    found = _repeated(nodes, ["node"])
    if len(lengths) > 1:
        found = materialize(found, "found")
        # Only texts with candidates go through the shuffle, as long as their number allows.
        some = texts.join(small_side(found.select("node")), "node", "left_semi").dropDuplicates(["node"])
        survivors = some.join(found.hint("merge"), "node")
        step = survivors.select("node", "text", "at").mapInArrow(
            tidy(lambda b: _from_texts(b, lengths[0], lengths[1], window)), _SEGMENT)
        for length, longer in zip(lengths[1:], [*lengths[2:], 0], strict=True):
            segments = materialize(step, "segments")
            found = _repeated(segments, ["node", "begin"])
            if not longer or segments.isEmpty():
                found = found.select("node", F.expr("transform(at, x -> x + begin)").alias("at"))
                break
            step = _next_step(segments, found, length, longer, window)
    marked = found.select("node", F.lit(1).cast("long").alias("copies"), "at")
    return marked.unionByName(copies).groupBy("node").agg(
        F.max("copies").alias("copies"), F.flatten(F.collect_list("at")).alias("at"))


def _next_step(segments: DataFrame, found: DataFrame, length: int, longer: int, window: int) -> DataFrame:
    rows = segments.select("node", "begin", "words").join(found.hint("merge"), ["node", "begin"])
    return rows.select("node", "begin", "words", "at").mapInArrow(
        tidy(lambda b: _from_segments(b, length, longer, window)), _SEGMENT)


def _node():
    return F.unhex(F.md5(text_of())).alias("node")


def removed_words(piece: Piece, places: list[np.ndarray | None], copies: list[int | None], window: int) -> np.ndarray:
    """Which words of the piece lie in a repeated window."""
    change = np.zeros(len(piece.starts) + 1, np.int64)
    for t in range(piece.n_texts):
        begin, end = piece.first[t], piece.first[t + 1]
        if (copies[t] or 0) > 1:
            if end - begin >= window:
                change[begin] += 1
                change[end] -= 1
        elif places[t] is not None and len(places[t]):
            at = begin + np.asarray(places[t])
            change[at] += 1
            change[at + window] -= 1
    return np.cumsum(change[:-1]) > 0


def kept_texts(piece: Piece, gone: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words left of each text, joined by single spaces; and how many were taken."""
    keep = np.flatnonzero(~gone)
    lengths = piece.ends[keep] - piece.starts[keep] + 1  # with the space after the word
    begin = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    source = np.arange(total) + np.repeat(piece.starts[keep] - begin, lengths)
    data = piece.data[np.minimum(source, max(len(piece.data) - 1, 0))]
    data[begin + lengths - 1] = 32
    upto = np.append(begin, total)
    first = np.searchsorted(keep, piece.first)
    starts = upto[first]
    ends = np.maximum(starts[1:] - 1, starts[:-1])
    whole = data.tobytes()
    texts = [whole[a:b].decode() for a, b in zip(starts[:-1].tolist(), ends.tolist(), strict=True)]
    taken = np.concatenate([[0], np.cumsum(gone)])
    return pa.array(texts, pa.string()), taken[piece.first[1:]] - taken[piece.first[:-1]]


def _cut(batches, window):
    for batch in batches:
        kept_columns = batch.columns[:-3]
        body, copies, at = batch.columns[-3:]
        for piece in pieces(body):
            rows = range(piece.row, piece.row + piece.n_texts)
            gone = removed_words(piece, [_list(at, r, np.int64) if at[r].is_valid else None for r in rows],
                                 copies.slice(piece.row, piece.n_texts).to_pylist(), window)
            texts, taken = kept_texts(piece, gone)
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(piece.row, piece.n_texts) for c in kept_columns), pa.array(piece.n_words),
                 pa.array(taken), texts],
                names=[*batch.schema.names[:-3], "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, window: int = 35, carry: tuple[str, ...] = ("doc_id",),
                   text: str = "text") -> DataFrame:
    """``carry`` columns, ``n_words, n_removed, kept``: every row's text without its repeated passages."""
    places = materialize(repeated_places(docs, window, text), "places")
    own = docs.select(*(F.col(f"`{c}`") for c in carry), F.col(f"`{text}`").alias("__text"))
    rows = own.withColumn("__node", F.unhex(F.md5(text_of("__text")))).join(
        places.select(F.col("node").alias("__node"), F.col("copies").alias("__copies"), F.col("at").alias("__at"))
        .hint("merge"), "__node", "left").select(*(F.col(f"`{c}`") for c in carry), text_of("__text").alias("__text"), "__copies", "__at")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-3])
    return rows.mapInArrow(tidy(lambda b: _cut(b, window)), f"{kinds}, n_words long, n_removed long, kept string")
