"""Byte-pair encoding with an index of pair occurrences, and decoding.

The words of a chunk of texts that have not been met before are laid out as one long
array of symbols.  An index maps each mergeable pair, by its rank, to all positions at
which it stands.  The lowest active rank is taken, all its positions are merged at once,
and only the pairs beside them are looked up again and added to the index.  Words do not
influence each other, so taking ranks in ascending order over all words does for each
word what encoding it alone would do; a merge that makes a pair of lower rank puts that
rank in front again.

Encoding works inside the partition in which a text is read: no shuffle, and memory
bounded by ``CHUNK_BYTES`` of text plus one text.

Defined results: a null or empty text has no ids and decodes to an empty text; strings of
special tokens become those tokens; bytes that are no UTF-8 after decoding become U+FFFD.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.frames import named, tidy

#: So much text is encoded together.
CHUNK_BYTES = 8 << 20
#: Places that are looked up and entered into the index in one go.
INDEXED_AT_ONCE = 500_000
#: Known words are forgotten beyond so many.
KNOWN_WORDS = 400_000
#: Longer texts are searched for words in parts of about so many characters.
PART_CHARS = 1 << 20

#: Fixed value: how the byte-level vocabularies split text into words; white space is Unicode's.
WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Ids, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        ids = stored["model"]["vocab"]
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.bytes_of: list[bytes] = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            self.bytes_of[i] = bytes(of_letter[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.first = np.array([ids[c] for c in letters], np.int32)
        pairs = [x.split(" ") if isinstance(x, str) else x for x in stored["model"]["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], np.int64)
        self.right = np.array([ids[b] for _, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        keys = self.left << 32 | self.right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it does not merge."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], -1)


class PairIndex:
    """Positions of every mergeable pair, by rank, with a heap of the ranks in use."""

    def __init__(self):
        self.at: dict[int, list[np.ndarray]] = {}
        self.heap: list[int] = []

    def add(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        some = ranks >= 0
        if not some.any():
            return
        ranks, positions = ranks[some], positions[some]
        if len(ranks) > 1:
            by = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[by], positions[by]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        begin = 0
        for end in [*cuts.tolist(), len(ranks)]:
            rank = int(ranks[begin])
            if rank not in self.at:
                self.at[rank] = []
                heapq.heappush(self.heap, rank)
            self.at[rank].append(positions[begin:end])
            begin = end

    def pop(self) -> tuple[int, np.ndarray]:
        rank = heapq.heappop(self.heap)
        found = self.at.pop(rank)
        return rank, found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def encode_words(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after the other, and where each word starts (one entry more)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    symbols = vocabulary.first[np.frombuffer(b"".join(words), np.uint8)]
    n = len(symbols)
    following = np.arange(1, n + 1, dtype=np.int32)
    following[ends[lengths > 0] - 1] = -1
    before = np.arange(-1, n - 1, dtype=np.int32)
    before[(ends - lengths)[lengths > 0]] = -1
    index = PairIndex()
    for start in range(0, n, INDEXED_AT_ONCE):
        at = (start + np.flatnonzero(following[start:start + INDEXED_AT_ONCE] >= 0)).astype(np.int32)
        index.add(vocabulary.ranks(symbols[at], symbols[at + 1]), at)
    while index.heap:
        rank, at = index.pop()
        left, right = vocabulary.left[rank], vocabulary.right[rank]
        after = following[at]
        good = (symbols[at] == left) & (after >= 0)
        good &= symbols[after] == right
        at, after = at[good], after[good]
        if left == right and len(at) > 1:
            # In a row of equal symbols every second pair is left over: the leftmost goes first.
            chained = np.concatenate([[False], after[:-1] == at[1:]])
            start = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
            first = (np.arange(len(at)) - start) % 2 == 0
            at, after = at[first], after[first]
        if not len(at):
            continue
        symbols[at] = vocabulary.merged[rank]
        symbols[after] = -1
        beyond = following[after]
        following[at] = beyond
        has_right = beyond >= 0
        before[beyond[has_right]] = at[has_right]
        behind = before[at]
        pairs = np.concatenate([behind[behind >= 0], at[has_right]])
        if len(pairs):
            pairs = np.unique(pairs)
            index.add(vocabulary.ranks(symbols[pairs], symbols[following[pairs]]), pairs)
    alive = symbols >= 0
    counts = np.concatenate([[0], np.cumsum(alive)])
    return symbols[alive], counts[np.concatenate([[0], ends])]


class _Places(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class Encoder:
    """Encodes chunk after chunk and remembers words."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.words = regex.compile(WORDS)
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.cut = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
        self.forget()

    def forget(self) -> None:
        self.places, self.ids = _Places(), np.empty(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def _parts(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > PART_CHARS:
            found = self.cut.search(text, at + PART_CHARS)
            if not found:
                break
            yield text[at:found.start()]
            at = found.start()
        yield text[at:]

    def _numbers(self, text: str) -> np.ndarray:
        """Word numbers of a text; special tokens are -1 minus their id."""
        out = []
        for piece in self.special.split(text) if self.special else [text]:
            if self.special and piece in self.vocabulary.special:
                out.append(np.array([-1 - self.vocabulary.special[piece]], np.int32))
            elif piece:
                for part in self._parts(piece):
                    found = self.words.findall(part)
                    out.append(np.fromiter(map(self.places.__getitem__, found), np.int32, len(found)))
        return np.concatenate(out) if out else np.empty(0, np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.places) > KNOWN_WORDS:
            self.forget()
        known = len(self.places)
        numbers = [self._numbers(t) for t in texts]
        new = [w.encode() for w in list(self.places)[known:]]
        if new:
            ids, starts = encode_words(new, self.vocabulary)
            self.starts = np.concatenate([self.starts, starts[1:] + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
        return [self._ids(n) for n in numbers]

    def _ids(self, numbers: np.ndarray) -> np.ndarray:
        if not len(numbers):
            return np.empty(0, np.int32)
        special = numbers < 0
        words = np.where(special, 0, numbers) if special.any() else numbers
        begin = self.starts[words] if len(self.starts) > 1 else np.zeros(len(words), np.int64)
        size = self.starts[words + 1] - begin if len(self.starts) > 1 else np.zeros(len(words), np.int64)
        size = np.where(special, 1, size)
        upto = np.cumsum(size)
        take = np.arange(upto[-1]) + np.repeat(begin - upto + size, size)
        if not special.any():
            return self.ids[take]
        place = np.flatnonzero(special)
        take[(upto - size)[place]] = 0
        out = self.ids[take] if len(self.ids) else np.zeros(len(take), np.int32)
        out[(upto - size)[place]] = -1 - numbers[place]
        return out


def decode(ids: list[int], bytes_of: list[bytes]) -> str:
    return b"".join(map(bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _chunks(batches) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts, gathered up to a chunk."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for start in range(batch.num_rows):
            text = batch.column(1)[start].as_py() or ""
            keys.append(batch.column(0)[start])
            texts.append(text)
            size += len(text)
            if size >= CHUNK_BYTES:
                yield keys, texts
                keys, texts, size = [], [], 0
    if texts:
        yield keys, texts


def _encoded(batches, path: str):
    """Keys, ids and decoded text, text by text."""
    encoder = Encoder(path)
    for keys, texts in _chunks(batches):
        yield keys, encoder.encode(texts), encoder.vocabulary


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids, decoded``: the ids of each text and the text they decode to."""
    rows = docs.select(*named(key=key, text=text))

    def run(batches):
        for keys, ids, vocabulary in _encoded(batches, path):
            for begin in range(0, len(keys), 100):
                some = ids[begin:begin + 100]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k.as_py() for k in keys[begin:begin + 100]], keys[0].type),
                     pa.array(some, pa.list_(pa.int32())),
                     pa.array([decode(i.tolist(), vocabulary.bytes_of) for i in some], pa.string())],
                    names=["key", "ids", "decoded"])

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"key {kind}, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256``: as ``encode``, hashed in the same task."""
    rows = docs.select(*named(key=key, text=text))

    def run(batches):
        for keys, ids, vocabulary in _encoded(batches, path):
            spelled = [str(i) for i in range(len(vocabulary.bytes_of))]
            out = []
            for one in ids:
                one = one.tolist()
                out.append((len(one), hashlib.sha256(",".join(map(spelled.__getitem__, one)).encode()).hexdigest(),
                            hashlib.sha256(decode(one, vocabulary.bytes_of).encode()).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.as_py() for k in keys], keys[0].type), pa.array([x[0] for x in out], pa.int64()),
                 pa.array([x[1] for x in out], pa.string()), pa.array([x[2] for x in out], pa.string())],
                names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
