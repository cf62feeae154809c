"""Repair of conversations whose turns are lost, empty, cut off, repeated or mislabelled.

Rows are edited at the least cost so that their roles read: at most one system turn, then
user and assistant by turns, ending with the assistant; or nothing.  Keep is free, another
role (user or assistant) costs 2, Delete 3, an empty turn put in 2, and each cut-off row
that stays 1 more; blank and repeated rows must go.  The edits' initials in order are the
audit; of the cheapest ones that with the least audit in ASCII order is taken.

The costs are a shortest path through (row, state), the state being the last role.  They
go backwards; then only arcs on shortest paths are left.  A node has one arc at most for
each initial, so the least audit of any length from a node leads to one node.  Nodes are
ranked by their least audits of length 1, 2, 4, ...: the rank for twice the length is that
of the pair (own rank, rank of the node the first half leads to), and pointers are doubled
with it.  The least path is read off by going through the doubled pointers.

A conversation may hold any share of all rows.  Rows are sorted over ranges of
(conversation, turn).  Conversations that lie inside a range and are short are repaired
there.  The others are cut into pieces of bounded size, each kept as one row.  Repeats are
found by an aggregate over digests.  A piece's costs are a 4 by 4 matrix from states before
it to states after it; matrices are multiplied up (minimum and sum), each piece finds its
least path for every state it may begin with, and the states are chained.  Only numbers of
pieces and, since they are the result, the audit and the digest's state of one conversation
are ever in one place; the digest goes over the pieces one after the other, as SHA-256 does.

Defined results: null roles and texts are one space; rows are in order of turn, null
first, equal turns by role and text; null is a conversation like any other; a
conversation none of whose rows is left has zeros, an empty audit and the digest of an
empty text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from keelson.llm.frames import named, shuffle_width
from keelson.session import materialize

#: Rows and characters of a piece; a longer conversation is cut.
PIECE_ROWS, PIECE_CHARS = 4096, 1 << 18
#: Rows of short conversations whose paths are ranked together.
TOGETHER = 4096

DELETE, KEEP_CUT, RENAME, INSERT = 3, 1, 2, 2
#: The last role: none yet, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that a renamed or inserted turn takes after each of them.
_NEXT = np.array([USER, USER, ASSISTANT, USER])
_NAMES = {USER: "user", ASSISTANT: "assistant"}
#: State after a kept row, by its initial (other, s, u, a) and the state before; -1: can't be kept.
_KEPT = np.array([[-1, -1, -1, -1], [SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1]])
#: Cost from each state at the end: what is still to be inserted.
_END = (0, 4, 2, 0)
_FAR = 1 << 40
_INITIALS = "DIKR"
_LEGAL = {"su", "ua", "au"}
_BLANKS = " \t\n\x0b\x0c\r"
#: A row's code: initial in the low two bits, then whether it must go, and whether it is cut off.
_GOES, _CUT = 4, 8


def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """``conv, turn, role, text, copies`` with a fifth of the rows damaged by a checksum of (conv, turn).

    Of twenty rows one is lost (0 copies), one empty, one without marks that end sentences,
    one doubled and one given to the user.
    """
    rows = conversations.select(*named(conv=conv, turn=turn, role=role, body=text))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")]
    rows = rows.withColumn("fate", F.crc32(F.concat(parts[0], F.lit(":"), parts[1]).cast("binary")) % 20)
    role_, body = (F.coalesce(c, F.lit(" ")) for c in ("role", "body"))
    return rows.select(
        "conv", F.col("turn").cast("long").alias("turn"),
        F.when(F.col("fate") == 4, "user").otherwise(role_).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace(body, "[.!?]", "")).otherwise(body).alias("text"),
        F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1).alias("copies"))


@dataclass
class Rows:
    """Consecutive rows of one conversation and what was found in them."""

    turns: list = field(default_factory=list)
    roles: list = field(default_factory=list)
    texts: list = field(default_factory=list)

    def add(self, turn, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            self.turns.append(turn)
            self.roles.append(role)
            self.texts.append(text)

    def digests(self) -> list[bytes]:
        """Equal for rows of equal role and text."""
        return [hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()[:20] for r, t in zip(self.roles, self.texts, strict=True)]

    def measure(self, earlier: set[bytes]) -> dict:
        """Codes of the rows, counts of faults, and what is needed to add up neighbours.

        ``earlier`` holds digests of rows before these; those of these rows are added.
        """
        codes, faults = bytearray(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for role, text, digest in zip(self.roles, self.texts, self.digests(), strict=True):
            ink = text.rstrip(_BLANKS)
            fault = "blank" if not ink else "duplicate" if digest in earlier else "truncated" if ink[-1] not in ".!?" else None
            earlier.add(digest)
            if fault:
                faults[fault] += 1
            codes.append(max("-sua".find(role[:1] or "-"), 0)
                         | (0 if fault in (None, "truncated") else _GOES) | (_CUT if fault == "truncated" else 0))
        initials = [r[:1] for r in self.roles]
        known = [t for t in self.turns if t is not None]
        return {"codes": bytes(codes), **faults,
                "illegal": sum(a + b not in _LEGAL for a, b in itertools.pairwise(initials)),
                "first_initial": initials[0] if initials else None, "last_initial": initials[-1] if initials else None,
                "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None,
                "n_turns": len(set(known))}

    def lines(self, audit: str, codes: bytes, state: int) -> list[str]:
        """The repaired turns that an audit makes of these rows, from a state on."""
        out, k = [], 0
        for edit in audit:
            if edit == "K":
                out.append(f"{self.roles[k]}:{self.texts[k]}")
                state = int(_KEPT[codes[k] & 3, state])
            elif edit in "RI":
                state = int(_NEXT[state])
                out.append(f"{_NAMES[state]}:{self.texts[k] if edit == 'R' else ''}")
            k += edit != "I"
        return out


def costs_to_go(codes: bytes, tail: tuple[int, ...]) -> np.ndarray:
    """Least cost from each state before each row, and after the last one (``tail``)."""
    out = np.empty((len(codes) + 1, 4), np.int64)
    after = list(tail)
    out[-1] = after
    following, kept_of = _NEXT.tolist(), _KEPT.tolist()
    for i in range(len(codes) - 1, -1, -1):
        code = codes[i]
        own = kept_of[code & 3]
        cut = KEEP_CUT if code & _CUT else 0
        here = []
        for s in range(4):
            cost = after[s] + DELETE
            if not code & _GOES:
                cost = min(cost, after[following[s]] + RENAME + cut)
                if own[s] >= 0:
                    cost = min(cost, after[own[s]] + cut)
            here.append(cost)
        # More turns may be put in before the row; three suffice to reach every state.
        for _ in range(3):
            here = [min(here[s], here[following[s]] + INSERT) for s in range(4)]
        after = here
        out[i] = here
    return out


def matrix(codes: bytes) -> list[int]:
    """Least costs from each state before these rows to each state after them, row by row."""
    ends = [tuple(0 if s == end else _FAR for s in range(4)) for end in range(4)]
    return np.minimum(np.stack([costs_to_go(codes, e)[0] for e in ends], axis=1), _FAR).ravel().tolist()


class LeastPaths:
    """Least audits through the rows of several pieces at once."""

    def __init__(self, pieces: list[tuple[bytes, tuple[int, ...], bool]]):
        """Of each piece: codes, the costs after it, and whether its conversation ends with it."""
        sizes = np.array([len(codes) + 1 for codes, _, _ in pieces])
        self.first = np.cumsum(sizes) - sizes
        cost = np.concatenate([costs_to_go(codes, tail) for codes, tail, _ in pieces])
        code = np.frombuffer(b"".join(codes + b"\0" for codes, _, _ in pieces), np.uint8)
        last = np.zeros(len(code), bool)
        last[self.first + sizes - 1] = True
        inside, stays = ~last[:, None], ((code & _GOES) == 0)[:, None]
        cut = ((code & _CUT) > 0).astype(np.int64)[:, None] * KEEP_CUT
        final = np.repeat([f for _, _, f in pieces], sizes)[:, None]
        row = np.arange(len(code))[:, None]
        state, kept = np.arange(4)[None, :], _KEPT[code & 3]
        below = np.minimum(row + 1, len(code) - 1) * 4
        arcs = (  # in the order of their initials: where to, at what cost, whether possible
            (below + state, DELETE, inside),
            (row * 4 + _NEXT[state], INSERT, inside | final),
            (below + np.maximum(kept, 0), cut, inside & stays & (kept >= 0)),
            (below + _NEXT[state], cut + RENAME, inside & stays),
        )
        flat = cost.ravel()
        targets = np.stack([np.broadcast_to(t, cost.shape).ravel() for t, _, _ in arcs])
        optimal = np.stack([np.broadcast_to(p & (cost == c + flat[t]), cost.shape).ravel() for t, c, p in arcs])
        self._rank(targets, optimal)

    def _rank(self, targets: np.ndarray, optimal: np.ndarray) -> None:
        nodes = np.arange(targets.shape[1])
        ends = ~optimal.any(axis=0)
        choice = optimal.argmax(axis=0)
        rank = np.where(ends, 0, choice + 1)
        hop = np.where(ends, nodes, targets[choice, nodes])
        self.hops = [hop]
        while not ends[hop].all():
            rank = np.unique(rank.astype(np.int64) * (int(rank.max()) + 1) + rank[hop], return_inverse=True)[1]
            hop = hop[hop]
            self.hops.append(hop)
        # Of a node's arcs on shortest paths: the one whose initial, and whose target's rank, is least.
        keys = np.where(optimal, np.arange(1, 5)[:, None] * (int(rank.max(initial=0)) + 1) + rank[targets], _FAR)
        self.label = np.where(ends, 0, keys.argmin(axis=0) + 1)

    def path(self, piece: int, state: int) -> tuple[str, int]:
        """The least audit of a piece from a state on, and the state it leads to."""
        path = np.array([self.first[piece] * 4 + state])
        for hop in self.hops:
            if self.label[path[-1]] == 0:
                break
            path = np.concatenate([path, hop[path]])
        if self.label[path[-1]]:
            path = np.append(path, self.hops[-1][path[-1]])
        steps = int((self.label[path] == 0).argmax())
        return "".join(_INITIALS[k - 1] for k in self.label[path[:steps]].tolist()), int(path[steps]) % 4


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
_PIECE = "range int, piece long, turns array<long>, roles array<string>, texts array<string>"


def _gaps(first, last, n_turns: int) -> int:
    return 0 if first is None else last - first + 1 - n_turns


def _repaired(group: list[tuple[object, Rows]]) -> list[tuple]:
    """Result rows of whole conversations."""
    found = [rows.measure(set()) for _, rows in group]
    paths = LeastPaths([(f["codes"], _END, True) for f in found])
    out = []
    for k, ((conv, rows), f) in enumerate(zip(group, found, strict=True)):
        audit, _ = paths.path(k, START)
        lines = rows.lines(audit, f["codes"], START)
        cost = int(costs_to_go(f["codes"], _END)[0][START])
        out.append((conv, _gaps(f["first_turn"], f["last_turn"], f["n_turns"]), f["blank"], f["duplicate"], f["truncated"],
                    f["illegal"], cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def _split(batches, kind) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a range to results of short conversations inside it, and pieces of the others."""
    kinds = [kind, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string(), pa.int32(), pa.int64(),
             pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string())]
    names = ["conv", *_COUNTS, "audit", "repaired_sha256", "range", "piece", "turns", "roles", "texts"]

    def emitted(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def piece() -> tuple:
        return (conv, *[None] * 8, range_, n_pieces, rows.turns, rows.roles, rows.texts)

    nothing = (None,) * 5
    conv, rows, chars, n_pieces, is_open, range_, waiting, begun = None, Rows(), 0, 0, True, None, [], False
    for batch in batches:
        out = []
        for r, c, turn, role, text, copies in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
            if not begun or c != conv:
                if begun and (is_open or n_pieces):
                    out.append(piece())
                elif begun:
                    waiting.append((conv, rows))
                # The range's first conversation may have begun in the range before.
                conv, rows, chars, n_pieces, is_open, range_, begun = c, Rows(), 0, 0, not begun, r, True
            rows.add(turn, role, text, copies)
            chars += (len(text) + len(role)) * copies
            if len(rows.roles) >= PIECE_ROWS or chars >= PIECE_CHARS:
                out.append(piece())
                rows, chars, n_pieces = Rows(), 0, n_pieces + 1
        if sum(len(x.roles) for _, x in waiting) >= TOGETHER:
            out += [(*x, *nothing) for x in _repaired(waiting)]
            waiting = []
        yield emitted(out)
    if waiting:
        yield emitted([(*x, *nothing) for x in _repaired(waiting)])
    if begun:
        # The last one may go on in the next range.
        yield emitted([piece()])


def _rows_of(batch: pa.RecordBatch) -> Iterator[Rows]:
    for turns, roles, texts in zip(*(batch.column(c).to_pylist() for c in ("turns", "roles", "texts")), strict=True):
        yield Rows(turns, roles, texts)


_AT = ["owner", "range", "piece"]


def _piece_digests(batches):
    """The distinct rows of each piece, by digest."""
    for batch in batches:
        found = [sorted(set(rows.digests())) for rows in _rows_of(batch)]
        take = pa.array(np.repeat(np.arange(batch.num_rows), [len(f) for f in found]))
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in _AT),
                                          pa.array(list(itertools.chain(*found)), pa.binary())], names=[*_AT, "digest"])


_MEASURED = ("owner string, range int, piece long, codes binary, blank long, duplicate long, truncated long, illegal long, "
             "first_initial string, last_initial string, first_turn long, last_turn long, n_turns long, matrix array<long>")


def _measured(batches):
    """Counts, codes and cost matrices of pieces, repeats of earlier pieces' rows known."""
    for batch in batches:
        out = []
        for rows, earlier in zip(_rows_of(batch), batch.column("earlier").to_pylist(), strict=True):
            found = rows.measure(set(earlier or ()))
            out.append(found | {"matrix": matrix(found["codes"])})
        # Field order is that of the schema above.
        own = pa.array(out, pa.struct([
            ("codes", pa.binary()), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")],
            ("first_initial", pa.string()), ("last_initial", pa.string()),
            *[(c, pa.int64()) for c in ("first_turn", "last_turn", "n_turns")], ("matrix", pa.list_(pa.int64()))]))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _AT), *own.flatten()],
                                         names=[*_AT, *(f.name for f in own.type)])


def _totals(group: pd.DataFrame) -> pd.DataFrame:
    """Of one conversation's pieces: costs after each of them; with the first one, the sums of all."""
    group = group.sort_values(["range", "piece"], ignore_index=True)
    tail, tails = np.array(_END), []
    for k in range(len(group) - 1, -1, -1):
        tails.append(tail.tolist())
        # The last piece's own end allows insertions after its last row; its matrix ends before them.
        tail = (np.array(group["matrix"][k], np.int64).reshape(4, 4) + tail[None, :]).min(axis=1)
    full = group[group["first_initial"].notna()]
    seams = sum(a + b not in _LEGAL for a, b in zip(full["last_initial"][:-1], full["first_initial"][1:], strict=True))
    dated = group[group["first_turn"].notna()]
    shared = sum(a == b for a, b in zip(dated["last_turn"][:-1], dated["first_turn"][1:], strict=True))
    first = [True] + [False] * (len(group) - 1)
    sums = {"gaps": _gaps(int(dated["first_turn"].iloc[0]), int(dated["last_turn"].iloc[-1]),
                          int(dated["n_turns"].sum()) - shared) if len(dated) else 0,
            **{c: int(group[c].sum()) for c in ("blank", "duplicate", "truncated")},
            "illegal": int(group["illegal"].sum()) + seams, "cost": int(tail[START])}
    out = group[_AT].assign(tail=tails[::-1], final=first[::-1])
    for c, total in sums.items():
        out[c] = pd.array([total] + [None] * (len(group) - 1), "Int64")
    return out


def _piece_paths(batches):
    """For each state a piece may begin with: its least audit and the state after it."""
    for batch in batches:
        codes, tails, finals = (batch.column(c).to_pylist() for c in ("codes", "tail", "final"))
        found = []
        if codes:
            paths = LeastPaths(list(zip(codes, map(tuple, tails), finals, strict=True)))
            found = [[paths.path(k, s) for s in range(4)] for k in range(len(codes))]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in _AT), pa.array([[a for a, _ in f] for f in found], pa.list_(pa.string())),
             pa.array([[s for _, s in f] for f in found], pa.list_(pa.int32())), batch.column("codes")],
            names=[*_AT, "audits", "exits", "codes"])


def _chained(group: pd.DataFrame) -> pd.DataFrame:
    """The state each piece of one conversation begins with."""
    group = group.sort_values(["range", "piece"], ignore_index=True)
    state, entries = START, []
    for exits in group["exits"]:
        entries.append(state)
        state = int(exits[state])
    return group[_AT].assign(entry=entries)


def _written(batches):
    """Repaired turns of each piece, as one text; null if there are none."""
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("audit", "codes", "entry"))
        lines = [rows.lines(a, c, e) for rows, a, c, e in zip(_rows_of(batch), *columns, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in _AT), pa.array(["\n".join(x) if x else None for x in lines], pa.string())],
            names=[*_AT, "lines"])


def _hashed(batches):
    """Pieces in order of conversation to its digest; only its state is held."""
    owner, digest, some = None, None, False

    def emitted(rows):
        return pa.RecordBatch.from_arrays([pa.array([o for o, _ in rows], pa.string()), pa.array([d for _, d in rows], pa.string())],
                                          names=["owner", "repaired_sha256"])
    for batch in batches:
        out = []
        for here, lines in zip(batch.column("owner").to_pylist(), batch.column("lines").to_pylist(), strict=True):
            if here != owner:
                if owner is not None:
                    out.append((owner, digest.hexdigest()))
                owner, digest, some = here, hashlib.sha256(), False
            if lines is not None:
                digest.update((("\n" if some else "") + lines).encode())
                some = True
        yield emitted(out)
    yield emitted([(owner, digest.hexdigest())] if owner is not None else [])


def _whole(pieces: DataFrame) -> DataFrame:
    """Results of conversations that lie in pieces."""
    width = shuffle_width(pieces.sparkSession)
    pieces = pieces.withColumn("owner", F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("null")))
    texts = pieces.select(*_AT, "turns", "roles", "texts")
    at = "owner string, range int, piece long"
    # A digest has one row for each piece it occurs in; the first of them does not count it as a repeat.
    digests = materialize(texts.mapInArrow(_piece_digests, f"{at}, digest binary"), "digests")
    first = digests.groupBy("owner", "digest").agg(F.min(F.struct("range", "piece")).alias("first"))
    earlier = digests.join(first.hint("merge"), ["owner", "digest"]).filter(
        F.struct("range", "piece") > F.col("first")).groupBy(*_AT).agg(F.collect_list("digest").alias("earlier"))
    measured = materialize(texts.join(earlier.hint("merge"), _AT, "left").mapInArrow(_measured, _MEASURED), "measured")
    longs = ", ".join(f"{c} long" for c in _COUNTS)
    # As text: pandas would read long numbers beside nulls as doubles.
    turns = {c: F.col(c).cast("string") for c in ("first_turn", "last_turn")}
    totals = materialize(measured.drop("codes").withColumns(turns).groupBy("owner").applyInPandas(
        _totals, f"{at}, tail array<long>, final boolean, {longs}"), "totals")
    paths = materialize(
        measured.select(*_AT, "codes").join(totals.select(*_AT, "tail", "final").hint("merge"), _AT)
        .mapInArrow(_piece_paths, f"{at}, audits array<string>, exits array<int>, codes binary"), "paths")
    chained = paths.select(*_AT, "exits").groupBy("owner").applyInPandas(_chained, f"{at}, entry int")
    chosen = materialize(paths.join(chained.hint("merge"), _AT).select(
        *_AT, "codes", "entry", F.expr("audits[entry]").alias("audit")), "chosen")
    lines = texts.join(chosen.hint("merge"), _AT).mapInArrow(_written, f"{at}, lines string")
    digest = lines.repartition(width, "owner").sortWithinPartitions(*_AT).mapInArrow(
        _hashed, "owner string, repaired_sha256 string")
    audit = chosen.groupBy("owner").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("range", "piece", "audit"))), lambda x: x.audit), "").alias("audit"))
    names = pieces.groupBy("owner").agg(F.first("conv").alias("conv"))
    return names.join(totals.filter("cost is not null").select("owner", *_COUNTS), "owner").join(
        audit, "owner").join(digest, "owner").select("conv", *_COUNTS, "audit", "repaired_sha256")


def repaired(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``conv, turn, role, text, copies``; see ``damaged``.

    ``gaps, blank, duplicate, truncated, illegal`` count what was found, ``cost`` and
    ``audit`` tell the edits, and ``repaired_sha256`` is the digest of the repaired turns.
    """
    field_ = rows.schema["conv"]
    kind = to_arrow_type(field_.dataType)
    order = ["conv", "turn", "role", "text"]
    # Long texts are told apart by their beginnings when ranges are cut: samples of them go to the driver.
    ranged = (rows.withColumn("begin", F.substring("text", 1, 32))
              .repartitionByRange(shuffle_width(rows.sparkSession), "conv", "turn", "role", "begin")
              .sortWithinPartitions(*order)
              .select(F.spark_partition_id().alias("range"), *order, "copies"))
    found = materialize(ranged.mapInArrow(
        lambda batches: _split(batches, kind), f"conv {field_.dataType.simpleString()}, {_RESULT}, {_PIECE}"), "repaired")
    inside = found.filter("piece is null").select("conv", *_COUNTS, "audit", "repaired_sha256")
    return inside.unionByName(_whole(found.filter("piece is not null").select("conv", "range", "piece", "turns", "roles", "texts")))
