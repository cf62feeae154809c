"""Prefix trie of conversations that are rebuilt from another one's head and their own rest.

A sequence of turns has a fingerprint in a monoid: joining two sequences of lengths ``m``
and ``n`` gives ``left * base**n + right`` modulo 2**64, in two lanes.  The product is
associative, so it is composed from parts and never from texts:

* a conversation's own prefixes are multiplied up within ranges of sorted turns, and the
  product that a range ends with is carried into the next one, so that a conversation
  with any share of all turns is spread over many tasks;
* a rebuilt prefix is the product of the base's head and of the own turns after the head,
  and the latter is the own prefix with its first turns divided out.

Rebuilt texts are never made.  A prefix row refers to the stored turn it ends with
(``turn_conv``, ``turn_at``) and carries 240 bits of that turn's SHA-256.  Rows of equal
depth and fingerprint are a node; a node is verified if all turns its rows refer to have
the same content and all rows have the same parent, which by induction makes all its
prefixes equal.  Should one fail, all is computed again with other bases.

Sums over subtrees need no walk down the trie.  A node belongs to its smallest member, so
a conversation's nodes are one piece of its path, down to its end.  Of a member of a node
that is not its smallest, the whole piece lies below the node; of the smallest, all of
its piece but the nodes above.  So a sum over a subtree is a sum over members, less one
running total.

Defined results: turns are in order of ``turn``, null first, equal ones in an order of
their content; a null role or text is empty; rows without a conversation id belong to
none and are left out; repeated rows are repeated turns; a conversation whose rebuilt
form has no turns is a member of the root only; an empty table gives no nodes, not even
a root.  A head is taken from a conversation that exists; of an absent one it is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.frames import named, shuffle_width, text_of
from keelson.operators.ranking import running_totals
from keelson.session import materialize

#: Ids joined to one piece of text before a node's digest is taken.
IDS_IN_PIECE = 4096
_ONES = (1 << 64) - 1
_CONTENT = ("ca", "cb", "cc", "cd")
NODE = ["depth", "fa", "fb"]


def bases(salt: int) -> tuple[int, int]:
    """The two lanes' bases, odd numbers."""
    found = hashlib.sha256(f"conversation prefixes {salt}".encode()).digest()
    return int.from_bytes(found[:8], "big") | 1, int.from_bytes(found[8:16], "big") | 1


def joined(left: tuple[int, int], right: tuple[int, int], n: int, salt: int = 0) -> tuple[int, int]:
    """Fingerprint of a sequence from those of its parts, of which the right one has ``n`` turns."""
    return tuple((a * pow(b, n, 1 << 64) + c) & _ONES for a, b, c in zip(left, bases(salt), right, strict=True))


def _powers(base: int, exponents: np.ndarray) -> np.ndarray:
    return np.power(np.uint64(base), exponents.astype(np.uint64))


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _unsigned(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """``conv, turn, ca, cb, cc, cd, words``: what is needed of each turn, its text left behind."""
    rows = conversations.select(*named(conv=conv, turn=turn, role=role, body=text)).filter("conv is not null")
    content = F.sha2(F.concat(F.length(text_of("role")).cast("string"), F.lit(":"), text_of("role"), text_of("body")), 256)
    lanes = [F.conv(F.substring(content, 1 + 15 * k, 15), 16, 10).cast("long").alias(c) for k, c in enumerate(_CONTENT)]
    return rows.select("conv", "turn", *lanes,
                       F.regexp_count(text_of("body"), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def _multiplied(batches, salt):
    """Sorted turns with their place in, and the product of, their conversation's turns of this range."""
    last, n, product = None, 0, [np.uint64(0)] * 2
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        conv = batch.column("conv")
        own = conv.dictionary_encode().indices.to_numpy()
        new = np.concatenate([[conv[0].as_py() != last], own[1:] != own[:-1]])
        starts = np.flatnonzero(new)
        goes_on = 0 if new[0] else n
        run = np.cumsum(new) - 1
        at = np.arange(1, rows + 1) + goes_on
        if len(starts):
            at = np.where(run < 0, at, np.arange(1, rows + 1) - starts[np.maximum(run, 0)])
        lanes = []
        for lane, (base, c) in enumerate(zip(bases(salt), _CONTENT[:2], strict=True)):
            inverse = pow(base, -1, 1 << 64)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(_unsigned(batch, c) * _powers(inverse, at))])
            before = product[lane] * _powers(inverse, np.array([goes_on]))[0]
            # What the sums held where the run began; a run that goes on began with the product so far.
            begin = np.where(run < 0, np.uint64(0) - before, sums[starts[np.maximum(run, 0)]] if len(starts) else np.uint64(0))
            lanes.append((sums[1:] - begin) * _powers(base, at))
        last, n, product = conv[rows - 1].as_py(), int(at[-1]), [x[-1] for x in lanes]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at), *map(_long, lanes)],
                                         names=[*batch.schema.names, "at", "pa", "pb"])


def _carries(ends: list, salt: int) -> dict[int, tuple]:
    """For each range that a conversation goes on into: ``conv, turns, product`` before it."""
    out, state = {}, None
    for row in sorted(ends, key=lambda r: r["range"]):
        n, product = row["last"]["at"], (row["last"]["pa"] & _ONES, row["last"]["pb"] & _ONES)
        if state is not None and state[0] == row["first"]:
            out[row["range"]] = state
            if row["first"] == row["conv"]:
                n, product = state[1] + n, joined(state[2], product, n, salt)
        state = (row["conv"], n, product)
    return out


def _carried(batches, carries, salt):
    """Products of ranges to products of conversations."""
    for batch in batches:
        at = batch.column("at").to_numpy().copy()
        lanes = [_unsigned(batch, c).copy() for c in ("pa", "pb")]
        ranges = batch.column("range").to_numpy()
        for r in np.unique(ranges).tolist():
            if r not in carries:
                continue
            conv, n, product = carries[r]
            hit = pa.compute.equal(batch.column("conv"), pa.scalar(conv, batch.column("conv").type)).to_numpy(
                zero_copy_only=False) & (ranges == r)
            for lane, base in zip(range(2), bases(salt), strict=True):
                lanes[lane][hit] += np.uint64(product[lane]) * _powers(base, at[hit])
            at[hit] += n
        rest = [batch.column(c) for c in ("conv", *_CONTENT, "words")]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(at), *map(_long, lanes)],
                                         names=["conv", *_CONTENT, "words", "at", "pa", "pb"])


def own_prefixes(rows: DataFrame, salt: int = 0) -> DataFrame:
    """``conv, ca, cb, cc, cd, words, at, pa, pb``: each turn's place and the product up to it."""
    kind = rows.schema["conv"].dataType.simpleString()
    order = ["conv", "turn", *_CONTENT, "read_at"]
    # The place of reading only parts repeated rows, so that any number of them is split over ranges.
    ranged = (rows.withColumn("read_at", F.monotonically_increasing_id())
              .repartitionByRange(shuffle_width(rows.sparkSession), *order).sortWithinPartitions(*order)
              .select("conv", *_CONTENT, "words", F.spark_partition_id().alias("range")))
    longs = ", ".join(f"{c} long" for c in (*_CONTENT, "words"))
    stored = materialize(ranged.mapInArrow(lambda b: _multiplied(b, salt),
                                           f"conv {kind}, {longs}, range int, at long, pa long, pb long"), "turns")
    last = F.max(F.struct("conv", "at", "pa", "pb"))
    # One row for each range.
    carries = _carries(stored.groupBy("range").agg(F.min("conv").alias("first"), last.alias("last")).select(
        "range", "first", "last.conv", "last").collect(), salt)
    return stored.mapInArrow(lambda b: _carried(b, carries, salt), f"conv {kind}, {longs}, at long, pa long, pb long")


def _rest(batches, salt):
    """Own turns after the head, to rows of rebuilt prefixes."""
    for batch in batches:
        beyond = batch.column("at").to_numpy() - batch.column("skip").to_numpy()
        lanes, parents = [], []
        for lane, base in zip("ab", bases(salt), strict=True):
            head, own, skipped = (_unsigned(batch, c + lane) for c in ("h", "p", "s"))
            # The head's product, moved up, and the own one with its first turns divided out.
            found = (head - skipped) * _powers(base, beyond) + own
            lanes.append(found)
            parents.append((found - _unsigned(batch, "c" + lane)) * np.uint64(pow(base, -1, 1 << 64)))
        depth = beyond + batch.column("head").to_numpy()
        rest = [batch.column(c) for c in ("conv", *_CONTENT, "words")]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(depth), *map(_long, (*lanes, *parents)), batch.column("conv"), batch.column("at"),
             pa.array(depth == batch.column("length").to_numpy())],
            names=["conv", *_CONTENT, "words", *NODE, "qa", "qb", "turn_conv", "turn_at", "ends"])


def rebuilt_prefixes(own: DataFrame, base: Column, head: Column, most: int, salt: int = 0) -> DataFrame:
    """One row for each prefix of each rebuilt conversation, the empty one included.

    ``base`` and ``head`` are made of the column ``conv``: whose first turns a conversation
    takes, and how many, at most ``most``.  Columns: ``conv``, the node (``depth, fa, fb``), its
    parent's fingerprint (``qa, qb``), content and words of the last turn, where that is
    stored (``turn_conv, turn_at``), and ``ends``, whether it is the whole conversation.
    """
    kind = own.schema["conv"].dataType.simpleString()
    held = ("pa", "pb", *_CONTENT, "words")
    firsts = [F.max(F.when(F.col("at") == j, F.col(c))).alias(f"{c}{j}") for j in range(1, most + 1) for c in held]
    known = materialize(own.groupBy("conv").agg(F.max("at").alias("n"), *firsts)
                        .withColumns({"base": base, "h": head.cast("long")}), "conversations")
    other = known.select(F.col("conv").alias("base"), F.col("n").alias("base_n"),
                         *[F.col(f"{c}{j}").alias(f"base_{c}{j}") for j in range(1, most + 1) for c in held])

    def product(name: str, length: str) -> Column:
        out = F.lit(0).cast("long")
        for j in range(1, most + 1):
            out = F.when(F.col(length) == j, F.col(f"{name}{j}")).otherwise(out)
        return out

    plan = known.join(other, "base", "left").withColumns({
        "head": F.least("h", F.coalesce("base_n", F.lit(0))), "skip": F.least("h", "n")}).withColumns({
            "length": F.col("head") + F.col("n") - F.col("skip"),
            "ha": product("base_pa", "head"), "hb": product("base_pb", "head"),
            "sa": product("pa", "skip"), "sb": product("pb", "skip")})
    plan = materialize(plan.select(
        "conv", "base", "head", "skip", "length", "ha", "hb", "sa", "sb", *[c for c in other.columns[2:]]), "rebuilt")
    nothing = F.lit(0).cast("long")
    heads = [F.struct(
        F.lit(j).cast("long").alias("depth"),
        *[(F.col(f"base_{c}{j}") if j else nothing).alias(name) for c, name in (
            ("pa", "fa"), ("pb", "fb"), *((c, c) for c in _CONTENT), ("words", "words"))],
        *[(F.col(f"base_{c}{j - 1}") if j > 1 else nothing).alias(name) for c, name in (("pa", "qa"), ("pb", "qb"))])
        for j in range(most + 1)]
    columns = ["conv", *_CONTENT, "words", *NODE, "qa", "qb", "turn_conv", "turn_at", "ends"]
    inside = plan.select("conv", "base", "length", F.explode(F.slice(F.array(*heads), F.lit(1), F.col("head").cast("int") + 1))
                         .alias("x")).select(
        "conv", "x.*", F.when(F.col("x.depth") > 0, F.col("base")).alias("turn_conv"),
        F.when(F.col("x.depth") > 0, F.col("x.depth")).alias("turn_at"),
        (F.col("x.depth") == F.col("length")).alias("ends")).select(columns)
    after = own.join(plan.select("conv", "head", "skip", "length", "ha", "hb", "sa", "sb").hint("merge"), "conv").filter("at > skip")
    longs = ", ".join(f"{c} long" for c in (*_CONTENT, "words", *NODE, "qa", "qb"))
    return inside.unionByName(after.mapInArrow(
        lambda b: _rest(b, salt), f"conv {kind}, {longs}, turn_conv {kind}, turn_at long, ends boolean"))


def _pieces(batches) -> Iterator[pa.RecordBatch]:
    """Sorted ``depth, fa, fb, conv`` to texts of some thousand ids each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        node = np.stack([batch.column(c).to_numpy() for c in NODE])
        new = np.flatnonzero(np.concatenate([[True], (node[:, 1:] != node[:, :-1]).any(axis=0)]))
        borders = sorted({*new.tolist(), *range(0, batch.num_rows, IDS_IN_PIECE)})
        ids = batch.column("conv").to_pylist()
        ends = [*borders[1:], batch.num_rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[k][borders]) for k in range(3)] + [
                batch.column("conv").take(pa.array(borders, pa.int64())),
                pa.array([",".join(map(str, ids[b:e])) for b, e in zip(borders, ends, strict=True)], pa.string())],
            names=[*NODE, "conv", "ids"])


def _digested(batches):
    """Pieces in order of node and id to one digest for each node; only its state is held."""
    node, digest = None, None
    for batch in batches:
        out = []
        for *here, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
            if here != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = here, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield _digest_rows(out)
    yield _digest_rows([(*node, digest.hexdigest())] if node is not None else [])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                                      names=[*NODE, "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node, ascending, joined by commas.

    A node's ids are sorted over ranges of (node, id) and joined to pieces there.  The
    digest itself goes over them one after the other, as SHA-256 does; the task that takes
    a node's pieces holds one of them at a time.
    """
    width = shuffle_width(ends.sparkSession)
    kind = ends.schema["conv"].dataType.simpleString()
    key = ", ".join(f"{c} long" for c in NODE)
    ranged = ends.select(*NODE, "conv").repartitionByRange(width, *NODE, "conv").sortWithinPartitions(*NODE, "conv")
    pieces = ranged.mapInArrow(_pieces, f"{key}, conv {kind}, ids string")
    return pieces.repartition(width, *NODE).sortWithinPartitions(*NODE, "conv").mapInArrow(
        _digested, f"{key}, ends_sha256 string")


def nodes_of(prefixes: DataFrame) -> tuple[DataFrame, int]:
    """One row for each node, and how many nodes hold unequal prefixes."""
    checked = [c for c in (*_CONTENT, "qa", "qb")]
    found = materialize(prefixes.groupBy(*NODE).agg(
        F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.max("words").alias("words"),
        *[F.min(c).alias(c) for c in checked], *[F.max(c).alias(f"most_{c}") for c in checked]), "nodes")
    unequal = " or ".join(f"{c} <> most_{c}" for c in checked)
    return found.drop(*[f"most_{c}" for c in checked]), found.filter(unequal).count()


def trie(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes with parents, children, leaves, saved words and the digest of what ends there.

    All but a node's parent is gathered by one aggregate over rows of the kind
    (node, what is to be added), so no node is too frequent for a task.
    """
    nothing = F.lit(None)
    kept = {"n_convs": "sum", "conv": "max", "parent": "max", "n_children": "sum", "n_leaves": "sum",
            "below": "sum", "above": "sum", "ends_sha256": "max"}
    kinds = {"conv": nodes.schema["conv"].dataType, "parent": nodes.schema["conv"].dataType, "ends_sha256": "string"}

    def rows(df: DataFrame, node: list[str], **given: str | Column) -> DataFrame:
        return df.select(*[F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for c, n in zip(node, NODE, strict=True)],
                         *[(F.expr(given[c]) if c in given else nothing).cast(kinds.get(c, "long")).alias(c) for c in kept])

    up = ["qa", "qb"]
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("fa").alias("qa"), F.col("fb").alias("qb"),
                           F.col("conv").alias("parent"))
    with_parent = nodes.join(parents.hint("merge"), ["depth", *up], "left")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *up).agg(F.count("*").alias("n"))
    saved = "(n_convs - 1) * words"
    # A conversation's piece of its path: its words saved, and whether it ends in a leaf.
    leaf = nodes.join(children.select("depth", F.col("qa").alias("fa"), F.col("qb").alias("fb")).hint("merge"), NODE, "left_anti")
    pieces = nodes.select("conv", F.expr(saved).alias("saved"), F.lit(0).alias("leaf")).unionByName(
        leaf.select("conv", F.lit(0).alias("saved"), F.lit(1).alias("leaf"))).groupBy("conv").agg(
        F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    members = prefixes.select("conv", *NODE).join(pieces.hint("merge"), "conv")
    shared = running_totals(nodes.filter("n_convs > 1").select("conv", *NODE, F.expr(saved).alias("saved")),
                            ["conv"], "depth", ["saved"])
    gathered = rows(with_parent, NODE, n_convs="n_convs", conv="conv", parent="parent") \
        .unionByName(rows(children, ["depth", *up], n_children="n")) \
        .unionByName(rows(members, NODE, n_leaves="leaf", below="saved")) \
        .unionByName(rows(shared, NODE, above="cum_saved - saved")) \
        .unionByName(rows(end_digests(prefixes.filter("ends")), NODE, ends_sha256="ends_sha256"))
    out = gathered.groupBy(*NODE).agg(*[(F.sum if how == "sum" else F.max)(c).alias(c) for c, how in kept.items()])
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
        # A lone member saves nothing, and its nodes have no running total.
        F.when(F.col("n_convs") > 1, F.col("below") - F.col("above")).otherwise(zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "fa", "fb")


def prefix_trie(conversations: DataFrame, base: Column, head: Column, most: int, **columns: str) -> DataFrame:
    """The trie of conversations that take their first turns from others; see ``rebuilt_prefixes``."""
    rows = turns(conversations, **columns)
    for salt in count():
        prefixes = materialize(rebuilt_prefixes(own_prefixes(rows, salt), base, head, most, salt), "prefixes")
        nodes, unequal = nodes_of(prefixes)
        if not unequal:
            return trie(prefixes, nodes)


def stride_base(stride: int) -> Column:
    """The conversation whose id is the largest multiple of ``stride`` towards zero."""
    return F.col("conv") - F.col("conv") % stride


def checksum_head(lengths: int) -> Column:
    """A head length below ``lengths``, drawn by a checksum of the id."""
    return F.crc32(F.col("conv").cast("string").cast("binary")) % lengths
