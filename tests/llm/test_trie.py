"""The trie against one built turn by turn."""

import hashlib
import random
import re
import zlib

import pytest

from keelson.llm import trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KIND = "conv_id long, turn long, role string, text string, depth string, fa string, range string, at string, base string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", "y", "z", "a", "b") for r in rows], KIND).repartition(parts)


def content(role, text):
    """Ties of a turn go by content, as the operator's do."""
    found = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
    return [int(found[15 * k:15 * k + 15], 16) for k in range(4)]


def brute_force(rows, stride=20, lengths=4):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, content(role or "", text or ""), role or "", text or ""))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    nodes = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % lengths
        base = c - (abs(c) % stride) * (1 if c > 0 else -1)
        whole = turns.get(base, [])[:h] + own[h:]
        for d in range(len(whole) + 1):
            node = nodes.setdefault(tuple(whole[:d]), {"members": [], "ends": []})
            node["members"].append(c)
            if d == len(whole):
                node["ends"].append(c)
    out = []
    for path, node in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[:len(p)] == p and len(q) > len(p) for q in below)]
        saved = sum((len(nodes[p]["members"]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p)
        out.append((min(node["members"]), len(path), min(nodes[path[:-1]]["members"]) if path else None,
                    len(node["members"]), len(children), len(leaves), saved,
                    hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, parts=3):
    df = trie.prefix_trie(table(spark, rows, parts), trie.stride_base(20), trie.checksum_head(4), 3)
    return sorted((tuple(r)[:8] for r in df.collect()), key=repr)


def conversations(seed, n, longest=9):
    rng = random.Random(seed)
    heads = [("user", f"hello {k} there") for k in range(3)]
    out = []
    for c in rng.sample(range(-30, 200), n):
        turns = [rng.choice(heads)] if rng.random() < 0.7 else []
        turns += [(rng.choice(["user", "assistant"]), f"w{rng.randrange(4)} x " * rng.randrange(3)) for _ in range(rng.randrange(longest))]
        out += [(c, k, *t) for k, t in enumerate(turns)]
    copied = [r for r in out if r[0] % 7 == 0]
    return out + [(c + 1000, *rest) for c, *rest in copied] + [(c + 1020, *rest) for c, *rest in copied if rest[0] < 3]


AWKWARD = [(1, None, None, None), (1, None, "user", ""), (1, 2, "user", "same"), (1, 2, "user", "same"), (1, 2, "", "é  ß\x0b"),
           (None, 1, "user", "no id"), (20, 0, "user", "hi"), (21, 0, "user", "hi"), (22, 5, "user", "hi"), (40, 1, None, "hi"),
           (41, 0, "user", "long " * 40_000), (61, 0, "user", "long " * 40_000), (61, 1, "a", "b:c"), (41, 1, "a:b", "c")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_turn_by_turn(spark, seed):
    rows = conversations(seed, 60) + (AWKWARD if seed == 1 else [])
    assert found(spark, rows) == brute_force(rows)


def test_a_conversation_over_many_ranges(spark):
    """One conversation holds most turns, and many are copies of it."""
    long = [(7, k, "user", f"turn {k % 5}") for k in range(300)]
    copies = [(c, k, "user", f"turn {k % 5}") for c in (27, 47, 80) for k in range(40)]
    rows = long + copies + conversations(3, 20)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert found(spark, rows) == brute_force(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_table_and_lone_root(spark):
    assert found(spark, []) == []
    rows = [(c, 0, "user", "x") for c in range(3, 6) if zlib.crc32(str(c).encode()) % 4 > 0]
    assert rows
    assert found(spark, rows) == brute_force(rows)


def test_products_compose():
    rng = random.Random(9)
    turns = [(rng.getrandbits(60), rng.getrandbits(60)) for _ in range(12)]
    whole = (0, 0)
    for t in turns:
        whole = trie.joined(whole, t, 1)
    for cut in range(13):
        parts = []
        for part in (turns[:cut], turns[cut:]):
            product = (0, 0)
            for t in part:
                product = trie.joined(product, t, 1)
            parts.append(product)
        assert trie.joined(*parts, 12 - cut) == whole


def test_unequal_prefixes_of_one_node_are_noticed(spark):
    """Fingerprints that are all equal make nodes of unequal prefixes; those are counted."""
    rows = [(c, k, "user", f"{(c * 7 + k) % 5}" if k < 3 else "last") for c in range(5) for k in range(4)]
    own = trie.own_prefixes(trie.turns(table(spark, rows)))
    prefixes = trie.rebuilt_prefixes(own, trie.stride_base(20), trie.checksum_head(4), 3)
    assert trie.nodes_of(prefixes)[1] == 0
    lost = prefixes.withColumns({"fa": trie.F.lit(1).cast("long"), "fb": trie.F.lit(1).cast("long")})
    assert trie.nodes_of(lost)[1] > 0


def test_ids_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "IDS_IN_PIECE", 3)
    rows = [(0, 0, "user", "hi")] + [(c, 0, "user", "hi") for c in range(1, 90)]
    assert found(spark, rows) == brute_force(rows)
