"""Repairs against cheapest edits found by trying all of them, row by row."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from keelson.llm import repair

WORD = re.compile(r"[^\x20\x09-\x0D]")
KIND = "conv_id long, turn long, role string, text string, range string, piece string, owner string, copies string, audit string"
#: Role initial put after each state, and the states a kept row leads to.
PUT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", "y", "z", "q", "r") for r in rows], KIND).repartition(parts)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if fate == 4 else role
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired turns) with the least audit, over all edits of ``(role, text, fault)``."""
    def settle(best):
        # Insertions before the next row.
        for _ in range(4):
            for state, (cost, audit, lines) in list(best.items()):
                put = PUT[state]
                more = (cost + 2, audit + "I", [*lines, f"{NAMES[put]}:"])
                if put not in best or more[:2] < best[put][:2]:
                    best[put] = more
        return best
    best = settle({"": (0, "", [])})
    for role, text, fault in rows:
        after = {}

        def offer(state, entry, after=after):
            if state not in after or entry[:2] < after[state][:2]:
                after[state] = entry
        extra = fault == "truncated"
        for state, (cost, audit, lines) in best.items():
            offer(state, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            put = PUT[state]
            offer(put, (cost + 2 + extra, audit + "R", [*lines, f"{NAMES[put]}:{text}"]))
            initial = role[:1]
            if (initial == "s" and state == "") or (initial == "u" and state != "u") or (initial == "a" and state == "u"):
                offer(initial, (cost + extra, audit + "K", [*lines, f"{role}:{text}"]))
        best = settle(after)
    return min((best[s] for s in ("", "a") if s in best), key=lambda b: b[:2])


def brute_force(rows, damaged=None):
    out = []
    convs = {r[0] for r in rows}
    left = damage(rows) if damaged is None else damaged
    for conv in convs:
        own = sorted((r[1:] for r in left if r[0] == conv),
                     key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in own:
            ink = WORD.findall(text)
            faults.append("blank" if not ink else "duplicate" if (role, text) in seen
                          else "truncated" if ink[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in {"su", "ua", "au"} for a, b in itertools.pairwise(own))
        cost, audit, lines = cheapest([(r, t, f) for (_, r, t), f in zip(own, faults, strict=True)])
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, parts=3):
    return sorted(map(tuple, repair.repaired(repair.damaged(table(spark, rows, parts))).collect()), key=repr)


def conversations(seed, n, longest=12):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t", "Done.  ", "é…", "two\nlines."]
    out = []
    for c in range(n):
        roles = rng.choice([["user", "assistant"], ["system", "user", "assistant", "tool", ""]])
        turn = rng.randrange(3)
        for k in range(rng.randrange(longest)):
            role = ["user", "assistant"][k % 2] if rng.random() < 0.6 else rng.choice(roles)
            out.append((c, turn, role, f"{rng.choice(texts)}" if rng.random() < 0.5 else f"{rng.randrange(30)}{rng.choice(texts)}"))
            turn += rng.choice([0, 1, 1, 1, 3])
    return out


AWKWARD = [(None, 0, "user", "a."), (None, None, "assistant", None), (500, None, None, None), (500, None, "user", "x."),
           (500, 3, "user", "x."), (500, 3, "user", "x."), (500, 2**60, "assistant", "y" * 50_000), (501, 7, "system", "only."),
           (502, 1, "s", "a."), (502, 2, "u", "b."), (502, 3, "a", "c.")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_edits(spark, seed):
    rows = conversations(seed, 120) + AWKWARD
    assert found(spark, rows) == brute_force(rows)


@pytest.mark.parametrize(("rows_each", "width"), [(1, "7"), (3, "2"), (4, "25")])
def test_pieces_make_no_difference(spark, monkeypatch, rows_each, width):
    """Every conversation in pieces of a few rows; one holds most of all rows."""
    monkeypatch.setattr(repair, "PIECE_ROWS", rows_each)
    rows = conversations(5, 25) + AWKWARD
    rows += [(900, k, ["user", "assistant", "assistant"][k % 3], f"{k % 40}.") for k in range(150)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        assert found(spark, rows) == brute_force(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_least_paths_of_random_rows():
    rng = random.Random(3)
    group, expected = [], []
    for _ in range(400):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), f"{k}{rng.choice('.x')}") for k in range(rng.randrange(9))]
        own = repair.Rows(list(range(len(rows))), [r for r, _ in rows], [t for _, t in rows])
        group.append((0, own))
        expected.append(cheapest([(r, t, None if t[-1] == "." else "truncated") for r, t in rows]))
    got = repair._repaired(group)
    assert [(r[6], r[7]) for r in got] == [e[:2] for e in expected]


def test_a_matrix_is_the_product_of_its_parts():
    rng = random.Random(6)
    for _ in range(50):
        codes = bytes(rng.choice([0, 1, 2, 3, 4, 9, 10, 11]) for _ in range(rng.randrange(12)))
        cut = rng.randrange(len(codes) + 1)
        whole, left, right = (repair.np.array(repair.matrix(c)).reshape(4, 4) for c in (codes, codes[:cut], codes[cut:]))
        product = (left[:, :, None] + right[None]).min(axis=1)
        assert (repair.np.minimum(product, repair._FAR) == whole).all()


def test_ties_go_to_the_least_audit():
    # Drop the second user turn, or put an assistant turn before it: both D and I cost more than renaming.
    assert cheapest([("user", "a.", None), ("user", "b.", None)])[1] == repair._repaired(
        [(0, repair.Rows([0, 1], ["user", "user"], ["a.", "b."]))])[0][7]
    # A lone user turn can be answered (2) or deleted (3).
    assert repair._repaired([(0, repair.Rows([0], ["user"], ["a."]))])[0][6:8] == (2, "KI")


def test_empty_table_and_all_rows_lost(spark):
    assert found(spark, []) == []
    lost = [(c, 0, "user", "x.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    empty = hashlib.sha256(b"").hexdigest()
    assert lost
    assert {r[1:] for r in found(spark, lost)} == {(0, 0, 0, 0, 0, 0, "", empty)}
