import random

import pytest

#: Columns an operator may use inside; inputs of the tests carry them too.
CLASHING = ("key", "node", "n", "n_words", "token", "at", "hash", "size", "part", "failed", "range", "start", "list", "body")


@pytest.fixture(scope="session")
def rows_of(spark):
    """Builds ``doc_id, text`` with further columns of clashing names."""
    def build(rows, text="text"):
        extra = ", ".join(f"`{c}` string" for c in CLASHING)
        return spark.createDataFrame([(i, t, *["x"] * len(CLASHING)) for i, t in rows],
                                     f"doc_id long, {text} string, {extra}").repartition(3)
    return build


@pytest.fixture(scope="session")
def prose():
    """Invented texts with copies, near copies, shared passages, and every awkward case."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(300)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))
    base, passage, long = text(120), text(50), text(30_000)
    out = [(k, text(rng.randint(1, 200))) for k in range(40)]
    out += [(100 + k, base) for k in range(5)]
    for k in range(30):
        changed = base.split(" ")
        for _ in range(k % 6):
            changed[rng.randrange(len(changed))] = rng.choice(words)
        out.append((200 + k, " ".join(changed)))
    out += [(300 + k, f"{text(20)} {passage}\n{text(30)}") for k in range(4)]
    out += [(400, f"{passage} {text(3)} {passage}"), (401, long), (402, f"{long} {text(2)}")]
    out += [(k, text(k % 15 + 1)) for k in range(500, 530)] + [(530 + k, text(6)) for k in range(3)]
    short = text(9)
    out += [(540, short), (541, short), (542, short + " zz"), (543, short.upper())]
    out += [(600, None), (601, ""), (602, " \n\t "), (603, "\x0b\x0c"), (604, "é ß ç 日本 \U0001f600"),
            (605, "one"), (None, base), (None, None), (606, "same row"), (606, "same row"), (607, "!!! ### \n\n !!! ###")]
    return out
