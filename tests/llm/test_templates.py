"""Items found verbatim and re-parameterised; ordinary texts left alone."""

import pytest

from keelson.llm import templates

ITEM = "Yesterday morning Alice walked 12 miles to the old market and bought 3 kg of apples before Alice walked home again"
OTHER = "in which of the following years did the northern kingdom sign the treaty that ended the long war"


def find(spark, texts, items):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, node string, item int")
    bench = spark.createDataFrame([(k, t, "x") for k, t in enumerate(items)], "item_id long, text string, hash string")
    kept = templates.clean(docs, bench)
    assert kept.columns == docs.columns
    found = {(r["key"], r["item"]): (r["run"], r["slots"], r["same_values"]) for r in templates.contaminated(docs, bench).collect()}
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {k for k, _ in found}
    return found


def test_copies_and_variants(spark):
    variant = ITEM.replace("Alice", "Robert").replace("12", "7.5").replace("miles", "km").replace("3", "40")
    crossed = variant.replace("before Robert", "before Maria")
    noisy = " ".join(f"{w}###" for w in OTHER.upper().split())
    texts = [f"Some words first. {ITEM}. And some after.", variant, crossed, f"a b c {noisy} d", None, "", "nothing of it",
             OTHER, OTHER, " ".join(OTHER.split()[:11]), "x " * 20_000 + OTHER + " y" * 20_000]
    found = find(spark, texts, [ITEM, OTHER, None, "", "too short", OTHER])
    assert {k for k, i in found if i == 0} == {0, 1}
    assert found[0, 0][2] is True
    assert found[1, 0][2] is False
    assert found[1, 0][1] == 6
    assert {k for k, i in found if i == 1} == {k for k, i in found if i == 5} == {3, 7, 8, 10}


def test_short_items(spark):
    found = find(spark, ["we ask what is the capital of france today", "what is the capital"], ["what is the capital of france"])
    assert set(found) == {(0, 0)}


def test_at_every_offset(spark):
    words = OTHER.split()[:12]
    texts = ["z " * k + " ".join(words) + " q" * (5 - k % 5) for k in range(12)]
    assert {k for k, _ in find(spark, texts, [OTHER])} == set(range(12))


def test_empty_tables(spark):
    assert find(spark, [], [OTHER]) == {}
    assert find(spark, [OTHER], []) == {}


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, OTHER)], "doc_id long, text string")
    plan = templates.contaminated(docs, spark.createDataFrame([(1, OTHER)], "item_id long, text string"))
    assert "Python" not in plan._jdf.queryExecution().toString()


@pytest.mark.parametrize(("text", "words"), [
    ("then Bob paid $5.50 or 12 kg", ["then", "\x01pbob", "paid", "\x01n550", "or", "\x01n12", "\x01ukg"]),
    ("Start is no name; UPPER neither", ["start", "is", "no", "name", "upper", "neither"]), ("  ", []), ("...", [])])
def test_placeholders(spark, text, words):
    df = spark.createDataFrame([(text,)], "t string").select(templates.words_of(templates.slots_marked(templates.F.col("t"))).alias("w"))
    assert df.first().w == words


TRAIN = "A train travels 60 km in 2 hours, 90 km in 3 hours, how far in 5 hours?"


def test_number_rich_copies_at_every_offset(spark):
    texts = ["z " * k + TRAIN + " q" * (5 - k % 5) for k in range(12)]
    assert {k for k, _ in find(spark, texts, [TRAIN])} == set(range(12))


def test_verbatim_copies_of_every_item(spark):
    items = ["What is 12 times 7?", "3 x 4?", "Alice has 5 apples and eats 2, how many are left?", "Anna Berg, Carl Dorn, Emil Falk, who is 9?"]
    texts = [f"{before} {i} {after}" for i in items for before in ("z", "we ask", "so Tom asks: z", "He asked Jim") for after in ("", "Yes")]
    found = find(spark, [*texts, *map(str.upper, items), *map(str.lower, items), "What is 13 times 8?"], items)
    want = {(k, k // 8) for k in range(32)} | {(32 + k, k % 4) for k in range(8)}
    assert set(found) == want


def test_other_names_wherever_they_stand(spark):
    pens = "Tom buys 3 pens. Sara buys 5 pens. How many pens do they have in total?"
    apples = "Alice has 5 apples and eats 2, how many are left?"
    pairs = [(pens.replace("Tom", "Jim").replace("Sara", "Ann"), 0), (pens.replace("Tom", "TIM").replace("Sara", "Mary Jane O'Brien"), 0),
             (pens.replace("Tom", "J. Smith").replace("3", "7"), 0), (apples.replace("Alice", "Maria"), 1),
             ("In 2020 " + apples.replace("Alice", "Anna Berg"), 1), ("we ask " + apples.replace("Alice", "Maria"), 1),
             ("Suppose " + ITEM.removeprefix("Yesterday morning ").replace("Alice", "Robert"), 2)]
    found = find(spark, [t for t, _ in pairs], [pens, apples, ITEM.removeprefix("Yesterday morning ")])
    assert set(found) == {(k, i) for k, (_, i) in enumerate(pairs)}


def test_windows_of_texts_equal_those_of_items(spark):
    texts = spark.createDataFrame([(k, [f"w{j % 5}" for j in range(n)]) for k, n in enumerate((0, 1, 6, 7, 8, 40))],
                                  "node int, words array<string>")
    for window, stride in ((7, 1), (3, 1), (7, 6)):
        own = texts.select("node", templates.F.explode(templates.windows(templates.F.col("words"), window, stride)).alias("w"))
        want = sorted((r["node"], r["w"]["at"], r["w"]["hash"]) for r in own.collect())
        assert sorted(map(tuple, templates.texts_windows(texts, window, stride).collect())) == want
