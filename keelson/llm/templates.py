"""Benchmark decontamination by templates: finds questions also where they were re-parameterised.

Two views of a text are searched.  The template: numbers, names and units become typed
placeholders, words lose case and punctuation.  A name is a capitalised word after a
lower-case letter, comma or semicolon, or one that no item writes in lower case; names
that follow one another are one placeholder.  And the plain words, without placeholders, so
that verbatim copies of every item are found, whatever its length and its words.

Every window of an item is hashed.  Windows of a template count only if most of their words
are literal, so all windows of a document's template are hashed too.  Of plain words, where
all windows of an item count, every ``stride``-th of a document is enough, since a
shared run of ``window + stride - 1`` words holds one of them whole.  Equal hashes give
candidates: a document, an item and how they lie against each other.  Those are laid
side by side and measured: the longest run of equal words, and whether the placeholders
are filled consistently, that is, equal values of the item stand for equal values of
the document.

All of it is DataFrame expressions.  The windows of the benchmark are broadcast up to
``frames.BROADCAST_ROWS`` counted rows, else joined by shuffle; so are the candidate texts.
The benchmark's lower-case words are brought to the driver, as a set to look names up in.

Defined results: null and empty texts and items match nothing; equal texts get equal
findings; an item with fewer than ``LEAST_WORDS`` words or without ``window`` words of
which most are literal is too unspecific for its template to be searched for, and only its
verbatim copies are found; repeated items are found under each of their ids; empty tables
give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.frames import named, small_side, text_of
from keelson.session import materialize

WINDOW, STRIDE = 7, 6
#: A template of fewer words than this is no question.
LEAST_WORDS = 5
#: At least so many words of a window are literal.
LEAST_LITERAL = 4

#: Fixed value: unit words that count as such after a number.
UNITS = ("kg|g|mg|lb|lbs|oz|km|m|cm|mm|mi|miles?|feet|foot|ft|inch(?:es)?|yards?|l|ml|liters?|litres?|gallons?|"
         "s|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|months?|years?|percent|dollars?|euros?|cents?|pounds?|"
         "degrees?|meters?|metres?|grams?|kilometers?|kilograms?")
#: Fixed value: words that often start a sentence and are no names.
OPENERS = frozenset(
    "a about after again all also although an and another any are as at because before both but by can could did do does "
    "during each either every few find first for from give given had has have he her here his how however i if in into is "
    "it its last later let many may most much my next no not now of on once one only or other our over she should show so "
    "some such that the their then there these they this those to today tomorrow tonight two under until use using was we "
    "were what when where whether which while who whom whose why will with would yesterday yet you your "
    "aber als am an auch auf aus bei das dass dem den der des die du ein eine einem einen einer er es für hat ich ihr im in "
    "ist ja man mit nach nicht noch nun oder sein sie sind so um und von vor wann warum was weil wenn wer werden wie wir wo "
    "zu zum zur au aux avec ce ces cette chaque combien comme dans de des donc du elle en est et il ils je la le les leur "
    "mais nous on ou où par pas pour quand que quel quelle qui sa se ses si son sont sur un une vous al algo como con "
    "cuando cuánto cuántos de del dos el ella en entre es esta este fue ha hay la las lo los más no o para pero por qué "
    "quién se si sin sobre su sus todo un una y ya".split())
_MARK = "\x01"
_DOUBT = "q"
_START = "\x02"
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~“”‘’„«»…–—¿¡"
_SPACE = r"[ \t\n\x0B\f\r]+"


def _names_marked(text: Column, known: list[str] | None) -> Column:
    """Names with their mark; with ``known`` words also those that start a text, sentence or line, and those in capitals."""
    after = F.regexp_replace(text, r"(?<=[\p{Ll},;] )(\p{Lu}\p{Ll}[\p{L}’'-]*)", f"{_MARK}p$1")
    if known is None:
        return after
    # A word in doubt is marked at its start too, so that only such words are looked up, not all.
    doubtful = F.regexp_replace(after, r"(?<!\S)([^\p{L}\p{N}\s\x01]*)(\p{Lu})", f"{_START}$1{_MARK}{_DOUBT}$2")

    def settled(part: Column) -> Column:
        word = F.regexp_extract(part, r"^\S*", 0)
        plain = F.translate(F.lower(word), _PUNCTUATION + _MARK, "")
        return F.when(F.instr(part, _MARK + _DOUBT) == 0, F.concat(F.lit(_START), part)).when(
            F.substring(plain, 2, 1 << 20).isin(known), F.regexp_replace(part, _MARK + _DOUBT, "")).otherwise(
            F.regexp_replace(part, _MARK + _DOUBT, f"{_MARK}p"))
    parts = F.split(doubtful, _START)
    words = F.array_join(F.transform(parts, lambda part, k: F.when(k == 0, part).otherwise(settled(part))), "")
    return F.regexp_replace(words, rf"(\x01p(?:[\p{{L}}’'-]+|\p{{Lu}}\.)){_SPACE}(?=\x01p)", "$1")


def slots_marked(text: Column, known: list[str] | None = None) -> Column:
    """The text in template words, where a placeholder still carries its value."""
    named_ = _names_marked(text, known)
    numbered = F.regexp_replace(named_, r"(?<!\S)([$€£]?\d\S*)", f"{_MARK}n$1")
    measured = F.regexp_replace(numbered, rf"({_MARK}n\S*\s+)((?:{UNITS})(?![\p{{L}}\p{{N}}]))", f"$1{_MARK}u$2")
    return F.translate(F.lower(measured), _PUNCTUATION, "")


def known_words(items: DataFrame, text: str = "text") -> list[str]:
    """Words that start a sentence without being names: those the items write in lower case, and ``OPENERS``."""
    words = items.select(F.explode(F.split(text_of(text), _SPACE)).alias("w")).filter(
        F.col("w").rlike(r"^[^\p{L}\p{N}]*\p{Ll}")).select(F.translate(F.lower("w"), _PUNCTUATION, "").alias("w"))
    return sorted(OPENERS | {r["w"] for r in words.distinct().collect()})


def plain_words(text: Column) -> Column:
    """Words without case and punctuation."""
    return words_of(F.translate(F.lower(text), _PUNCTUATION, ""))


def words_of(marked: Column) -> Column:
    trimmed = F.regexp_replace(marked, rf"^{_SPACE}|{_SPACE}$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE))


def without_values(marked: Column) -> Column:
    return F.regexp_replace(marked, rf"({_MARK}.)\S*", "$1")


def windows(words: Column, window: int, stride: int) -> Column:
    """``at, hash`` of every ``stride``-th window."""
    starts = F.when(F.size(words) >= window, F.sequence(F.lit(0), F.size(words) - window, F.lit(stride)))
    return F.transform(starts, lambda i: F.struct(
        i.alias("at"), F.xxhash64(F.slice(words, i + 1, F.lit(window))).alias("hash")))


def texts_windows(texts: DataFrame, window: int, stride: int) -> DataFrame:
    """``node, at, hash`` of the windows of ``words``, the same as ``windows`` has.

    All windows are laid out as columns, a copy of the words for each place in them: compiled
    code hashes these, while ``windows`` cuts and hashes one after the other, uncompiled.
    """
    if stride > 1:
        return texts.select("node", F.explode(windows(F.col("words"), window, stride)).alias("w")).select(
            "node", F.col("w.at").alias("at"), F.col("w.hash").alias("hash"))
    n = F.greatest(F.size("words") - window + 1, F.lit(0))
    shifted = F.arrays_zip(*(F.slice("words", F.lit(k + 1), n).alias(f"w{k}") for k in range(window)))
    return texts.select("node", F.posexplode(shifted).alias("at", "w")).select(
        "node", "at", F.xxhash64(*(F.col(f"w.w{k}") for k in range(window))).alias("hash"))


def item_templates(items: DataFrame, known: list[str], item: str = "item_id", text: str = "text") -> DataFrame:
    marked = items.select(*named(item=item, body=text)).select(
        "item", slots_marked(text_of("body"), known).alias("marked"), plain_words(text_of("body")).alias("plain"))
    return marked.select("item", words_of(without_values(F.col("marked"))).alias("template"),
                         words_of(F.col("marked")).alias("filled"), "plain").filter(F.size("plain") > 0)


def _cut_once(texts: DataFrame) -> DataFrame:
    """``words`` as a column of their own, cut once and not for each window; a text without words has an empty one."""
    return texts.select("node", F.regexp_replace("text", rf"^{_SPACE}|{_SPACE}$", "").alias("text")).select(
        "node", F.split("text", _SPACE).alias("words"))


def _candidates(texts: DataFrame, items: DataFrame, window: int, stride: int, least_literal: int) -> DataFrame:
    """``node, item, shift`` of ``words`` in both: how far into the document the item would begin."""
    own = items.select("item", F.explode(windows(F.col("words"), window, 1)).alias("w"), "words")
    literal = F.size(F.filter(F.slice("words", F.col("w.at") + 1, window), lambda x: ~x.startswith(_MARK)))
    own = own.filter(literal >= min(least_literal, window)).select("item", F.col("w.at").alias("item_at"), F.col("w.hash").alias("hash"))
    found = texts_windows(texts, window, stride)
    return found.join(small_side(own), "hash").select(
        "node", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()


def _candidates_of_all(texts: DataFrame, items: DataFrame, window: int, least: int, stride: int, least_literal: int,
                       view: str) -> DataFrame:
    """Candidates of long items by windows, of each length of short ones by all their words."""
    own = items.withColumn("words", F.col(view))
    found = _candidates(texts, own.filter(F.size("words") >= least), window, stride, least_literal)
    lengths = [r[0] for r in own.filter(F.size("words") < least).select(F.size("words")).distinct().collect()]
    for length in sorted(lengths):  # fewer than ``least`` different lengths
        found = found.unionByName(_candidates(texts, own.filter(F.size("words") == length), length, 1, least_literal))
    return found.select("node", "item", "shift", F.lit(view == "plain").alias("plainly"))


def _node(text: str) -> Column:
    return F.unhex(F.md5(text_of(text)))


def findings(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
             item_text: str = "text", window: int = WINDOW, stride: int = STRIDE) -> DataFrame:
    """``node, item, run, slots, same_values``: per distinct text and item, the best laying.

    ``node`` is the MD5 of the text; ``run`` the longest stretch of equal template words;
    ``slots`` the placeholders in agreement.  Only consistent findings of a whole run.
    """
    texts = docs.select(*named(text=text)).select(_node("text").alias("node"), text_of().alias("text"))
    known = known_words(benchmark, item_text)
    items = materialize(item_templates(benchmark, known, item, item_text), "items")
    least = window + stride - 1
    templates = _cut_once(texts.select("node", without_values(slots_marked(F.col("text"), known)).alias("text")))
    plain = _cut_once(texts.select("node", F.translate(F.lower("text"), _PUNCTUATION, "").alias("text")))
    found = _candidates_of_all(templates, items.filter(F.size("template") >= LEAST_WORDS), window, least, 1, LEAST_LITERAL, "template")
    found = found.unionByName(_candidates_of_all(plain, items, window, least, stride, 0, "plain"))
    found = materialize(found, "candidates")
    wanted = small_side(found.select("node").distinct())
    some = texts.join(wanted, "node", "left_semi").dropDuplicates(["node"]).select(
        "node", slots_marked(F.col("text"), known).alias("marked"), plain_words(F.col("text")).alias("doc_plain"))
    # Stored, so that the words of a document are cut once for all layings.
    some = materialize(some.select("node", words_of(without_values(F.col("marked"))).alias("doc_template"),
                                   words_of(F.col("marked")).alias("doc_filled"), "doc_plain"), "candidate-texts")
    laid = found.join(some.hint("merge"), "node").join(small_side(items), "item")

    def view(column: str, plain: str) -> Column:
        return F.when(F.col("plainly"), F.col(plain)).otherwise(F.col(column)).alias(column)
    laid = laid.select("node", "item", "shift", view("template", "plain"), view("filled", "plain"),
                       view("doc_template", "doc_plain"), view("doc_filled", "doc_plain"))

    def beside(words: str) -> Column:
        """The document's words under the item's, null where it has none."""
        length, missing = F.size("template"), F.greatest(-F.col("shift"), F.lit(0))
        own = F.slice(words, F.greatest(F.col("shift"), F.lit(0)) + 1, F.greatest(length - missing, F.lit(0)))
        return F.concat(F.array_repeat(F.lit(None).cast("string"), F.least(missing, length)), own)
    laid = laid.select("node", "item", "template", F.arrays_zip(
        F.col("template"), F.col("filled"), beside("doc_template").alias("t"), beside("doc_filled").alias("f")).alias("rows"))
    def own_part(mine: Column, theirs: Column, first: bool) -> Column:
        """The document's name, less what runs together with it outside of the item."""
        names, n = F.split(theirs, _MARK + "p"), F.size(F.split(mine, _MARK + "p")) - 1
        n = F.greatest(F.least(n, F.size(names) - 1), F.lit(1))
        part = F.slice(names, -n, n) if first else F.slice(names, F.lit(2), n)
        return F.when(theirs.startswith(_MARK + "p"), F.concat(F.lit(_MARK + "p"), F.array_join(part, _MARK + "p"))).otherwise(theirs)
    pairs = F.transform("rows", lambda r, k: F.struct(
        F.coalesce(r["template"] == r["t"], F.lit(False)).alias("equal"), r["template"].startswith(_MARK).alias("slot"),
        r["filled"].alias("mine"), r["f"].alias("theirs"),
        F.when(k == 0, own_part(r["filled"], r["f"], True)).when(
            k == F.size("template") - 1, own_part(r["filled"], r["f"], False)).otherwise(r["f"]).alias("inner")))
    laid = laid.select("node", "item", F.size("template").alias("length"), pairs.alias("pairs"))

    def run(test) -> Column:
        marks = F.array_join(F.transform("pairs", lambda p: F.when(test(p), "1").otherwise("0")), "")
        return F.array_max(F.transform(F.split(marks, "0"), F.length))
    filled = F.filter("pairs", lambda p: p.equal & p.slot)
    measured = laid.select(
        "node", "item", "length", run(lambda p: p.equal).alias("run"),
        run(lambda p: p.equal & (p.mine == p.theirs)).alias("verbatim"), F.size(filled).alias("slots"),
        F.size(F.array_distinct(F.transform(filled, lambda p: p.mine))).alias("values"),
        F.size(F.array_distinct(F.transform(filled, lambda p: F.struct(p.mine, p.theirs)))).alias("fillings"),
        F.size(F.array_distinct(F.transform(filled, lambda p: F.struct(p.mine, p.inner)))).alias("inner_fillings"))
    need = F.least(F.lit(least), F.col("length"))
    consistent = (F.col("fillings") == F.col("values")) | (F.col("inner_fillings") == F.col("values"))
    kept = measured.filter((F.col("run") >= need) & (consistent | (F.col("verbatim") >= need)))
    return kept.groupBy("node", "item").agg(
        F.max(F.struct("run", "slots", (F.col("verbatim") == F.col("run")).alias("same_values"))).alias("x")).select(
        "node", "item", "x.*")


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``key, item, run, slots, same_values``: every row whose text holds an item."""
    found = materialize(findings(docs, benchmark, text, **options), "findings")
    rows = docs.select(*named(key=key, text=text)).select("key", _node("text").alias("node"))
    return rows.join(small_side(found), "node").drop("node")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no item."""
    found = materialize(findings(docs, benchmark, text, **options).select("node").distinct(), "findings")
    rows = docs.withColumn("__node", _node(text))
    return rows.join(small_side(found.withColumnRenamed("node", "__node")), "__node", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
