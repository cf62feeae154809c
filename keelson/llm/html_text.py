"""Main text of web pages by scoring the element tree.

A page is read into a list of elements and a list of text runs.  Elements that are by
their kind, role or class not article text (menus, adverts, forms, comments, ...) are
struck out.  Each remaining paragraph earns points for its length and its commas and
passes them to its ancestors, in full to the nearest, less to farther ones.  An element
keeps the share of its points that is not link text.  The best element and those of its
siblings that score well or read like paragraphs give the text, with the headings, lists
and tables between them; where the best element is not named as an article, every sibling
that scores and is not mostly links belongs to it.

Defined results: a null or empty page, or one without text, gives an empty text; broken
markup never fails: open elements end with the page, stray ends are skipped, an open
comment or script runs to the end.  If no paragraph is long enough to score, all text
that was not struck out is kept.  Repeated rows give repeated results.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.frames import named

#: Paragraphs shorter than this earn nothing.
LEAST_CHARS = 25

_MARKUP = re.compile(
    r"<!--|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)>|<[!?/][^>]*>")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp".split())
_BLOCK = frozenset(
    "address article aside blockquote body br dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_HOLDER = frozenset("article body details div dd fieldset figure html main section table tbody td tr".split())
_ROOT = frozenset(("html", "body", "article", "main"))
_STRUCK = frozenset("nav footer aside form button select option dialog menu svg canvas object video audio head".split())
_STRUCK_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
#: Parts of class names and ids that name something beside the article.
_STRUCK_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs footer sidebar comment comments disqus replies reply cookie cookies consent gdpr "
    "related recommended share sharing newsletter subscribe signup login popup modal pagination pager skip".split())
#: Such parts that count only where no part names the article.
_DOUBTFUL_NAMES = frozenset("header masthead banner notice notices widget form search social toolbar alert disclaimer".split())
_ARTICLE_NAMES = frozenset("article content entry main post story text body".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Kinds that are kept between chosen siblings.
_BETWEEN = _HEADINGS | frozenset("ul ol table dl figure".split())
#: Starting one of these ends an open one of the named kinds, up to the next holder.
_ENDS_OPEN = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
              "th": ("td", "th"), "option": ("option",)}
_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
          "th": ("tr", "table"), "option": ("select",)}


class Page:
    """Elements as parallel lists, text as runs ``(element, block, text)`` in page order."""

    def __init__(self, source: str):
        self.tag, self.parent, self.struck, self.weight = ["#page"], [0], [False], [0.0]
        self.runs: list[tuple[int, int, str]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack, at, block = [0], 0, 0

        def pop_to(kinds, stops):
            for depth in range(len(stack) - 1, 0, -1):
                if self.tag[stack[depth]] in kinds:
                    del stack[depth:]
                    return
                if self.tag[stack[depth]] in stops:
                    return

        while at < len(source):
            found = _MARKUP.search(source, at)
            upto = found.start() if found else len(source)
            if upto > at:
                self.runs.append((stack[-1], block, source[at:upto]))
            if not found:
                break
            at = found.end()
            if found[0] == "<!--":
                end = source.find("-->", at)
                at = len(source) if end < 0 else end + 3
                continue
            tag = (found["tag"] or "").lower()
            if not tag:
                continue
            if tag in _BLOCK:
                block += 1
            if found["end"]:
                pop_to((tag,), () if tag in _HOLDER else _HOLDER)
                continue
            if tag in _RAW:
                end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            if tag in _VOID:
                continue
            if tag in _ENDS_OPEN:
                pop_to(_ENDS_OPEN[tag], _SCOPE[tag])
            elif tag in _BLOCK:
                pop_to(("p",), _HOLDER)
            if tag == "body":
                pop_to(("head",), ())
            self._open(tag, found["rest"], stack)

    def _open(self, tag: str, rest: str, stack: list[int]) -> None:
        above = stack[-1]
        attributes = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(rest)} if rest.strip(" /") else {}
        names = {x.lower() for x in _NAME_PART.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")}
        good = bool(names & _ARTICLE_NAMES)
        struck = tag in _STRUCK or attributes.get("role", "").lower() in _STRUCK_ROLES
        struck |= tag == "header" and not any(self.tag[e] in ("article", "main") for e in stack)
        if tag not in _ROOT:
            struck |= bool(names & _STRUCK_NAMES) or (bool(names & _DOUBTFUL_NAMES) and not good)
        struck |= "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
        struck |= "display:none" in attributes.get("style", "").replace(" ", "").lower()
        self.tag.append(tag)
        self.parent.append(above)
        self.struck.append(struck or self.struck[above])
        self.weight.append(25.0 if tag in ("article", "main") or (good and tag in _HOLDER and tag not in _ROOT) else 0.0)
        stack.append(len(self.tag) - 1)

    def blocks(self) -> list[tuple[int, str, int]]:
        """Element, clean text and characters in links of each block that was not struck out."""
        out: list[list] = []
        last = None
        for element, block, text in self.runs:
            if self.struck[element]:
                continue
            text = html.unescape(text)
            linked = len(text.strip()) if self.in_link(element) else 0
            if block != last:
                out.append([self.block_element(element), [text], linked])
                last = block
            else:
                out[-1][1].append(text)
                out[-1][2] += linked
        clean = ((e, " ".join("".join(parts).split()), linked) for e, parts, linked in out)
        return [x for x in clean if x[1]]

    def in_link(self, element: int) -> bool:
        while element and self.tag[element] not in _BLOCK:
            if self.tag[element] == "a":
                return True
            element = self.parent[element]
        return False

    def block_element(self, element: int) -> int:
        while element and self.tag[element] not in _BLOCK:
            element = self.parent[element]
        return element


def main_text(source: str | None) -> str:
    page = Page(source or "")
    blocks = _without_link_lists(page, page.blocks())
    score = dict.fromkeys(range(len(page.tag)), 0.0)
    chars, links, scored = dict.fromkeys(score, 0), dict.fromkeys(score, 0), False
    for element, text, linked in blocks:
        points = 1 + text.count(",") + min(len(text) / 100, 3) if len(text) >= LEAST_CHARS else 0
        scored |= points > 0
        holder = element if page.tag[element] in _HOLDER else page.parent[element]
        if holder != element:
            chars[element] += len(text)
            links[element] += linked
        level = 0
        while True:
            score[holder] += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            chars[holder] += len(text)
            links[holder] += linked
            if holder == 0:
                break
            holder, level = page.parent[holder], level + 1
    if not scored:
        return " ".join(text for _, text, _ in blocks)

    def density(e):
        return min(1.0, links[e] / chars[e]) if chars[e] else 0.0

    final = {e: (s + page.weight[e]) * (1 - density(e)) for e, s in score.items() if s > 0}
    best = max(final, key=lambda e: (final[e], -e))
    # Where no element is named as the article, each sibling with text that scores is part of it.
    chosen, enough = {best}, max(10.0, final[best] / 5)
    beside = [e for e in range(1, len(page.tag)) if page.parent[e] == page.parent[best] and chars[e] and not page.struck[e]]
    for e in beside:
        reads = page.tag[e] in ("p", "h1", "blockquote", "pre") and density(e) < 0.25
        if final.get(e, 0.0) >= enough or reads or (not page.weight[best] and score[e] > 0 and density(e) < 0.25):
            chosen.add(e)
    # Headings, lists and tables between what was chosen, and a heading before it.
    ends = [k for k, e in enumerate(beside) if e in chosen]
    first = ends[0] - 1 if ends and ends[0] and page.tag[beside[ends[0] - 1]] in _HEADINGS else (ends or [0])[0]
    chosen.update(e for e in beside[first:(ends or [0])[-1]] if page.tag[e] in _BETWEEN and density(e) < 0.5)

    def kept(element):
        while element:
            if element in chosen:
                return True
            element = page.parent[element]
        return 0 in chosen
    return " ".join(text for element, text, _ in blocks if kept(element))


def _without_link_lists(page: Page, blocks):
    """Leaves out lists of two or more entries that are mostly links.

    Inside an article only those without a heading directly before, whose entries are
    links and nothing else: reference lists stay.
    """
    owner, before, last = {}, {}, None
    for element, text, linked in blocks:
        at = element
        while at and page.tag[at] not in ("ul", "ol"):
            at = page.parent[at]
        if at:
            before.setdefault(at, last)
            entry = owner.setdefault(at, [0, 0, 0])
            entry[0] += len(text)
            entry[1] += linked
            entry[2] += linked > 0
        last = element

    def inside(element):
        while element and page.tag[element] not in ("article", "main"):
            element = page.parent[element]
        return element

    def cited(e):
        chars, linked, _ = owner[e]
        headed = before[e] is not None and page.tag[before[e]] in _HEADINGS
        return inside(e) and (headed or linked < 0.9 * chars)
    bare = {e for e, (chars, linked, n) in owner.items() if n > 1 and linked > chars / 2 and not cited(e)}
    if not bare:
        return blocks

    def outside(element):
        while element:
            if element in bare:
                return False
            element = page.parent[element]
        return True
    return [b for b in blocks if outside(b[0])]


def _extract(batches):
    for batch in batches:
        texts = [main_text(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, page: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; rows stay where they are read."""
    rows = pages.select(*named(page_id=page, url=url, source=source))
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2]]
    return rows.mapInArrow(_extract, ", ".join([*kinds, "text string", "n_chars long"]))
