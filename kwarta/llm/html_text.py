"""Main text of web pages by tag-path ratios.

Every block of text has a path of tags from the root. Per path two ratios are taken over all its blocks: text
outside links per block, and punctuation per block. Both are smoothed along the page, since content stands
together, and fused with what the path itself says: elements named for content or for furniture. Paths whose
fused score reaches a threshold are content, and so are their blocks; short blocks are taken in by what they stand with.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator
from statistics import pstdev

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kwarta.llm.shared import small_batches

#: Share of the standard deviation of the paths' fused scores that a path must reach.
THRESHOLD = 0.8
#: Weights of the neighbours when smoothing along the page.
KERNEL = (0.25, 0.5, 0.25)

#: Elements by their role in HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noframes xmp".split())
#: Furniture if they have an end tag (else what follows is the page's), their choices in any case.
_EMBEDDED, _CHOICES = frozenset("noscript template svg select object".split()), frozenset("option optgroup".split())
_FOREIGN, _HTML_IN_FOREIGN = frozenset("svg math".split()), frozenset("foreignobject desc annotation-xml".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var".split())
_FURNITURE = frozenset("nav footer aside button dialog menu head".split())
#: Elements that only a head holds; any other ends it.
_IN_HEAD = frozenset("base link meta noscript script style template title".split())
_CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "optgroup": {"option", "optgroup"},
}
#: HTML elements that end an svg or math left open.
_ENDS_FOREIGN = frozenset(
    "article aside blockquote body br center dd div dl dt embed footer form h1 h2 h3 h4 h5 h6 head header hr img li main "
    "menu meta nav ol p pre section table ul".split())
_HOLDS = frozenset("ul ol dl table select article section div main body html nav aside footer header form td th li dd".split())
#: Words in class, id or role that name furniture.
_FURNITURE_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs footer sidebar aside ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo banner cookie cookies consent notice notices alert popup modal newsletter subscribe "
    "comment comments respond disqus share sharing social related recommended widget toolbar pagination pager login signup "
    "search complementary contentinfo masthead copyright reply replies discussion".split())
_CONTENT_WORDS = frozenset("main articlebody".split())

# A quote opens a value only after an equals sign; one that is never closed is an ordinary character.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+|(?=[>\"'])))*+)>|"
    r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|[^<]++|<",
    re.S)
_TAG_BEGINS = re.compile(r"</?[a-zA-Z]|<[!?]")
_ATTRIBUTES = re.compile(r"([^\s\"'=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAMING = frozenset(("class", "id", "role", "itemprop"))
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")

#: Words in class, id or role of an article that is not the page's own.
_ASIDE_ARTICLES = frozenset("comment comments reply replies ad ads advert sponsored promo related recommended teaser teasers".split())
#: Words that name what readers wrote, whatever it looks like.
_READER_WORDS = frozenset("comment comments respond disqus reply replies reader readers".split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: A part of an article that is named like furniture is prose all the same if it has so many blocks, so much text outside
#: links in each on average, and so small a share of links.
PROSE_BLOCKS, PROSE_CHARS, PROSE_LINKS = 2, 80, 0.1

#: What an element's own name says, before its text is known: furniture by tag, or by a word that may mean a wrapper.
#: What readers wrote is named by a word too, and no look of its text speaks against it.
_NONE, _NAMED_MAIN, _NAMED_ARTICLE, _WORDED, _READERS, _TAGGED = range(6)
#: Roles; an article is disputed inside furniture that only a word names.
_PLAIN, _MAIN, _ARTICLE, _DISPUTED, _SIDE, _OUT = range(6)
#: What a path's name adds to its ratio, which lies between 0 and 1: a good ratio outweighs content's names.
NAMED = {_PLAIN: 0.0, _MAIN: 0.3, _ARTICLE: 0.5, _DISPUTED: -0.5, _SIDE: -1.0, _OUT: -1.0}


class _Element:
    """An open element: its name, the text outside links in it, and the articles and mains with their own name.

    Its path is a number, given to each pair of an outer path and a tag, so that a deep page costs no more per
    element than a flat one. Its holder is the article or main that it belongs to, if any.
    """

    __slots__ = (
        "tag", "outer", "path", "heading", "name", "inline", "foreign", "within", "chars", "marks", "blocks", "linked", "role", "holder")

    def __init__(self, tag: str, outer: _Element | None, name: int, paths: dict[tuple[int, str], int]) -> None:
        self.tag, self.outer, self.name = tag, outer, name
        self.foreign = tag in _FOREIGN or (outer is not None and outer.foreign and tag not in _HTML_IN_FOREIGN)
        self.inline = tag in _INLINE or self.foreign
        self.path = 0 if outer is None else outer.path if self.inline else paths.setdefault((outer.path, tag), len(paths) + 1)
        self.heading = (not self.inline and tag in _HEADINGS) or (outer is not None and outer.heading)
        self.within = name in (_NAMED_MAIN, _NAMED_ARTICLE) or (outer is not None and outer.within)
        self.chars = self.marks = self.blocks = self.linked = 0
        self.role, self.holder = _PLAIN, None


class _Block:
    """Text between two borders of block elements."""

    __slots__ = ("parts", "linked", "element")

    def __init__(self, element: _Element) -> None:
        self.parts, self.linked, self.element = [], 0, element

    @property
    def key(self) -> tuple[int, int]:
        return self.element.path, self.element.role


def _name(tag: str, attributes: str, outer: _Element) -> int:
    """What an element's own name says of its text."""
    if tag in _FURNITURE or tag in _CHOICES or (tag == "header" and not outer.within):
        return _TAGGED
    found = _NAMED_ARTICLE if tag == "article" else _NAMED_MAIN if tag == "main" else _WORDED if tag == "form" else _NONE
    if attributes and tag not in ("html", "body"):
        for name, a, b, c in _ATTRIBUTES.findall(attributes):
            if (name := name.lower()) not in _NAMING:
                continue
            words = [w.lower() for w in _WORDS.findall(a or b or c)]
            if name == "itemprop":
                if "".join(words) == "articlebody":
                    return _NAMED_ARTICLE
            elif not _FURNITURE_WORDS.isdisjoint(words) and tag not in ("article", "main"):
                return _WORDED if _READER_WORDS.isdisjoint(words) else _READERS
            elif name == "role" and words == ["main"]:
                found = max(found, _NAMED_MAIN) if found != _WORDED else _NAMED_MAIN
            elif tag == "article" and not _ASIDE_ARTICLES.isdisjoint(words):
                return _WORDED if _READER_WORDS.isdisjoint(words) else _READERS
    return found


def _settle(elements: list[_Element], found: list[_Block]) -> None:
    """Roles and holders of all elements, outer ones first.

    A word that names furniture, and a form, count for nothing if the element holds most of the page's text outside
    links and furniture tags and no article or main is outside it: it is a wrapper, such as "has-sidebar". In an
    article or main the word counts for nothing either if the element's own ratios are those of prose, as
    in "social-history"; only words for what readers wrote always count.
    """
    for block in found:
        size = len(" ".join("".join(block.parts).split()))
        block.element.chars += max(0, size - block.linked)
        block.element.blocks += size > 0
        block.element.linked += min(size, block.linked)
    for e in reversed(elements):
        if e.outer is not None and e.name != _TAGGED:
            e.outer.chars += e.chars
            e.outer.blocks += e.blocks
            e.outer.linked += e.linked
    total, worded = elements[0].chars, (_WORDED, _READERS)
    for e in reversed(elements):
        e.marks += e.name in (_NAMED_MAIN, _NAMED_ARTICLE)
        if e.outer is not None and e.name != _TAGGED and (e.name not in worded or 2 * e.chars > total):
            e.outer.marks += e.marks
    marks = elements[0].marks
    for e in elements[1:]:
        outer, name = e.outer, e.name
        if name in worded and 2 * e.chars > total and e.marks == marks:
            name = _NAMED_ARTICLE if e.tag == "article" else _NONE
        elif name == _WORDED and outer.within and e.tag not in ("form", "article") and _is_prose(e):
            name = _NONE
        e.role, e.holder = outer.role, outer.holder
        if outer.role == _OUT or name == _TAGGED:
            e.role = _OUT
        elif name in worded:
            e.role = _SIDE
        elif name == _NAMED_MAIN:
            e.role = max(outer.role, _MAIN) if outer.role <= _ARTICLE else _MAIN
            e.holder = e
        elif name == _NAMED_ARTICLE:
            e.role = _ARTICLE if outer.role <= _ARTICLE else _DISPUTED
            e.holder = e


def _is_prose(e: _Element) -> bool:
    """Whether an element's text per block and its links are those of prose."""
    return e.blocks >= PROSE_BLOCKS and e.chars >= PROSE_CHARS * e.blocks and e.linked <= PROSE_LINKS * (e.chars + e.linked)


def blocks(page: str) -> list[_Block]:
    """All blocks with text, in page order; scripts, styles and other raw elements have none."""
    found: list[_Block] = []
    paths: dict[tuple[int, str], int] = {}
    stack = [_Element("", None, _NONE, paths)]
    open_tags: dict[str, int] = {}
    elements = [stack[0]]
    block = _Block(stack[0])

    def border() -> None:
        nonlocal block
        if block.parts:
            found.append(block)
        block = _Block(stack[-1])

    def pop_to(at: int) -> None:
        split = any(not e.inline or e.name != _NONE or e.tag in _EMBEDDED for e in stack[at:])
        for e in stack[at:]:
            open_tags[e.tag] -= 1
        del stack[at:]
        if split:
            border()

    at, size, links, last_end = 0, len(page), 0, page.rfind(">")
    while at < size:
        if at > last_end:  # no tag can end here any more: one that begins takes the rest of the page with it
            text = _TAG_BEGINS.split(page[at:], maxsplit=1)[0]
            block.parts.append(text)
            block.linked += len(text) if links else 0
            break
        token = _TOKEN.match(page, at)
        at = token.end()
        tag = token[2] or token[5]
        if not tag:
            text = token[0]
            if text[0] != "<" or text == "<":
                block.parts.append(text)
                if links:
                    block.linked += len(text)
            continue
        tag = tag.lower()
        if stack[-1].tag == "head" and not (token[1] or token[4]) and tag not in _IN_HEAD:
            pop_to(len(stack) - 1)
        if token[1] or token[4]:
            for i in range(len(stack) - 1, 0, -1) if open_tags.get(tag) else ():
                if stack[i].tag == tag:
                    if tag in _EMBEDDED:
                        stack[i].name = _TAGGED
                    pop_to(i)
                    break
            if tag == "a":
                links = max(0, links - 1)
            elif tag == "p":
                border()
            continue
        attributes = token[3] or token[6] or ""
        if attributes.endswith("/") and (tag in _FOREIGN or stack[-1].foreign):
            continue
        if stack[-1].foreign and tag in _ENDS_FOREIGN:
            top = next(i for i in range(len(stack) - 1, 0, -1) if not stack[i - 1].foreign)
            if stack[top].tag in _EMBEDDED:
                stack[top].name = _TAGGED
            pop_to(top)
        if tag not in _INLINE and tag not in _CHOICES and tag != "hr":
            top = len(stack) - 1
            while stack[top].tag in _CHOICES:
                top -= 1
            if stack[top].tag == "select":
                stack[top].name = _TAGGED
                pop_to(top)
            elif top < len(stack) - 1:
                pop_to(top + 1)
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            if tag not in _INLINE:
                border()
            continue
        if tag in _VOID:
            if tag in ("br", "hr"):
                border()
            continue
        if tag not in _INLINE and tag not in _EMBEDDED and not (tag in _FOREIGN or stack[-1].foreign):
            closes = _CLOSED_BY.get(tag)
            for i in range(len(stack) - 1, 0, -1):
                open_tag = stack[i].tag
                if open_tag == "p" or (closes and open_tag in closes):
                    pop_to(i)
                    break
                if open_tag in _HOLDS:
                    break
        outer = stack[-1]
        name = _name(tag, attributes, outer)
        element = _Element(tag, outer, name, paths)
        stack.append(element)
        open_tags[tag] = open_tags.get(tag, 0) + 1
        elements.append(element)
        if not element.inline or name != _NONE or tag in _EMBEDDED:
            border()
            links = 0 if not element.inline else links
        if tag == "a":
            links += 1
    border()
    _settle(elements, found)
    return found


def _smooth(values: list[float], roles: list[int]) -> list[float]:
    """Each value with its neighbours on the page; one of another role lends nothing."""
    before, here, after = KERNEL
    out = []
    for i, v in enumerate(values):
        left = values[i - 1] if i > 0 and roles[i - 1] == roles[i] else v
        right = values[i + 1] if i + 1 < len(values) and roles[i + 1] == roles[i] else v
        out.append(before * left + here * v + after * right)
    return out


def content_paths(found: list[tuple[_Block, str]], threshold: float = THRESHOLD) -> set[tuple[int, int]]:
    """The (path, role) pairs that hold the page's content: their fused scores reach the threshold.

    Furniture neither scales the ratios nor counts for the spread, however much of it a page has.
    """
    sums: dict[tuple[int, int], list[float]] = {}
    for block, text in found:
        if NAMED[block.element.role] <= -1:
            continue
        of = sums.setdefault(block.key, [0, 0, 0])
        of[0] += 1
        of[1] += max(0, len(text) - block.linked)
        of[2] += len(_PUNCTUATION.findall(text))
    if not sums:
        return set()
    roles = [role for _, role in sums]
    text_ratio = _smooth([s[1] / s[0] for s in sums.values()], roles)
    mark_ratio = _smooth([s[2] / s[0] for s in sums.values()], roles)
    ratio = [t * math.log2(2 + m) for t, m in zip(text_ratio, mark_ratio, strict=True)]
    most = max(ratio) or 1.0
    fused = [r / most + NAMED[role] for r, role in zip(ratio, roles, strict=True)]
    least = threshold * pstdev(fused)
    return {key for key, score in zip(sums, fused, strict=True) if score >= least and score > 0}


def content(found: list[tuple[_Block, str]], threshold: float = THRESHOLD) -> list[bool]:
    """Which blocks are content: those of content paths, and what is not furniture and belongs to them.

    An article or main with content is taken in whole, without the articles inside that have none; elsewhere
    headings are that content follows.
    """
    chosen = content_paths(found, threshold)
    holders = {id(b.element.holder) for b, _ in found if b.element.holder is not None and b.key in chosen}
    taken = [b.key in chosen or (NAMED[b.element.role] > -1 and id(b.element.holder) in holders) for b, _ in found]
    for i in range(len(found) - 2, -1, -1):
        element = found[i][0].element
        if not taken[i] and taken[i + 1] and NAMED[element.role] > -1 and element.heading:
            taken[i] = True
    return taken


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    """The page's main text: character references decoded, one space for white space and between blocks."""
    if not page:
        return ""
    found = [(b, " ".join(html.unescape("".join(b.parts)).split())) for b in blocks(page)]
    found = [(b, text) for b, text in found if text]
    return " ".join(text for (_, text), taken in zip(found, content(found, threshold), strict=True) if taken)


def extract(
    pages: DataFrame, page: str = "html", *, columns: Iterable[str] = ("page_id", "url"), threshold: float = THRESHOLD,
) -> DataFrame:
    """The given columns with text and n_chars (code points of text), one row per row, from the whole page.

    A null or empty page, and one without content, has the empty text. Repeated rows give repeated results.
    Empty table: no rows. Input columns named like a result are not carried.
    """
    names = [n for n in columns if n not in ("text", "n_chars")]
    small_batches(pages.sparkSession)
    rows = pages.select(pages[f"`{page}`"].cast("string").alias("_page"), *(pages[f"`{n}`"].alias(f"_in_{i}") for i, n in enumerate(names)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, threshold) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*batch.schema.names[1:], "text", "n_chars"])

    kept = "".join(f"_in_{i} {rows.schema[f'_in_{i}'].dataType.simpleString()}, " for i in range(len(names)))
    done = rows.mapInArrow(run, kept + "text string, n_chars long")
    return done.select(*(F.col(f"_in_{i}").alias(n) for i, n in enumerate(names)), "text", "n_chars")
