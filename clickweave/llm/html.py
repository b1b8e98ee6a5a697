"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# lines of a block, and the characters a block needs to rise above the boilerplate of a page
BLOCK_LINES = 3
SURGE_CHARS = 80
# a character inside of article or main counts so many times
MARK_WEIGHT = 2
# a line is navigation if more of its characters than this share are link text
LINK_SHARE = 0.5

# one alternative per kind of markup; a comment, an element of raw text or a tag that never ends takes the rest
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|iframe|canvas|object)\b[^>]*(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|</?[a-z][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
# fixed values: how the foot of a page begins
_FOOT = re.compile(
    r"^(?:©|\(c\)\s|copyright\b|imprint\b|impressum\b|privacy policy\b|terms of (?:use|service)\b|powered by\b)"
    r"|\ball rights reserved\b",
    re.IGNORECASE,
)
_NAMING = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# fixed values: elements of HTML that begin a line of their own
_BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p "
    "pre search section select summary table tbody td tfoot th thead tr ul".split()
)
_BOXES = frozenset("article blockquote center div main section table tbody td th tr ul ol li".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# fixed values: elements that never hold the article
_ASIDE = frozenset("aside button dialog footer form head menu nav search select".split())
# fixed values: words in class, id or role that name something beside the article, whatever the page is about
_FIRM_WORDS = frozenset(
    "ad ads adsense advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent "
    "contentinfo cookie cookies disqus gdpr masthead modal nav navbar newsletter pager pagination popup promo "
    "promoted sidebar signup sponsor sponsored subscribe toolbar widget widgets".split()
)
# fixed values: words that name such things too, but may also say what a part of an article is about
_ASIDE_WORDS = _FIRM_WORDS | frozenset(
    "alert complementary copyright dialog disclaimer discussion footer login menu menus navigation notice notices "
    "promotion related recommended replies reply respond search share sharing social".split()
)
# fixed values: what stands beside such a word and does not say what it is about: furniture, and mere places
_FURNITURE = frozenset(
    "articles bar box button buttons card cards entries form icon icons item items link links list panel posts "
    "slot stories thread unit".split()
)
_PLACES = frozenset(
    "area block body bottom col column container content group inner inside left main outer page reader readers "
    "right row section site sticky title top user users wrap wrapper".split()
)
_PAGE_HEADER_WORDS = frozenset(["header", "topbar"])
_HOLDING = frozenset("has have no not show hide with without".split())
# fixed values: elements that are never left out for what they are called
_KEPT = frozenset("html body h1 h2 h3 h4 h5 h6 hgroup".split())
_TALK = frozenset("comment comments discussion disqus replies reply respond".split())


class _Line(NamedTuple):
    text: str
    linked: int
    marked: bool
    # numbers of the innermost container around it, and of the one around that
    box: int
    up: int
    # number of the element around it whose name may be that of something beside the article; 0 for none
    doubt: int = 0


class _Skip:
    """A part of the page that is left out, until its element ends."""

    def __init__(self, name: str, firm: bool):
        self.name = name
        # an article inside ends a loose skip: then it was a wrapper
        self.firm = firm
        self.depth = 1

    def over(self, closing: bool, name: str) -> bool:
        if name == self.name:
            self.depth += -1 if closing else 1
            # a paragraph or list item that was never closed ends where the next begins
            return self.depth == 0 or (self.name in ("p", "li", "dd", "dt") and not closing)
        # what cannot stand inside ends a paragraph or a head that was never closed
        return self.name in ("p", "head") and name in _BLOCKS and name != "br"


class _Names(NamedTuple):
    """What class, id and role call an element."""

    # something beside the article, and that for certain
    aside: bool
    firm: bool
    talk: bool


_NAMELESS = _Names(False, False, False)


def _named(rest: str, inside: bool) -> _Names:
    """Judge an element by its names.

    A name counts if all its parts are words for things beside the article, or
    furniture, places and numbers next to such a word.  An id inside an article
    is an anchor and may say what a section is about: there it takes a firm word,
    or furniture.  Outside of an article the last part of a class is enough, and
    headers are those of the page.
    """
    aside = firm = talk = False
    for kind, *value in _NAMING.findall(rest):
        for token in "".join(value).split():
            parts = [part.lower() for part in _PARTS.findall(token)]
            # what an element has is inside of it
            if not parts or _HOLDING.intersection(parts):
                continue
            words = _ASIDE_WORDS.intersection(parts)
            other = set(parts) - words
            if "header" in other and ({"page", "site"} & other or not inside):
                words = words | {"header"}
            other -= words | _FURNITURE | _PLACES
            known = bool(words) and all(part.isdigit() for part in other)
            if known and inside and kind.lower() == "id":
                known = bool(_FIRM_WORDS & words or _FURNITURE.intersection(parts))
            if not inside and kind.lower() == "class":
                known |= parts[-1] in _ASIDE_WORDS | _PAGE_HEADER_WORDS
            if known:
                aside = True
                firm |= bool(_FIRM_WORDS & words) or bool(_FURNITURE.intersection(parts))
                talk |= bool(_TALK & set(parts)) and not (inside and kind.lower() == "id" and not _FIRM_WORDS & words)
    return _Names(aside, firm, talk)


def _lines(page: str, asides: frozenset[str] = _ASIDE) -> list[_Line]:
    """Lines of text without markup; where something was left out, a gap of empty lines."""
    lines: list[_Line] = []
    pieces: list[str] = []
    linked = links = articles = seen = 0
    skip: _Skip | None = None
    # an element inside an article that may not belong to it
    doubt: _Skip | None = None
    doubts = 0
    boxes: list[tuple[str, int]] = [("", 0)]

    def around() -> tuple[int, int]:
        return boxes[-1][1], boxes[-2][1] if len(boxes) > 1 else -1

    def gap() -> list[_Line]:
        return [_Line("", 0, False, *around())] * BLOCK_LINES

    def end_line() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            lines.append(_Line(text, linked, articles > 0, *around(), doubts if doubt is not None else 0))
        pieces.clear()
        linked = 0

    def take(text: str) -> None:
        nonlocal linked
        if text and skip is None:
            pieces.append(text)
            if links:
                linked += len(html.unescape(text).strip())

    def talk(rest: str) -> bool:
        # the first article is the page's own, whatever it is called
        return seen > 0 and _named(rest, True).talk

    at = 0
    for m in _MARKUP.finditer(page):
        take(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        closing = bool(m["close"])
        if skip is not None:
            if skip.over(closing, name):
                skip = None
                lines += gap()
                if closing:
                    continue
            elif name in ("article", "main") and not closing and not skip.firm and not talk(m["rest"]):
                skip = None
            else:
                continue
        if name in _BLOCKS:
            end_line()
        if name in _BOXES:
            if closing:
                open_ = next((k for k in range(len(boxes) - 1, 0, -1) if boxes[k][0] == name), 0)
                if open_:
                    del boxes[open_:]
        if doubt is not None and name == doubt.name and not m["rest"].endswith("/") and doubt.over(closing, name):
            doubt = None
        if closing:
            if name in ("article", "main"):
                articles = max(0, articles - 1)
                lines += gap()
                doubt = doubt if articles else None
            elif name == "a":
                links = max(0, links - 1)
            continue
        names = _named(m["rest"], articles > 0) if m["rest"] else _NAMELESS
        aside = name in asides or names.aside or (name == "header" and not articles)
        if aside and name not in _VOID | _KEPT and not m["rest"].endswith("/"):
            if name not in ("article", "main") or talk(m["rest"]):
                end_line()
                if articles and name not in asides and not names.firm:
                    # its text decides whether it belongs to the article
                    if doubt is None:
                        doubt = _Skip(name, False)
                        doubts += 1
                else:
                    lines += gap()
                    # a form may be wrapped around the whole page
                    skip = _Skip(name, (name in asides and name != "form") or names.talk)
                    continue
        if name in ("article", "main"):
            lines += gap() if not articles else []
            articles += 1
            seen += 1
        elif name == "a" and not m["rest"].endswith("/"):
            links += 1
        if name in _BOXES and not m["rest"].endswith("/"):
            boxes.append((name, m.start() + 1))
    take(page[at:])
    end_line()
    return _settled(lines)


def _settled(lines: list[_Line]) -> list[_Line]:
    """Without the doubtful parts of an article, but for one that rises and holds half of its text or more."""
    held: dict[int, int] = {}
    for line in lines:
        if line.marked:
            held[line.doubt] = held.get(line.doubt, 0) + len(line.text)
    whole = sum(held.values())
    gone = {k for k, size in held.items() if k and (2 * size < whole or size <= SURGE_CHARS)}
    out: list[_Line] = []
    for line in lines:
        if line.doubt not in gone:
            out.append(line)
        elif not out or out[-1].text:
            out += [_Line("", 0, False, line.box, line.up)] * BLOCK_LINES
    return out


def _is_foot(line: _Line) -> bool:
    return len(line.text) <= SURGE_CHARS and _FOOT.search(line.text) is not None


def _goes_on(lines: list[_Line], last: int, after: int, marked: bool) -> bool:
    """Whether a run that ended in a gap goes on: in the same container or, without marks, in the one that follows."""
    box = lines[last].box
    if all(line.box == box for line in lines[last + 1 : after + 1]):
        return True
    beside = lines[after].up == lines[last].up and lines[after].marked == lines[last].marked
    return not marked and beside and not _is_foot(lines[after])


def _runs(lines: list[_Line], lengths: list[int], surge: int, *, marked: bool = False) -> list[list[int]]:
    """Lines between a surge and the dive after it, by the sums of blocks of lines.

    What was left out inside of a container is no dive: the run goes on behind
    it with the next line of the same container.  Without marks it also goes on
    in the container that stands beside, and the foot of the page is a dive:
    from a short line of that kind in another container on, and at the very end.
    """
    n = len(lengths)
    sums = [sum(lengths[i : i + BLOCK_LINES]) for i in range(n)] + [0]
    runs = []
    i = 0
    while i < n:
        if not (sums[i] > surge and lengths[i]):
            i += 1
            continue
        run: list[int] = []
        while i < n:
            foot = False
            while i < n and sums[i]:
                foot |= not marked and bool(run) and lines[i].box != lines[run[-1]].box and _is_foot(lines[i])
                run += [i] if lengths[i] and not foot else []
                i += 1
            after = i
            while after < n and not lines[after].text:
                after += 1
            if foot or after == n or not lengths[after] or not _goes_on(lines, run[-1], after, marked):
                break
            i = after
        while not marked and len(run) > 1 and _is_foot(lines[run[-1]]) and not any(x.text for x in lines[run[-1] + 1 :]):
            run.pop()
        runs.append(run)
    return runs


def main_text(page: str | None) -> str:
    """The article of a page: its blocks joined by single spaces."""
    lines = _lines(page or "")
    if not any(line.text for line in lines):
        # nothing outside of forms: then the form is the page
        lines = _lines(page or "", _ASIDE - {"form"})
    # links inside an article are text; elsewhere a line of links is navigation
    lengths = [
        len(line.text) * (MARK_WEIGHT if line.marked else line.linked <= LINK_SHARE * len(line.text)) for line in lines
    ]
    inside = [n if line.marked else 0 for n, line in zip(lengths, lines)]
    outside = [0 if line.marked else n for n, line in zip(lengths, lines)]
    around = _runs(lines, outside, SURGE_CHARS)
    if sum(inside) >= max((sum(outside[i] for i in run) for run in around), default=1):
        # the marks hold the largest rise of the page: they say where it begins and ends
        keep = _runs(lines, inside, 0, marked=True)
    else:
        keep = _runs(lines, lengths, SURGE_CHARS)
    if not keep and any(lengths):
        keep = _runs(lines, lengths, max(sum(lengths[i : i + BLOCK_LINES]) for i in range(len(lengths))) - 1)
    return " ".join(lines[i].text for run in keep for i in run)


def extract_text(pages: DataFrame) -> DataFrame:
    """Main text of every row of ``pages(page_id, url, html)``: page_id, url, text and n_chars.

    A null or empty html, or one without an article, gives the empty text.
    Repeated rows are repeated; other columns are ignored; an empty table gives
    no rows.  Whole pages are read, however long; rows do not depend on each other.

    Markup is stripped, elements that stand beside the article (by tag or by
    what class, id and role call them) leave a gap of empty lines, and every
    block-level element begins a line.  A part of an article whose name may also
    be a subject (a notice, a discussion) stays if it holds half of the text.
    Sums of text lengths over windows of lines rise where the article begins and
    fall to nothing where it ends; text between such points is kept, and goes on
    behind a gap in the same container.  On pages without marks it also goes on
    in the container beside, and short lines that begin the foot of a page end it.
    A line inside article or main weighs ``MARK_WEIGHT`` times its length, a line
    of links elsewhere nothing.  Where the marked lines weigh at least as much as
    any rise outside of them, only they count, however short; else every rise of
    more than ``SURGE_CHARS`` does, marked or not.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )

    schema = pages.select("page_id", "url").schema.add("text", T.StringType())
    found = pages.select("page_id", "url", "html").mapInArrow(run, schema)
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))
