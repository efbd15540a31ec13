"""Main text of web pages by tree scoring.

A page is read into a tree (tags, implied end tags, raw-text elements), and its
text is cut into blocks at block-level elements and at two line breaks in a row.
Subtrees that are no article by their element, role or class words (menus, page
headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments)
give no blocks.  Every other block is a paragraph: it passes 1 point, one per
comma and up to 3 for its length to the element around it, a half of that to the
next one, and a sixth, a ninth and a twelfth to the three beyond.  An element's points, with a
weight for its kind and class words, are discounted by the share of its text that
lies in links; the best one, or the article around it, is the container.
It is kept with those of its siblings that hold text of the same sort, and
without the link lists inside.

Each page is judged by itself in the task that reads it, in time linear in its
length; nothing is shuffled, and batches are cut by bytes of text.

Defined cases: a null or empty page has the empty text; a page without markup is
one block; text that never gets into an element belongs to the page itself; an
unclosed comment, script or style runs to the end of the page; an unclosed quote
in a tag ends where the tag does; a missing end tag ends with the element
around it; repeated rows, null ids and null urls stay as they are; of two
elements with equal scores the first counts; an empty table gives an empty
result; columns other than the three named are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm.shingles import chunks
from indicata.llm.store import small_batches

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style xmp iframe noembed noframes textarea title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr "
                   "output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br "
                   "base link meta param source track area col input".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = HEADINGS | frozenset("p pre li td th dt dd caption figcaption summary address".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt".split())
SCOPES = frozenset("table td th caption html body object template".split())
# An element of the key ends an open one of the names, unless a boundary lies between.
IMPLIED = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
           "option": (("option",), ("select",)), "tr": (("tr",), ("table",)),
           "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
           "tbody": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead"), ("table",))}
# What is never article text, by element, role and class or id word.
DROPPED = frozenset("nav footer aside form script style noscript template iframe object svg canvas audio video button "
                    "select textarea fieldset dialog menu head title xmp noembed noframes datalist map".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
                          "toolbar form".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot sponsor sponsored sponsors "
    "promo promos promotion banner sidebar sidebars nav navbar navigation menu menus submenu breadcrumb breadcrumbs "
    "footer masthead topbar toolbar comment comments commentlist disqus respond replies cookie cookies consent gdpr "
    "notice notices notification notifications alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations widget widgets pagination pager hidden copyright".split())
HEADER_WORDS = frozenset("header siteheader pageheader".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies".split())
ARTICLE_WORDS = frozenset("article content main post entry story text body hentry blog".split())
MODIFIERS = ("has-", "with-", "no-", "without-", "has_", "with_", "no_", "without_")
COMMENT_TITLE = re.compile(r"(?:\d+ )?(?:reader )?(?:comments?|kommentare?|comentarios?|commentaires?)(?: \(?\d+\)?)?:?$"
                           r"|leave a (?:comment|reply)", re.I)
WEIGHTS = {"article": 25, "main": 20, "section": 5, "div": 5, "td": 3, "blockquote": 3, "pre": 3,
           "ul": -3, "ol": -3, "dl": -3, "li": -3, "address": -3, "th": -5}
WORD_WEIGHT = 25
SHARES = (1, 1 / 2, 1 / 6, 1 / 9, 1 / 12)  # of a block's points, by the distance of the element
SIBLING_SHARE = 0.2  # of the best score, for a sibling to be kept
LONG_SIBLING = 80  # characters of a sibling paragraph that need not be a sentence
LINKED, LINKED_LIST, LIST_LINKS = 0.25, 0.8, 3  # shares of linked text; links that make a list

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in RAW_TEXT}
_COMMA = re.compile("[,،、，]")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """The tree of one page: lists by element (parents come before their
    children), and the blocks of text in page order."""

    def __init__(self, source: str):
        self.tag, self.parent, self.weight, self.classes = ["#page"], [-1], [0], [""]
        self.dropped = [False]  # by its element or role
        self.marked = [False]  # by its class or id words
        self.owner: list[int] = []  # per block: the block-level element around it
        self.text: list[str] = []
        self.linked: list[int] = []  # characters inside links
        self.links: list[int] = []  # links that start in the block
        self._pieces: list[str] = []
        self._linked = self._links = self._breaks = 0
        self._stack = [0]  # open elements
        self._open: dict[str, list[int]] = {}  # by name: their places in the stack
        self._blocks = [0]  # places of the block-level ones
        self._walls = [0]  # places that end tags do not reach beyond
        self._read(source)

    def _read(self, source: str) -> None:
        pos, last, tag = 0, source.rfind(">"), _TAG
        while True:
            at = source.find("<", pos)
            if at != pos:
                self._add(source[pos:] if at < 0 else source[pos:at])
            if at < 0:
                break
            after = source[at + 1: at + 2]
            if source.startswith("<!--", at):
                end = source.find("-->", at + 2)
                pos = len(source) if end < 0 else end + 3
            elif at > last or not (after in ("/", "!", "?") or after.isascii() and after.isalpha()):
                self._add("<")
                pos = at + 1
            else:
                m = tag.match(source, at)
                if m is None and (m := _PLAIN_TAG.match(source, at)) is not None:
                    tag = _PLAIN_TAG  # quotes are out of step: from here on they do not count
                if m is None:  # a declaration, or no name after the slash
                    pos = source.find(">", at) + 1
                    continue
                pos, name = m.end(), m[2].lower()
                if m[1]:
                    self._end(name)
                    continue
                self._start(name, m[3])
                if name in RAW_TEXT:
                    closing = _RAW_END[name].search(source, pos)
                    pos = closing.end() if closing else len(source)
                    self._end(name)
        self._close_block()

    def _add(self, text: str) -> None:
        text = html.unescape(text) if "&" in text else text
        self._pieces.append(text)
        if self._open.get("a"):
            self._linked += sum(map(len, text.split()))
        if self._breaks and not text.isspace():
            self._breaks = 0

    def _close_block(self) -> None:
        text = " ".join("".join(self._pieces).split())
        if text:
            self.owner.append(self._stack[self._blocks[-1]])
            self.text.append(text)
            self.linked.append(self._linked)
            self.links.append(self._links)
        self._pieces = []
        self._linked = self._links = self._breaks = 0

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self._pieces.append(" ")
            self._breaks += 1
            if self._breaks == 2:
                self._close_block()
            return
        if name == "a":
            self._end("a")
            self._links += 1
        if name in ENDS_P:
            self._end_open(("p",), ())
        if name in IMPLIED:
            self._end_open(*IMPLIED[name])
        if name in HEADINGS and self.tag[self._stack[-1]] in HEADINGS:
            self._pop()
        if name not in INLINE:
            self._close_block()
        if name in VOID:
            return
        dropped, marked, weight, classes = _judge(name, attributes)
        place, node = len(self._stack), len(self.tag)
        for column, value in ((self.tag, name), (self.parent, self._stack[-1]), (self.dropped, dropped),
                              (self.marked, marked), (self.weight, weight), (self.classes, classes)):
            column.append(value)
        self._open.setdefault(name, []).append(place)
        if name in SCOPES:
            self._walls.append(place)
        if name not in INLINE:
            self._blocks.append(place)
        self._stack.append(node)

    def _pop(self) -> None:
        name = self.tag[self._stack[-1]]
        if name not in INLINE:
            self._close_block()
            self._blocks.pop()
        self._open[name].pop()
        if name in SCOPES:
            self._walls.pop()
        self._stack.pop()

    def _end(self, name: str) -> None:
        places = self._open.get(name)
        if name == "br":
            self._start("br", "")
        elif places:
            wall = 0 if name in SCOPES else self._walls[-1]
            if places[-1] > wall and not (name in INLINE and places[-1] < self._blocks[-1]):
                self._pop_to(places[-1])

    def _end_open(self, names: tuple[str, ...], walls: tuple[str, ...]) -> None:
        wall = max([self._walls[-1], *(self._open[w][-1] for w in walls if self._open.get(w))])
        place = max([0, *(self._open[n][-1] for n in names if self._open.get(n))])
        if place > wall:
            self._pop_to(place)

    def _pop_to(self, place: int) -> None:
        while len(self._stack) > place:
            self._pop()

    # -- judging -------------------------------------------------------------

    def main_blocks(self) -> list[str]:
        """The blocks of the article, in page order."""
        gone = self._left_out()
        kept = [k for k, o in enumerate(self.owner) if not gone[o]]
        size, linked, links, points = self._sums(kept)
        density = lambda n: linked[n] / size[n] if size[n] else 0.0
        lists = [n > 0 and links[n] >= LIST_LINKS and density(n) >= LINKED_LIST
                 and t not in ("article", "main", "body", "html") for n, t in enumerate(self.tag)]
        inside = self._inherited(lists)
        score = [(p + w) * (1 - density(n)) if p else -math.inf
                 for n, (p, w) in enumerate(zip(points, self.weight))]
        best = max(range(len(score)), key=score.__getitem__)
        if score[best] == -math.inf:  # headings and links at most
            return [self.text[k] for k in kept if not inside[self.owner[k]]]
        best = self._article_around(best)
        same = [False] * len(self.tag)
        same[best] = True
        least = SIBLING_SHARE * score[best] if score[best] > 0 else math.inf
        above = self.parent[best]
        ending = {self.owner[k]: self.text[k][-1] for k in kept}
        if above >= 0 and self.tag[best] not in ("main", "body", "html"):
            for n in range(1, len(self.tag)):
                if self.parent[n] == above and size[n] and not gone[n]:
                    same[n] = same[n] or self._alike(n, best, score[n], least, size[n], density(n), ending)
        chosen = self._inherited(same)
        return [self.text[k] for k in kept if chosen[self.owner[k]] and not inside[self.owner[k]]]

    def _inherited(self, own: list[bool]) -> list[bool]:
        out = list(own)
        for n in range(1, len(out)):
            out[n] = out[n] or out[self.parent[n]]
        return out

    def _left_out(self) -> list[bool]:
        """Per element, whether it or one around it is no part of an article."""
        holds = [t == "main" or t == "article" and not m for t, m in zip(self.tag, self.marked)]
        heading = [t in HEADINGS for t in self.tag]
        for n in range(len(self.tag) - 1, 0, -1):
            holds[self.parent[n]] |= holds[n]
            heading[self.parent[n]] |= heading[n]
        within = self._inherited([t in ("article", "main") for t in self.tag])
        quoted = self._inherited([t == "blockquote" for t in self.tag])
        out = [False] * len(self.tag)
        for n, t in enumerate(self.tag):
            if t == "header" or self.classes[n] == "#header":
                out[n] = not (within[n] and heading[n]) and not holds[n]
            elif t == "footer" and quoted[n]:
                out[n] = False
            else:
                out[n] = self.dropped[n] or self.marked[n] and not holds[n] and t not in ("html", "body", "main")
        seen = set()
        for o, text in zip(self.owner, self.text):  # a part that begins with the title "Comments"
            part = self.parent[o]
            if self.tag[o] in HEADINGS and self.tag[part] in ("section", "div", "ol", "ul") and part not in seen \
                    and not holds[part] and COMMENT_TITLE.match(text):
                out[part] = True
            while part >= 0 and part not in seen:
                seen.add(part)
                part = self.parent[part]
        return self._inherited(out)

    def _sums(self, kept: list[int]) -> tuple[list[int], list[int], list[int], list[float]]:
        """Per element, over all blocks inside: characters, those in links, links; and its points."""
        size, linked, links = ([0] * len(self.tag) for _ in range(3))
        points = [0.0] * len(self.tag)
        for k in kept:
            o, text = self.owner[k], self.text[k]
            n_chars = len(text) - text.count(" ")
            size[o] += n_chars
            linked[o] += min(self.linked[k], n_chars)
            links[o] += self.links[k]
            if self.tag[o] in HEADINGS:
                continue
            given = 1 + len(_COMMA.findall(text)) + min(len(text) / 100, 3)
            at = self.parent[o] if self.tag[o] in PARAGRAPHS else o
            for share in SHARES:
                if at < 0:
                    break
                points[at] += given * share
                at = self.parent[at]
        for n in range(len(self.tag) - 1, 0, -1):
            p = self.parent[n]
            size[p] += size[n]
            linked[p] += linked[n]
            links[p] += links[n]
        return size, linked, links, points

    def _article_around(self, best: int) -> int:
        found, n = {}, best
        while n >= 0:
            found.setdefault(self.tag[n], n)
            n = self.parent[n]
        return found.get("article", found.get("main", best))

    def _alike(self, n: int, best: int, score: float, least: float, size: int, density: float,
               ending: dict[int, str]) -> bool:
        """Whether a sibling of the best container holds text of the same sort."""
        tag = self.tag[n]
        if tag in HEADINGS:
            return density < LINKED
        if tag == self.tag[best] and self.classes[n] == self.classes[best] and tag not in ("article", "body"):
            return density < LINKED
        if score >= least:
            return True
        if tag in ("p", "pre", "blockquote", "ul", "ol", "dl", "table", "figure"):
            return density < LINKED and size > LONG_SIBLING or density == 0 and ending.get(n, "") in set(".!?…")
        return False


def _judge(name: str, attributes: str) -> tuple[bool, bool, float, str]:
    """Of a start tag: dropped by element or role, marked by its words, the
    weight of its points, and its classes (``#header`` for a page header's)."""
    dropped, marked, weight, classes = name in DROPPED, False, WEIGHTS.get(name, 0), ""
    if not attributes or attributes.isspace():
        return dropped, marked, weight, classes
    values: dict[str, str] = {}
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        values.setdefault(key.lower(), a or b or c)
    hidden = "hidden" in values or values.get("aria-hidden", "").lower() == "true" or _HIDING.search(values.get("style", ""))
    dropped = dropped or bool(hidden) or values.get("role", "").lower().strip() in DROPPED_ROLES
    classes = " ".join(sorted(html.unescape(values.get("class", "")).split()))
    words = {w.lower() for c in [*classes.split(), html.unescape(values.get("id", ""))]
             if not c.lower().startswith(MODIFIERS) for w in _WORDS.findall(c)}
    if words:
        marked = not words.isdisjoint(DROPPED_WORDS) and (name != "article" or not words.isdisjoint(COMMENT_WORDS))
        if not words.isdisjoint(HEADER_WORDS) and name not in HEADINGS:
            classes = "#header"
        if not words.isdisjoint(ARTICLE_WORDS):
            weight += WORD_WEIGHT
    if values.get("role", "").lower().strip() in ("main", "article"):
        weight += WORD_WEIGHT
    return dropped, marked, weight, classes


def main_text(source: str | None) -> str:
    """The article's blocks, joined by two line feeds."""
    return "\n\n".join(Page(source).main_blocks()) if source else ""


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (its code points), one row per row of ``pages``."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                        F.col(source).cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "html"):
            found = [main_text(v) for v in b["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["page_id"], b["url"], pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
