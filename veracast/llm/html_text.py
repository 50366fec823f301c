"""Main-text extraction from web pages by scoring the element tree."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_stage, text_list

#: Elements whose content is no text of the page; fixed values.
RAW = frozenset("script style noscript template textarea iframe object svg math canvas title select button".split())
#: Of these, those whose content is plain letters up to the first end tag; the others hold elements. Fixed values.
LETTERS = frozenset("script style textarea iframe title".split())
#: Elements that are never part of an article; fixed values.
BESIDE = frozenset("nav footer aside form menu dialog fieldset head".split())
#: Elements that stand for a block of their own; fixed values.
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption address header hgroup details summary hr center nav footer aside form menu dialog fieldset".split()
)
#: Elements without an end tag; fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What a start tag closes if it is still open; fixed values.
CLOSES = {
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), "option": frozenset({"option"}),
}
_FENCE = frozenset("ul ol dl table tbody thead article section div main body".split())
#: Words of class, id and role that name what is not the article; fixed values.
BESIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent "
    "disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices alert pagination pager popup promo promotion "
    "related recommended reply replies respond share sharing sidebar sidebars social sponsor sponsored subscribe subscription toolbar "
    "topbar widget widgets complementary contentinfo search signup login overlay".split()
)
_TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_UNSEEN = re.compile(r"(?<![\w-])(?:display\s*:\s*none|visibility\s*:\s*hidden)(?![\w-])", re.I)
#: Words beside a word of BESIDE_WORDS in one class or id that make it the name of a wrapper; fixed values.
WRAPPER_WORDS = frozenset("with without no not has page pages results layout".split())
_HOLDERS = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)(" + "|".join(sorted(RAW - LETTERS)) + r")(?![a-zA-Z0-9:-])((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>",
    re.S | re.I,
)
_CUT_OFF = re.compile(r"<[/!a-zA-Z]")
_COMMAS = re.compile("[,،、，]")
_PIECES = re.compile(r"[A-Za-z][a-z]*|[a-z]+")


class Node:
    """A block element: its parent, whether it stands beside the article, what its class, id or role says
    about that (1: beside, 2: maybe a wrapper), its points, the points of all its text, text and link letters."""

    __slots__ = ("tag", "parent", "out", "named", "points", "worth", "letters", "links", "order")

    def __init__(self, tag: str, parent: Node | None, out: bool, named: int, order: int):
        self.tag, self.parent, self.out, self.named, self.order = tag, parent, out, named, order
        self.points, self.worth, self.letters, self.links = 0.0, 0.0, 0, 0


def _beside(tag: str, attributes: str, inside: str) -> bool:
    if tag in BESIDE or (tag == "header" and inside not in ("article", "main", "section")):
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value.strip("\"' ").lower() == "true") or (name == "style" and _UNSEEN.search(value)):
            return True
    return False


def _named(tag: str, attributes: str) -> int:
    """0 if no class, id or role names what is not the article, 1 if one does, 2 if all that do may name a wrapper."""
    if not attributes or tag in ("html", "body", "article", "main"):
        return 0
    found = 0
    for _, value in _NAMES.findall(attributes):
        for name in value.strip("\"'").split():
            words = {w.lower() for w in _PIECES.findall(name)}
            if not BESIDE_WORDS.isdisjoint(words):
                if WRAPPER_WORDS.isdisjoint(words):
                    return 1
                found = 2
    return found


def _worth(text: str, linked: int) -> float:
    return (1 + len(_COMMAS.findall(text)) + min(len(text) / 100, 3.0)) * (1 - linked / len(text))


class Page:
    """The blocks of a page in order, and the tree of block elements they hang in."""

    def __init__(self, source: str):
        self.root = Node("html", None, False, 0, 0)
        self.nodes = [self.root]
        self.blocks: list[tuple[Node, str, int]] = []
        self._parts: list[str] = []
        self._linked = self._in_link = 0
        self._stack = [self.root]
        at = 0
        self._source, self._held, self._endless = source, None, set()
        # Behind the last ">" no tag can end; looking for one there would take quadratic time.
        whole = source.rfind(">") + 1
        while token := _TOKENS.search(source, at, whole):
            if token.start() > at:
                self._text(source[at : token.start()])
            at = token.end()
            end, tag, attributes, end2, tag2, attributes2 = token.groups()
            name = (tag or tag2 or "").lower()
            if name in RAW:
                if not (end or end2):
                    self._parts.append(" ")
                    at = self._raw_end(name, token, (attributes or attributes2 or "").endswith("/"))
            elif name:
                self._close(name) if end or end2 else self._open(name, attributes or attributes2 or "")
            elif source.startswith("<!--", token.start()) and not token.group().endswith("-->"):
                at = len(source)
        rest = source[at:]
        cut = _CUT_OFF.search(rest)
        self._text(rest[: cut.start()] if cut else rest)
        self._flush()

    def _raw_end(self, name: str, start: re.Match, closed: bool) -> int:
        """Where the content of a raw element ends. One that is closed in its start tag has none, nor has one
        without an end tag; only code without an end tag goes on to the end of the page, as in a browser."""
        source, at = self._source, start.end()
        if name not in LETTERS:
            if self._held is None:
                self._held = self._pairs()
            return self._held.get(start.start(), at)
        if name in self._endless:
            ended = None
        elif closed:  # browsers pass over the slash: if the next such tag is an end tag, it belongs to this one
            ended = re.compile(rf"<(/?){name}(?![a-z0-9:-])[^>]*>", re.I).search(source, at)
            return ended.end() if ended and ended.group(1) else at
        else:
            ended = re.compile(rf"</{name}\s*>", re.I).search(source, at)
        if ended:
            return ended.end()
        self._endless.add(name)
        return len(source) if name in ("script", "style") and not closed else at

    def _pairs(self) -> dict[int, int]:
        """For raw elements that hold elements: where the start tags that have an end tag begin, and where that one ends."""
        out: dict[int, int] = {}
        left: dict[str, list[int]] = {}
        for token in _HOLDERS.finditer(self._source):
            _, end, name, attributes = token.groups()
            if name:
                begun = left.setdefault(name.lower(), [])
                if not end and not attributes.endswith("/"):
                    begun.append(token.start())
                elif end and begun:
                    out[begun.pop()] = token.end()
        return out

    def _text(self, text: str) -> None:
        text = html.unescape(text) if "&" in text else text
        self._parts.append(text)
        if self._in_link:
            self._linked += len(text.strip())

    def _flush(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                self.blocks.append((self._stack[-1], text, min(self._linked, len(text))))
            self._parts = []
        self._linked = 0

    def _open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._parts.append(" ")
        elif tag == "a":
            self._in_link = 1
        elif tag in BLOCKS:
            self._flush()
            stack = self._stack
            closes = CLOSES.get(tag)
            if closes:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in closes:
                        del stack[k:]
                        break
                    if stack[k].tag in _FENCE:
                        break
            elif stack[-1].tag == "p":
                stack.pop()
            if tag not in VOID:
                above = stack[-1]
                node = Node(tag, above, above.out or _beside(tag, attributes, above.tag), _named(tag, attributes), len(self.nodes))
                self.nodes.append(node)
                stack.append(node)
            self._in_link = 0

    def _close(self, tag: str) -> None:
        if tag == "a":
            self._in_link = 0
        elif tag in BLOCKS:
            self._flush()
            for k in range(len(self._stack) - 1, 0, -1):
                if self._stack[k].tag == tag:
                    del self._stack[k:]
                    break

    def _judge_names(self) -> None:
        """Elements whose names say that they stand beside the article go out, but not those that hold most
        of the page's points: half if the name may be a wrapper's, nine tenths otherwise. Where names would
        leave less than a tenth of the points, none counts."""
        named = [n for n in self.nodes if n.named and not n.out]
        if not named:
            return
        open_blocks = [(node, _worth(text, linked)) for node, text, linked in self.blocks if not node.out]
        for node, worth in open_blocks:
            above: Node | None = node
            while above is not None:
                above.worth += worth
                above = above.parent
        total = self.root.worth
        for node in named:
            node.out = node.worth <= (0.5 if node.named == 2 else 0.9) * total
        gone = [n.order for n in named if n.out]
        below: dict[int, bool] = {}
        for node in self.nodes:
            below[node.order] = node.out or (node.parent is not None and below[node.parent.order])
        if sum(worth for node, worth in open_blocks if not below[node.order]) < 0.1 * total:
            for order in gone:
                self.nodes[order].out = False

    def main_text(self) -> str:
        """Paragraphs pass points for length and commas to their ancestors, half as many at each level;
        letters in links take points away. The best article or main element and those like it are the article; without one, the best
        container and all around it that is not mostly links."""
        self._judge_names()
        for node in self.nodes[1:]:
            node.out = node.out or node.parent.out
        for node, text, linked in self.blocks:
            if not node.out:
                above: Node | None = node
                while above is not None:
                    above.letters += len(text)
                    above.links += linked
                    above = above.parent
        for node in self.nodes:
            # A list or table made of links is a menu, wherever it stands.
            if node.tag in ("ul", "ol", "dl", "table") and node.letters and node.links > 0.8 * node.letters:
                node.out = True
        for node in self.nodes[1:]:
            node.out = node.out or node.parent.out
        kept = [(node, text, linked) for node, text, linked in self.blocks if not node.out]
        for node, text, linked in kept:
            worth = _worth(text, linked)
            # A block's own element is no container, unless the text stands in it bare.
            holder = node.parent if node.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "li", "td", "dd", "dt") else node
            share, above = 1.0, holder or node
            while above is not None and share >= 1 / 64:
                above.points += worth * share
                above, share = above.parent, share / 2
        if not kept:
            return ""

        def score(node: Node) -> float:
            density = node.links / node.letters if node.letters else 0.0
            return node.points * (1 - density)

        open_nodes = [n for n in self.nodes if not n.out and n.letters]
        articles = [n for n in open_nodes if n.tag in ("article", "main")]
        best = max(articles or open_nodes, key=lambda n: (score(n), -n.order))
        limit = max(10.0, 0.2 * score(best))
        chosen = {best.order}
        on_path: set[int] = set()
        if not articles:
            # Points choose the article but do not cut it: beside the best container and each one around it,
            # all that is not mostly links stays, however short.
            children: dict[int, list[Node]] = {}
            for node in open_nodes:
                if node.parent is not None:
                    children.setdefault(node.parent.order, []).append(node)
            above = best.parent
            while above is not None:
                on_path.add(above.order)
                chosen |= {n.order for n in children.get(above.order, ()) if n.order not in on_path and (n.links < 0.5 * n.letters or score(n) >= limit)}
                above = above.parent
        else:
            chosen |= {n.order for n in articles if n.tag == best.tag and score(n) >= limit}
        inside: dict[int, bool] = {}
        for node in self.nodes:
            inside[node.order] = node.order in chosen or (node.parent is not None and inside[node.parent.order])
        return "\n\n".join(text for node, text, linked in kept if inside[node.order] or (node.order in on_path and linked < 0.5 * len(text)))


def main_text(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: the main text of each page's whole html.

    Blocks are in page order, joined by an empty line; white space inside one is a single space and
    character references are decoded. A null or empty page, or one without text outside of menus and
    the like, has the empty text; a class, id or role alone does not empty a page. Unclosed elements end where their surroundings end. Every input row
    gives one row, repeated ids too; an empty table gives an empty result.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(x) for x in text_list(batch.column("html"))]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return arrow_stage(own, work, "page_id long, url string, text string, n_chars long")
