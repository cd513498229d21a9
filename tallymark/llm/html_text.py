"""Main text of web pages by consensus of the pages of a host.

Each page is cut into blocks of text, each with the elements it lies in. An element scores by the text of its blocks that
read like an article, less those that do not, and the best element of a page votes for its path: tags with their classes
from the page's body down, numbers in classes generalised. Spark adds the votes up per host, and every page is extracted
again from the elements whose path won, so a page that would have been misread alone follows the template of its host.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.frames import slices, texts
from tallymark.operators.joins import checkpointed_lookup

_QUOTED = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+'|["'])[^>"']*+)*+"""
_TAG = re.compile(rf"<!--(?:.*?--!?>|.*$)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)({_QUOTED})(?:>|$)", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s/=]|$)", re.IGNORECASE)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in "script style textarea title noframes iframe xmp".split()}

DEEPEST = 200
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_LEAVES = _HEADINGS | frozenset("p li dd dt pre blockquote figcaption td th caption".split())
_BLOCKS = _LEAVES | frozenset(
    "address article aside body center details dialog dir div dl fieldset figure footer form header hgroup hr html legend "
    "main menu nav ol section summary table tbody tfoot thead tr ul option".split()
)
#: An element of the first kind ends open ones of the second, up to the nearest of the third.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dd": (("dd", "dt"), ("dl",)),
    "dt": (("dd", "dt"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "datalist")),
}

# What never belongs to an article, by tag and by role, and what rarely does, by word in a class or id.
_DROPPED_TAGS = frozenset(
    "head nav footer aside script style noscript template svg canvas object select button textarea dialog iframe menu "
    "datalist audio video noframes title".split()
)
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar toolbar".split())
_DROPPED_WORDS = frozenset(
    "ad ads adv adsense alert banner consent disclaimer discussion gdpr login masthead menu modal nav navigation notice "
    "notices overlay pager pagination paywall popup recommendations recommended related replies respond share sharing "
    "signin signup skip social tags toolbar topbar tracking trending".split()
)
_DROPPED_STARTS = (
    "advert breadcrumb comment cookie disqus footer navbar newsletter promo sidebar sponsor subscri widget".split()
)
_COMMENTARY = ("commentar", "commentat")  # an article's own words, unlike other ones with that start
_OF_READERS = ("comment", "disqus", "respond", "replies")
_NEVER_DROPPED = frozenset("html body main article".split())
_WORD = re.compile(r"[a-z]+")
_ANNOTATION_END = re.compile(r"</annotation(?:-xml)?(?=[\s/>])", re.IGNORECASE)
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


class Element:
    """``dropped`` with all below it by tag or role. ``doubted`` is the nearest element that a word of a class or id speaks
    against, itself or above; whether it goes is decided when the whole page is known (:func:`_spare`)."""

    __slots__ = ("tag", "parent", "path", "dropped", "head_only", "form", "depth", "gain", "inside", "holds",
                 "doubted", "by_id", "readers", "plain", "spared")

    def __init__(self, tag: str, parent: Element | None, attributes: dict[str, str]):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.gain = 0
        up = parent or self
        self.dropped = bool(parent) and parent.dropped
        self.head_only = bool(parent) and parent.head_only
        self.form = (bool(parent) and parent.form) or tag == "form"
        self.doubted = parent.doubted if parent else None
        self.holds, self.by_id, self.readers, self.plain, self.spared = "", "", False, True, False
        kind = "main" if attributes.get("role", "").lower() == "main" else tag
        self.inside = kind in ("main", "article") or (bool(parent) and parent.inside)
        if kind in ("main", "article"):
            for e in ancestors(parent):
                e.holds = kind if e.holds != "main" else e.holds
        names = attributes.get("class", "")
        label = tag
        if names:
            label += "." + ".".join(sorted({re.sub(r"\d+", "#", n) for n in names.split()}))
        self.path = f"{up.path}/{label}" if parent and tag not in ("html", "body") else label
        if tag in _NEVER_DROPPED:
            return
        if (
            tag in _DROPPED_TAGS
            or attributes.get("role", "").lower() in _DROPPED_ROLES
            or "hidden" in attributes
            or "display:none" in attributes.get("style", "").replace(" ", "").lower()
        ):
            self.dropped = True
            return
        own_id = attributes.get("id", "") if tag not in _HEADINGS and tag != "p" else ""  # those of headings are its text
        header = False
        for place, name in enumerate([*names.split(), *own_id.split()]):
            words = _WORD.findall(_CAMEL.sub(" ", name).lower())
            if words and words[0] in ("has", "with", "no", "without"):
                continue
            begun = [w for w in words if w.startswith(tuple(_DROPPED_STARTS)) and not w.startswith(_COMMENTARY)]
            if begun or not _DROPPED_WORDS.isdisjoint(words):
                self.doubted, self.plain = self, not begun
                self.by_id = own_id if place >= len(names.split()) else ""
                self.readers = any(w.startswith(_OF_READERS) and not w.startswith(_COMMENTARY) for w in words)
                return
            header = header or "header" in words
        if header or tag == "header":  # the head of the page goes; of the head of an article its headings stay
            if any(e.tag in ("article", "main") for e in ancestors(self)):
                self.head_only = True
            elif tag == "header":
                self.dropped = True
            else:
                self.doubted = self


def ancestors(element: Element | None) -> Iterator[Element]:
    while element is not None:
        yield element
        element = element.parent


class Block:
    __slots__ = ("element", "leaf", "text", "linked")

    def __init__(self, element: Element, leaf: str, text: str, linked: int):
        self.element, self.leaf, self.text, self.linked = element, leaf, text, linked


def blocks(page: str) -> list[Block]:
    """The blocks of a page in their order; their text has character references decoded and single spaces."""
    found: list[Block] = []
    stack = [Element("body", None, {})]
    inline: list[str] = []  # open inline elements, of which only links matter
    pieces: list[str] = []
    deeper: list[str] = []  # elements below ``DEEPEST``, which count as part of the one there
    linked = 0
    annotated = True  # whether an end of an annotation may follow

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                leaf = next((e.tag for e in reversed(stack) if e.tag in _LEAVES), "")
                found.append(Block(stack[-1], leaf, text, linked))
            pieces.clear()
        linked = 0

    def close(tags: tuple[str, ...], within: tuple[str, ...]) -> None:
        end = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in within:
                break
            if stack[i].tag in tags:
                end = i
        if end is not None:
            del stack[end:]

    at, n = 0, len(page)
    while at < n:
        match = _TAG.search(page, at)
        if match is None:
            pieces.append(page[at:])
            break
        if match.start() > at:
            pieces.append(page[at : match.start()])
            if "a" in inline:
                linked += match.start() - at
        at = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1]:
            if tag in _BLOCKS or tag in _DROPPED_TAGS:
                flush()
                if deeper:
                    if tag in deeper:
                        while deeper.pop() != tag:
                            pass
                    continue
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        del stack[i:]
                        inline.clear()
                        break
            elif tag in inline:
                inline.remove(tag)
            continue
        if tag in ("br", "img", "wbr"):
            pieces.append(" " if tag != "wbr" else "")
            continue
        if tag in ("annotation", "annotation-xml") and annotated:  # the source of a formula, which no one sees
            end = _ANNOTATION_END.search(page, at)
            at, annotated = (end.start(), True) if end else (at, False)
            continue
        if tag not in _BLOCKS and tag not in _DROPPED_TAGS:
            if tag not in _VOID and tag == "a":
                inline.append(tag)
            continue
        flush()
        if tag in _BLOCKS:
            close(("p",), ("td", "th", "button", "table"))
            inline.clear()
        if tag in _CLOSES:
            close(*_CLOSES[tag])
        if tag in _VOID:
            continue
        attributes = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(match[3])}
        if _HIDDEN.search(match[3]):
            attributes["hidden"] = ""
        if tag in ("html", "body"):
            if len(stack) > 1 and stack[-1].tag == "head":  # an unclosed head
                del stack[1:]
            continue
        if stack[-1].tag == "head" and tag not in _DROPPED_TAGS:
            del stack[-1]
        if tag in _RAW_END:
            end = _RAW_END[tag].search(page, at)
            at = end.start() if end else n
        if match[3].endswith("/") and tag == "svg":
            continue
        if len(stack) < DEEPEST:
            stack.append(Element(tag, stack[-1], attributes))
        else:
            deeper.append(tag)
    flush()
    return found


def _doubts(block: Block) -> Iterator[Element]:
    """The doubted elements that a block lies in, from the inside."""
    doubted = block.element.doubted
    while doubted is not None:
        yield doubted
        doubted = doubted.parent.doubted if doubted.parent else None


def _spare(found: list[Block]) -> None:
    """Spare those doubted elements that hold the article, or are sections of it with an id made from a heading.

    An element stays that holds a main element. If no article is left without doubt, one stays that holds an article or
    more than half of the prose of the page, comments of readers excepted. Marked by its id alone, one stays that has more
    prose than else and is a section or begins with a heading of that name.
    """
    inside: dict[Element, list[Block]] = {}
    total, sure = 0, False
    for block in found:
        worth = _worth(block)
        total += max(worth, 0)
        sure = sure or (block.element.doubted is None and block.element.inside and worth > 0)
        for element in _doubts(block):
            inside.setdefault(element, []).append(block)
    for element, own in inside.items():
        worth = [_worth(b) for b in own]
        most = 2 * sum(w for w in worth if w > 0) > total
        if element.holds == "main":
            element.spared = True
        elif not element.readers and not sure and not element.inside and (element.holds or most):
            element.spared = True
        elif element.by_id and not element.readers and sum(worth) > 0:
            heading = own[0].leaf in _HEADINGS and _slug(own[0].text) == _slug(element.by_id)
            element.spared = heading or (element.tag == "section" and element.plain)


def _slug(text: str) -> list[str]:
    return re.findall(r"\w+", text.lower().replace("_", " "))


def _kept(found: list[Block]) -> list[Block]:
    """Blocks that may belong to an article; forms count only on pages that are one form as a whole.

    Words of classes and ids never leave a page without text.
    """
    found = [b for b in found if not b.element.dropped]
    _spare(found)
    kept = [b for b in found if not (b.element.head_only and b.leaf not in _HEADINGS) and all(e.spared for e in _doubts(b))]
    kept = kept or found
    outside = [b for b in kept if not b.element.form]
    inside = sum(len(b.text) for b in kept) - sum(len(b.text) for b in outside)
    return outside if inside <= 2 * sum(len(b.text) for b in outside) or inside < 500 else kept


def _worth(block: Block) -> int:
    """Letters of a block, negative if it does not read like an article: mostly links, or short and in no paragraph."""
    size = len(block.text)
    prose = block.linked <= 0.4 * size and (block.leaf not in ("", "td", "th") or size >= 100)
    return size if prose else -size


def best_path(page: str) -> str | None:
    """Path of the element with the most article-like text, the innermost of equals; None for a page without text."""
    best: Element | None = None
    for block in (found := _kept(blocks(page))):
        worth = _worth(block)
        for element in ancestors(block.element):
            element.gain += worth
    for block in found:
        for element in ancestors(block.element):
            if element.tag not in _LEAVES or element.tag in ("td", "blockquote"):
                if best is None or (element.gain, element.depth) > (best.gain, best.depth):
                    best = element
    return best.path if best is not None else None


def main_text(page: str, paths: dict[str, float]) -> str:
    """Text of the elements on the most voted of ``paths`` that the page has; on its own best path if it has none.

    Of paths with at least half the votes of the most voted one, that with the most votes times text counts.
    """
    found = _kept(blocks(page))
    under: dict[str, list[Block]] = {}
    for block in found:
        for path in {e.path for e in ancestors(block.element)}:
            under.setdefault(path, []).append(block)
    most = max((votes for p, votes in paths.items() if p in under), default=0.0)
    close = [(votes * max(1, sum(map(_worth, under[p]))), p) for p, votes in paths.items() if p in under and 2 * votes >= most]
    path = max(close)[1] if close else best_path(page)
    return "\n".join(b.text for b in under.get(path, []))


def host_of(url: Column) -> Column:
    """Host of an address in lower case, without port and user; the empty text if there is none."""
    found = F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(found, F.lit(""))


def extract(
    pages: DataFrame, *, url: str = "url", page: str = "html", name: str = "text", least_share: float = 0.05
) -> DataFrame:
    """``pages`` without ``page``, with its main text as ``name``; a column of that name is replaced.

    Paths with at least ``least_share`` of the votes of a host win (so at most ``1 / least_share`` for each host);
    :func:`main_text` chooses among those that a page has. Pages without a host vote together.
    A null or empty page has the empty text, repeated pages vote repeatedly, and an empty table gives none. Pages of any
    length are read whole, in time proportional to their length.
    """
    kept = [c for c in pages.columns if c != page and c.lower() != name.lower()]
    rows = pages.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"),
        host_of(F.col(f"`{url}`")).alias("host"),
        F.col(f"`{page}`").alias("page"),
    )

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "page"):
            paths = pa.array([best_path(p) for p in texts(batch, "page")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("host"), paths], ["host", "path"])

    votes = rows.select("host", "page").mapInArrow(vote, "host string, path string")
    votes = votes.where("path is not null").groupBy("host", "path").agg(F.count("*").alias("votes"))
    totals = votes.groupBy("host").agg(
        F.sum("votes").alias("total"), F.max_by("path", F.struct("votes", "path")).alias("first")
    )
    winners = (
        votes.join(totals, "host")
        .where((F.col("votes") >= least_share * F.col("total")) | (F.col("path") == F.col("first")))
        .groupBy("host")
        .agg(F.array_sort(F.collect_list(F.struct("path", (F.col("votes") / F.col("total")).alias("share")))).alias("paths"))
    )
    joined = rows.join(checkpointed_lookup(winners), "host", "left").select("row", "page", "paths")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "page"):
            lists = batch.column("paths").to_pylist()
            out = [
                main_text(p, {x["path"]: x["share"] for x in own or []})
                for p, own in zip(texts(batch, "page"), lists, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], ["row", "text"])

    out = joined.mapInArrow(read, joined.select("row", F.lit("").alias("text")).schema)
    return out.select(*(F.col("row").getField(c).alias(c) for c in kept), F.col("text").alias(name))
