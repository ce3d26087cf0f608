"""Main text of HTML pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass calls each block good, bad or short
from the region that it is in, its length, its link density and the density of stop words. In the
second pass short blocks, which these say little about, take the label of the nearest decided
neighbours. Names of class, id and role are evidence beside the densities: an element that they put
beside the text is so however long it is, unless nothing else on the page is prose; marks of the
main text lower the limits within, and blocks outside of it are judged by their densities where it
holds less prose than they do.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.text import add_columns

# Rules of the first pass: characters, and shares.
SHORT = 70
LONG = 200
MOST_LINKS = 0.5
SOME_STOPS = 0.15
MANY_STOPS = 0.30
# Within the marked text.
MARKED_STOPS = 0.05
# Below this share on a whole page, its language is one without a list of stop words.
NO_LIST = 0.05

# Elements that hold no text, or text that is not shown.
HIDDEN = {
    "script", "style", "noscript", "template", "svg", "math", "canvas", "iframe", "object", "head", "title",
    "select", "option", "button", "textarea", "datalist", "audio", "video", "map",
}
# Of these the content is not markup.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template"}
# Elements without an end tag.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
# Elements within a line of text.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
    "sub", "sup", "time", "tt", "u", "var", "wbr",
}
# Elements beside the main text.
ASIDE = {"nav", "footer", "aside", "form", "dialog", "menu", "fieldset"}
MAIN = {"article", "main"}
# Elements whose text is no prose.
BARE = ASIDE | HIDDEN
# Words of class, id and role that name parts beside the main text.
ASIDE_NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb",
    "breadcrumbs", "byline", "comment", "comments", "commentlist", "complementary", "contentinfo", "consent",
    "cookie", "cookies", "copyright", "discussion", "disqus", "dialog", "footer", "form", "gdpr", "header",
    "legal", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "notification", "pager", "pagination", "popup", "promo", "promoted", "promotion", "recommended", "related",
    "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor",
    "sponsored", "subscribe", "subscription", "tags", "toolbar", "topbar", "widget", "widgets",
}
# Those of them that name parts with articles of their own.
OWN_ARTICLES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "comment", "comments", "commentlist",
    "discussion", "disqus", "promo", "promoted", "promotion", "recommended", "related", "replies", "reply", "respond",
    "sponsor", "sponsored",
}
# Words of class, id and role that name the main text.
MAIN_NAMES = {"article", "content", "entry", "main", "post", "story", "body"}
# Frequent words of some languages.
STOP_WORDS = set(
    """a about after all also an and are as at be been but by can could for from had has have he her his how i if in
    into is it its more no not of on one or other our out she so some such than that the their them then there these
    they this to up was we were what when which who will with would you your
    au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais me ne nous on ou
    par pas pour qu que qui sa se ses son sont sur te un une vous y
    al algo como con cual cuando del desde donde el ella ellos entre era es esta este esto hay las lo los mas mi muy
    o para pero por porque sin sobre su sus tambien tiene todo una uno ya
    aber alle als am auch auf aus bei bin bis das dass dem den der die dies durch ein eine einem einen einer er
    ist kann man mit nach nicht noch nur oder sein sich sie sind um und uns unter vom von vor war wenn werden wie
    wir wird zu zum zur über für""".split()
)

# Words before a name that say what a layout has, not what the element is.
LAYOUT = {"has", "with", "without", "no", "is", "layout", "show", "hide"}

_MARKUP = re.compile(r"<!--|<!|<\?|</?[A-Za-z]")
_NAME = re.compile(r"[^\s/>]+")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_TAG_END = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*>""")
_PART = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"\w+")


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    zone: int = 0  # 1 in the main text, -1 beside it, 0 in neither
    heading: bool = False
    text: str = ""
    label: str = ""
    counted: tuple[int, int] | None = None  # stop words and words


# Regions while a page is read, beside those of a block: beside the main text by name only, where an
# article may be the main text after all; and within such an article.
NAMED, REOPENED = -2, 2


def _zone(tag: str, attributes: str, around: int, ignored: bool) -> tuple[int, bool, bool]:
    """Region that an element opens, whether its names alone put it beside the main text, and whether
    these are of OWN_ARTICLES.

    One beside the main text stays so for all within it, but for articles in one that is so by name.
    """
    if around == -1 or tag in ASIDE or (tag == "header" and around == 0):
        return -1, False, False
    names: set[str] = set()
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            key = m[1].lower()
            if key == "hidden" or (key == "aria-hidden" and m[2] and "true" in m[2]):
                return -1, False, False
            if key == "style" and m[2] and "display:none" in m[2].replace(" ", "").lower():
                return -1, False, False
            if key in ("class", "id", "role") and m[2]:
                for word in m[2].strip("\"'").split():
                    parts = _PART.findall(_CAMEL.sub("-", word).lower())
                    if parts and parts[0] not in LAYOUT:
                        names.update(parts)
    if tag in ("html", "body"):
        return around, False, False
    own = bool(names & OWN_ARTICLES)
    beside = bool(names & ASIDE_NAMES) and not ignored
    if tag in MAIN and not (beside and not names & MAIN_NAMES):
        # Readers' comments may be articles within an article.
        if around == NAMED:
            return (NAMED, True, own) if beside else (1 if tag == "main" else REOPENED, False, False)
        return max(around, 1), False, False
    if beside:
        return (-1 if around > 0 or own else NAMED), True, own
    return (max(around, 1) if names & MAIN_NAMES and around >= 0 else around), False, False


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order, those without text left out."""
    found, named, prose = _blocks(page, frozenset())
    # Where nothing else is prose, the names of an element that holds most of it mean something
    # else; comments and the like last, which may be longer than a text of one short line.
    most = [(at, own) for at, (size, own) in named.items() if 2 * size > prose]
    wrong = frozenset(at for at, own in most if not own)
    if wrong and not any(_may_be_text(b, SHORT) for b in found):
        found = _blocks(page, wrong)[0]
    if len(wrong) < len(most) and not any(_may_be_text(b, 1) for b in found):
        found = _blocks(page, frozenset(at for at, _ in most))[0]
    marked = any(b.zone == 1 and len(b.text) >= SHORT for b in found)
    for b in found:
        if b.zone == REOPENED:
            b.zone = -1 if marked else 1
        elif b.zone == NAMED:
            b.zone = -1
    return found


def _may_be_text(block: Block, size: int) -> bool:
    """Whether a block that is not beside the main text has so many characters outside of links."""
    beside = block.zone in (-1, NAMED) or block.heading or _links(block) > MOST_LINKS
    return not beside and len(block.text) >= size


def _blocks(page: str, ignored: frozenset[int]) -> tuple[list[Block], dict[int, tuple[int, bool]], int]:
    """Blocks; by place the prose of elements beside the main text by name, and whether their names
    are of OWN_ARTICLES; and all prose.

    Prose are characters outside of links and of elements that hold none. Names of the elements at
    the places ``ignored`` do not count.
    """
    out: list[Block] = []
    current = Block()
    # Tag, region around it, and for elements counted in ``named`` their place.
    stack: list[tuple[str, int, int | None]] = []
    named: dict[int, tuple[int, bool]] = {}
    still_open: Counter[str] = Counter()
    zone, links, breaks, prose, bare = 0, 0, 0, 0, 0

    def leave(depth: int) -> None:
        nonlocal zone, bare
        zone = stack[depth][1]
        for tag, _, place in stack[depth:]:
            if place is not None:
                before, own = named[place]
                named[place] = prose - before, own
            bare -= tag in BARE
            still_open[tag] -= 1
        del stack[depth:]

    def close() -> None:
        nonlocal current
        out.append(current)
        current = Block(zone=zone, heading=bool(stack) and stack[-1][0] in ("h1", "h2", "h3", "h4", "h5", "h6"))

    def add(raw: str) -> None:
        nonlocal breaks, prose
        text = html.unescape(raw)
        if text and not text.isspace():
            breaks = 0
            size = len("".join(text.split()))
            if links:
                current.link_chars += size
            elif not bare:
                prose += size
        current.parts.append(text)

    at = 0
    while at < len(page):
        m = _MARKUP.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        if m[0] == "<!--":
            end = page.find("-->", m.end())
            at = end + 3 if end >= 0 else len(page)
            continue
        if m[0] in ("<!", "<?"):
            end = page.find(">", m.end())
            at = end + 1 if end >= 0 else len(page)
            continue
        closing = m[0][1] == "/"
        name = _NAME.match(page, m.end() - 1)
        tag = name[0].lower()
        end = _TAG_END.match(page, name.end())
        if not end:
            # An unclosed quote, or a page that was cut off within a tag.
            plain = page.find(">", name.end())
            if plain < 0:
                break
            attributes, at = page[name.end() : plain], plain + 1
        else:
            attributes, at = page[name.end() : end.end() - 1], end.end()
        if not closing and tag in RAW:
            found = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = found.end() if found else len(page)
            current.parts.append(" ")
            continue
        if tag == "br":
            breaks += 1
            current.parts.append(" ")
            if breaks > 1:
                close()
            continue
        if tag in VOID:
            if tag == "hr":
                close()
            continue
        if tag == "a":
            links = 0 if closing else 1
        if closing:
            # An end tag closes what was left open within its element; a stray one closes nothing.
            if still_open[tag]:
                leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
        else:
            if tag == "p" or tag == "li":
                # A paragraph or item ends at the next one.
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        leave(i)
                        break
                    if stack[i][0] not in INLINE and stack[i][0] != "p":
                        break
            around, by_name, own = zone, False, False
            if tag in HIDDEN and tag != "head":
                zone = -1
            else:
                zone, by_name, own = _zone(tag, attributes, zone, at in ignored)
            stack.append((tag, around, at if by_name else None))
            bare += tag in BARE
            still_open[tag] += 1
            if by_name:
                named[at] = prose, own
        if tag not in INLINE:
            links = 0
            close()
        elif zone != current.zone:
            # A marked part within a line.
            text_before = "".join(current.parts).strip()
            if text_before:
                close()
            else:
                current.zone = zone
    out.append(current)
    if stack:
        leave(0)
    kept = []
    for block in out:
        block.text = " ".join("".join(block.parts).split())
        if block.text:
            kept.append(block)
    return kept, named, prose


def _links(block: Block) -> float:
    return block.link_chars / max(1, len(block.text.replace(" ", "")))


def _stops(block: Block) -> tuple[int, int]:
    """Stop words and words."""
    if block.counted is None:
        tokens = _WORD.findall(block.text.lower())
        block.counted = sum(t in STOP_WORDS for t in tokens), len(tokens)
    return block.counted


def _size(text: str) -> int:
    """Characters, those of scripts that write a word in one or two as three."""
    return len(text) if text.isascii() else len(text) + 2 * sum(c >= "\u2e80" for c in text)


def _first_pass(block: Block, listed: bool) -> str:
    size = len(block.text)
    if block.zone < 0 or _links(block) > MOST_LINKS:
        return "bad"
    if block.zone > 0:
        if size < SHORT or block.heading:
            return "short"
        # A long block without any stop word is a table, a list of names or the like: as its neighbours are.
        count, words = _stops(block) if listed else (1, 1)
        return "good" if count >= MARKED_STOPS * words else "short"
    if not listed:
        size = _size(block.text)
    if size < SHORT or block.heading:
        return "short" if not block.link_chars else "bad"
    if not listed:
        return "good" if size >= LONG else "short"
    count, words = _stops(block)
    stops = count / max(1, words)
    if stops >= MANY_STOPS or (stops >= SOME_STOPS and size >= LONG):
        return "good"
    return "short" if stops >= SOME_STOPS else "bad"


def _listed(found: list[Block]) -> bool:
    """Whether a page's language is one with a list of stop words."""
    stops = words = 0
    for b in found:
        if b.zone >= 0 and _size(b.text) >= SHORT and _links(b) <= MOST_LINKS:
            count, size = _stops(b)
            stops, words = stops + count, words + size
    return stops >= NO_LIST * words


def label(found: list[Block]) -> list[Block]:
    """Blocks with their labels, good or bad."""
    listed = _listed(found)
    prose = [0, 0]
    for b in found:
        b.label = _first_pass(b, listed)
        if b.label == "good":
            prose[b.zone > 0] += len(b.text)
    marked = any(b.zone > 0 for b in found) and prose[1] >= prose[0]
    if marked:
        # Where the page marks its main text, the rest is beside it.
        for b in found:
            if b.zone == 0:
                b.label = "bad"
    # Within the marked text only decided blocks of that text are neighbours.
    pool = [i for i, b in enumerate(found) if b.label != "short" and (not marked or b.zone > 0)]
    labels = {}
    k = 0
    for i, b in enumerate(found):
        if b.label != "short":
            continue
        while k < len(pool) and pool[k] < i:
            k += 1
        before = pool[k - 1] if k else None
        after = pool[k] if k < len(pool) else None
        if before is None and after is None:
            labels[i] = "good" if marked else "bad"
        elif before is None or after is None:
            labels[i] = found[before if after is None else after].label
        elif b.heading:
            labels[i] = found[after].label
        else:
            near, far = (before, after) if i - before < after - i else (after, before)
            same_distance = i - before == after - i
            if same_distance and found[near].label != found[far].label:
                labels[i] = "good" if b.zone > 0 else "bad"
            else:
                labels[i] = found[near].label
    for i, value in labels.items():
        found[i].label = value
    return found


def main_text(page: str | None) -> str:
    """Text of a page's good blocks, each with single spaces, joined by line ends."""
    return "\n".join(b.text for b in label(blocks(page or "")) if b.label == "good")


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` with ``main_text`` and ``main_chars`` (code points).

    A null or empty page, and one without main text, gives an empty text. Whole pages are read;
    other columns are kept. Rows stand for themselves: repeated pages and null ids give a row each.
    """

    def compute(texts: pa.Array) -> list[pa.Array]:
        out = [main_text(t) for t in texts.to_pylist()]
        return [pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())]

    rows = pages.withColumn(column, F.col(column).cast("string"))
    return add_columns(rows, compute, "main_text string, main_chars long", column)
