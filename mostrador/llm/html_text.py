"""Main text of web pages by two-pass block rules (operator 4).

A page is cut into blocks at block-level tags. Blocks inside parts that say what they are (menus, headers and footers of
the page, sidebars, notices, adverts, forms, reader comments) are decided from that. The first pass classes every other
block by itself: many links make it bad, enough length with enough stop words make it good, and blocks too short to
tell stay open, leaning by their stop words. In the second pass open blocks take the label of their nearest decided
neighbours; between neighbours that differ they follow the lean, or the part of the page they stand in.

What a part says is a claim: one that holds most of the page's prose is not believed, and a main part inside of one that is
believed counts for itself. In a main part, a name that is about something else by its last word (``related-work``) is a weak claim,
not believed of a part that is prose for the most part. Only hidden parts are never read.
"""

from __future__ import annotations

import html as references
import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import narrow

#: Characters of a block that is long, and of one that is short.
LONG, SHORT = 70, 60
#: Share of link characters that makes a block bad.
LINKS = 0.33
#: Shares of stop words that are high and low.
STOP_HIGH, STOP_LOW = 0.30, 0.12

# Frequent words of English, French, German, Spanish, Italian and Portuguese.
STOP_WORDS = frozenset(
    """the of and to in a is that it for was on are as with be by at this from or an have not they which you he his her had
    but we were their has its will would there can all if one been when who so no more out up into them
    le la les de des du un une et en que qui dans pour est sur par au avec pas plus ne ce il elle se son sa ses aux mais ou
    der die das und von zu den mit im ist nicht auf ein eine dem des als auch es an werden aus er hat dass sie nach bei um
    el los las y del se por con para una su al lo como más o pero sus este ya está entre cuando muy sin sobre
    il di che non per del della sono con gli alla nel si da come anche ma
    os do da em um uma não com na no dos mais foi ao""".split()
)

# HTML elements.
BLOCK_TAGS = frozenset(
    """address article aside blockquote body button canvas caption center col colgroup dd details dialog dir div dl dt
    fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li link main
    menu meta nav noframes ol option optgroup p pre search section select summary table tbody td textarea tfoot th thead
    title tr ul""".split()
)
VOID_TAGS = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
#: Elements without text of the page; raw ones end only at their own end tag.
RAW_TAGS = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg".split())
NOTES = frozenset("annotation annotation-xml".split())  # a formula once more, in other words
DROPPED_TAGS = RAW_TAGS | NOTES | frozenset("head button select option optgroup object audio video canvas dialog datalist".split())
#: What may stand in a head; anything else ends it, as text does.
HEAD_TAGS = frozenset("head html base basefont bgsound link meta title style script noscript noframes template".split())
BAD_TAGS = frozenset("nav footer aside form menu search".split())
GOOD_TAGS = frozenset("article main".split())
#: Elements that end when one of the same kind begins in the same parent.
SELF_CLOSING = {
    "p": frozenset({"p"}), "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "td", "th"}), "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}),
}
_PARAGRAPH = frozenset({"p"})
SCOPES = frozenset("article aside blockquote body div footer form header html main nav ol section table td th ul".split())

# Words in class, id and role that say what a part is.
_BAD_NAME = re.compile(
    r"(?:^|[\s_-])(nav(?:bar|igation)?|menu|breadcrumbs?|header|masthead|top-?bar|footer|foot|sidebar|side|aside|widgets?|"
    r"ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banner|cookies?|consent|gdpr|notices?|alert|"
    r"popup|modal|overlay|newsletter|subscribe|subscription|sign-?up|login|share|sharing|social|related|recommend(?:ed|ations)?|"
    r"comments?|commentlist|respond|replies|reply|disqus|discussion|reviews?|toolbar|pagination|pager|tags|legal|copyright|"
    r"disclaimer|privacy|search|contentinfo|complementary|skip(?:-?link)?|hidden)(?:$|[\s_-])",
    re.I,
)
_GOOD_NAME = re.compile(
    r"(?:^|[\s_-])(?:article|article-?body|main|content|main-?content|post|post-?(?:body|content|text)|entry|entry-?content|story|"
    r"story-?body|body-?text|text|prose)(?:$|[\s_-])",
    re.I,
)
# Words of parts that readers write, or that others pay for: these may well be long, and hold articles of their own.
_FOREIGN_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|cookies?|consent|gdpr|comments?|commentlist|respond|"
    r"replies|reply|disqus|discussion|reviews?)(?:$|[\s_-])",
    re.I,
)
# Last words of names that leave what a part is to the words before: "related-posts" and "share-box", not "related-work".
_BOXES = frozenset(
    """area article articles aside bar block body bottom box btn button buttons card cards cell col column container content
    contents copy cta description entries entry feed footer form grid group header heading holder inner item items label left link
    links list listing main message messages middle module news outer page pages panel panels paragraph post posts primary region
    right row rows secondary section sections slot stories story stream strip summary tab tabs tag teaser teasers text thread tile
    tiles title toggle top unit view widget widgets wrap wrapper zone""".split()
)
# Class words that tell the state of a page or part, not what it is.
_STATE = re.compile(
    r"(?<!\S)(?:(?:has|have|no|not|with|without)[_-]\S+|"
    r"\S+[_-](?:fixed|sticky|enabled|disabled|open(?:ed)?|closed|visible|collapsed|expanded|on|off))(?!\S)",
    re.I,
)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_HIDDEN_ATTRIBUTE = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_NOTICE = re.compile(r"(?:©|\(c\)|copyright\b|all rights reserved)", re.I)

GOOD, BAD, OPEN = 1, -1, 0
#: Why a part is bad: a part of the page that may hold others, one that readers or others write, one that is not shown.
PART, FOREIGN, HIDDEN = 1, 2, 3


class Block:
    __slots__ = ("text", "links", "place", "heading")

    def __init__(self, text: str, links: int, place: int, heading: bool):
        self.text, self.links, self.place, self.heading = text, links, place, heading


def _weak(names: str) -> bool:
    """Whether every word that says a part is bad only tells more about another word, the last of its name."""
    for name in names.split():
        bad = [m.end(1) for m in _BAD_NAME.finditer(name)]
        last = re.split("[_-]", name.lower())[-1]
        if bad and (max(bad) == len(name) or _BAD_NAME.search(last) or last in _BOXES or not last.isalpha() or len(last) < 3):
            return False
    return True


def _said(tag: str, attributes: str, inside_main: bool) -> tuple[int, int, bool]:
    """What an element by itself says about its content, GOOD, BAD or nothing (OPEN), why it is bad, and if that is weak."""
    named, names = False, ""
    if "=" in attributes or "hidden" in attributes.lower():
        if _HIDDEN_ATTRIBUTE.search(attributes):
            return BAD, HIDDEN, False
        values = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
        if _HIDDEN.search(values.get("style", "")) or values.get("aria-hidden", "").lower() == "true":
            return BAD, HIDDEN, False
        if tag not in ("html", "body") and tag not in GOOD_TAGS:
            names = " ".join(_STATE.sub(" ", _CAMEL.sub("-", values.get(k, ""))) for k in ("class", "id", "role"))
            named = bool(names.strip())
        elif tag in GOOD_TAGS and re.search(r"(?:^|[\s_-])comments?(?:$|[\s_-])", values.get("class", ""), re.I):
            return BAD, FOREIGN, False
    if tag in BAD_TAGS or tag == "header":
        if tag == "header" and inside_main:
            return OPEN, 0, False
        return BAD, FOREIGN if tag == "aside" or named and _FOREIGN_NAME.search(names) else PART, False
    if named:
        good, bad = _GOOD_NAME.search(names), _BAD_NAME.search(names)
        if bad and not (good and good.end() > bad.end()):
            foreign = bool(_FOREIGN_NAME.search(names))
            return BAD, FOREIGN if foreign else PART, inside_main and not foreign and _weak(names)
        if good:
            return GOOD, 0, False
    return (GOOD if tag in GOOD_TAGS else OPEN), 0, False


class Claim:
    """An element that says it is bad, and the blocks (first, and the one after the last) inside of it."""

    __slots__ = ("number", "why", "weak", "first", "last")

    def __init__(self, number: int, why: int, weak: bool, first: int):
        self.number, self.why, self.weak, self.first, self.last = number, why, weak, first, None


def blocks(page: str, refused: frozenset = frozenset(), names: bool = False) -> tuple[list[Block], list[Claim]]:
    """The blocks of a page in order, with what the elements around them say, and the elements that say they are bad.

    Claims whose numbers are ``refused`` say nothing. A main element counts inside of a bad one, an article inside of one that
    is a part of the page; with ``names`` everything that says it is good counts in everything that is not foreign.
    """
    out: list[Block] = []
    claims: list[Claim] = []
    # element, what it and those around it say, inside of a main part, why it is bad, its claim
    stack: list[tuple[str, int, bool, int, Claim | None]] = [("", OPEN, False, 0, None)]
    # where in the stack the elements of a name are, and the scopes: no tag costs a walk over all open elements
    places: defaultdict[str, list[int]] = defaultdict(list)
    scopes = [0]
    parts: list[str] = []
    links, in_link, heading, skip = 0, 0, False, 0

    def end_block() -> None:
        nonlocal links, heading
        text = " ".join(references.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, min(links, len(text)), stack[-1][1], heading))
        parts.clear()
        links = 0

    def leave(depth: int) -> None:
        nonlocal in_link, heading, skip
        for tag, _, _, _, claim in reversed(stack[depth:]):
            places[tag].pop()
            if tag in SCOPES:
                scopes.pop()
            if claim:
                claim.last = len(out)
            in_link -= tag == "a"
            skip -= tag in DROPPED_TAGS
            if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                heading = False
        del stack[depth:]

    at, end = 0, len(page)
    while at < end:
        begin = page.find("<", at)
        found = _TOKEN.match(page, begin) if begin >= 0 else None
        stop = end if begin < 0 else begin if found else begin + 1
        if stack[-1][0] == "head" and stop > at and not page[at:stop].isspace():
            leave(len(stack) - 1)
        if stop > at and not skip:
            piece = page[at:stop]
            parts.append(piece)
            if in_link:
                links += len(" ".join(piece.split()))
        if not found:
            at = stop
            continue
        at = found.end()
        closing, tag = found[1], (found[2] or "").lower()
        if not tag:
            continue
        if tag == "br":
            if not skip:
                parts.append("\n")
            continue
        block = tag in BLOCK_TAGS or tag in DROPPED_TAGS and tag not in NOTES
        if closing:
            depth = places[tag][-1] if places[tag] else 0
            if block and not skip:
                end_block()
            if depth and (block or scopes[-1] <= depth):
                leave(depth)
            continue
        attributes = found[3] or ""
        if stack[-1][0] == "head" and tag not in HEAD_TAGS:
            leave(len(stack) - 1)
        if block and not skip:
            end_block()
        if tag in VOID_TAGS or attributes.rstrip().endswith("/") and tag not in BLOCK_TAGS and tag not in RAW_TAGS:
            continue
        if tag in RAW_TAGS:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = close.end() if close else (end if tag in ("script", "style") else at)
            continue
        if tag in SELF_CLOSING or tag in SCOPES:
            nearest = max((places[e][-1] for e in SELF_CLOSING.get(tag, _PARAGRAPH) if places[e]), default=0)
            if nearest and nearest >= scopes[-1]:
                leave(nearest)
        _, outer, main, why, _ = stack[-1]
        place, reason, claim = outer, why, None
        if why != HIDDEN:
            said, cause, weak = _said(tag, attributes, main)
            if said == BAD and cause != HIDDEN:
                claim = Claim(len(claims), cause, weak, len(out))
                claims.append(claim)
                if claim.number in refused:
                    said = OPEN
            if said == BAD:
                place, reason = BAD, max(why, cause)
            elif said == GOOD and (
                outer != BAD or not main and (tag == "main" or tag in GOOD_TAGS and why == PART or names and why == PART)
            ):
                place, reason = GOOD, 0
        places[tag].append(len(stack))
        if tag in SCOPES:
            scopes.append(len(stack))
        stack.append((tag, place, main or place == GOOD, reason, claim))
        in_link += tag == "a"
        skip += tag in DROPPED_TAGS
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            heading = True
    if not skip:
        end_block()
    for claim in claims:
        claim.last = len(out) if claim.last is None else claim.last
    return out, claims


def _prose(block: Block) -> bool:
    """Whether a block is good by itself, whatever the elements around it say."""
    return first_pass(Block(block.text, block.links, OPEN, block.heading))[0] == GOOD


def believed(page: str) -> list[Block]:
    """The blocks of a page, where parts that hold most of its prose are not bad for what they say."""
    found, claims = blocks(page)
    if not claims:
        return found
    sizes = [len(b.text) if _prose(b) else 0 for b in found]
    upto, whole = [0], [0]
    for block, size in zip(found, sizes):
        upto.append(upto[-1] + size)
        whole.append(whole[-1] + len(block.text))
    prose = lambda c: 2 * (upto[c.last] - upto[c.first]) > whole[c.last] - whole[c.first]
    weak = frozenset(c.number for c in claims if c.weak and prose(c))
    # each of them lies in the one before
    heavy = [c for c in claims if c.number not in weak and 2 * (upto[c.last] - upto[c.first]) > upto[-1]]
    if heavy:
        found, _ = blocks(page, weak.union(c.number for c in heavy))
        # prose of a main part outside is where the text is; for what others write, so is any main part or prose outside
        kept = len(heavy)
        for k, claim in enumerate(heavy):
            outside = zip(found[: claim.first] + found[claim.last :], sizes[: claim.first] + sizes[claim.last :])
            foreign = claim.why == FOREIGN
            if any(b.place == GOOD and (size or foreign) or foreign and size and b.place != BAD for b, size in outside):
                kept = k
                break
        refused = weak.union(c.number for c in heavy[:kept])
        if kept < len(heavy):
            found, _ = blocks(page, refused)
    else:
        refused = weak
        if weak:
            found, _ = blocks(page, refused)
    if upto[-1] and not any(size and b.place != BAD for b, size in zip(found, sizes)):
        found, _ = blocks(page, refused, True)
    return found


def first_pass(block: Block) -> tuple[int, int]:
    """(label, lean) of a block by itself."""
    if block.place == BAD:
        return BAD, BAD
    size = len(block.text)
    if block.links > LINKS * size:
        return (BAD, BAD) if block.place != GOOD else (OPEN, BAD)
    if size < 3 * LONG and _NOTICE.match(block.text) and block.place != GOOD:
        return BAD, BAD
    words = _WORD.findall(block.text.lower())
    share = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
    if size >= LONG and share >= STOP_HIGH or size >= 4 * LONG and share >= STOP_LOW:
        return GOOD, GOOD
    if size < SHORT:
        return OPEN, OPEN
    if share >= STOP_LOW:
        return OPEN, GOOD
    return OPEN, OPEN


def second_pass(found: list[Block]) -> list[bool]:
    """Which blocks are main text."""
    marks = [first_pass(b) for b in found]
    labels = [m[0] for m in marks]
    # parts that say they are not main text say nothing about their neighbours
    telling = [OPEN if b.place == BAD else label for b, label in zip(found, labels)]
    before, after = [(OPEN, 0)] * len(found), [(OPEN, 0)] * len(found)  # label, and how far away
    for i in range(1, len(found)):
        label, far = (telling[i - 1], 0) if telling[i - 1] else before[i - 1]
        before[i] = (label, far + 1)
    for i in range(len(found) - 2, -1, -1):
        label, far = (telling[i + 1], 0) if telling[i + 1] else after[i + 1]
        after[i] = (label, far + 1)
    # where nothing is good by itself, the page's declared main part is all there is to go by
    any_good = GOOD in labels
    out = []
    for block, (label, lean), (left, before_it), (right, to_it) in zip(found, marks, before, after):
        if label == OPEN:
            if block.place == GOOD:
                label = BAD if lean == BAD and left == right == BAD else GOOD
            elif not any_good:
                label = lean or (GOOD if len(block.text) >= SHORT else BAD)
            elif left == right or not (left and right):
                label = left or right
            elif lean != OPEN or block.heading and right == GOOD:
                label = lean or GOOD
            else:  # what follows a text as closely as what comes after it belongs to the text
                label = left if before_it < to_it or left == GOOD and before_it == to_it else right if to_it < before_it else BAD
        out.append(label == GOOD)
    return out


def main_text(page: str | None) -> str:
    """Blocks of main text, joined by newlines; empty if there are none."""
    found = believed(page or "")
    # a declared main part is where the text is, unless it holds none of it
    if any(b.place == GOOD for b in found):
        own = [b.place == GOOD for b in found]
        kept = second_pass(found)
        inside = [k and o for k, o in zip(kept, own)]
        weigh = lambda marks: sum(len(b.text) for b, m in zip(found, marks) if m)
        kept = inside if 2 * weigh(inside) >= weigh(kept) else kept
    else:
        kept = second_pass(found)
    return "\n".join(b.text for b, k in zip(found, kept) if k)


def extracted(html: Column | str) -> Column:
    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    return extract(html)


def extract_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text (empty if there is none), n_chars (code points).

    A null or empty page has no text; markup that is cut off or wrong is read as far as it goes; ids and urls may be null or
    repeated; no rows give no rows; other columns are ignored.
    """
    rows = narrow(pages, id=id_column, url=url_column, html=html_column)
    rows = rows.select(F.col("id").alias(id_column), F.col("url").alias(url_column), extracted("html").alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
