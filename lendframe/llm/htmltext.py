"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass classifies each block by the
density of its stop words, its length and its links. A block of links is bad. A block is good if
dense in stop words, or if long with some and few links; it is bad if it has hardly any and is
not long; short blocks, and those alone in a small container, are ambiguous. Where the page or
the block shows that the stop words are not of its language, long blocks of words with few
links are good. What a page says of itself has a vote: what lies in menus, headers, footers,
sidebars, forms, notices, adverts or comments is bad, as is a short block with a copyright
sign, and what lies in an ``article`` or ``main`` element is good unless it is a block of links.
A form that holds an article or long prose is no such form, and an article inside a menu, header
or named container counts nonetheless.

In the second pass an ambiguous block takes the label of its nearest decided neighbour, one in
another container being farther off; of two at the same distance that differ, it takes the good
one if it is a heading or follows a good block of its own kind of element, else the bad one.
Without any decided block, ambiguous blocks are good.

Buttons, choices, drawings, templates and annotations of formulas are left out, and end with
their parents; what else formulas and objects hold is text.

Null and empty pages give an empty text. Character references are decoded once. Repeated
rows get a row each; columns other than ``page_id``, ``url`` and ``html`` are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from lendframe.llm.arrow import chunks, column

GOOD, BAD, OPEN = 1, -1, 0
#: Attributes up to the next tag; or some with a ``<`` in quotes, of bounded length: an open quote
#: could else make every tag look through the whole page.
_PLAIN = r"""(?:[^>"'<]++|"[^"<]*+"|'[^'<]*+')*+"""
_QUOTED = r"""(?:[^>"'<]++|"[^"]{0,1024}+"|'[^']{0,1024}+'){0,8}+"""
TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)
    | <(script|style|textarea|title|iframe)\b(?:{_PLAIN}|{_QUOTED})>.*?(?:</\1\s*>|\Z)
    | <(/?)([a-z][a-z0-9:-]*)({_PLAIN}|{_QUOTED})>
    | <(/?)([a-z][a-z0-9:-]*)([^>]*+)>
    | <[!?][^>]*+>""",
    re.X | re.S | re.I,
)


def tokens(page: str) -> Iterator[re.Match[str]]:
    """Tags, comments and raw elements; nothing behind the last ``>`` can be one."""
    return TOKEN.finditer(page, 0, page.rfind(">") + 1)


def end_of_text(page: str, last: re.Match[str] | None) -> int:
    """Where the text ends: an element or comment that nothing closes takes all behind it."""
    end = page.rfind(">") + 1
    if last is not None and last.end() == end:
        raw = last[0].lower()
        if last[1] and not raw.rstrip("> \t\r\n\f").endswith(f"</{last[1].lower()}") or raw.startswith("<!--") and not raw.endswith("-->"):
            return last.start()
    open_ = page.find("<!--", end)
    return len(page) if open_ < 0 else open_


INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark object param q s samp small span strike strong sub sup time tt u var wbr
    math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup
    mtext munder munderover semantics""".split()
)
#: Elements that open a container; a block inherits what its containers are.
CONTAINERS = frozenset("address article aside blockquote body details dialog div dl fieldset figure footer form header main menu nav noscript ol section table ul".split())
#: Elements whose content is not text of the page. One that nothing closes before its parent ends stops at the next block.
HIDDEN = frozenset("annotation annotation-xml button select svg template".split())
HAS_HIDDEN = re.compile("<(?:%s)\\b" % "|".join(sorted(HIDDEN)), re.I)
BLOCKS = CONTAINERS | frozenset("caption center dd dt figcaption h1 h2 h3 h4 h5 h6 legend li p pre summary tbody td tfoot th thead tr".split())
#: Elements never part of the main text. An ``article`` or ``main`` inside a SOFT one is; inside a NAMED one it is if
#: there is none elsewhere and less prose; inside a FIRM one it is not.
SOFT, NAMED, FIRM = 1, 2, 3
APART = {"aside": FIRM, "dialog": FIRM, "footer": FIRM, "header": SOFT, "menu": SOFT, "nav": SOFT}
APART_ROLES = re.compile(r"""(?<![\w-])role\s*=\s*["']?(?:(navigation|banner|search|form)|complementary|contentinfo|dialog|alert)\b""", re.I)
#: Class or id of containers that are not part of the main text: the whole name, its last part after a hyphen or underscore
#: (``site-footer``), or a part before one of NAME_TAILS (``share-buttons``).
APART_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo banner
    menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer sidebar side rail widget related recommended
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social
    toolbar pagination pager""".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist replies respond disqus".split())
NAME_TAILS = frozenset(
    """area articles banner bar block body bottom box btn button buttons container content contents count form group heading holder icons info
    inner item items label link links list lists media message meta panel placeholder posts primary row secondary section slot stories text thread title
    tools top unit wrap wrapper""".split()
)
#: First parts of names that tell of a state or a layout: ``has-sidebar``, ``with-nav``.
NAME_STATES = frozenset("has have with without no not is hide show js".split())
NAMES = re.compile(r"""(?<![\w-])(?:class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: A form, or a noscript outside the article, is part of the page if it holds an article or main element, so many words of prose, or most of the page's prose.
FORM_WORDS, NOTICE_WORDS = 100, 40
INNER_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"[^"]*?|'[^']*?|)(?<![a-z0-9])(?:main|article|article-body|post-content|entry-content|story|main-content)(?![a-z0-9])""", re.I)
#: Frequent function words of four languages.
STOP_WORDS = frozenset(
    (
        "a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their they this to was were which who will with you "
        "au aux avec ce ces dans de des du elle en est et eux il je la le les leur lui mais ne nous on ou par pas pour qu que qui sa se ses son sur un une vous "
        "aber als am auch auf aus bei das dass dem den der des die ein eine einem einen einer es für hat im ist mit nach nicht noch sich sie sind so über und von vor war wie wird zu zum "
        "al como con del el ella ellos entre era es esta este fue ha hay las lo los más me muy no para pero por se sin sobre su sus también una y ya"
    ).split()
)
#: A block of fewer words is ambiguous unless its container or its links decide.
SHORT_WORDS = 12
LINKED = 0.5
#: Blocks of more words have no few of anything by chance; containers of fewer are notices as often as text.
LONG_WORDS, LONE_WORDS = 40, 20
#: So many blocks farther off is a neighbour that lies in another container.
APART_BOX = 4
DENSE, SPARSE = 0.22, 0.08
#: The stop words fit a page if blocks dense in them hold this share of its words, and a block if so few of its letters are foreign.
FITS, FOREIGN = 0.1, 0.02
#: Long blocks that the stop words don't fit are good with fewer links and more words of letters than this.
FEW_LINKS, WORDY = 0.2, 0.6
_FOREIGN = re.compile(r"[^\W\d_a-zA-ZÀÁÂÄÆÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜŒŸàáâäæçèéêëíîïñóôöùúûüœÿßªº]")
#: Letters of scripts without spaces; two count as a word.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff]")
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


@dataclass
class Block:
    text: str
    label: int
    heading: bool
    element: str
    #: Number of the container it lies in.
    box: int = 0


@dataclass
class Place:
    """What a container hands on to all that is in it."""

    name: str = ""
    #: 0, SOFT, NAMED or FIRM.
    apart: int = 0
    inner: bool = False
    #: In an article or main element in a NAMED container.
    lifted: bool = False
    #: The nearest form or noscript.
    form: int = -1
    number: int = 0


@dataclass
class Form:
    outer: int
    #: Fewer words of prose are a notice.
    least: int = 0
    holds_inner: bool = False
    prose: int = 0


def apart_by_name(attributes: str) -> int:
    """What class, id and role tell of a container."""
    role = APART_ROLES.search(attributes)
    found = 0 if role is None else SOFT if role[1] else FIRM
    for m in NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            parts = [x for x in re.split(r"[-_]+", name) if x and not re.fullmatch(r"\d+(?:x\d+)?", x)]
            if not parts or parts[0] in NAME_STATES:
                continue
            named = {parts[-1], *(parts[:-1] if parts[-1] in NAME_TAILS else ())}
            found = max(found, FIRM if named & COMMENT_NAMES else NAMED if named & APART_NAMES else 0)
    return found


def blocks(page: str) -> list[Block]:
    """All blocks of a page that have text, in order, with the first pass' labels."""
    found: list[tuple[Block, Place, int]] = []
    stack: list[Place] = [Place()]
    forms: list[Form] = []
    pieces: list[str] = []
    linked = links = boxes = 0
    element, at, in_head = "", 0, False

    def close() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                place = Place(apart=FIRM) if in_head else stack[-1]
                found.append((Block(text, OPEN, element[:1] == "h" and element[1:].isdigit(), element, stack[-1].number), place, linked))
            pieces.clear()
        linked = 0

    skips = hidden(page) if HAS_HIDDEN.search(page) else {}
    until, token = 0, None
    for token in tokens(page):
        if token.start() < until:
            continue
        if until > at:
            at = until
        if token.start() > at:
            piece = page[at : token.start()]
            pieces.append(piece)
            if links:
                linked += len(piece)
        at = token.end()
        name = token[3] or token[6]
        if token.start() in skips:
            until = skips[token.start()]
            pieces.append(" ")
            continue
        if name is None:
            if token[1]:
                pieces.append(" ")
            continue
        name, ends, attributes = name.lower(), (token[2] or token[5]) == "/", token[4] or token[7] or ""
        if name == "a":
            links = 0 if ends else 1
        if name in INLINE:
            continue
        close()
        links = 0
        element = "" if ends else name
        if name == "head" and ends or name == "body":
            while stack[-1].name == "noscript":
                stack.pop()
        if name == "head":
            in_head = not ends
        elif name == "body":
            in_head = False
        if name not in CONTAINERS or attributes.endswith("/"):
            continue
        if not ends:
            in_head = in_head and name == "noscript"
            boxes += 1
            stack.append(enter(name, attributes, stack[-1], forms))
            stack[-1].number = boxes
        else:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
    at, end = max(at, until), end_of_text(page, token)
    if at < end:
        pieces.append(page[at:end])
    close()
    return judge(found, forms)


def hidden(page: str) -> dict[int, int]:
    """Where each outermost hidden element starts, and where it ends."""
    found: dict[int, int] = {}
    #: Open elements: name, start, and the first block tag in it; ``veiled`` has the hidden ones among them.
    stack: list[tuple[str, int, list[int]]] = []
    veiled: list[tuple[str, int, list[int]]] = []
    count: Counter[str] = Counter()

    def drop(name: str, end: int, closed: bool) -> None:
        """End the last open element of a name, and all that it holds."""
        while True:
            last, start, block = stack.pop()
            count[last] -= 1
            if last in HIDDEN:
                veiled.pop()
                whole = closed and last == name
                found[start] = end if whole else min([*block, end])
                if block and not whole and veiled and not veiled[-1][2]:
                    veiled[-1][2].extend(block)
            if last == name:
                return

    for token in tokens(page):
        name, attributes = (token[3] or token[6] or "").lower(), token[4] or token[7] or ""
        if (token[2] or token[5]) == "/":
            if count[name]:
                drop(name, token.end() if name in HIDDEN else token.start(), name in HIDDEN)
            continue
        if name in BLOCKS and veiled and not veiled[-1][2]:
            veiled[-1][2].append(token.start())
        if name == "svg" and attributes.endswith("/"):
            found[token.start()] = token.end()
            continue
        if name in ("button", "select") and count[name]:
            drop(name, token.start(), False)
        if name in BLOCKS or name in HIDDEN and not (name == "template" and "shadowroot" in attributes.lower()):
            stack.append((name, token.start(), []))
            count[name] += 1
            if name in HIDDEN:
                veiled.append(stack[-1])
    while stack:
        drop(stack[-1][0], len(page), False)
    return found


def enter(name: str, attributes: str, outer: Place, forms: list[Form]) -> Place:
    """The place that a container's start tag opens."""
    article = name in ("article", "main")
    own = 0 if article or name == "body" or not attributes else apart_by_name(attributes)
    if not (name == "header" and outer.inner):
        own = max(own, APART.get(name, 0))
    is_inner = article or bool(attributes) and bool(INNER_NAMES.search(attributes))
    form = outer.form
    if name == "form" or name == "noscript" and not outer.inner:
        forms.append(Form(form, NOTICE_WORDS if name == "noscript" else 0))
        form = len(forms) - 1
    elif is_inner and not own:
        while form >= 0 and not forms[form].holds_inner:
            forms[form].holds_inner = True
            form = forms[form].outer
        form = outer.form
    apart = 0 if article and outer.apart == SOFT else max(outer.apart, own)
    lifted = not own and (outer.lifted or article) and apart == NAMED
    return Place(name, apart, outer.inner or is_inner, lifted, form)


def judge(found: list[tuple[Block, Place, int]], forms: list[Form]) -> list[Block]:
    """Label the blocks of a page, now that all of it is known."""
    prose = lifted = dense = seen = 0
    # no need to count where every block's place decides
    counted = any(p.lifted or p.form >= 0 or not (p.apart or p.inner) for _, p, _ in found)
    room: Counter[int] = Counter()
    for block, _, _ in found if counted else ():
        room[block.box] += n_words(block.text)
    for block, place, linked in found if counted else ():
        words = n_words(block.text)
        if words < SHORT_WORDS or linked > LINKED * len(block.text):
            continue
        if (not place.apart or place.lifted) and room[block.box] >= LONE_WORDS:
            seen += words
            dense += words * (density(block.text) >= DENSE)
        lifted += words * place.lifted
        if not place.apart:
            prose += words
            form = place.form
            while form >= 0:
                forms[form].prose += words
                form = forms[form].outer
    wraps: list[bool] = []
    for form in forms:
        wraps.append((form.outer < 0 or wraps[form.outer]) and (form.holds_inner or form.prose >= FORM_WORDS or form.prose >= form.least and 2 * form.prose > prose))
    lift = lifted > prose and not any(p.inner and not p.apart and (p.form < 0 or wraps[p.form]) and k <= LINKED * len(b.text) for b, p, k in found)
    for block, place, linked in found:
        apart = bool(place.apart) and not (lift and place.lifted) or place.form >= 0 and not wraps[place.form]
        block.label = first_label(block.text, apart, place.inner, linked, dense >= FITS * seen, 0 < room[block.box] < LONE_WORDS)
    return [block for block, _, _ in found]


def n_words(text: str) -> int:
    return len(text.split()) + (0 if text.isascii() else len(_UNSPACED.findall(text)) // 2)


def density(text: str) -> float:
    """Share of stop words."""
    words = text.lower().split()
    return sum(_EDGES.sub("", w) in STOP_WORDS for w in words) / len(words)


def first_label(text: str, apart: bool, inner: bool, linked: int, fits: bool = True, lone: bool = False) -> int:
    """``fits``: the stop words are of the page's language; ``lone``: the container holds little more than this block."""
    if apart:
        return BAD
    if linked > LINKED * len(text):
        return BAD
    if inner:
        return GOOD
    size = n_words(text)
    if "\xa9" in text and size < LONG_WORDS:
        return BAD
    if size < SHORT_WORDS or lone:
        return OPEN
    share = density(text)
    few_links = linked <= FEW_LINKS * len(text)
    if share >= DENSE or share >= SPARSE and size >= LONG_WORDS and few_links:
        return GOOD
    letters = sum(map(str.isalpha, text))
    if fits and (text.isascii() or len(_FOREIGN.findall(text)) <= FOREIGN * letters):
        return BAD if share < SPARSE and (size < LONG_WORDS or not few_links) else OPEN
    # without stop words to go by, length, links and words of letters decide; marks between words are none
    words = [w for w in text.split() if any(map(str.isalnum, w))]
    wordy = sum(_EDGES.sub("", w) != "" for w in words) > WORDY * len(words)
    return GOOD if wordy and few_links else OPEN


def settle(found: list[Block]) -> list[Block]:
    """Second pass: the good blocks."""
    decided = [k for k, b in enumerate(found) if b.label != OPEN]
    if not decided:
        return found
    kept, place = [], 0
    for k, block in enumerate(found):
        while place < len(decided) and decided[place] < k:
            place += 1
        label = block.label
        if label == OPEN:
            before = decided[place - 1] if place else None
            after = decided[place] if place < len(decided) else None
            # a neighbour in another container is farther off
            back, on = (None if x is None else abs(k - x) + APART_BOX * (found[x].box != block.box) for x in (before, after))
            if before is None or after is None:
                label = found[after if before is None else before].label
            elif back != on:
                label = found[before if back < on else after].label
            elif found[before].label == found[after].label:
                label = found[before].label
            else:
                goes_on = found[before].label == GOOD and found[before].element == block.element
                label = GOOD if goes_on or block.heading and found[after].label == GOOD else BAD
        if label == GOOD:
            kept.append(block)
    return kept


def main_text(page: str) -> str:
    return " ".join(b.text for b in settle(blocks(page)))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source = column(batch, "html")
            for a, b in chunks(source):
                texts = [main_text(p) if p else "" for p in source[a:b].to_pylist()]
                ids, urls = column(batch, "page_id")[a:b], column(batch, "url")[a:b]
                lengths = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, urls, pa.array(texts, pa.string()), lengths], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
