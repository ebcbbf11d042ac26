"""Main text of web pages by two-pass block rules (operator 1).

Pass one cuts a page into blocks at block-level tags and classifies each block
by itself: its container (menus, footers, forms, adverts, reader comments ...
are bad), its link density, its length and its stop-word density. Blocks that
these leave open, mostly short ones, are ambiguous. Pass two gives each
ambiguous block the label of the nearest decided block of its region.

Inside ``article`` or ``main`` the container already says that a block is
content, so there the text rules never reject running text; they decide alone
on pages without such an element.

Defined cases: null html gives an empty text; a page without tags is one
block; unclosed tags, tags cut off at the end and unclosed comments or scripts
are accepted; list items, cells and rows end where a sibling begins, and an end
tag finds its element at any depth; character references decode as HTML5 defines them, also without
a semicolon; a long page takes time in proportion to its length.
"""

from __future__ import annotations

import html as html_lib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MIN_LINK_DENSITY = 0.5      # share of a block's characters inside links: bad
SHORT = 60                  # characters; below it a block can't decide itself
LONG = 160                  # above it stop words decide alone
STOP_HIGH, STOP_LOW = 0.28, 0.12

# Frequent function words of the languages in the corpus.
STOP_WORDS = frozenset("""
the of and to in a is that for it with as was on be by at this are or from an not have but they his her
she he which you one all were their there been has when who will more no if out so what up into than
der die und das ist nicht ein eine einer eines den dem des zu mit sich auf für von im auch es an werden
aus er hat dass sie nach wird bei noch wie einem über so zum war haben nur oder aber vor zur bis mehr
le la les de des et un une du en est que qui dans pour par sur pas au aux avec ce il elle se ne plus sont
son sa ses ou mais comme nous vous leur cette été être fait
el los las del y en que se por con para una su al lo como más pero sus le ya este sí porque esta entre
cuando muy sin sobre también me hasta hay donde quien desde todo nos durante
""".split())

# Elements whose whole content is never text of the page.
SKIPPED = frozenset("script style title head noscript template iframe object svg math select textarea "
                    "button canvas audio video datalist".split())
RAW = frozenset("script style title textarea iframe".split())       # content isn't markup
BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
MAIN_TAGS = frozenset(("article", "main"))
BLOCK_TAGS = frozenset("""
address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p
pre section summary table tbody td tfoot th thead tr ul
""".split())
CONTAINERS = frozenset("""
address article aside blockquote details dialog div dl fieldset figure footer form header main menu nav ol
section table tbody td tfoot th thead tr ul li span p
""".split())
UNSTYLED = frozenset("tfoot th thead".split())     # their class and id say nothing of what they hold
INLINE = frozenset(("p", "span"))
# What may stay open inside an item of a list when the next one begins; any other container holds a list of its own.
IN_ITEM = frozenset("address div li p span".split())
# Start tags of table parts and what they end, back to the innermost table.
ENDS = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"),
        **dict.fromkeys(("tbody", "tfoot", "thead"), ("tbody", "td", "tfoot", "th", "thead", "tr"))}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

# Words of class and id values. The first kind holds even around an article.
HARD_WORDS = frozenset("""
ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promoted
promotion comment comments commentlist disqus replies reply respond discussion nav navbar navigation menu
menus breadcrumb breadcrumbs footer cookie cookies consent gdpr popup modal overlay newsletter subscribe
subscription signup login signin share sharing social related recommended recommendations pagination pager
notice notices alert disclaimer copyright
""".split())
SOFT_WORDS = frozenset("sidebar sidenav side rail widget widgets toolbar masthead header topbar hidden skip".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
                         "menubar".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/><]*)((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)(?:>|\Z)", re.S)
ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
SPLIT_NAMES = re.compile(r"[^a-z0-9]+")
LETTERS = re.compile(r"[^\W\d_]+")
GOOD, BAD, OPEN = 1, -1, 0


def container_kind(tag: str, attrs: str, in_main: bool) -> int:
    """2: never content; 1: not content unless an article stands inside; 0: may be content."""
    if tag in BOILER_TAGS:
        return 2
    kind = 1 if tag == "header" and not in_main else 0
    if not attrs or tag in ("body", "html"):
        return kind
    for name, a, b, c in ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        words = SPLIT_NAMES.split(value)
        if name in ("class", "id"):
            if not HARD_WORDS.isdisjoint(words):
                return 2
            if not SOFT_WORDS.isdisjoint(words) and not (in_main and "header" in words):
                kind = 1
        elif name == "role" and not BOILER_ROLES.isdisjoint(words):
            return 2
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            kind = 1
        elif name == "style" and "display:none" in value.replace(" ", ""):
            return 2
    return kind


def blocks(page: str) -> list[tuple[str, int, int, bool]]:
    """(text, characters inside links, region, boilerplate container) of each
    block in page order; region 0 is outside every ``article`` and ``main``."""
    out: list[tuple[str, int, int, bool]] = []
    stack: list[tuple[str, int, int]] = []       # container tag, kind, region
    # positions in the stack, ascending: of each tag, of what isn't INLINE and of what isn't IN_ITEM
    places: dict[str, list[int]] = {tag: [] for tag in CONTAINERS}
    walls: list[int] = []
    lists: list[int] = []
    parts: list[str] = []
    linked, in_link, region, kind, regions, at = 0, False, 0, 0, 0, 0

    def flush():
        nonlocal linked
        text = " ".join(html_lib.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append((text, min(linked, len(text)), region, kind > 0))
        linked = 0

    def add(text):
        nonlocal linked
        parts.append(text)
        if in_link:
            linked += len(text)

    def close(i):
        """Everything from position ``i`` of the stack on ends."""
        while len(stack) > i:
            places[stack.pop()[0]].pop()
        for own in (walls, lists):
            while own and own[-1] >= i:
                own.pop()

    def last(own):
        return own[-1] if own else -1

    search = TAG.search
    while True:
        m = search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(m.group(1))
        if tag in SKIPPED and not closing and not m.group(3).endswith("/"):
            end = re.compile(rf"</{tag}(?![a-z0-9])[^>]*(?:>|\Z)", re.I).search(page, at)
            if tag == "head" and end is None:    # a page that never closes its head: go on at the body
                end = re.compile(r"(?=<body[\s>])", re.I).search(page, at)
            at = end.end() if end else len(page) if tag in RAW else at
            continue
        if tag == "a":
            in_link = not closing
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
        if tag not in CONTAINERS:
            continue
        if not closing:
            if m.group(3).endswith("/"):
                continue
            if tag == "p":
                # a paragraph ends where the next one begins, whatever stayed open inside
                close(last(walls) + 1)
            elif tag == "li" and last(places["li"]) > last(lists):
                close(places["li"][-1])
                in_link = False
            elif tag in ENDS:
                table = last(places["table"])
                ended = [i for own in ENDS[tag] if (i := last(places[own])) > table]
                if ended:
                    close(min(ended))
                    in_link = False
            region, kind = (stack[-1][2], stack[-1][1]) if stack else (0, 0)
            own = 0 if tag in UNSTYLED else container_kind(tag, m.group(3), region > 0)
            if own and tag == "span":
                flush()
            if tag in MAIN_TAGS and own < 2 and kind < 2:
                regions += 1
                region, kind = regions, own and kind
            else:
                kind = max(kind, own)
            places[tag].append(len(stack))
            if tag not in INLINE:
                walls.append(len(stack))
            if tag not in IN_ITEM:
                lists.append(len(stack))
            stack.append((tag, kind, region))
        else:
            i = last(places[tag])
            if i > (last(walls) if tag in INLINE else -1):
                if tag == "span" and stack[i][1]:
                    flush()
                close(i)
            region, kind = (stack[-1][2], stack[-1][1]) if stack else (0, 0)
            in_link = False if tag != "span" else in_link
    flush()
    return out


def stop_density(text: str) -> float:
    words = LETTERS.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def first_pass(block: tuple[str, int, int, bool], has_main: bool) -> int:
    """A block's label by itself: GOOD, BAD or OPEN."""
    text, linked, region, boiler = block
    if boiler or has_main and not region or linked > MIN_LINK_DENSITY * len(text):
        return BAD
    if len(text) < SHORT:
        return OPEN
    density = stop_density(text)
    if density >= STOP_HIGH or density >= STOP_LOW and len(text) > LONG:
        return GOOD
    return OPEN if region or density >= STOP_LOW or len(text) <= LONG else BAD


def second_pass(found: list[tuple[str, int, int, bool]], labels: list[int]) -> list[int]:
    """OPEN blocks take the label of the nearest block that the text rules
    decided in the same region (good if two are as near, or if there is none)."""
    by_region: dict[int, list[int]] = {}
    for i, (_, _, region, boiler) in enumerate(found):
        if not boiler:
            by_region.setdefault(region, []).append(i)
    out = list(labels)
    for region, own in by_region.items():
        decided = [k for k, i in enumerate(own) if labels[i] == GOOD or labels[i] == BAD and not region]
        j = 0
        for k, i in enumerate(own):
            if labels[i] != OPEN:
                continue
            while j + 1 < len(decided) and decided[j + 1] < k:
                j += 1
            near = [(abs(d - k), -labels[own[d]]) for d in decided[j:j + 2]]
            out[i] = -min(near)[1] if near else GOOD
    return out


def main_text(page: str | None) -> str:
    """The main text of one page."""
    found = blocks(page) if page else []
    has_main = any(region and not boiler for _, _, region, boiler in found)
    labels = second_pass(found, [first_pass(b, has_main) for b in found])
    return " ".join(b[0] for b, label in zip(found, labels) if label == GOOD)


@F.arrow_udf(StringType())
def _main_text(pages: pa.Array) -> pa.Array:
    # a lone surrogate can come from no valid string, so every text encodes
    return pa.array([main_text(p) for p in pages.to_pylist()], pa.string())


def extract(df: DataFrame, html: str | Column = "html", out: str = "text") -> DataFrame:
    """``df`` with the column ``out`` (replaced if it exists): the main text of
    each row's ``html``. Row by row, so no data moves between tasks."""
    return df.withColumn(out, _main_text(F.col(html) if isinstance(html, str) else html))
