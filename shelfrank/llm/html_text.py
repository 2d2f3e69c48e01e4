"""Main text of web pages by two passes over their blocks.

The first pass classifies blocks by where they stand, link density, stop-word density and length;
the second gives undecided blocks the label of their nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Comments, declarations, whole scripts and the like, tags, text.  Possessive, so a stray bracket costs one look ahead.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|math|iframe|object|textarea|select|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*>"
    r"|(?P<text>[^<]++|<)",
    re.S | re.I,
)
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody"
    " td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold no article text, whatever it looks like.
ASIDE_TAGS = frozenset("nav footer aside form header menu button dialog label option search".split())
MAIN_TAGS = frozenset(("article", "main"))
#: Elements that stand inside a sentence; only adverts and share links mark these, since comment or notice are styles there.
INLINE_TAGS = frozenset(
    "a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strong sub sup time u var".split()
)
INLINE_WORDS = re.compile(r"(?:ads?|advert(?:s|isements?|ising)?|sponsor(?:s|ed)?|promo(?:s|tions?|ted)?|shar(?:es?|ing))", re.I)
#: Words of a class, id or role that mark such a place.
ASIDE_WORDS = re.compile(
    r"(?:ads?|advert(?:s|isements?|ising)?|banners?|sponsor(?:s|ed)?|promo(?:s|tions?|ted)?|nav(?:s|bar|igation|menu)?|menu(?:s|bar)?"
    r"|breadcrumbs?|sidebars?|footer|header|cookies?|consent|notices?|popup|modal|newsletters?|subscribe|comments?|replies|reply|disqus"
    r"|shar(?:es?|ing)|social|related|login|search(?:box|bar|form)?|complementary|contentinfo)",
    re.I,
)
#: Words that follow the one that names the place, as in comment-list or ad-slot-2.
FOLLOWING = re.compile(
    r"(?:[0-9x]*|box|bar|block|list|items?|container|wrapper|wrap|inner|outer|area|region|zone|widget|section|panel|slot|unit|links?"
    r"|buttons?|icons?|form|top|bottom|left|right|posts?|articles?|stories|group|row|column|overlay|signup|threads?|results?|media|dialog"
    r"|fixed|sticky|desktop|mobile|primary|secondary)",
    re.I,
)
#: What has a header of its own, with the title of the article.
TITLED = frozenset("post entry article story content page section title".split())
#: A word that only tells whether the page has such a place, as in with-sidebar.
TELLS = re.compile(r"(?:^|[_-])(?:with|without|has|have|no|not|non)[_-]", re.I)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]++)))?+")
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)

# Function words of the languages expected.
STOP_WORDS = frozenset(
    "a an and are as at be by for from in is it of on or that the this to was were with"
    " au aux avec ce dans de des du elle en est et il la le les leur mais ne ou par pas pour qui que sur un une"
    " als auf aus bei das dem den der des die ein eine einem einer es für ich im ist mit nicht sich sie und von wie zu zum"
    " al como con del el ella en entre era es esta las lo los más no para pero por se sin su sus un una y".split()
)
SPACES = re.compile(r"\s+")
WORDS = re.compile(r"\w+")

#: Scripts that write a word in one or two signs; such a sign counts as three.
DENSE = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7a3]")

LINKS_HIGH = 0.5
STOPS_LOW, STOPS_HIGH = 0.15, 0.25
SHORT, LONG = 70, 200
#: Below this share of function words over its longer blocks, a page is in no language expected.
STOPS_KNOWN = 0.1
#: A form outside any article is no form but the page itself if it holds more than this share of the open text.
FORM_MOST = 0.5

GOOD, BAD, UNSURE = 1, -1, 0


@dataclass
class Block:
    """A run of text between block tags."""

    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    aside: bool = False
    region: int = 0
    heading: bool = False
    form: int = 0
    text: str = ""


#: How sure a place is no part of the text: a marked one may yet hold the article, an aside one may not.
OPEN, MARKED, ASIDE = 0, 1, 2


def _marks(name: str, tag: str, inside_main: bool) -> bool:
    """Whether a class, id or role names a place that holds no article text.

    Of a compound the last word counts that is no mere place or number: comment-list is one, social-sciences is not.
    """
    if TELLS.search(name):
        return False
    parts = re.split("[_-]+", name)
    while len(parts) > 1 and FOLLOWING.fullmatch(parts[-1]):
        parts.pop()
    if tag in INLINE_TAGS:
        return bool(INLINE_WORDS.fullmatch(parts[-1]))
    if parts[-1].lower() == "header" and (inside_main or any(p.lower() in TITLED for p in parts)):
        return False
    return bool(ASIDE_WORDS.fullmatch(parts[-1]))


def _place(tag: str, attributes: str, inside_main: bool) -> int:
    if tag in ASIDE_TAGS and (tag != "form" or inside_main):
        return OPEN if inside_main and tag == "header" else ASIDE
    if tag in ("html", "body") or not attributes:
        return OPEN
    values: dict[str, str] = {}
    for name, *value in ATTRIBUTE.findall(attributes):
        values.setdefault(name.lower(), "".join(value))
    classes = values.get("class", "")
    hidden = "hidden" in values or "hidden" in classes.lower().split() or values.get("aria-hidden", "").strip().lower() == "true"
    if tag not in MAIN_TAGS and (hidden or NO_DISPLAY.search(values.get("style", ""))):
        return ASIDE
    names = f"{classes} {values.get('id', '')} {values.get('role', '')}".split()
    return MARKED if any(_marks(n, tag, inside_main) for n in names) else OPEN


def blocks_of(page: str) -> list[Block]:
    """Blocks with text in page order; ``region`` numbers the article or main element they stand in, 0 outside.

    Text of an aside element inside a paragraph is left out of it.
    """
    found: list[Block] = []
    stack: list[tuple[str, int, int, int]] = []
    aside, region, regions, form, forms, links, heading = OPEN, 0, 0, 0, 0, 0, False
    block = Block()

    def close() -> None:
        nonlocal block
        text = SPACES.sub(" ", html.unescape("".join(block.pieces))).strip()
        if text:
            block.text = text
            found.append(block)
        block = Block(aside=aside > OPEN, region=region, heading=heading, form=form)

    for token in TOKEN.finditer(page):
        kind = token.lastgroup
        if kind == "text":
            if aside > OPEN and not block.aside:
                continue
            piece = token.group()
            block.pieces.append(piece)
            if links:
                block.linked += len(SPACES.sub("", html.unescape(piece)))
            continue
        tag = token.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            block.pieces.append(" ")
            continue
        if token.group("close"):
            if tag == "a":
                links = max(0, links - 1)
            level = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if level is not None:
                _, aside, region, form = stack[level]
                del stack[level:]
                heading = any(entry[0] in HEADINGS for entry in stack)
        else:
            attributes = token.group("attributes")
            if tag == "a":
                links = 1
            elif tag not in VOID_TAGS and not attributes.endswith("/"):
                if tag == "p" or tag in HEADINGS:  # neither holds another p
                    level = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"), None)
                    if level is not None and not any(entry[0] in BLOCK_TAGS for entry in stack[level + 1 :]):
                        _, aside, region, form = stack[level]
                        del stack[level:]
                stack.append((tag, aside, region, form))
                if tag == "form" and not region and not form:
                    forms += 1
                    form = forms
                place = _place(tag, attributes, bool(region))
                if tag not in MAIN_TAGS:
                    aside = max(aside, place)
                elif not region and (aside == OPEN or (aside == MARKED and place == OPEN)):
                    regions += 1
                    aside, region = OPEN, regions
                heading = heading or tag in HEADINGS
        if tag in BLOCK_TAGS:
            links = 0 if tag != "a" and not token.group("close") else links
            close()
    close()
    _settle_forms(found)
    return found


def _settle_forms(blocks: list[Block]) -> None:
    """Mark the blocks of forms, but for a form round the page itself."""
    open_text: Counter[int] = Counter()
    for b in blocks:
        if not b.aside:
            open_text[b.form] += len(b.text)
    most = FORM_MOST * open_text.total()
    outside = any(b.region and not b.form for b in blocks)
    for b in blocks:
        if b.form and (outside or open_text[b.form] <= most):
            b.aside = True


def _length(text: str) -> int:
    return len(text) + 2 * len(DENSE.findall(text))


def _stops(text: str) -> tuple[int, int]:
    words = WORDS.findall(text.lower())
    return sum(w in STOP_WORDS for w in words), len(words)


def known_language(blocks: list[Block]) -> bool:
    """Whether the longer blocks of a page hold the function words of an expected language; so if there are none."""
    stops = words = 0
    for b in blocks:
        if not b.aside and len(b.text) >= SHORT and b.linked <= LINKS_HIGH * len(b.text.replace(" ", "")):
            found, all_words = _stops(b.text)
            stops, words = stops + found, words + all_words
    return stops >= STOPS_KNOWN * words


def first_label(block: Block, known: bool = True) -> int:
    """The first pass: a decided label, or unsure for short blocks and for such without function words.

    Where the language is not ``known``, length and links decide alone.  A linked sentence of an article is unsure.
    """
    if block.aside:
        return BAD
    size = len(block.text.replace(" ", ""))
    length = _length(block.text)
    found, words = _stops(block.text)
    stops = found / max(1, words)
    if block.linked > LINKS_HIGH * size:
        sentence = block.region and length >= SHORT and (stops >= STOPS_HIGH or not known)
        return UNSURE if sentence else BAD
    if block.heading or length < SHORT:
        return UNSURE
    if not known:
        return GOOD if length >= LONG else UNSURE
    if stops >= STOPS_HIGH:
        return GOOD
    if stops >= STOPS_LOW:
        return GOOD if length >= LONG else UNSURE
    return UNSURE if block.region else BAD


def label_blocks(blocks: list[Block]) -> list[int]:
    """Both passes.

    An unsure block takes the label of the nearest decided blocks before and after it in the same
    region; if they differ, the nearer one's, and the good one at equal distance; a heading looks
    after itself first.  Where a region has no decided block, its unsure ones are good inside
    an article or main element and bad outside.
    """
    known = known_language(blocks)
    labels = [first_label(b, known) for b in blocks]
    # Bad places inside a region say nothing about the article around them.
    decided = [i for i, b in enumerate(blocks) if labels[i] != UNSURE and not (b.region and labels[i] == BAD)]
    before: list[int | None] = [None] * len(blocks)
    after: list[int | None] = [None] * len(blocks)
    last: int | None = None
    sure = set(decided)
    for i in range(len(blocks)):
        before[i] = last if last is not None and blocks[last].region == blocks[i].region else None
        last = i if i in sure else last
    last = None
    for i in range(len(blocks) - 1, -1, -1):
        after[i] = last if last is not None and blocks[last].region == blocks[i].region else None
        last = i if i in sure else last
    final = list(labels)
    for i, b in enumerate(blocks):
        if labels[i] != UNSURE:
            continue
        left, right = before[i], after[i]
        if left is None and right is None:
            final[i] = GOOD if b.region else BAD
        elif left is None or right is None:
            final[i] = labels[right if left is None else left]
        elif labels[left] == labels[right]:
            final[i] = labels[left]
        elif b.heading:
            final[i] = labels[right]
        else:
            nearer = sorted(((i - left, -labels[left], left), (right - i, -labels[right], right)))[0][2]
            final[i] = labels[nearer]
    return final


def main_text(page: str | None) -> str:
    """The good blocks of a page, white space folded, joined by empty lines."""
    if not page:
        return ""
    blocks = blocks_of(page)
    return "\n\n".join(b.text for b, label in zip(blocks, label_blocks(blocks), strict=True) if label == GOOD)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page, from its whole html.

    Null, empty and text-free pages have an empty text.  Unclosed tags and comments reach to the end of
    what they stand in.  Repeated rows are repeated, an empty table gives no rows, other columns are ignored.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = [main_text(page) for page in part.column(2).to_pylist()]
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
