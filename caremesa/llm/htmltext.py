"""Operator 8: main text of web pages by two-pass block rules.

The markup cuts a page into blocks. The first pass decides blocks by where they stand and
by stop-word density, length and link density; short or otherwise doubtful blocks stay
ambiguous. Outside the article, text has to be longer and denser. In the second pass
ambiguous blocks take the label of their nearest decided neighbour in the same part of
the page.

Elements with a role of their own (menus, footers, forms) are other parts of a page. Words in
a class, id or role, and marks of hidden elements, only suggest one: a marked region that
holds the article, or most of the text that looks like one, is a wrapper, and its mark says
nothing. A compound of which only one word is known raises what a block has to show.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremesa.llm.common import c

LONG, DENSE, LINKED = 70, 0.15, 0.34
#: Outside the article or main element, where a page has one, a block has to be that many times as long and as dense.
OUTSIDE = 2

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """
    the of and to in is that it was for on are as with by be this from or an at not
    der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er
    le la les de des du et un une en est que qui dans pour par sur au avec ne se ce pas plus il elle
    el los las y del una por con para se su al lo como más o pero sus a
    """.split()
)
# Elements whose content is never text of the article.
RAW = ("script", "style", "template", "noscript", "title", "textarea", "iframe", "svg", "object", "math")
ASIDE = frozenset("nav footer aside header menu dialog form button select option fieldset label datalist".split())
BREAKS = frozenset(
    """
    address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table
    tbody td tfoot th thead tr ul
    """.split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in a class, id or role that mark other parts of a page.
OTHER_PARTS = frozenset(
    """
    ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent notice
    gdpr alert popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb
    breadcrumbs share sharing social comment comments reply replies respond disqus related recommended recommendations
    footer masthead toolbar pagination pager widget legal login signup search contentinfo complementary
    """.split()
)
# Whole blocks that announce an advert.
AD_LABELS = frozenset("ad advert advertisement sponsored promoted anzeige werbung publicité annonce sponsorisé publicidad anuncio patrocinado".split())
COMMENTS = frozenset("comment comments reply replies respond disqus".split())
# Words that go with another to name a part of a page, and first words that only mention one.
PLACES = frozenset(
    """
    area bar block body bottom box button buttons col column container content cta footer form frame group header holder inner
    item items layer left link links list main message outer panel primary right row secondary section site slot space top
    unit wrap wrapper page global mobile desktop small large first second big mini the
    """.split()
)
MENTIONS = frozenset("with has no without not non is hide show js".split())
# Words of notices on cookies and subscriptions, with those that ask for something.
NOTICE_WORDS = frozenset(
    """
    cookie cookies consent privacy policy preferences settings browser website newsletter inbox email tracking
    datenschutz einwilligung einstellungen datenschutzerklärung confidentialité préférences consentement
    privacidad preferencias consentimiento suscríbete
    """.split()
)
ASKING = frozenset("accept agree subscribe consent sign allow akzeptieren zustimmen abonnieren accepter acceptez abonnez aceptar acepta suscríbete".split())
MAIN = ("article", "main")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(RAW)})\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)"""  # to the end, if not closed
    r"|<[!?][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]++)(?:\s*+=\s*+(?:"([^"]*+)"?|'([^']*+)'?|([^\s"'>]++)))?""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[^\W\d_]+")
GOOD, BAD, OPEN = 1, 0, None
#: What a mark says of its region: a part that is not the article, reader comments, hidden, or perhaps another part.
OTHER, COMMENT, HIDDEN, PERHAPS = "other", "comment", "hidden", "perhaps"


def attributes_of(text: str) -> dict[str, str]:
    """Attributes by lower-case name, the first of a name; an unquoted value may hold slashes."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), next((value for value in m.groups()[1:] if value is not None), ""))
    return found


def mark_of(attributes: dict[str, str]) -> str | None:
    """What the attributes of an element say of its region."""
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or _NO_DISPLAY.search(attributes.get("style", "")):
        return HIDDEN
    found = None
    for name in ("class", "id", "role"):
        for token in attributes.get(name, "").split():
            words = [word for word in re.split(r"[\W_\d]+", _CAMEL.sub("-", token).lower()) if word]
            if not words or words[0] in MENTIONS or not OTHER_PARTS.intersection(words):
                continue
            if all(word in OTHER_PARTS or word in PLACES or len(word) < 2 for word in words):
                return COMMENT if COMMENTS.intersection(words) else OTHER
            found = PERHAPS
    return found


@dataclass
class Block:
    """Text between two breaks.

    ``part``: the number of the article or main element around it, 0 outside. ``other``:
    an element around it is no part of an article. ``regions``: the marked elements
    around it. ``doubtful``: it has to show more to count as text.
    """

    text: str
    linked: int
    part: int
    other: bool
    heading: bool
    regions: tuple[int, ...] = ()
    doubtful: bool = False


_TOP = ("", 0, False, False, ())


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    #: open elements: name, number of the part, stands in another part of the page, is a link, marked regions
    stack: list[tuple[str, int, bool, bool, tuple[int, ...]]] = field(default_factory=list)
    #: by region: what its mark says, and whether an article or main element begins in it
    marks: list[str] = field(default_factory=list)
    holds: list[bool] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    open: Counter = field(default_factory=Counter)
    parts: int = 0
    heading: bool = False

    def add(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self.pieces.append(text)
        if self.stack and self.stack[-1][3]:
            self.linked += len(" ".join(text.split()))

    def close_block(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            _, part, other, _, regions = self.stack[-1] if self.stack else _TOP
            self.blocks.append(Block(text, self.linked, part, other, self.heading, regions))
        self.pieces, self.linked, self.heading = [], 0, False

    def start(self, name: str, attributes: str) -> None:
        if name in BREAKS:
            self.close_block()
            self._imply_ends(name)
            self.heading = name in ("h1", "h2", "h3", "h4", "h5", "h6")
        elif name == "br":
            self.pieces.append(" ")
        if name in VOID:
            return
        _, part, other, link, regions = self.stack[-1] if self.stack else _TOP
        mark = mark_of(attributes_of(attributes)) if attributes else None
        if name in MAIN:
            comment = mark == COMMENT or (name == "article" and any(e[0] == "article" for e in self.stack))
            other = other or comment
            if not other:
                for region in regions:
                    self.holds[region] = True
            self.parts += 1
            part = self.parts
        elif name in ASIDE and not (name == "header" and part):
            other = True
        if mark and name not in ("html", "body") and not (name in MAIN and mark != HIDDEN):
            self.marks.append(mark)
            self.holds.append(name in MAIN)
            regions = (*regions, len(self.marks) - 1)
        self.stack.append((name, part, other, link or name == "a", regions))
        self.open[name] += 1

    def _imply_ends(self, name: str) -> None:
        """A block ends an open paragraph, and an item ends the open item of its list."""
        if self.open["p"]:
            for entry in reversed(self.stack):
                if entry[0] == "p":
                    self._close("p")
                if entry[0] in BREAKS:
                    break
        if self.stack and self.stack[-1][0] == name and name in ("li", "option", "tr", "td", "th", "dt", "dd"):
            self._close(name)

    def _close(self, name: str) -> None:
        while self.open[name]:
            closed = self.stack.pop()[0]
            self.open[closed] -= 1
            if closed == name:
                return

    def end(self, name: str) -> None:
        if name in BREAKS:
            self.close_block()
        self._close(name)


def blocks_of(page: str | None) -> list[Block]:
    """The blocks of a page in their order."""
    page, state, at = page or "", _Page(), 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            state.add(page[at : token.start()])
        at = token.end()
        if token[3]:
            (state.end if token[2] else lambda name, a=token[4]: state.start(name, a))(token[3].lower())
    if at < len(page):
        state.add(page[at:])
    state.close_block()
    _weigh(state)
    return state.blocks


def _weigh(page: _Page) -> None:
    """Decides what the marks say of each block: that of a wrapper says nothing.

    A wrapper holds an article or main element, or all text of its part of the page but
    headings. Unless it is hidden or comments, several blocks that look like text will do
    if they are most of the article's text or, on a page without an article, most of
    what looks like text.
    """
    has_main = any(block.part and not block.other for block in page.blocks)
    texts, looks, several, whole, part_of = Counter(), Counter(), Counter(), Counter(), {}
    like_text = 0
    for block in page.blocks:
        if block.other or block.heading or (has_main and not block.part):
            continue
        size, good = len(block.text), _looks_like_text(block, 1)
        whole[block.part] += size
        like_text += size * good
        for region in block.regions:
            part_of[region] = block.part if region not in part_of else min(block.part, part_of[region])
            texts[region] += size
            looks[region] += size * good
            several[region] += good

    def is_wrapper(region: int, mark: str) -> bool:
        if page.holds[region] or region not in part_of:
            return page.holds[region]
        total = whole[part_of[region]]
        mostly = several[region] >= 2 and 2 * looks[region] > (total if has_main else like_text)
        return texts[region] == total or (mostly and mark not in (COMMENT, HIDDEN))

    wrappers = {region for region, mark in enumerate(page.marks) if is_wrapper(region, mark)}
    for block in page.blocks:
        said = {page.marks[region] for region in block.regions if region not in wrappers}
        block.other = block.other or bool(said - {PERHAPS})
        block.doubtful = PERHAPS in said


def _looks_like_text(block: Block, times: int) -> bool:
    """Long, dense in stop words, and not a link."""
    if block.linked > LINKED * len(block.text) or len(block.text) < times * LONG:
        return False
    words = _WORD.findall(block.text.lower())
    return sum(w in STOP_WORDS for w in words) >= times * DENSE * len(words)


def first_pass(block: Block, has_main: bool) -> int | None:
    """GOOD, BAD or OPEN by place, link density, length and stop-word density."""
    if block.other or _is_ad_label(block) or _is_notice(block):
        return BAD
    if block.linked > LINKED * len(block.text):
        # an article's own title is often a link to it
        return OPEN if block.part and block.heading else BAD
    times = (OUTSIDE if has_main and not block.part else 1) * (OUTSIDE if block.doubtful else 1)
    return GOOD if _looks_like_text(block, times) else OPEN


def _is_notice(block: Block) -> bool:
    """A short block that asks for consent or a subscription, whatever its markup."""
    if len(block.text) > 6 * LONG:
        return False
    words = _WORD.findall(block.text.lower())
    about = {word for word in words if word in NOTICE_WORDS}
    return len(about) >= 2 and not ASKING.isdisjoint(words) and 8 * sum(word in about for word in words) >= len(words)


def _is_ad_label(block: Block) -> bool:
    return len(block.text) < LONG and block.text.lower().strip(" .:-–—()[]") in AD_LABELS


def first_labels(blocks: list[Block], has_main: bool) -> list[int | None]:
    """The first pass over all blocks; an ambiguous one that follows the label of an advert is the advert."""
    labels = [first_pass(block, has_main) for block in blocks]
    for i in range(1, len(blocks)):
        last, block = blocks[i - 1], blocks[i]
        if labels[i] is OPEN and not block.heading and last.part == block.part and not last.other and _is_ad_label(last):
            labels[i] = BAD
    return labels


def second_pass(blocks: list[Block], labels: list[int | None]) -> list[int]:
    """Open blocks take the label of the nearest decided block of their part; of two as near, GOOD wins inside an article.

    Ambiguous blocks of an article without a good block are text, as markup has named it the
    article; if it has none either, so are its links. So are ambiguous blocks of a page without
    an article that has no decided block; beside an article they are not.
    """
    result = list(labels)
    has_main = any(block.part and not block.other for block in blocks)
    for indexes in _parts(blocks):
        decided = [i for i in indexes if labels[i] is not None and not blocks[i].other]
        if blocks[indexes[0]].part and GOOD not in [labels[i] for i in decided]:
            decided = []
        place = {i: k for k, i in enumerate(indexes)}
        at = 0
        for i in indexes:
            if labels[i] is not None:
                continue
            while at < len(decided) and decided[at] < i:
                at += 1
            before, after = decided[at - 1] if at else None, decided[at] if at < len(decided) else None
            if before is None and after is None:
                result[i] = GOOD if blocks[i].part or not has_main else BAD
            elif before is None or after is None:
                result[i] = labels[after if before is None else before]
            elif labels[before] == labels[after]:
                result[i] = labels[before]
            else:
                left, right = place[i] - place[before], place[after] - place[i]
                tie = GOOD if blocks[i].part else BAD
                result[i] = tie if left == right else labels[before if left < right else after]
    articles = [i for i, block in enumerate(blocks) if block.part and not block.other]
    if articles and not any(result[i] for i in articles):
        for i in articles:
            if not _is_ad_label(blocks[i]) and not _is_notice(blocks[i]):
                result[i] = GOOD
    return result


def _parts(blocks: list[Block]) -> list[list[int]]:
    parts: dict[int, list[int]] = {}
    for i, block in enumerate(blocks):
        parts.setdefault(block.part, []).append(i)
    return list(parts.values())


def main_text(page: str | None) -> str:
    """Good blocks joined by line feeds."""
    blocks = blocks_of(page)
    has_main = any(block.part and not block.other for block in blocks)
    labels = first_labels(blocks, has_main)
    return "\n".join(block.text for block, label in zip(blocks, second_pass(blocks, labels)) if label)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of all rows of ``pages`` (page_id, url, html).

    Nulls: a null html is empty; an empty page and one without any text of an article have
    the empty text. Null ids and urls stay null. Repeated rows give a row each. An empty
    table gives no rows. Other columns are ignored.
    """

    def texts(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(page) for page in pages], dtype=object)

    found = pages.select("page_id", "url", F.pandas_udf(texts, "string")("html").alias("text"))
    return found.select("page_id", "url", "text", F.length(c("text")).cast("bigint").alias("n_chars"))
