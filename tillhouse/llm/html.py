"""Main text of web pages by two passes of block rules.

A page is cut into blocks at its block-level tags. The first pass labels each block: blocks in menus, headers, footers,
sidebars, notices, adverts, forms and reader comments (by tag, class, id or role) are bad, as are blocks that are mostly
links; long blocks with enough stop words are good; so are long blocks within the page's article, whatever their words.
Short blocks, and those with few stop words, stay open. The second pass gives them the label of the nearest decided
block, the good one at equal distance. Where a page marks its article, only blocks within are looked at and both its
ends count as good; where no block at all is decided good, open ones are kept. On a page whose long blocks hold hardly any of the stop words, as in another language
or in code, these can't tell: there long blocks with few links are good. Blocks outside of a marked article are judged apart, as on a page without a mark.

A bad class, id or role (and a form) is a hint only: it is ignored where no article lies outside of such elements and
the element holds most of the page's text. Names after no-, has- or with- tell of the layout and say nothing.

A page is a row, and rows are independent, so tasks extract in batches without a shuffle.

Defined results: NULL or empty html, and a page without main text, give an empty text; NULL ids and urls stay; rows
repeated are extracted each; an empty table gives an empty result; other columns are ignored. Broken markup doesn't
fail: open elements end with the element around them, and an unclosed comment or script ends with the page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT = 70  # characters of a block that its words alone don't decide
LONG = 200  # characters of a block that stop words alone make good
MANY_STOPS = 0.3  # share of stop words in running text
SOME_STOPS = 0.15
FEW_STOPS = 0.05  # share in all long blocks, below which stop words can't tell
FEW_LINKS = 0.2
LINKS = 0.5  # share of a block's characters in links, above which it is bad

# Frequent words of the languages at hand.
STOPS = frozenset("""
a about all an and are as at be been but by can for from had has have he her his i if in into is it its more no not of on
only or our she so than that the their there they this to was we were what when which who will with would you
aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich
im in ist mit nach nicht noch oder sich sie sind so und um von vor war wie wir zu zum zur über
au aux avec ce ces dans de des du elle en est et eux il ils je la le les leur lui mais même ne nous on ou par pas pour
plus qu que qui sa se ses son sont sur un une vous
al como con de del el ella en entre era es esta este ha las lo los más muy no nos para pero por que se ser si sin sobre
su sus también un una y ya
""".split())

BLOCKS = frozenset("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody
td tfoot th thead tr ul
""".split())
NESTED = frozenset("article aside blockquote details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split())
SKIPPED = frozenset("script style title noscript template svg math iframe object canvas textarea select button audio video".split())
BAD_TAGS = frozenset("nav header footer aside menu dialog".split())
# Words of a class, id or role.
BAD_NAMES = frozenset("""
ad ads adsbygoogle advert adverts advertisement advertisements advertising alert banner breadcrumb breadcrumbs comment
commentlist comments complementary consent contentinfo cookie cookies dialog disclaimer discussion disqus footer form gdpr
hidden login masthead menu modal nav navbar navigation newsletter notice notices notification pagination popup promo
promoted promotion recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored
subscribe toolbar widget widgets
""".split())
EDGE_NAMES = frozenset("header top bottom topbar".split())  # bad outside of the article
GOOD_NAMES = frozenset("article content entry main post story".split())

# Names that silence running text too, where others are used for highlighting.
ADVERTS = frozenset("ad ads adsbygoogle advert adverts advertisement advertisements promo promoted sponsor sponsored".split())

TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*+)")
STOP = re.compile("[<>\"']")
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")  # parts of my-name, my_name and myName
LAYOUT = re.compile(r"(?:no|has|with|without)[-_]", re.I)
UNSEEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
WORD = re.compile(r"[^\W\d_]+")

BAD, OPEN, GOOD = 0, 1, 2


def _end_of_tag(html: str, at: int, last: dict[str, int]) -> int:
    """The place after the tag's ``>``, which isn't one in a quoted value; -1 where another tag begins before it."""
    while m := STOP.search(html, at):
        sign, at = m[0], m.end()
        if sign == ">":
            return at
        if sign == "<":
            return -1
        before = m.start() - 1
        while html[before].isspace():
            before -= 1
        if html[before] == "=":
            if m.start() >= last[sign]:
                return -1
            at = html.index(sign, at) + 1
    return -1


class _Tags:
    """The tags of a page one after the other. Every character is looked at a few times at most, however broken."""

    def __init__(self, html: str) -> None:
        self.html, self.at = html, 0
        self.last = {sign: html.rfind(sign) for sign in "\"'>"}

    def next(self) -> tuple[int, bool, str, str] | None:
        """Where the next tag or comment begins, whether it closes, its name (none: no element) and its attributes."""
        html, look = self.html, self.at
        while (start := html.find("<", look)) >= 0:
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                self.at = end + 3 if end >= 0 else len(html)
                return start, False, "", ""
            look = start + 1
            if start > self.last[">"]:
                look = html.find("<!--", start)
                if look < 0:
                    return None
            elif m := TAG_NAME.match(html, start):
                end = _end_of_tag(html, m.end(), self.last)
                self.at = end if end >= 0 else html.index(">", m.end()) + 1
                return start, bool(m[1]), m[2].lower(), html[m.end():self.at - 1]
            elif html[look:look + 1] in ("!", "?", "/"):
                self.at = html.index(">", look) + 1
                return start, False, "", ""
        return None

    def skip(self, tag: str) -> None:
        """Go behind the closing tag."""
        m = re.compile(f"</{tag}", re.I).search(self.html, self.at)
        end = self.html.find(">", m.end()) if m else -1
        self.at = end + 1 if end >= 0 else len(self.html)


class _Blocks:
    """The blocks of a page: text, characters in links, whether in a bad element, whether in an article, and a hint."""

    def __init__(self) -> None:
        self.found: list[tuple[str, int, bool, bool, int]] = []
        self.stack: list[tuple[str, bool, bool, bool]] = []  # elements that matter: tag, bad, article, whether with a hint
        self.depth: Counter[str] = Counter()  # of the tags in the stack
        self.hints = [0]  # numbers of the open elements that a name makes bad, innermost last
        self.around = [0]  # for each such number, the next one outwards; 0 is none
        self.pieces: list[tuple[str, bool]] = []
        self.bad = self.article = 0
        self.in_link = False
        self.silent: list[str] = []  # open elements within running text, from one that isn't shown

    def text(self, data: str) -> None:
        if data and not self.silent:
            self.pieces.append((data, self.in_link))

    def flush(self) -> None:
        self.silent = []
        if not self.pieces:
            return
        text = " ".join(unescape("".join(p for p, _ in self.pieces)).split())
        if text:
            linked = len(" ".join(unescape("".join(p for p, link in self.pieces if link)).split()))
            self.found.append((text, linked, self.bad > 0, self.article > 0, self.hints[-1]))
        self.pieces = []

    @staticmethod
    def _names(attributes: str) -> set[str]:
        names: set[str] = set()
        for m in NAMES.finditer(attributes):
            for name in (m[1] or m[2] or m[3] or "").split():
                if not LAYOUT.match(name):
                    names.update(x.lower() for x in NAME_WORDS.findall(name))
        return names

    def open(self, tag: str, attributes: str) -> None:
        """A block element; those that neither nest nor matter leave no trace."""
        if self.stack and (self.stack[-1][0] == "p" or (self.stack[-1][0] == tag and tag not in NESTED)):
            self._pop()  # its closing tag may be left out
        names = self._names(attributes) if attributes else set()
        hidden = bool(attributes) and bool(UNSEEN.search(attributes))
        if tag not in NESTED:
            hint = bool(names & BAD_NAMES)
            if (hidden or hint) and tag not in ("html", "body"):
                self._push(tag, hidden, False, hint)
            return
        good = tag in ("article", "main") or (tag in ("div", "section") and bool(names & GOOD_NAMES) and not names & EDGE_NAMES)
        hint = bool(names & BAD_NAMES) or (not good and (tag == "form" or bool(names & EDGE_NAMES and not self.article)))
        bad = hidden or (not good and tag in BAD_TAGS and not (tag == "header" and self.article))
        self._push(tag, bad, good and not bad and not hint, hint)

    def inline(self, tag: str, closing: bool, attributes: str) -> None:
        """An element within running text: silent with all it holds if hidden or an advert."""
        if self.silent:
            if closing:
                if tag in self.silent:
                    while self.silent.pop() != tag:
                        pass
            elif tag == self.silent[0] and not attributes.endswith("/"):
                self.silent.append(tag)
        elif attributes and not closing and tag not in ("br", "wbr", "img", "input", "hr", "meta", "link") and (
                UNSEEN.search(attributes) or self._names(attributes) & ADVERTS):
            self.silent = [tag]

    def _push(self, tag: str, bad: bool, article: bool, hint: bool) -> None:
        self.stack.append((tag, bad, article, hint))
        self.depth[tag] += 1
        self.bad += bad
        self.article += article
        if hint:
            self.around.append(self.hints[-1])
            self.hints.append(len(self.around) - 1)

    def _pop(self) -> str:
        tag, bad, article, hint = self.stack.pop()
        self.depth[tag] -= 1
        self.bad -= bad
        self.article -= article
        if hint:
            self.hints.pop()
        return tag

    def close(self, tag: str) -> None:
        if tag in NESTED:
            if self.depth[tag]:
                while self._pop() != tag:
                    pass
            self.in_link = False
        elif self.stack and self.stack[-1][0] == tag:
            self._pop()

    def judged(self) -> list[tuple[str, int, bool, bool]]:
        """The blocks, with hints either ignored or made verdicts.

        A hint is ignored where its element holds most of the page; then so are all hints around it.
        """
        own = [0 if bad else len(text) - linked for text, linked, bad, _, _ in self.found]
        ignored = [False] * len(self.around)
        if not any(n and article and not hint for n, (_, _, _, article, hint) in zip(own, self.found)):
            inside, whole = [0] * len(self.around), sum(own)
            for n, (*_, hint) in zip(own, self.found):
                inside[hint] += n
            for hint in range(len(inside) - 1, 0, -1):
                ignored[hint] = 2 * inside[hint] > whole
                inside[self.around[hint]] += inside[hint]
        ignored[0] = True
        return [(text, linked, bad or not ignored[hint], article) for text, linked, bad, article, hint in self.found]


def blocks(html: str) -> list[tuple[str, int, bool, bool]]:
    page, tags, at = _Blocks(), _Tags(html), 0
    while found := tags.next():
        start, closing, tag, attributes = found
        page.text(html[at:start])
        at = tags.at
        if not tag:
            continue
        if tag in SKIPPED and not closing and not attributes.endswith("/"):
            tags.skip(tag)
            at = tags.at
        elif tag in BLOCKS:
            page.flush()
            if closing:
                page.close(tag)
            else:
                if attributes and tag not in NESTED and tag not in ("html", "body"):
                    page.in_link = False
                page.open(tag, attributes)
        else:
            page.inline(tag, closing, attributes)
            if tag == "a":
                page.in_link = not closing
            elif tag == "br":
                page.text(" ")
    page.text(html[at:])
    page.flush()
    return page.judged()


def _first_label(text: str, linked: int, bad: bool, article: bool, telling: bool) -> int:
    if bad or linked > LINKS * len(text):
        return BAD
    if "©" in text and not article and len(text) < LONG:
        return BAD
    if len(text) < SHORT:
        return OPEN
    if article:
        return GOOD
    if not telling:
        return GOOD if len(text) >= LONG and linked <= FEW_LINKS * len(text) else OPEN
    words, n = _stops(text)
    stops = n / max(1, words)
    if stops >= MANY_STOPS:
        return GOOD if len(text) >= LONG else OPEN
    return OPEN if stops >= SOME_STOPS else BAD


def _decided(labels: list[int], edge: int) -> list[int]:
    """Open labels replaced by that of the nearest decided block; ``edge`` is what lies beyond the ends."""
    n = len(labels)
    before, after = [(edge, n + 1)] * n, [(edge, n + 1)] * n
    for order, side in ((range(n), before), (range(n - 1, -1, -1), after)):
        label, distance = edge, 0
        for k in order:
            distance += 1
            if labels[k] != OPEN:
                label, distance = labels[k], 0
            side[k] = (label, distance)
    out = []
    for k in range(n):
        (a, near), (b, far) = before[k], after[k]
        out.append(labels[k] if labels[k] != OPEN else a if near < far else b if far < near else max(a, b))
    return out


def _stops(text: str) -> tuple[int, int]:
    """Words, and stop words among them."""
    words = WORD.findall(text.lower())
    return len(words), sum(w in STOPS for w in words)


def _telling(found: list[tuple[str, int, bool, bool]]) -> bool:
    sums = [_stops(text) for text, linked, bad, _ in found if not bad and len(text) >= SHORT and linked <= LINKS * len(text)]
    return sum(n for _, n in sums) >= FEW_STOPS * sum(words for words, _ in sums) > 0


def _labels(found: list[tuple[str, int, bool, bool]], marked: bool, telling: bool) -> list[int]:
    labels = [_first_label(*b, telling) for b in found]
    if GOOD in labels or marked:
        return _decided(labels, GOOD if marked else BAD)
    return labels


def main_text(html: str) -> str:
    found = blocks(html)
    inside = [article and not bad for _, _, bad, article in found]
    within, beyond = ([b for b, i in zip(found, inside) if i is side] for side in (True, False))
    telling = not beyond or _telling(found)
    within_labels, beyond_labels = _labels(within, True, telling), _labels(beyond, False, telling)
    if not within:
        beyond_labels = [GOOD if x == OPEN else x for x in beyond_labels]
    of = {True: iter(within_labels), False: iter(beyond_labels)}
    return "\n\n".join(b[0] for b, i in zip(found, inside) if next(of[i]) == GOOD)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h or "") for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
