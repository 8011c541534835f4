"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags.  The first pass decides a block
by where it stands (navigation, forms and the like never hold the article; class
and id names count unless the element holds the articles or most running text),
its link density, its length and its density of stop words.  Short blocks, and
middling ones, stay undecided; the second pass gives them the label of the
nearest decided neighbours.

Stop words are those listed, and on a page in another language those it shows itself:
short words, or characters where words are not spaced, that its running text repeats.
A form around the page, and a header, menu or the like that is never closed, hold the
article as any element does where the articles or most running text lie in them.

Defined results: a null or empty page has an empty text; a page without any
block of text too.  Unclosed and stray tags are taken as browsers take them: an
end tag closes what is open inside it, one without a start is ignored.  Pages
of any size are read whole.  Rows are independent: repeated rows and ids
repeat their results.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from html import unescape

import pandas as pd
from pyspark.sql import Column, functions as F

SHORT = 70          # characters: below this a block is undecided
LONG = 200          # from here on, stop words alone make a block good
STOP_LOW, STOP_HIGH = 0.15, 0.30  # stop words among a block's words
LINKS = 0.33        # share of a block's characters in links
LINKS_INSIDE = 0.8  # the same, where blocks inside an article or main element are bad at once
OVERRULE = 3        # running text outside, times that of the best article
TYPICAL = 0.38      # stop words among the words of running text
FUNCTION = 4        # letters of a function word at most, on a page that shows its own
WIDE = 3            # letters that a character counts for where words are not spaced

# Frequent function words of the languages that pages come in.
STOP_WORDS = frozenset("""
a about after all an and are as at be been but by can do for from had has have he her his i if in
into is it its more no not of on one or she so that the their them there they this to up was we
were what when which who will with would you
aber als am an auch auf aus bei bin bis das dass dem den der des die doch du durch ein eine einem
einen einer er es für hat ich ihr im in ist ja kann man mit nach nicht noch nur oder sich sie sind
so über um und uns von vor war was wenn wie wir wird zu zum zur
au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur lui mais ne
nous on ou où par pas plus pour qu que qui sa se ses son sont sur un une vous y à été
al como con cuando del el ella en entre era es esta este fue ha hay la las lo los más muy no o para
pero por que se ser si sin sobre su sus también un una uno ya
""".split())

# Element names, by what they do to the text.
BLOCKS = frozenset("""
address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
optgroup option p pre search section summary table tbody td tfoot th thead title tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp noembed noframes".split())
NEVER = frozenset("""
head nav header footer aside form menu button select script style title textarea template noscript
iframe object svg canvas audio video dialog search xmp noembed noframes
""".split())
# Of these, a form may go around the page, and the others may lack their end tag.
AROUND = frozenset("form header nav footer aside".split())
ROLES = frozenset("""
navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar
""".split())
# Words in class and id that name what is not the article.
NAMES = frozenset("""
ad ads adslot advert adverts advertisement advertising sponsor sponsored promo promoted promotion
banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter
subscribe subscription signup login sidebar sidenav rail widget widgets menu menus nav navbar
navigation breadcrumb breadcrumbs header masthead topbar footer comment comments commentlist respond
reply replies disqus share sharing social related recommended recommendations pagination pager toolbar
skip searchform searchbox
""".split())
# Words that only shape a box, after one that names it, and words
# that speak of another box or of its absence.
SHAPES = frozenset("""
area bar block box button buttons col column container content group icons inner item items left
link links list main post posts primary right row section secondary slot text title unit wrap wrapper
""".split())
OTHERS = frozenset("has no with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
REPLIES = frozenset("comment comments commentlist respond reply replies disqus".split())
INSIDE = {"article": 2, "main": 1}
ROOTS = frozenset("html body main".split())

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PARTS = re.compile(r"[^0-9a-z]+|(?<=[a-z])(?=[A-Z])")


_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"
                       "\U00020000-\U0003ffff]")


@dataclass
class Block:
    text: str
    linked: int     # characters in links
    inside: int     # bits: 2 in an article element, 1 in a main element
    never: bool     # where no article stands
    article: int    # number of the article or main element
    named: tuple[int, ...] = ()  # elements around it that speak against it
    label: str = ""
    stops: frozenset = STOP_WORDS   # the page's function words
    scale: float = 1.0              # of their density, where the page showed them itself
    heading: bool = False

    @property
    def link_density(self) -> float:
        return self.linked / max(1, len(self.text))

    @cached_property
    def size(self) -> int:
        """Characters; those of a script without spaces between words count for more."""
        if self.text.isascii():
            return len(self.text)
        return len(self.text) + (WIDE - 1) * len(_UNSPACED.findall(self.text))

    @property
    def words(self) -> list[str]:
        """Words, or characters of a script without spaces between words."""
        if not self.text.isascii() and 3 * len(wide := _UNSPACED.findall(self.text)) >= len(self.text):
            return wide
        return [w.strip(".,;:!?\"'()[]«»“”„") for w in self.text.lower().split()]

    @cached_property
    def stop_density(self) -> float:
        words = self.words
        return self.scale * sum(w in self.stops for w in words) / max(1, len(words))


def _learn_stops(page: list[Block]) -> None:
    """On a page whose running text has fewer of the listed stop words than such text has:
    those that it shows itself too, and their density in proportion to the usual one."""
    running = [b for b in page if not b.never and b.size >= SHORT and b.link_density <= LINKS]
    size = sum(b.size for b in running)
    if not size or sum(b.stop_density * b.size for b in running) >= STOP_HIGH * size:
        return
    words = [w for b in running for w in b.words]
    counts = Counter(w for w in words if len(w) <= FUNCTION and w.isalpha())
    shown = frozenset(w for w, n in counts.items() if n >= 2 and 200 * n >= len(words))
    stops = shown | STOP_WORDS
    share = sum(w in stops for w in words) / len(words)
    if len(shown) >= 3 and share >= STOP_LOW / 2:
        for b in page:
            b.stops, b.scale = stops, max(1.0, TYPICAL / share)
            b.__dict__.pop("stop_density", None)


def _named(words: str) -> set[str]:
    """Words of NAMES that tokens of a class or id are, end in, or start with before
    words of shape alone."""
    out = set()
    for token in words.split():
        parts = [p for p in re.split(r"[^0-9a-z]+", re.sub(
            r"([a-z])([A-Z])", r"\1-\2", token).lower()) if p and not p.isdigit()]
        if parts and not OTHERS & set(parts):
            shape = set(parts[1:]) <= SHAPES
            out |= NAMES & {"".join(parts), parts[-1], parts[0] if shape else ""}
    return out


def _outside(tag: str, attrs: str) -> tuple[bool, bool]:
    """Whether an element with this start tag cannot hold the article, and whether
    its names say that it does not."""
    if tag in NEVER:
        return True, False
    if not attrs or "=" not in attrs and "hidden" not in attrs.lower():
        return False, False
    got = {}
    for name, a, b, c in _ATTR.findall(attrs):
        got.setdefault(name.lower(), unescape(a or b or c))
    if tag in ROOTS:
        return False, False
    names = set() if tag in HEADINGS else _named(f"{got.get('class', '')} {got.get('id', '')}")
    if tag == "article":
        return bool(names & REPLIES), False
    style = got.get("style", "").replace(" ", "").lower()
    return (bool(names & REPLIES) or got.get("role", "").lower() in ROLES or "hidden" in got
            or got.get("aria-hidden", "").lower() == "true"
            or "display:none" in style or "visibility:hidden" in style), bool(names)


def blocks(html: str | None) -> list[Block]:
    """The page's blocks of text in page order, not labelled yet."""
    html = html or ""
    out: list[Block] = []
    text: list[str] = []
    linked, at = 0, 0
    outer = (False, 0, False, (), 0)
    open_: list[tuple[str, bool, int, bool, tuple, int]] = []  # tag, never, inside, link, named, article
    never, inside, link, named, article = outer
    kinds: list[str] = []            # of the elements that speak against their text: tag, or "" (names)
    closed: set[int] = set()         # those of them with an end tag
    paths: list[tuple[int, ...]] = []  # of each article, those around it
    heads: set[int] = set()          # those with a headline in them

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            raw = unescape(raw) if "&" in raw else raw
            text.append(raw)
            if link:
                linked += len("".join(raw.split()))

    def flush() -> None:
        nonlocal linked
        if text:
            line = " ".join("".join(text).split())
            if line:
                out.append(Block(line, linked, inside, never, article, named,
                                 heading=bool(open_) and open_[-1][0] in HEADINGS))
            text.clear()
        linked = 0

    size = len(html)
    while at < size:
        m = _TAG.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS or tag in NEVER:
            flush()
        if m[1]:
            if any(x[0] == tag for x in open_):
                while (last := open_.pop())[0] != tag:
                    pass
                if tag in AROUND and last[4] and kinds[last[4][-1]] == tag:
                    closed.add(last[4][-1])
                never, inside, link, named, article = open_[-1][1:] if open_ else outer
        elif tag not in VOID:
            if tag == "p" and open_ and open_[-1][0] == "p":
                open_.pop()
                never, inside, link, named, article = open_[-1][1:] if open_ else outer
            if not never:
                if tag in AROUND:
                    named += (len(kinds),)
                    kinds.append(tag)
                else:
                    never, by_name = _outside(tag, m[3])
                    if by_name and not never:
                        named += (len(kinds),)
                        kinds.append("")
            if not never:
                if tag in INSIDE:
                    paths.append(named)
                    if not inside & INSIDE[tag]:
                        inside, article = inside | INSIDE[tag], len(paths)
                elif tag in ("h1", "h2"):
                    heads.update(named)
            link = link or tag == "a"
            open_.append((tag, never, inside, link, named, article))
            if tag in RAW:  # up to its end tag there is no markup
                end = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
                at = end.start() if end else size
    flush()
    # A closed header, menu or the like never holds the article; a form with its end tag may.
    shut = {i for i in closed if kinds[i] != "form"}
    for b in out:
        b.never = b.never or not shut.isdisjoint(b.named)
    paths = [p for p in paths if shut.isdisjoint(p)]
    _learn_stops(out)
    _overrule(out, kinds, {i for i in set().union(*paths) if all(i in p for p in paths)}, heads)
    return out


def _sure(b: Block) -> bool:
    """A long block of running text."""
    return b.size >= LONG and b.link_density <= LINKS and b.stop_density >= STOP_HIGH


def _overrule(page: list[Block], kinds: list[str], held: set[int], heads: set[int]) -> None:
    """What an element is speaks against its text, unless it holds all articles of the
    page (``held``) or half of its running text or more; a form, three quarters of it
    and a headline."""
    if not any(b.named for b in page):
        return
    sizes: dict[int, int] = {}
    every = 0
    for b in page:
        if not b.never and _sure(b):
            every += len(b.text)
            for i in b.named:
                sizes[i] = sizes.get(i, 0) + len(b.text)
    held = held | {i for i, n in sizes.items() if 2 * n >= every and (
        kinds[i] != "form" or 4 * n >= 3 * every and i in heads)}
    for b in page:
        b.never = b.never or not held.issuperset(b.named)
        if b.never:
            b.inside = 0


def _level(page: list[Block]) -> int:
    """Where the text is: in articles, else in main elements, else anywhere.  An
    element of that kind is believed unless OVERRULE times as much running text as
    the best one has lies outside all of them."""
    for level in [x for x in (2, 1) if any(b.inside & x and not b.never for b in page)]:
        best: dict[int, int] = {}
        outside = 0
        for b in page:
            if b.never:
                continue
            if b.inside & level:
                plain = b.link_density <= LINKS and (
                    b.size >= LONG or b.size >= SHORT and b.stop_density >= STOP_LOW)
                best[b.article] = best.get(b.article, 0) + plain * len(b.text)
            elif _sure(b):
                outside += len(b.text)
        if outside <= OVERRULE * max(best.values()):
            return level
    return 0


def label(page: list[Block]) -> list[Block]:
    """Both passes: every block gets the label good or bad."""
    level = _level(page)
    held = [b for b in page if level and b.inside & level and not b.never]
    # In an article of a language without known stop words they say nothing.
    whole = sum(len(b.text) for b in held)
    known = sum(b.stop_density * len(b.text) for b in held) >= STOP_LOW * whole
    for b in page:
        if b.never or level and not b.inside & level:
            b.label = "bad"
        elif b.link_density > (LINKS_INSIDE if level else LINKS):
            b.label = "bad"
        elif b.size < SHORT:
            b.label = ""
        elif level and not known:
            b.label = "good" if b.link_density <= LINKS else ""
        elif b.stop_density >= STOP_HIGH and b.size >= LONG and b.link_density <= LINKS:
            b.label = "good"
        elif level:  # the article speaks for it, few stop words or many links against it
            b.label = "good" if b.stop_density >= STOP_LOW and b.link_density <= LINKS else ""
        else:
            b.label = "bad" if b.stop_density < STOP_LOW else ""
    # A short block in an article looks at that article's blocks alone: the menu
    # before a headline says nothing about it.
    _inherit(held or page, "good" if held else "bad")
    return page


def _inherit(row: list[Block], otherwise: str) -> None:
    """Undecided blocks take the label of the nearest decided block before and
    after; where these differ, the nearer one's, and ``otherwise`` on a tie, but that a
    headline goes with what it heads."""
    decided = [i for i, b in enumerate(row) if b.label]
    new, k = {}, 0
    for i, b in enumerate(row):
        if b.label:
            k += 1
            continue
        before = decided[k - 1] if k else None
        after = decided[k] if k < len(decided) else None
        if before is None and after is None:
            new[i] = otherwise
        elif before is None or after is None:
            new[i] = row[after if before is None else before].label
        elif i - before == after - i and row[before].label != row[after].label:
            new[i] = row[after].label if b.heading and otherwise == "bad" else otherwise
        else:
            new[i] = row[before if i - before <= after - i else after].label
    for i, x in new.items():
        row[i].label = x


def main_text(html: str | None) -> str:
    return " ".join(b.text for b in label(blocks(html)) if b.label == "good")


def extracted(html: Column | str) -> Column:
    """struct(text, n_chars) of the main text."""
    @F.pandas_udf("text string, n_chars long")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for pages in batches:
            texts = [main_text(p) for p in pages]
            yield pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})
    return each(F.col(html) if isinstance(html, str) else html)
