"""Main text of web pages.

Method: a page is a sequence of words and tags.  Words score positive where
their surroundings speak for the article and negative where they speak against
it, tags score negative; one linear scan finds the contiguous region with the
greatest sum.  The weights are log-odds counted on labelled pages.  Within the
region, blocks that score negative (an advert between paragraphs) are left out;
between two parts of one article they and the tags cost less than either part.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import lru_cache
from math import log

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------

#: Elements whose contents are no markup: they end at their end tag alone, whatever stands between.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
#: Elements whose contents are markup, but never text of the page, if they are closed where they were opened.
HIDDEN = frozenset("noscript template svg annotation annotation-xml object select button canvas audio video".split())
#: Elements that stand inside a line; all others limit blocks.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output progress q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr img input link meta "
                   "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mprescripts "
                   "mstyle merror mpadded mphantom mfenced menclose mtable mtr mlabeledtr mtd maction semantics annotation annotation-xml".split())
#: Elements without contents.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements and parts of class names, ids and roles that tell the purpose of a container.
PURPOSES = ("nav menu header footer aside sidebar form article main content post entry story body text "
            "advert banner promo sponsor cookie consent notice alert popup modal overlay comment discussion reply respons "
            "share social related recommend newsletter subscri signup login search breadcrumb pagination pager widget toolbar "
            "masthead copyright legal tag meta toc skip teaser trending popular disqus complementary contentinfo navigation "
            "disclaimer dialog").split()
#: Purposes that also name layout, page builders or the whole page; all others hold however much prose they surround.
DOUBTFUL = frozenset("form widget legal header alert sidebar meta tag login signup search toolbar menu skip toc".split())
#: Lines that say what they are, outside of anything that is named an article.
PHRASES = re.compile(r"(?:©|\(c\)|copyright ©|copyright \(c\)|copyright \d{4}\b).*|.*\ball rights reserved\b.*|advertisement|sponsored"
                     r"|\d[\d.,]* (?:comments?|repl(?:y|ies)|responses?|shares?|likes?)(?: (?:to|on) .*)?"
                     r"|(?:leave|post|write|add) a (?:comment|reply)|share (?:this|on)(?: \w+)?|read more|sign (?:up|in)|log ?in|subscribe", re.I)
#: Names too short to be looked for inside longer ones.
WHOLE = frozenset("ad ads adv toc tag meta nav text body post main skip form menu alert entry story login pager reply share legal".split())

#: Labelled pages: the word c is content, the word b is not.  ``%`` stands for one
#: container purpose at a time, so that every purpose occurs in every place.
_PLAIN = "<p>c c c c c c c c</p><p>c c c c <a>c</a> c c</p><h2>c c</h2><ul><li>c c c c</li><li>c c c</li></ul><p>c c c c c c c</p>"
_AGAINST = ("nav menu header footer aside sidebar form ad ads adv advert banner promo sponsor cookie consent notice alert popup modal "
            "overlay comment discussion reply respons share social related recommend newsletter subscri signup login search breadcrumb "
            "pagination pager widget toolbar masthead copyright legal tag meta toc skip teaser trending popular disqus complementary "
            "contentinfo navigation disclaimer dialog").split()
_FOR = "article main content post entry story body text".split()
_LABELLED = (
    ["<body><div class='%'><p>b b b b b</p></div><div><h1>c c c</h1>" + _PLAIN + "</div></body>",
     "<body><article><h1>c c c</h1>" + _PLAIN + "<div class='%'><p>b b b</p></div>" + _PLAIN + "</article></body>",
     "<body><main>" + _PLAIN + "</main><div class='%'><ul><li><a>b b</a></li><li><a>b b b</a></li></ul></div></body>"],
    ["<body><ul><li><a>b b</a></li><li><a>b</a></li></ul><div class='%'><h1>c c c</h1>" + _PLAIN + "</div><p><a>b b</a></p></body>",
     "<body><% ><h1>c c</h1>" + _PLAIN + "</%><div><a>b b</a> <a>b b b</a></div></body>"],
)

# --- pages as blocks ------------------------------------------------------------

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
                    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Endings with which a purpose is written; all others take "s" alone.
_ENDINGS = {"advert": "s|ise|ising|isement|isements|iser|isers", "sponsor": "s|ed|ship", "promo": "s|ted|tion|tions|tional",
            "respons": "e|es", "recommend": "s|ed|ation|ations|ing", "subscri": "be|ber|bers|bing|ption|ptions",
            "comment": "s|ing|er|ers"}
_BEFORE = "site|page|main|global|top|left|right|bottom|blog|web|primary|secondary|inner|outer|sub|user|post|article|entry|content"
_AFTER = ("bar|box|boxes|list|area|wrap|wrapper|container|block|section|inner|outer|left|right|top|bottom|item|items|link|links|form|body|"
          "text|content|count|thread|title|nav|menu|panel|widget|holder|banner|row|col|column|inside|main|primary|secondary|page|button|btn|icon|icons")
#: A part of a name that is one purpose, alone or written together with words of layout.
_PURPOSE = re.compile(rf"(?:{_BEFORE})*?(?P<p>" + "|".join(
    f"{p}(?:{_ENDINGS.get(p, 's')})?" for p in sorted(PURPOSES, key=len, reverse=True) if p not in WHOLE) + rf")(?:{_AFTER})*")
#: Parts after these say what stands elsewhere; names of a topic or a state say nothing of their container.
_STATES = frozenset("has have no not with without hide hidden".split())
_TOPIC = re.compile(r"(?:tag|category|cat|topic|term|tax|type|format|status)[-_](?!(?:list|lists|cloud|links?)\b)|comments?[-_](?:open|closed)\b", re.I)
#: What can have a heading of its own, and class parts that hold against the tag article or main as well.
_HEADED = frozenset("article post entry story content".split())
_OTHER = frozenset("ad ads adv advert promo comment discussion reply respons disqus related recommend teaser".split())

_LONGEST = sorted((p for p in PURPOSES if p not in WHOLE), key=len, reverse=True)


def _purpose(part: str) -> str | None:
    if part in WHOLE:
        return part
    m = _PURPOSE.fullmatch(part)
    return next((p for p in _LONGEST if m["p"].startswith(p)), None) if m else None


@lru_cache(maxsize=20_000)
def purposes(tag: str, rest: str) -> frozenset[str]:
    """Purposes that a start tag names: by itself, or as whole parts of its class names, id and role.

    Classes of the whole page (html, body) tell its layout and count for nothing.
    An article's or main's own tag outweighs class parts, save those of comments,
    adverts and references to other articles.  The header of an article is its heading.
    """
    found = set()
    if tag in PURPOSES:
        found.add(tag)
    if tag in ("html", "body"):
        return frozenset(found)
    for m in _NAMES.finditer(rest):
        for name in (m[1] or m[2] or m[3] or "").split():
            if _TOPIC.match(name):
                continue
            parts = [p.lower() for p in _PART.findall(name)]
            parts = parts[:next((i for i, p in enumerate(parts) if p in _STATES), len(parts))]
            own = {_purpose(p) for p in parts} | {a + b for a, b in zip(parts, parts[1:]) if a + b in PURPOSES}
            if "header" in own and own & _HEADED:
                own.discard("header")
                found.discard("header")
            if tag in ("article", "main"):
                own -= set(_AGAINST) - _OTHER
            found |= own
    return frozenset(found - {None})


class Block:
    """Text between block limits, the purposes around it, its words inside links, the tags before it.

    ``place`` numbers the article (rank and number; rank 0: none) and the division that hold it.
    """

    __slots__ = ("parts", "around", "linked", "tags", "place")

    def __init__(self, around, tags, place):
        self.parts, self.around, self.linked, self.tags, self.place = [], around, 0, tags, place

    def beside(self, other: "Block") -> bool:
        """Whether both stand in one article, or directly in one division."""
        (article, division), (article2, division2) = self.place, other.place
        return article == article2 and article[0] > 0 or division == division2


class _Ends:
    """Where hidden and raw elements end.  Every position is searched once per name, so a page is read in linear time."""

    def __init__(self, page: str):
        self.page, self.next = page, {}

    def raw(self, name: str, at: int) -> int:
        """After the end tag of ``name``, or the end of the page."""
        found = self._tag(name, at, "/")
        return found[1] if found else len(self.page)

    def hidden(self, name: str, at: int, parent: str | None) -> int | None:
        """After the end tag of ``name``, or None if it is left open: its parent ends, or the next one begins, before."""
        end = self._tag(name, at, "/")
        if end is None:
            return None
        for other, mark in ((name, ""), (parent, "/")):
            found = other and self._tag(other, at, mark)
            # a container of the parent's name inside would be closed before: then this one is no sign
            if found and found[0] < end[0] and not (mark and self._within(other, at, found[0])):
                return None
        return end[1]

    def _within(self, name: str, at: int, to: int) -> bool:
        opened = self._tag(name, at, "")
        return opened is not None and opened[0] < to

    def _tag(self, name: str, at: int, mark: str) -> tuple[int, int] | None:
        """Limits of the first start (or, by the mark, end) tag of ``name`` from ``at`` on."""
        known = self.next.get((name, mark))
        if known is None or known and known[0] < at:
            m = re.compile(rf"<{mark}{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(self.page, at)
            self.next[name, mark] = known = m.span() if m else ()
        return known or None


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order; markup need be neither closed nor nested properly."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str], tuple]] = []  # open containers with all purposes around their contents, and the place
    opened: Counter[str] = Counter()  # how many of the stack have a name
    ends = _Ends(page)
    around: frozenset[str] = frozenset()
    place, number = _NOWHERE, 0
    block, links, tags, at = None, 0, 0, 0

    def text(raw: str) -> None:
        nonlocal block, tags
        if block is None:
            if raw.isspace():
                return
            block = Block(around, tags, place)
            tags = 0
            out.append(block)
        raw = html.unescape(raw)
        block.parts.append(raw)
        if links:
            block.linked += len(raw.split())

    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            # A tag cut off at the end of the page is markup as well.
            text(page[at:])
            break
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        if m["cdata"]:
            text(m["cdata"])
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        tags += 1
        closing = bool(m["close"] or m["close2"])
        rest = m["rest"] or m["rest2"] or ""
        if name in RAW and not closing:
            at = ends.raw(name, at)  # a slash does not close these
            block = None
            continue
        if name in HIDDEN:
            if not closing and not rest.endswith("/"):
                end = ends.hidden(name, at, stack[-1][0] if stack else None)
                at = at if end is None else end  # one left open hides nothing
            if name not in INLINE:
                block = None
            continue
        if name == "a":
            links = 0 if closing else 1
        if name not in INLINE:
            block = None
            if name == "p" or name in VOID:
                continue
            if closing:
                if opened[name]:
                    while True:
                        last = stack.pop()[0]
                        opened[last] -= 1
                        if last == name:
                            break
                around, place = stack[-1][1:] if stack else (frozenset(), _NOWHERE)
            else:
                own = purposes(name, rest)
                if name in ("article", "main") and not own & _COMMENTS:
                    outer = around & _COMMENTS  # an article ends what was left open before it
                    inner = outer | own
                elif name == "header" and around & _BODIES:
                    inner = around | (own - {"header"})  # the heading of an article
                else:
                    inner = around | own
                number += 1
                article, division = place
                rank = 0 if own & _COMMENTS else 3 if name == "article" else 2 if name == "main" else 1 if own & _ARTICLES else 0
                if rank > article[0]:
                    article = (rank, number)
                place = article, number if name in _DIVISIONS else division
                stack.append((name, inner, place))
                opened[name] += 1
                around = inner
            links = 0 if name in _DIVISIONS else links
    return out


_COMMENTS = frozenset(("comment", "reply", "discussion", "respons", "disqus"))
_BODIES = frozenset(("article", "main"))
_ARTICLES = frozenset(("article", "post", "entry", "story"))
_DIVISIONS = frozenset(("article", "main", "div", "section", "body"))
_NOWHERE = ((0, 0), 0)

# --- weights and region ---------------------------------------------------------


class Weights:
    """Log-odds of content: ``base`` of a word, ``purpose`` of each surrounding, ``linked``, ``tag``."""

    def __init__(self, base, purpose, linked, tag):
        self.base, self.purpose, self.linked, self.tag = base, purpose, linked, tag

    def word(self, block: Block, words: int, silent: frozenset[str] = frozenset()) -> float:
        """Score of each word of a block, between -0.5 and 1; purposes in ``silent`` say nothing.

        A negative block inside the region is left out; :func:`bridge` keeps a
        long one from cutting an article in two.
        """
        total = self.base + sum(self.purpose.get(p, 0.0) for p in block.around if p not in silent)
        if 2 * block.linked > words:
            total += self.linked
        return max(-0.5, min(1.0, total))


_SENTENCE = re.compile(r"[.!?…。！？](?:\W|$)")


def silent_purposes(found: list[tuple[Block, str, int]]) -> frozenset[str]:
    """Purposes that say nothing on this page: more than half of its prose stands in them.

    Prose are blocks of ten words or more with a sentence's end and few links.
    A form around the whole page, or a page builder's widgets, hold the article
    itself; purposes such as navigation, adverts and comments hold whatever they surround.
    """
    prose, inside = 0, Counter()
    for b, text, words in found:
        if words >= 10 and 4 * b.linked < words and _SENTENCE.search(text):
            prose += words
            for p in b.around & DOUBTFUL:
                inside[p] += words
    return frozenset(p for p, n in inside.items() if 2 * n > prose)


def labelled_pages() -> list[str]:
    against, favour = _LABELLED
    return [t.replace("%", p) for t in against for p in _AGAINST] + [t.replace("%", p) for t in favour for p in _FOR]


@lru_cache(maxsize=1)
def learn_weights() -> Weights:
    """Counted on the labelled pages; every count starts at one."""
    word, inside, linked, tag = Counter(), {True: Counter(), False: Counter()}, Counter(), Counter()
    for page in labelled_pages():
        for b in blocks(page):
            words = "".join(b.parts).split()
            content = words.count("c") * 2 > len(words)
            word[content] += len(words)
            tag[content] += b.tags
            if 2 * b.linked > len(words):
                linked[content] += len(words)
            for p in b.around:
                inside[content][p] += len(words)

    def odds(a: float, b: float) -> float:
        return log((a + 1) / (word[True] + 2)) - log((b + 1) / (word[False] + 2))

    against = set(_AGAINST)
    purpose = {p: odds(inside[True][p], inside[False][p]) for p in inside[True] | inside[False]}
    # One purpose against the article outweighs all those for it.
    ceiling = sum(max(w, 0.0) for w in purpose.values())
    purpose = {p: w - ceiling if p in against else max(w, 0.0) for p, w in purpose.items()}
    cost = log((tag[True] + 1) / (tag[True] + word[True] + 2)) - log((tag[False] + 1) / (tag[False] + word[False] + 2))
    return Weights(log((word[True] + 1) / (word[False] + 1)), purpose, odds(linked[True], linked[False]),
                   max(-0.12, min(-0.02, cost)))  # a heading of one word outweighs the tags around it


def best_region(scores: list[float]) -> tuple[int, int]:
    """Limits of the contiguous run with the greatest positive sum (the first of equals); (0, 0) if none."""
    best, found, total, begin = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, found = total, (begin, i + 1)
    return found


def bridge(own: list[Block], scores: list[float]) -> None:
    """Limit what lies between two positive blocks of one article to half the lesser of them.

    ``scores`` holds two places a block: its tags and its words.  However long
    an advert or however many tags stand there, the region reaches over them.
    """
    last = None
    for i, b in enumerate(own):
        if scores[2 * i + 1] <= 0:
            continue
        if last is not None and own[last].beside(b):
            lo, hi = 2 * last + 2, 2 * i + 1
            cost, limit = -sum(scores[lo:hi]), min(scores[lo - 1], scores[hi]) / 2
            if cost > limit:
                scores[lo:hi] = [s * limit / cost for s in scores[lo:hi]]
        last = i


def main_text(page: str | None, weights: Weights | None = None) -> str:
    """Main text of a page: blocks in page order, white space as one space."""
    if not page:
        return ""
    weights = weights or learn_weights()
    found = []
    for b in blocks(page):
        words = "".join(b.parts).split()
        found.append((b, " ".join(words), len(words)))
    silent = silent_purposes(found)
    own, scores = [], []
    for b, text, words in found:
        score = weights.word(b, words, silent) if words else 0.0
        if 0 < words <= 15 and not b.place[0][0] and PHRASES.fullmatch(text):
            score = -0.5
        own.append(score)
        scores += [weights.tag * b.tags, score * words]
    bridge([b for b, _, _ in found], scores)
    lo, hi = best_region(scores)
    return " ".join(text for i, (_, text, _) in enumerate(found) if text and own[i] > 0 and lo <= 2 * i + 1 < hi)


def extract(page: Column) -> Column:
    """Main text of a column of pages; a NULL page gives the empty text."""

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        weights = learn_weights()
        return pd.Series([main_text(p, weights) for p in pages], dtype=object)

    return run(page)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars), one row per page.

    Defined cases: a NULL or empty page, and one without a positive region, has
    the empty text; unclosed and cut-off markup is read as far as it goes; NULL
    ids and repeated rows are kept; other columns are not read; a page is read
    whole.
    """
    rows = pages.select(F.col(id_col), F.col(url_col), extract(F.col(html_col)).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
