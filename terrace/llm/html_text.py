"""Main text of web pages by line-block distribution.

Markup is stripped first: the page becomes a sequence of lines, one per block
element. A line's weight is its text length; it is 0 for furniture (menus,
headers, footers, sidebars, notices, adverts, forms, comments), for lines made
of links and, where the page marks its article, for everything outside it.
Class names and ids are evidence only: the word that says what a name means
decides, not a word somewhere in it, and an element that holds most of the text
beside next to nothing else is a wrapper of the page, whatever its name.
Weights are summed over sliding windows of lines. Text starts where the sum
surges, with the short lines right before, and ends where it dives to nothing;
all lines in between are kept, short ones and lines of links too. Inside a
marked article any text is a surge.

A page is handled on its own, by linear scans of its markup. Null and empty
pages and pages without text give an empty text; repeated rows give equal
texts; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from terrace.llm.common import text_of


@dataclass(frozen=True)
class BlockRules:
    window: int = 3
    surge: int = 80           # characters in a window


# Element names of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr br img".split())
SILENT = frozenset("script style noscript template iframe svg math object canvas audio video head textarea".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
FURNITURE = frozenset("nav footer aside form button select menu dialog fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SELF_ENDING = frozenset("p li dt dd option tr td th".split())
WRAPPING = frozenset("form fieldset dialog".split())     # some pages stand in one of these as a whole
ARTICLE = frozenset("article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

# Words of class names and ids that name furniture, and those that stand behind such a word
# without changing what it names.
NAMED = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|notification|alert|popup|modal|dialog|overlay|"
    r"banner|sidebar|comments?|commentlist|disqus|repl(?:y|ies)|footer|nav|navbar|navigation|menu|search|widgets?|toolbar|skip|"
    r"breadcrumbs?|share|sharing|social|related|recommend\w*|subscribe|newsletter|signup|login|pagination|pager|copyright")
CARRIERS = frozenset(
    "area bar block body box button buttons card column container content form group icon icons inner item items left line link "
    "links list menu message module outer panel placeholder posts right row section slot stories text thread top bottom unit "
    "wrap wrapper".split())
STATES = frozenset("has is no not with without hide show enable enabled disable disabled open closed active on off".split())
PAGE_WORDS = frozenset("content main layout page site".split())
TALK = re.compile(r"comments?|commentlist|disqus|repl(?:y|ies)")
_PAGE_HEAD = re.compile(r"(?:^|\s)(?:(?:site|page|main)[_-])?(?:header|masthead|topbar)(?=$|\s)", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)((?>[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+)/?>")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)([^>]*)>?")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)


def tokens(page: str) -> list[tuple[str, str, str]]:
    """(kind, name or text, attributes): kinds are text, open and close."""
    out: list[tuple[str, str, str]] = []
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            out.append(("text", page[at:lt], ""))
        if lt >= n:
            break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        tag = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if tag is None:                       # a plain less-than sign
            out.append(("text", "<", ""))
            at = lt + 1
            continue
        at, name = tag.end(), tag[2].lower()
        if tag[1]:
            out.append(("close", name, ""))
            continue
        out.append(("open", name, tag[3]))
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}\\s*>", re.I).search(page, at)
            at = n if end is None else end.end()
            out.append(("close", name, ""))
    return out


def named_head(token: str) -> str:
    """What a class name or id names, if that is furniture: its last word that is no carrier, place or number.

    ``sidebar-right`` is a sidebar and ``comment-body`` a comment, but ``related-work`` is work,
    ``has-sidebar`` and ``share-enabled`` are states of something else, and ``content-sidebar-wrap``
    is a wrapper of the content.
    """
    words = [w.lower() for w in _WORD.findall(token.replace("side-bar", "sidebar"))]
    if not words or words[0] in STATES or words[-1] in STATES:
        return ""
    if words[-1] in ("wrap", "wrapper", "container") and PAGE_WORDS.intersection(words):
        return ""
    while len(words) > 1 and not NAMED.fullmatch(words[-1]) and (
            words[-1] in CARRIERS or len(words[-1]) == 1 or words[-1].isdigit()):
        words.pop()
    return words[-1] if NAMED.fullmatch(words[-1]) else ""


@dataclass(frozen=True)
class Verdict:
    """Why an element may be furniture: by its tag alone, or by its name."""

    certain: bool
    talk: bool = False


def _furniture(name: str, attributes: str, inside: bool) -> Verdict | None:
    if name in SILENT or (name in FURNITURE and name not in WRAPPING) or (name == "header" and not inside):
        return Verdict(True)
    if name in WRAPPING:
        return Verdict(False)
    if name in ARTICLE or name in ("html", "body") or not attributes:
        return None
    if _HIDDEN.search(attributes):
        return Verdict(True)
    named = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    label = f"{named.get('class', '')} {named.get('id', '')}"
    heads = [h for h in map(named_head, label.split()) if h]
    if heads or (not inside and _PAGE_HEAD.search(label)) or named.get("role", "").lower() in ROLES:
        return Verdict(False, any(TALK.fullmatch(h) for h in heads))
    return None


def _closings(items: list[tuple[str, str, str]]) -> dict[int, int]:
    """Index of the closing tag of each element that has one."""
    opened: dict[str, list[int]] = {}
    found: dict[int, int] = {}
    for k, (kind, name, _) in enumerate(items):
        if kind == "open":
            opened.setdefault(name, []).append(k)
        elif kind == "close" and opened.get(name):
            found[opened[name].pop()] = k
    return found


def _end_of(items: list[tuple[str, str, str]], closings: dict[int, int], k: int) -> int:
    """Index behind the element that opens at ``k``; an unclosed one ends at the next block."""
    name = items[k][1]
    if name not in SELF_ENDING and k in closings:
        return closings[k] + 1
    for j in range(k + 1, len(items)):
        kind, other, _ = items[j]
        if kind == "close" and other == name:
            return j + 1
        if kind != "text" and other not in INLINE:
            return j
    return len(items)


def _articles_before(items: list[tuple[str, str, str]]) -> list[int]:
    """Number of articles that open before each index."""
    counts = [0]
    for kind, name, _ in items:
        counts.append(counts[-1] + (kind == "open" and name in ARTICLE))
    return counts


class Layout:
    """Which elements of a page are left out."""

    def __init__(self, items: list[tuple[str, str, str]], rules: BlockRules):
        self.items, self.rules = items, rules
        self.closings, self.articles = _closings(items), _articles_before(items)
        self.prose = self._prose()
        self.dropped: dict[int, int] = {}       # opening to the index behind the element
        self._judge(0, len(items), 0)

    def _prose(self) -> list[int]:
        """Characters of text outside links and scripts, before each index."""
        total, silent, links = [0], 0, 0
        for k, (kind, name, _) in enumerate(self.items):
            if kind == "open" and name in SILENT and name not in VOID:
                silent = max(silent, _end_of(self.items, self.closings, k))
            links = 0 if kind != "text" and name not in INLINE else max(0, links + (name == "a") * (
                1 if kind == "open" else -1 if kind == "close" else 0))
            counts = kind == "text" and k >= silent and not links
            total.append(total[-1] + (len(name.strip()) if counts else 0))
        return total

    def _length(self, begin: int, end: int) -> int:
        return self.prose[end] - self.prose[begin]

    def _judge(self, begin: int, end: int, depth: int) -> None:
        """Decide on the outermost suspects between two indexes, then inside those that turn out to be wrappers.

        A suspect that holds most of the text here, beside little that is not suspect, is a
        wrapper of the page, whatever its name; so is what holds the page's article.
        """
        todo = [(begin, end, depth)]
        while todo:
            begin, end, depth = todo.pop()
            suspects: list[tuple[int, int, Verdict, int]] = []
            free, k = self._length(begin, end), begin
            while k < end:
                kind, name, rest = self.items[k]
                if kind == "open":
                    verdict = _furniture(name, rest, depth > 0) if name not in VOID else None
                    if verdict:
                        stop = min(end, _end_of(self.items, self.closings, k))
                        suspects.append((k, stop, verdict, depth))
                        free -= self._length(k, stop)
                        k = max(stop, k + 1)
                        continue
                    depth += name in ARTICLE
                elif kind == "close" and name in ARTICLE and depth:
                    depth -= 1
                k += 1
            doubtful = [(self._length(k, stop), -k) for k, stop, verdict, _ in suspects if not verdict.certain]
            most, first = max(doubtful, default=(0, 0))
            for k, stop, verdict, at in suspects:
                # readers' comments may be marked as articles too
                holds = not at and self.articles[stop] > self.articles[k] and self.items[k][1] not in SILENT and (
                    not verdict.talk or (free < self.rules.surge and not self.articles[k]))
                little = free < self.rules.surge or (not verdict.talk and 10 * free < most)
                if holds or (k == -first and most and 2 * most >= self._length(begin, end) and little):
                    todo.append((k + 1, stop, at))
                else:
                    self.dropped[k] = stop


def lines_of(page: str, rules: BlockRules = BlockRules()) -> list[tuple[str, int, bool]]:
    """(text, weight, inside an article) of every block of the page that has text."""
    items = tokens(page)
    dropped = Layout(items, rules).dropped
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    linked = depth = links = k = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            lines.append((text, 0 if 2 * linked > len(text) else len(text), depth > 0))
        parts.clear()
        linked = 0

    while k < len(items):
        kind, name, rest = items[k]
        if kind == "text":
            parts.append(name)
            linked += len(name.strip()) if links else 0
            k += 1
            continue
        if name not in INLINE:
            flush()
            links = 0
        elif name == "br":
            parts.append(" ")
        if kind == "open":
            if k in dropped:
                k = max(dropped[k], k + 1)
                continue
            if name in ARTICLE:
                depth += 1
            links += name == "a"
        else:
            if name in ARTICLE and depth:
                depth -= 1
            if name == "a" and links:
                links -= 1
        k += 1
    flush()
    return lines


def main_text(page: str, rules: BlockRules = BlockRules()) -> str:
    """The lines between surges and dives of the text length, joined by line feeds."""
    lines = lines_of(page, rules)
    if any(inside for _, _, inside in lines):
        weights = [max(len(t), 1) if inside else 0 for t, _, inside in lines]
        surge = 1
    else:
        weights, surge = [w for _, w, _ in lines], rules.surge
        surge = min(surge, max(weights, default=0))
    marked = any(inside for _, _, inside in lines)
    kept: list[str] = []

    def keep(start: int, stop: int) -> None:
        while stop > start and not weights[stop - 1]:
            stop -= 1
        while start < stop and not weights[start]:
            start += 1
        # lines of links inside the text belong to it; what stands between two articles does not
        kept.extend(lines[j][0] for j in range(start, stop) if weights[j] or not marked)

    start, ended = -1, 0
    window = sum(weights[:rules.window])
    for k in range(len(lines)):
        if start < 0 and window >= surge > 0:
            start = k                    # surge: headings and bylines before it are text too
            while start > ended and weights[start - 1]:
                start -= 1
        elif start >= 0 and window == 0:
            keep(start, k)               # dive
            start, ended = -1, k
        window -= weights[k]
        window += weights[k + rules.window] if k + rules.window < len(weights) else 0
    if start >= 0:
        keep(start, len(lines))
    return "\n".join(kept)


def extract(df: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"),
            rules: BlockRules = BlockRules()) -> DataFrame:
    """The kept columns with ``text`` and ``n_chars`` of every row."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p, rules) for p in pages], dtype="object")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    rows = df.select(*map(F.col, keep), text_of(html).alias("_html"))
    rows = rows.select(*keep, F.pandas_udf(run, StringType())("_html").alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
