"""A small tree of the block elements of a web page, with the numbers a classifier needs.

Only block elements are nodes; inline elements and their text belong to the block around them.
Unclosed, misnested and unknown tags, broken attributes and missing end tags are all accepted.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np

# Element names and what they mean.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt rtc s samp small "
    "span strike strong sub sup time tt u var wbr img picture source input".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
HIDDEN = frozenset(
    "head script style title noscript template iframe noembed noframes svg math object canvas audio video textarea "
    "select button datalist".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote body center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dt dd".split()
)
SAME = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead"), "thead": ("tr", "td", "th"),
}
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
SCOPE = frozenset("ul ol dl table body html article section main div aside nav header footer form".split())
TAGS = "p h1 h2 h3 h4 li ul ol div section article main header footer nav aside form table td blockquote pre figure".split()
# Words of class, id, role and aria attributes, by what they say about a block.
HINTS = {
    "content": "article content post entry story main body text read longform prose",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs toc pagination pager tabs skip",
    "frame": "header footer masthead banner contentinfo copyright legal colophon topbar bottom foot head logo",
    "side": "sidebar side aside complementary widget widgets related recommended recommendations more trending popular rail",
    "advert": "ad ads adv advert advertisement adverts adsense adslot dfp sponsor sponsored promo promotion affiliate outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert alertdialog dialog modal popup overlay warning message disclaimer",
    "form": "form search login signup signin subscribe subscription newsletter contact register",
    "comment": "comment comments commentlist reply replies respond response discussion disqus thread feedback reviews",
    "share": "share sharing social tags tag meta byline author toolbar tools print follow buttons actions",
}
HINT_OF = {word: k for k, words in enumerate(HINTS.values()) for word in words.split()}
FEATURES = (
    ["log_chars", "log_own", "log_tags", "chars_per_tag", "link_share", "punctuation", "mean_word", "page_share"]
    + ["depth", "children", "place", "siblings", "alike", "kin_chars", "kin_links", "parent_links"]
    + [f"is_{t}" for t in TAGS]
    + [f"in_{t}" for t in ("nav", "header", "footer", "aside", "form", "article", "main")]
    + [f"says_{h}" for h in HINTS]
    + [f"under_{h}" for h in HINTS]
)
_IN = {t: k for k, t in enumerate(("nav", "header", "footer", "aside", "form", "article", "main"))}
_IS = {t: k for k, t in enumerate(TAGS)}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*|[^>]*)>", re.DOTALL
)
_HINTED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_MARK = re.compile(r"\bdata-label\s*=\s*\"(\d)\"")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in RAW}


def _hints(attributes: str) -> int:
    bits = 0
    for m in _HINTED.finditer(attributes):
        value = _CAMEL.sub(" ", m[1] or m[2] or m[3] or "")
        for word in _WORD.findall(value.lower()):
            k = HINT_OF.get(word)
            if k is not None:
                bits |= 1 << k
    return bits


class Page:
    """Nodes in page order: node 0 is the page itself, and parents come before their children."""

    def __init__(self, html: str, labelled: bool = False):
        self.tags, self.parents, self.hints, self.labels = ["#page"], [-1], [0], [0]
        #: Text runs and boundaries in page order: (node, text, characters in links or 0).
        self.runs: list[tuple[int, str, bool]] = []
        self._read(html, labelled)

    def _read(self, html: str, labelled: bool) -> None:
        tags, parents, runs = self.tags, self.parents, self.runs
        stack: list[tuple[str, int]] = [("#page", 0)]
        links = hidden = 0
        at = 0
        while True:
            m = _MARKUP.search(html, at)
            if not hidden:
                text = html[at : m.start()] if m else html[at:]
                if text:
                    runs.append((stack[-1][1], unescape(text), links > 0))
            if not m:
                return
            at = m.end()
            name = (m[2] or "").lower()
            if not name:
                continue
            if m[1]:
                ended = HEADINGS if name in HEADINGS else (name,)
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in ended), 0)
                if not depth:
                    continue
                if name in INLINE and any(t not in INLINE for t, _ in stack[depth + 1 :]):
                    continue
                left = stack[depth:]
                del stack[depth:]
            else:
                left = []
                if name in CLOSES_P:
                    left += self._close(stack, ("p",), SCOPE)
                if name in SAME:
                    left += self._close(stack, SAME[name], ("ul", "ol", "dl", "table", "select"))
            for t, _ in left:
                links -= t == "a"
                hidden -= t in HIDDEN
            if name not in INLINE or any(t not in INLINE for t, _ in left):
                runs.append((stack[-1][1], " ", False))
            if m[1] or name in VOID:
                continue
            if m[3].endswith("/") and name in ("svg", "path"):
                continue
            node = stack[-1][1]
            if name not in INLINE:
                tags.append(name)
                parents.append(node)
                self.hints.append(_hints(m[3]) if m[3] else 0)
                if labelled:
                    mark = _MARK.search(m[3])
                    self.labels.append(int(mark[1]) if mark else 0)
                node = len(tags) - 1
            if name in RAW:
                end = _END[name].search(html, at)
                at = end.start() if end else len(html)
            stack.append((name, node))
            links += name == "a"
            hidden += name in HIDDEN

    @staticmethod
    def _close(stack, names, scope):
        """Take everything from the innermost open element of ``names`` on, within ``scope``."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                left = stack[i:]
                del stack[i:]
                return left
            if stack[i][0] in scope:
                break
        return []

    def features(self) -> np.ndarray:
        n = len(self.tags)
        own, link, marks, words = (np.zeros(n) for _ in range(4))
        for node, text, linked in self.runs:
            if text != " ":
                size = len(text)
                own[node] += size
                words[node] += text.count(" ") + 1
                marks[node] += text.count(".") + text.count(",") + text.count(";")
                if linked:
                    link[node] += size
        parents, tags = self.parents, self.tags
        chars, links, punctuation, count, below = own.copy(), link.copy(), marks.copy(), words.copy(), np.ones(n)
        for i in range(n - 1, 0, -1):
            p = parents[i]
            chars[p] += chars[i]
            links[p] += links[i]
            punctuation[p] += punctuation[i]
            count[p] += count[i]
            below[p] += below[i]
        depth, children, place = np.zeros(n), np.zeros(n), np.zeros(n)
        inside, under = np.zeros(n, np.int64), np.zeros(n, np.int64)
        alike: dict[tuple[int, str], list] = {}
        for i in range(1, n):
            p = parents[i]
            depth[i] = depth[p] + 1
            place[i] = children[p]
            children[p] += 1
            k = _IN.get(tags[i])
            inside[i] = inside[p] | (1 << k if k is not None else 0)
            under[i] = under[p] | self.hints[i]
            kin = alike.setdefault((p, tags[i]), [0, 0.0, 0.0])
            kin[0] += 1
            kin[1] += chars[i]
            kin[2] += links[i]
        up = np.array(parents)
        up[0] = 0
        kin = np.array([[1, chars[0], links[0]], *(alike[parents[i], tags[i]] for i in range(1, n))])
        share = links / np.maximum(chars, 1)
        is_tag = np.zeros((n, len(TAGS)))
        for i, t in enumerate(tags):
            if t in _IS:
                is_tag[i, _IS[t]] = 1
        hints = np.array(self.hints)
        bits = np.arange(len(HINTS))
        table = [
            np.log1p(chars), np.log1p(own), np.log1p(below), np.log1p(chars / below), share,
            punctuation / np.maximum(count, 1), chars / np.maximum(count, 1), chars / max(chars[0], 1),
            np.minimum(depth, 20), np.log1p(children), (place + 1) / np.maximum(children[up], 1), np.log1p(children[up]),
            np.log1p(kin[:, 0]), np.log1p(kin[:, 1] / kin[:, 0]), kin[:, 2] / np.maximum(kin[:, 1], 1), share[up],
        ]
        return np.column_stack(
            [
                *table,
                is_tag,
                (inside[:, None] >> np.arange(len(_IN))) & 1,
                (hints[:, None] >> bits) & 1,
                (under[:, None] >> bits) & 1,
            ]
        ).astype(np.float64)

    def decode(self, keep: np.ndarray) -> np.ndarray:
        """The most likely set of kept nodes in which no kept node stands inside a dropped one.

        ``keep`` is the probability of each node. Upwards, the best scores of both choices for the
        part of the tree below a node; downwards, the choices. Node 0 is always kept.
        """
        n = len(self.tags)
        p = np.clip(keep, 1e-6, 1 - 1e-6)
        kept, dropped = np.log(p).tolist(), np.log1p(-p).tolist()
        for i in range(n - 1, 0, -1):
            up = self.parents[i]
            kept[up] += max(kept[i], dropped[i])
            dropped[up] += dropped[i]
        chosen = np.zeros(n, bool)
        chosen[0] = True
        for i in range(1, n):
            chosen[i] = chosen[self.parents[i]] and kept[i] >= dropped[i]
        return chosen

    def text(self, kept: np.ndarray) -> str:
        """Text of the kept nodes; white space is one space, also between blocks."""
        out, before = [], None
        for node, text, _ in self.runs:
            if text == " ":
                out.append(" ")
            elif kept[node]:
                if before is not None and node != before:
                    out.append(" ")
                out.append(text)
                before = node
        return " ".join("".join(out).split())
