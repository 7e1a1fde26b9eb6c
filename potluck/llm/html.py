"""Main-text extraction by boosted trees over DOM nodes.

* A tolerant parser builds the element tree of a page (implied ends of
  paragraphs, list items, cells; void elements; comments dropped; scripts and
  styles carry no text).
* Every element gets features: subtree text, tags and link density, depth,
  place among its siblings and their statistics, kind of tag, groups of
  attribute tokens, and the same of what encloses it.
* Gradient-boosted regression trees on the logistic loss (histogram splits,
  written here in numpy) give the log-odds that the text below an element is
  main text.  They are trained here, from a fixed seed, on pages that
  ``training_page`` lays out at random with a known main text: the tables
  carry no labels.
* Hierarchical decoding takes the best consistent set: an element that is
  left out leaves out all below it, and each element's vote weighs as much as
  the text it holds.  One pass up and one pass down the tree.

The kept blocks' character references are decoded, white space inside a block
becomes one space, and blocks are joined in page order by one space.

Defined cases: null and empty pages give an empty text; text outside any
element belongs to the page's root; a page without markup is one block; rows
that repeat give the same text again; broken markup never raises, reading goes
on behind it; a comment never closed ends at the next ``>``; a head left open
ends at the first element or text that cannot stand in it.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from potluck.llm.common import with_python

# Element names of the HTML standard by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template iframe head title textarea select option button datalist".split())
#: What may stand in a head; anything else ends a head that was left open.
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
BLOCK = frozenset(("html body article section nav aside header footer main div p ul ol li dl dt dd table thead tbody tfoot tr td th caption "
                   "h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption form fieldset address details summary hr br dialog").split())
CLOSES_P = BLOCK - {"html", "body", "br", "td", "th", "tr", "thead", "tbody", "tfoot", "caption"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
#: Kinds of tags, one feature each.
KINDS = [{"nav", "menu"}, {"header"}, {"footer"}, {"aside"}, {"form", "fieldset", "label", "input"}, {"article"}, {"main"}, {"section"}, {"div"}, {"p"},
         {"ul", "ol", "dl"}, {"li", "dt", "dd"}, {"a"}, {"h1", "h2"}, {"h3", "h4", "h5", "h6"}, {"table", "tbody", "tr", "td", "th"},
         {"blockquote", "pre", "figure", "figcaption"}, {"span", "b", "i", "em", "strong", "small", "code"}, {"dialog"}, {"html", "body"},
         {"noscript"}, {"object", "canvas"}]
KIND_OF = {tag: k for k, tags in enumerate(KINDS) for tag in tags}
#: Groups of attribute tokens (of class, id, role), one feature each.
TOKENS = [
    "nav navigation navbar menu breadcrumb breadcrumbs tabs toc pagination pager",
    "header masthead topbar banner hero",
    "footer copyright legal colophon foot",
    "sidebar aside widget rail side complementary secondary",
    "ad ads advert advertisement sponsor sponsored promo promotion adsense commercial",
    "cookie cookies consent notice alert popup modal gdpr overlay warning dialog disclaimer message",
    "comment comments reply replies disqus discussion respond reader responses",
    "share social follow tools toolbar meta byline tags",
    "related recommend recommended more similar popular trending",
    "subscribe newsletter signup login form search contact input",
    "content article post entry story body main text maincontent articlebody prose",
]
TOKEN_OF = {word: k for k, words in enumerate(TOKENS) for word in words.split()}
SPLIT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
N_NUM = 20
N_FEATURES = N_NUM + 2 * len(KINDS) + 3 * len(TOKENS)


class Page(HTMLParser):
    """Elements as parallel lists; text runs in page order with their element."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.depth, self.mask = ["#root"], [-1], [0], [0]
        self.runs: list[tuple[int, str]] = []   # (element, text); element -1: a block boundary
        self.open = [0]
        self.silent = 0
        self.reached = 0   # how far the unread text is done
        rest = html
        while rest:
            try:
                self.reached = 0
                self.feed(rest)
                self.close()
                break
            except Exception:  # noqa: BLE001 - the parser asserts on some broken constructs: go on behind it
                end = rest.find(">", self.reached)
                rest = rest[end + 1:] if end >= 0 else ""
                self.rawdata = ""

    def updatepos(self, i: int, j: int) -> int:
        self.reached = max(self.reached, j)
        return super().updatepos(i, j)

    def _pop_to(self, k: int) -> None:
        for node in self.open[k:]:
            self.silent -= self.tag[node] in SILENT
            if self.tag[node] in BLOCK:
                self.runs.append((-1, ""))
        del self.open[k:]

    def _leave_head(self) -> None:
        for k in range(1, len(self.open)):
            if self.tag[self.open[k]] == "head":
                self._pop_to(k)
                return

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag not in IN_HEAD and self.silent and (tag == "body" or self.tag[self.open[-1]] == "head"):
            self._leave_head()
        if tag in CLOSES_P:
            for k in range(len(self.open) - 1, 0, -1):
                name = self.tag[self.open[k]]
                if name == "p":
                    self._pop_to(k)
                    break
                if name in BLOCK:
                    break
        if tag in SAME:
            for k in range(len(self.open) - 1, 0, -1):
                name = self.tag[self.open[k]]
                if name in STOPS[tag]:
                    break
                if name in SAME[tag]:
                    self._pop_to(k)
                    break
        if tag in BLOCK:
            self.runs.append((-1, ""))
        mask = 0
        for name, value in attrs:
            if value and name in ("class", "id", "role", "itemprop"):
                for word in SPLIT.findall(value):
                    k = TOKEN_OF.get(word.lower())
                    if k is not None:
                        mask |= 1 << k
        if tag in VOID:
            return
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.depth.append(len(self.open))
        self.mask.append(mask)
        self.open.append(len(self.tag) - 1)
        self.silent += tag in SILENT

    def parse_comment(self, i: int, report: int = 1) -> int:
        """A comment to its end; one that is never closed ends at the next ``>``."""
        k = super().parse_comment(i, report)
        if k < 0:
            k = self.parse_bogus_comment(i)
        return k if k >= 0 else len(self.rawdata)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A known section to its end; any other ``<![`` is a comment up to ``>``."""
        try:
            k = super().parse_marked_section(i, report)
        except AssertionError:
            k = -1
        return k if k >= 0 else self.parse_bogus_comment(i)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.tag[self.open[-1]] == tag and tag not in BLOCK:
            self._pop_to(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[k]]
            if name == tag:
                self._pop_to(k)
                return
            if tag not in BLOCK and name in BLOCK:
                return  # an inline end does not close a block
        if tag in BLOCK:
            self.runs.append((-1, ""))

    def handle_data(self, data: str) -> None:
        if self.silent and self.tag[self.open[-1]] == "head" and not data.isspace():
            self._leave_head()
        if not self.silent:
            self.runs.append((self.open[-1], data))


def _sums(page: Page, base: int) -> list[list[int]]:
    """Per element, what needs the tree: parent (shifted by ``base``), own text,
    text, tags, linked text, sentence marks and links below, children, place,
    largest child, first text, attribute groups and kinds of what encloses it."""
    n = len(page.tag)
    parent, tag, mask = page.parent, page.tag, page.mask
    own, linked, marks, first = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    above, outer = [0] * n, [0] * n
    kind = [KIND_OF.get(t, -1) for t in tag]
    for i in range(1, n):
        p = parent[i]
        in_link[i] = in_link[p] or tag[i] == "a"
        above[i] = above[p] | mask[p]
        outer[i] = outer[p] | (1 << kind[p] if kind[p] >= 0 else 0)
    seen = 0
    for node, data in page.runs:
        if node >= 0:
            size = 0 if data.isspace() else len(data) - data.count(" ")
            if size:
                own[node] += size
                marks[node] += data.count(".") + data.count(",")
                if in_link[node]:
                    linked[node] += size
                first[node] = first[node] or seen
                seen += size
    below, tags, links = own[:], [1] * n, [0] * n
    kids, order, largest = [0] * n, [0] * n, [0] * n
    for i in range(1, n):
        p = parent[i]
        order[i] = kids[p]
        kids[p] += 1
    for i in range(n - 1, 0, -1):
        p = parent[i]
        below[p] += below[i]
        tags[p] += tags[i]
        linked[p] += linked[i]
        marks[p] += marks[i]
        links[p] += links[i] + (tag[i] == "a")
        if below[i] > largest[p]:
            largest[p] = below[i]
    return [[base + max(0, p) for p in parent], own, below, tags, linked, marks, links, kids, order, largest, first,
            above, outer, kind, mask, page.depth, [below[0]] * n]


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    """(features [elements, N_FEATURES], characters below each element) of some pages in a row."""
    columns: list[list[int]] = [[] for _ in range(17)]
    for page in pages:
        for column, values in zip(columns, _sums(page, len(columns[0]))):
            column.extend(values)
    par = np.array(columns[0], dtype=np.int64)
    own, b, t, link, mark, links, k, order, largest, first = (np.array(c, dtype=np.float64) for c in columns[1:11])
    over, outer, kinds, mine = (np.array(c, dtype=np.int64) for c in columns[11:15])
    depth, total = np.array(columns[15], dtype=np.float64), np.maximum(np.array(columns[16], dtype=np.float64), 1)
    n, siblings = len(par), k[par]
    x = np.zeros((n, N_FEATURES), dtype=np.float32)
    x[:, 0], x[:, 1] = np.log1p(b), np.log1p(own)
    x[:, 2] = b / total
    x[:, 3] = np.log1p(b / t)                            # subtree density
    x[:, 4] = link / np.maximum(b, 1)                     # link density
    x[:, 5] = np.log1p(links)
    x[:, 6] = depth
    x[:, 7] = order / np.maximum(siblings - 1, 1)
    x[:, 8] = np.log1p(siblings)
    x[:, 9] = np.log1p(k)
    x[:, 10] = b / np.maximum(b[par], 1)                  # share of the parent's text
    x[:, 11] = b / np.maximum(largest[par], 1)            # against the largest sibling
    x[:, 12] = 100.0 * mark / np.maximum(b, 1)
    x[:, 13] = np.log1p(t)
    x[:, 14] = np.log1p(b[par])
    x[:, 15] = x[par, 3]
    x[:, 16] = x[par, 4]
    x[:, 17] = first / total
    alike = (par * (len(KINDS) + 1) + kinds + 1) * (1 << len(TOKENS)) + mine
    _, group, count = np.unique(alike, return_inverse=True, return_counts=True)
    x[:, 18] = np.log1p(count[group])                     # siblings of the same kind and attribute groups
    x[:, 19] = own / np.maximum(b, 1)                     # share of text without an element of its own
    at = N_NUM
    known = np.flatnonzero(kinds >= 0)
    x[known, at + kinds[known]] = 1
    at += len(KINDS)
    for j in range(len(KINDS)):
        x[:, at + j] = outer >> j & 1
    at += len(KINDS)
    for j in range(len(TOKENS)):
        x[:, at + j] = mine >> j & 1
        x[:, at + len(TOKENS) + j] = over >> j & 1
        x[:, at + 2 * len(TOKENS) + j] = mine[par] >> j & 1
    return x, b


# ------------------------------------------------------ boosted trees -------
class Boosted:
    """Gradient-boosted regression trees on the logistic loss, histogram splits."""

    def __init__(self, trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 32, l2: float = 5.0):
        self.size, self.depth, self.rate, self.bins, self.l2 = trees, depth, rate, bins, l2

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
        n, d = x.shape
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins)[1:-1])) for j in range(d)]
        code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], axis=1)
        width = self.bins
        mean = float((weight * y).sum() / weight.sum())
        self.base = float(np.log(mean / (1 - mean)))
        score = np.full(n, self.base)
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        flat = code + np.arange(d) * width
        for _ in range(self.size):
            p = 1 / (1 + np.exp(-score))
            g, h = weight * (y - p), weight * p * (1 - p) + 1e-9
            feature = np.zeros((1 << self.depth) - 1, dtype=np.int64)
            cut = np.full((1 << self.depth) - 1, np.inf)
            node = np.zeros(n, dtype=np.int64)
            for level in range(self.depth):
                k, start = 1 << level, (1 << level) - 1
                cell = ((node - start)[:, None] * (d * width) + flat).ravel()
                gs = np.bincount(cell, np.repeat(g, d), minlength=k * d * width).reshape(k, d, width)
                hs = np.bincount(cell, np.repeat(h, d), minlength=k * d * width).reshape(k, d, width)
                gl, hl = gs.cumsum(axis=2), hs.cumsum(axis=2)
                gt, ht = gl[:, :, -1:], hl[:, :, -1:]
                gain = gl ** 2 / (hl + self.l2) + (gt - gl) ** 2 / (ht - hl + self.l2) - gt ** 2 / (ht + self.l2)
                best = gain.reshape(k, -1).argmax(axis=1)
                for i in range(k):
                    f, b = divmod(int(best[i]), width)
                    if gain[i, f, b] > 1e-6 and b < len(self.cuts[f]):
                        feature[start + i], cut[start + i] = f, self.cuts[f][b]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
            leaf = node - ((1 << self.depth) - 1)
            value = self.rate * np.bincount(leaf, g, 1 << self.depth) / (np.bincount(leaf, h, 1 << self.depth) + self.l2)
            score += value[leaf]
            self.trees.append((feature, cut, value))
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - ((1 << self.depth) - 1)]
        return out


def decode(parent: list[int], odds: np.ndarray, below: np.ndarray) -> list[bool]:
    """The best consistent labels: kept only where all that encloses is open."""
    n = len(parent)
    shut = (np.clip(odds, -6, 6) * below).tolist()
    gain = shut[:]
    # shut: votes of the subtree (leaving it out scores -shut); gain: best score of an open element
    for i in range(n - 1, 0, -1):
        shut[parent[i]] += shut[i]
        gain[parent[i]] += max(gain[i], -shut[i])
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[parent[i]] and gain[i] > -shut[i]
    return kept


# ------------------------------------------------------ training pages ------
def training_page(rng: random.Random) -> str:
    """A page with random layout; main text stands between \\x01 and \\x02."""
    syllables = ["".join(rng.choice("bcdfghlmnprstvw") + rng.choice("aeiou") for _ in range(rng.randint(1, 2))) for _ in range(30)]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))

    def words(lo: int, hi: int) -> str:
        return " ".join(word() for _ in range(rng.randint(lo, hi))).capitalize()

    def sentences(lo: int, hi: int) -> str:
        mark = rng.choice([".", ".", ".", "!", "", "***", "!!"])
        return " ".join(words(3, 18) + mark for _ in range(rng.randint(lo, hi)))

    def cls(*names: str) -> str:
        kind = rng.choice(["class", "id", "class", ""])
        return f' {kind}="{rng.choice(names)}"' if kind else ""

    def links(lo: int = 3, hi: int = 9) -> str:
        tag = rng.choice(["ul", "ul", "div", "p"])
        items = [f'<a href="/{word()}">{words(1, 3)}</a>' for _ in range(rng.randint(lo, hi))]
        if tag == "ul":
            return f"<ul>{''.join(f'<li>{x}</li>' for x in items)}</ul>"
        return f"<{tag}>{rng.choice([' | ', ' ', '']).join(items)}</{tag}>"

    def inline(text: str) -> str:
        parts = text.split(" ")
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(parts))
            tag = rng.choice(["b", "i", "em", "strong", "a", "span", "code"])
            parts[k] = f"<{tag}{' href=x' if tag == 'a' else ''}>{parts[k]}</{tag}>"
        return " ".join(parts)

    def paragraph() -> str:
        pick = rng.random()
        if pick < 0.05:  # mostly links
            return "<p>" + " ".join(f'{words(1, 4)} <a href="/{word()}">{words(1, 6)}</a>' for _ in range(rng.randint(1, 4))) + ".</p>"
        if pick < 0.08:
            tag = rng.choice(["noscript", "object", "canvas"])
            return f"<{tag}>{rng.choice(['<p>', ''])}{sentences(1, 3)}</{tag}>"
        if pick < 0.66:
            end = rng.choice(["</p>", "</p>", "</p>", ""])
            return f"<p>{rng.choice(['', '', '<b>'])}{inline(sentences(1, 7))}{rng.choice(['', '', '<br>'])}{end}"
        if pick < 0.74:
            return f"<h{rng.randint(2, 4)}>{words(2, 7)}</h2>"
        if pick < 0.82:
            return "<ul>" + "".join(f"<li>{inline(sentences(1, 2))}</li>" for _ in range(rng.randint(2, 6))) + "</ul>"
        if pick < 0.88:
            return f"<blockquote><p>{sentences(1, 3)}</p></blockquote>"
        if pick < 0.92:
            return f"<pre>{sentences(1, 3)}</pre>"
        if pick < 0.96:
            return f"<figure><img src=a><figcaption>{sentences(1, 1)}</figcaption></figure>"
        return "<table>" + "".join(f"<tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr>" for _ in range(rng.randint(2, 4))) + "</table>"

    def noise() -> str:
        pick = rng.randrange(10)
        if pick == 9:
            return f"<noscript>{rng.choice(['<p>', '', '<div>'])}{sentences(1, 1)}</noscript>"
        if pick == 0:
            return f"<div{cls('ad', 'ads', 'advert', 'sponsored', 'promo-box', 'ad-slot', 'advertisement')}>{sentences(1, 2)}</div>"
        if pick == 1:
            return f"<aside{cls('sidebar', 'widget', 'rail', 'aside')}>{rng.choice([links(), '<h3>' + words(1, 3) + '</h3>' + links(), '<p>' + sentences(1, 3) + '</p>'])}</aside>"
        if pick == 2:
            return f"<div class=\"{rng.choice(['cookie-notice', 'notice', 'alert', 'consent-banner', 'popup', 'gdpr', 'message'])}\">{rng.choice(['<p>', ''])}{sentences(1, 3)}<button>{words(1, 2)}</button></div>"
        if pick == 3:
            return f"<form{cls('newsletter', 'search', 'subscribe', 'login')}><label>{words(1, 4)}</label><input name=a><button>{words(1, 2)}</button>{rng.choice(['', '<p>' + sentences(1, 1) + '</p>'])}</form>"
        if pick == 4:
            return f"<div{cls('related', 'recommended', 'more-stories', 'popular')}><h3>{words(1, 3)}</h3>{links()}</div>"
        if pick == 5:
            return f"<div{cls('share', 'social', 'follow', 'toolbar')}>{links(2, 5)}</div>"
        if pick == 6:
            return f"<div class=\"{rng.choice(['sidebar', 'widget', 'side-rail'])}\"><p>{sentences(1, 4)}</p>{links()}</div>"
        if pick == 7:
            return f"<p class=\"{rng.choice(['notice', 'disclaimer', 'promo', 'ad', 'copyright'])}\">{sentences(1, 2)}</p>"
        return f"<nav{cls('breadcrumbs', 'pagination', 'toc')}>{links()}</nav>"

    def comments() -> str:
        if rng.random() < 0.35:  # nothing is named
            row = rng.choice(["<li>{}</li>", "<div>{}</div>", "<tr><td>{}</td></tr>", "<p>{}</p>"])
            who = rng.choice(["<b>{}</b> ", "<strong>{}</strong>: ", "<a href=/u>{}</a> ", "<b>{}</b><br>", "<cite>{}</cite> <small>12:30</small> "])
            rows = "".join(row.format(who.format(word()) + rng.choice(["", "" if row[1] == "p" else "<p>"]) + sentences(1, 3)) for _ in range(rng.randint(2, 8)))
            outer = {"<li": "<ul>{}</ul>", "<tr": "<table>{}</table>"}.get(row[:3], "<div>{}</div>")
            return f"<h{rng.randint(2, 4)}>{words(1, 2)}</h3>" + outer.format(rows)
        tag, name = rng.choice([("section", "comments"), ("div", "comments"), ("div", "comment-list"), ("ol", "comments"), ("div", "disqus"), ("div", "replies"), ("section", "responses")])
        inner = rng.choice(["div", "article", "li", "p"])
        body = "".join(f"<{inner} class=\"{rng.choice(['comment', 'reply', 'comment-body', 'item'])}\">{rng.choice(['<p>', '', '<b>' + word() + '</b> '])}{sentences(1, 5)}</{inner}>" for _ in range(rng.randint(1, 8)))
        return f"<{tag} {rng.choice(['class', 'id'])}=\"{name}\">{rng.choice(['', '<h3>' + words(1, 3) + '</h3>'])}{body}</{tag}>"

    tag = rng.choice(["article", "article", "main", "section", "div", "div"])
    named = f' {rng.choice(["class", "id"])}="{rng.choice(["content", "post", "entry-content", "story-body", "article-body", "main", "text", "article"])}"'
    opened = f"<{tag}{named if tag == 'div' or rng.random() < 0.4 else ''}>"
    title = f"<h1>{words(2, 9)}</h1>"
    head = rng.choice([title, title, "", f"<header>{title}</header>"])
    blocks = [paragraph() for _ in range(rng.choice([1, 2, 4, 8, 14, 25]))]
    if rng.random() < 0.2:  # a short text
        blocks = [f"<p>{words(1, 10)}{rng.choice(['.', '', '</p>', '.</p>'])}" for _ in range(rng.randint(1, 2))]
        head = rng.choice([head, ""])
    elif rng.random() < 0.12:  # lines
        lines = rng.choice(["<br>", "<br/>", "<br><br>"]).join(inline(sentences(1, 4)) for _ in range(rng.randint(2, 14)))
        blocks = [rng.choice(["{}", "<div>{}</div>", "<p>{}</p>"]).format(lines)]
    elif rng.random() < 0.12:  # names that mislead
        a, b = rng.choice(TOKENS).split(), TOKENS[-1].split()
        opened = f'<{tag} class="{rng.choice(a)}-{word()} {rng.choice(a)}-{rng.choice(b)}">'
        blocks = [paragraph() for _ in range(rng.randint(3, 9))]
    if rng.random() < 0.1:  # nothing but text
        outer = rng.choice(["{}", "<body>{}</body>", "<div>{}</div>", "<html><body><div>{}</body></html>"])
        return outer.format("\x01" + "".join(blocks) + "\x02")
    main = [opened, "\x01", *([] if head.startswith("<header") else [head])]
    if head.startswith("<header"):
        main = [opened, f"<header>\x01{title}\x02", f"<p class=\"byline meta\">{words(2, 4)}</p></header>\x01"]
    for b in blocks:
        main.append(b)
        if rng.random() < 0.08:
            main += ["\x02", noise(), "\x01"]
    main.append("\x02")
    if rng.random() < 0.2:
        main += [rng.choice([noise, comments])()]
    main.append(f"</{tag}>")
    body = ["".join(main)]
    if rng.random() < 0.06:  # columns of a table
        body = [f"<table><tr><td>{links()}</td><td>", *body, "</td></tr></table>"]
    if rng.random() < 0.3:
        body = [f"<div{cls('wrapper', 'container', 'page', 'layout')}>", *body, "</div>"]
    top = [rng.choice(["", f"<nav{cls('menu', 'navbar')}>{links()}</nav>", f"<div class=menu>{links()}</div>",
                       f"<header{cls('site-header', 'masthead', 'top')}><a href=/>{words(1, 2)}</a>{rng.choice(['', links(), '<p>' + words(2, 8) + '</p>', '<h1>' + words(1, 3) + '</h1>'])}</header>"])]
    top += [noise() for _ in range(rng.choice([0, 0, 1, 1, 2]))]
    low = [noise() for _ in range(rng.choice([0, 0, 1, 2]))] + ([comments()] if rng.random() < 0.35 else [])
    foot = rng.choice(["", f"<footer{cls('site-footer', 'footer')}>&copy; {words(1, 12)}.\n{rng.choice(['', links(), sentences(1, 2)])}</footer>",
                       f"<footer>{sentences(1, 2)}</footer>", f"<div class=footer><p>{sentences(1, 2)}</p>{links()}</div>"])
    shell = "<!DOCTYPE html><html><head><title>{}</title><style>p{{}}</style></head><body>{}</body></html>"
    inside = "".join([*top, *body, *low, foot])
    if rng.random() < 0.1:  # one form around the page
        inside = f"<form{cls('aspnetForm', 'form1', 'page-form')} method=post><input type=hidden name=v>{inside}</form>"
    return shell.format(words(2, 6), inside)


def _labelled(html: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, share of main text below each element, and weights."""
    page = Page(html)
    good, n, on = np.zeros(len(page.tag)), len(page.tag), False
    clean: list[tuple[int, str]] = []
    for node, data in page.runs:
        kept = ""
        for part in re.split("([\x01\x02])", data):
            if part in ("\x01", "\x02"):
                on = part == "\x01"
            else:
                kept += part
                if on and node >= 0:
                    good[node] += len(part) - part.count(" ")
        clean.append((node, kept))
    page.runs = clean
    x, below = features([page])
    for i in range(n - 1, 0, -1):
        good[page.parent[i]] += good[i]
    some = below > 0
    return x[some], np.clip(good[some] / below[some], 0, 1), np.log1p(below[some])


@lru_cache(maxsize=2)
def trained(pages: int = 700, seed: int = 7) -> Boosted:
    rng = random.Random(seed)
    parts = [_labelled(training_page(rng)) for _ in range(pages)]
    x, y, w = (np.concatenate([p[k] for p in parts]) for k in range(3))
    return Boosted().fit(x, np.clip(y, 0.001, 0.999), w)


# ---------------------------------------------------------- extraction ------
def blocks_of(page: Page, kept: list[bool]) -> str:
    out: list[str] = []
    run: list[str] = []
    for node, data in page.runs:
        if node < 0:
            if run:
                out.append(" ".join("".join(run).split()))
                run = []
        elif kept[node]:
            run.append(data)
    if run:
        out.append(" ".join("".join(run).split()))
    return " ".join(x for x in out if x)


def extract_texts(pages: list, model: Boosted) -> list[str]:
    """The main text of each page; predictions are made for many pages at once."""
    out = []
    for at in range(0, len(pages), 64):
        some = [Page(h or "") for h in pages[at:at + 64]]
        x, below = features(some)
        odds = model.log_odds(x)
        start = 0
        for page in some:
            n = len(page.tag)
            own = odds[start:start + n].copy()
            for i, tag in enumerate(page.tag):
                if tag in ("#root", "html", "body"):
                    own[i] = 0.0  # the page itself is open
            if n == 1:
                own[0] = 1.0
            out.append(blocks_of(page, decode(page.parent, own, below[start:start + n])))
            start += n
    return out


def extract(pages: DataFrame, html: str = "html", out: str = "text", model: Boosted | None = None) -> DataFrame:
    """``pages`` with the main text in ``out``: one pass, no shuffle."""
    model = model or trained()

    def make():
        return lambda rows: [extract_texts(rows, model)]
    return with_python(pages, [html], make, [(out, T.StringType())])
