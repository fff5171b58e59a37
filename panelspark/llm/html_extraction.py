"""Main text of web pages by tag-path ratios.

Text nodes with the same root-to-leaf tag path are judged together. A path's ratio is its text length and punctuation
per node; ratios are smoothed in page order, fused over paths that share a container, and cut at a threshold.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

from pyspark.sql import DataFrame, functions as F

from .arrow import extend, map_rows

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font",
          "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub",
          "sup", "time", "tt", "u", "var", "wbr"}
# Elements whose content is not shown as text.
UNSEEN = {"head", "title", "script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "audio",
          "video", "button", "select", "textarea", "input"}
AROUND = {"nav", "footer", "aside", "menu", "dialog"}
MAIN = {"article", "main"}
ROOTS = {"html", "body"}
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "blockquote", "pre", "caption",
         "figcaption", "summary"}
# An open element of the first kind ends when one of the second kind starts.
CLOSED_BY = {"p": {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form",
                   "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section",
                   "table", "ul"},
             "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
             "th": {"td", "th", "tr"}, "option": {"option"}, "head": {"body"}}
# How far up an open element is looked for: not beyond one of these.
FENCE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookies?|consent|notices?|alerts?|popup|modal|menu\w*|"
    r"nav\w*|sidebar\w*|footer|breadcrumbs?|comments?|respond|repl(?:y|ies)|social|shar(?:e|ing)|related|newsletter|"
    r"subscribe|widgets?|pagination|disclaimer|copyright)(?:$|[\s_-])", re.I)
TOP = re.compile(r"(?:^|[\s_-])(?:masthead|site-?header|page-?header|top-?bar)(?:$|[\s_-])", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，！？]")
SMOOTH = (0.25, 0.5, 0.25)
THRESHOLD = 0.5  # of the largest fused ratio
# Prior weights of ratios. Those of elements multiply down a path.
MAIN_WEIGHT, FORM_WEIGHT, HINT_WEIGHT, AROUND_WEIGHT = 32.0, 1 / 32, 1 / 32, 0.0
BARE_WEIGHT = 0.25   # text that stands in no paragraph, heading, item or cell
TITLE_WEIGHT = 2.0   # text in a container with a heading of first or second rank


class Paths:
    """Tag paths as a tree: a path is one number, larger than that of the path around it."""

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.parent, self.tag, self.weight = [-1], [""], [1.0]
        self.main, self.link, self.rooted, self.bare = [False], [False], [True], [True]
        self.region = [0]     # the nearest path here or around whose weight differs from the one around it
        self.container = [0]  # what a text on this path is a part of

    def step(self, at: int, tag: str, label: str, weight: float) -> int:
        key = (at, label, weight)
        found = self.number.get(key)
        if found is not None:
            return found
        new = self.number[key] = len(self.parent)
        inline = tag in INLINE
        self.parent.append(at)
        self.tag.append(tag)
        self.weight.append(self.weight[at] * weight)
        self.main.append(self.main[at] or tag in MAIN)
        self.link.append(self.link[at] or tag == "a")
        self.rooted.append(self.rooted[at] and tag in ROOTS)
        self.bare.append(self.bare[at] if inline else tag not in PROSE)
        self.region.append(self.region[at] if weight == 1.0 else new)
        around = self.region[new] if self.main[new] or self.region[new] == new else at
        self.container.append(self.container[at] if inline and weight == 1.0 else around)
        return new


class Nodes(HTMLParser):
    """Text nodes of a page as (path, block, text), all that is shown."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.paths = Paths()
        self.open: list[tuple[str, int, bool]] = []  # tag, path, whether its content is not shown
        self.places: dict[str, list[int]] = {}       # where in ``open`` each tag stands
        self.block, self.has_main = 0, False
        self.found: list[tuple[int, int, str]] = []

    def handle_starttag(self, tag, attrs):
        for kind, starters in CLOSED_BY.items():
            if tag in starters:
                self._end(kind, FENCE.get(kind, ("table", "td", "th", "button")))
        if tag not in INLINE:
            self.block += 1
        if tag == "br":
            self.handle_data(" ")
        if tag in VOID:
            return
        _, path, unseen = self.open[-1] if self.open else ("", 0, False)
        given = dict(attrs)
        named = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        inside = self.paths.main[path]
        weight = 1.0
        if tag in MAIN:
            self.has_main = True
            weight = 1.0 if inside else MAIN_WEIGHT
        elif tag in AROUND or not inside and tag == "header":
            weight = AROUND_WEIGHT
        elif tag == "form":
            weight = FORM_WEIGHT
        elif tag not in ROOTS and named and (HINT.search(named) or not inside and TOP.search(named)):
            weight = HINT_WEIGHT
        unseen = unseen or tag in UNSEEN or "hidden" in given or "display:none" in (given.get("style") or "").replace(" ", "")
        label = tag + "." + named.split()[0] if named.strip() else tag
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, self.paths.step(path, tag, label, weight), unseen))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end(tag, ())
        if tag not in INLINE:
            self.block += 1

    def _last(self, tag) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def _end(self, tag, fence):
        """Close the innermost ``tag`` and all in it, unless a tag of ``fence`` stands between."""
        at = self._last(tag)
        if at < 0 or any(self._last(f) > at for f in fence):
            return
        blocks = False
        while len(self.open) > at:
            closed = self.open.pop()[0]
            self.places[closed].pop()
            blocks = blocks or closed not in INLINE
        self.block += blocks

    def handle_data(self, data):
        _, path, unseen = self.open[-1] if self.open else ("", 0, False)
        if not unseen:
            self.found.append((path, self.block, data))


def content_paths(paths: Paths, nodes: list[tuple[int, int, str]], has_main: bool) -> tuple[set[int], set[int]]:
    """Paths whose fused ratio reaches the threshold, and those whose own ratio does.

    The ratio of a path is log text length times log punctuation of its nodes, nought for links. Ratios are smoothed
    over the next paths without links in page order, and weighted. Paths in one container, and in containers around and inside it, are
    parts of one text and take the weightiest ratio there, as far as element weights are the same. An article or main
    element is one container; html and body hold everything and join nothing. If the page has such an element, paths
    of less than full weight are no content.
    """
    length: dict[int, int] = {}
    marks: dict[int, int] = {}
    count: dict[int, int] = {}
    titled: set[int] = set()
    for path, _, text in nodes:
        plain = " ".join(text.split())
        if plain:
            length[path] = length.get(path, 0) + len(plain)
            marks[path] = marks.get(path, 0) + len(PUNCTUATION.findall(plain))
            count[path] = count.get(path, 0) + 1
            if paths.tag[path] in ("h1", "h2"):
                titled.add(paths.container[path])
    if not length:
        return set(), set()
    order = list(length)  # in page order of their first node
    plain_ratio = {p: math.log1p(length[p] / count[p]) * (1 + math.log1p(marks[p] / count[p])) for p in order}
    unlinked = [p for p in order if not paths.link[p]]
    if not unlinked:
        return set(), set()
    padded = [plain_ratio[p] for p in (unlinked[0], *unlinked, unlinked[-1])]

    def weight(p: int) -> float:
        prose = BARE_WEIGHT if paths.bare[p] else 1.0
        return paths.weight[p] * prose * (TITLE_WEIGHT if paths.container[p] in titled else 1.0)

    value = dict.fromkeys(order, 0.0)
    for at, p in enumerate(unlinked):
        value[p] = weight(p) * sum(w * v for w, v in zip(SMOOTH, padded[at:at + 3]))
    best = [0.0] * len(paths.parent)
    for p, v in value.items():
        best[paths.container[p]] = max(best[paths.container[p]], v)
    up, down = best[:], best[:]
    for c in range(1, len(best)):
        around = paths.parent[c]
        if not paths.rooted[around] and paths.region[around] == paths.region[c]:
            up[c] = max(up[c], up[around])
    for c in range(len(best) - 1, 0, -1):
        around = paths.parent[c]
        if not paths.rooted[around] and paths.region[around] == paths.region[c]:
            down[around] = max(down[around], down[c])

    def fused(p: int) -> float:
        c = paths.container[p]
        # Text in no container but the page stands by itself, path by path.
        return value[p] if paths.rooted[c] else max(up[c], down[c])

    total = {p: fused(p) for p in order if not has_main or paths.weight[p] >= 1}
    top = max(total.values(), default=0.0)
    if not top:
        return set(), set()
    return ({p for p, v in total.items() if v >= THRESHOLD * top},
            {p for p in total if weight(p) * plain_ratio[p] >= THRESHOLD * top})


def main_text(html: str) -> str:
    parser = Nodes()
    parser.feed(html)
    parser.close()
    paths = parser.paths
    chosen, by_itself = content_paths(paths, parser.found, parser.has_main)
    blocks: dict[int, list[str]] = {}
    sure: set[int] = set()  # blocks that are more than a link which only stands near the text, such as a menu entry
    for path, block, text in parser.found:
        if path in chosen:
            blocks.setdefault(block, []).append(text)
            if text.strip() and (not paths.link[path] or path in by_itself or paths.main[path]):
                sure.add(block)
    joined = (" ".join("".join(parts).split()) for block, parts in sorted(blocks.items()) if block in sure)
    return "\n".join(t for t in joined if t)


def extract(pages: DataFrame, keep: Sequence[str] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The ``keep`` columns of every page with ``text``, its main text: blocks in page order, one per line.

    White space inside a block is one space, character references are decoded. Menus, headers, footers, sidebars,
    notices, adverts, forms, scripts, styles, comments and markup are left out; a form, or an element that is only named
    like one of these, stays if it holds the weightiest text of a page without article (see ``content_paths``). Within
    the rest nothing is cut. Time is in proportion to the page, however deep or unclosed its elements are.

    Null or empty html, and pages without article text, give the empty string. Unclosed and crossing tags are closed
    as browsers do for paragraphs, items and cells. Rows that repeat an id or a page are read each; null ids stay.
    Whole pages are read, however long. An empty table gives an empty table. Kept columns must not be called
    ``text``; other input columns are not looked at.
    """
    keep = list(keep)

    def read(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            yield *(row[c] for c in keep), main_text(row["__tp_html"])

    source = pages.select(*keep, F.coalesce(F.col(html_col), F.lit("")).alias("__tp_html"))
    return map_rows(source, extend(pages, keep, "text string"), read)
