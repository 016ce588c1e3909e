"""Main text of web pages by composite text density.

A task reads a page into a tree (one pass of a linear pattern, HTML's implied end tags), leaves out what is never main
text, and measures every node at once over all pages of a batch: its density is its characters per tag, scaled by a
logarithm that falls with the share of link text. A node's sum is the sum of its children's densities, text runs being
children too. The node with the largest sum is the article's; its surroundings are judged by a threshold, the least density
on its path from the body:

* a paragraph, heading, list, quote or the like stands for the container that it is in;
* an enclosing ``article`` or ``main`` is taken as a whole;
* otherwise it grows into its parent as long as all other text there is headings, or parts as dense as the threshold.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .util import row_slices, string_buffer

# Fixed values of HTML: element names by their role.
_RAW = "script|style|textarea|title|noscript|iframe|noembed|noframes|xmp"
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
             "header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
_LEAVES = _HEADINGS | set("p li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption address center summary".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
              "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"}}
_HOLDS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
_HEAD = set("head meta link base title script style noscript template".split())
# Elements, roles and class or id words that mark what is no main text.
_NEVER = set("head script style textarea title noscript iframe noembed noframes xmp template svg math canvas object audio video button select input datalist map".split())
_APART = set("nav footer aside form header dialog menu search".split())
_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
_WORDS = set("nav navbar navigation menu menus breadcrumb breadcrumbs header masthead topbar footer sidebar aside widget widgets ad ads adv advert adverts advertisement "
             "advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe "
             "subscription signup login comment comments disqus respond reply replies discussion share sharing social related recommended recommendations "
             "pagination pager toolbar search copyright".split())
_NOT_AFTER = {"no", "has", "with", "without", "hide", "is"}
_MAIN = {"article", "main"}

_ATTRS = r"""(?:[^=>]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_TOKEN = re.compile(rf"<(?:(?P<raw>{_RAW})(?=[\s/>]){_ATTRS}>(?:[^<]++|<(?!/(?P=raw)[\s/>]))*+(?:</(?P=raw){_ATTRS}(?:>|\Z))?|!--(?:-?>|.*?(?:--!?>|\Z))|"
                    rf"(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<attrs>{_ATTRS})(?:>|\Z)|[!?/][^>]*+(?:>|\Z))", re.S | re.I)
_ATTR = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|style|aria-hidden)(?=[\s=/]|$)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?+""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

TEXT = "#text"
#: Elements nested deeper than this have no subtree: what they hold is their parent's, as in browsers.
_DEPTH = 512


def _hinted(name: str, attrs: str) -> bool:
    """Whether the attributes mark an element as no main text."""
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _HIDDEN.search(value)) or (key == "role" and value.strip().lower() in _ROLES):
            return True
        if key in ("class", "id") and name not in ("html", "body"):
            for word in value.split():
                parts = [p.lower() for p in _PARTS.findall(word)]
                if any(p in _WORDS and not _NOT_AFTER & set(parts[:i]) for i, p in enumerate(parts)):
                    return True
    return False


class Page:
    """Nodes of one page in document order: name, parent, end (one past the subtree), text, mark (no main text)."""

    def __init__(self, html: str):
        self.name, self.parent, self.end, self.text, self.mark, self.body = ["html"], [-1], [0], [""], [False], 0
        stack, at = [0], 0
        for m in _TOKEN.finditer(html):
            if m.start() > at:
                self._run(html[at:m.start()], stack)
            at = m.end()
            name = m["name"]
            if name is None:
                continue
            name = name.lower()
            if m["end"]:
                self._close(name, stack)
                continue
            if name in ("html", "body"):
                self._leave_head(stack)
                if name == "body" and not self.body:
                    self.body = self._add("body", stack[-1], _hinted(name, m["attrs"]))
                    stack.append(self.body)
                continue
            if name not in _HEAD:
                self._leave_head(stack)
            self._imply(name, stack)
            node = self._add(name, stack[-1], bool(m["attrs"]) and _hinted(name, m["attrs"]))
            if name not in _VOID and len(stack) < _DEPTH and not (m["attrs"].endswith("/") and name not in _BLOCK and name != "a"):
                stack.append(node)
        if at < len(html):
            self._run(html[at:], stack)
        while stack:
            self.end[stack.pop()] = len(self.name)

    def _add(self, name: str, parent: int, mark: bool = False, text: str = "") -> int:
        self.name.append(name)
        self.parent.append(parent)
        self.end.append(len(self.name))
        self.text.append(text)
        self.mark.append(mark)
        return len(self.name) - 1

    def _run(self, raw: str, stack: list[int]) -> None:
        if not raw.isspace():
            self._leave_head(stack)
        self._add(TEXT, stack[-1], text=unescape(raw) if "&" in raw else raw)

    def _pop(self, stack: list[int], to: int) -> None:
        """Close the open elements from place ``to`` on."""
        while len(stack) > to:
            self.end[stack.pop()] = len(self.name)

    def _leave_head(self, stack: list[int]) -> None:
        if len(stack) > 1 and self.name[stack[1]] == "head":
            self._pop(stack, 1)

    def _imply(self, name: str, stack: list[int]) -> None:
        if name in _BLOCK:
            for i in range(len(stack) - 1, 0, -1):
                open_ = self.name[stack[i]]
                if open_ == "p":
                    self._pop(stack, i)
                    break
                if open_ in _BLOCK:
                    break
        closes, holds = _CLOSED_BY.get(name), _HOLDS.get(name)
        if closes:
            cut = 0
            for i in range(len(stack) - 1, 0, -1):
                open_ = self.name[stack[i]]
                if open_ in holds:
                    break
                if open_ in closes:
                    cut = i
            if cut:
                self._pop(stack, cut)

    def _close(self, name: str, stack: list[int]) -> None:
        if name in ("html", "body"):
            return
        for i in range(len(stack) - 1, 0, -1):
            open_ = self.name[stack[i]]
            if open_ == name:
                self._pop(stack, i)
                return
            if open_ == "body" or (name not in _BLOCK and name not in _HEAD and open_ in _BLOCK):
                return

    def kept(self) -> np.ndarray:
        """Nodes that may be main text. A marked element that holds an unmarked article or main is the page's frame."""
        n, name, parent = len(self.name), self.name, self.parent
        frame = bytearray(n)
        for i in range(n):
            if name[i] in _MAIN and not self.mark[i]:
                j = parent[i]
                while j >= 0 and not frame[j]:
                    frame[j] = 1
                    j = parent[j]
        inside, keep = bytearray(n), np.ones(n, bool)
        for i in range(1, n):
            p = parent[i]
            inside[i] = inside[p] or (name[p] in _MAIN)
            if not keep[p]:
                # the headings of an article's header are the article's
                keep[i] = bool(inside[i]) and name[i] in _HEADINGS and not self.mark[i] and name[p] in ("header", "hgroup") and keep[parent[p]]
                keep[i] = keep[i] or (name[p] == "header" and bool(inside[i]) and name[i] == "hgroup" and keep[parent[p]])
            elif name[i] in _NEVER:
                keep[i] = False
            elif (self.mark[i] or name[i] in _APART) and not frame[i]:
                keep[i] = False
        return keep


def _densities(chars: np.ndarray, links: np.ndarray, tags: np.ndarray, link_tags: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Composite text density; ``share``: the page's link characters by its characters. Counts of 0 under a bar count as 1."""
    least = lambda x: np.maximum(x, 1)
    c, lc = chars.astype(float), links.astype(float)
    base = np.log(c / least(c - lc) * lc + share * c + np.e)
    # a base near 1 would blow up the logarithm of pages without links: 2 is the least
    return np.where(c > 0, c / least(tags) * np.log(np.maximum(c / least(lc) * least(tags) / least(link_tags), 1)) / np.log(np.maximum(base, 2)), 0.0)


def _chosen(page: Page, keep: np.ndarray, has: np.ndarray, density: np.ndarray, total: np.ndarray) -> int:
    """The main node of a page; -1 if no kept node has text. ``has``: characters of each node."""
    body, name, parent = page.body, page.name, page.parent
    inside = np.flatnonzero(keep & (has > 0))
    inside = inside[inside >= body]
    if not len(inside):
        return -1
    best = int(inside[np.argmax(total[inside])])
    path, i = [], best
    while i > body:
        path.append(i)
        i = parent[i]
    threshold = min([density[j] for j in path] + [density[body]])
    outer = [j for j in path if name[j] in _MAIN and keep[j]]
    if outer:
        return outer[-1]
    children: dict[int, list[int]] = {}
    for j in inside.tolist():
        children.setdefault(parent[j], []).append(j)
    while best > body and parent[best] >= body:
        up = parent[best]
        part = name[best] in _LEAVES or name[best] == TEXT or name[best] not in _BLOCK
        others = [j for j in children.get(up, []) if j != best]
        grows = all(name[j] in _HEADINGS or (density[j] >= threshold and up != body) for j in others)
        if not (part or (others and grows) or (not others and up != body)):
            break
        best = up
    return best


def _blocks(page: Page, keep: np.ndarray, root: int) -> str:
    """The text below ``root``: blocks joined by line feeds, white space inside a block as one space."""
    out: list[str] = []
    runs: list[str] = []

    def flush():
        if runs:
            text = " ".join("".join(runs).split())
            if text:
                out.append(text)
            runs.clear()

    open_: list[int] = []  # ends of open blocks
    for i in range(root, page.end[root]):
        while open_ and open_[-1] <= i:
            flush()
            open_.pop()
        name = page.name[i]
        if name in _BLOCK:
            flush()
            open_.append(page.end[i])
        elif name == "br":
            runs.append(" ")
        elif name == TEXT and keep[i]:
            runs.append(page.text[i])
    flush()
    return "\n".join(out)


def main_texts(pages: list[str]) -> list[str]:
    """Main texts of a list of pages; counts and densities of all nodes are computed together."""
    trees = [Page(html) for html in pages]
    keeps = [t.kept() for t in trees]
    sizes = np.array([len(t.name) for t in trees])
    first = np.concatenate([[0], np.cumsum(sizes)])
    n = int(first[-1])
    base = np.repeat(first[:-1], sizes)
    parent = np.concatenate([np.array(t.parent) for t in trees]) + base
    end = np.concatenate([np.array(t.end) for t in trees]) + base
    keep = np.concatenate(keeps)
    is_text = np.array([x == TEXT for t in trees for x in t.name])
    is_link = np.array([x == "a" for t in trees for x in t.name])
    own = np.array([len(" ".join(x.split())) if x else 0 for t in trees for x in t.text], np.int64)
    under_link, node = np.zeros(n, bool), np.arange(n)
    for i, j in zip(node[is_link], end[is_link]):
        under_link[i:j] = True

    def below(x: np.ndarray, itself: bool) -> np.ndarray:
        run = np.append(0, np.cumsum(x))
        return run[end] - run[node if itself else node + 1]

    all_chars, all_links = below(own, True), below(own * under_link, True)
    body = np.array([t.body for t in trees]) + first[:-1]
    share = np.repeat(all_links[body] / np.maximum(all_chars[body], 1), sizes)
    chars = below(own * keep, True)
    density = _densities(chars, below(own * keep * under_link, True), below(keep & ~is_text, False), below(keep & is_link, True), share)
    total = np.zeros(n)
    up = (parent >= base) & keep & (chars > 0)
    np.add.at(total, parent[up], density[up])
    out = []
    for k, t in enumerate(trees):
        here = slice(first[k], first[k + 1])
        root = _chosen(t, keeps[k], chars[here], density[here], total[here])
        out.append("" if root < 0 else _blocks(t, keeps[k], root))
    return out


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """All rows and columns of ``pages`` but ``html_col``, with the main text of the page and its number of code points.

    Text: blocks in page order joined by one line feed; character references decoded; white space inside a block (line breaks
    and ``br`` too) as one space. Left out: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, hidden
    parts and reader comments, known by element, role, class or id, and whatever is outside the chosen node. Null or empty pages,
    and pages without text, give an empty text. Broken pages are read to their end. Very long pages are read whole; a
    page is one row. Repeated rows stay. Columns named ``text_col`` or ``chars_col`` are replaced. An empty table: no rows.
    """
    rest = [c for c in pages.columns if c not in (html_col, text_col, chars_col)]

    def run(it):
        for batch in it:
            html = batch.column(batch.num_columns - 1)
            _, offs = string_buffer(html)
            for i, j in row_slices(offs):
                texts = main_texts([x or "" for x in html.slice(i, j - i).to_pylist()])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in range(len(rest))), pa.array(texts, pa.string()),
                                                  pa.array([len(x) for x in texts], pa.int64())], names)

    # by place: a column's own name may hold a dot
    src = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], F.col(f"`{html_col}`").cast("string").alias("html"))
    schema = StructType([*src.schema.fields[:-1], StructField("text", StringType()), StructField("n_chars", LongType())])
    names = schema.names
    return src.mapInArrow(run, schema).toDF(*rest, text_col, chars_col)


def duckdb_sql() -> str:
    """DuckDB SQL for ``extract`` over ``pages`` whose one ``article`` holds headings and paragraphs."""
    return r"""
WITH a AS (SELECT page_id, url, coalesce(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '') AS h FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(h, '</?(?:p|h1)>'), lambda x: regexp_replace(x, '<[^>]*>', ' ', 'g')) AS parts FROM a),
c AS (SELECT page_id, url, list_transform(parts, lambda x: replace(replace(regexp_replace(x, '&quot;?', '"', 'g'), '&lt;', '<'), '&gt;', '>')) AS parts FROM b),
d AS (SELECT page_id, url, list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(x, '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts FROM c),
t AS (SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) AS text FROM d)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
"""
