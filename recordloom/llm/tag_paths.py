"""Main text of HTML pages by tag path ratios.

A page is read into text nodes, each with the path of tags from the root down to it. For every path, the text
length and the punctuation of its nodes are summed and divided by the number of nodes that have the path. Both
ratios are smoothed over neighbouring nodes by a Gaussian, scaled by their largest value and multiplied, and the
nodes whose fused ratio reaches a share of its spread are content. What is returned is the content region: the
smallest element that holds most of the content, without elements whose tag, role, class or id names furniture
(navigation, headers and footers of the page, sidebars, notices, adverts, forms, comments by readers).

Text of a block (a run of text not interrupted by a block-level tag) has its character references decoded and its
white space collapsed; blocks are joined by an empty line, in the order of the page.

Defined results: null, empty and furniture-only pages give an empty text. A page without markup is one block.
Unclosed scripts, styles and comments reach to the end of the page. Rows are read one by one; result columns
replace input columns of the same name.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.arrays import steps, without

# Elements as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template textarea title iframe object svg math canvas audio video select option datalist head".split())
RAW = frozenset("script style textarea title iframe noscript noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark meter nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input picture source".split()
)
FURNITURE = frozenset("nav header footer aside form button menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar alert alertdialog dialog".split())
CLOSES = {
    "p": frozenset("p".split()),
    "li": frozenset("li".split()),
    "dt": frozenset("dt dd".split()),
    "dd": frozenset("dt dd".split()),
    "tr": frozenset("tr td th".split()),
    "td": frozenset("td th".split()),
    "th": frozenset("td th".split()),
    "option": frozenset("option".split()),
}
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
BOUNDARY = frozenset("table td th ul ol dl div section article main body html".split())
# Words in class and id that name furniture.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|topbar|footer|sidebar|side|aside|widget|related|recommend(?:ed|ations)?|"
    r"ads?|advert(?:s|isement|ising)?|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|"
    r"signup|login|search|form|share|sharing|social|comments?|disqus|replies|respond|pagination|pager|skip|toolbar|legal|copyright)(?:$|[\s_-])",
    re.IGNORECASE,
)
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")
# comments, declarations, tags (quotes may hold >), and a tag that the end of the page cuts off
_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?>(?:[^>"']|"[^"]*"|'[^']*')*)>|[^>]*(?:>|\Z))""", re.DOTALL
)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: Width of the smoothing in nodes, and the share of the spread of fused ratios that makes a node content.
SMOOTH, SPREAD = 1.0, 0.5
#: Share of the content that the chosen element holds at least.
MOST = 0.8
#: Share of a page's text that no furniture holds.
MOSTLY = 0.6


@dataclass(slots=True)
class Node:
    """A text node: its path of tags, its chain of elements, the block it stands in, the named furniture around it."""

    text: str
    path: str
    chain: tuple[int, ...]
    block: int
    named: int


def _is_hidden(tag: str, attributes: dict[str, str], article: bool) -> bool:
    """Furniture and hidden elements by tag, role and style."""
    if tag in HIDDEN or (tag in FURNITURE and not (tag == "header" and article)):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    return attributes.get("role", "").lower() in ROLES or "display:none" in re.sub(r"\s", "", attributes.get("style", "").lower())


def _is_named_furniture(tag: str, attributes: dict[str, str], article: bool) -> bool:
    """Furniture by class and id; within an article a heading part is none."""
    if tag in ("html", "body", "main", "article") or (article and tag in ("header", "h1", "h2", "h3", "h4", "h5", "h6")):
        return False
    return any(NAMES.search(_CAMEL.sub("-", attributes.get(k, ""))) for k in ("class", "id"))


def _parse(page: str, not_furniture: set[int]) -> list[Node]:
    """Text nodes outside hidden elements; ``not_furniture`` are elements whose name is not to be believed."""
    nodes: list[Node] = []
    stack: list[tuple[str, int, bool, int]] = []  # tag, number, hidden, number of the named furniture around
    elements = block = at = 0

    def add(text: str) -> None:
        if text and not (stack and stack[-1][2]):
            named = stack[-1][3] if stack else 0
            nodes.append(Node(text, "/".join(e[0] for e in stack), tuple(e[1] for e in stack), block, named))

    while True:
        found = _MARKUP.search(page, at)
        add(html.unescape(page[at : found.start() if found else len(page)]))
        if not found:
            return nodes
        at = found.end()
        if not found["tag"]:
            continue
        tag, rest = found["tag"].lower(), found["rest"].rstrip(">")
        if tag not in INLINE and tag not in HIDDEN and not (stack and stack[-1][2]):
            block += 1
        if page[found.start() + 1] == "/":
            names = [e[0] for e in stack]
            if tag in names:
                del stack[len(names) - 1 - names[::-1].index(tag) :]
            continue
        if tag in ENDS_P or tag in CLOSES:
            ended = CLOSES.get(tag, frozenset()) | ({"p"} if tag in ENDS_P else frozenset())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ended:
                    del stack[i:]
                    break
                if stack[i][0] in BOUNDARY:
                    break
        if tag in VOID:
            if tag == "br":
                add("\n")
            continue
        if tag in RAW:  # its content is no markup
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        attributes = {}
        if rest.strip():
            for name, value in _ATTRIBUTE.findall(rest):
                attributes.setdefault(name.lower(), html.unescape(value.strip("\"'")))
        article = any(e[0] in ("article", "main") for e in stack)
        elements += 1
        hidden = bool(stack and stack[-1][2]) or _is_hidden(tag, attributes, article)
        named = stack[-1][3] if stack else 0
        if not named and attributes and elements not in not_furniture and _is_named_furniture(tag, attributes, article):
            named = elements
        stack.append((tag, elements, hidden, named))


def text_nodes(page: str) -> list[Node]:
    """Text nodes outside furniture.

    On a page without an article, an element that holds most of the text is no furniture, whatever its name.
    """
    believed: set[int] = set()
    while True:
        nodes = _parse(page, believed)
        held: dict[int, int] = defaultdict(int)
        for n in nodes:
            held[n.named] += len(n.text.strip())
        large = {e for e, size in held.items() if e and size > MOSTLY * sum(held.values())}
        if not large or any(t in ("article", "main") for n in nodes if not n.named and n.text.strip() for t in n.path.split("/")):
            return [n for n in nodes if not n.named]
        believed |= large


def _smoothed(values: np.ndarray) -> np.ndarray:
    reach = np.arange(-3, 4)
    weights = np.exp(-(reach**2) / (2 * SMOOTH**2))
    padded = np.pad(values, 3)
    return np.convolve(padded, weights / weights.sum(), mode="same")[3:-3]


def content(nodes: list[Node]) -> np.ndarray:
    """Which nodes are content, by the fused ratios of their paths."""
    length, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    size = [len(n.text.strip()) for n in nodes]
    for n, s in zip(nodes, size, strict=True):
        if s:
            length[n.path] += s
            marks[n.path] += len(PUNCTUATION.findall(n.text))
            count[n.path] += 1
    by_length = _smoothed(np.array([length[n.path] / max(count[n.path], 1) for n in nodes]))
    by_marks = _smoothed(np.array([(marks[n.path] + 1) / max(count[n.path], 1) for n in nodes]))
    fused = by_length / max(by_length.max(), 1e-9) * (by_marks / max(by_marks.max(), 1e-9))
    chosen = fused >= min(SPREAD * fused.std(), fused.max())
    return chosen & (np.array(size) > 0)


def main_text(page: str | None) -> str:
    """The main text of one page."""
    nodes = [n for n in text_nodes(page or "") if n.text]
    if not any(n.text.strip() for n in nodes):
        return ""
    chosen = content(nodes)
    weight: dict[int, int] = defaultdict(int)
    total = 0
    for n, c in zip(nodes, chosen, strict=True):
        if c:
            total += len(n.text)
            for element in n.chain:
                weight[element] += len(n.text)
    # the innermost element that holds most of the content; an article or main element settles it at once
    holders = [e for e, w in weight.items() if w >= MOST * total]
    holder = max(holders, default=None)
    region = [n for n in nodes if holder is None or holder in n.chain]
    if holder is not None:
        tags = _tags(nodes)
        outer = [e for e in holders if tags.get(e) in ("article", "main")]
        if outer:
            region = [n for n in nodes if max(outer) in n.chain]
        elif tags.get(holder) not in ("div", "section", "td", "body", "html", "table"):  # a single paragraph is no region
            inner = [e for e in holders if tags.get(e) in ("div", "section", "td", "body", "html", "table")]
            region = [n for n in nodes if not inner or max(inner) in n.chain]
    blocks: list[list[str]] = []
    last = None
    for n in region:
        if n.block != last:
            blocks.append([])
            last = n.block
        blocks[-1].append(n.text)
    texts = (" ".join("".join(b).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


def _tags(nodes: list[Node]) -> dict[int, str]:
    out: dict[int, str] = {}
    for n in nodes:
        out.update(zip(n.chain, n.path.split("/"), strict=False))
    return out


def extract(pages: DataFrame, *, html_column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Add text and n_chars (its code points) to every page. ``keep`` names the input columns to carry along."""
    pages = without(pages, ["text", "n_chars"])
    names = [c for c in pages.columns if keep is None or c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, html_column, 1 << 20):
            texts = [main_text(page) for page in batch.column(html_column).to_pylist()]
            size = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(texts, pa.string()), size], names=[*names, "text", "n_chars"])

    schema = T.StructType([pages.schema[c] for c in names]).add("text", "string").add("n_chars", "long")
    return pages.select([F.col(f"`{c}`") for c in dict.fromkeys([*names, html_column])]).mapInArrow(run, schema)
