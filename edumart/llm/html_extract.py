"""HTML main-text extraction by minimum-cut labelling.

1. A tolerant scanner cuts a page into blocks of text (what lies between two
   block-level tags), each with its place in the element tree, its share of
   linked text, and the evidence of its elements.
2. A classifier gives each block two costs: what it costs to drop it and what
   it costs to keep it. They are the capacities of its edges from the source
   (content) and to the sink (boilerplate).
3. Smoothness edges join neighbouring blocks (adjacency; less capacity the
   more elements lie between them) and consecutive blocks of one element (DOM
   proximity, across nested elements).
4. A minimum cut, found by maximum flow, separates content from boilerplate;
   of several minimum cuts the one that keeps most is taken. Content blocks are
   joined in page order.

The classifier is a logistic regression over a block's shape (words, share of
links, sentence ends, heading, list item), fitted on the table itself: blocks
whose elements say content or boilerplate are the labelled ones, of pages drawn
by hash at a rate that gives about ``SAMPLE_PAGES``. Only counts by feature
value reach the driver (at most 21 x 5 x 2 x 2 x 2 x 2 rows at any input size).
The fit is drawn towards the stated weights ``PRIOR``, which stand where nothing
is labelled. Evidence of elements adds to the shape: the innermost element that
says something decides, except that navigation, asides, footers, reader
comments and elements named as boilerplate mark all they hold. Blocks without
evidence are told by their shape and by their neighbours through the cut.

Before the flow, blocks whose costs differ by at least the capacity of their
smoothness edges are settled (they keep their label in a minimum cut
whatever their neighbours do), which leaves a small graph on most pages.

Scale: no shuffle but the fit's counts; pages stream through Arrow, and a task holds one page's
blocks. Work and memory per page grow with its own length only.

Defined results: a null html is empty; a page without content has the empty
text; null ids and urls pass through; repeated rows get equal results; an empty
table gives an empty result; only the named columns are read. Unclosed elements
end with their parent, an unclosed comment, tag or raw-text element ends with
the page, and a ``<`` that starts no markup is text. Character references are
decoded as in HTML, also without a semicolon where HTML allows it; a cut-off
reference stays as it is. White space is what Unicode calls so.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edumart.llm.common import table

# Element and attribute words that say what a part of a page is.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template svg math object canvas audio video select "
                "button datalist".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = frozenset("ul ol dl table article section div main aside nav body td th".split())     # an implied end does not cross these
KEEP_TAGS = frozenset(["article", "main"])
DROP_TAGS = frozenset("form fieldset dialog menu head".split())
CONTAINERS = frozenset("div section ul ol dl table td form header".split())
DROP_ALL_TAGS = frozenset("nav aside footer".split())
KEEP_WORDS = frozenset("article articlebody main content story post entry body text maincontent mainbody blogpost hentry".split())
DROP_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense advertorial banner sponsor sponsored promo promotion promoted
    nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead topbar toolbar search login signup signin register
    sidebar side rail widget widgets related recommended recommendations popular trending teaser teasers outbrain taboola
    notice notices cookie cookies consent gdpr privacy popup modal overlay dialog alert paywall newsletter subscribe subscription
    share sharing social follow form hidden skip toc""".split())
DROP_ALL_WORDS = frozenset("""comment comments commentlist reply replies respond disqus discussion reactions complementary contentinfo
    footer colophon copyright""".split())

KEEP_TAG, KEEP, NONE, HEADER, DROP, DROP_ALL = 2, 1, 0, 3, -1, -2

#: Logits of a block's shape that the fit starts from: base, words (of 20), linked share, sentence end, heading, list item.
PRIOR = (-2.0, 6.0, -12.0, 0.8, 1.2, -0.6)
PRIOR_WEIGHT = 2.0                 # strength of the pull towards them, in labelled blocks
SAMPLE_PAGES = 5000                # pages the fit draws, about
MOST_WORDS, SHARES = 20, 4         # words counted; steps of the linked share
SCALE = 10                         # capacity per logit
SHAPE_AT_MOST = 100                # largest cost from the shape alone
ELEMENT, OUTSIDE = 140, 80         # cost of going against element evidence; of keeping what lies outside the content element
ADJACENT, SIBLING = 16, 8          # capacities of smoothness edges

# A comment, declaration or tag; one that never ends takes the rest of the page.
MARKUP = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</?([a-zA-Z][^\s/>]*)(?>(?:[^>"']++|"[^"]*+"|'[^']*+')*+(?:>|\Z)|[^>]*+(?:>|\Z))""", re.S)
ATTRIBUTE = re.compile(r"""[\s"'/](class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|[\s"'/](hidden)(?=[\s/>=])""", re.I)
WORD = re.compile(r"[a-z]+")
SENTENCE = re.compile(r"[.!?…。！？](?:\s|$|[\"'”’»)])")


class Block:
    __slots__ = ("text", "parent", "depth", "evidence", "linked", "chars", "heading", "item")

    def __init__(self, text, parent, depth, evidence, linked, chars, heading, item):
        self.text, self.parent, self.depth, self.evidence = text, parent, depth, evidence
        self.linked, self.chars, self.heading, self.item = linked, chars, heading, item


def element_evidence(tag: str, markup: str) -> int:
    """What an element's tag and its class, id and role say about what it holds."""
    if tag in DROP_ALL_TAGS:
        return DROP_ALL
    names: set[str] = set()
    if len(markup) > len(tag) + 2 and tag not in ("body", "html"):
        for name, value, hidden in ATTRIBUTE.findall(markup):
            if hidden:
                names.add("hidden")
            elif name.lower() != "id" or tag in CONTAINERS:       # a heading's id holds words of its text
                names.update(value.strip("\"'").lower().split())
    if tag in KEEP_TAGS:                                          # its own words are about the article: whole names only
        return DROP_ALL if names & (DROP_WORDS | DROP_ALL_WORDS) else KEEP_TAG
    if names:
        words = {w for n in names for w in WORD.findall(n)}
        dropped = words & DROP_WORDS
        if words & DROP_ALL_WORDS or names & DROP_WORDS - {"header", "form"}:
            return DROP_ALL
        if dropped:
            return HEADER if dropped == {"header"} else DROP
        if words & KEEP_WORDS:
            return KEEP
    return HEADER if tag == "header" else DROP if tag in DROP_TAGS else NONE


def blocks(page: str) -> list[Block]:
    """The page's blocks of text in page order."""
    out: list[Block] = []
    # open block elements: (tag, element number, evidence inside)
    stack: list[tuple[str, int, int]] = [("", 0, NONE)]
    opened: dict[str, int] = {}
    number, links, pieces, linked = 0, 0, [], []
    pos, size = 0, len(page)

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                tag, parent, evidence = stack[-1]
                chars = sum(not c.isspace() for c in text) if linked else 1
                in_links = sum(len("".join(x.split())) for x in linked)
                out.append(Block(text, parent, len(stack), evidence, in_links, chars,
                                 len(tag) == 2 and tag[0] == "h" and tag[1].isdigit(), tag == "li" or "li" in opened and opened["li"] > 0))
            pieces.clear()
            linked.clear()

    def pop() -> None:
        opened[stack.pop()[0]] -= 1

    while pos < size:
        m = MARKUP.search(page, pos)
        start = m.start() if m else size
        if start > pos:
            text = page[pos:start]
            if "&" in text:
                text = entities.unescape(text)
            pieces.append(text)
            if links:
                linked.append(text)
        if not m:
            break
        pos = m.end()
        tag = m.group(1)
        if tag is None:
            continue
        tag, closing = tag.lower(), page[start + 1] == "/"
        if tag in RAW:
            if not closing and not page.endswith("/>", start, pos):
                pos = _after_raw(page, pos, tag)
            if tag not in ("noscript", "svg", "math", "button", "template", "script", "style"):
                flush()
            else:
                pieces.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            elif tag == "br":
                pieces.append(" ")
            part = f"*{tag}"                                      # an inline part that is boilerplate is a block of its own
            within = opened.get(part, 0) > 0
            if tag in VOID or (closing and not within):
                continue
            if not closing and not within and (not ("class" in m.group() or "hidden" in m.group())
                                               or element_evidence(tag, m.group()) not in (DROP, DROP_ALL)):
                continue
            tag = part
        if closing:
            flush()
            links = 0
            if opened.get(tag, 0) > 0:
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        flush()
        if tag in VOID:
            continue
        if opened.get("p", 0) > 0 and stack[-1][0] == "p" and tag[0] != "*":
            pop()
        for implied in CLOSES.get(tag, ()):
            if opened.get(implied, 0) > 0:
                at = len(stack) - 1
                while stack[at][0] != implied and (stack[at][0] not in SCOPE or stack[at][0] in CLOSES[tag]) and at:
                    at -= 1
                if stack[at][0] == implied:
                    while len(stack) > at:
                        pop()
        if tag in KEEP_TAGS and opened.get("nav", 0) > 0:         # a menu that was never closed
            while opened["nav"] > 0:
                pop()
        number += 1
        outer = stack[-1][2]
        found = outer if outer == DROP_ALL else element_evidence(tag.lstrip("*"), m.group())
        if found == HEADER:                                       # the content's own header holds its title
            found = outer if outer in (KEEP, KEEP_TAG) else DROP
        elif found == KEEP and outer == DROP:                     # a banner's "content" stays a banner
            found = DROP
        stack.append((tag, number, found or outer))
        opened[tag] = opened.get(tag, 0) + 1
    flush()
    return out


_RAW_END: dict[str, re.Pattern] = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I) for t in RAW}


def _after_raw(page: str, pos: int, tag: str) -> int:
    m = _RAW_END[tag].search(page, pos)
    return m.end() if m else len(page)


def shape(b: Block) -> tuple[int, int, int, int, int]:
    """(words, linked share in steps, sentence end, heading, list item)."""
    share = min(SHARES, round(SHARES * b.linked / b.chars)) if b.linked else 0
    return min(MOST_WORDS, b.text.count(" ") + 1), share, SENTENCE.search(b.text) is not None, b.heading, b.item


def logit(x: tuple, weights: tuple) -> float:
    base, words, share, sentence, heading, item = weights
    return base + words * x[0] / MOST_WORDS + share * x[1] / SHARES + sentence * x[2] + heading * x[3] + item * x[4]


def costs(found: list[Block], weights: tuple = PRIOR) -> list[int]:
    """Cost of dropping minus cost of keeping, for each block."""
    has_content = any(b.evidence == KEEP_TAG for b in found)
    out = []
    for b in found:
        cost = max(-SHAPE_AT_MOST, min(SHAPE_AT_MOST, round(SCALE * logit(shape(b), weights))))
        if b.evidence > 0:
            cost += ELEMENT
        elif b.evidence < 0:
            cost -= ELEMENT
        elif has_content:
            cost -= OUTSIDE
        out.append(cost)
    return out


def fit(counts: list[tuple]) -> tuple:
    """Weights from rows (words, share, sentence, heading, item, is content, n):
    Newton steps of a logistic regression, both classes of equal weight, drawn
    towards ``PRIOR``."""
    prior = np.array(PRIOR)
    if not counts:
        return PRIOR
    c = np.array(counts, float)
    x = np.column_stack([np.ones(len(c)), c[:, 0] / MOST_WORDS, c[:, 1] / SHARES, c[:, 2:5]])
    y, n = c[:, 5], c[:, 6]
    sides = [n[y == v].sum() for v in (0, 1)]
    if min(sides) == 0:
        return PRIOR
    n = n * np.where(y == 1, 0.5 / sides[1], 0.5 / sides[0]) * sum(sides)
    pull, w = PRIOR_WEIGHT + 0.001 * sum(sides), prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + pull * (w - prior)
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w)), gradient)
        step *= min(1.0, 4 / max(1e-9, np.abs(step).max()))
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(np.round(w, 6).tolist())


def smoothness(found: list[Block]) -> list[tuple[int, int, int]]:
    """Edges (block, block, capacity): adjacency and DOM proximity."""
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:
            before = found[i - 1]
            apart = 0 if before.parent == b.parent else 1 + abs(before.depth - b.depth)
            edges.append((i - 1, i, max(1, ADJACENT // (1 + apart))))
        j = last.get(b.parent)
        if j is not None and j != i - 1:
            edges.append((j, i, SIBLING))
        last[b.parent] = i
    return edges


# ------------------------------------------------------------ minimum cut

def min_cut(terminal: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Label True (source side) or False per node, of a minimum cut.

    ``terminal[i]`` > 0 is the capacity source -> i, < 0 its negative is the
    capacity i -> sink; ``edges`` are undirected. Of several minimum cuts the
    one with the most True labels.
    """
    n = len(terminal)
    net = list(terminal)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for i, j, c in edges:
        if i != j and c > 0:
            near[i][j] = near[i].get(j, 0) + c
            near[j][i] = near[j].get(i, 0) + c
    label: list[bool | None] = [None] * n
    pull = [sum(x.values()) for x in near]
    todo = deque(range(n))
    while todo:                                                   # settle what no neighbour can change
        i = todo.popleft()
        if label[i] is not None or not (net[i] >= pull[i] or -net[i] > pull[i]):
            continue
        label[i] = net[i] >= pull[i]
        for j, c in near[i].items():
            if label[j] is None:
                net[j] += c if label[i] else -c
                pull[j] -= c
                todo.append(j)
    core = [i for i in range(n) if label[i] is None]
    if core:
        for i, side in zip(core, _flow_cut(core, net, near, label)):
            label[i] = side
    return label


def _flow_cut(core: list[int], net: list[int], near: list[dict[int, int]], label: list) -> list[bool]:
    """Maximum flow on the unsettled nodes by shortest augmenting paths in
    level graphs; nodes that cannot reach the sink afterwards are True."""
    at = {i: k for k, i in enumerate(core)}
    n = len(core)
    room = [{at[j]: c for j, c in near[i].items() if label[j] is None} for i in core]
    excess = [net[i] for i in core]                               # left to the source (> 0) or the sink (< 0)
    while True:
        level = [-1] * n                                          # distance to a node that still drains into the sink
        queue = deque(k for k in range(n) if excess[k] < 0)
        for k in queue:
            level[k] = 0
        while queue:
            k = queue.popleft()
            for j in room[k]:
                if level[j] < 0 and room[j].get(k, 0) > 0:
                    level[j] = level[k] + 1
                    queue.append(j)
        if not any(excess[k] > 0 and level[k] >= 0 for k in range(n)):
            return [x < 0 for x in level]
        choices = [list(r) for r in room]
        for k in range(n):
            while excess[k] > 0 and level[k] >= 0:
                path = [k]
                while path:
                    v = path[-1]
                    if level[v] == 0 and excess[v] < 0:
                        break
                    while choices[v] and not (room[v][choices[v][-1]] > 0 and level[choices[v][-1]] == level[v] - 1):
                        choices[v].pop()
                    if choices[v]:
                        path.append(choices[v][-1])
                    else:
                        path.pop()
                        if path:
                            choices[path[-1]].pop()
                if not path:
                    break
                amount = min(excess[k], -excess[path[-1]], *(room[a][b] for a, b in zip(path, path[1:])))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= amount
                    room[b][a] = room[b].get(a, 0) + amount
                excess[k] -= amount
                excess[path[-1]] += amount


def main_text(page: str, weights: tuple = PRIOR) -> tuple[str, int, int]:
    """(text, blocks of the page, blocks kept)."""
    found = blocks(page)
    kept = [b.text for b, keep in zip(found, min_cut(costs(found, weights), smoothness(found))) if keep]
    return "\n".join(kept), len(found), len(kept)


# ------------------------------------------------------------- Spark plan

FLUSH = 4 << 20                    # characters of output held before a batch goes out


def train(pages: DataFrame, key: str, html: str) -> tuple:
    """The classifier's weights, fitted on a hash sample of about ``SAMPLE_PAGES`` pages."""
    names = ["words", "share", "sentence", "heading", "item", "content", "n"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for h in b.column(0):
                seen.update((*map(int, shape(x)), int(x.evidence > 0)) for x in blocks(h.as_py() or "") if x.evidence != NONE)
        if seen:
            columns = zip(*((*k, n) for k, n in seen.items()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    every = max(1, pages.count() // SAMPLE_PAGES)
    sample = pages.filter(F.pmod(F.xxhash64(F.col(key)), F.lit(every)) == 0).select(F.col(html).cast("string").alias("html"))
    counts = sample.mapInArrow(count, ", ".join(f"{n} long" for n in names)) \
        .groupBy(*names[:-1]).agg(F.sum("n").alias("n")).collect()
    return fit(sorted(map(tuple, counts)))


def extract(pages: DataFrame, key: str, url: str, html: str, weights: tuple | None = None) -> DataFrame:
    """(page_id, url, text, n_blocks, n_kept), one row per row of ``pages``;
    without ``weights`` the classifier is fitted on ``pages`` first."""
    weights = weights or train(pages, key, html)
    names = ["page_id", "url", "text", "n_blocks", "n_kept"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for k, u, h in zip(*b.columns):
                text, n, kept = main_text(h.as_py() or "", weights)
                held.append((k.as_py(), u.as_py(), text, n, kept))
                size += len(text)
                if size >= FLUSH or len(held) >= 4096:
                    yield batch(held)
                    held, size = [], 0
        if held:
            yield batch(held)

    return pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(html).cast("string").alias("html")) \
        .mapInArrow(rows, "page_id long, url string, text string, n_blocks long, n_kept long")


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), "page_id", "url", "html").select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks", "n_kept")
