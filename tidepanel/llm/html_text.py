"""Main text of web pages by a tree-structured graphical model.

The block elements of a page are the nodes of a tree. A node's label is whether
its own text is main text. The model has a potential for every parent-child edge
(how labels follow each other downward) and node potentials from what a block
looks like: tag, class and id words, its text and links, those below it. Both are
estimated from labelled pages. Sum-product messages, upward then downward, give
every node's exact marginal, and text of blocks above one half is kept. On a page that
has prose but no such block the marginals are taken given that its likeliest prose is
main text.

Messages run level by level over the arrays of a whole batch of pages.

Defined cases: null and empty html give an empty text; markup that is broken or
cut off is read as far as it goes, open elements end with the page; what is inside
an svg, video, noscript, select or the like is no text, but one that its parent ends before an
end tag of its own hides nothing; nothing is
dropped for its length; equal pages are extracted one by one; an empty table
gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import text_or_empty
from tidepanel.llm.encoding import text_batches
from tidepanel.llm.html_samples import labelled_pages

# HTML's elements by how they are laid out or parsed
BLOCKS = frozenset(
    "html body article section nav aside header footer main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt "
    "dd table caption thead tbody tfoot tr blockquote pre figure figcaption form fieldset address "
    "details summary center dialog menu hgroup search button label legend".split())
ENDS_PARAGRAPH = BLOCKS - frozenset("button label caption thead tbody tfoot tr".split())
RAW_TEXT = frozenset("script style textarea title iframe noembed noframes xmp".split())
NOT_TEXT = frozenset("template noscript select svg math object audio video canvas".split())
FOREIGN = frozenset("svg math".split())  # may be closed by their own tag
SPACED = frozenset("br td th hr img input wbr".split())
SIBLINGS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
            "tr": ("tr", ("table", "thead", "tbody", "tfoot"))}
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr blockquote pre ul ol dl table".split())
TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+\Z", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_WORD = re.compile(r"[a-z]+")
LANDMARKS = frozenset("nav aside header footer form dialog article main section table".split())
NEVER_MAIN = frozenset("nav aside footer form dialog button".split())
CERTAINLY = 50.0  # log odds of a label that is given
PROSE = 80  # characters from which a block with a sentence's end and without links is prose
SENTENCE_END = (".", "!", "?", "…", ":", ";", '"', "”", "»")


class Page:
    """Nodes (parallel lists) and blocks of text in page order."""

    __slots__ = ("parent", "depth", "tag", "names", "chars", "linked", "blocks", "marks")

    def __init__(self):
        self.parent, self.depth, self.tag, self.names = [-1], [0], ["page"], [()]
        self.chars, self.linked = [0], [0]  # of the node's own text
        self.blocks: list[tuple[int, str]] = []
        self.marks = [""]


def parse(html: str, with_marks: bool = False) -> Page:
    page = Page()
    parent, depth, tags, chars, linked = (
        page.parent, page.depth, page.tag, page.chars, page.linked)
    open_nodes = [0]
    held: list[str] = []
    in_link = False
    hidden: list[tuple] = []  # open elements of NOT_TEXT, with what was there before each
    floors: list[int] = []  # and how many nodes stay open while each does
    at, end = 0, len(html)

    def flush():
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                page.blocks.append((open_nodes[-1], text))

    def close(names, until=()):
        """Ends the innermost open element of `names`, unless one of `until` is nearer."""
        for i in range(len(open_nodes) - 1, 0, -1):
            tag = tags[open_nodes[i]]
            if tag in names:
                del open_nodes[i:]
                return
            if tag in until:
                return

    def begin_hidden(tag):
        held[:] = ["".join(held), " "]
        node = open_nodes[-1]
        hidden.append((tag, open_nodes[:], held[0], len(page.blocks), len(parent), chars[node],
                       linked[node], in_link))
        floors.append(len(open_nodes))

    def leave_hidden():
        """Elements of NOT_TEXT whose parent has ended are not closed any more."""
        while floors and floors[-1] > len(open_nodes):
            floors.pop()
            hidden.pop()

    def keep_hidden():
        """A paragraph that another one inside them ended does not end them."""
        for i in range(len(floors) - 1, -1, -1):
            if floors[i] <= len(open_nodes):
                break
            floors[i] = len(open_nodes)

    def end_hidden(tag):
        """Takes back what came since the innermost open `tag`; whether it was in a link."""
        for i in range(len(hidden) - 1, -1, -1):
            if hidden[i][0] == tag:
                break
        else:
            return in_link
        _, nodes, text, blocks, n, own, own_linked, link = hidden[i]
        del hidden[i:], floors[i:], page.blocks[blocks:], parent[n:], depth[n:], tags[n:], chars[n:], linked[n:]
        del page.names[n:], page.marks[n if with_marks else 1:]
        open_nodes[:], held[:] = nodes, [text, " "]
        chars[nodes[-1]], linked[nodes[-1]] = own, own_linked
        return link

    while at < end:
        m = TOKEN.search(html, at)
        text = html[at:m.start()] if m else html[at:]
        if text:
            held.append(text)
            n = len(text.strip())
            node = open_nodes[-1]
            chars[node] += n
            if in_link:
                linked[node] += n
        if not m:
            break
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        closing = m[1] or m[4]
        if tag in RAW_TEXT:
            if not closing:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = stop.end() if stop else end
                held.append(" ")
        elif tag in NOT_TEXT:
            if closing:
                in_link = end_hidden(tag)
            elif tag in FOREIGN and m[0].endswith("/>"):
                held.append(" ")
            else:
                begin_hidden(tag)
        elif tag == "head":
            if not closing:
                stop = re.compile(r"</head\s*>|<body\b", re.I).search(html, at)
                if stop:
                    at = stop.end() if stop[0][1] == "/" else stop.start()
        elif tag == "a":
            in_link = not closing
        elif tag in SPACED:
            held.append(" ")
        elif tag in BLOCKS:
            flush()
            in_link = False
            if closing:
                close((tag,), () if tag == "table" else ("table",) if tag != "tr" else ())
                leave_hidden()
                continue
            if tag in ENDS_PARAGRAPH:
                close(("p",), ("table", "button"))
            if tag in SIBLINGS:
                names, until = SIBLINGS[tag]
                close(names.split(), until)
            keep_hidden()
            up = open_nodes[-1]
            attributes = m[3] or m[6] or ""
            names = []
            if "=" in attributes:
                for _, a, b, c in ATTRIBUTE.findall(attributes):
                    names += NAME_WORD.findall((a or b or c).lower())
            open_nodes.append(len(parent))
            parent.append(up)
            depth.append(depth[up] + 1)
            tags.append(tag)
            page.names.append(names)
            chars.append(0)
            linked.append(0)
            if with_marks:
                page.marks.append("1" if "data-main" in attributes
                                  else "0" if "data-other" in attributes else "")
    flush()
    return page


def bucket(n: int) -> int:
    return 0 if n == 0 else 1 if n < 25 else 2 if n < 80 else 3 if n < 250 else 4


def share(part: int, whole: int) -> int:
    return 0 if not part else 1 if 3 * part < whole else 2 if 3 * part < 2 * whole else 3


def prose_blocks(page: Page) -> np.ndarray:
    """Whether a node's own text is prose outside elements that never are main text."""
    out = np.zeros(len(page.parent), dtype=bool)
    for v, text in page.blocks:
        if len(text) >= PROSE and text.endswith(SENTENCE_END) and 3 * page.linked[v] < page.chars[v]:
            out[v] = True
    never = [False] * len(out)
    for v in range(1, len(out)):
        never[v] = never[page.parent[v]] or page.tag[v] in NEVER_MAIN
    return out & ~np.array(never)


def fifth(part: int, whole: int) -> int:
    return min(4, 5 * part // whole) if whole else 0


def features(page: Page) -> list[list[tuple]]:
    """What each node looks like: by itself, with what is below it, next to its
    siblings, and by its place in the page."""
    n = len(page.parent)
    chars, linked, paragraphs = page.chars[:], page.linked[:], [0] * n
    for v in range(n - 1, 0, -1):
        up = page.parent[v]
        chars[up] += chars[v]
        linked[up] += linked[v]
        paragraphs[up] += paragraphs[v] + (page.tag[v] == "p")
    sign, notice = [""] * n, [False] * n
    for v, text in page.blocks:
        sign[v] = "end" if text.endswith(SENTENCE_END) else "open"
        notice[v] = notice[v] or "©" in text
    prose = prose_blocks(page).tolist()
    beside, alike = [0] * n, defaultdict(int)  # characters of prose and like siblings in a parent
    for v in range(1, n):
        beside[page.parent[v]] += prose[v] * page.chars[v]
        alike[page.parent[v], page.tag[v], prose[v]] += 1
    most = max(beside)
    heading = page.tag.index("h1") if "h1" in page.tag else n
    before, landmark, outer = 0, ["none"] * n, ["none"] * n
    out = []
    for v in range(n):
        f = [("tag", page.tag[v]), ("own", bucket(page.chars[v])), ("sign", sign[v]),
             ("links", share(page.linked[v], page.chars[v])),
             ("below links", share(linked[v], chars[v])),
             ("paragraphs", min(3, paragraphs[v])),
             ("place", fifth(before, chars[0])), ("weight", fifth(chars[v], chars[0])),
             ("heading", heading < n, v >= heading), ("prose", prose[v])]
        before += page.chars[v]
        if notice[v]:
            f.append(("notice",))
        f += [("name", w) for w in set(page.names[v])]
        f += [("stem", w) for w in {w[:4] for w in page.names[v] if len(w) > 4}]
        if beside[v]:
            f.append(("holds prose", beside[v] == most))
        up = page.parent[v]
        if up >= 0:
            own = page.tag[v] in LANDMARKS
            landmark[v] = page.tag[v] if own else landmark[up]
            outer[v] = landmark[up] if own else outer[up]
            f += [("in", page.tag[up]), ("landmark", landmark[v]), ("landmarks", landmark[v], outer[v]),
                  ("alike", prose[v], min(4, alike[up, page.tag[v], prose[v]]))]
            if beside[up]:
                f.append(("beside prose", beside[up] == most, page.tag[v] in TEXT_BLOCKS))
            f += [("in name", w) for w in set(page.names[up])]
        out.append(f)
    return out


def kinds(page: Page) -> np.ndarray:
    return np.array([tag in TEXT_BLOCKS for tag in page.tag], dtype=np.int64)


class Model:
    """Log potentials: of a node's features, and of (child kind, parent label, child
    label), where the kinds are containers and blocks of text."""

    def __init__(self, feature: dict[tuple, float], edge: np.ndarray):
        self.feature, self.edge = feature, edge

    def evidence(self, page: Page) -> list[float]:
        """Log odds of each node's features for main text."""
        get = self.feature.get
        return [sum([get(x, 0.0) for x in f]) for f in features(page)]

    def marginals(self, pages: list[Page]) -> list[np.ndarray]:
        """Of every node, given that a page with prose has main text: where no block of it
        would be any, its likeliest block of prose is taken to be."""
        found = self.messages(pages, [-1] * len(pages))
        again, given = [], []
        for i, (page, p) in enumerate(zip(pages, found)):
            if not any(p[v] > 0.5 for v, _ in page.blocks):
                prose = np.flatnonzero(prose_blocks(page))
                if len(prose):
                    again.append(i)
                    given.append(int(prose[np.argmax(p[prose])]))
        if again:
            for i, p in zip(again, self.messages([pages[i] for i in again], given)):
                found[i] = p
        return found

    def messages(self, pages: list[Page], given: list[int]) -> list[np.ndarray]:
        """given: for every page a node that is known to be main text, or -1."""
        sizes = [len(p.parent) for p in pages]
        starts = np.cumsum([0, *sizes])
        depth = np.concatenate([p.depth for p in pages])
        parent = np.concatenate([np.array(p.parent) + s for p, s in zip(pages, starts)])
        node = np.zeros((len(depth), 2))
        node[:, 1] = np.concatenate([self.evidence(p) for p in pages])
        for v, start in zip(given, starts):
            if v >= 0:
                node[start + v, 1] += CERTAINLY
        kind = np.concatenate([kinds(p) for p in pages])
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
        # upward: a child's message is its belief summed over its own label
        up = np.zeros_like(node)
        belief = node.copy()
        for level in levels[:0:-1]:
            a = belief[level][:, None, :] + self.edge[kind[level]]  # [child, parent label, label]
            up[level] = np.logaddexp(a[:, :, 0], a[:, :, 1])
            np.add.at(belief, parent[level], up[level])
        # downward: the parent's belief without what this child told it
        for level in levels[1:]:
            rest = belief[parent[level]] - up[level]
            a = rest[:, :, None] + self.edge[kind[level]]
            belief[level] += np.logaddexp(a[:, 0], a[:, 1])
            belief[level] -= belief[level].max(axis=1, keepdims=True)
        p = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))
        return np.split(p, starts[1:-1])


def labels_of(page: Page) -> list[int]:
    """From the marks: a node without one has its parent's label."""
    out = [0]
    for v in range(1, len(page.parent)):
        out.append(int(page.marks[v]) if page.marks[v] else out[page.parent[v]])
    return out


def train(pages: list[str], steps: int = 400, rate: float = 0.05, decay: float = 3e-5) -> Model:
    """Potentials of the highest pseudo-likelihood (each label given its neighbours'
    labels and its features), by gradient steps with moment estimates."""
    index: dict[tuple, int] = {}
    node_of, feature_of, labels, parents, kind = [], [], [], [], []
    for html in pages:
        page = parse(html, with_marks=True)
        start = len(labels)
        for v, f in enumerate(features(page)):
            for x in f:
                node_of.append(start + v)
                feature_of.append(index.setdefault(x, len(index)))
        parents += [up + start if up >= 0 else -1 for up in page.parent]
        labels += labels_of(page)
        kind.append(kinds(page))
    y, up = np.array(labels), np.array(parents)
    node_of, feature_of = np.array(node_of), np.array(feature_of)
    child = np.flatnonzero(up >= 0)
    n, k = len(y), len(index)
    w = np.zeros(k + 8)  # features, then edges by (kind, parent label, label)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    yp, yc, kind = y[up[child]], y[child], np.concatenate(kind)[child]
    for step in range(1, steps + 1):
        edge = w[k:].reshape(2, 2, 2)
        odds = np.bincount(node_of, w[feature_of], n)
        odds[child] += edge[kind, yp, 1] - edge[kind, yp, 0]
        odds += np.bincount(up[child], edge[kind, 1, yc] - edge[kind, 0, yc], n)
        wrong = (1 / (1 + np.exp(-odds)) - y) / n
        slope = np.zeros_like(w)
        slope[:k] = np.bincount(feature_of, wrong[node_of], k)
        turn = np.zeros((2, 2, 2))
        for label, sign in ((0, -1), (1, 1)):
            turn[:, :, label] += sign * np.bincount(
                2 * kind + yp, wrong[child], 4).reshape(2, 2)
            turn[:, label] += sign * np.bincount(
                2 * kind + yc, wrong[up[child]], 4).reshape(2, 2)
        slope[k:] = turn.ravel()
        slope += decay * w
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope ** 2
        w -= rate * mean / (1 - 0.9 ** step) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-9)
    return Model({x: float(w[i]) for x, i in index.items()}, w[k:].reshape(2, 2, 2))


def main_text(page: Page, marginal: np.ndarray) -> str:
    return "\n".join(text for v, text in page.blocks if marginal[v] > 0.5)


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every page. model: trained from the labelled
    layouts of `html_samples` unless one is given."""
    model = model or train(labelled_pages())

    def texts(batches):
        for frame in batches:
            sources = list(frame.pop("html"))
            out = []
            for part in text_batches(sources):
                parsed = [parse(h) for h in sources[part]]
                out += map(main_text, parsed, model.marginals(parsed))
            frame["text"] = out
            frame["n_chars"] = np.array([len(t) for t in out], dtype=np.int64)
            yield frame

    rows = pages.select(F.col("page_id").cast("string").alias("page_id"),
                        F.col("url").cast("string").alias("url"),
                        text_or_empty("html").alias("html"))
    return (rows.mapInPandas(texts, "page_id string, url string, text string, n_chars long")
            .withColumn("page_id", F.col("page_id").cast("long")))
