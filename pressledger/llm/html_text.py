"""Main text of web pages by composite text density (after Sun, Song and Liao, 2011).

Every node of the page's tree gets its characters per tag, adjusted by how much of them are links. The node whose children's densities have the highest
sum holds the text; the lowest density on its way up to the body is the threshold by which further parts belong to it. Parts that name
themselves as menus, headers, footers, sidebars, notices, adverts, forms or comments are taken out first.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import released

# fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong "
                   "sub sup time tt u var wbr".split())
#: elements that a new block, or one of the same kind, closes
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
                     "main menu nav ol p pre search section summary table ul".split())
SAME = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
        "tbody": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tr", "td", "th", "tbody", "thead"}, {"table"})}
SCOPE = frozenset("html table td th caption template object".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# names of parts that are not the article
UNSEEN = frozenset("head title script style noscript template iframe object svg math canvas audio video button select textarea datalist dialog map".split())
PARTS = frozenset("nav footer aside form menu search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
WORDS = frozenset("ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner sidebar cookie cookies consent gdpr notice notices "
                  "alert comment comments disqus respond reply replies menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar "
                  "related recommended recommendations teaser teasers share sharing social newsletter subscribe subscription signup login popup modal overlay widget widgets "
                  "pager pagination skip copyright disclaimer form".split())
#: where the text of a page usually stands; the tags count, and whole words of a class or id
HOLDERS, HOLDER_WORDS = frozenset({"article", "main"}), frozenset("article content post entry story".split())
#: a part with so many links and this share of its characters in them is a menu, where its density is below the threshold
MENU_LINKS, MENU_SHARE = 2, 2 / 3
PIECES = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class Tree(HTMLParser):
    """A page as flat lists, in page order: a node's parent, tag, names; pieces of text and the node that each lies in. Formatting that
    is never closed ends with its block."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.names, self.hidden = [-1], ["#root"], [frozenset()], [False]
        self.texts: list[tuple[int, str, int]] = []  # with the number of nodes so far
        self.open, self.counts = [0], Counter(["#root"])
        self.feed(html)
        self.close()

    def _pop(self, to: int) -> None:
        while len(self.open) > to:
            self.counts[self.tag[self.open.pop()]] -= 1

    def _close_within(self, tags: set[str] | frozenset[str], ends: set[str] | frozenset[str]) -> None:
        """Closes the outermost open element of ``tags`` above the innermost of ``ends``."""
        if not any(self.counts[t] for t in tags):
            return
        found = None
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[k]]
            if tag in ends:
                break
            if tag in tags:
                found = k
        if found is not None:
            self._pop(found)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES_P and self.counts["p"]:
            self._close_within({"p"}, SCOPE | {"button"})
        if tag in SAME:
            self._close_within(*SAME[tag])
        given = {k: v or "" for k, v in attrs}
        names = frozenset(w.lower() for w in PIECES.findall(given.get("class", "") + " " + given.get("id", ""))) if given else frozenset()
        self.parent.append(self.open[-1])
        self.tag.append(tag)
        self.names.append(names | {"role:" + r for r in given["role"].lower().split()} if "role" in given else names)
        style = given.get("style", "").replace(" ", "").lower() if "style" in given else ""
        self.hidden.append("hidden" in given or given.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style)
        if tag not in VOID:
            self.open.append(len(self.tag) - 1)
            self.counts[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash of other than void elements means nothing

    def handle_endtag(self, tag: str) -> None:
        if not self.counts[tag]:
            return
        for k in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[k]]
            if name == tag:
                return self._pop(k)
            # the end of emphasis or of a link does not close blocks, the end of a block no table around it
            if (tag in INLINE and name not in INLINE) or name in SCOPE:
                return None

    def handle_data(self, data: str) -> None:
        self.texts.append((self.open[-1], data, len(self.tag)))


def left_out(tree: Tree) -> list[bool]:
    """Whether a node lies in a part that names itself as no part of the article."""
    tags, names, parent, many = tree.tag, tree.names, tree.parent, len(tree.tag)
    holds = [t in HOLDERS and not names[i] & WORDS or t == "h1" for i, t in enumerate(tags)]  # the article, or something around it
    for i in range(many - 1, 0, -1):
        holds[parent[i]] = holds[parent[i]] or holds[i]
    inside, out = [False] * many, [False] * many
    for i in range(1, many):
        tag, own, p = tags[i], names[i], parent[i]
        inside[i] = inside[p] or tag in HOLDERS or bool(own & HOLDER_WORDS)
        words = own & WORDS
        if tag in UNSEEN or tree.hidden[i]:
            gone = True
        elif tag == "header" or words == {"header"} or "role:banner" in own:
            # the header of the page, not the one of its article
            gone = not (inside[p] or inside[i])
        elif tag in ("html", "body", "main"):
            gone = False
        else:
            gone = not holds[i] and (tag in PARTS or bool(words) or any(n[5:] in ROLES for n in own if n.startswith("role:")))
        out[i] = out[p] or gone
    return out


class Densities:
    """Composite text density of every node: characters per tag, scaled by how few of both are links."""

    def __init__(self, tree: Tree, out: list[bool]) -> None:
        many = len(tree.tag)
        self.chars, self.tags, self.linked, self.links = [0] * many, [0] * many, [0] * many, [0] * many
        seen, in_link = [False] * many, [False] * many
        for i in range(1, many):
            p = tree.parent[i]
            seen[i] = seen[p] or tree.tag[i] in UNSEEN
            in_link[i] = in_link[p] or tree.tag[i] == "a"
        for node, text, _ in tree.texts:
            if not seen[node]:
                size = len(" ".join(text.split()))
                self.chars[node] += size
                self.linked[node] += size if in_link[node] else 0
        for i in range(many - 1, 0, -1):
            p = tree.parent[i]
            if not seen[i]:
                self.chars[p] += self.chars[i]
                self.linked[p] += self.linked[i]
                self.tags[p] += self.tags[i] + 1
                self.links[p] += self.links[i] + (tree.tag[i] == "a")
        body = next((i for i, t in enumerate(tree.tag) if t == "body"), 0)
        self.body = body
        share = self.linked[body] / max(self.chars[body], 1)
        self.of = [self._density(i, share) for i in range(many)]
        self.sums = [0.0] * many
        for i in range(1, many):
            if not out[i]:
                self.sums[tree.parent[i]] += self.of[i]

    def _density(self, i: int, share: float) -> float:
        chars, tags, linked, links = self.chars[i], max(self.tags[i], 1), self.linked[i], self.links[i]
        if not chars:
            return 0.0
        plain = math.log(chars / max(linked, 1) * tags / max(links, 1))
        # on a page without links the base is 1 for every node: then the logarithms themselves compare
        base = math.log(math.log(chars / max(chars - linked, 1) * linked + share * chars + math.e))
        return chars / tags * (plain / base if base > 1e-9 else plain)


def chosen(tree: Tree, out: list[bool]) -> tuple[list[bool], Densities, float]:
    """Nodes of the article, the densities and the threshold.

    The maximum-sum node is sought among nodes that are not left out. Every node at or above the threshold marks the maximum-sum node below it. The
    lowest part that holds all marks is the article, or the element made to hold one in which the maximum-sum node stands. Where only the
    body holds all marks, the article is those of its parts that have one, and the headings among them.
    """
    density, many, parent = Densities(tree, out), len(tree.tag), tree.parent
    body, sums = density.body, density.sums
    top = list(range(many))  # the maximum-sum node of each subtree: of equals the outer, then the earlier one
    for i in range(many - 1, 0, -1):
        p = parent[i]
        if not out[i] and density.chars[i] and (sums[top[i]] > sums[top[p]] or top[p] != p and sums[top[i]] == sums[top[p]]):
            top[p] = top[i]
    best = top[body]
    path = [best]
    while path[-1] != body:
        path.append(parent[path[-1]])
    threshold = min(density.of[i] for i in path)
    below = [False] * many
    below[body] = True
    for i in range(body + 1, many):
        below[i] = below[parent[i]]
    marked = {top[i] for i in range(body, many) if below[i] and not out[i] and density.chars[i] and density.of[i] >= threshold} | {best}
    held = [int(i in marked) for i in range(many)]  # marks in each subtree
    for i in range(many - 1, 0, -1):
        held[parent[i]] += held[i]
    articles = [i for i in range(many) if tree.tag[i] == "article" and not out[i] and held[i]]
    outer = lambda fits: next((i for i in reversed(path[:-1]) if fits(i)), None)
    article, main = outer(lambda i: tree.tag[i] == "article"), outer(lambda i: tree.tag[i] == "main")
    if article is not None and any(not _within(tree, i, article) for i in articles):
        article = None  # several articles
    holder = outer(lambda i: tree.names[i] & HOLDER_WORDS and tree.tag[i] not in INLINE | HEADINGS)
    root = next((i for i in (article, main, holder) if i is not None), None)
    if root is None:
        root = next(i for i in path if held[i] == len(marked))
    kept = [False] * many
    if root != body:
        kept[root] = True
        path = root
        while path != body:  # headings that stand before the article
            up = parent[path]
            for k in range(up + 1, path):
                if parent[k] == up and _heading(tree, density, k, path):
                    kept[k] = True
            path = up
    else:
        parts = [k for k in range(body + 1, many) if parent[k] == body]
        for k in parts:
            kept[k] = bool(held[k]) or tree.tag[k] in HEADINGS
        kept[body] = best == body
    for i in range(body + 1, many):
        kept[i] = kept[i] or kept[parent[i]]
    return kept, density, threshold


def _within(tree: Tree, node: int, outer: int) -> bool:
    while node > outer:
        node = tree.parent[node]
    return node == outer


def _heading(tree: Tree, density: Densities, node: int, before: int) -> bool:
    """Whether a part that ends before ``before`` is a heading and nothing else."""
    if density.links[node] or not density.chars[node]:
        return False
    if tree.tag[node] in HEADINGS:
        return True
    inner = [k for k in range(node + 1, before) if tree.parent[k] == node]
    return len(inner) == 1 and tree.tag[inner[0]] in HEADINGS and density.chars[inner[0]] == density.chars[node]


def main_text(html: str | None) -> str:
    """Blocks of the article in page order, joined by two line breaks; white space inside a block is one space."""
    if not html:
        return ""
    tree = Tree(html)
    out = left_out(tree)
    kept, density, threshold = chosen(tree, out)
    for i in range(1, len(kept)):
        if kept[i] and not out[i] and density.links[i] >= MENU_LINKS and density.of[i] < threshold and density.linked[i] >= MENU_SHARE * density.chars[i]:
            out[i] = True
        out[i] = out[i] or out[tree.parent[i]]
    # the innermost block of every node
    block = [0] * len(kept)
    for i in range(1, len(kept)):
        block[i] = i if tree.tag[i] not in INLINE else block[tree.parent[i]]
    blocks: list[list[str]] = []
    last, node = -1, 1
    for place, text, seen in tree.texts:
        if not kept[place] or out[place]:
            continue
        # a line break is white space; a block between two texts ends theirs, unless it cannot be seen
        for i in range(node, seen):
            if tree.tag[i] == "br" and blocks:
                blocks[-1].append(" ")
            elif tree.tag[i] not in INLINE | UNSEEN:
                last = -1
        node = max(node, seen)
        if block[place] != last:
            blocks.append([])
            last = block[place]
        blocks[-1].append(text)
    joined = (" ".join("".join(parts).split()) for parts in blocks)
    return "\n\n".join(b for b in joined if b)


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every page.

    Whole pages are parsed, however long, in memory that follows the page. A null or empty page, and one without text, has an empty text. Character references
    are decoded, unclosed and stray tags are taken as browsers do. Repeated rows stay, an empty table gives an empty one; other columns are not read. Rows never
    leave their task.
    """
    from pyspark.sql import functions as F

    kind = lambda c: pages.schema[c].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             [key, url, "text", "n_chars"])

    return pages.select(F.col(key), F.col(url), F.col(html).alias("_html")).mapInArrow(released(run), f"{key} {kind(key)}, {url} {kind(url)}, text string, n_chars long")
