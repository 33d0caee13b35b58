"""HTML extraction by a tree-structured graphical model.

The nodes of a page's DOM (elements and texts) are binary variables, content
or not. Every child has a potential with its parent: how likely it is content,
given whether its parent is, by its tag. Nodes also have potentials of their own,
from words of class, id and role, and for texts from size, punctuation and links.
One pass up the tree and one down (sum-product) give each text's marginal; texts
whose marginal is over a half make up the main text, in page order.

Training counts labelled pages: those with an ``article`` or ``main`` element,
whose subtree is labelled content but for what names itself something else. At
most ``MAX_PAGES`` of them are used (those of the smallest hash of their key; a
documented bound). The counts of a tag on such pages tell how often it begins
content there: nearly always for ``article``. A box beside an article begins none
unless counts say so, however long its text. Pages without such an element are
judged by what their boxes hold. Counts are taken given the parent's label, so what menus
are made of (lists, links, short texts) speaks against a list that stands by itself
and not against one inside content: there a child is content unless it is
named otherwise, whatever its text, and a text is always what its element is.

What the task excludes by name is a kind of its own (``OUT`` by tag and
``FURNITURE`` by name: never content; ``DOUBTFUL`` names: only inside content, with
much running text). Such elements say nothing about their parent. A ``header``
inside an article is the article's. An article inside furniture (a reader's
comment) begins no content. A word of these lists that is part of a longer name
("related-work", "with-sidebar") counts ``CAP`` against it unless training counts
otherwise; a heading's names tell its subject, not its role. Ratios of a feature
are limited to ``CAP`` (a text's to ``TEXT_CAP``), and what all texts below an
element say together to ``BELOW``.

Blocks: block elements part texts, inline elements do not, ``br`` is white
space. Character references are decoded; white space becomes one space; blocks
are joined by one space. Whole pages are read.

Defined results: a null, empty or blank page, or one without content, gives an
empty text; malformed markup is read leniently (open elements end with their
parent, a lone ``<`` is text, an unfinished comment, script or style runs to the
end); without labelled pages the fixed words and default potentials decide, and
texts say nothing.
Repeated rows are read once per row. Other columns than the named are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsense.llm.tables import map_rows

MAX_PAGES = 2000
CAP, TEXT_CAP, LIKELY = 2.5, 1.0, 6.0
BELOW = (-5.0, 20.0)  # log odds that all below an element may add to its own
# Chance to be content in what is not and in content, by the child's kind, where
# nothing is counted; and the bounds of what counts may make of it.
START = {"main": (0.999, 1 - 1e-9), "box": (0.02, 1 - 1e-9), "element": (1e-9, 1 - 1e-9),
         "beside": (1e-12, 1 - 1e-9),  # boxes and other elements of a page that has an article or main
         "text": (1e-9, 1 - 5e-4),
         "doubtful": (1e-12, 1e-4), "furniture": (1e-12, 1e-9)}
LEAST, MOST = 1e-12, 1 - 1e-9

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
    option p pre search section select summary table tbody td tfoot th thead tr ul""".split())
ENDS_P = BLOCK - frozenset("html head body li dd dt td th tr tbody thead tfoot option legend summary figcaption".split())
# An opening tag ends an open element of these, unless one of the others stands between.
SAME_LEVEL = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
              "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
              "option": ({"option"}, {"select"})}
# Tags, and words of class, id or role, that tell content from the rest.
OUT = frozenset("""nav aside footer header form script style noscript template iframe button select
    input textarea title head menu dialog svg canvas object""".split())
FURNITURE = frozenset("""ad ads advert adverts advertisement sidebar comment comments reply replies response
    responses disqus complementary""".split())
DOUBTFUL = frozenset("""nav aside footer menu dialog sponsored promo cookie cookies consent notice notices banner alert
    popup modal breadcrumb breadcrumbs navigation navbar topbar related recommended share sharing social newsletter
    subscribe login signup search pagination toolbar widget copyright contentinfo""".split())
CONTENT = frozenset("content entry story articlebody post".split())
MAIN = frozenset(["article", "main"])
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
BOX = MAIN | frozenset("#root html body div section center table tbody tr td".split())

_TOKEN = re.compile(r"""<!--(?P<comment>.*?)(?:--!?>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"""
                    r"""(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z/][^<>]*(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-zA-Z]+")


class Page:
    """The nodes of a page, parents before children."""

    def __init__(self, html: str):
        self.parent, self.tag, self.words, self.text = [-1], ["#root"], [()], [None]
        self.gap = [True]  # white space stands before the node
        stack, at, gap = [0], 0, True

        def add(tag, words, text):
            nonlocal gap
            self.parent.append(stack[-1])
            self.tag.append(tag)
            self.words.append(words)
            self.text.append(text)
            self.gap.append(gap)
            gap = False
            return len(self.tag) - 1

        def close(names, stop=frozenset()):
            """End the innermost open element of ``names``, if none of
            ``stop`` is nearer."""
            for k in range(len(stack) - 1, 0, -1):
                name = self.tag[stack[k]]
                if name in names:
                    del stack[k:]
                    return
                if name in stop:
                    return

        while at < len(html):
            m = _TOKEN.search(html, at)
            text = html[at:m.start() if m else len(html)]
            if text:
                add("#text", (), unescape(text))
            if not m:
                break
            at = m.end()
            if not m["tag"]:
                continue
            tag = m["tag"].lower()
            block = tag in BLOCK
            if block or tag == "br":
                gap = True
            if m["end"]:
                if tag == "p" or block:
                    close({tag})
                else:
                    close({tag}, BLOCK)
                continue
            if tag in ENDS_P:
                close({"p"}, {"td", "th", "li", "div", "article", "section", "button", "body", "main", "aside", "form"})
            if tag in SAME_LEVEL:
                close(*SAME_LEVEL[tag])
            words = ()
            if m["attrs"]:
                words = tuple(w.lower() for g in _NAMES.findall(m["attrs"]) for w in "".join(g).split())
            node = add(tag, words, None)
            if block:
                gap = True
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}[\s/>]|\Z", re.I).search(html, at)
                if end.start() > at:
                    stack.append(node)
                    add("#raw", (), html[at:end.start()])
                    stack.pop()
                at = end.start()
                if at < len(html):
                    close_at = html.find(">", at)
                    at = len(html) if close_at < 0 else close_at + 1
            elif tag not in VOID and not m["attrs"].endswith("/"):
                stack.append(node)

        self._place()

    def _place(self) -> None:
        """Names of elements, their kinds, and what each node is counted as."""
        self.named = [[f for w in ws for f in _named(w, t)] for ws, t in zip(self.words, self.tag)]
        self.kind, self.key = [], []
        within, out = [], []  # an article or main, furniture is around the node or it
        for k, tag in enumerate(self.tag):
            p = self.parent[k]
            around, aside = (within[p], out[p]) if p >= 0 else (False, False)
            names = {f[4:] for f in self.named[k] if f.startswith("not:")}
            if tag == "#text":
                kind = "text"
            elif names & FURNITURE or tag == "#raw" or tag in OUT and not (tag == "header" and around):
                kind = "furniture"
            elif names:
                kind = "doubtful"
            elif tag in MAIN:
                kind = "element" if aside else "main"
            else:
                kind = "box" if tag in BOX else "element"
            self.kind.append(kind)
            within.append(around or kind == "main")
            out.append(aside or kind == "furniture" and tag not in ("form", "header"))
        mark = "@" if "main" in self.kind else ""
        if mark:
            self.kind = ["beside" if kind in ("box", "element") else kind for kind in self.kind]
        for tag, kind in zip(self.tag, self.kind):
            self.key.append(tag if kind == "text" else f"{tag}{mark}{'!' if tag in MAIN and kind != 'main' else ''}")

    def features(self) -> list[list[str]]:
        """Names of the features of each node."""
        out = []
        linked = [False] * len(self.tag)
        for k, tag in enumerate(self.tag):
            p = self.parent[k]
            linked[k] = tag == "a" or (p >= 0 and linked[p])
            if tag == "#text":
                text = self.text[k]
                n = len(text.split())
                ends = sum(text.count(c) for c in ".,;:!?")
                out.append([f"size:{min(n.bit_length(), 6)}", f"marks:{min(4, 8 * ends // max(n, 1))}",
                            f"linked:{linked[k]}"] if n else [])
            else:
                out.append([f for f in self.named[k] if not f.startswith("not:")])
        return out

    def labels(self) -> list[bool] | None:
        """Labels by the page's own structure; None without such structure."""
        if "main" not in self.kind:
            return None
        out = []
        for k, kind in enumerate(self.kind):
            p = self.parent[k]
            out.append((p >= 0 and out[p] or kind == "main") and kind not in ("furniture", "doubtful"))
        return out


def _named(name: str, tag: str) -> list[str]:
    """Features of a name of class, id or role: what it is (``not``: made up of
    words against content), or its words (``part``: one of several, and some of
    them are such words)."""
    parts = _WORD.findall(name)
    against = [w for w in parts if w in FURNITURE or w in DOUBTFUL]
    if tag in HEADING:
        return [f"heading:{w}" for w in parts]
    if against and len(against) == len(parts):
        return [f"not:{max(against, key=lambda w: (w in FURNITURE, w))}"]
    if tag in MAIN:  # an article's names count whole: "post-42" is no post
        return [f"word:{name}"]
    return [f"{'part' if against else 'word'}:{w}" for w in parts]


class Model:
    """Potentials: of features, and of parent and child by the child's tag."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        """``counts``: by feature, or ``pair:key:parent``, how often the node
        is not content, and how often it is."""
        total = [sum(c[y] for f, c in counts.items() if not f.startswith("pair:")) + 1 for y in (0, 1)]
        self.ratio = {f"part:{w}": -CAP for w in FURNITURE | DOUBTFUL} | {f"word:{w}": LIKELY for w in CONTENT}
        self.counts = {}
        for f, (no, yes) in counts.items():
            if f.startswith("pair:"):
                self.counts.setdefault(f[5:-2], [(0, 0), (0, 0)])[int(f[-1])] = (no, yes)
            elif f not in self.ratio or f.startswith("part:"):
                r = math.log((yes + 1) / total[1]) - math.log((no + 1) / total[0])
                cap = TEXT_CAP if f.startswith(("size:", "marks:", "linked:")) else CAP
                self.ratio[f] = max(-cap, min(cap, r))
        self.known: dict[tuple[str, str], tuple[float, float]] = {}

    def _chances(self, key: str, kind: str) -> tuple[float, float]:
        """Of a child: its chance to be content, by its parent's label."""
        usual = START[kind]
        if kind in ("furniture", "doubtful") or key not in self.counts:
            return usual
        return tuple(max(LEAST, min(MOST, (yes + u) / (no + yes + 1))) for (no, yes), u in zip(self.counts[key], usual))

    def pairs(self, page: Page) -> list[tuple[float, float]]:
        out = []
        for k in zip(page.key, page.kind):
            if k not in self.known:
                self.known[k] = self._chances(*k)
            out.append(self.known[k])
        return out

    def marginals(self, page: Page) -> list[float]:
        """Log odds that each node is content."""
        exp, log, get = math.exp, math.log, self.ratio.get
        parent, (least, most) = page.parent, BELOW
        own = [sum(get(f, 0.0) for f in fs) for fs in page.features()]
        kinds = self.pairs(page)
        belief, sent = [0.0] * len(own), [0.0] * len(own)
        for k in range(len(own) - 1, 0, -1):  # messages to the parents
            belief[k] = own[k] + max(least, min(most, belief[k]))
            c0, c1 = kinds[k]
            e = exp(belief[k])
            sent[k] = log((c1 * e + 1 - c1) / (c0 * e + 1 - c0))
            belief[parent[k]] += sent[k]
        # A whole page is hardly all content, and not where it has an article.
        belief[0] = own[0] + max(least, min(most, belief[0])) - (2 * most if "main" in page.kind else LIKELY)
        for k in range(1, len(own)):  # messages to the children
            c0, c1 = kinds[k]
            e = exp(max(-60.0, min(60.0, belief[parent[k]] - sent[k])))
            belief[k] += log((c1 * e + c0) / ((1 - c1) * e + 1 - c0))
        return belief

    def text(self, html: str | None) -> str:
        if not html:
            return ""
        page = Page(html)
        belief = self.marginals(page)
        parts, gap = [], False
        for k, t in enumerate(page.text):
            gap = gap or page.gap[k]
            if page.tag[k] == "#text" and belief[k] > 0:
                parts.append(" " + t if gap else t)
                gap = False
        return " ".join("".join(parts).split())


def count(htmls) -> Counter:
    """(feature or ``pair:key:parent``, label): how often, on labelled pages."""
    n: Counter = Counter()
    for h in htmls:
        page = Page(h or "")
        labels = page.labels()
        if labels is None:
            continue
        for k, fs in enumerate(page.features()):
            y = int(labels[k])
            n.update((f, y) for f in fs)
            if k and page.kind[k] not in ("furniture", "doubtful"):
                n[f"pair:{page.key[k]}:{int(labels[page.parent[k]])}", y] += 1
    return n


def train(pages: DataFrame, *, html: str = "html", key: str = "page_id", max_pages: int = MAX_PAGES) -> Model:
    chosen = pages.where(F.col(key).isNotNull() & F.col(html).rlike("(?i)<(article|main)[ >]")) \
        .select(F.col(key).alias("k")).distinct().orderBy(F.xxhash64("k"), "k").limit(max_pages)
    rows = pages.select(F.col(key).alias("k"), F.col(html).alias("h")).join(F.broadcast(chosen), "k", "left_semi") \
        .dropDuplicates(["k"])

    def run(batches):
        for b in batches:
            yield pd.DataFrame([(f, y, c) for (f, y), c in count(b["h"]).items()], columns=["f", "y", "n"])

    counts: dict[str, list[int]] = {}
    for r in rows.select("h").mapInPandas(run, "f string, y int, n long").groupBy("f", "y").agg(F.sum("n").alias("n")).collect():
        counts.setdefault(r["f"], [0, 0])[r["y"]] = r["n"]
    return Model({f: tuple(c) for f, c in counts.items()})


def extract(pages: DataFrame, model: Model, *, html: str = "html", carry=("page_id", "url")) -> DataFrame:
    """``carry`` columns, ``text`` and ``n_chars`` of every row."""
    def make():
        def run(rows):
            texts = [model.text(h) for h in rows]
            return texts, [len(t) for t in texts]
        return run

    return map_rows(pages, [F.col(html)], list(carry), make, {"text": "string", "n_chars": "long"})
