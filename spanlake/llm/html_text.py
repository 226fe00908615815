"""Operator 9: main text of web pages by gradient-boosted trees over DOM nodes.

A page is read into a tree of block elements whose leaves are runs of text.
Boosted regression trees (logistic loss, trained here) score every node for
"holds main text" from its tag, the words of its class, id and role, those of
its ancestors, subtree text and link density, depth and sibling statistics.
Decoding is hierarchical: the best labelling in which a node may hold main text
only if its parent does is found by dynamic programming over the tree, so a
leaf never contradicts the blocks around it. The text of the chosen leaves is
the result.

There are no labelled pages, so training pages are made from a bounded sample of
the table's own: their text is dressed in many layouts (semantic or plain tags,
nested wrappers, menus, headers, sidebars, notices, adverts, forms, comments,
related links, footers) whose labels are known by construction, and the pages
themselves take part with what stands in their <article> or <main> as main text.
"""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm.common import pick, read_table
from spanlake.llm.tokens import text_slices

TRAIN_PAGES = 200          # pages sampled for training
TRAIN_CHARS = 100_000      # of a longer page training sees this much (every page is extracted whole)
SCORE_ROWS = 1 << 16       # nodes scored at a time
LAYOUTS = 5                # dressed pages per sampled page
TREES, TREE_DEPTH, BINS, RATE = 80, 4, 32, 0.2

# HTML's block, void and raw-text elements.
BLOCKS = frozenset("""html head body title article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd nav header footer aside
 form fieldset table caption thead tbody tfoot tr td th blockquote pre figure figcaption address details summary center hr
 menu hgroup dialog search button select option label legend noscript template iframe object svg canvas video audio""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea xmp".split())
UNSEEN = frozenset("head title noscript template iframe object svg canvas video audio select button option".split())
CLOSES_P = BLOCKS - frozenset("button select option label noscript template iframe object svg canvas video audio".split())
SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
                "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th")}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "tbody": ("table",),
          "option": ("select",)}

# Words of class, id and role, by what they hint at.
HINTS = {
    "content": "article content post entry story main text body prose copy single blog page",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pager pagination tabs toc skip links topnav sitemap",
    "header": "header masthead banner topbar logo brand hero head toolbar",
    "footer": "footer foot copyright colophon legal bottom contentinfo",
    "side": "sidebar side aside widget widgets rail column complementary related recommended recommendations more popular trending teaser",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion adsense dfp commercial",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup paywall message dialog banner",
    "comment": "comment comments reply replies respond discussion disqus thread responses reader feedback review",
    "form": "form search login input signin register contact poll survey",
    "share": "share social sharing follow tweet facebook byline meta tags author date tools print",
    "hidden": "hidden invisible screenreader sr offscreen",
}
HINT_OF = {}
for _k, (_name, _words) in enumerate(HINTS.items()):
    for _w in _words.split():
        HINT_OF.setdefault(_w, []).append(_k)
TAGS = ["article", "main", "section", "div", "p", "h1", "h", "list", "li", "nav", "header", "footer", "aside", "form", "table", "quote", "figure",
        "body", "text", "other"]
TAG_OF = {t: i for i, t in enumerate(TAGS)} | {f"h{k}": TAGS.index("h") for k in range(2, 7)} | {
    t: TAGS.index("list") for t in ("ul", "ol", "dl", "menu")} | {t: TAGS.index("li") for t in ("dt", "dd")} | {
    t: TAGS.index("form") for t in ("fieldset", "label", "legend", "search")} | {
    t: TAGS.index("table") for t in ("tr", "td", "th", "tbody", "thead", "tfoot", "caption")} | {
    t: TAGS.index("quote") for t in ("blockquote", "pre")} | {"figcaption": TAGS.index("figure"), "html": TAGS.index("body")}
N_HINTS, N_TAGS = len(HINTS), len(TAGS)
N_FEATURES = N_TAGS + 2 * N_HINTS + N_TAGS + 19

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page:
    """Block tree of a page, in document order: parent, tag, attributes, and
    for leaves (tag "text") the text and its share inside links."""

    def __init__(self, source: str):
        self.parent, self.tag, self.attrs = [-1], ["body"], [{}]
        self.text: dict[int, str] = {}
        self.link: dict[int, int] = {}
        stack, run, links, in_link = [0], [], 0, False
        places: dict[str, list[int]] = {}        # of a tag: its places in the stack
        unseen = 0                               # open tags of UNSEEN

        def flush():
            nonlocal run, links
            if run:
                text = " ".join("".join(run).split())
                if text and not unseen:
                    self.parent.append(stack[-1])
                    self.tag.append("text")
                    self.attrs.append({})
                    self.text[len(self.tag) - 1] = text
                    self.link[len(self.tag) - 1] = min(links, len(text))
                run, links = [], 0

        def last(names):
            return max((places[t][-1] for t in names if places.get(t)), default=0)

        def pop_to(names, scope=()):
            nonlocal unseen
            i = last(names)
            if i and i > last(scope):
                while len(stack) > i:
                    tag = self.tag[stack.pop()]
                    places[tag].pop()
                    unseen -= tag in UNSEEN

        at, lower = 0, None
        while at < len(source):
            m = TOKEN.search(source, at)
            piece = source[at:m.start() if m else len(source)]
            if piece:
                piece = html.unescape(piece)
                run.append(piece)
                links += len(piece.strip()) if in_link else 0
            if not m:
                break
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<![CDATA["):
                    run.append(m[0][9:].removesuffix("]]>"))
                continue
            name, closing = m[2].lower(), bool(m[1])
            if name in RAW and not closing:
                lower = lower if lower is not None else source.lower()
                end = lower.find(f"</{name}", at)
                at = len(source) if end < 0 else end
                continue
            if name == "br":
                run.append(" ")
            elif name == "a":
                in_link = not closing
            elif name in BLOCKS and name != "html":
                flush()
                in_link = False
                if closing:
                    pop_to((name,))
                    continue
                if name in CLOSES_P:
                    pop_to(("p",), ("td", "th", "button", "object", "table"))
                if name in SELF_CLOSING:
                    pop_to(SELF_CLOSING[name], SCOPES[name])
                if re.fullmatch("h[1-6]", name):
                    pop_to(("h1", "h2", "h3", "h4", "h5", "h6"), BLOCKS - {"h1", "h2", "h3", "h4", "h5", "h6"})
                if name == "body":
                    continue
                self.parent.append(stack[-1])
                self.tag.append(name)
                self.attrs.append({k.lower(): a or b or c for k, a, b, c in ATTR.findall(m[3])})
                if name not in VOID and not (m[3].endswith("/") and name in ("svg", "iframe")):
                    places.setdefault(name, []).append(len(stack))
                    stack.append(len(self.tag) - 1)
                    unseen += name in UNSEEN
        flush()

    def features(self) -> np.ndarray:
        return np.concatenate(list(self.feature_blocks(len(self.tag))))

    def feature_blocks(self, rows: int):
        """The features of `rows` nodes at a time, in document order."""
        n = len(self.tag)
        parent = np.array(self.parent)
        kind = np.zeros(n, np.int64)
        depth, chars, link, leaves, words, stops, kids, tags = (np.zeros(n) for _ in range(8))
        own_hint = np.zeros((n, N_HINTS), bool)
        index, same, in_p = np.zeros(n), np.zeros(n), np.zeros(n)
        seen: dict[tuple[int, str], int] = {}
        above = np.zeros((n, N_HINTS), bool)
        above_tag = np.zeros((n, N_TAGS), bool)
        for i in range(n):
            kind[i] = TAG_OF.get(self.tag[i], N_TAGS - 1)
            a = self.attrs[i]
            if a:
                for w in WORDS.findall(" ".join(filter(None, (a.get("class"), a.get("id"), a.get("role"))))):
                    for k in HINT_OF.get(w.lower(), ()):
                        own_hint[i, k] = 1
                if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in (a.get("style") or "").replace(" ", ""):
                    own_hint[i, N_HINTS - 1] = 1
            p = parent[i]
            if p >= 0:
                depth[i] = depth[p] + 1
                index[i] = kids[p]
                kids[p] += 1
                same[i] = seen.get((p, self.tag[i]), 0)
                seen[(p, self.tag[i])] = same[i] + 1
                np.logical_or(above[p], own_hint[p], out=above[i])
                above_tag[i] = above_tag[p]
                above_tag[i, kind[p]] = 1
            if self.tag[i] == "text":
                s = self.text[i]
                chars[i], link[i], leaves[i], words[i] = len(s), self.link[i], 1, s.count(" ") + 1
                stops[i] = s.count(".") + s.count(",") + s.count("!") + s.count("?")
                in_p[i] = len(s) if self.tag[p] == "p" else 0
            tags[i] = 1
        before = np.cumsum(chars) - chars
        for i in range(n - 1, 0, -1):
            p = parent[i]
            for v in (chars, link, leaves, words, stops, tags, in_p):
                v[p] += v[i]
        total = max(chars[0], 1)
        up = np.where(parent < 0, 0, parent)
        c = np.maximum(chars, 1)
        numbers = [np.log1p(chars), link / c, chars / np.maximum(tags, 1), chars / np.maximum(leaves, 1), stops / np.maximum(words, 1),
                   c / np.maximum(words, 1), depth, index, kids[up], same, before / total, chars / total, chars / np.maximum(chars[up], 1),
                   in_p / c, np.log1p(chars[up]), (link / c)[up], (in_p / c)[up], np.log1p(chars[up[up]]), (in_p / c)[up[up]]]
        for a in range(0, n, rows):
            b = min(a + rows, n)
            yield np.concatenate([np.eye(N_TAGS, dtype=np.float32)[kind[a:b]], own_hint[a:b], above[a:b], above_tag[a:b],
                                  np.stack([v[a:b] for v in numbers], 1)], 1, dtype=np.float32, casting="unsafe")

    def labels(self) -> np.ndarray:
        """1 for nodes that hold a leaf marked as main text (training pages)."""
        y = np.zeros(len(self.tag), np.int8)
        marked = [False] * len(self.tag)         # by the nearest mark above
        for i, a in enumerate(self.attrs):
            marked[i] = a["data-y"] == "1" if "data-y" in a else i > 0 and marked[self.parent[i]]
            y[i] = marked[i] and i in self.text
        for i in range(len(y) - 1, 0, -1):
            y[self.parent[i]] |= y[i]
        return y

    def smoothed(self, score: np.ndarray) -> np.ndarray:
        """Half a node's score, half the mean (by text length) of its plain
        siblings of the same tag; a leaf alone in a plain block counts with it."""
        groups: dict[tuple, list[int]] = {}
        for i in range(1, len(self.tag)):
            p = self.parent[i]
            if self.tag[i] == "text":
                if not self.attrs[p]:
                    groups.setdefault((self.parent[p], self.tag[p], "text"), []).append(i)
            elif not self.attrs[i]:
                groups.setdefault((p, self.tag[i]), []).append(i)
        size = np.zeros(len(self.tag))
        for i, t in self.text.items():
            size[i] += len(t)
            size[self.parent[i]] += len(t)
        out = score.astype(float).copy()
        for rows in groups.values():
            if len(rows) > 1:
                out[rows] = 0.5 * score[rows] + 0.5 * np.average(score[rows], weights=size[rows] + 1)
        return out

    def decode(self, score: np.ndarray) -> str:
        """The leaves of the best labelling in which a node is chosen only
        together with its parent, one line each."""
        n = len(self.tag)
        gain = self.smoothed(score)
        for i in range(n - 1, 0, -1):
            if gain[i] > 0:
                gain[self.parent[i]] += gain[i]
        chosen = np.zeros(n, bool)
        chosen[0] = True
        for i in range(1, n):
            chosen[i] = chosen[self.parent[i]] and gain[i] > 0
        return "\n".join(self.text[i] for i in sorted(self.text) if chosen[i])


# ---- boosted trees ----

class Boosted:
    """Gradient-boosted complete trees on binned features (logistic loss)."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        steps = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, f], steps)) if len(x) else np.zeros(0) for f in range(x.shape[1])]
        b = self.bins(x)
        n, m = b.shape
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))) if n else -1.0
        score = np.full(n, self.base)
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        cell = b + np.arange(m)[None, :] * BINS
        for _ in range(TREES if n else 0):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            feature, cut = np.zeros(2**TREE_DEPTH - 1, np.int64), np.full(2**TREE_DEPTH - 1, BINS, np.int64)
            node = np.zeros(n, np.int64)
            for level in range(TREE_DEPTH):
                first = 2**level - 1
                for k in range(first, 2 * first + 1):
                    rows = np.flatnonzero(node == k)
                    if len(rows) < 20:
                        continue
                    flat = cell[rows].ravel()
                    gs = np.bincount(flat, np.repeat(g[rows], m), m * BINS).reshape(m, BINS).cumsum(1)
                    hs = np.bincount(flat, np.repeat(h[rows], m), m * BINS).reshape(m, BINS).cumsum(1)
                    gt, ht = gs[0, -1], hs[0, -1]
                    gain = gs**2 / (hs + 1) + (gt - gs)**2 / (ht - hs + 1) - gt**2 / (ht + 1)
                    gain[(hs < 1) | (ht - hs < 1)] = 0
                    best = int(gain.argmax())
                    if gain.flat[best] > 1e-6:
                        feature[k], cut[k] = divmod(best, BINS)
                node = 2 * node + 1 + (b[np.arange(n), feature[node]] > cut[node])
            leaf = node - (2**TREE_DEPTH - 1)
            value = RATE * np.bincount(leaf, g, 2**TREE_DEPTH) / (np.bincount(leaf, h, 2**TREE_DEPTH) + 1)
            self.trees.append((feature, cut, value))
            score += value[leaf]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(self.edges)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        b, rows = self.bins(x), np.arange(len(x))
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(TREE_DEPTH):
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            out += value[node - (2**TREE_DEPTH - 1)]
        return out


def score_pages(model: Boosted, pages: list[Page]) -> np.ndarray:
    """Scores of all nodes; about SCORE_ROWS of them have features at a time."""
    out, held, n = [], [], 0
    for page in pages:
        for x in page.feature_blocks(SCORE_ROWS):
            held.append(x)
            n += len(x)
            if n >= SCORE_ROWS:
                out.append(model.score(np.concatenate(held)))
                held, n = [], 0
    if held:
        out.append(model.score(np.concatenate(held)))
    return np.concatenate(out)


# ---- training pages ----

def _dress(rng: random.Random, title: str, body: list[str], other: list[str]) -> str:
    """A page in a random layout; data-y marks main text (1) and the rest (0)."""
    def say(most=12):
        words = rng.choice(other).split()
        at = rng.randrange(max(1, len(words) - most + 1))
        return html.escape(" ".join(words[at:at + rng.randint(1, most)]) or "more")

    def named(tags, hint):
        words = HINTS[hint].split()
        tag = rng.choice(tags)
        how = rng.random()
        if tag in ("div", "section", "ul", "p") or how < 0.4:
            name = rng.choice(words) + rng.choice(["", "", "-list", "-box", "_area", "Wrap", " clearfix", f"-{rng.randint(1, 9)}"])
            return tag, f' {rng.choice(["class", "id"])}="{name}"'
        return tag, ""

    def links(k):
        return "<ul>" + "".join(f'<li><a href="/x">{say(3)}</a></li>' for _ in range(k)) + "</ul>"

    def block(tags, hint, inner):
        tag, attrs = named(tags, hint)
        return f'<{tag}{attrs} data-y="0">{inner}</{tag}>'

    def paras(k, most=40):
        return "".join(rng.choice(["<p>%s</p>", "<div>%s</div>", "<p>%s<br>", "%s "]) % say(most) for _ in range(k))

    parts = {
        "menu": lambda: block(["nav", "div", "ul"], "menu", links(rng.randint(2, 8))),
        "header": lambda: block(["header", "div"], "header", rng.choice(["<h1>%s</h1>", "<h2>%s</h2>", "<p>%s</p>"]) % say(5) + (links(3) if rng.random() < .5 else "")),
        "footer": lambda: block(["footer", "div"], "footer", f"&copy; {say(5)}. {say(20)}" if rng.random() < .6 else paras(2) + links(3)),
        "side": lambda: block(["aside", "div", "section"], "side", f"<h3>{say(3)}</h3>" + rng.choice([links(rng.randint(2, 6)), paras(rng.randint(1, 4))])),
        "advert": lambda: block(["div", "aside", "section"], "advert", rng.choice([say(15), paras(1, 25), f'<a href="/b">{say(10)}</a>'])),
        "notice": lambda: block(["div", "section", "p"], "notice", rng.choice([say(25), f"{say(25)} <button>{say(2)}</button>"])),
        "comment": lambda: block(["section", "div", "ul"], "comment", f"<h3>{say(3)}</h3>" + "".join(
            rng.choice(["<div class='comment'><p>%s</p></div>", "<li><b>%s</b></li>", "<article class='comment'><p>%s</p></article>", "<p>%s</p>"]) % say(60)
            for _ in range(rng.randint(1, 6)))),
        "form": lambda: block(["form", "div"], "form", f"<label>{say(3)}</label><input name=q><button>{say(1)}</button> {say(4)}"),
        "share": lambda: block(["div", "ul", "p"], "share", rng.choice([links(3), say(6)])),
    }

    def some(names, p):
        return "".join(parts[k]() for k in names if rng.random() < p)

    inner = []
    if rng.random() < .8:
        inner.append(f'<{(h := rng.choice(["h1", "h1", "h2"]))} data-y="1">{html.escape(title)}</{h}>')
    for text in body:
        kind = rng.random()
        text = html.escape(text)
        if kind < .75:
            inner.append(f'<p data-y="1">{text}' + rng.choice(["</p>", "</p>", "", "<br>"]))
        elif kind < .85:
            inner.append(f'<div data-y="1">{text}</div>')
        elif kind < .9:
            inner.append(f'<ul data-y="1"><li>{text}</li></ul>')
        elif kind < .95:
            inner.append(f'<blockquote data-y="1">{text}</blockquote>')
        else:
            inner.append(f'<h2 data-y="1">{text[:60]}</h2>')
        if rng.random() < .08:
            inner.append(some(["advert", "side", "share", "notice"], .4))
    inner.append(some(["share", "comment", "form", "side"], .2))
    tag, attrs = named(["article", "main", "div", "section", "article"], "content")
    page = f"<{tag}{attrs}>{''.join(inner)}</{tag}>"
    for _ in range(rng.randint(0, 3)):
        page = f"<div{rng.choice(['', ' class=wrap', ' id=container', ' class=row'])}>" + some(["side", "advert"], .15) + page + some(["side", "comment"], .15) + "</div>"
    return ("<html><head><title>t</title></head><body>" + some(["notice", "header", "menu", "advert", "form"], .5) + page
            + some(["comment", "side", "advert", "form", "notice", "menu", "footer"], .45) + "</body></html>")


def training_rows(pages: list[str], seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the sampled pages and their dressed forms."""
    rng, xs, ys, other = random.Random(seed), [], [], ["more about this"]
    parsed = [Page(p) for p in pages]
    for page in parsed:
        other += [t for t in list(page.text.values())[:40]]
    for page in parsed:
        marked = any(t in ("article", "main") for t in page.tag)
        if marked:
            for t, a in zip(page.tag, page.attrs):
                if t in ("article", "main"):
                    a["data-y"] = "1"
                elif t in ("nav", "footer", "aside", "header", "form"):
                    a["data-y"] = "0"
            y = page.labels()
            xs.append(page.features())
            ys.append(y)
        main = [page.text[i] for i in sorted(page.text) if not marked or y[i]]
        for _ in range(LAYOUTS):
            k = rng.randint(1, max(1, min(len(main), rng.choice((2, 12)))))
            at = rng.randrange(max(1, len(main) - k + 1)) if main else 0
            dressed = Page(_dress(rng, main[0][:80] if main else "title", main[at:at + k] or ["text"], other))
            xs.append(dressed.features())
            ys.append(dressed.labels())
    if not xs:
        return np.zeros((0, N_FEATURES), np.float32), np.zeros(0)
    return np.concatenate(xs), np.concatenate(ys).astype(float)


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", train_pages: int = TRAIN_PAGES) -> Boosted:
    """Fit on at most `train_pages` sampled pages, of long ones on the first
    TRAIN_CHARS characters. Where no page has html, there is nothing to fit and
    nothing to extract: such a model finds no text."""
    rows = pick(pages, page_id=id_col, html=html_col).where("html is not null").withColumn("html", F.substring("html", 1, TRAIN_CHARS))
    chosen = rows.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(train_pages)
    found = rows.join(F.broadcast(chosen), "page_id", "left_semi").groupBy("page_id").agg(F.min("html").alias("html")).orderBy("page_id").collect()
    return Boosted(*training_rows([r["html"] for r in found]))


def extract(pages: DataFrame, model: Boosted, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null or empty html gives an empty text; unclosed, stray and unknown tags
    are tolerated; a very long or deeply nested page takes time in proportion
    to its length, its nodes being scored in blocks; repeated rows and null ids are kept; an empty table gives an
    empty result; other columns are ignored."""
    rows = pick(pages, page_id=id_col, url=url_col, text=html_col).select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            for piece in text_slices(batch, "text", 1 << 20):
                parsed = [Page(s) for s in piece.column("text").to_pylist()]
                ends = np.cumsum([0, *(len(p.tag) for p in parsed)])
                score = score_pages(model, parsed)
                texts = [p.decode(score[a:b]) for p, a, b in zip(parsed, ends, ends[1:])]
                yield pa.RecordBatch.from_pydict({
                    "page_id": piece.column("page_id"), "url": piece.column("url"), "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return extract(pages, train(pages))
