"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of block elements with its runs of text as leaves. Every node is
content (C), boilerplate (B) or a mixed container (M; elements only). Potentials are
log-probabilities of a node's state given its parent's state, and of its features (tag,
tag under parent's tag and in the nearest section, tokens of class, id and role, shape of a text) given its state.
Sum-product messages pass once from the leaves up and once from the root down, which is
exact on a tree; runs of text whose marginal of C is over 1/2 are the main text.

The model is trained on LABELLED_PAGES pages of the labelled generator below, which
builds pages of varied layouts with a state for each element: a bounded, documented
sample, the same at every size of the input.

Each page is handled alone and whole. Character references are decoded, white space
within a run (Unicode white space and <br>) becomes one space, and runs are joined by
an empty line. Defined cases: a null or empty page has an empty text; a comment or raw text (RAW) that is
not closed ends with the page, but of an element of SUBTREES only the tag is dropped then;
"/>" closes svg; formulas are part of the text around them; nothing that may stand in a head has text, so its tags are passed
over and the first other thing is of the body, closed head or not; a page without
tags is one run of text; repeated rows are handled one by one; an empty table gives an
empty result.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import defaultdict
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import kept

LABELLED_PAGES = 600
C, B, M = range(3)
# Element names of the HTML standard.
RAW = "script style iframe textarea title".split()
SUBTREES = frozenset("noscript template svg annotation annotation-xml object canvas audio video select datalist".split())
FOREIGN = frozenset(["svg"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split()) | frozenset(
    "math menclose merror mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "p": {"p"}}
SECTIONS = frozenset("article main section nav aside header footer form".split())
SCOPE = frozenset("table ul ol dl body html article section div td th".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|(?P<tag><(?P<drop>" + "|".join(RAW) + r")(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>).*?(?:</(?P=drop)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|data-y)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Tree(NamedTuple):
    parents: list[int]
    features: list[tuple[str, ...]]
    texts: list[str | None]  # of leaves
    states: list[int]  # of labelled pages, else -1


_END_OF_FOREIGN = re.compile(r"</svg\s*>", re.I)


def _tokens(page: str) -> tuple[list[tuple[int, int, re.Match]], dict[int, int]]:
    """Start, end and match of each token; by the start of a closed element of SUBTREES, its end."""
    tokens, closed = [], {}
    opened: dict[str, list[int]] = defaultdict(list)
    foreign = spot = 0
    while m := _TOKEN.search(page, spot):
        start, spot = m.span()
        if m["drop"] is not None:
            # In svg, an element of RAW can be closed by "/>" and ends with it.
            if foreign > 0 and (m["tag"].endswith("/>") or _END_OF_FOREIGN.search(page, m.end("tag"), spot)):
                spot = m.end("tag")
        elif m["name"] is not None and (name := m["name"].lower()) in CLOSES_P:
            foreign = 0  # a block is no longer in it
        elif m["name"] is not None and name in SUBTREES:
            if m["close"]:
                if opened[name]:
                    closed[opened[name].pop()] = spot
                    foreign = max(0, foreign - (name in FOREIGN))
            elif name in FOREIGN and m["rest"].endswith("/"):
                closed[start] = spot
            else:
                opened[name].append(start)
                foreign += name in FOREIGN
        tokens.append((start, spot, m))
    return tokens, closed


def _shape(text: str, linked: int, tag: str, around: str) -> tuple[str, ...]:
    n = len(text)
    size = "s" if n < 25 else "m" if n < 80 else "l" if n < 250 else "x"
    link = "0" if not linked else "1" if 2 * linked < n else "2"
    end = "." if text[-1] in ".!?:;\"')]»”…" else "-"
    return (f"t:{size}{link}", f"e:{end}{size}", f"u:{tag}{link}", f"u:in {around}{link}", "copyright" if "©" in text else "plain")


def parse(page: str) -> Tree:
    tree = Tree([-1], [("root",)], [None], [M])
    stack: list[tuple[str, int, str]] = [("", 0, "")]  # block elements: name, node, nearest of SECTIONS
    standing: dict[str, int] = defaultdict(int)  # open elements by name: what is not open is not looked for
    run: list[str] = []
    links = linked = 0
    spot = 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                name, node, around = stack[-1]
                tree.parents.append(node)
                tree.features.append(_shape(text, linked, name, around))
                tree.texts.append(text)
                tree.states.append(tree.states[node] if tree.states[node] != M else -1)
            linked = 0

    def say(piece: str) -> None:
        nonlocal linked
        if piece:
            plain = html.unescape(piece) if "&" in piece else piece
            run.append(plain)
            if links > 0:
                linked += len(plain.strip())

    def pop_to(depth: int) -> None:
        flush()
        for name, *_ in stack[depth:]:
            standing[name] -= 1
        del stack[depth:]

    tokens, closed = _tokens(page)
    for start, end, m in tokens:
        if start < spot:
            continue
        say(page[spot:start])
        spot = end
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in SUBTREES:
            spot = closed.get(start, end)
            continue
        if name == "head":
            continue
        if name in INLINE:
            if name == "a":
                links = 0 if m["close"] else 1
            continue
        if name == "br" or name in VOID:
            run.append(" ")
            if name == "hr":
                flush()
            continue
        if m["close"]:
            if standing[name]:
                pop_to(next(depth for depth in range(len(stack) - 1, 0, -1) if stack[depth][0] == name))
            else:
                flush()
            links = 0
            continue
        flush()
        links = 0
        if name in CLOSES_P and standing["p"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    pop_to(depth)
                    break
                if stack[depth][0] in SCOPE:
                    break
        ends = SIBLING.get(name)
        if ends and name != "p":
            while len(stack) > 1 and stack[-1][0] in ends:
                pop_to(len(stack) - 1)
        above, node, around = stack[-1]
        own, state = [name, f"{name}<{above}", f"{name} in {around}"], -1
        rest = m["rest"]
        if rest and "=" in rest:
            for a in _ATTRIBUTE.finditer(rest):
                value = a[2] or a[3] or a[4] or ""
                if a[1].lower() == "data-y":
                    state = int(value) if value in ("0", "1", "2") else -1
                else:
                    own += [f"#{x.lower()}" for x in _PART.findall(value)]
        tree.parents.append(node)
        tree.features.append(tuple(dict.fromkeys(own)))
        tree.texts.append(None)
        tree.states.append(state)
        stack.append((name, len(tree.parents) - 1, name if name in SECTIONS else around))
        standing[name] += 1
    say(page[spot:])
    flush()
    return tree


class Model(NamedTuple):
    features: dict[str, tuple[float, float, float]]
    unseen: dict[bool, tuple[float, float, float]]
    down: dict[bool, tuple[tuple[float, float, float], ...]]  # by is-leaf: state of parent, of child


def train(pages: list[str]) -> Model:
    """Counts of the labelled pages, smoothed."""
    counts: dict[str, list[float]] = defaultdict(lambda: [0.0] * 3)
    totals = {leaf: [0.0] * 3 for leaf in (True, False)}
    pairs = {leaf: [[0.5] * 3 for _ in range(3)] for leaf in (True, False)}
    for page in pages:
        t = parse(page)
        for i in range(1, len(t.parents)):
            y, leaf = t.states[i], t.texts[i] is not None
            if y < 0:
                continue
            totals[leaf][y] += 1
            for f in t.features[i]:
                counts[f][y] += 1
            if t.states[t.parents[i]] >= 0:
                pairs[leaf][t.states[t.parents[i]]][y] += 1
    for p in range(3):
        pairs[True][p][M] = 0.0
    log = lambda x: math.log(x) if x > 0 else -1e9
    smooth = 0.3
    share = {}
    for f, c in counts.items():
        n = totals[f[:2] in ("t:", "e:", "u:") or f in ("copyright", "plain")]
        p = [(c[y] + smooth * (sum(c) + 1) / (sum(n) + 3)) / (n[y] + smooth) if n[y] else 1.0 for y in range(3)]
        share[f] = tuple(log(x) for x in p)
    down = {leaf: tuple(tuple(log(x / sum(row)) for x in row) for row in pairs[leaf]) for leaf in pairs}
    return Model(share, {True: (0.0, 0.0, 0.0), False: (0.0, 0.0, 0.0)}, down)


def marginals(t: Tree, model: Model) -> list[float]:
    """P(C) of each node, by sum-product."""
    n = len(t.parents)
    up = [(0.0, 0.0, 0.0)] * n
    exp, log = math.exp, math.log
    known = model.features
    local = []
    for i in range(n):
        c = b = m = 0.0
        for f in t.features[i]:
            x = known.get(f)
            if x is not None:
                c += x[0]
                b += x[1]
                m += x[2]
        if t.texts[i] is not None:
            m = -1e9
        local.append([c, b, m])
    local[0] = [-5.0, -5.0, 0.0]
    for i in range(n - 1, 0, -1):
        c, b, m = local[i]
        message = []
        for pc, pb, pm in model.down[t.texts[i] is not None]:
            x, y, z = pc + c, pb + b, pm + m
            top = x if x > y else y
            top = z if z > top else top
            message.append(top + log(exp(x - top) + exp(y - top) + exp(z - top)))
        up[i] = tuple(message)
        above = local[t.parents[i]]
        above[0] += message[0]
        above[1] += message[1]
        above[2] += message[2]
    belief = [[0.0, 0.0, 0.0] for _ in range(n)]
    out = [0.0] * n
    for i in range(n):
        c, b, m = local[i]
        if i:
            pc, pb, pm = belief[t.parents[i]]
            own = up[i]
            x, y, z = pc - own[0], pb - own[1], pm - own[2]
            rows = model.down[t.texts[i] is not None]
            mixed = []
            for s in range(3):
                p, q, r = x + rows[0][s], y + rows[1][s], z + rows[2][s]
                top = max(p, q, r)
                mixed.append(top + log(exp(p - top) + exp(q - top) + exp(r - top)))
            c, b, m = c + mixed[0], b + mixed[1], m + mixed[2]
        top = max(c, b, m)
        total = top + log(exp(c - top) + exp(b - top) + exp(m - top))
        belief[i] = [c - total, b - total, m - total]
        out[i] = exp(c - total)
    return out


def main_text(page: str | None, model: Model) -> str:
    if not page:
        return ""
    t = parse(page)
    p = marginals(t, model)
    return "\n\n".join(x for x, q in zip(t.texts, p, strict=True) if x is not None and q > 0.5)


# Labelled pages.

_BOILER = {
    "nav": "nav navigation menu directory navbar topnav mainmenu breadcrumb breadcrumbs pagination pager tabs toc links sitemap",
    "header": "header masthead topbar branding logo banner site",
    "footer": "footer contentinfo copyright colophon legal bottom credits",
    "aside": "sidebar complementary aside widget related recommended trending popular rail secondary tags archive",
    "ad": "ad ads advert advertisement adsense promo sponsored sponsor banner commercial billboard",
    "notice": "cookie notice consent gdpr alert popup modal overlay message warning privacy toast",
    "form": "form search newsletter subscribe signup login register contact poll feedback",
    "comments": "comments comment wpdiscuz disqus replies discussion respond reply",
    "share": "share social sharing follow buttons toolbar meta byline print",
}
_CONTENT = "article content main post entry story body text page markdown article-body post-content entry-content main-content story-body prose document maincontent"
_TAGS = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "ad": "div", "notice": "div", "form": "form", "comments": "section", "share": "div"}


class _Writer:
    """Makes one labelled page. data-y: the state of an element and of the text in it."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        syllables = [a + b for a in "b d f g k l m n p r s t v z".split() for b in "a e i o u an en or is ei ou".split()]
        self.words = ["".join(self.r.choices(syllables, k=self.r.randint(1, 4))) for _ in range(300)]

    def some(self, low: int, high: int) -> str:
        return " ".join(self.r.choices(self.words, k=self.r.randint(low, high)))

    def sentence(self) -> str:
        return self.some(3, 18).capitalize() + self.r.choice(".....!?")

    def prose(self, low: int = 1, high: int = 8) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(low, high)))

    def reading(self) -> str:
        """A list of links that is part of an article."""
        item = lambda: f'<a href="/{self.some(1, 1)}">{self.some(2, 8).capitalize()}</a>{self.r.choice(["", "", ", " + self.some(2, 6), ". " + self.sentence()])}'
        return f'<ul data-y="{C}">' + "".join(f'<li data-y="{C}">{item()}</li>' for _ in range(self.r.randint(2, 6))) + "</ul>"

    def links(self, y: int) -> str:
        n = self.r.randint(2, 8)
        item = lambda: f'<a href="/{self.some(1, 1)}">{self.some(1, 4)}</a>'
        if self.r.random() < 0.7:
            return f'<ul data-y="{y}">' + "".join(f'<li data-y="{y}">{item()}</li>' for _ in range(n)) + "</ul>"
        return self.r.choice([" | ", " ", " · "]).join(item() for _ in range(n))

    def name(self, words: str) -> str:
        own = self.r.choice(words.split())
        extra = self.r.choice(["", "", "", f" {self.some(1, 1)}", f" {own}-{self.some(1, 1)}", " box", " wrapper", " inner"])
        return f' {self.r.choice(["class", "class", "class", "id", "id", "role"])}="{own}{extra}"'

    def boiler(self, kind: str) -> str:
        tag = _TAGS[kind] if self.r.random() < 0.6 else self.r.choice(["div", "div", "section", "aside" if kind in ("aside", "ad") else "div"])
        attributes = self.name(_BOILER[kind]) if tag in ("div", "section") or self.r.random() < 0.5 else ""
        if kind in ("nav", "header", "share"):
            body = self.links(B) + (f'<h1 data-y="{B}">{self.some(1, 4)}</h1>' if kind == "header" and self.r.random() < 0.3 else "")
        elif kind == "footer":
            body = self.r.choice([f"&copy; {self.some(1, 4)} &middot; {self.prose(1, 2)}", f'<p data-y="{B}">&copy; 2020 {self.some(1, 5)}</p>', self.links(B), self.prose(1, 1), f"{self.some(1, 4)}. {self.links(B)}"])
        elif kind == "ad":
            body = self.r.choice([self.prose(1, 3), f'<a href="x">{self.some(2, 8)}</a>', f'<p data-y="{B}">{self.prose(1, 3)}</p>'])
        elif kind == "notice":
            body = f'<p data-y="{B}">{self.prose(1, 3)}</p><button data-y="{B}">{self.some(1, 2)}</button>' if self.r.random() < 0.6 else self.prose(1, 3)
        elif kind == "form":
            body = f'<label>{self.some(1, 3)}</label><input name="q"><p data-y="{B}">{self.prose(1, 2)}</p><button data-y="{B}">{self.some(1, 2)}</button>'
        elif kind == "comments":
            body = f'<h3 data-y="{B}">{self.some(1, 3)}</h3>' + "".join(
                self.r.choice([f'<div class="comment" data-y="{B}"><p data-y="{B}">{self.prose(1, 5)}</p></div>', f'<li data-y="{B}">{self.prose(1, 4)}</li>', f'<p data-y="{B}">{self.prose(1, 5)}</p>', f'<article class="comment" data-y="{B}"><p data-y="{B}">{self.prose(1, 4)}</p></article>'])
                for _ in range(self.r.randint(1, 5))
            )
        else:
            body = f'<h3 data-y="{B}">{self.some(1, 4)}</h3>' + self.r.choice([self.links(B), f'<p data-y="{B}">{self.prose(1, 3)}</p>', self.prose(1, 2)])
        return f'<{tag}{attributes} data-y="{B}">{body}</{tag}>'

    def paragraph(self) -> str:
        text = self.prose()
        if self.r.random() < 0.2:
            text = self.some(1, 4).capitalize() + "."
        if self.r.random() < 0.2:
            text = f"<b>{self.some(1, 6)}</b> {text}<br>"
        if self.r.random() < 0.2:
            text += f' <a href="/x">{self.some(1, 3)}</a> {self.sentence()}'
        return f'<p data-y="{C}">{text}' + ("</p>" if self.r.random() < 0.9 else "")

    def article(self) -> str:
        parts = [self.paragraph() for _ in range(self.r.randint(1, 10))]
        extras = [
            f'<h2 data-y="{C}">{self.some(1, 6)}</h2>',
            f'<ul data-y="{C}">' + "".join(f'<li data-y="{C}">{self.r.choice([self.sentence(), self.some(1, 5)])}</li>' for _ in range(3)) + "</ul>",
            f'<blockquote data-y="{C}"><p data-y="{C}">{self.prose(1, 3)}</p></blockquote>',
            f'<pre data-y="{C}">{self.some(4, 20)}</pre>',
            f'<table data-y="{C}"><tr data-y="{C}"><td data-y="{C}">{self.some(1, 3)}</td><td data-y="{C}">{self.some(1, 3)}</td></tr></table>',
            f'<figure data-y="{C}"><figcaption data-y="{C}">{self.sentence()}</figcaption></figure>',
            f'<section data-y="{C}"><h3 data-y="{C}">{self.some(1, 5)}</h3>{self.paragraph()}</section>',
            f'<div data-y="{C}">{self.paragraph()}</div>',
            f'<h2 data-y="{C}">{self.some(1, 4)}</h2>{self.reading()}',
            self.reading(),
        ]
        for _ in range(self.r.randint(0, 4)):
            parts.insert(self.r.randint(0, len(parts)), self.r.choice(extras))
        if self.r.random() < 0.35:
            parts.insert(self.r.randint(1, len(parts)), self.reading())
        for _ in range(self.r.choice([0, 0, 0, 1, 2])):
            parts.insert(self.r.randint(0, len(parts)), self.boiler(self.r.choice(["ad", "aside", "share", "form", "notice"])))
        title = f'<h1 data-y="{C}">{self.some(2, 9).capitalize()}</h1>'
        if self.r.random() < 0.2:
            title = f'<header data-y="{C}">{title}</header>'
        if self.r.random() < 0.15:
            parts.append(self.boiler("comments"))
        body = (title if self.r.random() < 0.9 else "") + "".join(parts)
        if self.r.random() < 0.05:
            body = f'<ul data-y="{C}">' + "".join(f'<li data-y="{C}">{self.prose(1, 4)}</li>' for _ in range(self.r.randint(2, 8))) + "</ul>"
        if self.r.random() < 0.08:
            return body
        tag = self.r.choice(["article", "article", "main", "div", "div", "section"])
        attributes = self.name(_CONTENT) if tag in ("div", "section") or self.r.random() < 0.4 else ""
        return f'<{tag}{attributes} data-y="{C}">{body}</{tag}>'

    def page(self) -> str:
        before = self.r.sample(["header", "nav", "notice", "ad", "form"], self.r.randint(1, 4))
        after = self.r.sample(["aside", "comments", "ad", "footer", "share", "nav", "form", "notice"], self.r.randint(1, 5))
        middle = self.article()
        beside = [self.boiler(self.r.choice(["aside", "ad", "comments", "nav"])) for _ in range(self.r.choice([0, 0, 1, 2]))]
        if self.r.random() < 0.4:
            inner = [middle, *beside]
            self.r.shuffle(inner)
            middle = f'<div class="{self.r.choice(["container", "wrapper", "row", "layout", "page", "site", "inner"])}" data-y="{M}">{"".join(inner)}</div>'
        else:
            middle += "".join(beside)
        body = "".join(self.boiler(k) for k in before) + middle + "".join(self.boiler(k) for k in after)
        if self.r.random() < 0.3:
            body = f'<div id="{self.r.choice(["page", "wrapper", "app", "root", "container"])}" data-y="{M}">{body}</div>'
        return f'<!DOCTYPE html><html data-y="{M}"><head><title>x</title></head><body data-y="{M}">{body}</body></html>'


def labelled_pages(n: int = LABELLED_PAGES, seed: int = 0) -> list[str]:
    return [_Writer(seed * 1_000_003 + i).page() for i in range(n)]


def extract(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """page_id, keep, text and n_chars of every page."""
    keep = ["page_id", *kept(["url"] if keep is None else keep, "page_id", "html", "text", "n_chars")]
    source = pages.select(*keep, F.col("html").alias("_html"))
    shared = pages.sparkSession.sparkContext.broadcast(train(labelled_pages()))

    def run(batches):
        model = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = [main_text(x, model) for x in part.columns[-1].to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], [*keep, "text", "n_chars"])

    schema = source.schema[: len(keep)].add("text", "string").add("n_chars", "long")
    return source.mapInArrow(T.tidy(run), schema)
