"""Main-text extraction with a tree-structured graphical model.

A page becomes its DOM tree. Every block element and every run of text is a
binary variable (content or not) with

* a node potential: log-likelihood ratios of its features (tag, class and id
  words, link share, place below the body), and
* an edge potential between parent and child, one table for the children of the
  body (where article and surroundings meet) and one for all other nodes.

Both are counted from labelled pages (:func:`labelled_pages`). Sum-product
message passing, once up and once down the tree, gives the exact marginal of
every node; text whose marginal reaches 0.5 is kept.

Texts: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one line end in page order. Scripts,
styles, templates, the head and comments are never text. Null or empty html
gives the empty text; markup without an end, unclosed or crossing tags are
repaired the way browsers do for the common cases. Rows are independent;
repeated rows, null ids and urls and extra columns do not matter.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)", re.S)
#: The same once a quote has been found that nothing closes.
_LENIENT = re.compile(
    r"<!--(?:.*?-->|.*\Z)|()()()<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true)"
                     r"|display\s*:\s*none", re.I)
_LINK_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is never page text.
SILENT = frozenset("script style template noscript head title svg math iframe object canvas "
                   "audio video select option datalist".split())
RAW = frozenset(("script", "style", "title", "textarea", "iframe", "noscript"))
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label "
                   "mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
                   "img".split())
#: An open element that the start of another one closes.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead"),
          "option": ("option",)}
#: An end tag or an implied end does not reach beyond these.
SCOPE = frozenset(("table", "ul", "ol", "dl", "article", "main", "section", "aside", "body",
                   "html", "div", "nav", "footer", "header", "form"))


#: End tags of these close nothing around the innermost scope.
_HELD = INLINE | {"p", "li", "td", "tr", "dd", "dt"}
_RAW_END = {t: re.compile(r"</" + t + r"(?=[\s/>])", re.I) for t in sorted(RAW)}

#: Nodes whose children may be article or surroundings alike.
TOP = frozenset(("#page", "html", "body"))


class Page:
    """Nodes in document order (a parent comes before its children)."""

    def __init__(self, source: str):
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["#page"]
        self.attrs: list[str] = [""]
        self.text: list[list[str] | None] = [None]  # pieces, for runs of text
        self.block: list[int] = [0]
        self.linked: list[int] = [0]  # characters inside links, for runs of text
        self._parse(source)

    def _add(self, parent: int, tag: str, attrs: str, text, block: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.text.append(text)
        self.block.append(block)
        self.linked.append(0)
        return len(self.tag) - 1

    def _parse(self, src: str) -> None:
        """In one pass: a tag whose quotes do not close is looked for once, after
        which quotes mean nothing; and what is open is counted per tag, so that the
        open elements are only gone through to be closed."""
        stack = [("#page", 0)]  # open elements: tag, node that their text belongs to
        # Open elements per tag, of all and of those inside the innermost scope.
        total: Counter[str] = Counter()
        scopes: list[Counter[str]] = [Counter()]
        block, silent, links, at, run = 0, 0, 0, 0, -1
        markup, last_end = _MARKUP, src.rfind(">")

        def push(tag: str, node: int) -> None:
            nonlocal silent
            stack.append((tag, node))
            total[tag] += 1
            scopes[-1][tag] += 1
            if tag in SCOPE:
                scopes.append(Counter())
            silent += tag in SILENT

        def pop() -> str:
            nonlocal silent, links
            tag = stack.pop()[0]
            if tag in SCOPE:
                scopes.pop()
            scopes[-1][tag] -= 1
            total[tag] -= 1
            silent -= tag in SILENT
            links -= tag == "a"
            return tag

        def say(raw: str) -> None:
            nonlocal run
            if silent or not raw:
                return
            node = stack[-1][1]
            if run < 0 or self.parent[run] != node or self.block[run] != block:
                if raw.isspace() and run < 0:
                    return
                run = self._add(node, "#text", "", [], block)
            text = html.unescape(raw) if "&" in raw else raw
            self.text[run].append(text)
            if links:
                self.linked[run] += len(text)

        end = len(src)
        while at < end:
            m = markup.search(src, at) if at <= last_end else None
            if m is None:
                rest = src[at:]
                cut = re.search(r"<[a-zA-Z/!?]", rest)  # a tag that the page's end cut off
                say(rest[:cut.start()] if cut else rest)
                break
            if m[5]:
                markup = _LENIENT  # no quote closes up to the page's end
            say(src[at:m.start()])
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            tag, closing = name.lower(), m[1] or m[4]
            if closing:
                if tag == "p" and not total["p"]:
                    block, run = block + 1, -1
                    continue
                # An end tag inside a scope does not close what is open around it.
                if (scopes[-1] if tag in _HELD else total)[tag] > 0:
                    while pop() != tag:
                        pass
                if tag not in INLINE:
                    block, run = block + 1, -1
                continue
            attrs = m[3] or m[6] or ""
            if tag == "br":
                say(" ")
                continue
            inline = tag in INLINE
            if not inline:
                block, run = block + 1, -1
                ends = CLOSES.get(tag, ("p",))
                while any(scopes[-1][e] > 0 for e in ends):
                    while pop() not in ends:
                        pass
                    if tag != "tr" and tag != "tbody":
                        break
            if tag in VOID:
                continue
            if tag in RAW:
                close = _RAW_END[tag].search(src, at)
                if tag == "textarea" or not close:
                    at = close.start() if close else end
                    continue
                at = close.start()
            node = stack[-1][1]
            if not inline or _ATTRIBUTE.search(attrs):
                node = self._add(node, tag, attrs, None, block)
                if inline:
                    run = -1
            hidden = bool(attrs) and bool(_HIDDEN.search(attrs))
            push("template" if hidden else tag, node)
            links += tag == "a" and not hidden

    def features(self) -> list[list[str]]:
        n = len(self.tag)
        chars, linked = [0] * n, [0] * n
        for i in range(n - 1, 0, -1):
            if self.text[i] is not None:
                chars[i] += sum(map(len, self.text[i]))
                linked[i] += self.linked[i]
            chars[self.parent[i]] += chars[i]
            linked[self.parent[i]] += linked[i]
        out = []
        for i in range(n):
            share = linked[i] / chars[i] if chars[i] else 0.0
            f = ["L0" if share < 0.1 else "L1" if share < 0.5 else "L2"]
            tag = self.tag[i]
            above = self.tag[self.parent[i]]
            if above in TOP:
                f.append("top:" + tag)
            elif tag != "#text":
                f.append("t:" + tag)
                if tag in ("header", "footer"):
                    f.append(f"in:{above}>{tag}")
            if self.attrs[i]:
                for value in _ATTRIBUTE.findall(self.attrs[i]):
                    f += {"c:" + w for w in _LINK_WORDS.findall(_CAMEL.sub(" ", value).lower())}
            out.append(f)
        return out


class Model:
    """Node log-likelihood ratios and the edge table P(child | parent)."""

    def __init__(self, weight: dict[str, float], edges: list[list[list[float]]], root: float):
        self.weight, self.edges, self.root = weight, edges, root

    def marginals(self, page: Page) -> list[float]:
        """P(content) of every node: sum-product, up and then down the tree."""
        n, parent = len(page.tag), page.parent
        tables = [(*e[0], *e[1]) for e in self.edges]
        edge = [tables[page.tag[p] in TOP] for p in parent]
        get = self.weight.get
        up0, up1 = [1.0] * n, [1.0] * n  # belief from the node and all below it
        for i, f in enumerate(page.features()):
            x = sum([get(k, 0.0) for k in f])
            up1[i] = 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, x))))
            up0[i] = 1.0 - up1[i] + 1e-13
        m0, m1 = [1.0] * n, [1.0] * n  # message to the parent
        for i in range(n - 1, 0, -1):
            s = up0[i] + up1[i]
            a, b = up0[i] / s, up1[i] / s
            e00, e01, e10, e11 = edge[i]
            m0[i], m1[i] = e00 * a + e01 * b, e10 * a + e11 * b
            p = parent[i]
            x, y = up0[p] * m0[i], up1[p] * m1[i]
            s = x + y
            up0[p], up1[p] = max(x / s, 1e-300), max(y / s, 1e-300)
        out = [0.0] * n
        x, y = up0[0] * (1 - self.root), up1[0] * self.root
        out[0] = y / (x + y)
        for i in range(1, n):
            q = out[parent[i]]
            e00, e01, e10, e11 = edge[i]
            a, b = (1.0 - q) / m0[i], q / m1[i]  # the parent without this child's message
            x = up0[i] * (a * e00 + b * e10)
            y = up1[i] * (a * e01 + b * e11)
            out[i] = y / (x + y)
        return out


#: Words of class and id attributes of the labelled pages (fixed values): around
#: the article, and of the article itself.
AROUND = """ad ads advert advertisement adsense sponsor sponsored promo promotion banner cookie
cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup sidebar aside
widget widgets related recommended recommendations more trending popular share sharing social
follow comments comment reply replies respond disqus discussion menu nav navbar navigation
breadcrumb breadcrumbs footer header masthead topbar copyright legal login search form pagination
pager tags toolbar skip print rating poll survey teaser links sitemap language toc""".split()
ARTICLE = """article post entry content main story body text page news blog maincontent
articlebody postbody richtext prose""".split()

_SENTENCES = ("The quick report of the morning was read by all who came to the hall.",
              "It rained for two days, and nobody in the valley had expected so much water.",
              "Why did the bridge hold? The engineers explain it in simple words, step by step, so "
              "that every reader can follow the calculation from the first load to the last.",
              "A short note.", "Later that year the council met again and agreed on the plan.")
_SNIPPETS = ("Home", "About us", "Read more", "Sign up for our letter", "All rights reserved.",
             "We use cookies.", "Buy now and save 20 percent today.", "Share", "Contact",
             "Nice text, thank you!", "Search", "Popular this week")


def labelled_pages() -> list[tuple[str, frozenset[str]]]:
    """Labelled pages: the html, with ``data-y`` = 1 on elements that are content
    and 0 on elements that are not; labels hold below until changed."""
    def text(i: int, n: int) -> str:
        return " ".join(_SENTENCES[(i + k) % len(_SENTENCES)] for k in range(n))

    def snip(i: int) -> str:
        return _SNIPPETS[i % len(_SNIPPETS)]

    def links(i: int, n: int = 4) -> str:
        return "".join(f'<li><a href="/{k}">{snip(i + k)}</a></li>' for k in range(n))

    def around(i: int, word: str) -> str:
        inner = (f"<ul>{links(i)}</ul>", f"<p>{snip(i)}</p>", f"{snip(i)} {text(i, 1)}",
                 f"<h3>{snip(i)}</h3><p>{text(i, 1)}</p><p>{text(i + 1, 2)}</p>",
                 f"<form><label>{snip(i)}</label><input><button>{snip(i)}</button></form>",
                 f"<h2>{snip(i)}</h2><div><p>{text(i, 2)}</p></div><div>{text(i, 1)}</div>",
                 f"<h4>{snip(i)}</h4><ol><li>{text(i, 1)}</li><li>{snip(i)}</li></ol>",
                 f"<article><header>{snip(i)}</header><p>{text(i, 2)}</p></article>",
                 f"<section><h2>{snip(i)}</h2><table><tr><td>{snip(i)}</td></tr></table></section>",
                 f"<div><div><a href='/'>{snip(i)}</a></div><p>{text(i, 1)}</p></div>")[i % 10]
        attr = ("class", "id")[i % 2]
        tag = ("div", "section", "div", "aside", "div", "ul" if i % 10 == 0 else "div")[i % 6]
        return f'<{tag} {attr}="{word}" data-y="0">{inner}</{tag}>'

    def article(i: int) -> str:
        parts = [f"<h1>{text(i, 1)}</h1>" if i % 3 else
                 f'<header data-y="1"><h1>{text(i, 1)}</h1><p>{text(i + 1, 1)}</p></header>']
        for k in range(3 + i % 4):
            parts.append(f"<p>{text(i + k, 1 + (i + k) % 3)}</p>")
            parts.append((
                f"<h2>{text(k, 1)}</h2><ul><li>{text(i, 1)}</li><li>Item</li></ul>",
                f"<blockquote><p>{text(k, 1)}</p></blockquote><pre>a = 1</pre>",
                f"<table><tr><th>{snip(k)}</th><td>{text(k, 1)}</td></tr></table>",
                f"<h3>{snip(k)}</h3><ol><li>{text(i, 1)}</li></ol><h4>{snip(i)}</h4>",
                f"<div><p>{text(k, 2)}</p></div><section><h2>{snip(k)}</h2>{text(i, 1)}</section>",
                f"<figure><figcaption>{text(k, 1)}</figcaption></figure><dl><dt>{snip(k)}</dt>"
                f"<dd>{text(k, 1)}</dd></dl>",
                f'<p><a href="/x">{text(k, 1)}</a></p><ul>{links(k, 2)}</ul>',
                f"<div>{text(k, 1)}</div><hr><p>{snip(i)}</p>")[(i + k) % 8])
        return "".join(parts)

    pages = []
    for i in range(4 * len(AROUND)):
        word = AROUND[(i * 7) % len(AROUND)]
        name = ARTICLE[i % len(ARTICLE)]
        open_, close = (("<article data-y='1'>", "</article>"),
                        (f'<div class="{name}" data-y="1">', "</div>"),
                        (f'<main id="{name}" data-y="1"><section>', "</section></main>"),
                        ("<article data-y='1'>", "</article>"))[i % 4]
        inside = "".join(around(i + k, AROUND[(i * 5 + k) % len(AROUND)]) for k in range(1 + i % 3))
        byline = f'<footer data-y="0"><p>{snip(i)}</p></footer>' if i % 5 == 0 else ""
        pages.append(
            "<html><body data-y='1'>"
            + (f'<header data-y="0"><a href="/">{snip(i)}</a></header>' if i % 3 == 0 else "")
            + f'<nav data-y="0"><ul>{links(i, 5)}</ul></nav>' + around(i, word)
            + open_ + article(i) + inside + byline + close
            + around(i + 2, AROUND[(i + 5) % len(AROUND)])
            + (f'<form data-y="0"><label>{snip(i)}</label><input><p>{snip(i)}</p></form>'
               if i % 4 == 0 else "")
            + (f'<aside data-y="0"><h3>{snip(i)}</h3><p>{text(i, 1)}</p></aside>' if i % 2 else "")
            + f'<footer data-y="0"><p>{snip(i + 4)}</p>{text(i, 1)}</footer></body></html>')
    for i in range(12):  # the article's blocks directly in the body, or bare text
        body = article(i) if i % 4 else f"{text(i, 3)}<p>{text(i, 1)}</p>"
        pages.append(f"<html><body data-y='1'><nav data-y='0'><ul>{links(i)}</ul></nav>{body}"
                     f'<footer data-y="0">{snip(i)}</footer></body></html>')
    return pages


def train(pages: list[str] | None = None, smooth: float = 0.1) -> Model:
    """Count the potentials from labelled pages."""
    seen, total = (Counter(), Counter()), [0, 0]
    edges = [[[1.0, 1.0], [1.0, 1.0]] for _ in range(2)]
    for source in labelled_pages() if pages is None else pages:
        page = Page(source)
        y = [1] * len(page.tag)
        for i in range(1, len(y)):
            m = re.search(r"data-y=[\"']?([01])", page.attrs[i])
            y[i] = int(m[1]) if m else y[page.parent[i]]
            edges[page.tag[page.parent[i]] in TOP][y[page.parent[i]]][y[i]] += 1
        for f, label in zip(page.features(), y):
            total[label] += 1
            seen[label].update(f)
    weight = {f: math.log((seen[1][f] + smooth) / (total[1] + 2 * smooth))
              - math.log((seen[0][f] + smooth) / (total[0] + 2 * smooth))
              for f in seen[0].keys() | seen[1].keys()}
    for tag in TOP:
        weight.pop("top:" + tag, None)
        weight.pop("t:" + tag, None)
    return Model(weight, [[[x / sum(row) for x in row] for row in e] for e in edges], 0.9)


def extract(source: str | None, model: Model) -> str:
    """The main text of one page."""
    if not source:
        return ""
    page = Page(source)
    p = model.marginals(page)
    blocks: list[tuple[int, list[str]]] = []
    for i, pieces in enumerate(page.text):
        if pieces is not None and p[i] >= 0.5:
            if not blocks or blocks[-1][0] != page.block[i]:
                blocks.append((page.block[i], []))
            blocks[-1][1].extend(pieces)
    lines = [" ".join("".join(b).split()) for _, b in blocks]
    return "\n".join([x for x in lines if x])


def _extracted(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(s, model) for s in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    return run


def extract_pages(df: DataFrame, model: Model | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    src = df.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"),
                    F.col("html").cast("string"))
    return src.mapInArrow(_extracted(model or train()),
                          "page_id long, url string, text string, n_chars long")
