"""HTML extraction: a linear-chain CRF over DOM leaf blocks, decoded by Viterbi.

A page is read into leaf blocks: runs of text between the borders of block elements, each with the
tags and the class and id words of its ancestors. The features of a block are those of its ancestors
and of its text; neighbouring blocks are tied by transition weights. The model is trained on labelled
pages: a bounded sample of the table, whose ``article`` elements tell the label, and the same texts
set in generated layouts, where labels are known by construction and the markup varies. Generated
layouts teach what the table's own markup may lack: sidebars, notices, forms, reader comments.
"""

from __future__ import annotations

import html
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shedlake.llm.common import among_few

SAMPLE_PAGES = 400  # the bound of the training sample: pages of the table
LAYOUTS = 1500  # generated pages
LAYOUT_TEXTS = 4000  # texts of the sample that are set in them, at most
LAYOUT_CHARS = 2000  # characters that each of these has at most
MOST_FEATURES = 200_000  # of the paths of a page of the sample; pages nested beyond this don't train
PASSES = 10
RATE = 0.3
DECAY = 1e-4

# Element names of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
_UNSEEN = frozenset("head script style title noscript template svg math iframe object select textarea option noembed noframes xmp".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
_ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_KEEPS_P = frozenset("article aside body button div footer header main nav section table td th li blockquote form".split())

_MARK = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:(/?)>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|data-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Path:
    """The ancestors of blocks, as a chain that all blocks below share; ``fresh`` has the features, tag
    and class and id words, that no element above has."""

    __slots__ = ("above", "tag", "features", "fresh", "size")

    def __init__(self, above: Path | None, tag: str, features: tuple[str, ...], fresh: tuple[str, ...]) -> None:
        self.above, self.tag, self.features, self.fresh = above, tag, features, fresh
        self.size = len(fresh) + (above.size if above else 0)

    def upwards(self) -> Iterator[Path]:
        path: Path | None = self
        while path is not None:
            yield path
            path = path.above

    def __iter__(self) -> Iterator[str]:
        """All features, each once."""
        yield f"p:{self.tag}"
        for path in self.upwards():
            yield from path.fresh


@dataclass
class Block:
    """A leaf block: its text, the path to it, the share of its text in links, and a given label."""

    path: Path
    text: str
    linked: float
    label: int | None


@dataclass
class _Open:
    tag: str
    path: Path  # of the nearest block element, this one included
    own: tuple[str, ...]  # features that the path has from this element
    label: int | None


def _names(attributes: str) -> tuple[tuple[str, ...], int | None]:
    found, label = [], None
    for m in _ATTRIBUTE.finditer(attributes):
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4]
        if m[1].lower() == "data-label":
            label = int(value == "1")
        else:
            found += [f"c:{part.lower()}" for part in _NAME_PART.findall(html.unescape(value))]
    return tuple(found), label


class _Reader:
    """Reads a page into leaf blocks, forgiving unclosed and stray tags."""

    def __init__(self) -> None:
        self.root = Path(None, "", (), ())
        self.open: list[_Open] = []
        self.tags: Counter[str] = Counter()  # open elements by tag
        self.features: Counter[str] = Counter()  # by feature
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0
        self.unseen = 0

    def text(self, raw: str) -> None:
        if self.unseen or not raw:
            return
        if "&" in raw:
            raw = html.unescape(raw)
        self.parts.append(raw)
        if self.tags["a"]:
            self.linked += len("".join(raw.split()))

    def flush(self) -> None:
        if not self.parts:
            return
        text = " ".join("".join(self.parts).split())
        if text:
            path, label = (self.open[-1].path, self.open[-1].label) if self.open else (self.root, None)
            letters = max(1, len(text) - text.count(" "))
            self.blocks.append(Block(path, text, min(1.0, self.linked / letters), label))
        self.parts, self.linked = [], 0

    def push(self, tag: str, features: tuple[str, ...], label: int | None) -> None:
        path, before = (self.open[-1].path, self.open[-1].label) if self.open else (self.root, None)
        own: tuple[str, ...] = ()
        if tag not in _INLINE:
            own = tuple(dict.fromkeys((f"t:{tag}", *features)))
            path = Path(path, tag, own, tuple(f for f in own if not self.features[f]))
            self.features.update(own)
        self.tags[tag] += 1
        self.open.append(_Open(tag, path, own, before if label is None else label))
        if tag in _UNSEEN:
            self.unseen += 1

    def pop(self) -> None:
        gone = self.open.pop()
        self.tags[gone.tag] -= 1
        self.features.subtract(gone.own)
        if gone.tag in _UNSEEN:
            self.unseen -= 1

    def start(self, tag: str, attributes: str, closed: bool) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in _INLINE:
            self.flush()
            if tag in _ENDS_P:
                self.end_within({"p"}, _KEEPS_P)
            if tag in _ENDED_BY:
                self.end_within(_ENDED_BY[tag], _SCOPES[tag])
        if tag in _VOID or closed:
            return
        features, label = _names(attributes) if "=" in attributes else ((), None)
        self.push(tag, features, label)

    def end_within(self, tags: set[str], borders: frozenset[str] | set[str]) -> None:
        """Close the nearest of ``tags`` and all in it, unless a border stands before it."""
        if not any(self.tags[tag] for tag in tags):
            return
        for n in range(len(self.open) - 1, -1, -1):
            if self.open[n].tag in tags:
                while len(self.open) > n:
                    self.pop()
                return
            if self.open[n].tag in borders:
                return

    def end(self, tag: str) -> None:
        if tag not in _INLINE:
            self.flush()
        if not self.tags[tag]:
            return
        for n in range(len(self.open) - 1, -1, -1):
            if self.open[n].tag == tag:
                while len(self.open) > n:
                    self.pop()
                return
            if tag in _INLINE and self.open[n].tag not in _INLINE:
                return


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order; empty for null, empty and markup-only pages."""
    reader, page, at = _Reader(), page or "", 0
    while True:
        mark = page.find("<", at)
        if mark < 0:
            reader.text(page[at:])
            break
        found = _MARK.match(page, mark)
        if found is None:  # a "<" of its own
            reader.text(page[at : mark + 1])
            at = mark + 1
            continue
        reader.text(page[at:mark])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            reader.end(tag)
            continue
        reader.start(tag, found[3], bool(found[4]) and tag not in _RAW)
        if tag in _RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = close.start() if close else len(page)
    reader.flush()
    return reader.blocks


def text_features(block: Block, place: float) -> list[str]:
    text = block.text
    words = text.count(" ") + 1
    size = min(7, int(np.log2(words + 1)))
    link = 0 if block.linked == 0 else 1 if block.linked < 0.34 else 2 if block.linked < 0.67 else 3
    return [
        "b",
        f"w{size}",
        f"l{link}",
        f"w{min(size, 4)}l{link}",
        f"e{text[-1] if text[-1] in '.!?:,;' else ''}",
        f"n{min(3, text.count(',') + text.count('.'))}",
        f"s{min(3, int(place * 4))}",
        f"d{min(2, 10 * sum(map(text.count, string.digits)) // len(text))}",
        *(["©"] if "©" in text else []),
    ]


@dataclass
class ExtractionModel:
    """Weights for "main" against "other" of each feature, and of transitions; bounded by the training."""

    weights: dict[str, float]
    transitions: list[list[float]]

    def on_path(self, path: Path, known: dict[Path, float]) -> float:
        """The weight of all features of a path, from that of the nearest known one above it."""
        chain = []
        for part in path.upwards():
            if part in known:
                break
            chain.append(part)
        for part in reversed(chain):
            above = known[part.above] if part.above else 0.0
            known[part] = above + sum(self.weights.get(f, 0.0) for f in part.fresh)
        return known[path] + self.weights.get(f"p:{path.tag}", 0.0)

    def decode(self, blocks: list[Block]) -> list[int]:
        """The likeliest labels of a page's blocks (Viterbi)."""
        of = self.weights.get
        best, back = [0.0, 0.0], []
        known: dict[Path, float] = {}
        for n, block in enumerate(blocks):
            gain = self.on_path(block.path, known) + sum(of(f, 0.0) for f in text_features(block, n / len(blocks)))
            if n == 0:
                best = [0.0, gain]
                continue
            (a, b), (c, d) = self.transitions
            to_other = (0, best[0] + a) if best[0] + a >= best[1] + c else (1, best[1] + c)
            to_main = (0, best[0] + b) if best[0] + b > best[1] + d else (1, best[1] + d)
            back.append((to_other[0], to_main[0]))
            best = [to_other[1], to_main[1] + gain]
        if not blocks:
            return []
        labels = [int(best[1] > best[0])]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]

    def extract(self, page: str | None) -> str:
        blocks = blocks_of(page)
        return "\n".join(b.text for b, main in zip(blocks, self.decode(blocks), strict=True) if main)


def fit(pages: list[list[Block]], seed: int = 3) -> ExtractionModel:
    """Train on labelled pages: gradients by forward and backward passes over each chain."""
    names: dict[str, int] = {}
    chains = []
    for blocks in pages:
        if blocks:
            rows = [
                np.array(sorted({names.setdefault(f, len(names)) for f in (*set(b.path), *text_features(b, n / len(blocks)))}))
                for n, b in enumerate(blocks)
            ]
            chains.append((rows, np.array([b.label or 0 for b in blocks])))
    weights, links = np.zeros(len(names)), np.zeros((2, 2))
    seen, seen_links = np.full(len(names), 1e-3), np.full((2, 2), 1e-3)
    random = np.random.default_rng(seed)
    for _ in range(PASSES):
        for c in random.permutation(len(chains)):
            rows, labels = chains[c]
            gains = np.array([weights[r].sum() for r in rows])
            count = len(rows)
            forward, backward = np.zeros((count, 2)), np.zeros((count, 2))
            forward[0, 1] = gains[0]
            for n in range(1, count):
                forward[n] = np.logaddexp(forward[n - 1, 0] + links[0], forward[n - 1, 1] + links[1])
                forward[n, 1] += gains[n]
            for n in range(count - 2, -1, -1):
                ahead = backward[n + 1] + [0, gains[n + 1]]
                backward[n] = np.logaddexp(ahead[0] + links[:, 0], ahead[1] + links[:, 1])
            total = np.logaddexp(*forward[-1])
            slope = np.exp(forward[:, 1] + backward[:, 1] - total) - labels
            slope_links = np.zeros((2, 2))
            if count > 1:
                joint = forward[:-1, :, None] + links + (backward[1:] + np.stack([np.zeros(count - 1), gains[1:]], 1))[:, None, :]
                slope_links = np.exp(joint - total).sum(0)
                np.add.at(slope_links, (labels[:-1], labels[1:]), -1)
            touched = np.concatenate(rows)
            back = np.bincount(touched, np.repeat(slope, [len(r) for r in rows]), len(names))
            some = np.unique(touched)
            back = back[some] + DECAY * weights[some]
            seen[some] += back**2
            weights[some] -= RATE * back / np.sqrt(seen[some])
            seen_links += slope_links**2
            links -= RATE * slope_links / np.sqrt(seen_links)
    return ExtractionModel({f: float(weights[n]) for f, n in names.items() if weights[n]}, links.tolist())


def _in_article(path: Path) -> bool:
    """Inside an ``article``, in no part of it that is set apart, and the article is no reader's comment."""
    for part in path.upwards():
        names = {f[2:] for f in part.features if f.startswith("c:")}
        if part.tag == "article":
            above = {f[2:] for p in part.upwards() for f in p.features if f.startswith("c:")}
            return not above & _COMMENT_WORDS
        if part.tag in _APART_TAGS or names & _APART_WORDS:
            return False
    return False


def labelled_by_article(page: str | None) -> list[Block]:
    """Blocks of a page whose markup tells the label; none if it has no ``article``.

    Main is what lies inside an article but not in its navigation, notices, adverts, forms, asides or
    comments, by tags and by class and id words.
    """
    blocks = blocks_of(page)
    inside = {b.path: None for b in blocks}
    if sum(p.size for p in inside) > MOST_FEATURES or not any("t:article" in p for p in inside):
        return []
    known = {p: int(_in_article(p)) for p in inside}
    for b in blocks:
        b.label = known[b.path]
    return blocks


# Words of class and id names that set a part of an article apart.
_COMMENT_WORDS = frozenset("comments comment commentlist discussion replies reply responses respond".split())
_APART_WORDS = _COMMENT_WORDS | frozenset(
    "notice alert cookie cookies consent gdpr warning announcement ad ads advert advertisement adsense sponsored promo"
    " promotion sponsor newsletter subscribe signup login sidebar related recommended popular nav menu navigation"
    " breadcrumb breadcrumbs pagination pager footer widget share social".split()
)
_APART_TAGS = frozenset("nav aside footer form header".split())

# Words of class and id names, as they are common on the web.
_MAIN_NAMES = "content main article post entry story body text page-content post-body entry-content article-body main-content blog-post".split()
_OTHER_NAMES = {
    "nav": "nav menu navigation navbar main-menu topnav breadcrumb breadcrumbs pagination pager".split(),
    "header": "header site-header masthead top banner logo branding".split(),
    "footer": "footer site-footer bottom copyright legal colophon".split(),
    "aside": "sidebar side widget related related-posts recommended popular tags share social".split(),
    "notice": "notice alert cookie cookie-banner consent gdpr warning message info announcement".split(),
    "ad": "ad ads advert advertisement adsense sponsored promo promotion sponsor".split(),
    "form": "form search login newsletter subscribe signup contact-form".split(),
    "comments": "comments comment comment-list commentlist comment-body discussion replies reply responses respond user-comments".split(),
}
_FILLERS = {
    "nav": "Home|About|Contact|News|Blog|Products|Archive|Next|Previous".split("|"),
    "header": "Site|Welcome|Our site|Daily".split("|"),
    "footer": "© 2020 Example|All rights reserved.|Privacy policy|Terms of use".split("|"),
    "aside": "Related|Most read|Share this|Tags|See also".split("|"),
    "notice": "We use cookies.|This site uses cookies to improve your visit.|Please accept our terms.".split("|"),
    "ad": "Advertisement|Buy now!|Sponsored|Special offer, today only!".split("|"),
    "form": "Search|Subscribe to our newsletter|Your name|E-mail|Send".split("|"),
    "comments": "Great post!|I do not agree with this.|Thanks for sharing.|Reply".split("|"),
}


def generated_pages(texts: list[str], count: int, seed: int = 17) -> list[list[Block]]:
    """Labelled pages: given texts set in layouts drawn at random."""
    random = np.random.default_rng(seed)
    pick = lambda options: options[int(random.integers(len(options)))]
    chance = lambda p: bool(random.random() < p)

    def named(names: list[str]) -> str:
        kind = pick(["class", "id"])
        return f' {kind}="{pick(names)}"' if chance(0.9) else ""

    def some_text(kind: str, most: int) -> str:
        return html.escape(pick(texts) if texts and chance(0.6) else " ".join(pick(_FILLERS[kind]) for _ in range(int(random.integers(1, most + 1)))))

    def part(kind: str) -> str:
        names, label = _OTHER_NAMES[kind], ' data-label="0"'
        if kind == "nav":
            tag = pick(["nav", "div", "ul"])
            items = "".join(f'<li><a href="#">{some_text(kind, 1)[:30]}</a></li>' for _ in range(int(random.integers(2, 9))))
            return f"<{tag}{named(names) if tag != 'nav' or chance(0.5) else ''}{label}>{items if tag == 'ul' else f'<ul>{items}</ul>'}</{tag}>"
        if kind == "form":
            return f'<form{named(names)}{label}><label>{some_text(kind, 2)}</label><input name="q"><button>{pick(_FILLERS[kind])}</button></form>'
        if kind == "comments":
            tag = pick(["div", "section", "ol"])
            inner = pick(["div", "li", "article", "p"])
            rows = "".join(
                f'<{inner} class="{pick(names)}"><p>{some_text(kind, 3)}</p></{inner}>' for _ in range(int(random.integers(1, 6)))
            )
            return f'<{tag} class="{pick(names)}"{label}><h3>{pick(["Comments", "Discussion", "Replies", "What do you think?"])}</h3>{rows}</{tag}>'
        tag = {"header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"]}.get(kind, ["div", "section", "p", "aside"])
        tag = pick(tag)
        name = named(names) if tag in ("header", "footer", "aside") else f' class="{pick(names)}"'
        body = f"<p>{some_text(kind, 3)}</p>" if chance(0.5) and tag != "p" else some_text(kind, 3)
        if chance(0.3) and kind in ("aside", "footer"):
            body += "<ul>" + "".join(f'<li><a href="#">{some_text(kind, 1)[:40]}</a></li>' for _ in range(3)) + "</ul>"
        return f"<{tag}{name}{label}>{body}</{tag}>"

    def article() -> str:
        rows = []
        if chance(0.7):
            rows.append(f"<h1>{html.escape((pick(texts) if texts else 'A title')[:60])}</h1>")
        for _ in range(int(random.integers(1, 8))):
            text = html.escape(pick(texts) if texts else "Some text of an article, with a point. And more of it.")
            kind = random.random()
            if kind < 0.7:
                rows.append(f"<p>{text}</p>")
            elif kind < 0.8:
                rows.append(f"<h2>{text[:50]}</h2>")
            elif kind < 0.88:
                rows.append(f"<blockquote><p>{text}</p></blockquote>")
            elif kind < 0.95:
                rows.append("<ul>" + "".join(f"<li>{html.escape((pick(texts) if texts else 'An item of a list')[:80])}</li>" for _ in range(3)) + "</ul>")
            else:
                rows.append(f"<table><tr><td>{text[:60]}</td><td>12</td></tr></table>")
            if chance(0.12):
                rows.append(part(pick(["ad", "notice", "aside", "form"])))
        if chance(0.15):
            rows.append(part("comments"))
        tag = pick(["article", "div", "main", "section", "div"])
        name = named(_MAIN_NAMES) if tag in ("article", "main") and chance(0.5) else f' {pick(["class", "id"])}="{pick(_MAIN_NAMES)}"'
        return f'<{tag}{name if tag in ("div", "section") or chance(0.6) else ""} data-label="1">{"".join(rows)}</{tag}>'

    pages = []
    for _ in range(count):
        top = [part(k) for k in ("header", "nav", "notice", "ad", "form") if chance(0.45)]
        end = [part(k) for k in ("comments", "aside", "ad", "notice", "form", "nav", "footer") if chance(0.45)]
        body = "".join([*top, article(), *end])
        if chance(0.3):
            body = f'<div class="{pick(["wrapper", "container", "page", "site", "layout", "row"])}">{body}</div>'
        pages.append(blocks_of(f"<html><head><title>x</title></head><body>{body}</body></html>"))
    return pages


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, layouts: int = LAYOUTS) -> ExtractionModel:
    """Fit on a bounded, reproducible sample of pages and on generated layouts of their texts."""
    named = pages.where("html IS NOT NULL").select(F.xxhash64("page_id", "url").alias("order"), "html")
    few = named.where(among_few(F.col("order"), sample_pages, named.count()))
    sample = (
        few.groupBy("order").agg(F.min("html").alias("html")).orderBy("order").limit(sample_pages).collect()
    )
    own = [b for r in sample if (b := labelled_by_article(r.html))]
    texts = [b.text for blocks in own for b in blocks if len(b.text) < LAYOUT_CHARS][:LAYOUT_TEXTS]
    return fit(own + generated_pages(texts, layouts))


def main_text(model: ExtractionModel, page: Column) -> Column:
    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([model.extract(p) for p in pages], dtype="object")

    return extract(page)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``.

    The blocks labelled main, joined by line ends; character references are decoded and white space
    inside a block is one space. Null, empty and markup-only pages give an empty text. Repeated rows
    come back repeated; further columns are ignored. Without any labelled page in the table the
    generated layouts alone train the model.
    """
    model = train(pages)
    return pages.select("page_id", "url", main_text(model, F.col("html")).alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )
