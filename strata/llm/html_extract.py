"""Main text of web pages: flat text blocks classified by a decision tree.

A page's markup is read once from front to back and leaves a flat list of text
blocks. Each is described by its words and link density, those of the blocks
before and after it, and the kind of the nearest enclosing element that tells
content from page furniture. A decision tree fitted on a small labelled table
(``html_training``) keeps or drops each block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.llm.common import read_table, without
from strata.llm.html_training import PAGES

#: Pages that a task hands back at once.
OUT_ROWS = 256
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "place")

#: Elements whose content is no text of the page.
HIDDEN = frozenset("script style title textarea xmp iframe noembed noframes template".split())
VOID = frozenset("area base col embed hr img input link meta param source track wbr br".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript "
    "object ol optgroup option output p pre search section select summary svg table tbody td tfoot th thead tr ul".split()
)
#: A new one of these ends an open one before it.
IMPLIED_END = frozenset("p li dt dd td th tr option".split())
MAIN_TAGS = frozenset("article main".split())
FURNITURE_TAGS = frozenset(
    "nav footer aside button select menu dialog fieldset noscript object svg label output search head".split()
)
#: Words of a class, id or role that mark page furniture or main text.
FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies disqus footer gdpr masthead menu nav navbar navigation newsletter notice notices "
    "pagination popup promo promotion related replies reply respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar widget".split()
)
MAIN_WORDS = frozenset("article entry main post story".split())

_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
FURNITURE, FORM, NEITHER, MAIN = -1.0, -0.5, 0.0, 1.0


@dataclass(slots=True)
class Block:
    text: str
    words: int
    linked: int  # words inside links
    place: float  # in main text, in page furniture, in a form, or in neither
    marked: bool  # the training table's label


def _place(name: str, attributes: dict[str, str], inside: float) -> float:
    """Where an element's content stands. What is in page furniture stays there;
    a form may span a whole page, so an article in it counts. An article's own
    heading part is not the page's header."""
    if inside == FURNITURE or name == "body":
        return inside
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return FURNITURE
    if re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return FURNITURE
    said = {w.lower() for key in ("class", "id", "role") for w in _WORDS.findall(attributes.get(key, ""))}
    if name in FURNITURE_TAGS or said & FURNITURE_WORDS or inside != MAIN and (name == "header" or "header" in said):
        return FURNITURE
    if name in MAIN_TAGS or inside != FORM and said & MAIN_WORDS:
        return MAIN
    return FORM if name == "form" else inside


def blocks(page: str) -> list[Block]:
    """A page's text blocks in order. Malformed markup is read leniently: an end
    tag closes what was opened within its element, one without a start tag and
    markup cut off by the page's end count for nothing."""
    out: list[Block] = []
    pieces: list[str] = []
    # Open block elements: name, place before it, label before it.
    opened: list[tuple[str, float, bool]] = []
    count: dict[str, int] = {}
    place, marked, link = NEITHER, False, False
    words = linked = 0

    def flush() -> None:
        nonlocal words, linked
        text = " ".join("".join(pieces).split())
        if text:
            total = text.count(" ") + 1
            out.append(Block(text, total, min(linked, total), place, marked))
        pieces.clear()
        words = linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = unescape(raw) if "&" in raw else raw
        pieces.append(text)
        if link:
            linked += len(text.split())

    def close(name: str) -> None:
        nonlocal place, marked, link
        while True:
            was, place, marked = opened.pop()
            count[was] -= 1
            if was == name:
                link = False
                return

    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        if lt > at:
            add(page[at:lt])
        follow = page[lt + 1:lt + 2]
        if follow == "!" or follow == "?":
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 2)
                at = size if end < 0 else end + 3
            else:
                end = page.find(">", lt)
                at = size if end < 0 else end + 1
            continue
        if follow == "/":
            end = page.find(">", lt)
            named = _NAME.match(page, lt + 2)
            at = size if end < 0 else end + 1
            if end < 0 or not named:
                continue
            name = named.group().lower()
            if name == "a":
                link = False
            elif name in BLOCK:
                flush()
                if count.get(name):
                    close(name)
            continue
        named = _NAME.match(page, lt + 1)
        if not named:
            add("<")
            at = lt + 1
            continue
        name, at, attributes = named.group().lower(), named.end(), {}
        while at < size and (m := _ATTRIBUTE.match(page, at)):
            at = m.end()
            attributes.setdefault(m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or "")
        end = page.find(">", at)
        if end < 0:
            break
        at = end + 1
        if name in HIDDEN:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = stop.start() if stop else size
        elif name == "a":
            link = True
        elif name == "br":
            add(" ")
        elif name in BLOCK:
            flush()
            if opened and (opened[-1][0] == "p" or opened[-1][0] == name and name in IMPLIED_END):
                close(opened[-1][0])
            if name not in VOID:
                opened.append((name, place, marked))
                count[name] = count.get(name, 0) + 1
                place = _place(name, attributes, place)
                marked = "data-main" in attributes or marked and "data-not" not in attributes
    flush()
    return out


def features(found: list[Block]) -> np.ndarray:
    """One row per block, columns as in ``FEATURES``; beyond a page's ends there
    are no words and no links."""
    own = np.array([[b.words, b.linked / b.words] for b in found], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    before, after = np.concatenate([edge, own])[:-1], np.concatenate([own, edge])[1:]
    return np.column_stack([own, before, after, [b.place for b in found]])


@dataclass(frozen=True)
class Tree:
    """A node: a leaf's ``label``, or a split at ``x[feature] <= limit``."""
    label: bool
    feature: int = -1
    limit: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.label)
        out = np.empty(len(x), bool)
        is_low = x[:, self.feature] <= self.limit
        out[is_low] = self.low.predict(x[is_low])
        out[~is_low] = self.high.predict(x[~is_low])
        return out


def fit_tree(x: np.ndarray, y: np.ndarray, depth: int = 5, least: int = 2) -> Tree:
    """Binary splits that lower the Gini impurity most, the first of equals;
    leaves of ``least`` rows or more, at most ``depth`` splits deep."""
    label = bool(y.mean() >= 0.5) if len(y) else False
    best = None
    if depth and 0 < y.sum() < len(y):
        impurity = lambda part: len(part) * part.mean() * (1 - part.mean())
        least_impure = impurity(y) - 1e-9
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for limit in (values[1:] + values[:-1]) / 2:
                low = x[:, f] <= limit
                if low.sum() < least or (~low).sum() < least:
                    continue
                now = impurity(y[low]) + impurity(y[~low])
                if now < least_impure - 1e-9:
                    least_impure, best = now, (f, float(limit), low)
    if best is None:
        return Tree(label)
    f, limit, low = best
    return Tree(label, f, limit, fit_tree(x[low], y[low], depth - 1, least), fit_tree(x[~low], y[~low], depth - 1, least))


@lru_cache(maxsize=1)
def default_tree() -> Tree:
    """The tree fitted on the pages of ``html_training``."""
    found = [blocks(page) for page in PAGES]
    x = np.concatenate([features(f) for f in found])
    return fit_tree(x, np.array([b.marked for f in found for b in f], float))


def main_text(page: str, tree: Tree) -> tuple[str, int, int]:
    """(text, blocks, kept blocks) of one page."""
    found = blocks(page)
    if not found:
        return "", 0, 0
    keep = tree.predict(features(found))
    return " ".join(b.text for b, k in zip(found, keep) if k), len(found), int(keep.sum())


def extract_main_text(pages: DataFrame, html_col: str = "html", out_col: str = "text", tree: Tree | None = None) -> DataFrame:
    """Adds ``out_col``, ``n_blocks`` and ``n_kept``: the main text of every
    row's whole page, and how many text blocks it has and how many were kept.

    Kept blocks come in page order, joined by one space; inside a block
    character references are decoded and white space is one space. Comments,
    scripts, styles and markup are never text. Each row is handled alone,
    without a shuffle, in time linear in its length. A null or empty page, and
    one without kept blocks, has an empty text; repeated rows are handled
    alike; other columns are kept, but input columns named like the new ones
    are replaced.
    """
    tree = tree or default_tree()
    raw = pages.select("*", F.col(f"`{html_col}`").alias("__html__"))
    kept = without(raw, out_col, "n_blocks", "n_kept")
    schema = StructType([
        *[f for f in kept.schema.fields if f.name != "__html__"], StructField(out_col, StringType(), False),
        StructField("n_blocks", LongType(), False), StructField("n_kept", LongType(), False),
    ])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                found = [main_text(page.as_py() or "", tree) for page in part.column("__html__")]
                made = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [c for c, n in zip(part.columns, part.schema.names) if n != "__html__"] + made, names=names
                )

    return kept.mapInArrow(run, schema)


def op12_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
