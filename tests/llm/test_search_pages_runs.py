"""Ranked search, main text of pages and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import html
import math
import os
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from strata.llm import html_extract, html_training, lexical_search, periodic_runs

SF = "/root/testdata/sf0.001"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x20\x09-\x0D]+"


def _terms(text):
    return re.findall(TERM, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _ranked(docs, items, k):
    held = [(i, c) for i, c in ((i, Counter(_terms(t))) for i, t in docs) if c]
    total, words = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(_terms(text))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, c in held:
            m = 100 - 50 + (50 * c.total() * total) // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                        * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            scored.append((-score, i is None, i or 0))
        best = sorted(s for s in scored if s[0] < 0)[:k]
        out += [(str(item), r, str(None if none else i), -s) for r, (s, none, i) in enumerate(best, 1)]
    return sorted(out)


def _found(df):
    return sorted((str(r.item_id), r["rank"], str(r.doc_id), r.score) for r in df.collect())


@pytest.fixture(scope="module")
def search_docs(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(30)] + ["Ärger", "été", "日本", "W3", "it's", "a-b_c"]
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 40)))) for i in range(150)]
    rows += [(i, "w1 w2 w3 w1") for i in range(200, 260)] + [(7, "w1 w2"), (7, "w1 w2"), (None, "w1 w5"), (None, None)]
    rows += [(300, None), (301, ""), (302, " .,-"), (303, "x" * 9_000_000 + " w4"), (304, "w6 " * 2_000_000), (305, "w7\u0000w8")]
    return rows, spark.createDataFrame([(i, t, "q", i) for i, t in rows],
                                       "doc_id long, text string, score string, n long").repartition(5)


ITEMS = [(1, "w1 W2 w1"), (2, "nothing known here"), (3, None), (4, ""), (5, " ".join(f"w{i}" for i in range(30))), (6, "ÄRGER été 日本"),
         (7, "w3"), (7, "w4 it"), (None, "w6 w7"), (8, "w8")]


@pytest.mark.parametrize("k,a_pass,a_block", [(50, 200_000, 2_000_000), (5, 3, 100), (1000, 10, 1)])
def test_search_against_every_score(spark, search_docs, k, a_pass, a_block):
    rows, docs = search_docs
    items = spark.createDataFrame([(i, t, "d") for i, t in ITEMS], "item_id long, text string, doc_id string")
    got = lexical_search.lexical_search(docs, items, k, terms_a_pass=a_pass, postings_a_block=a_block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert _found(got) == _ranked(rows, ITEMS, k)


def test_search_empty_tables(spark, search_docs):
    rows, docs = search_docs
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.lexical_search(docs.limit(0), items).count() == 0
    assert lexical_search.lexical_search(docs, items.limit(0)).count() == 0
    assert lexical_search.lexical_search(docs.where("doc_id in (300, 301, 302)"), items).count() == 0


def test_nra_reads_no_further_than_it_must():
    rng = np.random.default_rng(2)
    for k in (1, 7, 50):
        for first in (1, 16):
            lists, whole = [], np.zeros(4000, np.int64)
            for _ in range(5):
                who = rng.permutation(4000)[:rng.integers(50, 4000)]
                impact = np.sort((rng.pareto(1.2, len(who)) * 100).astype(np.int64) + 1)[::-1]
                lists.append((who, impact))
                whole[who] += impact
            docs, scores, read = lexical_search.nra(lists, 4000, k, 0, first)
            bar = np.sort(whole)[-k]
            assert sorted(docs.tolist()) == np.flatnonzero(whole >= bar).tolist()
            assert (scores == whole[docs]).all()
            if k == 1 and first == 1:
                assert read < sum(len(w) for w, _ in lists)
            again = lexical_search.nra(lists, 4000, k, int(bar), first)
            assert sorted(again[0].tolist()) == sorted(docs.tolist()) and again[2] <= read
    assert lexical_search.nra([(np.array([2, 0]), np.array([5, 5]))], 3, 9)[0].tolist() == [0, 2]


def test_op11_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert _found(lexical_search.op11_lexical_search(spark, SF)) == _ranked(docs, items, 50)


LAYOUTS = {
    "": "", "plain text only, and little of it": "",
    "<p>&lt;a&gt; &amp &copy &nosuch; x</p>" + "<article><p>1 &lt; 2 &amp; 3&#8364; &eacute;t&eacute;\n\t&nbsp; end</p></article>": "1 < 2 & 3€ été end",
    "<nav><a href=/>Home</a></nav><article>One<p>two<br>three<b>four</b><!-- <p>no</p> --></p><script>var t='</p>';</script>"
    "<ul><li>five</ul><aside>six</aside></article><footer>seven</footer>": "One two threefour five",
    "<main><h1>T</h1><form>in<button>b</button></form><p>kept</p><div class='comments'><p>said</p></div></main>": "T kept",
    "<article><p>cut off <b>here &am": "cut off here &am", "<article><p>cut off</p><p class='x": "cut off",
    "<article><header><h1>Head</h1></header><p title='a > b'>x</p></article><header>site</header>": "Head x",
    "<form><article><p>inside a form</p></article><p>and the rest of it</p></form>": "inside a form",
    "<ARTICLE><P>upper</P></ARTICLE><Div Class=\"AD\">no</Div>": "upper",
    "<article><p>a</article></div></p><footer>z</footer>": "a", "<article></p></div><p>b</p></nav>c</article>": "b c",
    "<div hidden><article><p>unseen</p></article></div><article style='display: none'>x</article>": "",
    "<nav><article><a href=x>teaser</a></article></nav><article>3 <4 and 5 < 6 </ 7></article>": "3 <4 and 5 < 6",
}


def test_main_text_of_layouts(spark):
    rows = [(i, page, "t", "n") for i, page in enumerate(LAYOUTS)] + [(None, None, None, None), (0, "", "t", "n"), (1, None, "t", "n")]
    table = spark.createDataFrame(rows, "page_id long, html string, TEXT string, n_kept string")
    got = html_extract.extract_main_text(table)
    assert got.columns == ["page_id", "html", "text", "n_blocks", "n_kept"]
    for r in got.collect():
        assert r.text == LAYOUTS.get(r.html or "", ""), r
    assert got.count() == len(rows)
    assert html_extract.extract_main_text(table.limit(0)).count() == 0


@pytest.mark.parametrize("page", ["<b>" * 200_000, "<div>" * 200_000, '<a href="x' * 50_000, "<!--" * 200_000, "<script>" * 100_000,
                                  "</div>" * 200_000, "<" * 300_000, "<div><p>" * 50_000 + "</div>" * 50_000, "&amp;" * 300_000])
def test_long_malformed_pages(page):
    tree = html_extract.default_tree()
    assert isinstance(html_extract.main_text(page, tree)[0], str)
    assert html_extract.main_text("<article>" + "word " * 400_000 + "</article>", tree)[0].count("word") == 400_000


def test_tree_on_pages_left_out():
    """Each training page in turn is classified by a tree fitted on the others."""
    found = [html_extract.blocks(p) for p in html_training.PAGES]
    x, y = [html_extract.features(f) for f in found], [np.array([b.marked for b in f], float) for f in found]
    right = total = 0
    for k in range(len(found)):
        rest = [i for i in range(len(found)) if i != k]
        tree = html_extract.fit_tree(np.concatenate([x[i] for i in rest]), np.concatenate([y[i] for i in rest]))
        right += int((tree.predict(x[k]) == y[k]).sum())
        total += len(y[k])
    assert right >= 0.85 * total, (right, total)


def test_op12_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = html_extract.op12_html_extract(spark, SF).collect()
    assert len(got) == len(pages) and got[0].__fields__[:4] == ["page_id", "url", "text", "n_chars"]
    for r in got:
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id].html, re.S).group(1)
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inside)).split())
        assert (r.text, r.n_chars, r.url) == (want, len(want), pages[r.page_id].url)


def _plain_runs(w, least=12):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        s = 0
        while s + q < len(w):
            e = s
            while e + q < len(w) and w[e] == w[e + q]:
                e += 1
            if e + q - s >= max(least, 2 * q):
                out.setdefault((s, e + q - s), q)
            s = e + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_against_every_period():
    r = random.Random(1)
    for _ in range(3000):
        k, n = r.choice([1, 2, 2, 3, 5]), r.randrange(0, 70)
        w = [b"%d" % r.randrange(k) for _ in range(n)]
        if r.random() < 0.5 and n > 5:
            a = r.randrange(n)
            p = 1 + r.randrange(n - a)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        least = r.choice([2, 3, 5, 12])
        assert periodic_runs.runs_of(w, least) == _plain_runs(w, least), (w, least)
    fib, last = [b"a", b"b"], [b"a"]
    while len(fib) < 1500:
        fib, last = fib + last, fib
    assert periodic_runs.runs_of(fib) == _plain_runs(fib)
    assert periodic_runs.runs_of([b"x"] * 100_000) == [(0, 100_000, 1)]
    assert periodic_runs.runs_of([b"%d" % (i % 777) for i in range(100_000)]) == [(0, 100_000, 777)]


def _op13(doc_id, text):
    w = re.findall(WORD, text or "")
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = _plain_runs(w)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    return (str(doc_id), len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def _op13_rows(df):
    return sorted(((str(r.doc_id), *tuple(r)[1:]) for r in df.collect()), key=str)


def test_op13_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = periodic_runs.op13_periodic_runs(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert _op13_rows(got) == sorted((_op13(r.doc_id, r.text) for r in docs), key=str)


def test_op13_awkward_texts(spark, scratch_dir):
    r = random.Random(9)
    texts = ["", None, " \t\n\r\x0b\x0c ", "a a a a", "a " * 40, "a b " * 6, "a b c d e f " * 2, "a b c d e f g " * 2 + "h",
             "日本 語 " * 9, "x y z " * 4 + "x q " + "x y z " * 5, "\u0000 " * 13, " ".join(r.choices("ab", k=2000))]
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0][:len(texts)]
    rows = [(i, t) for i, t in zip(ids, texts)] + [(i + 4000, t) for i, t in enumerate(texts)] + [(None, t) for t in texts]
    rows += rows[:5]
    table = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, runs int, best int")
    table.write.parquet(f"{scratch_dir}/documents.parquet")
    assert _op13_rows(periodic_runs.op13_periodic_runs(spark, scratch_dir)) == sorted((_op13(i, t) for i, t in rows), key=str)
    found = periodic_runs.periodic_runs(table)
    assert found.columns == ["doc_id", "text", "best", "n_words", "runs", "collapsed"]
    assert periodic_runs.periodic_runs(table.limit(0)).count() == 0
