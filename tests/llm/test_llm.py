"""Corpus operators against brute force on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import os
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from strata.llm import ann, bpe, embed_dedup, mixing, pii, sharding, simhash, substring_dedup, suffix_dedup, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, runs string, h string, id string"
WORDS = [f"w{i}" for i in range(40)]


def _text(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


PASSAGE = _text(99, 45)
TEXTS = [
    (1, _text(1, 60)), (2, ""), (3, None), (4, PASSAGE), (5, _text(5, 30) + " " + PASSAGE + " " + _text(6, 25)),
    (6, _text(1, 60)), (7, "  \t\n"), (8, "mail a.b@c.de and a@b.c_d@e.f, +49 (30) 123-4567"), (9, "ip 10.0.0.256 1.2.3.4 card 4111 1111 1111 1111"),
    (10, "x" * 400), (11, "日本 " * 150 + "é" * 130), (12, _text(1, 59) + " other"), (4, PASSAGE), (None, _text(77, 30)),
    (None, PASSAGE), (13, "IBAN GB82 WEST 1234 5698 7654 32 end"), (14, "a b"), (15, "A B"), (16, "ab " * 900),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "hot" if k % 3 else None, 0, "r", "h", "z") for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, DOCS).repartition(4)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def _removed(units, key, window):
    """(id, text) -> covered flags, for distinct documents in order. Rows alike
    in id and text are one document."""
    seen, out = set(), {}
    for doc in key:
        u = units(doc[1])
        flags = [False] * len(u)
        for o in range(len(u) - window + 1):
            w = tuple(u[o:o + window])
            if w in seen:
                flags[o:o + window] = [True] * window
            seen.add(w)
        out[doc] = (u, flags)
    return out


def _in_order():
    named = [d for d in dict.fromkeys(TEXTS) if d[0] is not None]
    # The two rows with a null id come last; which of them first does not
    # matter here, as they share no text.
    return sorted(named, key=lambda d: d[0]) + [d for d in dict.fromkeys(TEXTS) if d[0] is None]


def test_substring_dedup(docs, none):
    want = _removed(lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or ""), _in_order(), 20)
    got = substring_dedup.substring_dedup(docs).collect()
    assert len(got) == len(TEXTS)
    expect = sorted((str(i), len(want[i, t][0]), sum(want[i, t][1]),
                     " ".join(w for w, d in zip(*want[i, t]) if not d)) for i, t in TEXTS)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got) == expect
    assert substring_dedup.substring_dedup(none).count() == 0


def test_suffix_dedup(docs, none):
    want = _removed(lambda t: (t or "").encode(), _in_order(), 100)
    got = suffix_dedup.suffix_dedup(docs).collect()
    expect = sorted((str(i), len(want[i, t][0]), bytes(b for b, d in zip(*want[i, t]) if not d)) for i, t in TEXTS)
    assert sorted((str(r.doc_id), r.n_bytes, bytes(r.kept)) for r in got) == expect
    assert suffix_dedup.suffix_dedup(none).count() == 0


def test_collection_transform_is_that_of_sorted_suffixes():
    r = random.Random(3)
    for _ in range(60):
        strings = [bytes(r.choice(b"ab") for _ in range(r.randint(1, 12))) for _ in range(r.randint(1, 6))]
        bwt, lcp = suffix_dedup.collection_bwt(strings)
        suffixes = sorted(
            ([(c, 0) for c in s[i:]] + [(-1, k)], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1))
        assert bwt.tolist() == [strings[k][i - 1] + 1 if i else 0 for _, k, i in suffixes]
        shared = [0]
        for (a, *_), (b, *_) in zip(suffixes, suffixes[1:]):
            shared.append(next(n for n, (x, y) in enumerate(zip(a, b)) if x != y))
        assert lcp.tolist() == shared


@pytest.mark.parametrize("limit", [2, 7, 1000])
def test_hot_anchors_are_split_without_loss(limit):
    r = random.Random(4)
    core = bytes(r.choice(b"abcdefgh") for _ in range(90))
    strings = [bytes(r.choice(b"xy") for _ in range(20)) + core + bytes(r.choice(b"xy") for _ in range(20)) for _ in range(30)]
    group, place = np.zeros(len(strings), np.int64), np.full(len(strings), 50)
    got = suffix_dedup.repeated_by_columns(strings, group, place, 100, limit)
    seen, want = set(), []
    for s in strings:
        want.append([])
        for o in range(len(s) - 99):
            want[-1].append(s[o:o + 100] in seen)
            seen.add(s[o:o + 100])
    # Only windows that hold the anchor are the pieces' own; here all do.
    assert [g.tolist() for g in got] == want


def test_tree_groups_split_by_longer_prefixes():
    pieces = [f"a b c {i % 3} e f".encode() for i in range(9)]
    for limit in (2, 3, 100):
        got = substring_dedup.repeated_by_trees(pieces, np.zeros(9, np.int64), np.zeros(9, np.int64), 4, limit)
        seen, want = set(), []
        for p in pieces:
            w = p.split()
            want.append([])
            for o in range(3):
                want[-1].append(tuple(w[o:o + 4]) in seen)
                seen.add(tuple(w[o:o + 4]))
        assert [g.tolist() for g in got] == want


def _fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(docs, none):
    codes = [_fingerprint(t) for _, t in TEXTS]
    group = list(range(len(TEXTS)))
    for a in range(len(TEXTS)):
        for b in range(a):
            if (codes[a] ^ codes[b]).bit_count() <= 3:
                group = [group[b] if g == group[a] else g for g in group]
    least = {}
    for g, (i, _) in zip(group, TEXTS):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    got = sorted((str(r.id), r.fingerprint % 2**64, str(r.component_id)) for r in simhash.simhash_groups(docs).collect())
    assert got == sorted((str(i), c, str(least[g])) for (i, _), c, g in zip(TEXTS, codes, group))
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(group))
    assert simhash.simhash_groups(none).count() == 0


def test_links_up_to_three_bits(spark):
    r = random.Random(8)
    base = [r.getrandbits(64) for _ in range(40)]
    codes = {c ^ sum(1 << b for b in r.sample(range(64), k)) for c in base for k in range(6)}
    signed = [c - 2**64 if c >= 2**63 else c for c in codes]
    got = {frozenset((x.a, x.b)) for x in simhash.fingerprint_links(
        spark.createDataFrame([(c,) for c in signed], "fingerprint long")).collect()}
    want = {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 3}
    assert got == want


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 16))
    near = base[:25] + 0.05 * rng.standard_normal((25, 16))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(np.concatenate((base, near, base[:5], 2 * base[:5])))]
    rows += [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (503, [None] * 16), (504, []),
             (505, [float("inf")] * 16), (None, rows[0][1]), (506, [1.0, 2.0])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def _cosines(rows):
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    return x @ x.T


def _good(vectors):
    return [(r.vec_id, r.embedding) for r in vectors.collect()
            if r.vec_id is not None and r.vec_id < 500]


@pytest.mark.parametrize("block", [4, 1024])
def test_embedding_groups(spark, vectors, block):
    rows = _good(vectors)
    s = _cosines(rows) >= 0.95
    links = {i: int(s[k].sum()) - 1 for k, (i, _) in enumerate(rows)}
    label = {i: i for i, _ in rows}
    for _ in rows:
        for k, (i, _) in enumerate(rows):
            label[i] = min(label[rows[j][0]] for j in np.flatnonzero(s[k]))
    got = {r.id: r for r in embed_dedup.embedding_groups(vectors, 0.95, block=block).collect()}
    assert len(got) == vectors.count()
    assert {i: got[i].n_links for i in links} == links
    assert {i: got[i].component_id for i in label} == label
    assert all(got[i].n_links == 0 and got[i].kept for i in (500, 501, 502, 503, 504, 505, 506))


def test_nearest(spark, vectors):
    rows = _good(vectors)
    s = _cosines(rows)
    got = ann.nearest(vectors.where("vec_id % 10 = 0"), vectors, 5).collect()
    hit = total = 0
    for k, (q, _) in enumerate(rows):
        if q % 10:
            continue
        best = sorted((-round(float(s[k, j]), 9), i) for j, (i, _) in enumerate(rows) if j != k)[:5]
        own = sorted((r.rank, r.vec_id) for r in got if r.query_id == q)
        assert [r for r, _ in own] == [1, 2, 3, 4, 5]
        hit += len({i for _, i in best} & {i for _, i in own})
        total += 5
    assert hit >= 0.9 * total
    few = vectors.where("vec_id in (0, 1, 2)")
    assert ann.nearest(few, few, 5).count() == 6
    assert ann.nearest(few.limit(0), few, 5).count() == 0


def test_nearest_with_repeated_ids(spark, vectors):
    def answers(queries, rows, probes):
        found = ann.nearest(queries, rows, 5, probes=probes).collect()
        return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in found)

    some = vectors.where("vec_id % 10 = 0")
    twice = vectors
    for _ in range(2):
        twice = twice.union(twice)
    for probes in (4, 1 << 30):
        assert answers(some, twice, probes) == answers(some, vectors, probes)
    rows = [(q, v) for q, v in ((r.vec_id, r.embedding) for r in vectors.where("vec_id < 40").collect())
            if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    size = max({len(v) for _, v in rows}, key=[len(v) for _, v in rows].count)
    rows = [(q % 9, v) for q, v in rows if len(v) == size]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    query = spark.createDataFrame([(100, rows[0][1])], table.schema)
    best = {}
    for i, v in rows:
        score = float(np.dot(v, rows[0][1]) / np.linalg.norm(v) / np.linalg.norm(rows[0][1]))
        best[i] = max(score, best.get(i, -2.0))
    want = sorted(best.items(), key=lambda p: (-round(p[1], 9), p[0]))[:5]
    assert answers(query, table, 1 << 30) == sorted((100, r, i, round(s, 9)) for r, (i, s) in enumerate(want, 1))


@pytest.mark.parametrize("most", [ann.MAX_BROADCAST, 0])
def test_nearest_deals_hot_buckets_out(spark, vectors, monkeypatch, most):
    """Buckets in parts of rows and of queries give the answers of whole ones; ties by id."""
    some = vectors.where("vec_id % 5 = 0")
    rows = vectors.union(vectors.withColumn("vec_id", F.col("vec_id") + 10_000))

    def answers():
        found = ann.nearest(some, rows, 5, tables=4, probes=200).collect()
        return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found)

    whole = answers()
    monkeypatch.setattr(ann, "ROWS_PER_SALT", 7)
    monkeypatch.setattr(ann, "QUERIES_PER_SALT", 3)
    monkeypatch.setattr(ann, "MAX_BROADCAST", most)
    assert answers() == whole
    scores = {}
    for query, rank, vec, score in whole:
        scores.setdefault(query, []).append((-score, vec))
    assert all(own == sorted(own) for own in scores.values())


def test_answers_do_not_depend_on_the_number_of_rows(spark, monkeypatch):
    """Rows that no query is compared with change no answer, however many they are."""
    monkeypatch.setattr(ann, "PROBES", 60)
    rng = np.random.default_rng(4)
    shape = "vec_id long, embedding array<double>"
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 16)))], shape)
    others = spark.createDataFrame([(1000 + i, v.tolist()) for i, v in enumerate(rng.standard_normal((5000, 2)))], shape)
    some = rows.where("vec_id % 10 = 0")

    def answers(table):
        return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(some, table, 5).collect())

    assert answers(rows.union(others)) == answers(rows)


def test_rows_as_near():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((200_000, 16))
    cos = np.sort(x[:, 0] / np.linalg.norm(x, axis=1))[::-1]
    for n in (2_000, 20_000, 200_000):
        s = float(np.median(cos.reshape(-1)[:5 * 200_000 // n][-1:]))
        assert 0.5 * n < ann.rows_as_near(s, 16, 5) < 2 * n
    assert ann.rows_as_near(1.0, 16, 5) > 1e50 and ann.probes_for(ann.rows_as_near(1.0, 16, 5)) == ann.TABLES
    assert ann.rows_as_near(-1.0, 2, 5) == pytest.approx(5)


def test_probes_fall_with_the_rows():
    """Work of a query: its share of the rows falls as the table grows, on random vectors too."""
    rng = np.random.default_rng(5)
    shares = []
    for n in (1000, 8000):
        x = rng.standard_normal((n, 64))
        codes, cells = ann.own_cells(x, ann.TABLES, ann.SEED)
        held = Counter((c, e) for own in zip(codes, cells) for c, e in zip(*own))
        codes, cells = ann.probed_cells(x[:50], ann.TABLES, ann.probes_for(n), ann.SEED)
        assert all(sum(map(len, e)) == ann.probes_for(n) for e in cells)
        shares.append(sum(held[c, e] for C, E in zip(codes, cells) for c, some in zip(C, E) for e in some) / 50 / n)
    assert shares[1] < 0.6 * shares[0] and shares[1] < 0.2
    assert ann.probes_for(10**9) < 40 and ann.probes_for(10**12) == ann.TABLES


def test_subtrees_have_the_nodes_of_a_suffix_tree():
    """Equal pieces among them: each deep node nearest to the root, by its leaves and its depth."""
    rng = random.Random(8)
    for _ in range(60):
        width = rng.randint(2, 4)
        pieces = [[rng.randint(1, 2) for _ in range(rng.randint(width, 9))] for _ in range(rng.randint(1, 7))]
        pieces += rng.choices(pieces, k=2)
        suffixes = [p[i:] for p in pieces for i in range(len(p) - width + 1)]
        words = np.array([w for p in pieces for w in p], np.uint32)
        ends = np.cumsum([len(p) for p in pieces])
        at = np.array([e - len(p) + i for p, e in zip(pieces, ends) for i in range(len(p) - width + 1)])
        stop = np.array([e for p, e in zip(pieces, ends) for _ in range(len(p) - width + 1)])
        order, first, depth = substring_dedup._subtree(words, at, stop, 0, width)
        got = {}
        for leaves, d in zip(np.split(order, first[1:]), depth):
            if len(leaves) > 1:
                got[tuple(sorted(leaves.tolist()))] = int(d)
        want = {}
        for head in {tuple(s[:width]) for s in suffixes}:
            leaves = tuple(i for i, s in enumerate(suffixes) if tuple(s[:width]) == head)
            if len(leaves) > 1:
                want[leaves] = len(os.path.commonprefix([suffixes[i] for i in leaves]))
        assert got == want
        text = [b" ".join(b"%d" % w for w in p) for p in pieces]
        none = np.zeros(len(pieces), np.int64)
        seen = set()
        flags = [s in seen or seen.add(s) is not None for s in (tuple(s[:width]) for s in suffixes)]
        for limit in (1, 3, 1 << 16):
            assert np.concatenate(substring_dedup.repeated_by_trees(text, none, none, width, limit)).tolist() == flags


@pytest.mark.parametrize("subtree", [2, 40, 1 << 16])
def test_prefixes_grow_under_a_hot_phrase(spark, subtree):
    """A phrase that all documents hold in contexts of their own and in shared ones: groups split, nothing lost."""
    rng = random.Random(4)
    shared = " ".join(rng.choices(WORDS, k=30))
    texts = []
    for i in range(120):
        own = [f"u{i}_{j}" for j in range(25)]
        middle = shared if i % 3 == 0 else " ".join(rng.choices(WORDS[:3], k=24))
        texts.append(" ".join([*own[:12], "all rows say this", middle, "all rows say this", *own[12:]]))
    texts += texts[:5]
    seen, want = set(), {}
    for i, t in enumerate(texts):
        words = t.split()
        gone = [False] * len(words)
        for j in range(len(words) - 19):
            head = tuple(words[j:j + 20])
            if head in seen:
                gone[j:j + 20] = [True] * 20
            seen.add(head)
        want[i] = (" ".join(w for w, g in zip(words, gone) if not g), sum(gone))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.kept_text, r.n_removed) for r in substring_dedup.substring_dedup(df, subtree=subtree).collect()}
    assert got == want and any(n for _, n in want.values())


def test_bpe_round_trip(docs, none):
    import base64

    import public_tokenizers
    import tiktoken

    path = bpe.vocabulary_path()
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(path, "rb"))}
    whole = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.bpe_decode(bpe.bpe_encode(docs, chunk=16, overlap=4)).collect()
    for r in got:
        assert r.token_ids == whole.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert bpe.bpe_encode(none).count() == 0


def _whole_encoding():
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(bpe.vocabulary_path(), "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_chunks_are_stitched_as_the_whole():
    whole, path = _whole_encoding(), bpe.vocabulary_path()
    r = random.Random(1)
    parts = ["a", " ", "  ", "\n", "\r\n", "\t", "\u00a0", "\u2003", "\u3000", "\u2028", "'s", "'ll", "é", "1", "!!", "日本", "'", "x" * 9,
             "\u0301", "\u200b"]
    cuts = 0
    for k in range(100_000):
        s = "".join(r.choices(parts, k=r.randint(0, 60)))
        chunk = r.choice((4, 7, 16, 64))
        assert bpe.encode_text(s, path, chunk, r.randint(1, 12)) == whole.encode_ordinary(s), (k, s)
    # Runs of white space across the end of a chunk of the default size.
    for run in ("  \u00a0", "\u00a0\u00a0 ", " \t", "\r\n\r\n", "\u3000 \u3000", " " * 600, "z" * 70_000, "'"):
        for shift in range(-3, 4):
            s = "word " * (bpe.CHUNK_CHARS // 5) + "w" * (3 + shift) + run + "a" + " more words" * 9000
            assert bpe.encode_text(s, path) == whole.encode_ordinary(s), (run, shift)
            cuts += len(bpe.stitched_cuts(bpe._encoder(path)[1], s)) - 2
    assert cuts > 100
    assert bpe.encode_text("y" * 300_000, path, 64, 8) == whole.encode_ordinary("y" * 300_000)


def test_op10_query(spark):
    sf, whole = "/root/testdata/sf0.001", _whole_encoding()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = bpe.op10_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = whole.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def _plain_spans(text):
    out = []

    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0

    for kind, pattern, ok in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(re.sub("[^0-9]", "", v)) <= 19 and luhn(re.sub("[^0-9]", "", v))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(re.sub("[^0-9]", "", v)) <= 15),
    ):
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text, re.ASCII) if ok(m.group())]
    return out


def test_pii_base_spans(spark, docs, none):
    r = random.Random(2)
    pieces = ["4111111111111111", "4111 1111-1111 1111", "12", "1.2.3.4", "999.1.1.1", "0001.2.3.4.5.6.7.8", "a@b.c", "a.b@c.d_e@f.gh",
              "+1 (555) 123-4567", "+", "@", ".", "-", " ", "日", "x", "5", "+49", "%", "a@b", "..", "\u0001"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(1, 14))) for _ in range(400)]
    texts += ["", None, "1 " * 30_000, "a" * 60_000 + "@b.c", "+" + "1" * 50_000, "7" * 50_000]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, pii string")
    for row in pii.find_pii(df).collect():
        base = [(s.kind, s.start, s.end) for s in row.pii if s.kind in pii.BASE_KINDS]
        assert base == _plain_spans(texts[row.doc_id] or ""), texts[row.doc_id]
    found = {r.doc_id: [s.kind for s in r.pii] for r in pii.find_pii(docs).collect()}
    assert found[13] == ["iban"] and found[9] == ["ip", "card"]
    masked = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert masked[9] == "ip 10.0.0.256 <IP> card <CARD>" and masked[3] is None and masked[2] == ""
    assert pii.find_pii(none).count() == 0


def test_pii_ends_and_labels_behind(spark):
    iban = "DE89 3704 0044 0532 0130 00"
    texts = {
        f"IBAN {iban} BIC COBADEFFXXX": [("iban", iban)], f"{iban} EUR 500, thanks": [("iban", iban)],
        f"REF AB12 {iban} BIC": [("iban", iban)], f"NO12 {iban} {iban} X": [("iban", iban), ("iban", iban)],
        "pay NO9386011117947 NOK": [("iban", "NO9386011117947")], "GB82WEST12345698765432 EUR": [("iban", "GB82WEST12345698765432")],
        "IBAN DE89 3704 0044 0532 0130 01 BIC": [], f"日本{iban}X": [],
        "123-45-6789 (SSN)": [("ssn", "123-45-6789")], "the social security number 123-45-6789": [("ssn", "123-45-6789")],
        "123-45-6789 " + "x" * 40 + " SSN": [], "part 123-45-6789": [],
    }
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in pii.find_pii(df).collect():
        spans = [(s.kind, row.text[s.start:s.end]) for s in row.pii if s.kind not in pii.BASE_KINDS]
        assert spans == texts[row.text], row
    masked = {r.text for r in pii.redact(df).collect()}
    assert {"IBAN <IBAN> BIC COBADEFFXXX", "<IBAN> EUR 500, thanks", "<SSN> (SSN)"} <= masked


def test_shards(docs, none):
    got = sharding.shard_by_bytes(docs, 3).collect()
    sizes = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    assert sorted((str(r.id), r["size"], r.text_crc32) for r in got) == sizes
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert all(sorted(r.slot for r in rows) == list(range(len(rows))) for rows in by.values())
    total, largest = sum(s for _, s, _ in sizes), max(s for _, s, _ in sizes)
    assert all(abs(sum(r["size"] for r in by.get(k, [])) - total / 3) <= largest for k in range(3))
    assert sharding.shard_by_bytes(none, 3).count() == 0


def test_a_hot_text_is_cut_between_documents(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(
        F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    sums = sharding.shard_by_bytes(rows, 8).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert len(sums) == 8 and max(r.s for r in sums) - min(r.s for r in sums) <= 40


@pytest.mark.parametrize("n_shards,tolerance", [(3, 0.01), (8, 0.01), (8, 0.2), (40, 0.3), (5, 0.0)])
def test_shards_equal_a_cut_by_hand(spark, n_shards, tolerance):
    """Targets moved one by one on the ordered texts, against the operator's cut."""
    texts = ["hot"] * 400 + ["b" * 90] * 60 + [f"text {i} " + "x" * (i * 37 % 200) for i in range(300)] + ["z" * 3000, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    text = F.coalesce("text", F.lit(""))
    order = df.select("doc_id", text.alias("t"), F.xxhash64(text).alias("h"),
                      F.xxhash64("doc_id", F.lit("slice")).alias("g")).collect()
    order = sorted(order, key=lambda r: (r.h % 2**64 >> 52, r.h, r.g % 2**64 >> 58, r.g, r.doc_id))
    size = [len(r.t.encode()) + 1 for r in order]
    ends = np.cumsum(size)
    total = int(ends[-1])
    groups = {}
    for i, r in enumerate(order):
        groups.setdefault(r.t, []).append(i)
    spans = [(int(ends[g[0]]) - size[g[0]], int(ends[g[-1]])) for g in groups.values()]
    assert all(g == list(range(g[0], g[-1] + 1)) for g in groups.values())
    cuts = []
    for k in range(1, n_shards):
        target = k * total / n_shards
        for a, b in spans:
            near, end = min((target - a, a), (b - target, b))
            if a < target < b and near <= tolerance * total / n_shards:
                target = end
                break
        cuts.append(target)
    middles = [e - s / 2 for e, s in zip(ends.tolist(), size)]
    want = {r.doc_id: sum(m >= c for c in cuts) for r, m in zip(order, middles)}
    got = {r.id: r.shard for r in sharding.shard_by_bytes(df, n_shards, tolerance=tolerance).collect()}
    assert got == want


def test_mixing(spark, docs, none):
    n = 4000
    rows = spark.range(n).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("0123456789 "), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 4 == 0, "rare").otherwise("common").alias("source"), F.lit(1).alias("copy_no"))
    weights = spark.createDataFrame([("rare", 3.0), ("common", 1.0)], "source string, weight double")
    got = mixing.poisson_mix(rows, weights)
    shares = {r.source: r.b for r in got.groupBy("source").agg(F.sum(F.octet_length("text")).alias("b")).collect()}
    total = sum(shares.values())
    assert abs(shares["rare"] / total - 0.75) < 0.03
    assert abs(total / rows.agg(F.sum(F.octet_length("text"))).first()[0] - 1) < 0.06
    again = mixing.poisson_mix(rows.repartition(7), weights)
    assert got.exceptAll(again).isEmpty() and again.exceptAll(got).isEmpty()
    # The counts follow the distribution: mean 3, so about exp(-3) of the rare are left out.
    kept = got.where("source = 'rare'").select("doc_id").distinct().count()
    assert abs(kept / (n / 4) - (1 - np.exp(-3))) < 0.03
    high = mixing.poisson_mix(rows.where("doc_id < 40"), None, budget=200.0)
    assert abs(high.count() / (40 * 200) - 1) < 0.1
    assert mixing.poisson_mix(none).count() == 0
    assert mixing.poisson_mix(docs).columns == [*docs.columns, "copy_no", "shuffle_key"]


def test_maximal_segments_match_the_definition():
    def by_definition(s, lo, hi):
        best = max(((sum(s[a:b]), -(b - a), -a) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        a = -best[2]
        b = a - best[1]
        return by_definition(s, lo, a) + [(a, b, best[0])] + by_definition(s, b, hi)

    r = random.Random(6)
    for _ in range(150):
        s = [r.choice([-5, -3, -2, -1, 1, 2, 4, 7]) + r.random() / 100 for _ in range(r.randint(0, 14))]
        got = toxicity.maximal_segments(s)
        want = by_definition(s, 0, len(s))
        assert [x[:2] for x in got] == [x[:2] for x in want]


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    scored = toxicity.op3_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    assert scored.count() == 10_000
    found = [r for r in rows if r.predicted]
    assert sum(r.toxic for r in found) >= 0.9 * len(found)
    assert len([r for r in found if r.toxic]) >= 0.7 * sum(r.toxic for r in rows)


def test_weak_toxic_evidence_counts(spark):
    model = toxicity.ToxicityModel({"foul": 2.3, "vile": 3.0}, 1.0, 1.0)
    values = [toxicity.evidence(t, model)[0] for t in ("", "plain", "foul", "vile", "foul vile")]
    assert not toxicity.evidence("vile", model)[1] and toxicity.evidence("foul vile", model)[1]
    assert values[1] < values[2] < values[3] < values[4] and values[2] > 0
    c0, c1 = np.array([0.0, 0.0, 300.0, 40.0]), np.array([2.0, 40.0, 0.0, 5.0])
    odds = toxicity.shrunken_log_odds(c0, c1, 2661, 329)
    assert odds[1] > odds[0] > 1 and odds[2] < -1 and odds[3] == 0
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").select("doc_id")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    found = toxicity.op3_toxicity(spark, sf).where("held_out").join(labels, "doc_id").join(docs, "doc_id")
    shares = {r.lang: r.share for r in found.groupBy("lang").agg(F.avg("predicted").alias("share")).collect()}
    assert len(shares) == 4 and min(shares.values()) >= 0.5, shares


def test_rare_toxic_words_score_at_any_size(spark, monkeypatch):
    ids = [i for i in range(13_000) if zlib.crc32(str(i).encode()) % 4 != 2]
    toxic = set(ids[::10])
    rare = set(sorted(toxic)[:4])
    rows = [(i, f"some plain words n{i % 7}" + (" vile vile" if i in rare else "") + (" foul" if i in toxic and i % 3 else ""))
            for i in ids]
    docs = spark.createDataFrame(rows + [(-1, None), (-2, ""), (-3, rows[0][1])], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in ids], "doc_id long, toxic int")
    held = toxicity.train_toxicity(docs, labels)
    assert held.rare is None and held.scores["vile"] > 1 and held.scores["foul"] > held.scores["vile"]
    want = {r.doc_id: r for r in toxicity.score_toxicity(docs, held).collect()}
    assert min(want[i].toxicity for i in rare) > max(want[i].toxicity for i in ids if i not in toxic)
    monkeypatch.setattr(toxicity, "HELD_SCORES", 1)
    joined = toxicity.train_toxicity(docs, labels)
    assert joined.rare is not None and len(joined.scores) <= 1
    assert (joined.rate, joined.scale) == pytest.approx((held.rate, held.scale), rel=1e-9)
    got = toxicity.score_toxicity(docs, joined).collect()
    assert len(got) == len(rows) + 3 and got[0].__fields__ == want[-1].__fields__
    for r in got:
        assert r.toxicity == pytest.approx(want[r.doc_id].toxicity, rel=1e-9)
        assert [x[:2] for x in r.toxic_passages] == [x[:2] for x in want[r.doc_id].toxic_passages]


def test_toxicity_edges(spark, docs, none):
    labels = spark.createDataFrame([(1, None), (None, 1), (4, 0), (4, 0), (999, 1)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, labels)
    out = toxicity.score_toxicity(docs, model)
    assert out.count() == len(TEXTS) and out.select("toxicity").distinct().count() == 1
    assert toxicity.score_toxicity(none, toxicity.train_toxicity(none, labels)).count() == 0


def test_pipeline_stages_against_their_operators(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        after = docs.collect()
        assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars"} and after
        assert {r.doc_id for r in after} <= set(before), name
        if name == "simhash_near_dedup":
            codes = {r.doc_id: _fingerprint(r.text) for r in after}
            assert all((codes[a] ^ codes[b]).bit_count() > 3 for a in codes for b in codes if a < b)
            gone = set(before) - set(codes)
            every = {i: _fingerprint(t) for i, t in before.items()}
            assert all(any(i != j and (every[i] ^ every[j]).bit_count() <= 3 for j in every) for i in gone)
        if name == "pii":
            assert not any(_plain_spans(r.text) for r in after)
    whole = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.decoded_sha256) for r in whole) == sorted(
        (r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in docs.collect())


# Names that the operators use inside, or did.
WORKING_NAMES = ("_id", "_toxic", "_source", "_me", "_root", "_found_email", "_spans_iban", "_n", "_cdf", "_draws", "_code", "_least",
                 "_again", "_fingerprint", "_rare", "_key", "_text", "__w0", "__W1", "__w2", "fingerprint", "root", "row", "id", "h", "g",
                 "bucket", "part", "size", "shard", "token", "tokens", "runs")


def test_callers_columns_survive(spark, docs):
    own = docs.select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(f"own {c}").alias(c) for c in WORKING_NAMES])
    labels = spark.createDataFrame([(1, 0), (4, 1), (5, 1), (12, 0), (16, 0)], "doc_id long, toxic int").withColumn("_id", F.lit(1))
    made = {
        "toxicity": toxicity.score_toxicity(own, toxicity.train_toxicity(own, labels)),
        "simhash": simhash.keep_one_per_group(own),
        "pii": pii.find_pii(own), "redact": pii.redact(own),
        "mixing": mixing.poisson_mix(own),
        "bpe": bpe.bpe_decode(bpe.bpe_encode(own)),
    }
    for name, df in made.items():
        rows = df.collect()
        assert rows and set(own.columns) <= set(df.columns), name
        assert all(r[c] == f"own {c}" for r in rows for c in WORKING_NAMES), name
    assert simhash.simhash_groups(own).count() == sharding.shard_by_bytes(own, 3).count() == own.count()
    assert substring_dedup.substring_dedup(own).count() == suffix_dedup.suffix_dedup(own).count() == own.count()


def test_least_id_of_each_group_is_kept(spark):
    same = _text(3, 40)
    rows = [(9, same, "x"), (4, same, "y"), (4, same, "z"), (None, same, "n"), (None, _text(4, 40), "o"), (7, "", "e"), (6, None, "f"),
            (5, _text(5, 40), "p"), (5, _text(6, 40), "q")]
    got = simhash.keep_one_per_group(spark.createDataFrame(rows, "doc_id long, text string, v string")).collect()
    assert sorted(str(r.doc_id) for r in got) == ["4", "5", "5", "6", "None"]
    assert {r.v for r in got} - {"y", "z"} == {"o", "f", "p", "q"}
