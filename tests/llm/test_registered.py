"""Registered corpus queries against brute force on the smallest tables, all contract columns."""

from __future__ import annotations

import hashlib
import os
import re
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from strata.llm.queries import QUERIES
from test_llm import _fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    return sorted((r.doc_id, r.text or "") for r in rows)


@pytest.fixture(scope="module")
def vectors(spark):
    rows = sorted(spark.read.parquet(f"{SF}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    good = [r for r in rows if r.embedding and None not in r.embedding and np.isfinite(r.embedding).all() and any(r.embedding)]
    x = np.array([r.embedding for r in good], float)
    norms = np.linalg.norm(x, axis=1)
    return [r.vec_id for r in rows], [r.vec_id for r in good], (x @ x.T) / norms[:, None] / norms[None, :]


def _components(n, linked):
    group = list(range(n))
    for a, b in linked:
        if group[a] != group[b]:
            low, high = sorted((group[a], group[b]))
            group = [low if g == high else g for g in group]
    return group


def test_op1(spark, vectors):
    ids, good, cos = vectors
    linked = [(a, b) for a, b in zip(*np.nonzero(cos >= 0.95)) if a < b]
    group = _components(len(good), linked)
    want = {i: (0, i, True) for i in ids}
    for k, i in enumerate(good):
        least = min(good[j] for j in range(len(good)) if group[j] == group[k])
        want[i] = (sum(k in p for p in linked), least, least == i)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in QUERIES["op1_embedding_dedup"](spark, SF).collect()}
    assert got == want


def _covered(units, docs, width):
    seen, out = set(), {}
    for i, text in docs:
        u = units(text)
        flags = [False] * len(u)
        for o in range(len(u) - width + 1):
            w = bytes(u[o:o + width]) if isinstance(u, bytes) else tuple(u[o:o + width])
            if w in seen:
                flags[o:o + width] = [True] * width
            seen.add(w)
        out[i] = (u, flags)
    return out


def test_op4(spark, docs):
    want = {}
    for i, (u, gone) in _covered(lambda t: t.encode(), docs, 100).items():
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(u, gone) if not g)
        want[i] = (len(u), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op4_suffix_dedup"](spark, SF).collect()}
    assert got == want


def test_op5(spark, docs):
    """The law, and the cut itself: shards are stretches of one order of the texts, each
    group of equal texts whole or cut between documents, bytes as near equal as a group allows."""
    rows = QUERIES["op5_sharding"](spark, SF).collect()
    sizes = {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in docs}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == sizes and len(rows) == len(docs)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    total = sum(s for s, _ in sizes.values())
    by = {k: [r for r in rows if r.shard == k] for k in range(8)}
    texts = dict(docs)
    groups = {}
    for r in rows:
        groups.setdefault(texts[r.doc_id], []).append(r)
    # A group of up to 2 % of a shard is whole; a cut is off its target by less than half a group or document.
    for t, members in groups.items():
        if sum(m["size"] for m in members) <= 0.02 * total / 8:
            assert len({m.shard for m in members}) == 1
    largest = max(max(m["size"] for m in g) if sum(m["size"] for m in g) > 0.02 * total / 8 else sum(m["size"] for m in g)
                  for g in groups.values())
    at = 0
    for k in range(8):
        assert sorted(r.slot for r in by[k]) == list(range(len(by[k])))
        at += sum(r["size"] for r in by[k])
        assert abs(at - (k + 1) * total / 8) <= largest


def test_op6(spark, docs):
    codes = [_fingerprint(t) for _, t in docs]
    linked = [(a, b) for a in range(len(docs)) for b in range(a) if (codes[a] ^ codes[b]).bit_count() <= 3]
    group = _components(len(docs), linked)
    least = {}
    for g, (i, _) in zip(group, docs):
        least[g] = min(i, least.get(g, i))
    want = {i: (f"{c:016x}", least[g]) for (i, _), c, g in zip(docs, codes, group)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op6_simhash"](spark, SF).collect()}
    assert got == want


def test_op7(spark, docs):
    want = {}
    for i, (u, gone) in _covered(lambda t: re.findall(r"[^\x20\x09-\x0D]+", t), docs, 20).items():
        kept = " ".join(w for w, g in zip(u, gone) if not g)
        want[i] = (len(u), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op7_substring_dedup"](spark, SF).collect()}
    assert got == want


def test_op8(spark, vectors):
    _, good, cos = vectors
    rows = QUERIES["op8_ann"](spark, SF).collect()
    hit = total = 0
    for k, q in enumerate(good):
        if q % 50:
            continue
        own = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == q)
        best = sorted((-cos[k, j], i) for j, i in enumerate(good) if j != k)[:5]
        assert [r for r, *_ in own] == [1, 2, 3, 4, 5]
        assert [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)
        assert all(abs(s - cos[k, good.index(i)]) < 1e-12 for _, i, s in own)
        hit += len({i for _, i, _ in own} & {i for _, i in best})
        total += 5
    assert {r.query_id for r in rows} == {q for q in good if q % 50 == 0} and hit >= 0.9 * total


def test_op3_columns(spark, docs):
    rows = QUERIES["op3_toxicity"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == [i for i, _ in docs]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
