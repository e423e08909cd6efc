"""Suffix dedup against a brute-force count of every window."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from affinity.llm import suffixes as sx
from affinity.llm.suffixes import SuffixParams

from .helpers import awkward, documents, prose


def brute(rows, length):
    c = Counter()
    raw = [(i, (t or "").encode()) for i, t, *_ in rows]
    for _, b in raw:
        for k in range(len(b) - length + 1):
            c[b[k:k + length]] += 1
    out = []
    for i, b in raw:
        mask = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if c[b[k:k + length]] > 1:
                mask[k:k + length] = b"\1" * length
        left = bytes(x for x, m in zip(b, mask) if not m)
        spans = sum(1 for k, m in enumerate(mask) if m and not (k and mask[k - 1]))
        out.append((i, len(b), sum(mask), spans, hashlib.sha256(left).hexdigest()))
    return Counter(out)


def got(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_awkward_documents_equal_brute_force(spark):
    rows = awkward()
    df = documents(spark, rows, extra=True)
    assert got(sx.deduplicate(df, SuffixParams(batches=3))) == brute(rows, 200)


def _passages():
    hot = prose(5, 60)
    rows = []
    for k in range(60):
        left, right = prose(100 + k, 30), prose(200 + k, 30)
        cut = hot[: 150 + 5 * k] if k % 3 else hot[k:]
        rows.append((k, f"{left} {cut} {right}"))
    rows += [(100 + k, prose(5, 60)) for k in range(30)]                  # copies of the hot passage alone
    rows.append((200, (prose(7, 40) + " ") * 3))                          # repeats inside one document
    return rows


@pytest.mark.parametrize("crowd", [1, 2_000])
def test_hot_passage_in_many_contexts(spark, crowd):
    rows = _passages()
    p = SuffixParams(length=80, k=24, batches=4, bucket=50, crowd=crowd)
    assert got(sx.deduplicate(documents(spark, rows), p)) == brute(rows, 80)


def test_long_texts_are_cut_into_chunks_without_losing_windows(monkeypatch):
    p = SuffixParams(length=60, k=16)
    data = np.frombuffer(prose(3, 3000).encode(), np.uint8)
    offsets = np.array([0, 5000, 5030, len(data)])
    whole = sx.anchors(data, offsets, p)
    monkeypatch.setattr(sx, "_CHUNK", 700)
    parts = sx.anchors(data, offsets, p)

    def windows(a):
        return {(r, w) for r, lo, n in zip(*a[:3]) for w in range(lo, lo + n)}
    size = np.diff(offsets)
    assert windows(whole) == windows(parts) == {(r, w) for r in range(3) for w in range(size[r] - 59)}


def test_index_levels_merge_geometrically(spark):
    p = SuffixParams(length=60, k=16)
    index = sx.SuffixIndex(spark, p)
    found = []
    for k in range(5):
        df = documents(spark, [(k, prose(k, 100)), (10 + k, prose(k // 2, 90))])
        found.append({r.head for r in index.add(df).collect()})
    assert sorted(index.levels) == [0, 2]                                  # 5 batches = 4 + 1
    assert found[1] and found[3]                                           # met earlier batches
    n = {k: v.agg({"n": "sum"}).first()[0] for k, v in index.levels.items()}
    assert n[2] > n[0] > 0


def test_texts_option_and_empty_table(spark):
    rows = [(1, "x" + prose(1, 60)), (2, "y" + prose(1, 60)), (3, "é" * 150 + "a"), (4, "é" * 150 + "b")]
    df = documents(spark, rows)
    out = {r.doc_id: r for r in sx.deduplicate(df, keep=("lang",), texts=True).collect()}
    assert out[1].text == "x" and out[2].text == "y" and out[3].text == "a" and out[1].lang == "en"
    assert sx.deduplicate(df.where("false")).count() == 0
