"""Merkle manifest against a tree built by hand."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from affinity.llm import merkle

from .helpers import awkward, documents, prose


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(i, source, lang, n, text):
    values = [None if v is None else str(v) for v in (i, source, lang, n, text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """(root, per node the list of (left, right) digests up to it)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // 16 * 16:i // 16 * 16 + 16]
            paths[k].append(("".join(run[:i % 16]), "".join(run[i % 16 + 1:])))
        nodes = [sha("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
        at = [i // 16 for i in at]
    return nodes[0], paths


def by_hand(rows):
    groups = {}
    for r in rows:
        groups.setdefault("" if r[1] is None else "s" + r[1], []).append(r)
    order = sorted(groups, key=lambda g: g.encode())
    for g in order:
        groups[g] = sorted((r[0] is not None, r[0] or 0, leaf(*r), r) for r in groups[g])
    trees = {g: tree([x[2] for x in groups[g]]) for g in order}
    root, above = tree([trees[g][0] for g in order])
    out = []
    for g, over in zip(order, above, strict=True):
        for (_, _, own, r), path in zip(groups[g], trees[g][1], strict=True):
            path = path + over
            d = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                d = leaf(*r[:4], lowered(r[4]))
            for left, right in path:
                d = sha(left + d + right)
            out.append((r[0], own, trees[g][0], root, sha("".join(a + b for a, b in path)), d, d == root))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def check(df, spread=merkle.SPREAD):
    rows = [tuple(r) for r in df.select(*merkle.FIELDS).collect()]
    got = [tuple(r) for r in merkle.verify(df, spread).collect()]
    assert sorted(got, key=key) == sorted(by_hand(rows), key=key)
    return got


def test_awkward_rows_and_clashing_columns(spark):
    rows = [(i, t, "en" if k % 3 else None, f"s{k % 4}" if k % 5 else None) for k, (i, t, *_) in enumerate(awkward())]
    rows += [(9, "Tie", "en", "s1"), (9, "Tie", "en", "s1"), (9, "Other", "en", "s1"),
             (3, "x", "en", "a/t"), (4, "y", "en", ""), (5, "z", "en", "t"), (6, "w", "en", "é")]
    got = check(documents(spark, rows, extra=True))
    assert len(got) == len(rows)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257])
def test_one_source_of_any_size(spark, n):
    check(documents(spark, [(i, f"Text {i}", "en", "only") for i in range(n)]))


def test_many_sources_and_copied_targets(spark):
    """A deep hot source beside 300 lone ones; every pointer target has many copies."""
    rows = [(i, prose(i, 4).title(), "en", "hot") for i in range(5000)]
    rows += [(9000 + i, "Lone", "de", f"z{i}") for i in range(300)]
    got = check(documents(spark, rows), spread=64)
    assert len({r[3] for r in got}) == 1
    tampered = [r for r in got if not r[-1]]
    assert tampered and all(zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in tampered)


def test_segments_double(spark):
    """A chain of 9 nodes: after three jumps every segment ends at the root."""
    rows = [(str(i), 1, False, str(i + 1) if i < 8 else None, 1 if i < 8 else None,
             [(f"l{i}", f"r{i}")] if i < 8 else [], "top" if i == 8 else None) for i in range(9)]
    p = spark.createDataFrame(rows, "key string, w long, run boolean, anc string, aw long, "
                                    "seg array<struct<l:string,r:string>>, sub string")
    for reach in (2, 4, 8):
        p = merkle.jump(p)
        for r in p.collect():
            assert [s.l for s in r.seg] == [f"l{j}" for j in range(int(r.key), min(8, int(r.key) + reach))]
    assert p.where("anc <> '8'").count() == 0


def test_empty_table(spark):
    assert merkle.verify(documents(spark, [])).collect() == []


def test_places_are_spread_over_range_partitions(spark):
    """No window or sort gathers a source: the only windows run over partition counts."""
    df = documents(spark, [(i, "x", "en", "one") for i in range(2000)])
    p = merkle.positions(df.select("doc_id", "source"), "source", ("doc_id",), "places")
    assert [r.idx for r in p.orderBy("doc_id").collect()] == list(range(2000))
    assert p.agg(F.min("n"), F.max("n")).first() == (2000, 2000)
