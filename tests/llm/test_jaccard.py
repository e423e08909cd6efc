"""Jaccard join against all pairs."""

import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.llm import jaccard
from affinity.llm.components import components
from affinity.llm.textcore import word_counts

from .helpers import WORDS, awkward, documents, prose

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=5):
    w = _WORD.findall((text or "").translate(_LOW))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < n else [tuple(w[k:k + n]) for k in range(len(w) - n + 1)])


def brute(rows):
    """(doc_id, n_shingles, component_id) of every row; ids may repeat."""
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    part = list(range(len(sets)))

    def find(a):
        while part[a] != a:
            a = part[a]
        return a
    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            if i is None or j is None or not s or not t:
                continue
            both = len(s & t)
            if 100 * both >= 75 * (len(s) + len(t) - both):
                part[find(a)] = find(b)
    low = {}
    for a, (i, s) in enumerate(sets):
        if i is not None:
            low[find(a)] = min(low.get(find(a), i), i)
    return Counter((i, len(s), None if i is None else low[find(a)]) for a, (i, s) in enumerate(sets))


def got(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_awkward_documents_equal_brute_force(spark):
    rows = awkward()
    assert got(jaccard.near_duplicates(documents(spark, rows, extra=True))) == brute(rows)


def _edited(r, words, k):
    w = list(words)
    for _ in range(k):
        w[r.randrange(len(w))] = r.choice(WORDS)
    return " ".join(w)


def chains(seed):
    """Chains of ever more edited copies, groups of near copies, a line that is everywhere."""
    r = random.Random(seed)
    line = prose(seed, 9)
    rows, i = [], 0
    for g in range(12):
        words = prose(seed + g, r.choice([6, 12, 40, 90])).split(" ")
        for _ in range(r.choice([1, 3, 8])):
            text = _edited(r, words, r.choice([0, 1, 2, 4]))
            words = text.split(" ") if r.random() < 0.5 else words
            if r.random() < 0.3:
                text = f"{line}\n{text}"
            rows.append((i, text))
            i += 1
    for k in range(25):                                         # one large group around one text
        rows.append((i + k, _edited(r, prose(seed + 99, 80).split(" "), r.choice([0, 1, 2, 3]))))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_chains_and_large_groups_equal_brute_force(spark, seed):
    rows = chains(seed)
    assert got(jaccard.near_duplicates(documents(spark, rows))) == brute(rows)


def test_prefix_holds_a_common_shingle_of_every_similar_pair():
    p = jaccard.JaccardParams()
    for n in range(1, 400):
        assert p.needed(n) == min(k for k in range(n + 1) if 100 * k >= 75 * n)


def test_short_texts_are_one_shingle_and_sets_ignore_case():
    texts = ["one two", "ONE two", "", "a b c d e f", "a b c d e"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    g, r = jaccard.shingle_sets(data, offsets, 5)
    n, cid = jaccard.set_ids(g, r, 5)
    assert n.tolist() == [1, 1, 0, 2, 1] and cid[0] == cid[1] != cid[4]


def test_empty_table(spark):
    assert jaccard.near_duplicates(documents(spark, [(1, "x")]).where("false")).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(300, 340)]
    ring = [(k, 400 + (k - 399) % 20) for k in range(400, 420)]
    df = spark.createDataFrame(path + star + ring + [(9, 9)], "a long, b long")
    c = {r.v: r.c for r in components(df).collect()}
    assert {c[k] for k in range(100, 161)} == {100} and {c[k] for k in [7, *range(300, 340)]} == {7}
    assert {c[k] for k in range(400, 420)} == {400} and 9 not in c


def all_links(rows):
    """Other shingle sets similar to the set of each doc_id."""
    sets = {i: shingles(t) for i, t, *_ in rows if i is not None}
    distinct = {s for s in sets.values() if s}
    return {i: sum(1 for t in distinct if t != s and 100 * len(s & t) >= 75 * len(s | t)) for i, s in sets.items()}


@pytest.mark.parametrize("block", [7, 2048])
def test_links_equal_all_pairs(spark, block):
    """A large group in one block and in several, chains, copies, repeated rows."""
    r = random.Random(8)
    base = prose(77, 150).split(" ")
    rows = chains(3) + [(1000 + k, _edited(r, base, r.choice([1, 1, 2, 4]))) for k in range(70)]
    rows += [(2000 + k, rows[-1][1]) for k in range(5)] + rows[-3:]
    found = jaccard.near_duplicates(documents(spark, rows), jaccard.JaccardParams(block=block))
    assert got(found) == brute(rows)
    want = all_links(rows)
    assert max(want.values()) > 40 and {(x.doc_id, x.n_links) for x in found.collect()} == set(want.items())


def test_common_counts_equal_plain_intersections():
    r = np.random.default_rng(5)
    for width in (30, 5000):                                    # by products only; by pairs too
        sets = [np.unique(r.integers(0, width, r.integers(0, 400))).astype(np.uint64) for _ in range(40)]
        g, row = np.concatenate(sets), np.repeat(np.arange(40), [len(s) for s in sets])
        want = [[len(np.intersect1d(x, y)) for y in sets[15:]] for x in sets[:15]]
        assert jaccard.common_counts(g, row, 15, 25).tolist() == want


def test_a_class_has_one_text_however_often_its_id_is_repeated(spark):
    p = jaccard.JaccardParams()
    near = " ".join([*prose(1, 60).split(), "x"])
    rows = [(1, prose(1, 60))] * 30 + [(2, near)] * 20 + [(3, "")]
    docs = documents(spark, rows).select("doc_id", "text").repartition(4)
    sketch = spark.sparkContext.broadcast(jaccard.count_sketch(docs, p))
    known = jaccard.document_sets(docs, sketch, p).where("n > 0")
    texts = jaccard.class_texts(docs, known.select("doc_id", "cid").distinct(), p)
    assert texts.count() == 2
    a, b = sorted(r.cid for r in texts.select("cid").collect())
    pairs = spark.createDataFrame([(a, b)], "a long, b long")
    assert jaccard.verified(pairs, texts, p).collect() == [(a, b)]


def test_runs_hold_the_shingles_of_several_groups_and_first_pairs_fit(spark):
    """Shingles of one group only are no runs, however many copies or buckets it has."""
    p = jaccard.JaccardParams()
    base = prose(5, 80).split(" ")
    r = random.Random(2)
    rows = [(k, " ".join(base)) for k in range(30)] + [(50 + k, _edited(r, base, 1 + k % 4)) for k in range(20)]
    rows += [(90 + k, prose(500 + k, 40)) for k in range(4)] * 3
    docs = documents(spark, rows).select("doc_id", "text").repartition(4)
    sketch = spark.sparkContext.broadcast(jaccard.count_sketch(docs, p))
    known = jaccard.document_sets(docs, sketch, p).where("n > 0").cache()
    sets = {}
    for x in known.collect():
        sets[x.gid] = (x.n, np.frombuffer(x.prefix, np.uint64).tolist())
    where = {}
    for gid, (n, prefix) in sets.items():
        for pos, h in enumerate(prefix):
            where.setdefault(h, set()).add((gid, n, pos))
    want = Counter(frozenset(x) for x in where.values() if len(x) > 1)
    for buckets in (1, 5):
        got = jaccard.shared_runs(jaccard.postings(known, buckets), p).collect()
        runs = {}
        for x in got:
            if not x.pair:
                runs.setdefault(x.h, set()).add((x.gid, x.n, x.pos))
        assert Counter(frozenset(x) for x in runs.values()) == want and len(want) > 20
        pairs = Counter()
        for x in got:
            if x.pair:
                pairs[x.h, x.gid] += x.n
        assert pairs
        for (g1, g2), k in pairs.items():
            assert g1 != g2 and 0 < k <= len(set(sets[g1][1]) & set(sets[g2][1]))
    known.unpersist()


def test_the_tables_of_the_join_are_removed(spark):
    """Texts, prefixes and runs do not stay on disk; rows and classes do, and are read again."""
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(base))
    rows = [(1, prose(1, 60)), (2, prose(1, 60) + " x"), (3, "")]
    found = jaccard.near_duplicates(documents(spark, rows))
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(base)) - before}
    assert left == {"jaccard_classes_out", "jaccard_sizes_out"}
    assert got(found) == got(found) == brute(rows)


def test_only_texts_of_classes_in_pairs_are_sent(spark):
    texts = spark.range(-500, 500).select(F.col("id").alias("cid"), F.lit(b"x").alias("z"))
    pairs = spark.createDataFrame([(-7, 3), (3, 9), (2**40, 11)], "a long, b long")
    assert sorted(r.cid for r in jaccard.in_pairs(texts, pairs).collect()) == [-7, 3, 9, 11]
    assert jaccard.in_pairs(texts, pairs.where("false")).count() == 0


def test_word_counts_equal_words():
    texts = ["", " a  b\tc ", "é ü\n", "x" * 99, " \r\x0b "]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    assert word_counts(data, offsets).tolist() == [len(_WORD.findall(t)) for t in texts]
