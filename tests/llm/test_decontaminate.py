"""Decontamination: planted exact and edited items, brute-force alignment."""

import numpy as np

from affinity.llm import decontaminate as dc
from affinity.llm.decontaminate import DecontamParams

from .helpers import awkward, documents, prose


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def sw(a, b, mismatch, gap):
    best, h = 0.0, [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = 1.0 if a[i - 1] == b[j - 1] else -mismatch
            h[i][j] = max(0.0, h[i - 1][j - 1] + s, h[i - 1][j] - gap, h[i][j - 1] - gap)
            best = max(best, h[i][j])
    return best


def test_alignment_equals_the_textbook_table():
    r = np.random.default_rng(1)
    for _ in range(60):
        a, b = (r.integers(0, 6, r.integers(1, 30)) for _ in range(2))
        for mismatch, gap in ((0.5, 0.5), (1.0, 2.0), (0.25, 1.0)):
            assert abs(dc.smith_waterman(a, b, mismatch, gap)[0] - sw(a, b, mismatch, gap)) < 1e-9


def _edit(text, every):
    return " ".join("changed" if k % every == every - 1 else w for k, w in enumerate(text.split(" ")))


def test_exact_edited_and_hot_passages_are_found_and_clean_ones_left(spark):
    items = [(k, prose(500 + k, 30)) for k in range(8)] + [(90, "tiny item"), (91, ""), (92, None), (None, "x y z")]
    rows = [(1, f"{prose(1, 40)} {items[0][1]} {prose(2, 40)}"),
            (2, f"{prose(3, 40)}\n{_edit(items[1][1], 5)}\n{prose(4, 10)}"),
            (3, items[2][1].upper()),
            (4, " ".join(w for k, w in enumerate(items[3][1].split(" ")) if k % 6)),       # words left out
            (5, f"{prose(9, 300)}"), (6, items[4][1][:40]), (7, "a Tiny item here"), (8, None), (9, "")]
    rows += [(100 + k, f"{prose(700 + k, 20)} {items[5][1]}") for k in range(60)]           # in a third of all rows
    rows += [(i if i is None else 3000 + i, t) for i, t in awkward(40)]
    found = dc.contaminated(documents(spark, rows, extra=True), _items(spark, items)).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert pairs == {(1, 0), (2, 1), (3, 2), (4, 3), (7, 90)} | {(100 + k, 5) for k in range(60)}
    assert {r.doc_id: round(r.score, 3) for r in found}[1] == 1.0
    kept = dc.drop_contaminated(documents(spark, rows), _items(spark, items))
    bad = {d for d, _ in pairs}
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((i or -1) for i, *_ in rows if i not in bad)


def test_every_candidate_equals_a_full_alignment(spark):
    """Seeds lose no item that a full alignment scores clearly above the threshold."""
    r = np.random.default_rng(4)
    items = [(k, prose(800 + k, int(r.integers(15, 50)))) for k in range(10)]
    rows = []
    for d in range(40):
        w = items[d % 10][1].split(" ")
        for _ in range(int(r.integers(0, len(w) // 2))):
            w[int(r.integers(0, len(w)))] = prose(int(r.integers(0, 10**6)), 1)
        rows.append((d, f"{prose(900 + d, 30)} {' '.join(w)} {prose(950 + d, 30)}"))
    p = DecontamParams()
    got = {(x.doc_id, x.item_id): x.score for x in dc.contaminated(documents(spark, rows), _items(spark, items)).collect()}
    for d, t in rows:
        for k, q in items:
            full = sw(q.split(" "), t.split(" "), p.mismatch, p.gap) / len(q.split(" "))
            if full >= 0.6:
                assert abs(got[(d, k)] - full) < 1e-9
            if full < p.threshold:
                assert (d, k) not in got


def _seeded(item, text, n=3):
    grams = lambda w: {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}               # noqa: E731
    return bool(grams(item) & grams(text))


def test_insertions_deletions_and_replacements_from_the_threshold_up(spark):
    """Whatever the edits, a passage with a seed is found with its full score."""
    r = np.random.default_rng(12)
    items = [(k, prose(800 + k, int(r.integers(20, 45)))) for k in range(8)]
    rows = []
    w = items[0][1].split(" ")
    q = len(w) // 4                       # split in four, far apart but above the threshold
    rows.append((0, " ".join([*w[:q], *prose(1, q // 2 + 1).split(" "), *w[q:2 * q], *prose(2, q // 2 + 1).split(" "),
                              *w[2 * q:3 * q], *prose(3, q // 2 + 1).split(" "), *w[3 * q:]])))
    for d in range(1, 120):
        out, share = [], r.uniform(0.05, 0.5)
        for x in items[d % 8][1].split(" "):
            kind = r.integers(0, 3) if r.random() < share else 3
            if kind == 0:                                       # words put in before it
                out += prose(int(r.integers(0, 10**6)), int(r.integers(1, 9))).split(" ")
            out += [] if kind == 1 else [prose(int(r.integers(0, 10**6)), 1)] if kind == 2 else [x]
        rows.append((d, f"{prose(900 + d, 25)} {' '.join(out)} {prose(950 + d, 25)}"))
    p = DecontamParams()
    got = {(x.doc_id, x.item_id): x.score for x in dc.contaminated(documents(spark, rows), _items(spark, items)).collect()}
    band = 0
    for d, t in rows:
        for k, text in items:
            a, b = text.split(" "), t.split(" ")
            full = sw(a, b, p.mismatch, p.gap) / len(a)
            if full < p.threshold or not _seeded(a, b):
                assert (d, k) not in got or full >= p.threshold
            else:
                assert abs(got[(d, k)] - full) < 1e-9, (d, k, full)
                band += full < 0.65
    assert band >= 10


def test_an_item_of_everyday_words_in_many_documents(spark):
    """Its n-grams are everywhere: common seeds alone, and clean documents stay."""
    item = "it is one of the best and one of the first in all of the world"
    rows = [(k, f"{prose(k, 15)} one of the {prose(50 + k, 15)} in all of {prose(90 + k, 5)}") for k in range(200)]
    rows += [(500, f"{prose(1, 9)} it is one of the very best and one of the first in all of our world {prose(2, 9)}")]
    kept = dc.drop_contaminated(documents(spark, rows), _items(spark, [(1, item)]))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(200))


def test_blocks_of_items_empty_tables_and_seeds(spark):
    items = [(k, prose(500 + k, 30)) for k in range(12)]
    rows = [(k, f"{prose(k, 20)} {items[k][1]}") for k in range(12)]
    df, bm = documents(spark, rows), _items(spark, items)
    small = dc.contaminated(df, bm, DecontamParams(block_words=70)).collect()
    assert sorted((r.doc_id, r.item_id) for r in small) == [(k, k) for k in range(12)]
    assert dc.contaminated(df, bm.where("false")).count() == 0
    assert dc.contaminated(df.where("false"), bm).count() == 0
    assert dc.drop_contaminated(df, bm.where("false")).count() == 12
    block = dc.Items.build([1], [items[0][1]], 3)
    df_n = np.arange(len(block.keys)) * 10                          # one n-gram occurs nowhere
    assert len(block.keys) == 28
    assert len(block.rare(df_n, 0).keys) == 14                      # the rarer half of 27
    assert len(block.rare(df_n, 200).keys) == 20                    # and all in at most 200 documents


def test_edited_copies_in_very_many_documents_are_found_beside_a_verbatim_one(spark):
    """The n-grams that survive the edits are the common half; the rare half is in one document."""
    item = prose(500, 30)
    rows = [(0, f"{prose(1, 20)} {item} {prose(2, 20)}")]
    rows += [(1 + k, f"{prose(3000 + k, 20)} {_edit(item, 5)} {prose(6000 + k, 20)}") for k in range(300)]
    rows += [(400 + k, prose(9000 + k, 60)) for k in range(20)]
    df, bm = documents(spark, rows), _items(spark, [(7, item)])
    assert {r.doc_id for r in dc.contaminated(df, bm).collect()} == set(range(301))
    assert {r.doc_id for r in dc.drop_contaminated(df, bm).collect()} == set(range(400, 420))


def test_bound_is_never_below_the_alignment():
    r = np.random.default_rng(2)
    for _ in range(200):
        a, b = (r.integers(0, 8, r.integers(1, 30)) for _ in range(2))
        for mismatch, gap in ((0.5, 0.5), (1.0, 2.0), (0.25, 1.0)):
            assert dc.score_bound(a, b, mismatch, gap) >= dc.smith_waterman(a, b, mismatch, gap)[0] - 1e-9
