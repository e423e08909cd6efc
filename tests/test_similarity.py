"""Exact in-category top-k cosine: blocked plan against brute force."""

import numpy as np
import pandas as pd

from affinity.operators import similarity as sim
from affinity.operators import word2vec
from affinity.operators.payload import similarity_payload


def _vectors(spark, n=60, dim=5, cats=3, seed=7, dup=True):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = base[i % 12] if dup else rng.normal(size=dim)   # many exact ties when dup
        rows.append((i, f"c-{i % cats}", str(i % cats), [float(x) for x in v]))
    rows.append((n, "c-0", "0", [0.0] * dim))                # zero vector: dropped
    return spark.createDataFrame(rows, "product_id long, cat_path string, cat4cat string, "
                                       "vec array<double>"), rows


def _brute(rows, k):
    df = pd.DataFrame(rows, columns=["product_id", "cat_path", "cat4cat", "vec"])
    out = []
    for _, g in df.groupby("cat4cat"):
        m = np.stack(g["vec"].to_numpy())
        nrm = np.linalg.norm(m, axis=1)
        g, m = g[nrm > 0], m[nrm > 0] / nrm[nrm > 0][:, None]
        s = sim.round5(m @ m.T)
        ids = g["product_id"].to_numpy()
        for a in range(len(ids)):
            cand = sorted((-s[a, b], ids[b]) for b in range(len(ids)) if ids[b] != ids[a])
            for r, (neg, o) in enumerate(cand[:k], 1):
                out.append((int(ids[a]), g["cat_path"].iloc[a], int(o), -neg, r))
    return sorted(out)


def test_blocked_equals_brute_force_with_ties(spark):
    df, rows = _vectors(spark)
    # many blocks and strips, uneven sizes, chunked strips, one block
    for block, strip, chunk in ((4, 6, 4), (7, 5, 3), (3, 1024, 2), (1024, 1024, 4096)):
        got = sorted(tuple(r)[:5] for r in sim.vector_similarity(
            df, k=5, block_size=block, strip_size=strip, chunk=chunk).collect())
        assert got == _brute(rows, 5), (block, strip, chunk)


def test_properties_k_bound_no_self_same_category(spark):
    df, rows = _vectors(spark, dup=False)
    res = sim.vector_similarity(df, k=4, block_size=8, strip_size=8, chunk=5).collect()
    cat = {r[0]: r[2] for r in rows}
    assert all(r.rank <= 4 and r.product_id != r.other_id for r in res)
    assert all(cat[r.product_id] == cat[r.other_id] for r in res)
    assert all(-1.0 <= r.score <= 1.0 for r in res)
    assert all(r.product_id != 60 and r.other_id != 60 for r in res)   # zero vector gone


def test_item_desc_and_text_similarity_rows(spark):
    from affinity.sources import adapters as ad
    cat = ad.part_catalogue(spark, "/root/testdata/sf0.001")
    items = sim.item_desc(cat)
    assert items.count() == 200
    res = sim.text_similarity(cat, k=10, dim=16).collect()
    assert res and all(r.rank <= 10 and r.product_id != r.other_id for r in res)


def test_a_repeated_item_has_a_list_per_row(spark):
    rows = [(1, "c", "c", [1.0, 0.0]), (1, "c", "c", [0.0, 1.0]), (2, "c", "c", [1.0, 0.1]),
            (3, "c", "c", [0.1, 1.0]), (4, "c", "c", [1.0, 1.0])]
    df = spark.createDataFrame(rows, "product_id long, cat_path string, cat4cat string, vec array<double>")
    res = sim.vector_similarity(df, k=3, block_size=2, strip_size=2, chunk=2)
    lists = {}
    for r in res.where("product_id = 1").collect():
        lists.setdefault(r.row_id, []).append((r.rank, r.other_id))
    assert sorted([o for _, o in sorted(x)] for x in lists.values()) == [[2, 4, 3], [3, 4, 2]]
    pay = similarity_payload(res).where("product_id = 1").collect()
    assert len(pay) == 2 and all(len(p.text_corr_payload.split(" ")) == 3 for p in pay)


def _word_rows(df):
    return {r.word: np.array(r.vec) for r in df.collect()}


def test_word_vectors_are_equal_bit_by_bit_whatever_the_tasks(spark):
    from affinity.sources import adapters as ad
    items = sim.item_desc(ad.part_catalogue(spark, "/root/testdata/sf0.001"))
    a = _word_rows(word2vec.train(items, dim=16, block_words=30))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = _word_rows(word2vec.train(items.repartition(5), dim=16, block_words=30))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a.keys() == b.keys() == {w for r in items.select("text").collect() for w in r.text}
    assert all((a[w] == b[w]).all() for w in a)


def _reference_cell(u, v, ua, va, c, o, n, noise, rng, passes, negative, rate, batch):
    """The same steps one pair and one component list at a time."""
    for _ in range(passes):
        order = rng.permutation(len(c))
        for s in range(0, len(c), batch):
            k = order[s:s + batch]
            drawn = rng.random((len(k), negative))
            gu, gv = {}, {}
            for b, p in enumerate(k):
                ctx = [o[p]] + [min(int(np.searchsorted(noise, x)), len(v) - 1) for x in drawn[b]]
                for t, w in enumerate(ctx):
                    g = ((t == 0) - 1 / (1 + np.exp(-float(u[c[p]] @ v[w])))) * np.sqrt(n[p])
                    gu[c[p]] = gu.get(c[p], 0) + g * v[w]
                    gv[w] = gv.get(w, 0) + g * u[c[p]]
            for m, acc, grads in ((u, ua, gu), (v, va, gv)):
                for r, g in grads.items():
                    acc[r] += g @ g / len(g)
                    m[r] += rate * g / np.sqrt(acc[r] + 1e-8)


def test_training_equals_a_plain_loop():
    r = np.random.default_rng(3)
    u, v = r.normal(size=(6, 4)), r.normal(size=(7, 4))
    args = (np.array([0, 0, 1, 5, 2, 3]), np.array([1, 6, 2, 2, 0, 4]), np.array([1, 9, 4, 2, 1, 3]), np.linspace(1 / 7, 1, 7))
    got = [u.copy(), v.copy(), np.zeros(6), np.zeros(7)]
    want = [x.copy() for x in got]
    word2vec.train_cell(*got, *args, np.random.default_rng(1), 3, 2, 0.1, 4)
    _reference_cell(*want, *args, np.random.default_rng(1), 3, 2, 0.1, 4)
    for x, y in zip(got, want):
        assert np.allclose(x, y, atol=1e-5)


def test_words_used_alike_get_close_vectors(spark):
    r = np.random.default_rng(2)
    topics = [[f"{t}{i}" for i in range(12)] for t in "abc"]
    rows = [(i, "c", "c", [str(x) for x in r.choice(topics[i % 3], 6)]) for i in range(600)]
    items = spark.createDataFrame(rows + [(9000, "c", "c", None), (9001, "c", "c", [None, "a1"]), (9002, "c", "c", [])],
                                  "product_id long, cat_path string, cat4cat string, text array<string>")
    vec = _word_rows(word2vec.train(items, dim=16, block_words=10))       # several cells
    assert len(vec) == 36
    unit = {w: x / np.linalg.norm(x) for w, x in vec.items()}
    same = np.mean([unit[f"{t}{i}"] @ unit[f"{t}{j}"] for t in "abc" for i in range(12) for j in range(i)])
    other = np.mean([unit[f"a{i}"] @ unit[f"b{j}"] for i in range(12) for j in range(12)])
    assert same > other + 0.3, (same, other)
    assert {r.word for r in word2vec.vocabulary(items, 110).collect()} < set(vec)
    assert word2vec.train(items.where("product_id >= 9002"), dim=4).collect() == []


def test_mean_vectors_by_blocks_equal_those_by_lookup(spark):
    r = np.random.default_rng(6)
    names = [f"w{i}" for i in range(40)]
    rows = [(i, "c", "c", [str(x) for x in r.choice([*names, "unknown"], int(r.integers(1, 9)))]) for i in range(200)]
    rows += [(500 + i, "c", "c", ["w0"] * 50) for i in range(100)]                     # a hot word
    items = spark.createDataFrame(rows + [(900, "c", "c", None), (901, "c", "c", []), (902, "c", "c", ["unknown", None])],
                                  "product_id long, cat_path string, cat4cat string, text array<string>")
    words = spark.createDataFrame([(w, [float(x) for x in r.normal(size=6)]) for w in names], "word string, vec array<double>")
    a = {x.product_id: x.vec for x in sim.mean_word_vectors(items, words).collect()}
    b = {x.product_id: x.vec for x in sim.mean_word_vectors(items, words, 0, block_words=7, block_tokens=100).collect()}
    assert a.keys() == b.keys() and len(a) >= 290 and not {900, 901, 902} & a.keys()
    assert all(np.allclose(a[k], b[k], atol=1e-12) for k in a)


def test_given_word_vectors_are_applied(spark):
    from affinity.sources import adapters as ad
    cat = ad.part_catalogue(spark, "/root/testdata/sf0.001")
    words = word2vec.train(sim.item_desc(cat), dim=8)
    a, b = (sorted(map(tuple, sim.text_similarity(cat, k=5, dim=8, words=w).drop("row_id").collect())) for w in (words, None))
    assert a == b and a


def test_mean_counts_every_word_and_drops_rows_without_a_known_one(spark):
    items = spark.createDataFrame([(1, "c", "c", ["a", "b", "x"]), (2, "c", "c", ["x"]), (3, "c", "c", ["b", "b"])],
                                  "product_id long, cat_path string, cat4cat string, text array<string>")
    words = spark.createDataFrame([("a", [3.0, 0.0]), ("b", [0.0, 6.0])], "word string, vec array<double>")
    got = {r.product_id: r.vec for r in sim.mean_word_vectors(items, words).collect()}
    assert got == {1: [1.0, 2.0], 3: [0.0, 6.0]}
