"""Quality, toxicity and language ID: held-out accuracy, folds, awkward rows, kernels."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from affinity.llm import ftrl, langid, quality, toxicity
from affinity.llm.ftrl import FtrlParams
from affinity.llm.langid import CrfParams

from .helpers import awkward, documents, prose


def out_fold(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def _labels(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    return df.selectExpr("*", "'x' AS text", "1 AS score") if extra else df


def _corpus(n=400, seed=1):
    """Good prose, shouted or symbol-ridden junk, and toxic prose."""
    r = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        text = prose(seed * 1000 + k, r.randrange(5, 120))
        junk, toxic = r.random() < 0.25, r.random() < 0.25
        if junk:
            text = " ".join(w.upper() + "!!" if k % 2 else w + "###" for w in text.split(" "))
        if toxic:
            w = text.split(" ")
            for _ in range(1 + len(w) // 15):
                w.insert(r.randrange(len(w) + 1), r.choice(["grobian", "grobiane", "schuft", "halunke"]))
            text = " ".join(w)
        rows.append((k, text))
        labels.append((k, int(not junk), int(toxic)))
    return rows, labels


def _accuracy(df, labels, column, want_out):
    truth = {i: (q, t)[column] for i, q, t in labels}
    hits = [r.predicted == truth[r.doc_id] for r in df.collect() if r.doc_id in truth and r.held_out == want_out]
    return sum(hits) / len(hits)


def test_quality_generalises_to_the_held_out_fold(spark):
    rows, labels = _corpus()
    out = quality.quality_scores(documents(spark, rows, extra=True), _labels(spark, labels))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    assert all(r.held_out == out_fold(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
               for r in out.collect())
    assert _accuracy(out, labels, 0, True) > 0.95


def test_toxicity_generalises_to_the_held_out_fold(spark):
    rows, labels = _corpus(600, 2)
    out = toxicity.toxicity_scores(documents(spark, rows, extra=True), _labels(spark, labels))
    assert _accuracy(out, labels, 1, True) > 0.95
    assert all(r.predicted == (r.score >= 0.5) for r in out.collect())


def test_toxicity_learns_a_wide_vocabulary(spark):
    r = random.Random(8)
    bad = [f"x{''.join(r.choice('bdgklmnprst') + r.choice('aeiou') for _ in range(3))}k" for _ in range(100)]
    rows, labels = [], []
    for k in range(7000):
        w = prose(k, r.randrange(10, 40)).split(" ")
        if k % 2:
            w.insert(r.randrange(len(w)), r.choice(bad))
        rows.append((k, " ".join(w)))
        labels.append((k, 1, k % 2))
    out = [x for x in toxicity.toxicity_scores(documents(spark, rows), _labels(spark, labels)).collect() if x.held_out]
    assert np.mean([x.predicted for x in out if x.doc_id % 2]) > 0.8
    assert np.mean([x.predicted for x in out if x.doc_id % 2 == 0]) < 0.01


def test_words_of_a_copied_text_do_not_all_vote(spark):
    rows, labels = _corpus(600, 2)
    copied = prose(99, 60) + " " + " ".join(f"copied{j}" for j in range(40)) + " grobian"
    rows += [(5000 + k, f"{copied} {k}") for k in range(60)]
    labels += [(5000 + k, 1, 1) for k in range(60)]
    sample = quality.training_sample(documents(spark, rows), _labels(spark, labels), "toxic", FtrlParams())
    lexicon = toxicity.induce_lexicon(sample, toxicity.ToxicityParams())
    assert 1 <= len(lexicon) <= 8


def test_binomial_tail():
    assert abs(toxicity._tail(3, 3, 0.5) - 0.125) < 1e-12 and abs(toxicity._tail(0, 5, 0.3) - 1) < 1e-12
    assert abs(toxicity._tail(2, 3, 0.25) - (3 * 0.0625 * 0.75 + 0.015625)) < 1e-12


def test_held_out_labels_never_matter(spark):
    rows, labels = _corpus(150, 3)
    flipped = [(i, 1 - q, 1 - t) if out_fold(i) else (i, q, t) for i, q, t in labels]
    df = documents(spark, rows)
    for op in (quality.quality_scores, toxicity.toxicity_scores):
        a, b = ({r.doc_id: r.score for r in op(df, _labels(spark, x)).collect()} for x in (labels, flipped))
        assert a == b


def test_scores_depend_on_the_text_alone(spark):
    rows, labels = _corpus(120, 4)
    twin = [(10_000 + i, t, "xx", "other") for i, t in rows]
    for op in (quality.quality_scores, toxicity.toxicity_scores):
        s = {r.doc_id: r.score for r in op(documents(spark, rows + twin), _labels(spark, labels)).collect()}
        assert all(s[i] == s[10_000 + i] for i, _ in rows)


def test_awkward_rows_and_empty_tables(spark):
    rows, labels = _corpus(60, 5)
    labels += [(0, None, None), (None, 1, 0), (77_777, 0, 1), (3, 7, -1)]
    df = documents(spark, rows + awkward(9))
    for op in (quality.quality_scores, toxicity.toxicity_scores):
        got = op(df, _labels(spark, labels)).collect()
        assert len(got) == len(rows) + len(awkward(9))
        by_text = {r.doc_id: r.score for r in got}
        assert by_text[4] is not None and 0 <= by_text[4] <= 1
        assert op(df.where("false"), _labels(spark, labels)).count() == 0
        none = op(df, _labels(spark, labels).where("false")).collect()
        assert len(none) == len(got) and len({r.score for r in none}) == 1
    assert {r.predicted for r in toxicity.toxicity_scores(df, _labels(spark, labels).where("false")).collect()} <= {0, 1}


def test_a_repeated_id_does_not_make_the_sample_larger(spark):
    rows, labels = _corpus(60, 6)
    same = [(1, "one text, many rows")] * 500
    other = [(1, f"text {i} of one id") for i in range(300)]
    df, p = documents(spark, rows + same + other), FtrlParams(max_rows=100)
    for label in ("quality", "toxic"):
        got = quality.training_sample(df, _labels(spark, labels), label, p).collect()
        assert len(got) == len({(r.doc_id, r.text) for r in got}) <= 100
        assert not any(out_fold(r.doc_id) for r in got)
    wide = quality.training_sample(df, _labels(spark, labels), "toxic", FtrlParams()).collect()
    assert sum(r.doc_id == 1 for r in wide) == 302         # its own, the repeated one, 300 others
    langs = [(i, f"{t} {i}", "aa" if i % 2 else "bb", "s") for i, t in rows] + [(1, t, "aa", "s") for _, t in same + other]
    got = langid.training_rows(documents(spark, langs), CrfParams(per_lang=20)).collect()
    assert [sum(r.lang == x for r in got) for x in ("aa", "bb")] == [20, 20]
    assert len(got) == len({tuple(r) for r in got})


def test_every_language_is_learned_whatever_its_name_or_it_is_an_error(spark):
    rows = [(k * 10 + j, " ".join([f"{chr(97 + k % 26)}{chr(97 + k // 26)}{v}" for v in ("oku", "ile", "ana")] * 5),
             f"l{k}\nx", "s") for k in range(70) for j in range(6)]
    out = langid.identify(documents(spark, rows), CrfParams(epochs=8, batch=64, dim=1 << 14)).collect()
    assert {r.lang_pred for r in out} == {f"l{k}\nx" for k in range(70)}
    with pytest.raises(ValueError):
        langid.identify(documents(spark, rows), CrfParams(max_langs=69))


def test_ftrl_learns_a_separable_rule():
    r = np.random.default_rng(1)
    ex = []
    for _ in range(300):
        i = np.unique(np.r_[r.integers(0, 60, 6), 64])
        ex.append((i, np.ones(len(i)), float(7 in i)))
    w = ftrl.ftrl(ex, 64, FtrlParams(dim=64, alpha=0.5, l1=0.1, l2=0.0, updates=3000))
    right = [((w[i] @ v > 0) == bool(y)) for i, v, y in ex]
    assert np.mean(right) > 0.97 and w[7] > 1


def test_label_model_recovers_accuracies_and_shares_weight_of_copies():
    r = np.random.default_rng(2)
    y = r.random(4000) < 0.2
    rates = [(0.02, 0.6), (0.01, 0.5), (0.05, 0.7)]
    votes = np.stack([r.random(4000) < np.where(y, b, a) for a, b in rates], axis=1)
    votes = np.concatenate([votes, votes[:, :1]], axis=1)                   # a copied voter
    silent = ~votes.any(axis=1, keepdims=True)
    v = np.concatenate([votes, silent], axis=1).astype(np.uint8)
    m = toxicity.fit_label_model(v, 4, 60)
    assert abs(m.prior - 0.2) < 0.08
    assert m.keep[0] < 0.7 and m.keep[3] < 0.7 and m.keep[1] > 0.8 and m.keep[2] > 0.8
    p = m.posterior(v.astype(float))
    assert np.mean((p > 0.5) == y) > 0.9
    once, n = np.unique(v, axis=0, return_counts=True)                      # equal vectors once
    c = toxicity.fit_label_model(once, 4, 60, n)
    assert abs(c.prior - m.prior) < 1e-6 and np.allclose(c.rate, m.rate) and np.allclose(c.keep, m.keep)


LANGS = {"aa": ["baku", "lomi", "tera", "suno", "vika"], "bb": ["schnor", "grecht", "pflong", "wurst", "ding"],
         "cc": ["eaux", "oiment", "elle", "avec", "queur"]}


def _lang_rows(n=150, seed=3):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        lang = r.choice(sorted(LANGS))
        words = [r.choice(LANGS[lang]) + r.choice(["", "a", "en", "is"]) for _ in range(r.randrange(3, 60))]
        rows.append((k, ". ".join(" ".join(words[j:j + 9]) for j in range(0, len(words), 9)), lang, "s"))
    return rows


def test_language_id_generalises_and_handles_awkward_rows(spark):
    rows = _lang_rows()
    odd = [(1000, None, "aa", "s"), (1001, "", "bb", "s"), (1002, "12 34 !!", "bb", "s"), (None, "baku lomi tera", "aa", "s"),
           (1004, "schnor grecht wurst ding " * 4000, None, "s"), (1005, "Ж", None, "s"), (1006, "€ 5", None, "s")]
    out = {r.doc_id: r for r in langid.identify(documents(spark, rows + odd, extra=True), CrfParams(epochs=6)).collect()}
    assert all(out[i].lang_pred == lang for i, _, lang, _ in rows if out_fold(i))
    assert all(out[i].held_out == out_fold(i) for i, *_ in rows)
    assert [out[k].lang_pred for k in (1000, 1001, 1002, 1006)] == ["und"] * 4 and out[None].lang_pred == "aa"
    assert out[1004].lang_pred == "bb" and out[1005].lang_pred in LANGS
    assert all(0 <= r.score <= 1 for r in out.values())
    df = documents(spark, rows)
    assert langid.identify(df.where("false")).count() == 0
    from pyspark.sql import functions as F
    none = langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


def test_code_switched_text_changes_label_inside(spark):
    rows = _lang_rows(300, 5)
    both = "baku lomi tera suno vika baku tera lomi schnor grecht pflong wurst ding grecht schnor pflong"
    out = {r.doc_id: r for r in langid.identify(documents(spark, rows + [(5000, both, None, "s")]), CrfParams(epochs=6)).collect()}
    assert out[5000].switches == 1 and out[5000].n_words == 16


def test_forward_backward_equals_enumeration():
    r = np.random.default_rng(3)
    lengths = np.array([1, 4, 2, 5, 1])
    start = np.cumsum(lengths) - lengths
    emit, trans = r.normal(size=(lengths.sum(), 3)), r.normal(size=(3, 3))
    gamma, log_z, expected = langid.forward_backward(emit, start, lengths, trans)
    want_t = np.zeros((3, 3))
    for c, (s, n) in enumerate(zip(start, lengths)):
        paths = list(itertools.product(range(3), repeat=int(n)))
        score = np.array([sum(emit[s + t, p[t]] for t in range(n)) + sum(trans[p[t], p[t + 1]] for t in range(n - 1))
                          for p in paths])
        z = np.logaddexp.reduce(score)
        prob = np.exp(score - z)
        assert abs(z - log_z[c]) < 1e-9
        for t in range(n):
            for k in range(3):
                assert abs(gamma[s + t, k] - sum(q for q, p in zip(prob, paths) if p[t] == k)) < 1e-9
        for q, p in zip(prob, paths):
            for t in range(n - 1):
                want_t[p[t], p[t + 1]] += q
    assert np.allclose(expected, want_t)


def test_sentences_and_word_features_of_a_block():
    b = pa.RecordBatch.from_pydict({"text": ["ab cd. ef\ngh", "", "ij"]})
    from affinity.llm.textcore import text_blocks
    (_, _, data, offsets), = text_blocks(b)
    s = langid.Sentences(data, offsets, 1 << 10)
    assert s.length.tolist() == [2, 1, 1, 1] and s.row.tolist() == [0, 0, 0, 0, 2] and s.types == 5
