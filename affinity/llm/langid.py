"""Language ID: a linear-chain conditional random field over the words of a text.

A word's emission sums hashed affix, character n-gram and whole-word
(lexicon) weights; transitions between neighbouring words are learned.
Forward-backward gives every word of code-switched text a posterior over
languages; a document's language is the one with the largest mean posterior.

A chain is a sentence (words up to ``.``, ``!``, ``?`` or a line break) of any
length.  Training chains join sentences of different documents, so that
the switch from one language to another is seen and learned.
The model is fitted in one task on a bounded sample (``per_lang`` rows of
each language, of which there may be ``max_langs``); labelling is one scan.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out, saved
from .ftrl import LETTER, Tokens
from .textcore import BASE, mix, text_blocks

UNDETERMINED = "und"


@dataclass(frozen=True)
class CrfParams:
    dim: int = 1 << 17
    per_lang: int = 300
    max_langs: int = 128       # more are an error
    epochs: int = 3
    batch: int = 512
    rate: float = 0.3
    l2: float = 1e-6
    joined: int = 3            # sentences per training chain
    seed: int = 11


class Sentences:
    """Words of a block, their distinct types with features, and chains."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, dim: int):
        t = Tokens(data, offsets)
        m = t.kind == LETTER
        self.row, s, e = t.row[m], t.s[m], t.e[m]
        stop = np.zeros(len(data) + 1, np.int64)
        np.cumsum(np.isin(data, (0x2E, 0x21, 0x3F, 0x0A)), out=stop[1:])
        first = np.ones(len(s), bool)
        first[1:] = (self.row[1:] != self.row[:-1]) | (stop[s[1:]] > stop[e[:-1]])
        self.start = np.flatnonzero(first)
        self.length = np.diff(np.r_[self.start, len(s)])
        _, at, self.type = np.unique(t.hash[m], return_index=True, return_inverse=True)
        self.feature_type, self.slot = _features(t.prefix, t.hash[m][at], s[at], e[at], dim)
        self.types = len(at)

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        """(words x labels) sums of feature weights."""
        per = np.stack([np.bincount(self.feature_type, weights[self.slot, k], self.types)
                        for k in range(weights.shape[1])], axis=1)
        return per[self.type] if self.types else np.zeros((0, weights.shape[1]))


def _features(prefix, word, s, e, dim: int):
    """(type, slot): whole word, prefixes and suffixes of 1-4 bytes, 2- and 3-grams."""
    n = len(s)
    ids, hashes = [np.arange(n)], [mix(word + BASE)]
    for k in (1, 2, 3, 4):
        ids += [np.arange(n)] * 2
        hashes += [mix(prefix.of(s, np.minimum(s + k, e)) + np.uint64(10 + k)),
                   mix(prefix.of(np.maximum(e - k, s), e) + np.uint64(20 + k))]
    for k in (2, 3):
        c = np.maximum(e - s - k + 1, 0)
        own = np.repeat(np.arange(n), c)
        at = np.arange(len(own)) - np.repeat(np.cumsum(c) - c, c) + s[own]
        ids.append(own)
        hashes.append(mix(prefix.of(at, at + k) + np.uint64(30 + k)))
    return np.concatenate(ids), (np.concatenate(hashes) & np.uint64(dim - 1)).astype(np.int64)


def forward_backward(emit: np.ndarray, start: np.ndarray, length: np.ndarray, trans: np.ndarray):
    """(posteriors, log Z per chain, expected transitions) of many chains at once.

    Chains advance in step, longest first, so each step is one array operation
    over the chains still running; probabilities are rescaled at each word.
    """
    labels = trans.shape[0]
    gamma = np.zeros_like(emit)
    if not len(start):
        return gamma, np.zeros(0), np.zeros((labels, labels))
    order = np.argsort(-length, kind="stable")
    st, ln = start[order], length[order]
    top = emit.max(axis=1, keepdims=True)
    psi, m = np.exp(emit - top), np.exp(trans)
    alpha, scale = np.zeros_like(emit), np.zeros(len(emit))
    active = np.searchsorted(-ln, -np.arange(ln[0]), side="left")       # chains longer than t
    a = None
    for t in range(ln[0]):
        k = active[t]
        i = st[:k] + t
        a = psi[i] if t == 0 else (a[:k] @ m) * psi[i]
        z = a.sum(axis=1)
        a = a / z[:, None]
        alpha[i], scale[i] = a, z
    expected = np.zeros((labels, labels))
    beta = np.ones((len(st), labels))
    for t in range(ln[0] - 1, -1, -1):
        k = active[t]
        i = st[:k] + t
        if t + 1 < ln[0]:
            nk = active[t + 1]
            j = st[:nk] + t + 1
            right = psi[j] * beta[:nk] / scale[j][:, None]
            expected += m * (alpha[i[:nk]].T @ right)
            beta[:nk] = right @ m.T
        g = alpha[i] * beta[:k]
        gamma[i] = g / g.sum(axis=1, keepdims=True)
    log_z = np.add.reduceat(np.log(scale) + top[:, 0], start)
    return gamma, log_z, expected


def fit_crf(batch: pa.RecordBatch, langs: np.ndarray, labels: int, p: CrfParams):
    """(emission weights dim x labels, transitions) by AdaGrad on the likelihood."""
    rng = np.random.default_rng(p.seed)
    w, gw = np.zeros((p.dim, labels)), np.full((p.dim, labels), 1e-2)
    tr, gt = np.zeros((labels, labels)), np.full((labels, labels), 1e-2)
    blocks = [(Sentences(d, o, p.dim), langs[i:j]) for i, j, d, o in text_blocks(batch)]
    chains = [(b, q) for b, (s, _) in enumerate(blocks) for q in range(len(s.start))]
    chains = np.array(chains, np.int64).reshape(-1, 2)
    for _ in range(p.epochs):
        chains = chains[rng.permutation(len(chains))]
        for c in range(0, len(chains), p.batch):
            part = chains[c:c + p.batch]
            emits, gold, feats, total = [], [], [], 0
            for b in np.unique(part[:, 0]):
                s, y = blocks[b]
                q = part[part[:, 0] == b, 1]
                words = np.concatenate([np.arange(s.start[x], s.start[x] + s.length[x]) for x in q])
                types, local = np.unique(s.type[words], return_inverse=True)
                keep = np.isin(s.feature_type, types)
                ft, sl = np.searchsorted(types, s.feature_type[keep]), s.slot[keep]
                e = np.stack([np.bincount(ft, w[sl, k], len(types)) for k in range(labels)], axis=1)[local]
                emits.append(e)
                gold.append(y[s.row[words]])
                feats.append((ft, sl, local, len(types)))
                total += len(words)
            sizes = np.concatenate([blocks[b][0].length[part[part[:, 0] == b, 1]] for b in np.unique(part[:, 0])])
            emit, gold = np.concatenate(emits), np.concatenate(gold)
            # sentences of different documents joined into chains
            begin = np.cumsum(sizes) - sizes
            mixed = rng.permutation(len(sizes))
            idx = np.concatenate([np.arange(begin[x], begin[x] + sizes[x]) for x in mixed])
            joined = np.add.reduceat(sizes[mixed], np.arange(0, len(mixed), p.joined))
            starts = np.cumsum(joined) - joined
            gamma, _, expected = forward_backward(emit[idx], starts, joined, tr)
            diff = np.zeros_like(emit)
            diff[idx] = -gamma
            diff[np.arange(total), gold] += 1
            inner = np.ones(total, bool)
            inner[starts] = False
            at = np.flatnonzero(inner)
            seen = np.zeros((labels, labels))
            np.add.at(seen, (gold[idx][at - 1], gold[idx][at]), 1)
            g = (seen - expected) / total
            gt += g * g
            tr += p.rate * g / np.sqrt(gt)
            grad, lo = np.zeros_like(w), 0
            for ft, sl, local, n in feats:
                d = diff[lo:lo + len(local)]
                lo += len(local)
                for k in range(labels):
                    grad[:, k] += np.bincount(sl, np.bincount(local, d[:, k], n)[ft], p.dim)
            grad = grad / total * 100 - p.l2 * w
            gw += grad * grad
            w += p.rate * grad / np.sqrt(gw)
    return w.astype(np.float32), tr


def training_rows(documents: DataFrame, p: CrfParams) -> DataFrame:
    """(lang, doc_id, text): at most ``per_lang`` rows of every language.

    Those of the ids of smallest hash; equal rows count once.  More than
    ``max_langs`` languages are an error: the weights of all must fit the training task.
    """
    ids = documents.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                          & ~held_out(F.col("doc_id"))).select("lang", "doc_id").distinct()
    order = [F.xxhash64("doc_id", F.lit(p.seed)), F.col("doc_id")]
    pick = saved(ids.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
                 .where(F.col("r") <= p.per_lang).select("lang", "doc_id"), "lang_ids")
    langs = pick.select("lang").distinct().limit(p.max_langs + 1).count()
    if langs > p.max_langs:
        raise ValueError(f"more than {p.max_langs} languages: set CrfParams.max_langs "
                         f"(training takes about {40 * p.dim >> 20} MB for each)")
    # per_lang * max_langs rows at most
    rows = documents.select("lang", "doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(pick), ["lang", "doc_id"]).distinct()
    # an id may have many texts: the bound holds for rows too
    w = Window.partitionBy("lang").orderBy(*order, F.xxhash64("text"), "text")
    return rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= p.per_lang).drop("r")


def fit_langid(documents: DataFrame, p: CrfParams):
    """(languages, emission weights, transitions) or None without labelled text."""
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "lang", "text"], kind="stable")
        names = sorted(pdf["lang"].unique())
        y = pdf["lang"].map({v: i for i, v in enumerate(names)}).to_numpy()
        b = pa.RecordBatch.from_pydict({"text": pa.array(pdf["text"].tolist(), pa.string())})
        w, tr = fit_crf(b, y, len(names), p)
        return pd.DataFrame({"langs": [names], "w": [w.tobytes()], "t": [tr.tobytes()]})

    got = (training_rows(documents, p).withColumn("one", F.lit(0)).groupBy("one")
           .applyInPandas(fit, "langs array<string>, w binary, t binary").collect())
    if not got:
        return None
    names = list(got[0].langs)
    w = np.frombuffer(got[0].w, np.float32).reshape(p.dim, len(names))
    return names, w, np.frombuffer(got[0].t).reshape(len(names), len(names))


def identify(documents: DataFrame, p: CrfParams | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_words, switches) for every document.

    ``lang_pred`` is ``und`` with score 0 where text is null or has no
    letter, and everywhere when nothing could be learned.  ``score`` is the
    mean posterior of the predicted language, ``switches`` the number of
    neighbouring words with different labels.  Ties go to the language first
    in the alphabet; a null doc_id is scored and counts as not held out;
    repeated rows are scored each; extra columns are ignored.
    """
    p = p or CrfParams()
    model = fit_langid(documents, p)
    src = documents.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    shared = documents.sparkSession.sparkContext.broadcast(model)      # dim x languages floats

    def label(batches):
        m = shared.value
        for b in batches:
            letter = b.column(2).to_numpy(zero_copy_only=False)
            lang = np.full(b.num_rows, UNDETERMINED, object)
            conf, words, switches = (np.zeros(b.num_rows) for _ in range(3))
            for i, j, data, offsets in text_blocks(b) if m else ():
                names, w, tr = m
                s = Sentences(data, offsets, p.dim)
                gamma, _, _ = forward_backward(s.emissions(w), s.start, s.length, tr)
                n = np.bincount(s.row, minlength=j - i)
                mean = np.stack([np.bincount(s.row, gamma[:, k], j - i) for k in range(len(names))],
                                axis=1) / np.maximum(n, 1)[:, None]
                best = mean.round(9).argmax(axis=1)
                ok = letter[i:j] & (n > 0)
                lang[i:j] = np.where(ok, np.array(names, object)[best], UNDETERMINED)
                conf[i:j] = np.where(ok, np.clip(mean.max(axis=1), 0, 1), 0)
                words[i:j] = n
                tag = gamma.argmax(axis=1)
                sw = (tag[1:] != tag[:-1]) & (s.row[1:] == s.row[:-1])
                switches[i:j] = np.bincount(s.row[1:][sw], minlength=j - i)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang, pa.string()), pa.array(conf), pa.array(words.astype(np.int64)),
                 pa.array(switches.astype(np.int64))], ["doc_id", "lang_pred", "score", "n_words", "switches"])

    kind = src.schema["doc_id"].dataType.simpleString()
    out = src.mapInArrow(label, f"doc_id {kind}, lang_pred string, score double, n_words long, switches long")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                      "lang_pred", "score", "n_words", "switches")
