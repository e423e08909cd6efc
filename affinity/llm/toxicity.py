"""Toxicity by weak supervision.

1. Voters.  The lexicon is induced from the labelled sample outside the
   held-out fold: the words and word beginnings most associated with the toxic
   label (distributed counts, smoothed log-odds, an exact test).  The strongest
   first, an entry becomes a voter if it passes the test on the toxic rows that no
   voter before it explains, so there are as many voters as the vocabulary needs
   and the words of copied texts do not all vote.  Pattern voters (shouting, exclamation runs, symbol runs,
   repeated words) join them.
2. Label model.  A latent class explains the votes: EM estimates the class
   prior and each voter's firing rate per class without the labels; a voter
   that does not fire abstains, and one more voter speaks for clean when the whole
   lexicon is silent.  Voters strongly correlated inside the classes say
   the same thing and share one voter's weight.
3. Classifier.  A hashed linear model (FTRL) is trained on the posteriors and
   scores every document in one scan.

The driver only sees the toxic rows of the entries and the distinct vote vectors
of the bounded sample, and the model.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, saved
from .ftrl import LETTER, PUNCT, FeatureMap, FtrlParams, Tokens, _slots, presence, score, train
from .quality import training_sample
from .textcore import BASE, mix, text_blocks

#: Bytes of a word's beginning that count as a lexicon entry of their own.
STEM_BYTES = 4
PATTERNS = 4
#: Correlation inside the classes from which voters count as dependent.
DEPENDENT = 0.5
#: Voters whose correlations with all others are held at a time.
VOTER_BLOCK = 512
THRESHOLD = 0.5


@dataclass(frozen=True)
class ToxicityParams:
    """support: least number of toxic sample rows of an entry, whose log-odds
    must exceed least_odds; chance: most probable its toxic share may be by
    chance (binomial tail at the sample's share of toxic rows)."""

    support: int = 4
    least_odds: float = 1.5
    chance: float = 0.001
    rounds: int = 30
    ftrl: FtrlParams = FtrlParams(alpha=0.3, l1=7.5, l2=0.0, epochs=6, shard_rows=6_000)


def _terms(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word and of the beginnings of longer words."""
    m = t.kind == LETTER
    s, e, row, h = t.s[m], t.e[m], t.row[m], t.hash[m]
    rows, hashes = [row], [mix(h + BASE)]
    long = e - s > STEM_BYTES
    for n in (STEM_BYTES, STEM_BYTES + 1):
        rows.append(row[long])
        hashes.append(mix(t.prefix.of(s[long], np.minimum(s[long] + n, e[long])) + np.uint64(n)))
    return np.concatenate(rows), np.concatenate(hashes)


def term_features(data, offsets, dim: int):
    row, h = _terms(Tokens(data, offsets))
    return row, _slots(h, 5, dim)


FEATURES = FeatureMap(term_features, presence)


def _patterns(t: Tokens, rows: int) -> np.ndarray:
    """Pattern votes per row: shouting, exclamation runs, symbol runs, repeated words."""
    def count(mask):
        return np.bincount(t.row[mask], minlength=rows)

    n = np.maximum(1, count(np.ones(len(t.row), bool)))
    again = np.zeros(len(t.row), bool)
    if len(t.row):
        again[1:] = (t.hash[1:] == t.hash[:-1]) & (t.row[1:] == t.row[:-1])
    punct = t.kind == PUNCT
    long = punct & (t.e - t.s >= 2)
    return np.stack([count(t.shouted) / n > 0.3, count(punct) / n > 0.4,
                     count(long) / n > 0.2, count(again) / n > 0.2], axis=1)


def votes_of(data, offsets, lexicon: np.ndarray) -> np.ndarray:
    """0/1 votes (rows x voters) of a text block: lexicon (sorted), patterns, silence."""
    rows = len(offsets) - 1
    t = Tokens(data, offsets)
    v = np.zeros((rows, len(lexicon) + PATTERNS + 1), np.uint8)
    r, h = _terms(t)
    if len(lexicon) and len(h):
        at = np.minimum(np.searchsorted(lexicon, h), len(lexicon) - 1)
        hit = lexicon[at] == h
        v[r[hit], at[hit]] = 1
    v[:, len(lexicon):-1] = _patterns(t, rows)
    v[:, -1] = ~v[:, :len(lexicon)].any(axis=1)
    return v


def _tail(a: int, n: int, share: float) -> float:
    """Probability of ``a`` or more successes in ``n`` trials."""
    k = np.arange(a, n + 1)
    log_choose = np.array([math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in k])
    return float(np.exp(log_choose + k * math.log(share) + (n - k) * math.log1p(-share)).sum())


def induce_lexicon(sample: DataFrame, p: ToxicityParams) -> np.ndarray:
    """Sorted hashes of the voters among the terms associated with the toxic label."""
    def terms(batches):
        for b in batches:
            y, key = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("y", "row"))
            for i, j, data, offsets in text_blocks(b):
                row, h = _terms(Tokens(data, offsets))
                pair = np.unique(np.stack([row.astype(np.uint64), h]), axis=1)
                at = pair[0].astype(np.int64) + i
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[1].view(np.int64)), pa.array(y[at].astype(np.int64)), pa.array(key[at])],
                    ["term", "y", "row"])

    n1, n0 = (sample.agg(F.sum(F.when(F.col("y") == v, 1).otherwise(0))).first()[0] or 0 for v in (1, 0))
    if not n1 or not n0:
        return np.zeros(0, np.uint64)
    found = sample.select("y", "text", F.xxhash64("doc_id", "text").alias("row")).mapInArrow(
        terms, "term long, y long, row long")
    c = found.groupBy("term").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))

    def sure(a: int, b: int) -> bool:
        odds = math.log((a + 0.5) / (n1 + 1.0)) - math.log((b + 0.5) / (n0 + 1.0))
        return a >= p.support and odds > p.least_odds and _tail(a, a + b, n1 / (n1 + n0)) < p.chance

    odds = F.log((F.col("a") + 0.5) / (n1 + 1.0)) - F.log((F.col("b") + 0.5) / (n0 + 1.0))
    c = c.where((F.col("a") >= p.support) & (odds > p.least_odds))
    pairs = [(r.a, r.b) for r in c.select("a", "b").distinct().collect() if sure(r.a, r.b)]
    if not pairs:
        return np.zeros(0, np.uint64)
    pairs = F.broadcast(sample.sparkSession.createDataFrame(pairs, "a long, b long"))
    strong = c.join(pairs, ["a", "b"]).select("term", "b", F.round(odds * F.sqrt("a"), 9).alias("strength"))
    # toxic rows of strong terms, of the bounded sample
    rows = (found.where("y = 1").join(strong, "term").groupBy("term", "b", "strength")
            .agg(F.collect_list("row").alias("rows")).collect())
    explained, voters = set(), []
    for r in sorted(rows, key=lambda r: (-r.strength, r.term)):
        new = [x for x in r.rows if x not in explained]
        if sure(len(new), r.b):
            voters.append(r.term)
            explained.update(new)
    return np.sort(np.array(voters, np.int64).view(np.uint64))


@dataclass
class LabelModel:
    """rate[y, j]: voter j fires in class y; keep[j]: weight after correlations."""

    prior: float
    rate: np.ndarray
    keep: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        fire = np.log(self.rate[1] / self.rate[0]) * self.keep
        z = np.log(self.prior / (1 - self.prior)) + votes @ fire
        return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def _dependence(v: np.ndarray, w: np.ndarray, mass: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Sum of each voter's strong correlations inside the classes, a block of voters at a time."""
    n, share = mass.sum(), mass / mass.sum()
    sd = np.sqrt(np.maximum(share @ (rate - rate ** 2), 1e-9))
    out = np.zeros(v.shape[1])
    for i in range(0, v.shape[1], VOTER_BLOCK):
        part = slice(i, i + VOTER_BLOCK)
        together = (v[:, part] * (w.sum(axis=0) / n)[:, None]).T @ v
        rho = np.clip((together - (rate[:, part] * share[:, None]).T @ rate) / np.outer(sd[part], sd), 0, 1)
        rho[np.arange(rho.shape[0]), np.arange(i, i + rho.shape[0])] = 0
        out[part] = np.where(rho < DEPENDENT, 0, rho).sum(axis=1)
    return out


def fit_label_model(votes: np.ndarray, lexicon: int, rounds: int, counts: np.ndarray | None = None) -> LabelModel:
    """EM over vote vectors (rows of ``counts`` copies); a row starts toxic if a lexicon voter fires."""
    v = votes.astype(np.float32)
    m = v.shape[1]
    counts = np.ones(len(v)) if counts is None else counts.astype(float)
    model = LabelModel(0.1, np.full((2, m), 0.5), np.ones(m))
    if not len(v) or not lexicon:
        return LabelModel(1e-6, model.rate, model.keep)
    post = np.where(v[:, :lexicon].sum(axis=1) > 0, 0.9, 0.02)
    for _ in range(rounds):
        w = np.stack([1 - post, post]) * counts
        mass = w.sum(axis=1)
        rate = np.clip((w @ v + 0.1) / (mass[:, None] + 1.0), 1e-5, 1 - 1e-5)
        model = LabelModel(float(np.clip(mass[1] / mass.sum(), 1e-4, 0.9)), rate,
                           1.0 / (1.0 + _dependence(v, w, mass, rate)))
        new = model.posterior(v)
        if np.abs(new - post).max() < 1e-4:
            break
        post = new
    return model


def fit_toxicity(documents: DataFrame, labels: DataFrame, p: ToxicityParams) -> np.ndarray:
    sample = saved(training_sample(documents, labels, "toxic", p.ftrl), "toxic_sample")
    lexicon = induce_lexicon(sample, p)

    def votes(batches):
        for b in batches:
            for i, j, data, offsets in text_blocks(b):
                v = votes_of(data, offsets, lexicon)
                v = np.packbits(v, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in v], pa.binary())], ["v"])

    # training_sample holds max_rows rows at most, whatever repeats; one bit a vote, equal vectors once
    rows = sample.select("text").mapInArrow(votes, "v binary").groupBy("v").count().orderBy("v").collect()
    width = len(lexicon) + PATTERNS + 1
    packed = np.frombuffer(b"".join(r.v for r in rows), np.uint8).reshape(len(rows), -(-width // 8))
    matrix = np.unpackbits(packed, axis=1, count=width)
    model = fit_label_model(matrix, len(lexicon), p.rounds, np.array([r["count"] for r in rows]))

    def labelled(batches):
        for b in batches:
            y = np.zeros(b.num_rows)
            for i, j, data, offsets in text_blocks(b):
                y[i:j] = model.posterior(votes_of(data, offsets, lexicon).astype(float))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(y)], ["doc_id", "text", "y"])

    soft = sample.select("doc_id", "text").mapInArrow(
        labelled, f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, text string, y double")
    return train(soft, FEATURES, p.ftrl)


def toxicity_scores(documents: DataFrame, labels: DataFrame, p: ToxicityParams | None = None,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, held_out, score, predicted) for every document.

    Null and empty texts get the classifier's bias; a null doc_id is scored
    and counts as not held out; repeated rows are scored each.  Without
    labels of both kinds there is no lexicon, the model knows no toxic class
    and nothing is predicted toxic.  Extra columns are ignored unless kept.
    """
    p = p or ToxicityParams()
    s = score(documents, fit_toxicity(documents, labels, p), FEATURES, p.ftrl.dim, keep=keep)
    return s.select("doc_id", *keep, F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
