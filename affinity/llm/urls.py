"""URL filter: rules first, then a character language-model ratio.

Two smoothed variable-order Markov models over the characters of ``host/path``
are counted from the URLs the rules allow and the URLs they block.  A URL
without a rule is judged by its length-normalised log-likelihood difference
against a calibrated threshold.  DataFrame functions only.

The models use an alphabet folded to 30 symbols (a-z, ``0`` for any digit,
``.``, ``/``, ``-`` for everything else), so the table of order-3 contexts
has at most 30**4 rows whatever the corpus holds: that is the proven bound
under which the scored n-grams are broadcast.  Counts are partially
aggregated before their shuffle and cover every URL that has a rule.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

ALPHABET = 30
#: Contract rules: (verdict, rule as host/path prefix).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))


@dataclass(frozen=True)
class UrlModel:
    """order: characters of context; mass: weight of the shorter context."""

    order: int = 3
    mass: float = 2.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, nulls where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, text in sorted(rules, key=lambda r: len(r[1])):       # the longest is tested last and wins
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _folded(c: Column) -> Column:
    s = F.regexp_replace(F.lower(c), "[0-9]+", "0")
    return F.regexp_replace(s, "[^a-z0./]", "-")


def _grams(df: DataFrame, order: int) -> DataFrame:
    """One row per character: its context and itself, ``order + 1`` characters."""
    n = F.length("s")
    return (df.withColumn("s", F.concat(F.lit("/" * order), _folded(F.concat("host", "path")), F.lit("/")))
            .withColumn("i", F.explode(F.sequence(F.lit(1), n - order)))
            .withColumn("gram", F.substring("s", F.col("i"), F.lit(order + 1))))


def ratio_table(labelled: DataFrame, p: UrlModel) -> DataFrame:
    """(gram, llr): log P(last | context) under allowed minus blocked URLs.

    Smoothing is recursive over the context length: P_k = (c(ctx, x) + m *
    P_{k-1}) / (c(ctx) + m), ending in the uniform distribution.  Only grams seen in
    either class are kept with full context; the others back off (``llr_at``).
    """
    g = _grams(labelled, p.order).groupBy("gram").agg(
        F.sum(F.when(F.col("verdict") == "allow", 1).otherwise(0)).cast("double").alias("a"),
        F.sum(F.when(F.col("verdict") == "block", 1).otherwise(0)).cast("double").alias("b"))
    g = saved(g, "url_grams")
    full = None
    for k in range(p.order + 1):
        # n-grams of k context characters: a sum over the longer ones
        ck = (g.groupBy(F.substring("gram", p.order + 1 - k, k + 1).alias("gram"))
              .agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
        ctx = (ck.groupBy(F.substring("gram", 1, k).alias("ctx"))
               .agg(F.sum("a").alias("ca"), F.sum("b").alias("cb")))
        t = ck.withColumn("ctx", F.substring("gram", 1, k)).join(ctx, "ctx")
        if full is None:
            pa_, pb_ = F.lit(1.0 / ALPHABET), F.lit(1.0 / ALPHABET)
        else:
            low = full.select(F.col("gram").alias("low"), F.col("pa").alias("la"), F.col("pb").alias("lb"))
            t = t.join(low, F.substring("gram", 2, k) == F.col("low"))
            pa_, pb_ = F.col("la"), F.col("lb")
        t = t.select("gram", ((F.col("a") + p.mass * pa_) / (F.col("ca") + p.mass)).alias("pa"),
                     ((F.col("b") + p.mass * pb_) / (F.col("cb") + p.mass)).alias("pb"),
                     F.lit(k).alias("k"))
        full = saved(t, f"url_order{k}")
        levels = [full] if k == 0 else [*levels, full]          # noqa: F821
    return reduce(DataFrame.unionByName, levels).select(
        "gram", "k", F.log(F.col("pa") / F.col("pb")).alias("llr"))


def score_urls(urls: DataFrame, table: DataFrame, p: UrlModel) -> DataFrame:
    """(host, path, score): mean log-likelihood difference per character.

    A gram unseen with its full context takes the longest seen shorter one.
    """
    u = urls.select("host", "path").distinct()
    grams = _grams(u, p.order)
    # distinct grams first: at most ALPHABET ** (order + 1) rows meet the levels
    d = grams.select("gram").distinct()
    for k in range(p.order + 1):
        lk = table.where(F.col("k") == k).select(F.col("gram").alias(f"g{k}"), F.col("llr").alias(f"l{k}"))
        d = d.join(lk, F.substring("gram", p.order + 1 - k, k + 1) == F.col(f"g{k}"), "left")
    d = d.select(F.col("gram").alias("g"), F.coalesce(*[f"l{k}" for k in range(p.order, -1, -1)],
                                                      F.lit(0.0)).alias("llr"))
    d = saved(d, "url_ratio")
    # bounded by the folded alphabet, see the module's text
    return (grams.join(F.broadcast(d), F.col("gram") == F.col("g"))
            .groupBy("host", "path")
            .agg((F.sum(F.round("llr", 9).cast("decimal(18,9)")).cast("double") / F.count(F.lit(1))).alias("score")))


def filter_urls(pages: DataFrame, rules=RULES, p: UrlModel | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, threshold).

    ``verdict`` is the rule's, else ``allow`` where score >= threshold, else
    ``block``.  The threshold is the midpoint of the mean scores of allowed
    and blocked URLs; without URLs of both kinds there is no evidence and
    everything without a rule is allowed.  Null urls and urls without ``://``
    have empty host and path and are judged like any other; repeated rows
    stay; extra columns are ignored.
    """
    p = p or UrlModel()
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    u = saved(pages.select("page_id", host.alias("host"), path.alias("path"))
              .withColumn("rule", rule).withColumn("verdict", verdict), "url_parts")
    table = ratio_table(u.where(F.col("verdict").isNotNull()), p)
    # one score per distinct address; a hot address is one row here
    s = saved(score_urls(u, table, p), "url_scores")
    seen = u.where(F.col("verdict").isNotNull()).groupBy("host", "path", "verdict").agg(F.count(F.lit(1)).alias("n"))
    means = seen.join(s, ["host", "path"]).agg(
        *[(F.sum(F.when(F.col("verdict") == v, F.col("score") * F.col("n")))
           / F.sum(F.when(F.col("verdict") == v, F.col("n")))).alias(v) for v in ("allow", "block")])
    limit = means.select(F.round((F.col("allow") + F.col("block")) / 2, 6)).scalar()
    s = s.select(F.col("host").alias("h"), F.col("path").alias("p"), F.round("score", 6).alias("score"),
                 limit.alias("threshold"))
    judged = u.join(s, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    free = F.when(F.col("threshold").isNull() | (F.col("score") >= F.col("threshold")), "allow").otherwise("block")
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce("verdict", free).alias("verdict"), "score", "threshold")
