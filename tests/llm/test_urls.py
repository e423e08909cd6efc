"""URL filter: host, path and rules against urllib-free brute force; the model against Python."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from affinity.llm import urls

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    tail = rest[len(host):]
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return low, re.split(r"[?#]", tail, maxsplit=1)[0]


def rule(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def fold(s):
    return re.sub("[^a-z0./]", "-", re.sub("[0-9]+", "0", s.lower()))


def model(labelled, order=3, mass=2.0):
    """P(last | context) per class by the recursion, from plain counters."""
    cnt = {v: [Counter() for _ in range(order + 1)] for v in ("allow", "block")}
    ctx = {v: [Counter() for _ in range(order + 1)] for v in ("allow", "block")}
    for v, h, p in labelled:
        s = "/" * order + fold(h + p) + "/"
        for i in range(order, len(s)):
            for k in range(order + 1):
                cnt[v][k][s[i - k:i + 1]] += 1
                ctx[v][k][s[i - k:i]] += 1

    def prob(v, gram, k):
        low = prob(v, gram, k - 1) if k else 1 / 30
        g = gram[order - k:]
        return (cnt[v][k][g] + mass * low) / (ctx[v][k][g[:-1]] + mass)

    def llr(gram):
        for k in range(order, -1, -1):
            g = gram[order - k:]
            if cnt["allow"][k][g] + cnt["block"][k][g]:
                return math.log(prob("allow", gram, k) / prob("block", gram, k))
        return 0.0

    def score(h, p):
        s = "/" * order + fold(h + p) + "/"
        return sum(round(llr(s[i:i + order + 1]), 9) for i in range(len(s) - order)) / (len(s) - order)
    return score


def _pages(seed=2, n=300):
    r = random.Random(seed)
    out = []
    for k in range(n):
        lang = r.choice(["en", "fr", "de", "es"])
        host = r.choice(["", "www.", "m."]) + r.choice(["shop", "spam", "news"]) + r.choice([".example.org", ".example.com", ".net"])
        out.append((k, f"https://{host}/{lang}/{r.randrange(300)}{r.choice(['', '/', '?a=1', '#t', '.html'])}"))
    out += [(1000, None), (1001, ""), (1002, "no scheme/org/"), (1003, "http://EXAMPLE.ORG/ES/x"),
            (1004, "http://example.org/es/x?y=/a"), (1005, "ftp://a.b://c.com/fr/"), (1006, "://org"), (1007, "x://org/"),
            (1008, "http://notexample.org/en/17"), (1009, "http://x.example.org/en/17#z"), (1010, "http://com/fr/é?"),
            (1011, "http://a.net/" + "long/" * 3000), (0, "https://dup.net/")]
    return out


def test_columns_scores_and_verdicts_equal_brute_force(spark):
    rows = _pages()
    df = (spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
          .withColumn("score", F.lit(1)).withColumn("rule", F.lit("r")))
    got = {(r.page_id, r.host, r.path): r for r in urls.filter_urls(df).collect()}
    want = [(i, *parts(u)) for i, u in rows]
    assert sorted(got) == sorted(set(want)) and len(want) == len(got)
    labelled = [(rule(h, p)[1], h, p) for _, h, p in want if rule(h, p)[1]]
    score = model(labelled)
    mean = {v: sum(score(h, p) for x, h, p in labelled if x == v) / sum(x == v for x, *_ in labelled)
            for v in ("allow", "block")}
    limit = (mean["allow"] + mean["block"]) / 2
    for key in want:
        r = got[key]
        s = score(*key[1:])
        assert r.rule == rule(*key[1:])[0] and abs(r.score - s) < 2e-6 and abs(r.threshold - limit) < 2e-6
        free = "allow" if s >= limit else "block"
        if abs(s - limit) > 1e-5:
            assert r.verdict == (rule(*key[1:])[1] or free)


def test_longest_rule_wins_and_hosts_match_at_dots():
    assert rule("example.org", "/es/x") == ("example.org/es/", "block")
    assert rule("notexample.org", "/es/x") == ("org/", "allow")


def test_model_separates_the_classes(spark):
    rows = [(k, f"http://h.com/fr/news-{k}") for k in range(60)] + [(100 + k, f"http://h.com/de/casino-{k}") for k in range(60)]
    rows += [(300, "http://h.net/fr/news-7"), (301, "http://h.net/de/casino-7")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    v = {r.page_id: r.verdict for r in urls.filter_urls(df).collect()}
    assert v[300] == "allow" and v[301] == "block"


def test_empty_table_and_one_sided_evidence(spark):
    df = spark.createDataFrame([(1, "http://x.org/"), (2, "http://y.net/a")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.filter_urls(df).collect()} == {1: "allow", 2: "allow"}
    assert urls.filter_urls(df.where("false")).count() == 0
