"""Small tables with awkward rows, shared by the operator tests."""

import random

#: Names the operators use inside; extra input columns must not clash.
CLASHING = ("score", "h", "gid", "cid", "n", "pos", "z", "row_key", "head", "ctx", "found", "spots", "shard",
            "piece", "cluster", "bin_id", "held_out", "predicted", "rank", "_r", "v", "c", "a", "b", "one", "y")

WORDS = [a + b for a in "bcdfgklmnprst" for b in ("a", "en", "or", "ul", "ist", "oma")]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def documents(spark, rows, extra=False):
    """rows: (doc_id, text[, lang, source])."""
    full = [(i, t, *(r or ["en", "s0"]), None if t is None else len(t)) for i, t, *r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"x{k}").alias(k) for k in CLASHING])
    return df


def awkward(seed=1):
    """Null and empty texts, null ids, a very long text, repeats, near copies."""
    base = prose(seed, 120)
    words = base.split(" ")
    near = " ".join(words[:60] + ["other"] + words[61:])
    rows = [(1, base), (2, base), (3, near), (4, None), (5, ""), (6, "  \n\t"), (7, "one two"), (8, "One TWO"),
            (9, prose(seed + 1, 30_000)), (10, prose(seed + 2, 50)), (10, prose(seed + 2, 50)),
            (None, prose(seed + 3, 80)), (None, None), (11, "é" * 300 + " ü " + "Ω" * 50), (12, "a" * 900)]
    rows += [(20 + k, prose(seed + 10 + k, 70)) for k in range(6)]
    return rows
