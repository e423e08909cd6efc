"""Filter interaction audit by decision diagrams.

Each document's failures of a few filters are a bit mask.  Masks are counted
per part in the cluster; a part's counts become one decision diagram: a node
of level k splits its documents into those that pass and those that fail the
k-th filter of the order, and holds how many they are (documents, good ones,
toxic ones).  Equal nodes of a level are one node.  Another order is reached by
swapping adjacent levels, which rebuilds two levels only; swaps in the order of
plain changes visit all orders.  Along the path on which every filter passes, an order's
steps can be read off: what passes is kept, what fails is removed there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

WORD = r"[^\x20\x09-\x0D]+"
LETTERS = "ABCDE"
#: Every filter but the last is a condition on the text; the last, E, on the table.
STEP = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
        "unique_fails long, good_lost long, toxic_lost long, shapley long")


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions on a text and the array of its words."""
    n = F.size(words)
    caps = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"A": n < 200,
            "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
            "C": 100 * caps > 2 * F.length(text),
            "D": text.rlike(r"[#$%&*|]")}


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per source and failure mask.

    Bit k of ``mask`` is the failure of the k-th filter.  Copies of a text agree in all of them
    but E, so they are counted together before anything depends on how many they
    are: first by id, then by (text, part, labels), which knows its smallest id
    and the rows that have it; only those rows, where no smaller id has the
    text, pass E.  Texts are told apart by their sha256.
    """
    d = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"),
                    F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    bits = [F.when(c, 1 << k).otherwise(0)
            for k, c in enumerate(text_failures(F.col("text"), F.col("words")).values())]
    d = d.select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("same"),
                 sum(bits[1:], bits[0]).alias("mask"))
    flags = (labels.where("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    no = F.lit(0)
    known = d.where("doc_id IS NOT NULL").join(flags, "doc_id", "left").withColumns(
        {c: F.coalesce(c, no) for c in ("good", "toxic")})
    text = ["same", "part", "mask", "good", "toxic"]
    by_id = known.groupBy("doc_id", *text).agg(F.count(F.lit(1)).alias("c"))
    nameless = (d.where("doc_id IS NULL").groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"))
                .select("part", "mask", no.alias("good"), no.alias("toxic"), "n"))
    texts = saved(by_id.groupBy(*text).agg(F.min(F.struct("doc_id", "c")).alias("least"), F.sum("c").alias("n")),
                  "audit_texts")
    ids = texts.groupBy("same").agg(F.min("least.doc_id").alias("first_id"))
    first = F.when(F.col("least.doc_id") == F.col("first_id"), F.col("least.c")).otherwise(0)
    e = 1 << LETTERS.index("E")
    split = F.array(F.struct(F.col("mask").alias("m"), first.alias("n")),
                    F.struct((F.col("mask") + e).alias("m"), (F.col("n") - first).alias("n")))
    parted = texts.join(ids, "same").select("part", "good", "toxic", F.explode(split).alias("s")).select(
        "part", F.col("s.m").alias("mask"), "good", "toxic", "s.n")
    n = F.col("n")
    return (parted.unionByName(nameless).where("n > 0").groupBy("part", "mask")
            .agg(F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic")))


class Diagram:
    """Counts of failure masks as a shared decision diagram.

    A node is (passing child, failing child, total); a node below the last level is its
    total alone.  ``levels[k]`` maps a node's content to itself, so equal
    parts of a level are stored once.
    """

    def __init__(self, counts: dict[int, tuple], letters: str):
        self.order = list(letters)
        zero = (0,) * len(next(iter(counts.values())))
        self.levels = [{} for _ in letters]
        nodes = [counts.get(m, zero) for m in range(1 << len(letters))]
        for k in reversed(range(len(letters))):        # mask bit k: the k-th letter fails
            half = len(nodes) // 2
            nodes = [self._node(k, nodes[m], nodes[m + half]) for m in range(half)]
        self.root = nodes[0]

    def _total(self, k: int, node):
        return node if k == len(self.order) else node[2]

    def _node(self, k: int, passing, failing):
        """The node of level ``k`` with these children, shared with an equal one."""
        total = tuple(a + b for a, b in zip(self._total(k + 1, passing), self._total(k + 1, failing), strict=True))
        mark = (passing, failing) if k + 1 == len(self.order) else (id(passing), id(failing))
        return self.levels[k].setdefault(mark, [passing, failing, total])

    def swap(self, k: int) -> None:
        """Exchange levels ``k`` and ``k + 1``; the levels above keep their nodes."""
        upper = list(self.levels[k].values())
        self.levels[k], self.levels[k + 1] = {}, {}
        for node in upper:
            (pp, pf, _), (fp, ff, _) = node[0], node[1]
            node[0], node[1] = self._node(k + 1, pp, fp), self._node(k + 1, pf, ff)
            self.levels[k][id(node[0]), id(node[1])] = node
        self.order[k], self.order[k + 1] = self.order[k + 1], self.order[k]

    def steps(self) -> Iterator[tuple[str, tuple, tuple]]:
        """(letter, kept, removed) along the path on which every filter passes."""
        node = self.root
        for k, letter in enumerate(self.order):
            yield letter, self._total(k + 1, node[0]), self._total(k + 1, node[1])
            node = node[0]


def plain_changes(n: int) -> Iterator[int]:
    """Adjacent swaps (the left place of each) that visit all orders of n things."""
    if n < 2:
        return
    down, inner = True, plain_changes(n - 1)
    while True:
        yield from reversed(range(n - 1)) if down else range(n - 1)
        nxt = next(inner, None)
        if nxt is None:
            return
        yield nxt + down
        down = not down


def orders(counts: dict[int, tuple], letters: str = LETTERS) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique, good lost, toxic lost, shapley)."""
    diagram, found = Diagram(counts, letters), []
    swaps = plain_changes(len(letters))
    while True:
        found.append(("".join(diagram.order), list(diagram.steps())))
        k = next(swaps, None)
        if k is None:
            break
        diagram.swap(k)
    # first in an order a filter removes all its failures, last only those no other has
    fails = {s[0][0]: s[0][2][0] for _, s in found}
    alone = {s[-1][0]: s[-1][2][0] for _, s in found}
    shapley = dict.fromkeys(letters, 0)
    for _, steps in found:
        for letter, _, removed in steps:
            shapley[letter] += removed[0]
    return [(order, k + 1, kept[0], removed[0], fails[x] - removed[0], alone[x], removed[1], removed[2], shapley[x])
            for order, steps in found for k, (x, kept, removed) in enumerate(steps)]


def _audit_part(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    counts = {int(m): (int(n), int(g), int(t))
              for m, n, g, t in zip(rows["mask"], rows["n"], rows["good"], rows["toxic"], strict=True)}
    names = [c.split()[0] for c in STEP.split(", ")]
    return pd.DataFrame([(key[0], *r) for r in orders(counts)], columns=names)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step (see ``STEP``).

    A part is a source, null counting as the empty string.  Null texts are empty: too short, not
    repetitive, without capitals or marks, and equal to each other.  A row without doc_id
    neither fails E nor makes another fail it, and has no label.  Rows that
    share an id are documents of their own; equal ones with the smallest id all
    pass E.  A document is good (toxic) if any label row of its id says 1.
    Tables may hold extra columns; an empty one has no parts.
    """
    # at most 2 ** 5 rows a part reach one call
    return mask_counts(docs, labels).groupBy("part").applyInPandas(_audit_part, STEP)
