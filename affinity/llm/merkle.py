"""Merkle dataset manifest with proofs by pointer jumping.

Every row is a leaf.  The leaves of a source, in order of doc_id, are hashed
together in runs of ``fanout`` until one node, the subroot, is left; the
subroots, in order of source, give the root the same way.

1. A leaf's place in its source is a range shuffle plus prefix sums over the
   partitions' counts, so no source is ever sorted in one task.
2. Each run of leaves is one row holding its leaves; the levels above shrink
   by the fanout.
3. Every node above the leaves holds a pointer to an ancestor (its parent at
   first) and the segment of siblings on the way there, as (left, right)
   texts around the node.  One self-join on pointer = node doubles the
   distance of all pointers and concatenates the segments; after
   ceil(log2(height)) joins all reach the root.  The leaves of one run share
   everything above it, so they make their own step at the end, by the join
   with their run's finished pointer.

An ancestor near the root is the target of very many pointers.  It is copied
``ceil(leaves below / spread)`` times and the pointers are dealt over the copies,
so a join key has a bounded number of rows however large a source is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

FANOUT = 16
#: Leaves below one copy of a pointer's target.
SPREAD = 1 << 16
#: Group of the tree over the subroots; groups of sources are "" or begin with "s".
TOP = "t"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts' UTF-8 bytes, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_of(*values: Column) -> Column:
    """Digest of the values, each ``-`` if null, else byte count, ``:``, value."""
    texts = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                    for t in texts])


def lowered(text: Column) -> Column:
    """The text with A-Z lower-cased."""
    return F.translate(text, UPPER, LOWER)


def positions(df: DataFrame, group: str, order: tuple[str, ...], name: str) -> DataFrame:
    """``df`` with ``idx`` (place within the group, from 0) and ``n`` (the group's rows).

    Rows are shuffled by range; a row's place is its place in its partition plus
    the rows of its group in earlier partitions.  The window sees one row per
    partition and group.
    """
    s = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    s = saved(s.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), name)
    runs = s.groupBy("part", group).agg(F.min("at").alias("lo"), F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("lo")
    runs = runs.select("part", group, shift.alias("shift"), F.sum("c").over(whole).alias("n"))
    return (s.join(runs, ["part", group]).withColumn("idx", F.col("at") + F.col("shift"))
            .drop("at", "part", "shift"))


def _text(kids: Column, field: str) -> Column:
    return F.array_join(F.transform(kids, lambda k: k[field]), "")


def _around(kids: Column, j: Column, field: str) -> Column:
    """The digests before and after place ``j`` (from 0) of a run."""
    return F.struct(_text(F.slice(kids, F.lit(1), j), field).alias("l"),
                    _text(F.slice(kids, j + 2, F.size(kids)), field).alias("r"))


def _climb(nodes: DataFrame, rows: int, level: int, fanout: int, name: str) -> tuple[list[DataFrame], DataFrame, int]:
    """Hash nodes (g, i, key, digest, n, w) level by level until each group has one.

    ``rows`` is the largest group, ``level`` the nodes' own.  Returns the links (node
    to parent, with the step between them), the last node of each group, and
    the number of levels above ``nodes``.
    """
    links, tops, height = [], nodes.where("n = 1"), 0
    while rows > 1:
        rows, level, height = -(-rows // fanout), level + 1, height + 1
        packs = saved(nodes.where("n > 1").groupBy("g", F.floor(F.col("i") / fanout).alias("i")).agg(
            F.sort_array(F.collect_list(F.struct("i", "key", "digest", "w"))).alias("kids"),
            F.sum("w").alias("w"), F.ceil(F.first("n") / fanout).alias("n")), f"{name}_{level}")
        key = F.concat(F.lit(f"{level}/"), F.col("i").cast("string"), F.lit("/"), F.col("g"))
        packs = packs.withColumn("key", key)
        links.append(packs.select(F.posexplode("kids").alias("j", "kid"), "kids", F.col("key").alias("anc"),
                                  F.col("w").alias("aw")).select(
            "kid.key", "kid.digest", "kid.w", "anc", "aw",
            F.array(_around(F.col("kids"), F.col("j"), "digest")).alias("seg")))
        nodes = packs.select("g", "i", "key", digest(_text(F.col("kids"), "digest")).alias("digest"), "n", "w")
        tops = tops.unionByName(nodes.where("n = 1"))
    return links, tops, height


def _largest(df: DataFrame, column: str) -> int:
    return df.agg(F.max(column)).first()[0] or 0


def jump(pointers: DataFrame, spread: int = SPREAD) -> DataFrame:
    """Double the distance of every pointer that has not reached the root.

    pointers: key, w (leaves below), run (a run of leaves), anc (pointed-to
    key, null at the root), aw (leaves below it), seg, sub (digest of the subroot, once on
    the way).
    """
    copies = lambda w: F.ceil(F.col(w) / spread)                                       # noqa: E731
    far = pointers.where(~F.col("run")).select(
        F.col("key").alias("k"), F.col("anc").alias("anc2"), F.col("aw").alias("aw2"), F.col("seg").alias("seg2"),
        F.col("sub").alias("sub2"), F.explode(F.sequence(F.lit(0), copies("w") - 1)).alias("copy"))
    near = pointers.where("anc IS NOT NULL").withColumn("copy", F.pmod(F.xxhash64("key"), copies("aw")))
    met = near.alias("a").join(far.alias("b"), (F.col("anc") == F.col("k")) & (F.col("a.copy") == F.col("b.copy")))
    return pointers.where("anc IS NULL").unionByName(met.select(
        "key", "w", "run", F.col("anc2").alias("anc"), F.col("aw2").alias("aw"),
        F.concat("seg", "seg2").alias("seg"), F.coalesce("sub", "sub2").alias("sub")))


def manifest(docs: DataFrame, tampered: Column | None = None, fanout: int = FANOUT,
             spread: int = SPREAD) -> DataFrame:
    """(doc_id, source, leaf, other, subroot, root, path) per row of ``docs``.

    ``path`` lists a leaf's steps to the root: the digests left and right of it in
    its run, then of its ancestors in theirs.  ``other`` is the leaf of the row
    with ``tampered`` in place of its text (null where that is null).

    Null sources are one source, the first; null fields are leaves' ``-``; null doc_ids come first
    in their source, and rows that agree in doc_id are ordered by leaf, so
    repeated rows are leaves of their own.  A source of one row has the leaf as its subroot,
    a table of one source its subroot as the root.  An empty table has no
    rows; extra columns are ignored.
    """
    fields = [F.col(c) for c in FIELDS]
    other = F.lit(None).cast("string") if tampered is None else F.when(
        tampered.isNotNull(), leaf_of(*fields[:-1], tampered))
    group = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    leaves = docs.select("doc_id", "source", group.alias("g"), leaf_of(*fields).alias("leaf"), other.alias("other"))
    # written before the range shuffle, which reads its input twice: the texts are read once
    placed = positions(saved(leaves, "merkle_digests"), "g", ("doc_id", "leaf"), "merkle_leaves")
    kids = F.sort_array(F.collect_list(F.struct("idx", "doc_id", "source", "leaf", "other")))
    runs = placed.groupBy("g", F.floor(F.col("idx") / fanout).alias("i")).agg(
        kids.alias("kids"), F.first("n").alias("leaves"))
    key = F.concat(F.lit("1/"), F.col("i").cast("string"), F.lit("/"), F.col("g"))
    lone = F.col("leaves") == 1
    runs = saved(runs.withColumn("key", key).withColumn(
        "digest", F.when(lone, F.col("kids")[0]["leaf"]).otherwise(digest(_text(F.col("kids"), "leaf")))),
        "merkle_runs")
    first = runs.select("g", "i", "key", "digest", F.ceil(F.col("leaves") / fanout).alias("n"),
                        F.size("kids").cast("long").alias("w"))
    links, tops, h = _climb(first, _largest(first, "n"), 1, fanout, "merkle_nodes")
    tops = saved(tops.select("g", "key", "digest", "w"), "merkle_subroots")
    ranked = positions(tops.withColumn("all", F.lit(TOP)), "all", ("g",), "merkle_sources")
    over = ranked.select(F.col("all").alias("g"), F.col("idx").alias("i"), "key", "digest", "n", "w")
    above, root, h2 = _climb(over, _largest(over, "n"), 0, fanout, "merkle_tops")
    root = saved(root.select("key", "digest", "w"), "merkle_root")

    # pointers of every node above the leaves
    nothing = F.lit(None).cast("string")
    one = F.array().cast("array<struct<l:string,r:string>>")
    end = root.select("*", nothing.alias("anc"), F.lit(None).cast("long").alias("aw"), one.alias("seg"))
    pointers = None
    for x, sub in [(x, nothing) for x in [*links, *above[1:], end]] + [(x, F.col("digest")) for x in above[:1]]:
        run = F.col("key").rlike(r"^1/[0-9]+/(s|\z)")           # level 1 of a source
        x = x.select("key", "w", run.alias("run"), "anc", "aw", "seg", sub.alias("sub"))
        pointers = x if pointers is None else pointers.unionByName(x)
    pointers = saved(pointers, "merkle_pointers0")
    for r in range((h + h2 - 1).bit_length() if h + h2 else 0):
        pointers = saved(jump(pointers, spread), f"merkle_pointers{r + 1}")

    met = runs.select("key", "kids", "leaves").join(pointers.where("run").select("key", "seg", "sub"), "key")
    rows = met.select("seg", "sub", "leaves", "kids", F.posexplode("kids").alias("j", "kid"))
    step = F.array(_around(F.col("kids"), F.col("j"), "leaf"))
    top = root.select("digest").scalar()       # also the subroot where there is one source
    return rows.select("kid.doc_id", "kid.source", "kid.leaf", "kid.other", F.coalesce("sub", top).alias("subroot"),
                       top.alias("root"), F.when(lone, F.col("seg")).otherwise(F.concat(step, "seg")).alias("path"))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda d, s: digest(s["l"], d, s["r"]))


def verify(docs: DataFrame, spread: int = SPREAD) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row.

    Where 5 divides crc32 of the decimal doc_id the row is folded with its text
    lower-cased (A-Z); a text without A-Z, or null, still verifies, and so
    does a row without doc_id, which is not tampered with.
    """
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    m = manifest(docs, F.when(hit, lowered(F.col("text"))), spread=spread)
    m = m.withColumn("folded_root", fold(F.coalesce("other", "leaf"), F.col("path")))
    return m.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
