"""Pair counts of two user x item matrices as a blocked sparse product.

A user with n primary and m partner items makes n * m pairs.  No pair is a row of
its own: users are dealt into blocks of about ``block_pairs`` pairs (a long
list is cut into a grid of cells first, see ``cooccurrence``), a task multiplies its block
in memory, where equal pairs of different users meet, and sends what is left as
arrays, one row per block and target bucket.  A second task per bucket adds the blocks'
counts and either returns them or scores them and keeps each item's k best.

``floor_of`` is the exact bound for skipping partners: the log-likelihood ratio
of a pair, given the users ``a`` and ``b`` of its items, is convex in the common
users k and zero at independence, so it is largest at an end of k's range,

    k = min(a, b)   growing in b up to b = a, falling beyond
    k = 1           growing in b once a * b > n, until a + b > n forces k up

and an item whose k-th best score is known needs no partner with fewer users than the
first b that reaches it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType

#: Pairs expanded at a time.
CHUNK = 1 << 20
#: Entries of one packed row.
PACKED = 1 << 16


def llr_values(k11, a, b, n) -> np.ndarray:
    """``functions.llr.llr`` on arrays."""
    k11, a, b = (np.asarray(v, np.float64) for v in (k11, a, b))
    n = float(n)

    def term(k, row, col):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(k > 0, k * np.log(k * n / (row * col)), 0.0)

    s = term(k11, a, b) + term(a - k11, a, n - b) + term(b - k11, n - a, b) + term(n - a - b + k11, n - a, n - b)
    return np.maximum(0.0, 2.0 * s)


def independent_values(k11, a, b, n: int) -> np.ndarray:
    """``functions.llr.independent`` on arrays: k11 * n = a * b, exactly."""
    if len(k11) and max(int(k11.max()) * n, int(a.max()) * int(b.max())) >= 1 << 63:
        near = np.isclose(k11.astype(np.float64) * n, a.astype(np.float64) * b, rtol=1e-9)
        near[near] = [int(k) * n == int(x) * int(y) for k, x, y in zip(k11[near], a[near], b[near], strict=True)]
        return near
    return k11 * n == a * b


def upper_bound(a, b, n) -> np.ndarray:
    """Largest log-likelihood ratio a pair with at least one common user can have."""
    a, b = np.broadcast_arrays(np.asarray(a, np.float64), np.asarray(b, np.float64))
    least = np.maximum(1.0, a + b - n)
    return np.maximum(llr_values(np.minimum(a, b), a, b, n), llr_values(least, a, b, n))


def floor_of(a: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Smallest b whose upper bound reaches ``score`` (n + 1 if none does; 1 for NaN).

    Scores are rounded to 5 places, hence the margin.
    """
    goal = np.where(np.isnan(score), -1.0, score - 1e-5 - 1e-9 * np.abs(score))

    def first(low, high, value):
        """By bisection on a growing function: the first b in [low, high] with value(b) >= goal."""
        low, high = low.astype(np.int64), high.astype(np.int64)
        end = high + 1
        high = end.copy()
        while np.any(low < high):
            mid = (low + high) // 2
            ok = (value(np.minimum(mid, end - 1)) >= goal) & (mid < end)
            high, low = np.where(ok & (low < high), mid, high), np.where(~ok & (low < high), mid + 1, low)
        return np.where(low < end, low, n + 1)

    one = np.ones_like(a)
    within = first(one, a, lambda b: llr_values(np.minimum(a, b), a, b, n))
    # k = 1, below independence: grows with b from b = n / a on, until k has to grow too
    peak = n - a + 1
    below = first(np.minimum(n // a + 1, peak), peak, lambda b: llr_values(np.maximum(1, a + b - n), a, b, n))
    return np.where(goal <= 0, 1, np.minimum(within, below))


def _column(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _codes(*columns: np.ndarray):
    """Distinct values in order, and each column's positions among them."""
    values, codes = np.unique(np.concatenate(columns), return_inverse=True)
    return values, np.split(codes, np.cumsum([len(c) for c in columns])[:-1])


def _summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """(code, count) of several sorted (codes, counts)."""
    codes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    if len(parts) == 1:
        return codes, counts
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[starts], np.add.reduceat(counts, starts)


def multiply(left: pa.Table, right: pa.Table, n: int, chunk: int = CHUNK):
    """Pair counts of one block: (items, hash parts, ev, x, y, a, b, count); x and y are places in items.

    left: user_id, ba, bb, x, a, parts, floor (scores per event, may be null);
    right: user_id, ba, bb, ev, y, b, own (partners of the primary event, never paired with themselves).
    """
    _, (lu, ru) = _codes(_column(left, "user_id"), _column(right, "user_id"))
    na = max(_column(left, "ba").max(), _column(right, "ba").max()) + 1
    nb = max(_column(left, "bb").max(), _column(right, "bb").max()) + 1
    lcell = (lu.astype(np.int64) * na + _column(left, "ba")) * nb + _column(left, "bb")
    rcell = (ru.astype(np.int64) * na + _column(right, "ba")) * nb + _column(right, "bb")
    items, (x, y) = _codes(_column(left, "x"), _column(right, "y"))
    a_of, parts_of = np.zeros(len(items), np.int64), np.ones(len(items), np.int64)
    a_of[x], parts_of[x] = _column(left, "a"), _column(left, "parts")
    events, b, own = _column(right, "ev"), _column(right, "b"), _column(right, "own")
    floors = left.column("floor").combine_chunks()
    out = []
    for ev in np.unique(events):
        here = events == ev
        yb, big = b[here], int(b[here].max()) + 2
        key = rcell[here] * big + (big - 1 - yb)           # a cell's partners, those with most users first
        order = np.argsort(key, kind="stable")
        key, ry = key[order], y[here][order]
        need = np.ones(len(items), np.int64)
        if floors.null_count < len(floors):
            score = np.full(len(items), np.nan)
            known = floors.is_valid().to_numpy(zero_copy_only=False)
            lists = floors.filter(pa.array(known))
            score[x[known]] = np.array([s[ev] for s in lists.to_pylist()], np.float64)
            used = np.unique(x)
            need[used] = floor_of(a_of[used], score[used], n)
        low = np.searchsorted(key, lcell * big, "left")
        high = np.searchsorted(key, lcell * big + (big - 1 - np.minimum(need[x], big - 1)), "right")
        count = np.maximum(high - low, 0)
        ends = np.cumsum(count)
        cuts = np.searchsorted(ends, np.arange(chunk, (ends[-1] if len(ends) else 0) + chunk, chunk), "left") + 1
        found, start = [], 0
        for stop in np.unique(np.minimum(cuts, len(count))):
            c = count[start:stop]
            total = int(c.sum())
            if total:
                row = np.repeat(np.arange(start, stop), c)
                at = np.arange(total) - np.repeat(np.cumsum(c) - c, c) + low[row]
                px, py = x[row].astype(np.int64), ry[at]
                if own[here][0]:
                    px, py = px[px != py], py[px != py]
                if len(px):                                # else items met only themselves
                    found.append(np.unique(px * len(items) + py, return_counts=True))
            start = stop
        if found:
            code, times = _summed(found)
            px, py = code // len(items), code % len(items)
            b_of = np.zeros(len(items), np.int64)
            b_of[y[here]] = yb
            out.append((np.full(len(code), ev, np.int8), px, py, a_of[px], b_of[py], times.astype(np.int64)))
    if not out:
        return None
    return items, parts_of, *[np.concatenate(c) for c in zip(*out, strict=True)]


def _lists(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))


def _narrow(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Integers as bytes, each row in the fewest bytes its range needs: the width, the smallest, the rest above it."""
    out = []
    for s, e in zip(cuts[:-1], cuts[1:], strict=True):
        v = values[s:e].astype(np.int64)
        low = v.min()
        v = v.view(np.uint64) - low.view(np.uint64)        # modulo 2**64, so any range will do
        kind = np.min_scalar_type(v.max())
        out.append(bytes([kind.itemsize]) + low.tobytes() + v.astype(kind).tobytes())
    return pa.array(out, pa.binary())


def _widened(column: pa.ChunkedArray) -> np.ndarray:
    """The integers of all rows of a column ``_narrow`` made."""
    parts = [np.frombuffer(v, f"u{v[0]}", offset=9).astype(np.uint64) + np.frombuffer(v, np.uint64, 1, 1)
             for v in column.to_pylist()]
    return np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)


def _runs(bucket: np.ndarray, ev: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Starts of the runs of one bucket, event and item, and of the packed rows."""
    new = (bucket[1:] != bucket[:-1]) | (ev[1:] != ev[:-1]) | (x[1:] != x[:-1])
    return np.flatnonzero(np.r_[True, new])


def _packer(n: int, buckets: int, item: pa.DataType):
    """Cogroup kernel: a block's product, packed per bucket.

    Pairs come in runs of one event and item, so event, item and the item's users are
    sent once a run with its length, and per pair the partner, its users and the count.
    """
    whole = pa.types.is_integer(item)                      # else partners travel as they are
    schema = pa.schema([("bucket", pa.int32()), ("ev", pa.list_(pa.int8())), ("x", pa.list_(item)), ("a", pa.binary()),
                        ("m", pa.binary()), ("y", pa.binary() if whole else pa.list_(item)), ("b", pa.binary()),
                        ("c", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = multiply(left, right, n) if len(left) and len(right) else None
        if got is None:
            return schema.empty_table()
        items, parts, ev, x, y, a, b, c = got
        # an item's partners share a bucket; those of an item with very many pairs are
        # spread, over buckets of their own
        h, n_buckets, p = pd.util.hash_array(items), np.uint64(buckets), parts[x].astype(np.uint64)
        bucket = ((h[x] % n_buckets + h[y] % p) % n_buckets).astype(np.int32) + np.where(p > 1, buckets, 0).astype(np.int32)
        order = np.argsort(bucket, kind="stable")          # pairs come sorted by event, x and y
        bucket, ev, x, y, a, b, c = (v[order] for v in (bucket, ev, x, y, a, b, c))
        edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        cuts = np.unique(np.r_[edge, np.arange(0, len(bucket), PACKED), len(bucket)])
        runs = np.unique(np.r_[_runs(bucket, ev, x), cuts[:-1]])
        at = np.searchsorted(runs, cuts)                   # the packed rows' first runs
        return pa.Table.from_arrays(
            [pa.array(bucket[cuts[:-1]], pa.int32()), _lists(ev[runs], at, pa.int8()), _lists(items[x[runs]], at, item),
             _narrow(a[runs], at), _narrow(np.diff(np.r_[runs, len(bucket)]), at),
             _narrow(items[y], cuts) if whole else _lists(items[y], cuts, item), _narrow(b, cuts), _narrow(c, cuts)], schema=schema)
    return run


def _unpacked(t: pa.Table):
    """(ev, x, y, a, b, count) of a bucket, the blocks' counts added up; sorted by ev, x, y."""
    whole = pa.types.is_binary(t.schema.field("y").type)
    ev, x, *rest = (t.column(k).combine_chunks().flatten().to_numpy(zero_copy_only=False)
                    for k in ("ev", "x", *([] if whole else ["y"])))
    y = _widened(t.column("y")).astype(x.dtype) if whole else rest[0]
    a, m, b, c = (_widened(t.column(k)) for k in ("a", "m", "b", "c"))
    xs, (xc,) = _codes(x)
    ys, (yc,) = _codes(y)
    ev, x, a, xc = (np.repeat(v, m) for v in (ev, x, a, xc))
    code = (ev.astype(np.int64) * len(xs) + xc) * len(ys) + yc
    order = np.argsort(code, kind="stable")
    code = code[order]
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    first = order[starts]
    return ev[first], x[first], y[first], a[first], b[first], np.add.reduceat(c[order], starts), xc[first]


def _adder(item: pa.DataType):
    schema = pa.schema([("ev", pa.int8()), ("x", item), ("y", item), ("a", pa.int64()), ("b", pa.int64()),
                        ("k11", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        ev, x, y, a, b, k, _ = _unpacked(t)
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip((ev, x, y, a, b, k), schema, strict=True)],
                                    schema=schema)
    return run


def _ranker(n: int, buckets: int, caps: dict[int, int], item: pa.DataType):
    """Adds a bucket up, scores it and ranks the best of each event and item."""
    schema = pa.schema([("ev", pa.int8()), ("x", item), ("y", item), ("llr", pa.float64()), ("rank", pa.int32()),
                        ("whole", pa.bool_())])
    cap = np.array([caps[e] for e in range(len(caps))])

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        whole = key[0].as_py() < buckets
        ev, x, y, a, b, k, xc = _unpacked(t)
        keep = ~independent_values(k, a, b, n)
        ev, x, y, xc = ev[keep], x[keep], y[keep], xc[keep]
        s = llr_values(k[keep], a[keep], b[keep], n)
        s = np.floor(s * 1e5 + 0.5) / 1e5
        # rows come sorted by (ev, x, y): a stable sort breaks ties by y and keeps the groups
        group = ev.astype(np.int64) * (int(xc.max(initial=0)) + 1) + xc
        order = np.lexsort((-s, group))
        new = np.r_[True, group[1:] != group[:-1]][:len(group)]
        at = np.arange(len(group))
        place = at - np.maximum.accumulate(np.where(new, at, 0))
        best = place < cap[ev]
        order, place = order[best], place[best]
        columns = (ev[order], x[order], y[order], s[order], place + 1, np.full(len(order), whole))
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema, strict=True)], schema=schema)
    return run


def blocks_of(left: DataFrame, right: DataFrame, n: int, buckets: int, item: DataType) -> DataFrame:
    """Packed pair counts of every block; both sides have a column ``block``."""
    from pyspark.sql.pandas.types import to_arrow_type
    t = item.simpleString()
    partners = "binary" if pa.types.is_integer(to_arrow_type(item)) else f"array<{t}>"
    schema = f"bucket int, ev array<tinyint>, x array<{t}>, a binary, m binary, y {partners}, b binary, c binary"
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(
        _packer(n, buckets, to_arrow_type(item)), schema)


def counts(blocks: DataFrame, item: DataType) -> DataFrame:
    """(ev, x, y, a, b, k11) of packed blocks."""
    from pyspark.sql.pandas.types import to_arrow_type
    t = item.simpleString()
    return blocks.groupBy("bucket").applyInArrow(
        _adder(to_arrow_type(item)), f"ev tinyint, x {t}, y {t}, a bigint, b bigint, k11 bigint")


def best(blocks: DataFrame, n: int, buckets: int, caps: dict[int, int], item: DataType) -> DataFrame:
    """(ev, x, y, llr, rank, whole): each item's best partners in their bucket.

    ``whole``: the bucket holds all of the item's pairs, so the ranks are final.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    t = item.simpleString()
    return blocks.groupBy("bucket").applyInArrow(
        _ranker(n, buckets, caps, to_arrow_type(item)),
        f"ev tinyint, x {t}, y {t}, llr double, rank int, whole boolean")
