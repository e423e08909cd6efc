"""Filter audit against filters applied one by one."""

import itertools
import random
import re

from affinity.llm import audit

from .helpers import CLASHING, awkward, documents, prose


def fails(text, i, rows):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = {x for x, bad in {
        "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
        "D": any(c in "#$%&*|" for c in text)}.items() if bad}
    ids = [j for j, t, *_ in rows if j is not None and (t or "") == text]
    return out | ({"E"} if i is not None and ids and min(ids) < i else set())


def by_hand(rows, labels):
    labels = [x for x in labels if x[0] is not None]
    docs = [(r[3] if len(r) > 3 and r[3] is not None else "", fails(r[1], r[0], rows),
             any(j == r[0] and q == 1 for j, q, _ in labels), any(j == r[0] and t == 1 for j, _, t in labels))
            for r in rows]
    out = set()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        table, total = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for k, x in enumerate(order):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                all_fail = sum(x in d[1] for d in own)
                total[x] += len(gone)
                table.append((x, part, "".join(order), k + 1, len(left), len(gone), all_fail - len(gone),
                              sum(d[1] == {x} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out |= {(*t[1:], total[t[0]]) for t in table}
    return out


def label_table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_equals_filters_applied_one_by_one(spark):
    r = random.Random(4)
    texts = [prose(1, 250), prose(2, 30) + " #", "THE END " * 150, prose(3, 300) + " $", "a " * 300, prose(5, 220).upper()]
    rows = [(i, r.choice(texts) if i % 3 else prose(100 + i, 260), "en", r.choice(["x", "y", None, ""]))
            for i in range(120)]
    rows += [(i, t, "en", "awk") for i, t, *_ in awkward()]
    rows += [(7, texts[0], "en", "x"), (7, texts[0], "en", "x"), (None, texts[0], "en", "x"), (-5, "  ", "en", "y")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(100)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    docs = documents(spark, rows, extra=True)
    lab = label_table(spark, labels).selectExpr("*", *[f"1 AS {c}" for c in CLASHING])
    got = [tuple(x) for x in audit.audit(docs, lab).collect()]
    want = by_hand(rows, labels)
    assert len(got) == len(set(got)) == 600 * 4 and set(got) == want     # x, y, "", awk


def test_copies_of_one_text_in_many_parts(spark):
    rows = [(i, "same text", "en", f"p{i % 7}") for i in range(2000)]
    got = audit.mask_counts(documents(spark, rows), label_table(spark, [(0, 1, 1), (1, 1, 0)]))
    counts = {(r.part, r["mask"]): (r.n, r.good, r.toxic) for r in got.collect()}
    assert counts["p0", 0b00001] == (1, 1, 1)            # id 0 alone is the first copy
    assert sum(n for (_, m), (n, *_) in counts.items() if m == 0b10001) == 1999


def test_swaps_visit_every_order_once():
    seen, order = set(), list("ABCDE")
    seen.add("".join(order))
    for k in audit.plain_changes(5):
        order[k], order[k + 1] = order[k + 1], order[k]
        seen.add("".join(order))
    assert len(list(audit.plain_changes(5))) == 119 and len(seen) == 120


def test_swap_keeps_counts_and_shares_nodes():
    r = random.Random(1)
    counts = {m: (r.randrange(4), 0, 0) for m in range(32)}
    d = audit.Diagram(counts, "ABCDE")
    for k in audit.plain_changes(5):
        d.swap(k)
        assert d.root[2][0] == sum(c[0] for c in counts.values())
        fresh = audit.Diagram({sum(((m >> "ABCDE".index(x)) & 1) << j for j, x in enumerate(d.order)): c
                               for m, c in counts.items()}, "".join(d.order))
        assert list(d.steps()) == list(fresh.steps())
        # a level never holds more nodes than distinct sub-tables of counts
        assert [len(x) for x in d.levels] == [len(x) for x in fresh.levels]


def test_empty_table(spark):
    assert audit.audit(documents(spark, []), label_table(spark, [])).collect() == []
