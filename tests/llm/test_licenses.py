"""License scan against a scan of word lists in Python."""

import random
import re

import pytest

from affinity.llm import licenses

from .helpers import awkward, documents, prose


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def by_hand(text, slack=6):
    ws = words(text)
    places, labels, score = [], set(), 0.0
    for t in licenses.TEMPLATES:
        tw = words(t.text)
        if t.exact:
            at = [i for i in range(len(ws)) if ws[i:i + len(tw)] == tw]
            places += [(i, t.label) for i in at]
            score = max([score, *[1.0 for _ in at]])
            continue
        diagonals = {}
        for i in range(len(ws) - 2):
            for j in range(len(tw) - 2):
                if ws[i:i + 3] == tw[j:j + 3]:
                    diagonals.setdefault(i - j, set()).update((j, j + 1, j + 2))
        for d in diagonals:
            cover = len(set().union(*[s for e, s in diagonals.items() if abs(e - d) <= slack])) / len(tw)
            score = max(score, cover)
            if cover >= t.cover:
                labels.add(t.label)
    base = {x for _, x in places}
    starts = [i for i, _ in places]
    return (len(ws), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | labels)), score)


def edited(text, seed, share):
    r = random.Random(seed)
    out = []
    for w in text.split():
        x = r.random()
        if x > share:
            out.append(w)
        elif x < share / 3:
            out += [w, "extra"]
        elif x < 2 * share / 3:
            out.append("other")
    return " ".join(out)


def texts():
    out = [t for _, t, *_ in awkward()]
    for n, t in enumerate(licenses.TEMPLATES):
        out += [t.text, f"{prose(n, 40)} {t.text.upper()}. {prose(n + 1, 9)}", f"{t.text}, {t.text}; {prose(n, 3)} {t.text}"]
        out += [f"{prose(n, 5)} {edited(t.text, 10 * n + k, 0.03 * (k + 1))} {prose(n + 2, 5)}" for k in range(4)]
    out += ["Under the MIT-license under the mit\nLICENSE", "under the mit", "license under the mit", "cc by nc by nc",
            "cc_by_nc CC-BY-NC cc by nc", "ccé by nc", "licensed under the GNU General Public License, version 2.",
            "GNU General Public License (GPL), version 3", "cc by cc by nc sa", "booK the mit license",
            "the software " * 4000, " ".join(licenses.PASSAGES[0].text.split()[::-1])]
    return out


def test_equals_scan_by_hand(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(0, "under the MIT license"), (0, "under the MIT license"),
                                                      (None, "cc by nc"), (None, None)]
    got = licenses.scan(documents(spark, rows, extra=True)).collect()
    key = lambda r: tuple((x is None, x) for x in r)                                   # noqa: E731
    assert sorted((tuple(r) for r in got), key=key) == sorted(((i, *by_hand(t)) for i, t in rows), key=key)


def test_edited_passages_are_found_and_versions_told_apart(spark):
    mit = licenses.PASSAGES[0].text.split()
    cut = " ".join(mit[:40] + ["new", "words", "here"] + mit[44:])
    rows = [(1, prose(1, 30) + " " + cut), (2, "GNU General Public License, version 2"),
            (3, "GNU General Public License, version 3"), (4, " ".join(mit[:60])), (5, prose(2, 4000))]
    got = {r.doc_id: r for r in licenses.scan(documents(spark, rows)).collect()}
    assert [got[i].labels for i in range(1, 6)] == ["mit", "gpl-2", "gpl-3", "", ""]
    assert 0.75 <= got[1].score < 1 and 0.3 < got[4].score < 0.75 and got[5].score == 0


def test_spans_hold_the_place(spark):
    text = prose(3, 25) + " " + licenses.PASSAGES[1].text + " " + prose(4, 25)
    s = [r for r in licenses.spans(documents(spark, [(1, text)])).collect() if r.held]
    assert {r.label for r in s} == {"isc"}
    n = len(words(licenses.PASSAGES[1].text))
    assert (min(r["first"] for r in s), max(r.stop for r in s)) == (25, 25 + n)


def test_templates_are_checked(spark):
    with pytest.raises(ValueError, match="fewer than 3"):
        licenses.scan(documents(spark, []), (licenses.Template("x", "two words"),))
    with pytest.raises(ValueError, match="not broadcast"):
        licenses.scan(documents(spark, []), (licenses.Template("x", "a b c " * (1 << 20)),))


def test_empty_table_and_no_python_in_the_plan(spark):
    out = licenses.scan(documents(spark, []))
    assert out.collect() == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
