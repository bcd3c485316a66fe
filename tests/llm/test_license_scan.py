"""License scan against brute force, with planted notices, odd rows and repeated rows."""

import re
from collections import defaultdict

import pytest

from barline.llm import license_scan as ls

CUT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, tie string, words string, n_words string, at string, key string"


def cut(text):
    return CUT.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x") for i, t in rows], DOCS)


def brute(text, templates, gram=ls.GRAM):
    """The result row of one text, from the definition alone."""
    w = cut(text)
    places, base, labels, score = [], set(), set(), 0.0
    for t in templates:
        v = cut(t.text)
        if not v:
            continue
        if t.exact:
            found = [i for i in range(len(w) - len(v) + 1) if w[i:i + len(v)] == v]
            places += found
            if found:
                base.add(t.label)
                score = 1.0
            continue
        k = min(gram, len(v))
        hits = sorted((i - j, i, j) for j in range(len(v) - k + 1) for i in range(len(w) - k + 1) if w[i:i + k] == v[j:j + k])
        bands = []
        for d, i, j in hits:
            if not bands or d - bands[-1][-1][0] > ls.DRIFT:
                bands.append([])
            bands[-1].append((d, i, j))
        for band in bands:
            covered = {j + x for _, _, j in band for x in range(k)}
            span = max(i + k for _, i, _ in band) - min(i for _, i, _ in band)
            score = max(score, len(covered) / len(v))
            if 10 * len(covered) >= 7 * len(v) and span <= ls.SPREAD * len(v):
                labels.add(t.label)
    names = lambda x: ",".join(sorted(x))
    return (len(w), len(places), min(places, default=None), max(places, default=None), names(base), names(base | labels), round(score, 9))


def compared(spark, rows, templates=ls.TEMPLATES, gram=ls.GRAM):
    got, want = defaultdict(list), defaultdict(list)
    for r in ls.scan(frame(spark, rows), templates, gram=gram).collect():
        got[r["doc_id"]].append((r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], round(r["score"], 9)))
    for i, t in rows:
        want[i].append(brute(t, templates, gram))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items()}
    return got


MIT = next(t.text for t in ls.NOTICES if t.text.startswith("Permission is hereby granted, free"))


def test_scan_matches_brute_force(spark):
    bsd = next(t.text for t in ls.NOTICES if t.label == "bsd")
    filler = " ".join(f"w{k}" for k in range(300))
    rows = [
        (1, "Released under the MIT License."), (2, "the mit-LICENSE and MIT license, mit  license"), (3, filler), (4, ""), (5, None),
        (6, f"{filler}\n{MIT}\n{filler}"), (7, f"{filler} {MIT.replace('charge', 'any charge at all')} {filler}"),  # words put in
        (8, MIT[:len(MIT) // 3]), (9, f"{bsd[:60]} {filler} {bsd[60:]}"),  # a part; two halves far apart
        (10, "GNU General Public License GNU General Public License"), (11, "apache License apache"), (12, "CC BY CC BY-NC 4.0"),
        (13, "Lïcensed apache, license"), (6, f"{filler}\n{MIT}\n{filler}"), (6, "other text under one id: apache license"),
        (None, "mit license"), (None, "mit license"), (None, None), (14, f"{bsd} {bsd} {MIT} {MIT}"),
        (15, "mit license " * 3000), (16, "is hereby granted free " * 2000), (17, "ccby mitlicense"), (18, "\x00\t\n -- !")]
    got = compared(spark, rows)
    assert got[6].count(next(x for x in got[6] if "mit" in x[5])) == 2
    assert "mit" in got[7][0][5] and got[8][0][5] == "" and got[8][0][6] > 0 and "bsd" not in got[9][0][5]
    assert got[15][0][1] == 3000 and got[10][0][1] == 2


def test_other_templates_and_run_sizes(spark):
    own = (ls.Template("a", "one two three four five six seven", True), ls.Template("b", "x"), ls.Template("c", "---"),
           ls.Template("d", "one two nine four five six seven eight nine ten"))
    rows = [(1, "one two three four five six seven"), (2, "one two three four five six"), (3, "x y x"), (4, None),
            (5, "one two three four five six seven eight nine ten"), (6, "z one two three four five six seven one two three four five six seven")]
    for gram in (1, 3, 6):
        compared(spark, rows, own, gram)


def test_empty_table_and_bounded_templates(spark):
    assert ls.scan(frame(spark, [])).count() == 0
    assert [r["n_base"] for r in ls.scan(frame(spark, [(1, "mit license")]), ()).collect()] == [0]
    with pytest.raises(ValueError):
        ls.template_grams(spark, (ls.Template("x", "w " * (ls.MAX_WORDS + 1)),))


def test_plan_has_no_python(spark):
    plan = ls.scan(frame(spark, [(1, "mit license")]))._jdf.queryExecution().toString()
    seeds = ls.seeds(frame(spark, [(1, "mit license")]), ls.TEMPLATES, "doc_id", "text", 4)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan + seeds) and "BroadcastHashJoin" in seeds
