"""Periodic runs against the definition, on random and built words, and the query's digests."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from fractions import Fraction

from barline.llm import periodic_runs as pr
from barline.llm import queries
from barline.llm.text import split_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, min_length=24, exponent=3):
    """(start, length, period) of every run, from the definition."""
    found, n = {}, len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(min_length, exponent * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def built(rng):
    """Words with planted repeats of several periods, some nested, some cut off or touching."""
    w = []
    for _ in range(int(rng.integers(1, 6))):
        unit = [f"u{k}" for k in rng.integers(0, 3 + rng.integers(0, 40), int(rng.integers(1, 30)))]
        if rng.random() < 0.3:
            unit = unit * int(rng.integers(2, 5)) + [f"x{rng.integers(0, 3)}"]
        w += [f"f{k}" for k in rng.integers(0, 50, int(rng.integers(0, 20)))]
        w += (unit * 40)[:int(len(unit) * rng.uniform(1, 6))]
    return w


@pytest.mark.parametrize("min_length,exponent", [(24, 3), (1, 2), (6, 2), (10, 4), (60, 3)])
def test_runs_match_the_definition(min_length, exponent):
    rng = np.random.default_rng(min_length * 10 + exponent)
    texts = [" ".join(built(rng)) for _ in range(120)]
    texts += [" ".join(f"a{k}" for k in rng.integers(0, 2, int(rng.integers(0, 200)))) for _ in range(60)]  # two words only
    fib = ["a", "b"]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    texts += ["", None, "a", "a " * 23, "a " * 24, "a " * 777, " ".join(fib[-1]), "a b " * 300 + "a a b", None, "x"]
    words = split_words(pa.array(texts, pa.string()))
    got = defaultdict(list)
    for s, e, q in pr.batch_runs(words, min_length, exponent):
        owner = int(np.searchsorted(words.starts, s, side="right")) - 1
        got[owner].append((s - words.starts[owner], e - s, q))
    for i, t in enumerate(texts):
        assert got[i] == brute(WORD.findall(t or ""), min_length, exponent), t


def test_a_long_text_of_one_word_and_of_long_periods():
    rng = np.random.default_rng(5)
    unit = rng.integers(0, 10 ** 6, 30_000)
    codes = np.concatenate([np.zeros(100_000, np.int64), unit + 1, unit + 1, unit + 1, unit[:99] + 1])
    assert pr.find_runs(codes, np.array([len(codes)])) == [(0, 100_000, 1), (100_000, 100_000 + 90_099, 30_000)]


def test_collapsed_text_and_rows(spark):
    rows = [(1, "a b c " * 20 + "end"), (1, "a b c " * 20 + "end"), (2, None), (3, ""), (None, "z " * 30), (4, "é ü " * 15 + "\x0b\n last")]
    docs = spark.createDataFrame([(i, t, "x", 3, "y") for i, t in rows], "doc_id long, text string, runs string, n_words long, collapsed string")
    got = sorted(((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in pr.periodic_runs(docs).collect()), key=str)
    want = [(0, 30, [(0, 30, 1)], "z"), (1, 61, [(0, 60, 3)], "a b c end"), (1, 61, [(0, 60, 3)], "a b c end"), (2, 0, [], ""), (3, 0, [], ""),
            (4, 31, [(0, 30, 2)], "é ü last")]
    assert got == sorted(want, key=str)
    assert pr.periodic_runs(docs.limit(0)).count() == 0


def expected(doc_id, text):
    w = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = brute(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n_},{q}\n" for s, n_, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_the_query_matches_the_definition(spark, tmp_path):
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 30, int(rng.integers(0, 400)))), "en", "s", 1) for i in range(150)]
    rows += [(200 + i, " ".join(built(rng)), None, None, 1) for i in range(60)]
    rows += [(300, None, None, None, None), (301, "", "fr", "s", 0), (302, "rep " * 500, "fr", "s", 0), (302, "other", "fr", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = defaultdict(list)
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect():
        got[r["doc_id"]].append(tuple(r[c] for c in columns))
    want = defaultdict(list)
    for r in rows:
        want[r[0]].append(expected(r[0], r[1]))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items()}
    assert sum(v[0][0] > 0 for v in want.values()) > 40
