"""Operators across documents: against brute force on small corpora with planted cases."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barline.llm import decontaminate, mixing, near_dedup, sharding, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, _node long, tie string, words string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "clash", "clash") for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def corpus():
    """Random texts with exact copies, near copies, shared passages, odd rows and repeated rows."""
    rng = np.random.default_rng(3)
    text = lambda n: [f"t{k}" for k in rng.integers(0, 4000, n)]
    rows, passage = [], text(70)
    for i in range(60):
        rows.append((i, " ".join(text(int(rng.integers(40, 160)))), f"s{i % 5}"))
    base = text(150)
    for i in range(60, 110):  # a large group of near copies, some of them exact
        w = list(base)
        for k in rng.choice(150, int(rng.integers(0, 3)), replace=False):
            w[k] = f"n{rng.integers(0, 9)}"
        rows.append((i, " ".join(w), "s0"))
    for i in range(110, 140):  # one passage in many texts
        rows.append((i, " ".join(text(30) + passage + text(30)), None))
    rows += [(200, "", "s1"), (201, "", "s1"), (202, None, "s1"), (203, None, None), (204, "t1 t2", "s2"), (205, "t1  t2", "s2"),
             (206, "rep " * 300, "s3"), (207, "rep " * 340, "s3"), (60, rows[60][1], "s0"), (None, "t5 t6 t7 t8 t9 t10", "s4"),
             (208, " ".join(text(3000)), "s4")]
    return rows


def shingles(t):
    w = WORD.findall(t or "")
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def similar(a, b):
    low, high = sum((a & b).values()), sum((a | b).values())
    return high > 0 and 10 * low >= 8 * high


def test_signature_agreement_is_the_weighted_similarity():
    rng = np.random.default_rng(0)
    texts = []
    for _ in range(40):
        a = [f"w{k}" for k in rng.integers(0, 50, 90)] + ["r"] * int(rng.integers(0, 40))
        texts += [" ".join(a), " ".join(x if rng.random() < 0.94 else "z" for x in a) + " r" * int(rng.integers(0, 40))]
    from barline.llm.text import split_words

    sig = near_dedup.signatures(len(texts), *near_dedup.shingle_counts(split_words(pa.array(texts))))
    error = []
    for i in range(0, len(texts), 2):
        a, b = shingles(texts[i]), shingles(texts[i + 1])
        error.append((sig[i] == sig[i + 1]).mean() - sum((a & b).values()) / sum((a | b).values()))
    assert abs(np.mean(error)) < 0.03 and np.std(error) < 0.08


def test_near_duplicate_classes_match_brute_force(spark, corpus):
    ids = [r for r in corpus if r[0] is not None]
    sets = {i: shingles(t) for i, t, _ in ids}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    texts = {i: t for i, t, _ in ids}
    for a in sets:
        for b in sets:
            if a < b and (similar(sets[a], sets[b]) or (texts[a] is not None and texts[a] == texts[b])):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = near_dedup.near_duplicates(frame(spark, corpus)).collect()
    assert len(got) == len(corpus)
    assert all(r["class_id"] == find(r["doc_id"]) for r in got if r["doc_id"] is not None)
    kept = near_dedup.keep_one(frame(spark, corpus))
    assert kept.columns == ["doc_id", "text", "source", "_node", "tie", "words"]
    assert sorted(r[0] for r in kept.where("doc_id is not null").select("doc_id").collect()) == sorted({find(i) for i in sets})


def test_one_id_with_unrelated_texts_is_several_documents(spark):
    rng = np.random.default_rng(8)
    text = lambda: [f"t{k}" for k in rng.integers(0, 4000, 120)]
    a, b, c, d = text(), text(), text(), text()
    near = lambda w: " ".join(w[:-1] + ["z"])
    rows = [(5, " ".join(a), None), (5, " ".join(a), None), (5, " ".join(b), None), (7, near(a), None), (9, near(b), None),
            (5, None, None), (5, None, None), (None, None, None), (None, None, None), (None, " ".join(c), None),
            (11, near(c), None), (None, " ".join(d), None), (None, near(d), None)]
    got = defaultdict(list)
    for r in near_dedup.near_duplicates(frame(spark, rows)).collect():
        got[r["doc_id"]].append(r["class_id"])
    assert sum(map(len, got.values())) == len(rows)
    (seven,), (nine,), (eleven,) = got[7], got[9], got[11]
    assert seven != nine and 5 in (seven, nine) and min(seven, nine) < 0 and eleven == 11
    assert sorted(Counter(got[5]).values()) == [1, 2, 2] and got[5].count(seven) == 2 and got[5].count(nine) == 1
    free = got[None]
    assert free.count(None) == 2 and free.count(11) == 1 and len(set(free)) == 3
    kept = Counter((r["doc_id"], r["text"]) for r in near_dedup.keep_one(frame(spark, rows)).collect())
    of_d = {(None, " ".join(d)), (None, near(d))}
    assert sum(kept[x] for x in of_d) == 1
    assert {k: n for k, n in kept.items() if k not in of_d} == {
        (5, " ".join(a)): 1, (5, " ".join(b)): 1, (11, near(c)): 1, (5, None): 2, (None, None): 2}


def test_leftover_search_finds_links_the_star_misses(spark):
    """b is the bucket's smallest; c and d are linked to each other only."""
    rng = np.random.default_rng(1)
    w = [f"a{k}" for k in rng.integers(0, 900, 300)]
    far = w[:200] + [f"x{k}" for k in range(100)]
    rows = [(1, " ".join(w), None), (2, " ".join(far), None), (3, " ".join(far[:-3] + ["q", "r", "s"]), None)]
    sigs = near_dedup.sign(frame(spark, rows).select(F.col("doc_id").alias("node"), F.col("doc_id").alias("digest"), "text"))
    buckets = spark.createDataFrame([(9, 1), (9, 2), (9, 3)], "key long, node long")
    labels = spark.createDataFrame([], "node long, label long")
    pairs = near_dedup.leftover_pairs(buckets, sigs.select("node", "sig"), labels).collect()
    assert (2, 3) in {(r["a"], r["b"]) for r in pairs}


def test_leftover_search_verifies_inside_blocks(spark):
    """Copies of two sources, linked within each: no more links than join them, however many pairs pass the screen."""
    rng = np.random.default_rng(4)
    rows, sources = [], [[f"{s}{k}" for k in rng.integers(0, 900, 300)] for s in "ab"]
    for i in range(40):
        w = list(sources[i % 2])
        w[int(rng.integers(0, 300))] = f"n{i}"
        rows.append((i, " ".join(w), None))
    rows.append((40, " ".join(sources[0][:250] + [f"x{k}" for k in range(50)]), None))  # 0.70 like source a: no link
    docs = frame(spark, rows).select(F.col("doc_id").alias("node"), F.col("doc_id").alias("digest"), "text")
    sigs = near_dedup.sign(docs).select("node", "sig", "units").join(docs.select("node", "text"), "node")
    buckets = spark.createDataFrame([(key, i, 1) for key in (9, 8) for i in range(41)], "key long, node long, units long")
    labels = spark.createDataFrame([], "node long, label long")
    screened = near_dedup.leftover_pairs(buckets, sigs.select("node", "sig"), labels).count()
    links = near_dedup.leftover_pairs(buckets, sigs, labels).select("a", "b")
    assert screened >= 2 * 190 and 38 <= links.count() <= 2 * 38
    got = {r["node"]: r["label"] for r in near_dedup.components(links).collect()}
    assert got == {i: i % 2 for i in range(40)}


@pytest.mark.parametrize("units", [1, 300])
def test_search_in_one_block_and_in_many_finds_the_same_pairs(spark, units):
    """Long texts take more units, so that a block's bytes are bounded."""
    rng = np.random.default_rng(5)
    w = [f"a{k}" for k in rng.integers(0, 900, 300)]
    rows = [(i, " ".join(w[:-1] + [f"n{i}"]), None) for i in range(30)]
    sigs = near_dedup.sign(frame(spark, rows).select(F.col("doc_id").alias("node"), F.col("doc_id").alias("digest"), "text"))
    assert [r[0] for r in near_dedup.sign(spark.createDataFrame([(1, 1, "w " * near_dedup.UNIT)], "node long, digest long, text string"))
            .select("units").collect()] == [3]
    buckets = spark.createDataFrame([(9, i, units) for i in range(30)], "key long, node long, units long")
    pairs = near_dedup.leftover_pairs(buckets, sigs.select("node", "sig"), spark.createDataFrame([], "node long, label long")).collect()
    assert {(r["a"], r["b"]) for r in pairs} == {(a, b) for a in range(30) for b in range(a + 1, 30)}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (102, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in near_dedup.components(edges).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[102] == got[101] == 100


def test_repeats_match_brute_force(spark, corpus):
    words = [(i, WORD.findall(t or "")) for i, t, _ in corpus]
    first = {}
    for i, w in words:
        for s in range(len(w) - 49):
            key, d = tuple(w[s:s + 50]), float("inf") if i is None else i
            first[key] = min(first.get(key, d), d)
    want = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - 49):
            if first[tuple(w[s:s + 50])] < (float("inf") if i is None else i):
                gone.update(range(s, s + 50))
        want.append((i if i is not None else -1, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    got = substring_dedup.remove_repeats(frame(spark, corpus)).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["n_removed"], r["kept"]) for r in got) == sorted(want)
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("max_broadcast", [decontaminate.MAX_BROADCAST, 0])
def test_contamination_matches_brute_force(spark, corpus, max_broadcast):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    items = [(1, corpus[3][1].upper()[:200]), (2, corpus[115][1].replace(" ", ", ")), (3, "t1 T2"), (4, ""), (5, None), (6, "REP"),
             (7, "É t7 t8"), (8, "nothing of the kind is anywhere in here at all"), (9, "t1-t2"), (None, "t1 t2")]
    rows = [*corpus, (300, "x É t7-T8 y", None), (301, "x é t7 t8 y", None)]
    got = decontaminate.decontaminate(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"),
                                     max_broadcast=max_broadcast).collect()
    windows = defaultdict(set)
    for item, t in items:
        w = cut(t)
        for s in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[s:s + 10])].add(str(item))
    want = []
    for i, t, _ in rows:
        w, hit, found = cut(t), set(), set()
        for size in {len(k) for k in windows}:
            for s in range(len(w) - size + 1):
                if tuple(w[s:s + size]) in windows:
                    hit.update(range(s, s + size))
                    found |= windows[tuple(w[s:s + size])]
        want.append((i if i is not None else -1, len(w), len(hit), sorted(found - {"None"}), bool(hit)))
    key = lambda r: (r[0], r[1], r[2], r[3])
    have = [(r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["n_hit"], list(r["items"]), r["contaminated"]) for r in got]
    assert sorted(have, key=key) == sorted(want, key=key)
    none = decontaminate.decontaminate(frame(spark, rows), spark.createDataFrame([], "item_id long, text string"))
    assert none.where("contaminated").count() == 0 and none.count() == len(rows)


def fill_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    goal, open_set, rest = {}, set(names), 1.5 * sum(sizes.values())
    while open_set:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_set) for s in open_set}
        over = {s for s in open_set if share[s] >= 2 * sizes[s]}
        if not over:
            return goal | share
        for s in over:
            goal[s] = 2.0 * sizes[s]
            rest -= goal[s]
        open_set -= over
    return goal


def test_mix_meets_its_targets(spark, corpus):
    got = mixing.mix(frame(spark, corpus)).collect()
    sizes = Counter()
    for _, t, s in corpus:
        sizes[s] += len(WORD.findall(t or ""))
    want, taken = fill_targets(sizes), Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.mix(frame(spark, corpus).repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    out = mixing.mixed_documents(frame(spark, corpus))
    assert out.columns == ["doc_id", "text", "source", "_node", "tie", "words"]
    words = Counter()
    for r in out.collect():
        words[r["source"]] += len(WORD.findall(r["text"] or ""))
    largest = max(len(WORD.findall(t or "")) for _, t, _ in corpus)
    assert all(abs(words[s] - want[s]) <= largest for s in sizes)
    assert mixing.mix(frame(spark, [])).count() == 0


def test_mix_spreads_rows_of_one_id_and_counts_repeated_rows(spark):
    """A third of the rows share a null id, a third are one row repeated; every source still meets its target."""
    rows = [(None, f"n{i} " * (1 + i % 7), "a") for i in range(300)] + [(9, "same words here", "a")] * 300 + [
        (1000 + i, f"x{i} y", "b") for i in range(300)]
    sizes = mixing.sized(frame(spark, rows))
    of_null = sizes.where("doc_id is null").select(F.substring("key", 1, 2).alias("k")).distinct().count()
    assert of_null > 100  # of 256 ranges
    got = mixing.mix(frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len(t.split())) for i, t, _ in rows)
    taken, want = Counter(), {r["source"]: r["target"] for r in got}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in "ab")
    partly = [r["taken"] for r in got if r["doc_id"] == 9]  # whole epochs plus one more, cut in one row at most
    assert len({t for t in partly}) <= 3


def fill(shards, slots):
    import hashlib

    half = lambda i, at: int(hashlib.md5(f"shard-{i}".encode()).hexdigest()[at:at + 15], 16)
    owner, nxt, turn = [-1] * slots, [0] * shards, 0
    while turn < slots:
        i = turn % shards
        while True:
            slot = (half(i, 0) % slots + nxt[i] * (half(i, 16) % (slots - 1) + 1)) % slots
            nxt[i] += 1
            if owner[slot] < 0:
                break
        owner[slot] = i
        turn += 1
    return owner


def test_shards_take_turns_and_place_rows(spark):
    got = [r["shard"] for r in sharding.lookup_table(spark, 7, 101).orderBy("slot").collect()]
    assert got == fill(7, 101)
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "doc_id long, shard string")
    placed = sharding.place(rows, "doc_id", sharding.lookup_table(spark, 7, 101), 101).collect()
    assert len(placed) == 3 and len({r["shard"] for r in placed if r["doc_id"] == 1}) == 1
    assert all(0 <= r["shard"] < 7 for r in placed)


def test_removing_a_shard_moves_few_other_slots():
    names = sharding.shard_names(20)
    before = [names[i] for i in sharding.filled_slots(names, 2003)]
    for gone in ("shard-0", "shard-11", "shard-19"):
        rest = [n for n in names if n != gone]
        after = [rest[i] for i in sharding.filled_slots(rest, 2003)]
        assert max(map(after.count, rest)) - min(map(after.count, rest)) <= 1
        others = [(a, b) for a, b in zip(before, after) if a != gone]
        assert sum(a != b for a, b in others) < 0.1 * len(others)


def test_sharding_of_an_empty_table(spark):
    assert sharding.place(frame(spark, []), "doc_id", sharding.lookup_table(spark)).count() == 0
