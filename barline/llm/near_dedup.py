"""Near-duplicate groups by BagMinHash signatures over word shingles (operator 6).

A text is the multiset of its shingles of ``SHINGLE`` words (one shingle of all
its words if it has fewer).  Two texts are linked if the weighted Jaccard
similarity of their multisets, sum of minima over sum of maxima, is at least
``THRESHOLD``; a class is a connected set of linked texts.

A node is a distinct text: rows with equal texts (by their whole MD5) are copies of
one node, signed once a task and joined to its class by the text's key.

1. Signature.  Each shingle owns a Poisson process over (weight level, time);
   a text sees the points below its count.  Levels are discretised to integers
   and held in doubling blocks [0,1), [1,2), [2,4), ...: a block is one process
   of its length's rate, and a block only partly below the count is thinned by
   the points' levels.  Each point falls on one of ``REGISTERS`` registers; a
   register keeps its first time, so two texts agree there with probability
   equal to their weighted Jaccard similarity.  Points are drawn up to the time
   by which all registers are expected to be filled, and further if one is not.
2. ``BANDS`` bands of ``ROWS`` registers are hashed to bucket keys.  Two texts of
   similarity 0.8 miss all bands with probability 0.0013, of 0.85 with 1e-5; of
   0.5 they meet with 0.13.  A signature keeps 8 bits a register.
3. Stars, never all pairs: a text is compared with the smallest member that any
   of its buckets has, and in a second round with the smallest member of the
   largest class in those of its buckets that hold several classes.  Signatures
   that agree in under ``SCREEN`` of the registers (4 standard deviations below
   0.8) are dropped, all others are verified on their whole texts.
4. Best partners: in buckets that then still hold several classes, every member
   outside the largest class is compared with all other members, in blocks of
   bounded size, and goes on with the ``PARTNERS`` texts of other classes it agrees
   with most.  Only these pairs are verified, which joins copies to their common source.
5. Buckets that still hold several classes are searched once more in the same
   blocks, now with the texts: all pairs of different classes that pass the screen
   are verified inside the block, the most alike first and each in the first bucket
   it shares only, unless links of the block already join the two.  A block gives the
   links that join classes anew, fewer than it has members, so no list of pairs
   is written, and no link between texts sharing a bucket is lost to the rounds before.
6. Classes are found by label propagation with pointer jumping, each round
   written to the shared folder.

An id that repeats with other texts is as many documents as it has texts.  A class is
numbered by its smallest doc_id; if several classes have the same smallest id, one
has it and each other one a negative number from its texts, as has a class without
an id.  Texts without words are linked only to equal texts; null texts to nothing
(without an id their class is null).  Empty tables give no rows; other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.text import MIX1, MULT, Words, forget, fresh, hash_strings, mix, pieces, prepare, rolling, split_words, written

SHINGLE = 5
THRESHOLD = (8, 10)  # a fraction, compared in integers
REGISTERS = 512
BANDS = 36
ROWS = 8
SCREEN = 0.73
STAR_ROUNDS = 2
PARTNERS = 3
QUERY_BLOCK, OTHER_BLOCK = 512, 2048  # units, of which a text has one and another for each UNIT bytes
UNIT = 16 << 10
PAIRS = 256  # verified at a time inside a block
PIECE = 1 << 20  # bytes of text signed or compared at a time


# ---------------------------------------------------------------- signatures

def shingle_counts(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count) of the distinct shingles of each text."""
    ids, n = hash_strings(words.uniques)[words.codes], words.counts
    owner = words.owners
    full = rolling(ids, SHINGLE)
    at = np.flatnonzero(owner[:len(full)] == owner[SHINGLE - 1:]) if len(full) else np.zeros(0, np.int64)
    text, key = [owner[at]], [full[at]]
    for size in range(1, SHINGLE):
        short = np.flatnonzero(n == size)
        if len(short):
            text.append(short)
            key.append(mix(rolling(ids, size)[words.starts[short]] + np.uint64(size)))
    text, key = np.concatenate(text), np.concatenate(key)
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (key[1:] != key[:-1])
    at = np.flatnonzero(first)
    return text[at], key[at], np.diff(np.append(at, len(text)))


def uniform(seed: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from 64-bit seeds."""
    return ((mix(seed) >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def signatures(n: int, text: np.ndarray, key: np.ndarray, count: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """(n, registers) first point times of texts given by their shingle counts; inf for texts without shingles."""
    total = np.bincount(text, weights=count, minlength=n)
    out = np.full(n * registers, np.inf)
    # one node per shingle and doubling block [low, low + size) below its count
    blocks = 1 + np.ceil(np.log2(count)).astype(np.int64)
    node = np.repeat(np.arange(len(text)), blocks)
    block = np.arange(len(node)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    size = np.maximum(1, 2 ** np.maximum(block - 1, 0))
    low = np.where(block == 0, 0, size)
    with np.errstate(over="ignore"):
        seed = mix(key[node] + (block.astype(np.uint64) + np.uint64(1)) * MULT)
    limit = registers * (math.log(registers) + 6) / np.maximum(total, 1)
    pending = np.flatnonzero(total > 0)
    while len(pending):
        wanted = np.zeros(n, bool)
        wanted[pending] = True
        live = np.flatnonzero(wanted[text[node]])
        time, step = np.zeros(len(live)), 0
        while len(live):  # the next points of every process still before its text's time limit
            ahead = 1 if len(live) > 4096 else 64  # few processes go on long where a text is short
            with np.errstate(over="ignore"):
                draw = seed[live][:, None] + np.arange(step + 1, step + ahead + 1).astype(np.uint64) * MIX1
                gap = -np.log(uniform(draw)) / size[live][:, None]
                point = np.cumsum(np.concatenate([time[:, None], gap], axis=1), axis=1)[:, 1:]
                on = point <= limit[text[node[live]]][:, None]
                own = np.repeat(live, on.sum(axis=1))
                place = mix(draw[on] ^ MULT)
            level = low[own] + ((place >> np.uint64(32)) % size[own].astype(np.uint64)).astype(np.int64)
            seen = level < count[node[own]]
            register = ((place & np.uint64(0xFFFFFFFF)) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(out, text[node[own[seen]]] * registers + register[seen], point[on][seen])
            live, time, step = live[on[:, -1]], point[on[:, -1], -1], step + ahead
        empty = np.isinf(out.reshape(n, registers)[pending]).any(axis=1)
        pending = pending[empty]
        limit[pending] *= 2
    return out.reshape(n, registers)


def sign(docs: DataFrame) -> DataFrame:
    """(node, digest, sig, bands, units) of the rows of (node, digest, text) with a text, once per node and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # 64 bits for each row of one input partition
        for batch in batches:
            node = batch.column("node").to_pylist()
            fresh_at = [i for i, v in enumerate(node) if not (v in done or done.add(v))]
            for part in pieces(batch.take(pa.array(fresh_at, pa.int64())), limit=PIECE):
                n = part.num_rows
                words = split_words(part.column("text"))
                times = signatures(n, *shingle_counts(words)).view(np.uint64)
                with np.errstate(over="ignore"):
                    sig = (mix(times) >> np.uint64(56)).astype("u1")
                    bands = np.zeros((n, BANDS), np.uint64)
                    for k in range(ROWS):
                        bands = mix(bands * MULT + times[:, k * BANDS:(k + 1) * BANDS] + np.uint64(k + 1))
                    bands = mix(bands + (np.arange(BANDS, dtype=np.uint64) + np.uint64(1)) * MIX1).view(np.int64)
                lists = [b if c else b[:0] for b, c in zip(bands, words.counts)]
                units = 1 + pc.binary_length(part.column("text")).to_numpy(zero_copy_only=False).astype(np.int64) // UNIT
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("digest"), pa.array([s.tobytes() for s in sig], pa.binary()),
                     pa.array(lists, pa.list_(pa.int64())), pa.array(units)], names=["node", "digest", "sig", "bands", "units"])

    return docs.where(F.col("text").isNotNull()).mapInArrow(run, "node long, digest long, sig binary, bands array<long>, units long")


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal registers of rows of packed signatures."""
    return (a == b).mean(axis=-1)


def unpack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "u1").reshape(len(column), REGISTERS)


# ---------------------------------------------------------------- links

def screened(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """(a, b, sure): pairs whose signatures agree enough; sure where the texts are equal."""
    both = pairs.join(sigs.select(F.col("node").alias("a"), F.col("digest").alias("da"), F.col("sig").alias("sa")), "a")
    both = both.join(sigs.select(F.col("node").alias("b"), F.col("digest").alias("db"), F.col("sig").alias("sb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sure = batch.column("da").to_numpy() == batch.column("db").to_numpy()
                near = sure | (agreement(unpack(batch.column("sa")), unpack(batch.column("sb"))) >= SCREEN)
                out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sure)], names=["a", "b", "sure"])
                yield out.filter(pa.array(near))

    return both.select("a", "b", "da", "db", "sa", "sb").mapInArrow(run, "a long, b long, sure boolean").groupBy("a", "b").agg(
        F.max("sure").alias("sure"))


def overlaps(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Whether each pair of whole texts reaches the threshold, by exact multiset overlap."""
    n = len(a)
    ta, ka, ca = shingle_counts(split_words(a))
    tb, kb, cb = shingle_counts(split_words(b))
    with np.errstate(over="ignore"):
        tag = [mix(k ^ mix(t.astype(np.uint64) * MULT + MULT)) for t, k in ((ta, ka), (tb, kb))]
    _, ia, ib = np.intersect1d(*tag, assume_unique=True, return_indices=True)
    low = np.bincount(ta[ia], weights=np.minimum(ca[ia], cb[ib]), minlength=n)
    high = np.bincount(ta, weights=ca, minlength=n) + np.bincount(tb, weights=cb, minlength=n) - low
    return (high > 0) & (low * THRESHOLD[1] >= high * THRESHOLD[0])


def holding(a: pa.Array, b: pa.Array) -> np.ndarray:
    """``overlaps`` of any number of pairs, in bounded memory."""
    parts = pieces(pa.RecordBatch.from_arrays([a, b], names=["a", "b"]), "a", PIECE)
    return np.concatenate([np.zeros(0, bool), *[overlaps(p.column("a"), p.column("b")) for p in parts]])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): the pairs that are sure or reach the threshold on their whole texts (one row a node), written."""
    both = pairs.where(~F.col("sure")).join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["a", "b"]).filter(pa.array(holding(batch.column("ta"), batch.column("tb"))))

    return written(pairs.where("sure").select("a", "b").unionByName(both.mapInArrow(run, "a long, b long").distinct()), "verified")


def joining(text: pa.Array, label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the pairs (a[k], b[k]) that reach the threshold and join classes that no link before them joins."""
    _, own = np.unique(label, return_inverse=True)
    found = []
    for at in range(0, len(a), PAIRS):
        some = np.arange(at, min(at + PAIRS, len(a)))
        some = some[own[a[some]] != own[b[some]]]
        if len(some):
            good = some[holding(text.take(pa.array(a[some])), text.take(pa.array(b[some])))]
            for k in good:
                if own[a[k]] != own[b[k]]:
                    own[own == own[b[k]]] = own[a[k]]
                    found.append(k)
    return np.array(found, np.int64)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node connected to each node of ``edges`` (a, b)."""
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("heard")), "b").groupBy(
            F.col("a").alias("node")).agg(F.min("heard").alias("heard"))
        best = labels.join(heard, "node").select("node", F.col("label").alias("old"), F.least("label", "heard").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        moved = written(best.join(jump, "mid", "left").select("node", "old", F.least("mid", F.coalesce("far", "mid")).alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def mixed_members(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold several classes, with the bucket's size, its largest class and that class's smallest member.

    Sizes are in units of text if ``buckets`` has them, else in members.
    """
    units = F.col("units") if "units" in buckets.columns else F.lit(1)
    members = buckets.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"), units.alias("units"))
    per_class = members.groupBy("key", "label").agg(F.sum("units").alias("n"), F.min("node").alias("least"))
    largest = F.max_by(F.struct("label", "least", F.col("n").alias("n_main")), F.struct("n", "label"))
    mixed = per_class.groupBy("key").agg(F.sum("n").alias("n"), largest.alias("_m"), F.count(F.lit(1)).alias("classes"))
    mixed = mixed.where("classes > 1").select("key", "n", F.col("_m.label").alias("main"), F.col("_m.least").alias("leader"),
                                              F.col("_m.n_main").alias("n_main"))
    return members.join(mixed, "key")


def star_pairs(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(a, b): every member b with the smallest leader a that its buckets offer, one pair a member."""
    if labels is None:
        leaders = buckets.groupBy("key").agg(F.min("node").alias("leader"))
        offers = buckets.join(leaders, "key").where(F.col("leader") != F.col("node"))
    else:
        offers = mixed_members(buckets, labels).where(F.col("label") != F.col("main"))
    return offers.groupBy(F.col("node").alias("b")).agg(F.min("leader").alias("a")).select("a", "b")


def searched(buckets: DataFrame, sigs: DataFrame, labels: DataFrame, best: bool) -> DataFrame:
    """(a, b, agree): screened pairs between different classes inside one bucket, searched in blocks.

    With ``best`` only the partners that a member outside its bucket's largest class agrees with most;
    else all, each pair in the first bucket it shares if ``sigs`` has the bands.  If ``sigs`` has the
    texts, only pairs that reach the threshold and join classes that the block's pairs before do not.
    """
    members = mixed_members(buckets, labels).join(sigs, "node")
    query_blocks = F.ceil((F.col("n") - F.col("n_main")) / QUERY_BLOCK).cast("long")
    other_blocks = F.ceil(F.col("n") / OTHER_BLOCK).cast("long")
    place = lambda blocks, salt: F.pmod(F.xxhash64("node", F.lit(salt)), blocks)
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    once = not best and "bands" in sigs.columns
    verify = "text" in sigs.columns
    common = ("key", "node", "label", "sig", *(["bands"] if once else []), *(["text"] if verify else []))
    asks, whole = F.col("label") != F.col("main"), (query_blocks <= 1) & (other_blocks <= 1)  # a bucket in one block is sent once
    queries = members.where(asks & ~whole).select(
        *common, F.lit(True).alias("query"), F.lit(False).alias("other"), place(query_blocks, 1).alias("q"), upto(other_blocks).alias("o"))
    others = members.select(
        *common, (asks & whole).alias("query"), F.lit(True).alias("other"), upto(query_blocks).alias("q"), place(other_blocks, 2).alias("o"))

    def search(block: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(block["sig"]), "u1").reshape(len(block), REGISTERS)
        node, label, query = (block[c].to_numpy() for c in ("node", "label", "query"))
        bands = np.stack(block["bands"].to_list()) if once else None
        here = block["key"].iloc[0]
        a, b, agreed = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        other = np.flatnonzero(block["other"].to_numpy())
        for i in np.flatnonzero(query):
            far = other[label[other] != label[i]]
            alike = agreement(sig[far], sig[i])
            if best:
                pick = np.argsort(-alike, kind="stable")[:PARTNERS]
                pick = pick[alike[pick] >= SCREEN]
            else:
                pick = np.flatnonzero(alike >= SCREEN)
            if once and len(pick):  # the first band that both have in common
                same = bands[far[pick]] == bands[i]
                pick = pick[bands[i][same.argmax(axis=1)] == here]
            a.append(np.full(len(pick), i))
            b.append(far[pick])
            agreed.append(alike[pick])
        a, b, agreed = (np.concatenate(x) for x in (a, b, agreed))
        if verify and len(a):
            order = np.argsort(-agreed, kind="stable")
            at = order[joining(pa.array(block["text"], pa.string()), label, a[order], b[order])]
            a, b, agreed = a[at], b[at], agreed[at]
        return pd.DataFrame({"a": node[a], "b": node[b], "agree": agreed})

    return queries.unionByName(others).groupBy("key", "q", "o").applyInPandas(search, "a long, b long, agree double")


def unsure(pairs: DataFrame) -> DataFrame:
    """(a, b, sure): distinct pairs with a < b, to be verified."""
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().withColumn("sure", F.lit(False))


def best_pairs(buckets: DataFrame, sigs: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b, sure): every member of a mixed bucket, outside the bucket's largest class, with its best partners in other classes."""
    found = searched(buckets, sigs, labels, best=True).groupBy("a").agg(F.collect_set(F.struct("agree", "b")).alias("p"))
    top = F.slice(F.sort_array("p", asc=False), 1, PARTNERS)  # of at most PARTNERS a block and bucket
    return unsure(found.select("a", F.explode(top).alias("p")).select("a", "p.b"))


def leftover_pairs(buckets: DataFrame, sigs: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b, sure): all screened pairs between different classes that share a bucket; with texts, the links that join them."""
    return unsure(searched(buckets, sigs, labels, best=False))


def node_of(doc_id: Column, text: Column) -> Column:
    """64 bits that stand for a row's id and text."""
    return F.xxhash64(doc_id, text)


def text_nodes(src: DataFrame) -> DataFrame:
    """``src`` with ``node``, 64 bits that stand for a text; different texts (by MD5) that share them are told apart.

    At 10^10 texts a few pairs share 64 bits: then all but the one with the least MD5 take theirs from the MD5.
    """
    rows = src.withColumn("node", F.when(F.col("empty"), F.col("who")).otherwise(F.xxhash64("text"))).withColumn("md5", F.md5("text"))
    met = rows.where("not empty").groupBy("node").agg(F.min("md5").alias("least"), F.max("md5").alias("most"))
    twins = written(met.where("least != most").select("node", "least"), "twins")
    if not twins.isEmpty():
        own = F.when(F.col("least").isNotNull() & (F.col("md5") != F.col("least")), F.xxhash64("md5", F.lit(1))).otherwise(F.col("node"))
        rows = rows.join(twins, "node", "left").withColumn("node", own).drop("least")
    return rows.drop("md5")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, who, empty, label): the smallest node of each row's class; ``empty`` rows have a null text."""
    prepare(docs.sparkSession)
    src = docs.select(F.col(doc_id).alias("doc_id"), node_of(F.col(doc_id), F.col(text)).alias("who"),
                      F.col(text).isNull().alias("empty"), F.col(text).alias("text"))
    src = text_nodes(src)
    signed = written(sign(src.select("node", F.col("node").alias("digest"), "text")), "signatures")
    # a key is shared if it has different texts; a text signed by several tasks counts once
    # dealt by key once: both sides of the join read the same columns, so they read the same exchange
    held = signed.select(F.explode("bands").alias("key"), "node", "units").repartition("key")
    shared = held.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"), F.max("units").alias("units"))
    shared = shared.where("least != most and units > 0").select("key")
    buckets = written(held.join(shared, "key").distinct(), "buckets")
    # only texts that share a bucket are compared; their list grows with the corpus and is never sent whole to every task
    sharing = written(buckets.select("node").distinct(), "sharing").hint("merge")
    sigs = signed.join(sharing, "node", "left_semi").dropDuplicates(["node"])
    sigs = written(sigs.select("node", "digest", "sig", "bands"), "shared_signatures")
    forget(signed)
    texts = src.where("not empty").select("node", "text").join(sharing, "node", "left_semi").dropDuplicates(["node"])
    texts = written(texts, "shared_texts")
    links, labels = None, None
    for k in range(STAR_ROUNDS + 1):
        pairs = screened(star_pairs(buckets, labels), sigs) if k < STAR_ROUNDS else best_pairs(buckets, sigs.select("node", "sig"), labels)
        found = verified(written(pairs, "pairs"), texts)
        links = written(found if links is None else links.unionByName(found), "links")
        labels = components(links)
    rest = written(leftover_pairs(buckets, sigs.select("node", "sig", "bands").join(texts, "node"), labels), "joining").select("a", "b")
    if not rest.isEmpty():
        labels = components(links.unionByName(rest))
    rows = src.select("doc_id", "who", "node", "empty").join(labels, "node", "left")
    return written(rows.select("doc_id", "who", "empty", F.coalesce("label", "node").alias("label")), "classes")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id): each row with the number of its class."""
    rows = classes(docs, doc_id, text)
    each = rows.groupBy("label").agg(F.min(F.col("doc_id").cast("long")).alias("least"), F.min("empty").alias("empty"))
    # of the classes with one smallest id, the first with a text has it
    owner = each.groupBy("least").agg(F.min(F.struct("empty", "label"))["label"].alias("owner"))
    number = -1 - F.shiftrightunsigned("label", 2)
    number = F.when(F.col("label") == F.col("owner"), F.col("least")).when(F.col("least").isNotNull() | ~F.col("empty"), number)
    numbers = each.join(owner.where("least is not null"), "least", "left").select("label", number.alias("class_id"))
    return rows.join(numbers, "label").select("doc_id", "class_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of the smallest document of each class, and all rows with a null text."""
    node, columns = fresh(docs, "_node"), docs.columns
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("who")))
    kept = classes(docs.select("doc_id", "text")).where("not empty").groupBy("label").agg(first["who"].alias(node)).select(node)
    rows = docs.where(F.col("text").isNotNull()).withColumn(node, node_of(F.col("doc_id"), F.col("text"))).dropDuplicates([node])
    return rows.join(kept, node, "left_semi").select(*columns).unionByName(docs.where(F.col("text").isNull()))
