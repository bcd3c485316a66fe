"""Toxicity: a bidirectional gated recurrent network with attention pooling (operator 2).

Input of a step is one word: the embedding of the hashed word plus the mean
embedding of its hashed character n-grams.  A forward and a backward GRU read
each window, attention pools their states, and a logistic unit scores the
window.  Every text is scored by all its windows of ``WINDOW`` words, each
overlapping the next by half; the document's score is its highest window score
after Platt calibration.

Training runs in numpy on the driver over a bounded sample: at most
``MAX_PER_CLASS`` labelled documents per class, those with the smallest hash of
their id.  A document counts through its highest-scoring window (multiple
instance learning); every update scores all windows of its documents.  The number
of updates is fixed, so training cost does not grow with the table.

Null and empty texts score 0.  Repeated rows each get a row; labels join by
``doc_id`` (null ids have none).  With no labelled documents, or only one
class, every score is 0 (no toxic example) or 1 (no clean one).  The input's
other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.text import Words, hash_strings, pieces, prepare, ragged, release, split_words, subword_ids

WINDOW = 64
STRIDE = 32
HIDDEN = 8
EMBED = 8
CHAR_BUCKETS = 1 << 17
CHAR_SIZES = (3, 4)
MIN_DOCS = 3
WORD_BLOCK = 1 << 13  # words whose n-grams are hashed at a time
MAX_PER_CLASS = 1000
UPDATES = 400
BATCH_DOCS = 20  # of each class
RATE = 0.02
DECAY = 1e-5
CHECK_EVERY = 25
THRESHOLD = 0.3
SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


# ---------------------------------------------------------------- inputs

@dataclass
class Inputs:
    """Hashed inputs of distinct words: a word key each, and the buckets of its character n-grams, word by word."""

    key: np.ndarray
    n_chars: np.ndarray
    chars: np.ndarray

    @functools.cached_property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.n_chars) - self.n_chars

    def select(self, words: np.ndarray) -> Inputs:
        return Inputs(self.key[words], self.n_chars[words], self.chars[ragged(self.starts[words], self.n_chars[words])])


def word_inputs(uniques: pa.Array, block: int = WORD_BLOCK) -> Inputs:
    """Inputs of distinct words, ``block`` words at a time: the n-grams of all at once would take many times the result."""
    parts = []
    for at in range(0, max(len(uniques), 1), block):
        plain = pc.utf8_trim(pc.utf8_lower(uniques.slice(at, block)), SIGNS)
        owner, chars = subword_ids(plain, CHAR_SIZES, CHAR_BUCKETS)
        order = np.argsort(owner, kind="stable")
        parts.append((hash_strings(plain), np.bincount(owner, minlength=len(plain)), chars[order]))
    return Inputs(*map(np.concatenate, zip(*parts)))


def windows(counts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of texts: (text index, first word, size); consecutive ones overlap, the last ends at the text's end."""
    n = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(counts)), n)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    first = np.minimum(k * STRIDE, np.maximum(counts[owner] - WINDOW, 0))
    return owner, starts[:-1][owner] + first, np.minimum(counts[owner], WINDOW)


# ---------------------------------------------------------------- network

GATES = ("update", "reset", "candidate")


def initial(n_words: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters; ``word`` has a row for each known word and a last one, always 0, for all others."""
    rng = np.random.default_rng(seed)
    p = {"word": np.zeros((n_words + 1, EMBED)), "char": 0.05 * rng.standard_normal((CHAR_BUCKETS, EMBED)),
         "attend": 0.3 * rng.standard_normal(2 * HIDDEN), "out": 0.5 * rng.standard_normal(2 * HIDDEN), "bias": np.zeros(1)}
    for side in "fb":
        for gate in GATES:
            p[f"in_{gate}_{side}"] = rng.standard_normal((EMBED, HIDDEN)) / math.sqrt(EMBED)
            p[f"rec_{gate}_{side}"] = rng.standard_normal((HIDDEN, HIDDEN)) / math.sqrt(HIDDEN)
            p[f"bias_{gate}_{side}"] = np.zeros(HIDDEN)
    return {k: v.astype(np.float32) for k, v in p.items()}


def word_rows(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Rows of the word table for word keys: the place among the sorted known keys, or the last row."""
    at = np.searchsorted(known, keys)
    hit = at < len(known)
    hit[hit] = known[at[hit]] == keys[hit]
    return np.where(hit, at, len(known))


def embed(p: dict, x: Inputs, rows: np.ndarray) -> np.ndarray:
    """(words, EMBED) inputs of distinct words: word embedding plus mean n-gram embedding."""
    out = p["word"][rows]
    filled = np.flatnonzero(x.n_chars)
    if len(filled):
        at = (np.cumsum(x.n_chars) - x.n_chars)[filled]
        out[filled] += np.add.reduceat(p["char"].take(x.chars, axis=0), at, axis=0) / x.n_chars[filled, None].astype(np.float32)
    return out


def soft(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|): the cheap sigmoid of this network; gates use (1 + soft) / 2."""
    return x / (1 + np.abs(x))


def gate_inputs(p: dict, vectors: np.ndarray, side: str) -> list[np.ndarray]:
    """The input part of each gate for distinct words, (words, HIDDEN)."""
    return [vectors @ p[f"in_{g}_{side}"] + p[f"bias_{g}_{side}"] for g in GATES]


def gru(p: dict, side: str, gates: list[np.ndarray], steps: np.ndarray, mask: np.ndarray | None, keep: bool = False):
    """States (T, N, HIDDEN) of one direction over the words ``steps`` (T, N).

    ``mask`` (T, N) is 0 outside the text.  With ``keep`` the values needed for
    the gradient come along.
    """
    uz, ur, uc = (p[f"rec_{g}_{side}"] for g in GATES)
    h = np.zeros((steps.shape[1], HIDDEN), np.float32)
    states = np.empty((len(steps), *h.shape), np.float32)
    kept = []
    for t, words in enumerate(steps):
        z = 0.5 * soft(gates[0].take(words, axis=0) + h @ uz) + 0.5
        r = 0.5 * soft(gates[1].take(words, axis=0) + h @ ur) + 0.5
        a = h @ uc
        c = soft(gates[2].take(words, axis=0) + r * a)
        new = c + z * (h - c)
        if mask is not None:
            new *= mask[t, :, None]
        if keep:
            kept.append((h, z, r, c, a))
        h = states[t] = new
    return states, kept


def forward(p: dict, gates: dict, steps: np.ndarray, mask: np.ndarray | None, keep: bool = False):
    """Logit of each window; ``steps`` is (T, N).  Padding, if any, lies at the end of a window."""
    f, kf = gru(p, "f", gates["f"], steps, mask, keep)
    b, kb = gru(p, "b", gates["b"], steps[::-1], None if mask is None else mask[::-1], keep)
    b = b[::-1]
    score = f @ p["attend"][:HIDDEN] + b @ p["attend"][HIDDEN:]
    if mask is not None:
        score = np.where(mask > 0, score, np.float32(-1e9))
    weight = np.exp(score - score.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.concatenate([np.einsum("tn,tnh->nh", weight, x) for x in (f, b)], axis=1)
    return pooled @ p["out"] + p["bias"][0], (f, b, kf, kb, weight, pooled)


def gru_gradient(p: dict, side: str, kept: list, mask: np.ndarray, d_states: np.ndarray):
    """Gradients of the three gate inputs, (T, N, HIDDEN) each, and of the recurrent weights."""
    rec = [p[f"rec_{g}_{side}"] for g in GATES]
    d_gates = np.empty((3, *d_states.shape), np.float32)
    d_rec, dh = [np.zeros_like(u) for u in rec], np.zeros_like(d_states[0])
    for t in range(len(kept) - 1, -1, -1):
        h, z, r, c, a = kept[t]
        dn = (dh + d_states[t]) * mask[t, :, None]
        dc = dn * (1 - z) * (1 - np.abs(c)) ** 2
        dz = dn * (h - c) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
        dr = dc * a * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
        for i, (d, into) in enumerate(((dz, dz), (dr, dr), (dc, dc * r))):
            d_gates[i, t] = d
            d_rec[i] += h.T @ into
            dh = dn * z + into @ rec[i].T if i == 0 else dh + into @ rec[i].T
    return d_gates, d_rec


def gradient(p: dict, x: Inputs, rows: np.ndarray, vectors: np.ndarray, steps: np.ndarray, mask: np.ndarray,
             cache: tuple, d_logit: np.ndarray) -> dict[str, np.ndarray]:
    f, b, kf, kb, weight, pooled = cache
    g = {"out": d_logit @ pooled, "bias": np.array([d_logit.sum()], np.float32)}
    both = np.concatenate([f, b], axis=2)
    d_pool = d_logit[:, None] * p["out"]
    d_weight = np.einsum("tnh,nh->tn", both, d_pool)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    g["attend"] = np.einsum("tn,tnh->h", d_score, both)
    d_both = weight[:, :, None] * d_pool + d_score[:, :, None] * p["attend"]
    d_vec = np.zeros_like(vectors)
    for side, kept, d, s, m in (("f", kf, d_both[:, :, :HIDDEN], steps, mask),
                                ("b", kb, d_both[::-1, :, HIDDEN:], steps[::-1], mask[::-1])):
        d_gates, d_rec = gru_gradient(p, side, kept, m, d)
        for i, gate in enumerate(GATES):
            per_word = np.zeros((len(vectors), HIDDEN), np.float32)
            np.add.at(per_word, s.reshape(-1), d_gates[i].reshape(-1, HIDDEN))
            g[f"rec_{gate}_{side}"], g[f"in_{gate}_{side}"] = d_rec[i], vectors.T @ per_word
            g[f"bias_{gate}_{side}"] = per_word.sum(axis=0)
            d_vec += per_word @ p[f"in_{gate}_{side}"].T
    g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
    moved = np.unique(steps)  # only words of these windows have a gradient
    near = x.select(moved)
    np.add.at(g["word"], rows[moved], d_vec[moved])
    np.add.at(g["char"], near.chars, np.repeat(d_vec[moved] / np.maximum(near.n_chars, 1)[:, None], near.n_chars, axis=0))
    g["word"][-1] = 0
    return g


def window_logits(p: dict, words: Words, gates: dict, first: np.ndarray, size: np.ndarray, block: int = 2048) -> np.ndarray:
    """Logits of windows given by first word and size, in blocks of full and of short windows."""
    out = np.zeros(len(first), np.float32)
    for own in (np.flatnonzero(size == WINDOW), np.flatnonzero(size < WINDOW)):
        for i in range(0, len(own), block):
            k = own[i:i + block]
            steps, mask = window_steps(words.codes, first[k], size[k])
            out[k] = forward(p, gates, steps, mask)[0]
    return out


def window_steps(codes: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    length = int(size.max())
    at = first + np.arange(length)[:, None]
    if (size == length).all():
        return codes[at], None
    mask = (np.arange(length)[:, None] < size).astype(np.float32)
    return codes[np.minimum(at, len(codes) - 1)], mask


# ---------------------------------------------------------------- training

class Adam:
    def __init__(self, p: dict):
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}
        self.t = 0

    def step(self, p: dict, g: dict, rate: float) -> None:
        self.t += 1
        for k, d in g.items():
            d = d.astype(np.float32)
            self.m[k] += 0.1 * (d - self.m[k])
            self.v[k] += 0.01 * (d * d - self.v[k])
            scale = rate * math.sqrt(1 - 0.99 ** self.t) / (1 - 0.9 ** self.t)
            p[k] -= (scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-6)).astype(np.float32)


def document_logits(p: dict, words: Words, x: Inputs) -> np.ndarray:
    """Highest window logit of each text (-inf for texts without words)."""
    owner, first, size = windows(words.counts, words.starts)
    out = np.full(len(words.starts) - 1, -np.inf, np.float32)
    if len(owner):
        vectors = embed(p, x, word_rows(x.key, p["known"]))
        gates = {side: gate_inputs(p, vectors, side) for side in "fb"}
        np.maximum.at(out, owner, window_logits(p, words, gates, first, size))
    return out


def calibrate(logit: np.ndarray, label: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Platt scaling by Newton steps, with smoothed targets: probability = sigmoid(a * logit + b)."""
    n1, n0 = max(1, int(label.sum())), max(1, int((1 - label).sum()))
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    ab = np.array([1.0, 0.0])
    z = np.stack([logit, np.ones_like(logit)])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(ab @ z, -30, 30)))
        grad = z @ (weight * (q - target)) + 1e-3 * (ab - [1.0, 0.0])
        hess = (z * (weight * q * (1 - q))) @ z.T + 1e-3 * np.eye(2)
        ab = ab - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(max(ab[0], 1e-3)), float(ab[1])


def frequent(words: Words, x: Inputs) -> tuple[np.ndarray, np.ndarray]:
    """What is found in at least ``MIN_DOCS`` of the sample's texts: sorted word keys, and a flag per n-gram bucket.

    Only these are learnt; rarer ones would let the network remember single texts.
    """
    keys, at = np.unique(x.key, return_inverse=True)
    in_texts, of_grams = np.zeros(len(keys), np.int64), np.zeros(CHAR_BUCKETS, np.int64)
    for a, b in zip(words.starts[:-1], words.starts[1:]):
        own = np.unique(words.codes[a:b])
        in_texts[np.unique(at[own])] += 1
        of_grams[np.unique(x.select(own).chars)] += 1
    return keys[in_texts >= MIN_DOCS], of_grams >= MIN_DOCS


def log_loss(logit: np.ndarray, label: np.ndarray) -> float:
    """Mean logistic loss, both classes weighing the same."""
    loss = np.logaddexp(0, np.where(label == 1, -logit, logit))
    return float(sum(loss[label == k].mean() for k in (0, 1) if (label == k).any()))


def train(texts: list[str], labels: np.ndarray, prior: float, updates: int = UPDATES, seed: int = 7) -> dict[str, np.ndarray]:
    """Fit the network on whole texts; ``prior`` is the share of toxic documents, for calibration.

    Every fourth text is first kept from the updates, for the number of updates with
    the least loss on these texts and for calibration.  The weights returned are then
    fitted anew on all texts by that many updates.
    """
    words = split_words(pa.array(texts, pa.string()))
    x = word_inputs(words.uniques)
    known, common = frequent(words, x)
    rows = word_rows(x.key, known)
    w_owner, w_first, w_size = windows(words.counts, words.starts)
    w_from = np.searchsorted(w_owner, np.arange(len(texts) + 1))
    spare = np.arange(len(texts)) % 4 == 3
    usable = np.diff(w_from) > 0
    kept, least, best = initial(len(known), seed) | {"known": known}, np.inf, 0
    kept["char"][~common] = 0
    checked = np.flatnonzero(spare & (np.diff(w_from) > 0))
    seen = words.codes[ragged(words.starts[checked], words.counts[checked])]
    check_words = np.unique(seen)
    code = np.zeros(len(words.uniques), np.int64)
    code[check_words] = np.arange(len(check_words))
    check = Words(words.uniques, code[seen], np.concatenate([[0], np.cumsum(words.counts[checked])]))
    check_inputs = x.select(check_words)

    def fitted(groups: list[np.ndarray], n: int) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
        """(updates made, weights) after each of ``n`` updates on the texts of both groups."""
        rng = np.random.default_rng(seed)
        p = initial(len(known), seed) | {"known": known}
        p["char"][~common] = 0
        adam = Adam({k: v for k, v in p.items() if k != "known"})
        for step in range(n if min(map(len, groups)) else 0):
            docs = np.concatenate([rng.choice(own, min(BATCH_DOCS, len(own)), replace=False) for own in groups])
            cand = ragged(w_from[docs], w_from[docs + 1] - w_from[docs])
            own = words.codes[ragged(w_first[cand], w_size[cand])]
            used = np.unique(own)
            code[used] = np.arange(len(used))
            view = Words(words.uniques, code[own], np.zeros(0, np.int64))
            first = np.cumsum(w_size[cand]) - w_size[cand]
            part = x.select(used)
            vectors = embed(p, part, rows[used])
            gates = {side: gate_inputs(p, vectors, side) for side in "fb"}
            # a document counts through its highest window under the present weights; toxic ones at first by any window
            logit = window_logits(p, view, gates, first, w_size[cand])
            if step < updates // 3:
                logit = np.where(labels[w_owner[cand]] == 1, rng.random(len(cand)), logit)
            ends = np.flatnonzero(np.diff(w_owner[cand], append=-1)) + 1
            top = np.array([a + np.argmax(logit[a:b]) for a, b in zip(np.append(0, ends[:-1]), ends)])
            steps, mask = window_steps(view.codes, first[top], w_size[cand][top])
            mask = np.ones(steps.shape, np.float32) if mask is None else mask
            z, cache = forward(p, gates, steps, mask, keep=True)
            y = labels[w_owner[cand][top]]
            share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
            d = ((1 / (1 + np.exp(-z)) - y) * share).astype(np.float32)
            g = gradient(p, part, rows[used], vectors, steps, mask, cache, d)
            g["word"] += DECAY * p["word"]
            g["char"] += DECAY * p["char"]
            g["char"][~common] = 0
            adam.step(p, g, RATE * (1 - step / updates) + 1e-4)
            yield step + 1, p

    both = lambda chosen: [np.flatnonzero((labels == k) & chosen) for k in (0, 1)]
    for made, p in fitted(both(usable & ~spare), updates):
        if len(checked) and made % CHECK_EVERY == 0:
            loss = log_loss(document_logits(p, check, check_inputs), labels[checked])
            if loss < least:
                kept, least, best = {k: v.copy() for k, v in p.items()}, loss, made
    logit = document_logits(kept, check, check_inputs).astype(np.float64)
    y = labels[checked]
    n1, n0 = (max(1, int((y == k).sum())) for k in (1, 0))
    weight = np.where(y == 1, prior / n1, (1 - prior) / n0) * (n0 + n1)
    platt = np.array(calibrate(logit, y, weight))
    for _, kept in fitted(both(usable), best):
        pass
    return kept | {"platt": platt}


# ---------------------------------------------------------------- Spark

def remainder(doc_id: str, modulus: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % modulus


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        max_per_class: int = MAX_PER_CLASS) -> dict[str, np.ndarray] | None:
    """Train on the labelled documents that are not held out (remainder 2 of 4); None without both classes.

    The first ``max_per_class`` ids of a class in hash order are drawn, and of their distinct
    texts the first ``max_per_class`` in hash order of (id, text), so the broadcast
    keys and the collected texts are bounded by that parameter, whatever ids repeat.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & (remainder(doc_id, 4) != 2)).groupBy(
        F.col(doc_id).alias("_id")).agg(F.max(F.col(label)).cast("int").alias("_label"))
    known = known.join(docs.select(F.col(doc_id).alias("_id")).distinct(), "_id", "left_semi")
    counts = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return {"constant": np.array([1.0 if counts.get(1) else 0.0])}
    ids = [r for k in (0, 1) for r in known.where(F.col("_label") == k)
           .orderBy(F.xxhash64("_id"), "_id").limit(max_per_class).collect()]
    sample = spark.createDataFrame([(r["_id"], r["_label"]) for r in ids], known.schema)
    src = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).withColumn("_tie", F.xxhash64("_text"))
    key = ["_label", "_id", "_tie"]
    order = Window.partitionBy("_label").orderBy(F.xxhash64("_id", "_tie"), "_id", "_tie")
    texts = src.select("_id", "_tie").join(F.broadcast(sample), "_id").select(key).distinct()
    drawn = texts.withColumn("_turn", F.row_number().over(order)).where(F.col("_turn") <= max_per_class).select(key).collect()
    drawn = spark.createDataFrame(drawn, texts.schema)
    rows = src.join(F.broadcast(drawn), ["_id", "_tie"]).groupBy(key).agg(F.min("_text").alias("_text")).collect()
    rows.sort(key=lambda r: (r["_id"], r["_text"] or ""))
    model = train([r["_text"] or "" for r in rows], np.array([r["_label"] for r in rows]),
                  counts[1] / (counts[0] + counts[1]))
    del rows
    release()
    return model


def score_texts(p: dict[str, np.ndarray], text: pa.Array) -> np.ndarray:
    """Calibrated score of each whole text."""
    if "constant" in p:
        return np.full(len(text), p["constant"][0])
    words = split_words(text)
    logit = document_logits(p, words, word_inputs(words.uniques)).astype(np.float64)
    a, b = p["platt"]
    out = 1 / (1 + np.exp(-np.clip(a * np.where(np.isfinite(logit), logit, 0) + b, -30, 30)))
    return np.where(np.isfinite(logit), out, 0.0)


def score(docs: DataFrame, model: dict[str, np.ndarray], text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score per row (a column of that name is replaced); only ``text`` is read by the model."""
    prepare(docs.sparkSession)
    names = [c for c in docs.columns if c != out]
    src = docs.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType([*src.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score_texts(model, part.column(text)))],
                                                 names=[*part.schema.names, out])

    return src.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with ``score`` and ``predicted``."""
    prepare(docs.sparkSession)
    scored = score(docs, fit(docs, labels), out="score")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
