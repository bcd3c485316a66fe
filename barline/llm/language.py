"""Language identification: averaged hashed subword embeddings and a linear softmax (operator 7).

A text's vector is the mean embedding of the hashed byte n-grams of its words;
a linear softmax over it gives the languages.  Both are trained together in
numpy by stochastic gradient descent on a bounded sample: the ``MAX_TRAIN``
labelled documents with the smallest hash of their id, outside the held-out
fifth.  A quarter of the sample is kept back to fit a temperature, and the
rejection level is the probability below which that quarter's predictions are
mostly wrong.

Scoring needs only the product of the embeddings and the softmax, one row of
class scores per n-gram bucket.  Texts that are null or have no letter are
``und`` with score 0.  ``accepted`` is false where the calibrated probability is
under the rejection level.  Languages whose label is null are not learnt; with
no labelled document every text is ``und``.  Repeated rows each get a row; other
columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.text import Words, pieces, prepare, ragged, split_words, subword_ids
from barline.llm.toxicity import remainder

BUCKETS = 1 << 16
SIZES = (2, 3, 4)
EMBED = 16
MAX_TRAIN = 2000
UPDATES = 600
BATCH = 64
RATE = 0.5
UNKNOWN = "und"
LETTER = r"\p{L}"
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


@dataclass
class Grams:
    """n-gram buckets of the words of a batch, word by word, and the words of each text."""

    words: Words
    sizes: np.ndarray
    buckets: np.ndarray

    def sums(self, per_bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the buckets' rows over each text, and its number of n-grams."""
        ends = np.concatenate([[0], np.cumsum(self.sizes)])
        total = np.zeros((len(self.sizes), per_bucket.shape[1]))
        filled = np.flatnonzero(self.sizes)
        if len(filled):
            total[filled] = np.add.reduceat(per_bucket.take(self.buckets, axis=0), ends[filled], axis=0)
        return text_sums(total[self.words.codes], self.words.starts), \
            text_sums(self.sizes[self.words.codes][:, None].astype(float), self.words.starts)


def text_sums(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(starts) - 1, rows.shape[1]))
    filled = np.flatnonzero(np.diff(starts))
    if len(filled):
        out[filled] = np.add.reduceat(rows, starts[:-1][filled], axis=0)
    return out


def grams(text: pa.Array) -> Grams:
    words = split_words(text)
    owner, buckets = subword_ids(pc.utf8_trim(pc.utf8_lower(words.uniques), EDGE), SIZES, BUCKETS)
    order = np.argsort(owner, kind="stable")
    return Grams(words, np.bincount(owner, minlength=len(words.uniques)), buckets[order])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], langs: list[str], updates: int = UPDATES, seed: int = 11) -> dict:
    """Fit embeddings and softmax by SGD; then temperature and rejection level on every fourth text."""
    rng = np.random.default_rng(seed)
    names = sorted(set(langs))
    y = np.searchsorted(names, langs)
    g = grams(pa.array(texts, pa.string()))
    starts = np.cumsum(g.sizes) - g.sizes
    docs = []  # distinct buckets and counts of each text
    for i in range(len(texts)):
        codes = g.words.codes[g.words.starts[i]:g.words.starts[i + 1]]
        docs.append(np.unique(g.buckets[ragged(starts[codes], g.sizes[codes])], return_counts=True))
    spare = np.arange(len(texts)) % 4 == 3
    pool = np.flatnonzero(~spare & np.array([len(b) > 0 for b, _ in docs]))
    emb = rng.standard_normal((BUCKETS, EMBED)) / EMBED
    out, bias = np.zeros((EMBED, len(names))), np.zeros(len(names))
    for step in range(updates if len(pool) else 0):
        own = rng.choice(pool, min(BATCH, len(pool)), replace=False)
        size = np.array([len(docs[i][0]) for i in own])
        buckets = np.concatenate([docs[i][0] for i in own])
        weight = np.concatenate([docs[i][1] / docs[i][1].sum() for i in own])
        mean = np.add.reduceat(emb[buckets] * weight[:, None], np.cumsum(size) - size, axis=0)
        d = softmax(mean @ out + bias)
        d[np.arange(len(own)), y[own]] -= 1
        rate = RATE * (1 - step / updates) * EMBED
        d_mean = d @ out.T / len(own)
        out -= rate * (mean.T @ d) / len(own)
        bias -= rate * d.sum(axis=0) / len(own)
        moved = np.repeat(d_mean, size, axis=0) * weight[:, None]
        for k in range(EMBED):
            emb[:, k] -= rate * BATCH * np.bincount(buckets, moved[:, k], BUCKETS)
    model = {"names": names, "bias": bias, "table": (emb @ out).astype(np.float32), "temperature": 1.0, "reject": 0.0}
    check = np.flatnonzero(spare)
    if len(check):
        logits = class_logits(model, g)[check]
        grid = np.geomspace(0.1, 10, 60)
        loss = [-np.log(softmax(logits / t)[np.arange(len(check)), y[check]] + 1e-12).mean() for t in grid]
        model["temperature"] = float(grid[int(np.argmin(loss))])
        prob = softmax(logits / model["temperature"])
        top, right = prob.max(axis=1), prob.argmax(axis=1) == y[check]
        order = np.argsort(top)
        wrong = np.cumsum(~right[order]) * 2 > np.arange(1, len(order) + 1)
        model["reject"] = float(top[order][np.flatnonzero(wrong)[-1]]) if wrong.any() else 1.0 / len(names)
    return model


def class_logits(model: dict, g: Grams) -> np.ndarray:
    sums, counts = g.sums(model["table"])
    return sums / np.maximum(counts, 1) + model["bias"]


def predict(model: dict, text: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, calibrated probability and acceptance of each whole text."""
    n = len(text)
    lettered = pc.fill_null(pc.match_substring_regex(text, LETTER), False).to_numpy(zero_copy_only=False)
    if not model["names"]:
        return [UNKNOWN] * n, np.zeros(n), np.zeros(n, bool)
    prob = softmax(class_logits(model, grams(text)) / model["temperature"])
    top = np.where(lettered, prob.max(axis=1), 0.0)
    lang = [model["names"][k] if ok else UNKNOWN for k, ok in zip(prob.argmax(axis=1), lettered)]
    return lang, top, lettered & (top >= model["reject"])


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", max_train: int = MAX_TRAIN) -> dict:
    """Train on at most ``max_train`` labelled documents outside the held-out fifth.

    Languages take turns in hash order of (id, text), so each has its share however rare
    it is (with more languages than ``max_train``, some have none).  Rows of one id, text
    and language are one document.  Keys are ranked without texts; the broadcast keys and
    the collected texts are bounded by the parameter, whatever ids repeat.
    """
    src = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.col(lang).alias("_lang")).where(
        F.col("_lang").isNotNull() & F.col("_text").isNotNull() & F.col("_id").isNotNull() & (remainder("_id", 5) != 0))
    src = src.withColumn("_tie", F.xxhash64("_text"))
    key = ["_lang", "_id", "_tie"]
    # one row a document, and in each task at most max_train of a language, before the one sort by turns
    order = Window.partitionBy("_lang").orderBy(F.xxhash64("_id", "_tie"), "_id", "_tie")
    ranked = src.select(key).distinct().withColumn("_turn", F.row_number().over(order)).where(F.col("_turn") <= max_train)
    chosen = ranked.orderBy("_turn", "_lang").limit(max_train).select(key).collect()
    if not chosen:
        return {"names": []}
    chosen = docs.sparkSession.createDataFrame(chosen, src.select(key).schema)
    rows = src.join(F.broadcast(chosen), key).groupBy(key).agg(F.min("_text").alias("_text")).collect()
    rows.sort(key=lambda r: (r["_id"], r["_lang"], r["_text"]))
    return train([r["_text"] for r in rows], [r["_lang"] for r in rows])


def identify(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted``; only ``text`` is read by the model."""
    prepare(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "accepted")]
    src = docs.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType([*src.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                lang, top, ok = predict(model, part.column(text))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lang, pa.string()), pa.array(top, pa.float64()), pa.array(ok, pa.bool_())],
                    names=schema.names)

    return src.mapInArrow(run, schema)
