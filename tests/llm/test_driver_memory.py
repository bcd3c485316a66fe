"""What training takes of the driver's memory, and what it leaves there."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa

from barline.llm import toxicity
from barline.llm.text import split_words


def anonymous_mb():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nAnonymous:\s+(\d+)", f.read())[1]) / 1024


def random_words(n, seed=5):
    letters = np.random.default_rng(seed).integers(97, 123, (n, 12)).astype(np.uint8)
    return [bytes(x).decode() for x in letters]


def test_word_inputs_in_blocks_equal_those_of_all_words_at_once():
    uniques = pa.array(["", "a", "Ab", "(abc)", "naïve", "漢字漢字", *random_words(40)], pa.string())
    whole = toxicity.word_inputs(uniques, block=len(uniques))
    for block in (1, 7):
        part = toxicity.word_inputs(uniques, block=block)
        assert all((getattr(part, k) == getattr(whole, k)).all() for k in ("key", "n_chars", "chars"))
    assert len(toxicity.word_inputs(pa.array([], pa.string())).key) == 0


def test_word_inputs_take_little_more_than_their_result():
    uniques = split_words(pa.array([" ".join(random_words(60_000))])).uniques
    tracemalloc.start()
    x = toxicity.word_inputs(uniques)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * (x.key.nbytes + x.n_chars.nbytes + x.chars.nbytes)


def test_fit_leaves_no_freed_memory_in_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "some words here") for i in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, toxic int")

    def trained(texts, label, prior):
        """100 MB in small pieces, of which every hundredth lives on and keeps the C library from giving the others back."""
        parts = [np.ones(1000) for _ in range(13_000)]
        return {f"p{i}": x for i, x in enumerate(parts[::100])}

    monkeypatch.setattr(toxicity, "train", lambda texts, label, prior: {})
    toxicity.fit(docs, labels)
    before = anonymous_mb()
    monkeypatch.setattr(toxicity, "train", trained)
    model = toxicity.fit(docs, labels)
    assert len(model) == 130 and anonymous_mb() - before < 30
