"""The pipeline's filtering and writing stages on planted documents, each on what the one before kept."""

import numpy as np

import corpus_pipeline
from barline.llm.text import written

STAGES = dict(corpus_pipeline.STAGES)


def test_stages_after_toxicity_on_planted_documents(spark, tmp_path):
    rng = np.random.default_rng(2)
    text = lambda n=120: [f"v{k}" for k in rng.integers(0, 3000, n)]
    item, base = text(30), text()
    rows = [(i, " ".join(text()), "en", f"s{i % 2}", 1) for i in range(20)]
    rows += [(100, " ".join(base), "en", "s0", 1), (101, " ".join(base), "en", "s1", 1), (102, " ".join(base[:-2] + ["x"]), "en", "s1", 1)]
    rows += [(200, " ".join(text(50) + item[5:25] + text(50)), "en", "s0", 1), (300, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    columns = docs.columns
    assert list(STAGES) == ["toxicity", "near_dedup", "decontaminate", "mixing", "token_blocks"]
    kept = written(STAGES["near_dedup"](spark, docs, str(tmp_path)), "t_near")
    assert kept.columns == columns and sorted(r["doc_id"] for r in kept.collect()) == [*range(20), 100, 200, 300]
    clean = written(STAGES["decontaminate"](spark, kept, str(tmp_path)), "t_clean")
    assert clean.columns == columns and sorted(r["doc_id"] for r in clean.collect()) == [*range(20), 100, 300]
    mixed = written(STAGES["mixing"](spark, clean, str(tmp_path)), "t_mixed")
    told = mixed.collect()
    assert mixed.columns == columns and {r["text"] for r in told} <= {r["text"] for r in clean.collect()} and len(told) >= 20
    out = STAGES["token_blocks"](spark, mixed, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(r["doc_id"] for r in told)
    at = 0
    for r in sorted(out, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
