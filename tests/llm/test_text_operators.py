"""Operators on single texts and conversations: against plain Python on small and odd inputs."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barline.llm import chat_format, host_quality, language, token_blocks, toxicity
from barline.llm.queries import tokenizer_path
from barline.llm.text import hash_strings, rolling, split_words

ODD = ["", None, " ", "a", "a b\tc\nd\x0be\x0cf\rg", "é ü x 　y", "x" * 5000, "one two " * 400, "\n\na\n\na\n",
       "#*$ %&| <>", "漢字 テスト", "a's 'S 12½ don't <|endoftext|>"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, score string, _text string"


def docs_of(spark, texts, langs=None):
    rows = [(i, t, (langs or {}).get(i), "s%d" % (i % 3) if i % 4 else None, "clash", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def test_words_match_the_pattern():
    words = split_words(pa.array(ODD))
    for i, t in enumerate(ODD):
        own = words.codes[words.starts[i]:words.starts[i + 1]]
        assert [words.uniques[int(c)].as_py() for c in own] == WORD.findall(t or "")
    assert len(split_words(pa.array([], pa.string())).codes) == 0


def test_rolling_hash_depends_on_order_and_content_only():
    ids = hash_strings(pa.array(list("abcabcacb")))
    h = rolling(ids, 3)
    assert h[0] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 5


def plain_stats(t):
    t = t or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    rep = {p for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall("[#*$%&|<>]", t)),
            "n_dup_lines": dup, "n_repeat_words": len(rep)}


def test_statistics_match_plain_python():
    got = host_quality.text_stats(pa.array(ODD))
    for i, t in enumerate(ODD):
        assert {k: int(v[i]) for k, v in got.items()} == plain_stats(t)


def test_host_rate_drops_documents_of_a_bad_host_only(spark):
    good = " ".join("w%d" % i for i in range(30))
    rows = [(i, "bad " * 60 if i < 18 else good, "bad") for i in range(20)] + [(100 + i, good, None) for i in range(20)]
    rows += [(200 + i, good, "ok") for i in range(20)] + [(300, None, "ok"), (301, "", "ok"), (200, good, "ok")]
    got = host_quality.host_quality(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    rows_out = got.select("doc_id", "host", "base_failed", "kept").collect()
    assert len(rows_out) == len(rows)
    for r in rows_out:
        if r["doc_id"] in (300, 301):
            assert r["base_failed"] and not r["kept"]
        else:
            assert r["kept"] == (r["host"] != "bad")
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert host_quality.host_quality(empty).count() == 0


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 255, 256, 257, 3000):
        for high in (1, 2, 300, 49408, 2 ** 32):
            ids = rng.integers(0, high, n, dtype=np.uint64)
            ids[::50] = high - 1
            assert (token_blocks.decode_blocks(token_blocks.encode_blocks(ids)) == ids).all()


CONTROLS = ["<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|> é<|endoftext|>É", "it's<|endoftext|>'s", "x " * 50 + "<|endoftext|>\n1"]


@pytest.mark.parametrize("name, control_ids", [
    ("word_bpe_49k.json", True), ("word_bpe_49k.json", False), ("byte_bpe_50k.json", True), ("byte_bpe_50k.json", False)])
def test_token_files_hold_the_library_s_ids(spark, tmp_path, name, control_ids):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path(name))
    whole.encode_special_tokens = not control_ids
    texts = [*ODD, "Hello, World! abc123 ÉÀ ñ" * 3, "Σς ΑΣ. ſt İ", *CONTROLS]
    frame = docs_of(spark, texts).unionByName(docs_of(spark, texts[:2])).unionByName(
        spark.createDataFrame([(None, "no id", None, None, "", "")], DOCS))
    token_blocks.write_tokens(frame, str(tmp_path / "t"), tokenizer_path(name), control_ids=control_ids)
    rows = sorted(token_blocks.read_tokens(spark, str(tmp_path / "t")).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 0, 0, 1, 1, *range(2, len(texts))]
    at = 0
    for r in rows:
        text = "no id" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [2], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_chunks_are_encoded_in_bounded_memory(monkeypatch):
    """A batch of 12 MB of text is encoded a piece at a time, and known words are bounded: the arrays at hand stay small."""
    rng = np.random.default_rng(6)
    words = [f"{a}{b}" for a in ("be", "ka", "lo", "mi") for b in ("da", "ren", "sol")]
    texts = [" ".join(words[k] for k in rng.integers(0, len(words), 4000)) for _ in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(600), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    assert batch.nbytes > 11 << 20
    coder = token_blocks.PieceIds(tokenizer_path())
    at, peak = 0, 0
    tracemalloc.start()
    for chunk in token_blocks.token_chunks([batch], coder, 3):
        peak = max(peak, tracemalloc.get_traced_memory()[1])
        ids, sizes = token_blocks.decode_blocks(chunk.column("blocks")[0].as_py()), chunk.column("sizes")[0].as_py()
        own = chunk.column("doc_ids")[0].as_py()
        assert own == list(range(at, at + len(own))) and len(ids) == sum(sizes) == chunk.column("n_ids")[0].as_py()
        if not at:
            assert list(ids[:sizes[0]]) == [*coder.whole.encode(texts[0], add_special_tokens=False).ids, token_blocks.END_ID]
        at += len(own)
    tracemalloc.stop()
    assert at == 600 and peak < 40 << 20
    monkeypatch.setattr(token_blocks, "CACHE_PIECES", 1000)
    for k in range(5):
        token_blocks.encode_texts(pa.array([" ".join(f"{'abcdefgh'[j % 8]}{chr(97 + k)}{chr(97 + j // 26)}{chr(97 + j % 26)}" for j in range(600))]), coder, 2)
        assert len(coder.keys) <= 1000


def test_token_files_of_an_empty_table(spark, tmp_path):
    token_blocks.write_tokens(docs_of(spark, []), str(tmp_path / "t"), tokenizer_path())
    assert token_blocks.read_tokens(spark, str(tmp_path / "t")).count() == 0


def sentences(rng, words, n):
    return " ".join(rng.choice(words, n))


def test_network_gradient_matches_differences():
    p = toxicity.initial(3, seed=1)
    words = split_words(pa.array(["aa bb cc dd aa", "bb dd ee"]))
    x = toxicity.word_inputs(words.uniques)
    p["known"] = np.sort(x.key)[:3]
    rows = toxicity.word_rows(x.key, p["known"])
    _, first, size = toxicity.windows(words.counts, words.starts)
    steps, mask = toxicity.window_steps(words.codes, first, size)

    def loss():
        vec = toxicity.embed(p, x, rows)
        gates = {s: toxicity.gate_inputs(p, vec, s) for s in "fb"}
        z, cache = toxicity.forward(p, gates, steps, mask, keep=True)
        return float(z.astype(np.float64) @ [1.0, -0.5]), cache, vec

    _, cache, vec = loss()
    g = toxicity.gradient(p, x, rows, vec, steps, mask, cache, np.array([1.0, -0.5], np.float32))
    for name, at in (("out", 3), ("attend", 5), ("rec_reset_f", (1, 2)), ("rec_candidate_b", (0, 3)),
                     ("in_update_b", (2, 1)), ("bias_candidate_f", 4), ("word", (0, 2)), ("char", (int(x.chars[0]), 1))):
        old, h = p[name][at], 5e-3
        p[name][at] = old + h
        up = loss()[0]
        p[name][at] = old - h
        down = loss()[0]
        p[name][at] = old
        assert g[name][at] == pytest.approx((up - down) / (2 * h), abs=2e-3)


def test_every_word_lies_in_overlapping_windows():
    counts = np.array([0, 1, 64, 65, 200])
    starts = np.concatenate([[0], np.cumsum(counts)])
    owner, first, size = toxicity.windows(counts, starts)
    covered = {int(p) for f, s in zip(first, size) for p in range(f, f + s)}
    assert covered == set(range(starts[-1])) and 0 not in owner
    assert (first + size <= starts[owner + 1]).all()


def test_a_toxic_passage_is_learnt_wherever_a_long_text_has_it():
    """The passages lie where windows spread evenly over a text, 32 of them, leave gaps."""
    rng = np.random.default_rng(4)
    n, labels = 3000, np.arange(48) % 2
    _, first, size = toxicity.windows(np.array([n]), np.array([0, n]))
    spread = np.unique(np.linspace(0, len(first) - 1, 32).astype(np.int64))
    gaps = [(a + 64, b) for a, b in zip(first[spread[:-1]], first[spread[1:]]) if b - a - 64 >= 24]
    texts = []
    for toxic in labels:
        words = [f"plain{k}" for k in rng.integers(0, 300, n)]
        if toxic:
            a, _ = gaps[rng.integers(len(gaps))]
            words[a:a + 24] = [f"vile{k}" for k in rng.integers(0, 6, 24)]
        texts.append(" ".join(words))
    train = np.arange(48) < 36
    model = toxicity.train([x for x, own in zip(texts, train) if own], labels[train], 0.5, updates=100)
    told = toxicity.score_texts(model, pa.array([x for x, own in zip(texts, train) if not own])) >= 0.5
    assert (told == labels[~train]).mean() >= 0.9


def test_toxicity_on_held_out_texts(spark):
    rng = np.random.default_rng(0)
    clean = ["w%d" % i for i in range(300)]
    texts = [sentences(rng, clean, 60) for _ in range(360)]
    toxic = {i for i in range(360) if i % 3 == 0}
    for i in toxic:
        w = texts[i].split()
        for k in rng.choice(60, 3, replace=False):
            w[k] = "nasty%d" % rng.integers(0, 3)
        texts[i] = " ".join(w)
    docs = docs_of(spark, [*texts, "", None])
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in range(360)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == 362 and got[360]["score"] == got[361]["score"] == 0.0
    held = [i for i in range(360) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(got[i]["predicted"] == 1) == (i in toxic) for i in held]) >= 0.95
    one_class = toxicity.toxicity(docs, labels.where("toxic = 0"))
    assert one_class.agg(F.max("score")).first()[0] == 0.0


def test_language_on_held_out_texts_and_odd_ones(spark):
    rng = np.random.default_rng(0)
    made = {"aa": ["bona", "casa", "rosa", "lima"], "zz": ["strk", "grmpf", "krst", "vltn"]}
    texts, langs = [], {}
    for i in range(240):
        lang = "aa" if i % 2 else "zz"
        texts.append(sentences(rng, [w + c for w in made[lang] for c in "aeiou"], 25))
        langs[i] = lang
    texts += ["", None, "12 !?", "bonae casao"]
    docs = docs_of(spark, texts, langs)
    got = {r["doc_id"]: r for r in language.identify(docs, language.fit(docs)).collect()}
    assert all(got[i]["lang_pred"] == langs[i] for i in range(240))
    assert [got[240 + k]["lang_pred"] for k in range(4)] == ["und", "und", "und", "aa"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    nothing = language.identify(docs, language.fit(docs.withColumn("lang", F.lit(None).cast("string"))))
    assert {r["lang_pred"] for r in nothing.select("lang_pred").distinct().collect()} == {"und"}


def test_training_samples_are_bounded_in_rows_and_hold_rare_languages(spark, monkeypatch):
    """One id with thousands of texts, copies of one row, and a language of three documents among thousands."""
    rows = [(9, f"text {i} of one id", "aa") for i in range(3000)] + [(7, "copied", "aa")] * 500
    rows += [(100 + i, f"common {i}", "aa") for i in range(400)] + [(600 + i, f"rare {i}", "zz") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = {}
    monkeypatch.setattr(language, "train", lambda texts, langs: seen.update(texts=texts, langs=langs))
    language.fit(docs, max_train=50)
    assert len(seen["texts"]) == len(set(seen["texts"])) == 50
    learnable = sum(zlib.crc32(str(600 + i).encode()) % 5 != 0 for i in range(3))
    assert 0 < learnable == Counter(seen["langs"])["zz"]
    labels = spark.createDataFrame([(i, int(i < 100)) for i in (7, 9, *range(100, 500))], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "train", lambda texts, y, prior: seen.update(texts=texts, y=y))
    toxicity.fit(docs, labels, max_per_class=40)
    assert len(seen["texts"]) == len(set(seen["texts"])) <= 80 and max(Counter(seen["y"]).values()) <= 40
    assert set(seen["y"]) == {0, 1}


def test_trained_operators_on_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, labels).count() == 0
    assert language.identify(docs, language.fit(docs)).count() == 0


def test_chat_round_trip_and_loss_mask(spark):
    turns = [(1, 0, "system", "be [INST] nice </s>"), (1, 1, "user", None), (1, 2, "assistant", "a&amp;<s>\n[/INST] é"),
             (1, 3, None, "&lt;s> &#91;INST]"), (1, 4, "assistant", ""), (1, 5, "ro\nle", "x" * 600), (2, 0, "assistant", "<"),
             (2, 0, "assistant", "<"), (None, None, "user", "[")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    made = chat_format.format_events(chat_format.events_of_turns(frame))
    got = {r["conv_id"]: r for r in made.select(
        "conv_id", "formatted", "n_messages", chat_format.read_back(F.col("formatted")).alias("turns"),
        chat_format.masked_text(F.col("formatted"), F.col("loss_spans")).alias("masked")).collect()}
    for conv in (1, 2, None):
        want = [(r or "", t or "") for c, _, r, t in turns if c == conv]
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == want
        assert got[conv]["masked"] == "".join(t for r, t in want if r == "assistant")
    assert chat_format.format_events(chat_format.events_of_turns(frame.limit(0))).count() == 0


def test_chat_events_fold_deltas_edits_and_regenerations(spark):
    log = [(1, 0, 1, "delta", "user", "Hel"), (1, 0, 2, "delta", "user", "lo"), (1, 1, 3, "delta", "assistant", "bad"),
           (1, 2, 4, "delta", "user", "why?"), (1, 1, 5, "regenerate", "assistant", None), (1, 1, 6, "delta", "assistant", "go"),
           (1, 1, 7, "delta", "assistant", "od"), (1, 0, 8, "edit", "user", "Hi"), (1, 0, 9, "delta", "user", "!"),
           (1, 3, 10, "delta", "user", "thanks")]
    events = spark.createDataFrame(log, "conv_id long, message long, seq long, kind string, role string, text string")
    out = chat_format.format_events(events).first()
    assert out["formatted"] == "[INST]user\nHi![/INST]<s>good</s>[INST]user\nthanks[/INST]"
    assert out["n_messages"] == 3
    assert hashlib.sha256(b"").hexdigest()  # the digest of an empty mask is that of no bytes
