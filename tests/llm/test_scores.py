"""Quality, language and language-model scores against plain versions and held-out texts."""

from __future__ import annotations

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edops.llm import bloom_lm, langid, quality
from llm_helpers import make, prose, words_of


def brute_quality(text):
    text = text or ""
    words = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    chars = sum(map(len, words))

    def windows(n):
        return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]

    count = collections.Counter(windows(3))
    repeated = {j for i, w in enumerate(windows(3)) if count[w] > 1 for j in range(i, i + 3)}
    out = {
        "n_words": len(words), "word_chars": chars, "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
    }
    for n in (2, 3, 4):
        count = collections.Counter(windows(n))
        out[f"top_{n}"] = min(1, max([k * sum(map(len, w)) for w, k in count.items() if k > 1], default=0) / max(chars, 1))
    for n in range(5, 11):
        seen, inside = set(), set()
        for i, w in enumerate(windows(n)):
            if w in seen:
                inside.update(range(i, i + n))
            seen.add(w)
        out[f"repeated_{n}"] = sum(len(words[i]) for i in inside) / max(chars, 1)
    seen, again = set(), 0
    for line in lines:
        again += sum(map(len, words_of(line))) if line in seen else 0
        seen.add(line)
    return out | {"line_char_share": again / max(chars, 1)}


def test_repetition_measures(spark, odd_rows):
    draw = random.Random(1)
    rows = [(r[0], r[1]) for r in odd_rows] + [
        (100 + i, "".join(draw.choices(["a ", "b ", "cc ", "\n", "é| ", "a b\n"], k=draw.randint(0, 90)))) for i in range(60)
    ]
    got = quality.repetition(make(spark, rows), keep=("doc_id", "text")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute_quality(r["row"]["text"])
        assert {k: r[k] for k in want} == pytest.approx(want)
        assert r["base_failed"] == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_clean_prose_is_kept_and_repetition_is_not(spark):
    rows = [(i, prose(i, 60 + 40 * i)) for i in range(20)]
    line = prose(99, 12)
    bad = [(100, "\n".join([prose(50, 40)] + [line] * 4)), (101, " ".join([prose(51, 15)] * 8))]
    kept = {r["row"]["doc_id"] for r in quality.repetition(make(spark, rows + bad)).filter("kept").collect()}
    assert kept == set(range(20))


def test_quality_keeps_columns_of_any_name(odd_docs):
    judged = quality.repetition(odd_docs, keep=tuple(odd_docs.columns)).select("row.*")
    assert judged.columns == odd_docs.columns and judged.count() == odd_docs.count()


SYLLABLES = {"en": ["th", "er", "on", "wh"], "de": ["sch", "ung", "keit", "ü"], "fr": ["eau", "oi", "é", "ment"]}


def speak(lang, seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 4))) for _ in range(n))


def test_languages_of_held_out_and_mixed_texts(spark):
    rows = [(i, speak(lang, i, 3 + i % 40), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    rows += [(500, None, "en"), (501, "123 *** !!", "de"), (502, "", "fr"), (503, "no label here th er", None)]
    rows += [(600, speak("en", 1, 30) + " " + speak("fr", 2, 70), "en"), (600, speak("fr", 2, 50), None)]
    learn = F.col("doc_id") % 4 != 1
    df = make(spark, rows)
    got = collections.defaultdict(list)
    for r in langid.identify(df, learn).collect():
        assert 0 <= r["score"] <= 1
        got[r["key"]].append((r["lang_pred"], r["score"]))
    assert sum(map(len, got.values())) == len(rows)
    held = [r for r in rows[:180] if r[0] % 4 == 1]
    assert sum(got[r[0]][0][0] == r[2] for r in held) >= 0.97 * len(held)
    for i in (500, 501, 502):
        assert got[i] == [("und", 0.0)]
    shares = sorted(s for lang, s in got[600] if lang == "fr")
    assert len(shares) == 2 and 0.6 < shares[0] < 0.8 and shares[1] > 0.95


def test_languages_with_nothing_to_learn(no_docs, odd_docs, odd_rows):
    assert langid.identify(no_docs, F.lit(True)).count() == 0
    found = langid.identify(odd_docs, F.lit(False)).collect()
    assert len(found) == len(odd_rows) and {(r["lang_pred"], r["score"]) for r in found} == {("und", 0.0)}
    assert len(langid.identify(odd_docs, F.lit(True)).collect()) == len(odd_rows)


def lower(text):
    return [w.translate({i: i + 32 for i in range(65, 91)}) for w in words_of(text)] + [None]


def brute_base(rows, learn):
    count = collections.Counter(t for r in rows if learn(r) for t in lower(r[1]))
    total, distinct = sum(count.values()), len(count)

    def of(text):
        tokens = lower(text)
        log = sum(math.log10((count[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        return len(tokens), sum(t in count for t in tokens), total, log

    return of


@pytest.mark.parametrize("model_bytes", [64 << 20, 1 << 12])
def test_base_scores_in_one_and_in_many_blocks(spark, odd_rows, model_bytes, monkeypatch):
    monkeypatch.setattr(bloom_lm.train, "__defaults__", (1 << 12,))
    rows = [(r[0], r[1]) for r in odd_rows] + [(100 + i, prose(i % 7, 40 + i)) for i in range(40)]
    got = bloom_lm.score(make(spark, rows), F.coalesce(F.col("doc_id") % 4 != 0, F.lit(True)), model_bytes=model_bytes)
    of = brute_base(rows, lambda r: r[0] is None or r[0] % 4 != 0)
    want = sorted((str(r[0]), *of(r[1])[:3], round(of(r[1])[3], 5)) for r in rows)
    found = got.collect()
    assert sorted((str(r["key"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in found) == want
    assert all(r["score"] < 0 for r in found)


def test_blocks_do_not_change_scores(spark, monkeypatch):
    monkeypatch.setattr(bloom_lm.train, "__defaults__", (1 << 12,))
    df = make(spark, [(i, prose(i % 9, 50 + i)) for i in range(60)])
    one, many = (
        {r["key"]: r["score"] for r in bloom_lm.score(df, F.col("doc_id") % 5 != 0, model_bytes=size).collect()}
        for size in (64 << 20, 1 << 12)
    )
    assert one == pytest.approx(many)


def test_pairs_make_held_out_texts_likelier(spark):
    """Texts of a fixed word order: the pair model must beat the word frequencies."""
    chain = prose(77, 60).split(" ")
    rows = [(i, " ".join(chain[i % 40 : i % 40 + 20])) for i in range(200)]
    got = bloom_lm.score(make(spark, rows), F.col("doc_id") % 10 != 0).filter("key % 10 = 0").collect()
    assert sum(r["score"] for r in got) > 0.5 * sum(r["base_score"] for r in got)


def test_filter_never_loses_and_seldom_invents():
    draw = np.random.default_rng(0)
    ngram, count = draw.integers(0, 1 << 63, 20_000, dtype=np.uint64), draw.geometric(0.3, 20_000)
    bits = bloom_lm.filter_bits(ngram, count)
    held = bloom_lm.Filters(bits, np.array([len(bits) * 8], np.uint64), np.zeros(1, np.int64))
    level = held.level(ngram, np.zeros(len(ngram), np.int64))
    true = 1 + np.floor(np.log2(count)).astype(int)
    assert (level >= true).all() and (level > true).mean() < 0.03
    other = draw.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert (held.level(other, np.zeros(len(other), np.int64)) > 0).mean() < 0.03


def test_model_without_documents(no_docs, odd_docs, odd_rows):
    assert bloom_lm.score(no_docs, F.lit(True)).count() == 0
    found = bloom_lm.score(odd_docs, F.lit(False)).collect()
    assert len(found) == len(odd_rows) and {(r["n_known"], r["train_tokens"]) for r in found} == {(0, 0)}


def tongue(seed, n, stems):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(stems) for _ in range(draw.randint(2, 4))) for _ in range(n))


STEMS = [["ba", "do", "gu"], ["wix", "zek", "quy"], ["shr", "thl", "mpf"], ["éla", "ùne", "çoi"], ["jju", "kko", "vva"], ["ñan", "rri", "lle"]]


@pytest.mark.parametrize("languages", [1, 2, 4, 6])
def test_shares_of_as_many_languages_as_a_text_has(languages):
    """All six are learned; a text in several equal parts gets its share, in whole languages."""
    counts = np.zeros((6, 1 << langid.BUCKET_BITS))
    for i, stems in enumerate(STEMS):
        bucket, _, _ = langid.trigrams(pa.array([tongue(i, 5000, stems)]))
        counts[i] += np.bincount(bucket, minlength=counts.shape[1])
    logs = np.log((counts + langid.SMOOTHING) / (counts.sum(axis=1, keepdims=True) + langid.SMOOTHING * counts.shape[1]))
    mixed = " ".join(tongue(50 + i, 300, STEMS[i]) for i in range(languages))
    lang, share = langid.detect(pa.array([mixed, tongue(99, 300, STEMS[5]), ""]), logs)
    assert lang[0] < languages and abs(share[0] - 1 / languages) < 0.03
    assert lang[1] == 5 and share[1] > 0.99 and lang[2] == -1


def test_a_text_above_the_slice_size(spark):
    from edops.llm.words import SLICE_BYTES

    long = " ".join(tongue(7, 200_000, STEMS[0]).split())
    assert len(long) > SLICE_BYTES
    rows = [(1, long, "x"), (2, tongue(8, 500, STEMS[1]), "y"), (3, tongue(9, 500, STEMS[0]), "x"), (4, long, None)]
    found = langid.identify(make(spark, rows), F.col("doc_id") < 4).collect()
    assert {r["key"]: r["lang_pred"] for r in found} == {1: "x", 2: "y", 3: "x", 4: "x"}
    judged = quality.repetition(make(spark, [(1, long)])).first()
    want = brute_quality(long)
    assert {k: judged[k] for k in want} == pytest.approx(want)


def test_blocks_of_the_model_are_cut_by_their_real_sizes(spark, monkeypatch):
    """A context that a third of all words follow makes its cells large; they are cut further."""
    monkeypatch.setattr(bloom_lm.train, "__defaults__", (1 << 12,))
    docs = [(i, " ".join(f"the w{i}x{j}" if j % 2 else f"u{i}y{j % 7}" for j in range(60))) for i in range(120)]
    model, bits = bloom_lm.train(spark.createDataFrame(docs, "doc_id long, text string").select("text"))
    assert bits >= 2 and model.count() == model.select("kind", "cell").distinct().count()
    size = 60_000
    parts = bloom_lm._parts(model, bits, size)
    # The parts tile the grid.
    cells = {(r, c) for rows, columns in parts for r in rows for c in columns}
    assert len(cells) == sum(len(rows) * len(columns) for rows, columns in parts) == 1 << 2 * bits
    assert len(parts) > 1
    for block, (rows, columns) in zip(bloom_lm._blocks(model, bits, size), parts):
        held = sum(a.nbytes for a in (block["words"], block["counts"], *block["contexts"], *block["pairs"]))
        assert held <= size or len(rows) * len(columns) == 1
    total, distinct = model.filter("kind = 0").selectExpr("sum(total)", "sum(entries)").first()
    tokens = [w for _, text in docs for w in text.split()] + ["</>"] * len(docs)
    assert (total, distinct) == (len(tokens), len(set(tokens)))


def test_passes_do_not_grow_with_the_model(spark, monkeypatch):
    """A model above ``model_bytes`` takes as many stored steps however large it is, and the same scores."""
    stored = []
    stage = bloom_lm.stage
    monkeypatch.setattr(bloom_lm, "stage", lambda df, name: stored.append(name) or stage(df, name))
    monkeypatch.setattr(bloom_lm.train, "__defaults__", (1 << 12,))
    monkeypatch.setattr(bloom_lm, "FLUSH", 700)  # several chunks in a task
    steps = {}
    for n in (40, 160):
        rows = [(i, f"{prose(i, 60)} Own{i} the the", "en") for i in range(n)] + [(None, None), (7, ""), (7, "")]
        df = make(spark, rows).repartition(3)
        learn = F.col("doc_id") % 5 != 0
        stored.clear()
        got = bloom_lm.score(df, learn, model_bytes=1 << 12).collect()
        steps[n] = list(stored)
        want = bloom_lm.score(df, learn).collect()
        names = ("n_tokens", "n_known", "train_tokens")
        assert sorted((str(r["key"]), *(r[c] for c in names)) for r in got) == sorted(
            (str(r["key"]), *(r[c] for c in names)) for r in want
        )
        for c in ("base_score", "score"):
            assert sorted(r[c] for r in got) == pytest.approx(sorted(r[c] for r in want))
    assert steps[40] == steps[160] and len(steps[40]) <= 3
