import random

import numpy as np
from helpers import docs_df

from tessera.llm import langid

SYLLABLES = {"xx": ["ka", "to", "mi", "ru"], "yy": ["schr", "ung", "eit", "ö"], "zz": ["eau", "que", "ié", "ou"]}


def corpus(rng, n):
    rows = []
    for k in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        text = " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(3, 60)))
        rows.append((k, text.capitalize() + ".", lang, "s", 1, "x"))
    return rows


def test_held_out_accuracy_and_edge_rows(spark):
    rng = random.Random(2)
    rows = corpus(rng, 400)
    rows += [(1000, None, "xx", "s", 0, "x"), (1001, "", "xx", "s", 0, "x"), (1002, "12 34 %% ..", "yy", "s", 0, "x"),
             (1003, "katomi ruka " * 20000, None, "s", 0, "x"), (None, "katomi ru", "xx", "s", 0, "x"),
             (1, rows[1][1], rows[1][2], "s", 0, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    out = langid.identify(df.repartition(3)).join(
        df.select("doc_id", langid.held_out().alias("h"), "lang"), "doc_id", "left").distinct().collect()
    held = [r for r in out if r.h and r.lang and r.doc_id < 1000]
    assert len(held) > 50 and np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    by = {r.doc_id: r for r in out}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (1000, 1001, 1002))
    assert by[1003].lang_pred == "xx" and 0 <= by[1003].score <= 1
    assert langid.identify(df).count() == len(rows)


def test_no_labels_and_empty_table(spark):
    assert langid.identify(docs_df(spark, [])).count() == 0
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify(df).collect()] == [("und", 0.0)]


def test_scores_equal_the_dense_model():
    """Batch scoring against a count vector times the matrix, text by text."""
    rng = np.random.default_rng(0)
    logp = np.hstack([rng.standard_normal((2, langid.BUCKETS)), np.zeros((2, 1))]).astype(np.float32)
    texts = ["Hello wörld", "", "a", "b" * 300, "7!"]
    pred, score = langid.score_texts(texts, ["p", "q"], logp)
    for k, t in enumerate(texts):
        for _, _, ids, _, letters in langid.ngram_stream([t]):
            counts = sum(np.bincount(g, minlength=langid.BUCKETS + 1) for g in ids)
            total = logp.astype(np.float64) @ counts
        if not letters[0]:
            assert pred[k] == "und"
            continue
        assert pred[k] == ["p", "q"][int(total.argmax())]
        assert abs(score[k] - 1 / np.exp(total - total.max()).sum()) < 1e-6


def test_slices_of_languages_equal_one_matrix(spark):
    """Three slices of one language against a single slice of three, rows without a letter and empty tables included."""
    rows = corpus(random.Random(5), 150) + [(900, None, "xx", "s", 0, "x"), (901, "12", "zz", "s", 0, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    whole = {r.doc_id: r for r in langid.identify(df).collect()}
    parts = {r.doc_id: r for r in langid.identify(df, slice_langs=1).collect()}
    assert whole.keys() == parts.keys()
    assert {r.lang_pred for r in whole.values()} == {"xx", "yy", "zz", "und"}
    for k, r in whole.items():
        assert parts[k].lang_pred == r.lang_pred and abs(parts[k].score - r.score) < 1e-3
    assert langid.identify(df.limit(0), slice_langs=1).collect() == []


def test_more_languages_than_a_slice_holds(spark):
    """300 label values, 44 of them in a second slice: each word's document gets its own label."""
    letters = "abcdefghijklmnopqrst"
    word = [letters[k // 20] + letters[k % 20] + letters[(7 * k + 3) % 20] for k in range(300)]
    rows = [(4 * k + c, f"{word[k]} {word[k]} {word[k]}", f"l{k:03d}") for k in range(300) for c in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(df).collect()
    taught = {r.lang for r in df.where(~langid.held_out()).collect()}
    asked = {r.doc_id: r.lang for r in df.collect() if r.lang in taught}
    assert len(taught) > 256 and np.mean([r.lang_pred == asked[r.doc_id] for r in got if r.doc_id in asked]) > 0.98


def test_merge_keeps_the_earlier_language_on_ties():
    one = (np.array(["a", None, "a", None], object), np.array([2.0, 0, -900.0, 0]), np.array([1.0, 0, 1.5, 0]))
    two = (np.array(["b", "b", "b", None], object), np.array([2.0, -5, 0.0, 0]), np.array([1.0, 1, 1.0, 0]))
    best, top, mass = langid.merged(one, two)
    assert best.tolist() == ["a", "b", "b", None] and top.tolist() == [2, -5, 0, 0] and mass.tolist() == [2, 1, 1, 0]
