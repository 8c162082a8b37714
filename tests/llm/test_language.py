"""Language profiles against a dense reference, and texts without letters."""

from __future__ import annotations

import numpy as np

from recogna.llm import language

TEXTS = ["The cat, the dog; 2½ Ⅷ cats!", "Über den Häusern", "a", "ab", "", "ÉTÉ été", "日本語 x", "one\ntwo\tthree", "x" * 3000, "ab12cd", "naïve—word"]


def bundle(text):
    """Every n-gram on its own: rotate, bind, add."""
    plain = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
    out = np.zeros(language.DIM)
    plain = f" {plain} " if plain else ""
    for a, b, c in zip(plain, plain[1:], plain[2:]):
        out += np.roll(language.letter(ord(a)), 2).astype(int) * np.roll(language.letter(ord(b)), 1) * language.letter(ord(c))
    return out / np.linalg.norm(out) if out.any() else out


def test_bundles_are_the_plain_ones():
    assert np.allclose(language.bundles(TEXTS), np.stack([bundle(t) for t in TEXTS]), atol=1e-5)


def test_predictions_are_the_nearest_prototypes(spark):
    rows = [(i, t, ("en", "de")[i % 2]) for i, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    sums = {lang: sum(np.rint(bundle(t).astype(np.float32).astype(float) * language.STEPS) for _, t, x in rows if x == lang) for lang in ("de", "en")}
    learnt = language.learn(docs)
    assert learnt.keys() == sums.keys()
    for lang, total in sums.items():
        assert np.allclose(learnt[lang], total / np.linalg.norm(total), atol=1e-4)
    for r in language.predict(docs, learnt).collect():
        cosines = {lang: bundle(r["text"]) @ v for lang, v in learnt.items()}
        if not bundle(r["text"]).any():
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert abs(r["score"] - max(0.0, cosines[r["lang_pred"]])) < 1e-4
            assert cosines[r["lang_pred"]] >= max(cosines.values()) - 1e-4


def test_numbers_are_no_letters(spark):
    texts = ["² ½", "Ⅷ", "12 34", "_ - …", "٣", "①②", None, ""]
    learnt = language.learn(spark.createDataFrame([("Haus und Hof", "de"), ("house and home", "en")], "text string, lang string"))
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {(r["lang_pred"], r["score"]) for r in language.predict(rows, learnt).collect()} == {("und", 0.0)}
