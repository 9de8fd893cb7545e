"""p3: one form for texts that look the same, and only for those."""

import pytest

from pixloom.llm import canonical, textforms


@pytest.mark.parametrize(
    "a, b",
    [("ＡＢＣ１２", "ABC12"), ("é", "é"), ("a​b", "ab"), ("a b", "a b"), ("a　b", "a b"), ("ﬁn", "fin"), ("﻿x", "x"), ("ｶﾞ", "ガ")],
)
def test_folding(a, b):
    assert textforms.fold(a) == textforms.fold(b)


@pytest.mark.parametrize("a, b", [("A", "a"), ("é", "e"), ("x²", "x2"), ("a  b", "a b"), ("a.", "a"), ("½", "1/2"), ("a-b", "a b")])
def test_what_stays_different(a, b):
    assert textforms.fold(a) != textforms.fold(b)


def test_rows(spark):
    rows = [
        (1, "оrange", "orange"),  # a Cyrillic letter in a Latin word
        (2, "Νо", "No"),  # Greek and Cyrillic letters, a Latin reading in the corpus
        (3, "ΑΒ", "AB"),  # one other script, as rare as the Latin word
        (4, "дом", "dom"),  # other letters: not the same
        (5, None, "x"), (6, "x", None), (7, "", ""), (8, "same", "same"), (9, "Ｂ", "B"), (10, "B", "b"), (1, "оrange", "orange"),
        (11, "оrange " * 4_000, "orange " * 4_000), (None, "ｘ", "x"),
    ]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "pred_id long, prediction string, answer string, _text string").drop("_text")
    out = canonical.canonicalize(df, ["prediction", "answer"]).collect()
    same = {r["pred_id"] for r in out if r["prediction"] != r["answer"] and r["prediction"] is not None and r["prediction_canonical"] == r["answer_canonical"]}
    assert same == {1, 2, 3, 9, 11, None}
    assert len(out) == len(rows)
    assert canonical.canonicalize(df.limit(0), ["prediction"]).count() == 0
