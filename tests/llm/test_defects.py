"""p4_found: one row per defective pair of both tables, with its kind."""

import datetime as dt

import pytest

from pixloom.llm import defects
from pixloom.session import get_spark

PHRASES = {
    "en": ("What does a grey heron do in this picture?", "The photo shows a grey heron near a hollow log. A grey heron crosses a shallow stream on a rocky island."),
    "de": ("Was ist auf der nassen Wiese zu sehen?", "Zu sehen ist ein Graureiher auf der nassen Wiese. Ein Luchs sucht nach Futter im tiefen Schnee."),
    "es": ("¿Qué se ve en la orilla del estanque?", "En la foto, una garza gris espera en la orilla del estanque. Se ve un lince solitario en la nieve."),
    "zh": ("这张图里一只白鹭在做什么？", "画面中一只白鹭正在觅食。可以看到湿地草甸上有一只猞猁。"),
}


@pytest.fixture(scope="module")
def spark():
    return get_spark(cores=2)


def test_each_kind_from_both_tables(spark, tmp_path):
    en, zh = PHRASES["en"][0], PHRASES["zh"][0]
    cases = [  # question, answer, defect
        (en, None, "empty"), (en, "<p> ​</p>", "empty"), (en, "⽊⾨", "other_language"),
        (en, "The photo shows a grey heron near a hol", "truncated"), (en, "The photo shows a grey heron near a hollow log", None),
        (zh, "画面中一只白鹭正在觅食，并且在", "truncated"), (en, '{"caption": "A grey heron", "objects": ["', "truncated"), (en, "a grey heron", None),
        (en, "Unfortunately, I can't view images in this conversation.", "refusal"), (zh, "很遗憾，我无法查看这张图片。请换一个问题。", "refusal"),
        (en, "The man is unable to reach the upper shelf.", None), (en, "The note reads: I cannot come before noon.", None),
        (en, "You are asking: What does a grey heron do in this picture?", "copies_question"), (en, "does a grey heron do in this picture?", "copies_question"),
        (en, en + " A grey heron crosses a shallow stream.", None),
        (en, PHRASES["es"][1], "other_language"), (zh, PHRASES["de"][1], "other_language"), (en, "246 km", None), (en, "Ｂ", None),
        ("Answer in Spanish. " + en, PHRASES["es"][1], None),
    ]
    base = [(f"{q} {k}", f"{a} {k}.", lang) for lang, (q, a) in PHRASES.items() for k in range(9)]
    at = dt.datetime(2025, 1, 1)
    items = [(i, q, "en" if q.isascii() else "zh") for i, (q, _, _) in enumerate(cases)]
    preds = [(i, i, q, a, at) for i, (q, a, _) in enumerate(cases)]
    preds.append((*preds[0][:4], at + dt.timedelta(days=1)))  # exported twice
    qa = [(i, q, a, None) for i, (q, a, _) in enumerate(cases)] + [(1000 + i, q, a, lang) for i, (q, a, lang) in enumerate(base)]
    spark.createDataFrame(items, "item_index bigint, question string, lang string").write.parquet(f"{tmp_path}/bench_items.parquet")
    spark.createDataFrame(preds, "pred_id bigint, item_index bigint, question string, prediction string, received_at timestamp").write.parquet(f"{tmp_path}/predictions.parquet")
    spark.createDataFrame(qa, "qa_id bigint, question string, answer string, lang string").write.parquet(f"{tmp_path}/recaption_qa.parquet")
    got = sorted(tuple(r) for r in defects.p4_found(spark, str(tmp_path)).collect())
    assert got == sorted((f, i, d) for f in ("answer", "prediction") for i, (_, _, d) in enumerate(cases) if d)
