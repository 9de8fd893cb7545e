"""p4: edge cases of the pieces."""

from pixloom.llm import defects


def test_a_refusal_after_a_long_quotation():
    quoted = '"' + "x " * 3_000 + '"'
    assert defects.refuses(defects.plain(f"{quoted} I can't help with this picture."))
    assert not defects.refuses(defects.plain('The note says "I can\'t help you".'))


def test_empty_forms():
    for text in (None, "", " \n", "<p></p>", "​", "...", "<b> - </b>"):
        assert defects.is_empty(text), text
    for text in ("a", "1", "①", "Ａ", "一"):
        assert not defects.is_empty(text), text


def test_texts_of_a_batch_once(spark):
    rows = [("Q one?", "An answer.", "en"), ("Q one?", "An answer.", "eng"), ("Answer in German. Q?", "Eine Antwort.", "en"), (None, None, None), ("Q one?", None, "en")]
    df = spark.createDataFrame(rows, "question string, answer string, lang string")
    got = {(r["text"], r["lang"]): r["learn"] for r in df.mapInPandas(defects._texts, "text string, lang string, learn boolean").collect()}
    assert got[("Q one?", "en")] and got[("An answer.", "en")] and not got[("Eine Antwort.", "en")]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "field string, row_id long, question string, answer string, lang string")
    assert defects.find_defects(df).count() == 0
