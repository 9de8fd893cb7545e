"""p9_found: the subject areas that a text is about."""

import itertools

import pandas as pd
from pyspark.sql import functions as F

from pixloom.llm import subjects
from pixloom.session import get_spark


def test_subjects_of_whole_texts(tmp_path):
    spark = get_spark(cores=2)
    animals = ["A grey heron near a hollow log.", "A lone lynx in deep snow.", "Two young otters dry their coat.", "A kingfisher feeds its young."]
    law = ["A witness statement is read aloud by the clerk.", "A summons on blue paper.", "The judge's bench is empty.", "The plaintiff asks for damages."]
    filler = "The light comes from the left. " * 40
    docs = [
        (1, " ".join(animals)),
        (2, filler + " ".join(animals + law[:3])),  # the second subject stands at the end of a long text
        (3, " ".join(animals) + " " + law[0]),  # a passing remark
        (4, " ".join(animals) + " The outline reminds one viewer of a witness statement."),
        (5, None), (6, " \n"), (7, "IMG 4711"), (8, "The light comes from the left."),
        (9, "画面中一只白鹭正在觅食。雪地里有一只猞猁。"), (10, "Ein Luchs im tiefen Schnee."),
        (11, " ".join(law)), (11, " ".join(law)),
    ]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "wildlife")], "doc_id bigint, subject string").write.parquet(f"{tmp_path}/subject_labels.parquet")
    spark.createDataFrame([(s, s) for s in subjects.SEEDS], "subject string, title string").write.parquet(f"{tmp_path}/subjects.parquet")
    got = sorted(tuple(r) for r in subjects.p9_found(spark, str(tmp_path)).collect())
    assert got == [(1, "wildlife"), (2, "law"), (2, "wildlife"), (3, "wildlife"), (4, "wildlife"), (9, "wildlife"), (10, "wildlife"), (11, "law")]


def test_thresholds_follow_the_ratings():
    names = ["food", "law"]
    counts = {f: {"law": 40.0} for f in subjects.features("the gavel")} | {f: {"food": 40.0} for f in subjects.features("a ladle")}
    model = subjects.Subjects(names, counts)
    model.calibrate([("The gavel.", "law")] * 5 + [("A ladle.", "food")] * 5)
    assert model.thresholds == dict.fromkeys(names, subjects.LEAST_SCORE)  # all thresholds do as well: the default
    top = model.scored("the gavel")[1]
    model.thresholds["law"] = top + 1
    assert model.text("The gavel.") == [] and model.text("A ladle.") == ["food"]
    model.calibrate([])
    assert set(model.thresholds.values()) == {subjects.LEAST_SCORE}


def _words():
    """Words that occur once, of no subject."""
    for n in itertools.count():
        yield "zq" + "".join("bcdfghjkmn"[int(d)] for d in str(n))


def _found(spark, texts):
    """p9 of (doc_id, text) of words that only the ratings give a subject, food and law by turns; those rated."""
    rated = [(i, ("food", "law")[k % 2]) for k, (i, _) in enumerate(texts)]
    got = subjects.document_subjects(
        spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(rated, "doc_id bigint, subject string"),
        spark.createDataFrame([("food",), ("law",)], "subject string"),
    )
    return sorted(tuple(r) for r in got.collect()), sorted(rated)


def test_rare_words_of_a_large_vocabulary_count():
    spark, words = get_spark(cores=2), _words()
    texts = [(i, " ".join(itertools.islice(words, 120 if i < 700 else 2))) for i in range(1000)]  # 168 000 features, each once
    got, rated = _found(spark, texts)
    assert got == rated  # three features, of which each is needed


def test_thresholds_follow_all_ratings():
    spark, words = get_spark(cores=2), _words()
    ids = [r["id"] for r in spark.range(3200).selectExpr("id").orderBy(F.xxhash64("id"), "id").collect()]
    texts = [(i, " ".join(itertools.islice(words, 6 if k < 3100 else 2))) for k, i in enumerate(ids)]
    got, rated = _found(spark, texts)
    assert got == rated  # only the last ones need a low threshold


def test_tables_give_what_the_model_on_one_machine_gives():
    spark = get_spark(cores=2)
    texts = ["A lynx in deep snow near a hollow log. A judge reads the verdict. Two otters!", "The hollow log of the heron.", "Reading the verdict aloud. It reminds one of a heron.", "...", "The judge's verdict. A soup. The soup."]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0])], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, "wildlife"), (2, "law"), (3, "law")], "doc_id bigint, subject string")
    names = sorted(subjects.SEEDS)
    rated = {1: "wildlife", 2: "law", 3: "law"}
    pairs = {tuple(r) for r in next(subjects._labelled([pd.DataFrame({"text": texts, "rated": [rated.get(i) for i in range(5)]})])).itertuples(index=False)}
    counts = {}
    for s, t in pairs:
        for f in subjects.features(subjects.no_numbers(t)):
            of = counts.setdefault(f, {})
            of[s] = of.get(s, 0.0) + 1
    model = subjects.Subjects(names, counts)
    model.calibrate([(texts[i], s) for i, s in rated.items()])
    want = sorted((i, s) for i, t in enumerate(texts) for s in model.text(t))
    got = subjects.document_subjects(docs, labels, spark.createDataFrame([(s,) for s in names], "subject string"))
    assert sorted(tuple(r) for r in got.collect()) == want and want
