"""Scalar kernels and column expressions against the rule itself."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from pixloom.functions import answers as A
from pixloom.functions import denotation as N
from pixloom.functions import parsing as P
from pixloom.functions import scorers as S
from pixloom.functions import structures as X
from pixloom.functions import text as T


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double' if isinstance(v, float) else 'int'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def test_punctuation_and_articles(spark):
    cases = [
        ("Hello, world!", "hello world"), ("a-b", "b"), ("the 1,000 dogs.", "1000 dogs"), ("3.5 m. long", "3.5 m long"),
        ("None of ten", "0 of 10"), ("dont stop", "don't stop"), ("", ""), ("x; y;z", "x yz"),
    ]
    for text, want in cases:
        assert one(spark, A.normal_answer("t"), t=text) == want, text
    assert one(spark, A.normal_answer("t"), t=None) is None
    many = "a." * 40
    assert one(spark, A.no_punctuation("t"), t=many).count(".") == 8


def test_option_and_sequences(spark):
    letters = F.array(*[F.lit(c) for c in "ABCD"])
    for text, want in [("The answer is (B).", "B"), ("A or B", None), ("Z", "Z"), ("Failed to obtain answer via API", None), ("Cannot determine the answer", "Z"), ("", None), (None, None)]:
        assert one(spark, A.infer_option("t", letters), t=text) == want, text
    for text, want in [("BADC", "BADC"), ("first B, second A, third D, fourth C", "BADC"), ("AABC", None), ("Step 1: D step 2: C step 3: B step 4: A", "DCBA"), ("x", None)]:
        assert one(spark, A.infer_sequence("t"), t=text) == want, text
    for text, want in [("The best answer is C", "C"), ("b)", "B"), ("", "A"), ("no letter here at all but very many small words in it", "")]:
        assert one(spark, A.first_letter("t"), t=text) == want, text
    for text, want in [("yes", 1), ("No, yes", 0), ("yesterday", -1), ("YES no", 1)]:
        assert one(spark, A.first_of_two("t", "yes", "no"), t=text) == want, text


def test_numbers(spark):
    for text, want in [("twenty one", 20), ("I see 7 cats", 7), ("100", None), ("第5个", None), ("5", 5)]:
        assert one(spark, A.small_count("t"), t=text) == want, text
    for a, b, want in [("10", "10.4", True), ("10", "11", False), ("5%", "0.05", True), ("0", "0", True), ("Cat", "cat", True), ("1e3", "1000", True)]:
        assert one(spark, A.relaxed("p", "t"), p=a, t=b) is want, (a, b)


def test_parsing(spark):
    assert one(spark, P.last_boxed("t"), t=r"\boxed{1} then \boxed{x+2}") == "x+2"
    assert one(spark, P.last_boxed("t"), t="none") is None
    assert one(spark, P.tagged("t", "answer"), t="<answer>\n B </answer>") .strip() == "B"
    assert one(spark, P.seconds("t"), t="01:02:03") == 3723 and one(spark, P.seconds("t"), t="x") is None
    assert list(one(spark, P.list_string("t"), t="['a', 'b']")) == ["a", "b"]
    assert tuple(one(spark, P.score_pair("t"), t="8, 7\nbecause")) == (8.0, 7.0)
    assert tuple(one(spark, P.score_pair("t"), t="eight")) == (-1.0, -1.0)


def test_captions_and_prompts(spark):
    both = "<|native_caption_start|>a<|native_caption_end|><|recaption_start|>b\nc<|recaption_end|>"
    assert tuple(one(spark, T.captions("t"), t=both)) == ("a", "b\nc")
    assert tuple(one(spark, T.captions("t"), t="plain")) == ("plain", None)
    assert one(spark, T.expand_image("t", F.lit(2), 2), t="x <image> y <image>") == "x <img><ctx><ctx><ctx><ctx></img> y <image>"
    assert one(spark, T.fill("q: {a}!", a=F.col("t")), t=None) == "q: !"
    turns = F.array(F.struct(F.lit("user").alias("role"), F.col("t").alias("text")), F.struct(F.lit("bot").alias("role"), F.lit(None).cast("string").alias("text")))
    assert one(spark, T.turns_to_prompt(turns, "single", "sys"), t="hi") == "sys\nuser: hi\nbot:"
    want = {"rounds": "[Round 0]\nuser：hi\nbot：", "dolly": "user:\nhi\nbot:\n", "phoenix": "user: <s>hi</s>bot: <s>", "intern": "user:hi\n\nbot:", "mpt": "\nuserhi\nbot", "plain": "hi\n"}
    for style, text in want.items():
        assert one(spark, T.turns_to_prompt(turns, style), t="hi") == text, style
    assert one(spark, T.turns_to_prompt(turns, "inst", "s"), t="hi") == "[INST] <<SYS>>\ns\n<</SYS>>\n\nhi [/INST]"
    for style in (*T.STYLES, "chatml", "inst"):
        assert one(spark, T.turns_to_prompt(turns, style), t="hi") is not None
    masked = T.mask_labels(F.array(F.lit(2), F.lit(1)), F.array(F.lit(True), F.lit(False)))
    assert list(one(spark, masked, t="x")) == [-100, -100, 2]
    padded = one(spark, T.left_pad(F.array(F.lit(5), F.lit(6)), F.lit(4)), t="x")
    assert list(padded["ids"]) == [0, 0, 5, 6] and list(padded["mask"]) == [0, 0, 1, 1]


def test_damerau():
    assert X.damerau("ca", "abc") == 2 and X.damerau("abcd", "acbd") == 1 and X.damerau("", "ab") == 2
    assert X.near_text("international", "internatoinal") == pytest.approx(1 - 1 / 13)
    assert X.near_text("abc", "abd") == 0.0 and X.near_text("", "") == 1.0


def test_assignment_is_cheapest():
    rng = random.Random(3)
    for _ in range(60):
        n, m = rng.randrange(1, 5), rng.randrange(1, 5)
        cost = [[rng.randrange(20) for _ in range(m)] for _ in range(n)]
        got = X.assign(cost)
        assert sum(j >= 0 for j in got) == min(n, m)
        best = min(
            sum(cost[i][j] for i, j in zip(rows, cols)) for rows in itertools.combinations(range(n), min(n, m)) for cols in itertools.permutations(range(m), min(n, m))
        )
        assert sum(cost[i][j] for i, j in enumerate(got) if j >= 0) == best
    assert X.match_blocks(["abc", "zz"], ["zz"]) == [(0, -1, 1.0), (1, 0, 0.0)]
    assert X.match_blocks([], ["a"]) == [(-1, 0, 1.0)]


def test_table_similarity():
    a = "<table><tr><td>1</td><td>2</td></tr></table>"
    assert X.table_similarity(a, a) == 1.0
    assert X.table_similarity(a, a.replace("2", "3")) == pytest.approx(1 - 1 / 4)
    assert X.table_similarity(a, "<table><tr><td>1</td></tr></table>") == pytest.approx(1 - 1 / 4)
    assert X.table_similarity("", "") == 1.0


def test_flatten_and_f1():
    assert X.flatten({"a": {"b": [1, 2]}, "c": None}) == [("a.b", "1"), ("a.b", "2"), ("c", "")]
    assert X.pair_f1({"a": 1}, {"a": 1}) == pytest.approx(1, abs=1e-5)
    assert X.pair_f1({"a": 1}, {"a": 2}) == 0.0


def test_denotation():
    assert N.cell_value("1,234") == 1234.0 and N.cell_value("12%") == 12.0
    assert N.cell_value("2001-05-xx") == (2001, 5, None)
    assert N.normal_cell("“Café” [2]") == "cafe"
    assert N.same_denotation(["3", "a"], ["A", "3.0"]) and not N.same_denotation(["3"], ["3", "4"])
    assert N.verdict_words("That is true.") == "true" and N.verdict_words("true and false") is None


def test_formulas():
    assert N.math_equal(r"\frac{1}{2}", "0.5") and N.math_equal(r"\sqrt{16}", "4") and N.math_equal("2^3", "8")
    assert not N.math_equal("x+1", "y") and N.math_equal("x", "x")
    assert N.arithmetic("__import__('os')") is None and N.arithmetic("9**9**9**9") is None and N.arithmetic("1/0") is None


def test_windows_and_grams():
    s = N.window_scores("b c d".split(), "a b c x".split())
    assert s["p"] == s["r"] == pytest.approx(2 / 3)
    assert N.window_scores(["q"], ["a"])["f1"] == 0.0
    assert N.rouge_l("a b c".split(), "a b c".split()) == pytest.approx(1.0) and N.rouge_l([], ["a"]) == 0.0
    assert N.gleu("a b".split(), "a b".split()) == 1.0
    assert N.markdown_tables("x\n| a | b |\n|---|---|\n| 1 | 2 |\n\ny") == [[["a", "b"], ["1", "2"]]]


def test_puzzles():
    good = [[1, 2, 3, 4], [3, 4, 1, 2], [2, 1, 4, 3], [4, 3, 2, 1]]
    assert N.sudoku_ok(good, [[1, 0, 0, 0]] + [[0] * 4] * 3, (2, 2))
    assert not N.sudoku_ok(good, [[2, 0, 0, 0]] + [[0] * 4] * 3, (2, 2))
    assert N.nonogram_ok([[1, 1], [0, 1]], [[2], [1]], [[1], [2]])


def test_registry(spark):
    with pytest.raises(ValueError):
        S.register(S.SCORERS, "exact")(lambda p, t: p)
    df = spark.createDataFrame([("mcq", "B", "B"), ("vqa", "cats", "cat"), ("odd", "a", "a"), ("mcq", None, "A")], "task string, p string, t string")
    assert [r["score"] for r in S.score(df, "p", "t", "task").collect()] == [1.0, 0.75, None, 0.0]
    for name, fn in S.SCORERS.items():
        got = df.select(fn(F.col("p"), F.col("t")).alias("s")).collect()
        assert all(r["s"] is not None and 0 <= r["s"] <= 1 for r in got), name
