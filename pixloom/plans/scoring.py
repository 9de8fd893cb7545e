"""Answer extraction and scoring over the predictions, captions and dialogues."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixloom.functions import answers as A
from pixloom.functions import parsing as P
from pixloom.functions import text as T
from pixloom.operators import reports as R
from pixloom.plans.registry import Registry
from pixloom.session import table

# one row per prediction: the last export
PRELUDE = """WITH p AS (SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY pred_id ORDER BY received_at DESC) = 1),
i AS (SELECT item_index, task, lang, option_a, option_b, option_c, option_d, l2_category FROM bench_items)"""
reg = Registry(PRELUDE)


def predictions(spark, sf, *cols):
    t = table(spark, sf, "predictions").select("pred_id", "received_at", *cols)
    return R.latest(t, ["pred_id"], "received_at").drop("received_at")


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _words_sql(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '[\\s\\v\\p{{Z}}]+'), lambda w: w <> '')"


def _strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


def _punct_sql(expr: str) -> str:
    """The punctuation step as nested replacements; the input must be a column."""
    out = expr
    for p in A.PUNCTUATION:
        q, a, b = _quote(p), _quote(p + " "), _quote(" " + p)
        cond = f"contains({expr}, {a}) OR contains({expr}, {b}) OR regexp_matches({expr}, '\\p{{Nd}},\\p{{Nd}}')"
        out = f"replace({out}, {q}, CASE WHEN {cond} THEN '' ELSE ' ' END)"
    out = f"regexp_replace(regexp_replace({out}, '(\\p{{Nd}})\\.', '\\1' || chr(1), 'g'), '\\.(\\p{{Nd}})', chr(1) || '\\1', 'g')"
    return f"replace(replace({out}, '.', ''), chr(1), '.')"


def _articles_sql(expr: str) -> str:
    to = {**A.CONTRACTIONS, **A.NUMBERS}
    table_sql = f"MAP {{{', '.join(f'{_quote(k)}: {_quote(v)}' for k, v in to.items())}}}"
    kept = f"list_filter({_words_sql(f'lower({expr})')}, lambda w: w NOT IN ('a', 'an', 'the'))"
    return f"array_to_string(list_transform({kept}, lambda w: coalesce({table_sql}[w], w)), ' ')"


_NORMAL = f"""n0 AS (SELECT pred_id, item_index, {_strip_sql("translate(prediction, chr(10) || chr(9), '  ')")} AS a, {_strip_sql("translate(answer, chr(10) || chr(9), '  ')")} AS b FROM p),
n1 AS (SELECT pred_id, item_index, {_punct_sql("a")} AS a, {_punct_sql("b")} AS b FROM n0),
n2 AS (SELECT pred_id, item_index, {_articles_sql("a")} AS a, {_articles_sql("b")} AS b FROM n1)"""


@reg.query("T11", f"WITH n0 AS (SELECT pred_id, prediction AS a FROM p) SELECT pred_id, {_punct_sql('a')} AS cleaned FROM n0")
def vqa_punctuation(spark, sf):
    return predictions(spark, sf, "prediction").select("pred_id", A.no_punctuation("prediction").alias("cleaned"))


@reg.query("T12 T13", f"WITH {_NORMAL} SELECT pred_id, a AS prediction_norm, b AS answer_norm FROM n2")
def process_answer(spark, sf):
    p = predictions(spark, sf, "prediction", "answer")
    return p.select("pred_id", A.normal_answer("prediction").alias("prediction_norm"), A.normal_answer("answer").alias("answer_norm"))


@reg.query("T14", f"""WITH {_NORMAL},
g AS (SELECT item_index, list(a ORDER BY pred_id) AS gts FROM n2 WHERE a IS NOT NULL GROUP BY item_index)
SELECT n2.pred_id, round(list_aggregate(list_transform(gts, lambda g: least(1.0::DOUBLE, (len(list_filter(gts, lambda o: o = n2.b)) - (g = n2.b)::INT) / 3)), 'sum') / len(gts), 6) AS score
FROM n2 JOIN g USING (item_index) WHERE n2.b IS NOT NULL""")
def vqa_soft(spark, sf):
    """Each exported answer against all predictions of its item as the given answers; the number of runs bounds a group."""
    p = predictions(spark, sf, "item_index", "prediction", "answer")
    n = p.select("pred_id", "item_index", A.normal_answer("prediction").alias("a"), A.normal_answer("answer").alias("b"))
    counts = n.filter("a IS NOT NULL").groupBy("item_index", "a").agg(F.count("*").alias("same"))
    total = counts.groupBy("item_index").agg(F.sum("same").alias("n"))
    b = n.filter("b IS NOT NULL").join(total, "item_index")
    hit = counts.select("item_index", F.col("a").alias("b"), "same")
    j = b.join(hit, ["item_index", "b"], "left").withColumn("s", F.coalesce("same", F.lit(0)))
    score = (F.col("s") * F.least(F.lit(1.0), (F.col("s") - 1) / 3) + (F.col("n") - F.col("s")) * F.least(F.lit(1.0), F.col("s") / 3)) / F.col("n")
    return j.select("pred_id", F.round(score, 6).alias("score"))


# the engine's own edit distance counts bytes: both texts are rewritten over the characters they share first
_DENSE = """d AS (SELECT *, list_distinct(string_split(a || b, '')) AS cs FROM c),
e AS (SELECT *, array_to_string(list_transform(string_split(a, ''), lambda x: chr(CAST(list_position(cs, x) AS INTEGER))), '') AS da,
  array_to_string(list_transform(string_split(b, ''), lambda x: chr(CAST(list_position(cs, x) AS INTEGER))), '') AS db FROM d),
l AS (SELECT *, CASE WHEN a = b THEN 0 WHEN a = '' THEN length(b) WHEN b = '' THEN length(a) ELSE levenshtein(da, db) END AS dist FROM e)"""
_ANLS = f"""c AS (SELECT pred_id, model, item_index, prediction, answer, array_to_string({_words_sql("lower(answer)")}, ' ') AS a,
  array_to_string({_words_sql("lower(prediction)")}, ' ') AS b FROM p WHERE answer IS NOT NULL AND prediction IS NOT NULL), {_DENSE},
s AS (SELECT *, CASE WHEN greatest(length(prediction), length(answer)) = 0 THEN 1.0 ELSE 1 - dist / greatest(length(prediction), length(answer)) END AS raw FROM l)"""


@reg.query("T15", f"WITH {_ANLS} SELECT pred_id, CAST(dist AS INTEGER) AS dist, round(CASE WHEN raw < 0.5 THEN 0 ELSE raw END, 6) AS anls FROM s")
def anls(spark, sf):
    p = predictions(spark, sf, "prediction", "answer").filter("prediction IS NOT NULL AND answer IS NOT NULL")
    return p.select("pred_id", F.levenshtein(A.collapsed("answer"), A.collapsed("prediction")).alias("dist"), F.round(A.anls("answer", "prediction"), 6).alias("anls"))


@reg.query("A56", f"""WITH {_ANLS},
w AS (SELECT model, CASE WHEN raw < 0.5 THEN 0 ELSE raw END AS anls, (b = a)::INT AS em, {_words_sql("b")} AS pw, {_words_sql("a")} AS tw FROM s),
m AS (SELECT *, CASE WHEN len(pw) > 0 THEN len(list_filter(pw, lambda x: list_contains(tw, x))) / len(pw) ELSE 0 END AS pr,
  CASE WHEN len(tw) > 0 THEN len(list_filter(tw, lambda x: list_contains(pw, x))) / len(tw) ELSE 0 END AS rc FROM w)
SELECT model, count(*) AS n, round(avg(anls), 6) AS anls, round(avg(em), 6) AS em, round(avg(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END), 6) AS f1 FROM m GROUP BY model""")
def anls_em_f1(spark, sf):
    p = predictions(spark, sf, "model", "prediction", "answer").filter("prediction IS NOT NULL AND answer IS NOT NULL")
    b = A.bag_prf(A.words(A.collapsed("prediction")), A.words(A.collapsed("answer")))
    s = p.select("model", A.anls("answer", "prediction").alias("anls"), (A.collapsed("prediction") == A.collapsed("answer")).cast("int").alias("em"), b["f1"].alias("f1"))
    return s.groupBy("model").agg(F.count("*").alias("n"), R.mean("anls").alias("anls"), R.mean("em").alias("em"), R.mean("f1").alias("f1"))


@reg.query("A28 M17", f"""WITH {_ANLS},
q AS (SELECT model AS page, lang AS attr, dist, greatest(length(a), length(b)) AS n FROM s JOIN i USING (item_index)),
g AS (SELECT page, attr, sum(dist) / sum(n) AS e FROM q GROUP BY ALL HAVING sum(n) > 0)
SELECT attr, count(*) AS pages, round(avg(e), 6) AS edit FROM g GROUP BY attr""")
def page_edit_distance(spark, sf):
    """Edit distances weighted by length within a page, then the mean of pages, by attribute."""
    p = predictions(spark, sf, "model", "item_index", "prediction", "answer").filter("prediction IS NOT NULL AND answer IS NOT NULL")
    a, b = A.collapsed("answer"), A.collapsed("prediction")
    q = p.join(table(spark, sf, "bench_items").select("item_index", "lang"), "item_index").select(
        "model", "lang", F.levenshtein(a, b).alias("dist"), F.greatest(F.length(a), F.length(b)).alias("n"))
    g = q.groupBy("model", "lang").agg(F.sum("dist").alias("d"), F.sum("n").alias("n")).filter("n > 0")
    return g.groupBy(F.col("lang").alias("attr")).agg(F.count("*").alias("pages"), F.round(F.avg(F.col("d") / F.col("n")), 6).alias("edit"))


_NUM = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _number_sql(x: str) -> str:
    body = f"regexp_replace({x}, '%+$', '')"
    return f"(CASE WHEN regexp_matches({body}, '{_NUM}') THEN CAST({body} AS DOUBLE) / CASE WHEN ends_with({x}, '%') THEN 100 ELSE 1 END END)"


@reg.query("T16", f"""WITH n AS (SELECT pred_id, {_strip_sql("prediction")} AS pr, answer AS gt FROM p),
m AS (SELECT *, {_number_sql("pr")} AS a, {_number_sql(_strip_sql("gt"))} AS b FROM n)
SELECT pred_id, coalesce(CASE WHEN a IS NOT NULL AND b IS NOT NULL AND a <> 0 THEN abs(a - b) / abs(a) <= 0.05 ELSE lower(pr) = lower(gt) END, false) AS by_prediction,
  coalesce(CASE WHEN a IS NOT NULL AND b IS NOT NULL AND b <> 0 THEN abs(a - b) / abs(b) <= 0.05 ELSE lower(pr) = lower(gt) END, false) AS by_target FROM m""")
def relaxed_acc(spark, sf):
    p = predictions(spark, sf, "prediction", "answer")
    return p.select("pred_id", *[F.coalesce(A.relaxed("prediction", "answer", denominator=d), F.lit(False)).alias(f"by_{d}") for d in ("prediction", "target")])


@reg.query("T17", f"SELECT pred_id, coalesce(lower({_strip_sql('prediction')}) = lower({_strip_sql('answer')}), false) AS hit FROM p")
def exact_acc(spark, sf):
    return predictions(spark, sf, "prediction", "answer").select("pred_id", F.coalesce(A.exact("prediction", "answer"), F.lit(False)).alias("hit"))


_OPTIONS = "list_filter(['A', 'B', 'C', 'D'], lambda x: (CASE x WHEN 'A' THEN option_a WHEN 'B' THEN option_b WHEN 'C' THEN option_c ELSE option_d END) IS NOT NULL)"


def _letters():
    pairs = [F.when(F.col(f"option_{c}").isNotNull(), c.upper()) for c in "abcd"]
    return F.array_compact(F.array(*pairs))


def options(letters="abcd"):
    """Map of the letters whose option is not null."""
    m = F.map_from_arrays(F.array(*[F.lit(c.upper()) for c in letters]), F.array(*[F.col(f"option_{c}") for c in letters]))
    return F.map_filter(m, lambda _, v: v.isNotNull())


def _with_items(spark, sf):
    p = predictions(spark, sf, "item_index", "prediction")
    return p.join(table(spark, sf, "bench_items").select("item_index", "task", "option_a", "option_b", "option_c", "option_d"), "item_index")


@reg.query("T18", f"""WITH w AS (SELECT p.pred_id, p.prediction, {_OPTIONS} AS letters, {_words_sql("translate(p.prediction, '.()[],:;!*#{}', '             ')")} AS ws
  FROM p JOIN i USING (item_index) WHERE task = 'mcq'), f AS (SELECT *, list_filter(letters, lambda l: list_contains(ws, l)) AS found FROM w)
SELECT pred_id, CASE WHEN contains(prediction, '{A.FAILED}') THEN NULL
  WHEN {" OR ".join(f"contains(prediction, {_quote(r)})" for r in A.REFUSED)} OR (len(found) = 0 AND list_contains(ws, 'Z')) THEN 'Z'
  WHEN len(found) = 1 THEN found[1] END AS option FROM f""")
def option_infer(spark, sf):
    return _with_items(spark, sf).filter("task = 'mcq'").select("pred_id", A.infer_option("prediction", _letters()).alias("option"))


@reg.query("T19 F10", f"""WITH f AS (SELECT p.pred_id, list_filter({_OPTIONS}, lambda x: contains(lower(p.prediction),
  lower(CASE x WHEN 'A' THEN option_a WHEN 'B' THEN option_b WHEN 'C' THEN option_c ELSE option_d END))) AS found FROM p JOIN i USING (item_index) WHERE task = 'mcq')
SELECT pred_id, CASE WHEN len(found) = 1 THEN found[1] END AS option FROM f""")
def option_text_infer(spark, sf):
    return _with_items(spark, sf).filter("task = 'mcq'").select("pred_id", A.infer_text("prediction", options()).alias("option"))


@reg.query("F10 F11 T35", f"""SELECT item_index, CASE WHEN len(o) > 0 THEN 'Options:' || chr(10) || array_to_string(list_transform(o, lambda x: x || '. ' ||
  (CASE x WHEN 'A' THEN option_a WHEN 'B' THEN option_b WHEN 'C' THEN option_c ELSE option_d END) || chr(10)), '') ELSE '' END AS option_text,
  coalesce('Hint: ' || hint || chr(10), '') || 'Question: ' || question || chr(10) ||
  CASE WHEN len(o) > 0 THEN 'Options:' || chr(10) || array_to_string(list_transform(o, lambda x: x || '. ' ||
  (CASE x WHEN 'A' THEN option_a WHEN 'B' THEN option_b WHEN 'C' THEN option_c ELSE option_d END) || chr(10)), '') || 'Please select the correct answer from the options above.' || chr(10) ELSE '' END AS prompt
FROM (SELECT *, {_OPTIONS} AS o FROM bench_items)""")
def option_prompt(spark, sf):
    """Option lines and the question prompt of every item."""
    m = options()
    lines = F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit(". "), e["value"], F.lit("\n"))), "")
    some = F.size(m) > 0
    opts = F.when(some, F.concat(F.lit("Options:\n"), lines)).otherwise("")
    hint = F.when(F.col("hint").isNotNull(), F.concat(F.lit("Hint: "), "hint", F.lit("\n"))).otherwise("")
    ask = F.when(some, "Please select the correct answer from the options above.\n").otherwise("")
    return table(spark, sf, "bench_items").select("item_index", opts.alias("option_text"), F.concat(hint, F.lit("Question: "), "question", F.lit("\n"), opts, ask).alias("prompt"))


_B, _E = r"(?:^|[^\p{L}\p{N}_])", r"(?:[^\p{L}\p{N}_]|$)"


@reg.query("T20", f"""WITH t AS (SELECT pred_id, upper(t) AS t FROM (SELECT pred_id, prediction AS t FROM p UNION ALL SELECT pred_id, 'First ' || left(answer, 1) || ', second B, 3rd ' || right(answer, 1) || ', fourth D; DCBA' || right(answer, 1) FROM p)),
x AS (SELECT pred_id, t, regexp_extract(t, '{_B}([A-D]{{4}}){_E}', 1) AS j,
  list_distinct([regexp_extract(t, '(?i)(?:first|1st|首先|第一步).*?([A-D])', 1), regexp_extract(t, '(?i)(?:second|2nd|其次|第二步).*?([A-D])', 1),
    regexp_extract(t, '(?i)(?:third|3rd|再次|第三步).*?([A-D])', 1), regexp_extract(t, '(?i)(?:fourth|4th|最后|第四步).*?([A-D])', 1)]) AS o,
  list_distinct(regexp_extract_all(t, '(?i)(?:step\\s*[\\d一二三四]+|步骤\\s*[\\d一二三四]+|第\\s*[\\d一二三四]\\s*步).*?([A-D])', 1)[:4]) AS s FROM t)
SELECT pred_id, count(*) AS texts, count(*) FILTER (j <> '' AND len(list_distinct(string_split(j, ''))) = 4) AS together,
  count(*) FILTER (NOT (j <> '' AND len(list_distinct(string_split(j, ''))) = 4) AND ((len(o) = 4 AND NOT list_contains(o, '')) OR len(s) = 4)) AS spelled FROM x GROUP BY pred_id""")
def sequence_infer(spark, sf):
    """Orders of four letters in the predictions and in a text that spells the order around the answer."""
    p = predictions(spark, sf, "prediction", "answer")
    spelled = F.concat(F.lit("First "), F.left("answer", F.lit(1)), F.lit(", second B, 3rd "), F.right("answer", F.lit(1)), F.lit(", fourth D; DCBA"), F.right("answer", F.lit(1)))
    t = p.select("pred_id", F.explode(F.array("prediction", spelled)).alias("t")).select("pred_id", F.upper("t").alias("t"))
    j = F.regexp_extract("t", A.BEFORE + "([A-D]{4})" + A.AFTER, 1)
    together = F.coalesce(F.size(F.array_distinct(F.filter(F.split(j, ""), lambda x: x != ""))) == 4, F.lit(False))
    return t.groupBy("pred_id").agg(
        F.count("*").alias("texts"), F.count_if(together).alias("together"), F.count_if(~together & A.infer_sequence("t").isNotNull()).alias("spelled"))


@reg.query("T21", f"""WITH n AS (SELECT pred_id, lower(prediction) AS a FROM p), w AS (SELECT pred_id, {_words_sql(_punct_sql("a"))} AS ws FROM n)
SELECT pred_id, CASE WHEN list_contains(ws, 'yes') AND NOT list_contains(ws, 'no') THEN 'Yes' WHEN list_contains(ws, 'no') AND NOT list_contains(ws, 'yes') THEN 'No' ELSE 'Unknown' END AS verdict FROM w""")
def yesno_extract(spark, sf):
    return predictions(spark, sf, "prediction").select("pred_id", A.yes_no("prediction").alias("verdict"))


def _prefix_sql(x: str) -> str:
    for s in A.PREFIXES:
        x = f"replace({x}, {_quote(s)}, '')"
    return x


@reg.query("T22", f"""WITH n AS (SELECT pred_id, {_prefix_sql(_strip_sql("prediction"))} AS s FROM p),
m AS (SELECT *, regexp_extract(s, '[ABCDE]') AS l, {_words_sql("s")} AS ws, list_filter(['(a)', '(b)', '(c)', '(d)', '(e)'], lambda o: contains(o, lower(s))) AS part FROM n)
SELECT pred_id, CASE WHEN l <> '' THEN l WHEN len(ws) > 10 THEN '' WHEN len(part) > 0 THEN upper(part[1][2]) ELSE '' END AS letter FROM m WHERE s IS NOT NULL""")
def letter_extract(spark, sf):
    p = predictions(spark, sf, "prediction").filter("prediction IS NOT NULL")
    return p.select("pred_id", A.first_letter("prediction").alias("letter"))


def _at_sql(word: str) -> str:
    return (f"CASE WHEN regexp_matches(t, '(?i){_B}{word}{_E}') THEN length(regexp_extract(t, '(?is)^(.*?)(^|[^\\p{{L}}\\p{{N}}_]){word}{_E}', 1)) + "
            f"length(regexp_extract(t, '(?is)^(.*?)(^|[^\\p{{L}}\\p{{N}}_]){word}{_E}', 2)) ELSE -1 END")


@reg.query("T23", f"""WITH t AS (SELECT pred_id, prediction AS t FROM p WHERE prediction IS NOT NULL),
x AS (SELECT pred_id, {_at_sql("yes")} AS y, {_at_sql("no")} AS n, {_at_sql("A")} AS a, {_at_sql("B")} AS b FROM t)
SELECT pred_id, CAST(CASE WHEN y < 0 AND n < 0 THEN -1 WHEN n < 0 THEN 1 WHEN y < 0 THEN 0 WHEN y < n THEN 1 ELSE 0 END AS INTEGER) AS yes_first,
  CAST(CASE WHEN a < 0 AND b < 0 THEN -1 WHEN b < 0 THEN 1 WHEN a < 0 THEN 0 WHEN a < b THEN 1 ELSE 0 END AS INTEGER) AS a_first FROM x""")
def word_precedence(spark, sf):
    p = predictions(spark, sf, "prediction").filter("prediction IS NOT NULL")
    return p.select("pred_id", A.first_of_two("prediction", "yes", "no").alias("yes_first"), A.first_of_two("prediction", "A", "B").alias("a_first"))


@reg.query("T24 A54", """
WITH t AS (SELECT pred_id, answer, 'So \\boxed{x} and \\boxed{' || translate(coalesce(prediction, ''), '{}', '') || '} <answer> ' || coalesce(prediction, '') || '</answer>' AS t FROM p),
x AS (SELECT pred_id, answer, regexp_extract_all(t, '\\\\boxed\\{([^{}]*)\\}', 1)[-1] AS boxed, regexp_extract_all(t, '\\{([^{}]*)\\}', 1)[-1] AS braced,
  trim(regexp_extract(t, '(?s)<answer>(.*?)</answer>', 1), ' ') AS tagged FROM t)
SELECT pred_id, boxed, tagged, coalesce(boxed = answer, false) AS exact, coalesce(contains(braced, answer), false) AS holds FROM x""")
def tagged_answer(spark, sf):
    """The last boxed or braced answer and the tagged one in a worked solution around the prediction."""
    p = predictions(spark, sf, "prediction", "answer")
    said = F.coalesce("prediction", F.lit(""))
    t = F.concat(F.lit("So \\boxed{x} and \\boxed{"), F.translate(said, "{}", ""), F.lit("} <answer> "), said, F.lit("</answer>"))
    x = p.select("pred_id", "answer", t.alias("t"))
    boxed = P.last_boxed("t")
    return x.select("pred_id", boxed.alias("boxed"), P.tagged("t", "answer").alias("tagged"), F.coalesce(boxed == F.col("answer"), F.lit(False)).alias("exact"),
        F.coalesce(F.contains(P.last_braced("t"), F.col("answer")), F.lit(False)).alias("holds"))


@reg.query("T25 M11", """
SELECT event_id, CAST(json_extract_string(regexp_extract('payload ' || props || ' end', '(\\{[^{}]*\\})', 1), '$.k') AS BIGINT) AS k FROM events""")
def json_in_text(spark, sf):
    """The first object in free text."""
    e = table(spark, sf, "events").select("event_id", F.concat(F.lit("payload "), "props", F.lit(" end")).alias("t"))
    return e.select("event_id", P.first_object("t", "k bigint")["k"].alias("k"))


@reg.query("T26", """
WITH t AS (SELECT o_orderkey, CAST(o_orderkey % 11 AS VARCHAR) || CASE WHEN o_orderkey % 3 = 0 THEN ', ' WHEN o_orderkey % 3 = 1 THEN ' ' ELSE ' to ' END || CAST(o_custkey % 11 AS VARCHAR)
   || chr(10) || '[Begin Correctness]' || CASE WHEN o_orderkey % 2 = 0 THEN ' yes ' ELSE ' no ' END || '[End Correctness]' AS t FROM orders),
x AS (SELECT o_orderkey, t, regexp_split_to_array(trim(translate(string_split(t, chr(10))[1], ',', ' ')), ' +') AS w FROM t)
SELECT o_orderkey, CASE WHEN len(w) = 2 THEN CAST(w[1] AS DOUBLE) ELSE -1.0::DOUBLE END AS a, CASE WHEN len(w) = 2 THEN CAST(w[2] AS DOUBLE) ELSE -1.0::DOUBLE END AS b,
  CASE WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE 'no' END AS verdict FROM x""")
def judgement_parse(spark, sf):
    """Score pairs and a tagged verdict in judgement texts composed from the orders."""
    k = F.col("o_orderkey")
    join = F.when(k % 3 == 0, ", ").when(k % 3 == 1, " ").otherwise(" to ")
    t = F.concat((k % 11).cast("string"), join, (F.col("o_custkey") % 11).cast("string"), F.lit("\n[Begin Correctness]"), F.when(k % 2 == 0, " yes ").otherwise(" no "), F.lit("[End Correctness]"))
    x = table(spark, sf, "orders").select("o_orderkey", t.alias("t"))
    return x.select("o_orderkey", P.score_pair("t")["a"].alias("a"), P.score_pair("t")["b"].alias("b"), P.section("t", "[Begin Correctness]", "[End Correctness]").alias("verdict"))


_COUNTS = "|".join(["[0-9]", "1[0-9]", "20", *A.COUNT_WORDS])
_COUNT_SQL = "CASE " + " ".join(f"WHEN c = '{w}' THEN {k}" for k, w in enumerate(A.COUNT_WORDS)) + " WHEN c <> '' THEN CAST(c AS INTEGER) END"


@reg.query("T27", f"""WITH x AS (SELECT pred_id, regexp_extract(lower(prediction), '{_B}({_COUNTS}){_E}', 1) AS c,
  len(regexp_extract_all(prediction, '[0-9]+')) AS numbers FROM p WHERE prediction IS NOT NULL)
SELECT pred_id, CAST(coalesce({_COUNT_SQL}, -1) AS INTEGER) AS n, CAST(numbers AS INTEGER) AS numbers FROM x""")
def text_to_int(spark, sf):
    p = predictions(spark, sf, "prediction").filter("prediction IS NOT NULL")
    return p.select("pred_id", F.coalesce(A.small_count("prediction"), F.lit(-1)).alias("n"), F.size(A.all_numbers("prediction")).alias("numbers"))


@reg.query("A41", """
WITH x AS (SELECT model, CAST(regexp_extract(answer, '[0-9]+') AS BIGINT) AS gt, regexp_extract_all(prediction, '[0-9]+') AS ns, length(answer) AS len
  FROM p WHERE regexp_matches(answer, '[0-9]')),
y AS (SELECT model, gt, CASE WHEN len(ns) = 1 THEN CAST(ns[1] AS BIGINT) END AS v, len FROM x),
s AS (SELECT model, CASE WHEN v IS NULL THEN 0 WHEN v = gt THEN 100 ELSE greatest(0, 100 * (1 - (4.0 / len) * pow(abs(v - gt) / greatest(gt - 1, len - gt, 1), 0.1))) END AS sc FROM y)
SELECT model, count(*) AS n, round(avg(sc), 5) AS score FROM s GROUP BY model""")
def counting_score(spark, sf):
    """Counting answers with a penalty that grows by a root of the relative error."""
    p = predictions(spark, sf, "model", "prediction", "answer").filter(F.col("answer").rlike("[0-9]"))
    gt = F.regexp_extract("answer", "[0-9]+", 0).cast("bigint")
    numbers = F.coalesce(A.all_numbers("prediction"), F.array().cast("array<bigint>"))
    s = p.select("model", A.counting_score(gt, numbers, F.length("answer")).alias("s"))
    return s.groupBy("model").agg(F.count("*").alias("n"), F.round(F.avg("s"), 5).alias("score"))


@reg.query("T34", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, CASE l_linenumber WHEN 1 THEN 'm' WHEN 2 THEN 'cm' WHEN 3 THEN 'ft' WHEN 4 THEN 'inches' WHEN 5 THEN 'mm' ELSE 'league' END AS u,
  l_quantity * CASE l_linenumber WHEN 1 THEN 100 WHEN 2 THEN 1 WHEN 3 THEN 30.48::DOUBLE WHEN 4 THEN 2.54::DOUBLE WHEN 5 THEN 0.1::DOUBLE ELSE 0 END AS cm FROM lineitem)
SELECT u AS unit, count(*) AS n, count(*) FILTER (greatest((cm + 1e-8) / (50 + 1e-8), (50 + 1e-8) / (cm + 1e-8)) < 2) AS within_2,
  count(*) FILTER (greatest((cm + 1e-8) / (50 + 1e-8), (50 + 1e-8) / (cm + 1e-8)) < 1.5) AS within_15 FROM x GROUP BY u""")
def distance_within(spark, sf):
    """Lengths in several units against half a metre, within a factor of 2 and of 1.5."""
    n = F.col("l_linenumber")
    unit = F.when(n == 1, "m").when(n == 2, "cm").when(n == 3, "ft").when(n == 4, "inches").when(n == 5, "mm").otherwise("league")
    x = table(spark, sf, "lineitem").select(unit.alias("unit"), A.centimetres(F.col("l_quantity"), unit).alias("cm"))
    hit = lambda f: F.count_if(A.within_factor(F.col("cm"), F.lit(50.0), f))
    return x.groupBy("unit").agg(F.count("*").alias("n"), hit(2).alias("within_2"), hit(1.5).alias("within_15"))


@reg.query("A27 T31", """
WITH t AS (SELECT pred_id, list_filter(string_split(lower(regexp_replace(replace(replace(prediction, '###', ''), '***', ''), '[\\s\\v\\p{Z}]+', ' ', 'g')), ' '), lambda x: x <> '') AS pw,
  list_filter(string_split(lower(regexp_replace(replace(replace(answer, '###', ''), '***', ''), '[\\s\\v\\p{Z}]+', ' ', 'g')), ' '), lambda x: x <> '') AS gw FROM p WHERE answer IS NOT NULL),
pc AS (SELECT pred_id, tok, count(*) AS c FROM (SELECT pred_id, unnest(pw) AS tok FROM t) GROUP BY ALL),
gc AS (SELECT pred_id, tok, count(*) AS c FROM (SELECT pred_id, unnest(gw) AS tok FROM t) GROUP BY ALL),
h AS (SELECT pred_id, sum(least(pc.c, gc.c)) AS h FROM pc JOIN gc USING (pred_id, tok) GROUP BY pred_id),
f AS (SELECT t.pred_id, coalesce(h.h, 0) AS h, coalesce(len(pw), 0) AS np, coalesce(len(gw), 0) AS ng FROM t LEFT JOIN h USING (pred_id)),
m AS (SELECT *, h / (ng + 1e-9) AS r, h / (np + 1e-9) AS pr FROM f)
SELECT count(*) AS files, round(avg(r), 6) AS macro_recall, round(avg(pr), 6) AS macro_precision, round(avg(2 * r * pr / (r + pr + 1e-9)), 6) AS macro_f1,
  round(sum(h) / (sum(ng) + 1e-9), 6) AS micro_recall, round(sum(h) / (sum(np) + 1e-9), 6) AS micro_precision FROM m""")
def token_prf(spark, sf):
    """Multiset overlap of recognised tokens, macro over files and micro; the overlap is counted inside the row."""
    p = predictions(spark, sf, "prediction", "answer").filter("answer IS NOT NULL")
    none = F.array().cast("array<string>")
    t = p.select(F.coalesce(T.ocr_tokens("prediction"), none).alias("pw"), T.ocr_tokens("answer").alias("gw"))
    count = lambda arr, w: F.size(F.filter(arr, lambda x: x == w))
    hits = F.aggregate(F.array_distinct("gw"), F.lit(0), lambda acc, w: acc + F.least(count(F.col("gw"), w), count(F.col("pw"), w)))
    f = t.select(hits.alias("h"), F.size("pw").alias("np"), F.size("gw").alias("ng"))
    f = f.withColumns({"r": F.col("h") / (F.col("ng") + 1e-9), "pr": F.col("h") / (F.col("np") + 1e-9)})
    return f.agg(
        F.count("*").alias("files"), R.mean("r").alias("macro_recall"), R.mean("pr").alias("macro_precision"),
        R.mean(F.expr("2 * r * pr / (r + pr + 1e-9D)")).alias("macro_f1"), F.round(F.sum("h") / (F.sum("ng") + 1e-9), 6).alias("micro_recall"),
        F.round(F.sum("h") / (F.sum("np") + 1e-9), 6).alias("micro_precision"))


@reg.query("T1", """
SELECT doc_id, coalesce(length(regexp_replace(text, '^[\\s\\v\\p{Z}]+|[\\s\\v\\p{Z}]+$', '', 'g')) - len(regexp_extract_all(text, '[，。！？“”‘’：；、【】《》\\s\\v\\p{Z},.!?"'':;\\[\\]<>]')), 0) AS n FROM documents""")
def alttext_stats(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.coalesce(T.alttext_length("text"), F.lit(0)).cast("bigint").alias("n"))


@reg.query("T4", """
WITH x AS (SELECT doc_id, text, regexp_matches(text, '(?s)^<\\|native_caption_start\\|>(.*)<\\|native_caption_end\\|><\\|recaption_start\\|>(.*)<\\|recaption_end\\|>$') AS b,
  regexp_matches(text, '(?s)^<\\|recaption_start\\|>(.*)<\\|recaption_end\\|>$') AS r, regexp_matches(text, '(?s)^<\\|native_caption_start\\|>(.*)<\\|native_caption_end\\|>$') AS n FROM documents)
SELECT doc_id, CASE WHEN b THEN regexp_extract(text, '(?s)^<\\|native_caption_start\\|>(.*)<\\|native_caption_end\\|><\\|recaption_start\\|>(.*)<\\|recaption_end\\|>$', 1)
   WHEN r THEN NULL WHEN n THEN regexp_extract(text, '(?s)^<\\|native_caption_start\\|>(.*)<\\|native_caption_end\\|>$', 1) ELSE text END AS native,
  CASE WHEN b THEN regexp_extract(text, '(?s)^<\\|native_caption_start\\|>(.*)<\\|native_caption_end\\|><\\|recaption_start\\|>(.*)<\\|recaption_end\\|>$', 2)
   WHEN r THEN regexp_extract(text, '(?s)^<\\|recaption_start\\|>(.*)<\\|recaption_end\\|>$', 1) END AS recaption FROM x""")
def caption_tags(spark, sf):
    c = T.captions("text")
    return table(spark, sf, "documents").select("doc_id", c["native"].alias("native"), c["recaption"].alias("recaption"))


@reg.query("T30 T32", """
WITH f AS (SELECT pred_id, regexp_matches(prediction, '[\\x{4e00}-\\x{9fff}]') AS chinese,
  array_to_string(list_transform(string_split(prediction, ''), lambda c: CASE WHEN c = '' THEN '' WHEN unicode(c) BETWEEN 65281 AND 65374 THEN chr(unicode(c) - 65248) WHEN c = '　' THEN ' ' ELSE c END), '') AS t FROM p WHERE prediction IS NOT NULL)
SELECT pred_id, chinese, regexp_replace(regexp_replace(t, '([\\x{4e00}-\\x{9fff}]) +', '\\1', 'g'), ' +([\\x{4e00}-\\x{9fff}])', '\\1', 'g') AS half FROM f""")
def half_width(spark, sf):
    p = predictions(spark, sf, "prediction").filter("prediction IS NOT NULL")
    return p.select("pred_id", T.has_chinese("prediction").alias("chinese"), T.half_width("prediction").alias("half"))


@reg.query("T33 A29", """
WITH d AS (SELECT source, text, len(list_filter(regexp_split_to_array(text, '\\n[ \\t]*\\n|\\n'), lambda x: trim(x, ' ') <> '')) AS paras,
   len(list_filter(regexp_split_to_array(text, '[.!?。！？]+'), lambda x: trim(x, ' ') <> '')) AS sents, len(list_filter(regexp_split_to_array(text, '[\\s\\v\\p{Z}]+'), lambda w: w <> '')) AS ws,
   len(regexp_extract_all(text, 'the')) AS kw, len(list_filter(regexp_extract_all(text, '[0-9]+\\.([0-9]+)', 1), lambda x: length(x) <> 2)) = 0 AS decimals FROM documents WHERE text IS NOT NULL),
c AS (SELECT unnest(['paragraphs', 'sentences', 'words', 'keyword', 'decimals', 'no_digits', 'begins', 'ends', 'lower']) AS tag,
   unnest([paras BETWEEN 1 AND 3, sents BETWEEN 2 AND 8, ws <= 60, kw >= 2, decimals, NOT regexp_matches(text, '[0-9]'), starts_with(text, 'The'), ends_with(text, '.'), lower(text) = text]) AS ok FROM d),
t AS (SELECT tag, count(*) AS n, count(*) FILTER (ok) AS h FROM c GROUP BY tag)
SELECT tag, n, round(h / n, 6) AS acc FROM t UNION ALL SELECT 'overall', CAST(sum(n) AS BIGINT), round(sum(h) / sum(n), 6) FROM t""")
def constraint_checks(spark, sf):
    """Verifiable instructions on the documents, the mean of each tag and the count-weighted mean."""
    t = F.col("text")
    checks = {
        "paragraphs": F.size(T.paragraphs("text")).between(1, 3), "sentences": F.size(T.sentences("text")).between(2, 8), "words": F.size(A.words("text")) <= 60,
        "keyword": F.regexp_count(t, F.lit("the")) >= 2, "decimals": T.decimals_ok("text", 2), "no_digits": ~t.rlike("[0-9]"), "begins": t.startswith("The"),
        "ends": t.endswith("."), "lower": F.lower(t) == t,
    }
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("tag"), v.cast("int").alias("ok")) for k, v in checks.items()])).alias("c")
    tags = table(spark, sf, "documents").filter("text IS NOT NULL").select(rows).groupBy("c.tag").agg(F.count("*").alias("n"), F.sum("c.ok").alias("h"))
    both = tags.withColumn("tag", F.explode(F.array("tag", F.lit("overall")))).groupBy("tag").agg(F.sum("n").alias("n"), F.sum("h").alias("h"))
    return both.select("tag", "n", R.ratio(F.col("h"), F.col("n")).alias("acc"))


@reg.query("S15 M13", """
WITH u AS (SELECT item_index, unnest([image_path, 'https://host.example/' || item_index || '.png', 'data:image/jpeg;base64,AAAA', question]) AS t FROM bench_items),
x AS (SELECT item_index, lower(t) AS t, t AS raw, regexp_extract(lower(t), '\\.([a-z0-9]{1,5})$', 1) AS s FROM u WHERE t IS NOT NULL)
SELECT item_index, md5(raw) AS digest, CASE WHEN starts_with(t, 'data:') THEN 'data' WHEN regexp_matches(t, '^https?://') THEN 'url' WHEN s <> '' THEN 'path' ELSE 'text' END AS kind,
  CASE WHEN starts_with(t, 'data:') THEN regexp_extract(t, '^data:([a-z]+/[a-z0-9.+-]+)', 1) WHEN s IN ('jpg', 'jpeg', 'png', 'gif', 'webp', 'pgm') THEN 'image/' || CASE s WHEN 'jpg' THEN 'jpeg' ELSE s END
   WHEN s = 'json' THEN 'application/json' WHEN s = 'txt' THEN 'text/plain' ELSE 'unknown' END AS media FROM x""")
def locator_sniff(spark, sf):
    """Kind and media type of stored strings, with their digest."""
    b = table(spark, sf, "bench_items")
    url = F.concat(F.lit("https://host.example/"), F.col("item_index").cast("string"), F.lit(".png"))
    u = b.select("item_index", F.explode(F.array("image_path", url, F.lit("data:image/jpeg;base64,AAAA"), "question")).alias("t")).filter("t IS NOT NULL")
    k = P.locator_kind("t")
    return u.select("item_index", F.md5("t").alias("digest"), k["kind"].alias("kind"), k["media"].alias("media"))


@reg.query("A36 M8", """
WITH t AS (SELECT pred_id, model, string_split(lower(prediction), ' ') AS c, string_split(lower(answer), ' ') AS r FROM p WHERE prediction IS NOT NULL AND answer IS NOT NULL),
g AS (SELECT pred_id, model, n, list_transform(range(1, greatest(len(c) - n + 2, 1)), lambda i: array_to_string(c[i:i + n - 1], ' ')) AS cg,
   list_transform(range(1, greatest(len(r) - n + 2, 1)), lambda i: array_to_string(r[i:i + n - 1], ' ')) AS rg FROM t, (SELECT unnest([1, 2, 3, 4]) AS n)),
cc AS (SELECT pred_id, model, n, x, count(*) AS k FROM (SELECT pred_id, model, n, unnest(cg) AS x FROM g) GROUP BY ALL),
rc AS (SELECT pred_id, n, x, count(*) AS k FROM (SELECT pred_id, n, unnest(rg) AS x FROM g) GROUP BY ALL),
m AS (SELECT cc.model, cc.n, sum(least(cc.k, coalesce(rc.k, 0))) AS hit, sum(cc.k) AS total FROM cc LEFT JOIN rc USING (pred_id, n, x) GROUP BY ALL),
l AS (SELECT model, sum(len(c)) AS cl, sum(len(r)) AS rl FROM t GROUP BY model)
SELECT m.model, CAST(m.n AS INTEGER) AS n, CAST(hit AS BIGINT) AS hit, CAST(total AS BIGINT) AS total,
  round(CASE WHEN cl > rl THEN 1 ELSE exp(1 - rl / cl) END * hit / total, 6) AS precision FROM m JOIN l USING (model)""")
def bleu_precisions(spark, sf):
    """Clipped n-gram precisions of order 1 to 4 times the brevity penalty, over the corpus of each model."""
    p = predictions(spark, sf, "model", "prediction", "answer").filter("prediction IS NOT NULL AND answer IS NOT NULL")
    t = p.select("model", F.split(F.lower("prediction"), " ").alias("c"), F.split(F.lower("answer"), " ").alias("r"))
    grams = lambda a, n: F.when(F.size(a) >= n, F.transform(F.sequence(F.lit(1), F.size(a) - n + 1), lambda i: F.array_join(F.slice(a, i, n), " "))).otherwise(F.array().cast("array<string>"))
    count = lambda arr, w: F.size(F.filter(arr, lambda x: x == w))
    rows = t.select("model", F.size("c").alias("cl"), F.size("r").alias("rl"), F.explode(F.array(*[
        F.struct(F.lit(n).alias("n"), grams(F.col("c"), n).alias("cg"), grams(F.col("r"), n).alias("rg")) for n in range(1, 5)])).alias("g"))
    hit = F.aggregate(F.array_distinct("g.cg"), F.lit(0), lambda acc, w: acc + F.least(count(F.col("g.cg"), w), count(F.col("g.rg"), w)))
    s = rows.select("model", "g.n", "cl", "rl", hit.alias("hit"), F.size("g.cg").alias("total"))
    m = s.groupBy("model", "n").agg(*[F.sum(c).alias(c) for c in ("cl", "rl", "hit", "total")]).filter("total > 0")
    brevity = F.when(F.col("cl") > F.col("rl"), 1.0).otherwise(F.exp(1 - F.col("rl") / F.col("cl")))
    return m.select("model", "n", "hit", "total", F.round(brevity * F.col("hit") / F.col("total"), 6).alias("precision"))


QUERIES, ORACLES = reg.queries, reg.oracles
