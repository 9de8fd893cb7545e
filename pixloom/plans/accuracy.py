"""Accuracy reports over the scored predictions (one query for each kind of report)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixloom.operators import reports as R
from pixloom.plans.registry import Registry
from pixloom.plans.scored import SCORED, scored
from pixloom.session import table

reg = Registry(SCORED)


def N():
    return F.count("*").alias("n")


@reg.query("A1 O1", """
SELECT model, split, level, name, count(*) AS n, round(avg(hit), 6) AS acc FROM (
  SELECT model, split, 'Overall' AS level, 'Overall' AS name, hit FROM scored
  UNION ALL SELECT model, split, 'l2_category', l2_category, hit FROM scored
  UNION ALL SELECT model, split, 'category', category, hit FROM scored)
WHERE name IS NOT NULL GROUP BY ALL""")
def acc_report(spark, sf):
    """Mean hit by model and split, overall and by both category columns."""
    return R.by_levels(scored(spark, sf), ["model", "split"], ["l2_category", "category"], N(), R.mean("hit").alias("acc"))


@reg.query("A2", """
WITH b2 AS (SELECT model, split, l2_category, category, hit FROM scored
              UNION ALL SELECT model, 'ALL', l2_category, category, hit FROM scored),
cat AS (SELECT model, split, l2_category, category, avg(hit) AS m FROM b2
        WHERE l2_category IS NOT NULL AND category IS NOT NULL GROUP BY ALL)
SELECT model, split, 'l2_category' AS level, l2_category AS name, round(avg(m), 6) AS acc FROM cat GROUP BY ALL
UNION ALL
SELECT model, split, 'category', category, round(avg(hit), 6) FROM b2 WHERE category IS NOT NULL GROUP BY ALL
UNION ALL
SELECT model, split, 'Overall', 'Overall', round(avg(hit), 6) FROM b2 GROUP BY ALL""")
def acc_report_mmt(spark, sf):
    """As ``acc_report`` with a split ALL; the upper category is the unweighted mean of its categories."""
    s = scored(spark, sf).select("model", "split", "l2_category", "category", "hit")
    both = s.withColumn("split", F.explode(F.array("split", F.lit("ALL"))))
    cells = both.groupBy("model", "split", "l2_category", "category").agg(F.sum("hit").alias("h"), F.count("*").alias("c"))
    acc = F.round(F.sum("h") / F.sum("c"), 6).alias("acc")
    flat = R.by_levels(cells, ["model", "split"], ["category"], acc)
    per = cells.filter("l2_category IS NOT NULL AND category IS NOT NULL").withColumn("m", F.col("h") / F.col("c"))
    upper = per.groupBy("model", "split", "l2_category").agg(F.round(F.avg("m"), 6).alias("acc"))
    return flat.unionByName(upper.select("model", "split", F.lit("l2_category").alias("level"), F.col("l2_category").alias("name"), "acc"))


@reg.query("A3 U1", """
WITH cells AS (
  SELECT 'CATEGORY_' || category AS name, lang, hit FROM scored WHERE category IS NOT NULL
  UNION ALL SELECT task, lang, hit FROM scored UNION ALL SELECT 'Overall', lang, hit FROM scored),
p AS (SELECT name, coalesce(round(avg(hit) FILTER (lang = 'en'), 6), 0) AS en, coalesce(round(avg(hit) FILTER (lang = 'zh'), 6), 0) AS zh,
        coalesce(round(avg(hit) FILTER (lang = 'de'), 6), 0) AS de FROM cells GROUP BY name)
SELECT name, en, zh, de, round((en + zh + de) / 3, 6) AS avg FROM p""")
def acc_pivot(spark, sf):
    """Means by task and by category over a closed list of settings, missing cells 0, with the row mean."""
    s = scored(spark, sf)
    named = F.explode(F.array(F.col("task"), F.concat(F.lit("CATEGORY_"), "category"), F.lit("Overall"))).alias("name")
    p = R.pivot_means(s.select(named, "lang", "hit").filter("name IS NOT NULL"), ["name"], "lang", ["en", "zh", "de"], "hit", 0.0)
    return p.withColumn("avg", F.round((F.col("en") + F.col("zh") + F.col("de")) / 3, 6))


@reg.query("A4", """
SELECT model, coalesce(category, 'None') AS grp, count(*) AS n,
  CASE WHEN category IS NULL THEN NULL ELSE round(avg(hit), 6) END AS acc
FROM scored GROUP BY model, category""")
def group_accuracy(spark, sf):
    """By an arbitrary column; the group of nulls is called None and has no accuracy."""
    acc = F.when(F.col("category").isNotNull(), R.mean("hit")).alias("acc")
    return scored(spark, sf).groupBy("model", "category").agg(N(), acc).select("model", F.coalesce("category", F.lit("None")).alias("grp"), "n", "acc")


@reg.query("A5 A12 A46", """
SELECT m.model, m.macro, o.overall FROM
 (SELECT model, round(avg(a), 6) AS macro FROM (SELECT model, lang, avg(hit) AS a FROM scored WHERE lang IS NOT NULL GROUP BY ALL) GROUP BY model) m
 JOIN (SELECT model, round(avg(hit), 6) AS overall FROM scored GROUP BY model) o USING (model)""")
def source_macro(spark, sf):
    """Mean over sources of their means beside the plain mean, from one aggregate of (model, source)."""
    per = scored(spark, sf).groupBy("model", "lang").agg(F.sum("hit").alias("h"), F.count("*").alias("c"))
    return per.groupBy("model").agg(
        F.round(F.avg(F.when(F.col("lang").isNotNull(), F.col("h") / F.col("c"))), 6).alias("macro"),
        F.round(F.sum("h") / F.sum("c"), 6).alias("overall"),
    )


@reg.query("A6", """
WITH g AS (SELECT model, run_no, g_index, min(hit) AS hit, bool_or(rotation = 0) AS main, max(CASE WHEN rotation = 0 THEN category END) AS category
           FROM scored GROUP BY ALL)
SELECT model, level, name, count(*) AS n, round(avg(hit), 6) AS acc FROM (
  SELECT model, 'Overall' AS level, 'Overall' AS name, hit FROM g WHERE main
  UNION ALL SELECT model, 'category', category, hit FROM g WHERE main)
WHERE name IS NOT NULL GROUP BY ALL""")
def circular_acc(spark, sf):
    """A base item hits when every rotation of it does; reported on the base rows only."""
    main = F.col("rotation") == 0
    g = scored(spark, sf).groupBy("model", "run_no", "g_index").agg(
        F.min("hit").alias("hit"), F.bool_or(main).alias("main"), F.max(F.when(main, F.col("category"))).alias("category")
    )
    return R.by_levels(g.filter("main"), ["model"], ["category"], N(), R.mean("hit").alias("acc"))


@reg.query("A7", """
WITH k AS (SELECT *, g_index // 2 AS pair FROM scored)
SELECT 'circ' AS kind, model, count(*) AS n, round(avg(h), 6) AS acc FROM (SELECT model, g_index, min(hit) AS h FROM k GROUP BY ALL) GROUP BY model
UNION ALL SELECT 'flip', model, count(*), round(avg(h), 6) FROM (SELECT model, pair, rotation, min(hit) AS h FROM k GROUP BY ALL) GROUP BY model
UNION ALL SELECT 'flip_circ', model, count(*), round(avg(h), 6) FROM (SELECT model, pair, min(hit) AS h FROM k GROUP BY ALL) GROUP BY model""")
def flip_product(spark, sf):
    """Product of hits over three keys: rotations of an item, flipped neighbours, both; one pass of grouping sets."""
    s = scored(spark, sf).select("model", "hit", "rotation", "g_index", F.floor(F.col("g_index") / 2).alias("pair"))
    sets = [["model", "g_index"], ["model", "pair", "rotation"], ["model", "pair"]]
    g = s.groupingSets(sets, "model", "g_index", "pair", "rotation").agg(F.grouping_id().alias("gid"), F.min("hit").alias("h"))
    kind = F.when(F.col("gid") == 3, "circ").when(F.col("gid") == 4, "flip").otherwise("flip_circ").alias("kind")
    return g.groupBy(kind, "model").agg(N(), R.mean("h").alias("acc"))


@reg.query("A8 J8", """
WITH i AS (SELECT g_index, coalesce(category, 'None') AS category, rotation, max(hit) AS hit FROM scored WHERE model = 'vlm-alder-7b' GROUP BY ALL),
g AS (SELECT category, g_index, min(hit) AS lo, max(hit) AS hi, max(CASE WHEN rotation = 0 THEN hit END) AS r0, max(CASE WHEN rotation = 1 THEN hit END) AS r1
      FROM i GROUP BY ALL),
c AS (SELECT category, count(*) AS n, avg(lo) AS all_right, avg(1 - hi) AS all_wrong, avg(r0) AS rot0, avg(r1) AS rot1 FROM g GROUP BY category)
SELECT category, n, round(all_right, 6) AS all_right, round(all_wrong, 6) AS all_wrong, round(rot0, 6) AS rot0, round(rot1, 6) AS rot1 FROM c
UNION ALL SELECT 'Average', CAST(sum(n) AS BIGINT), round(avg(all_right), 3), round(avg(all_wrong), 3), round(avg(rot0), 3), round(avg(rot1), 3) FROM c""")
def rotational_eval(spark, sf):
    """Shares of items right (wrong) in every rotation, by category, and the average row; one model."""
    s = scored(spark, sf).filter("model = 'vlm-alder-7b'").withColumn("category", F.coalesce("category", F.lit("None")))

    def at(r):
        return F.max(F.when(F.col("rotation") == r, F.col("hit")))

    g = s.groupBy("category", "g_index").agg(F.lit(0).alias("x"), at(0).alias("r0"), at(1).alias("r1"), at(2).alias("r2"), at(3).alias("r3"))
    r = [F.col(f"r{k}") for k in range(4)]
    c = g.groupBy("category").agg(
        N(), F.avg(F.least(*r)).alias("all_right"), F.avg(1 - F.greatest(*r)).alias("all_wrong"), F.avg("r0").alias("rot0"), F.avg("r1").alias("rot1")
    )
    cells = ("all_right", "all_wrong", "rot0", "rot1")
    mean_row = c.agg(F.sum("n").alias("n"), *[F.round(F.avg(x), 3).alias(x) for x in cells]).select(F.lit("Average").alias("category"), "n", *cells)
    return c.select("category", "n", *[F.round(x, 6).alias(x) for x in cells]).unionByName(mean_row)


@reg.query("A9 W6", """
WITH r AS (SELECT category, image_path, hit, row_number() OVER (PARTITION BY category, image_path ORDER BY item_index, pred_id) AS k
           FROM scored WHERE category IS NOT NULL AND image_path IS NOT NULL),
plus AS (SELECT category, image_path, max(CASE WHEN k = 1 THEN hit END) * max(CASE WHEN k = 2 THEN hit END) AS plus FROM r GROUP BY ALL),
c AS (SELECT a.category, 100 * a.m + 100 * b.p AS score FROM (SELECT category, avg(hit) AS m FROM r GROUP BY ALL) a
      JOIN (SELECT category, avg(plus) AS p FROM plus GROUP BY ALL) b USING (category))
SELECT category AS name, round(score, 6) AS score FROM c
UNION ALL SELECT 'perception', round(sum(score) FILTER (category IN ('wildlife', 'food', 'sport', 'fine_art', 'fashion', 'architecture')), 6) FROM c
UNION ALL SELECT 'reasoning', round(sum(score) FILTER (category IN ('law', 'finance', 'science', 'software')), 6) FROM c""")
def mme_score(spark, sf):
    """100 x mean plus 100 x mean product of an image's first two answers; sums over two closed lists of categories."""
    s = scored(spark, sf).filter("category IS NOT NULL AND image_path IS NOT NULL")
    # the two first rows of an image by bounded aggregate state, no sort of the group
    first = F.expr("min_by(struct(hit, item_index, pred_id), struct(item_index, pred_id))")
    image = s.groupBy("category", "image_path").agg(
        first.alias("f"), F.expr("slice(array_sort(collect_list(struct(item_index, pred_id, hit))), 2, 1)").alias("s"),
        F.sum("hit").alias("h"), F.count("*").alias("c"),
    )
    plus = F.col("f.hit") * F.when(F.size("s") > 0, F.col("s")[0]["hit"])
    c = image.groupBy("category").agg((100 * F.sum("h") / F.sum("c") + 100 * F.avg(plus)).alias("score"))
    groups = {"perception": ["wildlife", "food", "sport", "fine_art", "fashion", "architecture"], "reasoning": ["law", "finance", "science", "software"]}
    sums = c.agg(*[F.round(F.sum(F.when(F.col("category").isin(v), F.col("score"))), 6).alias(k) for k, v in groups.items()])
    wide = sums.select(F.expr("stack(2, 'perception', perception, 'reasoning', reasoning) AS (name, score)"))
    return c.select(F.col("category").alias("name"), F.round("score", 6).alias("score")).unionByName(wide)


@reg.query("A10 F13", """
WITH y AS (SELECT model, category, split_part(l2_category, '/', 2) AS l2, image_path, g_index, (yes_truth = yes_guess)::INT AS ok FROM scored WHERE task = 'yorn'),
e AS (SELECT model, 'Overall' AS name, * EXCLUDE (model) FROM y UNION ALL SELECT model, category, * EXCLUDE (model) FROM y WHERE category IS NOT NULL
      UNION ALL SELECT model, l2, * EXCLUDE (model) FROM y WHERE l2 IS NOT NULL)
SELECT a.model, a.name, a.a_acc, f.f_acc, q.q_acc FROM
 (SELECT model, name, round(100 * avg(ok), 6) AS a_acc FROM e GROUP BY ALL) a
 JOIN (SELECT model, name, round(100 * avg(m), 6) AS f_acc FROM (SELECT model, name, category, l2, image_path, min(ok) AS m FROM e GROUP BY ALL) GROUP BY ALL) f USING (model, name)
 JOIN (SELECT model, name, round(100 * avg(m), 6) AS q_acc FROM (SELECT model, name, category, l2, g_index, min(ok) AS m FROM e GROUP BY ALL) GROUP BY ALL) q USING (model, name)""")
def hallusion(spark, sf):
    """Share of answers, of figures with all answers right and of questions with all answers right."""
    s = scored(spark, sf).filter("task = 'yorn'").select(
        "model", "category", F.split("l2_category", "/")[1].alias("l2"), "image_path", "g_index",
        (F.col("yes_truth") == F.col("yes_guess")).cast("int").alias("ok"),
    )
    e = s.withColumn("name", F.explode(F.array_compact(F.array(F.lit("Overall"), F.col("category"), F.col("l2")))))
    keys = ["model", "name", "category", "l2"]
    g = e.groupingSets([[*keys, "image_path"], [*keys, "g_index"]], *keys, "image_path", "g_index").agg(
        F.grouping_id().alias("gid"), F.min("ok").alias("m"), F.sum("ok").alias("h"), F.count("*").alias("c")
    )
    figure = F.col("gid") == 1
    return g.groupBy("model", "name").agg(
        F.round(100 * F.sum(F.when(figure, F.col("h"))) / F.sum(F.when(figure, F.col("c"))), 6).alias("a_acc"),
        F.round(100 * F.avg(F.when(figure, F.col("m"))), 6).alias("f_acc"),
        F.round(100 * F.avg(F.when(~figure, F.col("m"))), 6).alias("q_acc"),
    )


@reg.query("A11", """
WITH e AS (SELECT model, unnest(string_split(l2_category, '/')) AS name, yes_truth, yes_guess FROM scored WHERE task = 'yorn'),
a AS (SELECT model, name, yes_truth, yes_guess FROM e UNION ALL SELECT model, 'Overall', yes_truth, yes_guess FROM e),
c AS (SELECT model, name, count(*) FILTER (yes_truth AND yes_guess) AS tp, count(*) FILTER (NOT yes_truth AND yes_guess) AS fp,
        count(*) FILTER (yes_truth AND NOT yes_guess) AS fn, count(*) FILTER (NOT yes_truth AND NOT yes_guess) AS tn FROM a GROUP BY ALL)
SELECT model, name, tp, fp, fn, tn, round(CASE WHEN tp + fp > 0 THEN 100.0 * tp / (tp + fp) ELSE 0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN 100.0 * tp / (tp + fn) ELSE 0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 200.0 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1,
  round(100.0 * (tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM c""")
def pope_explode(spark, sf):
    """Precision, recall and F1 of yes; a row counts for each of its categories, Overall after the split."""
    s = scored(spark, sf).filter("task = 'yorn'").select("model", F.explode(F.split("l2_category", "/")).alias("name"), "yes_truth", "yes_guess")
    e = s.withColumn("name", F.explode(F.array("name", F.lit("Overall"))))
    return R.prf(e.groupBy("model", "name").agg(*R.confusion(F.col("yes_truth"), F.col("yes_guess"))), 100.0)


@reg.query("A12", """
WITH c AS (SELECT model, CASE WHEN category IN ('wildlife', 'food', 'fashion') THEN 'attribute' WHEN category IN ('law', 'finance') THEN 'relation' ELSE 'existence' END AS name,
  avg((yes_truth = yes_guess)::INT) AS a FROM scored WHERE task = 'yorn' GROUP BY ALL)
SELECT model, name, round(100 * a, 6) AS acc FROM c UNION ALL SELECT model, 'Avg ACC', round(100 * avg(a), 6) FROM c GROUP BY model""")
def amber(spark, sf):
    """Means of remapped categories and their unweighted mean."""
    to = F.when(F.col("category").isin("wildlife", "food", "fashion"), "attribute").when(F.col("category").isin("law", "finance"), "relation").otherwise("existence")
    c = scored(spark, sf).filter("task = 'yorn'").groupBy("model", to.alias("name")).agg(F.avg((F.col("yes_truth") == F.col("yes_guess")).cast("int")).alias("a"))
    named = c.withColumn("name", F.explode(F.array("name", F.lit("Avg ACC"))))
    return named.groupBy("model", "name").agg(F.round(100 * F.avg("a"), 6).alias("acc"))


@reg.query("A13", """
SELECT level, name, round(100 * avg(ok), 6) AS acc FROM (
  SELECT 'Overall' AS level, 'Overall' AS name, (yes_truth = yes_guess)::INT AS ok FROM scored WHERE task = 'yorn'
  UNION ALL SELECT 'category', category, (yes_truth = yes_guess)::INT FROM scored WHERE task = 'yorn'
  UNION ALL SELECT 'l2_category', l2_category, (yes_truth = yes_guess)::INT FROM scored WHERE task = 'yorn')
WHERE name IS NOT NULL GROUP BY ALL""")
def default_rating(spark, sf):
    s = scored(spark, sf).filter("task = 'yorn'").withColumn("ok", (F.col("yes_truth") == F.col("yes_guess")).cast("int"))
    return R.by_levels(s, [], ["category", "l2_category"], F.round(100 * F.avg("ok"), 6).alias("acc"))


_CAPS = ("mcq", "vqa", "yorn", "open", "coarse", "fine", "cross")


@reg.query("A14", """
WITH e AS (SELECT model, unnest(list_filter(['mcq', 'vqa', 'yorn', 'open', 'coarse', 'fine', 'cross'], lambda c: contains(l2_category, c))) AS name, hit FROM scored)
SELECT 'capability' AS kind, model, name, count(*) AS n, round(100 * avg(hit), 6) AS acc FROM e GROUP BY ALL
UNION ALL SELECT 'combination', model, l2_category, count(*), round(100 * avg(hit), 6) FROM scored WHERE l2_category IS NOT NULL GROUP BY ALL""")
def multi_capability(spark, sf):
    """By each capability named in the category and by the exact combination."""
    caps = F.filter(F.array(*[F.lit(c) for c in _CAPS]), lambda c: F.contains(F.col("l2_category"), c))
    one = F.transform(caps, lambda c: F.struct(F.lit("capability").alias("kind"), c.alias("name")))
    whole = F.array(F.struct(F.lit("combination").alias("kind"), F.col("l2_category").alias("name")))
    e = scored(spark, sf).filter("l2_category IS NOT NULL").select("model", "hit", F.explode(F.concat(one, whole)).alias("x"))
    return e.groupBy("x.kind", "model", "x.name").agg(N(), F.round(100 * F.avg("hit"), 6).alias("acc"))


@reg.query("A15 A48", """
WITH e AS (SELECT unnest(list_distinct(list_concat(string_split(l2_category, '/'), [task, 'Overall']))) AS skill, hit, prediction FROM scored)
SELECT skill, count(*) AS n, CAST(sum(hit) AS BIGINT) AS hits, count(prediction) AS answered, round(100 * avg(hit), 6) AS acc FROM e GROUP BY skill""")
def multilabel_skills(spark, sf):
    """Counts, hits and answered rows by each skill of a row, its task and Overall."""
    skills = F.array_union(F.coalesce(F.split("l2_category", "/"), F.array().cast("array<string>")), F.array(F.col("task"), F.lit("Overall")))
    e = scored(spark, sf).select(F.explode(skills).alias("skill"), "hit", "prediction")
    return e.groupBy("skill").agg(N(), F.sum("hit").alias("hits"), F.count("prediction").alias("answered"), F.round(100 * F.avg("hit"), 6).alias("acc"))


@reg.query("A17", """
WITH q AS (SELECT model, category, lang, item_index, avg(hit) AS a, min(hit) AS w FROM scored WHERE category IS NOT NULL GROUP BY ALL)
SELECT model, name, round(100 * avg(a), 6) AS average, round(100 * avg(w), 6) AS worst FROM (
  SELECT model, category AS name, a, w FROM q UNION ALL SELECT model, lang, a, w FROM q UNION ALL SELECT model, 'Overall', a, w FROM q)
WHERE name IS NOT NULL GROUP BY ALL""")
def worst_case(spark, sf):
    """A question's worst variant beside its mean, by subject and by level."""
    q = scored(spark, sf).filter("category IS NOT NULL").groupBy("model", "category", "lang", "item_index").agg(F.avg("hit").alias("a"), F.min("hit").alias("w"))
    e = q.select("model", F.explode(F.array_compact(F.array("category", "lang", F.lit("Overall")))).alias("name"), "a", "w")
    return e.groupBy("model", "name").agg(F.round(100 * F.avg("a"), 6).alias("average"), F.round(100 * F.avg("w"), 6).alias("worst"))


@reg.query("A18", """
WITH i AS (SELECT model, g_index, rotation, max(hit) AS hit FROM scored GROUP BY ALL),
p AS (SELECT model, g_index, max(CASE WHEN rotation = 0 THEN hit END) AS a, max(CASE WHEN rotation = 1 THEN hit END) AS b,
        max(CASE WHEN rotation = 2 THEN hit END) AS c, coalesce(max(CASE WHEN rotation = 3 THEN hit END), 0) AS d FROM i GROUP BY ALL)
SELECT model, count(*) AS groups, round(avg((a * b + c * d) / 2.0), 6) AS q_acc, round(avg((a * c + b * d) / 2.0), 6) AS i_acc,
  round(avg((a + b + c + d) / 4.0), 6) AS acc, round(avg(a * b * c * d), 6) AS g_acc FROM p
WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL GROUP BY model""")
def natural_bench(spark, sf):
    """2 x 2 items (two questions by two images): by question, by image, plain and by whole group; a missing last cell is wrong."""

    def at(r):
        return F.max(F.when(F.col("rotation") == r, F.col("hit")))

    p = scored(spark, sf).groupBy("model", "g_index").agg(at(0).alias("a"), at(1).alias("b"), at(2).alias("c"), F.coalesce(at(3), F.lit(0)).alias("d"))
    m = F.expr
    return p.filter("a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL").groupBy("model").agg(
        F.count("*").alias("groups"), F.round(F.avg(m("(a * b + c * d) / 2")), 6).alias("q_acc"), F.round(F.avg(m("(a * c + b * d) / 2")), 6).alias("i_acc"),
        F.round(F.avg(m("(a + b + c + d) / 4")), 6).alias("acc"), F.round(F.avg(m("a * b * c * d")), 6).alias("g_acc"),
    )


@reg.query("A19", """
WITH g AS (SELECT model, g_index, count(*) AS n, min(hit) AS h FROM scored GROUP BY ALL)
SELECT model, count(*) AS groups, round(avg(CASE WHEN n >= 2 AND h = 1 THEN 1 ELSE 0 END), 6) AS acc FROM g GROUP BY model""")
def tf_pair(spark, sf):
    """A group counts as right with at least two rows, all right; groups of one stay in the denominator."""
    g = R.all_correct(scored(spark, sf), ["model", "g_index"])
    return g.groupBy("model").agg(F.count("*").alias("groups"), R.share((F.col("n") >= 2) & (F.col("hit") == 1)).alias("acc"))


@reg.query("A20", """
WITH k AS (SELECT model, g_index, sum(hit) AS h, count(*) AS n FROM scored GROUP BY ALL)
SELECT model, count(*) FILTER (h >= 4) AS consistent, CAST(sum(n) AS BIGINT) AS n, round(count(*) FILTER (h >= 4) / (sum(n) / 4.0), 6) AS consistency FROM k GROUP BY model""")
def consistency(spark, sf):
    """Keys hit in all four conditions over a quarter of the rows."""
    k = scored(spark, sf).groupBy("model", "g_index").agg(F.sum("hit").alias("h"), F.count("*").alias("n"))
    return k.groupBy("model").agg(
        F.count_if(F.col("h") >= 4).alias("consistent"), F.sum("n").alias("n"), F.round(F.count_if(F.col("h") >= 4) / (F.sum("n") / 4), 6).alias("consistency")
    )


@reg.query("A21 J9 U4", """
WITH i AS (SELECT model, g_index, rotation, max(hit) AS hit FROM scored GROUP BY ALL),
p AS (SELECT model, g_index, max(CASE WHEN rotation = 0 THEN hit END) AS multi, max(CASE WHEN rotation = 1 THEN hit END) AS s1, max(CASE WHEN rotation = 2 THEN hit END) AS s2 FROM i GROUP BY ALL),
f AS (SELECT * FROM p WHERE multi IS NOT NULL AND s1 IS NOT NULL AND s2 IS NOT NULL),
c AS (SELECT model, mode, count(*) AS n,
   count(*) FILTER (multi = 0 AND s1 + s2 < 2) AS ik, count(*) FILTER (multi = 0 AND s1 + s2 = 2) AS ig,
   count(*) FILTER (multi = 1 AND s1 + s2 >= need) AS cm, count(*) FILTER (multi = 1 AND s1 + s2 < need) AS rm
   FROM f, (VALUES ('strict', 2), ('loose', 1)) AS m(mode, need) GROUP BY ALL)
SELECT model, mode, n, ik, ig, cm, rm, printf('%.2f%%', round(100.0 * ik / n, 2)) AS ik_rate, printf('%.2f%%', round(100.0 * ig / n, 2)) AS ig_rate,
  printf('%.2f%%', round(100.0 * cm / n, 2)) AS cm_rate, CASE WHEN cm + rm > 0 THEN printf('%.2f%%', round(100.0 * rm / (cm + rm), 2)) END AS rm_rate FROM c""")
def four_dimensions(spark, sf):
    """Steps against the composed question: insufficient knowledge, inadequate generalisation, mastery, rote memory."""

    def at(r):
        return F.max(F.when(F.col("rotation") == r, F.col("hit")))

    p = scored(spark, sf).groupBy("model", "g_index").agg(at(0).alias("multi"), at(1).alias("s1"), at(2).alias("s2"))
    modes = F.explode(F.array(F.struct(F.lit("strict").alias("mode"), F.lit(2).alias("need")), F.struct(F.lit("loose").alias("mode"), F.lit(1).alias("need")))).alias("m")
    f = p.filter("multi + s1 + s2 IS NOT NULL").select("*", modes)
    c = f.groupBy("model", F.col("m.mode").alias("mode")).agg(
        N(), F.expr("count_if(multi = 0 AND s1 + s2 < 2)").alias("ik"), F.expr("count_if(multi = 0 AND s1 + s2 = 2)").alias("ig"),
        F.expr("count_if(multi = 1 AND s1 + s2 >= m.need)").alias("cm"), F.expr("count_if(multi = 1 AND s1 + s2 < m.need)").alias("rm"),
    )

    def percent(a, b):
        return F.when(F.expr(f"{b} > 0"), F.format_string("%.2f%%", F.expr(f"round(100 * {a} / ({b}), 2)")))

    return c.withColumns({"ik_rate": percent("ik", "n"), "ig_rate": percent("ig", "n"), "cm_rate": percent("cm", "n"), "rm_rate": percent("rm", "cm + rm")})


@reg.query("A24", """
WITH b AS (SELECT split AS duration, category AS domain, split_part(l2_category, '/', 1) AS sub, task, hit FROM scored),
d AS (SELECT duration, domain, sub, task, hit FROM b UNION ALL SELECT 'overall', domain, sub, task, hit FROM b)
SELECT duration, level, name, printf('%.3f', round(avg(hit), 3)) AS score FROM (
  SELECT duration, 'overall' AS level, 'overall' AS name, hit FROM d UNION ALL SELECT duration, 'domain', domain, hit FROM d
  UNION ALL SELECT duration, 'sub', sub, hit FROM d UNION ALL SELECT duration, 'task', task, hit FROM d)
WHERE name IS NOT NULL GROUP BY ALL""")
def duration_cube(spark, sf):
    """By duration (and overall): domain, sub-category and task, three decimals as text."""
    b = scored(spark, sf).select(
        F.explode(F.array("split", F.lit("overall"))).alias("duration"), F.col("category").alias("domain"), F.split("l2_category", "/")[0].alias("sub"), "task", "hit"
    )
    text = F.format_string("%.3f", F.round(F.avg("hit"), 3)).alias("score")
    return R.by_levels(b, ["duration"], ["domain", "sub", "task"], text, overall="overall")


@reg.query("A25 A39", """
SELECT task || '. ' || coalesce(category, 'None') AS key, CAST(sum(hit) AS BIGINT) AS hits, count(*) AS n,
  printf('%.2f%%', round(100.0 * sum(hit) / count(*), 2)) AS acc FROM scored GROUP BY ALL
UNION ALL SELECT 'overall', CAST(sum(hit) AS BIGINT), count(*), printf('%.2f%%', round(100.0 * sum(hit) / count(*), 2)) FROM scored""")
def sum_count(spark, sf):
    """[sum, count] by dimension and task type with a percentage, and the micro total, from one aggregate."""
    key = F.concat("task", F.lit(". "), F.coalesce("category", F.lit("None")))
    c = scored(spark, sf).groupBy(key.alias("key")).agg(F.sum("hit").alias("hits"), N())
    both = c.withColumn("key", F.explode(F.array("key", F.lit("overall")))).groupBy("key").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))
    return both.withColumn("acc", F.format_string("%.2f%%", F.round(100 * F.col("hits") / F.col("n"), 2)))


@reg.query("A32", """
SELECT coalesce(task, 'Avg') AS task, coalesce(l2_category, 'Avg') AS subtask, coalesce(category, 'Avg') AS category, count(*) AS n, round(avg(hit), 6) AS acc
FROM scored WHERE task IS NOT NULL AND l2_category IS NOT NULL AND category IS NOT NULL GROUP BY ROLLUP (task, l2_category, category)""")
def rollup_nested(spark, sf):
    """Task, subtask and category, micro averages at each level."""
    s = scored(spark, sf).filter("task IS NOT NULL AND l2_category IS NOT NULL AND category IS NOT NULL")
    r = s.rollup("task", "l2_category", "category").agg(N(), R.mean("hit").alias("acc"))
    return r.select(*[F.coalesce(F.col(a), F.lit("Avg")).alias(b) for a, b in (("task", "task"), ("l2_category", "subtask"), ("category", "category"))], "n", "acc")


@reg.query("A33", """
SELECT model, count(*) FILTER (hit = 1 AND category IN ('law', 'finance')) AS text_recognition, count(*) FILTER (hit = 1 AND category IN ('science', 'medicine')) AS scene,
  count(*) FILTER (hit = 1 AND coalesce(category, '') NOT IN ('law', 'finance', 'science', 'medicine')) AS other, CAST(sum(hit) AS BIGINT) AS final_score, round(sum(hit) / 10.0, 6) AS norm_score
FROM scored GROUP BY model""")
def category_hits(spark, sf):
    """Hits by closed groups of categories, their sum and a tenth of it."""
    c, hit = F.coalesce("category", F.lit("")), F.col("hit") == 1
    a, b = c.isin("law", "finance"), c.isin("science", "medicine")
    return scored(spark, sf).groupBy("model").agg(
        F.count_if(hit & a).alias("text_recognition"), F.count_if(hit & b).alias("scene"), F.count_if(hit & ~a & ~b).alias("other"),
        F.sum("hit").alias("final_score"), F.round(F.sum("hit") / 10, 6).alias("norm_score"),
    )


@reg.query("A34", """
WITH e AS (SELECT rotation, unnest(['all', category]) AS name, hit FROM scored WHERE category IS NOT NULL),
c AS (SELECT rotation, name, avg(hit) AS a FROM e GROUP BY ALL), k AS (SELECT count(DISTINCT rotation) AS k FROM scored WHERE category IS NOT NULL)
SELECT CAST(rotation AS VARCHAR) AS cycle, name, round(a, 6) AS acc FROM c
UNION ALL SELECT 'Average', name, round(sum(a) / any_value(k), 6) FROM c, k GROUP BY name""")
def cycles(spark, sf):
    """By cycle, and the average over the number of cycles even where a category is missing in one."""
    s = scored(spark, sf).filter("category IS NOT NULL")
    c = s.select("rotation", F.explode(F.array(F.lit("all"), F.col("category"))).alias("name"), "hit").groupBy("rotation", "name").agg(F.avg("hit").alias("a"))
    k = c.agg(F.count_distinct("rotation").alias("k"))  # one row
    mean = c.join(F.broadcast(k), F.lit(True)).groupBy("name").agg(F.round(F.sum("a") / F.first("k"), 6).alias("acc")).select(F.lit("Average").alias("cycle"), "name", "acc")
    return c.select(F.col("rotation").cast("string").alias("cycle"), "name", F.round("a", 6).alias("acc")).unionByName(mean)


@reg.query("A35", """
WITH c AS (SELECT model, category, avg(hit) AS a FROM scored WHERE category IS NOT NULL GROUP BY ALL),
g(category, grp) AS (VALUES ('wildlife', 'General'), ('food', 'General'), ('sport', 'General'), ('science', 'Reasoning'), ('law', 'Reasoning'), ('finance', 'Doc'), ('software', 'Doc'))
SELECT model, grp, round(100 * avg(a), 2) AS acc FROM c JOIN g USING (category) GROUP BY ALL
UNION ALL SELECT model, 'Overall', round(100 * avg(a), 2) FROM c GROUP BY model""")
def macro_groups(spark, sf):
    """Category means, then unweighted means of fixed groups of categories."""
    groups = {"General": ["wildlife", "food", "sport"], "Reasoning": ["science", "law"], "Doc": ["finance", "software"]}
    of = F.lit(None).cast("string")
    for g, cs in groups.items():
        of = F.when(F.col("category").isin(cs), g).otherwise(of)
    c = scored(spark, sf).filter("category IS NOT NULL").groupBy("model", "category").agg(F.avg("hit").alias("a"))
    return c.select("model", F.explode(F.array_compact(F.array(of, F.lit("Overall")))).alias("grp"), "a").groupBy("model", "grp").agg(F.round(100 * F.avg("a"), 2).alias("acc"))


@reg.query("A42 J14", """
WITH m AS (SELECT DISTINCT model FROM predictions), t AS (SELECT unnest(['mcq', 'vqa', 'yorn', 'open', 'video']) AS task),
s AS (SELECT model, task, round(avg(hit), 6) AS acc FROM scored GROUP BY ALL)
SELECT m.model, t.task, s.acc FROM m CROSS JOIN t LEFT JOIN s ON s.model = m.model AND s.task = t.task""")
def leaderboard_cells(spark, sf):
    """Every model by a closed list of benchmarks, null where a result is missing."""
    tasks = ["mcq", "vqa", "yorn", "open", "video"]
    p = scored(spark, sf).groupBy("model").agg(*[F.round(F.avg(F.when(F.col("task") == t, F.col("hit"))), 6).alias(t) for t in tasks])
    models = table(spark, sf, "predictions").select("model").distinct()
    return models.join(p, "model", "left").unpivot(["model"], tasks, "task", "acc")


@reg.query("A42", """
SELECT model, round(avg(hit) FILTER (task = 'mcq'), 6) AS mcq, round(avg(hit) FILTER (task = 'vqa'), 6) AS vqa,
  round(avg(hit) FILTER (task = 'yorn'), 6) AS yorn, round(avg(hit) FILTER (task = 'open'), 6) AS open FROM scored GROUP BY model""")
def leaderboard(spark, sf):
    return R.pivot_means(scored(spark, sf), ["model"], "task", ["mcq", "vqa", "yorn", "open"], "hit")


@reg.query("A47", """
WITH s AS (SELECT string_split(l2_category, '/') AS sources, prediction IS NOT NULL AND length(translate(prediction, ' ().', '')) > 0 AS answered,
  split <> 'dev' AS answerable, hit FROM scored),
e AS (SELECT unnest(['all', sources[1], CASE WHEN answered THEN 'size_one' ELSE 'size_zero' END]) AS slice, * FROM s)
SELECT slice, count(*) AS n, round(CASE WHEN count(*) FILTER (answerable) > 0 THEN sum(hit) FILTER (answerable) / count(*) FILTER (answerable) ELSE 0 END, 6) AS recall,
  round(CASE WHEN count(*) FILTER (answered) > 0 THEN coalesce(sum(hit) FILTER (answered AND answerable), 0) / count(*) FILTER (answered) ELSE 0 END, 6) AS precision
FROM e WHERE slice IS NOT NULL GROUP BY slice""")
def answerability(spark, sf):
    """Recall over answerable rows and precision over answered ones, by slices of list membership and size; empty is 0."""
    s = scored(spark, sf).select(
        F.split("l2_category", "/")[0].alias("source"), (F.coalesce(F.length(F.translate("prediction", " ().", "")), F.lit(0)) > 0).alias("answered"),
        (F.col("split") != "dev").alias("answerable"), "hit",
    )
    e = s.withColumn("slice", F.explode(F.array_compact(F.array(F.lit("all"), F.col("source"), F.when(F.col("answered"), "size_one").otherwise("size_zero")))))
    return e.groupBy("slice").agg(
        N(), R.ratio(F.sum(F.expr("IF(answerable, hit, 0)")), F.count_if("answerable"), empty=0.0).alias("recall"),
        R.ratio(F.sum(F.expr("IF(answered AND answerable, hit, 0)")), F.count_if("answered"), empty=0.0).alias("precision"),
    )


@reg.query("A48 M12", """
WITH e AS (SELECT model, unnest(from_json(replace('[''' || replace(l2_category, '/', ''', ''') || ''']', '''', '"'), '["VARCHAR"]')) AS capability, hit FROM scored)
SELECT model, capability, count(*) AS n, round(avg(hit), 6) AS acc FROM e GROUP BY ALL""")
def capability_list(spark, sf):
    """Accuracy by the members of a list stored as its printed form (single quotes)."""
    from pixloom.functions.parsing import list_string

    printed = F.concat(F.lit("['"), F.regexp_replace("l2_category", "/", "', '"), F.lit("']"))
    e = scored(spark, sf).select("model", F.explode(list_string(printed)).alias("capability"), "hit")
    return e.groupBy("model", "capability").agg(N(), R.mean("hit").alias("acc"))


@reg.query("A49", """
WITH g AS (SELECT model, category, g_index, min(hit) AS h FROM scored WHERE category IS NOT NULL GROUP BY ALL), c AS (SELECT model, category, avg(h) AS a FROM g GROUP BY ALL)
SELECT model, round(avg(a), 6) AS acc, count(*) AS subtests FROM c GROUP BY model""")
def all_of_group_macro(spark, sf):
    """All rows of a group right, means by subtest, then the mean of subtests."""
    g = R.all_correct(scored(spark, sf).filter("category IS NOT NULL"), ["model", "category", "g_index"])
    c = g.groupBy("model", "category").agg(F.avg("hit").alias("a"))
    return c.groupBy("model").agg(F.round(F.avg("a"), 6).alias("acc"), F.count("*").alias("subtests"))


@reg.query("A52 F7", """
SELECT task, count(*) AS n, round(avg(hit), 6) AS acc FROM scored
WHERE prediction IS NOT NULL AND length(translate(prediction, ' ', '')) > 0 AND NOT contains(prediction, 'Failed to obtain answer via API') GROUP BY task""")
def skip_failed(spark, sf):
    """Means by type; failed and empty predictions leave the denominator."""
    ok = F.expr("prediction IS NOT NULL AND length(translate(prediction, ' ', '')) > 0 AND NOT contains(prediction, 'Failed to obtain answer via API')")
    return scored(spark, sf).filter(ok).groupBy("task").agg(N(), R.mean("hit").alias("acc"))


@reg.query("A53", """
WITH f(category) AS (VALUES ('wildlife'), ('food'), ('sport'), ('geology')),
c AS (SELECT f.category, count(s.pred_id) AS n, CAST(coalesce(sum(s.hit), 0) AS BIGINT) AS hits FROM f LEFT JOIN scored s ON s.category = f.category GROUP BY ALL)
SELECT category, n, CASE WHEN n > 0 THEN round(hits / n, 6) END AS acc FROM c
UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT), CASE WHEN sum(n) > 0 THEN round(sum(hits) / sum(n), 6) END FROM c""")
def fixed_categories(spark, sf):
    """A closed list of categories with the total; null for a category without rows."""
    names = ["wildlife", "food", "sport", "geology"]
    wide = scored(spark, sf).agg(*[f for n in names for f in (F.count_if(F.col("category") == n).alias(f"{n}_n"), F.sum(F.when(F.col("category") == n, F.col("hit"))).alias(f"{n}_h"))])
    parts = ", ".join(f"'{n}', {n}_n, coalesce({n}_h, 0)" for n in names)
    c = wide.select(F.expr(f"stack({len(names)}, {parts}) AS (category, n, h)"))
    both = c.withColumn("category", F.explode(F.array("category", F.lit("total")))).groupBy("category").agg(F.sum("n").alias("n"), F.sum("h").alias("h"))
    return both.select("category", "n", R.ratio(F.col("h"), F.col("n")).alias("acc"))


@reg.query("A55 F17", """
WITH v AS (SELECT task, CASE task WHEN 'yorn' THEN (yes_truth = yes_guess)::INT WHEN 'mcq' THEN hit
    ELSE coalesce(contains(lower(prediction), lower(answer)), false)::INT END AS ok FROM scored), t AS (SELECT task, avg(ok) AS a FROM v GROUP BY task)
SELECT task, round(a, 6) AS acc FROM t UNION ALL SELECT 'overall', round(avg(a), 6) FROM t""")
def rule_dispatch(spark, sf):
    """Each task by its own rule (synonyms of yes, letter equality, containment), overall as the mean of tasks."""
    holds = F.coalesce(F.contains(F.lower("prediction"), F.lower("answer")), F.lit(False)).cast("int")
    ok = F.when(F.col("task") == "yorn", (F.col("yes_truth") == F.col("yes_guess")).cast("int")).when(F.col("task") == "mcq", F.col("hit")).otherwise(holds)
    t = scored(spark, sf).groupBy("task").agg(F.avg(ok).alias("a"))
    return t.withColumn("task", F.explode(F.array("task", F.lit("overall")))).groupBy("task").agg(F.round(F.avg("a"), 6).alias("acc"))


@reg.query("A58", """
SELECT split_part(l2_category, '/', 1) AS dimension, CAST(sum(hit) AS BIGINT) AS hits, count(*) AS n FROM scored WHERE l2_category IS NOT NULL GROUP BY ALL""")
def first_dimension(spark, sf):
    return scored(spark, sf).filter("l2_category IS NOT NULL").groupBy(F.split("l2_category", "/")[0].alias("dimension")).agg(F.sum("hit").alias("hits"), N())


@reg.query("E7", """
SELECT model, task, count(*) AS n, count(*) FILTER (prediction IS NULL OR contains(prediction, 'Failed to obtain answer via API')) AS failed,
  count(*) FILTER (prediction IS NOT NULL AND length(translate(prediction, ' ', '')) = 0) AS empty FROM scored GROUP BY ALL""")
def failure_scan(spark, sf):
    return scored(spark, sf).groupBy("model", "task").agg(
        N(), F.expr("count_if(prediction IS NULL OR contains(prediction, 'Failed to obtain answer via API'))").alias("failed"),
        F.expr("count_if(prediction IS NOT NULL AND length(translate(prediction, ' ', '')) = 0)").alias("empty"),
    )


QUERIES, ORACLES = reg.queries, reg.oracles
