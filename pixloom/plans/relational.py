"""Numeric reports, joins, boxes and intervals over the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixloom.functions import geometry as G
from pixloom.functions import text as T
from pixloom.operators import intervals as I
from pixloom.operators import reports as R
from pixloom.plans.registry import Registry
from pixloom.session import table
from pixloom.tables import micros

reg = Registry()


def _t(name):
    return lambda spark, sf: table(spark, sf, name)


lineitem, orders, part, supplier, nation, region, events, embeddings, documents = (
    _t(n) for n in ("lineitem", "orders", "part", "supplier", "nation", "region", "events", "embeddings", "documents"))
N = "count(*) AS n"


def _e(*exprs: str):
    return [F.expr(x) for x in exprs]


@reg.query("A16", "SELECT l_returnflag, round(avg(l_extendedprice * (1 - l_discount)) / avg(l_extendedprice) * 100, 6) AS relative, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def ratio_of_means(spark, sf):
    return lineitem(spark, sf).groupBy("l_returnflag").agg(F.round(F.avg(F.expr("l_extendedprice * (1 - l_discount)")) / F.avg("l_extendedprice") * 100, 6).alias("relative"), *_e(N))


_VERDICT = "CASE o_orderpriority WHEN '1-URGENT' THEN 'A>>B' WHEN '2-HIGH' THEN 'A>B' WHEN '3-MEDIUM' THEN 'A=B' WHEN '4-NOT SPECIFIED' THEN 'B>A' ELSE 'B>>A' END"
_SCORE = f"""j AS (SELECT o_orderkey, o_orderstatus, o_custkey, {_VERDICT} AS verdict, o_orderkey % 2 = 1 AS rev FROM orders),
s AS (SELECT *, CASE WHEN rev THEN -1 ELSE 1 END * CASE verdict WHEN 'A>>B' THEN 2 WHEN 'A>B' THEN 1 WHEN 'B>A' THEN -1 WHEN 'B>>A' THEN -2 ELSE 0 END AS score FROM j)"""


def judged(spark, sf):
    """Pairwise judgements read from the order priorities; odd orders judged the sides exchanged."""
    o = orders(spark, sf).select("o_orderkey", "o_orderstatus", "o_custkey", F.expr(_VERDICT).alias("verdict"), (F.col("o_orderkey") % 2 == 1).alias("rev"))
    return o.withColumn("score", R.verdict_score("verdict", F.col("rev")))


_WIN = "count(*) AS n, round(avg((score > 0)::INT), 6) AS win_rate, round(avg((score = 0)::INT), 6) AS tie_rate, round(50.0 * sum(score) / count(*), 6) AS reward"


@reg.query("A22", f"WITH {_SCORE} SELECT o_orderstatus, {_WIN} FROM s GROUP BY o_orderstatus")
def winrate_reward(spark, sf):
    return R.win_reward(judged(spark, sf), ["o_orderstatus"])


@reg.query("A44", f"""WITH {_SCORE}, d AS (SELECT o_orderstatus AS main, o_custkey % 5 AS cat, score, verdict <> 'A=B' AS parsed FROM s),
c AS (SELECT main || '/' || cat AS name, * FROM d UNION ALL SELECT main, * FROM d)
SELECT name, {_WIN}, round(avg(parsed::INT), 6) AS parse_ok, count(*) FILTER (score = 2) AS much_better, count(*) FILTER (score = -2) AS much_worse FROM c GROUP BY name""")
def dual_order_merge(spark, sf):
    """Both orders of a judgement merged (exchanged ones negated), by category and main category."""
    d = judged(spark, sf).select(F.col("o_orderstatus").alias("main"), (F.col("o_custkey") % 5).alias("cat"), "score", (F.col("verdict") != "A=B").alias("parsed"))
    c = d.withColumn("name", F.explode(F.array(F.concat_ws("/", "main", F.col("cat").cast("string")), F.col("main"))))
    s = F.col("score")
    return c.groupBy("name").agg(
        *_e(N), R.share(s > 0).alias("win_rate"), R.share(s == 0).alias("tie_rate"), F.round(50 * F.sum(s) / F.count("*"), 6).alias("reward"),
        R.share(F.col("parsed")).alias("parse_ok"), F.count_if(s == 2).alias("much_better"), F.count_if(s == -2).alias("much_worse"))


@reg.query("A45", f"""WITH {_SCORE} SELECT o_custkey % 7 AS grp, round(avg((score > 0)::INT) FILTER (o_orderstatus = 'F'), 6) AS f_win, round(50.0 * sum(score) FILTER (o_orderstatus = 'F') / nullif(count(*) FILTER (o_orderstatus = 'F'), 0), 6) AS f_reward,
 round(avg((score > 0)::INT) FILTER (o_orderstatus = 'O'), 6) AS o_win, round(50.0 * sum(score) FILTER (o_orderstatus = 'O') / nullif(count(*) FILTER (o_orderstatus = 'O'), 0), 6) AS o_reward FROM s GROUP BY ALL""")
def winrate_wide(spark, sf):
    """Win rate and reward widened into columns by a closed list of types."""
    j = judged(spark, sf)
    cells = []
    for t in ("F", "O"):
        score = F.when(F.col("o_orderstatus") == t, F.col("score"))
        cells += [F.round(F.avg((score > 0).cast("int")), 6).alias(f"{t.lower()}_win"), F.round(50 * F.avg(score), 6).alias(f"{t.lower()}_reward")]
    return j.groupBy((F.col("o_custkey") % 7).alias("grp")).agg(*cells)


@reg.query("A23", """
WITH c AS (SELECT l_returnflag AS g, count(*) FILTER (l_linestatus = 'O' AND l_discount > 0.05) AS tp, count(*) FILTER (l_linestatus <> 'O' AND l_discount > 0.05) AS fp,
  count(*) FILTER (l_linestatus = 'O' AND l_discount <= 0.05) AS fn, count(*) FILTER (l_linestatus <> 'O' AND l_discount <= 0.05) AS tn FROM lineitem GROUP BY g),
j AS (SELECT a.g, a.tp + b.tp AS tp, a.fp + b.fp AS fp, a.fn + b.fn AS fn, a.tn + b.tn AS tn FROM c a, c b WHERE a.g <> 'N' AND b.g = 'N'),
r AS (SELECT g, tp, fp, fn, tn, tp / (tp + fp) AS p, tp / (tp + fn) AS rc, 2.0 * tp / (2 * tp + fp + fn) AS f1, (tp + tn) / (tp + fp + fn + tn) AS acc FROM j)
SELECT g AS grp, tp, fp, fn, tn, round(p, 6) AS precision, round(rc, 6) AS recall, round(f1, 6) AS f1, round(acc, 6) AS accuracy FROM r
UNION ALL SELECT 'overall', CAST(sum(tp) AS BIGINT), CAST(sum(fp) AS BIGINT), CAST(sum(fn) AS BIGINT), CAST(sum(tn) AS BIGINT), round(avg(round(p, 6)), 6), round(avg(round(rc, 6)), 6), round(avg(round(f1, 6)), 6), round(avg(round(acc, 6)), 6) FROM r""")
def control_group_prf(spark, sf):
    """Each group together with a shared control group, and the mean of groups."""
    c = lineitem(spark, sf).groupBy(F.col("l_returnflag").alias("grp")).agg(*R.confusion(F.expr("l_linestatus = 'O'"), F.expr("l_discount > 0.05")))
    counts = ["tp", "fp", "fn", "tn"]
    r = R.prf(R.with_control(c, "grp", "N", counts))
    mean = r.agg(*[F.sum(x).alias(x) for x in counts], *[F.round(F.avg(x), 6).alias(x) for x in ("precision", "recall", "f1", "accuracy")])
    return r.unionByName(mean.withColumn("grp", F.lit("overall")))


@reg.query("A26", """
WITH q AS (SELECT l_orderkey AS qid, avg(l_discount * 10) AS miou, max((l_linestatus = 'O')::INT) AS long_acc FROM lineitem GROUP BY l_orderkey),
t AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5])::DOUBLE AS t)
SELECT t AS threshold, round(avg((round(miou, 9) > t AND long_acc = 1)::INT), 6) AS acc FROM q, t GROUP BY t
UNION ALL SELECT -1.0::DOUBLE, round(avg((round(miou, 9) > t AND long_acc = 1)::INT), 6) FROM q, t""")
def acc_at_iou(spark, sf):
    """Share of questions with an IoU above each threshold and a right long answer; -1 is their mean."""
    q = lineitem(spark, sf).groupBy("l_orderkey").agg(F.round(F.avg(F.col("l_discount") * 10), 9).alias("miou"), F.max((F.col("l_linestatus") == "O").cast("int")).alias("ok"))
    ts = [0.1, 0.2, 0.3, 0.4, 0.5]
    wide = q.agg(*[F.round(R.share((F.col("miou") > t) & (F.col("ok") == 1), 9), 9).alias(f"t{k}") for k, t in enumerate(ts)])
    mean = F.expr("(" + " + ".join(f"t{k}" for k in range(5)) + ") / 5")
    parts = ", ".join(f"{t}D, round(t{k}, 6)" for k, t in enumerate(ts))
    return wide.withColumn("m", mean).select(F.expr(f"stack(6, {parts}, -1.0D, round(m, 6)) AS (threshold, acc)"))


_FIELDS = """f AS (SELECT l_orderkey AS q, l_linestatus AS task, CASE WHEN l_discount = 0 THEN -1 ELSE l_discount * 10 END AS score, l_quantity AS w FROM lineitem),
q AS (SELECT task, q, coalesce(sum(score * w) FILTER (score >= 0) / nullif(sum(w) FILTER (score >= 0), 0), -1) AS mean, coalesce(min(score) FILTER (score >= 0), -1) AS least FROM f GROUP BY ALL)"""


@reg.query("A30", f"""WITH {_FIELDS}
SELECT task, count(*) AS n, round(avg(mean) FILTER (mean >= 0), 6) AS mean, round(avg(least) FILTER (least >= 0), 6) AS least FROM q GROUP BY task
UNION ALL SELECT 'macro', sum(n)::BIGINT, round(avg(m), 6), round(avg(l), 6) FROM (SELECT count(*) AS n, avg(mean) FILTER (mean >= 0) AS m, avg(least) FILTER (least >= 0) AS l FROM q GROUP BY task)
UNION ALL SELECT 'micro', count(*), round(avg(mean) FILTER (mean >= 0), 6), round(avg(least) FILTER (least >= 0), 6) FROM q""")
def field_aggregation(spark, sf):
    """Fields to queries by weighted mean and by minimum (-1 is not applicable), then micro and macro means of tasks."""
    score = F.when(F.col("l_discount") == 0, -1.0).otherwise(F.col("l_discount") * 10)
    f = lineitem(spark, sf).select("l_orderkey", F.col("l_linestatus").alias("task"), score.alias("score"), F.col("l_quantity").alias("w"))
    q = f.groupBy("task", "l_orderkey").agg(R.weighted_mean(F.col("score"), F.col("w")).alias("mean"), F.coalesce(F.min(F.when(F.col("score") >= 0, F.col("score"))), F.lit(-1.0)).alias("least"))
    ok = lambda c: F.when(F.col(c) >= 0, F.col(c))
    t = q.groupBy("task").agg(*_e(N), *[x for c in ("mean", "least") for x in (F.sum(ok(c)).alias(f"{c}_s"), F.count(ok(c)).alias(f"{c}_c"))])
    each = t.select("task", "n", *[F.round(F.col(f"{c}_s") / F.col(f"{c}_c"), 6).alias(c) for c in ("mean", "least")])
    both = t.agg(F.sum("n").alias("n"), *[F.array(F.round(F.avg(F.col(f"{c}_s") / F.col(f"{c}_c")), 6), F.round(F.sum(f"{c}_s") / F.sum(f"{c}_c"), 6)).alias(c) for c in ("mean", "least")])
    wide = both.select(F.posexplode(F.array(F.lit("macro"), F.lit("micro"))).alias("i", "task"), "n", "mean", "least")
    return each.unionByName(wide.select("task", "n", F.element_at("mean", F.col("i") + 1).alias("mean"), F.element_at("least", F.col("i") + 1).alias("least")))


@reg.query("A31 F8", """
WITH s AS (SELECT l_returnflag AS dim, greatest(0, least(10, l_quantity / 4)) AS v, l_linenumber < 7 AS ok FROM lineitem)
SELECT dim, count(*) FILTER (ok) AS valid, round(avg(v) FILTER (ok), 6) AS mean_valid, round(sum(v) FILTER (ok) / count(*), 6) AS mean_all FROM s GROUP BY dim""")
def judge_means(spark, sf):
    """Scores clipped to 0..10, averaged over the valid rows and over all rows."""
    v = F.when(F.col("l_linenumber") < 7, F.greatest(F.lit(0.0), F.least(F.lit(10.0), F.col("l_quantity") / 4)))
    return lineitem(spark, sf).groupBy(F.col("l_returnflag").alias("dim")).agg(F.count(v).alias("valid"), F.round(F.avg(v), 6).alias("mean_valid"), F.round(F.sum(v) / F.count("*"), 6).alias("mean_all"))


@reg.query("A50", """
WITH s AS (SELECT l_returnflag AS mode, l_linenumber AS gt, CAST(floor(l_quantity / 7) AS INTEGER) AS pred FROM lineitem)
SELECT mode, round(avg((gt = pred)::INT), 6) AS acc, round(avg((abs(gt - pred) <= 1)::INT), 6) AS off_by_one, round(avg(abs(gt - pred)), 6) AS mae, round(sqrt(avg((gt - pred) * (gt - pred))), 6) AS rmse FROM s GROUP BY mode""")
def counting_metrics(spark, sf):
    d = F.col("l_linenumber") - F.floor(F.col("l_quantity") / 7)
    return lineitem(spark, sf).groupBy(F.col("l_returnflag").alias("mode")).agg(
        R.share(d == 0).alias("acc"), R.share(F.abs(d) <= 1).alias("off_by_one"), F.round(F.avg(F.abs(d)), 6).alias("mae"), F.round(F.sqrt(F.avg(d * d)), 6).alias("rmse"))


@reg.query("A51", """
WITH s AS (SELECT l_returnflag AS dim, CASE WHEN l_tax = 0 THEN -1 ELSE greatest(0, (0.5 - abs(l_discount * 5 - l_tax * 5)) / 0.5) END AS v FROM lineitem),
d AS (SELECT dim, coalesce(avg(v) FILTER (v <> -1), 0) AS m FROM s GROUP BY dim)
SELECT dim, round(m, 6) AS score FROM d UNION ALL SELECT 'overall', round(avg(m), 6) FROM d""")
def closeness(spark, sf):
    """Closeness within half a unit; rows marked -1 don't count, a dimension without rows is 0; then the mean of means."""
    v = F.when(F.col("l_tax") != 0, F.greatest(F.lit(0.0), (0.5 - F.abs(F.col("l_discount") * 5 - F.col("l_tax") * 5)) / 0.5))
    d = lineitem(spark, sf).groupBy(F.col("l_returnflag").alias("dim")).agg(F.coalesce(F.avg(v), F.lit(0.0)).alias("m"))
    return d.withColumn("dim", F.explode(F.array("dim", F.lit("overall")))).groupBy("dim").agg(F.round(F.avg("m"), 6).alias("score"))


@reg.query("A39", "SELECT event_type, count(*) AS n, mode(user_id % 4) AS common FROM events GROUP BY event_type")
def bincount(spark, sf):
    return events(spark, sf).groupBy("event_type").agg(*_e(N), F.mode(F.col("user_id") % 4, True).alias("common"))


@reg.query("J9 J10", """
WITH s AS (SELECT s_nationkey, avg(s_acctbal) AS joker FROM supplier GROUP BY s_nationkey)
SELECT r_name, count(*) AS nodes, count(joker) AS known, round(avg(joker), 6) AS mean FROM region JOIN nation ON r_regionkey = n_regionkey LEFT JOIN s ON s_nationkey = n_nationkey GROUP BY r_name""")
def lookup_rollup(spark, sf):
    """Nodes with a looked-up mean (kept without one), rolled up to their root."""
    s = supplier(spark, sf).groupBy("s_nationkey").agg(F.avg("s_acctbal").alias("joker"))
    n = nation(spark, sf).join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left").join(region(spark, sf), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.groupBy("r_name").agg(F.count("*").alias("nodes"), F.count("joker").alias("known"), F.round(F.avg("joker"), 6).alias("mean"))


_BOX = """b AS (SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity AS q, l_linenumber::DOUBLE AS k, l_discount * 100 AS d FROM lineitem),
x AS (SELECT *, [k, k, k + q, k + 20] AS p, [k + d, k, k + d + 25, k + 25] AS g FROM b),
i AS (SELECT *, greatest(0, least(p[3], g[3]) - greatest(p[1], g[1])) * greatest(0, least(p[4], g[4]) - greatest(p[2], g[2])) AS inter, (p[3] - p[1]) * (p[4] - p[2]) AS ap, (g[3] - g[1]) * (g[4] - g[2]) AS ag FROM x),
u AS (SELECT *, inter / (ap + ag - inter) AS iou, (p[1] + p[3]) / 2 BETWEEN g[1] AND g[3] AND (p[2] + p[4]) / 2 BETWEEN g[2] AND g[4] AS inside FROM i)"""


def _boxes(spark, sf):
    k, q, d = F.col("l_linenumber").cast("double"), F.col("l_quantity"), F.col("l_discount") * 100
    return lineitem(spark, sf).select("l_orderkey", "l_linenumber", F.array(k, k, k + q, k + 20).alias("p"), F.array(k + d, k, k + d + 25, k + 25).alias("g"))


@reg.query("M1 M2", f"WITH {_BOX} SELECT l_linenumber, count(*) AS n, round(avg(round(iou, 9)), 6) AS iou, count(*) FILTER (round(iou, 9) >= 0.5) AS hits, count(*) FILTER (inside) AS inside FROM u GROUP BY l_linenumber")
def iou_boxes(spark, sf):
    """Overlap of two boxes of each row, and whether the centre of one lies in the other."""
    b = _boxes(spark, sf)
    c = G.centre(F.col("p"))
    s = b.select("l_linenumber", F.round(G.box_iou(F.col("p"), F.col("g")), 9).alias("iou"), G.in_box(c["x"], c["y"], F.col("g")).alias("inside"))
    return s.groupBy("l_linenumber").agg(*_e(N), F.round(F.avg("iou"), 6).alias("iou"), F.count_if(F.col("iou") >= 0.5).alias("hits"), F.count_if("inside").alias("inside"))


@reg.query("J16 M18", f"""WITH {_BOX}, g AS (SELECT DISTINCT l_orderkey, g FROM x), p AS (SELECT DISTINCT l_orderkey, p FROM x),
c AS (SELECT p.l_orderkey, p.p, max(greatest(0, least(p.p[3], g.g[3]) - greatest(p.p[1], g.g[1])) * greatest(0, least(p.p[4], g.g[4]) - greatest(p.p[2], g.g[2])) /
  ((p.p[3] - p.p[1]) * (p.p[4] - p.p[2]) + (g.g[3] - g.g[1]) * (g.g[4] - g.g[2]) - greatest(0, least(p.p[3], g.g[3]) - greatest(p.p[1], g.g[1])) * greatest(0, least(p.p[4], g.g[4]) - greatest(p.p[2], g.g[2])))) AS best
  FROM p JOIN g USING (l_orderkey) GROUP BY ALL)
SELECT l_orderkey, count(*) AS boxes, round(avg(best), 6) AS mean_best FROM c GROUP BY l_orderkey""")
def best_boxes(spark, sf):
    """For each predicted box of an order its best true box."""
    b = _boxes(spark, sf).groupBy("l_orderkey").agg(F.array_sort(F.collect_set("p")).alias("p"), F.collect_set("g").alias("g"))
    best = G.best_iou(F.col("p"), F.col("g"))
    s = b.select("l_orderkey", best.alias("b"))
    return s.select("l_orderkey", F.size("b").cast("bigint").alias("boxes"), F.round(F.aggregate("b", F.lit(0.0), lambda a, x: a + x) / F.size("b"), 6).alias("mean_best"))


_IV = """e AS (SELECT user_id, event_type, value AS s, value + 5 AS f FROM events),
o AS (SELECT *, max(f) OVER (PARTITION BY user_id, event_type ORDER BY s, f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pf FROM e),
g AS (SELECT *, sum(CASE WHEN s <= pf THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, event_type ORDER BY s, f ROWS UNBOUNDED PRECEDING) AS k FROM o),
m AS (SELECT user_id, event_type, k, min(s) AS s, max(f) AS f FROM g GROUP BY ALL)"""


def _spans(spark, sf):
    return events(spark, sf).select("user_id", "event_type", F.col("value").alias("s"), (F.col("value") + 5).alias("e"))


@reg.query("W10", f"WITH {_IV} SELECT user_id, event_type, count(*) AS intervals, round(sum(f - s), 6) AS covered FROM m GROUP BY ALL")
def interval_merge(spark, sf):
    """Intervals of each user and kind merged where they touch."""
    m = I.merge(_spans(spark, sf), ["user_id", "event_type"], "s", "e", 50.0)
    return m.groupBy("user_id", "event_type").agg(F.count("*").alias("intervals"), F.round(F.sum(F.col("e") - F.col("s")), 6).alias("covered"))


@reg.query("M3 J15", f"""WITH {_IV},
a AS (SELECT * FROM m WHERE event_type = 'click'), b AS (SELECT * FROM m WHERE event_type = 'view'),
i AS (SELECT a.user_id, sum(greatest(0, least(a.f, b.f) - greatest(a.s, b.s))) AS inter FROM a JOIN b USING (user_id) GROUP BY 1),
l AS (SELECT user_id, sum(f - s) AS total FROM m WHERE event_type IN ('click', 'view') GROUP BY 1)
SELECT user_id, round(coalesce(inter, 0) / (total - coalesce(inter, 0)), 6) AS iou FROM l LEFT JOIN i USING (user_id)""")
def interval_iou(spark, sf):
    """Overlap of two interval sets of each user, without a join of intervals."""
    return I.set_iou(_spans(spark, sf), ["user_id"], "event_type", "click", "view", "s", "e", 50.0).withColumn("iou", F.round("iou", 6))


@reg.query("M4", """
WITH s AS (SELECT l_returnflag, l_quantity AS x1, l_linenumber * 7.0::DOUBLE AS x2, l_discount * 900 AS y1, l_tax * 900 AS y2 FROM lineitem),
m AS (SELECT *, greatest(0, CASE WHEN x2 = 0 THEN (x1 = 0)::INT ELSE 1 - abs(x1 - x2) / abs(x2) END) AS rel, sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)) AS dist,
  2 * 6371.0 * asin(least(1, sqrt(pow(sin(radians(y2 - y1) / 2), 2) + cos(radians(y1)) * cos(radians(y2)) * pow(sin(radians(x2 - x1) / 2), 2)))) AS km FROM s)
SELECT l_returnflag, round(avg(dist), 6) AS dist, round(avg((x1 - x2) * (x1 - x2)), 6) AS mse, round(avg(rel), 6) AS relative,
  round(1 - least(0.1, sqrt(avg((x1 - x2) * (x1 - x2))) / (max(x2) - min(x2))) / 0.1, 6) AS norm_rmse, round(avg(exp(-km / 5000)), 6) AS geo FROM m GROUP BY l_returnflag""")
def numeric_scores(spark, sf):
    """Point distance, squared error, relative score, normalised RMSE and geographic nearness."""
    c = F.col
    s = lineitem(spark, sf).select("l_returnflag", c("l_quantity").alias("x1"), (c("l_linenumber") * 7.0).alias("x2"), (c("l_discount") * 900).alias("y1"), (c("l_tax") * 900).alias("y2"))
    sq = (c("x1") - c("x2")) * (c("x1") - c("x2"))
    return s.groupBy("l_returnflag").agg(
        F.round(F.avg(G.distance(c("x1"), c("y1"), c("x2"), c("y2"))), 6).alias("dist"), F.round(F.avg(sq), 6).alias("mse"), F.round(F.avg(G.relative_score(c("x1"), c("x2"))), 6).alias("relative"),
        F.round(1 - F.least(F.lit(0.1), F.sqrt(F.avg(sq)) / (F.max("x2") - F.min("x2"))) / 0.1, 6).alias("norm_rmse"),
        F.round(F.avg(F.exp(-G.haversine_km(c("y1"), c("x1"), c("y2"), c("x2")) / 5000)), 6).alias("geo"))


@reg.query("M5 M6 U3", """
WITH w AS (SELECT pred_id, list_filter(string_split(lower(prediction), ' '), lambda x: x <> '') AS a, list_filter(string_split(lower(answer), ' '), lambda x: x <> '') AS b
  FROM (SELECT DISTINCT pred_id, prediction, answer FROM predictions) WHERE prediction IS NOT NULL AND answer IS NOT NULL),
s AS (SELECT *, list_distinct(a) AS p, list_distinct(b) AS t, len(list_intersect(list_distinct(a), list_distinct(b))) AS common, len(list_distinct(list_concat(a, b))) AS uni,
  len(list_filter(range(1, greatest(len(a), len(b)) + 1), lambda i: a[1:i] = b[1:i] AND i <= least(len(a), len(b)))) AS pre FROM w)
SELECT pred_id, round(CASE WHEN greatest(len(a), len(b)) = 0 THEN 1 ELSE pre / greatest(len(a), len(b)) END, 6) AS prefix, round(CASE WHEN uni = 0 THEN 1 ELSE common / uni END, 6) AS jaccard,
  round(CASE WHEN uni = 0 THEN 1 WHEN len(p) = 0 THEN 0 ELSE common / len(p) END, 6) AS precision, round(CASE WHEN uni = 0 THEN 1 WHEN len(t) = 0 THEN 0 ELSE common / len(t) END, 6) AS recall, a = b AS equal_sequence, common = uni AS equal_set FROM s""")
def sequence_scores(spark, sf):
    """Longest common prefix, set scores and equality of two word sequences."""
    p = table(spark, sf, "predictions").select("pred_id", "prediction", "answer").distinct().filter("prediction IS NOT NULL AND answer IS NOT NULL")
    w = p.select("pred_id", *[F.filter(F.split(F.lower(c), " "), lambda x: x != "").alias(n) for c, n in (("prediction", "a"), ("answer", "b"))])
    x = G.set_scores(F.col("a"), F.col("b"))
    return w.select("pred_id", F.round(G.prefix_ratio(F.col("a"), F.col("b")), 6).alias("prefix"), F.round(x["jaccard"], 6).alias("jaccard"), F.round(x["p"], 6).alias("precision"),
                    F.round(x["r"], 6).alias("recall"), (F.col("a") == F.col("b")).alias("equal_sequence"), (F.size(F.array_intersect("a", "b")) == F.size(F.array_union("a", "b"))).alias("equal_set"))


@reg.query("M15", """
SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS stamp, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS seconds, CAST(user_id % 24 AS INTEGER) * 3600 + 90 AS parsed FROM events""")
def timestamps(spark, sf):
    """A stamp as text, whole seconds, and a clock text parsed to seconds."""
    from pixloom.functions.parsing import seconds

    clock = F.concat((F.col("user_id") % 24).cast("string"), F.lit(":01:30"))
    ts = F.col("ts")
    return events(spark, sf).select("event_id", F.date_format(ts, "yyyyMMddHHmmss").alias("stamp"), F.floor(micros("ts") / 1_000_000).alias("seconds"), seconds(clock).cast("int").alias("parsed"))


@reg.query("S12", """
WITH n AS (SELECT l_orderkey, max(l_quantity)::BIGINT + 10 AS len FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, array_to_string(list_transform(range(1, 9), lambda i: CAST(floor(i * len / 9) AS BIGINT)), ',') AS by_count, array_to_string(list_transform(range(0, CAST(ceil(len / 12) AS BIGINT)), lambda i: CAST(floor(i * 25 / 2.0) AS BIGINT)), ',') AS by_rate FROM n""")
def frame_indices(spark, sf):
    """Frames sampled evenly by number, and by rate (two a second of 25)."""
    n = lineitem(spark, sf).groupBy("l_orderkey").agg((F.max("l_quantity").cast("bigint") + 10).alias("len"))
    by_count = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.floor(i * F.col("len") / 9))
    by_rate = F.transform(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("len") / 12) - 1), lambda i: F.floor(i * 25 / 2.0))
    return n.select("l_orderkey", F.array_join(by_count.cast("array<string>"), ",").alias("by_count"), F.array_join(by_rate.cast("array<string>"), ",").alias("by_rate"))


@reg.query("T10", """
WITH g AS (SELECT i AS c, j AS r, row_number() OVER (ORDER BY i * j, i, j) AS k FROM range(1, 13) a(i), range(1, 13) b(j) WHERE i * j <= 12),
s AS (SELECT DISTINCT l_suppkey % 37 * 100 + 150 AS w, l_partkey % 41 * 90 + 120 AS h FROM lineitem),
d AS (SELECT w, h, c, r, k, abs(w / h - c / r) AS far FROM s, g),
m AS (SELECT w, h, min(far) AS least FROM d GROUP BY ALL),
t AS (SELECT d.*, row_number() OVER (PARTITION BY d.w, d.h ORDER BY k) AS o FROM d JOIN m ON d.w = m.w AND d.h = m.h AND d.far = m.least),
f AS (SELECT w, h, arg_max(c, k) AS c, arg_max(r, k) AS r FROM t WHERE o = 1 OR w::DOUBLE * h > 0.5 * 448 * 448 * c * r GROUP BY ALL)
SELECT w, h, CAST(c AS INTEGER) AS cols, CAST(r AS INTEGER) AS rows, CAST(CASE WHEN c * r > 1 THEN c * r + 1 ELSE 1 END AS INTEGER) AS images,
  ((c - 1) * 448) || ',' || ((r - 1) * 448) || ',' || (c * 448) || ',' || (r * 448) AS last_box FROM f""")
def tile_grid(spark, sf):
    """Closest grid of tiles for every picture size, with the thumbnail and the last box."""
    s = lineitem(spark, sf).select((F.col("l_suppkey") % 37 * 100 + 150).alias("w"), (F.col("l_partkey") % 41 * 90 + 120).alias("h")).distinct()
    g = s.withColumn("g", G.tile_grid(F.col("w"), F.col("h")))
    c, r = F.col("g.c"), F.col("g.r")
    boxes = G.tile_boxes(c, r)
    return g.select("w", "h", c.alias("cols"), r.alias("rows"), F.when(c * r > 1, c * r + 1).otherwise(1).alias("images"), F.array_join(F.element_at(boxes, -1).cast("array<string>"), ",").alias("last_box"))


@reg.query("T9", """
WITH d AS (SELECT doc_id, doc_id // 8 AS batch, coalesce(length(text), 0) % 50 AS n FROM documents), w AS (SELECT *, max(n) OVER (PARTITION BY batch) AS width FROM d)
SELECT doc_id, CAST(width AS BIGINT) AS width, CAST(width - n AS BIGINT) AS pads, CAST(n AS BIGINT) AS ones FROM w""")
def left_pad_batches(spark, sf):
    """Batches of eight padded on the left to their longest row, with masks."""
    from pyspark.sql import Window

    ids = F.transform(F.sequence(F.lit(0), F.coalesce(F.length("text"), F.lit(0)) % 50), lambda i: i + 5)
    d = documents(spark, sf).select("doc_id", F.floor(F.col("doc_id") / 8).alias("batch"), F.slice(ids, 1, F.size(ids) - 1).alias("ids"))
    p = d.withColumn("width", F.max(F.size("ids")).over(Window.partitionBy("batch"))).withColumn("x", T.left_pad(F.col("ids"), F.col("width")))
    return p.select("doc_id", F.size("x.ids").cast("bigint").alias("width"), F.size(F.filter("x.mask", lambda m: m == 0)).cast("bigint").alias("pads"),
                    F.aggregate("x.mask", F.lit(0), lambda a, m: a + m).cast("bigint").alias("ones"))


_TURNS = """t AS (SELECT dialogue_id, conversations AS c FROM (SELECT DISTINCT dialogue_id, conversations FROM train_dialogues) WHERE conversations IS NOT NULL),
u AS (SELECT dialogue_id, c, unnest(range(1, len(c) + 1)) AS i FROM t), m AS (SELECT dialogue_id, i, c[i].role AS role, c[i].text AS txt, coalesce(length(c[i].text) > 0, false) AS has FROM u)"""


def dialogues(spark, sf):
    return table(spark, sf, "train_dialogues").select("dialogue_id", "conversations").distinct().filter("conversations IS NOT NULL")


def _render(expr: str, head: str = "") -> str:
    return f"coalesce('{head}' || string_agg({expr}, '' ORDER BY i), '{head}')"


@reg.query("T6 T5", f"""WITH {_TURNS}, a AS (SELECT t.dialogue_id, md5(t.c::VARCHAR) AS which, m.* EXCLUDE (dialogue_id) FROM t LEFT JOIN m USING (dialogue_id)),
z AS (SELECT dialogue_id, which, {_render("CASE WHEN i IS NULL THEN '' WHEN has THEN coalesce(role, '') || ': ' || txt || chr(10) ELSE coalesce(role, '') || ':' END", chr(10))} AS single,
 {_render("CASE WHEN i IS NULL THEN '' WHEN has THEN coalesce(role, '') || ': ' || txt || CASE WHEN i % 2 = 1 THEN chr(10) ELSE '</s>' END ELSE coalesce(role, '') || ':' END", chr(10))} AS two,
 {_render("CASE WHEN i IS NULL OR NOT has THEN '' ELSE txt || CASE WHEN i % 2 = 1 THEN chr(10) ELSE '</s>' END END")} AS plain,
 {_render("CASE WHEN i IS NULL THEN '' WHEN has THEN '<|im_start|>' || coalesce(role, '') || chr(10) || txt || '<|im_end|>' || chr(10) ELSE '<|im_start|>' || coalesce(role, '') || chr(10) END")} AS chatml,
 {_render("CASE WHEN i IS NULL OR NOT has THEN '' WHEN role = 'user' THEN '[INST] ' || txt || ' [/INST]' ELSE ' ' || txt || ' </s>' END")} AS inst FROM a GROUP BY dialogue_id, which)
SELECT dialogue_id, md5(single) AS single, md5(two) AS two, md5(plain) AS plain, md5(chatml) AS chatml, md5(inst) AS inst FROM z""")
def chat_prompts(spark, sf):
    """Every dialogue in five chat styles (as digests)."""
    d = dialogues(spark, sf)
    turns = F.transform("conversations", lambda m: F.struct(F.coalesce(m["role"], F.lit("")).alias("role"), m["text"].alias("text")))
    return d.select("dialogue_id", *[F.md5(T.turns_to_prompt(turns, s)).alias(s) for s in ("single", "two", "plain", "chatml", "inst")])


@reg.query("W11 W12 T7 T8", f"""WITH {_TURNS}, n AS (SELECT dialogue_id, i, role, coalesce(length(txt), 0) AS len, (length(coalesce(txt, '')) - length(replace(coalesce(txt, ''), '<image>', ''))) // 7 AS tags FROM m)
SELECT dialogue_id, CAST(count(*) AS BIGINT) AS turns, CAST(sum(len) FILTER (role = 'assistant') AS BIGINT) AS learnt, CAST(coalesce(sum(tags), 0) AS BIGINT) AS images, CAST(max(tags) AS BIGINT) AS most,
  CAST(sum(greatest(tags - 1, 0)) AS BIGINT) AS left_over FROM n GROUP BY dialogue_id HAVING sum(len) FILTER (role = 'assistant') IS NOT NULL""")
def dialogue_masks(spark, sf):
    """History and image slots of each dialogue, tokens that are learnt and marks left after one is expanded a turn."""
    d = dialogues(spark, sf)
    text = F.transform("conversations", lambda m: F.coalesce(m["text"], F.lit("")))
    expanded = F.transform(text, lambda t: T.left_images(T.expand_image(t, F.lit(1), 4)))
    labels = T.mask_labels(F.transform(text, F.length), F.transform("conversations", lambda m: F.coalesce(m["role"] != "assistant", F.lit(True))))
    tags = F.transform(text, T.left_images)
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x).cast("bigint")
    some = F.exists("conversations", lambda m: F.coalesce(m["role"] == "assistant", F.lit(False)))
    return d.filter(some).select("dialogue_id", F.size("conversations").cast("bigint").alias("turns"), F.size(F.filter(labels, lambda x: x != -100)).cast("bigint").alias("learnt"),
                                 total(tags).alias("images"), F.array_max(tags).cast("bigint").alias("most"), total(expanded).alias("left_over"))


@reg.query("O3 O4", "SELECT task, n, CAST(row_number() OVER (ORDER BY n DESC, task) AS INTEGER) AS place FROM (SELECT p_type AS task, count(*) AS n FROM part WHERE p_size > 25 GROUP BY p_type)")
def ranked_failures(spark, sf):
    """Groups by falling number of matches; the groups are few (one row a kind)."""
    from pyspark.sql import Window

    g = part(spark, sf).filter("p_size > 25").groupBy(F.col("p_type").alias("task")).agg(*_e(N))
    return g.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "task")))


@reg.query("U4 U1", """
UNPIVOT (SELECT p_partkey, p_size::DOUBLE AS size, p_retailprice AS price FROM part) ON size, price INTO NAME field VALUE value""")
def unpivot_long(spark, sf):
    p = part(spark, sf).select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"))
    return p.unpivot(["p_partkey"], ["size", "price"], "field", "value")


@reg.query("M10", """
WITH f AS (SELECT event_id, k.key AS field, CAST(k.value AS VARCHAR) AS value FROM events, json_each(props) AS k), t AS (SELECT event_id, 'k' AS field, CAST(user_id AS VARCHAR) AS value FROM events),
h AS (SELECT f.field, count(*) FILTER (t.value = f.value) AS tp, count(*) AS n FROM f JOIN t USING (event_id, field) GROUP BY f.field)
SELECT field, tp, round(tp / (tp + ((n - tp) + (n - tp)) / 2.0 + 1e-6), 6) AS f1 FROM h""")
def flat_fields_f1(spark, sf):
    """Flattened key-value pairs of a record against the truth, F1 by field."""
    from pixloom.functions.structures import flat_pairs

    e = events(spark, sf).select(F.col("user_id").cast("string").alias("truth"), F.explode(flat_pairs("props")).alias("kv"))
    h = e.groupBy(F.col("kv.key").alias("field")).agg(F.count_if(F.col("kv.value") == F.col("truth")).alias("tp"), *_e(N))
    return h.select("field", "tp", F.round(F.expr("tp / (tp + ((n - tp) + (n - tp)) / 2 + 1e-6D)"), 6).alias("f1"))


QUERIES, ORACLES = reg.queries, reg.oracles
