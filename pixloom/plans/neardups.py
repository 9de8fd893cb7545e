"""Near-duplicate queries over the pictures and the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixloom.operators import neardup as D
from pixloom.plans.registry import Registry
from pixloom.session import cut, table

PRELUDE = """WITH v AS (SELECT DISTINCT image_id, h, w, image FROM image_grids WHERE image IS NOT NULL AND h > 0 AND w > 0 AND h % 8 = 0 AND w % 8 = 0 AND len(image) = h * w),
px AS (SELECT image_id, h, w, image, unnest(range(0, h * w)) AS k FROM v),
cell AS (SELECT image_id, (k // w) // (h // 8) AS r, (k % w) // (w // 8) AS c, sum(image[k + 1]) AS s FROM px GROUP BY ALL),
tot AS (SELECT image_id, sum(s) AS t, median(s) AS md FROM cell GROUP BY image_id),
ah AS (SELECT image_id, string_agg(CASE WHEN 64 * s >= t THEN '1' ELSE '0' END, '' ORDER BY r, c) AS bits FROM cell JOIN tot USING (image_id) GROUP BY image_id)"""
reg = Registry(PRELUDE)


def _images(spark, sf):
    return table(spark, sf, "image_grids")


def _ahash(spark, sf):
    p = D.valid_pictures(_images(spark, sf)).withColumn("cells", D.block_sums(F.col("image"), F.col("h"), F.col("w")))
    return p.select("image_id", D.average_hash(F.col("cells")).alias("bits")).withColumn("h", D.bits_of("bits"))


@reg.query("N1 N17 S10", "SELECT image_id, bits FROM ah")
def ahash_bits(spark, sf):
    return _ahash(spark, sf).select("image_id", "bits")


@reg.query("N4", """SELECT image_id, string_agg(CASE WHEN s >= md THEN '1' ELSE '0' END, '' ORDER BY r, c) AS bits FROM cell JOIN tot USING (image_id) GROUP BY image_id""")
def whash_bits(spark, sf):
    return D.picture_hashes(_images(spark, sf)).select("image_id", F.col("whash").alias("bits"))


@reg.query("N2", """
WITH g AS (SELECT image_id, h, w, image, i // 8 AS r, i % 8 AS c FROM (SELECT *, unnest(range(0, 64)) AS i FROM v))
SELECT image_id, string_agg(CASE WHEN image[(r * h // 8) * w + ((c + 1) * w // 9) + 1] > image[(r * h // 8) * w + (c * w // 9) + 1] THEN '1' ELSE '0' END, '' ORDER BY r, c) AS bits FROM g GROUP BY image_id""")
def dhash_bits(spark, sf):
    return D.picture_hashes(_images(spark, sf)).select("image_id", F.col("dhash").alias("bits"))


@reg.query("N3", """
WITH s AS (SELECT image_id, y, x, image[(y * h // 32) * w + (x * w // 32) + 1] AS p FROM (SELECT *, unnest(range(0, 32)) AS x FROM (SELECT *, unnest(range(0, 32)) AS y FROM v))),
k AS (SELECT unnest(range(0, 8)) AS u), b AS (SELECT image_id, y, u, sum(p * 2 * cos(pi() * u * (2 * x + 1) / 64)) AS q FROM s, k GROUP BY ALL),
d AS (SELECT b.image_id, k.u AS uy, b.u AS ux, round(sum(q * 2 * cos(pi() * k.u * (2 * y + 1) / 64)), 6) AS z FROM b, k GROUP BY ALL),
m AS (SELECT image_id, median(z) AS md FROM d WHERE uy + ux > 0 GROUP BY image_id)
SELECT image_id, string_agg(CASE WHEN z >= md THEN '1' ELSE '0' END, '' ORDER BY uy, ux) AS bits FROM d JOIN m USING (image_id) GROUP BY image_id""")
def phash_bits(spark, sf):
    return D.picture_hashes(_images(spark, sf)).select("image_id", F.col("phash").alias("bits"))


_PAIRS = """c AS (SELECT bits, min(image_id) AS first, count(*) AS n FROM ah GROUP BY bits),
e AS (SELECT a.bits AS x, b.bits AS y, a.first AS fx, b.first AS fy, bit_count(xor(a.bits::BIT, b.bits::BIT)) AS d FROM c a JOIN c b ON a.bits < b.bits WHERE bit_count(xor(a.bits::BIT, b.bits::BIT)) <= 5),
w AS (SELECT x, y, fx, fy, d FROM e UNION ALL SELECT y, x, fy, fx, d FROM e)"""


@reg.query("J12 N5 N6 N7 N8", f"WITH {_PAIRS} SELECT least(fx, fy) AS a, greatest(fx, fy) AS b, CAST(d AS INTEGER) AS distance FROM e")
def hamming_pairs(spark, sf):
    """Pairs of representatives of different hashes within 5 bits; ``dups_map`` has the membership."""
    h = cut(_ahash(spark, sf))
    c = D.classes(h, "image_id", "h").select("h", "first")
    p = D.hamming_pairs(h, "h", 5)
    j = p.join(c.select(F.col("h").alias("a"), F.col("first").alias("fa")), "a").join(c.select(F.col("h").alias("b"), F.col("first").alias("fb")), "b")
    return j.select(F.least("fa", "fb").alias("a"), F.greatest("fa", "fb").alias("b"), "distance")


@reg.query("N9 O2 K7", f"""WITH {_PAIRS},
l AS (SELECT w.x, sum(c.n) AS others, min(w.d) AS least FROM w JOIN c ON c.bits = w.y GROUP BY w.x)
SELECT ah.image_id, c.first AS class, CAST(c.n - 1 + coalesce(l.others, 0) AS BIGINT) AS links, CAST(coalesce(CASE WHEN c.n > 1 THEN 0 ELSE l.least END, -1) AS INTEGER) AS nearest
FROM ah JOIN c USING (bits) LEFT JOIN l ON l.x = ah.bits""")
def dups_map(spark, sf):
    """Every picture with its class, its number of near pictures and the least distance (-1 for none)."""
    d = D.duplicate_counts(cut(_ahash(spark, sf)), "image_id", "h", 5)
    return d.withColumn("nearest", F.coalesce("nearest", F.lit(-1)))


@reg.query("N13 J3", f"WITH {_PAIRS} SELECT first AS image_id FROM c WHERE n = 1 AND bits NOT IN (SELECT x FROM w)")
def neardup_drop_all(spark, sf):
    return D.kept(cut(_ahash(spark, sf)), "image_id", "h", 5, "drop_all")


@reg.query("N10", f"""WITH {_PAIRS},
nd AS (SELECT c.first AS id, coalesce(list(w.fy) FILTER (w.fy IS NOT NULL), []) AS nb FROM c LEFT JOIN w ON w.x = c.bits GROUP BY c.first),
r AS (SELECT list_reduce(list({{'id': id, 'nb': nb, 'kept': []::BIGINT[]}} ORDER BY id), lambda acc, n:
   {{'id': n.id, 'nb': n.nb, 'kept': CASE WHEN list_has_any(acc.kept, n.nb) THEN acc.kept ELSE list_append(acc.kept, n.id) END}}, {{'id': -1::BIGINT, 'nb': []::BIGINT[], 'kept': []::BIGINT[]}}) AS s FROM nd)
SELECT unnest(s.kept) AS image_id FROM r""")
def neardup_greedy(spark, sf):
    return D.kept(cut(_ahash(spark, sf)), "image_id", "h", 5, "greedy")


@reg.query("N10 N13", """
WITH RECURSIVE c AS (SELECT bits, min(image_id) AS first FROM ah GROUP BY bits),
w AS (SELECT a.first AS x, b.first AS y FROM c a JOIN c b ON a.bits <> b.bits WHERE bit_count(xor(a.bits::BIT, b.bits::BIT)) <= 5),
reach(s, t) AS (SELECT first, first FROM c UNION SELECT reach.s, w.y FROM reach JOIN w ON reach.t = w.x),
l AS (SELECT s, min(t) AS label FROM reach GROUP BY s)
SELECT DISTINCT label AS image_id FROM l""")
def neardup_components(spark, sf):
    return D.kept(cut(_ahash(spark, sf)), "image_id", "h", 5, "component_min")


@reg.query("N13b O11")
def neardup_random_groups(spark, sf):
    """The approximate way, seeded: three rounds of groups of 256; no SQL (its result depends on the seed)."""
    return D.random_groups(_ahash(spark, sf), "image_id", "h", 5, 256, 3, 7)


_COS = """q AS (SELECT vec_id AS query, label AS ql, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 20 = 0),
s AS (SELECT query, ql, vec_id AS name, label, list_cosine_similarity(v, embedding::DOUBLE[]) AS score FROM q, embeddings WHERE query <> vec_id)"""


@reg.query("N11 J13 N12", f"WITH {_COS} SELECT query, name, round(score, 6) AS score FROM s WHERE score >= 0.3")
def cosine_pairs(spark, sf):
    """Every vector whose id is divisible by 20 against all vectors, exact, at 0.3 or more."""
    e = table(spark, sf, "embeddings")
    return D.cosine_search(e, e.filter("vec_id % 20 = 0"), "vec_id", "embedding", 0.3).withColumn("score", F.round("score", 6))


def _hits(spark, sf, threshold):
    from pyspark.sql import Window

    e = table(spark, sf, "embeddings")
    s = D.cosine_search(e, e.filter("vec_id % 20 = 0"), "vec_id", "embedding", threshold)
    labels = e.select(F.col("vec_id").alias("name"), "label")
    ql = e.select(F.col("vec_id").alias("query"), F.col("label").alias("ql"))
    j = s.join(labels, "name").join(ql, "query")
    w = Window.partitionBy("query").orderBy(F.desc(F.round("score", 9)), "name")
    return j.select("query", F.row_number().over(w).alias("rank"), (F.col("label") == F.col("ql")).alias("relevant"))


@reg.query("N14 A37 W4 W5", f"""WITH {_COS},
t AS (SELECT query, count(*) FILTER (label = ql) AS correct FROM s GROUP BY query),
h AS (SELECT query, (label = ql)::INT AS rel, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, name) AS rk FROM s WHERE score >= 0.1),
f AS (SELECT *, sum(rel) OVER (PARTITION BY query ORDER BY rk) AS cum FROM h),
p AS (SELECT query, count(*) AS retrieved, sum(rel) AS hits, sum(CASE WHEN rel = 1 THEN cum / rk END) AS prec, sum(rel / log2(rk + 1)) AS dcg, sum(CASE WHEN rel = 1 THEN 1 / log2(cum + 1) END) AS idcg FROM f GROUP BY query),
m AS (SELECT query, correct, coalesce(retrieved, 0) AS n, coalesce(hits, 0) AS hits, prec, dcg, idcg FROM t LEFT JOIN p USING (query))
SELECT query, round(CASE WHEN correct = 0 AND n = 0 THEN 1 WHEN correct = 0 OR n = 0 THEN 0 ELSE coalesce(prec / correct, 0) END, 6) AS ap,
  round(CASE WHEN correct = 0 AND n = 0 THEN 1 WHEN correct = 0 OR n = 0 THEN 0 WHEN hits > 0 THEN dcg / idcg ELSE 0 END, 6) AS ndcg,
  round(CASE WHEN correct = 0 AND n = 0 THEN 1 WHEN correct = 0 OR n = 0 THEN 0 ELSE hits / (correct + n - hits) END, 6) AS jaccard FROM m""")
def ir_metrics(spark, sf):
    """Average precision, NDCG and Jaccard of the cosine search, the label being the truth."""
    e = table(spark, sf, "embeddings")
    per = e.groupBy("label").agg((F.count("*") - 1).alias("correct"))
    truth = e.filter("vec_id % 20 = 0").join(per, "label").select(F.col("vec_id").alias("query"), "correct")
    m = D.retrieval_metrics(truth, _hits(spark, sf, 0.1))
    return m.select("query", *[F.round(c, 6).alias(c) for c in ("ap", "ndcg", "jaccard")])


@reg.query("N15 A38 N16", """
WITH h AS (SELECT image_id, bits, coalesce(sample_key, 'none') AS k FROM ah JOIN (SELECT image_id, min(sample_key) AS sample_key FROM image_grids GROUP BY 1) USING (image_id)),
t AS (SELECT sum(n * (n - 1) // 2) AS real FROM (SELECT k, count(*) AS n FROM h GROUP BY k)),
f AS (SELECT sum(n * (n - 1) // 2) AS found FROM (SELECT bits, count(*) AS n FROM h GROUP BY bits)),
r AS (SELECT sum(n * (n - 1) // 2) AS hit FROM (SELECT bits, k, count(*) AS n FROM h GROUP BY ALL)),
x AS (SELECT count(*) * (count(*) - 1) // 2 AS total FROM h),
z AS (SELECT hit, found, real, total, hit / found AS pp, hit / real AS rp, (total - real - found + hit) / (total - found) AS pn, (total - real - found + hit) / (total - real) AS rn FROM t, f, r, x)
SELECT round(CASE WHEN found > 0 THEN pp ELSE 0 END, 6) AS precision_pos, round(CASE WHEN real > 0 THEN rp ELSE 0 END, 6) AS recall_pos,
  round(CASE WHEN coalesce(pp, 0) + coalesce(rp, 0) > 0 THEN 2 * pp * rp / (pp + rp) ELSE 0 END, 6) AS f1_pos, CAST(real AS BIGINT) AS support_pos,
  round(pn, 6) AS precision_neg, round(rn, 6) AS recall_neg, round(2 * pn * rn / (pn + rn), 6) AS f1_neg, CAST(total - real AS BIGINT) AS support_neg FROM z""")
def pair_prf(spark, sf):
    """Both classes over all unordered pairs, from group sizes alone: same sample is true, same hash is found."""
    k = _images(spark, sf).groupBy("image_id").agg(F.coalesce(F.min("sample_key"), F.lit("none")).alias("k"))
    h = _ahash(spark, sf).join(k, "image_id").select("bits", "k")
    cells = h.groupBy("bits", "k").agg(F.count("*").alias("n"))

    def pairs(n):
        return F.sum((F.col(n) * (F.col(n) - 1) / 2).cast("bigint"))

    by_k = cells.groupBy("k").agg(F.sum("n").alias("n")).agg(pairs("n").alias("real"), F.sum("n").alias("total"))
    by_b = cells.groupBy("bits").agg(F.sum("n").alias("n")).agg(pairs("n").alias("found"))
    hit = cells.agg(pairs("n").alias("hit"))
    one = by_k.join(F.broadcast(by_b), F.lit(True)).join(F.broadcast(hit), F.lit(True))  # single rows
    return one.select(*D.pair_classification(F.col("total"), F.col("real"), F.col("found"), F.col("hit")))


@reg.query("J3", """
WITH d AS (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY text) AS first FROM documents WHERE text IS NOT NULL)
SELECT doc_id FROM d WHERE doc_id = first UNION ALL SELECT doc_id FROM documents WHERE text IS NULL""")
def dedup_exact_docs(spark, sf):
    """Documents without those that repeat an earlier text (left anti by digest); null texts stay."""
    d = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("k"))
    first = d.filter("k IS NOT NULL").groupBy("k").agg(F.min("doc_id").alias("doc_id"))
    return first.select("doc_id").unionByName(d.filter("k IS NULL").select("doc_id"))


@reg.query("N16 U2 U3", f"""WITH {_PAIRS},
m AS (SELECT fx AS a, fy AS b FROM w) SELECT count(*) AS rows, count(*) FILTER (NOT EXISTS (SELECT 1 FROM m o WHERE o.a = m.b AND o.b = m.a)) AS asymmetric,
 count(*) FILTER (b NOT IN (SELECT first FROM c)) AS unknown FROM m""")
def map_validation(spark, sf):
    """The checks of a duplicate map: symmetric, and no duplicate outside its keys."""
    h = cut(_ahash(spark, sf))
    m = cut(D.both_ways(D.hamming_pairs(h, "h", 5)).select("src", "dst"))
    back = m.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    keys = h.select(F.col("h").alias("dst")).distinct()
    counts = [m.agg(F.count("*").alias("rows")), m.exceptAll(back).agg(F.count("*").alias("asymmetric")), m.join(keys, "dst", "left_anti").agg(F.count("*").alias("unknown"))]
    return counts[0].join(F.broadcast(counts[1]), F.lit(True)).join(F.broadcast(counts[2]), F.lit(True))


QUERIES, ORACLES = reg.queries, reg.oracles
