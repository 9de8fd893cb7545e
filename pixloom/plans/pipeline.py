"""The corpus pipeline over the delivered members, documents and question-answer pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixloom.functions import text as T
from pixloom.operators import corpus as C
from pixloom.operators import ordinal as O
from pixloom.plans.corpus import _VALID
from pixloom.plans.registry import Registry
from pixloom.session import table
from pixloom.tables import sample_key, sample_suffix, valid_members

PRELUDE = _VALID + """, k AS (SELECT *, regexp_extract(fname, '^([^_.]*)', 1) AS key, lower(regexp_extract(fname, '\\.([^.]*)$', 1)) AS suffix FROM v)"""
reg = Registry(PRELUDE)


def members(spark, sf, *cols):
    return valid_members(table(spark, sf, "shard_members"), *cols)


@reg.query("S1 F3 A40", """
SELECT folder, suffix, count(*) AS n, CAST(sum(coalesce(octet_length(data), 0)) AS BIGINT) AS bytes, count(*) FILTER (regexp_matches(fname, '^\\S+\\.jpg$')) AS plain_jpg FROM k GROUP BY ALL""")
def member_scan(spark, sf):
    """Valid members of each folder by suffix."""
    m = table(spark, sf, "shard_members").withColumn("n", F.coalesce(F.length("data"), F.lit(0)))
    return valid_members(m, "n").groupBy("folder", sample_suffix("fname").alias("suffix")).agg(
        F.count("*").alias("n"), F.sum("n").cast("bigint").alias("bytes"), F.count_if(F.col("fname").rlike(r"^\S+\.jpg$")).alias("plain_jpg"))


@reg.query("S3 W2 S2", """
WITH l AS (SELECT folder, shard, pos, fname, key, suffix, CASE WHEN key = lag(key) OVER w THEN 0 ELSE 1 END AS new FROM k WINDOW w AS (PARTITION BY folder, shard ORDER BY pos, fname)),
r AS (SELECT *, sum(new) OVER (PARTITION BY folder, shard ORDER BY pos, fname ROWS UNBOUNDED PRECEDING) AS run FROM l)
SELECT folder, shard, CAST(run AS BIGINT) AS run, key, count(*) AS n, string_agg(DISTINCT suffix, ',' ORDER BY suffix) AS suffixes, count(*) > count(DISTINCT suffix) AS doubled FROM r GROUP BY folder, shard, run, key""")
def sample_grouping(spark, sf):
    return C.sample_runs(members(spark, sf, "pos"))


@reg.query("S4", """
WITH h AS (SELECT DISTINCT folder, TRY_CAST(regexp_extract(shard, '^([0-9]+)\\.tar$', 1) AS BIGINT) AS n FROM v),
t AS (SELECT folder, unnest(range(0, max(n) + 1)) AS n FROM h WHERE n IS NOT NULL GROUP BY folder)
SELECT folder, printf('%08d.tar', n) AS shard FROM t WHERE (folder, n) NOT IN (SELECT folder, n FROM h WHERE n IS NOT NULL)""")
def missing_shards(spark, sf):
    from pixloom.tables import bare_folder

    listing = table(spark, sf, "shard_members").select(bare_folder("wds_shards_folder").alias("folder"), "shard").distinct()
    return C.missing_shards(listing)


@reg.query("S5 K2 M13", """
SELECT folder, shard, replace(fname, '.txt', '.jpg') AS name, md5(coalesce(decode(data), '')) AS hash FROM k WHERE suffix = 'txt' AND fname LIKE '%.txt'""")
def hash_map(spark, sf):
    """Text members as a map from picture name to the digest of their content."""
    t = members(spark, sf, "data").filter(F.col("fname").like("%.txt"))
    return t.select("folder", "shard", F.replace(F.col("fname"), F.lit(".txt"), F.lit(".jpg")).alias("name"), F.md5(F.coalesce("data", F.lit(b""))).alias("hash"))


_SIZES = "s AS (SELECT folder, shard, key, CAST(json_extract_string(decode(data), '$.w') AS INTEGER) AS w, CAST(json_extract_string(decode(data), '$.h') AS INTEGER) AS h FROM k WHERE suffix = 'json')"


@reg.query("F1 F2", f"""WITH {_SIZES},
c AS (SELECT folder, CASE WHEN w IS NULL OR h IS NULL THEN NULL WHEN h < 448 OR w < 448 THEN 'min' WHEN h > 5376 OR w > 5376 THEN 'max' ELSE 'keep' END AS verdict FROM s)
SELECT folder, count(*) AS total, count(*) FILTER (verdict = 'keep') AS kept, count(*) FILTER (verdict = 'min') AS too_small, count(*) FILTER (verdict = 'max') AS too_large,
  round(100.0 * count(*) FILTER (verdict IN ('min', 'max')) / count(*), 4) AS filtered_percent FROM c GROUP BY folder""")
def resolution_filter_counts(spark, sf):
    """Verdicts of the pixel filter by folder; the parts add up to the readable records."""
    s = C.picture_sizes(members(spark, sf, "data"))
    c = s.select("folder", C.resolution_verdict(F.col("w"), F.col("h")).alias("v"))
    n = lambda v: F.count_if(F.col("v") == v)
    return c.groupBy("folder").agg(F.count("*").alias("total"), n("keep").alias("kept"), n("min").alias("too_small"), n("max").alias("too_large"),
                                   F.round(100 * (n("min") + n("max")) / F.count("*"), 4).alias("filtered_percent"))


@reg.query("T3 K6 F15", f"""WITH {_SIZES}
SELECT folder, shard, key, least(w, h) AS shorter, greatest(w, h) AS longer, round_even(w / h * 10000, 0) / 10000 AS ratio, w::BIGINT * h AS area,
  CASE WHEN w <= 500 THEN '<=500' WHEN w <= 1000 THEN '500-1000' WHEN w <= 2000 THEN '1000-2000' ELSE '>2000' END AS bin FROM s WHERE w IS NOT NULL AND h IS NOT NULL""")
def picture_statistics(spark, sf):
    """Statistics of every readable picture, with right-closed bins of the width."""
    s = C.picture_sizes(members(spark, sf, "data")).filter("w IS NOT NULL AND h IS NOT NULL")
    bins = F.when(F.col("w") <= 500, "<=500").when(F.col("w") <= 1000, "500-1000").when(F.col("w") <= 2000, "1000-2000").otherwise(">2000")
    return s.withColumn("x", C.picture_stats(F.col("w"), F.col("h"))).select("folder", "shard", "key", "x.*", bins.alias("bin"))


_TRIPLES = """t AS (SELECT folder, shard, key, count(*) FILTER (suffix = 'txt' AND data IS NOT NULL) > 0 AS txt,
  count(*) FILTER (suffix = 'json' AND data IS NOT NULL) > 0 AS js, count(*) FILTER (suffix IN ('jpg', 'jpeg', 'png') AND data IS NOT NULL) > 0 AS img FROM k GROUP BY ALL)"""


@reg.query("F4 F5", f"WITH {_TRIPLES} SELECT folder, count(*) AS samples, count(*) FILTER (txt AND js AND img) AS whole, count(*) FILTER (NOT (txt AND js AND img)) AS dropped FROM t GROUP BY folder")
def corrupt_pairs(spark, sf):
    """Samples with a missing or null part leave with all their members; only presence and size are shuffled, no content."""
    suffix = sample_suffix("fname")
    m = members(spark, sf, "data").filter("data IS NOT NULL AND is_valid_utf8(IF(fname LIKE '%.txt' OR fname LIKE '%.json', CAST(data AS STRING), ''))")
    part = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    whole = m.groupBy("folder", "shard", sample_key("fname").alias("key")).agg(
        (part(suffix == "txt") & part(suffix == "json") & part(suffix.isin(*C.IMAGE))).alias("ok"))
    every = members(spark, sf).select("folder", "shard", sample_key("fname").alias("key")).distinct()
    j = every.join(whole, ["folder", "shard", "key"], "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    return j.groupBy("folder").agg(F.count("*").alias("samples"), F.count_if("ok").alias("whole"), F.count_if(~F.col("ok")).alias("dropped"))


@reg.query("J1 F16", """
WITH i AS (SELECT folder, shard, key, min(fname) AS img FROM k WHERE suffix IN ('jpg', 'jpeg', 'png') GROUP BY ALL), t AS (SELECT folder, shard, key, min(fname) AS txt FROM k WHERE suffix = 'txt' GROUP BY ALL)
SELECT folder, shard, count(*) AS pairs, count(*) FILTER (split_part(img, '.', 1) = split_part(txt, '.', 1)) AS equal_stems FROM i JOIN t USING (folder, shard, key) GROUP BY folder, shard""")
def image_text_join(spark, sf):
    """Pictures beside their texts by stem, with the stem check, from one aggregate instead of a join."""
    suffix = sample_suffix("fname")
    m = members(spark, sf)
    p = m.groupBy("folder", "shard", sample_key("fname").alias("key")).agg(
        F.min(F.when(suffix.isin(*C.IMAGE), F.col("fname"))).alias("img"), F.min(F.when(suffix == "txt", F.col("fname"))).alias("txt"))
    stem = lambda c: F.substring_index(c, ".", 1)
    return p.filter("img IS NOT NULL AND txt IS NOT NULL").groupBy("folder", "shard").agg(F.count("*").alias("pairs"), F.count_if(stem("img") == stem("txt")).alias("equal_stems"))


@reg.query("W1 K3 W8 W9", """
WITH s AS (SELECT DISTINCT folder, shard, key FROM k), o AS (SELECT *, row_number() OVER (ORDER BY folder, shard, key) - 1 AS ord, count(*) OVER () AS n FROM s)
SELECT folder, shard, key, ord // 1000 AS new_shard, ord % 1000 AS "offset", printf('%05d%04d', ord // 1000, ord % 1000) AS new_key, CAST(ord % 7 AS INTEGER) AS rank, CAST(ntile(7) OVER (ORDER BY ord) - 1 AS INTEGER) AS worker FROM o""")
def reshard_manifest(spark, sf):
    """All samples renumbered into shards of 1 000, with round-robin ranks and an even split over 7 workers."""
    s = members(spark, sf).select("folder", "shard", sample_key("fname").alias("key")).distinct()
    r = C.reshard(s, ["folder", "shard", "key"], 1000)
    n = F.broadcast(s.agg(F.count("*").alias("n")))  # one row
    o = F.col("new_shard") * 1000 + F.col("offset")
    return r.join(n, F.lit(True)).withColumns({"rank": (o % 7).cast("int"), "worker": O.even_split(F.col("n"), o, 7)}).drop("n")


@reg.query("K5 K4", "SELECT folder, shard, count(*) AS n, md5(string_agg(fname, ',' ORDER BY pos, fname)) AS digest FROM v GROUP BY folder, shard")
def shard_manifest(spark, sf):
    """Names of each shard in archive order (as a digest of the list)."""
    m = C.manifest(members(spark, sf, "pos"))
    return m.select("folder", "shard", "n", F.md5(F.array_join("names", ",")).alias("digest"))


@reg.query("O6", """
WITH z AS (SELECT folder, shard, count(DISTINCT key) AS n, md5(folder || '|' || shard || '|42') AS h FROM k GROUP BY folder, shard),
c AS (SELECT *, sum(n) OVER (ORDER BY h, folder, shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM z)
SELECT folder, shard, n, CAST(coalesce(before, 0) AS BIGINT) AS before FROM c WHERE coalesce(before, 0) < 2000""")
def cluster_sample(spark, sf):
    """Whole shards in a seeded order until 2 000 samples are reached."""
    s = members(spark, sf).select("folder", "shard", sample_key("fname").alias("key")).distinct()
    sizes = s.filter("folder IS NOT NULL").groupBy("folder", "shard").agg(F.count("*").alias("n"))
    return O.sample_clusters(sizes, ["folder", "shard"], "n", 2000, 42)


@reg.query("J2 U2", """
WITH d AS (SELECT sample_key, text FROM documents WHERE sample_key IS NOT NULL), n AS (SELECT DISTINCT sample_key FROM d WHERE contains(text, '<|native_caption_start|>')),
r AS (SELECT DISTINCT sample_key FROM d WHERE contains(text, '<|recaption_start|>'))
SELECT coalesce(n.sample_key, r.sample_key) AS sample_key, n.sample_key IS NOT NULL AS in_a, r.sample_key IS NOT NULL AS in_b FROM n FULL JOIN r USING (sample_key)""")
def native_recap_diff(spark, sf):
    """Samples with a native and with a new caption: which sides hold each."""
    d = table(spark, sf, "documents").filter("sample_key IS NOT NULL")
    side = lambda tag: d.filter(F.contains("text", F.lit(tag))).select("sample_key")
    return C.difference(side(T.NATIVE[0]), side(T.RECAPTION[0]), ["sample_key"])


@reg.query("J2 J4 A43", """
WITH d AS (SELECT sample_key, min_by(text, doc_id) AS caption FROM documents WHERE sample_key IS NOT NULL AND text IS NOT NULL GROUP BY sample_key),
q AS (SELECT DISTINCT qa_id, sample_key FROM recaption_qa)
SELECT qa_id, q.sample_key, md5(caption) AS caption, caption IS NULL AS missing FROM q LEFT JOIN d USING (sample_key)""")
def recaption_join(spark, sf):
    """The first caption of the sample of each question-answer pair; missing ones are flagged, not dropped."""
    d = table(spark, sf, "documents").filter("sample_key IS NOT NULL AND text IS NOT NULL").groupBy("sample_key").agg(F.min_by("text", "doc_id").alias("caption"))
    q = table(spark, sf, "recaption_qa").select("qa_id", "sample_key").distinct()
    return q.join(d.select("sample_key", F.md5("caption").alias("caption")), "sample_key", "left").withColumn("missing", F.col("caption").isNull())


@reg.query("J5 W3 S14", """
WITH a AS (SELECT sample_key AS id, min_by(qa_id, rank_no::BIGINT * 1000000000 + qa_id) AS ord FROM recaption_qa WHERE sample_key IS NOT NULL GROUP BY sample_key)
SELECT d.doc_id, a.ord AS qa_id FROM documents d JOIN a ON d.sample_key = a.id""")
def annotation_join(spark, sf):
    """Equal ids, the first annotation in file order, unmatched ones dropped."""
    a = table(spark, sf, "recaption_qa").filter("sample_key IS NOT NULL").groupBy(F.col("sample_key")).agg(F.min_by("qa_id", F.struct("rank_no", "qa_id")).alias("qa_id"))
    return table(spark, sf, "documents").select("doc_id", "sample_key").join(a, "sample_key").select("doc_id", "qa_id")


@reg.query("J6 W3", """
WITH a AS (SELECT item_index AS ord, option_a AS stem FROM bench_items WHERE option_a IS NOT NULL AND option_a <> '')
SELECT d.doc_id AS id, min(a.ord) AS ord FROM documents d JOIN a ON contains(d.text, a.stem) GROUP BY d.doc_id""")
def contains_join_first(spark, sf):
    """The first option text contained in each document."""
    a = table(spark, sf, "bench_items").select(F.col("item_index").alias("ord"), F.col("option_a").alias("stem"))
    return C.contains_first(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), a)


@reg.query("E1", """
WITH o AS (SELECT *, list_filter([option_a, option_b, option_c, option_d], lambda x: x IS NOT NULL) AS os FROM bench_items WHERE rotation_ok),
x AS (SELECT *, len(os) AS k, (len(os) >= 2 AND len(list_filter([option_a, option_b, option_c, option_d][1:len(os)], lambda x: x IS NOT NULL)) = len(os)) AS whole FROM o),
r AS (SELECT *, unnest(range(0, CASE WHEN whole THEN k ELSE 1 END)) AS rotation FROM x)
SELECT item_index + rotation * 1000000 AS item_index, item_index AS g_index, CAST(rotation AS INTEGER) AS rotation,
  CASE WHEN whole AND k > 0 THEN os[(rotation + 0) % k + 1] ELSE option_a END AS option_a, CASE WHEN whole AND k > 1 THEN os[(rotation + 1) % k + 1] ELSE option_b END AS option_b,
  CASE WHEN whole AND k > 2 THEN os[(rotation + 2) % k + 1] ELSE option_c END AS option_c, CASE WHEN whole AND k > 3 THEN os[(rotation + 3) % k + 1] ELSE option_d END AS option_d,
  CASE WHEN whole AND answer IN ('A', 'B', 'C', 'D') THEN chr(CAST((ascii(answer) - 65 - rotation + k) % k + 65 AS INTEGER)) ELSE answer END AS answer FROM r""".replace("WHERE rotation_ok", "WHERE item_index = g_index"))
def circular_expand(spark, sf):
    """All rotations of the base items."""
    b = table(spark, sf, "bench_items").filter("item_index = g_index").drop("g_index")
    return C.circular(b).select("item_index", "g_index", "rotation", "option_a", "option_b", "option_c", "option_d", "answer")


@reg.query("E4 F6", """
WITH good AS (SELECT DISTINCT item_index FROM predictions WHERE model = 'fir-mini' AND prediction IS NOT NULL AND NOT contains(prediction, 'Failed to obtain answer via API'))
SELECT item_index, CAST((row_number() OVER (ORDER BY item_index) - 1) % 4 AS INTEGER) AS rank FROM bench_items WHERE item_index NOT IN (SELECT item_index FROM good)""")
def remaining_work(spark, sf):
    """Items one model has still to answer, dealt to four workers."""
    done = table(spark, sf, "predictions").filter("model = 'fir-mini'").select("item_index", "prediction")
    left = C.remaining(table(spark, sf, "bench_items").select("item_index"), done, "item_index", "prediction", "Failed to obtain answer via API")
    return O.ordinal(left, ["item_index"]).select("item_index", (F.col("ord") % 4).cast("int").alias("rank"))


@reg.query("E2 J17 U1", """
WITH u AS (SELECT 'bench' AS part, item_index AS original_index, question FROM bench_items UNION ALL SELECT 'qa', qa_id, question FROM (SELECT qa_id, min(question) AS question FROM recaption_qa GROUP BY qa_id))
SELECT part, original_index, row_number() OVER (ORDER BY part, original_index) - 1 AS idx, md5(coalesce(question, '')) AS digest FROM u""")
def concat_parts(spark, sf):
    """Two sets under one new index, each row remembering its part and old index."""
    b = table(spark, sf, "bench_items").select(F.lit("bench").alias("part"), F.col("item_index").alias("original_index"), "question")
    q = table(spark, sf, "recaption_qa").groupBy("qa_id").agg(F.min("question").alias("question")).select(F.lit("qa").alias("part"), F.col("qa_id").alias("original_index"), "question")
    u = b.unionByName(q).withColumn("digest", F.md5(F.coalesce("question", F.lit("")))).drop("question")
    return O.ordinal(u, ["part", "original_index"], "idx")


@reg.query("J11", "SELECT a.item_index, b.item_index AS source, coalesce(a.image_path, b.image_path) AS image_path FROM bench_items a LEFT JOIN bench_items b ON a.g_index = b.item_index")
def back_reference(spark, sf):
    """Rotated rows take the picture of their base row where they have none."""
    b = table(spark, sf, "bench_items").select("item_index", "g_index", "image_path")
    base = b.select(F.col("item_index").alias("source"), F.col("image_path").alias("base_path"))
    return b.join(base, b.g_index == base.source, "left").select("item_index", "source", F.coalesce("image_path", "base_path").alias("image_path"))


@reg.query("F9 F12 F14", """
SELECT item_index, (SELECT bool_and(TRY_CAST(item_index AS BIGINT) IS NOT NULL) FROM bench_items) AS all_int, coalesce(option_a, answer) AS "A", CASE WHEN option_a IS NULL THEN 'Other Answers' ELSE option_b END AS "B",
  CASE WHEN coalesce(answer, '') NOT IN ('A', 'B', 'C', 'D') THEN 'A' ELSE answer END AS gt FROM bench_items""")
def open_to_choice(spark, sf):
    """Open items as two-option ones; the index is an integer when every value can be one."""
    b = table(spark, sf, "bench_items").withColumn("i", F.col("item_index").cast("string"))
    ok = F.broadcast(b.agg(F.bool_and(F.col("i").try_cast("bigint").isNotNull()).alias("all_int")))
    j = b.join(ok, F.lit(True))
    return j.select("item_index", "all_int", F.coalesce("option_a", "answer").alias("A"), F.when(F.col("option_a").isNull(), "Other Answers").otherwise(F.col("option_b")).alias("B"),
                    F.when(F.col("answer").isin("A", "B", "C", "D"), F.col("answer")).otherwise("A").alias("gt"))


@reg.query("O7 O8 O12", """
WITH s AS (SELECT doc_id, md5(doc_id || '|7') AS h FROM documents), o AS (SELECT doc_id, h, row_number() OVER (ORDER BY h, doc_id) - 1 AS ord, count(*) OVER () AS n FROM s)
SELECT doc_id, ord, CAST(ord % 3 AS INTEGER) AS rank, ord < n // 3 * 3 AS in_epoch, CAST(('0x' || left(h, 8))::BIGINT % 4 AS INTEGER) AS prompt FROM o""")
def epoch_order(spark, sf):
    """A seeded shuffle dealt to three ranks, cut to equal lengths, with a seeded prompt for each row."""
    d = table(spark, sf, "documents").select("doc_id").withColumn("h", O.shuffle_key("doc_id", seed=7))
    n = F.broadcast(d.agg(F.count("*").alias("n")))
    o = O.ordinal(d, ["h", "doc_id"]).join(n, F.lit(True))
    return o.select("doc_id", "ord", (F.col("ord") % 3).cast("int").alias("rank"), (F.col("ord") < F.floor(F.col("n") / 3) * 3).alias("in_epoch"), O.draw(F.col("h"), 4).alias("prompt"))


@reg.query("O9", """
WITH s AS (SELECT doc_id, coalesce(length(text), 0) AS len, md5(doc_id || '|3') AS h FROM documents), o AS (SELECT *, (row_number() OVER (ORDER BY h, doc_id) - 1) // 64 AS megabatch FROM s)
SELECT megabatch, doc_id, len, CAST(row_number() OVER (PARTITION BY megabatch ORDER BY len DESC, doc_id) - 1 AS INTEGER) AS slot FROM o""")
def length_grouped(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("len"))
    return O.length_groups(d, "len", "doc_id", 16, 4, 3).select("megabatch", "doc_id", "len", "slot")


@reg.query("O9")
def length_chunks(spark, sf):
    """The megabatches dealt greedily to four workers; no SQL, tested against the rule itself."""
    d = table(spark, sf, "documents").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("len"))
    return O.even_chunks(O.length_groups(d, "len", "doc_id", 16, 4, 3), "len", "doc_id", 4)


@reg.query("O10", """
SELECT kind, count(*) AS n FROM (SELECT CASE WHEN b < 3 THEN 'caption' WHEN b < 6 THEN 'vqa' ELSE 'mcq' END AS kind FROM (SELECT ('0x' || left(md5(doc_id || '|11'), 8))::BIGINT % 10 AS b FROM documents)) GROUP BY kind""")
def weighted_mix(spark, sf):
    """Documents in three kinds by weights 3 : 3 : 4."""
    b = O.draw(O.shuffle_key("doc_id", seed=11), 10)
    return table(spark, sf, "documents").select(F.when(b < 3, "caption").when(b < 6, "vqa").otherwise("mcq").alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@reg.query("W7 O5", """
WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS ord FROM documents) SELECT ord // 150 AS grp, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last FROM o GROUP BY ALL""")
def contiguous_groups(spark, sf):
    o = O.ordinal(table(spark, sf, "documents").select("doc_id"), ["doc_id"])
    return o.groupBy(F.floor(F.col("ord") / 150).alias("grp")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


@reg.query("O5 S8", """
SELECT folder, count(DISTINCT shard) AS shards, string_agg(DISTINCT suffix, ',' ORDER BY suffix) AS suffixes FROM k WHERE contains(fname, '0') AND NOT contains(fname, '.json') GROUP BY folder""")
def listing(spark, sf):
    """Names that hold one pattern and not another, with the sorted set of suffixes."""
    m = members(spark, sf).filter(F.contains("fname", F.lit("0")) & ~F.contains("fname", F.lit(".json")))
    return m.groupBy("folder").agg(F.count_distinct("shard").alias("shards"), F.array_join(F.array_sort(F.collect_set(sample_suffix("fname"))), ",").alias("suffixes"))


QUERIES, ORACLES = reg.queries, reg.oracles
