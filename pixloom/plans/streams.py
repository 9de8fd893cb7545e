"""Streaming queries: each drains a real stream and must equal its SQL over the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixloom.operators import neardup as D
from pixloom.plans.registry import Registry
from pixloom.plans.scored import bare
from pixloom.session import cut, table
from pixloom.streaming import tables as S
from pixloom.tables import bare_folder, micros

reg = Registry()


@reg.query("ST4 ST7", "SELECT event_type, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start_us, count(*) AS n FROM events GROUP BY ALL")
def stream_tumbling(spark, sf):
    w = S.drain_complete(S.tumbling(S.stream_table(spark, sf, "events"), "ts", "1 hour", "event_type"))
    return w.select("event_type", micros("w.start").alias("start_us"), "n")


@reg.query("ST4", """
WITH e AS (SELECT event_type, ts, unnest([0, 1, 2, 3]) AS k FROM events) SELECT event_type, epoch_us(time_bucket(INTERVAL 15 MINUTE, ts)) - k::BIGINT * 900000000 AS start_us, count(*) AS n FROM e GROUP BY ALL""")
def stream_sliding(spark, sf):
    w = S.drain_complete(S.tumbling(S.stream_table(spark, sf, "events"), "ts", "1 hour", "event_type", slide="15 minutes"))
    return w.select("event_type", micros("w.start").alias("start_us"), "n")


@reg.query("ST4", """
WITH o AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w < 1800000000 THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o)
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 1800000000 AS end_us, count(*) AS n FROM g GROUP BY user_id, k""")
def stream_session(spark, sf):
    w = S.drain_complete(S.sessions(S.stream_table(spark, sf, "events"), "ts", "30 minutes", "user_id"))
    return w.select("user_id", micros("w.start").alias("start_us"), micros("w.end").alias("end_us"), "n")


@reg.query("ST2", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf):
    return S.drain(S.first_seen(S.stream_table(spark, sf, "events"), ["user_id", "event_type"], "ts", "365 days").select("user_id", "event_type"))


@reg.query("ST1", """
SELECT list_filter(string_split(wds_shards_folder, '/'), lambda x: trim(x) <> '')[-1] AS folder, count(*) AS members, CAST(sum(coalesce(octet_length(data), 0)) AS BIGINT) AS bytes FROM shard_members GROUP BY 1""")
def stream_ingest(spark, sf):
    """Deliveries taken in as they arrive, counted by folder."""
    s = S.stream_table(spark, sf, "shard_members").select(bare_folder("wds_shards_folder").alias("folder"), F.coalesce(F.length("data"), F.lit(0)).alias("b"))
    return S.drain_complete(s.groupBy("folder").agg(F.count("*").alias("members"), F.sum("b").cast("bigint").alias("bytes")))


@reg.query("ST5", """
SELECT b.category, count(*) AS n, CAST(sum(coalesce(lower(translate(p.prediction, ' ().', '')) = lower(translate(b.answer, ' ().', '')), false)::INT) AS BIGINT) AS hits
FROM predictions p JOIN bench_items b USING (item_index) WHERE b.answer IS NOT NULL GROUP BY b.category""")
def stream_accuracy(spark, sf):
    """Running accuracy by category over every export, from a stream joined with the static items."""
    b = table(spark, sf, "bench_items").filter("answer IS NOT NULL").select("item_index", F.col("answer").alias("truth"), F.col("category").alias("item_category"))
    p = S.stream_table(spark, sf, "predictions").select("item_index", "prediction").join(b, "item_index")
    hit = F.coalesce((bare("prediction") == bare("truth")).cast("int"), F.lit(0))
    return S.drain_complete(p.groupBy(F.col("item_category").alias("category")).agg(F.count("*").alias("n"), F.sum(hit).alias("hits")))


@reg.query("ST6", """
WITH l AS (SELECT user_id, list({'us': epoch_us(ts), 'id': event_id} ORDER BY epoch_us(ts), event_id) AS es FROM events GROUP BY user_id),
r AS (SELECT user_id, list_reduce(list_transform(es, lambda e: {'us': e.us, 'id': e.id, 'last': NULL::BIGINT, 'kept': []::BIGINT[]}),
  lambda a, e: CASE WHEN a.last IS NULL OR e.us - a.last >= 86400000000 THEN {'us': e.us, 'id': e.id, 'last': e.us, 'kept': list_append(a.kept, e.id)} ELSE {'us': e.us, 'id': e.id, 'last': a.last, 'kept': a.kept} END,
  {'us': 0::BIGINT, 'id': -1::BIGINT, 'last': NULL::BIGINT, 'kept': []::BIGINT[]}) AS s FROM l)
SELECT user_id, unnest(s.kept) AS event_id FROM r""")
def stream_greedy(spark, sf):
    """First events of each user at least a day apart, with one time of state for each user."""
    return S.drain(S.spaced(S.stream_table(spark, sf, "events"), "user_id", "ts", "event_id", 86_400.0))


@reg.query("ST3", """
WITH v AS (SELECT DISTINCT image_id, origin, h, w, image FROM image_grids WHERE image IS NOT NULL AND h > 0 AND w > 0 AND h % 8 = 0 AND w % 8 = 0 AND len(image) = h * w),
px AS (SELECT image_id, origin, h, w, image, unnest(range(0, h * w)) AS k FROM v),
cell AS (SELECT image_id, origin, (k // w) // (h // 8) AS r, (k % w) // (w // 8) AS c, sum(image[k + 1]) AS s FROM px GROUP BY ALL),
tot AS (SELECT image_id, origin, sum(s) AS t FROM cell GROUP BY ALL),
ah AS (SELECT image_id, origin, string_agg(CASE WHEN 64 * s >= t THEN '1' ELSE '0' END, '' ORDER BY r, c)::BIT AS bits FROM cell JOIN tot USING (image_id, origin) GROUP BY image_id, origin)
SELECT a.image_id, count(DISTINCT b.bits) AS near FROM (SELECT * FROM ah WHERE origin = 'recaption') a JOIN (SELECT * FROM ah WHERE origin = 'crawl') b ON bit_count(xor(a.bits, b.bits)) <= 5 GROUP BY a.image_id""")
def stream_near_reference(spark, sf):
    """Arriving pictures against a fixed reference set of hashes, joined by bands in every micro-batch."""

    def hashes(images):
        p = D.valid_pictures(images).withColumn("cells", D.block_sums(F.col("image"), F.col("h"), F.col("w")))
        return p.select("image_id", D.bits_of(D.average_hash(F.col("cells"))).alias("h"))

    reference = cut(hashes(table(spark, sf, "image_grids").filter("origin = 'crawl'")).select("h").distinct())

    def near(batch, number):
        own = cut(hashes(batch.filter("origin = 'recaption'")))
        pairs = D.hamming_join(own.select("h").distinct(), reference, "h", 5)
        return own.join(pairs.select(F.col("a").alias("h"), "b"), "h").groupBy("image_id").agg(F.count_distinct("b").alias("near"))

    found = S.drain_batches(S.stream_table(spark, sf, "image_grids"), near, "image_id bigint, near bigint")
    return found.groupBy("image_id").agg(F.max("near").alias("near"))


QUERIES, ORACLES = reg.queries, reg.oracles
