"""Near-duplicate engine: perceptual hashes, Hamming and cosine search, removal policies, retrieval metrics.

Hashes are texts of 64 bits (``0`` and ``1``) and, for the join, one long. The Hamming join
collapses equal hashes first, so a picture stored a million times is one row. Then it is an exact
equi-join on bands: of two hashes at distance ``t``, one of ``m`` bands differs in at most
``t // m`` bits, so one side offers every band with up to so many bits flipped. A pair is taken
at the first band that holds it, so nothing is de-duplicated by shuffle; AQE splits hot bands.
The join always sorts and merges: a side's size is estimated before its rows are multiplied by bands
and flips, so the broadcast that the size check would choose may be a hundred times the limit.

Defined results: null pictures, wrong lengths and sides that are no multiple of 8 have no hash;
equal hashes are at distance 0; a record never pairs with itself.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixloom.session import cut


def valid_pictures(images: DataFrame) -> DataFrame:
    """(image_id, h, w, image) of pictures whose length fits their sides, once each."""
    good = "image IS NOT NULL AND h > 0 AND w > 0 AND h % 8 = 0 AND w % 8 = 0 AND size(image) = h * w"
    return images.select("image_id", "h", "w", "image").filter(good).distinct()


def block_sums(image: Column, h: Column, w: Column, side: int = 8) -> Column:
    """Sums of the ``side x side`` equal blocks of a picture, row by row (integers, so exact)."""
    bh, bw = (h / side).cast("int"), (w / side).cast("int")

    def block(k):
        r, c = F.floor(k / side).cast("int"), (k % side).cast("int")
        rows = F.transform(F.sequence(F.lit(0), bh - 1), lambda y: F.aggregate(
            F.slice(image, (r * bh + y) * w + c * bw + 1, bw), F.lit(0), lambda a, x: a + x))
        return F.aggregate(rows, F.lit(0), lambda a, x: a + x)

    return F.transform(F.sequence(F.lit(0), F.lit(side * side - 1)), block)


def resample(image: Column, h: Column, w: Column, rows: int, cols: int) -> Column:
    """The picture at ``rows x cols`` by its nearest pixels above and to the left."""
    k = F.sequence(F.lit(0), F.lit(rows * cols - 1))
    at = lambda i: F.floor(F.floor(i / cols) * h / rows) * w + F.floor(i % cols * w / cols)
    return F.transform(k, lambda i: F.element_at(image, at(i).cast("int") + 1))


def beside(a: Column, b: Column, rows: Column) -> Column:
    """Two pictures of equal height side by side."""
    wa, wb = (F.size(a) / rows).cast("int"), (F.size(b) / rows).cast("int")
    return F.flatten(F.transform(F.sequence(F.lit(0), rows - 1), lambda r: F.concat(F.slice(a, r * wa + 1, wa), F.slice(b, r * wb + 1, wb))))


def bit_text(bits: Column) -> Column:
    return F.array_join(F.transform(bits, lambda b: F.when(b, "1").otherwise("0")), "")


def bits_of(text: Column | str) -> Column:
    """The bits of a hash text as one long (the first bit is the highest)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.conv(c, 2, -10).cast("bigint")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once a row, however often ``use`` names it and wherever Spark moves the expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def average_hash(cells: Column) -> Column:
    """A bit for each cell at or above the mean of all cells."""
    total = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)
    return once(cells, lambda c: once(total(c), lambda t: bit_text(F.transform(c, lambda x: x * F.size(c) >= t))))


def wavelet_hash(cells: Column) -> Column:
    """A bit for each cell at or above the median of all cells; block sums are the lowest Haar band up to a factor."""
    s = F.array_sort(cells)
    n = F.size(cells)
    middle = F.element_at(s, (n / 2).cast("int")) + F.element_at(s, (n / 2).cast("int") + 1)
    return bit_text(F.transform(cells, lambda x: 2 * x >= middle))


def difference_hash(image: Column, h: Column, w: Column) -> Column:
    """A bit for each cell greater than its left neighbour, on 8 rows of 9 sampled columns."""
    at = lambda r, c: F.element_at(image, (F.floor(r * h / 8) * w + F.floor(c * w / 9)).cast("int") + 1)
    k = F.sequence(F.lit(0), F.lit(63))
    return bit_text(F.transform(k, lambda i: at(F.floor(i / 8), i % 8 + 1) > at(F.floor(i / 8), i % 8)))


def _cosines(n: int = 32, keep: int = 8) -> np.ndarray:
    k, x = np.arange(keep)[:, None], np.arange(n)[None, :]
    return 2 * np.cos(np.pi * k * (2 * x + 1) / (2 * n))


@F.pandas_udf(T.StringType())
def frequency_hash(image: pd.Series, h: pd.Series, w: pd.Series) -> pd.Series:
    """Lowest 8 x 8 cosine coefficients of the picture sampled at 32 x 32, against the median of those but the first."""
    d, out = _cosines(), []
    for px, hh, ww in zip(image, h, w):
        a = np.asarray(px, dtype=np.float64).reshape(int(hh), int(ww))
        rows, cols = (np.arange(32) * int(hh)) // 32, (np.arange(32) * int(ww)) // 32
        low = (d @ a[np.ix_(rows, cols)] @ d.T).round(6).ravel()
        out.append("".join("1" if x >= np.median(low[1:]) else "0" for x in low))
    return pd.Series(out, dtype=object)


def picture_hashes(images: DataFrame) -> DataFrame:
    """(image_id, ahash, dhash, phash, whash) of every valid picture."""
    p = valid_pictures(images).withColumn("cells", block_sums(F.col("image"), F.col("h"), F.col("w")))
    return p.select(
        "image_id", average_hash(F.col("cells")).alias("ahash"), difference_hash(F.col("image"), F.col("h"), F.col("w")).alias("dhash"),
        frequency_hash("image", "h", "w").alias("phash"), wavelet_hash(F.col("cells")).alias("whash"),
    )


def _bounds(bands: int) -> list[tuple[int, int]]:
    edge = [round(64 * k / bands) for k in range(bands + 1)]
    return [(edge[k], edge[k + 1] - edge[k]) for k in range(bands)]


def hamming_pairs(hashes: DataFrame, column: str, threshold: int, bands: int | None = None) -> DataFrame:
    """(a, b, distance) of all pairs ``a < b`` of different values of the long ``column`` within ``threshold`` bits."""
    keys = hashes.select(F.col(column).alias("h")).filter("h IS NOT NULL").distinct()
    return hamming_join(keys, keys, "h", threshold, bands).filter("a < b")


def hamming_join(left: DataFrame, right: DataFrame, column: str, threshold: int, bands: int | None = None) -> DataFrame:
    """(a, b, distance): distinct values of ``left`` within ``threshold`` bits of distinct values of ``right``, equal ones too."""
    if not 0 <= threshold <= 64:
        raise ValueError("the threshold must be from 0 to 64")
    m = bands or max(1, (threshold + 1 + 1) // 2)  # at most one flipped bit a band
    flips = threshold // m
    keys, others = (x.select(F.col(column).alias("h")) for x in (left, right))
    parts = [(b, F.shiftrightunsigned("h", at).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1)), width) for b, (at, width) in enumerate(_bounds(m))]

    own = keys.select("h", F.explode(F.array(*[F.struct(F.lit(b).alias("band"), v.alias("v")) for b, v, _ in parts])).alias("x"))

    def flipped(b, v, width):
        masks = [sum(1 << i for i in c) for k in range(flips + 1) for c in itertools.combinations(range(width), k)]
        return F.transform(F.array(*[F.lit(x).cast("bigint") for x in masks]), lambda x: F.struct(F.lit(b).alias("band"), v.bitwiseXOR(x).alias("v")))

    asked = others.select("h", F.explode(F.concat(*[flipped(*p) for p in parts])).alias("x"))
    a = own.select(F.col("h").alias("a"), "x.band", "x.v")
    c = asked.select(F.col("h").alias("b"), "x.band", "x.v")
    x = F.col("a").bitwiseXOR(F.col("b"))
    pairs = a.hint("merge").join(c.hint("merge"), ["band", "v"]).withColumn("distance", F.bit_count(x)).filter(F.col("distance") <= threshold)
    near = [F.bit_count(F.shiftrightunsigned(x, at).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))) <= flips for at, width in _bounds(m)]
    first = F.array_position(F.array(*near), True) - 1
    return pairs.filter(first == F.col("band")).select("a", "b", F.col("distance").cast("int").alias("distance"))


def classes(hashes: DataFrame, name: str, column: str) -> DataFrame:
    """(h, first, n): the least name and the number of names of each value of ``column``."""
    return hashes.groupBy(F.col(column).alias("h")).agg(F.min(name).alias("first"), F.count("*").alias("n"))


def both_ways(pairs: DataFrame) -> DataFrame:
    """Each pair as two directed rows (src, dst, distance)."""
    return pairs.select("distance", F.explode(F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")), F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))).alias("e")).select("e.src", "e.dst", "distance")


def duplicate_counts(hashes: DataFrame, name: str, column: str, threshold: int) -> DataFrame:
    """(name, class, links, nearest): every record with its class, the number of records within the threshold and the
    least distance to another; records without any have 0 links and a null distance."""
    h = hashes.select(F.col(name).alias("_name"), F.col(column).alias("h"))
    c = cut(classes(h, "_name", "h"))
    e = both_ways(hamming_pairs(h, "h", threshold))
    near = e.join(c.select(F.col("h").alias("dst"), "n"), "dst").groupBy(F.col("src").alias("h")).agg(F.sum("n").alias("others"), F.min("distance").alias("least"))
    per = c.join(near, "h", "left").select(
        "h", F.col("first").alias("class"), (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
        F.when(F.col("n") > 1, 0).otherwise(F.col("least")).alias("nearest"),
    )
    return h.join(per, "h").select(F.col("_name").alias(name), "class", "links", "nearest")


def kept(hashes: DataFrame, name: str, column: str, threshold: int, policy: str = "greedy") -> DataFrame:
    """(name) of the records that stay.

    ``drop_all``: those without any near record. ``greedy``: taken in the order of ``name``, those without an earlier kept
    one near. ``component_min``: the least name of each connected component. Equal hashes form one class, whose least name
    decides for all of it.
    """
    h = hashes.select(F.col(name).alias("_name"), F.col(column).alias("h")).filter("h IS NOT NULL")
    nodes = cut(classes(h, "_name", "h"))
    edges = cut(both_ways(hamming_pairs(h, "h", threshold)).select("src", "dst"))
    if policy == "drop_all":
        return nodes.filter("n = 1").join(edges.select(F.col("src").alias("h")).distinct(), "h", "left_anti").select(F.col("first").alias(name))
    if policy == "greedy":
        return greedy(nodes.select(F.col("h").alias("node"), F.col("first").alias("rank")), edges).select(F.col("rank").alias(name))
    if policy == "component_min":
        labels = components(nodes.select(F.col("h").alias("node"), F.col("first").alias("rank")), edges)
        return labels.groupBy("label").agg(F.lit(1)).select(F.col("label").alias(name))
    raise ValueError(f"unknown policy: {policy}")


def greedy(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes of the lexicographically first independent set by ``rank``: rounds decide every node whose earlier
    neighbours are all decided, so the number of rounds is the longest chain of dependencies, not the number of nodes."""
    r = nodes.select(F.col("node").alias("dst"), F.col("rank").alias("dst_rank"))
    q = nodes.select(F.col("node").alias("src"), F.col("rank").alias("src_rank"))
    back = cut(edges.join(r, "dst").join(q, "src").filter("dst_rank < src_rank").select("src", "dst"))  # to earlier neighbours
    linked = back.select(F.col("src").alias("node")).distinct()
    done = cut(nodes.join(linked, "node", "left_anti").select("node", F.lit(True).alias("keep")))
    left = cut(nodes.join(linked, "node", "left_semi").select("node"))
    while not left.isEmpty():
        state = back.join(left, back.src == left.node, "left_semi").join(done.select(F.col("node").alias("dst"), "keep"), "dst", "left")
        now = cut(
            state.groupBy(F.col("src").alias("node")).agg(F.bool_or(F.coalesce("keep", F.lit(False))).alias("hit"), F.bool_or(F.col("keep").isNull()).alias("open"))
            .filter("hit OR NOT open").select("node", (~F.col("hit")).alias("keep"))
        )
        done = cut(done.unionByName(now))
        left = cut(left.join(now, "node", "left_anti"))
    return nodes.join(done.filter("keep").select("node"), "node", "left_semi")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label): the least rank of the component, by least-label steps with pointer jumping."""
    labels = cut(nodes.select("node", F.col("rank").alias("label"), F.col("rank").alias("own")))
    while True:
        near = edges.join(labels.select(F.col("node").alias("dst"), "label"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node", "left").select("node", "own", F.least("label", F.coalesce("near", "label")).alias("new"), "label")
        jump = step.select(F.col("own").alias("j_own"), F.col("new").alias("j_new"))
        nxt = cut(step.join(jump, step.new == jump.j_own, "left").select("node", "own", F.least("new", F.coalesce("j_new", "new")).alias("new"), "label"))
        if nxt.filter("new <> label").isEmpty():
            return nxt.select("node", F.col("new").alias("label"))
        labels = nxt.select("node", F.col("new").alias("label"), "own")


def random_groups(hashes: DataFrame, name: str, column: str, threshold: int, size: int, rounds: int, seed: int) -> DataFrame:
    """Names left after ``rounds`` of removal inside shuffled groups of ``size``: every member of a pair found inside a
    group goes. Approximate by design; ``kept`` is the exact way. A group is one task's bounded work."""
    from pixloom.operators.ordinal import ordinal, shuffle_key

    # the filter stands behind the cut: before it, Spark would move it to the scan and work out every hash there once more
    live = cut(hashes.select(F.col(name).alias("_name"), F.col(column).alias("h"))).filter("h IS NOT NULL")

    def near(pdf: pd.DataFrame) -> pd.DataFrame:
        h = pdf.h.to_numpy().view(np.uint64)
        bad = np.zeros(len(h), bool)
        for i in range(0, len(h), 1024):
            d = np.bitwise_count(h[i : i + 1024, None] ^ h[None, :]) <= threshold
            d[np.arange(len(d)), np.arange(i, i + len(d))] = False
            bad[i : i + 1024] |= d.any(1)
        return pdf.loc[bad, ["_name"]]

    for k in range(rounds):
        keyed = ordinal(live.withColumn("_k", shuffle_key("_name", seed=seed + k)), ["_k", "_name"], "_o")
        gone = keyed.withColumn("_g", F.floor(F.col("_o") / size)).select("_g", "_name", "h").groupBy("_g").applyInPandas(near, f"_name {dict(live.dtypes)['_name']}")
        live = cut(live.join(gone, "_name", "left_anti"))
    return live.select(F.col("_name").alias(name))


def cosine_search(vectors: DataFrame, queries: DataFrame, name: str, vector: str, threshold: float, block: int = 8192) -> DataFrame:
    """(query, name, score) of all rows at or above ``threshold`` for each query, the query itself left out.

    Queries are taken in blocks of at most ``block`` rows, each a bounded broadcast; every row meets each block in one
    Arrow pass of a matrix product. Vectors of length 0 have no neighbours.
    """
    spark = vectors.sparkSession
    numbered = queries.select(F.col(name).alias("q"), F.col(vector).alias("v")).filter("v IS NOT NULL")
    blocks = max(1, -(-numbered.count() // (block // 2)))
    numbered = cut(numbered.withColumn("b", F.pmod(F.xxhash64("q"), F.lit(blocks))))
    out = None
    for b in range(blocks):
        rows = numbered.filter(F.col("b") == b).select("q", "v").collect()  # about half a block
        if not rows:
            continue
        m = np.array([r["v"] for r in rows], dtype=np.float64)
        length = np.linalg.norm(m, axis=1)
        sent = spark.sparkContext.broadcast((np.array([r["q"] for r in rows]), m[length > 0] / length[length > 0, None], length > 0))

        def near(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            ids, q, some = sent.value
            ids = ids[some]
            for pdf in batches:
                pdf = pdf[pdf.v.notna()]
                if len(pdf):
                    x = np.array(pdf.v.tolist(), dtype=np.float64)
                    n = np.linalg.norm(x, axis=1)
                    s = q @ np.divide(x, n[:, None], out=np.zeros_like(x), where=n[:, None] > 0).T
                    i, j = np.nonzero(s >= threshold)
                    keep = ids[i] != pdf.n.to_numpy()[j]
                    yield pd.DataFrame({"query": ids[i[keep]], "name": pdf.n.to_numpy()[j[keep]], "score": s[i[keep], j[keep]]})

        kind = dict(vectors.dtypes)[name]
        part = vectors.select(F.col(name).alias("n"), F.col(vector).alias("v")).mapInPandas(near, f"query {kind}, name {kind}, score double")
        out = part if out is None else out.unionByName(part)
    if out is None:
        kind = dict(vectors.dtypes)[name]
        return spark.createDataFrame([], f"query {kind}, name {kind}, score double")
    return out


def retrieval_metrics(truth_counts: DataFrame, hits: DataFrame) -> DataFrame:
    """(query, ap, ndcg, jaccard) from ``truth_counts(query, correct)`` and ``hits(query, rank, relevant)``.

    Ranks count from 1. Empty against empty is 1, empty against other 0; the ideal order knows the retrieved ones only.
    """
    from pyspark.sql import Window

    rel = F.col("relevant").cast("int")
    so_far = F.sum(rel).over(Window.partitionBy("query").orderBy("rank"))
    h = hits.withColumn("prec", F.when(rel == 1, so_far / F.col("rank"))).withColumn("gain", rel / (F.log2(F.col("rank") + 1.0)))
    h = h.withColumn("ideal", F.when(rel == 1, 1 / F.log2(so_far + 1.0)))
    per = h.groupBy("query").agg(
        F.count("*").alias("retrieved"), F.sum(rel).alias("right"), F.sum("prec").alias("prec"), F.sum("gain").alias("dcg"), F.sum("ideal").alias("idcg"))
    j = truth_counts.join(per, "query", "left").fillna(0, subset=["retrieved", "right"])
    both = (F.col("correct") == 0) & (F.col("retrieved") == 0)
    none = (F.col("correct") == 0) | (F.col("retrieved") == 0)

    def value(x):
        return F.when(both, 1.0).when(none, 0.0).otherwise(F.coalesce(x, F.lit(0.0)))

    right = F.col("right")
    return j.select(
        "query", value(F.col("prec") / F.col("correct")).alias("ap"), value(F.when(right > 0, F.col("dcg") / F.col("idcg"))).alias("ndcg"),
        value(right / (F.col("correct") + F.col("retrieved") - right)).alias("jaccard"),
    )


def pair_classification(n: int | Column, true_pairs: Column, found: Column, right: Column) -> list[Column]:
    """Precision, recall, F1 and support of both classes over all ``n (n - 1) / 2`` unordered pairs."""
    total = (F.lit(n) if isinstance(n, int) else n) * ((F.lit(n) if isinstance(n, int) else n) - 1) / 2
    tn = total - true_pairs - found + right

    def trio(tp, pred, real, tag):
        p = F.when(pred > 0, tp / pred).otherwise(0.0)
        r = F.when(real > 0, tp / real).otherwise(0.0)
        f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
        return [F.round(p, 6).alias(f"precision_{tag}"), F.round(r, 6).alias(f"recall_{tag}"), F.round(f, 6).alias(f"f1_{tag}"), real.cast("bigint").alias(f"support_{tag}")]

    return [*trio(right, found, true_pairs, "pos"), *trio(tn, total - found, total - true_pairs, "neg")]
