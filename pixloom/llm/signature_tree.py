"""Near-duplicate pictures (problem 2): a similarity join through a forest of signature trees.

Similarity of two pictures is the Pearson correlation of their 16 x 16 block means, so with
vectors of mean 0 and length 1 a pair of similarity ``s`` is at distance ``sqrt(2 - 2 s)``.

Signature. A vector is projected on its ``FINE`` lowest cosine waves (orthonormal, so distances
only shrink). A wave's amount, in steps of ``STEP``, becomes that many tokens of the wave's
positive or negative side: a thermometer in a bitmap. Of two pictures above the threshold at
most ``D`` tokens are in only one signature (Cauchy-Schwarz plus rounding), so they have at
least ``(|a| + |b| - D) / 2`` tokens in common.

Tree. Inner nodes hold the OR of the bitmaps below and the range of their sizes; the overlap of
``OR(X)`` and ``OR(Y)`` is the most any pair below X and Y can share. The dual traversal starts at
(root, root) and drops a pair of nodes when that is below ``(min|X| + min|Y| - D) / 2``.

Forest. Of two unrelated pictures' signatures the overlap is short of the bound nearly always, but pictures have
about 100 effective dimensions and the OR of two unrelated ones already covers most tokens (README has figures): the
traversal drops pairs at its leaves, which hold one picture each, and next to nothing above them. One tree over
all would stay quadratic. Pictures are therefore routed to the roots of ``tables`` trees by the signs of ``bits``
random projections each; pictures at the threshold agree on a sign with probability ``1 - acos(s) / pi``.
``bits`` grows with the logarithm of the collection, so a root holds about ``ROOT`` unrelated pictures at
any size, and ``tables`` follows from the bound ``miss`` on the chance to lose a pair at the threshold (closer
pairs are safer by orders of magnitude).

Plan. Vectors are kept as whole block sums. Equal ones are collapsed first and expanded only in the answer. Only a 40-byte code of a
picture is shuffled, once per table. A root with more than ``block`` pictures is cut into blocks
whose pairs are separate groups, so no task holds more than two blocks. Pairs of surviving leaves are
compared by their codes (a necessary condition) and, once each, by the full vectors.

Defined results: null pictures, pictures whose length is not ``h * w``, whose sides are not
multiples of 16 or of a single grey are never in a pair; a row loaded twice counts once; an id
with several valid pictures pairs by each of them; ties at the threshold are kept; an empty
table has no pairs; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixloom.session import cut, spread, table

SIDE = 16
FINE = 40
FINE_STEP = 1 / 120
STEP = 0.01
LEAF, FANOUT = 1, 8
#: Pictures of a root.
ROOT = 128


def _waves() -> np.ndarray:
    """The orthonormal cosine waves of a 16 x 16 picture, lowest first, without the constant."""
    k = np.arange(SIDE)
    basis = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * SIDE))
    basis *= np.sqrt(np.where(k == 0, 1, 2) / SIDE)[:, None]
    order = sorted(((u, v) for u in k for v in k if u + v), key=lambda uv: (uv[0] ** 2 + uv[1] ** 2, uv))
    return np.stack([np.outer(basis[u], basis[v]).ravel() for u, v in order[:FINE]])


WAVES = _waves()


def block_sums(image, h, w) -> np.ndarray | None:
    """Sums of the 256 blocks of a valid picture: the means up to a factor that correlation doesn't see."""
    if image is None or h is None or w is None or h != h or w != w:
        return None
    h, w = int(h), int(w)
    if h <= 0 or w <= 0 or h % SIDE or w % SIDE or len(image) != h * w:
        return None
    a = np.asarray(image)
    if a.dtype.kind not in "iu" or a.min() == a.max():  # a null pixel makes floats
        return None
    return a.reshape(SIDE, h // SIDE, SIDE, w // SIDE).sum(axis=(1, 3), dtype=np.int64).ravel()


def unit(means: np.ndarray) -> np.ndarray | None:
    """Mean 0, length 1; None for a flat list, whose correlation is undefined."""
    z = means - means.mean()
    n = np.linalg.norm(z)
    return z / n if n > 1e-9 else None


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for i, image, h, w in zip(pdf.image_id, pdf.image, pdf.h, pdf.w):
            sums = block_sums(image, h, w)
            z = unit(sums) if sums is not None else None
            if z is None or pd.isna(i):
                continue
            fine = np.clip(np.rint(WAVES @ z / FINE_STEP), -127, 127).astype(np.int8)
            rows.append((int(i), sums.astype(np.int32).tobytes(), fine.tobytes()))
        yield pd.DataFrame(rows, columns=["image_id", "vec", "fine"])


def forest_size(n: int, threshold: float, miss: float) -> tuple[int, int]:
    """(bits, tables) for ``n`` pictures."""
    bits = max(1, math.ceil(math.log2(max(2, n) / ROOT)))
    agree = 1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    p = agree**bits
    tables = 1 if p >= 1 else math.ceil(math.log(miss) / math.log1p(-p))
    return bits, max(1, tables)


def _roots(bits: int, tables: int):
    """Array of the root of each table: table number and sign bits in one long."""

    @F.pandas_udf("array<bigint>")
    def roots(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        planes = np.random.default_rng(20).standard_normal((SIDE * SIDE, bits * tables)).astype(np.float32)
        weight = (1 << np.arange(bits, dtype=np.int64))[None, None, :]
        at = np.arange(tables, dtype=np.int64) << bits
        for s in batches:
            if not len(s):
                yield pd.Series([], dtype=object)
                continue
            z = np.frombuffer(b"".join(s), np.int32).reshape(len(s), -1).astype(np.float32)
            z -= z.mean(1, keepdims=True)
            sign = (z @ planes > 0).reshape(len(s), tables, bits)
            yield pd.Series(list((sign * weight).sum(2) + at))

    return roots


class SignatureTree:
    """Static tree over the codes of a group: leaves of ``LEAF`` neighbours, ``FANOUT`` children a node.

    The tokens of one side of a wave are a thermometer, so a bitmap is one run for each side and is kept as its
    length; the OR of bitmaps is the longest run, the overlap of two the sum of the shorter runs."""

    def __init__(self, fine: np.ndarray):
        amounts = fine.astype(np.float32) * FINE_STEP
        self.order = np.lexsort(np.rint(amounts[:, :6] / 0.2).T[::-1])
        lv = np.floor(np.abs(amounts) / STEP + 1e-4).astype(np.uint8)[self.order]
        up = amounts[self.order] > 0
        bitmaps = np.concatenate([np.where(up, lv, 0), np.where(up, 0, lv)], axis=1)
        sizes = lv.sum(1, dtype=np.int32)
        at = np.arange(0, len(lv), LEAF)
        self.bounds = [(at, np.append(at[1:], len(lv)))]
        self.bitmaps, self.least, self.most = [np.maximum.reduceat(bitmaps, at, axis=0)], [np.minimum.reduceat(sizes, at)], [np.maximum.reduceat(sizes, at)]
        while len(self.least[-1]) > FANOUT:
            at = np.arange(0, len(self.least[-1]), FANOUT)
            self.bounds.append((at, np.append(at[1:], len(self.least[-1]))))
            self.bitmaps.append(np.maximum.reduceat(self.bitmaps[-1], at, axis=0))
            self.least.append(np.minimum.reduceat(self.least[-1], at))
            self.most.append(np.maximum.reduceat(self.most[-1], at))

    def leaf_pairs(self, other: SignatureTree, apart: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of leaves that may hold a pair of records with at most ``apart`` unshared tokens; of a tree with itself
        each pair of leaves once."""
        a, b = len(self.least) - 1, len(other.least) - 1
        x, y = (g.ravel() for g in np.meshgrid(np.arange(len(self.least[a])), np.arange(len(other.least[b])), indexing="ij"))
        while True:
            if other is self:
                once = x <= y
                x, y = x[once], y[once]
            keep = np.zeros(len(x), bool)
            for i in range(0, len(x), 16_384):
                s = slice(i, i + 16_384)
                overlap = np.minimum(self.bitmaps[a][x[s]], other.bitmaps[b][y[s]]).sum(1, dtype=np.int32)
                keep[s] = 2 * overlap >= self.least[a][x[s]] + other.least[b][y[s]] - apart
                keep[s] &= np.maximum(self.least[a][x[s]] - other.most[b][y[s]], other.least[b][y[s]] - self.most[a][x[s]]) <= apart
            x, y = x[keep], y[keep]
            if a == 0 and b == 0:
                return x, y
            if a >= b:
                x, y = _expand(x, y, *self.bounds[a])
            if b >= a:
                y, x = _expand(y, x, *other.bounds[b])
            a, b = (a - (a >= b), b - (b >= a))


def _expand(x, y, start, end):
    """Children of each ``x`` beside its ``y``."""
    n = end[x] - start[x]
    at = np.repeat(start[x] - np.cumsum(n) + n, n) + np.arange(n.sum())
    return at, np.repeat(y, n)


def _limits(threshold: float) -> tuple[float, float]:
    """(most unshared tokens, largest squared distance of codes) of a pair at the threshold."""
    distance = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    apart = (math.sqrt(FINE) * distance + FINE * FINE_STEP) / STEP + FINE
    return apart, (distance + FINE_STEP * math.sqrt(FINE)) ** 2 + 1e-4


def group_pairs(fine: np.ndarray, side: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the near pairs of a group; ``side`` names the block when two blocks meet."""
    apart, reach = _limits(threshold)
    if side is None:
        left = right = np.arange(len(fine))
    else:
        left, right = np.nonzero(side == 0)[0], np.nonzero(side == 1)[0]
    if not len(left) or not len(right):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    tx = SignatureTree(fine[left])
    ty = tx if side is None else SignatureTree(fine[right])
    lx, ly = tx.leaf_pairs(ty, apart)
    px, py = [], []
    (sx, ex), (sy, ey) = tx.bounds[0], ty.bounds[0]
    for i in range(0, len(lx), 65_536):
        x, yl = _expand(lx[i : i + 65_536], ly[i : i + 65_536], sx, ex)
        y, x = _expand(yl, x, sy, ey)
        x, y = left[tx.order[x]], right[ty.order[y]]
        if side is None:
            x, y = np.minimum(x, y), np.maximum(x, y)
            x, y = x[x < y], y[x < y]
        d = fine[x].astype(np.int32) - fine[y]
        near = np.einsum("ij,ij->i", d, d) * FINE_STEP**2 <= reach
        px.append(x[near])
        py.append(y[near])
    return np.concatenate(px or [np.empty(0, np.int64)]), np.concatenate(py or [np.empty(0, np.int64)])


def _near(threshold: float):
    """Rows sorted by (root, bi, bj) to candidate pairs; groups may span batches."""

    def work(root, bi, bj, side, c1, c2, fine):
        edge = np.nonzero((root[1:] != root[:-1]) | (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1]))[0] + 1
        start = np.concatenate([[0], edge])
        size = np.diff(np.append(start, len(root)))
        xs, ys = [], []
        plain = bi[start] == bj[start]
        for g in np.nonzero(size > 1)[0]:
            s = slice(start[g], start[g] + size[g])
            x, y = group_pairs(fine[s], None if plain[g] else side[s], threshold)
            xs.append(x + start[g])
            ys.append(y + start[g])
        x = np.concatenate(xs) if xs else np.empty(0, np.int64)
        y = np.concatenate(ys) if ys else np.empty(0, np.int64)
        swap = (c1[x] > c1[y]) | ((c1[x] == c1[y]) & (c2[x] > c2[y]))
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        return pd.DataFrame({"a1": c1[x], "a2": c2[x], "b1": c1[y], "b2": c2[y]}).drop_duplicates()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []

        def arrays(pdf):
            fine = np.frombuffer(b"".join(pdf.fine), np.int8).reshape(len(pdf), FINE)
            return [*(pdf[c].to_numpy() for c in ("root", "bi", "bj", "side", "c1", "c2")), fine]

        for pdf in batches:
            if not len(pdf):
                continue
            now = arrays(pdf)
            if held:
                now = [np.concatenate([a, b]) for a, b in zip(held, now)]
            root, bi, bj = now[:3]
            same = (root == root[-1]) & (bi == bi[-1]) & (bj == bj[-1])
            cut_at = len(root) - int(same[::-1].argmin()) if not same.all() else 0
            held = [a[cut_at:] for a in now]
            if cut_at:
                yield work(*[a[:cut_at] for a in now])
        if held:
            yield work(*held)

    return run


def similar_pairs(images: DataFrame, threshold: float = 0.9, miss: float = 1e-3, block: int = 2048) -> DataFrame:
    """(image_id_a, image_id_b, similarity) of the pairs of different pictures at or above ``threshold``."""
    rows = cut(
        images.select("image_id", "h", "w", "image")
        .filter("image IS NOT NULL")
        .mapInPandas(_vectors, "image_id bigint, vec binary, fine binary")
        .withColumn("c1", F.xxhash64("vec"))
        .withColumn("c2", F.xxhash64(F.lit(7), "vec"))
    )
    members = rows.select("image_id", "c1", "c2").distinct()
    pictures = cut(rows.groupBy("c1", "c2").agg(F.first("vec").alias("vec"), F.first("fine").alias("fine")))
    bits, tables = forest_size(pictures.count(), threshold, miss)

    routed = pictures.select("c1", "c2", "fine", F.explode(_roots(bits, tables)("vec")).alias("root"))
    hot = cut(
        routed.groupBy("root").agg(F.count("*").alias("n")).filter(F.col("n") > block)
        .select("root", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    zero = F.lit(0)
    if hot.isEmpty():
        grouped = routed.select("root", zero.alias("bi"), zero.alias("bj"), zero.alias("side"), "c1", "c2", "fine")
    else:
        # a record of block i meets every block: groups (i, j) with i <= j, left side i, right side j
        spread = routed.join(hot, "root", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        spread = spread.withColumn("own", F.expr("pmod(xxhash64(c1, c2), blocks)").cast("int"))
        spread = spread.withColumn("o", F.explode(F.sequence(zero, F.col("blocks") - 1)))
        grouped = spread.select(
            "root", F.least("own", "o").alias("bi"), F.greatest("own", "o").alias("bj"),
            (F.col("own") > F.col("o")).cast("int").alias("side"), "c1", "c2", "fine",
        )
    parts = max(8, int(images.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pairs = "a1 bigint, a2 bigint, b1 bigint, b2 bigint"
    cand = cut(
        grouped.repartition(parts, "root", "bi", "bj").sortWithinPartitions("root", "bi", "bj")
        .mapInPandas(_near(threshold), pairs).distinct()
    )
    vecs = pictures.select("c1", "c2", "vec")

    @F.pandas_udf("double")
    def correlation(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in batches:
            if not len(x):
                yield pd.Series([], dtype="float64")
                continue
            # whole numbers throughout: the counts below the root are exact
            p, q = (np.frombuffer(b"".join(v), np.int32).reshape(len(v), -1).astype(np.int64) for v in (x, y))
            n, sp, sq = SIDE * SIDE, p.sum(1), q.sum(1)
            top = (n * (p * q).sum(1) - sp * sq).astype(np.float64)
            yield pd.Series(top / np.sqrt((n * (p * p).sum(1) - sp * sp).astype(np.float64)) / np.sqrt((n * (q * q).sum(1) - sq * sq).astype(np.float64)))

    va = vecs.withColumnsRenamed({"c1": "a1", "c2": "a2", "vec": "va"})
    vb = vecs.withColumnsRenamed({"c1": "b1", "c2": "b2", "vec": "vb"})
    alike = cand.join(va, ["a1", "a2"]).join(vb, ["b1", "b2"]).withColumn("similarity", correlation("va", "vb"))
    alike = alike.filter(F.col("similarity") >= threshold - 1e-12).select("a1", "a2", "b1", "b2", "similarity")

    ma = members.withColumnsRenamed({"image_id": "ia", "c1": "a1", "c2": "a2"})
    mb = members.withColumnsRenamed({"image_id": "ib", "c1": "b1", "c2": "b2"})
    between = alike.join(ma, ["a1", "a2"]).join(mb, ["b1", "b2"]).select("ia", "ib", "similarity")
    twins = members.groupBy("c1", "c2").agg(F.count("*").alias("n")).filter("n > 1").join(members, ["c1", "c2"])
    within = (
        twins.select("c1", "c2", F.col("image_id").alias("ia"))
        .join(twins.select("c1", "c2", F.col("image_id").alias("ib")), ["c1", "c2"])
        .filter("ia < ib").select("ia", "ib", F.lit(1.0).alias("similarity"))
    )
    return (
        between.filter("ia <> ib").unionByName(within)
        .groupBy(F.least("ia", "ib").alias("image_id_a"), F.greatest("ia", "ib").alias("image_id_b"))
        .agg(F.max("similarity").alias("similarity"))
    )


def _images(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "image_grids").select("image_id", "h", "w", "image"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return similar_pairs(_images(spark, sf)).select("image_id_a", "image_id_b")


def p2_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return similar_pairs(_images(spark, sf)).withColumn("similarity", F.round("similarity", 6))


_PAIRS = """WITH v AS (SELECT DISTINCT image_id, h, w, image FROM image_grids WHERE image IS NOT NULL AND h > 0 AND w > 0 AND h % 16 = 0 AND w % 16 = 0
  AND len(image) = h * w AND list_min(image) <> list_max(image)),
px AS (SELECT image_id, h, w, image, unnest(range(0, h * w)) AS k FROM v),
c AS (SELECT image_id, (k // w) // (h // 16) AS r, (k % w) // (w // 16) AS q, avg(image[k + 1]) AS m FROM px GROUP BY ALL),
s AS (SELECT image_id, avg(m) AS mean, sqrt(sum(m * m) - sum(m) * sum(m) / 256) AS len FROM c GROUP BY image_id),
z AS (SELECT image_id, list((m - mean) / len ORDER BY r, q) AS z FROM c JOIN s USING (image_id) WHERE len > 1e-6 GROUP BY image_id)
SELECT a.image_id AS image_id_a, b.image_id AS image_id_b{} FROM z a JOIN z b ON a.image_id < b.image_id WHERE list_inner_product(a.z, b.z) >= 0.9 - 1e-12"""


QUERIES = {"p2_found": p2_found, "p2_pairs": p2_pairs}
ORACLES = {"p2_found": _PAIRS.format(""), "p2_pairs": _PAIRS.format(", round(list_inner_product(a.z, b.z), 6) AS similarity")}
