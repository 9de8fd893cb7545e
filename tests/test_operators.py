"""Operators against the rule itself on small fixtures: nulls, ties, empty tables, hot keys, clashing names."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pixloom.functions import geometry as G
from pixloom.operators import corpus as C
from pixloom.operators import neardup as D
from pixloom.operators import ordinal as O
from pixloom.operators import reports as R
from pixloom.plans import neardups


def test_running_total_and_even_split(spark):
    rows = [(k, (k * 37) % 101, f"x{k}") for k in range(500)]
    df = spark.createDataFrame(rows, "id long, v long, name string").repartition(7)
    got = {r["id"]: r["before"] for r in O.running_total(df, ["name", "id"], F.col("v")).collect()}
    total = 0
    for k, v, _ in sorted(rows, key=lambda r: r[2]):
        assert got[k] == total
        total += v
    empty = O.ordinal(df.filter("id < 0"), ["id"])
    assert empty.count() == 0 and "ord" in empty.columns
    parts = O.ordinal(df, ["id"]).select(O.even_split(F.lit(500), F.col("ord"), 7).alias("p")).groupBy("p").count().collect()
    assert sorted(r["count"] for r in parts) == [71] * 4 + [72] * 3
    assert {r["p"] for r in parts if r["count"] == 72} == {0, 1, 2}


def test_sample_clusters_overshoots_once(spark):
    sizes = spark.createDataFrame([(f"s{k}", k % 9) for k in range(60)], "shard string, n int")
    got = O.sample_clusters(sizes, ["shard"], "n", 50, 3).collect()
    total = sum(r["n"] for r in got)
    assert total >= 50 and total - max(got, key=lambda r: r["before"])["n"] < 50
    assert O.sample_clusters(sizes, ["shard"], "n", 50, 3).collect() == got


def test_islands_with_null_keys(spark):
    rows = [("a", i, k) for i, k in enumerate(["x", "x", None, None, "x", "y"])]
    got = O.islands(spark.createDataFrame(rows, "g string, pos int, key string"), ["g"], ["pos"], "key").orderBy("pos").collect()
    assert [r["run"] for r in got] == [1, 1, 2, 2, 3, 4]


def test_even_chunks_follow_the_rule(spark):
    rng = random.Random(5)
    rows = [(k, rng.randrange(1, 90)) for k in range(3 * 32 + 5)]
    df = spark.createDataFrame(rows, "id long, len long")
    grouped = O.length_groups(df, "len", "id", 8, 4, 1)
    chunks = {r["id"]: r["chunk"] for r in O.even_chunks(grouped, "len", "id", 4).collect()}
    pdf = grouped.toPandas()
    assert sorted(pdf.id) == [k for k, _ in rows]
    for _, g in pdf.groupby("megabatch"):
        g = g.sort_values("slot")
        assert list(g.len) == sorted(g.len, reverse=True)
        counts = pd.Series([chunks[i] for i in g.id]).value_counts()
        assert counts.max() - counts.min() <= (0 if len(g) % 4 == 0 else 1)


@pytest.mark.parametrize("threshold", [0, 3, 5, 10])
def test_banded_join_equals_brute_force(spark, threshold):
    rng = random.Random(threshold)
    base = [rng.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1]
    values = set(base)
    for b in base:
        for flips in (1, 2, threshold, threshold + 1):
            x = b
            for i in rng.sample(range(64), flips):
                x ^= 1 << i
            values.add(x)
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    df = spark.createDataFrame([(v,) for v in signed] + [(signed[0],), (None,)], "h long")
    got = {(r["a"], r["b"], r["distance"]) for r in D.hamming_pairs(df, "h", threshold).collect()}
    want = {(a, b, d) for a in signed for b in signed if a < b and (d := ((a ^ b) & ((1 << 64) - 1)).bit_count()) <= threshold}
    assert got == want


def test_banded_join_is_never_broadcast(spark):
    # 2,000 hashes are 32 KB, but 134,000 rows once every band is offered with its flips
    rng = random.Random(3)
    pairs = D.hamming_pairs(spark.createDataFrame([(rng.getrandbits(63),) for _ in range(2000)], "h long"), "h", 5)
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("name", ["dups_map", "map_validation", "neardup_drop_all", "hamming_pairs", "neardup_components", "neardup_greedy"])
def test_near_duplicate_queries_broadcast_no_flipped_hashes(spark, monkeypatch, name):
    made, join = [], D.hamming_join
    monkeypatch.setattr(D, "hamming_join", lambda *a: made.append(join(*a)) or made[-1])
    neardups.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert made
    for pairs in made:
        pairs.collect()
        assert "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_a_hash_names_its_cells_once():
    assert str(D.average_hash(F.col("cells"))).count("cells") == 1


def test_random_groups_work_out_a_hash_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def slow(x):
        calls.add(1)
        return (1 << x) - 1 if x else None

    hashes = spark.range(40).distinct().select("id", slow("id").alias("h"))
    left = {r["id"] for r in D.random_groups(hashes, "id", "h", 0, 8, 2, 1).collect()}
    assert left == set(range(1, 40)) and calls.value == 40


def test_removal_policies(spark):
    # a chain a-b-c in which a and c are apart, an exact copy of c, and one alone
    h = [(1, 0b0), (2, 0b111), (3, 0b111111), (4, 0b111111), (5, -1)]
    df = spark.createDataFrame(h, "id long, h long")
    keep = lambda policy: {r["id"] for r in D.kept(df, "id", "h", 3, policy).collect()}
    assert keep("drop_all") == {5}
    assert keep("greedy") == {1, 3, 5}
    assert keep("component_min") == {1, 5}
    links = {r["id"]: (r["links"], r["nearest"]) for r in D.duplicate_counts(df, "id", "h", 3).collect()}
    assert links == {1: (1, 3), 2: (3, 3), 3: (2, 0), 4: (2, 0), 5: (0, None)}
    assert D.kept(df.filter("id < 0"), "id", "h", 3, "greedy").count() == 0


def test_greedy_and_components_on_random_graphs(spark):
    rng = random.Random(9)
    n = 60
    edges = {(a, b) for _ in range(70) if (a := rng.randrange(n)) != (b := rng.randrange(n))}
    both = edges | {(b, a) for a, b in edges}
    nodes = spark.createDataFrame([(k, k) for k in range(n)], "node long, rank long")
    e = spark.createDataFrame(sorted(both), "src long, dst long")
    kept = set()
    for k in range(n):
        if not any((k, j) in both for j in kept):
            kept.add(k)
    assert {r["node"] for r in D.greedy(nodes, e).collect()} == kept
    label = {k: k for k in range(n)}
    for _ in range(n):
        for a, b in both:
            label[a] = min(label[a], label[b])
    assert {r["node"]: r["label"] for r in D.components(nodes, e).collect()} == label


def test_hashes_of_plain_pictures(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, (32, 32))
    rows = [(1, 32, 32, a.ravel().tolist()), (2, 32, 32, None), (3, 32, 32, [1] * 5), (4, 12, 16, [1] * 192), (5, 0, 0, [])]
    df = spark.createDataFrame(rows, "image_id long, h int, w int, image array<int>")
    (r,) = D.picture_hashes(df).collect()
    cells = a.reshape(8, 4, 8, 4).sum((1, 3)).ravel()
    assert r["ahash"] == "".join("1" if 64 * c >= cells.sum() else "0" for c in cells)
    assert r["whash"] == "".join("1" if c >= np.median(cells) else "0" for c in cells)
    assert len(r["phash"]) == len(r["dhash"]) == 64


def test_cosine_search_in_blocks(spark):
    rng = np.random.default_rng(2)
    v = rng.standard_normal((200, 8))
    v[7] = 0
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)] + [(999, None)], "id long, v array<double>")
    got = {(r["query"], r["name"]) for r in D.cosine_search(df, df.filter("id % 5 = 0"), "id", "v", 0.5, block=16).collect()}
    u = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    s = u @ u.T
    assert got == {(a, b) for a in range(0, 200, 5) for b in range(200) if a != b and s[a, b] >= 0.5}


def test_contains_first(spark):
    texts = spark.createDataFrame([(1, "a red fox and a blue cat"), (2, None), (3, ""), (4, "nothing")], "id long, text string")
    notes = spark.createDataFrame([(5, "blue"), (3, "red fox"), (9, "red fox"), (1, ""), (2, None)], "ord long, stem string")
    assert [tuple(r) for r in C.contains_first(texts, notes).collect()] == [(1, 3)]
    assert [tuple(r) for r in C.contains_first(texts, notes, limit=1).collect()] == [(1, 3)]
    assert C.contains_first(texts, notes.limit(0)).count() == 0


def test_circular_rotations_keep_the_answer(spark):
    rows = [(1, "A", "w", "x", "y", None), (2, "D", "w", "x", "y", "z"), (3, None, "w", "x", None, None), (4, "A", "w", None, "y", None), (5, "free", None, None, None, None)]
    df = spark.createDataFrame(rows, "item_index long, answer string, option_a string, option_b string, option_c string, option_d string")
    got = C.circular(df).collect()
    by = {}
    for r in got:
        by.setdefault(r["g_index"], []).append(r)
    assert {k: len(v) for k, v in by.items()} == {1: 3, 2: 4, 3: 2, 4: 1, 5: 1}
    for r in by[1]:
        assert r[f"option_{r['answer'].lower()}"] == "w" and r["option_d"] is None
    for r in by[2]:
        assert r[f"option_{r['answer'].lower()}"] == "z"
    assert len({r["item_index"] for r in got}) == len(got)


def test_latest_and_control_group(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, None)], "id long, at int, x string")
    assert sorted((r["id"], r["x"]) for r in R.latest(df, ["id"], "at").collect()) == [(1, "b"), (2, None)]
    c = spark.createDataFrame([("n", 1, 1), ("p", 2, 3)], "g string, tp long, fp long")
    assert [tuple(r) for r in R.with_control(c, "g", "n", ["tp", "fp"]).collect()] == [("p", 3, 4)]
    assert [tuple(r) for r in R.with_control(c.filter("g = 'p'"), "g", "n", ["tp", "fp"]).collect()] == [("p", 2, 3)]


def test_interval_rows_equal_interval_arrays(spark):
    from pixloom.operators import intervals as I

    rng = random.Random(8)
    rows = [(rng.randrange(3) if rng.random() < 0.5 else 0, rng.choice("ab"), float(s := rng.randrange(60)), float(s + rng.randrange(7))) for _ in range(300)]
    df = spark.createDataFrame(rows + [(1, "a", None, 2.0)], "k long, kind string, s double, e double")
    got = {(r["k"], r["kind"]): set() for r in df.collect()}
    for r in I.merge(df, ["k", "kind"], "s", "e", 10.0).collect():
        got[r["k"], r["kind"]].add((r["s"], r["e"]))
    iv = F.struct("s", "e")
    arrays = df.filter("s IS NOT NULL").groupBy("k", "kind").agg(G.merge_intervals(F.collect_list(iv)).alias("m")).collect()
    assert got == {(r["k"], r["kind"]): {(x["s"], x["e"]) for x in r["m"]} for r in arrays}
    both = df.filter("s IS NOT NULL").groupBy("k").agg(*[G.merge_intervals(F.collect_list(F.when(F.col("kind") == x, iv))).alias(x) for x in "ab"])
    want = {r["k"]: r["iou"] for r in both.select("k", G.interval_iou(F.col("a"), F.col("b")).alias("iou")).collect()}
    found = {r["k"]: r["iou"] for r in I.set_iou(df, ["k"], "kind", "a", "b", "s", "e", 10.0).collect()}
    assert found.keys() == want.keys() and all(found[k] == pytest.approx(want[k]) for k in want)


def test_intervals_against_points(spark):
    rng = random.Random(4)
    sets = [[(a := rng.randrange(40), a + rng.randrange(6)) for _ in range(rng.randrange(5))] for _ in range(40)]
    rows = [([{"s": float(s), "e": float(e)} for s, e in x], [{"s": float(s), "e": float(e)} for s, e in y]) for x, y in zip(sets[::2], sets[1::2])]
    df = spark.createDataFrame(rows, "a array<struct<s:double,e:double>>, b array<struct<s:double,e:double>>")
    got = df.select(G.interval_iou(G.merge_intervals(F.col("a")), G.merge_intervals(F.col("b"))).alias("x")).collect()
    for (x, y), r in zip(zip(sets[::2], sets[1::2]), got):
        p, q = ({t for s, e in z for t in range(s, e)} for z in (x, y))
        assert r["x"] == pytest.approx(len(p & q) / len(p | q) if p | q else 0.0)
