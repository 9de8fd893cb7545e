"""p6: draws and samples are uniform, at any size and however the data arrives."""

from collections import Counter

import numpy as np

from pixloom.llm import reservoir as R


def test_hypergeometric_against_exact_probabilities():
    from math import comb

    g = np.random.default_rng(3)
    for good, bad, n in ((5, 7, 6), (1, 30, 4), (40, 3, 20), (10, 10, 20), (0, 5, 3), (5, 0, 3)):
        draws = Counter(R.hypergeometric(g, good, bad, n) for _ in range(20_000))
        for k in range(n + 1):
            p = comb(good, k) * comb(bad, n - k) / comb(good + bad, n) if k <= good and n - k <= bad else 0
            assert abs(draws[k] / 20_000 - p) < 0.015, (good, bad, n, k)


def test_hypergeometric_of_huge_populations():
    g = np.random.default_rng(4)
    good, bad, n = 3 * 10**12, 7 * 10**12, 10**8
    x = np.array([R.hypergeometric(g, good, bad, n) for _ in range(200)])
    sd = (n * 0.3 * 0.7) ** 0.5
    assert abs(x.mean() - 0.3 * n) < 5 * sd / 200**0.5 and 0.8 < x.std() / sd < 1.2


def test_every_record_is_equally_likely(spark):
    rows = [("f", f"r{k:02}", k // 7) for k in range(30)]  # arrives in five batches
    records = spark.createDataFrame(rows, "folder string, key string, batch long")
    runs = spark.createDataFrame([(r, "f", 6, r) for r in range(400)] + [(900, "f", 0, 1), (901, "f", None, 1), (902, "f", 99, 1), (903, "none", 3, 1)], "run_id long, folder string, k long, seed long")
    got = R.sample(records, runs, slot_records=8).toPandas()
    per = got.groupby("run_id").key.agg(["size", "nunique"])
    assert set(per.index) == {*range(400), 902}
    assert (per.loc[:399, "size"] == 6).all() and (per["size"] == per["nunique"]).all() and per.loc[902, "size"] == 30
    counts = got[got.run_id < 400].key.value_counts().reindex([k for _, k, _ in rows], fill_value=0)
    expected = 400 * 6 / 30
    assert ((counts - expected) ** 2 / expected).sum() < 60  # chi-square of 29 degrees, far tail
    assert R.sample(records.limit(0), runs).count() == 0


def test_slots_of_which_no_run_takes_a_record(spark):
    records = spark.createDataFrame([("f", f"r{k:02}", 0) for k in range(40)], "folder string, key string, batch long")
    runs = spark.createDataFrame([(1, "f", 1, 7), (2, "f", 2, 7)], "run_id long, folder string, k long, seed long")
    got = R.sample(records, runs, slot_records=2).collect()  # 20 slots, 3 places
    assert sorted(r["run_id"] for r in got) == [1, 2, 2] and {r["key"] for r in got} <= {f"r{k:02}" for k in range(40)}


def test_batches_as_they_arrive(spark, tmp_path):
    r = R.Reservoir(spark, str(tmp_path / "state"), k=10, seed=2, slots=3)
    for number in range(4):
        batch = spark.createDataFrame([(f"b{number}-{k}",) for k in range(15)] + [(None,)], "key string")
        r.update(batch, number)
        r.update(batch, number)  # a batch twice counts once
        held = [x["key"] for x in r.sample().collect()]
        assert len(held) == len(set(held)) == min(10, 15 * (number + 1))
    assert len({h.split("-")[0] for h in held}) > 1
