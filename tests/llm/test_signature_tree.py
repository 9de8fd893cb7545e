"""p2: pairs against brute force; dirty pictures, copies, one root."""

import numpy as np
import pytest

from pixloom.llm import signature_tree as S


def pictures(rng, n):
    """Unrelated pictures, changed copies of some, and the dirty cases."""
    rows, base = [], []
    for k in range(n):
        side = (16, 32, 48)[k % 3]
        blocks = rng.integers(0, 256, (16, 16))
        if k % 4 == 0 and base:
            old = base[rng.integers(len(base))].astype(float)
            noise = rng.standard_normal((16, 16)) * rng.uniform(5, 45)
            blocks = np.clip(old + noise, 0, 255).round().astype(int)
        base.append(blocks)
        rows.append((k, side, side, np.kron(blocks, np.ones((side // 16, side // 16), int)).ravel().tolist()))
    bad = [(n, 16, 16, None), (n + 1, 16, 16, [5] * 256), (n + 2, 16, 16, [1, 2]), (n + 3, 20, 20, [1] * 399 + [2]), (n + 4, None, 16, [1] * 256), (None, *rows[0][1:])]
    copies = [rows[3], (n + 10, *rows[3][1:]), (n + 11, *rows[3][1:])]  # loaded twice, and the same picture under other ids
    return rows, rows + bad + copies


def correlation(a, b):
    return np.corrcoef(S.block_sums(a[3], a[1], a[2]), S.block_sums(b[3], b[1], b[2]))[0, 1]


@pytest.mark.parametrize("root, block", [(4, 2048), (256, 2048), (100_000, 16)])
def test_against_brute_force(spark, monkeypatch, root, block):
    monkeypatch.setattr(S, "ROOT", root)
    rng = np.random.default_rng(root)
    good, rows = pictures(rng, 160)
    df = spark.createDataFrame(rows, "image_id long, h int, w int, image array<int>").withColumnRenamed("image_id", "image_id")
    got = {(r["image_id_a"], r["image_id_b"]): r["similarity"] for r in S.similar_pairs(df, block=block).collect()}
    every = good + [(170, *good[3][1:]), (171, *good[3][1:])]
    want = {}
    for i, a in enumerate(every):
        for b in every[i + 1 :]:
            c = correlation(a, b)
            if c >= 0.9:
                want[min(a[0], b[0]), max(a[0], b[0])] = c
    assert got.keys() == want.keys() and len(want) > 10
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert S.similar_pairs(df.limit(0)).count() == 0


def test_the_tree_drops_no_near_pair():
    rng = np.random.default_rng(5)
    base = [S.unit(v) for v in rng.standard_normal((60, 256))]
    near = [S.unit(v + rng.standard_normal(256) * 0.015) for v in base[:30]]
    z = np.array(base + near)
    fine = np.clip(np.rint(z @ S.WAVES.T / S.FINE_STEP), -127, 127).astype(np.int8)
    x, y = S.group_pairs(fine, None, 0.9)
    got = set(zip(x.tolist(), y.tolist()))
    s = z @ z.T
    assert got >= {(i, j) for i in range(90) for j in range(i + 1, 90) if s[i, j] >= 0.9}
    side = np.r_[np.zeros(60, int), np.ones(30, int)]
    a, b = S.group_pairs(fine, side, 0.9)
    assert {(i, 60 + i) for i in range(30)} <= set(zip(a.tolist(), b.tolist()))
