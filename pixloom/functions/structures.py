"""Nested values: flattening, tree and block matching. Scalar kernels in plain Python, run as Arrow UDFs."""

from __future__ import annotations

import json
from collections import Counter
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIRS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]))


def flatten(value, at: str = "") -> list[tuple[str, str]]:
    """(dotted key, text) of the leaves; members of a list share their list's key."""
    if isinstance(value, dict):
        return [p for k, v in value.items() for p in flatten(v, f"{at}.{k}" if at else str(k))]
    if isinstance(value, list):
        return [p for v in value for p in flatten(v, at)]
    return [(at, "" if value is None else str(value))]


def flat_pairs(c: Column | str) -> Column:
    """Flattened pairs of a JSON text; null when it can't be read."""

    @F.pandas_udf(PAIRS)
    def run(s: pd.Series) -> pd.Series:
        def one(t):
            try:
                return [{"key": k, "value": v} for k, v in flatten(json.loads(t))]
            except (TypeError, ValueError):
                return None

        return s.map(one)

    return run(c)


def pair_f1(pred, truth) -> float:
    """Multiset F1 of flattened pairs, with a small constant below the line."""
    p, t = Counter(flatten(pred)), Counter(flatten(truth))
    tp = sum((p & t).values())
    return tp / (tp + (sum(p.values()) - tp + sum(t.values()) - tp) / 2 + 1e-6)


def damerau(a: str, b: str) -> int:
    """Edit distance in which exchanging two neighbours counts once, also around other edits (Lowrance and Wagner 1975)."""
    far, n, m = len(a) + len(b), len(a), len(b)
    d = [[far] * (m + 2) for _ in range(n + 2)]
    for i in range(n + 1):
        d[i + 1][1] = i
    for j in range(m + 1):
        d[1][j + 1] = j
    row_of: dict[str, int] = {}
    for i in range(1, n + 1):
        col = 0
        for j in range(1, m + 1):
            r, c = row_of.get(b[j - 1], 0), col
            same = a[i - 1] == b[j - 1]
            if same:
                col = j
            d[i + 1][j + 1] = min(d[i][j] + (not same), d[i + 1][j] + 1, d[i][j + 1] + 1, d[r][c] + (i - r - 1) + 1 + (j - c - 1))
        row_of[a[i - 1]] = i
    return d[n + 1][m + 1]


def near_text(a: str, b: str, cutoff: float = 0.9) -> float:
    """Normalised similarity, 0 below ``cutoff``."""
    n = max(len(a), len(b))
    if a == b or n == 0:
        return 1.0
    # neither the difference of the lengths nor of the letters can exceed the distance
    apart = max(abs(len(a) - len(b)), sum(((Counter(a) - Counter(b)) | (Counter(b) - Counter(a))).values()) / 2)
    if 1 - apart / n < cutoff:
        return 0.0
    s = 1 - damerau(a, b) / n
    return s if s >= cutoff else 0.0


class _Tree(HTMLParser):
    """Nodes [label, text, children] of a table's markup."""

    def __init__(self):
        super().__init__()
        self.root = ["", "", []]
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        label = tag if tag not in ("td", "th") else f"td:{a.get('rowspan', '1')}:{a.get('colspan', '1')}"
        node = [label, "", []]
        self.open[-1][2].append(node)
        if tag not in ("br", "img", "hr"):
            self.open.append(node)

    def handle_endtag(self, tag):
        name = "td" if tag == "th" else tag
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0].split(":")[0] == name:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1][1] += data.strip()


def _post(node, labels, left):
    """Post-order labels and the leftmost leaf of each node."""
    first = None
    for child in node[2]:
        at = _post(child, labels, left)
        first = at if first is None else first
    labels.append((node[0], node[1]))
    left.append(len(labels) - 1 if first is None else first)
    return left[-1]


def tree_distance(a, b, change) -> float:
    """Ordered tree edit distance (Zhang and Shasha 1989); nodes are [label, text, children]."""
    la, fa, lb, fb = [], [], [], []
    _post(a, la, fa)
    _post(b, lb, fb)
    n, m = len(la), len(lb)
    dist = [[0.0] * m for _ in range(n)]
    roots = lambda f: sorted({x: i for i, x in enumerate(f)}.values())
    for i in roots(fa):
        for j in roots(fb):
            oi, oj = fa[i], fb[j]
            d = [[0.0] * (j - oj + 2) for _ in range(i - oi + 2)]
            for x in range(1, i - oi + 2):
                d[x][0] = d[x - 1][0] + 1
            for y in range(1, j - oj + 2):
                d[0][y] = d[0][y - 1] + 1
            for x in range(1, i - oi + 2):
                for y in range(1, j - oj + 2):
                    u, v = x + oi - 1, y + oj - 1
                    least = min(d[x - 1][y], d[x][y - 1]) + 1
                    if fa[u] == oi and fb[v] == oj:
                        d[x][y] = dist[u][v] = min(least, d[x - 1][y - 1] + change(la[u], lb[v]))
                    else:
                        d[x][y] = min(least, d[fa[u] - oi][fb[v] - oj] + dist[u][v])
    return dist[-1][-1]


def _edit(a: str, b: str) -> float:
    n = max(len(a), len(b))
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1] / n if n else 0.0


def table_similarity(a: str, b: str) -> float:
    """TEDS: 1 less the tree edit distance of two HTML tables over the greater number of nodes."""
    trees = []
    for t in (a, b):
        p = _Tree()
        p.feed(t or "")
        trees.append(p.root)

    def size(n):
        return 1 + sum(map(size, n[2]))

    def change(x, y):
        if x[0] != y[0]:
            return 1.0
        return _edit(x[1], y[1]) if x[0].startswith("td") else 0.0

    n = max(size(trees[0]), size(trees[1])) - 1  # the root is no node of the table
    return 1.0 if n == 0 else 1 - tree_distance(*trees, change) / n


def assign(cost: list[list[float]]) -> list[int]:
    """Cheapest assignment of rows to columns (-1 for none), by shortest augmenting paths."""
    n, m = len(cost), len(cost[0]) if cost else 0
    if n > m:
        back = assign([list(c) for c in zip(*cost)]) if m else []
        out = [-1] * n
        for j, i in enumerate(back):
            if i >= 0:
                out[i] = j
        return out
    inf = float("inf")
    u, v, match = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, used, way = [inf] * (m + 1), [False] * (m + 1), [0] * (m + 1)
        while match[j0]:
            used[j0] = True
            i0, delta, j1 = match[j0], inf, 0
            for j in range(1, m + 1):
                if not used[j]:
                    cur = cost[i0 - 1][j - 1] - u[i0] - v[j]
                    if cur < least[j]:
                        least[j], way[j] = cur, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(m + 1):
                if used[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
        while j0:
            j1 = way[j0]
            match[j0] = match[j1]
            j0 = j1
    out = [-1] * n
    for j in range(1, m + 1):
        if match[j]:
            out[match[j] - 1] = j - 1
    return out


def match_blocks(pred: list[str], truth: list[str]) -> list[tuple[int, int, float]]:
    """(pred, truth, edit) of the cheapest pairing on normalised edit distance; what is left alone has edit 1 and -1."""
    if not pred or not truth:
        return [(i, -1, 1.0) for i in range(len(pred))] + [(-1, j, 1.0) for j in range(len(truth))]
    cost = [[_edit(p, t) for t in truth] for p in pred]
    got = assign(cost)
    pairs = [(i, j, cost[i][j]) if j >= 0 else (i, -1, 1.0) for i, j in enumerate(got)]
    return pairs + [(-1, j, 1.0) for j in range(len(truth)) if j not in set(got)]


def udf(fn, kind: T.DataType):
    """A scalar kernel of texts as an Arrow UDF; null when any input is null."""

    def run(*cols: Column | str) -> Column:
        @F.pandas_udf(kind)
        def wrapped(frame: pd.DataFrame) -> pd.Series:
            return pd.Series([None if any(x is None for x in row) else fn(*row) for row in frame.itertuples(index=False, name=None)], dtype=object)

        return wrapped(F.struct(*cols))

    return run
