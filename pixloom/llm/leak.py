"""Evaluation texts leaking into training text (problem 5).

A test item is a list of words; a passage of it is any ``min_words`` consecutive ones. A corpus text
leaks the item when it holds a passage with at most one edited word. Pigeonhole, twice: of a passage
with one error one half stands unchanged, and of the two halves of the other half one does too, moved
by at most one word. So a text is a candidate at a place where it holds half a passage and, at its due
distance (give or take one), a quarter of it. Candidates are verified by Myers' bit-parallel distance, the words
being the symbols; those of distance 0 have the passage unchanged.

Plan. The items' keys (half and quarter hashed together) form one sorted index. It is sent to the tasks in
parts of at most ``part_bytes``, so what is broadcast is bounded whatever the number of items, and each part is one
Arrow pass over the corpus in which candidates are found, merged and verified. No text, window or hit is shuffled; a
piece that stands in many items and texts costs its candidates inside the task that reads the text. The results
are few rows a text, aggregated once.

Defined results: null or empty conversations, messages and questions leak nothing; items shorter
than ``min_words`` cannot leak; repeated rows count once; texts of any length are searched whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixloom.llm import textforms
from pixloom.session import cut, spread, table

#: Most edits of a passage: the two pigeonholes stand for one.
BUDGET = 1
#: Texts whose result a task remembers, for texts that are stored again and again.
MEMO = 20_000
#: Words that are searched at once.
BATCH_WORDS = 200_000


def myers(pattern: list, text: list) -> list[int]:
    """Least edit distance of ``pattern`` to a part of ``text`` ending at each position (Myers 1999)."""
    m = len(pattern)
    peq: dict = {}
    for i, w in enumerate(pattern):
        peq[w] = peq.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, out = full, 0, m, []
    for w in text:
        eq = peq.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        out.append(score)
    return out


def word_hash(word: str, _memo: dict = {}) -> int:
    h = _memo.get(word)
    if h is None:
        h = xxhash.xxh64_intdigest(word)
        if len(_memo) < 500_000:
            _memo[word] = h
    return h


def word_hashes(text: str) -> np.ndarray:
    words = textforms.words(text)
    return np.fromiter(map(word_hash, words), np.uint64, len(words))


def runs(h: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of the ``size`` words from each position on."""
    n = len(h) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    return out ^ out >> np.uint64(29)


def _key(half: np.ndarray, quarter: np.ndarray, kind: int) -> np.ndarray:
    """One number for a half, a quarter and where it stands: 0 and 1 after the half, 2 and 3 before it, nearer ones even."""
    x = (half ^ quarter * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(kind * 0x632BE59BD9B4E019 % 2**64)
    return x ^ x >> np.uint64(31)


@dataclass
class Index:
    """Passages of some items by key. ``words`` are all items' word hashes end to end, ``base`` where each item begins."""

    halves: np.ndarray
    keys: np.ndarray
    item: np.ndarray
    start: np.ndarray
    words: np.ndarray
    base: np.ndarray
    names: np.ndarray

    @classmethod
    def build(cls, items: list[tuple[int, np.ndarray]], min_words: int) -> Index:
        half, quarter = min_words // 2, min_words // 4
        keys, item, start, halves, base, at = [], [], [], [], [], 0
        for k, (_, h) in enumerate(items):
            base.append(at)
            at += len(h)
            n = len(h) - min_words + 1
            a, q = runs(h, half), runs(h, quarter)
            s = np.arange(n)
            halves += [a[: n + half]]
            for kind, (piece, beside) in enumerate(((s, s + half), (s, s + half + quarter), (s + half, s + half - quarter), (s + half, s))):
                keys.append(_key(a[piece], q[beside], kind))
                item.append(np.full(n, k, np.int32))
                start.append(s.astype(np.int32))
        cat = lambda x, t: np.concatenate(x) if x else np.empty(0, t)
        key = cat(keys, np.uint64)
        order = np.argsort(key, kind="stable")
        return cls(np.unique(cat(halves, np.uint64)), key[order], cat(item, np.int32)[order], cat(start, np.int32)[order],
                   cat([h for _, h in items], np.uint64), np.array(base, np.int64), np.array([i for i, _ in items], np.int64))

    def leaks(self, texts: list[np.ndarray], min_words: int) -> list[dict[int, int]]:
        """For each text the items (positions in ``names``) that it leaks, with the least distance."""
        out: list[dict[int, int]] = [{} for _ in texts]
        half, quarter = min_words // 2, min_words // 4
        length = np.array([len(x) for x in texts], np.int64)
        if not len(self.halves) or not length.sum():
            return out
        # all texts end to end; a run counts only inside one text
        h = np.concatenate(texts)
        end = np.repeat(np.cumsum(length), length)
        begin_of = end - np.repeat(length, length)
        number = np.repeat(np.arange(len(texts)), length)
        a, q = runs(h, half), runs(h, quarter)
        at = np.searchsorted(self.halves, a)
        p = np.nonzero((self.halves[np.minimum(at, len(self.halves) - 1)] == a) & (np.arange(len(a)) + half <= end[: len(a)]))[0]
        places = [(0, half, 0), *[(1, half + quarter + d, 0) for d in (-1, 0, 1)], (2, -quarter, -half), *[(3, -half + d, -half) for d in (-1, 0, 1)]]
        got = []
        for kind, step, back in places:
            pp = p[(p + step >= begin_of[p]) & (p + step + quarter <= end[p])]
            key = _key(a[pp], q[pp + step], kind)
            lo, hi = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
            n = hi - lo
            if n.any():
                row = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                place = np.repeat(pp, n)
                got.append(np.stack([number[place], self.item[row].astype(np.int64), self.start[row].astype(np.int64), place + back]))
        if not got:
            return out
        text, item, start, begin = np.unique(np.concatenate(got, axis=1), axis=1)
        last = np.cumsum(length)[text]
        first = last - length[text]
        # passages that stand unchanged: distance 0 on the words themselves
        same = (begin >= first) & (begin + min_words <= last)
        k = np.arange(min_words)
        i, s, b = item[same], start[same], begin[same]
        same[same] = (self.words[(self.base[i] + s)[:, None] + k] == h[b[:, None] + k]).all(1)
        for t, i in zip(text[same].tolist(), item[same].tolist()):
            out[t][i] = 0
        rest = ~same
        for t, i, s, b, lo, hi in zip(*(x[rest].tolist() for x in (text, item, start, begin, first, last))):
            if i not in out[t]:
                passage = self.words[self.base[i] + s : self.base[i] + s + min_words].tolist()
                d = min(myers(passage, h[max(lo, b - BUDGET) : min(hi, b + min_words + BUDGET)].tolist()), default=min_words)
                if d <= BUDGET:
                    out[t][i] = d
        return out


def _item_words(items: DataFrame, min_words: int) -> DataFrame:
    """(item_index, h): word hashes of every item long enough to leak."""

    def run(batches):
        for pdf in batches:
            rows = []
            for i, q in zip(pdf.item_index, pdf.question):
                h = word_hashes(q) if isinstance(q, str) and not pd.isna(i) else ()
                if len(h) >= min_words:
                    rows.append((int(i), h.view(np.int64)))
            yield pd.DataFrame(rows, columns=["item_index", "h"])

    return items.select("item_index", "question").distinct().mapInPandas(run, "item_index bigint, h array<bigint>")


def find_leaks(corpus: DataFrame, items: DataFrame, min_words: int = 12, part_bytes: int = 128 << 20) -> DataFrame:
    """(id, item_index, distance) from ``corpus(id, text)`` and ``items(item_index, question)``; an id may have several texts.

    ``min_words`` must be a multiple of 4."""
    if min_words < 4 or min_words % 4:
        raise ValueError("min_words must be a multiple of 4")
    spark = corpus.sparkSession
    words = cut(_item_words(items, min_words))
    # a word of an item takes about four keys with two numbers each, the key of its half and itself: 100 bytes
    size = words.agg(F.sum(F.size("h").cast("bigint") * 100)).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    out = None
    for k in range(parts):
        mine = words.filter(F.pmod(F.xxhash64("item_index"), F.lit(parts)) == k).collect()  # about ``part_bytes``
        index = Index.build([(r["item_index"], np.array(r["h"], np.int64).view(np.uint64)) for r in mine], min_words)
        sent = spark.sparkContext.broadcast(index)

        def search(batches, sent=sent):
            index, memo = sent.value, {}

            def look_up(new: list[str]):
                held, words = [], 0
                for k, text in enumerate(new):
                    held.append((text, word_hashes(text)))
                    words += len(held[-1][1])
                    if words > BATCH_WORDS or k == len(new) - 1:
                        memo.update(zip((t for t, _ in held), index.leaks([h for _, h in held], min_words)))
                        held, words = [], 0

            for pdf in batches:
                texts = [t if isinstance(t, str) and not pd.isna(i) else None for i, t in zip(pdf.id, pdf.text)]
                if len(memo) >= MEMO:
                    memo.clear()
                look_up([t for t in dict.fromkeys(texts) if t is not None and t not in memo])
                rows = [(int(i), int(index.names[k]), d) for i, t in zip(pdf.id, texts) if t is not None for k, d in memo[t].items()]
                yield pd.DataFrame(rows, columns=["id", "item_index", "distance"])

        part = corpus.select("id", "text").mapInPandas(search, "id bigint, item_index bigint, distance int")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("id", "item_index").agg(F.min("distance").alias("distance"))


def dialogue_leaks(dialogues: DataFrame, items: DataFrame, min_words: int = 12) -> DataFrame:
    """(dialogue_id, item_index, distance), the least distance over the dialogue's messages."""
    messages = dialogues.select(F.col("dialogue_id").alias("id"), F.explode("conversations.text").alias("text"))
    return find_leaks(messages, items, min_words).withColumnRenamed("id", "dialogue_id")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    found = p5_leaks(spark, sf)
    return found.filter("distance = 0").select("dialogue_id", "item_index")


def p5_leaks(spark: SparkSession, sf: str) -> DataFrame:
    dialogues = spread(table(spark, sf, "train_dialogues").select("dialogue_id", "conversations"))
    return dialogue_leaks(dialogues, table(spark, sf, "bench_items"))


QUERIES = {"p5_found": p5_found, "p5_leaks": p5_leaks}
ORACLES: dict[str, str] = {}
