"""p5: leaked passages against brute force; hot pieces, nulls, one edited word."""

import random

import pytest

from pixloom.llm import leak, textforms


def plain_distance(a, b):
    """Least edit distance of ``a`` to any part of ``b``."""
    last = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return min(last)


def test_myers_equals_dynamic_programming():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.choice("abc") for _ in range(rng.randrange(1, 9))] for _ in range(2))
        assert min(leak.myers(a, b)) <= len(a)
        assert min(min(leak.myers(a, b)), len(a)) == plain_distance(a, b)


def test_against_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"w{k}" for k in range(60)]
    hot = [rng.choice(vocab) for _ in range(6)]  # a piece that all items share
    items = [(k, [rng.choice(vocab) for _ in range(rng.randrange(0, 9))] + hot + [rng.choice(vocab) for _ in range(rng.randrange(3, 16))]) for k in range(40)]
    texts = []
    for t in range(150):
        words = [rng.choice(vocab) for _ in range(rng.randrange(0, 40))]
        k, item = rng.choice(items)
        piece = item[(s := rng.randrange(max(1, len(item) - 11))) : s + rng.randrange(10, 15)]
        edit = rng.randrange(5)
        if edit == 1 and piece:
            piece[rng.randrange(len(piece))] = "zz"
        elif edit == 2 and piece:
            del piece[rng.randrange(len(piece))]
        elif edit == 3:
            piece.insert(rng.randrange(len(piece) + 1), "zz")
        at = rng.randrange(len(words) + 1)
        texts.append((t % 100, words[:at] + piece + words[at:] + (hot if t % 4 == 0 else [])))
    want = {}
    for i, words in texts:
        for k, item in items:
            for s in range(len(item) - 11):
                d = plain_distance(item[s : s + 12], words)
                if d <= 1:
                    want[i, k] = min(d, want.get((i, k), 9))
    corpus = spark.createDataFrame([(i, " ".join(w)) for i, w in texts] + [(500, None), (None, "x"), (501, "")], "id long, text string")
    q = spark.createDataFrame([(k, " ".join(w)) for k, w in items] + [(77, None), (78, "too short")], "item_index long, question string")
    got = {(r["id"], r["item_index"]): r["distance"] for r in leak.find_leaks(corpus, q).collect()}
    assert got == want and {0, 1} == set(want.values())
    again = {(r["id"], r["item_index"]): r["distance"] for r in leak.find_leaks(corpus, q, part_bytes=20_000).collect()}
    assert again == want  # in parts
    assert leak.find_leaks(corpus, q.limit(0)).count() == 0 and leak.find_leaks(corpus.limit(0), q).count() == 0
    with pytest.raises(ValueError):
        leak.find_leaks(corpus, q, min_words=10)


def test_words_are_compared_in_canonical_form(spark):
    item = "Straße ＡＢＣ one two three four five six seven eight nine ten"
    text = "…STRASSE, abc; one-two three four (five) six seven eight nine ten!"
    assert textforms.words(item) == textforms.words(text)
    zh = "图版上的第三个标记在哪里呢请回答"
    d = spark.createDataFrame([(1, [("user", text)]), (2, [("user", zh), ("assistant", None)]), (3, None), (4, [])], "dialogue_id long, conversations array<struct<role:string,text:string>>")
    q = spark.createDataFrame([(10, item), (11, zh)], "item_index long, question string")
    assert sorted(tuple(r) for r in leak.dialogue_leaks(d, q).collect()) == [(1, 10, 0), (2, 11, 0)]
