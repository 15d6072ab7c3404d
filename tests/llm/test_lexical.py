"""Ranked search against plain scoring of every document, and on awkward inputs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def brute(docs, items, best=20):
    held = [(doc, terms(text)) for doc, text in docs]
    held = [(doc, Counter(t), len(t)) for doc, t in held if t]
    count, total = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c, n in held:
            m = 75 + (25 * n * count) // total
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms(text) if t in c
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, k + 1, None if none else doc, -s) for k, (s, none, doc) in enumerate(sorted(scored)[:best])]
    return sorted(out, key=repr)


def found(spark, docs, items, best=20):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for name in ("m", "n", "block", "item", "score", "TERMS"):
        docs = docs.withColumn(name, F.lit("kept"))
    items = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(1))
    return sorted(map(tuple, lexical.search(lexical.build_index(docs), items, best=best).collect()), key=repr)


def corpus(seed, size):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Ünï", "ünï", "A1b2", "日本"]
    rows = []
    for k in range(size):
        n = draw.choice([1, 2, 5, 30, 200])
        rows.append((k, draw.choice([" ", "-", "\n"]).join(draw.choices(words, [1 / (j + 1) for j in range(len(words))], k=n))))
    return rows, draw


@pytest.mark.parametrize("seed", [0, 1])
def test_like_a_full_scan(spark, spread, seed):
    docs, draw = corpus(seed, 400)
    items = [(k, " ".join(draw.choice(docs)[1].split()[:20])) for k in range(30)]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, 3) == brute(docs, items, 3)


def test_small_blocks_and_item_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_WORDS", 40)
    docs, draw = corpus(5, 150)
    items = [(k, " ".join(draw.choice(docs)[1].split()[:20])) for k in range(20)]
    assert found(spark, docs, items) == brute(docs, items)


def test_nulls_ties_repeats_and_long_texts(spark):
    docs = [
        (1, None), (2, ""), (3, " .,;\t"), (4, "same text here"), (5, "same text here"), (5, "same text here"), (None, "same text here"),
        (-6, "Same TEXT here"), (7, "word " * 50_000 + "rare"), (8, "x" * 200_000), (9, "ŒUVRE é🎉 same"),
        *((100 + k, "copy of one line") for k in range(60)),
    ]
    items = [
        (1, "same text"), (1, "same text"), (1, "rare"), (2, None), (3, "  "), (4, "nowhere"), (None, "copy"), (5, "word word word rare x"),
        (6, "é🎉 œuvre ŒUVRE"), (7, "x" * 200_000),
    ]
    assert found(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a")], []) == [] and found(spark, [(1, None)], [(1, "a")]) == []


def test_postings_and_bounds():
    draw = np.random.default_rng(1)
    docs = [draw.integers(0, 30, n).astype(np.uint64) for n in (1, 5, 40, 40, 300)]
    held, groups, tfs, sizes, places = lexical.postings(docs)
    firsts, ends = (np.cumsum(np.append(0, a)) for a in (groups, sizes))
    got = {}
    for k, t in enumerate(held):
        groups = range(firsts[k], firsts[k + 1])
        assert list(tfs[groups]) == sorted(set(tfs[groups]), reverse=True)
        for g in groups:
            for p in places[ends[g] : ends[g + 1]]:
                got[int(t), int(p)] = int(tfs[g])
    want = {(int(t), p): n for p, d in enumerate(docs) for t, n in Counter(d.tolist()).items()}
    assert got == want
    import pyarrow as pa

    items = lexical.Items(pa.array([1]), np.array([1]), ["a b"])
    items.terms, items.column, items.count = held, np.arange(len(held)), np.ones(len(held), int)
    items.start, items.item, items.weights = np.array([0]), np.zeros(len(held), int), draw.integers(0, 99, len(held))
    m = 80
    full = lexical.scores(items, np.array([0]), len(docs), m, held, firsts, tfs, ends, places)[0]
    plain = [sum(int(items.weights[k]) * (10**9 * n // (1000 * n + 12 * m)) for k, t in enumerate(held) if (n := want.get((int(t), p)))) for p in range(5)]
    assert full.tolist() == plain and lexical.bounds(items, m, held, firsts, tfs)[0] >= max(plain)


def test_bounds_save_visits(spark, monkeypatch):
    """Documents of a long stratum cannot reach what the short ones score."""
    import pyarrow as pa

    docs = [np.array([1, 2], np.uint64)], [np.array([1, *range(100, 400)], np.uint64)]
    items = lexical.Items(pa.array([1]), np.array([1]), ["a b"])
    items.terms, items.column, items.count, items.start = np.array([1, 2], np.uint64), np.arange(2), np.ones(2, int), np.array([0])
    items.weights, items.item = np.array([5, 5]), np.zeros(2, int)
    short, long_ = ([np.cumsum(np.append(0, a)) if k in (1, 3) else a for k, a in enumerate(lexical.postings(d))] for d in docs)
    best = lexical.scores(items, np.array([0]), 1, 75, *short)[0][0]
    assert lexical.bounds(items, 900, *long_[:3])[0] < best
