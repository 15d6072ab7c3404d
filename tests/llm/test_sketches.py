"""Near duplicates by sketches against all pairs, the sketch itself, and awkward inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm import sketches


def brute(rows):
    """(doc_id, n, component, kept) by all pairs of rows."""
    sets, parent = [], list(range(len(rows)))
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)} if words else set())

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None:
                common = len(sets[a] & sets[b])
                if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                    parent[find(a)] = find(b)
    out = []
    for k, (doc, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(k)]
        component = None if doc is None else min(g for g in group if g is not None)
        out.append((doc, len(sets[k]), component, doc == component))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for name in ("key", "n", "rep", "_gone", "CELLS"):
        df = df.withColumn(name, F.lit("kept"))
    return sorted(map(tuple, sketches.near_groups(df).collect()), key=repr)


def near_copies(seed, bases, copies, words, edits):
    draw = random.Random(seed)
    rows = []
    for _ in range(bases):
        base = [f"w{draw.randrange(5000)}" for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(draw.randrange(edits + 1)):
                text[draw.randrange(len(text))] = f"x{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("words, edits", [(300, 9), (40, 3), (12, 1)])
def test_like_all_pairs(spark, spread, words, edits):
    rows = near_copies(words, 12, 15, words, edits)
    assert found(spark, rows) == brute(rows)


def test_a_large_cell_with_many_components(spark, spread):
    """Copies too far from each other to link share cells; links between late members must not be lost."""
    rows = near_copies(3, 1, 120, 200, 24)
    want = brute(rows)
    assert 10 < len({r[2] for r in want}) < 115
    assert found(spark, rows) == want


def test_a_shared_passage_links_nothing(spark):
    draw = random.Random(9)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, passage + " " + " ".join(f"w{draw.randrange(10**6)}" for _ in range(60))) for k in range(60)]
    assert {r[2] for r in found(spark, rows)} == set(range(60))


def test_awkward_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (6, "ONE"), (7, "a b c d e f g"), (7, "a b c d e f g"), (7, "other words"),
        (8, "é🎉 naïve ß ŒUVRE " * 40), (None, "no id here at all"), (None, "no id here at all"), (9, "word " * 30_000), (10, "x" * 100_000),
        (-3, "a b c d e f g h"), (11, "two words"), (12, "two  WORDS"), (13, "Two\x0bwords"), (14, "no id here at all"),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows[:0]) == [] and found(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_dropping_keeps_all_columns(spark):
    rows = [(1, "a b c d e f"), (2, "A b c d e f"), (3, None), (None, "a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_gone", F.lit(1)).withColumn("n", F.lit(2))
    kept = sketches.drop_near_copies(df)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3]


def test_registers_hold_leading_zeros_and_mantissa():
    draw = np.random.default_rng(5)
    value = np.unique(draw.integers(0, 2**64, 900, dtype=np.uint64))
    value = np.unique(np.concatenate([value, np.array([7 << 56, 200 << 56 | 1], np.uint64)]))
    plain = np.zeros(256, int)
    for v in map(int, value[::-1]):
        rest = v & (1 << 56) - 1
        bits = format(rest >> 4, "052b")
        zeros = len(bits) - len(bits.lstrip("0"))
        mantissa = int((bits[zeros + 1 :] + "0" * 10)[:10], 2) if "1" in bits else 0
        plain[v >> 56] = 1 + (zeros << 10 | mantissa)
    assert sketches.registers(value).tolist() == plain.tolist()


def test_filled_registers_agree_as_often_as_sets():
    draw = np.random.default_rng(6)
    lender, agree = sketches.Lender(), []
    for _ in range(200):
        both = draw.integers(0, 2**64, 34, dtype=np.uint64)
        one, two = (np.sort(np.concatenate([both, draw.integers(0, 2**64, 3, dtype=np.uint64)])) for _ in range(2))
        filled = [lender.fill(sketches.registers(v)) for v in (one, two)]
        assert all((f > 0).all() for f in filled)
        agree.append((filled[0] == filled[1]).mean())
    assert abs(np.mean(agree) - 34 / 40) < 0.02


def test_estimate_is_corrected_for_collisions():
    draw = np.random.default_rng(7)
    chance = sketches.collisions()
    for common, own in ((0, 3000), (1500, 800), (2800, 200)):
        rows = []
        for _ in range(60):
            both = draw.integers(0, 2**64, common, dtype=np.uint64)
            rows.append([sketches.registers(np.sort(np.concatenate([both, draw.integers(0, 2**64, own, dtype=np.uint64)]))) for _ in range(2)])
        one, two = (np.array([r[k] for r in rows]) for k in (0, 1))
        value, used = sketches.estimate(one, two, np.full(60, common + own), chance)
        assert (used == 256).all() and abs(value.mean() - common / (common + 2 * own)) < 0.02
    # few bits make many collisions: the correction then matters
    assert 0.0001 < chance[12] < 0.002
