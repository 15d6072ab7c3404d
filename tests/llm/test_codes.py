"""Vector codes against a plain version of Lloyd's rounds, and on awkward inputs."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, codes string"


def brute(rows):
    """Whole rows as (vec_id, code, error, label_error, digest), by all distances in Python's integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(4096 * float(np.float32(x))) for x in r[1]] for r in kept]
    wide = len(whole[0]) // 8
    books = [[v[p * wide : (p + 1) * wide] for v in whole[:16]] for p in range(8)]

    def assign(p):
        out = []
        for v in whole:
            part = v[p * wide : (p + 1) * wide]
            gaps = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[p]]
            out.append((min(gaps), gaps.index(min(gaps))))
        return out

    for _ in range(6):
        for p in range(8):
            chosen = [e for _, e in assign(p)]
            for e in range(len(books[p])):
                mine = [v[p * wide : (p + 1) * wide] for v, c in zip(whole, chosen) if c == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [assign(p) for p in range(8)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(f[k][0] for f in found) for k in range(len(whole))]
    by_label = {}
    for r, e in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return [
        (r[0], "".join(f"{f[k][1]:02x}" for f in found), errors[k], by_label[r[2]], digest) for k, r in enumerate(kept)
    ]


def same(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(3)
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, codes.report(df).collect()), key=order) == sorted(brute(rows), key=order)


@pytest.mark.parametrize("wide", [1, 3])
def test_like_all_distances(spark, wide):
    draw = random.Random(wide)
    rows = [(k, [draw.choice([-1, 0, 1]) + draw.gauss(0, 0.2) for _ in range(8 * wide)], draw.randrange(3)) for k in range(300)]
    same(spark, rows)


def test_nulls_ties_repeats_and_few_rows(spark):
    one = [0.5, -0.5, 0.25, -0.25, 0.0, 1.0, -1.0, 2.0]
    rows = [
        (5, one, 1), (5, one, 1), (5, one[::-1], None), (None, one, None), (2, None, 1), (3, [*one[:7], None], 1),
        (4, [*one[:7], float("nan")], 1), (6, [*one[:7], float("-inf")], 2), (-7, [0.0] * 8, 2), (8, [1e-5] * 8, 2),
    ]
    same(spark, rows)
    empty = spark.createDataFrame([r for r in [(2, None, 1)]], "vec_id long, embedding array<float>, label int")
    assert codes.report(empty).collect() == [] and codes.report(empty.where("vec_id = 0")).collect() == []


def test_uneven_vectors_are_refused(spark):
    for rows in ([(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)], [(1, [1.0] * 7, 1)], [(1, [], 1)], [(1, [1e9] * 8, 1)]):
        with pytest.raises(Exception, match="vectors must|components must"):
            codes.report(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()


def test_trees_decide_like_all_distances():
    draw = np.random.default_rng(3)
    for size, wide, spread in ((1, 2, 9), (17, 1, 3), (700, 2, 40), (3000, 8, 4000)):
        values = draw.integers(-spread, spread, (size, 8 * wide))
        values[: size // 3] //= 10
        block = codes.Block.build(values)
        for p in range(8):
            parts = values[:, p * wide : (p + 1) * wide]
            entries = parts[: codes.ENTRIES]
            gaps = ((parts[:, None] - entries[None]) ** 2).sum(2)
            code, error = block.codes(p, entries)
            assert (code == gaps.argmin(1)).all() and (error == gaps.min(1)).all()
            total, count = block.sums(p, entries)
            assert (count == np.bincount(code, minlength=len(entries))).all()
            assert all((total[e] == parts[code == e].sum(0)).all() for e in range(len(entries)))


def test_whole_nodes_are_assigned_by_their_sums():
    draw = np.random.default_rng(4)
    values = np.concatenate([draw.integers(-9, 9, (500, 16)) + 1000 * k for k in range(4)])
    _, low, high, _ = codes.part_tree(values[:, :2])
    whole, (leaves, _) = codes.walk(len(values), low, high, np.array([[0, 0], [1000, 1000], [2000, 2000], [3000, 3000]]))
    assert not len(leaves) and {level for level, *_ in whole} == {2}


def test_hot_label_and_extra_columns(spark):
    df = spark.range(2000).select(
        F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.sin(F.col("id") * (k + 1)).cast("float")).alias("embedding"),
        F.when(F.col("id") % 3 > 0, 1).alias("label"), F.lit(1).alias("error"), F.lit("x").alias("CODES"),
    )
    got = codes.report(df)
    assert got.count() == 2000 and got.select("label_error").distinct().count() == 2
