"""Near duplicates by HyperMinHash sketches, banding, a collision-corrected estimate and an exact check.

A document's set of word shingles is hashed to 64 bits. The first bits name a bucket; of a bucket's smallest hash the
sketch keeps the number of leading zeros and the mantissa bits after them, 16 bits a bucket. Documents whose registers
agree in all rows of a band meet in that band's cell. Cells hold candidates only: pairs are tested by size and parity
bits, by the Jaccard estimate of their registers corrected for chance collisions, and at last on their full sets. Near
copies in a cell are not compared with each other all at once, see ``near_groups``.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.session import discard, materialize

from .batches import add_columns, arrow_map, fresh, keep, slices, texts_of, with_arrays
from .jaccard import PARITY, Memo, components, differing, every_key, joined, mix, parity, set_key

WORDS, PERCENT = 3, 85
BUCKETS, MANTISSA = 256, 10
#: Registers of a band, and bands. Two large sets at the threshold share no band with odds of 2.3e-9
#: ((1 - 0.85 ** 6) ** 42); closer or smaller ones with less.
ROWS, BANDS = 6, 42
#: A pair is ruled out by an estimate only where it lies so many standard deviations below a link's.
DEVIATIONS = 6
#: Members of a region that the first round compares with the others, and their growth with each round.
PROBES, GROWTH = 4, 8

REST = 64 - (BUCKETS.bit_length() - 1)
BORDERS = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(REST)
FACTORS = np.array([xxhash.xxh3_64_intdigest(bytes([k]), 17) | 1 for k in range(max(WORDS, ROWS))], np.uint64)
BAND_SALTS = np.array([xxhash.xxh3_64_intdigest(bytes([k]), 19) for k in range(BANDS)], np.uint64)


def shingles(text: str) -> np.ndarray:
    """A text's shingles as sorted distinct 64-bit hashes; a text of fewer words has one, of all its words."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b"\0" + b" ".join(words))], np.uint64)
    hashes = np.fromiter(map(keep(Memo).__getitem__, words), np.uint64, len(words))
    count = len(words) - WORDS + 1
    total = np.zeros(count, np.uint64)
    for k in range(WORDS):
        total += hashes[k : k + count] * FACTORS[k]
    value = np.sort(mix(total))
    return value[np.concatenate([[True], value[1:] != value[:-1]])]


def registers(value: np.ndarray) -> np.ndarray:
    """Per bucket 1 + (leading zeros, mantissa bits) of its smallest hash; 0 where the bucket is empty."""
    out = np.zeros(BUCKETS, np.uint16)
    starts = np.searchsorted(value, BORDERS)
    full = np.flatnonzero(np.diff(np.append(starts, len(value))))
    # 52 bits fit a double exactly, whose exponent and fraction are the zeros and the mantissa
    rest = (value[starts[full]] & np.uint64((1 << REST) - 1)) >> np.uint64(REST - 52)
    fraction, exponent = np.frexp(rest.astype(np.float64))
    bits = np.where(rest > 0, (2 * fraction - 1) * (1 << MANTISSA), 0).astype(np.int64)
    out[full] = 1 + ((52 - exponent) << MANTISSA) + bits
    return out


class Lender:
    """For each bucket the order in which it borrows from others when it is empty, the same for all sets."""

    def __init__(self):
        order = mix(np.arange(BUCKETS * BUCKETS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        self.order = order.reshape(BUCKETS, BUCKETS)

    def fill(self, row: np.ndarray) -> np.ndarray:
        """Registers without gaps: agreement of two sets' registers stays as likely as their Jaccard similarity."""
        full = np.flatnonzero(row)
        if len(full) == BUCKETS:
            return row
        out, empty = row.copy(), np.flatnonzero(row == 0)
        out[empty] = row[full[self.order[empty][:, full].argmin(1)]]
        return out


def band_keys(filled: np.ndarray) -> np.ndarray:
    """64-bit cells of a sketch without gaps (of many, row by row), one for each band."""
    rows = filled[..., : ROWS * BANDS].astype(np.uint64).reshape(*filled.shape[:-1], BANDS, ROWS)
    return mix((rows * FACTORS[:ROWS]).sum(-1, dtype=np.uint64) + BAND_SALTS)


def sketched(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n, key and parity bits of the set, and registers (bytes).

    The last two are NULL without words.
    """

    def step(batches):
        for batch in slices(batches, "text"):
            sets = [shingles(t) for t in texts_of(batch, "text")]
            raw = [registers(s).astype("<u2").tobytes() if len(s) else None for s in sets]
            keys = np.array([set_key(s) for s in sets], np.uint64).view(np.int64)
            bits = pa.array([parity(s, PARITY) if len(s) else None for s in sets], pa.list_(pa.int64()))
            arrays = [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys), bits, pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "key", "bits", "registers"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs, step, f"doc_id {kind}, n long, key long, bits array<long>, registers binary")


def banded(sets: DataFrame) -> DataFrame:
    """``sets`` (with key and registers) and the cells of each."""

    def step(batches):
        lender = keep(Lender)
        for batch in batches:
            rows = [np.frombuffer(r, "<u2") for r in batch.column("registers").to_pylist()]
            filled = np.array([lender.fill(r) for r in rows], np.uint16).reshape(-1, BUCKETS)
            yield with_arrays(batch, {"cells": pa.array(list(band_keys(filled).view(np.int64)), pa.list_(pa.int64()))})

    return add_columns(sets, step, [T.StructField("cells", T.ArrayType(T.LongType()))])


def sizes_fit(n: Column, m: Column) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def bits_fit(n: Column, m: Column, a: Column, b: Column) -> Column:
    """Whether few enough parity bits differ: each of them shows a shingle that only one of the sets has."""
    return differing(a, b, PARITY) * (100 + PERCENT) <= (n + m) * (100 - PERCENT)


def collisions() -> np.ndarray:
    """Odds that unequal minima of a bucket leave equal registers, for 2 ** k hashes a set, k = 0, 1, ..."""
    zeros, fraction = np.arange(REST)[:, None], np.arange(1 << MANTISSA)
    start = 2.0 ** -(zeros + 1) * (1 + fraction / (1 << MANTISSA))
    end = start + 2.0 ** -(zeros + 1 + MANTISSA)
    out = []
    for k in range(40):
        load = 2.0**k / BUCKETS  # hashes of a bucket
        at = (np.exp(-load * start) - np.exp(-load * end)) / -np.expm1(-load)
        out.append((at * at).sum())
    return np.array(out)


def estimate(one: np.ndarray, two: np.ndarray, n: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of rows of registers, corrected for collisions, and the number of buckets they rest on."""
    used = ((one > 0) | (two > 0)).sum(1)
    same = ((one > 0) & (one == two)).sum(1) / np.maximum(used, 1)
    odds = chance[np.log2(np.maximum(n, 1)).astype(int)]
    return (same - odds) / (1 - odds), used


def estimated(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b, na, nb), those whose estimate is not too low for a link: by DEVIATIONS deviations of a link's."""
    one = sets.select(F.col("key").alias("a"), F.col("registers").alias("ra"))
    two = sets.select(F.col("key").alias("b"), F.col("registers").alias("rb"))

    def step(batches):
        chance, link = collisions(), PERCENT / 100
        for batch in batches:
            rows = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, BUCKETS) for c in ("ra", "rb"))
            value, used = estimate(*rows, batch.column("na").to_numpy(), chance)
            fit = value >= link - DEVIATIONS * np.sqrt(link * (1 - link) / np.maximum(used, 1))
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(fit))

    return arrow_map(pairs.join(one, "a").join(two, "b"), step, "a long, b long, na long, nb long")


def bags(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """key and whole shingle set of the ends of ``pairs``, from the texts of their first documents."""

    def step(batches):
        for batch in slices(batches, "text"):
            made = [shingles(t) for t in texts_of(batch, "text")]
            keys = np.array([set_key(s) for s in made], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([s.view(np.int64) for s in made], pa.list_(pa.int64()))], names=["key", "bag"])

    needed = materialize(sets.select("key", "rep").join(every_key(pairs), "key"), "needed")
    rows = docs.join(needed.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("text")
    made = arrow_map(rows, step, "key long, bag array<long>").join(needed.select("key"), "key", "left_semi")
    # rows of one doc_id may repeat a text
    return made.dropDuplicates(["key"])


def links(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The links among pairs (a, b, na, nb): estimated first, then checked on the full sets; stored."""
    near = materialize(estimated(pairs, sets), "near")
    held = materialize(bags(docs, sets, near), "bags")
    first = held.select(F.col("key").alias("a"), F.col("bag").alias("bag_a"))
    second = held.select(F.col("key").alias("b"), F.col("bag").alias("bag_b"))
    common = F.size(F.array_intersect("bag_a", "bag_b"))
    sure = near.join(first, "a").join(second, "b").where(common * 100 >= (F.col("na") + F.col("nb") - common) * PERCENT)
    found = materialize(sure.select("a", "b"), "links")
    discard(near, held)
    return found


def met(one: DataFrame, two: DataFrame, on: str, extra: Column) -> DataFrame:
    """Pairs (a, b, na, nb) of members that meet under ``on`` and whose sizes and parity bits allow a link."""
    columns = [c for c in one.columns if c != on]
    left = one.select(on, *[F.col(c).alias(f"{c}_a") for c in columns])
    right = two.select(on, *[F.col(c).alias(f"{c}_b") for c in columns])
    n, m = F.col("n_a"), F.col("n_b")
    fit = sizes_fit(n, m) & bits_fit(n, m, F.col("bits_a"), F.col("bits_b")) & extra
    ordered = F.col("key_a") < F.col("key_b")
    return left.join(right, on).where(fit).select(
        F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"),
        F.when(ordered, n).otherwise(m).alias("na"), F.when(ordered, m).otherwise(n).alias("nb"),
    ).distinct()


def open_regions(members: DataFrame, roots: DataFrame, done: int) -> DataFrame:
    """region, key, root and size of the region, for regions of more than ``done`` members and several components.

    A region is all members whose pivots have the same root.
    """
    at = roots.select(F.col("key").alias("pivot"), F.col("root").alias("region"))
    placed = members.join(at, "pivot", "left").select(F.coalesce("region", "pivot").alias("region"), "key").distinct()
    placed = placed.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    sizes = placed.groupBy("region").agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"))
    return placed.join(sizes.where((F.col("low") != F.col("high")) & (F.col("size") > done)).drop("low", "high"), "region")


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept.

    Words are runs of anything but blanks, tabs and line ends, A-Z in lower case; a document's set holds its distinct
    shingles of three words, or all its words as one if it has fewer. Two documents link when the Jaccard similarity of
    their sets is 0.85 or more. Documents with equal sets are one node. Without words or text a document links with
    nothing. A document of a NULL id links with nothing, has a NULL component and is kept. Rows that repeat a doc_id are
    documents of their own with their own sets. Empty tables give no rows.

    In each cell all members are first compared with the one of the smallest key, the pivot. Cells whose pivots are
    linked make a region. Regions that hold several components go on in rounds: a growing share of their members,
    chosen by hash, is compared with those members of other components, until each pair of a region has been compared
    or is connected. So a large group of near copies costs a few comparisons for each member, not for each pair, and no
    cell or region is capped.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = materialize(sketched(docs), "sketches")
    same = marked.where("n > 0 and doc_id is not null").groupBy("key").agg(
        F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("n", "bits", "registers")]
    )
    sets = materialize(banded(same), "cells")
    slim = sets.select("key", "n", "bits")
    cells = sets.select(F.explode("cells").alias("cell"), "key")
    heads = cells.groupBy("cell").agg(F.min("key").alias("pivot"), F.max("key").alias("last")).where("pivot != last")
    members = materialize(cells.join(heads.drop("last"), "cell").select("pivot", "key").distinct(), "members")
    pivots = slim.select(F.col("key").alias("pivot"), "key", "n", "bits")
    pairs = materialize(met(pivots, members.where("pivot != key").join(slim, "key"), "pivot", F.lit(True)), "pairs")
    roots = components(links(docs, sets, pairs))
    done, size = 2, PROBES
    while True:
        inside = materialize(open_regions(members, roots, done).join(slim, "key"), "inside")
        if inside.isEmpty():
            break
        chosen = inside.where(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1 << 30)) * F.col("size") < size * (1 << 30))
        pairs = materialize(met(chosen, inside, "region", F.col("root_a") != F.col("root_b")), "pairs")
        found = links(docs, sets, pairs)
        if not found.isEmpty():
            roots = joined(roots, found)
        discard(inside, pairs, found)
        done, size = size, size * GROWTH
    rooted = sets.select("key", "rep").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    lowest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = rooted.join(lowest, "root").select("key", "component_id")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return marked.select("doc_id", "n", "key").join(classes, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without documents that a smaller doc_id reaches by links, all columns kept.

    Rows go by doc_id: where an id repeats, its rows stay if one of them is kept.
    """
    groups = near_groups(docs, doc_id, text).where("doc_id is not null")
    gone = groups.groupBy("doc_id").agg(F.bool_or("kept").alias("any")).where("not any")
    mark = fresh(docs, "_gone")
    return docs.join(gone.select(F.col("doc_id").alias(mark)), F.col(doc_id) == F.col(mark), "left_anti")
