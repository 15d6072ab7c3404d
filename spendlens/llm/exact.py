"""Exact duplicates: counting quotient filters per partition, merged, then a comparison of the texts themselves."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.session import materialize

from .batches import arrow_map, fresh, join_filter, key_filter

#: White space that does not count when texts are compared.
BLANK = " \t\n\x0b\x0c\r"
#: Bits of a fingerprint that name its quotient; the other 64 - QUOTIENT_BITS are the remainder.
QUOTIENT_BITS = 20
#: Quotients are merged in so many ranges, each by one task at a time.
RANGES = 1 << 10
#: Fingerprints that one partition holds before it gives out a filter. Filters add up, so this changes no count.
FILTER_KEYS = 2_000_000

BLOCK = "range int, quotients binary, runs binary, remainders binary, counts binary"


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANK, "")


def filter_blocks(prints: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A counting quotient filter, cut into ranges of quotients.

    A block lists the quotients in use, the length of each one's run, the sorted remainders of all runs
    and their counts. Quotient and remainder together are the fingerprint, so nothing is lost.
    """
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    new = np.flatnonzero(np.diff(prints, prepend=prints[:1] + np.uint64(1)) != 0) if len(prints) else np.zeros(0, int)
    prints, counts = prints[new], np.add.reduceat(counts, new) if len(new) else counts
    shift = np.uint64(64 - QUOTIENT_BITS)
    quotients, remainders = prints >> shift, prints & ((np.uint64(1) << shift) - np.uint64(1))
    ranges = (quotients >> np.uint64(QUOTIENT_BITS - RANGES.bit_length() + 1)).astype(np.int32)
    columns: list[list] = [[], [], [], [], []]
    edges = [*np.flatnonzero(np.diff(ranges, prepend=-1)).tolist(), len(ranges)]
    for a, b in zip(edges, edges[1:]):
        used, runs = np.unique(quotients[a:b], return_counts=True)
        values = (used.astype("<u4"), runs.astype("<u4"), remainders[a:b].astype("<u8"), counts[a:b].astype("<i8"))
        columns[0].append(int(ranges[a]))
        for column, value in zip(columns[1:], values):
            column.append(value.tobytes())
    kinds = [pa.int32(), *[pa.binary()] * 4]
    names = ["range", "quotients", "runs", "remainders", "counts"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def read_blocks(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and counts of all blocks."""
    prints, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    parts = (batch.column(n).to_pylist() for n in ("quotients", "runs", "remainders", "counts"))
    for used, runs, rest, count in zip(*parts):
        heads = np.repeat(np.frombuffer(used, "<u4").astype(np.uint64), np.frombuffer(runs, "<u4"))
        prints.append((heads << np.uint64(64 - QUOTIENT_BITS)) | np.frombuffer(rest, "<u8"))
        counts.append(np.frombuffer(count, "<i8"))
    return np.concatenate(prints), np.concatenate(counts)


def build_filters(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        size += len(held[-1])
        if size >= FILTER_KEYS:
            yield filter_blocks(np.concatenate(held), np.ones(size, np.int64))
            held, size = [], 0
    if size:
        yield filter_blocks(np.concatenate(held), np.ones(size, np.int64))


def merge_filters(table: pa.Table) -> pa.Table:
    """All partitions' blocks of one range as one block: sorted remainders meet, their counts are added."""
    return pa.Table.from_batches([filter_blocks(*read_blocks(table))])


def quotient_filter(prints: DataFrame) -> DataFrame:
    """The merged counting quotient filter of a column of 64-bit fingerprints (``BLOCK`` rows)."""
    return arrow_map(prints, build_filters, BLOCK).groupBy("range").applyInArrow(merge_filters, BLOCK)


def filter_counts(blocks: DataFrame, least: int = 2) -> DataFrame:
    """The fingerprints that a filter counts at least ``least`` times."""

    def entries(batches):
        for batch in batches:
            prints, counts = read_blocks(batch)
            fit = counts >= least
            arrays = [pa.array(prints[fit].view(np.int64)), pa.array(counts[fit])]
            yield pa.RecordBatch.from_arrays(arrays, names=["print", "count"])

    return arrow_map(blocks, entries, "print long, count long")


def with_prints(docs: DataFrame, text: str) -> tuple[DataFrame, str, str]:
    """``docs`` with the normalised text and its fingerprint, under names that are free."""
    norm, mark = fresh(docs, "_norm"), fresh(docs, "_print")
    return docs.withColumn(norm, normalised(F.col(text))).withColumn(mark, F.xxhash64(norm)), norm, mark


def mark_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: which row of its group of equal texts stays.

    Texts are equal when they are the same after deleting blanks, tabs and line ends; null counts as empty.
    The row with most code points in its original text stays, then the one with the smallest doc_id (null
    last). Columns: doc_id, keep_id, group_size, kept, text_sha256. Of rows that share the doc_id that stays, only
    those with as many code points are kept. Rows that repeat both cannot be told apart and carry the same answer; ``drop_copies`` keeps one of them. No rows give no rows.

    Fingerprints that the merged filter counts more than once go on to a grouping by the texts themselves,
    which first shrinks within each task, so a text held by a third of the rows is sent a few times only.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows, norm, mark = with_prints(rows, "text")
    rows = rows.withColumn("n", F.char_length(F.coalesce("text", F.lit(""))))
    repeated = filter_counts(quotient_filter(rows.select(mark)))
    routed = join_filter(rows, F.col(mark), key_filter(repeated, "print"))
    # by length first: counts and smallest ids have a fixed width and shrink in the map tasks
    lengths = routed.groupBy(mark, norm, "n").agg(F.min("doc_id").alias("id"), F.count("*").alias("rows"))
    first = F.min(F.struct((-F.col("n")).alias("short"), F.col("id").isNull().alias("none"), "id")).alias("first")
    groups = lengths.groupBy(mark, norm).agg(F.sum("rows").alias("rows"), first).where("rows > 1").select(
        F.col(mark).alias("g_print"), F.sha2(norm, 256).alias("g_sha"), "rows", F.col("first.id").alias("keep"),
        (-F.col("first.short")).alias("keep_n"),
    )
    marked = rows.select("doc_id", "n", F.col(mark).alias("print"), F.sha2(norm, 256).alias("text_sha256"))
    same = (F.col("print") == F.col("g_print")) & (F.col("text_sha256") == F.col("g_sha"))
    keep = F.when(F.col("rows").isNull(), F.col("doc_id")).otherwise(F.col("keep"))
    return (
        marked.join(groups, same, "left")
        .withColumn("keep_id", keep)
        .select(
            "doc_id", "keep_id", F.coalesce("rows", F.lit(1).cast("long")).alias("group_size"),
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.coalesce("keep_n", "n"))).alias("kept"), "text_sha256",
        )
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept; rules as in ``mark_copies``.

    Rows whose fingerprint cannot be repeated pass straight through; only the others are shuffled.
    """
    names = docs.columns
    rows, norm, mark = with_prints(docs, text)
    repeated = materialize(filter_counts(quotient_filter(rows.select(mark))), "prints")  # read by both ways below
    places = key_filter(repeated, "print")
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    rank = F.struct(
        (-F.char_length(F.coalesce(F.col(text), F.lit("")))).alias("short"), F.col(doc_id).isNull().alias("none"),
        F.col(doc_id).alias("id"),
    )
    kept = join_filter(rows, F.col(mark), places).groupBy(norm).agg(F.min_by(row, rank).alias("_row")).select("_row.*")
    return join_filter(rows, F.col(mark), places, "left_anti").select(*[f"`{c}`" for c in names]).unionAll(kept)
