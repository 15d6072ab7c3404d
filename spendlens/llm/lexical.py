"""Ranked lexical search over a length-stratified index.

A document's normaliser m is a whole number of its length, so documents of equal m form a stratum, in which a term's
part of a score depends on how often the document holds it (tf) and on nothing else. The index keeps each stratum in
blocks; a block lists its terms and, for each term, the documents by tf, highest first. A search works out each term's
impact once for a block and tf and adds impacts by document. The impacts of the highest tf add up to a bound that no
document of the block passes: the blocks of the highest bounds are visited first, and their results say which of the
others can still hold one of an item's best documents. Bounds only save visits; the ranks are those of a full scan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.session import materialize

from .batches import arrow_map, keep, slices, small_batches, texts_of
from .decontam import words_of
from .jaccard import Memo

TERM = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
#: Words and documents of a block at most (one document at least).
BLOCK_WORDS, BLOCK_DOCS = 1 << 19, 1 << 13
#: Words of the items that a search takes at once; more items are searched in several rounds.
ITEM_WORDS = 1 << 17
#: Blocks visited first for each item; blocks held at once; and scores, and postings, that a visit spreads out at once.
FIRST, HELD, SPREAD = 2, 256, 1 << 19
BEST = 20

#: A block's numbers: sorted terms, groups of each term, each group's tf and documents, and their places.
NUMBERS = {"terms": "<u8", "groups": "<u2", "tfs": "<u4", "sizes": "<u2", "places": "<u2"}


@dataclass
class Index:
    """``blocks`` with N (documents that hold a term) and L (all terms with repeats)."""

    blocks: DataFrame
    documents: int
    terms: int


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
    """Index every document that holds a term: all of its terms, by stratum.

    Terms are runs of digits, letters and non-ASCII characters, A-Z in lower case. A NULL text holds none. Rows that
    repeat a doc_id are documents of their own. Terms are kept as 64-bit hashes: one of T searched terms meets another
    of V indexed ones with odds of about T * V / 2 ** 64. Documents are dealt to tasks by m; Spark splits a stratum that
    outgrows a partition by its bytes, and a task holds one block at a time.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(TERM)).cast("long")).where("n > 0")
    size = rows.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    kind = rows.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("m", T.LongType()), T.StructField("docs", T.ArrayType(kind)),
        *[T.StructField(n, T.BinaryType()) for n in NUMBERS],
    ])
    if not size["docs"]:
        return Index(rows.sparkSession.createDataFrame([], schema), 0, 0)
    placed = rows.withColumn("m", normaliser(F.col("n"), size["docs"], size["terms"])).drop("n")
    ordered = placed.hint("rebalance", F.col("m")).sortWithinPartitions("m", F.col("doc_id").asc_nulls_last())
    with small_batches(docs.sparkSession):
        return Index(materialize(arrow_map(ordered, block_rows, schema), "index"), size["docs"], size["terms"])


def normaliser(n: Column, documents: int, terms: int) -> Column:
    return F.lit(75) + F.call_function("div", n * F.lit(25) * F.lit(documents).cast("long"), F.lit(terms).cast("long"))


def block_rows(batches) -> Iterator[pa.RecordBatch]:
    """Blocks of documents that follow each other and have the same m."""
    memo = keep(Memo)
    held: list[np.ndarray] = []
    ids: list[pa.Array] = []
    size, made, now = 0, 0, None

    def block() -> pa.RecordBatch:
        number = TaskContext.get().partitionId() << 33 | made
        docs = pa.concat_arrays(ids)
        listed = pa.ListArray.from_arrays([0, len(docs)], docs)
        raw = [pa.array([a.astype(k).tobytes()], pa.binary()) for a, k in zip(postings(held), NUMBERS.values())]
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([now]), listed, *raw], names=["block", "m", "docs", *NUMBERS])

    for batch in slices(batches, "text"):
        for k, (m, value) in enumerate(zip(batch.column("m").to_pylist(), texts_of(batch, "text"))):
            words = words_of(value)
            if held and (m != now or size + len(words) > BLOCK_WORDS or len(held) == BLOCK_DOCS):
                yield block()
                held, ids, size, made = [], [], 0, made + 1
            now = m
            held.append(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)))
            ids.append(batch.column("doc_id").slice(k, 1))
            size += len(words)
    if held:
        yield block()


def postings(docs: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Inverted lists of documents given as their words' hashes.

    Returns the sorted terms, how many groups each has, the groups' tf, highest first in each term, how many documents
    each has, and the documents' places, ascending in a group.
    """
    words = np.concatenate(docs)
    places = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    order = np.argsort(words, kind="stable")
    words, places = words[order], places[order]
    new = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (places[1:] != places[:-1])]))
    tf = np.diff(np.append(new, len(words)))
    words, places = words[new], places[new]
    begin = np.concatenate([[True], words[1:] != words[:-1]])
    term = np.cumsum(begin) - 1
    order = np.lexsort((-tf, term))
    tf, places, term = tf[order], places[order], term[order]
    group = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])]))
    return words[begin], np.bincount(term[group]), tf[group], np.diff(np.append(group, len(term))), places


class Items:
    """A block of items: their sorted distinct terms and, item by item, which terms they hold and how often."""

    def __init__(self, ids: pa.Array, copies: np.ndarray, texts: list[str]):
        memo = Memo()
        held = [np.unique(np.fromiter(map(memo.__getitem__, words_of(t)), np.uint64), return_counts=True) for t in texts]
        full = np.array([k for k, (terms, _) in enumerate(held) if len(terms)], int)
        self.ids, self.copies = ids.take(pa.array(full)), copies[full]
        held = [held[k] for k in full]
        sizes = [len(terms) for terms, _ in held]
        flat = np.concatenate([np.zeros(0, np.uint64), *(t for t, _ in held)])
        self.terms, self.column = np.unique(flat, return_inverse=True)
        self.count = np.concatenate([np.zeros(0, int), *(c for _, c in held)])
        self.start, self.item = np.cumsum([0, *sizes])[:-1], np.repeat(np.arange(len(held)), sizes)
        self.weights = np.zeros(len(self.terms), np.int64)

    def __len__(self) -> int:
        return len(self.copies)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, m: int) -> np.ndarray:
    return weights * (1_000_000_000 * tf // (1000 * tf + 12 * m))


def few(batches, column: str) -> Iterator[pa.RecordBatch]:
    """The blocks a few at a time, by number and bytes."""
    for batch in slices(batches, column):
        for start in range(0, batch.num_rows, HELD):
            yield batch.slice(start, HELD)


def numbers(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Per block its m and the named columns as 64-bit arrays (terms unsigned).

    ``groups`` and ``sizes`` come summed up: where each term's groups, and each group's places, begin, and the end.
    """
    columns = [batch.column(n).to_pylist() for n in names]
    for m, *raw in zip(batch.column("m").to_pylist(), *columns):
        out = [np.frombuffer(r, NUMBERS[n]).astype(np.uint64 if n == "terms" else np.int64) for r, n in zip(raw, names)]
        yield m, *(np.cumsum(np.append(0, a)) if n in ("groups", "sizes") else a for a, n in zip(out, names))


def meeting(terms: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``terms`` and in ``wanted`` (both sorted) of the terms that both hold."""
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    hit = np.flatnonzero(terms[at] == wanted)
    return at[hit], hit


def bounds(items: Items, m: int, terms: np.ndarray, firsts: np.ndarray, tfs: np.ndarray) -> np.ndarray:
    """For each item what no document of the block scores above."""
    at, hit = meeting(terms, items.terms)
    top = np.zeros(len(items.terms), np.int64)
    top[hit] = impacts(items.weights[hit], tfs[firsts[at]], m)
    return np.add.reduceat(top[items.column] * items.count, items.start)


def scores(items: Items, wanted: np.ndarray, size: int, m, terms, firsts, tfs, ends, places) -> np.ndarray:
    """Scores of the block's ``size`` documents (columns) for the ``wanted`` items (rows)."""
    at, hit = meeting(terms, items.terms)
    spot = np.full(len(items.terms), -1)
    spot[hit] = np.arange(len(hit))
    begin, end = ends[firsts[at]], ends[firsts[at + 1]]
    # one impact for each group of equal tf, spread over its postings
    groups = np.concatenate([np.arange(a, b) for a, b in zip(firsts[at], firsts[at + 1])]) if len(at) else np.zeros(0, int)
    value = impacts(np.repeat(items.weights[hit], firsts[at + 1] - firsts[at]), tfs[groups], m)
    value = np.repeat(value, ends[groups + 1] - ends[groups])
    offset = np.cumsum([0, *(end - begin)])
    row = np.full(len(items), -1)
    row[wanted] = np.arange(len(wanted))
    pairs = np.flatnonzero((row[items.item] >= 0) & (spot[items.column] >= 0))
    out = np.zeros(len(wanted) * size, np.int64)
    sizes = (end - begin)[spot[items.column[pairs]]]
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(SPREAD, sizes.sum() + SPREAD, SPREAD), side="right")
    for a, b in zip([0, *cuts], [*cuts, len(pairs)]):
        some, n = pairs[a:b], sizes[a:b]
        if not len(some):
            continue
        term = spot[items.column[some]]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        cell = np.repeat(row[items.item[some]] * size, n) + places[np.repeat(begin[term], n) + step]
        np.add.at(out, cell, value[np.repeat(offset[term], n) + step] * np.repeat(items.count[some], n))
    return out.reshape(len(wanted), size)


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[Items]:
    """The items in blocks of about ITEM_WORDS words; equal rows once, with their number."""
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).where("text is not null")
    rows = rows.groupBy("item_id", "text").agg(F.count("*").alias("copies"))
    size = rows.agg(F.sum(F.regexp_count("text", F.lit(TERM)))).first()[0] or 0
    blocks = -(-size // ITEM_WORDS)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)).cast("long"))
    for k in range(blocks):
        table = rows.where(part == k).toArrow()  # one block: bounded by ITEM_WORDS
        made = Items(table.column("item_id").combine_chunks(), table.column("copies").to_numpy(), table.column("text").to_pylist())
        if len(made):
            yield made


def weigh(index: Index, items: Items) -> None:
    """Give the items' terms their weights by the number of documents that hold them."""
    held = index.blocks.sparkSession.sparkContext.broadcast(items.terms)

    def step(batches):
        df = np.zeros(len(held.value), np.int64)
        for batch in batches:
            for _, terms, firsts, ends in numbers(batch, "terms", "groups", "sizes"):
                at, hit = meeting(terms, held.value)
                df[hit] += ends[firsts[at + 1]] - ends[firsts[at]]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])

    counts = arrow_map(index.blocks.select("m", "terms", "groups", "sizes"), step, "term long, df long")
    for row in counts.groupBy("term").agg(F.sum("df").alias("df")).collect():  # terms of one block of items
        items.weights[row["term"]] = weight(index.documents, row["df"])
    held.unpersist()


def first_blocks(index: Index, held) -> DataFrame:
    """For each item the FIRST blocks of the highest bounds: their numbers."""

    def step(batches):
        items = held.value
        for batch in few(batches, "terms"):
            every = np.stack([bounds(items, *b) for b in numbers(batch, "terms", "groups", "tfs")])
            top = np.argsort(-every, axis=0, kind="stable")[:FIRST]
            block = batch.column("block").to_numpy()[top]
            arrays = [np.tile(np.arange(len(items)), len(top)), block.ravel(), np.take_along_axis(every, top, 0).ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["item", "block", "bound"])

    every = arrow_map(index.blocks.select("block", "m", "terms", "groups", "tfs"), step, "item long, block long, bound long")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "block")
    return every.where("bound > 0").withColumn("k", F.row_number().over(order)).where(F.col("k") <= FIRST).select("block").distinct()


def visits(blocks: DataFrame, held, least, best: int, kind: T.DataType) -> DataFrame:
    """item (number), doc_id and score of the documents that can be among an item's ``best``.

    ``least`` holds for each item a score that so many documents are known to reach. In each batch the blocks are
    visited from the highest bound down; what a task has found raises its own limits.
    """

    def step(batches):
        items, limit = held.value, least.value.copy()
        tops = np.zeros((len(items), best), np.int64)
        for batch in few(batches, "places"):
            every = np.stack([bounds(items, *b) for b in numbers(batch, "terms", "groups", "tfs")])
            for k in np.argsort(-every.max(1), kind="stable").tolist():
                one = batch.slice(k, 1)
                docs, block = one.column("docs").flatten(), next(numbers(one, *NUMBERS))
                reach, parts = np.flatnonzero(every[k] >= limit), []
                for start in range(0, len(reach), max(1, SPREAD // len(docs))):
                    wanted = reach[start : start + max(1, SPREAD // len(docs))]
                    found = scores(items, wanted, len(docs), *block)
                    for row, item in enumerate(wanted.tolist()):
                        some = np.flatnonzero(found[row] >= limit[item])
                        if len(some) > best:
                            some = some[np.lexsort((some, -found[row][some]))[:best]]
                        if len(some):
                            parts.append((np.full(len(some), item), some, found[row][some]))
                            tops[item] = np.sort(np.concatenate([tops[item], found[row][some]]))[-best:]
                            limit[item] = max(limit[item], tops[item][0])
                if parts:
                    item, place, score = map(np.concatenate, zip(*parts))
                    yield pa.RecordBatch.from_arrays([pa.array(item), docs.take(pa.array(place)), pa.array(score)], names=["item", "doc_id", "score"])

    fields = [T.StructField("item", T.LongType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())]
    return arrow_map(blocks, step, T.StructType(fields))


def ranked(found: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def search(index: Index, items: DataFrame, item_id: str = "item_id", text: str = "text", best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``best`` documents with a score above 0.

    Equal scores rank by doc_id (null last). Items without a term, and a NULL text, give no rows. Each row of ``items``
    is an item: equal rows give their results as often as they occur, and rows that share an item_id but not their text
    rank on their own. An empty index gives no rows.
    """
    ids, kind = items.schema[item_id].dataType, index.blocks.schema["docs"].dataType.elementType
    out = None
    with small_batches(index.blocks.sparkSession):
        for block in item_blocks(items, item_id, text) if index.documents else ():
            rows = search_block(index, block, ids, best)
            out = rows if out is None else out.unionAll(rows)
    if out is None:
        fields = [("item_id", ids), ("rank", T.IntegerType()), ("doc_id", kind), ("score", T.LongType())]
        return items.sparkSession.createDataFrame([], T.StructType([T.StructField(*f) for f in fields]))
    return out


def search_block(index: Index, items: Items, ids: T.DataType, best: int) -> DataFrame:
    """The stored results of one block of items."""
    weigh(index, items)
    spark, kind = index.blocks.sparkSession, index.blocks.schema["docs"].dataType.elementType
    held = spark.sparkContext.broadcast(items)
    least = np.ones(len(items), np.int64)
    chosen = materialize(first_blocks(index, held), "first")  # FIRST rows for each of these items at most
    some = index.blocks.join(F.broadcast(chosen), "block", "left_semi")
    early = ranked(visits(some, held, spark.sparkContext.broadcast(least), best, kind), best)
    for row in early.where(F.col("rank") == best).select("item", "score").collect():  # one row an item at most
        least[row["item"]] = row["score"]
    rest = ranked(visits(index.blocks, held, spark.sparkContext.broadcast(least), best, kind), best)
    table = pa.Table.from_arrays([pa.array(np.arange(len(items))), items.ids, pa.array(items.copies)], names=["item", "item_id", "copies"])
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", ids), T.StructField("copies", T.LongType())])
    names = F.broadcast(spark.createDataFrame(table, schema))  # these items
    rows = rest.join(names, "item").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    out = materialize(rows.select("item_id", "rank", "doc_id", "score"), "ranks")
    held.unpersist()
    return out
