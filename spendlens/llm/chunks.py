"""Repeated passages: content-defined chunks by a gear rolling hash find the places, windows of words the exact ends."""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens.session import materialize

from .batches import arrow_map, release, slices, texts_of

#: A chunk ends where the top so many bits of the rolling hash are zero: 2 ** CUT_BITS bytes on average.
CUT_BITS = 5
#: Longer stretches without an end are cut at multiples of this, counted from the chunk's start.
LONGEST = 1024
#: Bytes that the rolling hash sees: one for each of its bits.
REACH = 32
#: Bytes before a chunk that its start may depend on: those that the hash sees, and a shift to a character's end.
BACK = REACH + 3
#: Words that a repeated passage holds at least, counted exactly.
LEAST_WORDS = 30
#: Bits of the filter of repeated digests, whatever the size of the data.
FILTER_BITS = 25

#: The gear table, by rule; a zero byte adds nothing, so that texts can be set apart by zeros.
GEAR = np.array([0, *(xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(1, 256))], np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum over the last REACH bytes of their gear values, shifted by their distance."""
    value = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        value[step:] += value[:-step] << np.uint32(step)
    return value


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Chunks of all texts: text number, start and end in the joined bytes, words begun; and the joined bytes."""
    gap = b"\0" * REACH
    joined = gap + gap.join([*texts, b""])
    data = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(np.concatenate([[0], sizes[:-1]])) + REACH * np.arange(1, len(texts) + 1)
    ends = np.flatnonzero(rolling(data) >> np.uint32(32 - CUT_BITS) == 0) + 1
    for _ in range(3):  # a chunk does not end inside a character
        inside = ends[ends < len(data)]
        ends = np.concatenate([inside + ((data[inside] & 0xC0) == 0x80), ends[ends >= len(data)]])
    owner = np.searchsorted(starts, ends, side="left") - 1  # an end at a text's start is no end
    fit = (owner >= 0) & (ends < (starts + sizes)[owner])
    edges = np.unique(np.concatenate([ends[fit], starts[sizes > 0], (starts + sizes)[sizes > 0]]))
    last = (starts + sizes)[sizes > 0]
    heads = edges[~np.isin(edges, last)]
    tails = edges[np.searchsorted(edges, heads, side="right")] if len(heads) else heads
    if (long := tails - heads > LONGEST).any():
        more = [h + k for h, t in zip(heads[long], tails[long]) for k in range(LONGEST, int(t - h), LONGEST)]
        return _recut(np.unique(np.concatenate([edges, _aligned(np.array(more), data)])), starts, sizes, data, joined)
    return _recut(edges, starts, sizes, data, joined)


def _aligned(at: np.ndarray, data: np.ndarray) -> np.ndarray:
    for _ in range(3):
        at = at + ((data[at] & 0xC0) == 0x80)
    return at


def _recut(edges, starts, sizes, data, joined):
    last = (starts + sizes)[sizes > 0]
    heads = edges[~np.isin(edges, last)]
    tails = edges[np.searchsorted(edges, heads, side="right")] if len(heads) else heads
    owner = np.searchsorted(starts, heads, side="right") - 1
    blank = (data == 32) | ((data >= 9) & (data <= 13)) | (data == 0)
    begun = np.concatenate([[0], np.cumsum(~blank[1:] & blank[:-1])])
    words = begun[tails - 1] - begun[heads - 1]
    return owner, heads, tails, words, joined


def digests(joined: bytes, heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    value = xxhash.xxh3_64_intdigest
    return np.fromiter((value(joined[a:b]) for a, b in zip(heads.tolist(), tails.tolist())), np.uint64, len(heads)).view(np.int64)


def windows(joined: bytes, heads: np.ndarray, tails: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of ``least`` words in the joined texts: first byte, end, and the chunk that stands for the run or -1.

    That is the first chunk that starts BACK bytes or more after the run's start, if it ends before the run does. The run's
    own bytes alone decide which it is, so equal runs have equal chunks, whatever text is around them.
    """
    data = np.frombuffer(joined, np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13)) | (data == 0)
    begins = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    stops = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    begins, stops = begins[: max(0, len(begins) - least + 1)], stops[least - 1 :]
    at = np.searchsorted(heads, begins + BACK)
    inside = np.append(tails, len(data))[at] < stops
    return begins, stops, np.where(inside, at, -1)


def _groups(batch: pa.RecordBatch, least: int):
    """The runs of a batch's texts, in groups of consecutive ones that the same chunk stands for.

    A run that no chunk stands for is a group of its own. Gives the runs (text number, first byte, end, number of the first
    word), each group's first run and the one after its last, the digest of its chunk with the BACK bytes before it, the
    digest of all its bytes, the joined bytes and the texts' starts in them.
    """
    texts = [t.encode() for t in texts_of(batch, "text")]
    _, heads, tails, _, joined = cut(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(np.concatenate([[0], sizes[:-1]])) + REACH * np.arange(1, len(texts) + 1)
    begins, stops, chunk = windows(joined, heads, tails, least)
    owner = np.searchsorted(starts, begins, side="right") - 1
    words = np.arange(len(begins)) - np.searchsorted(begins, starts)[owner]
    one = stops <= (starts + sizes)[owner]
    owner, begins, stops, words, chunk = owner[one], begins[one], stops[one], words[one], chunk[one]
    low = np.flatnonzero(np.append(True, (chunk[1:] != chunk[:-1]) | (chunk[1:] < 0))[: len(chunk)])
    high = np.append(low[1:], len(chunk)).astype(np.int64)[: len(low)]
    whole = digests(joined, begins[low], stops[high - 1])
    seed, has = whole.copy(), chunk[low] >= 0
    seed[has] = digests(joined, heads[chunk[low][has]] - BACK, tails[chunk[low][has]])
    return owner, begins, stops, words, low, high, seed, whole, joined, starts


def seeds(docs: DataFrame, least: int) -> DataFrame:
    """What finds the groups of runs of every whole text: doc_id, digest (of the chunk), whole (hash of all its bytes)."""

    def step(batches):
        for batch in slices(batches, "text", 2 << 20):
            owner, _, _, _, low, _, seed, whole, _, _ = _groups(batch, least)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner[low])), pa.array(seed), pa.array(whole)],
                names=["doc_id", "digest", "whole"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), step, f"doc_id {kind}, digest long, whole long")


def shared_seeds(docs: DataFrame, least: int) -> DataFrame:
    """Digests of chunks found in two documents or more, and whether the groups of runs around them differ (``mixed``)."""
    seen = seeds(docs, least).groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), (F.min("whole") != F.max("whole")).alias("mixed")
    )
    return seen.where("first != last").select("digest", "mixed")


RUN = "doc_id {kind}, text_key long, start int, end int, word int, words int, digest long"


def word_runs(docs: DataFrame, near: np.ndarray, mixed: np.ndarray, least: int) -> DataFrame:
    """The groups whose digest's bit is set in ``near``, or their single runs where it is set in ``mixed`` too: doc_id,
    text_key (a hash of the text), start and end (bytes of UTF-8, end exclusive), word (number of its first word), words,
    digest of the bytes."""
    held = docs.sparkSession.sparkContext.broadcast((near, mixed))

    def step(batches):
        for batch in slices(batches, "text", 2 << 20):
            owner, begins, stops, words, low, high, seed, whole, joined, starts = _groups(batch, least)
            at = seed.view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)
            byte, bit = (at >> np.uint64(3)).astype(np.int64), (at & np.uint64(7)).astype(np.uint8)
            shared, parted = (((bits[byte] >> bit) & 1).astype(bool) for bits in held.value)
            plain, single = np.flatnonzero(shared & ~parted), np.flatnonzero(shared & parted)
            many = high[single] - low[single]
            runs = np.repeat(low[single] - np.cumsum(many) + many, many) + np.arange(many.sum())
            first, last = np.concatenate([low[plain], runs]), np.concatenate([high[plain] - 1, runs])
            digest = np.concatenate([whole[plain], digests(joined, begins[runs], stops[runs])])
            whose = owner[first]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n).take(pa.array(whose)) for n in ("doc_id", "text_key")),
                 pa.array(begins[first] - starts[whose], pa.int32()), pa.array(stops[last] - starts[whose], pa.int32()),
                 pa.array(words[first], pa.int32()), pa.array(last - first + least, pa.int32()), pa.array(digest)],
                names=["doc_id", "text_key", "start", "end", "word", "words", "digest"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"), step, RUN.format(kind=kind))


def bits_of(keys: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A bit for the low bits of each digest, and the same for those that are ``mixed``: 2 ** FILTER_BITS bits each,
    however many digests there are."""
    at = F.col("digest").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    words = keys.select(at.alias("at"), "mixed").groupBy(F.shiftright("at", 6).cast("int").alias("word")).agg(
        F.bit_or(bit).alias("near"), F.bit_or(F.when(F.col("mixed"), bit).otherwise(F.lit(0).cast("long"))).alias("mixed")
    )
    got = words.toArrow()  # at most 2 ** (FILTER_BITS - 6) rows
    out = np.zeros((2, 1 << (FILTER_BITS - 6)), "<i8")
    for k, name in enumerate(("near", "mixed")):
        out[k, got.column("word").to_numpy()] = got.column(name).to_numpy()
    return out[0].view(np.uint8), out[1].view(np.uint8)


def passages(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """Repeated passages of ``docs`` (doc_id, text): doc_id, text_key, start, end, words, first.

    A passage is made of overlapping runs of ``least`` words, blanks between them included, that other documents hold too;
    so all that is repeated from ``least`` words on is found, up to its first and last whole word. ``first`` is the smallest
    doc_id that holds its first run. Runs first found in this document, which are no repetition here, and runs that an
    earlier one holds make separate passages, which may overlap. What repeats only within one document does not count, nor do
    documents of a NULL id. Rows that share a doc_id count as one document.

    Chunks stand for the runs at first: one held by a third of all documents shrinks to one row in each task before the
    shuffle. The texts are read a second time and tested against two filters of fixed size, so that only runs whose chunk
    is repeated are shuffled: as one row where all documents that hold the chunk hold the same runs around it.
    """
    near, mixed = bits_of(shared_seeds(docs, least))
    gc.collect()  # Python's names of the plan stand in a cycle; after them, Spark needs two rounds to drop its shuffle
    release(docs)
    found = materialize(word_runs(docs, near, mixed, least).where("doc_id is not null"), "runs")
    release(docs)
    seen = found.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = materialize(seen.where("first != last").select("digest", "first"), "digests")  # so that a hot digest's join can split
    held = found.join(shared, "digest").withColumn("own", F.col("first") == F.col("doc_id"))
    by_place = Window.partitionBy("doc_id", "text_key", "own").orderBy("start")
    new = F.coalesce(F.col("start") >= F.lag("end").over(by_place), F.lit(True)).cast("int")
    upto = by_place.rowsBetween(Window.unboundedPreceding, 0)
    runs = held.withColumn("new", new).withColumn("run", F.sum("new").over(upto))
    return runs.groupBy("doc_id", "text_key", "own", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        (F.max(F.col("word") + F.col("words")) - F.min("word")).cast("long").alias("words"), F.min_by("first", "start").alias("first"),
    ).drop("own", "run")


def report(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, repeated, n_passages, n_words (in them), n_bytes_cut, first_ids, spans.

    ``repeated`` tells whether the text holds a repeated passage, ``first_ids`` the documents that its passages are
    first found in (sorted; its own id where it is the first), ``n_bytes_cut`` the bytes that ``remove`` takes away
    and ``spans`` all passages (start, end in bytes).
    """
    own = F.col("first") == F.col("doc_id")
    held = passages(docs, least).groupBy("doc_id", "text_key").agg(
        F.count("*").alias("n_passages"), F.sum("words").alias("n_words"),
        F.sum(F.when(own, 0).otherwise(F.col("end") - F.col("start"))).alias("n_bytes_cut"),
        F.array_sort(F.collect_set("first")).alias("first_ids"),
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"))
    return rows.join(held, ["doc_id", "text_key"], "left").select(
        "doc_id", F.col("n_passages").isNotNull().alias("repeated"),
        *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("n_passages", "n_words", "n_bytes_cut")],
        "first_ids", "spans",
    )


def remove(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` (with doc_id and text) whose texts lose every passage that an earlier document holds."""
    cuts = passages(docs.select("doc_id", "text"), least).where("first != doc_id").groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")
    ).select(F.col("doc_id").alias("cut_id"), F.col("text_key").alias("cut_key"), F.col("spans").alias("cut_spans"))
    names = docs.columns
    match = (docs["doc_id"] == cuts["cut_id"]) & (F.xxhash64(docs["text"]) == cuts["cut_key"])
    joined = docs.join(cuts, match, "left").select(*[docs[n] for n in names], cuts["cut_spans"])

    def step(batches):
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            for k, spans in enumerate(batch.columns[-1].to_pylist()):
                if spans:
                    raw, kept, at = texts[k].encode(), [], 0
                    for span in spans:
                        kept.append(raw[at : span["start"]])
                        at = span["end"]
                    texts[k] = b"".join([*kept, raw[at:]]).decode()
            arrays = [pa.array(texts, c.type) if n == "text" else c for n, c in zip(names, batch.columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return arrow_map(joined, step, docs.schema)
