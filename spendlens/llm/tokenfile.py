"""Token ids on disk: frequency-ranked ids in byte-aligned variable length, their widths in separate control bytes."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendlens.session import materialize, scratch_path

from .batches import arrow_map, keep, slices, texts_of

#: White-space-separated chunks whose ids a Python worker remembers; beyond that it starts anew.
MEMO_ENTRIES = 600_000
#: Marks that never join with a letter or digit before them.
MARKS = b".,;:!?*#$%&|"
#: Bytes of text whose chunks are told apart in one call.
CALL_BYTES = 6 << 20
#: Chunks that the tokenizer gets in one call.
CALL_CHUNKS = 10_000
#: Letters that no neighbour changes: a word of them alone is one piece, each letter brought to its form by itself.
LETTERS = [chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
#: Ids of one block of a file.
BLOCK_IDS = 1 << 20

#: Lengths of the four ids that a control byte speaks of: two bits each, lowest bits first, 0 means one byte.
WIDTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def pack_ids(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers; the last control byte is filled up with zeros."""
    ranks = ranks.astype("<u4")
    widths = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = widths - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    used = np.arange(4, dtype=np.uint8) < widths[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack_ids(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers that ``pack_ids`` packed: widths by table lookup, then bytes to their places."""
    widths = WIDTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    out = np.zeros((count, 4), np.uint8)
    out[np.arange(4, dtype=np.uint8) < widths[:, None]] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view("<u4")


class Memo(dict):
    """Ids of white-space-separated chunks as little-endian 32-bit integers, worked out when first asked for.

    For tokenizers that drop white space, treat what stands between by itself and put all into lower case.
    """

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.whole = Tokenizer.from_str(text), Tokenizer.from_str(text)
        self.tokenizer.encode_special_tokens = True  # chunks are in lower case, where a special token's string may be none
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.model, self.forms = self.tokenizer.model, self._letter_forms()
        self.plain = re.compile(f"[{''.join(map(chr, self.forms))}]+").fullmatch if self.forms else lambda _: None

    def _letter_forms(self) -> dict[int, str]:
        """What the model gets for each of ``LETTERS``, asked of the tokenizer; none where it treats them otherwise."""
        def pieces(word: str) -> list[str]:
            if self.tokenizer.normalizer:
                word = self.tokenizer.normalizer.normalize_str(word)
            split = self.tokenizer.pre_tokenizer.pre_tokenize_str(word) if self.tokenizer.pre_tokenizer else [(word, None)]
            return [piece for piece, _ in split]

        forms = [pieces(c) for c in LETTERS]
        alone = any(s.isalpha() for s in self.special)
        if alone or any(len(f) != 1 for f in forms) or pieces("".join(LETTERS)) != ["".join(f for f, in forms)]:
            return {}
        return {ord(c): f for c, (f,) in zip(LETTERS, forms)}

    def ids_of(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text: of each different chunk of all the texts, looked up once, put together by its places."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))  # A-Z: the tokenizer does too
        every, starts = split.flatten(), split.offsets.to_numpy()
        full = pc.greater(pc.binary_length(every), 0)  # blanks at either end of a text leave empty chunks
        before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
        coded = every.filter(full).dictionary_encode()
        one_list = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary.cast(pa.binary()))
        chunks = pc.binary_join(one_list, pa.scalar(b" ", pa.binary()))[0].as_py().split()
        found = list(map(self.get, chunks))
        new = [k for k, ids in enumerate(found) if ids is None]
        self.learn({chunks[k] for k in new})
        for k in new:
            found[k] = self[chunks[k]]
        ids = pa.array(found, pa.large_binary()).take(coded.indices)
        sizes = pc.binary_length(ids).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes)])[before[starts - starts[0]]].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]

    def learn(self, chunks: set[bytes]) -> None:
        """Encode unknown chunks, many in one call: a token belongs to the chunk that its first character is in."""
        unknown = chunks.difference(self)
        if len(self) + len(unknown) > MEMO_ENTRIES:
            self.clear()
            unknown = chunks
        known, later, rest = self.get, [], set()
        for chunk in unknown:
            core, marks = chunk.rstrip(MARKS), b""
            if len(core) < len(chunk) and core[-1:].isalnum():  # marks after a letter or digit stand by themselves
                marks = chunk[len(core) :]
            else:
                core = chunk
            ids = known(core)
            if ids is None:
                word = core.decode()
                if self.plain(word):  # one piece whose form is known: the model alone, a third of the whole way's work
                    found = [token.id for token in self.model.tokenize(word.translate(self.forms))]
                    ids = self[core] = struct.pack(f"<{len(found)}I", *found)
                else:
                    rest.add(core)
            tail = known(marks) if marks else b""
            if tail is None:
                rest.add(marks)
            if ids is None or tail is None:
                later.append((chunk, core, marks))
            elif marks:
                self[chunk] = ids + tail
        self._encode([c.decode() for c in rest])
        for chunk, core, marks in later:
            if marks:
                self[chunk] = self[core] + self[marks]

    def _encode(self, new: list[str]) -> None:
        for k in range(0, len(new), CALL_CHUNKS):
            block = new[k : k + CALL_CHUNKS]
            starts = np.cumsum([0, *[len(c) + 1 for c in block]])
            got = self.tokenizer.encode(" ".join(block), add_special_tokens=False)
            at = np.fromiter((a for a, _ in got.offsets), np.int64, len(got.ids))
            cuts = np.searchsorted(at, starts).tolist()
            raw = np.array(got.ids, "<u4").tobytes()
            for chunk, a, b in zip(block, cuts, cuts[1:]):
                self[chunk.encode()] = raw[4 * a : 4 * b]

    def special_ids(self, text: str) -> bytes | None:
        """The ids of a text that holds a special token's string, which stands for that token; None for other texts."""
        if not any(s in text for s in self.special):
            return None
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _memo(held) -> Memo:
    return Memo(held.value)


def shrink(ids: bytes) -> bytes:
    """Ids for the way between two steps: the four bytes of all ids, lowest first, compressed."""
    planes = np.frombuffer(ids, np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def grow(shrunk: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(shrunk), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def encode(docs: DataFrame, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids (shrunk) of every whole text, ``end_id`` appended; null counts as empty."""
    with open(tokenizer_path, encoding="utf-8") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())
    last = np.array([end_id], "<u4").tobytes()

    def step(batches):
        memo = keep(_memo, held)
        for batch in slices(batches, "text", CALL_BYTES):
            texts = texts_of(batch, "text")
            special = [memo.special_ids(value) for value in texts]
            plain = pa.array([value if s is None else "" for value, s in zip(texts, special)], pa.large_string())
            ids = [(s or found) + last for s, found in zip(special, memo.ids_of(plain))]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            arrays = [batch.column("doc_id"), counts, pa.array(map(shrink, ids), pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows, step, f"doc_id {kind}, n_tokens long, ids binary")


def id_counts(encoded: DataFrame) -> DataFrame:
    """How often each id occurs in the whole corpus: added up in each task, then over tasks."""

    def step(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            counts = np.bincount(np.concatenate([grow(x) for x in batch.column("ids").to_pylist()] or [[]]).astype(np.int64))
            if len(counts) > len(total):
                counts, total = total, counts
            total[: len(counts)] += counts
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["id", "n"])

    return arrow_map(encoded.select("ids"), step, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


FILE = "first_start long, doc_ids binary, doc_nulls binary, lengths binary, control binary, data binary"


def write_files(encoded: DataFrame, path: str, parts: int | None = None) -> None:
    """Write the file format to ``path``: ``files``, in ascending doc_id order (null first), and ``ranks``.

    A file is a sequence of blocks (rows without compression of their own): the first id's position in the
    whole corpus, the documents' numbers and lengths in ids, control bytes and data bytes. Ids stand as their
    rank by falling frequency (ties: smaller id first), so that the commonest take one byte; ``ranks`` lists
    the ids in that order. Documents are dealt by ranges of doc_id; only one block is in memory at a time, and
    the sizes of the ranges, not the data, meet in one place. Rows that repeat a doc_id follow each other,
    ordered by their ids' bytes.
    """
    spark = encoded.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))  # ranges follow the cluster
    ranked = id_counts(encoded).orderBy(F.desc("n"), "id").select("id")
    order = np.array([r["id"] for r in ranked.collect()], dtype=np.int64)  # at most the vocabulary
    spark.createDataFrame([(order.astype("<u4").tobytes(),)], "ids binary").coalesce(1).write.parquet(f"{path}/ranks")
    marks = encoded.select(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)] or [0.5], 10_000)).first()[0]
    cuts = sorted(set(marks or []))
    # the range of a row: how many cut points lie at or below it; null comes first
    part = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(_bucket(F.col("doc_id"), cuts))
    rows = encoded.withColumn("part", part)
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    starts = {r["part"]: r["s"] for r in sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("s")).collect()}
    held = spark.sparkContext.broadcast((order, starts))

    def step(batches):
        order, starts = held.value
        rank = np.zeros(int(order.max(initial=0)) + 1, np.int64)
        rank[order] = np.arange(len(order))
        at = now = None
        docs, nulls, lengths, ranks, size = [], [], [], [], 0
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("part", "doc_id", "ids"))
            for part, doc, ids in zip(*columns):
                if part != now or size >= BLOCK_IDS:
                    if docs:
                        yield _block(at, docs, nulls, lengths, ranks)
                        docs, nulls, lengths, ranks = [], [], [], []
                        at += size
                    if part != now:
                        now, at = part, starts[part]
                    size = 0
                values = rank[grow(ids)]
                docs.append(doc or 0)
                nulls.append(doc is None)
                lengths.append(len(values))
                ranks.append(values)
                size += len(values)
        if docs:
            yield _block(at, docs, nulls, lengths, ranks)

    dealt = rows.repartition(parts, "part").sortWithinPartitions("part", F.asc_nulls_first("doc_id"), "ids")
    arrow_map(dealt, step, FILE).write.option("compression", "none").parquet(f"{path}/files")


def _bucket(value, cuts: list[int]):
    """Number of cut points at or below ``value``."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.lit(cuts), lambda c: c <= value))


def _block(at, docs, nulls, lengths, ranks) -> pa.RecordBatch:
    control, data = pack_ids(np.concatenate(ranks))
    values = [np.array(docs, "<i8").tobytes(), np.packbits(nulls).tobytes(), np.array(lengths, "<u4").tobytes(), control, data]
    names = ["first_start", "doc_ids", "doc_nulls", "lengths", "control", "data"]
    return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), *[pa.array([v], pa.binary()) for v in values]], names=names)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of ``write_files``: doc_id, start, n_tokens, ids (binary, little-endian unsigned 32-bit)."""
    order = np.frombuffer(spark.read.parquet(f"{path}/ranks").first()["ids"], "<u4")  # at most the vocabulary
    held = spark.sparkContext.broadcast(order)

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                lengths = np.frombuffer(block["lengths"], "<u4").astype(np.int64)
                docs = np.frombuffer(block["doc_ids"], "<i8")
                empty = np.unpackbits(np.frombuffer(block["doc_nulls"], np.uint8), count=len(docs)).astype(bool)
                ids = held.value[unpack_ids(block["control"], block["data"], int(lengths.sum()))]
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4").tobytes()
                parts = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64(), mask=empty), pa.array(block["first_start"] + ends - lengths),
                     pa.array(lengths), pa.array(parts, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    blocks = spark.read.schema(FILE).parquet(f"{path}/files")
    return arrow_map(blocks, step, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write the ids of all documents and read them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    encoded = materialize(encode(docs, tokenizer_path, end_id), "ids")  # read for counts, ranges and files
    path = scratch_path(spark, "token-files")
    write_files(encoded, path)
    return read_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

