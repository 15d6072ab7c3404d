"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the others by a heap over linked bytes."""

from __future__ import annotations

import base64
from collections.abc import Iterable
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import add_columns, arrow_map, fresh, keep, slices, texts_of, with_arrays

#: Pre-tokens whose ids a Python worker remembers; beyond that it starts anew.
MEMO_ENTRIES = 250_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each token, its bytes in base64 and its rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"rank file lacks the bytes {missing[:5]}: not byte-level")
    return ranks


class PerfectHash:
    """Minimal perfect hash from tokens to ranks: as many slots as tokens, one displacement for each bucket.

    Buckets of several tokens are placed first, largest first, by trying displacements; a bucket of one token
    names its slot directly. The slot's token is compared, so a token outside the vocabulary gets None.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.size = size = len(ranks)
        buckets: dict[int, list[tuple[bytes, int]]] = {}
        for token in ranks:
            value = xxhash.xxh3_128_intdigest(token)
            buckets.setdefault((value >> 64) % size, []).append((token, value & 0xFFFFFFFFFFFFFFFF))
        self.moves = [0] * size
        self.tokens: list[bytes] = [b""] * size
        self.ranks = [0] * size
        free = np.ones(size, bool)
        for bucket, members in sorted(buckets.items(), key=lambda x: -len(x[1])):
            if len(members) == 1:
                break
            move = 1
            while True:
                slots = [self._slot(low, move, size) for _, low in members]
                if len(set(slots)) == len(slots) and free[slots].all():
                    break
                move += 1
            self._fill(bucket, move, zip(slots, members), free, ranks)
        left = iter(np.flatnonzero(free).tolist())
        for bucket, members in buckets.items():
            if len(members) == 1:
                slot = next(left)
                self._fill(bucket, -slot - 1, [(slot, members[0])], free, ranks)

    @staticmethod
    def _slot(low: int, move: int, size: int) -> int:
        mixed = ((low ^ (move * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF
        return (mixed >> 20) % size

    def _fill(self, bucket: int, move: int, placed: Iterable, free: np.ndarray, ranks: dict[bytes, int]) -> None:
        self.moves[bucket] = move
        for slot, (token, _) in placed:
            free[slot], self.tokens[slot], self.ranks[slot] = False, token, ranks[token]

    def get(self, token: bytes) -> int | None:
        value = xxhash.xxh3_128_intdigest(token)
        move = self.moves[(value >> 64) % self.size]
        slot = -move - 1 if move < 0 else self._slot(value & 0xFFFFFFFFFFFFFFFF, move, self.size)
        return self.ranks[slot] if self.tokens[slot] == token else None


def merge_bytes(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token: of all neighbouring parts the pair of lowest rank joins first, the leftmost of equals.

    ``ends[i]`` is where the part that starts at i ends (0: no part starts there), ``before[i]`` where the
    part on its left starts. A heap entry whose two parts have changed since is skipped.
    """
    size = len(token)
    ends, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = [(rank, i, i + 2) for i in range(size - 1) if (rank := ranks.get(token[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, start, end = heappop(heap)
        middle = ends[start]
        if not middle or middle >= size or ends[middle] != end:
            continue
        ends[start], ends[middle] = end, 0
        if end < size:
            before[end] = start
            if (rank := ranks.get(token[start : ends[end]])) is not None:
                heappush(heap, (rank, start, ends[end]))
        left = before[start]
        if left >= 0 and (rank := ranks.get(token[left:end])) is not None:
            heappush(heap, (rank, left, end))
    out, at = [], 0
    while at < size:
        out.append(ranks[token[at : ends[at]]])
        at = ends[at]
    return out


class Memo(dict):
    """Ids of pre-tokens as little-endian 32-bit integers, worked out when first asked for."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.whole = ranks, PerfectHash(ranks)

    def __missing__(self, token: str) -> bytes:
        raw = token.encode()
        rank = self.whole.get(raw)
        ids = [rank] if rank is not None else merge_bytes(raw, self.ranks)
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        self[token] = out = np.array(ids, "<u4").tobytes()
        return out


def _memo(held) -> Memo:
    return Memo(held.value)


def encoder(held, pattern: str, text: str, out: str):
    """A step that appends the ids of the texts."""

    def step(batches):
        find, memo = regex.compile(pattern).findall, keep(_memo, held)
        for batch in slices(batches, text):
            ids = [b"".join(map(memo.__getitem__, find(value))) for value in texts_of(batch, text)]
            yield with_arrays(batch, {out: pa.array(ids, pa.binary())})

    return step


def decoder(held, ids: str, out: str):
    """A step that appends the bytes of the ids."""

    def step(batches):
        table = [b""] * (max(held.value.values()) + 1)
        for token, rank in held.value.items():
            table[rank] = token
        for batch in slices(batches, ids):
            raw = [
                None if v is None else b"".join(map(table.__getitem__, np.frombuffer(v, "<u4").tolist()))
                for v in batch.column(ids).to_pylist()
            ]
            yield with_arrays(batch, {out: pa.array(raw, pa.binary())})

    return step


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with each whole text's ids (binary, little-endian unsigned 32-bit), and that column's name.

    ``pattern`` splits a text into pre-tokens, each encoded by itself; no special tokens. Null counts as
    empty and has no ids. The vocabulary (a file on the driver) is broadcast; its size does not depend on data.
    """
    out = fresh(docs, "ids")
    held = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    return add_columns(docs, encoder(held, pattern, text, out), [T.StructField(out, T.BinaryType())]), out


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids") -> tuple[DataFrame, str]:
    """``encoded`` with the bytes that the ids stand for (binary), and that column's name. Null stays null."""
    out = fresh(encoded, "decoded")
    held = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    return add_columns(encoded, decoder(held, ids, out), [T.StructField(out, T.BinaryType())]), out


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256; every row and whole text of ``docs``."""
    docs = docs.select("doc_id", "text")
    held = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    encoding, decoding = encoder(held, pattern, "text", "ids"), decoder(held, "ids", "decoded")

    def both(batches):  # in one Python worker, which halves their number
        yield from decoding(batch.select(["doc_id", "ids"]) for batch in encoding(batches))

    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, T.BinaryType()) for n in ("ids", "decoded"))])
    return arrow_map(docs, both, schema).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
