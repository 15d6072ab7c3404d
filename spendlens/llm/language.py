"""Language identification by rank-order profiles of letter n-grams."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import arrow_map, slices

#: n-grams in a profile, of a language and of a document.
PROFILE = 400
#: Lengths of n-grams; a word's edges count as one character each.
ORDERS = (1, 2, 3)
#: Learning sample: so many documents of each language, the smallest by a hash of their id.
SAMPLE = 3_000
#: The answer for a text without a letter.
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts in lower case as one row of code points, each followed by a 0, and the row's document numbers."""
    low = pc.utf8_lower(pc.fill_null(column, ""))
    sizes = pc.utf8_length(low).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.frombuffer("\0".join([*low.to_pylist(), ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    return flat, np.repeat(np.arange(len(sizes)), sizes + 1)


def grams(symbols: np.ndarray, docs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """n-grams (packed symbols, lengths marked above them) and their documents; symbol 0 parts words."""
    edge = symbols == 0
    keep = ~edge
    keep[1:] |= ~edge[:-1]  # one edge after each word
    symbols, docs = symbols[keep].astype(np.int64), docs[keep]
    symbols, docs = np.concatenate([[0], symbols]), np.concatenate([docs[:1], docs])
    codes, owners = [], []
    for n in ORDERS:
        if len(symbols) < n:
            continue
        code = np.full(len(symbols) - n + 1, n, np.int64)
        fit = np.ones(len(code), bool)
        for k in range(n):
            part = symbols[k : len(symbols) - n + 1 + k]
            code = (code << bits) | part
            if 0 < k < n - 1:
                fit &= part != 0  # an edge stands only at an end
        if n == 1:
            fit &= symbols[: len(code)] != 0
        codes.append(code[fit])
        owners.append(docs[n - 1 :][fit])  # the last symbol's document: an edge before a word may be another's
    return np.concatenate(codes), np.concatenate(owners)


def spell(code: int, bits: int) -> str:
    """The n-gram of a code made of code points; a blank for an edge."""
    n = (int(code).bit_length() - 1) // bits
    while int(code) >> (bits * n) != n:
        n += 1
    return "".join(chr(c) if c else " " for c in ((int(code) >> (bits * (n - 1 - k))) & ((1 << bits) - 1) for k in range(n)))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """Profiles: lang, gram, rank (0 is the commonest), the ``PROFILE`` commonest n-grams of each language.

    Learns from at most ``sample`` documents of each non-null language, those with the smallest hash of their
    key; their whole texts count. Ties in frequency go by n-gram.
    """
    known = docs.where(F.col(lang).isNotNull()).select(F.col(key).alias(key), F.col(lang).alias("lang")).distinct()
    first = [F.xxhash64(key), key]
    deal = F.pmod(F.xxhash64(key, F.lit("deal")), F.lit(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    # a language may hold a third of all rows: its slices first, then what is left of them
    few = known.withColumn("k", F.row_number().over(Window.partitionBy("lang", deal).orderBy(*first))).where(F.col("k") <= sample)
    order = Window.partitionBy("lang").orderBy(*first)
    chosen = few.withColumn("k", F.row_number().over(order)).where(F.col("k") <= sample).select(key, "lang")
    rows = docs.select(key, F.col(text).alias("text")).join(F.broadcast(chosen), key).select("lang", "text")

    def step(batches):
        for batch in slices(batches, "text"):
            flat, owner = code_points(batch.column("text"))
            table = letters()
            names = np.array(batch.column("lang").to_pylist(), object)
            for name in sorted(set(names.tolist())):
                mine = (names == name)[owner]
                codes, _ = grams(np.where(table[flat[mine]], flat[mine], 0), owner[mine], 20)
                got, counts = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(got), pa.string()), pa.array(got), pa.array(counts)], names=["lang", "code", "n"]
                )

    counts = arrow_map(rows, step, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    return counts.withColumn("rank", F.row_number().over(best) - 1).where(F.col("rank") < PROFILE)


class Profiles:
    """Profiles as arrays: symbols of all letters in use, n-grams in order, ranks of each language."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({lang for lang, _, _ in rows})
        spelled = [(lang, spell(code, 20), rank) for lang, code, rank in rows]
        known = sorted({ord(c) for _, gram, _ in spelled for c in gram if c != " "})
        self.symbols = np.zeros(sys.maxunicode + 1, np.uint16)
        self.symbols[letters()] = 1  # a letter of no profile
        self.symbols[known] = np.arange(2, len(known) + 2)
        self.bits = int(len(known) + 2).bit_length()
        packed = {gram: self._pack(gram) for _, gram, _ in spelled}
        self.codes = np.array(sorted({*packed.values()}), np.int64)
        #: out-of-place distance of an n-gram that a language lacks
        self.ranks = np.full((len(self.langs), len(self.codes)), -1, np.int64)
        for lang, gram, rank in spelled:
            self.ranks[self.langs.index(lang), np.searchsorted(self.codes, packed[gram])] = rank

    def _pack(self, gram: str) -> int:
        code = len(gram)
        for c in gram:
            code = (code << self.bits) | (0 if c == " " else int(self.symbols[ord(c)]))
        return code

    def distances(self, flat: np.ndarray, owner: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Out-of-place distance of each document to each language, and the n-grams of each document's profile."""
        out, sizes = np.zeros((count, len(self.langs)), np.int64), np.zeros(count, np.int64)
        codes, docs = grams(self.symbols[flat], owner, self.bits)
        if not len(codes) or not self.langs:
            return out, sizes
        width = int(codes.max()).bit_length()
        keys, counts = np.unique((docs << width) | codes, return_counts=True)
        docs, codes = keys >> width, keys & ((1 << width) - 1)
        order = np.argsort((docs << 32) | ((1 << 31) - counts), kind="stable")  # ties stay in the order of codes
        docs, codes = docs[order], codes[order]
        first = np.searchsorted(docs, np.arange(count))
        place = np.arange(len(docs)) - first[docs]
        top = place < PROFILE
        docs, codes, place = docs[top], codes[top], place[top]
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        known = self.codes[at] == codes
        sizes = np.bincount(docs, minlength=count)
        for k in range(len(self.langs)):
            rank = np.where(known, self.ranks[k, at], -1)
            gap = np.where(rank < 0, PROFILE, np.abs(rank - place))
            out[:, k] = np.bincount(docs, weights=gap, minlength=count)
        return out, sizes


@lru_cache(maxsize=1)
def _profiles(held) -> Profiles:
    return Profiles(held.value)


def predict(docs: DataFrame, profiles: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every whole text.

    A document's n-grams are ranked by frequency (ties by n-gram); the language whose profile is least out of
    place wins, the first by name of equals. The score is the share of the greatest possible distance that the
    winner saves, from 0 to 1. ``und`` with score 0 if the text is null or has no letter, or nothing was
    learned. The profiles (``PROFILE`` rows for each language) come to the driver and are broadcast.
    """
    rows = [(r["lang"], r["code"], r["rank"]) for r in profiles.select("lang", "code", "rank").collect()]
    held = docs.sparkSession.sparkContext.broadcast(rows)

    def step(batches):
        model = _profiles(held)
        names = np.array([*model.langs, UNKNOWN], object)
        for batch in slices(batches, "text", 3 << 20):
            flat, owner = code_points(batch.column("text"))
            far, sizes = model.distances(flat, owner, batch.num_rows)
            best = np.where(sizes > 0, far.argmin(axis=1) if model.langs else -1, -1)
            least = far.min(axis=1, initial=1 << 40) if model.langs else sizes
            score = np.where(best >= 0, 1 - least / np.maximum(1, sizes * PROFILE), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[best].tolist(), pa.string()), pa.array(np.clip(score, 0, 1))],
                names=["doc_id", "lang_pred", "score"],
            )

    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs, step, f"doc_id {kind}, lang_pred string, score double")


def held_out(key: str):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows that are not held out, predicted for all.

    A null doc_id is not held out, and is not learned from either.
    """
    fold = F.coalesce(held_out("doc_id"), F.lit(False))
    profiles = learn(docs.where(~held_out("doc_id")))
    return predict(docs, profiles).select("doc_id", fold.alias("held_out"), "lang_pred", "score")
