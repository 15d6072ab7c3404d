"""Passages of benchmark items in documents, found with a generalised suffix automaton over words."""

from __future__ import annotations


from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import add_columns, arrow_map, fresh, slices, texts_of, with_arrays

#: Words of a window: what an item and a document must share.
WINDOW = 13
#: A document is contaminated when at least 1 of so many words is hit.
COVERAGE = 20
#: Words of benchmark text that one automaton holds; a larger benchmark is taken in blocks.
BLOCK_WORDS = 1_000_000

#: Bytes to words: A-Z become lower case, other ASCII but digits and letters become blanks.
WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


class ItemAutomaton:
    """Suffix automaton of all items' words, with the items of each window at its states.

    An item with fewer words than the window is a window of its own. Repeated items and items that are part
    of others are fine. Items without words are left out.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window, self.ids = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.ids.setdefault(w, len(self.ids) + 1) for w in words]) for name, words in items if words]
        pairs = set()
        for _, words in coded:
            last = 0
            for word in words:
                last = self._extend(last, word)
            pairs.update(zip(words, words[1:]))
        self.least = min((min(len(w), window) for _, w in coded), default=0)
        self.pairs = np.array(sorted((a << 32) | b for a, b in pairs), dtype=np.int64)
        found: dict[int, set[tuple[int, str | None]]] = {}
        for name, words in coded:
            size, state = min(len(words), window), 0
            for k, word in enumerate(words):
                state = self.next[state][word]  # the prefix's own path
                if k + 1 >= size:
                    found.setdefault(self._holder(state, size), set()).add((size, name))
        self.found = found
        self.chains: dict[int, list[tuple[int, str | None]]] = {}

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            old = nxt[last][word]
            return old if length[old] == length[last] + 1 else self._split(last, word, old)
        new = self._state(length[last] + 1, {})
        while last >= 0 and word not in nxt[last]:
            nxt[last][word] = new
            last = link[last]
        if last < 0:
            link[new] = 0
        else:
            old = nxt[last][word]
            link[new] = old if length[old] == length[last] + 1 else self._split(last, word, old)
        return new

    def _state(self, length: int, nxt: dict[int, int]) -> int:
        self.next.append(nxt)
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, last: int, word: int, old: int) -> int:
        copy = self._state(self.length[last] + 1, dict(self.next[old]))
        self.link[copy], self.link[old] = self.link[old], copy
        while last >= 0 and self.next[last].get(word) == old:
            self.next[last][word] = copy
            last = self.link[last]
        return copy

    def _holder(self, state: int, size: int) -> int:
        """The state that holds the last ``size`` words of ``state``."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _windows(self, state: int) -> list[tuple[int, str | None]]:
        """Windows that end where ``state`` ends: its own and those of its suffixes."""
        if state not in self.chains:
            chain, at = set(), state
            while at > 0:
                chain |= self.found.get(at, set())
                at = self.link[at]
            self.chains[state] = sorted(chain, key=lambda x: (x[0], str(x[1])))
        return self.chains[state]

    def match(self, words: list[int]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Spans (start, end) of windows in a run of word numbers, merged, and the items they are from."""
        spans: list[tuple[int, int]] = []
        items: set[str | None] = set()
        state = size = 0
        nxt, link, length = self.next, self.link, self.length
        for k, word in enumerate(words):
            while state and word not in nxt[state]:
                state = link[state]
                size = length[state]
            if word in nxt[state]:
                state = nxt[state][word]
                size += 1
            if size < self.least:
                continue
            longest = 0
            for n, name in self._windows(state):
                if n <= size:
                    items.add(name)
                    longest = n
            if longest:
                start = k + 1 - longest
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, k + 1))
        return spans, items

    def runs(self, numbers: np.ndarray) -> list[tuple[int, int]]:
        """Stretches whose neighbouring words are neighbours in some item; no window leaves its stretch."""
        if not self.least or not len(numbers):
            return []
        follows = np.zeros(len(numbers) - 1, bool)
        both = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0))
        if len(self.pairs):
            pairs = (numbers[both] << 32) | numbers[both + 1]
            follows[both] = self.pairs[np.searchsorted(self.pairs[:-1], pairs)] == pairs
        starts = np.flatnonzero(~np.concatenate([[False], follows]))
        ends = np.append(starts[1:], len(numbers))
        fit = (ends - starts >= self.least) & (numbers[starts] > 0)
        return list(zip(starts[fit].tolist(), ends[fit].tolist()))


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> list[list[tuple[str, list[bytes]]]]:
    """The benchmark in blocks of about ``block_words`` words, each small enough for one automaton.

    Items with equal ids are one item's parts. Only the size is counted first; each block comes by itself.
    """
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (6 * block_words)))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(blocks).cast("long"))
    for k in range(blocks):
        rows = items.where(part == k).select("item", "text").distinct().collect()  # one block: bounded by block_words
        yield [(r["item"], words_of(r["text"])) for r in rows]


def find_spans(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, tuple[str, str, str]]:
    """``docs`` with the number of words, the hit spans of words and the items hit, and these columns' names.

    Words are runs of digits, letters and non-ASCII characters, A-Z in lower case; null has none. A span is
    (start, end) in words, end exclusive; spans do not overlap. Items of a NULL id hit words but are not
    listed. An empty benchmark hits nothing. Each document streams through the automaton in its map task.
    """
    names = tuple(fresh(docs, n) for n in ("n_words", "hit_spans", "hit_items"))
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    kinds = [T.LongType(), span, T.ArrayType(T.StringType())]
    fields = [T.StructField(n, k) for n, k in zip(names, kinds)]
    out, first = docs, True
    spark = docs.sparkSession
    for items in item_blocks(benchmark, item_id, item_text, block_words):
        held = spark.sparkContext.broadcast(items)
        step = _matcher(held, text, names, window, first)
        out = add_columns(out, step, fields) if first else arrow_map(out, step, out.schema)
        first = False
    return out, names


def _matcher(held, text: str, names: tuple[str, str, str], window: int, first: bool):
    def step(batches):
        automaton = ItemAutomaton(held.value, window)
        number = automaton.ids.get
        for batch in slices(batches, text):
            before = None if first else [batch.column(n).to_pylist() for n in names[1:]]
            counts, spans, items = [], [], []
            coded = []
            for value in texts_of(batch, text):
                words = words_of(value)
                counts.append(len(words))
                coded.append(np.fromiter(map(number, words, repeat(0)), np.int64, len(words)))
            flat = np.concatenate([x for c in coded for x in (c, np.zeros(1, np.int64))])
            offsets = np.cumsum([0, *[n + 1 for n in counts]])
            spans = [[] for _ in counts]
            items = [set() for _ in counts]
            for a, b in automaton.runs(flat):
                doc = int(np.searchsorted(offsets, a, side="right")) - 1
                got, names_hit = automaton.match(flat[a:b].tolist())
                if got:
                    move = a - int(offsets[doc])
                    spans[doc] += [(s + move, e + move) for s, e in got]
                    items[doc] |= names_hit
            if before:
                spans = [merged([*x, *((r["start"], r["end"]) for r in y)]) for x, y in zip(spans, before[0])]
                items = [x | set(y) for x, y in zip(items, before[1])]
            rows = [[{"start": s, "end": e} for s, e in x] for x in spans]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            new = {
                names[0]: pa.array(counts, pa.int64()), names[1]: pa.array(rows, kind),
                names[2]: pa.array([sorted(i for i in x if i is not None) for x in items], pa.list_(pa.string())),
            }
            if not first:
                batch = batch.drop_columns(list(names))
            yield with_arrays(batch, new)

    return step


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def hit_words(spans: str):
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])


def contaminated(words: str, spans: str, coverage: int = COVERAGE):
    hits = hit_words(spans)
    return (hits > 0) & (hits * coverage >= F.col(words))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", coverage: int = COVERAGE, **names) -> DataFrame:
    """``docs`` without those whose hit words reach 1 in ``coverage``; the others stay as they are."""
    found, (words, spans, _) = find_spans(docs, benchmark, text, **names)
    return found.where(~contaminated(words, spans, coverage)).select(*[f"`{c}`" for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", least: int = WINDOW, **names) -> DataFrame:
    """``docs`` whose texts lose every hit span of at least ``least`` words; the rest of a text is untouched."""
    found, (_, spans, _) = find_spans(docs, benchmark, text, **names)
    columns = docs.columns

    def step(batches):
        for batch in slices(batches, text):
            texts = batch.column(text).to_pylist()
            for k, row in enumerate(batch.column(spans).to_pylist()):
                cut = [(s["start"], s["end"]) for s in row if s["end"] - s["start"] >= least]
                if cut:
                    texts[k] = without_words(texts[k], cut)
            arrays = [pa.array(texts, batch.column(text).type) if c == text else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return arrow_map(found, step, docs.schema)


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    raw = text.encode()
    plain = np.frombuffer(raw.translate(WORD_BYTES), np.uint8) != 32
    edges = np.diff(np.concatenate([[0], plain.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    out, at = [], 0
    for s, e in spans:
        out.append(raw[at : starts[s]])
        at = int(ends[e - 1])
    return b"".join([*out, raw[at:]]).decode()


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (rules in ``find_spans``)."""
    found, (words, spans, items) = find_spans(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    return found.select(
        "doc_id", F.col(words).alias("n_words"), hit_words(spans).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        contaminated(words, spans).alias("contaminated"),
    )


