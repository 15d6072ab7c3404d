"""Vector codes by product quantisation: Lloyd's rounds over two trees, one of the parts and one of the entries.

Vectors become whole numbers and are cut into equal parts; each part position has a codebook of a few entries. Blocks of
vectors are stored once, each with a tree over the parts of every position: nodes with their box and the sum of their
parts. A round sends the codebooks (a fixed number of entries) to all tasks, walks both trees at once and returns sums
and counts by entry. For a node of parts and a node of entries the least difference of two squared distances over both
boxes is worked out exactly; where it is above 0 no entry of that node can be the nearest of any part. A node of parts
that is left with one entry goes to it as a whole by its cached sum; leaves that keep several are compared part by part
in whole numbers. No step rounds, so the result does not depend on blocks or trees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.session import materialize

from .batches import arrow_map

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a block, and parts of a tree's leaf at most.
BLOCK, LEAF = 8192, 16
#: Components have less than so much after scaling, so that sums of squares fit 64 bits.
LIMIT = 1 << 28


def scaled(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite numbers, as 64-bit integers."""
    out = np.floor(values.astype(np.float64) * SCALE)
    if out.size and (out.min() <= -LIMIT or out.max() >= LIMIT):
        raise ValueError(f"components must be smaller than {LIMIT // SCALE}")
    return out.astype(np.int64)


def edges_of(size: int) -> list[np.ndarray]:
    """Borders of the nodes of each level over ``size`` sorted parts: halves of halves, down to leaves."""
    levels = [np.array([0, size])]
    while size > LEAF << (len(levels) - 1):
        count = 1 << len(levels)
        levels.append(np.arange(count + 1) * size // count)
    return levels


def part_tree(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A balanced tree over the rows of ``parts``: their order, and boxes and sums of all nodes, level by level.

    Each node is halved at the median of its widest component.
    """
    order = np.arange(len(parts))
    low, high, sums = [], [], []
    for edges in edges_of(len(parts)):
        if low:  # sort within the nodes of the level above
            above = edges_of(len(parts))[len(low) - 1]
            node = np.repeat(np.arange(len(above) - 1), np.diff(above))
            widest = (high[-1] - low[-1]).argmax(1)
            order = order[np.lexsort((parts[order, widest[node]], node))]
        at = parts[order]
        low.append(np.minimum.reduceat(at, edges[:-1]))
        high.append(np.maximum.reduceat(at, edges[:-1]))
        sums.append(np.add.reduceat(at, edges[:-1]))
    return order, np.concatenate(low), np.concatenate(high), np.concatenate(sums)


def entry_tree(entries: np.ndarray) -> list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Nodes of each level over a codebook: (indexes, lowest, highest); the last level holds single entries."""
    levels = [[np.arange(len(entries))]]
    while any(len(n) > 1 for n in levels[-1]):
        halves = []
        for node in levels[-1]:
            held = entries[node]
            order = node[np.lexsort((node, held[:, np.ptp(held, axis=0).argmax()]))] if held.shape[1] else node
            halves += [h for h in (order[: (len(node) + 1) // 2], order[(len(node) + 1) // 2 :]) if len(h)]
        levels.append(halves)
    return [[(n, entries[n].min(0), entries[n].max(0)) for n in level] for level in levels]


def surplus(low: np.ndarray, high: np.ndarray, below: np.ndarray, above: np.ndarray, rival: np.ndarray) -> np.ndarray:
    """Least |x - c|^2 - |x - rival|^2 for x in the box (low, high) and c in the box (below, above).

    It is a sum over components, each of them least at one end of x's range for any c.
    """
    ends = []
    for x in (low, high):
        gap = np.maximum(np.maximum(below - x, x - above), 0)
        ends.append(gap * gap - (x - rival) ** 2)
    return np.minimum(*ends).sum(-1)


def walk(size: int, low: np.ndarray, high: np.ndarray, entries: np.ndarray):
    """Both trees from the root: (whole, loose).

    ``whole`` lists (level, nodes, entry of each) whose parts all have that entry as their nearest; ``loose`` (leaves,
    entry of each) the pairs that are left undecided, sorted by leaf.
    """
    part_levels, tree = edges_of(size), entry_tree(entries)
    whole, offset = [], 0
    nodes, groups = np.zeros(1, int), np.zeros(1, int)
    for level, edges in enumerate(part_levels):
        depth = min(level + 1, len(tree) - 1)
        if depth > min(level, len(tree) - 1):
            above, here = tree[depth - 1], tree[depth]
            child = [[k for k, n in enumerate(here) if n[0][0] in a[0]] for a in above]
            counts = np.array([len(c) for c in child])
            nodes = np.repeat(nodes, counts[groups])
            groups = np.concatenate([child[g] for g in groups]).astype(int)
        below, over = (np.stack([n[i] for n in tree[depth]]) for i in (1, 2))
        lo, hi = low[offset + nodes], high[offset + nodes]
        # the rival of a node is the entry group whose middle is nearest to the node's own, by its first entry
        away = ((lo + hi - below[groups] - over[groups]) ** 2).sum(1)
        order = np.lexsort((away, nodes))
        first = order[np.flatnonzero(np.diff(nodes[order], prepend=-1))]
        names = np.array([n[0][0] for n in tree[depth]])
        rival = np.zeros(len(edges) - 1, int)
        rival[nodes[first]] = names[groups[first]]
        keep = surplus(lo, hi, below[groups], over[groups], entries[rival[nodes]]) <= 0
        nodes, groups = nodes[keep], groups[keep]
        if depth == len(tree) - 1:
            counts = np.bincount(nodes, minlength=len(edges) - 1)
            sure = counts[nodes] == 1
            if sure.any():
                whole.append((level, nodes[sure], names[groups[sure]]))
            nodes, groups = nodes[~sure], groups[~sure]
        if level == len(part_levels) - 1:
            break
        offset += len(edges) - 1
        nodes, groups = np.concatenate([2 * nodes, 2 * nodes + 1]), np.tile(groups, 2)
    # a shallow tree of parts may end before the entries' tree does: what is left are groups, told apart here
    left = tree[min(len(part_levels), len(tree) - 1)]
    sizes = np.array([len(n[0]) for n in left])
    leaves = np.repeat(nodes, sizes[groups])
    named = np.concatenate([left[g][0] for g in groups]) if len(groups) else np.zeros(0, int)
    order = np.lexsort((named, leaves))
    return whole, (leaves[order], named[order])


def nearest(parts: np.ndarray, edges: np.ndarray, leaves: np.ndarray, named: np.ndarray, entries: np.ndarray):
    """For the parts of undecided leaves: their places and nearest entries, ties to the lower index."""
    if not len(leaves):
        return np.zeros(0, int), np.zeros(0, int)
    used, counts = np.unique(leaves, return_counts=True)
    sizes = np.diff(edges)[used]
    place = np.concatenate([np.arange(edges[n], edges[n + 1]) for n in used])
    options = np.full((len(used), counts.max()), -1)
    options[np.repeat(np.arange(len(used)), counts), np.concatenate([np.arange(c) for c in counts])] = named
    mine = np.repeat(options, sizes, axis=0)
    best, chosen = np.full(len(place), np.iinfo(np.int64).max), np.zeros(len(place), int)
    for k in range(mine.shape[1]):  # entries in ascending order, so the first of equal ones stays
        distance = ((parts[place] - entries[mine[:, k]]) ** 2).sum(1)
        closer = (mine[:, k] >= 0) & (distance < best)
        best, chosen = np.where(closer, distance, best), np.where(closer, mine[:, k], chosen)
    return place, chosen


class Block:
    """Vectors as whole numbers with a tree for each part position."""

    def __init__(self, values: np.ndarray, trees: list[tuple[np.ndarray, ...]]):
        self.values, self.trees = values, trees
        self.width = values.shape[1] // PARTS

    @classmethod
    def build(cls, values: np.ndarray) -> Block:
        width = values.shape[1] // PARTS
        return cls(values, [part_tree(values[:, p * width : (p + 1) * width]) for p in range(PARTS)])

    def parts(self, p: int) -> np.ndarray:
        return self.values[self.trees[p][0], p * self.width : (p + 1) * self.width]

    def sums(self, p: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum and number of the parts at ``p`` nearest to each entry."""
        _, low, high, cached = self.trees[p]
        total, count = np.zeros_like(entries), np.zeros(len(entries), np.int64)
        levels = edges_of(len(self.values))
        offsets = np.cumsum([0, *[len(e) - 1 for e in levels]])
        whole, (leaves, named) = walk(len(self.values), low, high, entries)
        for level, nodes, to in whole:
            np.add.at(total, to, cached[offsets[level] + nodes])
            np.add.at(count, to, np.diff(levels[level])[nodes])
        parts = self.parts(p)
        place, chosen = nearest(parts, levels[-1], leaves, named, entries)
        np.add.at(total, chosen, parts[place])
        return total, count + np.bincount(chosen, minlength=len(entries))

    def codes(self, p: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each vector's part at ``p`` and its squared distance, in the vectors' order."""
        order, low, high, _ = self.trees[p]
        levels = edges_of(len(self.values))
        chosen = np.zeros(len(order), int)
        whole, (leaves, named) = walk(len(self.values), low, high, entries)
        for level, nodes, to in whole:
            for node, entry in zip(nodes, to):
                chosen[levels[level][node] : levels[level][node + 1]] = entry
        parts = self.parts(p)
        place, found = nearest(parts, levels[-1], leaves, named, entries)
        chosen[place] = found
        code, error = np.empty_like(chosen), np.empty(len(order), np.int64)
        code[order], error[order] = chosen, ((parts - entries[chosen]) ** 2).sum(1)
        return code, error


def finite(vector: Column) -> Column:
    number = vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(number, F.lit(False))


def blocks_of(kept: DataFrame, width: int) -> DataFrame:
    """The rows of ``kept`` (vec_id, vector, label) in blocks with their trees; the columns ``FIELDS`` of numbers."""
    fields = [
        T.StructField("ids", T.ArrayType(kept.schema["vec_id"].dataType)),
        T.StructField("labels", T.ArrayType(kept.schema["label"].dataType)),
        *[T.StructField(n, T.BinaryType()) for n in ("numbers", "orders", "lows", "highs", "sums")],
    ]

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches).combine_chunks()
        vectors = rows.column("vector").combine_chunks()
        if set(np.diff(vectors.offsets.to_numpy())) != {width}:
            raise ValueError(f"all vectors must have {width} components")
        held = Block.build(scaled(vectors.flatten().to_numpy(zero_copy_only=False)).reshape(len(rows), width))
        trees = [np.concatenate([t[k].ravel() for t in held.trees]) for k in range(4)]
        raw = [held.values.astype("<i4"), trees[0].astype("<i4"), trees[1].astype("<i4"), trees[2].astype("<i4"), trees[3].astype("<i8")]
        lists = [pa.ListArray.from_arrays([0, len(rows)], rows.column(c).combine_chunks()) for c in ("vec_id", "label")]
        arrays = [*lists, *(pa.array([r.tobytes()], pa.binary()) for r in raw)]
        return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(start, BLOCK)
                if size + piece.num_rows > BLOCK:
                    yield block(held)
                    held, size = [], 0
                held.append(piece)
                size += piece.num_rows
        if size:
            yield block(held)

    return arrow_map(kept, step, T.StructType(fields))


def read_blocks(batch: pa.RecordBatch, width: int) -> Iterator[Block]:
    columns = [batch.column(n).to_pylist() for n in ("numbers", "orders", "lows", "highs", "sums")]
    for numbers, orders, *boxes in zip(*columns):
        values = np.frombuffer(numbers, "<i4").astype(np.int64).reshape(-1, width)
        order = np.frombuffer(orders, "<i4").astype(np.int64).reshape(PARTS, -1)
        low, high = (np.frombuffer(b, "<i4").astype(np.int64).reshape(PARTS, -1, width // PARTS) for b in boxes[:2])
        sums = np.frombuffer(boxes[2], "<i8").reshape(PARTS, -1, width // PARTS)
        yield Block(values, list(zip(order, low, high, sums)))


def lloyd_round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: the floor of each entry's mean part; an entry without parts stays."""
    parts, entries, wide = books.shape
    held = blocks.sparkSession.sparkContext.broadcast(books)  # PARTS x ENTRIES entries, whatever the data

    def step(batches):
        total, count = np.zeros_like(books), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for block in read_blocks(batch, parts * wide):
                for p in range(parts):
                    s, n = block.sums(p, held.value[p])
                    total[p] += s
                    count[p] += n
        place, entry = np.nonzero(count)
        columns = [pa.array(place, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[place, entry])]
        lists = pa.array(list(total[place, entry]), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*columns, lists], names=["part", "entry", "n", "sums"])

    found = arrow_map(blocks, step, "part int, entry int, n long, sums array<long>")
    # sums of a component may pass 64 bits over very many rows
    sums = [F.sum(F.get("sums", F.lit(k)).cast("decimal(28,0)")).alias(f"s{k}") for k in range(wide)]
    out = books.copy()
    for row in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():  # PARTS x ENTRIES rows
        out[row["part"], row["entry"]] = [int(row[f"s{k}"]) // row["n"] for k in range(wide)]
    held.unpersist()
    return out


def encoded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, codes (bytes, one of each part) and error (sum of squared distances) of every vector."""
    parts, _, wide = books.shape
    kind = {n: blocks.schema[n].dataType.elementType for n in ("ids", "labels")}
    held = blocks.sparkSession.sparkContext.broadcast(books)

    def step(batches):
        for batch in batches:
            for k, block in enumerate(read_blocks(batch, parts * wide)):
                found = [block.codes(p, held.value[p]) for p in range(parts)]
                codes = np.stack([f[0] for f in found], 1).astype(np.uint8)
                error = sum(f[1] for f in found)
                ids, labels = (batch.column(n).slice(k, 1).flatten() for n in ("ids", "labels"))
                raw = pa.array([c.tobytes() for c in codes], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, labels, raw, pa.array(error)], names=["vec_id", "label", "codes", "error"])

    fields = [
        T.StructField("vec_id", kind["ids"]), T.StructField("label", kind["labels"]),
        T.StructField("codes", T.BinaryType()), T.StructField("error", T.LongType()),
    ]
    return arrow_map(blocks, step, T.StructType(fields))


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """Codes and errors of all whole vectors, as ``encoded`` gives them and stored, and the codebooks.

    A row is dropped if its vector is null or has a null or non-finite component. A codebook starts as its part of the
    ENTRIES smallest vec_ids (null last, equal ones by their vectors; fewer rows make fewer entries). Rows that repeat
    a vec_id are vectors of their own. All vectors must have one length above 0 that PARTS divides, and components
    below LIMIT / SCALE; anything else is an error. Without rows there are no codes and empty codebooks.
    """
    kept = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label")).where(finite(F.col("vector")))
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).collect()
    if not first:
        schema = T.StructType([*(kept.schema[c] for c in ("vec_id", "label")), T.StructField("codes", T.BinaryType()), T.StructField("error", T.LongType())])
        return kept.sparkSession.createDataFrame([], schema), np.zeros((PARTS, 0, 0), np.int64)
    width = len(first[0]["vector"])
    if not width or width % PARTS or any(len(r["vector"]) != width for r in first):
        raise ValueError(f"all vectors must have the same number of components, a multiple of {PARTS}")
    books = scaled(np.array([r["vector"] for r in first], np.float64).reshape(len(first), PARTS, -1)).transpose(1, 0, 2)
    books = np.ascontiguousarray(books)
    blocks = materialize(blocks_of(kept, width), "blocks")
    for _ in range(ROUNDS):
        books = lloyd_round(blocks, books)
    return materialize(encoded(blocks, books), "codes"), books


def report(vectors: DataFrame, **names) -> DataFrame:
    """Per whole vector: vec_id, code, error, label_error, codebooks_sha256 (rules in ``compress``).

    ``label_error`` is the sum of the errors of all vectors of the same label, those of a NULL label together.
    """
    codes, books = compress(vectors, **names)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    by_label = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"),
    )
