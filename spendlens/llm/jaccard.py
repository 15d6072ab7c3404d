"""Near duplicates: an exact Jaccard join in the metric space of word shingles, by pivots and recursive regions.

Distance is 1 - Jaccard. Pivots come in two kinds.

1. Shingles. A set {s} lies at 1 - 1/|x| from every document x that holds s, so the regions of these pivots are the
   documents by their rarest shingle; the boundary documents of a region are those that a document at distance
   1 - t could still meet there: each document goes to the regions of its first n - ceil(t n) + 1 shingles in one
   global order (frequent shingles last). Two linked documents meet in a region at least.
2. Documents. In each region the document with the smallest key is its pivot p; regions with the same pivot are one.
   All of a region's documents are compared with p only. A link x-y that does not follow from links through p
   must lie in the window |d(x,p) - d(y,p)| <= 1 - t. Members outside a region's largest linked part become its
   next pivots, so the region joins itself recursively until every pair is either compared, outside the window or
   linked through others. Dense groups of near copies therefore cost one comparison for each document and round.

Nothing caps a region: later pivots grow in number by a factor each round, until none is left.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.session import discard, materialize

from .batches import arrow_map, join_filter, keep, key_filter, release, slices, texts_of

WORDS = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Shingles ordered last, by their frequency: the most frequent ones. An order only; it drops nothing.
FREQUENT = 1 << 18
#: How many different sets of a batch of sets must hold a shingle for the batch to report it, and a batch's shingles.
OFTEN, BATCH = 2, 2_000_000
#: 64-bit parts of the coarse parity signature: bits flipped by each shingle, so that bits that differ bound the
#: difference of two sets. A set with more shingles than PARITY * 16 also has a fine one of four bits for each or more.
PARITY = 16
#: Central members of a region's largest linked part that all members outside it are compared with first.
CENTRAL = (8, 32)
#: Pivots of a region in the first recursive round, and their growth with each round.
PIVOTS, GROWTH = 4, 8
MEMO_ENTRIES = 200_000

FACTORS = np.array([xxhash.xxh3_64_intdigest(bytes([k]), 11) | 1 for k in range(WORDS)], np.uint64)


class Memo(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """The set of a text's shingles as sorted 64-bit hashes; a text of fewer words has one, of all its words."""
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


def set_key(value: np.ndarray) -> int:
    """64 bits that stand for a set; two different ones of N sets agree with odds of about N ** 2 / 2 ** 65."""
    return xxhash.xxh3_64_intdigest(value.tobytes())


def prefix_size(n: int) -> int:
    return n - math.ceil(n * PERCENT / 100) + 1 if n else 0


def parity(value: np.ndarray, parts: int) -> np.ndarray:
    bits = np.bincount((value & np.uint64(64 * parts - 1)).astype(np.int64), minlength=64 * parts) & 1
    return np.packbits(bits.astype(np.uint8)).view("<i8")


def fine_parts(n: int) -> int:
    return 1 << math.ceil(math.log2(n / 16))


def describe(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per document doc_id, n, the key of its set and a hash of its text; and shingles that many documents hold, with counts."""

    def step(batches):
        seen, held, size = set(), [], 0
        kind = None
        for batch in slices(batches, "text"):
            sets = [shingles(t) for t in texts_of(batch, "text")]
            keys = [set_key(s) for s in sets]
            kind = batch.column("doc_id").type
            yield rows_of(batch.column("doc_id"), [len(s) for s in sets], np.array(keys, np.uint64), batch.column("mark"), False)
            for key, value in zip(keys, sets):
                if key not in seen:  # copies in a batch count once
                    seen.add(key)
                    held.append(value)
                    size += len(value)
            if size > BATCH:
                yield often(held, kind)
                seen, held, size = set(), [], 0
        if size:
            yield often(held, kind)

    def often(sets, kind):
        value, counts = np.unique(np.concatenate(sets), return_counts=True)
        many = counts >= OFTEN
        size = int(many.sum())
        return rows_of(pa.nulls(size, kind), counts[many], value[many], pa.nulls(size, pa.int64()), True)

    def rows_of(ids, numbers, keys, marks, frequent):
        arrays = [ids, pa.array(numbers, pa.int64()), pa.array(keys.view(np.int64)), marks, pa.array([frequent] * len(keys), pa.bool_())]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "key", "mark", "frequent"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    marked = docs.withColumn("mark", F.xxhash64("text"))
    both = materialize(arrow_map(marked, step, f"doc_id {kind}, n long, key long, mark long, frequent boolean"), "sets")
    counted = both.where("frequent").groupBy("key").agg(F.sum("n").alias("n"))
    return both.where("not frequent").drop("frequent"), counted.orderBy(F.desc("n"), "key").limit(FREQUENT)


def prefixes(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """Per set (linkable documents only): key, n, rep (smallest doc_id), its regions' shingles and its signature.

    ``light`` holds the shingles outside the frequent ones, ``heavy`` the others, each in the global order.
    """
    table = frequent.toArrow()  # at most FREQUENT rows
    order = np.argsort(table.column("key").to_numpy().view(np.uint64))
    held = docs.sparkSession.sparkContext.broadcast(
        (table.column("key").to_numpy().view(np.uint64)[order], table.column("n").to_numpy()[order])
    )

    def step(batches):
        known, counts = held.value
        for batch in slices(batches, "text"):
            columns: list[list] = [[], [], [], [], [], []]
            rows = []
            for k, text in enumerate(texts_of(batch, "text")):
                value = shingles(text)
                if not len(value):
                    continue
                rows.append(k)
                size = prefix_size(len(value))
                at = np.minimum(np.searchsorted(known, value), max(0, len(known) - 1))
                hit = known[at] == value if len(known) else np.zeros(len(value), bool)
                light = value[~hit][:size]
                heavy = value[hit][np.lexsort((value[hit], counts[at[hit]]))][: size - len(light)] if hit.any() else value[:0]
                columns[0].append(set_key(value))
                columns[1].append(len(value))
                columns[2].append(light.view(np.int64))
                columns[3].append(heavy.view(np.int64))
                columns[4].append(parity(value, PARITY))
                columns[5].append(parity(value, fine_parts(len(value))) if len(value) > 16 * PARITY else None)
            arrays = [
                batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(np.array(columns[0], np.uint64).view(np.int64)),
                pa.array(columns[1], pa.int32()), *(pa.array(c, pa.list_(pa.int64())) for c in columns[2:]),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", "n", "light", "heavy", "coarse", "fine"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, key long, n int, light array<long>, heavy array<long>, coarse array<long>, fine array<long>"
    made = arrow_map(docs.where("doc_id is not null"), step, schema)
    return made.groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("light").alias("light"),
        F.first("heavy").alias("heavy"), F.first("coarse").alias("coarse"), F.first("fine").alias("fine"),
    )


def regions(sets: DataFrame) -> DataFrame:
    """Members of the document pivots' regions: pivot, key, busy; without the pivots themselves.

    A shingle's documents, in the order of their sizes, part wherever two neighbours' sizes allow no link: no pair across
    such a gap has sizes closer than theirs. ``busy`` members share a part with others than the pivot; a part of two is
    done when its pair has been compared.

    Regions of the frequent shingles, at most FREQUENT, get their pivots by an aggregation that shrinks in the map
    tasks and a broadcast of one row each; the others are small and get theirs in one shuffle.
    """
    light = sets.select("key", "n", F.explode("light").alias("s"))
    by_size = Window.partitionBy("s").orderBy("n")
    beside = light.withColumn("before", F.lag("n").over(by_size)).withColumn("after", F.lead("n").over(by_size))
    joins = F.col("before").isNotNull() & sizes_fit(F.col("before"), F.col("n"))
    joined_on = F.col("after").isNotNull() & sizes_fit(F.col("n"), F.col("after"))
    paired = beside.withColumn("joins", joins).where(F.col("joins") | joined_on)
    parted = paired.withColumn("part", F.sum(F.when(F.col("joins"), 0).otherwise(1)).over(by_size))
    by_part = Window.partitionBy("s", "part")
    few = parted.withColumn("pivot", F.min("key").over(by_part)).withColumn("busy", F.count("*").over(by_part) > 2)
    heavy = sets.select("key", F.explode("heavy").alias("s"))
    tops = heavy.groupBy("s").agg(F.min("key").alias("pivot"), (F.count("*") > 2).alias("busy"))
    many = heavy.join(F.broadcast(tops), "s")
    both = few.select("pivot", "key", "busy").unionAll(many.select("pivot", "key", "busy"))
    return both.where("pivot != key").groupBy("pivot", "key").agg(F.max("busy").alias("busy"))


def sizes_fit(n: Column, m: Column) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def differing(a: Column, b: Column, parts: int | None = None) -> Column:
    """How many bits of two signatures of equal length differ; with a known number of ``parts`` in generated code."""
    if parts:
        return reduce(add, [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(parts)])
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, v: t + v)


def difference_fits(n: Column, m: Column, a: Column, b: Column, parts: int | None = None) -> Column:
    """Whether few enough bits of two signatures of equal length differ.

    A link leaves at most (100 - P) / (100 + P) of both sizes outside the intersection, and each shingle outside it
    flips one bit.
    """
    return differing(a, b, parts) * (100 + PERCENT) <= (n + m) * (100 - PERCENT)


def folded(signature: Column, parts: Column) -> Column:
    """A signature of twice as many parts as ``parts``, or as many, brought to ``parts``."""
    halves = F.zip_with(F.slice(signature, F.lit(1), parts), F.slice(signature, parts + 1, parts), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(signature) > parts, halves).otherwise(signature)


def narrowed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b), those whose sizes and signatures allow a link: a, b, na, nb; stored. Rules out no link."""
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("coarse").alias("ca"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("coarse").alias("cb"))
    n, m = F.col("na"), F.col("nb")
    sized = pairs.join(left, "a").join(right, "b").where(sizes_fit(n, m))
    near = sized.where(difference_fits(n, m, F.col("ca"), F.col("cb"), PARITY)).select("a", "b", "na", "nb")
    coarse = materialize(near, "coarse")
    out = refined(coarse, sets)
    if out is not coarse:
        discard(coarse)
    return out


def refined(near: DataFrame, sets: DataFrame) -> DataFrame:
    """Of stored pairs whose coarse signatures allow a link, those whose fine ones do too; stored."""
    n, m = F.col("na"), F.col("nb")
    large = (n > 16 * PARITY) & (m > 16 * PARITY)
    if near.where(large).isEmpty():
        return near
    fine = only(sets.select("key", "fine").where("fine is not null"), near)
    left = fine.select(F.col("key").alias("a"), F.col("fine").alias("fa"))
    right = fine.select(F.col("key").alias("b"), F.col("fine").alias("fb"))
    both = near.where(large).join(left, "a").join(right, "b")
    parts = F.least(F.size("fa"), F.size("fb"))
    sure = both.where(difference_fits(n, m, folded(F.col("fa"), parts), folded(F.col("fb"), parts))).select(*near.columns)
    return materialize(near.where(~large).unionAll(sure), "near")


def only(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of ``table`` that the keys of ``pairs`` may need."""
    return join_filter(table, F.col("key"), key_filter(every_key(pairs), "key"))


def bags_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """key and whole shingle set of the sets in ``needed`` (key, rep)."""

    def step(batches):
        for batch in slices(batches, "text"):
            sets = [shingles(t) for t in texts_of(batch, "text")]
            keys = np.array([set_key(s) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["key", "bag"]
            )

    rows = join_filter(docs.where("doc_id is not null"), F.col("doc_id"), key_filter(needed, "rep"))
    made = arrow_map(rows.select("text"), step, "key long, bag array<long>")
    return made.join(needed.select("key"), "key", "left_semi").groupBy("key").agg(F.first("bag").alias("bag"))


def linked(near: DataFrame, bags: DataFrame) -> DataFrame:
    """Of possible pairs, each with the exact size of its intersection and whether it is a link."""
    bags = only(bags, near)
    first = bags.select(F.col("key").alias("a"), F.col("bag").alias("bag_a"))
    second = bags.select(F.col("key").alias("b"), F.col("bag").alias("bag_b"))
    both = near.join(first, "a").join(second, "b")
    common = F.size(F.array_intersect("bag_a", "bag_b"))
    return both.select("a", "b", "na", "nb", common.alias("common")).withColumn(
        "link", F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * PERCENT
    )


def components(edges: DataFrame) -> DataFrame:
    """key and root (smallest key) of every key in ``edges`` (a, b), by contraction.

    Each round a key takes its smallest neighbour as its parent, edges move to the parents and keys to their parents'
    parents; keys are hashes, so the number of edges falls by a factor each round. Only two tables are kept.
    """
    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        ends = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = ends.groupBy(F.col("a").alias("key")).agg(F.least(F.first("a"), F.min("b")).alias("parent"))
        parents = materialize(parents, "parents")
        old = roots
        if old is None:
            roots = materialize(parents.withColumnRenamed("parent", "root"), "roots")
        else:
            to = parents.select(F.col("key").alias("root"), "parent")
            roots = materialize(old.join(to, "root", "left").select("key", F.coalesce("parent", "root").alias("root")), "roots")
            discard(old)
        one = parents.select(F.col("key").alias("a"), F.col("parent").alias("pa"))
        two = parents.select(F.col("key").alias("b"), F.col("parent").alias("pb"))
        moved = edges.join(one, "a").join(two, "b").where("pa != pb")
        done = edges
        edges = materialize(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        discard(done, parents)
    if roots is None:
        return edges.select(F.col("a").alias("key"), F.col("b").alias("root"))
    return roots


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, the smallest doc_id reachable by links."""
    return near_rows(docs, doc_id, text).drop("mark", "root")


def spare_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and mark (``xxhash64`` of the text) of the rows that go so that one row of each class of links stays.

    The row of the smallest doc_id stays; where several rows of a class have that id, one of them by its mark. Rows
    without an id or without words all stay.
    """
    rows = near_rows(docs, doc_id, text).where("n_shingles > 0 and doc_id is not null")
    first = F.col("doc_id") == F.col("component_id")
    stays = rows.where(first).groupBy("root").agg(F.min("mark").alias("stays"), F.max("mark").alias("last")).where("stays != last")
    twice = rows.where(first).join(stays, "root").where("mark != stays")
    return rows.where(~first).select("doc_id", "mark").unionAll(twice.select("doc_id", "mark")).distinct()


def near_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``near_classes`` with the row's mark (a hash of its text) and the root of its class.

    Words are runs of anything but blanks, tabs and line ends, A-Z in lower case; a document's set holds its distinct
    shingles of five words, or all its words as one if it has fewer. Documents with equal sets are one node. Without
    words or text a document links with nothing. A document of a NULL id links with nothing and gets a NULL component.
    Rows that repeat a doc_id are documents of their own with their own sets. Empty tables give no rows.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked, frequent = describe(docs)
    sets = materialize(prefixes(docs, frequent), "prefixes")
    release(docs)
    members = materialize(regions(sets), "regions")
    release(docs)
    slim = sets.drop("light", "heavy")
    near = narrowed(members.select(F.col("pivot").alias("a"), F.col("key").alias("b")), slim)
    # distance to the pivot of a region; without a figure it is more than any link's
    bags = materialize(bags_of(docs, every_key(near).join(slim.select("key", "rep"), "key")), "bags")
    tested = materialize(linked(near, bags), "tested")
    release(docs)
    roots = components(tested.where("link").select("a", "b"))
    cells = members
    members = materialize(with_distances(cells, tested, slim), "members")
    discard(cells, tested, near)
    known = placed(members, roots)
    release(docs)
    size, held = PIVOTS, None
    probes = list(zip((0, *CENTRAL), CENTRAL))
    while (step := next_pairs(known, size, held, probes[0] if probes else None)) is not None:
        release(docs)
        pairs, held = step
        size *= 1 if probes else GROWTH
        probes = probes[1:]
        if pairs.isEmpty():
            discard(pairs)
            continue
        near = refined(pairs, slim)
        if near is not pairs and near.isEmpty():  # as in most rounds: no sets to read, nothing to compare
            discard(pairs, near)
            continue
        more = every_key(near).join(bags.select("key"), "key", "left_anti").join(slim.select("key", "rep"), "key")
        more = materialize(more, "more")
        if not more.isEmpty():
            bags = bags.unionAll(materialize(bags_of(docs, more), "bags"))
        found = materialize(linked(near, bags).where("link").select("a", "b"), "links")
        if not found.isEmpty():
            roots, old = joined(roots, found), known
            known = placed(members, roots)
            discard(old)
        discard(found, more, *([pairs] if near is pairs else [pairs, near]))
    discard(members, known, bags, *([held] if held is not None else []))
    return named(marked, slim, roots)


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (stored; its files go) after more links: components of the roots that the links join."""
    one = roots.select(F.col("key").alias("a"), F.col("root").alias("ra"))
    two = roots.select(F.col("key").alias("b"), F.col("root").alias("rb"))
    moved = links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    new = components(moved.where("a != b"))
    to = new.select(F.col("key").alias("root"), F.col("root").alias("higher"))
    old = roots.join(to, "root", "left").select("key", F.coalesce("higher", "root").alias("root"))
    out = materialize(old.unionAll(new.join(roots.select("key"), "key", "left_anti").select("key", "root")), "roots")
    discard(roots, new)
    return out


def every_key(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("key")).unionAll(pairs.select(F.col("b").alias("key"))).distinct()


def with_distances(members: DataFrame, tested: DataFrame, sets: DataFrame) -> DataFrame:
    """Regions of three documents or more (pairs are done) with each member's size and distance to the pivot.

    The distance lies from ``low`` to ``high``: both are it where it was worked out, else the signatures' differing
    bits bound it from below, and it is greater than a link's.
    """
    far = tested.select(
        F.col("a").alias("pivot"), F.col("b").alias("key"),
        (1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))).alias("far"),
    )
    members = members.where("busy").select("pivot", "key")
    own = members.select("pivot", F.col("pivot").alias("key"), F.lit(0.0).alias("far")).distinct()
    every = members.join(far, ["pivot", "key"], "left").unionAll(own)
    at = sets.select(F.col("key").alias("pivot"), F.col("n").alias("m"), F.col("coarse").alias("at"))
    sized = every.join(sets.select("key", "n", "coarse"), "key").join(at, "pivot")
    bits = differing(F.col("coarse"), F.col("at"), PARITY)
    # the difference holds as many shingles at least as bits differ, and as the sizes differ
    apart = F.greatest(bits, F.abs(F.col("n") - F.col("m")))
    least = 2 * apart / (F.col("n") + F.col("m") + apart)
    low = F.coalesce("far", F.greatest(least, F.lit(1 - PERCENT / 100)))
    return sized.select("pivot", "key", "n", "coarse", low.alias("low"), F.coalesce("far", F.lit(1.0)).alias("high"))


def placed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` with their roots and regions (root of the pivot); stored."""
    at = roots.select(F.col("key").alias("pivot"), F.col("root").alias("region"))
    return materialize(members.join(at, "pivot", "left").join(roots, "key", "left").select(
        F.coalesce("region", "pivot").alias("region"), "pivot", "key", "n", "coarse", "low", "high",
        F.coalesce("root", "key").alias("root"),
    ), "known")


def next_pairs(
    known: DataFrame, size: int, held: DataFrame | None, ranks: tuple[int, int] | None
) -> tuple[DataFrame, DataFrame | None] | None:
    """Pairs (a, b, na, nb) of each region's next ``size`` pivots with members in their window, and ``held`` with them
    added. Sizes and coarse signatures, which members carry, are tested in the same join, so that no pair comes out of
    it that they rule out.

    Regions whose pivots are linked have their next pivots in common, so that a group of near copies with several
    first pivots is not gone through again for each. Next pivots are members outside the largest linked part that have
    not been compared with all of their regions (``held``: first pivot and member). A pair whose ends are linked already needs no comparison. None when no pivot is left.

    With ``ranks`` the pivots are members of the largest part instead, those of these ranks by how near they are to
    the region's first pivots, and only members outside it are compared with them: near copies of one text mostly
    link with the copies closest to it, which leaves few members for the pivots of the later rounds.
    """
    nearness = F.sum(0.3 - F.least("high", F.lit(0.5))).alias("nearness")
    inside = known.groupBy("region", "key").agg(F.first("root").alias("root"), nearness)
    parts = inside.groupBy("region", "root").count()
    largest = parts.groupBy("region").agg(F.max_by("root", F.struct("count", "root")).alias("largest"), F.count("*").alias("parts"))
    open_ = largest.where("parts > 1").drop("parts")
    rest = known.join(open_, "region").where("root != largest and key != pivot")
    if held is not None:
        rest = rest.join(held, ["pivot", "key"], "left_anti")
    if ranks:
        inner = inside.join(open_, "region").where("root = largest")
        order = Window.partitionBy("region").orderBy(F.desc("nearness"), "key")
        ranked = inner.withColumn("k", F.row_number().over(order)).where(F.col("k") <= ranks[1]).where(F.col("k") > ranks[0])
    else:
        order = Window.partitionBy("region").orderBy("key")
        ranked = rest.select("region", "key").distinct().withColumn("k", F.row_number().over(order)).where(F.col("k") <= size)
    chosen = materialize(ranked.select("region", "key"), "chosen")
    if chosen.isEmpty():
        if ranks and ranks[0]:  # open regions may have no member of these ranks
            return chosen, held
        discard(chosen)  # no region is open: an open one has a nearest member and next pivots
        return None
    reach = 1 - PERCENT / 100 + 1e-9
    columns = ("key", "n", "root", "low", "high", "coarse")
    one = known.join(chosen, ["region", "key"], "left_semi").select("pivot", *[F.col(c).alias(f"{c}_a") for c in columns])
    two = known.select("pivot", *[F.col(c).alias(f"{c}_b") for c in columns])
    window = (F.col("low_a") - F.col("high_b") <= reach) & (F.col("low_b") - F.col("high_a") <= reach)
    n, m = F.col("n_a"), F.col("n_b")
    close = sizes_fit(n, m) & difference_fits(n, m, F.col("coarse_a"), F.col("coarse_b"), PARITY)
    met = one.join(two, "pivot").where((F.col("root_a") != F.col("root_b")) & window & close)
    ordered = F.col("key_a") < F.col("key_b")
    pairs = met.select(
        F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"),
        F.when(ordered, n).otherwise(m).alias("na"), F.when(ordered, m).otherwise(n).alias("nb"),
    ).distinct()
    if ranks:
        return materialize(pairs, "pairs"), held
    now = known.join(chosen, ["region", "key"], "left_semi").select("pivot", "key").distinct()
    return materialize(pairs, "pairs"), materialize(now if held is None else held.unionAll(now), "held")


def named(marked: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Classes by document: the smallest doc_id of all sets with the same root."""
    rooted = sets.select("key", "rep").join(roots, "key", "left").select("key", "rep", F.coalesce("root", "key").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = rooted.join(lowest, "root").select("key", "component_id", "root")
    own = F.col("n") == 0
    return marked.join(classes, "key", "left").select(
        "doc_id", "mark", "root", F.col("n").alias("n_shingles"),
        F.when(own | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
