"""Quality and toxicity from weak labels: expectation-maximisation over labellers, then a hashed linear scorer."""

from __future__ import annotations

import re
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.session import materialize

from .batches import add_columns, arrow_map, fresh, keep, release, slices, texts_of, with_arrays

#: Labelled documents that lexicons and scorers are fitted on: those with the smallest hash of their id.
SAMPLE = 12_000
#: Documents of the sample that must hold a feature before it gets a weight or enters a lexicon.
SUPPORT = 5
#: Share of toxic documents among those that hold a lexicon entry.
PRECISION = 0.9
#: Entries of a lexicon: the best supported.
LEXICON = 5_000
#: Standard deviations that a feature's documents must be off the mean for the feature to get a weight.
DEVIATION = 5
BITS = 18
#: Words whose weights a Python worker remembers; beyond that it starts anew.
MEMO_ENTRIES = 150_000
ABSTAIN = 2
#: Documents that the prior on the given label's accuracy is worth.
TRUST = 100

#: Everything in ASCII but letters and digits parts words.
PARTS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: White space beyond ASCII, ASCII white space, and marks that make no word.
WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
BLANK = bytes(32 if chr(c).isspace() else c for c in range(128)) + bytes(range(128, 256))
MARKS = b".,;:!?\"'()|*#$%&-"
#: ASCII marks that running text holds few of.
ODD = bytes(b for b in b"#$%&*+<=>@[\\]^_`{|}~/")
#: Shares that describe a text's shape, and above which share a labeller calls the text poor.
SHAPE = {"upper": 0.2, "odd": 0.04, "shout": 0.05, "repeat": 0.15, "alike": 0.75, "marks": 0.1}


def shape_of(text: str, words: list[str]) -> list[float]:
    """Shares of a text in units of their limits, 4 at most: upper-case words, odd marks, exclamation marks, words
    equal to the one before, words that occurred before, words that are no more than marks."""
    n = max(1, len(words))
    raw = text.encode()
    # a word that is left when all marks are deleted holds something else
    spaced = raw if text.isascii() else WIDE_SPACE.sub(" ", text).encode()
    solid = len(spaced.translate(BLANK, MARKS).split())
    shares = [
        sum(map(str.isupper, words)) / n, 1 - len(raw.translate(None, ODD)) / max(1, len(raw)), text.count("!") / n,
        sum(map(eq, words, words[1:])) / n, max(0, len(words) - 20) / n * (1 - len(set(words)) / n),
        1 - solid / n,
    ]
    return [min(4.0, share / limit) for share, limit in zip(shares, SHAPE.values())]


def features_of(word: str) -> list[str]:
    """A word, and its first five and four letters, which inflected forms share."""
    return ["w" + word, "p" + word[:5], "q" + word[:4]] if len(word) >= 4 else ["w" + word]


def place(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature.encode()) & ((1 << BITS) - 1)


def words_of(text: str) -> set[str]:
    return set(text.lower().encode().translate(PARTS).decode().split())


def em(patterns: np.ndarray, counts: np.ndarray, gold: int, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Two-class latent model of vote patterns: (outcome probabilities [labeller, class, outcome], posteriors).

    ``patterns`` [pattern, labeller] holds 0, 1 or ABSTAIN. An abstention is an outcome like any other. The given label
    (labeller ``gold``) is one of the labellers: its accuracy is estimated like theirs, from a prior worth ``TRUST``
    documents whatever their number. The start is the mean of the label and of whether any other labeller says 1.
    """
    size = patterns.shape[1]
    hits = np.where((np.delete(patterns, gold, axis=1) == 1).any(axis=1), 0.9, 0.05)
    post = np.where(patterns[:, gold] == ABSTAIN, hits, (hits + patterns[:, gold]) / 2)
    onehot = patterns[:, :, None] == np.arange(3)
    prior = np.ones((size, 2, 3)) * 0.01
    prior[gold, [0, 1], [0, 1]] += TRUST
    chance = prior
    for _ in range(rounds):
        weights = np.stack([counts * (1 - post), counts * post])
        chance = np.einsum("cp,pko->kco", weights, onehot) + prior
        chance /= chance.sum(axis=2, keepdims=True)
        share = weights.sum(axis=1) + 1
        logs = np.log(share / share.sum()) + np.einsum("pko,kco->pc", onehot, np.log(chance))
        post = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
    return chance, post


def votes_of(text: str, gold: tuple[int, int] | None, lexicons: tuple[frozenset[str], ...]) -> tuple[list[int], list[int]]:
    """The labellers' votes (poor quality, toxic); the last of each list is the given label."""
    shape = shape_of(text, text.split())
    poor = [1 if s > 1 else ABSTAIN for s in shape]
    poor.append(ABSTAIN if any(v == 1 for v in poor) else 0)  # nothing odd at all
    words = words_of(text)
    longer = [w for w in words if len(w) >= 4]
    parts = (words, {w[:5] for w in longer}, {w[:4] for w in longer})
    toxic = [0 if own.isdisjoint(lexicon) else 1 for own, lexicon in zip(parts, lexicons)]
    given = gold or (ABSTAIN, ABSTAIN)
    return [*poor, given[0]], [*toxic, given[1]]


def telling(made: DataFrame, name: str) -> np.ndarray:
    """Places held by enough documents of the sample whose mean ``name`` is far from the mean of all."""
    mean = made.agg(F.avg(name)).first()[0] or 0.0
    held = made.select(F.explode(F.array_distinct("places")).alias("place"), F.col(name).alias("target"))
    stats = held.groupBy("place").agg(F.count("*").alias("n"), F.sum("target").alias("sum"))
    off = F.abs(F.col("sum") - F.col("n") * mean) >= DEVIATION * F.sqrt(F.col("n") * max(mean * (1 - mean), 1e-9))
    rows = stats.where((F.col("n") >= SUPPORT) & off).select("place").toArrow()  # at most 2 ** BITS
    return np.sort(rows.column("place").to_numpy())


def fit_linear(rows: list[np.ndarray], dense: np.ndarray, target: np.ndarray, use: np.ndarray, epochs: int = 30) -> np.ndarray:
    """Logistic regression on hashed counts and dense shares by AdaGrad in fixed batches; weights [places + shares + 1].

    Only the places ``use`` get a weight: many words that tell nothing would add up in a long text.
    """
    dims, extra = 1 << BITS, dense.shape[1]
    number = np.full(dims, -1)
    number[use] = np.arange(len(use))
    kept = [number[r][number[r] >= 0] for r in rows]
    size = len(use)
    weights, seen = np.zeros(size + extra + 1), np.full(size + extra + 1, 1e-2)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for chunk in np.array_split(order.permutation(len(rows)), max(1, len(rows) // 64)):
            if not len(chunk):
                continue
            at = np.concatenate([kept[i] for i in chunk])
            owner = np.repeat(np.arange(len(chunk)), [len(kept[i]) for i in chunk])
            total = np.bincount(owner, weights=weights[at], minlength=len(chunk))
            score = total + dense[chunk] @ weights[size:-1] + weights[-1]
            gap = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target[chunk]) / len(chunk)
            grad = np.concatenate([np.bincount(at, weights=gap[owner], minlength=size), gap @ dense[chunk], [gap.sum()]])
            grad += 1e-6 * weights
            seen += grad**2
            weights -= 0.3 * grad / np.sqrt(seen)
    out = np.zeros(dims + extra + 1)
    out[use], out[dims:] = weights[:size], weights[size:]
    return out


def sample_of(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """doc_id, text, poor, toxic of at most ``size`` labelled documents."""
    given = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg(
        (1 - F.min("quality")).alias("poor"), F.max("toxic").alias("toxic")
    )
    chosen = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, quality, toxic): a model of a size that data do not change.

    1. Lexicons of words, and of word beginnings, that toxic documents of the sample hold and others do not.
    2. Labellers vote on every document: six shapes, absence of any, three lexicons, and the given label where the
       sample has it. Votes are counted by pattern over all documents (at most 3 ** labellers patterns).
    3. EM over the counted patterns gives each labeller's accuracy and each pattern's posterior.
    4. The posteriors of the sample train a hashed linear scorer for poor quality and one for toxicity.
    Repeated labels of a document: the worse counts. Without labels the shapes alone decide, and nothing is toxic.
    """
    spark = docs.sparkSession
    rows = sample_of(docs, labels, sample)
    held = rows.select("doc_id", "poor", "toxic").dropDuplicates(["doc_id"]).collect()  # at most ``sample``
    gold = spark.sparkContext.broadcast({r["doc_id"]: (r["poor"], r["toxic"]) for r in held})

    def hold(batches):
        for batch in slices(batches, "text"):
            for text, toxic in zip(texts_of(batch, "text"), batch.column("toxic").to_pylist()):
                names = sorted({f for w in words_of(text) for f in features_of(w)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array([toxic] * len(names), pa.int32())], names=["feature", "toxic"]
                )

    lift = arrow_map(rows.select("text", "toxic"), hold, "feature string, toxic int").groupBy("feature").agg(
        F.count("*").alias("n"), F.avg("toxic").alias("share")
    )
    best = lift.where((F.col("n") >= SUPPORT) & (F.col("share") >= PRECISION)).orderBy(F.desc("n"), "feature").limit(LEXICON)
    entries = [r["feature"] for r in best.collect()]
    lexicons = tuple(frozenset(e[1:] for e in entries if e[0] == kind) for kind in "wpq")
    lists = spark.sparkContext.broadcast(lexicons)

    def vote(batches):
        for batch in slices(batches, "text"):
            given = map(gold.value.get, batch.column("doc_id").to_pylist())
            both = [votes_of(t, g, lists.value) for t, g in zip(texts_of(batch, "text"), given)]
            names = ["".join(map(str, p)) + "/" + "".join(map(str, x)) for p, x in both]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["pattern"])

    counted = arrow_map(docs.select("doc_id", "text"), vote, "pattern string").groupBy("pattern").count().collect()
    model = {"lexicons": lexicons, "accuracy": {}, "weights": {}}
    posts = []
    for side, name in enumerate(("poor", "toxic")):
        split = [r["pattern"].split("/")[side] for r in counted]
        own = sorted(set(split))
        if not own:
            posts.append({})
            continue
        totals = np.zeros(len(own))
        np.add.at(totals, [own.index(p) for p in split], [r["count"] for r in counted])
        chance, post = em(np.array([[int(c) for c in p] for p in own]), totals, len(own[0]) - 1)
        model["accuracy"][name] = chance
        posts.append(dict(zip(own, post.tolist())))
    after = spark.sparkContext.broadcast(posts)

    def describe(batches):
        for batch in slices(batches, "text", 1 << 20):
            out: list[list] = [[], [], [], []]
            for text, poor, toxic in zip(texts_of(batch, "text"), *(batch.column(n).to_pylist() for n in ("poor", "toxic"))):
                votes = votes_of(text, (poor, toxic), lists.value)
                for side, column in zip((0, 1), out):
                    column.append(after.value[side].get("".join(map(str, votes[side])), 0.0))
                out[2].append(sorted(place(f) for w in words_of(text) for f in features_of(w)))
                out[3].append(shape_of(text, text.split()))
            kinds = [pa.float64(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds))],
                names=["doc_id", "poor", "toxic", "places", "shape"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    made = arrow_map(rows, describe, f"doc_id {kind}, poor double, toxic double, places array<int>, shape array<double>")
    made = materialize(made, "sample")
    use = {name: telling(made, name) for name in ("poor", "toxic")}
    any_use = spark.sparkContext.broadcast(np.isin(np.arange(1 << BITS), np.concatenate([*use.values()])))

    def slim(batches):
        for batch in batches:
            column = batch.column("places")
            values = column.flatten().to_numpy()
            fit = any_use.value[values]
            ends = np.cumsum([0, *column.value_lengths().to_pylist()])
            offsets = np.concatenate([[0], np.cumsum(fit)])[ends].astype(np.int32)
            kept = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[fit], pa.int32()))
            at = batch.schema.get_field_index("places")
            yield batch.set_column(at, "places", kept)

    table = arrow_map(made, slim, made.schema).toArrow()  # at most ``sample`` rows
    table = table.sort_by("doc_id")  # so that the fit can be repeated
    places = [np.asarray(p.values, np.int64) for p in table.column("places")]
    dense = np.array(table.column("shape").to_pylist(), float).reshape(-1, len(SHAPE))
    for name in ("poor", "toxic"):
        side = dense if name == "poor" else np.zeros_like(dense)  # shape tells nothing of toxicity
        model["weights"][name] = fit_linear(places, side, table.column(name).to_numpy(), use[name]).astype(np.float32)
    for held_there in (gold, lists, after, any_use):
        held_there.unpersist()
    release(docs)
    return model


class Scorer(dict):
    """Summed weights (poor, toxic) of words, worked out when first asked for."""

    def __init__(self, model: dict):
        super().__init__()
        pairs = np.stack([model["weights"]["poor"], model["weights"]["toxic"]], axis=1).astype(float)
        self.tail = pairs[1 << BITS :]
        used = np.flatnonzero(pairs[: 1 << BITS].any(axis=1))  # most places have no weight
        self.weights = dict(zip(used.tolist(), (pairs[used, 0] + 1j * pairs[used, 1]).tolist()))

    def __missing__(self, word: str) -> complex:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        weight = self.weights.get
        self[word] = out = sum([weight(place(f), 0j) for f in features_of(word)], 0j)
        return out

    def __call__(self, text: str) -> tuple[float, float]:
        both = sum(map(self.__getitem__, words_of(text)), complex(*self.tail[-1]))
        shape = np.array(shape_of(text, text.split())) @ self.tail[:-1]
        logits = np.clip([both.real + shape[0], both.imag + shape[1]], -30, 30)
        return tuple(1 / (1 + np.exp(-logits)))


def _scorer(held) -> Scorer:
    return Scorer(held.value)


def score(docs: DataFrame, model: dict, text: str = "text") -> tuple[DataFrame, tuple[str, str]]:
    """``docs`` with the chance of poor quality and of toxicity of each whole text, and these columns' names.

    Null counts as empty, which is scored like any other text.
    """
    names = fresh(docs, "p_poor"), fresh(docs, "p_toxic")
    held = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches):
        scorer = keep(_scorer, held)
        for batch in slices(batches, text):
            both = np.array([scorer(t) for t in texts_of(batch, text)], float).reshape(-1, 2)
            yield with_arrays(batch, {n: pa.array(both[:, k]) for k, n in enumerate(names)})

    return add_columns(docs, step, [T.StructField(n, T.DoubleType()) for n in names]), names


def keep_good(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """``docs`` without those more likely than ``limit`` to be of poor quality or toxic; all columns stay."""
    scored, (poor, toxic) = score(docs, fit(docs.select("doc_id", "text"), labels))
    return scored.where((F.col(poor) <= limit) & (F.col(toxic) <= limit)).select(*[f"`{c}`" for c in docs.columns])


def assess(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """Per document: doc_id, p_poor, p_toxic, kept."""
    docs = docs.select("doc_id", "text")
    scored, (poor, toxic) = score(docs, fit(docs, labels))
    return scored.select("doc_id", poor, toxic, ((F.col(poor) <= limit) & (F.col(toxic) <= limit)).alias("kept"))
