"""Personal data: base patterns, and more spans by weak supervision of regex, gazetteer and context labellers.

DataFrame functions only. Candidates, votes, the expectation-maximisation's counts and the classifier's are all
expressions; only counts by votes and traits (bounded, whatever the data) reach the driver, where the rounds run on
them. The classifier sees traits of the span and its surroundings, not the votes, and learns from the votes' posteriors.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of the results; the base ones first, then those that only the method finds.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]

# Possessive quantifiers and the look at what lies before change no match: a run can only match from its start.
# \G (where the last match ended) keeps a match that starts right after another.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}

#: Looser patterns for candidates of the same kinds, and of secrets.
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++ ?(?:\[at\]|\(at\)) ?[a-z0-9-]++(?: ?(?:\.|\[dot\]|\(dot\)) ?[a-z0-9-]++)++",
    "ip": r"(?i)(?<![0-9a-f:])(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}(?![0-9a-f:])",
    "phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9.-])",
    "secret": r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/-]{16,}={0,2}(?![A-Za-z0-9_+/=-])",
}
#: What each kind's text must hold for its patterns to be worth a look: a plain search that few texts pass.
HINTS = {"email": "@|(?i:[\\[(]at[\\])])", "ip": "[0-9]\\.[0-9]|[0-9a-fA-F]:", "card": "[0-9][\\x20-]?[0-9]", "phone": "\\+[0-9]|[0-9]{3}", "secret": "[0-9]"}
#: Words near a candidate that speak for it (within CONTEXT characters before it).
NEAR = {
    "email": "mail|write|contact|address", "ip": "ip|host|server|addr", "phone": "call|phone|tel|mobile|fax|ring|contact",
    "secret": "key|token|secret|password|passwd|pwd|auth|credential|api",
}
#: Known beginnings and endings of each kind.
KNOWN = {
    "email": r"(?:com|org|net|edu|gov|io|info|example|invalid|test)$", "ip": "^(?:fe80|fd|fc|200[0-9])",
    "phone": r"^\(?[2-9][0-9]{2}", "secret": "^(?:AKIA|ASIA|ghp_|gho_|sk-|sk_|pk_|xox|AIza|eyJ|glpat)",
}
CONTEXT = 24
#: Numbers of an array that are added up directly.
BLOCK = 64
LABELLERS = 5
ROUNDS = 40
#: Levels of what the classifier sees of a candidate: its length, shares of digits, of capitals and of marks, the
#: character before it, the one after it, and whether a word and a mark lead up to it.
TRAITS = (4, 3, 3, 2, 3, 2, 2)
#: A candidate's chance above which the classifier's spans are given out.
ACCEPT = 0.5


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sums_before(values: Column, levels: int = 2) -> Column:
    """For each number of an array the sum of those before it: sums inside blocks, added to the blocks' own.

    Work grows with BLOCK times the length (and its square over BLOCK ** 4), not with its square.
    """
    inside = lambda block: F.transform(block, lambda _, i: F.aggregate(F.slice(block, F.lit(1), i), F.lit(0), lambda t, v: t + v))
    if not levels:
        return inside(values)

    def parted(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        blocks = F.transform(numbers, lambda k: F.slice(v, k * BLOCK + 1, F.lit(BLOCK)))

        def joined(held: Column) -> Column:
            totals = F.transform(held, lambda block: F.aggregate(block, F.lit(0), lambda t, x: t + x))
            moved = F.zip_with(held, sums_before(totals, levels - 1), lambda block, t: F.transform(inside(block), lambda x: x + t))
            return F.flatten(moved)

        return F.when(F.size(v) <= BLOCK, inside(v)).otherwise(let(blocks, joined))

    return let(values, parted)


def located(text: Column, pattern: str) -> Column:
    """All matches, leftmost first, as structs (start, end, match) in code points.

    Splitting by the pattern gives what lies between the matches; adding lengths up gives the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(found)), found,
        lambda g, m: F.struct(F.char_length(g).alias("gap"), F.char_length(m).alias("size"), m.alias("match")),
    )

    def placed(held: Column) -> Column:
        def span(pair: Column, before: Column) -> Column:
            start = before + pair["gap"]
            return F.struct(start.alias("start"), (start + pair["size"]).alias("end"), pair["match"].alias("match"))

        return F.zip_with(held, sums_before(F.transform(held, lambda p: p["gap"] + p["size"])), span)

    return let(pairs, placed)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a row of digits passes the Luhn check."""
    places = F.split(F.reverse(number), "")
    twice = F.transform(places, lambda d, k: F.when(k % 2 == 1, d.cast("int") * 2).otherwise(d.cast("int")))
    return F.aggregate(twice, F.lit(0), lambda total, v: total + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        number = digits(match)
        return F.when(F.length(number).between(16, 19), luhn(number)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(match)).between(8, 15)
    return F.lit(True)


NONE = "cast(array() as array<struct<start:int,end:int,match:string>>)"


def base_spans(text: Column, kind: str) -> Column:
    """The base spans of a kind; matches that fail its test are dropped, and not tried again elsewhere."""
    spans = F.filter(located(text, PATTERNS[kind]), lambda s: valid(kind, s["match"]))
    return F.when(text.rlike(HINTS[kind]), spans).otherwise(F.expr(NONE))


def with_base(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and an array column of base spans for each base kind."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("*", *[base_spans(F.col("text"), k).alias(k) for k in BASE])


def around(text: Column, span: Column) -> Column:
    """What stands right before (lower case) and after a candidate, taken from the text once."""
    lead, size = F.least(span["start"], F.lit(CONTEXT)), span["end"] - span["start"]
    return let(F.substring(text, span["start"] - lead + 1, lead + size + 1), lambda w: F.struct(
        F.lower(F.substring(w, F.lit(1), lead)).alias("before"), F.substring(w, lead + size + 1, F.lit(1)).alias("after")))


def traits(span: Column, near: Column) -> Column:
    """What the classifier sees of a candidate: one digit for each of TRAITS. No labeller's vote is among them."""
    match = span["match"]
    size = F.char_length(match)

    def share(pattern: str, levels: int) -> Column:
        return F.least(F.floor(F.length(F.regexp_replace(match, pattern, "")) * levels / size), F.lit(levels - 1)).cast("string")

    return F.concat(
        F.when(size < 12, "0").when(size < 20, "1").when(size < 32, "2").otherwise("3"),
        share("[^0-9]", 3), share("[^A-Z]", 3), share("[A-Za-z0-9]", 2),
        F.when(near["before"].rlike(r"(?:^|\s)$"), "0").when(near["before"].rlike(r"[=:\"'`(\[{<]$"), "1").otherwise("2"),
        F.when(near["after"].rlike(r"^(?:$|[\s.,;:!?)])"), "0").otherwise("1"),
        F.when(near["before"].rlike(r"[a-z]{2}[^a-z0-9\s]\s?$"), "1").otherwise("0"),
    )


def voted(kind: str, span: Column, before: Column) -> Column:
    """The labellers' votes on a candidate, as a string of LABELLERS characters."""
    match = span["match"]
    size = F.char_length(match)
    n_digits = F.length(digits(match))
    mixed = {
        "email": match.rlike(r"[a-z]{2,}$"), "ip": match.rlike("[a-fA-F]"), "phone": match.rlike(r"^\("),
        "secret": match.rlike("[0-9]") & match.rlike("[A-Za-z]"),
    }[kind]
    usual = {"email": size.between(8, 60), "ip": size.between(15, 39), "phone": size.between(12, 14), "secret": size.between(16, 64)}[kind]
    spread = {
        "email": ~match.rlike(r"\.\."), "ip": ~match.rlike("^(?:0+:){7}"), "phone": ~digits(match).rlike(r"^([0-9])\1+$"),
        "secret": (n_digits >= 3) & ~match.rlike("^[a-z]+-[a-z-]+$"),
    }[kind]
    one = lambda test, no="0": F.when(test, "1").otherwise(no)
    return F.concat(
        one(mixed), one(before.rlike(f"(?:{NEAR[kind]})[^a-z]{{0,8}}$"), "2"), one(match.rlike(KNOWN[kind]), "2"), one(usual), one(spread)
    )


def extra_spans(text: Column, kind: str, taken: list[Column]) -> Column:
    """Candidates of a kind with their votes, without those that overlap a base span."""
    spans = located(text, LOOSE[kind])
    clear = F.filter(
        spans,
        lambda s: reduce(
            lambda a, b: a & b,
            [~F.exists(t, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])) for t in taken],
        ),
    )
    made = F.transform(clear, lambda s: let(around(text, s), lambda near: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        voted(kind, s, near["before"]).alias("votes"), traits(s, near).alias("traits"),
    )))
    empty = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,votes:string,traits:string>>)")
    return F.when(text.rlike(HINTS[kind]), made).otherwise(empty)


def reliabilities(counts: dict[str, int]) -> tuple[list[list[list[float]]], dict[str, float]]:
    """EM for one kind over counted vote patterns: chance of each vote by class and labeller, and posteriors."""
    post = {p: (p.count("1") + 0.5) / (p.count("1") + p.count("0") + 1) for p in counts}
    chance = [[[1 / 3] * 3 for _ in range(2)] for _ in range(LABELLERS)]
    for _ in range(ROUNDS if counts else 0):
        share = [1.0, 1.0]
        for p, n in counts.items():
            share[0] += n * (1 - post[p])
            share[1] += n * post[p]
        for k in range(LABELLERS):
            for side in range(2):
                # prior: a labeller that says yes is rather right
                sums = [2.0, 1.0, 1.0] if side == 0 else [1.0, 2.0, 1.0]
                for p, n in counts.items():
                    sums[int(p[k])] += n * (post[p] if side else 1 - post[p])
                chance[k][side] = [s / sum(sums) for s in sums]
        for p in counts:
            logs = [math.log(share[side]) + sum(math.log(chance[k][side][int(p[k])]) for k in range(LABELLERS)) for side in range(2)]
            post[p] = 1 / (1 + math.exp(max(-50.0, min(50.0, logs[0] - logs[1]))))
    return chance, post


def train(cells: dict[tuple[str, str], int], post: dict[str, float], rounds: int = 60) -> list[list[float]]:
    """Logistic weights of each trait's levels, fitted to the posteriors of the candidates' votes by Newton's method.

    ``cells`` counts candidates by votes and traits. The last list is the bias.
    """
    seen = sorted({t for _, t in cells})
    at = {t: i for i, t in enumerate(seen)}
    total, right = np.zeros(len(seen)), np.zeros(len(seen))
    for (votes, t), n in cells.items():
        total[at[t]] += n
        right[at[t]] += n * post[votes]
    starts = np.cumsum([0, *TRAITS])
    rows = np.zeros((len(seen), starts[-1] + 1))
    rows[:, -1] = 1
    for i, t in enumerate(seen):
        rows[i, [start + int(c) for start, c in zip(starts, t)]] = 1
    weights = np.zeros(starts[-1] + 1)
    for _ in range(rounds if seen else 0):
        chance = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (right - total * chance) - weights
        bend = (rows * (total * chance * (1 - chance))[:, None]).T @ rows + np.eye(len(weights))
        weights += np.clip(np.linalg.solve(bend, slope), -2, 2)
    return [weights[a:b].tolist() for a, b in zip(starts, [*starts[1:], len(weights)])]


def classifier(found: DataFrame) -> dict[str, list[list[float]]]:
    """Fit the span classifier on all candidates of ``found`` (``with_extras``): weights for each kind.

    Candidates are counted by votes and traits, of which there are some 10 ** 5 at most, whatever the data.
    """
    cells = found.select(F.explode("extras").alias("c")).groupBy("c.kind", "c.votes", "c.traits").count().collect()
    models = {}
    for kind in LOOSE:
        own = {(r["votes"], r["traits"]): r["count"] for r in cells if r["kind"] == kind}
        counts: dict[str, int] = {}
        for (votes, _), n in own.items():
            counts[votes] = counts.get(votes, 0) + n
        models[kind] = train(own, reliabilities(counts)[1])
    return models


def with_extras(found: DataFrame) -> DataFrame:
    taken = [F.col(k) for k in BASE]
    return found.withColumn("extras", F.concat(*[extra_spans(F.col("text"), k, taken) for k in LOOSE]))


def accepted(seen: Column, weights: list[list[float]]) -> Column:
    score = F.lit(weights[-1][0])
    for k, levels in enumerate(weights[:-1]):
        score = score + F.get(F.array(*map(F.lit, levels)), F.substring(seen, k + 1, 1).cast("int"))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score)) > ACCEPT


def find(docs: DataFrame) -> DataFrame:
    """Personal data in every whole text: doc_id, one array of base spans for each base kind, and ``extras``.

    Null counts as empty. Places are code points, end exclusive. Base spans are leftmost and do not overlap within a
    kind; ``extras`` are the loose candidates clear of them that the trained span classifier accepts. The first run
    counts votes over all documents, the second applies the classifier; nothing is shuffled but the counts.
    """
    found = with_extras(with_base(docs))
    models = classifier(found)
    fits = F.filter("extras", lambda c: reduce(
        lambda a, b: a | b, [(c["kind"] == kind) & accepted(c["traits"], weights) for kind, weights in models.items()]
    ))
    return found.withColumn("extras", fits).drop("text")


def of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def places(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_extra."""
    rows = find(docs)

    def line(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    base = F.concat(*[line(k, F.col(k)) for k in BASE])
    every = []
    for kind in KINDS:
        spans = places(of_kind("extras", kind))
        every.append(line(kind, F.array_sort(F.concat(places(F.col(kind)), spans) if kind in BASE else spans)))
    return rows.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(F.concat(*every), ",").alias("spans"),
        F.size("extras").cast("long").alias("n_extra"),
    )
