"""Exact order statistics without a single-task window.

Quantiles and bands read the few positions they need. A sketch of each group's values brackets each position, one more
pass counts exactly what lies below, on and inside the brackets, and the values inside are read when they are few;
else they are bracketed again, which leaves a fiftieth of them each time. So no group is gathered in one task, nothing
is sorted as a whole, and small and large tables take the same way.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.numbers import INFINITY
from ..session import discard, materialize

ROW_BITS = 33  # monotonically_increasing_id keeps the index inside the partition in the low 33 bits
READ = 20_000  # values inside a bracket that are read together
ACCURACY = 2000  # size of a sketch; its ranks are right to about a quarter of a per cent of the rows
STEPS = 100  # equal steps of rank at which a sketch is asked for its values
MARGIN = 1  # steps beyond the two around a wanted rank that its bracket takes in


def with_positions(df: DataFrame, order: list) -> DataFrame:
    """Adds ``__pos``, the 0-based position under ``order``.

    End ``order`` in a unique key: ties then spread over partitions too. The sorted rows are written
    to scratch first, as partition bounds come from a sample and must not be drawn twice.
    """
    numbered = materialize(df.orderBy(*order).withColumn("__row", F.monotonically_increasing_id()), "sorted")
    part = F.shiftrightunsigned("__row", ROW_BITS)
    sizes = numbered.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    # One row per sort partition, a number set by the session and not by the data.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    local = F.col("__row").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        numbered.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")
        .withColumn("__pos", F.col("__start") + local)
        .drop("__part", "__row", "__start")
    )


def melt_metrics(df: DataFrame, metrics: list[str], keep: list[str] = ()) -> DataFrame:
    """Wide metrics to ``metric, value`` rows; NULL and non-finite values are dropped."""
    cast = df.select(*keep, *[F.col(m).cast("double").alias(m) for m in metrics])
    return cast.unpivot(list(keep), metrics, "metric", "value").where(F.abs("value") < F.lit(INFINITY))


Wanted = list[tuple[str, str, Column]]  # label, its bracket, 0-based position in terms of ``n``


def select_ranks(long: DataFrame, by: list[str], wanted: Wanted, key: str | None = None) -> DataFrame:
    """``by..., n`` and, per label, the exact value at the wanted 0-based position of the group; stored.

    ``long`` holds ``by..., value`` without NULLs. Labels that share a bracket are neighbours. With ``key``, positions
    go by value and then key, and ``label_key`` is the key at the position, or NULL where the value is an end of its
    bracket, which many rows may share.
    """
    whole = isinstance(long.schema["value"].dataType, T.IntegralType)
    sketch, quantile = (
        (F.kll_sketch_agg_bigint, F.kll_sketch_get_quantile_bigint) if whole
        else (F.kll_sketch_agg_double, F.kll_sketch_get_quantile_double)
    )
    value = F.col("value").cast("bigint" if whole else "double")
    lowest, highest = (F.lit(x).cast("bigint" if whole else "double") for x in ((-(2**63), 2**63 - 1) if whole else (-INFINITY, INFINITY)))
    long = long.select(*by, value.alias("value"), *([key] if key else []))
    brackets = list(dict.fromkeys(name for _, name, _ in wanted))
    places = {name: [p for _, other, p in wanted if other == name] for name in brackets}
    ranks = F.array(*[F.lit(k / STEPS) for k in range(STEPS + 1)])
    grid = lambda column: sketch(column, ACCURACY)
    around = lambda share: {
        "lo": F.greatest(F.floor(share * STEPS) - MARGIN, F.lit(0)), "hi": F.least(F.ceil(share * STEPS) + MARGIN, F.lit(STEPS))}
    shared = lambda place, size: place / F.greatest(size - 1, F.lit(1))
    ends = [F.col(f"{b}_{end}") for b in brackets for end in ("lo", "hi")]
    first = long.groupBy(*by).agg(F.count("value").alias("n"), grid("value").alias("sketch"))
    first = first.select(*by, "n", quantile("sketch", ranks).alias("grid"))
    state = materialize(first.select(*by, "n", *[
        F.get("grid", step.cast("int")).alias(f"{b}_{end}") for b in brackets for end, step in around(shared(places[b][0], F.col("n"))).items()
    ]), "brackets")
    share = 2 * (MARGIN + 2) / STEPS  # of its rows that a bracket leaves, with room for the sketch's error
    most = share * (state.agg(F.max("n")).first()[0] or 0)
    while True:
        reading = most <= READ
        parts = []
        for b in brackets:
            low, high = F.col(f"{b}_lo"), F.col(f"{b}_hi")
            inside = F.when((F.col("value") > low) & (F.col("value") < high), F.struct("value", key) if key else F.col("value"))
            inner = F.when((F.col("value") > low) & (F.col("value") < high), F.col("value"))
            held = F.collect_list(inside) if reading else grid(inner)
            parts += [
                F.count_if(F.col("value") < low).alias(f"{b}_below"), F.count_if(F.col("value") == low).alias(f"{b}_at"),
                F.count(inner).alias(f"{b}_within"),
                F.count_if((F.col("value") == high) & (high > low)).alias(f"{b}_end"),
                held.alias(f"{b}_held"),
            ]
        counts = materialize(long.join(state, by).groupBy(*by, "n", *ends).agg(*parts), "counts")
        rest = {b: [p - F.col(f"{b}_below") - F.col(f"{b}_at") for p in places[b]] for b in brackets}
        found = {
            b: reduce(and_, [(F.col(f"{b}_below") <= p) & (r < F.col(f"{b}_within") + F.col(f"{b}_end")) for p, r in zip(places[b], rest[b])])
            for b in brackets
        }
        if reading and counts.where(~reduce(and_, found.values())).isEmpty():
            break
        # brackets that missed their position start again from all values; large ones are narrowed
        moved, left = [], [F.lit(0.0)]
        for b in brackets:
            size, large = F.col(f"{b}_within"), F.lit(not reading) & (F.col(f"{b}_within") > READ)
            steps = around(shared(F.greatest(F.lit(0), F.least(rest[b][0], size - 1)), size))
            stays = {"lo": F.least(rest[b][0], *rest[b]) < 0, "hi": F.greatest(rest[b][0], *rest[b]) >= size}
            for end, edge in (("lo", lowest), ("hi", highest)):
                close = F.col(f"{b}_{end}")
                if not reading:
                    close = F.when(large & ~stays[end], F.get(quantile(f"{b}_held", ranks), steps[end].cast("int"))).otherwise(close)
                moved.append(F.when(found[b], close).otherwise(edge).alias(f"{b}_{end}"))
            left.append(F.when(~found[b], F.col("n")).when(large, share * size).otherwise(0.0))
        most = counts.agg(F.max(F.greatest(*left))).first()[0] or 0
        new = materialize(counts.select(*by, "n", *moved), "brackets")
        discard(state, counts)
        state = new
    picked = []
    for label, b, position in wanted:
        at = position - F.col(f"{b}_below") - F.col(f"{b}_at")
        row = F.get(F.sort_array(f"{b}_held"), at.cast("int"))
        read = (at >= 0) & (at < F.col(f"{b}_within"))
        edge = F.when(at < 0, F.col(f"{b}_lo")).otherwise(F.col(f"{b}_hi"))
        picked.append(F.when(read, row["value"] if key else row).otherwise(edge).alias(label))
        if key:
            picked.append(F.when(read, row[key]).alias(f"{label}_key"))
    return counts.select(*by, "n", *picked)


def quantiles(df: DataFrame, metrics: list[str], probs: dict[str, float], by: list[str] = (),
              key: str = "entity_id") -> DataFrame:
    """``by..., metric, n`` and one column per named probability (linear interpolation).

    Groups with a NULL key are left out.
    """
    by = list(by)
    # The metric travels as its number; shuffling names would cost more than the values.
    values = F.posexplode(F.array(*[F.col(m).cast("double") for m in metrics])).alias("__metric", "value")
    long = df.select(*by, values).where(F.abs("value") < F.lit(INFINITY))
    for column in by:
        long = long.where(F.col(column).isNotNull())
    place = {name: F.lit(float(p)) * (F.col("n") - 1) for name, p in probs.items()}
    wide = select_ranks(long, [*by, "__metric"], [
        (f"{name}_{side}", name, rounding(place[name]).cast("bigint"))
        for name in probs for side, rounding in (("floor", F.floor), ("ceil", F.ceil))
    ])
    named = F.element_at(F.array(*[F.lit(m) for m in metrics]), F.col("__metric") + 1)
    return wide.select(*by, named.alias("metric"), "n", *[
        (F.col(f"{name}_floor") + (F.col(f"{name}_ceil") - F.col(f"{name}_floor")) * (place[name] - F.floor(place[name]))).alias(name)
        for name in probs
    ])


# Labels of the four spend bands, lowest first, and the label of a lone entity.
BAND_LABELS = ["Baixo", "Médio-baixo", "Médio-alto", "Alto"]
SINGLE_BAND = "Única"


def spend_band(df: DataFrame, value: str = "spend_total", key: str = "entity_id",
               labels: list[str] = BAND_LABELS, single: str = SINGLE_BAND) -> DataFrame:
    """Adds ``band_no`` and ``spend_band``: equal-count bands by rank of ``value`` (NULL lowest), ties by key.

    With bands 1..B and n rows, rank r falls in band ``max(1, ceil(B (r-1) / (n-1)))``; so band b ends
    at rank ``floor(b (n-1) / B) + 1``. The B-1 rows at those ranks are the cut points, and every row
    compares itself with them where it is.
    """
    bands = len(labels)
    number = F.col(value).cast("double")
    number = F.when(number.isNull(), F.lit(-INFINITY)).when(F.isnan(number), F.lit(INFINITY)).otherwise(number)
    cuts = _cuts(df.select(number.alias("value"), F.col(key).alias("key")), bands)
    if cuts is None:
        return df.withColumns({"band_no": F.lit(1), "spend_band": F.lit(single)})
    place = F.lit(1)
    for cut_value, cut_key in cuts:
        above = (number > F.lit(cut_value)) | ((number == F.lit(cut_value)) & (F.col(key) > F.lit(cut_key)))
        place = place + F.when(above, 1).otherwise(0)
    label = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("band_no"))
    return df.withColumn("band_no", place).withColumn("spend_band", label)


def _cuts(rows: DataFrame, bands: int) -> list[tuple] | None:
    """The (value, key) rows that end bands 1 to ``bands`` - 1; ``None`` for fewer than two rows.

    Where a cut's value is an end of its bracket, many rows may share it; its key is then looked for among
    the keys of those rows.
    """
    position = {b: F.floor(F.lit(b) * (F.col("n") - 1) / bands) for b in range(1, bands)}
    wanted = [(f"c{b}", f"b{b}", place) for b, place in position.items()]
    found = select_ranks(rows.select(F.lit(0).alias("__all"), "*"), ["__all"], wanted, "key").first()
    if found is None or found["n"] < 2:
        return None
    n, cuts = found["n"], [(found[f"c{b}"], found[f"c{b}_key"]) for b in range(1, bands)]
    tied = sorted({v for v, k in cuts if k is None})
    if not tied:
        return cuts
    below = rows.agg(*[F.count_if(F.col("value") < F.lit(v)) for v in tied]).first()
    wanted_keys = [(i, v, b * (n - 1) // bands - below[tied.index(v)]) for i, (b, (v, k)) in enumerate(zip(range(1, bands), cuts)) if k is None]
    for i, v, place in wanted_keys:
        keys = rows.where(F.col("value") == F.lit(v)).select(F.lit(0).alias("__all"), F.col("key").alias("value"))
        if isinstance(keys.schema["value"].dataType, T.IntegralType):
            at = select_ranks(keys, ["__all"], [("k", "b", F.lit(place).cast("bigint"))]).first()["k"]
        else:  # other keys have no sketch: they are sorted over all tasks
            at = with_positions(keys, ["value"]).where(F.col("__pos") == place).first()["value"]
        cuts[i] = (v, at)
    return cuts
