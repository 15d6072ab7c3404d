"""Tolerant number handling as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Every character that counts as white space at the ends of a text.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B))
)
INFINITY = float("inf")


def number_from_text(col: Column) -> Column:
    """Text as double, NULL where it is no number.

    ``try_cast`` alone would also take Java's type suffixes (``1.5d``, ``2f``), hexadecimal, NaN and inf.
    Masking their letters first makes the cast refuse them, and reads the text only once.
    """
    return F.translate(col, "dDfFnNxX", "?" * 8).try_cast("double")


def coerce_number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as double; NaN and text that is no finite number become NULL."""
    col, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return number_from_text(col)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col), col.cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return col.cast("double")
    return F.lit(None).cast("double")


def coerce_whole(df: DataFrame, name: str, to: str = "bigint") -> Column:
    """Column ``name`` as an integer, fractions cut off; whole numbers never pass through double."""
    col, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return col.try_cast(to)
    through_double = null_nonfinite(coerce_number(df, name)).try_cast(to)
    if isinstance(kind, T.StringType):
        return F.coalesce(col.try_cast(to), through_double)
    return through_double


def coerce_year_value(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a nullable int year; a fractional year becomes NULL."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).try_cast("int")
    number = null_nonfinite(coerce_number(df, name))
    return F.when(number == F.floor(number), number.try_cast("int"))


def null_nonfinite(col: Column) -> Column:
    """NaN and both infinities to NULL (NaN sorts above infinity, so one comparison finds all three)."""
    return F.when(F.abs(col) < F.lit(INFINITY), col)


def clip_floor(col: Column, floor: float = 0.0) -> Column:
    """Values below ``floor`` become ``floor``; NULL stays NULL (``greatest`` alone would fill it)."""
    return F.when(col.isNotNull(), F.greatest(col, F.lit(floor)))


def flag_refund(col: Column) -> Column:
    return col < F.lit(0)


def exact_money(col: Column) -> Column:
    """Money as a decimal with the digits that the amount is written with, up to 18 after the point."""
    return col.cast("double").cast("decimal(38,18)")


MICRO, NANO = 1_000_000, 1_000_000_000
#: Amounts below this many units are split into limbs; larger ones are added as doubles.
LARGEST = 1e12
LIMBS = ("w", "f", "r", "big")


def whole(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def money_limbs(col: Column, micros: Column | None = None) -> dict[str, Column]:
    """An amount as whole units and two groups of nine decimals, all integers, so that sums are exact in any order.

    An amount that is the closest double to a number of millionths, as nearly all are, takes integer arithmetic only;
    others go through their decimal digits. Amounts from 1e12 on stay doubles (``big``). ``micros`` is ``rint`` of the
    amount times a million, where the caller has it as a column.
    """
    x = col.cast("double")
    micros = F.rint(x * MICRO) if micros is None else micros
    small = (F.abs(x) < 9e9) & (micros / MICRO == x)
    units, other = micros.try_cast("bigint"), F.abs(x) < LARGEST
    digits = exact_money(x)
    rest = ((digits % 1).cast("decimal(18,18)") * F.lit(10**18).cast("decimal(19,0)")).cast("bigint")
    return {
        "w": F.when(small, whole(units, MICRO)).when(other, digits.cast("bigint")),
        "f": F.when(small, units % MICRO * 1000).when(other, whole(rest, NANO)),
        "r": F.when(~small & other, rest % NANO),
        "big": F.when(~other, x),
    }


def add_limbs(limbs: dict[str, Column]) -> Column:
    """The double closest to the sum of all amounts whose limbs these columns hold; NULL for none.

    A sum of millionths below 2 ** 53 of them takes one division; others are put together as a decimal. A group of
    more than some 10 ** 10 amounts raises an overflow error.
    """
    w, f, r, big = (F.sum(limbs[name]) for name in LIMBS)
    f, r = F.coalesce(f, F.lit(0)), F.coalesce(r, F.lit(0))
    plain = (r == 0) & (f % 1000 == 0) & (F.abs(w) < 4_000_000_000) & (F.abs(f) < 4_000_000_000 * NANO)
    exact = lambda c, places: (c.cast("decimal(19,0)") * F.lit(f"1e-{places}").cast(f"decimal(18,{places})")).cast("decimal(38,18)")
    total = F.when(plain, (w * MICRO + whole(f, 1000)) / MICRO).otherwise(
        (w.cast("decimal(38,18)") + exact(f, 9) + exact(r, 18)).cast("double"))
    return F.when(big.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + big)


def sum_money(col: Column) -> Column:
    """Exact sum of the amounts as given, so the result does not depend on partition order; double at the end."""
    return add_limbs(money_limbs(col))


def with_limbs(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with the limbs of money columns, worked out once for any number of sums (``sum_limbs``)."""
    df = df.withColumns({f"__{n}_micros": F.rint(F.col(n).cast("double") * MICRO) for n in names})
    return df.withColumns({
        f"__{n}_{limb}": c for n in names for limb, c in money_limbs(F.col(n), F.col(f"__{n}_micros")).items()
    })


def sum_limbs(name: str, where: Column | None = None) -> Column:
    """``sum_money`` of a column that ``with_limbs`` was given, over the rows where ``where`` holds."""
    limbs = {limb: F.col(f"__{name}_{limb}") for limb in LIMBS}
    return add_limbs(limbs if where is None else {limb: F.when(where, c) for limb, c in limbs.items()})


def mean_money(col: Column) -> Column:
    """Mean of the non-null values from the exact sum (NULL for no values)."""
    return sum_money(col) / F.nullif(F.count(col), F.lit(0))


def parse_money(col: Column) -> Column:
    """``R$ 1.234,56`` to 1234.56: dots group thousands, the comma is the decimal mark.

    NULL and unreadable text give 0.0, as the cleaning step expects.
    """
    blank = F.lit(WHITE_SPACE)
    text = F.trim(F.replace(col, F.lit("R$"), F.lit("")), blank)
    text = F.translate(text, ",.", ".")
    return F.coalesce(number_from_text(text), F.lit(0.0))


def log1p_spend(col: Column) -> Column:
    return F.log1p(clip_floor(col))


def replace_values(col: Column, mapping: dict) -> Column:
    """Exact-value replacement; other values pass through."""
    out = col
    for old, new in mapping.items():
        out = F.when(col == F.lit(old), F.lit(new)).otherwise(out)
    return out


def format_amount(col: Column) -> Column:
    """Hover text: millions as ``R$ x.xxM``, thousands grouped, smaller values with one decimal."""
    millions = F.concat(
        F.lit("R$ "), F.replace(F.format_number(col / 1e6, 2), F.lit(","), F.lit("")), F.lit("M")
    )
    return (
        F.when(col >= 1e6, millions)
        .when(col >= 1e3, F.format_number(col, 0))
        .otherwise(F.replace(F.format_number(col, 1), F.lit(","), F.lit("")))
    )
