"""Roman numerals and letter labels as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The steps of Roman numerals.
ROMAN = (("M", 1000), ("CM", 900), ("D", 500), ("CD", 400), ("C", 100), ("XC", 90), ("L", 50), ("XL", 40), ("X", 10), ("IX", 9), ("V", 5), ("IV", 4), ("I", 1))


def to_roman(number: Column) -> Column:
    """Roman numeral of a positive integer; NULL for NULL and for numbers below 1."""
    out, rest = F.lit(""), number.cast("int")
    for sign, value in ROMAN:
        out = F.concat(out, F.repeat(F.lit(sign), F.floor(rest / value).cast("int")))
        rest = rest % value
    return F.when(number >= 1, out)


def from_roman(text: Column) -> Column:
    """Value of a Roman numeral in any case: a sign smaller than one to its right counts against; NULL if other letters occur."""
    signs = F.split(F.upper(text), "")
    values = F.filter(F.transform(signs, lambda s: F.element_at(F.create_map(*[F.lit(x) for sign, value in ROMAN if len(sign) == 1 for x in (sign, value)]), s)), lambda v: v.isNotNull())
    total = F.aggregate(
        F.reverse(values),
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("most")),
        lambda a, v: F.struct((a["sum"] + F.when(v < a["most"], -v).otherwise(v)).alias("sum"), F.greatest(a["most"], v).alias("most")),
        lambda a: a["sum"],
    )
    return F.when(text.rlike("(?i)^[ivxlcdm]+$"), total)


def letter_index(label: Column) -> Column:
    """a..z to 1..26, aa to 27 and so on for one repeated letter; NULL for anything else."""
    same = label.rlike(r"^([a-z])\1*$")
    return F.when(same, (F.length(label) - 1) * 26 + F.ascii(label) - 96)
