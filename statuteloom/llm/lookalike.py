"""One consistent form for text whose characters only look right.

Characters are mapped inside Spark SQL (translate and replace, no Python), the mapped values are grouped under an accent-
and case-sensitive Unicode collation, which also sees composed and decomposed accents as equal, and the least member of
each class, in binary order, is joined back as the canonical form.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statuteloom.functions.text import strip
from statuteloom.session import keep

#: Letters of other scripts, and Latin variants, that are drawn like a plain Latin letter.
LETTERS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ѵ": "V",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ϳ": "j", "ϲ": "c", "Ϲ": "C",
    "օ": "o", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m", "ⅰ": "i", "ⅴ": "v", "ⅹ": "x",
}
#: Latin ligatures.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
_STYLES = ("<font>", "<wide>", "<narrow>", "<noBreak>")
#: Marks without ink besides the format characters (category Cf): joiners of graphemes, fillers, variation selectors.
_UNSEEN = (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0))


@lru_cache(maxsize=1)
def tables() -> tuple[str, str, str]:
    """(characters with a one-letter form, those forms, characters without ink), by rule from the Unicode database."""
    wrong, right, unseen = [], [], [chr(c) for c in _UNSEEN]
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.category(char) == "Cf":
            unseen.append(char)
        elif unicodedata.category(char) == "Zs":
            wrong.append(char)
            right.append(" ")
        elif char in LETTERS:
            wrong.append(char)
            right.append(LETTERS[char])
        elif unicodedata.decomposition(char).startswith(_STYLES):
            plain = unicodedata.normalize("NFKC", char)
            if len(plain) == 1 and code not in _UNSEEN:
                wrong.append(char)
                right.append(LETTERS.get(plain, plain))
    return "".join(wrong), "".join(right), "".join(unseen)


def plain_form(text: Column) -> Column:
    """text with look-alikes mapped, invisible characters gone and white space at both ends cut; accents stay as composed."""
    wrong, right, unseen = tables()
    out = F.translate(text, wrong + unseen, right)
    for ligature, letters in LIGATURES.items():
        out = F.replace(out, F.lit(ligature), F.lit(letters))
    return trimmed(out)


def trimmed(text: Column) -> Column:
    return strip(text)


def classes(values: DataFrame, keys: Sequence[str], form: str = "form") -> DataFrame:
    """(keys, collated, canonical): equivalence classes of a form within its keys, with the least member in binary order."""
    collated = F.collate(form, "UNICODE").alias("collated")
    return values.where(F.col(form).isNotNull()).groupBy(*keys, collated).agg(F.min(F.collate(form, "UTF8_BINARY")).alias("canonical"))


def canonical_forms(values: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """values with column `canonical` added (a column of that name already there is replaced).

    Every text of one class, within equal keys, gets the same canonical form. Keys may be empty; NULL keys are equal to
    each other; NULL texts keep a NULL form and empty or blank ones get "". Rows are neither dropped nor multiplied.
    """
    formed = values.drop("canonical").withColumn("__form", plain_form(F.col(text)))
    own = classes(formed.select(*keys, F.col("__form").alias("form")), keys).select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("collated").alias("__collated"), "canonical")
    on = F.collate("__form", "UNICODE") == F.col("__collated")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return formed.join(own, on, "left").drop("__form", "__collated", *(f"__{k}" for k in keys))


@F.pandas_udf(T.BooleanType())
def same_when_composed(a: pd.Series, b: pd.Series) -> pd.Series:
    """The exact check on the few pairs that the collation calls equal: the same code points once accents are composed."""
    nfc = unicodedata.normalize
    return pd.Series([x is not None and y is not None and nfc("NFC", x) == nfc("NFC", y) for x, y in zip(a, b)], dtype=bool)


def same_look(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, left_text: str, right_id: str, right_text: str) -> DataFrame:
    """(left_id, right_id) of rows with equal keys whose texts differ as stored but look the same. NULL keys or texts never pair."""
    side = lambda df, id_, text, name: df.select(*keys, F.lit(name).alias("side"), F.col(id_).alias("id"), F.col(text).alias("text"))
    both = side(left, left_id, left_text, "l").unionAll(side(right, right_id, right_text, "r")).where(F.col("text").isNotNull())
    formed = keep(both.select(*keys, "side", "id", F.md5(trimmed(F.col("text"))).alias("stored"), plain_form(F.col("text")).alias("form")))
    own = classes(formed, keys).select(*keys, "collated", F.md5("canonical").alias("class"))  # digests, so that a text travels once
    member = formed.withColumn("collated", F.collate("form", "UNICODE")).join(own, [*keys, "collated"]).drop("collated")
    a = member.where("side = 'l'").select(*keys, "class", F.col("id").alias(left_id), F.col("stored").alias("stored_l"), F.col("form").alias("form_l"))
    b = member.where("side = 'r'").select(*keys, "class", F.col("id").alias(right_id), F.col("stored").alias("stored_r"), F.col("form").alias("form_r"))
    pairs = a.join(b, [*keys, "class"]).where(F.col("stored_l") != F.col("stored_r"))
    return pairs.where(same_when_composed("form_l", "form_r")).select(left_id, right_id)
