"""Freely entered values mapped to the entry of a reference list that the writer meant.

The list and its known synonyms are turned into a symmetric-delete dictionary: every term is filed under all strings that
deleting up to two characters leaves. A value finds its candidates by its own deletes, so no value is compared with the whole
list. Candidates within the edit bound are ranked by weighted Damerau-Levenshtein distance, then by how often the term
occurs in the column. The dictionary depends on the list alone and is broadcast; rows are looked up where they lie.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Mapping
from functools import lru_cache
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What stands for a missing value, after white space is collapsed and case ignored.
NULL_MARKS = ("", "nan", "none", "-", "—", "na", "n/a")
#: Ways in which clerks write each status, beside its label. A parameter of the operator.
SYNONYMS: dict[str, tuple[str, ...]] = {
    "carried_over": (
        "c/o", "carry over", "carried forward", "no change", "not changed", "unchanged", "retained", "retained as is", "identical", "kept as such", "yathavat",
        "यथावत", "brought forward", "continued", "same as before", "as it was", "same",
    ),
    "changed": (
        "changed", "changes made", "chg", "chgd", "amended", "partly amended", "modified", "modification", "altered", "reworded", "revised", "text revised",
        "punishment increased", "fine enhanced", "changed in part", "substituted", "badlav", "परिवर्तित",
    ),
    "deleted": (
        "delete", "del", "omitted", "removed", "repealed", "dropped", "left out", "struck off", "scrapped", "abolished", "done away with", "no successor",
        "not retained in new code", "hataya gaya", "हटाया गया",
    ),
    "new_section": (
        "new sec", "new sectn", "newsection", "fresh section", "section inserted", "newly added section", "section newly added", "sec newly created", "new provision whole section",
        "nayi dhara", "नई धारा",
    ),
    "new_subsection": (
        "new subsection", "new sub sec", "new s/section", "subsection newly added", "newly added sub section", "fresh sub section", "sub sec inserted",
        "nayi up dhara", "नई उपधारा",
    ),
    "merged": ("merger", "mergd", "merged into one", "clubbed", "clubbed with others", "combined", "consolidated", "amalgamated", "joined together", "मिलाया गया"),
    "split": ("splitted", "split up", "split in two", "divided", "division", "bifurcated", "broken up", "separated into parts", "विभाजित"),
    "renumbered": (
        "renumbering", "renumberd", "re numbered", "renum", "number changed only", "only number differs", "numbering altered only", "new number same text",
    ),
    "moved": (
        "moved to other chapter", "shifted", "shifted to another chapter", "transferred", "transferred to other chapter", "relocated", "transposed",
        "placed elsewhere", "chapter altered", "स्थानांतरित",
    ),
}
#: Remarks written before or after a status that do not change it.
_BEFORE = re.compile(r"^(?:status|marked as|marked|prob|probably|shown as|now)\b[\s:.]*")
_AFTER = re.compile(r"\s*(?:[-/,;]?\s*\b(?:verified|checked|confirmed)|\(?\bsee (?:note|remarks)\b[^)]*\)?|\bvide\b.*|\bw\.?\s?e\.?\s?f\b.*)$")
MAX_EDITS = 2
#: Terms of more characters are found by their parts instead of their deletes.
LONG = 60


def collapsed(value: str) -> str:
    return " ".join(unicodedata.normalize("NFC", value).split()).lower()


def key(value: str) -> str:
    """Letters, digits, marks and slashes of a collapsed value with single spaces."""
    kept = "".join(c if c.isalnum() or c == "/" or unicodedata.category(c) in ("Mn", "Mc") else " " for c in value)
    return " ".join(kept.replace(" / ", " ").split()).strip("/ ")


def readings(value: str) -> list[str]:
    """Keys under which a value may be meant: as it stands, then without the remarks around it."""
    plain = collapsed(value)
    forms = [key(plain)]
    while True:
        inner = _AFTER.sub("", _BEFORE.sub("", plain.strip(" *.!?()[]{}\"'")))
        if inner == plain:
            break
        plain = inner
        forms.append(key(plain))
    return list(dict.fromkeys(f for f in forms if f))


def bound(size: int) -> int:
    """Edits allowed for a term of this many characters; short ones must be right."""
    return 0 if size <= 4 else 1 if size <= 6 else MAX_EDITS


def deletes(text: str, most: int) -> set[str]:
    spots = range(len(text))
    return {"".join(c for k, c in enumerate(text) if k not in gone) for n in range(most + 1) for gone in combinations(spots, min(n, len(text)))}


def distance(a: str, b: str, most: int) -> float | None:
    """Weighted Damerau-Levenshtein distance, or None if more than `most` plain edits are needed.

    Swapped neighbours cost 0.7, spaces and doubled letters put in or left out 0.6, everything else 1.
    """
    if abs(len(a) - len(b)) > most:
        return None

    def gap(text: str, k: int) -> float:
        return 0.6 if text[k] == " " or (k and text[k] == text[k - 1]) or text[k] == text[k + 1 : k + 2] else 1.0

    rows: list[list[tuple[int, float]]] = [[(0, 0.0)]]
    for j in range(len(b)):
        edits, weight = rows[0][j]
        rows[0].append((edits + 1, weight + gap(b, j)))
    seen: dict[str, int] = {}  # last row of each character of a
    for i in range(len(a)):
        edits, weight = rows[i][0]
        row, match = [(edits + 1, weight + gap(a, i))], -1  # match: last column of this row with the same character
        for j in range(len(b)):
            up, side, corner = rows[i][j + 1], row[j], rows[i][j]
            options = [(up[0] + 1, up[1] + gap(a, i)), (side[0] + 1, side[1] + gap(b, j)), corner if a[i] == b[j] else (corner[0] + 1, corner[1] + 1.0)]
            if (before := seen.get(b[j], -1)) >= 0 and match >= 0:  # swapped, perhaps with edits between the two
                between = i - before - 1 + j - match - 1
                edits, weight = rows[before][match]
                options.append((edits + 1 + between, weight + 0.7 + between))
            if a[i] == b[j]:
                match = j
            row.append(min(options))
        seen[a[i]] = i
        rows.append(row)
    edits, weight = rows[-1][-1]
    return weight if edits <= most else None


class Dictionary:
    """Symmetric-delete index over the terms of a reference list.

    Terms of more than LONG characters have too many deletes. They are filed under three equal parts instead, of which two edits
    leave at least one whole. Neither terms nor values are bounded in length.
    """

    def __init__(self, terms: Mapping[str, str], frequency: Mapping[str, int]) -> None:
        self.terms, self.frequency, self.index = dict(terms), dict(frequency), {}
        self.parts: dict[str, list[str]] = {}
        self.longest = max((len(t) for t in self.terms if len(t) <= LONG), default=0)
        for term in self.terms:
            if len(term) > LONG:
                third = len(term) // (MAX_EDITS + 1)
                for k in range(MAX_EDITS + 1):
                    self.parts.setdefault(term[k * third : (k + 1) * third], []).append(term)
                continue
            for left in deletes(term, bound(len(term))):
                self.index.setdefault(left, []).append(term)
        self.sizes = sorted({len(p) for p in self.parts})

    def near(self, form: str) -> set[str]:
        """Terms that may be within the edit bound of a form."""
        found: set[str] = set()
        if len(form) <= self.longest + MAX_EDITS:  # a longer one is too far from all of them
            found |= {term for left in deletes(form, MAX_EDITS if len(form) > 4 else 1) for term in self.index.get(left, ())}
        for size in self.sizes:
            found |= {term for k in range(len(form) - size + 1) for term in self.parts.get(form[k : k + size], ()) if abs(len(term) - len(form)) <= MAX_EDITS}
        return found

    def lookup(self, form: str) -> tuple[float, int, str, str] | None:
        """(distance, -frequency, term, code) of the best term, or None."""
        if form in self.terms:
            return 0.0, -self.frequency.get(form, 0), form, self.terms[form]
        found = [(d, -self.frequency.get(t, 0), t, self.terms[t]) for t in self.near(form) if (d := distance(form, t, bound(len(t)))) is not None]
        return min(found, default=None)

    def meant(self, value: str) -> str:
        """Code of the entry meant, or `unmatched`."""
        hits = [(hit[0], n, hit[1:]) for n, form in enumerate(readings(value)) if (hit := self.lookup(form))]
        return min(hits)[2][-1] if hits else "unmatched"


def terms_of(entries: Mapping[str, str], synonyms: Mapping[str, tuple[str, ...]] = SYNONYMS) -> dict[str, str]:
    """Term to code, of the labels, codes and synonyms of {code: label}; a label wins over a synonym of another entry."""
    terms: dict[str, str] = {}
    for code, label in sorted(entries.items()):
        for form in (label, code.replace("_", " ")):
            terms.setdefault(key(collapsed(form)), code)
    for code in sorted(entries):
        for form in synonyms.get(code, ()):
            terms.setdefault(key(collapsed(form)), code)
    return terms


def entered(df: DataFrame, column: str, labels: list[str]) -> DataFrame:
    """Rows whose value, trimmed, is not NULL, no null mark and not exactly a label: the ones to be mapped."""
    value = F.regexp_replace(F.col(column), r"(?U)\A\s+|\s+\z", "")
    plain = F.lower(F.regexp_replace(value, r"(?U)\s+", " "))
    return df.where(F.col(column).isNotNull() & ~plain.isin(*NULL_MARKS) & ~value.isin(*labels) if labels else F.col(column).isNotNull() & ~plain.isin(*NULL_MARKS))


def term_frequency(df: DataFrame, column: str, terms: Mapping[str, str]) -> dict[str, int]:
    """How often each term is entered as it stands; one small count per term comes back (the dictionary bounds it)."""
    plain = F.trim(F.regexp_replace(F.lower(F.col(column)), r"(?U)[^\p{L}\p{M}\p{N}/]+", " "))
    rows = df.select(plain.alias("term")).where(F.col("term").isin(*terms)).groupBy("term").count().collect()
    return {r["term"]: r["count"] for r in rows}


def map_to_list(df: DataFrame, id_col: str, column: str, reference: DataFrame, code_col: str = "status_code", label_col: str = "label", synonyms: Mapping[str, tuple[str, ...]] = SYNONYMS, max_entries: int = 10_000) -> DataFrame:
    """(id, value, code) of every row whose value is free-entered; code is `unmatched` where no entry is meant.

    The reference list is checked to hold at most max_entries rows before it is broadcast; a longer one is refused, since
    this operator is for short canonical lists. NULL values, null marks and exact labels give no row; repeated rows stay.
    Values of any length are looked up.
    """
    head = reference.select(code_col, label_col).where(F.col(code_col).isNotNull() & F.col(label_col).isNotNull()).limit(max_entries + 1).collect()
    if len(head) > max_entries:
        raise ValueError(f"the reference list has more than {max_entries} entries")
    entries = {r[0]: r[1] for r in head}
    labels = sorted(set(entries.values()))
    terms = terms_of(entries, synonyms)
    rows = entered(df, column, labels).select(id_col, F.col(column).alias("value"))
    shared = df.sparkSession.sparkContext.broadcast((terms, term_frequency(df, column, terms)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Dictionary(*shared.value)
        meant = lru_cache(maxsize=100_000)(index.meant)
        for batch in batches:
            yield batch.assign(code=[meant(v) for v in batch["value"]])

    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInPandas(run, f"`{id_col}` {kind}, value string, code string")


def misses(mapped: DataFrame) -> DataFrame:
    """(value, n): the values that mean no entry, collapsed and lower-cased, with their number of rows."""
    plain = F.lower(F.trim(F.regexp_replace("value", r"(?U)\s+", " ")))
    return mapped.where("code = 'unmatched'").groupBy(plain.alias("value")).agg(F.count(F.lit(1)).alias("n"))
