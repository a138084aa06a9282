"""Several code references packed into one field, one per row again with their place kept.

A dictionary of whole values is read from the corpus itself: the fields that hold nothing but one reference, with its letters
and bracket groups. It is compiled into a multi-pattern automaton, beside one of the words that announce references and
remarks; a dynamic programme then takes the cheapest cover of each field by known values, values put together from known
parts, remarks, words and delimiters, so that the hyphen of `498-A`, the comma of `376(2)(a,b)` or a space before a letter never
splits a known value. A number of which the dictionary knows nothing is read by its form, which is a dear way out.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words before a number that make it a page, note, amount or date and no reference.
REMARK_BEFORE = (
    "p", "pp", "pg", "page", "pages", "note", "notes", "fn", "footnote", "vol", "volume", "ch", "chap", "chapter", "sr", "serial",
    "no", "nos", "para", "paras", "rs", "rupees", "item", "entry", "row", "line", "col", "column", "file", "sheet", "copy", "year",
    "as on", "w.e.f", "wef", "dated", "dt", "on", "from", "of",
)
#: Words after a number that make it a count, term or amount.
REMARK_AFTER = ("copies", "copy", "pages", "notes", "rupees", "days", "months", "years", "entries", "rows", "lines", "times", "per cent")
#: Words that stand around references.
AROUND = (
    "section", "sections", "sec", "secs", "s", "ss", "u/s", "u", "r/w", "read with", "and", "or", "with", "ipc", "code", "of the", "of", "the",
    "see", "fine", "up to", "old", "at", "act",
)

#: More distinct whole values than this are no list of one code's sections; the dictionary is refused then, not cut.
MOST_VALUES = 1_000_000
_NUMBER_FORM = r"([0-9]{1,3})(?:( ?- ?| )?([A-Z]{1,2})|-?([a-z]{1,2}))?"
_GROUP = r"\s*\(\s*(?:[0-9]+|[a-z])(?:\s*,\s*(?:[0-9]+|[a-z]))*\s*\)"
_WHOLE = rf"^\s*{_NUMBER_FORM}((?:{_GROUP})*)\s*$"
#: The form of a reference, for numbers at which the dictionary gives no help.
_REFERENCE = re.compile(r"([0-9]{1,3})(?![0-9])(?:(?:\s*-\s*|\s+)?([A-Z]{1,2})(?![A-Za-z])|-?([a-z]{1,2})(?![A-Za-z]|/[A-Za-z]))?")
_GROUPS = re.compile(f"(?:{_GROUP})+")
_LETTERS = re.compile(r"\s*-?\s*([A-Za-z]{1,2})(?![A-Za-z]|/[A-Za-z])")
_GAP = re.compile(r"\s*-?\s*")
_GROUPS_ONE = re.compile(_GROUP)
_DIGITS = re.compile(r"[0-9]+")
_DATE = re.compile(r"(?<![0-9]/)(?:0?[1-9]|[12][0-9]|3[01])([./-])(?:0?[1-9]|1[0-2])\1[12][0-9]{3}(?![0-9])")
_AMOUNT = re.compile(r"[\s.:]*(?:[0-9]{1,2}([./-])[0-9]{1,2}\1(?:[0-9]{4}|[0-9]{2})(?![0-9])|[0-9]+(?:,[0-9]{3})*)")
_WORD = re.compile(r"[^\W\d_]+")
_KNOWN, _COMPOSED, _UNKNOWN, _REMARK, _AROUND, _MARK, _STRAY, _NUMBER = 1.0, 1.6, 3.5, 0.4, 0.3, 0.1, 2.0, 4.0


def dictionary(*columns: tuple[DataFrame, str]) -> DataFrame:
    """Distinct whole values (`498A`, `376(2)(a,b)`) of the fields that hold one reference and nothing else; arrays count by element."""
    values = None
    for df, name in columns:
        value = F.explode_outer(name) if df.schema[name].dataType.typeName() == "array" else F.col(name)
        part = df.select(value.alias("v"))
        values = part if values is None else values.unionAll(part)
    number = F.regexp_replace(F.regexp_extract("v", _WHOLE, 1), "^0+", "")
    groups = F.regexp_replace(F.regexp_extract("v", _WHOLE, 5), r"\s", "")
    value = F.concat(number, F.upper(F.regexp_extract("v", _WHOLE, 3)), F.upper(F.regexp_extract("v", _WHOLE, 4)), groups)
    return values.where(F.col("v").rlike(_WHOLE) & (number != "")).select(value.alias("value")).distinct()


class Values:
    """The dictionary as an automaton of whole values, and the parts (letters, bracket groups) that they are made of."""

    def __init__(self, known: Iterable[str]) -> None:
        self.whole, self.letters, self.groups = ahocorasick.Automaton(), set(), set()
        for value in known:
            number, letters, groups = re.fullmatch(r"([0-9]+)([A-Z]*)(.*)", value).groups()
            self.whole.add_word(value.lower(), (value, len(number)))
            self.letters.add(letters)
            self.groups.update(re.findall(r"\([^)]*\)", groups))
        if len(self.whole):
            self.whole.make_automaton()
        self.words = ahocorasick.Automaton()
        for kind, listed in (("before", REMARK_BEFORE), ("around", AROUND), ("after", REMARK_AFTER)):
            for word in listed:
                self.words.add_word(word, (*self.words.get(word, ()), (kind, len(word))))
        self.words.make_automaton()

    def matches(self, low: str) -> Iterator[tuple[int, int, str]]:
        """(start, end, value) of the known values in a lower-case field; white space and a hyphen may part number, letters and groups."""
        if not len(self.whole):
            return
        at = [k for k, c in enumerate(low) if c != "-" and not c.isspace()]
        for last, (value, digits) in self.whole.iter("".join(low[k] for k in at)):
            own = at[last - len(value) + 1 : last + 1]
            start, end = own[0], own[-1] + 1
            if low[start - 1 : start].isalnum() and start or low[own[digits - 1] + 1 : own[digits - 1] + 2].isdigit():
                continue  # part of a longer number or word
            if low[end : end + 1].isalpha() or (low[end : end + 1] == "/" and low[end - 1].isalpha() and low[end + 1 : end + 2].isalpha()):
                continue
            gaps = [(a, b) for a, b in zip(own, own[1:]) if b > a + 1]
            # inside the number nothing may stand, after it a hyphen too, around brackets and commas white space only
            if all(b > own[digits - 1] and (low[a + 1 : b].isspace() or (b == own[digits] and low[b].isalpha() and _GAP.fullmatch(low, a + 1, b))) and not (low[a].isalpha() and low[b].isalpha()) for a, b in gaps):
                yield start, end, value

    def composed(self, field: str, start: int, digits: int) -> Iterator[tuple[int, str]]:
        """(end, value) of the number at start with letters and groups that occur in known values, if it stands with any."""
        for hit in (_LETTERS.match(field, digits), None):
            letters = hit[1].upper() if hit else ""
            if hit and (letters not in self.letters or (hit[1].islower() and field[digits : hit.start(1)].isspace())):
                continue
            end = hit.end() if hit else digits
            tail = ""
            while (group := _GROUPS_ONE.match(field, end)) and (inner := re.sub(r"\s", "", group[0])) in self.groups:
                end, tail = group.end(), tail + inner
            if letters or tail:
                yield end, letters + tail


def automaton(known: Iterable[str]) -> Values:
    return Values(known)


def _edges(field: str, values: Values) -> dict[int, list[tuple[int, float, str | None]]]:
    """Edges (end, cost, reference or None) by start; every position has at least one that leads on."""
    low, size = field.lower(), len(field)
    if len(low) != size:  # a letter whose lower case is longer
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in field)
    edges: dict[int, list[tuple[int, float, str | None]]] = {}
    for last, kinds in values.words.iter(low):
        end = last + 1
        for kind, length in kinds:
            start = end - length
            before, after = field[start - 1 : start], field[end : end + 1]
            if (before.isalpha() or after.isalpha()) or (kind != "after" and before.isdigit()):
                continue
            if kind == "around":
                edges.setdefault(start, []).append((end, _AROUND, None))
            elif kind == "before":
                if hit := _AMOUNT.match(field, end):
                    edges.setdefault(start, []).append((hit.end(), _REMARK, None))
            else:  # the number before it, however far
                first = len(field[:start].rstrip())
                while first and "0" <= field[first - 1] <= "9":
                    first -= 1
                if "0" <= field[first] <= "9":
                    edges.setdefault(first, []).append((end, _REMARK, None))
    for start, end, value in values.matches(low):
        edges.setdefault(start, []).append((end, _KNOWN, value))
    for number in _DIGITS.finditer(field):
        at = number.start()
        if hit := _DATE.match(field, at):
            edges.setdefault(at, []).append((hit.end(), _REMARK, None))
        edges.setdefault(at, []).append((number.end(), _NUMBER, None))
        if number.end() - at > 3 or field[at - 1 : at].isalpha() or int(number[0]) == 0:
            continue
        plain = number[0].lstrip("0")
        # a reference cut short of its letters or bracket groups leaves them uncovered, which costs more
        edges[at] += [(end, _COMPOSED, plain + rest) for end, rest in values.composed(field, at, number.end())]
        hit = _REFERENCE.match(field, at)
        for letters, end in {(hit[2] or hit[3] or "", hit.end()), ("", hit.end(1))}:
            if letters or not field[end : end + 1].isalpha():
                groups = _GROUPS.match(field, end)
                edges[at].append((groups.end() if groups else end, _UNKNOWN, plain + letters.upper() + (re.sub(r"\s", "", groups[0]) if groups else "")))
    return edges


def cover(field: str, values: Values) -> list[str]:
    """References of a field in order, by the cheapest cover."""
    edges, size = _edges(field, values), len(field)
    best: list[float] = [0.0] + [float("inf")] * size
    back: list[tuple[int, str | None]] = [(0, None)] * (size + 1)
    at = 0
    while at < size:
        if best[at] < float("inf"):
            own = edges.get(at, [])
            char = field[at]
            if char.isalpha():
                own = [*own, (_WORD.match(field, at).end() if _WORD.match(field, at) else at + 1, _STRAY, None)]
            elif not char.isdigit():
                own = [*own, (at + 1, _MARK, None)]
            elif not own:
                own = [(at + 1, _NUMBER, None)]
            for end, cost, ref in own:
                if best[at] + cost < best[end] - 1e-9:
                    best[end], back[end] = best[at] + cost, (at, ref)
        at += 1
    refs, at = [], size
    while at > 0:
        at, ref = back[at]
        if ref:
            refs.append(ref)
    return refs[::-1]


def split_packed(df: DataFrame, id_col: str, field: str, known: Iterable[str]) -> DataFrame:
    """(id, pos, ipc_ref, packed): every reference of the string or array column `field`.

    pos counts from 1 through the field, through all elements of an array; packed says whether one element holds two
    or more references. NULL or blank fields, NULL elements and fields without a reference give no row; repeated rows and
    repeated references are kept; other columns of df are left out. Narrow: no shuffle, and the dictionary is bounded.
    """
    words = tuple(known)
    kind = df.schema[id_col].dataType.simpleString()
    is_array = df.schema[field].dataType.typeName() == "array"
    source = df.select(F.col(id_col).alias("__id"), (F.col(field) if is_array else F.array(F.col(field))).cast("array<string>").alias("__field"))
    shared = df.sparkSession.sparkContext.broadcast(words)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = Values(shared.value)

        @lru_cache(maxsize=50_000)
        def refs_of(value: str) -> tuple[str, ...]:
            return tuple(cover(value, values))

        for batch in batches:
            rows, poss, refs, packed = [], [], [], []
            for row, elements in enumerate(batch.column(1).to_pylist()):
                found = [refs_of(e) for e in elements if e]
                many = any(len(f) > 1 for f in found)
                for pos, ref in enumerate((r for f in found for r in f), 1):
                    rows.append(row)
                    poss.append(pos)
                    refs.append(ref)
                    packed.append(many)
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(poss, pa.int32()), pa.array(refs, pa.string()), pa.array(packed, pa.bool_())], names=[id_col, "pos", "ipc_ref", "packed"])

    return source.where(F.col("__field").isNotNull()).mapInArrow(split, f"`{id_col}` {kind}, pos int, ipc_ref string, packed boolean")
