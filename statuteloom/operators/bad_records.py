"""Separation of delimited records that cannot be loaded from those that can.

Each Arrow batch is a block. It is parsed in bulk by the columnar CSV reader; where that fails it is halved and its halves
are parsed, again and again, until the offending records are isolated, and only these, and records whose section or status
fails a test on whole columns, are diagnosed strictly. Nothing is shuffled: the work is one narrow stage over the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = ("bns_section", "bns_title", "status", "ipc_section", "ipc_title")
#: What stands for a missing cell, after white space is collapsed and case ignored.
NULL_MARKS = ("", "nan", "none", "-", "—", "na", "n/a")
_NUMBER = re.compile(r"([0-9]{1,3})\s*(?:\(\s*[0-9a-z]+\s*\)\s*)*")
_HIGHEST = 358
_SECTION = r"^\s*(?P<n>[0-9]{1,3})\s*(?:\(\s*[0-9a-z]+\s*\)\s*)*$"
_MARK, _COMMA, _LINE_END = b'",\n'
_PARSE = pacsv.ParseOptions(newlines_in_values=True, ignore_empty_lines=False)
_CONVERT = pacsv.ConvertOptions(column_types=dict.fromkeys(CELLS, pa.string()), strings_can_be_null=False)
#: So few records are diagnosed one by one in less time than one more call of the reader takes.
LEAF = 32


def split_record(line: str | None) -> list[str] | None:
    """Cells of one record under strict quoting, or None if its quoting is broken. NULL has no cells."""
    if line is None:
        return []
    cells, at, end = [], 0, len(line)
    while True:
        if line.startswith('"', at):
            stop = line.find('"', at + 1)
            while stop >= 0 and line.startswith('"', stop + 1):
                stop = line.find('"', stop + 2)
            if stop < 0 or (stop + 1 < end and line[stop + 1] != ","):
                return None
            cells.append(line[at + 1 : stop].replace('""', '"'))
            at = stop + 1
        else:
            stop = line.find(",", at)
            stop = end if stop < 0 else stop
            if '"' in line[at:stop]:
                return None
            cells.append(line[at:stop])
            at = stop
        if at >= end:
            return cells
        at += 1


def _collapsed(text: str) -> str:
    return " ".join(text.split()).lower()


def section_ok(cell: str) -> bool:
    if _collapsed(cell) in NULL_MARKS:
        return True
    hit = _NUMBER.fullmatch(cell.strip())
    return bool(hit) and 1 <= int(hit[1]) <= _HIGHEST


def diagnose(line: str | None, statuses: frozenset[str]) -> tuple[list[str] | None, str | None]:
    """(cells, None) of a record that can be loaded, else (None, first reason that applies)."""
    cells = split_record(line)
    if cells is None:
        return None, "quoting"
    if len(cells) != len(CELLS):
        return None, "column_count"
    if not section_ok(cells[0]):
        return None, "bns_section"
    if _collapsed(cells[2]) not in statuses:
        return None, "status"
    return cells, None


class _Block:
    """Records of one Arrow batch as one run of bytes, each closed by a line end, so that any part of it can be parsed in place."""

    def __init__(self, lines: pa.Array) -> None:
        text = pa.large_string()
        closed = pc.binary_join_element_wise(pc.fill_null(lines.cast(text), ""), pa.scalar("", text), pa.scalar("\n", text))
        _, offsets, self.data = closed.buffers()
        self.at = np.frombuffer(offsets, dtype="int64")[closed.offset : closed.offset + len(closed) + 1]
        self.bytes = np.frombuffer(self.data, dtype="uint8")

    def parse(self, low: int, high: int) -> list[pa.Array] | None:
        """Columns of the records from low to high by the columnar reader, or None if any of them breaks the rules.

        The reader is lenient about quotation marks and may take line ends inside records for their ends. So the cells it found
        are laid along the bytes again, column by column: a cell that begins with a mark must end with one and hold all others
        doubled, any other cell must hold none, and each record must end where it does.
        """
        size = int(self.at[high] - self.at[low])
        options = pacsv.ReadOptions(column_names=list(CELLS), use_threads=False, block_size=size + 16)
        try:
            table = pacsv.open_csv(pa.BufferReader(self.data.slice(int(self.at[low]), size)), options, _PARSE, _CONVERT).read_all()
        except pa.ArrowInvalid:
            return None
        if table.num_rows != high - low:
            return None
        columns, at, fits = [], self.at[low:high].copy(), np.ones(high - low, dtype=bool)
        last = int(self.at[high]) - 1
        for name in CELLS:
            column = table[name].combine_chunks()
            columns.append(column)
            _, ends, content = column.buffers()
            ends = np.frombuffer(ends, dtype="int32")[column.offset : column.offset + len(column) + 1]
            marks = np.concatenate([[0], np.cumsum(np.frombuffer(content, dtype="uint8") == _MARK)]) if content is not None else np.zeros(1, dtype="int64")
            marks = marks[ends[1:]] - marks[ends[:-1]]
            quoted = self.bytes[np.minimum(at, last)] == _MARK
            end = at + np.diff(ends) + np.where(quoted, marks + 2, 0)
            fits &= np.where(quoted, self.bytes[np.minimum(end, last + 1) - 1] == _MARK, marks == 0)
            fits &= self.bytes[np.minimum(end, last)] == (_LINE_END if name == CELLS[-1] else _COMMA)
            at = end + 1
        return columns if bool((fits & (at == self.at[low + 1 : high + 1])).all()) else None


def bisect(block: _Block, low: int, high: int, leaf: int, fails: bool = False) -> Iterator[tuple[int, int, list[pa.Array] | None]]:
    """(low, high, columns) of runs of records that parse, and (low, high, None) of at most `leaf` records among which one fails.

    A failing run is halved. If its first half parses, the second one is known to fail and is halved without being parsed as a
    whole (`fails`).
    """
    if low >= high:
        return
    columns = None if fails else block.parse(low, high)
    if columns is not None or high - low <= leaf:
        yield low, high, columns
        return
    middle = (low + high) // 2
    first = list(bisect(block, low, middle, leaf))
    yield from first
    yield from bisect(block, middle, high, leaf, fails=all(found is not None for _, _, found in first))


def _loadable(section: pa.Array, status: pa.Array, statuses: pa.Array) -> np.ndarray:
    """Which of the records that parsed have a section and a status that can be used, judged on whole columns.

    White space is seen in the ASCII sense only, so a record that fails here may still be good; diagnose() has the last word.
    """
    number = pc.struct_field(pc.extract_regex(section, _SECTION), "n")
    inside = pc.fill_null(pc.is_in(number, pa.array([f"{n:0{w}d}" for w in (1, 2, 3) for n in range(1, _HIGHEST + 1) if len(str(n)) <= w])), False)
    blank = pc.is_in(pc.utf8_lower(pc.utf8_trim_whitespace(section)), pa.array(NULL_MARKS))
    known = pc.is_in(pc.utf8_lower(pc.utf8_trim_whitespace(pc.replace_substring_regex(status, r"\s+", " "))), statuses)
    return pc.and_(pc.or_(inside, blank), known).to_numpy(zero_copy_only=False)


def _cells_and_reasons(lines: pa.Array, statuses: frozenset[str], leaf: int) -> list[pa.Array]:
    """Columns of the cells, and the reasons, of the records of a batch."""
    block, listed = _Block(lines), pa.array(sorted(statuses), pa.string())
    runs, left = [], []
    for low, high, columns in bisect(block, 0, len(lines), leaf):
        if columns is None:
            left.append(np.arange(low, high))
        else:
            runs.append((np.arange(low, high), columns))
    rows = np.concatenate([r for r, _ in runs]) if runs else np.arange(0)
    parsed = [pa.concat_arrays([c[k] for _, c in runs]) if runs else pa.array([], pa.string()) for k in range(len(CELLS))]
    good = _loadable(parsed[0], parsed[2], listed) if len(rows) else np.zeros(0, dtype=bool)
    single = np.concatenate([*left, rows[~good]]).astype("int64")
    found = [diagnose(lines[int(k)].as_py(), statuses) for k in single]
    order = pa.array(np.argsort(np.concatenate([rows[good], single]), kind="stable"))
    keep = pa.array(good)
    out = [pa.concat_arrays([c.filter(keep), pa.array([cells[k] if cells else None for cells, _ in found], pa.string())]).take(order) for k, c in enumerate(parsed)]
    reasons = pa.concat_arrays([pa.nulls(int(good.sum()), pa.string()), pa.array([why for _, why in found], pa.string())]).take(order)
    return [*out, reasons]


def parse_records(df: DataFrame, id_col: str, line_col: str, status_labels: Sequence[str], leaf: int = LEAF) -> DataFrame:
    """One row per record: id, the five cells as strings, and the reason why it cannot be loaded (NULL if it can).

    A NULL line has no cells and an empty one has a single cell: both are `column_count`. Repeated records stay
    repeated, further columns of df are left out, and an empty table gives an empty result. status_labels is the
    short list of allowed labels; case and amount of white space do not matter. Failing blocks are halved down to `leaf`
    records, which are then diagnosed one by one; the result does not depend on it.
    """
    statuses = frozenset({*NULL_MARKS, *(_collapsed(s) for s in status_labels)})
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{c} string" for c in CELLS) + ", reason string"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _cells_and_reasons(batch.column(1).cast(pa.string()), statuses, leaf)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, *CELLS, "reason"])

    return df.select(F.col(id_col), F.col(line_col).cast("string").alias("__line")).mapInArrow(blocks, schema)


def rejected(parsed: DataFrame, id_col: str) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select(id_col, "reason")


def loaded(parsed: DataFrame, id_col: str) -> DataFrame:
    """Typed rows of the records that can be loaded; null marks become NULL and section numbers integers."""

    def cell(name: str):
        flat = F.trim(F.regexp_replace(F.col(name), r"(?U)\s+", " "))
        return F.when(~F.lower(flat).isin(*NULL_MARKS), flat)

    section = F.regexp_replace(cell("bns_section"), r"\s+", "")
    return parsed.where(F.col("reason").isNull()).select(
        id_col,
        section.alias("bns"),
        F.nullif(F.regexp_extract(section, r"^([0-9]+)", 1), F.lit("")).cast("int").alias("bns_section"),
        *(cell(c).alias(c) for c in CELLS[1:]),
    )
