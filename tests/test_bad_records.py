import math
import random

import pyarrow as pa
import pytest

from statuteloom.operators import bad_records as b

LABELS = ["Carried over", "Change", "Deleted", "New Section"]


def parse(spark, lines, **extra):
    rows = [(k, line, "x") for k, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "raw_id bigint, raw_line string, reason string")
    return {r.raw_id: r for r in b.parse_records(df, "raw_id", "raw_line", LABELS).collect()}


def test_reasons_in_order(spark):
    lines = [
        '1,"a ""b"" c",Change,302,t', "1,a,b", '1,a "b",Change,302,t', '1, "a",Change,302,t', '1,"a" ,Change,302,t', '0,"a,Change', "359,a,Change,1,t", "1A,a,Change,1,t", "1 ( 2 ) (a),x,change ,,",
        ",,,,", " ,,,,", '"",,,,', "١,a,Change,1,t", "5,a,Chan ge,1,t", "5,a,NEW  section,1,t", "", None, "x,y,z,1", '5,"line\nbreak",nan,1,t', "5,line\nbreak,-,1,t", "5,a,Changed,1,t",
    ]
    want = [None, "column_count", "quoting", "quoting", "quoting", "quoting", "bns_section", "bns_section", None, None, None, None, "bns_section", "status", None, "column_count", "column_count", "column_count", None, None, "status"]
    got = parse(spark, lines)
    assert [got[k].reason for k in range(len(lines))] == want
    assert got[0].bns_title == 'a "b" c' and got[18].bns_title == "line\nbreak" and got[2].bns_title is None


def test_bisection_equals_strict_parse(spark):
    rng = random.Random(3)
    parts = ["1", '"', ",", "a", "\n", '""', "Change", " ", "302"]
    lines = ["7(1),Title,Change,302,Title"] * 700 + ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(700)] + ['"8","T, u","",,""'] * 700
    rng.shuffle(lines)
    got = parse(spark, lines)
    statuses = frozenset({*b.NULL_MARKS, *(" ".join(s.lower().split()) for s in LABELS)})
    for k, line in enumerate(lines):
        cells, why = b.diagnose(line, statuses)
        assert got[k].reason == why
        assert [got[k][c] for c in b.CELLS] == (cells or [None] * 5)


def test_typed_rows_empty_table_and_repeats(spark):
    df = spark.createDataFrame([(1, "12 ( 3 ),T,-, 299 ,none"), (1, "12 ( 3 ),T,-, 299 ,none"), (2, ",,,,")], "raw_id bigint, raw_line string")
    rows = b.loaded(b.parse_records(df, "raw_id", "raw_line", LABELS), "raw_id").orderBy("raw_id").collect()
    assert [tuple(r) for r in rows] == [(1, "12(3)", 12, "T", None, "299", None)] * 2 + [(2, None, None, None, None, None, None)]
    assert b.rejected(b.parse_records(df.limit(0), "raw_id", "raw_line", LABELS), "raw_id").count() == 0
    assert b.parse_records(df, "raw_id", "raw_line", []).where("reason = 'status'").count() == 0


def test_long_cell(spark):
    long = "x" * 300_000
    got = parse(spark, [f'1,"{long}",Change,1,t', f'1,"{long},Change,1,t'])
    assert got[0].bns_title == long and got[1].reason == "quoting"


def test_bulk_parse_calls(monkeypatch):
    """Blocks are parsed first and only failing ones are halved: about 2 b log2(n / b) calls for b bad records, one for none."""
    rng, calls, size = random.Random(5), [], 4096
    parse_block = b._Block.parse
    monkeypatch.setattr(b._Block, "parse", lambda self, low, high: calls.append(high - low) or parse_block(self, low, high))
    strict = []
    diagnose = b.diagnose
    monkeypatch.setattr(b, "diagnose", lambda line, statuses: strict.append(line) or diagnose(line, statuses))
    statuses = frozenset({*b.NULL_MARKS, "change"})
    for bad in (0, 1, 20):
        lines = ['7(1),"Title, long",Change,302,Title'] * size
        for k in rng.sample(range(size), bad):
            lines[k] = rng.choice(["1,2,3", '1,"a"b,Change,2,t', '1,a"b,Change,2,t', '1,"a,Change,2,t'])
        calls.clear(), strict.clear()
        *_, reasons = b._cells_and_reasons(pa.array(lines), statuses, 1)
        assert reasons.null_count == size - bad and len(strict) == bad and calls[0] == size
        assert len(calls) <= 1 + 2 * bad * (math.log2(size / max(bad, 1)) + 2)


@pytest.mark.parametrize("leaf", [1, 3, 500])
def test_any_leaf(leaf):
    rng = random.Random(leaf)
    parts = ["1", '"', ",", "a", "\n", "\r", '""', "Change", " ", "é", "\u00a0", "(2)", "358", "359"]
    lines = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(800)] + ["358 (a),,,,", None, ',"x",CHANGE\u00a0 ,,""']
    rng.shuffle(lines)
    statuses = frozenset({*b.NULL_MARKS, "change"})
    *cells, reasons = (c.to_pylist() for c in b._cells_and_reasons(pa.array(lines), statuses, leaf))
    for k, line in enumerate(lines):
        want, why = b.diagnose(line, statuses)
        assert reasons[k] == why and [c[k] for c in cells] == (want or [None] * 5)


def test_label_list_is_counted(spark):
    from statuteloom.session import short_list

    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "label string")
    assert short_list(df, "label", 2) == ["a", "b"]
    with pytest.raises(ValueError, match="more than 1"):
        short_list(df, "label", 1)
