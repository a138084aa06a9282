import pytest

from statuteloom.operators import packed_values as p

AUTO = p.automaton(["498A", "376", "302", "34", "120B", "30AB"])


@pytest.mark.parametrize(
    ("field", "want"),
    [
        ("299 & 300", ["299", "300"]), ("498-A", ["498A"]), ("120 B, 34", ["120B", "34"]), ("376(2)(a,b)", ["376(2)(a,b)"]), ("376 (2) (a, b); 302", ["376(2)(a,b)", "302"]),
        ("Sections 302, 34 and 498a", ["302", "34", "498A"]), ('["30-AB", "299(1)"]', ["30AB", "299(1)"]), ("302 (see note 20)", ["302"]), ("p. 44: 302 and 34", ["302", "34"]), ("302 - 15 copies", ["302"]),
        ("302 w.e.f. 1.7.2024", ["302"]), ("302 (old no. as on 1/7/2024)", ["302"]), ("65/9/25", ["65", "9", "25"]), ("98-ab/103", ["98AB", "103"]), ("302 IPC 1860", ["302"]), ("u/s 302 r/w 34", ["302", "34"]),
        ("302 (fine up to Rs 1,154)", ["302"]), ("34,34", ["34", "34"]), ("0, 000", []), ("none", []), ("(para 9 at p. 3) 34", ["34"]), ("12 - s. 13", ["12", "13"]), ("302 to 304", ["302", "304"]), ("５", []),
    ],
)
def test_cover(field, want):
    assert p.cover(field, AUTO) == want


def test_rows_arrays_nulls_and_long_fields(spark):
    rows = [(1, "302, 34"), (2, None), (3, ""), (4, "302"), (1, "302, 34"), (5, "34, " * 20_000)]
    df = spark.createDataFrame([(i, f, "z") for i, f in rows], "row_id bigint, ipc_section string, pos string")
    known = [r[0] for r in p.dictionary((df, "ipc_section")).collect()]
    assert known == ["302"]
    got = p.split_packed(df, "row_id", "ipc_section", known)
    assert sorted((r.row_id, r.pos, r.ipc_ref) for r in got.where("packed and row_id < 5").collect()) == [(1, 1, "302"), (1, 1, "302"), (1, 2, "34"), (1, 2, "34")]
    assert got.where("row_id = 5").count() == 20_000 and got.where("row_id = 4 and packed").count() == 0
    arrays = spark.createDataFrame([(1, ["302", None, "34 & 498-A"]), (2, None), (3, []), (4, ["302", "34"])], "ordinal bigint, ipc array<string>")
    out = p.split_packed(arrays, "ordinal", "ipc", known)
    assert [(r.pos, r.ipc_ref) for r in out.where("packed").orderBy("pos").collect()] == [(1, "302"), (2, "34"), (3, "498A")]
    assert p.split_packed(df.limit(0), "row_id", "ipc_section", []).count() == 0


def test_dictionary_of_arrays(spark):
    df = spark.createDataFrame([(["498-a", "376 (2)", "299 & 300", "0034", "007", "12 - B(1)( a, b )", None],)], "ipc array<string>")
    assert sorted(r[0] for r in p.dictionary((df, "ipc")).collect()) == ["12B(1)(a,b)", "376(2)", "498A", "7"]


@pytest.mark.parametrize(
    ("field", "known", "with_it", "without"),
    [
        ("498 a, 34", ["498A"], ["498A", "34"], ["498", "34"]),  # a space inside a known value
        ("302 - B; 34", ["302"], ["302", "34"], ["302B", "34"]),  # no such value, and no value with that letter
        ("302 - B; 34", ["302", "34B"], ["302B", "34"], ["302B", "34"]),  # put together from known parts
        ("120 b(1) (a, b)/9", ["120B(1)(a,b)"], ["120B(1)(a,b)", "9"], ["120", "1", "9"]),  # delimiters inside a known value
        ("120 b and", ["120B"], ["120B"], ["120"]),
        ("1120B 120Ba", ["120B"], [], []),  # part of a longer number or word
    ],
)
def test_dictionary_decides(field, known, with_it, without):
    assert p.cover(field, p.automaton(known)) == with_it
    assert p.cover(field, p.automaton([])) == without


def test_remark_after_far_number():
    assert p.cover("302, 15" + " " * 40 + "copies", p.automaton(["302"])) == ["302"]
