import random

import pytest

from statuteloom.llm import scanned as s

WORDS = "whoever shall be punished with imprisonment for term of up to years and fine or both any person who dishonestly takes property pre-dawn street-vendor orphan's judgment magistrate officer confined compensation rupees section office the in during service machinery library protégé first occasion scale exceptions illustration".split()
COUNTS = {w: 1000 - k for k, w in enumerate(WORDS)} | {c: 500 for c in ("a",)}
FIX = s.Repairer(COUNTS)


#: Running headers as they recur in an edition, figures and the title of the chapter masked.
HEADERS = ["# the code gazette [part ii", "part ii] the record #", "the code gazette, town extraordinary", "\ue000 #", "printed at the town press, register no. #/#", "town, monday july #, # no. #", "sec. #] \ue000 [bsa", "bnss — town edition — \ue000", "| the record, town |"]
SETTING = s.Furniture(HEADERS, ["of attempts", "of abetment", "of public tranquillity"])


def pieces(text, title=False):
    return FIX.repair(text, title, SETTING)


@pytest.mark.parametrize(
    ("word", "meant"),
    [("rupce5", "rupees"), ("magi5fratc", "magistrate"), ("offi(er", "officer"), ("cornpensation", "compensation"), ("conf!ned", "confined"), ("judgmcnf", "judgment"), ("pcrson", "person"), ("scrvicc", "service"), ("machmery", "machinery"), ("propcrfy", "property"), ("pay", None), ("officcr", "officer"), ("ycars", "years"), ("0ff1ce", "office"), ("im9risonment", None)],
)
def test_misread_words(word, meant):
    text, found = pieces(f"any person {word} shall\nbe punished.")
    assert found == ([("misread", meant)] if meant else [])
    assert (meant or word) in text


def test_hyphens_of_all_kinds():
    for mark in ("-", "- ", "¬", "‐", "–", "­"):
        text, found = pieces(f"shall be impris{mark}\nonment for a term.")
        assert found == [("hyphen", "imprisonment")] and text == "shall be imprisonment for a term."
    assert pieces("in the pre-\ndawn")[1] == [("hyphen", "pre-dawn")]
    assert pieces("shall be compen-\n[17]\n\n|  The Record, Town  |\nsafion")[1] == [("header", "|  The Record, Town  |"), ("hyphen", "compensation"), ("misread", "compensation"), ("page_number", "[17]")]
    assert pieces("the street-vendor\nand any person") == ("the street-vendor and any person", [])


@pytest.mark.parametrize("line", ["12   THE CODE GAZETTE   [PART II", "PART II]   THE RECORD   9", "THE CODE GAZETTE, TOWN EXTRAORDINARY", "Of attempts    17", "Printed at the Town Press, Register No. 9/2023", "TOWN, MONDAY   JULY 8, 2024   No. 91", "Sec. 147] Of attempts [BSA", "BNSS — Town edition — OF ABETMENT", "|  The Record, Town  |"])
def test_headers(line):
    text, found = pieces(f"any person who takes\n  {line}\nproperty shall be fine.")
    assert found == [("header", line)] and text == "any person who takes property shall be fine."


@pytest.mark.parametrize("line", ["12   THE C0DE GAZETTE   [PAPT II", "Of public tranqui11ity    17", "Pr!nted at the Tovvn Press, Register N0. 9/2O23", "BN5S — Town ed!tion — of abetment"])
def test_misread_headers(line):
    assert pieces(f"any person who takes\n{line}\nproperty shall be fine.")[1] == [("header", line)]


def test_no_line_is_a_header_by_its_shape():
    line = "12   THE OTHER GAZETTE   [PART II"
    assert ("header", line) not in FIX.repair(f"any person who takes\n{line}\nproperty.")[1]


@pytest.mark.parametrize("line", ["17", "[17]", "- 17 -", "— 17 —", "~ 9 ~", "•  109", "p. 12", "Page 3 of 208", "PAGE 105/218", "Page No. 98", "12/204", "(xliv)", "lxx", "1S4", "10B"])
def test_page_numbers(line):
    text, found = pieces(f"any person who takes\n{line}\nproperty shall be fine.")
    assert found == [("page_number", line)] and "takes property" in text


def test_lines_that_are_no_noise():
    for line in ("SCALE OF OFFICE", "EXCEPTIONS", "17.", "5,000 rupees.", "(2) any person", "First occasion: 5,000 rupees"):
        assert not [p for p in pieces(f"any person.\n{line}\nwho takes property.")[1] if p[0] in ("header", "page_number")]


def test_numbers_look_alikes_and_titles():
    assert pieces("for 5OO rupees and l2 years.\nand 12,5OO or 500.")[1] == [("misread", "12"), ("misread", "12,500"), ("misread", "500")]
    assert pieces("ａｎｙ реrson who\ntakes prо­perty")[1] == []
    assert pieces("Any pers-\non who takes pr0perty\n56", True) == ("Any person who takes property", [("hyphen", "person"), ("misread", "property"), ("page_number", "56")])
    assert pieces("12", True) == ("12", [])


@pytest.mark.parametrize(
    ("text", "want", "found"),
    [
        ("the pro perty shall", "the property shall", [("spacing", "property")]),
        ("the impri sonment forterm of years", "the imprisonment for term of years", [("spacing", "imprisonment")]),
        ("shall be impris\nonment for term", "shall be imprisonment for term", [("hyphen", "imprisonment")]),
        ("any per son, who", "any person, who", [("spacing", "person")]),
        ("the magis tratc of", "the magistrate of", [("misread", "magistrate")]),
        ("any Zorblax per son takes", "any Zorblax person takes", [("spacing", "person")]),
        ("any per, son takes", "any per, son takes", []),
    ],
)
def test_spaces_and_line_ends_are_symbols_of_the_stream(text, want, found):
    assert pieces(text) == (want, found)


def test_two_words_of_the_vocabulary_that_are_one():
    counts = COUNTS | {"pro": 2, "vision": 2, "provision": 400, "this": 900, "may": 900, "be": 950, "maybe": 1}
    fix = s.Repairer(counts)
    assert fix.repair("the pro vision of fine") == ("the provision of fine", [("spacing", "provision")])
    assert fix.repair("the provi sion ofthis office") == ("the provision of this office", [("spacing", "provision")])
    assert fix.repair("any person may be fine") == ("any person may be fine", [])


def test_dear_paths_are_not_dropped():
    fix = s.Repairer(COUNTS)
    run = "dishonestlypropertyimprisonmentmagistratecompensationmachineryexceptions"
    assert " ".join(w[2] for w in fix.lattice.decode(run)[1]) == "dishonestly property imprisonment magistrate compensation machinery exceptions"


def test_merged_and_split_words():
    assert FIX.lattice.decode("anyperson")[1][0][2] == "any" and [w[2] for w in FIX.lattice.decode("per son")[1]] == ["person"]


def test_paragraphs():
    text, _ = pieces("(1) any person who takes property\nshall be fine.\n\n(2) whoever shall be\npunished for years.\nEXCEPTIONS\n(3) the officer.")
    assert text == "(1) any person who takes property shall be fine.\n(2) whoever shall be punished for years.\nEXCEPTIONS\n(3) the officer."


def test_edges():
    assert pieces(None) == (None, []) and pieces("") == ("", []) and pieces(" \n ") == ("", [])
    long = "any person who takes property " * 20
    assert pieces(long + "rupce5")[1] == [("misread", "rupees")]
    mixed = "any person who takes\nPage 12\npro-\nperty or scrvice.\n" + long + "\n| The Record, Town |\nany officer"
    text, found = pieces(mixed)  # a long line does not keep the others from being repaired
    assert found == [("header", "| The Record, Town |"), ("hyphen", "property"), ("misread", "service"), ("page_number", "Page 12")]
    assert text.split("\n") == ["any person who takes property or service.", long.strip(), "any officer"]
    big = "\n".join(["any pcrson who takes"] * 20_000)
    assert pieces(big)[1] == [("misread", "person")]


def test_planted_noise_is_found_and_repaired():
    rng = random.Random(4)
    spoil = [("e", "c"), ("o", "0"), ("i", "!"), ("t", "f"), ("s", "5"), ("n", "u"), ("m", "rn"), ("l", "|")]
    good = found = wrong = 0
    for _ in range(300):
        words = rng.choices([w for w in WORDS if len(w) > 5 and "-" not in w], k=12)
        k = rng.randrange(12)
        pairs = [p for p in spoil if p[0] in words[k]]
        bad = list(words)
        if pairs:
            old, new = rng.choice(pairs)
            bad[k] = words[k].replace(old, new, 1)
        got = pieces("\n".join(" ".join(bad[j : j + 4]) for j in range(0, 12, 4)))[1]
        want = {("misread", words[k])} if pairs else set()
        good += len(want)
        found += len(want & set(got))
        wrong += len(set(got) - want)
    assert found / good > 0.97 and wrong / good < 0.03


def test_rows(spark):
    df = spark.createDataFrame([(1, "any person who shall be fine " * 5, "Any person", "E1", None), (2, "any pcrson\nwho", None, "E1", None), (3, None, "", None, None), (2, "any pcrson\nwho", None, "E1", None)], "sec_id bigint, text string, title string, edition string, chapter_title string").selectExpr("*", "1 AS pieces", "2 AS field", "3 AS headers")
    seen = s.observed(df)
    counts = s.collect_vocabulary(s.vocabulary(seen))
    assert counts["person"] == 6
    rows = s.repair_sections(df, counts)
    assert rows.count() == 8 and sorted((r.sec_id, r.field, r.kind, r.piece) for r in s.noise(rows).collect()) == [(2, "text", "misread", "person")] * 2
    assert s.repair_corpus(df).count() == 8
    empty = df.limit(0)
    assert s.repair_corpus(empty).count() == 0 and s.collect_vocabulary(s.vocabulary(s.observed(empty))) == {}
    assert s.repair_sections(df, {}).count() == 8
    with pytest.raises(ValueError, match="min_count"):
        s.collect_vocabulary(s.vocabulary(seen), max_words=2)


def test_headers_are_found_by_recurrence_within_an_edition(spark):
    whole = "Any person who takes property shall be punished with imprisonment for a term of years. " * 3
    page = "any person who takes property\n{n}   OFFICIAL RECORD   {c}\nshall be punished with\nimprisonment for a term of years"
    rows = [(k, whole, None, e, "Of Fines") for k, e in enumerate(["A", "B", None])]
    rows += [(10 + k, page.format(n=k, c="Of Fines"), None, "A", "Of Fines" if k else None) for k in range(4)]
    rows += [(20 + k, page.format(n=k, c="Of Fines").replace("OFFICIAL", "OTHER"), None, "B", "Of Fines") for k in range(2)]
    df = spark.createDataFrame(rows, "sec_id bigint, text string, title string, edition string, chapter_title string")
    found = {r.edition: r.headers for r in s.running_headers(s.observed(df), df).collect()}
    assert found["A"] == found["B"] == "# official record \ue000"  # it recurs in A and in the corpus; the other one recurs too rarely
    pieces = {(r.sec_id, r.piece) for r in s.noise(s.repair_corpus(df)).where("kind = 'header'").collect()}
    assert pieces == {(10 + k, f"{k}   OFFICIAL RECORD   Of Fines") for k in range(4)}
