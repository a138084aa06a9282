import random

import pytest

from statuteloom.llm import canonical as c

LABELS = {
    "carried_over": "Carried over", "changed": "Change", "deleted": "Deleted", "new_section": "New Section", "new_subsection": "New Sub-Section", "merged": "Merged", "split": "Split",
    "renumbered": "Renumbered", "moved": "Moved",
}
TERMS = c.terms_of(LABELS)
INDEX = c.Dictionary(TERMS, {})


@pytest.mark.parametrize(
    ("value", "code"),
    [
        ("CHANGED", "changed"), ("no change", "carried_over"), ("Unchanged", "carried_over"), ("chnage", "changed"), ("deelted!!", "deleted"), ("[Altered]", "changed"), ("status: chgd.", "changed"),
        ("marked as moved to other chapter", "moved"), ("prob. reworded - verified", "changed"), ("fine enhanced (see note)", "changed"), ("altered w.e.f. 1 July", "changed"), ("c/o", "carried_over"),
        ("new provision (whole section)", "new_section"), ("sub-sec. inserted", "new_subsection"), ("new s/section", "new_subsection"), ("New-Section", "new_section"), ("परिवर्तित", "changed"), ("हटाया गया", "deleted"),
        ("amalmgated", "merged"), ("struc koff", "deleted"), ("x", "unmatched"), ("ok", "unmatched"), ("see note 4", "unmatched"), ("Lakshpuri", "unmatched"), ("302", "unmatched"), ("?", "unmatched"), ("pending", "unmatched"),
        ("  ", "unmatched"), ("theft", "unmatched"),
    ],
)
def test_meant(value, code):
    assert INDEX.meant(value) == code


def damerau(a, b):
    """Unrestricted Damerau-Levenshtein distance by its textbook recurrence."""
    seen, far = {}, len(a) + len(b)
    d = {(-1, -1): far}
    for i in range(len(a) + 1):
        d[i, -1], d[i, 0] = far, i
    for j in range(len(b) + 1):
        d[-1, j], d[0, j] = far, j
    for i in range(1, len(a) + 1):
        last = 0
        for j in range(1, len(b) + 1):
            k, m = seen.get(b[j - 1], 0), last
            same = a[i - 1] == b[j - 1]
            if same:
                last = j
            d[i, j] = min(d[i - 1, j - 1] + (not same), d[i, j - 1] + 1, d[i - 1, j] + 1, d[k - 1, m - 1] + (i - k - 1) + 1 + (j - m - 1))
        seen[a[i - 1]] = i
    return d[len(a), len(b)]


def test_distance_and_candidates_against_brute_force():
    rng = random.Random(9)
    flat = c.Dictionary(TERMS, {})
    for _ in range(600):
        term = rng.choice(sorted(TERMS))
        chars = list(term)
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(chars)) if chars else 0
            move = rng.randrange(4)
            if move == 0 and chars:
                del chars[k]
            elif move == 1:
                chars.insert(k, rng.choice("aeinst "))
            elif move == 2 and len(chars) > k + 1:
                chars[k], chars[k + 1] = chars[k + 1], chars[k]
            elif chars:
                chars[k] = rng.choice("aeinst")
        form = "".join(chars)
        for other in rng.sample(sorted(TERMS), 5) + [term]:
            assert (c.distance(form, other, 2) is not None) == (damerau(form, other) <= 2)
        near = {t for t in TERMS if damerau(form, t) <= c.bound(len(t))}
        hit = flat.lookup(form)
        assert (hit is None) == (not near) and (hit is None or hit[2] in near)


def test_frequency_breaks_ties():
    terms = {"moved": "moved", "roved": "other"}
    assert c.Dictionary(terms, {"roved": 5}).meant("xoved") == "other" and c.Dictionary(terms, {"moved": 5}).meant("xoved") == "moved"


def test_rows(spark):
    ref = spark.createDataFrame(list(LABELS.items()) + [(None, "x"), ("y", None)], "status_code string, label string")
    df = spark.createDataFrame([(1, "Change"), (2, " Change "), (3, "change"), (4, None), (5, "n/a"), (6, "—"), (7, "odd"), (8, "Odd "), (9, "New  Section"), (3, "change"), (10, "y" * 100_000)], "row_id bigint, status string").selectExpr("*", "1 AS code", "2 AS value")
    mapped = c.map_to_list(df, "row_id", "status", ref)
    assert sorted((r.row_id, r.code) for r in mapped.collect()) == [(3, "changed"), (3, "changed"), (7, "unmatched"), (8, "unmatched"), (9, "new_section"), (10, "unmatched")]
    assert ("odd", 2) in {(r.value, r.n) for r in c.misses(mapped).collect()}
    assert c.map_to_list(df.limit(0), "row_id", "status", ref).count() == 0
    assert {r.code for r in c.map_to_list(df, "row_id", "status", ref.limit(0)).collect()} == {"unmatched"}
    with pytest.raises(ValueError, match="entries"):
        c.map_to_list(df, "row_id", "status", ref, max_entries=2)


def test_long_labels_and_values():
    label = "the provision has been carried over into the new code without any change of wording or number"
    index = c.Dictionary(c.terms_of({"long": label, "x": "renumbered"}, {}), {})
    assert len(label) > 90 and index.meant(label.upper()) == "long" == index.meant("  " + label.replace("without", "witout") + "!")
    for k in range(0, len(label), 7):
        assert index.meant(label[:k] + "q" + label[k:]) == "long"
        assert index.meant(label[:k] + label[k + 2 :]) in ("long", "unmatched") and index.lookup(c.key(label[:k] + label[k + 1 :]))
    assert index.meant("x" * 5_000) == "unmatched" and index.meant(label + " and more") == "unmatched"
