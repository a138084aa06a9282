import random

import pytest
from pyspark.sql import functions as F

from statuteloom.llm import subjects as p

SENTENCES = {
    "sport": [f"The {a} {v} the {o}." for a in ("captain", "keeper", "batter") for v in ("bowled", "won") for o in ("match", "cup", "relay heat")],
    "finance": [f"The {a} {v} the {o}." for a in ("bank", "auditor", "broker") for v in ("inflated", "credited") for o in ("cheque", "loan", "ledger")],
    "traffic": [f"The {a} {v} the {o}." for a in ("truck", "driver", "bus") for v in ("hit", "grazed") for o in ("pillar", "red signal", "cyclist")],
}
REMARKS = ["Kindly acknowledge.", "File no. BNS/215/20.", "This note binds nobody (incl. copies).", "The drafters scored a point over their critics."]
SCHEMA = "doc_id bigint, text string"


def corpus(seed=1, size=600):
    rng = random.Random(seed)
    docs, truth, labels = [], {}, []
    for k in range(size):
        about = rng.sample(sorted(SENTENCES), rng.choice([1, 1, 2]))
        parts = [rng.choice(SENTENCES[s]) for s in about for _ in range(4)] + rng.choices(REMARKS, k=2)
        other = rng.choice([s for s in SENTENCES if s not in about])
        if rng.random() < 0.4:
            parts.append(rng.choice(SENTENCES[other]))  # in passing
        rng.shuffle(parts)
        docs.append((k, "".join(x + rng.choice([" ", "\n", "\r\n", "  "]) for x in parts)))
        truth[k] = set(about)
        if rng.random() < 0.3:
            given = [rng.choice(sorted(SENTENCES)) if rng.random() < 0.05 else s for s in about]
            labels += [(k, s, f"a{j}") for s in given for j in range(rng.choice([1, 2]))]
    return docs, truth, labels


def test_sentences(spark):
    text = 'See File no. BNS/2. “Shall” means it. He said "so." Then 12 left… Next\r\nline one\n\n  Approx. 5 of them! (incl. copies) पुराना है। नया'
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, " \n"), (5, "12."), (6, "x" * 200_000)], SCHEMA)
    got = [r.sentence for r in p.sentences(df).where("doc_id = 1").collect()]
    assert got == ["see file no.bns/9.", "“shall” means it.", 'he said "so."', "then 9 left…", "next", "line one", "approx.9 of them!", "(incl.copies) पुराना है।", "नया"]
    assert {r.doc_id for r in p.sentences(df).select("doc_id").distinct().collect()} == {1, 6}


def test_held_out_accuracy(spark):
    docs, truth, labels = corpus()
    df = spark.createDataFrame(docs + [(9000, None), (9001, ""), (9002, "Kindly acknowledge. " * 3), (9003, docs[0][1])], SCHEMA).selectExpr("*", "'x' AS subject", "1 AS share")
    found = {}
    lab = spark.createDataFrame(labels + [(77777, "sport", "a"), (1, "unheard of", "a"), (2, None, "a")], "doc_id bigint, subject string, annotator string")
    listed = spark.createDataFrame([(s,) for s in SENTENCES], "subject string")
    for r in p.document_subjects(df, lab, listed).collect():
        assert r.share >= 0.2
        found.setdefault(r.doc_id, set()).add(r.subject)
    held = [k for k in truth if k not in {x[0] for x in labels}]
    hit = sum(len(found.get(k, set()) & truth[k]) for k in held)
    assert hit / sum(len(truth[k]) for k in held) > 0.97 and hit / sum(len(found.get(k, set())) for k in held) > 0.97
    assert found.get(9003) == found.get(0) and not {9000, 9001, 9002} & set(found)
    every = p.document_subjects(df, lab, listed)
    parts = p.composition(every)
    assert abs(parts.agg(F.sum("weight_share")).first()[0] - 1) < 1e-9


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "The bank won.")], SCHEMA)
    lab = spark.createDataFrame([(1, "sport", "a")], "doc_id bigint, subject string, annotator string")
    listed = spark.createDataFrame([("sport",), (None,)], "subject string")
    assert p.document_subjects(docs.limit(0), lab, listed).count() == 0 and p.document_subjects(docs, lab.limit(0), listed).count() == 0
    assert p.document_subjects(docs, lab, listed.limit(0)).count() == 0
    with pytest.raises(ValueError, match="subjects"):
        p.document_subjects(docs, lab, spark.range(300).select(F.col("id").cast("string").alias("subject")))


def test_links_are_verified_stars(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(12)]
    texts = sorted({" ".join(rng.sample(words, 7)) for _ in range(150)}) + ["one two three", "one two three four", "lone", "!"]
    df = spark.createDataFrame([(k, 1, t) for k, t in enumerate(texts)], "sid bigint, n bigint, sentence string")
    got = {(r.sid, r.hub): r.j for r in p.links(p.signatures(df, bands=8, rows=2), 0.4).collect()}
    sets = [set(t.split()) for t in texts]
    for (a, b), j in got.items():
        exact = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        assert exact >= 0.4 and abs(exact - j) < 1e-6
    hubs = {b for _, b in got}
    assert all((h, h) in got for h in hubs) and len(got) <= 8 * len(texts) + len(hubs)
    assert sum(any(a == k for a, _ in got) for k in range(150)) > 140 and not any(a == len(texts) - 2 for a, _ in got)
    assert p.links(p.signatures(df.limit(0)), 0.4).count() == 0


def test_links_carry_labels_to_unseen_sentences(spark):
    """Of sentences that no labelled document holds, only similar ones tell the subject."""
    docs = [(k, f"The captain bowled the ball past the keeper of team {chr(97 + k % 20)}{chr(97 + k // 20)}. ") for k in range(60)]
    docs += [(100 + k, f"The bank credited the loan to the ledger of client {chr(97 + k % 20)}{chr(97 + k // 20)}. ") for k in range(60)]
    labels = [(k, "sport", "a") for k in range(0, 20)] + [(100 + k, "finance", "a") for k in range(0, 20)]
    df, lab = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, subject string, annotator string")
    listed = spark.createDataFrame([("sport",), ("finance",)], "subject string")
    found = {(r.doc_id, r.subject) for r in p.document_subjects(df, lab, listed).collect()}
    assert found == {(k, "sport") for k in range(60)} | {(100 + k, "finance") for k in range(60)}
    alone = {r.doc_id for r in p.document_subjects(df, lab, listed, linked=False).collect()}
    assert alone == {k for k, _, _ in labels}
