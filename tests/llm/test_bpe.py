import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statuteloom.llm import bpe

PATH = os.path.join(os.environ.get("TOKENIZER_FOLDER", bpe.DEFAULT_FOLDER), bpe.VOCABULARY)
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary here")


def plain_merge(piece, ranks):
    """The definition: merge the lowest-ranked pair, leftmost first, until none is left."""
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while True:
        options = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not options:
            return [ranks[p] for p in parts]
        _, k = min(options)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aabbcdeinrst 's123éन्ि​😀\n", max_size=60))
def test_against_the_definition(text):
    ranks = bpe.load_ranks(PATH)
    encoder = bpe.Encoder(ranks)
    ids = encoder.encode(text)
    assert ids == [i for piece in encoder.find(text) for i in plain_merge(piece.encode(), ranks)]
    back = {v: k for k, v in ranks.items()}
    assert b"".join(back[i] for i in ids).decode() == text


def test_against_the_public_library_and_long_tokens():
    import tiktoken

    ranks = bpe.load_ranks(PATH)
    theirs = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    for text in ["a" * 5000, "".join(rng.choices("abcdefgh", k=20_000)), "  \n\n  x", "don't  stop<|endoftext|>", " " * 999, "ﬁ​é"]:
        assert bpe.Encoder(ranks, keep=3).encode(text) == theirs.encode_ordinary(text)


def test_queue_takes_lowest_rank_first():
    queue = bpe.RankQueue()
    for rank, position in ((50_000, 1), (3, 9), (3, 2), (700, 4)):
        queue.push(rank, position)
    assert [queue.pop() for _ in range(4)] == [(3, [2, 9]), (700, [4]), (50_000, [1]), None]
    queue.push(0, 7)
    assert queue.pop() == (0, [7])


def test_rows(spark):
    df = spark.createDataFrame([(1, "Theft"), (2, ""), (3, None), (1, "Theft"), (4, " ")], "doc_id bigint, text string").selectExpr("*", "'x' AS ids")
    got = sorted((r.doc_id, list(r.ids)) for r in bpe.encode_texts(df).collect())
    assert got[2:4] == [(2, []), (3, [])] and got[0] == got[1] and len(got[4][1]) == 1
    assert [tuple(r) for r in bpe.encode_texts(df.where("doc_id = 3"), count_only=True, carry=["ids"]).collect()] == [(3, "x", 0)]
    assert bpe.encode_texts(df.limit(0)).count() == 0
