"""Encoding of whole texts with a public byte-level BPE vocabulary.

Merging works on a hierarchical-bitmap rank queue: every merge rank has a bucket of linked-list positions, a two-level
bitmap marks the ranks with a non-empty bucket, find-first-set takes the lowest, and positions whose pair has changed
since are skipped when they surface. A pre-token of n bytes costs O(n) queue steps, so a run of a million letters
without a space is no special case. The encoding is one narrow Arrow stage over the scan.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the published pattern that splits text before the merges of the rank files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORD_BITS = 256
#: Rows whose ids are held at once.
ROWS = 512


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class RankQueue:
    """Positions by merge rank, lowest rank first and leftmost position first."""

    def __init__(self) -> None:
        self.words: dict[int, int] = {}
        self.summary = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            word, bit = divmod(rank, _WORD_BITS)
            self.words[word] = self.words.get(word, 0) | 1 << bit
            self.summary |= 1 << word
        else:
            bucket.append(position)

    def pop(self) -> tuple[int, list[int]] | None:
        """The lowest rank with its positions in ascending order, taken off the queue."""
        if not self.summary:
            return None
        word = (self.summary & -self.summary).bit_length() - 1
        bits = self.words[word]
        bit = (bits & -bits).bit_length() - 1
        bits &= bits - 1
        self.words[word] = bits
        if not bits:
            self.summary &= self.summary - 1
        rank = word * _WORD_BITS + bit
        return rank, sorted(self.buckets.pop(rank))


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    size = len(piece)
    end = list(range(1, size + 1))  # where the part that starts here ends; 0 once it is merged into its left neighbour
    left = list(range(-1, size - 1))
    queue = RankQueue()

    def rank_at(start: int) -> int | None:
        """Rank of the pair of the part at start and the one after it."""
        middle = end[start]
        return ranks.get(piece[start : end[middle]]) if middle < size else None

    for start in range(size - 1):
        if (rank := rank_at(start)) is not None:
            queue.push(rank, start)
    while (entry := queue.pop()) is not None:
        rank, positions = entry
        for start in positions:
            if not end[start] or rank_at(start) != rank:
                continue  # stale: one side has been merged since
            middle = end[start]
            end[start], end[middle] = end[middle], 0
            if end[start] < size:
                left[end[start]] = start
            for changed in (left[start], start):
                if changed >= 0 and (new := rank_at(changed)) is not None:
                    queue.push(new, changed)
    ids, start = [], 0
    while start < size:
        ids.append(ranks[piece[start : end[start]]])
        start = end[start]
    return ids


class Encoder:
    """Encodes texts; the ids of pre-tokens met before are kept, up to `keep` of them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, keep: int = 200_000) -> None:
        self.ranks, self.find, self.keep, self.known = ranks, regex.compile(pattern).findall, keep, {}

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        known, out = self.known, []
        for piece in self.find(text):
            ids = known.get(piece)
            if ids is None:
                ids = merge(piece.encode("utf-8", "surrogatepass"), self.ranks)
                if len(known) >= self.keep:
                    known.clear()
                if len(piece) <= 64:
                    known[piece] = ids
            out += ids
        return out


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = DEFAULT_FOLDER, vocabulary: str = VOCABULARY, count_only: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """(id, *carry, ids array<int>) or, with count_only, (id, *carry, tokens bigint) of every row.

    NULL and empty texts give an empty list (0 tokens); white space is text and is encoded as stored. Repeated rows stay
    repeated, further columns are left out unless carried. The vocabulary file is read on each executor from `folder`, or
    from TOKENIZER_FOLDER where that is set, so that it need not be shipped.
    """
    path = os.path.join(os.environ.get("TOKENIZER_FOLDER", folder), vocabulary)
    kept = df.select(id_col, *carry)
    names = [*kept.columns, "tokens" if count_only else "ids"]
    schema = T.StructType([*kept.schema.fields, T.StructField(names[-1], T.LongType() if count_only else T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_ranks(path))
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):  # the ids of a whole batch of long texts need not be held as objects
                batch = whole.slice(start, ROWS)
                ids = [encoder.encode(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
                result = pa.array(map(len, ids), pa.int64()) if count_only else pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], result], names=names)

    return df.select(id_col, *carry, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)
