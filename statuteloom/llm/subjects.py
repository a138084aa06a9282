"""Subject areas of documents by label propagation over a graph of verified similarity.

Documents are tied to the sentences they hold (equal sentences, digits masked, are one node), and sentences to similar ones:
minhash bands propose, and the exact Jaccard similarity of the word sets confirms each link. A band's bucket proposes links to
its least member only, a star instead of all pairs, so the graph grows with the sentences and not with their pairs. Labels flow
from trusted seed documents to sentences, along the links and back to all documents in iterative DataFrame joins, until hardly
any sentence is newly read; seeds stay clamped, and a document keeps every subject that a fixed share of its sentences is about.

Subject scores are one column per subject of the (checked, short) subject list, so a message is one row a node.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuteloom.session import keep, short_list, small_side, stable_cut

#: Abbreviations whose full stop ends no sentence.
ABBREVIATIONS = ("no", "nos", "incl", "sec", "ss", "art", "cl", "para", "vol", "ch", "fig", "ref", "dr", "mr", "mrs", "ms", "st", "vs", "rs", "approx", "etc")
MAX_SUBJECTS = 200
_ABBREVIATED = r"(?i)\.(?<=(?<![\p{L}\p{N}])(?:" + "|".join(ABBREVIATIONS) + r")\.)[ \t\u00a0]+"  # the stop comes first: it is rare
_END = r"([.?!\u0964\u2026][\"\u201d\u2019)]?)[ \t\u00a0]+(?=[^\p{Ll}\s])"
_BLANKS = r"[ \t\u000b\f\u001c-\u001f\u0085\u00a0\u1680\u2000-\u200b\u202f\u205f\u3000]+"
_WORD = re.compile(r"\w+(?:['’-]\w+)*")
#: Links to one sentence lie in so many partitions, so that a sentence to which very many are similar is no bottleneck.
_SALTS = 32
_NOTHING = -1


def sentence_list(text: Column) -> Column:
    """array<string>: sentences of a text, collapsed, lower-case, digits masked; lines end sentences too. NULL gives NULL."""
    marked = F.regexp_replace(F.regexp_replace(text, _ABBREVIATED, "."), _END, "$1\n")
    flat = F.regexp_replace(F.regexp_replace(marked, r"[\u2028\u2029\r]", "\n"), _BLANKS, " ")
    masked = F.lower(F.regexp_replace(flat, r"\p{Nd}+", "9"))
    return F.filter(F.split(F.trim(masked), r" ?(?:\n ?)+"), lambda s: s.rlike(r"\p{L}"))


def sentences(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, sentence): the sentences of each text, a row each. NULL and blank texts give none."""
    return docs.select(F.col(id_col), F.explode_outer(sentence_list(F.col(text))).alias("sentence")).where("sentence IS NOT NULL")


def signatures(texts: DataFrame, bands: int = 6, rows: int = 3) -> DataFrame:
    """(sid, n, words array<int>, keys array<bigint>) of (sid, sentence, n): hashes of the distinct words, and one key a minhash band."""
    rng = np.random.default_rng(7)
    factors, shifts = (rng.integers(1, 2**63, bands * rows, dtype="uint64") | np.uint64(1), rng.integers(0, 2**63, bands * rows, dtype="uint64"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = lru_cache(maxsize=500_000)(lambda w: zlib.crc32(w.encode()))
        for batch in batches:
            sets = [sorted({code(w) for w in _WORD.findall(s)}) or [0] for s in batch.column(2).to_pylist()]
            sizes = np.array([len(x) for x in sets], dtype="int64")
            flat = np.array([w for x in sets for w in x], dtype="uint32")
            starts = np.concatenate([[0], np.cumsum(sizes)]).astype("int32")
            keys = np.zeros((bands, len(sets)), dtype="uint64")
            for k in range(bands * rows if len(sets) else 0):
                mixed = flat.astype("uint64") * factors[k] + shifts[k]
                mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                keys[k // rows] = (keys[k // rows] * np.uint64(0x9E3779B97F4A7C15)) ^ np.minimum.reduceat(mixed ^ (mixed >> np.uint64(29)), starts[:-1])
            keys ^= np.arange(bands, dtype="uint64")[:, None]  # bands never share a bucket
            words = pa.ListArray.from_arrays(pa.array(starts), pa.array(flat.view("int32")))
            bounds = pa.array(np.arange(len(sets) + 1, dtype="int32") * bands)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), words, pa.ListArray.from_arrays(bounds, pa.array(keys.T.reshape(-1).view("int64")))], names=["sid", "n", "words", "keys"])

    return texts.select("sid", "n", "sentence").mapInArrow(sign, "sid bigint, n bigint, words array<int>, keys array<bigint>")


def links(signed: DataFrame, least: float = 0.4) -> DataFrame:
    """(sid, hub, j): sentences with the sentences they are linked to, by a Jaccard similarity of at least `least` of their words.

    The least sentence of a bucket is the hub of all others in it. Each hub is linked to itself, too.
    """
    keyed = signed.select("sid", F.explode("keys").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("sid").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "hub")
    proposed = keyed.join(hubs, "key").where("sid <> hub").select("sid", "hub").distinct()
    words = signed.select("sid", "words")
    both = proposed.join(words, "sid").join(words.select(F.col("sid").alias("hub"), F.col("words").alias("others")), "hub")
    shared = F.size(F.array_intersect("words", "others"))
    confirmed = both.select("sid", "hub", (shared / (F.size("words") + F.size("others") - shared)).cast("float").alias("j")).where(F.col("j") >= least)
    confirmed = keep(confirmed)
    return confirmed.unionAll(confirmed.select("hub").distinct().select(F.col("hub").alias("sid"), "hub", F.lit(1.0).cast("float").alias("j")))


class Propagation:
    """Messages between documents, sentences and the hubs of their links for a list of subjects.

    smooth: how many documents the similar sentences, or the whole corpus, count for beside those that hold a sentence;
    certain: the share of the evidence at which a sentence is read as being about a subject; heard: the number of documents from
    which on a sentence without such a share is read as being about nothing.
    """

    def __init__(self, subjects: list[str], smooth: float = 4.0, certain: float = 0.4, heard: float = 10.0) -> None:
        self.subjects, self.smooth, self.certain, self.heard = subjects, smooth, certain, heard
        self.w = [f"w{k}" for k in range(len(subjects))]
        self.v = [f"v{k}" for k in range(len(subjects))]

    def _sums(self, by: Column) -> list[Column]:
        return [F.sum(by * F.col(n)).alias(n) for n in self.w]

    def seeds(self, labels: DataFrame, id_col: str) -> DataFrame:
        """(id, w..): the subjects given to a document, each once however often given, with weights that sum to 1.

        Where annotators disagree, subjects that only one of three or more gave are not trusted.
        """
        votes = labels.where(F.col("subject").isin(self.subjects)).groupBy(id_col, "subject").agg(F.countDistinct("annotator").alias("votes"))
        wide = votes.groupBy(id_col).agg(F.max("votes").alias("most"), *[F.max(F.when(F.col("subject") == s, F.col("votes")).otherwise(0)).alias(n) for s, n in zip(self.subjects, self.w)])
        given = [F.when((F.col(n) > 0) & ((F.col("most") < 3) | (F.col(n) > 1)), 1.0).otherwise(0.0) for n in self.w]
        flags = wide.select(id_col, *[g.alias(n) for g, n in zip(given, self.w)])
        return self._normal(flags, id_col)

    def _normal(self, flags: DataFrame, id_col: str) -> DataFrame:
        whole = flags.withColumn("whole", reduce(lambda a, b: a + b, [F.col(n) for n in self.w])).where("whole > 0")
        return whole.select(id_col, *[(F.col(n) / F.col("whole")).alias(n) for n in self.w])

    def to_sentences(self, held: DataFrame, known: DataFrame, id_col: str) -> DataFrame:
        """(sid, w..): sums of the weights of the known documents that hold a sentence; partial sums come first."""
        return held.join(known, id_col).withColumn("sid", F.explode(F.array_distinct("sids"))).groupBy("sid").agg(*self._sums(F.lit(1.0)))

    def base(self, heard: DataFrame) -> list[float]:
        """The share of each subject among all that was heard."""
        row = heard.agg(*self._sums(F.lit(1.0))).first()
        total = sum(row[n] or 0.0 for n in self.w) or 1.0
        return [(row[n] or 0.0) / total + 1e-4 for n in self.w]

    def _about(self, own: np.ndarray, prior: np.ndarray, cast: np.ndarray) -> np.ndarray:
        """Subject number of the largest share if it is certain, _NOTHING if much was heard without one, else NaN.

        own: what was heard, prior: shares to lean on, cast: whether these come from links. Without anything heard of its own a
        sentence is read by its links if at least half of them agree.
        """
        seen = own.sum(axis=1)
        post = (own + self.smooth * prior) / (seen + self.smooth)[:, None]
        sure = post.max(axis=1) >= np.where(seen > 0, self.certain, 0.5)
        return np.where(sure, post.argmax(axis=1), np.where((seen >= self.heard) | cast, float(_NOTHING), np.nan))

    def hubs_heard(self, by_sid: DataFrame, heard: DataFrame, base: list[float]) -> DataFrame:
        """(hub, first): what all sentences linked to a hub were heard to be about together; NULL if that is not clear."""
        sums = by_sid.join(heard, "sid").groupBy("hub").agg(*self._sums(F.col("j")))

        def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                own = batch[self.w].to_numpy(dtype="float64")
                yield pd.DataFrame({"hub": batch["hub"], "first": pd.array(self._about(own, np.tile(base, (len(own), 1)), np.zeros(len(own), dtype=bool)), dtype="Int32")})

        return sums.mapInPandas(judge, "hub bigint, first int")

    def hubs_read(self, by_sid: DataFrame, read: DataFrame) -> DataFrame:
        """(hub, next): what most of the sentences linked to a hub, by the weight of their links, are read to be about."""
        votes = by_sid.join(read, "sid").groupBy("hub", "about").agg(F.sum("j").alias("j"))
        whole = votes.groupBy("hub").agg(F.max(F.struct("j", "about")).alias("most"), F.sum("j").alias("all"))
        return whole.where(2 * F.col("most.j") >= F.col("all")).select("hub", F.col("most.about").alias("next"))

    def votes(self, by_hub: DataFrame, hubs: DataFrame, parts: int) -> DataFrame:
        """(sid, v.., nothing): the weights of the links of each sentence to hubs about each subject, and about nothing."""
        spread = hubs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        sent = by_hub.join(spread, ["hub", "salt"]).select("sid", "about", "j").repartition(parts, "sid")
        ballots = [F.sum(F.when(F.col("about") == k, F.col("j")).otherwise(0.0)).alias(n) for k, n in enumerate(self.v)]
        return sent.groupBy("sid").agg(*ballots, F.sum(F.when(F.col("about") == _NOTHING, F.col("j")).otherwise(0.0)).alias("nothing"))

    def read(self, heard: DataFrame, votes: DataFrame, base: list[float]) -> DataFrame:
        """(sid, about): each sentence that its own documents, or the hubs it is linked to, let be read."""
        both = heard.join(votes, "sid", "full").na.fill(0.0)

        def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                own, cast, nothing = (batch[n].to_numpy(dtype="float64") for n in (self.w, self.v, "nothing"))
                every = cast.sum(axis=1) + nothing
                prior = np.where((every > 0)[:, None], cast / np.maximum(every, 1e-12)[:, None], np.asarray(base)[None, :])
                about = self._about(own, prior, (every > 0) & (2 * nothing >= every))
                known = ~np.isnan(about)
                yield pd.DataFrame({"sid": batch["sid"][known], "about": about[known].astype("int32")})

        return both.mapInPandas(judge, "sid bigint, about int")

    def to_documents(self, held: DataFrame, rare: DataFrame, often: DataFrame, read: DataFrame, id_col: str, parts: int) -> DataFrame:
        """(id, total, w..): sentences of each document, and those about each subject.

        Sentences that very many documents hold (few by their nature, and counted) are looked up where the documents lie.
        """
        about = read.where(F.col("about") >= 0)
        there = held.select(id_col, F.explode("sids").alias("sid")).join(small_side(often.join(about, "sid").select("sid", "about")), "sid")
        told = rare.join(about, "sid").select(id_col, "about").unionAll(there.select(id_col, "about")).repartition(parts, id_col)
        counts = told.groupBy(id_col).agg(*[F.count_if(F.col("about") == k).cast("double").alias(n) for k, n in enumerate(self.w)])
        return held.select(id_col, F.size("sids").alias("total")).join(counts, id_col)

    def spread(self, counted: DataFrame, clamped: DataFrame, id_col: str, share: float) -> DataFrame:
        """(id, w..) of all documents with a subject; those of the seeds stay as they were."""
        flags = counted.select(id_col, *[F.when(F.col(n) >= share * F.col("total"), F.col(n)).otherwise(0.0).alias(n) for n in self.w])
        return self._normal(flags, id_col).join(clamped.select(id_col), id_col, "left_anti").unionByName(clamped)


def document_subjects(docs: DataFrame, labels: DataFrame, subject_list: DataFrame, id_col: str = "doc_id", text: str = "text", share: float = 0.2, rounds: int = 2, similar: float = 0.4, settled: float = 0.002, linked: bool = True) -> DataFrame:
    """(id, subject, share): every subject that at least `share` of a document's sentences is about.

    A round goes from the documents to their sentences, along the links of similarity until less than `settled` of all
    sentences are newly read, and back; the last round, or the first that changes the subjects of less than `settled` of all
    documents, ends it. Seeds are clamped as what the labels flow from; their rows in the result, too, are what their
    sentences show, since a label may be incomplete. Without `linked` labels go over shared sentences alone.

    NULL, empty and blank texts give no row, nor do documents about nothing in the list; repeated documents are judged alike.
    Labels of unknown documents or subjects are left out; without any labels the result is empty. Sentences are known by a
    64-bit hash. Hot sentences (a formal remark may stand in a third of all documents) are summed map-side on the way in and
    looked up on the way back; links to one hub are salted.
    """
    try:
        names = short_list(subject_list, "subject", MAX_SUBJECTS)
    except ValueError as error:
        raise ValueError(f"more than {MAX_SUBJECTS} subjects") from error
    if not names:
        return docs.select(id_col, F.lit("").alias("subject"), F.lit(0.0).alias("share")).where(F.lit(False))
    kept: list[DataFrame] = []

    def near(df: DataFrame) -> DataFrame:
        kept.append(keep(df))
        return kept[-1]

    def hold(df: DataFrame) -> DataFrame:
        """Cut, and kept near for the steps that read it again and again."""
        return near(stable_cut(df))

    work, parts = Propagation(names), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    said = keep(docs.select(id_col, sentence_list(F.col(text)).alias("said")))  # kept before any filter: that would make the list twice
    held = hold(said.where(F.size("said") > 0).select(id_col, F.transform("said", lambda s: F.xxhash64(s)).alias("sids")).repartition(parts, id_col))
    texts = said.select(F.explode("said").alias("sentence")).groupBy(F.xxhash64("sentence").alias("sid"), "sentence").agg(F.count(F.lit(1)).alias("n"))
    signed = keep(signatures(texts))
    sizes = signed.agg(F.count(F.lit(1)).alias("sentences"), F.sum("n").alias("said")).first()
    count = sizes["sentences"]
    often = small_side(signed.where(F.col("n") > max(1_000, (sizes["said"] or 0) // 10_000)).select("sid"))  # at most 10,000
    rare = hold(held.select(id_col, F.explode("sids").alias("sid")).join(often, "sid", "left_anti").repartition(parts, "sid"))
    tied = links(signed, similar) if linked else signed.select("sid", F.col("sid").alias("hub"), F.lit(1.0).cast("float").alias("j")).where(F.lit(False))
    by_sid = hold(tied.repartition(parts, "sid"))
    by_hub = hold(by_sid.withColumn("salt", F.pmod(F.xxhash64("sid"), F.lit(_SALTS)).cast("int")).repartition(parts, "hub", "salt"))
    for df in (said, signed):
        df.unpersist()
    seeds = hold(work.seeds(labels, id_col))
    known, before = seeds, None
    for left in range(rounds, 0, -1):
        heard = near(work.to_sentences(held, known, id_col))
        base = work.base(heard)
        first = near(work.hubs_heard(by_sid, heard, base))
        read, done = hold(work.read(heard, work.votes(by_hub, first.where("first IS NOT NULL").select("hub", F.col("first").alias("about")), parts), base)), 0
        while linked and (now := read.count()) - done > settled * count and count - now > settled * count:
            done = now
            hubs = first.join(work.hubs_read(by_sid, read), "hub", "full").select("hub", F.coalesce("first", "next").alias("about")).where("about IS NOT NULL")
            again = work.read(heard, work.votes(by_hub, hubs, parts), base)
            read = hold(read.join(again.withColumnRenamed("about", "later"), "sid", "full").select("sid", F.coalesce("about", "later").alias("about")))
        counted = stable_cut(work.to_documents(held, rare, often, read, id_col, parts))
        if left > 1:
            known = stable_cut(work.spread(counted, seeds, id_col, share))
            shown = counted.select(id_col, *[(F.col(n) >= share * F.col("total")).alias(n) for n in work.w])
            if before is not None:
                same = shown.join(before.withColumnsRenamed({n: f"_{n}" for n in work.w}), id_col).where(reduce(lambda a, b: a & b, [F.col(n) == F.col(f"_{n}") for n in work.w]))
                if counted.count() - same.count() <= settled * held.count():
                    break
            before = shown
    for df in kept:
        df.unpersist()
    shares = F.array(*[F.struct(F.lit(s).alias("subject"), (F.col(n) / F.col("total")).alias("share")) for s, n in zip(names, work.w)])
    return counted.select(id_col, F.explode(shares).alias("s")).where(F.col("s.share") >= share).select(id_col, "s.subject", "s.share")


def composition(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(subject, docs, weight, weight_share): how the corpus divides over subjects; a document with several counts in parts of its shares."""
    total = found.groupBy(id_col).agg(F.sum("share").alias("whole"))
    parts = found.join(total, id_col).groupBy("subject").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.col("share") / F.col("whole")).alias("weight"))
    return parts.withColumn("weight_share", F.col("weight") / F.sum("weight").over(Window.partitionBy(F.lit(0))))
