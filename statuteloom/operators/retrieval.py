"""Lexical and vector search of a stated set of queries against all rows, fusion and collapsing of rankings.

Queries come in blocks of bounded size that every task holds; the corpus is read in place, scored batch by batch as a matrix
product, and only the best k of each task and query are shuffled. No posting list is joined and no pair is emitted that is
not a candidate for the top.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuteloom.session import stable_cut

#: Words that carry no meaning for search.
STOP_WORDS = ("a", "an", "and", "any", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it", "of", "on", "or", "shall", "such", "that", "the", "this", "to", "was", "who", "with")
BLOCK = 2_000
_ITSELF = -2.0  # below every cosine


def tokens(text: Column) -> Column:
    """Lower-case words without stop words; a section reference such as 106(2) or 498a is one token."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[0-9]+[a-z]{0,2}(?:\([0-9a-z]+\))*|[a-z]+"), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(*STOP_WORDS))


def corpus_statistics(docs: DataFrame, toks: str = "toks") -> tuple[int, float]:
    """Documents and mean tokens of a document."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size(toks)).alias("avg")).first()
    return row["n"], row["avg"] or 1.0


def idf(docs: DataFrame, wanted: DataFrame, count: int, toks: str = "toks", okapi: bool = False) -> DataFrame:
    """(term, idf) of the wanted terms over all documents; partial counts come first.

    ln(1 + (N - df + 0.5) / (df + 0.5)), or with okapi ln((N - df + 0.5) / (df + 0.5)) where a negative value becomes a
    quarter of the mean over all terms.
    """
    df = docs.select(F.explode_outer(F.array_distinct(toks)).alias("term")).where("term IS NOT NULL").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    odds = (F.lit(count) - F.col("df") + 0.5) / (F.col("df") + 0.5)
    if not okapi:
        return wanted.join(df, "term").select("term", F.log1p(odds).alias("idf"))
    mean = df.agg(F.avg(F.log(odds))).first()[0] or 0.0
    return wanted.join(df, "term").select("term", F.when(F.log(odds) < 0, F.lit(0.25 * mean)).otherwise(F.log(odds)).alias("idf"))


def _best(frame: pd.DataFrame, k: int, id_name: str) -> pd.DataFrame:
    return frame.sort_values(["query", "score", id_name], ascending=[True, False, True]).groupby("query").head(k)


def _merge(partial: DataFrame, k: int, id_name: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), id_name))
    return partial.withColumn("rank", rank).where(F.col("rank") <= k)


def _blocks(queries: DataFrame, key: str, block: int) -> Iterator[list]:
    """Rows of the query set in blocks of about `block`, each fetched on its own."""
    n = queries.count()
    parts = max(1, -(-n // block))
    for part in range(parts):
        rows = (queries if parts == 1 else queries.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part)).collect()
        if rows:
            yield rows


def bm25(docs: DataFrame, queries: DataFrame, k: int = 5, k1: float = 1.2, b: float = 0.75, doc_id: str = "doc_id", query_id: str = "query", block: int = BLOCK, places: int = 4, okapi: bool = False, group: Sequence[str] = ()) -> DataFrame:
    """(query, doc_id, score, rank): the k best documents of each query by Okapi BM25 over its distinct terms.

    docs(doc_id, toks) and queries(query, toks). Scores are rounded to `places` before ranking; ties go to the lower id.
    Queries without a known term have no rows. With `group`, columns of docs that are never NULL, the result is
    (query, group, score, rank) of the k best distinct groups by their best document; ties go to the lower group.
    """
    rows, blocks, mean = _bm25_blocks(docs, queries, list(group) or [doc_id], query_id, block, okapi)
    kind, qkind = docs.schema[doc_id].dataType.simpleString(), queries.schema[query_id].dataType.simpleString()
    keys = list(group) or ["id"]
    rows = rows if group else rows.withColumnRenamed(doc_id, "id")
    columns = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys)
    results = []
    for shared in blocks:

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            names = shared.value[0]
            best = pd.DataFrame({"query": [], **{c: [] for c in keys}, "score": []})
            for part, scores in _bm25_scores(batches, shared.value, mean, k1, b, places):
                best = _keep_groups(best, part[keys], scores, names, k) if group else _keep(best, part["id"].to_numpy(), scores, names, k)
            if len(best):
                yield best

        results.append(rows.mapInPandas(run, f"query {qkind}, {columns}, score double"))
    if not group:
        return _finish(results, docs, doc_id, kind, qkind, k)
    if not results:
        return docs.sparkSession.createDataFrame([], f"query {qkind}, {columns}, score double, rank int")
    every = reduce(DataFrame.unionAll, results).groupBy("query", *keys).agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), *keys)).cast("int")
    return every.withColumn("rank", rank).where(F.col("rank") <= k)


def _bm25_blocks(docs: DataFrame, queries: DataFrame, keys: Sequence[str], query_id: str, block: int, okapi: bool) -> tuple[DataFrame, Iterator, float]:
    """Rows (keys, toks), broadcasts of (names, term index, weights) for each block of queries, and the mean length."""
    count, mean = corpus_statistics(docs)
    asked = queries.select(F.col(query_id).alias("query"), F.array_distinct("toks").alias("terms")).where(F.size("terms") > 0)
    weights = idf(docs, asked.select(F.explode("terms").alias("term")).distinct(), count, okapi=okapi)
    termed = asked.select("query", F.explode("terms").alias("term")).join(weights, "term").groupBy("query").agg(F.collect_list(F.struct("term", "idf")).alias("terms"))

    def blocks() -> Iterator:
        for held in _blocks(termed, "query", block):
            names = [r["query"] for r in held]
            index = {t: j for j, t in enumerate(sorted({t["term"] for r in held for t in r["terms"]}))}
            matrix = np.zeros((len(index), len(names)))
            for j, r in enumerate(held):
                for t in r["terms"]:
                    matrix[index[t["term"]], j] = t["idf"]
            yield docs.sparkSession.sparkContext.broadcast((names, index, matrix))

    return docs.select(*keys, "toks").where(F.size("toks") > 0), blocks(), mean


def _bm25_scores(batches: Iterator[pd.DataFrame], shared: tuple, mean: float, k1: float, b: float, places: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """(rows, rounded scores of all queries) of up to 512 documents at a time."""
    _, index, matrix = shared
    for batch in batches:
        for start in range(0, len(batch), 512):
            part = batch.iloc[start : start + 512]
            tf = np.zeros((len(part), len(index)))
            size = np.array([len(t) for t in part["toks"]], dtype=float)
            for i, toks in enumerate(part["toks"]):
                for t in toks:
                    if (j := index.get(t)) is not None:
                        tf[i, j] += 1
            weight = tf * (k1 + 1) / (tf + k1 * (1 - b + b * size / mean)[:, None])
            yield part, np.round(weight @ matrix, places)


def bm25_places(docs: DataFrame, queries: DataFrame, wanted: DataFrame, k1: float = 1.2, b: float = 0.75, doc_id: str = "doc_id", query_id: str = "query", block: int = BLOCK, places: int = 4, okapi: bool = False) -> DataFrame:
    """(query, doc_id, rank): the exact ranks of the wanted (query, doc_id) in the whole rankings that bm25 cuts at k.

    Two scans: the scores of the wanted, then the number of documents before each; a task yields one row a wanted pair. Pairs
    without a positive score have no row. The wanted of a block of queries are held by every task.
    """
    wanted = stable_cut(wanted.select("query", doc_id).distinct())
    queries = queries.join(wanted.select(F.col("query").alias(query_id)).distinct(), query_id, "left_semi")
    rows, blocks, mean = _bm25_blocks(docs, queries, [doc_id], query_id, block, okapi)
    kind, qkind = docs.schema[doc_id].dataType.simpleString(), queries.schema[query_id].dataType.simpleString()
    results = []
    for shared in blocks:
        session = docs.sparkSession
        names = session.createDataFrame([(q,) for q in shared.value[0]], f"query {qkind}")
        pairs: dict = {}
        for r in wanted.join(names, "query", "left_semi").collect():
            pairs.setdefault(r[doc_id], []).append(r["query"])
        asked = session.sparkContext.broadcast(pairs)

        def score(batches: Iterator[pd.DataFrame], shared=shared, asked=asked) -> Iterator[pd.DataFrame]:
            at = {q: j for j, q in enumerate(shared.value[0])}
            for part, scores in _bm25_scores(batches, shared.value, mean, k1, b, places):
                found = [(at[q], x, scores[i, at[q]]) for i, x in enumerate(part[doc_id]) for q in asked.value.get(x, ()) if scores[i, at[q]] > 0]
                if found:
                    yield pd.DataFrame(found, columns=["j", doc_id, "score"])

        found = rows.mapInPandas(score, f"j int, `{doc_id}` {kind}, score double").toPandas()
        if found.empty:
            continue
        ids, code = np.unique(found[doc_id].to_numpy(), return_inverse=True)
        most, unit = len(ids) + 1, 10**places
        span = (int(round(found["score"].max() * unit)) + 2) * most
        # one number a query, score and id, higher the earlier in the ranking: a wanted document counts itself
        key = found["j"].to_numpy().astype("int64") * span + np.rint(found["score"].to_numpy() * unit).astype("int64") * most - code
        order = np.argsort(key)
        held = session.sparkContext.broadcast((ids, key[order], most, unit, span))

        def ahead(batches: Iterator[pd.DataFrame], shared=shared, held=held) -> Iterator[pd.DataFrame]:
            ids, keys, most, unit, span = held.value
            total, width = np.zeros(len(keys) + 1, dtype="int64"), len(shared.value[0])
            top = span // most - 1  # all that score more than every wanted one
            firsts = np.searchsorted(keys, np.arange(width, dtype="int64") * span - most)
            for part, scores in _bm25_scores(batches, shared.value, mean, k1, b, places):
                i, j = np.nonzero(scores > 0)
                whole = np.minimum(np.rint(scores[i, j] * unit).astype("int64"), top)
                own = j.astype("int64") * span + whole * most - np.searchsorted(ids, part[doc_id].to_numpy())[i]
                total += np.bincount(np.searchsorted(keys, own, side="right"), minlength=len(total)) - np.bincount(firsts[j], minlength=len(total))
            # before a wanted one stand those whose place is beyond it, less those of the queries after its own
            n = np.cumsum(total[::-1])[::-1][1:]
            yield pd.DataFrame({"c": np.arange(len(keys)), "n": n})

        counts = rows.mapInPandas(ahead, "c bigint, n bigint").groupBy("c").agg(F.sum("n").cast("int").alias("rank"))
        listed = pd.DataFrame({"c": np.arange(len(order)), "query": np.asarray(shared.value[0], dtype=object)[found["j"].to_numpy()[order]], doc_id: found[doc_id].to_numpy()[order]})
        results.append(counts.join(session.createDataFrame(listed, f"c bigint, query {qkind}, `{doc_id}` {kind}"), "c").select("query", doc_id, "rank"))
    return reduce(DataFrame.unionAll, results) if results else docs.sparkSession.createDataFrame([], f"query {qkind}, `{doc_id}` {kind}, rank int")


def _keep(best: pd.DataFrame, ids: np.ndarray, scores: np.ndarray, names: Sequence, k: int, above: float = 0.0) -> pd.DataFrame:
    """best with the top k of a batch per query, of scores over `above`; ties at the edge are all taken along and cut by id."""
    take = min(k, len(ids))
    edge = np.partition(scores, len(ids) - take, axis=0)[len(ids) - take]
    i, j = np.nonzero((scores >= edge) & (scores > above))
    fresh = pd.DataFrame({"query": np.asarray(names, dtype=object)[j], "id": ids[i], "score": scores[i, j]})
    return _best(fresh if best.empty else pd.concat([best, fresh]), k, "id") if len(fresh) else best


def _keep_groups(best: pd.DataFrame, part: pd.DataFrame, scores: np.ndarray, names: Sequence, k: int) -> pd.DataFrame:
    """best with the top k groups of a batch per query, each group once with its best score.

    A group that is dropped has k better ones in this task alone, so the best k of all tasks are among those kept.
    """
    keys = list(part.columns)
    code = part.groupby(keys, sort=False).ngroup().to_numpy()
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.diff(code[order], prepend=-1))
    top = np.maximum.reduceat(scores[order], starts, axis=0)
    named = part.iloc[order[starts]]
    take = min(k, len(top))
    edge = np.partition(top, len(top) - take, axis=0)[len(top) - take]
    i, j = np.nonzero((top >= edge) & (top > 0))
    if not len(i):
        return best
    fresh = pd.DataFrame({"query": np.asarray(names, dtype=object)[j], **{c: named[c].to_numpy()[i] for c in keys}, "score": top[i, j]})
    every = (fresh if best.empty else pd.concat([best, fresh])).sort_values(["query", "score", *keys], ascending=[True, False, *[True] * len(keys)])
    return every.drop_duplicates(["query", *keys]).groupby("query").head(k)


def _finish(results: list[DataFrame], docs: DataFrame, doc_id: str, kind: str, qkind: str, k: int) -> DataFrame:
    if not results:
        return docs.sparkSession.createDataFrame([], f"query {qkind}, `{doc_id}` {kind}, score double, rank int")
    return _merge(reduce(DataFrame.unionAll, results), k, "id").select("query", F.col("id").alias(doc_id), "score", F.col("rank").cast("int").alias("rank"))


def dense(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", query_id: str = "query", block: int = BLOCK, places: int = 4, without_self: bool = False) -> DataFrame:
    """(query, vec_id, score, rank): the k nearest vectors of each query vector by cosine, exactly, whatever its sign.

    NULL, empty and zero vectors take no part; vectors of another length than the block's queries score nothing. Ties in the
    rounded score go to the lower id.
    """
    kind, qkind = vectors.schema[vec_id].dataType.simpleString(), queries.schema[query_id].dataType.simpleString()
    rows, blocks = _cosine_blocks(vectors, queries, vec_id, vector, query_id, block)
    results = []
    for shared in blocks:

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            names, matrix = shared.value
            best = pd.DataFrame({"query": [], "id": [], "score": []})
            for ids, scores in _cosines(batches, names, matrix, places, without_self):
                best = _keep(best, ids, scores, names, k, above=_ITSELF)
            if len(best):
                yield best

        results.append(rows.mapInPandas(run, f"query {qkind}, id {kind}, score double"))
    return _finish(results, vectors, vec_id, kind, qkind, k)


def _cosine_blocks(vectors: DataFrame, queries: DataFrame, vec_id: str, vector: str, query_id: str, block: int) -> tuple[DataFrame, Iterator]:
    """Usable rows (id, v), and broadcasts of (names, normalised query matrix) for each block of queries."""
    usable = lambda df: df.where(F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False)))
    rows = usable(vectors).select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    asked = usable(queries).select(F.col(query_id).alias("query"), F.col(vector).cast("array<double>").alias("v"))

    def blocks() -> Iterator:
        for held in _blocks(asked, "query", block):
            names, q = [r["query"] for r in held], np.array([r["v"] for r in held])
            yield vectors.sparkSession.sparkContext.broadcast((names, (q / np.linalg.norm(q, axis=1, keepdims=True)).T))

    return rows, blocks()


def _cosines(batches: Iterator[pd.DataFrame], names: Sequence, matrix: np.ndarray, places: int, without_self: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, rounded scores of all queries) of up to 1,024 vectors at a time."""
    for batch in batches:
        batch = batch[np.array([len(v) == matrix.shape[0] for v in batch["v"]], dtype=bool)]
        for start in range(0, len(batch), 1024):
            part = batch.iloc[start : start + 1024]
            v = np.stack(part["v"].to_numpy())
            scores = np.round((v / np.linalg.norm(v, axis=1, keepdims=True)) @ matrix, places)
            if without_self:
                scores[part["id"].to_numpy()[:, None] == np.asarray(names)[None, :]] = _ITSELF
            yield part["id"].to_numpy(), scores


def close(vectors: DataFrame, queries: DataFrame, least: float, vec_id: str = "vec_id", vector: str = "embedding", query_id: str = "query", block: int = BLOCK, places: int = 4) -> DataFrame:
    """(vec_id, queries, closest): every vector with a cosine of at least `least` to a query vector of another id.

    Counts all such queries, and gives the highest of the rounded scores; a task yields at most one row a vector and block,
    so groups of copies cost no pairs.
    """
    kind = vectors.schema[vec_id].dataType.simpleString()
    rows, blocks = _cosine_blocks(vectors, queries, vec_id, vector, query_id, block)
    results = []
    for shared in blocks:

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            names, matrix = shared.value
            for ids, scores in _cosines(batches, names, matrix, places, True):
                n = (scores >= least).sum(axis=1)
                if n.any():
                    yield pd.DataFrame({"id": ids[n > 0], "n": n[n > 0], "closest": scores[n > 0].max(axis=1)})

        results.append(rows.mapInPandas(run, f"id {kind}, n bigint, closest double"))
    if not results:
        return vectors.sparkSession.createDataFrame([], f"`{vec_id}` {kind}, queries bigint, closest double")
    return reduce(DataFrame.unionAll, results).groupBy(F.col("id").alias(vec_id)).agg(F.sum("n").alias("queries"), F.max("closest").alias("closest"))


def fuse(rankings: Sequence[DataFrame], k: int = 60, item: str = "doc_id", top: int | None = None) -> DataFrame:
    """(query, item, score, rank): reciprocal rank fusion, the sum of 1 / (k + rank) over the rankings; ties to the lower item."""
    every = reduce(DataFrame.unionAll, [r.select("query", item, "rank") for r in rankings])
    summed = every.groupBy("query", item).agg(F.round(F.sum(1.0 / (F.lit(k) + F.col("rank"))), 8).alias("score"))
    ranked = summed.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), item)).cast("int"))
    return ranked if top is None else ranked.where(F.col("rank") <= top)


def fuse_exactly(rankers: Sequence[tuple[Callable[[int], DataFrame], Callable[[DataFrame], DataFrame]]], top: int, k: int = 60, item: str = "doc_id") -> DataFrame:
    """(query, item, score, rank): the `top` first of the fusion of whole rankings, without ranking everything.

    A ranker is (ranking down to a depth, exact ranks of given (query, item)). At the depth taken, an item that no ranking
    holds is worth less than the first `top` of any one ranking. Of the others, those that could still reach the top are
    looked up in the rankings that do not hold them.
    """
    n = len(rankers)
    depth = n * (k + top) - k + 1
    every = reduce(DataFrame.unionAll, [take(depth).select("query", item, "rank", F.lit(j).alias("j")) for j, (take, _) in enumerate(rankers)])
    at = lambda j: F.max(F.when(F.col("j") == j, F.col("rank")))
    worth = lambda c: F.coalesce(1.0 / (F.lit(k) + F.col(c)), F.lit(0.0))
    summed = lambda df: df.withColumn("sum", sum((worth(f"r{j}") for j in range(n)), F.lit(0.0)))
    every = stable_cut(every)
    seen = summed(every.groupBy("query", item).agg(*[at(j).alias(f"r{j}") for j in range(n)]))
    ends = every.groupBy("query").agg(*[at(j).alias(f"m{j}") for j in range(n)])
    gone = [F.col(f"r{j}").isNull() & (F.col(f"m{j}") >= depth) for j in range(n)]
    may = sum((F.when(g, 1.0 / (k + depth + 1)).otherwise(0.0) for g in gone), F.col("sum"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("sum").desc()))
    marked = seen.join(ends, "query").withColumn("may", may).withColumn("place", place)
    least = F.coalesce(F.max(F.when(F.col("place") == top, F.col("sum"))).over(Window.partitionBy("query")), F.lit(0.0))
    kept = stable_cut(marked.withColumn("least", least).where(F.col("may") >= F.col("least") - 2e-8))
    full = kept
    for j, (_, places) in enumerate(rankers):
        missing = kept.where(gone[j]).select("query", item)
        if not missing.isEmpty():
            full = full.join(places(missing).withColumnRenamed("rank", "found"), ["query", item], "left").withColumn(f"r{j}", F.coalesce(f"r{j}", "found")).drop("found")
    scored = summed(full).select("query", item, F.round("sum", 8).alias("score"))
    return _merge(scored, top, item).withColumn("rank", F.col("rank").cast("int"))


def bm25_fused(docs: DataFrame, queries: DataFrame, rules: Sequence[tuple[float, float]], top: int = 5, k: int = 60, doc_id: str = "doc_id", query_id: str = "query", block: int = 10 * BLOCK, places: int = 4) -> DataFrame:
    """(query, doc_id, score, rank): the `top` first of the fusion of whole BM25 rankings, one for each (k1, b) of `rules`.

    docs(doc_id, toks) and queries(query, toks); NULL toks and ids take no part. What bm25 without a cut and fuse would give, by less work: queries of the
    same terms are ranked once; documents are tokenised once for a block of such term sets and kept as bags, the length
    and the counts of wanted terms, alike bags in one partition and scored once; and a partition yields the first few of each
    ranking, with the scores of all of them. What they leave open is settled by counting: see _fusion.
    """
    session, n = docs.sparkSession, len(rules)
    depth = n * (k + top) - k + 1  # no document past it in every ranking can reach the first `top` of any one
    kind, qkind = docs.schema[doc_id].dataType.simpleString(), queries.schema[query_id].dataType.simpleString()
    terms = F.array_sort(F.array_distinct(F.flatten(F.collect_list("toks"))))
    asked = stable_cut(queries.groupBy(F.col(query_id).alias("query")).agg(terms.alias("terms")).where(F.size("terms") > 0))
    results = []
    for held in _blocks(asked.select("terms").distinct(), "terms", block):
        sets = [r["terms"] for r in held]
        words = sorted({t for s in sets for t in s})
        bags = stable_cut(_bags(docs, doc_id, words).repartition("bag"))
        count, mean, df = _bag_statistics(bags, len(words))
        index = {t: j for j, t in enumerate(words)}
        shared = session.sparkContext.broadcast(([[index[t] for t in s] for s in sets], np.log1p((count - df + 0.5) / (df + 0.5)), mean, tuple(rules), 10.0**places))
        ranked = bags.where("id IS NOT NULL").select("id", "bag")
        lists = ", ".join(f"s{j} array<bigint>" for j in range(n))
        firsts = ranked.mapInArrow(lambda batches, shared=shared: _bag_firsts(batches, shared.value, depth), f"g int, ids array<{kind}>, {lists}")
        columns = "".join(f", r{j} int, s{j} bigint" for j in range(n))
        kept = stable_cut(firsts.groupBy("g").applyInArrow(lambda table: _fusion(table, n, depth, top, k), f"g int, id {kind}{columns}"))
        open_at = [F.col(f"r{j}").isNull() & (F.col(f"s{j}") > 0) for j in range(n)]
        pairs = [(r["g"], r["id"], j, r[f"s{j}"]) for r in kept.where(reduce(Column.__or__, open_at)).collect() for j in range(n) if r[f"r{j}"] is None and r[f"s{j}"] > 0]
        if pairs:
            wanted = session.sparkContext.broadcast(pairs)
            counts = ranked.mapInArrow(lambda batches, shared=shared, wanted=wanted: _bag_places(batches, shared.value, wanted.value), "c int, ahead bigint").groupBy("c").agg(F.sum("ahead").alias("ahead"))
            found = session.createDataFrame([(c, *p[:3]) for c, p in enumerate(pairs)], f"c int, g int, id {kind}, j int").join(counts, "c")
            for j in range(n):
                place = found.where(F.col("j") == j).select("g", "id", (F.col("ahead") + 1).cast("int").alias("found"))
                kept = kept.join(place, ["g", "id"], "left").withColumn(f"r{j}", F.coalesce(f"r{j}", "found")).drop("found")
        score = sum((F.coalesce(1.0 / (F.lit(k) + F.col(f"r{j}")), F.lit(0.0)) for j in range(n)), F.lit(0.0))
        place = F.row_number().over(Window.partitionBy("g").orderBy(F.col("score").desc(), "id")).cast("int")
        best = kept.select("g", "id", F.round(score, 8).alias("score")).withColumn("rank", place).where(F.col("rank") <= top)
        best = best.join(session.createDataFrame(list(enumerate(sets)), "g int, terms array<string>"), "g")
        results.append(best.join(asked, "terms").select("query", F.col("id").alias(doc_id), "score", "rank"))
    return reduce(DataFrame.unionAll, results) if results else session.createDataFrame([], f"query {qkind}, `{doc_id}` {kind}, score double, rank int")


def _bags(docs: DataFrame, doc_id: str, words: Sequence[str]) -> DataFrame:
    """(id, bag, n, tokens): the bag of each document that has one of the words; a row a batch, without id, counts documents and tokens.

    A bag is the length of the document, then number and count of each of the words in it, as 32-bit integers.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(list(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.string())
        for batch in batches:
            batch = batch.filter(batch.column(1).is_valid())  # here: a filter of Spark would compute the tokens twice
            ids, toks = batch.column(0), batch.column(1)
            size = pc.list_value_length(toks).to_numpy(zero_copy_only=False).astype("int64")
            word = pc.fill_null(pc.index_in(toks.flatten(), value_set=known), -1).to_numpy(zero_copy_only=False).astype("int64")
            row = np.repeat(np.arange(len(size)), size)
            owner, word, tf = _counted(row[word >= 0], word[word >= 0], len(known))
            has, owner = np.unique(owner, return_inverse=True)
            each = np.bincount(owner, minlength=len(has))
            ends = np.cumsum(1 + 2 * each)
            starts = ends - 1 - 2 * each
            flat = np.empty(int(ends[-1]) if len(ends) else 0, dtype="<i4")
            flat[starts] = size[has]
            at = starts[owner] + 1 + 2 * (np.arange(len(owner)) - (np.cumsum(each) - each)[owner])
            flat[at], flat[at + 1] = word, tf
            bags = pa.Array.from_buffers(pa.binary(), len(has), [None, pa.py_buffer(np.append(0, 4 * ends).astype("<i4")), pa.py_buffer(flat)])
            none = pa.nulls(len(has), pa.int64())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(has)), bags, none, none], names=["id", "bag", "n", "tokens"])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, ids.type), pa.nulls(1, pa.binary()), pa.array([len(size)], pa.int64()), pa.array([int(size.sum())], pa.int64())], names=["id", "bag", "n", "tokens"])

    return docs.select(F.col(doc_id).alias("id"), "toks").mapInArrow(run, f"id {kind}, bag binary, n bigint, tokens bigint")


def _counted(row: np.ndarray, word: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, words and counts of the distinct (row, word), in order."""
    pair, n = np.unique(row * width + word, return_counts=True)
    return pair // width, pair % width, n


def _unpacked(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of the documents of some bags; owner, word and count of what is in them."""
    ends = np.frombuffer(bags.buffers()[1], dtype="<i4")[bags.offset : bags.offset + len(bags) + 1].astype("int64") // 4
    flat, starts, each = np.frombuffer(bags.buffers()[2], dtype="<i4"), ends[:-1], (np.diff(ends) - 1) // 2
    owner = np.repeat(np.arange(len(each)), each)
    at = starts[owner] + 1 + 2 * (np.arange(len(owner)) - (np.cumsum(each) - each)[owner])
    return flat[starts], owner, flat[at], flat[at + 1]


def _bag_statistics(bags: DataFrame, width: int) -> tuple[int, float, np.ndarray]:
    """Documents, mean tokens of a document, and the number of documents with each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, tokens, df = 0, 0, np.zeros(width, dtype="<i8")
        for batch in batches:
            n, tokens = n + (pc.sum(batch.column(1)).as_py() or 0), tokens + (pc.sum(batch.column(2)).as_py() or 0)
            if len(held := batch.column(0).drop_null()):
                df += np.bincount(_unpacked(held)[2], minlength=width)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([tokens], pa.int64()), pa.array([df.tobytes()], pa.binary())], names=["n", "tokens", "df"])

    rows = bags.select("bag", "n", "tokens").mapInArrow(run, "n bigint, tokens bigint, df binary").collect()
    count = sum(r["n"] for r in rows)
    df = sum((np.frombuffer(r["df"], dtype="<i8") for r in rows), np.zeros(width, dtype="int64"))
    return count, (sum(r["tokens"] for r in rows) / count if count else 0.0) or 1.0, df


class _Bags:
    """The bags of a partition, alike ones once: their document ids in order, and for each word who has it and with what weights."""

    def __init__(self, batches: Iterator[pa.RecordBatch], idf: np.ndarray, mean: float, rules: Sequence[tuple[float, float]]):
        table = [b for b in batches if b.num_rows]
        self.count = 0
        if not table:
            return
        table = pa.Table.from_batches(table)
        code = pa.concat_arrays(table.column(1).chunks).dictionary_encode()
        ids, which = table.column(0).to_numpy(), code.indices.to_numpy()
        self.count = len(code.dictionary)
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order[np.argsort(which[order], kind="stable")]]
        self.copies = np.bincount(which, minlength=self.count)
        self.starts = np.cumsum(self.copies) - self.copies
        size, owner, word, tf = _unpacked(code.dictionary)
        order = np.argsort(word, kind="stable")
        owner, word, tf = owner[order], word[order], tf[order].astype(float)
        self.at, self.owner = np.searchsorted(word, np.arange(len(idf) + 1)), owner
        self.weights = [idf[word] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * size[owner] / mean)) for k1, b in rules]

    def scores(self, terms: Sequence[int]) -> np.ndarray:
        """By rule and bag, not rounded."""
        out = np.zeros((len(self.weights), self.count))
        for t in terms:
            part = slice(self.at[t], self.at[t + 1])
            for j, w in enumerate(self.weights):
                out[j, self.owner[part]] += w[part]
        return out

    def places(self, bags: np.ndarray, most: int | None = None) -> np.ndarray:
        """Where in ids the documents of some bags are, of each bag the first `most`."""
        each = self.copies[bags] if most is None else np.minimum(self.copies[bags], most)
        return np.repeat(self.starts[bags] - np.cumsum(each) + each, each) + np.arange(each.sum())

    def first(self, scores: np.ndarray, terms: Sequence[int], depth: int, unit: float) -> np.ndarray:
        """Where in ids the first `depth` documents are, by rounded score and id; none without a positive score."""
        least = 0.5 / unit
        for t in sorted(terms, key=lambda t: self.at[t + 1] - self.at[t]):  # the depth-th of any bags is no better than that of all
            if (n := self.at[t + 1] - self.at[t]) >= depth:
                least = max(least, np.partition(scores[self.owner[self.at[t] : self.at[t + 1]]], n - depth)[n - depth])
                break
        bags = np.flatnonzero(scores >= least - 1 / unit)  # all that round alike are among them
        whole = np.rint(scores[bags] * unit)
        bags, whole = bags[whole > 0], whole[whole > 0]
        if not len(bags):
            return bags
        order = np.argsort(-whole, kind="stable")
        edge = min(int(np.searchsorted(np.cumsum(self.copies[bags[order]]), depth)), len(order) - 1)
        bags = bags[whole >= whole[order[edge]]]
        at = self.places(bags, depth)
        each = np.repeat(np.rint(scores[bags] * unit), np.minimum(self.copies[bags], depth))
        order = np.argsort(self.ids[at], kind="stable")
        return at[order[np.argsort(-each[order], kind="stable")]][:depth]


def _bag_firsts(batches: Iterator[pa.RecordBatch], shared: tuple, depth: int, batch: int = 512) -> Iterator[pa.RecordBatch]:
    """(g, ids, scores by each rule) of a partition for each term set: documents among the first `depth` by any rule."""
    sets, idf, mean, rules, unit = shared
    held = _Bags(batches, idf, mean, rules)
    if not held.count:
        return
    bag_of = np.repeat(np.arange(held.count), held.copies)
    for start in range(0, len(sets), batch):
        g, ids, whole = [], [], []
        for at, terms in enumerate(sets[start : start + batch], start):
            scores = held.scores(terms)
            found = np.unique(np.concatenate([held.first(s, terms, depth, unit) for s in scores]))
            if len(found):
                g.append(at)
                ids.append(held.ids[found])
                whole.append(np.rint(scores[:, bag_of[found]] * unit).astype("int64"))
        if g:
            offsets = pa.array(np.append(0, np.cumsum([len(x) for x in ids])), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (np.concatenate(ids), *np.concatenate(whole, axis=1))]
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), *lists], names=["g", "ids", *[f"s{j}" for j in range(len(rules))]])


def _fusion(table: pa.Table, n: int, depth: int, top: int, k: int) -> pa.Table:
    """(g, id, rank and score by each rule): the documents that can be among the `top` of the fusion, from the firsts of all partitions.

    A partition holds nothing before its last that it has not yielded. So a rank is known down to the earliest of those lasts;
    past it, it is NULL, and at least the number of documents known to be before. A score of 0 has no rank.
    """
    flat = lambda c: pa.concat_arrays([x.flatten() for x in table.column(c).chunks]).to_numpy(zero_copy_only=False)
    ids, part = flat("ids"), np.repeat(np.arange(table.num_rows), pc.list_value_length(table.column("ids")).to_numpy())
    by_id = np.argsort(ids, kind="stable")
    known, most, columns = np.zeros(len(ids)), np.zeros(len(ids)), {}
    for j in range(n):
        whole = flat(f"s{j}")
        order = by_id[np.argsort(-whole[by_id], kind="stable")]
        order = order[whole[order] > 0]
        own = np.argsort(part[order], kind="stable")  # places in the order, by partition
        each = np.bincount(part[order], minlength=table.num_rows)
        full = each >= depth
        sure = own[(np.cumsum(each) - each)[full] + depth - 1].min() + 1 if full.any() else len(order)
        rank = np.zeros(len(ids), dtype="int64")
        rank[order] = np.arange(1, len(order) + 1)
        worth = np.where(rank > 0, 1.0 / (k + rank), 0.0)
        most += worth
        known += np.where(rank <= sure, worth, 0.0)
        columns |= {f"r{j}": pa.array(rank, pa.int32(), mask=(rank == 0) | (rank > sure)), f"s{j}": pa.array(whole, pa.int64())}
    least = np.partition(known, len(known) - top)[len(known) - top] if len(known) >= top else 0.0
    kept = pa.array(np.flatnonzero(most >= least - 2e-8))
    columns = {"g": pa.repeat(table.column("g")[0], len(ids)), "id": pa.array(ids, table.schema.field("ids").type.value_type), **columns}
    return pa.table(columns).take(kept)


def _bag_places(batches: Iterator[pa.RecordBatch], shared: tuple, pairs: Sequence[tuple]) -> Iterator[pa.RecordBatch]:
    """(c, ahead): how many documents of a partition stand before the c-th of pairs (term set, id, rule, score)."""
    sets, idf, mean, rules, unit = shared
    held = _Bags(batches, idf, mean, rules)
    if not held.count:
        return
    by_set: dict = {}
    for c, (g, x, j, score) in enumerate(pairs):
        by_set.setdefault(g, {}).setdefault((j, score), []).append((c, x))
    ahead = np.zeros(len(pairs), dtype="int64")
    for g, wanted in by_set.items():
        whole = np.rint(held.scores(sets[g]) * unit).astype("int64")
        for j in {j for j, _ in wanted}:
            order = np.argsort(-whole[j], kind="stable")
            falling, before = -whole[j][order], np.append(0, np.cumsum(held.copies[order]))
            for score, those in ((s, x) for (i, s), x in wanted.items() if i == j):
                low, high = np.searchsorted(falling, -score, side="left"), np.searchsorted(falling, -score, side="right")
                tied = np.sort(held.ids[held.places(order[low:high])])
                for c, x in those:
                    ahead[c] = before[low] + np.searchsorted(tied, x)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(pairs)), pa.int32()), pa.array(ahead, pa.int64())], names=["c", "ahead"])


def collapse(ranking: DataFrame, parts: DataFrame, item: str, group: Sequence[str]) -> DataFrame:
    """(query, group, score, rank): the best score of a group's items, ranked anew."""
    best = ranking.join(parts.select(item, *group), item).groupBy("query", *group).agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), *group)).cast("int"))


def rerank(ranking: DataFrame, texts: DataFrame, queries: DataFrame, score: Callable[[Column, Column], Column], item: str = "doc_id", first: int = 20, k: int = 5) -> DataFrame:
    """(query, item, score, rank): the first `first` of a ranking scored anew by score(query text, item text), best k kept."""
    pairs = ranking.where(F.col("rank") <= first).select("query", item).join(texts.select(item, F.col("text").alias("_t")), item).join(queries.select("query", F.col("text").alias("_q")), "query")
    scored = pairs.select("query", item, F.round(score(F.col("_q"), F.col("_t")), 4).alias("score"))
    return _merge(scored, k, item).withColumn("rank", F.col("rank").cast("int"))


def search(docs: DataFrame, queries: DataFrame, k: int = 5, depth: int = 50, vectors: DataFrame | None = None, query_vectors: DataFrame | None = None, doc_id: str = "doc_id", where: Column | None = None) -> DataFrame:
    """Lexical and, where vectors are given, vector rankings of `depth`, fused, best k kept; `where` filters the corpus first."""
    kept = docs if where is None else docs.where(where)
    rankings = [bm25(kept.select(doc_id, tokens(F.col("text")).alias("toks")), queries.select("query", tokens(F.col("text")).alias("toks")), depth, doc_id=doc_id)]
    if vectors is not None and query_vectors is not None:
        rankings.append(dense(vectors.join(kept.select(doc_id), doc_id, "left_semi"), query_vectors, depth, vec_id=doc_id))
    return fuse(rankings, item=doc_id, top=k)
