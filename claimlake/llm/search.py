"""Exact BM25 top-k search over a sharded inverted index with block-max WAND.

``build_index`` cuts the documents, where they lie, into shards of at most
``SHARD`` documents and stores one inverted index for each: documents in order
of length, postings in order of term. ``statistics`` takes the number of
documents, their mean length and the document frequencies over all shards, so
that a score doesn't depend on the shard it was computed in.

``search`` runs blocks of ``QUERIES`` queries against every shard. A shard's
documents are cut into blocks of ``BLOCK``. The contributions of terms that are in
many of the shard's documents lie in a dense matrix for each block, with the
largest of every term in the block; those of the other terms are added up by
document from their postings, for ``GROUP`` queries at a time. The sum of the
query's block maxima and the largest sum of the others bounds every score in the
block. Blocks whose bound is below the k-th best score so far (over all shards
that the task has seen) are skipped: nothing that they hold can be among the k
best. In the others every document gets a bound of its own, by the product of the
block's matrix with the weights of the queries that enter it; a group's queries
share their commonest terms, so that the product takes few of the matrix's rows.
Documents whose bound reaches the k-th best score are scored, in double precision
and in one order of terms. Each task hands on its k best per query; these are
merged, in two steps, to the exact result.

Terms are runs of word characters in lower case, told apart by 64-bit hashes. A
query is the set of its terms. Ties are broken by the smaller id.

Defined results: a null or empty text, or one without terms, is in no result
and gives none as a query; fewer than k rows if fewer documents share a term;
repeated rows are separate results; rows with a null id can be found (they sort
after others) but are no queries; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.session import materialize

K1, B = 1.2, 0.75
SHARD = 2048
SHARD_CHARS = 1 << 24
BLOCK = 64
#: Queries that are sent to the tasks at a time; bounds what is broadcast.
QUERIES = 4096
#: Queries whose bounds are computed together, with so many terms at most unless it is one query, and documents that are scored together.
GROUP, GROUP_TERMS, SCORED = 128, 65_536, 512
#: Queries are alike if so many of their commonest terms are the same.
LIKE = 8
#: A term in more than one of ``DENSE_SHARE`` documents of a shard goes to its dense matrix, ``DENSE_TERMS`` terms at most.
DENSE_SHARE, DENSE_TERMS = 32, 1024
_TERM = re.compile(r"\w+")


def terms(text: str | None) -> list[str]:
    return _TERM.findall((text or "").lower())


def _term_counts(text: str | None, known: dict[str, int]) -> tuple[np.ndarray, np.ndarray, int]:
    found = terms(text)
    h = [known.get(t) or known.setdefault(t, xxhash.xxh3_64_intdigest(t) or 1) for t in found]
    hashes, counts = np.unique(np.array(h, np.uint64), return_counts=True)
    return hashes, counts, len(found)


def build_index(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Stored index, a row for each shard: ids and lengths of its documents by
    length; sorted term hashes, where their postings start, and the postings
    (document in the shard, count)."""
    schema = T.StructType([T.StructField("ids", T.ArrayType(docs.schema[id_col].dataType))])
    for name in ("lengths", "terms", "starts", "postings", "counts"):
        schema = schema.add(name, "binary")

    def shard(ids: list, found: list[tuple[np.ndarray, np.ndarray, int]], id_type: pa.DataType) -> pa.RecordBatch:
        order = sorted(range(len(ids)), key=lambda i: found[i][2])
        lengths = np.array([found[i][2] for i in order], "<u4")
        doc = np.repeat(np.arange(len(order)), [len(found[i][0]) for i in order])
        term = np.concatenate([found[i][0] for i in order])
        count = np.concatenate([found[i][1] for i in order])
        by = np.argsort(term, kind="stable")
        distinct, starts = np.unique(term[by], return_index=True)
        data = [lengths, distinct.astype("<u8"), np.r_[starts, len(term)].astype("<u4"), doc[by].astype("<u2"), count[by].astype("<u4")]
        return pa.RecordBatch.from_arrays([pa.array([[ids[i] for i in order]], pa.list_(id_type)), *(pa.array([x.tobytes()], pa.binary()) for x in data)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found, size, known, id_type = [], [], 0, {}, None
        for batch in batches:
            id_type = batch.column(0).type
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                counted = _term_counts(text.as_py(), known)
                if not counted[2]:
                    continue
                ids.append(key.as_py())
                found.append(counted)
                size += 6 * counted[2]
                if len(ids) >= SHARD or size >= SHARD_CHARS:
                    yield shard(ids, found, id_type)
                    ids, found, size, known = [], [], 0, {}
        if ids:
            yield shard(ids, found, id_type)

    return materialize(docs.select(id_col, "text").mapInArrow(run, schema), "search_index")


def statistics(index: DataFrame) -> tuple[int, float, DataFrame]:
    """(documents, mean length, document frequencies (h, df)) over all shards."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lengths in batch.column(0):
                n = np.frombuffer(lengths.as_py(), "<u4")
                yield pa.RecordBatch.from_arrays([pa.array([len(n)], pa.int64()), pa.array([int(n.sum(dtype=np.int64))], pa.int64())], names=["n", "words"])

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                h, starts = np.frombuffer(batch.column(0)[i].as_py(), "<u8"), np.frombuffer(batch.column(1)[i].as_py(), "<u4")
                for lo in range(0, len(h), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(h[lo : lo + 50_000].view(np.int64)), pa.array(np.diff(starts[lo : lo + 50_001]).astype(np.int64))], names=["h", "n"])

    total = index.select("lengths").mapInArrow(tally, "n long, words long").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    df = index.select("terms", "starts").mapInArrow(frequencies, "h long, n long").groupBy("h").agg(F.sum("n").alias("df"))
    return total["n"] or 0, (total["words"] or 0) / max(total["n"] or 0, 1), df


def weighted_queries(queries: DataFrame, df: DataFrame, n_docs: int, id_col: str = "doc_id") -> DataFrame:
    """Stored (query, terms, weights): a query's term hashes and their idf. Terms
    that no document has add nothing and are left out."""
    schema = T.StructType([T.StructField("query", queries.schema[id_col].dataType)]).add("h", "long")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, int] = {}
            for i, text in enumerate(batch.column(1)):
                h = _term_counts(text.as_py(), known)[0]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.full(len(h), i))), pa.array(h.view(np.int64))], names=schema.names)

    idf = F.log1p((F.lit(float(n_docs)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    exploded = queries.where(F.col(id_col).isNotNull()).select(id_col, "text").mapInArrow(explode, schema).distinct()
    rows = exploded.join(df, "h").select("query", F.struct("h", idf.alias("w")).alias("t"))
    # a row holds the distinct terms of one text
    grouped = rows.groupBy("query").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return materialize(grouped.select("query", F.col("t.h").alias("terms"), F.col("t.w").alias("weights")), "search_queries")


class Shard:
    """One shard: contributions of frequent terms as a matrix for each block, with their
    block maxima; those of other terms by posting."""

    def __init__(self, row: dict, mean: float):
        self.ids = row["ids"]
        lengths = np.frombuffer(row["lengths"], "<u4")
        self.terms = np.frombuffer(row["terms"], "<u8")
        self.starts = np.frombuffer(row["starts"], "<u4").astype(np.int64)
        docs = np.frombuffer(row["postings"], "<u2").astype(np.int64)
        tf = np.frombuffer(row["counts"], "<u4").astype(np.float64)
        self.part = tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[docs] / mean))
        self.blocks = int(-(-len(self.ids) // BLOCK))
        #: where a posting's document is for the first query of a group
        self.at = docs + docs // BLOCK * ((GROUP - 1) * BLOCK)
        n = np.diff(self.starts)
        # frequent terms, by document
        dense = np.flatnonzero(n > len(self.ids) / DENSE_SHARE)
        dense = dense[np.argsort(-n[dense], kind="stable")[:DENSE_TERMS]]
        self.dense = np.full(len(n), -1)
        self.dense[dense] = np.arange(len(dense))
        self.exact = np.zeros((self.blocks * BLOCK, len(dense)))
        at = _ranges(self.starts[dense], self.starts[dense + 1])
        self.exact[docs[at], np.repeat(np.arange(len(dense)), n[dense])] = self.part[at]
        self.matrix = np.ascontiguousarray(self.exact.reshape(self.blocks, BLOCK, len(dense)).transpose(0, 2, 1), np.float32)
        self.most = self.matrix.max(2).T
        # single precision and another order of additions change a sum of positive numbers by less than this share
        self.slack = (len(dense) + 16) * 2.0**-22


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    n = hi - lo
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Top:
    """The k best of a query so far: score down, id up, null ids last."""

    def __init__(self, k: int):
        self.k, self.rows, self.floor = k, [], -1.0

    def add(self, scores: np.ndarray, ids: list) -> None:
        self.rows = sorted([*self.rows, *zip(scores.tolist(), ids, strict=True)], key=lambda r: (-r[0], r[1] is None, r[1]))[: self.k]
        if len(self.rows) == self.k:
            self.floor = self.rows[-1][0]


class Queries:
    """Queries with their terms as numbers in one sorted list, and groups of queries whose commonest terms are alike."""

    def __init__(self, terms: list[np.ndarray], weights: list[np.ndarray]):
        self.n = len(weights)
        self.terms, number = np.unique(np.concatenate([np.zeros(0, np.uint64), *terms]), return_inverse=True)
        numbers = np.split(number, np.cumsum([len(t) for t in terms])[:-1]) if terms else []
        common = [n[np.argsort(w, kind="stable")[:LIKE]].tolist() for n, w in zip(numbers, weights, strict=True)]
        groups, size = [], 0
        for i in sorted(range(len(weights)), key=common.__getitem__):
            if not groups or len(groups[-1]) == GROUP or size + len(weights[i]) > GROUP_TERMS:
                groups.append([])
                size = 0
            groups[-1].append(i)
            size += len(weights[i])
        #: each group's queries; of its terms, one query after the other, the place in the group, the number and the weight
        self.groups = [
            (g, np.repeat(np.arange(len(g)), [len(weights[i]) for i in g]), np.concatenate([numbers[i] for i in g]), np.concatenate([weights[i] for i in g])) for g in groups
        ]

    def __len__(self) -> int:
        return self.n


def run_queries(s: Shard, asked: Queries, tops: list[Top]) -> int:
    """Adds the shard's part to every query's ``Top``; gives the number of blocks entered."""
    at = np.minimum(np.searchsorted(s.terms, asked.terms), len(s.terms) - 1)
    place = np.where(s.terms[at] == asked.terms, at, -1)
    return sum(_run_group(s, [tops[i] for i in group], row, place[number], weight) for group, row, number, weight in asked.groups)


def _run_group(s: Shard, tops: list[Top], row: np.ndarray, term: np.ndarray, weight: np.ndarray) -> int:
    # the queries' terms that the shard has, one query after the other; ``row`` is the query
    there = np.flatnonzero(term >= 0)
    if not len(there):
        return 0
    row, term, weight = row[there], term[there], weight[there]
    column, k = s.dense[term], tops[0].k
    frequent, other = np.flatnonzero(column >= 0), np.flatnonzero(column < 0)
    asked = np.zeros(s.matrix.shape[1], bool)
    asked[column[frequent]] = True
    used = np.flatnonzero(asked)
    dense = np.zeros((len(tops), len(used)), np.float32)
    dense[row[frequent], (np.cumsum(asked) - 1)[column[frequent]]] = weight[frequent]
    matrix = s.matrix if len(used) == s.matrix.shape[1] else s.matrix[:, used]
    # other terms' sums, by block, query and document
    lo, n = s.starts[term[other]], s.starts[term[other] + 1] - s.starts[term[other]]
    postings = _ranges(lo, lo + n)
    key = s.at[postings] + np.repeat(row[other] * BLOCK, n)
    parts = s.part[postings] * np.repeat(weight[other], n)
    sums = np.bincount(key, parts, s.blocks * GROUP * BLOCK).reshape(s.blocks, GROUP, BLOCK)[:, : len(tops)]
    bounds = (dense @ s.most[used] + sums.max(2).T) * (1 + s.slack)
    floor = np.array([top.floor for top in tops])
    # the best blocks first for queries that have no k-th best score yet
    ahead = np.zeros(bounds.shape, bool)
    np.put_along_axis(ahead, np.argsort(-bounds, axis=1)[:, :2], True, 1)
    ahead &= (floor < 0)[:, None]
    entered, left = 0, []
    for part in (ahead, ~ahead) if ahead.any() else (~ahead,):
        chosen = part & (bounds > 0) & (bounds >= floor[:, None])
        entered += int(chosen.sum())
        for b in np.flatnonzero(chosen.any(0)):
            rows = np.flatnonzero(chosen[:, b])
            most = (dense[rows] @ matrix[b] + sums[b, rows]) * (1 + s.slack)
            at = np.flatnonzero((most >= floor[rows, None]) & (most > 0))
            left.append((rows[at // BLOCK], b * BLOCK + at % BLOCK, most.ravel()[at]))
        if not left:
            return entered
        # each query's documents, the largest bounds first; not those below the k-th best of what is bounded so far
        query, doc, most = map(np.concatenate, zip(*left, strict=True))
        by = np.lexsort((-most, query))
        query, doc, most = query[by], doc[by], most[by]
        kth = np.searchsorted(query, np.arange(len(tops))) + k - 1
        full = np.flatnonzero(kth < np.searchsorted(query, np.arange(len(tops)), "right"))
        floor[full] = np.maximum(floor[full], most[kth[full]] * (1 - 3 * s.slack))
        keep = most >= floor[query]
        query, doc, most = query[keep], doc[keep], most[keep]
        left = [(query, doc, most)]
    if not len(query):
        return entered
    # the postings of those documents only
    wanted = np.zeros(s.blocks * GROUP * BLOCK, bool)
    wanted[_at(query, doc)] = True
    mine = np.flatnonzero(wanted[key])
    found = key[mine], other[np.searchsorted(np.cumsum(n), mine, "right")], parts[mine]
    for i in range(0, len(query), SCORED):
        q, d = query[i : i + SCORED], doc[i : i + SCORED]
        scores = _scores(s, q, d, (row, weight, column), found)
        cuts = np.flatnonzero(np.diff(q)) + 1
        for own in np.split(np.arange(len(q)), cuts):
            top = tops[q[own[0]]]
            best = own[(scores[own] > 0) & (scores[own] >= top.floor)]
            if len(best):
                top.add(scores[best], [s.ids[j] for j in d[best]])
    return entered


def _at(query: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Where a group's sums have a query's document."""
    return doc + (doc // BLOCK * (GROUP - 1) + query) * BLOCK


def _scores(s: Shard, query: np.ndarray, doc: np.ndarray, terms: tuple[np.ndarray, ...], found: tuple[np.ndarray, ...]) -> np.ndarray:
    """Exact scores of documents for queries, added up in the order of the query's terms."""
    (row, weight, column), (key, word, parts) = terms, found
    start = np.searchsorted(row, np.arange(row[-1] + 2))
    n = start[query + 1] - start[query]
    pair, term = np.repeat(np.arange(len(query)), n), _ranges(start[query], start[query + 1])
    value = np.zeros(len(term))
    dense = np.flatnonzero(column[term] >= 0)
    value[dense] = s.exact[doc[pair[dense]], column[term[dense]]] * weight[term[dense]]
    slot = np.full(s.blocks * GROUP * BLOCK, -1)
    slot[_at(query, doc)] = np.cumsum(n) - n
    mine = np.flatnonzero(slot[key] >= 0)
    value[slot[key[mine]] + word[mine] - start[row[word[mine]]]] = parts[mine]
    return np.bincount(pair, value, len(query))


def run_query(s: Shard, term: np.ndarray, weight: np.ndarray, top: Top) -> int:
    """:func:`run_queries` for one query."""
    return run_queries(s, Queries([term], [weight]), [top])


def search(index: DataFrame, queries: DataFrame, mean: float, k: int = 10) -> DataFrame:
    """(query, rank, id, score), the k best documents of every weighted query."""
    spark = index.sparkSession
    id_type, query_type = index.schema["ids"].dataType.elementType, queries.schema["query"].dataType
    schema = T.StructType([T.StructField("query", query_type), T.StructField("id", id_type)]).add("score", "double").add("part", "integer")
    n = queries.count()
    blocks = max(1, -(-n // QUERIES))
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
    found = None
    for b in range(blocks):
        shared = spark.sparkContext.broadcast(dealt.where(F.col("block") == b).drop("block").toPandas())  # about QUERIES rows

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            block: pd.DataFrame = shared.value
            asked = Queries([np.asarray(t, np.int64).view(np.uint64) for t in block["terms"]], [np.asarray(w, np.float64) for w in block["weights"]])
            tops = [Top(k) for _ in range(len(asked))]
            for batch in batches:
                for i in range(batch.num_rows):
                    run_queries(Shard({name: batch.column(name)[i].as_py() for name in batch.schema.names}, mean), asked, tops)
            rows = [(q, key, score) for q, top in zip(block["query"].tolist(), tops, strict=True) for score, key in top.rows]
            part = TaskContext.get().partitionId() % 64
            yield pa.RecordBatch.from_pylist([{"query": q, "id": key, "score": score, "part": part} for q, key, score in rows], schema=_arrow(schema))

        one = index.mapInArrow(run, schema)
        found = one if found is None else found.unionByName(one)
    best_first = [F.col("score").desc(), F.col("id").asc_nulls_last()]

    def best(df: DataFrame, *by: str) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*best_first))).where(F.col("rank") <= k)

    return best(best(found, "query", "part").drop("rank"), "query").select("query", "rank", "id", "score")


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id") -> DataFrame:
    """The k best of ``docs`` for every row of ``queries`` (same id and text columns)."""
    index = build_index(docs, id_col)
    n, mean, df = statistics(index)
    return search(index, weighted_queries(queries, df, n, id_col), mean, k)
