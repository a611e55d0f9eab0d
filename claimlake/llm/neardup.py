"""Near-duplicate groups: MinHash bands, sequential Bayesian comparison of the
signatures, and an exact check on full shingle sets.

A document's set holds its distinct shingles of ``k`` words (ASCII capitals
lower-cased, words cut at ASCII white space); with fewer words, the whole
sequence is the one shingle. Documents are linked if their sets' Jaccard
similarity is ``percent`` or more; linked documents form a group.

1. Documents with equal sets are one class, represented by the least id.
2. Representatives that share a band of the signature are candidates. A pair
   at the threshold shares none of ``BANDS`` x ``ROWS`` with probability 6e-7.
3. In each bucket, every member is first compared with the bucket's least id
   only, then, if still in another group, with the member that has the fewest
   shingles of its own: as many pairs as members, however large the bucket.
   Groups are formed from the links; a pair inside one group needs no
   comparison, so groups of copies never turn into all their pairs. What shares
   a bucket and is still apart is compared last, unless exact counts rule the
   pair out: the shingles that each of the two shares with any candidate bound
   what they can have in common, and where both have been compared with the
   bucket's least id, their differences from it tell how much that is.
4. A comparison reads the signatures in batches of ``BATCH`` hashes and stops as
   soon as the posterior probability (uniform prior) of a similarity at or above
   the threshold falls below ``MISS``. What survives is joined with the texts
   and linked only if the full sets agree.
5. Connected components by alternating large-star and small-star steps, each a
   pair of joins whose result is stored in the shared folder.

Defined results: a document without words (or a null text) has an empty set and
no links; rows with a null id have no links either and a null component, and
are kept; rows of one id count as one document that has the links of any of
its rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.session import materialize

BANDS = 36
ROWS = 5
BATCH = 30
MISS = 1e-6
#: Shingles that are hashed BANDS x ROWS times at once.
CHUNK = 2048

_U = np.uint64
_RNG = np.random.default_rng(20)
_odd = lambda n: _RNG.integers(0, 1 << 63, n, dtype=np.uint64) * _U(2) + _U(1)
_BYTE, _PLACE, _MULTIPLY, _BAND = _odd(256), _odd(64), _odd(BANDS * ROWS), _odd(ROWS)
_ADD = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(text: str | None, k: int) -> set[tuple[bytes, ...]]:
    """The set itself, for the exact check."""
    w = words(text)
    return set(zip(*(w[i:] for i in range(k)), strict=False)) if len(w) >= k else {tuple(w)} if w else set()


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    w = words(text)
    if not w:
        return np.zeros(0, np.uint64)
    known: dict[bytes, int] = {}
    h = np.array([known.get(x) or known.setdefault(x, xxhash.xxh3_64_intdigest(x)) for x in w], np.uint64)
    if len(w) < k:
        return _mix((h * np.resize(_PLACE, len(h))).sum(keepdims=True) + _U(len(h)))
    n = len(h) - k + 1
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total += h[i : i + n] * _PLACE[i % len(_PLACE)]
    return np.unique(_mix(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    """MinHash of BANDS x ROWS 32-bit values."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), CHUNK):
        h = (hashes[at : at + CHUNK, None] * _MULTIPLY + _ADD) >> _U(32)
        least = np.minimum(least, h.min(0).astype(np.uint32))
    return least


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """Signed 64-bit key of each band, rows x BANDS."""
    s = signatures.astype(np.uint64).reshape(len(signatures), BANDS, ROWS)
    return _mix((s * _BAND).sum(2) + np.arange(BANDS, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)).view(np.int64)


def least_matches(percent: int) -> list[tuple[int, int]]:
    """(hashes compared, matches needed to go on) after each batch.

    With a uniform prior, m matches of n give P(similarity >= t) = P(Bin(n + 1, t) <= m)."""
    out, t = [], percent / 100
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        total = 0.0
        for m in range(n + 1):
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= MISS:
                out.append((n, m))
                break
    return out


def sketches(docs: DataFrame, k: int, id_col: str = "doc_id") -> DataFrame:
    """Stored (id, n_shingles, digest of the set, signature) of every row."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType)])
    schema = schema.add("n_shingles", "long").add("digest", "binary").add("signature", "binary")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, sig = [], [], []
            for text in batch.column(1):
                h = shingle_hashes(text.as_py(), k)
                n.append(len(h))
                digest.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                sig.append(signature(h).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())], names=schema.names)

    return materialize(docs.select(F.col(id_col).alias("id"), "text").mapInArrow(sketch, schema), "neardup_sketches")


def _bands(reps: DataFrame) -> DataFrame:
    schema = T.StructType([T.StructField("key", T.LongType()), reps.schema["id"]])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
                ids = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))
                yield pa.RecordBatch.from_arrays([pa.array(band_keys(sigs).ravel()), ids], names=["key", "id"])

    return reps.select("id", "signature").mapInArrow(explode, schema)


def _surviving(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that no batch of their signatures rules out."""
    joined = (
        pairs.join(sigs.select(F.col("id").alias("a"), F.col("signature").alias("sa")), "a")
        .join(sigs.select(F.col("id").alias("b"), F.col("signature").alias("sb")), "b")
        .select("a", "b", "sa", "sb")
    )
    schema = T.StructType([pairs.schema["a"], pairs.schema["b"]])
    tests = least_matches(percent)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4000):
                batch = whole.slice(at, 4000)
                sa, sb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for i in (2, 3))
                alive, matches, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
                for n, least in tests:
                    matches[alive] += (sa[alive, done:n] == sb[alive, done:n]).sum(1)
                    alive, done = alive[matches[alive] >= least], n
                kept = batch.take(pa.array(alive))
                yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    return joined.mapInArrow(compare, schema).distinct()


def _compared(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b, size_a, common, linked, diff): what the full shingle sets of each
    pair have in common, whether they have the similarity, and hashes of the
    shingles that only one of the two has (different ones for either side)."""
    joined = (
        pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
        .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
        .select("a", "b", "ta", "tb")
    )
    schema = T.StructType([pairs.schema["a"], pairs.schema["b"]]).add("size_a", "long").add("common", "long").add("linked", "boolean")
    schema = schema.add("diff", T.ArrayType(T.LongType()))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[str, set] = OrderedDict()  # a bucket's centre comes up again and again

        def of(text: str) -> set:
            if text not in recent:
                recent[text] = shingles(text, k)
                if len(recent) > 8:
                    recent.popitem(last=False)
            recent.move_to_end(text)
            return recent[text]

        def hashed(only: set, seed: int) -> list[int]:
            return [xxhash.xxh3_64_intdigest(b" ".join(x), seed) - (1 << 63) for x in only]

        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                size, common, linked, diff = [], [], [], []
                for i in range(batch.num_rows):
                    x, y = of(batch.column(2)[i].as_py()), of(batch.column(3)[i].as_py())
                    n = len(x & y)
                    size.append(len(x))
                    common.append(n)
                    linked.append(100 * n >= percent * (len(x) + len(y) - n))
                    diff.append(hashed(x - y, 1) + hashed(y - x, 2))
                columns = [pa.array(size, pa.int64()), pa.array(common, pa.int64()), pa.array(linked, pa.bool_()), pa.array(diff, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=schema.names)

    return joined.mapInArrow(compare, schema)


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of the edges (a, b): the least id that can be reached."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges, "neardup_edges")
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "neardup_edges")
        after = mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _own_shingles(texts: DataFrame, k: int) -> DataFrame:
    """(id, own): how many shingles of a document are in no other of these; the
    rest bounds what it has in common with any. Hashes of 40 bits: a collision
    can only lower ``own``."""
    schema = T.StructType([T.StructField("h", T.LongType()), texts.schema["id"]])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                h = np.unique(shingle_hashes(text.as_py(), k) >> _U(24)).astype(np.int64)
                ids = batch.column(0).take(pa.array(np.full(len(h), i)))
                yield pa.RecordBatch.from_arrays([pa.array(h), ids], names=["h", "id"])

    found = texts.select("id", "text").mapInArrow(explode, schema).groupBy("h").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    return found.where("n = 1").groupBy("id").agg(F.count(F.lit(1)).alias("own"))


def _apart(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the buckets whose members are in several groups."""
    placed = shared.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    several = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    return placed.join(several, "key", "left_semi")


def groups(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row."""
    rows = sketches(docs, k, id_col)
    real = rows.where("id IS NOT NULL AND digest IS NOT NULL")
    classes = materialize(real.groupBy("digest").agg(F.min("id").alias("rep")), "neardup_classes")
    members = real.join(classes, "digest").select("id", "rep", "digest", "signature", "n_shingles")
    reps = members.where("id = rep").dropDuplicates(["digest"]).select("id", "signature", "n_shingles")
    reps = materialize(reps, "neardup_reps")

    buckets = _bands(reps)
    centres = buckets.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("last")).where("centre <> last")
    shared = materialize(buckets.join(centres.select("key", "centre"), "key"), "neardup_buckets")
    involved = materialize(shared.select("id").distinct(), "neardup_involved")
    sigs = materialize(reps.join(involved, "id", "left_semi"), "neardup_signatures")
    texts = materialize(docs.select(F.col(id_col).alias("id"), "text").where("text IS NOT NULL").join(involved, "id", "left_semi"), "neardup_texts")

    def compared(pairs: DataFrame) -> DataFrame:
        survivors = materialize(_surviving(pairs.distinct(), sigs, percent), "neardup_pairs")
        return materialize(_compared(survivors, texts, k, percent), "neardup_compared")

    def links_of(done: DataFrame) -> DataFrame:
        return done.where("linked").select("a", "b").distinct()

    # rows of one id with different sets tie their classes together
    several = real.groupBy("id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x <> y").select("id")
    links = members.join(several, "id", "left_semi").select(F.col("id").alias("a"), F.col("rep").alias("b"))

    # first comparisons: with the least id of each bucket
    done = compared(shared.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")))
    links = links.unionByName(links_of(done))
    found = materialize(components(links), "neardup_components")

    # second: with the member of each bucket that has the fewest shingles of its own
    apart = materialize(_apart(shared, found), "neardup_open")
    open_ids = apart.select("id").distinct()
    own = _own_shingles(texts.join(open_ids, "id", "left_semi"), k)
    size = sigs.groupBy("id").agg(F.max("n_shingles").alias("n"))
    # sizes bound what one set can share; an id with several texts has several sets, so nothing is known of it
    size = size.join(open_ids, "id", "left_semi").join(own, "id", "left").join(several.withColumn("many", F.lit(True)), "id", "left")
    size = size.select("id", F.when(F.col("many").isNull(), F.col("n")).alias("n"), F.when(F.col("many").isNull(), F.col("n") - F.coalesce("own", F.lit(0))).alias("s"))
    # what is known of each member and its bucket's centre; ids with several texts are left unknown
    known = done.groupBy(F.col("a").alias("centre"), F.col("b").alias("id")).agg(F.count(F.lit(1)).alias("texts"), *[F.first(c).alias(c) for c in ("size_a", "common", "diff")])
    known = known.where("texts = 1").drop("texts")
    itself = F.col("id") == F.col("centre")
    apart = apart.join(size, "id").join(known, ["centre", "id"], "left").withColumns(
        {
            "common": F.when(itself, F.col("n")).otherwise(F.col("common")),
            "size_a": F.when(itself, F.col("n")).otherwise(F.col("size_a")),
            "diff": F.when(itself, F.array().cast("array<bigint>")).otherwise(F.col("diff")),
        }
    )
    apart = materialize(apart, "neardup_open")
    second = apart.groupBy("key").agg(F.max_by("id", F.struct(F.when(F.col("id") != F.col("centre"), F.col("s")), "id")).alias("centre_2"))
    apart = materialize(apart.join(materialize(second, "neardup_centres"), "key"), "neardup_open")
    # what two sets have in common is at most the smaller s; and it follows exactly
    # from how each of them differs from the centre, where that is known
    enough = lambda common: f"{100 + percent} * ({common}) >= {percent} * (n + n2)"
    possible = f"coalesce({enough('least(s, s2)')}, true) AND coalesce({enough('common + common2 - size_a + size(array_intersect(diff, diff2))')}, true)"
    others = ("component", "n", "s", "common", "diff")
    second_row = apart.where("id = centre_2").select("key", *[F.col(x).alias(f"{x}2") for x in others])
    stars = apart.join(second_row, "key").where(f"component <> component2 AND id <> centre AND {possible}")
    done = compared(stars.select(F.least("id", "centre_2").alias("a"), F.greatest("id", "centre_2").alias("b")))
    links = links.unionByName(links_of(done))
    found = materialize(components(links), "neardup_components")

    # last: what is still apart, each pair in the first bucket that it shares
    apart = _apart(apart.drop("component"), found)
    keys = apart.groupBy("id").agg(F.sort_array(F.collect_list("key")).alias("keys"))  # at most BANDS
    apart = materialize(apart.join(keys, "id"), "neardup_open")
    left = apart.select("key", F.col("id").alias("id2"), F.col("keys").alias("keys2"), *[F.col(x).alias(f"{x}2") for x in others])
    cross = apart.join(left, "key").where(
        "id < id2 AND component <> component2 AND id <> centre AND id <> centre_2 AND id2 <> centre AND id2 <> centre_2 "
        f"AND {possible} AND key = array_min(array_intersect(keys, keys2))"
    )
    links = links.unionByName(links_of(compared(cross.select(F.col("id").alias("a"), F.col("id2").alias("b")))))
    final = materialize(components(links), "neardup_components")

    by_rep = members.select("id", "rep").join(final.select(F.col("id").alias("rep"), "component"), "rep", "left")
    component = by_rep.groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("component"))
    out = rows.select("id", "n_shingles").join(component, "id", "left")
    found = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", found.alias("component_id"), F.coalesce(found == F.col("id"), F.lit(True)).alias("kept"))
