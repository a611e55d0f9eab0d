"""Removal of repeated lines, exact and near, by a deletion-neighbourhood join.

Lines are compared as sequences of words (cut at ASCII white space). The edit
distance counts words inserted, deleted or replaced; lines of ``FUZZY_WORDS`` or
more are equal within ``BOUND`` = 1 edit, shorter ones only if all words agree.
Lines of fewer than ``least_words`` words are never removed: ``LEAST_WORDS`` by
default; the queries pass 1, so that every line with a word counts. A line goes
if an equal line comes earlier; the earliest stays. Order: document id (null
first), a hash of the row, line number.

1. Every distinct line is reduced to a hash with its earliest place.
2. A near pair agrees in its first or in its second half, so only distinct lines
   that share a half with another one go on; no pair is lost by that.
3. Of these, every variant with one word deleted is emitted as a hashed key:
   with its place and the line's length, so that equal keys mean one replaced
   word, and without, to meet lines that are one word shorter. Each key keeps
   its earliest line only, so a key of many lines gives as many rows as lines
   and never their pairs.
4. The earliest such line is the witness; the distance between both lines'
   words is verified, then the later line is marked.
5. Marked lines, and repeats of equal lines, are taken out of the texts.

On demand every document also tells how many words it keeps, and how many of its
distinct lines' words went because another document has them earlier (not those
that repeat a line of its own): a near copy keeps few and lost many.

Defined results: null texts stay null, empty texts and empty lines stay; rows of
equal id and text are one document (they lose the same lines); a document
that loses all its lines keeps an empty text; an empty table gives an empty
result; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.session import materialize

LEAST_WORDS = 5
FUZZY_WORDS = 10
BOUND = 1

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hash(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


def half_keys(words: list[bytes]) -> list[int]:
    """Keys of the halves that a line shares with every line within one edit."""
    n = len(words)
    ahead = {n // 2, (n - 1) // 2}
    behind = {n // 2, n - n // 2}
    return [_hash([b"<", *words[:p]]) for p in sorted(ahead)] + [_hash([b">", *words[n - s :]]) for s in sorted(behind)]


def _few(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, which bound what a task holds and gives back at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _row() -> Column:
    return F.xxhash64("_id", "text")


def _lines(docs: DataFrame, with_keys: bool, least_words: int) -> DataFrame:
    """(h, id, row, line, and half keys) of every line that can be removed."""
    schema = T.StructType([T.StructField("h", T.LongType()), docs.schema["_id"], T.StructField("row", T.LongType()), T.StructField("line", T.IntegerType())])
    if with_keys:
        schema = schema.add("keys", T.ArrayType(T.LongType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            at, h, line, keys = [], [], [], []
            for i, text in enumerate(batch.column(2)):
                for k, x in enumerate(text.as_py().split("\n")):
                    words = x.encode("utf-8", "surrogatepass").split()
                    if len(words) >= least_words:
                        at.append(i)
                        h.append(_hash(words))
                        line.append(k)
                        if with_keys:
                            keys.append(half_keys(words) if len(words) >= FUZZY_WORDS else [])
            where = pa.array(at, pa.int64())
            columns = [pa.array(h, pa.int64()), batch.column(0).take(where), batch.column(1).take(where), pa.array(line, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(keys, pa.list_(pa.int64()))] if with_keys else []), names=schema.names)

    return docs.where("text IS NOT NULL").select("_id", _row().alias("row"), "text").mapInArrow(cut, schema)


def deletion_keys(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all variants with one word deleted: (by content, by content and
    place). Sums over prefixes and suffixes make it linear in the line."""
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    n = len(h)
    power = np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE)].astype(np.uint64))
    before = np.r_[np.uint64(0), np.cumsum(h * power[:n])]  # words ahead of each place
    after = np.r_[np.cumsum((h * power[np.maximum(np.arange(n), 1) - 1])[::-1])[::-1], np.uint64(0)]  # moved up by one
    content = before[:n] + after[1:]
    place = (content ^ np.arange(n, dtype=np.uint64)) * _BASE + np.uint64(n)
    return content, place ^ (place >> np.uint64(29))


def full_key(words: list[bytes]) -> np.uint64:
    """The content hash of the whole line, as ``deletion_keys`` gives it for a variant."""
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    power = np.cumprod(np.r_[np.uint64(1), np.full(len(h), _BASE)].astype(np.uint64))
    return (h * power[: len(h)]).sum()


def within_bound(a: list[bytes], b: list[bytes]) -> bool:
    """Whether the word edit distance is at most ``BOUND`` = 1."""
    if abs(len(a) - len(b)) > BOUND:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :] or a == b


def _variants(lines: DataFrame) -> DataFrame:
    """(v, tag, h): tags P (by place), D (one word deleted) and W (whole line)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, tag, at = [], [], []
            for i, text in enumerate(batch.column(1)):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                content, place = deletion_keys(words)
                content = np.unique(content)  # deleting either of two equal neighbours
                v += [place, content, np.array([full_key(words)], np.uint64)]
                tag += [np.full(len(place), 0), np.full(len(content), 1), np.array([2])]
                at.append(np.full(len(place) + len(content) + 1, i))
                if len(at) >= 500:
                    yield _batch(batch, v, tag, at)
                    v, tag, at = [], [], []
            if at:
                yield _batch(batch, v, tag, at)

    def _batch(batch: pa.RecordBatch, v: list, tag: list, at: list) -> pa.RecordBatch:
        keys = np.concatenate(v).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(np.concatenate(tag).astype(np.int8)), batch.column(0).take(pa.array(np.concatenate(at)))], names=["v", "tag", "h"]
        )

    return lines.select("h", "line_text").mapInArrow(emit, "v long, tag byte, h long")


def _candidate_lines(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Stored (h, first, line_text) of the distinct lines that share a half with another one."""
    halves = firsts.where(F.size("keys") > 0).select("h", F.explode("keys").alias("key"))
    shared = halves.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    wanted = halves.join(shared, "key", "left_semi").select("h").distinct()
    places = firsts.join(wanted, "h", "left_semi").select("first.row", F.struct("h", "first.line", "first").alias("at"))
    places = materialize(places.groupBy("row").agg(F.collect_list("at").alias("at")), "linededup_places")  # lines of one text
    text = docs.where("text IS NOT NULL").select(_row().alias("row"), "text").join(places, "row")
    # a repeated row would give its lines again
    lines = text.select(F.split("text", "\n", -1).alias("lines"), F.explode("at").alias("at")).select("at.h", "at.first", F.get("lines", F.col("at.line")).alias("line_text"))
    return materialize(lines.dropDuplicates(["h"]), "linededup_candidates")


def near_repeats(docs: DataFrame, firsts: DataFrame, sources: bool = False) -> DataFrame:
    """(h) of the distinct lines that have an earlier line within the bound;
    with ``sources`` also the row of that line, ``source``."""
    lines = _candidate_lines(docs, firsts)
    variants = _variants(lines)
    meet = variants.groupBy("v").agg(F.min("h").alias("x"), F.max("h").alias("y")).where("x <> y").select("v")
    met = variants.join(meet, "v", "left_semi").join(lines.select("h", "first"), "h")
    met = materialize(met, "linededup_variants")
    pick = lambda tag: F.min(F.when(F.col("tag") == tag, F.struct("first", "h")))
    by_key = met.groupBy("v").agg(pick(0).alias("p"), pick(1).alias("d"), pick(2).alias("w"))
    other = F.when(F.col("tag") == 0, F.col("p")).when(F.col("tag") == 1, F.col("w")).otherwise(F.col("d"))
    # the earliest of each key decides; lines meet a key only with their own tag's partner
    found = met.join(by_key, "v").withColumn("other", other).where(F.col("other.first") < F.col("first"))
    own = ["source"] if sources else []
    witness = found.groupBy("h").agg(F.min("other").alias("other")).select("h", F.col("other.h").alias("h2"), *[F.col("other.first.row").alias(c) for c in own])
    pairs = witness.join(lines.select("h", "line_text"), "h").join(lines.select(F.col("h").alias("h2"), F.col("line_text").alias("text_2")), "h2")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            words = [[x.as_py().encode("utf-8", "surrogatepass").split() for x in batch.column(c)] for c in (1, 2)]
            near = pa.array([within_bound(a, b) for a, b in zip(*words, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(near) for c in (0, *range(3, 3 + len(own)))], names=["h", *own])

    return pairs.select("h", "line_text", "text_2", *own).mapInArrow(verify, ", ".join(f"{c} long" for c in ("h", *own)))


def _words(lines: Iterable[str]) -> int:
    """Words of the distinct lines, a line's words at a time."""
    seen, total = set(), 0
    for line in lines:
        words = line.encode("utf-8", "surrogatepass").split()
        key = xxhash.xxh3_128_digest(b" ".join(words))
        if key not in seen:
            seen.add(key)
            total += len(words)
    return total


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", least_words: int = LEAST_WORDS, count_words: bool = False) -> DataFrame:
    """The documents with repeated lines taken out of ``text``, and n_lines
    (lines before) and n_removed (lines taken out). Lines of fewer than
    ``least_words`` words stay; empty lines always do. With ``count_words`` also
    n_words_left and n_words_elsewhere (words of the distinct lines that are left,
    and of those that another document has earlier), 0 where no line went."""
    least_words = max(1, least_words)
    source = docs.select(F.col(id_col).alias("_id"), "text")
    place = F.struct(F.col("_id").alias("id"), "row", "line")
    firsts = _lines(source, True, least_words).groupBy("h").agg(F.min(place).alias("first"), F.first("keys").alias("keys"))
    firsts = materialize(firsts, "linededup_firsts")
    near = near_repeats(source, firsts, count_words).withColumn("near", F.lit(True))
    known = firsts.select("h", "first").join(near, "h", "left")
    repeats = _lines(source, False, least_words).join(known, "h").where(F.coalesce("near", F.lit(False)) | ~place.eqNullSafe(F.col("first")))
    lists = [F.sort_array(F.collect_set("line")).alias("removed")]
    if count_words:
        lists.append(F.collect_set(F.when(F.coalesce("source", F.col("first.row")) != F.col("row"), F.col("line"))).alias("elsewhere"))
    removed = materialize(repeats.groupBy("row").agg(*lists), "linededup_removed")

    columns = docs.columns
    renamed = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    text = f"c{columns.index('text')}"
    joined = renamed.withColumn("row", F.xxhash64(f"c{columns.index(id_col)}", text)).join(removed, "row", "left")
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.IntegerType()), T.StructField("n_removed", T.IntegerType())])
    counts = ["n_words_left", "n_words_elsewhere"] if count_words else []
    for c in counts:
        schema = schema.add(c, T.LongType())

    others = [c for c in renamed.columns if c != text]
    whole = T.StructType([*(renamed.schema[c] for c in others), *schema.fields])

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            texts, before, out, words = [], [], [], [[] for _ in counts]
            for i, (text, gone) in enumerate(zip(batch.column(len(others)), batch.column(len(others) + 1), strict=True)):
                t, g = text.as_py(), gone.as_py()
                lines = t.split("\n") if t is not None else []
                drop = set(g or ())
                texts.append("\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else t)
                before.append(len(lines))
                out.append(len(drop))
                if counts:
                    away = batch.column(len(others) + 2)[i].as_py() or ()
                    words[0].append(_words(x for k, x in enumerate(lines) if k not in drop) if drop else 0)
                    words[1].append(_words(lines[k] for k in away))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(others))), pa.array(texts, pa.string()), pa.array(before, pa.int32()), pa.array(out, pa.int32()), *(pa.array(w, pa.int64()) for w in words)],
                names=whole.names,
            )

    rebuilt = joined.select(*others, text, "removed", *(["elsewhere"] if count_words else [])).mapInArrow(rebuild, whole)
    back = [F.col("text") if c == "text" else F.col(f"c{i}").alias(c) for i, c in enumerate(columns)]
    return rebuilt.select(*back, *[F.col(n) for n in ("n_lines", "n_removed", *counts)])
