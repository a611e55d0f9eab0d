"""Byte-level BPE of whole texts by overlapping chunks, and back.

A pre-token is a match of the vocabulary's pattern; each is merged by the ranks
on its own. A long text is cut into chunks of ``CHUNK`` code points that run
``OVERLAP`` further, dealt over the tasks:

1. Every chunk is pre-tokenised by itself from its first character on, which may
   lie inside a pre-token.
2. A match depends on what follows it only. So where a chunk and the one
   before both have a boundary, in the stretch that both hold, they agree from
   there on: the two are stitched at the first such place.
3. Chunks that share no boundary (one pre-token covers the whole stretch) are put
   together and pre-tokenised again as one, so nothing depends on the chunk's size.
4. The pieces between stitches are encoded, each by its distinct pre-tokens, and
   joined by text in order.

A text of one chunk needs no stitch and is encoded where it is read. Decoding
concatenates the raw bytes of the ids.

The pattern is matched by the ``regex`` module. It and the tokenizer's library may
come from different versions of Unicode: characters whose class (letter, number,
space) differs are found by asking the library, once in a worker, and replaced
for pre-tokenising only by others of the class the library sees.

Defined results: a null text counts as empty and gives no ids; strings of special
tokens are plain text; rows of equal id or text are encoded row by row; an
empty table gives an empty result; of other columns only the id is kept.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from claimlake.session import materialize

CHUNK, OVERLAP = 1 << 16, 1 << 10
#: A match looks at most this far beyond its end, so no boundary nearer to a cut is trusted.
MARGIN = 8
#: A worker's memory of pre-tokens is emptied at this number; it is only a memory.
MEMORY = 300_000
#: Text of one step in a task, in code points.
STEP = 1 << 20

#: Every class of the pattern with a character that stands for it; the last one for all others.
_CLASSES = ((r"\p{L}", "é"), (r"\p{N}", "1"), (r"\s", "\t"))
_OTHER = "#"

_loaded: dict[tuple, Codec] = {}


class Codec:
    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        # pre-tokens come one by one, so the library's pattern need not cut
        self.library = tiktoken.Encoding("whole", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.known: dict[str, bytes] = {}
        self._stand_ins: dict[int, str] | None = None

    def stand_ins(self) -> dict[int, str]:
        """Characters whose class differs between ``regex`` and the library, each
        with one that both put where the library puts it."""
        if self._stand_ins is None:
            import regex
            import tiktoken

            every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
            single = {bytes([i]): i for i in range(256)}
            classes = []
            for pattern, _ in _CLASSES:
                enc = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
                classes.append((set(bytes(enc.encode_ordinary(every)).decode()), set(regex.findall(pattern, every))))
            self._stand_ins = {}
            for theirs, ours in classes:
                for ch in theirs ^ ours:
                    seen = next((to for (t, _), (_, to) in zip(classes, _CLASSES, strict=True) if ch in t), _OTHER)
                    self._stand_ins[ord(ch)] = seen
        return self._stand_ins

    def pretokens(self, text: str) -> list[str]:
        """The pre-tokens of ``text``; together they are the text."""
        if text.isascii():
            return self.pattern.findall(text)
        seen = text.translate(self.stand_ins())
        parts = self.pattern.findall(seen)
        if seen == text:
            return parts
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return [text[lo:hi] for lo, hi in zip([0, *ends], ends, strict=False)]

    def encode(self, parts: list[str]) -> bytes:
        """Little-endian unsigned 32-bit ids of pre-tokens."""
        known = self.known
        try:
            return b"".join([known[p] for p in parts])
        except KeyError:
            return b"".join([known.get(p) or self._learn(p) for p in parts])

    def _learn(self, part: str) -> bytes:
        ids = array("I", self.library.encode_ordinary(part)).tobytes()
        if len(part) <= 100:
            if len(self.known) >= MEMORY:
                self.known.clear()
            self.known[part] = ids
        return ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join([self.bytes[i] for i in np.frombuffer(ids, "<u4").tolist()])


def codec(ranks_path: str, pattern: str) -> Codec:
    if (ranks_path, pattern) not in _loaded:
        _loaded[ranks_path, pattern] = Codec(ranks_path, pattern)
    return _loaded[ranks_path, pattern]


def starts(parts: list[str]) -> np.ndarray:
    """Where pre-tokens start, counted from the first, and where the last one ends."""
    return np.r_[0, np.cumsum([len(p) for p in parts], dtype=np.int64)] if parts else np.zeros(1, np.int64)


def _whole(docs: DataFrame, ranks: str, pattern: str, schema: T.StructType) -> DataFrame:
    """Ids of texts of one chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for batch in batches:
            lo, size, ids = 0, 0, []
            for at, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                ids.append(c.encode(c.pretokens(text)))
                size += len(text)
                if size >= STEP or at + 1 == batch.num_rows:
                    numbers = pa.array([len(x) // 4 for x in ids], pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(ids)), numbers, pa.array(ids, pa.binary())], names=schema.names)
                    lo, size, ids = at + 1, 0, []

    return docs.mapInArrow(run, schema)


def chunks(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, id, chunk, last, text) of (row, id, text); ``last`` marks a text's end."""
    schema = T.StructType([docs.schema["row"], docs.schema["id"]]).add("chunk", "integer").add("last", "boolean").add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, text in enumerate(batch.column("text")):
                text = text.as_py()
                n = -(-len(text) // chunk)
                for lo in range(0, n, 64):  # 64 chunks at a time
                    at_once = range(lo, min(n, lo + 64))
                    pieces = [text[i * chunk : (i + 1) * chunk + overlap] for i in at_once]
                    repeat = pa.array([at] * len(pieces))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row").take(repeat), batch.column("id").take(repeat), pa.array(at_once, pa.int32()), pa.array([i == n - 1 for i in at_once]), pa.array(pieces, pa.string())],
                        names=schema.names,
                    )

    return docs.select("row", "id", "text").mapInArrow(run, schema)


def _pretokenised(cut: DataFrame, ranks: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Adds a chunk's boundaries: all of them (``starts``), those in the stretch it
    shares with the chunk before (``left``) and with the next one (``right``),
    counted from the start of that stretch."""
    schema = T.StructType([*cut.schema.fields]).add("starts", "binary")
    schema = schema.add("left", T.ArrayType(T.IntegerType())).add("right", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                text = row.column("text")[0].as_py()
                found = starts(c.pretokens(text))
                # the text is cut before its end wherever the view is full
                sure = found if len(text) < chunk + overlap else found[found + MARGIN <= len(text)]
                left, right = sure[sure < overlap], sure[sure >= chunk] - chunk
                arrays = [pa.array([found.astype("<i4").tobytes()], pa.binary()), *[pa.array([x.tolist()], pa.list_(pa.int32())) for x in (left, right)]]
                yield pa.RecordBatch.from_arrays([*row.columns, *arrays], names=schema.names)

    return cut.mapInArrow(run, schema)


def stitches(edges: DataFrame, chunk: int) -> DataFrame:
    """(row, chunk, head, from, until, n) for (row, chunk, last, left, right): the run of
    chunks each one belongs to, known by its first; what the run has to encode, as
    code points from the start of its first chunk (``until`` null: to the end); and
    the run's number of chunks."""
    before = edges.select("row", (F.col("chunk") + 1).alias("chunk"), "right")
    met = edges.select("row", "chunk", "left").join(before, ["row", "chunk"], "left")
    meet = F.when(F.col("chunk") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("left", "right")))
    met = met.select("row", "chunk", meet.alias("meet"))
    # one text's chunks, a few numbers each: a text is a single value, so there are at most 2**31 / chunk
    by_text = Window.partitionBy("row").orderBy("chunk")
    upward = by_text.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = met.withColumn("head", F.max(F.when(F.col("meet").isNotNull(), F.col("chunk"))).over(upward))
    spans = runs.groupBy("row", "head").agg(F.max("meet").alias("from"), F.count("*").alias("n"))
    following = Window.partitionBy("row").orderBy("head")
    until = F.lead("from").over(following) + (F.lead("head").over(following) - F.col("head")) * chunk
    spans = spans.withColumn("until", until)
    return runs.select("row", "chunk", "head").join(spans, ["row", "head"]).select("row", "chunk", "head", F.col("from").cast("long"), F.col("until").cast("long"), "n")


def _encoded(pieces: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(row, id, head, ids) of (row, id, head, from, until, text, starts); without
    ``starts`` the text is pre-tokenised from ``from`` on."""
    schema = T.StructType([pieces.schema[c] for c in ("row", "id", "head")]).add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for batch in batches:
            ids = []
            for row in batch.select(["from", "until", "text", "starts"]).to_pylist():
                lo, hi, text = row["from"], row["until"], row["text"]
                hi = len(text) if hi is None else hi
                at = np.frombuffer(row["starts"], "<i4") if row["starts"] is not None else starts(c.pretokens(text[lo:])) + lo
                at = at[(at >= lo) & (at <= hi)].tolist()
                ids.append(c.encode([text[a:b] for a, b in zip(at, at[1:], strict=False)]))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in schema.names[:3]], pa.array(ids, pa.binary())], names=schema.names)

    return pieces.mapInArrow(run, schema)


def _long(docs: DataFrame, ranks: str, pattern: str, chunk: int, overlap: int, schema: T.StructType) -> DataFrame:
    """Ids of texts of several chunks, given as (id, text)."""
    numbered = docs.toDF("id", "text").withColumn("row", F.monotonically_increasing_id())
    cut = chunks(numbered, chunk, overlap).repartition("row", "chunk")  # one text's chunks go to many tasks
    held = materialize(_pretokenised(cut, ranks, pattern, chunk, overlap), "bpe-chunks")
    spans = stitches(held.select("row", "chunk", "last", "left", "right"), chunk)
    placed = held.select("row", "id", "chunk", "text", "starts").join(spans, ["row", "chunk"])
    columns = ["row", "id", "head", "from", "until", "text", "starts"]
    single = placed.where("n = 1").select(columns)
    # runs without a boundary between their chunks: all but the last give their own part only
    part = F.when(F.col("chunk") < F.col("head") + F.col("n") - 1, F.substring("text", 1, chunk)).otherwise(F.col("text"))
    merged = placed.where("n > 1").groupBy("row", "head").agg(
        F.first("id").alias("id"), F.first("from").alias("from"), F.first("until").alias("until"), F.sort_array(F.collect_list(F.struct("chunk", part.alias("part")))).alias("parts")
    )
    merged = merged.withColumn("text", F.array_join(F.col("parts")["part"], "")).withColumn("starts", F.lit(None).cast("binary"))
    pieces = _encoded(single.unionByName(merged.select(columns)), ranks, pattern)
    # the ids of one text, which was one value before
    gathered = pieces.groupBy("row").agg(F.first("id").alias("id"), F.sort_array(F.collect_list(F.struct("head", "ids"))).alias("parts")).select("id", F.col("parts")["ids"].alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, parts in enumerate(batch.column("parts")):
                ids = b"".join(parts.as_py())
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, 1), pa.array([len(ids) // 4], pa.int64()), pa.array([ids], pa.binary())], names=schema.names)

    return gathered.mapInArrow(run, schema)


def encode(docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids) of every whole text; ids as little-endian unsigned
    32-bit numbers. ``ranks`` is the path of the vocabulary's rank file, read in
    the tasks; ``pattern`` must match every character of a text in some pre-token
    and look no further than ``MARGIN`` beyond a match."""
    if not MARGIN <= overlap <= chunk:
        raise ValueError(f"the overlap must lie between {MARGIN} and the chunk's size")
    schema = T.StructType([docs.schema[id_col]]).add("n_tokens", "long").add("ids", "binary")
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    size = F.length("__text")
    return _whole(rows.where(size <= chunk), ranks, pattern, schema).unionByName(_long(rows.where(size > chunk), ranks, pattern, chunk, overlap, schema))


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Adds ``decoded``, the raw bytes of ``ids``."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for batch in batches:
            lo, size, out = 0, 0, []
            for at, ids in enumerate(batch.column("ids")):
                out.append(c.decode(ids.as_py()))
                size += len(out[-1])
                if size >= STEP or at + 1 == batch.num_rows:
                    part = batch.slice(lo, len(out))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=schema.names)
                    lo, size, out = at + 1, 0, []

    return encoded.mapInArrow(run, schema)
