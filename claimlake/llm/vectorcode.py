"""Codes of vectors by a codebook per part, with norm-of-sum bounds.

Vectors become integers, floor(scale * x), and are cut into equal consecutive
parts. A part position has a codebook of ``entries``; rounds assign every part to
its nearest entry (squared Euclidean distance, ties to the lower index) and
replace each entry by the floored mean of its parts.

Every part keeps an upper bound of the distance to its entry and a lower bound
to all others, each with the round in which it was exact. All earlier
codebooks are kept, so a bound moves by the norm of the sum of the entry's steps
since then, its net displacement, and not by the sum of their norms. Only where
the bounds meet is the own distance computed, and only if they still meet are all
entries scanned. Integer arithmetic decides; bounds are floating-point numbers,
widened by more than their rounding.

A round is one pass over the vectors, which stay where they are with their
bounds; sums by part and entry (a few numbers for each task) and the codebooks
(``parts * entries * width`` numbers) are all that moves. A lost executor's rows are
computed again from the table and the codebooks so far.

Defined results: rows whose vector is null or holds a null or non-finite
component are dropped; shorter vectors are filled up with zeros to the longest
one's width, and that to a multiple of ``parts``; integers are held between
-2**27 and 2**27; fewer rows than entries give a smaller codebook; of repeated
ids each row counts, the smaller vector first; a null id comes last; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.operators.relate import fits_broadcast
from claimlake.session import materialize

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
LIMIT = 1 << 27
#: Rows of one step in a task, and relative slack of a bound (float64 rounds at 1e-16).
ROWS, SLACK = 4096, 1e-9
#: Rows of a label in a shuffled join are dealt over this many keys.
SALTS = 32

_STATE = ("vector", "entry", "upper", "upper_round", "lower", "lower_round", "scans")
_TYPES = {"vector": "<i4", "entry": "u1", "upper": "<f8", "upper_round": "u1", "lower": "<f8", "lower_round": "u1", "scans": "u1"}


def _square(x: np.ndarray) -> np.ndarray:
    return np.einsum("...w,...w->...", x, x)


def _above(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64)) * (1 + SLACK)


def _below(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64)) * (1 - SLACK)


def scan(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry, its squared distance and that of the second nearest, for
    ``parts`` (n, width) against ``book`` (n, entries, width) or (entries, width)."""
    far = np.stack([_square(parts - book[..., k, :]) for k in range(book.shape[-2])], -1)
    best = far.argmin(-1)
    rows = np.arange(len(parts))
    nearest = far[rows, best]
    if far.shape[1] == 1:
        return best, nearest, np.full(len(parts), np.iinfo(np.int64).max)
    far[rows, best] = np.iinfo(np.int64).max
    return best, nearest, far.min(-1)


class Moves:
    """Net displacements from every kept round to the newest one."""

    def __init__(self, books: list[np.ndarray]):
        now = books[-1]
        self.of = np.stack([_above(_square(now - b)) for b in books])  # round, part, entry
        self.of[-1] = 0
        n = self.of.shape[-1]
        others = [np.delete(self.of, k, -1).max(-1) if n > 1 else np.zeros(self.of.shape[:2]) for k in range(n)]
        self.others = np.stack(others, -1)


def assign(state: dict[str, np.ndarray], books: list[np.ndarray], moves: Moves) -> None:
    """Brings entries and bounds of ``state`` (arrays of rows x parts) to the newest codebook."""
    now, new = len(books) - 1, books[-1]
    n, parts = state["entry"].shape
    place = np.broadcast_to(np.arange(parts), (n, parts))
    if now == 0:
        open_ = np.ones((n, parts), bool)
        lower = np.zeros((n, parts))
    else:
        lower = state["lower"] * (1 - SLACK) - moves.others[state["lower_round"], place, state["entry"]] * (1 + SLACK)
        upper = (state["upper"] + moves.of[state["upper_round"], place, state["entry"]]) * (1 + SLACK)
        open_ = ~(upper < lower)
        row, part = np.nonzero(open_)
        if len(row):  # the own distance is made exact first
            entry = state["entry"][row, part]
            own = _above(_square(state["vector"][row, part] - new[part, entry]))
            state["upper"][row, part], state["upper_round"][row, part] = own, now
            open_[row, part] = ~(own < lower[row, part])
    for p in range(parts):
        rows = np.flatnonzero(open_[:, p])
        if len(rows):
            best, near, second = scan(state["vector"][rows, p], new[p])
            state["entry"][rows, p] = best
            state["upper"][rows, p], state["lower"][rows, p] = _above(near), _below(second)
            state["upper_round"][rows, p] = state["lower_round"][rows, p] = now
            state["scans"][rows, p] += 1


def _unpack(batch: pa.RecordBatch, parts: int) -> dict[str, np.ndarray]:
    out = {}
    for name in _STATE:
        flat = np.frombuffer(b"".join(batch.column(name).to_pylist()), _TYPES[name])
        out[name] = flat.reshape(batch.num_rows, parts, -1).astype(np.int64) if name == "vector" else flat.reshape(batch.num_rows, parts).copy()
    return out


def _pack(state: dict[str, np.ndarray]) -> list[pa.Array]:
    return [pa.array([row.tobytes() for row in state[name].astype(_TYPES[name])], pa.binary()) for name in _STATE]


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            yield batch.slice(lo, ROWS)


def integers(vectors: list[list[float]], parts: int, width: int) -> np.ndarray:
    """(rows, parts, width) of floor(SCALE * x), filled up with zeros."""
    out = np.zeros((len(vectors), parts * width))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    with np.errstate(over="ignore"):
        return np.clip(np.floor(out * SCALE), -LIMIT, LIMIT).astype(np.int64).reshape(len(vectors), parts, width)


def _first_round(rows: DataFrame, book: np.ndarray) -> DataFrame:
    parts, _, width = book.shape
    schema = T.StructType([rows.schema["id"], rows.schema["label"], *[T.StructField(n, T.BinaryType()) for n in _STATE]])
    moves = Moves([book])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            n = batch.num_rows
            state = {name: np.zeros((n, parts), _TYPES[name]) for name in _STATE}
            state["vector"] = integers(batch.column("embedding").to_pylist(), parts, width)
            assign(state, [book], moves)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), *_pack(state)], names=schema.names)

    return rows.mapInArrow(run, schema)


def _next_round(state_rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    parts, books, moves = books[0].shape[0], list(books), Moves(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            state = _unpack(batch, parts)
            assign(state, books, moves)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), *_pack(state)], names=batch.schema.names)

    return state_rows.mapInArrow(run, state_rows.schema)


def _moved_book(state_rows: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebook of floored means; entries without parts stay."""
    parts, entries, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(book.shape, np.int64), np.zeros(book.shape[:2], np.int64)
        for batch in _steps(batches):
            state = _unpack(batch, parts)
            for p in range(parts):
                np.add.at(sums[p], state["entry"][:, p], state["vector"][:, p])
                counts[p] += np.bincount(state["entry"][:, p], minlength=entries)
        used = counts[..., None] * np.ones(width, np.int64)
        at = np.flatnonzero(used.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums.ravel()[at]), pa.array(used.ravel()[at])], names=["at", "total", "n"])

    # parts * entries * width rows from each task, summed in Spark; that many numbers come back
    found = state_rows.mapInArrow(run, "at long, total long, n long").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()
    new = book.copy().ravel()
    for r in found:
        new[r["at"]] = int(r["total"]) // r["n"]
    return new.reshape(book.shape)


def train(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
          parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, codes, error, scans) of every kept row, stored in the shared folder,
    and the codebooks of all rounds, the last one final. ``codes`` holds one byte
    for each part; ``scans`` how often all entries were scanned."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = rows.where(F.col("embedding").isNotNull() & finite)
    longest = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "embedding").limit(entries).collect()
    first = integers([r["embedding"] for r in seeds], parts, width)
    books = [np.ascontiguousarray(first.transpose(1, 0, 2))]
    out_type = T.StructType([rows.schema["id"], rows.schema["label"]]).add("codes", "binary").add("error", "long").add("scans", "integer")
    if not seeds:
        return rows.sparkSession.createDataFrame([], out_type), books
    state = _first_round(rows, books[0]).persist(StorageLevel.MEMORY_AND_DISK)
    for _ in range(rounds):
        books.append(_moved_book(state, books[-1]))
        later = _next_round(state, books).persist(StorageLevel.MEMORY_AND_DISK)
        later.count()  # filled from the rows of the round before, which can go then
        state.unpersist()
        state = later
    final = books[-1]

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            s = _unpack(batch, parts)
            error = sum(_square(s["vector"][:, p] - final[p][s["entry"][:, p]]) for p in range(parts))
            codes = pa.array([row.tobytes() for row in s["entry"]], pa.binary())
            scans = pa.array(s["scans"].sum(1), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), codes, pa.array(error, pa.int64()), scans], names=out_type.names)

    done = materialize(state.mapInArrow(close, out_type), "vector-codes")
    state.unpersist()
    return done, books


def books_sha256(book: np.ndarray) -> str:
    """SHA-256 of all components, decimal, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def label_errors(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error summed over rows of equal label (nulls together)."""
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    sums = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"))
    sums = sums.withColumnRenamed("label", "__label")
    if fits_broadcast(sums):
        return coded.join(F.broadcast(sums), coded["label"].eqNullSafe(sums["__label"])).drop("__label")
    # too many labels to send: a label's rows, perhaps a third of all, are dealt over SALTS keys
    salted = coded.withColumn("__salt", F.pmod(F.xxhash64("id", "codes"), F.lit(SALTS)))
    sums = sums.withColumn("__to", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(sums, salted["label"].eqNullSafe(sums["__label"]) & (salted["__salt"] == sums["__to"])).drop("__salt", "__to", "__label")
