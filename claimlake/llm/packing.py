"""Packing token pieces into sequences by best fit and a swap-based local search.

``pieces`` tokenises whole texts and cuts only what is longer than a sequence:
the first piece takes the remainder, the others fill a sequence each. Full
pieces need no search. The others are dealt by a hash of the row into blocks of
about ``BLOCK`` pieces, whatever the sizes of groups and keys, and each block is
packed in its task: best fit by decreasing length, then a local search that
moves a piece, exchanges one for one or two for one between underfull sequences
as long as the sum of squared fills grows, so that the least filled sequences
empty (``SWEEPS`` bounds the effort of this search, not what is packed). What is left underfull in the blocks is gathered from ``MERGE`` blocks
and packed again.

Defined results: a null text counts as empty, an empty document is its end
token alone; repeated rows are packed one by one; a null id is a value like any
other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.llm.bytebpe import encoder
from claimlake.session import materialize

END = 2
BLOCK = 2048
MERGE = 64
#: Sequences filled less than this share are packed again across blocks.
AGAIN = 0.97
#: Effort of the local search: passes over the underfull bins, and how many of
#: the least filled ones a pass tries to empty.
SWEEPS = 24
GIVERS = 3


def pieces(docs: DataFrame, vocabulary: str, ranks: str, most: int = 1024, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, and ids as little-endian bytes if
    asked for) for every whole text and its end token."""
    id_type = docs.schema[id_col].dataType
    fields = [
        T.StructField(id_col, id_type),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if with_ids else []),
    ]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, ranks)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = enc.encode(text.as_py() or "") + end
                n, at, k = len(ids) // 4, 0, 0
                while at < n:
                    to = at + ((n - at) % most or most)
                    part = ids[4 * at : 4 * to]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(to - at)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        kept.append(part)
                    at, k = to, k + 1
            columns = [
                batch.column(0).take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                *(pa.array(c, pa.int64()) for c in (start, length, crc)),
                *([pa.array(kept, pa.binary())] if with_ids else []),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])
        enc.forget()  # the worker goes on to other work

    return docs.select(id_col, "text").mapInArrow(cut, T.StructType(fields))


def best_fit(lengths: Sequence[int], most: int) -> list[list[int]]:
    """Bins of item numbers: by decreasing length, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(most + 1)]
    rooms = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = most, len(bins)
            bins.append([i])
        by_room[room - n].append(b)
        rooms |= 1 << (room - n)
    return bins


def _exchange(giver: list[int], taker: list[int], room: int, lengths: Sequence[int]) -> tuple[int, list[int], list[int]]:
    """The move, 1:1 or 2:1 exchange that fills the taker most: (gain, out of giver, out of taker)."""
    best: tuple[int, list[int], list[int]] = (0, [], [])
    # pieces of one length are the same move
    giver = list({lengths[x]: x for x in giver}.values()) if len(giver) > 24 else giver
    taker = list({lengths[y]: y for y in taker}.values())
    outs = [[x] for x in giver] + [[x, y] for k, x in enumerate(giver) for y in giver[k + 1 :]]
    for out in outs:
        n = sum(lengths[x] for x in out)
        if best[0] < n <= room and len(out) == 1:
            best = (n, out, [])
        for y in taker:
            gain = n - lengths[y]
            if best[0] < gain <= room:
                best = (gain, out, [y])
        if best[0] == room:
            break
    return best


def local_search(bins: list[list[int]], lengths: Sequence[int], most: int, sweeps: int = SWEEPS) -> list[list[int]]:
    """Empties the least filled bins. Every step moves fill from a bin to one
    that is at least as full, so the sum of squared fills grows. Ends when the
    bins are as few as their total allows, when the least filled ones offer no
    step, or after ``sweeps`` passes over the underfull bins."""
    fills = [sum(lengths[i] for i in b) for b in bins]
    least = -(-sum(fills) // most)
    count = len(bins)
    open_bins = [b for b in range(len(bins)) if fills[b] < most]
    for _ in range(sweeps):
        if count <= least:
            break
        open_bins = sorted((b for b in open_bins if bins[b] and fills[b] < most), key=lambda b: (fills[b], b))
        moved = False
        for giver in open_bins[:GIVERS]:
            for taker in reversed(open_bins):
                if taker == giver or fills[taker] >= most or fills[taker] < fills[giver]:
                    continue
                gain, out, back = _exchange(bins[giver], bins[taker], most - fills[taker], lengths)
                if not gain:
                    continue
                bins[giver] = [i for i in bins[giver] if i not in out] + back
                bins[taker] = [i for i in bins[taker] if i not in back] + out
                fills[giver] -= gain
                fills[taker] += gain
                moved = True
                if not bins[giver]:
                    count -= 1
                    break
            if not bins[giver]:
                break
        if not moved:
            break
    return [b for b in bins if b]


def pack_lengths(lengths: Sequence[int], most: int) -> list[list[int]]:
    return local_search(best_fit(lengths, most), lengths, most)


def _packed(df: DataFrame, group: str, most: int, turn: int) -> DataFrame:
    """Packs every group; sequence ids are unique by group and turn."""
    schema = T.StructType([f for f in df.schema.fields if f.name not in ("sequence_id", "offset", "fill")])
    schema = schema.add("sequence_id", "long").add("offset", "long").add("fill", "long")
    names = [f.name for f in schema.fields]

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row"], ascending=False, kind="stable")
        lengths = pdf["length"].tolist()
        sequence, offset, fill = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        base = int(pdf[group].iloc[0]) * 4 * BLOCK * MERGE
        for k, items in enumerate(pack_lengths(lengths, most)):
            sizes = [lengths[i] for i in items]
            sequence[items] = (base + k) * 4 + turn
            offset[items] = np.cumsum([0, *sizes[:-1]])
            fill[items] = sum(sizes)
        return pdf.assign(sequence_id=sequence, offset=offset, fill=fill)[names]

    return df.groupBy(group).applyInPandas(pack, schema)


def pack(cut: DataFrame, most: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to pieces. They are stored once, so that
    neither the tokens nor the dealing into blocks are made twice."""
    cut = materialize(
        cut.withColumn("number", F.monotonically_increasing_id()).withColumn("row", F.xxhash64(*cut.columns[:2], "number")), "pack_pieces"
    )
    part = F.col("length") < most
    n = cut.where(part).count()
    # of a length as of now: about BLOCK pieces a block at any size of the input
    blocks = max(1, n // BLOCK)
    dealt = cut.where(part).withColumn("block", F.pmod("row", F.lit(blocks)))
    first = materialize(_packed(dealt, "block", most, 0), "pack_blocks")
    short = F.col("fill") < int(AGAIN * most)
    rest = first.where(short).withColumn("block", F.expr(f"block div {MERGE}"))
    again = _packed(rest, "block", most, 1)
    full = cut.where(~part).withColumns({"sequence_id": F.col("number") * 4 + 2, "offset": F.lit(0).cast("long")})
    columns = [c for c in cut.columns if c not in ("number", "row")] + ["sequence_id", "offset"]
    return first.where(~short).select(columns).unionByName(again.select(columns)).unionByName(full.select(columns))
