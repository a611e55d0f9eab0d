"""Language identification with error-correcting output codes.

Every language gets a codeword; for every bit a binary classifier over hashed
byte n-grams tells the languages with a 1 from those with a 0. A text's bits
are decoded to the codeword with the least weighted loss: each bit's margin
enters through a logistic loss, weighted by how well that bit did on that
language in training. A text whose two nearest codewords lie close together is
flagged as ambiguous.

``fit`` learns from at most about ``PER_LANGUAGE`` labelled rows of each
language (a documented bound; the rows are chosen by a hash of their id).
What it gathers is one vector of n-gram counts per language, of fixed size.
``predict`` reads whole texts; label, source and id never enter a prediction.

Defined results: a text that is null or has no letter is ``und`` with score 0;
so is every text if nothing could be learned; rows with a null label or a null
id are not learned from; a label that is the only one is predicted with score
1; repeated rows get equal results; an empty table gives an empty result; other
columns are kept only if named.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.session import materialize

PER_LANGUAGE = 6000
BUCKETS = 1 << 16
ORDERS = (2, 3, 4)
#: Bytes of text that are turned into n-grams at a time.
CHUNK = 1 << 19
#: Two nearest codewords closer than this make a text ambiguous.
AMBIGUOUS = 0.05
UNKNOWN = "und"

_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text))


def _bytes(text: str) -> np.ndarray:
    """Lower-cased bytes, ASCII other than letters as spaces, one space on either side."""
    return np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_LETTERS) + b" ", np.uint8)


def _grams(data: np.ndarray, order: int) -> np.ndarray:
    """Hashed n-grams of one order, one for each start."""
    n = len(data) - order + 1
    h = np.full(max(n, 0), order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(order):
        h = (h ^ data[k : k + n]) * np.uint32(0x01000193)
    return ((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(16)).astype(np.int64)


def gram_counts(text: str) -> np.ndarray:
    total = np.zeros(BUCKETS, np.int64)
    data = _bytes(text)
    for at in range(0, len(data), CHUNK):
        for order in ORDERS:
            total += np.bincount(_grams(data[at : at + CHUNK + order - 1], order), minlength=BUCKETS)
    return total


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """n codewords of +-1: all distinct splits up to five languages, else the
    best of seeded random codes by least distance between codewords."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= 5:
        columns = [c for c in itertools.product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(columns, np.int8).T
    bits, rng, best = int(np.ceil(10 * np.log2(n))), np.random.default_rng(seed), (-1, None)
    for _ in range(100):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        if (np.abs(code.sum(0)) == n).any():
            continue
        near = (code.astype(np.int32) @ code.T.astype(np.int32) - 2 * bits * np.eye(n, dtype=np.int32)).max()
        if (bits - near) // 2 > best[0]:
            best = ((bits - near) // 2, code)
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, +-1
    weights: np.ndarray  # BUCKETS x bits, log odds
    scale: np.ndarray  # bits, the usual size of a margin
    trust: np.ndarray  # languages x bits, rows add up to 1

    def margins(self, texts: Sequence[str]) -> np.ndarray:
        """Mean log odds of each text's n-grams, texts x bits, over whole texts."""
        total = np.zeros((len(texts), self.code.shape[1]))
        number = np.ones(len(texts))
        rows: list[int] = []
        datas: list[np.ndarray] = []
        for i, text in enumerate(texts):
            data = _bytes(text)
            number[i] = max(1, sum(max(len(data) - order + 1, 0) for order in ORDERS))
            if len(data) > CHUNK:
                for at in range(0, len(data), CHUNK):
                    for order in ORDERS:
                        total[i] += self.weights[_grams(data[at : at + CHUNK + order - 1], order)].sum(0, dtype=np.float64)
                continue
            if rows and sum(map(len, datas)) + len(data) > CHUNK:
                total[rows] = self._sums(datas)
                rows, datas = [], []
            rows.append(i)
            datas.append(data)
        if rows:
            total[rows] = self._sums(datas)
        return total / number[:, None]

    def _sums(self, datas: list[np.ndarray]) -> np.ndarray:
        """Summed log odds of several texts, laid end to end."""
        joined, ends = np.concatenate(datas), np.cumsum([len(d) for d in datas])
        starts, total = np.r_[0, ends[:-1]], 0.0
        for order in ORDERS:
            grams = _grams(joined, order)
            odds = np.zeros((len(joined), self.code.shape[1]), np.float32)
            odds[: len(grams)] = self.weights[grams]
            for k in range(1, order):  # n-grams that reach into the next text
                odds[np.maximum(ends - k, starts)] = 0
            total = total + np.add.reduceat(odds, starts, axis=0, dtype=np.float64)
        return total

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, score, ambiguous) of each row of mean margins."""
        z = 2 * (margins / self.scale)[:, None, :] * self.code[None]
        loss = (np.logaddexp(0, -z) * self.trust[None]).sum(2)
        order = np.argsort(loss, axis=1, kind="stable")
        best = order[:, 0]
        if loss.shape[1] == 1:
            return best, np.ones(len(best)), np.zeros(len(best), bool)
        likely = np.exp(-8 * (loss - loss.min(1, keepdims=True)))
        score = likely[np.arange(len(best)), best] / likely.sum(1)
        ahead = loss[np.arange(len(best)), order[:, 1]] - loss[np.arange(len(best)), best]
        return best, score, ahead < AMBIGUOUS


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(docs: DataFrame, id_col: str = "doc_id", per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, text): a stored sample of the rows that may be learned from, about
    ``per_language`` of each language, all of a language that has fewer."""
    known = docs.where(F.col("lang").isNotNull() & F.col(id_col).isNotNull() & F.col("text").isNotNull() & ~held_out(id_col))
    counts = known.groupBy("lang").count().collect()  # a row per language
    if not counts:
        return known.select("lang", "text").limit(0)
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, per_language / r["count"]))])
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return materialize(known.where(draw < F.element_at(share, F.col("lang"))).select("lang", "text"), "langid_sample")


def fit(sample: DataFrame) -> Model | None:
    """Learns the classifiers from (lang, text). One vector per language and one
    row of tallies per language come to the driver."""
    per_task = "lang string, bucket int, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if lang not in total:
                    total[lang] = np.zeros(BUCKETS, np.int64)
                total[lang] += gram_counts(text.as_py())
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["lang", "bucket", "n"])

    def vector(pdf: pd.DataFrame) -> pd.DataFrame:
        n = np.zeros(BUCKETS)
        n[pdf["bucket"].to_numpy()] = pdf["n"].to_numpy()
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "n": [n.astype("<f4").tobytes()]})

    # a group holds at most BUCKETS rows
    counted = sample.mapInArrow(count, per_task).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = {r["lang"]: np.frombuffer(bytes(r["n"]), "<f4").astype(float) for r in counted.groupBy("lang").applyInPandas(vector, "lang string, n binary").collect()}
    if not found:
        return None
    languages = sorted(found)
    p = np.array([(found[x] + 0.5) / (found[x].sum() + 0.5 * BUCKETS) for x in languages])
    code = codewords(len(languages))
    bits = code.shape[1]
    if len(languages) == 1:
        return Model(languages, code, np.zeros((BUCKETS, 1), np.float32), np.ones(1), np.ones((1, 1)))
    weights = np.stack([np.log(p[code[:, b] > 0].mean(0)) - np.log(p[code[:, b] < 0].mean(0)) for b in range(bits)], 1).astype(np.float32)
    model = Model(languages, code, weights, np.ones(bits), np.full(code.shape, 1 / bits))
    shared = sample.sparkSession.sparkContext.broadcast(model)  # languages x bits and BUCKETS x bits numbers

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        right, size, n = np.zeros(m.code.shape), np.zeros(m.code.shape), np.zeros(len(m.languages))
        for batch in batches:
            at = np.array([m.languages.index(x) for x in batch.column(0).to_pylist()], np.int64)
            for lo in range(0, len(at), 512):
                margins = m.margins([t.as_py() for t in batch.column(1).slice(lo, 512)])
                part = at[lo : lo + 512]
                np.add.at(right, part, margins * m.code[part] > 0)
                np.add.at(size, part, np.abs(margins))
                np.add.at(n, part, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(range(len(n)), bits), pa.int32()), pa.array(np.tile(range(bits), len(n)), pa.int32()), *(pa.array(x.ravel()) for x in (right, size, np.repeat(n, bits)))],
            names=["language", "bit", "right", "size", "n"],
        )

    tallied = sample.mapInArrow(tally, "language int, bit int, right double, size double, n double")
    rows = tallied.groupBy("language", "bit").agg(F.sum("right").alias("right"), F.sum("size").alias("size"), F.sum("n").alias("n")).collect()
    right, size, n = (np.zeros(code.shape) for _ in range(3))
    for r in rows:
        right[r["language"], r["bit"]], size[r["language"], r["bit"]], n[r["language"], r["bit"]] = r["right"], r["size"], r["n"]
    share = (right + 0.5) / (n + 1)
    return Model(languages, code, weights, np.maximum(size.sum(0) / np.maximum(n.sum(0), 1), 1e-9), share / share.sum(1, keepdims=True))


def predict(docs: DataFrame, model: Model | None, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred, score (0 to 1) and ambiguous for every row."""
    schema = T.StructType([docs.schema[c] for c in keep]).add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # a text that is kept goes to the tasks once
    sent = list(keep) if "text" in keep else [*keep, "text"]
    text_at = sent.index("text")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                batch = whole.slice(lo, 512)
                texts = batch.column(text_at).to_pylist()
                n = len(texts)
                lang, score, ambiguous = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n, bool)
                known = [i for i, t in enumerate(texts) if m is not None and has_letter(t)]
                if known:
                    best, sure, close = m.decode(m.margins([texts[i] for i in known]))
                    lang[known] = np.array(m.languages, object)[best]
                    score[known], ambiguous[known] = sure, close
                columns = [batch.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lang, pa.string()), pa.array(score), pa.array(ambiguous)], names=[f.name for f in schema.fields])

    return docs.select(*sent).mapInArrow(label, schema)
