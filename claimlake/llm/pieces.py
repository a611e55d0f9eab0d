"""Sampled segmentations of whole texts over a SentencePiece vocabulary.

All segmentations of a text form a lattice whose paths have probabilities
proportional to exp(alpha x the sum of the pieces' scores). ``sample`` gives the
k segmentations with the largest Gumbel-perturbed log probabilities, which is
sampling k of them without replacement. They are found by a best-first search:
a path's perturbed value bounds everything below it, so the first path is drawn
top down, every choice on it keeps the perturbed maximum of what it left out,
and the largest of those values is where the next path branches off. The value
of the (k+1)th, not expanded, is the threshold of the inclusion scores
1 - exp(-exp(log_prob - threshold)).

No piece goes over the start of a word, so the lattice of a text is the chain of
its words' lattices; a task makes the lattice of a distinct word once and keeps
it, up to a bound. The ways of all texts of a batch are drawn together.
Random numbers are hashes of the row key, the number of the path and the place
in the text: a row's samples don't depend on what it is processed with.

``decode`` gives the text back. Characters without a piece of their own are
written as byte pieces, as are U+2581 characters, so that every text returns.

Defined results: a null or empty text has one segmentation, the empty one; a
text with fewer than k segmentations gives all of them, with inclusion 1;
repeated rows give equal samples; a null key is a key like any other; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALPHA = 0.0003
GAP = "▁"
_UNIT = re.compile(f"{GAP}+[^{GAP}\n]*|[^{GAP}\n]+|\n")
#: Characters of text that are segmented at a time.
CHUNK = 1 << 20
#: Edges of distinct words (28 bytes each) beyond which a task forgets its words before the next texts.
CACHE = 1 << 21

_U = np.uint64
_STEP, _SPREAD = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
#: Stands for a U+2581 of the text; a lone surrogate can't be in one.
_MARK = 0xD800
_loaded: dict[tuple[str, float], Vocabulary] = {}


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _hash(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(_STEP) + (ord(c) + 1) * int(_SPREAD)) & 0xFFFFFFFFFFFFFFFF
    return h


class Vocabulary:
    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces: list[tuple[int, str]] = []
        self.bytes = [0] * 256
        self.text: list[bytes] = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.text.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text.append(b"")
            else:
                pieces.append((i, piece))
                self.text.append(piece.replace(GAP, " ").encode())
        self.longest = max(len(x) for _, x in pieces)
        hashes = np.array([_hash(x) for _, x in pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.ids_of = np.array([i for i, _ in pieces], np.int64)[order]
        self.weight = np.array([alpha * model.get_score(i) for i, _ in pieces])[order]
        self.size = np.array([len(x) for _, x in pieces])[order]
        self.codes = np.zeros((len(pieces), self.longest), np.uint32)
        for row, k in enumerate(order):
            self.codes[row, : self.size[row]] = _codes(pieces[k][1])
        # beginnings of pieces, to stop looking for longer ones; a false hit is harmless
        self.begins = np.zeros(1 << 22, bool)
        for x in {x[:n] for _, x in pieces for n in range(1, len(x) + 1)}:
            self.begins[_hash(x) >> 42] = True
        self.wholes = np.zeros(1 << 22, bool)
        self.wholes[self.hashes >> _U(42)] = True

    def edges(self, codes: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, payload, weight) of every piece in the words, sorted by
        start, long ones first; ``left`` is the distance from each character to its word's end."""
        at, h = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        start, length, payload, weight = [], [], [], []
        alone = np.ones(len(codes), bool)
        for n in range(1, self.longest + 1):
            h = h * _STEP + (codes[at + n - 1].astype(np.uint64) + _U(1)) * _SPREAD
            short = (h >> _U(42)).astype(np.int64)
            may = np.flatnonzero(self.begins[short])
            at, h = at[may], h[may]
            whole = np.flatnonzero(self.wholes[short[may]])
            where, wanted = at[whole], h[whole]
            k = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
            hit = np.flatnonzero((self.hashes[k] == wanted) & (self.size[k] == n))
            k, where = k[hit], where[hit]
            for c in range(n):
                same = codes[where + c] == self.codes[k, c]
                if not same.all():
                    k, where = k[same], where[same]
            if n == 1:
                alone[where] = False
            start.append(where)
            length.append(np.full(len(where), n))
            payload.append(self.ids_of[k])
            weight.append(self.weight[k])
            go = np.flatnonzero(left[at] > n)
            at, h = at[go], h[go]
        bare = np.flatnonzero(alone)
        c = codes[bare].astype(np.int64)
        start.append(bare)
        length.append(np.ones(len(bare), np.int64))
        payload.append(np.where(c < 128, np.array(self.bytes, np.int64)[np.minimum(c, 127)], np.where(c == _MARK, -1 - ord(GAP), -1 - c)))
        weight.append(np.zeros(len(bare)))
        start, length, payload, weight = (np.concatenate(x[::-1]) for x in (start, length, payload, weight))
        order = np.argsort(start, kind="stable")
        return start[order], length[order], payload[order], weight[order]

    def units(self, text: str) -> list[str]:
        """The words of the text as the vocabulary writes them, with the space that it puts ahead."""
        if not text:
            return []
        if GAP in text:  # a piece's mark, here an ordinary character: units of its own
            cut = [x for i, part in enumerate(text.split(GAP)) for x in ([None] if i else []) + [part]]
            out: list[str] = []
            for i, part in enumerate(cut):
                out += [chr(_MARK)] if part is None else _UNIT.findall((GAP if i == 0 else "") + part.replace(" ", GAP))
            return out
        return _UNIT.findall(GAP + text.replace(" ", GAP))

    def ids(self, payload: np.ndarray) -> bytes:
        if (payload >= 0).all():
            return payload.astype("<u4").tobytes()
        out: list[int] = []
        for x in payload.tolist():
            out += [x] if x >= 0 else [self.bytes[b] for b in chr(-1 - x).encode("utf-8", "surrogatepass")]
        return np.array(out, "<u4").tobytes()

    def decode(self, ids: bytes) -> str:
        text = self.text
        raw = b"".join(map(text.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "surrogatepass")


def vocabulary(path: str, alpha: float) -> Vocabulary:
    if (path, alpha) not in _loaded:
        _loaded[path, alpha] = Vocabulary(path, alpha)
    return _loaded[path, alpha]


def _uniform(seeds: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit seeds."""
    x = (seeds ^ (seeds >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return (((x ^ (x >> _U(31))) >> _U(11)).astype(np.float64) + 0.5) / 9007199254740992.0


def _stream(seed: int, path: int, kind: int, place: np.ndarray) -> np.ndarray:
    base = (seed + path * 0x9E3779B97F4A7C15 + kind * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF
    return place.astype(np.uint64) * _U(0x2545F4914F6CDD1D) + _U(base)


class _Numbers(dict):
    """Words in the order in which they are first met."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Lattices:
    """The lattices of distinct words, joined to arrays that grow with new words.
    A node's edges lie together, those of long (likely) pieces first; ``upto`` sums
    their probabilities up to each, with infinity at the node's last one."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.clear()

    def clear(self) -> None:
        self.words, self.known = _Numbers(), 0
        self.root, self.first, self.many, self.node, self.target, self.payload = (np.zeros(0, np.int32) for _ in range(6))
        self.p, self.upto = np.zeros(0), np.zeros(0)

    def out_of(self, node: int) -> range:
        return range(self.first[node], self.first[node] + self.many[node])

    def add(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the texts' words in a row, where each text's words end)."""
        if len(self.node) > CACHE:
            self.clear()
        of_text = [list(map(self.words.__getitem__, self.vocab.units(text))) for text in texts]
        if len(self.words) > self.known:
            self._build(list(itertools.islice(self.words, self.known, None)))
            self.known = len(self.words)
        ends = np.cumsum([len(x) for x in of_text])
        return np.fromiter(itertools.chain.from_iterable(of_text), np.int64, int(ends[-1])), ends

    def _build(self, words: list[str]) -> None:
        sizes = np.array([len(u) for u in words], np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1])  # a node for each character
        left = np.repeat(ends, sizes) - np.arange(total)
        start, length, payload, weight = self.vocab.edges(_codes("".join(words)), left)
        # nodes of all words at once, by their distance from the end (short numbers sort faster)
        far = left.astype(np.uint16) if left.max() < 1 << 16 else left
        by_node, by_edge = np.argsort(far, kind="stable"), np.argsort(far[start], kind="stable")
        start, length, payload, weight = start[by_edge], length[by_edge], payload[by_edge], weight[by_edge]
        target = np.where(length < left[start], start + length, -1)
        many = np.bincount(start, minlength=total)[by_node]
        first = np.cumsum(many) - many
        p = np.zeros(len(start))
        beta = np.zeros(total + 1)  # log of the weight of all ways on; the last is the end's
        lo = e_lo = 0
        for n in np.bincount(left)[1:]:
            m, at = many[lo : lo + n], first[lo : lo + n] - e_lo
            edges = slice(e_lo, e_lo + int(m.sum()))
            ways = weight[edges] + beta[target[edges]]
            top = np.maximum.reduceat(ways, at)
            odds = np.exp(ways - np.repeat(top, m))
            whole = np.add.reduceat(odds, at)
            beta[by_node[lo : lo + n]] = top + np.log(whole)
            p[edges] = odds / np.repeat(whole, m)
            lo, e_lo = lo + n, edges.stop
        drawn = p > 0
        if not drawn.all():  # what is too unlikely for a float is not drawn
            start, target, payload, p = start[drawn], target[drawn], payload[drawn], p[drawn]
            many = np.bincount(start, minlength=total)[by_node]
            first = np.cumsum(many) - many
        upto = p.copy()
        for j in range(1, int(many.max())):  # node by node, whatever words it is built with
            at = first[many > j] + j
            upto[at] += upto[at - 1]
        upto[first + many - 1] = np.inf
        nodes, edges = len(self.first), len(self.node)
        of_node = np.empty((2, total), np.int32)
        of_node[:, by_node] = edges + first, many
        self.root = np.concatenate([self.root, (nodes + ends - sizes).astype(np.int32)])
        self.first, self.many = np.concatenate([self.first, of_node[0]]), np.concatenate([self.many, of_node[1]])
        self.node = np.concatenate([self.node, (nodes + start).astype(np.int32)])
        self.target = np.concatenate([self.target, np.where(target >= 0, nodes + target, -1).astype(np.int32)])
        self.payload = np.concatenate([self.payload, payload.astype(np.int32)])
        self.p, self.upto = np.concatenate([self.p, p]), np.concatenate([self.upto, upto])

    def walk(self, nodes: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draws a way from each node to the end of its word: (edges, which node they belong to), in order."""
        active, steps, taken, step = np.arange(len(nodes)), np.zeros(len(nodes), np.int64), [], 0
        while len(active):
            u = _uniform(seeds[active] + _U(step * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
            e = self.first[nodes].astype(np.int64)
            later = np.flatnonzero(u > self.upto[e])
            while len(later):
                e[later] += 1
                later = later[u[later] > self.upto[e[later]]]
            taken.append((active, e))
            target = self.target[e]
            go = np.flatnonzero(target >= 0)
            step += 1
            steps[active] = step
            active, nodes = active[go], target[go]
        begin = np.cumsum(steps) - steps
        edges = np.zeros(int(steps.sum()), np.int64)
        for i, (who, e) in enumerate(taken):
            edges[begin[who] + i] = e
        return edges, np.repeat(np.arange(len(steps)), steps)


class _Path:
    """A drawn segmentation and the perturbed maxima of what each choice left out."""

    def __init__(self, lat: Lattices, edges: np.ndarray, words: np.ndarray, value: float, noise: np.ndarray, at: int = 0, left_out: frozenset = frozenset()):
        self.edges, self.words, self.value = edges, words, value
        p = lat.p[edges]
        log = np.log(p)
        self.log_prob = float(log.sum())
        self.before = np.cumsum(log) - log
        self.left_out = {at: left_out | {int(edges[at])}} if len(edges) and left_out else {}
        with np.errstate(divide="ignore"):
            rest = np.log1p(-np.minimum(p, 1.0))
        if self.left_out:
            node = lat.node[edges[at]]
            others = [i for i in lat.out_of(node) if i not in self.left_out[at]]
            rest[at] = math.log(lat.p[others].sum()) if others else -math.inf
        # the largest of Gumbels with this total weight; ``bound`` puts it below the
        # path's value, which keeps the order
        self.most = self.before + rest - np.log(-np.log(noise))
        self.most[:at] = -np.inf  # these belong to the path that this one left
        self.next = int(self.most.argmax()) if len(edges) else -1

    def bound(self) -> float:
        if self.next < 0 or self.most[self.next] == -np.inf:
            return -math.inf
        return -float(np.logaddexp(-self.value, -self.most[self.next]))


def _leave(lat: Lattices, paths: list[_Path], seed: int, number: int) -> tuple[_Path, int, int, frozenset] | None:
    """(path, place, edge, edges gone before): the next best path leaves the one
    with the largest bound, at that choice, by this edge."""
    old = max(paths, key=_Path.bound)
    if old.bound() == -math.inf:
        return None
    at = old.next
    gone = frozenset(old.left_out.get(at, frozenset()) | {int(old.edges[at])})
    node = lat.node[old.edges[at]]
    others = np.array([i for i in lat.out_of(node) if i not in gone])
    u = float(_uniform(_stream(seed, number, 3, np.array([at])))[0])
    odds = np.cumsum(lat.p[others])
    return old, at, int(others[min(int(np.searchsorted(odds, u * odds[-1])), len(others) - 1)]), gone


def segment(lat: Lattices, texts: Sequence[str], seeds: Sequence[int], k: int) -> list[list[tuple[bytes, float, float, float]]]:
    """For each text up to k (ids, log probability, perturbed value, inclusion), largest value first.
    The ways of all texts are drawn together, one path a round."""
    units, ends = lat.add(texts)
    starts = np.r_[0, ends[:-1]].astype(np.int64)
    rows: list[list[_Path]] = [[] for _ in texts]
    # (text, value, place left at, edges before and the one that leaves, words of these, edges gone)
    drawn = []
    for i, seed in enumerate(seeds):
        value = -math.log(-math.log(float(_uniform(_stream(seed, 0, 4, np.zeros(1)))[0])))
        drawn.append((i, value, 0, np.zeros(0, np.int64), np.zeros(0, np.int64), frozenset()))
    for number in range(k):
        nodes, words = [], []
        for i, _, _, head, head_words, _ in drawn:
            inside = number > 0 and lat.target[head[-1]] >= 0
            word = int(head_words[-1]) + 1 if number else 0
            on = lat.root[units[starts[i] + word : ends[i]]]
            nodes.append(np.r_[lat.target[head[-1]], on] if inside else on)
            words.append(np.arange(word - inside, int(ends[i] - starts[i])))
        if drawn:
            noise = [_stream(seeds[d[0]], number, 1, w) for d, w in zip(drawn, words, strict=True)]
            more, which = lat.walk(np.concatenate(nodes), np.concatenate(noise))
            cut = np.searchsorted(which, np.cumsum([0] + [len(x) for x in nodes]))
            word_of = np.concatenate(words)[which]
        for j, (i, value, at, head, head_words, gone) in enumerate(drawn):
            edges = np.concatenate([head, more[cut[j] : cut[j + 1]]])
            of_word = np.concatenate([head_words, word_of[cut[j] : cut[j + 1]]])
            noise = _uniform(_stream(seeds[i], number, 2, np.arange(len(edges))))
            rows[i].append(_Path(lat, edges, of_word, value, noise, at, gone))
        if number + 1 == k:
            break
        drawn = []
        for i, seed in enumerate(seeds):
            if len(rows[i]) == number + 1 and (way := _leave(lat, rows[i], seed, number + 1)) is not None:
                old, at, edge, gone = way
                drawn.append((i, old.bound(), at, np.append(old.edges[:at], edge), old.words[: at + 1], gone))
                old.most[at] = -np.inf
                old.next = int(old.most.argmax())
    out = []
    for paths in rows:
        threshold = max(p.bound() for p in paths)
        found = []
        for p in paths:
            odds = p.log_prob - threshold
            inclusion = 1.0 if odds > 40 else -math.expm1(-math.exp(odds))
            found.append((lat.vocab.ids(lat.payload[p.edges]), p.log_prob, p.value, inclusion))
        out.append(found)
    return out


def sample(docs: DataFrame, model: str, k: int = 2, alpha: float = ALPHA, seed: int = 11, id_col: str = "doc_id", decoded: bool = False) -> DataFrame:
    """(id, sample, n_pieces, log_prob, perturbed, inclusion, ids) for every whole
    text; ids as little-endian unsigned 32-bit numbers. With ``decoded`` also
    their text, by ``Vocabulary.decode`` in the same pass."""
    schema = T.StructType([docs.schema[id_col]]).add("sample", "integer").add("n_pieces", "long").add("log_prob", "double")
    schema = schema.add("perturbed", "double").add("inclusion", "double").add("ids", "binary")
    if decoded:
        schema = schema.add("decoded", "string")

    def emit(column: pa.Array, rows: list[int], texts: list[str], keys: list[int], lat: Lattices) -> pa.RecordBatch:
        found = [(r, j, *x) for r, group in zip(rows, segment(lat, texts, keys, k), strict=True) for j, x in enumerate(group)]
        row, number, ids, log_prob, value, inclusion = zip(*found, strict=True)
        columns = [column.take(pa.array(row)), pa.array(number, pa.int32()), pa.array([len(x) // 4 for x in ids], pa.int64())]
        columns += [pa.array(log_prob), pa.array(value), pa.array(inclusion), pa.array(ids, pa.binary())]
        if decoded:
            columns.append(pa.array([lat.vocab.decode(x) for x in ids], pa.string()))
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = Lattices(vocabulary(model, alpha))
        for batch in batches:
            rows, texts, keys, size = [], [], [], 0
            for i, (key, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                rows.append(i)
                texts.append(text.as_py() or "")
                keys.append(xxhash.xxh3_64_intdigest(repr(key), seed))
                size += len(texts[-1])
                if size >= CHUNK:
                    yield emit(batch.column(0), rows, texts, keys, lat)
                    rows, texts, keys, size = [], [], [], 0
            if rows:
                yield emit(batch.column(0), rows, texts, keys, lat)

    return docs.select(id_col, "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    at = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model, ALPHA)
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                text = pa.array([vocab.decode(x.as_py()) for x in batch.column(at)], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, text], names=schema.names)

    return encoded.mapInArrow(run, schema)
