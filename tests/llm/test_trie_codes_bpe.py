"""Prefix trie, vector codes and chunked BPE against plain Python."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from claimlake.llm import chunkbpe, prefixtrie, queries, vectorcode
from tests.llm import edge

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TURNS = "conv_id long, turn long, role string, text string, block string, prior string, path string, pos string, depth string, n string"


# prefix trie


def brute_trie(sequences: dict[int, list[tuple[str, str]]]):
    members = defaultdict(list)
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = set()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(p))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    assert len(out) == len(members)
    return out


def ordered(rows):
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            found[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()[:16], role or "", text or ""))
    return {c: [t[3:] for t in sorted(v)] for c, v in found.items()}


def rebuilt(rows):
    own = ordered(rows)
    out = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + seq[h:]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 6) for r in rows], TURNS).repartition(3)


def conversations(seed):
    r = random.Random(seed)
    rows = [(None, 0, "user", "nobody"), (7, None, "user", "first of all"), (7, 0, None, None), (7, 0, "user", "a"), (7, 0, "user", "a"), (11, None, None, None), (11, None, None, None)]
    for c in [*range(100, 160), *range(250, 300), 400, 401, 402]:
        n = r.choice([1, 2, 3, 7, 8, 9, 16, 17, 30])
        rows += [(c, t, r.choice(["user", "assistant", "system"][: 1 + t % 2]), f"t{r.randint(0, 1)}é") for t in range(n)]
    rows += [(c, t, "user", "same") for c in range(500, 580) for t in range(12)]  # one large group of copies
    rows += [(600, t, "user", f"turn {t % 3}") for t in range(700)]  # one long conversation
    rows += [(601, t, "user", f"turn {t % 3}") for t in range(650)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, tmp_path, seed):
    rows = conversations(seed)
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op11_prefix_rollup(spark, str(tmp_path))
    assert {tuple(r) for r in got.collect()} == brute_trie(rebuilt(rows)) and got.count() == len(brute_trie(rebuilt(rows)))


def test_trie_of_turns_as_they_are(spark):
    rows = conversations(3)
    turns = frame(spark, rows)
    tree = prefixtrie.prefix_trie(turns, spark.createDataFrame([(7,), (900,), (None,)], "conv_id long"))
    want = brute_trie({**ordered(rows), 900: []})
    digests = {(r.conv_id, r.depth): r.ends_sha256 for r in prefixtrie.ends_digest(tree.ends).collect()}
    none = hashlib.sha256(b"").hexdigest()
    nodes = tree.nodes.collect()
    assert {(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_chars, digests.get((r.conv_id, r.depth), none)) for r in nodes} == want
    members = Counter(i for r in tree.ends.collect() for i in r.conv_ids)
    assert set(members) == set(ordered(rows)) | {900} and set(members.values()) == {1}
    texts = {(r.conv_id, r.depth): (r.role, r.text) for r in prefixtrie.with_texts(tree.nodes, turns).collect()}
    seqs = ordered(rows)
    assert all(texts[c, d] == (seqs[c][d - 1] if d else (None, None)) for c, d in texts if c in seqs)


def test_trie_of_nothing(spark):
    tree = prefixtrie.prefix_trie(frame(spark, []))
    assert tree.nodes.count() == 0 and tree.ends.count() == 0
    only_null = prefixtrie.prefix_trie(frame(spark, [(None, 1, "user", "x")]))
    assert only_null.nodes.count() == 0


def test_running_sums_carry_over_parts(spark):
    rows = [("hot", i, i) for i in range(3000)] + [(f"k{i % 50}", i, 1) for i in range(300)]
    got = prefixtrie.running(spark.createDataFrame(rows, "k string, at int, v long").repartition(5), "k", ["at"], {"before": F.col("v")}).collect()
    assert len(got) == len(rows)
    sums = Counter()
    for r in sorted(got, key=lambda r: (r.k, r.at)):
        assert r.before == sums[r.k]
        sums[r.k] += r.v


# vector codes


def brute_codes(vectors, parts, entries, rounds):
    """(codes, errors, books) of integer vectors given in seed order, by Lloyd's rounds in plain integers."""
    w = len(vectors[0]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for v in vectors]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda part, book: min(range(len(book)), key=lambda k: (dist(part, book[k]), k))
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for v in cut:
                groups[near(v[p], books[p])].append(v[p])
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if groups[k] else e for k, e in enumerate(books[p])]
    codes = [bytes(near(v[p], books[p]) for p in range(parts)) for v in cut]
    errors = [sum(dist(v[p], books[p][c]) for p, c in enumerate(code)) for v, code in zip(cut, codes, strict=True)]
    return codes, errors, books


EMB = "vec_id long, embedding array<float>, label int, vector string, entry string, id string, codes string, error string"


def embeddings(kind):
    r = random.Random(kind)
    base = [[r.gauss(0, 0.2) for _ in range(16)] for _ in range(9)]
    rows = [(i, [x + r.gauss(0, 0.05) for x in base[i % 9]], i % 4 or None) for i in range(3, 400)]
    if kind == "ties":  # few distinct values, so distances tie often
        rows = [(i, [r.choice([0.0, 0.25, -0.25]) for _ in range(16)], 1) for i in range(300)]
    if kind == "few":
        rows = rows[:5]
    if kind == "mixed":
        rows += [(1, None, 1), (0, [float("nan")] * 16, 1), (2, [float("inf")] + [0.0] * 15, 1), (900, [None] + [0.1] * 15, 1)]
        rows += [(3, rows[7][1], 9), (3, rows[7][1], 9), (None, rows[8][1], None), (901, [0.5] * 7, 2), (902, [], 2)]
        rows += [(1000 + i, rows[0][1], 2) for i in range(500)]  # a hot vector and label
    return rows


@pytest.mark.parametrize("kind", ["plain", "ties", "few", "mixed"])
def test_codes_equal_plain_rounds(spark, tmp_path, kind):
    rows = embeddings(kind)
    spark.createDataFrame([(*r, *["x"] * 5) for r in rows], EMB).repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op12_bounded_codes(spark, str(tmp_path)).collect()
    kept = [(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[int(np.floor(4096 * x)) for x in v] + [0] * (16 - len(v)) for _, v, _ in kept]
    codes, errors, books = brute_codes(ints, 8, 16, 6)
    by_label = Counter()
    for (_, _, lab), e in zip(kept, errors, strict=True):
        by_label[lab] += e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    assert Counter(map(tuple, got)) == Counter((i, c.hex(), e, by_label[lab], sha) for (i, _, lab), c, e in zip(kept, codes, errors, strict=True))


def test_bounds_spare_scans_and_keep_history(spark):
    rows = embeddings("plain")
    coded, books = vectorcode.train(spark.createDataFrame([(*r, *["x"] * 5) for r in rows], EMB))
    assert len(books) == 7
    scans = coded.agg(F.sum("scans")).first()[0]
    assert len(rows) * 8 <= scans < 0.7 * len(rows) * 8 * 7
    # an entry that comes back has moved nowhere, whatever the sum of its steps
    moves = vectorcode.Moves([books[0], books[3], books[0]])
    assert (moves.of[0] == 0).all() and (moves.of[1] > 0).any()


def test_label_errors_beyond_the_broadcast(spark, monkeypatch):
    rows = [(i, None if i % 3 == 0 else i % 5, b"x", i) for i in range(400)]
    coded = spark.createDataFrame(rows, "id long, label int, codes binary, error long")
    want = sorted((r.id, r.label_error) for r in vectorcode.label_errors(coded).collect())
    monkeypatch.setattr(vectorcode, "fits_broadcast", lambda df: False)
    assert sorted((r.id, r.label_error) for r in vectorcode.label_errors(coded).collect()) == want and len(want) == 400


def test_codes_of_nothing_and_of_large_numbers(spark):
    empty, books = vectorcode.train(spark.createDataFrame([], EMB))
    assert empty.count() == 0 and books[-1].size == 0
    far = spark.createDataFrame([(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1)], "vec_id long, embedding array<float>, label int")
    assert [r.error for r in vectorcode.train(far)[0].collect()] == [0, 0]


# chunked BPE


def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe_texts():
    r = random.Random(3)
    alphabet = "ab é\n\t 1²'s!?.\r\x0b\x0c×¡ ՘₏\U000107bb\U00012550日本\x1c\x1d ​'re <|endoftext|>"
    texts = [*edge.TEXTS, *[(100 + i, "".join(r.choice(alphabet) for _ in range(r.randint(0, 400)))) for i in range(200)]]
    # long pre-tokens, so that chunks share no boundary
    return [*texts, (1000, "a" * 300), (1001, " " * 300), (1002, "\n" * 200 + "x"), (1003, ("x" * 70 + " ") * 9), (1004, "'" * 200), (1005, "'re" * 99), (1006, "ab " * 64)]


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (50, 50), (40, 8), (chunkbpe.CHUNK, chunkbpe.OVERLAP)])
def test_chunked_ids_equal_the_librarys(spark, chunk, overlap):
    texts, enc = bpe_texts(), library()
    rows = [(i, t, *["x"] * 4) for i, t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, row string, chunk string, decoded string").repartition(5)
    encoded = chunkbpe.encode(df, RANKS, public_tokenizers.PATTERN, chunk, overlap)
    got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in chunkbpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect())
    want = Counter()
    for i, t in texts:
        ids = np.array(enc.encode_ordinary(t or ""), "<u4")
        want[i, len(ids), ids.tobytes(), (t or "").encode()] += 1
    assert got == want


def test_bpe_query_digests(spark, tmp_path):
    enc, texts = library(), [*edge.TEXTS, (50, "lorem ipsum dolor " * 9000), (51, "z" * 70000)]
    got = queries.op13_chunked_bpe(spark, edge.write(spark, spark.createDataFrame(edge.rows(texts), edge.SCHEMA), tmp_path)).collect()
    want = Counter()
    for i, t in texts:
        ids = np.array(enc.encode_ordinary(t or ""), "<u4")
        want[i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, got)) == want
    assert chunkbpe.encode(edge.empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bad_overlap(spark):
    with pytest.raises(ValueError):
        chunkbpe.encode(edge.empty(spark), RANKS, public_tokenizers.PATTERN, 100, 200)
