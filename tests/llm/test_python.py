"""Packing, search, sampling, language ID, line dedup, near duplicates and the pipeline."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from claimlake.llm import bytebpe, langid, linededup, neardup, packing, pieces, queries, search
from tests.conftest import SF_SMALL
from tests.llm import edge

VOCABULARY, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


# packing


def test_ids_equal_the_tokenizers():
    enc, r = bytebpe.Encoder(VOCABULARY, RANKS), random.Random(2)
    texts = ["", "  a  b\n\n  c\t\td ", "it's we're I'll 'x 'S", "a\xa0b \x1c\x1d", "<|endoftext|> x", "日本 語", "x" * 500 + " y", "12 3²½a"]
    texts += ["".join(r.choice("ab é\n\t 1²'s!?.\r\x0b\x0c×¡ ") for _ in range(r.randint(0, 30))) for _ in range(500)]
    for t in texts:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["mixed", "large", "equal", "none", "tiny"])
def test_bins_hold_all_and_overflow_never(kind):
    r = random.Random(4)
    lengths = {"mixed": [r.randint(1, 100) for _ in range(400)], "large": [r.randint(30, 70) for _ in range(300)], "equal": [30] * 100, "none": [], "tiny": [1]}[kind]
    bins = packing.pack_lengths(lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 100 for b in bins)
    assert len(bins) <= 1.1 * (-(-sum(lengths) // 100)) + 1 or kind == "equal"


def test_local_search_exchanges_until_a_bin_is_empty():
    lengths = [6, 4, 5, 3, 2]  # 6+3 | 5+4 | 2 needs an exchange to fit two bins of 10
    out = packing.local_search([[0, 3], [2, 1], [4]], lengths, 10)
    assert len(out) == 2 and sorted(i for b in out for i in b) == [0, 1, 2, 3, 4]


def test_packing_whole_table(spark):
    texts = [*edge.TEXTS, *[(i, edge.prose(i, i % 90)) for i in range(100, 400)]]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = packing.pack(packing.pieces(df, VOCABULARY, RANKS, with_ids=True)).collect()
    enc = bytebpe.Encoder(VOCABULARY, RANKS)
    want = Counter()
    for i, t in texts:
        ids = enc.encode(t or "") + np.array([2], "<u4").tobytes()
        n, at, k = len(ids) // 4, 0, 0
        while at < n:
            to = at + ((n - at) % 1024 or 1024)
            want[i, k, at, to - at, zlib.crc32(ids[4 * at : 4 * to])] += 1
            at, k = to, k + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:i]) for i in range(len(p))] and sum(n for _, n in p) <= 1024
    assert len(places) <= math.ceil(sum(r.length for r in got) / 1024) + 1
    assert packing.pack(packing.pieces(edge.empty(spark), VOCABULARY, RANKS)).count() == 0


# search


def _bm25(docs, queries_, k):
    terms = [(i, Counter(search.terms(t))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    n, mean = len(terms), sum(sum(c.values()) for _, c in terms) / max(len(terms), 1)
    df = Counter(x for _, c in terms for x in c)
    out = {}
    for q, t in queries_:
        found = []
        for i, c in terms:
            size = sum(c.values())
            s = sum(math.log1p((n - df[x] + 0.5) / (df[x] + 0.5)) * c[x] * 2.2 / (c[x] + 1.2 * (0.25 + 0.75 * size / mean)) for x in set(search.terms(t)) if x in c)
            if s > 0:
                found.append((-round(s, 6), i is None, i or 0))
        out[q] = sorted(found)[:k]
    return {q: x for q, x in out.items() if x}


@pytest.mark.parametrize("parts", [1, 3])
def test_search_is_exact(spark, monkeypatch, parts):
    monkeypatch.setattr(search, "QUERIES", 3)
    docs = [*edge.TEXTS, *[(i, edge.prose(i % 130, 5 + i % 40)) for i in range(100, 400)]]
    asked = [(i, t) for i, t in docs if i in (1, 2, 3, 4, 8, 100, 150, 200, 333)]
    asked = list({i: (i, t) for i, t in asked}.values())
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    got = defaultdict(list)
    for r in search.top_k(df, spark.createDataFrame(asked, "doc_id long, text string"), 7).orderBy("query", "rank").collect():
        got[r.query].append((-round(r.score, 6), r.id is None, r.id or 0))
    want = _bm25(docs, asked, 7)
    assert got.keys() == want.keys()
    for q in want:
        assert np.allclose([x[0] for x in got[q]], [x[0] for x in want[q]], atol=2e-6)
        assert [x[2] for x in got[q]] == [x[2] for x in want[q]]


def test_search_skips_blocks_and_takes_empty_tables(spark):
    r = random.Random(1)
    docs = [(i, " ".join(r.choice(["a", "b", "c"]) for _ in range(50))) for i in range(2000)] + [(5000 + i, "rare needle " * (i + 1)) for i in range(20)]
    row = search.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).first().asDict()
    shard, top = search.Shard(row, 50.0), search.Top(5)
    h = np.unique(np.array([search.xxhash.xxh3_64_intdigest(x) for x in ("a", "rare", "needle")], np.uint64))
    entered = search.run_query(shard, h, np.array([0.1 if x == search.xxhash.xxh3_64_intdigest("a") else 5.0 for x in h.tolist()]), top)
    assert 0 < entered < shard.blocks and all(i >= 5000 for _, i in top.rows)
    assert search.top_k(edge.empty(spark), edge.empty(spark)).count() == 0


# sampled segmentations


def test_samples_follow_the_distribution_without_replacement():
    v = pieces.Lattices(pieces.Vocabulary(MODEL))
    every = {x[0]: math.exp(x[1]) for x in pieces.segment(v, ["heth"], [1], 1000)[0]}
    assert abs(sum(every.values()) - 1) < 1e-9
    n, first, pair, total = 4000, Counter(), Counter(), 0.0
    for s in range(n):
        a, b = pieces.segment(v, ["heth"], [s * 7919 + 13], 2)[0]
        assert a[0] != b[0] and a[2] >= b[2]
        first[a[0]] += 1
        pair[a[0], b[0]] += 1
        total += sum(every[x[0]] / x[3] for x in (a, b))
    for x, p in every.items():
        assert abs(first[x] / n - p) < 0.03
        for y, q in every.items():
            if x != y and p < 1 - 1e-9:
                assert abs(pair[x, y] / n - p * q / (1 - p)) < 0.03
    assert abs(total / n - 1) < 0.05  # inclusion scores: weighting by their inverse estimates a sum


def test_samples_return_every_text(spark):
    odd = [(100 + i, t) for i, t in enumerate(["a", " a  b\n\n c ", "日本語 x", "▁a ▁▁ b", "\n\x00\n▁", "é\U0001f600\t"])]
    df = spark.createDataFrame([*edge.TEXTS, *odd], "doc_id long, text string").repartition(2)
    rows = pieces.decode(pieces.sample(df, MODEL, k=3), MODEL).collect()
    assert Counter(rows) == Counter(pieces.sample(df, MODEL, k=3, decoded=True).collect())
    texts = defaultdict(set)
    for i, t in [*edge.TEXTS, *odd]:
        texts[i].add(t or "")
    seen = defaultdict(list)
    for r in rows:
        assert r.decoded in texts[r.doc_id] and r.n_pieces * 4 == len(r.ids) and 0 < r.inclusion <= 1 or r.inclusion >= 0
        seen[r.doc_id, r.decoded].append((r.sample, r.ids))
    for (i, t), found in seen.items():
        copies = sum(1 for j, u in [*edge.TEXTS, *odd] if j == i and (u or "") == t)
        assert len(set(found)) * copies == len(found) and len({x for _, x in found}) == len(set(found))
    assert {k[0] for k in seen} == texts.keys()
    assert pieces.sample(edge.empty(spark), MODEL).count() == 0


def test_samples_do_not_depend_on_the_batch():
    v = pieces.Vocabulary(MODEL)
    texts = [edge.prose(i, 30) for i in range(6)]
    together = pieces.segment(pieces.Lattices(v), texts, range(6), 3)
    assert all(pieces.segment(pieces.Lattices(v), [t], [i], 3)[0] == together[i] for i, t in enumerate(texts))


def test_samples_do_not_depend_on_what_the_cache_forgets(monkeypatch):
    lattices = pieces.Lattices(pieces.Vocabulary(MODEL))
    texts = [edge.prose(i, 30) for i in range(6)] + ["", "a" * 70000]
    kept = [pieces.segment(lattices, [t], [i], 2)[0] for i, t in enumerate(texts)]
    monkeypatch.setattr(pieces, "CACHE", 0)
    assert kept == [pieces.segment(lattices, [t], [i], 2)[0] for i, t in enumerate(texts)]
    assert kept[-2] == [(b"", 0.0, kept[-2][0][2], 1.0)]


# language


def test_language_on_held_out_rows(spark):
    out = queries.QUERIES["op6_output_code_language"](spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    rows = out.join(docs, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 20 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 5, 12])
def test_codewords_differ(n):
    code = langid.codewords(n)
    assert len(code) == n and set(np.unique(code)) <= {1, -1}
    assert min([(a != b).sum() for i, a in enumerate(code) for b in code[:i]], default=9) >= min(n - 1, 4) or n == 1


def test_margins_of_a_text_do_not_depend_on_its_neighbours(monkeypatch):
    w = np.random.default_rng(1).normal(size=(langid.BUCKETS, 3)).astype(np.float32)
    m = langid.Model(["a", "b", "c"], langid.codewords(3), w, np.ones(3), np.full((3, 3), 1 / 3))
    texts = ["x", edge.prose(1, 50), "é" * 300, edge.prose(2, 5)]
    want = np.array([sum(w[g].sum(0, dtype=float) for g in gs) / sum(map(len, gs)) for t in texts for gs in [[langid._grams(langid._bytes(t), o) for o in langid.ORDERS]]])
    assert np.allclose(m.margins(texts), want)
    monkeypatch.setattr(langid, "CHUNK", 64)
    assert np.allclose(m.margins(texts), want)


def test_language_edge_and_empty(spark):
    df = edge.docs(spark)
    got = langid.predict(df, langid.fit(langid.labelled(df)), ("doc_id", "text")).collect()
    assert len(got) == len(edge.TEXTS)
    for r in got:
        assert (r.lang_pred == "und") == (not langid.has_letter(r.text))
    assert langid.fit(langid.labelled(edge.empty(spark))) is None
    assert {r.lang_pred for r in langid.predict(df, None).collect()} == {"und"}


# lines


def _distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[-1]


def test_variants_find_every_pair_within_one_edit():
    r = random.Random(9)
    for _ in range(1500):
        a = [r.choice([b"a", b"b", b"c"]) for _ in range(r.randint(3, 8))]
        b = list(a)
        for _ in range(r.choice([1, 2])):
            i, kind = r.randrange(len(b)), r.random()
            b[i : i + (kind < 0.67)] = [] if kind < 0.33 and len(b) > 1 else [r.choice([b"a", b"d"])]
        near = _distance(a, b) <= 1
        assert linededup.within_bound(a, b) == near
        if a != b:
            (ca, pa), (cb, pb) = linededup.deletion_keys(a), linededup.deletion_keys(b)
            met = set(pa.tolist()) & set(pb.tolist()) or int(linededup.full_key(a)) in cb.tolist() or int(linededup.full_key(b)) in ca.tolist()
            assert bool(met) == near
            assert not near or set(linededup.half_keys(a)) & set(linededup.half_keys(b))


def _without_repeats(docs):
    lines = [(i, k, tuple(x.encode().split())) for i, t in docs for k, x in enumerate(t.split("\n")) if len(x.encode().split()) >= 5]
    first = {}
    for i, k, w in lines:
        first.setdefault(w, (i, k))
    order = sorted((w for w in first if len(w) >= 10), key=first.get)
    near = {w for j, w in enumerate(order) if any(abs(len(v) - len(w)) < 2 and _distance(v, w) <= 1 for v in order[:j])}
    gone = {(i, k) for i, k, w in lines if w in near or first[w] != (i, k)}
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in docs}


def test_line_dedup_equals_brute_force(spark):
    r, base = random.Random(5), [edge.prose(i, 14) for i in range(12)]
    docs = []
    for i in range(80):
        lines = []
        for _ in range(r.randint(0, 6)):
            w = r.choice(base).split()
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                j, kind = r.randrange(len(w)), r.random()
                w[j : j + (kind < 0.67)] = [] if kind < 0.33 else [r.choice(["new", "other"])]
            lines.append(" ".join(w[: r.choice([3, 7, 20, 20])]))
        docs.append((i, "\n".join(lines)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    out = linededup.dedup_lines(df).collect()
    assert {x.doc_id: x.text for x in out} == _without_repeats(docs)


def test_line_dedup_edge_and_empty(spark):
    out = linededup.dedup_lines(edge.docs(spark).drop("n_lines"))
    got = out.collect()
    assert len(got) == len(edge.TEXTS)
    texts = defaultdict(set)
    for x in got:
        texts[x.doc_id].add(x.text)
    assert texts[1] == {None} and texts[2] == {""} and texts[7] == {" \n\t \n"} and texts[4] == {edge.prose(2, 80)} and texts[5] == {""}
    assert all(x.row == "extra" for x in got)
    assert linededup.dedup_lines(edge.empty(spark)).count() == 0


def test_short_repeated_lines_go(spark, tmp_path):
    r = random.Random(6)
    docs = [(i, "\n".join(" ".join(r.choice("ab") for _ in range(r.randint(0, 6))) for _ in range(r.randint(1, 9)))) for i in range(60)]
    docs += [(60, "\n".join(["menu"] * 50)), (61, "only here\n\nmenu\n  only   here")]
    seen, want = set(), {}
    for i, t in docs:
        kept = []
        for x in t.split("\n"):
            if not x.split() or tuple(x.split()) not in seen:
                kept.append(x)
            seen.add(tuple(x.split()))
        want[i] = "\n".join(kept)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    path = edge.write(spark, df, tmp_path / "short")
    assert {x.doc_id: x.text_crc32 for x in queries.op7_line_neighbourhood(spark, path).collect()} == {i: zlib.crc32(t.encode()) for i, t in want.items()}
    import corpus_pipeline

    emptied = {i for i, t in docs if want[i] != t and not want[i].split()}
    assert {x.doc_id: x.text for x in corpus_pipeline.line_dedup(spark, df, path).collect()} == {i: t for i, t in want.items() if i not in emptied}


# near duplicates


def _groups(docs, k):
    sets, parent = [(i, neardup.shingles(t, k)) for i, t in docs if i is not None], {i: i for i, _ in docs if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, x) in enumerate(sets):
        for j, y in sets[:n]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in parent}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    r, docs = random.Random(8), []
    for i in range(260):
        w = edge.prose(1000 + (i % 9 if i % 2 else i % 40), 12 + 7 * (i % 5) if i % 3 else 60).split()
        for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
            w[r.randrange(len(w))] = r.choice(["x", "y", "z"]) + str(r.randint(0, 3))
        docs.append((i, " ".join(w)))
    got = neardup.groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), k=k).collect()
    assert {x.doc_id: x.component_id for x in got} == _groups(docs, k)
    assert all(x.n_shingles == len(neardup.shingles(docs[x.doc_id][1], k)) and x.kept == (x.doc_id == x.component_id) for x in got)


def test_near_duplicates_edge_and_empty(spark):
    got = neardup.groups(edge.docs(spark), k=2).collect()
    assert len(got) == len(edge.TEXTS)
    want = _groups(edge.TEXTS, 2)
    assert all(x.component_id == want.get(x.doc_id) for x in got)
    assert all(x.kept for x in got if x.doc_id is None)
    assert neardup.groups(edge.empty(spark), k=2).count() == 0


def test_bayesian_bounds_rarely_miss():
    assert (1 - 0.8**neardup.ROWS) ** neardup.BANDS < 1e-6
    for n, least in neardup.least_matches(80):
        below = sum(math.comb(n, m) * 0.8**m * 0.2 ** (n - m) for m in range(least))
        assert below < 1e-5


# pipeline


def test_pipeline_on_awkward_rows(spark, tmp_path):
    import corpus_pipeline

    d = edge.write(spark, edge.docs(spark), tmp_path / "edge")
    docs, names = spark.read.parquet(f"{d}/documents.parquet"), edge.empty(spark).columns
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
        docs = docs.persist()
        sizes[name] = docs.count()
        if name != "pack":
            assert docs.columns == names
            assert docs.where("n_chars <> length(text)").count() == 0
    assert sizes["language_id"] == sum(langid.has_letter(t) for _, t in edge.TEXTS)
    assert sizes["near_dedup"] < sizes["line_dedup"] < sizes["language_id"]
    e = edge.write(spark, edge.empty(spark), tmp_path / "empty")
    assert corpus_pipeline.run(spark, e).count() == 0


def test_pipeline_keeps_different_texts_of_one_id(spark):
    import corpus_pipeline

    first, second = (t for i, t in edge.TEXTS if i == 14)
    texts = {(13, first + " copied"), (14, first), (14, second), (15, edge.prose(7, 30)), (15, edge.prose(8, 30))}
    df = spark.createDataFrame(edge.rows([*texts, (14, second)]), edge.SCHEMA).repartition(3)
    got = [(x.doc_id, x.text) for x in corpus_pipeline.near_dedup(spark, df, "").collect()]
    assert sorted(got) == sorted(texts - {(14, first)})
    got = [x.text for x in corpus_pipeline.near_dedup(spark, edge.docs(spark), "").collect() if x.doc_id == 14]
    assert sorted(got) == sorted([first, second])
