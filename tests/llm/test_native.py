"""Quality rules, sharding, secrets and chat formatting against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from claimlake.llm import chat, quality, queries, secrets, sharding
from tests.conftest import SF_SMALL
from tests.llm import edge

GAP = re.compile(r"[\x20\x09-\x0D]+")


def _counts(text):
    text = text or ""
    words = [w for w in GAP.split(text) if w]
    lines = [x for x in text.split("\n") if GAP.sub("", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_measures(spark):
    got = quality.measures(edge.docs(spark), ("doc_id",)).collect()
    assert len(got) == len(edge.TEXTS)
    want = sorted(map(str, [(i, *_counts(t)) for i, t in edge.TEXTS]))
    assert sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == want


def test_quality_order_never_changes_the_verdict(spark):
    measured = quality.measures(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    rules = quality.default_rules()
    one = {r.doc_id: r.rejected_by is None for r in quality.cascade(measured, rules).select("doc_id", "rejected_by").collect()}
    other = {r.doc_id: r.rejected_by is None for r in quality.cascade(measured, rules[::-1]).select("doc_id", "rejected_by").collect()}
    assert one == other and 0 < sum(one.values()) < len(one)


def test_quality_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    got = queries.QUERIES["op1_quality_cascade"](spark, SF_SMALL)
    want = con.sql(queries.ORACLE["op1_quality_cascade"])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(str, got.select(columns).collect())) == sorted(str(Row(**dict(zip(columns, r, strict=True)))) for r in want.select(*columns).fetchall())


def test_quality_rules_are_ordered_by_rejections_per_cost():
    rules = quality.default_rules()[:3]
    estimates = [(rules[0].name, 0.1, 1.0), (rules[1].name, 0.1, 0.1), (rules[2].name, 0.5, 1.0)]
    assert [r.name for r in quality.order(rules, estimates)] == [rules[1].name, rules[2].name, rules[0].name]


def test_quality_edge_and_empty(spark):
    out = quality.filter_quality(edge.docs(spark))
    assert out.count() == len(edge.TEXTS)
    assert out.where("doc_id = 1 AND base_failed AND NOT kept").count() == 1
    assert quality.filter_quality(edge.empty(spark)).count() == 0


def test_shards_have_equal_bytes_and_gapless_places(spark, tmp_path):
    r = random.Random(3)
    texts = [(i, "copy" * 40 if i % 3 == 0 else edge.prose(i, r.randint(1, 60))) for i in range(3000)]  # a group of a third
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = sharding.shard(df, 8, str(tmp_path / "maps")).collect()
    assert sorted(x.doc_id for x in got) == list(range(3000))
    loads, places = Counter(), {}
    for x in got:
        t = texts[x.doc_id][1]
        assert x.size == len(t.encode()) + 1 and x.text_crc32 == zlib.crc32(t.encode())
        loads[x.shard] += x.size
        places.setdefault(x.shard, []).append(x.slot)
    assert set(loads) == set(range(8)) and max(loads.values()) < 1.02 * min(loads.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    later = Counter()
    for x in got:
        assert x.next_shard in (x.shard, 8)
        later[x.next_shard] += x.size
    assert len(later) == 9 and max(later.values()) < 1.05 * min(later.values())


def test_equal_texts_share_a_shard_and_maps_are_versioned(spark, tmp_path):
    df = spark.createDataFrame([(i, edge.prose(i % 400, 20)) for i in range(2000)], "doc_id long, text string")
    got = sharding.shard(df, 8, str(tmp_path / "maps")).collect()
    assert all(len(s) == 1 for s in _by(got, "text_crc32", "shard").values())
    newest = {r.virtual_slot: r.shard for r in sharding.load_map(spark, str(tmp_path / "maps")).collect()}
    first = {r.virtual_slot: r.shard for r in sharding.load_map(spark, str(tmp_path / "maps"), 0).collect()}
    assert newest.keys() == first.keys() and all(newest[s] in (first[s], 8) for s in first)


def _by(rows, key, value):
    out = {}
    for r in rows:
        out.setdefault(r[key], set()).add(r[value])
    return out


def test_sharding_edge_and_empty(spark, tmp_path):
    got = sharding.shard(edge.docs(spark), 8, str(tmp_path / "a")).collect()
    assert len(got) == len(edge.TEXTS)
    assert [(x.size, x.text_crc32) for x in got if x.doc_id == 1] == [(1, 0)]
    assert sharding.shard(edge.empty(spark), 8, str(tmp_path / "b")).count() == 0


BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]+", 0, 24),
}


def _base(text):
    found = []
    for k, (kind, (p, group, least)) in enumerate(BASE.items()):
        found += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(p, text or "", re.ASCII) if len(m.group(group)) >= least]
    return [x for _, _, x in sorted(found)]


SECRETS = [
    "secret=token:abcdefgh token=token=abcdef api_key: 'A1+/_.=-' APIKEY=12345 passwd  =  zzzzzz",
    "AKIAAKIA" + "0" * 14 + " AKIA123 xAKIA" + "Q" * 40,
    "deadbeef" * 3 + "g" + "0" * 23 + "\n" + "f" * 60,
    "-----BEGIN RSA PRIVATE KEY-----\nabc\n-----END RSA PRIVATE KEY-----",
    "ghp_" + "a" * 36 + " xoxb-1234567890-abc eyJabcdefghij.eyJabcdefghij.sig AIza" + "x" * 35 + " sk_live_" + "1" * 20,
    "see https://user:pass@host.example/x and http://host:80/",
    "é" * 30 + " password='ééé' token: 'xxxxxx" + "é",
]


def test_secret_spans(spark):
    texts = [*edge.TEXTS, *enumerate(SECRETS, 100), (200, "abcdef0123456789" * 500 + " token=" + "z" * 9000)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    got = secrets.scan(df).collect()
    assert len(got) == len(texts)
    for r in got:
        base = [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind in secrets.BASE_KINDS]
        assert base == _base(r.text), (r.doc_id, base)
        extra = sorted((m.start(), x.kind, m.end()) for x in secrets.EXTRA for m in re.finditer(x.pattern, r.text or "", re.ASCII))
        assert extra == sorted((s.start, s.kind, s.end) for s in r.spans if s.kind not in secrets.BASE_KINDS)
    assert {s.kind for r in got for s in r.spans} == {r.kind for r in secrets.RULES}


def test_texts_with_thousands_of_spans(spark):
    block = secrets.FOLD_BLOCK
    texts = [(n, f"é token=abcdef{n % 7} {'0' * 24} token=x " * n) for n in (1, block - 1, block, block + 1, 6000)]
    texts.append((0, "AKIA" + "0" * 16 + " token=" + "0" * 30))
    got = secrets.scan(spark.createDataFrame(texts, "doc_id long, text string")).cache()
    for r in got.collect():
        assert [f"{s.kind}:{s.start}:{s.end}" for s in r.spans] == _base(r.text)
    for r, t in zip(sorted(secrets.redact(got).collect()), sorted(texts), strict=True):
        assert r.text == ("[SECRET] [SECRET]" if t[0] == 0 else "é [SECRET] [SECRET] token=x " * t[0])


def test_trigram_queries_lose_no_match():
    grams = lambda t: {t[i : i + 3] for i in range(len(t) - 2)}
    for rule in secrets.RULES:
        query = secrets.trigram_query(rule.pattern)
        for text in SECRETS:
            if re.search(rule.pattern, text, re.ASCII):
                assert all(any(a <= grams(text.lower()) for a in clause) for clause in query), rule.kind
    assert secrets.trigram_query("[0-9a-f]{24,}") == [] and secrets.trigram_query("ab|abcd") == []
    assert secrets.trigram_query("abc(d|e)?") == [frozenset({frozenset({"abc"})})]


def test_redaction_keeps_the_rest(spark):
    text = 'a token = "' + "ab" * 12 + '" b ' + "0" * 24 + " c"
    df = spark.createDataFrame([(1, text), (2, None), (3, "clean")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in secrets.redact(secrets.scan(df)).collect()}
    assert got == {1: 'a [SECRET]" b [SECRET] c', 2: None, 3: "clean"}
    assert secrets.scan(edge.empty(spark)).count() == 0


def test_secret_query_digest(spark, tmp_path):
    d = edge.write(spark, edge.docs(spark), tmp_path)
    for r in queries.QUERIES["op9_secret_index"](spark, d).collect():
        texts = [t for i, t in edge.TEXTS if i == r.doc_id]
        assert r.base_sha256 in {hashlib.sha256(",".join(_base(t)).encode()).hexdigest() for t in texts}


def _render(turns):
    return "".join(f"<|{r or 'user'}|>\n{t or ''}<|end|>\n" for r, t in turns)


def test_common_prefix_and_masks(spark):
    chosen = [(0, "system", "s"), (1, "user", "u"), (2, "assistant", "good é")]
    cases = [
        (1, chosen, [*chosen[:2], (2, "assistant", "bad")]),
        (2, chosen, chosen),
        (3, chosen, []),
        (4, [], []),
        (5, chosen, [*chosen, (3, "user", "more"), (4, "assistant", "x")]),
        (6, [(0, "user", "a")], [(0, "assistant", "a")]),
    ]
    df = spark.createDataFrame(cases, f"conv_id long, chosen_turns array<{chat.TURN}>, rejected_turns array<{chat.TURN}>")
    for r in chat.preferences(df).collect():
        _, a, b = cases[r.conv_id - 1]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x[1:] != y[1:]), min(len(a), len(b)))
        assert r.n_common == n and r.prompt == _render(x[1:] for x in a[:n])
        for text, spans, turns in ((r.chosen, r.chosen_mask, a[n:]), (r.rejected, r.rejected_mask, b[n:])):
            assert text == _render(x[1:] for x in turns)
            assert [text[s.start : s.end] for s in spans] == [f"{t}<|end|>\n" for _, role, t in turns if role == "assistant"]


def test_exchanged_replies_on_edge_turns(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (2, 0, None, None), (2, 1, "assistant", "a2"), (2, 1, "assistant", "a2"), (None, 0, "user", "lost"), (3, 0, "user", "no reply"), (4, None, "assistant", "a4")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    got = {r.conv_id: r for r in chat.preferences(chat.exchanged_replies(df, 1)).collect()}
    assert got.keys() == {1, 2, 4}
    assert got[1].prompt == _render([("user", "q")]) and got[2].n_common == 1
    assert {got[1].rejected, got[2].rejected, got[4].rejected} == {_render([("assistant", a)]) for a in ("a1", "a2", "a4")}
    assert all(r.chosen != r.rejected for r in got.values())
    assert chat.preferences(chat.exchanged_replies(df.limit(0), 1)).count() == 0


@pytest.mark.parametrize("name", ["op1_quality_cascade", "op5_preference_format", "op8_virtual_slots", "op9_secret_index"])
def test_native_queries_run_no_python(spark, capsys, name):
    out = queries.QUERIES[name](spark, SF_SMALL)
    out.explain()
    plan = capsys.readouterr().out
    assert "Physical Plan" in plan and not re.search("Python|Pandas|Arrow", plan)
    assert out.select(F.count(F.lit(1))).first()[0] > 0
