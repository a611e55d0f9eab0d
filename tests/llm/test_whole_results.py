"""Results that must be whole: links of ids with several texts, conversations of any length, texts without labels."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from claimlake.llm import chat, neardup, queries
from tests.llm import edge


def brute_groups(rows, k, percent):
    """{id: least id reachable} by comparing all pairs of texts."""
    sets = [(i, neardup.shingles(t, k)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            x, y = find(i), find(j)
            if x != y and 100 * len(a & b) >= percent * len(a | b):
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}

def variants(seed, templates=4, each=40, other_text=True):
    """Variants of templates, a few words changed in each; an unrelated second text for every id."""
    r = random.Random(seed)
    rows, i = [], 0
    for t in range(templates):
        words = edge.prose(1000 + t, 120).split(" ")
        for _ in range(each):
            some = list(words)
            for at in r.sample(range(len(some)), r.choice([0, 1, 2, 4, 6, 8])):
                some[at] = f"w{r.randint(0, 999)}"
            i += 1
            rows.append((i, " ".join(some)))
            if other_text:
                rows.append((i, edge.prose(5000 + i, 60)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("other_text", [True, False])
def test_no_link_is_lost_for_ids_with_several_texts(spark, seed, other_text):
    rows = variants(seed, other_text=other_text)
    got = {(r.doc_id, r.component_id) for r in neardup.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), k=2, percent=80).collect()}
    want = brute_groups(rows, 2, 80)
    assert got == set(want.items())


@pytest.mark.parametrize("length", [4, 600])
def test_every_conversation_with_a_reply_gives_a_pair(spark, tmp_path, length):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{c} says {t}") for c in range(64) for t in range(length)]
    rows += [(100, 0, "user", "no reply"), (None, 1, "assistant", "nobody")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op5_preference_format(spark, str(tmp_path)).collect()
    assert sorted(r.conv_id for r in got) == list(range(64))
    assert all(r.chosen != r.rejected for r in got)


def test_lone_conversations_take_another_pools_reply(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(c, t, "assistant" if t else "user", f"{c} says {t}") for c in range(30) for t in range(2)]
    got = chat.exchanged_replies(spark.createDataFrame(rows, schema), 100_000).collect()
    reply = {r.conv_id: r.rejected_turns[1].text for r in got}
    assert set(reply) == set(range(30)) and all(text != f"{c} says 1" for c, text in reply.items())
    assert reply[0] == "1 says 1"
    one = chat.exchanged_replies(spark.createDataFrame(rows[:2], schema), 5).collect()
    assert [r.rejected_turns[1].text for r in one] == [""]


def test_pipeline_keeps_unlabelled_texts(spark):
    rows = [(i, edge.prose(i, 50), None, "s", 1) for i in range(20)] + [(50, "4711 ++", None, "s", 7), (51, None, None, "s", 0), (52, "", None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()) == list(range(20))


def test_ambiguity_does_not_depend_on_the_number_of_languages(spark):
    rows = [(i, edge.prose(i, 80) if i % 2 else edge.prose(i, 80).replace("a", "o").replace("e", "u"), "xy"[i % 2], "s", 1) for i in range(200)]
    half = " ".join([rows[1][1], rows[2][1]])
    docs = spark.createDataFrame([*rows, (900, half, None, "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert set(range(200)) <= kept


def _prose(rng: random.Random, lines: int = 10, words: int = 12) -> list[list[str]]:
    return [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) for _ in range(words)] for _ in range(lines)]


def _text(lines: list[list[str]]) -> str:
    return "\n".join(" ".join(x) for x in lines)


@pytest.mark.parametrize("changes", [0, 1, 3, 6])
def test_near_copies_go_whole_and_originals_stay(spark, changes):
    rng = random.Random(changes)
    originals = [_prose(rng) for _ in range(100)]
    copies = []
    for lines in originals:
        copy = [list(x) for x in lines]
        for _ in range(changes):  # also several in one line
            copy[rng.randrange(10)][rng.randrange(12)] = "zz" + str(rng.randrange(10**6))
        copies.append(copy)
    rows = [(i, _text(x)) for i, x in enumerate(originals + copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.near_dedup(spark, corpus_pipeline.line_dedup(spark, docs, ""), "").collect()}
    assert all(got.get(i) == text for i, text in rows[:100])
    left = {i for i in got if i >= 100}
    # a copy can stay only if more than a fifth of its lines differ by two words or more
    assert all(5 * sum(sum(a != b for a, b in zip(x, y, strict=True)) > 1 for x, y in zip(originals[i - 100], copies[i - 100], strict=True)) > 10 for i in left)
    assert len(left) <= 2


def test_lines_of_its_own_and_shared_headers_take_no_document_out(spark):
    rng = random.Random(5)
    header, body, other = _prose(rng, 6), _prose(rng, 4), _prose(rng, 4)
    template = _prose(rng, 1)[0]
    listing = [[*template[:-1], f"n{i}"] for i in range(50)]  # each within one edit of the first
    rows = [(1, _text(header + body)), (2, _text(header + other)), (3, _text(listing)), (4, _text([body[0]] * 30 + _prose(rng, 5)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert got[1] == rows[0][1] and got[2] == _text(other) and got[3] == " ".join(listing[0])
