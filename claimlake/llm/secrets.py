"""Secret scans over a trigram inverted index.

Each rule is a regular expression. ``trigram_query`` derives from it which
three-character sequences a text must hold to be able to match: an AND of
clauses, each an OR of trigram sets. ``build_index`` writes the postings
(trigram, row key) of every trigram that some rule asks for; ``candidates``
intersects the postings per rule; ``scan`` verifies the candidates with the
rule's expression. A rule without mandatory trigrams scans every text. The
index is over lower-cased text, which can only add candidates.

Spans are in code points, end exclusive; matches of one rule never overlap
(leftmost first), and those that fail a rule's length test are dropped after
they have been matched.

Defined results: a null or empty text has no spans; repeated rows and repeated
or null ids give one result per row (postings are keyed by a hash of id and
text, and a shared key only adds a candidate, which is verified by itself);
an empty table gives an empty result; extra columns are kept only if named.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from re import _constants as rc
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.session import materialize


@dataclass(frozen=True)
class Rule:
    """``pattern`` holds for Java and Python; ``group`` must have ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: Base rules. Runs of one class are matched whole, so a least length may stand in the pattern itself.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Published formats of keys and tokens.
EXTRA = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]{1,20} ){0,4}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END (?:[A-Z]{1,20} ){0,4}PRIVATE KEY-----)?"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("payment_key", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,256}:[^\s:/@]{3,256}@[A-Za-z0-9.-]+"),
)
RULES = BASE + EXTRA

#: Sets of literal strings larger than this are cut into separate clauses.
MAX_STRINGS = 128
#: Matches of a text whose positions are added up at a time.
FOLD_BLOCK = 256

Clause = frozenset[frozenset[str]]


def _clause(strings: set[str]) -> list[Clause]:
    """OR over the strings of the AND of their trigrams; nothing if one is too short."""
    if any(len(s) < 3 for s in strings):
        return []
    alternatives = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    return [frozenset(a for a in alternatives if not any(b < a for b in alternatives))]


def _characters(items) -> set[str] | None:
    """Lower-cased members of a character class, None if it is large or negated."""
    found: set[str] = set()
    for op, value in items:
        if op is rc.LITERAL:
            found.add(chr(value).lower())
        elif op is rc.RANGE and value[1] - value[0] < MAX_STRINGS:
            found |= {chr(x).lower() for x in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _part(op, value) -> tuple[set[str] | None, list[Clause]]:
    """(strings the part matches exactly, or None; clauses that hold for it)."""
    if op is rc.LITERAL:
        return {chr(value).lower()}, []
    if op is rc.IN:
        return _characters(value), []
    if op is rc.AT:
        return {""}, []
    if op is rc.SUBPATTERN:
        return _sequence(value[3])
    if op is rc.BRANCH:
        parts = [_sequence(x) for x in value[1]]
        if all(exact is not None for exact, _ in parts):
            return set().union(*(exact for exact, _ in parts)), []
        if not all(clauses for _, clauses in parts):
            return None, []
        either = {frozenset().union(*pick) for _, clauses in parts for pick in itertools.product(*clauses)}
        return None, [frozenset(either)]
    if op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
        least, most, body = value
        exact, clauses = _sequence(body)
        if exact is not None and most == 1:
            return exact | {""}, []
        return None, (_clause(exact) if exact is not None else clauses) if least else []
    return None, []


def _sequence(parts) -> tuple[set[str] | None, list[Clause]]:
    whole, strings, clauses = True, {""}, []
    for op, value in parts:
        exact, more = _part(op, value)
        if exact is not None and len(strings) * len(exact) <= MAX_STRINGS:
            strings = {a + b for a in strings for b in exact}
            continue
        clauses += _clause(strings) + more
        whole, strings = False, exact if exact is not None else {""}
    return (strings, []) if whole else (None, clauses + _clause(strings))


def trigram_query(pattern: str) -> list[Clause]:
    """The Boolean trigram query of an expression, AND over the clauses; an
    empty list means that any text may match."""
    exact, clauses = _sequence(_parser.parse(pattern))
    return _clause(exact) if exact is not None else clauses


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def build_index(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Stored postings (gram, key), each pair once per row, sorted by trigram
    within a file so that readers of few trigrams skip the rest. Trigrams that
    no rule asks for have no postings."""
    grams = sorted({g for r in rules for c in trigram_query(r.pattern) for a in c for g in a})
    wanted = F.array(*[F.lit(g) for g in grams]) if grams else F.array().cast("array<string>")
    # the lower-cased text is bound once, by a one-element array, and not per trigram
    found = F.get(F.transform(F.array(F.lower("text")), lambda low: F.filter(wanted, lambda g: F.contains(low, g))), F.lit(0))
    postings = docs.where(F.col("text").isNotNull()).select(_key().alias("key"), F.explode(found).alias("gram"))
    return materialize(postings.sortWithinPartitions("gram"), "trigram_index")


def candidates(index: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(key, kinds): the rules whose trigram query the row's postings satisfy."""
    rows = [
        (r.kind, c, a, gram, len(alternative), len(clauses))
        for r in rules
        for clauses in [trigram_query(r.pattern)]
        for c, clause in enumerate(clauses)
        for a, alternative in enumerate(sorted(clause, key=sorted))
        for gram in sorted(alternative)
    ]
    schema = "kind string, clause int, alternative int, gram string, n_grams int, n_clauses int"
    terms = index.sparkSession.createDataFrame(rows, schema)  # as large as the rules
    hits = index.dropDuplicates(["key", "gram"]).join(F.broadcast(terms), "gram")
    met = hits.groupBy("key", "kind", "n_clauses", "clause", "alternative", "n_grams").agg(F.count(F.lit(1)).alias("n"))
    met = met.where("n = n_grams").groupBy("key", "kind", "n_clauses").agg(F.count_distinct("clause").alias("n"))
    return met.where("n = n_clauses").groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def _fold(items: Column, kind: str, step: Callable[[Column, Column, Column], tuple[Column, Column]]) -> Column:
    """struct(at, out) after all items: ``step(at, out, item)`` gives the next
    position and list of ``kind``. ``concat`` copies the list that it extends, so
    lists grow within blocks of items only and the blocks' lists are joined once."""
    none = F.array().cast(f"array<{kind}>")
    starts = F.when(F.size(items) > 0, F.sequence(F.lit(0), F.size(items) - 1, F.lit(FOLD_BLOCK))).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda i: F.slice(items, i + 1, F.lit(FOLD_BLOCK)))

    def inner(state: Column, x: Column) -> Column:
        at, out = step(state["at"], state["out"], x)
        return F.struct(at.alias("at"), out.alias("out"))

    def outer(state: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(state["at"].alias("at"), none.alias("out")), inner)
        # bound once, by a one-element array
        grown = F.transform(F.array(done), lambda d: F.struct(d["at"].alias("at"), F.concat(state["out"], F.array(d["out"])).alias("out")))
        return F.get(grown, F.lit(0))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    return F.aggregate(blocks, zero, outer, lambda s: F.struct(s["at"].alias("at"), F.flatten(s["out"]).alias("out")))


def _spans(rule: Rule, order: int) -> Column:
    """Spans of the rule in ``text``: the pieces between the matches and the
    matches themselves, laid end to end, give the positions."""
    p = F.lit(rule.pattern)
    pieces, found = F.split("text", rule.pattern, -1), F.regexp_extract_all("text", p, F.lit(0))
    tested = F.regexp_extract_all("text", p, F.lit(rule.group)) if rule.least else found
    sizes = F.arrays_zip(
        F.transform(pieces, F.length).alias("gap"), F.transform(found, F.length).alias("size"), F.transform(tested, F.length).alias("tested")
    )
    # the piece behind the last match has no match of its own
    sizes = F.filter(sizes, lambda x: x["size"].isNotNull())
    span = "struct<start:int,order:int,kind:string,end:int>"

    def step(at: Column, out: Column, x: Column) -> tuple[Column, Column]:
        start = at + x["gap"]
        one = F.struct(start.alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), (start + x["size"]).alias("end"))
        return start + x["size"], F.when(x["tested"] >= rule.least, F.concat(out, F.array(one))).otherwise(out)

    return _fold(sizes, span, step)["out"]


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, text and ``spans``, an array of (start, order, kind,
    end) sorted by start, then by the rule's place in the list. Only candidates
    of a rule are matched against it, except for rules without a trigram query."""
    gated = [r for r in rules if trigram_query(r.pattern)]
    found = candidates(build_index(docs, gated), gated)
    rest = [c for c in keep if c not in ("doc_id", "text")]
    left = docs.select("doc_id", "text", *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(rest)])
    df = left.withColumn("key", _key()).join(found, "key", "left")
    none = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    parts = []
    for i, r in enumerate(rules):
        may = F.array_contains("kinds", r.kind) if r in gated else F.col("text").rlike(r.pattern)
        parts.append(F.when(F.coalesce(may, F.lit(False)), _spans(r, i)).otherwise(none))
    spans = F.sort_array(F.concat(*parts))
    names = [F.col(f"kept_{rest.index(c)}").alias(c) if c in rest else F.col(c) for c in keep]
    text = [] if "text" in keep else ["text"]
    return df.select(*names, *text, spans.alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redact(scanned: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    # where every span begins and the furthest end so far; one that starts inside those before adds no mark
    def furthest(at: Column, out: Column, s: Column) -> tuple[Column, Column]:
        one = F.struct(at.alias("from"), s["start"].alias("start"), (s["start"] >= at).alias("apart"))
        return F.greatest(at, s["end"]), F.concat(out, F.array(one))

    def parts(state: Column) -> Column:
        between = lambda x: F.substring(F.col("text"), x["from"] + 1, F.greatest(x["start"] - x["from"], F.lit(0)))
        cut = F.transform(F.filter(state["out"], lambda x: x["apart"]), lambda x: F.concat(between(x), F.lit(mark)))
        return F.concat(F.array_join(cut, ""), F.substring(F.col("text"), state["at"] + 1, F.length("text")))

    state = _fold(F.col("spans"), "struct<from:int,start:int,apart:boolean>", furthest)
    whole = F.get(F.transform(F.array(state), parts), F.lit(0))
    text = F.when(F.size("spans") > 0, whole).otherwise(F.col("text"))
    return scanned.withColumn("text", text)


BASE_KINDS = tuple(r.kind for r in BASE)
