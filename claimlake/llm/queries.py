"""Registered queries of the subpackage: one per operator, each over its whole table.

Every query reads a table, hands it to its operator and derives its digest
columns from the operator's rows. ``ORACLE`` holds DuckDB SQL where SQL can
express the result; the other queries are tested against brute force in
``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OP1_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT *, CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) ELSE []::VARCHAR[] END AS gs FROM w),
u AS (SELECT doc_id, gs, unnest(gs) AS gram, unnest(range(0, len(gs))) AS i FROM g),
r AS (SELECT doc_id, i FROM u QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
m AS (SELECT g.doc_id, g.text, ws,
             CAST(len(ws) AS BIGINT) AS n_words,
             CAST(len(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(g.text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(ls) AS BIGINT) AS n_lines,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
      FROM g LEFT JOIN c ON c.doc_id = g.doc_id),
f AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
             len(regexp_extract_all(text, '[!-@\[-`{-~]')) AS marks FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * n_symbols > n_words
            OR 10 * n_dup_lines > 4 * n_lines
            OR 10 * marks > 6 * word_chars
            OR 10 * len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) > 3 * n_words
            OR 2 * len(regexp_extract_all(text, '[A-Z\x{C0}-\x{D6}\x{D8}-\x{DE}]')) > word_chars
            OR 10 * len(regexp_extract_all(text, '!')) > 3 * n_words
            OR 10 * len(regexp_extract_all(text, '(\.\.\.|\x{2026})(\n|$)')) > 3 * greatest(n_lines, 3)
            OR 10 * len(regexp_extract_all(text, '(^|\n)[*\x{2022}-]\x20')) > 9 * greatest(n_lines, 3)
            OR 20 * len(regexp_extract_all(text, '</?[A-Za-z][^<>\n]{0,200}>|[{}]')) > n_words) AS kept
FROM f
"""


@register(_OP1_SQL)
def op1_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the rule cascade for every document. Which rule
    rejected a row depends on measured costs, so it isn't part of the result."""
    from claimlake.llm import quality

    return quality.filter_quality(table(spark, sf_dir, "documents")).drop("rejected_by")


@register()
def op8_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of eight shards of near equal bytes."""
    from claimlake.llm import sharding

    out = sharding.shard(table(spark, sf_dir, "documents"), 8)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "next_shard",
    )


def _op9_sql() -> str:
    """Positions from the pieces between the matches. The expressions are those of the
    contract and of the published formats, with letters of either case written out
    (DuckDB's case folding goes beyond ASCII) and the vertical tab among white space."""
    either = lambda word: "".join(f"[{x}{x.upper()}]" if x.isalpha() else x for x in word)
    names = "|".join([*map(either, ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")])
    key_name = r"(?:[A-Z]{1,20} ){0,4}PRIVATE KEY-----"
    rules = [
        ("assign", rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        ("access", "AKIA[A-Z0-9]+", 0, 20),
        ("hex", "[0-9a-f]+", 0, 24),
        ("private_key", rf"-----BEGIN {key_name}[A-Za-z0-9+/=\s\x0B]*(?:-----END {key_name})?", 0, 0),
        ("code_host", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
        ("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
        ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 0),
        ("cloud_key", "AIza[A-Za-z0-9_-]{35,}", 0, 0),
        ("payment_key", "sk_live_[A-Za-z0-9]{16,}", 0, 0),
        ("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s\x0B:/@]{1,256}:[^\s\x0B:/@]{3,256}@[A-Za-z0-9.-]+", 0, 0),
    ]
    found = []
    for i, (kind, pattern, group, least) in enumerate(rules):
        p = "'" + pattern.replace("'", "''") + "'"
        found.append(f"""SELECT n, {i} AS o, '{kind}' AS kind, {least} AS least, unnest(range(1, len(m) + 1)) AS i, gaps, m, g
FROM (SELECT n, string_split_regex(text, {p}) AS gaps, regexp_extract_all(text, {p}) AS m, regexp_extract_all(text, {p}, {group}) AS g FROM d)""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(found)}),
l AS (SELECT n, o, kind, least, i, length(gaps[i]) AS gap, length(m[i]) AS size, length(g[i]) AS tested FROM f),
s AS (SELECT n, o, kind, least, tested, size, CAST(sum(gap + size) OVER (PARTITION BY n, o ORDER BY i) - size AS BIGINT) AS start FROM l),
k AS (SELECT n, o, kind, start, kind || ':' || start || ':' || (start + size) AS span FROM s WHERE tested >= least),
a AS (SELECT n, count(*) FILTER (WHERE o = 0) AS n_assign, count(*) FILTER (WHERE o = 1) AS n_access, count(*) FILTER (WHERE o = 2) AS n_hex,
             string_agg(span, ',' ORDER BY start, o) FILTER (WHERE o < 3) AS base, string_agg(span, ',' ORDER BY start, o) AS spans FROM k GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (n)
"""


@register(_op9_sql())
def op9_secret_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts and digest of the base kinds, all spans."""
    from claimlake.llm import secrets as s

    found = s.scan(table(spark, sf_dir, "documents"))
    counts = [F.size(s.of_kinds(F.col("spans"), [kind])).cast("long").alias(f"n_{kind}") for kind in s.BASE_KINDS]
    base = s.listed(s.of_kinds(F.col("spans"), s.BASE_KINDS))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), s.listed(F.col("spans")).alias("spans"))


def _xxhash64_sql(x: str) -> str:
    """Spark's xxhash64 of a bigint column, as a bigint; the numbers are the hash's published primes."""
    p1, p2, p3, p4, p5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
    word, seed = f"{2**64}::UHUGEINT", 42
    turn = lambda h, r: f"(({h} * {2**r}::UHUGEINT) % {word} + {h} // {2 ** (64 - r)}::UHUGEINT)"
    steps = [
        f"(CASE WHEN {x} < 0 THEN CAST({x} AS HUGEINT) + {2**64}::HUGEINT ELSE CAST({x} AS HUGEINT) END)::UHUGEINT",
        f"(h * {p2}::UHUGEINT) % {word}",
        f"xor({seed + p5 + 8}::UHUGEINT, {turn('h', 31)} * {p1}::UHUGEINT % {word})",
        f"({turn('h', 27)} * {p1}::UHUGEINT % {word} + {p4}::UHUGEINT) % {word}",
        f"xor(h, h // {2**33}::UHUGEINT) * {p2}::UHUGEINT % {word}",
        f"xor(h, h // {2**29}::UHUGEINT) * {p3}::UHUGEINT % {word}",
        f"xor(h, h // {2**32}::UHUGEINT)",
        f"CAST(CASE WHEN h >= {2**63}::UHUGEINT THEN h::HUGEINT - {2**64}::HUGEINT ELSE h::HUGEINT END AS BIGINT)",
    ]
    out = f"list_value({steps[0]})"  # a list of one value, so that each step names it once
    for step in steps[1:]:
        out = f"list_transform({out}, lambda h: {step})"
    return f"({out})[1]"


def _op5_sql() -> str:
    rendered = lambda l: f"array_to_string(list_transform({l}, lambda t: '<|' || t.r || '|>' || chr(10) || t.x || '<|end|>' || chr(10)), '')"

    def masked(l: str) -> str:
        sizes = f"list_transform({l}, lambda t: length(t.r) + length(t.x) + 13)"
        upto = lambda i: f"CAST(coalesce(list_sum(({sizes})[1:{i}]), 0) AS BIGINT)"
        trained = f"list_filter(range(1, len({l}) + 1), lambda i: ({l})[i].r = 'assistant')"
        return f"array_to_string(list_transform({trained}, lambda i: ({upto('i - 1')} + length(({l})[i].r) + 5) || ':' || {upto('i')}), ',')"

    return f"""
WITH t AS (SELECT DISTINCT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(struct_pack(r := role, x := text) ORDER BY turn NULLS FIRST, role, text) AS l FROM t GROUP BY conv_id),
w AS (SELECT conv_id, l, list_max(list_filter(range(1, len(l) + 1), lambda i: l[i].r = 'assistant')) AS k FROM c WHERE len(list_filter(l, lambda t: t.r = 'assistant')) > 0),
n AS (SELECT greatest(1, count(*) // 128) AS pools FROM w),
p AS (SELECT conv_id, l, k, l[k].x AS reply, (({_xxhash64_sql('conv_id')} % pools) + pools) % pools AS pool FROM w, n),
o AS (SELECT *, lead(reply) OVER (PARTITION BY pool ORDER BY conv_id) AS after_it, first_value(reply) OVER (PARTITION BY pool ORDER BY conv_id) AS first_one,
             count(*) OVER (PARTITION BY pool) AS together FROM p),
e AS (SELECT list(struct_pack(id := conv_id, reply := reply) ORDER BY conv_id) AS two FROM (SELECT conv_id, reply FROM p ORDER BY conv_id LIMIT 2)),
x AS (SELECT conv_id, l, k, reply, CASE WHEN together > 1 THEN coalesce(after_it, first_one) ELSE coalesce(CASE WHEN two[1].id <> conv_id THEN two[1].reply ELSE two[2].reply END, '') END AS other FROM o, e),
s AS (SELECT conv_id, l, list_transform(l, lambda t, i: CASE WHEN i = k THEN struct_pack(r := t.r, x := other) ELSE t END) AS m, CASE WHEN other = reply THEN len(l) ELSE k - 1 END AS n FROM x),
y AS (SELECT conv_id, n, l[1:n] AS shared, l[n + 1:] AS a, m[n + 1:] AS b FROM s)
SELECT conv_id, CAST(n AS INTEGER) AS n_common, {rendered('shared')} AS prompt, {rendered('a')} AS chosen, {masked('a')} AS chosen_mask,
       {rendered('b')} AS rejected, {masked('b')} AS rejected_mask
FROM y
"""


@register(_op5_sql())
def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and masked completions for every conversation with a reply, the
    rejected side made by exchanging the last reply within a pool."""
    from claimlake.llm import chat

    turns = table(spark, sf_dir, "conversations")
    out = chat.preferences(chat.exchanged_replies(turns, chat.pools_for(turns)))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(c)
    return out.select("conv_id", "n_common", "prompt", "chosen", spans("chosen_mask"), "rejected", spans("rejected_mask"))


@register()
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces of at most 1024 tokens and their places in sequences."""
    import public_tokenizers

    from claimlake.llm import packing

    vocabulary, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), vocabulary, ranks))


@register()
def op6_output_code_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language, score and ambiguity of every whole document."""
    from claimlake.llm import langid

    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(langid.labelled(docs)))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


#: Equal sets first; sets that share enough have one of their rarest shingles in common
#: (so many that the others alone would not be enough), and are compared whole then.
_OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
d AS MATERIALIZED (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 1 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END)) AS sh FROM w),
c AS MATERIALIZED (SELECT sh, min(doc_id) AS rep FROM d WHERE len(sh) > 0 GROUP BY sh),
u AS (SELECT rep, len(sh) AS n, unnest(sh) AS g FROM c),
r AS (SELECT rep, n, g, row_number() OVER (PARTITION BY rep ORDER BY df, g) AS i FROM u JOIN (SELECT g, count(*) AS df FROM u GROUP BY g) USING (g)),
p AS MATERIALIZED (SELECT rep, n, g FROM r WHERE i <= n - (80 * n + 99) // 100 + 1),
q AS MATERIALIZED (SELECT DISTINCT x.rep AS a, y.rep AS b FROM p x JOIN p y ON x.g = y.g AND x.rep < y.rep AND 100 * x.n >= 80 * y.n AND 100 * y.n >= 80 * x.n),
l AS MATERIALIZED (SELECT a, b FROM (SELECT a, b, len(list_intersect(x.sh, y.sh)) AS m, len(x.sh) + len(y.sh) AS t FROM q JOIN c x ON x.rep = a JOIN c y ON y.rep = b) WHERE 100 * m >= 80 * (t - m)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
z(a, least_id) AS (SELECT rep, rep FROM c UNION SELECT e.b, z.least_id FROM z JOIN e ON e.a = z.a WHERE z.least_id < e.b),
k AS (SELECT a, min(least_id) AS component FROM z GROUP BY a)
SELECT d.doc_id, CAST(len(d.sh) AS BIGINT) AS n_shingles, coalesce(k.component, d.doc_id) AS component_id, coalesce(k.component, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN c ON c.sh = d.sh LEFT JOIN k ON k.a = c.rep
"""


@register(_OP10_SQL)
def op10_minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by two-word shingles."""
    from claimlake.llm import neardup

    return neardup.groups(table(spark, sf_dir, "documents"), k=2, percent=80)


@register()
def op7_line_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its repeated lines taken out: counts and digest."""
    from claimlake.llm import linededup

    out = linededup.dedup_lines(table(spark, sf_dir, "documents"), least_words=1)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").alias("n_left_chars"), crc.alias("text_crc32"))


@register()
def op4_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every whole document, decoded again."""
    import public_tokenizers

    from claimlake.llm import pieces

    model = public_tokenizers.path("piece_bpe_32k.model")
    out = pieces.sample(table(spark, sf_dir, "documents"), model, k=2, decoded=True)
    return out.select(
        "doc_id", "sample", "n_pieces", "log_prob", "perturbed", "inclusion", F.crc32("ids").alias("ids_crc32"), F.crc32(F.col("decoded").cast("binary")).alias("text_crc32")
    )


_OP3_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS ts FROM documents),
d AS (SELECT doc_id, len(ts) AS n, ts FROM t WHERE len(ts) > 0),
c AS MATERIALIZED (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(ts) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM c GROUP BY term),
g AS (SELECT count(*) AS docs, avg(n) AS mean FROM d),
w AS (SELECT term, ln(1 + (docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) AS idf FROM f, g),
q AS (SELECT doc_id AS query_id, term, idf FROM c JOIN w USING (term) WHERE doc_id % 100 = 0),
s AS (SELECT query_id, doc_id, sum(idf * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n / mean)) ORDER BY term) AS score
      FROM q JOIN c USING (term), g GROUP BY query_id, doc_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM s)
SELECT * FROM r WHERE rank <= 10
"""


@register(_OP3_SQL)
def op3_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 100."""
    from claimlake.llm import search

    docs = table(spark, sf_dir, "documents")
    found = search.top_k(docs, docs.where(F.col("doc_id") % 100 == 0), 10)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))


def _rebuilt(placed: DataFrame) -> DataFrame:
    """Every conversation's first h turns from the one that ends its hundred
    (conv_id - conv_id % 100), h = crc32(conv_id) % 6, then its own after its first h."""
    from claimlake.llm.prefixtrie import STRIDE

    own = placed.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    own = own.select("conv_id", "n_own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 100).alias("base"))
    lead = placed.where((F.col("conv_id") % 100 == 0) & (F.col("pos") < 5)).withColumnRenamed("conv_id", "base")  # at most five turns
    heads = own.join(lead, "base").where("pos < h").select("conv_id", "pos", "turn_id", "chars")
    taken = own.join(lead.groupBy("base").agg(F.count("*").alias("n_base")), "base", "left")
    taken = taken.withColumn("shift", F.least("h", F.coalesce("n_base", F.lit(0))) - F.col("h"))
    # a key for every STRIDE turns: one conversation's turns don't meet in one task
    taken = taken.withColumn("stride", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n_own") / STRIDE))))
    tails = placed.withColumn("stride", F.floor(F.col("pos") / STRIDE)).join(taken.select("conv_id", "stride", "h", "shift"), ["conv_id", "stride"])
    tails = tails.where("pos >= h").select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "turn_id", "chars")
    return heads.unionByName(tails)


_OP11_SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(struct_pack(r := role, x := text) ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS l FROM t GROUP BY conv_id),
c AS (SELECT conv_id, l,
             xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda b: CAST(ord(b) AS BIGINT))),
                 lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]),
                     lambda s, i: xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT) % 6 AS h
      FROM o),
r AS (SELECT c.conv_id, list_concat(coalesce(b.l, [])[1:c.h], c.l[c.h + 1:]) AS l FROM c LEFT JOIN o b ON b.conv_id = c.conv_id - c.conv_id % 100),
p AS (SELECT conv_id, len(l) AS n, unnest(range(0, len(l) + 1)) AS depth, l FROM r),
n AS (SELECT depth, l[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
             coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '') AS ends
      FROM p GROUP BY ALL),
k AS (SELECT u.depth, u.path, u.conv_id, u.n_convs, u.ends, q.conv_id AS parent_conv_id
      FROM n u LEFT JOIN n q ON q.depth = u.depth - 1 AND q.path = u.path[1:u.depth - 1]),
g AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM k WHERE depth > 0 GROUP BY ALL),
m AS (SELECT k.*, coalesce(g.n_children, 0) AS n_children, CASE WHEN k.depth = 0 THEN 0 ELSE (k.n_convs - 1) * length(k.path[k.depth].x) END AS saves
      FROM k LEFT JOIN g USING (conv_id, depth)),
a AS (SELECT d AS depth, path[1:d] AS path, CAST(sum(saves) AS BIGINT) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM m) GROUP BY ALL)
SELECT m.conv_id, m.depth, m.parent_conv_id, m.n_convs, m.n_children, a.n_leaves, a.saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN a USING (depth, path)
"""


@register(_OP11_SQL)
def op11_prefix_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    from claimlake.llm import prefixtrie

    turns = table(spark, sf_dir, "conversations")
    placed = prefixtrie.positions(turns)
    tree = prefixtrie.trie(_rebuilt(placed), turns.select("conv_id"))
    digests = prefixtrie.ends_digest(tree.ends)
    out = tree.nodes.join(digests, ["conv_id", "depth"], "left")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved_chars").alias("saved_tokens"), F.coalesce("ends_sha256", empty).alias("ends_sha256")
    )


def _op12_sql(rounds: int = 6) -> str:
    near = "SELECT x.vec_id, x.n, x.label, x.p, x.v, min(CAST(list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS HUGEINT) * 16 + c.k) AS dk FROM x JOIN {book} c ON c.p = x.p GROUP BY ALL"
    steps = []
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED ({near.format(book=f'c{i}')})")
        steps.append(
            f"""s{i} AS (SELECT p, k, list(CAST((s - ((s % m) + m) % m) // m AS BIGINT) ORDER BY j) AS v FROM (
  SELECT p, dk % 16 AS k, j, sum(v[j]) AS s, count(*) AS m FROM (SELECT *, unnest(range(1, len(v) + 1)) AS j FROM a{i}) GROUP BY ALL) GROUP BY p, k)"""
        )
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.p, c.k, coalesce(s.v, c.v) AS v FROM c{i} c LEFT JOIN s{i} s ON s.p = c.p AND s.k = c.k)")
    last = f"c{rounds}"
    return f"""
WITH kept AS (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS n FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
x AS MATERIALIZED (SELECT vec_id, label, n, p, list_transform(embedding[p * len(embedding) // 8 + 1:(p + 1) * len(embedding) // 8], lambda e: CAST(floor(4096 * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM kept, (SELECT unnest(range(0, 8)) AS p)),
c0 AS (SELECT p, n AS k, v FROM x WHERE n < 16),
{", ".join(steps)},
f AS ({near.format(book=last)}),
o AS (SELECT vec_id, n, label, string_agg(printf('%02x', CAST(dk % 16 AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(dk // 16) AS BIGINT) AS error FROM f GROUP BY vec_id, n, label),
b AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM {last})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM o, b
"""


@register(_op12_sql())
def op12_bounded_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector by codebooks of eight parts after six rounds."""
    from claimlake.llm import vectorcode

    coded, books = vectorcode.train(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)
    out = vectorcode.label_errors(coded)
    code = F.lower(F.hex("codes")).alias("code")
    return out.select(F.col("id").alias("vec_id"), code, "error", "label_error", F.lit(vectorcode.books_sha256(books[-1])).alias("codebooks_sha256"))


@register()
def op13_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document and their bytes, as digests."""
    import public_tokenizers

    from claimlake.llm import chunkbpe

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = chunkbpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    out = chunkbpe.decode(encoded, ranks, public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
