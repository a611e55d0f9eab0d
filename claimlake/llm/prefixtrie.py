"""The prefix trie of conversations, all prefixes aggregated by one ROLLUP.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that start with it. It is named by its smallest member and its
depth; the root has depth 0.

1. Turns get their position in the conversation and an id: 128 bits of SHA-256
   of role and text, with the text's code points.
2. A conversation becomes one row for each block of ``BLOCK`` turns, the ids in
   positional columns. Later blocks are keyed by the node that the blocks before
   end in: the sum of 4 x 32 bits of SHA-256 of every block and its number, which
   equal prefixes share, so blocks of all depths take part in one aggregation.
3. ``GROUP BY block, prior, ROLLUP (t0, ...)`` gives members and smallest member
   of every prefix; grouping_id() tells its depth.
4. A conversation owns the nodes whose smallest member it is: an unbroken range
   of depths down to its end. A sum over a subtree is the sum over its members'
   owned nodes less those that lie above the top node, all of which the top
   node's own smallest member owns. So a second ROLLUP over the owners, with
   each owner's totals, gives leaves and saved code points of every subtree.

A conversation may hold any share of the turns: running sums are taken over
range partitions and carried on from one to the next, and joins use (conversation,
block) or (conversation, depth) as keys.

Defined results: rows without conv_id belong to no conversation; null role or
text counts as empty; order is by turn, null first, then by turn id, so equal
rows are turns one after the other; conversations named in ``ids`` without a
turn end at the root; an empty table gives no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from claimlake.session import materialize

#: Positional columns of a block.
BLOCK = 8
#: Blocks or positions of one conversation that share a join key, and ids (as a power of two) of one list of members.
STRIDE = 4096
ENDS_BITS = 8


class Trie(NamedTuple):
    """``nodes``: conv_id, depth, turn_id, chars, parent_conv_id, n_convs,
    n_children, n_leaves, saved_chars. ``ends``: conv_id and depth of the node
    where the conversations ``conv_ids`` (ascending) end; the lists of a node
    are to be read in the order of ``chunk``."""

    nodes: DataFrame
    ends: DataFrame


def running(df: DataFrame, key: str, order: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Adds to every row the sums of the rows before it, by ``key`` in ``order``.

    Rows are dealt by ranges of key and order, so a key of any size lies in as
    many parts as its rows need. Each part sums its own rows; keys that lie in
    several parts, at most two for each part's borders, get the sums of the parts before."""
    df = df.withColumns({f"__{name}": value for name, value in sums.items()}).withColumn("__row", F.monotonically_increasing_id())
    dealt = df.repartitionByRange(key, *order, "__row").withColumn("__part", F.spark_partition_id())
    dealt = materialize(dealt, "running")
    parts = dealt.groupBy(key, "__part").agg(*[F.sum(f"__{name}").alias(f"__{name}") for name in sums])
    split = parts.groupBy(key).agg(F.min("__part").alias("first"), F.max("__part").alias("last")).where("first < last")
    # only the keys at the borders of parts: at most one for each part
    split = split.select(F.col(key).alias("__key"))
    earlier = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.join(F.broadcast(split), parts[key] == split["__key"], "left_semi").select(
        F.col(key).alias("__key"), F.col("__part").alias("__at"), *[F.coalesce(F.sum(f"__{name}").over(earlier), F.lit(0)).alias(f"__before_{name}") for name in sums]
    )
    within = Window.partitionBy(key, "__part").orderBy(*order, "__row").rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumns({f"__{name}": F.coalesce(F.sum(f"__{name}").over(within), F.lit(0)) for name in sums})
    joined = local.join(F.broadcast(carried), (local[key] == carried["__key"]) & (local["__part"] == carried["__at"]), "left")
    for name in sums:
        joined = joined.withColumn(name, F.col(f"__{name}") + F.coalesce(f"__before_{name}", F.lit(0)))
    return joined.drop("__row", "__part", "__key", "__at", *[f"__{n}" for n in sums], *[f"__before_{n}" for n in sums])


def _digest(c: Column) -> Column:
    return F.substring(F.unhex(F.sha2(c, 256)), 1, 16)


def turn_ids(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, turn_id, chars) of every row that has a conv_id."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = _digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return turns.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", named.alias("turn_id"), F.length(text).cast("long").alias("chars"))


def positions(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_id, chars): every turn with its place in its conversation, from 0."""
    placed = running(turn_ids(turns), "conv_id", ["turn", "turn_id"], {"pos": F.lit(1).cast("long")})
    return placed.select("conv_id", "pos", "turn_id", "chars")


def _blocks(placed: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, block, prior, path) with path the block's turns as structs (id, chars)."""
    marks = ids.select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("binary").alias("turn_id"), F.lit(None).cast("long").alias("chars"))
    turn = F.when(F.col("pos") >= 0, F.struct("pos", F.col("turn_id").alias("id"), "chars"))
    rows = placed.unionByName(marks).groupBy("conv_id", F.floor(F.greatest("pos", F.lit(0)) / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))  # at most BLOCK turns
    rows = rows.select("conv_id", "block", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars"))).alias("path"))
    rows = materialize(rows, "trie-blocks")
    # only conversations that fill their first block have later ones
    many = rows.where((F.col("block") > 0) | (F.size("path") == BLOCK))
    text = F.sha2(F.concat(F.col("block").cast("string"), F.lit(":"), F.array_join(F.transform("path", lambda t: F.hex(t["id"])), ",")), 256)
    lanes = {f"k{i}": F.conv(F.substring(text, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)}
    later = running(many, "conv_id", ["block"], lanes).where("block > 0").withColumn("prior", F.concat_ws(":", *lanes))
    columns = ["conv_id", "block", "prior", "path"]
    return materialize(rows.where("block = 0").withColumn("prior", F.lit("")).select(columns).unionByName(later.select(columns)), "trie-keyed")


def _rolled(rows: DataFrame, aggregates: dict[str, str]) -> DataFrame:
    """The aggregates of all prefixes of all blocks: (block, prior, path, depth, ...)."""
    names = [f"t{i}" for i in range(BLOCK)]
    spread = rows.select("*", *[F.get("path", F.lit(i)).alias(n) for i, n in enumerate(names)])
    # equal rows first, so that ROLLUP expands each distinct block once
    distinct = spread.groupBy("block", "prior", *names).agg(*[F.expr(e).alias(n) for n, e in aggregates.items()])
    again = ", ".join(f"{'min' if e.startswith('min') else 'sum'}({n}) AS {n}" for n, e in aggregates.items())
    rolled = distinct.sparkSession.sql(
        f"SELECT block, prior, {', '.join(names)}, {BLOCK} - bit_count(grouping_id()) AS level, {again} FROM {{distinct}} GROUP BY block, prior, ROLLUP ({', '.join(names)})",
        distinct=distinct,
    )
    rolled = rolled.withColumn("path", F.array_compact(F.array(*names)))
    # a shorter block has nulls behind its end: those groups repeat a shorter prefix; a later block's empty prefix is the node before
    real = (F.size("path") == F.col("level")) & ((F.col("level") > 0) | (F.col("block") == 0))
    return rolled.where(real).withColumn("depth", F.col("block") * BLOCK + F.col("level")).drop("level", *names)


def _parents(steps: DataFrame, nodes: DataFrame, blocks: DataFrame) -> DataFrame:
    """(conv_id, depth, parent): the owner of the node above each conversation's top node."""
    root = nodes.where("depth = 0").select(F.col("conv_id").alias("parent"))
    tops = steps.where("nth = 0 AND depth > 0").select("conv_id", "depth", F.floor((F.col("depth") - 2) / BLOCK).alias("block"))
    first = tops.where("depth = 1").join(F.broadcast(root), F.lit(True), "inner").select("conv_id", "depth", "parent")  # the root is one row
    deep = tops.where("depth > 1").join(blocks, ["conv_id", "block"])
    above = F.slice("path", F.lit(1), (F.col("depth") - 1 - F.col("block") * BLOCK).cast("int"))
    keyed = nodes.select("block", "prior", "path", F.col("conv_id").alias("parent"))
    return first.unionByName(deep.withColumn("path", above).join(keyed, ["block", "prior", "path"]).select("conv_id", "depth", "parent"))


def trie(placed: DataFrame, ids: DataFrame | None = None) -> Trie:
    """The trie of turns that have their places (see :func:`positions`).
    ``ids`` (conv_id) adds conversations that may have no turn."""
    known = placed.select("conv_id") if ids is None else placed.select("conv_id").union(ids.select("conv_id"))
    known = known.where(F.col("conv_id").isNotNull()).distinct()
    blocks = _blocks(placed, known)
    nodes = _rolled(blocks, {"conv_id": "min(conv_id)", "n_convs": "count(*)"})
    nodes = materialize(nodes.withColumn("chars", F.coalesce(F.element_at(F.when(F.size("path") > 0, F.col("path")), -1)["chars"], F.lit(0))), "trie-nodes")

    own = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saves"))
    steps = materialize(running(own, "conv_id", ["depth"], {"above": F.col("saves"), "nth": F.lit(1).cast("long")}), "trie-steps")
    parents = _parents(steps, nodes, blocks).withColumnRenamed("parent", "other")
    linked = steps.join(parents, ["conv_id", "depth"], "left")
    linked = linked.withColumn("parent_conv_id", F.coalesce("other", F.when(F.col("depth") > 0, F.col("conv_id")))).drop("other", "nth")
    linked = materialize(linked, "trie-parents")
    children = linked.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    grown = linked.join(children, ["conv_id", "depth"], "left").fillna(0, ["n_children"])

    owners = grown.groupBy("conv_id").agg(F.sum("saves").alias("all_saved"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"), F.max("depth").alias("deepest"))
    # a row for every STRIDE blocks of the owner: no key of the join holds more blocks
    owners = owners.withColumn("stride", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("deepest") / (BLOCK * STRIDE))))).drop("deepest")
    weighed = blocks.withColumn("stride", F.floor(F.col("block") / STRIDE)).join(owners, ["conv_id", "stride"])
    below = _rolled(weighed, {"conv_id": "min(conv_id)", "all_saved": "sum(all_saved)", "n_leaves": "sum(leaf)"})
    below = below.select("conv_id", "depth", "all_saved", "n_leaves")

    last = F.element_at(F.when(F.size("path") > 0, F.col("path")), -1)["id"].alias("turn_id")
    out = nodes.select("conv_id", "depth", last, "chars", "n_convs").join(grown, ["conv_id", "depth"]).join(below, ["conv_id", "depth"])
    out = out.withColumn("saved_chars", F.col("all_saved") - F.col("above"))
    out = out.select("conv_id", "depth", "turn_id", "chars", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_chars")

    lengths = placed.groupBy("conv_id").agg(F.max("pos").alias("top"))
    lengths = known.join(lengths, "conv_id", "left").select("conv_id", F.floor(F.coalesce("top", F.lit(0)) / BLOCK).alias("block"))
    ends = lengths.join(blocks, ["conv_id", "block"]).groupBy("block", "prior", "path", F.shiftright("conv_id", ENDS_BITS).alias("chunk"))
    ends = ends.agg(F.sort_array(F.collect_list("conv_id")).alias("conv_ids"))  # distinct ids of one chunk: at most 2 ** ENDS_BITS
    ends = ends.join(nodes.select("block", "prior", "path", "conv_id", "depth"), ["block", "prior", "path"])
    return Trie(out, ends.select("conv_id", "depth", "chunk", "conv_ids"))


def prefix_trie(turns: DataFrame, ids: DataFrame | None = None) -> Trie:
    """The trie of conversations given as rows (conv_id, turn, role, text)."""
    return trie(positions(turns), ids)


def with_texts(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """Adds role and text of each node's last turn (null for the root)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = _digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    texts = turns.groupBy(named.alias("turn_id")).agg(F.first(role).alias("role"), F.first(text).alias("text"))
    return nodes.join(texts, "turn_id", "left")


def ends_digest(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256): SHA-256 of a node's ending conversations,
    decimal and comma-joined. One digest is a sequence by nature; its lists pass
    through a task in order, and no more than one of them is held."""
    schema = T.StructType([ends.schema["conv_id"], ends.schema["depth"], T.StructField("ends_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            done = []
            for conv, depth, some in zip(batch.column("conv_id").to_pylist(), batch.column("depth").to_pylist(), batch.column("conv_ids"), strict=True):
                part = ",".join(map(str, some.as_py()))
                if (conv, depth) != at:
                    if at is not None:
                        done.append((*at, digest.hexdigest()))
                    at, digest = (conv, depth), hashlib.sha256()
                else:
                    part = "," + part
                digest.update(part.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=schema.names)
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*at, digest.hexdigest())], names=schema.names)

    dealt = ends.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "chunk")
    return dealt.select("conv_id", "depth", "conv_ids").mapInArrow(run, schema)
