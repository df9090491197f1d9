"""Prefix trie of rebuilt conversations from mergeable partial tries (operator 12).

1. Turns are dealt by ranges of (conversation, turn, role, text), so one conversation of any length may lie in several
   partitions; positions, prefix keys and path sums run within a partition and are carried over from its neighbours by one
   row a conversation and partition.
2. Every conversation is rebuilt: the first turns of its hundred's first conversation, then its own.
3. A node is keyed by its depth and 120 bits: the exclusive or of its turns' SHA-256, each with its place. A parent's key is
   the node's without its last turn, so no path is ever shipped.
4. Partial tries: each partition combines its turns into a node table (members, least member, key of the parent); tables
   meet by their keys' hash and merge by sums and minima, as often as there are tables (:func:`merge_nodes` is associative).
   End lists travel as sorted runs of ids: partitions join their own runs, runs of one node are merged in order of their
   first id into its digest, so a node where any share of all conversations ends is never one row.
5. Bottom-up rollup without a round a level: the least member of a node owns it, what a conversation owns is the tail of its
   own path, and the subtree of a node is what its members own at or below its depth. Sums run up each path from its end;
   one aggregate over the members gives every subtree's leaves and saved tokens.

Defined results: null role and text are empty; a null turn comes first; turns that tie are ordered by role and text, and repeated
rows stay; rows without conversation id belong to no conversation and are left out; an empty table has no node. Roles
and texts of any length count whole; columns other than the four named are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import forget, save, table, tidy

#: Conversations share the opening of the first conversation of their hundred: of at most ``MOST_SHARED - 1`` turns.
FAMILY, MOST_SHARED = 100, 6
#: Bytes of a run of ids, at most about.
RUN_BYTES = 1 << 16
_KEY = ("depth", "k1", "k2")


def _carried(rows: DataFrame, order: str, running: dict[str, tuple], backwards: bool = False) -> DataFrame:
    """Running aggregates over each conversation's rows in ``order``, up to the row itself, across its parts.

    ``running``: name to (aggregate function, column, joiner of the earlier parts' value with the own one).
    """
    seq = (lambda c: F.col(c).desc()) if backwards else F.col
    before = W.partitionBy("_conv").orderBy(seq("_part")).rowsBetween(W.unboundedPreceding, -1)
    within = W.partitionBy("conv_id", "part").orderBy(seq(order)).rowsBetween(W.unboundedPreceding, W.currentRow)
    parts = rows.groupBy(F.col("conv_id").alias("_conv"), F.col("part").alias("_part")).agg(*[f(c).alias(f"_{n}") for n, (f, c, _) in running.items()])
    parts = parts.select("_conv", "_part", *[F.coalesce(f(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n, (f, _, _) in running.items()])
    joined = rows.join(parts, (F.col("conv_id") == F.col("_conv")) & (F.col("part") == F.col("_part")))
    return joined.select(*rows.columns, *[join(F.col(f"_{n}"), f(c).over(within)).alias(n) for n, (f, c, join) in running.items()])


def _add(a: Column, b: Column) -> Column:
    return a + b


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def ordered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, part, pos, digest, chars) of all turns: their place in the conversation, SHA-256 of role and text, code points of the text. Saved."""
    turns = df.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keys = ("conv_id", "turn", "role", "text")
    # The role's length first: no two pairs of role and text make one string.
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    dealt = turns.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", F.monotonically_increasing_id().alias("at"), digest.alias("digest"), F.length("text").cast("long").alias("chars"))
    dealt = save(dealt, "turns").select("conv_id", F.shiftright("at", 33).cast("int").alias("part"), "at", "digest", "chars", F.lit(1).cast("long").alias("_one"))
    out = save(_carried(dealt, "at", {"pos": (F.sum, "_one", _add)}).select("conv_id", "part", (F.col("pos") - 1).alias("pos"), "digest", "chars"), "positions")
    return out


def rebuild(turns: DataFrame) -> DataFrame:
    """The rebuilt conversations, (conv_id, part, pos, digest, chars), and for every conversation one row at pos -1, the root."""
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = convs.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).alias("h"))
    sizes = convs.where("conv_id = base").select(F.col("conv_id").alias("_base"), F.col("n").alias("_n"))
    convs = convs.join(sizes, F.col("base") == F.col("_base"), "left").select("conv_id", "base", "h", F.least("h", F.coalesce("_n", F.lit(0))).alias("shared"))
    convs = save(convs, "conversations")
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < MOST_SHARED - 1)).select(F.col("conv_id").alias("_base"), "pos", "digest", "chars")
    opening = convs.where("shared > 0").join(heads, (F.col("base") == F.col("_base")) & (F.col("pos") < F.col("h"))).select("conv_id", F.lit(-1).alias("part"), "pos", "digest", "chars")
    own = turns.join(convs.select(F.col("conv_id").alias("_conv"), "h", "shared"), F.col("conv_id") == F.col("_conv")).where("pos >= h")
    own = own.select("conv_id", "part", (F.col("pos") - F.col("h") + F.col("shared")).alias("pos"), "digest", "chars")
    root = convs.select("conv_id", F.lit(-2).alias("part"), F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("chars"))
    out = opening.union(own).union(root)
    out._sources = [convs]
    return out


def prefix_rows(rebuilt: DataFrame) -> DataFrame:
    """One row per conversation and node on its path: conv_id, part, depth, the node's key k1, k2, its parent's p1, p2, and chars."""
    placed = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("digest")).cast("binary"), 256)
    own = [F.when(F.col("digest").isNull(), F.lit(0).cast("long")).otherwise(F.conv(F.substring(placed, at, 15), 16, 10).cast("long")) for at in (1, 16)]
    rows = rebuilt.select("conv_id", "part", (F.col("pos") + 1).alias("depth"), "chars", own[0].alias("o1"), own[1].alias("o2"))
    rows = _carried(rows, "depth", {"k1": (F.bit_xor, "o1", _xor), "k2": (F.bit_xor, "o2", _xor)})
    return rows.select("conv_id", "part", *_KEY, F.col("k1").bitwiseXOR(F.col("o1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("o2")).alias("p2"), "chars")


def partial_nodes(paths: DataFrame) -> DataFrame:
    """Node tables of paths, one node a row and path: depth, k1, k2, p1, p2, chars, n_convs, conv_id; to be merged."""
    return paths.select(*_KEY, "p1", "p2", "chars", F.lit(1).cast("long").alias("n_convs"), "conv_id")


def merge_nodes(*tables: DataFrame) -> DataFrame:
    """Node tables merged by key: members are summed, the least member stays. Partitions combine their own nodes before the shuffle.

    Associative: tries of any parts of the conversations merge to the trie of all.
    """
    both = tables[0]
    for t in tables[1:]:
        both = both.unionByName(t)
    return both.groupBy(*_KEY).agg(F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("chars").alias("chars"), F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))


def _runs(batches):
    """Sorted (depth, k1, k2, conv_id) to runs: (depth, k1, k2, first, ids joined by commas)."""
    key, first, held, size, out = None, 0, [], 0, []
    for batch in batches:
        for *now, conv in zip(*[c.to_pylist() for c in batch.columns]):
            if held and (now != key or size >= RUN_BYTES):
                out.append((*key, first, ",".join(held)))
                held = []
            if not held:
                key, first, size = now, conv, 0
            held.append(str(conv))
            size += len(held[-1]) + 1
        if out:
            yield _batch(out, _RUN)
            out = []
    if held:
        yield _batch([(*key, first, ",".join(held))], _RUN)


def _end_digests(batches):
    """Runs in order of their nodes and first ids to (depth, k1, k2, SHA-256 of all ids)."""
    key, digest, out = None, None, []
    for batch in batches:
        for *now, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
            if now != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = now, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if out:
            yield _batch(out, _END)
            out = []
    if key is not None:
        yield _batch([(*key, digest.hexdigest())], _END)


_RUN = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
_END = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) from (depth, k1, k2, conv_id): SHA-256 of each node's ids, ascending, joined by commas."""
    runs = ends.repartitionByRange(*_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id").mapInArrow(tidy(_runs), "depth long, k1 long, k2 long, first long, ids string")
    return runs.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(tidy(_end_digests), "depth long, k1 long, k2 long, ends_sha256 string")


def _same(a: str, b: tuple) -> Column:
    """Equality of the key columns of alias ``a`` with the columns ``b``."""
    return (F.col(f"{a}.depth") == b[0]) & (F.col(f"{a}.k1") == b[1]) & (F.col(f"{a}.k2") == b[2])


def trie(df: DataFrame, **columns) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = ordered_turns(df, **columns)
    rebuilt = rebuild(turns)
    paths = save(prefix_rows(rebuilt), "paths")
    forget(turns, *rebuilt._sources)
    nodes = save(merge_nodes(partial_nodes(paths)), "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children")).alias("c")
    n, parent = nodes.alias("n"), nodes.alias("u")
    known = n.join(children, _same("c", (F.col("n.depth"), F.col("n.k1"), F.col("n.k2"))), "left")
    known = known.join(parent, _same("u", (F.col("n.depth") - 1, F.col("n.p1"), F.col("n.p2"))), "left")
    known = save(known.select("n.depth", "n.k1", "n.k2", "n.chars", "n.n_convs", "n.conv_id", F.col("u.conv_id").alias("parent_conv_id"), F.coalesce("n_children", F.lit(0)).alias("n_children")), "nodes")
    forget(nodes)
    # What each conversation owns on its path: nodes whose least member it is, always the path's tail.
    owner = known.select(*_KEY, F.col("conv_id").alias("owner"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaf")).alias("o")
    x = paths.alias("x").join(owner, _same("o", (F.col("x.depth"), F.col("x.k1"), F.col("x.k2"))))
    mine = F.col("owner") == F.col("conv_id")
    x = save(x.select("conv_id", "part", *[f"x.{c}" for c in _KEY], F.when(mine, F.col("saved")).otherwise(0).alias("saved"), F.when(mine, F.col("leaf")).otherwise(0).alias("leaf")), "owned")
    below = _carried(x, "depth", {"_saved_below": (F.sum, "saved", _add), "_leaves_below": (F.sum, "leaf", _add)}, backwards=True)
    rolled = below.groupBy(*_KEY).agg(F.sum("_leaves_below").alias("n_leaves"), F.sum("_saved_below").alias("saved_tokens")).alias("r")
    last = paths.groupBy("conv_id").agg(F.max(F.struct(*_KEY)).alias("e")).select("e.*", "conv_id")
    ends = end_digests(last).alias("e")
    k = known.alias("k")
    key = (F.col("k.depth"), F.col("k.k1"), F.col("k.k2"))
    out = k.join(rolled, _same("r", key)).join(ends, _same("e", key), "left")
    out = save(out.select("k.conv_id", "k.depth", "k.parent_conv_id", "k.n_convs", "k.n_children", "r.n_leaves", "r.saved_tokens", F.coalesce("e.ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")), "trie")
    forget(paths, known, x)
    return out


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


#: crc32 of a decimal number, bit by bit, in the oracle's dialect.
_CRC = """xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda crc, byte:
    list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END, xor(crc, byte)), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"""

OP12_SQL = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)
), head AS (
  SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = base AND pos < h
), rebuilt AS (
  SELECT * FROM head
  UNION ALL
  SELECT conv_id, pos - h + coalesce(n, 0), role, text FROM t JOIN c USING (conv_id) LEFT JOIN (SELECT conv_id, count(*) AS n FROM head GROUP BY conv_id) USING (conv_id) WHERE pos >= h
), path AS (
  SELECT conv_id, pos + 1 AS d, list([role, text]) OVER (PARTITION BY conv_id ORDER BY pos) AS k, length(text) AS chars FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, CAST([] AS VARCHAR[][]), 0 FROM c
), node AS (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM path GROUP BY d, k
), above AS (
  SELECT n.*, n.k[1:a.i] AS up, a.i AS up_d, NOT EXISTS (SELECT 1 FROM node m WHERE m.d = n.d + 1 AND m.k[1:n.d] = n.k) AS leaf
  FROM node n, (SELECT DISTINCT d AS i FROM node) a WHERE a.i <= n.d
), sums AS (
  SELECT up_d AS d, up AS k, count(*) FILTER (d = up_d + 1) AS n_children, count(*) FILTER (leaf) AS n_leaves, sum((n_convs - 1) * chars) AS saved FROM above GROUP BY up_d, up
), ends AS (
  SELECT d, k, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, max(d) AS d, arg_max(k, d) AS k FROM path GROUP BY conv_id) GROUP BY d, k
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node n JOIN sums s ON s.d = n.d AND s.k = n.k LEFT JOIN ends e ON e.d = n.d AND e.k = n.k LEFT JOIN node p ON p.d = n.d - 1 AND p.k = n.k[1:n.d - 1]
"""
