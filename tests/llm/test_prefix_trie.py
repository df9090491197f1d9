"""Operator 12 against its SQL and a plain trie, its defined results, and the merging of partial tries."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from readloom.llm import prefix_trie as T

CONV = "conv_id long, turn long, role string, text string"


def rows_of(df):
    return sorted(tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in df.collect())


def plain(turns):
    """A trie of dictionaries, filled conversation by conversation and summed from its leaves."""
    own = {}
    for c, turn, role, text in turns:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    node = lambda last: {"last": last, "next": {}, "members": [], "ends": []}
    root = node(("", ""))
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        at = root
        at["members"].append(c)
        for t in own.get(c - int(c - 100 * int(c / 100)), [])[:h] + own[c][h:]:
            at = at["next"].setdefault(t, node(t))
            at["members"].append(c)
        at["ends"].append(c)
    out, stack = [], [(root, 0, None)]
    order = []
    while stack:
        at, depth, parent = stack.pop()
        order.append((at, depth, parent))
        stack += [(n, depth + 1, at) for n in at["next"].values()]
    for at, depth, parent in reversed(order):
        at["leaves"] = sum(n["leaves"] for n in at["next"].values()) or 1
        at["saved"] = sum(n["saved"] for n in at["next"].values()) + (len(at["members"]) - 1) * len(at["last"][1])
        out.append((min(at["members"]), depth, min(parent["members"]) if parent else None, len(at["members"]), len(at["next"]), at["leaves"], at["saved"], hashlib.sha256(",".join(map(str, at["ends"])).encode()).hexdigest()))
    return sorted(out) if own else []


def odd_turns(seed=1, n=260):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        if c in (100, 101):  # no first conversation of this hundred, and a number that is absent
            continue
        for t in range(rng.choice([1, 2, 3, 7])):
            out.append((c, rng.choice([t, t, None, 3]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "bb", "", None, "é" * 4, "x:y"])))
    out += out[:40]  # repeated rows
    out += [(None, 1, "user", "no conversation"), (-5, 1, "user", "a"), (10**12, 1, None, None)]
    out += [(c, t, "user", "same") for c in range(300, 400) for t in range(4)]  # many equal conversations
    rng.shuffle(out)
    return out


def test_against_plain_trie_and_sql(spark):
    turns = odd_turns()
    df = spark.createDataFrame(turns, CONV)
    got = rows_of(T.trie(df))
    assert got == plain(turns)
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    res = con.execute(T.OP12_SQL)
    names = [d[0] for d in res.description]
    assert got == sorted((tuple(r[names.index(c)] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in res.fetchall()), key=lambda r: r[:2])


def test_one_conversation_of_most_turns_over_many_partitions(spark):
    turns = [(207, i % 2500, "user", f"t{i % 7}") for i in range(5000)] + [(200, i, "user", f"t{i}") for i in range(9)] + [(250, 1, "user", "x" * 2_000_000)]
    df = spark.createDataFrame(turns, CONV).withColumns({"part": F.lit(1), "k1": F.lit("clash"), "depth": F.lit(None)})
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = T.ordered_turns(df)
        assert parts.where("conv_id = 207").select("part").distinct().count() > 4
        assert parts.where("conv_id = 207").agg(F.min("pos"), F.max("pos"), F.count_distinct("pos")).first() == (0, 4999, 5000)
        got = rows_of(T.trie(df))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == plain(turns)


def test_empty_table_and_conversations_without_turns(spark):
    assert T.trie(spark.createDataFrame([], CONV)).count() == 0
    turnless = [c for c in range(500, 600) if zlib.crc32(str(c).encode()) % 6 and c != 500][:3]
    turns = [(c, 0, "user", "gone") for c in turnless]  # all of it is replaced by the opening of 500, which is absent
    got = rows_of(T.trie(spark.createDataFrame(turns, CONV)))
    assert got == plain(turns) == [(turnless[0], 0, None, 3, 0, 1, 0, hashlib.sha256(",".join(map(str, turnless)).encode()).hexdigest())]


@pytest.mark.parametrize("n", [1, 3])
def test_partial_tries_merge_to_the_whole(spark, n):
    paths = T.prefix_rows(T.rebuild(T.ordered_turns(spark.createDataFrame(odd_turns(2), CONV)))).persist()
    key = lambda r: tuple(r[c] for c in ("depth", "k1", "k2", "n_convs", "conv_id", "chars"))
    whole = sorted(map(key, T.merge_nodes(T.partial_nodes(paths)).collect()))
    pieces = [T.merge_nodes(T.partial_nodes(paths.where(F.pmod("conv_id", F.lit(n)) == i))) for i in range(n)]
    merged = T.merge_nodes(T.merge_nodes(*pieces[:2]), *pieces[2:])
    assert sorted(map(key, merged.collect())) == whole


def test_runs_of_ids_keep_their_order(spark, monkeypatch):
    monkeypatch.setattr(T, "RUN_BYTES", 64)
    rows = spark.range(-300, 5000).select(F.lit(1).cast("long").alias("depth"), F.lit(2).cast("long").alias("k1"), (F.col("id") % 2).alias("k2"), F.col("id").alias("conv_id"))
    got = {r.k2: r.ends_sha256 for r in T.end_digests(rows.repartition(7)).collect()}
    for odd in (-1, 0, 1):
        ids = [i for i in range(-300, 5000) if (abs(i) % 2) * (1 if i > 0 else -1) == odd]
        assert got[odd] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
