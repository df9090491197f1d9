"""Embedding near-duplicates over robust-pruned flat graphs (operator 1).

0. Vectors of one label that are equal once scaled by their largest component (to ``GRID``, so that multiples
   count as equal) collapse to one node, which carries their number; only it is searched, and its cosines hold for all of them.
1. Centroids: for each (label, dimension) about one a ``SHARD_VECTORS`` nodes, at most
   ``MOST_CENTROIDS``, fitted by spherical k-means in a task of its own on a bounded sample
   (``SAMPLE_PER_CENTROID`` nodes a centroid, at most ``MOST_SAMPLE``). Nodes meet the centroids of
   their label in portions of ``PORTION``; nothing is broadcast and nothing passes the driver.
2. Every node goes to the cluster of its nearest centroid (its home) and to the next
   ``OVERLAP - 1`` nearest. A cluster of over ``MOST_NODES`` nodes, such as a large group of
   near copies, is split by a hash of the node into shards of at most about that many.
3. Each shard builds a graph: nearest candidates and some random ones, robust-pruned (a neighbour
   goes if it is ``ALPHA`` times nearer to a kept, closer neighbour), with reverse edges.
4. A node's adjacency lists from all its shards are united.
5. Each node searches every shard of its home cluster: a greedy beam search from the shard's medoids,
   which then expands its range through all neighbours of found nodes until nothing new
   lies within the radius. Nodes of a cluster search in blocks of at most ``MOST_NODES``.
6. Every pair returned has its cosine computed in double precision against the threshold. A block returns, for each
   searching node, how many it found (copies included), and a spanning forest of the links, never the pairs.

``audit_recall`` compares n_links with brute force for a stated set of vectors.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and
vectors without label, link with nothing and are kept; vectors of different dimensions do not
link; every row is a vector, also where ids repeat or are null (such a component's id is its least
id, null where no member has one). Only the three named columns are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, forget, release_memory, save, table

SHARD_VECTORS, MOST_NODES, MOST_CENTROIDS, SAMPLE_PER_CENTROID, MOST_SAMPLE, PORTION = 500, 2048, 2048, 40, 20_000, 8192
OVERLAP, DEGREE, CANDIDATES, RANDOM, ALPHA, BEAM = 4, 24, 64, 8, 1.2, 24
GRID = 2.0**-44


def unit(rows) -> np.ndarray:
    x = np.asarray(rows, np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centroids(sample: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Spherical k-means, a few rounds; empty clusters keep their centroid."""
    rng = np.random.default_rng(seed)
    c = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(4):
        near = np.concatenate([(sample[at : at + 2048] @ c.T).argmax(axis=1) for at in range(0, len(sample), 2048)])
        total = np.zeros_like(c)
        np.add.at(total, near, sample)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 1e-9, total / np.maximum(size, 1e-9), c)
    return c


def build_graph(x: np.ndarray, degree: int = DEGREE, candidates: int = CANDIDATES, alpha: float = ALPHA, seed: int = 1) -> np.ndarray:
    """Robust-pruned adjacency, n x (2 degree), padded with -1. Distances are Euclidean between unit vectors."""
    n = len(x)
    rng = np.random.default_rng(seed)
    c = min(candidates, n - 1)
    if c <= 0:
        return np.full((n, 1), -1, np.int64)
    pool = np.empty((n, c + RANDOM), np.int64)
    for at in range(0, n, 512):
        sim = x[at : at + 512] @ x.T
        sim[np.arange(len(sim)), np.arange(at, at + len(sim))] = -9
        pool[at : at + 512, :c] = np.argpartition(-sim, c - 1, axis=1)[:, :c]
    pool[:, c:] = rng.integers(0, n, (n, RANDOM))
    forward = _prune(x, pool, degree, alpha)
    # Reverse edges, as many as fit, nearest-listed first.
    src, slot = np.nonzero(forward >= 0)
    dst = forward[src, slot]
    order = np.lexsort((slot, dst))
    src, dst = src[order], dst[order]
    rank = np.arange(len(dst)) - np.searchsorted(dst, dst)
    fit = rank < degree
    out = np.full((n, 2 * degree), -1, np.int64)
    out[:, :degree] = forward
    out[dst[fit], degree + rank[fit]] = src[fit]
    return out


def _prune(x: np.ndarray, pool: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    n = len(x)
    out = np.full((n, degree), -1, np.int64)
    for at in range(0, n, 256):
        some = pool[at : at + 256]
        vec = x[some]
        own = np.sqrt(np.maximum(2 - 2 * np.einsum("md,mcd->mc", x[at : at + len(some)], vec), 0))
        own[some == np.arange(at, at + len(some))[:, None]] = np.inf
        live, rows = own.copy(), np.arange(len(some))
        for k in range(degree):
            best = live.argmin(axis=1)
            ok = np.isfinite(live[rows, best])
            if not ok.any():
                break
            out[at + rows[ok], k] = some[rows[ok], best[ok]]
            apart = np.sqrt(np.maximum(2 - 2 * np.einsum("md,mcd->mc", vec[rows, best], vec), 0))
            live[alpha * apart <= own] = np.inf  # includes the chosen one and its copies in the pool
            live[rows, best] = np.inf
    return out


def range_search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, radius: float, beam: int = BEAM):
    """Pairs (query row, node) with similarity of at least ``radius``: beam search from medoids, then expansion in range.

    Exact similarities, but only of nodes that the walk reaches.
    """
    m, n = len(queries), len(x)
    medoids = np.unique(np.concatenate([[(x @ x.mean(axis=0)).argmax()], np.linspace(0, n - 1, min(8, n)).astype(np.int64)]))
    seen = np.zeros((m, n), bool)
    seen[:, medoids] = True
    sim = queries @ x[medoids].T
    width = max(beam, len(medoids))
    pool_id = np.full((m, width), -1, np.int64)
    pool_sim = np.full((m, width), -9.0)
    pool_id[:, : len(medoids)], pool_sim[:, : len(medoids)] = medoids, sim
    done = pool_id < 0
    q, hit = np.nonzero(sim >= radius)
    found_q, found_n = [q], [medoids[hit]]
    active = np.arange(m)
    while len(active):
        open_ = np.where(done[active], -9.0, pool_sim[active])
        best = open_.argmax(axis=1)
        going = open_[np.arange(len(active)), best] > -9
        active, best = active[going], best[going]
        if not len(active):
            break
        done[active, best] = True
        nb = graph[pool_id[active, best]]
        fresh = (nb >= 0) & ~seen[active[:, None], np.maximum(nb, 0)]
        row, slot = np.nonzero(fresh)
        key = np.unique(active[row] * n + nb[row, slot])
        qs, ns = key // n, key % n
        seen[qs, ns] = True
        s = np.einsum("ij,ij->i", queries[qs], x[ns])
        hit = s >= radius
        found_q.append(qs[hit])
        found_n.append(ns[hit])
        # Merge each query's new nodes into its beam.
        count = np.bincount(qs, minlength=m)[active]
        most = int(count.max()) if len(count) else 0
        if most:
            first = np.searchsorted(qs, active)
            col = np.arange(most)
            have = col < count[:, None]
            take = np.minimum(first[:, None] + col, len(ns) - 1)
            ids = np.concatenate([pool_id[active], np.where(have, ns[take], -1)], axis=1)
            sims = np.concatenate([pool_sim[active], np.where(have, s[take], -9.0)], axis=1)
            closed = np.concatenate([done[active], ~have], axis=1)
            top = np.argpartition(-sims, width - 1, axis=1)[:, :width]
            r = np.arange(len(active))[:, None]
            pool_id[active], pool_sim[active], done[active] = ids[r, top], sims[r, top], closed[r, top]
    fq, fn = np.concatenate(found_q), np.concatenate(found_n)
    at = 0
    while at < len(fq):  # expand everything in range, also what the beam had no room for
        stop = min(len(fq), at + 100_000)
        nb = graph[fn[at:stop]]
        qs = np.repeat(fq[at:stop], nb.shape[1])
        nb = nb.reshape(-1)
        fresh = nb >= 0
        fresh[fresh] = ~seen[qs[fresh], nb[fresh]]
        key = np.unique(qs[fresh] * n + nb[fresh])
        at = stop
        if len(key):
            qs, ns = key // n, key % n
            seen[qs, ns] = True
            s = np.concatenate([np.einsum("ij,ij->i", queries[qs[i : i + 50_000]], x[ns[i : i + 50_000]]) for i in range(0, len(qs), 50_000)])
            hit = s >= radius
            fq, fn = np.concatenate([fq, qs[hit]]), np.concatenate([fn, ns[hit]])
    return fq, fn


def _build(pdf):
    import pandas as pd

    ids, x = pdf["node"].to_numpy(), unit(np.stack(pdf["vec"].to_numpy()))
    graph = build_graph(x)
    return pd.DataFrame({"node": ids, "near": [ids[g[g >= 0]] for g in graph]})


def _search(radius: float):
    def run(pdf):
        import pandas as pd

        nodes, asks = pdf[~pdf["asks"]].sort_values("node"), pdf[pdf["asks"]].sort_values("node")
        if not len(nodes) or not len(asks):
            return pd.DataFrame({"node": [], "found": [], "root": []}).astype("int64")
        ids, x = nodes["node"].to_numpy(), unit(np.stack(nodes["vec"].to_numpy()))
        q_ids, q = asks["node"].to_numpy(), unit(np.stack(asks["vec"].to_numpy()))
        lists = [np.asarray(v, np.int64) if v is not None else np.zeros(0, np.int64) for v in nodes["near"]]
        # United lists may name vectors of other shards; those are not here.
        flat = np.concatenate(lists)
        row = np.repeat(np.arange(len(lists)), [len(v) for v in lists])
        at = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
        here = ids[at] == flat
        row, at = row[here], at[here]
        count = np.bincount(row, minlength=len(ids))
        graph = np.full((len(ids), max(1, int(count.max()))), -1, np.int64)
        graph[row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)] = at
        fq, fn = range_search(x, graph, q, radius)
        other = q_ids[fq] != ids[fn]
        fq, fn = fq[other], fn[other]
        found = np.bincount(fq, weights=nodes["copies"].to_numpy()[fn], minlength=len(q_ids))
        # Components of the links found here, by pointer jumping on the least id.
        both = np.unique(np.concatenate([q_ids, ids]))
        a, b = np.searchsorted(both, q_ids[fq]), np.searchsorted(both, ids[fn])
        root = np.arange(len(both))
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, root[a], low)
            np.minimum.at(new, root[b], low)
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        touched = np.unique(np.concatenate([a, b]))
        rows = pd.DataFrame({"node": both[touched], "found": 0, "root": both[root[touched]]})
        asked = pd.DataFrame({"node": q_ids, "found": found, "root": both[root[np.searchsorted(both, q_ids)]]})
        rows = rows[~rows["node"].isin(q_ids)]
        return pd.concat([asked, rows]).astype("int64")

    return run


def _fit(pdf):
    import pandas as pd

    pdf = pdf.sort_values("node")
    c = fit_centroids(unit(np.stack(pdf["vec"].to_numpy())), int(pdf["k"].iloc[0]))
    release_memory()
    return pd.DataFrame({"label": pdf["label"].iloc[0], "dim": pdf["dim"].iloc[0], "cluster": np.arange(len(c), dtype=np.int32), "centroid": list(c)})


def _assign(nodes, centroids):
    import pandas as pd

    nodes = nodes.drop(columns="portion")
    if len(nodes) and len(centroids):
        c = np.stack(centroids.sort_values("cluster")["centroid"].to_numpy())
        x = unit(np.stack(nodes["vec"].to_numpy()))
        near = [np.argsort(-(x[at : at + 1024] @ c.T), axis=1, kind="stable")[:, :OVERLAP] for at in range(0, len(x), 1024)]
        nodes["clusters"] = list(np.concatenate(near).astype(np.int32))
    else:
        nodes["clusters"] = pd.Series([[0]] * len(nodes), index=nodes.index)
    release_memory()
    return nodes


def _nodes(good: DataFrame) -> DataFrame:
    """(_a, _b, node, least_id, copies) of equal vectors: the node's number is its least id, or 63 bits of its digest below zero where it has none or another node has it."""
    equal = save(good.groupBy("_a", "_b").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies")), "equal")
    spare = F.col("_a").bitwiseOR(F.lit(-(1 << 63)))
    twice = equal.where("least_id is not null").groupBy("least_id").agg(F.count("*").alias("n"), F.min(F.struct("_a", "_b")).alias("first")).where("n > 1").select(F.col("least_id").alias("_l"), "first")
    if twice.isEmpty():
        return equal.withColumn("node", F.coalesce("least_id", spare))
    own = F.col("_l").isNull() | (F.col("first") == F.struct("_a", "_b"))
    return equal.join(twice, F.col("least_id") == F.col("_l"), "left").withColumn("node", F.coalesce(F.when(own, F.col("least_id")), spare)).drop("_l", "first")


def vector_links(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least_cosine: float = 0.98) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, and whether it could be compared."""
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.withColumn("usable", F.coalesce(F.col("label").isNotNull() & fine & F.exists("vec", lambda v: v != 0), F.lit(False)))
    # Components of extreme size would overflow a norm; scaling by the largest leaves the cosine as it is.
    rows = rows.withColumn("_largest", F.when(F.col("usable"), F.array_max(F.transform("vec", lambda v: F.abs(v)))))
    rows = rows.select("vec_id", "usable", "label", F.size("vec").alias("dim"), F.transform("vec", lambda v: v / F.col("_largest")).alias("vec"))
    grid = F.transform("vec", lambda v: F.rint(v / GRID).cast("long"))
    keyed = {name: F.when(F.col("usable"), F.xxhash64(F.lit(seed), "label", "dim", grid)) for name, seed in (("_a", 3), ("_b", 7))}
    rows = save(rows.withColumns(keyed), "vectors")
    good = rows.where("usable")
    equal = save(_nodes(good), "nodes")
    every = rows.select("vec_id", "usable", "_a", "_b")
    of_node = good.groupBy("_a", "_b").agg(F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("vec").alias("vec"))
    nodes = save(of_node.join(equal.select("_a", "_b", "node", "copies"), ["_a", "_b"]).select("node", "copies", "label", "dim", "vec"), "node-vectors")
    wanted = F.least(F.lit(MOST_CENTROIDS), F.ceil(F.col("n") / SHARD_VECTORS)).cast("int")
    groups = nodes.groupBy("label", "dim").agg(F.count("*").alias("n")).withColumns({"k": wanted, "portions": F.ceil(F.col("n") / PORTION).cast("int")})
    groups = save(groups, "groups")
    rate = F.least(F.lit(MOST_SAMPLE), F.col("k") * SAMPLE_PER_CENTROID) / F.col("n")
    draw = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    sample = nodes.join(groups.where("k > 1"), ["label", "dim"]).where(draw < rate).select("label", "dim", "node", "vec", "k")
    centroids = save(sample.groupBy("label", "dim").applyInPandas(_fit, "label string, dim int, cluster int, centroid array<double>"), "centroids")
    dealt = centroids.join(groups.select("label", "dim", "portions"), ["label", "dim"]).withColumn("portion", F.explode(F.sequence(F.lit(0), F.col("portions") - 1))).drop("portions")
    portioned = nodes.join(groups.select("label", "dim", "portions"), ["label", "dim"]).withColumn("portion", F.pmod(F.xxhash64("node", F.lit(9)), F.col("portions")).cast("int")).drop("portions")
    by = ["label", "dim", "portion"]
    placed = portioned.select("node", "copies", "label", "dim", "vec", "portion").groupBy(*by).cogroup(dealt.groupBy(*by)).applyInPandas(_assign, "node long, copies long, label string, dim int, vec array<double>, clusters array<int>")
    placed = save(placed, "placed")
    spread = placed.select("node", "copies", "label", "dim", "vec", F.posexplode("clusters").alias("rank", "cluster"))
    sizes = spread.groupBy("label", "dim", "cluster").agg(F.count("*").alias("members"), F.count(F.when(F.col("rank") == 0, 1)).alias("home"))
    cut = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / MOST_NODES)).cast("int")
    sizes = save(sizes.select("label", "dim", "cluster", cut("members").alias("shards"), cut("home").alias("blocks")), "clusters")
    spread = spread.join(sizes, ["label", "dim", "cluster"])
    members = spread.withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))
    near = members.groupBy("label", "dim", "cluster", "shard").applyInPandas(_build, "node long, near array<long>")
    united = save(near.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
    members = members.join(united, "node").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(False))
    asks = spread.where("rank = 0").withColumn("block", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    asks = asks.withColumns({"asks": F.lit(True), "near": F.lit(None).cast("array<long>")})
    columns = ["label", "dim", "cluster", "shard", "block", "node", "copies", "vec", "near", "asks"]
    got = members.select(*columns).union(asks.select(*columns)).groupBy("label", "dim", "cluster", "shard", "block").applyInPandas(_search(least_cosine), "node long, found long, root long")
    got = save(got, "found")
    links = got.groupBy("node").agg(F.sum("found").alias("n_links"))
    label_of = save(components(got.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))), "labels")
    least = equal.join(links, "node", "left").join(label_of.select(F.col("id").alias("node"), "component_id"), "node", "left").withColumn("component", F.coalesce("component_id", "node"))
    least = save(least.select("_a", "_b", "least_id", "component", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "linked")
    named = least.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = save(least.join(named, "component").select("_a", "_b", "n_links", "component_id"), "classes")
    forget(nodes, groups, centroids, placed, sizes, united, got, label_of, least, equal)
    out = every.join(of_class, ["_a", "_b"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"), "usable")
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"), "usable")


def audit_recall(df: DataFrame, found: DataFrame, every: int = 50, key: str = "vec_id", vector: str = "embedding", label: str = "label", least_cosine: float = 0.98, portion: int = PORTION) -> tuple[int, int]:
    """(links found, links there are) of the vectors whose id is divisible by ``every``, against brute force over all rows.

    Stated vectors and rows meet in portions of at most about ``portion`` a side of one (label, dimension); only counts come back.
    """
    rows = df.select(F.col(key).alias("vec_id"), F.col(label).cast("string").alias("label"), F.size(vector).alias("dim"), F.col(vector).cast("array<double>").alias("vec")).where("label is not null and vec is not null and dim > 0")
    picked = F.col("vec_id") % every == 0
    groups = rows.groupBy("label", "dim").agg(F.ceil(F.count("*") / portion).cast("int").alias("parts"), F.greatest(F.lit(1), F.ceil(F.count(F.when(picked, 1)) / portion)).cast("int").alias("asks"))
    rows = rows.join(groups, ["label", "dim"]).withColumns({"part": F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"), "ask": F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("asks")).cast("int")})
    every_row = rows.withColumn("ask", F.explode(F.sequence(F.lit(0), F.col("asks") - 1))).select("label", "dim", "part", "ask", "vec_id", "vec")
    asked = rows.where(picked).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*[F.col(c).alias(f"q_{c}") for c in ("label", "dim", "part", "ask", "vec_id", "vec")])
    by = ["label", "dim", "part", "ask"]

    def count(one, two):
        import pandas as pd

        n = 0
        if len(one) and len(two):
            ids, x, y = one["vec_id"].to_numpy(), unit(np.stack(one["vec"].to_numpy())), unit(np.stack(two["q_vec"].to_numpy()))
            for at in range(0, len(y), 512):
                n += int(((y[at : at + 512] @ x.T >= least_cosine) & (two["q_vec_id"].to_numpy()[at : at + 512, None] != ids)).sum())
        return pd.DataFrame({"n": [n]})

    there = every_row.groupBy(*by).cogroup(asked.groupBy(*[f"q_{c}" for c in by])).applyInPandas(count, "n long").agg(F.sum("n")).first()[0] or 0
    got = found.where(F.col("vec_id") % every == 0).agg(F.sum("n_links")).first()[0] or 0
    return got, there


def op1_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all vectors at cosine 0.98 within their label."""
    return vector_links(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")
