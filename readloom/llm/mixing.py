"""Mixing sources to target weights (operator 7).

Sainte-Laguë apportionment: the mix is cut into blocks of equal token counts. Blocks go to
sources by the highest quotients weight / (2 s + 1), each source stopping at ``most_epochs``
times what it has; a source's blocks go to its shards the same way, by shard size. Within a
shard, documents stand in seeded order; whole epochs take every block, and the rest of the
quota takes consecutive blocks of that order from a seeded place, round the end.

One row a source and shard reaches the driver, and no text passes the query's and the stage's window: at most ``most_shards`` and one more a
source. A shard holds about ``shard_tokens`` tokens, or more where that bound asks for it, so a
hot source has many shards and no window is larger than a shard.

Defined results: null text has size 0 and is never taken; a null source is a source of its own
and comes last; an empty table gives an empty result; sources without tokens get target 0;
repeated rows are separate documents; result columns replace input columns of the same name.
"""

from __future__ import annotations

import math
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, save, table

BLOCK_TOKENS = 16
SHARD_TOKENS = 50_000
MOST_SHARDS = 20_000
WEIGHTS = (5, 2, 1)


def targets(sizes: list[int], weights: list[float], most_epochs: float = 3) -> list[float]:
    """Shares of all tokens by weight, each at most ``most_epochs`` times its size, the excess reshared by weight."""
    share, open_, left = [0.0] * len(sizes), {i for i, s in enumerate(sizes) if s > 0}, Fraction(sum(sizes))
    while open_:
        total = sum(Fraction(weights[i]) for i in open_)
        over = {i for i in open_ if left * Fraction(weights[i]) / total > Fraction(most_epochs) * sizes[i]}
        if not over:
            for i in open_:
                share[i] = float(left * Fraction(weights[i]) / total)
            break
        for i in over:
            share[i] = float(Fraction(most_epochs) * sizes[i])
            left -= Fraction(most_epochs) * sizes[i]
        open_ -= over
    return share


def sainte_lague(seats: int, weights, caps=None) -> list[int]:
    """Seats by highest quotients weight / (2 s + 1); ties to the earlier party; at most ``caps`` seats each.

    The divisor is bisected to just before the last seats, which are then dealt one at a time,
    so the work does not grow with the seats.
    """
    w = np.asarray(weights, float)
    cap = np.full(len(w), seats) if caps is None else np.asarray(caps, np.int64)
    cap = np.where(w > 0, cap, 0)
    seats = int(min(seats, cap.sum()))
    if seats <= 0:
        return [0] * len(w)

    def at(divisor: float) -> np.ndarray:  # quotient above the divisor: w / (2 s + 1) > divisor
        return np.minimum(np.ceil(np.maximum(w / divisor - 1, 0) / 2), cap).astype(np.int64)

    low, high = 1e-12 * w[w > 0].min() / (2 * seats + 1), 2 * w.max()
    for _ in range(200):
        mid = math.sqrt(low * high)
        if at(mid).sum() > seats:
            low = mid
        else:
            high = mid
    got = at(high * (1 + 1e-9))  # what rounding could misplace is dealt below
    while got.sum() < seats:
        quotient = np.where(got < cap, w / (2 * got + 1), -1.0)
        got[int(quotient.argmax())] += 1
    return got.tolist()


def order_key(key: str, text: str, seed: int):
    """A seeded 64-bit key of a row's id and text."""
    return F.xxhash64(F.lit(seed), F.col(key).cast("string"), F.col(text))


def sized(df: DataFrame, text: str = "text", key: str = "doc_id", seed: int = 7) -> DataFrame:
    """All columns with size, and the seeded ``_order``, ``_deal`` and ``_tie`` that place a row; the text itself is no longer needed."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return df.withColumns({"size": size, "_order": order_key(key, text, seed), "_deal": order_key(key, text, seed + 1), "_tie": order_key(key, text, seed + 2)})


def mix(df: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id", weights=WEIGHTS, most_epochs: int = 3, block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS, most_shards: int = MOST_SHARDS, seed: int = 7) -> DataFrame:
    """All columns with size, source_size, target and taken (tokens of the row that the mix takes, repeats counted)."""
    kept = [c for c in df.columns if c not in ("size", "source_size", "target", "taken")]
    return mix_sized(sized(df, text, key, seed), source, key, weights, most_epochs, block_tokens, shard_tokens, most_shards, seed).select(*kept, "size", "source_size", "target", "taken")


def mix_sized(df: DataFrame, source: str = "source", key: str = "doc_id", weights=WEIGHTS, most_epochs: int = 3, block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS, most_shards: int = MOST_SHARDS, seed: int = 7) -> DataFrame:
    """:func:`mix` of rows that :func:`sized` has measured."""
    spark = df.sparkSession
    by_source = [(r[0], r[1]) for r in df.groupBy(F.col(source)).agg(F.sum("size")).collect()]
    by_source.sort(key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [s for _, s in by_source]
    w = [weights[i % len(weights)] for i in range(len(by_source))]
    share = targets(sizes, w, most_epochs)
    shard_tokens = max(shard_tokens, -(-sum(sizes) // most_shards))
    n_shards = [max(1, -(-s // shard_tokens)) for s in sizes]
    plan = spark.createDataFrame([(name, i, n, s, t) for i, ((name, s), n, t) in enumerate(zip(by_source, n_shards, share))], "_source string, _i int, _n int, source_size long, target double")
    rows = df.drop("source_size", "target", "taken").join(F.broadcast(plan), F.col(source).eqNullSafe(F.col("_source")))
    rows = rows.withColumn("_shard", F.pmod(F.col("_deal"), F.col("_n")).cast("int"))
    shards: dict[int, list] = {}
    for r in rows.groupBy("_i", "_shard").agg(F.sum("size").alias("s")).collect():
        shards.setdefault(r["_i"], []).append((r["_shard"], r["s"]))
    # A source's blocks, by the quotients of the capped shares; then its shards', by their sizes.
    blocks = sainte_lague(round(sum(share) / block_tokens), share, [math.floor(most_epochs * s / block_tokens) for s in sizes])
    quotas = []
    for i, own in sorted(shards.items()):
        own.sort()
        got = sainte_lague(blocks[i], [s for _, s in own], [math.floor(most_epochs * s / block_tokens) for _, s in own])
        for (shard, s), q in zip(own, got):
            tokens = q * block_tokens
            whole, rest = divmod(tokens, s) if s else (0, 0)
            start = zlib.crc32(f"{seed}/{i}/{shard}".encode()) % max(1, -(-s // block_tokens)) * block_tokens
            quotas.append((i, shard, s, whole, rest, start))
    quota = spark.createDataFrame(quotas, "_qi int, _qs int, _total long, _whole long, _rest long, _start long")
    rows = rows.join(F.broadcast(quota), (F.col("_i") == F.col("_qi")) & (F.col("_shard") == F.col("_qs")))
    w_shard = W.partitionBy("_i", "_shard").orderBy("_order", F.col(key), "_tie").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("_end", F.sum("size").over(w_shard)).withColumn("_begin", F.col("_end") - F.col("size"))

    def overlap(a, b):
        return F.greatest(F.lit(0), F.least(F.col("_end"), b) - F.greatest(F.col("_begin"), a))

    first = overlap(F.col("_start"), F.least(F.col("_start") + F.col("_rest"), F.col("_total")))
    wrapped = overlap(F.lit(0), F.col("_start") + F.col("_rest") - F.col("_total"))
    taken = F.col("_whole") * F.col("size") + first + wrapped
    return rows.withColumn("taken", taken.cast("long")).drop("_source", "_i", "_n", "_shard", "_qi", "_qs", "_total", "_whole", "_rest", "_start", "_end", "_begin")


def repeat_documents(mixed: DataFrame) -> DataFrame:
    """Whole documents as often as the mix takes them, to the nearest count."""
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0)
    return mixed.where(times > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), times.cast("int")))).drop("_copy")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 5, 2, 1 by source."""
    docs = save(sized(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text"), "sizes")
    return mix_sized(docs).select("doc_id", "size", "source_size", "target", "taken")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: whole documents, each as often as the mix of sources takes it (also never).

    Documents without words are never taken; a null source is a source of its own; rows repeating an id or
    all of a document are documents of their own; an empty table stays empty; other columns pass through.
    """
    narrow = save(sized(docs).drop("text"), "sizes")
    kept = repeat_documents(mix_sized(narrow))
    # The texts meet the documents that are taken afterwards, by the 128 bits of id and text that place a row; null ones are never taken.
    key = ("_order", "_deal")
    texts = docs.where("text is not null").select(order_key("doc_id", "text", 7).alias("_order"), order_key("doc_id", "text", 8).alias("_deal"), "text").dropDuplicates(key)
    return kept.join(texts, list(key)).select(*docs.columns)
