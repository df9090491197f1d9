"""MinHash near-duplicates with b-bit signatures (operator 8).

1. One pass over the texts: each document's set of word shingles becomes a 128-bit BLAKE2b digest
   of the set, 128 minima, band keys over the full minima, and a packed signature that keeps the low
   ``BITS`` bits of each (mixed) minimum as bit planes.
2. Documents with equal sets collapse to one class, so exact copies never meet in pairs.
3. Classes sharing a band key are candidates. Each meets its bucket's least member only; the
   estimate from bit counts, corrected for chance agreement, drops hopeless pairs, and the rest
   are confirmed on the full sets. Their components cover the large groups in linear work.
4. Buckets of three or more whose members still lie in different components are the exact
   rest: they are cut into blocks, each pair of blocks is one task group, and every pair of members
   from different components is decided there; a block returns at most a spanning forest.

Words stand for themselves by 64 bits of their BLAKE2b digest and a shingle by a mixed sum of its
words' keys, so no two texts can be made to share a shingle by their form. Links are confirmed
on these sets in full.

A link of similarity s shares no band with probability (1 - s**rows) ** bands: 8e-7 at 0.85 with
24 bands of 5, 5e-8 at 0.8 with 32 bands of 4. The estimate drops a pair only 5 standard errors below.

Defined results: null, empty and wordless texts have an empty set and link with nothing; with
fewer words than a shingle the whole sequence is the one shingle; equal texts form one class;
rows repeating an id are judged each by its text; rows without id link like others and count
among them as a component's least id only where no member has one (null). A text of any length is read
in pieces of a megabyte. Only the key and the text are read.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, byte_views, components, forget, mix64, release_memory, row_chunks, save, table, tidy, word_keys

HASHES, BITS = 128, 2
#: A block of a bucket holds at most about so many members, and shingles.
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000
_RNG = np.random.default_rng(20240229)
_MUL = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_TURN = [np.uint64(x | 1) for x in _RNG.integers(1 << 62, 1 << 63, 64, dtype=np.uint64)]


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each row of bytes, A-Z lower-cased."""
    keys, counts = word_keys(data, bounds)
    hashes, edge = keys.view(np.uint64), np.concatenate([[0], np.cumsum(counts)])
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    if n >= words:
        for j in range(words):
            rolled[: n - words + 1] += hashes[j : n - words + 1 + j] * _TURN[j]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            short = blake2b(hashes[a:b].tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(short, np.uint64).copy())
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        out = np.minimum(out, (np.multiply.outer(_MUL, x[at : at + 1024]) + _ADD[:, None]).min(axis=1))
    return out


def pack(minimum: np.ndarray) -> np.ndarray:
    """Bit planes of the low BITS bits of each mixed minimum: rows x (BITS * HASHES / 64) longs."""
    mixed = mix64(minimum.astype(np.uint64) + np.uint64(1))
    planes = [np.packbits(((mixed >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1).view(">u8").astype(np.int64) for b in range(BITS)]
    return np.concatenate(planes, axis=1)


def estimate(differing, hashes: int = HASHES):
    """Similarity from the number of differing b-bit values, corrected for chance agreement."""
    chance = 2.0**-BITS
    return ((1 - differing / hashes) - chance) / (1 - chance)


def least_estimate(similarity: float) -> float:
    """Five standard errors below ``similarity``."""
    chance = 2.0**-BITS
    agree = chance + (1 - chance) * similarity
    return similarity - 5 * math.sqrt(agree * (1 - agree) / HASHES) / (1 - chance)


def _rows_of(df: DataFrame, schema: str, make):
    """mapInArrow over (text bytes, further columns) in bounded chunks: ``make`` gets the further columns, the bytes and the rows' bounds."""

    def run(batches):
        for batch in batches:
            buf, off = byte_views(batch.column(0))
            for a, b in row_chunks(off, 1 << 20):
                yield make([batch.column(i).slice(a, b - a) for i in range(1, batch.num_columns)], buf[off[a] : off[b]], off[a : b + 1] - off[a])

    return bounded_batches(df).mapInArrow(tidy(run), schema)


def _digests(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """128-bit digests of shingle sets as two longs; null for empty sets."""
    both = np.frombuffer(b"".join(blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2)
    empty = np.array([not len(s) for s in sets], bool)
    return pa.array(both[:, 0], pa.int64(), mask=empty), pa.array(both[:, 1], pa.int64(), mask=empty)


def _bytes_of(text):
    return F.coalesce(text, F.lit("")).cast("binary")


def text_key(text):
    """Tells the texts of rows apart that repeat an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def signatures(df: DataFrame, text: str, key: str, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, d1, d2, bands, planes); d1 and d2 are the digest of the shingle set, null for an empty one."""

    def make(columns, data, bounds):
        sets = shingle_sets(data, bounds, words)
        full = [i for i, s in enumerate(sets) if len(s)]
        low = np.stack([minima(sets[i]) for i in full]) if full else np.zeros((0, HASHES), np.uint32)
        key_of = np.zeros((len(full), bands), np.uint64)
        for j in range(rows):
            key_of = (key_of ^ low[:, j : rows * bands : rows].astype(np.uint64)) * _TURN[j]
            key_of ^= key_of >> np.uint64(29)
        key_of = mix64(key_of + np.arange(bands, dtype=np.uint64) * _TURN[9]).astype(np.int64)

        def lists(values):
            each, at = values.shape[1], np.zeros(len(sets) + 1, np.int32)
            at[1:][full] = each
            return pa.ListArray.from_arrays(pa.array(np.cumsum(at, dtype=np.int32)), pa.array(values.reshape(-1), pa.int64()))

        return pa.RecordBatch.from_arrays([*columns, pa.array([len(s) for s in sets], pa.int64()), *_digests(sets), lists(key_of), lists(pack(low))], names=["doc_id", "text_key", "n_shingles", "d1", "d2", "bands", "planes"])

    kind = df.schema[key].dataType.simpleString()
    return _rows_of(df.select(_bytes_of(F.col(text)), F.col(key).alias("doc_id"), text_key(F.col(text)).alias("text_key")), f"doc_id {kind}, text_key long, n_shingles long, d1 long, d2 long, bands array<long>, planes array<long>", make)


def _block_links(num: int, den: int, cut: float):
    """Decide all pairs of a bucket's block that lie in different components; return a spanning forest of the links."""

    def run(pdf):
        import pandas as pd

        pdf = pdf.drop_duplicates("class")
        ids, comp, own = pdf["class"].to_numpy(), pdf["comp"].to_numpy(), pdf["own"].to_numpy()
        across = pdf["i"].iloc[0] != pdf["j"].iloc[0]  # pairs within a block are decided where it meets itself
        planes = np.stack(pdf["planes"].to_numpy()).astype(np.int64).view(np.uint64)
        sets = [np.asarray(s) for s in pdf["shingles"]]
        size = np.array([len(s) for s in sets])
        per, root, out = HASHES // 64, comp.copy(), []
        for i in range(len(ids)):
            diff = planes[i + 1 :] ^ planes[i]
            differing = np.zeros(len(diff), np.int64)
            for w in range(per):
                differing += np.bitwise_count(np.bitwise_or.reduce(diff[:, w::per], axis=1)).astype(np.int64)
            near = (estimate(differing) >= cut) & (den * np.minimum(size[i], size[i + 1 :]) >= num * np.maximum(size[i], size[i + 1 :])) & (root[i + 1 :] != root[i])
            if across:
                near &= own[i + 1 :] != own[i]
            for j in (np.flatnonzero(near) + i + 1).tolist():
                if root[j] == root[i]:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if den * both >= num * (size[i] + size[j] - both):
                    out.append((ids[i], ids[j]))
                    root[root == root[j]] = root[i]
        release_memory()
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _named(classes: DataFrame, integral: bool) -> DataFrame:
    """Give each class its number: its least id, or else (no id, an id that another class has, ids that are no integers) 63 bits of its digest, below zero."""
    spare = F.col("d1").bitwiseOR(F.lit(-(1 << 63)))
    if not integral:
        return classes.withColumn("class", spare)
    twice = classes.groupBy("least_id").agg(F.count("*").alias("n"), F.min(F.struct("d1", "d2")).alias("first")).where("n > 1 and least_id is not null").select(F.col("least_id").alias("_l"), "first")
    if twice.isEmpty():
        return classes.withColumn("class", F.coalesce(F.col("least_id").cast("long"), spare))
    own = F.col("_l").isNull() | (F.col("first") == F.struct("d1", "d2"))
    return classes.join(twice, F.col("least_id") == F.col("_l"), "left").withColumn("class", F.coalesce(F.when(own, F.col("least_id").cast("long")), spare)).drop("_l", "first")


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = 5, similarity: tuple[int, int] = (4, 5)) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id reachable by links), kept, group and text_key.

    ``similarity`` is the least Jaccard similarity of a link, as a fraction of integers. ``group`` numbers the
    components themselves, also where rows repeat ids; it is null for empty sets.
    """
    num, den = similarity
    rows, bands = (5, 24) if num / den >= 0.85 else (4, 32)
    cut = least_estimate(num / den)
    signed = save(signatures(df, text, key, words, bands, rows), "signatures")
    found = signed.where("d1 is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("least_id"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"), F.first("planes").alias("planes"))
    found = save(found, "sets")
    classes = save(_named(found, df.schema[key].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")), "classes")
    forget(found)
    member = classes.select("class", F.explode("bands").alias("bucket"))
    busy = member.groupBy("bucket").agg(F.min("class").alias("pivot"), F.count("*").alias("m")).where("m > 1")
    busy = save(member.join(busy, "bucket"), "buckets")
    planes = classes.select("class", "planes")
    pairs = busy.where("class <> pivot").select(F.col("pivot").alias("a"), F.col("class").alias("b")).distinct()
    pairs = pairs.join(planes.toDF("b", "pb"), "b").join(planes.toDF("a", "pa"), "a")
    per = HASHES // 64
    differing = sum(F.bit_count(_any_bit([F.col("pa")[w + per * p].bitwiseXOR(F.col("pb")[w + per * p]) for p in range(BITS)])) for w in range(per))
    pairs = save(pairs.where(estimate(differing) >= cut).select("a", "b"), "pairs")
    # The full sets of classes that share a bucket, from the texts of their least documents.
    wanted = save(busy.select("class").distinct().join(classes.select("class", "least_id", "d1", "d2"), "class"), "wanted")
    source = df.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    # The hint gives small and large inputs the same plan.
    texts = source.join(wanted.select(F.col("least_id").alias("_w")).distinct().hint("merge"), F.col("_id").eqNullSafe(F.col("_w")), "left_semi")
    sets = _sets(texts, words).join(wanted.select("class", "d1", "d2"), ["d1", "d2"]).select("class", "shingles").dropDuplicates(["class"])
    sets = save(sets, "full-sets")
    # A pivot's set meets the others where they are: only the other side's own sets travel with the pairs.
    confirmed = pairs.join(sets.toDF("b", "sb"), "b").join(sets.toDF("a", "sa"), "a")
    both = F.size(F.array_intersect("sa", "sb"))
    links = save(confirmed.where(den * both >= num * (F.size("sa") + F.size("sb") - both)).select("a", "b"), "links")
    label = save(components(links), "labels")
    # The rest: buckets of three or more with members in different components.
    placed = busy.where("m > 2").join(label.select(F.col("id").alias("class"), F.col("component_id").alias("comp")), "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    sized = placed.join(classes.select("class", "size"), "class")
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    mixed = sized.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n"), F.sum("size").alias("shingles")).where("lo <> hi").select("bucket", blocks.alias("blocks"))
    open_ = save(placed.join(mixed, "bucket").select("bucket", "class", "comp", "blocks"), "open")
    if not open_.isEmpty():
        own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
        spread = open_.select("bucket", "class", "comp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        spread = spread.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "class", "comp", "own")
        spread = spread.join(planes, "class").join(sets, "class")
        more = spread.groupBy("bucket", "i", "j").applyInPandas(_block_links(num, den, cut), "a long, b long")
        more = save(more.distinct(), "links")
        if not more.isEmpty():
            forget(label)
            label = save(components(links.union(more)), "labels")
        forget(more)
    forget(busy, pairs, wanted, sets, open_, links)
    joined = classes.select("class", "least_id", "d1", "d2").join(label.select("id", "component_id"), F.col("class") == F.col("id"), "left")
    joined = joined.select("class", "least_id", "d1", "d2", F.coalesce("component_id", "class").alias("group"))
    least = joined.groupBy("group").agg(F.min("least_id").alias("_least"))
    named = save(joined.join(least, "group").select(F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), "group", "_least"), "components")
    forget(classes, label)
    out = signed.select("doc_id", "text_key", "n_shingles", "d1", "d2").join(named, (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")), "left")
    component = F.coalesce(F.col("_least"), F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "group", "text_key")


def _any_bit(columns):
    out = columns[0]
    for c in columns[1:]:
        out = out.bitwiseOR(c)
    return out


def _sets(df: DataFrame, words: int) -> DataFrame:
    """(d1, d2, shingles) of every (_id, _text) that has a shingle."""

    def make(columns, data, bounds):
        sets = [s for s in shingle_sets(data, bounds, words) if len(s)]
        ends = np.zeros(len(sets) + 1, np.int32)
        np.cumsum([len(s) for s in sets], out=ends[1:])
        flat = np.concatenate(sets).astype(np.int64) if sets else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([*_digests(sets), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["d1", "d2", "shingles"])

    return _rows_of(df.select(_bytes_of(F.col("_text"))), "d1 long, d2 long, shingles array<long>", make)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all documents: 3-word shingles, similarity 0.85."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, words=3, similarity=(17, 20)).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate group stays, that of the least id.

    Rows decide by id and text: of rows that repeat an id within a group one stays, and of rows equal in both one.
    Documents without words link with nothing and all stay, null texts too; an empty table stays empty; other columns pass through.
    """
    judged = near_duplicates(docs)
    least = judged.where("group is not null").groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("one")).select("one.doc_id", "one.text_key", F.lit(True).alias("grouped"))
    kept = save(least.union(judged.where("group is null").select("doc_id", "text_key", F.lit(False).alias("grouped")).distinct()), "kept")
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text_key"), "grouped")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (text_key(F.col("text")) == F.col("_text_key"))
    rows = judged.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1 and text_key is not null")
    if rows.isEmpty():
        return docs.join(kept, same, "left_semi")
    out = docs.join(kept, same)
    once = out.where("grouped").dropDuplicates(["_id", "_text_key"])
    return out.where("not grouped").union(once).select(*docs.columns)
