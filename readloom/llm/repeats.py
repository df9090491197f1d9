"""Exact repeats over a run-length index (operator 6).

A byte is removed if a ``length``-byte string covering it also starts earlier: in a document of
smaller id, or earlier in the same one. Strings never cross documents.

1. Windows of ``length`` bytes are dealt to anchors: the least k-gram hash in the window. Equal
   windows have the same anchor k-gram at the same offset, so only windows whose anchor occurs
   twice can repeat. Consecutive windows of one anchor form a segment.
2. Segments equal as a whole (by a BLAKE2b digest of their bytes) are settled by their first
   occurrence alone; all later ones repeat.
3. Where an anchor has several different segments, their first occurrences are indexed, anchors
   dealt to buckets of bounded text: suffix array, run-compressed Burrows-Wheeler transform, and
   at the run heads the sampled suffix positions with their match lengths. Between samples a match
   shrinks by one byte a step, so streaming from sample to sample yields the matching
   statistics of every position. Positions matching over ``length`` bytes form classes; all but
   the earliest of a class are marked.
4. An anchor whose different segments hold over ``BUCKET_BYTES`` is split by content: its segments alone
   go through the same steps with longer k-grams (24, 62, 81, ... up to ``length`` bytes), which
   more windows tell apart. A level has at most about twice the rows of what it splits.

Anchor hashes only decide which windows meet: a collision costs work, not right results.

Defined results: null text is empty and loses nothing; a text shorter than ``length`` loses
nothing; rows that repeat an id are ordered by a hash of their text, and rows repeating id and
text are one document (nothing is removed for their sake, both rows get the same result); a null
id sorts first. A text of any length is read in pieces of a megabyte. Other columns are not read.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, byte_views, forget, mix64, release_memory, row_chunks, save, table, tidy

LENGTH, GRAM = 100, 24
BUCKET_BYTES, PIECE_BYTES = 250_000, 1 << 20
_PLACE = (1 << 30) - 1
_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes at every position that has so many, by doubling."""
    power, size = _CODES[data], 1
    out, done = None, 0
    while True:
        if gram & size:
            if out is None:
                out = power
            else:
                tail = power[done:]
                out = out[: len(tail)] * np.uint64(pow(_BASE, size, 1 << 64)) + tail
            done += size
        if done == gram:
            return mix64(out)
        power = power[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + power[size:]
        size *= 2


def segments(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of window starts with one anchor: (row, start in row, windows, anchor hash, content digest)."""
    n = len(data)
    sizes = np.diff(bounds)
    if n < length or not (sizes >= length).any():
        return (np.zeros(0, np.int64),) * 5
    grams = gram_hashes(data, gram)
    low = (grams & ~np.uint64(_PLACE)) | np.arange(len(grams), dtype=np.uint64)
    span, reach = length - gram + 1, 1
    while reach * 2 <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < span:
        low = np.minimum(low[: len(low) - (span - reach)], low[span - reach :])
    # low[i]: least key among the k-grams of the window starting at i
    inside = np.zeros(n + 1, np.int32)
    long_rows = sizes >= length
    np.add.at(inside, bounds[:-1][long_rows], 1)
    np.add.at(inside, bounds[1:][long_rows] - length + 1, -1)
    valid = np.flatnonzero(np.cumsum(inside[: len(low)], dtype=np.int32) > 0)
    at = (low[valid] & np.uint64(_PLACE)).astype(np.int64)
    head = np.ones(len(valid), bool)
    head[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)
    begins = np.searchsorted(valid, bounds[:-1][long_rows])  # a row's first window starts a segment
    head[begins] = True
    first = np.flatnonzero(head)
    starts, windows = valid[first], np.diff(np.append(first, len(valid)))
    rows = np.searchsorted(bounds, starts, side="right") - 1
    raw = data.tobytes()
    ends = (starts + windows + length - 1).tolist()
    content = np.frombuffer(b"".join([blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(starts.tolist(), ends)]), np.int64)
    return rows, starts - bounds[rows], windows, grams[at[first]].astype(np.int64), content


def suffix_array(symbols: np.ndarray, most: int) -> np.ndarray:
    """Suffix order by prefix doubling; suffixes differ within ``most`` symbols."""
    n = len(symbols)
    s = np.zeros(n + 2, np.int64)
    s[:n] = symbols + 1
    key, reach = (s[:-2] << 42) | (s[1:-1] << 21) | s[2:], 3
    while True:
        order = np.argsort(key)
        ranked = key[order]
        step = np.ones(n, np.int64)
        step[1:] = ranked[1:] != ranked[:-1]
        place = np.cumsum(step)
        if place[-1] == n or reach > most:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = place
        later = np.zeros(n, np.int64)
        later[:-reach] = rank[reach:]
        key, reach = rank * (n + 1) + later, reach * 2


class RunLengthIndex:
    """Run-compressed BWT of several byte strings with sampled run heads and their match lengths."""

    def __init__(self, parts: list[bytes]):
        count = len(parts)
        sizes = np.array([len(p) for p in parts], np.int64)
        self.ends = np.cumsum(sizes + 1) - 1  # of each string, where its separator stands
        self.text = np.zeros(int(self.ends[-1]) + 1, np.uint8)
        symbols = np.zeros(len(self.text), np.int64)
        body = np.ones(len(self.text), bool)
        body[self.ends] = False
        self.text[body] = np.frombuffer(b"".join(parts), np.uint8)
        symbols[body] = self.text[body] + np.int64(count)
        symbols[self.ends] = np.arange(count)  # separators differ, so that no match crosses one
        self.order = suffix_array(symbols, int(sizes.max()) + 1)
        bwt = symbols[self.order - 1]
        head = np.ones(len(bwt), bool)
        head[1:] = bwt[1:] != bwt[:-1]
        self.run_heads = np.flatnonzero(head)  # the runs of the transform
        self.run_symbols = bwt[self.run_heads]
        self.left = np.repeat(self.ends, sizes + 1) - np.arange(len(self.text))  # bytes left in the string

    def matching_statistics(self) -> np.ndarray:
        """For every position the match length with its lexicographic predecessor, streamed from the run-head samples."""
        heads = self.run_heads[self.run_heads > 0]
        here, before = self.order[heads], self.order[heads - 1]
        most = np.minimum(self.left[here], self.left[before])
        padded = np.concatenate([self.text, np.zeros(8, np.uint8)])
        words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(self.text) + 1]).view(">u8").reshape(-1)
        sampled = most.copy()
        live, at = np.arange(len(heads)), 0
        while len(live):
            live = live[most[live] > at]
            differ = words[here[live] + at] ^ words[before[live] + at]
            found = differ != 0
            same = np.zeros(int(found.sum()), np.int64)
            for b in range(7):
                same += (differ[found] >> np.uint64(8 * (7 - b))) == 0
            sampled[live[found]] = np.minimum(most[live[found]], at + same)
            live, at = live[~found], at + 8
        length = np.zeros(len(self.text), np.int64)
        length[here] = sampled
        last = np.zeros(len(self.text), np.int64)
        last[here] = here
        last[self.order[0]] = self.order[0]
        last = np.maximum.accumulate(last)
        return np.maximum(length[last] - (np.arange(len(self.text)) - last), 0)

    def later_copies(self, length: int) -> np.ndarray:
        """Positions whose next ``length`` bytes also start at an earlier position."""
        match = self.matching_statistics()[self.order]
        head = match < length
        head[0] = True
        first = np.flatnonzero(head)
        least = np.minimum.reduceat(self.order, first)
        klass = np.cumsum(head) - 1
        return np.sort(self.order[self.order > least[klass]])


def _runs(positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of consecutive sorted positions."""
    if not len(positions):
        return positions, positions
    head = np.append(True, positions[1:] != positions[:-1] + 1)
    first = np.flatnonzero(head)
    return positions[first], np.diff(np.append(first, len(positions)))


def _mark_bucket(length: int):
    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["doc", "th", "start"], na_position="first", kind="stable").drop_duplicates(["doc", "th", "start"]).reset_index(drop=True)
        parts = [bytes(x) for x in pdf["segment"]]
        index = RunLengthIndex(parts)
        at, n = _runs(index.later_copies(length))
        which = np.searchsorted(index.ends, at)
        begin = index.ends[which] - np.array([len(p) for p in parts], np.int64)[which]
        start = pdf["start"].to_numpy()[which] + at - begin
        del index
        release_memory()
        return pd.DataFrame({"doc": pdf["doc"].astype("Int64").iloc[which].to_numpy(), "th": pdf["th"].to_numpy()[which], "start": start, "n": n})

    return run


def _pieces(off: np.ndarray, length: int, most: int):
    """Row ranges of bounded bytes as (first row, bounds); a longer row comes alone in pieces that share ``length`` - 1 bytes, with its place as third."""
    for a, b in row_chunks(off, most):
        size = int(off[b] - off[a])
        if b - a > 1 or size <= most + length:
            yield a, off[a : b + 1], 0
        else:
            for at in range(0, size - length + 1, most):
                yield a, off[a] + np.array([at, min(at + most + length - 1, size)]), at


def _cut(length: int, gram: int, most: int):
    def run(batches):
        for batch in batches:
            buf, off = byte_views(batch.column(3))
            for a, bounds, at in _pieces(off, length, most):
                rows, starts, windows, anchor, content = segments(buf[bounds[0] : bounds[-1]], bounds - bounds[0], length, gram)
                pick = pa.array(rows + a)
                place = [batch.column(i).take(pick) for i in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(content), *place, pa.array((starts + at).astype(np.int32)), pa.array(windows.astype(np.int32))], names=["anchor", "content", "doc", "th", "base", "start", "n"])

    return run


def repeat_ranges(df: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(doc, th, start, n): runs of n window starts that occur earlier; th is the hash of the document's text."""
    source = bounded_batches(df).select(F.col(key).cast("long").alias("doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"), F.lit(0).alias("base"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    ranges, tables = [], []
    while True:
        more, heavy = _level(source, length, gram, bucket_bytes, piece_bytes)
        ranges.append(more)
        tables.append(heavy)
        if gram == length or heavy.isEmpty():
            break
        source, gram = heavy.select("doc", "th", F.col("start").alias("base"), F.col("segment").alias("raw")), (gram + length + 1) // 2
    forget(*tables)
    out = ranges[0]
    for x in ranges[1:]:
        out = out.unionByName(x)
    return out


def _level(source: DataFrame, length: int, gram: int, bucket_bytes: int, piece_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Marks of the windows of ``source(doc, th, base, raw)`` as far as one level of k-grams decides them, and the segments it leaves to the next."""
    cuts = source.select("doc", "th", "base", "raw").mapInArrow(tidy(_cut(length, gram, piece_bytes)), "anchor long, content long, doc long, th long, base int, start int, n int")
    cuts = save(cuts, "cuts")
    # Written first, so that the join below may split what it reads of a hot anchor.
    shared = save(cuts.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    rows = save(cuts.join(shared, "anchor", "left_semi").withColumn("at", F.col("base") + F.col("start")), "segments")
    forget(cuts, shared)
    place = F.struct("doc", "th", "at")
    first = rows.groupBy("anchor", "content").agg(F.min(F.struct("doc", "th", "at", "base", "start")).alias("first"), F.first("n").alias("n"), F.count("*").alias("copies"))
    first = save(first, "firsts")
    repeated = first.where("copies > 1").select("anchor", "content", F.struct("first.doc", "first.th", "first.at").alias("first"))
    later = rows.join(repeated, ["anchor", "content"]).where(place > F.col("first")).select("doc", "th", F.col("at").alias("start"), "n")
    several = first.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum(F.col("n") + length).alias("bytes")).where("kinds > 1")
    open_ = save(first.join(several, "anchor").select("anchor", "bytes", "first.doc", "first.th", "first.base", "first.start", "first.at", "n"), "open")
    # The bytes of these segments, from where they were cut.
    asked = open_.groupBy("doc", "th", "base").agg(F.collect_list(F.struct("anchor", "bytes", "start", "at", "n")).alias("asked")).toDF("_d", "_t", "_b", "asked")
    met = source.join(asked, F.col("doc").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")) & (F.col("base") == F.col("_b")))
    # Cut before the rows are spread, so that no row carries the text it was cut from.
    piece = lambda a: F.struct(a["anchor"].alias("anchor"), a["bytes"].alias("bytes"), a["at"].alias("start"), F.substring(F.col("raw"), a["start"] + 1, a["n"] + length - 1).alias("segment"))
    found = save(met.select("doc", "th", F.explode(F.transform("asked", piece)).alias("a")).select("doc", "th", "a.*"), "open-text")
    total = open_.where(F.col("bytes") <= bucket_bytes).agg(F.sum(F.col("n") + length)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    light = found.where(F.col("bytes") <= bucket_bytes).withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    indexed = light.select("bucket", "doc", "th", "start", "segment").groupBy("bucket").applyInPandas(_mark_bucket(length), "doc long, th long, start int, n int")
    marks = save(later.unionByName(indexed), "ranges")
    heavy = save(found.where(F.col("bytes") > bucket_bytes).select("doc", "th", "start", "segment"), "heavy")
    forget(rows, first, open_, found)
    return marks, heavy


def _without(raw: bytes, starts: np.ndarray, ends: np.ndarray, whole_chars: bool) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs, what remains) of ``raw`` without its spans."""
    if whole_chars:
        data = np.frombuffer(raw, np.uint8)
        for _ in range(3):
            starts = starts - ((data[starts] & 0xC0) == 0x80)
            ends = ends + ((ends < len(data)) & ((data[np.minimum(ends, len(data) - 1)] & 0xC0) == 0x80))
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    head = np.append(True, starts[1:] > reach[:-1])
    first = np.flatnonzero(head)
    starts, ends = starts[first], reach[np.append(first[1:], len(reach)) - 1]
    kept = [raw[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(raw)])]
    return int((ends - starts).sum()), len(starts), b"".join(kept)


def remove_repeats(df: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, whole_chars: bool = False, **options) -> DataFrame:
    """All columns with n_bytes, n_removed, n_spans and ``kept`` (the remaining bytes).

    ``whole_chars`` also removes the rest of a character of which a byte is removed, so that
    ``kept`` stays UTF-8.
    """
    ranges = repeat_ranges(df, text, key, length, **options)
    spans = ranges.groupBy("doc", "th").agg(F.collect_set(F.struct("start", "n")).alias("_spans")).select(F.col("doc").alias("_d"), F.col("th").alias("_t"), "_spans")
    names = [c for c in df.columns if c not in ("n_bytes", "n_removed", "n_spans", "kept")]
    rows = df.select(*names, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_raw"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_h"), F.col(key).cast("long").alias("_k"))
    rows = rows.join(spans, F.col("_k").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_t")), "left")
    rows = rows.select(*names, "_raw", F.col("_spans.start").alias("_start"), F.col("_spans.n").alias("_n"))
    schema = rows.select(*names).schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")

    def one(raw, starts, counts):
        starts = np.asarray(starts).astype(np.int64)
        return _without(raw.as_py(), starts, starts + np.asarray(counts) + (length - 1), whole_chars)

    def run(batches):
        for batch in batches:
            raw_at = batch.num_columns - 3
            _, off = byte_views(batch.column(raw_at))
            for a, b in row_chunks(off, 2 << 20):
                raws = batch.column(raw_at).slice(a, b - a)
                starts, counts = batch.column(raw_at + 1).slice(a, b - a), batch.column(raw_at + 2).slice(a, b - a)
                got = [one(raws[i], starts[i].values, counts[i].values) if starts[i].is_valid else (0, 0, raws[i].as_py()) for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(raw_at)), pa.array(np.diff(off[a : b + 1])), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.binary())], names=schema.names)

    return rows.mapInArrow(tidy(run), schema)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their repeated 100-byte strings."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without strings that an earlier document has; documents left empty by it go.

    Null and empty texts stay as they are, rows equal in id and text get equal texts, an empty table stays
    empty; n_chars follows the text where it changes, other columns pass through.
    """
    out = remove_repeats(docs, whole_chars=True)
    cleaned = F.when(F.col("n_removed") > 0, F.col("kept").cast("string")).otherwise(F.col("text"))
    emptied = (F.col("n_removed") > 0) & (F.length(F.trim(cleaned)) == 0)
    changed = out.where(~F.coalesce(emptied, F.lit(False))).withColumns({"text": cleaned, "n_chars": F.when(F.col("n_removed") > 0, F.length(cleaned).cast("long")).otherwise(F.col("n_chars"))})
    return changed.select(*docs.columns)
