"""BPE encoding and decoding with content-defined chunk reuse (operator 4).

A rolling hash over 16 bytes cuts texts where their content says so, hence a passage that
documents share yields the same chunks wherever it stands. A chunk is encoded once and kept;
its white-space-delimited words are encoded once across all chunks. What stands at a chunk's
two ends, up to its first and from its last white space, may be half a word: that join is
repaired by re-encoding it together with the neighbours' ends, growing until it begins and
ends at white space, from where on the two encodings agree exactly (the tokenizer's splits
never cross ASCII white space).

That holds for tokenizers that lower-case, split at white space and at marks, as ``word_bpe_49k.json``
does. ``splits_as_known`` reads the tokenizer's own file; one whose normalizer or splitting differs
encodes every text whole with the tokenizers library, without reuse.

Both caches are bounded (``MOST_WORDS``, ``MOST_CHUNKS``) and last as long as a task: a worker that
waits for other stages' work holds none. Emptying one only costs re-encoding. Nothing is shuffled.

Defined results: rows repeating a text or an id are encoded each; null and empty text encode to no ids and decode to empty text. Text of any
length is encoded whole. The tokenizer file is a parameter and is read on each worker;
its truncation and padding are not used and no special tokens are added.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, byte_views, mix64, row_chunks, table, tidy

MOST_WORDS = 90_000
MOST_CHUNKS = 15_000
CUT_BITS = 8
_MARKS = b".,;:!?*$%&#)"
_GEAR = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(32)).astype(np.uint32)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# How word_bpe_49k.json normalizes and splits texts.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def splits_as_known(tokenizer) -> bool:
    """Whether a text's words may be encoded apart: the tokenizer normalizes, splits and knows special tokens as ``word_bpe_49k.json`` does."""
    own = json.loads(tokenizer.to_str())
    split = ((own.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return (
        (own.get("normalizer") or {}).get("normalizers") == _NORMALIZER
        and (split.get("type"), split.get("pattern"), split.get("behavior"), split.get("invert")) == ("Split", {"Regex": _SPLIT}, "Removed", True)
        and all(t["content"].startswith("<|") and not any(t[k] for k in ("lstrip", "rstrip", "single_word", "normalized")) for t in own["added_tokens"])
        and own["post_processor"] is None
    )


def chunk_cuts(data: np.ndarray) -> np.ndarray:
    """Positions after which the rolling hash of the last 16 bytes cuts."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        later = h.copy()
        later[step:] += h[:-step] << np.uint32(step)
        h = later
    return np.flatnonzero((h >> np.uint32(32 - CUT_BITS - 8)) & np.uint32((1 << CUT_BITS) - 1) == 0) + 1


class ChunkEncoder:
    """Encodes byte texts to int32 ids (as bytes), reusing words and chunks."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.by_parts = splits_as_known(self.tokenizer)
        self.words: dict[bytes, bytes] = {}
        self.old_words: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, tuple] = {}
        self.older: dict[bytes, tuple] = {}

    def forget(self) -> None:
        for cache in (self.words, self.old_words, self.chunks, self.older):
            cache.clear()

    def learn(self, words) -> None:
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > MOST_WORDS:
            self.old_words, self.words = self.words, {}
            new = list(words)
        if self.old_words:
            old = self.old_words
            self.words.update({w: old[w] for w in new if w in old})
            new = [w for w in new if w not in old]
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            texts = [w.decode("utf-8", "replace") for w in some]
            for w, e in zip(some, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
                self.words[w] = np.asarray(e.ids, "<i4").tobytes()

    def encode(self, texts: list[bytes], cuts: list[np.ndarray], simple=None) -> list[bytes]:
        """Ids of each text; ``cuts``: its inner chunk bounds; ``simple``: has no character beyond U+00FF.

        Where no combining mark can follow a letter, A-Z may be lower-cased before the
        tokenizer's own normalization: more words are then equal.
        """
        if not self.by_parts:
            whole = self.tokenizer.encode_batch([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
            return [np.asarray(e.ids, "<i4").tobytes() for e in whole]
        plans, need, fresh = [], set(), {}
        for i, (text, cut) in enumerate(zip(texts, cuts)):
            if (simple is not None and simple[i] or text.isascii()) and b"<|" not in text:
                text = text.lower()
            plan, carry, start = [], b"", 0
            for stop in [*cut.tolist(), len(text)]:
                raw, start = text[start:stop], stop
                got = self.chunks.get(raw) or fresh.get(raw)
                if got is None:
                    got = self.older.get(raw)
                    if got is None:
                        got = fresh[raw] = self._parts(raw)
                        need.update(got[1])
                    else:
                        self.chunks[raw] = got
                head, _, tail, _ = got
                if tail is None:  # no white space: the join goes on
                    carry += head
                    continue
                joined = carry + head
                if joined:
                    need.add(joined)
                    plan.append(joined)
                plan.append(got)
                carry = tail
            if carry:
                need.add(carry)
                plan.append(carry)
            plans.append(plan)
        self.learn(need)
        words = self.words
        for got in fresh.values():
            got[3] = b"".join([words[w] for w in got[1]])
            got[1] = None
        out = [b"".join([p[3] if p.__class__ is list else words[p] for p in plan]) for plan in plans]
        if len(self.chunks) + len(fresh) > MOST_CHUNKS:
            self.older, self.chunks = self.chunks, {}
        self.chunks.update(list(fresh.items())[:MOST_CHUNKS])
        return out

    @staticmethod
    def _parts(raw: bytes) -> list:
        """[before the first white space, words between, after the last (None: there is none), their ids]."""
        words = raw.split()
        if not words:
            return [b"", [], b"" if raw else None, b""]
        head = b"" if raw[:1].isspace() else words.pop(0)
        if not words:
            return [head, [], None if len(head) == len(raw) else b"", b""]
        tail = b"" if raw[-1:].isspace() else words.pop()
        return [head, ChunkEncoder._split_marks(words) if words else words, tail, b""]

    @staticmethod
    def _split_marks(words: list[bytes]) -> list[bytes]:
        """Words with trailing marks apart: the tokenizer splits there too, and bare words repeat more often.

        Only after a letter or digit, so that no run of marks is cut, and not in special tokens.
        """
        out = []
        for w in words:
            if w[-1] in _MARKS and w[0] not in b"<'":
                bare = w.rstrip(_MARKS)
                if bare and (bare[-1:].isalnum()):
                    out.append(bare)
                    out.append(w[len(bare) :])
                    continue
            out.append(w)
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> ChunkEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return ChunkEncoder(path)


def encode(df: DataFrame, text: str = "text", tokenizer: str | None = None, keep: tuple[str, ...] = ("doc_id",), decoded: bool = False) -> DataFrame:
    """``keep`` columns and ``ids`` array<int> of each text; with ``decoded`` also what these ids decode to, in the same pass."""
    path = tokenizer or default_tokenizer()
    rows = bounded_batches(df).select(*keep, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    schema = rows.drop("_text").schema.add("ids", T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add("decoded", "string")

    def run(batches):
        encoder = _encoder(path)
        for batch in batches:
            buf, off = byte_views(batch.column(batch.num_columns - 1))
            for a, b in row_chunks(off, 2 << 20):
                data = buf[off[a] : off[b]]
                cuts, bounds = chunk_cuts(data), off[a : b + 1] - off[a]
                at = np.searchsorted(cuts, bounds)
                texts = [data[bounds[i] : bounds[i + 1]].tobytes() for i in range(b - a)]
                inner = [c[(c > 0) & (c < len(t))] for t, c in zip(texts, (cuts[at[i] : at[i + 1]] - bounds[i] for i in range(b - a)))]
                wide = np.concatenate([[0], np.cumsum(data >= 0xC4)])
                ids = encoder.encode(texts, inner, wide[bounds[1:]] == wide[bounds[:-1]])
                ends = np.zeros(b - a + 1, np.int32)
                np.cumsum([len(x) // 4 for x in ids], out=ends[1:])
                coded = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32()))
                more = [_texts_of(coded, path)] if decoded else []
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(batch.num_columns - 1)), coded, *more], names=schema.names)
        encoder.forget()

    return rows.mapInArrow(tidy(run), schema)


@lru_cache(maxsize=2)
def _vocabulary(path: str):
    """Tokens by id, and whether decoding is their joining by a space (a tokenizer without decoder)."""
    t = _encoder(path).tokenizer
    vocab = t.get_vocab(with_added_tokens=True)
    tokens = [None] * (max(vocab.values()) + 1)
    for word, i in vocab.items():
        tokens[i] = word
    return pa.array(tokens, pa.string()), t.decoder is None


def _texts_of(column, path: str):
    """The decoded texts of an Arrow column of id lists."""
    tokens, plain = _vocabulary(path)
    if not plain:
        tok = _encoder(path).tokenizer
        return pa.array([x if x is None else tok.decode(x, skip_special_tokens=False) for x in column.to_pylist()], pa.string())
    flat = column.flatten()
    known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(tokens)))
    if flat.null_count or not pc.all(known, min_count=0).as_py():  # ids of no token are left out
        return pa.array([x if x is None else " ".join(t for i in x if i is not None and 0 <= i < len(tokens) and (t := tokens[i].as_py()) is not None) for x in column.to_pylist()], pa.string())
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    ends = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=ends[1:])
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), tokens.take(flat)), " ")
    return pc.if_else(pc.is_null(column), pa.scalar(None, pa.string()), texts) if column.null_count else texts


def decode(df: DataFrame, ids: str = "ids", tokenizer: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``decoded`` text of each array of ids, special tokens kept; null ids give null."""
    path = tokenizer or default_tokenizer()
    rows = bounded_batches(df).select(*keep, F.col(ids).cast("array<int>").alias("_ids"))
    schema = rows.drop("_ids").schema.add("decoded", "string")

    def run(batches):
        for batch in batches:
            texts = _texts_of(batch.column(batch.num_columns - 1), path)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), texts], names=schema.names)

    return rows.mapInArrow(tidy(run), schema)


def digest(df: DataFrame, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text; one Python worker a task encodes and decodes."""
    coded = encode(df, text, tokenizer, decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: training rows, doc_id, n_tokens and the digests of each document's ids and decoded text.

    A null text has no ids; repeated rows give a row each; columns besides doc_id and text end here.
    """
    return digest(docs)
