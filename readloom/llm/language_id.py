"""Language identification (operator 9).

Multinomial naive Bayes over hashed character n-grams (1 to 3 characters, ``BUCKETS`` buckets,
lower-cased). Counts come from a sample of labelled documents of about ``sample_per_lang`` a
language (all of a rarer language), chosen by a hash of id and text. Every language is learned; the log-probability
matrix is cut into groups of ``GROUP`` languages (17 MB in float32), of which one at a time is built, broadcast and
scored, so that neither the driver nor a task ever holds more, whatever the corpus holds. Batches are scored as sparse rows in
numpy: bucket ids of all n-grams, gathered log-probabilities, sums by document. With several groups each gives a
document's best language and the sum of its likelihoods, and these are put together by id and text.

``score`` is the posterior probability of the predicted language under equal priors.

Defined results: null text and text without a letter get ``und`` with score 0; with no labelled
documents to learn from, everything is ``und``. A null id counts as empty text in the fold
(crc32 0: held out). Repeated rows are labelled alike, and drawn together; of languages that score the same the first by name
is told. Result columns replace input columns of
the same name; other columns pass through. A text of any length is scored in pieces. The names and counts of the languages are held on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, crc_fold, forget, release_memory, save, table, tidy

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SAMPLE_PER_LANG = 2000
#: Languages that are scored at once.
GROUP = 64
#: Names of languages that are sent to every task; with more, texts and names meet by a shuffle.
MOST_SENT = 100_000
PIECE_CHARS = 1_000_000
_ODD = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


def ngram_buckets(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order the bucket at every character (``BUCKETS`` where the n-gram would leave its text), and text bounds."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    n, out, h = len(points), [], np.zeros(len(points), np.uint32)
    for k in ORDERS:
        shifted = np.zeros(n, np.uint32)
        shifted[: max(n - k + 1, 0)] = points[k - 1 :]
        h = (h ^ shifted) * _ODD[k - 1]
        h ^= h >> np.uint32(15)
        ids = ((h * np.uint32(0x2C1B3C6D)) >> np.uint32(16)).astype(np.int32)
        for j in range(1, k):
            at = bounds[1:] - j
            ids[at[at >= bounds[:-1]]] = BUCKETS
        out.append(ids)
    return out, bounds


def _pieces(texts: list[str], most: int):
    """(rows, lower-cased pieces, characters of each that count) in lists of at most about ``most`` characters.

    A longer text comes in several pieces, each followed by the characters that its last n-grams need.
    """
    rows, pieces, own, held = [], [], [], 0
    for i, text in enumerate(texts):
        low = text.lower()
        for at in range(0, len(low), most):
            piece = low[at : at + most + ORDERS[-1] - 1]
            if held and held + len(piece) > most:
                yield rows, pieces, own
                rows, pieces, own, held = [], [], [], 0
            rows.append(i)
            pieces.append(piece)
            own.append(min(most, len(low) - at))
            held += len(piece)
    if rows:
        yield rows, pieces, own


def _owned(ids: list[np.ndarray], bounds: np.ndarray, own: list[int]) -> None:
    """Blank the n-grams that start in the next piece of the same text."""
    for i in np.flatnonzero(np.diff(bounds) > own):
        for one in ids:
            one[bounds[i] + own[i] : bounds[i + 1]] = BUCKETS


@dataclass
class LanguageGroup:
    """Some of a model's languages: their names and log-probabilities, and what they say about texts."""

    langs: list[str]
    logp: np.ndarray  # languages x (BUCKETS + 1); the last bucket weighs nothing

    def predict(self, texts: list[str], piece_chars: int = PIECE_CHARS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the best language, its log-likelihood, log of the sum of all likelihoods) of texts."""
        total = np.zeros((len(texts), len(self.langs)))
        for rows, pieces, own in _pieces(texts, piece_chars):
            ids, bounds = ngram_buckets(pieces)
            _owned(ids, bounds, own)
            for i, row in enumerate(self.logp):
                gathered = row[ids[0]].astype(np.float64)
                for one in ids[1:]:
                    gathered += row[one]
                np.add.at(total[:, i], rows, np.add.reduceat(gathered, bounds[:-1]))
        best, top = total.argmax(axis=1), total.max(axis=1, initial=-np.inf)
        return best, top, top + np.log(np.exp(total - top[:, None]).sum(axis=1))


@dataclass
class LanguageModel:
    """Counted n-grams of all languages; ``groups`` gives their matrices, one at a time."""

    langs: list[str]
    counted: DataFrame | None
    group: int = GROUP

    @classmethod
    def fit(cls, docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample_per_lang: int = SAMPLE_PER_LANG, group: int = GROUP) -> LanguageModel:
        """Learn from all rows of ``docs`` with text and language, sampled where a language has many."""
        draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.col(text)), F.lit(1 << 30)) / float(1 << 30)
        labelled = bounded_batches(docs).where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("_lang"), F.col(text).alias("_text"), draw.alias("_draw"))
        counts = {r[0]: r[1] for r in labelled.groupBy("_lang").count().collect()}
        langs = sorted(counts)
        if not langs:
            return cls([], None, group)
        rates = docs.sparkSession.createDataFrame([(x, i, sample_per_lang / counts[x]) for i, x in enumerate(langs)], "_name string, _code int, _rate double")
        # A join by language would shuffle every text to its language's task; a list of names within the bound goes to the texts instead.
        rates = F.broadcast(rates) if len(langs) <= MOST_SENT else rates
        sample = labelled.join(rates, F.col("_lang") == F.col("_name")).where(F.col("_draw") < F.col("_rate")).select("_code", "_text", "_draw")

        def count(batches):
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                codes, texts = np.asarray(batch.column(0)), batch.column(1).to_pylist()
                for rows, pieces, own in _pieces(texts, PIECE_CHARS):
                    ids, bounds = ngram_buckets(pieces)
                    _owned(ids, bounds, own)
                    code = np.repeat(codes[rows], np.diff(bounds))
                    for i in np.unique(codes[rows]).tolist():
                        if i not in held:
                            if len(held) >= GROUP:
                                yield from _counts(held)
                                held.clear()
                            held[i] = np.zeros(BUCKETS + 1, np.int64)
                        for one in ids:
                            held[i] += np.bincount(one[code == i], minlength=BUCKETS + 1)
            yield from _counts(held)

        counted = sample.repartition("_draw").select("_code", "_text").mapInArrow(tidy(count), "code int, bucket int, n long").groupBy("code", "bucket").agg(F.sum("n").alias("n"))
        return cls(langs, save(counted, "ngrams"), group)

    def groups(self) -> Iterator[LanguageGroup]:
        for first in range(0, len(self.langs), self.group):
            names = self.langs[first : first + self.group]
            got = self.counted.where((F.col("code") >= first) & (F.col("code") < first + len(names))).toArrow()  # at most GROUP x BUCKETS numbers
            total = np.full((len(names), BUCKETS + 1), 0.5)
            total[np.asarray(got["code"]) - first, np.asarray(got["bucket"])] += np.asarray(got["n"])
            logp = np.log(total / total[:, :BUCKETS].sum(axis=1, keepdims=True))
            logp[:, BUCKETS] = 0
            yield LanguageGroup(names, logp.astype(np.float32))

    def close(self) -> None:
        """Delete the counts."""
        if self.counted is not None:
            forget(self.counted)


def _counts(held: dict[int, np.ndarray]):
    for code, numbers in held.items():
        bucket = np.flatnonzero(numbers[:BUCKETS])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bucket), code), pa.int32()), pa.array(bucket, pa.int32()), pa.array(numbers[bucket], pa.int64())], names=["code", "bucket", "n"])


def _judged(df: DataFrame, text, group: LanguageGroup) -> DataFrame:
    """``df`` with ``_got``: lang, top and total of one group of languages."""
    shared = df.sparkSession.sparkContext.broadcast(group)

    @F.pandas_udf("lang string, top double, total double")
    def label(texts):
        import pandas as pd

        best, top, total = shared.value.predict(texts.tolist())
        release_memory()
        return pd.DataFrame({"lang": np.array(shared.value.langs, object)[best], "top": top, "total": total})

    return df.select("*", label(text).alias("_got"))


def identify(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """All columns with lang_pred and score. With more than one group of languages a text is scored once a group."""
    rest = [c for c in df.columns if c not in ("lang_pred", "score")]
    if not model.langs:
        return df.select(*rest, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    bounded_batches(df)
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    result = lambda got: [F.when(F.col("_lettered"), got["lang"]).otherwise("und").alias("lang_pred"), F.when(F.col("_lettered"), F.least(F.exp(got["top"] - got["total"]), F.lit(1.0))).otherwise(0.0).alias("score")]
    # Texts without a letter are not judged; they go through empty.
    judged_text = F.when(F.col("_lettered"), F.col(text)).otherwise("")
    if len(model.langs) <= model.group:
        out = _judged(df.select(*rest, lettered.alias("_lettered")), judged_text, next(model.groups()))
        return out.select(*rest, *result(F.col("_got")))
    # Several groups: the distinct texts are scored against each, and the parts put together by the text's digest.
    digest = F.sha2(F.col(text).cast("binary"), 256)
    texts = save(df.where(lettered).select(F.col(text).alias("_text"), digest.alias("_digest")).groupBy("_digest").agg(F.first("_text").alias("_text")), "texts")
    parts = [save(_judged(texts, F.col("_text"), g).select("_digest", "_got.*"), "judged") for g in model.groups()]
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    top = F.array_max(F.transform("_g", lambda g: g["top"]))
    best = F.array_min(F.transform(F.filter("_g", lambda g: g["top"] == F.col("_top")), lambda g: g["lang"]))
    total = F.aggregate("_g", F.lit(0.0), lambda a, g: a + F.exp(g["total"] - F.col("_top")))
    one = every.groupBy("_digest").agg(F.collect_list(F.struct("lang", "top", "total")).alias("_g")).withColumn("_top", top)
    one = save(one.select(F.col("_digest").alias("_d"), F.struct(best.alias("lang"), F.col("_top").alias("top"), (F.col("_top") + F.log(total)).alias("total")).alias("_got")), "languages")
    forget(texts, *parts)
    out = df.select(*rest, lettered.alias("_lettered"), digest.alias("_digest")).join(one, F.col("_lettered") & (F.col("_digest") == F.col("_d")), "left")
    return out.select(*rest, *result(F.col("_got")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the four folds that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = crc_fold(F.col("doc_id"))
    model = LanguageModel.fit(docs.where(fold != 0))
    out = identify(docs.select("doc_id", "text"), model).select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")
    model.close()
    return out


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str, least_score: float = 0.5) -> DataFrame:
    """Pipeline stage: documents whose language is known with at least ``least_score``.

    Null texts and texts without a letter go, like those no language claims; with no labelled document all go.
    Repeated rows share their fate, an empty table stays empty, other columns pass through.
    """
    model = LanguageModel.fit(docs)
    judged = identify(docs, model)
    model.close()
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= least_score)).select(*docs.columns)
