"""Prediction by partial matching (operator 5).

A byte-context trie of depth ``ORDER``: every node is a context of 0 to ORDER bytes with the
counts of the symbols that followed it in training (bytes and an end-of-text symbol; contexts
at the beginning hold start symbols). Escape by method C: a context with t counts of d symbols
gives a symbol of count c the probability c / (t + d) and the escape d / (t + d), then the next
shorter context is asked, with the symbols of the longer one excluded throughout. Below the
empty context the symbols never seen are equally likely. Probabilities of all symbols sum to
one in every context.

The trie lives in tables, one row a (context, symbol): nothing of it is broadcast or collected.
Its levels are sums over the deepest grams, and the code length of every gram comes from joining
each level with the next shorter one. Documents are dealt to blocks of bounded text. A block
asks for its distinct grams and words once, gets their code lengths and counts, and scores its
documents in numpy; so what travels is each block's vocabulary, not its text's grams.

``adaptive_code_lengths`` is the other use: each document alone, its trie growing byte by byte.

Words and grams are kept as 64-bit keys: grams exactly (9 bits a symbol), words by BLAKE2b digest.

Defined results: null text is empty (one end token, one end symbol); a null id counts as
empty text in the fold; with no training document all symbols are equally likely and every
token has count 0; rows repeating an id are scored each by its own text. A text of any length is
read in pieces of bounded size. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_fold, forget, release_memory, save, table, word_keys

ORDER = 4
END, START, BITS = 256, 257, 9
SYMBOLS = 257
BLOCK_BYTES, PART_BYTES = 16_000_000, 1_500_000
_END_WORD = np.int64(1)


def grams_of(data: np.ndarray, bounds: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """For every symbol of every row (its bytes, then the end) the gram of ``order`` symbols before it and itself; rows' bounds."""
    rows = len(bounds) - 1
    sizes = np.diff(bounds)
    # Each row stands behind ``order`` start symbols and ends with the end symbol.
    wide = np.full(len(data) + rows * (order + 1), START, np.int64)
    place = np.arange(len(data)) + np.repeat(np.arange(rows) * (order + 1) + order, sizes)
    wide[place] = data
    wide[np.cumsum(sizes + order + 1) - 1] = END
    own = np.ones(len(wide), bool)
    first = np.concatenate([[0], np.cumsum(sizes + order + 1)[:-1]]).astype(np.int64)
    for j in range(order):
        own[first + j] = False
    return _rolled(wide, order)[own], np.concatenate([[0], np.cumsum(sizes + 1)])


def _rolled(symbols: np.ndarray, order: int) -> np.ndarray:
    gram = symbols.copy()
    for j in range(1, order + 1):
        gram[j:] |= symbols[:-j] << (BITS * j)
    return gram


def gram_parts(texts, order: int, most: int = PART_BYTES):
    """(first row, grams, rows' bounds) of runs of texts of bounded size; a longer text comes alone, in several parts."""
    for at, raw, bounds in _chunks(texts, most):
        data = np.frombuffer(raw, np.uint8)
        if len(data) <= most or len(bounds) > 2:
            yield at, *grams_of(data, bounds, order)
            continue
        for begin in range(0, len(data), most):
            before = data[max(begin - order, 0) : begin]
            symbols = [np.full(order - len(before), START), before, data[begin : begin + most], [END] if begin + most >= len(data) else []]
            gram = _rolled(np.concatenate(symbols).astype(np.int64), order)[order:]
            yield at, gram, np.array([0, len(gram)])


def token_parts(texts, most: int = PART_BYTES):
    """(first row, keys of the words, words of each row) of runs of texts of bounded size; the end token is not among them."""
    for at, raw, bounds in _chunks(texts, most):
        keys, counts = word_keys(np.frombuffer(raw, np.uint8), bounds)
        yield at, np.where(keys == _END_WORD, np.int64(2), keys), counts


def _chunks(texts, most: int):
    """Rows of bytes in runs of bounded size: (first row, data, bounds)."""
    start, held = 0, 0
    for i in range(len(texts) + 1):
        if i == len(texts) or (held and held + len(texts[i]) > most):
            if i > start:
                some = [bytes(t) for t in texts[start:i]]
                bounds = np.zeros(len(some) + 1, np.int64)
                np.cumsum([len(t) for t in some], out=bounds[1:])
                yield start, b"".join(some), bounds
            start, held = i, 0
        if i < len(texts):
            held += len(texts[i])


def _count(keys: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sum of their weights."""
    import pandas as pd

    code, distinct = pd.factorize(np.concatenate(keys))
    return np.asarray(distinct, np.int64), np.bincount(code, np.concatenate(weights), len(distinct)).astype(np.int64)


def _distinct(keys: np.ndarray, weight: np.ndarray):
    import pandas as pd

    code, distinct = pd.factorize(keys)
    return np.asarray(distinct, np.int64), np.bincount(code, weight, len(distinct))


def _vocabulary(order: int, part_bytes: int):
    """Of a block's documents: (block, word, key, n), n counted in training documents only."""

    def run(pdf):
        import pandas as pd

        gram, word = ([], []), ([], [])
        train = pdf["train"].to_numpy()
        raw, weight = pdf["raw"].to_numpy(), train.astype(np.float64)
        for at, grams, own in gram_parts(raw, order, part_bytes):
            for one, x in zip(gram, _distinct(grams, np.repeat(weight[at : at + len(own) - 1], np.diff(own)))):
                one.append(x)
        for at, words, counts in token_parts(raw, part_bytes):
            for one, x in zip(word, _distinct(words, np.repeat(weight[at : at + len(counts)], counts))):
                one.append(x)
        (gram, gram_n), (word, word_n) = _count(*gram), _count(*word)
        word, word_n = np.append(word, _END_WORD), np.append(word_n, train.sum())
        release_memory()
        return pd.DataFrame({"block": pdf["block"].iloc[0], "word": np.repeat([False, True], [len(gram), len(word)]), "key": np.concatenate([gram, word]), "n": np.concatenate([gram_n, word_n])})

    return run


def code_lengths(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, logp): log10 of the model's probability of every gram of ``counted(gram, n)``; n is 0 for grams not in training."""

    def suffix(gram, k):  # the gram without all but its last k + 1 symbols
        return gram.bitwiseAND(F.lit((1 << (BITS * (k + 1))) - 1))

    # Counts of each level; level k holds contexts of k symbols. All grams that are asked for are rows.
    levels = [None] * (order + 1)
    levels[order] = save(counted.select("gram", "n"), f"level{order}")
    for k in range(order - 1, -1, -1):
        levels[k] = save(levels[k + 1].groupBy(suffix(F.col("gram"), k).alias("gram")).agg(F.sum("n").alias("n")), f"level{k}")
    # Of each context: t counts of d symbols, and xt counts of xd symbols that they exclude from the next shorter context.
    total = []
    for k in range(1, order + 1):
        seen = levels[k].where("n > 0").select(F.shiftright("gram", BITS).alias("ctx"), "gram", "n")
        shorter = levels[k - 1].select(F.col("gram").alias("sg"), F.col("n").alias("sn"))
        # What the symbols of this context take out of the next shorter one.
        out = seen.withColumn("sg", suffix(F.col("gram"), k - 1)).join(shorter, "sg").groupBy("ctx").agg(F.sum("n").alias("t"), F.count("*").alias("d"), F.sum("sn").alias("xt"))
        total.append(out.select("ctx", "t", "d", "xt", F.col("d").alias("xd")))
    # From the longest context down: grams whose symbol it knows are done; the rest escape with what is excluded.
    per = [None, *(save(x, f"contexts{k}") for k, x in enumerate(total, 1))]
    t0, d0 = levels[0].where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()  # the empty context is one
    ask = levels[order].select("gram", "n", F.lit(0).cast("long").alias("xt"), F.lit(0).cast("long").alias("xd"), F.lit(0.0).alias("esc"))
    done, tables = [], [*levels, *per[1:]]
    for k in range(order, -1, -1):
        last = ask.withColumns({"g": suffix(F.col("gram"), k)}).drop("n") if k < order else ask.withColumn("g", F.col("gram")).drop("n")
        here = last.withColumn("ctx", F.shiftright("g", BITS)).join(levels[k].select(F.col("gram").alias("g"), "n"), "g")
        if k:
            here = here.join(per[k].select("ctx", "t", "d", F.col("xt").alias("nxt"), F.col("xd").alias("nxd")), "ctx", "left")
        else:
            here = here.withColumns({"t": F.lit(t0).cast("long"), "d": F.lit(d0).cast("long"), "nxt": F.lit(0).cast("long"), "nxd": F.lit(0).cast("long")})
        t, d = F.coalesce("t", F.lit(0)) - F.col("xt"), F.coalesce("d", F.lit(0)) - F.col("xd")
        here = here.withColumns({"t2": t, "d2": d})
        done.append(here.where("n > 0").select("gram", (F.col("esc") + F.log10(F.col("n") / (F.col("t2") + F.col("d2")))).alias("logp")))
        more = here.where("n = 0")
        step = F.when(F.col("d2") > 0, F.log10(F.col("d2") / (F.col("t2") + F.col("d2")))).otherwise(0.0)
        ask = save(more.select("gram", F.col("n"), F.coalesce("nxt", F.lit(0)).cast("long").alias("xt"), F.coalesce("nxd", F.lit(0)).cast("long").alias("xd"), (F.col("esc") + step).alias("esc"), F.coalesce("d", F.lit(0)).alias("d0")), f"ask{k}")
        tables.append(ask)
        if k:
            ask = ask.drop("d0")
    # Below the empty context: the symbols that training never showed, equally likely.
    done.append(ask.select("gram", (F.col("esc") - F.log10(F.lit(float(SYMBOLS)) - F.col("d0"))).alias("logp")))
    out = done[0]
    for x in done[1:]:
        out = out.union(x)
    out = save(out, "code-lengths")
    forget(*tables)
    return out


def _score(order: int, n_total: int, v_total: int, part_bytes: int):
    base_of = lambda c: np.log10((c + 0.5) / (n_total + 0.5 * (v_total + 1)))

    def run(docs, vocabulary):
        import pandas as pd

        word = vocabulary["word"].to_numpy()
        key, value = vocabulary["key"].to_numpy(), vocabulary["value"].to_numpy()
        gram_at, logp = pd.Index(key[~word]), np.append(value[~word], 0.0)
        # Words of other counts than the block's own came; the rest occur in this block alone.
        train = docs["train"].to_numpy()
        own_key, own_n = [np.array([_END_WORD])], [np.array([float(train.sum())])]
        raw, weight = docs["raw"].to_numpy(), train.astype(np.float64)
        for at, words, counts in token_parts(raw, part_bytes):
            k, n = _distinct(words, np.repeat(weight[at : at + len(counts)], counts))
            own_key.append(k)
            own_n.append(n)
        own_key, own_n = _count(own_key, own_n)
        word_at, count = pd.Index(own_key), own_n.astype(np.float64)
        count[word_at.get_indexer(key[word])] = value[word]
        end_count = count[word_at.get_loc(_END_WORD)]
        n = len(docs)
        score, base, tokens, known = np.zeros(n), np.zeros(n), np.ones(n, np.int64), np.zeros(n, np.int64)
        for at, gram, own in gram_parts(raw, order, part_bytes):
            score[at : at + len(own) - 1] += np.add.reduceat(logp[gram_at.get_indexer(gram)], own[:-1])
        for at, words, counts in token_parts(raw, part_bytes):
            rows, c = len(counts), count[word_at.get_indexer(words)]
            row = np.repeat(np.arange(rows), counts)
            tokens[at : at + rows] += counts
            known[at : at + rows] = np.bincount(row, c > 0, rows).astype(np.int64) + int(end_count > 0)
            base[at : at + rows] = np.bincount(row, base_of(c), rows) + base_of(end_count)
        del gram_at, word_at
        release_memory()
        return pd.DataFrame({"doc_id": docs["doc_id"], "held_out": ~docs["train"], "n_tokens": tokens, "n_known": known, "train_tokens": n_total, "base_score": base, "score": score})

    return run


def score_documents(df: DataFrame, train, text: str = "text", key: str = "doc_id", order: int = ORDER, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row; ``train``: boolean column of the rows to learn from."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    total = df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64(F.col(key).cast("string"), F.col(text)), F.lit(blocks)).cast("int")
    docs = df.select(F.col(key).alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), raw.alias("raw"), block.alias("block"))
    seen = save(docs.groupBy("block").applyInPandas(_vocabulary(order, part_bytes), "block int, word boolean, key long, n long"), "vocabulary")
    # Words meet their total where they were dealt to: one shuffle serves the sums and the join.
    words = seen.where("word").select("block", "key", "n").repartition("key")
    totals = words.groupBy("key").agg(F.sum("n").alias("value"))
    n_total, v_total = totals.agg(F.coalesce(F.sum("value"), F.lit(0)), F.count(F.when(F.col("value") > 0, 1))).first()
    grams = seen.where("not word").groupBy(F.col("key").alias("gram")).agg(F.sum("n").alias("n"))
    lengths = code_lengths(grams, order)
    of_words = words.join(totals, "key").where("value <> n").select("block", F.lit(True).alias("word"), "key", F.col("value").cast("double").alias("value"))
    of_grams = seen.where("not word").select("block", "key").join(lengths.select(F.col("gram").alias("key"), F.col("logp").alias("value")), "key").select("block", F.lit(False).alias("word"), "key", "value")
    asked = of_words.union(of_grams)
    kind = df.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    # ``seen`` and ``lengths`` stay until the result is read, in the shared folder.
    return docs.groupBy("block").cogroup(asked.groupBy("block")).applyInPandas(_score(order, n_total, v_total, part_bytes), schema)


def adaptive_code_lengths(texts: list[bytes], order: int = ORDER) -> list[float]:
    """log10 probability of each text by a trie that starts empty and learns each symbol after coding it."""
    out = []
    for text in texts:
        trie: dict[tuple, dict] = {}
        past, score = (START,) * order, 0.0
        for symbol in [*text, END]:
            score += symbol_logp(trie, past, symbol)
            for k in range(order + 1):
                node = trie.setdefault(past[len(past) - k :], {})
                node[symbol] = node.get(symbol, 0) + 1
            past = (*past, symbol)[-order:] if order else ()
        out.append(score)
    return out


def symbol_logp(trie: dict, past: tuple, symbol: int) -> float:
    """log10 probability of ``symbol`` after ``past`` under a trie of {context: {symbol: count}}."""
    excluded, score = set(), 0.0
    for k in range(len(past), -1, -1):
        node = {s: n for s, n in trie.get(past[len(past) - k :], {}).items() if s not in excluded}
        if not node:
            continue
        t, d = sum(node.values()), len(node)
        if symbol in node:
            return score + math.log10(node[symbol] / (t + d))
        score += math.log10(d / (t + d))
        excluded |= node.keys()
    return score - math.log10(SYMBOLS - len(excluded))


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored; fold 1 of 5 is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs, crc_fold(F.col("doc_id")) != 1)
