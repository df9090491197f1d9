"""Operator 13: counts against plain Python, rules on planted and on held-out labels, and its defined results."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from readloom.llm import quality_rules as R

DOC = "doc_id long, text string"
NAMES = list(R.FEATURES)


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {}
    for w in windows:
        many[w] = many.get(w, 0) + 1
    covered = {i + j for i, w in enumerate(windows) if many[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def odd_texts():
    rng = random.Random(5)
    words = ["a", "b", "A", "ü", "日本", "#x", "<b>", "c|d", "...", "\x1c", "1"]
    out = [None, "", " \t\n\x0b\x0c\r", "a", "a b", "a b c", "a b c a b c", "x x x", "x x x x", "a\n a\na\n\n\n", "a\r\na\r\n", "\x00 \x00 \x00 \x00", "a\xa0b a\xa0b"]
    for _ in range(120):
        out.append("".join(rng.choice(words) + rng.choice([" ", " ", "\n", "\t", "  "]) for _ in range(rng.randrange(1, 90))))
    return out + ["long " * 60 + " ".join(f"w{i % 1000}" for i in range(300_000)), "one " * 400_000]


def test_counts_against_plain_python(spark):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, texts[20]), (3, texts[3])], DOC).withColumn("n_words", F.lit("clash")).withColumn("extra", F.col("doc_id"))
    got = R.statistics(df).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(r.text)
        assert r.extra == r.doc_id


def test_windows_of_very_many_words():
    """Window keys that outgrow 62 bits are renumbered, with the same result."""
    ids = np.array([0, 1, 2, 9, 0, 1, 2, 5, 1, 2, 9])
    assert R.repeated_words(ids, 10) == R.repeated_words(ids, 1 << 40) == 10


def planted(n=3000, seed=2):
    """Rows whose low quality has two causes, each a conjunction, and one label in fifty wrong."""
    rng = np.random.default_rng(seed)
    x = rng.uniform(size=(n, len(NAMES)))
    at = {name: i for i, name in enumerate(NAMES)}
    bad = ((x[:, at["symbols_per_word"]] > 0.6) & (x[:, at["mean_word"]] <= 0.5)) | ((x[:, at["capital_share"]] > 0.8) & (x[:, at["distinct_share"]] > 0.4))
    noisy = bad ^ (rng.uniform(size=n) < 0.02)
    return x, bad, noisy


def test_covering_finds_planted_conjunctions():
    x, bad, noisy = planted()
    rules = R.cover(x, noisy, np.arange(len(x)) % 3 == 2, NAMES, least_precision=0.9)
    assert 2 <= len(rules.rules) <= 8
    y, truth, _ = planted(seed=9)
    kept = rules.keeps(y, NAMES)
    assert (~kept & truth).sum() >= 0.9 * truth.sum() and (~kept & ~truth).sum() <= 0.02 * (~truth).sum()


def test_chance_labels_teach_nothing():
    rng = np.random.default_rng(4)
    x, bad = rng.uniform(size=(2000, len(NAMES))), rng.uniform(size=2000) < 0.3
    assert R.cover(x, bad, np.arange(2000) % 3 == 2, NAMES).rules == []


def test_held_out_labels(spark, sf_dir):
    """Rules learned on four folds judge the fifth, and the Spark expression says what numpy says."""
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    counted = R.statistics(docs.select("doc_id", "text")).drop("text").persist()
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    rules = R.learn(counted, labels.where(fold != 0))
    assert rules.rules and str(rules).endswith("keep")
    got = R.judge(counted, rules).join(labels, "doc_id").where((fold == 0) & ~F.col("base_failed")).select("quality", "kept").collect()
    assert len(got) > 50 and {r.quality for r in got} == {0, 1}
    assert sum(r.kept == (r.quality == 1) for r in got) >= 0.97 * len(got) and all(r.kept for r in got if r.quality == 1)
    rows = counted.select(*[F.expr(e).alias(n) for n, e in R.FEATURES.items()], rules.verdict().alias("kept")).collect()
    assert rules.keeps(np.array([r[:-1] for r in rows]), NAMES).tolist() == [r.kept for r in rows]
    counted.unpersist()


def test_query_keeps_what_the_labels_call_good(spark, sf_dir):
    from readloom.llm import queries as Q

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = Q.QUERIES["op13_quality_rules"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, chars, symbols, dups, repeats = plain(texts[r.doc_id])
        assert tuple(r)[1:6] == (n, chars, symbols, dups, repeats)
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n) and not (r.base_failed and r.kept)


def test_defined_results(spark):
    good, junk = " ".join(f"word{i}" for i in range(80)), " ".join(f"w{i}###" for i in range(80))
    docs = [(i, (good if i % 3 else junk) + f" {i}") for i in range(90)]
    df = R.statistics(spark.createDataFrame([*docs, (None, good), (None, junk), (90, None), (5, good)], DOC)).drop("text").persist()
    label = "doc_id long, quality int"
    labels = [(i, int(i % 3 > 0)) for i in range(90)] + [(None, 0), (7777, 0), (1, None), (90, 1)]
    rules = R.learn(df, spark.createDataFrame(labels + [(2, 1), (2, 1)], label))
    kept = {(r.doc_id, r.n_symbols > 0): (r.base_failed, r.kept) for r in R.judge(df.withColumn("kept", F.lit("clash")), rules).collect()}
    assert kept[None, False] == (False, True) and kept[None, True] == (False, False) and kept[90, False] == (True, False)
    assert all(v[1] != k[1] for k, v in kept.items() if not v[0])
    for none in ([], [(1, 1), (2, 1)], [(1, None)]):
        assert R.learn(df, spark.createDataFrame(none, label)).rules == []
    assert R.judge(df, R.DecisionList()).where("not base_failed and not kept").count() == 0
    few = R.learn(df, spark.createDataFrame(labels, label), most_labelled=60)
    assert sum(r.covered for r in few.rules) <= 60 and few.rules
    empty = R.statistics(spark.createDataFrame([], DOC)).drop("text")
    assert R.judge(empty, R.learn(empty, spark.createDataFrame(labels, label))).count() == 0
    df.unpersist()


def test_low_label_wins(spark):
    df = R.statistics(spark.createDataFrame([(i, " ".join(f"w{j}{'#' * (i % 2)}" for j in range(60))) for i in range(60)], DOC)).drop("text")
    labels = [(i, 1) for i in range(60)] + [(i, 0) for i in range(1, 60, 2)]
    rules = R.learn(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert len(rules.rules) == 1 and rules.rules[0].right == 30

