"""Filter interaction audit by the multilinear extension (operator 11).

A document's failures are a mask of bits, one a filter. Per part, the documents are counted by mask; what follows
works on these counts alone (at most 32 a part, combined before their shuffle):

- the number of documents that a set S of filters removes is the value, at the corner 1_S, of the multilinear
  polynomial  f(x) = sum over masks m of n(m) * (1 - prod_{i in m} (1 - x_i)) = sum over sets T of c(T) * prod_{i in T} x_i
  with  c(T) = (-1)^(|T|+1) * (documents whose mask holds T);
- survivors, removals, redundancy and unique failures are differences of corner values;
- the Shapley value of filter i is the integral of df/dx_i along the diagonal, sum over T with i in T of c(T) / |T|.
  The fractions are held over the common denominator lcm(1..k), so the value times k! (its sum over all orders) is an
  exact integer.

Only ids, digests and masks are shuffled, never a text. Equal texts are found by SHA-256 and decided by an equi-join
with the least id of each repeated text, whose hot keys adaptive execution splits.

Defined results: a null text is empty; a null part is the part ``''``; a row without id is no one's copy and has no copy;
rows that repeat an id count each, and rows equal in id and text are no copies of each other; several labels of one id
count as quality 1 (toxic 1) if any of them does, labels of unknown or null ids count nothing; an empty table has no part
and no row. Only the named columns are read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial, lcm

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, save, table

#: Five word-and-character filters; the last looks at the whole table.
FILTERS = "ABCDE"
COPY = "E"


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that a text alone decides."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {"A": n < 200, "B": distinct.cast("long") * 100 < n.cast("long") * 50, "C": capitals.cast("long") * 100 > F.length(text).cast("long") * 2, "D": text.rlike(r"[#$%&*|]")}


def failure_masks(docs: DataFrame, text: str = "text", key: str = "doc_id", part: str = "source", filters: str = FILTERS) -> DataFrame:
    """One row per document: part, doc_id and mask (bit i: the i-th filter fails)."""
    alone = text_failures(F.col(text))
    bits = sum((F.when(alone[x], 1 << i).otherwise(0) for i, x in enumerate(filters) if x != COPY), F.lit(0))
    rows = docs.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(key).alias("doc_id"), F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("digest"), bits.alias("mask"))
    if COPY not in filters:
        return rows.drop("digest")
    rows = save(rows, "masks")  # both sides of the join read it, the texts are read once
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most")).where("_least < _most").select("digest", "_least")
    first = save(first, "repeated")  # a table of its own: the join is then of two shuffles, whose hot keys adaptive execution splits
    copy = F.coalesce(F.col("doc_id") > F.col("_least"), F.lit(False))
    out = rows.join(first, "digest", "left").select("part", "doc_id", (F.col("mask") + F.when(copy, 1 << filters.index(COPY)).otherwise(0)).alias("mask"))
    out._sources = [rows, first]
    return out


def mask_counts(masks: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(part, mask, n, good, toxic): documents by mask, and those labelled quality 1 and toxic 1."""
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_id")).agg(F.coalesce(F.max(F.when(F.col(quality) == 1, 1)), F.lit(0)).alias("_good"), F.coalesce(F.max(F.when(F.col(toxic) == 1, 1)), F.lit(0)).alias("_toxic"))
    rows = masks.join(known, F.col("doc_id") == F.col("_id"), "left")
    return rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.coalesce(F.sum("_good"), F.lit(0)).alias("good"), F.coalesce(F.sum("_toxic"), F.lit(0)).alias("toxic"))


def removal_polynomials(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, t, n, good, toxic): coefficients of the three removal polynomials by set ``t`` of filters (bits); the constant term is 0.

    ``covered`` counts the documents whose mask holds ``t``; with the empty set that is all of them.
    """
    held = F.filter(F.sequence(F.lit(0), F.lit((1 << len(filters)) - 1)), lambda t: t.bitwiseAND(F.bitwise_not(F.col("mask"))) == 0)
    sign = F.when(F.col("t") == 0, 0).otherwise(F.bit_count("t") % 2 * 2 - 1)
    terms = counts.select("part", "n", "good", "toxic", F.explode(held).alias("t")).groupBy("part", "t").agg(*[F.sum(v).alias(v) for v in ("n", "good", "toxic")])
    return terms.select("part", "t", F.col("n").alias("covered"), *[(F.col(v) * sign).alias(v) for v in ("n", "good", "toxic")])


def corner_values(polynomials: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part: ``total`` and ``at``, an array of structs (set, n, good, toxic) of what each set of filters removes, by the set's bits.

    The corner 1_S is the sum of the terms within S.
    """
    wider = F.filter(F.sequence(F.lit(0), F.lit((1 << len(filters)) - 1)), lambda s: s.bitwiseAND(F.col("t")) == F.col("t"))
    summed = polynomials.select("*", F.explode(wider).alias("set")).groupBy("part", "set").agg(*[F.sum(v).alias(v) for v in ("n", "good", "toxic")], F.sum(F.when(F.col("t") == 0, F.col("covered")).otherwise(0)).alias("total"))
    return summed.groupBy("part").agg(F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("set", "n", "good", "toxic"))).alias("at"))


def shapley_values(polynomials: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, shapley): by filter, the integral of the partial derivative times k!, exact: numerators over lcm(1..k), which divides k!."""
    k = len(filters)
    denominator = lcm(*range(1, k + 1))
    own = [F.sum(F.when(F.col("t").bitwiseAND(F.lit(1 << i)) != 0, F.col("n") * F.expr(f"{denominator} div bit_count(t)")).otherwise(0)) * (factorial(k) // denominator) for i in range(k)]
    return polynomials.where("t > 0").groupBy("part").agg(F.array(*own).alias("shapley"))


def _orders(filters: str) -> list[tuple]:
    """(filter_order, step, filter, set before, set after) of every step of every order."""
    out = []
    for order in permutations(range(len(filters))):
        name, before = "".join(filters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            out.append((name, step, i, before, before | 1 << i))
            before |= 1 << i
    return out


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from :func:`mask_counts`."""
    k = len(filters)
    whole = (1 << k) - 1
    terms = removal_polynomials(counts, filters)
    parts = corner_values(terms, filters).join(shapley_values(terms, filters).withColumnRenamed("part", "_part"), F.col("part") == F.col("_part"), "left")
    steps = F.expr("array(" + ",".join(f"named_struct('o','{o}','s',{s},'i',{i},'b',{b},'a',{a})" for o, s, i, b, a in _orders(filters)) + ")")
    rows = parts.select("part", "total", "at", "shapley", F.explode(steps).alias("x")).select("*", "x.*")
    at = lambda s, v: F.get("at", s)[v]
    bit = F.expr("shiftleft(1, i)")
    gone = {v: at(F.col("a"), v) - at(F.col("b"), v) for v in ("n", "good", "toxic")}
    return rows.select(
        "part",
        F.col("o").alias("filter_order"),
        F.col("s").alias("step"),
        (F.col("total") - at(F.col("a"), "n")).alias("kept"),
        gone["n"].alias("removed"),
        (at(bit, "n") - gone["n"]).alias("redundant"),
        (at(F.lit(whole), "n") - at(F.lit(whole).bitwiseXOR(bit), "n")).alias("unique_fails"),
        gone["good"].alias("good_lost"),
        gone["toxic"].alias("toxic_lost"),
        F.coalesce(F.get("shapley", F.col("i")), F.lit(0).cast("long")).alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders, per source, over all documents."""
    masks = failure_masks(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    counts = save(mask_counts(masks, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")), "mask-counts")
    forget(*masks._sources)
    return audit(counts)


OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), least AS (
  SELECT text, min(doc_id) AS least FROM words GROUP BY text
), failed AS (
  SELECT doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
    regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] AS f
  FROM words JOIN least USING (text)
), labelled AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), docs AS (
  SELECT part, f, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM failed LEFT JOIN labelled USING (doc_id)
), counted AS (
  SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM docs GROUP BY part, f
), letters AS (
  SELECT unnest([1, 2, 3, 4, 5]) AS i
), orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), steps AS (
  SELECT o, s.i AS step FROM orders, letters s
), judged AS (
  SELECT part, o, step, n, good, toxic, f[o[step]] AS fails,
    len(list_filter(o[1:step - 1], lambda x: f[x])) > 0 AS earlier,
    len(list_filter(f, lambda x: x)) AS n_fails
  FROM counted, steps
), summed AS (
  SELECT part, o, step,
    sum(CASE WHEN NOT earlier AND NOT fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT earlier AND fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN earlier AND fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT earlier AND fails THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT earlier AND fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY part, o, step
)
SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, CAST(step AS INT) AS step,
  CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley
FROM summed
"""
