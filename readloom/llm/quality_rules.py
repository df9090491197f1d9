"""Quality rules: learned decision lists over text statistics (operator 13).

``statistics`` counts words, lines, characters and repeated word windows of whole texts in numpy. ``learn`` fits an ordered
list of rules by sequential covering. Each rule is a conjunction of thresholds on ratios of these counts that covers
documents of low quality: it is grown on two thirds of the labelled rows by FOIL's gain, pruned from its end to the
shortest beginning that is precise on the last third, accepted if it is precise on both, and what it covers is taken away before the next one
is grown. What no rule covers is kept. ``DecisionList.verdict`` is one Spark conditional expression, so that judging runs in
the JVM on the statistics alone.

The rules are fitted on the driver from at most ``MOST_LABELLED`` labelled rows, drawn by a hash of id and counts (all of them
if there are fewer): some 20 numbers a row, whatever the corpus holds. Everything else covers all rows and whole texts.

Defined results: a null text is empty and has no word; labels without id or quality teach nothing, several labels of one id
count as the lowest; without labels of both kinds there is no rule and the base conditions alone decide. A null id
can't be labelled, and is judged like any other. Repeated rows are judged alike; an empty table gives no row. Result columns replace
input columns of the same name, others pass through. A text of any length is split into words in pieces of a
megabyte and held as numbers from then on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _word_pieces, bounded_batches, byte_views, forget, is_space, release_memory, save, table

#: Labelled rows that the rules are fitted on, at most.
MOST_LABELLED = 20_000
#: A rule's share of low-quality rows among those it covers, on the growing and on the pruning rows, at least.
LEAST_PRECISION = 0.95
#: Rows of low quality that a rule covers in each of the two, at least, as a share of all of them, and in number.
LEAST_SHARE, LEAST_COVERED = 0.01, 2
MOST_CONDITIONS, MOST_RULES = 4, 16

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_lines", "n_capitals", "n_digits", "n_marks")
#: Ratios that rules may use, as SQL over the counts.
FEATURES = {
    "words": "cast(n_words as double)",
    "mean_word": "coalesce(try_divide(cast(word_chars as double), n_words), 0D)",
    "symbols_per_word": "coalesce(try_divide(cast(n_symbols as double), n_words), 0D)",
    "repeated_share": "coalesce(try_divide(cast(n_repeat_words as double), n_words), 0D)",
    "distinct_share": "coalesce(try_divide(cast(n_distinct_words as double), n_words), 0D)",
    "duplicate_lines": "coalesce(try_divide(cast(n_dup_lines as double), n_lines), 0D)",
    "words_per_line": "coalesce(try_divide(cast(n_words as double), n_lines), 0D)",
    "capital_share": "coalesce(try_divide(cast(n_capitals as double), word_chars), 0D)",
    "digit_share": "coalesce(try_divide(cast(n_digits as double), word_chars), 0D)",
    "marks_per_word": "coalesce(try_divide(cast(n_marks as double), n_words), 0D)",
}

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_MARKS = np.isin(np.arange(256), np.frombuffer(b"!?;:", np.uint8))


def _word_ids(data: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers of the words of one text in order of first occurrence, and how many differ."""
    known: dict[bytes, int] = {}
    out = [np.zeros(0, np.int64)]
    for piece in _word_pieces(data, 1 << 20):
        words = piece.tobytes().split()  # of bytes: exactly the six ASCII white spaces
        out.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
    return np.concatenate(out), len(known)


def repeated_words(ids: np.ndarray, distinct: int, window: int = 3) -> int:
    """Words in windows of ``window`` words that occur twice or more, each counted once."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    key = ids[:n].copy()
    size = distinct
    for j in range(1, window):
        if size > (1 << 62) // max(distinct, 1):  # numbers of the windows so far instead of their digits
            key = np.unique(key, return_inverse=True)[1]
            size = int(key.max()) + 1
        key = key * distinct + ids[j : n + j]
        size *= distinct
    order = np.sort(key)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    again = np.isin(key, twice)
    covered = np.zeros(len(ids), bool)
    for j in range(window):
        covered[j : n + j] |= again
    return int(covered.sum())


def count_text(data: np.ndarray) -> tuple[int, ...]:
    """COUNTS of one text, given as UTF-8 bytes."""
    ids, distinct = _word_ids(data)
    lines = [x for x in data.tobytes().split(b"\n") if x.strip()]
    points = int(((data & 0xC0) != 0x80).sum()) - int(is_space(data).sum())
    capitals = int(((data >= 65) & (data <= 90)).sum())
    digits = int(((data >= 48) & (data <= 57)).sum())
    return (len(ids), points, int(_SYMBOLS[data].sum()), len(lines) - len(set(lines)), repeated_words(ids, distinct), distinct, len(lines), capitals, digits, int(_MARKS[data].sum()))


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``df``, and COUNTS of its texts."""

    @F.arrow_udf(", ".join(f"{c} long" for c in COUNTS))
    def count(texts: pa.Array) -> pa.Array:
        buf, off = byte_views(texts)
        rows = [count_text(buf[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
        release_memory()
        columns = zip(*rows) if rows else [[] for _ in COUNTS]
        return pa.StructArray.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=list(COUNTS))

    rest = [c for c in df.columns if c not in COUNTS]
    counted = bounded_batches(df).select(*rest, count(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_counts"))
    return counted.select(*rest, "_counts.*")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        column = x[:, names.index(self.feature)]
        return column > self.threshold if self.above else column <= self.threshold

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    covered: int = 0
    right: int = 0

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        out = np.ones(len(x), bool)
        for c in self.conditions:
            out &= c.holds(x, names)
        return out

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out &= c.column()
        return out

    def __str__(self) -> str:
        return f"drop if {' and '.join(map(str, self.conditions))} ({self.right} of {self.covered})"


@dataclass
class DecisionList:
    """Ordered rules; the first that holds drops a document, and one that none covers is kept."""

    rules: list[Rule] = field(default_factory=list)

    def verdict(self) -> Column:
        """True for kept, as one conditional expression over COUNTS."""
        if not self.rules:
            return F.lit(True)
        out = F.when(self.rules[0].column(), False)
        for rule in self.rules[1:]:
            out = out.when(rule.column(), False)
        return out.otherwise(True)

    def keeps(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        out = np.ones(len(x), bool)
        for rule in self.rules:
            out &= ~rule.holds(x, names)
        return out

    def __str__(self) -> str:
        return "\n".join([*map(str, self.rules), "keep"])


def _best_condition(x: np.ndarray, bad: np.ndarray, names: list[str]) -> Condition | None:
    """The threshold of most FOIL gain on the rows that the rule covers so far; of ties the first by name and value."""
    p, n = int(bad.sum()), int((~bad).sum())
    if not p or not n:
        return None
    before, best, gain = np.log2(p / (p + n)), None, 1e-9
    for name, column in zip(names, x.T):
        order = np.argsort(column, kind="stable")
        v, below = column[order], np.cumsum(bad[order])
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        pl, all_l = below[cuts], cuts + 1
        for above, pos, total in ((False, pl, all_l), (True, p - pl, p + n - all_l)):
            with np.errstate(divide="ignore", invalid="ignore"):
                g = np.where(pos > 0, pos * (np.log2(pos / total) - before), -np.inf)
            i = int(g.argmax())
            if g[i] > gain:
                gain, best = float(g[i]), Condition(name, above, float((v[cuts[i]] + v[cuts[i] + 1]) / 2))
    return best


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str]) -> tuple[Condition, ...]:
    inside, out = np.ones(len(x), bool), []
    while len(out) < MOST_CONDITIONS and (found := _best_condition(x[inside], bad[inside], names)):
        out.append(found)
        inside &= found.holds(x, names)
    return tuple(out)


def _prune(conditions: tuple[Condition, ...], x: np.ndarray, bad: np.ndarray, names: list[str], least_precision: float) -> tuple[Condition, ...]:
    """The shortest beginning of the conjunction that is precise enough on the pruning rows; if none is, the one of best (p - n) / (p + n)."""

    def worth(k: int) -> tuple[bool, float, int]:
        inside = Rule(conditions[:k]).holds(x, names)
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        precise = p > 0 and p >= least_precision * (p + n)
        return (precise, 0.0 if precise else (p - n) / max(p + n, 1), -k)

    return conditions[: max(range(1, len(conditions) + 1), key=worth)]


def cover(x: np.ndarray, bad: np.ndarray, pruning: np.ndarray, names: list[str], least_precision: float = LEAST_PRECISION) -> DecisionList:
    """Sequential covering of the rows ``bad``; rules grow on rows outside ``pruning`` and are pruned on those inside."""
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    least = [max(LEAST_COVERED, LEAST_SHARE * int((bad & side).sum())) for side in (~pruning, pruning)]
    while len(rules) < MOST_RULES:
        grow, prune = left & ~pruning, left & pruning
        conditions = _grow(x[grow], bad[grow], names)
        if not conditions:
            break
        rule = Rule(_prune(conditions, x[prune], bad[prune], names, least_precision))
        inside = rule.holds(x, names)
        good = True
        for side, at_least in zip((grow, prune), least):
            covered, right = int((inside & side).sum()), int((inside & side & bad).sum())
            good &= right >= at_least and right >= least_precision * covered
        if not good:
            break
        rules.append(Rule(rule.conditions, int((inside & left).sum()), int((inside & left & bad).sum())))
        left &= ~inside
    return DecisionList(rules)


def learn(counted: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality", most_labelled: int = MOST_LABELLED) -> DecisionList:
    """A decision list from the labelled rows of ``counted`` (key and COUNTS) that pass the base conditions."""
    known = labels.where(F.col(key).isNotNull() & F.col(quality).isNotNull()).groupBy(F.col(key).alias("_id")).agg(F.min(quality).alias("_quality"))
    rows = counted.where(~base_failed()).join(known, F.col(key) == F.col("_id"))
    draw = F.xxhash64(F.col("_id").cast("string"), *COUNTS)
    rows = rows.select("_id", draw.alias("_draw"), (F.col("_quality") == 0).alias("_bad"), *[F.expr(e).alias(f"_f_{n}") for n, e in FEATURES.items()])
    n = rows.count()
    # Twice the wanted share first, so that no more than that is sorted anywhere; then exactly as many, in the hash's order.
    rows = rows.where(F.pmod("_draw", F.lit(1 << 20)) < (1 << 20) * min(1.0, 2 * most_labelled / max(n, 1))).orderBy(F.pmod("_draw", F.lit(1 << 20)), "_draw", "_id").limit(most_labelled)
    got = rows.toArrow().to_pydict()
    names = list(FEATURES)
    x = np.array([got[f"_f_{n}"] for n in names], float).T.reshape(-1, len(names))
    bad = np.array(got["_bad"], bool)
    if not bad.any() or bad.all():
        return DecisionList()
    place = np.where(bad, np.cumsum(bad), np.cumsum(~bad))  # each kind is dealt in thirds
    return cover(x, bad, place % 3 == 0, names)


def judge(counted: DataFrame, rules: DecisionList) -> DataFrame:
    """All columns of ``counted`` with base_failed and kept."""
    rest = [c for c in counted.columns if c not in ("base_failed", "kept")]
    return counted.select(*rest, base_failed().alias("base_failed"), (~base_failed() & rules.verdict()).alias("kept"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, and whether it is kept by the base conditions and the rules learned from the labels."""
    counted = save(statistics(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"), "counts")
    rules = learn(counted, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    out = save(judge(counted, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"), "judged")
    forget(counted)
    return out
