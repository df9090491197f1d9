"""Alignment quality: statistics, A tails, end sites and the good/bad split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cigar as C
from ..functions import polya as P
from ..functions import sequence as S


@dataclass(frozen=True)
class QualityLimits:
    """Least identity in percent and longest clips; ``poly_a_read_suffix`` 0 leaves the read-level tail out."""

    per_id: float = 98
    clip5: int = 20
    clip3: int = 20
    poly_a_read_suffix: int = 0

    def __post_init__(self):
        if not 0 <= self.per_id <= 100:
            raise ValueError("identity is a percentage")
        if self.clip5 < 0 or self.clip3 < 0 or self.poly_a_read_suffix < 0:
            raise ValueError("lengths cannot be negative")


#: The two passes of the tail step.
FIRST_PASS, SECOND_PASS = QualityLimits(96, 20, 50, 50), QualityLimits(98, 20, 20, 50)


def strand_of(flag, literal: bool = False):
    """- where bit 0x10 is set; ``literal`` knows the values 16 and 2064 only."""
    minus = flag.isin(16, 2064) if literal else flag.bitwiseAND(F.lit(16)) != 0
    return F.when(minus, "-").otherwise("+")


def measure(alignments: DataFrame, limits: QualityLimits = SECOND_PASS, literal: bool = True) -> DataFrame:
    """Statistics of mapped alignments: strand, per_id, clips, tails, tes, tagged name, good.

    ``literal`` takes the hard-clip flag from the CIGAR's right end whatever the strand, and the
    strand from flag values; otherwise both follow the read.
    """
    rows = alignments.where("flag <> 4").withColumns({"_cigar": C.measures(F.col("cigar")), "strand": strand_of(F.col("flag"), literal), "bare_name": S.bare_read_name(F.col("name"))})
    minus = F.col("strand") == "-"
    left, right = F.col("_cigar.left"), F.col("_cigar.right")
    hard = F.col("_cigar.hard_right") if literal else F.when(minus, F.col("_cigar.hard_left")).otherwise(F.col("_cigar.hard_right"))
    rows = rows.withColumns(
        {
            "per_id": F.try_divide(F.col("_cigar.matches").cast("double"), F.col("_cigar.aligned").cast("double")),
            "clip5": F.when(minus, right).otherwise(left),
            "_clip3": F.when(minus, left).otherwise(right),
            "hard_clip3": hard,
            "tes": F.when(minus, F.col("pos")).otherwise(F.col("pos") + F.col("_cigar.span") - 1),
            "_read": F.when(minus, S.reverse_complement(F.col("seq"))).otherwise(F.col("seq")),
        }
    )
    tail = F.when((F.col("_clip3") > 0) & ~F.col("hard_clip3"), P.tail_length(S.suffix(F.col("_read"), F.col("_clip3").cast("int")))).otherwise(0)
    rows = rows.withColumn("poly_a", tail).withColumn("clip3", F.col("_clip3") - F.col("poly_a"))
    read_tail = None
    if limits.poly_a_read_suffix:
        suffix = (F.lit(limits.poly_a_read_suffix) + F.col("_clip3")).cast("int")
        rows = rows.withColumn("poly_a_read", F.greatest(P.read_tail_length(F.col("_read"), suffix), F.col("poly_a")))
        read_tail = F.col("poly_a_read")
    rows = rows.withColumn("tagged_name", S.read_name(F.col("bare_name"), F.col("per_id"), F.col("clip5"), F.col("clip3"), F.col("poly_a"), read_tail))
    fine = (F.col("per_id") * 100 >= limits.per_id) & (F.col("clip3") <= limits.clip3)
    rows = rows.withColumns({"good_but_5prime": F.coalesce(fine, F.lit(False)), "good": F.coalesce(fine & (F.col("clip5") <= limits.clip5), F.lit(False))})
    return rows.drop("_cigar", "_clip3", "_read")


def without_categories(df: DataFrame, category: str = "category", skipped: tuple[str, ...] = ("lq",)) -> DataFrame:
    return df.where(~F.col(category).isin(*skipped))
