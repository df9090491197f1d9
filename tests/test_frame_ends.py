"""Frames against projections, whole columns at a time; and the derived tables' one shuffle."""

import contextlib
import io
import random
import re

from readloom.operators import overrules
from readloom.plans import queries as Q


def fits(strand, start, stop, lens, starts, stops, begin, end, permitted):
    """The rule row by row."""
    if None in (start, stop, lens, starts, stops, begin, end):
        return False
    minus, spans = strand == "-", [(start + s, start + s + n) for s, n in zip(starts, lens)]
    pos, entry = (end, end) if minus else (begin + 1, begin)
    if not (start <= pos <= stop and any(a <= pos <= b for a, b in spans)):
        return False
    k = next((i for i, (_, b) in enumerate(spans) if b >= entry), None)
    if k is None or entry < spans[k][0]:
        return False
    first = sum(lens[:k]) + entry - spans[k][0]
    first = sum(lens) - first if minus else first
    frame = [x for x in stops if x >= first >= 0 and (x - first) % 3 == 0]
    known = permitted is not None
    other = [x for x in (frame[1:] if minus else frame) if known and x != permitted]
    at = next(iter(other[0 if minus else 1 :]), frame[-1] if frame else None)
    if at is None:
        return False
    at, before = sum(lens) - at if minus else at, 0
    for (a, _), n in zip(spans, lens):
        if at - before <= n:
            edge = a + at - before
            return edge - 3 == begin if minus else edge + 3 == end
        before += n
    return False


def _row(rng):
    lens = [rng.randint(1, 12) for _ in range(rng.randint(1, 4))]
    starts, at = [], 0
    for n in lens:
        starts.append(at)
        at += n + rng.randint(0, 5)
    start, strand = rng.randint(0, 50), rng.choice("+-")
    stops = sorted(rng.sample(range(sum(lens) + 4), rng.randint(0, min(9, sum(lens)))))
    row = [strand, start, start + starts[-1] + lens[-1], lens, starts, stops, start + rng.randint(-1, at // 2), start + rng.randint(at // 2, at + 1), rng.choice([-1, None, *stops])]
    if rng.random() < 0.1:
        row[rng.randint(0, 7)] = None
    # Three times of four the end is one at which some frame ends.
    for shift in rng.sample(range(-2, at + 4), at + 4) if rng.random() < 0.75 and None not in row[1:8] else []:
        moved = list(row)
        moved[6 if strand == "-" else 7] = start + shift
        if fits(*moved):
            return tuple(moved)
    return tuple(row)


def test_frames_end_is_the_rule_row_by_row(spark):
    rng = random.Random(3)
    rows = [(i, *_row(rng)) for i in range(3000)] + [(3000, "+", 0, 9, [], [], [], 0, 9, -1)]
    names = "id long, strand string, start long, stop long, block_lens array<long>, block_starts array<long>, stops array<int>, toga_start long, toga_stop long, permitted long"
    df = spark.createDataFrame(rows, names)
    want = {r[0]: fits(*r[1:]) for r in rows}
    got = {r.id: r.compatible for r in overrules.compatible(df, "permitted").collect()}
    assert got == want and 300 < sum(want.values()) < 2700
    plain = {r.id: r.compatible for r in overrules.compatible(df).collect()}
    assert plain == {r[0]: fits(*r[1:-1], -1) for r in rows}


def _shuffles(df):
    with contextlib.redirect_stdout(io.StringIO()) as said:
        df.explain()
    return set(re.findall(r"Exchange hashpartitioning\(([^#,)]+)", said.getvalue()))


def test_projections_meet_without_another_shuffle(spark, sf_dir):
    """Transcripts and projections come from one shuffle by name, and frames are judged without a lambda a row."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("compatible_projections", "overrule_candidates", "overrule_all_masked"):
            df = Q.QUERIES[name](spark, sf_dir)
            # Rows that Python returned are dealt again: stop codons by _id, judged projections by canonical_id.
            assert "name" in _shuffles(df) <= {"name", "_id", "canonical_id"}
            with contextlib.redirect_stdout(io.StringIO()) as said:
                df.explain()
            assert "exists(" not in said.getvalue()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
