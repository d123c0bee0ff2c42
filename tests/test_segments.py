"""Segmented per-key windows (hot-key split) against brute force.

Segment widths from 1 s (almost every row its own segment) to one segment
for everything must give the same answer as the plain per-key definition.
"""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rowtide.operators.scd2 import as_of_join, scd2_history
from rowtide.operators.sequence import segmented_shift, with_segment

WIDTHS = (1, 7, 3600, 10 ** 9)


def _log(seed=7, n=400, keys=4):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < 0.5 else rnd.randrange(1, keys)  # key 0 is hot
        t = rnd.randrange(0, 60_000) if rnd.random() > 0.02 else None
        rows.append((k, t, i, rnd.choice("cuud"), rnd.choice(["a", "b", None])))
    return rows


@pytest.mark.parametrize("width", WIDTHS)
def test_segmented_lag_and_lead_equal_plain_windows(spark, width):
    rows = _log()
    df = spark.createDataFrame(rows, "k int, t long, pos int, op string, v string")
    seg = with_segment(df, "t", width)
    prev = segmented_shift(seg, ["k"], ["t", "pos"], ["v", "op"], "prev", "_p_")
    both = segmented_shift(prev, ["k"], ["t", "pos"], ["pos"], "next", "_n_")
    got = {r.pos: (r._p_v, r._p_op, r._n_pos) for r in both.collect()}
    want = {}
    for k in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        for i, r in enumerate(seq):
            p = seq[i - 1] if i else None
            n = seq[i + 1] if i + 1 < len(seq) else None
            want[r[2]] = (p and p[4], p and p[3], n and n[2])
    assert got == want


def _history_brute(rows):
    out = []
    for k in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))
        kept, prev = [], None
        for r in seq:
            is_del = r[3] == "d"
            prev_open = prev is not None and prev[3] != "d"
            if (is_del and prev_open) or (not is_del and (not prev_open or r[4] != prev[4])):
                kept.append(r)
            prev = r
        for i, r in enumerate(kept):
            if r[3] == "d":
                continue
            nxt = kept[i + 1][1] if i + 1 < len(kept) else None
            out.append((k, r[4], r[1], nxt))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", WIDTHS)
def test_scd2_history_is_independent_of_segment_width(spark, width):
    rows = [r for r in _log(11) if r[1] is not None]
    rows = [(k, t, pos, op, None if op == "d" else v) for k, t, pos, op, v in rows]
    df = spark.createDataFrame(rows, "k int, t long, pos int, op string, v string")
    hist = scd2_history(df, ["k"], ["v"], [F.col("t"), F.col("pos")], ts_ms="t", op="op", strict=True,
                        segment_seconds=width)
    ms = lambda x: None if x is None else round(x.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    got = sorted(((r.k, r.v, ms(r.valid_from), ms(r.valid_to)) for r in hist.collect()), key=repr)
    assert got == _history_brute(rows)


@pytest.mark.parametrize("width", (1, 3600, 86400 * 400))
def test_as_of_join_equals_range_join(spark, width):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    dims, facts = [], []
    for k in range(5):
        t = base
        for _ in range(rnd.randrange(1, 30 if k == 0 else 4)):
            start = t + dt.timedelta(seconds=rnd.randrange(0, 5000))
            end = start + dt.timedelta(seconds=rnd.randrange(1, 5000))
            dims.append((k, f"v{k}-{start:%H%M%S}", start, end if rnd.random() < 0.9 else None))
            t = end + dt.timedelta(seconds=rnd.randrange(0, 50))
            if dims[-1][3] is None:
                break
    for i in range(600):
        k = 0 if rnd.random() < 0.6 else rnd.randrange(1, 7)
        t = base + dt.timedelta(seconds=rnd.randrange(-100, 100_000)) if rnd.random() > 0.02 else None
        facts.append((i, k, t))
    dim = spark.createDataFrame(dims, "k int, attr string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    f = spark.createDataFrame(facts, "id int, fk int, at timestamp_ntz")
    got = sorted(tuple(r) for r in as_of_join(f, dim, ["fk"], ["k"], "at", ["attr"],
                                               segment_seconds=width).collect())
    want = []
    for i, k, t in facts:
        hits = [d[1] for d in dims if t is not None and d[0] == k and d[2] <= t and (d[3] is None or t < d[3])]
        assert len(hits) <= 1
        want.append((i, k, t, hits[0] if hits else None))
    assert got == sorted(want)
    inner = as_of_join(f, dim, ["fk"], ["k"], "at", ["attr"], how="inner", segment_seconds=width)
    assert inner.count() == sum(1 for w in want if w[3] is not None)
