import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowtide.llm import negatives
from rowtide.llm.negatives import hard_negatives, quantized

SCHEMA = "vec_id long, embedding array<double>, label int, q string, cell int, cluster int, at long"


def brute(rows, k=5):
    """The contract, row by row, on (vec_id, q, label) with every row its own."""
    out = []
    rows = [(n, i, q, c) for n, (i, q, c) in enumerate(rows)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for n, i, q, c in rows:
        if i % 10:
            continue
        others = sorted((-dot(q, r), j, d) for m, j, r, d in rows if m != n)
        for s, j, d in [o for o in others if o[2] == c][:k]:
            fits = [(t, e) for t, e, d2 in others if d2 != c and 80 * -s <= 100 * -t <= 100 * -s][:k]
            out += [(i, j, rank, e, min(-s, 2**63 - 1), min(-t, 2**63 - 1)) for rank, (t, e) in enumerate(fits, 1)]
    return Counter(out)


def mined(spark, rows):
    df = spark.createDataFrame([(i, v, c, "q", 1, 2, 3) for i, v, c in rows], SCHEMA).repartition(3)
    return Counter(tuple(r) for r in hard_negatives(quantized(df, F.col("label")), F.col("vec_id") % 10 == 0).collect())


def integers(rows):
    return [(i, [int(256 * x // 1) for x in v], c) for i, v, c in rows]


@pytest.mark.parametrize("blocks", [8, 8192])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(negatives, "STEP_ROWS", max(3, blocks // 4))
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(300):
        c = rng.randrange(5)
        rows.append((i, [x + rng.gauss(0, 0.7) for x in centres[c]], c if rng.random() < 0.8 else rng.randrange(5)))
    assert mined(spark, rows) == brute(integers(rows)) != Counter()


def test_blocks_out_of_reach_are_not_opened(spark, monkeypatch, tmp_path):
    """Certified stop: of tight clusters with high windows only the near blocks are read."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    folder, opened = str(tmp_path), []
    write = negatives._write_blocks(folder, 8)
    frames = []
    for c in range(6):
        q = np.zeros((40, 8), np.int64)
        q[:, c] = 1000
        q += rng.integers(-20, 20, q.shape)
        frames.append(pd.DataFrame({"vec_id": np.arange(40) + 40 * c, "label": np.arange(40) % 2, "q": list(q), "cell": c}))
    directory = pd.concat(list(write(iter(frames))))
    assert len(directory) == 6
    load = negatives._load
    monkeypatch.setattr(negatives, "_load", lambda *a: opened.append(a[1]) or load(*a))
    directory.to_parquet(str(tmp_path / "directory"))
    got = negatives._mine(folder, 8, str(tmp_path / "directory"), 5, 80, 100)(frames[2].head(4))
    assert len(got) and set(got.negative_id) <= set(range(80, 120))
    assert len(set(opened)) == 1


def test_nulls_ties_copies_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.9, 0.5], 2), (3, [0.9, 0.5], 2), (4, [0.9, 0.5, 3.0], 2), (0, [1.0, 0.5], 1),
            (10, [0.0, 0.0], 1), (20, [], 2), (5, [-1.0, -1.0], 1), (30, [2e6, 1.0], 2), (6, [1.9e6, 1.0], 1), (7, [1.9e6, 0.0], 2), (8, [1.8e6, 0.0], 2)]
    bad = [(None, [1.0], 1), (40, None, 1), (50, [1.0, None], 1), (60, [nan], 1), (70, [inf], 1), (80, [1.0], None)]
    assert mined(spark, good + bad) == brute(integers(good)) != Counter()


def test_scores_beyond_floats_are_exact(spark):
    rows = [(i, [2.0**40 + i, float(i)], i % 3) for i in range(40)]
    assert mined(spark, rows) == brute(integers(rows)) != Counter()
    rows = [(i, [2.0**20 + i, float(i)], i % 3) for i in range(40)]
    assert mined(spark, rows) == brute(integers(rows)) != Counter()


def test_many_copies_of_one_vector(spark):
    rows = [(i, [1.0, 1.0], i % 2) for i in range(120)] + [(200 + i, [0.95, 1.0], i % 3) for i in range(60)]
    assert mined(spark, rows) == brute(integers(rows)) != Counter()


def test_empty_table_and_no_anchor(spark):
    assert mined(spark, [(1, [1.0], 1)]) == Counter()
    assert mined(spark, [(10, [1.0], 1), (11, [1.0], 2)]) == Counter()  # no positive
    assert mined(spark, [(10, [1.0], 1), (11, [1.0], 1)]) == Counter()  # no negative
    df = spark.createDataFrame([], SCHEMA)
    assert hard_negatives(quantized(df, F.col("label")), F.col("vec_id") % 10 == 0).collect() == []
