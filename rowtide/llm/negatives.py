"""Hard negatives by anchor-clustered shared lists (MAXIMUS).

Anchors are grouped into clusters around directions c. For an anchor u at an
angle of at most r from c and a candidate i at the angle t from c, the score is
at most |u| |i| cos(max(0, t - r)). Candidates are ordered by that bound once per
group of anchors; all members walk the same list from its top, and a member stops
when the bound says that nothing further down can enter its result. What it
has not seen is then certified to be lower, so results are exact.

The list is kept in two levels, so that no task ever holds all candidates:
candidates lie in block files of at most ``BLOCK_ROWS`` rows of similar direction,
whose directory entries (centre, angle, longest vector) bound all their rows.
A task orders the directory by bound, loads block after block, and orders the rows
of a block by their own bound. Blocks of which no active member needs a row are
not opened, and the walk ends when no member is active.

One anchor walks twice: first for its positives (the nearest rows of its
label), then, their scores known, for the negatives of each of them.

Scale: one task per group of at most ``GROUP_ROWS`` anchors (a cluster that is
larger is cut), which reads candidates as stored, hence anchors against all rows
in blocks; nothing is shuffled per pair, and a task returns results only. The
clustering of anchors and of candidates is fitted on at most ``SAMPLE_ROWS`` rows
each, chosen by hash (it changes speed only, never a result). Broadcasts hold its
centres. The directory (one entry per block) is read from files by the tasks. A
vector space without structure makes bounds weak; the walk then visits all blocks.

Scores are integer inner products of quantized components. They are
computed in doubles where all sums stay below 2^53, else in 64-bit integers, else in
Python's integers. Components beyond 2^62 count as 2^62; scores beyond 64 bits are returned
as the nearest long, their order and the window test are exact.

Edge cases: rows with a null id, label, vector or a null or non-finite component
take no part. A repeated row is a row of its own. Vectors of different lengths are
compared as if the shorter one ended in zeros. An empty table, a label without
other rows, and an anchor without fitting rows give no result rows. Rows that
differ in nothing but their place are interchangeable in a tie.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.io import batches_of, filesystem, make_folder, scratch, settle

#: rows of a candidate block, rows of a block that are scored at once, anchors of a task, rows that centres are fitted on
BLOCK_ROWS, STEP_ROWS, GROUP_ROWS, SAMPLE_ROWS = 8_192, 1_024, 512, 4_096
#: cells that candidates are dealt by, at most
CELLS = 64

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantized(df: DataFrame, label: Column, factor: int = 256) -> DataFrame:
    """Rows that take part, as ``vec_id``, ``label`` and integer components ``q``."""
    limit = F.lit(2.0**62)
    wide = F.transform("embedding", lambda x: F.floor(F.greatest(-limit, F.least(limit, x.cast("double") * factor))))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), wide.cast("array<long>").alias("q"))


def _matrix(vectors, width: int):
    """Integer rows of one width; shorter ones end in zeros."""
    import numpy as np

    if all(len(v) == width for v in vectors):
        return np.concatenate([np.asarray(v, np.int64) for v in vectors]).reshape(-1, width) if len(vectors) else np.zeros((0, width), np.int64)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _units(m):
    """(unit vectors as floats, lengths); a zero vector stays zero."""
    import numpy as np

    f = m.astype(np.float64)
    length = np.linalg.norm(f, axis=1)
    return f / np.where(length > 0, length, 1)[:, None], length


def _centres(sample, k: int, rounds: int = 5):
    """Directions that split the sample: k-means on the unit sphere, from spread-out rows."""
    import numpy as np

    unit, length = _units(sample)
    unit = np.unique(unit[length > 0], axis=0)
    if not len(unit):
        return np.zeros((1, sample.shape[1]))
    centres = unit[np.linspace(0, len(unit) - 1, min(k, len(unit))).astype(int)]
    for _ in range(rounds):
        near = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        filled = np.linalg.norm(sums, axis=1) > 0
        centres = np.where(filled[:, None], _units(sums)[0], centres)
    return centres


def _sample(rows: DataFrame, n: int, width: int):
    """At most about ``SAMPLE_ROWS`` rows, the same ones each time, as a matrix."""
    if n > SAMPLE_ROWS:
        rows = rows.where(F.pmod(F.xxhash64("vec_id", "q"), F.lit(n)) < SAMPLE_ROWS)
    return _matrix([r.q for r in rows.select("q").limit(2 * SAMPLE_ROWS).collect()], width)


def _cell(centres, width: int):
    """A column function: the nearest centre of a vector."""
    @F.pandas_udf("int")
    def cell(q: pd.Series) -> pd.Series:
        return pd.Series((_units(_matrix(q.tolist(), width))[0] @ centres.T).argmax(axis=1).astype("int32"))

    return cell


def _write_blocks(folder: str, width: int):
    """mapInPandas: rows in the order of cells to block files and their directory entries."""
    def save(rows: pd.DataFrame) -> pd.DataFrame:
        import uuid

        import numpy as np

        q = _matrix(rows["q"].tolist(), width)
        unit, length = _units(q)
        centre = _units(unit.sum(axis=0, keepdims=True))[0][0]
        spread = np.arccos(np.clip(unit[length > 0] @ centre, -1, 1)).max(initial=0.0)
        most = int(np.abs(q).max(initial=0))
        small = q.astype(np.int16 if most < 2**15 else np.int64)
        name = f"{uuid.uuid4().hex}.block"
        system, path = filesystem(f"{folder}/{name}")
        with system.open_output_stream(path) as out:
            for part in (rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), small):
                out.write(part.tobytes())
        entry = (name, len(rows), small.itemsize, most, float(length.max(initial=0.0)), float(spread), centre.tolist())
        return pd.DataFrame([entry], columns=["name", "n", "bytes", "most", "longest", "spread", "centre"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        for batch in batches:
            for _, rows in batch.groupby("cell", sort=False):
                if waiting and (waiting[0]["cell"].iat[0] != rows["cell"].iat[0]
                                or sum(map(len, waiting)) + len(rows) > BLOCK_ROWS):
                    yield save(pd.concat(waiting))
                    waiting = []
                waiting.append(rows)
        if waiting:
            yield save(pd.concat(waiting))

    return run


def _load(folder: str, name: str, n: int, size: int, width: int):
    import numpy as np

    system, path = filesystem(f"{folder}/{name}")
    with system.open_input_stream(path) as src:
        raw = src.read()
    ids, labels = np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.int64, n, 8 * n)
    q = np.frombuffer(raw, np.int16 if size == 2 else np.int64, n * width, 16 * n).reshape(n, width)
    return ids, labels, q


def _scores(a, b, most_a: int, most_b: int):
    """Integer inner products of all rows of a with all rows of b, exact."""
    import numpy as np

    bound = most_a * most_b * max(1, a.shape[1])
    if bound < 2**53 // 101:
        return a.astype(np.float64) @ b.astype(np.float64).T
    if bound < 2**63 // 101:  # the window test multiplies by 100
        return a.astype(np.int64) @ b.astype(np.int64).T
    return a.astype(object) @ b.astype(object).T


def _exact(values):
    """Scores of any kind as Python integers."""
    import numpy as np

    return np.array([int(x) for x in values] + [None], object)[:-1]


class _Best:
    """The best ``k`` (score, id) of each of ``n`` slots: higher scores, then smaller ids."""

    def __init__(self, n: int, k: int):
        import numpy as np

        self.k = k
        self.slot, self.score, self.id = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        self.least = np.full(n, -np.inf)  # the k-th score, and its id
        self.last = np.full(n, -1, np.int64)

    def may_enter(self, slot, scores, ids):
        """Which of these scores (slots by rows) could be among the best."""
        least = self.least[slot][:, None]
        return (scores > least) | (scores == least) & (ids[None] < self.last[slot][:, None])

    def add(self, slot, score, id_) -> None:
        import numpy as np

        if not len(slot):
            return
        old = self.score if len(self.score) else score[:0]
        if old.dtype != score.dtype:
            old, score = _exact(old), _exact(score)
        slot, score, id_ = np.concatenate([self.slot, slot]), np.concatenate([old, score]), np.concatenate([self.id, id_])
        order = np.lexsort((id_, -score, slot)) if score.dtype != object else np.array(
            sorted(range(len(slot)), key=lambda i: (slot[i], -score[i], id_[i])), np.int64)
        slot, score, id_ = slot[order], score[order], id_[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot, side="left")
        full, keep = place == self.k - 1, place < self.k
        least = score[full].astype(np.float64)
        # a score that a float rounds may be above the true one: step below it and let ties in
        large = np.abs(least) >= 2**53
        self.least[slot[full]] = np.where(large, np.nextafter(least, -np.inf), least)
        self.last[slot[full]] = id_[full]
        self.slot, self.score, self.id = slot[keep], score[keep], id_[keep]


class _List:
    """The shared list of one group of anchors."""

    def __init__(self, members, directory, folder: str, width: int):
        import numpy as np

        self.folder, self.width = folder, width
        self.q, self.most = members, int(np.abs(members).max(initial=0))
        unit, self.length = _units(members)
        self.centre = _units(unit.sum(axis=0, keepdims=True))[0][0]
        angles = np.arccos(np.clip(unit[self.length > 0] @ self.centre, -1, 1))
        self.spread = angles.max(initial=0.0) + 1e-6
        centres = np.array(directory["centre"].tolist(), np.float64).reshape(len(directory), width)
        angle = np.arccos(np.clip(centres @ self.centre, -1, 1)) - directory["spread"].to_numpy() - 1e-6
        bound = self._bound(angle, directory["longest"].to_numpy())
        order = np.argsort(-bound, kind="stable")
        self.blocks = list(zip(bound[order].tolist(), directory.iloc[order][["name", "n", "bytes", "most"]].itertuples(index=False), strict=True))

    def _bound(self, angle, length):
        """Highest score of a row for an anchor of length 1, by angle from the centre."""
        import numpy as np

        return length * np.cos(np.clip(angle - self.spread, 0, np.pi)) * (1 + 1e-9) + 1e-6

    def walk(self, needs, take) -> None:
        """Hand scores to ``take(members, ids, labels, scores)`` down the list. ``needs()``
        gives the score that each member still has a use for; a member whose bound is lower is done."""
        import numpy as np

        def active(bound):
            # a bound below zero shrinks with the anchor's length instead of growing; zero is then safe
            return np.flatnonzero(max(bound, 0.0) * self.length + 1e-6 >= needs())

        for bound, (name, n, size, most) in self.blocks:
            if not len(active(bound)):
                break
            ids, labels, q = _load(self.folder, name, n, size, self.width)
            unit, length = _units(q)
            own = self._bound(np.arccos(np.clip(unit @ self.centre, -1, 1)), length)
            order = np.argsort(-own, kind="stable")
            for at in range(0, n, STEP_ROWS):
                rows = order[at:at + STEP_ROWS]
                members = active(own[rows[0]])
                if not len(members):
                    break
                take(members, ids[rows], labels[rows], _scores(self.q[members], q[rows], self.most, most))


def _mine(folder: str, width: int, directory_path: str, k: int, low: int, high: int):
    """applyInPandas: results of one group of anchors."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        import numpy as np
        import pyarrow.dataset as ds

        system, path = filesystem(directory_path)
        directory = ds.dataset(path, filesystem=system, format="parquet").to_table().to_pandas()
        group = group.sort_values("vec_id", kind="stable").reset_index(drop=True)
        ids, labels = group["vec_id"].to_numpy(np.int64), group["label"].to_numpy(np.int64)
        members = _matrix(group["q"].tolist(), width)
        shared = _List(members, directory, folder, width)
        # one more than k, since an anchor meets itself; where it does not, the best k are others anyway
        near = _Best(len(group), k + 1)

        def same(members, row_ids, row_labels, scores):
            fits = (labels[members][:, None] == row_labels[None]) & near.may_enter(members, scores, row_ids)
            m, r = np.nonzero(fits.astype(bool))
            near.add(members[m], scores[m, r], row_ids[r])

        shared.walk(lambda: near.least, same)
        itself = [sum(x * x for x in q.tolist()) for q in members]
        left_out, count, slots = set(), {}, []
        for s, score, i in zip(near.slot.tolist(), near.score.tolist(), near.id.tolist(), strict=True):
            if s not in left_out and i == ids[s] and int(score) == itself[s]:
                left_out.add(s)
            elif count.setdefault(s, 0) < k:
                count[s] += 1
                slots.append((s, int(score), i))
        if not slots:
            return pd.DataFrame(columns=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])
        # copies of a positive ask the same question: one slot for each anchor and score
        asked = sorted({(s, score) for s, score, _ in slots})
        of = np.array([s for s, _ in asked], np.int64)
        wide = any(abs(p) * 100 >= 2**53 for _, p in asked)
        p = np.array([p for _, p in asked], object if wide else np.float64)
        best = _Best(len(asked), k)
        first, last = np.searchsorted(of, np.arange(len(group))), np.searchsorted(of, np.arange(len(group)), side="right")
        # no lower score fits; below zero none does
        lowest = np.array([float(-(-low * x // high)) if x >= 0 else np.inf for _, x in asked])

        def needs():
            need = np.full(len(group), np.inf)
            np.minimum.at(need, of, np.maximum(lowest, best.least))
            return need

        def other(members, row_ids, row_labels, scores):
            differ = labels[members][:, None] != row_labels[None]
            for j in range(int((last - first).max())):
                has = first[members] + j < last[members]
                slot = np.minimum(first[members] + j, len(asked) - 1)
                score, top = scores * high, p[slot][:, None]
                fits = differ & has[:, None] & (score <= high * top) & (score >= low * top) & best.may_enter(slot, scores, row_ids)
                m, r = np.nonzero(fits.astype(bool))
                best.add(slot[m], scores[m, r], row_ids[r])

        shared.walk(needs, other)
        answers: dict[int, list] = {}
        for s, score, i in zip(best.slot.tolist(), best.score.tolist(), best.id.tolist(), strict=True):
            answers.setdefault(s, []).append((i, int(score)))
        at = {key: n for n, key in enumerate(asked)}

        def fit(x):
            return max(-(2**63), min(2**63 - 1, x))

        rows = [(int(ids[s]), i, rank, j, fit(score), fit(below)) for s, score, i in slots
                for rank, (j, below) in enumerate(answers.get(at[s, score], []), 1)]
        return pd.DataFrame(rows, columns=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return run


def hard_negatives(rows: DataFrame, is_anchor: Column, k: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """For each anchor and each of its ``k`` best rows of the same label, the best
    ``k`` rows of other labels whose score is between ``low/high`` of the positive's
    score and that score. ``rows`` has ``vec_id``, ``label``, ``q`` (see ``quantized``)."""
    spark = rows.sparkSession
    with batches_of(spark, BLOCK_ROWS):
        return _hard_negatives(spark, rows, is_anchor, k, low, high)


def _hard_negatives(spark, rows: DataFrame, is_anchor: Column, k: int, low: int, high: int) -> DataFrame:
    rows = settle(rows.select("vec_id", "label", "q", F.monotonically_increasing_id().alias("at")), "vectors")
    n, width, n_anchors = rows.agg(F.count("*"), F.coalesce(F.max(F.size("q")), F.lit(0)), F.count(F.when(is_anchor, 1))).first()
    if not n_anchors:
        return spark.createDataFrame([], RESULT)
    width = max(1, width)
    anchors = rows.where(is_anchor)

    cells = _cell(_centres(_sample(rows, n, width), min(CELLS, -(-n // BLOCK_ROWS))), width)
    parts = max(1, -(-n // (4 * BLOCK_ROWS)))
    folder, directory = scratch(spark, "blocks"), scratch(spark, "directory")
    make_folder(folder)
    dealt = rows.withColumn("cell", cells("q")).repartitionByRange(parts, "cell", F.xxhash64("at")).sortWithinPartitions("cell")
    entry = "name string, n long, bytes int, most long, longest double, spread double, centre array<double>"
    dealt.mapInPandas(_write_blocks(folder, width), entry).write.parquet(directory)

    size = max(16, min(GROUP_ROWS, -(-n_anchors // (2 * spark.sparkContext.defaultParallelism))))
    grouped = _cell(_centres(_sample(anchors, n_anchors, width), min(CELLS, -(-n_anchors // size))), width)
    anchors = settle(anchors.withColumn("cluster", grouped("q")), "anchors")
    cuts = anchors.groupBy("cluster").agg(F.ceil(F.count("*") / size).alias("cuts"))  # one row per cluster
    anchors = anchors.join(F.broadcast(cuts), "cluster").withColumn("cut", F.pmod(F.xxhash64("at"), F.col("cuts")))
    dealt = anchors.repartition(2 * -(-n_anchors // size), "cluster", "cut")
    return settle(dealt.groupBy("cluster", "cut").applyInPandas(_mine(folder, width, directory, k, low, high), RESULT), "negatives")
