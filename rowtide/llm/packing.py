"""Packing of documents into training sequences, first-fit decreasing.

Documents are dealt at random to groups of bounded size. A document longer
than a sequence gives whole sequences and a rest; in each group the rests go,
longest first, into the first sequence with room, which a tournament tree of
the free room finds in logarithmic time. What stays in sequences with much
room left is then laid end to end and cut to full sequences, the last one
into powers of two, so a group wastes next to nothing.
"""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.io import bounded_batches
from rowtide.llm.text import ChunkTokenizer
from rowtide.llm.token_files import id_dtype

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Tournament:
    """Free room of bins; ``first(size)`` is the leftmost bin with that much."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [room] * (2 * self.leaves)

    def first(self, size: int) -> int:
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < size:
                node += 1
        return node - self.leaves

    def take(self, bin_: int, size: int) -> None:
        best, node = self.best, bin_ + self.leaves
        best[node] -= size
        while node > 1:
            node //= 2
            best[node] = max(best[2 * node], best[2 * node + 1])


def first_fit_decreasing(sizes: list[int], room: int) -> list[list[int]]:
    """Bins of item places; items in falling size, ties in their given order."""
    tree, bins = Tournament(max(1, len(sizes)), room), []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.first(sizes[item])
        while len(bins) <= at:
            bins.append([])
        bins[at].append(item)
        tree.take(at, sizes[item])
    return bins


def lay_out(sizes: list[int], room: int, spare: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (item, from, to): first-fit decreasing, then the
    sequences with over ``spare`` room left are cut anew without waste."""
    sequences, loose = [], []
    for items in first_fit_decreasing(sizes, room):
        used = sum(sizes[i] for i in items)
        if room - used <= spare or used & (used - 1) == 0:
            sequences.append([(i, 0, sizes[i]) for i in items])
        else:
            loose.extend(items)
    left = sum(sizes[i] for i in loose)
    targets = [room] * (left // room) + [1 << b for b in range(room.bit_length(), -1, -1) if (left % room) >> b & 1]
    now, free = [], iter(targets)
    want = next(free, 0)
    for i in loose:
        at = 0
        while at < sizes[i]:
            end = min(sizes[i], at + want)
            now.append((i, at, end))
            want -= end - at
            at = end
            if not want:
                sequences.append(now)
                now, want = [], next(free, 0)
    return sequences


def pack(docs: DataFrame, tokenizer: str, end_id: int, room: int = 4096, group_docs: int = 1000, spare: int = 16) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text; others ignored), as in ``PIECE``.

    ``room`` is the longest sequence, ``group_docs`` the mean size of a group,
    ``spare`` the most room that first-fit may leave. A null or empty text is
    its end id alone. Repeated rows and null ids are documents of their own.
    An empty table gives no piece.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    dtype = id_dtype(tokenizer)
    groups = max(1, -(-docs.count() // group_docs))

    def tokenize(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encoder, seen = ChunkTokenizer(tokenizer, dtype), 0
        task = TaskContext.get().partitionId()
        for batch in batches:
            ids, ends = encoder.encode(batch.column("text"))
            ids = np.insert(ids, ends, np.array(end_id, dtype))
            ends = ends + np.arange(1, len(ends) + 1)
            out: dict = {"grp": [], "doc_tokens": [], "whole": [], "rest": []}
            low = 0
            for doc, high in zip(batch.column("doc_id").to_pylist(), ends.tolist(), strict=True):
                cut = high - (high - low) % room
                # the place in the task tells copies of a row apart; a rerun of the task reads the same rows
                out["grp"].append(zlib.crc32(f"{doc}/{task}/{seen}".encode()) % groups)
                out["doc_tokens"].append(high - low)
                out["whole"].append([zlib.crc32(ids[a:a + room].astype("<u4").tobytes()) for a in range(low, cut, room)])
                out["rest"].append(ids[cut:high].tobytes())
                low, seen = high, seen + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(out["grp"], pa.int64()), pa.array(out["doc_tokens"], pa.int64()), pa.array(out["whole"], pa.list_(pa.int64())), pa.array(out["rest"], pa.binary())],
                names=["doc_id", "grp", "doc_tokens", "whole", "rest"])

    def place(key, rows: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        rows = rows.sort_values(["doc_tokens", "doc_id"], kind="stable").reset_index(drop=True)
        base, out = int(key[0]) << 32, []
        doc_ids = [None if pd.isna(d) else int(d) for d in rows["doc_id"]]
        sizes = rows["doc_tokens"].tolist()
        for doc, size, whole in zip(doc_ids, sizes, rows["whole"], strict=True):
            for k, crc in enumerate(whole):
                out.append((doc, k * room, room, int(crc), size, base, 0))
                base += 1
        rests = [np.frombuffer(r, dtype) for r in rows["rest"]]
        items = [i for i, r in enumerate(rests) if len(r)]
        for pieces in lay_out([len(rests[i]) for i in items], room, spare):
            offset = 0
            for item, a, b in pieces:
                i = items[item]
                crc = zlib.crc32(rests[i][a:b].astype("<u4").tobytes())
                out.append((doc_ids[i], sizes[i] - len(rests[i]) + a, b - a, crc, sizes[i], base, offset))
                offset += b - a
            base += 1
        made = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        return made.astype({"doc_id": "Int64"})

    ready = docs.select("doc_id", "text").mapInArrow(tokenize, "doc_id long, grp long, doc_tokens long, whole array<long>, rest binary")
    return ready.groupBy("grp").applyInPandas(place, PIECE)
