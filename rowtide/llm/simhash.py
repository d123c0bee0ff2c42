"""SimHash near-duplicates through a Gray-order hierarchical index.

A document's fingerprint has a bit set where over half of its shingle hashes
have it. Two fingerprints link when they differ in at most ``radius`` bits.

Search: of ``radius + 1`` blocks of bits at least one is equal in linked
fingerprints, so the distinct fingerprints are dealt by (block, value of the
block). A group that is still large is dealt again by blocks of the bits not
yet used, until it is small or too few bits are left, so neither volume nor a huge group of near
copies meets in one task. In each group the fingerprints are sorted by Gray
rank, in which shared leading bits stand together: a node of the index is a
run that shares a masked bit pattern, split further byte by byte. A query
descends with the differences it has gathered, and a node whose sum exceeds
the radius is dropped with all below it. Groups return a spanning forest
(at most one link a fingerprint), never their pairs; components come from
``components.connected``. The result is exact: no candidate is capped.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.components import connected
from rowtide.llm.io import bounded_batches, settle
from rowtide.llm.text import utf8

BITS = 64


def fingerprint_of(text: str | None, shingle: int) -> int:
    """Signed 64-bit fingerprint; a text without words has fingerprint 0."""
    import numpy as np
    import xxhash

    words = utf8(text).lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    k = min(shingle, len(words))
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at:at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, shingle: int, name: str = "fingerprint") -> DataFrame:
    """The frame with a long column of fingerprints of ``text``."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn(name, fingerprint("text"))


def _gray_rank(x):
    """Rank of each unsigned 64-bit number in Gray order."""
    import numpy as np

    x = x.copy()
    for by in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(by)
    return x


def _merge(root, i, j):
    """Union the members i and j in ``root`` (each points to the smallest)."""
    import numpy as np

    while True:
        while not np.array_equal(up := root[root], root):
            root[:] = up
        a, b = root[i], root[j]
        if not (apart := a != b).any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])


def _linked(fps, root, radius: int, queries: int = 256) -> None:
    """Union all of one group (unsigned, in Gray order) within the radius.

    Level by level: the nodes of a level are the runs that share its leading
    bytes; pairs (query, node) carry the differences so far.
    """
    import numpy as np

    n = len(fps)
    octets = fps[:, None] >> np.arange(56, -8, -8).astype(np.uint64) & np.uint64(255)
    octets = octets.astype(np.uint8)
    ones = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.uint8)
    parents, levels = np.zeros(1, np.int64), []  # first members of the nodes above
    fresh = np.zeros(n, bool)
    fresh[0] = True
    for depth in range(8):
        fresh[1:] |= octets[1:, depth] != octets[:-1, depth]
        nodes = np.flatnonzero(fresh)
        if len(nodes) == len(parents) and depth < 7:
            levels.append((depth, nodes, None))  # the pattern of this byte joins the node above
            continue
        low = np.searchsorted(nodes, parents)
        levels.append((depth, nodes, (low, np.append(low[1:], len(nodes)))))
        parents = nodes
    for at in range(0, n, queries):
        query = np.arange(at, min(n, at + queries))
        where, gathered = np.zeros(len(query), np.int64), np.zeros(len(query), np.uint8)
        for depth, nodes, children in levels:
            if children is not None:
                low, high = children
                many = (high - low)[where]
                query, gathered = np.repeat(query, many), np.repeat(gathered, many)
                where = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - low[where], many)
            gathered = gathered + ones[octets[query, depth] ^ octets[nodes[where], depth]]
            near = gathered <= radius
            query, where, gathered = query[near], where[near], gathered[near]
        found = levels[-1][1][where]
        _merge(root, query, found)


def _group_links(batches, radius: int):
    """Rows (grp, fp) of whole groups to spanning links (a, b)."""
    import numpy as np

    parts = [b for b in batches if len(b)]
    if not parts:
        return
    rows = pd.concat(parts, ignore_index=True)
    group, fp = rows["grp"].to_numpy(), rows["fp"].to_numpy().view(np.uint64)
    order = np.lexsort((_gray_rank(fp), group))
    group, fp = group[order], fp[order]
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    for low, high in zip(starts, np.append(starts[1:], len(group)), strict=True):
        if high - low > 1:
            root = np.arange(high - low)
            _linked(fp[low:high], root, radius)
            while not np.array_equal(up := root[root], root):
                root = up
            moved = np.flatnonzero(root != np.arange(high - low))
            if len(moved):
                yield pd.DataFrame({"a": fp[low + moved].view(np.int64), "b": fp[low + root[moved]].view(np.int64)})


def _blocks(bits: list[int], parts: int) -> list[list[int]]:
    """The bit places in ``parts`` runs of nearly equal length."""
    return [bits[len(bits) * i // parts:len(bits) * (i + 1) // parts] for i in range(parts)]


def _mask(places: list[int]) -> int:
    value = sum(1 << p for p in places)
    return value - (1 << 64) if value >> 63 else value


#: fingerprints that a task searches, groups being whole
GROUP_ROWS = 32_768


def links(fps: DataFrame, radius: int, most: int = 4096) -> DataFrame:
    """Distinct fingerprints (column ``fp``) to links (a, b) whose components
    are those of all pairs within the radius.

    ``most`` is the size over which a group is dealt again by further blocks.
    """
    level = [(list(range(BITS)), 0, fps.select(F.lit(0).cast("long").alias("grp"), "fp"))]
    found = None
    deepest = 3
    for depth in range(deepest + 1):
        step = []
        for bits, used, rows in level:
            if depth == 0 and len(bits) == BITS or len(bits) >= 4 * (radius + 1):
                for places in _blocks(bits, radius + 1):
                    rest = [p for p in bits if p not in places]
                    mask = used | (_mask(places) & (2**64 - 1))
                    signed = mask - (1 << 64) if mask >> 63 else mask
                    # the group is named by the bits that are equal in it, and which these are
                    grp = F.xxhash64(F.col("fp").bitwiseAND(F.lit(signed)), F.lit(signed))
                    step.append((rest, mask, rows.select(grp.alias("grp"), "fp")))
        if not step:
            break
        dealt = None
        for k, (_, _, rows) in enumerate(step):
            rows = rows.withColumn("via", F.lit(k))
            dealt = rows if dealt is None else dealt.union(rows)
        dealt = settle(dealt, "simhash-dealt")
        # a group that leaves too few bits to be dealt again is searched as it is
        stuck = [k for k, (rest, _, _) in enumerate(step) if len(rest) < 4 * (radius + 1)]
        large = settle(dealt.where(~F.col("via").isin(stuck)).groupBy("grp").count().where(F.col("count") > (most if depth < deepest else 2**62)).select("grp"), "simhash-large")
        small = dealt.join(large, "grp", "left_anti").select("grp", "fp")
        # by rows: few bytes are much work here
        tasks = max(1, -(-dealt.count() // GROUP_ROWS))
        here = small.repartition(tasks, "grp").mapInPandas(lambda it: _group_links(it, radius), "a long, b long")
        found = here if found is None else found.union(here)
        if not large.take(1):
            break
        # a large group is dealt again by the bits that its name does not hold
        again = settle(dealt.join(large, "grp", "left_semi"), "simhash-again")
        level = [(rest, mask, again.where(F.col("via") == k).select("grp", "fp")) for k, (rest, mask, _) in enumerate(step)]
        level = [x for x in level if x[2].take(1)]
    return found


def classes(prints: DataFrame, radius: int) -> DataFrame:
    """Rows with doc_id and fingerprint, with ``component_id`` (smallest doc_id
    of the class, null if all are) and ``root`` (its smallest fingerprint)."""
    nodes = settle(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first_doc")), "simhash-nodes")
    roots = connected(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    placed = settle(nodes.join(roots, "fp", "left").select("fp", "first_doc", F.coalesce("root", "fp").alias("root")), "simhash-placed")
    low = settle(placed.groupBy("root").agg(F.min("first_doc").alias("component_id")), "simhash-low")
    named = settle(placed.join(low, "root").select(F.col("fp").alias("fingerprint"), "component_id", "root"), "simhash-named")
    return prints.join(named, "fingerprint")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text; others ignored):
    doc_id, fingerprint (long), component_id (smallest doc_id reachable).

    A null or empty text has fingerprint 0 and links like any other; repeated
    rows stay, each with its class; a null doc_id never names a class (a class
    of only such rows has a null component_id). An empty table gives an empty
    result.
    """
    prints = settle(with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fingerprint"), "fingerprints")
    return classes(prints, radius).select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: of each class that with
    the smallest doc_id (null last, equal ones by a hash of the text), once."""
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    marked = with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fingerprint", text_hash.alias("text_hash"))
    placed = classes(settle(marked, "fingerprints"), radius)
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("s"))
    stay = settle(first.select(F.col("s.doc_id").alias("__rowtide_id"), F.col("s.text_hash").alias("__rowtide_hash")), "simhash-stay")
    own = docs.withColumn("__rowtide_hash", text_hash)
    kept = own.join(stay, own["doc_id"].eqNullSafe(stay["__rowtide_id"]) & (own["__rowtide_hash"] == stay["__rowtide_hash"]), "left_semi")
    once = Window.partitionBy("doc_id", "__rowtide_hash").orderBy("text")
    return kept.withColumn("__rowtide_n", F.row_number().over(once)).where("__rowtide_n = 1").select(*docs.columns)
