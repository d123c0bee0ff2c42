"""Uniform shuffle into shards of exact sizes, by a communication matrix.

Rows lie in sources (runs of stored rows). How many rows each source sends to
each shard is drawn first, from the distribution that a uniform permutation
of all rows would give: source after source, a multivariate hypergeometric
draw from what the shards still lack. Its row sums are the sources' sizes, its
column sums the wanted shard sizes, both exactly. Every source then permutes
its rows and cuts them by its row of the matrix, the rows are exchanged, and
every shard permutes what it got. The result is a uniform permutation: each
order of all rows is equally likely, whatever order they came in.

Scale: the only thing that reaches the driver is the list of sources, at most
``MOST_SOURCES`` of them at any input size, and the matrix over them goes back
as a broadcast of as many rows. Sources and blocks of a shard hold a stated
number of rows, more only where that bound is reached, and are ordered
by Spark's sort, which spills. A shard is never ordered in one task: its
second permutation sorts by a random key that deals it into blocks first, and
slots are block bases plus the place in the block.

Only places are permuted; the whole rows are moved once, by a join on their place.

Recovery: the rows are written once with their place; everything after is a
function of that table and the seed, so a lost executor repeats its tasks with
the same result.

Edge cases: an empty table gives no rows; with fewer rows than shards some
shards are empty; null and repeated rows are rows like others; ties of a random
key are broken by the row's place. Column names that clash with those added
(``shard``, ``slot``) are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.io import settle

#: rows of a source and of a block of a shard; more where the sources reach their bound
SOURCE_ROWS, BLOCK_ROWS, MOST_SOURCES = 4_096, 16_384, 4_096


def equal_sizes(rows: int, shards: int) -> list[int]:
    """Shard sizes at most one apart; the first ones take the rest."""
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def communication_matrix(sources: Sequence[int], shards: Sequence[int], seed: int):
    """Rows that each source sends to each shard, with exactly these margins."""
    import numpy as np

    if sum(sources) != sum(shards):
        raise ValueError("sources and shards must hold equally many rows")
    rng = np.random.default_rng(seed)
    left = np.array(shards, np.int64)
    matrix = np.zeros((len(sources), len(shards)), np.int64)
    for i, size in enumerate(sources):
        total = int(left.sum())
        for j in range(len(shards)):  # the marginals of a multivariate draw, also beyond 10^9 rows
            if size == 0:
                break
            total -= int(left[j])
            matrix[i, j] = _hypergeometric(rng, int(left[j]), total, size)
            size -= int(matrix[i, j])
        left -= matrix[i]
    return matrix


def _hypergeometric(rng, good: int, bad: int, draws: int) -> int:
    """One hypergeometric draw. The generator takes fewer than 10^9 of a kind;
    above that the draw is made by inversion: the probabilities around the mode
    follow from the ratios of neighbours, and what lies beyond 12 standard
    deviations is too rare for a float to tell it from never."""
    if good + bad == draws:
        return good
    if good < 10**9 and bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    import numpy as np

    total = good + bad
    least, most = max(0, draws - bad), min(draws, good)
    mode = min(most, max(least, (draws + 1) * (good + 1) // (total + 2)))
    spread = 50 + 12 * int((draws * (good / total) * (bad / total)) ** 0.5)
    k = np.arange(max(least, mode - spread), min(most, mode + spread), dtype=np.float64)
    steps = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    odds = np.exp(logs - logs.max()).cumsum()
    return max(least, mode - spread) + int(np.searchsorted(odds, rng.random() * odds[-1], side="right"))


def _random(seed: int, salt: str, *cols: str):
    return F.xxhash64(F.lit(f"{salt}:{seed}"), *cols)


def _dealt(rows: DataFrame, sizes: list[int], sources: int, seed: int) -> DataFrame:
    """Rows (``_part``, ``_at``, ...) with ``shard``: each source's rows in random
    order, cut by its row of the matrix."""
    spark = rows.sparkSession
    source = F.pmod(F.xxhash64("_part", F.floor(F.col("_at") / SOURCE_ROWS)), F.lit(sources)).cast("int")
    rows = rows.withColumn("_source", source)
    counted = sorted(map(tuple, rows.groupBy("_source").count().collect()))  # at most MOST_SOURCES rows
    matrix = communication_matrix([n for _, n in counted], sizes, seed)
    cuts = [(s, matrix[i].cumsum().tolist()) for i, (s, _) in enumerate(counted)]
    table = F.broadcast(spark.createDataFrame(cuts, "_source int, _cuts array<bigint>"))
    order = Window.partitionBy("_source").orderBy(_random(seed, "source", "_part", "_at"), "_part", "_at")
    ranked = rows.withColumn("_rank", F.row_number().over(order)).join(table, "_source")
    return ranked.withColumn("shard", F.size(F.filter("_cuts", lambda c: c < F.col("_rank"))).cast("int")) \
        .drop("_cuts", "_rank", "_source")


def _slotted(rows: DataFrame, blocks: int, seed: int) -> DataFrame:
    """Rows with ``slot``: each shard's rows in random order. The leading bits of
    the random key are the block, so blocks are filled evenly and stand in order."""
    key = _random(seed, "shard", "_part", "_at")
    block = F.pmod(F.shiftrightunsigned(key, 32), F.lit(blocks)).cast("int")
    rows = settle(rows.withColumn("_key", key).withColumn("_block", block), "shards")
    filled = rows.groupBy("shard", "_block").agg(F.count("*").alias("_n"))
    bases = filled.select("shard", "_block", F.coalesce(F.sum("_n").over(
        Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    order = Window.partitionBy("shard", "_block").orderBy("_key", "_part", "_at")
    return rows.withColumn("_rank", F.row_number().over(order)).join(bases, ["shard", "_block"]) \
        .select("_part", "_at", "shard", (F.col("_base") + F.col("_rank") - 1).cast("long").alias("slot"))


def shuffle(df: DataFrame, shards: int = 16, seed: int = 42) -> DataFrame:
    """All rows of ``df`` with ``shard`` (int, from 0) and ``slot`` (long, gapless
    from 0 in each shard): a uniform shuffle whose shard sizes are at most one apart."""
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    whole = settle(df.select(F.struct(*kept).alias("_row"), F.spark_partition_id().alias("_part"), place.alias("_at")), "places")
    places = whole.select("_part", "_at")
    n = places.count()
    sources = max(1, min(MOST_SOURCES, -(-n // SOURCE_ROWS)))
    blocks = max(1, -(-n // (shards * BLOCK_ROWS)))
    placed = _slotted(_dealt(places, equal_sizes(n, shards), sources, seed), blocks, seed)
    return whole.join(placed, ["_part", "_at"]).select(F.col("_row.*"), "shard", "slot")


def write_shards(df: DataFrame, path: str, shards: int = 16, seed: int = 42) -> str:
    """Write the whole rows as one folder per shard, each file in the order of its slots."""
    out = shuffle(df, shards, seed)
    out.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return path
