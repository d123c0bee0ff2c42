import zlib
from collections import Counter

import numpy as np
import pytest

from rowtide.llm import sharding
from rowtide.llm.queries import QUERIES
from rowtide.llm.sharding import _hypergeometric, communication_matrix, equal_sizes, shuffle, write_shards


def test_matrix_has_exact_margins():
    sources, shards = [7, 0, 12, 1, 30], equal_sizes(50, 16)
    for seed in range(50):
        m = communication_matrix(sources, shards, seed)
        assert m.sum(axis=1).tolist() == sources
        assert m.sum(axis=0).tolist() == shards
        assert (m >= 0).all()


def test_matrix_follows_a_uniform_permutation():
    """Counts of the first cell against brute-force permutations of the rows."""
    sources, shards, runs = [4, 3, 3], [5, 3, 2], 6000
    drawn = Counter(tuple(communication_matrix(sources, shards, s)[:, 0].tolist()) for s in range(runs))
    rng = np.random.default_rng(1)
    owner = np.repeat([0, 1, 2], sources)
    brute = Counter(tuple(np.bincount(rng.permutation(owner)[:5], minlength=3).tolist()) for _ in range(runs))
    for cell in set(drawn) | set(brute):
        assert abs(drawn[cell] - brute[cell]) < 6 * (drawn[cell] + brute[cell] + 1) ** 0.5


def test_large_populations_are_drawn_by_inversion():
    rng = np.random.default_rng(2)
    got = np.array([_hypergeometric(rng, 2 * 10**9, 30 * 10**9, 10_000) for _ in range(3000)])
    p = 2 / 32
    assert abs(got.mean() - 10_000 * p) < 5 * (10_000 * p * (1 - p) / 3000) ** 0.5
    assert 0.9 < got.std() / (10_000 * p * (1 - p)) ** 0.5 < 1.1
    assert _hypergeometric(rng, 2 * 10**9, 0, 5) == 5


def _check(rows, shards):
    n = len(rows)
    sizes = Counter(r.shard for r in rows)
    assert [sizes[i] for i in range(shards)] == equal_sizes(n, shards)
    for i in range(shards):
        assert sorted(r.slot for r in rows if r.shard == i) == list(range(sizes[i]))


@pytest.mark.parametrize("small", [False, True])
def test_every_row_once_and_sizes_exact(spark, documents, odd_rows, monkeypatch, small):
    if small:  # many sources, several blocks of a shard
        monkeypatch.setattr(sharding, "SOURCE_ROWS", 3)
        monkeypatch.setattr(sharding, "BLOCK_ROWS", 2)
    rows = odd_rows + [(100 + i, "same") for i in range(150)]
    docs = documents(rows, parts=5).withColumnsRenamed({"grp": "slot", "block": "shard", "key": "_part", "owner": "_at"})
    out = shuffle(docs, shards=16, seed=3)
    assert set(out.columns) == set(docs.columns)
    found = out.collect()
    _check(found, 16)
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    assert [tuple(r) for r in shuffle(docs, 16, 3).collect()] != [] and {r["_part"] for r in found} == {"k"}


def test_empty_and_tiny_tables(documents):
    assert shuffle(documents([(1, "x")]).where("false")).collect() == []
    one = shuffle(documents([(1, "x"), (2, None)], parts=1)).collect()
    assert sorted((r.shard, r.slot) for r in one) == [(0, 0), (1, 0)]


def test_places_are_uniform(spark):
    """Each row is equally likely in each shard, and neighbours do not stay together."""
    docs = spark.range(24, numPartitions=3).toDF("doc_id")
    hits, pairs, runs = np.zeros((24, 4)), 0, 12
    for seed in range(runs):
        at = {r.doc_id: r.shard for r in shuffle(docs, 4, seed).collect()}
        for d, s in at.items():
            hits[d, s] += 1
        pairs += sum(at[d] == at[d + 1] for d in range(23))
    assert ((hits - runs / 4) ** 2 / (runs / 4)).sum() < 130  # chi-square, 72 degrees of freedom
    assert abs(pairs / runs - 23 * 5 / 23) < 2.5


def test_shard_files_hold_the_slots_in_order(spark, documents, tmp_path):
    path = write_shards(documents([(i, f"text {i}") for i in range(90)]), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(path)
    _check(back.collect(), 4)
    assert sorted(r.text for r in back.collect()) == sorted(f"text {i}" for i in range(90))


def test_query_returns_sizes_and_checksums(spark, documents, odd_rows, tmp_path):
    documents(odd_rows).write.parquet(str(tmp_path / "documents.parquet"))
    rows = QUERIES["op13_sharding"](spark, str(tmp_path)).collect()
    body = [(i, (t or "").encode()) for i, t in odd_rows]
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter((i, len(b) + 1, zlib.crc32(b)) for i, b in body)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    _check(rows, 16)
