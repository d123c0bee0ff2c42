import hashlib
import random

import duckdb
import pytest

from rowtide.llm import warc
from rowtide.llm.queries import ORACLES

SCHEMA = "page_id long, url string, html string, archive string, place long, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, "d") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("url, key", [
    ("http://www.a.example/x?y=1#z", "example,a)/x?y=1"), ("https://a.example:443", "example,a)/"), ("http://a.example:8080/", "example,a:8080)/"),
    (None, ")"), ("", ")"), ("no host", ")no host"), ("http://[bad", ")http://[bad")])
def test_url_key(url, key):
    assert warc.url_key(url) == key


def test_round_trip(spark):
    rng = random.Random(3)
    same, small = "é" * 60, "s" * 99
    rows = [(i, f"http://h{i % 3}.example/p{i % 5}", rng.choice([same, small, "x" * 200, "y" * rng.randint(0, 400), "", None])) for i in range(300)]
    rows += [(7, rows[7][1], rows[7][2]), (None, "http://h1.example/", same), (900, None, "z" * 50_000), (901, "a\r\nb", "long " * 50_000)]
    pages = frame(spark, rows)
    got = warc.round_trip(pages).collect()
    first = {}
    for i, _, html in rows:
        body = (html or "").encode()
        if i is not None and len(body) >= 100:
            first[body] = min(first.get(body, i), i)
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        to = first[body] if i is not None and len(body) >= 100 and first[body] != i else None
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "response" if to is None else "revisit", to))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)


def test_index_finds_captures_over_many_blocks(spark):
    pages = frame(spark, [(i, "http://one.example/", "p" * (i + 1)) for i in range(500)])
    shards = warc.build_index(warc.write(pages), block=7)
    wanted = spark.createDataFrame([("example,one)/", 3), ("example,one)/", 499), ("example,one)/", 500), ("nowhere)/", 3)], "url_key string, page_id long")
    assert sorted((r.page_id, r.payload_bytes) for r in warc.fetch(wanted, shards).collect()) == [(3, 4), (499, 500)]


def test_oracle_and_empty(spark):
    assert warc.round_trip(frame(spark, [])).collect() == []
    pages = duckdb.sql("SELECT * FROM (VALUES (1, repeat('a', 100)), (2, repeat('a', 100)), (3, NULL), (4, '')) t(page_id, html)")  # noqa: F841
    rows = duckdb.sql(ORACLES["op1_warc"].replace("FROM pages", "FROM pages")).fetchall()
    assert sorted((r[0], r[3], r[4]) for r in rows) == [(1, "response", None), (2, "revisit", 1), (3, "response", None), (4, "response", None)]
