import hashlib
import random

import pytest

from rowtide.llm.substrings import deduplicate


def brute(rows, length):
    first = {}
    for i, text in rows:
        if i is not None:
            body = (text or "").encode()
            for p in range(len(body) - length + 1):
                s = body[p:p + length]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, text in rows:
        body = (text or "").encode()
        gone = bytearray(len(body))
        if i is not None:
            for p in range(len(body) - length + 1):
                if first[body[p:p + length]] < i:
                    gone[p:p + length] = b"\1" * length
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(body), sum(gone), spans, hashlib.sha256(bytes(c for c, m in zip(body, gone, strict=True) if not m)).hexdigest()))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(7)
    shared = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(30, 200))) for _ in range(12)]
    rows = []
    for i in range(200):
        parts = [rng.choice(shared)[rng.randint(0, 20):] if rng.random() < 0.6 else "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 80))) for _ in range(rng.randint(0, 6))]
        rows.append((i, "".join(parts)))
    rows += [(5, rows[5][1]), (7, "a" * 300), (8, "a" * 200), (900, "a" * 60), (901, "ab" * 100), (902, "ab" * 60), (None, rows[3][1]), (None, None),
             (903, None), (904, ""), (905, "x" * 49), (906, "x" * 50), (907, "x" * 50), (-4, shared[0])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most, block_bytes", [(20_000, 4 << 20), (3, 3000)])
def test_equals_brute_force(spark, documents, most, block_bytes):
    rows = fixture()
    got = deduplicate(documents(rows), 50, block_bytes, most).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 50)


def test_kept_bytes_and_other_length(spark, documents):
    rows = fixture()[:60]
    got = deduplicate(documents(rows), 30, keep_bytes=True).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(rows, 30)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed for r in got)


def test_odd_rows_and_empty(spark, documents, odd_rows):
    short = [(i, None if x is None else x[:3000]) for i, x in odd_rows]
    assert sorted((tuple(r) for r in deduplicate(documents(short)).collect()), key=str) == brute(short, 50)
    assert deduplicate(documents([])).collect() == []
    with pytest.raises(ValueError):
        deduplicate(documents([]), length=20)
