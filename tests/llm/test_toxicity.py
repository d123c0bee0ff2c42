import random

import numpy as np

from rowtide.llm import toxicity as t


def brute_segments(scores):
    """Ruzzo and Tompa's definition: the best segment, then left and right of it."""
    if not len(scores):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores)))
    best = max(((total[b] - total[a], -(b - a), -a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)))
    if best[0] <= 0:
        return []
    a, n = -int(best[2]), -int(best[1])
    left, right = brute_segments(scores[:a]), brute_segments(scores[a + n:])
    return left + [(a, a + n)] + [(x + a + n, y + a + n) for x, y in right]


def test_segments_are_the_maximal_ones():
    rng = random.Random(5)
    for _ in range(400):
        scores = np.array([rng.uniform(-1, 1) for _ in range(rng.randint(0, 14))])
        assert [(a, b) for a, b, _ in t.segments(scores)] == brute_segments(scores)


def corpus(n):
    rng = random.Random(n)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    rude = ["scum", "morons", "idiotic", "trashy"]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(80)]
        if i % 6 == 0:
            at = rng.randrange(60)
            for k in range(4):
                words[at + 3 * k] = rng.choice(rude)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 6 == 0)))
    return rows, labels


def test_held_out_accuracy(spark, documents, odd_rows):
    rows, labels = corpus(900)
    docs = documents(rows + [(None if i is None else i + 10000, x) for i, x in odd_rows])
    truth = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = t.score(docs, t.fit(docs, truth)).collect()
    assert len(got) == len(rows) + len(odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert len({r.score for r in got if r.doc_id in (10001, 10002, 10003)}) == 1  # texts without tokens
    import zlib
    held = [r for r in got if r.doc_id is not None and r.doc_id < 10000 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    right = sum(r.predicted == int(r.doc_id % 6 == 0) for r in held)
    assert len(held) > 150 and right / len(held) > 0.97


def test_one_class_and_empty(spark, documents):
    rows, labels = corpus(60)
    one = spark.createDataFrame([(i, 0) for i, _ in labels], "doc_id long, toxic int")
    assert {r.predicted for r in t.score(documents(rows), t.fit(documents(rows), one)).collect()} == {0}
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert t.score(documents([]), t.fit(documents([]), none)).collect() == []
