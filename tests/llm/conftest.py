import random

import pytest

CLASH = "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string, grp long, block long, kept boolean, owner long, key string"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) as a frame with extra columns whose names clash with the operators' own."""
    def make(rows, parts=3):
        full = [(i, t, "en", "s", None if t is None else len(t), 0.5, "x", 1, 2, True, 3, "k") for i, t in rows]
        return spark.createDataFrame(full, CLASH).repartition(parts)
    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    long_text = " ".join(word() for _ in range(6000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "one two three"), (6, "one two three"), (6, "one two three"), (None, "one two three"),
            (None, None), (7, long_text), (8, long_text), (9, long_text + " tail"), (10, "😀 ü\x00 x"), (11, "x" * 5000)]
