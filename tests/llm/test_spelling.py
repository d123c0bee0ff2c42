import random
import re
import zlib
from collections import Counter

import pytest

from rowtide.llm import spelling
from rowtide.llm.queries import QUERIES
from rowtide.llm.spelling import BidirectionalIndex, suffix_ranks, variants, vocabulary


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute(words):
    out = {}
    for w, n in words.items():
        near = [v for v in words if one_apart(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = [form, w, n, len(near), None if form is None else words[form]]
    for w in out:
        while out[out[w][1]][0] is not None:
            out[w][1] = out[out[w][1]][0]
    return {(w, *v) for w, v in out.items()}


def random_words(seed, n, letters="abé", longest=9):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(5, longest))) for _ in range(n)})


def test_suffix_ranks():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 60):
        text = np.append(rng.integers(1, 3, n), 0)
        assert suffix_ranks(text).tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())


@pytest.mark.parametrize("seed", range(6))
def test_searches_find_each_near_word_once(seed):
    words = random_words(seed, 150, "ab" if seed % 2 else "abcé")
    index = BidirectionalIndex(words)
    asked = words + random_words(seed + 100, 60, "abcdxé")  # also words and letters that the index lacks
    first = list(zip(*(x.tolist() for x in index.search(asked, True)), strict=True))
    second = list(zip(*(x.tolist() for x in index.search(asked, False)), strict=True))
    assert len(set(first)) == len(first) and len(set(second)) == len(second)
    wanted = {(q, w) for q, a in enumerate(asked) for w, b in enumerate(words) if one_apart(a, b)}
    assert set(first) == {(q, w) for q, w in wanted if words[w].startswith(asked[q][:len(asked[q]) // 2])}
    assert set(second) == {(q, w) for q, w in wanted if words[w].endswith(asked[q][len(asked[q]) // 2:])}
    assert set(first) | set(second) == wanted


@pytest.mark.parametrize("small", [True, False])
def test_variants_equal_brute_force(spark, monkeypatch, small):
    if small:  # many shards; halves that span several of them; several slices
        monkeypatch.setattr(spelling, "SHARD_WORDS", 25)
        monkeypatch.setattr(spelling, "SLICE_ROWS", 40)
    rng = random.Random(5)
    words = {w: rng.choice([3, 3, 4, 6, 8, 20, 50, 200]) for w in random_words(8, 350)}
    words["b" * 3000] = 3
    words["b" * 3001] = 9
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    assert {tuple(r) for r in variants(frame).collect()} == brute(words)


def test_vocabulary_and_query(spark, documents, odd_rows, tmp_path):
    rng = random.Random(6)
    base = random_words(9, 60, "abcdé", 8)
    rows = odd_rows + [(1000 + i, " ".join(rng.choice(base).title() if rng.random() < 0.2 else rng.choice(base) for _ in range(120)) + "×Àé-x") for i in range(80)]
    rows += [(None, "Aaaaab1aaaaab aaaaab")] * 2
    words = brute_words(rows)
    docs = documents(rows)
    assert {(r.word, r.n) for r in vocabulary(docs).collect()} == set(words.items())
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op11_spelling"](spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == brute(words) != set()


def test_empty_tables(spark, documents):
    assert variants(vocabulary(documents([(1, "x")]).where("false"))).collect() == []
    assert variants(vocabulary(documents([(1, None), (2, "")]))).collect() == []
    alone = [tuple(r) for r in variants(vocabulary(documents([(1, "wörds wörds wörds")]))).collect()]
    assert alone == [(w, None, w, n, 0, None) for w, n in brute_words([(1, "wörds wörds wörds")]).items()]
