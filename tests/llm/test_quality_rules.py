import random
import re
from collections import Counter

import pandas as pd

from rowtide.llm import quality_rules as q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    count = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    again = {k for i in range(len(words) - 4) if count[tuple(words[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


def test_counts_equal_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choice(["a ", "b ", "c\n", "é ", "\x0b", "#", "\x85", " ", "日 "]) for _ in range(rng.randint(0, 60)))
        assert q.statistics_of(text)[:5] == brute(text)
    many = " ".join(str(rng.randrange(20000)) for _ in range(15000))
    many += " " + many[:3000]
    assert q.statistics_of(many)[:5] == brute(many)  # over 6000 distinct words


def labelled(n):
    rng = random.Random(n)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(30)]
        bad = i % 5 == 0
        rows.append((1000 + i, " ".join(w + "%%%" if bad else w for w in words)))
        labels.append((1000 + i, 0 if bad else 1))
    return rows, labels


def test_learned_list_rejects_junk_and_keeps_the_rest(spark, documents, odd_rows):
    rows, labels = labelled(200)
    docs = documents(rows + odd_rows)
    truth = spark.createDataFrame(labels + [(None, 0), (1, None), (10**6, 0)], "doc_id long, quality int")
    got = q.judge(docs, truth).collect()
    assert len(got) == len(rows) + len(odd_rows)
    bad = {i for i, y in labels if y == 0}
    for r in got:
        if r.doc_id is not None and r.doc_id >= 1000:
            assert not r.base_failed and r.kept == (r.doc_id not in bad)
        if r.doc_id in (1, 2, 3, 4):
            assert r.base_failed and not r.kept
    kept = q.keep_good(docs, truth)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)


def test_without_labels_only_the_base_decides(spark, documents):
    rows, _ = labelled(20)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.kept for r in q.judge(documents(rows), none).collect())
    assert q.judge(documents([]), none).collect() == []


def test_rules_are_conjunctions_in_order():
    rng = random.Random(9)
    rows = []
    for _ in range(600):
        a, b = rng.randrange(100), rng.randrange(100)
        rows.append({**dict.fromkeys(q.COUNTS, 0), "n_words": 100, "n_symbols": a, "n_upper": b, "bad": int(a > 50 and b > 50)})
    rules = q.learn(pd.DataFrame(rows))
    assert rules and {c.ratio for c in rules[0]} == {"symbols_per_word", "upper_share"}
