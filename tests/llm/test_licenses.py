import random
import re

from rowtide.llm.licenses import LOWER, NOTICES, PHRASES, UPPER, scan


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(UPPER, LOWER)))
    at, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k:k + len(p)] == p:
                at.append(k)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_equals_brute_force(spark, documents, odd_rows):
    rng = random.Random(4)
    bits = ["Under the MIT License", "apache license, VERSION 2", "cc-by-nc", "mit", "under the", "İ", "é1", "license", "the", "\n", "by nc", "cc"]
    rows = [(100 + i, " ".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(150)] + odd_rows
    got = scan(documents(rows)).collect()
    assert len(got) == len(rows)
    want = sorted((i, *brute(x)) for i, x in rows if i is not None)
    assert sorted(tuple(r)[:6] for r in got if r.doc_id is not None) == want
    assert all(0 <= r.score <= 1 for r in got)


def test_notices_add_labels_and_bear_small_changes(spark, documents):
    gpl = dict((label, text) for text, label in NOTICES)["gpl-3"]
    bsd = dict((label, text) for text, label in NOTICES)["bsd"].split()
    changed = " ".join(bsd[:5] + ["also"] + bsd[5:])
    got = {r.doc_id: r for r in scan(documents([(1, "So: " + gpl.upper()), (2, changed), (3, "version 3 of the work"), (4, "Released under the MIT License.")])).collect()}
    assert (got[1].labels, got[1].base_labels) == ("gpl-3", "") and got[2].labels == "bsd" and 0.6 <= got[2].score < 1
    assert (got[3].labels, got[3].score) == ("", 0.0) and (got[4].labels, got[4].base_labels, got[4].score) == ("mit", "mit", 1.0)


def test_empty(spark, documents):
    assert scan(documents([])).collect() == []
