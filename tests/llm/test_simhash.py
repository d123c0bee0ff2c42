import random
import re

import xxhash

from rowtide.llm import simhash


def brute_print(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows, radius=3):
    prints = [brute_print(t) for _, t in rows]
    distinct = sorted(set(prints))
    up = {p: p for p in distinct}

    def root(p):
        while up[p] != p:
            p = up[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if bin(a ^ b).count("1") <= radius:
                up[root(a)] = root(b)
    low = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            low[root(p)] = min(low.get(root(p), i), i)
    return sorted(((i, p, low.get(root(p))) for (i, _), p in zip(rows, prints, strict=True)), key=str)


def test_classes_equal_brute_force(spark, documents, odd_rows):
    rng = random.Random(1)
    rows = list(odd_rows)
    base = [" ".join("".join(rng.choice("abcdef") for _ in range(4)) for _ in range(60)) for _ in range(12)]
    for i in range(100, 200):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(60)] = "zz"
        rows.append((i, " ".join(words).upper() if i % 2 else " ".join(words)))
    got = simhash.near_duplicates(documents(rows)).collect()
    assert sorted(((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got), key=str) == brute_classes(rows)


def test_search_equals_brute_force_when_groups_are_dealt_again(spark):
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(60)}
    center = rng.getrandbits(64)
    for _ in range(120):
        x = center
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    found = simhash.connected(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), 3, most=40)).collect()
    root = {r.node: r.root for r in found}
    up = {p: p for p in signed}

    def top(p):
        while up[p] != p:
            p = up[p]
        return p

    for a in signed:
        for b in signed:
            if a < b and bin((a ^ b) % 2**64).count("1") <= 3:
                up[top(a)] = top(b)
    for a in signed:
        for b in signed:
            assert (top(a) == top(b)) == (root.get(a, a) == root.get(b, b))


def test_groups_that_cannot_be_dealt_again_are_searched(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(50) for _ in range(12)]  # equal in their first bits, so all meet in large groups
    prints += [p ^ sum(1 << b for b in rng.sample(range(50), 12)) for p in prints]
    up = {p: p for p in prints}

    def top(p):
        while up[p] != p:
            p = up[p]
        return p

    for a in prints:
        for b in prints:
            if bin(a ^ b).count("1") <= 14:
                up[max(top(a), top(b))] = min(top(a), top(b))
    found = simhash.connected(simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), 14, most=2)).collect()
    root = {r.node: r.root for r in found}
    assert {p: root.get(p, p) for p in prints} == {p: top(p) for p in prints}


def test_keep_one(spark, documents, odd_rows):
    docs = documents(odd_rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    classes = {}
    for i, p, c in brute_classes(odd_rows):
        classes[c] = min(classes.get(c, 10**9), 10**9 if i is None else i)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(classes.values())


def test_empty(spark, documents):
    assert simhash.near_duplicates(documents([])).collect() == []
    assert simhash.keep_one(documents([])).collect() == []
