"""Each registered query of the package on the smallest given tables against its contract, row by row."""

import hashlib
import re
import struct
import zlib
from collections import Counter

import pytest
import public_tokenizers
import xxhash
from test_licenses import brute as brute_licenses
from test_pii import brute as brute_spans
from test_quality_rules import brute as brute_counts
from tokenizers import Tokenizer

from rowtide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, SF).collect()]


def test_quality_rules(spark, texts):
    got = rows(spark, "op3_quality_rules")
    assert len(got) == len(texts)
    for r in got:
        n, *_, again = want = brute_counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (n < 10 or 100 * again > 20 * n) and not (r["base_failed"] and r["kept"])


def test_toxicity(spark, texts):
    got = rows(spark, "op6_toxicity")
    assert {r["doc_id"] for r in got} == set(texts)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_licenses(spark, texts):
    got = rows(spark, "op10_licenses")
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == brute_licenses(texts[r["doc_id"]])
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_pii(spark, texts):
    got = rows(spark, "op7_pii")
    assert len(got) == len(texts)
    for r in got:
        base = brute_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        count = Counter(s.split(":")[0] for s in base.split(",") if s)
        assert {k: r[f"n_{k}"] for k in ("email", "ip", "card", "phone")} == {k: count[k] for k in ("email", "ip", "card", "phone")}
        assert set(base.split(",")) - {""} <= set(r["spans"].split(","))


def test_simhash(spark, texts):
    def fingerprint(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
        h = [xxhash.xxh64(" ".join(words[i:i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 2))] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {i: fingerprint(t) for i, t in texts.items()}
    low = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if low[j] < low[i] and (prints[i] ^ prints[j]).bit_count() <= 3:
                    low[i], changed = low[j], True
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(spark, "op9_simhash")}
    assert got == {i: (f"{p:016x}", low[i]) for i, p in prints.items()}


def _ids(texts, name, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return {i: t.encode(x, add_special_tokens=False).ids + [end] for i, x in texts.items()}


def _crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_token_files(spark, texts):
    want, start = {}, 0
    ids = _ids(texts, "byte_bpe_50k.json", 0)
    for i in sorted(texts):
        want[i] = (start, len(ids[i]), _crc(ids[i]))
        start += len(ids[i])
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows(spark, "op8_token_files")} == want


def test_packing(spark, texts):
    ids, got = _ids(texts, "word_bpe_49k.json", 2), rows(spark, "op2_packing")
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
        assert r["doc_tokens"] == len(ids[r["doc_id"]]) and r["ids_crc32"] == _crc(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]])
    for i, own in pieces.items():
        own.sort(key=lambda r: r["start"])
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert sum(r["length"] for r in own) == len(ids[i])
    assert set(pieces) == set(texts)
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert sum(r["length"] for r in own) <= 4096


def test_substrings(spark, texts):
    first = {}
    bodies = {i: t.encode() for i, t in texts.items()}
    for i in sorted(bodies):
        for k in range(len(bodies[i]) - 49):
            first.setdefault(bodies[i][k:k + 50], i)
    want = {}
    for i, b in bodies.items():
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < i:
                gone[k:k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        want[i] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(spark, "op5_substrings")}
    assert got == want


def test_decontamination(spark, texts):
    """Items that stand word by word in a document, and no others but near copies of them."""
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    words = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    plain = {i: words(t) for i, t in texts.items()}
    whole = {(i, k) for i, t in plain.items() for k, x in items.items() if words(x).strip() and words(x) in t}
    got = {(r["doc_id"], r["item_id"]): r for r in rows(spark, "op4_decontam")}
    assert whole <= set(got)
    for (i, k), r in got.items():
        runs = words(items[k]).split()
        shared = sum(f" {' '.join(runs[a:a + 5])} " in plain[i] for a in range(len(runs) - 4))
        assert r["question_overlap"] >= 0.6 and shared >= 0.3 * (len(runs) - 4)


def test_hard_negatives_and_archives_have_oracles(spark):
    from rowtide.llm.queries import ORACLES

    assert {"op1_warc", "op11_spelling", "op12_hard_negatives"} <= set(ORACLES)
    without = set(QUERIES) - set(ORACLES) - {"op13_sharding"}  # see test_sharding
    assert without == {"op2_packing", "op3_quality_rules", "op4_decontam", "op5_substrings", "op6_toxicity", "op7_pii", "op8_token_files",
                       "op9_simhash", "op10_licenses"}


@pytest.mark.parametrize("name", ["op1_warc", "op11_spelling", "op12_hard_negatives"])
def test_oracles(spark, name):
    import duckdb

    from rowtide.llm.queries import ORACLES

    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.execute(ORACLES[name])
    cols = [d[0] for d in rel.description]
    want = Counter(rel.fetchall())
    assert Counter(tuple(r[c] for c in cols) for r in rows(spark, name)) == want != Counter()
