import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from rowtide.llm import packing, token_files  # noqa: E402
from rowtide.llm.text import ChunkTokenizer  # noqa: E402

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def ids_of(path, text, end):
    from tokenizers import Tokenizer
    return np.array(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_chunks_give_the_tokenizer_s_ids(path):
    from tokenizers import Tokenizer

    rng = random.Random(8)
    parts = [",", ".", "a.", "é!", "×?", "<|", "|>", "a", "B", "é", "'s", "'", "1", " ", "  ", "\n", "\t", "\x1c", " ", "　", "!", "<|endoftext|>",
             "é", "́", "日", "'ll", "\r\n", " ", "\x85", "İ", "ß", "﻿", "​", "᠎", " ."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(6000)] + [None, "x" * 3000, ""]
    whole = Tokenizer.from_file(path)
    ids, ends = ChunkTokenizer(path, "<u2", most=500).encode(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, [0, *ends[:-1]], ends, strict=True):
        assert ids[a:b].tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_token_files_round_trip(spark, documents, odd_rows):
    listing = token_files.write(documents(odd_rows), BYTE, 0)
    got = token_files.read(listing, token_files.id_dtype(BYTE)).orderBy("start").collect()
    rows = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    base = 0
    for (i, text), r in zip(rows, got, strict=True):
        ids = ids_of(BYTE, text, 0)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, base, len(ids), zlib.crc32(ids.tobytes()))
        base += len(ids)
    assert token_files.read(token_files.write(documents([]), BYTE, 0), "<u2").collect() == []


def test_tournament_is_first_fit_decreasing():
    rng = random.Random(2)
    for _ in range(200):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(0, 40))]
        bins, free = [], []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            at = next((k for k, f in enumerate(free) if f >= sizes[i]), len(free))
            if at == len(free):
                bins.append([])
                free.append(30)
            bins[at].append(i)
            free[at] -= sizes[i]
        assert packing.first_fit_decreasing(sizes, 30) == bins


@pytest.mark.parametrize("group_docs", [1000, 3])
def test_pieces_hold_each_id_once(spark, documents, odd_rows, group_docs):
    room = 512
    rows = packing.pack(documents(odd_rows), WORD, 2, room=room, group_docs=group_docs).collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= room and (room - at <= 16 or at & (at - 1) == 0)
    want = sorted((str(i), len(ids_of(WORD, x, 2))) for i, x in odd_rows)
    texts = {}
    for i, x in odd_rows:
        texts.setdefault((i, len(ids_of(WORD, x, 2))), ids_of(WORD, x, 2))
    total = {}
    for r in rows:
        assert zlib.crc32(texts[r.doc_id, r.doc_tokens][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        total[r.doc_id, r.doc_tokens] = total.get((r.doc_id, r.doc_tokens), 0) + r.length
    copies = {}
    for key in want:
        copies[key] = copies.get(key, 0) + 1
    assert {(str(i), n): t for (i, n), t in total.items()} == {key: key[1] * c for key, c in copies.items()}
    assert packing.pack(documents([]), WORD, 2).collect() == []
