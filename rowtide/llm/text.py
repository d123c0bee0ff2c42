"""Text helpers that run inside tasks."""

from __future__ import annotations

import sys
import types

#: ASCII white space, as in the contracts' word pattern ``[^\x20\x09-\x0D]+``.
#: ``bytes.split()`` splits on exactly these six characters.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

def utf8(text: str | None) -> bytes:
    """UTF-8 bytes; null is the empty text."""
    return (text or "").encode("utf-8", "surrogatepass")


def _process_cache() -> dict:
    """A dictionary that lives as long as the Python worker, across tasks."""
    name = "_rowtide_llm_cache"
    module = sys.modules.setdefault(name, types.ModuleType(name))
    if not hasattr(module, "entries"):
        module.entries = {}
    return module.entries


def _chunk_starts(data, starts):
    """Where chunks begin in a buffer of UTF-8 texts that begin at ``starts``.

    A chunk is white space plus what follows up to the next white space or
    punctuation; a cut is made in front of an ASCII white space whose
    predecessor is surely none, and between a letter and a punctuation mark.
    """
    import numpy as np

    white = (data == 32) | ((data >= 9) & (data <= 13))
    last = np.empty(len(data), np.uint8)
    last[:1], last[1:] = 32, data[:-1]
    # the last byte of U+0085, U+00A0, U+1680, U+2000.., U+2028.., U+202F, U+205F, U+3000
    odd = np.flatnonzero(white & (last >= 0x80) & (last <= 0xAF))
    cut = white
    cut[1:] &= ~((last[1:] == 32) | ((last[1:] >= 9) & (last[1:] <= 13)))
    cut[:1] = False
    for lead, before in ((0xC2, 2), (0xE1, 3), (0xE2, 3), (0xE3, 3)):
        at = odd[odd >= before]
        cut[at[data[at - before] == lead]] = False
    # between a letter (ASCII or U+00C0-U+00FF) and one of these marks the tokenizers always cut too
    mark = np.zeros(256, bool)
    mark[list(b'!"#$%&()*,.:;?')] = True
    letter = np.zeros(256, bool)
    letter[65:91] = letter[97:123] = True
    at = np.flatnonzero(mark[data])
    at = at[at > 1]
    before = data[at - 1]
    high = (data[at - 2] == 0xC3) & (before >= 0x80) & (before <= 0xBF) & (before != 0x97) & (before != 0xB7)
    cut[at[letter[before] | high]] = True
    cut[starts[starts < len(data)]] = True
    return np.flatnonzero(cut)


class ChunkTokenizer:
    """Token ids of whole texts, through a cache of their chunks.

    The tokenizers used here never let a token span from a non-space to a
    space or from a letter to a punctuation mark, so the ids of a text are the
    ids of its chunks, one after the other. Natural words repeat: chunks
    are told apart with Arrow, and most are found in the cache, which holds
    ``most`` chunks and starts again when full; that changes time only.
    """

    def __init__(self, path: str, dtype, most: int = 1_000_000, longest: int = 48):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        shared = _process_cache().setdefault(("tokenizer", path), {})
        if "tokenizer" not in shared:
            shared["tokenizer"] = Tokenizer.from_file(path)
        self.tokenizer = shared["tokenizer"]
        # a tokenizer that drops white space takes many chunks as the lines of one text
        self.drops_space = not self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.ids = shared.setdefault(str(dtype), {})
        self.dtype, self.most, self.longest = dtype, most, longest

    def _encode_new(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks; the short ones go into the cache too."""
        import numpy as np

        found = {}
        for at in range(0, len(chunks), 8192):
            part = chunks[at:at + 8192]
            if self.drops_space:
                encoding = self.tokenizer.encode("\n".join(part), add_special_tokens=False)
                ids = np.array(encoding.ids, self.dtype)
                lines = np.cumsum([0] + [len(c) + 1 for c in part])
                cuts = np.searchsorted(np.array([a for a, _ in encoding.offsets], np.int64), lines).tolist()
                found.update((c, ids[a:b].tobytes()) for c, a, b in zip(part, cuts, cuts[1:], strict=False))
                continue
            for c, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                found[c] = np.array(e.ids, self.dtype).tobytes()
        if len(self.ids) + len(found) > self.most:
            self.ids.clear()
        self.ids.update((c, b) for c, b in found.items() if len(c) <= self.longest)
        return found

    def encode(self, texts):
        """Texts (an Arrow string array, nulls are empty) to (ids, ends):
        one array of the ids of all texts, and where each text's ids end."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        low, high = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
        if high == low:
            return np.empty(0, self.dtype), np.zeros(len(texts), np.int64)
        body = np.frombuffer(data, np.uint8)[low:high]
        text_starts = offsets - low
        cuts = _chunk_starts(body, text_starts[:-1])
        ends = np.append(cuts, high - low)
        chunks = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(body))
        coded = chunks.dictionary_encode()
        distinct, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        cached = self.ids.get
        each = [cached(c) for c in distinct]
        new = self._encode_new([c for c, b in zip(distinct, each, strict=True) if b is None])
        if new:
            each = [new[c] if b is None else b for c, b in zip(distinct, each, strict=True)]
        width = np.dtype(self.dtype).itemsize
        pool = np.frombuffer(b"".join(each), self.dtype)
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // width
        first = np.cumsum(sizes) - sizes
        n = sizes[codes]
        until = np.cumsum(n)
        ids = pool[np.repeat(first[codes] - (until - n), n) + np.arange(int(until[-1]))]
        upto = np.append(0, until)[np.searchsorted(cuts, text_starts[1:])]
        return ids, upto
