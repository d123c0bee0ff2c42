"""Exact removal of repeated byte strings, by prefix-free parsing.

A rolling hash marks triggers in every text: of the ``K``-byte strings inside
each ``length``-byte string the one with the smallest hash is its trigger, so
equal strings have equal triggers at equal places. The work follows from that:

1. Texts are kept in blocks. Each block tells which triggers it holds (32 bits
   each, dealt by leading bits); a trigger that stands in one document only
   proves that none of its strings repeats.
2. What is left is cut at sparse triggers into phrases that overlap by
   ``length - 1`` bytes, so a repeated passage is the same sequence of phrases
   wherever it stands. The parse is the phrases of each document, the
   dictionary holds each distinct phrase once with its first document. All
   strings of a phrase that an earlier document has too are repeats.
3. A phrase's strings may also begin earlier inside another phrase. The
   dictionary is parsed in its turn; around each trigger that phrases of
   several first documents share, the strings are put into suffix order, in
   which equal strings are neighbours, and each gets its first document.
4. Parse and dictionary are joined, and each block removes what is covered.

Equality is decided on the bytes (phrases by a 128-bit digest). No candidate
is dropped: a trigger shared by very many contexts is taken apart into single
strings, which are aggregated before they are shuffled.
"""

from __future__ import annotations

import hashlib
import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.io import bounded_batches, filesystem, make_folder, scratch, settle

K = 24                # bytes of a trigger string
BLOCK_BYTES = 4 << 20
SPARSE = 8            # one trigger of so many begins a phrase


def _triggers(body, offsets, length: int):
    """Runs of strings with one trigger: first start, end (exclusive), hash of
    the trigger, text. ``body`` is the texts' bytes, text i from offsets[i] to
    offsets[i + 1]; strings do not cross texts."""
    import numpy as np

    none = np.empty(0, np.int64)
    if len(body) < length:
        return none, none, none.astype(np.uint64), none
    power = {k: np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in (1, 2, 4, 8)}
    h = body.astype(np.uint64) + np.uint64(1)
    for k in (1, 2, 4):
        h = h[:-k] * power[k] + h[k:]
    eight = h
    h = h[:-8] * power[8] + h[8:]
    h = h[:-8] * power[8] + eight[16:]
    del eight
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    least = h & np.uint64(0xFFFFFFFF00000000) | np.arange(len(h), dtype=np.uint64)
    width, reach = length - K + 1, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:reach - width], least[width - reach:])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(len(at) + 1, np.int64)
    long_ = np.diff(offsets) >= length
    np.add.at(inside, offsets[:-1][long_], 1)
    np.add.at(inside, offsets[1:][long_] - length + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (at[1:] != at[:-1])
    last = inside.copy()
    last[:-1] &= ~inside[1:] | (at[1:] != at[:-1])
    starts, ends = np.flatnonzero(new), np.flatnonzero(last) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, h[at[starts]], text


def _told(hashes, owner, bits: int):
    """Distinct leading 32 + bits bits of the hashes, in order; which one each
    hash is; which of them several owners have."""
    import numpy as np

    value, which = np.unique(hashes >> np.uint64(32 - bits), return_inverse=True)
    low = np.full(len(value), np.iinfo(np.int64).max)
    high = np.full(len(value), np.iinfo(np.int64).min)
    np.minimum.at(low, which, owner)
    np.maximum.at(high, which, owner)
    return value, which, low != high


def _write_block(folder: str, bodies: list[bytes], owners: list, keys: list[bytes] | None) -> tuple[int, int]:
    import io

    import numpy as np
    import zstandard

    number = uuid.uuid4().int >> 65
    known = np.array([o is not None for o in owners], bool)
    buffer = io.BytesIO()
    np.savez(buffer, body=np.frombuffer(b"".join(bodies), np.uint8), offsets=np.cumsum([0] + [len(b) for b in bodies]),
             owners=np.array([o or 0 for o in owners], np.int64), known=known, keys=np.frombuffer(b"".join(keys or []), np.uint8))
    system, path = filesystem(f"{folder}/{number}")
    with system.open_output_stream(path) as out:
        out.write(zstandard.ZstdCompressor(level=1).compress(buffer.getvalue()))
    return number, len(bodies)


def _read_block(folder: str, number: int):
    import io

    import numpy as np
    import zstandard

    system, path = filesystem(f"{folder}/{number}")
    with system.open_input_stream(path) as source:
        return np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(source.read(), max_output_size=2**31)))


def _blocks(rows: DataFrame, folder: str, block_bytes: int) -> DataFrame:
    """Write (owner, body[, key]) rows as block files; (block, n) per file."""
    keyed = "key" in rows.columns

    def write(batches):
        bodies, owners, keys, size = [], [], [], 0
        for batch in batches:
            columns = [batch.column("owner").to_pylist(), batch.column("body").to_pylist()]
            columns.append(batch.column("key").to_pylist() if keyed else [b""] * batch.num_rows)
            for owner, body, key in zip(*columns, strict=True):
                bodies.append(body)
                owners.append(owner)
                keys.append(key)
                size += len(body)
                if size >= block_bytes:
                    yield _listed(_write_block(folder, bodies, owners, keys))
                    bodies, owners, keys, size = [], [], [], 0
        if bodies:
            yield _listed(_write_block(folder, bodies, owners, keys))

    return settle(rows.mapInArrow(write, "block long, n long"), "blocks")


def _listed(block: tuple[int, int]):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"block": [block[0]], "n": [block[1]]})


def _shared(blocks: DataFrame, folder: str, length: int, bits: int) -> DataFrame:
    """(block, bucket, marks): a bit for each distinct trigger of the block in
    the bucket, set if another block has it too."""

    def tell(batches):
        import numpy as np

        for batch in batches:
            for number in batch["block"]:
                data = _read_block(folder, number)
                owners, known = data["owners"], data["known"]  # texts without an owner take no part
                _, _, hashes, text = _triggers(data["body"], data["offsets"], length)
                take = known[text]
                value, _, _ = _told(hashes[take], owners[text[take]], bits)
                bucket = (value >> np.uint64(32)).astype(np.int64)
                edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
                low = (value & np.uint64(0xFFFFFFFF)).astype("<u4")
                yield pd.DataFrame({"bucket": bucket[edge], "block": [number] * len(edge), "told": [x.tobytes() for x in np.split(low, edge[1:])] if len(edge) else []})

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        parts = [np.frombuffer(t, "<u4") for t in rows["told"]]
        _, which, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        marks = np.split(count[which] > 1, np.cumsum([len(p) for p in parts])[:-1])
        return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "marks": [np.packbits(m).tobytes() for m in marks], "n": [len(p) for p in parts]})

    told = _spread(blocks).mapInPandas(tell, "bucket long, block long, told binary")
    return told.groupBy("bucket").applyInPandas(compare, "block long, bucket long, marks binary, n int")


def _spread(blocks: DataFrame) -> DataFrame:
    """A task per few blocks; the list has one row per block."""
    few = max(1, min(blocks.count(), 8 * blocks.sparkSession.sparkContext.defaultParallelism))
    return blocks.select("block").repartition(few, "block")


def _open_runs(data, rows, length: int, bits: int):
    """The trigger runs of a block that may repeat, given its marks."""
    import numpy as np

    owners, known = data["owners"], data["known"]
    starts, ends, hashes, text = _triggers(data["body"], data["offsets"], length)
    take = known[text]
    starts, ends, hashes, text = starts[take], ends[take], hashes[take], text[take]
    _, which, several = _told(hashes, owners[text], bits)
    marks = [np.unpackbits(np.frombuffer(m, np.uint8), count=n).astype(bool) for _, m, n in sorted(rows)]
    shared = np.concatenate(marks) if marks else np.zeros(0, bool)
    keep = (shared | several)[which] if len(which) else np.zeros(0, bool)
    return starts[keep], ends[keep], hashes[keep], text[keep]


def _with_marks(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """One row per block with all its marks (a bit per trigger of the block)."""
    grouped = replies.groupBy("block").agg(F.collect_list(F.struct("bucket", "marks", "n")).alias("marks"))
    return settle(grouped, "block-marks")


_OCCURRENCE = "phrase binary, block long, text int, start int, n int, owner long, body binary"


def _parse(marked: DataFrame, folder: str, length: int, bits: int) -> DataFrame:
    """Phrases of all blocks: digest, block, text, first string, strings,
    owner; the first of a block carries the bytes."""

    def parse(batches):
        import numpy as np

        for batch in batches:
            for number, marks in zip(batch["block"], batch["marks"], strict=True):
                data = _read_block(folder, number)
                starts, ends, hashes, text = _open_runs(data, [(m["bucket"], m["marks"], m["n"]) for m in marks], length, bits)
                if not len(starts):
                    continue
                body, offsets, owners = data["body"].tobytes(), data["offsets"], data["owners"]
                cut = np.append(True, (starts[1:] != ends[:-1]) | (hashes[1:] % np.uint64(SPARSE) == 0) | (text[1:] != text[:-1]))
                first = np.flatnonzero(cut)
                low, high, where = starts[first], ends[np.append(first[1:], len(starts)) - 1], text[first]
                seen, out = set(), []
                for a, b, t in zip(low.tolist(), high.tolist(), where.tolist(), strict=True):
                    piece = body[a:b + length - 1]
                    digest = hashlib.blake2b(piece, digest_size=16).digest()
                    own = int(owners[t])
                    out.append((digest, number, t, a - int(offsets[t]), b - a, own, None if digest in seen else piece))
                    seen.add(digest)
                yield pd.DataFrame(out, columns=["phrase", "block", "text", "start", "n", "owner", "body"])

    return settle(marked.repartition(_parts(marked), "block").mapInPandas(parse, _OCCURRENCE), "parse")


def _parts(frame: DataFrame) -> int:
    return max(1, min(frame.count(), 8 * frame.sparkSession.sparkContext.defaultParallelism))


_CONTEXT = "trigger long, phrase binary, start int, n int, owner long, body binary"


def _contexts(marked: DataFrame, folder: str, length: int, bits: int) -> DataFrame:
    """The strings around the open triggers of the dictionary."""

    def cut(batches):
        for batch in batches:
            for number, marks in zip(batch["block"], batch["marks"], strict=True):
                data = _read_block(folder, number)
                starts, ends, hashes, text = _open_runs(data, [(m["bucket"], m["marks"], m["n"]) for m in marks], length, bits)
                body, offsets, owners, keys = data["body"].tobytes(), data["offsets"], data["owners"], data["keys"].tobytes()
                out = [(h, keys[16 * t:16 * t + 16], a - int(offsets[t]), b - a, int(owners[t]), body[a:b + length - 1])
                       for a, b, h, t in zip(starts.tolist(), ends.tolist(), hashes.view("int64").tolist(), text.tolist(), strict=True)]
                for at in range(0, len(out), 20_000):
                    yield pd.DataFrame(out[at:at + 20_000], columns=["trigger", "phrase", "start", "n", "owner", "body"])

    return settle(marked.repartition(_parts(marked), "block").mapInPandas(cut, _CONTEXT), "contexts")


def _spread_out(starts, sizes):
    """starts[0], starts[0] + 1, ... (sizes[0] of them), starts[1], ..."""
    import numpy as np

    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _first_owners(bodies: list[bytes], owners, length: int):
    """For each string of the bodies, one after the other, the smallest owner
    of an equal string. Strings are ordered as suffixes cut at ``length``."""
    import numpy as np

    sizes = np.array([len(b) - length + 1 for b in bodies])
    text = np.frombuffer(b"".join(bodies), np.uint8)
    at = _spread_out(np.cumsum(sizes + length - 1) - sizes - length + 1, sizes)
    strings = np.lib.stride_tricks.sliding_window_view(text, length)[at]
    whole = np.ascontiguousarray(strings).view(np.dtype((np.void, length))).ravel()
    order = np.argsort(whole, kind="stable")
    new = np.append(True, whole[order[1:]] != whole[order[:-1]])
    low = np.minimum.reduceat(np.repeat(np.asarray(owners), sizes)[order], np.flatnonzero(new))
    first = np.empty(len(order), np.int64)
    first[order] = low[np.cumsum(new) - 1]
    return first


def _earlier(contexts: DataFrame, length: int, most: int) -> DataFrame:
    """(phrase, start): strings of phrases that stand in an earlier document
    than the phrase does, as places in the phrase."""
    large = settle(contexts.groupBy("trigger").agg(F.count("*").alias("many")).where(F.col("many") > most).select("trigger"), "trigger-large")

    def order(batches):
        import numpy as np

        parts = [b for b in batches if len(b)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        trigger, owner = rows["trigger"].to_numpy(), rows["owner"].to_numpy()
        # equal contexts are put in order once, with their smallest owner
        code, bodies = pd.factorize(rows["body"])
        low = np.full(len(bodies), np.iinfo(np.int64).max)
        np.minimum.at(low, code, owner)
        trigger_of = np.empty(len(bodies), np.int64)
        trigger_of[code] = trigger
        own, group, many = np.unique(trigger_of, return_inverse=True, return_counts=True)
        sizes = np.fromiter(map(len, bodies), np.int64, len(bodies)) - length + 1
        base = np.cumsum(sizes) - sizes
        first = np.repeat(low, sizes)
        several = np.flatnonzero(many[group] > 1)  # elsewhere all strings of the trigger are in one context
        several = several[np.argsort(group[several], kind="stable")]
        edge = np.append(np.flatnonzero(np.append(True, group[several][1:] != group[several][:-1])), len(several)) if len(several) else np.zeros(1, np.int64)
        at = 0
        while at < len(edge) - 1:  # several triggers at once: strings of different triggers differ
            to = max(at + 1, int(np.searchsorted(edge, edge[at] + 4096, "right")) - 1)
            part = several[edge[at]:edge[to]]
            found = _first_owners([bodies[k] for k in part], low[part], length)
            first[_spread_out(base[part], sizes[part])] = found
            at = to
        lowest = np.full(len(own), np.iinfo(np.int64).max)
        np.minimum.at(lowest, group, low)
        later = np.flatnonzero(lowest[group[code]] < owner)
        start, phrase = rows["start"].to_numpy(), rows["phrase"].to_numpy()
        for k in range(0, len(later), 50_000):
            part = later[k:k + 50_000]
            n = sizes[code[part]]
            which = np.repeat(part, n)
            inside = _spread_out(np.zeros(len(part), np.int64), n)
            hit = first[base[code[which]] + inside] < owner[which]
            yield pd.DataFrame({"phrase": phrase[which[hit]], "start": (start[which[hit]] + inside[hit]).astype("int32")})

    few = contexts.join(large, "trigger", "left_anti").select("trigger", "phrase", "start", "owner", "body")
    by_order = few.repartition("trigger").mapInPandas(order, "phrase binary, start int")
    # a trigger with very many contexts: string by string, aggregated before the shuffle
    strings = contexts.join(large, "trigger", "left_semi").select("phrase", "start", "owner", "body", F.posexplode(F.sequence(F.lit(1), F.col("n"))).alias("k", "from"))
    strings = strings.select("phrase", (F.col("start") + F.col("k")).alias("start"), "owner", F.substring("body", F.col("from"), F.lit(length)).alias("string"))
    low = settle(strings.groupBy("string").agg(F.min("owner").alias("low")), "string-owners")
    by_string = strings.join(low, "string").where("low < owner").select("phrase", "start")
    return by_order.union(by_string)


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _removed(blocks: DataFrame, found: DataFrame, folder: str, length: int, keep_bytes: bool) -> DataFrame:
    """Apply the repeated strings (block, text, start, n, marks) to the blocks."""

    def cut(rows: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        data = _read_block(folder, int(rows["block"].iloc[0]))
        body, offsets, owners, known = data["body"], data["offsets"], data["owners"], data["known"]
        cover = np.zeros(len(body) + 1, np.int32)
        rows = rows[rows["text"].notna()]
        base = offsets[rows["text"].to_numpy().astype("int64")] + rows["start"].to_numpy().astype("int64") if len(rows) else []
        for at, n, marks in zip(base, rows["n"].tolist(), rows["marks"].tolist(), strict=True):
            if marks is None:  # all strings of the phrase
                cover[at] += 1
                cover[at + int(n) + length - 1] -= 1
            else:
                places = at + np.asarray(marks, np.int64)
                np.add.at(cover, places, 1)
                np.add.at(cover, places + length, -1)
        gone = np.cumsum(cover[:-1]) > 0
        out = []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            mask = gone[a:b]
            kept = body[a:b][~mask].tobytes()
            spans = int((mask[1:] & ~mask[:-1]).sum() + (mask[0] if b > a else 0))
            out.append((int(owners[i]) if known[i] else None, b - a, int(mask.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
        made = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
        return made.astype({"doc_id": "Int64"})

    return blocks.select("block").join(found, "block", "left").groupBy("block").applyInPandas(cut, _RESULT)


def deduplicate(docs: DataFrame, length: int = 50, block_bytes: int = BLOCK_BYTES, most: int = 20_000, keep_bytes: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; others ignored): doc_id,
    n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left, if asked).

    Removed is each byte covered by a ``length``-byte string that also starts
    in a document with a smaller doc_id. A null text is empty. Rows that share
    a doc_id are one document in this: none is earlier than the other. A null
    doc_id is neither earlier nor later than any. An empty table gives an
    empty result. ``most`` is the number of contexts over which a trigger is
    taken apart into strings.
    """
    if length <= K:
        raise ValueError(f"length must be over {K}")
    spark = docs.sparkSession
    bounded_batches(spark)
    folder, words = scratch(spark, "text-blocks"), scratch(spark, "phrase-blocks")
    make_folder(folder)
    make_folder(words)
    rows = docs.select(F.col("doc_id").cast("long").alias("owner"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("body"))
    blocks = _blocks(rows, folder, block_bytes)

    def bits(listed: DataFrame) -> int:  # so many buckets that each gets about 2**18 triggers
        return min(28, max(4, (listed.count() * block_bytes // 14 >> 18).bit_length()))

    n = bits(blocks)
    parse = _parse(_with_marks(blocks, _shared(blocks, folder, length, n)), folder, length, n)
    dictionary = settle(parse.groupBy("phrase").agg(F.min("owner").alias("owner"), F.max("body").alias("body")), "dictionary")
    listed = _blocks(dictionary.select("owner", "body", F.col("phrase").alias("key")), words, block_bytes)
    n = bits(listed)
    contexts = _contexts(_with_marks(listed, _shared(listed, words, length, n)), words, length, n)
    marks = settle(_earlier(contexts, length, most).groupBy("phrase").agg(F.collect_set("start").alias("marks")), "phrase-marks")
    firsts = settle(dictionary.select("phrase", F.col("owner").alias("first")).join(marks, "phrase", "left"), "phrase-firsts")
    joined = parse.select("phrase", "block", "text", "start", "n", "owner").join(firsts, "phrase")
    found = joined.where("first < owner OR marks IS NOT NULL").select(
        "block", "text", "start", "n", F.when(F.col("first") < F.col("owner"), F.lit(None)).otherwise(F.col("marks")).alias("marks"))
    out = _removed(blocks, found, folder, length, keep_bytes)
    return out if keep_bytes else out.drop("kept")
