"""Token-ID files: flat unsigned integers plus 64-bit document offsets.

Documents are ranged by doc_id; each range is one file set in the shared
folder: ``.ids`` (ids, little-endian, 16 bit if the vocabulary allows, else
32), ``.off`` (n + 1 unsigned 64-bit places in it) and ``.doc`` (the doc_ids,
signed 64-bit; the smallest value stands for null). The base of a file, its
place in the whole corpus, is the sum of the tokens of all files before it,
taken over the one-row-per-file listing. Readers map the files into memory.
"""

from __future__ import annotations

import uuid
import zlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.io import bounded_batches, filesystem, make_folder, scratch, settle
from rowtide.llm.text import ChunkTokenizer

NULL_ID = -(2**63)


def id_dtype(path: str):
    """The narrowest unsigned type for the vocabulary of a tokenizer file."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 65536 else "<u4"


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the ids of all ``docs`` (doc_id, text) in ascending doc_id order
    (null ids first, equal ids by text) and return the listing: shard, stem,
    n_docs, n_tokens, base. A null text is empty; every document, empty ones
    too, ends with ``end_id``. An empty table lists no file."""
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = folder or scratch(spark, "tokens")
    make_folder(folder)
    dtype = id_dtype(tokenizer)

    def write_range(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        stem = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        system, path = filesystem(stem)
        encoder, sizes, doc_ids, out = ChunkTokenizer(tokenizer, dtype), [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = system.open_output_stream(path + ".ids")
            ids, ends = encoder.encode(batch.column("text"))
            out.write(np.insert(ids, ends, np.array(end_id, dtype)).tobytes())
            sizes.append(np.diff(ends, prepend=0) + 1)
            doc_ids.append(batch.column("doc_id").cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False))
        if out is None:
            return
        out.close()
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype("<u8")
        for suffix, values in ((".off", offsets), (".doc", np.concatenate(doc_ids).astype("<i8"))):
            with system.open_output_stream(path + suffix) as side:
                side.write(values.tobytes())
        yield pa.RecordBatch.from_pydict({"shard": [TaskContext.get().partitionId()], "stem": [stem], "n_docs": [len(offsets) - 1], "n_tokens": [int(offsets[-1])]})

    # rows of one doc_id are told apart by a hash, so a hot id is dealt over several files
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").alias("tie")]
    docs = docs.select("doc_id", "text", order[1])
    ranged = docs.repartitionByRange(order[0], "tie").sortWithinPartitions(order[0], "tie").select("doc_id", "text")
    listing = settle(ranged.mapInArrow(write_range, "shard long, stem string, n_docs long, n_tokens long"), "token-listing")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return listing.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _mapped(stem: str, suffix: str, dtype: str):
    """A file as an array: mapped into memory where the folder is a local mount."""
    import numpy as np
    from pyarrow import fs

    system, path = filesystem(stem + suffix)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with system.open_input_file(path) as source:
        return np.frombuffer(source.read(), dtype)


def read(listing: DataFrame, dtype: str) -> DataFrame:
    """One row per document of the listed files: doc_id, start, n_tokens,
    ids_crc32 (of the ids as unsigned 32-bit integers)."""
    files = max(1, listing.count())

    def read_files(batches):
        for batch in batches:
            for stem, base in zip(batch["stem"], batch["base"], strict=True):
                ids, offsets, docs = _mapped(stem, ".ids", dtype), _mapped(stem, ".off", "<u8"), _mapped(stem, ".doc", "<i8")
                for at in range(0, len(docs), 4096):
                    own = docs[at:at + 4096]
                    cuts = offsets[at:at + len(own) + 1].astype("int64")
                    yield pd.DataFrame({
                        "doc_id": pd.array([None if d == NULL_ID else d for d in own.tolist()], "Int64"),
                        "start": cuts[:-1] + int(base),
                        "n_tokens": cuts[1:] - cuts[:-1],
                        "ids_crc32": [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)],
                    })

    return listing.select("stem", "base").repartition(files).mapInPandas(read_files, "doc_id long, start long, n_tokens long, ids_crc32 long")
