"""K4: search-index bulk actions as NDJSON, built and written by Spark.

Each upsert becomes an ``index`` action line plus its document line; a
delete becomes a ``delete`` action, or, for soft-delete tables, an
``index`` of the document with ``deleted_at`` set (readers filter it).
The action lines are written per partition as text: no driver round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.contracts import TableContract

INDEX_PREFIX = "cdc"  # fixed value: index names are <prefix>-<db>-<table>
ID_SEPARATOR = "|"  # fixed value: document id = key values joined by '|'


def index_name(contract: TableContract, prefix: str = INDEX_PREFIX) -> str:
    return f"{prefix}-{contract.db_name}-{contract.table_name}"


def document_id(contract: TableContract) -> Column:
    return F.concat_ws(ID_SEPARATOR, *[F.col(k).cast("string") for k in contract.primary_keys])


# Bits of the log position in a version; documents and bytes of a bulk request.
POSITION_BITS = 22
BULK_DOCUMENTS, BULK_BYTES = 500, 10_000_000


def document_version() -> Column:
    """The order key as one number: event time in ms, then the log position modulo 2^22. Two
    changes of a document within a millisecond compare right unless the log grew past a
    multiple of 4 MiB between them; a version has 63 bits."""
    place = F.pmod(F.coalesce(F.col("_pos"), F.lit(0)), F.lit(1 << POSITION_BITS))
    return F.shiftleft(F.col("_ts_ms"), POSITION_BITS).bitwiseOR(place)


def search_actions(rows: DataFrame, contract: TableContract, deleted: Column | None = None,
                   deleted_at: Column | None = None, prefix: str = INDEX_PREFIX, version: Column | None = None) -> DataFrame:
    """(_id, action, document) per row; ``document`` NULL for physical deletes.

    ``deleted`` marks delete rows; ``deleted_at`` is their time (soft delete).
    ``version`` (see ``document_version``) becomes the document's external version: the
    index refuses an action older than what it holds, so batches may be replayed in any order.
    """
    idx = index_name(contract, prefix)
    is_del = deleted if deleted is not None else F.lit(False)
    doc_cols = [F.col(a) for a in contract.attribute_columns] + [F.col(k) for k in contract.primary_keys]
    if contract.soft_delete:
        doc_cols.append(F.when(is_del, deleted_at).cast("timestamp_ntz").alias("deleted_at"))
    doc = F.to_json(F.struct(*doc_cols), {"ignoreNullFields": "false"})
    ordered = [] if version is None else [version.alias("version"), F.lit("external_gte").alias("version_type")]
    meta = F.struct(F.lit(idx).alias("_index"), document_id(contract).alias("_id"), *ordered)
    index_action = F.to_json(F.struct(meta.alias("index")))
    delete_action = F.to_json(F.struct(meta.alias("delete")))
    physical_delete = is_del & F.lit(not contract.soft_delete)
    return rows.select(
        document_id(contract).alias("_id"),
        F.when(physical_delete, delete_action).otherwise(index_action).alias("action"),
        F.when(physical_delete, F.lit(None)).otherwise(doc).alias("document"),
    )


def write_bulk(actions: DataFrame, path: str, documents: int = BULK_DOCUMENTS, max_bytes: int = BULK_BYTES) -> None:
    """Bulk NDJSON: action line, then document line when there is one. A file is one bulk
    request: at most ``documents`` documents and, as none is longer than the longest,
    at most ``max_bytes`` bytes (a single longer document is a file of its own)."""
    lines = actions.select(F.concat_ws("\n", "action", "document").alias("value"))
    longest = lines.agg(F.max(F.octet_length("value") + 1)).first()[0]
    per_file = max(1, min(documents, max_bytes // longest)) if longest else documents
    lines.write.mode("overwrite").option("maxRecordsPerFile", str(per_file)).text(path)


def read_bulk(spark: SparkSession, path: str) -> DataFrame:
    """(``_id``, ``version``, ``deleted``, ``document``) of written bulk files, whole requests at a time."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    line = F.split(F.rtrim(F.col("value"), F.lit("\n")), "\n")
    rows = files.select(F.posexplode(line).alias("at", "line"), line.alias("lines")) \
        .select("line", F.try_element_at("lines", F.col("at") + 2).alias("after")) \
        .select(F.from_json("line", "index struct<_id:string,version:long>, delete struct<_id:string,version:long>").alias("a"), "after")
    meta = F.coalesce("a.index", "a.delete")
    return rows.where(meta.isNotNull()).select(
        meta["_id"].alias("_id"), meta["version"].alias("version"), F.col("a.delete").isNotNull().alias("deleted"),
        F.when(F.col("a.index").isNotNull(), F.col("after")).alias("document"))


def indexed(actions: DataFrame) -> DataFrame:
    """What an index holds after these actions came in any order: (``_id``, ``document``)."""
    last = actions.groupBy("_id").agg(F.max_by(F.struct("deleted", "document"), "version").alias("x"))
    return last.filter(~F.col("x.deleted")).select("_id", "x.document")
