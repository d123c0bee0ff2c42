"""Reading change envelopes (JSON Lines, plain or gzip).

The raw line is read as text and parsed with ``from_json`` so that the
line itself survives for the quarantine. Glued records (several objects on
one line, as delivery buffers can produce) are split before parsing;
Spark's JSON parser would otherwise keep the first object and silently drop
the rest. Both envelope shapes are accepted: ``{"payload": {...}}`` and the
bare form with the payload fields at top level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.schemas import CORRUPT_COLUMN, PARSE_SCHEMA, PAYLOAD

# Boundary between two glued top-level objects: a closing brace, then an object
# with any first key. Inside a JSON string the key's quote would be escaped.
GLUED_BOUNDARY = r'(?<=\})\s*(?=\{\s*"[^"\\]*"\s*:)'
GLUED_AFTER = "{ \t\n\x0b\f\r"  # what may follow the closing brace: the opening one or what ``\\s`` matches


def read_change_lines(spark: SparkSession, path: str | list[str], recursive: bool = True) -> DataFrame:
    """Raw lines of landed files, with the file they came from.

    ``recursiveFileLookup`` is on by default: landing layouts like
    ``<db>/<table>/<yyyy>/<MM>/<dd>/<HH>`` are not ``k=v`` directories and a
    non-recursive read of them returns no rows.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    paths = [path] if isinstance(path, str) else list(path)
    return reader.text(paths).select(
        F.col("value"), F.col("_metadata.file_path").alias("source_file")
    )


def split_glued(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One row per JSON object; blank lines dropped. Only a line in which a brace closes before
    white space or another brace can hold a boundary: no other is read by the expression."""
    line, near = F.col(value_col), F.lit(False)
    for after in GLUED_AFTER:
        near = near | F.contains(line, F.lit("}" + after))
    parts = F.explode(F.when(near, F.split(line, GLUED_BOUNDARY)).otherwise(F.array(line)))
    others = [c for c in lines.columns if c != value_col]
    return (
        lines.select(*others, parts.alias(value_col))
        .filter(F.length(F.trim(F.col(value_col))) > 0)
    )


def parse_change_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse lines into ``payload`` (both shapes) + ``_corrupt_record``.

    ``_corrupt_record`` holds the raw line when it is not valid JSON for the
    schema; ``payload`` is NULL when the object has neither shape.
    """
    parsed = F.from_json(
        F.col(value_col),
        PARSE_SCHEMA,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN},
    )
    others = [c for c in lines.columns if c != value_col]
    j = F.col("_j")
    bare = F.struct(*[j[f.name].alias(f.name) for f in PAYLOAD.fields])
    payload = F.when(j["payload"].isNotNull(), j["payload"]).when(j["op"].isNotNull(), bare)
    # Parse inside a generator: predicates on the parsed columns cannot be
    # pushed below a Generate, so from_json runs once per line instead of
    # once in the pushed-down filter and again in the projection.
    parsed_row = F.struct(F.col(value_col).alias("_raw"), parsed.alias("_j"))
    return (
        lines.select(*others, F.inline(F.array(parsed_row)))
        .select(
            *others,
            payload.alias("payload"),
            F.when(j[CORRUPT_COLUMN].isNotNull() | j.isNull(), F.col("_raw")).alias(CORRUPT_COLUMN),
            F.col("_raw").alias("raw"),
        )
    )


def read_change_events(spark: SparkSession, path: str | list[str], recursive: bool = True) -> DataFrame:
    """Permissive typed scan of envelopes; keeps the raw line and its file."""
    return parse_change_lines(split_glued(read_change_lines(spark, path, recursive)))
