"""Reading recorded session files (CSV) as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setwise.contract import BATCH_BYTES, MISSING_TEXT, SESSION_FILE

_LINE = "__line"


def session_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType = SESSION_FILE,
    name: Column | None = None,
    stream: bool = False,
    max_bytes: int = BATCH_BYTES,
    max_files: int | None = None,
    session: str | None = None,
    block: str | None = None,
) -> DataFrame:
    """Typed samples plus ``_rescued_data`` and ``filename``.

    Cells are read as text and cast here, so that a cell that does not fit its type
    turns null and is kept, as JSON, in ``_rescued_data``. ``name`` says how to derive
    the session name from the file metadata; the default is the file's name. ``session`` names
    a last cell of files that hold several sessions, which ``name`` may use too.
    A stream takes at most about ``max_bytes`` (or ``max_files``) per micro-batch.
    ``block`` adds, under that name, a number that the rows of a part of a file share.
    """
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*schema.names, *([session] if session else [])]])
    reader = spark.readStream if stream else spark.read
    reader = (
        reader.schema(T.StructType([*text.fields, T.StructField(_LINE, T.StringType())]))
        .option("header", True)
        .option("delimiter", ",")
        .option("nullValue", MISSING_TEXT)
        .option("columnNameOfCorruptRecord", _LINE)
    )
    if stream:
        limit = ("maxFilesPerTrigger", max_files) if max_files else ("maxBytesPerTrigger", max_bytes)
        reader = reader.option(*limit)
    raw = reader.csv(path)
    added = {"filename": F.col("_metadata.file_name") if name is None else name}
    if block:
        added[block] = F.xxhash64("_metadata.file_path", "_metadata.file_block_start")
    return rescue_cells(raw, schema, line=_LINE).withColumns(added).select(*schema.names, "_rescued_data", *added)


def rescue_cells(raw: DataFrame, schema: T.StructType, line: str | None = None) -> DataFrame:
    """Cast text columns to ``schema``; keep the cells that do not fit as a JSON object.

    ``line`` names the column that holds a line whose number of cells is wrong.
    """
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    names = [f.name for f in schema.fields if f.dataType != T.StringType()]
    cells = [
        F.struct(
            F.lit(name).alias("key"),
            F.when(F.col(name).isNotNull() & typed[name].isNull(), F.col(name)).alias("value"),
        )
        for name in names
    ]
    if line:
        cells.append(F.struct(F.lit("_line").alias("key"), F.col(line).alias("value")))
    bad = F.map_from_entries(F.filter(F.array(*cells), lambda cell: cell["value"].isNotNull()))
    return raw.withColumns(
        typed | {"_rescued_data": F.when(F.size(bad) > 0, F.to_json(bad))}
    )
