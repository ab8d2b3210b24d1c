"""CSV sinks: plain writes and record-bounded chunked landing (K6-K8), with proof of the landed content (T7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlake import versions
from crashlake.config import join_path, shuffles_removed
from crashlake.operators.keys import staged_positions
from crashlake.sources.csv import CSV_DIALECT, read_csv

#: Kept beside the chunks, where no reader of the raw zone looks (the name begins with an underscore).
CONTENT = "_content"
#: Files that one task writes, about, where there are more chunks than shuffle partitions.
FILES_PER_TASK = 16


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Replace ``path`` with header CSV in the lake's RFC-4180 dialect."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    with shuffles_removed(df.sparkSession):
        writer.options(**CSV_DIALECT).option("sep", sep).csv(path)


def chunk_assign(
    df: DataFrame, records_per_file: int, order_by: list[str] | None, chunk_col: str = "chunk"
) -> tuple[DataFrame, int]:
    """Number rows 0..n-1 and put row i in chunk ``floor(i / records_per_file)``.

    The order is ``order_by`` (a total order), or, when it is ``None``, the
    source order of a file scan (file path, then record position). Adds
    ``chunk_col`` and ``_idx``; returned with the number of rows. All chunks hold exactly ``records_per_file``
    rows except the last, and no chunk is empty.
    """
    if records_per_file <= 0:
        raise ValueError("records_per_file must be > 0")
    frame, rows = staged_positions(df, order_by, "_idx")
    out = frame.withColumn(chunk_col, F.floor(F.col("_idx") / F.lit(records_per_file)).cast("bigint"))
    out.scratch = frame.scratch
    return out, rows


def writing_tasks(spark: SparkSession, chunks: int) -> int:
    """Tasks that write so many chunks: a file has a cost of its own, so that small chunks are dealt by number, not by bytes."""
    return max(1, min(chunks, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chunks // FILES_PER_TASK))))


def fingerprint(columns: list[str]) -> Column:
    """Fingerprint of a multiset of rows, whatever their order: the sum of 64-bit row hashes, as decimal(38).

    A sum is merged from partial sums, so it costs no shuffle. A value counts with its place among the columns. An
    empty text counts as null, which it becomes in the CSV dialect of the lake.
    """
    values = [F.nullif(F.col(f"`{name}`").cast("string"), F.lit("")) for name in columns]
    cells = [c for value in values for c in (value.isNull(), value)]
    return F.sum(F.xxhash64(*cells).cast("decimal(28,0)"))


def _as_written(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns whose text in a CSV file is that of a cast: texts, whole numbers and truth values."""
    plain = (T.StringType, T.IntegralType, T.BooleanType)
    return [c for c in columns if isinstance(df.schema[c].dataType, plain)]


def verify_content(spark: SparkSession, dest: str) -> int:
    """Read landed chunks back and compare rows and fingerprint with those of the landing; a difference raises.

    Returns the number of rows. One scan of the chunks, with one sum per task.
    """
    noted = spark.read.parquet(join_path(dest, CONTENT)).head()
    schema = T.StructType([T.StructField(c, T.StringType()) for c in noted["columns"]])
    landed = read_csv(spark, dest, sep=noted["sep"], schema=schema)
    rows, mark = landed.agg(F.count(F.lit(1)), fingerprint(noted["checked"])).head()
    if (rows, mark) != (noted["rows"], noted["fingerprint"]):
        raise RuntimeError(f"{dest} holds other content than was landed: {rows} rows of {noted['rows']}, fingerprint {mark}, not {noted['fingerprint']}")
    return rows


def land_chunked_csv(
    df: DataFrame,
    dest: str,
    records_per_file: int,
    order_by: list[str] | None,
    sep: str = ",",
    drop: list[str] | None = None,
    until_staged: str | None = None,
) -> dict[str, int]:
    """Replace ``dest`` with header CSV chunks of at most ``records_per_file`` records.

    Chunk ``k`` is the single file under ``dest/chunk=k/``; record order inside
    a chunk follows ``order_by`` (``None``: the source file order). Columns in
    ``drop`` (e.g. a source-order column) are not written. Earlier chunks go,
    whatever overwrite mode the session has.

    The rows are read once, staged as Parquet with their positions, shuffled by
    chunk and written, by a number of tasks that follows the number of chunks. The number of rows staged and the number the writing
    tasks sent out are compared; a difference raises. The writing tasks also sum up
    a fingerprint of what they send out, which is kept in ``dest/_content`` for
    :func:`verify_content`. Returns ``{"rows": n, "chunks": k}``. The staged rows are deleted when the chunks are
    written, and ``until_staged``, a scratch folder that ``df`` reads, as soon as the rows are staged.
    """
    chunked, rows = chunk_assign(df, records_per_file, order_by)
    if until_staged:
        versions.delete(df.sparkSession, until_staged)
    names = [c for c in df.columns if c not in set(drop or [])]
    checked = _as_written(df, names)
    keep = [F.col(f"`{c}`") for c in names] + [F.col("chunk")]
    # Sort last: the writer needs rows grouped by chunk, and (chunk, _idx) satisfies
    # that, so it adds no sort of its own that could reorder records within a chunk.
    tasks = writing_tasks(df.sparkSession, -(-rows // records_per_file))
    out = chunked.repartition(tasks, "chunk").sortWithinPartitions("chunk", "_idx").select(*keep)
    sent = Observation()
    if rows:
        marks = [fingerprint(checked).alias("fingerprint")] if checked else []
        out = out.observe(sent, F.count(F.lit(1)).alias("rows"), *marks)  # above the last shuffle: in the writing tasks
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.options(**CSV_DIALECT).option("sep", sep).partitionBy("chunk").csv(dest)
    versions.delete(df.sparkSession, chunked.scratch)
    if rows and sent.get["rows"] != rows:
        raise RuntimeError(f"{sent.get['rows']} of {rows} rows landed in {dest}")
    if rows and checked:
        spark = df.sparkSession
        row = (names, checked, sep, rows, sent.get["fingerprint"])
        schema = "columns array<string>, checked array<string>, sep string, rows bigint, fingerprint decimal(38,0)"
        spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(join_path(dest, CONTENT))
    return {"rows": rows, "chunks": -(-rows // records_per_file)}
