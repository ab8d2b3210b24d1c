"""Records of quoted multi-line CSV files, read in parallel.

A line break inside quotes belongs to the record, so where a byte range of a file begins, inside quotes or not, depends
on everything before it. Spark's CSV source therefore reads a ``multiLine`` file in one task. Here a file is read as
physical lines, split by bytes like any text. Each line is a function on the two states a line can begin in (outside or
inside quotes): it keeps the state, sets it, or turns it over. Such functions compose, so

1. one scan writes every line with its split, its place in the split, its start state and the first line of its record,
   each for both states the split may begin in (windows inside a split);
2. a prefix scan over one row per split, the composed function of its lines, gives the state every split begins in;
3. lines that begin outside quotes begin records; the few records that have several lines are put together, and
   Spark's CSV parser reads each record (``from_csv``).

Order is kept: a record carries file, split and line of its beginning (:data:`ORDER`).

Lines end with ``\\n`` or, where a file's first line does, with ``\\r\\n``, which is then read as ``\\n`` inside quotes
too, as Spark's reader does. Empty records are skipped. The header is every file's first record and must be the
expected one, or the scan raises. Quotes inside an unquoted field are plain characters and end no field, as in Spark's
reader. A quoted field that is never closed makes one record of the rest of the file: beyond ``max_record`` characters
that raises instead of gathering it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlake import versions
from crashlake.config import scratch_path
from crashlake.sources.csv import CSV_DIALECT, read_csv

#: Columns that give the order of the source: file, split and line of the record's beginning.
ORDER = ["_file", "_split", "_line"]
MAX_RECORD = 64 << 20


def _ends_inside(value: Column, sep: str) -> tuple[Column, Column]:
    """Does a line end inside quotes, if it begins outside, and if it begins inside?"""
    s = re.escape(sep)
    quoted = '[^"]*+(?:""[^"]*+)*+'  # up to the closing quote
    tail = f"[^{s}]*+"  # what follows a closing quote is plain, up to the separator
    fields = f'(?:(?:"{quoted}"{tail}|[^"{s}]{tail}|){s})*+'
    opened = f'{fields}"{quoted}$'
    has_quote = F.contains(value, F.lit('"'))
    one_quoted = f"(?s)^{quoted}"
    outside = has_quote & value.rlike(f"(?s)^{opened}")
    inside = ~has_quote | value.rlike(f"{one_quoted}$") | value.rlike(f'{one_quoted}"{tail}{s}{opened}')
    return outside, inside


def _lines(spark: SparkSession, path: str | list[str], sep: str) -> DataFrame:
    """Physical lines with file, split, place and end states; places grow along a split."""
    raw = (
        spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(path)
    )
    outside, inside = _ends_inside(F.col("value"), sep)
    return raw.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_line"),
        "value",
        outside.cast("int").alias("e0"),
        inside.cast("int").alias("e1"),
    )


def _state(begins: int, before) -> Column:
    """State after the rows of the window ``before``, each a function (e0, e1), if the first one begins in ``begins``."""
    sets = F.col("e0") == F.col("e1")
    turned = F.coalesce(F.sum(F.when((F.col("e0") == 1) & (F.col("e1") == 0), 1)).over(before), F.lit(0))
    # the last function that sets the state, and how many have turned it since
    last = F.max(F.when(sets, F.struct(F.col("_at"), F.col("e0").alias("to"), F.col("_turned").alias("turned")))).over(before)
    return F.when(last.isNull(), (F.lit(begins) + turned) % 2).otherwise((last["to"] + turned - last["turned"]) % 2).cast("int")


def _with_states(rows: DataFrame, partition: list[str], order: str) -> DataFrame:
    """Adds s0 and s1, the state every row begins in if its partition begins in 0 or 1."""
    upto = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.when((F.col("e0") == 1) & (F.col("e1") == 0), 1)
    counted = rows.withColumns({"_turned": F.coalesce(F.sum(turns).over(upto), F.lit(0)), "_at": F.col(order)})
    return counted.withColumns({"s0": _state(0, before), "s1": _state(1, before)}).drop("_turned", "_at")


def read_records(
    spark: SparkSession, path: str | list[str], sep: str, max_record: int = MAX_RECORD, own: bool = False
) -> tuple[DataFrame, list[str]]:
    """Raw text of every record but the headers, with :data:`ORDER`; and the header's column names.

    The records read their lines from the folder ``scratch`` of the frame, which whoever has read them for the last time deletes.
    With ``own`` the files under ``path`` (a file or folder) are the caller's scratch, deleted once their lines are there.
    """
    names = read_csv(spark, path, sep=sep).columns
    placed = _with_states(_lines(spark, path, sep), ["_file", "_split"], "_line")
    upto = Window.partitionBy("_file", "_split").orderBy("_line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = {f"r{s}": F.last(F.when(F.col(f"s{s}") == 0, F.col("_line")), ignorenulls=True).over(upto) for s in (0, 1)}
    staged = scratch_path(spark, "lines")
    placed.withColumns(first).write.option("compression", "zstd").parquet(staged)
    if own:
        versions.delete(spark, path)
    lines = spark.read.parquet(staged)

    # the function of a split is that of its last line, after the state that line begins in
    end = lambda s: F.max_by(F.when(F.col(f"s{s}") == 0, F.col("e0")).otherwise(F.col("e1")), "_line")
    splits = lines.groupBy("_file", "_split").agg(end(0).alias("e0"), end(1).alias("e1"), F.max("r0").alias("r0"), F.max("r1").alias("r1"))
    splits = _with_states(splits, ["_file"], "_split").withColumn("begins", F.col("s0"))  # a row per split
    last = F.when(F.col("begins") == 0, F.col("r0")).otherwise(F.col("r1"))
    opened = F.last(F.when(last.isNotNull(), F.struct("_split", last.alias("_line"))), ignorenulls=True)
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    # stored, so that Spark sees a row per split and leaves the lines where they are
    splits = _stored(splits.select("_file", "_split", "begins", opened.over(earlier).alias("opened")), "splits")

    own = F.when(F.col("begins") == 0, F.col("r0")).otherwise(F.col("r1"))
    starts = F.when(F.col("begins") == 0, F.col("s0")).otherwise(F.col("s1"))
    ends = F.when(starts == 0, F.col("e0")).otherwise(F.col("e1"))
    known = lines.join(splits, ["_file", "_split"]).select(
        "_file",
        F.when(own.isNull(), F.col("opened._split")).otherwise(F.col("_split")).alias("_split"),
        F.coalesce(own, F.col("opened._line")).alias("_line"),
        F.struct(F.col("_split").alias("split"), F.col("_line").alias("line"), "value").alias("part"),
        ((starts == 0) & (ends == 0)).alias("whole"),
    )
    several = known.where(~F.col("whole")).groupBy(*ORDER)
    sizes = several.agg(F.sum(F.length("part.value") + 1).alias("n")).agg(F.max("n")).head()[0] or 0
    if sizes > max_record:
        raise ValueError(f"a record of {sizes} characters: is a quoted field of {path} not closed?")
    joined = several.agg(F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["value"]), "\n").alias("record"))
    single = known.where("whole").select(*ORDER, F.col("part.value").alias("record"))
    records = single.unionByName(joined.select(*ORDER, "record"))

    heads = _stored(records.groupBy("_file").agg(F.min(F.struct("_split", "_line", "record")).alias("head")), "heads")  # a row per file
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    heads = heads.withColumn("crlf", F.substring_index("head.record", "\n", 1).rlike("^[^\r]*\r$"))
    text = F.regexp_replace(_unified("head.record"), "^\ufeff", "")
    parsed = heads.select("_file", F.from_csv(text, schema.simpleString()[7:-1].replace(":", " "), _options(sep, "PERMISSIVE")).alias("h"))
    wanted = F.array(*[F.lit(n) for n in names])
    other = parsed.where(F.array(*[F.col(f"h.c{i}") for i in range(len(names))]) != wanted).head(1)
    if other:
        raise ValueError(f"the header of {other[0]['_file']} is {list(other[0]['h'])}, not {names}")
    begin = heads.select("_file", "crlf", F.col("head._split").alias("_h_split"), F.col("head._line").alias("_h_line"))
    # a row per split, so that the records of one file need not meet in one task
    begin = _stored(splits.select("_file", "_split").join(begin, "_file"), "begin")
    body = records.join(begin, ["_file", "_split"]).where((F.col("_split") != F.col("_h_split")) | (F.col("_line") != F.col("_h_line")))
    out = body.select(*ORDER, _unified("record").alias("record")).where("record <> ''")
    out.scratch = staged
    return out, names


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _unified(record: str) -> Column:
    """A file whose first line ends with ``\\r\\n`` has these line ends, which become ``\\n``, inside quotes too."""
    return F.when(F.col("crlf"), F.regexp_replace(F.regexp_replace(record, "\r$", ""), "\r\n", "\n")).otherwise(F.col(record))


def _options(sep: str, mode: str, corrupt: str | None = None) -> dict[str, str]:
    # a record is given whole: its line ends are those inside quotes, none is to be guessed from it
    options = {k: v for k, v in CSV_DIALECT.items() if k != "header"} | {"sep": sep, "mode": mode, "lineSep": "\n"}
    return options | ({"columnNameOfCorruptRecord": corrupt} if corrupt else {})


def read_csv_records(
    spark: SparkSession, path: str | list[str], sep: str = ",", mode: str = "FAILFAST", corrupt: str | None = None,
    max_record: int = MAX_RECORD, own: bool = False,
) -> DataFrame:
    """What ``read_csv`` gives for the same files, in parallel inside a file, with the columns :data:`ORDER` after the source's.

    ``own`` is that of :func:`read_records`. With ``mode="PERMISSIVE"`` and a column name ``corrupt`` malformed records are kept in that column.
    """
    records, names = read_records(spark, path, sep, max_record, own)
    fields = [T.StructField(n, T.StringType()) for n in names] + ([T.StructField(corrupt, T.StringType())] if corrupt else [])
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in fields)
    parsed = records.select(*ORDER, F.from_csv("record", ddl, _options(sep, mode, corrupt)).alias("_r"))
    out = parsed.select(*[F.col("_r").getField(f.name).alias(f.name) for f in fields], *ORDER)
    out.scratch = records.scratch
    return out
