"""CSV files: every value quoted, no header, one record per line break outside quotes.

A NULL is written as nothing between the commas and an empty text as ``""``, so the
two stay apart. Lines are built as a column expression and written as text: values
keep their blanks, backslashes and line breaks exactly.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepull.functions.names import qcol, quoted
from tablepull.functions.render import render
from tablepull.session import child_names, remove_path, rename_path

# Stands for NULL while reading; no text can hold it, as text has no NUL.
NULL_MARK = "\u0000"
# Files with line breaks inside values are read whole by one task, so none may grow large.
# A task writes what it reads, by default 128 MB of the source; a file is cut here at the latest.
RECORDS_PER_FILE = 100_000
# Bytes of a file that one task puts in its place.
PIECE_BYTES = 128 * 1024 * 1024
# A record of one column with its line break: a quoted value, or nothing, which is NULL.
ONE_VALUE = r'(?s)("[^"]*+(?:""[^"]*+)*+"|)\n'
MAY_HOLD_QUOTES = (T.StringType, T.ArrayType, T.MapType, T.StructType, T.VariantType)
READ_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "multiLine": "true",
    "nullValue": NULL_MARK,
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "maxCharsPerColumn": "-1",
}


def csv_lines(df: DataFrame, bool_style: str = "tf") -> DataFrame:
    """One CSV record per row, in the column ``value``.

    Only texts can hold a quote, so only they are searched for one. A row without NULLs,
    the common case, is put together at once; ``concat`` is NULL for all others.
    """
    quote, texts = F.lit('"'), []
    for field in df.schema.fields:
        text = render(qcol(field.name), field.dataType, bool_style)
        if isinstance(field.dataType, MAY_HOLD_QUOTES):
            text = F.replace(text, quote, F.lit('""'))
        texts.append(text)
    full = [piece for text in texts for piece in (F.lit('","'), text)][1:]
    cells = [F.coalesce(F.concat(quote, text, quote), F.lit("")) for text in texts]
    line = F.coalesce(F.concat(quote, *full, quote), F.concat_ws(",", *cells))
    return df.select(line.alias("value"))


@dataclass(frozen=True)
class ExportResult:
    rows: int
    last_value: str | None
    path: str | None


def write_csv(df: DataFrame, path: str, watermark: str | None = None, bool_style: str = "tf", records_per_file: int = RECORDS_PER_FILE, single_file: bool = False) -> ExportResult:
    """Writes the frame and counts it in the same job; with the largest value of ``watermark``.

    An empty frame leaves no files. With ``single_file`` many tasks write their parts, which are then
    put together to one file in the frame's order; see ``join_files``.
    """
    observation = Observation()
    measures = [F.count(F.lit(1)).alias("rows")]
    if watermark is not None:
        data_type = next(f.dataType for f in df.schema.fields if f.name == watermark)
        measures.append(render(F.max(qcol(watermark)), data_type).alias("last_value"))
    observed = df.observe(observation, *measures)
    lines = csv_lines(observed, bool_style)
    target = f"{path.rstrip('/')}.parts" if single_file else path
    lines.write.mode("overwrite").option("maxRecordsPerFile", 0 if single_file else records_per_file).text(target)
    facts = observation.get
    if not facts["rows"]:
        remove_path(df.sparkSession, target)
        remove_path(df.sparkSession, path)
    elif single_file:
        join_files(df.sparkSession, target, path)
    return ExportResult(facts["rows"], facts.get("last_value"), path if facts["rows"] else None)


def join_files(spark: SparkSession, parts: str, path: str) -> None:
    """Puts the files of the folder ``parts``, which goes, behind each other into one file in the folder ``path``.

    In a file system that all executors mount, each task copies a stretch of at most ``PIECE_BYTES`` to its place,
    again with the same outcome if it is repeated. Others, such as HDFS, must be able to join files by name.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(parts)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    at = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{parts}/{name}")
    sizes = [(name, files.getFileStatus(at(name)).getLen()) for name in sorted(child_names(spark, parts)) if name.startswith("part-")]
    sizes = [(name, size) for name, size in sizes if size]
    remove_path(spark, path)
    first = sizes[0][0]
    if len(sizes) == 1 or files.getUri().getScheme() != "file":
        if len(sizes) > 1:
            others = spark._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(sizes) - 1)
            for i, (name, _) in enumerate(sizes[1:]):
                others[i] = at(name)
            files.concat(at(first), others)
        files.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(path))
        rename_path(spark, f"{parts}/{first}", f"{path}/{first}")
    else:
        source, target = folder.toUri().getPath(), spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()
        pieces, place = [], 0
        for name, size in sizes:
            pieces += [(f"{source}/{name}", start, min(PIECE_BYTES, size - start), place + start) for start in range(0, size, PIECE_BYTES)]
            place += size

        def copy(piece: tuple[str, int, int, int]) -> None:
            import os

            name, start, left, to = piece
            os.makedirs(target, exist_ok=True)
            out = os.open(f"{target}/{first}", os.O_CREAT | os.O_WRONLY, 0o644)
            try:
                with open(name, "rb") as file:
                    file.seek(start)
                    while left:
                        data = file.read(min(left, 1 << 22))
                        if not data:
                            raise OSError(f"{name} is shorter than it was.")
                        left -= len(data)
                        while data:
                            done = os.pwrite(out, data, to)
                            to, data = to + done, data[done:]
            finally:
                os.close(out)

        spark.sparkContext.parallelize(pieces, len(pieces)).foreach(copy)
        found = files.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{first}")).getLen()
        if found != place:
            raise RuntimeError(f"{path} holds {found} bytes, its parts hold {place}.")
    remove_path(spark, parts)


def read_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Files written by ``write_csv``, every column as text.

    In files of one column a NULL is an empty line, which the CSV source would skip: these
    are cut into records here, a file in a task as with any file whose values hold line breaks.
    """
    if len(columns) == 1:
        whole = spark.read.text(path, wholetext=True)
        records = whole.select(F.explode(F.regexp_extract_all("value", F.lit(ONE_VALUE), F.lit(1))).alias("r"))
        value = F.replace(F.expr("substring(r, 2, length(r) - 2)"), F.lit('""'), F.lit('"'))
        return records.select(F.when(F.col("r") != "", value).alias(columns[0]))
    schema = ", ".join(f"{quoted(name)} STRING" for name in columns)
    return spark.read.options(**READ_OPTIONS).schema(schema).csv(path)


def check_arity(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Records per file; how many have too few or too many values; how many have none at all."""
    schema = ", ".join(f"{quoted(name)} STRING" for name in [*columns, "_corrupt_record"])
    records = (
        spark.read.options(**READ_OPTIONS)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .schema(schema)
        .csv(path)
    )
    values = [qcol(name) for name in columns]
    blank = F.coalesce(*values, F.lit(None)).isNull()
    # The length keeps every value in the scan: a record is checked in full only if all
    # its values are read.
    bad = F.col("_corrupt_record").isNotNull() & (F.length(F.concat_ws("", *values)) >= 0)
    return (
        records.select(F.input_file_name().alias("file"), bad.alias("bad"), (blank & ~bad).alias("blank"))
        .groupBy("file")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if("bad").alias("bad_records"),
            F.count_if("blank").alias("blank_records"),
        )
    )


def write_document(spark: SparkSession, document: Any, path: str) -> None:
    """A small JSON document (a manifest or a state) as a one-line text folder."""
    text = document if isinstance(document, str) else json.dumps(document)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> Any:
    return json.loads(spark.read.text(path).first()["value"])
