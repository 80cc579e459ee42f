"""Raw CSV source (bronze).

* columns are matched by the names in the header: any order, columns beyond the known ones are
  carried through, a missing known column stops the read with its name, and files whose headers
  differ fail instead of mixing silently;
* every column is read as text (no inference pass, nothing rejected for a bad value);
* pandas' null tokens become NULL (configurable);
* numeric columns are typed with ``try_cast`` (bad numbers -> NULL, never an error);
* every row gets an ingest-order key (file, split start, row position inside the split), so
  "keep the first duplicate" / "first seen" mean first in file order, even across many
  files/splits (cleaning drops the key from the silver tables);
* quotes inside quoted fields are doubled (""), as pandas writes them;
* quoted fields may hold line breaks: a first pass over the lines finds the files in which a line ends
  inside quotes, and only these are read by one task each; the others stay split
  (``ChurnParams.csv_multiline`` turns this off, or on for every file);
* a record that doesn't have the header's fields is counted by ``malformed_rows``.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens import schemas as S
from churnlens.functions.text import null_tokens_to_null
from churnlens.params import ChurnParams


def type_raw(df: DataFrame, table: str, params: ChurnParams) -> DataFrame:
    """Null tokens -> NULL, then typed columns via try_cast. Extra columns are carried through."""
    cols = []
    for name in df.columns:
        if name == S.INGEST_ORDER:
            cols.append(F.col(name))
            continue
        c = null_tokens_to_null(F.col(name), params.tokens_for(table, name))
        dtype = S.raw_type(table, name)
        if dtype.simpleString() != "string":
            c = c.try_cast(dtype)
        cols.append(c.alias(name))
    return df.select(*cols)


CORRUPT = "_corrupt_record"


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first file's header (its first line alone is read)."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def csv_schema(spark: SparkSession, path: str, table: str) -> T.StructType:
    """All-text schema in the order of the files' header, with a column for malformed lines."""
    names = _header(spark, path)
    missing = [c for c in S.RAW_COLUMNS[table] if c not in names]
    if missing:
        raise ValueError(f"{path}: {table} lacks the columns {', '.join(missing)}")
    return T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])


def _one_form(file: str) -> str:
    """A file's name without an empty authority: file:///x and file:/x are the same."""
    return re.sub(r"^(\w+):///", r"\1:/", file)


def files_with_open_quotes(spark: SparkSession, path: str) -> list[str]:
    """The files with a line that holds an odd number of quotes: there a field goes on in the next line (or
    a stray quote stands, which reading the file whole doesn't harm). One narrow pass over the lines; what
    comes to the driver are names of files that it lists anyway."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_count("value", F.lit('"')).alias("quotes"))
    return sorted(r["file"] for r in lines.where(F.col("quotes") % 2 == 1).select("file").distinct().collect())


def _read_text(spark: SparkSession, path: str, table: str, params: ChurnParams, whole_lines: bool = False) -> DataFrame:
    """Known columns in their usual order, then the others, then the text of a malformed record. With
    ``whole_lines`` a record's fields are all parsed even where few are used, so that it is judged whole."""
    schema = csv_schema(spark, path, table)
    known = list(S.RAW_COLUMNS[table])
    others = [f.name for f in schema.fields if f.name not in (*known, CORRUPT)]

    def rows(paths, multiline: bool) -> DataFrame:
        df = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
              .option("multiLine", multiline).option("enforceSchema", False).option("columnPruning", not whole_lines)
              .option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(paths))
        return df.select(*known, *others, CORRUPT, F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("pos")).alias(S.INGEST_ORDER))

    if params.csv_multiline is not None:
        return rows(path, params.csv_multiline)
    whole = files_with_open_quotes(spark, path)
    if not whole:
        return rows(path, False)
    split = sorted({_one_form(f) for f in spark.read.text(path).inputFiles()} - {_one_form(f) for f in whole})
    parts = ([rows(split, False)] if split else []) + [rows(whole, True)]
    return reduce(DataFrame.unionByName, parts)


def read_raw_csv(spark: SparkSession, path: str, table: str, params: ChurnParams | None = None) -> DataFrame:
    params = params or ChurnParams()
    return type_raw(_read_text(spark, path, table, params).drop(CORRUPT), table, params)


def read_raw_text(spark: SparkSession, path: str, table: str, params: ChurnParams | None = None) -> DataFrame:
    """The raw file with every value as text, before null tokens and types are applied."""
    return _read_text(spark, path, table, params or ChurnParams()).drop(CORRUPT, S.INGEST_ORDER)


def malformed_rows(spark: SparkSession, raw_dir: str, params: ChurnParams | None = None) -> DataFrame:
    """table_name, keyed_rows, malformed_rows: lines with a first field or malformed, and the
    malformed ones, which don't have the header's fields. (Spark reads the column of malformed lines
    only beside another one.)"""
    params, base = params or ChurnParams(), raw_dir.rstrip("/")
    counts = [_read_text(spark, f"{base}/{S.RAW_FILES[t]}", t, params, whole_lines=True)
              .agg(F.count_if(F.col(S.RAW_COLUMNS[t][0]).isNotNull() | F.col(CORRUPT).isNotNull()).alias("keyed_rows"),
                   F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed_rows"))
              .select(F.lit(t).alias("table_name"), "keyed_rows", "malformed_rows") for t in S.TABLES]
    return reduce(DataFrame.unionByName, counts)


def null_token_hits(text: DataFrame, table: str, params: ChurnParams | None = None) -> DataFrame:
    """Per column: how many non-empty values the null-token rule turns into NULL
    (table_name, column_name, token_hits). One aggregate over the text table."""
    params = params or ChurnParams()
    cols = [c for c in text.columns if c != S.INGEST_ORDER]
    row = text.agg(*[F.count_if(F.col(c).isin([t for t in params.tokens_for(table, c) if t != ""])).alias(c)
                     for c in cols])
    return (row.unpivot([], cols, "column_name", "token_hits")
            .select(F.lit(table).alias("table_name"), "column_name", "token_hits"))


def read_raw_tables(spark: SparkSession, raw_dir: str, params: ChurnParams | None = None) -> dict[str, DataFrame]:
    base = raw_dir.rstrip("/")
    return {t: read_raw_csv(spark, f"{base}/{S.RAW_FILES[t]}", t, params) for t in S.TABLES}
