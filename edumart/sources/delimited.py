"""Delimited extracts (S1, S2, S3) and the file-order ordinal used by
keep-first de-duplication.

Extract files carry a header, ``;`` separators and Latin-1 text. They are
read with every column as text, then the wanted columns are picked **by
name** (files of different editions order their columns differently, and
Spark maps CSV columns by position when a schema is forced) and converted
with ``try_cast``; a value that is present but does not convert becomes NULL and,
with ``rejects=True``, its column is named in the row's ``REJECTED`` array, so the
same scan that types the rows also accounts for what it could not read.
The CSV parser only materialises the selected columns (CSV column pruning).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from edumart.functions.scalar import PANDAS_NA_TOKENS, null_if_token
from edumart.operators.dedupe import ORDINAL

LATIN1 = "ISO-8859-1"
REJECTED = "_rejected"
# what ``REJECTED`` holds for a record that is not as wide as the header, or broken otherwise
SHORT, LONG, BROKEN = "(too few fields)", "(too many fields)", "(broken record)"
_RECORD = "_corrupt_record_text"
_INTEGRAL = {"int", "integer", "bigint", "long", "smallint", "tinyint"}


def _convert(raw: Column, dtype: str, na_tokens, decimal_comma: bool) -> Column:
    s = null_if_token(raw, na_tokens) if na_tokens else raw
    t = dtype.lower()
    if t in ("string", "varchar"):
        return s
    if decimal_comma:
        s = F.regexp_replace(s, ",", ".")
    if t in _INTEGRAL:
        # an integral column written through a float (7 -> "7.0") still reads
        d = s.try_cast("double")
        return F.coalesce(s.try_cast(t), F.when(d == F.floor(d), d.try_cast(t)))
    return s.try_cast(t)


def _width_fault(record: Column, width: int, sep: str) -> Column:
    """What is wrong with a record the parser could not fit to the header (NULL: nothing)."""
    bare = F.regexp_replace(record, '"(?:[^"]|"")*"', "")
    fields = (F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep) + 1
    return F.when(record.isNotNull(), F.when(fields < width, F.lit(SHORT)).when(fields > width, F.lit(LONG)).otherwise(F.lit(BROKEN)))


def with_file_ordinal(df: DataFrame, name: str = ORDINAL) -> DataFrame:
    """Attach a total order equal to file order: (file path, split start,
    position inside the split). Must be applied directly on a file scan.
    Rows inside a split are read in order and splits are ordered by their
    start offset, so the ordinal is stable under retries and any split size."""
    return df.withColumn(name, F.struct(
        F.col("_metadata.file_path").alias("f"),
        F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("r")))


def read_delimited(spark: SparkSession, path: str | Sequence[str],
                   columns: Sequence[tuple[str, str]] | Mapping[str, str],
                   sep: str = ";", encoding: str = LATIN1, header: bool = True,
                   na_tokens: Sequence[str] | None = PANDAS_NA_TOKENS,
                   decimal_comma: bool = False, ordinal: bool = False,
                   multiline: bool = False, extra: Mapping[str, Column] | None = None,
                   missing: str = "error", rejects: bool = False) -> DataFrame:
    """Read one relation from delimited text.

    ``columns``: (name, Spark SQL type) pairs; names must exist in the header.
    All files of one call must share one header: a file whose header differs
    from the first one's fails the read. Such files are read one call each and
    stacked with ``union_editions``, as ``read_extracts`` does.
    ``na_tokens``: exact strings read as missing (default: the pandas set).
    ``ordinal``: add the file-order ordinal column (for keep-first de-dup).
    ``multiline``: quoted fields with newlines (makes each file one split).
    ``missing``: ``"error"`` (default) fails on a column absent from the
    header; ``"null"`` reads it as a typed NULL (older editions of a
    registry may lack newer columns).
    ``rejects``: add the array ``REJECTED`` of the columns whose value is present
    in the text but has not the declared type, and of ``SHORT``, ``LONG`` or
    ``BROKEN`` for a record without as many fields as the header (its first fields
    are read, missing ones are NULL). All fields are tokenised then, since a
    record's width shows in no single column.
    """
    cols = list(columns.items()) if isinstance(columns, Mapping) else list(columns)
    paths = path if isinstance(path, str) else list(path)
    reader = (spark.read.option("header", header).option("sep", sep)
              .option("encoding", encoding).option("quote", '"').option("escape", '"')
              .option("inferSchema", False).option("mode", "PERMISSIVE").option("enforceSchema", False)
              .option("multiLine", multiline))
    raw = reader.csv(paths)
    names = raw.columns
    if rejects:
        raw = (reader.option("columnPruning", False).option("columnNameOfCorruptRecord", _RECORD)
               .schema(StructType([*raw.schema.fields, StructField(_RECORD, StringType())])).csv(paths))
    absent = [c for c, _ in cols if c not in raw.columns]
    if absent and missing != "null":
        raise ValueError(f"{path}: columns missing from header: {absent}")
    if ordinal:
        raw = with_file_ordinal(raw)
    out = [(F.lit(None).cast(t) if c in absent
            else _convert(F.col(f"`{c}`"), t, na_tokens, decimal_comma)).alias(c) for c, t in cols]
    if rejects:
        typed = [(c, F.col(f"`{c}`"), e) for (c, t), e in zip(cols, out)
                 if c not in absent and t.lower() not in ("string", "varchar")]
        out.append(F.array_compact(F.array(_width_fault(F.col(_RECORD), len(names), sep), *[
            F.when((null_if_token(raw_c, na_tokens) if na_tokens else raw_c).isNotNull() & e.isNull(), F.lit(c))
            for c, raw_c, e in typed])).cast("array<string>").alias(REJECTED))
    if ordinal:
        out.append(F.col(ORDINAL))
    for name, expr in (extra or {}).items():
        out.append(expr.alias(name))
    return raw.select(*out)


def write_delimited(df: DataFrame, path: str, sep: str = ";", encoding: str = LATIN1,
                    header: bool = True, mode: str = "overwrite") -> None:
    (df.write.mode(mode).option("header", header).option("sep", sep)
     .option("encoding", encoding).option("quote", '"').option("escape", '"').csv(path))


def read_mart(spark: SparkSession, path: str, columns: Sequence[tuple[str, str]] | None = None,
              fmt: str = "csv") -> DataFrame:
    """Read a published mart (S2). CSV marts are UTF-8 with ``,``; the
    original re-read them as Latin-1 and corrupted every accent, which is
    not reproduced."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in columns]) if columns else df
    raw = (spark.read.option("header", True).option("encoding", "UTF-8")
           .option("quote", '"').option("escape", '"').option("inferSchema", False).csv(path))
    if columns is None:
        return raw
    return raw.select(*[_convert(F.col(f"`{c}`"), t, PANDAS_NA_TOKENS, False).alias(c)
                        for c, t in columns])
