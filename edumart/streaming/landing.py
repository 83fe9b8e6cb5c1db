"""Incremental landing of extract files into the lake (the landing chain's
"select the wanted files and move them into the run-date layer").

A Structured Streaming file source watches a landing folder; each trigger
picks up only files it has not seen (the source log in the checkpoint
records them), converts the wanted columns by name, tags the edition from
the file name and appends Parquet to ``<lake>/bronze/<name>`` partitioned by
``date`` and ``edition``. With ``Trigger.AvailableNow`` a run lands
everything present and stops, so the job can be scheduled like a batch job
and rerun after a failure without landing a file twice.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from edumart.sources.delimited import LATIN1, _convert
from edumart.functions.scalar import PANDAS_NA_TOKENS, qcol
from edumart.plans.marts import ExtractLayout, expected_files, read_relation
from edumart.schemas import EDITION, QUESTIONS, Question
from edumart.session import checkpoint_root
from edumart.sources.layers import write_layer

EDITION_FROM_NAME = r"(\d{4})"


def extract_stream(spark: SparkSession, landing_dir: str, header: Sequence[str],
                   columns: Sequence[tuple[str, str]], glob: str = "*[0-9][0-9][0-9][0-9]*.csv", sep: str = ";",
                   encoding: str = LATIN1, max_files_per_trigger: int | None = None,
                   na_tokens=PANDAS_NA_TOKENS) -> DataFrame:
    """Streaming read of delimited extracts. ``header``: every column of the
    files in order (a streaming source needs the full schema up front; a file
    whose header differs stops the query instead of landing swapped columns);
    ``columns``: the (name, type) pairs to keep; ``glob``: files without a year
    in their name are strays and not read."""
    schema = ", ".join(f"`{h}` string" for h in header)
    r = (spark.readStream.format("csv").schema(schema).option("header", True).option("enforceSchema", False)
         .option("sep", sep).option("encoding", encoding).option("quote", '"')
         .option("escape", '"').option("pathGlobFilter", glob))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.load(landing_dir)
    edition = F.regexp_extract(F.col("_metadata.file_name"), EDITION_FROM_NAME, 1).try_cast("int")
    return raw.select(*[_convert(qcol(c), t, na_tokens, False).alias(c) for c, t in columns],
                      edition.alias("edition"))


def land(df: DataFrame, lake_root: str, name: str, run_date: str,
         checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Append a streaming frame to the bronze layer; returns the running
    query (``awaitTermination()`` on it for an AvailableNow run)."""
    ckpt = checkpoint
    if ckpt is None:
        if not df.sparkSession.conf.get("spark.checkpoint.dir", None):
            raise ValueError("exactly-once landing needs a checkpoint folder that outlives this process")
        ckpt = f"{checkpoint_root(df.sparkSession)}/edumart-landing/{name}"
    w = (df.withColumn("date", F.lit(run_date)).writeStream.format("parquet")
         .outputMode("append").option("checkpointLocation", ckpt)
         .partitionBy("date", "edition"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(f"{lake_root.rstrip('/')}/bronze/{name}")


def file_patterns(spark: SparkSession, layout: ExtractLayout = ExtractLayout(),
                  questions: Sequence[Question] = QUESTIONS) -> list[tuple[str, str]]:
    """(relation, regular expression of its file names; group 1 is the edition)."""
    names = expected_files(spark, ["@@"], layout, questions, edition_type="string").collect()
    return [(r.relation, re.escape(r.file_name).replace("@@", r"(\d{4})", 1).replace("@@", r"\d{4}")) for r in names]


def land_arrivals(spark: SparkSession, landing_dir: str, lake_root: str, run_date: str, checkpoint: str,
                  layout: ExtractLayout = ExtractLayout(), questions: Sequence[Question] = QUESTIONS,
                  max_files_per_trigger: int = 100) -> StreamingQuery:
    """Land newly arrived extract files as ``land_extracts`` would, so
    ``read_landed_extracts`` reads them.

    The stream carries file names only; each file named as the layout says is
    read with its own header, by column name and with its file order, and
    replaces its (relation, edition) partition. A repeated trigger therefore
    lands nothing twice. Other files are strays and left alone."""
    patterns = file_patterns(spark, layout, questions)

    def arrived(files: DataFrame, _: int) -> None:
        # at most max_files_per_trigger names
        names = [r.n for r in files.select(F.element_at(F.split("path", "/"), -1).alias("n")).collect()]
        found: dict[str, set[int]] = {}
        for relation, pattern in patterns:
            for n in names:
                if m := re.fullmatch(pattern, n):
                    found.setdefault(relation, set()).add(int(m.group(1)))
        for relation, editions in found.items():
            df = read_relation(spark, landing_dir, relation, sorted(editions), layout, questions)
            write_layer(df, lake_root, "silver", f"extracts/{relation}", run_date, [EDITION], keep_other_partitions=True)

    files = (spark.readStream.format("binaryFile")
             .schema("path string, modificationTime timestamp, length bigint, content binary")
             .option("maxFilesPerTrigger", max_files_per_trigger).load(landing_dir).select("path"))
    return (files.writeStream.foreachBatch(arrived).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def parquet_stream(spark: SparkSession, path: str, schema: str, glob: str | None = None) -> DataFrame:
    r = spark.readStream.format("parquet").schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)
