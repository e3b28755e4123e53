"""Multi-document corpus files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_corpus(spark: SparkSession, path: str, end_tag: str = "</DOC>", partitions: int | None = None) -> DataFrame:
    """One row per document of every file below ``path``: ``path, doc``.

    The end tag is the record separator of the scan, so plain files are split
    between tasks and no file is read whole; give the spelling most files use. Each
    record is then cut before every start tag in any spelling, so documents that
    close otherwise, or not at all, are found too. Compressed files cannot be split:
    pass ``partitions`` to spread their documents over the cluster after the scan.
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text(path, lineSep=end_tag)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("record"))
    )
    pieces = lines.select("path", F.explode(F.split("record", r"(?i)(?=<doc[\s>])")).alias("piece"))
    closed = F.regexp_extract("piece", r"(?is)^.*?</doc\s*>", 0)
    docs = pieces.where(F.col("piece").rlike(r"(?i)^<doc[\s>]")).select(
        "path", F.when(closed != "", closed).otherwise(F.concat("piece", F.lit(end_tag))).alias("doc")
    )
    return docs.repartition(partitions) if partitions else docs
