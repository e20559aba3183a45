"""Files as documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.convert import binary_document


def binary_documents(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(doc_id, source, path)`` per file: base64 content under a stable id.

    The id derives from the path, so reading the same folder again gives the same ids.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select(
        F.concat(F.lit("att-"), F.sha2("path", 256)).alias("doc_id"),
        binary_document(F.col("content")).alias("source"),
        "path",
    )


def file_rows(files: DataFrame, tenant: str, document_type: str) -> DataFrame:
    """Files of a tenant as rows that a document table merges: ``<tenant>_<type>_att-...``.

    The typed ``doc`` holds where the file was.  Null or blank tenants give no usable id, and such
    rows are set aside like any other.
    """
    owner = F.lit(tenant).cast("string")
    named = F.when(F.length(F.trim(owner)) > 0, F.concat_ws("_", owner, F.lit(document_type), "doc_id"))
    empty = F.lit(None).cast("bigint")
    return files.select(
        owner.alias("tenant"),
        named.alias("doc_id"),
        F.lit(None).cast("string").alias("parent_key"),
        "source",
        empty.alias("changed_at"),
        empty.alias("changed_seq"),
        F.lit(False).alias("deleted"),
        F.struct("path").alias("doc"),
        F.lit(True).alias("from_run"),
    )
