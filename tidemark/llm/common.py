"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; texts of ASCII alone take the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def documents(df: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone (null text: empty), so that no other column's name can clash."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share: ``spark.checkpoint.dir`` of the session.

    Where that is unset a temporary folder is made, but only for a local master, as in tests; a cluster without it is an error.
    """
    if spark.sparkContext.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        spark.sparkContext.setCheckpointDir(path or tempfile.mkdtemp(prefix="tidemark-"))
    return spark.sparkContext.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: compressed, and read by column."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: A key with more than this part of all rows is hot, so at most HOT keys are; its rows are dealt to SHARES tasks.
HOT, SHARES = 1000, 64


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], rows: str, total: int, how: str = "inner") -> DataFrame:
    """``left`` joined to ``right``, which has one row a key and in ``rows`` the number of rows that ``left`` has of it.

    Hot keys are split: their rows of ``left`` are dealt by a hash of the whole row, so that a task that is run again deals them in the same
    way, and their row of ``right`` is repeated for each share.  The table of hot keys has at most ``HOT`` rows, whatever the
    data: that is the bound on which it is broadcast.  Rows with a null key join nothing.  ``rows`` is not in the result.
    """
    hot = F.col(rows) * HOT > total
    shares = F.broadcast(right.where(hot).select(*keys, F.lit(SHARES).alias("__tm_shares")))
    dealt = left.join(shares, keys, "left").withColumn("__tm_share", F.when(F.col("__tm_shares").isNotNull(), F.pmod(F.xxhash64(*left.columns), F.lit(SHARES))).otherwise(0).cast("int")).drop("__tm_shares")
    copies = right.withColumn("__tm_share", F.explode(F.sequence(F.lit(0), F.when(hot, SHARES - 1).otherwise(0)))).drop(rows)
    return dealt.join(copies, [*keys, "__tm_share"], how).drop("__tm_share")
