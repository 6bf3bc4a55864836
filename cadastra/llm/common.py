"""Shared helpers: staging of intermediate tables, word splitting and identifiers.

A word is a maximal run of characters other than space and U+0009..U+000D. On UTF-8 bytes, ``bytes.split()`` cuts at
exactly these six characters, so Python code here works on the undecoded bytes wherever it can.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six separators of words, as the body of a regular expression's class (Java, RE2 and Python read it alike).
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\v\f\r"
#: A word, and a run of separators.
WORD_RE, SPACE_RE = f"[^{SPACE}]+", f"[{SPACE}]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one in local mode only."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set; a cluster needs a folder that all its machines share")
    path = "file://" + tempfile.mkdtemp(prefix="cadastra-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete the files of a staged table that no later step reads."""
    path = getattr(df, "_staged_path", None)
    if path:
        sc = df.sparkSession.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)).cast("long"), F.lit(0).cast("long"))


def text_bytes(text: str) -> Column:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def spread(spark: SparkSession, rows_hint: int | None = None) -> int:
    """Partition count for an explicit repartition: the session's own setting, which grows with the cluster's input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi join on keys of equal names where null meets null; the result has left's keys only."""
    named = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    return left.join(named, on, how).drop(*[f"__right_{k}" for k in keys])
