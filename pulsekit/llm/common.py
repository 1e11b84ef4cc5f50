"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but these six characters; `bytes.split()` cuts at exactly the same six.
WORD = r"[^\x20\x09-\x0D]+"

_local_folder: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only a local session that names none gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="pulsekit-llm-")
    return _local_folder[app]


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/pulsekit-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name the frame does not have yet, whatever its own columns are called."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(text: Column | str) -> Column:
    """A text as its UTF-8 bytes."""
    return (F.col(text) if isinstance(text, str) else text).cast("binary")


def word_count(text: Column | str) -> Column:
    """Words of a text, computed in the JVM; NULL counts as none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of an id as text, modulo `folds`; a NULL id counts as the empty text."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")
