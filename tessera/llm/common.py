"""Session settings, checkpoints and names shared by the operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The folder named in spark.checkpoint.dir is used. Where none is set, a session on one machine has a
    temporary one; on a cluster that is an error, since no folder is known to be shared."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints"))


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder: lineage ends there, and lost executors cost nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def measured(df: DataFrame, rows: int = 50_000) -> tuple[DataFrame, int]:
    """checkpointed(df) in as few partitions as hold so many rows each, and its number of rows. A
    small table is then not dealt out by very many tasks, each with files of its own."""
    df = checkpointed(df)
    n = df.count()
    return df.coalesce(max(1, -(-n // rows))), n


def compacted(df: DataFrame, rows: int = 50_000) -> DataFrame:
    return measured(df, rows)[0]


#: Words of 64 bits of a sieve, as a power of two: it is sent to all executors, 16 bytes a word at most.
SIEVE = 20


def sifted(df: DataFrame, wanted: DataFrame, *keys: str, flag: str = "_likely") -> DataFrame:
    """Adds flag to df: true for all rows whose keys are those of a row of wanted, and for few others,
    as long as wanted has few million rows; more of them fill the sieve, which then lets more through."""
    names = f"{flag}_word", f"{flag}_bits"
    hash_ = F.xxhash64(*[F.col(k) for k in keys])
    word, bit = F.shiftrightunsigned(hash_, 64 - SIEVE), hash_.bitwiseAND(F.lit(63)).cast("int")
    sieve = wanted.groupBy(word.alias(names[0])).agg(F.bit_or(F.expr("shiftleft(1L, cast(xxhash64(" + ", ".join(f"`{k}`" for k in keys) + ") & 63 AS int))")).alias(names[1]))
    joined = df.join(F.broadcast(compacted(sieve, 200_000)), word == F.col(names[0]), "left")
    return joined.withColumn(flag, F.coalesce(F.getbit(names[1], bit) == 1, F.lit(False))).drop(*names)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def kept(keep, *own: str) -> list[str]:
    """Columns to carry along: not those whose names are the result's own, which win."""
    return [c for c in keep or [] if c not in own]


def free_name(taken, name: str) -> str:
    """name, or with more before it, such that no name of taken begins with it."""
    while any(c.startswith(name) for c in taken):
        name = f"_{name}"
    return name


#: A UTF-8 byte count, a null being empty.
def n_bytes(column: str):
    return F.coalesce(F.octet_length(F.col(column)), F.lit(0)).cast("long")


_BLANKS = " \t\n\x0b\x0c\r"


def n_words(column: str):
    """Words in the sense of the contracts: runs of anything but ASCII white space. Splitting makes
    one object a word; regexp_count makes several."""
    bare = F.btrim(F.col(column), F.lit(_BLANKS))
    return F.when(bare != "", F.size(F.split(bare, "[\\x20\\x09-\\x0D]+"))).otherwise(0).cast("long")
