"""Shards of stable keys by jump consistent hashing, in DataFrame functions only; no ring table is kept.

``jump`` follows one pseudo-random sequence per key (a 64-bit linear congruential generator seeded
with it) from shard count to shard count at which the key would move, and stops before the first
count beyond the present one.  It returns that stop as well: a key whose ``moves`` is ``m`` stays where
it is until there are ``m + 1`` shards, and then goes to shard ``m``.  So appending a shard moves
only the rows whose ``moves`` is the old count, about one in ``shards + 1``.

``write`` puts all rows, with all their columns, into a folder of Parquet files per shard; rows are
not shuffled, each task writes its own files, so neither a hot key nor copies gather anywhere but in
the key's shard.  ``grow`` appends the files of the rows that move, and writes nothing else again;
readers of the grown folder pass over their old places by ``moves``.  Growing is repeatable: a
generation is a folder of its own that is replaced as a whole.  ``read`` returns the rows of a
generation, ``number`` a gapless position in each shard: a prefix sum over files plus the position in
the file, so the unit of work is one task's file and never a shard.

Keys: one integer column is the generator's seed itself; other columns, or several, go through
``xxhash64`` first.  A null key counts as ``xxhash64``'s value of a null.  Rows with equal keys,
repeated rows among them, share a shard.  Rows keep their columns in a struct, so their names cannot
clash with the operator's; an empty table gives an empty folder that reads as no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MULTIPLIER = 2862933555777941757  # fixed value of the published generator
_LOW = (1 << 32) - 1


def _low_product(x: Column, by: int) -> Column:
    """The low 32 bits of a product of 32-bit numbers, without passing 63 bits."""
    return (x.bitwiseAND(0xFFFF) * F.lit(by) + F.shiftleft((F.shiftright(x, 16) * F.lit(by)).bitwiseAND(0xFFFF), 16)).bitwiseAND(F.lit(_LOW))


def _step(s: Column) -> Column:
    """The next jump: state times the multiplier plus one, modulo 2 to the 64, in halves of 32 bits."""
    low, high = MULTIPLIER & _LOW, MULTIPLIER >> 32
    upper = F.shiftright(s["lo"], 16) * F.lit(low)
    total = s["lo"].bitwiseAND(0xFFFF) * F.lit(low) + F.shiftleft(upper.bitwiseAND(0xFFFF), 16) + F.lit(1).cast("long")
    hi = (F.shiftright(total, 32) + F.shiftright(upper, 16) + _low_product(s["hi"], low) + _low_product(s["lo"], high)).bitwiseAND(F.lit(_LOW))
    reach = F.lit(2.0**31) / (F.shiftright(hi, 1) + 1).cast("double")
    return F.struct(s["j"].alias("b"), F.floor((s["j"] + 1).cast("double") * reach).alias("j"), hi.alias("hi"), total.bitwiseAND(F.lit(_LOW)).alias("lo"))


def jump(key: Column, shards: int) -> Column:
    """struct(shard, moves) of a 64-bit key: its shard of ``shards``, and the next shard it will jump to.

    A key jumps about ln(shards) times; every jump goes at least one shard further, so the two nested
    loops of a square root of steps reach any count, and leave off as soon as the key is past it."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    steps = F.sequence(F.lit(1), F.lit(math.isqrt(shards - 1) + 1))
    past = lambda s, step: F.when(s["j"] >= F.lit(shards), s).otherwise(step(s))
    start = F.struct(
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"), F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(_LOW)).alias("lo")
    )
    some = lambda s: F.aggregate(steps, s, lambda x, _: past(x, _step))
    end = lambda s: F.struct(s["b"].cast("int").alias("shard"), s["j"].alias("moves"))
    return F.aggregate(steps, start, lambda s, _: past(s, some), end)


def key_of(df: DataFrame, keys: list[str]) -> Column:
    """The 64-bit key of the named columns."""
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, T.IntegralType):
        return F.coalesce(df[keys[0]].cast("long"), F.xxhash64(F.lit(None).cast("long")))
    return F.xxhash64(*(df[k] for k in keys))


def _generation(path: str, shards: int) -> str:
    return f"{path}/rows/shards={shards}"


def write(df: DataFrame, path: str, shards: int, keys: list[str]) -> None:
    """Put every row of ``df`` into the folder of its shard below ``path``."""
    placed = df.select(F.struct(*(df[c] for c in df.columns)).alias("row"), key_of(df, keys).alias("key")).withColumn("at", jump(F.col("key"), shards))
    placed = placed.select("row", "key", F.col("at.moves").alias("moves"), F.col("at.shard").alias("shard"))
    placed.limit(0).write.mode("overwrite").parquet(f"{path}/schema")
    placed.write.mode("overwrite").partitionBy("shard").parquet(_generation(path, shards))


def grow(spark: SparkSession, path: str, shards: int, to: int) -> None:
    """Append shards ``shards`` to ``to - 1``: only rows that one of them takes are written."""
    if to <= shards:
        raise ValueError("a folder can only grow")
    moving = _held(spark, path, shards).where(F.col("moves") < to).withColumn("at", jump(F.col("key"), to))
    moving = moving.select("row", "key", F.col("at.moves").alias("moves"), F.col("at.shard").alias("shard"))
    moving.write.mode("overwrite").partitionBy("shard").parquet(_generation(path, to))


def _held(spark: SparkSession, path: str, shards: int) -> DataFrame:
    """The stored rows that are in force at ``shards``, with their files' metadata."""
    place = spark._jvm.org.apache.hadoop.fs.Path(_generation(path, shards))
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        raise ValueError(f"the folder was never written for {shards} shards")
    schema = spark.read.parquet(f"{path}/schema").schema.add("shards", T.IntegerType())
    return spark.read.schema(schema).parquet(f"{path}/rows").where((F.col("shards") <= shards) & (F.col("moves") >= shards))


def read(spark: SparkSession, path: str, shards: int) -> DataFrame:
    """(row, shard, moves, file, place) of every row; ``shards`` is a count that the folder was written or grown to.

    ``row`` is a struct of the row's own columns; file and place say where it is stored."""
    return _held(spark, path, shards).select("row", "shard", "moves", F.concat_ws("/", "shards", "_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"))


def number(rows: DataFrame) -> DataFrame:
    """``rows`` of ``read``, projected at will, with ``slot`` from 0 in each shard in place of file and place."""
    files = rows.groupBy("shard", "file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy("file")) - F.col("_n")  # one row a file
    files = files.select("shard", "file", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy("shard", "file").orderBy("place")) - 1
    return rows.withColumn("_within", within).join(files, ["shard", "file"]).withColumn("slot", F.col("_before") + F.col("_within")).drop("_before", "_within", "file", "place")


def digests(df: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``df`` into shards and read it back: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = df.sparkSession
    write(df, path, shards, [id_col])
    text = F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))
    rows = read(spark, path, shards).select(
        F.col("row")[id_col].alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), "shard", "moves", "file", "place"
    )
    grown = F.when(F.col("moves") == shards, F.lit(shards)).otherwise(F.col("shard")).cast("int")
    return number(rows).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", grown.alias("grown_shard"))
