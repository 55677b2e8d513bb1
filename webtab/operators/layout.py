"""Tables divided by a key, and a filter of addresses, for joins that are repeated step by step."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webtab.session import scratch_path


class Divided:
    """A growing table in the scratch area, bucketed by ``key``: a join on it moves the other side only.

    The session's catalog knows the table until ``forget``; its files stay with the run. ``level`` names a column of small whole
    numbers by which the files are divided as well, so that one value of it is read alone.
    """

    def __init__(self, spark: SparkSession, label: str, key: str, level: str | None = None) -> None:
        self.spark, self.key, self.level = spark, key, level
        self.path = scratch_path(spark, label)
        self.name = f"webtab_{label.replace('-', '_')}_{uuid.uuid4().hex}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.schema: T.StructType | None = None

    def append(self, df: DataFrame) -> None:
        """Rows go to the bucket of their key; a third of all rows may not share one (divide such a key before)."""
        writer = df.repartition(self.key).write.mode("append").format("parquet").option("path", self.path).bucketBy(self.buckets, self.key)
        (writer.partitionBy(self.level) if self.level else writer).saveAsTable(self.name)
        if self.level:
            # the planner takes the size of such a table from the catalog
            self.spark.sql(f"ANALYZE TABLE {self.name} COMPUTE STATISTICS NOSCAN")
        self.schema = df.schema

    def read(self, keys: list[str] | None = None) -> DataFrame:
        """The table so far, or the rows of a few keys, whose buckets alone are read."""
        table = self.spark.table(self.name)
        return table if keys is None else table.filter(F.col(self.key).isin(keys))

    def files(self) -> DataFrame:
        """The rows as plain files, which are there after ``forget``."""
        return self.spark.read.schema(self.schema).parquet(self.path)

    def forget(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


class AddressFilter:
    """A Bloom filter of one hash and a fixed number of bits: what it does not hold was surely never added.

    It is kept as rows of bitmaps, ``BITS / 8`` bytes at most in all, on the driver, and sent to every task.
    When far more addresses were added than it has bits it lets nearly all pass, and the exact join behind it does the work.
    """

    BITS = 1 << 25
    ROW = 1 << 15       # bits of Spark's bitmaps

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.rows = spark, {}

    @classmethod
    def _bit(cls, address: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(17), F.col(address)), F.lit(cls.BITS))

    def add(self, df: DataFrame, address: str) -> int:
        """Add the addresses of ``df``; the number of its rows comes back."""
        bit = self._bit(address)
        found = df.groupBy(F.shiftright(bit, 15).cast("int").alias("row")).agg(
            F.bitmap_construct_agg(F.pmod(bit, F.lit(self.ROW))).alias("bits"), F.count("*").alias("n")).collect()
        for r in found:
            old = int.from_bytes(self.rows.get(r["row"], b""), "little")
            self.rows[r["row"]] = (old | int.from_bytes(bytes(r["bits"]), "little")).to_bytes(self.ROW // 8, "little")
        return sum(r["n"] for r in found)

    def tested(self, df: DataFrame, address: str) -> DataFrame:
        """``df`` with ``doubtful``: false where ``address`` was surely never added."""
        rows = self.spark.createDataFrame([(k, bytearray(v)) for k, v in self.rows.items()], "_row int, _bits binary")
        bit, names = self._bit(address), df.columns
        marked = df.withColumns({"_bit_row": F.shiftright(bit, 15).cast("int"), "_place": F.pmod(bit, F.lit(self.ROW)).cast("int")})
        # the size of the filter is fixed
        joined = marked.join(F.broadcast(rows), F.col("_bit_row") == F.col("_row"), "left")
        byte = F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright("_place", 3) + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.getbit(byte, F.col("_place").bitwiseAND(F.lit(7))) == 1
        return joined.select(*names, F.coalesce(hit, F.lit(False)).alias("doubtful"))
