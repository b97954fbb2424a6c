"""Index of the ids a table holds, so a load reads only the part its own ids can be in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfield.sources import sinks

_FILES = "file STRING"


class IdIndex:
    """Ids of a Parquet table in hash buckets, with Bloom filters, beside the table.

    The table alone says what is stored; the index follows it. ``refresh`` adds the ids of the table's files that are
    not in it yet, so a load that broke off after writing the table is made up for by the next one, and an id that
    was indexed twice does no harm. If files the index knows are gone (the table was replaced), it is built anew.
    """

    def __init__(self, spark: SparkSession, table: str, id_col: str = "id", buckets: int = 64):
        self.spark, self.table, self.id_col, self.buckets = spark, table.rstrip("/"), id_col, buckets
        self.ids, self.files = f"{self.table}.ids", f"{self.table}.ids-files"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.id_col), F.lit(self.buckets)).cast("int")

    def _add(self, files: list[str], id_type: str) -> None:
        ids = self.spark.read.schema(f"`{self.id_col}` {id_type}").parquet(*files).where(F.col(self.id_col).isNotNull())
        (
            ids.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("append").partitionBy("bucket")
            .option(f"parquet.bloom.filter.enabled#{self.id_col}", "true").parquet(self.ids)
        )
        self.spark.createDataFrame([(f,) for f in files], _FILES).coalesce(1).write.mode("append").parquet(self.files)

    def refresh(self, id_type: str) -> None:
        """Bring the index up to the table's files; only new files are read, and of them only the ids."""
        if not sinks.table_exists(self.spark, self.table):
            return
        stored = set(self.spark.read.schema(f"`{self.id_col}` {id_type}").parquet(self.table).inputFiles())
        known = {r.file for r in sinks.read_table(self.spark, self.files, _FILES).collect()}
        if known - stored:
            for path in (self.files, self.ids):
                sinks.delete_table(self.spark, path)
            known = set()
        if stored - known:
            self._add(sorted(stored - known), id_type)

    def seen(self, batch: DataFrame, most: int = 1000) -> DataFrame:
        """Stored ids that ``batch`` could hold: from its buckets only, and if it has few ids, from the row groups that may have them."""
        id_type = batch.schema[self.id_col].dataType.simpleString()
        self.refresh(id_type)
        index = sinks.read_table(self.spark, self.ids, f"`{self.id_col}` {id_type}, bucket INT")
        ids = [r[0] for r in batch.select(self.id_col).where(F.col(self.id_col).isNotNull()).distinct().limit(most + 1).collect()]
        own = batch.where(F.col(self.id_col).isNotNull()).select(self._bucket().alias("b")).distinct().collect()
        found = index.where(F.col("bucket").isin([r[0] for r in own]))
        if len(ids) <= most:
            found = found.where(F.col(self.id_col).isin(ids))
        return found.select(self.id_col)
