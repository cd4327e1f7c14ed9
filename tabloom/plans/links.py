"""Links of a graph laid out once, so that rounds move only the values of the nodes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.plans.storage import scratch_path, written


class KeyedLinks:
    """A link table bucketed by its key, and by a part number where keys are hot.

    A key with more than ``rows_per_part`` links has several parts, and a value sent along its
    links is copied once per part; all other keys have one. Joining values to links then
    shuffles the values only, and no task holds all links of a hot key.
    """

    def __init__(self, links: DataFrame, key: str, rows_per_part: int = 500_000):
        self.spark, self.key, self.columns = links.sparkSession, key, links.columns
        sizes = links.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / rows_per_part).cast("int").alias("_parts"))
        self.hot = written(sizes.filter("_parts > 1"), "hot-keys")
        self.by = [key] if self.hot.isEmpty() else [key, "_part"]
        if len(self.by) > 1:
            part = F.pmod(F.xxhash64(*self.columns), F.coalesce("_parts", F.lit(1))).cast("int")
            links = links.join(self.hot, key, "left").select(*self.columns, part.alias("_part"))
        self.name = f"tabloom_links_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # One task per bucket writes one file per bucket.
        writer = links.repartition(buckets, *self.by).write.bucketBy(buckets, *self.by).sortBy(*self.by)
        writer.option("path", scratch_path(self.spark, "links")).saveAsTable(self.name)
        self.table = self.spark.table(self.name)

    def send(self, values: DataFrame) -> DataFrame:
        """Every link with the value row of its key."""
        if len(self.by) > 1:
            values = values.join(self.hot, self.key, "left").withColumn(
                "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
            ).drop("_parts")
        return self.table.join(values, self.by).drop("_part")

    def close(self) -> None:
        """Forget the table; results built from it must be checkpointed by now."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
