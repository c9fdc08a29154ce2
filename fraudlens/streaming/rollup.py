"""Small results of very many micro-batches, kept in a bounded number of files.

Each micro-batch writes a segment of its own; a repeated one replaces it. ``FAN`` segments of a tier are merged into
one of the next tier and then deleted, so after n micro-batches there are fewer than 2 * FAN * (1 + log n / log FAN)
segments. A reader takes only finished segments that none of a higher tier covers, so a merge that is interrupted
at any place changes nothing for it and is done again by the next.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FAN = 100
_NAME = re.compile(r"tier=(\d+)-upto=(\d+)$")


@dataclass(frozen=True, order=True)
class Segment:
    """The rows of the micro-batches up to ``upto`` that no earlier segment of its tier has."""

    tier: int
    upto: int

    def path(self, base: str) -> str:
        return f"{base}/tier={self.tier}-upto={self.upto:019}"


def _folder(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    folder, fs = _folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def delete(spark: SparkSession, path: str) -> None:
    folder, fs = _folder(spark, path)
    fs.delete(folder, True)


def _finished(spark: SparkSession, path: str) -> bool:
    folder, fs = _folder(spark, f"{path}/_SUCCESS")
    return fs.exists(folder)


def _all_segments(spark: SparkSession, base: str) -> list[Segment]:
    found = [m for m in map(_NAME.search, names(spark, base)) if m]
    return sorted(Segment(int(m[1]), int(m[2])) for m in found)


def _covered(segment: Segment, others: list[Segment]) -> bool:
    return any(o.tier > segment.tier and o.upto >= segment.upto for o in others)


def live_segments(spark: SparkSession, base: str) -> list[Segment]:
    """Finished segments that no finished one of a higher tier covers: together, every row once."""
    found = _all_segments(spark, base)
    merged = [s for s in found if s.tier and _finished(spark, s.path(base))]
    own = [s for s in found if not s.tier and not _covered(s, merged) and _finished(spark, s.path(base))]
    return sorted(own + [s for s in merged if not _covered(s, merged)])


def save_segment(df: DataFrame, base: str, epoch: int) -> str:
    """Write the result of a micro-batch; returns where it is."""
    path = Segment(0, epoch).path(base)
    df.write.mode("overwrite").parquet(path)
    return path


def read_segment(spark: SparkSession, base: str, epoch: int, schema: T.StructType) -> DataFrame | None:
    """What one recent micro-batch wrote; None if it has written nothing."""
    path = Segment(0, epoch).path(base)
    return spark.read.schema(schema).parquet(path) if _finished(spark, path) else None


def read_segments(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """All rows that micro-batches have written below ``base``."""
    paths = [s.path(base) for s in live_segments(spark, base)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def roll_up(spark: SparkSession, base: str, before: int, schema: T.StructType, fan: int = FAN) -> None:
    """Merge full tiers of segments of micro-batches before ``before``, which must not be repeated any more.

    Files that cover each other are deleted first: they are left of a merge that was interrupted.
    """
    live = live_segments(spark, base)
    for s in _all_segments(spark, base):
        if _covered(s, live) and s not in live:
            delete(spark, s.path(base))
    tier = 0
    while True:
        full = [s for s in live if s.tier == tier and s.upto < before]
        if len(full) < fan:
            break
        target = Segment(tier + 1, full[-1].upto)
        rows = spark.read.schema(schema).parquet(*[s.path(base) for s in full])
        rows.coalesce(1 + rows.count() // 1_000_000).write.mode("overwrite").parquet(target.path(base))
        for s in full:
            delete(spark, s.path(base))
        live = [s for s in live if s not in full] + [target]
        tier += 1
