"""Steps whose tables are made once per state of their input files, and made anew when those change."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir


def _at(spark: SparkSession, path: str):
    """(file system, path) of an address, as Spark itself resolves it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def fingerprint(spark: SparkSession, *paths: str, settings: str = "") -> str:
    """One hash over path, size and modification time of all files below ``paths``, and over ``settings``."""
    seen = []
    for path in paths:
        files, place = _at(spark, path)
        found = files.listFiles(place, True)
        while found.hasNext():
            status = found.next()
            seen.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join([settings, *sorted(seen)]).encode()).hexdigest()[:24]


#: tables already opened in this process, by application and folder; the folder's name holds the fingerprint
_OPENED: dict[tuple[str, str], dict[str, DataFrame]] = {}


def reused(spark: SparkSession, step: str, key: str, build: Callable, in_turn: bool = False) -> dict[str, DataFrame]:
    """The tables of ``step`` for the inputs that ``key`` stands for: those of an earlier run, or built and stored now.

    All tables are written under a name of their own and then renamed in one go, so a run that died leaves nothing that looks
    finished; of two runs at once the first one to finish counts. With ``in_turn``, ``build`` is given a function of a name and a
    table, which stores the table at once and returns what was stored, so that tables made from it do not work it out again.
    """
    folder = f"{shared_dir(spark)}/runs/{step}-{key}"
    opened = spark.sparkContext.applicationId, folder
    if opened in _OPENED:
        return _OPENED[opened]
    files, place = _at(spark, folder)
    if not files.exists(place):
        attempt = f"{folder}.{uuid.uuid4().hex}"

        def keep(name: str, table: DataFrame) -> DataFrame:
            # texts of reviews are the bulk of what is stored
            table.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "6").parquet(f"{attempt}/{name}")
            return spark.read.schema(table.schema).parquet(f"{attempt}/{name}")

        if in_turn:
            build(keep)
        else:
            for name, table in build().items():
                keep(name, table)
        made = _at(spark, attempt)[1]
        if files.exists(place) or not files.rename(made, place):
            files.delete(made, True)
    names = [status.getPath().getName() for status in files.listStatus(place)]
    _OPENED[opened] = {name: spark.read.parquet(f"{folder}/{name}") for name in names}
    return _OPENED[opened]


def drop_others(spark: SparkSession, step: str, key: str) -> int:
    """Remove the tables of ``step`` that other inputs left, and attempts that died; returns how many folders went."""
    files, place = _at(spark, f"{shared_dir(spark)}/runs")
    if not files.exists(place):
        return 0
    gone = [s.getPath() for s in files.listStatus(place)
            if s.getPath().getName().startswith(f"{step}-") and s.getPath().getName() != f"{step}-{key}"]
    for path in gone:
        files.delete(path, True)
        name = path.getName()
        for opened in [k for k in _OPENED if k[1].endswith(f"/runs/{name}")]:
            del _OPENED[opened]
    return len(gone)
