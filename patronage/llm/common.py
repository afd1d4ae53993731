"""Helpers shared by the operators: Arrow passes over rows, names that do not clash, shared files, components of links."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, shared_dir, tune

ARROW_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
               "binary": pa.binary(), "tinyint": pa.int8(), "longs": pa.list_(pa.int64())}
FIELD_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
               "boolean": T.BooleanType(), "binary": T.BinaryType(), "tinyint": T.ByteType(),
               "longs": T.ArrayType(T.LongType())}


def ship(module: str) -> None:
    """Send the functions of a module to the executors by value, so workers need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def prepare(spark: SparkSession, rows: int = 256, megabytes: int = 8) -> SparkSession:
    """Settings every operator here relies on: Arrow batches are bounded by rows and by bytes, so a worker holds a few
    megabytes of text whatever the size of its partition."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_columns(df: DataFrame, inputs: list[str], fields: dict[str, str], start: Callable[[], Callable]) -> DataFrame:
    """Append columns computed from ``inputs``, one Arrow batch at a time; all other columns pass through untouched.

    ``start()`` runs once per task and returns ``compute(*columns) -> one list per field``; a column is a list of Python
    values, strings as UTF-8 bytes. The names of ``fields`` must be free in ``df``.
    """
    places = [df.columns.index(name) for name in inputs]
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, FIELD_TYPES[k]) for n, k in fields.items())])
    kinds = [ARROW_TYPES[k] for k in fields.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = None
        for batch in batches:
            compute = compute or start()
            values = []
            for place in places:
                column = batch.column(place)
                if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                    column = column.cast(pa.large_binary())
                values.append(column.to_pylist())
            found = compute(*values)
            columns = [*batch.columns, *(pa.array(v, type=k) for v, k in zip(found, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def run_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def open_store(folder: str):
    """(file system, path) of a folder that executors write to with plain Python: local, HDFS, S3 or GCS addresses."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def tasks_for(spark: SparkSession, total: int, items: int, each: int = 1 << 26) -> int:
    """Tasks for ``items`` files or blocks of ``total`` bytes: about ``each`` bytes a task, but no fewer than there are cores for.

    Given to a repartition as a number, as adaptive execution would merge rows that only name a file into one task.
    """
    return max(1, min(items, max(spark.sparkContext.defaultParallelism, -(-total // each))))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of the links (a, b) over long ids: one row (node, label), label the smallest node reachable.

    Every round lowers a node's label to the smallest among its neighbours, offers the same value to the node that was its
    label, and follows labels of labels, so a chain of n links needs about log n rounds. Each round is written to the shared
    folder, which cuts the lineage and gives the next join two exchanged sides that a skew join can split: a hub of a star
    is one hot key there. Self links, repeated links and NULL ends add nothing.
    """
    pairs = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    both = materialize(pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    labels = materialize(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
                         .select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("label").alias("best"))
        offers = labels.join(near, F.col("node") == F.col("u")).select("node", "label", F.least("label", "best").alias("best"))
        lowered = materialize(
            offers.select(F.explode(F.array(F.struct("node", F.col("best").alias("label")),
                                            F.struct(F.col("label").alias("node"), F.col("best").alias("label")))).alias("x"))
            .select("x.*").groupBy("node").agg(F.min("label").alias("label")), "lowered")
        jumped = (lowered.join(lowered.select(F.col("node").alias("at"), F.col("label").alias("next")), F.col("label") == F.col("at"))
                  .select("node", F.col("next").alias("label")))
        after = materialize(jumped.join(labels.withColumnRenamed("label", "was"), "node")
                            .select("node", "label", (F.col("label") != F.col("was")).alias("moved")), "labels")
        moved = not after.where("moved").isEmpty()
        labels = after.drop("moved")
        if not moved:
            return labels


ship(__name__)
