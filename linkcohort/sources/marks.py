"""What is known of the steps in a folder: for each a mark, written after its rows, and by how many buckets of an id it is laid out."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MARKS = "marks"
SCHEMA = "mark string"


@dataclass(frozen=True)
class Mark:
    """A step's state: ``key`` stands for the inputs and settings it was made from, ``run`` for this writing of it."""

    step: str
    key: str
    finished: bool = True
    schema: str = ""
    inputs: tuple[str, ...] = ()
    by: str = ""
    buckets: int = 0
    measures: Mapping[str, int] = field(default_factory=dict)
    run: str = field(default_factory=lambda: uuid.uuid4().hex)


def write_mark(spark: SparkSession, folder: str, mark: Mark) -> None:
    """One small file, which replaces the step's mark before."""
    row = pa.table({"mark": pa.array([json.dumps(asdict(mark))], pa.string())})
    spark.createDataFrame(row).coalesce(1).write.mode("overwrite").text(f"{folder}/{MARKS}/{mark.step}")


def read_marks(spark: SparkSession, folder: str) -> dict[str, Mark]:
    """The marks in a folder by step; none where there is no such folder."""
    try:
        rows = spark.read.option("recursiveFileLookup", True).text(f"{folder}/{MARKS}").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    marks = [Mark(**{k: tuple(v) if k == "inputs" else v for k, v in json.loads(r.value).items()}) for r in rows]
    return {m.step: m for m in marks}


def key_of(*parts: object) -> str:
    return hashlib.sha256("\n".join(map(repr, parts)).encode()).hexdigest()


def content_key(df: DataFrame) -> str:
    """Stands for all rows of a table, in any order; one pass."""
    h = F.xxhash64(*df.columns)
    return key_of(df.schema.simpleString(), *df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.bitwiseAND(0xFFFFFFFF))).first())


def _bucketed_name(path: str) -> str:
    return f"linkcohort_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def save_bucketed(df: DataFrame, path: str, by: str, buckets: int) -> DataFrame:
    """Write rows in ``buckets`` files by the hash of an id, sorted by it, for joins on it that shuffle nothing.

    For tables with one row, or few, per id: all rows of an id are in one bucket.
    """
    name = _bucketed_name(path)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")  # the catalog's entry only: the files are the step's
    df.repartition(buckets, by).write.mode("overwrite").format("parquet").bucketBy(buckets, by).sortBy(by).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def load_bucketed(spark: SparkSession, path: str, schema: StructType, by: str, buckets: int) -> DataFrame:
    """What :func:`save_bucketed` wrote, also in another session, whose catalog does not know it yet."""
    name = _bucketed_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def schema_from(mark: Mark) -> StructType:
    return StructType.fromJson(json.loads(mark.schema))


__all__: Sequence[str] = [
    "Mark", "content_key", "key_of", "load_bucketed", "read_marks", "save_bucketed", "schema_from", "write_mark",
]
