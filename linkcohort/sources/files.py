"""Files: codelists, CSV modules, written tables and where to put them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

def normalise_codelist(df: DataFrame) -> DataFrame:
    """Lower-case names, codes without dots, blank attributes as empty text."""
    df = df.toDF(*[c.lower() for c in df.columns])
    fill = {c: F.coalesce(F.col(c), F.lit("")) for c in df.columns if c != "code"}
    return df.withColumns({**fill, "code": F.regexp_replace(F.col("code"), r"\.", "")}).filter(F.col("code") != "")


def read_codelist(spark: SparkSession, path: str) -> DataFrame:
    """A codelist CSV with a header, all columns read as text."""
    with_header = spark.read.option("header", True)
    return normalise_codelist(with_header.csv(path))


def codelist(spark: SparkSession, rows: Sequence[Sequence[str]], columns: Sequence[str]) -> DataFrame:
    """A codelist given in code; its size is known to the optimizer."""
    cols = list(zip(*rows)) if rows else [[] for _ in columns]
    table = pa.table({c: pa.array(list(v), pa.string()) for c, v in zip(columns, cols)})
    return normalise_codelist(spark.createDataFrame(table))


def read_csv_module(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV extract with a header and a declared schema.

    The columns of the schema are found by name, in any order of the file.
    """
    raw = spark.read.option("header", True).csv(path)
    raw = raw.toDF(*[c.lower() for c in raw.columns])
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)])


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    compression: str | None = None,
    partition_by: Iterable[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write a result as parquet, orc, json or csv, compressed as asked."""
    writer = df.write.mode(mode).partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def shared_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The folder every executor can reach: the session's checkpoint directory.

    ``fallback`` is used only where the session names none, and may be a local
    folder in local mode only.
    """
    if named := _checkpoint_dir(spark):
        return named
    if fallback:
        return checked_root(spark, fallback)
    raise ValueError("set spark.checkpoint.dir to a folder all executors share, or pass one")


def _checkpoint_dir(spark: SparkSession) -> str | None:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return named.rstrip("/") if named else None


def checked_root(spark: SparkSession, path: str) -> str:
    """The path without its last slash; an error if it is on one machine only and the session is not."""
    scheme = path.split("://")[0] if "://" in path else "file"
    if scheme == "file" and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"{path!r} is a folder of one machine; name one that all executors share")
    return path.rstrip("/")


def in_shared_dir(spark: SparkSession, path: str) -> bool:
    """Whether a path is the session's checkpoint directory or lies in it, which is shared whatever its scheme."""
    def plain(p: str) -> str:
        return re.sub("^file:/+", "/", p.rstrip("/")) + "/"

    named = _checkpoint_dir(spark)
    return bool(named) and ".." not in path.split("/") and plain(path).startswith(plain(named))


def save_step(df: DataFrame, name: str, root: str, partition_by: Iterable[str] = (), mode: str = "error") -> DataFrame:
    """Write one module's result and read it back, which cuts its lineage.

    A step that is there already is an error, so that runs cannot replace each other's.
    """
    path = f"{root.rstrip('/')}/{name}"
    write_table(df, path, partition_by=partition_by, mode=mode)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # also where there are no rows


def load_step(spark: SparkSession, name: str, root: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


__all__ = [
    "checked_root", "codelist", "in_shared_dir", "load_step", "normalise_codelist", "read_codelist",
    "read_csv_module", "save_step", "shared_dir", "write_table",
]
