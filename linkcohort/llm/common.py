"""Helpers the text operators share: cutting lineage, ASCII case, components of a graph."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] == "local":
        return "file://" + _own_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """The rows, written below the shared folder and read back: a lost executor costs no recomputation."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a session: they need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_has_linkcohort", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="run-")) / "linkcohort_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._has_linkcohort = True


ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}


def arrow_schema(columns: str) -> pa.Schema:
    """The Arrow form of ``name type, ...`` with flat types or arrays of them."""
    out = []
    for name, kind in (c.strip().split(" ") for c in columns.split(",")):
        inner = kind.removeprefix("array<").removesuffix(">")
        out.append(pa.field(name, ARROW[inner] if inner == kind else pa.list_(ARROW[inner])))
    return pa.schema(out)


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` by a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all other characters as they are; the quick way where there are no others."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, underscores put before those that ``df`` has as columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        out.append(n)
    return out


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``comp``: the smallest node reachable, for each node of the undirected edges.

    Large-star and small-star rounds: each links nodes to the smallest of their
    neighbours by one aggregate and one join, both safe for a node with a third
    of the edges. The rounds are written out, so nothing is recomputed, and end
    when a round changes no edge; few are needed, as components shrink to stars.
    """
    lo, hi = F.least(a, b), F.greatest(a, b)
    now = edges.filter(F.col(a) != F.col(b)).select(hi.alias("u"), lo.alias("v")).distinct()
    now, before = cut(now, "edges"), None
    while (mark := _fingerprint(now)) != before:
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("v", "m", "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        now = cut(small.filter("u > v").distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.bit_xor(h)).first())
