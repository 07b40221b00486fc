"""Sharding by a hierarchical weighted hash tree of regions, racks and shards.

Each row descends the tree: at each level every child makes a weighted hash draw
from the key, and the smallest draw wins. The draws of a child depend on its own
name and weight only, so a change of weight moves rows between the changed
subtree and its siblings, and never within the others. A shard in a region of
its own takes rows only into itself.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkcohort.llm.common import cut, let

CELL_ROWS = 20_000  # rows per cell of the slot numbering, all shards together, about


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def tree(shards: int, per_rack: int = 2, racks_per_region: int = 2, base: int = 8) -> list[Shard]:
    """``base`` shards in even racks and regions; each further one has a region of its own."""
    out = []
    for s in range(shards):
        rack = s // per_rack if s < base else s
        region = rack // racks_per_region if s < base else s
        out.append(Shard(f"region{region}", f"rack{rack}", s))
    return out


def _nested(shards: Sequence[Shard]) -> list[dict]:
    regions: dict[str, dict[str, list[Shard]]] = {}
    for s in shards:
        if s.weight > 0:
            regions.setdefault(s.region, {}).setdefault(s.rack, []).append(s)
    if not regions:
        raise ValueError("no shard has a weight")
    weight = lambda group: sum(s.weight for s in group)
    return [
        {
            "name": region, "weight": sum(map(weight, racks.values())),
            "racks": [
                {
                    "name": f"{region}/{rack}", "weight": weight(group),
                    "shards": [{"name": f"{region}/{rack}/{s.shard}", "weight": s.weight, "shard": s.shard} for s in group],
                }
                for rack, group in racks.items()
            ],
        }
        for region, racks in regions.items()
    ]


_LEAF = "struct<name: string, weight: double, shard: int>"
_RACK = f"struct<name: string, weight: double, shards: array<{_LEAF}>>"
_SCHEMA = f"array<struct<name: string, weight: double, racks: array<{_RACK}>>>"


def _pick(key: Column, children: Column) -> Column:
    """The child with the smallest exponential draw, the rate of which is its weight."""

    def draw(child, i):
        bits = F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11)
        return F.struct((-F.log((bits + 1) / F.lit(float(2**53))) / child["weight"]).alias("draw"), i.alias("i"))

    return F.element_at(children, F.array_min(F.transform(children, draw))["i"] + 1)


def place(key: Column, shards: Sequence[Shard]) -> Column:
    """The shard of a key; a NULL key has one as any other value has."""
    regions = F.from_json(F.lit(json.dumps(_nested(shards))), _SCHEMA)
    return let(regions, lambda t: let(_pick(key, t), lambda region: let(_pick(key, region["racks"]), lambda rack: _pick(key, rack["shards"])["shard"])))


def shard_documents(docs: DataFrame, shards: Sequence[Shard], grown: Sequence[Shard], cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs`` (doc_id, text).

    Slots are gapless from 0 within a shard. No shard is numbered in one task:
    rows fall into cells of a bounded number of rows by a salt, are numbered
    within them, and cells are offset by the sums of the cells before. The salt
    is of the row, not the key, so that repeated ids spread as well. Only ids
    and sizes are shuffled, and they are written first, so that both passes see
    the same salts even if an executor is lost.

    NULL text counts as empty, a NULL id is a key like others, repeated rows each
    have a slot of their own, no rows give no rows, and further columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    slim = cut(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            place(F.col("doc_id"), shards).alias("shard"),
            place(F.col("doc_id"), grown).alias("grown_shard"),
            F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("salt"),
        ),
        "shards",
    )
    cells = -(-max(1, slim.count()) // cell_rows)
    slim = slim.withColumn("cell", F.pmod("salt", F.lit(cells)))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slim.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    offsets = offsets.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size", "salt")
    return slim.withColumn("nth", F.row_number().over(within)).join(offsets, ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("offset") + F.col("nth") - 1).cast("long").alias("slot"), "grown_shard",
    )
