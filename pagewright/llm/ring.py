"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a 32-bit ring. A row's key hashes to a position, and the next
point clockwise names its home shard. A shard holds at most its bound; rows beyond it go on
clockwise to the next point whose shard has room. The bounds are the two nearest integers to
the mean, so the row counts of any two shards differ by at most one (law ``rows``), while
most rows stay where the ring alone would put them, also when a shard is added.

The ring has ``shards * points`` arcs whatever the number of rows. Rows are counted per arc
and cell (a hash range inside an arc that holds a few thousand rows), the arc totals are
filled into shards by one walk around the ring, and each row finds its place from its rank
inside its arc: cells before it, then rows before it in its cell. Nothing is grouped by
shard or by key.

Defined cases: a null key has a position like any other; equal rows are interchangeable and
get different slots; a key that holds a third of all rows overflows clockwise and is spread
over cells; fewer rows than shards leave shards empty; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.frames import map_texts, written

POINTS = 256
CELL_ROWS = 4096
#: Groups into which equal rows are split.
SALTS = 64


@dataclass
class Ring:
    """Sorted points and the shard of each; arc ``k`` ends at point ``k``."""

    points: np.ndarray
    owners: list[int]

    @classmethod
    def of(cls, shards: int, points: int) -> Ring:
        placed: dict[int, int] = {}
        for shard in range(shards):
            for k in range(points):
                digest = hashlib.blake2b(f"{shard}/{k}".encode(), digest_size=4).digest()
                placed.setdefault(int.from_bytes(digest, "big"), shard)
        at = sorted(placed)
        return cls(np.array(at, np.int64), [placed[p] for p in at])

    def arcs(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.points, positions) % len(self.points)


def fill(owners: list[int], totals: list[int], shards: int) -> dict[int, list[tuple[int, int, int, int]]]:
    """Per arc its pieces (first rank, shard, first slot, shards passed), in order of rank."""
    rows = sum(totals)
    room = [rows // shards + (s < rows % shards) for s in range(shards)]
    used = [0] * shards
    pieces: dict[int, list[tuple[int, int, int, int]]] = {}

    def put(arc: int, rank: int, shard: int, passed: int, most: int) -> int:
        n = min(most, room[shard] - used[shard])
        if n > 0:
            pieces.setdefault(arc, []).append((rank, shard, used[shard], passed))
            used[shard] += n
        return max(n, 0)

    left = {}
    for arc, total in enumerate(totals):
        kept = put(arc, 0, owners[arc], 0, total)
        if kept < total:
            left[arc] = kept
    for arc, rank in left.items():
        seen = {owners[arc]}
        step = arc
        while rank < totals[arc]:
            step = (step + 1) % len(owners)
            if owners[step] not in seen:
                rank += put(arc, rank, owners[step], len(seen), totals[arc] - rank)
                seen.add(owners[step])
    return pieces


def ring_shards(rows: DataFrame, key: str, shards: int, points: int = POINTS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``rows`` with ``shard``, ``slot`` (gapless from 0 in its shard), ``home`` and ``passed``.

    ``rows`` should hold the key and small columns only: equal rows are counted together.
    """
    spark = rows.sparkSession
    columns = rows.columns
    ring = Ring.of(shards, points)
    named = rows.select(F.struct(*columns).alias("row"))
    position = F.xxhash64(F.col(f"row.`{key}`")).bitwiseAND(F.lit(0xFFFFFFFF))
    salted = named.select("row", position.alias("position"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("salt"))
    # Which salt an equal row gets may change when a lost task runs again; the written table fixes it.
    counted = salted.groupBy("row", "position", "salt").agg(F.count("*").alias("copies"))

    shape = f"struct<{', '.join(f'`{c}`:{t}' for c, t in rows.dtypes)}>"
    names = ["row", "position", "salt", "copies"]

    def with_arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arcs = ring.arcs(batch.column("position").to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in names), pa.array(arcs, pa.int32())], [*names, "arc"])

    schema = f"row {shape}, position bigint, salt bigint, copies bigint, arc int"
    located = written(map_texts(counted, {name: F.col(name) for name in names}, schema, with_arcs), "ring")
    totals = [0] * len(ring.owners)
    cells = []
    for row in located.groupBy("arc").agg(F.sum("copies").alias("n"), F.count("*").alias("rows")).collect():
        totals[row.arc] = row.n
        cells.append((row.arc, -(-row["rows"] // cell_rows)))
    # A row for each arc at most. The arc of a key that has a third of all rows gets as many more cells.
    of_arc = F.broadcast(spark.createDataFrame(cells, "arc int, cells bigint"))
    placed = located.join(of_arc, "arc").withColumn("cell", F.pmod(F.xxhash64("row", "salt"), F.col("cells"))).drop("cells")
    per_cell = written(placed.groupBy("arc", "cell").agg(F.sum("copies").alias("n")), "ring-cells")
    pieces = fill(ring.owners, totals, shards)

    in_arc = Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_cell.select("arc", "cell", F.coalesce(F.sum("n").over(in_arc), F.lit(0)).alias("before"))
    in_cell = Window.partitionBy("arc", "cell").orderBy("position", "row", "salt").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("rank", F.coalesce(F.sum("copies").over(in_cell), F.lit(0))).join(offsets, ["arc", "cell"])
    one_each = ranked.select("row", "arc", F.explode(F.sequence(F.col("before") + F.col("rank"), F.col("before") + F.col("rank") + F.col("copies") - 1)).alias("rank"))
    starts = {arc: [p[0] for p in found] for arc, found in pieces.items()}
    schema = f"row {shape}, shard int, slot bigint, home int, passed int"

    def with_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, slot, home, passed = [], [], [], []
            for arc, rank in zip(batch.column("arc").to_pylist(), batch.column("rank").to_pylist(), strict=True):
                first, target, base, hops = pieces[arc][bisect.bisect_right(starts[arc], rank) - 1]
                shard.append(target)
                slot.append(base + rank - first)
                home.append(ring.owners[arc])
                passed.append(hops)
            kinds = [(shard, pa.int32()), (slot, pa.int64()), (home, pa.int32()), (passed, pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(v, t) for v, t in kinds)], ["row", "shard", "slot", "home", "passed"]
            )

    out = map_texts(one_each, {name: F.col(name) for name in ("row", "arc", "rank")}, schema, with_shards)
    return out.select(*(F.col(f"row.`{c}`").alias(c) for c in columns), "shard", "slot", "home", "passed")


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The result of the query: each document's shard and slot under the law ``rows``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return ring_shards(rows, "doc_id", shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "home",
        "passed",
    )
