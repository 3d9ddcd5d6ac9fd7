"""Sharding by histogram sort.

Rows are ordered by (hash of the text, hash of doc_id, row number of the written table), so
equal texts lie together. Splitters of this order are found without moving rows: every round,
each partition counts the exact bytes between candidate boundaries, the counts are summed, and
the candidates close in on the cell in which a splitter lies until an edge of it is near enough
to the splitter's share of the bytes. Then the rows are exchanged once, by part.

A cell that has shrunk to one value (a hot text) goes on with the next column of the key, so a
group of copies of any size is split. A round sends ``PROBES`` rows or so to the driver, or
``SLOTS`` for each splitter still sought where that is more.

Each shard consists of several parts, so that a shard is not one task; their number grows with the
bytes (``PART_BYTES``: some 100,000 parts for 100 TB). A row's slot is the number
of rows in the shard's earlier parts plus its rank in its own part. Law ``bytes``: shards' sizes
are as near equal as the largest row at a boundary and ``TOLERANCE`` allow.

Defined results: a NULL text has size 1 and the checksum of the empty text; rows without doc_id
hash alike and are told apart by row number, as repeated rows are; an empty table gives an empty
result; other columns pass through ``shard`` and are not read otherwise.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sevscope.session import write_stage

KEY = ("k_text", "k_id", "k_row")
#: Keys are below this, so that one past the last fits a long.
END = 1 << 62
PROBES = 4096
#: Least slots of a cell, so that every round narrows many splitters' cells alike.
SLOTS = 8
#: Of a part's share of the bytes.
TOLERANCE = 0.002
PART_BYTES = 1 << 30
MIN_PARTS = 4  # of a shard


class Cell:
    """Rows whose key starts with ``prefix`` and goes on with a value in [lo, hi]; ``below``: bytes ahead of it."""

    def __init__(self, prefix=(), lo=0, hi=END - 1, below=0):
        self.prefix, self.lo, self.hi, self.below = prefix, lo, hi, below

    def id(self):
        return self.prefix, self.lo, self.hi


def keyed(docs: DataFrame, *columns) -> DataFrame:
    """``columns`` of ``docs`` with the order's key and the size, as a written table."""
    cut = lambda c: F.shiftrightunsigned(F.xxhash64(c), 2)
    size = (F.coalesce(F.octet_length(docs["text"]), F.lit(0)) + 1).cast("long")
    return write_stage(docs.select(*columns, size.alias("size"), cut(docs["text"]).alias(KEY[0]), cut(docs["doc_id"]).alias(KEY[1]),
                                   F.monotonically_increasing_id().alias(KEY[2])), "keyed")


def _count(rows: DataFrame, cells: list[Cell], slots: int) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(cell, slot) -> bytes, smallest and largest value there."""
    spec = [(c.prefix, c.lo, c.hi, (c.hi - c.lo) // slots + 1) for c in cells]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys, size = [b[k].to_numpy() for k in KEY], b["size"].to_numpy()
            found = []
            for prefix in sorted({s[0] for s in spec}):
                own = sorted((lo, hi, step, i) for i, (p, lo, hi, step) in enumerate(spec) if p == prefix)
                lo, hi, step, at = (np.array(x, np.int64) for x in zip(*own))
                inside = np.ones(len(size), bool)
                for k, v in zip(keys, prefix):
                    inside &= k == v
                k, n = keys[len(prefix)][inside], size[inside]
                j = np.searchsorted(lo, k, "right") - 1
                ok = (j >= 0) & (k <= hi[j])
                j, k, n = j[ok], k[ok], n[ok]
                found.append(pd.DataFrame({"cell": at[j], "slot": (k - lo[j]) // step[j], "bytes": n, "lo": k, "hi": k}))
            f = pd.concat(found)
            yield f.groupby(["cell", "slot"], as_index=False).agg({"bytes": "sum", "lo": "min", "hi": "max"})

    got = (rows.select("size", *KEY).mapInPandas(count, "cell long, slot long, bytes long, lo long, hi long")
           .groupBy("cell", "slot").agg(F.sum("bytes").alias("bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    return {(r["cell"], r["slot"]): (r["bytes"], r["lo"], r["hi"]) for r in got.collect()}  # about PROBES rows


def splitters(rows: DataFrame, parts: int, total: int) -> list[tuple[int, ...]]:
    """``parts - 1`` keys in order; part i has the rows from splitter i - 1 on, up to splitter i."""
    near = TOLERANCE * total / parts
    found: dict[int, tuple[int, ...]] = {}
    open_ = {j: Cell() for j in range(1, parts)}
    while open_:
        cells = list({c.id(): c for c in open_.values()}.values())
        at = {c.id(): i for i, c in enumerate(cells)}
        counts = _count(rows, cells, max(SLOTS, PROBES // len(cells)))
        by_cell: dict[int, list] = {}
        for (i, slot), x in sorted(counts.items()):
            by_cell.setdefault(i, []).append(x)
        for j, cell in list(open_.items()):
            want, below = total * j / parts, cell.below
            for size, lo, hi in by_cell[at[cell.id()]]:
                if below + size >= want:
                    break
                below += size
            before, after = want - below, below + size - want
            last = len(cell.prefix) == len(KEY) - 1
            if min(before, after) <= near or (lo == hi and last):
                found[j] = cell.prefix + (lo if before <= after else hi + 1,)
                del open_[j]
            elif lo == hi:
                open_[j] = Cell(cell.prefix + (lo,), 0, END - 1, below)
            else:
                open_[j] = Cell(cell.prefix, lo, hi, below)
    return [found[j] for j in range(1, parts)]


def part_of(keys: list[np.ndarray], splits: list[tuple[int, ...]]) -> np.ndarray:
    """How many of the splitters (in order) each key has reached."""
    first = np.array([s[0] for s in splits], np.int64)
    k = keys[0]
    out = np.searchsorted(first, k, "left")  # splitters that start lower
    ties = np.searchsorted(first, k, "right") > out
    for v in np.unique(k[ties]):
        same = k == v
        equal = [s[1:] for s in splits if s[0] == v]
        whole = sum(not s for s in equal)  # end here, ahead of the longer ones
        deeper = equal[whole:]
        out[same] += whole + (part_of([x[same] for x in keys[1:]], deeper) if deeper else 0)
    return out


def shard(rows: DataFrame, n_shards: int = 16, part_bytes: int = PART_BYTES) -> DataFrame:
    """``rows`` (from ``keyed``) with shard and slot: law ``bytes``."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    per_shard = max(MIN_PARTS, -(-total // (n_shards * part_bytes)))
    splits = sorted(splitters(rows, n_shards * per_shard, total)) if total else []

    @F.pandas_udf("int")
    def part(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(part_of([x.to_numpy() for x in (a, b, c)], splits).astype("int32"))

    placed = rows.withColumn("part", part(*KEY) if splits else F.lit(0))
    in_shard = F.floor(F.col("part") / per_shard).cast("int")
    # a row per part: small beside the rows
    ahead = (placed.groupBy("part").count().withColumn("shard", in_shard)
             .select(F.col("part").alias("of_part"), "shard", (F.sum("count").over(Window.partitionBy("shard").orderBy("part")) - F.col("count")).alias("ahead")))
    at = F.row_number().over(Window.partitionBy("part").orderBy(*KEY)) - 1
    ranked = placed.withColumn("slot", at.cast("long"))
    return (ranked.join(F.broadcast(ahead), F.col("part") == F.col("of_part"))
            .withColumn("slot", F.col("ahead") + F.col("slot")).drop("of_part", "ahead"))


def report(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    crc = F.crc32(F.coalesce(docs["text"], F.lit("")).cast("binary")).alias("text_crc32")
    return shard(keyed(docs, docs["doc_id"], crc), n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def place(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, in place of columns of these names."""
    doc = F.struct(*(docs[c] for c in docs.columns if c not in ("shard", "slot"))).alias("doc")
    return shard(keyed(docs, doc), n_shards).select("doc.*", "shard", "slot")
