"""Consecutive batches of documents bounded by number and by bytes.

Where a batch ends depends on where it began, so batches are a chain over all documents. A batch spans few rows,
though: a part of consecutive rows can only be entered at one of its first ``count`` rows, and for each of these the
part alone tells the row the chain leaves it by, and with how many batches. Neighbouring parts are joined into
larger ones by following these (:func:`_climb`), until one is left, which is entered at the first row; on the
way down every part learns its own entry. No task sees more than a part or the entries of ``FAN`` parts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.documents import BATCH_SIZE, numbered
from strataflow.storage import materialize

# Fixed value: bytes an upload may hold.
UPLOAD_BYTES = 32 << 20

PART_BATCHES = 200
FAN = 64
END = -1  # the chain ends: no row follows

WAYS = "part long, entry long, exit long, n long"
STARTS = "part long, entry long, batch long"
BUCKETS = "bucket long, base long, cuts array<long>"


def next_starts(sizes: np.ndarray, own: int, count: int, limit: int) -> np.ndarray:
    """For each of the first ``own`` rows, the row a batch that begins there is followed by (``END`` behind the last).

    ``sizes`` are the bytes of these rows and of up to ``count`` rows behind them.
    """
    running = np.concatenate([[0], np.cumsum(sizes)])
    row = np.arange(own)
    full = np.searchsorted(running, running[:own] + limit, "right") - 1
    after = np.minimum(np.maximum(full, row + 1), row + count)  # a larger document is a batch of its own
    return np.where(after >= len(sizes), END, after)


def _ways(count: int, limit: int, part_rows: int):
    def run(key, rows):
        rows = rows.sort_by("number")
        number, first = rows["number"].to_numpy(), key[0].as_py() * part_rows
        own = int(np.searchsorted(number, first + part_rows))
        after = next_starts(rows["bytes"].to_numpy(), own, count, limit).tolist()
        leaves, batches = [0] * own, [0] * own
        for row in range(own - 1, -1, -1):
            inside = 0 <= after[row] < own
            leaves[row] = leaves[after[row]] if inside else after[row]
            batches[row] = 1 + (batches[after[row]] if inside else 0)
        entries = min(own, count)
        exits = [END if leave == END else first + leave for leave in leaves[:entries]]
        return pa.table({"part": [key[0].as_py()] * entries, "entry": list(range(first, first + entries)), "exit": exits,
                         "n": batches[:entries]}, schema=_schema(WAYS))

    return run


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (column.split() for column in ddl.split(", "))])


def _by_part(ways: pa.Table) -> dict[int, dict[int, tuple[int, int]]]:
    parts: dict[int, dict[int, tuple[int, int]]] = {}
    for part, entry, leave, n in zip(*(ways[c].to_pylist() for c in ("part", "entry", "exit", "n"))):
        parts.setdefault(part, {})[entry] = leave, n
    return parts


def _joined(key, ways):
    """Ways through ``FAN`` neighbouring parts, from every entry of the first."""
    parts = _by_part(ways)
    found = []
    for entry in parts[min(parts)]:
        at, batches = entry, 0
        for part in sorted(parts):
            if at in parts[part]:
                at, n = parts[part][at]
                batches += n
        found.append((key[0].as_py(), entry, at, batches))
    return pa.table(dict(zip(("part", "entry", "exit", "n"), map(list, zip(*found)))), schema=_schema(WAYS))


def _entered(key, ways, start):
    """The entry of each of the parts, and the batch that begins there; a part that none begins in has ``END``."""
    parts, found = _by_part(ways), []
    at, batch = start["entry"][0].as_py(), start["batch"][0].as_py()
    for part in sorted(parts):
        begins = at in parts[part]
        found.append((part, at if begins else END, batch))
        if begins:
            at, n = parts[part][at]
            batch += n
    return pa.table(dict(zip(("part", "entry", "batch"), map(list, zip(*found)))), schema=_schema(STARTS))


def _cuts(count: int, limit: int, part_rows: int):
    """Per ``count`` rows of a part: the batch that is open before them, and the rows of them that begin one."""

    def run(key, rows, start):
        rows = rows.sort_by("number")
        number, first = rows["number"].to_numpy(), key[0].as_py() * part_rows
        own = int(np.searchsorted(number, first + part_rows))
        after = next_starts(rows["bytes"].to_numpy(), own, count, limit).tolist()
        entry, batch = start["entry"][0].as_py(), start["batch"][0].as_py()
        begins, at = [], own if entry == END else entry - first
        while 0 <= at < own:
            begins.append(at)
            at = after[at]
        begins = np.array(begins, np.int64)
        edges = np.arange(0, own + count, count)
        cut = np.searchsorted(begins, edges[edges < own + count])
        buckets = -(-own // count)
        return pa.table({
            "bucket": [first // count + i for i in range(buckets)],
            "base": [batch - 1 + int(cut[i]) for i in range(buckets)],
            "cuts": [(first + begins[cut[i]:cut[i + 1]]).tolist() for i in range(buckets)]}, schema=_schema(BUCKETS))

    return run


def _group(width: int) -> Column:
    return F.floor(F.col("part") / F.lit(width)).cast("long").alias("above")


def _climb(ways: DataFrame) -> list[DataFrame]:
    tables = [ways]
    while (tables[-1].agg(F.max("part").alias("last")).first()["last"] or 0) > 0:
        tables.append(materialize(tables[-1].groupBy(_group(FAN)).applyInArrow(_joined, WAYS), "batch_ways"))
    return tables


def assign_bounded_batches(spark: SparkSession, path: str, size: Column, count: int = BATCH_SIZE, limit: int = UPLOAD_BYTES,
                           id_col: str = "id") -> DataFrame:
    """Written documents with a ``batch_id`` and their ``n_bytes``: consecutive runs of at most ``count`` rows and ``limit`` bytes.

    Every batch takes as many rows as fit, in order of the files' names; a document larger than ``limit`` is a batch
    of its own. ``size`` is a document's bytes (null: 0). Documents are joined to their batch by row number; only numbers
    and sizes are moved to find the batches.
    """
    part_rows = PART_BATCHES * count
    rows = numbered(spark, path).withColumn("n_bytes", F.coalesce(size.cast("long"), F.lit(0)).cast("long"))
    part = F.floor(F.col("_number") / F.lit(part_rows)).cast("long")
    # The first rows of a part are also what lies behind the part before.
    both = F.when((F.col("_number") % part_rows < count) & (part > 0), F.array(part, part - 1)).otherwise(F.array(part))
    narrow = materialize(rows.select(
        F.explode(both).alias("part"), F.col("_number").alias("number"), F.col("n_bytes").alias("bytes")), "batch_sizes")
    ways = materialize(narrow.groupBy("part").applyInArrow(_ways(count, limit, part_rows), WAYS), "batch_ways")
    tables = _climb(ways)
    starts = tables[-1].where("entry = 0").select("part", "entry", F.lit(0).cast("long").alias("batch"))
    for below in tables[-2::-1]:
        starts = materialize(below.groupBy(_group(FAN)).cogroup(starts.groupBy("part")).applyInArrow(_entered, STARTS), "batch_starts")
    cuts = narrow.groupBy("part").cogroup(starts.groupBy("part")).applyInArrow(_cuts(count, limit, part_rows), BUCKETS)
    buckets = materialize(cuts, "batch_cuts")
    bucket = F.floor(F.col("_number") / F.lit(count)).cast("long")
    batch = F.col("base") + F.size(F.filter("cuts", lambda row: row <= F.col("_number")))
    return rows.withColumn("bucket", bucket).join(buckets, "bucket").select(
        batch.cast("bigint").alias("batch_id"), F.col(id_col).isNull().alias("missing_id"),
        *(c for c in rows.columns if c != "_number"))
