"""Near-duplicate documents by an LSH forest of MinHash labels, confirmed on whole shingle sets.

Every tree orders all documents by its own label, a sequence of min-hashes; documents that
share a long prefix lie next to each other. Two passes over these orders find the links:

1. Neighbours in each order (longest common prefix) are compared; their links form components.
2. Regions, all documents that share ``MIN_DEPTH`` hashes of a tree, are searched completely if they
   still hold several components, whatever their size. Of a small region the pairs of different components
   are confirmed one by one; a larger one is compared where it lies, as a product of its documents'
   shingle sets, and yields links only.
3. The depth follows the region: one too large for a task is first searched deeper, at ``DEEPER`` hashes, where it falls
   into parts that fit, and what these link becomes one component before the documents meet at fewer hashes. At
   ``MIN_DEPTH`` what is still too large is cut into blocks that meet each other in pairs; blocks of the region's largest
   component do not meet each other. So depth decides the order of work, never which pairs are found.

A pair inside one component needs no comparison, so a group of thousands of copies costs a
few comparisons per copy, not one per pair. Documents with equal sets are one class and
enter once. Nothing is capped or sampled.

Ids, pairs and sets grow with the corpus, so their joins are never broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.components import components
from strataflow.llm.tokens import bound_batches, chunks, mix, shingles, words
from strataflow.storage import materialize

WIDTH = 5
PERCENT = 80

TREES = 24
MIN_DEPTH = 4  # hashes that documents of one region share
MAX_DEPTH = 8
DEEPER = (8, 6)  # depths of heavy regions, tried before MIN_DEPTH

SMALL_REGION = 16  # documents whose pairs are confirmed one by one
REGION_ITEMS = 2_000_000  # shingles of a region that one task compares; beyond, blocks of half as many
REGION_DOCS = 4_000  # the same for documents
_COLUMNS = 2048
_ROWS = 256

# Sketch of 128 one-bit hashes. Sets of similarity s agree in (1 + s) / 2 of the bits; pairs more than
# SIGMAS standard deviations below the threshold's mean are not worth reading two whole sets
# (one real link in some three million is below).
SKETCH_BITS = 128
SIGMAS = 5.0

_HASHES = TREES * MAX_DEPTH
_random = np.random.Generator(np.random.PCG64(77))
_MULTIPLY = (_random.integers(1, 2**31, _HASHES, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_SHIFT = _random.integers(0, 2**32, _HASHES, dtype=np.uint64).astype(np.uint32)
_BLOCK = 2048


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """``(first row, sorted distinct shingle hashes of each text)`` per chunk."""
    for row, data, offsets in chunks(texts):
        found = words(data, offsets, lower=True)
        hashes, at = shingles(found.hash, found.first, width, whole=True)
        yield row, [np.unique(hashes[at[i]:at[i + 1]]) for i in range(len(at) - 1)]


def _labels(sets: list[np.ndarray]) -> np.ndarray:
    """16-bit labels of all trees, one row per set; empty sets have zeros."""
    out = np.zeros((len(sets), _HASHES), np.uint16)
    for i, values in enumerate(sets):
        if not len(values):
            continue
        keys = (values >> np.uint64(32)).astype(np.uint32)
        least = np.full(_HASHES, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(keys), _BLOCK):
            hashed = (keys[at:at + _BLOCK, None] ^ _SHIFT) * _MULTIPLY
            np.minimum(least, hashed.min(axis=0), out=least)
        out[i] = (mix(least.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def _sign(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp", pa.binary()), ("sig", pa.binary())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets in shingle_sets(batch["text"], width):
                labels = _labels(sets)
                yield pa.record_batch([
                    batch["doc_id"].slice(row, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]),
                    pa.array([line.tobytes() if len(s) else None for s, line in zip(sets, labels)]),
                ], schema=schema)

    return sign


FOREST = "tree int, hi long, lo long, doc_id long, n long, s0 long, s1 long"
_FOREST_ARROW = pa.schema([
    ("tree", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()),
    ("s0", pa.int64()), ("s1", pa.int64()),
])


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document and tree: the label as two big-endian numbers, and the sketch."""
    for batch in batches:
        for start in range(0, batch.num_rows, 2048):
            part = batch.slice(start, 2048)
            labels = np.frombuffer(b"".join(part["sig"].to_pylist()), np.uint16).reshape(-1, _HASHES)
            halves = np.ascontiguousarray(labels.astype(">u2")).view(">i8").astype(np.int64)  # two per tree
            bits = np.packbits((labels[:, :SKETCH_BITS] >> 9 & 1).astype(np.uint8), axis=1).view("<i8")
            count = len(labels)
            repeat = lambda values: np.repeat(np.asarray(values), TREES)
            yield pa.record_batch([
                np.tile(np.arange(TREES, dtype=np.int32), count), halves[:, 0::2].ravel(), halves[:, 1::2].ravel(),
                repeat(part["doc_id"]), repeat(part["n_shingles"]), repeat(bits[:, 0]), repeat(bits[:, 1]),
            ], schema=_FOREST_ARROW)


def _least_agreement(percent: int) -> int:
    share = (1 + percent / 100) / 2
    return int(SKETCH_BITS * share - SIGMAS * (SKETCH_BITS * share * (1 - share)) ** 0.5)


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}


def _agree(rows: dict, i, j) -> np.ndarray:
    differ = sum(np.bitwise_count((rows[s][i] ^ rows[s][j]).view(np.uint64)).astype(np.int64) for s in ("s0", "s1"))
    return SKETCH_BITS - differ


def _sizes_fit(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


NEIGHBOURS = "a long, b long, near boolean, part int, last boolean, tree int, hi long, n long, s0 long, s1 long"


def _neighbours(percent: int):
    """Neighbours in a sorted order that share ``MIN_DEPTH`` hashes, and the two end rows of the partition."""
    least = _least_agreement(percent)
    schema = pa.schema([
        ("a", pa.int64()), ("b", pa.int64()), ("near", pa.bool_()), ("part", pa.int32()), ("last", pa.bool_()),
        ("tree", pa.int32()), ("hi", pa.int64()), ("n", pa.int64()), ("s0", pa.int64()), ("s1", pa.int64()),
    ])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), None
        end = lambda row, last: pa.record_batch(
            [[row["doc_id"][0]], [None], [None], [part], [last], *([row[c][0]] for c in ("tree", "hi", "n", "s0", "s1"))],
            schema=schema)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _columns(batch)
            if before is None:
                yield end({k: v[:1] for k, v in rows.items()}, False)
            else:
                rows = {k: np.concatenate([before[k], v]) for k, v in rows.items()}
            i = np.flatnonzero((rows["tree"][1:] == rows["tree"][:-1]) & (rows["hi"][1:] == rows["hi"][:-1]))
            j = i + 1
            near = _sizes_fit(rows["n"][i], rows["n"][j], percent) & (_agree(rows, i, j) >= least)
            a, b = rows["doc_id"][i], rows["doc_id"][j]
            nulls = [pa.nulls(len(i), f.type) for f in list(schema)[3:]]
            yield pa.record_batch([np.minimum(a, b), np.maximum(a, b), near, *nulls], schema=schema)
            before = {k: v[-1:] for k, v in rows.items()}
        if before is not None:
            yield end(before, True)

    return find


def _bit_agreement() -> F.Column:
    return F.lit(SKETCH_BITS) - F.bit_count(F.col("s0").bitwiseXOR(F.col("t0"))) - F.bit_count(
        F.col("s1").bitwiseXOR(F.col("t1")))


def _across_partitions(found: DataFrame, percent: int) -> DataFrame:
    """Neighbours that a partition boundary separates; two rows per partition take part."""
    order = Window.orderBy("part", F.col("last").asc())
    ends = found.where("part is not null").select("part", "last", "tree", "hi", "n", "s0", "s1", F.col("a").alias("x"))
    names = {"part": "next_part", "last": "next_last", "tree": "t", "hi": "h", "n": "m", "s0": "t0", "s1": "t1", "x": "y"}
    joined = ends.select("*", *(F.lead(c).over(order).alias(d) for c, d in names.items()))
    near = (100 * F.least("n", "m") >= percent * F.greatest("n", "m")) & (_bit_agreement() >= _least_agreement(percent))
    return joined.where("last and not next_last and tree = t and hi = h").select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), near.alias("near"))


def _sets(width: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets in shingle_sets(batch["text"], width):
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                yield pa.record_batch(
                    [batch["doc_id"].slice(row, len(sets)),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))],
                    names=["doc_id", "items"])

    return build


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose whole sets reach the threshold; integers only."""
    both = (
        pairs.hint("merge").join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x")), "a")
        .hint("merge").join(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y")), "b")
    )
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - shared
    return both.where(100 * shared >= percent * union).select("a", "b")


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Groups of sorted rows, also across batches."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[k].to_numpy(zero_copy_only=False) for k in keys]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for start, stop in zip(bounds, bounds[1:]):
            key = tuple(c[start] for c in columns)
            if kept and key != last:
                yield pa.Table.from_batches(kept)
                kept = []
            last = key
            kept.append(batch.slice(start, stop - start))
    if kept:
        yield pa.Table.from_batches(kept)


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([np.minimum(a, b), np.maximum(a, b)], schema=_PAIR)


def _small_regions(percent: int):
    """Pairs of different components in small regions, if size and sketch allow a link."""
    least = _least_agreement(percent)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ("tree", "hi")):
            rows = _columns(group.combine_chunks().to_batches()[0])
            i, j = np.triu_indices(len(rows["n"]), 1)
            good = rows["component"][i] != rows["component"][j]
            i, j = i[good], j[good]
            good = _sizes_fit(rows["n"][i], rows["n"][j], percent) & (_agree(rows, i, j) >= least)
            if good.any():
                yield _pair_batch(rows["doc_id"][i[good]], rows["doc_id"][j[good]])

    return find


def _shared_items(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all ``left`` with all ``right`` sets: a product of 0/1 rows, some columns at a time."""
    count, sets = len(left), [*left, *right]
    out = np.zeros((count, len(right)), np.float32)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    # An item of one side only, or of one set that stands on both, is shared by nobody.
    sides = [np.bincount(at[part], minlength=len(values)) for part in (owner < count, owner >= count)]
    often = np.flatnonzero((sides[0] > 0) & (sides[1] > 0) & (sides[0] + sides[1] > (2 if left is right else 1)))
    place = np.full(len(values), -1)
    place[often] = np.arange(len(often))
    column = place[at]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, len(often), _COLUMNS):
        inside = slice(*np.searchsorted(column, [start, start + _COLUMNS]))
        block = np.zeros((len(sets), min(_COLUMNS, len(often) - start)), np.float32)
        block[owner[inside], column[inside] - start] = 1
        out += block[:count] @ block[count:].T
    return out


def _links(ids: np.ndarray, component: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int):
    """One link for each two components of ``left`` and ``right`` rows that have any."""
    n = np.array([len(s) for s in sets])
    one_side = [sets[i] for i in left]
    shared = _shared_items(one_side, one_side if left is right else [sets[i] for i in right])
    for at in range(0, len(left), _ROWS):
        some, common = left[at:at + _ROWS], shared[at:at + _ROWS].astype(np.int64)
        linked = (100 + percent) * common >= percent * (n[some, None] + n[None, right])
        i, j = np.nonzero(linked & (component[some, None] != component[None, right]))
        i, j = some[i], right[j]
        if len(i):
            # One link joins two components as well as many.
            _, one = np.unique(np.stack([np.minimum(component[i], component[j]), np.maximum(component[i], component[j])]),
                               axis=1, return_index=True)
            yield _pair_batch(ids[i[one]], ids[j[one]])


def _large_regions(percent: int):
    """Links between different components of a region, or of a block, or between two blocks."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ("tree", "hi", "first", "second")):
            ids, component = group["doc_id"].to_numpy(), group["component"].to_numpy()
            if len(ids) < 2 or (component == component[0]).all():
                continue
            own = group["own"].to_numpy()
            first, second = group["first"][0].as_py(), group["second"][0].as_py()
            left = np.flatnonzero(own == first)
            right = left if first == second else np.flatnonzero(own == second)
            if not len(left) or not len(right):
                continue
            items = group["items"].combine_chunks()
            bounds, flat = items.offsets.to_numpy(), items.values.to_numpy()
            sets = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
            yield from _links(ids, component, sets, left, right, percent)

    return find


def _blocks(weight: F.Column, size: F.Column) -> F.Column:
    return F.greatest(F.ceil(weight / (REGION_ITEMS // 2)), F.ceil(size / (REGION_DOCS // 2)), F.lit(1)).cast("int")


def _fits() -> F.Column:
    """One task compares the region as a whole."""
    return (F.col("weight") <= REGION_ITEMS) & (F.col("size") <= REGION_DOCS)


def _in_blocks(large: DataFrame) -> DataFrame:
    """Rows of large regions, once for every pair of blocks that they take part in."""
    names = ["tree", "hi", "own", "first", "second", "doc_id", "component"]
    zero = F.lit(0)
    whole = large.where(_fits()).select("tree", "hi", zero.alias("own"), zero.alias("first"), zero.alias("second"), "doc_id", "component")
    heavy = large.where(~_fits())
    main = (
        heavy.groupBy("tree", "hi", "component").agg(F.sum("n").alias("w"), F.count("*").alias("s"))
        .groupBy("tree", "hi").agg(F.max(F.struct("w", "s", "component")).alias("main"))
    )
    # Blocks of the largest component stand behind those of the rest and meet only these.
    rest = _blocks(F.col("weight") - F.col("main.w"), F.col("size") - F.col("main.s"))
    dealt = (
        heavy.join(main, ["tree", "hi"])
        .withColumn("rest", rest).withColumn("mains", _blocks(F.col("main.w"), F.col("main.s")))
        .withColumn("in_main", F.col("component") == F.col("main.component"))
        .withColumn("own", F.when(F.col("in_main"), F.col("rest") + F.pmod(F.xxhash64("doc_id"), F.col("mains")))
                    .otherwise(F.pmod(F.xxhash64("doc_id"), F.col("rest"))).cast("int"))
        .withColumn("other", F.explode(F.sequence(zero, F.when(F.col("in_main"), F.col("rest"))
                                                  .otherwise(F.col("rest") + F.col("mains")) - 1)))
        .withColumn("first", F.least("own", "other")).withColumn("second", F.greatest("own", "other"))
    )
    return whole.unionByName(dealt.select(*names))


def _mixed(placed: DataFrame) -> DataFrame:
    """Regions that hold several components, with their documents and shingles."""
    return placed.groupBy("tree", "hi").agg(
        F.count("*").alias("size"), F.sum("n").alias("weight"), F.min("component").alias("c0"), F.max("component").alias("c1"),
    ).where("c0 < c1").drop("c0", "c1")


def _searched_regions(placed: DataFrame, sets: DataFrame, percent: int, regions: DataFrame | None = None) -> DataFrame:
    """Links between components that the ``regions`` (by default all) of ``placed`` show: ``a, b``."""
    rows = materialize(placed.join(_mixed(placed) if regions is None else regions, ["tree", "hi"]), "near_regions")
    small = (
        rows.where(F.col("size") <= SMALL_REGION).repartition("tree", "hi").sortWithinPartitions("tree", "hi", "doc_id")
        .mapInArrow(_small_regions(percent), "a long, b long").distinct()
    )
    met = _in_blocks(rows.where(F.col("size") > SMALL_REGION))
    keys = ["tree", "hi", "first", "second"]
    inside = (
        met.hint("merge").join(sets, "doc_id").repartition(*keys).sortWithinPartitions(*keys, "doc_id")
        .select(*keys, "own", "doc_id", "component", "items").mapInArrow(_large_regions(percent), "a long, b long")
    )
    return materialize(_confirm(small, sets, percent).union(inside), "near_late_links")


def _at_depth(placed: DataFrame, depth: int) -> DataFrame:
    """Rows whose regions share ``depth`` hashes, more than ``MIN_DEPTH``; two regions under one key would only be compared as well."""
    prefix = F.shiftrightunsigned("lo", 16 * (MAX_DEPTH - depth))
    return placed.withColumn("hi", F.xxhash64("hi", prefix))


def _merged(linked: DataFrame, links: DataFrame) -> DataFrame:
    return components(linked.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links))


def _linked_by_regions(planted: DataFrame, sets: DataFrame, linked: DataFrame, percent: int) -> DataFrame:
    """Components after all regions of ``planted`` are searched, heavy ones from their deepest parts upwards."""
    def placed() -> DataFrame:
        return planted.join(linked.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
            "component", F.coalesce("component", "doc_id"))

    regions = materialize(_mixed(placed()), "near_mixed")
    heavy = regions.where(~_fits()).select("tree", "hi")
    if not heavy.isEmpty():
        for depth in DEEPER:
            inner = _at_depth(placed().join(heavy, ["tree", "hi"], "left_semi"), depth)
            links = _searched_regions(inner, sets, percent, _mixed(inner).where(_fits()))
            linked = materialize(_merged(linked, links), "near_components")
        regions = materialize(_mixed(placed()), "near_mixed")
    return _merged(linked, _searched_regions(placed(), sets, percent, regions))


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs (doc_id, text)``: ``doc_id, n_shingles, component_id, kept``.

    Sets are the distinct shingles of ``width`` lower-cased words (fewer words: the whole
    sequence). Documents are linked if ``100 * shared >= percent * union``; a component's id is
    its smallest ``doc_id``. Null and empty texts are linked with nothing. Rows that repeat a
    ``doc_id`` and its text count as one document; an id must not stand for different texts (:func:`distinct_documents`
    numbers the rows itself). Rows without ``doc_id`` have neither component nor ``kept``. An empty table gives no rows,
    other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = materialize(
        texts.mapInArrow(_sign(width), "doc_id long, n_shingles long, fp binary, sig binary"), "near_signed"
    )
    reps = materialize(
        signed.where("fp is not null and doc_id is not null").groupBy("fp")
        .agg(F.min(F.struct("doc_id", "n_shingles", "sig")).alias("r")).select("fp", "r.*"),
        "near_classes",
    )
    forest = reps.select("doc_id", "n_shingles", "sig").mapInArrow(_plant, FOREST)
    ordered = forest.repartitionByRange("tree", "hi", "lo", "doc_id").sortWithinPartitions("tree", "hi", "lo", "doc_id")
    found = materialize(ordered.mapInArrow(_neighbours(percent), NEIGHBOURS), "near_neighbours")
    chained = materialize(
        found.where("b is not null").select("a", "b", "near").union(_across_partitions(found, percent)).distinct(),
        "near_chain",
    )
    partners = chained.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = materialize(
        texts.where("doc_id is not null").join(partners.hint("merge"), "doc_id", "left_semi")
        .dropDuplicates(["doc_id"]).mapInArrow(_sets(width), "doc_id long, items array<bigint>"),
        "near_sets",
    )
    links = materialize(_confirm(chained.where("near").select("a", "b"), sets, percent), "near_links")
    first = materialize(components(links), "near_components")

    # Only documents with neighbours are planted again.
    planted = reps.select("doc_id", "n_shingles", "sig").join(partners.hint("merge"), "doc_id", "left_semi").mapInArrow(_plant, FOREST)
    linked = _linked_by_regions(planted, sets, first, percent)

    classes = (
        reps.select("fp", "doc_id").join(linked.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("fp", F.coalesce("component", "doc_id").alias("component"))
    )
    return (
        signed.select("doc_id", "n_shingles", "fp").join(classes, "fp", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
                .alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )


def distinct_documents(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs`` that represent their component; all columns unchanged.

    Rows are numbered and compared one by one, whatever their ids. Of a component the row with the smallest
    ``doc_id`` stays (rows without id last). Texts without words stay, but of such rows that repeat a ``doc_id`` one.
    """
    row = "_row"
    while row in {c.lower() for c in docs.columns}:
        row += "_"
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "near_rows")
    found = near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"), width, percent)
    named = found.select(F.col("doc_id").alias("r"), "n_shingles", "component_id").join(
        numbered.select(F.col(row).alias("r"), F.col("doc_id").cast("long").alias("doc_id")), "r")
    wordless = F.col("n_shingles") == 0
    kind = F.when(~wordless, 0).when(F.col("doc_id").isNotNull(), 1).otherwise(2)
    member = F.when(~wordless, F.col("component_id")).otherwise(F.coalesce("doc_id", "r"))
    kept = (
        named.groupBy(kind.alias("kind"), member.alias("member"))
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "r")).alias("first")).select(F.col("first.r").alias(row))
    )
    return numbered.join(kept, row, "left_semi").drop(row)
