"""SimHash near-duplicates by segment popcounts.

A fingerprint of 64 bits is embedded as 32 counts, the set bits of each 2-bit segment. Flipping a bit moves one count
by one, so the Manhattan distance of two embeddings is a lower bound of the Hamming distance. Counts are kept in unary
(0 -> 00, 1 -> 01, 2 -> 11), which packs the embedding into one long and makes the Manhattan distance of two embeddings
the popcount of their XOR.

The grid: the 32 counts form 8 blocks of 4. Two embeddings within Manhattan distance d differ in at most d blocks, so
they agree on some 8 - d of them; for every choice of 8 - d blocks the space is cut into cells of equal counts there, and
a linked pair shares a cell of at least one of these grids. Inside a cell the Manhattan bound is tested first and the
exact distance after it. A cell never emits its pairs: it emits a spanning forest of its links, at most one row per
fingerprint, found by comparing only fingerprints that are not yet connected. Cells with more than `cell_rows`
fingerprints are cut into chunks, each pair of chunks being one unit of work of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.identity import row_tag
from pulsekit.llm.common import free_name, settled, text_bytes

SEED = 42
BLOCKS = 8
_BLOCK_BITS = 64 // BLOCKS
# Largest number of fingerprints of one grid cell that one task compares; larger cells are cut into chunks.
CELL_ROWS = 50_000


def shingle_hashes(data: bytes | None, width: int) -> np.ndarray:
    """Hashes of the shingles of a text, repeats included; a text of fewer words has one shingle, all its words."""
    import xxhash

    words = (data or b"").lower().split()  # on bytes: lower-cases A-Z only, cuts at the six ASCII gaps only
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - width + 1)
    spans = zip(starts[:n].tolist(), ends[min(width, len(words)) - 1 :].tolist())
    return np.fromiter((xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in spans), "<u8", n)


def _fingerprint(data: bytes | None, width: int) -> int:
    hashes = shingle_hashes(data, width)
    n = len(hashes)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column | str, width: int = 4) -> Column:
    """SimHash of a text as a signed long over `width`-word shingles, repeats included.

    A text of fewer words has one shingle, all its words; a text without words, empty or NULL, has fingerprint 0.
    """

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        made = np.fromiter((_fingerprint(t.as_py(), width) for t in texts), np.uint64, len(texts))
        return pa.array(made.view(np.int64))

    return run(text_bytes(text))


def hex_digits(value: Column) -> Column:
    """16 lower-case hex digits of a long."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _thermometer(value: Column) -> Column:
    """Per-segment popcounts in unary: the bits of each 2-bit segment, sorted."""
    odd = F.shiftrightunsigned(value, 1).bitwiseAND(F.lit(0x5555555555555555))
    even = value.bitwiseAND(F.lit(0x5555555555555555))
    return F.shiftleft(odd.bitwiseAND(even), 1).bitwiseOR(odd.bitwiseOR(even))


def _sort_bits(x: np.ndarray) -> np.ndarray:
    mask = np.uint64(0x5555555555555555)
    odd, even = (x >> np.uint64(1)) & mask, x & mask
    return ((odd & even) << np.uint64(1)) | odd | even


def _masks(distance: int) -> list[int]:
    """For each choice of BLOCKS - distance blocks, the mask of their bits, as a signed long."""
    made = []
    for chosen in combinations(range(BLOCKS), BLOCKS - distance):
        mask = sum(((1 << _BLOCK_BITS) - 1) << (_BLOCK_BITS * b) for b in chosen)
        made.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return made


def _linked(points: np.ndarray, unary: np.ndarray, at: int, others: np.ndarray, distance: int) -> np.ndarray:
    """Which of `others` lie within `distance` of the point `at`: the Manhattan bound first, then exactly."""
    near = others[np.bitwise_count(unary[others] ^ unary[at]) <= distance]
    return near[np.bitwise_count(points[near] ^ points[at]) <= distance]


def _forest(points: np.ndarray, distance: int, left: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct `points`, as index pairs.

    A point is compared with the points of other components only, and points of the largest component wait: when no
    point outside it is left to try, all links across components have been seen. A dense group of near copies is one
    component after a few comparisons. With `left` (a flag per point), only links between the two sides are wanted.
    """
    unary, group, found = _sort_bits(points), np.arange(len(points)), []
    tried = np.zeros(len(points), bool)
    while True:
        largest = np.argmax(np.bincount(group))
        waiting = np.flatnonzero(~tried & (group != largest))
        if not len(waiting):
            return found
        at = int(waiting[0])
        tried[at] = True
        others = np.flatnonzero(group != group[at])
        if left is not None:
            others = others[left[others] != left[at]]
        near = _linked(points, unary, at, others, distance)
        if len(near):
            met, first = np.unique(group[near], return_index=True)
            found += [(at, int(j)) for j in near[first]]
            group[np.isin(group, met)] = group[at]


def _cells(batches: Iterator[pa.RecordBatch], distance: int, cell_rows: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) found in the cells of one partition; rows are (cell, side, point), a cell lies in one partition.

    Of a cell with more than `cell_rows` points only its name is given, with a NULL link."""
    cells, sides, points = [], [], []
    for batch in batches:
        cells.append(batch.column(0).to_numpy())
        sides.append(batch.column(1).to_numpy(zero_copy_only=False))
        points.append(batch.column(2).to_numpy())
    if not cells:
        return
    cell, side, point = np.concatenate(cells), np.concatenate(sides), np.concatenate(points).view(np.uint64)
    del cells, sides, points
    order = np.argsort(cell, kind="stable")
    cell, side, point = cell[order], side[order], point[order]
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    ends = np.r_[starts[1:], len(cell)]
    size = ends - starts
    # cells of two are by far the most: all at once
    two = starts[size == 2]
    a, b = point[two], point[two + 1]
    ok = (side[two] == 0) | (side[two] != side[two + 1])
    ok &= np.bitwise_count(_sort_bits(a) ^ _sort_bits(b)) <= distance
    ok[ok] = np.bitwise_count(a[ok] ^ b[ok]) <= distance
    from_, to = [a[ok]], [b[ok]]
    some = (size > 2) & (size <= cell_rows)
    for i, j in zip(starts[some].tolist(), ends[some].tolist()):
        own, flags = point[i:j], side[i:j]
        pairs = _forest(own, distance, flags == 1 if flags.any() else None)
        if pairs:
            index = np.array(pairs)
            from_.append(own[index[:, 0]])
            to.append(own[index[:, 1]])
    a, b = np.concatenate(from_).view(np.int64), np.concatenate(to).view(np.int64)
    large = cell[starts[size > cell_rows]]
    nulls = lambda n: pa.nulls(n, pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), nulls(len(a))], ["a", "b", "cell"])
    if len(large):
        yield pa.RecordBatch.from_arrays([nulls(len(large)), nulls(len(large)), pa.array(large)], ["a", "b", "cell"])


def links(fingerprints: DataFrame, distance: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links among distinct longs (column `fp`): rows (a, b), a < b, that connect exactly what all pairs within
    `distance` differing bits connect. A fingerprint without a link has no row."""
    if not 0 <= distance < BLOCKS:
        raise ValueError(f"distance must lie between 0 and {BLOCKS - 1}")
    spark = fingerprints.sparkSession
    masks = F.array(*[F.lit(m) for m in _masks(distance)])
    # few bytes but many cells: spread over all tasks before they multiply
    spread = fingerprints.select("fp").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "fp")
    rows = spread.select("fp", F.posexplode(masks).alias("grid", "mask")).select(
        F.xxhash64("grid", _thermometer(F.col("fp")).bitwiseAND(F.col("mask"))).alias("cell"), "fp"
    )
    # Two cells may share a hash: that only adds candidates, every link is verified.
    schema, one = "a long, b long, cell long", F.lit(0).cast("byte")
    compare = lambda df, most: df.repartition("cell").mapInArrow(lambda b: _cells(b, distance, most), schema)
    found = settled(compare(rows.select("cell", one.alias("side"), "fp"), cell_rows), "links")
    pairs = found.where("cell IS NULL").select("a", "b").distinct()
    large = found.where("cell IS NOT NULL").select("cell")
    if not large.limit(1).count():
        return pairs
    # Large cells: each chunk of one meets itself and every other chunk; in a pair of chunks, sides 1 and 2 are told apart.
    rows = rows.join(large, "cell")
    chunks = rows.groupBy("cell").agg(F.ceil(F.count("*") * 2 / cell_rows).cast("int").alias("chunks"))
    unit = rows.join(chunks, "cell").withColumn("chunk", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("chunks")).cast("int"))
    unit = unit.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        F.xxhash64("cell", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("cell"),
        F.when(F.col("chunk") == F.col("other"), 0).when(F.col("chunk") < F.col("other"), 1).otherwise(2).cast("byte").alias("side"),
        "fp",
    )
    # chunks are dealt by hash, so their sizes vary a little; all are compared
    return pairs.unionAll(compare(unit, 1 << 62).select("a", "b")).distinct()


def connected(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Components of rows (a, b) of longs: rows (node, label), label the smallest node of the component.

    Alternates two local steps over the edges, each of which keeps connectivity: all larger neighbours of a node hang
    on its smallest neighbour, then all smaller ones. Rounds grow with the logarithm of the longest path. A hub is cut
    to one row per task before the shuffle, as only minima are taken; each round is written and read again.
    """
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = settled(edges, "edges")
    before = _digest(edges)
    for _ in range(max_rounds):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select("b", "a"))
        # large step: the larger neighbours of u hang on the smallest node around u
        least = settled(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settled(large, "edges")
        # small step: u and its smaller neighbours hang on the smallest of them
        least = settled(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.col("v").alias("b"), F.col("m").alias("a"))
        small = small.unionAll(least.select(F.col("u").alias("b"), F.col("m").alias("a")))
        edges = settled(small.where("a <> b").distinct().select("a", "b"), "edges")
        after = _digest(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionAll(
        edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    )


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def near_duplicates(docs: DataFrame, distance: int = 4, width: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id (the smallest doc_id linked, directly or over others).

    NULL and empty texts share fingerprint 0 and link like any other. A NULL doc_id takes part but is never the smallest
    unless its component has no other; repeated rows stay. Extra columns of `docs` are not read.
    """
    marked = settled(docs.select("doc_id", fingerprint("text", width).alias("fp")), "fingerprints")
    return _classes(marked, distance, cell_rows).select(
        "doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def _classes(marked: DataFrame, distance: int, cell_rows: int) -> DataFrame:
    """`marked` (doc_id, fp, ...) with the label and the component_id of each row."""
    points = settled(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    return classes_of(marked, points, links(points.select("fp"), distance, cell_rows))


def classes_of(marked: DataFrame, points: DataFrame, found: DataFrame) -> DataFrame:
    """`marked` with the label and component_id of each row, from links `found` among `points` (fp, least doc_id)."""
    labels = connected(found)
    named = points.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    linked = named.where("label IS NOT NULL")
    least = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    alone = named.where("label IS NULL").select("fp", F.col("fp").alias("label"), F.col("least").alias("component_id"))
    classes = settled(alone.unionAll(linked.join(least, "label").select("fp", "label", "component_id")), "classes")
    # Both sides come from files, so a fingerprint that many documents share is split by adaptive execution.
    return marked.join(classes, "fp")


def keep_one(docs: DataFrame, distance: int = 4, width: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The documents with one row of each near-duplicate component: that of the smallest doc_id (then hash of the row,
    128 bits over all its columns).

    Columns are those of `docs`. Of repeated rows one stays. A row with a NULL doc_id stays only where its component has
    no other.
    """
    tag = free_name(docs, "row_tag")
    keyed = docs.withColumn(tag, row_tag(docs))
    marked = settled(keyed.select("doc_id", fingerprint("text", width).alias("fp"), F.col(tag).alias("tag")), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "tag")
    winner = _classes(marked, distance, cell_rows).groupBy("label").agg(F.min(order).alias("w"))
    winner = settled(winner.select(F.col("w.tag").alias(tag)), "winners")
    # the row tag holds the doc_id, so the copies of a text are spread here; repeated rows meet, and one stays
    rows = keyed.join(winner, tag, "left_semi").dropDuplicates([tag])
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
