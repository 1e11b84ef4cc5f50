"""How far each source of a language departs in its words from the other sources and from the language as a whole.

Tasks count terms with Arrow kernels: `ascii_lower`, `split_pattern_regex`, `dictionary_encode` and hash `group_by` turn a
slice of texts into partial counts per (group, term). Partial counts are dealt by language and term to columnar shards,
sorted there and merged as they stream by; a kept term leaves its shard as one row with the counts of all its sources, so
the divergences need no further shuffle of counts: a task lays a block of terms out as a matrix of terms and sources.

All arithmetic is on whole numbers: with N occurrences of V kept terms in a group, a term that occurs `count` times has
p = 1 + floor(10^9 * (count + 1) / (N + V)), and departs by floor((p - q)^2 / q) from a term of weight q.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.llm.common import settled

# A term is a run of anything but these characters: ASCII letters and whatever lies beyond ASCII.
BREAKS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 3
TOP_TERMS = 200
# Bytes of text counted at once, partial rows a task merges before it hands them on, cells of a matrix of terms and sources.
SLICE_BYTES = 8 << 20
HELD_ROWS = 1_000_000
CELLS = 4_000_000

_PARTIAL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
_KEPT = pa.schema([("lang", pa.string()), ("term", pa.string()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_FOUND = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64()), ("terms", pa.int64())])


def term_counts(rows: pa.Table) -> pa.Table:
    """Occurrences and documents of each term per (lang, source) of `rows` (lang, source, text), none of them NULL."""
    lists = pc.split_pattern_regex(pc.ascii_lower(rows["text"]), BREAKS)
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    row, terms = pc.list_parent_indices(lists), pc.list_flatten(lists)
    there = pc.greater(pc.binary_length(terms), 0)
    terms = terms.filter(there).dictionary_encode()
    each = pa.table({"row": row.filter(there), "term": terms.indices})
    each = each.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    each = each.append_column("lang", rows["lang"].combine_chunks().dictionary_encode().indices.take(each["row"]))
    each = each.append_column("source", rows["source"].combine_chunks().dictionary_encode().indices.take(each["row"]))
    sums = each.group_by(["lang", "source", "term"], use_threads=False).aggregate([("count_all", "sum"), ([], "count_all")])
    langs, sources = (rows[c].combine_chunks().dictionary_encode().dictionary for c in ("lang", "source"))
    return pa.table(
        [langs.take(sums["lang"]), sources.take(sums["source"]), terms.dictionary.take(sums["term"]), sums["count_all_sum"], sums["count_all"]],
        schema=_PARTIAL,
    )


def _merged(tables: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False)
    return whole.aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(_PARTIAL.names)


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with some `most` bytes of text; a longer text is a run of its own."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _count(batches: Iterator[pa.RecordBatch], slice_bytes: int, held_rows: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in batches:
        for rows in _slices(batch, slice_bytes):
            rows = pa.Table.from_batches([rows])
            # a group without terms has to be known, too: its row has the empty term
            groups = rows.group_by(["lang", "source"], use_threads=False).aggregate([])
            zero = pa.array(np.zeros(len(groups), np.int64))
            empty = pa.array([""] * len(groups), pa.string())
            held += [term_counts(rows), pa.table([groups["lang"], groups["source"], empty, zero, zero], schema=_PARTIAL)]
            if sum(map(len, held)) > held_rows:
                held = [_merged(held)]
                if len(held[0]) * 2 > held_rows:
                    yield from held[0].to_batches()
                    held = []
    if held:
        yield from _merged(held).to_batches()


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in columns of codes."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().dictionary_encode().indices.to_numpy()


def _keep(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (lang, term, source) to one row per kept term; the last term waits for the next batch."""

    def kept(rows: pa.Table) -> list[pa.RecordBatch]:
        one = _starts(_codes(rows["lang"]), _codes(rows["term"]), _codes(rows["source"]))
        n, docs = (np.add.reduceat(rows[c].to_numpy(), one) for c in ("n", "docs"))
        rows = rows.select(["lang", "term", "source"]).take(one)
        at = _starts(_codes(rows["lang"]), _codes(rows["term"]))
        total = np.add.reduceat(docs, at)
        sizes = np.diff(np.r_[at, len(rows)])
        # groups without terms pass as the empty term, which is no term
        wanted = (total >= min_docs) | (pc.equal(rows["term"], "").to_numpy()[at])
        inside = pa.array(np.repeat(wanted, sizes))
        offsets = pa.array(np.r_[0, np.cumsum(sizes[wanted])].astype(np.int32))
        heads = rows.select(["lang", "term"]).take(at[wanted])
        sources = pa.ListArray.from_arrays(offsets, rows["source"].filter(inside).combine_chunks())
        counts = pa.ListArray.from_arrays(offsets, pa.array(n).filter(inside))
        return pa.table([heads["lang"], heads["term"], sources, counts], schema=_KEPT).to_batches()

    waiting: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(pa.Table.from_batches([batch]))
        first, last = waiting[0].slice(0, 1).to_pylist()[0], batch.slice(batch.num_rows - 1).to_pylist()[0]
        if (first["lang"], first["term"]) == (last["lang"], last["term"]) and sum(map(len, waiting)) < 200_000:
            continue
        rows = pa.concat_tables(waiting)
        cut = int(_starts(_codes(rows["lang"]), _codes(rows["term"]))[-1])
        if cut:
            yield from kept(rows.slice(0, cut))
        # a term with very many partial rows shrinks to one per source while it waits
        rest = rows.slice(cut)
        waiting = [_merged([rest]).select(_PARTIAL.names).sort_by("source") if len(rest) > 100_000 else rest]
    if waiting:
        yield from kept(pa.concat_tables(waiting))


def weight(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10^9 * (count + 1) / total), exact: long division by thousands, for totals below 9 * 10^15."""
    total = np.asarray(total, np.int64)
    left, out = count + 1, np.zeros(np.broadcast(count, total).shape, np.int64)
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // total
        left = left % total
    # count + 1 may exceed the total only if both are 1; its whole part is in `out` already
    return 1 + out


def departure(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _diverge(batches: Iterator[pa.RecordBatch], groups: dict[str, tuple[list[str], np.ndarray, int]], top: int, cells: int) -> Iterator[pa.RecordBatch]:
    """Rows of `_FOUND` for blocks of kept terms. A `pair` row sums the terms that occur in one of its two sources and says
    how many these are; `term` rows are the block's best."""

    def block(lang: str, terms: pa.Array, sources: pa.Array, counts: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        names, totals, v = groups[lang]
        count = np.zeros((len(terms), len(names)), np.int64)
        row = np.repeat(np.arange(len(terms)), sizes)
        count[row, pc.index_in(sources, value_set=pa.array(names, pa.string())).to_numpy(zero_copy_only=False)] = counts
        p, none = weight(count, totals + v), weight(np.zeros(len(names), np.int64), totals + v)
        there = count > 0
        row, column = np.nonzero(there.T)[::-1]  # by source, for sums of runs
        runs = _starts(column)
        p_there = p[row, column]
        named = pa.array(names, pa.string())
        for t in range(len(names)):
            mine = there[:, t]
            value = departure(p[mine], p[mine, t][:, None]).sum(axis=0)
            seen = np.full(len(names), int(mine.sum()), np.int64)
            if len(row):
                other = ~mine[row]
                value[column[runs]] += np.add.reduceat(np.where(other, departure(p_there, none[t]), 0), runs)
                seen[column[runs]] += np.add.reduceat(other.astype(np.int64), runs)
            rest = np.arange(len(names)) != t
            columns = [[lang] * int(rest.sum()), named.filter(pa.array(rest)), ["pair"] * int(rest.sum()), [names[t]] * int(rest.sum())]
            columns = [c if isinstance(c, pa.Array) else pa.array(c, pa.string()) for c in columns]
            yield pa.record_batch([*columns, pa.array(value[rest]), pa.array(seen[rest])], schema=_FOUND)
        q = weight(count.sum(axis=1), int(totals.sum()) + v)
        for s in range(len(names)):
            at = np.flatnonzero(there[:, s] & (p[:, s] > q))
            if not len(at):
                continue
            best = pa.table([terms.take(pa.array(at)), pa.array(departure(p[at, s], q[at]))], names=["item", "value"])
            best = best.take(pc.select_k_unstable(best, top, [("value", "descending"), ("item", "ascending")])).combine_chunks()
            n = len(best)
            fixed = [pa.array([x] * n, pa.string()) for x in (lang, names[s], "term")]
            item, value = (best[c].combine_chunks() for c in ("item", "value"))
            yield pa.record_batch([*fixed, item, value, pa.array(np.zeros(n, np.int64))], schema=_FOUND)

    def blocks(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        for lang in rows["lang"].unique().to_pylist():
            mine = rows.filter(pc.equal(rows["lang"], lang)).combine_chunks()
            terms, sources, counts = (mine[c].combine_chunks() for c in ("term", "sources", "counts"))
            height = max(1, cells // max(1, len(groups[lang][0])))
            for i in range(0, len(mine), height):
                part = slice(i, i + height)
                sizes = sources[part].value_lengths().to_numpy()
                yield from block(lang, terms[part], sources[part].flatten(), counts[part].flatten().to_numpy(), sizes)

    waiting, size = [], 0
    for batch in batches:
        waiting.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size * max(len(names) for names, _, _ in groups.values()) >= cells:
            yield from blocks(pa.concat_tables(waiting))
            waiting, size = [], 0
    if size:
        yield from blocks(pa.concat_tables(waiting))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, cells: int = CELLS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank). `pair`: how far the source departs from each other source (item) of its
    language; `term`: the up to `top` terms by which it departs most from its language. Largest value first, ties by item.

    Kept are the terms of a language in at least `min_docs` of its rows; repeated rows count each. NULL lang, source and
    text count as ''; a source without terms has pairs, and a language without kept terms pairs of value 0. Texts are
    counted whole, in slices of bounded size. An empty table gives no rows; only lang, source and text are read.

    The groups (lang, source) with their totals go to the driver and to every task. That table cannot be large where the
    result is possible: a language's part of the result grows with the square of its number of sources.
    """
    spark = docs.sparkSession
    filled = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    partial = filled.mapInArrow(lambda b: _count(b, SLICE_BYTES, HELD_ROWS), "lang string, source string, term string, n long, docs long")
    dealt = partial.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    kept = dealt.mapInArrow(lambda b: _keep(b, min_docs), "lang string, term string, sources array<string>, counts array<long>")
    kept = settled(kept, "kept-terms")
    sums = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c")).groupBy("lang", F.col("c.sources").alias("source"))
    sums = settled(sums.agg(F.sum("c.counts").alias("total")), "source-totals")
    sizes = {r.lang: r.n for r in kept.where("term <> ''").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    listed = sums.orderBy("lang", "source").collect()
    groups = {}
    for lang in {r.lang for r in listed}:
        own = [r for r in listed if r.lang == lang]
        groups[lang] = ([r.source for r in own], np.array([r.total for r in own], np.int64), sizes.get(lang, 0))
    schema = "lang string, source string, part string, item string, value long, terms long"
    found = settled(kept.where("term <> ''").mapInArrow(lambda b: _diverge(b, groups, top, cells), schema), "divergences")
    # terms that neither source has weigh the same each
    v = spark.createDataFrame([(lang, n) for lang, (_, _, n) in groups.items()], "lang string, v long")
    share = F.expr("1 + 1000000000BD div CAST(total + greatest(v, 1) AS DECIMAL(20, 0))").cast("bigint")
    sources = sums.join(v, "lang").select("lang", "source", share.alias("p"))
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    both = sources.join(sources.select("lang", F.col("source").alias("item"), F.col("p").alias("q")), "lang").where("source <> item")
    both = both.join(pairs, ["lang", "source", "item"], "left").join(v, "lang")
    rest = (F.col("v") - F.coalesce("terms", F.lit(0))) * F.expr("(p - q) * (p - q) div q")
    both = both.select("lang", "source", F.lit("pair").alias("part"), "item", (F.coalesce("value", F.lit(0)) + rest).cast("bigint").alias("value"))
    best = found.where("part = 'term'").select("lang", "source", "part", "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    best = best.withColumn("rank", rank).where(F.col("rank") <= top)
    return both.withColumn("rank", rank).unionByName(best)
