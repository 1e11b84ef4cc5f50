"""Mixing sources to target weights on a low-discrepancy schedule.

Slot k of the mix goes to the source in whose interval of cumulative shares the golden-ratio point frac(k * phi) falls,
so every stretch of the schedule holds the sources in nearly their shares. Slots are ranked per source. Each source's
documents, in shuffled order, form one line of tokens cut into equal blocks; the slot of rank r takes block r mod blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsekit.functions.identity import row_tag
from pulsekit.llm.common import settled, word_count

# Weights of the sources in order of their names (code points, NULL last), repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_PASSES = 2
BLOCK_TOKENS = 256
_PHI = 0.6180339887498949
_CELLS = 4096
_STRETCH = 65_536
_BUCKETS = 4096


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = MAX_PASSES) -> DataFrame:
    """Rows (source, source_size) with their `target`: weights share `share` of all sizes, no target above `passes` times
    its size, the excess reshared by weight until none is above. The window runs over one row per source."""
    by_name, full = Window.orderBy(F.col("source").isNull(), F.col("source")), Window.partitionBy()
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("weight", wheel[(F.row_number().over(by_name) - 1) % len(weights)])
    ranked = ranked.withColumn("cap", F.col("source_size") * float(passes))
    # Fill in order of cap per weight: with the sources before this one at their cap, what is the level of the rest?
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    used = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    total = F.sum("source_size").over(full) * float(share)
    level = (total - filled) / (F.sum("weight").over(full) - used)
    ranked = ranked.withColumn("level", level)
    # the first source whose cap lies above the level fixes it for itself and all after it, those of the same cap too
    ranked = ranked.withColumn("nth", F.row_number().over(order))
    fixed = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("nth", "level"))).over(full)
    target = F.least(F.coalesce(fixed["level"] * F.col("weight"), F.col("cap")), F.col("cap"))
    return ranked.select(*sizes.columns, target.alias("target"))


def _key() -> Column:
    """A source as a join key that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def schedule(spark: SparkSession, plan: DataFrame) -> DataFrame:
    """Slots (slot, key, rank) for `plan` rows (key, source, source_size, target, blocks); ranks count from 0 per source.

    Built by the cluster from slot numbers; a point finds its source through a grid over [0, 1)."""
    plan = plan.where("target > 0").withColumn("want", F.col("target") * F.col("blocks") / F.col("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    upto = F.sum("want").over(order.rowsBetween(Window.unboundedPreceding, 0))
    total, last = F.sum("want").over(Window.partitionBy()), F.lead("key").over(order).isNull()
    high = F.when(last, 2.0).otherwise(upto / total)  # the last interval is open, whatever rounding did
    shares = plan.select("key", ((upto - F.col("want")) / total).alias("low"), high.alias("high"), total.alias("n"))
    shares = settled(shares, "shares")
    n = round(shares.agg(F.max("n")).first()[0] or 0)
    cell = lambda c: F.least(F.floor(c * _CELLS), F.lit(_CELLS - 1))
    cells = F.sequence(cell(F.col("low")), cell(F.col("high")))
    grid = settled(shares.select("key", "low", "high", F.explode(cells).alias("cell")), "grid")
    point = F.col("id") * F.lit(_PHI)
    points = spark.range(n).select(F.col("id").alias("slot"), (point - F.floor(point)).alias("point"))
    points = points.withColumn("cell", cell(F.col("point")))
    found = points.join(grid, "cell").where("point >= low AND point < high")
    found = settled(found.select("slot", "key", F.expr(f"slot div {_STRETCH}").alias("stretch")), "slots")
    # ranks in two steps, so that no source is numbered by one task: slots before each stretch, then inside it
    over = Window.partitionBy("key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    base = found.groupBy("key", "stretch").agg(F.count("*").alias("n"))
    base = base.select("key", "stretch", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
    nth = F.row_number().over(Window.partitionBy("key", "stretch").orderBy("slot")) - 1
    ranked = found.withColumn("nth", nth).join(base, ["key", "stretch"])
    return ranked.select("slot", "key", (F.col("nth") + F.col("base")).cast("bigint").alias("rank"))


def _placed(rows: DataFrame, seed: int) -> DataFrame:
    """`rows` (doc_id, key, size, tag, ...) with `start`: where each begins on its source's shuffled line of tokens."""
    rows = rows.withColumn("h", F.xxhash64("doc_id", F.lit(seed))).withColumn("bucket", F.shiftrightunsigned("h", 52))
    rows = settled(rows, "sized")
    over = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("key", "bucket").agg(F.sum("size").alias("tokens"))
    base = base.select("key", "bucket", F.coalesce(F.sum("tokens").over(over), F.lit(0)).alias("base"))
    own = Window.partitionBy("key", "bucket").orderBy("h", "doc_id", "tag").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("local", F.coalesce(F.sum("size").over(own), F.lit(0))).join(base, ["key", "bucket"])
    return rows.withColumn("start", (F.col("local") + F.col("base")).cast("bigint")).drop("local", "base", "bucket", "h")


def mix(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = MAX_PASSES, block: int = BLOCK_TOKENS, seed: int = 11
) -> DataFrame:
    """One row per document: doc_id, source, tag, size, source_size, target, taken, and `parts`, the tokens taken in each
    pass over the source. A document's tag is a hash of its columns; reruns agree.

    Sizes are words; a NULL or empty text has size 0 and nothing is taken of it. NULL is a source of its own, the last.
    Repeated rows stay apart on the line. An empty table gives no rows.
    """
    tag = row_tag(docs)
    rows = docs.select("doc_id", "source", _key().alias("key"), word_count("text").alias("size"), tag.alias("tag"))
    placed = settled(_placed(rows, seed), "placed")
    sizes = placed.groupBy("key", "source").agg(F.sum("size").cast("bigint").alias("source_size"))
    # equal blocks, the last of a source may be shorter
    count = F.greatest(F.lit(1), F.round(F.col("source_size") / block))
    length = F.greatest(F.lit(1), F.ceil(F.col("source_size") / count)).cast("bigint")
    plan = targets(sizes, weights, share, passes).withColumn("length", length)
    plan = settled(plan.withColumn("blocks", F.ceil(F.col("source_size") / F.col("length")).cast("bigint")), "targets")
    sources = plan.select("key", "source_size", "target", "length", "blocks")
    slots = schedule(docs.sparkSession, plan).join(sources, "key")
    slots = slots.select("key", (F.col("rank") % F.col("blocks")).alias("block"), F.expr("rank div blocks").alias("pass"))
    # the passes that take a block; what the points give beyond the last pass stays out
    takes = slots.where(F.col("pass") < passes).groupBy("key", "block").agg(F.collect_set("pass").alias("passes"))
    line = placed.join(sources, "key")
    spans = F.sequence(F.expr("start div length"), F.expr("(start + size - 1) div length"))
    line = line.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, spans)))
    low = F.greatest(F.col("start"), F.col("block") * F.col("length"))
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("length"))
    pieces = line.withColumn("piece", high - low).join(takes, ["key", "block"], "left")
    parts = [
        F.coalesce(F.sum(F.when(F.array_contains("passes", F.lit(p).cast("bigint")), F.col("piece"))), F.lit(0)).alias(f"part{p}")
        for p in range(passes)
    ]
    keys = ["doc_id", "source", "tag", "size", "start", "source_size", "target"]
    done = pieces.groupBy(*keys).agg(*parts, F.count("*").alias("rows"))
    # repeated rows without words have one place on the line; each comes out again
    again = F.sequence(F.lit(1), F.when(F.col("size") == 0, F.col("rows")).otherwise(F.lit(1)))
    taken = sum((F.col(f"part{p}") for p in range(passes)), F.lit(0)).cast("bigint")
    return done.withColumn("again", F.explode(again)).select(
        "doc_id", "source", "tag", "size", "source_size", "target", taken.alias("taken"),
        F.array(*[F.col(f"part{p}") for p in range(passes)]).alias("parts"),
    )


def _first_words(text: Column, n: Column) -> Column:
    """The first n words of a text, joined by single spaces."""
    words = F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), " ")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents, columns as in `docs`: one row per document and pass that takes words of it.

    A pass takes a source's line from its start, so at most two documents per source and pass are cut; those keep
    their first words, joined by single spaces. Documents of which nothing is taken, wordless ones too, are left out.
    """
    # every name here is made longer than any column of the documents, and so is none of them
    mark = "_" * (1 + max(map(len, docs.columns)))
    tag, size, part, copies, t = (f"{mark}{c}" for c in ("tag", "size", "part", "copies", "t"))
    taken = mix(docs, **options).where("taken > 0").select(F.col("tag").alias(t), F.col("size").alias(size), F.explode("parts").alias(part))
    taken = settled(taken.where(F.col(part) > 0), "taken")
    # repeated rows share a tag and are taken one by one
    taken = taken.groupBy(t, size, part).agg(F.count("*").alias(copies))
    rows = docs.withColumn(tag, row_tag(docs)).dropDuplicates([tag]).join(taken, F.col(tag) == F.col(t))
    text = F.when(F.col(part) < F.col(size), _first_words(F.col("text"), F.col(part))).otherwise(F.col("text"))
    rows = rows.withColumn("text", text).withColumn(tag, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies))))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
