"""Tool calls linked to their results, ordered, checked and written as canonical JSON, in DataFrame functions only.

Calls and results meet in a hash join on (conv_id, call_id). Calls are ordered so that each comes after the calls it
depends on: where every dependency lies at an earlier position already, positions stay; only conversations that break
this are peeled, the calls without open dependencies first, one round per level. Arguments are held against schemas of
field types, and each link becomes one line of JSON with sorted keys.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import settled

# Field types a schema may name, and what Spark calls values of them in parsed JSON.
TYPES = {
    "string": ("STRING",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DOUBLE", "DECIMAL"),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
    "object": ("OBJECT",),
}

Schema = Mapping[str, tuple[str, bool]]


def problems(name: Column, arguments: Column, schemas: Mapping[str, Schema]) -> Column:
    """Sorted array of what is wrong with a call's arguments (a JSON text): unknown_tool, not_an_object,
    missing:<field>, wrong_type:<field>, unknown:<field>. Empty if they fit the schema of the tool."""
    value = F.try_parse_json(arguments)
    kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    keys = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
    each = F.lit(None).cast("array<string>")
    for tool, fields in schemas.items():
        found = []
        for field, (wanted, needed) in fields.items():
            there = F.array_contains(keys, F.lit(field))
            of = F.coalesce(F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant")), F.lit("VOID"))
            fits = F.lit(False)
            for start in TYPES[wanted]:
                fits = fits | of.startswith(start)
            if needed:
                found.append(F.when(~there, F.lit(f"missing:{field}")))
            found.append(F.when(there & ~fits, F.lit(f"wrong_type:{field}")))
        known = F.array(*[F.lit(f) for f in fields]) if fields else F.array().cast("array<string>")
        unknown = F.transform(F.array_distinct(F.array_except(keys, known)), lambda k: F.concat(F.lit("unknown:"), k))
        listed = F.concat(F.array_compact(F.array(*found)) if found else F.array().cast("array<string>"), unknown)
        each = F.when(name == tool, F.sort_array(listed)).otherwise(each)
    each = F.when(~kind.startswith("OBJECT"), F.array(F.lit("not_an_object"))).otherwise(each)
    return F.when(name.isNull() | ~name.isin(*schemas), F.array(F.lit("unknown_tool"))).otherwise(each)


def levels(calls: DataFrame) -> DataFrame:
    """Rows (conv_id, call_id, level) for `calls` (conv_id, call_id, position, after: array of call ids).

    Level 0, unless a conversation holds a call that depends on one at its own position or a later one; there the level is
    one more than that of the deepest call it depends on, and -1 for calls on a cycle or behind one. Ids that no call
    of the conversation has are ignored. Rounds grow with the longest chain of such conversations only.
    """
    calls = calls.where("call_id IS NOT NULL AND conv_id IS NOT NULL").groupBy("conv_id", "call_id")
    calls = calls.agg(F.min("position").alias("position"), F.array_distinct(F.flatten(F.collect_list("after"))).alias("after"))
    calls = settled(calls, "calls")
    needs = calls.select("conv_id", "call_id", "position", F.explode("after").alias("on"))
    there = calls.select("conv_id", F.col("call_id").alias("on"), F.col("position").alias("on_position"))
    needs = settled(needs.join(there, ["conv_id", "on"]), "needs")
    broken = needs.where("on_position >= position").select("conv_id").distinct()
    needs = settled(needs.join(broken, "conv_id", "left_semi").select("conv_id", "call_id", "on"), "open-needs")
    level, done = 0, None
    waiting = needs
    while waiting.limit(1).count():
        blocked = waiting.select("conv_id", "call_id").distinct()
        # calls that others wait for and that wait for nothing themselves
        ready = waiting.select("conv_id", F.col("on").alias("call_id")).distinct().join(blocked, ["conv_id", "call_id"], "left_anti")
        ready = settled(ready, "ready")
        freed = settled(waiting.join(ready.withColumnRenamed("call_id", "on"), ["conv_id", "on"], "left_anti"), "open-needs")
        level += 1
        now = blocked.join(freed.select("conv_id", "call_id").distinct(), ["conv_id", "call_id"], "left_anti")
        now = now.withColumn("level", F.lit(level))
        if not ready.limit(1).count():  # only cycles and what waits for them
            stuck = blocked.withColumn("level", F.lit(-1))
            done = stuck if done is None else done.unionByName(stuck)
            break
        now = settled(now, "levels")
        done = now if done is None else done.unionByName(now)
        waiting = freed
    base = calls.select("conv_id", "call_id")
    if done is None:
        return base.withColumn("level", F.lit(0))
    return base.join(done, ["conv_id", "call_id"], "left").withColumn("level", F.coalesce("level", F.lit(0)))


def link(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """One row per (conv_id, call_id) of either side: status, level, problems and the canonical JSON line.

    `calls`: conv_id, call_id, position, name, arguments (JSON text), after (array of call ids, may be NULL).
    `results`: conv_id, call_id, position, content. Of repeated ids the row of the smallest position counts, ties by
    content. Status is linked, no_result, no_call, or early_result (its position is not behind the call's). Rows with a
    NULL conv_id or call_id meet no partner and stay as they are. Sort a conversation by (level, position, call_id).
    """
    keys = ["conv_id", "call_id"]
    named = lambda df: df.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    loose = lambda df: df.where("conv_id IS NULL OR call_id IS NULL")
    first = lambda df, *c: df.groupBy(*keys).agg(F.min(F.struct("position", *c)).alias("r")).select(*keys, "r.*")
    c = first(named(calls), "name", "arguments").withColumn("called", F.lit(True))
    c = c.unionByName(loose(calls).select(*keys, "position", "name", "arguments").withColumn("called", F.lit(True)))
    r = first(named(results), "content").unionByName(loose(results).select(*keys, "position", "content"))
    r = r.select(*keys, F.col("position").alias("result_position"), "content", F.lit(True).alias("answered"))
    # level needs the calls alone, and only named ones
    c = c.join(levels(calls), keys, "left")
    both = c.join(r, keys, "full")
    status = (
        F.when(F.col("called").isNull(), "no_call")
        .when(F.col("answered").isNull(), "no_result")
        .when(F.col("result_position") <= F.col("position"), "early_result")
        .otherwise("linked")
    )
    wrong = F.when(F.col("called"), problems(F.col("name"), F.col("arguments"), schemas))
    both = both.withColumn("status", status).withColumn("problems", wrong)
    return both.select(
        *keys, "name", "position", "result_position", "level", "status", "problems", canonical().alias("canonical")
    )


def canonical() -> Column:
    """A link as one JSON object, keys sorted at every depth, no spaces; absent parts are left out. Arguments that are no
    JSON are kept as a string."""
    parsed = F.to_json(F.try_parse_json("arguments"))
    parts = [
        F.concat(F.lit('"arguments":'), F.coalesce(parsed, _json_string(F.col("arguments")))),
        F.concat(F.lit('"call_id":'), _json_string(F.col("call_id"))),
        F.concat(F.lit('"name":'), _json_string(F.col("name"))),
        F.concat(F.lit('"result":'), _json_string(F.col("content"))),
        F.concat(F.lit('"status":'), _json_string(F.col("status"))),
    ]
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*parts)), ","), F.lit("}"))


def _json_string(c: Column) -> Column:
    """A text as a JSON string."""
    line = F.to_json(F.struct(c.cast("string").alias("s")))
    return F.when(c.isNotNull(), F.substring(line, F.lit(6), F.length(line) - 6))
