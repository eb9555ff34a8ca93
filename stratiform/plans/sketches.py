"""Profiles that merge between loads: value ranges, payload types, and overlaps of keys.

Each is an aggregate whose state is small and bounded: a KLL sketch of values, the set of types that a path has,
a theta sketch of keys. A load's states can be stored and merged with those of other loads in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform import schemas as S

VARIABLES = [c for name, c in S.METRICS.items() if name not in S.TEXT_METRICS]

#: Size of a KLL sketch, and the error of its ranks that holds but for one sketch in many thousands.
KLL_SIZE = 800
RANK_ERROR = 0.01
#: log2 of the keys that a theta sketch keeps; with fewer keys it is exact, beyond its error is about 1 / sqrt(size).
THETA_LOG = 14


# -- value ranges -----------------------------------------------------------------------


def value_sketches(rows: DataFrame, by: list[str] | None = None, variables: list[str] | None = None) -> DataFrame:
    """(by..., variable, values, sketch) of each variable; NULLs and values that are no finite numbers are left out."""
    variables = variables or VARIABLES
    finite = [F.when(F.abs(c) < float("inf"), F.col(c)).alias(c) for c in variables]
    narrow = rows.select(*(by or []), *finite)
    parts = [x for c in variables for x in (F.kll_sketch_agg_double(c, F.lit(KLL_SIZE)).alias(f"s_{c}"), F.count(c).alias(f"n_{c}"))]
    grouped = narrow.groupBy(*(by or [])).agg(*parts)
    each = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"n_{c}").alias("values"), F.col(f"s_{c}").alias("sketch")) for c in variables])
    return grouped.select(*(by or []), F.inline(each)).filter("values > 0")


def merged_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sketches of many loads as one for each variable."""
    return sketches.groupBy(*(by or []), "variable").agg(F.sum("values").alias("values"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, ranks: list[float]) -> DataFrame:
    """(..., rank, value): a value for each rank, whose true rank is within RANK_ERROR."""
    at = F.array(*[F.lit(float(r)) for r in ranks])
    values = F.kll_sketch_get_quantile_double("sketch", at)
    pairs = F.zip_with(at, values, lambda r, v: F.struct(r.alias("rank"), v.alias("value")))
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], F.inline(pairs))


def learned_ranges(sketches: DataFrame, spread: float = 3.0) -> dict[str, tuple[float, float]]:
    """A range for each variable from its own values, for ``quality.range_checks``: the middle half, and
    ``spread`` times its width on both sides. One row for each variable comes to the driver."""
    rows = quantiles(sketches, [0.25, 0.75]).groupBy("variable").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return {r["variable"]: (r["low"] - spread * (r["high"] - r["low"]), r["high"] + spread * (r["high"] - r["low"])) for r in rows.collect()}


# -- payload types ----------------------------------------------------------------------

NOTHING, MIXED = "nothing", "variant"


def _kind(schema: Column) -> Column:
    """The kind of a value by Spark's own type of it."""
    numbers = schema.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)")
    return (
        F.when(schema == "VOID", "null")
        .when(schema == "BOOLEAN", "boolean")
        .when(numbers, "number")
        .when(schema.startswith("ARRAY"), "array")
        .when(schema.startswith("OBJECT"), "object")
        .otherwise("string")
    )


def _kind_of(value: Column) -> Column:
    return _kind(F.schema_of_variant(value))


def payload_kinds(documents: DataFrame, raw: str = "raw_api_response", by: list[str] | None = None, below: str = "hourly") -> DataFrame:
    """(by..., path, documents, kinds, items) over all documents that are JSON objects: how many have the path, the
    kinds of its values, and the kinds of items where they are arrays. Paths are the top keys and those ``below`` one of them.

    The path '$' counts the documents. States merge: sums of documents, unions of kinds.
    """
    members = "map<string,variant>"
    parsed = documents.select(*(by or []), F.try_parse_json(raw).alias("_v"))
    rows = parsed.select(*(by or []), "_v", F.try_variant_get("_v", "$", members).alias("_top")).filter("_top IS NOT NULL")
    deeper = F.coalesce(F.try_variant_get("_v", f"$.{below}", members), F.create_map().cast(members))
    pairs = F.concat(
        F.array(F.struct(F.lit("$").alias("path"), F.col("_v").alias("value"))),
        F.transform(F.map_entries("_top"), lambda e: F.struct(e["key"].alias("path"), e["value"].alias("value"))),
        F.transform(F.map_entries(deeper), lambda e: F.struct(F.concat(F.lit(f"{below}."), e["key"]).alias("path"), e["value"].alias("value"))),
    )
    values = rows.select(*(by or []), F.inline(pairs))
    elements = F.coalesce(F.try_variant_get("value", "$", "array<variant>"), F.array().cast("array<variant>"))
    typed = values.select(*(by or []), "path", _kind_of(F.col("value")).alias("kind"), F.array_distinct(F.transform(elements, _element)).alias("items"))
    # one row for each set of kinds, of which there are few, before the kinds are joined
    counted = typed.groupBy(*(by or []), "path", "kind", "items").agg(F.count("*").alias("documents"))
    return merged_kinds(counted.withColumn("kinds", F.array("kind")), by)


def _element(value: Column) -> Column:
    """A NULL item of an array is a JSON null."""
    return F.when(value.isNull(), "null").otherwise(_kind_of(value))


def merged_kinds(states: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The states of many loads as one for each path."""
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c)
    return states.groupBy(*(by or []), "path").agg(F.sum("documents").alias("documents"), union("kinds"), union("items"))


def _joined(kinds: Column) -> Column:
    """The least type above some kinds: a null adds nothing, and kinds that differ make a mixed one."""
    known = F.array_remove(kinds, "null")
    return F.when(F.size(known) > 1, MIXED).when(F.size(known) == 1, known[0]).when(F.size(kinds) > 0, "null").otherwise(NOTHING)


def payload_types(states: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., path, type, documents, missing): the joined type of each path, and in how many documents it is missing."""
    kind = _joined(F.col("kinds"))
    whole = F.when(kind == "array", F.concat(F.lit("array<"), _joined(F.col("items")), F.lit(">"))).otherwise(kind)
    totals = states.filter("path = '$'").select(*(by or []), F.col("documents").alias("_all"))
    rows = states.filter("path <> '$'")
    # without groups the total is one value
    met = rows.join(totals, by) if by else rows.withColumn("_all", totals.scalar())
    return met.select(*(by or []), "path", whole.alias("type"), "documents", (F.col("_all") - F.col("documents")).alias("missing"))


def drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, change, type_before, type_after) of the paths whose type differs between two loads, or that come or go."""
    a, b = (df.select("path", F.col("type").alias(n)) for df, n in ((before, "type_before"), (after, "type_after")))
    change = F.when(F.col("type_before").isNull(), "new").when(F.col("type_after").isNull(), "gone").otherwise("changed")
    met = a.join(b, "path", "full_outer").filter(~F.col("type_before").eqNullSafe(F.col("type_after")))
    return met.select("path", change.alias("change"), "type_before", "type_after")


# -- overlap of keys --------------------------------------------------------------------


def key_sketches(rows: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """(by..., keys): a theta sketch of the keys of each group; keys with a NULL are left out."""
    hashed = rows.dropna(subset=key).select(*by, F.xxhash64(*key).alias("_key"))
    return hashed.groupBy(*by).agg(F.theta_sketch_agg("_key", F.lit(THETA_LOG)).alias("keys"))


def overlap(stored: DataFrame, arriving: DataFrame, by: list[str]) -> DataFrame:
    """(by..., stored, arriving, common, action) of the groups that a delivery touches, from sketches alone.

    action: 'new' where nothing is stored, 'append' where no key is known, 'merge' where some are. A sketch with
    up to 2 ** THETA_LOG keys is exact. Beyond, few common keys may look like none, so 'append' stands
    only where both sketches are exact.
    """
    held = stored.select(*by, F.col("keys").alias("_held"))
    met = arriving.join(held, by, "left")
    exact = F.lit(1 << THETA_LOG)
    counts = met.select(
        *by,
        F.coalesce(F.theta_sketch_estimate("_held"), F.lit(0)).alias("stored"),
        F.theta_sketch_estimate("keys").alias("arriving"),
        F.coalesce(F.when(F.col("_held").isNotNull(), F.theta_sketch_estimate(F.theta_intersection("_held", "keys"))), F.lit(0)).alias("common"),
    )
    sure = (F.col("stored") < exact) & (F.col("arriving") < exact)
    action = F.when(F.col("stored") == 0, "new").when((F.col("common") == 0) & sure, "append").otherwise("merge")
    return counts.withColumn("action", action)
