"""Bronze with its payload as a shredded VARIANT, so that silver reads only the arrays it needs.

A document is parsed once, when it is converted. Spark infers the shape of the documents while it writes and
lays every path that it finds out as a Parquet column of its own; reading a path then reads
that column alone, without parsing. What a VARIANT would not keep stays beside it: the spelling of text
items ('3.0'), and the raw text of documents whose items are not plain numbers. Those
few take the way of ``silver.flatten``, which is the same for both forms.

Defined cases. A JSON null or a missing array is NULL. A document that is no JSON or has a key twice keeps its
text. Order of keys and spelling of numbers are not kept in a VARIANT; ``keep_text`` keeps all texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform import schemas as S
from stratiform.functions.documents import CORRUPT, parse_payload
from stratiform.operators.flatten import zip_longest
from stratiform.plans import silver

PAYLOAD, TEXTS = "payload", "text_items"
_SPELLED = T.StructType([T.StructField(name, T.ArrayType(T.StringType())) for name in S.METRICS if name in S.TEXT_METRICS])
VARIANT_BRONZE = T.StructType([
    *(T.StructField(f.name, f.dataType) for f in S.BRONZE),
    T.StructField(PAYLOAD, T.VariantType()),
    T.StructField(TEXTS, _SPELLED),
])
_PLACE = ["latitude", "longitude"]
#: A zero with a sign, which a VARIANT holds without it.
_SIGNED_ZERO = r"-0+(\.0+)?([eE][-+]?[0-9]+)?\s*[,\]}]"


def with_variant(bronze: DataFrame, keep_text: bool = False) -> DataFrame:
    """Bronze rows in the columns of VARIANT_BRONZE; a payload only where all items are plain numbers."""
    raw = F.col("raw_api_response")
    typed = parse_payload(raw, S.METRICS, [*silver.NUMBERS, *_PLACE])
    read = bronze.select(*S.BRONZE.names, F.try_parse_json(raw).alias("_v"), typed.alias("_p"))
    plain = F.col(f"_p.{CORRUPT}").isNull() & F.col("_v").isNotNull() & ~raw.rlike(_SIGNED_ZERO)
    spelled = F.struct(*[F.col(f"_p.hourly.{name}").alias(name) for name in _SPELLED.names])
    rows = read.withColumn(PAYLOAD, F.when(plain, F.col("_v"))).withColumn(TEXTS, F.when(plain, spelled))
    if not keep_text:
        rows = rows.withColumn("raw_api_response", F.when(F.col(PAYLOAD).isNull(), raw))
    return rows.select(*VARIANT_BRONZE.names)


def read_variant(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VARIANT_BRONZE).parquet(path)


def _path(*keys: str, kind: str) -> Column:
    return F.variant_get(F.col(PAYLOAD), "$." + ".".join(keys), kind)


def flatten_variant(rows: DataFrame) -> DataFrame:
    """The rows of ``silver.flatten``, from shredded payloads and, for documents that have none, from their text."""
    plain = rows.filter(F.col(PAYLOAD).isNotNull())
    read = plain.select(
        F.col("record_id").alias("bronze_record_id"),
        "location_name",
        *[_path(c, kind="double").alias(c) for c in _PLACE],
        _path("timezone", kind="string").alias("timezone"),
        "api_retrieval_time",
        F.lit(False).alias("_broken"),
        F.lit(False).alias("_bad_place"),
        _path("hourly", "time", kind="array<string>").alias("_time"),
        *[_path("hourly", name, kind="array<double>").alias(f"_{name}") for name in silver.NUMBERS],
        *[F.col(f"{TEXTS}.{name}").alias(f"_{name}") for name in _SPELLED.names],
    )
    keep = [F.col(c) for c in ("bronze_record_id", "location_name", *_PLACE, "timezone", "api_retrieval_time", "_broken", "_bad_place")]
    items = {
        "time": "coalesce(_time, array())",
        "timestamp": "try_cast(coalesce(_time, array()) AS array<timestamp>)",
        **{name: f"coalesce(_{name}, array())" for name in S.METRICS},
        "bad": "cast(array() AS array<boolean>)",
    }
    shredded = zip_longest(read, keep, {name: F.expr(sql) for name, sql in items.items()})
    return shredded.unionByName(silver.flatten(rows.filter(F.col(PAYLOAD).isNull())))


def checked_variant(rows: DataFrame) -> DataFrame:
    """``silver.checked_observations`` for bronze with a VARIANT payload."""
    return silver.check(flatten_variant(rows))
