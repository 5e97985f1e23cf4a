"""JSON encoding and decoding of the wire records.

Decoding parses every field as text first and then applies ``try_cast``:
that matches the coercions a lenient JSON object mapper performs
(``"12.5"`` into a double, ``"4"`` and ``3.7`` into an int) and lets us tell
a malformed body from an unknown field from a badly typed value.

Rows are never dropped silently: each decoded row carries ``reason`` (null
when good).  ``split`` turns that into good rows and a dead-letter frame
``(value, reason)``; ``mode="strict"`` fails the job on the first bad
record instead, the reference behaviour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.functions.timeparse import to_epoch_ms

CORRUPT = "_corrupt"
#: The largest epoch milliseconds a timestamp can hold.
MAX_MILLIS = (2**63 - 1) // 1000

# Quarantine reasons.
MALFORMED = "malformed"
UNKNOWN_FIELD = "unknown_field"
BAD_TYPE = "bad_type"
NULL_KEY = "null_key"

_JSON_READ = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "allowNonNumericNumbers": "false",
}


def _raw_schema(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType(
        [T.StructField(n, T.StringType(), True) for n, _ in fields]
        + [T.StructField(CORRUPT, T.StringType(), True)])


def _nested(value: Column, name: str, raw: Column) -> Column:
    """Is the field an object or array?  Only texts that start like one are looked at again."""
    kind = F.schema_of_variant(F.variant_get(F.try_parse_json(value), f"$.{name}", "variant"))
    return F.when(raw.rlike(r"^[{\[]"), kind.rlike("^(OBJECT|ARRAY)")).otherwise(False)


def _typed(raw: Column, kind: str) -> Column:
    if kind == "string":
        return raw
    if kind == "double":
        # numbers only: the text "NaN" / "Infinity" is a bad value, not a number
        d = raw.try_cast("double")
        return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d)
    if kind == "int":
        return raw.try_cast("double").try_cast("int")
    if kind == "bigint":
        return raw.try_cast("double").try_cast("bigint")
    if kind == "timestamp":
        # epoch milliseconds, or ISO text.  Only digit strings are cast to a
        # number: a failing try_cast costs an exception per row.
        # Milliseconds beyond the timestamp's range (microseconds in a long)
        # have no value, so they end as a bad type instead of an overflow.
        ms = F.when(raw.rlike(r"^-?[0-9]{1,18}$"), raw.cast("bigint"))
        return F.when(F.abs(ms) <= F.lit(MAX_MILLIS), F.timestamp_millis(ms)) \
                .when(ms.isNull(), F.try_to_timestamp(raw))
    raise ValueError(kind)


def fence(df: DataFrame) -> DataFrame:
    """Compute every column of ``df`` once per row, then continue.

    Catalyst pushes a filter below a projection by inlining the projected
    expressions into the predicate, without weighing their cost.  For JSON
    decoding that means parsing each record again for every pushed filter
    (and for every filter the consumer adds).  Predicates on a generator's
    output are never pushed below the generator, so a one-element ``inline``
    fixes the decoded columns as ordinary input columns.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def decode(df: DataFrame, fields: list[tuple[str, str]], value_col: str = "value",
           keep: list[str] | None = None, mode: str = "quarantine") -> DataFrame:
    """Decode a text column of JSON objects into typed columns + ``reason``.

    ``keep`` lists input columns carried through (e.g. the Kafka timestamp).
    """
    keep = keep or []
    value = F.col(value_col).cast("string")
    opts = dict(_JSON_READ)
    if mode == "strict":
        opts = {"mode": "FAILFAST", "allowNonNumericNumbers": "false"}
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n, _ in fields])
    else:
        schema = _raw_schema(fields)
    parsed = df.select(
        *[F.col(k) for k in keep],
        value.alias("value"),
        F.from_json(value, schema, opts).alias("_r"),
        F.json_object_keys(value).alias("_keys"),
    )
    known = F.array(*[F.lit(n) for n, _ in fields])
    if mode == "strict":
        malformed = F.col("_keys").isNull()
    else:
        malformed = (F.col("value").isNull() | F.col("_keys").isNull()
                     | F.col("_r").getField(CORRUPT).isNotNull())
    # typed values once per row; the reason then reads the typed columns
    typed = parsed.select(
        *[F.col(k) for k in keep], "value", "_keys", malformed.alias("_malformed"),
        *[_typed(F.col("_r").getField(n), t).alias(n) for n, t in fields],
        *[F.col("_r").getField(n).isNotNull().alias(f"_has_{n}")
          for n, t in fields if t != "string"],
        *[_nested(F.col("value"), n, F.col("_r").getField(n)).alias(f"_nested_{n}")
          for n, t in fields if t == "string"])
    bad_type = F.lit(False)
    for n, t in fields:
        bad_type = bad_type | (F.col(f"_nested_{n}") if t == "string"
                               else F.col(f"_has_{n}") & F.col(n).isNull())
    reason = (F.when(F.col("_malformed"), F.lit(MALFORMED))
              .when(F.size(F.array_except(F.col("_keys"), known)) > 0, F.lit(UNKNOWN_FIELD))
              .when(bad_type, F.lit(BAD_TYPE)))
    out = typed.select(
        *[F.col(k) for k in keep],
        F.col("value"),
        *[F.when(~F.col("_malformed"), F.col(n)).alias(n) for n, _ in fields],
        reason.alias("reason"),
    )
    if mode == "strict":
        out = out.withColumn(
            "reason",
            F.when(F.col("reason").isNotNull(),
                   F.raise_error(F.concat(F.lit("bad record: "), F.col("reason"))))
            .otherwise(F.col("reason")))
    return fence(out)


def split(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without value/reason, dead-letter rows (value, reason))."""
    good = decoded.filter(F.col("reason").isNull()).drop("value", "reason")
    bad = decoded.filter(F.col("reason").isNotNull()).select("value", "reason")
    return good, bad


def decode_events(df: DataFrame, value_col: str = "value", keep: list[str] | None = None,
                  mode: str = "quarantine") -> DataFrame:
    return decode(df, schemas.EVENT_FIELDS, value_col, keep, mode)


def decode_transactions(df: DataFrame, value_col: str = "value", keep: list[str] | None = None,
                        mode: str = "quarantine") -> DataFrame:
    return decode(df, schemas.TRANSACTION_FIELDS, value_col, keep, mode)


def dead_null_keys(decoded: DataFrame) -> DataFrame:
    """Good transactions without an id, category or date get the reason ``null_key``:
    they have no place in the result tables."""
    lost = (F.col("transactionId").isNull() | F.col("productCategory").isNull()
            | F.col("transactionDate").isNull())
    return decoded.withColumn("reason", F.when(F.col("reason").isNull() & lost, F.lit(NULL_KEY))
                              .otherwise(F.col("reason")))


def encode(cols: list[Column]) -> Column:
    """Compact JSON text; absent (null) fields are omitted."""
    return F.to_json(F.struct(*cols))


def encode_events(df: DataFrame) -> Column:
    """Envelope JSON from the typed envelope columns (text ``timestamp`` kept)."""
    return encode([F.col(n) for n, _ in schemas.EVENT_FIELDS if n in df.columns])


def encode_transactions(df: DataFrame, date_as: str = "millis") -> Column:
    """Transaction JSON (camelCase); ``transactionDate`` as epoch ms or ISO text."""
    cols = []
    for n, _ in schemas.TRANSACTION_FIELDS:
        c = F.col(schemas.snake(n))
        if n == "transactionDate":
            c = to_epoch_ms(c.cast("timestamp")) if date_as == "millis" else \
                F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        cols.append(c.alias(n))
    return encode(cols)


def transactions_from_records(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Decoded camelCase transaction records -> table form.

    The record's primitives mean a missing number is 0.  ``keep`` carries
    extra input columns through (e.g. the order of arrival).
    """
    out = [F.col(k) for k in (keep or [])]
    for n, _ in schemas.TRANSACTION_FIELDS:
        c = F.col(n)
        if n in ("productPrice", "totalAmount"):
            c = F.coalesce(c, F.lit(0.0))
        elif n == "productQuantity":
            c = F.coalesce(c, F.lit(0))
        out.append(c.alias(schemas.snake(n)))
    return df.select(*out)
