"""JSON messages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Full microseconds; the default formats cut to milliseconds. Parsing takes any ISO form by default.
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def message(*columns: str | Column) -> Column:
    """One compact JSON object; all columns by default, missing fields left out."""
    return F.to_json(F.struct(*(columns or ("*",))), TIME_FORMATS)


def parse_messages(
    records: DataFrame, schema: StructType, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Typed rows from message records, after the columns of the records in ``keep``.

    Parsing is permissive: a field of the wrong type is NULL, an unreadable message is a row of NULLs.
    Expanded by a generator, so that later filters do not parse each message a second time; give
    only the fields that are needed.
    """
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return records.select(*keep, F.inline(F.array(parsed)))


_RAW, _JSON = "__raw", "__json"
# Told without a parser, whose errors cost more than its results: an object without an end, a word that is none of JSON's.
_NEVER_JSON = r"^[ \t\r\n]*(\{[^}]*$|[A-Za-eg-mo-su-z])"


def judge_messages(
    records: DataFrame, schema: StructType, value: str = "value", keep: Sequence[str] = (), required: Sequence[str] = ()
) -> DataFrame:
    """Like ``parse_messages``, with the ``reason`` why a message is not whole, and the ``wrong`` fields.

    Reasons are ``missing`` (no value), ``empty``, ``no json``, ``no object``, ``wrong type`` (some fields hold what their
    type cannot; the others are read) and ``incomplete`` (a ``required`` field is absent or null); NULL means whole. A
    message is parsed once; only what that parse marks as corrupt is looked at further.
    """
    text = F.col(value).cast("string")
    told = StructType([*schema.fields, StructField(_RAW, StringType())])
    parsed = F.from_json(text, told, {"columnNameOfCorruptRecord": _RAW, "mode": "PERMISSIVE"})
    rows = records.select(*keep, text.alias("raw"), F.inline(F.array(parsed)))
    corrupt = F.col(_RAW).isNotNull()
    # By a generator as well: otherwise the filter and each column on the reason would look at a corrupt message once more.
    whole = F.when(corrupt & ~F.col("raw").rlike(_NEVER_JSON), F.try_parse_json("raw"))
    rows = rows.select("*", F.inline(F.array(F.struct(whole.alias(_JSON)))))
    missing = F.array(F.lit(None).cast("string"))
    held = F.array(
        *(F.when(F.col(f.name).isNull() & F.try_variant_get(_JSON, f"$['{f.name}']", "string").isNotNull(), F.lit(f.name)) for f in schema.fields)
    )
    held = F.array_except(held, missing)
    gaps = F.array(*(F.when(F.col(name).isNull(), F.lit(name)) for name in required))
    gaps = F.array_except(F.concat(gaps, missing), missing)
    incomplete = reduce(or_, (F.col(name).isNull() for name in required), F.lit(False))
    reason = (
        F.when(F.col("raw").isNull(), "missing")
        .when(F.trim("raw") == "", "empty")
        .when(corrupt & F.col(_JSON).isNull(), "no json")
        .when(~F.ltrim("raw").startswith("{"), "no object")
        .when(corrupt, "wrong type")
        .when(incomplete, "incomplete")
    )
    rows = rows.withColumn("reason", reason)
    wrong = F.when(F.col("reason") == "wrong type", held).when(F.col("reason") == "incomplete", gaps)
    return rows.withColumn("wrong", wrong).select(*keep, *schema.fieldNames(), "raw", "reason", "wrong")
