"""Records read field by field against a declared schema; what does not fit is rescued by name.

Both readers take a column of raw text and return the declared columns in their declared types
plus ``_rescued_data``: a JSON object that holds, by field name, every field the schema does not
name and every value that is not of its declared type; null where all fits.  Nothing vanishes:

* a record that is no JSON object at all (cut off, an array, a repeated field name) is rescued
  whole under ``_record``;
* a CSV line with too many fields has the surplus under ``_c<position>``; one with too few keeps
  what is there, and ``_fields`` tells how many there were;
* a number with a fraction in a column of whole numbers is rescued, not rounded;
* an object or array in a STRING column stays there as its JSON text.

Null text gives a row of nulls.  All of it is narrow (no shuffle), so it works on streams as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

RESCUED = "_rescued_data"
RECORD, FIELDS = "_record", "_fields"
EXACT = "decimal(38,9)"


def _json_or_null(rescued: Column) -> Column:
    return F.when(F.size(rescued) > 0, F.to_json(rescued))


def json_fields(records: DataFrame, body: str, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, the declared fields of the JSON object in ``body``, and what was rescued."""
    held = records.select(*keep, F.col(body).alias("_body"),
                          F.try_variant_get(F.try_parse_json(body), "$", "map<string,variant>").alias("_fields"))
    values, misfits = [], []
    for field in schema.fields:
        raw = F.try_element_at("_fields", F.lit(field.name))
        value = F.try_variant_get(raw, "$", field.dataType.simpleString())
        fits = value.isNotNull()
        if isinstance(field.dataType, IntegralType):
            fits = F.coalesce(F.try_variant_get(raw, "$", EXACT) == value.cast(EXACT), F.lit(False))
        values.append(F.when(fits, value).alias(field.name))
        misfits.append(F.when(raw.isNotNull() & ~F.is_variant_null(raw) & ~fits, F.lit(field.name)))
    declared = F.array(*[F.lit(f.name) for f in schema.fields])
    unfit = F.array_compact(F.array(*misfits))
    left = F.map_filter("_fields", lambda name, _: ~F.array_contains(declared, name) | F.array_contains(unfit, name))
    whole = F.to_json(F.create_map(F.lit(RECORD), F.col("_body")))
    rescued = F.when(F.col("_fields").isNotNull(), _json_or_null(left)).when(F.col("_body").isNotNull(), whole)
    return held.select(*keep, *values, rescued.alias(RESCUED))


def csv_fields(lines: DataFrame, body: str, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, the declared fields of the CSV line in ``body`` by position, and what was rescued."""
    width = len(schema.fields)
    positions = ", ".join(f"p{i} STRING" for i in range(width))
    # one token before each comma of the line and one more: in quotes, or without a comma
    tokens = F.regexp_extract_all(F.concat(F.col(body), F.lit(",")), F.lit(r'("(?:[^"]++|"")*+"|[^,]*+),'), F.lit(1))
    held = lines.select(*keep, F.from_csv(F.col(body), positions, {"mode": "PERMISSIVE"}).alias("_p"), tokens.alias("_tokens"))
    values, entries = [], []
    for i, field in enumerate(schema.fields):
        text = F.col(f"_p.p{i}")
        value = text.try_cast(field.dataType)
        values.append(value.alias(field.name))
        entries.append((F.lit(field.name), F.when(value.isNull(), text)))
    found = F.size("_tokens")
    entries.append((F.lit(FIELDS), F.when(found < width, found.cast("string"))))
    known = F.filter(F.array(*[F.struct(n.alias("name"), v.alias("text")) for n, v in entries]), lambda e: e["text"].isNotNull())
    surplus = F.transform(F.slice("_tokens", width + 1, F.greatest(found - width, F.lit(0))),
                          lambda token, i: F.struct(F.concat(F.lit("_c"), (i + width).cast("string")).alias("name"), token.alias("text")))
    rescued = F.map_from_entries(F.concat(known, surplus))
    return held.select(*keep, *values, F.when(F.col("_tokens").isNotNull(), _json_or_null(rescued)).alias(RESCUED))
