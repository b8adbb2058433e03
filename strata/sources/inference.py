"""Column types for fields that an evolving feed brings, learnt from the stored lines.

At each start of an ingest the Bronze lines that came since the last one are described by Spark's variant schema.
Fields the declaration lacks become columns of the type their values have; when later values need a wider type, the
field goes on in a further column of that type, so no stored file is rewritten or read under another type than it was written
with. A registry table keeps the types in the order they were needed, and reading puts the columns of a field together.
"""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import conform, table, table_path
from strata.sources.consumed import note, unread
from strata.sources.feeds import Feed, raw_field
from strata.sources.tables import append, read_if_exists, read_table

REGISTRY = table("gold", "inferred_fields")
_LINES = "_raw_json STRING, _corrupt BOOLEAN, ingestion_date DATE"
# A type can hold what those before it hold; a BOOLEAN is wider than nothing and narrower than text only.
_NUMBERS = ("BIGINT", "DOUBLE")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _fields(described: str) -> dict[str, str]:
    """The top-level fields of a type as `schema_of_variant_agg` writes it: OBJECT<a: BIGINT, b: ARRAY<...>>."""
    if not described.startswith("OBJECT<"):
        return {}
    fields, depth, part, quoted = {}, 0, "", False
    for character in described[len("OBJECT<"):-1] + ",":
        quoted ^= character == "`"
        depth += 0 if quoted else (character in "<(") - (character in ">)")
        if character == "," and depth == 0 and not quoted:
            name, _, kind = part.partition(": ")
            fields[name.strip().strip("`")] = kind
            part = ""
        else:
            part += character
    return {name: kind for name, kind in fields.items() if kind}


def column_type(kind: str) -> str | None:
    """The column type for values of a variant type: numbers without loss, everything nested or mixed as its text."""
    if kind == "VOID":
        return None
    decimal = re.fullmatch(r"DECIMAL\((\d+),(\d+)\)", kind)
    if decimal:
        return "DOUBLE" if int(decimal[1]) <= 15 and int(decimal[2]) else "STRING"
    return kind if kind in ("BOOLEAN", "DOUBLE", "BIGINT") else "STRING"


def wider(one: str, other: str) -> str:
    """The narrowest type that holds the values of both."""
    if one == other:
        return one
    if one in _NUMBERS and other in _NUMBERS:
        return "DOUBLE"
    return "STRING"


def observed_types(lines: DataFrame, raw_col: str = "_raw_json") -> dict[str, str]:
    """Types of the top-level fields of JSON lines; fields that were never more than null are left out."""
    described = lines.agg(F.schema_of_variant_agg(F.try_parse_json(raw_col))).first()[0]
    return {name: kind for name, found in _fields(described or "").items() if (kind := column_type(found))}


def known_types(spark: SparkSession, root: str, feed: Feed) -> dict[str, list[str]]:
    """The types each inferred field has had, the widest last."""
    stored = read_if_exists(spark, table_path(root, REGISTRY.layer, REGISTRY.name), schema=REGISTRY.schema)
    if stored is None:
        return {}
    known: dict[str, list[str]] = {}
    own = stored.filter(F.col("feed") == feed.bronze_table).orderBy("noted_ts", "step")
    for row in own.collect():  # a row for each type a field has had
        known.setdefault(row.field, []).append(row.type)
    return known


def stored_columns(known: dict[str, list[str]]) -> dict[str, str]:
    """Names and types of the columns that hold inferred fields: the field's own name, then one for each wider type."""
    return {
        (name if step == 0 else f"{name}__{kind.lower()}"): kind
        for name, kinds in known.items() for step, kind in enumerate(kinds)
    }


def learn_fields(spark: SparkSession, root: str, feed: Feed) -> dict[str, list[str]]:
    """Read the lines that came since the last call, and note fields and wider types that they need.

    Only names that are plain identifiers and unlike any declared column, in any case, become columns; others stay in
    `_rescued`, as all values stay in `_raw_json`.
    """
    known = known_types(spark, root, feed)
    spec = table("bronze", feed.bronze_table)
    if read_if_exists(spark, table_path(root, spec.layer, spec.name), schema=spec.schema) is None:
        return known
    consumer = f"fields:{feed.bronze_table}"
    rows, files = unread(spark, root, replace(spec, ddl=_LINES), consumer)
    if not files:
        return known
    declared = {name.lower() for name in spec.schema.names} | {"_rescued", "_corrupt"}
    taken = declared | {name.lower() for name in stored_columns(known)}
    news = []
    for name, kind in sorted(observed_types(rows.filter("NOT _corrupt")).items()):
        if not _NAME.fullmatch(name) or name.lower() in declared:
            continue
        kinds = known.get(name, [])
        if not kinds and name.lower() in taken:
            continue
        needed = wider(kinds[-1], kind) if kinds else kind
        if not kinds or needed != kinds[-1]:
            news.append((feed.bronze_table, name, needed, len(kinds)))
            known.setdefault(name, []).append(needed)
            taken.add(name.lower())
    at = spark.sql("SELECT cast(current_timestamp() AS string)").first()[0]
    if news:
        noted = spark.createDataFrame(news, "feed string, field string, type string, step int")
        stamp = F.lit(at).cast("timestamp")
        entries = conform(noted.withColumns({"noted_ts": stamp, "noted_date": F.to_date(stamp)}), REGISTRY)
        append(entries.coalesce(1), table_path(root, REGISTRY.layer, REGISTRY.name), REGISTRY.partition_by)
    note(spark, root, consumer, files, at)
    return known


def into_columns(records: DataFrame, known: dict[str, list[str]]) -> DataFrame:
    """Records parsed under the widest types, with each field in the column of that type."""
    return records.withColumnsRenamed({
        name: f"{name}__{kinds[-1].lower()}" for name, kinds in known.items() if len(kinds) > 1
    })


def read_inferred(spark: SparkSession, root: str, feed: Feed) -> DataFrame:
    """The Bronze rows of an evolving feed with every inferred field in one column of its widest type.

    Rows from before a field had its type, or whose value did not fit it then, have the value from the line itself.
    """
    known = known_types(spark, root, feed)
    spec = table("bronze", feed.bronze_table)
    columns = ", ".join(f"{name} {kind}" for name, kind in stored_columns(known).items())
    schema = ", ".join(part for part in (spec.ddl, columns, "_rescued STRING, _corrupt BOOLEAN") if part)
    rows = read_table(spark, table_path(root, spec.layer, spec.name), schema=schema)
    merged = {}
    for name, kinds in known.items():
        held = [name, *(f"{name}__{kind.lower()}" for kind in kinds[1:])]
        values = [F.col(c).cast(kinds[-1]) for c in reversed(held)]
        merged[name] = F.coalesce(*values, raw_field(name, kinds[-1], "_raw_json"))
    return rows.select(*spec.schema.names, *(value.alias(name) for name, value in merged.items()), "_rescued", "_corrupt")
