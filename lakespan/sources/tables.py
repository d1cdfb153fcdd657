"""Definitions of tables: their columns and rules, how they are made, and how one takes another's place.

Parquet tables of the catalog don't keep which columns must not be null, which arrays are sets, and greatest
sizes. These rules stand in a table property.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakespan.sources.errors import TableStateError
from lakespan.sources.names import dotted, quoted, split

RULES = "lakespan.rules"
#: Metadata keys of columns: an array that is a set, the most bytes of a string or binary.
IS_SET, MAX_LENGTH = "is_set", "maxlength"
#: The catalog keeps a column's default under this key of its metadata.
_DEFAULT = "CURRENT_DEFAULT"
#: Names of types that Spark's parser doesn't know, with those it does.
_TYPES = {r"LONG\s+VARCHAR": "VARCHAR", r"(?:LONG\s+)?VARBINARY(?:\s*\(\s*\d+\s*\))?": "BINARY", r"BYTEA": "BINARY", r"DOUBLE\s+PRECISION": "DOUBLE", r"FLOAT8": "DOUBLE", r"INT8": "BIGINT"}


@dataclass
class Definition:
    schema: T.StructType
    rules: dict = field(default_factory=dict)
    sql: str | None = None


def sql_type(spark: SparkSession, t: T.DataType) -> str:
    """A type as SQL says it, with names inside it quoted."""
    if isinstance(t, T.ArrayType | T.MapType | T.StructType):
        return spark._jvm.org.apache.spark.sql.types.DataType.fromJson(t.json()).sql()
    return t.simpleString()


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])


def sizes(schema: T.StructType, strlen: int | None, array_length: int) -> dict:
    """The rules on sizes: a column's own maxlength, else strlen and array_length where they are given."""
    octets = {f.name: f.metadata.get(MAX_LENGTH, strlen) for f in schema if isinstance(f.dataType, T.StringType)}
    octets |= {f.name: f.metadata[MAX_LENGTH] for f in schema if isinstance(f.dataType, T.BinaryType) and MAX_LENGTH in f.metadata}
    return {"octets": {c: n for c, n in octets.items() if n}, "items": {f.name: array_length for f in schema if array_length and isinstance(f.dataType, T.ArrayType)}}


def of_rows(schema: T.StructType, strlen: int | None, array_length: int) -> Definition:
    rules = {"not_null": [f.name for f in schema if not f.nullable], "sets": [f.name for f in schema if f.metadata.get(IS_SET)]}
    return Definition(nullable(schema), rules | sizes(schema, strlen, array_length))


def of_sql(spark: SparkSession, text: str, parts: list[str], strlen: int | None, array_length: int) -> Definition:
    """What a CREATE TABLE statement says, as Spark's own parser reads it.

    Statements after a semicolon and a PARTITION BY clause (physical design of another store) are left out."""
    first = split(text, ";")[0].strip()
    for ours, spark_s in _TYPES.items():
        first = re.sub(rf"\b{ours}\b" if ours[-1] != "?" else rf"\b{ours}", spark_s, first, flags=re.I)
    first = re.sub(r"\)\s*PARTITION\s+BY\b.*$", ")", first, flags=re.I | re.S)
    first = re.sub(r'"((?:[^"]|"")*)"', lambda m: quoted(m[1].replace('""', '"')), first)
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(first)
        kind = plan.getClass().getSimpleName()
        named = plan.name().nameParts() if kind == "CreateTable" else None
    except Exception as e:
        raise TableStateError(f"target_table_sql can't be read: {str(e)[:300]}") from e
    if named is None:
        raise TableStateError("target_table_sql isn't a CREATE TABLE with columns")
    if named.apply(named.size() - 1).lower() != parts[-1].lower():
        raise TableStateError(f"target_table_sql makes {named.apply(named.size() - 1)}, not {parts[-1]}")
    must, octets, fields = [], {}, []
    for i in range(plan.columns().size()):
        c = plan.columns().apply(i)
        kind, size = c.dataType().sql(), None
        if m := re.fullmatch(r"(?:VARCHAR|CHAR)\((\d+)\)", kind):
            kind, size = "STRING", int(m[1])
        if not c.nullable():
            must.append(c.name())
        if size:
            octets[c.name()] = size
        d = c.defaultValue()
        fields.append(T.StructField(c.name(), T._parse_datatype_string(kind), True, {_DEFAULT: d.get().originalSQL()} if d.isDefined() else {}))
    schema = T.StructType(fields)
    rules = sizes(schema, strlen, array_length)
    return Definition(schema, rules | {"not_null": must, "sets": [], "octets": rules["octets"] | octets}, first)


def default_of(f: T.StructField):
    """A column's default, or null."""
    return F.expr(f.metadata[_DEFAULT]).cast(f.dataType) if _DEFAULT in f.metadata else F.lit(None).cast(f.dataType)


class Tables:
    """Tables of one session's catalog, by the parts of their names."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def there(self, parts: list[str]) -> bool:
        return self.spark.catalog.tableExists(dotted(parts))

    def kind(self, parts: list[str]) -> str:
        """MANAGED, EXTERNAL, VIEW or TEMPORARY."""
        return self.spark.catalog.getTable(dotted(parts)).tableType

    def is_view(self, parts: list[str]) -> bool:
        return self.kind(parts) in ("VIEW", "TEMPORARY")

    def properties(self, parts: list[str]) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {dotted(parts)}").collect()}

    def rules(self, parts: list[str]) -> dict:
        if not self.there(parts) or self.is_view(parts):
            return {}
        return json.loads(self.properties(parts).get(RULES, "{}"))

    def set_properties(self, parts: list[str], of: dict[str, str]) -> None:
        if of:
            text = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
            self.spark.sql(f"ALTER TABLE {dotted(parts)} SET TBLPROPERTIES ({', '.join(f'{text(k)} = {text(v)}' for k, v in of.items())})")

    def beside(self, parts: list[str], what: str) -> list[str]:
        """A name of the same schema that nothing has."""
        return [*parts[:-1], f"lakespan_{what}_{uuid.uuid4().hex[:12]}"]

    def make(self, parts: list[str], d: Definition, options: dict) -> None:
        if d.sql:
            self.spark.sql(d.sql)
            if not self.there(parts):
                raise TableStateError(f"target_table_sql didn't make {dotted(parts)}")
        else:
            self.spark.catalog.createTable(dotted(parts), source="parquet", schema=d.schema, **{k: str(v) for k, v in options.items()})
        if any(d.rules.values()):
            self.set_properties(parts, {RULES: json.dumps(d.rules)})

    def make_like(self, parts: list[str], other: list[str]) -> None:
        """An empty table with other's columns, partitioning, defaults and properties."""
        self.spark.sql(f"CREATE TABLE {dotted(parts)} LIKE {dotted(other)}")
        self.set_properties(parts, {k: v for k, v in self.properties(other).items() if not k.startswith(("option.", "transient"))})

    def rename(self, parts: list[str], to: list[str]) -> None:
        self.spark.sql(f"ALTER TABLE {dotted(parts)} RENAME TO {dotted(to)}")

    def drop(self, parts: list[str]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {dotted(parts)}")

    def swap(self, new: list[str], parts: list[str]) -> None:
        """Put table new in the place of parts; if that fails, the old table is back under its name."""
        old = None
        if self.there(parts):
            old = self.beside(parts, "old")
            self.rename(parts, old)
        try:
            self.rename(new, parts)
        except Exception:
            if old:
                self.rename(old, parts)
            raise
        if old:
            self.drop(old)

    def insert(self, rows: DataFrame, parts: list[str]) -> None:
        rows.write.mode("append").insertInto(dotted(parts))
