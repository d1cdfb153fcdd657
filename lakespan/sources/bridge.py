"""Reading and writing tables of Spark's catalog with the bridge's options.

A write never touches the rows that are there before the new ones are known to be good. Rows that a rule may reject,
or that a merge reads several times, are written to a table of their own once and counted on the way; what is
rejected is kept in a table even if the load fails. Overwrites, truncations and merges fill a new table and put it
in the old one's place by renaming; an append adds its files in one commit. What a failed write made is dropped.
A single writer for each table is assumed.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakespan.operators import rejects
from lakespan.operators.merge import merge
from lakespan.sources import external, tables
from lakespan.sources.errors import ExternalTableError, SchemaError, TableStateError, ToleranceError
from lakespan.sources.names import dotted, quoted, shown, table_parts, unquoted
from lakespan.sources.options import Options, parse
from lakespan.sources.tables import IS_SET, MAX_LENGTH, Definition, Tables, sql_type

__all__ = ["IS_SET", "MAX_LENGTH", "STATUS", "Bridge", "check_schema", "quoted", "staged"]
STATUS = "lakespan_job_status"
_NATIVE = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
_NOTHING = {"copied": 0, "rejected": 0, "failed": 0.0, "rejects": None}


def parts_of(o: Options) -> list[str]:
    return table_parts(o.table, o.dbschema)


class Bridge:
    def __init__(self, spark: SparkSession):
        self.spark, self.tables_ = spark, Tables(spark)

    # Reading

    def read(self, **given) -> DataFrame:
        """A table or a query as a DataFrame; a query goes before a table."""
        o = parse(given)
        if o.query:
            df = self._query(o)
        else:
            parts = parts_of(o)
            df = self.spark.table(dotted(parts))
            for c in self.tables_.rules(parts).get("sets", []):
                df = df.withMetadata(c, {IS_SET: True})
        if o.json:
            df = self._by_json(df, o)
        if not o.num_partitions:
            return df
        # Fewer partitions than the scan's need no shuffle.
        fewer = not o.query and o.num_partitions <= df.rdd.getNumPartitions()
        return df.coalesce(o.num_partitions) if fewer else df.repartition(o.num_partitions)

    def _query(self, o: Options) -> DataFrame:
        """The query; names without a schema are those of dbschema if it is given."""
        if not o.dbschema:
            return self.spark.sql(o.query)
        was = self.spark.catalog.currentDatabase()
        self.spark.catalog.setCurrentDatabase(o.dbschema)
        try:
            return self.spark.sql(o.query)
        finally:
            self.spark.catalog.setCurrentDatabase(was)

    def _by_json(self, df: DataFrame, o: Options) -> DataFrame:
        """df by way of JSON files, under staging_fs_url or else in the warehouse."""
        bad = [f.name for f in df.schema if _holds(f.dataType, T.BinaryType)]
        if bad:
            raise SchemaError("binary columns can't be read by way of JSON", bad)
        folder = f"{(o.staging_fs_url or self.spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/lakespan_json_{uuid.uuid4().hex[:12]}"
        times = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "dateFormat": "yyyy-MM-dd"}
        df.write.options(ignoreNullFields=False, **times).json(folder)
        return self.spark.read.options(**times).schema(df.schema).json(folder)

    # The catalog

    def exists(self, **given) -> bool:
        return self.tables_.there(parts_of(parse(given)))

    def drop(self, **given) -> None:
        self.tables_.drop(parts_of(parse(given)))

    def rename(self, to: str, **given) -> None:
        """Give a table another name in its schema."""
        parts = parts_of(parse(given))
        self.tables_.rename(parts, [*parts[:-1], *table_parts(to)[-1:]])

    def tables(self, dbschema: str | None = None) -> list[str]:
        return [shown(t.name) for t in self.spark.catalog.listTables(dbschema) if not t.isTemporary]

    def rules(self, **given) -> dict:
        """What rows a table takes: see rejects.reason; sets names the columns that are sets."""
        return self.tables_.rules(parts_of(parse(given)))

    def job_status(self) -> DataFrame:
        """One row for each write that was told to save its status: where it stands last."""
        last = F.max_by(F.struct("failed_rows_percent", "success", "phase", "at"), F.struct(F.col("phase") == "ended", "at"))
        return self.spark.table(STATUS).groupBy("job", "target").agg(last.alias("s")).select("job", "target", "s.*")

    # Writing

    def write(self, df: DataFrame, mode: str = "errorifexists", **given) -> dict:
        """Write df; how many rows were copied and rejected, the failed fraction, and the table of what was rejected."""
        o, mode = parse(given, writing=True), mode.lower()
        parts = parts_of(o)
        if mode not in ("append", "overwrite", "ignore", "error", "errorifexists"):
            raise TableStateError(f"no such mode: {mode}")
        if o.create_external_table:
            return self._external(df, o, parts)
        check_schema(df.schema)
        there = self.tables_.there(parts)
        if there and self.tables_.is_view(parts):
            raise TableStateError(f"{o.table} is a view")
        if there and not o.merge_key and mode == "ignore":
            return dict(_NOTHING)
        if there and not o.merge_key and mode.startswith("error"):
            raise TableStateError(f"{o.table} exists")
        job = uuid.uuid4().hex[:12]
        self._status(o, job, parts, "started", None, False)
        done = dict(_NOTHING, failed=1.0)
        try:
            self._load(df, o, parts, mode, there, done)
        except Exception:
            self._status(o, job, parts, "ended", done["failed"], False)
            raise
        self._status(o, job, parts, "ended", done["failed"], True)
        return done

    def _load(self, df: DataFrame, o: Options, parts: list[str], mode: str, there: bool, done: dict) -> None:
        made: list[list[str]] = []  # what this write made and nobody else needs
        merging = bool(o.merge_key) and there
        new = not there or (mode == "overwrite" and not o.truncate and not merging)
        if not new:
            d = Definition(self.spark.table(dotted(parts)).schema, self.tables_.rules(parts))
        elif o.target_table_sql:
            d = tables.of_sql(self.spark, o.target_table_sql, parts, o.strlen, o.array_length)
        else:
            d = tables.of_rows(df.schema, o.strlen, o.array_length)
        rows = staged(df, d.schema, o.copy_column_list)
        rows = rows if merging else filled(rows, d.schema)
        have = set(rows.columns)
        rules = {k: [c for c in v if c in have] if isinstance(v, list) else {c: n for c, n in v.items() if c in have} for k, v in d.rules.items()}
        if rules.get("sets"):
            rows = rows.withColumns({c: F.array_distinct(quoted(c)) for c in rules["sets"]})
        may_reject = any(v for k, v in rules.items() if k != "sets")
        by_sql_anew = there and new and d.sql
        try:
            if may_reject or merging or by_sql_anew:
                rows = self._staged_rows(rows, rules, parts, made)
                self._judge(rows, parts, o, done)
                rows = rows.where(F.col(rejects.REASON).isNull()).drop(rejects.REASON)
                counted = None
            else:
                counted = Observation()
                rows = rows.observe(counted, F.count(F.lit(1)).alias("n"))
            if merging:
                rows = merge(self.spark.table(dotted(parts)), rows, [unquoted(k) for k in o.merge_key])
            if not new and mode == "append" and not merging:
                self.tables_.insert(rows, parts)
                self._count(counted, o, done)
            elif not new and self.tables_.kind(parts) == "EXTERNAL":  # its place is the user's: fill a copy, then the table
                goal = self._filled(rows, parts, parts, None, {}, made)
                self._count(counted, o, done)
                self.spark.table(dotted(goal)).write.mode("overwrite").insertInto(dotted(parts))
            elif d.sql:
                self._by_sql(rows, d, parts, there, counted, o, done)
            else:
                goal = self._filled(rows, parts, None if new else parts, d, external.file_sizes(df, o), made)
                self._count(counted, o, done)
                self.tables_.swap(goal, parts)
                made.remove(goal)
        finally:
            for name in [] if o.prevent_cleanup else made:
                self.tables_.drop(name)

    def _staged_rows(self, rows: DataFrame, rules: dict, parts: list[str], made: list) -> DataFrame:
        """rows with the reason of their rejection, written once."""
        at = self.tables_.beside(parts, "staged")
        made.append(at)
        rows.withColumn(rejects.REASON, rejects.reason(rules)).write.saveAsTable(dotted(at))
        return self.spark.table(dotted(at))

    def _judge(self, rows: DataFrame, parts: list[str], o: Options, done: dict) -> None:
        """Count rows that are taken and rejected, keep the latter in a table, and hold them against the tolerance."""
        counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count(rejects.REASON).alias("bad")).first()
        done["copied"], done["rejected"] = counts["n"] - counts["bad"], counts["bad"]
        if done["rejected"]:
            at = self.tables_.beside(parts, "rejects")
            rows.where(F.col(rejects.REASON).isNotNull()).write.saveAsTable(dotted(at))
            done["rejects"] = ".".join(at)
        self._tolerate(o, done)

    def _count(self, seen: Observation | None, o: Options, done: dict) -> None:
        if seen:
            done["copied"] = seen.get["n"]
            self._tolerate(o, done)

    def _tolerate(self, o: Options, done: dict) -> None:
        done["failed"] = rejects.failed(done["copied"], done["rejected"])
        if done["failed"] > o.failed_rows_percent_tolerance:
            raise ToleranceError(f"{done['rejected']} rows were rejected and {done['copied']} copied: {done['failed']:.4g} is above the tolerance of {o.failed_rows_percent_tolerance:.4g}", rejects=done["rejects"])

    def _filled(self, rows: DataFrame, parts: list[str], like: list[str] | None, d: Definition | None, options: dict, made: list) -> list[str]:
        """A new table with rows, beside parts."""
        goal = self.tables_.beside(parts, "new")
        made.append(goal)
        if like:
            self.tables_.make_like(goal, like)
        else:
            self.tables_.make(goal, d, options)
        self.tables_.insert(rows, goal)
        return goal

    def _by_sql(self, rows: DataFrame, d: Definition, parts: list[str], there: bool, counted, o: Options, done: dict) -> None:
        """The user's statement makes the table under its own name, so an old one steps aside until the new one is full."""
        old = self.tables_.beside(parts, "old") if there else None
        if old:
            self.tables_.rename(parts, old)
        try:
            self.tables_.make(parts, d, {})
            self.tables_.insert(rows, parts)
            self._count(counted, o, done)
        except Exception:
            self.tables_.drop(parts)
            if old:
                self.tables_.rename(old, parts)
            raise
        if old:
            self.tables_.drop(old)

    def _external(self, df: DataFrame, o: Options, parts: list[str]) -> dict:
        if self.tables_.there(parts):
            raise ExternalTableError(f"{o.table} exists")
        if o.create_external_table == "existing-data":
            if not df.isEmpty():
                raise ExternalTableError("existing data are registered with an empty DataFrame")
            external.register(self.spark, o.staging_fs_url, parts, df.schema, o.strlen, o.array_length)
            return dict(_NOTHING)
        check_schema(df.schema, external=True)
        return dict(_NOTHING, copied=external.write_new(df, o, parts))

    def _status(self, o: Options, job: str, parts: list[str], phase: str, failed: float | None, success: bool) -> None:
        if o.save_job_status_table:
            row = self.spark.range(1).select(F.lit(job).alias("job"), F.lit(".".join(parts)).alias("target"), F.lit(failed).cast("double").alias("failed_rows_percent"), F.lit(success).alias("success"), F.lit(phase).alias("phase"), F.current_timestamp().alias("at"))
            row.coalesce(1).write.mode("append").saveAsTable(STATUS)


def _holds(t: T.DataType, kind: type) -> bool:
    if isinstance(t, T.ArrayType):
        return _holds(t.elementType, kind)
    if isinstance(t, T.MapType):
        return _holds(t.keyType, kind) or _holds(t.valueType, kind)
    if isinstance(t, T.StructType):
        return any(_holds(f.dataType, kind) for f in t)
    return isinstance(t, kind)


def check_schema(schema: T.StructType, external: bool = False) -> None:
    """Fail on every fault: blank or repeated names, no plain column, maps in a table of our own or with nested keys or values."""
    names = [f.name for f in schema]
    faults = [f"blank column name at {i + 1}" for i, n in enumerate(names) if not n.strip()]
    faults += [f"{n} is there twice" for n in sorted({n for n in names if names.count(n) > 1})]
    if not any(isinstance(f.dataType, _NATIVE) for f in schema) and not any(isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, _NATIVE) for f in schema):
        faults.append("no column of a plain type")
    faults += [f"{f.name} is a map" for f in schema if isinstance(f.dataType, T.MapType) and not external]
    faults += [f"{f.name} is a map of nested values" for f in schema if isinstance(f.dataType, T.MapType) and external and not (isinstance(f.dataType.keyType, _NATIVE) and isinstance(f.dataType.valueType, _NATIVE))]
    if faults:
        raise SchemaError("the schema can't be stored", faults)


def _listed(text: str) -> tuple[str, str | None, str | None]:
    """(name, FILLER or AS, the rest) of an item of a column list."""
    m = re.fullmatch(r"""\s*("(?:[^"]|"")*"|`(?:[^`]|``)*`|[^\s"`]+)(?:\s+(FILLER|AS)\s+(.+?))?\s*""", text, re.I | re.S)
    if not m:
        raise SchemaError(f"{text!r} isn't an item of a column list")
    return unquoted(m[1]), m[2] and m[2].upper(), m[3]


def staged(df: DataFrame, target: T.StructType, columns: list[str] | None = None) -> DataFrame:
    """df's columns under the names and types of the target columns they go to.

    Without a list they go by name if the target knows every name, else by position. A list names them by
    position; `c FILLER type` names a column that is only used by others, `c AS expression` computes one.
    """
    if columns:
        items = [_listed(c) for c in columns]
    else:
        if len(df.columns) > len(target):
            raise SchemaError(f"the table has {len(target)} columns, the rows {len(df.columns)}")
        by_name = {c.lower(): c for c in target.names}
        known = all(c.lower() in by_name for c in df.columns)
        items = [(by_name[c.lower()], None, None) for c in df.columns] if known else [(c, None, None) for c in target.names[: len(df.columns)]]
    plain = [(name, rest) for name, word, rest in items if word != "AS"]
    if len(plain) != len(df.columns):
        raise SchemaError(f"{len(plain)} columns are listed, the rows have {len(df.columns)}")
    # Texts of expressions: a wide table has them parsed in one call.
    named = df.selectExpr(*[as_type(quoted(old.name), kind) + f" AS {quoted(new)}" for (new, kind), old in zip(plain, df.schema, strict=True)])
    types = {f.name.lower(): f for f in target}
    unknown = [name for name, word, _ in items if word != "FILLER" and name.lower() not in types]
    if unknown:
        raise SchemaError("columns aren't in the table", unknown)
    have = {f.name: f.dataType for f in named.schema}
    kept = [(types[name.lower()], f"({rest})" if word else quoted(name), None if word else have[name]) for name, word, rest in items if word != "FILLER"]
    return named.selectExpr(*[f"{as_type(c, sql_type(named.sparkSession, f.dataType) if old != f.dataType else None)} AS {quoted(f.name)}" for f, c, old in kept])


def as_type(c: str, kind: str | None) -> str:
    return f"CAST({c} AS {kind})" if kind else c


def filled(df: DataFrame, target: T.StructType) -> DataFrame:
    """df with all columns of the target, in its order; those that df lacks have their default, or null."""
    have = set(df.columns)
    if all(f.name in have for f in target):
        return df.select([quoted(f.name) for f in target])
    return df.select([(F.col(quoted(f.name)) if f.name in have else tables.default_of(f)).alias(f.name) for f in target])
