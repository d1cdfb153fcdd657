"""Options of reads and writes, checked all at once.

strlen and array_length bound the strings and arrays of a table that a write makes, where they are given.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from lakespan.sources.errors import OptionError
from lakespan.sources.names import split

#: Names that were replaced, with what replaced them.
REPLACED = {"target_table_ddl": "target_table_sql", "numpartitions": "num_partitions", "hdfs_url": "staging_fs_url", "web_hdfs_url": "staging_fs_url"}
#: Options of a remote server or of credentials, which have nothing to act on here.
IGNORED = {"host", "port", "db", "user", "password", "backup_server_node", "tls_mode", "file_permissions", "time_operations"}


@dataclass
class Options:
    table: str | None = None
    query: str | None = None
    dbschema: str | None = None
    num_partitions: int | None = None
    json: bool = False
    strlen: int | None = None
    array_length: int = 0
    target_table_sql: str | None = None
    copy_column_list: list[str] = field(default_factory=list)
    merge_key: list[str] = field(default_factory=list)
    failed_rows_percent_tolerance: float = 0.0
    create_external_table: str | None = None
    truncate: bool = False
    save_job_status_table: bool = False
    prevent_cleanup: bool = False
    staging_fs_url: str | None = None
    max_file_size_export_mb: int = 4096
    max_row_group_size_export_mb: int = 16


def _number(kind, low, high):
    def check(text):
        x = kind(text)
        if not low <= x <= high:
            raise ValueError(f"must be from {low} to {high}")
        return x

    return check


def _flag(text):
    if str(text).lower() not in ("true", "false"):
        raise ValueError("must be true or false")
    return str(text).lower() == "true"


def _names(text):
    if len(split(text, ";")) > 1:
        raise ValueError("holds a semicolon")
    out = [x.strip() for x in split(text, ",") if x.strip()]
    if any(x.startswith("(") for x in out):
        raise ValueError("must not stand in parentheses")
    return out


def _external(text):
    if text not in ("new-data", "true", "existing-data"):
        raise ValueError("must be new-data or existing-data")
    return "new-data" if text == "true" else text


_CHECKS = {
    "table": str, "dbschema": str, "query": lambda q: q.strip().rstrip(";"), "num_partitions": _number(int, 1, 10**9), "json": _flag,
    "strlen": _number(int, 1, 32_000_000), "array_length": _number(int, 0, 10**9), "target_table_sql": str, "copy_column_list": _names, "merge_key": _names,
    "failed_rows_percent_tolerance": _number(float, 0, 1), "create_external_table": _external, "truncate": _flag, "save_job_status_table": _flag, "prevent_cleanup": _flag,
    "staging_fs_url": str, "max_file_size_export_mb": _number(int, 1, 10**9), "max_row_group_size_export_mb": _number(int, 1, 10**9),
}


def parse(given: dict, writing: bool = False) -> Options:
    """Options of a read or write; every fault is named in one error."""
    out, faults = Options(), []
    for key, value in given.items():
        name = key.lower()
        if name in REPLACED:
            faults.append(f"{key}: use {REPLACED[name]}")
        elif name in _CHECKS:
            try:
                setattr(out, name, _CHECKS[name](value))
            except (ValueError, TypeError) as e:
                faults.append(f"{key}: {e}")
        elif name not in IGNORED:
            faults.append(f"{key}: no such option")
    if writing and not out.table:
        faults.append("table: a write needs it")
    if not writing and not (out.table or out.query):
        faults.append("table, query: a read needs one of them")
    if writing and out.merge_key and out.create_external_table:
        faults.append("merge_key: can't go with create_external_table")
    if writing and out.create_external_table and not out.staging_fs_url:
        faults.append("staging_fs_url: an external table needs it")
    if faults:
        raise OptionError("options are wrong", faults)
    return out
