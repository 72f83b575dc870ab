"""Stored type 2 history that is appended to, never rewritten.

A history is a versioned folder (see ``incremental``) of runs. A snapshot run compares the open versions with
the source and writes only what changed: the versions it closes, complete with their end, in ``state=closed``, and those
it opens in ``state=open``. A version is open if no closing names its key and start; closings that a compaction has
already taken out of the open set are marked and not looked at again. So a run's writing depends on the changed
keys alone, and reading the open set never touches closed history that is settled.

``compact`` writes the open set anew, without what was closed since; it is a step of its own and changes no row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.operators.incremental import (VersionConflict, _delete, _names, as_stored, list_versions, listed, publish,
                                              read_folders, require_unique, version_schema)
from ledgerstar.operators.scd2 import VERSION_FROM, VERSION_TO, scd2_changes

_LIST = "folder string, state string, settled boolean"


def _layout(spark: SparkSession, base: str) -> tuple[int, list, T.StructType | None]:
    vs = list_versions(spark, base)
    return (vs[-1], listed(spark, base, vs[-1]), version_schema(spark, base, vs[-1])) if vs else (0, [], None)


def _folders(rows: list, state: str, settled: bool | None = None) -> list[str]:
    return [r["folder"] for r in rows if r["state"] == state and settled in (None, r["settled"])]


def _same_version(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    cond = a[VERSION_FROM] == b["__from"]
    for k in keys:
        cond = cond & a[k].eqNullSafe(b["__" + k])
    return cond


def _open(spark: SparkSession, base: str, rows: list, schema: T.StructType, keys: list[str]) -> DataFrame:
    opened = read_folders(spark, base, _folders(rows, "open"), schema)
    late = _folders(rows, "closed", False)
    if not late:
        return opened
    ended = read_folders(spark, base, late, schema).select(*[F.col(k).alias("__" + k) for k in keys], F.col(VERSION_FROM).alias("__from"))
    return opened.join(ended, _same_version(opened, ended, keys), "left_anti")


def open_versions(spark: SparkSession, base: str, key: str | list[str]) -> DataFrame | None:
    """The open versions; None before the first run."""
    _, rows, schema = _layout(spark, base)
    return _open(spark, base, rows, schema, _keys(key)) if schema else None


def read_history(spark: SparkSession, base: str, key: str | list[str]) -> DataFrame | None:
    """All versions: the source's columns, ``version_from`` and ``version_to`` (NULL while open)."""
    _, rows, schema = _layout(spark, base)
    if schema is None:
        return None
    return read_folders(spark, base, _folders(rows, "closed"), schema).unionByName(_open(spark, base, rows, schema, _keys(key)))


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _write(spark: SparkSession, df: DataFrame, base: str) -> list[tuple[str, str, bool]]:
    """Write rows with a ``state`` column as a run; its folders as list rows."""
    run = f"run={uuid.uuid4().hex[:12]}"
    df.write.partitionBy("state").parquet(f"{base}/data/{run}")
    return [(f"{run}/{n}", n[6:], False) for n in _names(spark, f"{base}/data/{run}") if n.startswith("state=")]


def _publish(spark: SparkSession, base: str, rows: list[tuple], schema: T.StructType, after: int) -> int:
    """Publish or, if another run came first, take the own files back and fail."""
    try:
        return publish(spark, base, rows, _LIST, schema, after)
    except VersionConflict:
        new = {r[0].split("/")[0] for r in rows} - {r["folder"].split("/")[0] for v in list_versions(spark, base) for r in listed(spark, base, v)}
        for run in new:
            _delete(spark, f"{base}/data/{run}")
        raise


def snapshot(spark: SparkSession, base: str, source: DataFrame, key: str | list[str], check_cols: list[str], run_ts) -> int:
    """One snapshot run with the 'check' strategy (rules of ``scd2.scd2_apply``); the version, the old one if nothing changed.

    NULL is a key like any other. Duplicate source keys fail (``DuplicateKeys``; pass a written source, it is read twice).
    Later sources are cast to the types of the first. A run that is repeated finds no change. Two runs at once: the second fails with ``VersionConflict``.
    """
    keys = _keys(key)
    require_unique(source, keys)
    v, rows, schema = _layout(spark, base)
    if schema:
        source = as_stored(source, T.StructType([f for f in schema.fields if f.name in source.columns]))
    changes = scd2_changes(_open(spark, base, rows, schema, keys) if schema else None, source, keys, check_cols, run_ts)
    changes = changes.where("state <> 'same'")
    new = _write(spark, changes, base)
    if not new and schema:
        return v
    old = [(r["folder"], r["state"], r["settled"]) for r in rows]
    return _publish(spark, base, old + new, schema or changes.drop("state").schema, v)


def compact(spark: SparkSession, base: str, key: str | list[str]) -> int:
    """Write the open set as one run and settle all closings; closed history is not touched. The version."""
    v, rows, schema = _layout(spark, base)
    if schema is None or not _folders(rows, "closed", False):
        return v
    new = _write(spark, _open(spark, base, rows, schema, _keys(key)).withColumn("state", F.lit("open")), base)
    return _publish(spark, base, [(f, "closed", True) for f in _folders(rows, "closed")] + new, schema, v)
