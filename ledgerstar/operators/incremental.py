"""Incremental loads: look-back slice, merge by unique key, versioned partitioned tables.

A merged table is a folder with two parts: ``data/run=<id>/<partition folders>``, never
changed once written, and ``versions/v=<n>``, the list of data folders that make up version
n, with the version's schema. A merge writes new folders for the partitions it touches, then the next
version; readers take the newest. So nobody reads a half-written table, a failed merge or
refresh leaves the old version in place, and untouched partitions are not rewritten.

A version appears by one rename that fails if the version exists: of two writers that began from
the same version one is first, the other finds the conflict and merges again into what is newest
then. The list also keeps, per folder, the range of chosen columns, so that a merge reads only the
folders in which a source key can be.
"""

from __future__ import annotations

import datetime as _dt
import json
import os.path
import uuid
from collections.abc import Callable
from decimal import Decimal

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.session import shuffles_dropped, written


def watermark(tgt: DataFrame | None, tgt_ts: str, days: int = 3, floor: str = "1900-01-01") -> _dt.date:
    """``max(tgt_ts) - days`` (``floor - days`` for an empty or missing target).

    One aggregate over the target's watermark column (pruned to that column, partial
    per file); the single value goes back as a literal so that the slice below is a
    pushed-down parquet filter. Pass the stored target, not a plan that computes it.
    """
    if tgt is None:
        m = None
    else:
        m = tgt.agg(F.max(F.col(tgt_ts).cast("date")).alias("m")).first()["m"]
    base = m or _dt.date.fromisoformat(floor)
    return base - _dt.timedelta(days=days)


def incremental_slice(src: DataFrame, tgt: DataFrame | None, src_ts: str, tgt_ts: str,
                      days: int = 3, full_refresh: bool = False) -> DataFrame:
    """Rows of ``src`` modified on or after the target's watermark minus the look-back.

    Late rows inside the look-back are re-read on purpose; the merge makes re-reading
    harmless. ``full_refresh`` skips the filter.
    """
    if full_refresh:
        return src
    bound = watermark(tgt, tgt_ts, days)
    return src.where(F.col(src_ts) >= F.lit(bound))


class DuplicateKeys(ValueError):
    """The source of a merge holds a key more than once."""


def require_unique(src: DataFrame, keys: list[str]) -> None:
    """Fail when a key occurs more than once (a merge would multiply its rows)."""
    twice = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(5).collect()
    if twice:
        raise DuplicateKeys(f"source keys are not unique: {[tuple(r[k] for k in keys) for r in twice]}")


def _same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b["__" + k])
    return cond


def merge_upsert(tgt: DataFrame | None, src: DataFrame, keys: list[str] | str, check: bool = True) -> DataFrame:
    """Matched keys take the source row, unmatched source rows are inserted, the rest
    of the target stays: ``anti-join + union``. Duplicate source keys fail (``check``, one more
    read of the source's keys: pass a written source).

    The matched keys are found first, from the key columns alone, and written. Mostly they are few (an
    increment is new rows), so the planner, which sees their size, need not move the target's whole rows to drop them."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if check:
        require_unique(src, keys)
    if tgt is None:
        return src
    seen = src.select(*[F.col(k).alias("__" + k) for k in keys])
    matched = tgt.select(*keys).join(seen, _same_keys(tgt, seen, keys), "left_semi").distinct()
    matched = written(matched.select(*[F.col(k).alias("__" + k) for k in keys]), "merge-keys")
    kept = tgt.join(matched, _same_keys(tgt, matched, keys), "left_anti")
    return kept.unionByName(src.select(*tgt.columns))


def changed_rows(before: DataFrame, after: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Rows that differ between two versions of a table (both directions), ignoring audit
    columns. Empty after a replay means the load is idempotent."""
    ignore = set(ignore or [])
    cols = [c for c in before.columns if c not in ignore]
    b = before.select(*cols)
    a = after.select(*cols)
    return (a.exceptAll(b).withColumn("change", F.lit("added"))
            .unionByName(b.exceptAll(a).withColumn("change", F.lit("removed"))))


# ---------------------------------------------------------------- versioned tables
_ROOT = "/./"            # in a listed folder: between another table's data folder and the folder in it
RANGE_BINS = 1024        # intervals of source keys that the ranges of folders are held against


class VersionConflict(RuntimeError):
    """Another writer has published the version first."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename_new(spark: SparkSession, src: str, dst: str) -> None:
    """Rename a folder; ``VersionConflict`` if ``dst`` exists (decided by the file system, in one step where it can)."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    none = getattr(hadoop, "Options$Rename").NONE
    options = sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = none
    to = hadoop.Path(dst)
    context = hadoop.FileContext.getFileContext(to.getFileSystem(sc._jsc.hadoopConfiguration()).getUri(), sc._jsc.hadoopConfiguration())
    try:
        context.rename(hadoop.Path(src), to, options)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception):
            raise VersionConflict(dst) from None
        raise


def list_versions(spark: SparkSession, base: str) -> list[int]:
    """Versions, oldest first."""
    return sorted(int(n[2:]) for n in _names(spark, f"{base}/versions") if n.startswith("v="))


def listed(spark: SparkSession, base: str, version: int) -> list[Row]:
    """What a version is made of: a row per data folder, with ``folder`` (relative to ``data``) and what was recorded of it."""
    return spark.read.parquet(f"{base}/versions/v={version}").collect()


def version_schema(spark: SparkSession, base: str, version: int) -> T.StructType:
    return spark.read.parquet(f"{base}/versions/v={version}/_schema").schema


def read_note(spark: SparkSession, base: str, version: int | None = None) -> dict:
    """What writers have noted with the newest version (or the one asked for)."""
    vs = list_versions(spark, base)
    path = f"{base}/versions/v={version or (vs[-1] if vs else 0)}/_note"
    return json.loads(spark.read.text(path).first()[0]) if _names(spark, path) else {}


def publish(spark: SparkSession, base: str, rows: list[tuple], fields: str, schema: T.StructType, after: int,
            note: dict | None = None) -> int:
    """Publish version ``after + 1``, a list of ``rows`` (``fields``, ``folder`` among them) with its schema.
    ``VersionConflict`` if it exists by now. The version's note is that of version ``after``, updated by ``note``."""
    new = f"{base}/versions/.new-{uuid.uuid4().hex[:12]}"
    spark.createDataFrame(rows, fields).coalesce(1).write.parquet(new)
    spark.createDataFrame([], schema).write.parquet(f"{new}/_schema")
    noted = read_note(spark, base, after) | (note or {}) if after else note
    if noted:
        spark.createDataFrame([(json.dumps(noted),)], "value string").coalesce(1).write.text(f"{new}/_note")
    try:
        rename_new(spark, new, f"{base}/versions/v={after + 1}")
    except VersionConflict:
        _delete(spark, new)
        raise
    return after + 1


def read_folders(spark: SparkSession, base: str, folders: list[str], schema: T.StructType) -> DataFrame:
    """The rows of some data folders; one that a clone lists names its own root."""
    if not folders:
        return spark.createDataFrame([], schema)
    by_root: dict[str, list[str]] = {}
    for f in folders:
        root, own = f.rsplit(_ROOT, 1) if _ROOT in f else (f"{base}/data", f)
        by_root.setdefault(root, []).append(own)
    out = None
    for root, own in by_root.items():
        part = spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{f}" for f in own]).select(*schema.names)
        out = part if out is None else out.unionByName(part)
    return out


def clone_table(spark: SparkSession, base: str, version: int, to: str) -> int:
    """A new table ``to`` whose first version is a version of ``base``, without a copy of its data: it lists the same folders,
    which are never changed. Merges write into the new table alone; ``base`` must stay while it is read."""
    rows = [(r["folder"] if _ROOT in r["folder"] else f"{base}/data{_ROOT}{r['folder']}", r["ranges"]) for r in listed(spark, base, version)]
    return publish(spark, to, rows, _LIST, version_schema(spark, base, version), 0)


def as_stored(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and types of the table (a value that does not fit fails)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_current(spark: SparkSession, base: str, version: int | None = None) -> DataFrame | None:
    """The newest version (or the one asked for); None before the first."""
    vs = list_versions(spark, base)
    if not vs:
        return None
    v = version or vs[-1]
    return read_folders(spark, base, [r["folder"] for r in listed(spark, base, v)], version_schema(spark, base, v))


def _write_run(df: DataFrame, base: str, partition_col: str, finish: Callable[[DataFrame], DataFrame] | None = None) -> list[str]:
    """Write ``df`` as a run of partition folders; their names relative to ``data``.

    Rows are dealt by partition value first, so a folder gets few files; the rebalance lets AQE
    split a busy value over several tasks and files and pack small ones together. ``finish`` is applied after that.
    """
    spark, run = df.sparkSession, f"run={uuid.uuid4().hex[:12]}"
    path = f"{base}/data/{run}"
    with shuffles_dropped(spark):
        dealt = df.hint("rebalance", F.col(partition_col))
        (finish(dealt) if finish else dealt).write.partitionBy(partition_col).option("compression", "zstd").parquet(path)
    return [f"{run}/{n}" for n in _names(spark, path) if n.startswith(f"{partition_col}=")]


def _described(spark: SparkSession, base: str, folders: list[str], schema: T.StructType, partition_col: str, ranges: list[str]) -> list[tuple]:
    """(folder, ranges) of new folders; one grouped aggregate over the range columns of the written files.

    The ranges are a JSON text: {column: [least, greatest, has NULL]}, values as texts.
    """
    if not folders or not ranges:
        return [(f, None) for f in folders]
    run = folders[0].split("/", 1)[0]
    df = spark.read.schema(schema).parquet(f"{base}/data/{run}")
    cols = [f(c) for c in ranges for f in (lambda c: F.min(c).cast("string"), lambda c: F.max(c).cast("string"), lambda c: F.max(F.col(c).isNull()))]
    found = {}
    for r in df.groupBy(partition_col).agg(*cols).collect():  # one row per folder
        found[f"{run}/{_folder_name(spark, partition_col, r[0])}"] = json.dumps({c: r[1 + 3 * i:4 + 3 * i] for i, c in enumerate(ranges)})
    return [(f, found.get(f)) for f in folders]


_LIST = "folder string, ranges string"


def write_table(df: DataFrame, base: str, partition_col: str, ranges: list[str] | None = None,
                finish: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Write ``df`` as the next version of the table, replacing all partitions (a full
    refresh); the version number. ``ranges`` are columns whose range per folder is kept for merges. ``finish`` makes the
    table's rows, row by row, from ``df`` (which has the partition column) when they have been dealt: what can be
    computed from other columns, as hash keys, is not exchanged."""
    spark = df.sparkSession
    schema = finish(df).schema if finish else df.schema
    rows = _described(spark, base, _write_run(df, base, partition_col, finish), schema, partition_col, ranges or [])
    while True:
        try:
            return publish(spark, base, rows, _LIST, schema, max(list_versions(spark, base), default=0))
        except VersionConflict:
            continue  # it replaces whatever was published meanwhile


def _parse(text: str | None, kind: T.DataType):
    """A recorded bound in a form that compares in Spark's order."""
    if text is None or isinstance(kind, T.StringType):
        return text
    return text if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else Decimal(text)


def _source_intervals(src: DataFrame, column: str) -> tuple[list[tuple], bool]:
    """Intervals that together hold all values of the source column, and whether it has NULLs: at most ``RANGE_BINS`` equal
    parts of its range; for texts, one per two characters after what all of them begin with."""
    kind = src.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.StringType):
        low, high = src.agg(F.min(c), F.max(c)).first()
        bins = F.substring(c, len(os.path.commonprefix([low or "", high or ""])) + 1, 2)
    else:
        n = F.unix_date(c) if isinstance(kind, T.DateType) else F.unix_micros(c.cast("timestamp")) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else c
        low, high = src.agg(F.min(n).cast("double"), F.max(n).cast("double")).first()
        bins = F.lit(0) if low is None or low == high else F.floor((n.cast("double") - F.lit(low)) / F.lit(high - low) * RANGE_BINS)
    got = src.groupBy(bins.alias("b")).agg(F.min(c).cast("string").alias("low"), F.max(c).cast("string").alias("high"), F.max(c.isNull()).alias("null")).collect()
    spans = [(_parse(r["low"], kind), _parse(r["high"], kind)) for r in got if r["low"] is not None]
    return spans, any(r["null"] for r in got)


def folders_near(rows: list[Row], src: DataFrame, columns: list[str]) -> list[str]:
    """The folders in which a source value of every one of ``columns`` can be, by the recorded ranges;
    folders without a record are kept."""
    known = {c for r in rows if r["ranges"] for c in json.loads(r["ranges"])}
    near = [r["folder"] for r in rows]
    for c in columns:
        if c not in known:
            continue
        spans, null = _source_intervals(src, c)
        kind, out = src.schema[c].dataType, []
        for r in rows:
            held = json.loads(r["ranges"]).get(c) if r["ranges"] else None
            if held is None:
                out.append(r["folder"])
                continue
            low, high, has_null = _parse(held[0], kind), _parse(held[1], kind), held[2]
            if null and has_null or low is not None and any(a <= high and b >= low for a, b in spans):
                out.append(r["folder"])
        near = [f for f in near if f in set(out)]
    return near


def merge_table(spark: SparkSession, base: str, src: DataFrame, keys: list[str] | str, partition_col: str,
                newest: str | None = None, ranges: list[str] | None = None, attempts: int = 20,
                on_written: Callable[[int], None] | None = None, note: dict | None = None) -> int:
    """Merge ``src`` into the table as its next version; the version number.

    The partitions rewritten are those of the source rows and those that hold a source key
    now, so a key whose partition value changes leaves its old partition; NULL is a
    partition like any other. With ``newest``, a stored row with a later value of that
    column stays (files of one landing may arrive in any order).

    ``ranges``: columns that are equal wherever the keys are (the keys themselves, or what they are made from). Stored keys
    are looked for only in folders whose recorded range of these columns holds a source value. If another
    writer publishes first, the merge starts again from the newest version, up to ``attempts`` times. ``on_written`` is
    called with the number of the attempt when its data is written and its version is not yet published. ``note`` is
    published with the version, in the same step; with a note a version is published even if no row changes.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    require_unique(src, keys)
    for attempt in range(1, attempts + 1):
        vs = list_versions(spark, base)
        if not vs:
            rows = _described(spark, base, _write_run(src, base, partition_col), src.schema, partition_col, ranges or [])
            try:
                return publish(spark, base, rows, _LIST, src.schema, 0, note)
            except VersionConflict:
                _drop_run(spark, base, rows)
                continue
        found = _merged(spark, base, vs[-1], src, keys, partition_col, newest, ranges or [])
        if found is None and not note:
            return vs[-1]
        new, rows = found or ([], [(r["folder"], r["ranges"]) for r in listed(spark, base, vs[-1])])
        if on_written:
            on_written(attempt)
        try:
            return publish(spark, base, rows, _LIST, version_schema(spark, base, vs[-1]), vs[-1], note)
        except VersionConflict:
            _drop_run(spark, base, new)
    raise VersionConflict(f"{base}: {attempts} merges in a row found a newer version")


def _drop_run(spark: SparkSession, base: str, rows: list[tuple]) -> None:
    for run in {r[0].split("/", 1)[0] for r in rows}:
        _delete(spark, f"{base}/data/{run}")


def _merged(spark: SparkSession, base: str, version: int, src: DataFrame, keys: list[str], partition_col: str,
            newest: str | None, ranges: list[str]) -> tuple[list[tuple], list[tuple]] | None:
    """Write the partitions that ``src`` changes; (their list rows, the list rows of the next version), None if there are none."""
    held, schema = listed(spark, base, version), version_schema(spark, base, version)
    src = as_stored(src, schema)
    near = read_folders(spark, base, folders_near(held, src, ranges), schema)
    if newest:
        old = near.select(*[F.col(k).alias("__" + k) for k in keys], F.col(newest).alias("__newest"))
        src = (src.join(old, _same_keys(src, old, keys), "left")
               .where(F.col("__newest").isNull() | (F.col(newest) >= F.col("__newest"))).select(*schema.names))
    seen = src.select(*[F.col(k).alias("__" + k) for k in keys])
    left = near.join(seen, _same_keys(near, seen, keys), "left_semi").select(partition_col)
    # bounded: one value per partition of the table
    touched = [r[0] for r in src.select(partition_col).unionByName(left).distinct().collect()]
    if not touched:
        return None
    names = {_folder_name(spark, partition_col, t) for t in touched}
    here = [r["folder"] for r in held if r["folder"].rsplit("/", 1)[1] in names]
    merged = merge_upsert(read_folders(spark, base, here, schema), src, keys, check=False)
    new = _described(spark, base, _write_run(merged, base, partition_col), schema, partition_col, ranges)
    return new, [(r["folder"], r["ranges"]) for r in held if r["folder"] not in set(here)] + new


def drop_versions(spark: SparkSession, base: str, keep: int = 1) -> int:
    """Forget all but the newest ``keep`` versions; data folders that only they list are deleted, folders
    of writers that have not yet published are not. The number of folders deleted."""
    vs = list_versions(spark, base)
    old, kept = vs[:-keep], vs[-keep:]
    held = {r["folder"] for v in kept for r in listed(spark, base, v)}
    gone = {r["folder"] for v in old for r in listed(spark, base, v)} - held
    for v in old:
        _delete(spark, f"{base}/versions/v={v}")
    for f in (f for f in gone if _ROOT not in f):  # a clone does not delete what it only lists
        _delete(spark, f"{base}/data/{f}")
    return len(gone)


def _folder_name(spark: SparkSession, column: str, value) -> str:
    """Spark's folder name of a partition value."""
    if value is None:
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{column}={escape(str(value))}"
