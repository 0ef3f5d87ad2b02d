"""Durable state of a warehouse folder: a log of small manifests.

``<root>/_manifest/<version>.json`` names, for every published table, its
folders, row count and key statistics.  Versions are only ever added, each
by one put-if-absent, so of two publishers of a version exactly one wins;
the newest one is the truth, and a reader that starts from it sees either
all of a run or nothing of it.  Nothing a manifest names is written again.

``_manifest/_head`` is a hint at the newest version: a reader opens it, steps
over versions added since and reads one manifest, however long the log is.

Files go through Hadoop's file system interface, so the log lives wherever
the tables live.  Catalog entries are made from it (``sync_catalog``) for
SQL users of this session; a new process gets the same tables from the
same root.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass
class Table:
    """Columns (JSON schema), partition columns and data: a folder for a
    plain table, (partition values, base folder) pairs for a partitioned
    one.  ``rows``: row count, ``open_rows``: those of them that a history
    may still change, as counted when written; ``hot``: frequent keys
    (``skew.hot_keys``); ``sql``: a view's text instead of data;
    ``buckets``: column and number, for rows stored in buckets."""
    schema: str
    partition_by: list[str] = field(default_factory=list)
    path: str | None = None
    parts: list = field(default_factory=list)
    rows: int | None = None
    open_rows: int | None = None
    hot: dict | None = None
    sql: str | None = None
    buckets: list | None = None


@dataclass
class Manifest:
    version: int = 0
    run_id: str = ""
    tables: dict[str, Table] = field(default_factory=dict)
    epochs: dict[str, int] = field(default_factory=dict)
    root: str = ""


class _Files:
    """Small driver-side file operations on whatever storage a path is on."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def put_if_absent(self, name: str, text: str) -> bool:
        """The whole file at once, unless there is one: a finished file of another name is linked
        (local storage) or renamed without overwriting (other storage), both atomic there."""
        temporary = f"{name}.{uuid.uuid4().hex}.tmp"
        self.write(temporary, text)
        source, target = (self.fs.makeQualified(self.path(p)) for p in (temporary, name))
        try:
            if self.fs.getScheme() == "file":
                paths = self.jvm.java.nio.file.Paths
                self.jvm.java.nio.file.Files.createLink(paths.get(target.toUri()), paths.get(source.toUri()))
            else:
                options = self.jvm.org.apache.hadoop.fs.Options.Rename
                how = self.jvm.java.lang.reflect.Array.newInstance(options.NONE.getClass(), 1)
                how[0] = options.NONE
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf).rename(
                    source, target, how)
            return True
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        finally:
            self.fs.delete(self.path(temporary), False)


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/_manifest"


def _file(root: str, version: int) -> str:
    return f"{_folder(root)}/{version:012d}.json"


def _newest(files: _Files, root: str) -> int:
    head = f"{_folder(root)}/_head"
    try:
        version = int(files.read(head) or 0) if files.exists(head) else 0
    except (Py4JJavaError, ValueError):  # being replaced just now: the log itself tells
        version = 0
    if version == 0 or not files.exists(_file(root, version)):
        version = max(versions(files, root), default=0)
    while files.exists(_file(root, version + 1)):
        version += 1
    return version


def versions(files: _Files, root: str) -> list[int]:
    if not files.exists(_folder(root)):
        return []
    names = [s.getPath().getName() for s in files.fs.listStatus(files.path(_folder(root)))]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def load(spark: SparkSession, root: str) -> Manifest:
    """The newest manifest of ``root``; version 0 when there is none."""
    files = _Files(spark, _folder(root))
    version = _newest(files, root)
    if not version:
        return Manifest(root=root)
    return _parsed(files, root, version)


def _parsed(files: _Files, root: str, version: int) -> Manifest:
    d = json.loads(files.read(_file(root, version)))
    return Manifest(d["version"], d["run_id"], {k: Table(**t) for k, t in d["tables"].items()}, d["epochs"], root)


class ConcurrentPublishError(RuntimeError):
    pass


def commit(spark: SparkSession, root: str, old: Manifest, run_id: str,
           tables: dict[str, Table], epochs: dict[str, int] | None = None) -> Manifest:
    """Publish: the old tables with ``tables`` put in their place, in one step."""
    new = Manifest(old.version + 1, run_id, {**old.tables, **tables}, {**old.epochs, **(epochs or {})}, root)
    body = json.dumps({"version": new.version, "run_id": run_id,
                       "tables": {k: t.__dict__ for k, t in new.tables.items()}, "epochs": new.epochs})
    files = _Files(spark, _folder(root))
    if not files.put_if_absent(_file(root, new.version), body):
        raise ConcurrentPublishError(f"version {new.version} of {root} exists already")
    files.write(f"{_folder(root)}/_head", str(new.version))
    return new


def drop_versions(spark: SparkSession, root: str, keep: int) -> list[int]:
    """Remove all but the newest ``keep`` manifests from the log; returns their versions."""
    files = _Files(spark, _folder(root))
    gone = versions(files, root)[:-keep]
    for version in gone:
        files.fs.delete(files.path(_file(root, version)), False)
    return gone


def _directory(cols: list[str], values: list[str]) -> str:
    return "/".join(f"{c}={v}" for c, v in zip(cols, values))


def columns(table: Table) -> list[str]:
    return T.StructType.fromJson(json.loads(table.schema)).names


def _kinds(table: Table) -> list[tuple[str, str]]:
    """Column names and types, whatever may be NULL."""
    return [(f.name, f.dataType.simpleString()) for f in T.StructType.fromJson(json.loads(table.schema)).fields]


def only(table: Table, values) -> Table:
    """The table with those partitions alone (by their first column's values)."""
    wanted = {str(v) for v in values}
    return Table(table.schema, table.partition_by, parts=[p for p in table.parts if p[0][0] in wanted],
                 buckets=table.buckets)


def read(spark: SparkSession, table: Table) -> DataFrame:
    """The table's rows from its own folders."""
    schema = T.StructType.fromJson(json.loads(table.schema))
    if not table.partition_by:
        return spark.read.schema(schema).parquet(table.path)
    by_base: dict[str, list[str]] = {}
    for values, base in table.parts:
        by_base.setdefault(base, []).append(f"{base}/{_directory(table.partition_by, values)}")
    out = None
    for base, paths in by_base.items():
        df = spark.read.schema(schema).option("basePath", base).parquet(*paths).select(schema.names)
        out = df if out is None else out.unionByName(df)
    return out if out is not None else spark.createDataFrame([], schema)


#: Database of the entries through which stored buckets are written and read.
STORE = "ledger_store"


def _store_entry(spark: SparkSession, path: str) -> str:
    if not spark.catalog.databaseExists(STORE):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {STORE}")
    return f"{STORE}.t_{hashlib.md5(path.encode()).hexdigest()}"


def write_bucketed(df: DataFrame, path: str, partition_by: list[str], buckets: list) -> None:
    """Partitions whose rows lie in buckets by key, one sorted file a bucket.  Spark keeps buckets
    with a catalog entry only, so one is made for the write; the files stay when it goes."""
    key, n = buckets
    entry = _store_entry(df.sparkSession, path)
    (df.repartition(n, key).write.partitionBy(*partition_by).bucketBy(n, key).sortBy(key)
     .format("parquet").option("path", path).saveAsTable(entry))
    df.sparkSession.sql(f"DROP TABLE {entry}")


def read_bucketed(spark: SparkSession, table: Table) -> DataFrame:
    """One partition's rows as Spark's bucketed scan gives them: joined by key without an exchange."""
    ((values, base),) = table.parts
    entry = _store_entry(spark, f"{base} {values}")
    if not spark.catalog.tableExists(entry):
        _create_entry(spark, entry, table, "")
    return spark.table(entry).select(columns(table))


def forget_bucketed(spark: SparkSession, table: Table) -> None:
    """Drops the entry that ``read_bucketed`` made; the files stay."""
    ((values, base),) = table.parts
    spark.sql(f"DROP TABLE IF EXISTS {_store_entry(spark, f'{base} {values}')}")


def plain(df: DataFrame, path: str, **more) -> Table:
    return Table(schema=df.schema.json(), path=path, **more)


def partitioned(df: DataFrame, partition_by: list[str], parts: list, **more) -> Table:
    return Table(schema=df.schema.json(), partition_by=partition_by, parts=parts, **more)


def partition_values(spark: SparkSession, path: str, depth: int = 1) -> list[list[str]]:
    """The partitions a written folder has, from its folder names (no job)."""
    found = [[]]
    for _ in range(depth):
        found = [[*names, f] for names in found for f in sorted(
            c.rsplit("/", 1)[1] for c in children(spark, "/".join([path, *names]))) if "=" in f]
    return [[n.split("=", 1)[1] for n in names] for names in found]


#: Table property of a catalog entry: the root and the version of its log that it shows.
SHOWN = "ledger.shows"


def sync_catalog(spark: SparkSession, manifest: Manifest, names: dict[str, str]) -> None:
    """Catalog entries for the manifest's tables.  ``names``: table -> database.table.

    An entry whose columns stay is kept: its location, or the locations of the partitions that
    changed, are set in place, so the table can be read at any time.  Views are replaced.
    Repeating it, in this or another process, gives the same entries."""
    known = [(name, q, manifest.tables[name]) for name, q in names.items() if name in manifest.tables]
    for name, q, t in sorted(known, key=lambda k: k[2].sql is not None):  # views after their tables
        database = q.split(".")[0]
        if not spark.catalog.databaseExists(database):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        if t.sql is not None:
            spark.sql(f"CREATE OR REPLACE VIEW {q} AS {t.sql}")
            continue
        shown = _shown(spark, manifest.root, name, q)
        if shown is not None and (_kinds(shown), shown.partition_by, shown.buckets) == (_kinds(t), t.partition_by, t.buckets):
            _move(spark, q, t, shown, manifest)
        else:
            _create(spark, q, t, manifest)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _mark(manifest: Manifest) -> str:
    return f"('{SHOWN}' = {_quoted(f'{manifest.version} {manifest.root}')})"


def _shown(spark: SparkSession, root: str, name: str, q: str) -> Table | None:
    """What the catalog entry shows now; None without an entry of this log, or beyond its versions."""
    if not spark.catalog.tableExists(q):
        return None
    marks = [r.value for r in spark.sql(f"SHOW TBLPROPERTIES {q}").collect() if r.key == SHOWN]
    version, _, of = (marks or [""])[0].partition(" ")
    files = _Files(spark, _folder(root))
    if of != root or not files.exists(_file(root, int(version))):
        return None
    return _parsed(files, root, int(version)).tables.get(name)


def _spec(t: Table, values: list[str]) -> str:
    return "(" + ", ".join(f"{c} = {_quoted(v)}" for c, v in zip(t.partition_by, values)) + ")"


def _at(t: Table, values: list[str], base: str) -> str:
    return f"LOCATION {_quoted(base + '/' + _directory(t.partition_by, values))}"


def _add(spark: SparkSession, q: str, t: Table, parts: list) -> None:
    if parts:
        spark.sql(f"ALTER TABLE {q} ADD IF NOT EXISTS "
                  + " ".join(f"PARTITION {_spec(t, v)} {_at(t, v, base)}" for v, base in parts))


def _create(spark: SparkSession, q: str, t: Table, manifest: Manifest) -> None:
    kind = "VIEW" if spark.catalog.tableExists(q) and spark.catalog.getTable(q).tableType == "VIEW" else "TABLE"
    spark.sql(f"DROP {kind} IF EXISTS {q}")  # other columns, or no entry of this log; the files stay
    _create_entry(spark, q, t, f" TBLPROPERTIES {_mark(manifest)}")


def _create_entry(spark: SparkSession, q: str, t: Table, properties: str) -> None:
    fields = T.StructType.fromJson(json.loads(t.schema)).fields
    last = [f for c in t.partition_by for f in fields if f.name == c]
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                      for f in [f for f in fields if f.name not in t.partition_by] + last)
    by = f" PARTITIONED BY ({', '.join(t.partition_by)})" if t.partition_by else ""
    if t.buckets:
        key, n = t.buckets
        by += f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {n} BUCKETS"
    location = t.path or (t.parts[0][1] if t.parts else None)
    at = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE TABLE {q} ({names}) USING parquet{by}{at}{properties}")
    _add(spark, q, t, t.parts)


def _move(spark: SparkSession, q: str, t: Table, shown: Table, manifest: Manifest) -> None:
    if (shown.path, shown.parts) == (t.path, t.parts):
        return
    if not t.partition_by:
        spark.sql(f"ALTER TABLE {q} SET LOCATION {_quoted(t.path)}")
    else:
        old, new = ({tuple(v): base for v, base in parts} for parts in (shown.parts, t.parts))
        _add(spark, q, t, [(list(v), base) for v, base in new.items() if v not in old])
        for v, base in new.items():
            if v in old and old[v] != base:
                spark.sql(f"ALTER TABLE {q} PARTITION {_spec(t, list(v))} SET {_at(t, list(v), base)}")
        gone = [list(v) for v in old if v not in new]
        if gone:
            spark.sql(f"ALTER TABLE {q} DROP IF EXISTS " + ", ".join(f"PARTITION {_spec(t, v)}" for v in gone))
    spark.sql(f"ALTER TABLE {q} SET TBLPROPERTIES {_mark(manifest)}")
    spark.sql(f"REFRESH TABLE {q}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a run's folder (an unpublished one) on whatever storage it is."""
    files = _Files(spark, path)
    files.fs.delete(files.path(path), True)


def exists(spark: SparkSession, path: str) -> bool:
    return _Files(spark, path).exists(path)


def children(spark: SparkSession, path: str) -> list[str]:
    """Folders in a folder; none if it does not exist."""
    files = _Files(spark, path)
    if not files.exists(path):
        return []
    return [f"{path}/{s.getPath().getName()}" for s in files.fs.listStatus(files.path(path)) if s.isDirectory()]
