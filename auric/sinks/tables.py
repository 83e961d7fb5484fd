"""Writing layers to tables: landing with audit columns, commented overwrite,
idempotent per-batch append, namespaces and row-count inventory."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from auric.context import RunContext


def sql_string(value: str) -> str:
    """A SQL string literal with quotes and backslashes escaped."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_audit(df: DataFrame, ctx: RunContext, source_file=None) -> DataFrame:
    """Add ``_ingest_ts``, ``_source_file`` and ``_batch_id``.

    ``source_file`` defaults to the real file each row came from
    (``_metadata.file_path`` of a file scan); pass a literal path otherwise.
    """
    src = (F.lit(source_file) if source_file is not None
           else F.col("_file") if "_file" in df.columns else F.col("_metadata.file_path"))
    own = [c for c in df.columns if c != "_file"]
    return df.select(*own, F.lit(ctx.run_ts).alias("_ingest_ts"), src.alias("_source_file"),
                     F.lit(ctx.batch_id).alias("_batch_id"))


def create_namespaces(spark: SparkSession, names: Iterable[str],
                      properties: Mapping[str, str] | None = None) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
        props = dict(properties or {}, layer=name)
        try:
            pairs = ", ".join(f"{sql_string(k)} = {sql_string(v)}" for k, v in props.items())
            spark.sql(f"ALTER DATABASE {name} SET DBPROPERTIES ({pairs})")
        except Exception:  # properties are best effort (permissions vary)
            pass


def _commented(df: DataFrame, column_comments: Mapping[str, str] | None) -> DataFrame:
    """Carry column comments in the column metadata, so the write itself
    stores them and an overwrite cannot lose them."""
    if not column_comments:
        return df
    unknown = set(column_comments) - set(df.columns)
    if unknown:
        raise ValueError(f"comments for unknown columns: {sorted(unknown)}")
    return df.select(*[
        F.col(c).alias(c, metadata={**df.schema[c].metadata, "comment": column_comments[c]})
        if c in column_comments else F.col(c)
        for c in df.columns])


# Rows written per table by the last overwrite in this process (table -> rows).
WRITE_COUNTS: dict[str, int] = {}

# Properties of a published table (a view). VERSIONS: its layers and those of the
# versions before it, newest first, as JSON; a layer is a table and, if some of
# its partitions have been replaced, the partition column and their values.
VERSIONS, ROWS = "auric.versions", "auric.rows"
ORPHAN_SECONDS = 24 * 3600          # age at which a version that was never published goes


def overwrite_table(df: DataFrame, table: str, comment: str | None = None,
                    column_comments: Mapping[str, str] | None = None,
                    fmt: str = "parquet", partition_by: Iterable[str] = (), keep: int = 1) -> DataFrame:
    """Replace ``table`` with ``df`` (schema included). Returns the table.

    Each overwrite writes a table of its own, with its partitions and comments,
    and then moves the pointer that readers go through: ``table`` is a view of
    the newest version, and replacing the view is one metastore step. Before it
    readers see the old version whole, after it the new one, and whatever ends
    the process in between leaves a readable table. The ``keep`` versions before
    the newest stay, so that readers that planned before the swap finish; older
    ones are dropped, and so are versions that no writer published within a day.
    ``df`` may read the table it replaces.

    The number of rows written is observed during the write itself (no
    second pass to count) and kept in ``WRITE_COUNTS`` and with the table.
    """
    version, rows = _write_version(df, table, column_comments, fmt, partition_by)
    _publish(df.sparkSession, table, [{"table": version}], comment, keep, rows)
    return df.sparkSession.table(table)


def replace_partitions(df: DataFrame, table: str, column: str, values: Iterable[str | None],
                       fmt: str = "parquet", partition_by: Iterable[str] = (), keep: int = 1) -> DataFrame:
    """Replace the rows of ``table`` whose ``column`` is one of ``values`` with
    ``df``, which holds rows of these values only. Returns the table.

    What is written is ``df``. It becomes a layer over the versions below, whose
    rows of these values the view leaves out; where ``column`` is a partition
    column, their files are not read. Publishing is one metastore step, as in
    ``overwrite_table``, and a full overwrite makes one layer of all again.
    """
    spark = df.sparkSession
    values = list(values)
    layers = _layers(spark, table)[0]
    comment = spark.catalog.getTable(table).description
    comments = {f.name: f.metadata["comment"] for f in spark.table(table).schema.fields if "comment" in f.metadata}
    version, rows = _write_version(df.select(*spark.table(table).columns), table, comments, fmt, partition_by)
    below = [{**layer, "column": column, "without": sorted({*layer.get("without", []), *values}, key=str)}
             for layer in layers]
    _publish(spark, table, [{"table": version}, *below], comment, keep, None)
    return spark.table(table)


def _write_version(df: DataFrame, table: str, column_comments, fmt: str, partition_by) -> tuple[str, int]:
    rows = Observation(f"rows_{table}")
    df = _commented(df.observe(rows, F.count(F.lit(1)).alias("rows")), column_comments)
    parts = list(partition_by)
    version = f"{table}__v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    writer = df.write.format(fmt)
    (writer.partitionBy(*parts) if parts else writer).saveAsTable(version)
    WRITE_COUNTS[table] = rows.get.get("rows", 0)
    return version, WRITE_COUNTS[table]


def _publish(spark: SparkSession, table: str, layers: list[dict], comment: str | None, keep: int,
             rows: int | None) -> None:
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        # A table from before versions became views: the only step that is not one
        # metastore call. A rerun after an end in between publishes again.
        first = f"{table}__v{0:020d}_{uuid.uuid4().hex[:8]}"
        spark.sql(f"ALTER TABLE {table} RENAME TO {first}")
        before = [[{"table": first}]]
    else:
        before = _layers(spark, table)
    newest = [layers, *before][:keep + 1]
    fields = spark.table(layers[0]["table"]).schema.fields
    columns = ", ".join(f"`{f.name}`" + (f" COMMENT {sql_string(f.metadata['comment'])}" if "comment" in f.metadata else "")
                        for f in fields)
    names = ", ".join(f"`{f.name}`" for f in fields)

    def select(layer: dict) -> str:
        without = " AND ".join(f"NOT (`{layer['column']}` <=> {'NULL' if v is None else sql_string(v)})"
                               for v in layer.get("without", []))
        return f"SELECT {names} FROM {layer['table']}" + (f" WHERE {without}" if without else "")
    properties = {VERSIONS: json.dumps(newest), **({} if rows is None else {ROWS: str(rows)})}
    spark.sql(f"CREATE OR REPLACE VIEW {table} ({columns})"
              + (f" COMMENT {sql_string(comment)}" if comment else "")
              + f" TBLPROPERTIES ({', '.join(f'{sql_string(k)} = {sql_string(v)}' for k, v in properties.items())})"
              + " AS " + " UNION ALL ".join(map(select, layers)))
    used = {layer["table"] for version in newest for layer in version}
    superseded = {layer["table"] for version in before[keep:] for layer in version} - used
    for name in _versions(spark, table):
        written = int(name.rpartition("__v")[2].split("_")[0])
        if name in superseded or (name not in used and time.time_ns() - written > ORPHAN_SECONDS * 10**9):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _property(spark: SparkSession, table: str, name: str) -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == name).first()
    return found["value"] if found else None


def _layers(spark: SparkSession, table: str) -> list[list[dict]]:
    """The layers of the published versions behind ``table``, newest first."""
    return json.loads(_property(spark, table, VERSIONS) or "[]")


def published_versions(spark: SparkSession, table: str) -> list[str]:
    """The topmost layer's table of each published version, newest first."""
    return [version[0]["table"] for version in _layers(spark, table)]


def written_rows(spark: SparkSession, tables: Iterable[str]) -> DataFrame:
    """(table_name, row_count) as counted when each table was written: reads
    properties, no data. NULL where partitions were replaced since."""
    counts = [(t, int(n) if (n := _property(spark, t, ROWS)) is not None else None) for t in tables]
    return spark.createDataFrame(counts, "table_name string, row_count bigint")


def _versions(spark: SparkSession, table: str) -> list[str]:
    """Every version table of ``table``, published or not."""
    database, _, name = table.rpartition(".")
    found = spark.sql(f"SHOW TABLES IN {database or spark.catalog.currentDatabase()} LIKE '{name}__v*'")
    return sorted((f"{database}." if database else "") + r["tableName"] for r in found.collect()
                  if is_version(r["tableName"], name))


def is_version(name: str, of: str = "") -> bool:
    return re.fullmatch((re.escape(of) if of else ".+") + r"__v\d{20}_[0-9a-f]{8}", name) is not None


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table written by ``overwrite_table`` with all its versions."""
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    for name in _versions(spark, table):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def sample_rows(spark: SparkSession, table: str, n: int = 10,
                order_by: Iterable[str] = ()) -> DataFrame:
    """First ``n`` rows of a table for inspection (ordered when keys are given)."""
    df = spark.table(table)
    keys = list(order_by)
    return (df.orderBy(*keys) if keys else df).limit(n)


def append_batch(df: DataFrame, table: str, batch_id: str, comment: str | None = None,
                 fmt: str = "parquet", column: str = "batch_id") -> DataFrame:
    """Append one batch, replacing an earlier copy of the same batch only.

    The table is partitioned by ``column``. A batch is written to a folder of
    its own; then the batch's partition is pointed to that folder, which is one
    metastore step. So a batch that ran before is replaced whole, by no rows
    too, other batches are untouched, and a write that fails changes nothing.
    No session setting is read or changed: threads may append to several tables,
    or several batches to one. Columns new in ``df`` are added to the table.

    The folder of a replaced batch stays for readers that planned before; see
    ``vacuum_batches``.
    """
    spark = df.sparkSession
    rows = df.drop(column)
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({spec}, `{column}` STRING) USING {fmt} PARTITIONED BY (`{column}`)"
              + (f" COMMENT {sql_string(comment)}" if comment else ""))
    _add_columns(spark, table, rows)
    target = [f for f in spark.table(table).schema.fields if f.name != column]
    own = {c.lower(): c for c in rows.columns}
    aligned = rows.select(*[
        (F.col(own[f.name.lower()]) if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target])
    folder = f"{_location(spark, table)}/{column}-{uuid.uuid4().hex}"
    aligned.write.format(fmt).save(folder)
    partition = f"PARTITION (`{column}` = {sql_string(batch_id)})"
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partition} LOCATION {sql_string(folder)}")
    spark.sql(f"ALTER TABLE {table} {partition} SET LOCATION {sql_string(folder)}")
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {sql_string(comment)}")
    return spark.table(table)


def _add_columns(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Add the columns that the table lacks. Another writer may add the same
    ones at that moment; then there is nothing left to add."""
    for attempt in (1, 2, 3):
        there = {c.lower() for c in spark.table(table).columns}
        new = [f for f in rows.schema.fields if f.name.lower() not in there]
        if not new:
            return
        spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        try:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({spec})")
        except AnalysisException:
            if attempt == 3:
                raise


def _location(spark: SparkSession, table: str, partition: str = "") -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition}").filter("col_name = 'Location'")
    return rows.first()["data_type"].rstrip("/")


def vacuum_batches(spark: SparkSession, table: str, column: str = "batch_id", older_than_seconds: int = ORPHAN_SECONDS) -> int:
    """Delete the folders of ``table`` that no batch points to and that are
    older than the given age; returns how many. Folders are listed and deleted
    through the driver's Hadoop file system, so not from a remote session."""
    home = _location(spark, table)
    batches = [unquote(r["partition"].partition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    used = {_location(spark, table, f"PARTITION (`{column}` = {sql_string(b)})").rpartition("/")[2] for b in batches}
    at = spark._jvm.org.apache.hadoop.fs.Path(home)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for status in files.listStatus(at):
        name = status.getPath().getName()
        if (re.fullmatch(re.escape(column) + "-[0-9a-f]{32}", name) and name not in used
                and time.time() * 1000 - status.getModificationTime() >= older_than_seconds * 1000):
            gone += bool(files.delete(status.getPath(), True))
    return gone


def row_counts(tables: Iterable[tuple[str, str, DataFrame]]) -> DataFrame:
    """(layer, table_name, row_count) for each frame, as one union."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
              for layer, name, df in tables]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def table_inventory(spark: SparkSession, database: str) -> DataFrame:
    """Row count and audit columns of every table in a database."""
    rows = []
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect() if not r["isTemporary"]]
    for name in (f"{database}.{n}" for n in names if not is_version(n)):
        df = spark.table(name)
        audit = ",".join(c for c in df.columns if c.startswith("_"))
        rows.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(database).alias("layer"), F.lit(name.rpartition(".")[2]).alias("table_name"), "row_count",
            F.lit(audit).alias("audit_columns")))
    if not rows:
        return spark.createDataFrame([], "layer string, table_name string, row_count bigint, "
                                         "audit_columns string")
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
