"""Tables that change in one step: a run writes fresh folders, and one catalog command shows them to readers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from installarc.sources.tables import _file_system, _ordered, partition_text, stored_partitions


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _version_of(spark: SparkSession, table: str) -> str | None:
    """The version table that a published name shows now."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(table)} ('version_table')").collect()
    return rows[0]["value"] if rows and spark.catalog.tableExists(rows[0]["value"]) else None


def _folders(spark: SparkSession, version: str, column: str) -> dict[str | None, str]:
    """Folder of each partition of a version table, as the catalog has it."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {_quoted(version)}").collect():
        name = row["partition"]
        value = _partition_value(spark, name)
        told = spark.sql(f"DESCRIBE EXTENDED {_quoted(version)} PARTITION ({_spec(column, value)})")
        found[value] = next(r["data_type"] for r in told.collect() if r["col_name"] == "Location")
    return found


def _partition_value(spark: SparkSession, name: str) -> str | None:
    text = name.partition("=")[2]
    if text == "__HIVE_DEFAULT_PARTITION__":
        return None
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(text)


def _spec(column: str, value: str | None) -> str:
    return f"`{column}` = " + ("NULL" if value is None else _literal(value))


def publish_partitions(
    df: DataFrame,
    table: str,
    root: str,
    column: str,
    order: Sequence[str],
    owned: Callable[[str | None], bool] = lambda value: False,
    before_switch: Callable[[], None] = lambda: None,
) -> str:
    """Replace the partitions that occur in ``df`` in a published table; returns the table of the new version.

    ``table`` is a view. Its rows lie in a version table whose partitions point at folders: those of this run at
    fresh ones under ``root``, all others where they were. Nothing that readers see is touched until everything is
    written; then the view is replaced, which is one catalog command for all partitions together. A run that
    fails before leaves the old rows, and queries that have begun keep reading the old folders until ``forget_versions``.
    Partitions without new rows that are ``owned`` are not in the new version. NULL (and empty text) is a partition.
    ``before_switch`` runs between the write and the switch.
    """
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    plain = df.select(*[c for c in df.columns if c != column], column)
    _ordered(plain, order).write.partitionBy(column).parquet(folder)
    fresh = stored_partitions(spark, folder, column)
    old = _version_of(spark, table)
    kept = {v: f for v, f in (_folders(spark, old, column) if old else {}).items() if v not in fresh and not owned(v)}
    version = f"{table}__{uuid.uuid4().hex[:12]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
    spark.sql(f"CREATE TABLE {_quoted(version)} ({columns}) USING parquet PARTITIONED BY (`{column}`) LOCATION {_literal(folder)}")
    places = [f"PARTITION ({_spec(column, v)}) LOCATION {_literal(f)}" for v, f in {**kept, **fresh}.items()]
    for at in range(0, len(places), 200):
        spark.sql(f"ALTER TABLE {_quoted(version)} ADD {' '.join(places[at : at + 200])}")
    before_switch()
    # the definition of the view and the version that it shows change in this one command
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(table)} TBLPROPERTIES ('version_table' = {_literal(version)}) "
        f"AS SELECT {', '.join(f'`{c}`' for c in df.columns)} FROM {_quoted(version)}"
    )
    return version


def forget_versions(spark: SparkSession, table: str, root: str, column: str) -> int:
    """Drop all versions but the one that readers see, and the folders under ``root`` that only they use; returns their number.

    Versions of runs that failed before the switch go as well. Call it when no query of an older version runs any more.
    """
    shown = _version_of(spark, table)
    used = {f.rstrip("/").rsplit("/", 2)[-2] for f in _folders(spark, shown, column).values()} if shown else set()
    database, _, name = table.rpartition(".")
    rows = spark.sql(f"SHOW TABLES {f'IN {_quoted(database)} ' if database else ''}LIKE '{name}__*'").collect()
    for row in rows:
        version = f"{database}.{row['tableName']}" if database else row["tableName"]
        if version != shown:
            spark.sql(f"DROP TABLE {_quoted(version)}")
    files, top = _file_system(spark, root)
    gone = [s.getPath() for s in (files.listStatus(top) if files.exists(top) else []) if s.getPath().getName() not in used]
    for path in gone:
        files.delete(path, True)
    return len(gone)


def published_values(spark: SparkSession, table: str, column: str) -> set[str | None]:
    """Partitions that readers see, as text."""
    return {row[0] for row in spark.table(table).select(partition_text(F.col(column))).distinct().collect()}
