"""Stored tables: parquet folders or a JDBC database behind one ``load_table``.

Streaming jobs write in two ways, both safe to repeat for a batch that is replayed:
``write_batch`` replaces the part of that batch, ``VersionedTable`` keeps one snapshot per batch.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashtide import schemas as S


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None) -> dict[str, str]:
    options = {"url": url, "dbtable": table}
    if user:
        options |= {"user": user, "password": password or ""}
    return options


def jdbc_partitions(column: str, lower: str, upper: str, partitions: int) -> dict[str, str]:
    """Options that read a large table in ranges of a number or time column, one task each."""
    bounds = {"partitionColumn": column, "lowerBound": lower, "upperBound": upper}
    return {**bounds, "numPartitions": str(partitions)}


def load_table(
    spark: SparkSession,
    name: str,
    root: str | None = None,
    jdbc: dict[str, str] | None = None,
    ranges: dict[str, str] | None = None,
) -> DataFrame:
    """A stored table by name, from a parquet root or from a database.

    From a database the append-only tables need ``ranges`` (see ``jdbc_partitions``); only the small
    keyed tables are read by one task.
    """
    if name not in S.TABLES:
        raise ValueError(f"unknown table {name!r}")
    if jdbc is not None:
        if ranges is None and name not in S.SMALL_TABLES:
            raise ValueError(f"{name} can be large: say how to split its reading")
        return spark.read.format("jdbc").options(**{**jdbc, **(ranges or {}), "dbtable": name}).load()
    return spark.read.schema(S.TABLES[name]).parquet(f"{root}/{name}")


def load_pending_file(spark: SparkSession, path: str, kind: str = "csv") -> DataFrame:
    """The morning's pending-payment file with its fixed layout; no schema inference."""
    reader = spark.read.schema(S.TABLES["pending_payments"])
    return reader.option("header", "true").csv(path) if kind == "csv" else reader.parquet(path)


FAN = 16  # parts of one size that are merged
KEEP = 5  # finished batches whose parts stay readable for a replay
_PART, _DAY = "stored_part", "event_day"


def write_batch(rows: DataFrame, folder: str, batch_id: int, day: str | None = None) -> None:
    """Append one batch to a table of parts, by the day of the time column ``day`` if given.

    The part of a batch is a folder that a replay replaces.  A small file lists the parts that are live after
    the batch; it is made from the list of the batch before, so a replay leaves the same table.  Every
    ``FAN`` parts of one size are merged into one, so a table of n batches has some ``FAN`` times log(n) parts
    and each row is rewritten log(n) times.  Large days are split by size (adaptive rebalancing).
    """
    spark = rows.sparkSession
    parts = _Parts(spark, folder)
    single = f"{_PART}=batch-{batch_id}"
    _write_part(rows, f"{folder}/{single}", day)
    live = parts.live(before=batch_id)
    if parts.has_rows(single):
        live = [*live, (single, batch_id, batch_id, 0)]
    while len(live) >= FAN and len({level for *_, level in live[-FAN:]}) == 1:
        merged, level = live[-FAN:], live[-1][3] + 1
        name = f"{_PART}=merged-{merged[0][1]}-{merged[-1][2]}"
        together = _read_parts(spark, folder, [m[0] for m in merged], rows.schema).select(*rows.columns)
        dealt = _with_day(together, day).hint("rebalance", _DAY) if day else together.hint("rebalance")
        _write_part(dealt, f"{folder}/{name}", day)
        live = [*live[:-FAN], (name, merged[0][1], merged[-1][2], level)]
    parts.publish(batch_id, live)


def _with_day(rows: DataFrame, day: str) -> DataFrame:
    return rows.withColumn(_DAY, F.to_date(day))


def _write_part(rows: DataFrame, folder: str, day: str | None) -> None:
    if day is None:
        rows.write.mode("overwrite").parquet(folder)
        return
    dated = rows if _DAY in rows.columns else _with_day(rows, day)
    dated.write.mode("overwrite").partitionBy(_DAY).parquet(folder)


def _read_parts(spark: SparkSession, folder: str, names: list[str], schema) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", folder).parquet(*[f"{folder}/{name}" for name in names])


def read_batches(spark: SparkSession, folder: str, schema=None, days: tuple | None = None) -> DataFrame:
    """All finished batches of an append-only table (no rows if nothing was written).

    ``days`` (first and last, both included) limits the reading to the folders of these days.
    """
    live = [name for name, *_ in _Parts(spark, folder).live()]
    if not live:
        return spark.createDataFrame([], schema)
    kept = schema
    if days is not None:
        kept = T.StructType([*schema.fields, T.StructField(_DAY, T.DateType())])
    found = _read_parts(spark, folder, live, kept)
    if days is not None:
        found = found.where(F.col(_DAY).between(F.lit(days[0]), F.lit(days[1])))
    return found.drop(_PART, _DAY)


def read_batch(spark: SparkSession, folder: str, batch_id: int, schema) -> DataFrame:
    """What one batch has written, while it is under way or among the last finished ones."""
    return spark.read.schema(schema).parquet(f"{folder}/{_PART}=batch-{batch_id}").select(*schema.names)


def batch_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The batches of an append-only table as a stream; a replayed batch comes again."""
    reader = spark.readStream.schema(schema).option("basePath", folder)
    return reader.parquet(f"{folder}/{_PART}=batch-*").select(*schema.names)


class _Parts:
    """The lists of live parts of a table: (name, first batch, last batch, level), one list per batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.lists = spark, folder, f"{folder}/_parts"
        self.files, _ = _file_system(spark, folder)

    def _names(self, folder: str) -> list[str]:
        path = _path(self.spark, folder)
        return [status.getPath().getName() for status in self.files.listStatus(path)] if self.files.exists(path) else []

    def _versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names(self.lists) if n.endswith(".json"))

    def _read(self, version: int) -> list[tuple]:
        stream = self.files.open(_path(self.spark, f"{self.lists}/{version}.json"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return [tuple(part) for part in json.loads(text)]

    def live(self, before: int | None = None) -> list[tuple]:
        usable = [v for v in self._versions() if before is None or v < before]
        return self._read(usable[-1]) if usable else []

    def has_rows(self, name: str) -> bool:
        return any(not n.startswith("_") for n in self._names(f"{self.folder}/{name}"))

    def publish(self, version: int, live: list[tuple]) -> None:
        """Write the list whole, then put it in place; old lists and parts that none of the last needs go."""
        draft, final = (_path(self.spark, f"{self.lists}/{name}") for name in (f"_{version}.tmp", f"{version}.json"))
        stream = self.files.create(draft, True)
        stream.write(bytearray(json.dumps(live).encode()))
        stream.close()
        self.files.delete(final, False)
        self.files.rename(draft, final)
        versions = [v for v in self._versions() if v <= version]
        needed = {name for v in versions[-KEEP:] for name, *_ in self._read(v)}
        for old in versions[:-KEEP]:
            self.files.delete(_path(self.spark, f"{self.lists}/{old}.json"), False)
        for name in self._names(self.folder):
            last = name.rsplit("-", 1)[-1] if name.startswith(f"{_PART}=") else ""
            if last.isdigit() and name not in needed and int(last) <= version - KEEP:
                self.files.delete(_path(self.spark, f"{self.folder}/{name}"), True)


class VersionedTable:
    """A small keyed table, one full snapshot per batch.

    Batch N reads the newest snapshot older than N and writes its own, so a replay starts from the
    same rows and ends with the same snapshot.
    """

    def __init__(self, spark: SparkSession, folder: str, schema, keep: int = 5):
        self.spark, self.folder, self.schema, self.keep = spark, folder, schema, keep

    def versions(self) -> list[int]:
        """Complete snapshots, oldest first."""
        files, path = _file_system(self.spark, self.folder)
        if not files.exists(path):
            return []
        found = []
        for status in files.listStatus(path):
            name = status.getPath().getName()
            if name.startswith("v=") and files.exists(_path(self.spark, f"{self.folder}/{name}/_SUCCESS")):
                found.append(int(name[2:]))
        return sorted(found)

    def read(self, before: int | None = None) -> DataFrame:
        usable = [v for v in self.versions() if before is None or v < before]
        if not usable:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/v={usable[-1]}")

    def write(self, rows: DataFrame, version: int) -> None:
        columns = [rows[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields]
        rows.select(*columns).write.mode("overwrite").parquet(f"{self.folder}/v={version}")
        files, _ = _file_system(self.spark, self.folder)
        for old in [v for v in self.versions() if v < version][: -self.keep]:
            files.delete(_path(self.spark, f"{self.folder}/v={old}"), True)


def _path(spark: SparkSession, folder: str):
    return spark._jvm.org.apache.hadoop.fs.Path(folder)


def part_files(spark: SparkSession, folder: str) -> int:
    """How many data files lie in a folder that is not partitioned."""
    files, path = _file_system(spark, folder)
    return sum(status.getPath().getName().startswith("part-") for status in files.listStatus(path))


def _file_system(spark: SparkSession, folder: str):
    path = _path(spark, folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path
