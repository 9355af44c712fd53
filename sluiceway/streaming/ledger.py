"""Append micro-batches to tables of files exactly once, by a ledger beside the checkpoint.

A micro-batch for a table is first written to a folder of its own, through the table's own rules,
and noted as staged. Its files are then moved into the table's folder, one by one, and the
micro-batch is noted as done. A repeated micro-batch finds it done and passes, or staged and moves
what has not been moved, or neither and is written anew; what an attempt left that never came to
be staged is never read. Files keep their names, which no two writes share, so moving is the same
however often it is tried.

Works for tables of Parquet or other plain files in a folder, in a store whose renames are atomic.
A reader may see a micro-batch's files arrive one after the other.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

from sluiceway.sinks.tables import append_rows


class Ledger:
    """What has become of micro-batches, in a folder: ``<table>/<query>/<batch>``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self.files = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def append(self, rows: DataFrame, table: str, query_id: str, batch_id: int) -> bool:
        """Append the rows of a micro-batch to a table; False if that had been done before."""
        of = f"{self.folder}/{table}/{query_id}"
        entry = f"{of}/{batch_id}"
        if self._has(f"{entry}/done"):
            return False
        attempt = self._staged(entry)
        if attempt is None:
            attempt = uuid.uuid4().hex
            self._stage(rows, table, f"{entry}/{attempt}")
            self._note(f"{entry}/staged-{attempt}")
        self._move(f"{entry}/{attempt}", table)
        self._note(f"{entry}/done")
        self._forget(of, batch_id)
        return True

    def _stage(self, rows: DataFrame, table: str, folder: str) -> None:
        """Write rows as the table would have them, by a table like it over another folder."""
        like = f"staged_{uuid.uuid4().hex}"
        kind = self._detail(rows.sparkSession, table, "Provider")
        rows.sparkSession.sql(
            f"CREATE TABLE {like} LIKE IDENTIFIER(:table) USING {kind} LOCATION :folder", args={"table": table, "folder": folder}
        )
        try:
            append_rows(rows, like)
        finally:
            rows.sparkSession.sql(f"DROP TABLE {like}")  # the files stay

    def _move(self, folder: str, table: str) -> None:
        place = self._detail(self.spark, table, "Location")
        target = self._path(place)
        listed = self.files.listFiles(self._path(folder), True) if self._has(folder) else None
        start = len(self.files.makeQualified(self._path(folder)).toString()) + 1
        while listed is not None and listed.hasNext():
            source = listed.next().getPath()
            name = source.toString()[start:]
            if any(part.startswith(("_", ".")) for part in name.split("/")):
                continue
            aim = self._path(f"{target.toString()}/{name}")
            self.files.mkdirs(aim.getParent())
            if not self.files.rename(source, aim):
                raise OSError(f"{source} could not be moved to {aim}")
        self.spark.catalog.refreshTable(table)

    def _staged(self, entry: str) -> str | None:
        if not self._has(entry):
            return None
        for status in self.files.listStatus(self._path(entry)):
            name = status.getPath().getName()
            if name.startswith("staged-"):
                return name.removeprefix("staged-")
        return None

    def _forget(self, of: str, batch_id: int) -> None:
        """Only the last micro-batch of a query can come again, so older ones need no entry."""
        old = self._path(f"{of}/{batch_id - 2}")
        if batch_id >= 2 and self.files.exists(old):
            self.files.delete(old, True)

    def _detail(self, spark: SparkSession, table: str, name: str) -> str:
        described = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:table)", args={"table": table})
        return described.where(described.col_name == name).head()["data_type"]

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _has(self, path: str) -> bool:
        return self.files.exists(self._path(path))

    def _note(self, path: str) -> None:
        self.files.create(self._path(path), True).close()
