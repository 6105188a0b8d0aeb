"""A layer: a folder of Parquet tables, one sub-folder (or ``name.parquet``) per table.

A layer that a job rebuilds has versions instead: every run writes its tables into a folder of its own,
and one small file names the version that readers see, with its tables and their columns. It is
replaced by a rename, so readers find either the old layer or the new one, all of it, and a run that
fails changes nothing. The version before stays, for readers that have started; older ones go.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from stellate.config.optionsets import PREFIX
from stellate.sources.staging import delete_folder, shuffles_dropped

SUFFIX = ".parquet"
# The file that names the current version, and the folder of all versions.
POINTER, VERSIONS = "_current.json", "_versions"


@dataclass
class Rebuild:
    """One run that writes a new version of a layer. ``tables`` will be visible, with these columns."""

    layer: Layer
    version: str = field(default_factory=lambda: uuid.uuid4().hex)
    tables: dict[str, list[str]] = field(default_factory=dict)

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Write a table of the new version and return a reader of it."""
        path = f"{self.layer.folder}/{VERSIONS}/{self.version}/{table}"
        with shuffles_dropped(self.layer.spark):
            df.write.mode("error").option("compression", "zstd").parquet(path)
        self.tables[table] = df.columns
        return self.layer.spark.read.schema(df.schema).parquet(path)

    def leave_out(self, table: str, columns: Iterable[str]) -> None:
        """Hide columns of a written table; the files keep them, without any value."""
        gone = set(columns)
        self.tables[table] = [c for c in self.tables[table] if c not in gone]

    def forget(self, table: str) -> None:
        """The written table is no part of the layer."""
        del self.tables[table]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Treat NaN as a missing value in every floating-point column."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.nanvl(f"`{c}`", F.lit(None)) for c in floating})


class Layer:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._seen: tuple[dict | None] | None = None

    def _path(self, relative: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{relative}".rstrip("/"))

    def _files(self):
        path = self._path()
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def beside(self, name: str) -> str:
        """A folder of that name in the same parent; relative folders stay relative."""
        parent = self._path().getParent()
        return f"{parent.toString()}/{name}" if parent is not None and parent.toString() else name

    def same_place(self, other: Layer) -> bool:
        def whole(layer: Layer) -> str:
            return layer._files().makeQualified(layer._path()).toString()

        return whole(self) == whole(other)

    def _pointer(self) -> dict | None:
        """What the pointer file says now."""
        files, path = self._files(), self._path(POINTER)
        if not files.exists(path):
            return None
        stream = files.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _current(self) -> dict | None:
        """The version this reader has seen first: all its tables are of one version."""
        if self._seen is None:
            self._seen = (self._pointer(),)
        return self._seen[0]

    def _point_to(self, said: dict) -> None:
        files, path = self._files(), self._path(f"{POINTER}.{said['version']}")
        stream = files.create(path, True)
        try:
            stream.write(bytearray(json.dumps(said).encode()))
        finally:
            stream.close()
        fs = self.spark._jvm.org.apache.hadoop.fs
        rename = getattr(fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        context = fs.FileContext.getFileContext(files.makeQualified(path).toUri(), conf)
        context.rename(files.makeQualified(path), files.makeQualified(self._path(POINTER)), options)

    def _delete_version(self, version: str | None) -> None:
        if version:
            self._files().delete(self._path(f"{VERSIONS}/{version}"), True)

    @contextmanager
    def rebuild(self) -> Iterator[Rebuild]:
        """Write a whole new version; readers see it once the block has ended without an error."""
        run = Rebuild(self)
        try:
            yield run
        except BaseException:
            self._delete_version(run.version)
            raise
        before = self._pointer() or {}
        self._point_to({"version": run.version, "previous": before.get("version"), "tables": run.tables})
        self._seen = None
        self._delete_version(before.get("previous"))

    def tables(self) -> list[str]:
        """Names of the tables; none when the folder is missing."""
        current = self._current()
        if current is not None:
            return sorted(current["tables"])
        if not self._files().exists(self._path()):
            return []
        names = [s.getPath().getName() for s in self._files().listStatus(self._path())]
        names = [n for n in names if not n.startswith((".", POINTER)) and n != VERSIONS]
        return sorted(n.removesuffix(SUFFIX) for n in names)

    def option_sets(self) -> list[str]:
        return [t for t in self.tables() if t.startswith(PREFIX)]

    def data_tables(self) -> list[str]:
        return [t for t in self.tables() if not t.startswith(PREFIX)]

    def locate(self, table: str) -> str | None:
        current = self._current()
        if current is not None:
            return f"{self.folder}/{VERSIONS}/{current['version']}/{table}" if table in current["tables"] else None
        for name in (table, table + SUFFIX):
            if self._files().exists(self._path(name)):
                return f"{self.folder}/{name}"
        return None

    def read(self, table: str, columns: Iterable[str] | None = None) -> DataFrame:
        """The whole table, or only the named columns."""
        path = self.locate(table)
        if path is None:
            raise FileNotFoundError(f"no table {table} in {self.folder}")
        df = self.spark.read.parquet(path)
        visible = (self._current() or {"tables": {}})["tables"].get(table)
        if columns is None and visible is not None and visible != df.columns:
            columns = [f"`{c}`" for c in visible]
        return df.select(*columns) if columns is not None else df

    def read_optional(self, tables: Iterable[str]) -> dict[str, DataFrame]:
        """The tables that exist; absent ones are left out."""
        return {t: self.read(t) for t in tables if self.locate(t)}

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Replace one table of a layer without versions and return a reader of it.

        Jobs use ``rebuild``; this is for a layer that another program fills table by table.
        """
        if self._current() is not None:
            raise ValueError(f"{self.folder} has versions: write its tables in rebuild()")
        with shuffles_dropped(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/{table}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{table}")

    def delete(self) -> None:
        """Delete the folder with all tables and versions. What was read from it lazily cannot be read any more."""
        delete_folder(self.spark, self.folder)
        self._seen = None

    def views(self) -> None:
        """Expose every table to ``spark.sql`` under its own name."""
        for table in self.tables():
            self.read(table).createOrReplaceTempView(table)


def distinct_values(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*columns).distinct()


def query(spark: SparkSession, text: str, args=None, **frames: DataFrame) -> DataFrame:
    """Run a SELECT; ``{name}`` in the text refers to a frame, ``:name`` to an argument."""
    return spark.sql(text, args=args, **frames)


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per table: name and number of rows."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name, df in frames.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionAll(count)
    return result
