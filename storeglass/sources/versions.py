"""Tables whose readers never see half a write: immutable data folders and one list of them per version.

    path/data/version=<n>_<token>/<partition folders>/...   written once, never changed
    path/manifest/<n>.json                                   which folder holds each partition in version n

A write puts its files into a folder of its own, then its list of folders into a temporary file, and renames that to the
next number. The rename is the commit: before it, readers see the version before; a writer that dies leaves files
nobody refers to. It fails if the number is taken, so of two writers one has to begin again. Needed is a file system whose
rename is atomic and does not replace (HDFS, a local or network disk); on an object store use its own table format.
Readers take one list at the start and keep reading the same files, until `vacuum` removes versions that old.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_NULL = "__HIVE_DEFAULT_PARTITION__"


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Latest row per key. A maximum combines map-side, so a key with very many versions does not end up in one sort."""
    rest = [c for c in df.columns if c not in keys]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return latest.select(*keys, "_row.*").select(*df.columns)


class CommitConflict(RuntimeError):
    """Another writer committed the version first."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- files -------------------------------------------------------------------------------------------------------

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        return self._at("data").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        files, place = self._files(), self._at(folder)
        return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []

    def versions(self) -> list[int]:
        return sorted(int(name.removesuffix(".json")) for name in self._names("manifest") if name[0].isdigit())

    def manifest(self, version: int | None = None) -> dict | None:
        """The list of a version (the newest one if none is named); None for a table that isn't there."""
        found = self.versions() if version is None else [version]
        if not found:
            return None
        stream = self._files().open(self._at(f"manifest/{found[-1]}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> int:
        files, temporary = self._files(), self._at(f"manifest/.{uuid.uuid4().hex}")
        files.mkdirs(temporary.getParent())
        stream = files.create(temporary, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        target = self._at(f"manifest/{manifest['version']}.json")
        if files.exists(target) or not files.rename(temporary, target):
            files.delete(temporary, False)
            raise CommitConflict(f"version {manifest['version']} of {self.path} is taken")
        return manifest["version"]

    # --- reading -----------------------------------------------------------------------------------------------------

    def read(self, version: int | None = None, where: dict[str, Iterable] | None = None) -> DataFrame | None:
        """The rows of a version. `where` names partition values; folders of other values are not even listed."""
        manifest = self.manifest(version)
        return None if manifest is None else self._frame(manifest, self._chosen(manifest, where or {}))

    def _chosen(self, manifest: dict, where: dict[str, Iterable]) -> list[str]:
        wanted = [(manifest["partitions"].index(name), {_text(v) for v in values}) for name, values in where.items()]
        return [f"{e['folder']}/{key}".rstrip("/") for key, e in manifest["entries"].items()
                if all(e["values"][k] in values for k, values in wanted)]

    def _frame(self, manifest: dict, folders: list[str]) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self._relation(schema, folders).select(*schema.names)

    def _relation(self, schema: StructType, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(
            *(f"{self.path}/data/{folder}" for folder in folders))

    def file_ranges(self, columns: list[str], version: int) -> DataFrame:
        """file, rows, low and high (structs of these columns, in their order) of every file of a version."""
        manifest = self.manifest(version)
        key = F.struct(*columns)
        return self._relation(StructType.fromJson(manifest["schema"]), self._chosen(manifest, {})).groupBy(
            F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"))

    # --- writing -----------------------------------------------------------------------------------------------------

    def _write(self, df: DataFrame, partitions: list[str], kept: Callable[[dict], bool], before: dict | None) -> int:
        """Commits `df` together with the entries of the version before that are `kept`."""
        version = max(self.versions(), default=0) + 1
        folder = f"version={version}_{uuid.uuid4().hex[:8]}"
        df.write.partitionBy(*partitions).parquet(f"{self.path}/data/{folder}")
        entries = {key: e for key, e in before["entries"].items() if kept(e)} if before else {}
        for key in self._leaves(folder, len(partitions)):
            values = [self._plain(part.partition("=")[2]) for part in key.split("/")] if key else []
            entries[key] = {"folder": folder, "values": values}
        columns = [name for name in df.columns if name not in partitions] + partitions
        return self._commit({"version": version, "partitions": partitions, "entries": entries,
                             "schema": df.select(*columns).schema.jsonValue()})

    def _leaves(self, folder: str, depth: int) -> list[str]:
        """Partition folders of one write, relative to its folder."""
        found = [""]
        for _ in range(depth):
            found = [f"{key}/{name}".lstrip("/") for key in found for name in self._names(f"data/{folder}/{key}") if "=" in name]
        return found

    def _plain(self, value: str) -> str | None:
        plain = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(value)
        return None if plain == _NULL else plain

    def replace(self, df: DataFrame, partitions: list[str] | None = None) -> int:
        """A version with these rows only. Returns its number."""
        return self._write(df, partitions or [], lambda e: False, self.manifest())

    def replace_partitions(
        self, df: DataFrame, partitions: list[str], scope: int, touched: Iterable[tuple], base: int | None = None
    ) -> int:
        """A version in which all partitions whose first `scope` values are `touched` hold these rows only, and all
        others what they hold in version `base` (the newest one if none is named)."""
        gone = {tuple(map(_text, values)) for values in touched}
        return self._write(df, partitions, lambda e: tuple(e["values"][:scope]) not in gone, self.manifest(base))

    def upsert(self, df: DataFrame, keys: list[str], order_col: str, partitions: list[str], base: int | None = None,
               keep: Column | None = None, unique: bool = False, together: list[str] | None = None) -> int | None:
        """Per key the row with the highest `order_col` stays, a new one on equality; a key lives in one partition.

        Only partitions that get rows are read and written anew (their values come to the driver, one row per folder
        to be written). What is read can't be overwritten, so nothing needs a checkpoint. None if there are no rows.
        `base` is the version to build on, the newest one if none is named; rows that aren't to be kept (`keep`) are left
        out of what is written. `unique` rows, one per key, are written as they are where no row was before.
        Rows alike in `together`, some of the keys, are merged and written by one task: a partition then has no more
        files than it has of these.
        """
        touched = {tuple(row) for row in df.select(*(F.col(p).cast("string") for p in partitions)).distinct().collect()}
        if not touched:
            return None
        before, marked = self.manifest(base), df.withColumn("_new", F.lit(1))
        if before:
            old = [f"{e['folder']}/{key}" for key, e in before["entries"].items() if tuple(e["values"]) in touched]
            if old:
                unique = False
                marked = self._frame(before, old).select(*df.columns).withColumn("_new", F.lit(0)).unionByName(marked)
        if together and not unique:
            marked = marked.repartition(*together)
        merged = df if unique else keep_last(marked, keys, [F.col(order_col), F.col("_new")]).drop("_new")
        if keep is not None:
            merged = merged.filter(keep)
        return self._write(merged, partitions, lambda e: tuple(e["values"]) not in touched, before)

    def vacuum(self, keep: int = 2, named: Iterable[int] | None = None) -> None:
        """Removes all versions but the last `keep`, or but the `named` ones, and folders that none of those uses
        (unfinished writes included: not to be run while another writer is at work)."""
        kept, files = self.versions()[-keep:] if named is None else sorted(named), self._files()
        used = {e["folder"] for version in kept for e in self.manifest(version)["entries"].values()}
        for name in self._names("manifest"):
            if name.startswith(".") or int(name.removesuffix(".json")) not in kept:
                files.delete(self._at(f"manifest/{name}"), False)
        for name in self._names("data"):
            if name not in used:
                files.delete(self._at(f"data/{name}"), True)


def _text(value) -> str | None:
    return None if value is None else str(value)
