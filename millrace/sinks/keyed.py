"""Tables by key in buckets of files, changed bucket by bucket, for batches that come one after another."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64
# Versions whose files stay, for readers that began with them.
KEPT_VERSIONS = 3
# Folders of a bucket that are added up before the bucket is written anew.
MOST_FOLDERS = 8

BUCKET = "_bucket"


def bucket_of(key: Column, buckets: Column | int) -> Column:
    return F.pmod(F.xxhash64(key), buckets if isinstance(buckets, Column) else F.lit(buckets)).cast("int")


class SmallFiles:
    """Files of a few bytes below a folder, in whatever store Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _file(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _store(self):
        return self._file("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        return self._store().exists(self._file(name))

    def names(self, folder: str) -> list[str]:
        store, at = self._store(), self._file(folder)
        return sorted(s.getPath().getName() for s in store.listStatus(at)) if store.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._store().open(self._file(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, content: bytes) -> bool:
        """Whole or not at all; False where there is such a file."""
        store, final = self._store(), self._file(name)
        draft = self._file(f"{name}-draft-{uuid.uuid4().hex}")
        out = store.create(draft, True)
        out.write(bytearray(content))
        out.close()
        return not store.exists(final) and store.rename(draft, final)

    def delete(self, name: str) -> None:
        self._store().delete(self._file(name), True)


class BucketedTable:
    """A folder with ``data``, the rows of each write by bucket, and ``manifest``, a small file
    per version that says which folders make up each bucket.

    A write puts its rows into a folder of its own and then names them in the next
    manifest: readers see all of it or nothing. Buckets that it does not touch are not
    read or written. Files that none of the last ``KEPT_VERSIONS`` names are removed. One
    writer at a time; any store that can rename a file will do.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.files = SmallFiles(spark, path)

    # files

    def versions(self) -> list[int]:
        names = (n.removesuffix(".json") for n in self.files.names("manifest") if n.endswith(".json"))
        return [int(n) for n in names]

    def manifest(self, version: int | None = None) -> dict | None:
        """The newest manifest, or that of a version; None where there is no table yet."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        return json.loads(self.files.read(f"manifest/{version:012d}.json"))

    def _publish(self, manifest: dict) -> None:
        version = manifest["version"]
        if not self.files.write(f"manifest/{version:012d}.json", json.dumps(manifest).encode()):
            raise RuntimeError(f"another writer has made version {version} of {self.path}")
        self._forget(version)

    def _forget(self, newest: int) -> None:
        known = self.versions()
        kept = [v for v in known if v > newest - KEPT_VERSIONS]
        live = {folder.split("/")[0] for v in kept for folders in self.manifest(v)["buckets"].values() for folder in folders}
        for v in known:
            if v not in kept:
                self.files.delete(f"manifest/{v:012d}.json")
        for name in self.files.names("data"):
            if name not in live:
                self.files.delete(f"data/{name}")

    # rows

    def create(self, **info) -> dict:
        """The manifest of an empty table; one that exists stays as it is."""
        found = self.manifest()
        if found is None:
            found = {"version": 0, "number_of_buckets": self.buckets, "buckets": {}, **info}
            self._publish(found)
        return found

    def read(self, schema: StructType, buckets: Sequence[int] | None = None, spark: SparkSession | None = None) -> DataFrame:
        """The rows of the newest version, or of some of its buckets."""
        spark = spark or self.spark
        manifest = self.manifest()
        named = manifest["buckets"] if manifest else {}
        wanted = named if buckets is None else [str(b) for b in buckets if str(b) in named]
        paths = [f"{self.path}/data/{folder}" for b in wanted for folder in named[b]]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def _written(self, rows: DataFrame) -> dict[str, list[str]]:
        """Write rows with a column ``BUCKET``; the folders of each bucket that got any."""
        name = uuid.uuid4().hex
        # a bucket with many rows is written by several tasks
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{name}")
        return {n.split("=")[1]: [f"{name}/{n}"] for n in self.files.names(f"data/{name}") if n.startswith(f"{BUCKET}=")}

    def replace(self, rows: DataFrame, buckets: Sequence[int], **info) -> None:
        """Make ``rows``, with their ``BUCKET``, the whole content of these buckets."""
        manifest = self.create(**info)
        new = self._written(rows)
        others = {b: f for b, f in manifest["buckets"].items() if int(b) not in set(buckets)}
        self._publish({**manifest, **info, "version": manifest["version"] + 1, "buckets": others | new})

    def append(self, rows: DataFrame, **info) -> list[int]:
        """Add rows with their ``BUCKET``; returns buckets of so many folders that they are due to be replaced."""
        manifest = self.create(**info)
        new = self._written(rows)
        buckets = {**manifest["buckets"], **{b: [*manifest["buckets"].get(b, []), *f] for b, f in new.items()}}
        self._publish({**manifest, **info, "version": manifest["version"] + 1, "buckets": buckets})
        return [int(b) for b, folders in buckets.items() if len(folders) >= MOST_FOLDERS]
