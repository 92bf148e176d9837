"""Tables written to the cluster's shared folder, to cut lineage or keep a stage."""

from __future__ import annotations

import hashlib
import json
import logging
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

logger = logging.getLogger(__name__)


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a local one only on a local master."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def _own_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/textloom/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the application's folder, whose lease it renews."""
    root = _own_root(spark)
    fs, lease = hadoop_path(spark, f"{root}/_lease")
    fs.create(lease, True).close()
    return f"{root}/{name}-{uuid.uuid4().hex}"


def drop_all(spark: SparkSession) -> None:
    """Removes every folder of this application; nothing that reads them may run any more."""
    drop_folder(spark, _own_root(spark))


def sweep(spark: SparkSession, idle_seconds: float = 7 * 86400) -> list[str]:
    """Removes the folders of other applications that have made none for so long, and returns their names."""
    fs, root = hadoop_path(spark, f"{shared_dir(spark)}/textloom")
    gone = []
    for entry in fs.listStatus(root) if fs.exists(root) else []:
        folder = entry.getPath()
        lease = hadoop_path(spark, f"{folder.toString()}/_lease")[1]
        if folder.getName() == spark.sparkContext.applicationId:
            continue
        seen = fs.getFileStatus(lease) if fs.exists(lease) else entry
        if time.time() - seen.getModificationTime() / 1000 > idle_seconds:
            fs.delete(folder, True)
            gone.append(folder.getName())
    return gone


def hadoop_path(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """(file system, path) of the session's own storage layer."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when a write inside ends: what follows reads the written table, never the shuffle."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


class Scratch:
    """Owner of the tables staged inside its ``with`` block.

    They go when the block ends, or, after ``hold()``, when ``drop()`` says that their last reader is done. A block
    that ends with an error drops them in any case. What is staged for the block outside (``stage(..., outer=True)``)
    belongs to that block.
    """

    _open: ContextVar[tuple[Scratch, ...]] = ContextVar("scratch", default=())

    def __init__(self, spark: SparkSession):
        self.spark, self.folders, self.held = spark, [], False

    def __enter__(self) -> Scratch:
        self._token = self._open.set((*self._open.get(), self))
        return self

    def __exit__(self, kind, error, trace) -> None:
        self._open.reset(self._token)
        if kind is not None or not self.held:
            self.drop()

    def hold(self) -> None:
        self.held = True

    def drop(self) -> None:
        while self.folders:
            drop_folder(self.spark, self.folders.pop())


def stage(df: DataFrame, name: str, outer: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Unlike a cached frame it outlives lost executors, and unlike a checkpoint it
    is columnar, so later passes read only the columns they use. The innermost ``Scratch`` block, or with
    ``outer`` the one around it, owns the table; without one it stays until ``drop_all`` or ``sweep``.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    owners = Scratch._open.get()[: -1 if outer else None]
    if owners:
        owners[-1].folders.append(path)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_fingerprint(inputs: DataFrame, parameters: dict[str, Any]) -> str:
    """16 hex digits over the input files' paths, lengths and change times, and all parameters.

    ``inputs`` has ``path``, ``length`` and, where files can change in place, ``modificationTime``:
    without it an edit of equal length is not seen. The sums below do not depend on row order.
    """
    parts = ["path", "length", *(["modificationTime"] if "modificationTime" in inputs.columns else [])]
    digest = inputs.selectExpr(f"md5(concat_ws(':', {', '.join(f'cast({p} AS string)' for p in parts)})) AS h").selectExpr(
        "count(*) AS files",
        "sum(cast(conv(substr(h, 1, 8), 16, 10) AS bigint)) AS low",
        "sum(cast(conv(substr(h, 9, 8), 16, 10) AS bigint)) AS high",
    ).first()
    text = json.dumps({"inputs": list(digest), "parameters": parameters}, sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def stage_path(folder: str, dataset: str, fingerprint: str, split: str | None = None) -> str:
    prefix = f"{split}_" if split else ""
    return f"{folder.rstrip('/')}/{prefix}{dataset}_{fingerprint}.parquet"


MANIFEST = "_manifest.json"


def listed_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Length of each data file below a folder, by name."""
    fs, root = hadoop_path(spark, path)
    files, out = fs.listFiles(root, True), {}
    base = len(fs.makeQualified(root).toString()) + 1
    while files.hasNext():
        file = files.next()
        name = file.getPath().toString()[base:]
        if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            out[name] = file.getLen()
    return out


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = hadoop_path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_manifest(spark: SparkSession, path: str, **facts: Any) -> None:
    """What a reader checks before it trusts a table: its files with their lengths, who wrote them, and ``facts``."""
    known = {"owner": spark.sparkContext.applicationId, "files": listed_files(spark, path), **facts}
    write_text(spark, f"{path}/{MANIFEST}", json.dumps(known, sort_keys=True))


def read_manifest(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """The manifest of a table whose files are all there, whole; otherwise none."""
    text = read_text(spark, f"{path}/{MANIFEST}")
    try:
        known = json.loads(text) if text else None
    except ValueError:
        return None
    return known if known and known.get("files") == listed_files(spark, path) else None


def _renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Whether ``source`` took the name ``target``; in one step, and never where there is something already."""
    _, a = hadoop_path(spark, source)
    fs, b = hadoop_path(spark, target)
    a, b = fs.makeQualified(a), fs.makeQualified(b)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(a, b, plain)
    except Py4JJavaError:
        if not fs.exists(b):
            raise
        return False
    return True


def materialize_stage(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], lease_seconds: float = 86400
) -> tuple[DataFrame, bool]:
    """(table at ``path``, whether it was there already); built and written when absent or broken.

    A writer builds beside ``path`` in a folder of its own and publishes it, manifest and all, by one rename. Of several
    writers the first to finish publishes; the others drop theirs and read that one. A table with missing or shortened
    files does not agree with its manifest and is built again. What writers left that have died is dropped once it is older
    than ``lease_seconds``.
    """
    if read_manifest(spark, path) is not None:
        return spark.read.parquet(path), True
    folder, name = path.rstrip("/").rsplit("/", 1)
    _drop_leftovers(spark, folder, f"_{name}.", lease_seconds)
    own = f"{folder}/_{name}.{uuid.uuid4().hex}"
    try:
        with shuffles_freed(spark):
            build().write.parquet(own)
        write_manifest(spark, own)
        for _ in range(3):
            if _renamed(spark, own, path):
                return spark.read.parquet(path), False
            if read_manifest(spark, path) is not None:
                return spark.read.parquet(path), True
            logger.warning("%s does not agree with its manifest and is replaced", path)
            drop_folder(spark, path)
        raise OSError(f"could not publish {path}")
    finally:
        drop_folder(spark, own)  # gone already where it was published


def _drop_leftovers(spark: SparkSession, folder: str, prefix: str, lease_seconds: float) -> None:
    fs, root = hadoop_path(spark, folder)
    for entry in fs.listStatus(root) if fs.exists(root) else []:
        old = time.time() - entry.getModificationTime() / 1000 > lease_seconds
        if old and entry.getPath().getName().startswith(prefix):
            fs.delete(entry.getPath(), True)
