"""Text files: scan, decode, route by suffix, report, documents."""

from __future__ import annotations

import codecs
import errno
import os
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from itertools import batched

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.rows import where_computed
from textloom.functions.text import normalize_newlines, sanitize_encoding
from textloom.sources.rtf import rtf_to_text
from textloom.sources.staging import hadoop_path, path_exists, stage

RAW_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
ERROR_MODES = ("strict", "replace", "ignore")


def glob_to_regex(pattern: str) -> str:
    """A path glob (``*``, ``?``, ``[...]``, ``**/``) as an anchored regex."""
    out, i = "", 0
    while i < len(pattern):
        char = pattern[i]
        close = pattern.find("]", i + 2) if char == "[" else -1
        if pattern.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif char == "*":
            out, i = out + "[^/]*", i + 1
        elif char == "?":
            out, i = out + "[^/]", i + 1
        elif close > 0:
            body = pattern[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[")
            out, i = out + "[" + ("^" + body[1:] if body[0] == "!" else body) + "]", close + 1
        else:
            out, i = out + ("\\" + char if not char.isalnum() else char), i + 1
    return f"^{out}$"


#: Files and folders that the driver lists and plans itself.
MAX_LISTED = 100_000


def scan_files(spark: SparkSession, folder: str, patterns: Sequence[str] = ("*.rtf",)) -> DataFrame:
    """Files in ``folder`` that match any pattern, each once.

    Plain name patterns become one filter on names with alternatives, so the folder is one path,
    a file that matches several is listed once and no shuffle is needed to remove copies. Patterns that
    reach into subfolders are tested on the listed paths, before a file is opened.
    A missing folder, or one without matches, gives an empty table.

    Spark's reader keeps every file it lists in the driver's memory. Where a folder of a local file system holds more than
    ``MAX_LISTED``, tasks list and read the files, and their names stay in a staged table.
    """
    if not patterns or not path_exists(spark, folder):
        return spark.createDataFrame([], RAW_SCHEMA)
    fs, root = hadoop_path(spark, folder)
    place = fs.makeQualified(root)
    root = place.toString().rstrip("/")
    deep = any("/" in p or "[" in p for p in patterns)
    wanted = "|".join(glob_to_regex(p)[1:-1] for p in patterns)
    inside = f"^{re.escape(re.sub('^[a-z0-9]+:/+', '/', root))}/(?:{wanted})$"
    local = place.toUri().getPath()
    if place.toUri().getScheme() == "file" and _many(local):
        listed = _listed_by_tasks(spark, local)
        # With plain names Spark's reader makes columns of folders such as a=b, and a backslash quotes.
        parted = F.col("length").isNull() & F.substring("path", len(local) + 1, 1 << 30).contains("=")
        if deep or not (any("\\" in p for p in patterns) or listed.where(parted).limit(1).count()):
            return _read_by_tasks(listed.where(F.col("length") > 0), inside)
    reader = spark.read.format("binaryFile")
    escaped = re.sub(r"([\\{}\[\]*?])", r"\\\1", root)  # the folder's own name is no pattern
    if deep:
        # The listing holds encoded paths, in which only a plus sign stands for itself.
        listed = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        return reader.option("recursiveFileLookup", True).load(escaped).where(_bare(listed).rlike(inside))
    parts = [p.replace("{", "\\{").replace("}", "\\}") for p in patterns]
    names = parts[0] if len(parts) == 1 else "{" + ",".join(parts) + "}"
    return reader.option("pathGlobFilter", names).load(escaped)


def _bare(path: Column) -> Column:
    return F.regexp_replace(path, "^[a-z0-9]+:/+", "/")


def _left_out(name: str, folder: bool) -> bool:
    """Whether Spark's reader passes over a file or folder of that name."""
    under = name.startswith("_") and "=" not in name
    if name.startswith(".") or under and not folder:
        return True
    return (under or name.endswith("._COPYING_")) and not name.startswith(("_metadata", "_common_metadata"))


def _is_folder(entry: os.DirEntry) -> bool:
    return os.path.isdir(entry.path) if entry.is_symlink() else entry.is_dir()


def _many(folder: str) -> bool:
    """Whether more than ``MAX_LISTED`` files and folders lie below a local folder; looks at no more of them."""
    seen, below = 0, [folder] if os.path.isdir(folder) else []
    while below:
        with os.scandir(below.pop()) as entries:
            for entry in entries:
                inner = _is_folder(entry)
                if not _left_out(entry.name, inner):
                    seen += 1
                    if inner:
                        below.append(entry.path)
                if seen > MAX_LISTED:
                    return True
    return False


def _listed_by_tasks(spark: SparkSession, folder: str) -> DataFrame:
    """What lies below a local folder, a staged table per level: path, length (null for a folder), change time."""

    def held(folders: list[str]) -> Iterator[tuple[str, int | None, int | None]]:
        for each in folders:
            with os.scandir(each) as entries:
                for entry in entries:
                    inner = _is_folder(entry)
                    if _left_out(entry.name, inner):
                        continue
                    if inner:
                        yield entry.path, None, None
                        continue
                    try:
                        status = entry.stat()
                    except OSError as error:
                        if error.errno in (errno.ENOENT, errno.ELOOP):  # a link to nothing
                            continue
                        raise
                    yield entry.path, status.st_size, status.st_mtime_ns // 1_000_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("changed", pa.int64())])
        for batch in batches:
            for some in batched(held(batch.column(0).to_pylist()), 10_000):
                columns = [pa.array(column, kind) for column, kind in zip(zip(*some), schema.types)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    levels, folders = [], spark.createDataFrame([(folder,)], "path string")
    while True:
        levels.append(stage(folders.mapInArrow(run, "path string, length bigint, changed bigint"), "listing"))
        folders = levels[-1].where("length IS NULL").select("path")
        number = folders.count()
        if not number:
            return reduce(DataFrame.unionByName, levels)
        folders = folders.repartition(min(number, 4 * spark.sparkContext.defaultParallelism))


def _read_by_tasks(listed: DataFrame, inside: str) -> DataFrame:
    """The listed local files whose path matches, with their contents, some thousand to a task."""

    @F.arrow_udf("binary")
    def contents(paths: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for some in paths:
            read, size = [], 0
            for path in some.to_pylist():
                with open(path, "rb") as file:
                    read.append(file.read())
                size += len(read[-1])
                if size > 8 << 20:
                    yield pa.array(read, pa.binary())
                    read, size = [], 0
            yield pa.array(read, pa.binary())

    spark, wanted = listed.sparkSession, listed.where(F.col("path").rlike(inside))
    told = wanted.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    cost = told["bytes"] + told["files"] * int(_SMALL_FILES["spark.sql.files.openCostInBytes"])
    tasks = max(cost // spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() + 1, spark.sparkContext.defaultParallelism)
    return wanted.repartition(tasks).select(
        F.concat(F.lit("file:"), "path").alias("path"),
        F.timestamp_millis("changed").alias("modificationTime"),
        "length",
        contents("path").alias("content"),
    )


# For folders of many small files: some thousand of them to a task instead of 32, and folders listed beside each other.
_SMALL_FILES = {"spark.sql.files.openCostInBytes": "65536", "spark.sql.sources.parallelPartitionDiscovery.threshold": "4"}


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """What is listed and read inside may be very many small files; tasks still hold no more bytes than anywhere."""
    before = {name: spark.conf.get(name) for name in _SMALL_FILES}
    for name, value in _SMALL_FILES.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


# As Spark's own writer names the folder of a null or empty value, and what it escapes in the others.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def folder_name(column: str, value: str | None) -> str:
    """The folder of a partition's value, as Spark's own writer names it."""
    return f"{column}=" + (_ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", value) if value else _NO_VALUE)


def write_text_files(rows: DataFrame, folder: str, by: str, text: str = "text") -> None:
    """A text file for each row, in a folder per value of ``by``; the text and a line end, only the latter for a null.

    For each file that Spark's writer opens on a local file system Hadoop starts a process (``chmod``), and the driver
    renames them one by one at the end. So there the tasks write the files themselves, each under a name of its own, which a
    second attempt of the task gives again. The order of the rows in a partition must be fixed, as in a scan. Other
    stores get Spark's own writer.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col(by).cast("string").alias(by), F.col(text).alias(text))
    fs, root = hadoop_path(spark, folder)
    place = fs.makeQualified(root).toUri()
    if place.getScheme() != "file":
        rows.write.option("maxRecordsPerFile", 1).partitionBy(by).text(folder)
        return
    local = place.getPath()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, made, number = TaskContext.get(), set(), 0
        for batch in batches:
            for value, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                inside = f"{local}/{folder_name(by, value)}"
                if inside not in made:
                    os.makedirs(inside, exist_ok=True)
                    made.add(inside)
                name = f"part-{context.partitionId():05d}-{number:08d}.txt"
                own = f"{inside}/.{name}.{context.taskAttemptId()}"
                with open(own, "wb") as file:
                    file.write((content or b"") + b"\n")
                os.replace(own, f"{inside}/{name}")
                number += 1
        yield pa.RecordBatch.from_pydict({"files": [number]}, pa.schema([("files", pa.int64())]))

    rows.withColumn(text, F.col(text).cast("binary")).mapInArrow(run, "files bigint").agg(F.sum("files")).collect()


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]*$", 0)


def file_suffix(path: Column) -> Column:
    """Lower-cased suffix with its dot; empty for none or for names like ``.txt``."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def is_utf8(encoding: str) -> bool:
    return encoding.lower().replace("_", "-") in ("utf-8", "utf8")


# Codecs in which each byte is a character of its own.
SINGLE_BYTE = ("ascii", "iso8859-1", "iso8859-2", "iso8859-15", "cp437", "cp850", "cp1250", "cp1251", "cp1252", "koi8-r", "mac-roman")


def _decode_single(content: Column, codec: str, errors: str) -> Column:
    """Bytes as latin-1, then each sign that the codec reads otherwise exchanged; all inside the JVM."""
    given, wanted, undefined = [], [], []
    for number in range(256):
        sign = bytes([number]).decode(codec, "ignore")
        if not sign:
            undefined.append(chr(number))
        elif sign != chr(number):
            given.append(chr(number))
            wanted.append(sign)
    text = F.decode(content, "ISO-8859-1")
    lost = "".join(undefined)
    whole = F.translate(text, lost, "") == text if undefined else F.lit(True)
    if errors == "replace":
        given, wanted = given + undefined, wanted + ["\ufffd"] * len(undefined)
    elif errors == "ignore":
        given = given + undefined  # signs without a partner go
    made = F.translate(text, "".join(given), "".join(wanted)) if given else text
    return F.when(whole, made) if errors == "strict" else made


def decode_bytes(content: Column, encoding: str = "utf-8", errors: str = "replace") -> Column:
    r"""Text of ``content``; null where a strict reading fails. Line ends become ``\n``.

    UTF-8 and single-byte encodings are read inside the JVM, others batch by batch in Python.
    """
    if errors not in ERROR_MODES:
        raise ValueError(f"errors must be one of {ERROR_MODES}, got {errors!r}")
    codec = codecs.lookup(encoding).name
    if is_utf8(encoding):
        text = content.cast("string")
        text = F.when(F.is_valid_utf8(text), text) if errors == "strict" else sanitize_encoding(text, errors)
    elif codec in SINGLE_BYTE:
        text = _decode_single(content, codec, errors)
    else:
        text = _python_decode(encoding, errors)(content)
    return normalize_newlines(text)


def _python_decode(encoding: str, errors: str):
    def one(raw: bytes | None) -> str | None:
        try:
            return None if raw is None else raw.decode(encoding, errors)
        except UnicodeDecodeError:
            return None

    @F.arrow_udf("string")
    def decode(contents: pa.Array) -> pa.Array:
        return pa.array([one(raw) for raw in contents.to_pylist()], pa.string())

    return decode


def rtf_texts(source: Column) -> Column:
    """Plain text of RTF markup, a whole batch at a time."""

    @F.arrow_udf("string")
    def parsed(sources: pa.Array) -> pa.Array:
        return pa.array([None if s is None else rtf_to_text(s) for s in sources.to_pylist()], pa.string())

    return parsed(source)


def may_match_rtf(patterns: Sequence[str]) -> bool:
    """Whether a file that one of the patterns lists can be RTF."""
    return not all(re.search(r"\.[A-Za-z0-9]+$", p) and not p.lower().endswith(".rtf") for p in patterns)


def extraction_report(raw: DataFrame, encoding: str = "utf-8", errors: str = "replace", rtf: bool = True) -> DataFrame:
    """One row per file, failures included: text (null if failed) and metadata columns.

    Without ``rtf``, for files none of which is RTF, no row passes a Python operator.
    """
    suffix = file_suffix(F.col("path"))
    unsupported = F.concat(
        F.lit("Unsupported file type: "), F.col("_suffix"), F.lit(". Supported: .rtf, .txt")
    )
    undecodable = F.concat(F.lit("Encoding error reading "), F.col("path"), F.lit(f": not valid {encoding}"))
    # Only .rtf texts travel to Python; the other rows send a null.
    rtf_text = rtf_texts(F.when(F.col("_suffix") == ".rtf", F.col("_decoded"))) if rtf else F.lit(None).cast("string")
    return (
        raw.withColumn("_suffix", suffix)
        .withColumn(
            "_decoded",
            F.when(F.col("_suffix").isin(".txt", ".rtf"), decode_bytes(F.col("content"), encoding, errors)),
        )
        .withColumn("_rtf", rtf_text)
        .withColumn("text", F.when(F.col("_suffix") == ".rtf", F.col("_rtf")).otherwise(F.col("_decoded")))
        .select(
            "text",
            F.col("path").alias("source_file"),
            file_name(F.col("path")).alias("filename"),
            F.col("text").isNotNull().alias("success"),
            F.when(~F.col("_suffix").isin(".txt", ".rtf"), unsupported)
            .when(F.col("text").isNull(), undecodable)
            .alias("error_message"),
            F.col("length").alias("file_size"),
            F.length("text").alias("text_length"),
        )
    )


def extraction_totals(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("files_processed"), F.count_if(F.col("success")).alias("files_successful")
    )


def extract_documents(raw: DataFrame, encoding: str = "utf-8", errors: str = "replace", rtf: bool = True) -> DataFrame:
    """Successful files as documents: text, source_file (bare name), metadata."""
    report = extraction_report(raw, encoding, errors, rtf)
    return (
        where_computed(report, F.col("success"))
        .select(
            "text",
            F.col("filename").alias("source_file"),
            F.struct(
                "source_file", "filename", "success", "error_message", "file_size", "text_length"
            ).alias("metadata"),
        )
    )
