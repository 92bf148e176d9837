"""Files in, tables out and back."""

import os

import pytest
from pyspark.sql import functions as F

from textloom.plans import jobs
from textloom.sources import datasets, files, staging, tables
from textloom.sources.rtf import rtf_to_text

SCHEMA = "chunk_id bigint, text string"


def write(folder, name, content):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as handle:
        handle.write(content if isinstance(content, bytes) else content.encode())


def names(spark, folder, *patterns):
    found = files.scan_files(spark, str(folder), patterns)
    return sorted(os.path.relpath(r["path"].removeprefix("file:"), folder) for r in found.select("path").collect())


def test_scan(spark, tmp_path):
    for name in ("a.txt", "b.rtf", "c.pdf", "sub/d.txt", "sub/deep/e f+%.txt", "g[1].txt"):
        write(tmp_path, name, name)
    assert names(spark, tmp_path, "*.rtf") == ["b.rtf"]
    assert names(spark, tmp_path, "*.rtf", "*.txt", "a*") == ["a.txt", "b.rtf", "g[1].txt"]
    assert names(spark, tmp_path, "sub/*.txt", "s*/d*") == ["sub/d.txt"]
    assert names(spark, tmp_path, "**/*.txt") == ["a.txt", "g[1].txt", "sub/d.txt", "sub/deep/e f+%.txt"]
    assert names(spark, tmp_path, "[!ab]*.txt", "?.pdf") == ["c.pdf", "g[1].txt"]
    assert names(spark, tmp_path, "*.zip") == []
    assert names(spark, tmp_path / "absent", "*") == []


BAD = [b"\xff", b"a\xc3", b"\xc0\xafb", b"\xed\xa0\x80c", b"\xf0\x9f\x98d", b"ok\r\nx\ry\n", "é€".encode(), b""]


@pytest.mark.parametrize("errors", files.ERROR_MODES)
@pytest.mark.parametrize("encoding", ["utf-8", "latin-1", "utf-16", "cp1252", "cp1251", "ascii", "koi8-r", "mac-roman", "iso8859-15"])
def test_decoding_equals_python(spark, encoding, errors):
    def wanted(raw):
        try:
            return raw.decode(encoding, errors).replace("\r\n", "\n").replace("\r", "\n")
        except UnicodeDecodeError:
            return None

    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(BAD)], "i int, content binary")
    got = df.select("i", files.decode_bytes(F.col("content"), encoding, errors).alias("t")).orderBy("i").collect()
    assert [r["t"] for r in got] == [wanted(b) for b in BAD]


def test_report_and_documents(spark, tmp_path):
    write(tmp_path, "a.TXT", "one\r\ntwo")
    write(tmp_path, "b.rtf", r"{\rtf1\ansi caf\'e9\par x}")
    write(tmp_path, "c.pdf", "x")
    write(tmp_path, "d.txt", b"bad \xff")
    write(tmp_path, "noext", "x")
    raw = files.scan_files(spark, str(tmp_path), ["*"])
    report = {r["filename"]: r for r in files.extraction_report(raw, errors="strict").collect()}
    assert report["a.TXT"]["text"] == "one\ntwo" and report["a.TXT"]["file_size"] == 8
    assert report["b.rtf"]["text"] == "café\nx" and report["b.rtf"]["text_length"] == 6
    assert report["c.pdf"]["error_message"] == "Unsupported file type: .pdf. Supported: .rtf, .txt"
    assert report["noext"]["error_message"] == "Unsupported file type: . Supported: .rtf, .txt"
    assert report["d.txt"]["error_message"].startswith("Encoding error reading ")
    assert files.extraction_totals(files.extraction_report(raw, errors="strict")).first() == (5, 2)
    documents = {r["source_file"]: r for r in files.extract_documents(raw).collect()}
    assert set(documents) == {"a.TXT", "b.rtf", "d.txt"}
    assert documents["d.txt"]["text"] == "bad �" and documents["d.txt"]["metadata"]["success"]


@pytest.mark.parametrize(
    "source,wanted",
    [
        (r"{\rtf1 plain}", "plain"),
        (r"{\rtf1{\fonttbl{\f0 Arial;}}{\*\generator W;}{\info{\title T}}\f0\fs24 a\b b\b0  c}", "ab c"),
        (r"{\rtf1 it\u8217?s \u8212?\'80 ok}", "it’s —€ ok"),
        (r"{\rtf1\uc2 x\u233 ab y\uc0 z\u233q}", "xé yzéq"),
        (r"{\rtf1 \u-10179?\u-8703?}", "\U0001f601"),
        (r"{\rtf1\ansicpg932 \'82\'a0}", "あ"),
        (r"{\rtf1 a\tab b\line c\~d\_e\{\}\\}", "a\tb\nc\xa0d‑e{}\\"),
        ("{\\rtf1 two\nlines\\\nbreak}", "twolines\nbreak"),
        (r"{\rtf1 {\header h}body{\pict 0a0b}\emdash}", "body—"),
        ("", ""),
        ("not rtf at all", "not rtf at all"),
    ],
)
def test_rtf(source, wanted):
    assert rtf_to_text(source) == wanted


@pytest.mark.parametrize("fmt", datasets.FORMATS)
def test_splits_round_trip(spark, tmp_path, fmt):
    rows = [(i, None if i == 3 else f"täxt\n{i}", "validation" if i % 3 else "train") for i in range(10)]
    df = spark.createDataFrame(rows, f"{SCHEMA}, split string").repartition(3)
    for _ in range(2):  # the second write replaces the first
        paths = datasets.write_splits(df, str(tmp_path), fmt)
    assert sorted(os.listdir(tmp_path)) == sorted(f"{s}.{fmt}" for s in datasets.SPLITS)
    assert paths["test"] == f"{tmp_path}/test.{fmt}"
    assert sorted(map(tuple, datasets.read_splits(spark, str(tmp_path), SCHEMA).collect())) == sorted(rows)
    assert datasets.read_split(spark, str(tmp_path), "test", SCHEMA).count() == 0
    info = {r["split"]: r for r in datasets.dataset_info(spark, str(tmp_path), SCHEMA).collect()}
    assert {s: r["num_rows"] for s, r in info.items()} == {"train": 4, "validation": 6, "test": 0}
    assert info["train"]["format"] == fmt and info["train"]["size"] > 0


def test_partitioned_splits(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "train"), (2, "b", "test")], f"{SCHEMA}, split string")
    paths = datasets.write_splits(df, str(tmp_path), "parquet", partitioned=True)
    assert paths["train"] == f"{tmp_path}/dataset.parquet/split=train"
    got = datasets.read_splits(spark, str(tmp_path), SCHEMA).select("chunk_id", "text", "split").collect()
    assert sorted(map(tuple, got)) == [(1, "a", "train"), (2, "b", "test")]


def test_reading_rules(spark, tmp_path):
    folder = str(tmp_path)
    write(folder, "train.jsonl", '{"chunk_id": 1, "text": "a"}\n\n  \n{"chunk_id": 2, "text": "b"}\n')
    spark.createDataFrame([(9, "p")], SCHEMA).write.parquet(f"{folder}/train.parquet")
    assert sorted(r["chunk_id"] for r in datasets.read_split(spark, folder, "train", SCHEMA).collect()) == [1, 2]
    assert datasets.find_split(spark, folder, "train") == (f"{folder}/train.jsonl", "jsonl")
    with pytest.raises(FileNotFoundError):
        datasets.read_split(spark, folder, "test", SCHEMA)
    assert datasets.read_splits(spark, folder, SCHEMA, ["train", "test"]).count() == 2
    assert datasets.read_splits(spark, folder, SCHEMA, ["test"]).count() == 0
    with pytest.raises(FileNotFoundError):
        datasets.read_splits(spark, staging.shared_dir(spark) + "/absent", SCHEMA)
    stream = datasets.stream_split(spark, folder, "train", SCHEMA)
    assert stream.isStreaming


def test_writing_rules(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], SCHEMA)
    assert datasets.write_dataset(df, str(tmp_path)) == f"{tmp_path}/dataset.jsonl"
    assert datasets.write_dataset(df, str(tmp_path), "PARQUET", split_name="test") == f"{tmp_path}/test.parquet"
    assert spark.read.text(f"{tmp_path}/dataset.jsonl").first()[0] == '{"chunk_id":1,"text":null}'
    with pytest.raises(ValueError):
        datasets.write_dataset(df, str(tmp_path), "csv")
    with pytest.raises(ValueError):
        datasets.write_dataset(df, None)


def test_stage_cache(spark, tmp_path):
    listing = spark.createDataFrame([("a", 1), ("b", 2)], "path string, length bigint")
    one = staging.stage_fingerprint(listing, {"size": 1})
    assert one == staging.stage_fingerprint(listing.orderBy(F.desc("path")), {"size": 1}) and len(one) == 16
    assert one != staging.stage_fingerprint(listing, {"size": 2})
    path = staging.stage_path(str(tmp_path), "dataset", one, "train")
    assert path.endswith(f"/train_dataset_{one}.parquet")
    assert [staging.materialize_stage(spark, path, lambda: spark.range(3))[1] for _ in range(2)] == [False, True]


def test_texts_are_dealt_on_request_only(spark, tmp_path):
    spark.range(100).selectExpr("id", "cast(id AS string) AS text").coalesce(1).write.parquet(f"{tmp_path}/t")
    plain, dealt = (tables.read_documents(spark, f"{tmp_path}/t", "text", partitions=n) for n in (None, 5))
    assert (plain.rdd.getNumPartitions(), dealt.rdd.getNumPartitions()) == (1, 5)


def test_files_to_splits(spark, tmp_path):
    source, out, cache = (str(tmp_path / n) for n in ("in", "out", "cache"))
    for i in range(12):
        write(source, f"d{i:02d}.txt", f"Text number {i}. " * (5 + i))
    write(source, "skip.pdf", "x")
    write(source, "z.rtf", r"{\rtf1 Last one.}")
    config = {
        "processing": {"chunk_size": 20, "chunk_overlap": 5, "max_text_length": None},
        "output": {"output_dir": out, "format": "parquet", "train_ratio": 0.5, "validation_ratio": 0.25, "test_ratio": 0.25},
        "tokenization": {"pre_tokenize": False, "cache_dir": cache},
    }
    result = jobs.prepare_files(spark, source, jobs.options_from_config(config))
    stats = {r["split"]: r["num_examples"] for r in result.statistics.collect()}
    total = sum(stats.values())
    assert stats["train"] == total // 2 and stats["validation"] == total // 4
    saved = datasets.read_splits(spark, out, "chunk_id bigint, source_file string, text string")
    rows = sorted(saved.collect(), key=lambda r: r["chunk_id"])
    assert [r["chunk_id"] for r in rows] == list(range(total))
    assert [r["source_file"] for r in rows] == sorted(r["source_file"] for r in rows)
    assert rows[-1]["text"] == "Last one."
    assert result.split("train").count() == stats["train"]

    config["tokenization"]["pre_tokenize"] = True
    runs = [jobs.prepare_files(spark, source, jobs.options_from_config(config)) for _ in range(2)]
    assert [r.cache_used for r in runs] == [False, True]
    assert {"input_ids", "attention_mask"} <= set(runs[1].dataset.columns) and "text" not in runs[1].dataset.columns
    assert runs[1].dataset.count() == total
    uncached = {**config, "tokenization": {"pre_tokenize": True}}
    runs.append(jobs.prepare_files(spark, source, jobs.options_from_config(uncached)))
    ids = [sorted((r["chunk_id"], r["split"], tuple(r["input_ids"])) for r in run.dataset.collect()) for run in runs]
    assert ids[0] == ids[1] == ids[2]
    plain = {(r["chunk_id"], r["split"]) for r in rows}
    assert {(i, s) for i, s, _ in ids[0]} == plain
    for run in runs:
        assert run.saved_paths["vocabulary"] == f"{out}/vocabulary.parquet"
        assert {tuple(r) for r in run.vocabulary.collect()} == {
            tuple(r) for r in spark.read.parquet(run.saved_paths["vocabulary"]).collect()
        }
    assert {(r["split"], r["num_examples"]) for r in runs[1].totals.collect()} == {*stats.items(), ("total", total)}
    assert sum(r["num_examples"] for r in runs[1].source_histogram.collect()) == total
    assert {r["success"] for r in runs[1].extraction.collect()} == {True} and runs[1].extraction.count() == 13
    whole = jobs.prepare_files(spark, source, jobs.options_from_config({**config, "tokenization": {}}), split=False)
    assert whole.saved_paths == {"dataset": f"{out}/dataset.parquet"} and whole.statistics is None
    with pytest.raises(ValueError):
        jobs.prepare_files(spark, str(tmp_path / "absent"))


def test_balanced_files(spark, tmp_path):
    source = str(tmp_path / "in")
    for name in ("a.txt", "b.txt", "c.txt"):
        write(source, name, f"The text of {name}.")
    config = {"input": {"use_balanced_dataset": True, "sources": [{"path": "a.txt", "weight": 3}, {"path": "b.*"}]},
              "output": {"output_dir": str(tmp_path / "out")}}
    options = jobs.options_from_config(config)
    names = [r["source_file"] for r in jobs.prepare_files(spark, source, options).dataset.collect()]
    assert sorted(names) == ["a_001.txt", "a_002.txt", "a_003.txt", "b_001.txt"]
    config["tokenization"] = {"pre_tokenize": True, "cache_dir": str(tmp_path / "cache")}
    runs = [jobs.prepare_files(spark, source, jobs.options_from_config(config)) for _ in range(2)]
    assert [run.cache_used for run in runs] == [False, True]
    assert [run.dataset.count() for run in runs] == [run.cleaned.count() for run in runs] == [4, 4]
    config["input"]["use_balanced_dataset"] = False
    assert jobs.options_from_config(config).sources is None
    with pytest.raises(ValueError, match="needs sources"):
        jobs.prepare_files(spark, source, jobs.options_from_config({"input": {"use_balanced_dataset": True}}))


def test_folder_name_is_no_pattern(spark, tmp_path):
    folder = tmp_path / "a[1]{x}"
    folder.mkdir()
    (folder / "b.txt").write_text("one")
    (folder / "c.rtf").write_text("two")
    assert files.scan_files(spark, str(folder), ("*.txt",)).count() == 1
    assert files.scan_files(spark, str(folder), ("*.txt", "*.rtf")).count() == 2


def test_fingerprint_sees_an_edit_of_equal_length(spark):
    rows = [("a", 3, "2024-01-01"), ("a", 3, "2024-01-02")]
    marks = {staging.stage_fingerprint(spark.createDataFrame([r], "path string, length long, modificationTime string"), {}) for r in rows}
    assert len(marks) == 2


def test_scratch_owns_its_tables(spark):
    with staging.Scratch(spark) as outside:
        with staging.Scratch(spark):
            inner = staging.stage(spark.range(5).toDF("n"), "inner").inputFiles()[0]
            kept = staging.stage(spark.range(7).toDF("n"), "kept", outer=True)
            assert staging.path_exists(spark, inner)
        assert not staging.path_exists(spark, inner) and kept.count() == 7
        outside.hold()
    assert kept.count() == 7
    path = kept.inputFiles()[0]
    outside.drop()
    assert not staging.path_exists(spark, path)
    with pytest.raises(ValueError), staging.Scratch(spark) as failed:
        failed.hold()
        path = staging.stage(spark.range(1).toDF("n"), "failed").inputFiles()[0]
        raise ValueError
    assert not staging.path_exists(spark, path)


def test_folders_of_dead_applications(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_dir", lambda _: str(tmp_path))
    other = f"{staging.shared_dir(spark)}/textloom/local-gone"
    staging.write_text(spark, f"{other}/_lease", "")
    staging.write_text(spark, f"{other}/rows-1/part", "x")
    own = staging.new_folder(spark, "own")
    assert "local-gone" not in staging.sweep(spark, 3600)
    assert staging.sweep(spark, -1) == ["local-gone"] and not staging.path_exists(spark, other)
    assert staging.path_exists(spark, own.rsplit("/", 1)[0])


def test_two_writers_leave_one_whole_table(spark, tmp_path):
    path = staging.stage_path(str(tmp_path), "rows", "0" * 16)
    late = lambda: staging.materialize_stage(spark, path, lambda: spark.range(9))[0].limit(2)
    table, used = staging.materialize_stage(spark, path, late)
    assert used and table.count() == 9
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == [path.rsplit("/", 1)[1]]
    # A lost file, a half-written manifest and a build that fails.
    next(p for p in (tmp_path / path.rsplit("/", 1)[1]).glob("part-*")).unlink()
    assert staging.read_manifest(spark, path) is None
    with pytest.raises(ZeroDivisionError):
        staging.materialize_stage(spark, path, lambda: 1 // 0)
    assert staging.materialize_stage(spark, path, lambda: spark.range(4))[0].count() == 4
    staging.write_text(spark, f"{path}/{staging.MANIFEST}", "{")
    assert staging.materialize_stage(spark, path, lambda: spark.range(3))[0].count() == 3
    # What a dead writer left goes with its lease.
    left = f"{tmp_path}/_{path.rsplit('/', 1)[1]}.dead"
    staging.write_text(spark, f"{left}/part-0", "x")
    staging.write_text(spark, f"{path}/{staging.MANIFEST}", "{")
    staging.materialize_stage(spark, path, lambda: spark.range(3), lease_seconds=-1)
    assert not staging.path_exists(spark, left)


def test_every_byte_of_single_byte_encodings(spark):
    df = spark.createDataFrame([(bytearray(range(256)), bytearray(b"a"))], "every binary, plain binary")
    for codec in files.SINGLE_BYTE:
        got = df.select(
            *[files.decode_bytes(F.col("every"), codec, e).alias(e) for e in files.ERROR_MODES],
            files.decode_bytes(F.col("plain"), codec, "strict").alias("plain"),
        )
        assert "Arrow" not in got._jdf.queryExecution().executedPlan().toString()
        row, every = got.first(), bytes(range(256))
        try:
            strict = every.decode(codec).replace("\r", "\n")
        except UnicodeDecodeError:
            strict = None
        assert row["strict"] == strict and row["plain"] == "a", codec
        assert row["replace"] == every.decode(codec, "replace").replace("\r", "\n"), codec
        assert row["ignore"] == every.decode(codec, "ignore").replace("\r", "\n"), codec


def test_text_files_pass_no_python(spark, tmp_path):
    write(tmp_path, "a.txt", "one")
    write(tmp_path, "b.rtf", r"{\rtf1 two}")
    raw = files.scan_files(spark, str(tmp_path), ["*.txt"])
    assert [files.may_match_rtf(p) for p in (["*.txt"], ["*.txt", "*.RTF"], ["*"], ["a*/*.text", "x.txt"], ["*.*"])] == [
        False, True, True, False, True,
    ]
    plain = files.extract_documents(raw, rtf=False)
    assert "Arrow" not in plain._jdf.queryExecution().executedPlan().toString()
    assert [r["text"] for r in plain.collect()] == ["one"]


def test_output_is_checked_when_it_is_read(spark, tmp_path):
    for i in range(30):
        write(tmp_path / "in", f"{i}.txt", f"Text number {i}. It has some words.\n")
    out = str(tmp_path / "out")
    options = jobs.CorpusOptions(file_patterns=("*.txt",), output_dir=out, pre_tokenize=True, chunk_size=5, chunk_overlap=1)
    with jobs.prepare_files(spark, str(tmp_path / "in"), options) as result:
        wanted = result.dataset.drop("processing_timestamp").collect()
        tables = list(result.scratch.folders)
        assert tables and all(staging.path_exists(spark, t) for t in tables)
    assert not any(staging.path_exists(spark, t) for t in tables)
    back = jobs.read_corpus(spark, out)
    assert sorted(map(str, back.dataset.drop("processing_timestamp").select(*wanted[0].asDict()).collect())) == sorted(map(str, wanted))
    assert back.vocabulary.count() > 5
    with pytest.raises(FileNotFoundError):
        jobs.read_corpus(spark, str(tmp_path / "in"))
    with pytest.raises(ValueError, match="vocabulary"):
        jobs.read_corpus(spark, out, options.spec.with_special_tokens({"pad_token": "<pad>"}))
    info = {r["split"]: r["num_rows"] for r in datasets.dataset_info(spark, out).collect()}
    assert sum(info.values()) == len(wanted)
    damaged = next(p for p in (tmp_path / "out" / "train.jsonl").glob("part-*"))
    damaged.with_name(f".{damaged.name}.crc").unlink()
    damaged.write_text("{}\n")
    with pytest.raises(ValueError, match="train"):
        jobs.read_corpus(spark, out)
    assert datasets.dataset_info(spark, out).count() == 3  # counted, as the manifest no longer holds


def test_rows_are_counted_while_written(spark, tmp_path):
    rows = spark.createDataFrame([(i, "train" if i < 5 else "test") for i in range(7)], "n int, split string")
    for partitioned in (False, True):
        for fmt in datasets.FORMATS:
            folder = str(tmp_path / f"{fmt}{partitioned}")
            paths = datasets.write_splits(rows, folder, fmt, partitioned)
            assert staging.read_manifest(spark, paths["train"])["rows"] == 5
            assert {r["split"]: r["num_rows"] for r in datasets.dataset_info(spark, folder).collect()}["test"] == 2
    empty = datasets.write_dataset(rows.where("n > 9"), str(tmp_path / "none"), "parquet")
    assert staging.read_manifest(spark, empty)["rows"] == 0
    assert datasets.read_splits(spark, str(tmp_path / "jsonlFalse"), "n int", []).count() == 0


def test_text_files_as_sparks_writer_has_them(spark, tmp_path):
    rows = [("a", "one"), ("a", ""), ("a", None), (None, "two\nlines"), ("", "é"), ("x=1/%:[y]^{\"#'*?\\", "three"), ("b c+~", "one")] * 3
    df = spark.createDataFrame(rows, "source string, text string").repartition(3)
    df.write.option("maxRecordsPerFile", 1).partitionBy("source").text(str(tmp_path / "theirs"))
    files.write_text_files(df, str(tmp_path / "ours"), "source")

    def held(folder):
        return sorted((path.parent.name, path.read_bytes()) for path in folder.rglob("*.txt") if path.name[0] != ".")

    assert held(tmp_path / "ours") == held(tmp_path / "theirs")
    assert len(held(tmp_path / "ours")) == len(rows)
    found = files.scan_files(spark, str(tmp_path / "ours"), ["source=*/*.txt"])
    assert sorted(bytes(r.content) for r in found.collect()) == sorted(content for _, content in held(tmp_path / "ours"))
    assert not list((tmp_path / "ours").rglob(".*"))


def test_many_small_files_are_few_tasks(spark, tmp_path):
    for i in range(600):
        write(tmp_path, f"in/{i % 8}/{i}.txt", f"The text number {i}.")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    options = jobs.options_from_config({"input": {"file_patterns": ["*/*.txt"]}, "output": {"output_dir": str(tmp_path / "out")}})
    with jobs.prepare_files(spark, str(tmp_path / "in"), options) as result:
        chunks = next(f for f in result.scratch.folders if "/chunks-" in f)
        assert len(os.listdir(chunks.removeprefix("file:"))) < 30  # 19 tables and as many checksums where a task held 32 files
        assert result.dataset.count() == 600
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def many_names(folder):
    for name in ("a.txt", "b.rtf", "_x.txt", "_y=1.txt", ".h.txt", "e.txt._COPYING_", "_metadata", "_metadata=3.txt", "_d/f.txt", ".e/h.txt",
                 "_metadata2/i.txt", "sub/j+ %41é.txt", "sub/deep/k.txt", "l\nm.txt", "g[1].txt", "c.txt/z.txt"):
        write(folder, name, name)
    write(folder, "big.txt", "x" * 9_000_000)
    write(folder, "empty.txt", "")
    (folder / "link.txt").symlink_to(folder / "a.txt")
    (folder / "gone.txt").symlink_to(folder / "nothing")
    (folder / "other").symlink_to(folder / "sub")


@pytest.mark.parametrize(
    "patterns", [["**/*"], ["*/*", "*.txt"], ["*.txt", "*.rtf"], ["*", "a.txt"], ["[!ab]*"], ["no/*"]]
)
def test_tasks_read_what_sparks_reader_reads(spark, tmp_path, monkeypatch, patterns):
    folder = tmp_path / "in a+%"
    many_names(folder)
    if any("/" in p or "[" in p for p in patterns):
        write(folder, "_d=1/g.txt", "one")

    def rows():
        found = files.scan_files(spark, str(folder), patterns)
        return found.dtypes, sorted((r.path, r.modificationTime, r.length, bytes(r.content)) for r in found.collect())

    theirs = rows()
    monkeypatch.setattr(files, "MAX_LISTED", 3, raising=False)
    assert rows() == theirs


def test_driver_does_not_hold_many_files(spark, tmp_path, monkeypatch):
    for i in range(300):
        write(tmp_path, f"in/s={i % 5}/{i}.txt", f"The text number {i}.")
    monkeypatch.setattr(files, "MAX_LISTED", 100, raising=False)
    raw = files.scan_files(spark, str(tmp_path / "in"), ["s=*/*.txt"])
    assert raw.count() == 300 and len(raw.inputFiles()) < 50
    # With plain names Spark's reader makes a column of s=0 and its like; that stays.
    assert files.scan_files(spark, str(tmp_path / "in"), ["*.txt"]).where("s < 2").count() == 120


@pytest.mark.parametrize("sources", [None, [{"path": "s=1/*", "weight": 2}]])
def test_jobs_of_many_files(spark, tmp_path, monkeypatch, sources):
    for i in range(60):
        write(tmp_path, f"in/s={i % 3}/{i}.txt", f"The text number {i}.")
    given = {"file_patterns": ["s=*/*.txt"], "use_balanced_dataset": sources is not None, "sources": sources or []}

    def run(name, **tokens):
        options = jobs.options_from_config({"input": given, "output": {"output_dir": str(tmp_path / name)}, "tokenization": tokens})
        with jobs.prepare_files(spark, str(tmp_path / "in"), options) as result:
            tables = list(result.scratch.folders)
            assert result.extraction.count() == 60 and result.cleaned.count() == (60 if sources is None else 40)
        assert not any(staging.path_exists(spark, t) for t in tables)
        rows = jobs.read_corpus(spark, str(tmp_path / name)).dataset.drop("processing_timestamp").collect()
        return sorted(map(str, rows)), [t for t in tables if "/listing-" in t], result.cache_used

    plain = run("plain")
    monkeypatch.setattr(files, "MAX_LISTED", 20, raising=False)
    many = run("many")
    assert many[0] == plain[0] and plain[1] == [] and len(many[1]) == 2
    cached = [run("cached", pre_tokenize=True, cache_dir=str(tmp_path / "cache")) for _ in range(2)]
    assert [c[2] for c in cached] == [False, True] and cached[0][0] == cached[1][0]
