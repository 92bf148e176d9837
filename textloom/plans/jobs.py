"""Whole jobs: files or documents to split, counted and saved chunk tables."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textloom.operators.chunk import CHUNK_COLUMNS, assign_chunk_ids, staged_chunks
from textloom.operators.clean import CleanOptions, clean_batch
from textloom.operators.encode import encode_dataset
from textloom.operators.mix import copy_weight, repeat_copies, with_stem
from textloom.operators.split import split_exact
from textloom.operators.stats import split_source_histogram, split_statistics, split_totals
from textloom.operators.vocabulary import DEFAULT_SPEC, VOCABULARY_SIZE, TokenizerSpec, build_vocabulary, tokenizer_fingerprint
from textloom.sources.datasets import write_dataset, write_splits
from textloom.sources.files import extract_documents, extraction_report, may_match_rtf, scan_files, small_files
from textloom.sources.staging import (
    Scratch, hadoop_path, materialize_stage, read_manifest, read_text, stage, stage_fingerprint, stage_path, write_text,
)


@dataclass(frozen=True)
class CorpusOptions:
    """Defaults as in the default configuration."""

    clean: CleanOptions = CleanOptions()
    file_patterns: Sequence[str] = ("*.rtf", "*.txt")
    encoding: str = "utf-8"
    chunk_size: int = 512
    chunk_overlap: int = 50
    chunk_by: str = "tokens"
    ratios: Sequence[float] = (0.8, 0.1, 0.1)
    seed: int = 42
    output_dir: str | None = "data/processed"
    output_format: str = "jsonl"
    pre_tokenize: bool = False
    max_length: int | None = None
    vocab_size: int = VOCABULARY_SIZE
    cache_dir: str | None = None
    spec: TokenizerSpec = DEFAULT_SPEC
    #: Patterns and weights of a balanced run from files; without them every file counts once.
    sources: Sequence[Mapping[str, Any]] | None = None


@dataclass
class CorpusResult:
    cleaned: DataFrame
    dataset: DataFrame
    statistics: DataFrame | None = None
    totals: DataFrame | None = None
    source_histogram: DataFrame | None = None
    vocabulary: DataFrame | None = None
    saved_paths: dict[str, str] = field(default_factory=dict)
    cache_used: bool = False
    #: One row per scanned file, failed ones included (``prepare_files`` only).
    extraction: DataFrame | None = None
    #: Owner of the staged tables that the frames above read.
    scratch: Scratch | None = None

    def close(self) -> None:
        """Drops the staged tables; what was written to the output folder stays. Also the end of a ``with`` block."""
        if self.scratch is not None:
            self.scratch.drop()

    def __enter__(self) -> CorpusResult:
        return self

    def __exit__(self, *error: object) -> None:
        self.close()

    def split(self, name: str) -> DataFrame:
        return self.dataset.where(F.col("split") == name).drop("split")


def options_from_config(config: Mapping[str, Any]) -> CorpusOptions:
    """Options from a nested dict with the sections input, processing, output, tokenization."""
    given = {
        section: {k: v for k, v in (config.get(section) or {}).items() if v is not None}
        for section in ("input", "processing", "output", "tokenization")
    }
    processing, output, tokens = given["processing"], given["output"], given["tokenization"]
    base = CorpusOptions()
    names = CleanOptions.__dataclass_fields__
    ratios = [output.get(f"{name}_ratio", r) for name, r in zip(("train", "validation", "test"), base.ratios)]
    spec = TokenizerSpec(model_max_length=tokens.get("model_max_length", base.spec.model_max_length))
    return replace(
        base,
        clean=replace(base.clean, **{k: v for k, v in processing.items() if k in names}),
        file_patterns=tuple(given["input"].get("file_patterns", base.file_patterns)),
        encoding=processing.get("encoding", base.encoding),
        chunk_size=processing.get("chunk_size", base.chunk_size),
        chunk_overlap=processing.get("chunk_overlap", base.chunk_overlap),
        ratios=tuple(ratios),
        seed=output.get("random_seed", base.seed),
        output_dir=output.get("output_dir", base.output_dir),
        output_format=output.get("format", base.output_format),
        pre_tokenize=tokens.get("pre_tokenize", base.pre_tokenize),
        max_length=tokens.get("model_max_length"),
        cache_dir=tokens.get("cache_dir") if tokens.get("cache_tokenized", True) else None,
        spec=spec.with_special_tokens(tokens.get("special_tokens")),
        sources=tuple(given["input"].get("sources", ())) if given["input"].get("use_balanced_dataset") else None,
    )


def read_config(path: str) -> dict[str, Any]:
    import yaml

    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle) or {}


def extract_and_clean(raw: DataFrame, options: CorpusOptions = CorpusOptions()) -> DataFrame:
    """Cleaned documents of a file scan."""
    documents = extract_documents(raw, options.encoding, options.clean.handle_encoding_errors)
    return clean_batch(documents, options.clean)


def cleaned_characters(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(
        F.count(F.lit(1)).alias("texts"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("total_chars")
    )


def prepare_corpus(
    documents: DataFrame,
    options: CorpusOptions = CorpusOptions(),
    save: bool = True,
    split: bool = True,
    keys: Sequence[str] = ("source_file",),
) -> CorpusResult:
    """Clean, chunk, optionally encode, split, count and save documents.

    The texts are cleaned and chunked in one pass and the chunks written once. Ids,
    split and statistics come from that table's narrow columns; the texts are read
    again only for the output, where the one join that moves them adds the ids.
    """
    cleaned = clean_batch(documents, options.clean)
    size, overlap = options.chunk_size, options.chunk_overlap
    extra = [] if "source_file" in keys else ["source_file"]
    with Scratch(documents.sparkSession) as scratch:
        rows = staged_chunks(cleaned, size, overlap, options.chunk_by, keys, *extra)
        return _held(_finish(cleaned, rows, options, save, split, keys), scratch)


def _held(result: CorpusResult, scratch: Scratch) -> CorpusResult:
    result.scratch = scratch
    scratch.hold()
    return result


def prepare_balanced_corpus(
    documents: DataFrame,
    entries: Sequence[Mapping[str, Any]],
    options: CorpusOptions = CorpusOptions(),
    save: bool = True,
    split: bool = True,
) -> CorpusResult:
    """The same with weighted copies of the matched documents (``path`` names them).

    Copies are equal, so each document is cleaned and chunked once and its chunks
    are repeated afterwards.
    """
    cleaned = _cleaned_weighted(documents, entries, options)
    size, overlap = options.chunk_size, options.chunk_overlap
    with Scratch(documents.sparkSession) as scratch:
        rows = repeat_copies(staged_chunks(cleaned, size, overlap, options.chunk_by, ("stem",), "weight"))
        return _held(_finish(repeat_copies(cleaned), rows, options, save, split, ("source_file",)), scratch)


def _cleaned_weighted(
    documents: DataFrame, entries: Sequence[Mapping[str, Any]], options: CorpusOptions
) -> DataFrame:
    weighted = with_stem(copy_weight(documents, entries)).select("path", "stem", "weight", "text")
    return clean_batch(weighted, options.clean)


def prepare_files(
    spark: SparkSession, input_dir: str, options: CorpusOptions = CorpusOptions(), **flags: bool
) -> CorpusResult:
    """From a folder of files, as weighted copies where ``options.sources`` says so.

    With ``cache_dir`` set, encoded chunks with their split, and the vocabulary, are kept by fingerprint.
    """
    if options.sources is not None and not options.sources:
        raise ValueError("a balanced dataset needs sources")
    # What the scan stages is read as long as the result's own tables.
    with small_files(spark), Scratch(spark) as scratch:
        result = _prepared(spark, input_dir, options, **flags)
        if result.scratch is not None:
            scratch.folders += result.scratch.folders
        return _held(result, scratch)


def _prepared(spark: SparkSession, input_dir: str, options: CorpusOptions, **flags: bool) -> CorpusResult:
    raw = scan_files(spark, input_dir, options.file_patterns)
    rtf = may_match_rtf(options.file_patterns)
    documents = extract_documents(raw, options.encoding, options.clean.handle_encoding_errors, rtf)
    # The path in the metadata is unique; the bare name may not be, below several folders.
    # Relative to the folder, so that ids and splits do not depend on where it lies.
    fs, root = hadoop_path(spark, input_dir)
    above = fs.makeQualified(root).toString().rstrip("/") + "/"
    full = F.col("metadata.source_file")
    inside = F.when(full.startswith(above), F.substring(full, len(above) + 1, 1 << 30)).otherwise(full)
    documents = documents.withColumn("path", inside)

    def run(save: bool = True, split: bool = True) -> CorpusResult:
        if options.sources is None:
            return prepare_corpus(documents, options, save, split, ("path",))
        return prepare_balanced_corpus(documents, options.sources, options, save, split)

    if options.cache_dir and options.pre_tokenize:
        result = _cached(spark, raw, documents, options, run, **flags)
    else:
        result = run(**flags)
    result.extraction = extraction_report(raw, options.encoding, options.clean.handle_encoding_errors, rtf)
    return result


def _cached(
    spark: SparkSession,
    raw: DataFrame,
    documents: DataFrame,
    options: CorpusOptions,
    run: Callable[..., CorpusResult],
    save: bool = True,
    split: bool = True,
) -> CorpusResult:
    """The result of ``run`` from the tables kept for these files and options, or kept now."""
    parameters = {k: v for k, v in asdict(options).items() if k not in ("output_dir", "output_format")}
    fingerprint = stage_fingerprint(raw.select("path", "length", "modificationTime"), parameters)
    made: list[CorpusResult] = []

    def fresh() -> CorpusResult:
        if not made:
            made.append(run(save=False))
        return made[0]

    # The split is kept with the rows: it is the same as without a cache.
    dataset, used = materialize_stage(
        spark, stage_path(options.cache_dir, "dataset", fingerprint), lambda: fresh().dataset
    )
    vocabulary, _ = materialize_stage(
        spark, stage_path(options.cache_dir, "vocabulary", fingerprint), lambda: fresh().vocabulary
    )
    if options.sources is None:
        cleaned = clean_batch(documents, options.clean)
    else:
        cleaned = repeat_copies(_cleaned_weighted(documents, options.sources, options))
    for result in made:  # what is kept was read from these for the last time
        result.close()
    result = CorpusResult(cleaned, dataset if split else dataset.drop("split"), vocabulary=vocabulary, cache_used=used)
    return _save(_counted(result, dataset) if split else result, options, save, split)


def _finish(
    cleaned: DataFrame, rows: DataFrame, options: CorpusOptions, save: bool, split: bool, keys: Sequence[str]
) -> CorpusResult:
    vocabulary, columns = None, CHUNK_COLUMNS
    if split:
        rows = split_exact(rows, (*keys, "pos"), options.ratios, options.seed)
        columns = [*columns, "split"]
    dataset = assign_chunk_ids(rows, keys).withColumn("processing_timestamp", F.current_timestamp())
    dataset = dataset.select(*columns)
    if options.pre_tokenize:
        vocabulary = stage(build_vocabulary(rows, options.vocab_size, options.spec), "vocabulary")
        dataset = encode_dataset(dataset, vocabulary, spec=options.spec, max_length=options.max_length)
    result = CorpusResult(cleaned, dataset, vocabulary=vocabulary)
    return _save(_counted(result, rows) if split else result, options, save, split)


def _counted(result: CorpusResult, rows: DataFrame) -> CorpusResult:
    """The result with the counts of ``rows``, which have a split."""
    result.statistics, result.totals = split_statistics(rows), split_totals(rows)
    result.source_histogram = split_source_histogram(rows.na.fill("unknown", ["source_file"]))
    return result


JOB = "_job.json"


def _save(result: CorpusResult, options: CorpusOptions, save: bool, split: bool) -> CorpusResult:
    """The tables in the output folder, encoded ones with the vocabulary that reads them, and what the job wrote."""
    if not (save and options.output_dir):
        return result
    spark = result.dataset.sparkSession
    if split:
        result.saved_paths = write_splits(result.dataset, options.output_dir, options.output_format)
    else:
        path = write_dataset(result.dataset, options.output_dir, options.output_format)
        result.saved_paths = {"dataset": path}
    if result.vocabulary is not None:
        path = write_dataset(result.vocabulary, options.output_dir, "parquet", "vocabulary")
        result.saved_paths["vocabulary"] = path
    told = {k: v for k, v in asdict(options).items() if k != "output_dir"}
    digest = hashlib.sha256(json.dumps(told, sort_keys=True, default=str).encode()).hexdigest()[:16]
    rows = {name: read_manifest(spark, path)["rows"] for name, path in result.saved_paths.items()}
    columns = result.dataset.drop("split").schema.jsonValue()
    job = {"options": told, "fingerprint": digest, "rows": rows, "format": options.output_format, "columns": columns}
    if result.vocabulary is not None:
        job["vocabulary"] = tokenizer_fingerprint(spark.read.parquet(path), options.spec).first()["fingerprint"]
    write_text(spark, f"{options.output_dir.rstrip('/')}/{JOB}", json.dumps(job, sort_keys=True, default=str))
    return result


def read_corpus(spark: SparkSession, output_dir: str, spec: TokenizerSpec = DEFAULT_SPEC) -> CorpusResult:
    """What a job wrote to ``output_dir``, read back: the dataset with its split, statistics, the vocabulary.

    An error where a table is missing, has other files than its manifest lists or other rows than the job counted, or
    where the vocabulary is not the one the ids were made with (under ``spec``).
    """
    root = output_dir.rstrip("/")
    text = read_text(spark, f"{root}/{JOB}")
    if text is None:
        raise FileNotFoundError(f"{root} holds no output of a job")
    job = json.loads(text)
    schema, dataset, paths = StructType.fromJson(job["columns"]), None, {}
    for name, rows in job["rows"].items():
        paths[name] = path = f"{root}/{name}.{'parquet' if name == 'vocabulary' else job['format']}"
        known = read_manifest(spark, path)
        if known is None or known["rows"] != rows:
            raise ValueError(f"{path} is not the table of {rows} rows that the job wrote")
        if name != "vocabulary":
            reader = spark.read.schema(schema)
            part = reader.json(path) if job["format"] == "jsonl" else reader.parquet(path)
            part = part if name == "dataset" else part.withColumn("split", F.lit(name))
            dataset = part if dataset is None else dataset.unionByName(part)
    result = CorpusResult(dataset, dataset, saved_paths=paths)
    if "vocabulary" in job:
        result.vocabulary = spark.read.parquet(paths["vocabulary"])
        if tokenizer_fingerprint(result.vocabulary, spec).first()["fingerprint"] != job["vocabulary"]:
            raise ValueError(f"{paths['vocabulary']} is not the vocabulary that the ids were made with")
    countable = "split" in dataset.columns and {"source_file", "text_length", "token_count"} <= set(dataset.columns)
    return _counted(result, dataset) if countable else result
