"""Token ids in binary files with a minimal perfect hash index.

A file holds one block, little-endian: a header of eight 64-bit numbers (magic, partition, block, documents,
documents without a key, keys, buckets, bytes an id), then

    pilots        int32 a bucket    which hash sends the bucket's keys to free slots; -1 - slot for a bucket of one
    fingerprints  uint32 a slot     of the slot's key, so that an absent key is known
    entries       uint32 a slot     the key's first document in the tables below
    keys          int64 a document  ascending; documents without a key come first and count as 0
    places        uint64 a document and one more: where its ids start
    ids           uint16 or uint32

A key's document is found with two hashes and one comparison, whatever the block's size. Blocks are
partitioned by ranges of the key, so their order is the documents' order. Spark's own
writer and reader move the bytes: any store that Spark knows will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.tables import Workspace, texts_of
from textloom.llm.tokens import Encoder, byte_pieces, text_slices
from textloom.llm.words import U64, mix

MAGIC = 0x31584449_4E454B54
END_ID = 0
#: Ids in a block, unless one document has more.
BLOCK_IDS = 1 << 22
_PER_BUCKET = 4
_HEADER = 8


def _hashes(keys: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.int64).view(U64) ^ U64(0x5851F42D4C957F2D))


def _slots(hashes: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    return (mix(hashes ^ mix(pilots.astype(U64) + U64(1))) % U64(n)).astype(np.int64)


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``pilots, slot of each key`` for distinct keys; every slot from 0 to ``len(keys) - 1`` is used once."""
    n = len(keys)
    buckets = -(-n // _PER_BUCKET)
    pilots, slots = np.zeros(buckets, np.int32), np.zeros(n, np.int64)
    if n == 0:
        return pilots, slots
    hashes = _hashes(keys)
    bucket = (hashes % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=buckets)
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    free = np.ones(n, bool)
    by_size = np.argsort(-sizes, kind="stable")
    for b in by_size[: int((sizes > 1).sum())].tolist():
        own = order[firsts[b] : firsts[b + 1]]
        pilot = 0
        while True:
            tried = np.arange(pilot, pilot + 64)
            places = _slots(hashes[own][None, :], tried[:, None], n)
            ranked = np.sort(places, axis=1)
            good = free[places].all(axis=1) & (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if good.any():
                pick = int(good.argmax())
                pilots[b], slots[own] = pilot + pick, places[pick]
                free[places[pick]] = False
                break
            pilot += 64
    single = np.flatnonzero(sizes == 1)
    rest = np.flatnonzero(free)
    pilots[single] = -1 - rest
    slots[order[firsts[single]]] = rest
    return pilots, slots


class Block:
    """One block in memory."""

    def __init__(self, data: bytes):
        head = np.frombuffer(data, "<i8", _HEADER)
        if len(head) < _HEADER or head[0] != MAGIC:
            raise ValueError("not a token block")
        _, self.partition, self.block, self.documents, self.unkeyed, n_keys, buckets, width = head.tolist()
        at = _HEADER * 8

        def next_array(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.pilots = next_array("<i4", buckets)
        self.fingerprints = next_array("<u4", n_keys)
        self.entries = next_array("<u4", n_keys)
        self.keys = next_array("<i8", self.documents)
        self.places = next_array("<u8", self.documents + 1).astype(np.int64)
        self.ids = next_array("<u2" if width == 2 else "<u4", int(self.places[-1]))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key's first document, -1 where the block has no such key."""
        if len(self.pilots) == 0:
            return np.full(len(keys), -1, np.int64)
        hashes = _hashes(keys)
        pilots = self.pilots[(hashes % U64(len(self.pilots))).astype(np.int64)].astype(np.int64)
        slots = np.where(pilots < 0, -1 - pilots, _slots(hashes, np.maximum(pilots, 0), len(self.entries)))
        same = self.fingerprints[slots] == (hashes >> U64(32)).astype(np.uint32)
        found = self.entries[slots].astype(np.int64)
        return np.where(same & (self.keys[found] == keys), found, -1)

    def of(self, document: int) -> np.ndarray:
        """A document's ids."""
        return self.ids[self.places[document] : self.places[document + 1]]


def block_bytes(partition: int, block: int, keys: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    """The block of documents in key order, those without a key first."""
    unkeyed = sum(key is None for key in keys)
    known = np.array([0 if key is None else key for key in keys], np.int64)
    distinct, first = np.unique(known[unkeyed:], return_index=True)
    pilots, slots = build_index(distinct)
    fingerprints, entries = np.zeros(len(distinct), np.uint32), np.zeros(len(distinct), np.uint32)
    fingerprints[slots] = (_hashes(distinct) >> U64(32)).astype(np.uint32)
    entries[slots] = first + unkeyed
    places = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    head = [MAGIC, partition, block, len(keys), unkeyed, len(distinct), len(pilots), width]
    payload = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    arrays = ((head, "<i8"), (pilots, "<i4"), (fingerprints, "<u4"), (entries, "<u4"), (known, "<i8"), (places, "<u8"))
    parts = [np.asarray(values).astype(kind).tobytes() for values, kind in arrays]
    return b"".join([*parts, payload.astype("<u2" if width == 2 else "<u4").tobytes()])


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text",
    end_id: int = END_ID, block_ids: int = BLOCK_IDS,
) -> None:
    """The documents' ids as files in ``folder/blocks``, in ascending key order, nulls first, ties by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer, byte_pieces)
        width = 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        partition, block = TaskContext.get().partitionId(), 0
        keys: list = []
        ids: list = []
        held = 0

        def flush() -> pa.RecordBatch:
            data = block_bytes(partition, block, keys, ids, width)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["block"])

        for batch in batches:
            for part in text_slices(batch):
                encoded = encoder.encode(part.column("text"), end_id)
                for doc_id, own in zip(part.column("doc_id").to_pylist(), encoded, strict=True):
                    if keys and held + len(own) > block_ids:
                        yield flush()
                        keys, ids, held, block = [], [], 0, block + 1
                    keys.append(doc_id)
                    ids.append(own.astype(np.uint16) if width == 2 else own)
                    held += len(own)
        if keys:
            yield flush()

    ordered = texts_of(docs, key, text).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    blocks = ordered.mapInArrow(run, "block binary").select(F.col("block").cast("string"))
    # The text writer hands a row's bytes on as they are; one row a file.
    blocks.write.option("maxRecordsPerFile", 1).text(f"{folder}/blocks")


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/blocks").select("path", "content")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as the files give it: ``partition, block, doc_id, place, n_tokens, ids_crc32, ids``.

    Documents with a key are found through the index, as a reader of single documents would.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                own = Block(data.as_buffer())
                keyed = own.keys[own.unkeyed :]
                # A key's documents follow each other: the first is the index's, the others come behind it.
                distinct, rank = np.unique(keyed, return_index=True)
                numbers = own.find(distinct)
                if (numbers < 0).any():
                    raise ValueError("the index misses a key")
                again = np.arange(len(keyed)) - np.repeat(rank, np.diff([*rank, len(keyed)]))
                found = np.repeat(numbers, np.diff([*rank, len(keyed)])) + again
                order = [*range(own.unkeyed), *found.tolist()]
                for start in range(0, len(order), 1024):
                    part = order[start : start + 1024]
                    ids = [own.of(i) for i in part]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "partition": [own.partition] * len(part),
                            "block": [own.block] * len(part),
                            "doc_id": [None if i < own.unkeyed else int(own.keys[i]) for i in part],
                            "place": own.places[part].tolist(),
                            "n_tokens": [len(x) for x in ids],
                            "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                        },
                        schema=pa.schema([(n, pa.int64()) for n in names]),
                    )

    names = ("partition", "block", "doc_id", "place", "n_tokens", "ids_crc32")
    return _blocks(spark, folder).mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def read_documents(spark: SparkSession, folder: str, keys: list[int]) -> DataFrame:
    """``doc_id, ids`` of a list of keys; blocks without them are read but not decoded."""
    wanted = np.array(sorted(set(keys)), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                own = Block(data.as_buffer())
                for key, number in zip(wanted.tolist(), own.find(wanted).tolist(), strict=True):
                    while 0 <= number < own.documents and own.keys[number] == key:
                        ids = own.of(number).astype(np.int32)
                        yield pa.RecordBatch.from_pydict(
                            {"doc_id": [key], "ids": [ids]}, schema=pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
                        )
                        number += 1

    return _blocks(spark, folder).mapInArrow(run, "doc_id bigint, ids array<int>")


def token_files(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """Write the files, read them back: ``doc_id, start, n_tokens, ids_crc32``, a row per document.

    ``start`` counts the ids of all documents before in ascending key order; null keys come first,
    rows that share a key follow each other in the order of their texts and are all in the files. Null and empty texts are the end id alone.
    An empty table gives an empty folder and no rows. The files stay in the workspace's ``files`` folder.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "tokens")
    write_token_files(docs, f"{ws.folder}/files", tokenizer, key, text, end_id, block_ids)
    rows = ws.stage(read_token_files(spark, f"{ws.folder}/files"), "rows")
    blocks = rows.groupBy("partition", "block").agg(F.sum("n_tokens").alias("n"))
    earlier = (Window.unboundedPreceding, -1)
    # One row per partition: small whatever the data's size.
    bases = blocks.groupBy("partition").agg(F.sum("n").alias("total")).select(
        "partition", F.coalesce(F.sum("total").over(Window.orderBy("partition").rowsBetween(*earlier)), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("partition").orderBy("block").rowsBetween(*earlier)
    starts = blocks.select("partition", "block", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("inner")).join(
        bases, "partition"
    )
    return ws.finish(
        rows.join(starts, ["partition", "block"]).select(
            "doc_id", (F.col("base") + F.col("inner") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
        )
    )
