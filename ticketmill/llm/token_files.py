"""Token ids as flat binary files.

A dataset is a folder of shards in ascending document order. A shard is two files: `.bin`, the ids
of its documents one after another as little-endian unsigned integers of 16 or 32 bits; and `.idx`,
little-endian 64-bit integers: format version, bytes an id, documents n, then n + 1 offsets in ids
from the start of the shard, n document ids, n flags (1 where the id is null). A manifest (Parquet)
has a row per shard with the ids and documents before it, prefix sums over the shards' own counts.
Readers map the files into memory.

Documents are dealt by ranges of (doc_id, hash of the text) and sorted within them, so that equal
ids are split and their order does not depend on the run. A shard's name has the task attempt in
it, and the manifest lists what successful attempts returned; files of lost ones are never read.
Null texts are empty and have the end id alone; null doc_ids come first. Other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import stored, with_package
from .tokens import encode_all, largest_id

VERSION = 1
SHARD_BYTES = 32 << 20


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), parts.path if parts.scheme else path
    return pafs.FileSystem.from_uri(path)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme and authority that Spark takes it to have, so that tasks do not
    write to their own disks where a path without a scheme means a shared store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def write(docs: DataFrame, folder: str, tokenizer: str, keeps_space: bool, end: int, id_bytes: int = 2,
          shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the shards and the manifest; returns the manifest. A vocabulary whose largest id does
    not fit into `id_bytes` is refused before anything is written."""
    kind = {2: "<u2", 4: "<u4"}[id_bytes]
    largest = max(end, largest_id(tokenizer))
    if end < 0 or largest >> 8 * id_bytes:
        raise ValueError(f"id {largest if end >= 0 else end} does not fit into {id_bytes} bytes")
    folder = qualified(docs.sparkSession, folder)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"shard-{task.partitionId():06d}-{task.taskAttemptId()}"
        fs, base = _file_system(folder)
        fs.create_dir(base, recursive=True)
        offsets, doc_ids, first, out = [0], [], None, None
        for batch in batches:
            texts = batch.column("text")
            if first is None and batch.num_rows:
                first = (batch.column("doc_id")[0].as_py(), batch.column("tie")[0].as_py())
                out = fs.open_output_stream(f"{base}/{name}.bin")
            doc_ids += batch.column("doc_id").to_pylist()
            for at in range(0, batch.num_rows, 256):
                for ids in encode_all(texts.slice(at, 256).to_pylist(), tokenizer, keeps_space, end):
                    out.write(np.frombuffer(ids, "<u4").astype(kind).tobytes())
                    offsets.append(offsets[-1] + len(ids) // 4)
        if first is None:
            return
        out.close()
        null = [d is None for d in doc_ids]
        with fs.open_output_stream(f"{base}/{name}.idx") as index:
            for part in ([VERSION, id_bytes, len(doc_ids)], offsets, [d or 0 for d in doc_ids], null):
                index.write(np.asarray(part, "<i8").tobytes())
        yield pa.RecordBatch.from_pydict({
            "name": [name], "first_id": pa.array([first[0]], pa.int64()), "first_tie": [first[1]],
            "n_docs": [len(doc_ids)], "n_tokens": [offsets[-1]]})

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(max(1, -(-size // shard_bytes)))
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
    key = [F.asc_nulls_first("doc_id"), F.asc("tie")]
    ordered = rows.repartitionByRange(shards, *key).sortWithinPartitions(*key)
    written = stored(with_package(ordered).mapInArrow(
        work, "name string, first_id long, first_tie long, n_docs long, n_tokens long"), "token-shards")
    # One small row per shard.
    before = Window.orderBy(F.asc_nulls_first("first_id"), "first_tie").rowsBetween(Window.unboundedPreceding, -1)
    manifest = written.select("*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before")
                                     for c in ("n_docs", "n_tokens")])
    manifest.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.parquet(f"{folder}/manifest")


def open_shard(path: str) -> tuple[np.ndarray, np.ndarray, list[int | None]]:
    """(ids, offsets, doc_ids) of a shard; local files are memory-mapped."""
    fs, base = _file_system(path)
    if isinstance(fs, pafs.LocalFileSystem):
        raw = lambda name, kind: np.memmap(name, kind, "r") if os.path.getsize(name) else np.zeros(0, kind)
    else:
        raw = lambda name, kind: np.frombuffer(fs.open_input_file(name).read(), kind)
    index = raw(f"{base}.idx", "<i8")
    version, id_bytes, n = (int(x) for x in index[:3])
    if version != VERSION:
        raise ValueError(f"format version {version} of {path} is not known")
    offsets, doc_ids, null = index[3:4 + n], index[4 + n:4 + 2 * n], index[4 + 2 * n:]
    ids = raw(f"{base}.bin", {2: "<u2", 4: "<u4"}[id_bytes])
    return ids, offsets, [None if z else int(d) for d, z in zip(doc_ids, null)]


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Read back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    folder = qualified(spark, folder)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                ids, offsets, doc_ids = open_shard(f"{folder}/{shard['name']}")
                crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()), "start": np.asarray(offsets[:-1]) + shard["n_tokens_before"],
                    "n_tokens": np.diff(offsets), "ids_crc32": pa.array(crcs, pa.int64())})
    manifest = spark.read.parquet(f"{folder}/manifest")
    shards = max(1, manifest.count())
    return with_package(manifest.select("name", "n_tokens_before").repartition(shards)).mapInArrow(
        work, "doc_id long, start long, n_tokens long, ids_crc32 long")
