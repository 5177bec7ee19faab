"""Token ids of documents as compressed files, a data source of its own.

``write`` sorts documents by id over ranges; each task encodes its texts and writes
them as wavelet matrices (``wavelet``) of about ``SHARD_IDS`` tokens. When all tasks
have ended, an index lists the files of the tasks that count, in order, with the
tokens before each: files of lost or repeated attempts are in no index and are never
read. ``read`` opens one file per task.
"""

from __future__ import annotations

import io
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from fareloom.llm.common import by_chunks, id_and_text, ship
from fareloom.llm.wavelet import Shard, write_shard
from fareloom.llm.word_ids import word_ids

FORMAT = "token_files"
VOCABULARY = "word_bpe_49k.json"
END_ID = 2
# Tokens of a shard; a single longer document makes a longer one.
SHARD_IDS = 1 << 22
INDEX = "index.parquet"
INDEX_SCHEMA = pa.schema([("name", pa.string()), ("start", pa.int64()), ("n_ids", pa.int64())])
ROWS_PER_BATCH = 10_000

# What a row of each view holds. Positions count from the first token of all files.
VIEWS = {
    "ids": "doc_id long, start long, n_tokens long, ids array<int>",
    "digest": "doc_id long, start long, n_tokens long, ids_crc32 long",
    "counts": "token int, n long",
    "occurrences": "token int, doc_id long, position long",
    "positions": "position long, token int",
}


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    partition: int
    shards: list[tuple[str, int]]  # name and tokens


class TokenWriter(DataSourceArrowWriter):
    """Rows (doc_id, text), which are encoded here, as shards of a folder."""

    def __init__(self, path: str, vocabulary: str, end_id: int, shard_ids: int, overwrite: bool):
        self.path, self.vocabulary, self.end_id = path, vocabulary, end_id
        self.shard_ids, self.overwrite = shard_ids, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = opened(self.path)
        system.create_dir(folder, recursive=True)
        words = word_ids(public_tokenizers.path(self.vocabulary))
        partition = TaskContext.get().partitionId()
        message = Written(partition, [])
        held: list[np.ndarray] = []
        names: list[int | None] = []
        sizes: list[np.ndarray] = []

        def close() -> None:
            ids = np.concatenate(held)
            name = f"shard-{partition:05}-{len(message.shards):05}-{uuid.uuid4().hex}.wavelet"
            with system.open_output_stream(posixpath.join(folder, name)) as file:
                write_shard(file, ids, names, np.concatenate(sizes))
            message.shards.append((name, len(ids)))
            held.clear(), names.clear(), sizes.clear()

        for batch in iterator:
            for piece in by_chunks(batch, "text"):
                ids, ends = words.encode(piece.column("text").to_pylist(), self.end_id)
                own = piece.column("doc_id").to_pylist()
                at = first = 0
                while at < len(own):
                    # As many documents as the shard takes, one if it is empty.
                    room = first + self.shard_ids - sum(map(len, held))
                    stop = int(np.searchsorted(ends, room, side="right"))
                    stop = max(stop, at + (not held))
                    if stop > at:
                        last = int(ends[stop - 1])
                        held.append(ids[first:last].copy())
                        names.extend(own[at:stop])
                        sizes.append(np.diff(ends[at:stop], prepend=first))
                        at, first = stop, last
                    if at < len(own):
                        close()
        if held:
            close()
        return message

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = opened(self.path)
        index = posixpath.join(folder, INDEX)
        if not self.overwrite and system.get_file_info(index).type != fs.FileType.NotFound:
            raise ValueError(f"{self.path} holds token files already")
        system.create_dir(folder, recursive=True)
        known = sorted((m for m in messages if m), key=lambda m: m.partition)
        shards = [s for m in known for s in m.shards]
        sizes = np.array([n for _, n in shards], np.int64)
        columns = [[name for name, _ in shards], np.cumsum(sizes) - sizes, sizes]
        table = pa.table([pa.array(c, f.type) for c, f in zip(columns, INDEX_SCHEMA, strict=True)], INDEX_SCHEMA)
        buffer = io.BytesIO()
        pq.write_table(table, buffer)
        with system.open_output_stream(index) as file:
            file.write(buffer.getvalue())

    def abort(self, messages: list[Written | None]) -> None:
        """Files without an index are never read."""


@dataclass
class ShardFile(InputPartition):
    name: str
    start: int
    n_ids: int


class TokenReader(DataSourceReader):
    def __init__(self, path: str, view: str, asked: list[int]):
        self.path, self.view, self.asked = path, view, asked

    def partitions(self) -> list[ShardFile]:
        system, folder = opened(self.path)
        with system.open_input_file(posixpath.join(folder, INDEX)) as file:
            rows = pq.read_table(file).to_pylist()
        if self.view == "positions":  # only the files that hold one
            rows = [r for r in rows if any(0 <= p - r["start"] < r["n_ids"] for p in self.asked)]
        return [ShardFile(**r) for r in rows] or [ShardFile("", 0, 0)]

    def read(self, partition: ShardFile) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        system, folder = opened(self.path)
        with system.open_input_file(posixpath.join(folder, partition.name)) as file:
            yield from getattr(self, f"_{self.view}")(Shard(file), partition.start)

    def _whole(self, shard: Shard, start: int, last, kind: pa.DataType, name: str):
        doc_ids, sizes = shard.documents()
        ids = shard.ids()
        ends = np.cumsum(sizes)
        for i in range(0, len(doc_ids), ROWS_PER_BATCH):
            part = slice(i, i + ROWS_PER_BATCH)
            spans = zip((ends - sizes)[part].tolist(), ends[part].tolist(), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids[part], pa.int64()),
                    pa.array(start + (ends - sizes)[part]),
                    pa.array(sizes[part]),
                    pa.array([last(ids[a:b]) for a, b in spans], kind),
                ],
                ["doc_id", "start", "n_tokens", name],
            )

    def _ids(self, shard: Shard, start: int):
        return self._whole(shard, start, lambda x: x.view(np.int32), pa.list_(pa.int32()), "ids")

    def _digest(self, shard: Shard, start: int):
        return self._whole(shard, start, zlib.crc32, pa.int64(), "ids_crc32")

    def _counts(self, shard: Shard, start: int):
        counts = [shard.count(t) for t in self.asked]
        yield pa.RecordBatch.from_arrays(
            [pa.array(self.asked, pa.int32()), pa.array(counts, pa.int64())], ["token", "n"]
        )

    def _occurrences(self, shard: Shard, start: int):
        doc_ids, sizes = shard.documents()
        ends = np.cumsum(sizes)
        for token in self.asked:
            found = shard.positions(token)
            own = [doc_ids[i] for i in np.searchsorted(ends, found, side="right").tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(found), token, np.int32)),
                    pa.array(own, pa.int64()),
                    pa.array(start + found, pa.int64()),
                ],
                ["token", "doc_id", "position"],
            )

    def _positions(self, shard: Shard, start: int):
        here = [p for p in self.asked if 0 <= p - start < shard.n]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(here, pa.int64()),
                pa.array([shard.access(p - start) for p in here], pa.int32()),
            ],
            ["position", "token"],
        )


class TokenFiles(DataSource):
    """Options: path; to write vocabulary, end_id, shard_ids; to read view and asked."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return VIEWS[self.options.get("view", "ids")]

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        return TokenWriter(
            self.options["path"],
            self.options.get("vocabulary", VOCABULARY),
            int(self.options.get("end_id", END_ID)),
            int(self.options.get("shard_ids", SHARD_IDS)),
            overwrite,
        )

    def reader(self, schema) -> TokenReader:
        asked = [int(x) for x in self.options.get("asked", "").split(",") if x]
        return TokenReader(self.options["path"], self.options.get("view", "ids"), asked)


def write_token_files(
    df: DataFrame,
    path: str,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of all rows, each followed by ``end_id``, in ascending id order.

    Ids are those of the tokenizers library without special tokens. A null or empty
    text is ``end_id`` alone. Null ids come first; rows with the same id stand in the
    order of a hash of their texts. Repeated rows are written one by one, and many of
    them are dealt over several tasks. An empty table gives an index without files.
    Columns other than the two named are ignored. The folder must be one that all
    executors and the driver reach, and hold no token files yet.
    """
    spark = df.sparkSession
    ship(spark)
    spark.dataSource.register(TokenFiles)
    order = ["doc_id", "text_hash", "row"]
    rows = id_and_text(df, id_col, text_col).select(
        "*", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row")
    )
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .write.format(FORMAT)
        .options(vocabulary=vocabulary, end_id=end_id, shard_ids=shard_ids)
        .mode("append")
        .save(path)
    )


def read_token_files(
    spark: SparkSession, path: str, view: str = "ids", asked: tuple[int, ...] = ()
) -> DataFrame:
    """Rows of a view of the files in ``path``.

    "ids" and "digest" give a row per document: doc_id, start (tokens of all documents
    before it), n_tokens and its ids, or their unsigned crc32 as little-endian unsigned
    32-bit integers. "counts" and "occurrences" look for the tokens ``asked``: (token,
    n), or a row (token, doc_id, position) for each place. "positions" gives the
    (position, token) at the positions ``asked``. The last three open only the blocks
    that they need. Tokens and positions that do not occur give 0, or no row.
    """
    ship(spark)
    spark.dataSource.register(TokenFiles)
    options = {"view": view, "asked": ",".join(map(str, asked))}
    rows = spark.read.format(FORMAT).options(**options).load(path)
    if view == "counts":
        return rows.groupBy("token").agg(F.sum("n").alias("n"))
    return rows
