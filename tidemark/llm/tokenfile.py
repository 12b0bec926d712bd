"""Token ids in binary files: independent zstandard frames, a trailing seek table, a checksum for each frame.

A file is: one frame for each document in ascending id order (ids as little-endian unsigned integers), a
skippable frame with the document ids, and a skippable frame with the seek table of the public zstandard
seekable format (sizes, and the low 32 bits of XXH64 of each frame's content). A reader seeks to a document's
frame and decompresses nothing else; ordinary zstandard tools read the whole file as well.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, filesystem, scratch, settle, shuffle_partitions
from tidemark.llm.tokenize import encoder

# Fixed values of the public formats.
SKIPPABLE, SEEK_TABLE, SEEKABLE, NULL_ID = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, -(2**63)


class Writer:
    """Writes one file to an open binary stream."""

    def __init__(self, out, width: int, level: int = 3):
        self.out, self.width, self.ids, self.table = out, width, [], []
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=False).compress

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        raw = ids.astype(f"<u{self.width}").tobytes()
        frame = self.compress(raw)
        self.out.write(frame)
        self.ids.append(NULL_ID if doc_id is None else doc_id)
        self.table.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> None:
        index = struct.pack("<Q", self.width) + np.array(self.ids, "<i8").tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        self.table.append((len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        body = np.array(self.table, "<u4").tobytes() + struct.pack("<IBI", len(self.table), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SEEK_TABLE, len(body)) + body)


class Reader:
    """Reads documents from an open, seekable file; ``ValueError`` if a frame's content doesn't match its checksum."""

    def __init__(self, file, size: int):
        self.file = file
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError("no seek table")
        self.table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0].astype(np.int64))])
        index = self._at(int(self.starts[n - 1]) + 8, int(self.table[-1, 0]) - 8)
        self.width = struct.unpack("<Q", index[:8])[0]
        self.doc_ids = np.frombuffer(index[8:], "<i8")
        self.decompress = zstandard.ZstdDecompressor().decompress

    def _at(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def counts(self) -> np.ndarray:
        return self.table[:-1, 1].astype(np.int64) // self.width

    def ids(self, k: int) -> np.ndarray:
        size, length, check = (int(x) for x in self.table[k])
        raw = self.decompress(self._at(int(self.starts[k]), size), max_output_size=length) if length else b""
        if len(raw) != length or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, f"<u{self.width}")

    def find(self, doc_id: int) -> list[np.ndarray]:
        """Ids of the documents of this id (files are in ascending order)."""
        a, b = np.searchsorted(self.doc_ids, [doc_id, doc_id + 1])
        return [self.ids(k) for k in range(a, b)]


def write_files(docs: DataFrame, tokenizer: str, folder: str, *, end_id: int = 0, files: int | None = None) -> DataFrame:
    """Encode every text, append ``end_id``, and write files of consecutive document ids; (part, path, docs, tokens) of each file.

    Null texts are empty ones; null ids come first; rows of the same id follow each other in the order of a hash
    of their text. A task writes to a name of its own, and only the files of the attempts that Spark accepts are
    in the result, which is stored before it is returned.
    """
    ordered = documents(docs).withColumn("_tie", F.xxhash64("text")).repartitionByRange(files or shuffle_partitions(docs.sparkSession), "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, tokens = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if writer is None and batch.num_rows:
                enc = encoder(tokenizer)
                fs, root = filesystem(folder)
                fs.create_dir(root, recursive=True)
                name = f"part-{part:06d}-{uuid.uuid4().hex}.ids.zst"
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
                writer = Writer(out, enc.dtype.itemsize)
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = np.append(enc.encode(text or ""), enc.dtype.type(end_id))
                writer.add(doc, ids)
                tokens += len(ids)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.record_batch([[part], [f"{folder}/{name}"], [len(writer.ids)], [tokens]], ["part", "path", "docs", "tokens"])

    return settle(ordered.mapInArrow(run, "part long, path string, docs long, tokens long"), "token-files")


def read_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of ``write_files``, from the files themselves. start counts the ids in all files and documents before."""
    spark = files.sparkSession
    rows = sorted(files.select("part", "path", "tokens").collect())  # a row for each file
    before = np.concatenate([[0], np.cumsum([r.tokens for r in rows], dtype=np.int64)]).tolist()
    plan = spark.createDataFrame([(r.path, b) for r, b in zip(rows, before, strict=False)], "path string, base long").repartition(max(1, len(rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist(), strict=True):
                fs, local = filesystem(path)
                with fs.open_input_file(local) as f:
                    reader = Reader(f, f.size())
                    counts = reader.counts()
                    crcs = [zlib.crc32(reader.ids(k).astype("<u4").tobytes()) for k in range(len(reader))]
                ids = pa.array(reader.doc_ids, mask=reader.doc_ids == NULL_ID)
                yield pa.record_batch([ids, pa.array(base + np.cumsum(counts) - counts), pa.array(counts), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return plan.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, *, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row, written to files in ``folder`` and read back from them.

    A null or empty text is the end id alone; repeated rows are documents of their own and null ids come first. An empty
    table gives no files and no rows. Only id and text are read: other columns may have any names.
    """
    return read_files(write_files(docs, tokenizer, folder or scratch(docs.sparkSession, "token-ids"), end_id=end_id))
