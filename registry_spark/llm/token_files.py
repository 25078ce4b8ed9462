"""Token ids in binary files of independent zstandard frames (operator 3).

File: data frames, each the ids of some whole documents as little-endian unsigned
32-bit integers (a document above ``SPLIT`` bytes spans several frames); one skippable
frame with the document index; one skippable frame with the seek table of the public
zstandard seekable format (per frame: compressed size, decompressed size, low 32 bits of
the XXH64 of the content). The index frame's decompressed size in the table is 0.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
import tokenizers
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_spark.llm.tasks import begin, byte_texts, chunked, loaded, ragged, record, segments, ship
from registry_spark.llm.vocabulary import Encoder, Vocabulary, digest

# Fixed values of the public formats.
SKIPPABLE_MAGIC, SEEK_TABLE_MAGIC, SEEKABLE_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1

FRAME, SPLIT, LEVEL = 256 << 10, 64 << 20, 1
# Pieces of text that the library gets as one.
GROUP = 2_000


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a shared location, from any process."""
    return pyarrow.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class TokenFileWriter:
    """Appends documents; every frame is written as soon as it is full."""

    def __init__(self, out):
        self.out, self.compress = out, zstandard.ZstdCompressor(level=LEVEL).compress
        self.table: list[tuple[int, int, int]] = []
        self.parts: list[bytes] = []
        self.size = 0
        self.ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        data = ids.astype("<u4").tobytes()
        self.ids.append(doc_id)
        self.counts.append(len(ids))
        for at in range(0, len(data), SPLIT):
            part = data[at : at + SPLIT]
            self.parts.append(part)
            self.size += len(part)
            if self.size >= FRAME:
                self.flush()

    def flush(self) -> None:
        if self.size:
            data = b"".join(self.parts)
            frame = self.compress(data)
            self.out.write(frame)
            self.table.append((len(frame), len(data), checksum(data)))
            self.parts, self.size = [], 0

    def close(self) -> None:
        self.flush()
        known = np.array([i is not None for i in self.ids], np.uint8)
        ids = np.array([i or 0 for i in self.ids], "<i8")
        body = self.compress(known.tobytes() + ids.tobytes() + np.array(self.counts, "<i8").tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
        self.table.append((8 + len(body), 0, checksum(body)))
        rows = b"".join(struct.pack("<III", *row) for row in self.table)
        footer = struct.pack("<IBI", len(self.table), 1 << 7, SEEKABLE_FOOTER)
        self.out.write(struct.pack("<II", SEEK_TABLE_MAGIC, len(rows) + len(footer)) + rows + footer)


class TokenFile:
    """Reads a file from its seek table; only frames that hold a requested document are decompressed."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE_FOOTER or not flags >> 7:
            raise ValueError("no seek table with checksums")
        table = np.frombuffer(file.read_at(12 * n, size - 9 - 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.offsets = segments(table[:, 0])
        body = file.read_at(int(table[-1, 0]) - 8, int(self.offsets[-2]) + 8)
        if checksum(body) != table[-1, 2]:
            raise ValueError("damaged document index")
        index = zstandard.ZstdDecompressor().decompress(body)
        m = len(index) // 17
        known = np.frombuffer(index, np.uint8, m)
        ids = np.frombuffer(index, "<i8", m, m)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known)]
        self.counts = np.frombuffer(index, "<i8", m, 9 * m)
        self.starts = segments(self.counts)
        self.sizes, self.checksums = table[:-1, 1], table[:-1, 2]
        self.frame_starts = segments(self.sizes) // 4
        self.held: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def places(self, wanted: frozenset | None = None) -> np.ndarray:
        """Numbers of the documents with the ids asked for, by default of all."""
        if wanted is None:
            return np.arange(len(self.counts))
        return np.array([i for i, x in enumerate(self.doc_ids) if x in wanted], np.int64)

    def frame(self, k: int) -> np.ndarray:
        if self.held[0] != k:
            data = self.file.read_at(int(self.offsets[k + 1] - self.offsets[k]), int(self.offsets[k]))
            content = zstandard.ZstdDecompressor().decompress(data)
            if len(content) != self.sizes[k] or checksum(content) != self.checksums[k]:
                raise ValueError(f"frame {k} is damaged")
            self.held = (k, np.frombuffer(content, "<u4"))
        return self.held[1]

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document of the file."""
        a, b = int(self.starts[i]), int(self.starts[i + 1])
        parts = []
        k = int(np.searchsorted(self.frame_starts, a, "right")) - 1
        while a < b:
            start, end = int(self.frame_starts[k]), int(self.frame_starts[k + 1])
            parts.append(self.frame(k)[a - start : min(b, end) - start])
            a, k = min(b, end), k + 1
        return np.concatenate([np.zeros(0, "<u4"), *parts])


class LibraryEncoder:
    """Ids by the tokenizers library from a tokenizer file; each distinct piece of text is encoded once."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as file:
            text = file.read()
        self.key, self.text = digest(text), spark.sparkContext.broadcast(text)

    def library(self) -> Callable:
        tokenizer = tokenizers.Tokenizer.from_str(self.text.value)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        width = np.fromiter(map(len, Vocabulary(self.text.value).bytes_of), np.int64)

        def chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            """Ids of chunks; many go to the library as one text and are told apart by the bytes of their ids.

            White space after another character starts a pre-token, and a line break between two is one by itself,
            so chunks that begin and end with such characters may follow one another, others apart by a line break.
            """
            groups, alone = [], []
            for k, text in enumerate(texts):
                if len(text) > 2 and 32 < text[1] < 127 and 32 < text[-1] < 127:
                    continue
                plain = text.decode()
                if plain[-1:].isspace() or plain[:2].isspace():
                    alone.append(k)
            odd = set(alone)
            regular = [k for k in range(len(texts)) if k not in odd] if odd else range(len(texts))
            sizes = np.zeros(len(texts), np.int64)
            found: list[np.ndarray] = []
            for first in range(0, len(regular), GROUP):
                some = regular[first : first + GROUP]
                pieces = []
                for k in some:
                    pieces += (b"", texts[k]) if texts[k][0] in (32, 10) else (b"\n", texts[k])
                groups.append((some, pieces))
            encoded = tokenizer.encode_batch_fast([b"".join(p).decode() for _, p in groups], add_special_tokens=False)
            for (some, pieces), encoding in zip(groups, encoded):
                ids = np.array(encoding.ids, np.int32)
                ends = np.cumsum(width[ids])
                bounds = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))), "right")
                counts = np.diff(bounds, prepend=0)
                found.append(ids[np.repeat(np.arange(len(pieces)) % 2 == 1, counts)])
                sizes[some] = counts[1::2]
            rest = [e.ids for e in tokenizer.encode_batch_fast([texts[k].decode() for k in alone], add_special_tokens=False)]
            sizes[alone] = [len(x) for x in rest]
            if not alone:
                return np.concatenate(found) if found else np.zeros(0, np.int32), sizes
            order = np.concatenate((np.array(regular, np.int64), np.array(alone, np.int64)))
            flat = np.concatenate([*found, np.fromiter(chain.from_iterable(rest), np.int32)])
            starts = np.empty(len(texts), np.int64)
            starts[order] = segments(sizes[order])[:-1]
            return flat[ragged(starts, sizes)], sizes

        return chunks

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return loaded("library encoder", self.key, lambda: Encoder(self.library())).encode(texts)


def write_token_files(
    documents: DataFrame, folder: str, path: str, *, end_id: int, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write all documents in ascending ``id`` order (NULL first) and return the manifest, one row per file.

    Columns: part (order of the files), file, n_docs, n_tokens. Each document's ids are
    followed by ``end_id``; a NULL or empty text is the end id alone. Rows with equal
    ids are all written, next to each other, in the order of a hash of their texts and then of the texts (NULL first), so that the
    order depends on the rows alone; one id held by very many rows is shared by several tasks. A task writes under a name of its own and the
    manifest names the files of the tasks that counted, so repeated tasks do no harm.
    Evaluating the frame writes the files: store it, then read it. No rows, no files.
    """
    encoder = LibraryEncoder(ship(documents.sparkSession), path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        part = TaskContext.get().partitionId()
        writer = out = None
        name = f"part-{part:07d}-{uuid.uuid4().hex}.ids.zst"
        for batch in batches:
            for rows in chunked(batch):
                if writer is None:
                    fs, base = file_system(folder)
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    writer = TokenFileWriter(out)
                ids, sizes = encoder.encode(byte_texts(rows))
                at = 0
                for doc_id, n in zip(rows.column(0).to_pylist(), sizes.tolist()):
                    writer.add(doc_id, np.append(ids[at : at + n], end_id))
                    at += n
        if writer is not None:
            writer.close()
            out.close()
            yield record(part=[part], file=[f"{folder}/{name}"], n_docs=[len(writer.counts)], n_tokens=[sum(writer.counts)])

    rows = documents.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")
    return ordered.mapInArrow(run, "part long, file string, n_docs long, n_tokens long")


def read_token_files(
    spark: SparkSession, files: list[tuple[int, str, int, int]], *, with_ids: bool = False, wanted: Iterable[int | None] | None = None
) -> DataFrame:
    """Documents of the files of a manifest: doc_id, start, n_tokens, ids_crc32 and, on request, ids.

    ``files`` are the manifest's rows; there is one per file, each of at least one task's
    output, so they are few. ``start`` is the number of ids of all documents before. With ``wanted`` only
    the documents of these ids (None: those without one; a list that a driver holds) are read: of a file its index
    and the frames that hold them. Ids that no document has give no rows.
    """
    ship(spark)
    some = None if wanted is None else frozenset(wanted)
    rows, start = [], 0
    for part, file, _, n_tokens in sorted(files):
        rows.append((file, start))
        start += n_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, path = file_system(file)
                with fs.open_input_file(path) as source:
                    documents = TokenFile(source)
                    chosen = documents.places(some)
                    for first in range(0, len(chosen), 1_000):
                        numbers = chosen[first : first + 1_000]
                        columns = {
                            "doc_id": pa.array([documents.doc_ids[i] for i in numbers], pa.int64()),
                            "start": pa.array(start + documents.starts[numbers]),
                            "n_tokens": pa.array(documents.counts[numbers]),
                        }
                        if with_ids:
                            ids = [documents.document(i) for i in numbers]
                            columns["ids_crc32"] = [zlib.crc32(x.tobytes()) for x in ids]
                            columns["ids"] = pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64()))
                        else:
                            columns["ids_crc32"] = [zlib.crc32(documents.document(i).tobytes()) for i in numbers]
                        yield record(**columns)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return spark.createDataFrame(rows, "file string, start long").mapInArrow(run, schema)
