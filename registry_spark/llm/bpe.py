"""BPE encoding and decoding of whole texts (operator 4)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry_spark.llm.tasks import arrow, byte_texts, chunked, loaded, record, segments
from registry_spark.llm.vocabulary import Encoder, Vocabulary, digest


# Distinct pieces of text a worker keeps with their ids.
CAPACITY = 250_000
# Bytes of text that are encoded, decoded and hashed at once.
PART = 2 << 20


class Codec:
    """Encoder and decoder for one tokenizer file; tables are built once per worker process."""

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as file:
            text = file.read()
        self.key, self.text = digest(text), spark.sparkContext.broadcast(text)

    def vocabulary(self) -> Vocabulary:
        return loaded("bpe vocabulary", self.key, lambda: Vocabulary(self.text.value))

    def encoder(self) -> Encoder:
        return loaded("bpe encoder", self.key, lambda: Encoder(self.vocabulary().encode_chunks, CAPACITY))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self.encoder().encode(texts)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Texts of the id sequences that lie one after the other in ``ids``."""
        pieces = iter(map(self.vocabulary().bytes_of.__getitem__, ids.tolist()))
        return [b"".join(islice(pieces, int(n))).decode("utf-8", "replace") for n in sizes]


def encode_documents(documents: DataFrame, path: str, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``ids`` (array of int) of every whole text; NULL and empty texts give no ids.

    Same ids as the tokenizer file's own library with ``add_special_tokens=False``: special
    strings in a text become their ids, there is no truncation or padding. Rows, also equal
    ones, map one to one; other columns are not carried.
    """
    codec = Codec(documents.sparkSession, path)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in chunked(batch, size=PART):
            ids, sizes = codec.encode(byte_texts(part))
            lists = pa.ListArray.from_arrays(pa.array(segments(sizes).astype(np.int32)), pa.array(ids))
            yield record(id=part.column(0), ids=lists)

    kind = documents.schema[id].dataType.simpleString()
    out = arrow(documents.select(F.col(id).alias("id"), F.col(text).alias("text")), run, f"id {kind}, ids array<int>")
    return out.withColumnRenamed("id", id)


def decode_documents(encoded: DataFrame, path: str, *, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``id`` and ``text`` of every row's ids, special strings included; a NULL list is an empty text."""
    codec = Codec(encoded.sparkSession, path)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = batch.column(1)
        sizes = np.array(pc.fill_null(pc.list_value_length(lists), 0), np.int64)
        yield record(id=batch.column(0), text=pa.array(codec.decode(np.array(lists.flatten()), sizes), pa.string()))

    kind = encoded.schema[id].dataType.simpleString()
    out = arrow(encoded.select(F.col(id).alias("id"), F.col(ids).alias("ids")), run, f"id {kind}, text string")
    return out.withColumnRenamed("id", id)


def round_trip(documents: DataFrame, path: str, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document, in one pass: number of ids, SHA-256 of the comma-joined decimal ids, SHA-256 of the text decoded from them."""
    codec = Codec(documents.sparkSession, path)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        decimals = loaded("bpe decimals", codec.key, lambda: [str(i).encode() for i in range(codec.vocabulary().size)])
        for part in chunked(batch, size=PART):
            ids, sizes = codec.encode(byte_texts(part))
            texts = codec.decode(ids, sizes)
            numbers = iter(map(decimals.__getitem__, ids.tolist()))
            yield record(
                id=part.column(0),
                n_tokens=pa.array(sizes),
                ids_sha256=[hashlib.sha256(b",".join(islice(numbers, int(n)))).hexdigest() for n in sizes],
                decoded_sha256=[hashlib.sha256(t.encode()).hexdigest() for t in texts],
            )

    kind = documents.schema[id].dataType.simpleString()
    out = arrow(
        documents.select(F.col(id).alias("id"), F.col(text).alias("text")), run,
        f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
    return out.withColumnRenamed("id", id)
