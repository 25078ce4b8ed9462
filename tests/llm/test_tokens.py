"""BPE and token files against the tokenizer file's own library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tokenizers

from registry_spark.llm import token_files
from registry_spark.llm.bpe import decode_documents, encode_documents, round_trip
from registry_spark.llm.tasks import segments
from registry_spark.llm.token_files import LibraryEncoder, TokenFile, TokenFileWriter, read_token_files, write_token_files
from registry_spark.llm.vocabulary import Encoder, Vocabulary
from registry_spark.sources.shared import shared_folder, written

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as file:
        return Vocabulary(file.read())


def agree(library, vocabulary, texts):
    """Both encoders: by merge rounds, and by the library piece by piece."""

    class Shared:
        value = open(PATH, encoding="utf-8").read()

    pieces = LibraryEncoder.__new__(LibraryEncoder)
    pieces.text = Shared
    for encode_chunks in (vocabulary.encode_chunks, pieces.library()):
        agree_with(library, vocabulary, texts, encode_chunks)


def agree_with(library, vocabulary, texts, encode_chunks):
    ids, sizes = Encoder(encode_chunks, capacity=1_000).encode([t.encode() for t in texts])
    bounds = segments(sizes)
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[a:b].tolist() == want, repr(text)
        assert vocabulary.decode(ids[a:b]) == library.decode(want, skip_special_tokens=False)


def test_white_space_and_special_strings(library, vocabulary):
    agree(library, vocabulary, [
        "", " ", "  ", "a", "a  b", "a\n\nb", "a\n b", "a \nb", "\na", "a\n", "x<|endoftext|>y <|endoftext|> z,", "it's we'll\t\tx\xa0y　z",
        "aaaa" * 50, "a" * 3_000 + "b ab", "word.\r\nNext  line", "ünï 日本語 🙂🙂 a", "a, b.\nC! 12.5, (x), y.", "\x1c a\x85b", "<|endoftext|>", "<|endoftext|",
        "x\xa0\xa0y", "\xa0\xa0y z", "a　　b\u2003\u2003", "\t\ty", "\x1c\x1cq", "z\u2028\u2028w",
    ])


def test_many_code_points(library, vocabulary):
    random.seed(1)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    agree(library, vocabulary, [f"a{chr(c)}a1{chr(c)}1 {chr(c)}" for c in [*range(0x3100), *random.sample(points, 4_000)]])


def test_random_texts(library, vocabulary):
    rng = random.Random(5)
    alphabet = "ab '\n\t s.,1 é\x1c日!\xa0\u2003"
    agree(library, vocabulary, ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(5_000)])


def test_long_words_merge_alike(vocabulary):
    rng = random.Random(2)
    for word in (b"a" * 700, bytes(rng.choice(b"abcde") for _ in range(900)), bytes(rng.randrange(256) for _ in range(400))):
        flat, sizes = vocabulary.merge([word])
        assert sizes.tolist() == [len(flat)] and vocabulary.merge_long(word).tolist() == flat.tolist()


def test_documents(spark, documents, odd_rows, library):
    df = documents(odd_rows)
    got = round_trip(df, PATH).collect()
    want = []
    for doc_id, text, _, _ in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    encoded = encode_documents(df, PATH)
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()}[8] == library.encode("word").ids
    decoded = {r["doc_id"]: r["text"] for r in decode_documents(encoded, PATH).collect()}
    assert all(decoded[i] == (t or "") for i, t, _, _ in odd_rows)


def test_empty_table(spark, documents):
    assert round_trip(documents([]), PATH).collect() == []
    manifest = written(write_token_files(documents([]), shared_folder(spark), PATH, end_id=2))
    assert read_token_files(spark, [tuple(r) for r in manifest.collect()]).collect() == []


def test_files(spark, documents, odd_rows, library):
    rows = [(i, t) for i, t, _, _ in odd_rows]
    folder = shared_folder(spark)
    manifest = written(write_token_files(documents(odd_rows), folder, PATH, end_id=2))
    files = [tuple(r) for r in manifest.collect()]
    got = read_token_files(spark, files, with_ids=True).orderBy("start").collect()
    ids = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 2]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in got] == [i for i, _ in order]
    start = 0
    for r in got:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == sorted((str(i), ids(t)) for i, t in rows)


def test_equal_ids_have_one_order(spark, documents):
    """The same rows in one and in seven partitions, a third of them with one id, some without an id or text."""
    rows = [(7 if i % 3 == 0 else i % 9 or None, None if i % 50 == 0 else f"text {i % 40} " * (i % 5), "en", "a") for i in range(600)]
    seen = []
    for df in (documents(rows).coalesce(1), documents(rows[::-1]).repartition(7)):
        manifest = written(write_token_files(df, shared_folder(spark), PATH, end_id=2))
        out = read_token_files(spark, [tuple(r) for r in manifest.collect()])
        seen.append(sorted(map(tuple, out.collect()), key=str))
    assert seen[0] == seen[1] and len(seen[0]) == 600


def test_reading_by_id(spark, documents, odd_rows):
    manifest = written(write_token_files(documents(odd_rows), shared_folder(spark), PATH, end_id=2))
    files = [tuple(r) for r in manifest.collect()]
    whole = sorted(map(tuple, read_token_files(spark, files).collect()), key=str)
    for wanted in ([5, 22, 999], [None], []):
        out = read_token_files(spark, files, wanted=wanted).collect()
        assert sorted(map(tuple, out), key=str) == [r for r in whole if r[0] in wanted]


class Counting:
    """A file that remembers what was read."""

    def __init__(self, data):
        self.file, self.read = pa.BufferReader(data), 0

    def size(self):
        return self.file.size()

    def read_at(self, n, at):
        self.read += n
        return self.file.read_at(n, at)


def file_of(lists, monkeypatch, frame=4_000, split=10_000):
    monkeypatch.setattr(token_files, "FRAME", frame)
    monkeypatch.setattr(token_files, "SPLIT", split)
    out = pa.BufferOutputStream()
    writer = TokenFileWriter(out)
    for i, ids in enumerate(lists):
        writer.add(None if i == 3 else i, np.array(ids))
    writer.close()
    return out.getvalue().to_pybytes()


def test_frames_are_independent(monkeypatch):
    rng = np.random.default_rng(0)
    lists = [rng.integers(0, 50_000, n).tolist() for n in (5, 0, 700, 3, 20_000, 1, 900, 900, 900, 2)]
    data = file_of(lists, monkeypatch)
    source = Counting(data)
    reader = TokenFile(source)
    index = source.read
    assert reader.doc_ids == [0, 1, 2, None, *range(4, 10)]
    assert reader.document(9).tolist() == lists[9] and source.read - index < 12_000 < len(data)
    assert [reader.document(i).tolist() for i in range(10)] == lists


def test_damage_is_found(monkeypatch):
    data = bytearray(file_of([list(range(3_000)), [1, 2]], monkeypatch))
    data[40] ^= 1
    reader = TokenFile(pa.BufferReader(bytes(data)))
    with pytest.raises(Exception):
        reader.document(0)
    assert reader.document(1).tolist() == [1, 2]
