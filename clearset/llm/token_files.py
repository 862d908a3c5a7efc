"""Token-id files: whole texts as byte-level BPE ids in Simple-8b segments.

Documents are range-partitioned by doc_id and sorted, so that partitions, segments and
documents follow each other in ascending order (null first, repeats in the order of a hash of
their texts, so that a hot id is spread over many tasks).  Each
task encodes its documents and packs runs of whole documents into segments, which are
binary and describe themselves; Spark's Parquet writer stores them in the shared folder,
where any reader that Spark has can fetch them.

Segment: magic, version, counts, the number of ids before it in its part, then doc ids
(with null flags), ids per document, block offsets, words.

Defined cases: a null or empty text has only the end id; a longer text makes a longer
segment; repeated rows are stored each; an empty table gives no segment and an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import islice
from operator import attrgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearset.llm import simple8b
from clearset.llm.numbering import Numbers
from clearset.llm.text import small_batches
from clearset.storage import new_path

MAGIC, VERSION = b"S8BT", 1
HEADER = struct.Struct("<4sIQQQQQ")  # magic, version, part, base, documents, ids, words
#: A segment is closed once it holds so many ids.
SEGMENT_IDS = 1 << 18
#: Bytes that are encoded at once, and words and pre-tokens that a worker remembers.
PIECE_BYTES, CACHE_WORDS = 1 << 22, 600_000

_byte_chars = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
#: Byte-level alphabets write each byte as a printable character: itself, or one from 256 on.
BYTE_TABLE = "".join(chr(b if b in set(_byte_chars) else 256 + i - sum(c < b for c in _byte_chars)) for i, b in enumerate(range(256)))


class ByteBpe:
    """Encodes texts with a byte-level BPE of the tokenizers library.

    A text is cut at each space and before each line feed, which is where words begin for the
    pattern of such tokenizers; Arrow splits and numbers the words of a batch, and each different
    one is encoded once and remembered.  Texts with runs of white space or with the string of a
    special token go through the library as a whole.
    """

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.bpe = self.whole.model
        self.split = regex.compile(pattern).findall
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.runs = regex.compile(r"\s\s").search
        self.pieces: dict[str, bytes] = {}
        self.reset([], np.zeros(0, np.int32), np.zeros(0, np.uint32))

    def reset(self, words: list[str], lens: np.ndarray, flat: np.ndarray) -> None:
        self.index, self.lens, self.flat = Numbers(words), lens, flat

    def piece(self, pre: str) -> bytes:
        """Ids of one pre-token, as unsigned 32-bit integers."""
        if (ids := self.pieces.get(pre)) is None:
            if len(self.pieces) >= CACHE_WORDS // 2:
                self.pieces = dict(islice(self.pieces.items(), CACHE_WORDS // 4))
            mapped = charmap_decode(pre.encode("utf-8", "surrogatepass"), "strict", BYTE_TABLE)[0]
            ids = self.pieces[pre] = array("I", map(attrgetter("id"), self.bpe.tokenize(mapped))).tobytes()
        return ids

    def word(self, key: str) -> bytes:
        """Ids of a word by its key: the word without the space before it or, at the beginning of
        a text, with a space that it does not have.  A line feed has no space before it."""
        w = key[1:] if key[:1] == " " else key if key[:1] == "\n" else " " + key
        # letters of the Latin alphabets make one pre-token, whatever the version of Unicode
        if w[:1] == " " and key and max(key) < "\u0250":
            if key.isalpha():
                return self.piece(w)
            if key[-1] in ",." and key[:-1].isalpha():
                return self.piece(w[:-1]) + self.piece(w[-1])
        return b"".join(map(self.piece, self.split(w)))

    def encode(self, column: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a string column, ids of each text)."""
        column = pa.array(column, pa.string()) if isinstance(column, list) else column
        texts = column.to_pylist()
        apart = {i: self.whole.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts) if t and (self.runs(t) or any(s in t for s in self.special))}
        plain = np.ones(len(texts), bool)
        plain[list(apart)] = False
        whole = pc.fill_null(pc.if_else(pa.array(plain), column, ""), "")
        parts = pc.split_pattern(pc.replace_substring(whole, "\n", " \n"), " ")
        sizes = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        words, place = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        code = np.fromiter(map(self.index.__getitem__, words), np.int32, len(words))[place]
        heads = np.cumsum(sizes) - sizes
        code[heads] = [self.index[" " + words[i]] for i in place[heads]]
        if new := self.index.new:
            found = [self.word(w) for w in new]
            self.lens = np.concatenate([self.lens, np.fromiter(map(len, found), np.int32, len(found)) // 4])
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(found), np.uint32)])
            self.index.new = []
        n = self.lens[code]
        begin = np.cumsum(self.lens, dtype=np.int32) - self.lens
        before = np.zeros(len(n) + 1, np.int32)
        np.cumsum(n, out=before[1:])
        at = np.repeat(begin[code] - before[:-1], n)
        at += np.arange(len(at), dtype=np.int32)
        ids = self.flat[at]
        edge = np.r_[0, np.cumsum(sizes)]
        counts = (before[edge[1:]] - before[edge[:-1]]).astype(np.int64)
        if apart:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i, own in apart.items():
                parts[i] = np.array(own, np.uint32)
                counts[i] = len(own)
            ids = np.concatenate(parts)
        if len(self.index) > CACHE_WORDS:  # the words met first are the commonest
            half = CACHE_WORDS // 2
            self.reset(list(islice(self.index, half)), self.lens[:half], self.flat[: int(self.lens[:half].sum())])
        return ids, counts


_encoders: dict[str, ByteBpe] = {}


def encoder(path: str, pattern: str) -> ByteBpe:
    """One encoder for each worker process."""
    if path not in _encoders:
        _encoders[path] = ByteBpe(path, pattern)
    return _encoders[path]


def pack(part: int, base: int, doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets = simple8b.encode(ids)
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    numbers = np.array([0 if d is None else d for d in doc_ids], np.int64)
    head = HEADER.pack(MAGIC, VERSION, part, base, len(doc_ids), len(ids), len(words))
    return b"".join([head, nulls.tobytes(), numbers.tobytes(), counts.astype(np.int64).tobytes(), offsets.tobytes(), words.tobytes()])


def unpack(data: bytes) -> tuple[int, int, list, np.ndarray, np.ndarray]:
    """(part, base, doc ids, ids per document, ids) of a segment."""
    magic, version, part, base, docs, n, n_words = HEADER.unpack_from(data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token segment of this version")
    at = HEADER.size

    def take(kind, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    nulls, numbers, counts = take(np.uint8, docs), take(np.int64, docs), take(np.int64, docs)
    offsets = take(np.uint32, -(-n // simple8b.BLOCK) + 1)
    ids = simple8b.decode(take(np.uint64, n_words), offsets, n)
    return part, base, [None if x else int(d) for x, d in zip(nulls, numbers)], counts, ids


def write_segments(docs: DataFrame, path: str, tokenizer: str, pattern: str, end_id: int = 0, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode ``docs`` into segments below ``path``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    small_batches(docs.sparkSession)
    # rows that share an id, or have none, are spread by their text
    ranged = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = TaskContext.get().partitionId(), encoder(tokenizer, pattern)
        base, seq = 0, 0
        for batch in batches:
            column, doc_ids = batch.column(1).cast(pa.string()), batch.column(0).to_pylist()
            for lo, hi in runs(pc.fill_null(pc.binary_length(column), 0).to_pylist(), PIECE_BYTES):
                ids, counts = own.encode(column.slice(lo, hi - lo))
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
                edge = np.r_[0, np.cumsum(counts)]
                for a, b in runs(counts.tolist(), SEGMENT_IDS):
                    payload = pack(part, base, doc_ids[lo + a : lo + b], counts[a:b], ids[edge[a] : edge[b]])
                    n = int(edge[b] - edge[a])
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq]), pa.array([n]), pa.array([payload], pa.binary())], ["part", "seq", "n_ids", "segment"])
                    base += n
                    seq += 1

    files = ranged.select("doc_id", "text").mapInArrow(encode, "part int, seq long, n_ids long, segment binary")
    files.write.option("compression", "none").parquet(path)


def runs(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive runs (from, to) whose sizes add up to ``most`` or a little more."""
    first, n = 0, 0
    for i, size in enumerate(sizes):
        n += size
        if n >= most:
            yield first, i + 1
            first, n = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


def read_segments(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each stored document, from the files alone."""
    files = spark.read.schema("part int, seq long, n_ids long, segment binary").parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row for each part of the files: the offset of each is the sum of those before it
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    offsets = parts.select("part", before.alias("part_start"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for data in pdf["segment"]:
                part, base, doc_ids, counts, ids = unpack(data)
                edge = np.r_[0, np.cumsum(counts)]
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edge[:-1], edge[1:])]
                yield pd.DataFrame({"part": part, "doc_id": pd.array(doc_ids, "Int64"), "at": base + edge[:-1], "n_tokens": counts, "ids_crc32": np.array(crc, np.int64)})

    docs = files.select("segment").mapInPandas(decode, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(offsets, "part").select("doc_id", (F.col("part_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op1_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = new_path(spark, "token-files")
    write_segments(docs, path, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return read_segments(spark, path)
