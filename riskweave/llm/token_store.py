"""Token ids in raw shard files, found by a minimal perfect hash index."""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.llm.text import digest, slices, text_bytes
from riskweave.session import materialize

RECORD = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("n_tokens", "<u8")])

# Bits per key at each level of the index; keys that collide go to the next.
GAMMA = 2

LOCATION = "doc_id long, shard long, offset long, n_tokens long"


# Files in the shared folder, written and read by tasks.


def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def _write_whole(uri: str, chunks: Iterator[bytes]) -> None:
    """Write under another name and rename: a lost attempt leaves no half file."""
    fs, path = _open(uri)
    attempt = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(attempt) as out:
        for chunk in chunks:
            out.write(chunk)
    fs.move(attempt, path)


def _shard_file(root: str, shard: int) -> str:
    return f"{root}/shard-{shard:08d}.bin"


def _index_file(root: str, bucket: int) -> str:
    return f"{root}/index-{bucket:08d}.bin"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(hadoop).toString()


# Encoding.


class WordEncoder(dict):
    """Ids of words as raw little-endian integers, cached in two bounded generations.

    The tokenizer splits at white space first, so a text's ids are those of its
    words in a row; ASCII capitals are lowered by the tokenizer in any case and
    are lowered here so that more words are alike. Words that may hold one of
    its special strings stay as they are, for only their exact spelling counts.
    """

    def __init__(self, file: str, end_id: int, limit: int):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.dtype = id_type(file, end_id)
        self.letter = "H" if self.dtype == "<u2" else "I"
        self.end, self.limit, self.older = np.array([end_id], self.dtype).tobytes(), limit, {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        return [b"".join(map(self.__getitem__, self._words(t))) + self.end for t in texts]

    def _words(self, text: bytes) -> list[bytes]:
        if SPECIAL not in text:
            return text.lower().split()
        return [w if SPECIAL in w else w.lower() for w in text.split()]

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._ids(word)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def _ids(self, word: bytes) -> bytes:
        """The split pattern keeps letters in a row together and apart from the marks after them."""
        stem = word.rstrip(MARKS)
        if len(stem) < len(word) and _ends_in_letter(stem):
            return self[stem] + self[word[len(stem) :]]
        if letters := _plain_letters(word):
            ids = [t.id for t in self.tokenizer.model.tokenize(letters)]
        else:
            ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}{self.letter}", *ids)


# What the special strings of the vocabulary begin with.
SPECIAL = b"<|"

# Marks that are neither letters, digits nor part of a contraction.
MARKS = b".,;:!?"


def _byte_characters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable Latin-1 as it is, the
    other bytes in turn from code point 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTES = _byte_characters()


def _ends_in_letter(stem: bytes) -> bool:
    """Whether marks after the stem are a piece of their own: it ends in a letter, lowered too, or an ASCII digit."""
    return stem[-1:].isalnum() or (stem != b"" and stem[-1] > 127 and stem.decode()[-1].lower()[-1].isalpha())


def _plain_letters(word: bytes) -> str:
    """A word of Latin letters as the vocabulary writes it; empty for all other words.

    Such a word passes the tokenizer's normaliser and splitter as one piece.
    """
    if word.isascii():
        return word.decode() if word.isalpha() else ""  # lowered already
    text = unicodedata.normalize("NFC", word.decode()).lower()
    if not text.isalpha() or max(text) >= "\u0250":
        return ""
    return text.encode().decode("latin-1").translate(_BYTES)


_encoders: dict[tuple, WordEncoder] = {}


def _encoder(*key) -> WordEncoder:
    """One encoder in each worker process."""
    if key not in _encoders:
        _encoders[key] = WordEncoder(*key)
    return _encoders[key]


def id_type(tokenizer_file: str, end_id: int) -> str:
    """Two bytes for each id where the vocabulary allows it, else four."""
    from tokenizers import Tokenizer

    most = max(Tokenizer.from_file(tokenizer_file).get_vocab_size(), end_id + 1)
    return "<u2" if most <= 1 << 16 else "<u4"


# The minimal perfect hash of one bucket of keys.


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A hash of 64-bit keys, another one for each level."""
    x = keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mixed(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


@dataclass
class PerfectHash:
    """Bit arrays by level: a key's slot is the rank of the first set bit it meets."""

    levels: list[np.ndarray]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """From distinct keys; each level keeps the keys that are alone at their place."""
        levels, rest = [], keys
        while len(rest):
            at = _mixed(rest, len(levels)) % np.uint64(GAMMA * len(rest) + 1)
            alone = np.bincount(at.astype(np.int64), minlength=GAMMA * len(rest) + 1) == 1
            levels.append(alone)
            rest = rest[~alone[at.astype(np.int64)]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """A slot in 0 .. n-1 for each key, -1 for some of the keys that are not there."""
        found, before, rest = np.full(len(keys), -1, np.int64), 0, np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = (_mixed(keys[rest], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            found[rest[hit]] = before + np.cumsum(bits)[at[hit]] - 1
            before += int(bits.sum())
            rest = rest[~hit]
        return found

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<u8")
        return sizes.tobytes() + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def load(cls, data: bytes) -> tuple[PerfectHash, int]:
        """The hash and the place where its bytes end."""
        n = int(np.frombuffer(data, "<u8", 1)[0])
        sizes, at, levels = np.frombuffer(data, "<u8", n, 8).astype(int), 8 * (n + 1), []
        for size in sizes:
            width = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, width, at), count=size).astype(bool))
            at += width
        return cls(levels), at


# The store.


@dataclass
class TokenStore:
    """A store's folder and what its manifest says."""

    root: str
    dtype: str
    buckets: int

    @classmethod
    def open(cls, root: str) -> TokenStore:
        fs, path = _open(f"{root}/manifest.json")
        with fs.open_input_stream(path) as f:
            return cls(root, **json.loads(f.read()))

    def get(self, doc_id: int) -> np.ndarray | None:
        """One document's ids by key: one index file and one slice of one shard are read."""
        bucket = int(_mixed(np.array([doc_id], np.int64), 1 << 21)[0] % np.uint64(self.buckets))
        try:
            found, records = self.find(bucket, np.array([doc_id], np.int64))
        except FileNotFoundError:
            return None
        return self.read(_open(_shard_file(self.root, int(records["shard"][0]))), records[0]) if found[0] else None

    def find(self, bucket: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys of a bucket are stored, and their records."""
        fs, path = _open(_index_file(self.root, bucket))
        with fs.open_input_file(path) as f:
            data = f.read()
        perfect, at = PerfectHash.load(data)
        records = np.frombuffer(data, RECORD, offset=at)
        slots = perfect.slots(keys)
        records = records[np.maximum(slots, 0)]
        return (slots >= 0) & (records["fingerprint"] == _fingerprint(keys)), records

    def read(self, opened: tuple[pyarrow.fs.FileSystem, str], record: np.void) -> np.ndarray:
        fs, path = opened
        width = np.dtype(self.dtype).itemsize
        with fs.open_input_file(path) as f:
            return np.frombuffer(f.read_at(width * int(record["n_tokens"]), width * int(record["offset"])), self.dtype)


def write_store(
    docs: DataFrame,
    root: str,
    tokenizer_file: str,
    end_id: int,
    shard_bytes: int = 32 << 20,
    bucket_keys: int = 1 << 15,
    cached_words: int = 300_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[TokenStore, DataFrame]:
    """Write every document's ids and the index; returns the store and its catalog.

    Documents are put in order of id (null last, equal ids by text digest) by
    range partitioning; each range becomes one raw file of ids. The number of
    ranges follows the bytes of text. A null text counts as empty and yields the
    end id alone. The index holds the first document of each id; the catalog has
    every row: ``doc_id``, ``td1``, ``td2``, ``shard``, ``offset`` and
    ``n_tokens`` (in ids) and ``keyed``, whether the index leads to it.
    """
    spark = docs.sparkSession
    root = qualified(spark, root)
    fs, path = _open(root)
    fs.create_dir(path, recursive=True)
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), *digest(text, "t"), text.alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_last(), F.col("td1").asc(), F.col("td2").asc()]
    ordered = source.repartitionByRange(1 + size // shard_bytes, *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_file, end_id, cached_words)
        shard, width, rows = TaskContext.get().partitionId(), len(encoder.end), []

        def chunks() -> Iterator[bytes]:
            offset = 0
            for batch in slices(batches, "text"):
                ids = encoder.encode(text_bytes(batch["text"]))
                n = np.fromiter(map(len, ids), np.int64, len(ids)) // width
                starts = offset + np.cumsum(n) - n
                offset += int(n.sum())
                shards = np.full(len(n), shard, np.int64)
                columns = [batch["doc_id"], batch["td1"], batch["td2"], *map(pa.array, (shards, starts, n))]
                rows.append(pa.RecordBatch.from_arrays(columns, names=["doc_id", "td1", "td2", "shard", "offset", "n_tokens"]))
                yield b"".join(ids)

        payload = chunks()
        first = next(payload, None)
        if first is not None:
            _write_whole(_shard_file(root, shard), _chain(first, payload))
        yield from rows

    written = ordered.mapInArrow(write, "doc_id long, td1 long, td2 long, shard long, offset long, n_tokens long")
    catalog = materialize(written, "catalog")
    place = F.struct("shard", "offset")
    firsts = catalog.where("doc_id is not null").groupBy("doc_id").agg(
        F.min(F.struct("shard", "offset", "n_tokens")).alias("at")
    )
    firsts = materialize(firsts.select("doc_id", "at.*"), "first_documents")
    buckets = 1 + firsts.count() // bucket_keys
    store = TokenStore(root, id_type(tokenizer_file, end_id), buckets)
    _write_whole(f"{root}/manifest.json", iter([json.dumps({"dtype": store.dtype, "buckets": buckets}).encode()]))

    def index(key: tuple, table: pa.Table) -> pa.Table:
        keys = table["doc_id"].to_numpy()
        perfect = PerfectHash.build(keys)
        records = np.zeros(len(keys), RECORD)
        slots = perfect.slots(keys)
        records["fingerprint"][slots] = _fingerprint(keys)
        for column in ("shard", "offset", "n_tokens"):
            records[column][slots] = table[column].to_numpy()
        _write_whole(_index_file(root, key[0].as_py()), iter([perfect.dump(), records.tobytes()]))
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([len(keys)], pa.int64())})

    built = _bucketed(firsts, buckets).groupBy("bucket").applyInArrow(index, "bucket long, n long")
    materialize(built, "index_files")
    marked = catalog.join(firsts.select("doc_id", place.alias("first")), "doc_id", "left")
    catalog = marked.withColumn("keyed", F.coalesce(F.col("first") == place, F.lit(False))).drop("first")
    return store, catalog


def _chain(first: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield first
    yield from rest


def _bucketed(keys: DataFrame, buckets: int) -> DataFrame:
    """Adds each key's bucket, as ``TokenStore.get`` computes it."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = (_mixed(batch["doc_id"].to_numpy(), 1 << 21) % np.uint64(buckets)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bucket)], names=[*batch.schema.names, "bucket"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keys.schema)
    return keys.mapInArrow(add, f"{fields}, bucket long")


def locate(keys: DataFrame, store: TokenStore) -> DataFrame:
    """``doc_id``, ``shard``, ``offset``, ``n_tokens`` of the keys that are stored, by the index.

    Keys meet their bucket's index file in one task; each costs a constant
    number of steps. Null keys and keys whose fingerprint differs are left out.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, keys = batch["bucket"].to_numpy(), batch["doc_id"].to_numpy()
            for bucket in np.unique(buckets):
                mine = keys[buckets == bucket]
                found, records = store.find(int(bucket), mine)
                columns = [mine[found], *(records[c][found].astype(np.int64) for c in ("shard", "offset", "n_tokens"))]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["doc_id", "shard", "offset", "n_tokens"])

    wanted = _bucketed(keys.select(F.col("doc_id").cast("long")).where("doc_id is not null"), store.buckets)
    return wanted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(find, LOCATION)


def read_payloads(places: DataFrame, store: TokenStore) -> DataFrame:
    """Adds ``ids_crc32``, computed from each place's ids as read from its shard file.

    The ids count as little-endian unsigned 32-bit integers, whatever their
    width in the file. Places are read file by file in order of offset.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.dtype(store.dtype).itemsize
        shard, file = None, None
        for batch in batches:
            sums = []
            for s, offset, n in zip(*(batch[c].to_pylist() for c in ("shard", "offset", "n_tokens")), strict=True):
                if s != shard:
                    fs, path = _open(_shard_file(store.root, s))
                    shard, file = s, fs.open_input_file(path)
                ids = np.frombuffer(file.read_at(width * n, width * offset), store.dtype)
                sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], names=[*batch.schema.names, "ids_crc32"])

    dealt = places.select("doc_id", "shard", "offset", "n_tokens").repartition("shard").sortWithinPartitions("shard", "offset")
    return dealt.mapInArrow(read, f"{LOCATION}, ids_crc32 long")


def shard_starts(catalog: DataFrame) -> DataFrame:
    """``shard`` and ``base``, the ids in all shards before it (a row per file)."""
    totals = catalog.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_back(store: TokenStore, catalog: DataFrame) -> DataFrame:
    """Every document from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    Ids are looked up in the index; only rows that no key leads to (null ids,
    further rows of an id) are read where the catalog has them.
    """
    by_key = locate(catalog.where("keyed").select("doc_id"), store)
    others = catalog.where(~F.col("keyed")).select("doc_id", "shard", "offset", "n_tokens")
    read = read_payloads(by_key.unionByName(others), store).join(shard_starts(catalog), "shard")
    return read.select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
