"""Token-id shards with a minimal perfect hash index.

Layout of one shard: ``NNNNNN.ids`` holds the raw ids of its documents one
after another (little-endian, 2 bytes an id where the vocabulary allows, else
4); ``NNNNNN.index`` maps a document key to the id offset and length in
constant time; ``NNNNNN.keys`` lists the keys for enumeration.  Shards follow
each other in ascending key order, about ``SHARD_BYTES`` of input each, and a
manifest row tells each shard's bounds.

The index is a cascade of bit arrays: at level L a key hashes to one bit; keys
that are alone on their bit are settled, the others go to the next level.  A
key's slot is the number of settled bits before its own, so n keys fill the
slots 0 to n - 1 without gaps.  The bits are stored in blocks of ``BLOCK`` with
the number of settled bits before each, so a lookup reads the header, one block
a level (under two on average) and one record, whatever the size of the shard.
Each slot's record has a 32-bit fingerprint of its key, the length and the
offset; a key that was never stored is told by its fingerprint but for one case
in 2**32.

Defined results: null text is the end id alone; a repeated key is stored once
for each occurrence (key, 0), (key, 1) ...; a null key sorts first.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, Scratch, mix, parts_of, short_batches, table
from .tokens import default_vocabulary, encoder

GAMMA = 1.6
MAGIC = b"PLMPH002"
#: Bits that share a stored rank.
BLOCK = 512
_RECORD = np.dtype([("print", "<u4"), ("length", "<u4"), ("offset", "<i8")])
#: Bytes of input (compressed) in a shard.
SHARD_BYTES = 16 << 20


def key_hash(key, occurrence: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(f"{'n' if key is None else 'k' + str(key)}\0{occurrence}")


class PerfectHash:
    """A minimal perfect hash over distinct 64-bit hashes."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # of bool
        counts = [np.concatenate(([0], np.cumsum(bits))) for bits in levels]
        base = np.cumsum([0, *(int(c[-1]) for c in counts)])
        self.ranks = [c[:-1] + b for c, b in zip(counts, base)]
        self.size = int(base[-1])

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        levels, left = [], np.asarray(hashes, dtype=U64)
        while len(left):
            if len(levels) > 200:
                raise ValueError("two keys have the same 64-bit hash")
            bits = max(64, int(len(left) * GAMMA))
            at = cls._slot(left, len(levels), bits)
            alone = np.bincount(at, minlength=bits) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    @staticmethod
    def _slot(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
        return (mix(hashes + U64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % U64(bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash; -1 where no level has its bit."""
        hashes = np.asarray(hashes, dtype=U64)
        out = np.full(len(hashes), -1, dtype=np.int64)
        left = np.arange(len(hashes))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            if not len(left):
                break
            at = self._slot(hashes[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = ranks[at[hit]]
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        """The number of levels, the bits of each, and each level's blocks: a rank and the bits."""
        out = [struct.pack("<q", len(self.levels)), *(struct.pack("<q", len(bits)) for bits in self.levels)]
        for bits, ranks in zip(self.levels, self.ranks):
            n = -(-len(bits) // BLOCK)
            blocks = np.zeros((n, 1 + BLOCK // 64), dtype="<u8")
            blocks[:, 0] = ranks[::BLOCK]
            blocks[:, 1:] = np.packbits(np.pad(bits, (0, n * BLOCK - len(bits))), bitorder="little").view("<u8").reshape(n, -1)
            out.append(blocks.tobytes())
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[PerfectHash, int]:
        (n,) = struct.unpack_from("<q", data)
        sizes, at, levels = struct.unpack_from(f"<{n}q", data, 8), 8 + 8 * n, []
        for bits in sizes:
            blocks = np.frombuffer(data, "<u8", -(-bits // BLOCK) * (1 + BLOCK // 64), at).reshape(-1, 1 + BLOCK // 64)
            levels.append(np.unpackbits(np.ascontiguousarray(blocks[:, 1:]).view(np.uint8).reshape(-1), count=bits, bitorder="little").astype(bool))
            at += blocks.nbytes
        return cls(levels), at


class RangedHash:
    """The same, read from a file a block at a time; ``read(at, size)`` gives bytes from where it was stored."""

    def __init__(self, read):
        self.read = read
        (n,) = struct.unpack("<q", read(0, 8))
        self.sizes = struct.unpack(f"<{n}q", read(8, 8 * n))
        self.starts = np.cumsum([8 + 8 * n, *(-(-b // BLOCK) * (8 + BLOCK // 8) for b in self.sizes)]).tolist()
        self.end = self.starts[-1]

    def find(self, key: int) -> int:
        for level, bits in enumerate(self.sizes):
            at = int(PerfectHash._slot(np.array([key], dtype=U64), level, bits)[0])
            block = self.read(self.starts[level] + at // BLOCK * (8 + BLOCK // 8), 8 + BLOCK // 8)
            within = int.from_bytes(block[8:], "little")
            if within >> (at % BLOCK) & 1:
                return int.from_bytes(block[:8], "little") + (within & ((1 << (at % BLOCK)) - 1)).bit_count()
        return -1


def _fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ U64(0xD6E8FEB86659FD93)) >> U64(32)).astype("<u4")


class ShardIndex:
    """Key -> (offset, length) of one shard, both in ids."""

    def __init__(self, perfect: PerfectHash, prints: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, width: int):
        self.perfect, self.prints, self.offsets, self.lengths, self.width = perfect, prints, offsets, lengths, width

    @classmethod
    def build(cls, hashes: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, width: int) -> ShardIndex:
        perfect = PerfectHash.build(hashes)
        slot = perfect.find(hashes)
        back = np.empty(len(hashes), dtype=np.int64)
        back[slot] = np.arange(len(hashes))
        return cls(perfect, _fingerprints(hashes)[back], offsets.astype("<i8")[back], lengths.astype("<i8")[back], width)

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and lengths; offset -1 where the key isn't stored."""
        hashes = np.asarray(hashes, dtype=U64)
        if not self.perfect.size:
            return np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        slot = self.perfect.find(hashes)
        found = (slot >= 0) & (self.prints[slot] == _fingerprints(hashes))
        return np.where(found, self.offsets[slot], -1), np.where(found, self.lengths[slot], 0)

    def to_bytes(self) -> bytes:
        records = np.empty(self.perfect.size, dtype=_RECORD)
        records["print"], records["length"], records["offset"] = self.prints, self.lengths, self.offsets
        return b"".join([MAGIC, struct.pack("<qq", self.perfect.size, self.width), self.perfect.to_bytes(), records.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> ShardIndex:
        if data[:8] != MAGIC:
            raise ValueError("not a shard index")
        size, width = struct.unpack_from("<qq", data, 8)
        perfect, at = PerfectHash.from_bytes(data[24:])
        records = np.frombuffer(data, _RECORD, size, at + 24)
        return cls(perfect, records["print"], records["offset"], records["length"].astype("<i8"), width)


def _files(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Writer:
    """A file that takes its place when it is closed."""

    def __init__(self, path: str):
        self.files, self.at = _files(path)
        self.tmp = f"{self.at}.{uuid.uuid4().hex}.tmp"
        self.files.create_dir(self.at.rsplit("/", 1)[0], recursive=True)
        self.stream = self.files.open_output_stream(self.tmp)
        self.write = self.stream.write

    def close(self) -> None:
        self.stream.close()
        self.files.move(self.tmp, self.at)


def _read(path: str) -> bytes:
    files, at = _files(path)
    with files.open_input_stream(at) as f:
        return f.read()


def id_width(vocabulary: str, end_id: int) -> int:
    """Bytes that hold every id of a vocabulary."""
    return 2 if max(encoder(vocabulary).library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4


_KINDS = {2: "<u2", 4: "<u4"}


def narrow(payload: bytes, width: int) -> bytes:
    """Ids of four bytes in ``width`` bytes each; ids that don't fit raise."""
    ids = np.frombuffer(payload, "<u4")
    if width == 2 and len(ids) and int(ids.max()) > 0xFFFF:
        raise ValueError(f"id {int(ids.max())} doesn't fit in two bytes")
    return ids.astype(_KINDS[width]).tobytes()


def _keys_to_bytes(keys: list[int | None]) -> bytes:
    """How many, which are null (a byte each), the keys as longs."""
    return struct.pack("<q", len(keys)) + bytes(k is None for k in keys) + np.array([k or 0 for k in keys], dtype="<i8").tobytes()


def _keys_from_bytes(data: bytes) -> list[int | None]:
    (n,) = struct.unpack_from("<q", data)
    return [None if null else k for null, k in zip(data[8 : 8 + n], np.frombuffer(data, "<i8", n, 8 + n).tolist())]


def write_shards(docs: DataFrame, out: str, end_id: int = 0, vocabulary: str | None = None, width: int | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the shards of ``docs`` (doc_id, text) under ``out``; one manifest row for each shard, lazily.

    ``width``: bytes an id, by the vocabulary's size if not given; ids that don't fit raise.
    """
    vocabulary = vocabulary or default_vocabulary()
    end = np.array([end_id], dtype="<u4").tobytes()
    width = width or id_width(vocabulary, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ids, shard = encoder(vocabulary), None, None
        keys, hashes, lengths, last, again = [], [], [], (), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if ids is None:
                shard = batch.column(2)[0].as_py()
                ids = _Writer(f"{out}/{shard:06d}.ids")
            column = batch.column(0).to_pylist()
            for key, payload in zip(column, encode.payloads(batch.column(1).to_pylist())):
                payload += end
                again = again + 1 if last == (key,) else 0
                last = (key,)
                keys.append(key)
                hashes.append(key_hash(key, again))
                lengths.append(len(payload) // 4)
                ids.write(narrow(payload, width))
        if ids is None:
            return
        ids.close()
        sizes = np.array(lengths, dtype=np.int64)
        index = ShardIndex.build(np.array(hashes, dtype=U64), np.cumsum(sizes) - sizes, sizes, width)
        for name, data in (("index", index.to_bytes()), ("keys", _keys_to_bytes(keys))):
            f = _Writer(f"{out}/{shard:06d}.{name}")
            f.write(data)
            f.close()
        yield pa.RecordBatch.from_pydict({"shard": [shard], "n_docs": [len(keys)], "n_tokens": [int(sizes.sum())]}, schema=pa.schema([("shard", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    spark = docs.sparkSession
    short_batches(spark)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts_of(docs, shard_bytes))
    ordered = docs.select("doc_id", "text").repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id")
    # the number of the partition comes with its rows: a task may hold several partitions
    return ordered.select("doc_id", "text", F.spark_partition_id().alias("__part")).mapInArrow(run, "shard long, n_docs long, n_tokens long")


def read_shards(manifest: DataFrame, out: str) -> DataFrame:
    """Every document of the shards, by its key through the index: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                index = ShardIndex.from_bytes(_read(f"{out}/{shard:06d}.index"))
                keys = _keys_from_bytes(_read(f"{out}/{shard:06d}.keys"))
                hashes, last, again = [], (), 0
                for key in keys:
                    again = again + 1 if last == (key,) else 0
                    last = (key,)
                    hashes.append(key_hash(key, again))
                offsets, lengths = index.lookup(np.array(hashes, dtype=U64))
                kind = _KINDS[index.width]
                sums = np.zeros(len(keys), dtype=np.int64)
                files, at = _files(f"{out}/{shard:06d}.ids")
                with files.open_input_file(at) as f:
                    for i, (offset, n) in enumerate(zip(offsets.tolist(), lengths.tolist())):
                        if offset < 0:
                            raise ValueError(f"key {keys[i]} isn't in shard {shard}")
                        if f.tell() != offset * index.width:
                            f.seek(offset * index.width)
                        sums[i] = zlib.crc32(np.frombuffer(f.read(n * index.width), kind).astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(offsets + start), pa.array(lengths.astype(np.int64)), pa.array(sums)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.select("shard", "start").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(out: str, shard: int, key, occurrence: int = 0) -> np.ndarray | None:
    """The ids of one document by a few ranged reads, however many the shard holds; None if the key isn't stored."""
    files, at = _files(f"{out}/{shard:06d}.index")
    wanted = key_hash(key, occurrence)
    with files.open_input_file(at) as f:
        head = f.read_at(24, 0)
        if head[:8] != MAGIC:
            raise ValueError("not a shard index")
        size, width = struct.unpack_from("<qq", head, 8)
        perfect = RangedHash(lambda start, n: f.read_at(n, 24 + start))
        slot = perfect.find(wanted) if size else -1
        if slot < 0:
            return None
        (record,) = np.frombuffer(f.read_at(_RECORD.itemsize, 24 + perfect.end + slot * _RECORD.itemsize), _RECORD)
    if record["print"] != _fingerprints(np.array([wanted], dtype=U64))[0]:
        return None
    files, at = _files(f"{out}/{shard:06d}.ids")
    with files.open_input_file(at) as f:
        return np.frombuffer(f.read_at(int(record["length"]) * width, int(record["offset"]) * width), _KINDS[width])


def token_shards(docs: DataFrame, scratch: Scratch, **options) -> tuple[DataFrame, str]:
    """The manifest with each shard's first global position, and the shards' folder."""
    out = scratch.path("shards")
    manifest = scratch.stage(write_shards(docs, out, **options), "manifest")
    # a row for each shard: the running sum over all of them is small
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), out


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, out = token_shards(table(spark, sf_dir, "documents"), Scratch(spark, "op6"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_shards(manifest.repartition(tasks, "shard"), out)
