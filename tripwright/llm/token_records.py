"""Token ids of whole documents in length-delimited binary records, with an offset index.

A file is a sequence of records; all numbers are little-endian:

    length     uint64   bytes of the payload
    check      uint32   masked CRC-32 of the eight length bytes
    payload    doc_id int64, flags uint16 (bit 0: doc_id is null, bit 1: ids are 4 bytes wide),
               then the ids, 2 bytes each where the vocabulary allows it, else 4
    check      uint32   masked CRC-32 of the payload
    end        one line feed

The mask is a rotation by 15 bits plus a constant, so that a checksum over data that itself holds
checksums stays sound. Files are written by Spark's own text writer (a record is a "line"), so any
store Spark reaches can hold them and a lost or speculative task leaves nothing behind. File
``part-N`` holds a contiguous range of doc_id in ascending order, and ranges ascend with N.

The index is a Parquet table beside the records: doc_id, file, offset, length, shard, start,
n_tokens, ids_crc32. A reader that wants documents in another order sorts the index and seeks.

The string of a special token in a text is that token, as the library has it. Null texts are empty
documents (only the end id); a null doc_id sorts first and is kept; rows that
repeat a doc_id are all kept, ordered by a hash of their text; an empty table gives no record and
an empty index; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwright.llm.common import KEPT, arrow_rows, big_enough, lean, share
from tripwright.llm.words import SLICE_BYTES, run_hashes, slices, text_bytes

_MASK = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_ID = struct.Struct("<qH")
_CHECK = struct.Struct("<I")
NULL_ID, WIDE = 1, 2
#: Parts of texts that the Python workers of an executor remember the ids of together, at about
#: 40 bytes each.
CACHE_PARTS = 3_000_000
#: Texts that a worker takes, and records that it gives, at a time.
BATCH_ROWS = 1024
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?"]] = True


class CorruptRecord(ValueError):
    """A record's lengths or checksums don't fit its bytes."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, wide: bool) -> bytes:
    flags = (NULL_ID if doc_id is None else 0) | (WIDE if wide else 0)
    payload = _ID.pack(doc_id or 0, flags) + ids
    size = struct.pack("<Q", len(payload))
    return b"".join(
        (size, _CHECK.pack(masked(size)), payload, _CHECK.pack(masked(payload)), b"\n")
    )


def records(data: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """Offset, length, doc_id and ids of each record of a file, checked."""
    at, end = 0, len(data)
    while at < end:
        if end - at < _HEAD.size:
            raise CorruptRecord(f"cut head at {at}")
        size, check = _HEAD.unpack_from(data, at)
        if check != masked(data[at : at + 8]):
            raise CorruptRecord(f"length at {at}")
        body = at + _HEAD.size
        after = body + size + _CHECK.size + 1
        payload = data[body : body + size]
        if after > end or size < _ID.size or data[after - 1] != 10:
            raise CorruptRecord(f"cut record at {at}")
        if _CHECK.unpack_from(data, body + size)[0] != masked(payload):
            raise CorruptRecord(f"payload at {at}")
        doc_id, flags = _ID.unpack_from(payload)
        ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=_ID.size)
        yield at, after - at, None if flags & NULL_ID else doc_id, ids
        at = after


class Encoder:
    """Ids of whole texts through a byte-level tokenizer, with the parts seen lately remembered.

    Such a vocabulary begins a piece at some places whatever stands around them (``_cuts``). Texts
    are cut there, equal parts of a slice are encoded once, and the parts met before come from a
    store of fixed size. Parts are told apart by 64-bit hashes. If the vocabulary isn't of that
    kind, nothing is cut.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.wide = len(vocabulary) > 1 << 16
        self.dtype = "<u4" if self.wide else "<u2"
        # Only the first token of a piece that begins with a space holds that space.
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.dtype)

    def _encode(self, parts: list[str]) -> list[np.ndarray]:
        done = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype) for x in done]

    def _learn(self, hashes: np.ndarray, parts: list[str]) -> None:
        """Remember parts that aren't known yet; hashes ascend."""
        plain = [i for i, x in enumerate(parts) if x[:1] == " " and x.count(" ") == 1]
        other = sorted(set(range(len(parts))).difference(plain))
        found, counts = [self.ids], []
        for low in range(0, len(plain), 4096):
            some = [parts[i] for i in plain[low : low + 4096]]
            (ids,) = self._encode(["".join(some)])
            edges = np.flatnonzero(self.opens[ids])
            if len(edges) != len(some):
                pieces = self._encode(some)
                ids, edges = np.concatenate(pieces), np.cumsum([0, *map(len, pieces[:-1])])
            found.append(ids)
            counts.append(np.diff(np.append(edges, len(ids))))
        for ids in self._encode([parts[i] for i in other]):
            found.append(ids)
            counts.append(np.array([len(ids)]))
        sizes, at = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        order = np.array(plain + other)
        sizes[order] = np.concatenate(counts)
        at[order] = len(self.ids) + np.cumsum(sizes[order]) - sizes[order]
        self.ids = np.concatenate(found)
        place = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, place, hashes)
        self.at, self.sizes = np.insert(self.at, place, at), np.insert(self.sizes, place, sizes)

    def _cuts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Places where a piece begins, whatever stands around.

        These are a space, or a line feed and what follows it, between two characters that aren't
        white space, and a mark that follows an ASCII letter.
        """
        if not self.opens.any():
            return np.zeros(0, np.int64)
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        at = np.flatnonzero((data == 0x20) | (data == 0x0A))
        at = at[~edge[at] & ~edge[at + 1]]
        before, after = data[at - 1], data[at + 1]
        # Beyond ASCII, what may begin or end a white space character counts as one.
        two = np.where(edge[at - 1], 0, data[np.maximum(at - 2, 0)])
        three = data[np.maximum(at - 3, 0)]
        wide = ((two == 0xC2) & ((before == 0x85) | (before == 0xA0))) | (
            (before >= 0x80) & (three >= 0xE1) & (three <= 0xE3)
        )
        wide |= (after == 0xC2) | ((after >= 0xE1) & (after <= 0xE3))
        at = at[~(_BLANK[before] | _BLANK[after] | wide)]
        marks = np.flatnonzero(_MARK[data])
        marks = marks[~edge[marks]]
        marks = marks[_LETTER[data[marks - 1]]]
        return np.concatenate([at, at[data[at] == 0x0A] + 1, marks])

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        raw, offsets = text_bytes(texts)
        for low, high in slices(offsets, SLICE_BYTES // 2):
            data = raw[offsets[low] : offsets[high]]
            bounds = offsets[low : high + 1] - offsets[low]
            opening = np.zeros(len(data) + 1, bool)
            opening[bounds] = True
            opening[self._cuts(data, bounds)] = True
            begins = np.flatnonzero(opening[:-1])
            ends = np.append(begins[1:], len(data))[: len(begins)]
            keys, first, which = np.unique(
                run_hashes(data, begins, ends), return_index=True, return_inverse=True
            )
            if len(self.hashes) > share(CACHE_PARTS):
                self._forget()
            place = np.minimum(np.searchsorted(self.hashes, keys), max(0, len(self.hashes) - 1))
            new = self.hashes[place] != keys if len(self.hashes) else np.ones(len(keys), bool)
            if new.any():
                spans = zip(begins[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
                self._learn(keys[new], [data[a:b].tobytes().decode() for a, b in spans])
                place = np.searchsorted(self.hashes, keys)
            sizes = self.sizes[place][which]
            upto = np.concatenate([[0], np.cumsum(sizes)])
            from_at = np.repeat(self.at[place][which] - upto[:-1], sizes)
            ids = self.ids[from_at + np.arange(upto[-1])]
            edges = upto[np.searchsorted(begins, bounds)].tolist()
            for a, b in zip(edges, edges[1:], strict=False):
                yield ids[a:b]


def _encoder(path: str) -> Encoder:
    if path not in KEPT:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        KEPT[path] = Encoder(path)
    return KEPT[path]


def write_records(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    shard_chars: int = 8_000_000,
    order: Sequence[str] = ("doc_id",),
) -> None:
    """Encode every text and write ``path/records`` and ``path/index``.

    ``order`` names the columns to write in ascending order of, doc_id if not given. The one
    shuffle deals texts by range of them; about ``shard_chars`` characters make a file.
    """
    spark = docs.sparkSession
    total = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count(F.lit(1))).first()
    keys = [f"order{i}" for i in range(len(order))]
    keyed = docs.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(order, keys, strict=True)],
        F.xxhash64("text").alias("tie"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    dealt = keyed.repartitionByRange(
        big_enough(total[0] + 16 * total[1], shard_chars), *keys, "tie"
    ).sortWithinPartitions(*keys, "tie")

    def encode(batches):
        encoder = _encoder(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in lean(batches, keep=tokenizer):
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                framed = [
                    frame(doc_id, x.tobytes() + end, encoder.wide)
                    for doc_id, x in zip(
                        part["doc_id"].to_pylist(), encoder(part["text"]), strict=True
                    )
                ]
                yield pa.RecordBatch.from_arrays([pa.array(framed, pa.binary())], ["record"])

    framed = dealt.select("doc_id", "text").mapInArrow(encode, "record binary")
    # The record's own last byte is the line feed that the writer adds.
    body = F.expr("substring(record, 1, length(record) - 1)")
    with arrow_rows(spark, BATCH_ROWS):
        framed.select(body.cast("string")).write.text(f"{path}/records")
    with arrow_rows(spark, 1):  # a whole file
        _index(spark, f"{path}/records").write.parquet(f"{path}/index")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .where("length > 0")
        .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "content")
    )


def _index(spark: SparkSession, path: str) -> DataFrame:
    """Read every record back, check it, and say where it lies."""

    def walk(batches):
        for batch in lean(batches):
            for at in range(batch.num_rows):
                name = batch["file"][at].as_py()
                rows, before = [], 0
                for offset, length, doc_id, ids in records(batch["content"][at].as_buffer()):
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((doc_id, offset, length, before, len(ids), crc))
                    before += len(ids)
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(rows))] + [pa.array(c, pa.int64()) for c in columns],
                    ["file", "doc_id", "offset", "length", "before", "n_tokens", "ids_crc32"],
                )

    schema = (
        "file string, doc_id long, offset long, length long, before long, n_tokens long, "
        "ids_crc32 long"
    )
    rows = _files(spark, path).mapInArrow(walk, schema)
    shard = F.regexp_extract("file", r"^part-(\d+)", 1).cast("int")
    piece = F.regexp_extract("file", r"-c(\d+)", 1)  # set where Spark cuts files by rows
    part = F.when(piece == "", F.lit("0")).otherwise(piece).cast("int")
    rows = rows.withColumns({"shard": shard, "part": part})
    # One row a file: the only window without a key.
    totals = rows.groupBy("shard", "part").agg(F.sum("n_tokens").alias("tokens"))
    ahead = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "shard", "part", F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("ahead")
    )
    return rows.join(totals, ["shard", "part"]).select(
        "doc_id",
        (F.col("ahead") + F.col("before")).alias("start"),
        "n_tokens",
        "ids_crc32",
        "shard",
        "file",
        "offset",
        "length",
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, ids, file and offset of every record, checked."""

    def walk(batches):
        for batch in lean(batches):
            for at in range(batch.num_rows):
                name = batch["file"][at].as_py()
                for offset, _, doc_id, ids in records(batch["content"][at].as_buffer()):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([doc_id], pa.int64()),
                            pa.array([ids.astype(np.int32)]),
                            pa.array([name]),
                            pa.array([offset], pa.int64()),
                        ],
                        ["doc_id", "ids", "file", "offset"],
                    )

    return _files(spark, f"{path}/records").mapInArrow(
        walk, "doc_id long, ids array<int>, file string, offset long"
    )


def shuffled_order(index: DataFrame, seed: int) -> DataFrame:
    """The index in a random order fixed by the seed: where to seek, record after record."""
    return index.orderBy(F.xxhash64(F.lit(seed), "file", "offset"), "file", "offset")
