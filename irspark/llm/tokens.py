"""Token files: directly addressable codes, from which any token can be read by itself.

A segment holds the ids of whole documents. Each id is split into chunks of eight bits; level 0
holds the lowest chunk of every id, a level above the next chunk of those ids that have one. A
bitmap per level says which ids go on, and a rank directory (set bits before every 512) leads to
their place in the next level. Token i is read with one byte and one rank per level; no block is
decoded.

Layout of a segment, little-endian: `DAC1`, uint32 number of documents, uint64 number of ids,
uint32 number of levels; per document int64 doc_id, uint8 whether it is null, int64 ids; then per
level uint64 number of chunks, the chunks, the bitmap padded to 64 bytes, the rank directory as
uint64. Segments are rows of a Parquet table, so any file system of Spark's can hold them and a
repeated task leaves no half-written file behind.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from irspark.llm.batches import slices
from irspark.plans.lineage import checkpoint_dir
from irspark.plans.ordering import prefix_sum

_MAGIC = b"DAC1"
_HEAD = struct.Struct("<4sIQI")
_DOC = np.dtype([("doc_id", "<i8"), ("is_null", "u1"), ("n", "<i8")])
_RANK = 64  # bytes of bitmap per entry of the rank directory
_SEGMENT_IDS = 1_000_000
_PIECES_KEPT = 400_000
# Bytes of text that are cut into pieces at once.
_TEXT_BYTES = 4_000_000
_PIECE_BYTES = 64
# Marks between an ASCII or Latin-1 letter or a digit and white space or the end; an apostrophe
# may begin a suffix. The search looks for the first mark, then back: marks are rarer than letters.
_MARK = rb"[^\sa-z0-9\x80-\xff']"
_LAST_MARKS = re.compile(
    _MARK + rb"(?:(?<=[a-z0-9].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))" + _MARK + rb"*(?=\s|\Z)", re.DOTALL)
# One word of such letters, which composition leaves alone.
_LETTERS = re.compile(r"[a-zß-öø-ÿ]+")


def _byte_symbols() -> dict[int, int]:
    """The printable character that stands for each byte: itself, or the next one from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = itertools.count(0x100)
    return {b: b if b in plain else next(others) for b in range(256)}


_SYMBOLS = _byte_symbols()


def pack(docs: Sequence[tuple[int | None, np.ndarray]]) -> bytes:
    """One segment from (doc_id, ids) pairs."""
    index = np.array([(0 if d is None else d, d is None, len(ids)) for d, ids in docs], _DOC)
    rest = np.concatenate([ids for _, ids in docs]).astype(np.uint32) if docs else np.zeros(0, np.uint32)
    total, levels, body = len(rest), 0, []
    while len(rest):
        more = rest >> 8
        goes_on = more > 0
        bitmap = np.packbits(goes_on, bitorder="little")
        bitmap = np.pad(bitmap, (0, -len(bitmap) % _RANK))
        ones = np.bitwise_count(bitmap).reshape(-1, _RANK).sum(axis=1, dtype=np.uint64)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u8")
        body += [struct.pack("<Q", len(rest)), (rest & 255).astype(np.uint8).tobytes(), bitmap.tobytes(),
                 ranks.tobytes()]
        rest, levels = more[goes_on], levels + 1
    return b"".join([_HEAD.pack(_MAGIC, len(index), total, levels), index.tobytes(), *body])


class Segment:
    """Reader of one segment."""

    def __init__(self, data: bytes):
        magic, n_docs, self.n_ids, n_levels = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a segment of token ids")
        at = _HEAD.size
        self.docs = np.frombuffer(data, _DOC, n_docs, at)
        at += self.docs.nbytes
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            bits = -(-n // 8 // _RANK) * _RANK if n % 8 == 0 else -(-(n // 8 + 1) // _RANK) * _RANK
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bitmap = np.frombuffer(data, np.uint8, bits, at + 8 + n)
            ranks = np.frombuffer(data, "<u8", bits // _RANK, at + 8 + n + bits)
            self.levels.append((chunks, bitmap, ranks))
            at += 8 + n + bits + ranks.nbytes

    def token(self, i: int) -> int:
        """Id number `i` of the segment, by one byte and one rank for each of its chunks."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = shift = 0
        for chunks, bitmap, ranks in self.levels:
            value |= int(chunks[i]) << shift
            byte, bit = divmod(i, 8)
            if not bitmap[byte] >> bit & 1:
                break
            block = byte // _RANK
            before = int(np.bitwise_count(bitmap[block * _RANK : byte]).sum(dtype=np.int64))
            i = int(ranks[block]) + before + int(bitmap[byte] & ((1 << bit) - 1)).bit_count()
            shift += 8
        return value

    def ids(self) -> np.ndarray:
        """All ids in order."""
        above = np.zeros(0, np.uint32)
        for chunks, bitmap, _ in reversed(self.levels):
            values = chunks.astype(np.uint32)
            goes_on = np.unpackbits(bitmap, count=len(chunks), bitorder="little").astype(bool)
            values[goes_on] |= above << 8
            above = values
        return above.astype("<u4")


class LibraryEncoder:
    """The tokenizers library, asked once for each frequent piece of text.

    Texts are cut where no token can reach over: at ASCII white space, and before punctuation
    between a Latin letter or digit and such white space. Case is folded before, as the library
    would do, so that more pieces are equal.
    """

    def __init__(self, vocabulary: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use every core
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(vocabulary)
        self._library.no_truncation()
        self._library.no_padding()
        self._model = self._library.model
        self._kept: dict[bytes, bytes] = {}

    def _pieces(self, text: bytes) -> list[bytes]:
        folded = text.lower()
        if b"<|" in folded:  # names of special tokens keep their case
            return text.split()
        return _LAST_MARKS.sub(rb" \g<0>", folded).split()

    def _new(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of the pieces; words of plain letters go to the library's model directly."""
        out, others, tokenize = {}, [], self._model.tokenize
        for p in pieces:
            if p.isalpha() and p.islower():  # of bytes, these mean a to z
                out[p] = array("I", [t.id for t in tokenize(p.decode())]).tobytes()
            elif _LETTERS.fullmatch(word := p.decode().lower()):
                symbols = word.encode().decode("latin-1").translate(_SYMBOLS)
                out[p] = array("I", [t.id for t in tokenize(symbols)]).tobytes()
            else:
                others.append(p)
        found = self._library.encode_batch_fast([p.decode() for p in others], add_special_tokens=False)
        return out | {p: array("I", e.ids).tobytes() for p, e in zip(others, found)}

    def encode(self, texts: Sequence[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split, kept = [self._pieces(t) for t in texts], self._kept
        room = _PIECES_KEPT - len(kept)
        new = self._new(list(set().union(*split) - kept.keys()))
        kept.update(new)
        out = [b"".join(map(kept.__getitem__, pieces)) for pieces in split]
        for i, p in enumerate(new):
            if i >= room or len(p) > _PIECE_BYTES:
                del kept[p]
        return out


@functools.lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> LibraryEncoder:
    return LibraryEncoder(vocabulary)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int | None = None,
                 doc_id: str = "doc_id", text: str = "text", segment_ids: int = _SEGMENT_IDS) -> None:
    """Encode every text and write the ids in ascending order of the document's id.

    Rows are range-partitioned by id, rows of one id (or without one, which come last) by a hash
    of their text, so that no id makes a large partition. The text is encoded after the shuffle,
    in the task that writes it. A segment is closed once it holds `segment_ids` ids; a document
    stays whole. A null text counts as empty: it has no ids but the end id. Repeated rows are
    written as often as they come; other columns are not read. An empty table gives no segment.
    """
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(Path(vocabulary).read_text(encoding="utf-8"))
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, number = _encoder(content.value), TaskContext.get().partitionId(), 0
        waiting, held = [], 0

        def close() -> pa.RecordBatch:
            row = [[part], [number], [len(waiting)], [held], [pack(waiting)]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)],
                                              names=["part", "number", "n_docs", "n_ids", "segment"])

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            for first, end_row in slices(texts, _TEXT_BYTES):
                some = [t or b"" for t in texts.slice(first, end_row - first).to_pylist()]
                for key, ids in zip(keys[first:end_row], encoder.encode(some)):
                    ids = np.frombuffer(ids + end, "<u4")
                    waiting.append((key, ids))
                    held += len(ids)
                    if held >= segment_ids:
                        yield close()
                        waiting, held, number = [], 0, number + 1
        if waiting:
            yield close()

    spread = F.xxhash64("t")
    (
        docs.select(F.col(doc_id).cast("bigint").alias("d"), F.col(text).cast("string").alias("t"))
        .repartitionByRange(F.col("d").asc_nulls_last(), spread)
        .sortWithinPartitions(F.col("d").asc_nulls_last(), spread)
        .mapInArrow(run, "part bigint, number bigint, n_docs bigint, n_ids bigint, segment binary")
        .write.parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start (ids before it), n_tokens, ids_crc32."""
    files = spark.read.parquet(path)
    # One narrow row per segment; segments are numbered within the range partition that wrote them.
    sizes = files.select("part", "number", "n_ids")
    ends = prefix_sum(sizes, [], [F.col("part"), F.col("number")], {"_end": F.col("n_ids")})
    starts = ends.select("part", "number", (F.col("_end") - F.col("n_ids")).alias("_start"))
    placed = files.select("part", "number", "segment").join(starts, ["part", "number"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                segment = Segment(data.as_py())
                ids = segment.ids()
                ends = np.cumsum(segment.docs["n"])
                begins = ends - segment.docs["n"]
                crcs = [zlib.crc32(ids[b:e].tobytes()) for b, e in zip(begins, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(segment.docs["doc_id"], pa.int64(), mask=segment.docs["is_null"] == 1),
                     pa.array(begins + start, pa.int64()), pa.array(segment.docs["n"], pa.int64()),
                     pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.select("_start", "segment").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_path(spark: SparkSession) -> str:
    """A new folder for token files beside the checkpoints, which all executors share."""
    return f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
