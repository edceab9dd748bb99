"""Alignment of two tokenizers: which of their tokens cover the same bytes, over the whole corpus.

Tasks encode slices of documents. The linked id pairs of a slice, each with the number of its
documents, form a run, sorted by (first id, second id) and cut into radix parts by the first id;
parts are kept compressed. For every radix a heap merge of its runs adds up the counts, and as
all pairs of a first id come in a row, so does the highest of them. The totals then stream past
the parts again, and each run gets its counts back; documents never leave their run before that.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import json
import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from irspark.llm.batches import slices
from irspark.plans.lineage import materialize
from irspark.plans.ordering import row_index
from irspark.plans.skew import lookup_join

# Bytes of text in a run, and bytes that the libraries encode at once.
_RUN_BYTES, _CALL_BYTES = 2_000_000, 200_000
# Parts of a run, by the first id; bits of the second id in a pair.
_RADIX_BITS = 5
_RADICES = 1 << _RADIX_BITS
_SIDE_BITS = 32
# Runs that are merged at once, and parts that one task gives their totals back.
_FAN = 256
# Links of a group above which equal ids are counted before they are paired.
_WIDE = 1 << 16
# Fixed value: how byte-level vocabularies cut a text before they merge.
_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _gather(buffer: np.ndarray, offsets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bytes of the given places, one after the other."""
    ends = np.cumsum(sizes)
    if not len(ends):
        return np.zeros(0, np.uint8)
    at = np.repeat(offsets - ends + sizes, sizes)
    at += np.arange(ends[-1])
    return buffer[at]


class _Table:
    """Byte strings by number."""

    def __init__(self, values: list[bytes]):
        self.sizes = np.array([len(v) for v in values], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.buffer = np.frombuffer(b"".join(values), np.uint8)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        return _gather(self.buffer, self.offsets[ids], self.sizes[ids])


def _byte_symbols() -> dict[str, int]:
    """Characters that byte-level vocabularies write for bytes: printable ones are themselves."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _by_library(byte_level: str) -> Callable[[list[str]], list[np.ndarray]]:
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(byte_level)
    library.encode_special_tokens = True
    library.no_truncation()
    library.no_padding()
    return lambda texts: [np.array(e.ids, np.int64) for e in library.encode_batch_fast(texts, add_special_tokens=False)]


def _by_ranks(spec: dict, shown: list[bytes]) -> Callable[[list[str]], list[np.ndarray]] | None:
    """A faster encoder, for vocabularies whose ids ascend with the merges and that do nothing else."""
    import tiktoken

    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    plain = spec["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not (
        cut.get("add_prefix_space") or model.get("dropout") or model.get("ignore_merges"))
    if not plain or any(x >= y for x, y in itertools.pairwise(merged)):
        return None
    special = {t["id"] for t in spec["added_tokens"]}
    ranks = {t: i for i, t in enumerate(shown) if t and i not in special}
    if len(ranks) != len(merged) + 256:
        return None
    encoding = tiktoken.Encoding("byte_level", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [np.array(encoding.encode_ordinary(t), np.int64) for t in texts]


class Pair:
    """Two tokenizers: a byte-level one (json) and a sentence-piece model."""

    def __init__(self, byte_level: str, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        spec = json.loads(byte_level)
        symbols = _byte_symbols()
        ids = spec["model"]["vocab"]
        shown = [b""] * (1 + max(ids.values()))
        for token, i in ids.items():
            shown[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
        self._encode_a = _by_ranks(spec, shown) or _by_library(byte_level)
        self._b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.bytes_a = _Table(shown)
        pieces_ = [(self._b.id_to_piece(i), self._b.is_byte(i)) for i in range(self._b.get_piece_size())]
        self.bytes_b = _Table([bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in pieces_])
        self.size_a, self.size_b = len(shown), len(pieces_)
        # Decimal ids, each with room for the sign that follows it.
        self._decimals = _Table([b"%d " % i for i in range(max(self.size_a, self.size_b))])

    def encode(self, texts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        for first, end in slices(pa.array(texts, pa.binary()), _CALL_BYTES):
            some = [t.decode() for t in texts[first:end]]
            a += self._encode_a([" " + t for t in some])
            b += [np.array(ids, np.int64) for ids in self._b.encode(some, num_threads=1)]
        return a, b

    def _whole(self, table: _Table, ids: list[np.ndarray], texts: list[bytes]) -> list[bool]:
        """Whether the tokens of each text spell a blank and the text."""
        all_ids = np.concatenate(ids)
        ends = np.concatenate([[0], np.cumsum(table.sizes[all_ids])])[np.cumsum([len(i) for i in ids])]
        shown, at, out = table(all_ids).tobytes(), 0, []
        for text, end in zip(texts, ends.tolist(), strict=True):
            out.append(end - at == len(text) + 1 and shown[at:at + 1] == b" " and shown[at + 1:end] == text)
            at = end
        return out

    def align(self, texts: list[bytes]) -> Aligned:
        """Groups and links of the texts; texts that one side does not spell have no tokens."""
        use = [i for i, t in enumerate(texts) if t]
        a, b = self.encode([texts[i] for i in use])
        if use:
            there = [texts[i] for i in use]
            ok = [x and y for x, y in zip(self._whole(self.bytes_a, a, there), self._whole(self.bytes_b, b, there))]
            use, a, b = ([v for v, k in zip(vs, ok) if k] for vs in (use, a, b))
        return Aligned(self, len(texts), np.array(use, np.int64), a, b)

    def written(self, a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, na: np.ndarray,
                nb: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All groups as text, every id followed by one sign, and the end of each group in it."""
        ids = np.empty(len(a) + len(b), np.int64)
        at_a = np.arange(len(a)) + (np.cumsum(nb) - nb)[ga]
        at_b = np.arange(len(b)) + np.cumsum(na)[gb]
        ids[at_a], ids[at_b] = a, b
        signs = np.full(len(ids), ord(","), np.uint8)
        signs[at_a[np.cumsum(na) - 1]] = ord("|")
        last = at_b[np.cumsum(nb) - 1]
        signs[last] = ord(";")
        shown = self._decimals(ids)
        ends = np.cumsum(self._decimals.sizes[ids])
        shown[ends - 1] = signs
        return shown.tobytes(), ends[last]


class Aligned:
    """Groups and links of a slice of texts, numbers per text, and its distinct pairs in order."""

    def __init__(self, pair: Pair, n_texts: int, use: np.ndarray, a: list[np.ndarray], b: list[np.ndarray]):
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.zeros(n_texts, np.int64) for _ in range(4))
        self.sha256 = [""] * n_texts
        self.keys = self.radices = self.seen = self.slots = self.times = np.zeros(0, np.int64)
        if not len(use):
            return
        self.n_a[use], self.n_b[use] = [len(x) for x in a], [len(x) for x in b]
        a, b = np.concatenate(a), np.concatenate(b)
        ends_a, ends_b = np.cumsum(pair.bytes_a.sizes[a]), np.cumsum(pair.bytes_b.sizes[b])
        # The end of a text is an end on both sides, so no group reaches over it.
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        ga, gb = np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)
        na, nb = np.bincount(ga, minlength=len(ends)), np.bincount(gb, minlength=len(ends))
        text_ends = ends_a[np.cumsum(self.n_a[use]) - 1]
        slot = use[np.searchsorted(text_ends, ends)]
        self.n_groups = np.bincount(slot, minlength=n_texts)
        np.add.at(self.n_links, slot, na * nb)
        shown, at = pair.written(a, b, ga, gb, na, nb)
        cuts = at[np.searchsorted(ends, text_ends)].tolist()
        for i, first, end in zip(use.tolist(), [0, *cuts], cuts):
            self.sha256[i] = hashlib.sha256(shown[first:end - 1]).hexdigest()
        self._link(pair, a, b, ga, na, nb, slot, n_texts)

    def _link(self, pair: Pair, a: np.ndarray, b: np.ndarray, ga: np.ndarray, na: np.ndarray, nb: np.ndarray,
              slot: np.ndarray, n_texts: int) -> None:
        """Distinct pairs by (radix, first id, second id); for each the texts with it and how often."""
        bits_a, bits_b, bits_slot = ((n - 1).bit_length() for n in (pair.size_a, pair.size_b, n_texts))
        if _RADIX_BITS + bits_a + bits_b + bits_slot > 63:
            raise ValueError("vocabularies too large for packed links")

        def pack(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> np.ndarray:
            return (((x & _RADICES - 1) << bits_a | x) << bits_b | y) << bits_slot | z

        wide = na * nb > _WIDE
        first_a, first_b = np.cumsum(na) - na, np.cumsum(nb) - nb
        n = np.where(wide, 0, nb)[ga]
        at_b = np.repeat(first_b[ga] - np.cumsum(n) + n, n)
        at_b += np.arange(len(at_b))
        links, times = [pack(np.repeat(a, n), b[at_b], np.repeat(slot[ga], n))], []
        for g in np.flatnonzero(wide):
            ids_a, n_a = np.unique(a[first_a[g]:first_a[g] + na[g]], return_counts=True)
            ids_b, n_b = np.unique(b[first_b[g]:first_b[g] + nb[g]], return_counts=True)
            links.append(pack(np.repeat(ids_a, len(ids_b)), np.tile(ids_b, len(ids_a)), slot[g]))
            times.append(np.outer(n_a, n_b).ravel())
        if times:
            times = np.concatenate([np.ones(len(links[0]), np.int64), *times])
            links = np.concatenate(links)
            order = np.argsort(links)
            links, times = links[order], times[order]
            first = np.flatnonzero(np.diff(links, prepend=-1))
            self.times = np.add.reduceat(times, first)
        else:
            links = np.sort(links[0])
            first = np.flatnonzero(np.diff(links, prepend=-1))
            self.times = np.diff(first, append=len(links))
        links = links[first]
        self.slots = links & ((1 << bits_slot) - 1)
        keys = links >> bits_slot
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        self.seen = np.diff(first, append=len(keys))
        keys = keys[first]
        ids_a, ids_b = keys >> bits_b & ((1 << bits_a) - 1), keys & ((1 << bits_b) - 1)
        self.radices, self.keys = keys >> bits_a + bits_b, ids_a << _SIDE_BITS | ids_b


@functools.lru_cache(maxsize=2)
def _pair(byte_level: str, pieces: bytes) -> Pair:
    return Pair(byte_level, pieces)


def _compress(*columns: np.ndarray) -> bytes:
    """Columns of equal or given lengths as one compressed run; sorted ones are kept as steps."""
    import zstandard

    sizes = np.array([len(c) for c in columns], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(sizes + b"".join(c.astype("<i8").tobytes() for c in columns))


def _expand(run: bytes, columns: int) -> list[np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(run)
    sizes = np.frombuffer(data, "<i8", columns)
    return np.split(np.frombuffer(data, "<i8", offset=8 * columns), np.cumsum(sizes)[:-1])


def _pairs_of(run: bytes) -> Iterator[tuple[int, int]]:
    """The pairs of a run, with their counts, in order."""
    steps, n = _expand(run, 2)
    return zip(np.cumsum(steps).tolist(), n.tolist())


def _merge(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Heap merge of sorted runs: pairs and the sums of their counts."""
    keys: list[int] = []
    sums: list[int] = []
    last = -1
    for key, n in heapq.merge(*map(_pairs_of, runs)):
        if key == last:
            sums[-1] += n
        else:
            keys.append(key)
            sums.append(n)
            last = key
    return np.array(keys, np.int64), np.array(sums, np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _batch(values: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*values)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_PARTS = pa.schema([("radix", pa.int32()), ("run", pa.int64()), ("data", pa.binary())])
_PARTS_SQL = "radix int, run bigint, data binary"


def _merged(parts: DataFrame) -> DataFrame:
    """Runs of each radix merged by `_FAN` at once: radix, run (of the next level), data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (radix, group), rows in itertools.groupby(_rows(batches), lambda r: r[:2]):
            keys, sums = _merge([r[2] for r in rows])
            yield _batch([(radix, group, _compress(np.diff(keys, prepend=0), sums))], _PARTS)

    grouped = parts.select("radix", F.expr(f"run div {_FAN}").alias("run"), "data")
    return grouped.repartition("radix", "run").sortWithinPartitions("radix", "run").mapInArrow(run, _PARTS_SQL)


def _given_back(parts: DataFrame, totals: DataFrame, n_runs: int) -> DataFrame:
    """For every part the totals of its pairs: radix, run, data (total, whether it is the highest of its id).

    A radix is cut by runs, so that a task holds the totals once and sees a bounded number of parts.
    """
    shares = -(-n_runs // _FAN)
    copies = F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share")
    both = totals.select("radix", copies, F.lit(-1).cast("bigint").alias("run"), "data").unionByName(
        parts.select("radix", (F.col("run") % shares).cast("int").alias("share"), "run", "data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = sums = best = np.zeros(0, np.int64)
        for radix, _, number, data in _rows(batches):
            if number < 0:
                steps, sums = _expand(data, 2)
                keys = np.cumsum(steps)
                first = np.flatnonzero(np.diff(keys >> _SIDE_BITS, prepend=-1))
                highest = np.maximum.reduceat(sums, first)
                best = sums == np.repeat(highest, np.diff(first, append=len(keys)))
            else:
                at = np.searchsorted(keys, np.cumsum(_expand(data, 2)[0]))
                yield _batch([(radix, number, _compress(sums[at], best[at]))], _PARTS)

    placed = both.repartition("radix", "share").sortWithinPartitions("radix", "share", "run")
    return placed.mapInArrow(run, _PARTS_SQL)


def _summed(gathered: DataFrame) -> DataFrame:
    """Sums over the links of each text of a run: _run, _slot, n_best, count_sum."""
    schema = pa.schema([("_run", pa.int64()), ("_slot", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, parts, data in _rows(batches):
            seen, slots, times = _expand(data, 3)
            back = [_expand(p["data"], 2) for p in parts]
            n_best, count_sum = np.zeros((2, slots.max() + 1), np.int64)
            np.add.at(n_best, slots, np.repeat(np.concatenate([b for _, b in back]), seen) * times)
            np.add.at(count_sum, slots, np.repeat(np.concatenate([s for s, _ in back]), seen) * times)
            at = np.unique(slots)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), number)), pa.array(at.astype(np.int32)), pa.array(n_best[at]),
                 pa.array(count_sum[at])], schema=schema)

    return gathered.mapInArrow(run, "_run bigint, _slot int, n_best bigint, count_sum bigint")


ADDED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def align(docs: DataFrame, byte_level: str, pieces: str, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Groups and links between the tokens of two tokenizers for every text, with corpus-wide counts.

    `byte_level` is the path of a byte-level vocabulary (A, given a blank and the text) and
    `pieces` that of a sentence-piece model (B, given the text); the driver reads both files (a
    few MB, whatever the data) and broadcasts them. Where tokens of both sides end, a text is cut
    into groups; each A token of a group is linked with each B token in it. The count of an id
    pair is the number of rows of `docs` with such a link.

    Returns the columns `keep` (default: all; those of the added names are replaced) and n_a, n_b
    (tokens), n_groups, n_links, n_best (links whose pair has the highest count of its A id, equal
    ones included), count_sum (counts summed over the links) and groups_sha256 (of
    `a1,a2|b1;a3|b2,b3`). A text that is null or empty, or that the tokens of one side do not
    spell byte by byte, has zeros and ''. Repeated rows count again; an empty table gives an
    empty one. A task holds one long text, and the distinct pairs of one group, as a whole.
    """
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast((Path(byte_level).read_text(encoding="utf-8"), Path(pieces).read_bytes()))
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    shown = docs.select(*[docs[c].alias(f"_{i}") for i, c in enumerate(keep)])
    kinds = [("_run", "bigint"), ("_slot", "int"), ("_radix", "int"), ("_data", "binary"),
             *[(n, "bigint") for n in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", "string")]
    fields = [f"`{n}` {k}" for n, k in kinds] + [f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(shown.schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*files.value)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            kept = batch.select(list(range(1, batch.num_columns)))
            for first, end in slices(texts, _RUN_BYTES):
                found = pair.align([t.as_py() for t in texts.slice(first, end - first)])
                yield from _written(found, number, kept.slice(first, end - first), kinds)
                number += 1

    given = docs.select(docs[text].cast("string").alias("_text"), *[docs[c].alias(f"_{i}") for i, c in enumerate(keep)])
    written = materialize(given.mapInArrow(run, ", ".join(fields)))
    parts = written.filter("_radix >= 0").select(F.col("_radix").alias("radix"), F.col("_run").alias("run"), F.col("_data").alias("data"))
    runs = materialize(parts.select("run").distinct())
    n_runs = runs.count()
    if n_runs:
        # Runs get numbers without gaps, so that as many as can be are merged at once.
        numbered = row_index(runs, [F.col("run")], "number")
        parts = materialize(lookup_join(parts, numbered, ["run"]).select("radix", F.col("number").alias("run"), "data"))
        totals, left = parts, n_runs
        while True:
            totals, left = materialize(_merged(totals)), -(-left // _FAN)
            if left == 1:
                break
        back = _given_back(parts, totals.select("radix", "data"), n_runs)
        back = back.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("radix", "data"))).alias("parts"))
        links = written.filter("_radix = -1").select(F.col("_run").alias("run"), "_data")
        links = lookup_join(links, numbered, ["run"]).select(F.col("number").alias("run"), F.col("run").alias("_run"), "_data")
        sums = _summed(back.join(links, "run").select("_run", "parts", "_data"))
    else:
        sums = spark.createDataFrame([], "_run bigint, _slot int, n_best bigint, count_sum bigint")
    rows = written.filter("_radix is null").drop("_radix", "_data").join(sums, ["_run", "_slot"], "left")
    zero = F.lit(0).cast("bigint")
    rows = rows.withColumns({n: F.coalesce(n, zero) for n in ("n_best", "count_sum")})
    return rows.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], *ADDED)


def _written(found: Aligned, number: int, kept: pa.RecordBatch, kinds: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    """Rows of one run: its texts, then its links, then its pairs by radix."""
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    names = [n for n, _ in kinds] + kept.schema.names

    def rows(n: int, **values) -> pa.RecordBatch:
        columns = [pa.array(values[k], arrow[kind]) if k in values else pa.nulls(n, arrow[kind]) for k, kind in kinds]
        rest = kept.columns if "n_a" in values else [pa.nulls(n, c.type) for c in kept.columns]
        return pa.RecordBatch.from_arrays([*columns, *rest], names=names)

    n = len(found.sha256)
    yield rows(n, _run=[number] * n, _slot=range(n), n_a=found.n_a, n_b=found.n_b, n_groups=found.n_groups,
               n_links=found.n_links, groups_sha256=found.sha256)
    if len(found.keys):
        yield rows(1, _run=[number], _radix=[-1], _data=[_compress(found.seen, found.slots, found.times)])
        radices, first = np.unique(found.radices, return_index=True)
        data = [_compress(np.diff(found.keys[a:b], prepend=0), found.seen[a:b])
                for a, b in itertools.pairwise([*first.tolist(), len(found.keys)])]
        yield rows(len(radices), _run=[number] * len(radices), _radix=radices.astype(np.int32), _data=data)
