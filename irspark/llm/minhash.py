"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

A sketch has t coordinates. In round i every shingle falls into one coordinate, chosen by the
round's hash, with the value (i, hash); the smallest value stays. A document stops after the first
round that leaves no coordinate empty. From round t on, all shingles go to coordinate i - t, so
2t rounds always fill everything, whatever the size of the set. Two sketches agree in each
coordinate with the Jaccard similarity as probability, as for MinHash, and their agreement is
concentrated around it, at a cost that hardly depends on t.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from irspark.llm.linkage import link, with_values
from irspark.plans.lineage import materialize
from irspark.plans.skew import hot_keys, lookup_join, skew_join

# 32 bands of 4 coordinates miss a pair of similarity 0.8 with probability (1 - 0.8^4)^32 < 1e-7.
COORDINATES, BAND = 128, 4
# A pair is dropped unread if its sketches agree in less than this part: 0.8 less five standard
# deviations of 128 coordinates.
_LEAST_AGREEMENT = 0.62
# Pairs of one leader that one task compares, and words whose hash a worker keeps.
_PAIRS, _WORDS_KEPT = 2_000, 300_000
# Members of a bucket that are compared at once with as many others.
_BLOCK = 1_024
# Documents that are sketched at once, by bytes of text.
_TEXT_BYTES = 4_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing with multiplications and shifts."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """64-bit hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < _WORDS_KEPT and len(word) <= 64:
            self[word] = value
        return value


_HASHES = _WordHashes()


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `width` words, A-Z lower-cased.

    A text with fewer words is one run; without words there is none.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    length = min(width, len(words))
    runs = np.full(len(words) - length + 1, length, np.uint64)
    for i in range(length):
        runs = runs * _ODD + codes[i : i + len(runs)]
    return np.unique(_mix(runs))


def sketch(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """Sketches of non-empty sets of 64-bit values, one row each."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    empty = np.uint64(2**64 - 1)
    out = np.full((len(sets), t), empty)
    flat = out.reshape(-1)
    for i in range(2 * t):
        with np.errstate(over="ignore"):
            hashed = _mix(values + np.uint64(i + 1) * _ODD)
        place = (hashed % np.uint64(t)).astype(np.int64) if i < t else np.int64(i - t)
        # The round is in the upper eight bits, so that an earlier round always wins.
        np.minimum.at(flat, owner * t + place, (np.uint64(i) << np.uint64(56)) | (hashed >> np.uint64(8)))
        unfilled = (out == empty).any(axis=1)
        if not unfilled.any():
            break
        stays = unfilled[owner]
        owner, values = owner[stays], values[stays]
    return out


def bands(sketches: np.ndarray) -> np.ndarray:
    """One key per band; keys of different bands differ."""
    parts = sketches.reshape(len(sketches), -1, BAND)
    keys = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2])
    for i in range(BAND):
        keys = _mix(keys * _ODD + parts[:, :, i])
    return keys.view(np.int64)


def _text_hash(text: Column) -> Column:
    """Two 64-bit hashes; equal for equal texts only, for all that matters."""
    return F.struct(F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g"))


def _signatures(docs: DataFrame, width: int, columns: list[str]) -> DataFrame:
    """The columns, text_hash, n_shingles, id (of the set, null if empty), bands, sketch, as a written table."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            counts, ids, found = [], [], []
            waiting, weight, sketched, keys = [], 0, [], []

            def close() -> None:
                if waiting:
                    done = sketch(waiting)
                    keys.extend(bands(done))
                    sketched.extend((_mix(done) >> np.uint64(56)).astype(np.uint8))
                    waiting.clear()

            for text in texts:
                raw = text.as_py()
                values = shingles(raw, width)
                counts.append(len(values))
                found.append(len(values) > 0)
                ids.append(xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None)
                if len(values):
                    waiting.append(values)
                    weight += len(raw)
                    if weight > _TEXT_BYTES:
                        close()
                        weight = 0
            close()
            keys, sketched = iter(keys), iter(sketched)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(counts, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array([next(keys) if f else None for f in found], pa.list_(pa.int64())),
                 pa.array([next(sketched).tobytes() if f else None for f in found], pa.binary())],
                names=[*columns, "text_hash", "n_shingles", "id", "bands", "sketch"])

    given = docs.select(F.col("_text"), *columns, _text_hash(F.col("_text")).alias("text_hash"))
    added = ["text_hash struct<h: bigint, g: bigint>", "n_shingles bigint", "id binary", "bands array<bigint>", "sketch binary"]
    return materialize(given.mapInArrow(run, ", ".join([*fields, *added])))


def _agreeing(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs whose sketches agree often enough for their sets to be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COORDINATES)
                           for c in ("left", "right"))
            keep = pa.array((left == right).mean(axis=1) >= _LEAST_AGREEMENT)
            yield batch.select(["a", "b"]).filter(keep)

    both = with_values(pairs, sketches, "sketch", 1_000_000)
    return both.select("a", "b", "left", "right").mapInArrow(run, "a binary, b binary")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose whole sets are similar: 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}

        def values(side: str, key: bytes, text: pa.Scalar) -> np.ndarray:
            # Pairs come in the order of one side, so the last set is often the one that is needed.
            if known.get(side, (None,))[0] != key:
                known[side] = (key, shingles(text.as_py(), width))
            return known[side][1]

        for batch in batches:
            keys = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())
            keep = []
            for (a, b), left, right in zip(keys, batch.column("left"), batch.column("right")):
                x, y = values("a", a, left), values("b", b, right)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = with_values(pairs, texts, "text", _PAIRS)
    both = both.select("a", "b", F.col("left").cast("binary").alias("left"), F.col("right").cast("binary").alias("right"))
    return both.mapInArrow(run, "a binary, b binary")


def _compare(left: list[tuple], right: list[tuple], percent: int, same: bool) -> Iterator[tuple[bytes, bytes]]:
    """Similar pairs of (id, root, band, bands, open, sketch, shingles) members of one bucket.

    Pairs meet in the first band that they share and that is open for both (other buckets have
    another leader or are not read), need different roots, and are dropped by their sketches or
    their sizes before whole sets are intersected.
    """
    roots = [np.array([hash(m[1]) for m in side]) for side in (left, right)]
    keys = [np.array([m[3] for m in side]) for side in (left, right)]
    read = [np.array([m[4] for m in side]) for side in (left, right)]
    sketches = [np.frombuffer(b"".join(m[5] for m in side), np.uint8).reshape(len(side), -1) for side in (left, right)]
    sizes = [np.array([len(m[6]) for m in side]) for side in (left, right)]
    for i, one in enumerate(left):
        first = i + 1 if same else 0
        if first >= len(right):
            continue
        shared = (keys[1][first:] == keys[0][i]) & read[1][first:] & read[0][i]
        may = (shared.argmax(axis=1) == one[2]) & shared.any(axis=1) & (roots[1][first:] != roots[0][i])
        may &= 100 * np.minimum(sizes[1][first:], sizes[0][i]) >= percent * np.maximum(sizes[1][first:], sizes[0][i])
        rows = first + np.flatnonzero(may)
        rows = rows[(sketches[1][rows] == sketches[0][i]).mean(axis=1) >= _LEAST_AGREEMENT]
        for k in rows:
            other = right[k]
            n = len(np.intersect1d(one[6], other[6], assume_unique=True))
            if 100 * n >= percent * (len(one[6]) + len(other[6]) - n):
                yield one[0], other[0]


def _linked_in_buckets(open_: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Similar pairs (a, b) of one bucket with different roots; members: id, bands, open, sketch, s.

    `open` says of each band whether the set is in an open bucket of it, without being its leader.

    A bucket is cut into blocks of bounded size, and every two of its blocks meet in one group of
    rows of a task, which gives the links alone.
    """
    blocks = F.ceil(F.col("n") / _BLOCK).cast("int")
    placed = open_.withColumn("block", F.pmod(F.xxhash64("id"), blocks.cast("bigint")).cast("int"))
    each = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    met = placed.select("key", "id", "root", "block", each)
    met = met.select("key", "id", "root", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    full = skew_join(met, members, ["id"], rows=_PAIRS, salt_on=["key", "x", "y"], heavy=hot_keys(met, ["id"], _PAIRS))
    at = (F.array_position("bands", F.col("key")) - 1).cast("int").alias("band")
    full = full.select("key", "x", "y", "block", "id", "root", at, "bands", "open", "sketch", "s")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(group: tuple, rows: list[tuple]) -> pa.RecordBatch:
            left = [r[1:] for r in rows if r[0] == group[1]]
            right = left if group[1] == group[2] else [r[1:] for r in rows if r[0] == group[2]]
            found = list(_compare(left, right, percent, group[1] == group[2]))
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.binary()) for i in (0, 1)], names=["a", "b"])

        group, rows = None, []
        for batch in batches:
            columns = [batch.column(i) for i in range(11)]
            lists = [[v.values.to_numpy(zero_copy_only=False) for v in columns[i]] for i in (7, 8, 10)]
            plain = [columns[i].to_pylist() for i in (0, 1, 2, 3, 4, 5, 6, 9)]
            for (key, x, y, *row), keys, read, values in zip(zip(*plain), *lists):
                if group != (key, x, y):
                    if len(rows) > 1:
                        yield done(group, rows)
                    group, rows = (key, x, y), []
                block, id_, root, band, sketched = row
                rows.append((block, id_, root, band, keys, read, sketched, values.view(np.uint64)))
        if len(rows) > 1:
            yield done(group, rows)

    return full.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id",
                    text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """Components of documents that are linked by similar sets of word shingles.

    Adds n_shingles, component_id (the smallest doc_id reachable; null if no document of the
    component has an id) and kept (doc_id = component_id) to the columns (default: doc_id).
    Documents with equal sets, as of repeated rows, are one node. A null or wordless text has an
    empty set and is linked with nothing; its component_id is its own id. Rows without an id
    carry that of their component and are not kept, unless nothing in their component has one.
    Texts are read whole; other columns may have any name. An empty table stays empty.
    """
    columns = columns or [doc_id]
    given = docs.select(docs[text].cast("string").alias("_text"), *[docs[c] for c in columns])
    signed = _signatures(given, width, columns)
    sets = signed.filter("id is not null")
    buckets = sets.select(F.explode("bands").alias("key"), "id")

    def chosen(ids: DataFrame, columns: list[str]) -> DataFrame:
        return lookup_join(sets.select("id", *columns), ids, ["id"]).dropDuplicates(["id"])

    def texts(ids: DataFrame) -> DataFrame:
        """id, text: the text of one document per set."""
        hashes = materialize(chosen(ids, ["text_hash"]).select("id", "text_hash.*"))
        hashed = given.select("_text", _text_hash(F.col("_text")).alias("t")).select("_text", "t.*")
        found = lookup_join(hashed, hashes, ["h", "g"])
        return materialize(found.select("id", F.col("_text").alias("text")).dropDuplicates(["id"]))

    def ids_of(pairs: DataFrame) -> DataFrame:
        return materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())

    def verify(pairs: DataFrame) -> DataFrame:
        likely = materialize(_agreeing(pairs, materialize(chosen(ids_of(pairs), ["sketch"]))))
        return _verified(likely, texts(ids_of(likely)), width, percent)

    def rest(open_: DataFrame) -> DataFrame:
        ids = materialize(open_.select("id").distinct())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [shingles(t.as_py(), width).view(np.int64) for t in batch.column(1).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["id", "s"])

        listed = texts(ids).mapInArrow(run, "id binary, s array<bigint>")
        keys = open_.groupBy("id").agg(F.collect_set("key").alias("_open"))
        read = F.transform("bands", lambda k: F.array_contains("_open", k)).alias("open")
        signs = chosen(ids, ["bands", "sketch"]).join(keys, "id").select("id", "bands", read, "sketch")
        members = materialize(listed.join(signs, "id"))
        return _linked_in_buckets(open_, members, percent)

    roots = link(buckets, verify, rest)
    return _labelled(signed, roots, doc_id, columns)


def _labelled(signed: DataFrame, roots: DataFrame, doc_id: str, columns: list[str]) -> DataFrame:
    """Component of every document, from the components of sets."""
    # A set that occurs once and has no link is its own component, so only others are looked up.
    counted = signed.filter("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min(doc_id).alias("least"))
    named = counted.join(roots.withColumnRenamed("node", "id"), "id", "left").filter("n > 1 or root is not null")
    named = materialize(named.withColumn("root", F.coalesce("root", "id")))
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    groups = materialize(named.join(smallest, "root").select("id", F.lit(True).alias("grouped"), "component"))
    found = lookup_join(signed.select(*columns, "n_shingles", "id"), groups, ["id"], "left")
    component = F.when(F.col("grouped"), F.col("component")).otherwise(F.col(doc_id))
    return found.select(*columns, "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col(doc_id) == component, F.lit(False)).alias("kept"))
