"""Language of texts by bit-sliced Bloom filters of character n-grams.

One table of bit masks is the filters of all languages: bit `l` of a row says whether language
`l` has set that row. The masks of an n-gram's rows, joined by AND, name all languages that hold
the n-gram at once. Counted per language over a text, and freed of the hits that chance gives a
filter so full, they decide.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from irspark.llm.batches import slices
from irspark.plans.lineage import materialize
from irspark.plans.skew import lookup_join

LENGTHS = (2, 3, 4)
# An n-gram belongs to a language in whose n-grams it has this share at least, and this part of
# the share that it has in any other. So a filter holds 1 / MIN_SHARE n-grams at most.
MIN_SHARE, MIN_PART = 2e-5, 0.25
# Rows of the table, and rows that an n-gram sets. At 50,000 n-grams a filter is a quarter full.
_ROWS, _PROBES = 1 << 19, 3
_WORD = 63  # languages in one mask
_TEXT_BYTES = 500_000
# Distinct n-grams that a task counts before it passes the counts on.
_GRAMS_HELD = 1_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: its lower-case letter or mark (0: neither), and whether it is a letter."""
    lower, letter = np.zeros(sys.maxunicode + 1, np.uint32), np.zeros(sys.maxunicode + 1, bool)
    for i in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(i))[0]
        if kind in "LM":
            lower[i], letter[i] = ord(chr(i).lower()[0]), kind == "L"
    return lower, letter


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of the words of all texts, the text of each, and which texts have a letter.

    Words are runs of letters and marks, lower-cased, with one blank before and after.
    """
    lower, letter = _characters()
    points = [np.frombuffer((t or "").encode("utf-32-le"), np.uint32) for t in texts]
    has = np.array([bool(letter[p].any()) for p in points], bool)
    # A blank after each text ends its last word; blanks in a row are one.
    laid = lower[np.concatenate([np.append(p, np.uint32(32)) for p in points])]
    owner = np.repeat(np.arange(len(texts)), [len(p) + 1 for p in points])
    stays = (laid != 0) | np.append(False, laid[:-1] != 0)
    laid, owner = np.append(np.uint32(0), laid[stays]).astype(np.uint64), owner[stays]
    owner = np.append(owner[:1], owner)
    found, of = [], []
    for n in LENGTHS:
        ends = len(laid) - n + 1
        if ends < 1:
            continue
        key, inner = np.full(ends, n, np.uint64), np.ones(ends, bool)
        for i in range(n):
            key = (key ^ laid[i : i + ends]) * _ODD
            key ^= key >> np.uint64(29)
            if 0 < i < n - 1:
                inner &= laid[i : i + ends] != 0
        found.append(_mixed(key[inner]))
        # A window that begins with a blank belongs to the text of the letter after it.
        of.append(owner[1 : 1 + ends][inner])
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has
    return np.concatenate(found), np.concatenate(of), has


def _places(keys: np.ndarray) -> list[np.ndarray]:
    step = (keys >> np.uint64(32)) | np.uint64(1)
    return [((keys + np.uint64(i) * step) % np.uint64(_ROWS)).astype(np.int64) for i in range(_PROBES)]


def _texts(column: pa.Array) -> Iterator[tuple[int, int, list[str | None]]]:
    for first, end in slices(column.cast(pa.binary()), _TEXT_BYTES):
        yield first, end, column.slice(first, end - first).to_pylist()


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all rows (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = defaultdict(list)

        def compact() -> int:
            for lang, parts in held.items():
                keys = np.concatenate([k for k, _ in parts])
                keys, at = np.unique(keys, return_inverse=True)
                counts = np.zeros(len(keys), np.int64)
                np.add.at(counts, at, np.concatenate([n for _, n in parts]))
                held[lang] = [(keys, counts)]
            return sum(len(p[0][0]) for p in held.values())

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, [(keys, counts)] in held.items():
                for at in range(0, len(keys), 100_000):
                    some = keys[at : at + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some), pa.string()), pa.array(some.view(np.int64)),
                         pa.array(counts[at : at + 100_000])], names=["lang", "gram", "n"])
            held.clear()

        waiting = 0
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for first, end, texts in _texts(batch.column(1)):
                keys, owner, _ = grams(texts)
                for lang in dict.fromkeys(langs[first:end]):
                    own = np.unique(keys[(langs[first:end] == lang)[owner]], return_counts=True)
                    held[lang].append(own)
                    waiting += len(own[0])
                if waiting > 2 * _GRAMS_HELD:
                    waiting = compact()
                    if waiting > _GRAMS_HELD:
                        yield from counted()
                        waiting = 0
        compact()
        yield from counted()

    counts = docs.select("lang", "text").mapInArrow(run, "lang string, gram bigint, n bigint")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """Names of the languages, share of their n-grams that their filters hold, and the table of masks."""

    def __init__(self, names: list[str], held: list[float], masks: np.ndarray):
        self.names, self.held, self.masks = names, np.array(held), masks
        full = np.array([np.count_nonzero(self._bit(masks, i)) for i in range(len(names))]) / _ROWS
        self.by_chance = full**_PROBES

    @staticmethod
    def _bit(masks: np.ndarray, i: int) -> np.ndarray:
        return (masks[i // _WORD] >> np.int64(i % _WORD)) & np.int64(1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; without a letter or a language `und` and 0."""
        keys, owner, has = grams(texts)
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts))
        masks = functools.reduce(np.bitwise_and, [self.masks[:, p] for p in _places(keys)])
        total = np.bincount(owner, minlength=len(texts)).astype(float)
        found = np.empty((len(self.names), len(texts)))
        for i in range(len(self.names)):
            hits = np.bincount(owner[self._bit(masks, i) != 0], minlength=len(texts))
            by_chance = self.by_chance[i]
            found[i] = np.maximum(hits - total * by_chance, 0) / ((1 - by_chance) * self.held[i])
        best, sums = found.argmax(axis=0), found.sum(axis=0)
        score = np.divide(found.max(axis=0), sums, out=np.zeros(len(texts)), where=(sums > 0) & has)
        return [self.names[i] if h else "und" for i, h in zip(best, has)], score


def fit(docs: DataFrame, min_share: float = MIN_SHARE, min_part: float = MIN_PART) -> Filters:
    """Filters of all languages of the labelled rows (lang, text); rows with a null of these don't count.

    Counts cover all rows. The driver gets the table alone: half a million masks at most, whatever
    the data, and one more such column for every 63 languages.
    """
    spark = docs.sparkSession
    labelled = docs.filter("lang is not null and text is not null")
    counts = materialize(gram_counts(labelled))
    # One row per language.
    sums = materialize(counts.groupBy("lang").agg(F.sum("n").alias("all")))
    shares = lookup_join(counts, sums, ["lang"]).select("lang", "gram", (F.col("n") / F.col("all")).alias("share"))
    # Few rows are left: 1 / min_share of each language.
    common = materialize(shares.filter(F.col("share") >= min_share))
    highest = common.groupBy("gram").agg(F.max("share").alias("highest"))
    kept = materialize(common.join(highest, "gram").filter(F.col("share") >= min_part * F.col("highest")))
    held = kept.groupBy("lang").agg(F.sum("share").alias("held"))
    # The larger language first, which wins ties.
    langs = sums.join(held, "lang").orderBy(F.col("all").desc(), "lang").collect()
    names = [r.lang for r in langs]
    places = {name: (i // _WORD, 1 << i % _WORD) for i, name in enumerate(names)}
    numbered = spark.createDataFrame([(n, w, m) for n, (w, m) in places.items()], "lang string, word int, mask bigint")
    masks = np.zeros((-(-len(names) // _WORD) or 1, _ROWS), np.int64)
    if names:
        set_ = lookup_join(kept.select("lang", "gram"), numbered, ["lang"]).select("gram", "word", "mask")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows in _places(batch.column(0).to_numpy().view(np.uint64)):
                    yield pa.RecordBatch.from_arrays([pa.array(rows), *batch.columns[1:]], names=["row", "word", "mask"])

        rows = set_.mapInArrow(run, "row bigint, word int, mask bigint").groupBy("word", "row").agg(F.bit_or("mask").alias("mask"))
        found = rows.toArrow()
        word, row, mask = (found.column(n).to_numpy() for n in ("word", "row", "mask"))
        masks[word, row] = mask
    return Filters(names, [r.held for r in langs], masks)


def predict(docs: DataFrame, filters: Filters, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Add lang_pred and score (0 to 1, the share of the language in all corrected hits) to the columns `keep`.

    Only the text is read. A text that is null, empty or without a letter is `und` with score 0;
    so is every text if no language was learned. A text with letters that no filter knows gets
    the language with most n-grams and score 0. Columns with the added names are replaced; each
    row stands alone, and an empty table gives an empty one.
    """
    known = docs.sparkSession.sparkContext.broadcast(filters)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in _texts(batch.column(0)):
                names, score = known.value.predict(texts)
                columns = [c.slice(first, end - first) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(names, pa.string()), pa.array(score, pa.float64())], names=[*keep, "lang_pred", "score"])

    given = docs.select(docs[text].cast("string").alias("_text"), *[docs[c] for c in keep])
    return given.mapInArrow(run, ", ".join([*fields, "lang_pred string", "score double"]))
