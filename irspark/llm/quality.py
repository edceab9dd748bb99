"""Quality rules: how far a document's characters and common words are from its language's.

A language's reference is counted over all documents of that language: the shares of character
classes, and the shares of its common words with one bin for all other words. Both are smoothed
towards the shares over all documents, so a rare language has a reference too. A document is kept
if it passes a few counted rules and if the Jensen-Shannon distances (base 2, from 0 to 1) of its
own two histograms to the reference are within limits. Short documents have noisy histograms, so
each comparison is made from a minimum length on.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ASCII marks of ordinary sentences, and the symbols that the base rules count.
_SENTENCE = b".,;:!?'\"()-"
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"
_WINDOW = 8
_BLANKS = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Limits:
    """Parameters of the rules.

    common_share: a word is common if it makes up this share of its language's words (so a
    language has at most 1 / common_share of them). Distances are compared from min_chars
    characters and min_words words on, and their sum where both are. The shares over all documents
    count as much as smoothing_words words of the language itself.
    """

    base_words: int = 20
    base_repeat_percent: int = 30
    common_share: float = 0.002
    min_chars: int = 200
    min_words: int = 60
    max_char_distance: float = 0.32
    max_word_distance: float = 0.46
    max_sum: float = 0.64
    smoothing_words: int = 100


def _class_table() -> np.ndarray:
    """Class of each byte of UTF-8: a character counts by its first byte."""
    table = np.zeros(256, np.int64)
    table[list(_SPACE)] = 1
    table[ord("a") : ord("z") + 1] = 2
    table[ord("A") : ord("Z") + 1] = 3
    table[ord("0") : ord("9") + 1] = 4
    table[0x21:0x7F] = np.where(table[0x21:0x7F] == 0, 6, table[0x21:0x7F])
    table[list(_SENTENCE)] = 5
    table[0x80:0xC0] = -1
    # Blocks by first byte: Latin-1 signs, Latin-1 letters, up to U+03FF, up to U+07FF, and so on.
    for number, first in enumerate((0xC2, 0xC3, 0xC4, 0xD0, 0xE0, 0xE2, 0xE3, 0xF0)):
        table[first:] = 7 + number
    return table


_CLASS = _class_table()
_CLASSES = int(_CLASS.max()) + 1


def language(lang: Column) -> Column:
    """First subtag of a language code; whatever is no code of two or three letters is `und`.

    There are at most 26^2 + 26^3 such codes, which bounds the table of references.
    """
    code = F.lower(F.regexp_extract(F.coalesce(lang, F.lit("")), r"^([A-Za-z]{2,3})(?:$|[-_])", 1))
    return F.when(code == "", F.lit("und")).otherwise(code)


def _class_counts(counts: np.ndarray) -> np.ndarray:
    """Characters by class, from counts of bytes."""
    return np.bincount(_CLASS[_CLASS >= 0], counts[_CLASS >= 0], _CLASSES)


def references(docs: DataFrame, limits: Limits, text: str = "text", lang: str = "lang") -> dict:
    """References by language: class shares and (common word, share) pairs.

    With N words of a language and K smoothing words, the share of a word is (its count there +
    K * its share of all words) / (N + K); character classes alike, with the characters of K
    average words. Words are counted by Spark and only common ones reach the driver: at most
    1 / common_share for each of the bounded number of languages, and as many of all words. No
    word is left out of the counts, and every language that occurs has a reference.
    """
    given = docs.select(language(docs[lang]).alias("lang"), docs[text].cast("string").alias("text"))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        n: Counter = Counter()
        for batch in batches:
            for code, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                raw = value.as_py() or b""
                n[code] += len(raw.split())
                sums[code] = sums.get(code, 0) + np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        found = [_class_counts(s).astype(np.int64) for s in sums.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([n[c] for c in sums], pa.int64()),
             pa.array(found, pa.list_(pa.int64()))], names=["lang", "n", "counts"])

    classes = [F.sum(F.col("counts")[i]).alias(str(i)) for i in range(_CLASSES)]
    per_language = given.mapInArrow(totals, "lang string, n bigint, counts array<bigint>").groupBy("lang").agg(
        F.sum("n").alias("n"), *classes)
    rows = sorted(per_language.collect())
    n_all = sum(r.n for r in rows)
    in_all = [sum(r[str(i)] for r in rows) for i in range(_CLASSES)]
    weight = limits.smoothing_words
    # Characters that go with the smoothing words.
    chars = weight * sum(in_all) / max(1, n_all)
    out = {}
    for r in rows:
        own = [r[str(i)] for i in range(_CLASSES)]
        total = max(1.0, sum(own) + chars)
        out[r.lang] = ([(x + chars * a / max(1, sum(in_all))) / total for x, a in zip(own, in_all)], [])
    if not n_all:
        return out
    # One row per language, of which there is a bounded number.
    totals_of = docs.sparkSession.createDataFrame([(r.lang, r.n) for r in rows], "lang string, total bigint")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    smoothed = (F.col("x.n") + weight * F.col("n_w") / n_all) / (F.col("x.total") + weight)
    words = (
        given.select("lang", F.explode(F.split("text", _BLANKS)).alias("w"))
        .groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("lang", F.translate("w", upper, lower).alias("w")).agg(F.sum("n").alias("n"))
        .filter(F.col("w") != "")
        .join(F.broadcast(totals_of), "lang")
        # A word has one entry per language at most.
        .groupBy("w").agg(F.sum("n").alias("n_w"), F.collect_list(F.struct("lang", "n", "total")).alias("x"))
        .select("w", "n_w", F.posexplode("x").alias("no", "x"))
        .select("w", "n_w", "no", "x.lang", smoothed.alias("share"))
    )
    everywhere = F.col("n_w") >= limits.common_share * n_all
    found = words.filter((F.col("share") >= limits.common_share) | (everywhere & (F.col("no") == 0))).collect()
    common = {r.w: r.n_w / n_all for r in found if r.n_w >= limits.common_share * n_all}
    shares: dict[str, dict] = {r.lang: {} for r in rows}
    for r in found:
        if r.share >= limits.common_share:
            shares[r.lang][r.w] = r.share
    for r in rows:
        # Words common in the corpus that the language lacks; those it has are found above.
        for w, share in common.items():
            there = weight * share / (r.n + weight)
            if there >= limits.common_share:
                shares[r.lang].setdefault(w, there)
        out[r.lang][1].extend(sorted(shares[r.lang].items()))
    return out


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two histograms of shares."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / m), 0).sum() / 2 for x in (p, q)]
    return float(np.sqrt(max(0.0, parts[0] + parts[1])))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of eight words that occurs twice or more."""
    n = len(words) - _WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).astype(np.uint64)
    windows = np.zeros(n, np.uint64)
    for i in range(_WINDOW):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    starts = np.zeros(n, bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    steps = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(starts)
    steps[at] += 1
    steps[at + _WINDOW] -= 1
    return int((np.cumsum(steps) > 0).sum())


class _Judge:
    """Measures of one text against the references."""

    def __init__(self, packed: str, limits: Limits):
        self.limits = limits
        self.refs = {}
        for code, (classes, words) in json.loads(packed).items():
            shares = np.array([p for _, p in words] + [max(0.0, 1 - sum(p for _, p in words))])
            self.refs[code] = (np.array(classes), {w.encode(): i for i, (w, _) in enumerate(words)}, shares)

    def __call__(self, raw: bytes, code: str) -> tuple:
        limits, words = self.limits, raw.split()
        counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        chars = int(counts.sum() - counts[0x80:0xC0].sum())
        word_chars = chars - int(counts[list(_SPACE)].sum())
        lines = [line for line in raw.split(b"\n") if line.strip()]
        n, repeats = len(words), repeated_words(words)
        base_failed = n < limits.base_words or 100 * repeats > limits.base_repeat_percent * n
        char_distance, word_distance = self._distances(raw, counts, chars, n, code)
        near = (
            (char_distance or 0) <= limits.max_char_distance
            and (word_distance or 0) <= limits.max_word_distance
            and (None in (char_distance, word_distance) or char_distance + word_distance <= limits.max_sum)
        )
        symbols = int(counts[list(_SYMBOLS)].sum())
        return (n, word_chars, symbols, len(lines) - len(set(lines)), repeats, base_failed,
                not base_failed and near, char_distance, word_distance)


    def _distances(self, raw: bytes, counts: np.ndarray, chars: int, n: int, code: str) -> tuple:
        char_distance = word_distance = None
        if code in self.refs:
            classes, common, shares = self.refs[code]
            if chars >= self.limits.min_chars:
                char_distance = distance(_class_counts(counts) / chars, classes)
            if n >= self.limits.min_words:
                found, other = common.get, len(common)
                bins = np.bincount([found(w, other) for w in raw.lower().split()], minlength=other + 1)
                word_distance = distance(bins / n, shares)
        return char_distance, word_distance


_MEASURES = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
             ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
             ("kept", pa.bool_()), ("char_distance", pa.float64()), ("word_distance", pa.float64())]
_DDL = {pa.int64(): "bigint", pa.bool_(): "boolean", pa.float64(): "double"}


def judge(docs: DataFrame, limits: Limits = Limits(), text: str = "text", lang: str = "lang",
          keep: list[str] | None = None, corpus: DataFrame | None = None) -> DataFrame:
    """Add the measures and the verdict `kept` to the columns `keep` (default: all others).

    References come from `corpus` (default: the documents themselves). A null text has no words;
    it fails the base rules, as does every text of fewer than 20 words. Distances are null below
    the minimum lengths and then decide nothing. Rows stand alone: repeated rows get equal
    verdicts, and an empty table stays empty. Columns with the added names are replaced.
    """
    packed = json.dumps(references(docs if corpus is None else corpus, limits, text, lang))
    content = docs.sparkSession.sparkContext.broadcast(packed)
    added = {n for n, _ in _MEASURES}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    schema = docs.select(*keep).schema
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema]
    # A text that is kept moves to the tasks once.
    once = text in keep and schema[text].dataType == T.StringType()
    at = 1 + (keep.index(text) if once else len(keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = _Judge(content.value, limits)
        for batch in batches:
            texts, codes = batch.column(at).cast(pa.binary()), batch.column(0).to_pylist()
            rows = [one(t.as_py() or b"", c) for t, c in zip(texts, codes)]
            found = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_MEASURES)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1 : 1 + len(keep)], *found], names=[*keep, *[n for n, _ in _MEASURES]])

    texts = [] if once else [docs[text].cast("string").alias("_text")]
    given = docs.select(language(docs[lang]).alias("_lang"), *[docs[c] for c in keep], *texts)
    return given.mapInArrow(run, ", ".join([*fields, *[f"{n} {_DDL[k]}" for n, k in _MEASURES]]))
