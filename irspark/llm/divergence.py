"""Divergence between the sources of a language, from run-length encoded columns of counts.

The terms of a language are ordered by their counts in all its sources, so that terms with equal
counts lie side by side. In that order the counts of a source are a column of few runs. For two
sources, the borders of both columns cut the order into segments with one count each; a term's
share is computed once per segment and multiplied by the segment's length.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from irspark.plans.lineage import materialize
from irspark.plans.ordering import rank_within, top_within
from irspark.plans.skew import lookup_join

SCALE = 1_000_000_000
# Terms that a task counts before it passes the counts on, and pairs of sources whose sums it holds.
_TERMS_HELD = 300_000
_PAIRS_HELD = 500_000
# Rows of equal counts that are encoded together.
_BLOCK_ROWS = 4096
# Below this sum a product with SCALE fits 64 bits.
_SMALL = 9_000_000_000
# Bytes of a term: ASCII letters, lower-cased, and all bytes of other characters.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _terms(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n occurrences, docs with the term; nulls count as ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = defaultdict(lambda: (Counter(), Counter()))

        def counted() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs_with) in found.items():
                terms = list(n)
                for at in range(0, len(terms), _BLOCK_ROWS * 8):
                    some = terms[at : at + _BLOCK_ROWS * 8]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some), pa.string()), pa.array([source] * len(some), pa.string()),
                         pa.array(some, pa.binary()).cast(pa.string()), pa.array([n[t] for t in some], pa.int64()),
                         pa.array([docs_with[t] for t in some], pa.int64())],
                        names=["lang", "source", "term", "n", "docs"])
            found.clear()

        held = 0
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, batch.column(2).cast(pa.binary()), strict=True):
                n, docs_with = found[lang, source]
                terms, before = _terms(text.as_py()), len(n)
                n.update(terms)
                docs_with.update(set(terms))
                held += len(n) - before
                if held > _TERMS_HELD:
                    yield from counted()
                    held = 0
        yield from counted()

    empty = F.lit("")
    given = docs.select(*[F.coalesce(docs[c].cast("string"), empty).alias(c) for c in ("lang", "source", "text")])
    return given.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint").groupBy(
        "lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), exact for all 64-bit counts."""
    over = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", over, (total + terms).cast("decimal(20,0)"))


def excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _encode(rows: DataFrame) -> DataFrame:
    """Sorted rows (lang, cells, terms) in blocks: lang, size, runs of every source (ends, counts)."""

    def columns(part: pa.RecordBatch) -> list[dict]:
        cells = part.column("cells")
        values = cells.flatten()
        at = np.repeat(np.arange(len(cells)), np.diff(cells.offsets.to_numpy()))
        names = values.field("source").dictionary_encode()
        codes, counts = names.indices.to_numpy(), values.field("n").to_numpy()
        ends = np.cumsum(part.column("terms").to_numpy())
        out = []
        for code, name in enumerate(names.dictionary.to_pylist()):
            column = np.zeros(len(cells), np.int64)
            here = codes == code
            column[at[here]] = counts[here]
            last = np.append(np.flatnonzero(np.diff(column)), len(column) - 1)
            out.append({"source": name, "ends": ends[last], "counts": column[last]})
        return [{"size": int(ends[-1]), "runs": out}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            cuts = [0, *[i for i in range(1, len(langs)) if langs[i] != langs[i - 1]], len(langs)]
            for first, end in zip(cuts, cuts[1:]):
                for at in range(first, end, _BLOCK_ROWS):
                    found = columns(batch.slice(at, min(_BLOCK_ROWS, end - at)))
                    yield pa.RecordBatch.from_pylist([{"lang": langs[first], **x} for x in found], schema)

    schema = pa.schema([("lang", pa.string()), ("size", pa.int64()), ("runs", pa.list_(pa.struct(
        [("source", pa.string()), ("ends", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])))])
    return rows.mapInArrow(
        run, "lang string, size bigint, runs array<struct<source string, ends array<bigint>, counts array<bigint>>>")


def _shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    over = total + terms
    if over <= _SMALL:
        return 1 + SCALE * (counts + 1) // over
    return np.array([1 + SCALE * (int(c) + 1) // over for c in counts], np.int64)


def _compare(blocks: DataFrame) -> DataFrame:
    """Sums over the segments of all blocks: lang, source, item, value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = defaultdict(int)

        def summed() -> pa.RecordBatch:
            keys = list(sums)
            batch = pa.RecordBatch.from_arrays(
                [*[pa.array([k[i] for k in keys], pa.string()) for i in range(3)],
                 pa.array([sums[k] for k in keys], pa.int64())], names=["lang", "source", "item", "value"])
            sums.clear()
            return batch

        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.slice(row, 1).to_pylist()[0]
                lang, size, terms = block["lang"], block["size"], block["terms"]
                runs = {r["source"]: r for r in block["runs"]}
                laid = []
                for group in block["groups"]:
                    own = runs.get(group["source"], {"ends": [size], "counts": [0]})
                    ends, counts = np.array(own["ends"], np.int64), np.array(own["counts"], np.int64)
                    laid.append((group["source"], ends, _shares(counts, group["total"], terms) if size else counts))
                for i, (a, ends_a, p_a) in enumerate(laid):
                    for b, ends_b, p_b in laid[:i]:
                        there = back = 0
                        if size:
                            ends = np.union1d(ends_a, ends_b)
                            lengths = np.diff(ends, prepend=0)
                            p, q = p_a[np.searchsorted(ends_a, ends)], p_b[np.searchsorted(ends_b, ends)]
                            square = (p - q) * (p - q)
                            there, back = int((square // q * lengths).sum()), int((square // p * lengths).sum())
                        sums[lang, a, b] += there
                        sums[lang, b, a] += back
                    if len(sums) > _PAIRS_HELD:
                        yield summed()
        yield summed()

    return blocks.mapInArrow(run, "lang string, source string, item string, value bigint").groupBy(
        "lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """How far sources of a language differ, and by which terms: lang, source, part, item, value, rank.

    `docs` has text, lang and source; nulls count as '', other columns are not read. Terms are
    runs of ASCII letters (lower-cased) and characters beyond ASCII; a language keeps those in at
    least `min_docs` of its documents. A group's share of a term is 1 + floor(1e9 * (count + 1) /
    (all its counts + kept terms)), in whole numbers throughout.

    Part `pair` sums floor((p - q)^2 / q) over the kept terms for every other source of the
    language, by 1-based rank. Part `term` has the `top` terms whose share exceeds that of the
    whole language. Equal values go by item. A language without kept terms has pairs of value 0;
    a source without terms counts with zeros; repeated rows count again; an empty table gives an
    empty one. Sums fit 64 bits up to half a billion kept terms of a language.
    """
    names = [F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    listed = F.sort_array(F.collect_list(F.struct("source", "n"))).alias("cells")
    words = term_counts(docs).groupBy("lang", "term").agg(
        listed, F.sum("n").alias("total"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
    words = materialize(words.select("lang", "term", "total", "cells"))
    cells = words.select("lang", "term", "total", F.explode("cells").alias("c")).select(
        "lang", "term", F.col("total").alias("all"), "c.source", "c.n")
    sums = materialize(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")))
    groups = docs.select(*names).distinct().join(sums, ["lang", "source"], "left")
    groups = materialize(groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")))
    of_lang = words.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_total"))
    zero = F.lit(0).cast("bigint")
    # One row per language; a row holds as many entries as the language has sources.
    langs = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("groups"))
    langs = materialize(langs.join(of_lang, "lang", "left").withColumns(
        {"terms": F.coalesce("terms", zero), "lang_total": F.coalesce("lang_total", zero)}))

    alike = words.groupBy("lang", "cells").agg(F.count(F.lit(1)).alias("terms"))
    blocks = _encode(alike.repartitionByRange("lang", "cells").sortWithinPartitions("lang", "cells"))
    # A block without terms for every language, so that all pairs are there.
    blocks = blocks.unionByName(langs.select("lang", zero.alias("size")), allowMissingColumns=True)
    blocks = blocks.withColumn("runs", F.coalesce("runs", F.array().cast(blocks.schema["runs"].dataType)))
    values = _compare(lookup_join(blocks, langs.select("lang", "groups", "terms"), ["lang"]))
    by_value = [F.col("value").desc(), F.col("item")]
    pairs = rank_within(materialize(values), ["lang", "source"], by_value)

    known = lookup_join(cells, groups, ["lang", "source"])
    known = lookup_join(known, langs.select("lang", "terms", "lang_total"), ["lang"])
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    q = share(F.col("all"), F.col("lang_total"), F.col("terms"))
    shares = known.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    valued = shares.select("lang", "source", "item", excess(F.col("p"), F.col("q")).alias("value"))
    terms = top_within(valued, ["lang", "source"], by_value, top)
    columns = ["lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        terms.withColumn("part", F.lit("term")).select(*columns))
