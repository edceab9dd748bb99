"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A token sequence is the result of the merges if and only if every pair of neighbours is
compatible: undoing merges on both sides of their border, latest first, never shows a pair that
the merges would have joined earlier. So the encoder takes the longest token at each position
(all of them found by one Aho-Corasick pass over the word), checks it against the token before
it, and otherwise falls back to the next shorter token or takes back the token before. Each
position fails at most once, which keeps the time linear in the length of the word.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from irspark.llm.batches import slices

# Texts are cut at ASCII white space, and what a piece gave is kept up to these bounds.
_PIECES_KEPT = 250_000
_PIECE_BYTES = 64
_PAIRS_KEPT = 200_000
# Bytes of text whose results a worker holds at once.
_TEXT_BYTES = 4_000_000
# The last symbol of a word is a symbol of its own; it gets a code point above all byte symbols.
_END = 0x400
# Fixed value: the words of lower-case ASCII text.
_PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


class WordBpe:
    """Encoder and decoder for a vocabulary file with word ends and byte symbols."""

    def __init__(self, vocabulary: str):
        import ahocorasick
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        model = spec["model"]
        ids, suffix = model["vocab"], model["end_of_word_suffix"]
        if not suffix:
            raise ValueError("a vocabulary with word ends is needed")
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("|".join(map(re.escape, self.specials)) or r"(?!)")
        # Case, composition and the cut into words of byte symbols follow the library's tables.
        cutter = Tokenizer.from_str(vocabulary)
        self._normalize = cutter.normalizer.normalize_str
        self._cut = cutter.pre_tokenizer.pre_tokenize_str
        size = 1 + max([*ids.values(), *self.specials.values()])
        text = [""] * size
        for token, i in ids.items():
            if len(token) == 1:
                text[i] = token
            elif token.endswith(suffix) and len(token) == len(suffix) + 1:
                text[i] = chr(ord(token[0]) + _END)
        # Merge number of each token (-1: a symbol), its two parts, and the number of each pair.
        self._born = [-1] * size
        self._left, self._right = [-1] * size, [-1] * size
        self._pairs: dict[tuple[int, int], int] = {}
        for number, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, i = ids[left], ids[right], ids[left + right]
            text[i] = text[a] + text[b]
            self._born[i], self._left[i], self._right[i] = number, a, b
            self._pairs[a, b] = number
        self._length = [len(t) for t in text]
        by_text = {t: i for i, t in enumerate(text) if t}
        self._tokens = ahocorasick.Automaton()
        for t, i in by_text.items():
            self._tokens.add_word(t, i)
        self._tokens.make_automaton()
        # The longest shorter token that each token begins with.
        self._shorter = [
            next((by_text[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in by_text), -1)
            for t in text
        ]
        self._fits: dict[tuple[int, int], bool] = {}
        self._kept: dict[bytes, bytes] = {}
        # Decoding: all token texts in one buffer, each followed by a blank, and their offsets.
        shown = [b""] * size
        for token, i in [*ids.items(), *self.specials.items()]:
            shown[i] = token.encode() + b" "
        self._buffer = np.frombuffer(b"".join(shown), np.uint8)
        self._sizes = np.array([len(s) for s in shown], np.int64)
        self._offsets = np.concatenate([[0], np.cumsum(self._sizes)[:-1]])

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave `left` and `right` side by side."""
        until = float("inf")
        while True:
            joined = self._pairs.get((left, right))
            if joined is not None and joined < until:
                return False
            a, b = self._born[left], self._born[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                until, left = a, self._right[left]
            else:
                # Of equal merges the leftmost comes first, so the border wins over its right.
                until, right = b + 0.5, self._left[right]

    def encode_word(self, word: str) -> list[int]:
        """Tokens of one word, given as byte symbols."""
        word = word[:-1] + chr(ord(word[-1]) + _END)
        longest = [-1] * len(word)
        for end, token in self._tokens.iter(word):
            longest[end - self._length[token] + 1] = token  # ends grow, so the longest stays
        found: list[int] = []
        closed = bytearray(len(word) + 1)  # positions from which the rest can't be encoded
        at, token = 0, longest[0]
        while at < len(word):
            last = found[-1] if found else -1
            while token >= 0:
                end = at + self._length[token]
                if not closed[end] and (last < 0 or self._fit(last, token)):
                    break
                token = self._shorter[token]
            if token >= 0:
                found.append(token)
                at = end
                token = longest[at] if at < len(word) else -1
            elif found:
                closed[at] = 1
                found.pop()
                at -= self._length[last]
                token = self._shorter[last]
            else:
                raise ValueError("the vocabulary lacks a symbol of the word")
        return found

    def _fit(self, left: int, right: int) -> bool:
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) >= _PAIRS_KEPT:
                self._fits.clear()
            known = self._fits[left, right] = self._compatible(left, right)
        return known

    def _plain(self, text: str) -> list[int]:
        if text.isascii() and text.isprintable():
            words = _PLAIN_WORDS.findall(text.lower())  # what the library gives, without its objects
        else:
            words = [word for word, _ in self._cut(self._normalize(text))]
        out: list[int] = []
        for word in words:
            out += self.encode_word(word)
        return out

    def encode_text(self, text: str) -> list[int]:
        """Tokens of a text; the texts of special tokens become those tokens."""
        out, at = [], 0
        for m in self._special.finditer(text):
            out += [*self._plain(text[at : m.start()]), self.specials[m[0]]]
            at = m.end()
        return out + self._plain(text[at:])

    def _piece(self, piece: bytes) -> bytes:
        ids = np.array(self.encode_text(piece.decode()), "<u4").tobytes()
        if len(piece) <= _PIECE_BYTES and len(self._kept) < _PIECES_KEPT:
            self._kept[piece] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit integers.

        Words never reach over white space, so texts are cut there and frequent pieces are
        encoded once.
        """
        kept, piece = self._kept.get, self._piece
        return b"".join([kept(p) or piece(p) for p in text.split()])

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of the ids: token texts with blanks between."""
        tokens = np.frombuffer(ids, "<u4")
        if not len(tokens):
            return b""
        sizes = self._sizes[tokens]
        ends = np.cumsum(sizes)
        at = np.repeat(self._offsets[tokens] - ends + sizes, sizes)
        at += np.arange(ends[-1])
        return self._buffer[at].tobytes()[:-1]


@functools.lru_cache(maxsize=2)
def _codec(vocabulary: str) -> WordBpe:
    return WordBpe(vocabulary)


def encode_decode(docs: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None,
                  values: Sequence[str] = ("token_ids", "decoded")) -> DataFrame:
    """Encode every text and decode the ids again.

    `vocabulary` is the path of a vocabulary file that the driver can read; its content (a few
    MB, whatever the data) is broadcast. Adds n_tokens, ids_sha256 (of the ids as little-endian
    unsigned 32-bit integers), decoded_sha256, and those of token_ids and decoded that `values`
    names, to the columns `keep` (default: all, without those of the added names, which are
    replaced).

    A null text counts as empty: no tokens, decoded to an empty text. Each row stands alone, so
    repeated rows give equal results, an empty table an empty one, and a long text costs memory
    for itself only. There is no shuffle.
    """
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(Path(vocabulary).read_text(encoding="utf-8"))
    kinds = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string",
             "token_ids": "array<int>", "decoded": "string"}
    arrow = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    added = [n for n in kinds if n in values or n not in ("token_ids", "decoded")]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    schema = docs.select(*keep).schema
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema]
    # A text that is kept moves to the tasks once.
    once = text in keep and schema[text].dataType == T.StringType()
    at = keep.index(text) if once else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(content.value)
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            for first, end in slices(texts, _TEXT_BYTES):
                found: dict[str, list] = {n: [] for n in added}
                for value in texts.slice(first, end - first):
                    ids = codec.encode(value.as_py() or b"")
                    decoded = codec.decode(ids)
                    row = {"n_tokens": len(ids) // 4, "ids_sha256": hashlib.sha256(ids).hexdigest(),
                           "decoded_sha256": hashlib.sha256(decoded).hexdigest(),
                           "token_ids": np.frombuffer(ids, "<i4"), "decoded": decoded}
                    for n in added:
                        found[n].append(row[n])
                columns = [c.slice(first, end - first) for c in batch.columns[: len(keep)]]
                columns += [pa.array(found[n], pa.binary()).cast(pa.string()) if n == "decoded"
                            else pa.array(found[n], arrow[kinds[n]]) for n in added]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *added])

    given = docs.select(*[docs[c] for c in keep], *([] if once else [docs[text].cast("string").alias("_text")]))
    return given.mapInArrow(run, ", ".join([*fields, *[f"{n} {kinds[n]}" for n in added]]))
