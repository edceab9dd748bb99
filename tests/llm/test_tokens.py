"""Encoding, decoding and token files against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from irspark.llm import bpe, tokens
from irspark.llm.query_tokens import op9_bpe, op10_token_files, vocabulary_path
from irspark.llm.registry import table

from .conftest import DIR

CONTENT = open(vocabulary_path(), encoding="utf-8").read()
LIBRARY = Tokenizer.from_str(CONTENT)
CODEC = bpe.WordBpe(CONTENT)
ENCODER = tokens.LibraryEncoder(CONTENT)
ODD = [None, "", " \t\n", "a", "Don't  STOP'll 12٣ é é Σας İ", "x<|endoftext|>Y<|startoftext|>", "a\x1cb\x85c",
       "中文字🙂" * 50, "ab" * 40_000, "aaaa" * 3000, "the cat " * 20_000]


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list("aabcdeinrsth .'ABΣſİ12é́\x1c\x85 字🙂\n\t")) | st.characters(codec="utf-8"), max_size=40))
def test_codec_equals_library(text):
    ids, decoded = expected(text)
    own = CODEC.encode(text.encode())
    assert np.frombuffer(own, "<u4").tolist() == ids
    assert CODEC.decode(own).decode() == decoded
    assert np.frombuffer(ENCODER.encode([text.encode()])[0], "<u4").tolist() == ids


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["a", "Ab", "s", "'", "'s", ".", ",", "1", " ", "\n", "<|endoftext|>", "<|", "<|ENDOFTEXT|>", "é", "É", "÷", "ß", "ÿ", "×", "à", "\u0301", "\u0338", "=", "\x1c", "«", "\u3000"]), max_size=14))
def test_library_encoder_pieces(parts):
    text = "".join(parts)
    assert np.frombuffer(ENCODER.encode([text.encode()])[0], "<u4").tolist() == expected(text)[0]


def test_encode_decode_odd_rows(documents):
    rows = [(i if i else None, t) for i, t in enumerate(ODD)] + [(1, ""), (1, "")]
    docs = documents([(d, t, "x", "y", 5) for d, t in rows]).withColumnRenamed("n_chars", "n_tokens")
    out = bpe.encode_decode(docs, vocabulary_path()).collect()
    assert len(out) == len(rows)
    for r in out:
        ids, decoded = expected(r.text)
        assert (r.token_ids, r.decoded, r.n_tokens) == (ids, decoded, len(ids))
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_encode_decode_empty_table(documents):
    assert bpe.encode_decode(documents([]), vocabulary_path()).count() == 0


def test_op9_whole_table(spark):
    docs = {r.doc_id: r.text for r in table(spark, DIR, "documents").collect()}
    out = op9_bpe(spark, DIR).collect()
    assert sorted(r.doc_id for r in out) == sorted(docs)
    for r in out:
        ids, decoded = expected(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 255, 256, 65535, 65536, 2**24, 2**32 - 1]) | st.integers(0, 70_000), max_size=900), max_size=5))
def test_segment_round_trip_and_random_access(docs):
    given_ids = [np.array(d, "<u4") for d in docs]
    segment = tokens.Segment(tokens.pack([(i or None, d) for i, d in enumerate(given_ids)]))
    flat = [x for d in docs for x in d]
    assert segment.ids().tolist() == flat
    assert [segment.token(i) for i in range(len(flat))] == flat
    assert segment.docs["n"].tolist() == [len(d) for d in docs]
    with pytest.raises(IndexError):
        segment.token(len(flat))


def brute_force(rows):
    """(doc_id, start, n_tokens, crc) in ascending order; rows of one id in any order."""
    out, at = [], 0
    for d, t in rows:
        ids = np.array(expected(t)[0] + [1], "<u4")
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_op10_whole_table(spark):
    docs = sorted((r.doc_id, r.text) for r in table(spark, DIR, "documents").collect())
    got = sorted(tuple(r) for r in op10_token_files(spark, DIR).collect())
    assert got == brute_force(docs)


def test_token_files_odd_rows(spark, documents):
    rows = [(i, t) for i, t in enumerate(ODD)]
    docs = documents([(d, t) for d, t in rows] + [(None, "z z"), (None, None), (3, "a"), (3, "a")])
    path = tokens.token_path(spark)
    tokens.write_tokens(docs.withColumnRenamed("n_chars", "part"), path, vocabulary_path(), end_id=1, segment_ids=50)
    got = sorted((tuple(r) for r in tokens.read_tokens(spark, path).collect()), key=lambda r: r[1])
    assert [g[1] for g in got] == [sum(g[2] for g in got[:i]) for i in range(len(got))]
    assert [g[0] for g in got] == [0, 1, 2, 3, 3, 3, *range(4, len(ODD)), None, None]
    want = brute_force(sorted(rows + [(3, "a"), (3, "a")], key=lambda r: r[0]))
    assert sorted((g[0], g[2], g[3]) for g in got[:-2]) == sorted((w[0], w[2], w[3]) for w in want)


def test_token_files_empty_table(spark, documents):
    path = tokens.token_path(spark)
    tokens.write_tokens(documents([]), path, vocabulary_path())
    assert tokens.read_tokens(spark, path).count() == 0


def test_marks_are_cut_as_by_plain_rule_and_letters_are_skipped():
    """the cuts of a search that tries every letter, in less than two thirds of its time."""
    import random
    import re
    import time

    plain = re.compile(rb"([a-z0-9]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])([^\sa-z0-9\x80-\xff']+)(?=\s|\Z)")
    r = random.Random(3)
    some = [b"a", b"z", b"0", b"'", b".", b",", b" ", b"\n", b"\x0b", b"\x1c", b"\xc3", b"\x96", b"\x97", b"\xe2\x80\x99", b"!", b"\x7f"]
    encoder = tokens.LibraryEncoder.__new__(tokens.LibraryEncoder)
    for _ in range(20_000):
        text = b"".join(r.choices(some, k=r.randrange(12)))
        assert encoder._pieces(text) == plain.sub(rb"\1 \2", text.lower()).split()

    def seconds(cut):
        times = []
        for _ in range(5):
            began = time.process_time()
            cut()
            times.append(time.process_time() - began)
        return min(times)

    text = b"ordinary words of plain text and a comma, then more of them. " * 5_000
    assert seconds(lambda: encoder._pieces(text)) < seconds(lambda: plain.sub(rb"\1 \2", text.lower()).split()) * 2 / 3
