"""Alignment of two tokenizers against brute force."""

import base64
import hashlib
import json
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from irspark.llm import alignment
from irspark.llm.query_alignment import op12_alignment

from .conftest import DIR

FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def tokens_of():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        shown = {int(i): base64.b64decode(t) for t, i in map(bytes.split, f)}
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[1])

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def encode(text):
        if not text:
            return [], []
        left = [(i, shown[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, piece(i)) for i in b.encode(text)]
        want = (" " + text).encode()
        return (left, right) if all(b"".join(t for _, t in side) == want for side in (left, right)) else ([], [])

    return encode


def own_groups(left, right):
    """Groups of ids, by walking both sides byte by byte."""
    ends = []
    for side in (left, right):
        at, own = 0, []
        for i, shown in side:
            at += len(shown)
            own.append((at, i))
        ends.append(own)
    cuts = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
    return [tuple([i for e, i in own if low < e <= cut] for own in ends) for low, cut in zip([0, *cuts], cuts)]


def brute(texts):
    """Expected numbers of each text."""
    encode = tokens_of()
    kept, seen = [], Counter()
    for text in texts:
        left, right = encode(text)
        groups = own_groups(left, right) if len(text or "") < 20_000 else None
        links = Counter()
        for x, y in groups:
            links.update((i, j) for i in x for j in y)
        seen.update(set(links))
        kept.append((len(left), len(right), groups, links))
    highest = defaultdict(int)
    for (i, _), n in seen.items():
        highest[i] = max(highest[i], n)
    out = []
    for n_a, n_b, groups, links in kept:
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((n_a, n_b, len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if seen[p] == highest[p[0]]),
                    sum(n * seen[p] for p, n in links.items()),
                    hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return out


def got(rows):
    return [tuple(r[c] for c in alignment.ADDED) for r in rows]


@pytest.mark.parametrize("run_bytes, fan", [(2_000_000, 256), (3_000, 3)])
def test_whole_table(spark, monkeypatch, run_bytes, fan):
    monkeypatch.setattr(alignment, "_RUN_BYTES", run_bytes)
    monkeypatch.setattr(alignment, "_FAN", fan)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    rows = sorted(op12_alignment(spark, DIR).collect())
    assert [r.doc_id for r in rows] == sorted(docs)
    assert got(rows) == brute([docs[r.doc_id] for r in rows])


ODD = [None, "", " ", "  two  blanks ", "▁marked", "ﬁnal ½", "<|endoftext|> <s> <unk> <0x41>", "\x00\x01", "àé",
       "\U0001f600\U0001f1e9\U0001f1ea" * 40, "你好世界" * 30, "word " * 900, "x" * 3000, "line\nline\t\r\n", "same text", "same text", "éè" * 50]


def test_groups_of_many_links(monkeypatch):
    """Counting equal ids before they are paired changes nothing."""
    pair = alignment.Pair(open(FILES[0], encoding="utf-8").read(), open(FILES[1], "rb").read())
    texts = [t.encode() if t else t for t in ODD]
    plain = pair.align(texts)
    monkeypatch.setattr(alignment, "_WIDE", 2)
    counted = pair.align(texts)
    for name in ("keys", "radices", "seen", "slots", "times"):
        assert getattr(plain, name).tolist() == getattr(counted, name).tolist()
    assert plain.times.max() > 1


def test_encoders_agree():
    """The encoder by ranks gives what the library gives, and leaves other vocabularies to it."""
    text = open(FILES[0], encoding="utf-8").read()
    pair = alignment.Pair(text, open(FILES[1], "rb").read())
    spec = json.loads(text)
    by_ranks = alignment._by_ranks(spec, [pair.bytes_a([i]).tobytes() for i in range(pair.size_a)])
    texts = [" " + t for t in ODD if t] + ["it's I'LL ' s", "\u00a0\u2003 x", "\u0661\u0662 \u00bd", " " * 3000 + "a"]
    assert [i.tolist() for i in by_ranks(texts)] == [i.tolist() for i in alignment._by_library(text)(texts)]
    assert alignment._by_ranks(spec | {"normalizer": {"type": "Lowercase"}}, []) is None


def test_odd_texts(spark, documents):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (15, "same text")]
    docs = documents(rows).withColumnsRenamed({"lang": "n_best", "source": "_run", "n_chars": "run"})
    out = alignment.align(docs, *FILES)
    assert out.columns == ["doc_id", "text", "_run", "run", *alignment.ADDED]
    found = sorted(out.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert got(found) == brute([r.text for r in found])
    assert found[0].groups_sha256 == "" and found[14].n_a > 0
    assert alignment.align(docs.limit(0), *FILES).count() == 0
    assert got(alignment.align(documents([(1, None), (2, "")]), *FILES).collect()) == [(0,) * 6 + ("",)] * 2
