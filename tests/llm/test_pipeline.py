"""The pipeline, stage by stage, against brute force."""

from collections import Counter

import corpus_pipeline as pipeline
from irspark.llm import quality
from irspark.llm.registry import table

from .conftest import DIR
from .test_dedup import all_pairs
from .test_layout import water_fill
from .test_lines import expected as without_lines
from .test_quality import WORD, base
from .test_tokens import expected as encoded


def stage(spark, tmp_path, name, docs):
    dict(pipeline.STAGES)[name](spark, docs, DIR).write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def check(spark, tmp_path, docs):
    """Every stage on what the one before it has written; rows may lack unique ids."""
    given = docs
    rows = given.collect()
    kept = stage(spark, tmp_path, "quality", given)
    assert kept.columns == given.columns
    verdicts = quality.judge(given).collect()
    assert Counter(map(tuple, kept.collect())) == Counter(
        tuple(r[c] for c in given.columns) for r in verdicts if r.kept)
    assert all(not base(r.text)[-1] for r in kept.collect())
    assert len(rows) == len(verdicts)

    cleaned = stage(spark, tmp_path, "lines", kept)
    assert cleaned.columns == given.columns
    unique = kept.select("doc_id").distinct().count() == kept.count()
    if unique:
        before = {r.doc_id: r.text for r in kept.collect()}
        want = {d: t for d, t in without_lines(list(before.items())).items()
                if not before[d] or 100 * len(t) // len(before[d]) >= pipeline.LEAST_KEPT_PERCENT}
        assert {r.doc_id: r.text for r in cleaned.collect()} == want
        assert all(r.n_chars == len(r.text) for r in cleaned.collect())

    single = stage(spark, tmp_path, "minhash", cleaned)
    left = [(i, r.text) for i, r in enumerate(sorted(cleaned.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0)))]
    assert len(single.collect()) == len({c for _, _, c in all_pairs(left, 5)})
    if unique:
        pairs = all_pairs([(r.doc_id, r.text) for r in cleaned.collect()], 5)
        assert sorted(r.doc_id for r in single.collect()) == sorted(d for d, _, c in pairs if d == c)

    mixed = stage(spark, tmp_path, "mix", single)
    sizes, taken = Counter(), Counter()
    for r in single.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    longest = max((len(WORD.findall(r.text or "")) for r in single.collect()), default=0)
    for r in mixed.collect():
        taken[r.source] += len(WORD.findall(r.text or ""))
    for source, target in water_fill(sizes, (5, 2, 1), 1.5, 2.0).items() if sizes else ():
        assert target - 1 <= taken[source] <= target + longest

    last = dict(pipeline.STAGES)["encode"](spark, mixed, DIR).collect()
    assert len(last) == mixed.count()
    for r in last[:200]:
        assert (r.token_ids, r.n_tokens) == (encoded(r.text)[0], len(encoded(r.text)[0]))
    return last


def test_whole_table(spark, tmp_path):
    last = check(spark, tmp_path, table(spark, DIR, "documents"))
    assert Counter((r.doc_id, r.ids_sha256) for r in last) == Counter(
        (r.doc_id, r.ids_sha256) for r in pipeline.run(spark, DIR).collect())


def test_odd_rows(spark, documents, tmp_path):
    clean = [r for r in table(spark, DIR, "documents").collect()][:25]
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in clean]
    rows += [(None, rows[0][1], "en", None, None), (None, rows[0][1], "en", None, None), (None, rows[3][1] + " more", None, None, 1)]
    rows += [rows[5]] * 3 + [(900, None, None, None, None), (901, "", "", "", 0), (902, "long " * 30_000, "en", "s", 5)]
    check(spark, tmp_path, documents(rows))


def test_empty_table(spark, documents, tmp_path):
    assert check(spark, tmp_path, documents([])) == []


def test_first_copies_and_unique_lines_stay(spark, documents, tmp_path):
    shared = [f"shared line number {i} of the first document, about {'abcdefgh'[i] * 9}" for i in range(8)]
    passage = [f"the passage {c * 12} is repeated by later documents {c * 15}" for c in "pqr"]
    own = {d: f"document {d} says {c * 30} and nobody else" for d, c in ((0, "x"), (1, "y"), (5, "z"), (9, "w"))}
    texts = {0: [own[0], *shared], 1: [own[1], *shared, *passage], 5: [own[5], *passage], 9: [*passage, own[9]], 12: shared}
    cleaned = stage(spark, tmp_path, "lines", documents([(d, "\n".join(t), "en", "web", 1) for d, t in texts.items()]))
    left = {r.doc_id: r.text for r in cleaned.collect()}
    assert {d: left[d].split("\n") for d in own} == {0: [own[0], *shared], 1: [own[1], *passage], 5: [own[5]], 9: [own[9]]}
    # Of document 12 nothing remains, and it does not reach the corpus.
    assert left[12] == ""
    single = stage(spark, tmp_path, "minhash", cleaned)
    assert 12 not in {r.doc_id for r in stage(spark, tmp_path, "mix", single).collect()}


def test_kept_texts_move_to_the_tasks_once(spark, documents):
    """quality and encode sent a kept text twice, which the executors' memory had no room for."""
    from irspark.llm import bpe, quality
    from irspark.llm.query_tokens import vocabulary_path

    docs = documents([(1, "some words of a text", "en", "web"), (2, None, None, None)])
    for out in (quality.judge(docs), bpe.encode_decode(docs, vocabulary_path(), values=["token_ids"])):
        assert "AS _text" not in out._jdf.queryExecution().toString()
        assert {(r.doc_id, r.text, r.lang) for r in out.collect()} == {(1, "some words of a text", "en"), (2, None, None)}
