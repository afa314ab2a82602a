"""The corpus pipeline, each stage against brute force on its own input."""

import hashlib
from collections import Counter

import pytest
from test_mixing import targets
from test_quality import brute as quality_brute
from test_simhash import brute_components, brute_fp

import corpus_pipeline as C
from barlake.llm import bpe

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage over the smallest tables."""
    import os
    from conftest import SF001
    base = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(os.path.join(SF001, "documents.parquet")), {}
    before = docs.collect()
    for i, (name, f) in enumerate(C.STAGES):
        f(spark, docs, SF001).write.parquet(str(base / str(i)))
        docs = spark.read.parquet(str(base / str(i)))
        after = docs.collect()
        out[name] = (before, after, docs.columns)
        before = after
    return out


def test_columns_of_documents_until_the_last(stages):
    assert [n for n, _ in C.STAGES] == list(stages) == ["quality rules", "simhash near-dedup", "pii surrogates", "mix sources", "bpe"]
    for name, (_, _, columns) in list(stages.items())[:-1]:
        assert columns == COLUMNS, name


def test_quality_stage_keeps_what_the_rules_keep(stages):
    before, after, _ = stages["quality rules"]
    kept = {r[0] for r in quality_brute([(r.doc_id, r.text, r.lang) for r in before]) if r[7]}
    assert Counter(after) == Counter(r for r in before if r.doc_id in kept) and 0 < len(after) < len(before)


def test_one_document_of_each_group_stays(stages):
    before, after, _ = stages["simhash near-dedup"]
    fp = {r.doc_id: brute_fp(r.text) for r in before}
    root = brute_components(set(fp.values()))
    best = {}
    for i, f in fp.items():
        best[root[f]] = min(best.get(root[f], i), i)
    assert Counter(after) == Counter(r for r in before if r.doc_id in best.values())


def test_mentions_are_replaced_and_all_else_stays(stages):
    import re
    before, after, _ = stages["pii surrogates"]
    new = {r.doc_id: r for r in after}
    found = re.compile(r"[a-z]+\.\d\d@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|AKIA[A-Z0-9]{16}|password=\w+|token = \"\w+\"|\b\d+\.\d+\.\d+\.\d+\b")
    assert len(after) == len(before)
    for r in before:
        n = new[r.doc_id]
        assert n.n_chars == len(n.text) and (n.lang, n.source) == (r.lang, r.source)
        mentions = found.findall(r.text)
        assert not any(m in n.text for m in mentions)
        if not re.search(r"\d", r.text):
            assert n.text == r.text


def test_mix_takes_near_its_targets_with_whole_copies(stages):
    before, after, _ = stages["mix sources"]
    size = lambda r: len(r.text.split())
    sizes = Counter()
    for r in before:
        sizes[r.source] += size(r)
    want, got, times = targets(sizes), Counter(), Counter(after)
    for r, n in times.items():
        got[r.source] += n * size(r)
    assert set(times) <= set(before) and max(times.values()) <= 3
    for s, t in want.items():
        assert abs(got[s] - t) <= max(size(r) for r in before if r.source == s)


def test_ids_are_those_of_the_library(stages):
    before, after, _ = stages["bpe"]
    tok = bpe.load_tokenizer(bpe.vocabulary_path())
    import numpy as np

    def row(r):
        ids = tok.encode(r.text, add_special_tokens=False).ids
        return (r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest())

    assert Counter(map(tuple, after)) == Counter(map(row, before))


def test_odd_rows_pass_every_stage(spark, tmp_path):
    long = " ".join(f"word{i}" for i in range(60_000))
    rows = [(1, None, None, None, None, "a"), (None, "some text " * 40, "en", None, 3, None), (2, "", "en", "s", 0, None), (3, long, "en", "s", len(long), "x")]
    rows += [(4, "the same row twice " + long[:3000], "en", "s", 1, "y")] * 2 + [(None, None, None, None, None, None)] * 2
    for data in (rows, []):
        docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, quality string")
        for i, (_, f) in enumerate(C.STAGES):
            path = str(tmp_path / f"{len(data)}-{i}")
            f(spark, docs, "").write.parquet(path)
            docs = spark.read.schema(docs.schema if i < 4 else "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string").parquet(path)
        assert sorted({r.doc_id for r in docs.collect()}) == ([3, 4] if data else [])
