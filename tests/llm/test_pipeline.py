"""The pipeline against the plain computation of all its stages."""

from __future__ import annotations

import hashlib

import brute
import pytest
from samples import corpus, frame
from test_operators import benchmark_rows, check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from panelworks.llm import queries, toxicity


@pytest.fixture(scope="module")
def folder(llm, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    rows = corpus() + [(1000 + i, f"you are stupid trash {'a' * i} fool {i}") for i in range(40)]
    frame(llm, rows).write.parquet(f"{root}/documents.parquet")
    labels = [(i, 1, int(i >= 1000)) for i, _ in rows if i % 3]
    llm.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    llm.createDataFrame(benchmark_rows(), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), rows


def test_stages_keep_what_they_should(llm, folder):
    root, rows = folder
    docs = llm.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    model = toxicity.fit(docs, llm.read.parquet(f"{root}/labels.parquet").filter(~queries.held_out(5, 0)))
    rejected = {r["doc_id"] for r in toxicity.score(docs, model).filter("predicted = 1").collect()}
    assert len(rejected & set(range(1000, 1040))) >= 38
    current = [r for r in rows if r[0] not in rejected]

    def after(step, docs):
        out = corpus_pipeline.STAGES[step][1](llm, docs, root)
        return out, sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)

    out, found = after(0, docs)
    assert out.columns == columns and found == sorted(current, key=repr)

    out, found = after(1, out)
    kept = {i for i, _, _, k in brute.near(current) if k}
    current = [r for r in current if r[0] in kept]
    assert out.columns == columns and found == sorted(current, key=repr)

    out, found = after(2, out)
    assert out.columns == columns
    digests = {i: d for i, _, _, _, d in brute.removal(current, corpus_pipeline.PASSAGE_BYTES)}
    for i, t in found:
        assert hashlib.sha256((t or "").encode()).hexdigest() == digests[i]
    current = found

    out, found = after(3, out)
    dirty = {r[0] for r in brute.contamination(current, benchmark_rows()) if r[5]}
    current = [r for r in current if r[0] not in dirty]
    assert out.columns == columns and found == sorted(current, key=repr)

    content = queries.vocabulary("byte_bpe_50k.json")
    out = corpus_pipeline.STAGES[4][1](llm, out, root)
    check_packing(out.collect(), current, Tokenizer.from_str(content), 1024)

    whole = corpus_pipeline.run(llm, root)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(*key).collect())) == sorted(map(tuple, out.select(*key).collect()))


def test_freed_memory_of_a_worker_goes_back_to_the_system():
    """Many arrays below the size that the allocator maps for itself, with one kept above them."""
    import numpy as np

    from panelworks.llm import text as T

    def resident():
        with open("/proc/self/statm") as held:
            return int(held.read().split()[1]) * 4096

    arrays = [np.ones(60_000, np.uint8) for _ in range(3000)]
    kept = arrays[-1]
    del arrays
    before = resident()
    T.give_back()
    assert before - resident() > 100 << 20 and kept[0] == 1
