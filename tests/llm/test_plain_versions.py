"""Classifiers against scalar loops, hashes that collide, and columns and ids that clash."""

from __future__ import annotations

import math
import random

import brute
import numpy as np
import pytest
from samples import corpus, frame, prose
from test_trie_pivots_align import rows_of, thue_morse

import corpus_pipeline
from panelworks.llm import decontam, neardup, quality, suffixdedup, toxicity
from panelworks.llm import text as T


def plain_ftrl(rows, alpha=0.5, beta=1.0, l1=8.0, l2=1.0, epochs=5):
    """One coordinate after the other."""
    z, n, z0, n0 = {}, {}, 0.0, 0.0

    def weight(c):
        if abs(z.get(c, 0.0)) <= l1:
            return 0.0
        return -(z[c] - math.copysign(l1, z[c])) / ((beta + math.sqrt(n[c])) / alpha + l2)

    for _ in range(epochs):
        for at, label in rows:
            w = {c: weight(c) for c in at}
            w0 = -z0 / ((beta + math.sqrt(n0)) / alpha)
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()) + w0)))) - label
            for c in at:
                rate = (math.sqrt(n.get(c, 0.0) + g * g) - math.sqrt(n.get(c, 0.0))) / alpha
                z[c] = z.get(c, 0.0) + g - rate * w[c]
                n[c] = n.get(c, 0.0) + g * g
            z0 += g - (math.sqrt(n0 + g * g) - math.sqrt(n0)) / alpha * w0
            n0 += g * g
    return {c: weight(c) for c in z if weight(c)}, -z0 / ((beta + math.sqrt(n0)) / alpha)


def test_ftrl_is_that_of_a_scalar_loop():
    rng = random.Random(4)
    rows = []
    for _ in range(120):
        label = int(rng.random() < 0.4)
        at = set(rng.sample(range(60), 8)) | ({61, 62} if label else {63})
        rows.append((np.array(sorted(at), np.int32), label))
    model = toxicity.ftrl(rows, bits=6, l1=1.0)
    weights, bias = plain_ftrl([(at.tolist(), label) for at, label in rows], l1=1.0)
    assert model.at.tolist() == sorted(weights) and abs(model.bias - bias) < 1e-9
    assert np.allclose(model.weight, [weights[c] for c in sorted(weights)], atol=1e-5)


def test_toxic_features_are_the_distinct_words_pairs_and_skip_pairs():
    texts = ["One two  three, TWO one", "", "a", "b b b b", "ünï ünï x1 y"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    owner, at = toxicity.coordinates(*toxicity._hashed(data, offsets), 20)
    alnum = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))

    def named(word: bytes) -> int:
        return int(T.word_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0])

    for k, text in enumerate(raw):
        words = bytes(b if b in alnum else 32 for b in text.lower()).split()
        values = set()
        for cut in toxicity.STEMS:
            values |= {(named(w[:cut]) + cut) % 2**64 for w in words}
        values |= {named(w) for w in words}
        for gap, salt in ((1, 3), (2, 5)):
            values |= {(named(a) * salt + named(b) + gap) % 2**64 for a, b in zip(words, words[gap:])}
        wanted = {int(T.mixed(np.array([v], np.uint64))[0] >> np.uint64(44)) for v in values}
        assert set(at[owner == k].tolist()) == wanted


def test_pooled_is_that_of_a_loop_over_bytes_and_filters():
    rng = np.random.default_rng(5)
    table = rng.normal(size=(quality.WIDTH, 256, 3)).astype(np.float32)
    bias = rng.normal(size=3).astype(np.float32)
    sizes = [0, 3, 511, 512, 513, 1500]
    raw = [rng.integers(0, 256, n).astype(np.uint8) for n in sizes]
    offsets = np.cumsum([0, *sizes])
    found = quality.pooled(np.concatenate(raw), offsets, table, bias)
    step = quality.CHUNK - quality.WIDTH + 1
    for k, text in enumerate(raw):
        best = []
        for start in range(0, max(1, len(text) - quality.WIDTH + 1), step):
            chunk = [*text[start : start + quality.CHUNK].tolist()]
            chunk += [quality.PAD] * (quality.CHUNK - len(chunk))
            own = []
            for f in range(3):
                all_ = [bias[f] + sum(table[w][chunk[p + w]][f] for w in range(quality.WIDTH)) for p in range(step)]
                own.append(max(0.0, *all_))
            best.append(own)
        wanted = np.concatenate([np.mean(best, axis=0), np.max(best, axis=0)])
        assert np.allclose(found[k], wanted, atol=1e-3)


def test_the_text_that_is_learned_does_not_depend_on_the_order(llm):
    rows = [(i, f"text {i} " + ("bad" if i % 2 else "fine")) for i in range(40)]
    rows += [(1, f"another text {k}") for k in range(30)]
    labels = llm.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    first, second = (toxicity.labelled_sample(frame(llm, r, parts), labels, "toxic", 100) for r, parts in ((rows, 1), (rows[::-1], 5)))
    assert rows_of(first, "doc_id", "text", "_label") == rows_of(second, "doc_id", "text", "_label")
    assert first.count() == 40


@pytest.mark.parametrize("length", [1024, 2048])
def test_words_that_collide_are_not_near_duplicates(llm, length):
    a, b = thue_morse(length)
    rows = [(1, " ".join([a] * 6)), (2, " ".join([b] * 6)), (3, f"{a} {b} {a} {b} {a}"), (4, " ".join([a] * 6))]
    found = rows_of(neardup.near_duplicates(frame(llm, rows)), "doc_id", "n_shingles", "component_id", "kept")
    assert found == sorted(brute.near(rows), key=repr)
    data = np.frombuffer((a + b).encode(), np.uint8)
    h = T.sure_word_hashes(data, np.array([0, length]), np.array([length, 2 * length]))
    assert h[0] != h[1]


def test_hashes_do_not_depend_on_the_slice():
    word = b"whatever"
    for before in (0, 5, 300):
        data = np.frombuffer(b"x" * before + word, np.uint8)
        h = T.sure_word_hashes(data, np.array([before]), np.array([before + len(word)]))
        assert h[0] == T.sure_word_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0]


CLASHING = ["_id", "_text", "kept", "_rid", "_row", "_hit", "score", "_order", "node", "_KEPT"]


@pytest.mark.parametrize("stage", range(4))
def test_stages_with_clashing_columns(llm, tmp_path, stage):
    rows = [r for r in corpus(plain=5)] + [(7, "twice"), (7, "twice"), (None, None)]
    names = CLASHING[:-1]
    docs = llm.createDataFrame([(i, t, *["own"] * len(names)) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    llm.createDataFrame([(i, 1, int(i % 7 == 0)) for i, _ in rows if i], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    llm.createDataFrame([(None, prose(random.Random(1), 20)), (1, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = corpus_pipeline.STAGES[stage][1](llm, docs.select("doc_id", "text"), str(tmp_path))
    out = corpus_pipeline.STAGES[stage][1](llm, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert rows_of(out, "doc_id", "text") == rows_of(plain, "doc_id", "text")
    assert out.filter(" OR ".join(f"`{c}` <> 'own'" for c in names)).count() == 0


def test_passages_of_fifty_words_go_in_the_pipeline_stage(llm, tmp_path):
    rng = random.Random(9)
    passages = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.choice([3, 4, 5, 6, 7]))) for _ in range(52)) for _ in range(5)]
    rows = []
    for k in range(40):
        shared = [passages[k % 5]] if k < 20 else []
        rows.append((k, " ".join([prose(rng, 60), *shared, prose(rng, 40)])))
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_strings_out(llm, frame(llm, rows), "").collect()}
    assert all(passages[k % 5][10:-10] not in out[k] for k in range(20))
    assert all(out[k] == rows[k][1] for k in range(20, 40))


def test_items_without_an_id_are_items(llm):
    """A null item_id is an item of the name ``None``."""
    item = prose(random.Random(2), 20)
    found = decontam.contamination(frame(llm, [(1, item), (2, "clean text")]), llm.createDataFrame([(None, item)], "item_id long, text string"))
    assert rows_of(found, "doc_id", "n_items", "contaminated") == [(1, 1, True), (2, 0, False)]


def test_equal_long_suffixes_are_ordered_in_linear_time():
    strings = [b"a" * 700 + bytes([k % 251, k // 251]) for k in range(2000)]
    order = suffixdedup.blind_trie(strings)
    assert [strings[i] for i in order] == sorted(strings)
