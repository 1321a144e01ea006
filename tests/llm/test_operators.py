"""Each operator against the plain computation, with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import hashlib
import math
import random

import brute
import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F
from samples import corpus, frame, prose
from tokenizers import Tokenizer

from panelworks.llm import ann, decontam, encode, files, neardup, packing, quality, queries, store, suffixdedup, tokencount, tokenfile, toxicity, warc
from panelworks.llm import text as T

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same(found, wanted):
    assert found == sorted(wanted, key=repr)


# ---- suffix order ----------------------------------------------------------------------------


def test_deep_shallow_is_lexicographic():
    rng = random.Random(1)
    for _ in range(60):
        strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(30))) for _ in range(rng.randrange(1, 40))]
        strings += [b"a" * 90 + s for s in strings[:6]]
        order, common = suffixdedup.deep_shallow(strings, rng.choice([0, 8, 72]))
        got = [strings[i] for i in order]
        assert got == sorted(strings)
        for k in range(1, len(got)):
            n = next((i for i, (x, y) in enumerate(zip(got[k - 1], got[k])) if x != y), min(len(got[k - 1]), len(got[k])))
            assert common[k] == n


REMOVAL = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_removal(documents):
    same(rows_of(suffixdedup.removal_report(documents), *REMOVAL), brute.removal(corpus()))


def test_removal_of_repeated_rows_and_ids(llm):
    text = prose(random.Random(2), 120)
    rows = [(1, text), (1, text), (1, "other " + text[:600]), (None, text), (2, "short"), (2, "short"), (None, None)]
    same(rows_of(suffixdedup.removal_report(frame(llm, rows)), *REMOVAL), brute.removal(rows))


def covered(docs, hot):
    found, _ = suffixdedup.repeated_ranges(docs, hot_contexts=hot)
    return sorted((r["text"], sorted({i for x in r["_ranges"] for i in range(x["a"], x["b"])})) for r in found.collect())


def test_removal_with_runs_dealt_by_longer_runs(llm, documents):
    """Runs with many contexts are dealt again, some once, some down to windows, and give the same ranges."""
    whole = covered(documents, 10**9)
    assert whole and covered(documents, 3) == whole and covered(documents, 0) == whole


def test_removal_of_a_passage_that_many_texts_share(llm):
    """One passage of nearly the length in 150 texts: some share what stands before or behind it, or both."""
    rng = random.Random(11)
    passage = prose(rng, 80)[:380]
    before, behind = [prose(rng, 20) for _ in range(6)], [prose(rng, 20) for _ in range(6)]
    rows = []
    for i in range(150):
        left = rng.choice(before)[-rng.randrange(1, 60) :] if i % 2 else prose(rng, 10)
        right = rng.choice(behind)[: rng.randrange(1, 60)] if i % 3 else prose(rng, 10)
        rows.append((i, f"{prose(rng, 5)} {i} {left} {passage} {right} {i}"))
    docs = frame(llm, rows)
    found = covered(docs, 20)
    assert found == covered(docs, 10**9)
    removed = {t: len(c) for t, c in found}
    wanted = brute.removal(rows)
    assert any(r[2] for r in wanted)
    assert [removed.get(t, 0) for _, t in rows] == [r[2] for r in sorted(wanted)]


def test_removal_keeps_other_columns(llm):
    text = prose(random.Random(3), 100)
    rows = [(1, text, "x"), (2, text + " end", "y"), (3, None, "z")]
    docs = llm.createDataFrame(rows, "doc_id long, text string, _places string")
    out = suffixdedup.without_repeats(docs)
    assert out.columns == docs.columns
    assert rows_of(out, "doc_id", "text", "_places") == [(1, "", "x"), (2, " end", "y"), (3, None, "z")]


# ---- near duplicates -------------------------------------------------------------------------

NEAR = ["doc_id", "n_shingles", "component_id", "kept"]


def test_near_duplicates(documents):
    same(rows_of(neardup.near_duplicates(documents), *NEAR), brute.near(corpus()))


def test_near_duplicates_across_components(llm):
    """Chains in which the smallest member of a band is not linked with the others."""
    rng = random.Random(8)
    rows, n = [], 0
    for _ in range(6):
        chain = prose(rng, 120).split(" ")
        for _ in range(12):
            chain = chain[3:] + prose(rng, 3).split(" ")
            rows.append((n, " ".join(chain)))
            n += 1
    same(rows_of(neardup.near_duplicates(frame(llm, rows), block=2), *NEAR), brute.near(rows))


def test_near_duplicates_of_an_id_with_several_texts(llm):
    one, other = (" ".join(f"{c}{k}" for k in range(60)) for c in "xy")
    # whatever the order of their hashes, one of the blank texts comes before the full one
    blanks = [(5, b) for b in (None, "", *(" " * n for n in range(1, 12)))]
    rows = [(5, one), (5, other), (7, one + " and one more"), (3, other + " and the end"), (9, "alone"), *blanks]
    same(rows_of(neardup.near_duplicates(frame(llm, rows)), *NEAR), brute.near(rows))


def test_near_duplicates_of_repeated_and_unnamed_rows(llm):
    text = prose(random.Random(4), 50)
    rows = [(5, text), (5, text), (3, text), (None, text), (9, None), (9, None)]
    found = rows_of(neardup.near_duplicates(frame(llm, rows)), "doc_id", "component_id", "kept")
    assert found == sorted([(5, 3, False), (5, 3, False), (3, 3, True), (None, None, True), (9, 9, True), (9, 9, True)], key=repr)
    left = neardup.without_copies(frame(llm, rows))
    assert rows_of(left, "doc_id") == sorted([(3,), (9,), (None,)], key=repr)


def test_clean_texts_of_a_repeated_id_stay(llm):
    rng = random.Random(6)
    one, other, third = (prose(rng, 60) for _ in range(3))
    rows = [(1, one), (1, other), (1, one), (2, one), (3, third), (3, other + " end"), (4, None), (4, None), (4, ""), (None, one)]
    left = neardup.without_copies(frame(llm, rows))
    assert rows_of(left, "doc_id", "text") == sorted([(1, one), (1, other), (3, third), (4, None), (4, ""), (None, one)], key=repr)


def test_circulant_signature_is_the_shifted_permutation():
    h = T.mixed(np.arange(40, dtype=np.uint64))
    places, k = 1 << 10, 16
    order = neardup.permutation(places, k)[:places]
    at = neardup.scattered(h, places)
    wanted = [min(order[(p + s) % places] for p in at) for s in range(k)]
    assert neardup.signature(h, k, places).tolist() == wanted


# ---- decontamination ---------------------------------------------------------------------------

HITS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def benchmark_rows():
    rows = corpus()
    rng = random.Random(6)
    by_id = dict(rows)
    long = [t for t in by_id.values() if t and len(t.split()) > 60]
    items = [(n, " ".join(t.split()[5 : 5 + rng.randint(13, 30)]).upper()) for n, t in enumerate(sorted(long)[:8])]
    return items + [(20, "One two"), (21, "one"), (22, None), (23, ""), (24, "?!"), (3, prose(rng, 20)), (25, "case text mixed case text mixed case text mixed case text mixed case")]


@pytest.mark.parametrize("block_bytes", [8 << 20, 300])
def test_contamination(llm, documents, block_bytes):
    items = benchmark_rows()
    bench = llm.createDataFrame(items, "item_id long, text string")
    found = decontam.contamination(documents, bench, block_bytes=block_bytes)
    same(rows_of(found, *HITS), brute.contamination(corpus(), items))


def test_contamination_without_items_and_with_clashing_names(llm, documents):
    none = llm.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(documents, none).filter("n_hit > 0 OR contaminated").count() == 0
    items = benchmark_rows()
    bench = llm.createDataFrame(items, "item_id long, text string")
    docs = documents.withColumn("n_hit", F.lit("own")).withColumn("_row", F.lit(1))
    left = decontam.without_contaminated(docs, bench)
    assert left.columns == docs.columns
    clean = sorted(r[0] for r in brute.contamination(corpus(), items) if not r[5])
    assert sorted(r["doc_id"] for r in left.collect()) == clean


# ---- tokens ------------------------------------------------------------------------------------


@pytest.fixture(scope="module", params=[WORD_BPE, BYTE_BPE])
def content(request):
    return queries.vocabulary(request.param)


def odd_texts():
    rng = random.Random(9)
    parts = list("abXYZ  \t\n'''.,!?0129éüßñçÀΣσİǅ½²Ⅷ中あ한🙂́‍ 　\x1c\x85\r\0")
    parts += ["'s", "'re", "'LL", " 'd", "<|endoftext|>", "<|startoftext|>", "don't", "  x", " \n y", "the", "aaaa", "abab", "tionation"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(800)]
    return [*made, "", "a" * 3000, "ab" * 2000 + " x", "é" * 50]


def test_encoder_gives_the_ids_of_the_library(content):
    tokenizer = Tokenizer.from_str(content)
    texts = odd_texts()
    ids, cut = encode.Encoder(content).encode(texts)
    for i, t in enumerate(texts):
        assert ids[cut[i] : cut[i + 1]].tolist() == brute.ids(tokenizer, t), t


def test_transducer_counts_like_the_library(content):
    tokenizer = Tokenizer.from_str(content)
    texts = odd_texts()
    counter = tokencount.Counter(content)
    assert counter.transducer is not None
    assert counter.counts(texts).tolist() == [len(brute.ids(tokenizer, t)) for t in texts]
    assert counter.counts(["", ""]).tolist() == [0, 0]


def test_chunks_do_not_matter():
    transducer = tokencount.Counter(queries.vocabulary(WORD_BPE)).transducer
    raw = np.frombuffer(b"internationalization" * 20, np.uint8).astype(np.int64)
    raw[[30, 199, 399]] += 256
    totals = {chunk: int(transducer.added(raw, chunk).sum()) for chunk in (1, 2, 7, 64, 1000)}
    assert len(set(totals.values())) == 1


def test_chunk_maps_of_long_words_are_composed(content, monkeypatch):
    """Words of many chunks: few rounds however long the word, right counts also where rounds follow one state."""
    tokenizer = Tokenizer.from_str(content)
    rng = random.Random(5)
    words = ["a" * 40_000, "abc" * 10_000, "".join(rng.choice("etaoinshrdlu") for _ in range(30_000)), "é漢" * 3_000, "x" * 129 + " y " + "z" * 257]
    wanted = [len(brute.ids(tokenizer, w)) for w in words]
    counter = tokencount.Counter(content)
    transducer = counter.transducer
    rounds = []
    through = tokencount.Transducer.through
    monkeypatch.setattr(tokencount.Transducer, "through", lambda *own: rounds.append(1) or through(*own))
    assert counter.counts(words).tolist() == wanted
    assert len(rounds) <= 20
    monkeypatch.setattr(tokencount, "GROWING_ROUNDS", 0)
    assert counter.counts(words).tolist() == wanted
    raw = np.frombuffer(words[2][:3_000].encode(), np.uint8).astype(np.int64)
    raw[[700, 2_999]] += 256
    assert len({int(transducer.added(raw, chunk).sum()) for chunk in (1, 3, 16, 128, 4_096)}) == 1


def test_other_tokenizers_are_left_to_the_library():
    import json

    config = json.loads(queries.vocabulary(BYTE_BPE))
    config["pre_tokenizer"]["add_prefix_space"] = True
    content = json.dumps(config)
    encoder = encode.Encoder(content)
    assert encoder.kind is None
    ids, cut = encoder.encode(["a b", "", "c"])
    assert ids[: cut[1]].tolist() == brute.ids(Tokenizer.from_str(content), "a b")


def test_token_counts(llm, documents, content):
    tokenizer = Tokenizer.from_str(content)
    found = rows_of(tokencount.token_counts(documents, content, limit=100), "doc_id", "n_bytes", "n_tokens", "over_limit")
    wanted = [(i, len((t or "").encode()), n, n > 100) for i, t in corpus() for n in [len(brute.ids(tokenizer, t))]]
    same(found, wanted)


# ---- packing -----------------------------------------------------------------------------------


def check_packing(found, rows, tokenizer, capacity, end=2):
    by_doc = {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i, t in rows:
        ids = [*brute.ids(tokenizer, t), end]
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and len(own) == -(-len(ids) // capacity)
        at = 0
        for r in own:
            assert r["start"] == at and r["ids_crc32"] == brute.crc(ids[at : at + r["length"]])
            assert r["piece"] == 0 or r["length"] == capacity
            at += r["length"]
        assert at == len(ids)
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [1024, 64, 1])
def test_packing(llm, documents, capacity):
    content = queries.vocabulary(BYTE_BPE)
    found = packing.packed(documents, content, capacity).collect()
    many = check_packing(found, corpus(), Tokenizer.from_str(content), capacity)
    assert many <= -(-sum(r["length"] for r in found) // capacity) * 1.02 + 1


def test_packed_sequences_hold_the_ids(llm, documents):
    content = queries.vocabulary(BYTE_BPE)
    tokenizer = Tokenizer.from_str(content)
    total = 0
    for r in packing.sequences(documents, content).collect():
        assert len(r["ids"]) == 4 * r["n_tokens"] <= 4096
        total += r["n_tokens"]
    assert total == sum(len(brute.ids(tokenizer, t)) + 1 for _, t in corpus())


def test_packing_of_nothing(llm, nothing):
    assert packing.packed(nothing, queries.vocabulary(BYTE_BPE)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plans_fill_sequences(seed):
    rng = np.random.default_rng(seed)
    length = [rng.integers(1, 1025, 4000), rng.integers(500, 900, 500), rng.integers(1, 40, 3000), np.full(50, 700)][seed]
    histogram = np.bincount(length, minlength=1025)
    plan = packing.plan(histogram)
    lengths = np.repeat(np.arange(1025), histogram)
    rank = np.concatenate([np.arange(c) for c in histogram])
    sequence, offset = plan.place(lengths, rank)
    order = np.lexsort((offset, sequence))
    s, o, n = sequence[order], offset[order], lengths[order]
    first = np.concatenate([[True], s[1:] != s[:-1]])
    assert (np.where(first, 0, np.concatenate([[0], (o + n)[:-1]])) == o).all() and (o + n <= 1024).all()
    assert len(np.unique(s)) == plan.sequences <= sum(c for _, c in packing.best_fit(histogram, 1024)) + 2


# ---- token files ---------------------------------------------------------------------------------


@pytest.mark.parametrize("size", [0, 1, 2, 255, 256, 257, 3000])
def test_elias_fano(size):
    rng = np.random.default_rng(size)
    for top in (1, 3, 5000, 2**40, 2**62):
        values = np.sort(rng.integers(0, top, size))
        held = tokenfile.EliasFano.from_bytes(tokenfile.EliasFano.of(values).to_bytes())
        assert (held.select(0, size) == values).all()
        for i in range(0, size, 37):
            assert held.select(i, i + 1).tolist() == [values[i]]
            assert held.select(i, min(size, i + 300)).tolist() == values[i : i + 300].tolist()
        if size == 3000 and top == 5000:
            assert len(held.to_bytes()) * 8 < size * 6


def test_token_files(llm, tmp_path, documents, content):
    tokenizer = Tokenizer.from_str(content)
    shards = tokenfile.write_shards(documents, content, str(tmp_path / "ids"))
    found = rows_of(tokenfile.read_shards(shards), "doc_id", "start", "n_tokens", "ids_crc32")
    wanted, at = [], 0
    for i, t in sorted(corpus()):
        ids = [*brute.ids(tokenizer, t), 2]
        wanted.append((i, at, len(ids), brute.crc(ids)))
        at += len(ids)
    same(found, wanted)
    path = shards.orderBy("shard").first()["path"]
    system, local = files.opened(path)
    with system.open_input_file(local) as source:
        shard = tokenfile.Shard(source)
        names, ids, bounds = shard.read(1, 2)
        text = dict(corpus())[names[0]]
        assert ids.tolist() == [*brute.ids(tokenizer, text), 2]


def test_token_files_of_unnamed_and_repeated_rows(llm, tmp_path):
    rows = [(None, "a b"), (-5, "c"), (-5, "c"), (None, None), (7, ""), (7, "d e f")]
    shards = tokenfile.write_shards(frame(llm, rows, 2), queries.vocabulary(WORD_BPE), str(tmp_path / "ids"))
    found = rows_of(tokenfile.read_shards(shards), "start", "doc_id", "n_tokens")
    assert sorted(r[1:] for r in found if r[1] is None) == [(None, 1), (None, 3)]
    assert [r[1] for r in sorted(found)] == [None, None, -5, -5, 7, 7]
    assert sorted(r[0] for r in found)[0] == 0 and sum(r[2] for r in found) == 3 + 2 + 2 + 1 + 1 + 4


def test_token_files_of_nothing(llm, tmp_path, nothing):
    shards = tokenfile.write_shards(nothing, queries.vocabulary(WORD_BPE), str(tmp_path / "ids"))
    assert tokenfile.read_shards(shards).count() == 0


# ---- archives ------------------------------------------------------------------------------------


def page_rows():
    rng = random.Random(11)
    big, other = "<p>" + prose(rng, 300) + "</p>", "x" * 999
    rows = [(n, f"http://h.example/{n}?q=ä b\r\n", f"<b>{prose(rng, rng.randint(0, 400))}</b>") for n in range(40)]
    rows += [(100, "u", big), (105, "u", big), (103, None, big), (110, "v", other), (111, "v", other), (120, "w", None), (121, "w", "")]
    return rows + [(130, "z", "é" * 500), (131, "z", "é" * 500), (105, "u", big), (None, "n", big), (None, None, None), (140, "s", "<p>\r\n\r\nWARC/1.1\r\n" * 80)]


def wanted_pages(rows):
    payload = [(i, (h or "").encode()) for i, _, h in rows]
    top = {}
    for i, b in payload:
        if i is not None:
            top[b] = max(top.get(b, i), i)
    many = {b: sum(x == b for _, x in payload) for _, b in payload}
    out = []
    for i, b in payload:
        revisit = len(b) >= 1000 and many[b] > 1 and b in top and i != top[b]
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", top[b] if revisit else None))
    return out


PAGE = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_archives(llm, tmp_path, monkeypatch):
    rows = page_rows()
    pages = llm.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    index = warc.write_bundles(pages, str(tmp_path / "warc"))
    same(rows_of(warc.read_bundles(index), *PAGE), wanted_pages(rows))
    # each record is found by its frame and offset
    for r in index.collect():
        system, path = files.opened(r["bundle"])
        with system.open_input_file(path) as source:
            headers, _ = warc.Bundle(source).record(r["frame"], r["offset"])
            assert warc.id_of(headers["WARC-Record-ID"]) == r["page_id"]


def test_bundles_are_plain_zstandard(tmp_path):
    import zstandard

    path = str(tmp_path / "b.warc.zst")
    raws = [warc.record(i, "u", b"p" * i, "d", None, False) for i in range(50)]
    with files.new_file(path) as out:
        bundle = warc.BundleWriter(out, frame_bytes=700)
        places = [bundle.add(r) for r in raws]
        bundle.close()
    with open(path, "rb") as held:
        assert zstandard.ZstdDecompressor().stream_reader(held, read_across_frames=True).read() == b"".join(raws)
    with pafs.LocalFileSystem().open_input_file(path) as source:
        opened = warc.Bundle(source)
        assert len(opened.frames) > 5
        assert opened.record(*places[33])[1].endswith(b"p" * 33)
        assert len(list(opened.records())) == 50


def test_archives_of_nothing(llm, tmp_path):
    pages = llm.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_bundles(warc.write_bundles(pages, str(tmp_path / "warc"))).count() == 0


# ---- neighbours ----------------------------------------------------------------------------------


def vectors(n=1500, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, n)] + rng.normal(size=(n, 16)) * 0.6) * rng.uniform(0.5, 2, (n, 1))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    shared = rows[3][1]
    rows += [(n + k, shared) for k in range(300)]
    odd = [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [None, *shared[1:]]), (5080, [float("inf"), *shared[1:]]), (5100, []), (None, shared)]
    return rows + odd, [r for r in rows]


def test_neighbours(llm):
    every, good = vectors()
    emb = llm.createDataFrame(every, "vec_id long, embedding array<float>")
    found = ann.nearest(emb, emb.filter("vec_id % 20 = 0"), k=10, trees=8, leaf=32).collect()
    x = np.array([v for _, v in good])
    names = np.array([i for i, _ in good])
    by_query = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by_query.setdefault(r["query_id"], []).append(r)
    assert sorted(by_query) == [i for i in names.tolist() if i % 20 == 0]
    hits = total = 0
    for q, got in by_query.items():
        s = x @ x[q]
        order = [i for i in np.lexsort((names, -s)) if names[i] != q][:10]
        assert [r["rank"] for r in got] == list(range(1, 11))
        assert all(math.isclose(r["score"], s[r["vec_id"]], rel_tol=1e-9) for r in got)
        assert [(-r["score"], r["vec_id"]) for r in got] == sorted((-r["score"], r["vec_id"]) for r in got)
        hits += len({r["vec_id"] for r in got} & {int(names[i]) for i in order})
        total += 10
    assert hits / total >= 0.9


def test_neighbours_when_the_sample_is_a_small_part(llm):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 16)).astype(np.float32)
    emb = llm.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = ann.nearest(emb, emb.filter("vec_id % 20 = 0"), k=10, trees=8, leaf=32, sample_rows=256).collect()
    score = x[::20].astype(float) @ x.astype(float).T
    score[np.arange(200), np.arange(0, 4000, 20)] = -np.inf
    true = {(20 * q, int(i)) for q, row in enumerate(score) for i in np.argsort(-row)[:10]}
    assert len(true & {(r["query_id"], r["vec_id"]) for r in found}) / len(true) >= 0.9


def test_neighbours_that_tie_come_by_id(llm):
    rows = [(i, [1.0, *(float(i >> b & 1) for b in range(7))]) for i in range(128)]
    emb = llm.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = rows_of(ann.nearest(emb, emb.filter("vec_id = 0"), k=5), "query_id", "rank", "vec_id", "score")
    assert found == [(0, r, r, 1.0) for r in range(1, 6)]


def test_neighbours_of_few_and_none(llm):
    schema = "vec_id long, embedding array<float>"
    three = llm.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0]), (7, [2.0, 1.0]), (20, [1.0, 0.0])], schema)
    found = rows_of(ann.nearest(three, three.filter("vec_id % 20 = 0")), "query_id", "rank", "vec_id", "score")
    assert found == [(0, 1, 7, 2.0), (0, 2, 20, 1.0), (20, 1, 7, 2.0), (20, 2, 0, 1.0)]
    none = llm.createDataFrame([], schema)
    assert ann.nearest(none, none).count() == 0


# ---- classifiers -----------------------------------------------------------------------------------


def labelled(llm):
    rng = random.Random(12)
    bad = ["stupid", "fool", "trash"]
    rows, labels = [], []
    for i in range(400):
        words = prose(rng, rng.randint(5, 60)).split(" ")
        toxic, junk = i % 5 == 0, i % 4 == 1
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        text = " ".join(words)
        rows.append((i, text.upper().replace(" ", "!! ") if junk else text))
        labels.append((i, int(not junk), int(toxic)))
    rows += [(900, None), (901, ""), (902, "\n")]
    labels += [(900, 1, 0), (77777, 0, 1), (None, 1, 1), (3, None, None)]
    return frame(llm, rows), llm.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows, {i: (q, t) for i, q, t in labels}


def accuracy(df, truth, modulus, remainder):
    import zlib

    found = {r["doc_id"]: r for r in df.collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % modulus == remainder]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    return found, sum(found[i]["predicted"] == truth[i] for i in held) / len(held)


def test_toxicity_on_held_out_labels(llm):
    docs, labels, rows, truth = labelled(llm)
    model = toxicity.fit(docs, labels.filter(~queries.held_out(5, 0)))
    found, share = accuracy(toxicity.score(docs, model), {i: t for i, (_, t) in truth.items()}, 5, 0)
    assert share >= 0.95 and len(model.at) < 2000
    assert found[900]["score"] == found[901]["score"] == found[902]["score"]
    kept = toxicity.without_toxic(docs.withColumn("score", F.lit("own")), model)
    assert kept.columns == [*docs.columns, "score"]
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if not r["predicted"]}


def test_quality_on_held_out_labels(llm):
    docs, labels, rows, truth = labelled(llm)
    network = quality.fit(docs, labels.filter(~queries.held_out(3, 1)))
    found, share = accuracy(quality.score(docs, network), {i: q for i, (q, _) in truth.items()}, 3, 1)
    assert share >= 0.95
    assert found[900]["score"] == found[901]["score"]


@pytest.mark.parametrize("size", [0, 1, 5, 6, 511, 512, 513, 1018, 1019, 1020, 5000])
def test_chunks_cover_the_text(size):
    offsets = np.array([0, size, size])
    starts, cuts = quality.chunks_of(np.zeros(size, np.uint8), offsets)
    assert cuts[-1] == len(starts) and cuts[2] - cuts[1] == 1
    places = {s + i for s in starts[: cuts[1]] for i in range(quality.CHUNK - quality.WIDTH + 1)}
    assert set(range(max(0, size - quality.WIDTH + 1))) <= places


def test_classifiers_without_labels_and_rows(llm, documents, nothing):
    none = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    model, network = toxicity.fit(documents, none), quality.fit(documents, none)
    assert {r["score"] for r in toxicity.score(documents, model).collect()} == {0.5}
    assert {r["score"] for r in quality.score(documents, network).collect()} == {0.5}
    assert toxicity.score(nothing, model).count() == quality.score(nothing, network).count() == 0


def test_nothing_in_nothing_out(llm, nothing):
    none = llm.createDataFrame([], "item_id long, text string")
    assert suffixdedup.removal_report(nothing).count() == 0
    assert neardup.near_duplicates(nothing).count() == 0
    assert decontam.contamination(nothing, none).count() == 0
    assert tokencount.token_counts(nothing, queries.vocabulary(WORD_BPE)).count() == 0


def test_stored_tables_can_be_dropped(llm):
    held = store.written(llm.range(3).toDF("n"), "some")
    assert held.count() == 3
    store.dropped(held)
    with pytest.raises(Exception):
        held.count()
