"""Prefix trie, vector copies and tokenizer alignment against the plain computation."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from samples import corpus, frame, prose
from tokenizers import Tokenizer

from panelworks.llm import align, encode, pivotdedup, prefixtrie, queries

TURNS = "conv_id long, turn long, role string, text string"


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# ---- conversations -------------------------------------------------------------------------

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(sequences: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members, ends, children, parent, last = defaultdict(list), defaultdict(list), defaultdict(set), {}, {(): 0}
    for c in sorted(sequences):
        turns = tuple(sequences[c])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                parent[turns[:d]], last[turns[:d]] = turns[: d - 1], len(turns[d - 1][1])
                children[turns[: d - 1]].add(turns[:d])
        ends[turns].append(c)
    leaves, saved = Counter(), Counter()
    for node in members:
        up = node
        while up is not None:
            leaves[up] += not children[node]
            saved[up] += (len(members[node]) - 1) * last[node]
            up = parent.get(up)
    return sorted(
        (
            (m[0], len(n), members[parent[n]][0] if n else None, len(m), len(children[n]), leaves[n], saved[n])
            + (hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest(),)
            for n, m in members.items()
        ),
        key=repr,
    )


def in_order(rows) -> dict[int, list[tuple[str, str]]]:
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in by.items()}


def shared_heads(sequences):
    found = {}
    for c, turns in sequences.items():
        h = zlib.crc32(str(c).encode()) % 6
        found[c] = sequences.get(c - c % 100, [])[:h] + turns[h:]
    return found


def conversations(seed: int = 3):
    rng = random.Random(seed)
    rows = []
    for c in [0, 100, *range(1, 60), *range(205, 230), *range(1000, 1030)]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 8, 9])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "", None, "ünï", "a b", "a b c"])))
    rows += [(300 + i, t, "user", f"same {t}") for i in range(40) for t in range(7)]
    rows += [(900, t, "user", f"long {t // 2}") for t in range(70)] + [(901, t, "user", f"long {t // 2}") for t in range(66)]
    rows += [(500, None, "user", "first"), (500, 0, "user", "second"), (None, 0, "user", "nobody")]
    rng.shuffle(rows)
    return rows


def test_trie_of_conversations_as_they_are(llm):
    rows = conversations()
    turns = prefixtrie.numbered(llm.createDataFrame(rows, TURNS).repartition(3))
    found = prefixtrie.node_report(prefixtrie.trie(*prefixtrie.whole_sequences(*turns)))
    assert rows_of(found, *NODE) == plain_trie(in_order(rows))


def test_trie_with_shared_heads_and_clashing_columns(llm):
    rows = conversations(4)
    schema = TURNS + ", node string, name string, _row long, size int"
    frame_ = llm.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], schema).repartition(4)
    turns = prefixtrie.numbered(frame_)
    found = prefixtrie.node_report(prefixtrie.trie(*prefixtrie.with_shared_heads(*turns)))
    wanted = shared_heads(in_order(rows))
    assert any(not turns for turns in wanted.values())
    assert rows_of(found, *NODE) == plain_trie(wanted)


def test_trie_of_nothing_and_of_turnless_conversations(llm):
    def report(rows):
        turns = prefixtrie.numbered(llm.createDataFrame(rows, TURNS))
        return rows_of(prefixtrie.node_report(prefixtrie.trie(*prefixtrie.with_shared_heads(*turns))), *NODE)

    assert report([]) == []
    alone = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6)
    assert report([(alone, 0, "user", "x")]) == plain_trie({alone: []})


def test_ids_of_many_equal_conversations(llm, monkeypatch):
    monkeypatch.setattr(prefixtrie, "CHUNK_BYTES", 50)
    ids = list(range(1000, 1400))
    ends = llm.createDataFrame([(b"n", i) for i in ids] + [(b"m", 7)], "node binary, conv_id long").repartition(5)
    found = {bytes(r["node"]): r["ends_sha256"] for r in prefixtrie.id_digests(ends).collect()}
    assert found == {b"n": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), b"m": hashlib.sha256(b"7").hexdigest()}


# ---- vectors -------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_links(rows, least=0.93):
    n = len(rows)
    vectors, fit = [], []
    for i, v, label in rows:
        good = i is not None and label is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
        fit.append(bool(good))
        vectors.append(np.array(v, np.float32).astype(float) if good else None)
    links = [[] for _ in range(n)]
    for a in range(n):
        for b in range(a):
            if fit[a] and fit[b] and rows[a][2] == rows[b][2] and len(vectors[a]) == len(vectors[b]):
                x, y = vectors[a], vectors[b]
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                    links[a].append(b)
                    links[b].append(a)
    reach = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for a in range(n):
            for b in links[a]:
                if reach[b] < reach[a]:
                    reach[a], changed = reach[b], True
    return sorted(((rows[k][0], len(links[k]), reach[k], rows[k][0] is None or reach[k] == rows[k][0]) for k in range(n)), key=repr)


def near_groups(rng, labels=3, groups=6, size=8, dim=24, noise=0.04):
    rows = []
    for g in range(groups):
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            rows.append((centre + rng.normal(size=dim) * noise, g % labels))
    rows += [(rng.normal(size=dim), int(rng.integers(labels))) for _ in range(80)]
    return [(int(k), [float(np.float32(x)) for x in v], label) for k, (v, label) in zip(rng.permutation(len(rows)) + 10, rows)]


def test_vector_links(llm):
    rows = near_groups(np.random.default_rng(1))
    own = rows[0][1]
    odd = [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, own[:20], [x * 3 for x in own], [1e-30 * x for x in own]]
    rows += [(1000 + k, v, 0) for k, v in enumerate(odd)] + [(2000, own, None), (None, own, 0), (3000, own, 0), (3000, own, 0), (5, own, 0), (5, rows[60][1], 0)]
    found = pivotdedup.near_vectors(llm.createDataFrame(rows, VECTORS).repartition(3))
    assert rows_of(found, "vec_id", "n_links", "component_id", "kept") == plain_links(rows)


@pytest.mark.parametrize("block", [7, 40])
def test_vector_links_in_blocks_and_second_lists(llm, block):
    """Long lists are dealt out and cut; every link is still counted once."""
    rows = near_groups(np.random.default_rng(2), labels=1, groups=3, size=60)
    extra = llm.createDataFrame([(*r, 1, "x") for r in rows], VECTORS + ", node int, digest string").repartition(2)
    found = pivotdedup.near_vectors(extra, block=block)
    assert rows_of(found, "vec_id", "n_links", "component_id", "kept") == plain_links(rows)


def test_no_vectors(llm):
    found = pivotdedup.near_vectors(llm.createDataFrame([], VECTORS))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"] and found.count() == 0


def test_share_of_links_found_at_the_threshold(llm):
    """Pairs of a cosine just above the threshold, among 4,000 other vectors."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    y = 0.931 * x + np.sqrt(1 - 0.931**2) * z
    other = rng.normal(size=(4000, 64))
    rows = [(k, [float(f) for f in v], 1) for k, v in enumerate(np.concatenate([x, y, other]))]
    found = pivotdedup.near_vectors(llm.createDataFrame(rows, VECTORS))
    assert found.filter("vec_id < 1500 AND n_links > 0").count() >= 0.95 * 1500


# ---- tokenizers ----------------------------------------------------------------------------

LEFT, RIGHT = queries.vocabulary("byte_bpe_50k.json"), queries.model("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    own = Tokenizer.from_str(LEFT)
    own.encode_special_tokens = True
    return own, sentencepiece.SentencePieceProcessor(model_proto=RIGHT)


def plain_groups(text, libraries):
    """(A ids, B ids) of each group, by sets of ends."""
    if not text:
        return []
    one, two = align.byte_level(LEFT), align.pieces(RIGHT)
    ids = libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text)
    ends = []
    for side, own in zip((one, two), ids):
        read = [bytes(side.pool[side.start[i] : side.start[i] + side.length[i]]) for i in own]
        if b"".join(read) != (" " + text).encode():
            return []
        ends.append(np.cumsum([len(r) for r in read]).tolist())
    found, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        to = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
        found.append((ids[0][i : to[0]], ids[1][j : to[1]]))
        i, j = to
    return found


def odd_texts():
    rng = random.Random(3)
    letters = "abc  \n\t ▁éß漢字😀<>s/|endoftext\0́ﬁ0123'’."
    found = ["a ", "a  ", "<s> x </s>", "▁", "a▁ b", " ▁ ", "x" * 5000, "漢字" * 700, "\0a", "<0x41>", " lead", "é"]
    return found + ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 50))) for _ in range(300)]


def thue_morse(length):
    bits = [0]
    while len(bits) < length:
        bits += [1 - b for b in bits]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_groups(llm, libraries):
    rows = [(i, t) for i, t in corpus()] + [(1000 + k, t) for k, t in enumerate(odd_texts())]
    found = {r["doc_id"]: r for r in align.groups(frame(llm, rows), LEFT, RIGHT).collect()}
    for i, text in rows:
        r, want = found[i], plain_groups(text, libraries)
        a, b = [0, *r["a_cuts"]], [0, *r["b_cuts"]]
        assert [(r["a_ids"][w:x], r["b_ids"][y:z]) for w, x, y, z in zip(a, a[1:], b, b[1:])] == want, text


def test_alignment(llm, libraries, monkeypatch):
    monkeypatch.setattr(align, "LISTED", 6)
    rows = corpus() + [(1000 + k, t) for k, t in enumerate(odd_texts())] + [(7, "one text"), (7, "one text"), (None, "no id")]
    docs = frame(llm, rows).withColumnsRenamed({"lang": "pairs", "source": "slice"})
    per = [(i, plain_groups(t, libraries)) for i, t in rows]
    links = [Counter((a, b) for x, y in g for a in x for b in y) for _, g in per]
    count = Counter(p for own in links for p in own)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    want = []
    for (i, g), own in zip(per, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        sizes = sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(own.values())
        n_best = sum(n for (a, b), n in own.items() if count[a, b] == best[a])
        want.append((i, *sizes, n_best, sum(n * count[p] for p, n in own.items()), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(align.alignment(docs, LEFT, RIGHT), *names) == sorted(want, key=repr)
    counted = {(r["a"], r["b"]): r["count"] for r in align.link_counts(docs, LEFT, RIGHT).collect()}
    assert counted == count


def test_alignment_of_nothing(llm, nothing):
    assert align.alignment(nothing, LEFT, RIGHT).count() == 0


def test_long_documents_are_several_lanes():
    ends_a = np.cumsum(np.full(3000, 3))
    ends_b = np.cumsum(np.full(4500, 2))
    begin_a, begin_b = align.lanes(ends_a, ends_b, np.array([0, 100, 3000]))
    assert len(begin_a) > 10 and {0, 100, 3000} <= set(begin_a.tolist())
    group_a, group_b = align.lockstep(ends_a, ends_b, np.array([0, 100, 3000]))
    assert (np.diff(group_a) == 2).all() and (np.diff(group_b) == 3).all()
    assert np.array_equal(np.concatenate([[0], ends_a])[begin_a], np.concatenate([[0], ends_b])[begin_b])


@pytest.mark.parametrize("length", [1024, 2048, 4096])
def test_words_of_one_hash_keep_their_own_ids(length, libraries):
    """A polynomial hash modulo 2 ** 64 does not tell these words apart."""
    words = list(thue_morse(length))
    for texts in (words, [words[1], "x " + words[0] + " y"]):
        for own, library in (encode.Encoder(LEFT), libraries[0]), (encode.Encoder(queries.vocabulary("word_bpe_49k.json")), Tokenizer.from_str(queries.vocabulary("word_bpe_49k.json"))):
            ids, cut = own.encode(texts)
            assert [ids[a:b].tolist() for a, b in zip(cut, cut[1:])] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_known_words_are_compared_by_their_letters(monkeypatch, libraries):
    """Also with a hash that tells nothing apart."""
    monkeypatch.setattr(encode.T, "span_hashes", lambda values, starts, ends: (ends - starts).astype(np.uint64))
    own = encode.Encoder(LEFT)
    texts = [prose(random.Random(k), 40) for k in range(6)]
    for _ in range(2):
        ids, cut = own.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(cut, cut[1:])] == [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]
