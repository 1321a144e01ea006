"""Texts of many kinds for the tests of this folder."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def word(rng: random.Random) -> str:
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyzäéñ") for _ in range(rng.randint(2, 8)))


def prose(rng: random.Random, words: int) -> str:
    return " ".join(word(rng) for _ in range(words))


def corpus(seed: int = 5, plain: int = 30) -> list[tuple[int | None, str | None]]:
    """Texts of many kinds: null, empty, short, long, copies, near copies, shared passages."""
    rng = random.Random(seed)
    passage, base, line = prose(rng, 70), prose(rng, 200).split(" "), prose(rng, 12) + "."
    texts: list[str | None] = [None, "", " ", "\n\t", "one", "One two", "a b c d", "a b c d e", "a b c d e f", "!?.", "Ünïcode   x y"]
    texts += [prose(rng, rng.randint(1, 120)) for _ in range(plain)]
    texts += [prose(rng, 30) + " " + passage + " " + prose(rng, rng.randint(0, 60)) for _ in range(6)]
    texts += [" ".join(base)] * 4
    for n in (1, 1, 2, 3, 5, 8, 13, 20):
        near = list(base)
        for _ in range(n):
            near[rng.randrange(len(near))] = word(rng)
        texts.append(" ".join(near))
    texts += [(line + "\n") * 40, (line + "\n") * 40 + prose(rng, 20), "ab" * 700, "x" * 900, "x" * 400, "x" * 399, "y" * 401]
    texts += ["é" * 450, "A " * 300 + "b", prose(rng, 4000)]
    texts += ["<|endoftext|>", "say <|endoftext|> and go", "It's we'll 'tis\r\n  done  ", "mixed CASE Text " * 30, "MIXED case text " * 30]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows


def frame(spark, rows: list[tuple[int | None, str | None]], parts: int = 3):
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)
