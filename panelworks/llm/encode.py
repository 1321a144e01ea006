"""Token ids of whole texts, by the tokenizers library, each distinct word encoded once.

A tokenizer that cuts a text into words first (``SPLITS`` below) encodes each word for itself. So the
cut is made here for many texts at once, the library encodes the words not seen before in this
worker, and the ids of a text are those of its words. Texts that hold one of the tokenizer's special
strings, and all texts of tokenizers that cut in another way, go to the library as a whole.

A word is looked up by a 64-bit hash and its characters are compared with those of the known word; words of
more than ``LONG`` characters are not kept.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from panelworks.llm import text as T

SPACE, LETTER, NUMBER, OTHER = range(4)

# fixed values: the two pre-tokenizers whose cut is known here
SPLITS = {
    "lower": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
    "spaced": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True},
}
#: Words kept by one worker; beyond that the memory is emptied.
MOST_WORDS = 600_000
#: Characters of the longest word that is kept.
LONG = 64
#: Bytes of text cut at a time.
SLICE_BYTES = 1 << 19


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Class of every code point: white space, letter, number, other."""
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        if kind[0] == "L":
            table[code] = LETTER
        elif kind[0] == "N":
            table[code] = NUMBER
        elif kind[0] == "Z":
            table[code] = SPACE
    table[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85]] = SPACE
    return table


def split_kind(config: dict) -> str | None:
    """Which of the known cuts a tokenizer makes, or None."""
    model, cut, clean = config["model"], config.get("pre_tokenizer") or {}, config.get("normalizer")
    if model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges") or config.get("truncation") or config.get("padding"):
        return None
    if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in config.get("added_tokens", ())):
        return None
    if {k: cut.get(k) for k in SPLITS["spaced"]} == SPLITS["spaced"] and clean is None:
        return "spaced"
    steps = cut.get("pretokenizers") or [{}]
    if (
        [s.get("type") for s in steps] == ["Split", "ByteLevel"]
        and steps[0]["pattern"].get("Regex") == SPLITS["lower"]
        and steps[0]["behavior"] == "Removed"
        and steps[0]["invert"]
        and not steps[1]["use_regex"]
        and not steps[1]["add_prefix_space"]
        and [s["type"] for s in (clean or {}).get("normalizers", ())] == ["NFC", "Replace", "Lowercase"]
    ):
        return "lower"
    return None


def cleaned(text: str) -> str:
    """Composed and in lower case, as the library does it: character by character."""
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ")  # no special form at the end of a word
    return text.lower()


def cut_words(codes: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of joined texts, and for each text the range of its words."""
    n = len(codes)
    cls = character_classes()[codes]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    space = cls == SPACE
    run = np.ones(n, bool)  # first character of a run of one class
    run[1:] = (cls[1:] != cls[:-1]) | first[1:n]
    before_text = np.zeros(n, bool)  # white space with something else after it in its text
    before_text[:-1] = ~space[1:] & ~first[1:n]
    if kind == "lower":
        start = ~space & (run | (cls == NUMBER))
    else:
        after_blank = np.zeros(n, bool)
        after_blank[1:] = (codes[:-1] == 0x20) & ~first[1:n]
        start = np.where(space, run | before_text, run & ~after_blank)
    quotes = np.flatnonzero((codes == 0x27) & start)
    if len(quotes):
        room = offsets[np.searchsorted(offsets, quotes, "right")] - quotes  # characters to the end of the text
        one = codes[np.minimum(quotes + 1, n - 1)]
        two = codes[np.minimum(quotes + 2, n - 1)]
        short = (room > 1) & np.isin(one, [ord(c) for c in "stmd"])
        pair = np.zeros(len(quotes), bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b))
        pair &= room > 2
        ends = np.where(pair, 3, 2)
        chosen = short | pair
        quotes, ends, room = quotes[chosen], ends[chosen], room[chosen]
        start[quotes + 1] = False
        after = quotes + ends
        inside = ends < room
        after = after[inside]
        start[after[cls[after] == LETTER]] = True
    edge = np.flatnonzero(np.concatenate([start | first[:n] | (space if kind == "lower" else False), [True]]))
    at = np.flatnonzero(np.concatenate([start, [False]])[edge])
    starts = edge[at]
    return starts, edge[at + 1] if len(at) else starts, np.searchsorted(starts, offsets)


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all elements of the runs, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Words:
    """An open-addressing table from word hashes to runs of ids and characters, filled as words appear."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.slots = 1 << 16
        self.keys = np.zeros(self.slots, np.uint64)
        self.number = np.zeros(self.slots, np.int32)
        self.count = 0
        self.start = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)
        self.used = 0
        self.ids = np.zeros(1 << 18, np.uint32)
        self.spelt = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)
        self.chars = np.zeros(1 << 19, np.uint32)
        self.written = 0

    def differs(self, number: np.ndarray, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which words are spelt in another way than the known ones of these numbers."""
        out = self.size[number] != sizes
        same = np.flatnonzero(~out & (sizes > 0))
        own, known = runs(starts[same], sizes[same]), runs(self.spelt[number[same]], sizes[same])
        unequal = codes[own] != self.chars[known]
        if unequal.any():
            out[same] = np.logical_or.reduceat(unequal, np.cumsum(sizes[same]) - sizes[same])
        return out

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each word, -1 if it is not known."""
        mask = np.uint64(self.slots - 1)
        at = (h & mask).astype(np.int64)
        out = self.number[at]
        held = self.keys[at]
        out[held != h] = -1
        todo = np.flatnonzero((held != h) & (held != 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & (self.slots - 1)
            held = self.keys[at[todo]]
            same = held == h[todo]
            out[todo[same]] = self.number[at[todo[same]]]
            todo = todo[~same & (held != 0)]
        return out

    def _place(self, h: np.ndarray, number: np.ndarray) -> None:
        at = (h & np.uint64(self.slots - 1)).astype(np.int64)
        todo = np.arange(len(h))
        while len(todo):
            free = todo[self.keys[at[todo]] == 0]
            self.keys[at[free]] = h[free]
            won = free[self.keys[at[free]] == h[free]]
            self.number[at[won]] = number[won]
            lost = np.ones(len(h), bool)
            lost[won] = False
            todo = todo[lost[todo]]
            at[todo] = (at[todo] + 1) & (self.slots - 1)

    def _append(self, ids: list[np.ndarray], chars: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(lengths.sum())
        while self.count + len(ids) > len(self.start):
            for held in ("start", "length", "spelt", "size"):
                setattr(self, held, np.concatenate([getattr(self, held), np.zeros_like(self.start)]))
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.written + len(chars) > len(self.chars):
            self.chars = np.concatenate([self.chars, np.zeros_like(self.chars)])
        number = np.arange(self.count, self.count + len(ids), dtype=np.int32)
        self.spelt[number] = self.written + np.cumsum(sizes) - sizes
        self.size[number] = sizes
        self.chars[self.written : self.written + len(chars)] = chars
        self.written += len(chars)
        self.start[number] = self.used + np.cumsum(lengths) - lengths
        self.length[number] = lengths
        self.ids[self.used : self.used + total] = np.concatenate(ids) if ids else []
        self.count += len(ids)
        self.used += total
        return number

    def add(self, h: np.ndarray, ids: list[np.ndarray], chars: np.ndarray, sizes: np.ndarray) -> None:
        """Keep words under their hashes."""
        number = self._append(ids, chars, sizes)
        if self.count * 2 > self.slots:
            keys, numbers = self.keys, self.number
            while self.count * 2 > self.slots:
                self.slots *= 4
            self.keys, self.number = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.int32)
            old = np.flatnonzero(keys)
            self._place(keys[old], numbers[old])
        self._place(h, number)

    def aside(self, ids: list[np.ndarray]) -> np.ndarray:
        """Numbers of words that cannot be found again."""
        return self._append(ids, np.zeros(0, np.uint32), np.zeros(len(ids), np.int64))


class Encoder:
    """Ids of texts, the same as the library gives for each whole text.

    With ``plain_special`` the tokenizer's special strings inside a text are text like any other.
    """

    most_words = MOST_WORDS

    def __init__(self, content: str, plain_special: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        config = json.loads(content)
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = plain_special
        self.kind = split_kind(config)
        self.special = [] if plain_special else [t["content"] for t in config.get("added_tokens", ())]
        self.words = Words()

    def _cleaned(self, texts: list[str]) -> list[str]:
        return [cleaned(t) for t in texts] if self.kind == "lower" else texts

    def _cut(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return cut_words(codes, offsets, self.kind)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _each(self, words: list[str]) -> list[np.ndarray]:
        """Ids of single words. Many words are one text for the library, with breaks between them
        that it cuts off again; should it count other words than were given, each goes alone."""
        out: list[np.ndarray | None] = [None] * len(words)
        step, gap = (2, "\n") if self.kind == "spaced" else (1, " ")
        plain = [i for i, w in enumerate(words) if not w.isspace()]
        for first in range(0, len(plain), 4096):
            some = plain[first : first + 4096]
            found = self.tokenizer.encode(gap.join([words[i] for i in some]), add_special_tokens=False)
            ids, word = np.array(found.ids, np.uint32), np.array(found.word_ids, np.int64)
            cut = np.searchsorted(word, np.arange(step * len(some)))
            cut = np.append(cut, len(ids))
            if len(word) and word[-1] == step * (len(some) - 1) and (np.diff(word) >= 0).all() and (np.diff(cut)[: step * len(some) - 1] > 0).all():
                for k, i in enumerate(some):
                    out[i] = ids[cut[step * k] : cut[step * k + 1]]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self._whole([words[i] for i in rest])):
            out[i] = ids
        return out

    def _by_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        texts = self._cleaned(texts)
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]).astype(np.int64)
        if not len(codes):
            return np.zeros(0, np.uint32), offsets
        starts, ends, bounds = self._cut(codes, offsets)
        sizes = ends - starts
        h = T.span_hashes(codes.astype(np.uint64) + np.uint64(0x5BD1E995), starts, ends)
        h[h == 0] = 1
        words = self.words
        if words.count > self.most_words:
            words.clear()
        number = np.full(len(h), -1, np.int32)
        short = np.flatnonzero(sizes <= LONG)
        number[short] = words.find(h[short])
        miss = short[number[short] < 0]
        if len(miss):
            by = np.argsort(h[miss], kind="stable")
            own = h[miss][by]
            keep = np.concatenate([[True], own[1:] != own[:-1]])
            at = miss[by[keep]]
            words.add(own[keep], self._each([joined[a:b] for a, b in zip(starts[at], ends[at])]), codes[runs(starts[at], sizes[at])], sizes[at])
            number[miss] = words.find(h[miss])
        other = np.ones(len(h), bool)
        other[short] = words.differs(number[short], codes, starts[short], sizes[short])
        other = np.flatnonzero(other)
        if len(other):  # long words, and words that share their hash with another one
            spelt = [joined[a:b] for a, b in zip(starts[other], ends[other])]
            distinct = list(dict.fromkeys(spelt))
            kept = words.used, words.count
            known = dict(zip(distinct, words.aside(self._each(distinct))))
            number[other] = [known[w] for w in spelt]
        length = words.length[number]
        cut = np.concatenate([[0], np.cumsum(length)])
        ids = words.ids[runs(words.start[number], length)]
        if len(other):
            words.used, words.count = kept
        return ids, cut[bounds]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where the ids of each text start and end."""
        if self.kind is None:
            own = self._whole(texts)
            sizes = np.fromiter(map(len, own), np.int64, len(own))
            return np.concatenate([*own, np.zeros(0, np.uint32)]), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        odd = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        if not odd:
            return self._by_words(texts)
        whole = dict(zip(odd, self._whole([texts[i] for i in odd])))
        ids, cut = self._by_words(["" if i in whole else t for i, t in enumerate(texts)])
        own = [whole[i] if i in whole else ids[cut[i] : cut[i + 1]] for i in range(len(texts))]
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        return np.concatenate(own), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


@lru_cache(maxsize=2)
def encoder(content: str) -> Encoder:
    """One encoder for each tokenizer and worker; its known words outlive a task."""
    return Encoder(content)


def encoded_slices(column: pa.Array, content: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, ids, offsets); a null is an empty text."""
    own = encoder(content)
    for lo, hi, _, _ in T.byte_slices(column, limit):
        texts = [t or "" for t in column.slice(lo, hi - lo).to_pylist()]
        yield lo, hi, *own.encode(texts)


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with one more id at the end of each text."""
    return np.insert(ids, offsets[1:], end).astype("<u4"), offsets + np.arange(len(offsets))
