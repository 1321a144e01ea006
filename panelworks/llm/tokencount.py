"""Token counts by a finite-state transducer compiled from a BPE tokenizer.

The text is cut into words as the tokenizer does it, and becomes a row of symbols: the bytes of the words, the
last byte of a word being a symbol of its own. A deterministic transducer reads the symbols; each
transition is annotated with the number of tokens it adds (or takes back, where a merge makes
fewer of them), and after the last byte of a word it is in its start state again.

Why it is finite: the tokens of a prefix are the tokens of a shorter prefix and one last token, and two tokens can stand
next to each other exactly if no merge across their seam would have come first. So what can still
change depends only on the ends of the prefix that may begin a longer token (a state of the
automaton of all token beginnings) and, at each of these places, the last token there and how
many tokens it is away. Both are bounded by the longest token. States are compiled when a text
first needs them and kept by the worker; beyond ``MOST_STATES`` the compilation starts anew.

Parallel prefix scan: the symbols are cut into chunks of equal size and all chunks move in step. The
map of a chunk (from the state before it to the state after it and the tokens it adds) is constant once the chunk
holds the end of a word, so it is known without the chunks before it. A chunk inside a long word has a map over
the states that can reach it: first the start state, then the states after the chunk before it, from any of
its own. Tokens forget what is far behind them, so few states are found; chunks of equal symbols share one map.
The maps are composed by pointer doubling, in as many steps as the logarithm of the chunks. Then the part of each
chunk up to its first word end is counted from the right state.

A null is an empty text and has no tokens. Texts with special strings of the tokenizer, and all texts
of tokenizers that are not byte-level BPE with a known cut, are counted by the library.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelworks.llm import encode
from panelworks.llm import text as T

LIMIT = 2048
CHUNK = 128
MOST_STATES = 120_000
#: Rounds in which the maps of all chunks grow; later ones follow the states that were really reached.
GROWING_ROUNDS = 64
#: A transition is next state << SHIFT | added tokens + BIAS.
SHIFT, BIAS = 6, 32


def byte_alphabet() -> dict[str, int]:
    """Which character stands for which byte in a byte-level vocabulary: printable ones for themselves, the
    others, in order, for the characters from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """Tokens as rows of symbols, how each one is made, and which may stand next to each other."""

    def __init__(self, config: dict) -> None:
        model = config["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        alphabet = byte_alphabet()

        def symbols(token: str) -> tuple[int, ...]:
            last = bool(self.suffix) and token.endswith(self.suffix) and len(token) > len(self.suffix)
            own = [alphabet[c] for c in (token[: -len(self.suffix)] if last else token)]
            return (*own[:-1], own[-1] + 256) if last else tuple(own)

        special = {t["content"] for t in config.get("added_tokens", ())}
        of = {token: symbols(token) for token in model["vocab"] if token not in special}
        self.rank: dict[tuple[int, ...], int] = {}  # when a token is made; single symbols at -1
        # how a token is made
        self.halves: dict[tuple[int, ...], tuple[tuple[int, ...], tuple[int, ...]]] = {}
        self.merge: dict[tuple[tuple[int, ...], tuple[int, ...]], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = of[left], of[right]
            self.merge[a, b] = rank
            if a + b not in self.rank:
                self.rank[a + b] = rank
                self.halves[a + b] = (a, b)
        self.tokens = {s for s in of.values() if len(s) == 1}
        for whole, (a, b) in sorted(self.halves.items(), key=lambda x: self.rank[x[0]]):
            # a token counts if its own symbols are merged to it
            if a in self.tokens and b in self.tokens and self._seam_holds(a, b, self.rank[whole]):
                self.tokens.add(whole)
        self.known: dict[tuple[tuple[int, ...], tuple[int, ...]], bool] = {}

    def _seam_holds(self, a: tuple[int, ...], b: tuple[int, ...], until: float) -> bool:
        """No merge across the seam of ``a`` and ``b`` comes before ``until`` or before either was made.

        Goes back in time: of the two tokens at the seam, the one made later is taken apart first. A
        pair that was there until rank r would have been merged by a smaller rank, and by r itself
        if it stands left of the merge that ended it.
        """
        left_ended = True
        while True:
            rank = self.merge.get((a, b))
            if rank is not None and (rank < until or (rank == until and not left_ended)):
                return False
            made_a, made_b = self.rank.get(a, -1), self.rank.get(b, -1)
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                # ``a`` came from a merge to the left of the seam
                until, left_ended, a = made_a, True, self.halves[a][1]
            else:
                until, left_ended, b = made_b, False, self.halves[b][0]

    def adjacent(self, a: tuple[int, ...], b: tuple[int, ...]) -> bool:
        found = self.known.get((a, b))
        if found is None:
            found = self.known[a, b] = self._seam_holds(a, b, float("inf"))
        return found


class Transducer:
    """States and annotated transitions, compiled on demand."""

    def __init__(self, config: dict) -> None:
        self.merges = Merges(config)
        self.children: list[dict[int, int]] = [{}]
        self.token: list[tuple[int, ...] | None] = [None]
        for token in self.merges.tokens:
            node = 0
            for symbol in token:
                if symbol not in self.children[node]:
                    self.children[node][symbol] = len(self.children)
                    self.children.append({})
                    self.token.append(None)
                node = self.children[node][symbol]
            self.token[node] = token
        self.clear()

    def clear(self) -> None:
        # a state: for each place that may begin a longer token, the node reached from it, the last
        # token before it (None at the start of the word), and how many tokens it is behind
        self.states: list[tuple[tuple[int, tuple[int, ...] | None, int], ...]] = [((0, None, 0),)]
        self.number = {self.states[0]: 0}
        self.same: dict[tuple, tuple] = {}
        self.merges.known.clear()
        # transitions by state << 9 | symbol, in an open-addressing table; 0 is a free slot
        self.slots = 1 << 16
        self.keys = np.zeros(self.slots, np.int64)
        self.values = np.full(self.slots, -1, np.int32)
        self.held = 0

    def find(self, key: np.ndarray) -> np.ndarray:
        """The transitions of ``key`` (from 1), -1 where none is compiled."""
        at = T.mixed(key.astype(np.uint64)).astype(np.int64) & (self.slots - 1)
        found = self.keys[at]
        out = np.where(found == key, self.values[at], -1)
        todo = np.flatnonzero((found != key) & (found != 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & (self.slots - 1)
            found = self.keys[at[todo]]
            same = found == key[todo]
            out[todo[same]] = self.values[at[todo[same]]]
            todo = todo[~same & (found != 0)]
        return out

    def enter(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add transitions that are not there yet."""
        self.held += len(keys)
        if self.held * 2 > self.slots:
            old = np.flatnonzero(self.keys)
            keys, values = np.concatenate([self.keys[old], keys]), np.concatenate([self.values[old], values])
            while self.held * 2 > self.slots:
                self.slots *= 2
            self.keys, self.values = np.zeros(self.slots, np.int64), np.full(self.slots, -1, np.int32)
        at = T.mixed(keys.astype(np.uint64)).astype(np.int64) & (self.slots - 1)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[at[todo]] == 0]
            self.keys[at[free]] = keys[free]
            won = free[self.keys[at[free]] == keys[free]]
            self.values[at[won]] = values[won]
            lost = np.ones(len(keys), bool)
            lost[won] = False
            todo = todo[lost[todo]]
            at[todo] = (at[todo] + 1) & (self.slots - 1)

    def compile(self, state: int, symbol: int) -> int:
        """The transition from a state by a symbol."""
        last = symbol >= 256
        own = symbol if self.merges.suffix or not last else symbol - 256
        places, chosen = [], None
        for node, before, behind in self.states[state]:
            child = self.children[node].get(own)
            if child is None:
                continue
            token = self.token[child]
            if chosen is None and token is not None and (before is None or self.merges.adjacent(before, token)):
                chosen = (token, behind)
            if self.children[child]:
                places.append((child, before, behind))
        if chosen is None:
            raise ValueError(f"no token ends with symbol {own}")
        token, behind = chosen
        # the new prefix has the tokens of the chosen place and one more
        added = 1 - behind
        if last:
            following = 0
        else:
            key = (*((n, b, k + added) for n, b, k in places), (0, token, 0))
            following = self.number.get(key)
            if following is None:
                key = tuple(self.same.setdefault(place, place) for place in key)
                following = self.number[key] = len(self.states)
                self.states.append(key)
        return following << SHIFT | (added + BIAS)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        key = (state << 9 | symbol) + 1
        value = self.find(key)
        miss = np.flatnonzero(value < 0)
        if len(miss):
            new = T.distinct(key[miss])
            made = [self.compile((k - 1) >> 9, (k - 1) & 511) for k in new.tolist()]
            self.enter(new, np.array(made, np.int32))
            value[miss] = self.find(key[miss])
        return value

    def added(self, symbols: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """Tokens added at each symbol; exact in sum over whole words."""
        if len(self.states) > MOST_STATES:
            self.clear()
        n = len(symbols)
        lanes = -(-n // chunk)
        padded = np.full(lanes * chunk, symbols[-1], np.int64)
        padded[:n] = symbols
        grid = np.ascontiguousarray(padded.reshape(lanes, chunk).T)
        out = np.zeros((chunk, lanes), np.int32)
        ends = grid >= 256
        constant = ends.any(axis=0)
        first_end = np.where(constant, ends.argmax(axis=0), -1)
        # behind its first word end each chunk goes its way from the start state
        state = np.zeros(lanes, np.int64)
        for j in range(1, chunk):
            live = np.flatnonzero(constant & (first_end < j))
            value = self.step(state[live], grid[j, live])
            state[live] = value >> SHIFT
            out[j, live] = (value & ((1 << SHIFT) - 1)) - BIAS
        # composition of the maps, then the beginnings of the chunks
        before, out[0, ~constant] = self.composed(grid, constant, state)
        for j in range(int(first_end.max()) + 1):
            live = np.flatnonzero(first_end >= j)
            value = self.step(before[live], grid[j, live])
            before[live] = value >> SHIFT
            out[j, live] = (value & ((1 << SHIFT) - 1)) - BIAS
        return out.T.ravel()[:n]

    def through(self, state: np.ndarray, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after whole columns of ``grid``, and the tokens the columns add."""
        tokens = np.zeros(len(state), np.int64)
        for symbols in grid:
            value = self.step(state, symbols)
            state = (value >> SHIFT).astype(np.int64)
            tokens += (value & ((1 << SHIFT) - 1)) - BIAS
        return state, tokens

    def composed(self, grid: np.ndarray, constant: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state before each chunk, and the tokens added by each chunk without a word end.

        ``after`` is the state after the chunks with constant maps. The last chunk always has one.
        """
        lanes = len(constant)
        before = np.full(lanes, -1, np.int64)
        before[0] = 0
        before[1:][constant[:-1]] = after[:-1][constant[:-1]]
        inner = np.flatnonzero(~constant)
        if not len(inner):
            return before, np.zeros(0, np.int64)
        low = (1 << 32) - 1
        columns = np.ascontiguousarray(grid[:, inner].T)
        whole = columns.view(np.dtype((np.void, columns.itemsize * columns.shape[1]))).ravel()
        _, sample, content = np.unique(whole, return_index=True, return_inverse=True)
        shared = np.full(lanes, -1, np.int64)
        shared[inner] = content.ravel()
        # maps: (content, state before) -> state after, tokens; nodes: (chunk, state before)
        maps = np.zeros(0, np.int64)
        exits = gains = np.zeros(0, np.int64)
        known = before[inner] >= 0
        nodes = np.zeros(0, np.int64)
        new = inner << 32 | np.where(known, before[inner], 0)
        roots = new[known]
        for rounds in range(lanes + 1):
            missing = np.setdiff1d(shared[new >> 32] << 32 | new & low, maps)
            if len(missing):
                made = self.through(missing & low, grid[:, inner[sample[missing >> 32]]])
                maps = np.concatenate([maps, missing])
                order = np.argsort(maps)
                maps = maps[order]
                exits, gains = (np.concatenate([x, y])[order] for x, y in zip((exits, gains), made))
            nodes = np.union1d(nodes, new)
            chunk_of = nodes >> 32
            at = np.searchsorted(maps, shared[chunk_of] << 32 | nodes & low)
            wanted = chunk_of + 1 << 32 | exits[at]
            follows = np.searchsorted(nodes, wanted)
            found = np.take(nodes, follows, mode="clip") == wanted
            n = len(nodes)
            jump = np.append(np.where(found, follows, n), n)
            reached = np.zeros(n + 1, bool)
            reached[np.searchsorted(nodes, roots)] = True
            for _ in range(n.bit_length()):
                reached[jump[reached]] = True
                jump = jump[jump]
            reached = reached[:n]
            absent = ~found & ~constant[chunk_of + 1]
            if not (absent & reached).any():
                break
            new = np.unique(wanted[absent if rounds < GROWING_ROUNDS else absent & reached])
        before[chunk_of[reached] + 1] = exits[at[reached]]
        tokens = np.zeros(lanes, np.int64)
        tokens[chunk_of[reached]] = gains[at[reached]]
        return before, tokens[inner]


class Counter:
    def __init__(self, content: str) -> None:
        self.encoder = encode.Encoder(content)
        self.transducer = Transducer(json.loads(content)) if self.encoder.kind else None

    def counts(self, texts: list[str]) -> np.ndarray:
        if self.transducer is None:
            return np.diff(self.encoder.encode(texts)[1])
        special = self.encoder.special
        odd = [i for i, t in enumerate(texts) if any(s in t for s in special)]
        if odd:
            texts = list(texts)
            apart = np.diff(self.encoder.encode([texts[i] for i in odd])[1])
            for i in odd:
                texts[i] = ""
        out = self._counts(texts)
        if odd:
            out[odd] = apart
        return out

    def _counts(self, texts: list[str]) -> np.ndarray:
        if self.encoder.kind == "lower":
            texts = [encode.cleaned(t) for t in texts]
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]).astype(np.int64)
        if not len(codes):
            return np.zeros(len(texts), np.int64)
        starts, ends, _ = encode.cut_words(codes, offsets, self.encoder.kind)
        if not len(starts):
            return np.zeros(len(texts), np.int64)
        data = np.frombuffer(joined.encode(), np.uint8)
        if len(data) != len(codes):
            width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
            at = np.concatenate([[0], np.cumsum(width)])
            starts, ends, offsets = at[starts], at[ends], at[offsets]
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] += 1
        inside[ends] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
        symbols = data.astype(np.int64)
        symbols[ends - 1] += 256
        kept = np.concatenate([[0], np.cumsum(inside)])
        total = np.concatenate([[0], np.cumsum(self.transducer.added(symbols[inside]), dtype=np.int64)])
        return np.diff(total[kept[offsets]])


@lru_cache(maxsize=2)
def counter(content: str) -> Counter:
    """One transducer for each tokenizer and worker; its states outlive a task."""
    return Counter(content)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``."""
    content = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(content.value)
        for batch in batches:
            for lo, hi, _, offsets in T.byte_slices(batch.column("text"), encode.SLICE_BYTES):
                texts = [t or "" for t in batch.column("text")[lo:hi].to_pylist()]
                n = own.counts(texts)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id")[lo:hi],
                        "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                        "n_tokens": pa.array(n, pa.int64()),
                        "over_limit": pa.array(n > limit),
                    }
                )

    return docs.select("doc_id", "text").mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
