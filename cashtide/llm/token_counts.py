"""Token counts of byte-level BPE vocabularies by a compiled finite-state transducer.

Two deterministic transducers in a row replace the tokenizer library:

1. The pre-tokenizer is a finite automaton over character classes (letter, number, space, other
   white space, rest).  Run over a whole batch of texts at once it marks the byte at which each
   piece starts.
2. The merges are a transducer over bytes.  Its state says which suffixes of the piece read so far
   may still grow into a token, after which last token each of them starts, and how many tokens
   fewer that start has; the transition on a byte is annotated with the change of the token count.
   This rests on a property of BPE: the tokens of a prefix are the tokens of a shorter prefix plus
   one last token, and a sequence is the encoding of its text if every adjacent pair is its own
   encoding.  A piece start resets the state.  States and transitions are compiled when they are
   first met (the full automaton would not fit) into an open-addressing table; the table is dropped
   and compiled anew when it is full, which changes no result.

Texts are cut in chunks of equal length that all run at the same time, one byte per step.  The map of
a chunk from the state before it to (state after it, tokens) is constant behind its first piece
start; the stretch before that start runs from the state the chunk before ends in.  This composition
is a prefix scan over the chunks: a chunk without a piece start waits for its predecessor, so a piece
of any length is exact.

Defined cases: null and empty texts have 0 tokens; rows are independent, so repeated rows, ties and
null ids give their own rows; an empty table gives an empty result; other columns pass through unless
they carry the name of a result column, which replaces them.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 256
BATCH_BYTES = 8_000_000
MAX_TRANSITIONS = 4_000_000
SPREAD = 0x9E3779B97F4A7C15  # 2^64 divided by the golden ratio, for multiplicative hashing

LETTER, NUMBER, SPACE, BLANK, REST = range(5)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and added tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model, before = stored["model"], stored.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or stored.get("normalizer"):
            raise ValueError("only byte-level BPE without a normalizer is compiled")
        if not before.get("use_regex", True) or before.get("add_prefix_space"):
            raise ValueError("only the standard piece pattern is compiled")
        self.added = [t["content"] for t in stored.get("added_tokens", ())]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in stored.get("added_tokens", ())):
            raise ValueError("added tokens that take their surroundings are not compiled")
        alphabet = byte_alphabet()

        def raw(token: str) -> bytes:
            return bytes(alphabet[c] for c in token)

        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.tokens = {raw(t) for t in model["vocab"] if t not in self.added}

    def encode(self, piece: bytes) -> list[bytes]:
        """Textbook BPE of one short piece."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, 1 << 60), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts


class Transducer:
    """Lazily compiled merges: states, transitions and the tokens each transition adds."""

    def __init__(self, vocabulary: Vocabulary, max_transitions: int = MAX_TRANSITIONS):
        self.vocabulary = vocabulary
        self.max_transitions = max_transitions
        self.whole = {t for t in vocabulary.tokens if vocabulary.encode(t) == [t]}
        self.prefixes = {t[:i] for t in self.whole for i in range(1, len(t) + 1)}
        self.growing = {t[:i] for t in self.whole for i in range(1, len(t))}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self._clear()

    def _clear(self) -> None:
        start = ((b"", b"", 0),)
        self.states = [start]
        self.numbers = {start: 0}
        self.used = 0
        size = 1 << 16
        self.keys = np.full(size, -1, np.int64)
        self.next = np.zeros(size, np.int32)
        self.weight = np.zeros(size, np.int8)

    def valid(self, left: bytes, right: bytes) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            known = self.pairs[(left, right)] = self.vocabulary.encode(left + right) == [left, right]
        return known

    def step(self, state: tuple, byte: int) -> tuple[tuple, int]:
        grown, last, count = [], b"", 0
        for text, before, fewer in state:
            text += bytes((byte,))
            if text in self.prefixes:
                if not last and text in self.whole and (not before or self.valid(before, text)):
                    last, count = text, fewer + 1
                if text in self.growing:
                    grown.append((text, before, fewer))
        return (*((t, b, c - count) for t, b, c in grown), (b"", last, 0)), count

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(SPREAD)) >> np.uint64(20)).view(np.int64) & (len(self.keys) - 1)

    def _insert(self, key: int, follower: int, weight: int) -> None:
        if 2 * (self.used + 1) > len(self.keys):
            full = self.keys >= 0
            old = self.keys[full], self.next[full], self.weight[full]
            size = 2 * len(self.keys)
            self.keys = np.full(size, -1, np.int64)
            self.next, self.weight = np.zeros(size, np.int32), np.zeros(size, np.int8)
            slots = self._slots(old[0])
            left = np.arange(len(slots))
            while len(left):  # place what finds its slot free, move the rest on
                free = left[self.keys[slots[left]] < 0]
                _, first = np.unique(slots[free], return_index=True)
                put = free[first]
                for target, source in zip((self.keys, self.next, self.weight), old):
                    target[slots[put]] = source[put]
                left = np.setdiff1d(left, put, assume_unique=True)
                slots[left] = (slots[left] + 1) & (size - 1)
        slot = ((key * SPREAD & (1 << 64) - 1) >> 20) & (len(self.keys) - 1)
        while self.keys[slot] >= 0:
            slot = (slot + 1) & (len(self.keys) - 1)
        self.keys[slot], self.next[slot], self.weight[slot] = key, follower, weight
        self.used += 1

    def advance(self, states: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One byte in every lane: the states after it and the tokens it adds."""
        keys = states.astype(np.int64) << 8 | data
        slots = self._slots(keys)
        found = self.keys[slots]
        odd = np.flatnonzero(found != keys)
        missing = []
        while len(odd):  # another key sits in the slot, or the transition is new
            new = found[odd] < 0
            if new.any():
                missing.append(odd[new])
                odd = odd[~new]
            slots[odd] = (slots[odd] + 1) & (len(self.keys) - 1)
            found[odd] = self.keys[slots[odd]]
            odd = odd[found[odd] != keys[odd]]
        if missing:
            for key in np.unique(keys[np.concatenate(missing)]).tolist():
                follower, weight = self.step(self.states[key >> 8], key & 255)
                number = self.numbers.setdefault(follower, len(self.states))
                if number == len(self.states):
                    self.states.append(follower)
                self._insert(key, number, weight)
            return self.advance(states, data)
        return self.next[slots], self.weight[slots]

    def counts(self, data: np.ndarray, starts: np.ndarray, chunk: int = CHUNK_BYTES) -> np.ndarray:
        """For every byte, the tokens its transition adds (or takes away, when tokens merge).

        ``starts`` marks piece starts; the first byte must be one.
        """
        if self.used > self.max_transitions:
            self._clear()
        n = len(data)
        added = np.zeros(n, np.int8)
        lanes = -(-n // chunk)
        ends = np.minimum(np.arange(1, lanes + 1) * chunk, n)
        first = np.full(lanes, n, np.int64)
        at = np.flatnonzero(starts)
        np.minimum.at(first, at // chunk, at)
        tail = np.full(lanes, -1, np.int64)  # the state after the chunk, once it is known
        has = first < n
        tail[has] = self._run(data, starts, added, first[has], ends[has], np.zeros(has.sum(), np.int64))
        begin = np.arange(lanes) * chunk
        head = np.where(has, first, ends)
        waiting = np.flatnonzero(head > begin)
        while len(waiting):
            ready = waiting[tail[waiting - 1] >= 0]
            after = self._run(data, starts, added, begin[ready], head[ready], tail[ready - 1])
            tail[ready] = np.where(has[ready], tail[ready], after)
            waiting = np.setdiff1d(waiting, ready, assume_unique=True)
        return added

    def _run(self, data, starts, added, begin, end, state) -> np.ndarray:
        """All lanes from ``begin`` to ``end`` together; the states they end in."""
        state = state.copy()
        order = np.argsort(begin - end, kind="stable")  # longest first: the running lanes are a prefix
        begin, length, now = begin[order], (end - begin)[order], state[order]
        running = len(begin)
        for t in range(int(length[0]) if running else 0):
            running = int(np.searchsorted(-length, -t, side="left"))
            at = begin[:running] + t
            before = np.where(starts[at], 0, now[:running])
            now[:running], added[at] = self.advance(before, data[at])
        state[order] = now
        return state


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point, as the piece pattern sees it."""
    table = np.full(0x110000, REST, np.uint8)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(points)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        for m in regex.finditer(pattern, text):
            table[ord(m[0][0]) : ord(m[0][-1]) + 1] = kind
    # finditer over joined points may bridge the surrogates, which no text holds.
    for c in (0x1C, 0x1D, 0x1E, 0x1F):  # separators that only some engines take for white space
        table[c] = REST
    table[0x20] = SPACE
    return table


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Marks the code points at which pieces start; ``first`` marks the starts of texts.

    The pattern is: the contractions 's 't 're 've 'm 'll 'd | a run of letters, numbers or rest with
    at most one space before it | white space, leaving its last character to what follows it.
    """
    n = len(points)
    kind = _classes()[points]
    white = (kind == SPACE) | (kind == BLANK)
    last = np.append(first[1:], True)  # the last code point of a text
    run = np.empty(n, bool)  # starts of runs of one class; all white space is one class
    group = np.where(white, SPACE, kind)
    run[0] = True
    run[1:] = group[1:] != group[:-1]
    run |= first
    starts = run & ~white  # a run of words, unless the space before it joins
    previous_space = np.zeros(n, bool)
    previous_space[1:] = (kind[:-1] == SPACE) & ~first[1:]
    starts &= ~previous_space
    starts |= run & white
    # The last white space before a word starts a piece of its own: a space goes to the word.
    before_word = white & ~last
    before_word[:-1] &= ~white[1:]
    starts |= before_word
    _contractions(points, first, starts)
    return starts


def _contractions(points: np.ndarray, first: np.ndarray, starts: np.ndarray) -> None:
    """A quote that starts a piece takes the letters of a contraction; what follows starts a piece."""
    n = len(points)
    quote = np.flatnonzero((points == 39) & starts)
    if not len(quote):
        return
    begin = np.append(np.flatnonzero(first), n)
    stop = begin[np.searchsorted(begin, quote, side="right")]

    def at(offset: int) -> np.ndarray:
        where = quote + offset
        return np.where(where < stop, points[np.minimum(where, n - 1)], 0)

    one, two = at(1), at(2)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(quote), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    for taken, hit in ((2, short), (3, long)):
        where = quote[hit]
        starts[where + 1] = False
        after = where + taken
        after = after[after < stop[hit]]
        starts[after] = True


def count_tokens(texts: list[str | None], transducer: Transducer) -> np.ndarray:
    """Tokens of every text; the texts of one call run together."""
    added = transducer.vocabulary.added
    pattern = regex.compile("|".join(regex.escape(a) for a in sorted(added, key=len, reverse=True))) if added else None
    parts, owner = [], []
    total = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if not text:
            continue
        if pattern is not None and any(a in text for a in added):
            total[i] += len(pattern.findall(text))
            cut = [p for p in pattern.split(text) if p]
        else:
            cut = [text]
        parts += cut
        owner += [i] * len(cut)
    if not parts:
        return total
    points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(p) for p in parts])
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    first = np.zeros(len(points), bool)
    first[begin] = True
    starts = piece_starts(points, first)
    data = np.frombuffer("".join(parts).encode("utf-8", "surrogatepass"), np.uint8)
    lead = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of each code point
    byte_starts = np.zeros(len(data), bool)
    byte_starts[lead[starts]] = True
    per_part = np.add.reduceat(transducer.counts(data, byte_starts).astype(np.int64), lead[begin])
    np.add.at(total, np.array(owner), per_part)
    return total


@lru_cache(maxsize=2)
def _transducer(path: str) -> Transducer:
    return Transducer(Vocabulary(path))


def _path_in_task(name: str) -> str:
    """Executors find the vocabulary by its name in their own installation, or by a full path."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counter(vocabulary: str) -> Column:
    """A column function: text to tokens."""

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        transducer = _transducer(_path_in_task(vocabulary))
        for texts in batches:
            out, held, size = [], [], 0
            for text in texts:
                held.append(text)
                size += len(text or "")
                if size >= BATCH_BYTES:
                    out.append(count_tokens(held, transducer))
                    held, size = [], 0
            out.append(count_tokens(held, transducer))
            yield pd.Series(np.concatenate(out))

    return tokens


def with_token_counts(docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit to every row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    counted = docs.withColumns(
        {"n_bytes": F.octet_length(whole).cast("long"), "n_tokens": token_counter(vocabulary)(whole)}
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
