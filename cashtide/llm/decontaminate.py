"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may differ in up to ``n * error_rate`` edits (k) from a passage of a
document.  It is split in k + 1 pieces; k edits leave at least one piece unchanged, so every such
passage holds a piece at about its place.  All pieces of all items are found in one pass of an
Aho-Corasick automaton; around each hit, Myers' bit-parallel algorithm gives the least edit distance
of the item to any passage there.  Nothing is missed, and what is reported is verified.

Documents and items are compared lower-cased, with runs of other characters than letters and digits as
one blank.  The documents are read once, whole, without a shuffle.  Items are sent to the tasks in
blocks of at most ``BLOCK_CHARS`` characters each (a benchmark is a stated query set).

Items under ``min_chars`` normalised characters are matched without edits and on word borders: an edit
in so few characters makes another sentence, and a short word lies inside many others.

Defined cases: null ids or texts of items, and items without letters or digits, match nothing; null and empty documents have no items; an item that occurs
several times is listed once; rows are independent, so repeated rows and null ids are kept; empty
tables give no items; other columns are ignored or, in the filter, kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR_RATE = 0.07  # one edit in fourteen characters
MIN_CHARS = 40  # items from this length on may hold edits
BLOCK_CHARS = 4_000_000
_REST = re.compile(r"[\W_]+")
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")


def normalized(text: str | None) -> str:
    return _REST.sub(" ", (text or "").lower()).strip()


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): ``errors + 1`` pieces of nearly equal length."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks_of(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, char in enumerate(item):
        masks[char] = masks.get(char, 0) | 1 << i
    return masks


def least_distance(masks: dict[str, int], length: int, text: str) -> int:
    """The least edit distance of the item to any passage of ``text`` (Myers 1999)."""
    full, last = (1 << length) - 1, 1 << length - 1
    plus, minus, score = full, 0, length
    best = score
    for char in text:
        match = masks.get(char, 0)
        vertical = match | minus
        horizontal = (((match & plus) + plus) ^ plus) | match
        up, down = (minus | ~(horizontal | plus)) & full, plus & horizontal
        if up & last:
            score += 1
        elif down & last:
            score -= 1
            best = min(best, score)
        up, down = up << 1 & full, down << 1 & full
        plus = (down | ~(vertical | up)) & full
        minus = up & vertical
    return best


def _between_borders(text: str, start: int, end: int) -> bool:
    """No word goes on over either end; scripts without blanks have no borders to keep."""
    before, first, last, after = text[start - 1 : start], text[start], text[end - 1], text[end : end + 1]
    return not (_joined(before, first) or _joined(last, after))


def _joined(left: str, right: str) -> bool:
    return left.strip() != "" and right.strip() != "" and not (_UNSPACED.match(left) and _UNSPACED.match(right))


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: tuple[tuple[int, str], ...], error_rate: float, min_chars: int = MIN_CHARS):
        self.min_chars = min_chars
        self.items = [(number, text, self._errors(text, error_rate), masks_of(text)) for number, text in items]
        self.automaton = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text, errors, _) in enumerate(self.items):
            for offset, piece in pieces(text, errors):
                places.setdefault(piece, []).append((i, offset))
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def _errors(self, text: str, error_rate: float) -> int:
        return int(len(text) * error_rate) if len(text) >= self.min_chars else 0

    def find(self, text: str | None) -> list[int]:
        plain = normalized(text)
        if not plain or not self.items:
            return []
        starts: dict[int, list[int]] = {}
        for end, (length, where) in self.automaton.iter(plain):
            for i, offset in where:
                starts.setdefault(i, []).append(end + 1 - length - offset)
        return sorted({self.items[i][0] for i, at in starts.items() if self._verified(i, at, plain)})

    def _verified(self, i: int, starts: list[int], plain: str) -> bool:
        """Each stretch around hits that lie close together is compared once."""
        _, text, errors, masks = self.items[i]
        if len(text) < self.min_chars:
            return any(_between_borders(plain, at, at + len(text)) for at in starts)
        starts.sort()
        at = 0
        while at < len(starts):
            first = last = starts[at]
            while at < len(starts) and starts[at] <= last + 2 * errors:
                last = starts[at]
                at += 1
            window = plain[max(0, first - errors) : last + len(text) + errors]
            if least_distance(masks, len(text), window) <= errors:
                return True
        return False


@lru_cache(maxsize=4)
def _matcher(items: tuple[tuple[int, str], ...], error_rate: float, min_chars: int) -> Matcher:
    return Matcher(items, error_rate, min_chars)


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[tuple[tuple[int, str], ...]]:
    """The usable items, normalised, in blocks of bounded size."""
    held, size = [], 0
    rows = benchmark.select("item_id", "text").where("item_id is not null and text is not null").distinct()
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        text = normalized(row["text"])
        if text:
            held.append((row["item_id"], text))
            size += len(text)
        if size >= block_chars:
            yield tuple(held)
            held, size = [], 0
    if held:
        yield tuple(held)


def leaked_items(text: Column, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> Column:
    """Sorted ids of the items that a text holds."""

    def finder(items):
        @F.pandas_udf("array<long>")
        def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            matcher = _matcher(items, error_rate, min_chars)
            for texts in batches:
                yield texts.map(matcher.find)

        return find(F.coalesce(text, F.lit("")))

    found = [finder(items) for items in blocks(benchmark)]
    if not found:
        return F.array().cast("array<long>")
    return found[0] if len(found) == 1 else F.array_sort(F.array_distinct(F.concat(*found)))


def leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, items and contaminated of every row."""
    rows = docs.select("doc_id", leaked_items(F.col("text"), benchmark, error_rate, min_chars).alias("items"))
    return rows.withColumn("contaminated", F.size("items") > 0)


def without_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows that hold no item, all columns kept."""
    return docs.where(F.size(leaked_items(F.col("text"), benchmark, error_rate, min_chars)) == 0)
