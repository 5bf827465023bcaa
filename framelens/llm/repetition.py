"""Quality rules: repetition inside a text, found with a suffix array over its words.

A batch of documents is one integer sequence. Words get numbers that no two documents share and every document
ends in a number of its own, so one suffix array over the batch holds the suffix array of each document. Its
longest-common-prefix (LCP) array then gives, for every word position, the longest substring starting there that
occurs elsewhere in the same document. The spans of these maximal repeats are united; a document is rejected where
they cover too much of it or where one of them is too long.

Everything happens in one pass over the input: no shuffle, no state between batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import free_name, in_slices


#: Fixed values of the base rules.
SYMBOLS = re.compile(r"[#*$%&|<>]")
BASE_WINDOW = 5
BASE_MIN_WORDS = 10
BASE_MAX_REPEAT_PERCENT = 20

#: Words analysed as one sequence; a longer document is a sequence of its own.
BATCH_WORDS = 150_000

REPORT = T.StructType(
    [T.StructField(n, T.LongType(), False) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_chars", "longest_repeat")]
    + [T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])), False)]
    + [T.StructField("base_failed", T.BooleanType(), False), T.StructField("kept", T.BooleanType(), False)]
)


def suffix_ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... numbers, until all differ.

    ``ids`` must end in a number that occurs once. A rank is the place of the first suffix of its class in sorted
    order, so refining a class never touches another, and only classes with several members are sorted again.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    sorted_ids = ids[order]
    head = np.r_[True, sorted_ids[1:] != sorted_ids[:-1]]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n, dtype=np.int32), 0))
    levels = [rank]
    tied = order[~(head & np.r_[head[1:], True])]
    width = 1
    while len(tied):
        old, after = rank[tied], rank[np.minimum(tied + width, n - 1)]
        sub = np.lexsort((after, old))
        tied, old, after = tied[sub], old[sub], after[sub]
        group = np.r_[True, old[1:] != old[:-1]]
        part = group | np.r_[True, after[1:] != after[:-1]]
        place = np.arange(len(tied), dtype=np.int32)
        start_of_group = np.maximum.accumulate(np.where(group, place, 0))
        start_of_part = np.maximum.accumulate(np.where(part, place, 0))
        rank = rank.copy()
        rank[tied] = old + (start_of_part - start_of_group)
        levels.append(rank)
        tied = tied[~(part & np.r_[part[1:], True])]
        width *= 2
    return levels


def longest_repeats(ids: np.ndarray) -> np.ndarray:
    """For every position the length of the longest substring from it that starts at another position too."""
    n = len(ids)
    levels = suffix_ranks(ids)
    array = np.empty(n, np.int64)
    array[levels[-1]] = np.arange(n)
    first, second = array[:-1], array[1:]
    lcp = np.zeros(n - 1, np.int64)
    pair = np.flatnonzero(levels[0][first] == levels[0][second])
    for level in range(len(levels) - 1, -1, -1):
        a, b = first[pair] + lcp[pair], second[pair] + lcp[pair]
        inside = np.maximum(a, b) < n
        same = np.zeros(len(pair), bool)
        same[inside] = levels[level][a[inside]] == levels[level][b[inside]]
        lcp[pair[same]] += 1 << level
    longest = np.zeros(n, np.int64)
    longest[first] = lcp
    longest[second] = np.maximum(longest[second], lcp)
    return longest


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in the union of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def _reports(texts: list[str], min_words: int, max_covered: float, max_longest: int) -> Iterator[dict]:
    split = [t.encode("utf-8", "replace").split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    ids, taken = np.empty(int(sizes.sum()) + len(split), np.int64), 0
    chars = np.zeros(len(ids), np.int64)
    at = 0
    for text, words in zip(texts, split):
        number: dict[bytes, int] = {}
        m = len(words)
        ids[at : at + m] = [taken + number.setdefault(w, len(number)) for w in words]
        ids[at + m] = taken + len(number)
        chars[at : at + m] = [len(w) for w in words] if text.isascii() else [len(w.decode()) for w in words]
        taken += len(number) + 1
        at += m + 1
    longest = longest_repeats(ids)
    n = len(ids)
    hit = np.flatnonzero(longest >= BASE_WINDOW)
    in_base = covered(hit, np.full(len(hit), BASE_WINDOW), n)
    hit = np.flatnonzero(longest >= min_words)
    in_span = covered(hit, longest[hit], n)
    at = 0
    for text, m in zip(texts, sizes):
        here = slice(at, at + m)
        edges = np.flatnonzero(np.diff(np.r_[False, in_span[here], False]))
        word_chars, span_chars, peak = int(chars[here].sum()), int(chars[here][in_span[here]].sum()), int(longest[here].max(initial=0))
        lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")] if "\n" in text else []
        repeat = int(in_base[here].sum())
        failed = bool(m < BASE_MIN_WORDS or 100 * repeat > BASE_MAX_REPEAT_PERCENT * m)
        yield {
            "n_words": int(m),
            "word_chars": word_chars,
            "n_symbols": len(SYMBOLS.findall(text)),
            "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": repeat,
            "covered_chars": span_chars,
            "longest_repeat": peak,
            "spans": [{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)],
            "base_failed": failed,
            "kept": not failed and span_chars <= max_covered * word_chars and peak <= max_longest,
        }
        at += m + 1


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    chunk, size = [], 0
    for t in texts:
        chunk.append(t)
        size += len(t) // 6 + 1
        if size >= BATCH_WORDS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def repetition_report(docs: DataFrame, text_col: str = "text", into: str = "repetition", min_words: int = 5, max_covered: float = 0.3, max_longest: int = 40, carry: list[str] | None = None) -> DataFrame:
    """Adds a struct with the repetition figures and the verdict of each row.

    ``spans`` are the united maximal repeats of ``min_words`` words or more, as word positions with an exclusive
    end. ``kept`` is false where a base rule fails (``base_failed``), where the spans hold more than ``max_covered``
    of the characters in words, or where a repeat has over ``max_longest`` words.

    A null or empty text has no words and fails the base rule. Repeated rows get equal reports; an empty table
    gives an empty table. ``carry`` names the input columns to return (default: all); a column called ``into`` is
    replaced. A very long text is analysed whole, with about 100 bytes of memory a word.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c != into]
    source = docs.select(*[docs[c] for c in names], docs[text_col].cast("string").alias(free_name(docs, "_text")))
    schema = T.StructType([source.schema[c] for c in names] + [T.StructField(into, REPORT, False)])
    arrow_type = pa.struct([pa.field(f.name, pa.bool_() if isinstance(f.dataType, T.BooleanType) else pa.int64() if isinstance(f.dataType, T.LongType) else pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))) for f in REPORT])

    def analyse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            at = 0
            for texts in _chunks([t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]):
                found = pa.array(_reports(texts, min_words, max_covered, max_longest), arrow_type)
                yield pa.RecordBatch.from_arrays([*(c.slice(at, len(texts)) for c in batch.columns[:-1]), found], names=[*names, into])
                at += len(texts)

    return source.mapInArrow(analyse, schema)
