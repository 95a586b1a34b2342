"""Substring deduplication by word windows: super-k-mer partitioning."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import with_row_key
from .repeats import find_repeats, gram_hashes, merged, minimisers, runs_of

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word of a buffer."""
    solid = ~_SPACE[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    at = np.flatnonzero(solid)
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    word = np.cumsum(first[at]) - 1
    inside = at - starts[word]
    factor = (np.arange(int(inside.max()) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    factor ^= factor >> np.uint64(27)
    value = (raw[at].astype(np.uint64) + np.uint64(1)) * (factor[inside] | np.uint64(1))
    value ^= value >> np.uint64(32)
    value *= np.uint64(0x94D049BB133111EB)
    return starts, np.add.reduceat(value, np.searchsorted(at, starts))


class WordWindows:
    """Windows of consecutive words; a bucket sorts its windows and looks at neighbours."""

    presorted = True

    def __init__(self, window: int) -> None:
        self.window = window

    def units(self, text: bytes) -> list[bytes]:
        return text.split()

    def pack(self, units: list[bytes], first: int, end: int) -> bytes:
        return b" ".join(units[first:end])

    def anchors(self, texts: list[bytes], gram: int) -> tuple[np.ndarray, ...]:
        raw = np.frombuffer(b" ".join(texts), np.uint8)
        starts, h = _word_hashes(raw)
        none = np.zeros(0, np.int64)
        if len(h) < self.window:
            return none, none.astype(np.uint64), none, none, none
        begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]])
        doc = np.searchsorted(begin, starts, "right") - 1
        grams = gram_hashes(h, gram)
        anchor = minimisers(grams, self.window - gram + 1)
        valid = doc[: len(anchor)] == doc[self.window - 1 : self.window - 1 + len(anchor)]
        first, n = runs_of(anchor, valid)
        a = anchor[first]
        word0 = np.searchsorted(starts, begin)
        return doc[first], grams[a], first - word0[doc[first]], n, a - first

    def resolve(self, groups: list[list[tuple[bytes, int, int, int]]]) -> list[list[np.ndarray]]:
        answers = []
        w = self.window
        for group in groups:
            hits = [np.full(n, copies > 1) for _, n, _, copies in group]
            if len(group) > 1:
                rows = []
                for i, (s, n, _, _) in enumerate(group):
                    at = [0]
                    for x in s.split(b" "):
                        at.append(at[-1] + len(x) + 1)
                    rows += [(s[at[k] : at[k + w] - 1], i, k) for k in range(n)]
                rows.sort()
                for x, y in zip(rows, rows[1:]):
                    if x[0] == y[0]:
                        hits[x[1]][x[2]] = hits[y[1]][y[2]] = True
            answers.append(hits)
        return answers


def dedup_word_windows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 35,
    gram: int = 10,
    keep_text: bool = False,
) -> DataFrame:
    """One row per document: `id_col`, n_words, n_removed, kept_sha256 (and kept_text, the kept words joined by spaces).

    A word goes if a window of `window` words that covers it also starts anywhere else, the same document included;
    windows are judged on the input. Consecutive windows that share a minimiser travel as one packed string to its
    bucket, where sorting counts the windows exactly; minimisers that only one run has stay where they are, and runs of
    a minimiser that very many share are dealt out window by window.

    Null texts have no words. Texts shorter than a window lose nothing. Rows that repeat an id are separate documents,
    so rows that repeat wholly lose all their windows. Very long texts give more runs. Extra columns do not matter.
    """

    def cut_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, sha, kept = [], [], [], []
            for text, hits in zip(batch.column("_text"), batch.column("_hits")):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                total.append(len(words))
                left, n_gone = words, 0
                if hits.is_valid:
                    starts, ends = merged(hits.values.to_numpy())
                    left = [x for a, b in zip([0, *ends], [*starts, len(words)]) for x in words[a:b]]
                    n_gone = len(words) - len(left)
                gone.append(n_gone)
                left = b" ".join(left)
                sha.append(hashlib.sha256(left).hexdigest())
                if keep_text:
                    kept.append(left.decode("utf-8", "surrogatepass"))
            cols = [batch.column("_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            cols += [pa.array(kept, pa.string())] if keep_text else []
            yield pa.RecordBatch.from_arrays(cols, [id_col, "n_words", "n_removed", "kept_sha256", "kept_text"][: len(cols)])

    keyed = with_row_key(docs, id_col, text_col)
    schema = f"`{id_col}` {keyed.schema['_id'].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string"
    return find_repeats(keyed, WordWindows(window), gram).mapInArrow(cut_words, schema + (", kept_text string" if keep_text else ""))
