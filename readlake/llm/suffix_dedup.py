"""Substring deduplication by a sparse suffix array, sorted deep-shallow."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import with_row_key
from .repeats import find_repeats, gram_hashes, merged, minimisers, runs_of

#: Bytes that multikey quicksort looks at in one step.
_STEP = 8


def lcp(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return (8 * n - x.bit_length()) // 8


class _Node:
    __slots__ = ("depth", "items", "kids")

    def __init__(self, depth: int, items: list[int] | None = None) -> None:
        self.depth, self.items, self.kids = depth, items, {}


def _blind_trie(strings: list[bytes], ids: list[int], out: list[int]) -> None:
    """Append `ids` to `out` in the order of their strings.

    The trie keeps only branching depths and bytes. A new string descends by those bytes alone, is compared with the
    one leaf it reaches, and is hung where that comparison says it differs.
    """
    root: _Node | None = None
    for i in ids:
        s = strings[i]
        if root is None:
            root = _Node(len(s), [i])
            continue
        node = root
        while node.items is None:
            key = s[node.depth] if node.depth < len(s) else -1
            node = node.kids.get(key) or next(iter(node.kids.values()))
        t = strings[node.items[0]]
        if s == t:
            node.items.append(i)
            continue
        d = lcp(s, t)
        above, node = None, root
        while node.items is None and node.depth < d:
            above, node = node, node.kids[s[node.depth]]
        mine = s[d] if d < len(s) else -1
        if node.items is None and node.depth == d:
            node.kids[mine] = _Node(len(s), [i])
            continue
        split = _Node(d)
        split.kids[t[d] if d < len(t) else -1] = node
        split.kids[mine] = _Node(len(s), [i])
        if above is None:
            root = split
        else:
            above.kids[s[above.depth]] = split
    stack = [root]
    while stack:
        node = stack.pop()
        if node.items is not None:
            out.extend(node.items)
        else:
            stack.extend(node.kids[k] for k in sorted(node.kids, reverse=True))


def deep_shallow_sort(strings: list[bytes], start: int, shallow: int) -> list[int]:
    """Order of `strings`, which agree on their first `start` bytes.

    Multikey quicksort, several bytes at a step, down to depth `shallow`; groups that still agree there have long
    common prefixes and are ordered by blind tries.
    """
    out: list[int] = []
    stack: list[tuple[list[int], int]] = [(list(range(len(strings))), start)]
    while stack:
        ids, depth = stack.pop()
        if len(ids) == 1:
            out.append(ids[0])
            continue
        if depth >= shallow:
            _blind_trie(strings, ids, out)
            continue
        pivot = strings[ids[len(ids) // 2]][depth : depth + _STEP]
        less, same, more = [], [], []
        for i in ids:
            part = strings[i][depth : depth + _STEP]
            (same if part == pivot else less if part < pivot else more).append(i)
        if more:
            stack.append((more, depth))
        # strings that end inside the step are equal throughout
        stack.append((same, depth + _STEP if len(pivot) == _STEP else shallow))
        if less:
            stack.append((less, depth))
    return out


def _ranks(groups: list[list[bytes]], gram: int, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each string, LCP of each rank with the one before; -1 where a group begins), all groups in a row."""
    rank, before, base = [], [], 0
    for strings in groups:
        order = deep_shallow_sort(strings, gram, shallow) if len(strings) > 1 else [0]
        own = [0] * len(order)
        for r, i in enumerate(order):
            own[i] = base + r
        before.append(-1)
        before.extend(lcp(strings[a], strings[b]) for a, b in zip(order, order[1:]))
        rank += own
        base += len(order)
    return np.array(rank, np.int64), np.array(before, np.int64)


class ByteWindows:
    """Windows of bytes; a bucket sorts the suffixes at its anchors and, reversed, what lies before them.

    The suffix order alone tells which strings of a bucket are alike: they come in no order.
    """

    presorted = False

    def __init__(self, window: int, shallow: int) -> None:
        self.window, self.shallow = window, shallow

    def units(self, text: bytes) -> bytes:
        return text

    def pack(self, units: bytes, first: int, end: int) -> bytes:
        return units[first:end]

    def anchors(self, texts: list[bytes], gram: int) -> tuple[np.ndarray, ...]:
        raw = np.frombuffer(b"".join(texts), np.uint8)
        none = np.zeros(0, np.int64)
        if len(raw) < self.window:
            return none, none.astype(np.uint64), none, none, none
        sizes = np.array([len(t) for t in texts])
        begin = np.cumsum(sizes) - sizes
        grams = gram_hashes((raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), gram)
        anchor = minimisers(grams, self.window - gram + 1)
        valid = np.zeros(len(anchor), bool)
        for b, n in zip(begin.tolist(), sizes.tolist()):
            valid[b : max(b, b + n - self.window + 1)] = True
        # neighbouring windows of two texts are never consecutive: the last window - 1 starts of a text are not valid
        first, n = runs_of(anchor, valid)
        a = anchor[first]
        doc = np.searchsorted(begin, first, "right") - 1
        return doc, grams[a], first - begin[doc], n, a - first

    def resolve(self, groups: list[list[tuple[bytes, int, int, int]]]) -> list[list[np.ndarray]]:
        """Window at distance d left of its anchor occurs again if another string agrees on d bytes to the left and on
        the rest to the right: the two have the same class in both sorted orders, cut at those depths."""
        items = [x for g in groups for x in g]
        n, off = np.array([x[1] for x in items]), np.array([x[2] for x in items])
        hits = [np.full(x[1], x[3] > 1) for x in items]
        open_ = np.array([x[3] == 1 for x in items])
        size = np.array([len(g) for g in groups])
        lone = np.repeat(size == 1, size)
        if not lone.all():
            right, before_r = _ranks([[x[0][x[2] :] for x in g] for g in groups], 0, self.shallow)
            left, before_l = _ranks([[x[0][: x[2]][::-1] for x in g] for g in groups], 0, self.shallow)
            for d in range(int((off - n + 1).min()), int(off.max()) + 1):
                at = np.flatnonzero((d <= off) & (off - n < d) & ~lone)
                if not len(at):
                    continue
                key = np.cumsum(before_l < d)[left[at]] * (len(items) + 1) + np.cumsum(before_r < self.window - d)[right[at]]
                _, where, count = np.unique(key, return_inverse=True, return_counts=True)
                for i in at[(count[where] > 1) & open_[at]]:
                    hits[i][off[i] - d] = True
        answers, k = [], 0
        for g in groups:
            answers.append(hits[k : k + len(g)])
            k += len(g)
        return answers


def dedup_substrings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 200,
    gram: int = 64,
    shallow: int = 96,
    keep_text: bool = False,
) -> DataFrame:
    """One row per document: `id_col`, n_bytes, n_removed, n_spans, kept_sha256 (and kept_bytes).

    A byte of a text's UTF-8 form goes if a string of `window` bytes that covers it also starts anywhere else, the same
    document included; strings are judged on the input and never cross documents. The suffix array is sparse: every
    window holds an anchor, the least gram hash in it, and suffixes are sorted where anchors are that more than one
    place shares. Buckets sort them deep-shallow, to the right and, reversed, to the left; ranges of the two orders
    with long enough common prefixes tell which windows are equal.

    Null texts count as empty. Texts shorter than a window lose nothing. Rows that repeat an id are separate documents,
    so rows that repeat wholly lose all their windows. The remaining bytes need not be valid UTF-8, so kept_bytes is
    binary. Extra columns do not matter.
    """

    def cut_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, spans, sha, kept = [], [], [], [], []
            for text, hits in zip(batch.column("_text"), batch.column("_hits")):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                total.append(len(raw))
                left, n_spans = raw, 0
                if hits.is_valid:
                    starts, ends = merged(hits.values.to_numpy())
                    left, n_spans = b"".join(raw[a:b] for a, b in zip([0, *ends], [*starts, len(raw)])), len(starts)
                gone.append(len(raw) - len(left))
                spans.append(n_spans)
                sha.append(hashlib.sha256(left).hexdigest())
                if keep_text:
                    kept.append(left)
            cols = [batch.column("_id"), *(pa.array(x, pa.int64()) for x in (total, gone, spans)), pa.array(sha, pa.string())]
            cols += [pa.array(kept, pa.binary())] if keep_text else []
            names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"]
            yield pa.RecordBatch.from_arrays(cols, names[: len(cols)])

    keyed = with_row_key(docs, id_col, text_col)
    kind = keyed.schema["_id"].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    hits = find_repeats(keyed, ByteWindows(window, shallow), gram)
    return hits.mapInArrow(cut_bytes, schema + (", kept_bytes binary" if keep_text else ""))
