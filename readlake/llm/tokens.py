"""Token ids of texts by a public byte-level BPE vocabulary; vocabularies are read from a path, never trained."""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: A word with the space before it, or white space. Byte-level BPE of this family never joins ids across these cuts.
_CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: White space for Python but not for the vocabulary's own splitter.
_ODD = re.compile("[\x1c-\x1f]")
#: Characters on which both libraries agree by construction.
_PLAIN = re.compile("[\t-\r\x20-\x7e\xa1-ſ]*")
#: Chunks that one worker remembers.
_MOST_KEPT = 200_000
#: Bytes of text whose words are told apart at once; some 15 times that is held in memory.
SLICE = 8 << 20


class _Chunks(dict):
    """Little-endian unsigned 32-bit ids of chunks, encoded when first seen; for texts that the ranks may not serve."""

    def __init__(self, json_path: str, ranks_path: str | None, pattern: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.exact = Tokenizer.from_file(json_path)
        #: Texts that hold the content of an added token (<|endoftext|> and the like) are for the library alone.
        added = sorted(t.content for t in self.exact.get_added_tokens_decoder().values())
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.fast = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            #: Bytes of each id.
            self.width = np.zeros(max(ranks.values()) + 1, np.int64)
            self.width[list(ranks.values())] = list(map(len, ranks))
            self.fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _exact(self, text: str) -> bytes:
        return array("I", self.exact.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        out = self._exact(chunk)
        if len(self) < _MOST_KEPT:
            self[chunk] = out
        return out

    def count(self, text: str) -> int:
        """How many ids a text has."""
        if self.fast and _PLAIN.fullmatch(text) and not (self.added and self.added.search(text)):
            return len(self.fast(text))
        return len(self.ids(text)) // 4

    def ids(self, text: str) -> bytes:
        if self.added and self.added.search(text):
            return self._exact(text)
        if self.fast and _PLAIN.fullmatch(text):
            return array("I", self.fast(text)).tobytes()
        if _ODD.search(text):
            return self._exact(text)
        return b"".join(map(self.__getitem__, _CHUNK.findall(text)))

    def words(self, texts: pa.StringArray) -> Words:
        """The texts of a slice with each distinct word encoded once; see Words."""
        return Words(self, texts)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """`batch` in slices of about `most` bytes of text, a text at least; no text is null."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        n = max(1, int(np.searchsorted(ends, before + most, "right")) - at)
        yield batch.slice(at, n)
        at += n


class Words:
    """The ids of some texts, by the distinct words in them.

    A word is a space between two characters that are not white, and what follows up to the next such space. The
    vocabulary's splitter always cuts before such a space, and nothing before it changes what comes after, so the ids
    of a text are those of its words one after the other. Words are told apart by Arrow; distinct ones are encoded in
    one text, and what begins a text on its own. Texts that the ranks may not serve are encoded whole.
    """

    def __init__(self, enc: _Chunks, texts: pa.StringArray) -> None:
        texts, n = texts.cast(pa.string()), len(texts)
        bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = (bounds - bounds[0]).astype(np.int64)
        own = texts.to_pylist()
        whole = np.array([not enc.fast or not _PLAIN.fullmatch(t) or bool(enc.added and enc.added.search(t)) for t in own], bool)
        # 9 to 13 and the space are all that is white in plain texts
        ink = ((raw < 9) | (raw > 13)) & (raw != 32)
        cut = np.zeros(len(raw), bool)
        cut[1:-1] = (raw[1:-1] == 32) & ink[:-2] & ink[2:]
        # a space at either end of a text is none between two characters
        some = bounds[1:] > bounds[:-1]
        cut[bounds[:-1][some]] = False
        cut[bounds[1:][some] - 1] = False
        for i in np.flatnonzero(whole).tolist():
            cut[bounds[i] : bounds[i + 1]] = False
        starts = np.flatnonzero(cut)
        per = np.diff(np.searchsorted(starts, bounds))
        heads = np.append(starts, len(raw))[np.searchsorted(starts, bounds[:-1])]
        heads = np.minimum(heads, bounds[1:])
        # words end where the next one or the next text begins
        stops = np.append(starts[1:], len(raw))[: len(starts)]
        last = np.cumsum(per)[per > 0] - 1
        stops[last] = bounds[1:][per > 0]
        begun = [enc.ids(t) if w else enc.ids(str(raw[b:h], "utf-8")) for t, w, b, h in zip(own, whole.tolist(), bounds[:-1].tolist(), heads.tolist())]
        n_begun = np.array([len(x) // 4 for x in begun], np.int64)
        code, ids, n_word = np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(starts):
            lengths = stops - starts
            taken = np.zeros(len(raw) + 1, np.int8)
            taken[starts] += 1
            taken[stops] -= 1
            data = raw[np.cumsum(taken[:-1], dtype=np.int8).astype(bool)]
            ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
            found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data)).dictionary_encode()
            code = found.indices.to_numpy()
            ids = np.array(enc.fast("".join(found.dictionary.to_pylist())), np.uint32)
            until = np.searchsorted(np.cumsum(enc.width[ids]), np.cumsum(pc.binary_length(found.dictionary).to_numpy())) + 1
            n_word = np.diff(until, prepend=0)
        #: Ids of the beginnings, then of the distinct words; how many each has, and which words make up each text.
        self._first = np.cumsum(per) - per
        self._per, self._code, self._n_begun, self._n_word = per, code, n_begun, n_word
        self._ids = np.concatenate([np.frombuffer(b"".join(begun), "<u4"), ids])

    def counts(self) -> np.ndarray:
        """How many ids each text has."""
        run = np.append(0, np.cumsum(self._n_word[self._code]))
        return self._n_begun + run[self._first + self._per] - run[self._first]

    def ids(self) -> np.ndarray:
        """The ids of all texts, one after the other."""
        # parts in order: the beginning of a text, then its words
        at = self._first + np.arange(len(self._first))
        part = np.ones(len(self._code) + len(at), bool)
        part[at] = False
        n = np.empty(len(part), np.int64)
        n[at], n[part] = self._n_begun, self._n_word[self._code]
        begin = np.empty(len(part), np.int64)
        begin[at] = np.cumsum(self._n_begun) - self._n_begun
        begin[part] = (self._n_begun.sum() + np.cumsum(self._n_word) - self._n_word)[self._code]
        before = np.cumsum(n) - n
        return self._ids[np.repeat(begin - before, n) + np.arange(n.sum())]


@lru_cache(maxsize=2)
def encoder(name: str = "byte_bpe_50k") -> _Chunks:
    """The encoder of one vocabulary of `public_tokenizers`, or of a path to a tokenizers JSON file; one for each worker.

    The ids are those of the `tokenizers` library. Where the same vocabulary also lies beside it as ranks, texts of
    plain characters are encoded from those, which gives the same ids sooner.
    """
    import public_tokenizers

    if name.endswith(".json"):
        return _Chunks(name, None, "")
    return _Chunks(public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN)


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of `n` ids: whole ones of `capacity`, the first one shorter if need be."""
    first = n % capacity
    starts = [*([0] if first else []), *range(first, n, capacity)]
    return [(s, (first if first and s == 0 else capacity)) for s in starts]


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 2,
    vocabulary: str = "byte_bpe_50k",
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, crc[, ids]) of every document's ids followed by `end_id`; null texts count as empty.

    crc is the unsigned CRC-32 of the little-endian unsigned 32-bit ids; ids, where asked for, those bytes.
    """
    import zlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows, pieces, starts, lengths, crcs, held = [], [], [], [], [], []
                for i, text in enumerate(part.column("text")):
                    raw = enc.ids(text.as_py()) + end
                    view = memoryview(raw)
                    for k, (s, n) in enumerate(cut_points(len(raw) // 4, capacity)):
                        own = view[4 * s : 4 * (s + n)]
                        rows.append(i)
                        pieces.append(k)
                        starts.append(s)
                        lengths.append(n)
                        crcs.append(zlib.crc32(own))
                        if with_ids:
                            held.append(bytes(own))
                cols = [part.column("id").take(pa.array(rows, pa.int32())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64())]
                cols += [pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())] + ([pa.array(held, pa.binary())] if with_ids else [])
                yield pa.RecordBatch.from_arrays(cols, ["id", "piece", "start", "length", "crc", "ids"][: len(cols)])

    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = f"id {src.schema['id'].dataType.simpleString()}, piece int, start long, length long, crc long"
    return src.mapInArrow(run, schema + (", ids binary" if with_ids else ""))
