"""Token ids by distinct words, against the tokenizers library text by text."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from readlake.llm.tokens import encoder, slices

_R = random.Random(8)
_PARTS = ["a", "the", "The", " ", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "23", ".", ",", "é", "ſ", "\xa0", "\x85", "\x1c", "漢", "😀", "　", "\x00", "<|endoftext|>"]
_TEXTS = ["", " ", "  ", "a", " a", "a ", " a b ", "a  b", "a \n b", "a b " * 40]
_TEXTS += ["".join(_R.choice(_PARTS[: _R.choice([16, 24])]) for _ in range(_R.randrange(40))) for _ in range(3000)]


def _sliced(enc, texts, most):
    for part in slices(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]), most=most):
        words = enc.words(part.column("text"))
        counts, ids = words.counts(), words.ids()
        assert len(counts) == part.num_rows and counts.sum() == len(ids)
        yield from (x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1]))


@pytest.mark.parametrize("most", [1, 100, 1 << 20])
def test_ids_by_words_are_those_of_the_library(most):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [exact.encode(t, add_special_tokens=False).ids for t in _TEXTS]
    assert list(_sliced(encoder(), _TEXTS, most)) == want


def test_a_vocabulary_without_ranks_serves_too():
    path = public_tokenizers.path("byte_bpe_50k.json")
    exact = Tokenizer.from_file(path)
    assert list(_sliced(encoder(path), _TEXTS[:200], 1000)) == [exact.encode(t, add_special_tokens=False).ids for t in _TEXTS[:200]]


def test_no_rows_make_no_slice():
    assert list(_sliced(encoder(), [], 100)) == []


def test_training_order_encodes_a_word_once(monkeypatch):
    from readlake.llm import order

    class Docs:
        """Runs the first pass here and stops there."""

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            text = " ".join(_R.choice(["one", "two", "three"]) for _ in range(5000))
            list(run([pa.RecordBatch.from_arrays([pa.array([text] * 20)], ["text"])]))
            raise InterruptedError

    enc, seen = encoder("byte_bpe_50k"), []
    fast = enc.fast
    monkeypatch.setattr(enc, "fast", lambda text: seen.append(len(text)) or fast(text))
    monkeypatch.setattr(order, "text_or_empty", lambda name: _Column())
    monkeypatch.setattr(order, "F", type("F", (), {"col": staticmethod(lambda name: _Column())}))
    monkeypatch.setattr(order, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())}))
    with pytest.raises(InterruptedError):
        order.write_training_order(Docs(), "")
    assert 0 < sum(seen) < 1000


class _Column:
    def cast(self, kind):
        return self

    def alias(self, name):
        return self
