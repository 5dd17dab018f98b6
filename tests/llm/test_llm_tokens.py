import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from agorakit.llm import packing as K
from agorakit.llm.queries import vocabulary
from agorakit.llm.tokens import Vocabulary

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def slow():
    return tokenizers.Tokenizer.from_str(vocabulary())


def test_ids_equal_the_library(slow):
    rng = random.Random(1)
    parts = ["'", "s", "t", "re", "ve", " ", "  ", "\n", "\t", "a", "É", "1", "²", "!", "日本", " ", "'ll", "'S", "\r\n", "<|endoftext|>", "😀", "͸", "​"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(3000)] + ["", None, " ", "'s", " 's"]
    vocab = Vocabulary(vocabulary())
    assert vocab.fast is not None
    ids, counts = vocab.encode(pa.array(texts, pa.string()))
    own = np.split(ids, np.cumsum(counts)[:-1])
    for text, x in zip(texts, own):
        assert x.tolist() == slow.encode(text or "", add_special_tokens=False).ids


def check(found, docs, slow, length):
    """Every id lies in one piece, sequences have no gap, and no padding is needed but in none."""
    left = sorted(repr((d, len(slow.encode(t or "", add_special_tokens=False).ids) + 1)) for d, t in docs)
    assert sorted(repr((r.doc_id, r.doc_tokens)) for r in found if r.start == 0) == left
    by_text = {}
    for d, t in docs:
        by_text.setdefault(d, []).append(np.array(slow.encode(t or "", add_special_tokens=False).ids + [0], "<u4"))
    for r in found:
        assert any(zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in by_text[r.doc_id] if len(x) == r.doc_tokens)
    assert sum(r.length for r in found) == sum(len(x) for v in by_text.values() for x in v)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length and at & (at - 1) == 0


@pytest.mark.parametrize("length", [16, 1024])
def test_round_trip(frame, texts, slow, length):
    docs = [(i, texts(i, n)) for i, n in enumerate([0, 1, 3, 50, 400, 3000, 7])]
    docs += [(20, None), (21, ""), (5, docs[5][1]), (5, "x"), (None, "no id"), *[(30 + i, texts(2, 40)) for i in range(30)]]
    check(K.pack(frame(docs), vocabulary(), length).collect(), docs, slow, length)


def test_ids_of_pieces(frame, texts, slow):
    rows = K.pack(frame([(1, texts(1, 900)), (2, texts(2, 20))]), vocabulary(), 64).orderBy("doc_id", "start").collect()
    for d, n in ((1, 900), (2, 20)):
        assert [x for r in rows if r.doc_id == d for x in r.ids] == slow.encode(texts(d, n), add_special_tokens=False).ids + [0]


def test_empty_table(frame):
    assert K.pack(frame([]), vocabulary()).count() == 0


def test_hilbert_steps_to_neighbours():
    cells = np.array(np.meshgrid(*[range(8)] * 3)).reshape(3, -1).T
    key = K.hilbert(cells, 3)
    walk = cells[np.argsort(key)]
    assert sorted(key.tolist()) == list(range(512))
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()
