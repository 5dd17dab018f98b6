import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from agorakit.llm import ppm
from agorakit.llm.language import held_out


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(rows, fold=1, folds=5, order=ppm.ORDER):
    """Scores by following the definition one byte at a time."""
    held = {i: i is not None and zlib.crc32(str(i).encode()) % folds == fold for i, _ in rows}
    follow = defaultdict(Counter)
    tokens = Counter()
    for i, text in rows:
        if held[i]:
            continue
        tokens.update([*re.findall(r"[^\x20\x09-\x0D]+", low(text)), None])
        symbols = [ppm.PAD] * order + list(low(text).encode()) + [ppm.END]
        for at in range(order, len(symbols)):
            for k in range(order + 1):
                follow[tuple(symbols[at - k : at])][symbols[at]] += 1
    n, v = sum(tokens.values()), len(tokens)
    out = []
    for i, text in rows:
        words = [*re.findall(r"[^\x20\x09-\x0D]+", low(text)), None]
        base = sum(math.log10((tokens[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        symbols = [ppm.PAD] * order + list(low(text).encode()) + [ppm.END]
        score = 0.0
        for at in range(order, len(symbols)):
            out_of = set()
            for k in range(order, -1, -1):
                c = {s: x for s, x in follow.get(tuple(symbols[at - k : at]), {}).items() if s not in out_of}
                whole = 2 * sum(c.values())
                if symbols[at] in c:
                    score += math.log10((2 * c[symbols[at]] - 1) / whole)
                    break
                if c:
                    score += math.log10(len(c) / whole)
                out_of |= set(c)
            else:
                score -= math.log10(256 - len(out_of))
        out.append((i, held[i], len(words), sum(tokens[w] > 0 for w in words), n, base, score))
    return out


def scored(frame, rows):
    found = ppm.code_length(frame(rows), held_out(F.col("doc_id"), 5, 1))
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return [tuple(r) for r in found.collect()]


def same(found, expected):
    key = lambda r: (r[0] is None, r[0], r[6])
    assert len(found) == len(expected)
    for a, b in zip(sorted(found, key=key), sorted(expected, key=key)):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-6)


def test_equals_the_definition(frame, texts, monkeypatch):
    monkeypatch.setattr(ppm, "BLOCK", 700)  # blocks and chunks end inside and between texts
    monkeypatch.setattr(ppm, "CHUNK", 1500)
    rows = [(i, texts(i % 17, 5 + i)) for i in range(40)]
    rows += [(50, None), (51, ""), (52, " \t\n"), (53, "Ünïcode ÄÖ \U0001f600 \x00\x7f"), (54, "A"), (55, texts(3, 2500)), (None, texts(4, 9)), (None, "zz top")]
    rows += [(3, texts(3, 8)), (3, texts(3, 8)), (56, "aaaaaaaaaaaaaaaaaaaaaaaa"), (57, "qqqq" * 50)]
    same(scored(frame, rows), brute(rows))


def test_held_out_text_is_not_learned(frame):
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    alone = scored(frame, [(held, "some words here")])
    assert alone[0][:6] == (held, True, 4, 0, 0, 0.0)
    assert alone[0][6] == pytest.approx(-16 * math.log10(256))
    same(scored(frame, [(held, "some words"), (held + 1, "other words")]), brute([(held, "some words"), (held + 1, "other words")]))


def _messages(rows, each):
    """A slice's table of messages, each of a few rows."""
    import pyarrow as pa

    batches = []
    for k in range(0, len(rows), each):
        i, text = zip(*rows[k : k + each])
        held = [x % 5 == 1 for x in i]
        batches.append(pa.RecordBatch.from_arrays([pa.array(i), pa.array(text), pa.array(held), pa.array([7] * len(i), pa.int32())], names=["doc_id", "text", "held_out", "slice"]))
    return pa.Table.from_batches(list(ppm._bundled(iter(batches))))


def test_many_small_messages_are_read_like_few_large_ones(texts, monkeypatch):
    import pyarrow as pa

    from agorakit.llm import arrays

    rows = [(i, texts(i % 13, 3 + i)) for i in range(60)]
    few, many = _messages(rows, 60), _messages(rows, 1)
    assert (few.num_rows, many.num_rows) == (1, 60)
    calls = []
    look = ppm.pc.index_in
    monkeypatch.setattr(ppm.pc, "index_in", lambda *a, **b: calls.append(1) or look(*a, **b))
    found = []
    for docs in (few, many):
        assert len(list(ppm._chunks(docs))) == 1
        gathered = ppm._gather(4)(docs)
        shared = type("Shared", (), {"value": gathered["first"][-1].as_py()})
        parts = [gathered.filter(pa.compute.equal(gathered["part"], k)).drop(["first"]) for k in range(4)]
        answers = pa.concat_tables([ppm._score(shared)(x) for x in parts])
        assert int(arrays.unpacked(shared.value, "int64").sum()) == sum(len(t) + 1 for i, t in rows if i % 5 != 1)
        calls.clear()
        found.append(ppm._add_up(100, 10)(docs, answers).to_pylist())
        assert len(calls) == 1  # the words of a slice are looked up once, whatever the messages
    assert found[0] == found[1] and [r["doc_id"] for r in found[0]] == list(range(60))
    monkeypatch.setattr(ppm, "CHUNK", 500)
    chunks = list(ppm._chunks(many))
    assert 1 < len(chunks) < 60 and [i for x, _, _ in chunks for i in x.column("doc_id").to_pylist()] == list(range(60))


def test_no_rows(frame):
    assert scored(frame, []) == []


def test_probabilities_of_all_symbols_add_up_to_one():
    import numpy as np

    rng = np.random.default_rng(3)
    text = rng.integers(97, 101, 400).astype(np.uint8)
    buffer, _ = ppm.laid_out(text, np.array([0, 150, 400]))
    keys = np.concatenate([k for _, k in ppm.gram_blocks(buffer)])
    first = np.bincount(((keys >> np.uint64(8 * ppm.ORDER) << np.uint64(8)) | (keys & np.uint64(255))).astype(int), minlength=65536).reshape(256, 256)
    for context in (keys[10], keys[-1], np.uint64(0x414243444500)):
        every = (context >> np.uint64(8) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        both, counts = ppm.counted(np.r_[keys, every], np.r_[np.ones(len(keys), np.int64), np.zeros(256, np.int64)])
        found = 10 ** ppm.code_lengths(both, counts, first)[np.searchsorted(both, every)]
        assert found.sum() == pytest.approx(1.0)
