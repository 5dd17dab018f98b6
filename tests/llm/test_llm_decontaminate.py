import hashlib
import random
import re

import numpy as np
import pytest

from agorakit.llm import decontaminate as D

PATTERN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = {c: c + 32 for c in range(65, 91)}


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = PATTERN.findall((t or "").translate(LOW))
        for k in range(max(len(w) - 13, 0) + 1 if w and i is not None else 0):
            windows.setdefault(tuple(w[k : k + 13]), set()).add(str(i))
    out = []
    for i, t in docs:
        w = PATTERN.findall((t or "").translate(LOW))
        hit, ids = set(), set()
        for p, own in windows.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    ids |= own
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(ids), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.fixture
def case(texts):
    rng = random.Random(2)
    items = [(i, texts(1000 + i, rng.choice([3, 12, 13, 14, 30]))) for i in range(12)]
    items += [(50, None), (51, ""), (None, texts(3, 20)), (52, "Über große Straße"), (100, items[0][1]), (9, items[1][1].upper())]
    docs = []
    for i in range(40):
        w = texts(i, rng.choice([0, 5, 30, 200])).split()
        for _ in range(rng.randrange(3)):
            own = (rng.choice(items[:12])[1]).split()
            cut = own[rng.randrange(3) :] if rng.random() < 0.5 else own
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() + "!" for x in cut]
        docs.append((i, " ".join(w)))
    docs += [(90, None), (91, ""), (92, "ÜBER GROßE Straße"), (93, "Über große Straße"), (3, docs[3][1]), (3, docs[3][1]), (None, items[4][1])]
    return docs, items


def run(spark, frame, docs, items, **more):
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, spans string")
    scan = D.contamination(frame(docs), bench)
    return sorted((tuple(r) for r in scan.collect()), key=repr)


def test_matches_brute_force(spark, frame, case):
    docs, items = case
    assert run(spark, frame, docs, items) == brute(docs, items)


def test_blocks_of_the_benchmark_give_the_same(spark, frame, case, monkeypatch):
    docs, items = case
    monkeypatch.setattr(D.scan, "__defaults__", (13, 25))
    assert run(spark, frame, docs, items) == brute(docs, items)


def test_empty_tables(spark, frame, case):
    docs, items = case
    assert run(spark, frame, [], items) == []
    assert run(spark, frame, docs, []) == brute(docs, [])


def test_clean_keeps_columns_and_clean_rows(spark, frame, case):
    docs, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = D.clean(frame(docs), bench)
    assert kept.columns == frame(docs).columns
    want = sorted(repr(r[0]) for r in brute(docs, items) if not r[5])
    assert sorted(repr(r.doc_id) for r in kept.collect()) == want


def test_suffixes_and_index():
    rng = np.random.default_rng(1)
    for _ in range(60):
        # words are 2 and up, 1 ends a document, 0 the text
        text = np.r_[rng.integers(1, 6, rng.integers(1, 120)), 1].astype(np.int64)
        if rng.random() < 0.5:
            text = np.r_[text, text]
        text = np.r_[text, 0]
        order = D.suffix_order(text, 3)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        index = D.FMIndex(text, 5)
        for at in range(0, len(text) - 4, 7):
            phrase = text[at : at + 3]
            low, high = index.search(phrase[None, :], np.array([3]))
            found = sorted(index.locate(np.arange(low[0], high[0])).tolist())
            assert found == [i for i in range(len(text)) if text[i : i + 3].tolist() == phrase.tolist()]


def test_passages_at_the_start_of_documents(spark, frame, texts):
    items = [(i, texts(500 + i, 20)) for i in range(6)]
    docs = [(i, items[i % 6][1] + " " + texts(i, 5 + i)) for i in range(40)] + [(50 + i, texts(90 + i, 9)) for i in range(20)]
    assert run(spark, frame, docs, items) == brute(docs, items)


def test_blocks_are_bounded_and_keep_every_window(spark):
    import re

    rows = [("a", "\n".join(f"w{i}" for i in range(500))), ("b", "x" + ",y" * 200 + "  "), ("c", ""), ("d", "Ein-Wort"), ("e", " .. "), ("f", "k " * 30)]
    benchmark = spark.createDataFrame(rows, "item_id string, text string").coalesce(1)
    words = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", t.lower())
    windows = lambda i, t: {(i, *words(t)[k : k + 13]) for k in range(max(len(words(t)) - 12, 1))} if words(t) else set()
    for limit in (1, 13, 14, 40, 10**6):
        blocks = list(D._blocks(benchmark, limit))
        assert all(sum(len(words(t)) for _, t in block) <= max(limit, 13) for block in blocks)
        found = set().union(*[windows(i, t) for block in blocks for i, t in block])
        assert found == set().union(*[windows(i, t) for i, t in rows])
