import random
import re
from collections import Counter, defaultdict

import numpy as np

from agorakit.llm import phrases as P


def brute(rows, least, share=80, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        often = {g: a for g, a in counts.items() if a >= least and len(g) > 1}
        gone = {
            g[i:j] for g, a in often.items() for i in range(len(g)) for j in range(i + 2, len(g) + 1) if j - i < len(g) and 100 * a >= share * counts[g[i:j]]
        }
        rows_ = []
        for g, a in often.items():
            if g in gone:
                continue
            score, _, left, right = min((2000000 * a // (counts[g[:k]] + counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g)))
            rows_.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(n=150):
    rng = random.Random(8)
    fixed = ["new york city hall", "san francisco bay", "Guten Tag", "a priori", "über alles"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(2, 40)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice("abcdefgh") + rng.choice("xy"))
            parts.append(rng.choice([" ", " ", " ", "\t", ", ", ". ", "\n", "!  ", " ;"]))
        rows.append((rng.choice(["en", "de", None, "und"]), "".join(parts)))
    return [*rows, ("en", None), ("en", ""), ("de", " \n.,"), ("fr", "seul"), ("en", "x x x x x x x x x"), ("en", "x x x x x x x x x")]


def frame(spark, rows):
    data = [(1, t, g, "s", 1, "w", 2) for g, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, word string, id long, ids string, f long")


def mined(spark, rows, **more):
    found = P.collocations(frame(spark, rows), **more)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in found.collect())


def test_equals_counting_every_phrase(spark):
    rows = corpus()
    expected = brute(rows, 5)
    assert len(expected) > 20
    assert mined(spark, rows, least=5) == expected


def test_small_tries_that_burst_and_spill(spark, monkeypatch):
    rows = corpus()
    for name, value in (("CHUNK", 60), ("BURST", 8), ("LIMIT", 40), ("WORDS", 20)):
        monkeypatch.setattr(P, name, value)
    assert mined(spark, rows, least=4, top=7) == brute(rows, 4, top=7)


def test_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [("en", None), (None, "a b")]) == []


def test_equal_ids_make_the_ids_anew(spark, monkeypatch):
    real = P.word_ids

    def poor(words, langs, seed):
        ids = real(words, langs, seed)
        return ids % np.uint64(7) + np.uint64(1) if seed == 0 else ids

    monkeypatch.setattr(P, "word_ids", poor)
    rows = corpus(60)
    assert mined(spark, rows, least=3) == brute(rows, 3)


def test_long_texts_are_cut_between_pieces_only():
    import pyarrow as pa

    text = "aa bb cc. dd ee, " * 30 + "ff " * 90 + "gg"
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "de"], "text": [text, "hh"]})
    stretches = list(P.text_chunks(iter([batch]), 50))
    assert b"".join(bytes(d) for d, _, _ in stretches).decode() == text + "hh"
    for data, offsets, _ in stretches[:-2]:
        assert all(bytes(data)[b - 1 : b] in (b".", b",") for b in offsets[1:])


def test_a_task_copies_few_texts_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    seen, real = [], P.utf8

    def watched(values):
        data, offsets = real(values)
        seen.append(len(data))
        return data, offsets

    monkeypatch.setattr(P, "utf8", watched)
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 24, "text": ["ab " * (1 << 18)] * 24})
    assert sum(len(d) for d, _, _ in P.text_chunks(iter([batch]))) == 24 * 3 << 18
    assert sum(seen) == 24 * 3 << 18 and max(seen) <= 5 << 20
    runs = [(i, b"x" * 60, b"y" * 30) for i in range(10)]
    sent = list(P.run_batches(iter(runs), 200))
    assert [b.num_rows for b in sent] == [3, 3, 3, 1]
    assert [tuple(r.values()) for b in sent for r in b.to_pylist()] == runs


def test_batches_are_small_while_texts_are_read_and_the_setting_comes_back(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, inside, real = spark.conf.get(name), [], P.word_counts

    def watched(docs, seed):
        inside.append(int(spark.conf.get(name)))
        return real(docs, seed)

    monkeypatch.setattr(P, "word_counts", watched)
    P.frequent_phrases(frame(spark, corpus(20)), 3)
    assert inside and max(inside) <= P.ROWS and spark.conf.get(name) == before
