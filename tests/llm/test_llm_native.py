import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from agorakit.llm import fingerprint as P
from agorakit.llm import fixity as X
from agorakit.llm import licences as R
from agorakit.llm import placement as S


def shingles(text):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)}).split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


# --- fingerprints ---


def test_fingerprints(frame, texts):
    rows = [(10, texts(1, 60)), (8, texts(1, 60)), (7, texts(2, 40).upper()), (5, ""), (4, None), (3, "  "), (2, "one two"), (1, "é" * 7), (-4, texts(3, 90))]
    found = {r.doc_id: r for r in P.fingerprints(frame(rows)).collect()}
    order = [r for r, _ in rows]
    text = {i: t or "" for i, t in rows}
    for k, i in enumerate(order):
        own, after = text[i], text[order[(k + 1) % len(order)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        r = found[i]
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        # these sets are below the sketch size, so the estimates are exact
        assert r.near_edited == pytest.approx(jaccard(shingles(own), shingles(edited)))
        assert r.near_next == pytest.approx(jaccard(shingles(own), shingles(after)))
        assert r.n_shingles == len(shingles(own))
    assert found[10].fingerprint == found[8].fingerprint != found[7].fingerprint


def test_next_with_ties_nulls_and_many_blocks(spark):
    rows = [(i * i, f"t{i}") for i in range(200)] + [(9, "a"), (9, "b"), (9, "b"), (None, "n1"), (None, "n0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = collections.Counter((*r, ordered[(k + 1) % len(ordered)][1]) for k, r in enumerate(ordered))
    assert collections.Counter(tuple(r) for r in P.with_next(docs, ["text"]).collect()) == want


@pytest.mark.parametrize("rows", [
    [(i, f"t{i}") for i in range(2000)] + [(10**12, "far")],
    [(None, f"t{i:04}") for i in range(1000)] + [(7, f"{i:04}") for i in range(600)] + [(i, f"{i}") for i in range(400)],
    [(None, "same")] * 300 + [(5, "same")] * 300 + [(-(2**63), "é"), (2**63 - 1, "")],
    [(None, f"{i}") for i in range(50)],
], ids=["far id", "null ids and one id", "alike", "no id"])
def test_next_where_ids_crowd(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = collections.Counter((*r, ordered[(k + 1) % len(ordered)][1]) for k, r in enumerate(ordered))
    assert collections.Counter(tuple(r) for r in P.with_next(docs, ["text"]).collect()) == want
    if len(rows) >= 2000:  # the others are alike in id and text
        sizes = [n for (n,) in docs.groupBy(P.block_of(docs, 32).alias("b")).count().select("count").collect()]
        assert max(sizes) < 4 * len(rows) / 32


def test_single_and_no_document(frame):
    assert P.fingerprints(frame([(1, "a b c d e f")])).first().near_next == 1.0
    assert P.fingerprints(frame([])).count() == 0


def test_estimates_of_large_sets(spark):
    sets = spark.range(1).select(
        P.smallest(F.transform(F.sequence(F.lit(0), F.lit(19_999)), lambda i: F.xxhash64(i))).alias("a"),
        P.smallest(F.transform(F.sequence(F.lit(10_000), F.lit(24_999)), lambda i: F.xxhash64(i))).alias("b"),
    )
    r = sets.select(P.resemblance(F.col("a"), F.col("b")).alias("j"), P.distinct_count(F.col("a")).alias("n"), P.containment(F.col("b"), F.col("a")).alias("c")).first()
    assert abs(r.j - 0.4) < 0.15 and abs(r.n / 20_000 - 1) < 0.3 and abs(r.c - 2 / 3) < 0.25


def test_parts_merge_to_the_whole(spark):
    values = spark.range(5000).select((F.col("id") % 7).alias("part"), F.xxhash64("id").alias("h"))
    parts = values.groupBy("part").agg(P.smallest(F.collect_list("h")).alias("s"))
    merged = P.merge_by(parts.withColumn("all", F.lit(1)), ["all"], "s").first().s
    assert merged == values.agg(P.smallest(F.collect_list("h"))).first()[0]


# --- placement ---


def brute_table(shards, size):
    prefs = []
    for s in shards:
        o, k = S._number(f"offset:{s}") % size, S._number(f"skip:{s}") % (size - 1) + 1
        prefs.append([(o + j * k) % size for j in range(size)])
    owner = {}
    while True:
        for i, p in enumerate(prefs):
            owner[next(x for x in p if x not in owner)] = i
            if len(owner) == size:
                return [owner[x] for x in range(size)]


def test_table_is_filled_in_turns():
    names = [f"s{i}" for i in range(7)]
    assert S.fill(names, 101) == brute_table(names, 101)
    counts = collections.Counter(S.fill(names, 1009)).values()
    assert max(counts) - min(counts) <= 1


def test_few_slots_move_when_a_shard_leaves():
    names = [f"s{i}" for i in range(20)]
    before, after = S.fill(names, 10_007), S.fill(names[:-1], 10_007)
    moved = sum(a != b for a, b in zip(before, after) if a != 19)
    assert moved < 0.1 * 10_007


@pytest.mark.parametrize("shards,size", [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)])
def test_wrong_tables_are_refused(shards, size):
    with pytest.raises(ValueError):
        S.fill(shards, size)


def test_every_row_is_placed(spark):
    rows = [(i % 50, "x") for i in range(300)] + [(None, None), (None, "y")]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, shard string")
    found = S.documents_placed(docs, 8).collect()
    assert len(found) == 302 and all(r.shard_id == S.fill([f"shard-{i:04d}" for i in range(8)])[r.slot] for r in found)
    assert len({(r.doc_id, r.shard) for r in found}) == 51
    assert sum(r.n_bytes for r in found) == 301
    assert S.documents_placed(docs.limit(0)).count() == 0


def test_shards_are_written(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x") for i in range(100)], "doc_id long, text string")
    S.write_shards(S.documents_placed(docs, 4), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 100 and len(list((tmp_path / "s").glob("shard_id=*"))) == 4


# --- licences ---


def test_known_sentences_have_no_break_inside():
    import re

    for sentence in R.SENTENCES.values():
        assert len(re.split(R.BREAK.replace("\\z", "\\Z"), sentence)) == 1
    assert len({s for s, _ in R.known()}) == len(R.SENTENCES)
    assert all(set(ids) <= set(R.SENTENCES) for _, ids in R.RULES)


def test_licences(frame):
    apache = (
        'Copyright 2020 me\n\n   Licensed under the Apache License, Version 2.0 (the "License");\n   you may not use this file '
        "except in compliance with the License.\n   You may obtain a copy of the License at\n\n  http://example.com"
    )
    mit = "\n\n".join(R.SENTENCES[k] + "." for k in ("mit_grant", "mit_condition", "mit_warranty")).replace(", ", ",\n", 3)
    rows = [
        (1, apache),
        (2, mit),
        (3, "text |\nReleased under the MIT License.\nmore"),
        (4, "All rights reserved. licensed   UNDER cc-by-nc 4.0!"),
        (5, "\n\n".join(R.SENTENCES[k] + "." for k in ("mit_condition", "mit_grant", "mit_warranty"))),
        (6, "It was released under the MIT License. Not a sentence"),
        (7, None), (8, ""), (3, "text |\nReleased under the MIT License.\nmore"), (None, "All rights reserved"), (9, "x" * 300_000),
    ]
    found = collections.Counter((r.doc_id, r.licences, r.n_known) for r in R.licence_scan(frame(rows)).collect())
    assert found == collections.Counter({
        (1, "Apache-2.0", 3): 1, (2, "MIT", 3): 1, (3, "MIT", 1): 2, (4, "CC-BY-NC-4.0", 2): 1, (5, "", 3): 1,
        (6, "", 0): 1, (7, "", 0): 1, (8, "", 0): 1, (None, "all-rights-reserved", 1): 1, (9, "", 0): 1,
    })
    assert R.licence_scan(frame([])).count() == 0


def _notice(*names):
    return "Copyright 2020 somebody. " + "\n\n".join(R.SENTENCES[k] + "." for k in names)


@pytest.mark.parametrize("names, licences", [
    (("all_rights", "bsd_redistribution", "bsd_source", "bsd_binary", "bsd_names"), "BSD-3-Clause"),
    (("all_rights", "all_rights", "bsd_redistribution", "bsd_source", "bsd_binary"), "BSD-2-Clause"),
    (("bsd_redistribution", "bsd_source"), "BSD"),
    (("all_rights", "apache2_named", "apache2_compliance", "apache2_obtain"), "Apache-2.0"),
    (("mit_line", "all_rights"), "MIT,all-rights-reserved"),
    (("gpl_free", "gpl_terms", "gpl_either2", "gpl_hope"), "GPL-2.0-or-later"),
    (("lgpl_terms", "lgpl_either21"), "LGPL-2.1-or-later"),
    (("lgpl_terms", "gpl_either3"), "LGPL-3.0-or-later"),
    (("isc_grant",), "ISC"),
    (("zlib_asis", "zlib_grant"), "Zlib"),
    (("mit_grant", "mit_condition"), ""),
])
def test_rules_take_what_they_match(frame, names, licences):
    assert R.licence_scan(frame([(1, _notice(*names))])).first().licences == licences


def test_documented_licences_are_those_of_the_rules():
    for name, _ in R.RULES:
        assert name in R.__doc__


# --- fixity ---


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_audit_finds_what_differs(spark):
    rows = [(i, f"u{i}", "body " * (i % 9)) for i in range(3000)] + [(5, "again", "x"), (None, None, None)]
    other = [(i, u, "changed" if i == 1500 else h) for i, u, h in rows if i != 77] + [(9000, "new", "n")]
    mine, theirs = X.tree(X.records(table(spark, rows))), X.tree(X.records(table(spark, other)))
    found = {(r.archive, r.slot, r.status) for r in X.audit(mine, theirs).collect()}
    assert found == {(1, 1500 - 1024, "corrupt"), (0, 77, "missing"), (8, 9000 - 8192, "extra")}
    states = {r.archive: r.intact for r in X.roots(mine, theirs).collect()}
    assert states == {-1: True, 0: False, 1: False, 2: True, 8: False}
    assert X.audit(mine, mine).count() == 0


def test_records_moved_by_a_slot_are_found(spark):
    schema = "archive long, slot long, length long, digest string"
    mine = X.tree(spark.createDataFrame([(0, s, 10, f"d{k}") for k, s in enumerate((0, 1, 2))], schema))
    other = X.tree(spark.createDataFrame([(0, s, 10, f"d{k}") for k, s in enumerate((0, 1, 3))], schema))
    assert not X.roots(mine, other).first().intact
    assert {(r.slot, r.status) for r in X.audit(mine, other).collect()} == {(2, "missing"), (3, "extra")}
    # a node of its own moved whole: slots 16.. to 32..
    mine = X.tree(spark.createDataFrame([(0, s, 10, f"d{k}") for k, s in enumerate((0, 16, 300))], schema))
    other = X.tree(spark.createDataFrame([(0, s, 10, f"d{k}") for k, s in enumerate((0, 32, 300))], schema))
    assert {(r.slot, r.status) for r in X.audit(mine, other).collect()} == {(16, "missing"), (32, "extra")}
    # and equal replicas stay intact
    assert X.roots(mine, mine).first().intact and X.audit(mine, mine).count() == 0


def test_offsets_are_those_of_the_written_archive(spark):
    rows = [(i, f"u{i}", "é" * i) for i in (3, 1, 2)]
    text = {i: f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: u{i}\r\nContent-Length: {2 * i}\r\n\r\n{'é' * i}\r\n\r\n".encode() for i, _, _ in rows}
    other = [(i, u, h + "x" if i == 2 else h) for i, u, h in rows]
    r = X.audit(X.tree(X.records(table(spark, rows))), X.tree(X.records(table(spark, other)))).first()
    assert (r.low, r.high) == (len(text[1]), len(text[1]) + len(text[2]))


def test_repeated_records_and_empty_tables(spark):
    rows = [(1, "u", "x")] * 5
    fewer = X.audit(X.tree(X.records(table(spark, rows))), X.tree(X.records(table(spark, rows[:4])))).collect()
    assert [(r.status, r.n_mine, r.n_other) for r in fewer] == [("corrupt", 5, 4)]
    empty = X.tree(X.records(table(spark, [])))
    assert X.audit(empty, empty).count() == 0 and X.roots(empty, empty).count() == 0
