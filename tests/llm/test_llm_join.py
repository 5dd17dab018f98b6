import collections
import random

from agorakit.llm import ngram_join as J
from agorakit.llm.components import components


def brute(rows, num=75, den=100):
    """Components by comparing all pairs of exact shingle sets."""
    import re

    sets = []
    for _, t in rows:
        low = (t or "").translate({c: c + 32 for c in range(65, 91)})
        w = re.findall("[^\x20\x09-\x0d]+", low)
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return collections.Counter((rows[i][0], len(sets[i]), least.get(find(i))) for i in range(len(rows)))


def got(df):
    return collections.Counter(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def edited(text, rng, share):
    w = text.split()
    for _ in range(int(len(w) * share)):
        w[rng.randrange(len(w))] = "new" + str(rng.randrange(10**6))
    return " ".join(w)


def test_components_match_all_pairs(frame, texts):
    rng = random.Random(5)
    passage = texts(99, 60)
    rows = []
    for f in range(12):
        base = texts(f, rng.choice([6, 40, 150, 400]))
        for c in range(rng.choice([1, 2, 6])):
            t = edited(base, rng, rng.choice([0, 0.005, 0.01, 0.02]))
            rows.append((len(rows), t + (" " + passage if rng.random() < 0.5 else "")))
    rows += [(500, None), (501, ""), (502, "  \n "), (503, "one two"), (504, "ONE  two"), (505, "one two three"), (3, rows[3][1]), (4, "other text"), (None, rows[0][1])]
    assert got(J.jaccard_components(frame(rows))) == brute(rows)


def test_large_blocks_are_cut_and_joined(frame, texts, monkeypatch):
    monkeypatch.setattr(J, "CHUNK", 4)
    monkeypatch.setattr(J, "SMALL", 2)
    rng = random.Random(7)
    base = texts(1, 80)
    rows = [(i, edited(base, rng, 0.015 * (i % 4))) for i in range(40)]
    assert len(set(got(J.jaccard_components(frame(rows))))) == 40
    assert got(J.jaccard_components(frame(rows))) == brute(rows)


def test_dense_group_without_a_linked_centre(frame, texts, monkeypatch):
    # near copies of a passage that many other texts hold too: the smallest class of the group links with none of them
    monkeypatch.setattr(J, "CHUNK_SHINGLES", 600)
    rng = random.Random(13)
    base = texts(1, 100)
    rows = [(i, edited(base, rng, 0.022)) for i in range(90)]
    rows += [(100 + i, base + " " + texts(50 + i, 60 + 3 * i)) for i in range(30)]
    assert got(J.jaccard_components(frame(rows))) == brute(rows)


def test_sets_of_unlike_size_do_not_meet(spark):
    from agorakit.session import batch_rows

    rng = random.Random(23)
    classes = [band << J.BAND_SHIFT | rng.getrandbits(50) for band in rng.choices(range(3, 12), k=60)]
    rows = [(token, c) for token in range(25) for c in rng.sample(classes, rng.choice([1, 2, 5, 20]))]
    band = lambda c: c >> J.BAND_SHIFT
    wanted = set()
    for token in range(25):
        own = [c for t, c in rows if t == token]
        for centre in {min(x for x in own if band(x) == band(c)) for c in own}:
            wanted |= {(centre, c) for c in own if band(c) - band(centre) in (0, 1) and c != centre}
    wanted |= {(centre, centre) for centre, _ in wanted}
    size = collections.Counter(centre for centre, _ in wanted)
    with batch_rows(spark, 7):  # runs go on in later batches
        found = J.mates(spark.createDataFrame(rows, "token long, cls long")).collect()
    assert sorted(tuple(r) for r in found) == sorted((a, b, size[a]) for a, b in wanted)


def test_class_numbers_keep_bands_apart():
    key = b"\xff" * 16
    ratio = J._ratio(75, 100)
    sizes = [1, 2, 3, 5, 40, 41, 53, 54, 20_000, 10**9]
    bands = [J.class_number(key, n, ratio) >> J.BAND_SHIFT for n in sizes]
    assert bands == sorted(bands) and bands[0] == 0 and bands[-1] < J.LAST_BAND
    for n, m in ((3, 4), (30, 40), (39, 52), (7500, 10_000)):  # at the threshold
        assert (J.class_number(key, m, ratio) >> J.BAND_SHIFT) - (J.class_number(key, n, ratio) >> J.BAND_SHIFT) in (0, 1)
    assert 0 < J.class_number(key, 10**6, J._ratio(999, 1000)) < 1 << 63


def _block_rows(spark, sets, labels):
    import numpy as np

    rows = []
    for i, (x, label) in enumerate(zip(sets, labels)):
        x = np.array(sorted(x), np.uint64)
        rows.append((1, bytes([i // 256, i % 256]) * 8, len(x), bytearray(J.point(x).tobytes()), bytearray(label), False, bytearray(x.tobytes())))
    return spark.createDataFrame(rows, "block long, k binary, n long, point binary, label binary, late boolean, shingles binary")


def test_a_block_returns_fewer_links_than_members(spark, monkeypatch):
    monkeypatch.setattr(J, "SLAB", 3)
    rng = random.Random(17)
    # 120 sets that are all alike, 30 of a chain in which only neighbours link, 20 that link with nothing
    core = {rng.getrandbits(64) for _ in range(200)}
    sets = [core - set(rng.sample(sorted(core), 4)) | {rng.getrandbits(64)} for _ in range(120)]
    line = [rng.getrandbits(64) for _ in range(600)]
    sets += [set(line[10 * i : 10 * i + 100]) for i in range(30)]
    sets += [{rng.getrandbits(64) for _ in range(90)} for _ in range(20)]
    labels = [b"same" if i in (3, 8) else bytes([1, i // 256, i % 256]) for i in range(len(sets))]
    rows = _block_rows(spark, sets, labels)
    kept = {bytes(r.k) for r in J.with_partner(rows, 75, 100).collect()}
    links = J.joining_links(rows, 75, 100).collect()
    parent = {bytes(r.k): bytes(r.k) for r in rows.collect()}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    names = [bytes([i // 256, i % 256]) * 8 for i in range(len(sets))]
    parent[find(names[3])] = find(names[8])
    for a, b in links:
        assert find(bytes(a)) != find(bytes(b))  # every link joins
        parent[find(bytes(a))] = find(bytes(b))
    assert {bytes(k) for link in links for k in link} <= kept
    assert len({find(n) for n in names[:120]}) == 1 and len({find(n) for n in names[120:150]}) == 1
    assert len({find(n) for n in names}) == 22


def test_other_thresholds(frame, texts):
    rng = random.Random(9)
    rows = [(i, edited(texts(i // 5, 60), rng, 0.04)) for i in range(30)]
    assert got(J.jaccard_components(frame(rows), 1, 2)) == brute(rows, 1, 2)


def test_empty_table(frame):
    assert J.jaccard_components(frame([])).count() == 0


def test_keep_one(frame, texts):
    rows = [(5, texts(1, 50)), (2, texts(1, 50)), (2, texts(1, 50)), (7, texts(2, 50)), (None, texts(3, 50)), (8, None), (9, None)]
    docs = frame(rows)
    kept = J.keep_one(docs, J.jaccard_components(docs))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 2), (False, 7), (False, 8), (False, 9), (True, None)]


def test_keep_one_with_repeated_and_null_ids(frame, texts):
    one, two, three, four = (texts(k, 50) for k in range(1, 5))
    # 5 has two texts: one is a copy of 3's, the other of 9's; three copies have no id, and a group has ids beside a null
    rows = [(5, one), (3, one), (5, two), (9, two), (None, three), (None, three), (None, three), (None, four), (6, four)]
    rows += [(None, None), (None, ""), (8, None), (8, None), (8, "")]
    docs = frame(rows)
    kept = sorted(((r.doc_id, r.text) for r in J.keep_one(docs, J.jaccard_components(docs)).collect()), key=str)
    want = [(3, one), (5, two), (None, three), (6, four), (None, None), (None, ""), (8, None), (8, "")]
    assert kept == sorted(want, key=str)


def test_keep_one_takes_the_smallest_text_of_an_id(frame, texts):
    base = texts(1, 200)
    docs = frame([(2, base + " b"), (2, base + " a"), (4, base)])
    assert [(r.doc_id, r.text) for r in J.keep_one(docs, J.jaccard_components(docs)).collect()] == [(2, base + " a")]


def test_tree_bound_keeps_every_pair():
    import numpy as np

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 400, rng.integers(20, 200), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(80)]
    box = J._folded([J.point(x) for x in sets])
    size = np.array([len(x) for x in sets])
    x, y = J.Tree(box, size, np.arange(len(sets))).pairs(1, 4)
    found = {(min(a, b), max(a, b)) for a, b in zip(x.tolist(), y.tolist())}
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 4 * both >= size[a] + size[b] - both:
                assert (a, b) in found


def test_components_of_paths_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
