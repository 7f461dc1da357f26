"""Jaccard join, suffix dedup, neighbours and embedding dedup against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from fragloom.llm import ngram_join, suffix_dedup
from fragloom.llm.components import components, roots_of
from fragloom.llm.embedding_dedup import least_collisions, near_copies
from fragloom.llm.neighbours import Forest, nearest
from fragloom.llm.ngram_join import jaccard_join, remove_near_copies
from fragloom.llm.shelf import Shelf
from fragloom.llm.suffix_dedup import merged, repeated_passages, without_repeats


def shingles(text, k):
    words = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i: i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def reach(ids, pairs):
    root = {i: i for i in ids}
    moved = True
    while moved:
        moved = False
        for a, b in pairs:
            low = min(root[a], root[b])
            moved |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    bases = [[pick.choice(words) for _ in range(pick.choice([3, 8, 40, 120]))] for _ in range(25)]
    made = []
    for _ in range(220):
        own = list(pick.choice(bases))
        for _ in range(pick.choice([0, 0, 1, 2, 4])):
            own[pick.randrange(len(own))] = pick.choice(words)
        made.append(" ".join(own).replace("w1", pick.choice(["w1", "W1"])) + pick.choice(["", " \n"]))
    return [None, "", " \t ", "one", "ONE ", *made, "Ä b c d", "ä b c d"]


@pytest.mark.parametrize("k, threshold", [(4, (85, 100)), (5, (80, 100)), (2, (1, 2))])
@pytest.mark.parametrize("tile", [20_000, 5])
def test_jaccard_join(rows, texts, k, threshold, tile, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE_ROWS", tile)
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 3 if tile == 5 else 200_000)
    if tile == 5:
        monkeypatch.setattr(ngram_join, "SMALL_TILE", 4)
    docs = rows([(7 * i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_shingles int")
    got = {r.doc_id: r for r in jaccard_join(docs, k, threshold).collect()}
    sets = {7 * i: shingles(t, k) for i, t in enumerate(texts)}
    pairs = [
        (a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
        and threshold[1] * len(sets[a] & sets[b]) >= threshold[0] * len(sets[a] | sets[b])]
    want = reach(sets, pairs)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(s), want[i], want[i] == i) for i, s in sets.items()}


def test_jaccard_join_odd_rows(rows):
    schema = "doc_id long, text string, token string"
    assert jaccard_join(rows([], schema)).count() == 0
    assert remove_near_copies(rows([], schema)).count() == 0
    odd = rows([(None, "a b c d e f", "x"), (None, "a b c d e f", "x"), (4, "a b c d e f", "x"), (4, "a b c d e f", "x"),
                (9, "a b c d e f", "x"), (5, None, "x")], schema)
    found = sorted((r.doc_id is None, r.doc_id or 0, r.component_id, r.kept) for r in jaccard_join(odd).collect())
    assert found == [(False, 4, 4, True), (False, 4, 4, True), (False, 5, 5, True), (False, 9, 4, False),
                     (True, 0, None, True), (True, 0, None, True)]
    left = remove_near_copies(odd)
    assert left.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 0, 4, 5]


def test_unlike_texts_of_one_id_stay(rows):
    long = " ".join(f"w{i}" for i in range(40))
    docs = [(5, long, "a"), (5, "wholly another text of some words", "b"), (5, long, "c"), (5, None, "d"), (5, "", "e"),
            (6, long + " more", "f"), (7, "a third text that is like no other", "g")]
    got = remove_near_copies(rows(docs, "doc_id long, text string, source string"))
    assert sorted(r.source for r in got.collect()) == ["a", "b", "d", "g"]


def test_components_of_many_edges_by_rounds(spark, rows, monkeypatch):
    from fragloom.llm import components as module
    monkeypatch.setattr(module, "EDGES_IN_TASK", 0)
    pick = random.Random(9)
    pairs = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1200)]
    got = {r.vertex: r.root for r in components(rows(pairs, "a long, b long"), Shelf(spark, "t")).collect()}
    assert got == reach({x for p in pairs for x in p}, pairs)


def test_jaccard_join_of_repeated_rows(rows):
    """A text links two shorter ones that are not linked themselves; its row is there many times."""
    docs, groups = [], [1, 7, 8, 61, 62, 63, 70]
    for g, times in enumerate(groups):
        words = [f"g{g}w{i}" for i in range(100)]
        docs += [(10 * g, " ".join(words))] * times + [(10 * g + 1, " ".join(words[10:])), (10 * g + 2, " ".join(words[:-10]))]
    got = {(r.doc_id, r.component_id) for r in jaccard_join(rows(docs, "doc_id long, text string")).collect()}
    assert got == {(10 * g + i, 10 * g) for g in range(len(groups)) for i in range(3)}


def test_components(spark, rows):
    pick = random.Random(8)
    pairs = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1200)] + [(5000, 5000)]
    got = {r.vertex: r.root for r in components(rows(pairs, "a long, b long"), Shelf(spark, "t")).collect()}
    assert got == reach({x for p in pairs for x in p}, pairs)
    assert components(rows([], "a long, b long"), Shelf(spark, "t")).count() == 0
    names, root = roots_of(np.array([3, 9, 9]), np.array([9, 12, 3]))
    assert (names.tolist(), root.tolist()) == ([3, 9, 12], [3, 3, 3])


def passages(docs, length=100):
    first, out = {}, {}
    for i, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            w = data[s: s + length]
            if first.setdefault(w, (i, s)) != (i, s):
                gone[s: s + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture(scope="module")
def repeated():
    pick = random.Random(1)
    parts = ["".join(pick.choice("abc é") for _ in range(pick.choice([60, 99, 100, 101, 150, 400]))) for _ in range(12)]
    docs = []
    for i in range(150):
        text = ""
        for _ in range(pick.randrange(0, 8)):
            part, how = pick.choice(parts), pick.random()
            text += part if how < .5 else part[pick.randrange(0, 30):] if how < .7 else "a" * pick.randrange(50, 400) \
                if how < .8 else "".join(pick.choice("xyz ") for _ in range(pick.randrange(10, 200)))
        docs.append((3 * i, text))
    return [*docs, (4, None), (7, ""), (10, "short")]


@pytest.mark.parametrize("hot, size", [(100_000, 100_000), (5, 200)])
def test_suffix_dedup(rows, repeated, hot, size, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", hot)
    monkeypatch.setattr(suffix_dedup, "RANGE_ROWS", size)
    docs = rows([(i, t, "x", 0) for i, t in repeated], "doc_id long, text string, gram string, n_bytes int")
    found = repeated_passages(docs).collect()
    assert {r["row"]["doc_id"]: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in found} == passages(repeated)


def test_suffix_dedup_odd_rows(rows):
    schema = "doc_id long, text string, n_chars long"
    assert without_repeats(rows([], schema)).count() == 0
    text = "".join(random.Random(4).choices("abcdefgh ", k=300))
    odd = rows([(None, text, 1), (2, text, 1), (2, text, 1), (2, "é" + text, 1), (3, None, 1)], schema)
    got = sorted((-1 if r.doc_id is None else r.doc_id, len(r.text), r.n_chars) for r in without_repeats(odd).collect())
    # All starts of document 2 count: the text behind the é starts two bytes later than in the others.
    assert got == [(-1, 0, 0), (2, 1, 1), (2, 300, 300), (2, 300, 300), (3, 0, 0)]


def test_suffix_dedup_of_many_null_ids(rows):
    pick = random.Random(11)
    sign = lambda n: "".join(pick.choices("abcdefghijklmnop ", k=n))
    passages_ = [sign(160) for _ in range(40)]
    texts = [sign(pick.randrange(0, 60)) + pick.choice(passages_) + sign(pick.randrange(0, 600)) for _ in range(2_000)]
    found = repeated_passages(rows([(None, t, i) for i, t in enumerate(texts)], "doc_id long, text string, number int")).collect()
    # All null ids are one document: of its equal passages those at the least place stay.
    least, want = {}, {}
    for t in texts:
        for s in range(len(t) - 99):
            w = t[s: s + 100]
            least[w] = min(s, least.get(w, s))
    for i, t in enumerate(texts):
        gone = bytearray(len(t))
        for s in range(len(t) - 99):
            if least[t[s: s + 100]] < s:
                gone[s: s + 100] = b"\1" * 100
        want[i] = "".join(c for c, g in zip(t, gone) if not g)
    assert {r["row"]["number"]: r.kept for r in found} == want


def test_loser_tree_merges_and_knows_prefixes():
    pick = random.Random(6)
    runs = [sorted(bytes(pick.choice(b"ab") for _ in range(pick.randrange(1, 9))) for _ in range(pick.randrange(1, 40))) for _ in range(7)]
    coded = []
    for run in runs:
        shared = suffix_dedup.common_prefixes(run)
        coded.append((shared, [s[k:] for s, k in zip(run, shared.tolist())]))
    out = list(merged(coded))
    order = [runs[r][i] for r, i, _ in out]
    assert order == sorted(s for run in runs for s in run)
    for (_, _, known), a, b in zip(out[1:], order[:-1], order[1:]):
        assert known == len(__import__("os").path.commonprefix([a, b]))


def vectors(n, d=16, seed=0):
    random_ = np.random.default_rng(seed)
    x = random_.normal(size=(n, d))
    x[n // 2:] = x[: n - n // 2] + random_.normal(size=(n - n // 2, d)) * random_.choice([0.0, 0.02, 0.2, 1], (n - n // 2, 1))
    return x


def test_neighbours_against_brute_force(rows):
    x = vectors(3000)
    data = [(i, [float(v) for v in x[i]], 1, "t") for i in range(len(x))]
    odd = [(10_000, None, 1, "t"), (10_100, [0.0] * 16, 1, "t"), (10_200, [float("nan")] * 16, 1, "t"), (10_300, [1.0, None], 1, "t"),
           (10_400, [1.0], 1, "t"), (None, [1.0] * 16, 1, "t")]
    got = {}
    for r in nearest(rows(data + odd, "vec_id long, embedding array<double>, label int, tree string")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 3000, 100))
    hits = 0
    for q, found in got.items():
        distance = np.sqrt(((x - x[q]) ** 2).sum(1))
        true = [i for i in np.lexsort((np.arange(len(x)), distance)) if i != q][:10]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(math.isclose(s, distance[i], rel_tol=1e-12, abs_tol=1e-12) for _, i, s in found)
        hits += len({i for _, i, _ in found} & set(true))
    assert hits >= 0.9 * 10 * len(got)


def test_neighbours_among_vectors_of_every_length(rows):
    data = [(i, [float(i), 1.0]) for i in range(0, 120)] + [(i, [float(i), 2.0, 3.0]) for i in range(200, 330)]
    data += [(500, [7.0]), (300, [1000.0, 2.0, 3.0])]  # one alone; a second vector of an id, the larger one
    found = {}
    for r in nearest(rows(data, "vec_id long, embedding array<double>"), k=3).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert {q: sorted(v) for q, v in found.items()} == {
        0: [(1, 1), (2, 2), (3, 3)], 100: [(1, 99), (2, 101), (3, 98)], 200: [(1, 201), (2, 202), (3, 203)],
        300: [(1, 299), (2, 301), (3, 298)]}


def test_neighbours_of_copies_and_few_rows(rows):
    schema = "vec_id long, embedding array<float>"
    assert nearest(rows([], schema)).count() == 0
    some = rows([(0, [1.0, 0.0]), (5, [1.0, 0.0]), (3, [1.0, 0.0]), (9, [0.0, 1.0]), (9, [0.0, 1.0])], schema)
    got = [(r["rank"], r.vec_id, round(r.score, 6)) for r in nearest(some).orderBy("rank").collect()]
    assert got == [(1, 3, 0.0), (2, 5, 0.0), (3, 9, round(math.sqrt(2), 6))]
    many = rows([(i, [1.0, 1.0]) for i in range(201)], schema)
    got = {}
    for r in nearest(many).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert {q: sorted(v) for q, v in got.items()} == {
        0: list(range(1, 11)), 100: list(range(10)), 200: list(range(10))}


def test_forest_leaves_and_search_agree():
    x = vectors(500)
    forest = Forest(x, 4, 3)
    leaves = forest.leaves(x)
    for i in range(0, 500, 50):
        order = list(forest.search(x[i]))
        assert sorted(order) == [(t, leaf) for t in range(3) for leaf in range(16)]
        assert set(order[:3]) == {(t, leaves[i, t]) for t in range(3)}


@pytest.mark.parametrize("task", [2000, 7])
def test_embedding_dedup(rows, task, monkeypatch):
    from fragloom.llm import embedding_dedup
    monkeypatch.setattr(embedding_dedup, "TASK_ROWS", task)
    x = vectors(600, seed=4)
    x[:40] = x[0] + np.random.default_rng(1).normal(size=(40, 16)) * 0.05
    label = [i % 3 if i > 50 else 1 for i in range(len(x))]
    data = [(i, [float(v) for v in x[i]], label[i], "d") for i in range(len(x))]
    odd = [(900, None, 1, "d"), (901, [0.0] * 16, 1, "d"), (902, [float("inf")] * 16, 1, "d"), (903, [1.0, None], 1, "d"),
           (904, data[0][1], None, "d"), (None, data[0][1], 1, "d"), (905, [1.0], 1, "d"), (906, [2.0], 1, "d")]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_copies(
        rows(data + odd, "vec_id long, embedding array<double>, label int, role string")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.98
    pairs = [(i, j) for i in range(len(x)) for j in range(i) if near[i, j] and label[i] == label[j]]
    root = reach(range(len(x)), pairs)
    counts = dict.fromkeys(range(len(x)), 0)
    for i, j in pairs:
        counts[i] += 1
        counts[j] += 1
    assert sum(got[i][0] for i in range(len(x))) >= 0.99 * 2 * len(pairs)
    assert all(got[i][0] <= counts[i] for i in range(len(x)))
    assert sum(got[i][1] == root[i] for i in range(len(x))) >= 0.99 * len(x)
    for i in (900, 901, 902, 903, 904):
        assert got[i] == (0, i, True)
    assert got[None] == (0, None, True)
    assert (got[905], got[906]) == ((1, 905, True), (1, 905, False))


def test_embedding_dedup_of_nothing(rows):
    assert near_copies(rows([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_least_collisions_holds_the_recall():
    count, p = least_collisions(), math.erf(1.5 / math.sqrt(2))
    tail = lambda c: sum(math.comb(16, k) * p**k * (1 - p) ** (16 - k) for k in range(c, 17))
    assert tail(count) >= 0.995 > tail(count + 1)


def test_a_long_uniform_text_in_small_memory():
    """Runs are written while the text is read: half a megabyte of one letter, in pieces."""
    from fragloom.llm import suffix_dedup as sd
    text = b"a" * 500_000
    places = np.arange(len(text) - 100)
    packed = [int(sd.pack(int(p), int(p), int(p))) for p in places]
    lists = pa.array([[{"packed": p, "hot": True} for p in packed]])
    batch = pa.record_batch([pa.array([1]), pa.array([2]), pa.array([sd.zstandard.compress(text)]), lists],
                            names=["doc", "key", "text", "anchors"])
    pieces = list(sd._runs(100, [])([batch]))
    assert len(pieces) >= 4
    sent = sum(np.frombuffer(b, np.int64).size for p in pieces for b, n in zip(p["packed"].to_pylist(), p["part"].to_pylist()) if n >= 0)
    assert sent <= 2 * len(packed)


def test_repeats_inside_one_long_text(rows):
    """Passages of a text of megabytes, beyond the stretch that anchors are looked for in."""
    pick = random.Random(12)
    words = ["".join(pick.choice("abcdefghij") for _ in range(8)) for _ in range(40_000)]
    unique = " ".join(pick.choice(words) + str(i) for i in range(330_000))
    passage = " ".join(f"planted{i}" for i in range(30))
    text = unique[:2_000_000] + passage + unique[2_000_000:] + passage
    assert len(text) > 4_500_000
    got = repeated_passages(rows([(1, text), (2, "short " + passage)], "doc_id long, text string")).collect()
    found = {r.row.doc_id: r for r in got}
    for i, own in ((1, text), (2, "short " + passage)):
        last = own.encode().rfind(passage.encode())
        spans = [(s.first, s.last) for s in found[i].spans]
        assert any(a <= last and b >= last + len(passage) for a, b in spans)
        assert found[i].n_removed < len(passage) + 30


def test_join_of_long_texts(rows):
    pick = random.Random(13)
    words = [f"w{pick.randrange(10**6)}" for _ in range(30_000)]
    other = [*words[:29_000], *(f"x{i}" for i in range(1_000))]
    far = [*words[:15_000], *(f"y{i}" for i in range(15_000))]
    docs = [(i, " ".join(t)) for i, t in enumerate((words, other, far))]
    got = {r.doc_id: r.component_id for r in jaccard_join(rows(docs, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 2}


def test_stretches_are_joined_without_a_change_of_starts():
    from fragloom.llm.suffix_dedup import joined_stretches
    pick = np.random.default_rng(3)
    key, first = pick.integers(-5, 5, 400), pick.integers(0, 3000, 400)
    last = first + pick.integers(0, 12, 400)
    found = joined_stretches(key, first, last)
    starts = lambda rows: {(k, s) for k, a, b in zip(*rows) for s in range(a, b + 1)}
    assert starts([c.tolist() for c in found]) == starts([c.tolist() for c in (key, first, last)])
    assert all(k != m or b + 1 < c for k, b, m, c in zip(found[0], found[2], found[0][1:], found[1][1:]))
    assert [len(c) for c in joined_stretches(*[np.zeros(0, np.int64)] * 3)] == [0, 0, 0]
