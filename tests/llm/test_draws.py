"""Importance resampling, packing and ranked search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fragloom.llm import packing, ranked_search as search, resampling
from fragloom.llm.bpe import Vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " \n\t ", "...", "Ünï çode Wörter ABC", "a b c", "A B C a\x00b 1-2_3", "日本 語 " * 30, "x" * 5000]


def texts(n, seed):
    pick = random.Random(seed)
    words = [w + str(i) for i, w in enumerate(["the", "Of", "ñandú", "x", "Straße", "a", "b", "and", "zoo", "mimi"] * 8)]
    made = [" ".join(pick.choices(words, k=pick.randrange(1, 70))) + pick.choice(["", ".", " <|endoftext|>", "'s  "]) for _ in range(n)]
    return [*ODD, *made, *made[: n // 4]]


@pytest.fixture(scope="module")
def docs(rows):
    every = [(i, t, "clash", 1) for i, t in enumerate(texts(240, 3))]
    every += [(None, t, "clash", 2) for t in ("the zoo the zoo " * 10, "no id " * 30)]
    every += [(7, "one id two rows and twenty words " * 5, "clash", 3)] * 3
    return rows(every, "doc_id long, text string, rank string, score int")


@pytest.fixture(scope="module")
def items(rows):
    return rows([(i, t) for i, t in enumerate(texts(12, 9))] + [(None, "zoo the"), (3, "zoo"), (99, "unheard")], "item_id long, text string")


# Importance resampling


def plain_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_features(text, longest):
    words = plain_words(text)
    return [" ".join(words[i: i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def plain_scores(docs, target, percent, longest, buckets=10_000):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    s = Counter(bucket(f) for _, t in docs for f in plain_features(t, longest))
    t = Counter(bucket(f) for x in target for f in plain_features(x, longest))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in docs:
        features = [bucket(f) for f in plain_features(text, longest)]
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in features]
        weight = sum(gains) // len(gains) if gains else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(features), weight, score, len(plain_words(text)) >= 20 and i is not None))
    chosen = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0], x[1], x[2]))
    ranks = {}
    for place, x in enumerate(chosen[: len(chosen) * percent // 100], 1):
        ranks.setdefault(x, []).append(place)
    return Counter((*x[:4], ranks[x].pop(0) if ranks.get(x) else None) for x in out)


@pytest.mark.parametrize("longest, percent", [(1, 10), (3, 50), (2, 100)])
def test_importance_scores(docs, items, longest, percent):
    got = resampling.importance_scores(docs, items, percent, 20, longest)
    want = plain_scores([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in items.collect()], percent, longest)
    assert Counter(map(tuple, got.collect())) == want


def test_resampled_rows(docs, items):
    ranks = resampling.importance_scores(docs, items, 30).filter("rank IS NOT NULL").collect()
    drawn = resampling.resampled(docs, items, 30)
    assert drawn.columns == docs.columns
    ids = Counter(r.doc_id for r in drawn.collect())
    assert set(ids) == {r.doc_id for r in ranks}
    assert all(ids[i] >= n for i, n in Counter(r.doc_id for r in ranks).items())


def test_long_texts_are_cut_between_words(monkeypatch):
    made = texts(40, 4)
    array = pa.array(made)
    whole = resampling.feature_buckets(array, 1, 997)
    monkeypatch.setattr(resampling, "SEGMENT", 60)
    parts = resampling.feature_buckets(array, 1, 997)
    assert len(resampling._segments(array)[0]) > len(made)
    assert [x.tolist() for x in whole] == [x.tolist() for x in parts]


def test_resampling_of_empty_tables(docs, rows):
    none = rows([], "doc_id long, text string")
    assert resampling.importance_scores(none, none).count() == 0
    assert resampling.resampled(none, docs).count() == 0
    alone = resampling.importance_scores(docs, none, 100)
    assert alone.count() == docs.count()
    assert resampling.gains(np.zeros(4, np.int64), np.zeros(4, np.int64)).tolist() == [0, 0, 0, 0]


# Packing


def least_sequences(lengths, capacity):
    """A lower bound: pieces over half a sequence never share one, small ones fill what these leave."""
    found = 0
    for a in range(capacity // 2 + 1):
        big = sum(x > capacity - a for x in lengths)
        half = [x for x in lengths if capacity / 2 < x <= capacity - a]
        small = sum(x for x in lengths if a <= x <= capacity / 2)
        found = max(found, big + len(half) + max(0, -(-(small - len(half) * capacity + sum(half)) // capacity)))
    return found


def check_packing(docs, packed, capacity):
    """Every document is whole, every sequence gapless and within the capacity."""
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for r in docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        n = -(-len(ids) // capacity)
        cuts = [0, *(len(ids) - capacity * (n - 1 - i) for i in range(n))]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r.doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= capacity
    assert len(sequences) <= least_sequences([r.length for r in packed], capacity) + 1


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_packing(docs, capacity):
    packed = packing.packed_pieces(docs.repartition(5), PATH, capacity).collect()
    check_packing(docs, packed, capacity)


def test_fewest_sequences():
    pick = random.Random(1)
    for _ in range(60):
        capacity = pick.randrange(5, 25)
        pieces = [pick.randrange(1, capacity + 1) for _ in range(pick.randrange(1, 9))]
        found = packing.combinations(dict(Counter(pieces)), capacity)
        assert Counter(x for taken, times in found for x, n in taken.items() for _ in range(n * times)) == Counter(pieces)
        assert all(sum(x * n for x, n in taken.items()) <= capacity for taken, _ in found)
        first = found[0][0]
        rest = Counter(pieces) - Counter([max(pieces)])
        sums = {0}
        for x in rest.elements():
            sums |= {s + x for s in sums if s + x + max(pieces) <= capacity}
        assert sum(x * n for x, n in first.items()) == max(pieces) + max(sums)


def test_one_length_for_a_third_of_all_rows(rows):
    many = rows([(i, "the same text" if i % 3 else f"{i} " * (i % 50)) for i in range(900)], "doc_id long, text string")
    check_packing(many, packing.packed_pieces(many.repartition(6), PATH, 32).collect(), 32)


def test_training_sequences(docs):
    made = packing.training_sequences(docs, PATH, 64).collect()
    packed = packing.packed_pieces(docs, PATH, 64, with_ids=True).collect()
    assert sum(len(r.ids) for r in made) == sum(r.length for r in packed)
    assert all(len(r.ids) <= 64 and [p.offset for p in r.parts] == sorted(p.offset for p in r.parts) for r in made)
    ids = Counter((r.doc_id, r.piece, tuple(r.ids)) for r in packed)
    assert Counter((p.doc_id, p.piece, tuple(r.ids[p.offset: p.offset + p.length])) for r in made for p in r.parts) == ids


def test_packing_of_an_empty_table(rows):
    assert packing.packed_pieces(rows([], "doc_id long, text string"), PATH).count() == 0


def test_long_texts_are_cut_where_words_begin():
    library, encoder = Tokenizer.from_file(PATH), packing.Encoder(Vocabulary(PATH))
    pick = random.Random(2)
    long = " ".join(pick.choice(["word", "it's", "x1", " ", "ñ", "<|endoftext|>", "\n"]) for _ in range(90_000))
    made = ["", long, "y" * 3000, None, "", "short text", long[:150_000]]
    data, bounds = packing.utf8(pa.array(made))
    cut = packing.with_cuts(data, bounds, 100_000)
    assert len(cut) > len(bounds)
    old = packing.with_cuts
    packing.with_cuts = lambda d, b: old(d, b, 100_000)
    try:
        ids, of = encoder.encode(pa.array(made))
    finally:
        packing.with_cuts = old
    for i, text in enumerate(made):
        assert ids[of[i]: of[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids


# Ranked search


def plain_search(docs, items, k):
    def terms(text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    documents, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = Counter()
    for item, text in items:
        asked, found = Counter(terms(text)), []
        for i, c in counted:
            m = 75 + 25 * sum(c.values()) * documents // total
            score = sum(
                n * math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                for t, n in asked.items() if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(found)[:k], 1):
            out[item, rank, i, -score] += 1
    return out


@pytest.mark.parametrize("cells, block_terms, posting", [(1 << 23, 4096, 64), (2_000, 4096, 4), (4_000, 25, 3)])
def test_ranked_search(docs, items, monkeypatch, cells, block_terms, posting):
    from pyspark import cloudpickle
    monkeypatch.setattr(search, "SHARD_CELLS", cells)
    monkeypatch.setattr(search, "POSTING_BLOCK", posting)
    monkeypatch.setattr(search.query_blocks, "__defaults__", (block_terms,))
    cloudpickle.register_pickle_by_value(search)  # the changed sizes reach the tasks
    try:
        got = search.ranked_search(docs.repartition(3), items, 5).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(search)
    want = plain_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 5)
    assert Counter((r.item_id, r.rank, r.doc_id, r.score) for r in got) == want


def shard_of(n, size, seed):
    pick = np.random.default_rng(seed)
    rows = [np.sort(pick.choice(size, pick.integers(0, 20), replace=False)) for _ in range(n)]
    terms = np.concatenate(rows).astype(np.int64)
    of = np.append(0, np.cumsum([len(r) for r in rows]))
    tfs = pick.integers(1, 6, len(terms))
    n_terms = np.add.reduceat(np.append(tfs, 0), of[:-1]) + 1
    spread = np.where(pick.random((size, 16)) < 0.5, 1, -1).astype(np.float32)
    return search.Shard(np.arange(n), n_terms, of, terms, tfs, n, int(n_terms.sum()), size, spread)


def test_summaries_bound_every_document_of_their_block():
    shard = shard_of(700, 90, 5)
    posted = Counter(shard.posted.tolist())
    assert posted == Counter(np.repeat(np.arange(700), (shard.table > 0).sum(axis=1)).tolist())
    for i, (a, b) in enumerate(zip(shard.starts, shard.starts[1:])):
        assert 0 < b - a <= search.POSTING_BLOCK
        exact = shard.table[shard.posted[a:b]].max(axis=0)
        assert (shard.summary[i].astype(int) * search.UNIT >= exact).all()
        assert (shard.summary[i].astype(int) * search.UNIT - exact < search.UNIT).all()


def test_blocks_are_skipped_and_nothing_is_lost():
    shard = shard_of(3000, 60, 6)
    pick = np.random.default_rng(1)
    skipped = 0
    for _ in range(40):
        terms = np.sort(pick.choice(60, 4, replace=False))
        weight = pick.integers(1, 9000, 4)
        rows, scores = shard.search(terms, weight, 10, 1)
        every = shard.table[:, terms].astype(np.int64) @ weight
        least = np.sort(every)[-10]
        assert set(np.flatnonzero(every >= max(least, 1))) <= set(rows.tolist())
        assert (every[rows] == scores).all()
        rows, _ = shard.search(terms, weight, 10, int(every.max()) + 1)
        skipped += len(rows) == 0
    assert skipped == 40


def test_norms_beyond_64_bits():
    n = np.array([10**9, 1], np.int64)
    assert search._norms(n, 10**12, 10**14).tolist() == [75 + 25 * 10**9 * 10**12 // 10**14, 75]


def test_search_of_empty_tables(docs, items, rows):
    none = rows([], "doc_id long, text string")
    assert search.ranked_search(none, items).count() == 0
    assert search.ranked_search(docs, rows([], "item_id long, text string")).count() == 0
    assert search.ranked_search(docs, rows([(1, None), (2, "...")], "item_id long, text string")).count() == 0
