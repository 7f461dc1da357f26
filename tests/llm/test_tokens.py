"""Pre-tokens, merges, lexicon, encoding and counts against the public library."""

import hashlib
import random
import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fragloom.llm import encoding, words
from fragloom.llm.bpe import Cache, Vocabulary
from fragloom.llm.encoding import decode, encode, encoded_digests
from fragloom.llm.lexicon import Lexicon
from fragloom.llm.token_counts import WholeTokens, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["'", "s", "t", "re", "ve", "ll", "'s", "d", "m", " ", "  ", "\n", "\t", "a", "B", "é", "1", "23", "!", "..",
         "<|endoftext|>", "<|endof", "text|>", " ", "中文", "😀", "　", "aaaaaa", "'S", "'re", "'llx", "the", "tion"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(5)
    made = ["".join(pick.choice(PARTS) for _ in range(pick.randrange(0, 30))) for _ in range(3000)]
    return [None, "", "x" * 70_000, " " * 5000, *made]


def test_encoding_and_counts(rows, library, texts):
    docs = rows([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    got = {r.doc_id: r for r in encoded_digests(docs, PATH).collect()}
    counted = {r.doc_id: r for r in token_counts(docs, PATH, 20).collect()}
    assert len(got) == len(counted) == len(texts)
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(back))
        assert (counted[i].n_tokens, counted[i].n_bytes) == (len(ids), len((text or "").encode()))
        assert counted[i].over_limit == (len(ids) > 20)


def test_empty_repeated_and_null_rows(rows):
    schema = "doc_id long, text string, decoded string"
    empty = rows([], schema)
    assert encoded_digests(empty, PATH).count() == token_counts(empty, PATH).count() == 0
    some = rows([(None, "a b", "x"), (3, "a b", "x"), (3, "a b", "y")], schema)
    assert sorted(r.n_tokens for r in token_counts(some, PATH).collect()) == [2, 2, 2]
    back = decode(encode(some, PATH), PATH)
    assert [r.decoded for r in back.collect()] == ["a b"] * 3


def test_lexicon_size_changes_nothing(rows, texts):
    docs = rows([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = sorted((r.doc_id, r.ids) for r in encode(docs, PATH).collect())
    assert want == sorted((r.doc_id, r.ids) for r in encode(docs, PATH, 5).collect())


def test_lexicon_is_minimal_and_numbers_words():
    pick = random.Random(1)
    words = sorted({bytes(pick.choice(b"abc") for _ in range(pick.randrange(1, 7))) for _ in range(200)})
    lexicon = Lexicon(words)
    absent = [b"", b"zzz", b"a" * 9, b"abd"]
    data = b"".join([*words, *absent])
    ends = np.cumsum([len(w) for w in [*words, *absent]])
    found = lexicon.find(np.frombuffer(data, np.uint8), ends - [len(w) for w in [*words, *absent]], ends)
    assert found.tolist() == [*range(len(words)), *[-1] * len(absent)]
    tails = {w[i:] for w in words for i in range(len(w) + 1)}
    continuations = {frozenset(w[len(p):] for w in words if w.startswith(p)) for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert len(lexicon.final) - 1 == len(continuations) <= len(tails) + 1
    mapped = Lexicon.mapped(lexicon.tables(), lexicon.longest)
    assert (mapped.find(np.frombuffer(data, np.uint8), ends - [len(w) for w in [*words, *absent]], ends) == found).all()


def test_whole_tokens_are_proved_by_the_library(library):
    vocabulary = Vocabulary(PATH)
    whole = WholeTokens(vocabulary)
    assert len(whole.proved) > 40_000
    for s in random.Random(2).sample(whole.proved, 2000):
        try:
            text = s.decode()
        except UnicodeDecodeError:
            continue
        if len(library.pre_tokenizer.pre_tokenize_str(text)) == 1:
            assert len(library.encode(text, add_special_tokens=False).ids) == 1
    strings = [b"the", b" of", b"qzqzqz", b"x" * 16, b"x" * 17, b""]
    ends = np.cumsum([len(s) for s in strings])
    starts = ends - [len(s) for s in strings]
    match = whole.match(np.frombuffer(b"".join(strings), np.uint8), starts, ends - starts)
    assert match.tolist() == [s in set(whole.proved) and len(s) <= 16 for s in strings]


def test_merges_of_many_words_are_those_of_single_words(library):
    vocabulary = Vocabulary(PATH)
    pick = random.Random(3)
    words = [bytes(pick.choice(b"etaoinshrdlu aa") for _ in range(pick.randrange(1, 30))).strip() or b"a" for _ in range(500)]
    words = [w.replace(b" ", b"") or b"e" for w in words]
    ids, bounds = vocabulary.encode(words)
    for w, a, b in zip(words, bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == library.encode(w.decode(), add_special_tokens=False).ids
    cache = Cache(vocabulary, 3)
    for w in words[:20]:
        slot = cache.slots([w])[0]
        assert cache.ids[cache.bounds[slot]: cache.bounds[slot + 1]].tolist() == library.encode(w.decode(), add_special_tokens=False).ids


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_memory_goes_back_after_the_encoder_is_gone(monkeypatch):
    class Held:
        def encode(self, data, bounds):
            return np.zeros(0, np.int32), bounds * 0

    made, alive = [], []

    def build(**_):
        made.append(weakref.ref(held := Held()))
        return held

    monkeypatch.setattr(encoding, "_Encoder", build)
    for module in (encoding, words):
        monkeypatch.setattr(module, "released", lambda: alive.append(made[0]() is not None), raising=False)
    batch = pa.record_batch([pa.array([1]), pa.array(["a b"])], names=["doc_id", "text"])
    shared = type("Shared", (), {"value": {}})
    assert sum(b.num_rows for b in encoding._encode(shared)(iter([batch]))) == 1
    assert alive == [False]


def test_encoding_and_decoding_share_no_task(spark):
    """Two Python steps in one task are two workers, whose memory an executor holds at the same time."""
    from fragloom.llm.encoding import encoded_digests
    docs = spark.createDataFrame([(1, "one two"), (2, None), (2, "")], "doc_id long, text string")
    done = encoded_digests(docs, public_tokenizers.path("byte_bpe_50k.json"), apart=True)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert sorted(done.collect()) == sorted(encoded_digests(docs, public_tokenizers.path("byte_bpe_50k.json")).collect())
    assert sorted((r["doc_id"], r["n_tokens"] > 0) for r in done.collect()) == [(1, True), (2, False), (2, False)]


def test_readers_hold_few_texts_and_lists_at_once(spark):
    """A batch of 4,096 rows of ids is one array of tens of megabytes for each task of an executor."""
    from fragloom.llm.words import small_batches
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "4096")
        small_batches(spark)
        assert spark.conf.get(name) == "256"
        spark.conf.set(name, "64")
        small_batches(spark)
        assert spark.conf.get(name) == "64"
    finally:
        spark.conf.set(name, before)
