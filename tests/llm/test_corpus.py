"""Mixing, chat formatting, classifiers, queries and the pipeline."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from fragloom.llm import mixing
from fragloom.llm.chat import conversation_digests, fold_events, format_conversations, read_back
from fragloom.llm.labelled import logistic
from fragloom.llm.mixing import mix, mixed_documents
from fragloom.llm.quality import quality_scores, without_bad
from fragloom.llm.toxicity import Network, toxicity_scores, word_rows
from fragloom.llm.words import utf8

SF = "/root/testdata/sf0.001"


def targets(size, weights=(1, 2, 3), cap=3):
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    out, open_ = {}, set(names)
    while open_:
        rest = sum(size.values()) - sum(out.values())
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] > cap * size[s] * total]
        if not over:
            return out | {s: rest * weight[s] / total for s in open_}
        out |= {s: cap * size[s] for s in over}
        open_ -= set(over)
    return out


@pytest.mark.parametrize("stratum", [20_000, 3])
def test_mix(rows, stratum, monkeypatch):
    monkeypatch.setattr(mixing, "STRATUM_ROWS", stratum)
    pick = random.Random(2)
    sources = ["b", "a", "é", "zz", None, "tiny", "B"]
    data = [(i, " ".join(["w"] * pick.choice([0, 1, 1, 1, 5, 30, 200, 900])) + pick.choice(["", " \n"]), pick.choice(sources[:5]), "k")
            for i in range(400)]
    data += [(1000, "x y", "tiny", "k"), (1001, None, "B", "k"), (None, "x y z", "a", "k"), (1002, "q", "a", "k"), (1002, "q", "a", "k")]
    docs = rows(data, "doc_id long, text string, source string, key string")
    got = mix(docs).collect()
    assert len(got) == len(data)
    size = {}
    for _, text, source, _ in data:
        size[source] = size.get(source, 0) + len(re.findall(r"[^ \t-\r]+", text or ""))
    want = targets(size)
    taken = dict.fromkeys(size, 0)
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= 2, s  # every source but two has documents of one word
    assert sorted(map(str, got)) == sorted(map(str, mix(docs.repartition(5)).collect()))
    # Larger documents are tilted one way within a source.
    up = [r for r in got if r.source == "é" and r["size"]]
    means = [np.mean([r.copies for r in up if r["size"] == z]) for z in (30, 900)]
    assert (means[0] <= means[1]) == (want["é"] >= size["é"])
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    counts = {}
    for r in mixed.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    for r in got:
        if r.doc_id != 1002:
            assert counts.get(r.doc_id, 0) == (r.copies if r["size"] else 1)


def test_rows_of_one_id_keep_their_own_copies(rows):
    data = [(None, f"{i} b c", "a") for i in range(37)] + [(7, f"{i} x", "b") for i in range(11)] + [(8, "y z", "b")] * 3 + [
        (i, " ".join(["w"] * 3), "c") for i in range(100, 160)]
    docs = rows(data, "doc_id long, text string, source string")
    want = {}
    for r in mix(docs).collect():
        want[r.source, r["size"]] = want.get((r.source, r["size"]), 0) + r.copies
    got = {}
    for r in mixed_documents(docs).collect():
        key = r.source, len(r.text.split())
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in want.items() if n}
    assert any(n % sum((s, len(t.split())) == k for _, t, s in data) for k, n in want.items() if k[0] != "c")


def test_mix_of_nothing(rows):
    schema = "doc_id long, text string, source string"
    assert mix(rows([], schema)).count() == mixed_documents(rows([], schema)).count() == 0
    assert [(r["size"], r.target, r.taken) for r in mix(rows([(1, None, None)], schema)).collect()] == [(0, 0.0, 0)]


def test_chat_events_are_folded(rows):
    events = [
        (1, 1, 0, "start", "user", None), (1, 3, 0, "delta", None, "lo"), (1, 2, 0, "delta", None, "hel"),
        (1, 4, 1, "start", "assistant", ""), (1, 5, 1, "delta", None, "draft"), (1, 6, 2, "start", "user", "gone"),
        (1, 7, 1, "regenerate", None, None), (1, 8, 1, "delta", None, "an"), (1, 9, 1, "delta", None, "swer"),
        (1, 10, 3, "start", "user", "a"), (1, 11, 3, "edit", None, "b"), (1, 12, 3, "delta", None, "c"),
        (2, 1, 0, "delta", None, "<|im_end|>\\<|"), (2, 2, 0, "start", "a\nb<\\-", "x"), (None, 1, 0, "start", "user", "n")]
    table = rows(events, "conv_id long, seq long, message long, kind string, role string, text string")
    got = {(r.conv_id, r.message): (r.role, r.text) for r in fold_events(table).collect()}
    assert got == {(1, 0): ("user", "hello"), (1, 1): ("assistant", "answer"), (1, 3): ("user", "bc"),
                   (2, 0): ("a\nb<\\-", "<|im_end|>\\<|x"), (None, 0): ("user", "n")}
    back = {r.conv_id: r for r in read_back(format_conversations(table)).collect()}
    assert [tuple(t) for t in back[1].turns] == [("user", "hello"), ("assistant", "answer"), ("user", "bc")]
    assert [tuple(t) for t in back[2].turns] == [("a\nb<\\-", "<|im_end|>\\<|x")]
    assert (back[1].loss_text, back[2].loss_text) == ("answer", "")
    with pytest.raises(Exception, match="unknown event kind"):
        fold_events(rows([(1, 1, 0, "what", "user", "x")], table.schema)).collect()
    assert format_conversations(rows([], table.schema)).count() == 0


def test_chat_digests(rows):
    pick = random.Random(4)
    signs = ["<|", "|>", "<|im_end|>", "<|im_start|>", "\\", "\n", "é", "😀", "assistant", "<\\-", "\\\\|", " "]
    data = [(c, t, pick.choice(["user", "assistant", "system"]), pick.choice([None, "", "".join(pick.choice(signs) for _ in range(9))]))
            for c in range(30) for t in range(pick.randrange(1, 7))]
    data += [(99, i, "assistant", "x" * 50) for i in range(300)]
    table = rows([(*r, 7) for r in data], "conv_id long, turn long, role string, text string, seq long")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in conversation_digests(table).collect():
        own = sorted((t, role, text or "") for c, t, role, text in data if c == r.conv_id)
        loss = "".join(text for _, role, text in own if role == "assistant")
        assert r.n_turns == len(own)
        assert r.turns_sha256 == sha("".join(f"{role}\n{text}\n" for _, role, text in own))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


@pytest.mark.parametrize("name", ["op3_mixing", "op6_chat_formatting"])
def test_native_plans_have_no_python(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian", plan)


def labelled(rows, n=400):
    pick = random.Random(9)
    words = ["ba", "ce", "dilo", "fa", "gory", "hun", "ike", "jo", "kala"]
    docs, labels = [], []
    for i in range(n):
        toxic, bad = i % 5 == 0, i % 3 == 0
        text = [pick.choice(words) for _ in range(pick.randrange(30, 200))]
        if bad:
            text = [w.upper() + "!!%%" for w in text]
        for _ in range(3 * toxic):
            text[pick.randrange(len(text))] = pick.choice(["zonk", "zonker", "Zonkish,"])
        docs.append((i, " ".join(text), "en", i % 7, "s"))
        if i % 4:
            labels.append((i, int(not bad), int(toxic), 0.5))
    docs += [(1000, None, None, 1, "s"), (1001, "", "de", 1, "s"), (None, "ba ce", "en", 1, "s"), (1002, "ba " * 40_000, "en", 1, "s"), (3, docs[3][1], "en", 1, "s")]
    labels += [(1000, None, None, 0.5), (None, 1, 1, 0.5), (1, 1, 0, 0.5)]
    return (rows(docs, "doc_id long, text string, lang string, held_out int, row string"),
            rows(labels, "doc_id long, quality int, toxic int, score double"))


@pytest.mark.parametrize("score, mod, out, label", [(quality_scores, 5, 0, "quality"), (toxicity_scores, 4, 2, "toxic")])
def test_classifiers(rows, score, mod, out, label):
    docs, labels = labelled(rows)
    found = score(docs, labels)
    if "row" in found.columns:
        found = found.selectExpr("row.doc_id", "held_out", "score", "predicted")
    got = found.collect()
    assert len(got) == docs.count()
    right = total = 0
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == out)
            if r.held_out and r.doc_id < 400:
                truth = int(r.doc_id % 3 != 0) if label == "quality" else int(r.doc_id % 5 == 0)
                right, total = right + (truth == r.predicted), total + 1
    assert total > 50 and right >= 0.9 * total
    assert sorted(map(str, got)) == sorted(map(str, found.collect()))


def test_classifiers_without_labels(rows):
    docs, labels = labelled(rows)
    for score in (quality_scores, toxicity_scores):
        scores = {r.score for r in score(docs, labels.limit(0)).collect()}
        assert len(scores) >= 1 and all(0 <= s <= 1 for s in scores)
        assert score(docs.limit(0), labels).count() == 0
    kept = without_bad(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_held_out_labels_are_not_learned(rows):
    docs, labels = labelled(rows)
    turned = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - quality ELSE quality END quality",
        "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - toxic ELSE toxic END toxic")
    for score in (quality_scores, toxicity_scores):
        assert sorted(r.score for r in score(docs, labels).collect()) == sorted(r.score for r in score(docs, turned).collect())


def test_network_pools_like_a_loop():
    texts = pa.array(["a b c", "", "d", "a b c d e f g", None, "x y"])
    network = Network()
    network.table[:] = np.random.default_rng(3).normal(size=network.table.shape)
    rows_, of = word_rows(*utf8(texts))
    x = network.responses(rows_)
    best, where = network.pooled(x, of, True)
    again, _ = network.pooled(x, of)
    assert np.allclose(best, again)
    for t in range(len(texts)):
        own = np.concatenate([x[of[t]: of[t + 1]], np.zeros((3, x.shape[1]))])
        for k, filters in enumerate(network.filters):
            for f in range(filters.shape[2]):
                value = max([0.0, *(sum(own[i + j] @ filters[j, :, f] for j in range(len(filters))) for i in range(of[t + 1] - of[t]))])
                assert best[t, k * filters.shape[2] + f] == pytest.approx(value, rel=1e-4, abs=1e-4)


def test_logistic_finds_the_curve():
    x = np.random.default_rng(0).normal(size=4000)
    y = (np.random.default_rng(1).random(4000) < 1 / (1 + np.exp(-(3 * x - 1)))).astype(int)
    slope, offset = logistic(x, y)
    assert slope == pytest.approx(3, abs=0.4) and offset == pytest.approx(-1, abs=0.3)
    assert logistic(np.zeros(0), np.zeros(0, int)) == (0.0, 0.0)


@pytest.mark.parametrize("name", [n for n in entry.queries() if re.match(r"op\d+_", n)])
def test_query(spark, name):
    found = entry.queries()[name](spark, SF)
    table = "conversations" if "chat" in name else "embeddings" if name in ("op1_nearest_neighbours", "op4_embedding_near_dedup") else "documents"
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    want = {"op1_nearest_neighbours": 50, "op6_chat_formatting": None, "op12_best_fit_packing": None, "op13_ranked_search": 800}.get(name, n)
    assert want is None or found.count() == want


def test_quality_equals_a_loop_over_blocks(rows):
    """Sizes and scores from one-shot compressors, block by block, with the same dictionaries."""
    import math

    import zstandard
    from fragloom.llm import quality
    pick = random.Random(6)
    good, bad = ([" ".join(pick.choices(words, k=60)) for _ in range(60)] for words in (
        ["calm", "river", "under", "the", "old", "bridge"], ["click", "free", "win", "$$$", "now", "http"]))
    texts = [t for pair in zip(good, bad) for t in pair]
    dictionaries, slope, offset = quality.fit(pa.array(texts), np.array([1, 0] * 60))
    asked = [None, "", "x", "calm river win now", good[0] * 9, "é" * 700, *texts[:20]]
    got = next(quality._score(type("Shared", (), {"value": (dictionaries, slope, offset)}))(
        [pa.record_batch([pa.array(asked)], names=["text"])]))["score"].to_pylist()
    for text, score in zip(asked, got):
        data, sizes = (text or "").encode(), []
        for content, trained in dictionaries:
            kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
            held = zstandard.ZstdCompressionDict(content, dict_type=kind)
            total = 0
            for at in range(0, len(data), 512):
                press = zstandard.ZstdCompressor(3, dict_data=held, write_content_size=False, write_dict_id=False)
                total += len(press.compress(data[at: at + 512]))
            sizes.append(total)
        x = (sizes[0] - sizes[1]) / max(1, len(data))
        assert score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, slope * x + offset)))), abs=1e-9)
    assert got[asked.index(good[0])] > 0.5 > got[asked.index(bad[0])]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before, docs = docs, spark.createDataFrame(stage(spark, docs, SF).toArrow())
        assert docs.columns == columns
        if k < 2:
            assert 0 < docs.count() < before.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() > 0
    assert set(last.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert all(stage(spark, docs.limit(0), SF).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_pipeline_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def plain_near_copies(docs, k=5, part=80, whole=100):
    """Ids of documents that are the smallest of their component."""
    sets = {}
    for r in docs:
        words = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]+", lambda m: m[0].lower(), r.text or ""))
        sets[r.doc_id] = {tuple(words[i: i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            same = len(sets[a] & sets[b])
            if same and whole * same >= part * (len(sets[a]) + len(sets[b]) - same):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i for i in ids if find(i) == i}


def plain_repeats(docs, length=100):
    """The text left of each document."""
    first, out = {}, {}
    for i, text in sorted((r.doc_id, r.text or "") for r in docs):
        data = text.encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if first.setdefault(data[at: at + length], (i, at)) != (i, at):
                gone[at: at + length] = b"\1" * length
        out[i] = bytes(b for b, g in zip(data, gone) if not g).decode("utf-8", "ignore")
    return out


def test_pipeline_stages_against_brute_force(spark):
    """Every stage on what the stage before it kept, row by row."""
    import public_tokenizers
    from collections import Counter
    from tokenizers import Tokenizer
    stages = [f for _, f in corpus_pipeline.STAGES]
    start = spark.read.parquet(f"{SF}/documents.parquet")
    kept = spark.createDataFrame(stages[0](spark, start, SF).toArrow())
    rows_ = kept.collect()
    assert set(map(tuple, rows_)) <= set(map(tuple, start.collect()))
    apart = spark.createDataFrame(stages[1](spark, kept, SF).toArrow())
    want = plain_near_copies(rows_)
    assert sorted(map(tuple, apart.collect())) == sorted(tuple(r) for r in rows_ if r.doc_id in want)
    cleaned = spark.createDataFrame(stages[2](spark, apart, SF).toArrow())
    want = plain_repeats(apart.collect())
    before = {r.doc_id: r for r in apart.collect()}
    got = {r.doc_id: r for r in cleaned.collect()}
    assert {i: r.text for i, r in got.items()} == want and any(r.text != (before[i].text or "") for i, r in got.items())
    assert all((r.lang, r.source, r.n_chars) == (before[i].lang, before[i].source, len(r.text)) for i, r in got.items())
    mixed = spark.createDataFrame(stages[3](spark, cleaned, SF).toArrow())
    copies = Counter(map(tuple, mixed.collect()))
    assert set(copies) <= set(map(tuple, got.values())) and max(copies.values()) <= 3
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in got.values()}
    size, taken = Counter(), Counter()
    for r in got.values():
        size[r.source] += words[r.doc_id]
    for row, n in copies.items():
        taken[row[mixed.columns.index("source")]] += n * words[row[mixed.columns.index("doc_id")]]
    for source, aim in targets(dict(size)).items():
        assert abs(taken[source] - aim) <= max(words[i] for i, r in got.items() if r.source == source)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in mixed.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()] += 1
    last = stages[4](spark, mixed, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert Counter(map(tuple, last.collect())) == want
