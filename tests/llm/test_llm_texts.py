import base64
import gc
import hashlib
import random
import time
import tracemalloc

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_tables import awkward, documents  # noqa: F401
from reference_forms import base_scores, contamination, fold

from tidelog.llm import bpe, decontaminate, language_model, token_counts, toxicity

PATH = public_tokenizers.path(bpe.RANKS)


@pytest.fixture(scope="module")
def encoding():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH, public_tokenizers.PATTERN)


def packed(encoding, text):
    return np.array(encoding.encode_ordinary(text or ""), "<u4").tobytes()


def test_bpe_round_trip(spark, awkward, documents, encoding):
    docs = awkward.select("doc_id", "text", "n").union(documents.selectExpr("doc_id", "text", "1 AS n"))
    given_ = docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, len(packed(encoding, r.text)) // 4, packed(encoding, r.text), (r.text or "").encode()) for r in given_), key=repr)
    coded = bpe.encode(docs, ["doc_id"], decode_too=True)
    got = [(r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in coded.collect()]
    assert sorted(got, key=repr) == want
    again = bpe.decode(coded, ["doc_id"]).collect()
    assert sorted((r.doc_id, bytes(r.decoded)) for r in again if r.doc_id) == sorted((w[0], w[3]) for w in want if w[0])


def test_bpe_gives_its_memory_back(spark, documents):
    """With `spare` no Python worker keeps the codec after its task; ids are the same."""
    never = public_tokenizers.PATTERN + "|(?!)"

    def left(batches):
        for _ in batches:
            held = sum(isinstance(x, bpe.Codec) and x.pattern.pattern.endswith("|(?!)") for x in gc.get_objects())
            yield pa.RecordBatch.from_arrays([pa.array([held])], ["n"])

    docs = documents.select("doc_id", "text").repartition(8)
    workers = spark.range(0, 32, 1, 16).mapInArrow(left, "n long")
    found = {}
    for spare in (True, False):
        coded = bpe.encode(docs, ["doc_id"], pattern=never, decode_too=True, spare=spare)
        found[spare] = sorted(coded.collect()), workers.agg({"n": "max"}).first()[0]
    assert found[True][0] == found[False][0]
    assert (found[True][1], found[False][1]) == (0, 1)


def test_bpe_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(none, ["doc_id"], decode_too=True).collect() == []
    assert [bytes(r.decoded) for r in bpe.decode(spark.sql("SELECT 1 AS doc_id, CAST(NULL AS BINARY) AS ids"), ["doc_id"]).collect()] == [b""]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text("ab ", max_size=90), st.text("aeiou\n\t é", max_size=60)), max_size=6))
def test_bpe_equals_the_library(codec, encoding, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert codec.encode(texts) == [packed(encoding, t) for t in texts]


def test_bpe_long_words(codec, encoding):
    rng = random.Random(2)
    texts = ["a" * 3000, "ab" * 1000, "".join(rng.choice("abcdef") for _ in range(2500)), "<|endoftext|>"]
    assert codec.encode(texts) == [packed(encoding, t) for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.text(st.sampled_from("abAe=あ"), max_size=40), st.integers(1, 60), st.text("the -é", max_size=200))
def test_bpe_joins_pieces_of_long_words(codec, encoding, unit, times, rest):
    texts = [unit * times + rest, rest.replace(" ", "") * 3 + unit * times]
    assert codec.encode(texts) == [packed(encoding, t) for t in texts]


def test_bpe_of_very_long_words(codec, encoding):
    rng = random.Random(3)
    parts = ["the", "over", "stand", "ing", "tion", "er", "school"]
    texts = [
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000)),
        "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(20_000)),
        "".join(rng.choice(parts) for _ in range(10_000)),
        "=" * 50_001,
    ]
    began = time.monotonic()
    got = codec.encode(texts)
    assert time.monotonic() - began < 60
    assert got == [packed(encoding, t) for t in texts]


def as_contamination(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in df.collect()), key=repr)


def test_contamination_equals_brute_force(spark):
    rng = random.Random(8)
    words = [f"v{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice((13, 14, 20, 40)))) for i in range(8)]
    items += [(20, "Short item"), (21, "One"), (22, ""), (None, text(15)), (23, None), (24, "a " * 30), (1, items[1][1]), (25, text(9))]
    docs = [(i, text(rng.choice((0, 3, 60, 200)))) for i in range(30)]
    for i in range(40):
        own = rng.choice([t for _, t in items if t]).split()
        cut = own[: rng.randrange(1, len(own) + 1)]
        docs.append((100 + i, " -- ".join([text(rng.randrange(0, 300)), " ".join(cut).upper(), text(20)])))
    docs += [(None, items[2][1]), (500, None), (501, "..."), (502, items[2][1] + " x " + items[2][1]), (502, "other"), (503, "a " * 500), (503, "a " * 500)]
    df = spark.createDataFrame([(*d, "extra", 1) for d in docs], "doc_id long, text string, hash string, n_words int")
    it = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, window string")
    assert as_contamination(decontaminate.contamination(spark, df, it)) == sorted(contamination(docs, items), key=repr)


def test_contamination_of_short_quotations_of_long_items(spark):
    long = [f"q{i}" for i in range(30)]
    items = [(1, " ".join(long)), (2, "q9"), (3, "q11 q12")]
    docs = [(n, " ".join(long[4 : 4 + n])) for n in range(6, 15)] + [(100 + n, " ".join(long[:n])) for n in range(7, 15)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    it = spark.createDataFrame(items, "item_id long, text string")
    assert as_contamination(decontaminate.contamination(spark, df, it)) == sorted(contamination(docs, items), key=repr)


def test_contamination_without_items_or_documents(spark, awkward):
    none = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.contamination(spark, awkward, none).collect()
    assert len(found) == awkward.count() and not any(r.contaminated or r.n_hit for r in found)
    empty = awkward.limit(0)
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(spark, empty, some).collect() == []


def test_base_scores_and_model(spark, documents, awkward):
    # the two very long texts are scored but do not teach
    off = next(i for i in range(100000, 101000) if fold(10 + i, 5) == fold(11 + i, 5) == 1)
    docs = documents.select("doc_id", "text").union(awkward.selectExpr(f"doc_id + {off}", "text"))
    rows = [tuple(r) for r in docs.collect()]
    got = language_model.score_documents(spark, docs).toPandas()
    want = pd.DataFrame(base_scores(rows), columns=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score"])
    for df in (got, want):
        df["doc_id"] = df.doc_id.fillna(-1)
        df.sort_values(["doc_id", "n_tokens"], inplace=True, ignore_index=True)
    for column in ("doc_id", "n_tokens", "n_known", "train_tokens"):
        assert (got[column] == want[column]).all(), column
    assert np.allclose(got.base_score, want.base_score)
    known = got[got.doc_id >= 0]
    assert (known.held_out == known.doc_id.map(lambda d: fold(int(d), 5) == 1)).all()
    ordinary = got[(got.doc_id >= 0) & (got.doc_id < off) & got.held_out.astype(bool)]
    assert ordinary.score.sum() > ordinary.base_score.sum()
    assert (got.score < 0).all()


def test_model_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert language_model.score_documents(spark, none).collect() == []
    alone = next(i for i in range(100) if fold(i, 5) == 1)
    row = language_model.score_documents(spark, spark.createDataFrame([(alone, "a b")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.held_out) == (3, 0, 0, True)
    assert abs(row.base_score) < 1e-9 and abs(row.score) < 1e-5


def test_model_is_a_distribution_and_carries_state():
    tokens = np.sort(np.random.default_rng(0).integers(1, 2**62, 3000).astype(np.uint64))
    vocab = language_model.Vocabulary(tokens, np.arange(1.0, 3001), np.arange(3000)[::-1].copy(), 3000 * 3001 // 2, 3100)
    model = language_model.Model(vocab)
    rng = np.random.default_rng(1)
    for v in model.p.values():
        v += 0.3 * rng.standard_normal(v.shape).astype(np.float32)
    h = rng.standard_normal((1, language_model.HIDDEN)).astype(np.float32)
    every = np.arange(language_model.WORDS + 1)
    logs = model.outputs(np.repeat(h, len(every), 0), every)
    assert abs(np.exp(logs).sum() - 1) < 1e-4
    # lanes, windows and neighbours make no difference to a text's probability
    lengths = np.array([5, 400, 1, 33, 70])
    ids = rng.integers(0, language_model.WORDS + 64, lengths.sum()).astype(np.int32)
    a = language_model._run(model, ids, lengths, 256, 64, 0, 0.0)
    b = language_model._run(model, ids, lengths, 2, 7, 0, 0.0)
    alone = np.concatenate([language_model._run(model, ids[x : x + n], np.array([n]), 1, 1000, 0, 0.0) for x, n in zip(np.cumsum(lengths) - lengths, lengths)])
    assert np.allclose(a, b, atol=1e-3) and np.allclose(a, alone, atol=1e-3)


def test_a_long_text_takes_memory_by_its_tokens():
    vocab = language_model.Vocabulary(np.arange(1, 200, dtype=np.uint64), np.full(199, 5.0), np.arange(199), 995, 250)
    model = language_model.Model(vocab)
    rng = np.random.default_rng(2)
    lengths = np.array([60_000, *[100] * 255])
    ids = rng.integers(0, 199, lengths.sum()).astype(np.int32)
    tracemalloc.start()
    scored = language_model._run(model, ids, lengths, 256, 64, False, 0.0)
    language_model._run(model, ids, lengths, 256, 64, True, 0.002)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # a grid of the longest text by all lanes would take 60,000 * 256 * 5 bytes and as much again for scores
    assert len(scored) == len(ids) and peak < 60e6


def test_first_weights_come_from_a_bounded_number_of_tokens(spark):
    vocab = language_model.Vocabulary(np.arange(1, 200, dtype=np.uint64), np.full(199, 5.0), np.arange(199), 995, 250)
    shared = spark.sparkContext.broadcast(vocab)
    docs = spark.createDataFrame([("a b c " * 50,)] * 9, "text string").coalesce(1)
    parts = language_model._trained(docs, shared, None, 64, 32, 0.01, 1, 400)
    assert {r.weight for r in parts.select("weight").distinct().collect()} == {400.0}


def test_gradients():
    vocab = language_model.Vocabulary(np.arange(1, 200, dtype=np.uint64), np.full(199, 5.0), np.arange(199), 995, 250)
    model = language_model.Model(vocab)
    rng = np.random.default_rng(4)
    model.p = {k: (v + 0.2 * rng.standard_normal(v.shape)).astype(np.float64) for k, v in model.p.items()}
    tokens = rng.integers(0, 190, (6, 3))
    tokens[2, 1] = language_model.WORDS + 3
    fresh = np.zeros((6, 3), bool)
    fresh[0, 0] = fresh[3, 1] = True
    h0 = rng.standard_normal((3, language_model.HIDDEN))
    grads = {}
    model._climb = lambda g, scale, rate: grads.update(g)

    def loss():
        h, states = h0, []
        for t in range(6):
            h = np.where(fresh[t][:, None], 0, h)
            states.append(h)
            h, _ = model.step(h, tokens[t])
        return model.outputs(np.concatenate(states), tokens.reshape(-1)).sum()

    model.learn(h0, tokens, fresh, 0.1)
    for name, at in (("u", (2, 5)), ("u", (3, 40)), ("x", (tokens[1, 0], 7)), ("c", (1, 0)), ("cb", (0,)), ("w", (tokens[3, 2], 4)), ("wb", (tokens[3, 2],))):
        kept = model.p[name][at]
        model.p[name][at] = kept + 1e-4
        up = loss()
        model.p[name][at] = kept - 1e-4
        down = loss()
        model.p[name][at] = kept
        assert abs((up - down) / 2e-4 - grads[name][at]) < 1e-2 * max(1, abs(grads[name][at])), name


def test_outputs_work_in_place():
    """Class probabilities overwrite their logits: of two such arrays a token (132 bytes each) one is left."""
    vocab = language_model.Vocabulary(np.arange(1, 2201, dtype=np.uint64), np.full(2200, 5.0), np.arange(2200), 11000, 2200)
    model, rng = language_model.Model(vocab), np.random.default_rng(1)
    h = rng.standard_normal((20_000, language_model.HIDDEN)).astype(np.float32)
    token = rng.integers(0, language_model.WORDS + 9, len(h)).astype(np.int32)
    tracemalloc.start()
    try:
        model.outputs(h, token)
        assert tracemalloc.get_traced_memory()[1] < 265 * len(h)
    finally:
        tracemalloc.stop()


def test_toxicity_learns(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    labels = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/labels.parquet")
    out = toxicity.judge(spark, docs, labels).select("doc_id", "held_out", "score", "predicted").toPandas()
    assert len(out) == docs.count() and out.score.between(0, 1).all()
    assert ((out.score >= 0.7) == (out.predicted == 1)).all()
    assert (out.held_out == out.doc_id.map(lambda d: fold(d, 3) == 1)).all()
    met = out.merge(labels.toPandas(), on="doc_id")
    met = met[met.held_out]
    assert ((met.predicted == met.toxic).mean()) > 0.9
    # labels of the held-out fold teach nothing
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    again = toxicity.judge(spark, docs, flipped).select("doc_id", "score").toPandas()
    assert np.allclose(out.sort_values("doc_id").score, again.sort_values("doc_id").score, atol=1e-6)


def test_rare_toxic_wording_outside_the_sample(spark):
    rng = random.Random(12)
    words = [f"{a}{b}{c}" for a in ("lor", "mis", "tan", "vel") for b in ("ume", "ola", "iri") for c in ("nt", "sk", "dow", "ph")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows, rare = [], "zugqux hjyblort"
    for i in range(4000):
        toxic = i % 2
        own = (rare if i % 200 == 1 else "you vile wretch") if toxic else "kind regards"
        rows.append((i, f"{text(10)} {own} {text(10)}", toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    # 20 of 2,000 toxic texts hold it, of the 200 that are drawn about one
    model = toxicity.train(spark, docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), 400)
    plain = [text(20) for _ in range(20)]
    without, with_it = (model.margins(pa.array(t)) for t in (plain, [f"{t} {rare}" for t in plain]))
    assert (with_it > without + 1).all()
    clean = model.margins(pa.array([f"{t} kind regards" for t in plain]))
    assert (1 / (1 + np.exp(-with_it)) >= 0.7).all() and (1 / (1 + np.exp(-clean)) < 0.7).all()


def test_toxicity_sample_bounds_rows(spark, monkeypatch):
    rows = [(0, f"vile words number {i % 300}") for i in range(600)] + [(i, f"kind words {i}") for i in range(1, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)], "doc_id long, toxic int")
    seen, fit, counts = [], toxicity._fit, toxicity._counts
    monkeypatch.setattr(toxicity, "_fit", lambda *a: seen.append(a[3]) or fit(*a))
    monkeypatch.setattr(toxicity, "_counts", lambda *a: seen.append(counts(*a)) or seen[-1])
    toxicity.train(spark, docs, labels, 60)
    (*_, n_toxic, n_clean), y = seen
    assert (n_toxic, n_clean) == (600 + 39, 160) and (y.sum(), len(y)) == (30, 60)


def test_toxicity_of_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(1, 1), (1, 0), (7, None), (None, 1), (8, 0)], "doc_id long, toxic int")
    out = toxicity.judge(spark, awkward, labels)
    assert set(awkward.columns) - {"score"} <= set(out.columns)
    assert out.count() == awkward.count()
    none = toxicity.judge(spark, awkward, labels.limit(0)).select("score", "predicted").distinct().collect()
    assert [tuple(r) for r in none] == [(0.5, 0)]
    assert toxicity.judge(spark, awkward.limit(0), labels).collect() == []


def test_toxicity_pieces_make_no_difference(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(3)
    weights = np.where(rng.random(1 << toxicity.SLOT_BITS) < 0.2, rng.standard_normal(1 << toxicity.SLOT_BITS), 0)
    model = toxicity.ToxicityModel(weights, 0.25)
    texts = pa.array(["some words here " * 40, "", None, "abc", "ABC def ghi jkl", "x" * 700])
    whole = model.margins(texts)
    monkeypatch.setattr(toxicity, "PIECE", 16)
    assert np.allclose(model.margins(texts), whole)
    assert whole[1] == whole[2] == 0.25
    slots = toxicity._distinct_slots(np.frombuffer(b"ABC def ghi jkl", np.uint8))
    assert np.isclose(whole[4], 0.25 + weights[slots].sum())


def small_model():
    vocab = language_model.Vocabulary(np.arange(1, 200, dtype=np.uint64), np.full(199, 5.0), np.arange(199), 995, 250)
    model = language_model.Model(vocab)
    rng = np.random.default_rng(4)
    model.p = {k: (v + 0.2 * rng.standard_normal(v.shape)).astype(np.float64) for k, v in model.p.items()}
    return model


def test_every_token_teaches():
    # 300 texts in 256 lanes; none fills a window, a few run over several
    lengths = np.random.default_rng(6).integers(1, 60, 300)
    lengths[:3] = 700, 130, 65
    ids = np.random.default_rng(7).integers(0, 190, lengths.sum()).astype(np.int32)
    model, taught = small_model(), []
    learn = model.learn

    def watched(h, tokens, fresh, rate, active):
        taught.append(np.concatenate([tokens[t, :n] for t, n in enumerate(active)]))
        return learn(h, tokens, fresh, rate, active)

    model.learn = watched
    before = model.packed()
    language_model._run(model, ids, lengths, 256, 64, True, 0.002)
    assert np.array_equal(np.sort(np.concatenate(taught)), np.sort(ids))
    assert (model.packed() != before).any()


def test_short_texts_teach(spark):
    vocab = language_model.Vocabulary(np.arange(1, 200, dtype=np.uint64), np.full(199, 5.0), np.arange(199), 995, 250)
    docs = spark.createDataFrame([(i, "a b c") for i in range(20)], "doc_id long, text string")
    start = language_model.Model(vocab).packed()
    shared = spark.sparkContext.broadcast(vocab)
    flat = language_model._averaged(language_model._trained(docs, shared, start, 256, 64, 0.002, 1))
    assert not np.allclose(flat, start)


def test_gradients_of_lanes_that_end():
    model, rng = small_model(), np.random.default_rng(9)
    tokens, active = rng.integers(0, 190, (6, 3)), np.array([3, 3, 2, 2, 1, 1])
    fresh = np.zeros((6, 3), bool)
    fresh[3, 1] = True
    h0, sums = rng.standard_normal((3, language_model.HIDDEN)), []
    # a lane alone has the gradient of its own tokens, so those of all lanes add up to the window's
    model._climb = lambda g, scale, rate: sums.append(({k: v.copy() for k, v in g.items()}, round(1 / scale)))
    model.learn(h0, tokens, fresh, 0.1, active)
    for lane, n in enumerate((6, 4, 2)):
        own = slice(lane, lane + 1)
        model.learn(h0[own], tokens[:n, own], fresh[:n, own], 0.1)
    assert [n for _, n in sums] == [12, 6, 4, 2]
    for k, whole in sums[0][0].items():
        assert np.allclose(whole, sum(g[k] for g, _ in sums[1:])), k


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(spark, awkward, encoding, rule):
    docs = awkward.where("doc_id <> 10 AND doc_id <> 11")
    lines = docs.selectExpr("doc_id", "replace(text, ' w1', '\n\nw1') AS body", "score AS title", "1 AS section")
    got = token_counts.section_token_counts(lines, ["doc_id"], ["title", "body"], rule).toPandas()
    for r in lines.dropDuplicates(["doc_id"]).collect():
        whole = f"{r.title or ''}\n{r.body or ''}"
        ids = encoding.encode_ordinary(whole)
        mine = got[got.doc_id == r.doc_id].drop_duplicates(["field", "section"])
        assert np.isclose(mine.n_tokens.sum(), len(ids))
        assert mine.end_char.max() == len(whole) and mine.first_char.min() == 0
    assert token_counts.section_token_counts(lines.limit(0), ["doc_id"], ["body"], rule).collect() == []


def test_allocation_rules():
    # tokens over characters [0,2) [2,6) [6,6) [6,9); sections start at 0, 3, 5
    spans, starts = np.array([0, 2, 6, 6, 9]), np.array([0, 3, 5])
    assert token_counts.allocate(spans, starts, "start").tolist() == [2, 0, 2]
    assert token_counts.allocate(spans, starts, "most").tolist() == [1, 1, 2]
    assert token_counts.allocate(spans, starts, "share").tolist() == [1.25, 0.5, 2.25]


def test_token_counts_equal_another_library(spark, documents):
    from bisect import bisect_right

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    docs = documents.select("doc_id", "text")
    got = token_counts.section_token_counts(docs, ["doc_id"], ["text"], "start").toPandas()
    for r in docs.collect()[:60]:
        starts = [0] + [i + 1 for i, c in enumerate(r.text) if c == "\n" and i + 1 < len(r.text)]
        want = [0] * len(starts)
        for a, _ in tokenizer.encode(r.text, add_special_tokens=False).offsets:
            want[bisect_right(starts, a) - 1] += 1
        assert got[got.doc_id == r.doc_id].sort_values("section").n_tokens.tolist() == want


def test_digest_columns(spark, sf_dir):
    from tidelog.llm import catalog

    row = catalog.op2_byte_bpe(spark, sf_dir).where("doc_id = 0").first()
    text = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id = 0").first().text
    assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
