"""Ranked search, language identification and tokenizer alignment against plain forms."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_tables import awkward, documents  # noqa: F401
from reference_forms import LOWER, fold

from tidelog.llm import alignment, language_id, lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_ranks(docs, items, k=10):
    words = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n, total = sum(bool(w) for w in words), sum(map(len, words))
    counts = [Counter(w) for w in words]
    df = Counter(t for c in counts for t in c)
    asked = defaultdict(set)
    for item, text in items:
        if item is not None:
            asked[item] |= set(TERM.findall((text or "").translate(LOWER)))
    out = []
    for item, own in asked.items():
        scored = []
        for (doc_id, _), c, w in zip(docs, counts, words):
            m = 100 - 90 + (90 * len(w) * n) // total if total else 10
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in own
                if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out.append((item, rank, doc_id, -score))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_search_equals_scoring_everything(spark, awkward, documents):
    docs = awkward.select("doc_id", "text", "n").union(documents.selectExpr("doc_id + 1000", "text", "1 AS n"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rng = random.Random(3)
    texts = [t for _, t in rows if t]
    items = [(i, " ".join(rng.sample(rng.choice(texts).split(), 1) * 2 + rng.choice(texts).split()[:30])) for i in range(30)]
    items += [(100, None), (101, ""), (102, "nowhere-else-at-all"), (None, "x"), (103, "ONE two"), (103, "three one"), (104, "one")]
    queries = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "text AS term", "item_id AS doc_id")
    assert found(lexical.ranked_search(spark, docs, queries)) == plain_ranks(rows, items)


def test_search_over_many_shards_and_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 3)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    items = [(f"q{i}", text[:200]) for i, (_, text) in enumerate(rows[:10])]
    queries = spark.createDataFrame(items, "item_id string, text string")
    got = lexical.ranked_search(spark, documents.repartition(7), queries, k=3)
    assert found(got) == plain_ranks(rows, items, 3)


def test_search_takes_ties_in_order(spark):
    docs = [(i, "same words here") for i in range(40, 0, -1)] + [(None, "same words here"), (50, "other text"), (51, "")]
    items = [("a", "words"), ("b", "nothing")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    queries = spark.createDataFrame(items, "item_id string, text string")
    got = found(lexical.ranked_search(spark, df, queries))
    assert got == plain_ranks(docs, items) and [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(1, 11))


def test_search_of_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert lexical.ranked_search(spark, documents, none).collect() == []
    assert lexical.ranked_search(spark, documents.limit(0), some).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 400), st.integers(1, 6), st.integers(1, 12))
def test_best_documents_of_a_shard(seed, n_docs, n_lists, k):
    rng = np.random.default_rng(seed)
    lists, total = [], np.zeros(n_docs, np.int64)
    for _ in range(n_lists):
        docs = np.flatnonzero(rng.random(n_docs) < rng.random())
        impact = rng.integers(0, rng.choice([3, 1000]), len(docs))
        lists.append((docs, impact))
        total[docs] += impact
    leaf, lexical.LEAF = lexical.LEAF, int(rng.choice([0, 5, 1024]))
    try:
        docs, scores = lexical.Shard(lists, n_docs).best(np.arange(n_lists), k)
    finally:
        lexical.LEAF = leaf
    want = sorted((-s, d) for d, s in enumerate(total) if s > 0)[:k]
    assert list(zip((-scores).tolist(), docs.tolist())) == want


def plain_phrases(text, sample):
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample and b"\0" not in text[at : at + size + 1]:
            size += 1
        count, at = count + 1, at + size
    return count


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.text("abcé ", max_size=60), min_size=1, max_size=3),
    st.lists(st.text("abcdéx ", max_size=80), min_size=1, max_size=5),
    st.integers(1, 40),
)
def test_phrases_are_longest_matches(samples, texts, segment):
    given_ = tuple(s.encode().replace(b"  ", b"\0") for s in samples)
    texts = [t.encode() for t in texts]
    size, language_id.SEGMENT = language_id.SEGMENT, segment
    try:
        got = language_id.Parser(given_).phrases(texts)
    finally:
        language_id.SEGMENT = size
    cut = [[t[i : i + segment] for i in range(0, len(t), segment)] for t in texts]
    assert got.tolist() == [[sum(plain_phrases(c, s) for c in t) for s in given_] for t in cut]


def test_languages_equal_brute_force_and_are_right_on_held_out_texts(spark, awkward, documents):
    docs = documents.select("doc_id", "text", "lang")
    odd = [(None, "Sans numéro", "fr"), (9001, None, "en"), (9002, "12 .,;", "de"), (9003, "x", None), (9004, "中文字", "fr"), (9005, "", "es")]
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "doc_id AS score", "text AS lang_pred")
    rows = language_id.identify(spark, docs).collect()
    samples = language_id.learn(spark, docs.where(~language_id.held_out(docs.doc_id)))
    assert list(samples) == sorted(samples) and sum(map(len, samples.values())) <= language_id.SAMPLE_BYTES
    weight = [math.log2(len(s) + 1) for s in samples.values()]
    right = total = 0
    for row in rows:
        data = language_id.normalise(row.text)
        assert row.held_out == (None if row.doc_id is None else fold(row.doc_id, 3) == 1)
        if not data:
            assert (row.lang_pred, row.score) == ("und", 0)
            continue
        cut = [data[i : i + language_id.SEGMENT] for i in range(0, len(data), language_id.SEGMENT)]
        if len(data) < 3000:
            need = [sum(plain_phrases(c, s) for c in cut) * w / max(weight) for s, w in zip(samples.values(), weight)]
            assert row.lang_pred == list(samples)[need.index(min(need))]
            assert row.score == pytest.approx(1 / sum(2 ** max(min(need) - x, -1000) for x in need))
        if row.held_out and row.lang and len(data) > 40:
            total += 1
            right += row.lang_pred == row.lang
    assert total > 30 and right / total > 0.97
    odd_rows = {r.doc_id: r.lang_pred for r in rows if r.doc_id is None or r.doc_id > 9000}
    assert odd_rows[9001] == odd_rows[9002] == odd_rows[9005] == "und"
    assert odd_rows[9003] in samples and odd_rows[9004] in samples
    plain = awkward.selectExpr("*", "'en' AS lang", "1 AS held_out").drop("lang_pred")
    assert language_id.identify(spark, plain).count() == plain.count()


def test_languages_of_empty_tables(spark, documents):
    assert language_id.identify(spark, documents.limit(0)).collect() == []
    unlabelled = documents.limit(5).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in language_id.identify(spark, unlabelled).collect()} == {"und"}


@pytest.fixture(scope="module")
def tokenizers():
    path = alignment.public_tokenizers.path
    return alignment.Pair(path(alignment.BYTE_BPE), path(alignment.PIECE_BPE))


def plain_alignment(pair, text):
    """Groups of (ids of a, ids of b) of a text."""
    data = (" " + (text or "")).encode()
    a = pair.a.encode(" " + (text or ""), add_special_tokens=False).ids
    b = pair.b.encode(text or "")
    joined = [b"".join(known[i] for i in ids) for known, ids in ((pair.bytes_a, a), (pair.bytes_b, b))]
    if not text or joined != [data, data]:
        return []
    groups, i, j = [], 0, 0
    while i < len(a):
        x, y = [a[i]], [b[j]]
        n, m, i, j = len(pair.bytes_a[a[i]]), len(pair.bytes_b[b[j]]), i + 1, j + 1
        while n != m:
            if n < m:
                x.append(a[i])
                n, i = n + len(pair.bytes_a[a[i]]), i + 1
            else:
                y.append(b[j])
                m, j = m + len(pair.bytes_b[b[j]]), j + 1
        groups.append((x, y))
    return groups


def plain_rows(pair, docs):
    aligned = [plain_alignment(pair, t) for _, t in docs]
    links = [Counter((a, b) for x, y in g for a in x for b in y) for g in aligned]
    counts = Counter(p for own in links for p in own)
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for (doc_id, _), g, own in zip(docs, aligned, links):
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append(
            (
                doc_id,
                sum(len(x) for x, _ in g),
                sum(len(y) for _, y in g),
                len(g),
                sum(own.values()),
                sum(n for p, n in own.items() if counts[p] == most[p[0]]),
                sum(n * counts[p] for p, n in own.items()),
                hashlib.sha256(shown.encode()).hexdigest() if g else "",
            )
        )
    return sorted(out, key=repr), counts


ODD = [
    (9001, None), (9002, ""), (9003, " "), (9004, "▁ marked"), (9005, "<|endoftext|> and </s> <0x41> <unk>"),
    (9006, "\x00 control \x07"), (9007, "日本語のテキスト 😀 é́"), (9008, "a" * 20_000), (9009, "ab" * 3_000 + "\n" * 500),
    (9010, "  two  spaces   three "), (9011, "\t\ttabs\r\nlines\n\n"), (9012, "ﬁ ligature ½ ①"), (9010, "again"), (None, "no id"),
]


def test_alignment_equals_brute_force(spark, awkward, documents, tokenizers):
    docs = awkward.selectExpr("doc_id", "text", "n AS chunk").union(documents.selectExpr("doc_id + 100", "text", "1 AS n"))
    docs = docs.union(spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 AS n"))
    given_ = [(r.doc_id, r.text) for r in docs.collect()]
    want, counts = plain_rows(tokenizers, given_)
    rows, pairs = alignment.align_documents(spark, docs.repartition(5))
    assert sorted(map(tuple, rows.collect()), key=repr) == want
    assert {(r.a, r.b): r.docs for r in pairs.collect()} == dict(counts)


def test_alignment_in_small_chunks(spark, documents, tokenizers, monkeypatch):
    for name, value in (("CHUNK_ROWS", 64), ("BITMAP_BYTES", 8), ("STEP_BYTES", 4000), ("LARGE", 2)):
        monkeypatch.setattr(alignment, name, value)
    docs = [(r.doc_id, r.text[:2000]) for r in documents.collect()] + ODD
    rows, links = [], []
    made = alignment._encoded(tokenizers, [d for d, _ in docs[:64]], [t or "" for _, t in docs[:64]], 0)
    found = alignment._planes(*(np.concatenate(x) for x in zip(*made[1])))
    want, counts = plain_rows(tokenizers, docs[:64])
    assert dict(zip(zip(found["a"].to_pylist(), found["b"].to_pylist()), found["docs"].to_pylist())) == dict(counts)
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    tops = [counts[p] == most[p[0]] for p in zip(found["a"].to_pylist(), found["b"].to_pylist())]
    heads = {c: pa.array(list(x)) for c, x in zip(alignment.DOC_FIELDS, zip(*made[0]))}
    got = alignment._returned(pa.table(heads), pa.table(found | {"top": pa.array(tops)}))
    assert sorted(zip(*(c.to_pylist() for c in got.columns)), key=repr) == want


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(st.characters(max_codepoint=0x24F), max_size=60), st.text("aé ' \n\t\u0085\u00a0s12!", max_size=60), st.text(max_size=30)))
def test_ranks_give_the_ids_of_the_vocabulary(tokenizers, text):
    assert tokenizers.ranked is not None
    text = " " + text.encode("utf-8", "ignore").decode()
    want = tokenizers.a.encode(text, add_special_tokens=False).ids
    assert tokenizers._of_a([text])[0].tolist() == want


def test_alignment_of_nothing(spark, documents):
    rows, pairs = alignment.align_documents(spark, documents.limit(0))
    assert rows.collect() == [] and pairs.collect() == []
