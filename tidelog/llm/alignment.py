"""Alignment of two tokenizers by inverted pair bitmaps.

Both encode the same bytes, so the byte offsets where tokens of both end cut them into
groups; inside a group every token of one is linked with every token of the other.

Documents are numbered in chunks. For each pair of ids a chunk has bitmaps of its documents:
plane k holds the documents whose number of links of that pair has bit k. The documents of a
pair are the OR of its planes, its links the popcounts weighed by 2^k; both are summed over
chunks, which share no document. A bitmap is kept as a list of 16-bit numbers where that is
shorter. With the counts of all pairs known, every pair's bitmaps return them to the
documents of each chunk.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidelog.llm.components import written

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_ROWS = 1 << 12
CHUNK_LINKS = 1 << 20
STEP_BYTES = 1 << 20
# groups with more links are counted by distinct ids
LARGE = 1 << 12
BITMAP_BYTES = CHUNK_ROWS // 8
# Latin letters, signs and controls up to U+024F and the common dashes and quotes
_SETTLED = re.compile("[\x00-\u024F\u2010-\u2027]*")
CHUNKS = (
    "chunk long, a int, b int, planes array<binary>, docs long, links long, "
    "nth int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
)
DOC_FIELDS = ["nth", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _byte_letters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Pair:
    """Two tokenizers and the bytes of their ids."""

    def __init__(self, byte_bpe: str, piece_bpe: str):
        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        letters = _byte_letters()
        vocabulary = self.a.get_vocab()
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in letters for c in token)
            tokens[i] = bytes(letters[c] for c in token) if known else token.encode()
        pieces = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            pieces.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.bytes_a, self.bytes_b = tokens, pieces
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (tokens, pieces))
        self.ranked = self._ranked(byte_bpe)

    def _ranked(self, byte_bpe: str) -> tiktoken.Encoding | None:
        """The byte-level vocabulary as ranks, if its merges come in the order of their ids and nothing else is done."""
        with open(byte_bpe, encoding="utf-8") as lines:
            form = json.load(lines)
        vocabulary, special = form["model"]["vocab"], {t["content"] for t in form["added_tokens"]}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in form["model"]["merges"]]
        ids = [vocabulary[a + b] for a, b in pairs]
        split = form["pre_tokenizer"] or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        if form["normalizer"] or not plain or ids != sorted(ids) or form["model"].get("ignore_merges"):
            return None
        ranks = {self.bytes_a[i]: i for t, i in vocabulary.items() if t not in special}
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _of_a(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids by the byte-level vocabulary; None where their bytes are not the text's.

        Texts of characters whose kinds all editions of Unicode agree on take the ranks, which
        give the same ids at a quarter of the time.
        """
        out: list[np.ndarray | None] = [None] * len(texts)
        others = []
        for i, text in enumerate(texts):
            if self.ranked and _SETTLED.fullmatch(text):
                out[i] = np.array(self.ranked.encode_ordinary(text), np.int64)
            else:
                others.append(i)
        for i, found in zip(others, self.a.encode_batch_fast([texts[i] for i in others], add_special_tokens=False)):
            if b"".join([self.bytes_a[t] for t in found.ids]) == texts[i].encode():
                out[i] = np.array(found.ids, np.int64)
        return out

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text by either; none where the bytes of one are not those of the text."""
        full = [" " + t for t in texts]
        ids_a = self._of_a(full)
        ids_b = self.b.encode(texts, num_threads=1) if texts else []
        none = np.zeros(0, np.int64)
        for i, text in enumerate(full):
            if len(text) > 1 and ids_a[i] is not None and b"".join([self.bytes_b[t] for t in ids_b[i]]) == text.encode():
                ids_b[i] = np.array(ids_b[i], np.int64)
            else:
                ids_a[i] = ids_b[i] = none
        return ids_a, ids_b


@lru_cache(maxsize=1)
def _pair(byte_bpe: str, piece_bpe: str) -> Pair:
    return Pair(byte_bpe, piece_bpe)


def align(ids_a: np.ndarray, ids_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group of each token of a, of each of b, byte at which each group ends)."""
    end_a, end_b = np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b])
    # both rise and end with the last byte
    both = end_b[np.searchsorted(end_b, end_a)] == end_a
    ends = end_a[both]
    return np.cumsum(both) - both, np.searchsorted(ends, end_b), ends


def _digits(ids_a: np.ndarray, ids_b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(`a1,a2|b1;a3|b2,b3;` as bytes, where each group's text ends)."""
    n = int(of_a[-1]) + 1
    in_a, in_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
    place_a = np.arange(len(of_a)) + (np.cumsum(in_b) - in_b)[of_a]
    place_b = np.arange(len(of_b)) + np.cumsum(in_a)[of_b]
    value, mark = np.empty(len(of_a) + len(of_b), np.int64), np.empty(len(of_a) + len(of_b), np.uint8)
    value[place_a], value[place_b] = ids_a, ids_b
    mark[place_a] = np.where(np.append(of_a[1:] != of_a[:-1], True), ord("|"), ord(","))
    mark[place_b] = np.where(np.append(of_b[1:] != of_b[:-1], True), ord(";"), ord(","))
    width = np.searchsorted(10 ** np.arange(1, 10), value, "right") + 1
    end = np.cumsum(width + 1)
    out = np.empty(int(end[-1]), np.uint8)
    out[end - 1] = mark
    for back in range(int(width.max())):
        has = width > back
        out[end[has] - 2 - back] = 48 + value[has] // 10**back % 10
    return out, end[np.cumsum(in_a + in_b) - 1]


def _links(ids_a: np.ndarray, ids_b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, doc: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """(pair, document, links) in parts; `doc` is the document of each group."""
    n = len(doc)
    in_a, in_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
    first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    large = in_a * in_b > LARGE
    parts = []
    kept = np.flatnonzero(~large[of_a])
    times = in_b[of_a[kept]]
    left = np.repeat(kept, times)
    right = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times) + first_b[of_a[left]]
    parts.append((ids_a[left] << 16 | ids_b[right], doc[of_a[left]], np.ones(len(left), np.int64)))
    for g in np.flatnonzero(large):
        a, m = np.unique(ids_a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
        b, k = np.unique(ids_b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
        pairs = (a[:, None] << 16 | b[None, :]).ravel()
        parts.append((pairs, np.full(len(pairs), doc[g]), (m[:, None] * k[None, :]).ravel()))
    return parts


def _packed(docs: np.ndarray) -> bytes:
    """Rising numbers of documents as 16-bit numbers, or as a bitmap where that is no longer."""
    if 2 * len(docs) < BITMAP_BYTES:
        return docs.astype("<u2").tobytes()
    bits = np.zeros(CHUNK_ROWS, bool)
    bits[docs] = True
    return np.packbits(bits).tobytes()


def _bitmap(packed: bytes) -> np.ndarray:
    """The bits of a packed bitmap."""
    if len(packed) == BITMAP_BYTES:
        return np.unpackbits(np.frombuffer(packed, np.uint8)).view(bool)
    bits = np.zeros(CHUNK_ROWS, bool)
    bits[np.frombuffer(packed, "<u2")] = True
    return bits


def _planes(pairs: np.ndarray, docs: np.ndarray, links: np.ndarray) -> dict[str, pa.Array]:
    """Columns a, b, planes, docs and links of each distinct pair of a chunk."""
    order = np.argsort(pairs * CHUNK_ROWS + docs, kind="stable")
    pairs, docs, links = pairs[order], docs[order], links[order]
    new = np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]) | (docs[1:] != docs[:-1])))
    total = np.add.reduceat(links, new)
    pairs, docs = pairs[new], docs[new]
    first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    ends = np.append(first[1:], len(pairs))
    size = ends - first
    largest = np.maximum.reduceat(total, first)
    levels = np.frexp(largest.astype(float))[1]
    # most pairs have one plane and few documents, whose numbers lie next to each other already
    plain = (levels == 1) & (2 * size < BITMAP_BYTES)
    few, many = np.flatnonzero(plain), np.flatnonzero(~plain)
    places = np.append(0, 2 * np.cumsum(size[few])).astype(np.int32)
    numbers = docs[np.repeat(plain, size)].astype("<u2")
    alone = pa.Array.from_buffers(pa.binary(), len(few), [None, pa.py_buffer(places), pa.py_buffer(numbers)])
    packed = [
        _packed(docs[x:y][(total[x:y] >> k & 1) > 0])
        for x, y, n in zip(first[many].tolist(), ends[many].tolist(), levels[many].tolist())
        for k in range(n)
    ]
    counts = np.concatenate([np.ones(len(few), np.int64), levels[many]])
    order = np.concatenate([few, many])
    own = pairs[first[order]]
    return {
        "a": pa.array(own >> 16, pa.int32()),
        "b": pa.array(own & 0xFFFF, pa.int32()),
        "planes": pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.concat_arrays([alone, pa.array(packed, pa.binary())])
        ),
        "docs": pa.array(size[order].astype(np.int64)),
        "links": pa.array(np.add.reduceat(total, first)[order]),
    }


def _chunks(docs: DataFrame, byte_bpe: str, piece_bpe: str) -> DataFrame:
    """Rows of documents and of pairs, chunk by chunk."""

    def build(batches):
        pair, task, number = _pair(byte_bpe, piece_bpe), TaskContext.get().partitionId(), 0
        rows, links, held = [], [], 0

        def table(columns, n, chunk):
            columns["chunk"] = pa.array(np.full(n, chunk))
            schema = build_schema
            arrays = [columns.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in schema]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        def chunk():
            name = task << 31 | number
            columns = dict(zip(DOC_FIELDS, map(pa.array, zip(*rows))))
            columns["doc_id"] = pa.array([r[1] for r in rows], pa.int64())
            yield table(columns, len(rows), name)
            if links:
                found = _planes(*(np.concatenate(x) for x in zip(*links)))
                whole = table(found, len(found["a"]), name)
                for at in range(0, whole.num_rows, 10_000):
                    yield whole.slice(at, 10_000)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(ids):
                to, size = at, 0
                while to < len(ids) and to - at < CHUNK_ROWS - len(rows) and (size < STEP_BYTES or to == at):
                    size += len(texts[to] or "")
                    to += 1
                found, parts = _encoded(pair, ids[at:to], [t or "" for t in texts[at:to]], len(rows))
                rows += found
                links += parts
                held += sum(len(p[0]) for p in parts)
                at = to
                if len(rows) >= CHUNK_ROWS or held >= CHUNK_LINKS:
                    yield from chunk()
                    number, rows, links, held = number + 1, [], [], 0
        if rows:
            yield from chunk()

    build_schema = pa.schema(
        [
            ("chunk", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("planes", pa.list_(pa.binary())),
            ("docs", pa.int64()), ("links", pa.int64()), ("nth", pa.int32()), ("doc_id", pa.int64()),
            ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
            ("groups_sha256", pa.string()),
        ]
    )
    return docs.mapInArrow(build, CHUNKS)


def _encoded(pair: Pair, ids: list, texts: list[str], first: int) -> tuple[list[tuple], list[tuple[np.ndarray, ...]]]:
    """Rows of some documents, numbered from `first`, and their links."""
    ids_a, ids_b = pair.encode(texts)
    size_a, size_b = np.array([len(x) for x in ids_a]), np.array([len(x) for x in ids_b])
    all_a, all_b = np.concatenate(ids_a), np.concatenate(ids_b)
    if not len(all_a):
        return [(first + i, d, 0, 0, 0, 0, "") for i, d in enumerate(ids)], []
    # documents end together in both, so one alignment of all of them never crosses a border
    of_a, of_b, ends = align(all_a, all_b, pair.size_a, pair.size_b)
    last = np.cumsum(size_a)
    doc = np.searchsorted(last, np.flatnonzero(np.append(True, of_a[1:] != of_a[:-1])), "right")
    text, at = _digits(all_a, all_b, of_a, of_b)
    n_groups = np.bincount(doc, minlength=len(ids))
    per_group = np.bincount(of_a) * np.bincount(of_b)
    n_links = np.zeros(len(ids), np.int64)
    np.add.at(n_links, doc, per_group)
    group_end = np.cumsum(n_groups)
    rows = []
    for i, d in enumerate(ids):
        sha = ""
        if n_groups[i]:
            begin = at[group_end[i] - n_groups[i] - 1] if group_end[i] > n_groups[i] else 0
            sha = hashlib.sha256(text[begin : at[group_end[i] - 1] - 1]).hexdigest()
        rows.append((first + i, d, int(size_a[i]), int(size_b[i]), int(n_groups[i]), int(n_links[i]), sha))
    return rows, _links(all_a, all_b, of_a, of_b, doc + first)


def _returned(rows: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of a chunk with the counts that its pairs' bitmaps return."""
    best, total = np.zeros(CHUNK_ROWS, np.int64), np.zeros(CHUNK_ROWS, np.int64)
    pairs = pairs.combine_chunks()
    count, top = pairs["docs"].to_numpy(), pairs["top"].to_numpy(zero_copy_only=False)
    for i, planes in enumerate(pairs["planes"].to_pylist()):
        for k, packed in enumerate(planes):
            docs = np.frombuffer(packed, "<u2") if len(packed) < BITMAP_BYTES else _bitmap(packed)
            total[docs] += count[i] << k
            if top[i]:
                best[docs] += 1 << k
    nth = rows["nth"].to_numpy()
    columns = {c: rows[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    columns |= {"n_best": pa.array(best[nth]), "count_sum": pa.array(total[nth]), "groups_sha256": rows["groups_sha256"]}
    return pa.table(columns)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(a, b, docs, links, top) of each pair: documents that hold it, its links, and whether no b of a has more documents."""
    counted = chunks.where("a IS NOT NULL").groupBy("a", "b").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    most = counted.groupBy("a").agg(F.max("docs").alias("most"))
    return counted.join(most, "a").select("a", "b", "docs", "links", (F.col("docs") == F.col("most")).alias("top"))


def align_documents(
    spark: SparkSession, docs: DataFrame, byte_bpe: str | None = None, piece_bpe: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): the alignment of every whole text and the counts of all linked id pairs.

    `docs` has doc_id (long) and text; every row is a document of its own, repeated ones and
    those without doc_id included. Null and empty texts, and texts whose bytes are not those
    of both encodings, have no tokens: all numbers are 0 and groups_sha256 is ''. Other
    columns are not read. An empty table gives no rows.
    """
    paths = byte_bpe or public_tokenizers.path(BYTE_BPE), piece_bpe or public_tokenizers.path(PIECE_BPE)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chunks = written(spark, _chunks(given, *paths), "chunks")
    pairs = written(spark, pair_counts(chunks), "pair-counts")
    held = chunks.where("a IS NOT NULL").select("chunk", "a", "b", "planes")
    known = held.join(pairs.select("a", "b", "docs", "top"), ["a", "b"]).select("chunk", "planes", "docs", "top")
    rows = chunks.where("a IS NULL").select(F.col("chunk").alias("of"), *DOC_FIELDS)
    out = rows.groupBy("of").cogroup(known.groupBy("chunk")).applyInArrow(
        _returned,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    )
    return out, pairs
