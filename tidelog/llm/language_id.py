"""Language identification by cross-parsing entropy over suffix automata.

Each language has a suffix automaton of labelled text. A text is parsed against it from left
to right: every phrase is the longest match that the language's text holds anywhere (a byte
it never holds is a phrase by itself). A phrase costs about log2 of the length of the text
that it points into, so phrases are normalised by that; the language that needs the fewest
wins, the smaller name of equals.

Texts are lower-cased, what is neither letter nor mark becomes one space, and bytes are
matched. Texts are parsed whole, in segments of SEGMENT bytes that no phrase crosses, and
all segments of a batch side by side in numpy, one table look-up a byte and language.

The automata are fitted on a bounded sample (parameters): from at most `sample_rows`
different texts of a language, the one of the smallest hash in each of so many parts, a window
of PIECE characters at a place given by the hash, together at most `sample_bytes` over all languages, of which each
may use an equal part. Only that sample is sent to the tasks, which build the automata once.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.components import written

SAMPLE_ROWS = 256
SAMPLE_BYTES = 1 << 18
PIECE = 1024
SEGMENT = 1024
LANES = 1 << 14
UNKNOWN = "und"
_BREAK, _LETTER = regex.compile(r"[^\p{L}\p{M}]+"), regex.compile(r"\p{L}")


def normalise(text: str | None) -> bytes:
    """What is parsed of a text; nothing if it has no letter."""
    if not text or not _LETTER.search(text):
        return b""
    return _BREAK.sub(" ", text.lower()).strip(" ").encode()


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of the states of the smallest automaton of all substrings; state 0 is the start.

    Byte 0 stands between pieces and is followed by nothing but a new piece.
    """
    edges, link, length, last = [{}], [-1], [0], 0
    for byte in data:
        state = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and byte not in edges[at]:
            edges[at][byte] = state
            at = link[at]
        if at >= 0:
            to = edges[at][byte]
            if length[to] == length[at] + 1:
                link[state] = to
            else:
                copy = len(edges)
                edges.append(dict(edges[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and edges[at].get(byte) == to:
                    edges[at][byte] = copy
                    at = link[at]
                link[to] = link[state] = copy
        last = state
    return edges


class Parser:
    """Counts the phrases of texts against the samples of all languages at once."""

    def __init__(self, samples: tuple[bytes, ...]):
        used = sorted(set(b"".join(samples)) - {0})
        # code 0: bytes that no sample holds, and the mark between pieces
        self.code = np.zeros(256, np.uint8)
        self.code[used] = np.arange(1, len(used) + 1)
        self.width = width = len(used) + 1
        self.starts, tables, at = [], [], 0
        for sample in samples:
            edges = suffix_automaton(sample)
            # the last state is where a phrase has just ended with a byte of its own
            outside = len(edges)
            rows = np.repeat(np.arange(outside), [len(e) for e in edges])
            bytes_ = np.array([b for e in edges for b in e], np.int64)
            to = np.array([t for e in edges for t in e.values()], np.int64)
            real = bytes_ > 0
            rows, codes, to = rows[real], self.code[bytes_[real]], to[real]
            fresh = np.full(width, outside, np.int64)
            fresh[codes[rows == 0]] = to[rows == 0]
            # the next state times the width, and whether a new phrase begins
            table = np.tile(((fresh + at) * width) << 1 | 1, (outside + 1, 1))
            table[rows, codes] = ((to + at) * width) << 1
            tables.append(table.astype(np.int32))
            self.starts.append((outside + at) * width)
            at += outside + 1
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text (rows) against each language (columns)."""
        sizes = np.array([len(t) for t in texts], np.int64)
        out = np.zeros((len(texts), len(self.starts)), np.int64)
        data = self.code[np.frombuffer(b"".join(texts), np.uint8)]
        pieces = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = (np.cumsum(sizes) - sizes)[owner] + nth * SEGMENT
        size = np.minimum(sizes[owner] - nth * SEGMENT, SEGMENT)
        order = np.argsort(-size, kind="stable")
        for at in range(0, len(order), LANES):
            lanes = order[at : at + LANES]
            begin, length = first[lanes], size[lanes]
            count = np.zeros((len(self.starts), len(lanes)), np.int32)
            state = np.repeat(np.array(self.starts, np.int32)[:, None], len(lanes), 1)
            # lanes are sorted by length: those that go on are the first ones
            going = np.searchsorted(-length, -np.arange(1, length[0] + 1), "right")
            for step, n in enumerate(going):
                code = data[begin[:n] + step]
                for one, phrases in zip(state, count):
                    move = self.table[one[:n] + code]
                    phrases[:n] += move & 1
                    np.right_shift(move, 1, out=one[:n])
            np.add.at(out, owner[lanes], count.T)
        return out


@lru_cache(maxsize=2)
def _parser(samples: tuple[bytes, ...]) -> Parser:
    return Parser(samples)


def held_out(doc_id, folds: int = 3):
    """Every id whose crc32 leaves 1 is kept from learning."""
    return F.crc32(doc_id.cast("string")) % folds == 1


def learn(
    spark: SparkSession, docs: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES
) -> dict[str, bytes]:
    """A sample of each language's normalised text, from rows of `docs` (text, lang) with both.

    Equal texts of a language count once; a language whose drawn texts have no letter has an
    empty sample and is left out.
    """
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text", F.xxhash64("text").alias("at"))
    # the smallest hash of each part: a sample that every task can reduce by itself
    part = F.pmod(F.xxhash64("at"), F.lit(sample_rows))
    keys = rows.groupBy("lang", part).agg(F.min("at").alias("at")).select("lang", "at")
    keys = written(spark, keys, "sample")
    place = F.pmod("at", F.greatest(F.length("text") - PIECE, F.lit(0)) + 1).cast("int") + 1
    drawn = rows.join(F.broadcast(keys), ["lang", "at"]).select("lang", "at", F.substr("text", place, F.lit(PIECE)).alias("piece"))
    pieces = {}
    for row in drawn.groupBy("lang", "at").agg(F.min("piece").alias("piece")).orderBy("lang", "at").toLocalIterator():
        if found := normalise(row.piece):
            pieces.setdefault(row.lang, []).append(found)
    share = sample_bytes // max(1, len(pieces))
    return {lang: b"\0".join(own)[:share] for lang, own in sorted(pieces.items())}


def predictor(samples: dict[str, bytes]):
    """An expression (text) -> struct(lang_pred, score), see `identify`."""
    langs, texts = list(samples), tuple(samples.values())
    cost = np.array([np.log2(len(t) + 1) for t in texts])
    cost = cost / cost.max(initial=1)

    @F.arrow_udf("lang_pred string, score double")
    def predicted(column: pa.Array) -> pa.Array:
        given = [normalise(t) for t in column.to_pylist()]
        names, scores = np.full(len(given), -1), np.zeros(len(given))
        if langs and given:
            parsed = _parser(texts).phrases(given) * cost
            best = parsed.min(1, keepdims=True)
            known = np.array([bool(g) for g in given])
            names = np.where(known, parsed.argmin(1), -1)
            scores = np.where(known, 1 / np.exp2(np.maximum(best - parsed, -1000)).sum(1), 0)
        called = pa.array([langs[i] if i >= 0 else UNKNOWN for i in names], pa.string())
        return pa.StructArray.from_arrays([called, pa.array(scores)], ["lang_pred", "score"])

    return predicted


def identify(spark: SparkSession, docs: DataFrame, folds: int = 3, **sample) -> DataFrame:
    """`docs` (doc_id, text, lang) with held_out, lang_pred and score; learned from the other folds.

    lang_pred is `und`, with score 0, where the text is null or has no letter, and everywhere
    if nothing could be learned. The score halves the odds of a language with every
    normalised phrase that it needs more than another: 1 is certain, 1 / languages is a tie.
    A null doc_id belongs to no fold: held_out is null and the row teaches nothing. Rows
    come back as often as they went in; columns of the three names are replaced.
    """
    samples = learn(spark, docs.where(~held_out(F.col("doc_id"), folds)), **sample)
    told = predictor(samples)(F.col("text").cast("string")).alias("__told")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("held_out", "lang_pred", "score")]
    out = docs.select(*kept, held_out(F.col("doc_id"), folds).alias("held_out"), told)
    return out.select(*kept, "held_out", "__told.lang_pred", "__told.score")
