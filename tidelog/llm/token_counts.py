"""Token counts of fields and sections from one encoding of the whole document.

The fields of a row are joined to one document, which is encoded once, so tokens may cross
the borders of fields and of the sections inside them. Every token has a span of
characters (those whose first byte it holds); a sweep over the sorted borders meets each
span with the sections it touches. A token inside one section counts there. One that
crosses borders is allocated by a rule:

* "start": the section of its first character;
* "most":  the section with most of its characters, the earliest of equals;
* "share": every section, by its share of the characters.

A token without a character of its own (the rest of a split character) goes where the
character before it is. So the counts of a document's sections add up to its tokens.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "byte_bpe_50k.tiktoken"
RULES = ("start", "most", "share")


@lru_cache(maxsize=2)
def _tokenizer(ranks_path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder and the number of bytes of each id."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    encoder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoder, sizes


def token_spans(encoder: tiktoken.Encoding, sizes: np.ndarray, text: str) -> np.ndarray:
    """Character at which each token begins, and the text's length at the end."""
    ids = np.array(encoder.encode_ordinary(text), np.int64)
    data = np.frombuffer(text.encode(), np.uint8)
    first = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    return first[np.append(0, np.cumsum(sizes[ids]))]


def allocate(spans: np.ndarray, starts: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section: `starts` are the sections' first characters, in order."""
    begin, end = spans[:-1], spans[1:]
    # the character of a token that holds none is the one before
    begin = np.where(begin == end, np.maximum(begin - 1, 0), begin)
    end = np.maximum(end, begin + 1)
    low = np.maximum(np.searchsorted(starts, begin, "right") - 1, 0)
    high = np.maximum(np.searchsorted(starts, end - 1, "right") - 1, 0)
    counts = np.bincount(low[(low == high) | (rule == "start")], minlength=len(starts)).astype(float)
    if rule != "start":
        edges = np.append(starts, max(int(spans[-1]), int(starts[-1]) + 1))
        for t in np.flatnonzero(low != high):
            across = np.arange(low[t], high[t] + 1)
            held = np.minimum(edges[across + 1], end[t]) - np.maximum(edges[across], begin[t])
            if rule == "most":
                counts[across[np.argmax(held)]] += 1
            else:
                counts[across] += held / held.sum()
    return counts


def section_token_counts(
    df: DataFrame,
    keys: list[str],
    fields: list[str],
    rule: str = "start",
    section_end: str | None = "\n",
    joiner: str = "\n",
    ranks: str | None = None,
) -> DataFrame:
    """One row for each section of each row: keys, field, section, first_char, end_char, n_tokens.

    `joiner` stands between fields and belongs to the one before it. A section ends with
    `section_end` (or is the whole field where that is None); sections are numbered within
    a field. Null fields are empty; an empty field is one section of no characters and no
    tokens. n_tokens is a double, whole unless the rule is "share". Rows come back as often
    as they went in; columns that are neither keys nor fields are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    path = ranks or public_tokenizers.path(RANKS)

    def run(batches):
        encoder, sizes = _tokenizer(path)
        for batch in batches:
            texts = [batch.column(len(keys) + i).to_pylist() for i in range(len(fields))]
            rows, names, numbers, firsts, ends, counts = [], [], [], [], [], []
            size = 0

            def flush():
                taken = [c.take(pa.array(np.concatenate(rows))) for c in batch.columns[: len(keys)]]
                own = [np.concatenate(x) for x in (names, numbers, firsts, ends, counts)]
                columns = [*taken, pa.array(fields).take(pa.array(own[0])), *map(pa.array, own[1:])]
                for part in (rows, names, numbers, firsts, ends, counts):
                    part.clear()
                return pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])

            for row, values in enumerate(zip(*texts)):
                parts = [v or "" for v in values]
                whole = joiner.join(parts)
                starts, field_of, number = [], [], []
                at = 0
                for i, part in enumerate(parts):
                    own = [0]
                    if section_end:
                        cut = part.find(section_end)
                        while cut >= 0 and cut + len(section_end) < len(part):
                            own.append(cut + len(section_end))
                            cut = part.find(section_end, own[-1])
                    starts += [at + s for s in own]
                    field_of += [i] * len(own)
                    number += range(len(own))
                    at += len(part) + len(joiner)
                first = np.array(starts, np.int64)
                rows.append(np.full(len(first), row))
                names.append(np.array(field_of))
                numbers.append(np.array(number, np.int32))
                firsts.append(first)
                ends.append(np.append(first[1:], len(whole)))
                counts.append(allocate(token_spans(encoder, sizes, whole), first, rule))
                size += len(whole)
                if size > 8 << 20:
                    yield flush()
                    size = 0
            if rows:
                yield flush()

    given = df.select(*keys, *[F.col(f).cast("string").alias(f"__{i}") for i, f in enumerate(fields)])
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[: len(keys)]]
    return given.mapInArrow(
        run, ", ".join([*kept, "field string, section int, first_char long, end_char long, n_tokens double"])
    )
