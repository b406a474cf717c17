"""Byte-level BPE: words contract in DuckDB recursive queries, inside each partition.

A text is split by the tokenizer's pattern; each match is a word of its own. The distinct
new words of an Arrow batch become rows (word, position, token), one per byte. A recursive
query joins neighbouring tokens with the merge table, finds each word's pair of least
rank, leftmost first, and contracts it, until no pair is left. Decoding joins ids with the
vocabulary and aggregates their bytes in order.

A word of more than PIECE bytes is cut into pieces, which contract as words of their own,
and neighbours are then joined, pair by pair: the last tokens of one and the first of the
other contract once more as one word. If the outermost two tokens come out as they went
in, the join is done, else the window widens, at most to both parts as a whole. That is
exact: tokens are what a word contracts to just when each two neighbours are what those
two contract to, for the first contraction across a border would happen in the two alone
as well. In a window that had to widen (repetitive text) all occurrences of the least pair
contract in one round where that equals doing them one by one (no token that holds the new
one has a smaller rank). Queries hold at most BLOCK bytes of words, or one such window.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "byte_bpe_50k.tiktoken"
# fixed values: Unicode's White_Space characters, which the pattern's \s stands for
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CACHED_WORDS = 300_000
ROUNDS = 64
PIECE = 64
SEAM = 4
BLOCK = 1 << 19
TEXT_STEP = 4 << 20
SPARE_STEP = 2 << 20
IDS_STEP = 1 << 19

LEFTMOST = """
WITH RECURSIVE step(word, pos, id, round) AS (
    SELECT word, pos, id, 0 FROM tokens
    UNION ALL
    (
        WITH near AS MATERIALIZED (
            SELECT word, pos, id, round, lead(id) OVER one AS next_id, lag(pos) OVER one AS before
            FROM step WHERE round < ?
            WINDOW one AS (PARTITION BY word ORDER BY pos)
        ), best AS (
            SELECT near.word AS of_word, min(m.merged::BIGINT << 32 | near.pos) AS pick
            FROM near JOIN merges m ON near.id = m.a AND near.next_id = m.b
            GROUP BY near.word
        )
        SELECT word, pos, CASE WHEN pos = (pick & 4294967295) THEN (pick >> 32)::INTEGER ELSE id END, round + 1
        FROM near JOIN best ON word = of_word
        WHERE before IS DISTINCT FROM (pick & 4294967295)
    )
)
SELECT word, pos, id, round FROM step
"""

EVERYWHERE = """
WITH RECURSIVE step(word, pos, id, round) AS (
    SELECT word, pos, id, 0 FROM tokens
    UNION ALL
    SELECT word, pos, CASE WHEN taken THEN best ELSE id END, round + 1
    FROM (
        SELECT *, lag(taken, 1, false) OVER (PARTITION BY word ORDER BY pos) AS gone
        FROM (
            SELECT *,
                merged IS NOT DISTINCT FROM best AND CASE
                    WHEN run % 2 = 1 AND together THEN true
                    ELSE pos = first_pos
                END AS taken
            FROM (
                SELECT *, row_number() OVER (PARTITION BY word, island, merged IS NOT DISTINCT FROM best ORDER BY pos) AS run
                FROM (
                    SELECT *, nth - row_number() OVER (PARTITION BY word, merged IS NOT DISTINCT FROM best ORDER BY pos) AS island,
                        min(pos) FILTER (WHERE merged = best) OVER (PARTITION BY word) AS first_pos
                    FROM (
                        SELECT p.*, m.merged, m.together, min(m.merged) OVER (PARTITION BY p.word) AS best
                        FROM (
                            SELECT word, pos, id, round, lead(id) OVER one AS next_id, row_number() OVER one AS nth
                            FROM step WHERE round < ?
                            WINDOW one AS (PARTITION BY word ORDER BY pos)
                        ) p LEFT JOIN merges m ON p.id = m.a AND p.next_id = m.b
                    ) WHERE best IS NOT NULL
                )
            )
        )
    ) WHERE NOT gone
)
SELECT word, pos, id, round FROM step
"""


class Codec:
    """Encoder and decoder of one process, with a bounded store of words it has seen."""

    def __init__(self, ranks_path: str, pattern: str):
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE_SPACE}").replace(r"\s", f"[{WHITE_SPACE}]").replace(r"\S", f"[^{WHITE_SPACE}]"))
        with open(ranks_path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.first_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.db.execute("CREATE TABLE vocab(id INTEGER, hex VARCHAR)")
        self._load("vocab", {"id": list(self.ranks.values()), "hex": [k.hex() for k in self.ranks]})
        a, b, merged = [], [], []
        for token, rank in self.ranks.items():
            for at in range(1, len(token)):
                left, right = self.ranks.get(token[:at]), self.ranks.get(token[at:])
                if left is not None and right is not None:
                    a.append(left)
                    b.append(right)
                    merged.append(rank)
        self.db.execute("CREATE TABLE pairs(a INTEGER, b INTEGER, merged INTEGER)")
        self._load("pairs", {"a": a, "b": b, "merged": merged})
        self.db.execute(
            """CREATE TABLE merges AS
            SELECT p.*, coalesce(least > p.merged, true) AS together
            FROM pairs p LEFT JOIN (
                SELECT id, min(merged) AS least FROM (
                    SELECT a AS id, merged FROM pairs UNION ALL SELECT b, merged FROM pairs
                ) GROUP BY id
            ) o ON o.id = p.merged"""
        )
        self.codes: dict[str, int] = {}
        self.packed: list[bytes] = []

    def _load(self, table: str, columns: dict) -> None:
        rows = pa.table({k: pa.array(v, pa.string() if k == "hex" else pa.int32()) for k, v in columns.items()})
        self.db.register("given", rows)
        self.db.execute(f"INSERT INTO {table} SELECT * FROM given")
        self.db.unregister("given")

    def contract(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, packed as little-endian unsigned 32-bit numbers."""
        cut = {word: [word[at : at + PIECE] for at in range(0, len(word), PIECE)] for word in words if len(word) > PIECE}
        pieces = dict.fromkeys(word for word in words if word not in cut)
        pieces.update(dict.fromkeys(piece for parts in cut.values() for piece in parts))
        coded = self._contracted(list(pieces))
        joined = self._joined([[np.frombuffer(coded[piece], "<u4") for piece in parts] for parts in cut.values()])
        coded.update(zip(cut, joined))
        return [coded[word] for word in words]

    def _contracted(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids by word, for different words."""
        coded = {}
        for query, wide in ((LEFTMOST, False), (EVERYWHERE, True)):
            for block in _word_blocks([word for word in words if (len(word) > PIECE) == wide]):
                coded.update(zip(block, self._fixpoint(block, query)))
        return coded

    def _joined(self, rows: list[list[np.ndarray]]) -> list[bytes]:
        """Packed ids of words whose pieces are contracted; each level joins neighbours."""
        while any(len(parts) > 1 for parts in rows):
            # (word, place, tokens of the left part, of the right part in the window)
            open_ = [(row, at, SEAM, SEAM) for row, parts in enumerate(rows) for at in range(0, len(parts) - 1, 2)]
            level = [parts[::2] for parts in rows]
            while open_:
                windows = []
                for row, at, left, right in open_:
                    ids = np.concatenate([rows[row][at][-left:], rows[row][at + 1][:right]])
                    windows.append(b"".join(map(self.token.__getitem__, ids.tolist())))
                coded = self._contracted(list(dict.fromkeys(windows)))
                again = []
                for (row, at, left, right), window in zip(open_, windows):
                    a, b, ids = rows[row][at], rows[row][at + 1], np.frombuffer(coded[window], "<u4")
                    begins = left >= len(a) or ids[0] == a[-left]
                    ends = right >= len(b) or ids[-1] == b[right - 1]
                    if begins and ends:
                        level[row][at // 2] = np.concatenate([a[: max(len(a) - left, 0)], ids, b[right:]])
                    else:
                        again.append((row, at, left if begins else 2 * left, right if ends else 2 * right))
                open_ = again
            rows = level
        return [parts[0].tobytes() for parts in rows]

    def _fixpoint(self, words: list[bytes], query: str) -> list[bytes]:
        flat = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        pos = (np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        state = (word, pos, self.first_id[flat])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(state[0]):
            self.db.register("tokens", pa.table(dict(zip(("word", "pos", "id"), map(pa.array, state)))))
            rows = self.db.sql(query, params=[ROUNDS]).to_arrow_table()
            self.db.unregister("tokens")
            word, pos, id_, step = (rows[c].to_numpy() for c in ("word", "pos", "id", "round"))
            last = np.zeros(len(words), np.int32)
            np.maximum.at(last, word, step)
            ends = step == last[word]
            word, pos, id_ = word[ends], pos[ends], id_[ends]
            order = np.argsort(word.astype(np.int64) << 32 | pos, kind="stable")
            word, pos, id_ = word[order], pos[order], id_[order]
            open_ = last[word] == ROUNDS
            done.append((word[~open_], id_[~open_]))
            state = (word[open_], pos[open_], id_[open_])
        word = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int32)
        ids = np.concatenate([d[1] for d in done]) if done else np.zeros(0, np.int32)
        order = np.argsort(word, kind="stable")
        data = ids[order].astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(word, minlength=len(words))) * 4
        return [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        if len(self.codes) > CACHED_WORDS:
            self.codes.clear()
            self.packed.clear()
        new: list[bytes] = []
        coded = []
        for text in texts:
            words = self.pattern.findall(text)
            for word in set(words).difference(self.codes):
                self.codes[word] = len(self.codes)
                new.append(word.encode())
            coded.append(np.fromiter(map(self.codes.__getitem__, words), np.int32, len(words)))
        self.packed.extend(self.contract(new))
        return [b"".join(map(self.packed.__getitem__, c.tolist())) for c in coded]

    def decode(self, packed: list[bytes]) -> list[bytes]:
        """Bytes of each sequence of packed ids; long sequences go in blocks."""
        out = [[] for _ in packed]
        for rows, ids in _blocks(packed):
            self.db.register("ids", pa.table({"row": rows, "pos": np.arange(len(ids), dtype=np.int32), "id": ids}))
            found = self.db.sql(
                "SELECT row, unhex(string_agg(hex, '' ORDER BY pos)) AS bytes FROM ids JOIN vocab USING (id) GROUP BY row ORDER BY row"
            ).to_arrow_table()
            self.db.unregister("ids")
            for row, part in zip(found["row"].to_pylist(), found["bytes"].to_pylist()):
                out[row].append(part)
        return [b"".join(parts) for parts in out]


def _word_blocks(words: list[bytes]) -> Iterator[list[bytes]]:
    """Words in runs of at most BLOCK bytes; a longer word is a run of its own."""
    run, size = [], 0
    for word in words:
        if run and size + len(word) > BLOCK:
            yield run
            run, size = [], 0
        run.append(word)
        size += len(word)
    if run:
        yield run


def _blocks(packed: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of each id, ids) of at most IDS_STEP ids."""
    flat = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
    row = np.repeat(np.arange(len(packed), dtype=np.int32), [len(p) // 4 for p in packed])
    for at in range(0, len(flat), IDS_STEP):
        yield row[at : at + IDS_STEP], flat[at : at + IDS_STEP]


@lru_cache(maxsize=2)
def _codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def _steps(texts: pa.Array, step: int = TEXT_STEP) -> Iterator[list[str]]:
    """Texts in runs of about `step` characters."""
    run, size = [], 0
    for text in texts:
        run.append(text.as_py() or "")
        size += len(run[-1])
        if size >= step:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode(
    df: DataFrame,
    keys: list[str],
    text: str = "text",
    ranks: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    decode_too: bool = False,
    spare: bool = False,
) -> DataFrame:
    """`keys` of each row with n_tokens (long) and ids (binary, unsigned 32-bit little-endian).

    With decode_too the ids are decoded in the same pass, into `decoded` (binary). A null
    text is empty: no tokens. Rows come back as often as they went in, columns that are
    not named in `keys` are left out. `ranks` is the path of a rank file on every machine.
    Python workers outlive their tasks and keep the codec with its words for the next one;
    with `spare` they take smaller steps and give it back, for the stages that they run after.
    """
    path = ranks or public_tokenizers.path(RANKS)
    step = SPARE_STEP if spare else TEXT_STEP

    def run(batches):
        codec = _codec(path, pattern)
        for batch in batches:
            at = 0
            for texts in _steps(batch.column(len(keys)), step):
                ids = codec.encode(texts)
                columns = [batch.column(i).slice(at, len(texts)) for i in range(len(keys))]
                columns += [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
                if decode_too:
                    columns.append(pa.array(codec.decode(ids), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])
                at += len(texts)
        if spare:
            _codec.cache_clear()
            del codec
            pa.default_memory_pool().release_unused()

    given = df.select(*keys, F.col(text).cast("string").alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1]]
    fields += ["n_tokens long", "ids binary"] + ["decoded binary"] * decode_too
    return given.mapInArrow(run, ", ".join(fields))


def decode(df: DataFrame, keys: list[str], ids: str = "ids", ranks: str | None = None) -> DataFrame:
    """`keys` of each row with `decoded`, the bytes of packed ids; null ids are no ids.

    An id that the vocabulary lacks has no bytes.
    """
    path = ranks or public_tokenizers.path(RANKS)

    def run(batches):
        codec = _codec(path, public_tokenizers.PATTERN)
        for batch in batches:
            found = codec.decode([b or b"" for b in batch.column(len(keys)).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keys)], pa.array(found, pa.binary())], [f"c{i}" for i in range(len(keys) + 1)]
            )

    given = df.select(*keys, F.col(ids).alias("__ids"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1]]
    return given.mapInArrow(run, ", ".join([*fields, "decoded binary"]))
