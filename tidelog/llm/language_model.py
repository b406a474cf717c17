"""Document log-likelihood by a gated recurrent model with class-factored output, in numpy.

Tokens are words (A-Z lowered) and one end for each text. Counts over all training texts
give the base score and the parts of the model that words too rare for parameters of
their own need: the WORDS most frequent tokens have own vectors and form classes of
CLASS_SIZE by rank; all others are one class, inside which a token's probability is its
smoothed count. P(token | state) = P(class | state) * P(token | class, state), which sums
to one over the vocabulary and one unknown token.

The state starts at zero with a text and is carried through all of it, window by window;
gradients are truncated at the window's start. Texts run side by side in lanes. Training
has two steps: starting weights from at most `first_texts` texts and `first_tokens` tokens of
them in one task, then one pass over all training texts, in which each task runs the state through its texts, takes
a gradient step in every window, and the tasks' weights are averaged by tokens.
Counts of the KNOWN most frequent tokens and the weights are broadcast (a few megabytes,
however large the corpus); counts of all other tokens are joined.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.components import written
from tidelog.llm.words import mix, word_hashes

KNOWN = 1 << 16
WORDS = 2048
CLASS_SIZE = 64
RARE_INPUTS = 64
HIDDEN = 16
FIRST_TEXTS = 3000
FIRST_TOKENS = 3_000_000
SCORED_LANES = 1024
SEED = 20240401
END = mix(np.array([0xE0D], np.uint64))[0]
FLAT = "n_tokens long, known long, rare long, log_model double, log_counts double, log_rare_counts double"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """Of an array that may be overwritten."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


@dataclass
class Vocabulary:
    """Counts of the most frequent tokens by hash, and totals over all training tokens."""

    hashes: np.ndarray
    counts: np.ndarray
    ranks: np.ndarray
    total: int
    distinct: int

    @property
    def rare_mass(self) -> float:
        """Denominator inside the class of rare tokens, the unknown one included."""
        frequent = self.ranks < WORDS
        return self.total - self.counts[frequent].sum() + 0.5 * (self.distinct - frequent.sum() + 1)

    @property
    def base_mass(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    def look_up(self, tokens: np.ndarray) -> np.ndarray:
        """Index into the frequent tokens, -1 for all others."""
        if not len(self.hashes):
            return np.full(len(tokens), -1)
        at = np.minimum(np.searchsorted(self.hashes, tokens), len(self.hashes) - 1)
        return np.where(self.hashes[at] == tokens, at, -1)


def _texts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, token hashes) of each text; every text ends with END."""
    for first, end, hashed, at in word_hashes(column):
        for i in range(end - first):
            yield first + i, np.append(hashed[at[i] : at[i + 1]], END)


def count_tokens(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(token, n) over all texts, combined within batches before the shuffle."""

    def count(batches):
        for batch in batches:
            parts = [t for _, t in _texts(batch.column(0))]
            token, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], ["token", "n"])

    counted = docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return written(spark, counted, "token-counts")


def vocabulary(counts: DataFrame) -> Vocabulary:
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    top = counts.orderBy(F.desc("n"), "token").limit(KNOWN).toArrow()
    token = top["token"].to_numpy().view(np.uint64)
    n = top["n"].to_numpy().astype(float)
    order = np.argsort(token)
    ranks = np.empty(len(token), np.int64)
    ranks[np.lexsort((top["token"].to_numpy(), -n))] = np.arange(len(token))
    return Vocabulary(token[order], n[order], ranks[order], total or 0, distinct)


def _log_softmax(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, picked: np.ndarray):
    """(log probability of the picked column of each row, exponentials of all, their sums)."""
    e = h @ weights
    e += bias
    e -= e.max(1, keepdims=True)
    out = e[np.arange(len(e)), picked]
    np.exp(e, out=e)
    s = e.sum(1, keepdims=True)
    out -= np.log(s[:, 0])
    return out, e, s


class Model:
    """Parameters, one state step, the outputs of a window and their gradients."""

    def __init__(self, vocab: Vocabulary):
        rng = np.random.default_rng(SEED)
        small = lambda *shape: (0.1 * rng.standard_normal(shape)).astype(np.float32)
        n = np.zeros(WORDS)
        frequent = vocab.ranks < WORDS
        n[vocab.ranks[frequent]] = vocab.counts[frequent]
        n[np.arange(WORDS) >= min(WORDS, len(vocab.hashes))] = 1e-9
        classes = WORDS // CLASS_SIZE
        mass = np.append(n.reshape(classes, CLASS_SIZE).sum(1), vocab.rare_mass)
        self.p = {
            "x": small(WORDS + RARE_INPUTS, 3 * HIDDEN),
            "u": small(HIDDEN, 3 * HIDDEN),
            "c": np.zeros((HIDDEN, classes + 1), np.float32),
            "cb": np.log(mass / mass.sum()).astype(np.float32),
            "w": np.zeros((WORDS, HIDDEN), np.float32),
            "wb": np.log(n / n.reshape(classes, CLASS_SIZE).sum(1).repeat(CLASS_SIZE)).astype(np.float32),
        }
        self.m = self.v = None
        self.steps = 0

    def step(self, h: np.ndarray, token: np.ndarray):
        a, b = self.p["x"].take(token, 0), h @ self.p["u"]
        # gate by gate, so that each lies in one piece
        zr = np.empty((2, *h.shape), a.dtype)
        for i in range(2):
            np.add(a[:, i * HIDDEN : (i + 1) * HIDDEN], b[:, i * HIDDEN : (i + 1) * HIDDEN], out=zr[i])
        z, r = _sigmoid(zr)
        hn = b[:, 2 * HIDDEN :]
        n = r * hn
        n += a[:, 2 * HIDDEN :]
        np.tanh(n, out=n)
        h = h - n
        h *= z
        h += n
        return h, (z, r, n, hn)

    def outputs(self, h: np.ndarray, token: np.ndarray, grads: dict | None = None) -> np.ndarray:
        """Natural log probability of each token (of its class alone if rare) given the states.

        With `grads` the gradients of the outputs are added to it, those of h as "h".
        """
        # 16 bits: numpy sorts such numbers by counting
        kind = np.minimum(token // CLASS_SIZE, WORDS // CLASS_SIZE).astype(np.uint16)
        out, e, s = _log_softmax(h, self.p["c"], self.p["cb"], kind)
        if grads is not None:
            e /= -s
            e[np.arange(len(token)), kind] += 1
            grads["c"] += h.T @ e
            grads["cb"] += e.sum(0)
            grads["h"] = e @ self.p["c"].T
        order = np.argsort(kind, kind="stable")
        cuts = np.searchsorted(kind.take(order), np.arange(WORDS // CLASS_SIZE + 1))
        order = order[: cuts[-1]]
        # the tokens of a class lie side by side
        states, insides, inner = h.take(order, 0), token.take(order) % CLASS_SIZE, np.empty(len(order), out.dtype)
        back = None if grads is None else np.empty_like(states)
        for k in range(WORDS // CLASS_SIZE):
            at = slice(cuts[k], cuts[k + 1])
            if cuts[k] == cuts[k + 1]:
                continue
            own = slice(k * CLASS_SIZE, (k + 1) * CLASS_SIZE)
            hk, inside = states[at], insides[at]
            inner[at], e, s = _log_softmax(hk, self.p["w"][own].T, self.p["wb"][own], inside)
            if grads is not None:
                e /= -s
                e[np.arange(len(hk)), inside] += 1
                grads["w"][own] += e.T @ hk
                grads["wb"][own] += e.sum(0)
                np.matmul(e, self.p["w"][own], out=back[at])
        out[order] += inner
        if grads is not None:
            grads["h"][order] += back
        return out

    def learn(
        self, h0: np.ndarray, tokens: np.ndarray, fresh: np.ndarray, rate: float, active: np.ndarray | None = None
    ) -> np.ndarray:
        """One gradient step on a window (time x lanes); returns the state after it.

        At time t the first active[t] lanes hold tokens (never more than before; all if None).
        """
        if active is None:
            active = np.full(len(tokens), tokens.shape[1])
        h, states, kept = h0, [], []
        for t, n in enumerate(active):
            h = h[:n]
            if fresh[t, :n].any():
                h = np.where(fresh[t, :n, None], np.float32(0), h)
            states.append(h)
            h, saved = self.step(h, tokens[t, :n])
            kept.append(saved)
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        flat = np.concatenate([tokens[t, :n] for t, n in enumerate(active)])
        self.outputs(np.concatenate(states), flat, grads)
        from_out = grads.pop("h")
        back = np.zeros_like(h)
        ends = np.cumsum(active)
        inputs = np.empty((len(flat), 3 * HIDDEN), h.dtype)
        for t in range(len(tokens) - 1, -1, -1):
            if len(back) < active[t]:
                back = np.concatenate([back, np.zeros((active[t] - len(back), HIDDEN), back.dtype)])
            z, r, n, hn = kept[t]
            here = slice(ends[t] - active[t], ends[t])
            stay = 1 - z
            dn = back * stay
            dn *= 1 - n * n
            dr = dn * hn
            dr *= r
            dr *= 1 - r
            dz = states[t] - n
            dz *= back
            dz *= z
            dz *= stay
            np.concatenate([dz, dr, dn], 1, out=inputs[here])
            dn *= r
            inner = np.concatenate([dz, dr, dn], 1)
            grads["u"] += states[t].T @ inner
            back = back * z
            back += inner @ self.p["u"].T
            back += from_out[here]
            if fresh[t, : active[t]].any():
                back[fresh[t, : active[t]]] = 0
        order = np.argsort(flat.astype(np.uint16), kind="stable")
        token, first = np.unique(flat.take(order), return_index=True)
        grads["x"][token] = np.add.reduceat(inputs.take(order, 0), first)
        self._climb(grads, 1 / len(flat), rate)
        return h

    def _climb(self, grads: dict, scale: float, rate: float) -> None:
        if self.m is None:
            self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
            self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.steps += 1
        for k, g in grads.items():
            g = g * np.float32(scale)
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.99 * self.v[k] + 0.01 * g * g
            hat = self.m[k] / (1 - 0.9**self.steps)
            self.p[k] = self.p[k] + np.float32(rate) * hat / (np.sqrt(self.v[k] / (1 - 0.99**self.steps)) + 1e-8)

    def packed(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def unpack(self, flat: np.ndarray) -> None:
        at = 0
        for k, v in self.p.items():
            self.p[k] = flat[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size


def _ids(vocab: Vocabulary, tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Own id of the WORDS most frequent tokens, one of RARE_INPUTS shared ids for others."""
    rank = np.where(at >= 0, vocab.ranks[at] if len(vocab.ranks) else WORDS, WORDS)
    return np.where(rank < WORDS, rank, WORDS + (tokens % np.uint64(RARE_INPUTS)).astype(np.int64)).astype(np.int32)


def _lanes(lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lane of each text, its place there, length of lanes): long texts first, lanes sorted."""
    width = max(1, min(width, len(lengths)))
    load = np.zeros(width, np.int64)
    lane, place = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    for first in range(0, len(order), width):
        some = order[first : first + width]
        into = np.argsort(load, kind="stable")[: len(some)]
        lane[some], place[some] = into, load[into]
        load[into] += lengths[some]
    rank = np.argsort(-load, kind="stable")
    new = np.empty(width, np.int64)
    new[rank] = np.arange(width)
    return new[lane], place, load[rank]


def _laid(ids: np.ndarray, lengths: np.ndarray, width: int):
    """Tokens lane after lane: (tokens, first-of-text marks, start of lanes, their lengths, place of each token).

    Takes as much memory as there are tokens, however long the longest text is.
    """
    lane, place, load = _lanes(lengths, width)
    start = np.cumsum(load) - load
    first = start[lane] + place
    at = np.arange(len(ids)) + np.repeat(first - (np.cumsum(lengths) - lengths), lengths)
    tokens, fresh = np.empty(len(ids), np.int32), np.zeros(len(ids), bool)
    tokens[at] = ids
    fresh[first] = True
    return tokens, fresh, start, load, at


def _run(model: Model, ids: np.ndarray, lengths: np.ndarray, width: int, span: int, learn: bool, rate: float) -> np.ndarray | None:
    """Carry the state through all texts; learn in every window, or give log probabilities."""
    tokens, fresh, start, load, places = _laid(ids, lengths, width)
    out = None if learn else np.zeros(len(tokens), np.float32)
    h = np.zeros((len(load), HIDDEN), np.float32)
    for at in range(0, int(load[0]), span):
        times = np.arange(at, min(at + span, int(load[0])))
        # lanes are sorted by length, so those that still hold tokens are the first ones
        active = np.searchsorted(-load, -times, "left")
        n = active[0]
        here = np.minimum(start[:n] + times[:, None], len(tokens) - 1)
        if learn:
            # a window of few tokens moves the weights less: long texts run on alone at the end
            share = active.sum() / (span * len(load))
            h = model.learn(h[:n], tokens[here], fresh[here], rate * share, active)
            continue
        states, targets = [], []
        for row, n in zip(here, active):
            h, now = h[:n], row[:n]
            starts = fresh[now]
            if starts.any():
                h = np.where(starts[:, None], np.float32(0), h)
            states.append(h)
            targets.append(tokens[now])
            h, _ = model.step(h, targets[-1])
        held = np.arange(here.shape[1]) < active[:, None]
        out[here[held]] = model.outputs(np.concatenate(states), np.concatenate(targets))
    return None if learn else out[places]


def _batch_ids(vocab: Vocabulary, column: pa.Array):
    """(token hashes, known index, ids, lengths) of all texts of a batch."""
    parts = [t for _, t in _texts(column)]
    tokens = np.concatenate(parts)
    at = vocab.look_up(tokens)
    return tokens, at, _ids(vocab, tokens, at), np.fromiter(map(len, parts), np.int64, len(parts))


def _trained(
    texts: DataFrame, vocab, start: np.ndarray | None, width: int, span: int, rate: float, passes: int, most: int | None = None
) -> DataFrame:
    """(at, value, weight): each task's weights after its texts, and how many tokens it saw; `most` bounds them."""

    def run(batches):
        model = Model(vocab.value)
        if start is not None:
            model.unpack(start)
        seen = 0
        for batch in batches:
            if len(batch) and not (most and seen >= most):
                _, _, ids, lengths = _batch_ids(vocab.value, batch.column(0))
                if most and seen + len(ids) > most:
                    # texts up to the bound, the last of them as far as it goes
                    ids = ids[: most - seen]
                    ends = np.minimum(np.cumsum(lengths), len(ids))
                    lengths = np.diff(ends, prepend=0)
                    lengths = lengths[lengths > 0]
                for _ in range(passes):
                    _run(model, ids, lengths, width, span, True, rate)
                seen += len(ids)
        if seen:
            flat = model.packed()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat.astype(np.float64)), pa.array(np.full(len(flat), seen, np.float64))],
                ["at", "value", "weight"],
            )

    return texts.select("text").mapInArrow(run, "at int, value double, weight double")


def _averaged(parts: DataFrame) -> np.ndarray | None:
    mean = parts.groupBy("at").agg((F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("value")).toArrow()
    if not len(mean):
        return None
    flat = np.zeros(len(mean), np.float32)
    flat[mean["at"].to_numpy()] = mean["value"].to_numpy()
    return flat


def train(
    spark: SparkSession,
    docs: DataFrame,
    vocab: Vocabulary,
    first_texts: int = FIRST_TEXTS,
    first_tokens: int = FIRST_TOKENS,
) -> Model:
    """Weights learned from all rows of docs (doc_id, text); without rows those of no training."""
    shared = spark.sparkContext.broadcast(vocab)
    # hashes are drawn first, so that only the drawn texts travel to the one task
    hashed = docs.select("text", F.xxhash64("doc_id", "text").alias("at"))
    drawn = written(spark, hashed.select("at").distinct().orderBy("at").limit(first_texts), "sample")
    sample = hashed.join(F.broadcast(drawn), "at").dropDuplicates(["at"]).repartition(1)
    flat = _averaged(_trained(sample.sortWithinPartitions("at"), shared, None, 64, 32, 0.01, 1, first_tokens))
    model = Model(vocab)
    if flat is not None:
        more = _averaged(_trained(docs, shared, flat, 256, 64, 0.002, 1))
        model.unpack(flat if more is None else more)
    return model


def held_out(doc_id, folds: int = 5):
    """Every id whose crc32 leaves 1 is kept from learning."""
    return F.crc32(doc_id.cast("string")) % folds == 1


def score_texts(spark: SparkSession, docs: DataFrame, model: Model, vocab: Vocabulary, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of each row of docs."""
    shared = spark.sparkContext.broadcast((model, vocab))

    def run(batches):
        model, vocab = shared.value
        for batch in batches:
            if not len(batch):
                continue
            tokens, at, ids, lengths = _batch_ids(vocab, batch.column(1))
            text = np.repeat(np.arange(len(lengths)), lengths)
            total = lambda values: np.bincount(text, values, len(lengths))
            log_model = total(_run(model, ids, lengths, SCORED_LANES, 64, False, 0.0)) / np.log(10)
            found, rare = at >= 0, ids >= WORDS
            logs = np.zeros(len(tokens))
            logs[found] = np.log10(vocab.counts[at[found]] + 0.5)
            others, far = [], np.flatnonzero(~found)
            cuts = np.searchsorted(text[far], np.arange(len(lengths) + 1))
            others = pa.ListArray.from_arrays(cuts.astype(np.int32), pa.array(tokens[far].view(np.int64)))
            key = (uuid.uuid4().int >> 66) + np.arange(len(lengths), dtype=np.int64)
            columns = [key, batch.column(0), lengths, total(found).astype(np.int64), total(rare).astype(np.int64), log_model, total(logs), total(logs * rare), others]
            names = ["key", "doc_id", "n_tokens", "known", "rare", "log_model", "log_counts", "log_rare_counts", "others"]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    scored = docs.select("doc_id", "text").mapInArrow(run, f"key long, doc_id long, {FLAT}, others array<long>")
    scored = written(spark, scored, "scored")
    # tokens beyond the broadcast ones meet their counts by a join, once for each text
    others = scored.select("key", F.explode("others").alias("token")).groupBy("key", "token").agg(F.count("*").alias("times"))
    met = others.join(counts, "token", "left").groupBy("key").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("log_others"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known_others"),
    )
    log_others = F.coalesce("log_others", F.lit(0.0))
    base, rare = float(np.log10(vocab.base_mass)), float(np.log10(vocab.rare_mass))
    return scored.drop("others").join(met, "key", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("known_others", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("log_counts") + log_others - F.col("n_tokens") * base).alias("base_score"),
        (F.col("log_model") + F.col("log_rare_counts") + log_others - F.col("rare") * rare).alias("score"),
    )


def score_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Base and model log10 probability of every text, learned from the folds not held out.

    A null text is empty: its only token is the end. A row without doc_id belongs to no
    fold: held_out is null and it teaches nothing. Repeated rows are scored, and teach, as
    often as they occur; other columns are not read. A very long text is one lane from its first
    token to its end and takes memory in proportion to its tokens. If nothing is left to learn from, all
    tokens are unknown and either score gives each token the probability of the only one
    there is, 1.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learning = docs.where(~held_out(F.col("doc_id")))
    counts = count_tokens(spark, learning)
    vocab = vocabulary(counts)
    model = train(spark, learning, vocab)
    out = score_texts(spark, docs, model, vocab, counts)
    return out.withColumn("held_out", held_out(F.col("doc_id")))
