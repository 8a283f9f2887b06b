"""Language of whole texts by a bidirectional gated recurrent network over bytes.

The network reads a text as stretches of `STEPS` bytes, labels every byte with a probability for each
language, and a document's probability is the mean over its bytes. It is trained in numpy by
backpropagation through time on a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fundloom.llm.common import packed, small_batches, unpacked

#: Bytes that one run of the network reads; its state starts anew with each stretch.
STEPS = 64
#: Width of the state in each direction.
HIDDEN = 8
#: Labelled documents of each language that the network is fitted on, and stretches taken from each.
SAMPLE_DOCS, SAMPLE_STRETCHES = 256, 6
#: Steps of the fit, whatever the sample's size, and stretches of a step.
UPDATES, BATCH, RATE = 100, 512, 0.03
#: Stretches that are read at once.
WIDE = 4096
UNKNOWN = "und"


def _soft_sign(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place: the network's curve between -1 and 1, cheaper than tanh."""
    size = np.abs(x)
    size += 1
    x /= size
    return x


def _gate(x: np.ndarray) -> np.ndarray:
    """Between 0 and 1, in place."""
    _soft_sign(x)
    x *= 0.5
    x += 0.5
    return x


@dataclass
class Network:
    """Weights: for each direction a row of gate inputs for each byte and a square of state weights."""

    languages: list[str]
    inputs: list[np.ndarray]  # 2 x (256, 3 HIDDEN): update, reset and candidate
    states: list[np.ndarray]  # 2 x (HIDDEN, 3 HIDDEN)
    output: np.ndarray  # (2 HIDDEN, languages)
    offset: np.ndarray  # (languages,)

    def __post_init__(self):
        split = lambda w: [np.ascontiguousarray(part) for part in np.split(w, 3, axis=1)]
        self.tables = [split(w) for w in self.inputs]
        self.squares = [split(w) for w in self.states]
        self.labels = [np.ascontiguousarray(w.T) for w in np.split(self.output, 2)]

    def step(self, d: int, x: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The next state; rows are stretches."""
        rows, squares = self.tables[d], self.squares[d]
        z = rows[0].take(x, axis=0)
        z += h @ squares[0]
        r = rows[1].take(x, axis=0)
        r += h @ squares[1]
        n = h @ squares[2]
        n *= _gate(r)
        n += rows[2].take(x, axis=0)
        _soft_sign(n)
        h = h - n
        h *= _gate(z)
        h += n
        return h

    def sums(self, x: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Of each stretch (a column of x, with `length` bytes) the probabilities, summed over its bytes."""
        steps, wide = x.shape
        h = np.zeros((wide, HIDDEN), np.float32)
        ahead = np.empty((steps, wide, HIDDEN), np.float32)
        for t in range(steps):
            h = ahead[t] = self.step(0, x[t], h)
        h = np.zeros((wide, HIDDEN), np.float32)
        total = np.zeros((len(self.languages), wide), np.float32)
        for t in reversed(range(steps)):
            real = (length > t).astype(np.float32)
            h = self.step(1, x[t], h)
            h *= real[:, None]
            p = self.labels[0] @ ahead[t].T
            p += self.labels[1] @ h.T
            p += self.offset[:, None]
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p *= real / p.sum(axis=0)
            total += p
        return total

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages): the mean over all bytes of each text, which is not empty."""
        result = np.zeros((len(texts), len(self.languages)))
        for pieces, owners, lengths in _stretches(texts):
            sums = self.sums(np.ascontiguousarray(pieces.T).astype(np.intp), lengths)
            for c in range(len(self.languages)):
                result[:, c] += np.bincount(owners, sums[c], len(texts))
        return result / np.array([len(t) for t in texts])[:, None]


def _stretches(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes in rows of `STEPS`, the text each row belongs to and its number of bytes, `WIDE` rows at a time."""
    pieces, owners, lengths, held = [], [], [], 0
    for k, text in enumerate(texts):
        for at in range(0, len(text), STEPS * WIDE):
            part = np.frombuffer(text, np.uint8, min(STEPS * WIDE, len(text) - at), at)
            n = -(-len(part) // STEPS)
            rows = np.zeros(n * STEPS, np.uint8)
            rows[: len(part)] = part
            size = np.full(n, STEPS)
            size[-1] = len(part) - (n - 1) * STEPS
            pieces.append(rows.reshape(n, STEPS))
            owners.append(np.full(n, k))
            lengths.append(size)
            held += n
            if held >= WIDE:
                yield np.concatenate(pieces), np.concatenate(owners), np.concatenate(lengths)
                pieces, owners, lengths, held = [], [], [], 0
    if held:
        yield np.concatenate(pieces), np.concatenate(owners), np.concatenate(lengths)


def _forward(x, inputs, state):
    """States of one direction, (steps + 1, rows, HIDDEN), and what the way back needs of each step."""
    k, kept = HIDDEN, []
    h = np.zeros((x.shape[1], k), np.float32)
    states = [h]
    for t in range(len(x)):
        a, g = inputs[x[t]], h @ state
        gates = _gate(a[:, : 2 * k] + g[:, : 2 * k])
        z, r, u = gates[:, :k], gates[:, k:], g[:, 2 * k :]
        n = _soft_sign(a[:, 2 * k :] + r * u)
        kept.append((z, r, u, n))
        h = n + z * (h - n)
        states.append(h)
    return states, kept


def _backward(x, states, kept, state, grads):
    """Gradients of the input rows and the state weights of one direction by backpropagation through time.

    The slope of x / (1 + |x|) is (1 - |value|)^2.
    """
    k = HIDDEN
    d_state = np.zeros_like(state)
    d_rows = np.empty((len(x), x.shape[1], 3 * k), np.float32)
    d_h = np.zeros_like(states[0])
    for t in reversed(range(len(x))):
        z, r, u, n = kept[t]
        h = states[t]
        d_h = d_h + grads[t]
        d_z = d_h * (h - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
        d_n = d_h * (1 - z) * (1 - np.abs(n)) ** 2
        d_r = d_n * u * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
        d_g = np.concatenate([d_z, d_r, d_n * r], axis=1)
        d_rows[t, :, : 2 * k] = d_g[:, : 2 * k]
        d_rows[t, :, 2 * k :] = d_n
        d_state += h.T @ d_g
        d_h = d_h * z + d_g @ state.T
    flat, byte = d_rows.reshape(-1, 3 * k), x.ravel()
    d_inputs = np.stack([np.bincount(byte, flat[:, c], 256) for c in range(3 * k)], axis=1)
    return d_inputs.astype(np.float32), d_state


def train(stretches: list[bytes], labels: list[str], seed: int = 7) -> Network | None:
    """A network for the languages among the labels; none without a stretch. Same input, same network."""
    rows = [(s, label) for s, label in zip(stretches, labels) if s]
    if not rows:
        return None
    languages = sorted({label for _, label in rows})
    rng = np.random.default_rng(seed)
    k, c = HIDDEN, len(languages)
    scale = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    w = [scale(256, 3 * k), scale(256, 3 * k), scale(k, 3 * k), scale(k, 3 * k), scale(2 * k, c)]
    w.append(np.zeros(c, np.float32))
    x_all = np.zeros((len(rows), STEPS), np.uint8)
    length = np.array([len(s) for s, _ in rows])
    for i, (s, _) in enumerate(rows):
        x_all[i, : len(s)] = np.frombuffer(s, np.uint8)
    y_all = np.searchsorted(languages, [label for _, label in rows])
    first, second, count = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w], 0
    while count < UPDATES:
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            take = order[at : at + BATCH]
            x = np.ascontiguousarray(x_all[take].T)
            real = (np.arange(STEPS)[:, None] < length[take]).astype(np.float32)[:, :, None]
            ahead, kept_a = _forward(x, w[0], w[2])
            # A stretch is read backwards from its own last byte: what stands behind it is left out.
            flip = (length[take] - 1 - np.arange(STEPS)[:, None]) % STEPS
            back, kept_b = _forward(np.take_along_axis(x, flip, 0), w[1], w[3])
            h_a = np.stack(ahead[1:])
            h_b = np.take_along_axis(np.stack(back[1:]), flip[:, :, None], 0)
            h = np.concatenate([h_a, h_b], axis=2)
            p = h @ w[4] + w[5]
            p = np.exp(p - p.max(axis=2, keepdims=True))
            p /= p.sum(axis=2, keepdims=True)
            p[:, np.arange(len(take)), y_all[take]] -= 1
            p *= real / real.sum()
            d_h = p @ w[4].T
            g_a = _backward(x, ahead, kept_a, w[2], d_h[:, :, :k])
            d_b = np.take_along_axis(np.ascontiguousarray(d_h[:, :, k:]), flip[:, :, None], 0)
            g_b = _backward(np.take_along_axis(x, flip, 0), back, kept_b, w[3], d_b)
            d_out = np.tensordot(h, p, axes=([0, 1], [0, 1]))
            grads = [g_a[0], g_b[0], g_a[1], g_b[1], d_out, p.sum(axis=(0, 1))]
            count += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.99 * second[i] + 0.01 * g * g
                pace = RATE * np.sqrt(1 - 0.99**count) / (1 - 0.9**count)
                w[i] = (w[i] - pace * first[i] / (np.sqrt(second[i]) + 1e-8)).astype(np.float32)
    return Network(languages, w[:2], w[2:4], w[4], w[5])


def may_learn(key: Column) -> Column:
    """False for held-out documents: crc32 of the key as text leaves 1 modulo 3. A null key is text `""`."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 != 1


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """Train on stretches of at most `SAMPLE_DOCS` labelled documents of each language that are not held out.

    The sample is the document with the least hash in each of so many hash buckets of its language, so it is
    the same on every run and a frequent language costs a map-side minimum. Stretches lie evenly over the
    whole text. What reaches the driver is bounded by languages x SAMPLE_DOCS x SAMPLE_STRETCHES x STEPS bytes.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(may_learn(F.col("key")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    mixed = F.xxhash64(F.col("key"))
    chosen = (
        rows.groupBy("lang", F.pmod(mixed, F.lit(SAMPLE_DOCS)).alias("bucket"))
        .agg(F.min(F.struct(mixed.alias("hash"), "key")).alias("least"))
        .select(F.col("lang").alias("_lang"), F.col("least.key").alias("_key"))
    )
    whole = F.col("text").cast("binary")
    spare = F.greatest(F.octet_length(whole) - STEPS, F.lit(0))
    starts = F.array(*[F.floor(spare * (i / (SAMPLE_STRETCHES - 1))) + 1 for i in range(SAMPLE_STRETCHES)])
    texts = (
        rows.join(chosen, F.col("key").eqNullSafe(F.col("_key")) & (F.col("lang") == F.col("_lang")))
        .groupBy("lang", "key")
        .agg(F.min("text").alias("text"))  # of rows that repeat a key, one
        .select("lang", "key", F.explode(F.array_distinct(starts)).alias("start"), whole.alias("bytes"))
        .select("lang", "key", "start", F.expr(f"substring(bytes, CAST(start AS INT), {STEPS})").alias("stretch"))
    )
    sample = sorted((r.lang, r.key is not None, r.key or 0, r.start, bytes(r.stretch)) for r in texts.collect())
    return train([s for *_, s in sample], [s[0] for s in sample])


def language(spark: SparkSession, network: Network | None, text: Column) -> Column:
    """Struct of `lang` and `score` (0 to 1); `und` with 0 for a text that is null or has no letter."""
    small_batches(spark)
    # plain arrays: an instance would be unpickled by its module's name, which executors do not have
    parts = network and (network.languages, network.inputs, network.states, network.output, network.offset)
    weights = spark.sparkContext.broadcast(parts)

    @F.arrow_udf("struct<lang:string,score:double>")
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = weights.value and Network(*weights.value)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch]
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            use = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))] if net else []
            if use:
                p = net.probabilities([texts[i].encode() for i in use])
                best = p.argmax(axis=1)
                for i, c, value in zip(use, best.tolist(), p.max(axis=1).tolist()):
                    lang[i], score[i] = net.languages[c], min(1.0, max(0.0, round(value, 6)))
            yield pa.StructArray.from_arrays([pa.array(lang), pa.array(score)], ["lang", "score"])

    return label(text)


def identify(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", network: Network | None = None
) -> DataFrame:
    """`docs` with `held_out`, `lang_pred` and `score`; columns of these names are replaced.

    The network is fitted on the labelled documents of `docs` that are not held out, unless one is given.
    Labels, sources and keys are no inputs of a prediction: equal texts get equal ones. Every row stays; a
    text that is null or without letters is `und`, and so is every text if there is nothing to learn from.
    """
    net = network or fit(docs, key, text, lang)
    found = packed(docs, found=language(docs.sparkSession, net, F.col(text)), held_out=~may_learn(F.col(key)))
    return unpacked(
        found, docs, held_out=F.col("held_out"), lang_pred=F.col("found.lang"), score=F.col("found.score")
    )


def in_known_language(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """`docs` without those that have no language: no letters, or a score below `least`, hardly above chance."""
    net = fit(docs)
    found = packed(docs, found=language(docs.sparkSession, net, F.col("text")))
    return unpacked(found.where((F.col("found.lang") != UNKNOWN) & (F.col("found.score") >= least)), docs)
