"""Quality of whole texts by attention-based multiple-instance learning.

A text is a bag of passages of `PASSAGE` bytes. Each passage is encoded from its bytes, groups of three bytes and
their variety; a gated attention network gives it a weight among the passages of its text; the weighted sum of the
encodings is the text's representation, and its score the probability of label 1. Only whole texts are labelled:
which passages matter is learnt from that. The network is trained in numpy on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fundloom.llm.common import packed, small_batches, unpacked
from fundloom.llm.langid import may_learn
from fundloom.session import materialize

#: Bytes of a passage, and buckets of its groups of three bytes.
PASSAGE, BUCKETS = 512, 1024
FEATURES = 256 + BUCKETS + 2
#: Widths of the encoding and of the attention.
ENCODED, ATTENDED = 24, 12
#: Labelled documents of each label that the network is fitted on, and passages taken from each.
SAMPLE_DOCS, SAMPLE_PASSAGES = 1024, 12
#: Steps of the fit, whatever the sample's size, documents of a step, step width, weight decay.
UPDATES, BATCH, RATE, DECAY = 600, 64, 0.01, 1e-4
#: Passages that are encoded at once.
WIDE = 1024

#: Encoder, attention (two gates and a vector), classifier: arrays only, so that they travel anywhere.
Weights = list[np.ndarray]


def passages(texts: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of `PASSAGE` bytes, their lengths and the text each belongs to, `WIDE` at a time; an empty text has
    one empty passage."""
    held, count = [], 0
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text)), PASSAGE * WIDE):
            part = np.frombuffer(text, np.uint8, min(PASSAGE * WIDE, len(text) - at), at) if text else np.zeros(0, np.uint8)
            n = max(1, -(-len(part) // PASSAGE))
            rows = np.zeros(n * PASSAGE, np.uint8)
            rows[: len(part)] = part
            lengths = np.full(n, PASSAGE)
            lengths[-1] = len(part) - (n - 1) * PASSAGE
            held.append((rows.reshape(n, PASSAGE), lengths, np.full(n, k)))
            count += n
            if count >= WIDE:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, count = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def features(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each passage the roots of the shares of its bytes and of its groups of three, which part of the
    groups is there again, and its length."""
    n = len(rows)
    wide = rows.astype(np.int32)
    group = wide[:, :-2] * 40503 + wide[:, 1:-1] * 2654435 + wide[:, 2:] * 97
    group = (group ^ (group >> 11)) & 0xFFFF
    real, real_group = np.arange(PASSAGE) < lengths[:, None], np.arange(PASSAGE - 2) < lengths[:, None] - 2
    owner = np.arange(n)[:, None]
    x = np.zeros((n, FEATURES), np.float32)
    x[:, :256] = np.bincount((owner * 257 + np.where(real, wide, 256)).ravel(), minlength=n * 257).reshape(n, 257)[:, :256]
    size = BUCKETS + 1
    bucket = np.where(real_group, group & (BUCKETS - 1), BUCKETS)
    x[:, 256:-2] = np.bincount((owner * size + bucket).ravel(), minlength=n * size).reshape(n, size)[:, :-1]
    count = np.maximum(lengths, 1)[:, None]
    x[:, :-2] = np.sqrt(x[:, :-2] / count)
    ordered = np.sort(np.where(real_group, group, 0x10000), axis=1)
    different = (ordered[:, 1:] != ordered[:, :-1]).sum(axis=1) + 1 - (lengths < PASSAGE)
    x[:, -2] = 4 * np.where(lengths > 2, 1 - different / np.maximum(lengths - 2, 1), 0.0)
    x[:, -1] = np.log1p(lengths) / np.log1p(PASSAGE)
    return x


def encode(w: Weights, x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Encodings of passages, the two sides of the attention's gate, and its value before it is shared out."""
    h = np.tanh(x @ w[0] + w[1])
    t, g = np.tanh(h @ w[2]), 1 / (1 + np.exp(-(h @ w[3])))
    return h, t, g, (t * g) @ w[4]


def shares(e: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Attention of each passage among those of its text; passages of a text stand together."""
    a = np.exp(e - np.maximum.reduceat(e, starts)[owner])
    return a / np.add.reduceat(a, starts)[owner]


def gradient(w: Weights, x: np.ndarray, owner: np.ndarray, y: np.ndarray) -> tuple[float, Weights]:
    """Mean loss (negative log likelihood) over texts and its slope in every weight."""
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    h, t, g, e = encode(w, x)
    a = shares(e, starts, owner)
    z = np.add.reduceat(a[:, None] * h, starts)
    logit = z @ w[5] + w[6][0]
    loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
    d_logit = (1 / (1 + np.exp(-logit)) - y) / len(y)
    d_z = np.outer(d_logit, w[5])[owner]
    d_a = (d_z * h).sum(axis=1)
    d_e = a * (d_a - np.add.reduceat(a * d_a, starts)[owner])
    d_gate = np.outer(d_e, w[4])
    d_t, d_g = d_gate * g * (1 - t * t), d_gate * t * g * (1 - g)
    d_h = (a[:, None] * d_z + d_t @ w[2].T + d_g @ w[3].T) * (1 - h * h)
    return loss, [
        x.T @ d_h, d_h.sum(axis=0), h.T @ d_t, h.T @ d_g, (t * g).T @ d_e, z.T @ d_logit, np.array([d_logit.sum()])
    ]


def train(bags: Sequence[Sequence[bytes]], labels: Sequence[int], shift: float = 0.0, seed: int = 7) -> Weights:
    """Weights from bags of passages with 0/1 labels, both of which occur. `shift` is added to the offset: the log odds of the labels
    where the bags are from, over those among the bags. Same input, same weights."""
    rng = np.random.default_rng(seed)
    shapes = [(FEATURES, ENCODED), (ENCODED,), (ENCODED, ATTENDED), (ENCODED, ATTENDED), (ATTENDED,), (ENCODED,), (1,)]
    scale = [0.3, 0, ENCODED**-0.5, ENCODED**-0.5, ATTENDED**-0.5, ENCODED**-0.5, 0]
    w = [rng.normal(0, s, shape).astype(np.float32) if s else np.zeros(shape, np.float32) for s, shape in zip(scale, shapes)]
    flat = [p for bag in bags for p in bag]
    rows = np.zeros((len(flat), PASSAGE), np.uint8)
    lengths = np.array([len(p) for p in flat])
    for i, p in enumerate(flat):
        rows[i, : len(p)] = np.frombuffer(p, np.uint8)
    x = np.concatenate([features(rows[i : i + WIDE], lengths[i : i + WIDE]) for i in range(0, len(flat), WIDE)])
    ends = np.cumsum([len(bag) for bag in bags])
    y = np.array(labels, np.float32)
    first, second, count = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w], 0
    while count < UPDATES:
        order = rng.permutation(len(bags))
        for at in range(0, len(bags), BATCH):
            take = order[at : at + BATCH]
            use = np.concatenate([np.arange(ends[k] - len(bags[k]), ends[k]) for k in take])
            owner = np.repeat(np.arange(len(take)), [len(bags[k]) for k in take])
            _, slope = gradient(w, x[use], owner, y[take])
            count += 1
            pace = RATE * max(0.1, 1 - 0.9 * count / UPDATES) * np.sqrt(1 - 0.999**count) / (1 - 0.9**count)
            for i, g in enumerate(slope):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                w[i] = (w[i] * (1 - RATE * DECAY) - pace * first[i] / (np.sqrt(second[i]) + 1e-8)).astype(np.float32)
    w[6] = w[6] + np.float32(shift)
    return w


def scores(w: Weights, texts: Sequence[bytes]) -> np.ndarray:
    """Probability of label 1 of each whole text."""
    encoded, valued, owners = [], [], []
    for rows, lengths, owner in passages(texts):
        h, _, _, e = encode(w, features(rows, lengths))
        encoded.append(h)
        valued.append(e)
        owners.append(owner)
    if not owners:
        return np.zeros(0)
    h, e, owner = np.concatenate(encoded), np.concatenate(valued), np.concatenate(owners)
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    z = np.add.reduceat(shares(e, starts, owner)[:, None] * h, starts)
    return 1 / (1 + np.exp(-(z @ w[5] + w[6][0]).astype(np.float64)))


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> Weights | float:
    """Weights from labelled documents that are not held out; without both labels the share of label 1 (0.5 of none).

    A key with several labels has the more frequent one, and none if they are even; null labels and keys count for
    nothing. The sample has at most `SAMPLE_DOCS` documents of each label, those with the least hash in so many hash
    buckets, and of each at most `SAMPLE_PASSAGES` passages that lie evenly over the whole text. What reaches the
    driver is bounded by 2 x SAMPLE_DOCS x SAMPLE_PASSAGES x PASSAGE bytes. The labels' odds are those of all.
    """
    known = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("double").alias("label"))
    known = known.where(may_learn(F.col("key")) & F.col("key").isNotNull() & F.col("label").isNotNull())
    known = known.groupBy("key").agg(F.avg("label").alias("label")).where(F.col("label") != 0.5)
    known = known.select("key", (F.col("label") > 0.5).cast("int").alias("label"))
    there = docs.select(F.col(f"`{key}`").alias("key")).where(F.col("key").isNotNull()).distinct()
    known = materialize(known.join(there, "key"))
    odds = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(odds) < 2:
        return 0.5 if not odds else float(1 in odds)
    mixed = F.xxhash64("key")
    chosen = known.groupBy("label", F.pmod(mixed, F.lit(SAMPLE_DOCS)).alias("bucket")).agg(
        F.min(F.struct(mixed.alias("hash"), "key")).alias("least")
    )
    chosen = chosen.select("label", F.col("least.key").alias("key"))  # no more than 2 x SAMPLE_DOCS rows
    whole = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    spare = F.greatest(F.octet_length("whole") - PASSAGE, F.lit(0))
    most = F.greatest(F.lit(1), F.least(F.lit(SAMPLE_PASSAGES), F.ceil(F.octet_length("whole") / PASSAGE)))
    steps = [F.floor(spare * i / F.greatest(most - 1, F.lit(1))) + 1 for i in range(SAMPLE_PASSAGES)]
    starts = F.array(*[F.when(i < most, s) for i, s in enumerate(steps)])
    sample = (
        docs.select(F.col(f"`{key}`").alias("key"), whole.alias("whole"))
        .join(F.broadcast(chosen), "key")
        .groupBy("label", "key")
        .agg(F.min("whole").alias("whole"))  # of rows that repeat a key, one
        .select("label", "key", F.explode(F.array_compact(starts)).alias("start"), "whole")
        .select("label", "key", "start", F.expr(f"substring(whole, CAST(start AS INT), {PASSAGE})").alias("passage"))
    )
    bags: dict[tuple, list[bytes]] = {}
    for r in sorted(sample.collect(), key=lambda r: (r.label, r.key, r.start)):
        bags.setdefault((r.label, r.key), []).append(bytes(r.passage))
    taken = [label for label, _ in bags]
    shift = np.log(odds[1] / odds[0]) - np.log(sum(taken) / (len(taken) - sum(taken)))
    return train(list(bags.values()), taken, float(shift))


def score(spark: SparkSession, fitted: Weights | float, text: Column) -> Column:
    """Score (0 to 1) of each whole text; null counts as empty."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(fitted)

    @F.arrow_udf("double")
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w = shared.value
        for batch in batches:
            if isinstance(w, float):
                yield pa.array(np.full(len(batch), w))
            else:
                yield pa.array(scores(w, [t.as_py() or b"" for t in batch]).round(6))

    return rate(text.cast("binary"))


def rate_documents(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    least: float = 0.5,
    fitted: Weights | float | None = None,
) -> DataFrame:
    """`docs` with `held_out`, `score` and `predicted` (1 from `least` on); columns of these names are replaced.

    The network is fitted on the labelled documents that are not held out, unless one is given. Labels, keys and
    other columns are no inputs of a score: equal texts get equal ones. Every row stays; null and empty texts have
    the score of one empty passage. Without labels, or with one label only, all scores are the share of label 1.
    """
    net = fit(docs, labels, key, text, label) if fitted is None else fitted
    found = packed(docs, found=score(docs.sparkSession, net, F.col(f"`{text}`")), held_out=~may_learn(F.col(f"`{key}`")))
    return unpacked(
        found, docs, held_out=F.col("held_out"), score=F.col("found"), predicted=(F.col("found") >= least).cast("int")
    )
