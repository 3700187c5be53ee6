"""Toxic spans and document scores from a linear-chain conditional random field.

Each word of a document has one of two states, clean or toxic. The field's weights are on
features of the word itself (the whole word, its first and last letters) and on pairs of
neighbouring states. Forward and backward messages over the whole document give each word's
probability of being toxic; runs of words at 0.5 or more are the offending spans, and the
largest probability together with the sum of the probabilities of such words gives the document's score.

**Labelled tokens.** Labels are given for documents. A word of a toxic document counts as a
toxic token if the word, or its first letters, stand in toxic documents of the sample
much more often than their share in clean ones allows; all other words are clean tokens.

**Fitting** uses a sample that does not grow with the data: at most `per_class` labelled documents of each class,
those with the smallest hash of doc_id, and of these the ones of at most `max_chars`
characters. The sample is gathered in one task and the model is a few arrays of fixed size. Scoring
reads every text in full. lang, source and doc_id are never features.

Null and empty texts have no words and get the score of a document without a toxic word. A
sample without toxic documents, or without clean ones, gives every document the score 0.
Labels that are null, or other than 0 and 1, are left out; of contradicting labels of one
doc_id the toxic one holds. Repeated rows and extra columns change nothing.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partyfold.llm.words import ALNUM, U64, SpanHash, Texts, Words, mix, pieces, words
from partyfold.llm import words as _words

BITS = 18
SEGMENT = 128
_WINDOW = 24
_KINDS = ("word", "first3", "first4", "first5", "last3", "last4")


# Features


def feature_hashes(found: Words) -> np.ndarray:
    """One row per feature kind, one column per word; 64-bit hashes."""
    spans = SpanHash(_words._byte_values(), found.symbols)
    starts, ends = found.starts, found.ends
    rows = [spans.of(starts, ends)]
    rows += [spans.of(starts, np.minimum(starts + k, ends)) for k in (3, 4, 5)]
    rows += [spans.of(np.maximum(starts, ends - k), ends) for k in (3, 4)]
    return np.stack([mix(h + U64(1 + kind)) for kind, h in enumerate(rows)])


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U64(64 - BITS)).astype(np.int64)


# The chain


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    bias: float = 0.0
    pair: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    calibration: tuple[float, float, float] | None = None

    def emissions(self, found: Words) -> np.ndarray:
        """Log-odds of the toxic state from each word alone."""
        if not len(found.starts):
            return np.zeros(0)
        total = np.full(len(found.starts), self.bias)
        for row in slots(feature_hashes(found)):
            total += self.weights[row]
        return np.clip(total, -30, 30)

    def score(self, strongest: np.ndarray, mass: np.ndarray) -> np.ndarray:
        if self.calibration is None:
            return np.zeros(len(strongest))
        a, b, c = self.calibration
        return 1 / (1 + np.exp(-(a + b * strongest + c * np.log1p(mass))))


def marginals(emissions: np.ndarray, of_text: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Each word's probability of the toxic state.

    Texts are cut into segments of equal length that advance together: first the product of
    each segment's transfer matrices, then the messages at the segments' borders, then the
    messages within. The result is that of one pass over each whole text.
    """
    n = len(emissions)
    if not n:
        return np.zeros(0)
    move = np.exp(pair)
    odds = np.exp(emissions)
    counts = np.diff(of_text)
    per_text = -(-counts // SEGMENT)
    text = np.repeat(np.arange(len(counts)), per_text)
    rank = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    start = of_text[text] + rank * SEGMENT
    size = np.minimum(SEGMENT, of_text[text + 1] - start)
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    active = [int(np.searchsorted(-size, -k, side="left")) for k in range(SEGMENT)]
    longest = int(size.max(initial=0))

    product = np.tile(np.eye(2), (len(start), 1, 1))
    for k in range(longest):
        m = active[k]
        new = product[:m] @ move
        new[:, :, 1] *= odds[start[:m] + k][:, None]
        product[:m] = new / new.sum(axis=(1, 2), keepdims=True)

    first = np.cumsum(per_text) - per_text
    entry = np.zeros((len(start), 2))
    leave = np.ones((len(start), 2))
    by_rank = np.argsort(-per_text, kind="stable")
    texts_with = [int(np.searchsorted(-per_text[by_rank], -r, side="left")) for r in range(int(per_text.max()) + 1)]
    state = np.tile([1.0, 0.0], (len(counts), 1))
    for r in range(int(per_text.max())):
        own = by_rank[: texts_with[r]]
        at = place[first[own] + r]
        entry[at] = state[own]
        new = np.einsum("si,sij->sj", state[own], product[at])
        state[own] = new / new.sum(axis=1, keepdims=True)
    state = np.ones((len(counts), 2))
    for r in range(int(per_text.max()) - 1, -1, -1):
        own = by_rank[: texts_with[r]]
        at = place[first[own] + r]
        leave[at] = state[own]
        new = np.einsum("sij,sj->si", product[at], state[own])
        state[own] = new / new.sum(axis=1, keepdims=True)

    forward = np.empty((n, 2))
    now = entry
    for k in range(longest):
        m = active[k]
        at = start[:m] + k
        now = now[:m] @ move
        now[:, 1] *= odds[at]
        now /= now.sum(axis=1, keepdims=True)
        forward[at] = now
    result = np.empty(n)
    now = leave
    for k in range(longest - 1, -1, -1):
        m = active[k]
        at = start[:m] + k
        both = forward[at] * now[:m]
        result[at] = both[:, 1] / both.sum(axis=1)
        back = now[:m].copy()
        back[:, 1] *= odds[at]
        back = back @ move.T
        now[:m] = back / back.sum(axis=1, keepdims=True)
    return result


def log_likelihood(emissions: np.ndarray, states: np.ndarray, mask: np.ndarray, pair: np.ndarray):
    """Of padded rows: the gradients by emission and by pair, and the likelihood itself."""
    rows, length = emissions.shape
    move, odds = np.exp(pair), np.exp(emissions)
    forward = np.zeros((length + 1, rows, 2))
    forward[0] = [1.0, 0.0]
    scale = np.zeros(rows)
    for k in range(length):
        new = forward[k] @ move
        new[:, 1] *= odds[:, k]
        total = new.sum(axis=1, keepdims=True)
        on = mask[:, k : k + 1]
        forward[k + 1] = np.where(on, new / total, forward[k])
        scale += np.where(on[:, 0], np.log(total[:, 0]), 0)
    back = np.ones((rows, 2))
    by_emission, by_pair = np.zeros((rows, length)), np.zeros((2, 2))
    previous = np.concatenate([np.zeros((rows, 1), int), states[:, :-1]], axis=1)
    for k in range(length - 1, -1, -1):
        on = mask[:, k]
        here = back.copy()
        here[:, 1] *= odds[:, k]
        joint = forward[k][:, :, None] * move[None] * here[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        by_emission[:, k] = np.where(on, (states[:, k] == 1) - joint[:, :, 1].sum(axis=1), 0)
        expected = joint[on].sum(axis=0)
        np.subtract(by_pair, expected, out=by_pair)
        np.add.at(by_pair, (previous[on, k], states[on, k]), 1)
        before = here @ move.T
        back = np.where(on[:, None], before / before.sum(axis=1, keepdims=True), back)
    chosen = np.where(mask, emissions * states + pair[previous, states], 0).sum()
    return by_emission, by_pair, chosen - scale.sum()


# Fitting


def _token_labels(
    hashes: np.ndarray, text: np.ndarray, toxic: np.ndarray, ratio: float, least: int, part: float
):
    """Toxic tokens of a sample: words of toxic texts with strong evidence.

    The evidence of a feature is the number of toxic texts that hold it, if these are `least`
    and `ratio` times what its share in clean ones allows, both smoothed. A word's is that of its
    best feature, and it needs `part` of the strongest in its text: chance companions of a
    toxic word have a few texts where that word has many.
    """
    evidence = np.zeros(hashes.shape[1])
    share = max(toxic.sum(), 1) / max((~toxic).sum(), 1)
    for row in hashes[[0, 2, 3]]:
        _, feature = np.unique(row, return_inverse=True)
        once = np.unique(feature * np.int64(len(toxic)) + text)
        own, doc = np.divmod(once, len(toxic))
        bad = np.bincount(own[toxic[doc]], minlength=feature.max() + 1)
        good = np.bincount(own[~toxic[doc]], minlength=feature.max() + 1)
        strong = (bad >= least) & (bad >= ratio * share * (good + 0.5))
        evidence = np.maximum(evidence, np.where(strong, bad, 0)[feature])
    strongest = np.zeros(len(toxic))
    np.maximum.at(strongest, text, evidence)
    return (evidence > 0) & (evidence >= part * strongest[text]) & toxic[text]


def fit_sample(
    texts: list[str], toxic: list[int], rounds: int = 30, rate: float = 0.4, decay: float = 1e-4,
    ratio: float = 8.0, least: int = 3, part: float = 0.25, calibrating: int = 4,
) -> Model:
    """A model from the texts of a sample, the same for the same sample in the same order.

    Copies count once. Every `calibrating`-th text is kept from the field and fits the
    scores of texts to the probabilities of words.
    """
    texts, toxic = zip(*sorted(dict(zip(texts, toxic)).items())) if texts else ((), ())
    label = np.array(toxic, bool)
    if not label.any() or label.all():
        return Model()
    portions = list(pieces(pa.array(texts, pa.large_string())))
    found = [words(p, ALNUM) for p in portions]
    hashes = np.concatenate([feature_hashes(w) for w in found], axis=1)
    counts = np.concatenate([np.diff(w.of_text) for w in found])
    of_text = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(counts)), counts)
    if not len(text):
        return Model()
    kept_out = np.arange(len(label)) % calibrating == 0
    if label[kept_out].all() or not label[kept_out].any() or label[~kept_out].all() or not label[~kept_out].any():
        kept_out[:] = False  # too few for two parts
    fitted = label & ~kept_out
    known = ~kept_out[text]
    token = np.zeros(len(text), bool)
    number = np.cumsum(~kept_out) - 1
    token[known] = _token_labels(
        hashes[:, known], number[text[known]], fitted[~kept_out], ratio, least, part
    )
    model = Model()

    # Windows of equal length: all that hold a toxic token, and as many others.
    start = np.concatenate([np.arange(a, b, _WINDOW) for a, b in zip(of_text[:-1], of_text[1:])])
    end = np.minimum(start + _WINDOW, of_text[text[start] + 1])
    seen = np.concatenate([[0], np.cumsum(token)])
    holds = seen[end] > seen[start]
    others = np.flatnonzero(~holds & ~kept_out[text[start]])
    step = max(1, len(others) // max(int(holds.sum()), 2000))
    chosen = np.sort(np.concatenate([np.flatnonzero(holds), others[::step]]))
    at = start[chosen][:, None] + np.arange(_WINDOW)
    mask = at < end[chosen][:, None]
    at = np.minimum(at, len(text) - 1)
    where = slots(hashes)[:, at]
    states = np.where(mask, token[at], 0).astype(int)
    weights = np.zeros(1 << BITS)
    power = np.full(1 << BITS, 1e-8)
    bias, bias_power, pair_power = -2.0, 1e-8, np.full((2, 2), 1e-8)
    pair = np.zeros((2, 2))
    for _ in range(rounds):
        emissions = np.clip(bias + weights[where].sum(axis=0), -30, 30)
        by_emission, by_pair, _ = log_likelihood(emissions, states, mask, pair)
        gradient = np.zeros(1 << BITS)
        for row in where:
            gradient += np.bincount(row.ravel(), by_emission.ravel(), 1 << BITS)
        gradient -= decay * len(chosen) * weights
        power += gradient**2
        weights += rate * gradient / np.sqrt(power)
        bias_gradient = by_emission.sum()
        bias_power += bias_gradient**2
        bias += rate * bias_gradient / np.sqrt(bias_power)
        by_pair -= decay * len(chosen) * pair
        pair_power += by_pair**2
        pair += rate * by_pair / np.sqrt(pair_power)
        pair[0, 0] = 0.0
    model.weights, model.bias, model.pair = weights.astype(np.float32), float(bias), pair

    strongest, mass = [], []
    for portion, own in zip(portions, found):
        s, m = summaries(own, marginals(model.emissions(own), own.of_text, pair))
        strongest.append(s)
        mass.append(m)
    judging = kept_out if kept_out.any() else ~kept_out
    model.calibration = _logistic(
        np.concatenate(strongest)[judging], np.concatenate(mass)[judging], label[judging]
    )
    return model


def summaries(found: Words, probability: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the log-odds of its likeliest toxic word, and the mass of likely ones."""
    text = np.repeat(np.arange(len(found.of_text) - 1), np.diff(found.of_text))
    strongest = np.full(len(found.of_text) - 1, 1e-9)
    np.maximum.at(strongest, text, probability)
    strongest = np.clip(strongest, 1e-9, 1 - 1e-9)
    likely = probability >= 0.5
    mass = np.bincount(text[likely], probability[likely], len(strongest))
    return np.clip(np.log(strongest / (1 - strongest)), -8, 8), mass


def _logistic(strongest: np.ndarray, mass: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    x = np.stack([np.ones(len(label)), strongest, np.log1p(mass)], axis=1)
    w = np.zeros(3)
    for _ in range(50):  # Newton steps with a small penalty
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (label - p) - 0.1 * w
        curvature = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        w = w + np.linalg.solve(curvature, gradient)
    return tuple(float(v) for v in w)


def fold(doc_id: Column, folds: int = 5) -> Column:
    """The documents with remainder 0 are held out; a null doc_id is not."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % folds
    return F.coalesce(remainder, F.lit(1))


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = 1500, max_chars: int = 20_000, folds: int = 5
) -> Model:
    """A model from labelled documents that are not held out: at most `per_class` of each label, of
    texts with at most `max_chars` characters; of rows that share a sampled doc_id one counts."""
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("toxic in (0, 1) and doc_id is not null")
        .where(fold(F.col("doc_id"), folds) != 0)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .withColumn("place", F.xxhash64(F.col("doc_id"), F.lit("sample")))
    )
    by_class = [known.where(F.col("toxic") == c).orderBy("place", "doc_id").limit(per_class) for c in (0, 1)]
    chosen = by_class[0].unionAll(by_class[1])  # at most 2 * per_class rows of three numbers
    one = F.struct(F.xxhash64("text").alias("order"), "text")
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).where(F.length(F.coalesce("text", F.lit(""))) <= max_chars)
    # One text for each sampled id, so that the fitting task gets no more than was sampled.
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("place", "doc_id", "toxic").agg(
        F.min(one)["text"].alias("text")
    )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = {}
        for batch in batches:
            for place, doc_id, toxic, text in zip(*(batch[c].to_pylist() for c in range(4))):
                rows[place, doc_id, text or ""] = toxic
        ordered = sorted(rows.items())
        model = fit_sample([k[2] for k, _ in ordered], [v for _, v in ordered])
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    row = sample.repartition(1).mapInArrow(train, "model binary").first()
    return pickle.loads(row["model"]) if row else Model()


# Scoring


def _spans(texts: Texts, found: Words, probability: np.ndarray) -> tuple[np.ndarray, list, list, list]:
    """Runs of likely toxic words: text, first and last character, largest probability."""
    hit = np.flatnonzero(probability >= 0.5)
    if not len(hit):
        return hit, [], [], []
    text = np.searchsorted(found.of_text, hit, side="right") - 1
    fresh = np.ones(len(hit), bool)
    fresh[1:] = (np.diff(hit) > 1) | (np.diff(text) > 0)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(hit)) - 1
    chars = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
    zero = chars[texts.offsets[text[first]]]
    return (
        text[first],
        (chars[found.starts[hit[first]]] - zero).tolist(),
        (chars[found.ends[hit[last]]] - zero).tolist(),
        np.maximum.reduceat(probability[hit], first).tolist(),
    )


def judged(model: Model, column: pa.Array) -> Iterator[tuple[np.ndarray, list[list[dict]]]]:
    """Scores and spans of the texts of a column, portion by portion."""
    for texts in pieces(column):
        found = words(texts, ALNUM)
        if model.calibration is None:
            yield np.zeros(texts.count), [[] for _ in range(texts.count)]
            continue
        probability = marginals(model.emissions(found), found.of_text, model.pair)
        score = model.score(*summaries(found, probability))
        spans: list[list[dict]] = [[] for _ in range(texts.count)]
        for text, start, end, p in zip(*_spans(texts, found, probability)):
            spans[text].append({"start": start, "end": end, "probability": p})
        yield score, spans


def toxic_spans(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id, score, spans` for every row: offsets are characters, the end excluded."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(judged(model, batch["text"]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(np.concatenate([p[0] for p in parts]) if parts else [], pa.float64()),
                    pa.array([s for p in parts for s in p[1]], kind),
                ],
                ["doc_id", "score", "spans"],
            )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(
        score, "doc_id bigint, score double, spans array<struct<start:int,end:int,probability:double>>"
    )


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` whose text scores below the threshold, all columns kept."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [s for s, _ in judged(model, batch["text"])]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) < threshold))

    return docs.mapInArrow(clean, docs.schema)
