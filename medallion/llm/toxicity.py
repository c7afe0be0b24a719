"""Toxic documents and the sentences that make them so: multiple-instance learning.

A document is a bag of sentences of which only the document's label is known. A sentence scores
``sigmoid(bias + sum of its words' weights)``; a document is toxic unless all its sentences are
harmless (noisy-or): ``1 - prod(1 - score)``. Weights are trained through that product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.sampling import labelled_sample
from medallion.llm.tables import small_batches
from medallion.llm.text import WORD_CHARS, Powers, bounds, range_hashes, text_chunks

#: At most so many labelled documents of each class are used for fitting.
SAMPLE_PER_CLASS = 2500
BITS = 18
#: A word counts as itself and by its first bytes, which related words share.
PREFIXES = (4, 5)
_STOP = np.zeros(256, bool)
_STOP[[0x0A, 0x21, 0x2E, 0x3F]] = True  # line end ! . ?


@dataclass(frozen=True)
class ToxicModel:
    weights: np.ndarray
    bias: float


def sentence_features(
    data: np.ndarray, offsets: np.ndarray, powers: Powers
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features per word (words x 3), first word of each sentence, first sentence of each text, word bounds."""
    starts, ends = bounds(WORD_CHARS[data], offsets)
    parts = [range_hashes(data, starts, np.minimum(ends, starts + n), powers) + np.uint64(n) for n in (1 << 40, *PREFIXES)]
    features = np.stack([(p >> np.uint64(64 - BITS)).astype(np.int32) for p in parts], axis=1)
    stops = np.concatenate([[0], np.cumsum(_STOP[data])])[starts] if len(starts) else starts
    texts = np.searchsorted(offsets, starts, side="right")
    new = np.ones(len(starts), bool)
    new[1:] = (stops[1:] != stops[:-1]) | (texts[1:] != texts[:-1])
    first_word = np.flatnonzero(new)
    first_sentence = np.searchsorted(starts[first_word], offsets) if len(starts) else np.zeros(len(offsets), np.int64)
    return features, first_word, first_sentence, starts, ends


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups; ``first`` ends with the number of values. Empty groups sum to zero."""
    sums, filled = np.zeros(len(first) - 1), np.diff(first) > 0
    if filled.any():  # each group is summed alone, so its sum does not depend on the others
        sums[filled] = np.add.reduceat(values, first[:-1][filled])
    return sums


def fit_noisy_or(
    bags: list[tuple[np.ndarray, np.ndarray]],
    y: np.ndarray,
    weight: np.ndarray,
    epochs: int = 150,
    rate: float = 0.1,
    l2: float = 1e-6,
    min_documents: int = 4,
    min_excess: float = 3.5,
) -> ToxicModel:
    """Full-batch Adam on the bags' log-likelihood. A bag: features (words x 3) and words per sentence.

    Only features that speak for toxicity take part: in at least ``min_documents`` bags, and in toxic bags
    ``min_excess`` standard deviations more often than chance. Without both classes the model is constant.
    """
    size = 1 << BITS
    if len(bags) == 0 or y.min() == y.max():
        prior = float(y.mean()) if len(bags) else 0.0
        return ToxicModel(np.zeros(size, np.float32), -20.0 if prior == 0 else 20.0)
    seen, toxic = np.zeros(size), np.zeros(size)
    for (features, _), label, share in zip(bags, y, weight):
        present = np.unique(features)
        seen[present] += share
        toxic[present] += share * label
    rate_of_positive = float(np.clip((weight * y).sum() / weight.sum(), 1e-3, 0.999))
    excess = (toxic - rate_of_positive * seen) / np.sqrt(np.maximum(seen, 1) * rate_of_positive * (1 - rate_of_positive))
    slot = np.full(size, -1, np.int32)
    kept = np.flatnonzero((seen >= min_documents) & (excess >= min_excess))
    slot[kept] = np.arange(len(kept))
    ids, sentence, sentences_of, n = [], [], [], 0
    for features, lengths in bags:
        of_word = np.repeat(np.arange(n, n + len(lengths), dtype=np.int32), lengths)
        local = slot[features]
        used = local >= 0
        ids.append(local[used])
        sentence.append(np.broadcast_to(of_word[:, None], features.shape)[used])
        sentences_of.append(len(lengths))
        n += len(lengths)
    ids, sentence = np.concatenate(ids), np.concatenate(sentence)
    bag_first = np.concatenate([[0], np.cumsum(sentences_of)])
    bag_of = np.repeat(np.arange(len(bags)), sentences_of)
    weight = weight / weight.sum()
    theta = np.zeros(len(kept) + 1)
    theta[-1] = np.log(rate_of_positive / max(1.0, n / len(bags)))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, epochs + 1):
        z = theta[-1] + np.bincount(sentence, theta[ids], minlength=n)
        p = 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))
        total = np.maximum(_sums(_softplus(z), bag_first), 1e-9)
        pull = np.where(y == 1, -1.0 / np.expm1(np.minimum(total, 60.0)), 1.0) * weight
        dz = p * pull[bag_of]
        gradient = np.empty_like(theta)
        gradient[:-1] = np.bincount(ids, dz[sentence], minlength=len(kept)) + l2 * theta[:-1]
        gradient[-1] = dz.sum()
        m = 0.9 * m + 0.1 * gradient
        v = 0.98 * v + 0.02 * gradient**2
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.98**step)) + 1e-7)
    weights = np.zeros(size, np.float32)
    weights[kept] = theta[:-1]
    return ToxicModel(weights, float(theta[-1]))


_BAG = "doc_id long, _y int, features array<int>, lengths array<int>"


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch):
            features, first_word, first_sentence, starts, _ = sentence_features(data, offsets, powers)
            lengths = np.diff(np.append(first_word, len(starts))).astype(np.int32)
            word_of = np.append(first_word, len(starts))[first_sentence]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, end - first).cast(pa.int64()),
                    batch.column("_y").slice(first, end - first),
                    pa.ListArray.from_arrays(pa.array(word_of * 3, pa.int32()), pa.array(features.ravel(), pa.int32())),
                    pa.ListArray.from_arrays(pa.array(first_sentence, pa.int32()), pa.array(lengths, pa.int32())),
                ],
                names=["doc_id", "_y", "features", "lengths"],
            )


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> ToxicModel:
    """Fit on a bounded sample of labelled documents outside the held-out fifth (see ``labelled_sample``)."""
    small_batches(docs.sparkSession)
    rows, weights = labelled_sample(docs, labels, "toxic", per_class)
    sample = rows.select("doc_id", "text", "_y").mapInArrow(_bags, _BAG).toArrow().combine_chunks()
    bags = [
        (np.asarray(f.values, np.int32).reshape(-1, 3), np.asarray(n.values, np.int32))
        for f, n in zip(sample.column("features"), sample.column("lengths"))
    ]
    y = np.asarray(sample.column("_y"), np.int32)
    order = np.argsort(np.asarray(sample.column("doc_id")), kind="stable")
    weight = np.array([weights[int(c)] for c in y])
    return fit_noisy_or([bags[i] for i in order], y[order], weight[order])


_SPANS = "array<struct<start:int,length:int,score:double>>"


def _score(
    batches: Iterator[pa.RecordBatch], model: ToxicModel, schema: pa.Schema, within: tuple[str, int] | None = None
) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        if within:
            batch = batch.append_column("_text", batch.column(within[0]).field(within[1]))
        for first, end, data, offsets in text_chunks(batch, "_text"):
            features, first_word, first_sentence, starts, ends = sentence_features(data, offsets, powers)
            z = model.bias + _sums(model.weights[features].sum(axis=1, dtype=np.float64), np.append(first_word, len(starts)))
            scores = 1.0 - np.exp(-_sums(_softplus(z), first_sentence))
            bad = np.flatnonzero(z >= 0)
            characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]) if len(bad) else np.zeros(1, np.int64)
            text_of = np.searchsorted(first_sentence, bad, side="right") - 1
            last_word = np.append(first_word[1:], len(starts)) - 1
            begin, stop = (starts[first_word[bad]], ends[last_word[bad]]) if len(bad) else (bad, bad)
            spans = pa.StructArray.from_arrays(
                [
                    pa.array(characters[begin] - characters[offsets[text_of]], pa.int32()),
                    pa.array(characters[stop] - characters[begin], pa.int32()),
                    pa.array(1.0 / (1.0 + np.exp(-np.clip(z[bad], -40, 40))), pa.float64()),
                ],
                names=["start", "length", "score"],
            )
            rows = batch.slice(first, end - first)
            kept = [rows.column(n) for n in schema.names[:-3]]
            made = [
                pa.array(scores, pa.float64()),
                pa.array(np.diff(first_sentence), pa.int32()),
                pa.ListArray.from_arrays(pa.array(np.searchsorted(bad, first_sentence), pa.int32()), spans),
            ]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)


def score_toxicity(
    docs: DataFrame, model: ToxicModel, keep: tuple[str, ...] = ("doc_id",), within: tuple[str, int] | None = None
) -> DataFrame:
    """``keep`` columns plus ``score`` (0 to 1), ``n_sentences`` and ``offending``: spans, in characters, of sentences
    that are more likely toxic than not, with their score.

    Whole texts are read. A null or empty text, or one without a word, has no sentences and scores 0. Repeated
    rows score alike; an empty table gives an empty result. Columns that are not kept are not read. ``within`` names a
    kept struct and the place of the text in it, if ``docs`` has no column ``text``; then texts are sent to Python once.
    """
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    made = T._parse_datatype_string(f"score double, n_sentences int, offending {_SPANS}")
    schema = T.StructType([docs.schema[c] for c in keep] + made.fields)
    arrow = to_arrow_schema(schema)
    small_batches(docs.sparkSession)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *([] if within else [F.col("text").alias("_text")]))
    return rows.mapInArrow(lambda batches: _score(batches, model, arrow, within), schema)


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Documents, all columns, whose score stays below ``threshold``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    scored = score_toxicity(rows, fit(docs, labels), ("row",), ("row", [c.lower() for c in docs.columns].index("text")))
    return scored.filter(F.col("score") < threshold).select("row.*")
