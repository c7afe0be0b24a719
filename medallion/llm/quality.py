"""Document quality by a byte-level convolutional network written in numpy.

Bytes are embedded and read by learned filters at every fourth position. Filter outputs are max-pooled over
chunks of 256 bytes that overlap by 64 and together cover the whole document; a small dense layer judges
each chunk, and the chunks' largest and mean outputs are combined into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from medallion.llm.sampling import labelled_sample
from medallion.llm.text import text_bytes, text_chunks

#: At most so many labelled documents of each class are used for fitting.
SAMPLE_PER_CLASS = 2000
EMBED, STRIDE, TAPS, FILTERS, HIDDEN = 4, 4, 3, 24, 16
BLOCK = 64  # bytes; a chunk is four blocks, chunks begin three blocks apart
CHUNK_BLOCKS, CHUNK_STEP = 4, 3
_WINDOWS = BLOCK // STRIDE
_SPILL = TAPS - 1  # windows at the end of a text that would look into the next one

Params = dict[str, np.ndarray]


def initial(seed: int = 1) -> Params:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    width = EMBED * STRIDE
    return {
        "embed": normal(256, EMBED, scale=0.5),
        "conv": normal(TAPS, width, FILTERS, scale=(2 / (TAPS * width)) ** 0.5),
        "conv_bias": np.zeros(FILTERS, np.float32),
        "dense": normal(FILTERS, HIDDEN, scale=(2 / FILTERS) ** 0.5),
        "dense_bias": np.zeros(HIDDEN, np.float32),
        "out": normal(2 * HIDDEN, scale=0.1),
        "out_bias": np.zeros(1, np.float32),
    }


class Layout:
    """Texts laid out in whole blocks of bytes, and the chunks and texts those blocks belong to."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        lengths = np.diff(offsets)
        blocks = np.maximum(-(-(lengths + _SPILL * STRIDE) // BLOCK), 1)
        first = np.concatenate([[0], np.cumsum(blocks)])
        self.bytes = np.zeros(first[-1] * BLOCK, np.uint8)
        for source, size, block in zip(offsets, lengths, first):
            self.bytes[block * BLOCK : block * BLOCK + size] = data[source : source + size]
        chunks = np.maximum(-(-(blocks - CHUNK_BLOCKS) // CHUNK_STEP), 0) + 1
        self.first_chunk = np.concatenate([[0], np.cumsum(chunks)])
        self.text = np.repeat(np.arange(len(lengths)), chunks)
        start = first[self.text] + CHUNK_STEP * (np.arange(len(self.text)) - self.first_chunk[self.text])
        last = first[self.text + 1] - 1
        self.chunk_blocks = [np.minimum(start + o, last) for o in range(CHUNK_BLOCKS)]
        self.spill = (first[1:, None] * _WINDOWS - np.arange(1, _SPILL + 1)).ravel()
        self.counts = chunks


def _filters(p: Params, at: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Embedded rows of four bytes, and the filters' outputs at every window."""
    rows = p["embed"][at.bytes].reshape(-1, EMBED * STRIDE)
    # One product of fixed shape per block: how a sum is rounded must not depend on a text's place in the batch.
    blocks = rows.reshape(-1, _WINDOWS, EMBED * STRIDE)
    z = (blocks @ p["conv"][0]).reshape(-1, FILTERS)
    for tap in range(1, TAPS):
        z[:-tap] += (blocks @ p["conv"][tap]).reshape(-1, FILTERS)[tap:]
    z += p["conv_bias"]
    np.maximum(z, 0, out=z)
    z[at.spill] = 0
    return rows, z


def forward(p: Params, at: Layout) -> np.ndarray:
    """One logit per text."""
    _, z = _filters(p, at)
    block = z.reshape(-1, _WINDOWS, FILTERS).max(axis=1)
    chunk = block[at.chunk_blocks[0]]
    for index in at.chunk_blocks[1:]:
        np.maximum(chunk, block[index], out=chunk)
    hidden = np.maximum((chunk[:, None, :] @ p["dense"])[:, 0] + p["dense_bias"], 0)
    starts = at.first_chunk[:-1]
    pooled = np.concatenate(
        [np.maximum.reduceat(hidden, starts), np.add.reduceat(hidden, starts) / at.counts[:, None]], axis=1
    )
    return (pooled * p["out"]).sum(axis=1, dtype=np.float64) + p["out_bias"][0]


def gradients(p: Params, at: Layout, y: np.ndarray, weight: np.ndarray) -> tuple[float, Params]:
    """Weighted log-loss of a batch of texts and its gradient."""
    rows, z = _filters(p, at)
    by_block = z.reshape(-1, _WINDOWS, FILTERS)
    peak = by_block.argmax(axis=1)
    block = np.take_along_axis(by_block, peak[:, None, :], axis=1)[:, 0]
    stacked = np.stack([block[i] for i in at.chunk_blocks])
    pick = stacked.argmax(axis=0)
    chunk = np.take_along_axis(stacked, pick[None], axis=0)[0]
    hidden = np.maximum(chunk @ p["dense"] + p["dense_bias"], 0)
    starts = at.first_chunk[:-1]
    top, mean = np.maximum.reduceat(hidden, starts), np.add.reduceat(hidden, starts) / at.counts[:, None]
    pooled = np.concatenate([top, mean], axis=1)
    logit = pooled @ p["out"] + p["out_bias"][0]
    loss = float((weight * (np.logaddexp(0, logit) - y * logit)).sum())
    d_logit = (weight * (1 / (1 + np.exp(-logit)) - y)).astype(np.float32)

    g: Params = {"out": pooled.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * p["out"]
    is_top = hidden == top[at.text]
    ties = np.add.reduceat(is_top.astype(np.float32), starts)
    d_hidden = is_top * (d_pooled[:, :HIDDEN] / ties)[at.text] + (d_pooled[:, HIDDEN:] / at.counts[:, None])[at.text]
    d_hidden = (d_hidden * (hidden > 0)).astype(np.float32)
    g["dense"], g["dense_bias"] = chunk.T @ d_hidden, d_hidden.sum(axis=0)
    d_chunk = (d_hidden @ p["dense"].T) * (chunk > 0)
    # Each chunk and filter has its gradient at one window.
    block_of = np.choose(pick, [i[:, None] for i in at.chunk_blocks])
    filters = np.broadcast_to(np.arange(FILTERS), pick.shape)
    window = block_of * _WINDOWS + peak[block_of, filters]
    live = d_chunk != 0
    window, column, d = window[live], filters[live], d_chunk[live]
    g["conv_bias"] = np.bincount(column, d, minlength=FILTERS).astype(np.float32)
    g["conv"], d_embed = np.zeros_like(p["conv"]), np.zeros((256, EMBED), np.float64)
    order = np.argsort(column, kind="stable")
    window, column, d = window[order], column[order], d[order]
    edges = np.searchsorted(column, np.arange(FILTERS + 1))
    symbols = at.bytes.reshape(-1, STRIDE)
    for tap in range(TAPS):
        at_row = np.minimum(window + tap, len(rows) - 1)
        seen = rows[at_row] * d[:, None]
        for f in range(FILTERS):
            g["conv"][tap, :, f] = seen[edges[f] : edges[f + 1]].sum(axis=0)
        back = (p["conv"][tap].T[column] * d[:, None]).reshape(-1, STRIDE, EMBED)
        for s in range(STRIDE):
            for e in range(EMBED):
                d_embed[:, e] += np.bincount(symbols[at_row, s], back[:, s, e], minlength=256)
    g["embed"] = d_embed.astype(np.float32)
    return loss, g


def train(
    data: np.ndarray, offsets: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 8, batch: int = 32, rate: float = 4e-3
) -> Params:
    """Adam over shuffled batches; the step shrinks to nothing. Without both classes the model is constant."""
    p = initial()
    if len(y) == 0 or y.min() == y.max():
        p["out"][:] = 0
        p["out_bias"][:] = 20.0 if len(y) and y[0] == 1 else -20.0 if len(y) else 0.0
        return p
    rng = np.random.default_rng(2)
    weight = weight / weight.mean()
    m = {k: np.zeros_like(x) for k, x in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    steps, step = epochs * -(-len(y) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for begin in range(0, len(y), batch):
            rows = order[begin : begin + batch]
            part = np.concatenate([data[offsets[r] : offsets[r + 1]] for r in rows])
            at = Layout(part, np.concatenate([[0], np.cumsum(offsets[rows + 1] - offsets[rows])]))
            _, g = gradients(p, at, y[rows], weight[rows] / len(rows))
            step += 1
            size = rate * (1 - (step - 1) / steps) * (1 - 0.99**step) ** 0.5 / (1 - 0.9**step)
            for k, x in g.items():
                m[k] += 0.1 * (x - m[k])
                v[k] += 0.01 * (x * x - v[k])
                p[k] -= size * m[k] / (np.sqrt(v[k]) + 1e-8)
    return p


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Params:
    """Fit on a bounded sample of labelled documents outside the held-out fifth (see ``labelled_sample``)."""
    rows, weights = labelled_sample(docs, labels, "quality", per_class)
    sample = rows.select("doc_id", "text", "_y").toArrow().combine_chunks()
    sample = sample.sort_by("doc_id").combine_chunks()
    data, offsets = text_bytes(sample.column("text"))
    y = np.asarray(sample.column("_y"), np.int32)
    return train(data, offsets, y, np.array([weights[int(c)] for c in y]))


def _score(batches: Iterator[pa.RecordBatch], model: Params, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch, "_text"):
            at = Layout(data, offsets)
            logit = forward(model, at).astype(np.float64)
            rows = batch.slice(first, end - first)
            kept = [rows.column(n) for n in schema.names[:-2]]
            made = [pa.array(1 / (1 + np.exp(-np.clip(logit, -40, 40)))), pa.array(at.counts, pa.int32())]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)


def score_quality(docs: DataFrame, model: Params, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``score`` (probability of good quality) and ``n_chunks`` the network has read.

    Whole texts are read. Null and empty texts are one chunk of zero bytes and get the score of that. Repeated
    rows score alike; an empty table gives an empty result. Columns that are not kept are not read.
    """
    schema = T.StructType([docs.schema[c] for c in keep] + T._parse_datatype_string("score double, n_chunks int").fields)
    arrow = to_arrow_schema(schema)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text"))
    return rows.mapInArrow(lambda batches: _score(batches, model, arrow), schema)
