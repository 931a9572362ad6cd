"""A byte-level convolutional network that scores the quality of whole texts.

A text's UTF-8 bytes are embedded, with one more channel that tells whether the
next eight bytes occur a second time nearby. Learned filters run over the whole
text; the best answer of each filter is taken per chunk of CHUNK bytes (chunks
overlap by a filter's width), and a text's chunks are combined by their mean and
their maximum into one probability. The network is numpy: it is trained in the
driver on a bounded sample of labelled texts (TRAIN_DOCS texts, of each at most
SEGMENTS pieces of BLOCK bytes; both are parameters), and its few thousand
numbers go along with the scoring tasks, which read every byte of every text.

Defined results: null and empty texts have a score, that of no bytes; scoring
looks at nothing but the text, so that equal texts have equal scores, whatever
their ids; rows with a null doc_id are scored and are not held out; without any
labels of both kinds every score is 1; a document with several labels counts by
the lowest; other columns are ignored.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.llm.common import map_texts

WIDTH, STRIDE, CHUNK, BLOCK = 8, 2, 256, 1024
FILTERS, CHANNELS = 16, 5
#: The sample to learn from.
TRAIN_DOCS, SEGMENTS = 4_000, 8
STEPS, BATCH, RATE = 700, 32, 0.004
ACCEPT = 0.7
#: Bytes that go through the filters at a time.
SLICE = 256 * BLOCK // 2


@dataclass
class Net:
    embed: np.ndarray  # 256 x CHANNELS
    filters: np.ndarray  # WIDTH * (CHANNELS + 1) x FILTERS
    bias: np.ndarray
    weights: np.ndarray  # of the chunks' means, then maxima
    offset: np.ndarray


def new_net(seed: int = 7) -> Net:
    rng = np.random.default_rng(seed)
    size = WIDTH * (CHANNELS + 1)
    draw = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
    return Net(
        draw(256, CHANNELS, scale=0.5), draw(size, FILTERS, scale=size**-0.5), np.zeros(FILTERS, dtype=np.float32),
        draw(2 * FILTERS, scale=0.05), np.ones(1, dtype=np.float32),
    )


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes in whole blocks, with room behind each text, and where each text's blocks and chunks are."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    blocks = (sizes + WIDTH) // BLOCK + 1
    starts = (np.cumsum(blocks) - blocks) * BLOCK
    data = np.zeros(int(blocks.sum()) * BLOCK, dtype=np.uint8)
    for start, text in zip(starts.tolist(), texts):
        data[start : start + len(text)] = np.frombuffer(text, dtype=np.uint8)
    return data, starts, sizes // CHUNK + 1


def repeated(data: np.ndarray) -> np.ndarray:
    """Whether the eight bytes from each position on occur elsewhere in its block."""
    ahead = np.append(data, np.zeros(8, dtype=np.uint8))
    keys = np.ndarray((len(data),), dtype="<u8", buffer=ahead, strides=(1,)).reshape(-1, BLOCK)
    order = np.argsort(keys, axis=1)
    ranked = np.take_along_axis(keys, order, axis=1)
    same = ranked[:, 1:] == ranked[:, :-1]
    flags = np.zeros(ranked.shape, dtype=bool)
    flags[:, 1:] |= same
    flags[:, :-1] |= same
    out = np.empty_like(flags)
    np.put_along_axis(out, order, flags, axis=1)
    return out.ravel() & (data != 0)


def windows(net: Net, data: np.ndarray, flags: np.ndarray, start: int, stop: int) -> np.ndarray:
    """The filters' inputs for windows that start in data[start:stop]."""
    own = np.zeros(stop - start + WIDTH, dtype=np.uint8)
    seen = np.zeros(len(own), dtype=np.float32)
    piece = data[start : stop + WIDTH]
    own[: len(piece)] = piece
    seen[: len(piece)] = flags[start : stop + WIDTH]
    channels = np.concatenate([net.embed[own], seen[:, None]], axis=1)
    step = channels.strides[0]
    n = (stop - start) // STRIDE
    view = np.lib.stride_tricks.as_strided(channels, (n, WIDTH * (CHANNELS + 1)), (step * STRIDE, channels.strides[1]))
    return np.ascontiguousarray(view)


def chunk_maxima(net: Net, data: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Per chunk the best answer of each filter."""
    per = CHUNK // STRIDE
    out = []
    for start in range(0, len(data), SLICE):
        stop = min(start + SLICE, len(data))
        answers = windows(net, data, flags, start, stop) @ net.filters
        out.append(answers.reshape(-1, per, FILTERS).max(axis=1))
    return np.maximum(np.concatenate(out) + net.bias, 0)


def combined(chunks: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean and maximum of every text's chunks."""
    first = starts // CHUNK
    rows = np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.cumsum(counts) - counts
    own = chunks[rows]
    return np.hstack([np.add.reduceat(own, at, axis=0) / counts[:, None], np.maximum.reduceat(own, at, axis=0)])


def scores(net: Net, texts: list[bytes]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    data, starts, counts = laid_out(texts)
    features = combined(chunk_maxima(net, data, repeated(data)), starts, counts)
    logits = (features @ net.weights + net.offset).astype(np.float64)
    return 1 / (1 + np.exp(-np.clip(logits, -50, 50)))


def _gradients(net: Net, texts: list[bytes], labels: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean log loss, in the order of the net's fields."""
    data, starts, counts = laid_out(texts)
    flags = repeated(data)
    per = CHUNK // STRIDE
    inputs = windows(net, data, flags, 0, len(data))
    answers = (inputs @ net.filters).reshape(-1, per, FILTERS)
    best = answers.argmax(axis=1)
    raw = np.take_along_axis(answers, best[:, None, :], axis=1)[:, 0] + net.bias
    chunks = np.maximum(raw, 0)
    features = combined(chunks, starts, counts)
    error = (1 / (1 + np.exp(-(features @ net.weights + net.offset))) - labels) / len(texts)
    d_features = error[:, None] * net.weights
    d_chunks = np.zeros_like(chunks)
    for i, (start, n) in enumerate(zip((starts // CHUNK).tolist(), counts.tolist())):
        own = chunks[start : start + n]
        d_chunks[start : start + n] += d_features[i, :FILTERS] / n
        d_chunks[start + own.argmax(axis=0), np.arange(FILTERS)] += d_features[i, FILTERS:]
    d_chunks *= raw > 0
    chunk, filt = np.nonzero(d_chunks)
    grad = d_chunks[chunk, filt]
    window = chunk * per + best[chunk, filt]
    d_filters = np.zeros_like(net.filters)
    np.add.at(d_filters.T, filt, inputs[window] * grad[:, None])
    d_inputs = (net.filters.T[filt] * grad[:, None]).reshape(-1, WIDTH, CHANNELS + 1)[:, :, :CHANNELS]
    position = window[:, None] * STRIDE + np.arange(WIDTH)
    ahead = np.append(data, np.zeros(WIDTH, dtype=np.uint8))
    d_embed = np.zeros_like(net.embed)
    np.add.at(d_embed, ahead[position].ravel(), d_inputs.reshape(-1, CHANNELS))
    return [d_embed, d_filters, d_chunks.sum(axis=0), features.T @ error, np.array([error.sum()])]


def learn(examples: list[tuple[list[bytes], int]], steps: int = STEPS, seed: int = 7) -> Net:
    """Fit a net by Adam to (pieces of a text, label)."""
    net, rng = new_net(seed), np.random.default_rng(seed)
    texts = [b"".join(pieces) for pieces, _ in examples]
    labels = np.array([label for _, label in examples], dtype=np.float32)
    if len(set(labels.tolist())) < 2:
        net.weights[:], net.offset[:] = 0, 50
        return net
    fields = ["embed", "filters", "bias", "weights", "offset"]
    first = {f: np.zeros_like(getattr(net, f)) for f in fields}
    second = {f: np.zeros_like(getattr(net, f)) for f in fields}
    kinds = [np.flatnonzero(labels == k) for k in (0, 1)]
    for step in range(1, steps + 1):
        # Half of a batch of each kind; the odds of the kinds are put right below.
        rows = np.concatenate([rng.choice(k, BATCH // 2) for k in kinds])
        grads = _gradients(net, [texts[i] for i in rows], labels[rows])
        rate = RATE * min(1.0, 2.0 * (1 - (step - 1) / steps))
        for f, g in zip(fields, grads):
            first[f] = 0.9 * first[f] + 0.1 * g
            second[f] = 0.999 * second[f] + 0.001 * g * g
            change = first[f] / (1 - 0.9**step) / (np.sqrt(second[f] / (1 - 0.999**step)) + 1e-8)
            value = getattr(net, f)
            value -= (rate * (change + 1e-4 * value)).astype(np.float32)
    net.offset += np.float32(np.log(len(kinds[1]) / len(kinds[0])))
    return net


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, target: str = "quality", most: int = TRAIN_DOCS) -> list[tuple[list[bytes], int]]:
    """Pieces and labels of at most `most` documents, those whose ids' hashes are smallest, in their order."""
    known = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.min(target).cast("int").alias("_label"))
    picked = F.broadcast(known.orderBy(F.xxhash64("_id"), "_id").limit(most))  # bounded by `most`
    rows = docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "_label")
    # Of an id that repeats one text, so that no more than `most` come to the driver. Only hashes are grouped.
    prints = rows.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("_print"))
    rows = rows.join(F.broadcast(prints), "doc_id").where(F.xxhash64("text") == F.col("_print")).select("doc_id", "text", "_label")

    def make():
        def work(batch):
            ids, texts, marks = (c.to_pylist() for c in batch.columns)
            out = []
            for doc, text in zip(ids, texts):
                raw = (text or "").encode()
                rng = np.random.default_rng(doc % 2**32)
                n = -(-len(raw) // BLOCK)
                chosen = sorted(rng.choice(n, SEGMENTS, replace=False)) if n > SEGMENTS else range(n)
                out.append([raw[i * BLOCK : (i + 1) * BLOCK] for i in chosen])
            return pa.record_batch([batch.column(0), pa.array(out, pa.list_(pa.binary())), batch.column(2)], ["doc_id", "pieces", "label"])

        return work

    found = map_texts(rows, make, "doc_id long, pieces array<binary>, label int")
    # Equal rows are left, which are one.
    found = found.groupBy("doc_id").agg(F.first("pieces").alias("pieces"), F.first("label").alias("label")).collect()
    found.sort(key=lambda r: r["doc_id"])
    return [([bytes(p) for p in r["pieces"]], r["label"]) for r in found]


def score(docs: DataFrame, net: Net) -> DataFrame:
    """The documents' doc_id and score, from whole texts."""

    def make():
        def work(batch):
            found = scores(net, [(t or "").encode() for t in batch.column(1).to_pylist()])
            return pa.record_batch([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

        return work

    return map_texts(docs.select("doc_id", "text"), make, "doc_id long, score double", chunk_bytes=1_000_000)


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every document, after learning from the labels not held out."""
    net = learn(sample(docs, labels))
    return score(docs, net).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with all their columns as they are."""
    net = learn(sample(docs, labels))
    columns = docs.columns

    def run(batches):
        from sitewright.llm.common import in_chunks

        at = columns.index("text")
        for batch in batches:
            for piece in in_chunks(batch, 200_000, at):
                good = scores(net, [(t or "").encode() for t in piece.column(at).to_pylist()]) >= ACCEPT
                yield piece.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
