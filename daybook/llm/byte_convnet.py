"""Quality classifier: a convolutional network over bytes, trained and applied in numpy.

Filters of six bytes slide over the whole document. Their responses are max-pooled within chunks
that overlap by half; the pooled chunks are combined, by mean and maximum over the document, into
one probability through a small hidden layer. Applied to a block of documents the convolution is a
sum of table lookups, one for each pair of bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import textblocks as tb
from daybook.llm.tables import held_out

WIDTH = 6
STEP = 256  # chunks are two steps long
FILTERS = 16
HIDDEN = 16
#: Labelled documents of either class, and chunks of each of them, that the filters learn from.
SAMPLE_DOCS = 1500
SAMPLE_CHUNKS = 6
#: Passes over the sample; small samples are passed until so many steps are done.
EPOCHS = 6
STEPS = 300
SLICE_BYTES = 256 << 10
#: Bytes whose responses are held at once.
PIECE_BYTES = 64 << 10
_SCORES = "doc_id long, held_out boolean, score double"
_SAMPLE = "key long, quality int, n int, chunks binary"


class Network:
    """Parameters; ``shift`` moves the log-odds from the balanced sample to the labelled rows."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.filters = r.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.hidden = r.normal(0, 0.3, (2 * FILTERS, HIDDEN)).astype(np.float32)
        self.hidden_bias = np.zeros(HIDDEN, np.float32)
        self.out = r.normal(0, 0.3, HIDDEN).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)
        self.shift = 0.0

    def parameters(self) -> list[np.ndarray]:
        return [self.filters, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def head(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(features @ self.hidden + self.hidden_bias, 0)
        return h, h @ self.out + self.out_bias[0]

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.head(features)[1].astype(np.float64) + self.shift, -40, 40)))


def train(chunks: np.ndarray, lengths: np.ndarray, doc: np.ndarray, label: np.ndarray,
          epochs: int = EPOCHS, batch: int = 48, rate: float = 0.004) -> Network:
    """Learns from chunks (rows of two steps and a margin of bytes), in order of their documents."""
    net, r = Network(), np.random.default_rng(11)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    first, steps = np.searchsorted(doc, np.arange(len(label) + 1)), 0
    share = np.where(label == 1, label.mean(), 1 - label.mean())
    weight = (0.5 / share).astype(np.float32)  # both classes count alike
    parts = max(1, len(label) // batch)
    for _ in range(max(epochs, -(-STEPS // parts))):
        for docs in np.array_split(r.permutation(len(label)), parts):
            n = first[docs + 1] - first[docs]
            rows, at = tb.ranges(first[docs], n), np.cumsum(n) - n
            grads = _gradients(net, chunks[rows], lengths[rows], at, n, label[docs], weight[docs])
            steps += 1
            for p, g, (m, v) in zip(net.parameters(), grads, state):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** steps)) / (np.sqrt(v / (1 - 0.999 ** steps)) + 1e-8)
    return net


def _gradients(net: Network, x, lengths, at, n, label, weight) -> list[np.ndarray]:
    span = x.shape[1] - WIDTH + 1
    response = net.filters[0][x[:, :span]]
    for k in range(1, WIDTH):
        response += net.filters[k][x[:, k:k + span]]
    response[np.arange(span)[None, :] >= lengths[:, None]] = -np.inf
    best = response.argmax(1)
    pooled = np.maximum(np.take_along_axis(response, best[:, None], 1)[:, 0], 0)
    mean, most = np.add.reduceat(pooled, at) / n[:, None], np.maximum.reduceat(pooled, at)
    features = np.concatenate([mean, most], 1)
    h, logit = net.head(features)
    d_logit = ((1 / (1 + np.exp(-np.clip(logit, -40, 40))) - label) * weight / len(label)).astype(np.float32)
    d_h = d_logit[:, None] * net.out * (h > 0)
    d_features = d_h @ net.hidden.T
    owner = np.repeat(np.arange(len(n)), n)
    d_pooled = d_features[owner, :FILTERS] / n[owner, None]
    top = pooled == most[owner]
    d_pooled += d_features[owner, FILTERS:] * top / np.maximum(np.add.reduceat(top, at), 1)[owner]
    d_pooled *= pooled > 0
    d_filters, rows = np.zeros_like(net.filters), np.arange(len(x))[:, None]
    for k in range(WIDTH):
        np.add.at(d_filters[k], (x[rows, best + k], np.arange(FILTERS)[None, :]), d_pooled)
    return [d_filters, features.T @ d_h, d_h.sum(0), h.T @ d_logit, d_logit.sum(keepdims=True)]


def _block_maxima(padded: np.ndarray, cuts: np.ndarray, pairs: list[np.ndarray]) -> np.ndarray:
    """The largest responses between neighbouring cuts, in pieces that overlap by the filters' width.

    The responses of a piece are all that is held at once, however long a text is.
    """
    ends = np.append(cuts[1:], len(padded) - WIDTH)
    at = np.unique(np.searchsorted(cuts, np.arange(0, ends[-1] + PIECE_BYTES, PIECE_BYTES)))
    out = np.empty((len(cuts), FILTERS), np.float32)
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
        start, n = cuts[lo], ends[hi - 1] - cuts[lo]
        piece = padded[start:start + n + WIDTH]
        pair = piece[:-1].astype(np.int32) << 8 | piece[1:]
        response = pairs[0][pair[:n]]
        for k in range(1, WIDTH // 2):
            response += pairs[k][pair[2 * k:2 * k + n]]
        out[lo:hi] = np.maximum.reduceat(response, cuts[lo:hi] - start)
    return out


def features(net: Network, data: np.ndarray, offsets: np.ndarray,
             pairs: list[np.ndarray]) -> np.ndarray:
    """Mean and maximum over the overlapping chunks of each document of the pooled responses."""
    lengths = np.diff(offsets)
    spans = np.maximum(lengths, 1)
    base = np.cumsum(spans + WIDTH) - (spans + WIDTH)
    padded = np.zeros(int((spans + WIDTH).sum()) + WIDTH, np.uint8)
    padded[tb.ranges(base, lengths)] = data
    blocks = -(-spans // STEP)
    owner = np.repeat(np.arange(len(spans)), blocks)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    # a document's blocks and, apart, the margin behind it
    cuts = np.concatenate([base[owner] + inner * STEP, base + spans])
    order = np.argsort(cuts, kind="stable")
    best = np.empty((len(cuts), FILTERS), np.float32)
    best[order] = _block_maxima(padded, cuts[order], pairs)
    best = np.maximum(best[:len(owner)], 0)
    follows = np.concatenate([owner[1:] == owner[:-1], [False]])
    chunk = best.copy()
    chunk[follows] = np.maximum(best[follows], best[np.flatnonzero(follows) + 1])
    keep = follows | (inner == 0)  # the last block is within the chunk before it
    first = np.searchsorted(owner[keep], np.arange(len(spans)))
    count = np.diff(np.append(first, keep.sum()))
    return np.concatenate([np.add.reduceat(chunk[keep], first) / count[:, None],
                           np.maximum.reduceat(chunk[keep], first)], 1)


def _scorer(net: Network) -> Callable:
    def scorer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = [(net.filters[k][:, None] + net.filters[k + 1][None, :]).reshape(65536, FILTERS)
                 for k in range(0, WIDTH, 2)]
        for batch in batches:
            for part in tb.slices(batch, "text", SLICE_BYTES):
                score = net.probability(features(net, *tb.byte_view(part.column("text")), pairs))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(score)],
                    names=["doc_id", "held_out", "score"])
    return scorer


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Evenly spaced chunks of sampled documents; the first and the last are among them."""
    wide = 2 * STEP + WIDTH
    for batch in batches:
        out = []
        for key, quality, text in zip(*(batch.column(c).to_pylist() for c in ("key", "quality", "text"))):
            raw = (text or "").encode("utf-8", "replace")
            starts = range(0, max(len(raw) - STEP, 1), STEP)
            picked = sorted({starts[round(i * (len(starts) - 1) / max(SAMPLE_CHUNKS - 1, 1))]
                             for i in range(min(SAMPLE_CHUNKS, len(starts)))})
            out += [(key, quality, min(2 * STEP, max(len(raw) - s, 1)), raw[s:s + wide].ljust(wide, b"\0"))
                    for s in picked]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4,
                                            (pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
            names=["key", "quality", "n", "chunks"])


def fit(docs: DataFrame, labels: DataFrame) -> Network | float:
    """A network from labelled documents that are not held out.

    The filters learn from at most ``SAMPLE_DOCS`` documents of either class, those whose ids hash
    lowest, and ``SAMPLE_CHUNKS`` chunks of each. The class shares are counted over all labelled
    rows. Where a class has no documents, the share of label 1 (1 without labels) is returned.
    """
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("key"), F.col("quality").cast("int").alias("quality"))
    share = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    if len(share) < 2:
        return float(share.get(1, 0 if share else 1) > 0)
    picked = [known.where(F.col("quality") == q).orderBy(F.xxhash64("key"), "key").limit(SAMPLE_DOCS)
              for q in (0, 1)]
    rows = (docs.select(F.col("doc_id").cast("long").alias("key"), "text")
            .join(F.broadcast(picked[0].unionByName(picked[1])), "key")  # 3,000 rows at most
            .select("key", "quality", "text").mapInArrow(tb.tidy(_chunks), _SAMPLE).collect())
    rows.sort(key=lambda r: (r.key, r.quality))
    if len({r.quality for r in rows}) < 2:
        return share[1] / (share[0] + share[1])
    keys = [(r.key, r.quality) for r in rows]
    fresh = np.array([i == 0 or keys[i] != keys[i - 1] for i in range(len(keys))])
    x = np.frombuffer(b"".join(bytes(r.chunks) for r in rows), np.uint8).reshape(len(rows), -1)
    label = np.array([r.quality for r in rows], np.float32)[fresh]
    net = train(x, np.array([r.n for r in rows]), np.cumsum(fresh) - 1, label)
    net.shift = float(np.log(share[1] / share[0]))
    return net


def scores(docs: DataFrame, model: Network | float, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 if score >= threshold).

    The whole text is scored; null counts as empty, and empty texts get a score too. Rows without
    an id are not held out; repeated rows are scored alike. Other columns are not looked at.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    found = (slim.mapInArrow(tb.tidy(_scorer(model)), _SCORES) if isinstance(model, Network)
             else slim.select("doc_id", "held_out", F.lit(float(model)).alias("score")))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without those that the classifier rejects.

    Every row is scored by its own text, whatever its id; null counts as empty. Rows without an id
    have no label to learn from.
    """
    model = fit(docs, labels)
    if not isinstance(model, Network):
        return docs if model >= threshold else docs.limit(0)
    scorer, columns = _scorer(model), docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            for part in tb.slices(batch, "text", SLICE_BYTES):
                n = part.num_rows
                slim = pa.RecordBatch.from_arrays(
                    [pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), part.column("text")],
                    names=["doc_id", "held_out", "text"])
                scored = pa.Table.from_batches(scorer(iter([slim])))
                yield part.filter(pc.greater_equal(scored["score"].combine_chunks(), threshold))

    return docs.mapInArrow(tb.tidy(keep), docs.schema).select(*columns)
