"""A byte-level convolutional network that scores the quality of a text.

Bytes are embedded, learned filters of 8 bytes slide over overlapping chunks that cover the
whole text, a byte at a time, each filter's maximum in a chunk is kept, and the mean and the maximum of
these over all chunks are combined into one probability.  Fitted by Adam on
at most ``TRAIN_ROWS`` labelled rows, whole texts, on the driver; scored in tasks.
A null text is an empty one: one chunk of padding.  Texts of any length are scored whole, a
bounded number of chunks at once.  Repeated rows and rows without an id are scored as
any other; equal texts score alike, an empty table gives no rows.  Ties of a filter's places
within a chunk go to the first, and in fitting chunks that tie share the gradient.  Without labels of both kinds every
score is the share of label 1 (one half if there are none).
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bound of the labelled sample, and of the bytes of its texts in a step.
TRAIN_ROWS = 3000
STEPS, BATCH = 300, 48
CHUNK, OVERLAP = 512, 64
EMBED, WIDTH, STRIDE, FILTERS = 8, 8, 1, 32
#: Chunks that are worked out at once.
AT_ONCE = 256


def chunked(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of all texts, padded with zero bytes, and the number of chunks of each text."""
    step = CHUNK - OVERLAP
    count = np.array([max(1, -(-(len(t) - OVERLAP) // step)) for t in texts], np.int64)
    data = np.zeros((int(count.sum()), CHUNK), np.uint8)
    at = 0
    for text, n in zip(texts, count.tolist()):
        raw = np.frombuffer(text, np.uint8)
        padded = np.zeros((n - 1) * step + CHUNK, np.uint8)
        padded[: len(raw)] = raw
        data[at : at + n] = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]
        at += n
    return data, count


class Net:
    def __init__(self, seed=0):
        rng = np.random.default_rng(seed)
        scale = 1 / np.sqrt(WIDTH * EMBED)
        self.p = {
            "embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "filters": rng.normal(0, 2 * scale, (WIDTH * EMBED, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": np.zeros(2 * FILTERS, np.float32),
            "base": np.zeros(1, np.float32),
        }

    def windows(self, data: np.ndarray) -> np.ndarray:
        x = self.p["embed"][data].reshape(len(data), -1)
        return np.lib.stride_tricks.sliding_window_view(x, WIDTH * EMBED, axis=1)[:, :: STRIDE * EMBED]

    def pooled(self, data: np.ndarray, places=False):
        """Greatest response of each filter in each chunk, and where it is if asked for."""
        value = np.empty((len(data), FILTERS), np.float32)
        where = np.empty((len(data), FILTERS), np.int64)
        for at in range(0, len(data), AT_ONCE):
            part = data[at : at + AT_ONCE]
            x = self.windows(part)
            y = (x.reshape(-1, WIDTH * EMBED) @ self.p["filters"]).reshape(len(part), -1, FILTERS)
            if places:
                where[at : at + AT_ONCE] = y.argmax(axis=1)
            value[at : at + AT_ONCE] = y.max(axis=1)
        return np.maximum(value + self.p["bias"], 0), where

    def combine(self, pooled: np.ndarray, count: np.ndarray) -> np.ndarray:
        start = np.concatenate([[0], np.cumsum(count)])[:-1]
        mean = np.add.reduceat(pooled, start, axis=0) / count[:, None]
        most = np.maximum.reduceat(pooled, start, axis=0)
        return np.concatenate([mean, most], axis=1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        data, count = chunked(texts)
        logit = self.combine(self.pooled(data)[0], count) @ self.p["out"] + self.p["base"]
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -40, 40)))

    def gradients(self, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
        data, count = chunked(texts)
        pooled, where = self.pooled(data, places=True)
        features = self.combine(pooled, count)
        logit = features @ self.p["out"] + self.p["base"]
        wrong = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels) / len(labels)
        owner = np.repeat(np.arange(len(texts)), count)
        back = wrong[:, None] * self.p["out"]
        most = pooled == features[owner, FILTERS:]
        ties = np.add.reduceat(most, np.concatenate([[0], np.cumsum(count)])[:-1], axis=0)[owner]
        g = back[owner, :FILTERS] / count[owner, None] + back[owner, FILTERS:] * most / ties
        g = (g * (pooled > 0)).astype(np.float32)
        x = self.windows(data)
        out = {name: np.zeros_like(v) for name, v in self.p.items()}
        rows = np.arange(len(data))
        at = where * STRIDE
        for f in range(FILTERS):
            live = g[:, f] != 0
            if live.any():
                out["filters"][:, f] = g[live, f] @ x[rows[live], where[live, f]]
                spread = g[live, f, None] * self.p["filters"][:, f]
                places = data[rows[live, None], at[live, f, None] + np.arange(WIDTH)]
                np.add.at(out["embed"], places.ravel(), spread.reshape(-1, EMBED))
        out["bias"] = g.sum(axis=0)
        out["out"] = (wrong @ features).astype(np.float32)
        out["base"] = np.array([wrong.sum()], np.float32)
        return out


def fit(rows: list[tuple[str, int]], steps=STEPS, seed=0):
    """A function from encoded texts to scores."""
    labels = np.array([label for _, label in rows], np.float32)
    if not len(labels) or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.5
        return lambda texts: np.full(len(texts), share)
    texts = [text.encode("utf-8", "surrogatepass") for text, _ in rows]
    net, rng = Net(seed), np.random.default_rng(seed)
    share = labels.mean()
    net.p["base"][:] = np.log(share / (1 - share))
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    classes = [np.flatnonzero(labels == c) for c in (0, 1)]
    rare = min(classes, key=len)
    for step in range(1, steps + 1):
        # a third of each batch has the rarer label; the base is set right afterwards
        chosen = np.concatenate([rng.choice(rare, BATCH // 3), rng.integers(0, len(texts), BATCH - BATCH // 3)])
        grads = net.gradients([texts[i] for i in chosen], labels[chosen])
        rate = 0.01 * min(1, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            net.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    drawn = BATCH // 3 / BATCH * labels[rare[0]] + (1 - BATCH // 3 / BATCH) * share
    net.p["base"] += np.float32(np.log(share / (1 - share)) - np.log(drawn / (1 - drawn)))
    return net.score


def score(docs: DataFrame, scorer, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id and score per row."""

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at = 0
            while at < len(texts):
                part, size = [], 0
                while at + len(part) < len(texts) and size < 1 << 20:
                    part.append((texts[at + len(part)].as_py() or "").encode("utf-8", "surrogatepass"))
                    size += len(part[-1])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(part)), pa.array(scorer(part).astype(np.float64))], ["doc_id", "score"]
                )
                at += len(part)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")
