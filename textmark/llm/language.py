"""Languages of whole texts by a small convolutional network over bytes.

A text is cut into windows of ``WINDOW`` bytes.  Bytes are embedded, filters of two, three and
four bytes run over each window, the strongest answer of each filter is kept, and a softmax
gives the window's log-probabilities.  A text's prediction is the mean over all its windows,
weighted by their bytes.

The network is trained in numpy, with gradients written out, on a bounded, documented number
of labelled texts (``per_label`` of each language, ``train_windows`` evenly spaced windows of
each).  Prediction reads every byte of every text.

Defined results: a text that is null or has no letter is ``und`` with score 0; without any
labelled text everything is ``und``; equal texts get equal predictions; of equally likely
languages the first in name order is taken.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmark.llm import words as W
from textmark.llm.frames import narrowed
from textmark.llm.labelled import sampled

WINDOW = 240  # a multiple of every filter width
WIDTHS = (2, 3, 4)
EMBEDDED = 8
FILTERS = 16
PER_LABEL = 600
TRAIN_WINDOWS = 6
EPOCHS = 5
UNKNOWN = "und"
RUN_BYTES = 1 << 18

_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[0x41:0x5B] += 32
_LETTER = re.compile(r"[^\W\d_]")


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows as rows of bytes, padded with zeros; how many per text; bytes in each."""
    lengths = np.diff(offsets)
    counts = -(-lengths // WINDOW)
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()) * WINDOW, np.uint8)
    text = np.repeat(np.arange(len(lengths)), lengths)
    out[first[text] * WINDOW + np.arange(len(data)) - offsets[text]] = _SMALL[data]
    size = np.full(int(counts.sum()), WINDOW)
    some = counts > 0
    size[(first + counts - 1)[some]] = lengths[some] - (counts[some] - 1) * WINDOW
    return out.reshape(-1, WINDOW), counts, size


def _strongest(x: np.ndarray) -> np.ndarray:
    """Largest value over the middle axis, by halves."""
    while x.shape[1] > 1:
        half = x.shape[1] // 2
        top = np.maximum(x[:, :half], x[:, half : 2 * half])
        if x.shape[1] % 2:
            np.maximum(top[:, 0], x[:, -1], out=top[:, 0])
        x = top
    return x[:, 0]


@dataclass
class Network:
    languages: list[str]
    w: dict[str, np.ndarray]

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """Strongest answer of each filter in each window.

        Answers at positions that differ by the filter's width come from one matrix product
        over the embedded bytes as they lie in memory.
        """
        n = len(rows)
        flat = self.w["embed"][rows.ravel()].reshape(-1)
        flat = np.append(flat, np.zeros(EMBEDDED * max(WIDTHS), np.float32))
        out = []
        for k in WIDTHS:
            best = None
            for shift in range(k):
                at = flat[shift * EMBEDDED : shift * EMBEDDED + n * WINDOW * EMBEDDED]
                answers = (at.reshape(-1, k * EMBEDDED) @ self.w[f"conv{k}"]).reshape(n, WINDOW // k, FILTERS)
                if shift:  # the last position would reach into the next window
                    answers = answers[:, :-1]
                answers = _strongest(answers)
                best = answers if best is None else np.maximum(best, answers)
            out.append(best)
        return np.concatenate(out, axis=1)

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        step = RUN_BYTES // WINDOW
        out = [self._head(self.pooled(rows[i : i + step])) for i in range(0, len(rows), step)]
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)), np.float32)

    def _head(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.w["bias"], 0) @ self.w["out"] + self.w["out_b"]
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities per text; rows of zeros for texts without bytes."""
        rows, counts, size = windows(data, offsets)
        scores = self.log_probabilities(rows) * size[:, None]
        out = np.zeros((len(counts), len(self.languages)))
        text = np.repeat(np.arange(len(counts)), counts)
        np.add.at(out, text, scores)
        some = counts > 0
        out[some] /= np.diff(offsets)[some][:, None]
        out[some] = np.exp(out[some] - out[some].max(1, keepdims=True))
        out[some] /= out[some].sum(1, keepdims=True)
        return out

    def gradient(self, rows: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, n = self.w, len(rows)
        embedded = w["embed"][rows]
        pooled, where, patches = [], [], []
        for k in WIDTHS:
            view = np.lib.stride_tricks.sliding_window_view(embedded, k, axis=1)  # (n, positions, E, k)
            flat = view.transpose(0, 1, 3, 2).reshape(n, WINDOW - k + 1, k * EMBEDDED)
            answers = flat @ w[f"conv{k}"]
            best = answers.argmax(1)
            pooled.append(np.take_along_axis(answers, best[:, None, :], 1)[:, 0])
            where.append(best)
            patches.append(flat[np.arange(n)[:, None], best])  # (n, F, k * E)
        pooled = np.concatenate(pooled, axis=1)
        hidden = np.maximum(pooled + w["bias"], 0)
        p = np.exp(self._head(pooled))
        p[np.arange(n), y] -= 1
        p = (p / n).astype(np.float32)
        back = (p @ w["out"].T) * (hidden > 0)
        g = {"out": hidden.T @ p, "out_b": p.sum(0), "bias": back.sum(0), "embed": np.zeros_like(w["embed"])}
        for i, k in enumerate(WIDTHS):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            g[f"conv{k}"] = np.einsum("nf,nfe->ef", part, patches[i])
            into = part[:, :, None] * w[f"conv{k}"].T[None]  # (n, F, k * E)
            for j in range(k):
                byte = np.take_along_axis(rows, where[i] + j, 1)
                np.add.at(g["embed"], byte.ravel(), into[:, :, j * EMBEDDED : (j + 1) * EMBEDDED].reshape(-1, EMBEDDED))
        return g


def train(
    rows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, batch: int = 64,
    rate: float = 5e-3, seed: int = 11,
) -> Network:
    """Adam on the log loss of the windows; the same windows give the same network."""
    rng = np.random.default_rng(seed)
    shape = {"embed": (256, EMBEDDED), "out": (FILTERS * len(WIDTHS), len(languages))}
    shape |= {f"conv{k}": (k * EMBEDDED, FILTERS) for k in WIDTHS}
    w = {k: (rng.standard_normal(s) / np.sqrt(s[0] if k != "embed" else 2)).astype(np.float32) for k, s in shape.items()}
    w |= {"bias": np.zeros(FILTERS * len(WIDTHS), np.float32), "out_b": np.zeros(len(languages), np.float32)}
    net, m, s, t = Network(languages, w), {k: 0.0 for k in w}, {k: 0.0 for k in w}, 0
    steps = epochs * -(-len(rows) // batch)
    for _ in range(epochs if len(languages) > 1 else 0):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), batch):
            chosen = order[i : i + batch]
            g = net.gradient(rows[chosen], labels[chosen])
            t += 1
            now = rate * (1 - t / (steps + 1))
            for k in w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] * g[k]
                w[k] -= (now * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def _windows_of(most: int):
    @F.arrow_udf(T.BinaryType())
    def take(texts: pa.Array) -> pa.Array:
        out = []
        for _, _, data, offsets in W.chunks(texts):
            rows, counts, size = windows(data, offsets)
            for own, some in zip(np.split(rows, np.cumsum(counts)[:-1]), np.split(size, np.cumsum(counts)[:-1]), strict=True):
                if len(own) > 1 and some[-1] < WINDOW // 4:
                    own = own[:-1]  # too little in the last one to learn from
                if len(own) > most:
                    own = own[np.linspace(0, len(own) - 1, most).astype(np.int64)]
                out.append(own.tobytes())
        return pa.array(out, pa.binary())

    return take


def fit(
    texts: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", per_label: int = PER_LABEL,
    train_windows: int = TRAIN_WINDOWS,
) -> Network | None:
    """Train on at most ``per_label`` texts of each language; None without any."""
    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = narrowed(rows, sampled(texts.where(F.col(text).isNotNull()), key, label, per_label), ["key"])
    rows = rows.select("key", "label", _windows_of(train_windows)("text").alias("rows")).toArrow()
    rows = rows.sort_by([("key", "ascending"), ("rows", "ascending")])
    found, of = [], []
    names = sorted(set(rows["label"].to_pylist()))
    index = {name: i for i, name in enumerate(names)}
    for label_, own in zip(rows["label"].to_pylist(), rows["rows"], strict=True):
        own = np.frombuffer(own.as_buffer(), np.uint8).reshape(-1, WINDOW)
        found.append(own)
        of.append(np.full(len(own), index[label_]))
    if not found or not sum(map(len, found)):
        return None
    return train(np.concatenate(found), np.concatenate(of), names)


RESULT = T.StructType([T.StructField("language", T.StringType()), T.StructField("score", T.DoubleType())])


def predictor(net: Network | None):
    """A function from a text column to ``RESULT``."""

    @F.arrow_udf(RESULT)
    def predict(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for start, stop, data, offsets in W.chunks(texts):
            lettered = [bool(x.is_valid and _LETTER.search(x.as_py())) for x in texts.slice(start, stop - start)]
            p = net.texts(data, offsets) if net else np.zeros((stop - start, 1))
            best = p.argmax(1)
            known = np.array(lettered, bool) & (net is not None)
            names += [net.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            scores.append(np.where(known, p[np.arange(len(p)), best], 0.0))
        score = np.concatenate(scores) if scores else np.zeros(0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score)], ["language", "score"])

    return predict


