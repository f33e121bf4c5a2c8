"""Quality of whole texts by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` bytes.  Each passage becomes a vector: how often
each class of bytes follows each other, and how much its words repeat.  A small network
encodes every passage, gated attention weighs the passages of a text, and the weighted
mean is scored.  Only texts carry labels; the attention learns which passages matter.

The network is trained in numpy on a bounded, documented number of labelled texts
(``per_label`` of each label, and ``most`` passages of all together), on every passage of
each, in at least ``UPDATES`` steps however few they are.  Scoring reads every passage of
every text.

Defined results: null, empty and blank texts are one passage without bytes and get that
passage's score; without any training label the score is 0.5; with one label only, that
label.  Equal texts get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmark.llm import words as W
from textmark.llm.frames import narrowed, stored
from textmark.llm.labelled import sampled

PASSAGE = 512
PER_LABEL = 4000
ENCODED = 24
GATED = 12
#: Passages of all sampled texts together; the driver holds 522 bytes of each.
MOST_PASSAGES = 1 << 17
EPOCHS = 12
UPDATES = 600
ACCEPTED = 0.7

_CLASSES = 16
FEATURES = _CLASSES * _CLASSES + 5


def _byte_classes() -> np.ndarray:
    of = np.full(256, 12, np.int64)  # other punctuation
    of[0:32] = 15
    of[ord("a") : ord("z") + 1] = 0
    for c in "aeiou":
        of[ord(c)] = 1
    of[ord("A") : ord("Z") + 1] = 2
    of[ord("0") : ord("9") + 1] = 3
    of[ord(" ")], of[ord("\t")], of[ord("\n")] = 4, 4, 5
    for c, k in ((".", 6), (",", 7), ("!", 8), ("?", 8), ("|", 9), ("<", 10), (">", 10), ("/", 10)):
        of[ord(c)] = k
    for c in "*&#$%@^~=_+\\":
        of[ord(c)] = 11
    of[0x80:0xC0], of[0xC0:] = 14, 13
    return of


_CLASS_OF = _byte_classes()


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of all passages of a run of texts, and how many per text (at least one)."""
    lengths = np.diff(offsets)
    counts = np.maximum(-(-lengths // PASSAGE), 1)
    first = np.cumsum(counts) - counts
    total = int(counts.sum())
    n = len(data)
    text = np.repeat(np.arange(len(lengths)), lengths)
    of = first[text] + (np.arange(n) - offsets[text]) // PASSAGE
    cls = _CLASS_OF[data]
    table = np.zeros((total, FEATURES), np.float32)
    square = _CLASSES * _CLASSES
    if n > 1:
        inside = np.flatnonzero(text[1:] == text[:-1])
        code = of[inside] * square + cls[inside] * _CLASSES + cls[inside + 1]
        table[:, :square] = np.bincount(code, minlength=total * square).reshape(total, square)
    size = np.bincount(of, minlength=total).astype(np.float32) if n else np.zeros(total, np.float32)
    np.sqrt(table[:, :square] / np.maximum(size, 1)[:, None], out=table[:, :square])
    words = W.words_of(data, offsets, W.NOT_SPACE)
    at = of[words.starts]
    count = np.bincount(at, minlength=total)
    some = np.maximum(count, 1)
    table[:, square + 2] = np.minimum(np.maximum(size, 1) / some / 16, 4)
    if len(at):
        again = np.zeros(len(at))
        again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (at[1:] == at[:-1])
        pairs = np.lexsort((words.hashes, at))
        new = np.ones(len(at), bool)
        new[1:] = (words.hashes[pairs][1:] != words.hashes[pairs][:-1]) | (at[pairs][1:] != at[pairs][:-1])
        table[:, square] = np.bincount(at, weights=again, minlength=total) / some
        table[:, square + 1] = np.bincount(at[pairs][new], minlength=total) / some
    table[:, square + 3] = size / PASSAGE
    table[:, square + 4] = np.repeat(np.log1p(lengths) / 12, counts)
    return table, counts


def _sums(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, np.cumsum(counts) - counts, axis=0)


@dataclass
class Model:
    """Weights of the encoder, the attention and the score."""

    w: dict[str, np.ndarray]
    constant: float | None = None

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        h = np.tanh(x @ w["enc"] + w["enc_b"])
        v = np.tanh(h @ w["att"])
        u = 1 / (1 + np.exp(-(h @ w["gate"])))
        e = (v * u) @ w["pick"]
        text = np.repeat(np.arange(len(counts)), counts)
        e = np.exp(e - np.maximum.reduceat(e, np.cumsum(counts) - counts)[text])
        a = e / _sums(e, counts)[text]
        z = _sums(h * a[:, None], counts)
        p = 1 / (1 + np.exp(-(z @ w["out"] + w["out_b"][0])))
        return {"h": h, "v": v, "u": u, "a": a, "z": z, "p": p, "text": text}

    def score(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(counts), self.constant)
        return self.forward(x, counts)["p"].astype(np.float64)

    def gradient(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.w, self.forward(x, counts)
        d = ((f["p"] - y) / len(y)).astype(np.float32)
        dz = d[:, None] * w["out"][None, :]
        text, a, h, v, u = f["text"], f["a"], f["h"], f["v"], f["u"]
        dh = a[:, None] * dz[text]
        da = (h * dz[text]).sum(1)
        de = a * (da - _sums(a * da, counts)[text])
        dvu = de[:, None] * w["pick"][None, :]
        dv = dvu * u * (1 - v * v)
        du = dvu * v * u * (1 - u)
        dh = dh + dv @ w["att"].T + du @ w["gate"].T
        dpre = dh * (1 - h * h)
        return {
            "enc": x.T @ dpre, "enc_b": dpre.sum(0), "att": h.T @ dv, "gate": h.T @ du,
            "pick": (v * u).T @ de, "out": f["z"].T @ d, "out_b": d.sum(keepdims=True),
        }


def train(
    bags: list[np.ndarray], labels: np.ndarray, epochs: int | None = None, batch: int = 128, rate: float = 4e-3,
    decay: float = 1e-5, seed: int = 7,
) -> Model:
    """Adam on the log loss of the texts' labels; the same bags give the same model.

    Few texts are gone through more often, so that they make ``UPDATES`` steps too.
    """
    if len(bags) == 0:
        return Model({}, 0.5)
    if labels.min() == labels.max():
        return Model({}, float(labels[0]))
    rng = np.random.default_rng(seed)
    shape = {
        "enc": (FEATURES, ENCODED), "enc_b": (ENCODED,), "att": (ENCODED, GATED), "gate": (ENCODED, GATED),
        "pick": (GATED,), "out": (ENCODED,), "out_b": (1,),
    }
    w = {k: (rng.standard_normal(s) * (1 / np.sqrt(s[0])) * (k[-2:] != "_b")).astype(np.float32) for k, s in shape.items()}
    model, m, s, t = Model(w), {k: 0.0 for k in w}, {k: 0.0 for k in w}, 0
    each = -(-len(bags) // batch)
    epochs = max(EPOCHS, -(-UPDATES // each)) if epochs is None else epochs
    steps = epochs * each
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            chosen = order[i : i + batch]
            x = np.concatenate([bags[j] for j in chosen]).astype(np.float32)
            g = model.gradient(x, np.array([len(bags[j]) for j in chosen]), labels[chosen].astype(np.float32))
            t += 1
            now = rate * (1 - t / (steps + 1))
            for k in w:
                grad = g[k] + decay * w[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                s[k] = 0.999 * s[k] + 0.001 * grad * grad
                w[k] -= (now * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return model


def _encoder():
    @F.arrow_udf(T.BinaryType())
    def encode(texts: pa.Array) -> pa.Array:
        out = []
        for _, _, data, offsets in W.chunks(texts):
            table, counts = passages(data, offsets)
            out += [rows.astype(np.float16).tobytes() for rows in np.split(table, np.cumsum(counts)[:-1])]
        return pa.array(out, pa.binary())

    return encode


def fitting(sizes: pa.Table, most: int) -> list[int]:
    """Rows, in the order of ``nth`` within each label, whose passages are at most ``most``.

    Labels share that evenly; a text that would go beyond is passed over for later ones.
    """
    rows, kept = sizes.to_pylist(), []
    for label in sorted({x["label"] for x in rows}):
        left = most // 2
        for x in sorted((x for x in rows if x["label"] == label), key=lambda x: (x["nth"], x["key"], x["passages"])):
            if x["passages"] <= left:
                left -= x["passages"]
                kept.append(x["key"])
    return kept


def fit(
    texts: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    per_label: int = PER_LABEL, most: int = MOST_PASSAGES,
) -> Model:
    """Train on at most ``per_label`` texts of each label (0 or 1), ``most`` passages together."""
    labels = labels.where(F.col(label).isin(0, 1))
    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = narrowed(rows, stored(sampled(labels, key, label, per_label), "quality-sample"), ["key"])
    passages_ = F.greatest(F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / PASSAGE), F.lit(1))
    sizes = rows.groupBy("key", "label").agg(F.sum(passages_).alias("passages"))
    kept = fitting(sizes.select("key", "label", "passages", F.xxhash64(F.lit("bags"), "key").alias("nth")).toArrow(), most)
    chosen = F.broadcast(texts.sparkSession.createDataFrame([(x,) for x in kept], "key long"))
    rows = rows.join(chosen, "key").select("key", "label", _encoder()("text").alias("bag")).toArrow()
    rows = rows.sort_by([("key", "ascending"), ("bag", "ascending")])
    bags = [np.frombuffer(x.as_buffer(), np.float16).reshape(-1, FEATURES) for x in rows["bag"]]
    return train(bags, rows["label"].to_numpy().astype(np.int64))


def scorer(model: Model):
    """A function from a text column to its score."""

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        parts = [model.score(*passages(data, offsets)) for _, _, data, offsets in W.chunks(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score


def accepted(score: Column) -> Column:
    return score >= ACCEPTED
