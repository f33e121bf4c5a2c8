"""Log-probabilities of whole texts by a log-bilinear model over two preceding words.

Tokens are lower-cased words and one end per text.  The model predicts a token's class: one
of the ``shortlist - 2`` most frequent words, the end, or any other word; the word itself
then follows from smoothed counts.  The score of a class in its context is bilinear,
``(r1[before] + r2[before that]) . q[class] + bias[class]``; a matrix product per block of
contexts gives the scores of all classes, and so normalised log-probabilities.

Training is noise-contrastive estimation in numpy on every training text: each task turns
its texts into counts of contexts and classes, improves the shared weights on them, and the
weights are averaged by token in Spark, for a few rounds.  The noise is the classes' own
frequency; its expectation over all classes replaces drawn samples.

Word counts cover all training texts.  The end and words above a count that at most ``heavy``
words reach are sent to the tasks (a bounded table); all rarer words are joined by hash.

Defined results: null and empty texts are one end token; a null key is scored but its fold
decides as null (not in training, ``held_out`` null); rows that repeat are scored each;
without training texts both scores are those of the empty count table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmark.llm import words as W
from textmark.llm.frames import stored

HEAVY = 1 << 18
SHORTLIST = 512
WIDTH = 24
ROUNDS = 3
PASSES = 2
NOISE = 10.0
SMOOTHING = 0.1
OTHER, STOP = 0, 1
END = np.uint64(0)
UNIT_TOKENS = 4 << 20


def token_stream(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of consecutive texts with an end after each, and the text of each."""
    texts = len(words.counts)
    size = words.counts + 1
    out = np.full(int(size.sum()), END, np.uint64)
    out[np.arange(len(words.hashes)) + words.text] = words.hashes
    return out, np.repeat(np.arange(texts), size)


def _streams(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for start, stop, data, offsets in W.chunks(batch.column("text")):
        yield start, stop, *token_stream(W.words_of(data, offsets, W.NOT_SPACE))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        tokens, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n)], names=["token", "n"])

    for batch in batches:
        for _, _, tokens, _ in _streams(batch):
            held.append(tokens)
            if sum(map(len, held)) >= UNIT_TOKENS:
                yield flush()
    if held:
        yield flush()


class Vocabulary:
    """Counts of the frequent tokens, and class numbers of the most frequent ones."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, total: int, distinct: int, shortlist: int):
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order].astype(np.float64)
        self.total, self.distinct = total, distinct
        words = np.flatnonzero(self.tokens != END)
        top = words[np.lexsort((self.tokens[words], -self.counts[words]))][: shortlist - 2]
        self.of = np.full(len(self.tokens), OTHER, np.int64)
        self.of[top] = np.arange(2, 2 + len(top))
        self.of[self.tokens == END] = STOP
        self.classes = 2 + len(top)
        listed = self.of != OTHER
        #: Tokens and words that are not listed.
        self.other_total = total - self.counts[listed].sum()
        self.other_distinct = distinct - int(listed.sum())

    def look_up(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row in the table, or -1; class."""
        if len(self.tokens) == 0:
            return np.full(len(tokens), -1), np.where(tokens == END, STOP, OTHER)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        at[self.tokens[at] != tokens] = -1
        of = np.where(at >= 0, self.of[at], OTHER)
        of[tokens == END] = STOP
        return at, of

    def class_counts(self) -> np.ndarray:
        out = np.full(self.classes, SMOOTHING)
        listed = self.of != OTHER
        out[self.of[listed]] += self.counts[listed]
        out[OTHER] += max(self.other_total, 0)
        return out


def contexts(of: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the token before each token and of the one before that; ends before a text."""
    one = np.full(len(of), STOP)
    two = np.full(len(of), STOP)
    one[1:] = np.where(text[1:] == text[:-1], of[:-1], STOP)
    two[2:] = np.where(text[2:] == text[:-2], of[:-2], STOP)
    return one, two


def _counted_contexts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        s, held = vocabulary.classes, []

        def flush() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([int(n.sum())]), pa.array([codes.astype("<i8").tobytes()], pa.binary()), pa.array([n.astype("<i4").tobytes()], pa.binary())],
                names=["weight", "codes", "n"],
            )

        for batch in batches:
            for _, _, tokens, text in _streams(batch):
                of = vocabulary.look_up(tokens)[1]
                one, two = contexts(of, text)
                held.append((two * s + one) * s + of)
                if sum(map(len, held)) >= UNIT_TOKENS:
                    yield flush()
        if held:
            yield flush()

    return run


SHAPES = ("r1", "r2", "q", "bias")


def initial(counts: np.ndarray, width: int, seed: int = 5) -> dict[str, np.ndarray]:
    rng, s = np.random.default_rng(seed), len(counts)
    w = {k: (rng.standard_normal((s, width)) * 0.1).astype(np.float32) for k in SHAPES[:3]}
    return w | {"bias": np.log(counts / counts.sum()).astype(np.float32)}


def improved(
    w: dict[str, np.ndarray], codes: np.ndarray, n: np.ndarray, noise: np.ndarray,
    passes: int = PASSES, k: float = NOISE, batch: int = 1024, rate: float = 0.02, seed: int = 0,
) -> dict[str, np.ndarray]:
    """Adagrad on the noise-contrastive loss of counted contexts.

    A class is told from k noise classes by ``score - log(k * noise)``; the loss sums over all
    classes, each weighted by its count (as data) and its expected count (as noise).
    """
    s = len(noise)
    w = {name: x.copy() for name, x in w.items()}
    past = {name: np.full_like(x, 1e-6) for name, x in w.items()}
    context, first, inverse = np.unique(codes // s, return_index=True, return_inverse=True)
    target, total = codes % s, np.bincount(inverse, weights=n)
    log_noise, expected = np.log(k * noise).astype(np.float32), (k * noise).astype(np.float32)
    ends = np.append(first[1:], len(codes))
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        order = rng.permutation(len(context))
        for i in range(0, len(order), batch):
            chosen = order[i : i + batch]
            one, two = context[chosen] % s, context[chosen] // s
            size = ends[chosen] - first[chosen]
            row = np.repeat(np.arange(len(chosen)), size)
            at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[chosen], size)
            c = w["r1"][one] + w["r2"][two]
            p = 1 / (1 + np.exp(-np.clip(c @ w["q"].T + w["bias"] - log_noise, -30, 30)))
            g = p * expected * total[chosen].astype(np.float32)[:, None]
            seen = n[at].astype(np.float32)
            g[row, target[at]] += seen * (p[row, target[at]] - 1)
            g /= total[chosen].sum()
            dc = g @ w["q"]
            grads = {"q": g.T @ c, "bias": g.sum(0), "r1": _scattered(one, dc, s), "r2": _scattered(two, dc, s)}
            for name, grad in grads.items():
                past[name] += grad * grad
                w[name] -= rate * grad / np.sqrt(past[name])
    return w


def _scattered(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    cuts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    out = np.zeros((n, values.shape[1]), np.float32)
    out[rows[cuts]] = np.add.reduceat(values[order], cuts, axis=0)
    return out


def _flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[name].ravel() for name in SHAPES])


def _unflat(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name in SHAPES:
        out[name] = flat[at : at + like[name].size].reshape(like[name].shape).astype(np.float32)
        at += like[name].size
    return out


def _round(shared, noise: np.ndarray, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = None, 0
        for batch in batches:
            for size, codes, n in zip(batch["weight"], batch["codes"], batch["n"], strict=True):
                codes, n = np.frombuffer(codes.as_buffer(), "<i8"), np.frombuffer(n.as_buffer(), "<i4")
                w = _flat(improved(shared.value, codes, n, noise, seed=seed)).astype(np.float64) * size.as_py()
                total, weight = (w if total is None else total + w), weight + size.as_py()
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total), pa.array(np.full(len(total), float(weight)))],
                names=["place", "value", "weight"],
            )

    return run


def trained(units: DataFrame, counts: np.ndarray, width: int = WIDTH, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Weights after rounds of training in the tasks and averaging by token."""
    w, noise = initial(counts, width), counts / counts.sum()
    for number in range(rounds):
        shared = units.sparkSession.sparkContext.broadcast(w)
        rows = units.mapInArrow(_round(shared, noise, number), "place int, value double, weight double")
        mean = rows.groupBy("place").agg((F.sum("value") / F.sum("weight")).alias("value")).toArrow()
        if mean.num_rows:
            w = _unflat(mean.sort_by("place")["value"].to_numpy(), w)
    return w


class Model:
    """Scores of classes by the two classes before them, and what normalises them."""

    def __init__(self, vocabulary: Vocabulary, w: dict[str, np.ndarray]):
        self.vocabulary = vocabulary
        s = vocabulary.classes
        self.by_one = w["r1"] @ w["q"].T + w["bias"]
        self.by_two = w["r2"] @ w["q"].T
        self.norm = np.empty((s, s), np.float32)  # [before that, before]
        for two in range(s):
            z = self.by_one + self.by_two[two]
            top = z.max(1)
            self.norm[two] = top + np.log(np.exp(z - top[:, None]).sum(1))

    def log10(self, of: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return (self.by_one[one, of] + self.by_two[two, of] - self.norm[two, one]).astype(np.float64) / np.log(10)


_SCORED = "key {0}, row long, n_tokens long, n_known long, n_other long, logs double, other_logs double, classes double, rare array<long>, times array<int>"


def _scored(shared):
    """Per text: sums over frequent tokens and classes, and its rarer words for the join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model: Model = shared.value
        v = model.vocabulary
        logs = np.append(np.log10(v.counts + SMOOTHING), 0.0)  # the last for tokens outside
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start, stop, tokens, text in _streams(batch):
                rows = stop - start
                at, of = v.look_up(tokens)
                value, other, rare = logs[at], of == OTHER, at < 0
                sums = lambda x, text=text, rows=rows: np.bincount(text, weights=x, minlength=rows)
                order = np.lexsort((tokens[rare], text[rare]))
                t, x = text[rare][order], tokens[rare][order]
                new = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (x[1:] != x[:-1]))) if len(t) else np.zeros(0, np.int64)
                times = np.diff(np.append(new, len(t)))
                per_text = np.bincount(t[new], minlength=rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(start, rows),
                        pa.array(number + np.arange(rows)),
                        pa.array(np.bincount(text, minlength=rows)),
                        pa.array(sums(~rare).astype(np.int64)),
                        pa.array(sums(other).astype(np.int64)),
                        pa.array(sums(value)),
                        pa.array(sums(value * other)),
                        pa.array(sums(model.log10(of, *contexts(of, text)))),
                        W.list_array(pa.array(x[new].view(np.int64)), per_text),
                        W.list_array(pa.array(times.astype(np.int32)), per_text),
                    ],
                    names=["key", "row", "n_tokens", "n_known", "n_other", "logs", "other_logs", "classes", "rare", "times"],
                )
                number += rows

    return run


def _vocabulary(counts: DataFrame, heavy: int, shortlist: int) -> Vocabulary:
    """The end, and the frequent words: those above a count that at most ``heavy`` tokens reach.

    The end stays in the table however rare it is among the tokens, as it is in few, very long
    texts: it takes no part in the join of rarer words.
    """
    step = F.floor(F.log2("n") * 16).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("tokens"), F.sum("n").alias("n")).collect()
    total, distinct = sum(x["n"] for x in steps), sum(x["tokens"] for x in steps)
    least, so_far = None, 0
    for x in sorted(steps, key=lambda x: -x["step"]):
        so_far += x["tokens"]
        if so_far > heavy:
            break
        least = x["step"]
    is_end = F.col("token") == int(END)
    frequent = counts.where(is_end if least is None else is_end | (step >= least)).toArrow()
    tokens = frequent["token"].to_numpy().view(np.uint64)
    return Vocabulary(tokens, frequent["n"].to_numpy(), total, distinct, shortlist)


def scores(
    df: DataFrame, training: Column, key: str = "doc_id", text: str = "text", heavy: int = HEAVY, shortlist: int = SHORTLIST,
) -> DataFrame:
    """``key, n_tokens, n_known, train_tokens, base_score, score`` per row of ``df``.

    ``training`` says which rows to learn from.
    """
    spark = df.sparkSession
    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    learned = df.where(training).select(F.col(text).alias("text"))
    counts = learned.mapInArrow(_counted, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counts = stored(counts, "lm-counts")
    vocabulary = _vocabulary(counts, heavy, shortlist)
    shared = spark.sparkContext.broadcast(vocabulary)
    units = stored(learned.mapInArrow(_counted_contexts(shared), "weight long, codes binary, n binary"), "lm-contexts")
    model = Model(vocabulary, trained(units, vocabulary.class_counts()))

    kind = dict(docs.dtypes)["key"]
    rows = docs.mapInArrow(_scored(spark.sparkContext.broadcast(model)), _SCORED.format(kind))
    rows = stored(rows, "lm-scored")
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x"))
    rare = rare.select("row", F.col("x.rare").alias("token"), F.col("x.times").alias("times"))
    rare = rare.join(counts.where(F.col("token") != 0), "token", "left")
    known = F.col("n").isNotNull()
    rare = rare.groupBy("row").agg(
        F.sum(F.when(known, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTHING))).alias("rare_logs"),
    )
    n, v = vocabulary.total, vocabulary.distinct
    whole = float(np.log10(n + SMOOTHING * (v + 1)))
    others = float(np.log10(max(vocabulary.other_total, 0) + SMOOTHING * (max(vocabulary.other_distinct, 0) + 1)))
    out = rows.drop("rare", "times").join(rare, "row", "left").fillna(0, ["rare_known", "rare_logs"])
    base = F.col("logs") + F.col("rare_logs") - F.col("n_tokens") * whole
    model_score = F.col("classes") + F.col("other_logs") + F.col("rare_logs") - F.col("n_other") * others
    return out.select(
        F.col("key").alias(key),
        "n_tokens",
        (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (model_score if n else base).alias("score"),
    )
