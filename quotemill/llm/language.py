"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of bytes in both directions, labels every position with a distribution
over languages, and a document gets the mean over all its positions. It is trained in numpy by
backpropagation through time on a bounded sample of labelled windows, and applied to whole texts in
the tasks, many windows side by side.

Gates are clipped lines in place of sigmoids, which cost several times as much.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.mixing import draw

LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


@dataclass(frozen=True)
class Training:
    """``docs_per_label`` labelled rows at most (by a hash of key and text), each with
    ``windows_per_doc`` windows, are learned from; the sample is what the driver holds."""

    docs_per_label: int = 1_000
    windows_per_doc: int = 4
    window: int = 64
    hidden: int = 8
    batch: int = 256
    steps: int = 300
    rate: float = 0.02
    seed: int = 11


class Network:
    """``inputs`` (2, 256, 3H): what each byte adds to the gates, forwards and backwards.
    ``states`` (2, 3H, H), ``outputs`` (2, labels, H), ``bias`` (labels). Gates: reset, keep, new."""

    NAMES = ("inputs", "states", "outputs", "bias")

    def __init__(self, labels: list[str], hidden: int, window: int, seed: int):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden, self.window = labels, hidden, window
        self.inputs = rng.normal(0, 0.3, (2, 256, 3 * hidden)).astype(np.float32)
        self.inputs[:, :, : 2 * hidden] += 0.5
        self.states = rng.normal(0, 0.5 / hidden**0.5, (2, 3 * hidden, hidden)).astype(np.float32)
        self.outputs = rng.normal(0, 0.3, (2, len(labels), hidden)).astype(np.float32)
        self.bias = np.zeros((len(labels), 1), np.float32)

    def _steps(self, side: int, x: np.ndarray, keep: bool = False):
        """States of one direction, in reading order; with ``keep`` all a backward pass needs."""
        h2 = 2 * self.hidden
        states, inputs = self.states[side], self.inputs[side]
        lanes = x.shape[1]
        h = np.zeros((self.hidden, lanes), np.float32)
        taken = np.empty((lanes, 3 * self.hidden), np.float32)
        by_state = np.empty((3 * self.hidden, lanes), np.float32)
        for row in x if side == 0 else x[::-1]:
            np.take(inputs, row, axis=0, out=taken, mode="clip")
            gates = np.ascontiguousarray(taken.T)
            np.matmul(states, h, out=by_state)
            both = gates[:h2]
            both += by_state[:h2]
            np.clip(both, 0, 1, out=both)
            new = by_state[h2:] * both[: self.hidden]
            new += gates[h2:]
            np.tanh(new, out=new)
            before = h
            h = before - new
            h *= both[self.hidden :]
            h += new
            yield (h, before, both, new, by_state[h2:].copy()) if keep else h

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(positions, labels, lanes) for windows ``x`` (positions, lanes)."""
        out = np.empty((len(x), len(self.labels), x.shape[1]), np.float32)
        for t, h in enumerate(self._steps(0, x)):
            np.matmul(self.outputs[0], h, out=out[t])
        for t, h in enumerate(self._steps(1, x)):
            out[len(x) - 1 - t] += self.outputs[1] @ h
        out += self.bias
        out -= out.max(1, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(1, keepdims=True)
        return out

    def gradients(self, x: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy over all positions; ``label`` is an index per lane."""
        steps, lanes = x.shape
        kept = [list(self._steps(side, x, keep=True)) for side in (0, 1)]
        aligned = (kept[0], kept[1][::-1])
        hidden = [np.stack([k[0] for k in side]) for side in aligned]
        logits = sum(np.matmul(self.outputs[s], hidden[s]) for s in (0, 1)) + self.bias
        logits -= logits.max(1, keepdims=True)
        error = np.exp(logits)
        error /= error.sum(1, keepdims=True)
        error[:, label, np.arange(lanes)] -= 1
        error /= steps * lanes
        grads = [np.zeros_like(getattr(self, n)) for n in self.NAMES]
        grads[3] += error.sum((0, 2))[:, None]
        n = self.hidden
        for side in (0, 1):
            grads[2][side] = np.einsum("tcl,thl->ch", error, hidden[side])
            back = np.matmul(self.outputs[side].T, error)
            order = range(steps - 1, -1, -1) if side == 0 else range(steps)
            later = np.zeros((n, lanes), np.float32)
            to_inputs = np.empty((steps, 3 * n, lanes), np.float32)
            for t in order:
                _, before, both, new, by_state = aligned[side][t]
                d = back[t] + later
                reset, keep = both[:n], both[n:]
                d_new = d * (1 - keep) * (1 - new**2)
                open_gate = (both > 0) & (both < 1)
                g = to_inputs[t]
                g[:n] = d_new * by_state * open_gate[:n]
                g[n : 2 * n] = d * (before - new) * open_gate[n:]
                g[2 * n :] = d_new
                by = g.copy()
                by[2 * n :] *= reset
                grads[1][side] += by @ before.T
                later = d * keep + self.states[side].T @ by
            flat, codes = to_inputs.transpose(0, 2, 1).reshape(-1, 3 * n), x.ravel()
            for j in range(3 * n):
                grads[0][side][:, j] = np.bincount(codes, weights=flat[:, j], minlength=256)
        return grads

    def train(self, x: np.ndarray, label: np.ndarray, plan: Training) -> None:
        """Adam on batches drawn with a fixed seed; ``x`` has a window per row."""
        rng = np.random.default_rng(plan.seed)
        first = [np.zeros_like(getattr(self, n)) for n in self.NAMES]
        second = [np.zeros_like(getattr(self, n)) for n in self.NAMES]
        for step in range(1, plan.steps + 1):
            rows = rng.integers(0, len(x), plan.batch)
            rate = plan.rate * (1 - (step - 1) / plan.steps)
            for i, g in enumerate(self.gradients(np.ascontiguousarray(x[rows].T), label[rows])):
                first[i] += 0.1 * (g - first[i])
                second[i] += 0.01 * (g * g - second[i])
                mean, power = first[i] / (1 - 0.9**step), second[i] / (1 - 0.99**step)
                getattr(self, self.NAMES[i])[...] -= rate * mean / (np.sqrt(power) + 1e-8)

    def documents(self, texts: list[bytes], lanes: int = 2048) -> np.ndarray:
        """Mean probabilities over all bytes of each text, which must not be empty.

        A text shorter than a window is repeated to fill one; the last window of a longer one
        overlaps the one before. Every byte counts once."""
        w = self.window
        sums = np.zeros((len(texts), len(self.labels)))
        sizes = np.array([len(t) for t in texts], np.int64)
        flat = np.frombuffer(b"".join(t if len(t) >= w else (t * w)[:w] for t in texts), np.uint8)
        begin = np.cumsum(np.maximum(sizes, w)) - np.maximum(sizes, w)
        windows = np.maximum(1, -(-sizes // w))
        of = np.repeat(np.arange(len(texts)), windows)
        place = (np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)) * w
        start = np.minimum(place, np.maximum(sizes[of] - w, 0))
        skip = place - start
        stop = np.minimum(w, sizes[of])
        for at in range(0, len(of), lanes):
            part = slice(at, at + lanes)
            x = flat[begin[of[part]] + start[part] + np.arange(w)[:, None]]
            p = self.probabilities(x)
            odd = np.nonzero((skip[part] > 0) | (stop[part] < w))[0]
            t = np.arange(w)[:, None]
            counts = (t >= skip[part][odd]) & (t < stop[part][odd])
            p[:, :, odd] *= counts[:, None, :]
            np.add.at(sums, of[part], p.sum(0).T)
        return sums / sizes[:, None]


def remainder(key: Column, folds: int = 5) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key is the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def sample(labelled: DataFrame, plan: Training, key: str, text: str, label: str):
    """(windows, label indexes, labels) for training: bounded by labels and ``plan``, not by rows."""
    rows = labelled.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").alias("label")
    ).filter(F.col("label").isNotNull() & (F.length("text") > 0))
    # The draw goes by the text as well, so rows without a key, or with one key, are drawn like others.
    text_hash = F.xxhash64("text")
    drawn = draw(F.concat_ws("|", F.col("key").cast("string"), text_hash.cast("string")), f"sample-{plan.seed}")
    n = F.greatest(F.length("text") - plan.window, F.lit(1))
    cuts = F.transform(
        F.sequence(F.lit(1), F.lit(plan.windows_per_doc)),
        lambda i: F.substring(F.col("text"), F.pmod(F.xxhash64("key", i), n).cast("int") + 1, F.lit(plan.window)),
    )
    drawn_rows = rows.select("label", drawn.alias("drawn"), text_hash.alias("hash"), cuts.alias("cuts"))
    totals = drawn_rows.groupBy("label").agg(F.count("*").alias("n"), F.min("drawn").alias("least")).collect()
    if not totals:
        return np.zeros((0, plan.window), np.uint8), np.zeros(0, np.int64), []
    # Twice the share that is wanted, and the least draw at any rate, so no label is without a row;
    # copies of a row, which share their draw, are one. What is left to rank is a bounded sample.
    share = {r["label"]: min(1.0, 2 * plan.docs_per_label / r["n"]) for r in totals}
    most = [(F.lit(r["label"]), F.lit(max(r["least"], int(share[r["label"]] * 2**52))).cast("long")) for r in totals]
    limit = F.element_at(F.create_map(*[c for pair in most for c in pair]), F.col("label"))
    few = drawn_rows.filter(F.col("drawn") <= limit).dropDuplicates(["label", "drawn", "hash"])
    ranked = Window.partitionBy("label").orderBy("drawn", "hash")
    placed = few.withColumn("rank", F.row_number().over(ranked))
    found = placed.filter(F.col("rank") <= plan.docs_per_label).select("label", "rank", "cuts").collect()
    found.sort(key=lambda r: (r["label"], r["rank"]))
    labels = sorted({r["label"] for r in found})
    texts = [(c.encode(), labels.index(r["label"])) for r in found for c in r["cuts"] if c]
    x = np.stack([np.resize(np.frombuffer(t, np.uint8), plan.window) for t, _ in texts])
    return x, np.array([y for _, y in texts]), labels


def fit(labelled: DataFrame, plan: Training = Training(), key="doc_id", text="text", label="lang") -> Network:
    """A network for the labels of ``labelled``; rows without label or text are passed over."""
    x, y, labels = sample(labelled, plan, key, text, label)
    network = Network(labels, plan.hidden, plan.window, plan.seed)
    if len(labels) > 1:
        network.train(x, y, plan)
    return network


def predict(docs: DataFrame, network: Network, text: str = "text", lang="lang_pred", score="score") -> DataFrame:
    """``docs`` with the predicted label and its mean probability over all bytes of the text.

    ``und`` with score 0: null text, text without a letter, and any text if no label was learned.
    Equal texts get equal predictions. Ties go to the first label. Rows are neither dropped nor
    merged; columns named like the two new ones are replaced; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (lang, score)])
    schema = kept.select("*", F.lit("").alias(lang), F.lit(0.0).alias(score)).schema
    names = kept.columns

    def batches(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for table in tables:
            for at in range(0, table.num_rows, 1024):
                part = table.slice(at, 1024)
                texts = part.column(text).to_pylist()
                readable = [i for i, t in enumerate(texts) if net.labels and t and LETTER.search(t)]
                names_out = [UNKNOWN] * len(texts)
                scores = np.zeros(len(texts))
                if readable:
                    means = net.documents([texts[i].encode() for i in readable])
                    scores[readable] = np.clip(means.max(1), 0, 1)
                    for i, j in zip(readable, means.argmax(1)):
                        names_out[i] = net.labels[j]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names_out), pa.array(scores)], names=[*names, lang, score]
                )

    return kept.mapInArrow(batches, schema)
