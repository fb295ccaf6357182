"""Language identification by a bidirectional gated recurrent network over bytes (operator 10).

The network is trained in numpy by backpropagation through time on a bounded sample of
labelled rows.  It reads a text's UTF-8 bytes in windows of fixed length (every byte is in
exactly one), labels every position from the forward and the backward state there, and the
mean of the position probabilities over the whole text is the document's probability.
Windows of many documents run side by side, one matrix product per step.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfeat.llm.common import chunks, use_session, utf8

#: Bytes of a window, units of a direction's state, and windows that run side by side.
WINDOW, HIDDEN, LANES = 64, 8, 4096

#: The bounded training sample: rows, windows of a row; steps of the training, windows of a step.
SAMPLE_ROWS, ROW_WINDOWS, STEPS, BATCH = 3000, 4, 190, 256

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}").search
_ASCII_LETTER = re.compile("[A-Za-z]").search

Params = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, 0.5, out=x)
    np.tanh(x, out=x)
    np.add(x, 1, out=x)
    return np.multiply(x, 0.5, out=x)


def _start(n_labels: int, seed: int = 7) -> Params:
    rng = np.random.default_rng(seed)
    h = HIDDEN
    p = {"bias": np.zeros((n_labels, 1))}
    for d in "fb":
        p[f"{d}_x"] = rng.normal(0, 0.3, (3 * h, 256))  # input weights and biases of every byte: z, r, candidate
        p[f"{d}_u"] = rng.normal(0, 0.35, (3 * h, h))
        p[f"{d}_out"] = rng.normal(0, 0.3, (n_labels, h))
    return {k: v.astype(np.float32) for k, v in p.items()}


def _scan(p: Params, d: str, bytes_: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (steps, units, lanes) of one direction; ``keep`` gets what the way back needs."""
    steps, lanes = bytes_.shape
    h, u = HIDDEN, p[f"{d}_u"]
    states = np.empty((steps, h, lanes), np.float32)
    state = np.zeros((h, lanes), np.float32)
    gates, rec = np.empty((3 * h, lanes), np.float32), np.empty((3 * h, lanes), np.float32)
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        np.take(p[f"{d}_x"], bytes_[t], axis=1, out=gates, mode="clip")
        np.matmul(u, state, out=rec)
        zr = _sigmoid(np.add(gates[: 2 * h], rec[: 2 * h], out=gates[: 2 * h]))
        z, r, cand = zr[:h], zr[h:], gates[2 * h :]
        cand += r * rec[2 * h :]
        np.tanh(cand, out=cand)
        new = states[t]
        np.subtract(state, cand, out=new)
        new *= z
        new += cand
        new *= mask[t]
        if keep is not None:
            keep.append((t, state.copy(), z.copy(), r.copy(), cand.copy(), rec[2 * h :].copy()))
        state = new
    return states


def _probabilities(p: Params, hf: np.ndarray, hb: np.ndarray) -> np.ndarray:
    """Label probabilities (steps, labels, lanes) at every position."""
    x = np.matmul(p["f_out"], hf)
    x += np.matmul(p["b_out"], hb)
    x += p["bias"]
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def _gradients(p: Params, bytes_: np.ndarray, mask: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Params:
    """Gradients of the weighted mean cross-entropy over all positions, through time."""
    kept: dict[str, list] = {"f": [], "b": []}
    states = {d: _scan(p, d, bytes_, mask, kept[d]) for d in "fb"}
    err = _probabilities(p, states["f"], states["b"])
    err[:, label, np.arange(len(label))] -= 1
    err *= (mask * (weight / (mask.sum(0) * weight.sum())))[:, None, :]
    g = {"bias": err.sum(axis=(0, 2))[:, None]}
    for d in "fb":
        g[f"{d}_out"] = np.einsum("tkm,thm->kh", err, states[d], optimize=True)
        g[f"{d}_x"], g[f"{d}_u"] = np.zeros_like(p[f"{d}_x"]), np.zeros_like(p[f"{d}_u"])
        back = np.zeros_like(states[d][0])
        for t, old, z, r, cand, rec_n in reversed(kept[d]):
            back += p[f"{d}_out"].T @ err[t]
            back *= mask[t]
            da_n = back * (1 - z) * (1 - cand * cand)
            da_z = back * (old - cand) * z * (1 - z)
            da_r = da_n * rec_n * r * (1 - r)
            into = np.concatenate([da_z, da_r, da_n])
            np.add.at(g[f"{d}_x"].T, bytes_[t], into.T)
            rec = np.concatenate([da_z, da_r, da_n * r])
            g[f"{d}_u"] += rec @ old.T
            back = back * z + p[f"{d}_u"].T @ rec
    return g


@dataclass
class LanguageModel:
    labels: list[str]
    params: Params

    def position_probabilities(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(probabilities (steps, labels, lanes), mask (steps, lanes), row of each lane), window by window."""
        sizes = np.diff(offsets)
        n_windows = -(-sizes // WINDOW)
        row = np.repeat(np.arange(len(sizes)), n_windows)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        start = offsets[row] + nth * WINDOW
        length = np.minimum(offsets[row + 1] - start, WINDOW)
        step = np.arange(WINDOW)[:, None]
        for i in range(0, len(row), LANES):
            s, n = start[i : i + LANES], length[i : i + LANES]
            mask = (step < n).astype(np.float32)
            bytes_ = data[np.minimum(s + step, len(data) - 1)]
            hf, hb = _scan(self.params, "f", bytes_, mask), _scan(self.params, "b", bytes_, mask)
            yield _probabilities(self.params, hf, hb), mask, row[i : i + LANES]

    def label_positions(self, text: str) -> list[str]:
        """The label of every byte of a text."""
        data = np.frombuffer(text.encode(), np.uint8)
        out: list[str] = []
        for p, mask, _ in self.position_probabilities(data, np.array([0, len(data)])):
            best = p.argmax(axis=1).T[mask.T > 0]
            out += [self.labels[i] for i in best]
        return out

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean position probabilities (rows, labels); rows without a byte are all 0."""
        total = np.zeros((len(offsets) - 1, len(self.labels)))
        for p, mask, row in self.position_probabilities(data, offsets):
            p *= mask[:, None, :]
            sums = p.sum(axis=0, dtype=np.float32)
            for k in range(len(self.labels)):
                total[:, k] += np.bincount(row, sums[k], len(total))
        return total / np.maximum(np.diff(offsets), 1)[:, None]


def train(windows: list[bytes], labels: list[str], seed: int = 7) -> LanguageModel:
    """Fit by Adam, always STEPS steps, on windows of at most WINDOW bytes; every language weighs the same."""
    names = sorted(set(labels))
    y = np.array([names.index(x) for x in labels])
    size = np.array([len(w) for w in windows])
    data = np.frombuffer(b"".join(w.ljust(WINDOW, b"\0") for w in windows), np.uint8).reshape(-1, WINDOW).T
    mask = (np.arange(WINDOW)[:, None] < size).astype(np.float32)
    weight = (1 / np.bincount(y, minlength=len(names)))[y].astype(np.float32)
    p = _start(len(names), seed)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    rng, step = np.random.default_rng(seed), 0
    while step < STEPS:
        order = rng.permutation(len(windows))
        for i in range(0, len(order), BATCH):
            own, step = order[i : i + BATCH], step + 1
            if step > STEPS:
                break
            g = _gradients(p, data[:, own], mask[:, own], y[own], weight[own])
            for k, x in g.items():
                m[k] += 0.1 * (x - m[k])
                v[k] += 0.01 * (x * x - v[k])
                p[k] -= (0.02 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return LanguageModel(names, {k: np.ascontiguousarray(x, np.float32) for k, x in p.items()})


def sample_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", rows: int = SAMPLE_ROWS) -> tuple[list[bytes], list[str]]:
    """Windows, evenly spread over the text, of at most ``rows`` labelled rows outside the held-out quarter.

    Every label has the same share of them, so a rare language is not lost (of more labels
    than ``rows`` each has one).  A label's rows with the smallest hash are taken: the same
    ones for the same table.  A bound on the hash per label leaves little more than its share
    before rows are ordered.
    """
    size = F.length("t")
    part = F.transform(
        F.sequence(F.lit(0), F.lit(ROW_WINDOWS - 1)),
        lambda i: F.substring(F.col("t"), (i * F.greatest(size - WINDOW, F.lit(0)) / max(1, ROW_WINDOWS - 1) + 1).cast("int"), F.lit(WINDOW)),
    )
    labelled = docs.select(F.col(id_col).cast("string").alias("d"), F.col(text_col).alias("t"), F.col(label_col).alias("y"))
    labelled = labelled.where("t is not null and y is not null and pmod(crc32(d), 4) <> 2")
    labelled = labelled.where(r"t rlike '\\p{L}'").select("y", F.array_distinct(part).alias("w"), F.xxhash64("d", "t", "y").alias("k"))
    counts = {r.y: r["count"] for r in labelled.groupBy("y").count().collect()}  # a row per language
    if not counts:
        return [], []
    each = max(1, rows // len(counts))
    h = F.xxhash64("k")
    bounds = [x for y, n in counts.items() for x in (F.lit(y), F.lit(min(2**63 - 1, int(min(1.0, (each + 8 * each**0.5 + 8) / n) * 2**64) - 2**63)))]
    few = labelled.where(h <= F.element_at(F.create_map(*bounds), F.col("y"))).withColumn("h", h)
    nth = F.row_number().over(Window.partitionBy("y").orderBy("h", "k"))
    picked = sorted(few.withColumn("nth", nth).where(F.col("nth") <= each).select("h", "y", "w").collect(), key=lambda r: (r.h, r.y))
    return [w.encode()[:WINDOW] for r in picked for w in r.w if w], [r.y for r in picked for w in r.w if w]


def _predicted(model: LanguageModel, texts: pa.Array) -> tuple[list[str], list[float]]:
    """(label, score) of each text."""
    data, offsets = utf8(texts)
    best, score = [], []
    for i, j in chunks(offsets, WINDOW * LANES):
        own = data[offsets[i] : offsets[j]]
        p = model.pooled(own, offsets[i : j + 1] - offsets[i]) if model.labels else np.zeros((j - i, 1))
        top = p.argmax(axis=1)
        for k in range(i, j):
            text = own[offsets[k] - offsets[i] : offsets[k + 1] - offsets[i]].tobytes()
            known = bool(model.labels) and (_ASCII_LETTER(text[:64].decode("latin-1")) or _LETTER(text.decode()))
            best.append(model.labels[top[k - i]] if known else UNKNOWN)
            score.append(min(1.0, float(p[k - i, top[k - i]])) if known else 0.0)
    return best, score


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; one pass, no shuffle.

    held_out tells whether crc32 of the id as text leaves 2 modulo 4 (false for a null id).
    A text that is null or has no letter is ``und`` with score 0, and so is every text if the
    model has no label.  Repeated rows each give a row; ties go to the label that sorts first.
    """
    doc_id = F.col(id_col).cast("long")
    held_out = F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))
    source = docs.select(doc_id.alias("doc_id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    return annotate(source, model, "text").drop("text")


def annotate(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` plus lang_pred and score, which replace columns of these names; one pass, no shuffle."""
    extra = ["lang_pred", "score"]
    names = [n for n in docs.columns if n not in extra]
    plain = docs.select(*(docs[n] for n in names)).toDF(*(f"c{i}" for i in range(len(names))))
    text = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            best, score = _predicted(model, b.column(text))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(best, pa.string()), pa.array(score, pa.float64())], names=[*b.schema.names, *extra])

    schema = T.StructType([*plain.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(run, schema).toDF(*names, *extra)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> LanguageModel:
    """A model of the labelled rows of ``docs``; without any it has no label."""
    use_session(docs.sparkSession)
    windows, labels = sample_windows(docs, id_col, text_col, label_col)
    return train(windows, labels) if windows else LanguageModel([], {})


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """Train on the labelled rows of ``docs`` and predict every row's language."""
    return predict(docs, fit(docs, id_col, text_col, label_col), id_col, text_col)
