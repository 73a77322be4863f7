"""Quality scores by Bradley-Terry pairwise ranking.

Every labelled good document is preferred to every labelled bad one.  A linear
score is learned from such pairs by the logistic loss on the difference of
their features; then a quantile of the training scores becomes the threshold.
The features are the shares of byte-class transitions (which class of byte
follows which) and a few figures on words and lines, over the whole text.

The model is fitted on at most ``most`` labelled rows (the least by a hash of
the key, then of the text, also where keys repeat on either side); scoring covers
every row.  Null and empty texts have features of zero and get a score like any
other; a text of any length is one row.  Equal texts have equal scores.  Labels
that are null are left out; if one class is missing every score is the share of
good labels, and 1 without any.  No rows give no rows.  Extra columns are ignored
by ``score`` and pass through ``keep_good``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .rows import under_plain_names


def _classes() -> np.ndarray:
    table = np.full(256, 15, np.uint8)
    groups = ["\n\r", " \t\v\f", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",;:", "!?", "\"'()", "#$%&*@", "|/\\", "-_", "<>{}[]=+~^`"]
    for i, group in enumerate(groups):
        table[list(group.encode())] = i
    table[0xC0:] = 13
    table[0x80:0xC0] = 14
    return table


CLASSES = _classes()
WIDTH = 256 + 7


def features(texts: list[str | None]) -> np.ndarray:
    """One row of features for each text."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    for i, text in enumerate(texts):
        if not text:
            continue
        kinds = CLASSES[np.frombuffer(text.encode(), np.uint8)]
        pairs = np.bincount(kinds[:-1] * np.uint8(16) + kinds[1:], minlength=256)
        out[i, :256] = np.sqrt(pairs / max(1, len(kinds) - 1))
        words, lines = text.split(), text.split("\n")
        n, distinct = len(words), len(set(words))
        out[i, 256:] = (
            np.log1p(len(kinds)),
            np.log1p(n),
            np.log1p(distinct),
            distinct / max(1, n),
            len(set(lines)) / len(lines),
            len(text) / max(1, n) / 10,
            np.log1p(len(lines)),
        )
    return out


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs: int = 30_000, ridge: float = 1e-3, steps: int = 12, seed: int = 7) -> np.ndarray:
    """Weights that rank y = 1 over y = 0: Newton steps on the pairwise logistic loss."""
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    d = x[rng.choice(good, pairs)] - x[rng.choice(bad, pairs)]
    w = np.zeros(d.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        slope = d.T @ p / pairs - ridge * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / pairs + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "quality", most: int = 8000, cutoff: float = 0.3) -> dict:
    """A model (plain arrays) from at most ``most`` labelled rows for which ``learn`` holds."""
    chosen = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & learn).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_y"))
    chosen = chosen.orderBy(F.xxhash64("_key"), "_key", "_y").limit(most)
    chosen = cut(chosen, "quality-labels")  # at most ``most`` rows, so it may be broadcast
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_key")
    order = [F.xxhash64("_key"), F.col("_key"), F.col("_y"), F.xxhash64("_text")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float32())), *batch.columns[1:]], ["x", "y", "place"])

    # keys that repeat could give more rows than labels were chosen
    found = texts.select("_text", "_y", F.struct(*order).alias("place"))
    table = found.mapInArrow(rows, f"x array<float>, y int, place {dict(found.dtypes)['place']}").orderBy("place").limit(most).select("x", "y").toArrow()
    y = table["y"].to_numpy()
    if len(np.unique(y)) < 2:
        return {"w": np.zeros(WIDTH), "mean": np.zeros(WIDTH), "std": np.ones(WIDTH), "at": 0.0, "scale": 0.0, "prior": float(y.mean()) if len(y) else 1.0, "cutoff": cutoff}
    x = table["x"].combine_chunks().flatten().to_numpy().reshape(len(y), WIDTH).astype(np.float64)
    order = np.lexsort((*x[:, :8].T, *x[:, 256:].T, y))  # the same whatever order the rows came in
    x, y = x[order], y[order]
    mean, std = x.mean(axis=0), x.std(axis=0)
    std[std < 1e-6] = 1
    w = fit_pairs((x - mean) / std, y)
    s = (x - mean) / std @ w
    # the quantile of the scores that parts the classes best, bad and good counting alike
    levels = np.quantile(s, np.linspace(0, 1, 1001))
    right = [(s[y == 1] >= t).mean() + (s[y == 0] < t).mean() for t in levels]
    best = np.flatnonzero(np.array(right) >= max(right) - 1e-9)
    at = levels[best].mean()
    return {"w": w, "mean": mean, "std": std, "at": float(at), "scale": float(2 / max(1e-9, s.std())), "prior": None, "cutoff": cutoff}


def score(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score of every row: cutoff at the learned quantile, 0 to 1."""
    kind = dict(docs.dtypes)[key]
    base = np.log(model["cutoff"] / (1 - model["cutoff"]))
    cutoff = model["cutoff"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model["prior"] is not None:
                s = np.full(batch.num_rows, model["prior"])
            else:
                raw = (features(batch.column(1).to_pylist()) - model["mean"]) / model["std"] @ model["w"]
                s = 1 / (1 + np.exp(-np.clip(base + model["scale"] * (raw - model["at"]), -40, 40)))
                # rounding must not move a score across the cutoff
                s = np.where(raw >= model["at"], np.maximum(s, cutoff), np.minimum(s, np.nextafter(cutoff, 0)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], [key, "score"])

    return docs.select(key, text).mapInArrow(rows, f"`{key}` {kind}, score double")


def keep_good(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """The rows of docs whose score reaches the cutoff, with their columns."""
    columns = docs.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index(text)
        for batch in batches:
            raw = (features(batch.column(at).to_pylist()) - model["mean"]) / model["std"] @ model["w"]
            kept = raw >= model["at"] if model["prior"] is None else np.full(batch.num_rows, model["prior"] >= model["cutoff"])
            yield batch.filter(pa.array(kept))

    return under_plain_names(docs, [text], [], lambda d: d.mapInArrow(rows, d.schema))
