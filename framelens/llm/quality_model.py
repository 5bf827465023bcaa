"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into quantile bins. Boosting goes round the features: in turn each gets a shallow tree
over its bins, fitted to what the others leave, and the trees of a feature add up to a lookup table. Then the pairs
whose joint bins explain most of the remainder get two-dimensional tables in the same way. A score is the logistic of
the intercept and one table entry for each feature and pair: a few vectorised additions.

The model is fitted on a bounded sample of labelled rows; every row is scored, from its whole text and nothing else.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, in_slices, sample_cut


FEATURES = ("log_words", "mean_word", "long_words", "symbol_rate", "pipe_words", "shout_words", "bang_rate", "digit_rate", "punct_rate", "distinct_rate", "top_word_rate", "repeat_pairs", "line_words", "dup_lines", "upper_rate", "capital_words", "non_ascii", "deflated")
_SYMBOL = re.compile(rb"[#*$%&|<>]")
_PUNCT = re.compile(rb"[.,;:?]")
_UPPER, _DIGIT, _HIGH = re.compile(rb"[A-Z]"), re.compile(rb"[0-9]"), re.compile(rb"[\x80-\xff]")
DEFLATE_STEP = 1 << 20


def features(text: str) -> list[float]:
    """The features of a whole text; zeros for one without words."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    n, size = len(words), max(1, len(data))
    if not n:
        return [0.0] * len(FEATURES)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in data.split(b"\n") if x.strip()]
    squeeze = zlib.compressobj(1)
    packed = sum(len(squeeze.compress(data[i : i + DEFLATE_STEP])) for i in range(0, len(data), DEFLATE_STEP)) + len(squeeze.flush())
    pairs = len(set(zip(words, words[1:])))
    shout = sum(w.isupper() for w in words)
    return [
        float(np.log1p(n)), size / n, sum(len(w) > 12 for w in words) / n, len(_SYMBOL.findall(data)) / size, seen.get(b"|", 0) / n, shout / n,
        data.count(b"!") / size, len(_DIGIT.findall(data)) / size, len(_PUNCT.findall(data)) / size, len(seen) / n, max(seen.values()) / n,
        1 - pairs / max(1, n - 1) if n > 1 else 0.0, n / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        len(_UPPER.findall(data)) / size, sum(w[:1].isupper() for w in words) / n, len(_HIGH.findall(data)) / size, packed / size,
    ]


def _leaves(gradient: np.ndarray, weight: np.ndarray, depth: int, smooth: float) -> np.ndarray:
    """The values of a tree over ordered bins that splits ``depth`` times, each time where the gain is largest."""
    g, w = np.r_[0.0, np.cumsum(gradient)], np.r_[0.0, np.cumsum(weight)]
    out = np.zeros(len(gradient))

    def grow(a: int, b: int, left: int) -> None:
        total_g, total_w = g[b] - g[a], w[b] - w[a]
        cut = np.arange(a + 1, b)
        if left and len(cut):
            lg, lw = g[cut] - g[a], w[cut] - w[a]
            rg, rw = total_g - lg, total_w - lw
            gain = lg**2 / (lw + smooth) + rg**2 / (rw + smooth) - total_g**2 / (total_w + smooth)
            best = int(gain.argmax())
            if gain[best] > 1e-9:
                grow(a, int(cut[best]), left - 1)
                grow(int(cut[best]), b, left - 1)
                return
        out[a:b] = total_g / (total_w + smooth)

    grow(0, len(gradient), depth)
    return out


@dataclass
class GamModel:
    """Tables of an additive model with pairs."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def decision(self, x: np.ndarray) -> np.ndarray:
        """The sum of the intercept and a table entry for each feature and pair."""
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        bins = {j: np.searchsorted(self.coarse[j], x[:, j], side="right") for pair in self.pairs for j in pair}
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[bins[a], bins[b]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.decision(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, pair_bins: int = 8, rounds: int = 120, pair_rounds: int = 30, n_pairs: int = 8, depth: int = 2, rate: float = 0.2, smooth: float = 2.0) -> GamModel:
    """Fits by Newton steps on the logistic loss. Labels all of one kind, or none, give a constant."""

    def cuts(v: np.ndarray, k: int) -> np.ndarray:
        return np.unique(np.quantile(v, np.linspace(0, 1, k + 1)[1:-1])) if len(v) else np.zeros(0)

    d = x.shape[1]
    edges, coarse = [cuts(x[:, j], bins) for j in range(d)], [cuts(x[:, j], pair_bins) for j in range(d)]
    p = (y.sum() + 1) / (len(y) + 2)
    model = GamModel(edges, coarse, float(np.log(p / (1 - p))), [np.zeros(len(e) + 1) for e in edges])
    if len(np.unique(y)) < 2:
        return model
    index = [np.searchsorted(edges[j], x[:, j], side="right") for j in range(d)]
    total = np.full(len(y), model.intercept)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-total))
        return y - q, np.maximum(q * (1 - q), 1e-6)

    for _ in range(rounds):
        for j in range(d):
            g, w = slope()
            step = rate * _leaves(np.bincount(index[j], g, len(model.tables[j])), np.bincount(index[j], w, len(model.tables[j])), depth, smooth)
            model.tables[j] += step
            total += step[index[j]]
    low = [np.searchsorted(coarse[j], x[:, j], side="right") for j in range(d)]
    wide = [len(c) + 1 for c in coarse]
    g, w = slope()

    def cells(a: int, b: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(low[a] * wide[b] + low[b], v, wide[a] * wide[b]).reshape(wide[a], wide[b])

    gains = {(a, b): float((cells(a, b, g) ** 2 / (cells(a, b, w) + smooth)).sum()) for a, b in combinations(range(d), 2)}
    model.pairs = sorted(gains, key=gains.get, reverse=True)[:n_pairs]
    model.pair_tables = [np.zeros((wide[a], wide[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for table, (a, b) in zip(model.pair_tables, model.pairs):
            g, w = slope()
            gs, ws = cells(a, b, g), cells(a, b, w)
            # A shallow tree: the best cut of one feature, and in each half the best tree over the other's bins.
            step = _two_way(gs, ws, depth, smooth) * rate
            table += step
            total += step[low[a], low[b]]
    return model


def _two_way(g: np.ndarray, w: np.ndarray, depth: int, smooth: float) -> np.ndarray:
    rows_g, rows_w = np.cumsum(g.sum(axis=1)), np.cumsum(w.sum(axis=1))
    if len(rows_g) < 2:
        return np.tile(_leaves(g.sum(axis=0), w.sum(axis=0), depth, smooth), (len(rows_g), 1))
    gain = [sum(float((part_g.sum(axis=0) ** 2 / (part_w.sum(axis=0) + smooth)).sum()) for part_g, part_w in ((g[:c], w[:c]), (g[c:], w[c:]))) for c in range(1, len(rows_g))]
    cut, out = int(np.argmax(gain)) + 1, np.zeros_like(g)
    for part in (slice(0, cut), slice(cut, None)):
        out[part] = _leaves(g[part].sum(axis=0), w[part].sum(axis=0), depth, smooth)
    return out


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def text_features(docs: DataFrame, text_col: str, carry: list[str]) -> DataFrame:
    source = docs.select(*carry, F.col(text_col).cast("string").alias(free_name(docs, "_text")))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = [features(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.float64()))], names=[*carry, "features"])

    return source.mapInArrow(compute, T.StructType([source.schema[c] for c in carry] + [T.StructField("features", T.ArrayType(T.DoubleType()))]))


def fit_quality_model(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = 12_000, id_col: str = "doc_id", text_col: str = "text") -> GamModel:
    """Fits on at most ``max_rows`` labelled rows that are not held out, the first by a hash of id and label.

    Rows without an id or a label of 0 or 1 are no labels; an id with both labels counts once for each. Where rows of
    ``docs`` repeat an id, one of them is learnt: the one whose text has the smallest hash. Without labels, or with
    none that has a text, the model is constant. Columns but those named are never read.
    """
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    keyed = usable.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_y")).withColumn("_h", F.xxhash64("_id", "_y"))
    cut = sample_cut(keyed, "_h", max_rows)
    # Bounded by max_rows: two numbers a row. Distinct (id, label) have distinct hashes, but for one in 2**64.
    sample = keyed.where(F.lit(cut is not None) & (F.col("_h") <= F.lit(cut or 0))).dropDuplicates(["_h"]).select("_id", "_y")
    texts = docs.select(F.col(id_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))
    labelled = texts.join(F.broadcast(sample), F.col("_key") == F.col("_id")).select("_id", "_y", "_text")
    found = text_features(labelled.withColumn("_text_hash", F.xxhash64("_text")), "_text", ["_id", "_y", "_text_hash"])
    first = found.groupBy("_id", "_y").agg(F.min(F.struct("_text_hash", "features")).alias("f"))
    rows = first.select("_id", "_y", "f.features").orderBy("_id", "_y").collect()  # at most max_rows
    x = np.array([r["features"] for r in rows], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["_y"] for r in rows], float))


def score_quality(docs: DataFrame, model: GamModel, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) to each row.

    A null or empty text is scored like any other, from zero features. Repeated rows score alike; carried columns
    called like a result are left out.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c not in ("score", "predicted")]
    source = docs.select(*names, F.col(text_col).cast("string").alias(free_name(docs, "_text")))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: a few tables of at most 32 or 64 numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            x = np.array([features(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()], float).reshape(-1, len(FEATURES))
            scores = shared.value.score(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32), pa.int32())], names=[*names, "score", "predicted"])

    fields = [source.schema[c] for c in names] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return source.mapInArrow(score, T.StructType(fields))
