"""Quality classifier: a generalised additive model with pairwise interactions, boosted cyclically."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: Features of a text, in the order of the model's columns.
FEATURES = (
    "log_words", "word_length", "long_words", "upper", "digits", "symbols", "marks", "spaces", "distinct_words",
    "top_word", "repeated_pairs", "line_words", "distinct_lines", "short_words", "entropy", "vowels",
)

_SYMBOLS = re.compile(rb"[#*$%&|<>=_~^\\{}\[\]@]")
_MARKS = re.compile(rb"[!?]")


def text_features(text: str) -> list[float]:
    """Shape of a text: lengths, shares of character kinds, and how much of it repeats. Nothing but the text counts."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    if not n:
        return [0.0] * len(FEATURES)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    pairs = set(zip(words, words[1:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    chars = sum(map(len, words))
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    p = hist[hist > 0] / size
    top = max(counts.values())
    return [
        float(np.log1p(n)),
        chars / n,
        sum(len(w) > 12 for w in words) / n,
        float(hist[65:91].sum()) / size,
        float(hist[48:58].sum()) / size,
        len(_SYMBOLS.findall(raw)) / n,
        len(_MARKS.findall(raw)) / n,
        (size - chars) / size,
        len(counts) / n,
        top / n,
        1 - (len(pairs) / (n - 1) if n > 1 else 1.0),
        float(np.log1p(n / max(1, len(lines)))),
        len(set(lines)) / max(1, len(lines)),
        sum(len(w) <= 3 for w in words) / n,
        float(-(p * np.log2(p)).sum()),
        float(hist[[97, 101, 105, 111, 117]].sum()) / size,
    ]


@dataclass
class Gam:
    """Lookup tables: one over the bins of each feature, one over the bins of each chosen pair."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            z += table[np.searchsorted(self.edges[j], x[:, j], "right")]
        if self.pairs:
            bins = {j: np.searchsorted(self.pair_edges[j], x[:, j], "right") for j in {k for p in self.pairs for k in p}}
            for (a, b), table in zip(self.pairs, self.pair_tables):
                z += table[bins[a], bins[b]]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]


def _shallow_tree(grad: np.ndarray, hess: np.ndarray, leaves: int, least: float, smooth: float) -> np.ndarray:
    """Newton step of a tree with at most `leaves` leaves over the ordered bins, as a value for each bin."""
    cg, ch = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    gain = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + smooth)
    parts = [(0, len(grad))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for a, b in parts:
            mid = np.arange(a + 1, b)
            mid = mid[(ch[mid] - ch[a] >= least) & (ch[b] - ch[mid] >= least)]
            if len(mid):
                g = gain(a, mid) + gain(mid, b) - gain(a, b)
                k = int(np.argmax(g))
                if g[k] > best[0]:
                    best = (g[k], (a, b), int(mid[k]))
        if best[1] is None:
            break
        a, b = best[1]
        parts.remove((a, b))
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + smooth)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray, least: float, smooth: float) -> np.ndarray:
    """Newton step of a tree of depth two over a table of cells: one cut of the rows or columns and, on either side of
    it, one cut of the others."""

    def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g**2 / (h + smooth)

    best, out = 1e-9, np.zeros_like(grad)
    for turned in (False, True):
        g, h = (grad.T, hess.T) if turned else (grad, hess)
        cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
        for cut in range(1, len(g)):
            total, parts = -gain(cg[-1, -1], ch[-1, -1]), []
            for lo, hi in ((0, cut), (cut, len(g))):
                sg, sh = cg[hi] - cg[lo], ch[hi] - ch[lo]
                split = gain(sg[1:-1], sh[1:-1]) + gain(sg[-1] - sg[1:-1], sh[-1] - sh[1:-1])
                split[(sh[1:-1] < least) | (sh[-1] - sh[1:-1] < least)] = -1
                at = int(split.argmax()) + 1 if len(split) and split.max() > gain(sg[-1], sh[-1]) else len(sg) - 1
                total += gain(sg[at], sh[at]) + gain(sg[-1] - sg[at], sh[-1] - sh[at])
                parts.append((lo, hi, at, sg[at] / (sh[at] + smooth), (sg[-1] - sg[at]) / (sh[-1] - sh[at] + smooth)))
            if total > best:
                best, step = total, np.zeros_like(g)
                for lo, hi, at, a, b in parts:
                    step[lo:hi, :at], step[lo:hi, at:] = a, b
                out = step.T if turned else step
    return out


def fit_gam(
    x: np.ndarray, y: np.ndarray, bins: int = 64, pair_bins: int = 8, pairs: int = 8, rounds: int = 150, rate: float = 0.1, leaves: int = 3
) -> Gam:
    """Boost shallow trees over one feature at a time, round after round, so that no feature takes what others explain;
    then do the same, with trees that cut both, over the pairs of features whose coarse tables explain most of what is left."""
    n, k = x.shape
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    edges = _bin_edges(x, bins)
    at = [np.searchsorted(edges[j], x[:, j], "right") for j in range(k)]
    model = Gam(float(np.log(p / (1 - p))), edges, [np.zeros(len(e) + 1) for e in edges])
    z = np.full(n, model.base)
    for _ in range(rounds):
        for j in range(k):
            q = 1 / (1 + np.exp(-z))
            size = len(edges[j]) + 1
            grad, hess = np.bincount(at[j], y - q, size), np.bincount(at[j], q * (1 - q), size)
            step = rate * np.clip(_shallow_tree(grad, hess, leaves, 1.0, 1.0), -4, 4)
            model.tables[j] += step
            z += step[at[j]]
    model.pair_edges = _bin_edges(x, pair_bins)
    coarse = [np.searchsorted(model.pair_edges[j], x[:, j], "right") for j in range(k)]
    size = [len(e) + 1 for e in model.pair_edges]
    q = 1 / (1 + np.exp(-z))
    strength = []
    for a in range(k):
        for b in range(a + 1, k):
            cell = coarse[a] * size[b] + coarse[b]
            g, h = np.bincount(cell, y - q, size[a] * size[b]), np.bincount(cell, q * (1 - q), size[a] * size[b])
            strength.append((float((g**2 / (h + 5)).sum()), a, b))
    model.pairs = [(a, b) for _, a, b in sorted(strength, reverse=True)[:pairs]]
    model.pair_tables = [np.zeros((size[a], size[b])) for a, b in model.pairs]
    for _ in range(rounds // 3):
        for i, (a, b) in enumerate(model.pairs):
            q = 1 / (1 + np.exp(-z))
            cell = coarse[a] * size[b] + coarse[b]
            g, h = np.bincount(cell, y - q, size[a] * size[b]), np.bincount(cell, q * (1 - q), size[a] * size[b])
            shape = (size[a], size[b])
            step = rate * np.clip(_pair_tree(g.reshape(shape), h.reshape(shape), 1.0, 1.0), -4, 4)
            model.pair_tables[i] += step
            z += step.ravel()[cell]
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 2 modulo 4."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _matrix(texts: pd.Series) -> np.ndarray:
    return np.array([text_features(t or "") for t in texts], float).reshape(len(texts), len(FEATURES))


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_labelled: int = 20_000
) -> Gam:
    """Learn from at most `most_labelled` labelled rows that are not held out, those with the least hash of their id.

    The ids are chosen from the labels alone and sent to the texts (their number is bounded); only features come back,
    of at most `most_labelled` rows again, however many rows repeat an id.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1) and id is not null")
    known = known.where(~held_out("id")).withColumn("h", F.xxhash64("id")).orderBy("h", "id", "y").limit(most_labelled).select("id", "y")
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(F.broadcast(known), "id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "y": b["y"], "x": list(_matrix(b["text"]))})

    schema = f"id {texts.schema['id'].dataType.simpleString()}, y int, x array<double>"
    sample = texts.mapInPandas(run, schema).orderBy(F.xxhash64("id"), "id", "y", "x").limit(most_labelled).toPandas()
    if not len(sample):
        return Gam(0.0, [], [])
    # the same rows in the same order, however Spark dealt them out
    sample = sample.assign(key=[tuple(v) for v in sample["x"]]).sort_values(["id", "y", "key"])
    x, y = np.array(sample["x"].tolist(), float), sample["y"].to_numpy(float)
    return fit_gam(x, y) if 0 < y.mean() < 1 else Gam(float(np.log(999)) * (1 if y.mean() else -1), [], [])


def score_column(model: Gam, text: Column) -> Column:
    """The model's score of a text, a batch at a time."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(texts)))

    return score(text)


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = 0.7,
    most_labelled: int = 20_000,
) -> DataFrame:
    """One row per document: `id_col`, held_out, score (0 to 1, higher: label 1 likelier), predicted.

    The model is fitted by fit_quality() to features of texts alone. It is a sum of lookup tables, so scoring is a
    binning and an addition for each feature and pair, in one pass over whole texts without a shuffle.

    Null or empty texts have all features zero and are scored like any text. Rows without a label only get a score;
    null labels teach nothing; an id labelled twice counts each time. With labels of one kind, every score is the share
    of label 1, clipped; without labels it is 0.5. Rows that repeat an id stay apart. An empty table gives none.
    """
    model = fit_quality(docs, labels, id_col, text_col, label_col, most_labelled)
    scored = docs.select(F.col(id_col).alias("id"), score_column(model, text_or_empty(text_col)).alias("score"))
    return scored.select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def crc_remainder(doc_id: object) -> int:
    """The remainder that held_out() looks at, for tests."""
    return zlib.crc32(str(doc_id).encode()) % 4
