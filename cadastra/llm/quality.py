"""Quality scores by histogram gradient-boosted trees over statistics of whole texts.

Statistics are array operations over a chunk of texts.  Trees are grown in numpy
on a bounded sample of labelled rows: values are cut into quantile bins, a node's
best split is read off running sums of its gradient histograms, and all trees
have one depth, so that a forest is three flat arrays that a batch of rows walks
through level by level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .language import remainder
from .ngram_join import chunks
from .text_arrays import word_hashes

#: Labelled rows a forest is fitted on, drawn by a hash of the id.
SAMPLE_ROWS = 8000
TREES = 120
DEPTH = 4
BINS = 64
RATE = 0.1
LEAST_ROWS = 15
RIDGE = 1.0
CUT = 0.7

STATISTICS = [
    "chars", "words", "lines", "letters", "digits", "capitals", "spaces", "symbols", "other", "commas", "stops",
    "bars", "marks", "word_chars", "long_words", "short_words", "distinct_words", "top_word", "repeated_next",
    "distinct_pairs", "distinct_fours", "line_words", "distinct_lines", "word_entropy", "byte_entropy", "distinct_bytes",
]

_CLASSES = {
    "letters": b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(range(128, 256)),
    "digits": b"0123456789", "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "spaces": b" \t\n\r\x0b\x0c",
    "symbols": b"#$%&*+=@^~_\\<>{}[]", "other": bytes(range(128, 256)), "commas": b",", "stops": b".!?", "bars": b"|",
    "marks": b"!\"'();:-/",
}


def _entropy(counts: np.ndarray) -> float:
    p = counts / counts.sum()
    return float(-(p * np.log2(p)).sum())


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of ``STATISTICS`` a text; a null text counts as an empty one, whose statistics are 0."""
    out = np.zeros((len(texts), len(STATISTICS)))
    words, bounds = word_hashes(texts)
    pairs = words[:-1] * np.uint64(31) + words[1:] if len(words) > 1 else words[:0]
    fours = pairs[:-2] * np.uint64(961) + pairs[2:] if len(pairs) > 2 else pairs[:0]
    classes = [np.frombuffer(b, dtype=np.uint8) for b in _CLASSES.values()]
    for row, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        n = len(raw)
        if not n:
            continue
        by_byte = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
        shares = [by_byte[c].sum() / n for c in classes]
        begin, end = bounds[row], bounds[row + 1]
        own = words[begin:end]
        lines = [x for x in text.split("\n") if x.strip()]
        count = max(1, len(own))
        spread = np.unique(own, return_counts=True)[1] if len(own) else np.ones(1, np.int64)
        lengths = np.array([len(w) for w in text.split()] or [0])
        out[row] = [
            np.log1p(n), np.log1p(len(own)), np.log1p(len(lines)), *shares,
            lengths.mean(), (lengths > 12).mean(), (lengths < 4).mean(), len(spread) / count, spread.max() / count,
            float((own[1:] == own[:-1]).mean()) if len(own) > 1 else 0.0,
            len(np.unique(pairs[begin : end - 1])) / max(1, count - 1) if len(own) > 1 else 1.0,
            len(np.unique(fours[begin : end - 3])) / max(1, count - 3) if len(own) > 3 else 1.0,
            len(own) / max(1, len(lines)), len(set(lines)) / max(1, len(lines)),
            _entropy(spread) / max(1.0, np.log2(count)) if len(own) else 0.0,
            _entropy(by_byte[by_byte > 0]), int((by_byte > 0).sum()),
        ]
    return out


@dataclass
class Forest:
    """Complete trees as arrays: statistic and threshold by tree and inner node, value by tree and leaf."""

    statistic: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1; all rows walk through all trees one level at a time."""
        trees = np.arange(self.value.shape[0])[None, :]
        node = np.zeros((len(rows), self.value.shape[0]), dtype=np.int64)
        at = np.arange(len(rows))[:, None]
        inner = self.statistic.shape[1]
        while node.size and node[0, 0] < inner:
            node = 2 * node + 1 + (rows[at, self.statistic[trees, node]] > self.threshold[trees, node])
        total = self.start + self.value[trees, node - inner].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-np.clip(total, -500, 500)))


def grow(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Boost complete trees on the logistic loss.  Without rows of both labels the forest says their share."""
    inner = (1 << depth) - 1
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    start = float(np.log(share / (1 - share)))
    statistic, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    if len(np.unique(labels)) < 2:
        return Forest(statistic[:0], threshold[:0], value[:0], start)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in rows.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, rows.T, strict=True)])
    total = np.full(len(rows), start)
    for t in range(trees):
        chance = 1 / (1 + np.exp(-total))
        gradient, weight = chance - labels, np.maximum(chance * (1 - chance), 1e-6)
        node = np.zeros(len(rows), dtype=np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.zeros(width)
            pick = np.full((width, 2), -1)
            for f, (own, e) in enumerate(zip(binned, edges, strict=True)):
                if not len(e):
                    continue
                slot = (node - first) * BINS + own
                sums = [
                    np.bincount(slot, weights=w, minlength=width * BINS).reshape(width, BINS).cumsum(axis=1)
                    for w in (gradient, weight, np.ones(len(rows)))
                ]
                (g, h, c) = (s[:, :-1] for s in sums)
                (ga, ha, ca) = (s[:, -1:] for s in sums)
                gain = g**2 / (h + RIDGE) + (ga - g) ** 2 / (ha - h + RIDGE) - ga**2 / (ha + RIDGE)
                gain[(c < LEAST_ROWS) | (ca - c < LEAST_ROWS)] = 0
                gain[:, len(e) :] = 0
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                better = top > best + 1e-9
                best[better], pick[better] = top[better], np.stack([np.full(width, f), at], axis=1)[better]
            for i in np.flatnonzero(pick[:, 0] >= 0):
                statistic[t, first + i], threshold[t, first + i] = pick[i, 0], edges[pick[i, 0]][pick[i, 1]]
            right = rows[np.arange(len(rows)), statistic[t, node]] > threshold[t, node]
            node = 2 * node + 1 + right
        leaf = node - inner
        g = np.bincount(leaf, weights=gradient, minlength=inner + 1)
        h = np.bincount(leaf, weights=weight, minlength=inner + 1)
        value[t] = -RATE * g / (h + RIDGE)
        total += value[t][leaf]
    return Forest(statistic, threshold, value, start)


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """A forest from ``labels.quality`` of documents outside fold 2.

    About ``sample_rows`` labelled rows are drawn by a hash of the id; their
    ids are the only thing broadcast, and only their statistics are collected.
    """
    known = labels.where((remainder() != 2) & F.col("quality").isin(0, 1)).select("doc_id", "quality")
    count = known.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = cut_lineage(
        known.where(draw < min(1.0, 1.1 * sample_rows / max(1, count)))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows).select(F.col("doc_id").alias("id"), "quality"),
        "labelled-sample",
    )

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            rows = statistics(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(rows), pa.list_(pa.float64()))],
                names=["id", "quality", "rows"],
            )

    table = (
        docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("id"))
        .select("id", "quality", "text").mapInArrow(measured, "id long, quality int, rows array<double>")
        .orderBy("id", "quality", "rows").limit(2 * sample_rows).toArrow()
    )
    rows = np.array(table.column("rows").to_pylist(), dtype=float).reshape(-1, len(STATISTICS))
    return grow(rows, np.array(table.column("quality").to_pylist(), dtype=float))


def score_quality(docs: DataFrame, forest: Forest, cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    ``score`` is the probability of label 1, ``predicted`` is 1 from ``cut``
    on.  Null and empty texts are scored by statistics of 0; a null id is
    not held out; rows of equal id are each scored by their own text; other
    columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            score = shared.value.score(statistics(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= cut).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    held = F.coalesce(remainder() == 2, F.lit(False)).alias("held_out")
    return docs.select(F.col("doc_id").cast("long"), held, "text").mapInArrow(
        scored, "doc_id long, held_out boolean, score double, predicted int"
    )
