"""Quality scores: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.columns import hide, show

FEATURES = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "short_words", "long_words", "distinct_words",
    "top_word", "top_two_words", "repeats_before", "symbol_words", "symbol_tails", "digit_words", "capital_words",
    "sentence_ends", "commas", "lines", "line_words", "distinct_lines", "top_line",
    "letters", "capitals", "digits", "spaces", "other_marks", "high_bytes", "controls", "byte_entropy",
)

_KIND = np.full(256, 7)
_KIND[128:] = 6
_KIND[:32] = 7
for _first, _last, _kind in ((97, 122, 0), (65, 90, 1), (48, 57, 2), (33, 47, 5), (58, 64, 5), (91, 96, 5), (123, 126, 5)):
    _KIND[_first : _last + 1] = _kind
_KIND[[9, 10, 11, 12, 13, 32]] = 3
_KIND[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = 4  # marks of ordinary prose
_MARKS = b"!\"'(),-.:;?"


def statistics(text: str | None) -> list[float]:
    """The numbers of ``FEATURES`` for a whole text; all are 0 where there is nothing to count."""
    data = (text or "").encode()
    if not data:
        return [0.0] * len(FEATURES)
    bytes_ = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = len(data)
    share = bytes_[bytes_ > 0] / n
    kinds = np.bincount(_KIND, weights=bytes_, minlength=8) / n
    lower = data.lower()
    words = lower.split()
    w = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    common = Counter(words)
    first, second = ([c for _, c in common.most_common(2)] + [0, 0])[:2]
    odd = tails = marks = digits = 0
    for word, count in common.items():
        core = word.strip(_MARKS)
        if not core.isalnum() and core.isascii():
            bare = core.strip(b"#$%&*+/<=>@[\\]^_`{|}~")
            odd += count * (not bare)
            tails += count * (bool(bare) and bare != core)
        digits += count * core.isdigit()
        marks += count * (word[-1:] in b".!?")
    repeated = sum(a == b for a, b in zip(words, words[1:]))
    lines = [x for x in lower.split(b"\n") if x.strip()]
    line_count = Counter(lines)
    k = max(len(lines), 1)
    capitals = sum(x[:1].isupper() for x in set(data.split()))
    return [
        np.log1p(n), np.log1p(len(words)), float(lengths.mean()), float(lengths.std()),
        float((lengths <= 2).mean()), float((lengths >= 12).mean()), len(common) / w,
        first / w, (first + second) / w, repeated / w, odd / w, tails / w, digits / w, capitals / max(len(common), 1),
        marks / w, int(bytes_[44]) / w, np.log1p(len(lines)), len(words) / k, len(line_count) / k,
        (max(line_count.values()) if lines else 0) / k,
        kinds[0], kinds[1], kinds[2], kinds[3], kinds[5], kinds[6], kinds[7], float(-(share * np.log2(share)).sum()),
    ]


@dataclass
class BoostedTrees:
    """Complete trees of one depth as arrays of shape (trees, nodes); a row goes right where x > threshold."""

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row, all trees walked level by level."""
        x = np.atleast_2d(x)
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 150, depth: int = 4, rate: float = 0.1, bins: int = 64, ridge: float = 2.0
) -> BoostedTrees:
    """Boosting on the logistic loss; splits come from histograms of gradients over quantile bins.

    Without rows or with one label only, there are no trees and the score is the (smoothed) share of label 1.
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    inner, leaves, f = 2**depth - 1, 2**depth, x.shape[1]
    model = BoostedTrees(base, depth, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    if len(np.unique(y)) < 2:
        return model
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins)) for j in range(f)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    cells = binned + np.arange(f) * bins
    total = np.full(len(y), base)
    all_feature, all_threshold, all_leaf = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (f * bins) + cells).ravel()
            size = width * f * bins
            g = np.bincount(at, np.repeat(gradient, f), size).reshape(width, f, bins).cumsum(2)
            h = np.bincount(at, np.repeat(weight, f), size).reshape(width, f, bins).cumsum(2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
            gain[(h < 1) | (h_all - h < 1)] = 0
            best = gain.reshape(width, -1).argmax(1)
            found = gain.reshape(width, -1).max(1) > 1e-6
            chosen, cut = best // bins, best % bins
            for k in np.flatnonzero(found):
                feature[first + k], threshold[first + k] = chosen[k], edges[chosen[k]][cut[k]]
            here = node - first
            right = found[here] & (binned[np.arange(len(y)), chosen[here]] > cut[here])
            node = 2 * node + 1 + right
        at = node - inner
        g, h = np.bincount(at, gradient, leaves), np.bincount(at, weight, leaves)
        leaf = rate * g / (h + ridge)
        total += leaf[at]
        all_feature.append(feature)
        all_threshold.append(threshold)
        all_leaf.append(leaf)
    return BoostedTrees(base, depth, np.array(all_feature), np.array(all_threshold), np.array(all_leaf))


def held_out(doc_id: str = "doc_id"):
    """Whether labels of a document must not be learnt from: one in five, by the crc32 of the id as text.

    A null id counts as empty text.
    """
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


_STATISTICS = ", ".join(f"{name} double" for name in FEATURES)


def _matrix(texts: pa.Array) -> np.ndarray:
    found = [statistics(t.as_py()) for t in texts]
    return np.array(found, float).reshape(len(found), len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000) -> BoostedTrees:
    """Fit on at most ``most_rows`` rows: labelled documents outside the held-out fifth.

    The bound is on what is fitted: the labels whose ids hash lowest are taken, one document for each (of rows that
    repeat a doc_id the text that hashes lowest), so the sample is the same in every run and its statistics
    (``most_rows`` x 28 numbers) fit the driver. Labels that are null are left out; a document with several labels
    counts once for each. Other columns of either table are ignored.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("_y"))
    sample = known.orderBy(F.xxhash64("_id"), "_id", "_y").limit(most_rows)
    texts = docs.select(F.col("doc_id").alias("_doc"), "text")
    found = texts.join(F.broadcast(sample.select("_id").distinct()), F.col("_doc") == F.col("_id"), "left_semi")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [*batch.columns[:2], *(pa.array(np.ascontiguousarray(c)) for c in _matrix(batch.column(2)).T)]
            yield pa.RecordBatch.from_arrays(columns, ["_doc", "_text", *FEATURES])

    keyed = found.select("_doc", F.xxhash64("text").alias("_text"), "text")
    described = keyed.mapInArrow(run, f"_doc {dict(texts.dtypes)['_doc']}, _text long, " + _STATISTICS)
    numbers = F.struct("_text", *FEATURES)
    one = described.groupBy("_doc").agg(F.min(numbers).alias("_first"))
    table = sample.join(one, F.col("_id") == F.col("_doc")).select("_y", "_first.*").drop("_text").toPandas()
    table = table.sort_values(list(table.columns))  # sums must not depend on the order of tasks
    return fit(table[list(FEATURES)].to_numpy(float), table["_y"].to_numpy(float))


def score_documents(docs: DataFrame, model: BoostedTrees, least: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from ``least`` on).

    Only ``text`` is looked at. Defined cases: a null text is empty, and an empty text has statistics of 0;
    equal texts have equal scores; columns named ``score`` or ``predicted`` are replaced; an empty table stays empty.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    place = kept.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column(place)))
            columns = [*batch.columns, pa.array(score), pa.array((score >= least).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "score", "predicted"])

    rows = docs.select(*kept)
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", score double, predicted int"
    return rows.mapInArrow(run, schema)


def drop_rejected(docs: DataFrame, model: BoostedTrees, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, with all their columns as they are."""
    hidden, names = hide(docs, "text")
    return show(score_documents(hidden, model, least).filter("predicted = 1"), names)
