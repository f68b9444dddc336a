"""Quality rules with line labels from a linear-chain conditional random field (operator 1).

Viterbi decoding marks every line of a text as content or boilerplate; the content's share of the words decides retention,
after the base rules. The field is fitted on a bounded sample of labelled documents by maximum conditional likelihood.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.labelled import sample
from ebbtide.llm.lines import line_features, measure, repeated_lines, repeated_words
from ebbtide.llm.text import blocks

RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, content_share double, line_labels array<boolean>"
)


def _steps(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts by falling number of lines, and how many of them have a k-th line."""
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    return order, np.searchsorted(-sizes[order], -np.arange(sizes.max() if len(sizes) else 0), side="left")


def viterbi(scores: np.ndarray, starts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best labels of all lines. ``scores``: (lines, 2) emissions; ``moves``: (2, 2) from label to label; ties go to 0."""
    labels = np.zeros(len(scores), np.int8)
    order, alive = _steps(starts)
    first, n = starts[:-1][order], np.diff(starts)[order]
    best, back = np.zeros((len(order), 2)), []
    for k, m in enumerate(alive):
        if k:
            paths = best[:m, :, None] + moves[None]
            back.append(paths.argmax(1).astype(np.int8))
            best[:m] = paths.max(1)
        best[:m] += scores[first[:m] + k]
    state = best.argmax(1)
    for k in range(len(alive) - 1, -1, -1):
        m = alive[k]
        labels[first[:m] + k] = state[:m]
        if k:
            state[:m] = np.take_along_axis(back[k - 1][:m], state[:m, None], 1)[:, 0]
    assert not len(n) or n.min() >= 1
    return labels


def marginals(scores: np.ndarray, starts: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of each line's labels, and expected counts of moves, by forward and backward sums."""
    order, alive = _steps(starts)
    first, n = starts[:-1][order], np.diff(starts)[order]
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    for k, m in enumerate(alive):
        at = first[:m] + k
        forward[at] = scores[at] + (np.logaddexp.reduce(forward[at - 1][:, :, None] + moves[None], 1) if k else 0)
    for k in range(len(alive) - 2, -1, -1):
        at = first[: alive[k + 1]] + k
        backward[at] = np.logaddexp.reduce(moves[None] + (scores[at + 1] + backward[at + 1])[:, None, :], 2)
    total = np.logaddexp.reduce(forward + backward, 1)
    inner = np.ones(len(scores), bool)
    inner[starts[:-1]] = False
    at = np.flatnonzero(inner)
    pair = forward[at - 1][:, :, None] + moves[None] + (scores[at] + backward[at])[:, None, :] - total[at][:, None, None]
    assert len(n) == len(starts) - 1
    return np.exp(forward + backward - total[:, None]), np.exp(pair).sum(0)


def fit(features: np.ndarray, labels: np.ndarray, starts: np.ndarray, steps: int = 150, rate: float = 0.1, ridge: float = 1e-3):
    """Weights (features, 2) and moves (2, 2) of greatest conditional likelihood, by Adam."""
    truth = np.eye(2)[labels]
    inner = np.ones(len(labels), bool)
    inner[starts[:-1]] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[at - 1], labels[at]), 1)
    shape = features.shape[1]
    theta, mean, spread = np.zeros(2 * shape + 4), 0.0, 0.0
    for t in range(1, steps + 1):
        weights, moves = theta[: 2 * shape].reshape(shape, 2), theta[2 * shape :].reshape(2, 2)
        expected, crossed = marginals(features @ weights, starts, moves)
        slope = np.concatenate(((features.T @ (truth - expected)).ravel(), (seen - crossed).ravel())) / len(labels) - ridge * theta
        mean, spread = 0.9 * mean + 0.1 * slope, 0.999 * spread + 0.001 * slope**2
        theta = theta + rate * (mean / (1 - 0.9**t)) / (np.sqrt(spread / (1 - 0.999**t)) + 1e-8)
    return theta[: 2 * shape].reshape(shape, 2), theta[2 * shape :].reshape(2, 2)


def fit_line_model(docs: DataFrame, labels: DataFrame, *, most_docs: int = 2000, most_lines: int = 200, id_col: str = "doc_id", text_col: str = "text"):
    """The field, from up to ``most_docs`` labelled documents and ``most_lines`` lines of each.

    Lines of documents of quality 1 are content but for notices, lines of quality 0 are boilerplate. Without labelled
    documents, or with one kind only, every line is content.
    """
    rows = sample(docs, labels, "quality", most_docs, id_col=id_col, text_col=text_col).collect()
    if len({r["label"] for r in rows}) < 2:
        return np.array([[-1.0, 1.0]] + [[0.0, 0.0]] * 9), np.zeros((2, 2))
    m = measure(pa.array(["\n".join(r["text"].split("\n")[:most_lines]) for r in rows]))
    good = np.repeat(np.array([r["label"] for r in rows]) == 1, np.diff(m.starts))
    return fit(line_features(m), (good & ~m.notice).astype(np.int64), m.starts)


def rule_batches(weights: np.ndarray, moves: np.ndarray, least_words: int, most_repeats: int, least_share: float, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", block_bytes):
            m = measure(block["text"])
            n_words, repeats = m.per_text(m.counts), repeated_words(m)
            content = viterbi(line_features(m) @ weights, m.starts, moves) == 1
            share = m.per_text(np.where(content, m.counts, 0)) / np.maximum(n_words, 1)
            failed = (n_words < least_words) | (100 * repeats > most_repeats * n_words)
            columns = [
                block["doc_id"], n_words, m.per_text(m.points) - m.per_text(m.classes["blank"]), m.per_text(m.classes["symbol"]),
                repeated_lines(m), repeats, failed, ~failed & (share >= least_share), share,
                pa.ListArray.from_arrays(pa.array(m.starts, pa.int32()), pa.array(content)),
            ]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], [x.split()[0] for x in RESULT.split(", ")])

    return run


def line_quality(
    docs: DataFrame, model, *, id_col: str = "doc_id", text_col: str = "text", least_words: int = 50, most_repeats: int = 50,
    least_share: float = 0.5, block_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per row of ``docs``: counts, ``base_failed``, ``kept``, the content's share of the words and each line's label.

    Words are runs without ``[\\x20\\x09-\\x0D]``. A text fails the base rules with fewer than ``least_words`` words, or if more
    than ``most_repeats`` percent of them are in 3-word windows that it repeats. Otherwise it is kept when ``least_share`` of
    its words or more are in content lines. A null text counts as empty: no words, one line, failed. Rows that repeat an id stay
    rows of their own; an empty table gives an empty result; no other column is read. Texts are measured in blocks, a very
    long one alone.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(rule_batches(*model, least_words, most_repeats, least_share, block_bytes), RESULT)
