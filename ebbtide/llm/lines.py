"""What the quality operators measure of a block of texts, line by line and text by text, in whole-block array operations."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ebbtide.llm.text import coded, flat, split_words

#: Classes of bytes; letters outside ASCII are in no class.
CLASSES = {"blank": b" \t\r\x0b\x0c", "symbol": b"#*$%&|<>", "shout": b"!?", "digit": b"0123456789", "upper": bytes(range(65, 91)), "stop": b".,;:"}
#: Fixed value: words of lines that no reader came for.
NOTICES = r"(?i)licen[cs]e|copyright|all rights reserved|released under|cookies?\b|subscribe|sign up|log in|privacy policy|terms of (use|service)|click here|share this"
CLASS_OF = np.zeros(256, np.uint8)
for _k, _bytes in enumerate(CLASSES.values(), 1):
    CLASS_OF[list(_bytes)] = _k


@dataclass
class Measures:
    """Of every line: bytes, words, words equal to the one before, counts by class, notice; and where each text's lines start."""

    lines: pa.Array
    starts: np.ndarray  # of each text among the lines
    words: np.ndarray  # places in the vocabulary
    word_starts: np.ndarray  # of each line among the words
    vocabulary: pa.Array
    sizes: np.ndarray
    points: np.ndarray
    again: np.ndarray
    classes: dict[str, np.ndarray]
    notice: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.word_starts)

    def per_text(self, by_line: np.ndarray) -> np.ndarray:
        """Sums over each text's lines."""
        total = np.concatenate(([0], np.cumsum(by_line)))
        return total[self.starts[1:]] - total[self.starts[:-1]]


def measure(texts: pa.Array) -> Measures:
    """``texts`` hold no nulls; a text has one line at least."""
    lines, starts = flat(pc.split_pattern(texts, "\n"))
    lines = pa.concat_arrays([lines])
    words, word_starts, vocabulary = split_words(lines)
    ends = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset : lines.offset + len(lines) + 1].astype(np.int64)
    data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    classed = CLASS_OF[data]
    bounds = ends[1:] - ends[0]
    line_of = {}
    for k, name in enumerate(CLASSES, 1):
        places = np.flatnonzero(classed == k)
        line_of[name] = np.bincount(np.searchsorted(bounds, places, side="right"), minlength=len(lines))
    same = np.zeros(len(words) + 1, np.int64)
    if len(words):
        equal = words[1:] == words[:-1]
        inner = word_starts[1:-1]
        equal[inner[(inner > 0) & (inner < len(words))] - 1] = False
        same[2:] = np.cumsum(equal)
    return Measures(
        lines, starts, words, word_starts, vocabulary, np.diff(ends), pc.utf8_length(lines).to_numpy().astype(np.int64),
        same[word_starts[1:]] - same[word_starts[:-1]], line_of, pc.match_substring_regex(lines, NOTICES).to_numpy(zero_copy_only=False),
    )


def repeated_lines(m: Measures) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of the text."""
    codes, _ = coded(m.lines)
    text = np.repeat(np.arange(len(m.starts) - 1), np.diff(m.starts))
    worded = m.counts > 0
    pairs = np.sort(text[worded].astype(np.int64) * len(m.lines) + codes[worded])
    again = pairs[1:][pairs[1:] == pairs[:-1]] // max(1, len(m.lines))
    return np.bincount(again, minlength=len(m.starts) - 1)


def repeated_words(m: Measures, size: int = 3) -> np.ndarray:
    """Per text: words in windows of ``size`` words that the text has twice or more."""
    bounds = m.word_starts[m.starts]
    found = np.zeros(len(bounds) - 1, np.int64)
    if len(m.words) < size:
        return found
    n = len(m.words) - size + 1
    keys = m.words[:n].astype(np.int64)
    for k in range(1, size):
        if len(m.vocabulary) * (int(keys.max()) + 1) >= 1 << 62:  # name the windows so far by fewer numbers
            keys = np.unique(keys, return_inverse=True)[1].astype(np.int64)
        keys = keys * len(m.vocabulary) + m.words[k : k + n]
    for t, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        own = keys[a : b - size + 1] if b - a >= size else keys[:0]
        if len(own) < 2:
            continue
        ordered = np.sort(own)
        if not (ordered[1:] == ordered[:-1]).any():
            continue
        _, inverse, counts = np.unique(own, return_inverse=True, return_counts=True)
        marked = np.zeros(b - a, bool)
        often = np.flatnonzero(counts[inverse] > 1)
        for k in range(size):
            marked[often + k] = True
        found[t] = marked.sum()
    return found


def line_features(m: Measures) -> np.ndarray:
    """One row per line: constant, shares of symbols, shouting, digits, capitals and stops, repeated words, length, notice, emptiness."""
    size, words = np.maximum(m.sizes, 1), np.maximum(m.counts, 1)
    shares = [m.classes[k] / size for k in ("symbol", "shout", "digit", "upper", "stop")]
    columns = [np.ones(len(m.sizes)), *(np.minimum(10 * s, 3) for s in shares), 3 * m.again / words, np.log1p(m.counts) / 3, m.notice, m.counts == 0]
    return np.stack(columns, 1).astype(np.float64)


def text_features(m: Measures) -> np.ndarray:
    """One row per text: constant, shares by class, repeated words and lines, word length, length."""
    size, words = np.maximum(m.per_text(m.sizes), 1), m.per_text(m.counts)
    some = np.maximum(words, 1)
    shares = [m.per_text(m.classes[k]) / size for k in ("symbol", "shout", "digit", "upper", "stop")]
    letters = (m.per_text(m.points) - m.per_text(m.classes["blank"])) / some
    columns = [
        np.ones(len(words)), *(np.minimum(10 * s, 5) for s in shares), 3 * m.per_text(m.again) / some, np.minimum(letters, 20) / 5,
        np.log1p(words) / 3, repeated_lines(m) / np.maximum(np.diff(m.starts), 1), 3 * repeated_words(m) / some, words == 0,
    ]
    return np.stack(columns, 1).astype(np.float64)
