"""Piece BPE with a public ``sentencepiece`` model, by distinct words of a block of texts."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece

BLANK = "▁"  # fixed value: how pieces write a blank


class Pieces:
    """Encoder and table of token bytes of one model; ``load`` keeps one per Python worker."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.library.get_piece_size()
        pieces = [self.library.id_to_piece(i) for i in range(self.size)]
        byte = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else None for i, p in enumerate(pieces)]
        self.bytes = pa.array([b if b else p.replace(BLANK, " ").encode() for b, p in zip(byte, pieces, strict=True)], pa.large_binary())
        self.opens = np.array([p.startswith(BLANK) for p in pieces])
        self.newline = byte.index(b"\n") if b"\n" in byte else -1
        # Words are encoded alone as in their text if no piece goes on after a blank or holds a line end.
        self.apart = self.newline >= 0 and not any(BLANK in p.lstrip(BLANK) or "\n" in p for p in pieces)

    @staticmethod
    @functools.lru_cache(maxsize=2)
    def load(path: str) -> Pieces:
        return Pieces(path)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.uint32) for x in self.library.encode(texts, num_threads=1)]

    def encode_keys(self, strings: pa.Array, spaced: np.ndarray, step: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (of ``Vocabulary.keys``; a blank stands before the first, ``spaced`` ones) and where each word's ids
        start."""
        n = int(spaced.sum())
        line_end = pc.index(strings, "\n").as_py()
        words = (pc.if_else(pc.equal(strings, "\n"), "x", strings) if line_end >= 0 else strings).to_pylist()
        found, sizes = [], []
        for start, stop, glue in ((0, n, " "), (n, len(words), "\n")):
            for k in range(start, stop, step):
                part = words[k : min(k + step, stop)]
                joined = glue.join(part) if glue == " " else glue + glue.join(part)
                ids = np.array(self.library.encode(joined, num_threads=1), np.uint32)
                if glue == "\n":
                    ids = ids[1:]  # the blank that the library puts before a text
                first = np.flatnonzero(self.opens[ids] if glue == " " else ids == self.newline)
                if len(first) != len(part):
                    raise ValueError("words and their encoding differ in number")
                each = np.diff(np.append(first, len(ids)))
                if glue == "\n":
                    ids, each = ids[ids != self.newline], each - 1
                found.append(ids)
                sizes.append(each)
        if line_end >= 0:  # the line end itself stands for one id, not for those of the "x" in its place
            block, place = _where(sizes, line_end)
            before = int(sizes[block][:place].sum())
            found[block] = np.concatenate((found[block][:before], [self.newline], found[block][before + sizes[block][place] :])).astype(np.uint32)
            sizes[block][place] = 1
        ids = np.concatenate(found) if found else np.empty(0, np.uint32)
        return ids, np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int64) if sizes else np.zeros(1, np.int64)


def _where(sizes: list[np.ndarray], at: int) -> tuple[int, int]:
    """Which block, and which place in it, holds the item ``at`` of all."""
    for block, x in enumerate(sizes):
        if at < len(x):
            return block, at
        at -= len(x)
    raise IndexError(at)
