"""Byte-level BPE with a public vocabulary file, by distinct words of a block of texts.

The vocabulary is a ``tokenizers`` JSON file. Texts of well-known characters are encoded through their distinct words with the
same merges in ``tiktoken``; every other text by the ``tokenizers`` library. That the two agree needs a file whose merges are in
order of their ids and lead to every piece, which is checked when a file is loaded: of another file, every text goes to the library.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

#: Fixed value: the pre-tokenizer's pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters whose classes every Unicode version shares: ASCII, Latin, Greek, Cyrillic, kana, CJK, Hangul, punctuation.
PLAIN = r"!-~¡-ɏΑ-ΡΣ-Ωα-ωЀ-ӿぁ-ゖァ-ヺ一-龥가-힣‐-‧‰-⁞€"
#: Plain words with one blank or one line end between them.
REGULAR = rf"^[{PLAIN}]+(?:[ \n][{PLAIN}]+)*$"
ONE_WORD = re.compile(f"[{PLAIN}]+").fullmatch


def byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a letter: printable Latin-1 as itself, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + k) for k, b in enumerate(others)}


class Vocabulary:
    """Encoder and id-to-piece table of one file; ``load`` keeps one per Python worker."""

    def __init__(self, path: str, plain_specials: bool = False):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        byte_of = {letter: b for b, letter in byte_letters().items()}
        ranks = {bytes(byte_of[c] for c in piece): i for piece, i in described["model"]["vocab"].items() if all(c in byte_of for c in piece)}
        self.specials = {x["content"]: x["id"] for x in described["added_tokens"]}
        ranks = {piece: i for piece, i in ranks.items() if piece.decode("utf-8", "replace") not in self.specials}
        pieces = {i: piece for piece, i in ranks.items()} | {i: content.encode() for content, i in self.specials.items()}
        self.size = max(pieces) + 1
        self.pieces = pa.array([pieces.get(i, b"") for i in range(self.size)], pa.large_binary())
        self.merges = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.newline = ranks[b"\n"]
        self.opens = np.array([pieces.get(i, b"")[:1] == b" " for i in range(self.size)])
        self.in_order = self._in_order(described["model"], ranks)
        if plain_specials:  # their strings in a text are then ordinary text
            self.library.encode_special_tokens = True
            self.specials = {}

    @staticmethod
    @functools.lru_cache(maxsize=2)
    def load(path: str, plain_specials: bool = False) -> Vocabulary:
        return Vocabulary(path, plain_specials)

    def _in_order(self, model: dict, ranks: dict[bytes, int]) -> bool:
        """Whether merges give ascending ids, one for every piece of more than a byte, and lead from bytes to every piece."""
        merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = [model["vocab"].get("".join(m), -1) for m in merged]
        rising = all(a < b for a, b in zip(ids, ids[1:], strict=False)) and set(ids) == {i for piece, i in ranks.items() if len(piece) > 1}
        return rising and all(self.merges.encode_single_token(p) == i and self.merges._encode_single_piece(p) == [i] for p, i in ranks.items())

    def regular(self, texts: pa.Array) -> np.ndarray:
        """Which texts may be split at their single blanks and line ends."""
        if not self.in_order:
            return np.zeros(len(texts), bool)
        fits = pc.match_substring_regex(texts, REGULAR)
        for special in self.specials:
            fits = pc.and_(fits, pc.invert(pc.match_substring(texts, special)))
        return fits.to_numpy(zero_copy_only=False)

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Pre-tokens or runs of them that are encoded alone as in their text: places in the list of distinct words,
        where each text's words start, and the words."""
        regular = self.regular(texts)
        quick, offsets, words = self._regular_words(texts.filter(pa.array(regular)))
        if regular.all():
            return quick, offsets, words
        known = {w: k for k, w in enumerate(words)}
        parts, each = iter(np.split(quick, offsets[1:-1]) if regular.any() else []), []
        for fits, text in zip(regular.tolist(), texts.to_pylist(), strict=True):
            each.append(next(parts) if fits else np.array([known.setdefault(w, len(known)) for w in self._split(text)], np.int64))
        return np.concatenate(each), np.concatenate(([0], np.cumsum([len(x) for x in each]))).astype(np.int64), list(known)

    def _split(self, text: str) -> list[str]:
        """The library's own pre-tokens; special tokens stand alone."""
        parts = [text]
        for special in self.specials:
            parts = [y for x in parts for y in ([x] if x in self.specials else _around(x, special))]
        found = []
        for part in parts:
            if part in self.specials:
                found.append(part)
            elif part:
                spans = self.library.pre_tokenizer.pre_tokenize_str(part)
                found += [part[a:b] for _, (a, b) in spans]
        return found

    def keys(self, texts: pa.Array, blank_first: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """Of regular texts: each word's place among the distinct ones, where each text starts, the distinct words' strings,
        and whether a blank stands before them; those with one come first. ``blank_first``: as if each text began with a blank."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        both = lists.flatten().dictionary_encode()
        ids, vocabulary = both.indices.to_numpy(zero_copy_only=False), both.dictionary
        ends = ids == pc.index(vocabulary, "\n").as_py()
        keys = ids * 2 + 1
        firsts = offsets[:0] if blank_first else offsets[:-1][np.diff(offsets) > 0]
        bare = np.concatenate((firsts, np.flatnonzero(ends), np.flatnonzero(ends) + 1))
        bare = bare[bare < len(ids)]
        keys[bare] = ids[bare] * 2
        seen = np.zeros(2 * len(vocabulary), bool)
        seen[keys] = True
        used = np.flatnonzero(seen)
        used = np.concatenate((used[used % 2 == 1], used[used % 2 == 0]))
        place = np.zeros(2 * len(vocabulary), np.int32)
        place[used] = np.arange(len(used))
        return place[keys], offsets, vocabulary.take(pa.array(used // 2)), used % 2 == 1

    def _regular_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        at, offsets, strings, spaced = self.keys(texts)
        return at, offsets, [" " + w if s else w for w, s in zip(strings.to_pylist(), spaced.tolist(), strict=True)]

    def _regular_units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        at, offsets, strings, spaced = self.keys(texts)
        return *self.encode_keys(strings, spaced), at, offsets

    def encode_keys(self, strings: pa.Array, spaced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of ``keys`` and where each word's ids start."""
        n = int(spaced.sum())
        line_end = pc.index(strings, "\n").as_py()
        found, starts = [], []
        for group, glue in ((strings.slice(0, n), " "), (strings.slice(n), "\n")):
            if not len(group):
                continue
            if glue == "\n" and line_end >= 0:  # the line end itself, as one more word, is given its id below
                group = pc.if_else(pc.equal(group, "\n"), "x", group)
            joined = glue + pc.binary_join(pa.ListArray.from_arrays([0, len(group)], group), glue)[0].as_py()
            ids = np.array(self.merges.encode_ordinary(joined), np.uint32)
            first = np.flatnonzero(self.opens[ids] if glue == " " else ids == self.newline)
            if len(first) != len(group):
                raise ValueError("words and their encoding differ in number")
            if glue == "\n":
                keep = ids != self.newline
                first = (np.cumsum(keep) - keep)[first]
                ids = ids[keep]
                if line_end >= 0:
                    ids[first[line_end - n]] = self.newline
            starts.append(first + sum(map(len, found)))
            found.append(ids)
        ids = np.concatenate(found) if found else np.empty(0, np.uint32)
        return ids, np.concatenate([*starts, [len(ids)]]).astype(np.int64)

    def units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Texts (no nulls) as sequences of distinct units: ids of all units, where each unit's ids start, each unit's
        place in the texts, and where each text starts. A text that isn't regular is one unit."""
        regular = self.regular(texts)
        ids, starts, at, offsets = self._regular_units(texts.filter(pa.array(regular)))
        if regular.all():
            return ids, starts, at, offsets
        whole = [np.array(e.ids, np.uint32) for e in self.library.encode_batch(texts.filter(pa.array(~regular)).to_pylist(), add_special_tokens=False)]
        n = len(starts) - 1
        parts, alone = iter(np.split(at, offsets[1:-1]) if regular.any() else []), iter(range(n, n + len(whole)))
        each = [next(parts) if fits else np.array([next(alone)], np.int32) for fits in regular.tolist()]
        starts = np.concatenate((starts, starts[-1] + np.cumsum([len(x) for x in whole]))).astype(np.int64)
        return np.concatenate([ids, *whole]), starts, np.concatenate(each), np.concatenate(([0], np.cumsum([len(x) for x in each]))).astype(np.int64)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and where each word's ids start."""
        found: list = [None] * len(words)
        spaced = [k for k, w in enumerate(words) if w[:1] == " " and ONE_WORD(w, 1)]
        bare = [k for k, w in enumerate(words) if ONE_WORD(w) and w not in self.specials]
        for group, text in ((spaced, "".join([words[k] for k in spaced])), (bare, "\n" + "\n".join([words[k] for k in bare]))):
            if not group:
                continue
            ids = np.array(self.merges.encode_ordinary(text), np.uint32)
            starts = np.flatnonzero(self.opens[ids] if group is spaced else ids == self.newline)
            if len(starts) != len(group):
                raise ValueError("words and their encoding differ in number")
            skip = 0 if group is spaced else 1
            for k, a, b in zip(group, (starts + skip).tolist(), [*starts[1:].tolist(), len(ids)], strict=True):
                found[k] = ids[a:b]
        rest = [k for k, x in enumerate(found) if x is None]
        for k, e in zip(rest, self.library.encode_batch([words[k] for k in rest], add_special_tokens=False), strict=True):
            found[k] = np.array(e.ids, np.uint32)
        starts = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int64)
        return (np.concatenate(found) if found else np.empty(0, np.uint32)), starts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (no nulls) and where each text's ids start."""
        return spread(*self.units(texts))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The UTF-8 text of each slice, by taking every id's piece from the id-to-piece table."""
        taken = self.pieces.take(pa.array(ids.astype(np.int32)))
        ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1]
        joined = taken.buffers()[2].to_pybytes() if len(taken) else b""
        bounds = ends[offsets].tolist()
        parts = [joined[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return [x if _valid(x) else x.decode("utf-8", "replace").encode() for x in parts]


def spread(ids: np.ndarray, starts: np.ndarray, at: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace each place by its unit's ids; ``offsets`` move along."""
    sizes = np.diff(starts).astype(np.int32)[at]
    ends = np.zeros(len(at) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    lists = pa.LargeListArray.from_arrays(pa.array(starts), pa.array(ids))
    return lists.take(pa.array(at)).flatten().to_numpy(), ends[offsets]


def _valid(text: bytes) -> bool:
    try:
        text.decode()
    except UnicodeDecodeError:
        return False
    return True


def _around(text: str, special: str) -> list[str]:
    parts = text.split(special)
    return [x for k, part in enumerate(parts) for x in ([special, part] if k else [part])]
