"""Tokenizer alignment, vector codes and toxicity against brute force, on small tables with nulls, ties, repeats and odd texts."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbtide.llm import alignment, toxicity, vector_codes
from ebbtide.llm.tokens import Vocabulary, byte_letters

from ..conftest import SF

WORDS, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# 11 -----------------------------------------------------------------------------------------------
TEXTS = [
    (1, None), (2, ""), (3, " "), (4, "\n"), (5, "a\n\nb  c\t d "), (6, "ｆｕｌｌ ① naïve <|endoftext|> </s> <unk> x"), (7, "日本語 \x00 ​ 😀 ٣٤"),
    (8, "one\ntwo three\nfour"), (9, "\r\nx"), (10, "word " * 2000), (11, "▁mark and ▁▁marks"), (None, "x"), (None, "x"), (8, "one\ntwo three\nfour"),
    (12, " ".join(f"under{k}standing misread{k * k}" for k in range(700))), (13, "don't  stop...now"),
]


def tokens_of(text, library, model):
    byte_of = {letter: b for b, letter in byte_letters().items()}
    a = library.encode(" " + text, add_special_tokens=False)
    b = model.encode(text)
    pieces = [model.id_to_piece(x) for x in b]
    of_b = [bytes([int(p[3:5], 16)]) if model.is_byte(x) else p.replace("▁", " ").encode() for x, p in zip(b, pieces)]
    return list(a.ids), [bytes(byte_of[c] for c in t) for t in a.tokens], b, of_b


def brute_alignment(rows):
    library, model = Tokenizer.from_file(WORDS), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    library.encode_special_tokens = True
    held, aligned = Counter(), []
    for doc_id, text in rows:
        links, groups, n = [], [], (0, 0)
        if text:
            a, of_a, b, of_b = tokens_of(text, library, model)
            if b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
                spans = []
                for parts in (of_a, of_b):
                    ends = np.cumsum([len(x) for x in parts]).tolist()
                    spans.append(list(zip([0, *ends[:-1]], ends)))
                n = len(a), len(b)
                j = 0
                for i, (start, end) in enumerate(spans[0]):  # every pair whose ranges overlap
                    while spans[1][j][1] <= start:
                        j += 1
                    k = j
                    while k < len(b) and spans[1][k][0] < end:
                        links.append((a[i], b[k]))
                        k += 1
                shared = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
                for low, high in zip([0, *shared[:-1]], shared):
                    own = [",".join(str(x) for x, (s, e) in zip(ids, at) if low <= s and e <= high) for ids, at in ((a, spans[0]), (b, spans[1]))]
                    groups.append("|".join(own))
        held.update(set(links))
        aligned.append((doc_id, *n, len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    top = {}
    for (a, _), count in held.items():
        top[a] = max(top.get(a, 0), count)
    return Counter(
        (doc_id, n_a, n_b, n_groups, len(links), sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links), digest)
        for doc_id, n_a, n_b, n_groups, links, digest in aligned
    )


@pytest.mark.parametrize("options", [{}, {"block_bytes": 4000, "work": 5, "row_places": 200, "row_pairs": 300}])
def test_alignment_equals_brute_force(spark, options):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("block", "pair", "n", "places")}).repartition(3)
    given = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 4000").select("doc_id", "text").limit(60)
    for df in (docs, given):
        found = alignment.alignment(df, WORDS, PIECES, **options)
        expected = brute_alignment([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])
        assert Counter(tuple(r) for r in found.collect()) == expected
    assert alignment.alignment(docs.limit(0), WORDS, PIECES).count() == 0


@pytest.mark.parametrize("work", [1, 2, 7, 64, 10_000])
def test_merge_path_pieces_do_equal_work_and_find_every_overlap(work):
    rng = np.random.default_rng(work)
    for size in (1, 5, 400):
        a = np.unique(np.append(rng.integers(1, 3 * size + 2, size), 3 * size + 2))
        b = np.unique(np.append(rng.integers(1, 3 * size + 2, 2 * size), 3 * size + 2))
        i, j = alignment.crossings(a, b, work)
        assert np.array_equal(i + j, np.arange(0, len(a) + len(b), work))
        left, right, closed = alignment.overlaps(a, b, work)
        ranges = [list(zip([0, *x[:-1].tolist()], x.tolist())) for x in (a, b)]
        wanted = [(m, n) for m, (s, e) in enumerate(ranges[0]) for n, (t, f) in enumerate(ranges[1]) if s < f and t < e]
        assert list(zip(left.tolist(), right.tolist())) == wanted
        assert closed.sum() == len(set(a.tolist()) & set(b.tolist()))


def test_a_vocabulary_whose_merges_are_not_in_order_goes_to_the_library():
    known = Vocabulary.load(WORDS)
    assert known.in_order and known.regular(pa.array(["plain words"])).all()
    assert not known._in_order({"vocab": {"a": 0, "ab": 1}, "merges": [["a", "b"], ["b", "a"]]}, {b"a": 0, b"ab": 1})


# 12 -----------------------------------------------------------------------------------------------
def test_machine_equals_all_pairs_and_learns_an_interaction():
    rng = np.random.default_rng(0)
    kinds = [("mild", 0), ("insult", 0), ("group", 0), ("insult group", 1)] * 150  # neither term alone is toxic
    texts = pa.array([f"{words} filler{rng.integers(40)} filler{rng.integers(40)}" for words, _ in kinds])
    labels = np.array([y for _, y in kinds], float)
    terms, starts = toxicity.terms_of(texts, 18)
    machine = toxicity.fit(terms, starts, labels, 18, epochs=60, rate=0.1)
    odds = machine.odds(terms, starts)
    assert ((odds > 0) == (labels == 1)).mean() > 0.99
    for k in (0, 1, 2, 3):
        own = [int(np.searchsorted(machine.cells, t)) for t in terms[starts[k] : starts[k + 1]] if t in machine.cells]
        pairs = sum(machine.factors[i] @ machine.factors[j] for n, i in enumerate(own) for j in own[n + 1 :])
        assert math.isclose(odds[k], machine.constant + machine.weights[own].sum() + pairs, abs_tol=1e-9)


def test_toxicity_of_held_out_rows_and_of_odd_ones(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    machine = toxicity.fit_machine(docs, labels)
    found = toxicity.toxicity(docs, machine, block_bytes=200_000).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in found)
    bad = [r for r in found if r["toxic"] == 1]
    assert sum(r["predicted"] for r in bad) >= 0.9 * len(bad)
    assert sum(r["predicted"] for r in found if not r["toxic"]) <= 0.02 * len(found)
    # flipped labels of held out rows change nothing
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit_machine(docs, flipped)
    assert np.array_equal(again.cells, machine.cells) and np.allclose(again.weights, machine.weights)
    odd = spark.createDataFrame([(None, "x", 1), (2, None, 1), (2, "", 1), (22, "x", 1), (22, "x", 1), (4, "a b " * 30_000, 1)], "doc_id long, text string, score int")
    rows = toxicity.toxicity(odd, machine).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["doc_id"] for r in rows if r["held_out"]} == {i for i in (2, 4, 22) if zlib.crc32(str(i).encode()) % 4 == 2}
    nothing = toxicity.fit_machine(odd.limit(0), labels)
    assert toxicity.toxicity(odd, nothing).count() == 6 and toxicity.toxicity(odd.limit(0), machine).count() == 0


# 13 -----------------------------------------------------------------------------------------------
def test_limb_products_are_exact():
    rng = np.random.default_rng(1)
    for width, top in ((1, 1 << 30), (8, 1 << 29), (8, 100), (64, 1 << 27)):
        a, b = rng.integers(-top, top, (50, width)), rng.integers(-top, top, (7, width))
        exact = np.array([[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a], object)
        assert (vector_codes.dots(a, b).astype(object) == exact).all()
        bits = vector_codes.limb_bits(width)
        assert width * ((1 << bits) - 1) ** 2 < 1 << 53
    for total in (0, 1, -1, 1 << 40, -(1 << 40), 12345678901234567890123, -98765432109876543210):
        assert sum(x << vector_codes.TOTAL_BITS * k for k, x in enumerate(vector_codes.total_limbs(total))) == total


def brute_codes(rows, parts=8, entries=16, rounds=6):
    """``rows``: (vec_id, whole numbers, label) in order of the ids."""
    width = len(rows[0][1]) // parts
    cut = [[r[1][p * width : (p + 1) * width] for r in rows] for p in range(parts)]
    books, codes = [], []
    for own in cut:
        book = [list(x) for x in own[:entries]]

        def near(x, book=book):
            return min((sum((u - v) ** 2 for u, v in zip(x, e)), k) for k, e in enumerate(book))

        for _ in range(rounds):
            at = [near(x)[1] for x in own]
            for k in range(len(book)):
                mine = [x for x, c in zip(own, at) if c == k]
                if mine:
                    book[k] = [sum(column) // len(mine) for column in zip(*mine)]
        books.append(book)
        codes.append([near(x) for x in own])
    errors = [sum(c[n][0] for c in codes) for n in range(len(rows))]
    by_label = Counter()
    for r, e in zip(rows, errors):
        by_label[r[2]] += e
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return Counter((r[0], "".join(f"{c[n][1]:02x}" for c in codes), errors[n], by_label[r[2]], digest) for n, r in enumerate(rows))


def test_vector_codes_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    vectors = [[float(x) for x in rng.normal(0, 1, 16).round(2)] for _ in range(40)]
    vectors += [vectors[3], vectors[3], [20_000.0 * x for x in vectors[5]], [0.0] * 16, [3e8 * x for x in vectors[7]]]
    rows = [(k * 3 % 101, v, [None, 1, 2][k % 3]) for k, v in enumerate(vectors)] + [(7, vectors[0], 1), (7, vectors[1], 1)]
    bad = [(0, None, 1), (1, vectors[0][:-1] + [None], 1), (2, vectors[0][:-1] + [float("nan")], 1), (4, vectors[0][:-1] + [float("inf")], 2), (200, [1.0], 1), (201, [], 1)]
    df = spark.createDataFrame(rows + bad, "vec_id int, embedding array<double>, label int").withColumns({c: F.lit(1) for c in ("code", "error", "vector")})
    ordered = [(i, [math.floor(4096 * x) for x in v], y) for i, v, y in sorted(rows, key=lambda r: (r[0], r[1]))]
    assert Counter(tuple(r) for r in vector_codes.compressed(df.repartition(5)).collect()) == brute_codes(ordered)


def test_vector_codes_of_few_and_of_no_rows(spark):
    few = spark.createDataFrame([(1, [1e38, 2.0, -3.0], "a"), (None, [3.3e38, -1.0, 0.5], None)], "vec_id long, embedding array<double>, label string")
    assert [tuple(r)[:4] for r in vector_codes.compressed(few).orderBy("vec_id").collect()] == [(None, "01" * 3 + "00" * 5, 0, 0), (1, "00" * 8, 0, 0)]
    assert vector_codes.compressed(few.limit(0)).count() == 0
    assert vector_codes.compressed(few.filter("embedding is null")).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
