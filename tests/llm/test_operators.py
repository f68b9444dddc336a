"""The numbered operators against brute force, on small tables with nulls, ties, repeated rows and odd texts."""

import hashlib
import itertools
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbtide.llm import bpe, chosen_path, exact_dedup, line_dedup, mixing, quality_classifier, quality_rules, repair, rollups, url_filter
from ebbtide.llm.components import components
from ebbtide.session import scratch_path

from ..conftest import SF

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile("[^\x20\x09-\x0d]+")
PROSE = " ".join(f"word{k % 61} and{k % 17} the{k}" for k in range(60))
LONG = "\n".join(" ".join(f"w{(k * j) % 997}" for j in range(1, 40)) for k in range(1, 400))
ROWS = [
    (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, PROSE.replace(" ", "\n"), "de", "b"), (4, PROSE + " tail end", "en", None),
    (5, None, "en", "a"), (6, "", None, "b"), (7, " \t\n", "en", "b"), (8, "one two", "en", "a"), (9, "one two", "fr", "a"),
    (10, LONG, "en", "c"), (11, LONG.upper(), "en", "c"), (12, "a\nb\nc\nd\na\nb\nc\n\nx", "en", "a"), (13, "b\nc\nd\ny", "en", "a"),
    (14, "same line " * 30 + "\n" + PROSE, "en", "b"), (15, "### *** $$$ ### !!!\n" * 20, "en", "b"), (16, "x<|endoftext|>y\u00a0 z  \u3000q\r\n", "ja", "d"),
    (17, "\u65e5\u672c \u0663\u0664 \U0001d4b3 e\u0301", "ja", "d"), (8, "one two", "en", "a"), (None, "no id at all", "en", "a"), (None, None, None, None),
    (18, PROSE + " tail end", "en", "a"), (19, "The   the\tThe " * 40, "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    """Extra columns bear names that operators use themselves."""
    extra = {c: F.lit(c) for c in ("row", "key", "node", "lines", "recipe", "block", "host", "mass", "kept", "n_tokens", "start")}
    return spark.createDataFrame(ROWS, SCHEMA).withColumns(extra).repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


# 1 ------------------------------------------------------------------------------------------------
def base_rules(text):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    marked = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked), failed


COUNTS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_rules_equal_brute_force(spark, odd, given):
    model = quality_rules.fit_line_model(given, spark.read.parquet(f"{SF}/labels.parquet"))
    for docs in (odd, given):
        found = quality_rules.line_quality(docs, model, block_bytes=20_000)
        assert rows(found, *COUNTS) == Counter((i, *base_rules(t)) for i, t in texts_of(docs))
        labels = found.select("kept", "base_failed", "line_labels", "content_share").collect()
        assert all(r["kept"] == (not r["base_failed"] and r["content_share"] >= 0.5) for r in labels)


def test_good_documents_stay_and_junk_goes(spark, given):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = quality_rules.line_quality(given, quality_rules.fit_line_model(given, labels)).join(labels, "doc_id").filter("not base_failed")
    share = {r["quality"]: r["x"] for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("x")).collect()}
    assert share[1] > 0.98 and share.get(0, 0) < 0.2


def test_viterbi_and_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    sizes = [1, 4, 2, 6]
    starts = np.concatenate(([0], np.cumsum(sizes)))
    scores, moves = rng.normal(size=(starts[-1], 2)), rng.normal(size=(2, 2))
    best, (single, crossed) = quality_rules.viterbi(scores, starts, moves), quality_rules.marginals(scores, starts, moves)
    pairs = np.zeros((2, 2))
    for a, n in zip(starts, sizes):
        paths = list(itertools.product((0, 1), repeat=n))
        value = np.array([sum(scores[a + k, s] for k, s in enumerate(p)) + sum(moves[x, y] for x, y in zip(p, p[1:])) for p in paths])
        assert tuple(best[a : a + n]) == paths[int(value.argmax())]
        chance = np.exp(value - np.logaddexp.reduce(value))
        assert np.allclose(single[a : a + n, 1], [sum(c for c, p in zip(chance, paths) if p[k]) for k in range(n)])
        for c, p in zip(chance, paths):
            for x, y in zip(p, p[1:]):
                pairs[x, y] += c
    assert np.allclose(crossed, pairs)


# 2 ------------------------------------------------------------------------------------------------
LIBRARY = Tokenizer.from_file(VOCABULARY)


def encoded(text):
    library = LIBRARY
    ids = library.encode(text, add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_encoding_and_decoding_equal_the_library(odd, given):
    for docs in (odd, given):
        want = Counter()
        for i, t in texts_of(docs):
            ids, back = encoded(t)
            want[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), tuple(ids), back] += 1
        found = bpe.encode_decode(docs, VOCABULARY, keep_ids=True, keep_text=True, block_bytes=100_000, row_places=3_000).collect()
        assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], tuple(r["ids"]), r["decoded"]) for r in found) == want


# 3 ------------------------------------------------------------------------------------------------
def test_raked_weights_meet_all_targets(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    centres = mixing.fit_topics(given, topics=4)
    found = mixing.mixture(given, centres, part=0.5, power=0.7).cache()
    rows_ = found.filter("n_tokens > 0").collect()
    total = sum(r["n_tokens"] for r in rows_)
    own, raked = Counter(), Counter()
    for r in rows_:
        for c in ("source", "lang", "topic"):
            own[c, r[c]] += r["n_tokens"] / total
            raked[c, r[c]] += r["n_tokens"] / total * r["weight"]
        own["pair", r["lang"], r["topic"]] += r["n_tokens"] / total
    for c in ("source", "lang"):
        whole = sum(x**0.7 for k, x in own.items() if k[0] == c)
        wanted = {k: x**0.7 / whole for k, x in own.items() if k[0] == c}
        assert all(abs(raked[k] - x) < 1e-5 for k, x in wanted.items()), c
    langs, topics = wanted, Counter()
    for (_, lang), share in langs.items():
        damped = {k[2]: x**0.7 for k, x in own.items() if k[0] == "pair" and k[1] == lang}
        for t, x in damped.items():
            topics[t] += share * x / sum(damped.values())
    assert all(abs(raked["topic", t] - x) < 1e-5 for t, x in topics.items())
    assert abs(sum(r["probability"] * r["n_tokens"] for r in rows_) / total - 0.5) < 1e-6
    assert all(r["kept"] == (r["probability"] >= 1) for r in rows_ if r["probability"] >= 1)
    assert found.count() == given.count()


def test_topics_are_learnt_from_all_rows(spark):
    """A topic of 6 among 9,006 documents gets a centre, and a table of few documents is fitted by the same rule."""
    rare = [(k, " ".join(f"rare{(k + j) % 40}" for j in range(30)), "en", "a") for k in range(6)]
    common = [(100 + k, " ".join(f"often{(k + j) % 12}" for j in range(12)), "en", "a") for k in range(9000)]
    docs = spark.createDataFrame(rare + common, SCHEMA).repartition(5)
    centres = mixing.fit_topics(docs, topics=2)
    topics = {(r["doc_id"] < 100, r["topic"]) for r in mixing.mixture(docs, centres).select("doc_id", "topic").collect()}
    assert len(topics) == 2 and len({t for _, t in topics}) == 2
    assert np.array_equal(centres, mixing.fit_topics(docs.repartition(2), topics=2))
    few = spark.createDataFrame([(1, "a b c", "en", "a"), (2, "a b c", "en", "a"), (3, "x y z", "en", "a")], SCHEMA)
    found = {r["doc_id"]: r["topic"] for r in mixing.mixture(few, mixing.fit_topics(few)).collect()}
    assert mixing.fit_topics(few).shape[0] == 2 and found[1] == found[2] != found[3]


def test_raking_equals_a_dense_solution(spark):
    masses = {("s1", "x", 0): 5.0, ("s1", "y", 0): 1.0, ("s2", "x", 0): 2.0, ("s2", "y", 1): 7.0, ("s1", "x", 1): 3.0, ("s3", "y", 0): 4.0}
    cells = spark.createDataFrame([(*k, m) for k, m in masses.items()], "source string, lang string, topic long, mass double")
    wanted = {"source": {"s1": 0.5, "s2": 0.3, "s3": 0.2}, "lang": {"x": 0.6, "y": 0.4}, "topic": {0: 0.7, 1: 0.3}}
    kinds = {"source": "string", "lang": "string", "topic": "long"}
    targets = {c: spark.createDataFrame([*wanted[c].items()], f"{c} {kinds[c]}, target double") for c in wanted}
    weight = {k: m / sum(masses.values()) for k, m in masses.items()}
    for _ in range(3000):
        for i, c in enumerate(wanted):
            sums = Counter()
            for k, x in weight.items():
                sums[k[i]] += x
            weight = {k: x * wanted[c][k[i]] / sums[k[i]] for k, x in weight.items()}
    for r in mixing.rake(cells, targets, tolerance=1e-9).collect():
        key = (r["source"], r["lang"], r["topic"])
        assert abs(r["weight"] * r["mass"] / sum(masses.values()) - weight[key]) < 1e-6


# 4 ------------------------------------------------------------------------------------------------
def judged(url, rules):
    url = url or ""
    if "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), v == "block", v, h + p) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[3], max(fits)[2]) if fits else (host, path, None, "allow")


def test_url_verdicts_equal_brute_force(spark):
    urls = [
        None, "", "net/", "http://net", "http://net/", "HTTP://A.NET/x", "x://example.net/en", "x://example.net/en/", "x://b.example.net/en/a?q#f",
        "x://notexample.net/en/", "x://example.com/de/1", "x://example.com/fr/", "x://a.org/fr/", "x://a.org/de/?/fr/", "x://org/fr/", "://net/a", "a://b://net/",
        "x://a.net:80/", "x://u@a.net/y", "x:///net/", "x://\u00c9.NET/", "x://a.net?x", "x://a.net/" + "p/" * 3000, "x://..net/", "x://net./", "x://example.com/de/\n/x", "x://a.net/",
    ]
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    rules += [("example.com", "/d", "allow"), ("net", "/", "block"), ("a.net", "/x", "block"), ("a.net", "/x", "allow"), ("a.net", "", "allow")]
    pages = spark.createDataFrame([(k // 2, u) for k, u in enumerate(urls)], "page_id long, url string").withColumns({c: F.lit("z") for c in ("host", "rule", "kind", "short")})
    frame = spark.createDataFrame([*rules, (None, "/", "block"), ("net", None, "block")], "host string, path string, verdict string")
    found = url_filter.filter_urls(pages, frame)
    assert rows(found, "page_id", "host", "path", "rule", "verdict") == Counter((k // 2, *judged(u, rules)) for k, u in enumerate(urls))
    assert url_filter.filter_urls(pages.limit(0), frame).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(pages, frame.limit(0)).collect()} == {"allow"}


# 5 ------------------------------------------------------------------------------------------------
def test_token_files_give_back_all_documents(spark, odd, given):
    for docs, size in ((odd, 5_000), (given, 200_000)):
        folder = scratch_path(spark, "files")
        repair.write_tokens(docs, folder, VOCABULARY, block_bytes=size, least=3, rounds=(4, 4))
        found = sorted(repair.read_tokens(spark, folder).collect(), key=lambda r: r["start"])
        assert Counter((r["doc_id"], tuple(r["ids"])) for r in found) == Counter((i, (*encoded(t)[0], 0)) for i, t in texts_of(docs))
        at = 0
        for r in found:
            assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(r['ids'])}I", *r["ids"]))
            at += r["n_tokens"]
        known = [r["doc_id"] for r in found if r["doc_id"] is not None]
        assert known == sorted(known)
        one = repair.read_tokens(spark, folder, wanted=[8, 10])
        assert Counter((r["doc_id"], r["start"], tuple(r["ids"])) for r in one.collect()) == Counter((r["doc_id"], r["start"], tuple(r["ids"])) for r in found if r["doc_id"] in (8, 10))
        stored = spark.read.parquet(folder).agg(F.sum(F.octet_length("symbols") + F.octet_length("rules")), F.sum("n_tokens")).first()
        assert docs is odd or stored[0] < 4 * stored[1]


def test_blocks_that_start_with_equal_rows(spark):
    docs = spark.createDataFrame([(None, "one two", "en", "a")] * 9 + [(7, "same text", "en", "a")] * 9, SCHEMA)
    folder = scratch_path(spark, "files")
    repair.write_tokens(docs, folder, VOCABULARY, block_bytes=20)
    found = sorted(repair.read_tokens(spark, folder).collect(), key=lambda r: r["start"])
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in found) == Counter((i, (*encoded(t)[0], 0)) for i, t in texts_of(docs))
    assert [r["start"] for r in found] == [0, *np.cumsum([r["n_tokens"] for r in found])[:-1].tolist()]


def test_overlapping_pairs_and_document_ends():
    ids = np.array([1, 1, 1, 1, 1, 2, 1, 2, 1, 1], np.uint32)
    units = ids, np.arange(11, dtype=np.int64), np.arange(10), np.array([0, 5, 5, 10])
    grammar, symbols, starts, tokens = repair.compress(units, 9, 0, least=2, rounds=(2, 3))
    table, places = grammar.expansions()
    back = [np.concatenate([table[places[s] : places[s + 1]] for s in symbols[a:b]]).tolist() for a, b in zip(starts, starts[1:])]
    assert back == [[1, 1, 1, 1, 1, 0], [0], [2, 1, 2, 1, 1, 0]] and tokens.tolist() == [0, 6, 7, 13]


# 6 ------------------------------------------------------------------------------------------------
def test_rollups_follow_changes_once(spark, odd):
    root = scratch_path(spark, "rollups")
    side = rollups.counted(odd, "v1", rollups.blank_words(F.col("text")))
    nothing = F.when(F.lit(False), side)
    assert rollups.totals(spark, root).count() == 0
    inserts = odd.select(nothing.alias("old"), side.alias("new"))
    assert rollups.commit(root, "a", inserts) and not rollups.commit(root, "a", inserts)
    want = Counter()
    for _, text, lang, source in ROWS:
        want[source, lang, "v1"] += np.array([1, len(WORD.findall(text or ""))])
    assert rows(rollups.totals(spark, root), *rollups.KEYS, "n_docs", "n_tokens") == Counter((*k, *v.tolist()) for k, v in want.items())
    again = rollups.counted(odd, "v2", F.lit(None).cast("long"))
    rollups.commit(root, "b", odd.filter("lang = 'en'").select(side.alias("old"), again.alias("new")))
    rollups.commit(root, "c", odd.filter("lang <> 'en' or lang is null").select(side.alias("old"), nothing.alias("new")))
    rollups.commit(root, "d", odd.select(nothing.alias("old"), nothing.alias("new")))
    left = Counter(source for _, _, lang, source in ROWS if lang == "en")
    assert rows(rollups.totals(spark, root), *rollups.KEYS, "n_docs", "n_tokens") == Counter((s, "en", "v2", n, 0) for s, n in left.items())
    fresh = scratch_path(spark, "compact")
    rollups.compact(spark, root, fresh)
    assert rows(rollups.totals(spark, fresh), *rollups.KEYS, "n_docs") == rows(rollups.totals(spark, root), *rollups.KEYS, "n_docs")
    spark.createDataFrame([("a", "en", "v1", 9, 9)], rollups.DELTAS).write.parquet(f"{root}/batch=half")
    path, system = rollups._folder(spark, root, "batch=half/_SUCCESS")
    system.delete(path, False)
    assert "half" not in rollups.committed(spark, root)
    assert rollups.commit(root, "half", inserts.limit(0)) and "half" in rollups.committed(spark, root)


# 7 ------------------------------------------------------------------------------------------------
def test_classifier_is_accurate_on_documents_it_has_not_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    weights = quality_classifier.fit_classifier(docs, labels.filter(~held_out))
    found = quality_classifier.site_quality(docs, weights).join(labels.filter(held_out), "doc_id")
    right = found.agg(F.avg((F.col("kept").cast("int") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.97


def test_site_posteriors_equal_brute_force(odd, none):
    weights = np.linspace(-1, 1, 12)
    found = quality_classifier.site_quality(odd, weights, least=0.4).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(x[0] for x in ROWS)
    assert all(r["kept"] == (r["probability"] >= 0.4) and 0 < r["site"] < 1 for r in found)
    assert quality_classifier.site_quality(none, weights).count() == 0
    assert quality_classifier.good_documents(odd, weights).columns == odd.columns


def test_sparse_sites_shrink_to_their_host(spark):
    good, bad = PROSE, "### $$$ *** ### " * 40
    rows_ = [(k, good if k % 10 else bad, "en", "good") for k in range(400)] + [(1000 + k, bad if k % 10 else good, "en", "bad") for k in range(400)]
    rows_ += [(2000, good, "de", "bad"), (2001, good, "de", "good")]
    docs = spark.createDataFrame(rows_, SCHEMA)
    weights = quality_classifier.fit_classifier(docs, docs.select("doc_id", (F.col("text") == good).cast("int").alias("quality")))
    site = {r["doc_id"]: r["site"] for r in quality_classifier.site_quality(docs, weights).collect()}
    assert site[2001] > 0.8 and site[2000] < 0.2  # their own path has no other document


# 8 ------------------------------------------------------------------------------------------------
def copies(docs):
    groups = {}
    for k, (i, t) in enumerate(docs):
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t), []).append((-len(t), i is None, i or 0, k))
    found = {}
    for bare, members in groups.items():
        best = min(members)
        for m in members:
            found[m[3]] = (docs[best[3]][0], len(members), m[:3] == best[:3], hashlib.sha256(bare.encode()).hexdigest())
    return [(docs[k][0], *found[k]) for k in range(len(docs))]


@pytest.mark.parametrize("options", [{}, {"bits": 4, "least": 16, "most": 64, "block_bytes": 10_000}])
def test_exact_copies_equal_brute_force(odd, given, none, options):
    for docs in (odd, given):
        found = exact_dedup.exact_copies(docs, **options)
        want = copies(texts_of(docs))
        columns = ("doc_id", "keep_id", "group_size", "text_sha256")
        assert rows(found, *columns) == Counter((a, b, c, e) for a, b, c, _, e in want)
        kept = found.filter("kept")
        assert kept.count() == len({w[4] for w in want}) and kept.filter("not doc_id <=> keep_id").isEmpty()
    assert exact_dedup.exact_copies(none).count() == 0
    left = exact_dedup.without_copies(odd)
    assert left.columns == odd.columns and left.count() == len({w[4] for w in copies(texts_of(odd))})


def test_shared_identifiers_are_drawn_again(odd, monkeypatch):
    whole = exact_dedup.identifier
    seeds = []

    def weak(chunk, seed):
        return whole(chunk, seed) if seed > 1 else bytes(15) + whole(chunk, seed)[:1]

    run = exact_dedup.chunk_batches(0, 1 << 20, 16, 4, 16, 64)
    monkeypatch.setattr(exact_dedup, "identifier", weak)
    texts = pa.array([" ".join(f"{k}x{j}" for j in range(200)) for k in range(20)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(range(20)), texts], ["row", "doc_id", "text"])
    ids = next(iter(run(iter([batch]))))["id"].to_pylist()
    assert exact_dedup.CLASH in ids
    fine = exact_dedup.chunk_batches(2, 1 << 20, 16, 4, 16, 64)
    assert exact_dedup.CLASH not in next(iter(fine(iter([batch]))))["id"].to_pylist()
    assert not seeds


# 9 ------------------------------------------------------------------------------------------------
def without_lines(docs, span, long_line, passages=False):
    order = sorted({d for d in docs}, key=lambda d: (d[0] is not None, d[0] or 0))
    seen, gone = set(), {}
    for i, t in order:
        lines = [(k, x) for k, x in enumerate(t.split("\n")) if WORD.search(x)]
        out = set()
        for s in range(len(lines)):
            for n in range(1, span + 1) if passages else (span, 1):
                part = lines[s : s + n]
                if len(part) < n or (n < span and sum(len(WORD.findall(x)) for _, x in part) < long_line):
                    continue
                key = (n, tuple(x for _, x in part))
                if key in seen:
                    out |= {k for k, _ in part}
                seen.add(key)
        gone[i, t] = out
    return [(i, sum(1 for x in t.split("\n") if WORD.search(x)), len(gone[i, t]), "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i, t])) for i, t in docs]


def test_line_runs_equal_brute_force(spark, odd, given, none):
    block = ["alpha beta", "gamma", "delta epsilon", "zeta"]
    lines = [(k, "\n".join([f"own {k}", *block[k % 2 : 3 + k % 2], "", f"end {k % 3}"]), "en", "a") for k in range(40)]
    hot = spark.createDataFrame(lines, SCHEMA)
    for docs, span, long_line in ((odd, 3, 50), (odd, 2, 3), (given, 3, 50), (hot, 3, 50), (hot, 2, 2)):
        docs = docs.filter("doc_id is not null")  # the order of rows without ids is that of hashes
        found = line_dedup.without_repeated_lines(docs, span=span, long_line=long_line)
        assert rows(found, "doc_id", "n_lines", "n_removed", "kept_text") == Counter(without_lines(texts_of(docs), span, long_line))
        whole = line_dedup.without_repeated_lines(docs, span=span, long_line=long_line, passages=True)
        assert rows(whole, "doc_id", "n_lines", "n_removed", "kept_text") == Counter(without_lines(texts_of(docs), span, long_line, True))
    assert line_dedup.without_repeated_lines(odd).count() == len(ROWS)
    assert line_dedup.without_repeated_lines(none).count() == 0


def test_short_passages_of_many_words_go(spark):
    first, second = " ".join(f"a{k}" for k in range(4)), " ".join(f"b{k}" for k in range(47))
    texts = [f"{first}\n{second}\nown end", f"{first}\n{second}", f"own start\n\n{first}\n \n{second}", f"{first}\nb0 b1", f"x\n{second}"]
    docs = spark.createDataFrame([(k, t, "en", "a") for k, t in enumerate(texts)], SCHEMA)
    found = {r["doc_id"]: (r["n_removed"], r["kept_text"]) for r in line_dedup.without_repeated_lines(docs, passages=True).collect()}
    assert found == {0: (0, texts[0]), 1: (2, ""), 2: (2, "own start\n\n "), 3: (0, texts[3]), 4: (0, texts[4])}
    assert line_dedup.without_repeated_lines(docs).filter("n_removed > 0").isEmpty()
    spark.conf.set("spark.sql.ansi.enabled", "false")  # where the size of a missing array is -1
    try:
        lax = {r["doc_id"]: (r["n_removed"], r["kept_text"]) for r in line_dedup.without_repeated_lines(docs, passages=True).collect()}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert lax == found


# 10 -----------------------------------------------------------------------------------------------
def near(docs, size=5, threshold=0.8):
    sets = []
    for _, t in docs:
        w = WORD.findall(t)
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    links = [set() for _ in docs]
    for a, b in itertools.combinations(range(len(docs)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if both >= threshold * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                links[a].add(b)
                links[b].add(a)
    found = []
    for k in range(len(docs)):
        reach, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        ids = [docs[x][0] for x in reach if docs[x][0] is not None]
        found.append((docs[k][0], min(ids, default=None), len(links[k])))
    return Counter(found)


def families(spark):
    """Chains of edits of a few texts: many links, and classes that only chains connect."""
    rng = np.random.default_rng(5)
    made = []
    for f in range(4):
        words = [f"f{f}w{k}" for k in range(120)]
        for _ in range(60):
            words = list(words)
            words[int(rng.integers(len(words)))] = f"x{rng.integers(10**9)}"
            made.append(" ".join(words))
    made += [made[0]] * 30
    return spark.createDataFrame([(k, t, "en", "a") for k, t in enumerate(made)], SCHEMA).repartition(3)


@pytest.mark.parametrize("options", [{}, {"leaf": 8, "tile": 7, "depth": 3}, {"leaf": 8, "tile": 20, "depth": 0}])
def test_near_copies_equal_brute_force(spark, odd, given, none, options):
    for docs in (families(spark), *((odd, given) if not options else ())):
        assert rows(chosen_path.near_copies(docs, **options), "doc_id", "class_id", "n_links") == near(texts_of(docs))
    if not options:
        assert chosen_path.near_copies(none).count() == 0
        staying = chosen_path.one_of_each_class(odd)
        assert staying.columns == odd.columns
        assert {r["doc_id"] for r in staying.collect()} == {c for _, c, _ in near(texts_of(odd))}


def test_runs_follow_the_recall():
    assert [chosen_path.runs_for(r, 0.8, 8) for r in (0.5, 0.9, 0.9999)] == [1, 2, 7]
    assert chosen_path.runs_for(0.9, 0.8, 0) == 2  # a pair meets with 0.8 in a run that splits once


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 200)] + [(1000, k) for k in range(1001, 1300)] + [(5000, 5000)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(201)}, **{k: 1000 for k in range(1000, 1300)}, 5000: 5000}


# empty tables, and the pipeline -------------------------------------------------------------------
def test_empty_tables_give_empty_results(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.line_quality(none, quality_rules.fit_line_model(none, labels)).count() == 0
    assert quality_classifier.site_quality(none, quality_classifier.fit_classifier(none, labels)).count() == 0
    assert bpe.encode_decode(none, VOCABULARY).count() == 0
    assert mixing.mixture(none, mixing.fit_topics(none)).count() == 0
    folder = scratch_path(spark, "files")
    repair.write_tokens(none, folder, VOCABULARY)
    assert repair.read_tokens(spark, folder).count() == 0


def test_odd_rows_are_mixed_without_loss(odd):
    found = mixing.mixture(odd, mixing.fit_topics(odd))
    assert Counter(r["doc_id"] for r in found.collect()) == Counter(x[0] for x in ROWS)
    assert found.filter("n_tokens = 0 and kept").isEmpty()
    assert mixing.mixed(odd, mixing.fit_topics(odd)).columns == odd.columns


def test_decisions_hold_for_rows_that_share_an_id_or_have_none(spark):
    junk = "### $$$ *** " * 40
    known = spark.createDataFrame([(k, PROSE if k % 2 else junk, "en", f"s{k % 4}") for k in range(200)], SCHEMA)
    weights = quality_classifier.fit_classifier(known, known.select("doc_id", F.pmod("doc_id", F.lit(2)).alias("quality")))
    docs = known.unionByName(spark.createDataFrame([(i, t, "en", None) for i in (None, 1) for t in (PROSE + " x", junk + " x", PROSE + " x")], SCHEMA))
    good = quality_classifier.good_documents(docs, weights)
    assert rows(good, "doc_id", "text") == Counter((r["doc_id"], r["text"]) for r in docs.collect() if "###" not in r["text"])
    near_ = [(None, PROSE + f" end{k}", "en", "a") for k in range(4)] + [(5, LONG + f" end{k}", "en", "a") for k in range(4)] + [(6, LONG, "en", "a")]
    near_ += [(5, "another text", "en", "a")] * 3 + [(None, None, "en", "a"), (None, None, "en", "a"), (None, "alone", "en", "a")]
    single = chosen_path.one_of_each_class(spark.createDataFrame(near_, SCHEMA).repartition(3)).collect()
    kinds = Counter((r["doc_id"], r["text"] and ("prose" if r["text"].startswith(PROSE) else "long" if r["text"].startswith(LONG) else r["text"])) for r in single)
    assert kinds == {(None, "prose"): 1, (5, "long"): 1, (5, "another text"): 1, (None, None): 2, (None, "alone"): 1}
    many = [(i, f"{i} text number {k}", "en", "a") for i in (None, 1) for k in range(300)] + [(2, "equal text here", "en", "a")] * 200
    docs = spark.createDataFrame(many, SCHEMA).repartition(3)
    options = {"centres": np.zeros((1, 256)), "power": 1.0, "part": 0.5}
    drawn = rows(mixing.mixture(docs, **options).filter("kept"), "doc_id")
    assert all(0.35 * n < drawn[i,] < 0.65 * n for i, n in ((None, 300), (1, 300), (2, 200)))
    assert rows(mixing.mixed(docs, **options), "doc_id") == drawn


def test_pipeline_stages_keep_what_their_operators_say(spark, given):
    import corpus_pipeline as pipeline

    docs, names = given, given.columns
    stages = dict(pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, SF).cache()
    verdicts = quality_classifier.site_quality(docs, quality_classifier.fit_classifier(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in verdicts.filter("kept").collect()}
    single = stages["exact dedup"](spark, good, SF).cache()
    assert {r["doc_id"] for r in single.collect()} == {w[0] for w in copies(texts_of(good)) if w[3]}
    apart = stages["n-gram Jaccard join"](spark, single, SF).cache()
    assert {r["doc_id"] for r in apart.collect()} == {c for _, c, _ in near(texts_of(single))}
    mixed = stages["mixing"](spark, apart, SF).cache()
    assert good.columns == single.columns == apart.columns == mixed.columns == names
    assert rows(mixed, *names).keys() <= rows(apart, *names).keys() and mixed.count() > 0.5 * apart.count()
    last = stages["BPE"](spark, mixed, SF)
    assert rows(last, "doc_id", "n_tokens") == Counter((i, len(encoded(t)[0])) for i, t in texts_of(mixed))
