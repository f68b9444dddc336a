"""Stages keep every column, members are taken once, and site posteriors equal the formula written out."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import chosen_path, exact_dedup, mixing, quality_classifier

PROSE = " ".join(f"word{k % 61} and{k % 17} the{k}" for k in range(60))
HELPERS = ("row", "_id", "_none", "_key", "_source", "_lang", "_host", "_path", "_nth", "nth", "_all", "_kept", "_length", "_sha", "label", "node", "a.b")


def test_stages_keep_columns_named_like_their_helpers(spark):
    texts = [(1, PROSE), (2, PROSE), (3, PROSE + " tail"), (None, "no id"), (None, None), (4, "x y z")]
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in texts], "doc_id long, text string, lang string, source string")
    docs = docs.withColumns({c: F.concat(F.lit(c), F.coalesce("text", F.lit("-"))) for c in HELPERS})
    weights = np.array([4.0] + [0.0] * 11)
    stages = {
        "good": quality_classifier.good_documents(docs, weights), "exact": exact_dedup.without_copies(docs), "near": chosen_path.one_of_each_class(docs),
        "mixed": mixing.mixed(docs, mixing.fit_topics(docs), part=1.0, power=1.0),
    }
    for name, found in stages.items():
        assert found.columns == docs.columns, name
        assert Counter(map(tuple, found.collect())) <= Counter(map(tuple, docs.collect())), name
    assert stages["good"].count() == 6 and stages["exact"].count() == 5 and stages["near"].count() == 4


def test_rows_that_agree_in_id_and_text_are_one_member(spark, monkeypatch):
    sizes = []
    tiles = chosen_path.set_batches

    def counted(size, block_bytes):
        def run(batches):
            for batch in tiles(size, block_bytes)(batches):
                with open(path, "a") as file:
                    file.write(f"{batch.num_rows}\n")
                yield batch

        return run

    path = "/tmp/ebbtide-members-" + str(np.random.default_rng().integers(1 << 40))
    monkeypatch.setattr(chosen_path, "set_batches", counted)
    docs = spark.createDataFrame([(None, PROSE)] * 600 + [(7, PROSE + " tail")], "doc_id long, text string").repartition(3)
    found = Counter(map(tuple, chosen_path.near_copies(docs).collect()))
    assert found == {(None, 7, 600): 600, (7, 7, 600): 1}
    with open(path) as file:
        sizes = [int(x) for x in file]
    assert sum(sizes) <= 4  # one for each task that meets rows of a member


def test_a_recall_that_signatures_cannot_reach_is_refused(spark):
    docs = spark.createDataFrame([(1, PROSE), (2, PROSE + " tail")], "doc_id long, text string")
    with pytest.raises(ValueError, match="cannot reach recall"):
        chosen_path.near_copies(docs, threshold=0.5).count()
    assert chosen_path.near_copies(docs, threshold=0.5, recall=0.95).filter("n_links = 1").count() == 2
    assert 0 < chosen_path.sketch_misses(0.8, 0.2, 64) < 1e-4


def test_recall_of_near_copies_of_many_similarities(spark):
    """Pairs of documents whose shingle sets agree in 0.5 to 1; every pair at the threshold or above is one at brute force."""
    rng = np.random.default_rng(5)
    rows, pairs = [], []
    for k in range(150):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 120)]
        other = list(words)
        for at in rng.choice(120, rng.integers(1, 9), replace=False):
            other[at] = f"v{rng.integers(10**6)}"
        sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (words, other)]
        pairs.append(len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold, recall, least in ((0.8, 0.9999, 1.0), (0.5, 0.95, 0.9)):
        found = {r["doc_id"] for r in chosen_path.near_copies(docs, threshold=threshold, recall=recall).filter("n_links > 0").collect()}
        wanted = {2 * k for k, x in enumerate(pairs) if x >= threshold}
        assert {x for x in found if x % 2 == 0} <= wanted
        assert len(found & wanted) >= least * len(wanted) > 10


def test_site_posteriors_equal_the_formula(spark):
    texts = [(k, PROSE + f" {k}" if k % 3 else "### $$$ !!! " * (5 + k % 7), f"l{k % 4}", f"s{k % 5 if k % 11 else None}") for k in range(90)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string")
    weights = quality_classifier.fit_classifier(docs, docs.select("doc_id", (F.col("doc_id") % 3 > 0).cast("int").alias("quality")))
    weights = weights * 0.2  # evidence that is not all or nothing
    found = {r["doc_id"]: r for r in quality_classifier.site_quality(docs, weights).collect()}
    own = {i: found[i]["evidence"] for i, *_ in texts}
    site = {i: (s, path) for i, _, path, s in texts}
    groups, hosts = defaultdict(list), defaultdict(list)
    for i, (host, path) in site.items():
        groups[host, path].append(own[i])
        hosts[host].append(own[i])
    prior = sum(own.values()) / len(own)

    def strength(pairs):  # (members, parent's mean)
        n = sum(len(m) for m, _ in pairs)
        apart = sum(len(m) * (sum(m) / len(m) - p) ** 2 for m, p in pairs)
        between = (apart - sum(p * (1 - p) for _, p in pairs)) / (n - sum(len(m) ** 2 for m, _ in pairs) / n)
        chance = sum(len(m) * p * (1 - p) for m, p in pairs) / n
        return min(max(chance / between - 1, 1.0), 1e6) if between > 0 else 1e6

    k_host = strength([(m, prior) for m in hosts.values()])
    k_path = strength([(m, (sum(hosts[h]) + k_host * prior) / (len(hosts[h]) + k_host)) for (h, _), m in groups.items()])
    for i, (host, path) in site.items():
        mean = (sum(hosts[host]) - own[i] + k_host * prior) / (len(hosts[host]) - 1 + k_host)
        post = (sum(groups[host, path]) - own[i] + k_path * mean) / (len(groups[host, path]) - 1 + k_path)
        odds = math.log(own[i] / (1 - own[i])) + math.log(post / (1 - post)) - math.log(prior / (1 - prior))
        assert math.isclose(found[i]["site"], post, rel_tol=1e-6)
        assert math.isclose(found[i]["probability"], 1 / (1 + math.exp(-odds)), rel_tol=1e-6)
        assert found[i]["kept"] == (found[i]["probability"] >= 0.5)
