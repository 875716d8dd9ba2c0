"""Phrases, mixtures and ranked search against brute force and SQL, on small fixtures with odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import collocations, lexical, mixing
from millrace.llm.oracle import llm_oracles
from millrace.llm.queries import llm_queries
from tests.compare import duck, rows_of_frame, rows_of_sql

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    names, expected = rows_of_sql(duck(folder), llm_oracles()[name])
    got_names, got = rows_of_frame(llm_queries()[name](spark, folder))
    assert got_names == names
    assert sum(got.values()) > 0
    assert got == expected


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# phrases


def naive_phrases(rows, most_words=3, least=10, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, most_words + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    candidates = {key: a for key, a in counts.items() if len(key[1]) >= 2 and a >= least}
    hidden = set()
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                inner = lang, words[i : i + k]
                if 100 * a >= 50 * counts[inner]:
                    hidden.add(inner)
    out = []
    for lang in sorted(totals):
        found = []
        for (of, words), a in candidates.items():
            if of == lang and (of, words) not in hidden:
                cuts = [(10**6 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrase_rows(seed, n=150):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "Straße", "x'y", "\U0001f600", "the", "THE"]
    fixed = ["new york city", "as soon as", "The end of the"]
    rows = [("", "en"), (None, "en"), ("...!?", "de"), ("alone", None), ("a b " * 30, None), ("A\tB  c\r\nd\x0be f" * 12, "x")]
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(0, 40)):
            parts.append(rnd.choice(fixed) if rnd.random() < 0.2 else rnd.choice(words))
            parts.append(rnd.choice([" "] * 8 + ["  ", "\t", ". ", ",", "\n", "; "]))
        rows.append(("".join(parts), rnd.choice(["en"] * 4 + ["de", None])))
    return rows + [rows[-1]] * 15


@pytest.mark.parametrize("bits", [64, 9])
def test_phrases_are_those_of_plain_counts_whatever_collides(spark, bits):
    rows = phrase_rows(bits)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    found = collocations.collocations(docs, bits=bits, least=6, top=25, filter_bits=8 if bits == 9 else 26)
    assert sorted(map(tuple, found.collect())) == naive_phrases(rows, least=6, top=25)


def test_longer_phrases_and_slices_of_texts(spark, monkeypatch):
    rows = phrase_rows(5)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    found = collocations.collocations(docs, most_words=4, least=8)
    assert sorted(map(tuple, found.collect())) == naive_phrases(rows, 4, 8)


def test_cutting_a_text_keeps_its_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 50)
    rnd = random.Random(1)
    for _ in range(50):
        text = "".join(rnd.choice("ab .,\n") for _ in range(rnd.randint(0, 400))).encode()
        pieces = []
        for group in collocations._slices(iter([(text, 1)])):
            found = collocations.Fingerprints([t for t, _ in group], ["x"] * len(group))
            pieces += [found.phrase(i, 2) for i in found.places(2).tolist()]
        whole = collocations.Fingerprints([text], ["x"])
        assert pieces == [whole.phrase(i, 2) for i in whole.places(2).tolist()]


def test_fingerprints_depend_on_words_and_language_alone():
    a = collocations.Fingerprints([b"zero one two", b"One  two"], ["en", "en"])
    assert a.of(np.array([1]), 2) == a.of(np.array([3]), 2)
    assert a.of(np.array([1]), 2, check=True) == a.of(np.array([3]), 2, check=True)
    assert len({int(x) for k in (1, 2, 3) for x in a.of(a.places(k), k)}) == 3 + 2 + 1
    b = collocations.Fingerprints([b"one two"], ["de"])
    assert b.of(np.array([0]), 2) != a.of(np.array([1]), 2)


def test_phrases_of_nothing_and_with_other_columns(spark):
    columns = "lang string, rank int, phrase string, a long, l long, r long, n long, score long"
    empty = spark.createDataFrame([], DOCS)
    assert collocations.collocations(empty).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).collect() == []
    odd = spark.createDataFrame([("a b",) * 2 + ("x", 1, "p", 2)] * 12, "text string, lang string, row string, fingerprint int, phrase string, n int")
    found = collocations.collocations(odd)
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [tuple(c.replace("long", "bigint").split()) for c in columns.split(", ")]
    assert [tuple(r) for r in found.collect()] == [("a b", 1, "a b", 12, 12, 12, 24, 10**6)]


def test_scores_of_products_beyond_64_bits(spark):
    phrases = spark.createDataFrame(
        [("en", "a", 1, 4_000_000_000_000), ("en", "b", 1, 3_000_000_000_001), ("en", "a b", 2, 2_999_999_999_999)],
        "lang string, phrase string, k int, a long",
    )
    words = spark.createDataFrame([("en", 9_000_000_000_000)], "lang string, n long")
    row = collocations._ranked(phrases, words, 10, 5, 50).first()
    assert row["score"] == 10**6 * 2_999_999_999_999**2 // (4_000_000_000_000 * 3_000_000_000_001)


# mixtures


def naive_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    whole, full = sum(sizes.values()), set()
    while True:
        left = whole - sum(most * sizes[s] for s in full)
        heavy = sum(weight[s] for s in order if s not in full)
        share = {s: left * weight[s] / heavy if s not in full else most * sizes[s] for s in order} if heavy else {s: most * sizes[s] for s in order}
        above = {s for s in order if s not in full and share[s] > most * sizes[s]}
        if not above:
            return share
        full |= above


def test_mixture_meets_targets(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join("w" * rnd.randint(1, 3) for _ in range(int(rnd.paretovariate(1)) % 400)), rnd.choice("aaaaaabbcdÉ")) for i in range(3000)]
    rows += [(None, "one two three", None), (None, None, None), (7, "", "z"), (8, "same text", "e")] + [(9, "again and again", "e")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix_sources(docs).collect()
    assert len(found) == len(rows)
    size = Counter()
    for _, text, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    targets = naive_targets(dict(size))
    taken, longest = Counter(), Counter()
    for r in found:
        assert r["source_size"] == size[r["source"]]
        assert math.isclose(r["target"], targets[r["source"]], rel_tol=1e-12)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        # the expected number, rounded up or down
        assert abs(r["copies"] - r["target"] / max(r["source_size"], 1)) < 1 or r["source_size"] == 0
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for source in size:
        assert abs(taken[source] - targets[source]) <= 2 * longest[source]
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    other = mixing.mix_sources(docs, seed=1).collect()
    assert sorted(map(str, found)) != sorted(map(str, other))


def test_targets_reshare_in_turns(spark):
    sizes = {f"s{i:02}": n for i, n in enumerate([1, 1, 1, 2, 3, 5, 8, 13, 1000, 0, 40])} | {None: 7}
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    assert found == pytest.approx(naive_targets(sizes))
    assert sum(found.values()) == pytest.approx(sum(sizes.values()))


def test_mixture_of_nothing_and_with_other_columns(spark):
    assert mixing.mix_sources(spark.createDataFrame([], DOCS)).collect() == []
    wordless = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in mixing.mix_sources(wordless).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    odd = spark.createDataFrame([(1, "a b", "s", 5, 6, 7, 8)], "doc_id long, text string, source string, size int, target int, copies int, `part` int")
    assert mixing.mix_sources(odd).select("doc_id", "size", "source_size", "target", "taken").collect()[0][:4] == (1, 2, 2, 2.0)


def test_a_source_with_most_rows_is_spread(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("one").alias("source"))
    placed = mixing._placed(docs.select("source", "doc_id"), "source", ["doc_id"])
    assert placed.where("place = doc_id + 1").count() == 20_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions are put together else
    try:
        per_task = mixing._placed(docs.select("source"), "source", []).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in per_task) < 10_000


# ranked search


def naive_ranks(docs, items, k=10):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))

    held = [(i, doc, Counter(terms(text))) for i, (doc, text) in enumerate(docs)]
    held = [(i, doc, c, sum(c.values())) for i, doc, c in held if c]
    documents, words = len(held), sum(n for *_, n in held)
    df = Counter(t for _, _, c, _ in held for t in c)
    out = []
    for item_id, text in items:
        found = []
        for i, doc, c, n in held:
            m = 100 - 90 + (90 * n * documents) // words
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms(text))
                if t in c
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item_id, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def search_rows(seed):
    rnd = random.Random(seed)
    words = [f"w{int(rnd.paretovariate(0.6)) % 300}" for _ in range(500)] + ["Été", "ÀB", "straße", "日本"]

    def text(n):
        return "".join(rnd.choice(words) + rnd.choice([" ", ", ", "\n", "--"]) for _ in range(n))

    docs = [(i, text(int(rnd.paretovariate(0.5)) % 300)) for i in range(400)]
    docs += [(1000 + i, "one and the same W1 w2 text") for i in range(30)] + [(None, "w1 w2"), (None, "w1 w2"), (5, None), (6, ""), (7, "?!"), (7, "w7 w8")]
    items = [(i, text(rnd.randint(1, 25))) for i in range(25)] + [(90, None), (91, ""), (92, "..."), (93, "unheardof"), (94, "same text"), (94, "same text"), (None, "w1")]
    items += [(95, docs[3][1]), (96, "w1 W1 w1 w2")]
    return docs, items


@pytest.mark.parametrize("head, bucket, blocks", [(4096, 4096, 2_000_000), (1, 16, 2_000_000), (20, 64, 500)])
def test_ranks_are_those_of_scoring_every_document(spark, head, bucket, blocks):
    docs, items = search_rows(bucket)
    found = lexical.ranked_search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(6),
        spark.createDataFrame(items, "item_id long, text string"),
        head=head, bucket=bucket, block_letters=blocks,
    )
    assert sorted(map(tuple, found.collect()), key=str) == naive_ranks(docs, items)


def test_long_texts_are_cut_between_terms(monkeypatch):
    whole = ("Word-one tWo\n" * 40 + "x" * 60 + " end").encode()
    expected = [t for part in lexical.terms_of(whole) for t in part]
    monkeypatch.setattr(lexical, "SLICE", 17)
    assert [t for part in lexical.terms_of(whole) for t in part] == expected
    assert expected[:3] == [b"word", b"one", b"two"]


def test_pruning_leaves_out_most_of_the_work(monkeypatch):
    seen = []
    original = lexical._Best.add
    monkeypatch.setattr(lexical._Best, "add", lambda self, scores, ids, nulls: (seen.append(len(scores)), original(self, scores, ids, nulls))[1])
    docs = np.array([[1, 0, 0]] * 5 + [[1, 1, 0]] * 20 + [[0, 0, 1]] * 3000)
    lengths = docs.sum(axis=1)
    held = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(np.nonzero(docs)[1], pa.int32()))
    impacts = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(np.full(lengths.sum(), 1000), pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(docs))), pa.array(1000 * np.sqrt(lengths)), held, impacts], ["doc_id", "norm", "terms", "impacts"])
    queries = lexical._Queries([(0, np.arange(3))], np.array([9000, 8000, 10])).with_bounds({0: 17_000_000})
    best = [lexical._Best(10, low) for low in queries.bounds]
    lexical._search_bucket(batch, queries, best)
    # only the documents with both words are scored, the first 10 of them stay
    assert seen == [20] and best[0].ids.tolist() == list(range(5, 15))


def test_search_of_nothing_and_with_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.ranked_search(empty, items).collect() == []
    assert lexical.ranked_search(spark.createDataFrame([(1, "a")], "doc_id long, text string"), items.limit(0)).collect() == []
    odd = spark.createDataFrame([(1, "a b", 3, "x", 2.0)], "doc_id long, text string, n int, terms string, norm double")
    other = spark.createDataFrame([(4, "a", 9, "q")], "item_id long, text string, `at` int, item string")
    assert [tuple(r)[:3] for r in lexical.ranked_search(odd, other).collect()] == [(4, 1, 1)]
