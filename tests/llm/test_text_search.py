"""Substring deduplication, collocations and lexical search against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import collocations, lexical, substrings
from tallyframe.llm.collocations import mine_phrases
from tallyframe.llm.lexical import search
from tallyframe.llm.substrings import dedup_substrings, repeated_windows

DOC = "doc_id long, text string, lang string, row string, kept string, score string, _hash string, _id string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, "r", "k", "x", "y", "z") for i, t, g in rows], DOC)


def sentence(rng, size, vocabulary):
    return " ".join(f"w{min(rng.randrange(vocabulary), rng.randrange(vocabulary))}" for _ in range(size))


# Substring deduplication.

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def cut_by_force(rows, window):
    least = {}
    order = [(i if i is not None else math.inf, SPACES.findall(t or "")) for i, t, _ in rows]
    for i, words in order:
        for p in range(len(words) - window + 1):
            key = tuple(words[p:p + window])
            least[key] = min(least.get(key, math.inf), i)
    out = []
    for i, words in order:
        gone = set()
        for p in range(len(words) - window + 1):
            if least[tuple(words[p:p + window])] < i:
                gone.update(range(p, p + window))
        out.append((len(words), len(gone), " ".join(w for p, w in enumerate(words) if p not in gone)))
    return sorted(out)


def passages():
    rng = random.Random(5)
    shared = [sentence(rng, rng.choice([13, 14, 40]), 500) for _ in range(6)]
    rows = [(900, None, "en"), (901, "", None), (902, " \t\n", "en"), (903, "one", "en"),
            (904, sentence(rng, 12, 500), "en"), (905, "a " * 700, "en"), (906, "a " * 300, "en"),
            (None, shared[0], "en"), (None, shared[0], "en"), (3, shared[1], "en"), (3, shared[1], "en"),
            (907, "été   naïve\x0b" * 30, "fr"), (908, "été   naïve " * 20, "fr"),
            (909, "x\x00y\x1cz " * 20, "en"), (910, "x\x00y\x1cz\n" * 21, "en")]
    for i in range(60):
        parts = [sentence(rng, rng.randrange(30), 500) for _ in range(3)]
        rows.append((i, "  ".join([parts[0], rng.choice(shared), parts[1], rng.choice(shared), parts[2]]), "en"))
    return rows


def half_hot(monkeypatch, rows, window=13, minimiser=3):
    """Every other minimiser is hot."""
    held = [s for i, t, _ in rows for s in substrings.stretches(0, 0, (t or "").encode(), window)
            if len(s.words) >= window]
    found = np.unique(substrings.SuperKmers(held, window, minimiser).minimiser)
    monkeypatch.setattr(substrings, "_hot_minimisers", lambda *a: found[::2])


def test_identifiers_that_do_not_repeat(spark):
    rows = [row for i, row in enumerate(passages()) if row[0] is not None and row[0] > 3]
    assert len({i for i, _, _ in rows}) == len(rows)
    cut = dedup_substrings(table(spark, rows))
    assert sorted((r["n_words"], r["n_removed"], r["kept"]) for r in cut.collect()) == cut_by_force(rows, 13)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("parameters", [
    {}, {"window": 5, "minimiser": 2}, {"window": 13, "minimiser": 13}, {"bucket_bytes": 1 << 10}])
def test_repeated_passages_go(spark, monkeypatch, parameters, hot):
    rows = passages()
    if hot:
        half_hot(monkeypatch, rows, parameters.get("window", 13), parameters.get("minimiser", 3))
    cut = dedup_substrings(table(spark, rows), **parameters)
    found = sorted((r["n_words"], r["n_removed"], r["kept"]) for r in cut.collect())
    assert found == cut_by_force(rows, parameters.get("window", 13))
    assert cut.select("row.*").columns == [c.split()[0] for c in DOC.split(", ")]


def test_hot_windows_join_in_a_shuffle(spark, monkeypatch):
    rows = passages()
    half_hot(monkeypatch, rows)
    monkeypatch.setattr(substrings, "fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr("tallyframe.plans.joins.fits_broadcast", lambda *a: False)
    cut = dedup_substrings(table(spark, rows))
    assert sorted((r["n_words"], r["n_removed"], r["kept"]) for r in cut.collect()) == cut_by_force(rows, 13)


def test_a_third_of_the_rows_has_hot_minimisers(spark):
    rng = random.Random(1)
    shared = sentence(rng, 15, 500)
    rows = [(i, shared if i % 3 == 0 else sentence(rng, 15, 5000), "en") for i in range(900)]
    keyed = table(spark, rows).selectExpr("doc_id as _id", "xxhash64(text) as _hash", "cast(text as binary) as _text")
    hot = substrings._hot_minimisers(keyed, 70_000, 13, 3, 200, 5)
    own = substrings.SuperKmers(list(substrings.stretches(0, 0, shared.encode(), 13)), 13, 3).minimiser
    assert set(hot) == set(own)


def test_a_text_is_read_in_stretches(monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK", 50)
    text = " ".join(f"v{i}" for i in range(400)) + " " + "x" * 300 + " end"
    found = list(substrings.stretches(1, 2, text.encode(), 13))
    assert len(found) > 20
    starts = [s.base + p for s in found for p in range(len(s.words) - 12)]
    assert starts == list(range(402 - 12))
    for s in found:
        assert s.words == text.encode().split()[s.base:s.base + len(s.words)]


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(substrings, "run_hashes", lambda h, n: np.zeros(max(len(h) - n + 1, 0), np.uint64))
    ids = np.array([0, 1, 2, 0, 1, 3, 0, 1, 2])
    numbers = np.array([[1, 2, 3], [7, 8, 9], [0, 5, 10], [3, 3, 3]])
    assert repeated_windows(numbers, ids, np.arange(4, dtype=np.uint64), 3).T.tolist() == [[3, 9, 10, 13]]


def test_no_documents(spark):
    empty = table(spark, [])
    assert dedup_substrings(empty).collect() == []
    assert mine_phrases(empty).collect() == []
    assert search(empty, table(spark, [(1, "a", "en")]), item_id="doc_id").collect() == []
    assert search(table(spark, [(1, "a", "en")]), empty, item_id="doc_id").collect() == []


# Collocations.


def mined_by_force(rows, least, longest, first):
    counts, n = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for p in range(len(words) - k + 1):
                    counts[lang][tuple(words[p:p + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {q[i:j] for q, b in candidates.items() for i in range(len(q)) for j in range(i + 1, len(q) + 1)
                  if j - i < len(q) and f[q[i:j]] <= b}
        scored = []
        for p, a in candidates.items():
            if p not in inside:
                score, cut = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def prose():
    rng = random.Random(8)
    rows = [(1, None, "en"), (2, "", None), (3, "...", "en"), (4, "One, two", None), (5, "a " * 3000, "xx")]
    phrases = ["New York city", "of the", "École normale supérieure", "a\x00b c\x1cd", "in the end of the day"]
    for i in range(400):
        words = sentence(rng, rng.randrange(40), 30).split()
        for _ in range(rng.randrange(3)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(phrases))
        text = "".join(w + rng.choice([" ", "\t", "  ", ". ", "\n", ","] + [" "] * 8) for w in words)
        rows.append((i, text, rng.choice(["en", "fr", None, "und"])))
    return rows + [(9, "of the people by the people", "en")] * 40


@pytest.mark.parametrize("parameters", [
    {}, {"sampled": 8}, {"least": 3, "sampled": 8, "first": 7}, {"least": 2, "longest": 3, "bucket_bytes": 64}])
def test_phrases_are_all_counted(spark, parameters):
    rows = prose()
    given = {"least": 20, "longest": 5, "first": 2000} | parameters
    found = mine_phrases(table(spark, rows), **given).drop("cut").collect()
    assert sorted(map(tuple, found)) == mined_by_force(rows, given["least"], given["longest"], given["first"])
    assert found


def test_counts_join_in_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(collocations, "fits_broadcast", lambda *a: False)
    rows = prose()
    found = mine_phrases(table(spark, rows), least=5).drop("cut").collect()
    assert sorted(map(tuple, found)) == mined_by_force(rows, 5, 5, 2000)


def test_scores_beyond_64_bits(spark):
    row = spark.sql("select 9000000000000L a, 9900000000000L n, 9000000000000L l, 9500000000000L r")
    score = row.selectExpr(collocations._score("a", "n", "l", "r")).first()[0]
    assert score == 1000 * 9000000000000 * 9900000000000 // (9000000000000 * 9500000000000)


def test_infrequent_parts_are_abandoned():
    ids = np.array([[1, 2], [1, 2], [1, 3], [2, 0], [2, 0], [3, 1]])
    number = np.array([2, 1, 5, 1, 1, 2])
    found = {(tuple(ids[at, :size]), n) for at, size, n in collocations.frequent_phrases(ids, number, 0, 3)}
    assert found == {((1,), 8), ((1, 2), 3), ((1, 3), 5)}


# Lexical search.


def searched_by_force(docs, items, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def terms(text):
        return term.findall((text or "").translate(lower))

    read = [(i, Counter(terms(t))) for i, t, _ in docs]
    read = [(i, c) for i, c in read if c]
    total, size = len(read), sum(sum(c.values()) for _, c in read)
    having = Counter(t for _, c in read for t in c)
    out = []
    for item, text, _ in items:
        scored = []
        for i, counts in read:
            n = sum(counts.values())
            m = 100 - 75 + 75 * n * total // size
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * having[t] + 1)))
                        * (10**9 * counts[t] // (1000 * counts[t] + 8 * m)) for t in terms(text) if t in counts)
            if score > 0:
                scored.append((-score, math.inf if i is None else i))
        out += [(item, rank, None if i == math.inf else i, -score)
                for rank, (score, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("parameters", [{}, {"k": 1}, {"k": 500}, {"query_bytes": 100}])
def test_best_documents(spark, parameters):
    rng = random.Random(3)
    docs = [(1000, None, "e"), (1001, "", "e"), (1002, "!?", "e"), (None, "W1 w2", "e"), (None, "w1-w2", "e"),
            (1003, "Straße_naïve İ K W1", "e"), (1004, sentence(rng, 30_000, 90), "e")]
    docs += [(i, sentence(rng, rng.randrange(60), 90), "e") for i in range(700)]
    docs += [(7, "w80 w81", "e")] * 3  # ties, one identifier
    items = [(i, sentence(rng, rng.randrange(12), 90), "e") for i in range(25)]
    items += [(50, None, "e"), (51, "none of these", "e"), (52, "STRASSE straße İ", "e"), (53, "w80 w80 w81", "e"),
              (53, "w80 w80 w81", "e"), (None, "w3", "e")]
    best = search(table(spark, docs).repartition(3), table(spark, items), item_id="doc_id", **parameters)
    found = sorted(map(tuple, best.collect()), key=str)
    assert found == searched_by_force(docs, items, parameters.get("k", 10))


def test_blocks_are_skipped():
    docs = [(i, 5, [0, 1] if i % 50 == 0 else [1], [1, 1] if i % 50 == 0 else [1]) for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*docs, strict=True)], ["doc_id", "n", "terms", "tfs"])
    segment = lexical.Segment(batch, lexical.Corpus(1000, 5000, (3000, 1)))
    seen = []
    heap = []
    segment.ids = type("Seen", (list,), {"__getitem__": lambda s, i: seen.append(i) or list.__getitem__(s, i)})(segment.ids)
    segment.search(lexical.Query((0, 1), (1, 1)), 10, heap)
    # Equal scores: only documents of the short list are looked at, the first ten stay.
    assert sorted(name for _, name in heap) == [-i * 50 for i in reversed(range(10))]
    assert len(seen) == 20
