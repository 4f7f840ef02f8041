"""Manifest, mixing and phrases against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import sha256
from itertools import product

import pytest
from corpus import KINDS, LOWER, WORD, edge_documents, edge_rows, no_documents, prose
from pyspark.sql import functions as F

from marketlake.llm import merkle, mixing, phrases

SMALL = "/root/testdata/sf0.001"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    parts = []
    for value in (row[0], row[3], row[2], row[4], row[1]):
        text = None if value is None else str(value)
        parts.append("-" if text is None else f"{len(text.encode())}:{text}")
    return H(*parts)


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, rank):
    out = []
    for level in levels[:-1]:
        start = rank // 16 * 16
        out.append((level[start:rank], level[rank + 1:start + 16]))
        rank //= 16
    return out


def manifest_of(rows):
    """Rows (doc_id, text, lang, source, n_chars) to what the query returns."""
    sources = defaultdict(list)
    for row in rows:
        sources[row[3]].append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    order = sorted(sources, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for source in order:
        sources[source].sort(key=lambda x: x[:3])
        trees[source] = levels_of([x[2] for x in sources[source]])
    top = levels_of([trees[x][-1][0] for x in order])
    root, out = top[-1][0] if order else None, []
    for place, source in enumerate(order):
        for rank, (_, _, leaf, row) in enumerate(sources[source]):
            path = siblings(trees[source], rank) + siblings(top, place)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            now = leaf_of((row[0], row[1] and row[1].translate(LOWER), *row[2:])) if tampered else leaf
            for before, after in path:
                now = H(*before, now, *after)
            out.append((row[0], leaf, trees[source][-1][0], root, H(*(x for b, a in path for x in b + a)), now, now == root))
    return Counter(out)


def audit(docs):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.audited(docs, tampered, {"text": merkle.lowered(F.col("text"))})


def many_sources():
    pick = random.Random(5)
    rows = [(k, f"Text {k} Ä", "en" if k % 3 else None, "hot" if k % 2 else f"s{pick.randrange(40)}", k) for k in range(900)]
    return rows + [(k, None, None, None, None) for k in range(900, 917)] + [(7, "again", "en", "hot", 5)] * 20 + [(None, "x", "en", "hot", 1), (10_001, "", "en", "", 0)]


@pytest.mark.parametrize("rows", [many_sources, lambda: [r[:5] for r in edge_rows()], lambda: [(1, "one", None, "s", 3)]])
def test_manifest_is_that_of_plain_python(spark, checkpoints, rows):
    own = rows()
    docs = spark.createDataFrame(own, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    found = audit(docs.withColumn("leaf", F.lit("x")).withColumn("path", F.lit(1)))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(tuple(r) for r in found.collect()) == manifest_of(own)


def test_manifest_of_nothing(spark, checkpoints):
    assert audit(no_documents(spark)).collect() == []


def test_some_requests_get_the_paths_of_all(spark, checkpoints):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("group"), F.col("id").alias("key"),
        F.sha2(F.col("id").cast("string"), 256).alias("leaf"),
    )
    made = merkle.manifest(rows)
    asked = made.leaves.select("group", "rank", "key", "leaf")
    path = F.to_json("path").alias("path")
    every = {r.key: r.path for r in merkle.proofs(made, asked).select("key", path).collect()}
    some = {r.key: r.path for r in merkle.proofs(made, asked.filter("key in (0, 5, 6, 2999)")).select("key", path).collect()}
    assert len(every) == 3000 and some == {k: every[k] for k in (0, 5, 6, 2999)}
    record = made.records.first()
    assert record.digest == H(*record.children)


def cheapest(words, quotas, copies=3):
    """Most flow and its least cost for patterns A, B, AB by trying everything."""
    best = (0, 0)
    a, b, both = words
    for x, y, p, q in product(range(copies * a + 1), range(copies * b + 1), range(copies * both + 1), range(copies * both + 1)):
        if x + p <= quotas[0] and y + q <= quotas[1] and p + q <= copies * both:
            cost = sum(max(0, used - k * own) for used, own in ((x, a), (y, b), (p + q, both)) for k in range(1, copies))
            best = max(best, (x + y + p + q, -cost))
    return best


def test_flow_is_most_and_cheapest():
    pick = random.Random(3)
    for _ in range(60):
        words = [pick.randrange(3) for _ in range(3)]
        quotas = {"A": pick.randrange(9), "B": pick.randrange(9)}
        patterns = {("A",): words[0], ("B",): words[1], ("A", "B"): words[2]}
        flow = mixing.routed(patterns, quotas)
        for x in quotas:
            assert sum(own.get(x, 0) for own in flow.values()) <= quotas[x]
        used = [sum(flow[p].values()) for p in patterns]
        cost = sum(max(0, u - k * own) for u, own in zip(used, words) for k in (1, 2))
        assert all(u <= 3 * own for u, own in zip(used, words))
        assert (sum(used), -cost) == cheapest(words, list(quotas.values()))


def test_targets_stop_at_three_times_a_source():
    wanted = mixing.targets({"a": 10, "b": 1000, "c": 100, "d": 0}, {"a": 5, "b": 2, "c": 1, "d": 5})
    assert wanted["a"] == 30 and wanted["c"] == 300 and wanted["d"] == 0 and sum(wanted.values()) == 1110
    assert mixing.targets({"a": 100, "b": 100}, {"a": 1, "b": 3}) == {"a": Fraction(50), "b": Fraction(150)}


def test_mix_takes_the_targets(spark, checkpoints):
    pick = random.Random(8)
    rows = [(k, prose(k, pick.choice([0, 1, 5, 40, 400])) + " A\tb", None if k % 11 == 0 else f"s{min(pick.randrange(12), 4)}") for k in range(500)]
    rows += [(1000, "same text here", "s0")] * 300 + [(None, None, "s1"), (None, "x y", "s1"), (1001, prose(77, 20_000), "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("x"))

    def result(frame):
        found = mixing.mix(frame, F.array("source"), mixing.in_turn([5, 2, 1]), mixing.word_count(F.col("text"))).collect()
        return sorted(((r.doc_id, r.sources[0], r.size, r.taken, r.by_source[0].target) for r in found), key=str)

    found = result(docs)
    assert Counter((d, s, n) for d, s, n, _, _ in found) == Counter((d, s, len(WORD.findall(t or ""))) for d, t, s in rows)
    sizes, taken, target = Counter(), Counter(), {}
    for _, source, size, own, goal in found:
        assert 0 <= own <= 3 * size
        sizes[source] += size
        taken[source] += own
        target[source] = goal
    order = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    wanted = mixing.targets(sizes, {x: (5, 2, 1)[k % 3] for k, x in enumerate(order)})
    for source in sizes:
        assert target[source] == float(wanted[source]) and abs(taken[source] - wanted[source]) < 1
        whole = [own % size != 0 for _, s, size, own, _ in found if s == source and size]
        assert sum(whole) <= 1  # only the document on the border gives a part
    assert result(docs.repartition(7, "text")) == found


def test_mix_of_overlapping_sources(spark, checkpoints):
    rows = [(k, prose(k, 50), [["a"], ["b"], ["b", "a", "a"], ["c", None], [], None][k % 6]) for k in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tags array<string>")
    found = mixing.mix(docs, F.col("tags"), lambda names: [4 if x == "a" else 1 for x in names], mixing.word_count(F.col("text"))).collect()
    given = Counter()
    for row in found:
        tags = rows[row.doc_id][2]
        assert {x.source for x in row.by_source} == set(tags or []) and sum(x.words for x in row.by_source) == row.taken <= 3 * row.size
        for x in row.by_source:
            assert x.words >= 0
            given[x.source, x.target] += x.words
    assert len(found) == 240 and {s for s, _ in given} == {"a", "b", "c", None}
    for (_, target), words in given.items():
        assert abs(words - target) < 1


def test_mix_of_nothing_and_of_no_words(spark, checkpoints):
    size = mixing.word_count(F.col("text"))
    assert mixing.mix(no_documents(spark), F.array("source"), mixing.in_turn([1]), size).collect() == []
    empty = spark.createDataFrame([(1, None, "s"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.size, r.taken) for r in mixing.mix(empty, F.array("source"), mixing.in_turn([1]), size).collect()) == [(1, 0, 0), (2, 0, 0)]
    with pytest.raises(ValueError, match="patterns"):
        mixing.mix(edge_documents(spark).withColumn("source", F.col("doc_id").cast("string")), F.array("source"), mixing.in_turn([1]), size, most_patterns=3)


PIECES, PLAIN = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def collocations_of(rows, least, first, cover=80):
    """Rows (text, lang) to what the operator returns."""
    counts, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in PIECES.split((text or "").translate(LOWER)):
            own = PLAIN.findall(piece)
            n[lang] += len(own)
            for size in (1, 2, 3, 4):
                for i in range(len(own) - size + 1):
                    counts[lang, tuple(own[i:i + size])] += 1
    found = defaultdict(list)
    for (lang, words), a in counts.items():
        if len(words) < 2 or a < least:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        found[lang].append((words, a, l, r, score))
    out = []
    for lang, own in found.items():
        longer = [(w, a) for w, a, *_ in own if len(w) > 2]
        kept = [
            x for x in own
            if not any(len(w) > len(x[0]) and 100 * a >= cover * x[1] and any(w[i:i + len(x[0])] == x[0] for i in range(len(w))) for w, a in longer)
        ]
        kept.sort(key=lambda x: (-x[4], -x[1], " ".join(x[0]).encode()))
        out += [(lang, k + 1, " ".join(w), a, l, r, n[lang], score) for k, (w, a, l, r, score) in enumerate(kept[:first])]
    return sorted(out)


def chatter():
    pick = random.Random(4)
    rows = []
    for k in range(150):
        words = [pick.choices(["the", "of", f"w{pick.randrange(30)}", "Ünder", "the the", "a.b", "x\ty", "p,\nq", "san francisco bay area"], [9, 6, 9, 3, 2, 1, 1, 1, 1])[0] for _ in range(60)]
        rows.append((" ".join(words), ["en", "de", None, "und", ""][k % 5]))
    return rows + [(None, "en"), ("", None), (" \t.", "fr"), ("one", "fr"), ("z" * 3000 + " y", "en"), ("the the the the the the the the", "en")] + [("new york city hall, new york city", "en")] * 40


@pytest.mark.parametrize("budget", [8, 400, 1 << 21])
def test_collocations_are_those_of_plain_python(spark, checkpoints, monkeypatch, budget):
    rows = chatter()
    docs = spark.createDataFrame([(k, t, x, "f", "r") for k, (t, x) in enumerate(rows)], "doc_id long, text string, lang string, f string, word string").repartition(4)
    found = phrases.collocations(docs, least=5, first=50, budget=budget)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == collocations_of(rows, 5, 50)


def test_collocations_of_small_tables(spark, checkpoints, monkeypatch):
    monkeypatch.setattr(phrases, "_CHUNK_BYTES", 50)
    assert phrases.collocations(no_documents(spark)).collect() == []
    rows = [(r[1], r[2]) for r in edge_rows()]
    assert sorted(tuple(r) for r in phrases.collocations(edge_documents(spark), least=4).collect()) == collocations_of(rows, 4, 2000)


def test_a_frequent_word_is_dealt_over_many_groups():
    import numpy as np

    names = np.arange(1, 2001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    names = np.append(names, np.uint64(0))
    heavy = np.sort(names[:1])
    groups = phrases.Groups(np.zeros(8, dtype=np.int32), heavy, np.array([1], dtype=np.int32), np.array([16], dtype=np.int32))
    first = np.zeros(1999, dtype=np.int64)
    later = np.arange(1, 2000)
    place = groups.place([first, later, np.full(1999, 2000), np.full(1999, 2000)], names)
    assert set(place.tolist()) == set(range(1, 17)) and np.bincount(place).max() < 250
    assert (groups.place([later, first, first, first], names) == 0).all()
    again = groups.place([first, later, later, later], names)
    assert (again == place).all()  # the prefix ends at the first word that is not frequent
