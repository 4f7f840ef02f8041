import random

import numpy as np
import pytest
from corpus import KINDS, edge_documents, edge_rows, edited, near_groups, no_documents, prose, shingles, words
from pyspark.sql import functions as F

from marketlake.llm import chaining, components, fingerprints, pca_tiles, setsketch
from marketlake.llm import words as hashing

SMALL = "/root/testdata/sf0.001"


def documents(spark, texts):
    return spark.createDataFrame([(d, t) for d, t in texts.items()], "doc_id long, text string")


def test_words_and_shingles_are_those_of_the_definition():
    for text in ["", " a\tb ", "A b  c\nD e f", "É é \x0b x\x1cy", "w" * 200 + " " + "w" * 199, *[r[1] or "" for r in edge_rows()]]:
        own = words(text)
        hashed = hashing.word_hashes(text.encode())
        assert len(hashed) == len(own)
        assert len(set(hashed.tolist())) == len(set(own))
        assert len(hashing.shingle_set(text)) == len(shingles(text))


def test_sketches_merge_and_estimate():
    pick = np.random.default_rng(3)
    pool = hashing.mixed(pick.integers(0, 2**63, 3000).astype(np.uint64))
    first, second = pool[:2000], pool[1000:]
    a, b = setsketch.registers(first), setsketch.registers(second)
    assert np.array_equal(setsketch.merged(a, b), setsketch.registers(np.union1d(first, second)))
    estimate = setsketch.joint_estimate(
        np.array([(a > b).sum()]), np.array([(a < b).sum()]), np.array([2000.0]), np.array([2000.0])
    )[0]
    assert abs(estimate - 1 / 3) < 0.15
    same = setsketch.joint_estimate(np.array([0]), np.array([0]), np.array([50.0]), np.array([50.0]))[0]
    assert same > 0.99


def test_components_of_chains_stars_and_loops(spark, checkpoints):
    edges = [(i, i + 1) for i in range(1, 60)] + [(200, x) for x in range(201, 230)] + [(300, 300), (None, 5), (7, 3), (7, 3)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, **{i: 200 for i in range(200, 230)}}


def test_near_duplicates_match_all_pairs(spark, checkpoints, monkeypatch):
    texts = {}
    for group in range(6):  # groups of near copies whose members are not all alike
        base = prose(100 + group, 80)
        for k in range(30):
            texts[group * 100 + k] = edited(base, group * 1000 + k, k % 7)
    texts |= {1000 + k: prose(5000 + k, 40) for k in range(60)}
    texts |= {2000: "a b c", 2001: "A B C", 2002: "a b c d", 2003: "", 2004: " "}
    monkeypatch.setattr(setsketch, "TILE_NODES", 16)  # several tiles for a group
    sets, expected = near_groups(texts)
    found = setsketch.near_duplicates(documents(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (r.component_id == r.doc_id) for r in found)
    assert len(set(expected.values())) < len(texts) - 60  # the texts do hold near copies


def test_near_duplicates_of_the_given_documents(spark, checkpoints):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    _, expected = near_groups({r.doc_id: r.text for r in docs.collect()})
    assert {r.doc_id: r.component_id for r in setsketch.near_duplicates(docs).collect()} == expected


def test_near_duplicates_in_defined_cases(spark, checkpoints):
    found = setsketch.near_duplicates(edge_documents(spark)).collect()
    assert len(found) == len(edge_rows())
    group = {r.doc_id: r.component_id for r in found if r.doc_id is not None}
    assert group[1] == group[2] == group[3] == 1 and group[4] == 4
    assert [group[x] for x in (5, 6, 7, 8, 9, 10, 17, 18)] == [5, 6, 7, 8, 8, 10, 17, 17]
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)] * 2
    assert sorted(r.kept for r in found if r.doc_id == 12) == [True, True]
    assert setsketch.near_duplicates(no_documents(spark)).collect() == []
    docs = edge_documents(spark)
    kept = setsketch.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect() if r.doc_id is not None))
    assert ids == [1, 4, 5, 6, 7, 8, 10, 11, 12, 13, 14, 15, 16, 17] + ([19] if group[19] == 19 else [])
    assert setsketch.without_near_duplicates(no_documents(spark)).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links string, node string, x string")


def expected_links(rows, threshold=0.98):
    good = [
        (i, np.array(v, dtype=np.float32).astype(float), label) for i, v, label, *_ in rows
        if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    links = []
    for k, (i, v, label) in enumerate(good):
        for j, w, other in good[:k]:
            if label == other and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= threshold:
                links.append((j, i))
    return links


def test_near_vectors_match_all_pairs(spark, checkpoints):
    pick = np.random.default_rng(8)
    centres = pick.normal(size=(40, 24))
    rows = []
    for k in range(600):
        vector = centres[pick.integers(40)] + pick.normal(size=24) * pick.choice([0, 0.05, 0.15, 0.5])
        rows.append((k, [float(x) for x in vector], int(pick.choice([1, 1, 1, 2, 3])), "", "", ""))
    links = expected_links(rows)
    assert len(links) > 500
    group = __import__("corpus").groups([r[0] for r in rows], links)
    for tile in (1024, 20):
        found = pca_tiles.near_vectors(vectors(spark, rows), tile_rows=tile).collect()
        assert {r.vec_id: r.component_id for r in found} == group
        assert {r.vec_id: r.n_links for r in found} == {r[0]: sum(r[0] in x for x in links) for r in rows}


def test_near_vectors_in_defined_cases(spark, checkpoints):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None),
        (6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1), (9, [nan, 1.0], 1), (10, [inf, 0.0], 1), (11, [1.0, None], 1),
        (12, [1.0, 0.0, 0.0], 1), (13, [1e-30, -0.0], 1), (None, [1.0, 0.0], 1), (14, [3e38, 0.0], 1),
    ]
    found = pca_tiles.near_vectors(vectors(spark, [(*r, "", "", "") for r in rows])).collect()
    assert len(found) == len(rows)
    group = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    assert group[1] == (5, 1, True) and group[2] == (5, 1, False) and group[3] == (5, 1, False)
    assert group[13] == (5, 1, False) and group[14] == (5, 1, False)
    assert all(group[x] == (0, x, True) for x in (4, 5, 6, 7, 8, 9, 10, 11, 12))
    assert group[None] == (0, None, True)
    assert pca_tiles.near_vectors(vectors(spark, [])).collect() == []


def test_close_pairs_lose_nothing():
    pick = np.random.default_rng(1)
    left = pick.normal(size=(60, 40))
    right = np.concatenate([left[:20] + pick.normal(size=(20, 40)) * 0.1, pick.normal(size=(30, 40))])
    left /= np.linalg.norm(left, axis=1)[:, None]
    right /= np.linalg.norm(right, axis=1)[:, None]
    for threshold in (0.2, 0.9, 0.98):
        wanted = set(zip(*np.nonzero(left @ right.T >= threshold)))
        assert wanted <= set(zip(*pca_tiles.close_pairs(left, right, threshold)))


def best_chain_score(places, others):
    """The best chain's score by comparing all pairs."""
    order = sorted(range(len(places)), key=lambda k: (places[k], others[k]))
    score = {}
    for k in order:
        score[k] = chaining.SEED_WORDS + max([0.0, *(
            score[p] - chaining.GAP_COST * (places[k] - places[p] + others[k] - others[p])
            for p in score if places[p] < places[k] and others[p] < others[k]
        )])
    return max(score.values())


def chain_score(chain, places, others):
    out = chaining.SEED_WORDS * len(chain)
    for a, b in zip(chain, chain[1:]):
        assert places[a] < places[b] and others[a] < others[b]
        out -= chaining.GAP_COST * (places[b] - places[a] + others[b] - others[a])
    return out


@pytest.mark.parametrize("seed", range(20))
def test_chains_are_best_and_collinear(seed):
    pick = random.Random(seed)
    places = np.array(sorted(pick.randrange(200) for _ in range(60)))
    others = np.array([p + pick.choice([0, 0, 0, 1, 30, -20]) + 50 for p in places.tolist()])
    found = chaining.chains(places, others)
    scores = [chain_score(c, places, others) for c in found]
    assert abs(max(scores) - best_chain_score(places.tolist(), others.tolist())) < 1e-6
    used = [k for c in found for k in c]
    assert len(used) == len(set(used))


def test_eight_equal_words_share_a_seed_and_seeds_of_a_passage_are_chained():
    for k in range(200):
        pick = np.random.default_rng(k)
        shared = pick.integers(0, 2**63, 8).astype(np.uint64)
        grams = []
        for _ in range(2):
            own = np.concatenate([pick.integers(0, 2**63, 20).astype(np.uint64), shared, pick.integers(0, 2**63, 20).astype(np.uint64)])
            grams.append(set(hashing.gram_hashes(own, chaining.SEED_WORDS)[chaining.seeds(own)].tolist()))
        assert grams[0] & grams[1]
    for apart in (32, 45, 60):
        assert chaining.chains(np.array([10, 10 + apart]), np.array([70, 70 + apart])) == [[0, 1]]


def test_exact_and_fuzzy_passages_are_found(spark, checkpoints):
    passage, texts, expected = prose(1, 70, 10**6), {}, {}
    for k in range(40):
        copy = edited(passage, k, k % 5)
        before = prose(100 + k, 30 + k, 10**6)
        texts[k] = f"{before} {copy} {prose(500 + k, 60, 10**6)}"
        expected[k] = (30 + k, 100 + k)
    texts |= {100 + k: prose(9000 + k, 200, 10**6) for k in range(30)}
    found = chaining.passages(documents(spark, texts)).collect()
    assert {r.doc_id for r in found} == set(range(1, 40))
    for row in found:
        start, end = expected[row.doc_id]
        assert start <= row.start_word + 6 and row.end_word <= end + 6 and row.n_words >= 50 and row.identity >= 0.75
    left = chaining.without_passages(documents(spark, texts), chaining.passages(documents(spark, texts)))
    sizes = {r.doc_id: len(words(r.text)) for r in left.collect()}
    assert sizes[0] == len(words(texts[0])) and all(sizes[100 + k] == 200 for k in range(30))
    assert all(sizes[k] <= len(words(texts[k])) - 50 for k in range(1, 40))


def test_all_passages_of_a_chain_are_found(spark, checkpoints):
    first, second, texts, expected = prose(1, 60, 10**6), prose(2, 60, 10**6), {}, {}
    texts[0] = f"{prose(3, 30, 10**6)} {first} {prose(4, 40, 10**6)} {second} {prose(5, 30, 10**6)}"
    for k, apart in enumerate((20, 40, 70, 100, 150, 200), 1):
        texts[k] = f"{prose(10 * k, 30, 10**6)} {first} {prose(10 * k + 1, apart, 10**6)} {second} {prose(10 * k + 2, 30, 10**6)}"
        expected[k] = {(30, 90, 30, 90), (90 + apart, 150 + apart, 130, 190)}
    found = chaining.passages(documents(spark, texts)).collect()
    for k, spans in expected.items():
        assert {(r.start_word, r.end_word, r.first_start, r.first_end) for r in found if r.doc_id == k and r.first_id == 0} == spans


def test_passages_whose_parts_other_documents_hold_are_found(spark, checkpoints):
    texts, expected = {}, set()
    for k in range(12):  # every run of seven words of a passage is in a document before, each in another
        own = prose(k, 60, 10**6).split()
        for i in range(54):
            texts[1000 * k + i] = f"{prose(100 * k + i, 30, 10**6)} {' '.join(own[i:i + 7])} {prose(7000 + 100 * k + i, 30, 10**6)}"
        for i in (100, 200):
            texts[1000 * k + i] = f"{prose(9000 + 1000 * k + i, 40, 10**6)} {' '.join(own)} {prose(30000 + 1000 * k + i, 40, 10**6)}"
        expected.add((1000 * k + 200, 1000 * k + 100, 40, 100))
    assert expected == {(r.doc_id, r.first_id, r.start_word, r.end_word) for r in chaining.passages(documents(spark, texts)).collect()}


@pytest.mark.parametrize("parts", [(45, 5, 10), (45, 4, 9), (10, 5, 45), (20, 2, 2, 2, 2, 2, 25), (40, 20, 40)])
def test_the_longest_stretch_counts(spark, checkpoints, parts):
    own = prose(1, sum(parts), 10**6).split()
    other, place = list(own), 0
    for k, size in enumerate(parts):  # every second part is changed
        if k % 2:
            other[place:place + size] = prose(50 + k, size, 10**6).split()
        place += size
    texts = {k: f"{prose(10 + k, 30, 10**6)} {' '.join(x)} {prose(20 + k, 30, 10**6)}" for k, x in enumerate((own, other))}
    row, = chaining.passages(documents(spark, texts)).collect()
    assert (row.doc_id, row.first_id, row.start_word, row.end_word) == (1, 0, 30, 30 + sum(parts))
    assert abs(row.identity - sum(parts[::2]) / sum(parts)) < 1e-9


def test_every_exact_passage_of_the_given_documents(spark, checkpoints):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen, expected = {}, set()
    for row in sorted(docs.collect(), key=lambda r: r.doc_id):
        own = words(row.text)
        runs = {tuple(own[i:i + 50]) for i in range(len(own) - 49)}
        if any(x in seen for x in runs):
            expected.add(row.doc_id)
        for x in runs:
            seen.setdefault(x, row.doc_id)
    assert expected and expected <= {r.doc_id for r in chaining.passages(docs).collect()}


def test_passages_in_defined_cases(spark, checkpoints):
    docs = edge_documents(spark)
    found = chaining.passages(docs).collect()
    assert {r.doc_id for r in found} >= {2, 3, 13} and None not in {r.doc_id for r in found}
    assert {r.doc_id for r in found}.isdisjoint({1, 5, 6, 7, 8, 9, 10, 11, 12, 14, 15, 16})
    left = chaining.without_passages(docs, chaining.passages(docs))
    assert left.columns == docs.columns
    rows = left.collect()
    assert {r.doc_id for r in rows} >= {1, 4, 5, 6, 7, 12, None} and 2 not in {r.doc_id for r in rows}
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    assert chaining.passages(no_documents(spark)).collect() == []
    assert chaining.without_passages(no_documents(spark), chaining.passages(no_documents(spark))).count() == 0


def test_a_long_text_has_the_seeds_of_its_blocks():
    own = hashing.word_hashes(prose(4, 5000).encode())
    grams = hashing.gram_hashes(own, chaining.SEED_WORDS)
    at = set(chaining.seeds(own).tolist())
    assert all(any(k in at for k in range(i, i + chaining.WINDOW)) for i in range(len(grams) - chaining.WINDOW + 1))


def generalised_jaccard(first, second):
    from collections import Counter

    def terms(text):
        own = words(text)
        size = min(3, len(own))
        return Counter(tuple(own[i:i + size]) for i in range(len(own) - size + 1)) if own else Counter()

    a, b = terms(first), terms(second)
    every = a.keys() | b.keys()
    return sum(min(a[x], b[x]) for x in every) / max(1, sum(max(a[x], b[x]) for x in every))


def test_collision_rate_is_generalised_jaccard():
    errors = []
    for k in range(150):
        first = " ".join([prose(k, 40, 12)] * (1 + k % 3)) + " " + prose(k + 900, 30)
        second = edited(first, k, (k % 10) * 4) + " " + prose(k, 10 + k % 40, 12)
        a, b = fingerprints.fingerprint_pair(first, second)
        assert np.array_equal(a, fingerprints.fingerprint(first)) and np.array_equal(b, fingerprints.fingerprint(second))
        errors.append(fingerprints.likeness(a, b) - generalised_jaccard(first, second))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.09


def test_fingerprints_of_the_given_documents(spark):
    from hashlib import sha256

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted(docs.collect(), key=lambda r: -r.doc_id)
    for ranges in (8 << 20, 20_000):
        found = {r.doc_id: r for r in fingerprints.fingerprints(docs, range_bytes=ranges).collect()}
        assert len(found) == len(rows)
        for row, following in zip(rows, [*rows[1:], rows[0]]):
            third = len(row.text) // 3
            changed = row.text[:len(row.text) - third] + following.text[:third]
            own = found[row.doc_id]
            assert own.n_chars == len(row.text) and own.edited_sha256 == sha256(changed.encode()).hexdigest()
            assert own.fingerprint == fingerprints._hex(fingerprints.fingerprint(row.text))
            assert own.edited_fingerprint == fingerprints._hex(fingerprints.fingerprint(changed))
            assert own.near_next == fingerprints.likeness(fingerprints.fingerprint(row.text), fingerprints.fingerprint(following.text))
    assert np.mean([x.near_edited for x in found.values()]) > 0.4 > 0.1 > np.mean([x.near_next for x in found.values()])


def test_fingerprints_in_defined_cases(spark):
    docs = edge_documents(spark)
    found = fingerprints.fingerprints(docs, range_bytes=2000).collect()
    assert len(found) == docs.count()
    prints = {r.doc_id: r.fingerprint for r in found}
    assert prints[1] == prints[2] == prints[None] or prints[None] == prints[5]
    assert prints[5] == prints[6] == prints[7] and prints[17] == prints[18]
    assert fingerprints.fingerprints(no_documents(spark)).collect() == []
    one = fingerprints.fingerprints(spark.createDataFrame([(3, "a b c d e f g h i")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(3, 1.0)]


def test_a_batch_boundary_does_not_matter(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    whole = sorted(fingerprints.fingerprints(docs).collect())
    spark.conf.set(key, "3")
    try:
        assert sorted(fingerprints.fingerprints(docs).collect()) == whole
    finally:
        spark.conf.unset(key)
