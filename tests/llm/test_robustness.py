"""Damaged archives, repeated rows that fill whole tables, licence texts, and recall of passages."""

import base64
import gzip
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from corpus import prose
from pyspark.sql import functions as F

from marketlake.llm import chaining, fingerprints, licences, packing, shards, warc
from marketlake.llm import words as hashing

SMALL = "/root/testdata/sf0.001"


def sha1(data, lower=False):
    digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
    return digest.lower() if lower else digest


def response(number, payload, lower=False):
    return (
        f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{number}>\r\nWARC-Payload-Digest: sha1:{sha1(payload, lower)}\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode() + payload + b"\r\n\r\n"


def revisit(number, digest, http_length="12"):
    http = f"HTTP/1.1 200 OK\r\nContent-Length: {http_length}\r\n\r\n".encode()
    return (
        f"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:page:{number}>\r\nWARC-Payload-Digest: sha1:{digest}\r\n"
        f"Content-Type: application/http\r\nContent-Length: {len(http)}\r\n\r\n"
    ).encode() + http + b"\r\n\r\n"


def parts():
    return [response(1, b"first payload"), revisit(2, sha1(b"x" * 12)), response(3, b"the third payload", lower=True)]


def salvaged(data):
    """Every record as a row, as the reader makes it, and the gaps."""
    found = list(warc.salvage(data))
    rows = [warc._row("a", r, True) for r in found]
    pa.array([r[9] for r in rows], pa.int64())
    return [r for r, x in zip(rows, found) if not x.reason], [x for x in found if x.reason]


@pytest.mark.parametrize("pack", [lambda x: x, lambda x: gzip.compress(x, mtime=0)])
def test_no_damaged_byte_stops_the_reader(pack):
    members = [pack(x) for x in parts()]
    data = b"".join(members)
    starts = np.cumsum([0, *map(len, members)])
    whole = {r[5]: r[5:] for r in salvaged(data)[0]}
    assert len(whole) == 3 and not salvaged(data)[1]
    pick = random.Random(2)
    for place in range(len(data)):
        touched = int(np.searchsorted(starts, place, side="right")) - 1
        for changed in (
            bytes([data[place] ^ 255]), bytes([data[place] ^ 1]), bytes([pick.randrange(256)]), b"", data[place:place + 1] + bytes([pick.randrange(256)]), data[place:place + 1] * 3
        ):
            rows, gaps = salvaged(data[:place] + changed + data[place + 1:])
            back = [r[5:] for r in rows]
            for k in range(3):
                if k != touched:
                    assert whole[f"<urn:page:{k + 1}>"] in back, (place, changed)
            if len(rows) < 3:
                assert gaps
    for end in range(len(data)):
        rows, gaps = salvaged(data[:end])
        assert len(rows) >= int((starts[1:] <= end).sum()) and (gaps or end in starts)


@pytest.mark.parametrize("broken", [
    revisit(2, "not!base32" + "A" * 22), revisit(2, "0" * 39), revisit(2, sha1(b""), "9" * 25), response(2, b"x").replace(b"Content-Length: 1", b"Content-Length: " + b"1" * 5000),
    response(2, b"x").replace(b"Content-Length: 1", b"Content-Length: " + "١".encode()), b"WARC/1.0\r\n\xff\xfe: \x00\r\nContent-Length: 0\r\n\r\n\r\n",
])
def test_unreadable_headers_become_a_gap(broken):
    first, _, last = parts()
    rows, gaps = salvaged(first + broken + last)
    assert [r[5] for r in rows] == ["<urn:page:1>", "<urn:page:3>"]
    assert len(gaps) == 1 and gaps[0].offset == len(first) and gaps[0].length == len(broken)


def test_digests_of_either_case_are_read():
    lower = revisit(2, sha1(b"x" * 12, lower=True))
    hexadecimal = revisit(4, hashlib.sha1(b"y").hexdigest().upper())
    rows, gaps = salvaged(lower + hexadecimal)
    assert not gaps and [r[7] for r in rows] == [hashlib.sha1(b"x" * 12).hexdigest(), hashlib.sha1(b"y").hexdigest()]


def test_an_archive_that_is_too_long_is_a_gap(spark, tmp_path):
    (tmp_path / "long.warc").write_bytes(b"".join(parts()))
    (tmp_path / "short.warc").write_bytes(parts()[0])
    rows = warc.read_archives(spark, str(tmp_path), most_bytes=len(parts()[0])).collect()
    assert sorted((r.gap_reason or "", r.record_id) for r in rows) == [("", "<urn:page:1>"), ("the archive is too long", None)]


def repeated(spark, count=20_000, others=500):
    same = spark.range(count).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one text that many rows repeat").alias("text"))
    rest = spark.range(others).select((F.col("id") + 100).alias("doc_id"), F.concat(F.lit("text number "), F.col("id"), F.lit(" of its own")).alias("text"))
    return same.unionByName(rest).repartition(8)


def test_repeated_rows_are_dealt_over_buckets(spark, checkpoints, tmp_path, monkeypatch):
    docs, largest = repeated(spark), []
    real = shards.stored

    def watched(rows, name):
        out = real(rows, name)
        if name == "buckets":
            largest.append(out.agg(F.max("_rows"), F.count("_rows")).first())
        return out

    monkeypatch.setattr(shards, "stored", watched)
    found = shards.shuffle_into_shards(docs, str(tmp_path / "s"), bucket_bytes=20_000)
    sizes = [r["count"] for r in found.groupBy("shard").count().collect()]
    assert sum(sizes) == 20_500 and len(sizes) == 16 and max(sizes) - min(sizes) <= 1
    assert found.select("shard", "slot").distinct().count() == 20_500
    assert largest[0][0] >= 20_000 and largest[1][0] < 3 * 20_500 / largest[1][1]


def test_repeated_pieces_are_dealt_over_groups(spark, checkpoints):
    pieces = packing.stored(packing.token_pieces(repeated(spark), packing_model()), "pieces")
    packed = packing.pack(pieces, group_pieces=500)
    rows = packed.select("sequence_id", "offset", "length").collect()
    assert len(rows) == 20_500
    assert max(r["count"] for r in packed.groupBy(F.shiftright("sequence_id", 32)).count().collect()) < 1000
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        place = 0
        for offset, length in sorted(own):
            assert offset == place
            place += length
        assert place <= 2048
    assert len(sequences) <= 1.05 * sum(r.length for r in rows) / 2048 + 50


def packing_model():
    from marketlake.llm.book import tokenizer_file

    return tokenizer_file("word_bpe_49k.json")


def test_null_and_repeated_ids_fill_several_ranges(spark, checkpoints):
    nulls = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("null text "), F.col("id"), F.lit(" has five words")).alias("text"))
    docs = repeated(spark, 4000, 300).unionByName(nulls).unionByName(spark.createDataFrame([(-2**63, "least of all"), (2**63 - 1, "greatest of all")], "doc_id long, text string"))
    made = fingerprints._ranges(fingerprints._tied(docs), 4000, 1000)
    assert len(made.ties[7]) > 10 and len(made.ties[None]) > 10
    found = fingerprints.fingerprints(docs, range_bytes=4000).collect()
    assert len(found) == 7302 and sum(r.doc_id is None for r in found) == 3000
    whole = {r.doc_id: (r.edited_sha256, r.near_next) for r in fingerprints.fingerprints(docs.filter("doc_id <> 7 and doc_id is not null")).collect()}
    for r in found:
        if r.doc_id is not None and r.doc_id not in (7, 100, -2**63):  # those next to the repeats or the nulls differ
            assert (r.edited_sha256, r.near_next) == whole[r.doc_id]


def test_ranges_ascend_in_the_order_of_the_rows():
    made = fingerprints.Ranges(np.array([10, 20, 30]), {20: np.array([0, 50]), None: np.array([5])})
    ids = np.array([31, 30, 21, 20, 20, 20, 19, 11, 10, -5, 0, 0])
    ties = np.array([0, 0, 0, -1, 40, 60, 0, 0, 0, 0, 4, 6])
    null = np.array([False] * 10 + [True] * 2)
    found = made.of(ids, ties, null).tolist()
    assert found == sorted(found) and len(set(found)) == 9 and found[-1] < made.count and found[3:6] == sorted(set(found[3:6]))


def test_every_licence_text_is_named(spark):
    known = licences.known_templates()
    assert {"BSD-2-Clause", "BSD-3-Clause", "ISC", "Apache-2.0", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "CC0-1.0"} <= set(known)
    scanner = licences.Scanner()
    for name, texts in known.items():
        for number, text in enumerate(texts):
            found = scanner.scan("some words before it " + text + " and some words after it")
            assert (name, number) == max(found, key=lambda x: x[4])[:2], name
            assert max(x[2] for x in found) > 0.99


def test_two_and_three_clauses_are_told_apart():
    scanner = licences.Scanner()
    two, three = (licences.TEMPLATES[x][1] for x in ("BSD-2-Clause", "BSD-3-Clause"))
    changed = "Copyright (c) 2020, Somebody\n" + two.replace("COPYRIGHT HOLDERS AND CONTRIBUTORS", "REGENTS AND CONTRIBUTORS")
    assert [x[0] for x in scanner.scan(changed)] == ["BSD-2-Clause"]
    assert [x[0] for x in scanner.scan(three.replace("the copyright holder", "the University"))] == ["BSD-3-Clause"]


def passages_between(first, second):
    """What is found of two texts, from their seeds on."""
    texts = [first, second]
    columns = chaining.seed_columns(np.array([1, 2]), pa.array(texts))
    columns[0] = columns[0] & np.uint64(2**40 - 1)
    doc, _, place, owner_place = chaining.links(*columns)
    a, b = (hashing.word_hashes(x.encode()) for x in (second, first))
    out = []
    for chain in chaining.chains(place, owner_place) if len(doc) else []:
        anchors = [(int(place[k]), int(owner_place[k])) for k in chain]
        out += chaining.stretches(chaining.alignments(a, b, anchors), a, b)
    return out


@pytest.mark.parametrize("size, changed, floor", [(50, 0.0, 1.0), (60, 0.1, 0.97), (80, 0.2, 0.9), (100, 0.2, 0.95), (160, 0.23, 0.9)])
def test_recall_of_fuzzy_passages(size, changed, floor):
    found = 0
    for seed in range(100):
        pick = random.Random(1000 * size + seed)
        own = [f"p{pick.randrange(10**6)}" for _ in range(size)]
        other = [*own]
        for k in pick.sample(range(1, size - 1), int(changed * size)):
            other[k] = f"q{pick.randrange(10**6)}"
        first = f"{prose(seed, 80, 10**6)} {' '.join(own)} {prose(seed + 500, 70, 10**6)}"
        second = f"{prose(seed + 900, 30, 10**6)} {' '.join(other)} {prose(seed + 1500, 90, 10**6)}"
        spans = passages_between(first, second)
        found += any(i < 30 + size // 2 < p and abs(i - j + 50) <= 2 for i, p, j, q, _ in spans)
    assert found >= floor * 100, found


def test_seeds_of_many_texts_are_those_of_each():
    texts = [prose(k, k % 40, 30) for k in range(200)] + ["", None, "a b c d", "a b c d e", prose(9, 3000, 50)]
    columns = chaining.seed_columns(np.arange(len(texts)), pa.array(texts))
    for k, text in enumerate(texts):
        own = hashing.word_hashes((text or "").encode())
        mine = columns[1] == k
        assert columns[2][mine].tolist() == chaining.seeds(own).tolist()
    assert hashing.word_hashes(b"").tolist() == []
    words = ["a", "ab", "a" * 8, "a" * 9, "a" * 16, "a" * 17, "a" * 64, "a" * 65, "A", "\0", "\0\0", "é"]
    hashes = hashing.word_hashes(" ".join(words).encode())
    assert len(set(hashes.tolist())) == len(words) - 1 and hashes[0] == hashes[8]
    assert all(hashing.word_hashes(f" {w}\n".encode())[0] == h for w, h in zip(words, hashes))
