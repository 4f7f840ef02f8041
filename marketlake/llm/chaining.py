"""Repeated passages across documents by collinear chaining of shared word k-mers.

1. Seeds: of every 4 successive runs of five words the one of least hash (minimisers). Two documents that share
   8 words in a row share a seed, and of an exact passage of 50 words at least eleven.
2. Each occurrence of a seed is joined to the first document (by id) and place that has it and, unless the 50 words
   from there on are the same, also to the first that has it with the same 8, 16, 47 and 50 words from there on, and
   to the document before that has it. So the number of matches is linear in the occurrences, however many documents
   share a passage, and runs of five words that other documents have singly do not hide the holder of a passage:
   one of 50 words in a row is joined to the first holder of 47 of its words, one of 53 to that of 50.
3. The matches of a document with an owner are chained: both places must grow, every skipped word costs,
   and the best predecessor is found by a Fenwick tree over the owner's places (prefix maximum).
4. Each chain is aligned word by word and extended on both sides: equal runs, and between them the nearest place
   where three words agree again. Where none is near the alignment ends, and the next seed of the chain that no
   alignment has passed starts another. The longest stretches of each with 50 words and 75 per cent equal are passages.

Passages of at least 50 words with at least 75 per cent equal words are returned, with the document, the earlier
document that holds it, and the words' places in both. The first holder of a passage is named by the others.
Chaining is grouped by pairs of documents, so a passage that most documents share is spread. Seeds are joined by
buckets of their hash: a task holds all occurrences of its seeds, 26 bytes each, also of one that most documents have.
Of a seed's hash 40 bits and the bucket are kept, and short tags of its contexts, told apart within the shorter ones: a
match that is none is refused by the alignment, one that is lost has odds of about 1e-5 a seed.

Defined cases: null and empty texts and those of fewer than 50 words have no passages; a row with a null id takes no part; rows that repeat
an id and a text count once (passages are sought between different ids); an id that stands for several texts
gets the passages that can be verified on one of them; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.memory import tidy
from marketlake.llm.words import gram_hashes, hashes_between, joined_texts, mixed, row_ranges, word_bounds, word_hashes
from marketlake.session import stored, stored_alone

SEED_WORDS = 5
WINDOW = 4
LEAST_WORDS = 50
IDENTITY = 0.75
MARGIN = 128  # words by which a chain is extended on each side at most
GAP_COST = 0.04  # per word skipped in either document; seeds less than 62 words apart are linked
LEAST_SEEDS = 2
CONTEXTS = (8, 16, LEAST_WORDS - WINDOW + 1, LEAST_WORDS)  # words from a seed on whose first holders it is joined to
BUCKET_BYTES = 4 << 20  # of text whose seeds are joined at once
_MOST_SEEDS = 1 << 18  # in a batch
_CHUNK_BYTES = 1 << 20  # of text at a time
_CONTEXT_BITS = 24
_AGREE = 3  # words after which an alignment goes on
_REACH = 16  # words within which it must


def seeds(words: np.ndarray, size: int = SEED_WORDS, window: int = WINDOW) -> np.ndarray:
    """Places of the minimisers among the runs of ``size`` words of one text."""
    if len(words) < size:
        return np.empty(0, dtype=np.int64)
    grams = np.maximum(gram_hashes(words, size), 1)
    return minimisers(grams, np.full(len(grams), len(grams)), window)


def minimisers(grams: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """Places of the minimisers of several texts: those of least hash (the first of equal ones) among ``window`` successive runs of words, or
    among all runs of a shorter text. ``grams`` are not 0, but where no run starts; ``sizes`` has the number of runs of
    the text that each is in."""
    count = len(grams)
    reach = np.ones(count, dtype=np.int8)
    for side in (1, -1):
        going = np.ones(count, dtype=bool)
        for step in range(1, min(window, count)):
            here, there = (grams[:-step], grams[step:]) if side > 0 else (grams[step:], grams[:-step])
            least = there >= here if side > 0 else there > here
            if side > 0:
                going[:-step] &= least
                going[-step:] = False
            else:
                going[step:] &= least
                going[:step] = False
            reach += going
    return np.flatnonzero((grams != 0) & (reach >= np.minimum(sizes, window)))


_RATIO = 0x9E3779B97F4A7C15
_powers = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) < size:
        size = max(size, 2 * len(_powers[0]))
        _powers = tuple(
            np.cumprod(np.concatenate([np.ones(1, dtype=np.uint64), np.full(size - 1, x, dtype=np.uint64)]))
            for x in (_RATIO, pow(_RATIO, -1, 2**64))
        )
    return _powers


def contexts(words: np.ndarray, at: np.ndarray, ends: np.ndarray, sizes: tuple[int, ...] = CONTEXTS) -> list[np.ndarray]:
    """For each size a short hash, not 0, of so many words from every place on; 0 where the text ends (``ends``) before."""
    up, down = _power_tables(len(words) + 1)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words * up[:len(words)])])
    out = []
    for size, (_, kept) in zip(sizes, _RECORD[3:]):
        inside = at + size <= ends
        own = at[inside]
        hashes = np.zeros(len(at), dtype=np.uint32)
        hashes[inside] = np.maximum(mixed((sums[own + size] - sums[own]) * down[own]) >> np.uint64(64 - 8 * kept), 1)
        out.append(hashes)
    return out


def seed_columns(doc: np.ndarray, texts: pa.Array) -> list[np.ndarray]:
    """gram, doc, place and contexts of the seeds of some texts."""
    data, places = joined_texts(texts)
    starts, ends = word_bounds(data)
    words = hashes_between(data, starts, ends)
    first = np.searchsorted(starts, places)
    sizes = np.diff(first)
    row = np.repeat(np.arange(len(sizes)), sizes)
    if len(words) < SEED_WORDS:
        return [np.empty(0, dtype=x) for x in (np.uint64, np.int64, np.int32, *[np.uint32] * len(CONTEXTS))]
    grams = np.zeros(len(words), dtype=np.uint64)
    inside = np.flatnonzero(np.arange(len(words)) + SEED_WORDS <= first[row + 1])
    grams[inside] = np.maximum(gram_hashes(words, SEED_WORDS)[inside], 1)
    at = minimisers(grams, np.maximum(sizes - SEED_WORDS + 1, 0)[row], WINDOW)
    return [grams[at], doc[row[at]], (at - first[row[at]]).astype(np.int32), *contexts(words, at, first[row[at] + 1])]


# Bytes kept of each column. A bucket's number holds the other bits of the gram. Longer contexts are told apart among
# those with equal shorter ones, so they need few bits.
_RECORD = ((np.uint64, 5), (np.int64, 8), (np.int32, 4), (np.uint32, 3), *[(np.uint32, 2)] * (len(CONTEXTS) - 1))
_BUCKET = pa.schema([("bucket", pa.int32()), ("seeds", pa.binary())])
_GRAM_BITS = np.uint64(40)


def _planes(column: np.ndarray, kept: int) -> bytes:
    """The low bytes of numbers, byte by byte: bytes of one rank compress well."""
    return np.ascontiguousarray(column.view(np.uint8).reshape(len(column), -1)[:, :kept].T).tobytes()


def _from_planes(data: bytes, start: int, count: int, kind: type, kept: int) -> np.ndarray:
    out = np.zeros((count, np.dtype(kind).itemsize), dtype=np.uint8)
    out[:, :kept] = np.frombuffer(data, dtype=np.uint8, count=count * kept, offset=start).reshape(kept, count).T
    return out.view(kind)[:, 0]


def seed_table(docs: DataFrame, buckets: int) -> DataFrame:
    """bucket, seeds: the seeds of all documents by a part of their hash, many in a row, column after column."""

    def packed(columns: list[np.ndarray]) -> pa.RecordBatch:
        bucket = ((columns[0] >> _GRAM_BITS) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
        names, starts = np.unique(bucket[order], return_index=True)
        columns = [x[order] for x in columns]
        parts = [
            b"".join(_planes(x[i:j], kept) for x, (_, kept) in zip(columns, _RECORD)) for i, j in zip(starts, [*starts[1:], len(order)])
        ]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(parts, pa.binary())], schema=_BUCKET)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            doc = batch.column(0).to_numpy()
            for start, end in row_ranges(batch.column(1), _CHUNK_BYTES):
                own = seed_columns(doc[start:end], batch.column(1).slice(start, end - start))
                parts.append(own)
                size += len(own[0])
                if size >= _MOST_SEEDS:
                    yield packed([np.concatenate(x) for x in zip(*parts)])
                    parts, size = [], 0
        if size:
            yield packed([np.concatenate(x) for x in zip(*parts)])

    return docs.select(F.col("doc_id").cast("long"), "text").dropna().mapInArrow(tidy(found), "bucket int, seeds binary")


def _unpacked(parts: list[bytes]) -> list[np.ndarray]:
    width = sum(kept for _, kept in _RECORD)
    columns = [[] for _ in _RECORD]
    for part in parts:
        start, count = 0, len(part) // width
        for column, (kind, kept) in zip(columns, _RECORD):
            column.append(_from_planes(part, start, count, kind, kept))
            start += count * kept
    return [np.concatenate(x) for x in columns]


def links(gram: np.ndarray, doc: np.ndarray, place: np.ndarray, *context: np.ndarray) -> tuple[np.ndarray, ...]:
    """doc, owner, place, owner_place: the matches of seed occurrences with earlier documents; see the module."""
    order = np.argsort(gram)
    same = gram[order[1:]] == gram[order[:-1]]
    twice = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]  # most seeds occur once
    columns = [x[twice] for x in (gram, doc, place, *context)]
    order = np.lexsort(columns[2::-1])
    columns = [x[order] for x in columns]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in columns], axis=0)
    gram, doc, place, *context = (x[new] for x in columns)  # rows that repeat an id and a text count once
    if not len(doc):
        return doc, doc, place, place
    starts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    sizes = np.diff(np.append(starts, len(gram)))
    shared = np.repeat(doc[starts] != doc[starts + sizes - 1], sizes)
    group = np.repeat(np.arange(len(starts)), sizes)[shared]
    doc, place, *context = (x[shared] for x in (doc, place, *context))
    if not len(doc):
        return doc, doc, place, place
    every = np.arange(len(doc))

    def heads(change: np.ndarray) -> np.ndarray:
        """Where the stretch that each element is in begins; ``change`` tells of all but the first if it differs."""
        return np.maximum.accumulate(np.where(np.concatenate([[True], change]), every, 0))

    first = heads(group[1:] != group[:-1])
    own = heads((group[1:] != group[:-1]) | (doc[1:] != doc[:-1]))
    alike, firsts = first, []
    for x in context:  # the first with the same context, among those that have the shorter one too
        key = alike.astype(np.uint64) << np.uint64(_CONTEXT_BITS) | x
        order = np.argsort(key, kind="stable")
        alike = np.empty_like(every)
        alike[order] = order[heads(key[order[1:]] != key[order[:-1]])]
        firsts.append(alike)
    rest = every[(context[-1] == 0) | (alike != alike[first])]
    pairs = [(every, first), (rest, np.where(own > first, own - 1, first)[rest])]
    for x, head in zip(context, firsts):
        known = rest[x[rest] != 0]
        pairs.append((known, head[known]))
    left, right = (np.concatenate(x) for x in zip(*pairs))
    apart = doc[left] != doc[right]
    left, right = np.divmod(np.unique(left[apart] * len(doc) + right[apart]), len(doc))
    return doc[left], doc[right], place[left], place[right]


def matches(docs: DataFrame) -> DataFrame:
    """doc, owner, place, owner_place: the seeds that a document shares with earlier ones. A task holds the
    seeds of one bucket at a time, and they are all that is shuffled of the texts."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    schema = pa.schema([("doc", pa.int64()), ("owner", pa.int64()), ("place", pa.int32()), ("owner_place", pa.int32())])

    def result(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        columns = links(*_unpacked(parts))
        for start in range(0, len(columns[0]), _MOST_SEEDS):
            yield pa.RecordBatch.from_arrays([pa.array(x[start:start + _MOST_SEEDS]) for x in columns], schema=schema)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for bucket, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != now and parts:
                    yield from result(parts)
                    parts = []
                now = bucket
                parts.append(part)
        if parts:
            yield from result(parts)

    by_bucket = seed_table(docs, max(8, -(-total // BUCKET_BYTES))).repartition("bucket").sortWithinPartitions("bucket")
    return by_bucket.mapInArrow(tidy(joined), "doc long, owner long, place int, owner_place int")


class Fenwick:
    """Prefix maxima with the element that has them."""

    def __init__(self, size: int):
        self.best = [(0.0, -1)] * (size + 1)

    def put(self, at: int, value: tuple[float, int]) -> None:
        best = self.best
        at += 1
        while at < len(best):
            if best[at] < value:
                best[at] = value
            at += at & -at

    def most(self, before: int) -> tuple[float, int]:
        """The best of all places before this one; (0, -1) if none is better than nothing."""
        out, best = (0.0, -1), self.best
        while before > 0:
            if best[before] > out:
                out = best[before]
            before -= before & -before
        return out


def chains(places: np.ndarray, others: np.ndarray, weight: float = SEED_WORDS, gap_cost: float = GAP_COST) -> list[list[int]]:
    """Chains of matches (places in both documents), best first; each match is in one chain at most.

    The score of a match is its weight and the best over its possible predecessors of their score less the cost
    of the words between. With linear costs that is a prefix maximum of score + cost * (sum of the places).
    """
    order = np.lexsort((-others, places))
    ranks = np.unique(others, return_inverse=True)[1]
    tree = Fenwick(int(ranks.max()) + 1 if len(ranks) else 0)
    scores, before = [0.0] * len(order), [-1] * len(order)
    place_list, other_list, rank_list = places.tolist(), others.tolist(), ranks.tolist()
    # A lead over starting anew is kept as its distance from the far end, so that (0, -1) means "none".
    base = gap_cost * (int(places.min()) + int(others.min())) if len(order) else 0.0
    for k in order.tolist():
        here = gap_cost * (place_list[k] + other_list[k]) - base
        lead, last = tree.most(rank_list[k])
        gain = lead - here if last >= 0 else 0.0
        if gain > 0:
            before[k] = last
        scores[k] = weight + max(0.0, gain)
        tree.put(rank_list[k], (scores[k] + here, k))
    used, out = [False] * len(order), []
    for k in sorted(range(len(scores)), key=lambda x: -scores[x]):
        chain = []
        while k >= 0 and not used[k]:
            used[k] = True
            chain.append(k)
            k = before[k]
        if len(chain) >= LEAST_SEEDS:
            out.append(chain[::-1])
    return out


_CHAIN = pa.schema(
    [(x, pa.int64()) for x in ("doc", "owner")] + [(x, pa.int32()) for x in ("low", "high", "owner_low", "owner_high")] + [("steps", pa.binary())]
)
_CHAIN_KIND = "doc long, owner long, low int, high int, owner_low int, owner_high int, steps binary"


def _steps(places: np.ndarray, others: np.ndarray) -> bytes:
    """The matches of a chain after its first as distances from the one before: small numbers compress well."""
    return np.concatenate([np.diff(places), np.diff(others)]).astype(np.int32).tobytes()


def _anchors(steps: bytes, low: int, other_low: int) -> list[tuple[int, int]]:
    """The matches of a chain from what ``_steps`` made of them and the first one."""
    both = np.frombuffer(steps, dtype=np.int32).reshape(2, -1).cumsum(axis=1)
    return [(low, other_low), *zip((low + both[0]).tolist(), (other_low + both[1]).tolist())]


def chain_table(found: DataFrame) -> DataFrame:
    """The chains of every document with every owner: places of the first and after the last word in both, and the
    matches between."""

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(groups: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            rows = []
            for docs, owners, places, others in groups:
                for chain in chains(places, others):
                    first, last = chain[0], chain[-1]
                    steps = _steps(places[chain], others[chain])
                    rows.append((docs[0], owners[0], places[first], places[last] + SEED_WORDS, others[first], others[last] + SEED_WORDS, steps))
            columns = list(zip(*rows)) if rows else [[] for _ in _CHAIN]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CHAIN)], schema=_CHAIN)

        rest = None
        for batch in batches:
            own = [x.to_numpy() for x in batch.columns]
            if rest is not None:
                own = [np.concatenate(x) for x in zip(rest, own)]
            starts = np.flatnonzero(np.concatenate([[True], (own[0][1:] != own[0][:-1]) | (own[1][1:] != own[1][:-1])]))
            rest = [x[starts[-1]:] for x in own]  # the last pair may go on
            yield result([tuple(x[a:b] for x in own) for a, b in zip(starts, starts[1:]) if b - a >= LEAST_SEEDS])
        if rest is not None and len(rest[0]) >= LEAST_SEEDS:
            yield result([tuple(rest)])

    by_pair = found.repartition("doc", "owner").sortWithinPartitions("doc", "owner", "place", "owner_place")
    return by_pair.mapInArrow(tidy(chained), _CHAIN_KIND)


def _equal_run(a: np.ndarray, b: np.ndarray) -> int:
    size = min(len(a), len(b))
    start, block = 0, 64
    while start < size:  # in growing blocks: most runs are short
        differ = a[start:min(start + block, size)] != b[start:min(start + block, size)]
        if differ.any():
            return start + int(differ.argmax())
        start, block = start + block, block * 2
    return size


def _walk(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """Equal runs (place in a, place in b, length) from the start of both on."""
    i = j = 0
    out = []
    while True:
        run = _equal_run(a[i:], b[j:])
        if run:
            out.append((i, j, run))
            i, j = i + run, j + run
        x, y = a[i:i + _REACH + _AGREE - 1], b[j:j + _REACH + _AGREE - 1]
        if len(x) < _AGREE or len(y) < _AGREE:
            return out
        agree = np.ones((len(x) - _AGREE + 1, len(y) - _AGREE + 1), dtype=bool)
        for k in range(_AGREE):
            agree &= x[k:k + agree.shape[0], None] == y[k:k + agree.shape[1]]
        di, dj = np.nonzero(agree)
        if not len(di):
            return out
        near = np.argmin(np.maximum(di, dj) * 64 + di + dj)
        i, j = i + int(di[near]), j + int(dj[near])


def alignments(a: np.ndarray, b: np.ndarray, anchors: list[tuple[int, int]]) -> list[list[tuple[int, int, int]]]:
    """The equal runs (place in a, place in b, length) of a chain, one list for every stretch that is aligned without
    a break. Each match of the chain that lies on no run so far starts a new one."""
    out: list[list[tuple[int, int, int]]] = []
    for at, other_at in anchors:
        if any(_passes(runs, at, other_at) for runs in out):
            continue
        back = [(at - i - n, other_at - j - n, n) for i, j, n in _walk(a[:at][::-1], b[:other_at][::-1])][::-1]
        runs = back + [(at + i, other_at + j, n) for i, j, n in _walk(a[at:], b[other_at:])]
        if runs:
            out.append(runs)
    return out


def _passes(runs: list[tuple[int, int, int]], at: int, other_at: int) -> bool:
    k = bisect_right(runs, at, key=itemgetter(0)) - 1
    return k >= 0 and at < runs[k][0] + runs[k][2] and at - runs[k][0] == other_at - runs[k][1]


def _diagonals(a: np.ndarray, b: np.ndarray, i: int, p: int, j: int, q: int) -> list[tuple[int, int, int]]:
    """Equal runs of any length between two places, with the words left over in one of both set in where most agree."""
    size, out = min(p - i, q - j), []
    if size <= 0:
        return out
    left, right = a[i:i + size] == b[j:j + size], a[p - size:p] == b[q - size:q]
    split = int((np.concatenate([[0], np.cumsum(left)]) + np.concatenate([np.cumsum(right[::-1])[::-1], [0]])).argmax())
    for equal, x, y in ((left[:split], i, j), (right[split:], p - size + split, q - size + split)):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], equal.astype(np.int8), [0]]))).tolist()
        out += [(x + e, y + e, f - e) for e, f in zip(edges[::2], edges[1::2])]
    return out


def _filled(a: np.ndarray, b: np.ndarray, runs: list[tuple[int, int, int]], ends: int = 0) -> list[tuple[int, int, int]]:
    """The runs with the shorter equal ones between them, and with those in so many words before and after all."""
    (i, j, _), (p, q, n) = runs[0], runs[-1]
    before, after = min(ends, i, j), min(ends, len(a) - p - n, len(b) - q - n)
    out = _diagonals(a, b, i - before, i, j - before, j) + runs[:1]
    for run in runs[1:]:
        x, y, size = out[-1]
        out += [*_diagonals(a, b, x + size, run[0], y + size, run[1]), run]
    return out + _diagonals(a, b, p + n, p + n + after, q + n, q + n + after)


def _longest(runs: list[tuple[int, int, int]], least: int, identity: float) -> list[tuple[int, int, int, int, int]]:
    """The longest stretch of runs with enough words and enough of them equal, then those on both sides of it."""
    out, open_ = [], [(0, len(runs))]
    i, j, n = np.array(runs, dtype=np.int64).reshape(-1, 3).T
    total = np.concatenate([[0], np.cumsum(n)])
    x, y = total[1:] - identity * (i + n), total[1:] - identity * (j + n)
    while open_:
        low, high = open_.pop()
        best, chosen = least - 1, None
        for s in range(low, high):
            if i[high - 1] + n[high - 1] - i[s] <= best:
                break
            t = s + int(np.searchsorted((i + n)[s:high] - i[s], best + 1))
            good = (x[t:high] >= total[s] - identity * i[s] - 1e-9) & (y[t:high] >= total[s] - identity * j[s] - 1e-9)
            good &= (j + n)[t:high] - j[s] >= least
            if good.any():
                chosen = s, t + int(np.flatnonzero(good)[-1])
                best = int(i[chosen[1]] + n[chosen[1]] - i[s])
        if chosen:
            s, t = chosen
            out.append((int(i[s]), int(i[t] + n[t]), int(j[s]), int(j[t] + n[t]), int(total[t + 1] - total[s])))
            open_ += [(low, s), (t + 1, high)]
    return out


def _span(runs: list[tuple[int, int, int]]) -> int:
    """Words from the start of the first run to the end of the last, in the text where they are fewer."""
    (i, j, _), (p, q, n) = runs[0], runs[-1]
    return min(p - i, q - j) + n


def stretches(
    found: list[list[tuple[int, int, int]]], a: np.ndarray, b: np.ndarray, least: int = LEAST_WORDS, identity: float = IDENTITY
) -> list[tuple[int, int, int, int, int]]:
    """The longest stretches with enough words and enough of them equal: start and end in a and in b, equal words.

    Each alignment is taken by itself. Those without such a stretch are tried once more, with the words at their ends
    and together with their neighbours.
    """
    out, rest = [], []
    for runs in found:
        own = _longest(_filled(a, b, runs), least, identity) if _span(runs) >= least else []
        out += own
        if own:
            rest.append([])
        elif rest and rest[-1] and runs[0][0] >= sum(rest[-1][-1][::2]) and runs[0][1] >= sum(rest[-1][-1][1:]):
            rest[-1] += runs
        else:
            rest.append(list(runs))
    for runs in rest:
        if runs and _span(runs) + 2 * _REACH >= least:
            out += _longest(_filled(a, b, runs, _REACH), least, identity)
    return out


def passages(docs: DataFrame, least_words: int = LEAST_WORDS, identity: float = IDENTITY) -> DataFrame:
    """doc_id, first_id, start_word, end_word, first_start, first_end, n_words, identity: passages of a document
    that an earlier document holds. The result is stored, without what led to it."""
    return stored_alone(docs.sparkSession, "passages", lambda: _passages(docs, least_words, identity))


def _passages(docs: DataFrame, least_words: int, identity: float) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").dropna()
    found = stored(chain_table(matches(docs)), "chains")
    key = F.struct("doc", "owner", "low", "high", "owner_low", "owner_high").alias("chain")
    mine = found.select(key, F.lit(True).alias("mine"), "doc", "low", "high", "steps")
    theirs = found.select(
        key, F.lit(False).alias("mine"), F.col("owner").alias("doc"), F.col("owner_low").alias("low"), F.col("owner_high").alias("high"),
        F.lit(None).cast("binary").alias("steps"),
    )
    asked = mine.unionByName(theirs).join(texts, "doc")
    chain_type = asked.schema["chain"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_doc, last_text, words = None, None, None
        for batch in batches:
            parts, starts = [], []
            for doc, low, high, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5)):
                if doc != last_doc or text.as_buffer().size != last_text.as_buffer().size or text.as_buffer() != last_text.as_buffer():
                    last_doc, last_text = doc, text
                    words = word_hashes(text.as_py().encode()).astype(np.uint32)
                first = max(0, low - MARGIN)
                starts.append(first)
                parts.append(words[first:high + MARGIN].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(starts, pa.int32()), pa.array(parts, pa.binary()), batch.column(6)],
                names=["chain", "mine", "start", "words", "steps"],
            )

    slices = asked.select("chain", "mine", "doc", "low", "high", "text", "steps").mapInArrow(
        tidy(cut), f"chain {chain_type}, mine boolean, start int, words binary, steps binary"
    )
    part = F.struct("start", "words", "steps")
    both = slices.groupBy("chain").agg(F.max(F.when(F.col("mine"), part)).alias("a"), F.max(F.when(~F.col("mine"), part)).alias("b"))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("first_id", pa.int64()), ("start_word", pa.int32()), ("end_word", pa.int32()),
        ("first_start", pa.int32()), ("first_end", pa.int32()), ("n_words", pa.int32()), ("identity", pa.float64()),
    ])

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, owner, low, other_low, start, words, steps, other_start, others in zip(*(x.to_pylist() for x in batch.columns)):
                a, b = np.frombuffer(words, dtype=np.uint32), np.frombuffer(others, dtype=np.uint32)
                anchors = [(x, y) for x, y in _anchors(steps, low - start, other_low - other_start) if x < len(a) and y < len(b)]
                for i, p, j, q, equal in stretches(alignments(a, b, anchors), a, b, least_words, identity):
                    rows.append((doc, owner, start + i, start + p, other_start + j, other_start + q, p - i, equal / max(p - i, q - j)))
            columns = list(zip(*rows)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    kinds = "doc_id long, first_id long, start_word int, end_word int, first_start int, first_end int, n_words int, identity double"
    flat = both.filter("a is not null and b is not null").select(
        "chain.doc", "chain.owner", "chain.low", "chain.owner_low", F.col("a.start").alias("start"), F.col("a.words").alias("words"), F.col("a.steps").alias("steps"),
        F.col("b.start").alias("other_start"), F.col("b.words").alias("others"),
    )
    # Chains of one passage are extended to the same stretch.
    return flat.mapInArrow(tidy(aligned), kinds).distinct()


def without_passages(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents (with all their columns) less the words of the passages found; ``n_chars`` follows the text
    where there is such a column. Documents of which no word is left go; others stay, also those without text."""
    spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("start_word", "end_word")).alias("spans"))
    spans = spans.select(F.col("doc_id").alias("_cut_id"), "spans")
    own = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"))
    joined = own.join(spans, F.col("_row.doc_id").cast("long") == F.col("_cut_id"), "left").select("_row", "spans", F.col("_row.text").alias("text"))
    left = F.pandas_udf(_cut_spans, "string")("text", "spans")
    kept = joined.withColumn("text", F.when(F.col("spans").isNotNull(), left).otherwise(F.col("text")))
    kept = kept.filter(F.col("spans").isNull() | (F.col("text") != ""))
    columns = []
    for name in docs.columns:
        column = F.col(f"_row.`{name}`")
        if name == "text":
            column = F.col("text")
        elif name == "n_chars":
            column = F.when(F.col("spans").isNull(), column).otherwise(F.char_length("text").cast(docs.schema[name].dataType))
        columns.append(column.alias(name))
    return kept.select(*columns)


def _cut_spans(texts, spans):
    import pandas as pd

    return pd.Series([_cut(t, s) if s is not None else t for t, s in zip(texts, spans)], dtype=object)


def _cut(text: str | None, spans) -> str | None:
    """The text without the words of the spans; empty if no word is left."""
    if text is None:
        return None
    data = text.encode()
    starts, _ = word_bounds(data)
    gone = np.zeros(len(starts), dtype=bool)
    for span in spans:
        gone[span["start_word"]:span["end_word"]] = True
    if gone.all():
        return ""
    bounds = np.append(starts, len(data))
    parts, place = [data[:starts[0]]], 0
    for k in np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)) != 0).reshape(-1, 2):
        parts.append(data[bounds[k[0]]:bounds[k[1]]])
    return b"".join(parts).decode()
