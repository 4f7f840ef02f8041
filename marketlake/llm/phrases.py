"""Phrase collocation mining by vertical partitioning of a depth-truncated suffix tree, after the method of ERA.

1. Words are counted by language. These counts are the frequencies of the one-word prefixes of all suffixes.
2. Prefixes are grouped by a memory budget. Words in no more than an eighth of the budget are dealt into slots by their
   hash, and successive slots form groups of at most the budget. The suffixes of a more frequent word are told
   apart by longer prefixes, up to the first word that is not as frequent, and those are dealt over as many groups as
   the count of the word asks for.
3. Each task cuts its texts into suffixes of at most four words within a piece, adds up equal ones (so a hot phrase is
   one row of a task) and sends each to the group of its prefix.
4. Each group builds its subtrees by itself, one level of words after the other, following only nodes that are frequent
   enough, and reads the count of a node from the totals of the leaves below it. A node that lies above the prefixes of
   several groups (all its words are very frequent) gets the sum of its parts.
5. Cuts, scores, phrases inside longer ones and the first of each language are joins and aggregates of these nodes.

Pieces, words, candidates and scores are those of ``collocations``. Words are told apart by 64-bit hashes of language and
word in steps 3 and 4; two words with one hash would be an error, which the count of the words finds and raises.

What reaches the driver and is broadcast: a group for each slot and the words above an eighth of the budget. Both are
at most a few millions, as the budget grows with the words where they would be more (see ``Groups``).

Defined cases: null texts and texts without words add nothing; a null language is ``und``, as is the text "und"; repeated
rows count each; null and repeated ids do not matter (ids are not read); an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.words import bounds_between, hashes_between, joined_texts, mixed, row_ranges
from marketlake.session import stored, stored_alone

MOST_WORDS = 4
LEAST_COUNT = 30
FIRST = 2000  # phrases returned for a language
SCALE = 2_000_000
COVER = 80  # per cent of a phrase's occurrences inside a longer one at which it is dropped
GROUP_SUFFIXES = 1 << 19  # the budget: suffixes in a group
_MOST_GROUPS = 1 << 20  # beyond so many groups the budget grows instead
_CHUNK_BYTES = 4 << 20  # of text at a time
_NO_WORD = 0

_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAPS = _BREAKS.copy()
_GAPS[[0x20, 0x09]] = True


@dataclass
class Chunk:
    """Words of some texts: where they are, their hashes, the piece and the row that each is in."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    piece: np.ndarray
    row: np.ndarray


def worded(langs: pa.Array, texts: pa.Array) -> Chunk:
    """The words of texts. Equal words of different languages have different hashes; no hash is 0."""
    data, places = joined_texts(texts)
    codes = np.frombuffer(data, dtype=np.uint8)
    starts, ends = bounds_between(_GAPS[codes])
    seeds = {x: xxhash.xxh3_64_intdigest((x if x is not None else "und").encode(), seed=13) for x in set(langs.to_pylist())}
    counts = np.diff(np.searchsorted(starts, places))
    row = np.repeat(np.arange(len(texts)), counts)
    seed = np.array([seeds[x] for x in langs.to_pylist()], dtype=np.uint64)
    hashes = np.maximum(mixed(hashes_between(data, starts, ends) + seed[row]), 1)
    piece = np.searchsorted(np.flatnonzero(_BREAKS[codes]), starts)  # the line feed after each text is a break
    return Chunk(data, starts, ends, hashes, piece, row)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, Chunk]]:
    for start, end in row_ranges(batch.column(1), _CHUNK_BYTES):
        langs, texts = (x.slice(start, end - start) for x in batch.columns)
        yield langs, worded(langs, texts)


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, hash, count of the words in texts (columns lang, text)."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("hash", pa.int64()), ("count", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for langs, chunk in _chunks(batch):
                hashes, at, counts = np.unique(chunk.hashes, return_index=True, return_counts=True)
                names = [chunk.data[i:j] for i, j in zip(chunk.starts[at].tolist(), chunk.ends[at].tolist())]
                own = langs.fill_null("und").take(pa.array(chunk.row[at]))
                words = pa.array(names, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([own, words, pa.array(hashes.view(np.int64)), pa.array(counts)], schema=schema)

    rows = texts.mapInArrow(counted, "lang string, word string, hash long, count long")
    return rows.groupBy("lang", "word", "hash").agg(F.sum("count").alias("count"))


@dataclass
class Groups:
    """The groups of prefixes: one for each slot of a word's hash, and a range of them for each very frequent word.

    ``slots`` has the group of each slot, ``heavy`` the sorted hashes of the very frequent words, ``first`` and
    ``width`` their ranges.
    """

    slots: np.ndarray
    heavy: np.ndarray
    first: np.ndarray
    width: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame, total: int, budget: int = GROUP_SUFFIXES) -> Groups:
        """Groups by the words' counts (hash, count). At most 8 * total / budget words are very frequent."""
        budget = max(budget, -(-total // _MOST_GROUPS))
        most = max(1, budget // 8)
        size = 1 << max(3, (16 * total // budget).bit_length())
        heavy = counts.filter(F.col("count") > most).select("hash", "count").collect()
        slots = counts.filter(F.col("count") <= most).groupBy(F.col("hash").bitwiseAND(F.lit(size - 1)).alias("slot"))
        sums = np.zeros(size, dtype=np.int64)
        for slot, count in slots.agg(F.sum("count")).collect():
            sums[slot] = count
        group, filled, groups = 0, 0, np.zeros(size, dtype=np.int32)
        for slot, count in enumerate(sums.tolist()):
            if filled and filled + count > budget:
                group, filled = group + 1, 0
            groups[slot] = group
            filled += count
        hashes = np.array([x[0] for x in heavy], dtype=np.int64).view(np.uint64)
        width = np.maximum(-(-np.array([x[1] for x in heavy], dtype=np.int64) * 2 // budget), 1).astype(np.int32)
        order = np.argsort(hashes)
        width = width[order]
        return cls(groups, hashes[order], (group + 1 + np.cumsum(width) - width).astype(np.int32), width)

    def rank(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word among the very frequent ones, or -1."""
        if not len(self.heavy):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.heavy, hashes), len(self.heavy) - 1)
        return np.where(self.heavy[at] == hashes, at, -1)

    def place(self, words: list[np.ndarray], names: np.ndarray) -> np.ndarray:
        """The group of suffixes; words are places in ``names``, the hashes, of which the last stands for none."""
        rank = self.rank(names)
        out = self.slots[(names[words[0]] & np.uint64(len(self.slots) - 1)).astype(np.int64)]
        own = rank[words[0]]
        extended = np.flatnonzero(own >= 0)
        if len(extended):
            key, more = names[words[0][extended]], np.ones(len(extended), dtype=bool)
            for column in words[1:]:
                word = column[extended]
                key = np.where(more, mixed(key * np.uint64(0x9E3779B97F4A7C15) + names[word]), key)
                more &= rank[word] >= 0
            own = own[extended]
            out[extended] = self.first[own] + ((key >> np.uint64(32)) % self.width[own].astype(np.uint64)).astype(np.int32)
        return out


def suffixes(chunk: Chunk) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The different suffixes of two to four words in a chunk: their words as places in the hashes, which come next and
    end with that of no word, and how often each occurs."""
    names, word = np.unique(chunk.hashes, return_inverse=True)
    none, size = len(names), len(word)
    names = np.append(names, np.uint64(_NO_WORD))
    following = np.append(word[1:], none)
    same = chunk.piece[1:] == chunk.piece[:-1]
    following[:-1][~same] = none
    pairs, pair = np.unique(word * (none + 1) + following, return_inverse=True)
    far = len(pairs)
    later = np.full(size, far)
    later[:-2] = np.where(chunk.piece[2:] == chunk.piece[:-2], pair[2:], far)
    found, counts = np.unique((pair * (far + 1) + later)[following != none], return_counts=True)
    first, second = np.divmod(found, far + 1)
    ends = np.append(pairs, none * (none + 1) + none)
    return [*np.divmod(pairs[first], none + 1), *np.divmod(ends[second], none + 1)], names, counts


_KINDS = (np.uint8, np.uint16, np.uint32)


def _packed(words: list[np.ndarray], names: np.ndarray, counts: np.ndarray) -> bytes:
    """Suffixes with the hashes that they use, in as narrow numbers as hold them."""
    if len(counts) * 16 < len(names):
        used = np.unique(np.concatenate(words))
        words = [np.searchsorted(used, x) for x in words]
    else:
        mark = np.zeros(len(names), dtype=bool)
        for x in words:
            mark[x] = True
        used, new = np.flatnonzero(mark), np.cumsum(mark) - 1
        words = [new[x] for x in words]
    kinds = [next(k for k, t in enumerate(_KINDS) if x < 1 << 8 * np.dtype(t).itemsize) for x in (len(used), int(counts.max()))]
    head = np.array([len(counts), len(used), *kinds], dtype=np.int64)
    return b"".join([head.tobytes(), names[used].tobytes(), *(x.astype(_KINDS[kinds[0]]).tobytes() for x in words), counts.astype(_KINDS[kinds[1]]).tobytes()])


def _unpacked(part: bytes) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    size, used, *kinds = np.frombuffer(part, dtype=np.int64, count=4).tolist()
    names, at, columns = np.frombuffer(part, dtype=np.uint64, count=used, offset=32), 32 + 8 * used, []
    for kind in [_KINDS[kinds[0]]] * MOST_WORDS + [_KINDS[kinds[1]]]:
        columns.append(np.frombuffer(part, dtype=kind, count=size, offset=at))
        at += size * np.dtype(kind).itemsize
    return columns[:-1], names, columns[-1].astype(np.int64)


def nodes(parts: list[bytes], heavy: np.ndarray, least: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The hashes of the words (0 after the last) and the counts of the nodes of two to four words in the subtrees of a
    group. Nodes that other groups may have too, those of very frequent words only, are returned whatever their count."""
    opened = [_unpacked(x) for x in parts]
    names, place = np.unique(np.concatenate([x[1] for x in opened] + [np.array([_NO_WORD], dtype=np.uint64)]), return_inverse=True)
    place = place.astype(np.int32)
    shift = np.cumsum([0, *(len(x[1]) for x in opened)])
    words = [np.concatenate([place[x[0][k] + at] for x, at in zip(opened, shift)]) for k in range(MOST_WORDS)]
    counts = np.concatenate([x[2] for x in opened])
    del opened
    frequent = np.isin(names, heavy)
    path, split = words[0], frequent[words[0]]
    found, totals = [], []
    for depth in range(1, MOST_WORDS):
        inside = words[depth] > 0  # place 0 is that of no word
        words, path, split, counts = [x[inside] for x in words], path[inside], split[inside], counts[inside]
        if not len(counts):
            break
        key = path.astype(np.int64) * len(names) + words[depth]
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) > 0]))
        sums = np.add.reduceat(counts[order], starts)
        split = split & frequent[words[depth]] if depth + 1 < MOST_WORDS else np.zeros(len(key), dtype=bool)
        heads = order[starts]
        keep = (sums >= least) | split[heads]
        found.append([names[x[heads[keep]]] if k <= depth else np.zeros(int(keep.sum()), dtype=np.uint64) for k, x in enumerate(words)])
        totals.append(sums[keep])
        node = np.empty(len(key), dtype=np.int64)
        node[order] = np.repeat(np.where(keep, np.cumsum(keep) - 1, -1), np.diff(np.append(starts, len(key))))
        active = node >= 0  # a branch that is too rare is followed no further
        words, path, split, counts = [x[active] for x in words], node[active], split[active], counts[active]
    if not found:
        return [np.empty(0, dtype=np.uint64)] * MOST_WORDS, np.empty(0, dtype=np.int64)
    return [np.concatenate([x[k] for x in found]) for k in range(MOST_WORDS)], np.concatenate(totals)


_PACKED = pa.schema([("group", pa.int32()), ("part", pa.binary())])
_WORDS = [f"w{k}" for k in range(MOST_WORDS)]


def _sent(texts: DataFrame, groups: Broadcast) -> DataFrame:
    """group, part: the suffixes of all texts by the group of their prefix, many in a row."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, chunk in _chunks(batch):
                words, names, counts = suffixes(chunk)
                if not len(counts):
                    continue
                group = groups.value.place(words, names)
                order = np.argsort(group, kind="stable")
                own, starts = np.unique(group[order], return_index=True)
                parts = [
                    _packed([x[order[i:j]] for x in words], names, counts[order[i:j]]) for i, j in zip(starts, [*starts[1:], len(order)])
                ]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(parts, pa.binary())], schema=_PACKED)

    return texts.mapInArrow(cut, "group int, part binary")


def phrase_counts(texts: DataFrame, counts: DataFrame, total: int, least: int = LEAST_COUNT, budget: int = GROUP_SUFFIXES) -> DataFrame:
    """w0 to w3 (hashes of the words, 0 after the last), f: the phrases of one to four words that occur so often.

    ``counts`` are the words' counts and ``total`` their sum.
    """
    groups = texts.sparkSession.sparkContext.broadcast(Groups.of(counts, total, budget))
    schema = pa.schema([(x, pa.int64()) for x in [*_WORDS, "f"]])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(parts: list[bytes]) -> pa.RecordBatch:
            words, sums = nodes(parts, groups.value.heavy, least)
            return pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64)) for x in words), pa.array(sums)], schema=schema)

        now, parts = None, []
        for batch in batches:
            for group, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                if group != now and parts:
                    yield result(parts)
                    parts = []
                now = group
                parts.append(part.as_py())
        if parts:
            yield result(parts)

    by_group = _sent(texts, groups).repartition("group").sortWithinPartitions("group")
    longer = by_group.mapInArrow(counted, ", ".join(f"{x} long" for x in [*_WORDS, "f"]))
    longer = longer.groupBy(*_WORDS).agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    none = F.lit(_NO_WORD).cast("long")
    single = counts.filter(F.col("count") >= least).select(F.col("hash").alias("w0"), *(none.alias(x) for x in _WORDS[1:]), F.col("count").alias("f"))
    return longer.unionByName(single)


def _part(phrase: str, start: int, size: int) -> Column:
    """Some successive words of a phrase, as a phrase."""
    none = F.lit(_NO_WORD).cast("long")
    return F.struct(*(F.col(f"{phrase}.w{start + k}").alias(x) if k < size else none.alias(x) for k, x in enumerate(_WORDS)))


def _by_size(choices) -> Column:
    """What ``choices`` gives for two, three and four words, by the size of ``phrase``."""
    out = F.when(F.col("size") == 2, choices(2))
    for size in range(3, MOST_WORDS + 1):
        out = out.when(F.col("size") == size, choices(size))
    return out


def scored(phrases: DataFrame) -> DataFrame:
    """phrase, size, a, l, r, score: every phrase of two words or more, at its cut of least score. All numbers are exact."""
    parts = phrases.select("phrase", "f")
    cuts = phrases.filter("size > 1").select("phrase", "size", F.col("f").alias("a"), F.explode(_by_size(lambda n: F.array(*(
        F.struct(F.lit(k).alias("k"), _part("phrase", 0, k).alias("left"), _part("phrase", k, n - k).alias("right")) for k in range(1, n)
    )))).alias("cut"))
    cuts = cuts.select("phrase", "size", "a", "cut.*")
    cuts = cuts.join(parts.select(F.col("phrase").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(parts.select(F.col("phrase").alias("right"), F.col("f").alias("r")), "right")
    exact = F.expr(f"(cast({SCALE} as decimal(38, 0)) * cast(a as decimal(20, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    best = F.min(F.struct(exact.cast("long").alias("score"), "k", "l", "r")).alias("best")
    return cuts.groupBy("phrase", "size", "a").agg(best).select("phrase", "size", "a", "best.l", "best.r", "best.score")


def covered(phrases: DataFrame) -> DataFrame:
    """phrase, most: the largest count of a longer phrase that a phrase lies in."""
    inner = phrases.filter("size > 2").select(F.col("f"), F.explode(_by_size(lambda n: F.array(*(
        _part("phrase", start, size) for size in range(2, n) for start in range(n - size + 1)
    )) if n > 2 else F.lit(None))).alias("phrase"))
    return inner.groupBy("phrase").agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, least: int = LEAST_COUNT, first: int = FIRST, cover: int = COVER, budget: int = GROUP_SUFFIXES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best collocations of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line breaks, and pieces into words at spaces and
    tabs. Phrases of two to four words that occur ``least`` times (a) are cut where ``floor(2000000 * a / (l + r))``
    is least, l and r being the counts of the parts (of equal ones after fewest words); that is their score. Phrases
    inside a longer one that has ``cover`` per cent of their count or more are dropped. n counts a language's words.
    The result is stored, without what led to it.
    """
    return stored_alone(docs.sparkSession, "collocations", lambda: _collocations(docs, least, first, cover, budget))


def _collocations(docs: DataFrame, least: int, first: int, cover: int, budget: int) -> DataFrame:
    texts = docs.select("lang", "text").filter("text is not null")
    counts = stored(word_counts(texts), "words")
    per_lang = counts.groupBy("lang").agg(F.sum("count").alias("n"))
    words, hashes, total = counts.agg(F.count(F.lit(1)), F.count_distinct("hash"), F.coalesce(F.sum("count"), F.lit(0))).first()
    if words != hashes:
        raise ValueError("two words have the same hash")
    found = phrase_counts(texts, counts, total, least, budget)
    size = sum((F.col(x) != _NO_WORD).cast("int") for x in _WORDS)
    phrases = stored(found.select(F.struct(*_WORDS).alias("phrase"), size.alias("size"), "f"), "phrases")
    kept = (
        scored(phrases).join(covered(phrases), "phrase", "left")
        .filter(F.col("most").isNull() | (F.lit(100).cast("decimal(20, 0)") * F.col("most") < F.lit(cover).cast("decimal(20, 0)") * F.col("a")))
    )
    spelt = counts.filter(F.col("count") >= least).select("hash", "lang", "word")
    each = kept.select("*", F.posexplode(F.array(*(F.col(f"phrase.{x}") for x in _WORDS))).alias("place", "hash")).filter(F.col("hash") != _NO_WORD)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ")
    named = each.join(spelt, "hash").groupBy("phrase", "a", "l", "r", "score").agg(F.min("lang").alias("lang"), text.alias("text"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= first)
    return ranked.join(per_lang, "lang").select("lang", "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
