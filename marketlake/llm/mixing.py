"""Mixing sources to target weights by min-cost flow, where a document may belong to several sources.

1. Documents are grouped by membership pattern, the set of sources that they belong to, and their words are added up.
2. A flow network leads from each pattern, over its sources, to the sources' quotas. A pattern gives its words once for
   nothing, a second time at a cost of 1 a word, a third time at 2, and so on: convex costs, so the flow of most words
   and least cost repeats nothing before all has been used once. It is found by successive shortest paths on these
   aggregates.
3. Each pattern lays out its documents in the order of a seeded hash, lap after lap, and each source takes the stretch of
   that line that the flow gives it. A document on the border of two stretches gives a part of its words to each.

A quota is the source's target in whole words, so a source's taken words differ from its target by less than one.

The borders are found by refinement: the words of 4096 ranges of the hash are added up, then those of 4096 ranges inside
the range with the border, then single hashes, and for rows of one hash (repeats of a document) the written parts of the
table and the rows in one. A border is one row for each source of a pattern, so no task sorts a pattern, and hot
patterns are sums of map tasks.

What reaches the driver: a row for each pattern and each border (``most_patterns`` bounds both; more is an error). They
are settings of a mix, not data that grows with the documents.

Defined cases: a null source is a source of its own, after all others; documents without words are in the result with 0
words taken; null texts have none; rows that repeat a document are documents each; the same rows give the same result,
in any order of the input; a document without sources (an empty or null list) is not taken; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.words import joined_texts, row_ranges, word_bounds
from marketlake.operators.joins import join_dimension
from marketlake.session import stored, stored_alone

MOST_COPIES = 3
SEED = 20240611
MOST_PATTERNS = 100_000
_CHUNK_BYTES = 4 << 20
_RANGE_BITS = 12
_ROW_BITS = 33  # monotonically_increasing_id puts the partition above


@dataclass
class Arc:
    """An arc of a flow network; ``back`` is its reverse."""

    to: int
    room: int
    cost: int
    back: Arc | None = field(default=None, repr=False)


class Network:
    """A flow network with whole capacities and costs."""

    def __init__(self, size: int):
        self.arcs: list[list[Arc]] = [[] for _ in range(size)]

    def add(self, start: int, end: int, room: int, cost: int = 0) -> Arc:
        arc, back = Arc(end, room, cost), Arc(start, 0, -cost)
        arc.back, back.back = back, arc
        self.arcs[start].append(arc)
        self.arcs[end].append(back)
        return arc

    def send(self, source: int, sink: int) -> int:
        """Send as much as possible at least cost, by shortest paths in the residual network; costs are not negative."""
        price, sent = [0] * len(self.arcs), 0
        while True:
            far: dict[int, int] = {source: 0}
            last: dict[int, Arc] = {}
            heap, done = [(0, source)], set()
            while heap:
                distance, node = heapq.heappop(heap)
                if node in done:
                    continue
                done.add(node)
                for arc in self.arcs[node]:
                    if arc.room:
                        there = distance + arc.cost + price[node] - price[arc.to]
                        if there < far.get(arc.to, there + 1):
                            far[arc.to], last[arc.to] = there, arc
                            heapq.heappush(heap, (there, arc.to))
            if sink not in far:
                return sent
            most = far[sink]
            for node in range(len(price)):
                price[node] += min(far.get(node, most), most)
            path, node = [], sink
            while node != source:
                path.append(last[node])
                node = last[node].back.to
            flow = min(arc.room for arc in path)
            for arc in path:
                arc.room -= flow
                arc.back.room += flow
            sent += flow


def targets(sizes: dict, weights: dict, total: int | None = None, copies: int = MOST_COPIES) -> dict:
    """The words that each source is to give, as exact fractions: ``total`` (all words) by weight, but no more than
    ``copies`` times the source; what is over goes to the other sources by weight."""
    left = Fraction(sum(sizes.values()) if total is None else total)
    out, open_ = {x: Fraction(0) for x in sizes}, {x for x in sizes if weights[x] > 0}
    while open_:
        share = left / sum(Fraction(weights[x]) for x in open_)
        full = {x for x in open_ if share * Fraction(weights[x]) > copies * sizes[x]}
        if not full:
            return out | {x: share * Fraction(weights[x]) for x in open_}
        for x in full:
            out[x] = Fraction(copies * sizes[x])
            left -= out[x]
        open_ -= full
    return out


def routed(patterns: dict[tuple, int], quotas: dict, copies: int = MOST_COPIES) -> dict[tuple, dict]:
    """The words that each pattern (a tuple of sources, with its words) gives to each of its sources. Patterns that share
    no source, directly or through others, are networks of their own."""
    root = {x: x for x in quotas}

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for pattern in patterns:
        for other in pattern[1:]:
            root[top(other)] = top(pattern[0])
    parts: dict = {}
    for pattern in patterns:
        if pattern:
            parts.setdefault(top(pattern[0]), []).append(pattern)
    out: dict[tuple, dict] = {x: {} for x in patterns}
    for own in parts.values():
        names = list(dict.fromkeys(x for pattern in own for x in pattern))
        place = {x: 2 + len(own) + k for k, x in enumerate(names)}
        net = Network(2 + len(own) + len(names))
        for x in names:
            net.add(place[x], 1, quotas[x])
        used = {}
        for k, pattern in enumerate(own):
            for copy in range(copies):
                net.add(0, 2 + k, patterns[pattern], copy)
            for x in pattern:
                used[pattern, x] = net.add(2 + k, place[x], copies * patterns[pattern])
        net.send(0, 1)
        for (pattern, x), arc in used.items():
            if arc.back.room:
                out[pattern][x] = arc.back.room
    return out


def word_count(text: Column) -> Column:
    """The words of a text (runs of characters other than space and \\x09-\\x0D); 0 for null."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        out = [np.empty(0, dtype=np.int64)]
        for start, end in row_ranges(texts, _CHUNK_BYTES):
            data, places = joined_texts(texts.slice(start, end - start))
            out.append(np.diff(np.searchsorted(word_bounds(data)[0], places)))
        return pa.array(np.concatenate(out))

    return count(text)


def _levels() -> list[Column]:
    """What a border is found by, coarse to fine."""
    mask = F.lit((1 << _RANGE_BITS) - 1).cast("long")
    high = F.shiftrightunsigned("order", 64 - _RANGE_BITS)
    next_ = F.shiftrightunsigned("order", 64 - 2 * _RANGE_BITS).bitwiseAND(mask)
    return [high, next_, F.col("order"), F.shiftright("row", _ROW_BITS), F.col("row")]


_KEYS = [f"k{k}" for k in range(5)]


def borders(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """Where the words of each pattern, in the order of ``_KEYS``, reach a number.

    rows: pattern, size and the keys; asked: id, pattern, rest (a number below the pattern's words). Returns id, rest, the
    keys of the row with that word and ``part``, its words before it. One border is asked for by few rows, so a
    window over the sums of one level for one id has at most 4096 rows, or those of one hash range.
    """
    state = asked.select("id", "pattern", F.col("rest").alias("part"))
    for k, key in enumerate(_KEYS):
        inside = join_dimension(rows, stored(state, "mix-borders"), ["pattern", *_KEYS[:k]])
        sums = inside.groupBy("id", "pattern", *_KEYS[:k], "part", key).agg(F.sum("size").alias("size")).filter("size > 0")
        order = Window.partitionBy("id").orderBy(key)
        upto = sums.withColumn("upto", F.sum("size").over(order))
        before = F.col("upto") - F.col("size")
        found = upto.filter((before <= F.col("part")) & (F.col("part") < F.col("upto")))
        state = found.select("id", "pattern", *_KEYS[: k + 1], (F.col("part") - before).alias("part"))
    return state


def _taken(number: int) -> Column:
    """The words of a row before border ``number`` (columns with that suffix) on its pattern's line."""
    part = F.lit(0).cast("long")
    for key in reversed(_KEYS):
        mine, there = F.col(key), F.col(f"{key}_{number}")
        part = F.when(mine < there, F.col("size")).when(mine > there, F.lit(0).cast("long")).otherwise(
            part if key != _KEYS[-1] else F.col(f"part_{number}")
        )
    return F.col(f"laps_{number}") * F.col("size") + F.when(F.col(f"part_{number}").isNull(), F.lit(0).cast("long")).otherwise(part)


def mix(
    docs: DataFrame, sources: Column, weights, size: Column, identity: Sequence[str] = ("doc_id",), total: int | None = None,
    copies: int = MOST_COPIES, seed: int = SEED, most_patterns: int = MOST_PATTERNS,
) -> DataFrame:
    """A row for every document: the columns of ``identity``, size, sources, ``taken`` (words the mix takes, repeats
    counted) and ``by_source`` (source, target, source_size, words for each of its sources).

    ``sources`` is the list of a document's sources, ``size`` its words. ``weights`` gives the weights of a list of all
    sources. The result is stored, without what led to it.
    """
    return stored_alone(docs.sparkSession, "mix", lambda: _mix(docs, sources, weights, size, identity, total, copies, seed, most_patterns))


def _in_order(source: str | None) -> tuple:
    return source is None, (source or "").encode()


def _mix(docs, sources, weights, size, identity, total, copies, seed, most_patterns) -> DataFrame:
    spark = docs.sparkSession
    flat = F.to_json(F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>")))))
    own = docs.select(F.struct(*identity).alias("own"), flat.alias("pattern"), size.alias("size"), F.col("text").alias("text"))
    order = F.xxhash64(F.lit(seed), "own", "pattern", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    rows = stored(own.withColumn("order", order).drop("text").withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    listed = F.from_json("pattern", "array<string>")
    sums = rows.groupBy("pattern").agg(F.sum("size").alias("size")).select("pattern", listed.alias("sources"), "size")
    found = sums.limit(most_patterns + 1).collect()
    if len(found) > most_patterns:
        raise ValueError(f"more than {most_patterns} membership patterns")
    names = {x.pattern: tuple(x.sources) for x in found}
    words = {tuple(x.sources): x.size for x in found}
    sizes: dict = {}
    for pattern, count in words.items():
        for x in pattern:
            sizes[x] = sizes.get(x, 0) + count
    ordered = sorted(sizes, key=_in_order)
    wanted = targets(sizes, dict(zip(ordered, weights(ordered))), sum(words[x] for x in words if x) if total is None else total, copies)
    flow = routed(words, {x: min(round(t), copies * sizes[x]) for x, t in wanted.items()}, copies)

    # Borders on each pattern's line: where each of its sources ends.
    ends, info = [], []
    most = max([len(x) for x in names.values()], default=0)
    for pattern, own_names in names.items():
        place = 0
        for number, x in enumerate(own_names):
            place += flow[own_names].get(x, 0)
            lap, rest = divmod(place, words[own_names]) if words[own_names] else (0, 0)
            ends.append((f"{number}:{pattern}", pattern, number, lap, rest))
            info.append((pattern, number, x, float(wanted[x]), sizes[x], lap))
    table = spark.createDataFrame(ends, "id string, pattern string, number int, laps long, rest long")
    keyed = rows.select("own", "pattern", "size", *(x.alias(k) for k, x in zip(_KEYS, _levels())))
    cut = stored(borders(keyed, table.filter("rest > 0").select("id", "pattern", "rest")), "mix-cuts")
    about = spark.createDataFrame(info, "pattern string, number int, source string, target double, source_size long, laps long")
    about = about.join(cut.withColumn("number", F.split("id", ":")[0].cast("int")).drop("id"), ["pattern", "number"], "left")
    facts = F.struct("number", "source", "target", "source_size", "laps", *_KEYS, "part")
    per_pattern = about.groupBy("pattern").agg(F.array_sort(F.collect_list(facts)).alias("borders"))
    joined = join_dimension(keyed, stored(per_pattern, "mix-patterns"), "pattern", "left")
    for number in range(most):
        border = F.get("borders", F.lit(number))
        joined = joined.withColumns({f"{x}_{number}": border[x] for x in ("laps", *_KEYS, "part")})
    entries, before = [], F.lit(0).cast("long")
    for number in range(most):
        border, upto = F.get("borders", F.lit(number)), _taken(number)
        entries.append(F.struct(border["source"].alias("source"), border["target"].alias("target"), border["source_size"].alias("source_size"), (upto - before).alias("words")))
        before = upto
    kind = "array<struct<source:string,target:double,source_size:bigint,words:bigint>>"
    every = F.slice(F.array(*entries), F.lit(1), F.coalesce(F.size("borders"), F.lit(0))) if entries else F.array().cast(kind)
    out = joined.select("own.*", "size", F.coalesce(every, F.array().cast(kind)).alias("by_source"))
    taken = F.aggregate("by_source", F.lit(0).cast("long"), lambda total, x: total + x["words"])
    return out.select(*identity, "size", F.transform("by_source", lambda x: x["source"]).alias("sources"), taken.alias("taken"), "by_source")


def in_turn(weights: Sequence[int]):
    """Weights that the sources, by code point and null last, get one after the other and again from the start."""
    return lambda names: [weights[k % len(weights)] for k in range(len(names))]
