"""Near duplicates by SetSketch registers: band, estimate jointly by likelihood, verify on the full sets.

A text's set is its distinct 5-word shingles. Register i of its sketch is floor(1 - log_b(x)), cut off at 0 and
q + 1, where x is the least of exponential variates that hash i gives to the shingles: an exponentially spaced,
truncated minimum. Sketches of two sets merge by the larger of each register (``merged``), and two registers are
equal with a probability close to the Jaccard similarity (b is close to 1).

1. Texts with equal sets form a class; from here on a class is one node, whatever its number of copies.
2. Registers are banded. With 32 bands of 4, two sets of similarity 0.75 share no band with odds of 5e-6.
3. Within a bucket nodes are tied if the joint estimate of their sketches is not far below the threshold. Pairs are judged by
   the task that has the bucket (a large one is dealt into tiles) from the registers alone, but for those that are near
   to the same node already, and only a forest of ties is returned: boilerplate that many texts share makes
   buckets, but no ties, and a group of copies costs one comparison a node.
4. Each component is dealt into tiles of bounded rows and bytes, and each pair of tiles is one task's work: register
   counts for all pairs at once, the likelihood estimate for those near enough, and the exact sets for those that
   are not yet connected. It returns a spanning forest of the verified links.
5. Components of these links are the groups.

Estimates that decide have a margin of five standard deviations, and links are always verified, so none is
false, and a link is lost with odds below 1e-5.

Defined cases: texts that are null or without words have no shingles and link with nothing; a row with a null
id links with nothing, has a null component and is kept; rows that repeat an id and a text are copies; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.components import components
from marketlake.llm.memory import tidy
from marketlake.llm.skew import apart
from marketlake.llm.words import SHINGLE_WORDS, mixed, shingle_set
from marketlake.session import stored, stored_alone

BANDS, BAND_ROWS = 32, 4
REGISTERS = BANDS * BAND_ROWS
BASE, RATE, LIMIT = 1.001, 20.0, 2**16 - 2  # b, a and q of the sketch
SIMILARITY = 75  # per cent
MARGIN = 0.19  # five standard deviations of an estimate near 0.75 from 128 registers
TILE_NODES, TILE_BYTES = 512, 8 << 20
BUCKET_NODES = 1024  # of a bucket in a tile
_TASK_NODES = 1024  # of small buckets in a task
_MANY = 4  # pairs to verify for each node, beyond which all are verified at once

_SEEDS = mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mixed(_SEEDS) | np.uint64(1)


def registers(items: np.ndarray, block: int = 512) -> np.ndarray:
    """The sketch of a set of 64-bit hashes: one 16-bit register per hash function."""
    least = np.full(REGISTERS, 2**64 - 1, dtype=np.uint64)
    for start in range(0, len(items), block):
        hashed = (items[start:start + block, None] ^ _SEEDS) * _FACTORS
        hashed ^= hashed >> np.uint64(32)
        hashed *= np.uint64(0xD6E8FEB86659FD93)
        np.minimum(least, hashed.min(axis=0), out=least)
    if not len(items):
        return np.zeros(REGISTERS, dtype=np.uint16)
    spaced = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(spaced) / np.log(BASE)), 0, LIMIT + 1).astype(np.uint16)


def merged(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets, from their sketches."""
    return np.maximum(first, second)


def joint_estimate(
    larger: np.ndarray, smaller: np.ndarray, sizes: np.ndarray, other_sizes: np.ndarray, steps: int = 18
) -> np.ndarray:
    """Jaccard similarities of largest likelihood, given how many registers of the first set are larger and
    smaller than the second's, and both set sizes. The log-likelihood is concave: ternary search."""
    u = sizes / (sizes + other_sizes)
    v = 1 - u
    equal = REGISTERS - larger - smaller

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        above, below = chance(u - v * j), chance(v - u * j)
        return (larger * np.log(above + 1e-300) + smaller * np.log(below + 1e-300)
                + equal * np.log(np.maximum(1 - above - below, 0) + 1e-300))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(steps):
        third = (high - low) / 3
        left, right = low + third, high - third
        better = likelihood(left) < likelihood(right)
        low, high = np.where(better, left, low), np.where(better, high, right)
    return (low + high) / 2


def sketches(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (a digest of the set) and registers of every document."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("registers", pa.binary()),
    ])

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, rows = [], [], []
            for text in batch.column(2):
                items = shingle_set(text.as_py(), shingle_words)
                sizes.append(len(items))
                keys.append(blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None)
                rows.append(registers(items).astype("<u2").tobytes() if len(items) else None)
            columns = [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        tidy(sketched), "doc_id long, text_key long, n_shingles long, set_key binary, registers binary"
    )


def band_keys(column: str = "registers"):
    """An array with one hash per band."""
    size = 2 * BAND_ROWS
    return F.array(*(F.xxhash64(F.lit(i), F.substring(column, 1 + i * size, size)) for i in range(BANDS)))


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype="<u2").reshape(len(rows), -1)


def _near_enough(threshold: float):
    @F.pandas_udf("boolean")
    def near(first: pd.Series, second: pd.Series, size: pd.Series, other: pd.Series) -> pd.Series:
        a, b = _matrix(first), _matrix(second)
        estimate = joint_estimate((a > b).sum(axis=1), (a < b).sum(axis=1), size.to_numpy(float), other.to_numpy(float))
        return pd.Series(estimate >= threshold)

    return near


def _ties(classes: DataFrame, similarity: int) -> DataFrame:
    """a, b: nodes of one bucket whose estimate is near the threshold, as a forest for every bucket. Pairs of a bucket of
    two are joined once for all buckets that they share."""
    banded = classes.select("set_key", F.explode(band_keys()).alias("band"))
    buckets = banded.groupBy("band").agg(F.min("set_key").alias("a"), F.count(F.lit(1)).alias("size"))
    held = stored(banded.join(apart(buckets.filter("size > 1"), "band"), "band"), "bucketed")
    side = classes.select("set_key", "registers", "n_shingles")
    pairs = held.filter("size = 2 and a != set_key").select("a", F.col("set_key").alias("b")).distinct()
    pairs = pairs.join(side.toDF("a", "left", "left_size"), "a").join(side.toDF("b", "right", "right_size"), "b")
    near = pairs.filter(_near_enough(similarity / 100 - MARGIN)("left", "right", "left_size", "right_size"))
    return near.select("a", "b").unionByName(_ties_within(held.filter("size > 2"), side, similarity))


def _ties_within(held: DataFrame, side: DataFrame, similarity: int) -> DataFrame:
    rows = held.select("band", "set_key", F.ceil(F.col("size") / BUCKET_NODES).cast("int").alias("tiles"))
    tasks = max(1, -(-rows.count() // _TASK_NODES))
    tile = F.pmod(F.xxhash64("set_key"), F.col("tiles")).cast("int")
    dealt = (
        rows.join(side, "set_key").withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumn("task", F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("band"), F.lit(tasks))).otherwise(F.col("band")))
        .withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))
        .select("task", "low", "high", "band", "tile", "set_key", "n_shingles", "registers")
    )
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def judged(table: pa.Table) -> pa.Table:
        table = table.sort_by([("band", "ascending"), ("set_key", "ascending")]).combine_chunks()
        band, own = table["band"].to_numpy(), table["tile"].to_numpy()
        low, high = (int(table[x][0].as_py()) for x in ("low", "high"))
        sizes = table["n_shingles"].to_numpy().astype(np.float64)
        sketch = np.frombuffer(b"".join(table["registers"].to_pylist()), dtype="<u2").reshape(-1, REGISTERS)
        starts = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1], [True]]))
        ties = []
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
            left = start + np.flatnonzero(own[start:end] == low)
            right = left if low == high else start + np.flatnonzero(own[start:end] == high)
            if len(left) and len(right) and end - start > 1:
                ties += near_forest(sketch, sizes, left, right, similarity)
        a, b = (pa.array([x[k] for x in ties], pa.int64()) for k in (0, 1))
        return pa.Table.from_arrays([table["set_key"].take(a), table["set_key"].take(b)], schema=schema)

    return dealt.groupBy("task", "low", "high").applyInArrow(judged, "a binary, b binary").distinct()


def near_forest(sketch: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: int) -> list[tuple[int, int]]:
    """Ties between rows ``left`` and rows ``right`` (or among them, if they are the same): a forest that connects all
    whose estimates are near the threshold. Rows that are near the first of ``left`` are connected by it and are not
    compared with each other."""
    pivot = left[:1]
    ties = [(int(x), int(y)) for x, y in zip(*_near_pairs(sketch, sizes, pivot, right, similarity)) if x != y]
    by_right = np.isin(right, [y for _, y in ties]) | (right == pivot[0])
    by_left = by_right
    if left is not right:
        inner = [(int(x), int(y)) for x, y in zip(*_near_pairs(sketch, sizes, pivot, left[1:], similarity))]
        by_left = np.isin(left, [y for _, y in inner]) | (left == pivot[0])
        ties += inner
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = x = root.get(up, up)
        return x

    forest = []
    for x, y in _chain(ties, _near_pairs(sketch, sizes, left[~by_left], right, similarity), _near_pairs(sketch, sizes, left[by_left], right[~by_right], similarity)):
        if (p := top(x)) != (q := top(y)):
            root[max(p, q)] = min(p, q)
            forest.append((x, y))
    return forest


def _chain(first: list[tuple[int, int]], *rest: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, int]]:
    yield from first
    for x, y in rest:
        yield from zip(x.tolist(), y.tolist())


def _near_pairs(sketch: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows whose estimate is near the threshold. Sets too different in size cannot reach it; pairs with half
    of the registers equal or fewer are out at once (a pair of similarity 0.75 has so few with odds of 1e-9)."""
    found = []
    if len(left) and len(right):
        other = sketch[right]
        block = max(1, (1 << 23) // (REGISTERS * len(right)))
        for start in range(0, len(left), block):
            rows = left[start:start + block]
            equal = np.count_nonzero(sketch[rows][:, None, :] == other[None, :, :], axis=2)
            small, large = np.minimum(sizes[rows][:, None], sizes[right]), np.maximum(sizes[rows][:, None], sizes[right])
            i, j = np.nonzero((2 * equal > REGISTERS) & (100 * small >= similarity * large))
            x, y = rows[i], right[j]
            larger, smaller = (sketch[x] > sketch[y]).sum(axis=1), (sketch[x] < sketch[y]).sum(axis=1)
            near = joint_estimate(larger, smaller, sizes[x], sizes[y]) >= similarity / 100 - MARGIN
            found.append((x[near], y[near]))
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def linked(names: list, sketch: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: int) -> list[tuple]:
    """A spanning forest of the verified links between rows ``left`` and rows ``right`` (or among them, if they
    are the same), nearest by estimate first."""
    sizes = np.array([len(x) for x in sets], dtype=np.float64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    same = left is right
    block = max(1, (1 << 22) // (REGISTERS * max(1, len(right))))
    for start in range(0, len(left), block):
        rows = left[start:start + block]
        small = np.minimum(sizes[rows][:, None], sizes[right]) * 100 >= similarity * np.maximum(sizes[rows][:, None], sizes[right])
        if same:
            small &= np.arange(start, start + len(rows))[:, None] < np.arange(len(right))
        i, j = np.nonzero(small)
        a, b = rows[i], right[j]
        for at in range(0, len(a), 1 << 14):
            x, y = a[at:at + (1 << 14)], b[at:at + (1 << 14)]
            larger, smaller = (sketch[x] > sketch[y]).sum(axis=1), (sketch[x] < sketch[y]).sum(axis=1)
            estimate = joint_estimate(larger, smaller, sizes[x], sizes[y])
            near = estimate >= similarity / 100 - MARGIN
            found.append((x[near], y[near], estimate[near]))
    if not found:
        return []
    a, b, estimate = (np.concatenate(x) for x in zip(*found))
    common = None
    if len(a) > _MANY * len(names):  # exact sizes of all intersections at once, then only links are left
        common = _intersections(sets, left, right)
        place = np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=np.int64)
        place[0][left], place[1][right] = np.arange(len(left)), np.arange(len(right))
        both = common[place[0][a], place[1][b]]
        link = 100 * both >= similarity * (sizes[a] + sizes[b] - both)
        a, b, estimate = a[link], b[link], estimate[link]
    root = list(range(len(names)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    links = []
    for k in np.argsort(-estimate, kind="stable"):
        x, y = int(a[k]), int(b[k])
        p, q = top(x), top(y)
        if p != q:
            if common is None:
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if common is not None or 100 * both >= similarity * (len(sets[x]) + len(sets[y]) - both):
                root[max(p, q)] = min(p, q)
                links.append((names[x], names[y]))
    return links


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, block: int = 4096) -> np.ndarray:
    """The size of the intersection of each set ``left`` with each set ``right``, by products of their
    membership matrices; items of a single set are left out, items are taken block by block."""
    rows = np.union1d(left, right)
    items = np.concatenate([sets[i] for i in rows])
    owner = np.repeat(np.arange(len(rows)), [len(sets[i]) for i in rows])
    _, code, count = np.unique(items, return_inverse=True, return_counts=True)
    code, owner, several = code[count[code] > 1], owner[count[code] > 1], np.flatnonzero(count > 1)
    code = np.searchsorted(several, code)
    out = np.zeros((len(left), len(right)), dtype=np.float32)  # exact below 2**24
    i, j = np.searchsorted(rows, left), np.searchsorted(rows, right)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    for start in range(0, len(several), block):
        part = slice(*np.searchsorted(code, [start, start + block]))
        member = np.zeros((len(rows), min(block, len(several) - start)), dtype=np.float32)
        member[owner[part], code[part] - start] = 1
        out += member[i] @ member[j].T
    return out


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id that links reach), kept (whether it is the own id), and
    text_key (a hash of the text, which tells rows of one id apart). The result is stored, without what led to it."""
    return stored_alone(docs.sparkSession, "near", lambda: _near_duplicates(docs, similarity, shingle_words))


def _near_duplicates(docs: DataFrame, similarity: int, shingle_words: int) -> DataFrame:
    rows = stored(sketches(docs, shingle_words), "sketches")
    classes = stored(
        rows.filter("n_shingles > 0 and doc_id is not null").groupBy("set_key")
        .agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")),
        "classes",
    )
    groups = stored(components(_ties(classes, similarity)), "candidates").withColumnRenamed("node", "set_key")
    members = groups.join(classes, "set_key")
    nodes, size = members.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("n_shingles") * 8), F.lit(0))).first()
    tasks = max(1, -(-nodes // (TILE_NODES // 2)), -(-size // (TILE_BYTES // 2)))
    deal = members.groupBy("component").agg(F.count(F.lit(1)).alias("nodes"), F.sum(F.col("n_shingles") * 8).alias("bytes")).select(
        "component", F.ceil(F.greatest(F.col("nodes") / TILE_NODES, F.col("bytes") / TILE_BYTES)).cast("int").alias("tiles")
    )
    deal = apart(deal, "component")
    # Ids that are repeated with other texts are told apart by the digest; copies are dropped.
    wanted = members.join(deal, "component").select("set_key", "component", "tiles", "registers", F.col("first_id").alias("doc_id"))
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id")
    kinds = "set_key binary, component binary, tiles int, registers binary, items binary"
    schema = pa.schema([("set_key", pa.binary()), ("component", pa.binary()), ("tiles", pa.int32()), ("registers", pa.binary()), ("items", pa.binary())])

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x.as_py(), shingle_words).tobytes() for x in batch.column(0)]
            right = pa.array([blake2b(x, digest_size=16).digest() == k.as_py() for x, k in zip(sets, batch.column(1))], pa.bool_())
            columns = [batch.column(i) for i in range(1, 5)] + [pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays([x.filter(right) for x in columns], schema=schema)

    sets = texts.select("text", "set_key", "component", "tiles", "registers").mapInArrow(tidy(with_sets), kinds).dropDuplicates(["set_key"])
    tile = F.pmod(F.xxhash64("set_key"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    dealt = (
        sets.withColumn("tile", tile).withColumn("other", other)
        # Small components share a task; a pair of tiles of a large one has its own.
        .withColumn("task", F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("component"), F.lit(tasks))).otherwise(F.xxhash64("component")))
        .withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, group in frame.groupby("component", sort=False):
            if len(group) > 1:
                sketch = _matrix(group["registers"])
                sets = [np.frombuffer(x, dtype=np.uint64) for x in group["items"]]
                tiles, low, high = group["tile"].to_numpy(), group["low"].iat[0], group["high"].iat[0]
                left, right = np.flatnonzero(tiles == low), np.flatnonzero(tiles == high)
                links += linked(list(group["set_key"]), sketch, sets, left, left if low == high else right, similarity)
        return pd.DataFrame(links, columns=["a", "b"])

    links = dealt.groupBy("task", "low", "high").applyInPandas(compare, "a binary, b binary")
    return _with_components(rows, classes, components(links))


def _with_components(rows: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    named = classes.select("set_key", "first_id").join(groups.withColumnRenamed("node", "set_key"), "set_key", "left")
    named = stored(named.select("set_key", "first_id", F.coalesce("component", "set_key").alias("group")), "groups")
    least = apart(named.groupBy("group").agg(F.min("first_id").alias("component_id")), "group")
    owner = named.join(least, "group").select("set_key", "component_id")
    found = rows.select("doc_id", "text_key", "n_shingles", "set_key").join(owner, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), "text_key").withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def without_near_duplicates(docs: DataFrame, similarity: int = SIMILARITY, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One document of each group, that of the smallest id, with all columns. Of rows that repeat this id in the
    group one stays; rows with a null id, which link with nothing, all stay."""
    found = near_duplicates(docs, similarity, shingle_words)
    gone = found.filter("not kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text")).distinct()
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"))
    same = (F.col("_row.doc_id").cast("long") == F.col("_id")) & (F.xxhash64("_row.text") == F.col("_text"))
    left = rows.join(gone, same, "left_anti")
    again = found.filter("kept and doc_id is not null").groupBy("doc_id", "component_id").agg(F.count(F.lit(1)).alias("rows"))
    again = stored(again.filter("rows > 1").select(F.col("doc_id").alias("_id")).distinct(), "repeated")
    if again.isEmpty():
        return left.select("_row.*")
    repeats = F.col("_row.doc_id").cast("long") == F.col("_id")
    # Kept rows of one id are copies or near copies of each other, or of other groups: told apart by their component.
    group = found.filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), "component_id", "n_shingles").distinct()
    named = left.join(again, repeats, "left_semi").join(group, same)
    grouped = F.when(F.col("n_shingles") > 0, F.lit(0)).otherwise(F.col("_text"))  # texts without words are no group
    one = named.withColumn("_group", grouped).dropDuplicates(["_id", "component_id", "_group"])
    return left.join(again, repeats, "left_anti").unionByName(one.select("_row")).select("_row.*")
