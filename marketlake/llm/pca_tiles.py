"""Near-equal embeddings by PCA-ordered, tiled comparison.

Vectors are compared only under equal labels (and equal lengths). Equal vectors of a label form a class and are
compared once. Unit vectors are rotated to their principal axes, so that the leading coordinates hold most of
the length. Two unit vectors with cosine t or more lie within sqrt(2 - 2t) of each other, hence also in each
coordinate: the first two coordinates form a grid of that width, and only a cell and its neighbours need
comparing. Cells are dealt into tiles of bounded rows by a hash, so a label or cell that holds most rows is many
tasks, each with two tiles.

Inside a pair of tiles, products of the leading coordinates are added up block by block; a pair is given up as
soon as its sum plus the product of the two remaining norms stays under the threshold. The cosine of what is
left is computed from the original vectors in double precision. A task returns the number of links of each
vector and ties each to the smallest vector that its links reach there, not the pairs.

Defined cases: a vector that is null, empty, zero, or holds a null or non-finite component, and one with a null label or
a null id, links with nothing (n_links 0; its component is its own id); rows that repeat a vector under a
label are links of each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.components import components
from marketlake.llm.skew import apart
from marketlake.operators.joins import join_dimension
from marketlake.session import stored, stored_alone

SIMILARITY = 0.98
TILE_ROWS = 1024
SLACK = 1e-9  # rounding of bounds; the last word is the cosine itself
_PAIRS = 1 << 16
_FORWARD = [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]  # each pair of neighbouring cells once


def _keyed(vectors: DataFrame) -> DataFrame:
    """vec_id, node (a digest of label and vector, null for rows that link with nothing), label, values (doubles)."""
    schema = pa.schema([("vec_id", pa.int64()), ("node", pa.binary()), ("label", pa.string()), ("values", pa.binary())])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, values = [], []
            for vec_id, vector, label in zip(*batch.columns):
                found = None
                if vec_id.is_valid and vector.is_valid and label.is_valid and vector.values.null_count == 0:
                    found = np.asarray(vector.values.to_numpy(zero_copy_only=False), dtype="<f8") + 0.0  # no negative zero
                    if not (len(found) and np.isfinite(found).all() and found.any()):
                        found = None
                data = None if found is None else found.tobytes()
                values.append(data)
                nodes.append(None if data is None else blake2b(data, digest_size=16, key=label.as_py().encode()[:64], salt=_salt(label.as_py())).digest())
            columns = [batch.column(0), pa.array(nodes, pa.binary()), batch.column(2), pa.array(values, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return vectors.select(
        F.col("vec_id").cast("long"), "embedding", F.col("label").cast("string").alias("label")
    ).mapInArrow(keyed, "vec_id long, node binary, label string, values binary")


def _salt(label: str) -> bytes:
    return blake2b(label.encode(), digest_size=16).digest()


def _unit(values: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(values), width))
    for row, data in zip(out, values):
        found = np.frombuffer(data, dtype="<f8")
        found = found / np.abs(found).max()  # no overflow or underflow of squares
        row[:len(found)] = found / np.linalg.norm(found)
    return out


def principal_axes(classes: DataFrame, width: int) -> np.ndarray:
    """Orthonormal axes, as columns, by falling second moment of all unit vectors; shorter ones are padded."""

    def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for frame in frames:
            unit = _unit(frame["values"], width)
            total += unit.T @ unit
        yield pd.DataFrame({"row": range(width), "sums": list(total)})

    sums = classes.select("values").mapInPandas(moments, "row int, sums array<double>")
    cells = sums.select("row", F.posexplode("sums").alias("column", "value")).groupBy("row", "column").agg(F.sum("value").alias("value"))
    matrix = np.zeros((width, width))
    for row, column, value in cells.collect():  # width squared numbers, whatever the number of vectors
        matrix[row, column] = value
    _, axes = np.linalg.eigh((matrix + matrix.T) / 2)
    return np.ascontiguousarray(axes[:, ::-1])


def close_pairs(left: np.ndarray, right: np.ndarray, threshold: float, among: bool = False, block: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Rows i of left and j of right (both rotated unit vectors) whose product may reach the threshold;
    with ``among`` only i < j."""
    width = left.shape[1]
    tails = [np.sqrt((x[:, ::-1] ** 2).cumsum(axis=1)[:, ::-1]) for x in (left, right)]
    tails = [np.column_stack([x, np.zeros(len(x))]) for x in tails]
    done = min(block, width)
    sums = left[:, :done] @ right[:, :done].T
    while True:
        alive = sums + np.outer(tails[0][:, done], tails[1][:, done]) >= threshold - SLACK
        if among:
            alive &= np.arange(len(left))[:, None] < np.arange(len(right))
        if done == width or alive.mean() < 0.05:
            break
        step = min(done + block, width)
        sums += left[:, done:step] @ right[:, done:step].T
        done = step
    i, j = np.nonzero(alive)
    sums = sums[i, j]
    while done < width and len(i):
        step = min(done + block, width)
        for at in range(0, len(i), _PAIRS):
            part = slice(at, at + _PAIRS)
            sums[part] += np.einsum("ij,ij->i", left[i[part], done:step], right[j[part], done:step])
        done = step
        keep = sums + tails[0][i, done] * tails[1][j, done] >= threshold - SLACK
        i, j, sums = i[keep], j[keep], sums[keep]
    return i, j


def _cosines(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    for at in range(0, len(i), _PAIRS):
        part = slice(at, at + _PAIRS)
        out[part] = np.einsum("ij,ij->i", left[i[part]], right[j[part]])
    return out


def _least_reached(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``size`` rows the smallest row that the pairs reach."""
    least = np.arange(size)
    while True:
        low = np.minimum(least[i], least[j])
        new = least.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if np.array_equal(new, least):
            return least
        least = new


def near_vectors(vectors: DataFrame, similarity: float = SIMILARITY, tile_rows: int = TILE_ROWS) -> DataFrame:
    """vec_id, n_links, component_id (the smallest id that links reach), kept (whether it is the own id). The
    result is stored, without what led to it."""
    return stored_alone(vectors.sparkSession, "near", lambda: _near_vectors(vectors, similarity, tile_rows))


def _near_vectors(vectors: DataFrame, similarity: float, tile_rows: int) -> DataFrame:
    rows = stored(_keyed(vectors), "vectors")
    classes = stored(
        rows.filter("node is not null").groupBy("node")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("values").alias("values")),
        "classes",
    )
    width = (classes.agg(F.max(F.length("values"))).first()[0] or 8) // 8
    axes = principal_axes(classes, width)
    reach = math.sqrt(max(0.0, 2 - 2 * similarity)) + SLACK

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lead = np.floor(_unit(frame["values"], width) @ axes[:, :2] / reach).astype(np.int32)
            yield pd.DataFrame({
                "node": frame["node"], "label": frame["label"], "size": frame["values"].str.len() // 8,
                "x": lead[:, 0], "y": lead[:, 1] if width > 1 else np.int32(0),
                "copies": frame["copies"], "values": frame["values"],
            })

    kinds = "node binary, label string, size int, x int, y int, copies long, values binary"
    place = ["label", "size", "x", "y"]
    members = stored(classes.select("node", "label", "copies", "values").mapInPandas(placed, kinds), "placed")
    cells = members.groupBy(place).agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("tiles"))
    cells = stored(cells, "cells")
    sides = _work(cells)
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    # A cell may hold most vectors: they are not dealt by cell, but by cell and tile.
    tiled = join_dimension(members, cells, place).withColumn("tile", tile).drop("tiles")
    dealt = tiled.join(sides, [*place, "tile"])

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        raw = _unit(frame["values"], width)
        turned = raw @ axes
        first = frame["first"].to_numpy()
        among = bool(frame["among"].iat[0])
        a = np.flatnonzero(first)
        b = a if among else np.flatnonzero(~first)
        i, j = close_pairs(turned[a], turned[b], similarity, among)
        i, j = a[i], b[j]
        link = _cosines(raw, raw, i, j) >= similarity
        i, j = i[link], j[link]
        copies = frame["copies"].to_numpy()
        links = np.bincount(i, copies[j], len(frame)) + np.bincount(j, copies[i], len(frame))
        least = _least_reached(len(frame), i, j)
        found = np.flatnonzero(links)
        nodes = frame["node"].to_numpy()
        return pd.DataFrame({"node": nodes[found], "least": nodes[least[found]], "links": links[found].astype(np.int64)})

    found = stored(dealt.groupBy("work").applyInPandas(compare, "node binary, least binary, links long"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("least").alias("b")))
    named = stored(
        classes.select("node", "first_id", "copies").join(links, "node", "left").join(groups, "node", "left")
        .select("node", "first_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("group")),
        "groups",
    )
    least = apart(named.groupBy("group").agg(F.min("first_id").alias("component_id")), "group")
    owner = named.join(least, "group").select("node", "n_links", "component_id")
    return (
        rows.select("vec_id", "node").join(owner, "node", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def _work(cells: DataFrame) -> DataFrame:
    """For every tile (label, size, x, y, tile) the tasks it takes part in: work, first (its side), among."""
    from functools import reduce

    pairs = []
    for dx, dy in _FORWARD:
        there = cells.select("label", "size", (F.col("x") - dx).alias("x"), (F.col("y") - dy).alias("y"), F.col("tiles").alias("others"))
        pairs.append(cells.join(there, ["label", "size", "x", "y"]).withColumns({"dx": F.lit(dx), "dy": F.lit(dy)}))
    both = reduce(DataFrame.unionByName, pairs)
    tiles = both.withColumn("a", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumn(
        "b", F.explode(F.sequence(F.lit(0), F.col("others") - 1))
    )
    own = (F.col("dx") == 0) & (F.col("dy") == 0)
    tiles = tiles.filter(~own | (F.col("a") <= F.col("b"))).withColumns({
        "work": F.concat_ws("|", "label", "size", "x", "y", "dx", "dy", "a", "b"),
        "among": own & (F.col("a") == F.col("b")),
    })
    first = tiles.select("label", "size", "x", "y", F.col("a").alias("tile"), "work", "among", F.lit(True).alias("first"))
    second = tiles.filter("not among").select(
        "label", "size", (F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y"),
        F.col("b").alias("tile"), "work", "among", F.lit(False).alias("first"),
    )
    return first.unionByName(second)
