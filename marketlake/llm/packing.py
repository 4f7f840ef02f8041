"""Tokenise documents, cut long ones, and pack the pieces into sequences by vector best-fit.

A document is its token ids and one end id. Only documents longer than a sequence are cut, into pieces of
full length and a shorter last one. A piece takes three things from a sequence: tokens, one document, and
attention cost (its length squared). Pieces are placed longest first, each into the open sequence that can
hold it under all three limits and whose weighted residual vector is smallest afterwards
(``objective="norm"``), or whose residual has the largest weighted dot product with the piece
(``objective="dot"``).

Pieces are dealt by a hash into groups of about ``group_pieces``, and every group is packed on its own, so no
task holds more than its group however many documents there are, and a hot document or source is spread over all
groups. A group of more than twice as many, which rows that repeat a piece make, is divided further. Only the last sequences of a group stay partly empty.

Defined cases: a null or empty text is the end id alone; repeated rows are packed once each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.bpe import encoder_of
from marketlake.llm.memory import tidy
from marketlake.operators.joins import join_dimension
from marketlake.session import stored

SEQUENCE_TOKENS = 2048
END_ID = 0

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32())),
])


def token_pieces(
    docs: DataFrame, model: bytes, capacity: int = SEQUENCE_TOKENS, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids of every piece of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = _PIECES if with_ids else pa.schema(list(_PIECES)[:-1])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            columns: list[list] = [[] for _ in schema]
            for doc_id, found in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start:start + capacity]
                    row = (doc_id, piece, start, len(own), zlib.crc32(own.tobytes()), own.astype(np.int32))
                    for column, value in zip(columns, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    types = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(tidy(cut), types)


def best_fit(
    lengths: np.ndarray, limits: tuple[float, float, float], weights: tuple[float, float, float], objective: str = "norm"
) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece and its offset in tokens there; pieces are placed longest first."""
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    limit, weight = np.array(limits, dtype=np.float64), np.array(weights, dtype=np.float64)
    scale = weight / limit**2
    left = np.empty((3, 256))  # what each open bin still takes
    names = np.empty(256, dtype=np.int64)
    opened = made = 0
    for i in np.argsort(-lengths, kind="stable"):
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        place = -1
        if opened:
            after = left[:, :opened] - need[:, None]
            if objective == "norm":
                score = scale @ after**2
            else:
                score = -((scale * need) @ left[:, :opened])
            score[after.min(axis=0) < 0] = np.inf
            best = int(score.argmin())
            place = best if score[best] < np.inf else -1
        if place < 0:
            if opened == left.shape[1]:
                left, names = np.concatenate([left, left], axis=1), np.concatenate([names, names])
            place, opened = opened, opened + 1
            left[:, place], names[place] = limit, made
            made += 1
        bins[i], offsets[i] = names[place], limits[0] - left[0, place]
        left[:, place] -= need
        if left[:, place].min() < 1:  # takes nothing more
            opened -= 1
            left[:, place], names[place] = left[:, opened], names[opened]
    return bins, offsets


def pack(
    pieces: DataFrame,
    capacity: int = SEQUENCE_TOKENS,
    most_documents: int = SEQUENCE_TOKENS,
    most_attention: int = SEQUENCE_TOKENS**2,
    weights: tuple[float, float, float] = (1.0, 1e-4, 1e-4),
    objective: str = "norm",
    group_pieces: int = 4096,
) -> DataFrame:
    """Add sequence_id and offset. ``pieces`` is read several times (counted, then packed), in the same order: store it first.

    The defaults for documents and attention never bind before the tokens do. A piece longer than a
    limit allows is an error.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    limits = (float(capacity), float(most_documents), float(most_attention))

    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups))
    dealt = pieces.withColumns({"pack_group": group, "_row": F.monotonically_increasing_id()})
    # Rows that repeat a piece meet in one group; such a group is divided by the rows' places in the stored table.
    crowded = dealt.groupBy("pack_group").count().filter(F.col("count") > 2 * group_pieces)
    if not (crowded := stored(crowded, "crowded")).isEmpty():
        parts = F.ceil(F.coalesce("count", F.lit(0)) / group_pieces)
        part = F.when(parts > 0, F.pmod(F.xxhash64("_row"), F.greatest(parts, F.lit(1)))).otherwise(0)
        dealt = join_dimension(dealt, crowded, "pack_group", "left").withColumn("pack_group", F.col("pack_group") + groups * part).drop("count")
    dealt = dealt.drop("_row")

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        lengths = rows["length"].to_numpy()
        if len(lengths) and (lengths[0] > limits[0] or float(lengths[0]) ** 2 > limits[2]):
            raise ValueError(f"a piece of {lengths[0]} tokens fits no sequence")
        bins, offsets = best_fit(lengths, limits, weights, objective)
        return rows.assign(sequence_id=rows["pack_group"] * 2**32 + bins, offset=offsets).drop(columns="pack_group")

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("pack_group").applyInPandas(
        fill, f"{kinds}, sequence_id long, offset long"
    )


def pack_documents(docs: DataFrame, model: bytes, with_ids: bool = False, **options) -> DataFrame:
    """Tokenise, cut and pack whole documents (doc_id, text); one row per piece."""
    capacity = options.get("capacity", SEQUENCE_TOKENS)
    return pack(stored(token_pieces(docs, model, capacity, with_ids=with_ids), "pieces"), **options)
