"""Document fingerprints by consistent weighted sampling.

A document's terms are its runs of three words, weighted by how often they occur. For each of 64 samples every
term gets gamma(2, 1) variates r and c and a uniform shift from its hash; with t = floor(ln w / r + shift) and
ln y = r (t - shift), the term of least c / (y e^r) is drawn together with its t. Two documents draw the same
with a probability equal to their generalised Jaccard similarity (sum of smaller over sum of larger weights). A
fingerprint is 16 bits of each draw, in hex; likeness is the share of equal draws. r, shift and c come from 16 bits
each of one hash of term and sample, the gamma variates as quantiles from tables, c near 0 from 32 bits.

Each document is compared with the next one in descending order of doc_id. Documents are dealt by id ranges, each
range's first document is also sent to the range before it, and every task reads its range in order, holding
two documents at a time. An id (or null) that fills several ranges is divided by a hash of the texts. At most
``most_ranges`` range bounds pass the driver, and as many of ties; beyond them ranges grow.

Defined cases: a null text is empty; texts without words share one fingerprint; equal ids follow each other in the
order of a hash of their text, null ids come last; rows that repeat an id and a text are documents each; a table
of one document has itself as the next; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.words import gram_hashes, mixed, word_hashes

SAMPLES = 64
TERM_WORDS = 3
RANGE_BYTES = 8 << 20
MOST_RANGES = 100_000
_RANGE_ROWS = 1 << 18  # at most, about
_SALT_BITS = 20
_TERMS = 512  # at a time

_SEEDS = mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))[:, None]
_CELLS = 1 << 16
_FINE = 16  # lowest cells of the quantiles of c that are divided once more


def _gamma_quantiles(shares: np.ndarray) -> np.ndarray:
    """Values that a gamma(2, 1) variate stays below with these odds, by Newton's method on the logarithm."""
    x = np.log(np.sqrt(2 * shares) + shares * 0.7 - np.log1p(-shares) * shares)
    for _ in range(30):
        value = np.exp(x)
        x -= (-np.expm1(-value) - value * np.exp(-value) - shares) / (value * value * np.exp(-value))
    return np.exp(x)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r for 16 bits, ln c for 16 bits, and ln c for 32 bits of which the first 16 are below ``_FINE``."""
    middles = _gamma_quantiles((np.arange(_CELLS) + 0.5) / _CELLS)
    shares = (np.arange(_FINE * _CELLS) + 0.5) / _CELLS**2
    fine = 0.5 * np.log(2 * shares) + np.sqrt(2 * shares) / 3  # the distribution near 0: c*c/2 - c*c*c/3
    return middles.astype(np.float32), np.log(middles).astype(np.float32), fine.astype(np.float32)


def _variates(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ln c, r and 1 - shift of every sample (row) and term (column), from the parts of one hash."""
    bits = terms ^ _SEEDS
    bits *= np.uint64(0xBF58476D1CE4E5B9)
    bits ^= bits >> np.uint64(29)
    bits *= np.uint64(0x94D049BB133111EB)
    bits ^= bits >> np.uint64(32)
    parts = bits.astype("<u8", copy=False).view("<u2").reshape(*bits.shape, 4)
    for_r, for_c, fine = _tables()
    r, log_c = for_r[parts[..., 0]], for_c[parts[..., 2]]
    low = np.nonzero(parts[..., 2] < _FINE)
    if len(low[0]):
        log_c[low] = fine[parts[..., 2][low].astype(np.int64) * _CELLS + parts[..., 3][low]]
    left = parts[..., 1].astype(np.float32)
    left += np.float32(0.5)
    left *= np.float32(1 / _CELLS)
    return log_c, r, left


def draws(terms: np.ndarray, weights: np.ndarray, parts: list[slice]) -> list[np.ndarray]:
    """For each part of the weighted terms the 16-bit draws of all samples; variates are made once.

    With l = 1 - shift, ln(c / (y e^r)) is ln c - r (t + l), and t = floor(ln w / r + shift) is 0 for a weight of 1.
    """
    best = [np.full(SAMPLES, np.inf, dtype=np.float32) for _ in parts]
    out = [np.full(SAMPLES, 0xFFFF, dtype=np.uint16) for _ in parts]
    rows = np.arange(SAMPLES)
    for start in range(0, len(terms), _TERMS):
        own = terms[start:start + _TERMS]
        ranked, r, left = _variates(own)
        heavy = np.flatnonzero(weights[start:start + _TERMS] != 1)
        times = np.zeros(len(own), dtype=np.int64)
        if len(heavy):
            logs, own_r = np.log(weights[start + heavy]).astype(np.float32), r[:, heavy]
            t = np.floor(logs / own_r + 1 - left[:, heavy])
            ranked[:, heavy] -= own_r * t
            times[heavy] = np.arange(1, len(heavy) + 1)
        r *= left
        ranked -= r
        for k, part in enumerate(parts):
            low, high = max(part.start - start, 0), min(part.stop - start, len(own))
            if low >= high:
                continue
            at = low + ranked[:, low:high].argmin(axis=1)
            value = ranked[rows, at]
            better = value < best[k]
            best[k] = np.where(better, value, best[k])
            levels = np.zeros(SAMPLES, dtype=np.int64)
            if len(heavy):
                levels = np.where(times[at] > 0, t[rows, times[at] - 1], 0).astype(np.int64)
            drawn = mixed(own[at] ^ (levels.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)))
            out[k] = np.where(better, (drawn >> np.uint64(48)).astype(np.uint16), out[k])
    return out


def weighted_terms(text: str, size: int = TERM_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of a text, in the order of their hashes, and their weights."""
    terms, counts = np.unique(gram_hashes(word_hashes(text.encode()), size), return_counts=True)
    return terms, counts.astype(np.float64)


def fingerprint(text: str) -> np.ndarray:
    terms, weights = weighted_terms(text)
    return draws(terms, weights, [slice(0, len(terms))])[0]


def fingerprint_pair(text: str, other: str) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of two texts that share many terms: terms of equal weight in both are sampled once."""
    terms, weights = weighted_terms(text)
    others, other_weights = weighted_terms(other)
    _, i, j = np.intersect1d(terms, others, assume_unique=True, return_indices=True)
    same = weights[i] == other_weights[j]
    mine, theirs = np.ones(len(terms), dtype=bool), np.ones(len(others), dtype=bool)
    mine[i[same]] = theirs[j[same]] = False
    shared = i[same]
    every = np.concatenate([terms[mine], terms[shared], others[theirs]])
    heavy = np.concatenate([weights[mine], weights[shared], other_weights[theirs]])
    first, second = draws(every, heavy, [slice(0, len(terms)), slice(int(mine.sum()), len(every))])
    return first, second


def likeness(first: np.ndarray, second: np.ndarray) -> float:
    """Share of equal draws: an estimate of the generalised Jaccard similarity."""
    return float((first == second).mean())


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the start of the following one."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def _hex(draw: np.ndarray) -> str:
    return draw.astype(">u2").tobytes().hex()


_ROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def _read_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, borrowed) of one range in order; the last, borrowed one starts the next range."""
    before = None  # doc_id and text of the document whose next one is awaited
    ready = None  # what is known of the one before it, but for its likeness to ``before``
    over = False

    def finish(ready: tuple, own: np.ndarray) -> tuple:
        return (*ready[0], likeness(ready[1], own))

    for batch in batches:
        rows = []
        for doc_id, text, borrowed in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            text = text.as_py() or ""
            if over:
                break
            if before is not None:
                changed = edited(before[1], text)
                own, other = fingerprint_pair(before[1], changed)
                if ready is not None:
                    rows.append(finish(ready, own))
                known = (before[0], len(before[1]), sha256(changed.encode()).hexdigest(), _hex(own), _hex(other), likeness(own, other))
                ready = known, own
            before = doc_id, text
            if borrowed:
                over = True
                if ready is not None:
                    rows.append(finish(ready, fingerprint(text)))
        columns = list(zip(*rows)) if rows else [[] for _ in _ROW]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROW)], schema=_ROW)


@dataclass
class Ranges:
    """Ranges of documents in descending order of id, null ids last: bounds of ids (ascending), and for an id that fills
    several ranges, None too, the bounds of the ties of its rows (ascending)."""

    cuts: np.ndarray
    ties: dict[int | None, np.ndarray]

    @property
    def count(self) -> int:
        return len(self.cuts) + 2 + sum(len(x) + 1 for x in self.ties.values())

    def of(self, ids: np.ndarray, ties: np.ndarray, null: np.ndarray) -> np.ndarray:
        """The number of each row's range; numbers ascend in the order of the rows."""
        at = np.searchsorted(self.cuts, ids)
        # Range k has the ids above cut k - 1 up to cut k; those of a hot cut come before the others.
        sizes = np.ones(len(self.cuts) + 1, dtype=np.int64)
        hot = {int(np.searchsorted(self.cuts, x)): x for x in self.ties if x is not None}
        for k, x in hot.items():
            sizes[k] += len(self.ties[x]) + 1
        last = np.cumsum(sizes[::-1])[::-1]  # ranges up to and with k
        out = last[at] - 1
        for k, x in hot.items():
            mine = ids == x
            out[mine] = last[k] - sizes[k] + np.searchsorted(self.ties[x], ties[mine])
        out[null] = int(sizes.sum()) + np.searchsorted(self.ties.get(None, np.empty(0, dtype=np.int64)), ties[null])
        return out


def _ranges(rows: DataFrame, range_bytes: int, most_ranges: int) -> Ranges:
    """Ranges of about so many bytes, by quantiles of ids, and of ties where one id fills several ranges."""
    null = F.col("doc_id").isNull()
    total, count, without, nulls = rows.agg(
        F.sum(F.octet_length("text")), F.count("doc_id"), F.sum(F.when(null, F.octet_length("text"))), F.count(F.when(null, F.lit(1)))
    ).first()
    ranges = min(most_ranges, max(1, -(-(total or 0) // range_bytes), -(-(count + nulls) // _RANGE_ROWS)))
    shares = [(i + 1) / ranges for i in range(ranges)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 20 * ranges)).first()[0] or []
    cuts, repeats = np.unique(np.array(cuts, dtype=np.int64), return_counts=True)
    wanted: dict[int | None, int] = {int(x): int(n) for x, n in zip(cuts, repeats) if n > 1}
    of_null = min(ranges, max(-(-(without or 0) // range_bytes), -(-nulls // _RANGE_ROWS)))
    if of_null > 1:
        wanted[None] = of_null
    if not wanted:
        return Ranges(cuts, {})
    # An id with n of the quantiles is cut in n; all get as many bounds as the one with most, of which they take n - 1.
    finest = max(wanted.values())
    hot = rows.filter(F.col("doc_id").isin([x for x in wanted if x is not None]) | (null if None in wanted else F.lit(False)))
    found = hot.groupBy("doc_id").agg(F.percentile_approx("tie", [i / finest for i in range(1, finest)], 20 * finest).alias("bounds"))
    every = {x.doc_id: np.array(x.bounds, dtype=np.int64) for x in found.collect()}
    # Quantiles are doubles: an id beyond 2**53 may not be met exactly, and then stays in one range.
    return Ranges(cuts, {x: np.unique(every[x][np.arange(1, n) * finest // n - 1]) for x, n in wanted.items() if x in every})


def _tied(docs: DataFrame) -> DataFrame:
    """doc_id, text, tie. Rows that repeat an id and a text differ in the low bits, so that a range can end between them."""
    tie = F.xxhash64("text").bitwiseAND(F.lit(-1 << _SALT_BITS)) + F.floor(F.rand(31) * (1 << _SALT_BITS))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("tie", tie)


def fingerprints(docs: DataFrame, range_bytes: int = RANGE_BYTES, most_ranges: int = MOST_RANGES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each document."""
    rows = _tied(docs)
    ranges = _ranges(rows, range_bytes, most_ranges)

    @F.arrow_udf("int")
    def range_of(doc_id: pa.Array, tie: pa.Array) -> pa.Array:
        ids, null = doc_id.fill_null(0).to_numpy(), doc_id.is_null().to_numpy(zero_copy_only=False)
        return pa.array(ranges.of(ids, tie.to_numpy(), null), pa.int32())

    placed = rows.withColumn("range", range_of("doc_id", "tie"))
    first = F.max(F.struct("doc_id", F.bitwise_not("tie").alias("turned"))).alias("first")
    heads = placed.groupBy("range").agg(first)
    previous = F.lag("range").over(Window.orderBy("range"))
    last = F.max("range").over(Window.partitionBy())
    heads = heads.select(
        "range", F.col("first.doc_id").alias("first_id"), F.bitwise_not("first.turned").alias("first_tie"), F.coalesce(previous, last).alias("before")
    )
    is_head = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("tie") == F.col("first_tie"))
    own = F.struct(F.col("range").alias("to"), F.lit(False).alias("borrowed"))
    lent = F.struct(F.col("before").alias("to"), F.lit(True).alias("borrowed"))
    sent = (
        placed.join(F.broadcast(heads), "range")  # one row per range
        .select("doc_id", "text", "tie", F.explode(F.when(is_head, F.array(own, lent)).otherwise(F.array(own))).alias("sent"))
        .select("doc_id", "text", "tie", "sent.to", "sent.borrowed")
    )
    ordered = sent.repartitionById(ranges.count, F.col("to")).sortWithinPartitions(
        "borrowed", F.desc_nulls_last("doc_id"), "tie"
    )
    kinds = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.select("doc_id", "text", "borrowed").mapInArrow(_read_in_order, kinds)
