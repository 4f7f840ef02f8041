"""Language identification by rank-order profiles of letter n-grams.

A profile is the most frequent n-grams (1 to 3 letters, words padded with a blank) in the order of their
counts. A text goes to the language whose profile has its n-grams least out of place: the distance adds up how
far each n-gram's rank is from its rank in the language, or the profile's length where the language does not
have it. Tied n-grams of a text share their middle rank.

Counting is spread over all tasks: n-grams are counted per batch before the shuffle. The profiles, a few hundred
rows per language, are all that reaches the driver.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is every text if nothing was
learned; ties go to the first language in alphabetical order; a row with a null id is not held out and not
learned from; repeated rows are counted and predicted each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.memory import release, tidy

PROFILE_LENGTH = 400
LONGEST = 3
UNKNOWN = "und"
_BLANK = 32
_BITS = 21  # of a code point
_BLOCK_CHARS = 1 << 20
_FLUSH = 1 << 20


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    """Whether each code point is a letter; made once for a worker process."""
    return np.array([chr(x).isalpha() for x in range(0x110000)])


class Letters:
    """N-grams of texts as integers: code points side by side."""

    def __init__(self):
        self.is_letter = _is_letter()

    def grams(self, text: str) -> np.ndarray:
        """Every n-gram of a text, in any order, repeated as often as it occurs."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        padded = np.full(len(codes) + 2, _BLANK, dtype=np.uint64)
        padded[1:-1] = np.where(self.is_letter[codes], codes, _BLANK)
        blank = padded == _BLANK
        keep = np.ones(len(padded), dtype=bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        one, blank = padded[keep], blank[keep]
        if len(one) < 3:
            return np.empty(0, dtype=np.uint64)
        two = one[:-1] | one[1:] << np.uint64(_BITS)
        three = two[:-1] | one[2:] << np.uint64(2 * _BITS)
        return np.concatenate([one[~blank], two, three[~blank[1:-1]]])

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The distinct n-grams of a whole text and their counts; long texts are counted block by block."""
        parts = [np.unique(self.grams(x), return_counts=True) for x in _blocks(text)]
        return parts[0] if len(parts) == 1 else _added(parts)


def _blocks(text: str) -> list[str]:
    """Parts of a text cut at blanks, so that no n-gram is lost."""
    parts, start = [], 0
    while len(text) - start > _BLOCK_CHARS:
        cut = re.compile(r"\s").search(text, start + _BLOCK_CHARS)
        end = cut.start() if cut else len(text)
        parts.append(text[start:end])
        start = end
    return [*parts, text[start:]]


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, place = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
    return grams, np.bincount(place, np.concatenate([x for _, x in parts]), len(grams)).astype(np.int64)


def held_out(doc_id):
    """Whether a document is kept from learning: crc32 of its id as text has remainder 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn_profiles(docs: DataFrame, length: int = PROFILE_LENGTH) -> DataFrame:
    """lang, gram, rank (from 0) of each language's most frequent n-grams over all rows (text, lang)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in batches:
            rows: dict[str, list[int]] = {}
            for row, lang in enumerate(batch.column(1).to_pylist()):
                rows.setdefault(lang, []).append(row)
            for lang, own in rows.items():
                total, waiting, size = [], [], 0
                for row in own:
                    for block in _blocks(batch.column(0)[row].as_py()):
                        waiting.append(letters.grams(block))
                        size += len(waiting[-1])
                        if size > _FLUSH:
                            total = [_added([*total, np.unique(np.concatenate(waiting), return_counts=True)])]
                            waiting, size = [], 0
                grams, counts = _added([*total, np.unique(np.concatenate([np.empty(0, np.uint64), *waiting]), return_counts=True)])
                columns = [pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    counts = docs.select("text", "lang").dropna().mapInArrow(tidy(counted), "lang string, gram long, n long")
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return totals.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < length).select("lang", "gram", "rank")


def collect_profiles(profiles: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted n-grams and their ranks by language; ``length`` rows for each language."""
    rows = profiles.toPandas()
    out = {}
    for lang, own in rows.groupby("lang"):
        own = own.sort_values("gram")
        out[lang] = own["gram"].to_numpy(), own["rank"].to_numpy()
    return dict(sorted(out.items()))


def text_profile(grams: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A text's most frequent n-grams and their ranks; ties share the middle of their places."""
    order = np.lexsort((grams, -counts))[:length]
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], counts[1:] != counts[:-1]]))
    sizes = np.diff(np.append(first, len(counts)))
    return grams, np.repeat(first + (sizes - 1) / 2, sizes)


def distance(grams: np.ndarray, ranks: np.ndarray, profile: tuple[np.ndarray, np.ndarray], length: int) -> float:
    """How far the n-grams are out of place in a language's profile, per n-gram and from 0 to 1."""
    known, places = profile
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    apart = np.where(known[at] == grams, np.abs(places[at] - ranks), length)
    return float(apart.mean()) / length


def predictor(profiles: dict[str, tuple[np.ndarray, np.ndarray]], length: int = PROFILE_LENGTH):
    """A column function of a text: struct of lang_pred and score (1 less the distance to the nearest profile)."""
    langs, known = list(profiles), list(profiles.values())

    @F.arrow_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        letters = Letters()
        for texts in batches:
            found, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            for k, text in enumerate(texts):
                grams, counts = letters.counts(text.as_py() or "")
                if len(grams) and langs:
                    grams, ranks = text_profile(grams.astype(np.int64), counts, length)
                    apart = [distance(grams, ranks, x, length) for x in known]
                    best = int(np.argmin(apart))
                    found[k], scores[k] = langs[best], max(0.0, 1.0 - apart[best])
            yield pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])
        release()

    return predicted


def learned(docs: DataFrame, length: int = PROFILE_LENGTH):
    """The predictor learned from all documents (doc_id, text, lang) that are not held out."""
    rows = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return predictor(collect_profiles(learn_profiles(rows, length)), length)


def identify(docs: DataFrame, length: int = PROFILE_LENGTH) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learned from those that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    found = learned(rows, length)(F.col("text"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score"
    )


def identified(docs: DataFrame, least_score: float, length: int = PROFILE_LENGTH) -> DataFrame:
    """The documents, with all their columns, whose text is in a known language with at least this score."""
    found = learned(docs.select("doc_id", "text", "lang"), length)(F.col("text"))
    sure = (F.col("_found.lang_pred") != UNKNOWN) & (F.col("_found.score") >= least_score)
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), found.alias("_found")).filter(sure).select("_row.*")
