"""Encode and decode with a SentencePiece model through the tokenizers library.

The model's protobuf is parsed, and its normaliser, metaspace marker, pieces (with unigram scores, or with
merges in the order of the scores for BPE) and byte fallback are rebuilt as a tokenizers pipeline. Documents
are encoded in batches by the library's own threads.

Where no piece has the marker anywhere but at its start, a text's ids are those of its words, so the distinct
words of a batch are encoded once. Parity is verified against the sentencepiece library on the very same
units: for every text, each distinct word in it (or the whole text, if the model has other pieces) is encoded by
both libraries; ``parity`` tells whether all agree. The ids are those of the tokenizers pipeline. Only of a word or text
on which the two differ (two merges of one score) those of the sentencepiece library are taken, and parity is false.

Defined cases: a null or empty text has no ids and decodes to the empty text; repeated rows are encoded once
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

MARK = "▁"
_NORMAL, _USER = 1, 4  # fixed values: kinds of pieces in the protobuf
_BATCH_BYTES = 4 << 20
_WORDS_A_TEXT = 200
_TEXTS_A_BATCH = 50  # of new words: the library needs some hundred bytes for each token of a batch


def parse_model(model: bytes):
    """The model's protobuf message."""
    from sentencepiece import sentencepiece_model_pb2

    message = sentencepiece_model_pb2.ModelProto()
    message.ParseFromString(model)
    return message


def _merges(pieces) -> list[tuple[str, str]]:
    """All pairs of pieces that make a piece, by the score of what they make, best first."""
    rank = {x.piece: i for i, x in enumerate(pieces) if x.type in (_NORMAL, _USER)}
    found = []
    for piece, i in rank.items():
        for cut in range(1, len(piece)):
            if (left := piece[:cut]) in rank and (right := piece[cut:]) in rank:
                found.append((-pieces[i].score, i, rank[left], rank[right], left, right))
    return [x[-2:] for x in sorted(found)]


def rebuild(model: bytes):
    """The tokenizers pipeline of a SentencePiece model of type unigram or BPE."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    message = parse_model(model)
    trainer, spec, pieces = message.trainer_spec, message.normalizer_spec, message.pieces
    if trainer.model_type == 1:
        core = models.Unigram([(x.piece, x.score) for x in pieces], unk_id=trainer.unk_id, byte_fallback=trainer.byte_fallback)
    elif trainer.model_type == 2:
        vocabulary = {x.piece: i for i, x in enumerate(pieces)}
        core = models.BPE(vocabulary, _merges(pieces), unk_token=trainer.unk_piece, fuse_unk=True, byte_fallback=trainer.byte_fallback)
    else:
        raise ValueError(f"models of type {trainer.model_type} are neither unigram nor BPE")
    tokenizer = Tokenizer(core)
    steps = []
    if spec.precompiled_charsmap:
        steps.append(normalizers.Precompiled(spec.precompiled_charsmap))
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]*"), "isolated") if _by_word(message) else None
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return tokenizer


def _by_word(message) -> bool:
    return not any(MARK in x.piece.lstrip(MARK) for x in message.pieces if x.type in (_NORMAL, _USER)) and not any(
        x.type == _USER for x in message.pieces)


class PieceEncoder:
    """Encodes and decodes batches of texts; see the module."""

    def __init__(self, model: bytes, most_words: int = 250_000):
        import sentencepiece

        self.message = parse_model(model)
        self.tokenizer = rebuild(model)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        spec = self.message.normalizer_spec
        self.prefix = spec.add_dummy_prefix
        # Words are cut by plain string operations where normalising changes blanks only.
        self.by_word = (
            _by_word(self.message) and not spec.precompiled_charsmap and not spec.remove_extra_whitespaces
            and spec.escape_whitespaces and self.prefix and not self.message.trainer_spec.treat_whitespace_as_suffix
        )
        self.begins = np.array([x.piece.startswith(MARK) for x in self.message.pieces])
        self.most_words = most_words
        self._forget()

    def _both(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        """Ids of whole texts from the rebuilt pipeline (the model's own where they differ), and whether both libraries agree."""
        own = [x.ids for x in self.tokenizer.encode_batch(
            [MARK + x if self.prefix and x else x for x in texts], add_special_tokens=False)]
        theirs = self.processor.encode(texts, num_threads=1)
        agree = [a == b for a, b in zip(own, theirs)]
        return [a if same else b for a, b, same in zip(own, theirs, agree)], agree

    def text_of(self, ids: list[int]) -> str:
        """The text that the ids stand for."""
        return self._clean(self.tokenizer.decode(ids, skip_special_tokens=False))

    def _clean(self, text: str) -> str:
        return text[1:] if self.prefix and text.startswith(" ") else text

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, bool, str]]:
        """For each text: its ids, whether both libraries agree, and the text decoded from the ids."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(texts):
            done = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, done + _BATCH_BYTES, side="right")))
            yield from self._batch(texts.slice(start, stop - start))
            start = stop

    def _batch(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, bool, str]]:
        """Texts whose words stand between single blanks go by words, the others as a whole."""
        odd = np.full(len(texts), not self.by_word)
        if self.by_word:
            for blank in ("  ", MARK):
                odd |= pc.match_substring(texts, blank).to_numpy(zero_copy_only=False)
            odd |= pc.match_substring_regex(texts, "^ | $|^$").to_numpy(zero_copy_only=False)
        rest = texts.filter(pa.array(odd)).to_pylist()
        whole = iter(zip(rest, *self._both(rest))) if rest else iter(())
        words = self._words(texts.filter(pa.array(~odd)))
        for by_whole in odd:
            if by_whole:
                text, ids, same = next(whole)
                yield np.array(ids, dtype=np.uint32), same, self.text_of(ids) if ids else ""
            else:
                yield next(words)

    def _words(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, bool, str]]:
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        if len(self.known) > self.most_words:
            self._forget()
        at = np.fromiter(map(self.known.__getitem__, coded.dictionary.to_pylist()), dtype=np.int64, count=len(coded.dictionary))
        step = _WORDS_A_TEXT * _TEXTS_A_BATCH
        for start in range(0, len(self.known.new), step):
            self._learn(self.known.new[start:start + step])
        self.known.new = []
        at = at[coded.indices.to_numpy(zero_copy_only=False)] if len(at) else at
        counts, offsets = self.counts[at], self.offsets[at]
        places = split.offsets.to_numpy() - (split.offsets[0].as_py() if len(split) else 0)
        for i, text in enumerate(texts):
            own = slice(places[i], places[i + 1])
            lengths = counts[own]
            ends = np.cumsum(lengths)
            ids = self.flat[np.arange(ends[-1]) + np.repeat(offsets[own] - ends + lengths, lengths)]
            if self.returns[at[own]].all():  # every word decodes to itself, so the text does
                back = text.as_py()
            else:
                back = self.text_of(ids.tolist())
            yield ids, bool(self.same[at[own]].all()), back

    def _forget(self) -> None:
        self.known = Numbering()
        self.words = self.used = 0
        self.counts, self.offsets = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)
        self.same, self.returns = np.zeros(1 << 12, dtype=bool), np.zeros(1 << 12, dtype=bool)
        self.flat = np.zeros(1 << 14, dtype=np.uint32)

    def _learn(self, words: list[str]) -> None:
        """Encode new words with the rebuilt pipeline, many in one text, verify the ids against the sentencepiece library,
        and decode them again."""
        groups = [words[i:i + _WORDS_A_TEXT] for i in range(0, len(words), _WORDS_A_TEXT)]
        own = self.tokenizer.encode_batch_fast([MARK + MARK.join(x) for x in groups], add_special_tokens=False)
        theirs = self.processor.encode([" ".join(x) for x in groups], num_threads=1)
        found = [x.ids for x in own]
        back = self.tokenizer.decode_batch(found, skip_special_tokens=False)
        ids, counts, same, returns = [], [], [], []
        for group, coded, right, text in zip(groups, found, theirs, back):
            mine = np.array(coded, dtype=np.uint32)
            starts = np.flatnonzero(self.begins[mine])
            if coded == right and text == " " + " ".join(group) and len(starts) == len(group):
                ids.append(mine)
                counts.append(np.diff(np.append(starts, len(mine))))
                same.append(np.ones(len(group), dtype=bool))
                returns.append(same[-1])
            else:
                each, agree = self._both(group)
                ids.append(np.array([i for x in each for i in x], dtype=np.uint32))
                counts.append(np.array([len(x) for x in each], dtype=np.int64))
                same.append(np.array(agree, dtype=bool))
                returns.append(np.array([self.text_of(i) == x for i, x in zip(each, group)], dtype=bool))
        lengths = np.concatenate(counts)
        first, last = self.words, self.words + len(words)
        found = np.concatenate(ids)
        while last > len(self.counts):  # room is doubled, not made for each batch
            self.counts, self.offsets, self.same, self.returns = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.counts, self.offsets, self.same, self.returns)
            )
        while self.used + len(found) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.counts[first:last], self.offsets[first:last] = lengths, self.used + np.cumsum(lengths) - lengths
        self.same[first:last], self.returns[first:last] = np.concatenate(same), np.concatenate(returns)
        self.flat[self.used:self.used + len(found)] = found
        self.words, self.used = last, self.used + len(found)


class Numbering(dict):
    """Numbers its keys as they are first looked up, and lists the new ones."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = place = len(self)
        self.new.append(key)
        return place


@lru_cache(maxsize=1)
def encoder_of(model: bytes) -> PieceEncoder:
    """One encoder for a worker process and all its tasks: building one takes time, and memory that the libraries
    keep."""
    return PieceEncoder(model)


def encode_documents(docs: DataFrame, model: bytes, with_ids: bool = False) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (little-endian unsigned 32-bit ids), parity, round_trip and, if asked for, ids.

    ``round_trip``: decoding the ids gives the text as the model's normaliser leaves it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [("doc_id", pa.int64()), ("n_ids", pa.int64()), ("ids_crc32", pa.int64()), ("parity", pa.bool_()), ("round_trip", pa.bool_())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        plain = not encoder.message.normalizer_spec.precompiled_charsmap and not encoder.message.normalizer_spec.remove_extra_whitespaces
        for batch in batches:
            columns: list[list] = [[] for _ in schema]
            for doc_id, text, (ids, parity, back) in zip(batch.column(0).to_pylist(), batch.column(1), encoder.encode(batch.column(1))):
                text = text.as_py() or ""
                wanted = text if plain else encoder.processor.normalize(text).removeprefix(MARK).replace(MARK, " ")
                row = (doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), parity, back == wanted, ids.astype(np.int32))
                for column, value in zip(columns, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    types = "doc_id long, n_ids long, ids_crc32 long, parity boolean, round_trip boolean" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(coded, types)


def decode_documents(coded: DataFrame, model: bytes) -> DataFrame:
    """doc_id, text of rows with doc_id and ids; null ids decode to the empty text."""
    shared = coded.sparkSession.sparkContext.broadcast(model)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            ids = [x or [] for x in batch.column(1).to_pylist()]
            found = [encoder._clean(x) for x in encoder.tokenizer.decode_batch(ids, skip_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(texts, "doc_id long, text string")
