"""Byte-pair token ids of many texts at once, with numpy inside tasks.

For tokenisers that lower-case, drop blanks and split words by letters, numbers and other signs, the distinct
runs of non-blank characters of a batch are encoded together, each once. Any other tokeniser, and any text with
characters outside the plain set below, goes through the tokenizers library as it is. Both ways give the ids
that the library gives.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The normaliser and the pattern of the tokenisers that can be encoded by runs.
_NORMALISER = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_CONTRACTIONS = re.compile(r"'(?:s|t|re|ve|m|ll|d)")

_ODD = r"[^\t-\r -~¡-ÿŒœ]"  # any character that is not plain
_BATCH_BYTES = 8 << 20
_NEVER = np.int32(2**31 - 1)
_LETTER, _NUMBER, _OTHER = 0, 1, 2


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of a byte that stands alone, and of a character's second byte by its first: rows C2, C3, C5."""
    alone = np.full(256, _OTHER, dtype=np.int8)
    pairs = np.full((256, 256), _LETTER, dtype=np.int8)
    for code in [*range(128), *range(161, 256)]:
        char = chr(code)
        kind = _LETTER if char.isalpha() else _NUMBER if char.isnumeric() else _OTHER
        if code < 128:
            alone[code] = kind
        else:
            pairs[tuple(char.encode())] = kind
    return alone, pairs


class TextEncoder:
    """Token ids of whole texts: ``encode(texts)`` gives all ids in a row and the number of each text's."""

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model.decode())
        spec = json.loads(model)
        steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        split, bpe = parts[0], spec["model"]
        self.by_run = (
            steps == _NORMALISER
            and (split.get("pattern", {}).get("Regex"), split.get("behavior"), split.get("invert")) == (_PATTERN, "Removed", True)
            and [(x["type"], x["use_regex"], x["add_prefix_space"]) for x in parts[1:]] == [("ByteLevel", False, False)]
            and bpe.get("type") == "BPE" and bpe.get("end_of_word_suffix") and not bpe.get("continuing_subword_prefix")
            and not bpe.get("dropout") and not bpe.get("ignore_merges") and not bpe.get("byte_fallback")
        )
        self.specials = [x["content"] for x in spec.get("added_tokens", [])]
        if self.by_run:
            self._prepare(bpe)

    def _prepare(self, bpe: dict) -> None:
        # The byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from 256.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [x for x in range(256) if x not in printable]
        letter = {x: chr(x) for x in printable} | {x: chr(256 + i) for i, x in enumerate(others)}
        vocabulary, end = bpe["vocab"], bpe["end_of_word_suffix"]
        self.inner = np.array([vocabulary[letter[x]] for x in range(256)], dtype=np.int64)
        self.last = np.array([vocabulary[letter[x] + end] for x in range(256)], dtype=np.int64)
        pairs = [x.split(" ") if isinstance(x, str) else x for x in bpe["merges"]]
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], dtype=np.uint64)
        self.tables = []
        ranks = np.arange(len(keys), dtype=np.int32)
        for bits in (20, 16, 16, 16):  # a key whose place is taken goes to the next table
            places = self._place(keys, bits)
            _, first = np.unique(places, return_index=True)
            table, values = np.full(1 << bits, 2**64 - 1, dtype=np.uint64), np.full(1 << bits, _NEVER, dtype=np.int32)
            table[places[first]], values[places[first]] = keys[first], ranks[first]
            self.tables.append((bits, table, values))
            rest = np.setdiff1d(np.arange(len(keys)), first)
            keys, ranks = keys[rest], ranks[rest]
        if len(keys):
            self.by_run = False
        self.alone, self.pairs = _classes()

    @staticmethod
    def _place(keys: np.ndarray, bits: int) -> np.ndarray:
        spread = (keys ^ (keys >> np.uint64(17))) * np.uint64(0x9E3779B97F4A7C15 + 2 * bits)
        return (spread >> np.uint64(64 - bits)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32 | right).astype(np.uint64)
        bits, table, values = self.tables[0]
        places = self._place(keys, bits)
        found = table[places] == keys
        ranks = np.where(found, values[places], _NEVER)
        missing = np.flatnonzero(~found)
        for bits, table, values in self.tables[1:]:
            places = self._place(keys[missing], bits)
            found = table[places] == keys[missing]
            ranks[missing[found]] = values[places[found]]
            missing = missing[~found]
        return ranks

    def _merge(self, tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join the pair of lowest rank in each word, leftmost first, until no word has one."""
        words = np.arange(len(lengths))
        counts = np.zeros(len(lengths), dtype=np.int64)
        done_words, done_tokens = [], []
        owner = np.repeat(words, lengths)
        ranks = np.full(len(tokens), _NEVER, dtype=np.int32)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[inside] = self._ranks(tokens[inside], tokens[inside + 1])
        while len(tokens):
            firsts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.append(firsts, len(tokens)))
            least = np.minimum.reduceat(ranks, firsts)
            over = np.repeat(least == _NEVER, sizes)
            if over.any():
                done_tokens.append(tokens[over])
                done_words.append(owner[over])
                tokens, owner, ranks = tokens[~over], owner[~over], ranks[~over]
                sizes, least = sizes[least != _NEVER], least[least != _NEVER]
            if not len(tokens):
                break
            at = np.flatnonzero(ranks == np.repeat(least, sizes))
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]
            tokens[at] = self.merged[ranks[at]]
            keep = np.ones(len(tokens), dtype=bool)
            keep[at + 1] = False
            tokens, owner, ranks = tokens[keep], owner[keep], ranks[keep]
            at -= np.arange(len(at))  # one token fewer for each merge further left
            ranks[at] = _NEVER
            right = at[at + 1 < len(tokens)]
            right = right[owner[right] == owner[right + 1]]
            left = at[at > 0]
            left = left[owner[left] == owner[left - 1]] - 1
            for pairs in (right, left):
                ranks[pairs] = self._ranks(tokens[pairs], tokens[pairs + 1])
        tokens, owner = np.concatenate(done_tokens), np.concatenate(done_words)
        counts += np.bincount(owner, minlength=len(lengths))
        return tokens[np.argsort(owner, kind="stable")], counts

    def _runs(self, runs: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for distinct lower-case runs without blanks and contractions."""
        offsets = np.frombuffer(runs.buffers()[1], dtype=np.int32)[runs.offset:runs.offset + len(runs) + 1].astype(np.int64)
        data = np.frombuffer(runs.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        if not len(data):
            return np.empty(0, dtype=np.int64), np.zeros(len(runs), dtype=np.int64)
        second = (data & 0xC0) == 0x80
        kind = self.alone[data]
        at = np.flatnonzero(second)
        kind[at] = kind[at - 1] = self.pairs[data[at - 1], data[at]]
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[1:-1] = (kind[1:] != kind[:-1]) | ((kind[1:] == _NUMBER) & ~second[1:])
        begins[offsets] = True
        begins[-1] = False
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        tokens = self.inner[data]
        tokens[ends - 1] = self.last[data[ends - 1]]
        tokens, counts = self._merge(tokens, ends - starts)
        before = np.concatenate([[0], np.cumsum(counts)])
        return tokens, np.diff(before[np.searchsorted(starts, offsets)])

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        coded = split.flatten().dictionary_encode()
        runs, at = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        ids, counts = self._runs(runs)
        quoted = [i for i in np.flatnonzero(pc.match_substring(runs, "'").to_numpy(zero_copy_only=False))
                  if _CONTRACTIONS.search(runs[i].as_py())]
        offsets = np.cumsum(counts) - counts
        if quoted:
            more = [x.ids for x in self.tokenizer.encode_batch([runs[i].as_py() for i in quoted], add_special_tokens=False)]
            counts[quoted] = [len(x) for x in more]
            offsets[quoted] = len(ids) + np.cumsum(counts[quoted]) - counts[quoted]
            ids = np.concatenate([ids, *(np.array(x, dtype=np.int64) for x in more)])
        lengths = counts[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        out = ids[np.arange(total) + np.repeat(offsets[at] - ends + lengths, lengths)].astype(np.uint32)
        places = np.concatenate([[0], ends])
        return out, np.diff(places[split.offsets.to_numpy() - split.offsets[0].as_py()])

    def _batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_run:
            odd = np.ones(len(texts), dtype=bool)
        else:
            odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False).copy()
            for special in self.specials:
                odd |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._plain(texts)
        whole = [x.ids for x in self.tokenizer.encode_batch(texts.filter(pa.array(odd)).to_pylist(), add_special_tokens=False)]
        ids, counts = self._plain(texts.filter(pa.array(~odd))) if not odd.all() else (np.empty(0, np.uint32), np.empty(0, np.int64))
        parts, each = iter(np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []), iter(whole)
        own = [np.array(next(each), dtype=np.uint32) if x else next(parts) for x in odd]
        return np.concatenate(own), np.array([len(x) for x in own], dtype=np.int64)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; a null text has none."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        out: list[np.ndarray] = []
        start = 0
        while start < len(texts):
            stop = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), _BATCH_BYTES, side="right")))
            if sizes[start] > _BATCH_BYTES and self.by_run:
                blocks = pa.array(list(_blocks(texts[start].as_py(), _BATCH_BYTES)), pa.string())
                out.append(np.concatenate([self._batch(blocks.slice(i, 1))[0] for i in range(len(blocks))]))
                start += 1
                continue
            ids, counts = self._batch(texts.slice(start, stop - start))
            out += np.split(ids, np.cumsum(counts)[:-1])
            start = stop
        return out


@lru_cache(maxsize=1)
def encoder_of(model: bytes) -> TextEncoder:
    """One encoder for a worker process and all its tasks."""
    return TextEncoder(model)


def _blocks(text: str, size: int):
    """Parts of a very long text that start at a space before a plain letter: no word is cut there."""
    start = 0
    while start < len(text):
        cut = re.compile(r" (?=[A-Za-z])").search(text, min(start + size, len(text)))
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end
