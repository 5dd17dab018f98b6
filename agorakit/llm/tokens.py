"""Token ids of whole texts by a byte-level BPE vocabulary, a slice at a time.

Texts are cut into pieces by array operations, distinct pieces are encoded once, and the ids are gathered.
The result equals ``tokenizers.Tokenizer.encode(text, add_special_tokens=False)``; texts for which that is not
certain (added tokens in them, code points without a category) and vocabularies of another
kind are encoded by that library itself.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa

from agorakit.llm.kernels import once, utf8

# The split pattern of this kind of vocabulary, and its white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]
OTHER, LETTER, NUMBER, SPACE, UNSURE = range(5)
CACHE = 100_000  # encoded pieces kept by a worker, some 25 MB


def _classes() -> np.ndarray:
    """Class of every code point."""
    of = {"L": LETTER, "N": NUMBER}
    table = np.array([UNSURE if (c := unicodedata.category(chr(i))) == "Cn" else of.get(c[0], OTHER) for i in range(0x110000)], np.uint8)
    table[WHITE] = SPACE
    return table


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in vocabularies of this kind."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A vocabulary file (JSON text) ready to encode slices of texts."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_str(text)
        self.fast = None
        spec = json.loads(text)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.cache: dict[bytes, np.ndarray] = {}
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        simple = (
            model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
            and pre.get("use_regex", True) and not spec.get("normalizer") and not model.get("ignore_merges")
            and not model.get("dropout") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        )
        if simple:
            import tiktoken

            letters = _byte_letters()
            ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in self.added}
            merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
            ids = [model["vocab"][a + b] for a, b in merges]
            if ids == sorted(ids) and len(ranks) == 256 + len(merges):
                self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts): the ids of all texts in a row, and how many belong to each; null reads as empty."""
        data, offsets = utf8(texts)
        n = len(offsets) - 1
        if self.fast is None:
            parts = [np.array(e.ids, np.uint32) for e in self.slow.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.uint32), *parts]), np.array([len(p) for p in parts], np.int64)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        place = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        kinds = once("code point classes", _classes)[points]
        docs = np.searchsorted(place, offsets)
        begin = self._starts(points, kinds, docs)
        first = np.flatnonzero(begin)
        edges = np.r_[place[first], len(data)].astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(edges), pa.py_buffer(data)]).dictionary_encode()
        codes = pieces.indices.to_numpy(zero_copy_only=False)
        known = [self._piece(b) for b in pieces.dictionary.to_pylist()]
        size = np.array([len(k) for k in known], np.int64)
        flat = np.concatenate(known)
        base = np.cumsum(size) - size
        times = size[codes]
        ends = np.cumsum(times)
        ids = flat[np.repeat(base[codes] - (ends - times), times) + np.arange(ends[-1])]
        upto = np.r_[0, ends][np.searchsorted(first, docs)]
        counts = np.diff(upto)
        return self._checked(texts, data, offsets, kinds, docs, ids, counts, upto)

    def _piece(self, piece: bytes) -> np.ndarray:
        found = self.cache.get(piece)
        if found is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            found = self.cache[piece] = np.array(self.fast.encode_ordinary(piece.decode("utf-8")), np.uint32)
        return found

    @staticmethod
    def _starts(points: np.ndarray, kinds: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Where pieces begin, by the rules of PATTERN."""
        n = len(points)
        first = np.zeros(n + 1, bool)
        first[docs] = True
        first = first[:n]
        space = kinds == SPACE
        before = np.r_[False, space[:-1]] & ~first  # the code point before, in the same text, is white space
        change = np.r_[True, kinds[1:] != kinds[:-1]] | first
        blank = np.r_[False, points[:-1] == 32] & ~first
        begin = change & (space | ~blank)
        # the last white space before something else is a piece of its own, or goes with what follows if it is a blank
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & ~space[1:] & ~first[1:]
        begin |= last & before
        # contractions
        quote = np.flatnonzero((points == 39) & begin)
        if len(quote):
            follow = np.zeros((len(quote), 3), np.uint32)
            limit = np.searchsorted(docs, quote, side="right")
            end = docs[np.minimum(limit, len(docs) - 1)]
            for j in range(3):
                at = quote + 1 + j
                ok = at < end
                follow[ok, j] = points[at[ok]]
            for c in CONTRACTIONS:
                hit = np.ones(len(quote), bool)
                for j, letter in enumerate(c):
                    hit &= follow[:, j] == ord(letter)
                at = quote[hit]
                begin[at + 1] = False
                beyond = at + 1 + len(c)
                inside = beyond < end[hit]
                more = beyond[inside]
                begin[more[kinds[more] == LETTER]] = True
        return begin

    def _checked(self, texts, data, offsets, kinds, docs, ids, counts, upto):
        unsure = np.r_[0, np.cumsum(kinds == UNSURE)]
        redo = set(np.flatnonzero(unsure[docs[1:]] > unsure[docs[:-1]]).tolist())
        whole = data.tobytes()
        for token in self.added:
            mark, at = token.encode(), -1
            while mark and (at := whole.find(mark, at + 1)) >= 0:
                redo.add(int(np.searchsorted(offsets, at, side="right")) - 1)
        if not redo:
            return ids, counts
        parts = [ids[upto[i] : upto[i + 1]] for i in range(len(counts))]
        for i in redo:
            parts[i] = np.array(self.slow.encode(texts[i].as_py() or "", add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
