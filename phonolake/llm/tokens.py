"""Token ids of many texts from a tokenizers file, each distinct piece of text encoded once per worker.

The tokenizer never joins characters across white space. Inside a word of plain letters, digits and ASCII marks it
splits where the kind changes, and after each digit; such runs are encoded alone. Any other word (apostrophes,
control characters, other scripts, ``<|``) is encoded as a whole. ``CACHED`` bounds what a worker keeps.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

from phonolake.llm import words

CACHED = 400_000
LETTER, DIGIT, MARK, ODD = 1, 2, 3, 4

_kinds = np.full(256, ODD, np.uint8)
_kinds[33:127] = MARK
_kinds[48:58] = DIGIT
_kinds[65:91] = _kinds[97:123] = _kinds[0xC3] = LETTER
_kinds[[*words.SPACES]] = 0
_kinds[ord("'")] = ODD


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, words.Words]:
    """Starts, ends and kinds of the runs, and the words they lie in."""
    found = words.Words(data, offsets, words.PLAIN, hashed=False)
    kind = _kinds[data]
    tail = np.flatnonzero((data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[:-1] == 0xC3)) + 1
    kind[tail] = np.where((data[tail] == 0x97) | (data[tail] == 0xB7), ODD, LETTER)  # U+00D7, U+00F7 are no letters
    kind[np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))] = ODD
    odd = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kind == ODD, out=odd[1:])
    strange = odd[found.ends] > odd[found.starts]
    size = (found.ends - found.starts)[strange]
    at = np.cumsum(size) - size
    kind[np.repeat(found.starts[strange] - at, size) + np.arange(size.sum())] = ODD
    begin = np.zeros(len(data), bool)
    begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    begin[found.starts] = True
    begin &= kind > 0
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], len(data))
    word = np.searchsorted(found.starts, starts, "right") - 1
    ends = np.minimum(ends, found.ends[word]) if len(starts) else ends[:0]
    return starts, ends, kind[starts], found


class Encoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.closes = np.zeros(size, bool)
        self.closes[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.base, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.dtype)

    def _one_by_one(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter((i for x in ids for i in x), self.dtype)
        return flat, np.fromiter(map(len, ids), np.int64, len(ids))

    def _together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Runs of letters, separated by spaces: each must end with one closing token, else they go one by one."""
        line = self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids
        flat = np.array(line, self.dtype)
        ends = np.flatnonzero(self.closes[flat]) + 1
        if len(ends) != len(texts) or ends[-1] != len(flat):
            return self._one_by_one(texts)
        return flat, np.diff(ends, prepend=0)

    def _learn(self, keys: np.ndarray, texts: list[str], letters: np.ndarray) -> None:
        order = np.argsort(~letters, kind="stable")
        many = int(letters.sum())
        found = []
        for start in range(0, len(order), 2048):
            part = order[start : min(start + 2048, many) if start < many else start + 2048].tolist()
            chosen = [texts[i] for i in part]
            found.append(self._together(chosen) if start < many else self._one_by_one(chosen))
            if start < many < start + 2048:
                rest = [texts[i] for i in order[many : start + 2048].tolist()]
                found.append(self._one_by_one(rest))
        size = np.concatenate([s for _, s in found])
        first, held = len(self.size), len(self.flat)
        self.known.update(zip(keys[order].tolist(), range(first, first + len(order)), strict=True))
        self.base = np.append(self.base, held + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.flat = np.concatenate([self.flat, *[f for f, _ in found]])

    def __call__(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, ``end_id`` behind each text's, and the texts' numbers of ids."""
        data, offsets = words.raw(column)
        starts, ends, kinds, found = _runs(data, offsets)
        folded = np.where(_kinds[data] == LETTER, words.LOWER.fold[data], data)
        strange = kinds == ODD
        hashes = words.blocks_of_spans(words.PLAIN.values, folded, starts, ends)
        if strange.any():  # case matters in words that may hold special tokens
            exact = words.blocks_of_spans(words.PLAIN.values, data, starts[strange], ends[strange])
            hashes[strange] = words.mix(exact + np.uint64(1))
        keys, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(keys) > CACHED:
            self._clear()
        place = np.fromiter((self.known.get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        new = np.flatnonzero(place < 0)
        if len(new):
            body = data.tobytes()
            spots = at[new]
            texts = [body[a:b].decode() for a, b in zip(starts[spots].tolist(), ends[spots].tolist(), strict=True)]
            self._learn(keys[new], texts, kinds[spots] == LETTER)
            place[new] = np.fromiter((self.known[k] for k in keys[new].tolist()), np.int64, len(new))
        n = len(offsets) - 1
        stops = np.searchsorted(starts, offsets[1:])
        here = place[which]
        lengths = np.insert(self.size[here], stops, 1)
        sources = np.insert(self.base[here], stops, len(self.flat))
        flat = np.append(self.flat, self.dtype.type(end_id))
        from_ = np.cumsum(lengths) - lengths
        ids = flat[np.repeat(sources - from_, lengths) + np.arange(lengths.sum())]
        first = np.concatenate([[0], stops[:-1]]) + np.arange(n) if n else stops
        return ids, np.add.reduceat(lengths, first) if n else lengths


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)
