"""Token ids of whole texts with a public tokenizer."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from revloom.llm.blocks import Block

TOKENIZER_FILE = public_tokenizers.path("word_bpe_49k.json")

#: Bytes of text encoded at once: the more, the fewer look-ups of a piece.
TOKEN_BLOCK = 1 << 19

#: Pieces given to the tokenizer at once; what it returns takes hundreds of bytes a token.
CALL_PIECES = 1 << 14

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord("."), ord(",")]] = True
_END = np.uint64(0x5E0D0FD0C)


class WordTokenizer:
    """Encodes white-space separated pieces once and remembers their ids.

    For tokenizers that drop white space, lower-case all but their special tokens and never
    let a token span white space or the border between a letter and a full stop or comma,
    the ids of a text are those of its pieces put together.  A piece is remembered by a
    64-bit hash; beyond ``remembered`` pieces the memory starts over, which costs time only.
    """

    MARK = "\x01"

    def __init__(self, path: str = TOKENIZER_FILE, remembered: int = 1 << 20):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.remembered = remembered
        (self.mark_id,) = self._call([self.MARK])[0]
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts, self.counts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, self.dtype)

    def _call(self, pieces: list[str]) -> list[list[int]]:
        return [found.ids for found in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has."""
        # Many pieces in one call, a mark between them: far less work per piece.
        size = 100
        groups = [pieces[at : at + size] for at in range(0, len(pieces), size)]
        ids, counts = [], []
        joined = (
            found
            for at in range(0, len(groups), CALL_PIECES // size)
            for found in self._call([b" \x01 ".join(g).decode() for g in groups[at : at + CALL_PIECES // size]])
        )
        for group, found in zip(groups, joined, strict=True):
            found = np.array(found, self.dtype)
            cuts = np.flatnonzero(found == self.mark_id)
            if len(cuts) != len(group) - 1:  # a piece holds the mark itself
                single = self._call([piece.decode() for piece in group])
                ids += [np.array(x, self.dtype) for x in single]
                counts += [len(x) for x in single]
                continue
            ids.append(np.delete(found, cuts))
            counts += (np.diff(np.concatenate([[-1], cuts, [len(found)]])) - 1).tolist()
        return np.concatenate([np.zeros(0, self.dtype), *ids]), np.array(counts, np.int64)

    def _learn(self, keys: np.ndarray, pieces: list[bytes], end_id: int) -> None:
        if len(self.keys) + len(keys) > self.remembered:
            self._forget()
        ids, counts = self._encode(pieces)
        if _END in keys:
            at = int(np.searchsorted(keys, _END))
            begin = int(counts[:at].sum())
            ids = np.concatenate([ids[:begin], np.array([end_id], self.dtype), ids[begin + counts[at] :]])
            counts[at] = 1
        starts = len(self.ids) + np.cumsum(counts) - counts
        at = np.searchsorted(self.keys, keys)
        self.ids = np.concatenate([self.ids, ids])
        self.keys = np.insert(self.keys, at, keys)
        self.starts, self.counts = np.insert(self.starts, at, starts), np.insert(self.counts, at, counts)

    def encode(self, block: Block, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each followed by ``end_id``, and the bounds of each text in them."""
        if b"<|" not in block.data.tobytes():  # special tokens are told by case
            block = block.lowered()
        begin, end, firsts = block.words()
        data = block.data
        # A stop after a plain letter or digit is a piece of its own: far fewer distinct pieces.
        cut = (end - begin > 1) & _STOP[data[end - 1]]
        cut[cut] = _LETTER[data[end[cut] - 2]]
        number = np.repeat(np.arange(len(begin)), 1 + cut)
        tail = np.zeros(len(number), bool)
        tail[1:] = number[1:] == number[:-1]
        head = cut[number] & ~tail
        begins, ends = np.where(tail, end[number] - 1, begin[number]), end[number] - head
        firsts = firsts + np.concatenate([[0], np.cumsum(cut)])[firsts]
        keys = block.hashes(block.prefix(), begins, ends)
        keys = np.insert(keys, firsts[1:], _END)
        bounds = firsts + np.arange(len(firsts))
        # One sort serves both the look-up and the way back.
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        new = np.ones(len(ordered), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        distinct, sample = ordered[new], order[new]
        at = self._find(distinct)
        if (at < 0).any():
            fresh = np.flatnonzero(at < 0)
            if len(self.keys) + len(fresh) > self.remembered:
                self._forget()
                fresh = np.arange(len(distinct))
            # Back from places among pieces and ends to places among pieces.
            ends_before = np.searchsorted(bounds[1:] - 1, sample[fresh])
            raw = data.tobytes()
            is_end = distinct[fresh] == _END
            places = np.where(is_end, 0, sample[fresh] - ends_before)
            pieces = [
                b"" if last else raw[begins[p] : ends[p]] for p, last in zip(places.tolist(), is_end.tolist(), strict=True)
            ]
            self._learn(distinct[fresh], pieces, end_id)
            at = self._find(distinct)
        place = np.empty(len(keys), np.int64)
        place[order] = at[np.cumsum(new) - 1]
        counts = self.counts[place]
        stops = np.cumsum(counts)
        ids = self.ids[np.repeat(self.starts[place] - stops + counts, counts) + np.arange(stops[-1])]
        return ids, np.concatenate([[0], stops[bounds[1:] - 1]])

    def _find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


_tokenizers: dict[tuple[str, int], WordTokenizer] = {}


def tokenizer(path: str, end_id: int) -> WordTokenizer:
    """One tokenizer per Python worker and end id."""
    if (path, end_id) not in _tokenizers:
        _tokenizers[path, end_id] = WordTokenizer(path)
    return _tokenizers[path, end_id]
