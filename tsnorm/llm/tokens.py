"""Token ids of whole texts by the tokenizers library, which gets each distinct piece of many texts once."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tsnorm.llm.common import slices, text_bytes

RUN_BYTES = 12 << 20  # of texts whose pieces are told apart together
JOINED = 1 << 16  # bytes of pieces that the library takes at once
LETTERS = 0x250  # below it, all versions of Unicode have the same letters


class Pieces:
    """Ids of texts by way of their pieces. A piece starts at a space or a line feed, where the
    pre-tokenizer of a byte-level BPE always cuts, so a text's ids are those of its pieces in
    turn, unless it holds an added token. Pieces are told apart as arrays; the library gets distinct ones only, many in
    one string: a token of a byte-level BPE has as many characters as it stands for bytes, which tells where a piece's ids end.
    Pieces that are a space and letters are spelled for the model directly, as the pre-tokenizer does."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_piece = cuts_at_spaces(self.tokenizer)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.bytes_of[list(vocabulary.values())] = [len(token) for token in vocabulary]
        if self.by_piece:
            spell = self.tokenizer.pre_tokenizer.pre_tokenize_str
            self.speller = Tokenizer(self.tokenizer.model)  # of words that are spelled already, one a line
            self.speller.pre_tokenizer = WhitespaceSplit()
            self.spelling = {32: spell(" a")[0][0][0]}
            for char in filter(str.isalpha, map(chr, range(LETTERS))):
                self.spelling |= dict(zip(char.encode(), spell(char)[0][0], strict=True))

    def whole(self, text: str) -> np.ndarray:
        """Ids of a text by the library alone; it cuts at added tokens before all else."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a column, one after the other, and where each text's ids begin (and the last ones end)."""
        data, offsets = text_bytes(column)
        alone = range(len(column))
        if self.by_piece:
            raw = data.tobytes()
            alone = []
            if any(a.encode() in raw for a in self.added):
                alone = [i for i, t in enumerate(column.to_pylist()) if t and any(a in t for a in self.added)]
        if not len(alone):
            return self.by_pieces(data, offsets)
        out, alone = [], set(alone)
        for i, text in enumerate(column.to_pylist()):
            lo, hi = offsets[i], offsets[i + 1]
            out.append(self.whole(text or "") if i in alone else self.by_pieces(data[lo:hi], np.array([0, hi - lo]))[0])
        return np.concatenate(out), np.concatenate(([0], np.cumsum([len(o) for o in out], dtype=np.int64)))

    def by_pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        cuts = piece_starts(data, offsets)
        told = large_binary(data, np.append(cuts, len(data))).dictionary_encode()
        known, bounds = self.distinct(*binary_bytes(told.dictionary))
        which = told.indices.to_numpy()
        size = np.int32 if len(data) < 1 << 31 else np.int64  # there are no more ids than bytes
        bounds = bounds.astype(size)
        n = (bounds[1:] - bounds[:-1])[which]
        ends = np.cumsum(n, dtype=size)
        at = np.repeat(bounds[which] - (ends - n), n)
        at += np.arange(int(ends[-1]), dtype=size)
        return known[at], np.concatenate(([0], ends)).astype(np.int64)[np.searchsorted(cuts, offsets)]

    def distinct(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, and where each one's begin."""
        pieces = large_binary(data, offsets)
        first, second, last = data[offsets[:-1]], data[np.minimum(offsets[:-1] + 1, len(data) - 1)], data[offsets[1:] - 1]
        spaced = (first == 0x20) & (np.diff(offsets) > 1)
        odd = np.add.reduceat(~letter_bytes(data), offsets[:-1])  # the space is one
        letters = spaced & (odd == 1)
        # in a row, such pieces have a cut of the pre-tokenizer between each other
        plain = spaced & ~letters & WORD_BYTE[second] & ENDS_WORD[last]
        ids, sizes, order = [], np.zeros(len(pieces), np.int64), []
        for kind, spelled in ((letters, True), (plain, False)):
            rows = np.flatnonzero(kind)
            if len(rows):
                found, ends = self.joined(*binary_bytes(pieces.take(pa.array(rows))), spelled)
                sizes[rows] = np.diff(np.concatenate(([0], ends)))
                ids.append(found)
                order.append(rows)
        rows = np.flatnonzero(~letters & ~plain)
        for i in rows.tolist():
            ids.append(self.whole(data[offsets[i]:offsets[i + 1]].tobytes().decode()))
            sizes[i] = len(ids[-1])
        order = np.concatenate([*order, rows])
        flat, at = np.concatenate(ids), np.zeros(len(pieces), np.int64)
        at[order] = np.cumsum(sizes[order]) - sizes[order]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        return flat[np.repeat(at - bounds[:-1], sizes) + np.arange(len(flat))], bounds

    def joined(self, data: np.ndarray, offsets: np.ndarray, spelled: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces put in a row, and where each one's end."""
        edges = [0]
        while edges[-1] < len(offsets) - 1:
            edges.append(max(edges[-1] + 1, int(np.searchsorted(offsets, offsets[edges[-1]] + JOINED, "right")) - 1))
        texts = [data[offsets[a]:offsets[b]].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
        if spelled:
            texts = [t.decode("latin-1").replace(" ", "\n ").translate(self.spelling) for t in texts]
        else:
            texts = [t.decode() for t in texts]
        encoded = (self.speller if spelled else self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in encoded])
        return ids, np.searchsorted(np.cumsum(self.bytes_of[ids]), offsets[1:]) + 1


def letter_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters below ``LETTERS``."""
    two = np.zeros(len(data), bool)  # lead bytes of such letters of two bytes
    two[:-1] = TWO_LEAD[data[:-1]] & ~((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    out = ASCII_LETTER[data] | two
    out[1:] |= two[:-1]
    return out


def large_binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def binary_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a large binary column and the offsets of its rows."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def cuts_at_spaces(tokenizer) -> bool:
    """Whether the tokenizer is a byte-level BPE without a normalizer whose pieces start at spaces."""
    return (
        tokenizer.normalizer is None
        and type(tokenizer.pre_tokenizer).__name__ == "ByteLevel"
        and not tokenizer.pre_tokenizer.add_prefix_space
    )


# Bytes after which a space or line feed surely begins a piece: ASCII but white space and controls, and the last bytes of letters
# that two bytes from C3 on spell. No white space ends so; after other bytes a piece is left longer, which changes no id.
ENDS_WORD = np.zeros(256, bool)
ENDS_WORD[0x21:0x7F] = True
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[0x41:0x5B] = ASCII_LETTER[0x61:0x7B] = True
TWO_LEAD = np.zeros(256, bool)
TWO_LEAD[0xC3:0xC9] = True
WORD_BYTE = ENDS_WORD | (np.arange(256) >= 0xC3)
PAIR_LEAD = np.zeros(256, bool)
PAIR_LEAD[0xC3:0xE0] = True


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin: at each text with bytes, at a space or line feed after a word, and after a line feed between two words."""
    if len(data) == 0:
        return np.zeros(0, np.int64)
    after = np.zeros(len(data), bool)  # of a word's end
    after[1:] = ENDS_WORD[data[:-1]]
    if len(data) > 2:
        after[2:] |= (data[1:-1] >= 0x80) & PAIR_LEAD[data[:-2]]
    feed = (data == 0x0A) & after
    cut = (data == 0x20) & after | feed
    cut[1:] |= feed[:-1] & ENDS_WORD[data[1:]]
    begins = offsets[:-1][np.diff(offsets) > 0]
    cut[begins] = True
    return np.flatnonzero(cut)


_LOADED: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    """One tokenizer for each file and Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def gathered(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches with about ``RUN_BYTES`` of texts, or a single larger row."""
    held, size = [], 0
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        for lo, hi in slices(offsets, RUN_BYTES):
            part, more = batch.slice(lo, hi - lo), int(offsets[hi] - offsets[lo])
            if held and size + more > RUN_BYTES:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(part)
            size += more
    if held:
        yield pa.concat_batches(held)


def encode_column(path: str, column: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a text column, and where each row's begin and the last one's end. ``end`` is appended to each row; null is empty."""
    ids, bounds = loaded(path).encode(column)
    if end is not None:
        ids = np.insert(ids, bounds[1:], np.uint32(end))
        bounds = bounds + np.arange(len(bounds))
    return ids, bounds
