"""Token ids of whole texts, made in Arrow batches with a tokenizers file whose path is a parameter.

Texts repeat their words, so each task cuts texts into segments that the tokenizer would cut apart as well, encodes segments
it hasn't seen with the tokenizers library, and puts the ids of all segments together. Segments are looked up by a hash, and
compared byte by byte with what is remembered under it; those that only share a hash are encoded by themselves. How texts may be cut depends on the tokenizer: before a
space that begins a word (byte-level), or at white space (where that is dropped). With any other tokenizer, and for texts
where the cut isn't sure, whole texts are encoded.

A tokenizer is named by its file: a path, or the name of a public vocabulary file, which each task resolves for itself.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import _SPACE, Words, _blocks, chunks, same_spans, span_sums

#: Segments that a task remembers, and bytes of their names; beyond either, it starts anew.
REMEMBERED, NAMES = 1_000_000, 16_000_000
#: Segments that the tokenizer gets as one text, and bytes of the longest of them.
JOINED, LONGEST = 16, 64


@functools.cache
def tokenizer(path: str):
    """The tokenizer of a file; strings of special tokens are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(token_file(path))
    found.encode_special_tokens = True
    return found


@functools.cache
def cut_of(path: str) -> str:
    """``space``, ``word`` or ``whole``: where a tokenizer's texts may be cut."""
    with open(token_file(path), encoding="utf-8") as f:
        spec = json.load(f)
    pre, normalizer = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and normalizer is None:
        return "space"
    parts = pre.get("pretokenizers", [])
    if parts and parts[0].get("type") == "Split" and parts[0].get("behavior") == "Removed" and parts[0].get("invert") and r"[^\s" in parts[0].get("pattern", {}).get("Regex", "") and spec["model"].get("type") == "BPE":
        return "word"
    return "whole"


@functools.cache
def byte_lengths(path: str) -> np.ndarray | None:
    """Bytes that each id stands for, if the tokenizer is byte-level: its vocabulary writes each byte as one character."""
    if cut_of(path) != "space":
        return None
    vocabulary = tokenizer(path).get_vocab()
    found = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
    found[list(vocabulary.values())] = list(map(len, vocabulary))
    return found


def _flat(texts: list[str], tok) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, and how many each has."""
    ids = [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(size.sum())), size


def _ids_of(raw: bytes, span: np.ndarray, tok, lengths: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The ids of segments that lie side by side in ``raw``, and how many each has.

    Words with the space before them are cut from each other by a byte-level tokenizer, so several are encoded as one text. Where
    the ids of each begin follows from the bytes they stand for; should an id reach over a border, each segment is encoded alone.
    """
    ends = np.cumsum(span)
    offsets = np.concatenate([[0], ends])
    alone = lambda: _flat([raw[a:b].decode() for a, b in itertools.pairwise(offsets.tolist())], tok)
    if lengths is None or not len(span):
        return alone()
    data = np.frombuffer(raw, np.uint8)
    first = offsets[:-1]
    joins = (span > 1) & (span <= LONGEST) & (data[first] == 32) & ~_SPACE[data[np.minimum(first + 1, len(data) - 1)]] & ~_SPACE[data[ends - 1]] & ~_other_spaces(data, offsets)
    new = ~joins
    new[1:] |= ~joins[:-1]
    new[::JOINED] = True
    borders = np.append(first[new], len(data))
    ids, _ = _flat([raw[a:b].decode() for a, b in itertools.pairwise(borders.tolist())], tok)
    place = np.cumsum(lengths[ids])
    last = np.searchsorted(place, ends)
    if last[-1] != len(place) - 1 or (place[last] != ends).any():
        return alone()
    return ids, np.diff(last, prepend=-1)


class _Pool:
    """A growing array."""

    def __init__(self, kind: type):
        self.data, self.used = np.zeros(1 << 12, kind), 0

    def add(self, values: np.ndarray) -> int:
        """Where ``values`` are; eight places more are kept free behind."""
        at, self.used = self.used, self.used + len(values)
        if self.used + 8 > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(len(self.data) // 2, len(values) + 8), self.data.dtype)])
        self.data[at : self.used] = values
        return at


class Memory:
    """The ids of segments. Hashes are in sorted parts, merged as they grow, each with the numbers of its segments."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.at, self.size, self.name_at, self.name_size = (_Pool(np.int64) for _ in range(4))
        self.ids, self.names = _Pool(np.uint32), _Pool(np.uint8)

    def trimmed(self) -> Memory:
        """This memory, or an empty one where it has grown beyond its limits."""
        return self if self.at.used <= REMEMBERED and self.names.used <= NAMES else Memory()

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the segment of each hash, -1 where it is new."""
        found = np.full(len(hashes), -1, np.int64)
        for known, number in self.parts:
            k = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            found = np.where(known[k] == hashes, number[k], found)
        return found

    def _encode(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, tok, lengths: np.ndarray | None) -> np.ndarray:
        """Numbers of segments after encoding them."""
        base, raw = self.at.used, data.tobytes()
        for i in range(0, len(start), 2_000):
            names = b"".join(raw[a:b] for a, b in zip(start[i : i + 2_000].tolist(), end[i : i + 2_000].tolist(), strict=True))
            span = end[i : i + 2_000] - start[i : i + 2_000]
            ids, size = _ids_of(names, span, tok, lengths)
            self.at.add(self.ids.add(ids) + np.cumsum(size) - size)
            self.size.add(size)
            self.name_at.add(self.names.add(np.frombuffer(names, np.uint8)) + np.cumsum(span) - span)
            self.name_size.add(span)
        return np.arange(base, self.at.used)

    def numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, tok, lengths: np.ndarray | None = None) -> np.ndarray:
        """The number of each segment; new ones are encoded."""
        name, first, of = np.unique(span_sums(data, start, end), return_index=True, return_inverse=True)
        of = of.ravel()
        number = self._find(name)
        known = np.flatnonzero(number >= 0)
        blocks, size = _blocks(data), end - start
        kept = np.ndarray(len(self.names.data) - 7, "<u8", self.names.data, strides=(1,))
        same = self.name_size.data[number[known]] == size[first[known]]
        known, clash = known[same], known[~same]
        # The hash of up to eight bytes is one-to-one for spans of one size: only longer ones are compared.
        known = known[size[first[known]] > 8]
        same = same_spans(blocks, start[first[known]], kept, self.name_at.data[number[known]], size[first[known]])
        number[clash] = number[known[~same]] = -2
        fresh = np.flatnonzero(number == -1)
        if len(fresh):
            number[fresh] = self._encode(data, start[first[fresh]], end[first[fresh]], tok, lengths)
            part = name[fresh], number[fresh]
            while self.parts and len(self.parts[-1][0]) < 4 * len(part[0]):
                other = self.parts.pop()
                order = np.argsort(both := np.concatenate([other[0], part[0]]), kind="stable")
                part = both[order], np.concatenate([other[1], part[1]])[order]
            self.parts.append(part)
        out = number[of]
        rows = np.flatnonzero((start != start[first[of]]) & (out >= 0))
        same = size[rows] == size[first[of[rows]]]
        out[rows[~same]] = -2  # as above, equal sizes are enough up to eight bytes
        rows = rows[same & (size[rows] > 8)]
        out[rows[~same_spans(blocks, start[rows], blocks, start[first[of[rows]]], size[rows])]] = -2
        alone = np.flatnonzero(out == -2)
        if len(alone):
            out[alone] = self._encode(data, start[alone], end[alone], tok, lengths)
        return out


_MEMORY: dict[str, Memory] = {}


def _segments(data: np.ndarray, offsets: np.ndarray, cut: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of the segments in order."""
    w = Words(data, offsets)
    if cut == "word":
        return w.start, w.end, w.doc
    # With spaces: a word has the space right before it; what white space is left between is one piece, but its last
    # character stands alone if a word follows it at once.
    before = np.concatenate([[0], w.end[:-1]]) if len(w.start) else w.end
    new = np.concatenate([[True], w.doc[1:] != w.doc[:-1]]) if len(w.doc) else np.zeros(0, bool)
    before = np.where(new, offsets[w.doc], before)
    spaced = (w.start > before) & (data[np.maximum(w.start - 1, 0)] == 32)
    lead = w.start - spaced
    alone = ~spaced & (lead > before)
    run_end = lead - alone
    run = run_end > before
    last = np.full(len(offsets) - 1, -1, np.int64)
    last[w.doc] = w.end  # the last word's end of each text
    tail_start = np.where(last >= 0, last, offsets[:-1])
    tail = tail_start < offsets[1:]
    start = np.concatenate([lead, before[run], run_end[alone], tail_start[tail]])
    end = np.concatenate([w.end, run_end[run], lead[alone], offsets[1:][tail]])
    doc = np.concatenate([w.doc, w.doc[run], w.doc[alone], np.flatnonzero(tail)])
    order = np.argsort(start, kind="stable")
    return start[order], end[order], doc[order]


def _other_spaces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts may have white space beyond ASCII."""
    a, b = data[:-1], data[1:]
    hit = ((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & (b == 0x9A)) | ((a == 0xE2) & ((b == 0x80) | (b == 0x81))) | ((a == 0xE3) & (b == 0x80))
    found = np.zeros(len(offsets) - 1, bool)
    found[np.searchsorted(offsets, np.flatnonzero(hit), side="right") - 1] = True
    return found


def encoded(column: pa.Array | pa.ChunkedArray, path: str, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids of all texts of a run of rows, offsets of each text's ids). Null is empty; each text ends with ``end_id``."""
    tok, cut = tokenizer(path), cut_of(path)
    for a, b, data, offsets in chunks(column, 1_000_000):
        memory = _MEMORY[path] = _MEMORY[path].trimmed() if path in _MEMORY else Memory()
        if cut == "whole":
            full = np.flatnonzero(np.diff(offsets))
            start, end, doc = offsets[:-1][full], offsets[1:][full], full
        else:
            start, end, doc = _segments(data, offsets, cut)
            if cut == "space" and (odd := _other_spaces(data, offsets)).any():
                keep = ~odd[doc]
                whole = np.flatnonzero(odd)
                start, end, doc = np.concatenate([start[keep], offsets[:-1][whole]]), np.concatenate([end[keep], offsets[1:][whole]]), np.concatenate([doc[keep], whole])
                order = np.argsort(start, kind="stable")
                start, end, doc = start[order], end[order], doc[order]
        number = memory.numbers(data, start, end, tok, byte_lengths(path))
        size = memory.size.data[number]
        counts = np.bincount(doc, size, b - a).astype(np.int64)
        offs = np.concatenate([[0], np.cumsum(counts + 1)])
        ids = np.empty(offs[-1], np.uint32)
        # Where each segment's ids go: after all before it, and the end ids of the texts before.
        shift = np.cumsum(size) - size
        source = np.arange(size.sum()) + np.repeat(memory.at.data[number] - shift, size)
        ids[np.arange(size.sum()) + np.repeat(doc, size)] = memory.ids.data[source]
        ids[offs[1:] - 1] = end_id
        yield a, ids, offs


def token_file(name: str) -> str:
    """The path of a tokenizer's file: ``name`` itself if it is a path, else where the public vocabulary file of that name lies."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
