"""Segments that are encoded several at a time have the ids that each has alone."""

import numpy as np


class Counting:
    """A tokenizer that notes how many texts it gets."""

    def __init__(self, tok):
        self.tok, self.texts = tok, 0

    def encode_batch_fast(self, texts, add_special_tokens):
        self.texts += len(texts)
        return self.tok.encode_batch_fast(texts, add_special_tokens=add_special_tokens)


def test_segments_share_texts():
    from colscope.llm.tokens import JOINED, Memory, byte_lengths, tokenizer

    path = "byte_bpe_50k.json"
    words = [f" w{k}é'{k * 7919}" for k in range(1_600)]
    odd = ["\n", "  ", " \u00a0x", " x\u00a0", " y", "\u3000", "z", " " + "long" * 40, " <|endoftext|>", " 's", "'s", " ", " \u4f60\U0001f600", "\t", " .", " !?", " \x1cq"]
    for segments, most in ((words, len(words) // JOINED), (odd * 3 + words[:50] + odd[::-1], None)):
        raw = [x.encode() for x in segments]
        ends = np.cumsum([len(x) for x in raw])
        starts = ends - [len(x) for x in raw]
        tok, memory = Counting(tokenizer(path)), Memory()
        number = memory.numbers(np.frombuffer(b"".join(raw), np.uint8), starts, ends, tok, byte_lengths(path))
        got = [memory.ids.data[memory.at.data[n] : memory.at.data[n] + memory.size.data[n]].tolist() for n in number]
        assert got == [tokenizer(path).encode(x, add_special_tokens=False).ids for x in segments]
        assert most is None or tok.texts <= most


def test_ids_over_a_border_are_undone():
    """A vocabulary whose ids don't stand for the bytes that were said: each segment is encoded alone."""
    from colscope.llm.tokens import _ids_of, byte_lengths, tokenizer

    path, words = "byte_bpe_50k.json", [" ab", " cd", " token"]
    raw, span = "".join(words).encode(), np.array([3, 3, 6])
    for lengths in (byte_lengths(path), byte_lengths(path) + 1, None):
        ids, size = _ids_of(raw, span, tokenizer(path), lengths)
        cut = np.cumsum(size)[:-1]
        assert [x.tolist() for x in np.split(ids, cut)] == [tokenizer(path).encode(x, add_special_tokens=False).ids for x in words]
