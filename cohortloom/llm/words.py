"""Distinct words of a piece of text, and ids of whole texts by a word-level BPE file.

A tokenizer that drops white space never joins what ASCII white space divides, so each distinct run between such
space is encoded once per piece. Runs of plain Latin letters, digits and punctuation take a faster encoder, made from
the file's merges: the word's end is written as a space, and parts are joined by the rank of what they become. That
equals joining by listed pairs as long as every token can be reached from its own characters, so tokens that cannot
are left out. All other runs go to the tokenizer itself.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from cohortloom.llm.textbytes import NOT_SPACE, Piece
from cohortloom.llm.tokens import _byte_letters


def distinct_words(piece: Piece, inside: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct runs of the flagged bytes, and the row and the run of each occurrence."""
    starts, ends, rows = piece.spans(inside)
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    kept = piece.data[inside[piece.data]]
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(kept)]).dictionary_encode()
    return coded.dictionary, rows, coded.indices.to_numpy()


def _joined(words: pa.Array, at: np.ndarray, end: bytes) -> str:
    """Some of the words as one text, each followed by ``end``."""
    return pc.binary_join(pa.ListArray.from_arrays([0, len(at)], words.take(pa.array(at)).cast(pa.binary())), end)[0].as_py().decode() + end.decode()


# Fixed values of the file format: the end of a word, and how words part.
WORD_END = "</w>"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]

#: Printable ASCII, Latin letters that stay as they are when composed, and common punctuation.
PLAIN = regex.compile(r"[!-~\u00A1\u00AB\u00BB\u00BF\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u01C3\u01CD-\u01F0\u2010-\u2027]+")
#: Bytes of the longest run that the faster encoder takes.
LONGEST = 500
#: Kinds of bytes: 0 a letter of ASCII, 1 other printable ASCII, 2 part of another character, 3 a control character.
KIND = np.full(256, 3, np.uint8)
KIND[0x80:], KIND[0x21:0x7F] = 2, 1
KIND[0x41:0x5B] = KIND[0x61:0x7B] = 0


@lru_cache(2)
def word_encoder(file: str) -> WordEncoder:
    """One encoder per file and Python worker; ``file`` is a path or a name among the public files."""
    return WordEncoder(file)


class WordEncoder:
    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import tiktoken
        from tokenizers import Tokenizer, models

        if "/" not in file:
            import public_tokenizers

            file = public_tokenizers.path(file)
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = (spec["normalizer"] or {}).get("normalizers", []), (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        known = [n["type"] for n in steps[0]] == NORMALIZERS and steps[1][0].get("pattern") == {"Regex": SPLIT}
        if not known or model.get("end_of_word_suffix") != WORD_END:
            raise ValueError(f"{file} is not a word-level BPE file that drops white space")
        self.tokenizer = Tokenizer.from_file(file)
        self.special = [t["content"].encode() for t in spec["added_tokens"]]

        # Ranks: the characters, the characters at a word's end, then the merges in their order.
        end, vocab, merges = "\uE000", model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        marked = {t.removesuffix(WORD_END) + end if t.endswith(WORD_END) else t: i for t, i in vocab.items()}
        pairs = [tuple(x.removesuffix(WORD_END) + end if x.endswith(WORD_END) else x for x in m) for m in merges]
        letters = _byte_letters()
        # The plain model has no word ends of its own: there the end is a character, joined before all else.
        alone = {c + end: i for c in letters if (i := marked.get(c + end)) is not None}
        plain = Tokenizer(models.BPE({**marked, end: max(vocab.values()) + 1}, [(t[0], end) for t in alone] + pairs))
        joined = ["".join(m) for m in pairs]
        found = plain.encode_batch(joined, add_special_tokens=False)
        reached = [t for t, f in zip(joined, found, strict=True) if len(f.ids) == 1]
        order = [*[c for c in letters if c in marked], *alone, *dict.fromkeys(reached)]
        self.ids = np.array([marked[t] for t in order], np.uint32)
        as_bytes = {**letters, end: 0x20}
        ranks = {}
        for rank, token in enumerate(order):
            ranks.setdefault(bytes(as_bytes[c] for c in token), rank)
        self.line_end = ranks[b"\n"]
        self.fast = tiktoken.Encoding("words", pat_str=r"[^ \n]+ |\n", mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(SPLIT)
        self.largest = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])

    def _lines(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of runs that end with a line each, and how many each has."""
        found = np.asarray(self.fast.encode_to_numpy(text))
        last = found == self.line_end
        ends = np.flatnonzero(last)
        return self.ids[found[~last]], np.diff(ends, prepend=-1) - 1

    def encode(self, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows of a piece one after another, and where each row begins (and the last one ends)."""
        distinct, rows, word = distinct_words(piece, NOT_SPACE)
        if not len(distinct):
            return np.empty(0, np.uint32), np.zeros(len(piece) + 1, np.int64)
        bounds = np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1]
        data = np.frombuffer(distinct.buffers()[2], np.uint8)[: bounds[-1]]
        worst = np.maximum.reduceat(KIND[data], bounds[:-1])
        worst[np.diff(bounds) > LONGEST] = 3
        at = np.flatnonzero(worst == 2)
        worst[at] = [1 if PLAIN.fullmatch(t.decode()) else 3 for t in distinct.take(pa.array(at)).to_pylist()]
        whole = data.tobytes()
        if any(s in whole for s in self.special):
            at = np.flatnonzero(worst == 1)
            worst[at] = [3 if any(s in t for s in self.special) else 1 for t in distinct.take(pa.array(at)).to_pylist()]
        letters, plain, hard = (np.flatnonzero(worst == k) for k in (0, 1, 3))
        parts = []
        if len(letters):
            parts.append(self._lines(_joined(distinct, letters, b" \n").lower()))
        if len(plain):
            parts.append(self._lines(self.split.sub(r"\g<0> ", _joined(distinct, plain, b"\n").lower())))
        if len(hard):
            ids = [f.ids for f in self.tokenizer.encode_batch([t.decode() for t in distinct.take(pa.array(hard)).to_pylist()], add_special_tokens=False)]
            parts.append((np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64)))
        store, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.concatenate([letters, plain, hard])
        begin, size = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        begin[order], size[order] = np.cumsum(sizes) - sizes, sizes
        begin, size = begin[word], size[word]
        to = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        flat = store[np.repeat(begin - to[:-1], size) + np.arange(to[-1])]
        return flat, to[np.searchsorted(rows, np.arange(len(piece) + 1))]
