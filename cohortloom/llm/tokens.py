"""Token ids of whole texts by a public byte-level BPE file.

The ids are those of ``tokenizers`` with ``add_special_tokens=False``. Before white space that follows
other characters a token always begins, so a text is cut there into chunks, and each distinct chunk
is encoded once and kept. Ordinary chunks take a faster encoder built from the same file; chunks
with a special token's string, or of over ``LONG_CHUNK`` bytes, go to ``tokenizers`` itself.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np

from cohortloom.llm.textbytes import NOT_SPACE, Piece

LONG_CHUNK = 2000
#: Chunks that a Python worker keeps; it begins anew when they are reached.
MOST_KEPT = 200_000
DEFAULT_FILE = "byte_bpe_50k.json"


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: printable bytes stand for themselves, the others follow 0xFF."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(2)
def encoder(file: str) -> Encoder:
    """One encoder per file and Python worker; ``file`` is a path or a name among the public files."""
    return Encoder(file)


class Encoder:
    def __init__(self, file: str):
        import public_tokenizers
        import tiktoken

        self.path = file if "/" in file else public_tokenizers.path(file)
        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        self.special = [t["content"] for t in spec["added_tokens"]]
        known = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        ranks = {bytes(letters[c] for c in t): i for t, i in known.items()}
        self.fast = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.widths = np.zeros(max(spec["model"]["vocab"].values()) + len(self.special) + 1, np.int64)
        for raw, i in ranks.items():
            self.widths[i] = len(raw)
        for token in spec["added_tokens"]:
            self.widths[token["id"]] = len(token["content"].encode())

        self.clear()

    @cached_property
    def exact(self):
        """The tokenizer itself; few workers ever need it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def clear(self) -> None:
        """Forgets the chunks, as at the end of a task: the worker may go on with other work."""
        self.kept: dict[bytes, int] = {}
        self.store = np.empty(1 << 18, np.uint32)
        self.edges = np.zeros(MOST_KEPT + 1, np.int64)

    def ids(self, text: str) -> np.ndarray:
        if len(text) > LONG_CHUNK or any(s in text for s in self.special):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)

    def _keep(self, found: list[bytes], plain: list[bool]) -> list[int]:
        """Encodes new chunks and gives their numbers.

        Plain chunks begin with white space and end with something else, so tokens never join them:
        they are encoded as one text, which the tokens' widths divide again.
        """
        joined = b"".join(c for c, p in zip(found, plain, strict=True) if p).decode()
        if any(s in joined for s in self.special):
            plain, joined = [False] * len(found), ""
        together = np.array(self.fast.encode_to_numpy(joined), np.uint32) if joined else np.empty(0, np.uint32)
        sizes = np.cumsum([0, *(len(c) for c, p in zip(found, plain, strict=True) if p)])
        cut = np.searchsorted(np.cumsum(self.widths[together]), sizes, "left") + 1
        cut[0] = 0
        parts, at = [], 0
        for chunk, is_plain in zip(found, plain, strict=True):
            if is_plain:
                parts.append(together[cut[at] : cut[at + 1]])
                at += 1
            else:
                parts.append(self.ids(chunk.decode()))
        n = len(self.kept)
        numbers = list(range(n, n + len(found)))
        self.edges[n + 1 : n + 1 + len(found)] = self.edges[n] + np.cumsum([len(x) for x in parts])
        while self.edges[n + len(found)] > len(self.store):
            self.store = np.concatenate([self.store, np.empty_like(self.store)])
        self.store[self.edges[n] : self.edges[n + len(found)]] = np.concatenate(parts)
        self.kept.update(zip(found, numbers, strict=True))
        return numbers

    def rows(self, piece: Piece) -> Iterator[np.ndarray]:
        """The ids of each row of a piece."""
        starts, ends = chunks(piece)
        _, first, back = np.unique(piece.hashes(starts, ends), return_index=True, return_inverse=True)
        if len(self.kept) + len(first) > MOST_KEPT:
            self.clear()
        if len(first) > MOST_KEPT:  # a text alone that has more distinct chunks than are kept
            for r in range(len(piece)):
                yield self.ids(piece.text(r).decode())
            return
        raw = piece.data.tobytes()
        held = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        number = [self.kept.get(chunk, -1) for chunk in held]
        new = [i for i, n in enumerate(number) if n < 0]
        if new:
            at = first[new]
            plain = ~NOT_SPACE[piece.data[starts[at]]] & ~np.isin(ends[at], piece.bounds) & (ends[at] - starts[at] <= LONG_CHUNK)
            for i, n in zip(new, self._keep([held[i] for i in new], plain.tolist()), strict=True):
                number[i] = n
        own = np.array(number, np.int64)[back]
        begin, size = self.edges[own], self.edges[own + 1] - self.edges[own]
        to = np.concatenate([[0], np.cumsum(size)])
        flat = self.store[np.repeat(begin - to[:-1], size) + np.arange(to[-1])]
        row = to[np.searchsorted(starts, piece.bounds)]
        for r in range(len(piece)):
            yield flat[row[r] : row[r + 1]]


def chunks(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the chunks: each begins with its row, or with ASCII white space after another character.

    White space outside ASCII is told by its last bytes; where these leave a doubt no chunk begins.
    """
    data = piece.data
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    space = ~NOT_SPACE[data]
    begin = space.copy()
    begin[0] = False
    begin[1:] &= ~space[:-1]
    at = np.flatnonzero(begin)
    one, two, three = data[at - 1], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    doubt = (two == 0xC2) & ((one == 0x85) | (one == 0xA0)) | (one >= 0x80) & (three >= 0xE1) & (three <= 0xE3)
    begin[at[doubt]] = False
    begin[piece.bounds[:-1][np.diff(piece.bounds) > 0]] = True
    starts = np.flatnonzero(begin)
    return starts, np.append(starts[1:], len(data))
