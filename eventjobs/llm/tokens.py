"""Token ids of whole texts with a public byte-level BPE file, at the speed a corpus needs.

A text is cut before single spaces and line ends, which is where the tokenizer's own splitting cuts it if no white
space touches the cut's. Pieces repeat a lot, so the texts of a pass are cut as one run of bytes, Arrow finds the distinct
pieces, those are encoded in one call, and their ids are laid out in the texts' order. Nothing is kept from pass to pass.
A text with other white space, or with a special token's text in it, goes to the tokenizer as a whole. Either way the ids
are the tokenizer's, as a test shows.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

from .shared import passes

#: Bytes of text whose pieces are looked at together.
TOGETHER = 1 << 23
_OTHER_WHITE = re.compile(r"[^\S \n]")
_loaded: dict[str, Encoder] = {}


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the rest in order from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids by the tokenizers file at path."""

    def __init__(self, path: str, pattern: str):
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = tuple(x["content"] for x in spec.get("added_tokens", []))
        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in token): n for token, n in spec["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.line = ranks[b"\n"]

    def _plain(self, text: str) -> bool:
        """Whether text is pieces of a single space or line end, or none, and other characters."""
        double = any(pair in text for pair in ("  ", " \n", "\n ", "\n\n"))
        return not double and not text.endswith((" ", "\n")) and not _OTHER_WHITE.search(text) and not any(s in text for s in self.special)

    def _piece_ids(self, pieces: pa.Array) -> pa.Array:
        """The ids of each of some distinct pieces, as bytes."""
        words = pieces.to_pylist()
        lines = np.fromiter((p[0] == 10 for p in words), dtype=bool, count=len(words))
        bare = b"\n".join(p[1:] if line else p for p, line in zip(words, lines, strict=True))
        ids = np.array(self.fast.encode_ordinary(bare.decode()), dtype="<u4")
        # No piece holds a line end: those between pieces give way to those that pieces begin with.
        between = np.flatnonzero(ids == self.line)
        keep = np.ones(ids.size, dtype=bool)
        keep[between] = lines[1:]
        ends = np.append(np.cumsum(keep)[between] - lines[1:], keep.sum())
        ids = ids[keep]
        if lines[0]:
            ids, ends = np.append(np.uint32(self.line), ids), ends + 1
        return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(np.append(0, ends) * 4), pa.py_buffer(ids)])

    def _cut(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of texts that are plain and not empty."""
        buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
        text_at = np.append(0, np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))))
        begins = (buf == 32) | (buf == 10)
        begins[text_at[:-1]] = True
        at = np.append(np.flatnonzero(begins), buf.size)
        pieces = pa.Array.from_buffers(pa.large_binary(), at.size - 1, [None, pa.py_buffer(at), pa.py_buffer(buf)]).dictionary_encode()
        ids = self._piece_ids(pieces.dictionary).take(pieces.indices)
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int64, count=at.size) // 4
        flat = np.frombuffer(ids.buffers()[2], dtype="<u4", count=ends[-1])
        cuts = ends[np.searchsorted(at, text_at)]
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Of each text, as unsigned 32-bit numbers."""
        raw = [text.encode() for text in texts]
        out: list[np.ndarray] = [np.zeros(0, dtype="<u4")] * len(texts)
        for a, b in passes(raw, TOGETHER):
            plain = [k for k in range(a, b) if texts[k] and self._plain(texts[k])]
            for k in set(range(a, b)).difference(plain):
                out[k] = np.array(self.whole.encode(texts[k], add_special_tokens=False).ids, dtype="<u4")
            if plain:
                for k, ids in zip(plain, self._cut([raw[k] for k in plain]), strict=True):
                    out[k] = ids
        return out


def encoder(path: str) -> Encoder:
    """One for each file and worker."""
    if path not in _loaded:
        import public_tokenizers

        _loaded[path] = Encoder(path, public_tokenizers.PATTERN)
    return _loaded[path]
