"""Cutting texts into chunks that a byte-level tokenizer encodes each on its own.

A word of such a tokenizer takes the one blank before it, so a blank after a
character that is no white space always starts a word. Texts cut there repeat
most of their chunks, and a chunk's ids are worked out once and remembered.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: White space, in an engine that scans fast, before a blank; some controls more than needed.
_DOUBLE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}] "
)
_CUT = regex.compile(r"(?<=\S) ")

#: Chunks remembered from one batch to the next; beyond, the older half stays, in which
#: the common ones are.
CHUNKS_KEPT = 400_000


def chunk_keys(text: str) -> list[Hashable]:
    """Keys of the chunks in order; the first, which has no blank before it, in a tuple."""
    parts = _CUT.split(text)
    return [(parts[0],), *parts[1:]]


def chunk_text(key: Hashable) -> str:
    return key[0] if isinstance(key, tuple) else f" {key}"


def bounded(known: dict, kept: int) -> dict:
    """The dictionary, or its older half if it has more than ``kept`` entries."""
    return known if len(known) <= kept else dict(islice(known.items(), kept // 2))


class ChunkMemory:
    """Ids of texts by ``encode`` of their chunks, each chunk given to it once.

    ``encode`` takes distinct chunks and gives each one's ids as bytes.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], kept: int = CHUNKS_KEPT):
        self.encode_chunks = encode
        self.kept = kept
        self.known: dict[Hashable, bytes] = {}

    def _ids(self, keys: list[Hashable]) -> list[bytes]:
        got = list(map(self.known.get, keys))
        holes = [k for k, ids in enumerate(got) if ids is None]
        if not holes:
            return got
        new = list(dict.fromkeys(keys[k] for k in holes))
        self.known.update(zip(new, self.encode_chunks(list(map(chunk_text, new))), strict=True))
        for k in holes:
            got[k] = self.known[keys[k]]
        return got

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Repeated chunks are found by Arrow and looked up once per call."""
        self.known = bounded(self.known, self.kept)
        column = pa.array(texts, pa.large_string())
        double = pc.match_substring_regex(column, _DOUBLE).to_numpy(zero_copy_only=False)
        out = [b""] * len(texts)
        for k in np.flatnonzero(double).tolist():
            out[k] = b"".join(self._ids(chunk_keys(texts[k])))
        # Without such places every blank is one that a word begins with.
        plain = np.flatnonzero(~double).tolist()
        if not plain:
            return out
        split = pc.split_pattern(column.filter(pa.array(~double)), " ")
        begin = split.offsets.to_numpy()[:-1]
        chunks = split.flatten().dictionary_encode()
        names = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        # The first chunk of a text has no blank before it and is a name of its own.
        which = chunks.indices.to_numpy().astype(np.int64)
        firsts = [(texts[k].partition(" ")[0],) for k in plain]
        which[begin] = len(names) + np.arange(len(plain))
        ids = pa.array(self._ids([*names, *firsts]), pa.large_binary())
        # All texts' ids stand one after the other in the memory of the taken column.
        found = ids.take(pa.array(which))
        _, places, body = found.buffers()
        body = memoryview(body or b"")
        ends = np.frombuffer(places, np.int64, len(found) + 1)
        cuts = [*ends[begin].tolist(), int(ends[-1])]
        for at, k in enumerate(plain):
            out[k] = bytes(body[cuts[at] : cuts[at + 1]])
        return out


def in_portions(texts: pa.Array, most: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``most`` characters, with the place of the first; null is empty."""
    begin, run, size = 0, [], 0
    for k, text in enumerate(texts):
        run.append(text.as_py() or "")
        size += len(run[-1])
        if size >= most:
            yield begin, run
            begin, run, size = k + 1, [], 0
    if run:
        yield begin, run
