"""Byte-pair encoding by a trie of distinct words that shares the work of prefixes.

A word's encoding is fixed by the last token of each of its prefixes: the last
token ``t`` of a prefix is the longest token that ends it and may follow the
last token of the prefix before ``t``. Two tokens may stand side by side if
merging their bytes gives the two again; a sequence is the encoding exactly if
all its neighbours may. A walk over the trie, depth first, works out one last
token per node, so a prefix of many words is encoded once.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.llm.chunks import ChunkMemory, bounded, in_portions

#: Words remembered besides the chunks they stand in.
WORDS_KEPT = 700_000
#: Pairs of tokens remembered as fit or unfit neighbours; beyond, the memory starts anew.
PAIRS_KEPT = 1_000_000


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class ByteVocabulary:
    """A byte-level BPE file of the tokenizers library: tokens, merges, added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = before["type"] == "ByteLevel" and before["use_regex"]
        if model["type"] != "BPE" or not plain or before["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        letters = byte_letters()

        def as_bytes(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        self.ids = {as_bytes(token): n for token, n in model["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            left, right = as_bytes(a), as_bytes(b)
            pair = self.ids[left], self.ids[right]
            self.ranks[pair] = rank, self.ids[left + right]
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        for x in spec["added_tokens"]:
            if x["single_word"] or x["lstrip"] or x["rstrip"]:
                raise ValueError(f"{path} has added tokens that take their surroundings")
        last = max([*self.ids.values(), *self.added.values()])
        self.pieces = [b""] * (last + 1)
        for token, n in self.ids.items():
            self.pieces[n] = token
        for content, n in self.added.items():
            self.pieces[n] = content.encode()
        self.single = [self.ids[bytes([b])] for b in range(256)]
        #: Per token: the rank of the merge that makes it, and its two halves.
        self.made = [-1] * (last + 1)
        self.halves = [(-1, -1)] * (last + 1)
        for pair, (rank, joined) in self.ranks.items():
            if self.made[joined] < 0:
                self.made[joined], self.halves[joined] = rank, pair
        self.tree: dict = {}
        for token, n in self.ids.items():
            if self.made[n] < 0 and len(token) > 1:
                raise ValueError(f"{path} has a token that no merge makes")
            node = self.tree
            for b in token:
                node = node.setdefault(b, {})
            node[-1] = n
        self._beside: dict[int, bool] = {}

    def merged(self, text: bytes) -> list[int]:
        """Merge by rank, the plain way; what the walk must agree with."""
        ids = [self.single[b] for b in text]
        while len(ids) > 1:
            ranked = [(self.ranks[p][0], p) for p in zip(ids, ids[1:]) if p in self.ranks]
            if not ranked:
                break
            pair = min(ranked)[1]
            joined, out, k = self.ranks[pair][1], [], 0
            while k < len(ids):
                if tuple(ids[k : k + 2]) == pair:
                    out.append(joined)
                    k += 2
                else:
                    out.append(ids[k])
                    k += 1
            ids = out
        return ids

    def may_follow(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of the two tokens while they come about.

        Goes back in time: of the two tokens at the border the one made last is
        taken apart, down to single bytes. Two neighbours merge if their merge
        ranks before the one that used up one of them; of equal ranks the left
        one goes first.
        """
        made, halves, ranks = self.made, self.halves, self.ranks
        limit, ties = len(ranks) + 1, False
        while True:
            across = ranks.get((left, right))
            if across is not None and (across[0] < limit or ties and across[0] == limit):
                return False
            if made[left] < 0 and made[right] < 0:
                return True
            if made[right] >= made[left]:
                limit, ties, right = made[right], True, halves[right][0]
            else:
                limit, ties, left = made[left], False, halves[left][1]

    def encode_words(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """The ids of each distinct word, by one walk over the trie of all of them.

        Sorted words are the trie's depth-first order: what a word shares with
        the one before is the path to their common node, whose states stay. The
        state after ``d`` bytes is the last token of that prefix, where it
        starts, and the places in the vocabulary's own trie of the tokens that
        may still end further on.
        """
        found: dict[bytes, list[int]] = {}
        last, start, live, before = [-1], [0], [[]], b""
        root, beside, may = self.tree, self._beside, self.may_follow
        for word in sorted(set(words)):
            shared = 0
            for a, b in zip(word, before, strict=False):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], start[shared + 1 :], live[shared + 1 :]
            going = live[shared]
            for at in range(shared, len(word)):
                byte, ended = word[at], -1
                going.append((at, root))
                step = []
                for begin, node in going:
                    if byte not in node:
                        continue
                    child = node[byte]
                    step.append((begin, child))
                    if ended < 0 and -1 in child:  # longest first
                        n = child[-1]
                        if begin == 0:
                            ended, place = n, 0
                        else:
                            pair = last[begin] << 20 | n
                            if pair in beside:
                                fits = beside[pair]
                            else:
                                fits = beside[pair] = may(last[begin], n)
                            if fits:
                                ended, place = n, begin
                going.pop()
                last.append(ended)
                start.append(place)
                live.append(step)
                going = step
            before, out, at = word, [], len(word)
            while at:
                out.append(last[at])
                at = start[at]
            found[word] = out[::-1]
        if len(beside) > PAIRS_KEPT:
            beside.clear()
        return found


@lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteVocabulary:
    return ByteVocabulary(path)


#: Fixed value: how byte-level vocabularies of this kind cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Texts to ids and back; distinct words are encoded once and remembered."""

    def __init__(self, path: str):
        self.vocabulary = vocabulary(path)
        self.words = regex.compile(WORDS)
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        if any(" " in content for content in added):
            raise ValueError(f"{path} has added tokens with blanks")
        self.added = regex.compile(f"({'|'.join(map(regex.escape, added))})") if added else None
        self.of_added = {
            content: np.array([n], "<u4").tobytes()
            for content, n in self.vocabulary.added.items()
        }
        self.coded: dict[str, bytes] = {}
        self.memory = ChunkMemory(self.encode_chunks)

    def cut(self, chunk: str) -> list[str]:
        """The words of a chunk; added tokens stand alone."""
        if self.added is None or self.added.search(chunk) is None:
            return self.words.findall(chunk)
        words: list[str] = []
        for k, part in enumerate(self.added.split(chunk)):
            words += [part] if k % 2 else self.words.findall(part)
        return words

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        cut = [self.cut(chunk) for chunk in chunks]
        self.coded = coded = bounded(self.coded, WORDS_KEPT)
        coded.update(self.of_added)
        raw = {word: word.encode() for words in cut for word in words if word not in coded}
        ids = self.vocabulary.encode_words(list(raw.values()))
        coded.update((word, np.array(ids[text], "<u4").tobytes()) for word, text in raw.items())
        return [b"".join(map(coded.__getitem__, words)) for words in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        return self.memory.encode(texts)

    def decode(self, ids: bytes) -> str:
        pieces = self.vocabulary.pieces
        joined = b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return joined.decode("utf-8", "replace")


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder per worker process: its memory serves all tasks the worker runs."""
    return Encoder(path)


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: n_tokens and digests of the ids and of the text decoded from them.

    Null and empty texts have no ids and decode to the empty text. Null ids and
    repeated rows are encoded like any other row. Other columns are not looked
    at. An empty table gives no rows.
    """
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for begin, texts in in_portions(batch["_text"]):
                ids = coder.encode(texts)
                text_back = [coder.decode(x).encode("utf-8") for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(begin, len(texts)),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(x).hexdigest() for x in text_back]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = T.StructType(
        [
            own.schema["doc_id"],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return own.mapInArrow(encode, schema)
