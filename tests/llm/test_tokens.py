import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barograph.llm import bpetrie, packing, tokenfile
from barograph.llm.tokens import token_memory

from .conftest import TEXTS

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def hard_texts():
    random.seed(3)
    parts = ["a", "b ", "  ", "\n", "\t", " ", "<|endoftext|>", "é", "1", "'s", " ", "　",
             "\x1c", "\x85", "!", " the", "<|endo", "漢", "😀"]
    made = ["".join(random.choices(parts, k=random.randint(1, 25))) for _ in range(4000)]
    return made + [text or "" for _, text in TEXTS] + ["ab" * 3000, " " * 50]


@pytest.mark.parametrize("make", [token_memory, bpetrie.encoder])
def test_ids_are_the_librarys(tokenizer, make):
    texts = hard_texts()
    found = make(PATH).encode(texts)
    wanted = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [x.ids for x in wanted]


def test_memory_keeps_its_bound(tokenizer):
    memory = token_memory(PATH)
    memory.kept, kept = 50, memory.kept
    try:
        texts = hard_texts()[:300]
        wanted = [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
        for text, ids in zip(texts, wanted):
            assert np.frombuffer(memory.encode([text])[0], "<u4").tolist() == ids
        assert len(memory.known) < 100
    finally:
        memory.kept = kept


def test_neighbours_by_merging():
    vocabulary = bpetrie.vocabulary(PATH)
    random.seed(5)
    ids = list(vocabulary.ids.values())
    for _ in range(3000):
        a, b = random.choice(ids), random.choice(ids)
        joined = vocabulary.merged(vocabulary.pieces[a] + vocabulary.pieces[b])
        assert vocabulary.may_follow(a, b) == (joined == [a, b])


def test_encoded_rows(docs, no_docs, tokenizer):
    rows = bpetrie.encoded(docs, PATH).collect()
    assert len(rows) == len(TEXTS)
    found = sorted((row.doc_id or 0, *row[1:]) for row in rows)
    wanted = []
    for key, text in TEXTS:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        back = tokenizer.decode(ids, skip_special_tokens=False).encode()
        wanted.append((key or 0, len(ids), hashlib.sha256(raw).hexdigest(),
                       hashlib.sha256(back).hexdigest()))
    assert found == sorted(wanted)
    assert bpetrie.encoded(no_docs, PATH).collect() == []


def test_token_files(docs, no_docs, tokenizer):
    rows = tokenfile.token_file_roundtrip(docs, PATH, 0).collect()
    ordered = sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0))
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for _, t in ordered]
    starts = np.cumsum([0, *map(len, ids)])[:-1].tolist()
    wanted = [(key, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
              for (key, _), start, x in zip(ordered, starts, ids)]
    assert sorted(map(tuple, rows), key=lambda x: x[1]) == wanted
    assert tokenfile.token_file_roundtrip(no_docs, PATH, 0).collect() == []


def test_one_document_of_a_file():
    words = [np.arange(n, dtype="<u4").tobytes() for n in (1, 5, 300)]
    how = tokenfile.zstandard.ZstdCompressor()
    rows = [(k, len(x) // 4, how.compress(tokenfile.serialized(x, 2))) for k, x in enumerate(words)]
    raw = tokenfile.file_bytes(rows, hashlib.sha256(b"").digest(), 2)
    assert tokenfile.TokenFile(raw, b"").ids(1).tolist() == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="another dictionary"):
        tokenfile.TokenFile(raw, b"other")


def placed(plan, counts):
    found = []
    for length, n in counts.items():
        sequence, offset = plan.place(np.full(n, length), np.arange(n))
        found += [(s, o, length) for s, o in zip(sequence.tolist(), offset.tolist())]
    return sorted(found)


def first_fit(counts):
    """How many sequences first fit, longest first, takes."""
    free = []
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        k = next((k for k, room in enumerate(free) if room >= n), None)
        if k is None:
            free.append(1024 - n)
        else:
            free[k] -= n
    return len(free)


@pytest.mark.parametrize("by", ["norm", "dot"])
@pytest.mark.parametrize("capacity", [packing.Capacity(), packing.Capacity(100, 3, 4000)])
def test_plans_hold_every_constraint(by, capacity):
    random.seed(7)
    most = min(capacity.tokens, int(capacity.cost**0.5))
    counts = {n: random.randint(1, 5) for n in random.sample(range(1, most + 1), most // 2)}
    found = placed(packing.best_fit_plan(counts, capacity, packing.Score(by)), counts)
    assert len(found) == sum(counts.values())
    in_sequence = {}
    for sequence, offset, length in found:
        own = in_sequence.setdefault(sequence, [])
        assert offset == sum(own)
        own.append(length)
    for own in in_sequence.values():
        assert sum(own) <= capacity.tokens and len(own) <= capacity.documents
        assert sum(n * n for n in own) <= capacity.cost
    if capacity == packing.Capacity():
        assert len(in_sequence) <= first_fit(counts)


def test_packed_rows(docs, no_docs, tokenizer):
    rows = packing.packed(docs, PATH, 2).collect()
    ids = {}
    for key, text in TEXTS:
        ids[key] = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
    assert sum(row.length for row in rows) == sum(len(ids[key]) for key, _ in TEXTS)
    for row in rows:
        own = ids[row.doc_id][row.start : row.start + row.length]
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == row.ids_crc32
        assert row.length == 1024 or row.piece == 0
    ends = {}
    for row in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert row.offset == ends.get(row.sequence_id, 0)
        ends[row.sequence_id] = row.offset + row.length
    assert max(ends.values()) <= 1024
    assert packing.packed(no_docs, PATH, 2).collect() == []
