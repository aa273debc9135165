"""Alignment of tokenizers, mixing of sources, vector codes: each against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barograph.llm import alignment, cubemix, veccodes
from barograph.llm.queries import BYTE_BPE, PIECE_BPE
from barograph.llm.tables import ship_code
from tests.llm.conftest import as_tuples

# --- alignment ---------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(rest)}


def plainly_aligned(docs):
    """Two passes over all documents, token by token."""
    first = Tokenizer.from_file(BYTE_BPE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    letters = byte_letters()

    def bytes_a(n):
        return bytes(letters[c] for c in first.id_to_token(n))

    def bytes_b(n):
        piece = second.id_to_piece(n)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(n) else piece.replace("▁", " ").encode()

    def spans(ids, bytes_of):
        out, at = [], 0
        for n in ids:
            out.append((at, at + len(bytes_of(n)), n))
            at = out[-1][1]
        return out, b"".join(map(bytes_of, ids))

    held, documents = [], Counter()
    for key, text in docs:
        groups, links, a, b = [], [], [], []
        if text:
            a, whole_a = spans(first.encode(f" {text}", add_special_tokens=False).ids, bytes_a)
            b, whole_b = spans(second.encode(text), bytes_b)
            if not whole_a == whole_b == f" {text}".encode():
                a, b = [], []
            k = 0
            for start, end, n in a:
                while b[k][1] <= start:
                    k += 1
                j = k
                while j < len(b) and b[j][0] < end:
                    links.append((n, b[j][2]))
                    j += 1
            cuts = {x[1] for x in a} & {x[1] for x in b}
            cut_sides = []
            for side in (a, b):
                runs = [[]]
                for _, end, n in side:
                    runs[-1].append(str(n))
                    if end in cuts:
                        runs.append([])
                cut_sides.append([",".join(run) for run in runs[:-1]])
            groups = ["|".join(both) for both in zip(*cut_sides, strict=True)]
        held.append((key, len(a), len(b), groups, links))
        documents.update(set(links))
    best = defaultdict(int)
    for (n, _), count in documents.items():
        best[n] = max(best[n], count)
    return sorted(((
        key, n_a, n_b, len(groups), len(links), sum(documents[x] == best[x[0]] for x in links),
        sum(documents[x] for x in links),
        hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
    ) for key, n_a, n_b, groups, links in held), key=repr)


ODD = [
    (20, "a▁b"), (21, "▁"), (22, " ▁"), (23, "<|endoftext|> x <s> <0x0A> </s>"), (24, " "),
    (25, "  \n\t a  b  "), (26, "漢字 かな　😀 é́ a\x00b"), (27, "x "), (28, "﻿a​    b"),
]


@pytest.mark.parametrize("common", [alignment.COMMON, 60, 0])
def test_alignment_equals_brute_force(spark, docs, common):
    table = docs.unionByName(spark.createDataFrame(ODD, "doc_id long, text string"), True)
    rows = [tuple(row) for row in table.select("doc_id", "text").collect()]
    long_text = [(key, text) for key, text in rows if text and len(text) > 9000]
    assert long_text  # many tokens, aligned whole
    found = alignment.token_alignment(table, BYTE_BPE, PIECE_BPE, common=common)
    assert as_tuples(found) == plainly_aligned(rows)


def test_alignment_of_nothing(no_docs):
    assert alignment.token_alignment(no_docs, BYTE_BPE, PIECE_BPE).collect() == []


def test_pointers_reach_the_last_token_of_their_group():
    random = np.random.default_rng(5)
    for _ in range(200):
        size = int(random.integers(1, 60))
        cuts = [np.unique(np.append(random.integers(1, size + 1, 12), size)) for _ in range(2)]
        of_a, of_b = alignment.groups_of(*cuts)
        shared = np.intersect1d(*cuts)
        for of, ends in zip((of_a, of_b), cuts):
            assert of.tolist() == np.searchsorted(shared, ends).tolist()
    # One token over all: pointers of a long chain still meet.
    of_a, of_b = alignment.groups_of(np.arange(2, 2002, 2), np.append(np.arange(1, 1999, 2), 2000))
    assert set(of_a) == set(of_b) == {0}


# --- mixing ------------------------------------------------------------------------


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    """Share after share, the excess of each turn dealt by weight."""
    names = sorted(x for x in sizes if x is not None) + [x for x in sizes if x is None]
    weight = {x: Fraction(n % 3 + 1) for n, x in enumerate(names)}
    total = sum(sizes.values())
    target = {x: total * weight[x] / sum(weight.values()) for x in names}
    while any(target[x] > 3 * sizes[x] for x in names):
        excess = sum(max(target[x] - 3 * sizes[x], 0) for x in names)
        target = {x: min(target[x], Fraction(3 * sizes[x])) for x in names}
        below = [x for x in names if target[x] < 3 * sizes[x]]
        for x in below:
            target[x] += excess * weight[x] / sum(weight[y] for y in below)
    return target


@pytest.fixture(scope="module")
def corpus(spark):
    """Sources of unlike sizes, one with most rows, a tiny one, null ones; repeats; clashing names."""
    ship_code(spark)
    random = np.random.default_rng(2)
    rows = []
    for n in range(3000):
        source = ("a", "big", "big", "big", None, "ß")[int(random.integers(6))]
        size = int(random.integers(1, 400)) if n % 100 else 5000
        rows.append((n, "w " * size, source))
    rows += [(None, "same words here", "big")] * 700 + [(None, None, "a")] * 90 + [(7, "", "a")]
    rows += [(9001, "one two", "tiny"), (9002, None, "hollow")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"rank": F.lit("x"), "rows": F.lit(1), "block": F.lit(2)})


@pytest.mark.parametrize("block", [4096, 64])
def test_mix_meets_targets(corpus, block):
    given = corpus.collect()
    sizes = Counter()
    for row in given:
        sizes[row.source] += words(row.text)
    found = cubemix.mixed(corpus, block=block).collect()
    assert Counter((r.doc_id, r["size"], r.source) for r in found) == Counter(
        (r.doc_id, words(r.text), r.source) for r in given)
    target = plain_targets(sizes)
    taken, copies, count = Counter(), Counter(), Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == float(target[r.source])
        assert r.taken == r.copies * r["size"] <= 3 * r["size"]
        rate = target[r.source] / max(sizes[r.source], 1)
        assert r.copies in (int(rate), int(rate) + 1)
        taken[r.source] += r.taken
        copies[r.source] += r.copies
        count[r.source] += 1
    assert target["tiny"] == 6 and taken["tiny"] == 6
    for source, size in sizes.items():
        if size > 1000:
            assert abs(taken[source] - target[source]) < (50 if block == 4096 else 0.02 * size)
            rate = target[source] / size
            assert abs(copies[source] - rate * count[source]) <= 3
    again = cubemix.mixed(corpus.repartition(7, "text"), block=block)
    assert as_tuples(again) == sorted(map(tuple, found), key=repr)


def test_mix_of_awkward_rows(docs, no_docs, spark):
    given = docs.select("doc_id", "text").collect()
    found = cubemix.mixed(docs).collect()
    # One source is its own target: every row is taken once.
    assert Counter((r.doc_id, r["size"], r.taken) for r in found) == Counter(
        (r.doc_id, words(r.text), words(r.text)) for r in given)
    assert cubemix.mixed(no_docs).collect() == []
    wordless = cubemix.mixed(docs.filter("text IS NULL OR doc_id = 5")).collect()
    assert sorted((r.doc_id, r.taken, r.target) for r in wordless) == [(4, 0, 0.0), (5, 0, 0.0)]


def test_flight_keeps_totals():
    random = np.random.default_rng(3)
    for n in (3, 5, 200, 1000):
        for size in (random.integers(0, 3000, n), np.full(n, 7), np.arange(n) ** 2):
            size = np.sort(size)[::-1]
            odds = random.random(n)
            moved = cubemix.flight(odds, size, 1)
            open_ = (moved > 0) & (moved < 1)
            assert open_.sum() <= 2 and (moved >= 0).all() and (moved <= 1).all()
            assert abs(moved.sum() - odds.sum()) < 1e-4
            assert abs(moved @ size - odds @ size) < 1e-4 * max(size.max(), 1)


def test_inclusion_follows_probabilities():
    odds = np.array([0.2, 0.5, 0.9, 0.4, 0.7, 0.3])
    size = np.array([90, 60, 41, 30, 7, 2])
    mean = np.mean([cubemix.flight(odds, size, seed) for seed in range(4000)], axis=0)
    assert np.abs(mean - odds).max() < 0.03


# --- vector codes ------------------------------------------------------------------


def plainly_coded(rows, entries=64, rounds=2):
    """Codebooks by comparing every part with every entry, in Python's integers."""
    kept = [(k, [int(np.floor(256 * float(x))) for x in v], label) for k, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    first = {}
    for key, v, _ in sorted((x for x in kept if x[0] is not None), key=lambda x: x[:2]):
        first.setdefault(key, v)
    begun = list(first.values())[:entries]
    size = len(kept[0][1]) // 16
    books = [[v[p * size:(p + 1) * size] for v in begun] for p in range(16)]

    def nearest(part, book):
        away = [sum((x - y) ** 2 for x, y in zip(part, entry)) for entry in book]
        return away.index(min(away)), min(away)

    for turn in range(rounds + 1):
        chosen = [[nearest(v[p * size:(p + 1) * size], books[p]) for p in range(16)]
                  for _, v, _ in kept]
        if turn == rounds:
            break
        for p in range(16):
            for n in range(len(books[p])):
                own = [v[p * size:(p + 1) * size] for (_, v, _), c in zip(kept, chosen) if c[p][0] == n]
                if own:
                    books[p][n] = [sum(column) // len(own) for column in zip(*own)]
    digest = hashlib.sha256(
        ",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    errors = [sum(d for _, d in c) for c in chosen]
    total = Counter()
    for (_, _, label), error in zip(kept, errors):
        total[label] += error
    return sorted(((k, bytes(n for n, _ in c).hex(), error, total[label], digest)
                   for (k, _, label), c, error in zip(kept, chosen, errors)), key=repr)


def test_codes_equal_brute_force(spark):
    ship_code(spark)
    random = np.random.default_rng(4)
    rows = [(int(k), random.normal(0, 0.2, 48).tolist(), int(k) % 3 or None)
            for k in random.permutation(400)]
    # Ties: vectors on a coarse grid; one vector in many rows; one id with two vectors.
    rows += [(500 + k, (random.integers(-2, 3, 48) / 8).tolist(), 9) for k in range(200)]
    rows += [(3, rows[0][1], 9)] * 40 + [(None, rows[1][1], None), (None, [0.0] * 48, 1)]
    rows += [(-1, [-1e-9] * 48, 2), (-2, [3.99609375] * 48, 2), (-2, [1000.25] * 48, 2)]
    rows += [(-3, None, 1), (-4, [None] + [0.0] * 47, 1), (-5, [float("nan")] * 48, 1),
             (-6, [float("inf")] + [0.0] * 47, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    table = table.withColumns({"code": F.lit("x"), "salt": F.lit(1), "of": F.lit(2), "width": F.lit(3)})
    found = veccodes.vector_codes(table).drop("label")
    assert as_tuples(found) == plainly_coded(rows)
    few = [row for row in rows if row[0] is not None and row[0] % 20 == 0]
    small = table.filter("vec_id % 20 = 0")
    assert as_tuples(veccodes.vector_codes(small).drop("label")) == plainly_coded(few)


def test_codes_of_awkward_tables(spark):
    ship_code(spark)
    layout = "vec_id long, embedding array<float>, label string"
    assert veccodes.vector_codes(spark.createDataFrame([], layout)).collect() == []
    # No id to begin from; lengths that can't be cut; numbers beyond a long's errors.
    odd = [(None, [1.0] * 16, "a"), (1, [1.0] * 15, "a"), (2, [1e30] * 32, "a")]
    assert veccodes.vector_codes(spark.createDataFrame(odd, layout)).collect() == []
    # Lengths have codebooks of their own, the empty one too.
    mixed = [(1, [1.0] * 16, "a"), (2, [0.5] * 32, None), (3, [], "a"), (4, [0.75] * 16, None)]
    found = {r.vec_id: r for r in veccodes.vector_codes(spark.createDataFrame(mixed, layout)).collect()}
    assert sorted(found) == [1, 2, 3, 4]
    assert found[3].codebooks_sha256 == hashlib.sha256(b"").hexdigest() and found[3].error == 0
    assert found[1].codebooks_sha256 == found[4].codebooks_sha256 != found[2].codebooks_sha256


def test_access_tree_is_exact_and_prunes(monkeypatch):
    random = np.random.default_rng(6)
    compared = []
    plain = veccodes.squared
    for points in (random.integers(-300, 300, (64, 4)), random.integers(-2, 3, (200, 3)),
                   np.zeros((64, 2), int), random.integers(-9, 9, (5, 1)), np.zeros((3, 0), int),
                   random.integers(-(10**8), 10**8, (300, 2))):
        queries = np.concatenate([points, random.integers(-300, 300, (500, points.shape[1]))])
        away = plain(queries, points)
        tree = veccodes.AccessTree(points)
        monkeypatch.setattr(
            veccodes, "squared", lambda a, b: compared.append(len(a) * len(b)) or plain(a, b))
        entry, best = tree.nearest(queries)
        monkeypatch.undo()
        assert entry.tolist() == away.argmin(axis=1).tolist()
        assert best.tolist() == away.min(axis=1).tolist()
        if points.shape == (300, 2):
            assert sum(compared) < away.size / 2
        compared.clear()


def test_codes_restore_vectors():
    random = np.random.default_rng(7)
    book = veccodes.Codebooks(random.integers(-99, 99, (16, 64, 2)))
    vectors = random.integers(-99, 99, (50, 32))
    chosen, error = book.assigned(vectors)
    back = book.restored([bytes(row).hex() for row in chosen.astype(np.uint8)]) * veccodes.SCALE
    assert ((back - vectors) ** 2).sum(axis=1).astype(int).tolist() == error.tolist()
