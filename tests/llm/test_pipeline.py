"""The whole pipeline against a plain version, stage by stage."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from barograph.llm import pii, quality
from barograph.llm.queries import QUERY_KEY
from barograph.llm.tables import ship_code

from .test_others import shingles
from .test_quality import brute_counts
from .test_simhash import brute_print, brute_roots

#: Names that the stages use within, which the documents have as columns here.
CLASHING = ["_gone", "_t", "_text", "_kept_id", "positions", "line", "piece", "sequence_id", "removed"]
NAMES = [name for name, _ in corpus_pipeline.STAGES]


def corpus():
    """(id, text) with copies, near copies, shared lines, personal data and awkward rows."""
    draw = random.Random(7)
    vocabulary = ["".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 9))) for _ in range(900)]

    def line():
        return " ".join(draw.choices(vocabulary, k=draw.randint(12, 25))) + "."

    shared = [line() for _ in range(5)]
    rows = []
    for number in range(60):
        lines = [line() for _ in range(draw.randint(4, 9))]
        if number % 3 == 0:
            words = draw.choice(shared).split(" ")
            words[draw.randrange(len(words))] += draw.choice(["", "s"])
            lines.insert(draw.randrange(len(lines)), " ".join(words))
        if number % 5 == 0:
            lines.append(f"write to mail{number}@example.org or call +1 415 555 26{number:02d} on 1990-05-{number % 28 + 1:02d}")
        rows.append((number, "\n".join(lines)))
    rows += [(100 + k, text.upper()) for k, (_, text) in enumerate(rows[:4])]
    rows += [rows[5]] * 3 + [(None, rows[6][1] + "\n" + line()), (None, "\n".join(line() for _ in range(6)))]
    rows.append((200, "\n".join(line() for _ in range(120))))
    rows += [(201, None), (202, ""), (203, " \n\t"), (204, "too few words"), (205, "same " * 80), (206, "# $ % " * 40)]
    return rows


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The folder of the tables, and the rows after each stage."""
    ship_code(spark)
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.select("*", *[F.lit(k).alias(name) for k, name in enumerate(CLASHING)])
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(key, int(key % 7 != 3), 0) for key, _ in rows if key is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    before = spark.read.parquet(f"{folder}/documents.parquet")
    after = {"documents": before}
    for name, stage in corpus_pipeline.STAGES:
        made = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, before, folder).write.parquet(made)
        before = after[name] = spark.read.parquet(made)
    return folder, after


def texts(rows):
    return sorted(((row.doc_id, row.text) for row in rows.select("doc_id", "text").collect()), key=repr)


def pairs_between(staged, name):
    after = staged[1]
    before = ["documents", *NAMES][NAMES.index(name)]
    return texts(after[before]), texts(after[name])


def test_documents_keep_their_columns(staged):
    _, after = staged
    for name in NAMES[:-1]:
        assert after[name].schema == after["documents"].schema
        row = after[name].first()
        assert [row[x] for x in CLASHING] == list(range(len(CLASHING)))


def plain_score(model, features):
    total = model.base
    for at in model.roots:
        while (to := model.left[at] if features[model.feature[at]] <= model.threshold[at]
               else model.right[at]) != at:
            at = to
        total += model.value[at]
    return total


def test_quality_rules(spark, staged):
    before, after = pairs_between(staged, "quality_rules")
    folder = staged[0]
    model = quality.train(staged[1]["documents"], spark.read.parquet(f"{folder}/labels.parquet"))
    wanted = []
    for key, text in before:
        words, _, _, _, repeated = brute_counts(text)
        fine = words >= 50 and 100 * repeated <= 50 * words
        if fine and plain_score(model, quality.text_statistics(text)[1]) >= 0:
            wanted.append((key, text))
    assert after == sorted(wanted, key=repr)
    assert 10 < len(after) < len(before) - 6


def test_line_dedup(staged):
    before, after = pairs_between(staged, "line_dedup")
    lines = sorted({(key is not None, key or 0, at, x.strip()) for key, text in before
                    for at, x in enumerate(text.split("\n")) if x.strip()})
    sets = {x: shingles(x) for *_, x in lines}
    root = {x: x for x in sets}
    alike = [(a, b) for a in sets for b in sets
             if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert alike
    for _ in alike:
        for a, b in alike:
            root[a] = root[b] = min(root[a], root[b])
    first = {}
    for none, key, at, x in lines:
        first.setdefault(root[x], (none, key, at, x))
    wanted = [(key, "\n".join(
        x for at, x in enumerate(text.split("\n"))
        if not x.strip() or first[root[x.strip()]] == (key is not None, key or 0, at, x.strip())))
        for key, text in before]
    assert after == sorted(wanted, key=repr)


def test_near_dedup(staged):
    before, after = pairs_between(staged, "near_dedup")
    prints = [brute_print(text) for _, text in before]
    groups = defaultdict(list)
    for root, row in zip(brute_roots(prints), before):
        groups[root].append(row)
    assert len(groups) < len(before) and len(after) == len(groups)
    kept = defaultdict(int)
    for row in after:
        owners = [root for root, rows in groups.items() if row in rows]
        kept[owners[0]] += 1
        assert row[0] == min((x for x, _ in groups[owners[0]] if x is not None), default=None)
    assert all(kept[root] == 1 for root in groups)


def test_pii(staged):
    before, after = pairs_between(staged, "pii")
    names = pii.Pseudonyms(QUERY_KEY)
    wanted = [(key, names.text(text)[0]) for key, text in before]
    assert after == sorted(wanted, key=repr)
    assert before != after and not any("example.org" in t and "mail0@" in t for _, t in after)


def test_best_fit_packing(staged):
    after = staged[1]
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = []
    for key, text in texts(after["pii"]):
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        cuts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            wanted.append((key, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    rows = after["best_fit_packing"].collect()
    found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(sequences) <= 1.1 * -(-sum(r.length for r in rows) // 1024) + 1


def test_run_gives_the_last_stage(spark, staged):
    folder, after = staged
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found, wanted = (sorted(map(tuple, rows.select(columns).collect()), key=repr)
                     for rows in (corpus_pipeline.run(spark, folder), after["best_fit_packing"]))
    assert found == wanted


def test_empty_tables(spark, staged, tmp_path):
    after = staged[1]
    after["documents"].limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{staged[0]}/labels.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
