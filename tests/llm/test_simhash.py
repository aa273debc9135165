import pathlib
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from barograph.llm import simhash
from barograph.llm.components import components
from barograph.workspace import shared_root

from .conftest import TEXTS, as_tuples


def brute_print(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    spans = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints):
    roots = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for a, x in enumerate(prints):
            for b, y in enumerate(prints):
                if (x ^ y).bit_count() <= 4 and roots[b] < roots[a]:
                    roots[a], changed = roots[b], True
    return roots


def gray_sorted(prints):
    code = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        code ^= code >> np.uint64(shift)
    return prints[np.argsort(code)]


def test_fingerprints():
    for _, text in TEXTS:
        assert simhash.fingerprint(text) == brute_print(text)


def test_index_finds_the_components_of_all_pairs():
    random = np.random.default_rng(0)
    for _ in range(10):
        centres = random.integers(0, 2**63, random.integers(1, 6), dtype=np.uint64)
        prints = centres[random.integers(0, len(centres), 250)]
        for _ in range(random.integers(1, 6)):
            prints = prints ^ (np.uint64(1) << random.integers(0, 64, 250).astype(np.uint64))
        prints = gray_sorted(np.unique(prints))
        found = simhash.linked(prints, np.zeros(len(prints), int)).tolist()
        wanted = brute_roots([int(x) for x in prints])
        assert len(set(zip(found, wanted))) == len(set(found)) == len(set(wanted))


def test_every_lead_finds_every_link(spark, docs):
    random = np.random.default_rng(1)
    centres = random.integers(-(2**62), 2**62, 20)
    prints = [int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centres
              for a, b in random.integers(0, 63, (15, 2))]
    distinct = spark.createDataFrame([(x,) for x in set(prints)], "fp long")
    rows = sorted(set(prints))
    wanted = brute_roots(rows)
    for lead, together in ((1, 8_000), (2, 8_000), (1, 7)):
        found = components(simhash.links(distinct, lead, together))
        root = {row.node: row.root for row in found.collect()}
        got = [root.get(x, x) for x in rows]
        assert len(set(zip(got, wanted))) == len(set(got)) == len(set(wanted))


def test_awkward_rows(docs, no_docs):
    rows = simhash.near_duplicates(docs)
    assert rows.columns == ["doc_id", "fingerprint", "component_id"]
    by_id = {row.doc_id: row for row in rows.collect()}
    assert rows.count() == len(TEXTS)
    for key, text in TEXTS:
        assert by_id[key].fingerprint == f"{brute_print(text):016x}"
    assert by_id[2].component_id == 1
    assert by_id[4].component_id == by_id[5].component_id == by_id[6].component_id == 4
    assert by_id[None].component_id is None
    assert simhash.near_duplicates(no_docs).collect() == []


def test_one_of_each(docs):
    kept = simhash.one_of_each(docs)
    assert kept.schema == docs.schema
    assert sorted(row.doc_id or 0 for row in kept.collect()) == [0, 1, 3, 4, 7, 8, 9, 10]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001), (5, 5)],
                                  "a long, b long")
    rows = as_tuples(components(links))
    assert rows == sorted([(k, 0) for k in range(301)] + [(1000, 1000), (1001, 1000)], key=repr)


def test_one_text_of_each_component_stays(spark, docs):
    words = [" ".join(f"w{k * n % 211}" for k in range(1, 60)) for n in (1, 2, 3)]
    rows = [(1, words[0]), (2, words[0]), (2, words[1]), (3, words[1]), (3, words[0]),
            (4, words[2]), (4, words[2].upper()), (None, "of no id"), (None, "Of no ID")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.one_of_each(table).collect()
    assert sorted((r.doc_id or 0, r.text.lower()) for r in kept) == [
        (0, "of no id"), (1, words[0]), (2, words[1]), (4, words[2])]


def test_one_of_repeated_rows_stays(spark):
    words = [" ".join(f"w{k * n % 211}" for k in range(1, 60)) for n in (1, 2)]
    rows = [(1, words[0], k % 3) for k in range(90)] + [(2, words[0], 0), (3, words[1], 0)]
    rows += [(None, "of no id", k) for k in range(5)]
    table = spark.createDataFrame(rows, "doc_id long, text string, _kept_id int").repartition(5)
    table = table.withColumn("tags", F.create_map(F.lit("a"), "_kept_id"))
    kept = simhash.one_of_each(table)
    assert kept.schema == table.schema
    assert sorted(row.doc_id or 0 for row in kept.collect()) == [0, 1, 3]
    # Repeated rows meet after each task has put its own down to one.
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_rounds_leave_no_tables(spark):
    root = pathlib.Path(shared_root(spark).removeprefix("file:"))
    before = set(root.glob("components-*"))
    links = spark.createDataFrame([(k, k + 1) for k in range(100)], "a long, b long")
    assert components(links).count() == 101
    assert len(set(root.glob("components-*")) - before) == 1


def test_shingle_and_differences_are_parameters(spark, docs):
    a = " ".join(f"w{k}" for k in range(100))
    b = a.replace("w50", "other")
    table = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    far = (simhash.fingerprint(a, 5) ^ simhash.fingerprint(b, 5)).bit_count()
    assert 0 < far
    for differences, left in ((far - 1, 2), (far, 1)):
        found = simhash.one_of_each(table, shingle=5, differences=differences)
        assert found.count() == left
