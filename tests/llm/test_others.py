import datetime as dt
import pathlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barograph.llm import hashtree, licenses, linededup, pii, queries, vptree
from barograph.llm.components import components
from barograph.llm.feistel import Permutation
from barograph.llm.known_licenses import MIT
from barograph.llm.tables import numbered, ship_code, stored

from .conftest import TEXTS, as_tuples

# --- sharding ----------------------------------------------------------------------


def test_shards(docs, no_docs):
    tree = hashtree.even_tree(16)
    rows = hashtree.sharded(docs, tree, hashtree.with_shard(tree)).collect()
    texts = sorted((key or 0, len((text or "").encode()) + 1, zlib.crc32((text or "").encode()))
                   for key, text in TEXTS)
    assert sorted((row.doc_id or 0, row["size"], row.text_crc32) for row in rows) == texts
    slots = defaultdict(list)
    for row in rows:
        slots[row.shard].append(row.slot)
        assert row.law == "key" and row.grown_shard in (row.shard, 16)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert hashtree.sharded(no_docs, tree, tree).collect() == []


@pytest.mark.parametrize("name", ["slot", "number"])
def test_numbers_of_a_group_of_equal_rows(spark, name):
    rows = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("key"), F.lit(1).alias("part"))
    held = stored(rows, "equal-rows")
    found = numbered(held, ["part"], ["key"], name, salts=16)
    assert found.columns == ["key", "part", name]
    got = found.agg(F.min(name), F.max(name), F.countDistinct(name)).first()
    assert tuple(got) == (0, 29_999, 30_000)
    # The third of the rows without a key is dealt to all salts alike.
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
    salt = F.pmod(F.xxhash64(part, "_metadata.row_index"), F.lit(16))
    sizes = [row["count"] for row in held.groupBy(salt).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 30_000 / 16


def test_weights_and_movement(spark):
    keys = spark.range(20_000)
    tree = hashtree.even_tree(16)
    heavy = [*tree[:3], hashtree.Shard("r0", "r0k0", 3, 3.0), *tree[4:]]
    rows = keys.select(hashtree.shard_of(keys["id"], tree).alias("a"),
                       hashtree.shard_of(keys["id"], heavy).alias("b")).collect()
    counts = Counter(row.a for row in rows)
    assert all(abs(counts[n] - 1250) < 200 for n in range(16))
    assert abs(Counter(row.b for row in rows)[3] - 20_000 * 3 / 18) < 400
    for row in rows:  # only into the heavier region; from within it only into the heavier
        into = row.b < 8 and (row.a >= 8 or row.b < 4) and (row.a >= 4 or row.b == 3)
        assert row.a == row.b or into


def test_trees_are_checked():
    for tree in ([], [hashtree.Shard("a", "k", 0, 0.0)], hashtree.even_tree(2) * 2,
                 [hashtree.Shard("a", "k", 0), hashtree.Shard("b", "k", 1)]):
        with pytest.raises(ValueError):
            hashtree._checked(tree)


def test_lines_that_share_half_a_digest_stay_apart(spark, docs, monkeypatch):
    # Every line's first number is one of two: candidates are many, what goes is the same.
    expected = as_tuples(linededup.deduplicated(docs, least=1, count="gone"))
    whole = linededup._keys_of

    def halved(lines):
        keys = whole(lines).copy()
        keys[:, 0] &= 1
        return keys

    assert sum(row[-1] for row in expected) > 0
    texts = sorted({x for row in docs.collect() for x in (row.text or "").split("\n") if x.strip()})
    assert len({tuple(x) for x in whole(texts).tolist()}) == len({x.strip() for x in texts})
    monkeypatch.setattr(linededup, "_keys_of", halved)
    digest = linededup.line_digest
    monkeypatch.setattr(
        linededup, "line_digest", lambda x: bytes([digest(x)[0] & 1, *[0] * 7]) + digest(x)[8:])
    got = as_tuples(linededup.deduplicated(docs, least=1, count="gone"))
    # A bucket of lines that all share their first number is taken for one line's, so near
    # copies may stay; but no line goes that stayed.
    assert all(a[-1] <= b[-1] for a, b in zip(got, expected, strict=True))
    assert sum(row[-1] for row in got) > 0


# --- licences ----------------------------------------------------------------------


def test_licenses_and_oracle(spark, docs):
    mangled = "Copyright (c) 2020 Some One\n" + MIT.upper().replace("SUBLICENSE", "sub-licence")
    rows = [(1, f"mit license\n{mangled}"), (2, "prose\nReleased under the MIT License!\nmore"),
            (2, "Licenced under the Apache License, version 2.0"), (None, MIT), (3, None), (4, ""),
            (5, MIT + " And more."), (6, "© 2001 all rights reserved")]
    table = spark.createDataFrame(rows, "doc_id long, text string").unionByName(
        docs.select("doc_id", "text"))
    found = as_tuples(licenses.license_scan(table))
    assert found == sorted([
        (1, "text", "MIT", 1), (2, "line", "MIT", 1), (2, "line", "Apache-2.0", 1),
        (2, "text", "Apache-2.0", 1), (None, "text", "MIT", 1)], key=repr)
    database = duckdb.connect()
    database.register("documents", table.toArrow())
    sql = database.sql(licenses.oracle())
    assert sorted(sql.project("doc_id, scope, license, places").fetchall(), key=repr) == found
    assert licenses.license_scan(table.limit(0)).collect() == []


def test_listed_digests_are_those_of_the_published_texts(spark):
    folder = pathlib.Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0",
             "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    rows = [(n, (folder / file).read_text()) for n, file in enumerate(names) if (folder / file).exists()]
    if not rows:
        pytest.skip("no licence texts on this machine")
    found = licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string"))
    whole = {row.doc_id: row.license for row in found.collect() if row.scope == "text"}
    assert whole == {n: list(names.values())[n] for n, _ in rows}


def test_a_table_of_digests_is_sent_or_shuffled(spark, docs, monkeypatch):
    texts = spark.createDataFrame(
        [("A", TEXTS[0][1]), ("B", "short"), ("B", "SHORT!"), ("C", None), ("D", ""), ("E", "none")],
        "license string, text string")
    digests = licenses.text_digests(texts)
    assert digests.count() == 4
    expected = sorted([(1, "line", "A", 1), (1, "text", "A", 1), (2, "line", "A", 1),
                       (2, "text", "A", 1), (8, "line", "B", 4)])
    assert as_tuples(licenses.license_scan(docs, digests)) == expected
    monkeypatch.setattr(licenses, "BROADCAST_DIGESTS", 1)
    assert as_tuples(licenses.license_scan(docs, digests)) == expected
    nothing = spark.createDataFrame([], "license string, digest string")
    assert licenses.license_scan(docs, nothing).collect() == []


def test_canonical_form_is_worked_out_once(docs):
    digests = docs.select(docs.text.alias("license"), docs.text.alias("digest"))
    plan = licenses.license_scan(docs, digests)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("all rights reserved") == 1 and plan.count("sha2(") == 1


# --- pseudonyms --------------------------------------------------------------------


def test_permutation():
    own = Permutation(b"key")
    for size in (1, 2, 7, 1000, 4097):
        assert sorted(own.of("t", n, size) for n in range(size)) == list(range(size))
    assert [own.of("t", n, 1000) for n in range(9)] != [own.of("u", n, 1000) for n in range(9)]
    pair = {tuple(own.digits("d", (a, b, c), (3, 5, 2)))
            for a in range(3) for b in range(5) for c in range(2)}
    assert len(pair) == 30
    with pytest.raises(ValueError):
        Permutation(b"")


def test_formats_stay_and_values_stay_linked():
    names = pii.Pseudonyms(b"key")
    text = ("card 4111 1111 1111 1111, 4111111111111111 and 4111-1111-1111-1112; "
            "mail Ann.Lee7@mail5.example.com; ip 10.0.0.255 not 10.0.0.256; "
            "ssn 123-45-6789 not 000-45-6789; born 1987-03-12 or 12/03/1987, not 2023-02-30; "
            "iban DE89 3704 0044 0532 0130 00; call (743) 555-3824 or +1 743-555-3824; "
            'token = "11acdfb36bb72224148e6160f674b4be45601bff"')
    new, count = names.text(text)
    assert count == 11 and names.text(text) == (new, count)
    for old in ("4111 1111 1111 1111", "4111111111111111", "Ann.Lee7", "10.0.0.255", "123-45",
                "1987", "3704 0044", "555-3824", "11acdfb3"):
        assert old not in new
    for left in ("4111-1111-1111-1112", "10.0.0.256", "000-45-6789", "2023-02-30"):
        assert left in new
    spaced, plain = new[5:24], new[26:42]
    assert spaced.replace(" ", "") == plain and pii.luhn_digit(plain[:-1]) == plain[-1]
    country, check, account = (iban := "".join(new.split("iban ")[1].split(";")[0].split()))[:2], \
        iban[2:4], iban[4:]
    assert country == "DE" and pii.iban_digits("DE", account) == check
    first, second = new.split("born ")[1].split(",")[0].split(" or ")
    assert dt.date.fromisoformat(first).strftime("%d/%m/%Y") == second
    a, b = new.split("call ")[1].split(";")[0].split(" or +1 ")
    assert "".join(filter(str.isdigit, a)) == b.replace("-", "")


def test_pseudonyms_are_one_to_one():
    names = pii.Pseudonyms(b"key")
    days = [(dt.date(1990, 1, 1) + dt.timedelta(n)).isoformat() for n in range(3000)]
    cards = [f"{n:015d}" for n in range(4 * 10**14, 4 * 10**14 + 2000)]
    for values in (days, [c + pii.luhn_digit(c) for c in cards],
                   [f"200.1.{n // 250}.{n % 250}" for n in range(2000)],
                   [f"user{n}@a.org" for n in range(10)]):
        assert len({names.text(x)[0] for x in values}) == len(values)


def test_pseudonymised_rows(spark, docs, no_docs):
    table = docs.unionByName(docs.limit(1).selectExpr(
        "77L AS doc_id", "'x@y.org' AS text", *docs.columns[2:]))
    rows = pii.pseudonymised(table, b"key", count="replaced")
    assert rows.columns == [*docs.columns, "replaced"]
    same = as_tuples(rows.filter("replaced = 0").drop("replaced"))
    assert same == as_tuples(docs)
    assert rows.filter("replaced = 1").first().text.endswith(".org")
    assert pii.pseudonymised(no_docs, b"key").collect() == []
    with pytest.raises(ValueError):
        pii.pseudonymised(docs, b"key", count="size")


# --- nearest neighbours ------------------------------------------------------------


def brute_nearest(rows, every, k):
    found = []
    good = [(n, np.array(v, float)) for n, v in rows
            if n is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    good = list({(n, v.tobytes()): (n, v) for n, v in good}.values())
    for n, v in good:
        if n % every == 0:
            ranked = sorted((-float((v * w).sum()), m) for m, w in good
                            if m != n and len(v) == len(w))
            found += [(n, r, m, -s) for r, (s, m) in enumerate(ranked[:k], 1)]
    return sorted(found)


def test_factor_one_is_exact(spark):
    ship_code(spark)
    random = np.random.default_rng(0)
    rows = [(n, random.normal(size=8).round(1).tolist()) for n in range(900)]
    rows += [(n, [0.5] * 8) for n in range(900, 1300)] + [(1400, [1.0, 2.0]), (1500, [3.0, 1.0])]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] * 8), (2041, [None] * 8),
             (2060, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (20, rows[20][1]), (2080, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, vptree.nearest(table.withColumn("point", table.vec_id), 20, 5).collect()))
    wanted = brute_nearest(rows, 20, 5)
    assert [x[:3] for x in found] == [x[:3] for x in wanted]
    assert np.allclose([x[3] for x in found], [x[3] for x in wanted], atol=1e-12)
    assert vptree.nearest(table.limit(0), 20).collect() == []


def test_recall_of_the_relaxed_search(spark):
    points = np.random.default_rng(1).normal(size=(4000, 64))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    queries = points[:200]
    query, point, score = vptree.search(vptree.build_tree(points), queries, 20, 4.0)
    least = np.sort(queries @ points.T, axis=1)[:, -20]
    assert (score >= least[query] - 1e-9).sum() / (20 * len(queries)) >= 0.95


def test_smallest_ids_are_aggregated_before_the_shuffle(spark, monkeypatch):
    ship_code(spark)
    rows = [(n, [1.0, 2.0] if n % 3 else [float(n), 1.0]) for n in range(300)]
    plans = {}

    def watched(frame, label):
        plans[label] = frame._jdf.queryExecution().sparkPlan().toString()
        return stored(frame, label)

    monkeypatch.setattr(vptree, "stored", watched)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, vptree.nearest(table, 20, 5).collect()))
    assert [x[:3] for x in found] == [x[:3] for x in brute_nearest(rows, 20, 5)]
    assert "Window" not in plans["asked"] and "partial_min(vec_id" in plans["asked"]


def brute_ids(rows, every, k):
    """Each id once, by the best score of any two vectors."""
    best = {}
    for n, v in rows:
        for m, w in rows:
            if n % every == 0 and m != n:
                score = float((np.array(v) * np.array(w)).sum())
                best[n, m] = max(score, best.get((n, m), -np.inf))
    found = []
    for n in {n for n, _ in best}:
        ranked = sorted((-s, m) for (q, m), s in best.items() if q == n)
        found += [(n, r, m) for r, (_, m) in enumerate(ranked[:k], 1)]
    return sorted(found)


def test_ids_with_several_vectors(spark):
    ship_code(spark)
    random = np.random.default_rng(3)
    rows = [(n, random.normal(size=8).round(2).tolist()) for n in range(1, 400) if n % 20]
    a, b = random.normal(size=8).round(2).tolist(), random.normal(size=8).round(2).tolist()
    rows += [(20, a), (20, b), (40, a)]  # 20 is the smallest id of both vectors
    # More vectors than neighbours asked for, all near to a query and of one other id or its own.
    rows += [(n, (3 * np.array(a) + random.normal(size=8) / 9).tolist())
             for n in (7, 60) for _ in range(12)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(tuple(row)[:3] for row in vptree.nearest(table, 20, 5).collect())
    assert found == brute_ids(rows, 20, 5)


def test_each_block_of_queries_meets_each_shard_in_a_task_of_their_own(spark, monkeypatch):
    ship_code(spark)
    monkeypatch.setattr(vptree, "SHARD_BYTES", 50 * 8 * 8)
    monkeypatch.setattr(vptree, "BLOCK_BYTES", 7 * 8 * 8)
    random = np.random.default_rng(4)
    rows = [(n, random.normal(size=8).round(1).tolist()) for n in range(1, 900)]
    rows += [(n, rows[0][1]) for n in range(1000, 1300)] + [(1400, [1.0]), (1401, [2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vptree.nearest(table, 10, 6)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "tree" not in plan
    assert sorted(tuple(row)[:3] for row in found.collect()) == [
        x[:3] for x in brute_nearest(rows, 10, 6)]


# --- lines -------------------------------------------------------------------------


def shingles(line):
    line = line.strip().ljust(8, "\0")
    return {line[k : k + 8] for k in range(len(line) - 7)}


def brute_dedup(docs):
    """Each distinct document's text after dedup, by all pairs of lines."""
    lines = [(doc or -1, at, x.strip()) for doc, text in docs if text
             for at, x in enumerate(text.split("\n")) if linededup.considered(x)]
    distinct = sorted({x for _, _, x in lines})
    root = {x: x for x in distinct}
    sets = {x: shingles(x) for x in distinct}
    pairs = [(a, b) for a in distinct for b in distinct
             if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    for _ in distinct:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    first = {}
    for doc, at, x in sorted(lines):
        first.setdefault(root[x], (doc, at))
    return sorted((doc, None if text is None else "\n".join(
        x for at, x in enumerate(text.split("\n"))
        if not linededup.considered(x) or first[root[x.strip()]] == (doc or -1, at)))
        for doc, text in docs)


def test_lines_against_all_pairs(spark, docs, no_docs):
    random.seed(2)
    base = [" ".join(random.choices(["alpha", "beta", "gamma", "delta", "eps", "zeta"], k=14))
            for _ in range(30)]

    def edited(line):
        words = line.split(" ")
        for _ in range(random.randint(0, 3)):
            words[random.randrange(len(words))] = f"w{random.randint(0, 99)}"
        return " ".join(words)

    rows = [(100 + n, "\n".join(edited(random.choice(base)) for _ in range(6)) + "\nshort one")
            for n in range(80)]
    rows += [(key, text) for key, text in dict.fromkeys(TEXTS) if key is not None]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "line", F.lit(1))
    found = linededup.deduplicated(table, count="removed")
    assert found.columns == ["doc_id", "text", "line", "removed"]
    assert sorted((r.doc_id, r.text) for r in found.collect()) == brute_dedup(rows)
    assert linededup.deduplicated(no_docs).collect() == []


def test_repeated_rows_and_null_ids(docs):
    found = linededup.deduplicated(docs)
    assert found.schema == docs.schema and found.count() == docs.count()
    texts = [r.text for r in found.collect() if r.doc_id == 8]
    assert texts == ["Line one has five words here.\nshort\nshort"] * 2


def test_large_buckets_are_split(spark):
    ship_code(spark)
    words = [f"token{n}" for n in range(60)]
    lines = [" ".join([*words[:k], f"x{k}", *words[k + 1 :]]) for k in range(60)]
    table = spark.createDataFrame([("\n".join(lines[:30]),), ("\n".join(lines[30:]),)], "text string")
    links = linededup.line_links(table, together=7)
    roots = {r.root for r in components(links).collect()}
    assert len(roots) == 1


def test_lines_without_words_and_short_lines(spark, tmp_path):
    # No blanks: one word each, alike in all but the last character. "Les." is shorter than a shingle.
    han = "".join(chr(0x4E00 + n) for n in range(60))
    rows = [(1, f"Les.\n{han}\n\nLes."), (2, f"{han}\n \nLes.\nNot."),
            (3, f"{han[:-1]}x\nAnd ornd.\n| a | b |"), (4, "And ornd.\n Les. \n| a | b |\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    wanted = [(1, f"Les.\n{han}\n", 1), (2, " \nNot.", 2), (3, "And ornd.\n| a | b |", 1),
              (4, "\n", 3)]
    assert as_tuples(queries.op6_minhash_lines(spark, str(tmp_path))) == wanted
    assert as_tuples(corpus_pipeline.line_dedup(spark, docs, "")) == [x[:2] for x in wanted]
    left = as_tuples(linededup.deduplicated(docs))
    assert left[1] == (2, " \nLes.\nNot.") and left[3] == (4, " Les. \n\n")
    with pytest.raises(ValueError):
        linededup.deduplicated(docs, least=0)
