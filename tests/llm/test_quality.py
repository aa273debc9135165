import re
from collections import Counter

import numpy as np
import pytest

from barograph.llm import quality
from barograph.llm.boosting import TreeParams, fit

from .conftest import TEXTS


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times = Counter(windows)
    hit = {k + s for k, w in enumerate(windows) if times[w] > 1 for s in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return [len(words), sum(map(len, words)), symbols, dup, len(hit)]


@pytest.mark.parametrize(
    "text",
    [text for _, text in TEXTS]
    + ["a b c a b c", "a a a a", "# <b>|\n# <b>|", "x y\x1cz\x85w", "a b c d\ne a b c"],
)
def test_counts(text):
    assert quality.text_statistics(text)[0] == brute_counts(text)


def test_trees_learn_and_keep_constraints():
    random = np.random.default_rng(0)
    rows = random.normal(size=(3000, 3))
    noisy = rows[:, 0] - 0.5 * rows[:, 1] ** 2 + random.normal(size=3000) * 0.3 > 0
    model = fit(rows[:2000], noisy[:2000].astype(float), np.array([1, 0, -1]), TreeParams())
    right = (model.score(rows[2000:]) > 0) == noisy[2000:]
    assert right.mean() > 0.9
    steps = np.linspace(-3, 3, 60)
    for other in random.normal(size=(20, 2)):
        line = np.stack([steps, np.full(60, other[0]), np.full(60, other[1])], axis=1)
        assert (np.diff(model.score(line)) >= -1e-9).all()
        line = np.stack([np.full(60, other[0]), np.full(60, other[1]), steps], axis=1)
        assert (np.diff(model.score(line)) <= 1e-9).all()


def test_one_class_gives_no_model(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    assert quality.train(docs, labels) is None
    assert quality.train(docs, labels.limit(0)) is None


def test_awkward_rows(docs, no_docs):
    rows = quality.scored(docs, None).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        failed = row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words
        assert (row.base_failed, row.kept) == (failed, not failed)
    assert quality.scored(no_docs, None).collect() == []
    kept = quality.kept_documents(docs, None)
    assert kept.schema == docs.schema
    assert [row.doc_id for row in kept.collect()] == [7]


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.train(docs, labels.filter("doc_id % 3 < 2"))
    judged = quality.scored(docs, model).join(labels.filter("doc_id % 3 = 2"), "doc_id")
    rows = judged.filter("NOT base_failed").collect()
    assert sum(row.kept == (row.quality == 1) for row in rows) / len(rows) > 0.93


