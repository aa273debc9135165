"""Quality rules: base rules and boosted trees over statistics of whole documents.

Words are runs of characters other than blank and the five controls from tab to
carriage return. The trees are fitted on a bounded sample of labelled documents
(``LABELLED``, smallest hash first); every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.llm.boosting import FlatTrees, TreeParams, fit

#: At most so many labelled documents train the trees.
LABELLED = 20_000

SYMBOLS = b"#*$%&|<>"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features, and whether more of one may only harm (-1), only help (1) or either (0).
FEATURES = {
    "log_words": 0,
    "mean_word": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": -1,
    "digit_share": 0,
    "mark_share": 0,
    "words_per_line": 0,
    "distinct_share": 0,
    "sentence_share": 0,
}
CONSTRAINTS = np.array(list(FEATURES.values()))
MIN_WORDS = 50


def _repeated(words: list[bytes]) -> int:
    """Words in 3-word windows that stand twice or more in the text, the first included."""
    n = len(words)
    if n < 4:
        return 0
    distinct = dict(zip(dict.fromkeys(words), range(n), strict=False))
    if len(distinct) == n:
        return 0
    ids = np.fromiter(map(distinct.__getitem__, words), np.int64, n)
    # Number the pairs first, so that three-word keys stay within 64 bits in any text.
    pair = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
    _, which, times = np.unique(pair[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    hit = np.zeros(n, bool)
    for shift in range(3):
        hit[shift : shift + n - 2] |= again
    return int(hit.sum())


def text_statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The counts of the base rules and the features of the trees, of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    body = b"".join(words)
    chars = len(body.decode("utf-8", "surrogatepass"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    again = _repeated(words)
    upper = len(body) - len(body.translate(None, CAPITALS))
    digits = len(body) - len(body.translate(None, b"0123456789"))
    marks = len(body) - len(body.translate(None, b".,;:!?'\"()-"))
    ended = sum(x.rstrip().endswith((b".", b"!", b"?", b'"', b":")) for x in lines)
    per_word, per_char = max(n, 1), max(chars, 1)
    features = [
        float(np.log1p(n)),
        chars / per_word,
        symbols / per_word,
        dup / max(len(lines), 1),
        again / per_word,
        upper / per_char,
        digits / per_char,
        marks / per_word,
        n / max(len(lines), 1),
        len(set(words)) / per_word,
        ended / max(len(lines), 1),
    ]
    return [n, chars, symbols, dup, again], features


def _statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    counts = np.zeros((len(texts), len(COUNTS)), np.int64)
    features = np.zeros((len(texts), len(FEATURES)))
    for k, text in enumerate(texts):
        counts[k], features[k] = text_statistics(text.as_py())
    return counts, features


def base_failed(counts: np.ndarray) -> np.ndarray:
    words, repeated = counts[:, 0], counts[:, 4]
    return (words < MIN_WORDS) | (100 * repeated > 50 * words)


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    bound: int = LABELLED,
    params: TreeParams = TreeParams(),
) -> FlatTrees | None:
    """Fit the trees on at most ``bound`` labelled documents, the same ones each time.

    Labels other than 0 and 1 and null ids are left out. None if no two classes
    are there: the base rules then decide alone.
    """
    chosen = (
        labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_label"))
        .filter(F.col("_id").isNotNull() & F.col("_label").isin(0, 1))
        .distinct()
        .orderBy(F.xxhash64("_id", "_label"), "_id", "_label")
        .limit(bound)
    )
    own = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    found = own.join(F.broadcast(chosen), "_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _statistics(batch["_text"])[1]
            columns = [batch["_id"], batch["_label"], *map(pa.array, rows.T)]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_label", *FEATURES])

    kinds = [T.StructField(name, T.DoubleType()) for name in FEATURES]
    schema = T.StructType(
        [own.schema["_id"], T.StructField("_label", T.IntegerType()), *kinds]
    )
    # An id that stands in many rows could give more than the bound.
    rows = found.mapInArrow(measure, schema).orderBy("_id", "_label", *FEATURES).limit(bound)
    sample = rows.drop("_id").toPandas()
    target = sample.pop("_label").to_numpy(float)
    if len(set(target)) < 2:
        return None
    return fit(sample.to_numpy(float), target, CONSTRAINTS, params)


def _verdict(texts: pa.Array, model: FlatTrees | None, least: float):
    counts, features = _statistics(texts)
    failed = base_failed(counts)
    if model is None:
        chance = np.ones(len(texts))
    else:
        chance = 1 / (1 + np.exp(-model.score(features)))
    return counts, failed, chance, ~failed & (chance >= least)


def scored(
    docs: DataFrame,
    model: FlatTrees | None,
    least: float = 0.5,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Counts, base rules, chance of good quality and verdict of each row.

    Null and empty texts have no words and fail the base rules. Null ids and
    repeated rows are judged like any other row. Other columns are not looked
    at. An empty table gives no rows.
    """
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, chance, kept = _verdict(batch["_text"], model, least)
            columns = [batch["doc_id"], *map(pa.array, counts.T), *map(pa.array, (failed, kept))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(chance)],
                ["doc_id", *COUNTS, "base_failed", "kept", "quality_chance"],
            )

    schema = T.StructType(
        [
            own.schema["doc_id"],
            *[T.StructField(name, T.LongType()) for name in COUNTS],
            T.StructField("base_failed", T.BooleanType()),
            T.StructField("kept", T.BooleanType()),
            T.StructField("quality_chance", T.DoubleType()),
        ]
    )
    return own.mapInArrow(judge, schema)


def kept_documents(
    docs: DataFrame, model: FlatTrees | None, least: float = 0.5, text: str = "text"
) -> DataFrame:
    """The rows that base rules and trees keep, with all their columns."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = docs_columns.index(text)
        for batch in batches:
            kept = _verdict(batch.column(place), model, least)[3]
            yield batch.filter(pa.array(kept))

    docs_columns = docs.columns
    return docs.mapInArrow(keep, docs.schema)
