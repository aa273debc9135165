"""Mixing sources to target weights by balanced sampling, the cube method.

A source's target is its share of all words by weight, and its rate is target
over size. Each of its documents is taken floor(rate) times, and once more with
the rate's fraction as inclusion probability. The probabilities are moved
through the null space of the balancing constraints (documents and words of
the source) until nearly all are 0 or 1: three or more documents with
probabilities strictly between leave directions that change neither total, and
a step along one, up or down with the odds that keep the expectations, ends at
a 0 or 1.

Documents of a source are dealt over blocks of bounded size. A block keeps two
open probabilities at most, and the open ones of all blocks meet in blocks of
the next round, so that each source ends with one block and a landing problem
of two documents. Long documents come first in a block, so that what stays
open is short. All draws follow from hashes of the rows: reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of sources by rank, repeating; and how often a document may be taken.
WEIGHTS = (1, 2, 3)
MOST = 3
#: Documents of a source that a task balances together.
BLOCK = 4096
#: Documents whose probabilities move together.
WINDOW = 1024
#: The least share of its own axis that a leading document keeps in the null space.
LEAST_FREE = 0.01
#: Probabilities this near to 0 or 1 are settled.
NEAR = 1e-9
#: Equal rows that one row is turned into at once.
RUN = 4096


@dataclass(frozen=True)
class Share:
    """A source, its words, and the words wanted of it."""

    source: str | None
    size: int
    target: Fraction

    @property
    def rate(self) -> Fraction:
        return self.target / self.size if self.size else Fraction(0)


def word_sizes(docs: DataFrame, id: str, text: str, source: str) -> DataFrame:
    """Columns id, source and size, the number of words of the text; null: none."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pc.count_substring_regex(batch.column(2), WORD).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pc.fill_null(words, 0)],
                names=["doc_id", "source", "size"],
            )

    named = docs.select(F.col(id).alias("doc_id"), F.col(source).alias("source"), F.col(text))
    kind = named.schema["doc_id"].dataType.simpleString()
    return named.mapInArrow(counted, f"doc_id {kind}, source string, size long")


def shares(
    sizes: dict[str | None, int], weights: Sequence[int] = WEIGHTS, most: int = MOST
) -> list[Share]:
    """Targets that add up to all words: by weight, none above ``most`` times its source.

    Weights go to sources by code point, null last, repeating. What is above a
    source's bound is shared by weight among those still below theirs.
    """
    names = sorted((x for x in sizes if x is not None), key=lambda x: [ord(c) for c in x])
    names += [None] if None in sizes else []
    weight = {x: weights[n % len(weights)] for n, x in enumerate(names)}
    target: dict[str | None, Fraction] = {}
    open_ = list(names)
    while open_:
        left = sum(sizes.values()) - sum(target.values())
        each = Fraction(left) / sum(weight[x] for x in open_)
        above = [x for x in open_ if each * weight[x] > most * sizes[x]]
        if not above:
            target.update((x, each * weight[x]) for x in open_)
            break
        target.update((x, Fraction(most * sizes[x])) for x in above)
        open_ = [x for x in open_ if x not in target]
    return [Share(x, sizes[x], target[x]) for x in names]


def direction(size: np.ndarray) -> np.ndarray:
    """A way to move probabilities that changes neither the documents' nor the words' total.

    The longest document's own axis, projected on the null space of the two
    constraints: of all documents this one moves fastest and is settled first.
    One so much longer than all others that they can't make up for it stands
    still, and the next one leads.
    """
    n = len(size)
    from_mean = size - size.mean()
    spread = from_mean @ from_mean
    scaled = from_mean / spread if spread else np.zeros(n)
    free = 1 - 1 / n - from_mean * scaled
    able = np.flatnonzero(free > LEAST_FREE)
    lead = able[0] if len(able) else int(free.argmax())
    way = -1 / n - from_mean[lead] * scaled
    way[lead] += 1
    return way


def step(odds: np.ndarray, way: np.ndarray, draw: float) -> np.ndarray:
    """Move along ``way``, up or down by the odds that keep expectations, until one is 0 or 1."""
    with np.errstate(divide="ignore", invalid="ignore"):
        to_one, to_none = (1 - odds) / np.abs(way), odds / np.abs(way)
    up = np.where(way > 0, to_one, np.where(way < 0, to_none, np.inf))
    down = np.where(way > 0, to_none, np.where(way < 0, to_one, np.inf))
    far, back = up.min(), down.min()
    forward = draw * (far + back) < back
    moved = odds + (far if forward else -back) * way
    ends = up.argmin() if forward else down.argmin()
    moved[ends] = float((way[ends] > 0) == forward)
    return moved


def landing(odds: list[float], size: list[int]) -> list[int]:
    """Settle the last probabilities: the choice nearest to the words' total, then the documents'."""

    def off(choice: Sequence[int]) -> tuple[float, float]:
        moved = [x - p for x, p in zip(choice, odds, strict=True)]
        return abs(sum(m * s for m, s in zip(moved, size, strict=True))), abs(sum(moved))

    return list(min(product((0, 1), repeat=len(odds)), key=off))


def flight(odds: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Probabilities moved until two at most are strictly between 0 and 1.

    Goes from long documents to short ones, some at a time: what ends is replaced.
    """
    out = np.where(odds > 1 - NEAR, 1.0, np.where(odds < NEAR, 0.0, odds))
    coming = np.flatnonzero((out > 0) & (out < 1))
    draws = np.random.default_rng(seed).random(len(coming))
    held, size = coming[:WINDOW], size.astype(float)
    taken = turn = 0
    while len(held) > 2:
        moved = step(out[held], direction(size[held]), draws[turn])
        moved[moved < NEAR], moved[moved > 1 - NEAR] = 0, 1
        out[held] = moved
        left = held[(moved > 0) & (moved < 1)]
        taken += len(held) - len(left)
        held = np.concatenate([left, coming[taken + len(left) : taken + WINDOW]])
        turn += 1
    return out


def balanced(units: DataFrame, blocks: str, last: bool, salt: int) -> DataFrame:
    """Move the probabilities ``odds`` of the units of each block, and settle the ``last``.

    Units are those of one source in one of its ``blocks`` many blocks. They are
    distinct, so hashes deal them evenly whatever repeats in the documents.
    """

    def moved(block: pd.DataFrame) -> pd.DataFrame:
        # Long ones first.
        block = block.sort_values(["size", "mark", "doc_id"], ascending=[False, True, True])
        odds = block["odds"].to_numpy(float)
        # Content decides the draws: neither files nor partitions do.
        seed = int(np.bitwise_xor.reduce(block["mark"].to_numpy(np.int64)))
        odds = flight(odds, block["size"].to_numpy(), (seed ^ salt) & (2**63 - 1))
        if last:
            left = np.flatnonzero((odds > 0) & (odds < 1))
            odds[left] = landing(odds[left].tolist(), block["size"].to_numpy()[left].tolist())
        return block.assign(odds=odds)

    block = F.pmod(F.xxhash64("mark", F.lit(salt)), F.col(blocks)).alias("block")
    return units.groupBy("rank", block).applyInPandas(moved, units.schema)


def mixed(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    block: int = BLOCK,
) -> DataFrame:
    """Every document, and how often the mix takes it.

    Columns doc_id, size (words), source, source_size, target, copies and taken
    = copies * size. A source's words stay within some short documents of its
    target. Rows with an equal id, source and size are one unit of the sampling:
    of n such rows with probability p, floor(n p) are taken once more and one
    may be. Null ids and null sources are values like any other; a null or empty
    text has size 0 and gives no words however often it is taken. An empty table
    gives no rows. The driver holds one row per source.
    """
    spark = docs.sparkSession
    base = stored(word_sizes(docs, id, text, source), "sizes")
    units = stored(
        base.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")), "units"
    )
    by_source = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("size"), F.count("*").alias("units")
    )
    sizes = {row.source: (row["size"], row.units) for row in by_source.collect()}
    wanted = shares({x: size for x, (size, _) in sizes.items()}, weights, most)
    plan = [
        (rank, share.source, share.size, float(share.target), int(share.rate),
         float(share.rate % 1), -(-sizes[share.source][1] // block))
        for rank, share in enumerate(wanted)
    ]
    names = "rank int, of string, source_size long, target double, whole int, part double, blocks int"
    # A row per source: Spark knows its size and broadcasts it while that is small.
    rates = spark.createDataFrame(plan, names)
    expected = F.col("rows") * F.col("part")
    # A product a rounding below a whole number is that number.
    sure = F.floor(expected + NEAR).cast("long")
    state = units.join(rates, F.col("source").eqNullSafe(F.col("of"))).select(
        "rank", "doc_id", "size", "rows", "blocks",
        F.xxhash64("doc_id", "source", "size").alias("mark"),
        sure.alias("sure"),
        F.greatest(expected - sure, F.lit(0.0)).alias("odds"),
    )
    settled = []
    widest, turn = max((row[-1] for row in plan), default=0), 0
    while widest:
        last = widest == 1
        moved = stored(balanced(state, "blocks", last, turn), "flight")
        still = (F.col("odds") > 0) & (F.col("odds") < 1)
        settled.append(moved.filter(~still))
        if last:
            break
        # Two units of each block at most are still open. A source that has one block only
        # keeps its two for the last round.
        state = moved.filter(still).withColumn(
            "blocks", F.ceil(F.col("blocks") * 2 / F.lit(block)).cast("int")
        )
        widest, turn = -(-widest * 2 // block), turn + 1
    if not settled:
        return spark.createDataFrame([], f"doc_id {base.schema['doc_id'].dataType.simpleString()}, "
                                     "size long, source string, source_size long, target double, "
                                     "copies int, taken long")
    done = settled[0]
    for more in settled[1:]:
        done = done.unionByName(more)
    # Rows come back in runs, so that very many equal ones are the work of many tasks.
    run = F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / RUN)))
    runs = done.select("*", run.alias("run"))
    runs = runs.filter(F.col("rows") <= RUN).unionByName(
        runs.filter(F.col("rows") > RUN).repartition("mark", "run")
    )
    first = F.col("run") * RUN
    end = F.least(first + RUN, F.col("rows")) - 1
    every = runs.select("*", F.explode(F.sequence(first, end)).alias("nth"))
    more = F.when(F.col("nth") < F.col("sure") + F.col("odds").cast("long"), 1).otherwise(0)
    return every.join(rates.drop("blocks"), "rank").select(
        "doc_id", "size", F.col("of").alias("source"), "source_size", "target",
        (F.col("whole") + more).alias("copies"),
        ((F.col("whole") + more) * F.col("size")).cast("long").alias("taken"),
    )
