"""Vectors as short codes: each part of a vector is named by its nearest codebook entry.

Components become integers, so that sums, distances and ties are exact and no
order of work changes a codebook. The nearest entry is found in a geometric
near-neighbour access tree over a codebook's entries: a node has a few split
points, every other entry lies under the split point nearest to it, and for
each two split points i and j the node keeps the range of distances from i to
the entries under j. A query at distance d from i, whose best entry so far is
r away, can have nothing as near under j if d - r lies above that range or
d + r below it. The test is strict and all roundings go to the safe side, so
entries as near as the best are always met; the answer is decided on integers,
ties going to the entry listed first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.llm.tables import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Integers per unit of a component.
SCALE = 256
#: Split points of a node; a node with no more entries than that has no children.
SPLITS = 8
#: Share by which a distance in doubles may be off, with much to spare.
ROUNDING = 2.0**-48
#: Components that a task looks at together.
AT_ONCE = 1_000_000
SALTS = 16


@dataclass
class SplitNode:
    """Split points, and per pair (i, j) the range of distances from i to all under j."""

    split: np.ndarray
    least: np.ndarray
    greatest: np.ndarray
    children: list[SplitNode | None]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``a`` to each of ``b``, as integers."""
    away = a[:, None, :] - b[None, :, :]
    return np.einsum("ijk,ijk->ij", away, away)


class AccessTree:
    """Exact nearest entry of a codebook, for many queries at once."""

    def __init__(self, points: np.ndarray, splits: int = SPLITS):
        self.points = np.asarray(points, np.int64)
        self.splits = splits
        self.root = self._node(np.arange(len(self.points)))

    def _node(self, own: np.ndarray) -> SplitNode | None:
        if not len(own):
            return None
        if len(own) <= self.splits:
            none = np.zeros((len(own), len(own)))
            return SplitNode(own, none, none, [])
        away = squared(self.points[own], self.points[own])
        # Far from each other: each split point is the one farthest from those before it.
        chosen = [0]
        while len(chosen) < self.splits:
            gap = away[:, chosen].min(axis=1)
            gap[chosen] = -1
            chosen.append(int(gap.argmax()))
        chosen.sort()
        rest = np.setdiff1d(np.arange(len(own)), chosen)
        side = away[rest][:, chosen].argmin(axis=1)
        under = [rest[side == j] for j in range(self.splits)]
        least, greatest = (np.zeros((self.splits, self.splits)) for _ in range(2))
        for j, below in enumerate(under):
            if len(below):
                reach = np.sqrt(away[np.ix_(chosen, below)])
                least[:, j], greatest[:, j] = reach.min(axis=1), reach.max(axis=1)
        return SplitNode(own[chosen], least, greatest, [self._node(own[x]) for x in under])

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each query's nearest entry, the first of equals, and its squared distance."""
        entry = np.full(len(queries), len(self.points), np.int64)
        best = np.full(len(queries), np.iinfo(np.int64).max)

        def visit(node: SplitNode, active: np.ndarray) -> None:
            away = squared(queries[active], self.points[node.split])
            first = away.argmin(axis=1)
            least = away[np.arange(len(active)), first]
            found = node.split[first]
            nearer = (least < best[active]) | ((least == best[active]) & (found < entry[active]))
            best[active[nearer]], entry[active[nearer]] = least[nearer], found[nearer]
            if not any(node.children):
                return
            # First under the nearest split point; the others by what is then known.
            for j, child in enumerate(node.children):
                if child and (first == j).any():
                    visit(child, active[first == j])
            reach = np.sqrt(away)
            low, high = reach * (1 - ROUNDING), reach * (1 + ROUNDING)
            for j, child in enumerate(node.children):
                if not child:
                    continue
                radius = np.sqrt(best[active]) * (1 + ROUNDING)
                out = (low - radius[:, None] > node.greatest[:, j] * (1 + ROUNDING)).any(axis=1)
                out |= (high + radius[:, None] < node.least[:, j] * (1 - ROUNDING)).any(axis=1)
                left = ~out & (first != j)
                if left.any():
                    visit(child, active[left])

        if self.root and len(queries):
            visit(self.root, np.arange(len(queries)))
        return entry, best


@dataclass
class Codebooks:
    """Of vectors of one length: ``entries[part, entry]`` holds the entry's integers."""

    entries: np.ndarray

    def __post_init__(self) -> None:
        self.trees = [AccessTree(part) for part in self.entries]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assigned(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers of each vector's parts, and its error: squared distances summed."""
        parts, _, size = self.entries.shape
        cut = vectors.reshape(len(vectors), parts, size)
        found = [tree.nearest(cut[:, n]) for n, tree in enumerate(self.trees)]
        return np.stack([x for x, _ in found], axis=1), sum(error for _, error in found)

    def restored(self, codes: list[str]) -> np.ndarray:
        """The vectors that codes stand for, in units of the original components."""
        numbers = np.array([list(bytes.fromhex(code)) for code in codes], np.int64)
        numbers = numbers.reshape(len(codes), len(self.entries))
        joined = [part[numbers[:, n]] for n, part in enumerate(self.entries)]
        return np.concatenate(joined, axis=1) / SCALE


def largest(width: int) -> int:
    """Integers up to this size can't bring the error of a vector over a long."""
    return int((2.0**60 / max(width, 1)) ** 0.5)


def integers(rows: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """Columns id, label and ``vector`` as integers floor(256 x), of rows that take part.

    Vectors that are null or hold null or non-finite components take no part;
    nor do those that can't be cut into 16 equal parts, or hold a component so
    large (2^30 / 256 by the root of the length) that a long couldn't hold the error.
    """

    def quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            here = batch.filter(batch.column(2).is_valid())
            column = here.column(2)
            # Nulls become NaN here.
            x = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            ends = np.cumsum(column.value_lengths().to_numpy().astype(np.int64))
            size = np.diff(ends, prepend=0)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(x * SCALE)
                limit = np.repeat([largest(w) for w in size.tolist()], size)
                bad = np.concatenate([[0], np.cumsum(~(np.abs(x) <= limit))])
            kept = (bad[ends] == bad[ends - size]) & (size % PARTS == 0)
            whole = x[np.repeat(kept, size)].astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum(size[kept])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(whole))
            ids = here.select([0, 1]).filter(pa.array(kept))
            yield pa.RecordBatch.from_arrays(
                [*ids.columns, lists], names=["vec_id", "label", "vector"]
            )

    named = rows.select(F.col(id).alias("vec_id"), F.col(label).alias("label"), F.col(vector))
    kinds = {field.name: field.dataType.simpleString() for field in named.schema.fields[:2]}
    return named.mapInArrow(
        quantised, f"vec_id {kinds['vec_id']}, label {kinds['label']}, vector array<int>"
    )


def of_one_width(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, places, vectors) of a column without nulls, some vectors at a time."""
    size = column.value_lengths().to_numpy().astype(np.int64)
    x = column.flatten().to_numpy().astype(np.int64)
    begin = np.cumsum(size) - size
    for width in np.unique(size).tolist():
        places = np.flatnonzero(size == width)
        step = max(1, AT_ONCE // max(width, 1))
        for k in range(0, len(places), step):
            some = places[k : k + step]
            yield width, some, x[begin[some][:, None] + np.arange(width)]


def first_entries(rows: DataFrame, width: int, entries: int) -> np.ndarray:
    """Vectors of the smallest ids, ascending; of an id with several, the smallest one."""
    own = rows.filter((F.size("vector") == width) & F.col("vec_id").isNotNull())
    ids = [row[0] for row in own.select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    least = own.filter(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("vector"))
    found = dict(map(tuple, least.collect()))
    return np.array([found[x] for x in ids], np.int64).reshape(len(ids), width)


def part_sums(rows: DataFrame, books: dict[int, Codebooks]) -> DataFrame:
    """Per length, part, entry and place in it: how many parts chose it, and their sum.

    Each task adds up its own first, so it hands on no more rows than the
    codebooks have components, however many vectors chose one entry.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {w: np.zeros(book.entries.shape, np.int64) for w, book in books.items()}
        counts = {w: np.zeros(book.entries.shape[:2], np.int64) for w, book in books.items()}
        for batch in batches:
            for width, _, vectors in of_one_width(batch.column(0)):
                if width not in books:
                    continue
                chosen, _ = books[width].assigned(vectors)
                cut = vectors.reshape(len(vectors), *sums[width].shape[::2])
                for part in range(cut.shape[1]):
                    np.add.at(sums[width][part], chosen[:, part], cut[:, part])
                    counts[width][part] += np.bincount(
                        chosen[:, part], minlength=counts[width].shape[1]
                    )
        for width, total in sums.items():
            part, entry, place = (x.ravel() for x in np.indices(total.shape))
            count = np.repeat(counts[width].ravel(), total.shape[2])
            used = count > 0
            columns = [np.full(used.sum(), width), part[used], entry[used], place[used],
                       total.ravel()[used], count[used]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in columns],
                names=["width", "part", "entry", "place", "total", "chosen"],
            )

    layout = "width long, part long, entry long, place long, total long, chosen long"
    sums = rows.select("vector").mapInArrow(summed, layout)
    keys = ["width", "part", "entry", "place"]
    return sums.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("chosen").alias("chosen"))


def train(rows: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> dict[int, Codebooks]:
    """Codebooks per length of vectors, from ``integers``; all rows count in every round.

    Vectors of another length can't share a codebook, so each length has its
    own, begun from its own smallest ids. The driver holds the codebooks only.
    Without a single id there is nothing to begin from, and no codebook.
    """
    sizes = rows.filter(F.col("vec_id").isNotNull()).select(F.size("vector").alias("width"))
    books = {}
    for (width,) in sizes.distinct().orderBy("width").collect():
        begun = first_entries(rows, width, entries)
        cut = begun.reshape(len(begun), PARTS, width // PARTS)
        books[width] = Codebooks(np.ascontiguousarray(cut.transpose(1, 0, 2)))
    for _ in range(rounds if books else 0):
        new = {width: book.entries.copy() for width, book in books.items()}
        for row in part_sums(rows, books).collect():
            new[row.width][row.part, row.entry, row.place] = row.total // row.chosen
        books = {width: Codebooks(x) for width, x in new.items()}
    return books


def coded(rows: DataFrame, books: dict[int, Codebooks]) -> DataFrame:
    """Each of ``integers``' rows as a code: two hex digits a part, and its error."""
    digests = {width: book.digest() for width, book in books.items()}

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, places, vectors in of_one_width(batch.column(2)):
                if width not in books:
                    continue
                chosen, error = books[width].assigned(vectors)
                text = [row.tobytes().hex() for row in chosen.astype(np.uint8)]
                ids = batch.select([0, 1]).take(pa.array(places))
                yield pa.RecordBatch.from_arrays(
                    [*ids.columns, pa.array(text), pa.array(error, pa.int64()),
                     pa.array([digests[width]] * len(text))],
                    names=["vec_id", "label", "code", "error", "codebooks_sha256"],
                )

    kinds = {field.name: field.dataType.simpleString() for field in rows.schema.fields}
    return rows.mapInArrow(
        codes,
        f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long, "
        "codebooks_sha256 string",
    )


def with_label_error(rows: DataFrame) -> DataFrame:
    """Add the error summed over rows of an equal label, nulls together.

    Sums are made per task before the shuffle. They are few beside the rows, and
    are given to each of some salts, so that a label with most rows has many tasks.
    A sum that no long holds is null.
    """
    sums = rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38, 0)")).alias("total"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    sums = sums.select(
        F.col("label").alias("of"), F.col("total").try_cast("long").alias("label_error"),
        salts.alias("salt"),
    )
    salted = rows.withColumn("salt_of", F.monotonically_increasing_id() % SALTS)
    met = F.col("label").eqNullSafe(F.col("of")) & (F.col("salt_of") == F.col("salt"))
    return salted.join(sums, met).select(*rows.columns, "label_error")


def vector_codes(
    rows: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """Codes of all vectors by codebooks trained on all of them.

    Rows that take no part (see ``integers``) are left out. Repeated rows count
    and come back as often as they are there; rows with a null id are coded too
    but begin no entry, and an id begins one entry however often it occurs. An
    empty table gives no rows; other columns of the input have no effect.
    """
    whole = stored(integers(rows, id, vector, label), "vectors")
    codes = stored(coded(whole, train(whole)), "codes")
    return with_label_error(codes).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256", "label"
    )
