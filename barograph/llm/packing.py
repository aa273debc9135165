"""Packing documents into sequences by vector best fit.

A sequence has capacities for tokens, documents and attention cost (the sum of
squared lengths). Only lengths matter for the plan, so it is made for all
documents at once from the number of pieces of each length: at most ``capacity``
rows, whatever the size of the corpus. Sequences with equal residual capacities
form a class. Lengths are placed longest first, each into the class that the
score picks among those that hold it under every constraint, and as many pieces
at a time as the class or the length has. A new sequence is opened only where no
class fits. The moves of the plan are intervals, of piece numbers within a
length and of sequence numbers, so each piece finds its place by its number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.llm.chunks import CHUNKS_KEPT, in_portions
from barograph.llm.tables import numbered, stored
from barograph.llm.tokens import token_memory


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds; the defaults for documents and cost never bind before tokens."""

    tokens: int = 1024
    documents: int = 1024
    cost: float = 1024.0**2

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.cost], float)


@dataclass(frozen=True)
class Score:
    """How a class is picked: ``norm`` takes the smallest weighted norm of what would remain,
    ``dot`` the largest weighted dot product of demand and residual. Both are of shares of
    the capacities; tokens weigh most by default, so that sequences fill up."""

    by: str = "norm"
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)

    def best(self, residual: np.ndarray, demand: np.ndarray, whole: np.ndarray) -> int:
        weights = np.array(self.weights)
        if self.by == "dot":
            return int(np.argmax((residual / whole) @ (weights * demand / whole)))
        left = (residual - demand) / whole
        return int(np.argmin((left * left) @ weights))


@dataclass(frozen=True)
class Plan:
    """Moves by length: pieces ``first``.. go to sequences ``sequence``.. at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    count: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these numbers within their lengths."""
        # Moves stand in order of length and first number; both fit in one key.
        wide = max(1, int(number.max(initial=0)) + 1, int(self.first.max(initial=0)) + 1)
        move = np.searchsorted(self.length * wide + self.first, length * wide + number, "right") - 1
        return self.sequence[move] + number - self.first[move], self.offset[move]


class _Classes:
    """Open sequences by residual vector; each class has runs (first sequence, count)."""

    def __init__(self) -> None:
        self.residual = np.zeros((0, 3))
        self.runs: list[list[list[int]]] = []
        self.place: dict[tuple, int] = {}

    def add(self, residual: np.ndarray, sequence: int, count: int) -> None:
        key = tuple(residual)
        if key not in self.place:
            self.place[key] = len(self.runs)
            self.runs.append([])
            self.residual = np.vstack([self.residual, residual])
        self.runs[self.place[key]].append([sequence, count])

    def drop_empty(self) -> None:
        kept = [k for k, runs in enumerate(self.runs) if runs]
        self.residual, self.runs = self.residual[kept], [self.runs[k] for k in kept]
        self.place = {tuple(x): k for k, x in enumerate(self.residual)}


def best_fit_plan(
    counts: dict[int, int], capacity: Capacity = Capacity(), score: Score = Score()
) -> Plan:
    """Place ``counts`` pieces of each length; a length no empty sequence holds is an error."""
    whole, moves, opened = capacity.vector(), [], 0
    classes = _Classes()
    for length in sorted(counts, reverse=True):
        demand = np.array([length, 1, length * length], float)
        if (demand > whole).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        number, left = 0, counts[length]
        while left:
            fits = np.flatnonzero((classes.residual >= demand).all(axis=1))
            if len(fits):
                k = int(fits[score.best(classes.residual[fits], demand, whole)])
                residual, runs = classes.residual[k], classes.runs[k]
                sequence, has = runs[-1]
                count = min(left, has)
                runs[-1] = [sequence + count, has - count]
                if count == has:
                    runs.pop()
            else:
                # As many new sequences as these pieces fill when they fit together.
                per = int((whole / demand).min())
                residual, sequence, count = whole, opened, -(-left // per)
                opened += count
            moves.append((length, number, count, sequence, int(whole[0] - residual[0])))
            number, left = number + count, left - count
            classes.add(residual - demand, sequence, count)
            classes.drop_empty()
    columns = np.array(moves, np.int64).reshape(-1, 5)
    columns = columns[np.lexsort((columns[:, 1], columns[:, 0]))]
    return Plan(*columns.T, sequences=opened)


def pieces(
    docs: DataFrame,
    path: str,
    end: int,
    most: int,
    key: str = "doc_id",
    text: str = "text",
    chunks_kept: int = CHUNKS_KEPT,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, row (tells equal ids apart).

    A document longer than ``most`` tokens is cut into pieces of that length;
    the first is the shorter one.
    """
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, last = token_memory(path, chunks_kept), np.array([end], "<u4").tobytes()
        for batch in batches:
            for begin, run in in_portions(batch["_text"]):
                of, piece, start, length, crc = [], [], [], [], []
                for k, ids in enumerate(memory.encode(run)):
                    ids += last
                    n = len(ids) // 4
                    at, to = 0, (n - 1) % most + 1
                    while at < n:
                        of.append(begin + k)
                        piece.append((at + most - 1) // most)
                        start.append(at)
                        length.append(to - at)
                        crc.append(zlib.crc32(ids[4 * at : 4 * to]))
                        at, to = to, to + most
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                found = zip((piece, start, length, crc), kinds, strict=True)
                columns = [batch["doc_id"].take(pa.array(of, pa.int64()))]
                columns += [pa.array(x, kind) for x, kind in found]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


def packed(
    docs: DataFrame,
    path: str,
    end: int,
    capacity: Capacity = Capacity(),
    score: Score = Score(),
    key: str = "doc_id",
    text: str = "text",
    chunks_kept: int = CHUNKS_KEPT,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece of the end token. Null ids are kept.
    Repeated rows are documents of their own. Other columns are not looked at.
    An empty table gives no rows. Pieces are encoded once, kept as rows without
    their ids, and numbered within their lengths over salts, so that a length
    with most pieces stays on many tasks. What reaches the driver is a count per
    length; what is sent out is the plan.
    """
    longest = min(capacity.tokens, int(capacity.cost**0.5))
    kept = stored(pieces(docs, path, end, longest, key, text, chunks_kept), "pieces")
    counts = {row[0]: row[1] for row in kept.groupBy("length").count().collect()}
    plan = best_fit_plan(counts, capacity, score)
    ranked = numbered(kept, ["length"], ["doc_id", "piece", "ids_crc32"], "number")
    shared = docs.sparkSession.sparkContext.broadcast(plan)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch["length"].to_numpy(), batch["number"].to_numpy()
            sequence, offset = shared.value.place(length, number)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                [*names[:-1], "sequence_id", "offset"],
            )

    names = ranked.columns
    kind = kept.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(
        place,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
