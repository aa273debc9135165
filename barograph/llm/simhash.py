"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints that differ in at most ``DIFFERENCES`` bits agree in some ``lead``
of whole blocks out of ``DIFFERENCES`` + lead blocks. For each choice of lead
blocks the fingerprints are dealt by them, the index's top level, so no pair is
missed. Below a lead they stand in the order of their Gray ranks, where
neighbours share long runs of bits: runs of them form nodes, which keep the bits
all their fingerprints share (mask and pattern) and are grouped again. Two nodes
are compared by the shared bits alone: more differences there than allowed
prune all pairs below them, and few enough even if every other bit differed
link all of them at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from barograph.llm.components import Union, components
from barograph.llm.tables import split_groups, stored

SHINGLE = 4
SEED = 42
DIFFERENCES = 4
#: Children of a node of the index.
FANOUT = 8
#: A lead's fingerprints that meet in one task, and node pairs compared at once.
TOGETHER = 8_000
PAIRS = 400_000
#: Lead blocks are added until so many fingerprints share a lead on average.
PER_LEAD = 256

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_PLACES = np.arange(8) * 256


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit majority of the hashes of all word shingles; zero without words."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hashed(joined, seed)
    lengths = list(map(len, words))
    starts = [0, *accumulate(n + 1 for n in lengths)][:-1]
    ends = list(map(add, starts, lengths))
    spans = zip(starts, ends[shingle - 1 :], strict=False)
    hashes = np.array([hashed(joined[x:y], seed) for x, y in spans], "<u8")
    cells = (hashes.view(np.uint8).reshape(-1, 8) + _PLACES).ravel()
    counts = np.bincount(cells, minlength=2048).reshape(8, 256) @ _BITS
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, axis=1, bitorder="little").ravel().view("<u8")[0])


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """doc_id, fingerprint (as a signed 64-bit integer) and text_hash of each row."""
    own = docs.select(
        F.col(key).alias("doc_id"), F.col(text).alias("_text"), F.xxhash64(text).alias("text_hash")
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter(
                (fingerprint(x.as_py(), shingle) for x in batch["_text"]), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(prints.view(np.int64)), batch["text_hash"]],
                ["doc_id", "fp", "text_hash"],
            )

    schema = T.StructType(
        [own.schema["doc_id"], *(T.StructField(x, T.LongType()) for x in ("fp", "text_hash"))]
    )
    return own.mapInArrow(measure, schema)


def gray_rank(code: Column) -> Column:
    """The place of a 64-bit code in Gray order, as a signed integer of the same order."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(2**63)))


def lead_masks(lead: int, differences: int = DIFFERENCES) -> list[int]:
    """Masks of each choice of ``lead`` blocks, as signed integers."""
    blocks = differences + lead
    edges = [64 * n // blocks for n in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), lead):
        mask = sum((1 << edges[n + 1]) - (1 << edges[n]) for n in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def lead_blocks(
    distinct: int, per_lead: int = PER_LEAD, differences: int = DIFFERENCES
) -> int:
    """How many blocks lead: any number finds all links; more make smaller groups."""
    lead = 1
    while distinct / 2 ** (64 * lead / (differences + lead)) > per_lead and lead < 6:
        lead += 1
    return lead


def _levels(prints: np.ndarray, group: np.ndarray):
    """The index over sorted groups, leaves first: (mask, pattern, first child, end) a level."""
    n = len(prints)
    levels = [(np.full(n, ~np.uint64(0)), prints, None, None)]
    every, some, owner = prints, prints, group
    while len(owner) > 1 and (owner[1:] == owner[:-1]).any():
        change = np.r_[True, owner[1:] != owner[:-1]]
        begin = np.maximum.accumulate(np.where(change, np.arange(len(owner)), 0))
        first = np.flatnonzero((np.arange(len(owner)) - begin) % FANOUT == 0)
        end = np.r_[first[1:], len(owner)]
        every = np.bitwise_and.reduceat(every, first)
        some = np.bitwise_or.reduceat(some, first)
        owner = owner[first]
        mask = ~(every ^ some)
        levels.append((mask, every & mask, first, end))
    return levels


def _children(node_a, node_b, first, end):
    """All pairs of a child of a and a child of b; of a node with itself each pair once."""
    wide_a, wide_b = end[node_a] - first[node_a], end[node_b] - first[node_b]
    wide = wide_a * wide_b
    of = np.repeat(np.arange(len(node_a)), wide)
    step = np.arange(len(of)) - np.repeat(np.cumsum(wide) - wide, wide)
    a = first[node_a][of] + step // wide_b[of]
    b = first[node_b][of] + step % wide_b[of]
    once = a <= b
    return a[once], b[once]


def linked(prints: np.ndarray, group: np.ndarray, differences: int = DIFFERENCES) -> np.ndarray:
    """For fingerprints in Gray order by group: the first member each one is linked to."""
    levels = _levels(prints, group)
    starts, ends = [np.arange(len(prints))], [np.arange(len(prints)) + 1]
    for _, _, first, end in levels[1:]:
        starts.append(starts[-1][first])
        ends.append(ends[-1][end - 1])
    union = Union(len(prints))
    top = np.arange(len(levels[-1][0]))
    waiting = [(len(levels) - 1, top, top)]
    while waiting:
        depth, a, b = waiting.pop()
        if depth == 0:
            continue
        # The whole of a portion's children is compared at once, portion by portion.
        if len(a) * FANOUT**2 > PAIRS and len(a) > 1:
            half = len(a) // 2
            waiting += [(depth, a[:half], b[:half]), (depth, a[half:], b[half:])]
            continue
        a, b = _children(a, b, *levels[depth][2:])
        depth -= 1
        mask, pattern = levels[depth][:2]
        shared = mask[a] & mask[b]
        least = np.bitwise_count((pattern[a] ^ pattern[b]) & shared)
        close = least <= differences
        a, b, shared, least = a[close], b[close], shared[close], least[close]
        whole = least + np.bitwise_count(~shared) <= differences
        if whole.any():
            for nodes in (a[whole], b[whole]):
                nodes = np.unique(nodes)
                wide = ends[depth][nodes] - starts[depth][nodes]
                heads = np.repeat(starts[depth][nodes], wide)
                within = np.arange(len(heads)) - np.repeat(np.cumsum(wide) - wide, wide)
                union.link(heads, heads + within)
            union.link(starts[depth][a[whole]], starts[depth][b[whole]])
        if depth:
            waiting.append((depth, a[~whole], b[~whole]))
    return union.root


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[np.ndarray]:
    """Whole groups of sorted rows (columns: group hash, fingerprint), about ``most`` rows a time."""
    kept: list[np.ndarray] = []
    rows = 0
    for batch in batches:
        kept.append(np.stack([batch.column(n).to_numpy() for n in range(5)], axis=1))
        rows += batch.num_rows
        if rows >= most:
            held = np.concatenate(kept)
            ends = np.flatnonzero((held[1:, :4] != held[:-1, :4]).any(axis=1))
            if len(ends):
                yield held[: ends[-1] + 1]
                held = held[ends[-1] + 1 :]
            kept, rows = [held], len(held)
    if rows:
        yield np.concatenate(kept)


def links(
    distinct: DataFrame, lead: int, together: int = TOGETHER, differences: int = DIFFERENCES
) -> DataFrame:
    """Links (a, b) that connect all fingerprints within the allowed differences.

    Not every linked pair is there, but enough to reach each from the other.
    """
    leads = F.array(
        *[
            F.struct(F.lit(n).alias("which"), F.col("fp").bitwiseAND(F.lit(mask)).alias("lead"))
            for n, mask in enumerate(lead_masks(lead, differences))
        ]
    )
    dealt = distinct.select("fp", F.explode(leads).alias("l")).select("fp", "l.which", "l.lead")
    large = dealt.groupBy("which", "lead").agg(F.count("*").alias("size"))
    large = large.filter(F.col("size") > together)
    sized = dealt.join(large, ["which", "lead"], "left")
    sized = sized.withColumn("size", F.coalesce("size", F.lit(1)))
    parts = split_groups(sized, "fp", "size", together)
    own = ["which", "lead", "part_a", "part_b"]
    ordered = (
        parts.select(*[F.col(x).cast("long") for x in own], "fp")
        .repartition(*own)
        .sortWithinPartitions(*own, gray_rank(F.col("fp")))
    )

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _runs(batches, 2 * together):
            prints = np.ascontiguousarray(held[:, 4])
            change = np.r_[True, (held[1:, :4] != held[:-1, :4]).any(axis=1)]
            root = linked(prints.view(np.uint64), np.cumsum(change), differences)
            moved = root != np.arange(len(root))
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[moved]), pa.array(prints[root[moved]])], ["a", "b"]
            )

    return ordered.mapInArrow(connect, "a long, b long")


def _rooted(
    docs: DataFrame, key: str, text: str, shingle: int, differences: int
) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and per distinct one its smallest id, first row and root."""
    rows = stored(fingerprints(docs, key, text, shingle), "simhash")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "text_hash")
    distinct = rows.groupBy("fp").agg(
        F.min("doc_id").alias("first_id"), F.min(place).alias("first")
    )
    distinct = stored(distinct, "simhash-distinct")
    lead = lead_blocks(distinct.count(), differences=differences)
    found = components(links(distinct, lead, differences=differences))
    return rows, distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "first_id", "first", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    differences: int = DIFFERENCES,
) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id that can be reached over links of at
    most ``differences`` bits. Texts without words (null and empty ones too)
    have fingerprint zero and link like any other. Equal fingerprints count
    once in the search, so copies cost nothing. Repeated rows: one row each.
    Null ids: kept, never a component's id unless it has no other (then null).
    Other columns are not looked at. An empty table gives no rows.
    """
    rows, rooted = _rooted(docs, key, text, shingle, differences)
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    owner = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(owner, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    differences: int = DIFFERENCES,
) -> DataFrame:
    """Of each component the text with the smallest id (null last), with all its columns.

    Another text under that id is judged by its own component; in the same one
    it goes. Of rows that repeat both id and text one stays, whichever the hash
    of the whole row puts first. An empty table gives no rows.
    """
    _, rooted = _rooted(docs, key, text, shingle, differences)
    kept = rooted.groupBy("root").agg(F.min("first").alias("first"))
    # Names that the rows don't have; keys are never null, so both steps below share a shuffle.
    free = "_" * (1 + max(map(len, docs.columns)))
    own = [f"{free}none", f"{free}id", f"{free}hash"]

    def keys(number: Column, digest: Column) -> list[Column]:
        known = F.coalesce(number.cast("string"), F.lit(""))
        return [x.alias(n) for x, n in zip((number.isNull(), known, digest), own, strict=True)]

    kept = kept.select(*keys(F.col("first.doc_id"), F.col("first.text_hash")))
    rows = docs.select("*", *keys(docs[key], F.xxhash64(docs[text])))
    # Maps have no hash; rows that differ in nothing else are equal here.
    hashed = [x.name for x in docs.schema if "map<" not in x.dataType.simpleString()]
    turn = F.row_number().over(Window.partitionBy(*own).orderBy(F.xxhash64(*hashed)))
    once = rows.withColumn(f"{free}turn", turn).filter(F.col(f"{free}turn") == 1)
    return once.join(kept, own, "left_semi").select(*docs.columns)
