"""Alignment of two tokenizers' tokens over the same texts, by pointer jumping.

Each token of a text spans bytes of it, whichever tokenizer it comes from.
Every token points to the token that reaches farthest right among those that
overlap it; of two that end together, the second tokenizer's counts as farther.
Replacing each pointer by its target's pointer doubles the way it goes, and
after a few rounds all tokens of a connected group point to its last one. Those
last tokens are where both tokenizers end a token: the places that cut a text
into groups.

Both vocabularies keep words apart at blanks, so texts are encoded in chunks
cut there, each distinct chunk once per task and memory (see ``chunks``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.llm.chunks import ChunkMemory, in_portions
from barograph.llm.tables import stored
from barograph.llm.tokens import token_memory

BLANK = "▁"
#: Marks an id as the second tokenizer's, and a chunk whose tokens are not its bytes.
SECOND = np.uint32(1 << 31)
BROKEN = np.uint32(2**32 - 1)
#: Chunks remembered by a worker.
KEPT = 150_000
#: Pairs of ids that every task holds the count of; the counts of others are joined.
COMMON = 1_000_000
#: Pairs whose counts a task gathers before it hands them on.
GATHERED = 2_000_000
PORTION = 2_000_000


@dataclass
class Pair:
    """Both tokenizers: the bytes of each id's token, and ids of texts, chunk by chunk."""

    memory: ChunkMemory
    width_a: np.ndarray
    width_b: np.ndarray
    #: The ids as decimal numbers followed by ``,`` ``|`` or ``;``.
    text_a: np.ndarray
    text_b: np.ndarray

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids by the first and by the second tokenizer; none where tokens are not the text."""
        out = []
        # A text whose tokens would be taken for another's has none.
        for text, raw in zip(texts, self.memory.encode([f" {x}" if x else x for x in texts]),
                             strict=True):
            ids = np.frombuffer(raw, "<u4")
            if not text or (ids == BROKEN).any():
                ids = ids[:0]
            second = ids >= SECOND
            out.append((ids[~second], ids[second] ^ SECOND))
        return out


def texts_of(count: int) -> np.ndarray:
    return np.array([f"{n}{end}" for end in ",|;" for n in range(count)], object)


@lru_cache(maxsize=1)
def tokenizer_pair(path_a: str, path_b: str, kept: int = KEPT) -> Pair:
    """A byte-level BPE file and a sentencepiece BPE model; one memory per worker process."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = token_memory(path_a, kept, plain=True).encode_chunks
    vocabulary = Tokenizer.from_file(path_a).get_vocab()
    width_a = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, n in vocabulary.items():
        # A letter of a byte-level token stands for a byte.
        width_a[n] = len(token)
    second = sentencepiece.SentencePieceProcessor(model_file=path_b)
    pieces = [
        bytes([int(second.id_to_piece(n)[1:-1], 16)]) if second.is_byte(n)
        else second.id_to_piece(n).replace(BLANK, " ").encode()
        for n in range(second.get_piece_size())
    ]
    width_b = np.fromiter(map(len, pieces), np.int64, len(pieces))
    alone = second.piece_to_id(BLANK)

    def encode(chunks: list[str]) -> list[bytes]:
        # Every chunk begins with a blank, which the second tokenizer adds by itself.
        ids_b = second.encode([chunk[1:] for chunk in chunks], num_threads=1)
        out = []
        for chunk, a, b in zip(chunks, first(chunks), ids_b, strict=True):
            b = [alone] if chunk == " " else b
            whole = chunk.encode()
            size_a = width_a[np.frombuffer(a, "<u4")].sum()
            if size_a != len(whole) or b"".join([pieces[n] for n in b]) != whole:
                out.append(BROKEN.tobytes())
            else:
                out.append(a + (np.array(b, "<u4") | SECOND).tobytes())
        return out

    return Pair(
        ChunkMemory(encode, kept), width_a, width_b, texts_of(len(width_a)), texts_of(len(width_b))
    )


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers from 0 of the tokens of two sides that cover the same bytes.

    Takes the bytes' ends of each side's tokens, ascending. Tokens are numbered
    through, the first side's before the second's.
    """
    n = len(ends_a)
    # Who holds a token's last byte reaches at least as far right, and none farther.
    to_b = n + np.searchsorted(ends_b, ends_a - 1, side="right")
    to_a = np.searchsorted(ends_a, ends_b - 1, side="right")
    last = ends_a[to_a] == ends_b if n else np.zeros(0, bool)
    to = np.concatenate([to_b, np.where(last, n + np.arange(len(ends_b)), to_a)])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            break
        to = further
    number = np.cumsum(last) - 1
    return number[to[:n] - n], number[to[n:] - n]


def links_of(
    ends_a: np.ndarray, width_a: np.ndarray, ends_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens of the two sides that share a byte, as numbers in their side."""
    first = np.searchsorted(ends_b, ends_a - width_a, side="right")
    count = np.searchsorted(ends_b, ends_a - 1, side="right") - first + 1
    before = np.cumsum(count) - count
    second = np.arange(count.sum()) - np.repeat(before - first, count)
    return np.repeat(np.arange(len(ends_a)), count), second


def group_text(
    pair: Pair, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray
) -> np.ndarray:
    """Texts of the ids in the order ``a1,a2|b1;a3|b2,b3``, each with its end mark."""
    close_a = np.append(of_a[1:] != of_a[:-1], True)
    close_b = np.append(of_b[1:] != of_b[:-1], True)
    groups = np.arange(of_a[-1] + 1)
    b_before = np.searchsorted(of_b, groups, side="left")
    a_until = np.searchsorted(of_a, groups, side="right")
    out = np.empty(len(a) + len(b), object)
    out[np.arange(len(a)) + b_before[of_a]] = pair.text_a[a + close_a * len(pair.width_a)]
    out[np.arange(len(b)) + a_until[of_b]] = pair.text_b[b + close_b * 2 * len(pair.width_b)]
    return out


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
LINKS = "pairs binary, times binary"


def aligned(docs: DataFrame, path_a: str, path_b: str, id: str, text: str) -> DataFrame:
    """Per document its counts, the digest of its groups, and its links as pairs of ids.

    ``pairs`` holds the distinct pairs a * size of B's vocabulary + b, ascending,
    as unsigned 64-bit integers, and ``times`` how often each is linked in the
    document, in 32 bits.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(path_a, path_b)
        for batch in batches:
            for begin, texts in in_portions(batch.column(1), PORTION):
                columns = _portion(pair, texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, len(texts)), *columns],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256",
                           "pairs", "times"],
                )

    named = docs.select(F.col(id).alias("doc_id"), F.col(text))
    kind = named.schema["doc_id"].dataType.simpleString()
    return named.mapInArrow(rows, f"doc_id {kind}, {ALIGNED}, {LINKS}")


def _portion(pair: Pair, texts: list[str]) -> list[pa.Array]:
    """The columns of ``aligned`` for some texts, which are laid end to end for it."""
    sides = pair.encode(texts)
    n_a = np.array([len(a) for a, _ in sides])
    n_b = np.array([len(b) for _, b in sides])
    a = np.concatenate([a for a, _ in sides]).astype(np.int64)
    b = np.concatenate([b for _, b in sides]).astype(np.int64)
    if not len(a):
        none = np.zeros(len(texts), np.int64)
        return [*[pa.array(none)] * 4, pa.array([""] * len(texts)), *[pa.array([b""] * len(texts))] * 2]
    wide = pair.width_a[a]
    ends_a, ends_b = np.cumsum(wide), np.cumsum(pair.width_b[b])
    of_a, of_b = groups_of(ends_a, ends_b)
    words = group_text(pair, a, b, of_a, of_b)
    left, right = links_of(ends_a, wide, ends_b)
    document = np.repeat(np.arange(len(texts)), n_a)
    which = document[left]
    key = a[left] * len(pair.width_b) + b[right]
    # Both in one number to sort by, where they fit; pairs of two vocabularies take some 31 bits.
    bits = int(len(pair.width_a) * len(pair.width_b)).bit_length()
    both, times = np.unique((which.astype(np.uint64) << bits) | key.astype(np.uint64),
                            return_counts=True)
    place = np.arange(len(texts) + 1)
    cuts = np.searchsorted(both >> np.uint64(bits), place)
    both &= np.uint64((1 << bits) - 1)
    times = times.astype("<u4")
    n_links = np.bincount(which, minlength=len(texts))
    group_document = document[np.flatnonzero(np.append(True, of_a[1:] != of_a[:-1]))]
    n_groups = np.bincount(group_document, minlength=len(texts))
    ends = np.cumsum(n_a + n_b)
    digests = []
    for begin, end in zip((ends - n_a - n_b).tolist(), ends.tolist(), strict=True):
        joined = "".join(words[begin:end].tolist())
        digests.append(hashlib.sha256(joined[:-1].encode()).hexdigest() if joined else "")
    spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
    both = both.astype("<u8")
    return [
        *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)],
        pa.array(digests),
        pa.array([both[x:y].tobytes() for x, y in spans], pa.binary()),
        pa.array([times[x:y].tobytes() for x, y in spans], pa.binary()),
    ]


def flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in a column of binaries, one after the other, and the row of each."""
    values = [x.as_py() for x in column]
    size = np.fromiter(map(len, values), np.int64, len(values)) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(values), kind), np.repeat(np.arange(len(values)), size)


def pair_counts(rows: DataFrame) -> DataFrame:
    """How many documents hold each pair linked, and whether that is its first id's highest.

    Tasks add up before they hand on, so a pair that every document holds
    reaches the shuffle a few times per task.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, docs = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs.astype(np.int64)), pa.array(docs)], names=["pair", "docs"]
            )

        for batch in batches:
            new, found = np.unique(flat(batch.column(0), "<u8")[0], return_counts=True)
            merged, place = np.unique(np.concatenate([pairs, new]), return_inverse=True)
            # Whole numbers below 2^53: exact in doubles.
            docs = np.bincount(place, np.concatenate([docs, found]), len(merged)).astype(np.int64)
            pairs = merged
            if len(pairs) > GATHERED:
                yield handed()
                pairs, docs = pairs[:0], docs[:0]
        yield handed()

    return (
        rows.select("pairs").mapInArrow(counted, "pair long, docs long")
        .groupBy("pair").agg(F.sum("docs").alias("docs"))
    )


def with_best(counts: DataFrame, size_b: int) -> DataFrame:
    """Add ``best``: the count is the highest of the pair's first id. One row per id is compared."""
    first = F.floor(F.col("pair") / F.lit(size_b)).alias("a")
    highest = counts.groupBy(first).agg(F.max("docs").alias("most"))
    both = counts.withColumn("a", first).join(highest, "a")
    return both.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def least_common(counts: DataFrame, common: int) -> int:
    """The least power of two that at most ``common`` pairs' counts reach."""
    power = F.floor(F.log2("docs")).cast("int")
    of_power = counts.groupBy(power.alias("power")).agg(F.count("*").alias("pairs")).collect()
    held = least = 0
    for power, pairs in sorted(of_power, reverse=True):
        if held + pairs > common:
            return 2 ** (power + 1)
        held, least = held + pairs, 2**power
    return least


def scored_links(rows: DataFrame, size_b: int, common: int = COMMON) -> DataFrame:
    """Add ``n_best`` and ``count_sum`` to rows with a column ``row`` that tells them apart.

    Counts of the most frequent pairs, ``common`` at most, go to every task. They
    are those of nearly all links. The links of the other pairs, rare ones each,
    are joined with their counts and added up per row.
    """
    counts = stored(with_best(stored(pair_counts(rows), "pairs"), size_b), "best")
    least = least_common(counts, common)
    table = counts.filter(F.col("docs") >= least).orderBy("pair").toArrow()
    columns = [table.column(name).to_numpy() for name in ("pair", "docs", "best")]
    known = rows.sparkSession.sparkContext.broadcast(columns)

    def looked_up(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        names = known.value[0]
        place = np.searchsorted(names, pairs)
        place[place == len(names)] = 0
        hit = names[place] == pairs if len(names) else np.zeros(len(pairs), bool)
        return place, hit

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, docs, best = known.value
        for batch in batches:
            pairs, row = flat(batch.column("pairs"), "<u8")
            times, _ = flat(batch.column("times"), "<u4")
            place, hit = looked_up(pairs.astype(np.int64))
            place, row, times = place[hit], row[hit], times[hit].astype(np.int64)
            best_of, sum_of = (np.zeros(batch.num_rows, np.int64) for _ in range(2))
            if len(place):
                np.add.at(best_of, row, times * best[place])
                np.add.at(sum_of, row, times * docs[place])
            kept = [batch.column(name) for name in carried]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(best_of), pa.array(sum_of)],
                names=[*carried, "n_best", "count_sum"],
            )

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, row = flat(batch.column("pairs"), "<u8")
            times, _ = flat(batch.column("times"), "<u4")
            _, hit = looked_up(pairs.astype(np.int64))
            numbers = batch.column("row").take(pa.array(row[~hit]))
            yield pa.RecordBatch.from_arrays(
                [numbers, pa.array(pairs[~hit].astype(np.int64)),
                 pa.array(times[~hit].astype(np.int64))], names=["row", "pair", "times"],
            )

    carried = [name for name in rows.columns if name not in ("pairs", "times")]
    kinds = {field.name: field.dataType.simpleString() for field in rows.schema.fields}
    layout = ", ".join(f"{name} {kinds[name]}" for name in carried)
    found = rows.mapInArrow(summed, f"{layout}, n_best long, count_sum long")
    if least <= 1:
        return found
    links = rows.select("row", "pairs", "times").mapInArrow(others, "row long, pair long, times long")
    rare = links.join(counts.filter(F.col("docs") < least), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("docs")).alias("more_sum"),
    )
    return found.join(rare, "row", "left").select(
        *carried,
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )


def token_alignment(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id: str = "doc_id",
    text: str = "text",
    common: int = COMMON,
) -> DataFrame:
    """Groups, links and link counts of every document under two tokenizers.

    A null or empty text has no tokens: zeros and an empty digest; so has one
    whose tokens don't spell it, such as a text with U+2581, which the second
    tokenizer takes for a blank. Strings of special tokens are ordinary text.
    Each row is a document, repeated ones and null ids too; a very long text is
    aligned whole. An empty table gives no rows; other columns have no effect.
    """
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    rows = aligned(docs, path_a, path_b, id, text)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "aligned")
    found = scored_links(rows, size_b, common)
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
