"""Fuzzy line deduplication by MinHash over character shingles.

A line's shingles are hashed once; each hash falls in one of the signature's
bins, which keeps its smallest. Bands of bins deal the distinct lines into
buckets. In a bucket the exact Jaccard similarity of the shingle sets decides,
and union-find spares the pairs that are joined already. Links of all buckets
go through distributed union-find, and of each component of lines one
occurrence, the first, stays.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.llm.components import components
from barograph.llm.tables import split_groups, stored

#: Characters of a shingle, and least similarity of two lines that are one.
SHINGLE = 8
SIMILARITY = 0.8
#: Bands of so many bins each: two lines at the least similarity share a bucket with
#: probability 1 - (1 - 0.8**5)**14 = 0.996, lines alike in a tenth with 1.4e-4.
BANDS, ROWS = 14, 5
#: Lines of fewer characters stay where the caller gives no other number; at one, all lines
#: count but blank ones. Those shorter than a shingle are compared as a whole.
LEAST = SHINGLE
#: Distinct lines of a bucket that meet in one task.
TOGETHER = 2_000

#: Links that a task hands on together.
HANDED = 10_000
#: Shared shingles times lines up to which a bucket's pairs are counted by one product.
CELLS = 1 << 22
#: Of the others, buckets of more lines look for pairs by rare shingles; smaller ones compare all.
FEW = 64
#: Bits of the filter that spares most unwanted lines the way to the join; fixed size.
FILTER_BITS = 1 << 26
#: Low bits of a band's sort key that the line's digest takes; the bucket has the others.
LINE_BITS = 20
#: Columns of a line's digest.
DIGEST = "line long, more long"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint32(2**32 - 1)


def considered(line: str, least: int = LEAST) -> bool:
    """Whether a line has so many characters without the blanks around it."""
    return len(line.strip()) >= least


def line_digest(line: str) -> bytes:
    """The 128-bit digest of a line without the blanks around it."""
    return xxhash.xxh3_128_digest(line.strip().encode("utf-8", "surrogatepass"))


def line_keys(digests: bytes | bytearray) -> np.ndarray:
    """Digests, one after the other, as rows of two signed 64-bit numbers: ``line`` and ``more``.

    Both together stand for a line. Candidates are looked for by the first alone:
    lines that share it are told apart by their texts.
    """
    return np.frombuffer(digests, "<i8").reshape(-1, 2)


def _keys_of(lines: list[str]) -> np.ndarray:
    return line_keys(b"".join(map(line_digest, lines)))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def band_keys(lines: list[str]) -> np.ndarray:
    """A row of ``BANDS`` signed 64-bit keys per line.

    Here a character counts by its lowest byte, so that eight of them are one
    word of memory. Rare characters may look alike: that adds candidates, which
    the exact comparison tells apart, and loses none.
    """
    bins = BANDS * ROWS
    raw = [line.strip().ljust(SHINGLE, "\0") for line in lines]
    size = np.array([len(x) for x in raw], np.int64)
    codes = np.frombuffer("".join(raw).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint8)
    count = len(codes) - SHINGLE + 1
    words = np.empty(count, "<u8")
    for k in range(SHINGLE):
        part = np.frombuffer(codes.data, "<u8", (len(codes) - k) // SHINGLE, k)
        words[k::SHINGLE] = part
    words *= _ODD
    words ^= words >> np.uint64(29)
    words *= np.uint64(0xBF58476D1CE4E5B9)
    # A word that goes over the end of its line is no shingle.
    inside = np.ones(count, bool)
    ends = np.cumsum(size)[:-1]
    for k in range(1, SHINGLE):
        inside[ends - k] = False
    cell = ((words >> np.uint64(40)) * np.uint64(bins) >> np.uint64(24)).astype(np.int64)
    cell += np.repeat(np.arange(len(lines)) * bins, size)[:count]
    signature = np.full(len(lines) * bins, _EMPTY)
    np.minimum.at(signature, cell[inside], words[inside].astype(np.uint32))
    signature = signature.reshape(len(lines), bins)
    # An empty bin takes over another one's value, at a distance that its place decides, so
    # that lines with the same shingles fill it alike.
    # Few lines need many turns, so only those still with empty bins take the next.
    sparse = np.flatnonzero((signature == _EMPTY).any(axis=1))
    for turn in range(1, 64):
        if not len(sparse):
            break
        short = signature[sparse]
        moved = short[:, (np.arange(bins) * 31 + turn * 17 + turn * turn) % bins]
        short = np.where((short == _EMPTY) & (moved != _EMPTY), moved ^ np.uint32(turn), short)
        signature[sparse] = short
        sparse = sparse[(short == _EMPTY).any(axis=1)]
    groups = signature.reshape(len(lines), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD, groups.shape[:2])
    for k in range(ROWS):
        keys = _mixed(keys ^ groups[:, :, k]) + _ODD
    return keys.view(np.int64)


def _exploded(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """Occurrences of considered lines: doc_id, text_hash, position, line and more (digest)."""
    own = docs.select(
        F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("_t")
    ).filter(F.col("_t").isNotNull())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, position, digests = [], [], bytearray()
            for k, body in enumerate(batch["_t"]):
                for at, x in enumerate(map(str.strip, body.as_py().split("\n"))):
                    if len(x) >= least:
                        of.append(k)
                        position.append(at)
                        digests += line_digest(x)
            rows, keys = pa.array(of, pa.int64()), line_keys(digests)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(rows),
                    batch["text_hash"].take(rows),
                    pa.array(position, pa.int32()),
                    *map(pa.array, keys.T.copy()),
                ],
                ["doc_id", "text_hash", "position", "line", "more"],
            )

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(cut, f"doc_id {kind}, text_hash long, position int, {DIGEST}")


def _portions(texts: pa.Array, least: int, most: int = 2_000_000) -> Iterator[list[str]]:
    """Distinct considered lines of a shingle or more, about ``most`` characters at a time."""
    least = max(least, SHINGLE)
    lines: dict[str, None] = {}
    size = 0
    for body in texts:
        for x in (body.as_py() or "").split("\n"):
            if len(x := x.strip()) >= least and x not in lines:
                lines[x] = None
                size += len(x)
                if size >= most:
                    yield list(lines)
                    lines, size = {}, 0
    if lines:
        yield list(lines)


def _buckets(docs: DataFrame, text: str, least: int) -> DataFrame:
    """Rows (sort key, line) of the considered lines.

    The key is 44 bits of the band's and 20 of the line's, so that one number
    sorts by both. Bands that share their bits share a bucket: that adds
    candidates, which the exact comparison tells apart, and loses none.
    """
    low = np.int64((1 << LINE_BITS) - 1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lines in _portions(batch.column(0), least):
                own = np.repeat(_keys_of(lines)[:, 0], BANDS)
                keys = band_keys(lines).ravel() & ~low | own & low
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own)], ["key", "line"])

    return docs.select(text).mapInArrow(deal, "key long, line long")


def _shared_buckets(docs: DataFrame, text: str, least: int) -> DataFrame:
    """Rows (band, line) of the buckets with two lines or more.

    The rows pass in order of their key, one number that Spark sorts by its
    digits, so no bucket is held. Equal rows are given once; seldom twice, where
    lines of a bucket share their part of the key and a batch ends among them.
    """
    rows = _buckets(docs, text, least)
    ordered = rows.repartition(F.shiftright("key", LINE_BITS)).sortWithinPartitions("key")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 2), np.int64)  # the last row, and whether it was given out
        given = False
        for batch in batches:
            rows = np.stack([x.to_numpy() for x in batch.columns], axis=1)
            if ((rows[1:, 0] == rows[:-1, 0]) & (rows[1:, 1] != rows[:-1, 1])).any():
                rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
            rows = np.concatenate([held, rows])
            if not len(rows):
                continue
            rows = rows[np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)]]
            band = rows[:, 0] >> LINE_BITS
            same = band[1:] == band[:-1]
            out = np.r_[False, same] | np.r_[same, False]
            last = bool(out[-1]) or given and len(rows) == 1
            if given:
                out[0] = False
            held, given = rows[-1:], last
            yield pa.RecordBatch.from_arrays(
                [pa.array(band[out]), pa.array(rows[out, 1])], ["band", "line"]
            )

    return ordered.mapInArrow(keep, "band long, line long")


def _filter_words(wanted: DataFrame) -> np.ndarray:
    """A bitmap of the wanted lines' digests, of fixed size."""
    bit = F.pmod(F.col("line"), F.lit(FILTER_BITS))
    words = wanted.groupBy((bit / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(line, {FILTER_BITS}) % 64 AS int))")).alias("bits")
    )
    found = words.toPandas()
    bitmap = np.zeros(FILTER_BITS // 64, np.uint64)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return bitmap


def _bodies(docs: DataFrame, wanted: DataFrame, text: str, least: int) -> DataFrame:
    """line, more and body of the lines whose first number is wanted."""
    bitmap = docs.sparkSession.sparkContext.broadcast(_filter_words(wanted))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lines in _portions(batch.column(0), least):
                own = _keys_of(lines)
                bit = own[:, 0] % FILTER_BITS
                word = bitmap.value[bit >> 6] >> (bit & 63).astype(np.uint64)
                hit = np.flatnonzero(word & np.uint64(1))
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, own[hit].T.copy()), pa.array([lines[k] for k in hit], pa.string())],
                    ["line", "more", "body"],
                )

    rows = docs.select(text).mapInArrow(cut, f"{DIGEST}, body string")
    # One copy of each wanted line: equal digests of 128 bits have equal bodies.
    once = rows.groupBy("line", "more").agg(F.min("body").alias("body"))
    return once.join(wanted, "line", "left_semi")


def _padded(lines: list[str]) -> list[str]:
    return [line.strip().ljust(SHINGLE, "\0") for line in lines]


def _words(raw: list[str]) -> np.ndarray | None:
    """The eight characters from each place of the joined lines on, as one number each.

    Where the lines together have no more than 256 characters, each character
    gets a byte of its own, so that equal numbers are equal shingles. None for
    others.
    """
    codes = np.frombuffer("".join(raw).encode("utf-32-le", "surrogatepass"), "<u4")
    if codes.max() > 255:
        alphabet, codes = np.unique(codes, return_inverse=True)
        if len(alphabet) > 256:
            return None
    codes = codes.astype(np.uint8)
    words = np.empty(len(codes) - SHINGLE + 1, "<u8")
    for k in range(SHINGLE):
        words[k::SHINGLE] = np.frombuffer(codes.data, "<u8", (len(codes) - k) // SHINGLE, k)
    return words


def shingle_sets(lines: list[str]) -> list[set]:
    """The character shingles of each line; a line shorter than a shingle is one.

    The sets are exact: of numbers where ``_words`` has them, else of strings.
    """
    raw = _padded(lines)
    words = _words(raw)
    if words is None:
        return [{x[k : k + SHINGLE] for k in range(len(x) - SHINGLE + 1)} for x in raw]
    sets, begin = [], 0
    for x in raw:
        sets.append(set(words[begin : begin + len(x) - SHINGLE + 1].tolist()))
        begin += len(x)
    return sets


def _matched_at_once(lines: list[str], least: float) -> np.ndarray | None:
    """``matched`` by a product of the lines' shingle indicators; None where it would be large.

    A shingle that stands in one place only is shared by no pair: it counts in
    its line's size and has no column.
    """
    raw = _padded(lines)
    words = _words(raw)
    if words is None:
        return None
    count = len(raw)
    size = np.array([len(x) for x in raw])
    line = np.repeat(np.arange(count), size)[: len(words)]
    # A number that goes over the end of its line is no shingle.
    inside = np.ones(len(words), bool)
    ends = np.cumsum(size)[:-1]
    for k in range(1, SHINGLE):
        inside[ends - k] = False
    line = line[inside]
    _, kind, times = np.unique(words[inside], return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    often = times[kind] > 1
    if count * (column[-1] + 1) > CELLS or count * count > CELLS:
        return None
    held = np.zeros((count, column[-1] + 1), np.float32)
    held[line[often], column[kind[often]]] = 1
    # Counts are whole numbers that a float holds exactly.
    sizes = held.sum(axis=1, dtype=np.float64) + np.bincount(line[~often], minlength=count)
    shared = (held @ held.T).astype(np.float64)
    alike = shared >= least * (sizes[:, None] + sizes - shared) - 1e-9
    np.fill_diagonal(alike, True)
    root = np.arange(count)
    while True:
        first = np.where(alike, root, count).min(axis=1)
        if (first == root).all():
            return root
        root = first


def _pair_matched(lines: list[str], least: float) -> np.ndarray | None:
    """``matched`` of two lines by their sorted shingles; None where these are no numbers."""
    raw = _padded(lines)
    words = _words(raw)
    if words is None:
        return None
    begin = len(raw[0])
    own = [words[: begin - SHINGLE + 1], words[begin:]]
    few, many, both = (
        1 + np.count_nonzero(x[1:] != x[:-1]) for x in map(np.sort, (*own, np.concatenate(own)))
    )
    return np.array([0, 0 if few + many - both >= least * both - 1e-9 else 1])


def matched(lines: list[str], least: float = SIMILARITY) -> np.ndarray:
    """For each line of a bucket the first one of its component, by exact Jaccard similarity.

    Most buckets take all their pairs at once. In a large one the lines'
    shingles are ordered from rare to common. Two lines alike enough share one
    of their rarest shingles, of which each looks at as many as it can miss and
    one more; no other pair needs a comparison.
    """
    at_once = _pair_matched if len(lines) == 2 else _matched_at_once
    if len(lines) > 1 and (found := at_once(lines, least)) is not None:
        return found
    sets = shingle_sets(lines)
    root = list(range(len(lines)))
    members = {k: [k] for k in root}

    def compare(k: int, others) -> None:
        own = sets[k]
        for j in others:
            if root[j] == root[k]:
                continue
            # Sets of too unlike sizes share too little, whatever they hold.
            few, many = sorted((len(own), len(sets[j])))
            if few < least * many - 1e-9:
                continue
            shared = len(own & sets[j])
            if shared >= least * (len(own) + len(sets[j]) - shared) - 1e-9:
                low, high = sorted((root[j], root[k]))
                for x in members[high]:
                    root[x] = low
                members[low] += members.pop(high)

    if len(lines) <= FEW:
        for k in range(len(lines)):
            compare(k, range(k))
        return np.array(root)
    times = Counter(chain.from_iterable(sets))
    rank = {s: n for n, s in enumerate(sorted(times, key=lambda s: (times[s], s)))}
    # Lines by shingle and component, so that those joined already are passed over together.
    seen: dict[int, dict[int, list[int]]] = {}
    for k, own in enumerate(sets):
        rarest = sorted(map(rank.__getitem__, own))
        rarest = rarest[: len(own) - ceil(least * len(own) - 1e-9) + 1]
        # Near copies of one line are mostly alike to the one before; if that leaves a
        # single component so far, there is no pair left to look for.
        compare(k, range(max(0, k - 1), k))
        if len(members) - (len(lines) - k - 1) > 1:
            others: set[int] = set()
            for s in rarest:
                for first, own_lines in seen.get(s, {}).items():
                    if root[first] != root[k]:
                        others.update(own_lines)
            compare(k, sorted(others))
        for s in rarest:
            seen.setdefault(s, {}).setdefault(root[k], []).append(k)
    return np.array(root)


def line_links(
    docs: DataFrame, text: str = "text", together: int = TOGETHER, least: int = LEAST
) -> DataFrame:
    """Links (a, b) that join all lines found alike, by numbers of the lines."""
    return _linked(docs, text, together, least)[0]


def _linked(docs: DataFrame, text: str, together: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between numbered lines, and these lines: node (number), line, more, body."""
    dealt = stored(_shared_buckets(docs, text, least), "line-buckets")
    sizes = dealt.groupBy("band").agg(
        F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("line")).alias("members"),
        F.sum(F.pmod(F.xxhash64("line", F.lit(3)), F.lit(1 << 31))).alias("sum"),
    )
    # Buckets with the same lines need one look.
    shared = sizes.groupBy("size", "members", "sum").agg(F.min("band").alias("band"))
    found = stored(dealt.join(shared.select("band", "size"), "band"), "line-looks")
    wanted = found.select("line").distinct()
    # A number of one word for each distinct line: links of numbers aggregate without sorting.
    bodies = stored(
        _bodies(docs, wanted, text, least).withColumn("node", F.monotonically_increasing_id()),
        "line-bodies",
    )
    parts = split_groups(found.join(bodies, "line"), "line", "size", together)
    own = ["band", "part_a", "part_b"]
    ordered = (
        parts.select("band", "part_a", "part_b", "node", "body")
        .repartition(*own)
        .sortWithinPartitions(*own, "node")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[np.ndarray] = []
        right: list[np.ndarray] = []
        waiting = 0

        def handed() -> pa.RecordBatch:
            none = np.zeros(0, np.int64)
            sides = [pa.array(np.concatenate([none, *x])) for x in (left, right)]
            return pa.RecordBatch.from_arrays(sides, ["a", "b"])

        # Links of many buckets in one batch: most buckets have two lines.
        for _, lines, texts in _groups(batches):
            root = matched(texts)
            moved = np.flatnonzero(root != np.arange(len(root)))
            own = np.array(lines, np.int64)
            left.append(own[moved])
            right.append(own[root[moved]])
            waiting += len(moved)
            if waiting >= HANDED:
                yield handed()
                left, right, waiting = [], [], 0
        yield handed()

    return ordered.mapInArrow(verify, "a long, b long"), bodies


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[int], list[str]]]:
    now, lines, texts = None, [], []
    for batch in batches:
        columns = [x.to_pylist() for x in batch.columns]
        for band, a, b, line, body in zip(*columns, strict=True):
            if (band, a, b) != now:
                if lines:
                    yield now, lines, texts
                now, lines, texts = (band, a, b), [], []
            lines.append(line)
            texts.append(body)
    if lines:
        yield now, lines, texts


def removed_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST
) -> DataFrame:
    """Per document with lines to remove: doc_id, text_hash, positions (from 0)."""
    if least < 1:
        raise ValueError("blank lines always stay: least is one or more")
    occurrences = stored(_exploded(docs, key, text, least), "line-occurrences")
    place = F.struct("doc_id", "position", "text_hash")
    lines = occurrences.groupBy("line", "more").agg(
        F.count("*").alias("times"), F.min(place).alias("first")
    )
    links, bodies = _linked(docs, text, TOGETHER, least)
    known = bodies.select("node", "line", "more")
    root = known.toDF("root", "root_line", "root_more")
    found = components(links).join(known, "node").join(root, "root").drop("node", "root")
    # A line without links is the root of itself; if it stands once, nothing of it goes.
    own = [F.coalesce(f"root_{x}", x).alias(f"root_{x}") for x in ("line", "more")]
    rooted = lines.join(found, ["line", "more"], "left").filter("times > 1 OR root_line IS NOT NULL")
    rooted = rooted.select("line", "more", "times", "first", *own)
    by_root = ["root_line", "root_more"]
    whole = rooted.groupBy(*by_root).agg(F.sum("times").alias("times"), F.min("first").alias("keep"))
    affected = rooted.select("line", "more", *by_root).join(
        whole.filter(F.col("times") > 1).select(*by_root, "keep"), by_root
    )
    gone = occurrences.join(affected.select("line", "more", "keep"), ["line", "more"])
    gone = gone.filter(~place.eqNullSafe(F.col("keep")))
    return gone.groupBy("doc_id", "text_hash").agg(F.collect_set("position").alias("positions"))


def deduplicated(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    count: str | None = None,
    least: int = LEAST,
) -> DataFrame:
    """The rows with one line of each component of alike lines, all other columns as they are.

    Lines are cut at line feeds and compared without the blanks around them.
    The occurrence that stays is the one with the smallest id (null first), then
    position. Blank lines stay, and lines of fewer than ``least`` characters; the
    registered query and the pipeline leave none. Lines shorter than a shingle
    are alike when they are equal. A document may be left with an empty text.
    ``count`` names a column to add: the lines removed. Null texts stay null, empty ones empty. Rows with equal id and text count as
    one document: what stays in one stays in each, what goes goes in each. An
    empty table gives no rows.
    """
    if count in docs.columns:
        raise ValueError(f"the rows have a column {count} already")
    # Names that the rows don't have, whatever theirs are.
    free = "_" * (1 + max(map(len, docs.columns)))
    gone = removed_lines(docs, key, text, least).select(
        F.col("doc_id").alias(f"{free}id"),
        F.col("text_hash").alias(f"{free}hash"),
        F.col("positions").alias(f"{free}gone"),
    )
    same = docs[key].eqNullSafe(gone[f"{free}id"]) & (F.xxhash64(docs[text]) == gone[f"{free}hash"])
    rows = docs.join(gone, same, "left").drop(f"{free}id", f"{free}hash")
    place = docs.columns.index(text)
    schema = T.StructType(
        [*docs.schema.fields, *([T.StructField(count, T.LongType())] if count else [])]
    )

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, counts = [], []
            for body, positions in zip(batch.column(place), batch.columns[-1], strict=True):
                body, out = body.as_py(), set(positions.as_py() or ())
                if out:
                    lines = enumerate(body.split("\n"))
                    body = "\n".join(x for at, x in lines if at not in out)
                bodies.append(body)
                counts.append(len(out))
            columns = batch.columns[:-1]
            columns[place] = pa.array(bodies, batch.schema.field(place).type)
            columns += [pa.array(counts, pa.int64())] if count else []
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(rebuild, schema)
