"""Benchmark decontamination by Wu-Manber search over words.

The patterns are windows of ``width`` consecutive benchmark words; an item of fewer words, but not none,
is one shorter pattern. For each pattern length, a shift table over hashed blocks of words says
how far the search may jump from where it looks; only at a shift of nothing are the patterns in the bucket of
that suffix block (and of the window's first block) taken up, and an occurrence counts only if
their words are equal one by one.

The search runs in lanes: every document, cut into overlapping spans, is a lane, and all lanes jump at
once. Benchmark items go to the tasks in blocks of bounded size; a larger benchmark takes more passes over the
documents, each adding to the hits of the one before.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.llm.common import free_name, in_slices, map_arrow, quoted, run_folder, saved, ship_package
from cdcmart.llm.words import Words, mixed, words_of

WIDTH = 10

# Characters of benchmark text that one pass searches for: what is broadcast at once.
PASS_CHARS = 4_000_000

_TABLE_BITS = 18
_LANE = 512


class ShiftTable:
    """Search structure for patterns of ``length`` words."""

    def __init__(self, length: int, block: int = 3):
        self.length = length
        self.block = min(block, length)
        self.shifts = np.full(1 << _TABLE_BITS, length - self.block + 1, np.uint8 if length < 250 else np.int32)
        self.buckets: dict[tuple[int, int], list[tuple[bytes, list[int]]]] = defaultdict(list)

    def blocks(self, hashes: np.ndarray) -> np.ndarray:
        """Hash of the block of words that ends at each position; the first ones have none."""
        out = np.zeros(len(hashes), np.uint64)
        size = len(hashes) - self.block + 1
        if size > 0:
            found = hashes[:size].copy()
            for k in range(1, self.block):
                found = mixed(found * np.uint64(3) + hashes[k : k + size])
            out[self.block - 1 :] = found
        return out

    @staticmethod
    def slots(blocks: np.ndarray) -> np.ndarray:
        return (blocks >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def add(self, patterns: dict[bytes, list[int]], hashes: dict[bytes, np.ndarray]) -> None:
        for pattern, items in patterns.items():
            own = self.blocks(hashes[pattern])
            slots = self.slots(own)
            for end in range(self.block - 1, self.length):
                jump = self.length - 1 - end
                self.shifts[slots[end]] = min(jump, self.shifts[slots[end]])
            self.buckets[int(own[-1]), int(own[self.block - 1])].append((pattern, items))

    def occurrences(self, words: Words) -> Iterator[tuple[int, list[int]]]:
        """First word and items of every occurrence; windows never leave their document."""
        m = self.length
        if len(words.hashes) < m:
            return
        blocks = self.blocks(words.hashes)
        shifts = self.shifts[self.slots(blocks)]
        at, stop = _lanes(words.bounds, m)
        while len(at):
            jump = shifts[at].astype(np.int64)
            for last in at[jump == 0].tolist():
                first = last - m + 1
                bucket = self.buckets.get((int(blocks[last]), int(blocks[first + self.block - 1])))
                if bucket is None:
                    continue
                text = _joined(words, first, last + 1)
                for pattern, items in bucket:
                    if pattern == text:
                        yield first, items
                        break
            at = at + np.maximum(jump, 1)
            going = at < stop
            if not going.all():
                at, stop = at[going], stop[going]


def _lanes(bounds: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows' last words of each lane begin and end: documents in spans of ``_LANE`` ends."""
    first, stop = bounds[:-1] + m - 1, bounds[1:]
    fits = first < stop
    first, stop = first[fits], stop[fits]
    spans = -(-(stop - first) // _LANE)
    lane = np.repeat(np.arange(len(first)), spans)
    nth = np.arange(len(lane)) - np.repeat(np.cumsum(spans) - spans, spans)
    at = first[lane] + nth * _LANE
    return at, np.minimum(at + _LANE, stop[lane])


def _joined(words: Words, first: int, stop: int) -> bytes:
    data = words.data
    return b" ".join(
        [data[a:b].tobytes() for a, b in zip(words.starts[first:stop].tolist(), words.ends[first:stop].tolist())]
    )


class Patterns:
    """All patterns of some benchmark items, by length."""

    def __init__(self, items: list[tuple[int, bytes]], width: int = WIDTH):
        by_length: dict[int, dict[bytes, list[int]]] = defaultdict(dict)
        hashes: dict[bytes, np.ndarray] = {}
        for i, j, words in words_of([text for _, text in items]):
            for n, (begin, end) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()), i):
                length = min(width, end - begin)
                for at in range(begin, end - length + 1) if length else ():
                    pattern = _joined(words, at, at + length)
                    known = by_length[length].setdefault(pattern, [])
                    if not known or known[-1] != items[n][0]:
                        known.append(items[n][0])
                    hashes[pattern] = words.hashes[at : at + length].copy()
        self.tables = []
        for length, patterns in sorted(by_length.items()):
            table = ShiftTable(length)
            table.add(patterns, hashes)
            self.tables.append(table)

    def search(self, words: Words) -> tuple[np.ndarray, list[set[int]]]:
        """Which words are inside an occurrence, and the items found in each document."""
        hit = np.zeros(len(words.hashes), bool)
        found: list[set[int]] = [set() for _ in words.bounds[1:]]
        for table in self.tables:
            for first, items in table.occurrences(words):
                hit[first : first + table.length] = True
                found[int(np.searchsorted(words.bounds, first, side="right")) - 1].update(items)
        return hit, found


def _spans(hit: np.ndarray) -> list[int]:
    """Begin and end of every run of hits, one after the other."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).tolist()


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, pass_chars: int = PASS_CHARS) -> DataFrame:
    """Add to each row of ``docs`` (column ``text``): n_words, hit_spans (begin and end of each run of hit
    words, one after the other, counted in words) and items (sorted distinct item ids with an occurring window).

    Null or empty texts have no words and no hits; so do benchmark items of null text or null id. Rows of one
    item id are one item. An empty benchmark hits nothing. Repeated documents each get their result.
    Columns of ``docs`` stay; added names that are taken get underscores, in the order n_words, hit_spans, items.
    """
    spark = docs.sparkSession
    ship_package(spark)
    items = benchmark.where("item_id is not null and text is not null")
    items = items.select("item_id", F.col("text").cast("string")).distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-chars // pass_chars))
    names = []
    for base in ("n_words", "hit_spans", "items"):
        names.append(free_name(docs, base))
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField(names[0], T.LongType()),
            T.StructField(names[1], T.ArrayType(T.IntegerType())),
            T.StructField(names[2], T.ArrayType(T.LongType())),
        ]
    )
    folder = run_folder(spark, "leaks") if passes > 1 else ""
    out = docs
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k) if passes > 1 else items
        rows = [(r["item_id"], r["text"].encode()) for r in part.sort("item_id", "text").collect()]
        shared = spark.sparkContext.broadcast(rows)

        def step(batches, shared=shared, again=k > 0):
            patterns = Patterns(shared.value, width)
            for batch in in_slices(batches, "text"):
                texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
                before = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names] if again else None
                counts, spans, items = [], [], []
                for i, j, words in words_of(texts):
                    hit, found = patterns.search(words)
                    sizes = np.diff(words.bounds)
                    touched = np.add.reduceat(np.append(hit, False), words.bounds[:-1]) * (sizes > 0)
                    for n in range(j - i):
                        own = found[n]
                        if before:
                            own = own | set(before[2][i + n])
                        counts.append(int(sizes[n]))
                        items.append(sorted(own))
                        if not own:
                            spans.append([])
                            continue
                        part = hit[words.bounds[n] : words.bounds[n + 1]] if touched[n] else np.zeros(sizes[n], bool)
                        if before:
                            for a, b in zip(before[1][i + n][::2], before[1][i + n][1::2]):
                                part[a:b] = True
                        spans.append(_spans(part))
                kept = [c for c, n in zip(batch.columns, batch.schema.names) if not (again and n in names)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.int64()))],
                    schema.names,
                )

        out = map_arrow(out, step, schema)
        if passes > 1:
            out = saved(out, folder, f"pass-{k}")
    return out


def n_hit(spans: str) -> F.Column:
    """Words inside the spans: the sum of their ends less that of their begins."""
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x).cast("long"))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, b: a + b)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document. Null texts have no words; rows
    with a null doc_id and repeated rows each get their result; other columns are not read."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark)
    listed = F.concat_ws(",", F.array_sort(F.col("items").cast("array<string>")))
    return found.select(
        "doc_id",
        "n_words",
        n_hit("hit_spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with their own columns."""
    found = find_leaks(docs, benchmark)
    return found.where(F.size(found.columns[-2]) == 0).select(*quoted(docs.columns))
