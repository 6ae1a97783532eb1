"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds blocks of documents of about the same size. A block is a matrix of bits, one row for every slot of
a hash table and one column for every document: a term sets ``PROBES`` slots of its document, once for each of
``LEVELS`` that its number of occurrences reaches. The rows of a term ANDed give the documents that may hold it so
often: some too many, never one too few. A term's score grows with its occurrences, so the slices of its levels,
weighted by what each level adds at most in a document of that length, sum to an upper bound of the document's score.

A search reads the slices twice. First the documents with the highest bounds are scored exactly from their texts: the
``k``-th best of them is a score that a result has to beat. Then every document whose bound is not provably below
that is scored exactly. Nothing else decides the result, so it does not depend on the signatures.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.llm.common import in_slices, map_arrow, run_folder, saved, ship_package
from cdcmart.llm.words import Words, mixed, words_of

# Occurrences that set a term's bits anew, slots for each of a document's bits, and bits set by each.
LEVELS = (1, 2, 3, 4, 6, 10)
SLOTS = 14
PROBES = 5

# Documents of a block, cells of its matrix, and how much larger its largest document may be than its smallest.
BLOCK = 512
_CELLS = 1 << 25
_SPREAD = 1.25

# Distinct terms of all items that one pass searches for: what is broadcast at once. An item is never split.
PASS_TERMS = 200_000
_AT_ONCE = 4096

TOP = 10

# The terms, and the numbers of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
_LEVEL_SALTS = np.array(LEVELS, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ONE = 1_000_000_000

_NULL = np.iinfo(np.int64).min  # stands for a null key: nulls come first among equal scores


def terms_of(text: Column) -> Column:
    """Terms of a text, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(TERM), F.lit(0))


def term_counts(text: bytes) -> Counter[bytes]:
    """The same for one text in UTF-8, with the number of occurrences."""
    return Counter(_TERM_BYTES.findall(text.lower()))


def length_factor(n: np.ndarray | int, documents: int, terms: int) -> np.ndarray | int:
    """How much a document of ``n`` terms is marked down against the mean of the corpus."""
    return 100 - 75 + (75 * n * documents) // terms


def share(tf: np.ndarray | int, m: np.ndarray | int) -> np.ndarray | int:
    """What ``tf`` occurrences in a document of factor ``m`` are worth, before the term's weight."""
    return (_ONE * tf) // (1000 * tf + 8 * m)


def _slots(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    """The slots of each term at one level: an array of ``PROBES`` rows."""
    mix = mixed(hashes + _LEVEL_SALTS[level])
    step = (mix & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    tries = (mix >> np.uint64(32)) + np.arange(PROBES, dtype=np.uint64)[:, None] * step
    return (tries % np.uint64(size)).astype(np.int64)


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each document by hash: document, hash and occurrences, ordered by document."""
    sizes = np.diff(words.bounds)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    by_hash = np.argsort(words.hashes, kind="stable")
    order = by_hash[np.argsort(doc[by_hash], kind="stable")]
    doc, hashes = doc[order], words.hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    heads = np.flatnonzero(new)
    return doc[heads], hashes[heads], np.diff(np.append(heads, len(doc)))


def _blocks(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int, bytes]]:
    """Blocks of a run of documents: their numbers, sizes, most occurrences of a term, slots and slices."""
    doc, hashes, tf = _distinct(words)
    count = len(words.bounds) - 1
    # Bits of each document, before its probes.
    bits = sum(np.bincount(doc[tf >= least], minlength=count) for least in LEVELS)
    pairs = np.searchsorted(doc, np.arange(count + 1))
    most = np.zeros(count, np.int64)
    np.maximum.at(most, doc, tf)
    order = np.argsort(bits, kind="stable")
    order = order[bits[order] > 0]
    begin = 0
    while begin < len(order):
        end = begin + int(np.searchsorted(bits[order[begin:]], _SPREAD * bits[order[begin]] + 16, side="right"))
        end = min(end, begin + BLOCK, begin + max(1, _CELLS // (SLOTS * int(bits[order[end - 1]]))))
        some = order[begin:end]
        size = SLOTS * int(bits[some[-1]])
        matrix = np.zeros((size, len(some)), bool)
        sizes = pairs[some + 1] - pairs[some]
        column = np.repeat(np.arange(len(some)), sizes)
        at = np.arange(len(column)) + np.repeat(pairs[some] - (np.cumsum(sizes) - sizes), sizes)
        for level, least in enumerate(LEVELS):
            enough = tf[at] >= least
            for slot in _slots(hashes[at[enough]], level, size):
                matrix[slot, column[enough]] = True
        yield some, np.diff(words.bounds)[some], most[some], size, np.packbits(matrix, axis=1).tobytes()
        begin = end


_INDEX = "keys array<long>, n array<long>, most array<long>, slots int, bits binary, hashes array<long>, counts array<long>"


def build_index(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the signatures of ``docs`` below ``folder``, and beside them how many documents hold each term (by a
    64-bit hash). ``key`` is an integer. Documents without a term are left out. The text is cut into blocks where Spark
    hands it over; a task holds one block at a time."""
    ship_package(docs.sparkSession)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1, limit=4 << 20):
            keys, texts = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()
            for i, j, words in words_of(texts, limit=4 << 20):
                doc, hashes, _ = _distinct(words)
                holders = np.unique(hashes, return_counts=True)
                rows = []
                for some, n, most, size, bits in _blocks(words):
                    first = not rows
                    rows.append(
                        [keys.take(pa.array(i + some)).to_pylist(), n.tolist(), most.tolist(), size, bits,
                         holders[0].view(np.int64) if first else [], holders[1] if first else []]
                    )
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(column), kind) for column, kind in zip(zip(*rows), _INDEX_TYPES)],
                        [f"c{k}" for k in range(len(_INDEX_TYPES))],
                    )

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    return saved(map_arrow(rows, step, T._parse_datatype_string(_INDEX)), folder, "index")


_LONGS = pa.list_(pa.int64())
_INDEX_TYPES = (_LONGS, _LONGS, _LONGS, pa.int32(), pa.binary(), _LONGS, _LONGS)


def corpus_size(index: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all terms with repeats."""
    size = index.agg(
        F.sum(F.size("n")).alias("documents"), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)).alias("terms")
    ).first()
    return size["documents"] or 0, size["terms"] or 0


def _hashed(terms: DataFrame) -> DataFrame:
    """Add to rows (term) the hash that the index knows it by."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 0):
            hashes = [np.zeros(0, np.uint64)]
            for _, _, words in words_of(batch.column(0).cast(pa.binary()).to_pylist()):
                hashes.append(words.hashes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(hashes).view(np.int64))], ["c0", "c1"])

    return map_arrow(terms, step, T._parse_datatype_string("term string, hash long"))


def weighted_terms(items: DataFrame, index: DataFrame, documents: int, folder: str, item: str, text: str) -> DataFrame:
    """Write (item, term, hash, weight) of every term that an item and a document hold: its weight in the corpus times
    its occurrences in the item. Repeated rows of one item count once; different texts of one item are one text."""
    rows = items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").alias("text"))
    wanted = (
        rows.where("text is not null").distinct()
        .select("item", F.explode(terms_of(F.col("text"))).alias("term"))
        .groupBy("item", "term").agg(F.count("*").alias("times"))
    )
    wanted = saved(wanted, folder, "wanted")
    known = saved(_hashed(wanted.select("term").distinct()), folder, "terms")
    held = index.select(F.explode(F.arrays_zip("hashes", "counts")).alias("x")).select("x.hashes", "x.counts")
    df = (
        known.join(held, known["hash"] == held["hashes"])
        .groupBy("term", "hash").agg(F.sum("counts").alias("df"))
    )
    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    return saved(
        wanted.join(df.withColumn("weight", weight).where("weight > 0"), "term")
        .select("item", "term", "hash", (F.col("times") * F.col("weight")).alias("weight")),
        folder, "weights",
    )


class Wanted:
    """The terms of one pass: items are numbers from 0, their terms stand side by side."""

    def __init__(self, items: list[tuple[list[int], list[int]]]):
        self.chunks: list[tuple[int, list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]]] = []
        begin = 0
        while begin < len(items):
            end, size = begin + 1, len(items[begin][0])
            while end < len(items) and size + len(items[end][0]) <= _AT_ONCE:
                size += len(items[end][0])
                end += 1
            some = items[begin:end]
            hashes = np.array([h for own, _ in some for h in own], np.int64).view(np.uint64)
            weights = np.array([w for _, own in some for w in own], np.int64)
            starts = np.cumsum([0, *(len(own) for own, _ in some[:-1])])
            # One item of more terms is summed up in parts.
            parts = []
            for at in range(0, max(1, len(hashes)), _AT_ONCE):
                distinct, row = np.unique(hashes[at : at + _AT_ONCE], return_inverse=True)
                parts.append((distinct, row, weights[at : at + _AT_ONCE], starts if len(some) > 1 else np.zeros(1, np.int64)))
            self.chunks.append((begin, parts))
            begin = end
        self.size = len(items)

    def bounds(self, block: dict, documents: int, terms: int) -> Iterator[tuple[int, np.ndarray]]:
        """Upper bounds of one block's documents, for some items after the other: number of the first, and an
        array of items by documents."""
        n, most, size = np.array(block["n"]), np.array(block["most"]), block["slots"]
        slices = np.frombuffer(block["bits"], np.uint8).reshape(size, -(-len(n) // 8))
        m = length_factor(n, documents, terms)
        last = np.zeros(len(n), np.int64)
        gains = []
        for level in range(len(LEVELS)):
            cap = np.minimum(most, LEVELS[level + 1] - 1) if level + 1 < len(LEVELS) else most
            worth = np.maximum(share(cap, m), last)
            gains.append(worth - last)
            last = worth
        for begin, parts in self.chunks:
            total = 0
            for distinct, row, weights, starts in parts:
                worth = np.zeros((len(distinct), len(n)), np.int64)
                present = None
                for level, gain in enumerate(gains):
                    if not gain.any():
                        continue
                    slots = _slots(distinct, level, size)
                    found = slices[slots[0]]
                    for slot in slots[1:]:
                        found = found & slices[slot]
                    # What a term does not reach at a lower level it does not reach at this one.
                    present = found if present is None else found & present
                    worth += gain * np.unpackbits(present, axis=1, count=len(n))
                total = total + np.add.reduceat(worth[row] * weights[:, None], starts, axis=0)
            yield begin, total


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray]]:
    names = ("keys", "n", "most", "slots", "bits")
    for batch in batches:
        for r in range(batch.num_rows):
            block = {name: batch.column(k)[r].as_py() for k, name in enumerate(names)}
            yield block, np.array([_NULL if x is None else x for x in block["keys"]], np.int64)


def _found(item: np.ndarray, key: np.ndarray, *more: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(item, pa.int32()), pa.array(key, pa.int64(), mask=key == _NULL), *(pa.array(x, pa.int64()) for x in more)]
    return pa.RecordBatch.from_arrays(columns, [f"c{k}" for k in range(len(columns))])


def _highest(wanted: Callable[[], Wanted], k: int, documents: int, terms: int) -> Callable:
    """A step that gives, for each item, the ``k`` documents of a task with the highest bounds."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = wanted()
        cut = np.zeros(search.size, np.int64)
        item, key, bound = (np.zeros(0, np.int64) for _ in range(3))
        for block, keys in _blocks_of(batches):
            more = [(item, key, bound)]
            for begin, total in search.bounds(block, documents, terms):
                row, column = np.nonzero((total > 0) & (total >= cut[begin : begin + len(total), None]))
                more.append((row + begin, keys[column], total[row, column]))
            item, key, bound = (np.concatenate(part) for part in zip(*more))
            order = np.lexsort((key, -bound, item))
            item, key, bound = item[order], key[order], bound[order]
            rank = np.arange(len(item)) - np.searchsorted(item, item)
            kept = rank < k
            item, key, bound, rank = item[kept], key[kept], bound[kept], rank[kept]
            cut[item[rank == k - 1]] = bound[rank == k - 1]
        yield _found(item, key, bound)

    return step


def _not_excluded(wanted: Callable[[], Wanted], least: Callable[[], tuple], documents: int, terms: int) -> Callable:
    """A step that gives all documents whose bound does not exclude them."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, (score, last) = wanted(), least()
        for block, keys in _blocks_of(batches):
            for begin, total in search.bounds(block, documents, terms):
                own, end = score[begin : begin + len(total), None], last[begin : begin + len(total), None]
                # With the score of the k-th best a document has to come before it by its key.
                row, column = np.nonzero((total > own) | ((total == own) & (total > 0) & (keys <= end)))
                if len(row):
                    yield _found(row + begin, keys[column])

    return step


def _scored(docs: DataFrame, picked: DataFrame, terms: Callable[[], list], documents: int, total: int) -> DataFrame:
    """Exact scores (item, key, score) of the documents that ``picked`` names, for the items it names with each."""
    # A key is picked once for an item at most, so a list is no longer than the items of a pass.
    listed = picked.groupBy("key").agg(F.collect_set("item").alias("items"))
    rows = docs.join(listed, docs["key"].eqNullSafe(listed["key"])).select(docs["key"], "text", "items")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = [dict(own) for own in terms()]
        for batch in in_slices(batches, 1):
            out = [], [], []
            texts, items = batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()
            for key, text, own in zip(batch.column(0).to_pylist(), texts, items):
                counts = term_counts(text or b"")
                n = counts.total()
                m = length_factor(n, documents, total)
                for item in own if n else ():
                    score = sum(w * share(counts[t], m) for t, w in wanted[item].items() if t in counts)
                    if score > 0:
                        for column, value in zip(out, (item, key, score)):
                            column.append(value)
            types = (pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["c0", "c1", "c2"])

    return map_arrow(rows, step, T._parse_datatype_string("item int, key long, score long"))


def _best(rows: DataFrame, measure: str, k: int) -> DataFrame:
    """The ``k`` best rows of each item with their rank; Spark drops others before they are shuffled."""
    order = Window.partitionBy("item").orderBy(F.desc(measure), F.asc_nulls_first("key"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    pass_terms: int = PASS_TERMS,
) -> DataFrame:
    """The ``k`` best documents of every item: item, rank (from 1), key and score, as columns named ``item``, rank,
    ``key`` and score.

    Every row of ``docs`` is a document of its own, also if ids or texts repeat; equal scores are ordered by ascending
    key, nulls first. Documents and items without a term, null texts among them, have no rank. Rows of one item id are
    one item whose terms are those of its distinct texts; a null id is an id. Empty tables give none. Other
    columns are not read. ``key`` is an integer; ``item`` may have any type that can be grouped.
    """
    spark = docs.sparkSession
    folder = run_folder(spark, "search")
    corpus = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    index = build_index(corpus, folder, "key", "text")
    documents, total = corpus_size(index)
    weights = weighted_terms(items, index, documents, folder, item, item_text)
    slices = index.select("keys", "n", "most", "slots", "bits")

    results = None
    for number, part in enumerate(_passes(weights, pass_terms)):
        own = part.groupBy("item").agg(F.collect_list(F.struct("term", "hash", "weight")).alias("terms")).collect()
        spark_items = spark.createDataFrame(
            [(i, r["item"]) for i, r in enumerate(own)],
            T.StructType([T.StructField("item", T.IntegerType()), T.StructField("id", part.schema["item"].dataType)]),
        )
        hashed = spark.sparkContext.broadcast([([t["hash"] for t in r["terms"]], [t["weight"] for t in r["terms"]]) for r in own])
        plain = spark.sparkContext.broadcast([[(t["term"].encode(), t["weight"]) for t in r["terms"]] for r in own])

        bounded = map_arrow(
            slices, _highest(lambda h=hashed: Wanted(h.value), k, documents, total),
            T._parse_datatype_string("item int, key long, bound long"),
        )
        first = saved(_best(bounded, "bound", k).select("item", "key"), folder, f"first-{number}")
        exact = _scored(corpus, first, lambda p=plain: p.value, documents, total)
        score, last = np.zeros(len(own), np.int64), np.full(len(own), np.iinfo(np.int64).max)
        for r in _best(exact, "score", k).where(F.col("rank") == k).collect():  # one row an item of the pass
            score[r["item"]], last[r["item"]] = r["score"], _NULL if r["key"] is None else r["key"]
        least = spark.sparkContext.broadcast((score, last))

        left = map_arrow(
            slices, _not_excluded(lambda h=hashed: Wanted(h.value), lambda b=least: b.value, documents, total),
            T._parse_datatype_string("item int, key long"),
        )
        left = saved(left, folder, f"left-{number}")
        exact = _scored(corpus, left, lambda p=plain: p.value, documents, total)
        best = saved(_best(exact, "score", k), folder, f"best-{number}")
        named = best.join(spark_items, "item").select("id", "rank", "key", "score")
        results = named if results is None else results.unionByName(named)
    return results.select(F.col("id").alias(item), "rank", F.col("key").alias(key), "score")


def _passes(weights: DataFrame, limit: int) -> Iterator[DataFrame]:
    """The terms of the items in parts of about ``limit`` rows, or of one item if that alone has more; one part at
    least. Parts are halved until each of them keeps to that."""
    parts = max(1, -(-weights.count() // limit))
    while parts > 1:
        part = F.pmod(F.xxhash64("item"), F.lit(parts))
        sizes = weights.groupBy(part.alias("part"), "item").agg(F.count("*").alias("n"))
        sizes = sizes.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("items"))
        if sizes.where((F.col("n") > 2 * limit) & (F.col("items") > 1)).isEmpty():
            break
        parts *= 2
    for k in range(parts):
        yield weights.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == k) if parts > 1 else weights


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id and score of the ten best documents of every item; see :func:`search` for nulls, repeated
    rows and empty tables."""
    return search(docs, items).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
