"""Similarity join of word-shingle sets by chosen paths.

Every text is the set of its five-word shingles, embedded as ``TOKENS`` minhash tokens. A run is a tree of
splits: a node, known by its path, samples one or two token places (``1 / threshold`` on average), and a set goes to the child of
the token it has there, so two sets stay together at each place with a chance of their similarity. Buckets
of at most ``BUCKET`` sets, and larger ones whose sets are alike on average, are compared by brute force on the
exact shingle sets; others are split again. Runs are repeated until a pair at the threshold is found with
chance ``RECALL``; a pair's similarity is computed only in the first of the buckets it shares.

Texts that are equal in lower case are one set with a number of copies, so copies are never compared. A bucket of more
than ``TILE`` sets is compared tile by tile in different tasks. No bucket is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import in_slices, quoted, run_folder, saved, ship_package
from cdcmart.llm.components import components
from cdcmart.llm.links import local_groups
from cdcmart.llm.words import mixed, words_of

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
TOKENS = 96
LEAST_DEPTH, MOST_DEPTH = 2, 5
BUCKET = 256
TILE = 1024

# Buckets whose sets agree so often on the next places are not split: it would not part them.
ALIKE = 0.5

_HAS_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"

_random = np.random.default_rng(411)
_XOR = _random.integers(0, 1 << 32, TOKENS, dtype=np.uint64).astype(np.uint32)
_TIMES = (_random.integers(0, 1 << 31, TOKENS, dtype=np.uint64) * 2 + 1).astype(np.uint32)


def runs_for(threshold: float, recall: float, depth: int = MOST_DEPTH) -> int:
    """Runs after which a pair at ``threshold`` shared a bucket at ``depth`` with chance ``recall``.

    ``lost`` is the chance that no branch of one run holds both sets, from the leaves up: a node has one
    child place, and a second one with chance ``1 / threshold - 1``.
    """
    second = 1 / threshold - 1
    lost = 0.0
    for _ in range(depth):
        parted = 1 - threshold * (1 - lost)
        lost = (1 - second) * parted + second * parted * parted
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost)))


def shingles_of(hashes: np.ndarray, bounds: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of a run of documents, and how many each has. Fewer words than one shingle, but some,
    are one shingle."""
    sizes = np.diff(bounds)
    counts = np.where(sizes >= words, sizes - words + 1, (sizes > 0).astype(np.int64))
    whole = len(hashes) - words + 1
    found = np.zeros(max(whole, 0), np.uint64)
    for k in range(words if whole > 0 else 0):
        found = mixed(found * np.uint64(5) + hashes[k : k + whole])
    owner = np.repeat(np.arange(len(sizes)), counts)
    at = bounds[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    short = sizes[owner] < words
    out = np.empty(len(owner), np.uint64)
    out[~short] = found[at[~short]]
    for i in np.flatnonzero(short):
        h = np.zeros(1, np.uint64)
        for x in hashes[bounds[owner[i]] : bounds[owner[i] + 1]]:
            h = mixed(h * np.uint64(5) + x)
        out[i] = h[0] ^ np.uint64(sizes[owner[i]])
    return out, counts


def tokens_of(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The minhash tokens of each document, a row each; documents without shingles have a row of ones."""
    out = np.ones((len(counts), TOKENS), np.uint32)
    some = counts > 0
    if not some.any():
        return out
    low = shingles.astype(np.uint32)
    starts = (np.cumsum(counts) - counts)[some]
    for i in range(TOKENS):
        out[some, i] = np.minimum.reduceat((low ^ _XOR[i]) * _TIMES[i], starts)
    return out


def split_once(rows: np.ndarray, nodes: np.ndarray, tokens: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Children of ``nodes``: row and node id of each. The places depend on the node alone, so all its sets share them."""
    draw = mixed(nodes ^ np.uint64(0x5851F42D4C957F2D))
    first = (draw % np.uint64(TOKENS)).astype(np.int64)
    other = (first + 1 + ((draw >> np.uint64(20)) % np.uint64(TOKENS - 1)).astype(np.int64)) % TOKENS
    second = (draw >> np.uint64(40)).astype(np.float64) / (1 << 24) < 1 / threshold - 1
    rows_out, nodes_out = [], []
    for place, chosen in ((first, slice(None)), (other, second)):
        r, p = rows[chosen], place[chosen]
        value = tokens[r, p].astype(np.uint64) | (p.astype(np.uint64) << np.uint64(32))
        rows_out.append(r)
        nodes_out.append(mixed(mixed(nodes[chosen]) + value))
    return np.concatenate(rows_out), np.concatenate(nodes_out)


def first_nodes(tokens: np.ndarray, runs: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row and node id of all buckets at the least depth, of all runs."""
    rows = np.tile(np.arange(len(tokens)), runs)
    nodes = np.repeat(mixed(np.arange(1, runs + 1, dtype=np.uint64)), len(tokens))
    for _ in range(LEAST_DEPTH):
        rows, nodes = split_once(rows, nodes, tokens, threshold)
    return rows, nodes


def similar(one: list[np.ndarray], other: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets (sorted, distinct) have at least the Jaccard similarity ``threshold``."""
    same = one is other
    every = np.concatenate(one if same else [*one, *other])
    values, at, often = np.unique(every, return_inverse=True, return_counts=True)
    # A shingle that one set alone has adds to no intersection.
    shared = often > 1
    column = np.cumsum(shared) - 1
    kept = shared[at]
    sizes = np.array([len(s) for s in (one if same else [*one, *other])])
    row = np.repeat(np.arange(len(sizes)), sizes)[kept]
    column = column[at][kept]
    both = np.zeros((len(one), len(other)), np.float32)
    n = len(one)
    for begin in range(0, int(shared.sum()), 4096):
        part = (column >= begin) & (column < begin + 4096)
        if not part.any():
            continue
        inside = np.zeros((len(sizes), 4096), np.float32)
        inside[row[part], column[part] - begin] = 1
        both += inside[:n] @ (inside.T if same else inside[n:].T)
    left, right = sizes[:n], (sizes if same else sizes[n:])
    union = left[:, None] + right[None, :] - both
    return (both >= threshold * union - 1e-6) & (union > 0)


def _runs(sets: list[np.ndarray], limit: int) -> list[tuple[int, int]]:
    """Runs of sets with about ``limit`` shingles in all; a larger set is a run of its own."""
    runs, begin, held = [], 0, 0
    for i, s in enumerate(sets):
        if i > begin and held + len(s) > limit:
            runs.append((begin, i))
            begin, held = i, 0
        held += len(s)
    return [*runs, (begin, len(sets))] if sets else []


def linked_sets(
    one: list[np.ndarray], other: list[np.ndarray], threshold: float, limit: int = 1 << 20
) -> np.ndarray:
    """:func:`similar`, for sets of any size: what is held beside them does not grow with the longest text."""
    out = np.zeros((len(one), len(other)), bool)
    same = one is other
    for a, b in _runs(one, limit):
        left = one[a:b]
        for c, d in _runs(other, limit):
            if same and c < a:
                continue
            out[a:b, c:d] = similar(left, left if same and a == c else other[c:d], threshold)
            if same and c > a:
                out[c:d, a:b] = out[a:b, c:d].T
    return out


def shares_earlier(one: list[list[int]], other: list[list[int]], key: int) -> np.ndarray:
    """Which pairs have a bucket before ``key`` in common: they are compared there."""
    before = sorted({k for keys in (*one, *other) for k in keys if k < key})
    place = {k: i for i, k in enumerate(before)}

    def inside(sets: list[list[int]]) -> np.ndarray:
        out = np.zeros((len(sets), len(before)), np.float32)
        for i, keys in enumerate(sets):
            out[i, [place[k] for k in keys if k < key]] = 1
        return out

    return inside(one) @ inside(other).T > 0


def compare(rows: list[tuple], key: int, a: int, b: int, threshold: float) -> list[tuple[bytes, int, bytes]]:
    """Links in one tile of a bucket: (node, copies it is linked with here, a node of its group here).

    ``rows`` are (tile, node, copies, keys, shingles); a node that comes twice counts once.
    """
    rows = list({r[1]: r for r in rows}.values())
    one = [r for r in rows if r[0] == a]
    other = one if a == b else [r for r in rows if r[0] == b]
    if not one or not other or len(rows) < 2:
        return []
    if len(rows) == 2:
        first, second = rows
        if min(set(first[3]) & set(second[3])) != key:
            return []
        both = len(np.intersect1d(first[4], second[4], assume_unique=True))
        if both < threshold * (len(first[4]) + len(second[4]) - both) - 1e-6:
            return []
        root = min(first[1], second[1])
        return [(first[1], second[2], root), (second[1], first[2], root)]
    left = [r[4] for r in one]
    linked = linked_sets(left, left if a == b else [r[4] for r in other], threshold)
    linked &= ~shares_earlier([r[3] for r in one], [r[3] for r in other], key)
    if a == b:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return []
    nodes = [r[1] for r in one] + ([] if a == b else [r[1] for r in other])
    links = linked @ np.array([r[2] for r in other])
    left_end, right_end = np.nonzero(linked)
    if a != b:
        links = np.concatenate([links, linked.T @ np.array([r[2] for r in one])])
        right_end = right_end + len(one)
    return [(nodes[i], int(links[i]), nodes[root]) for i, root in local_groups(left_end, right_end)]


def node_of(text: str = "text") -> Column:
    """What texts that are equal in lower case have in common."""
    return F.unhex(F.md5(F.lower(F.coalesce(F.col(text), F.lit("")))))


def has_words(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(_HAS_WORD), F.lit(False))


# Keeps a null id apart from all others where ids are compared.
def _id_key() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"))


def _signed(texts: DataFrame) -> DataFrame:
    """none, id, node and tokens of every row (none, id, node, text)."""

    def step(batches):
        for batch in in_slices(batches, 3):
            texts = batch.column(3).cast(pa.binary()).to_pylist()
            found = []
            for _, _, words in words_of(texts):
                found += [row.tobytes() for row in tokens_of(*shingles_of(words.hashes, words.bounds))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found, pa.binary())], ["none", "id", "node", "tokens"]
            )

    return texts.mapInArrow(step, "none boolean, id long, node binary, tokens binary")


def _token_rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, TOKENS)


def _buckets(classes: DataFrame, folder: str, threshold: float, recall: float) -> DataFrame:
    """key, node, size of every bucket that is to be compared."""
    runs = runs_for(threshold, recall)

    def begin(batches):
        for batch in batches:
            rows, nodes = first_nodes(_token_rows(batch.column(1)), runs, threshold)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes.view(np.int64)), batch.column(0).take(pa.array(rows))], ["key", "node"]
            )

    def go_on(batches):
        for batch in batches:
            parents = batch.column(0).to_numpy()
            rows, nodes = split_once(np.arange(len(parents)), parents.view(np.uint64), _token_rows(batch.column(2)), threshold)
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes.view(np.int64)), batch.column(1).take(taken), batch.column(0).take(taken)],
                ["key", "node", "parent"],
            )

    done = []
    level = classes.select("node", "tokens").mapInArrow(begin, "key long, node binary")
    for depth in range(LEAST_DEPTH, MOST_DEPTH + 1):
        names = level.columns
        marks = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"mark{k}") for k in (1, 2)]
        above = [F.min("parent").alias("parent")] if "parent" in names else []
        counts = level.groupBy("key").agg(F.count("*").alias("size"), *marks, *above)
        counts = saved(counts.where("size > 1"), folder)
        if above:
            # What is alike on average stays in one piece; its parent is compared as it is.
            sizes = done_big.select(F.col("key").alias("parent"), F.col("size").alias("whole"))
            alike = (
                counts.groupBy("parent")
                .agg(F.sum(F.col("size") * F.col("size")).alias("pairs"), F.sum("size").alias("places"))
                .join(sizes, "parent")
                .where(F.col("pairs") >= ALIKE * F.col("places") * F.col("whole"))
                .select("parent")
            )
            alike = saved(alike, folder)
            done.append(big.join(alike.withColumnRenamed("parent", "key"), "key", "left_semi").select("key", "node", "size"))
            counts = counts.join(alike, "parent", "left_anti")
        # Buckets of the same sets, found on different paths, are compared once.
        distinct = counts.groupBy("size", "mark1", "mark2").agg(F.min("key").alias("key"))
        kept = saved(distinct.select("key", "size"), folder)
        members = saved(level.select("key", "node").join(kept, "key"), folder)
        last = depth == MOST_DEPTH
        done.append(members if last else members.where(F.col("size") <= BUCKET))
        if last:
            break
        done_big = kept.where(F.col("size") > BUCKET)
        if done_big.isEmpty():
            break
        big = members.where(F.col("size") > BUCKET)
        level = saved(
            big.select("key", "node")
            .join(classes.select("node", "tokens"), "node")
            .select("key", "node", "tokens")
            .mapInArrow(go_on, "key long, node binary, parent long"),
            folder,
        )
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _with_shingles(rows: DataFrame) -> DataFrame:
    """node, copies, keys, shingles of every row (node, copies, keys, text): sorted distinct hashes as bytes."""

    def step(batches):
        for batch in in_slices(batches, 3):
            texts = batch.column(3).cast(pa.binary()).to_pylist()
            found = []
            for _, _, words in words_of(texts):
                shingles, counts = shingles_of(words.hashes, words.bounds)
                ends = np.cumsum(counts).tolist()
                found += [np.unique(shingles[e - n : e]).tobytes() for e, n in zip(ends, counts.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found, pa.binary())], ["node", "copies", "keys", "shingles"]
            )

    return rows.mapInArrow(step, "node binary, copies long, keys array<struct<key:long,size:long>>, shingles binary")


def _compared(rows: DataFrame, threshold: float) -> DataFrame:
    """node, links, root: links found in each tile of rows (key, a, b, tile, node, copies, all_keys, shingles), which
    are dealt out and sorted by (key, a, b)."""

    def tiles(batches) -> Iterator[tuple[tuple[int, int, int], list[tuple]]]:
        current, held = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            values = [batch.column(i) for i in range(3, 8)]
            for n, place in enumerate(keys):
                if place != current:
                    if held:
                        yield current, held
                    current, held = place, []
                tile, node, copies, own, shingles = (v[n].as_py() for v in values)
                held.append((tile, node, copies, own, np.frombuffer(shingles, np.uint64)))
        if held:
            yield current, held

    def step(batches):
        out = []
        for (key, a, b), held in tiles(batches):
            out += compare(held, key, a, b, threshold)
            if len(out) >= 10_000:
                yield packed(out)
                out = []
        if out:
            yield packed(out)

    def packed(out) -> pa.RecordBatch:
        nodes, links, roots = zip(*out)
        columns = [pa.array(nodes, pa.binary()), pa.array(links, pa.int64()), pa.array(roots, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["node", "links", "root"])

    return rows.mapInArrow(step, "node binary, links long, root binary")


def link_classes(docs: DataFrame, folder: str, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """node, none, id, class_none, class_id, n_links of every distinct text with words of ``docs`` (doc_id, text).

    (none, id) is the smallest doc_id of that text, a null id last and marked by ``none``; the class's likewise, over all texts
    that links reach. ``n_links`` counts the other rows, copies included, that the text is linked with directly.
    """
    ship_package(docs.sparkSession)
    texts = docs.where(has_words()).select(
        _id_key().alias("key"), node_of().alias("node"), F.lower("text").alias("text")
    ).select("key.none", "key.id", "node", "text")
    signed = saved(_signed(texts), folder, "signed")
    first = F.min(F.struct("none", "id"))
    classes = saved(
        signed.groupBy("node")
        .agg(first.alias("key"), F.count("*").alias("copies"), F.first("tokens").alias("tokens"))
        .select("node", "key.none", "key.id", "copies", "tokens"),
        folder,
        "classes",
    )
    buckets = saved(_buckets(classes, folder, threshold, recall), folder, "buckets")
    # A set is in a bounded number of buckets: the places of all its runs.
    by_node = buckets.groupBy("node").agg(F.collect_set(F.struct("key", "size")).alias("keys"))
    wanted = saved(by_node.join(classes.drop("tokens"), "node"), folder, "wanted")
    # One text of each set; (none, id) spreads the copies, and a repeated row is dropped where tiles are compared.
    sets = _with_shingles(
        texts.join(wanted, ["node", "none", "id"]).select("node", "copies", "keys", "text")
    )
    tiles = F.ceil(F.col("at.size") / F.lit(TILE))
    dealt = (
        sets.select("node", "copies", "shingles", F.transform("keys", lambda k: k["key"]).alias("all_keys"), F.explode("keys").alias("at"))
        .withColumn("tile", F.pmod(F.xxhash64("node", F.col("at.key")), tiles).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), (tiles - 1).cast("int"))))
        .select(
            F.col("at.key").alias("key"),
            F.least("tile", "with").alias("a"),
            F.greatest("tile", "with").alias("b"),
            "tile",
            "node",
            "copies",
            "all_keys",
            "shingles",
        )
        .repartition("key", "a", "b")
        .sortWithinPartitions("key", "a", "b")
    )
    found = saved(_compared(dealt, threshold), folder, "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), f"{folder}/groups")
    grouped = saved(groups.join(classes.select("node", "none", "id"), "node"), folder, "grouped")
    heads = saved(grouped.groupBy("component").agg(first.alias("head")), folder, "heads")
    headed = grouped.join(heads, "component").select("node", "head")
    return saved(
        classes.drop("tokens")
        .join(links, "node", "left")
        .join(headed, "node", "left")
        .select(
            "node",
            "none",
            "id",
            F.coalesce("head.none", "none").alias("class_none"),
            F.coalesce("head.id", "id").alias("class_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        folder,
        "linked",
    )


def join_similar(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its group), n_links (other documents linked directly) and kept (it is the
    one of its group that stays) of every row.

    Null texts and texts without words link with nothing: class and id are equal, and they are kept. Repeated rows count as
    copies; rows that repeat the id that stays are all marked kept. Null ids come last. Other columns are not looked at.
    """
    folder = run_folder(docs.sparkSession, "jaccard")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    linked = link_classes(docs, folder, threshold, recall).select("node", "class_none", "class_id", "n_links")
    rows = docs.where(has_words()).select("doc_id", node_of().alias("node"))
    found = rows.join(linked, "node").select(
        "doc_id",
        F.when(~F.col("class_none"), F.col("class_id")).alias("class_id"),
        "n_links",
    )
    alone = docs.where(~has_words()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row of the smallest doc_id, one if it is
    repeated, and all rows without words. Null ids come last; columns of any name stay as they are."""
    folder = run_folder(docs.sparkSession, "jaccard")
    linked = link_classes(docs.select("doc_id", "text"), folder, threshold, recall)
    staying = linked.where("none = class_none and id = class_id").select("node", "none", "id")
    # The caller's columns stand in one, so that none of them meets a name of this function.
    row = F.struct(*quoted(docs.columns)).alias("row")
    keyed = docs.where(has_words()).select(row, node_of().alias("node"), _id_key().alias("key"))
    keyed = keyed.select("row", "node", "key.none", "key.id")
    kept = keyed.join(staying, ["node", "none", "id"], "left_semi").dropDuplicates(["node", "none", "id"]).select("row.*")
    return kept.unionByName(docs.where(~has_words()))
