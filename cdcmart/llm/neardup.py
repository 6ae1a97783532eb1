"""Near-duplicate vectors by PCA-ordered, tiled comparison.

All vectors are normed and turned so that the leading coordinates hold most of their length. A tile compares two
blocks: the products of the leading coordinates are added up first, the rest is bounded by the product of the
suffix norms (Cauchy-Schwarz), and a pair is given up as soon as its cosine cannot reach the threshold. Pairs that stay
are carried on, some coordinates at a time, to the exact cosine in double precision.

Blocks are leaves of median splits along the leading coordinates, so many pairs of blocks are given up as a whole: the
same bound over their bounding boxes. Equal vectors are one node with a number of copies. The turn and the splits
are fitted on a bounded sample; they change the speed, never the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import run_folder, saved, ship_package
from cdcmart.llm.components import components
from cdcmart.llm.links import local_groups

THRESHOLD = 0.9

# Vectors the turn and the splits are fitted on, vectors of a block, and coordinates added at a time.
SAMPLE = 4096
BLOCK = 8192
LEAD = 16
_BOX = 8
_SQUARE = 1024
_SLACK = 1e-4
_NEAR = 1e-9


def normed(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that nothing overflows."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


class Fit:
    """The turn and the splits for vectors of one length."""

    def __init__(self, sample: np.ndarray, leaves: int):
        unit = normed(sample)
        values, turn = np.linalg.eigh(unit.T @ unit)
        self.turn = np.ascontiguousarray(turn[:, np.argsort(-values, kind="stable")])
        self.splits: list[float] = []
        self.depth = max(0, min(int(np.ceil(np.log2(max(leaves, 1)))), 12))
        led = unit @ self.turn[:, :_BOX]
        level = [np.arange(len(led))]
        for depth in range(self.depth):
            axis, below = depth % led.shape[1], []
            for rows in level:
                cut = float(np.median(led[rows, axis])) if len(rows) else 0.0
                self.splits.append(cut)
                below += [rows[led[rows, axis] < cut], rows[led[rows, axis] >= cut]]
            level = below

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        return normed(vectors) @ self.turn

    def leaf(self, turned: np.ndarray) -> np.ndarray:
        splits, at = np.array(self.splits), np.zeros(len(turned), np.int64)
        for depth in range(self.depth):
            axis = depth % min(_BOX, turned.shape[1])
            cut = splits[(1 << depth) - 1 + at]
            at = 2 * at + (turned[:, axis] >= cut)
        return at


def reachable(boxes: np.ndarray, one: int, threshold: float) -> np.ndarray:
    """Blocks that may hold a vector within the threshold of one in block ``one``.

    ``boxes``: (blocks, 2 * k + 1): lowest and highest leading coordinates, and the largest norm of the rest.
    """
    k = boxes.shape[1] // 2
    low, high, rest = boxes[:, :k], boxes[:, k : 2 * k], boxes[:, -1]
    corners = [low * boxes[one, :k], low * boxes[one, k : 2 * k], high * boxes[one, :k], high * boxes[one, k : 2 * k]]
    most = np.maximum.reduce(corners).sum(axis=1) + rest * boxes[one, -1]
    return np.flatnonzero(most >= threshold - _SLACK)


def close_pairs(one: np.ndarray, other: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of turned unit rows whose cosine reaches the threshold, up to rounding: ``_NEAR`` is left undecided."""
    width = one.shape[1]
    lead = min(LEAD, width)

    def bounded(rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum((rows[:, lead:] ** 2).sum(axis=1), 0))
        return np.concatenate([rows[:, :lead], rest[:, None]], axis=1).astype(np.float32)

    i, j = np.nonzero(bounded(one) @ bounded(other).T >= threshold - _SLACK)
    if not len(i):
        return i, j
    sums = np.empty(len(i))
    for begin in range(0, len(i), 1 << 16):
        part = slice(begin, begin + (1 << 16))
        a, b = i[part], j[part]
        total = np.einsum("nd,nd->n", one[a, :lead], other[b, :lead])
        alive = np.arange(len(a))
        for at in range(lead, width, LEAD):
            stop = min(at + LEAD, width)
            total[alive] += np.einsum("nd,nd->n", one[a[alive], at:stop], other[b[alive], at:stop])
            if stop < width:
                left = np.sqrt((one[a[alive], stop:] ** 2).sum(axis=1) * (other[b[alive], stop:] ** 2).sum(axis=1))
                going = total[alive] + left >= threshold - _SLACK
                total[alive[~going]] = -2.0
                alive = alive[going]
        sums[part] = total
    kept = sums >= threshold - _NEAR
    return i[kept], j[kept]


def compare(
    nodes: list[str], copies: np.ndarray, vectors: np.ndarray, first: np.ndarray, fit: Fit, threshold: float, same: bool
) -> list[tuple[str, int, str]]:
    """Links in a tile: (node, copies it is linked with here, a node of its group here), several for a node.

    ``first`` marks the rows of the first block; ``same``: both blocks are one.
    """
    turned, exact = fit.turned(vectors), normed(vectors)
    left = np.flatnonzero(first)
    right = left if same else np.flatnonzero(~first)
    out: list[tuple[str, int, str]] = []
    links = np.zeros(len(nodes), np.int64)
    for p in range(0, len(left), _SQUARE):
        rows = left[p : p + _SQUARE]
        for q in range(p if same else 0, len(right), _SQUARE):
            columns = right[q : q + _SQUARE]
            i, j = close_pairs(turned[rows], turned[columns], threshold)
            if same and p == q:
                i, j = i[i < j], j[i < j]
            if len(i):
                # The turn rounds; what counts is the cosine of the vectors as they are.
                cosine = np.empty(len(i))
                for begin in range(0, len(i), 1 << 16):
                    part = slice(begin, begin + (1 << 16))
                    cosine[part] = np.einsum("nd,nd->n", exact[rows[i[part]]], exact[columns[j[part]]])
                i, j = i[cosine >= threshold], j[cosine >= threshold]
            if not len(i):
                continue
            a, b = rows[i], columns[j]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            for member, root in local_groups(a, b):
                out.append((nodes[member], 0, nodes[root]))
    out += [(nodes[i], int(links[i]), nodes[i]) for i in np.flatnonzero(links)]
    return out


def _rows(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, sample: int = SAMPLE
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding).

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; nor do vectors of
    different lengths. Equal vectors (rows repeated under one id, too) are links of each other. A component's id is its
    smallest vec_id, null ids last; other columns are not looked at.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    folder = run_folder(spark, "vectors")
    e = F.col("embedding").cast("array<double>")
    good = (
        F.col("embedding").isNotNull()
        & F.coalesce(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists(e, lambda x: x != 0), F.lit(False))
    )
    # 128 bits of two differently seeded hashes stand for the vector.
    node = F.concat(F.hex(F.xxhash64(e)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), e)))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", good.alias("good"))
    valid = rows.where("good").withColumn("node", node)
    key = F.struct(F.col("vec_id").isNull().alias("none"), F.coalesce("vec_id", F.lit(0)).alias("id"))
    # One vector for each node: what is compared.
    classes = saved(
        valid.groupBy("node")
        .agg(F.min(key).alias("key"), F.count("*").alias("copies"), F.first(e).alias("embedding"))
        .withColumn("width", F.size("embedding")),
        folder,
        "classes",
    )
    found = [
        _links(classes.where(F.col("width") == r["width"]), r["width"], r["count"], threshold, block, sample, f"{folder}/{r['width']}")
        for r in classes.groupBy("width").count().collect()
    ]
    if not found:
        linked = classes.select("node", F.lit(0).cast("long").alias("links"), F.col("node").alias("root")).limit(0)
    else:
        linked = found[0]
        for more in found[1:]:
            linked = linked.unionByName(more)
    linked = saved(linked, folder, "linked")
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")), f"{folder}/groups")
    grouped = saved(groups.join(classes.select("node", "key"), "node"), folder, "grouped")
    heads = saved(grouped.groupBy("component").agg(F.min("key").alias("head")), folder, "heads")
    result = saved(
        classes.select("node", "key", "copies")
        .join(links, "node", "left")
        .join(grouped.join(heads, "component").select("node", "head"), "node", "left")
        .select(
            "node",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("head", "key").alias("head"),
        ),
        folder,
        "result",
    )
    linked_rows = valid.select("vec_id", "node").join(result, "node").select(
        "vec_id", "n_links", F.when(~F.col("head.none"), F.col("head.id")).alias("component_id")
    )
    alone = rows.where(~F.col("good")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked_rows.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(
    classes: DataFrame, width: int, count: int, threshold: float, block: int, sample: int, folder: str
) -> DataFrame:
    """node, links and root found in the tiles of all vectors of one length."""
    # By a hash, about ``sample`` of them, so that no more than that leaves the tasks.
    chance = F.pmod(F.xxhash64("node"), F.lit(1 << 40)) / float(1 << 40)
    drawn = classes.where(chance <= sample / count).orderBy("node").limit(2 * sample).select("embedding").collect()
    if not drawn:
        drawn = classes.limit(1).select("embedding").collect()
    fit = Fit(np.array([r["embedding"] for r in drawn], np.float64), -(-count // block))

    def placed(batches):
        for batch in batches:
            values = batch.column(2).values.to_numpy().reshape(-1, width)
            turned = fit.turned(values)
            rest = np.sqrt((turned[:, _BOX:] ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([v.tobytes() for v in values], pa.binary()),
                    pa.array(fit.leaf(turned)),
                    pa.array(list(turned[:, :_BOX]), pa.list_(pa.float64())),
                    pa.array(rest),
                ],
                ["node", "copies", "vector", "leaf", "led", "rest"],
            )

    leaves = saved(
        classes.select("node", "copies", "embedding").mapInArrow(
            placed, "node string, copies long, vector binary, leaf long, led array<double>, rest double"
        ),
        folder,
        "leaves",
    )
    width_led = min(_BOX, width)
    # At most 4096 leaves, whatever the number of vectors: what goes to the driver and back to the tasks.
    stats = (
        leaves.groupBy("leaf")
        .agg(
            F.count("*").alias("size"),
            *[F.min(F.col("led")[k]).alias(f"low{k}") for k in range(width_led)],
            *[F.max(F.col("led")[k]).alias(f"high{k}") for k in range(width_led)],
            F.max("rest").alias("rest"),
        )
        .orderBy("leaf")
        .collect()
    )
    number = {r["leaf"]: k for k, r in enumerate(stats)}
    # A leaf with more vectors than a block is cut by a hash; its blocks have one box.
    pieces = np.array([-(-r["size"] // block) for r in stats], np.int64)
    first_block = np.cumsum(pieces) - pieces
    boxes = np.array([list(r)[2:] for r in stats], np.float64)
    shared = classes.sparkSession.sparkContext.broadcast((number, pieces, first_block, boxes))

    def dealt(batches):
        number, pieces, first_block, boxes = shared.value
        partners: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf = np.array([number[k] for k in batch.column(3).to_pylist()], np.int64)
            spread = np.array([zlib.crc32(n.encode()) for n in batch.column(0).to_pylist()], np.int64)
            own = first_block[leaf] + spread % pieces[leaf]
            rows, others = [], []
            for at in np.unique(leaf).tolist():
                if at not in partners:
                    near = reachable(boxes, at, threshold)
                    partners[at] = np.concatenate([first_block[k] + np.arange(pieces[k]) for k in near])
                members = np.flatnonzero(leaf == at)
                rows.append(np.repeat(members, len(partners[at])))
                others.append(np.tile(partners[at], len(members)))
            rows, others = np.concatenate(rows), np.concatenate(others)
            for begin in range(0, len(rows), 4096):
                row, other = rows[begin : begin + 4096], others[begin : begin + 4096]
                mine, taken = own[row], pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.minimum(mine, other)),
                        pa.array(np.maximum(mine, other)),
                        pa.array(mine),
                        *[batch.column(k).take(taken) for k in range(3)],
                    ],
                    ["a", "b", "own", "node", "copies", "vector"],
                )

    def tiles(batches) -> Iterator[tuple[int, int, list[pa.RecordBatch]]]:
        current, held = None, []
        for batch in batches:
            places = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            cuts = [0, *(np.flatnonzero((np.diff(places, axis=0) != 0).any(axis=1)) + 1).tolist(), len(places)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                place = tuple(places[begin].tolist())
                if place != current:
                    if held:
                        yield *current, held
                    current, held = place, []
                held.append(batch.slice(begin, end - begin))
        if held:
            yield *current, held

    def compared(batches):
        for a, b, held in tiles(batches):
            nodes = [n for part in held for n in part.column(3).to_pylist()]
            copies = np.concatenate([part.column(4).to_numpy() for part in held])
            own = np.concatenate([part.column(2).to_numpy() for part in held])
            values = np.concatenate([_rows(part.column(5), np.float64) for part in held]).reshape(-1, width)
            out = compare(nodes, copies, values, own == a, fit, threshold, a == b)
            if out:
                n, links, roots = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(n, pa.string()), pa.array(links, pa.int64()), pa.array(roots, pa.string())],
                    ["node", "links", "root"],
                )

    return (
        leaves.select("node", "copies", "vector", "leaf")
        .mapInArrow(dealt, "a long, b long, own long, node string, copies long, vector binary")
        .repartition("a", "b")
        .sortWithinPartitions("a", "b")
        .mapInArrow(compared, "node string, links long, root string")
    )
