"""Vector code compression: product codes refined over anchors-hierarchy metric trees.

Components become integers (``floor(scale * x)``) and vectors are cut into
equal parts; every part position has a codebook of a few entries, refined by
rounds of assignment and componentwise mean.

1. ``pack`` cuts the table into blocks of rows, where they lie, and grows a
   metric tree per block and part position.  Anchors hierarchy: about the
   root of the points become anchors, each new one the point farthest from
   its anchor; it takes over the points nearer to it, and only points
   farther than half the anchors' distance are looked at.  From this middle
   the anchors are merged pairwise outwards, smallest ball first, up to the
   root, and cut again by the same rule downwards to the leaves.  Each ball
   caches its count and its sum.  The blocks are written once.
2. A round walks every tree from the root with the list of candidate
   entries.  A ball inherits its parent's list and drops each entry that is
   farther than the nearest one for all of the ball; when one is left, the
   ball is wholly owned and its cached sum and count are added to that entry.
   Leaves compare what is left point by point, in integers.
3. Tasks return sums and counts per entry (positions x entries x width rows
   each); Spark adds them, and the driver holds the codebooks alone.

Balls drop entries by a floating-point bound with a margin for its rounding;
whatever is within the margin is compared in integers, so the codes are
those of a plain scan.

Defined cases: rows whose vector is null or holds null or non-finite
components go; shorter vectors end in zeros up to the longest one, and that
length is rounded up to a multiple of the parts; a first entry per row of the
smallest ids (null last, ties by vector), fewer where there are fewer rows;
entries that equal an earlier one are never used; rows that repeat an id
each stand alone; an empty table gives an empty result; components beyond
62 bits and errors beyond 64 raise; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import write_read
from .vectors import decimals, finite, matrix, scaled, span, widened

#: Rows of a block, and points of a leaf.
BLOCK = 2048
LEAF = 32


def _distances(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - to) ** 2).sum(axis=1))


def anchors(x: np.ndarray, k: int) -> np.ndarray:
    """The anchor (0 to k - 1, fewer where points repeat) of every point of ``x``."""
    own, pivots = np.zeros(len(x), np.int64), [0]
    far = _distances(x, x[0])
    while len(pivots) < k:
        new = int(far.argmax())
        if far[new] == 0:
            break
        gap = _distances(x[pivots], x[new])
        near = np.flatnonzero(far > gap[own] / 2)
        d = _distances(x[near], x[new])
        won = d < far[near]
        own[near[won]] = len(pivots)
        far[near[won]] = d[won]
        pivots.append(new)
    return own


def _merge(centres: list[np.ndarray], radii: list[float]) -> list[tuple[int, int]]:
    """Pairs to merge, in order: each time the two balls with the smallest ball around both."""
    c, r = np.array(centres), np.array(radii)
    size = len(c)
    cost = (np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2)) + r[:, None] + r[None]) / 2
    np.fill_diagonal(cost, np.inf)
    out = []
    for _ in range(size - 1):
        i, j = sorted(divmod(int(cost.argmin()), size))
        out.append((i, j))
        # the merged ball takes the place of i
        gap = float(np.sqrt(((c[i] - c[j]) ** 2).sum()))
        around = max((gap + r[i] + r[j]) / 2, r[i], r[j])
        if gap > 0:
            c[i] = c[i] + (c[j] - c[i]) * min(1.0, max(0.0, (around - r[i]) / gap))
        r[i] = around
        cost[j, :] = cost[:, j] = np.inf
        live = np.isfinite(cost[i])
        live[i] = False
        cost[i, live] = cost[live, i] = (np.sqrt(((c[live] - c[i]) ** 2).sum(axis=1)) + r[live] + r[i]) / 2
    return out


def grow(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes): the points' order along the leaves, and the balls of the tree, parents first.

    A node has ``start`` and ``stop`` in that order, its children (-1 at a
    leaf), the ``sum`` of its points and the ``radius`` around their mean.
    """
    x = points.astype(np.float64)
    left, right, parts = [], [], []

    def node(members) -> int:
        left.append(-1)
        right.append(-1)
        parts.append(members)
        return len(left) - 1

    root = node(np.arange(len(x)))
    open_ = [root]
    while open_:
        top = open_.pop()
        members = parts[top]
        if len(members) <= leaf:
            continue
        own = anchors(x[members], int(np.ceil(np.sqrt(len(members)))))
        groups = [members[own == a] for a in range(own.max() + 1)]
        if len(groups) == 1:
            continue
        centres = [x[g].mean(axis=0) for g in groups]
        at = [node(g) for g in groups]
        open_ += at
        merges = _merge(centres, [float(_distances(x[g], c).max()) for g, c in zip(groups, centres, strict=True)])
        for step, (i, j) in enumerate(merges):
            above = top if step == len(merges) - 1 else node(np.concatenate([parts[at[i]], parts[at[j]]]))
            left[above], right[above] = at[i], at[j]
            at[i] = above
    kind = np.dtype([("start", "<i4"), ("stop", "<i4"), ("left", "<i4"), ("right", "<i4"), ("radius", "<f8"), ("sum", "<i8", (points.shape[1],))])
    nodes = np.zeros(len(left), kind)
    nodes["left"], nodes["right"] = left, right
    order, stack = [], [root]
    begun = 0
    while stack:
        i = stack.pop()
        nodes["start"][i], nodes["stop"][i] = begun, begun + len(parts[i])
        if left[i] < 0:
            order.append(parts[i])
            begun += len(parts[i])
        else:
            stack += [right[i], left[i]]
    order = np.concatenate(order).astype(np.int32)
    ordered, x = points[order], x[order]
    if span(points) * len(points) >= 1 << 63:
        raise ValueError("sums of a block do not fit 64 bits")
    upto = np.concatenate([np.zeros((1, points.shape[1]), np.int64), ordered.cumsum(axis=0)])
    nodes["sum"] = upto[nodes["stop"]] - upto[nodes["start"]]
    for i in range(len(nodes)):
        a, b = nodes["start"][i], nodes["stop"][i]
        nodes["radius"][i] = _distances(x[a:b], nodes["sum"][i] / (b - a)).max() * (1 + 1e-9)
    return order, nodes


def _unique(entries: np.ndarray) -> np.ndarray:
    """False for entries that equal an earlier one."""
    seen: set = set()
    return np.array([not (t in seen or seen.add(t)) for t in map(tuple, entries.tolist())], bool)


def walk(nodes: np.ndarray, points: np.ndarray, entries: np.ndarray):
    """Sums and counts per entry, and the owner of each point (in the tree's order) and the points compared one by one."""
    k = len(entries)
    owner = np.zeros(len(points), np.int64)
    sums, counts = np.zeros((k, points.shape[1]), np.int64), np.zeros(k, np.int64)
    e = entries.astype(np.float64)
    between = np.sqrt(((e[:, None] - e[None]) ** 2).sum(axis=2))
    slack = 1e-13 * float(span(points, entries)) ** 2
    balls, lists, compared = np.zeros(1, np.int64), _unique(entries)[None], 0
    at, may = [], []
    while len(balls):
        ball = nodes[balls]
        size = ball["stop"] - ball["start"]
        centre = ball["sum"] / size[:, None]
        d = ((centre[:, None] - e[None]) ** 2).sum(axis=2)
        best = np.where(lists, d, np.inf).argmin(axis=1)
        nearest = np.take_along_axis(d, best[:, None], 1)
        reach = 2 * ball["radius"][:, None] * between[best]
        lists = lists & ~(d - nearest - reach > 1e-9 * (d + nearest + reach) + slack)
        owned = lists.sum(axis=1) == 1
        for b, entry in zip(balls[owned], best[owned], strict=True):
            owner[nodes["start"][b] : nodes["stop"][b]] = entry
        np.add.at(sums, best[owned], ball["sum"][owned])
        np.add.at(counts, best[owned], size[owned])
        leaf = ~owned & (ball["left"] < 0)
        at += [np.arange(a, b) for a, b in zip(ball["start"][leaf], ball["stop"][leaf], strict=True)]
        may.append(np.repeat(lists[leaf], size[leaf], axis=0))
        deeper = ~owned & (ball["left"] >= 0)
        balls = np.concatenate([ball["left"][deeper], ball["right"][deeper]]).astype(np.int64)
        lists = np.concatenate([lists[deeper], lists[deeper]])
    if at:
        at, may = np.concatenate(at), np.concatenate(may)
        bound = (2 * span(points, entries)) ** 2 * max(1, points.shape[1])
        apart = widened(points[at], bound)[:, None] - widened(entries, bound)[None]
        d = (apart * apart).sum(axis=2)
        d[~may] = bound + 1
        mine = d.argmin(axis=1)
        owner[at] = mine
        np.add.at(sums, mine, points[at])
        np.add.at(counts, mine, 1)
        compared = len(at)
    return sums, counts, owner, compared


def pack(rows: DataFrame, scale: int, parts: int, width: int, block: int, leaf: int) -> DataFrame:
    """Rows (id, label, v) as blocks: ids and labels, and per part position the points in tree order, the order and the tree."""

    def made(ids, labels, values):
        m = scaled(matrix(values, parts * width), scale)
        points, orders, trees = [], [], []
        for p in range(parts):
            part = m[:, p * width : (p + 1) * width]
            order, nodes = grow(part, leaf)
            points.append(part[order].astype(np.int32 if span(part) < 1 << 31 else np.int64).tobytes())
            orders.append(order.tobytes())
            trees.append(nodes.tobytes())
        whole = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
        packed = [pa.array([x], pa.list_(pa.binary())) for x in (points, orders, trees)]
        return pa.RecordBatch.from_arrays([whole(ids), whole(labels), *packed], names=["ids", "labels", "points", "orders", "trees"])

    def run(batches):
        held, rows_held = [], 0
        for batch in batches:
            held.append(batch)
            rows_held += batch.num_rows
            if rows_held < block:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            for a in range(0, rows_held - rows_held % block, block):
                yield made(*(table.column(c).slice(a, block).combine_chunks() for c in ("id", "label", "v")))
            held = table.slice(rows_held - rows_held % block).to_batches()
            rows_held %= block
        if rows_held:
            table = pa.Table.from_batches(held)
            yield made(*(table.column(c).combine_chunks() for c in ("id", "label", "v")))

    kinds = [("ids", T.ArrayType(rows.schema["id"].dataType)), ("labels", T.ArrayType(rows.schema["label"].dataType))]
    kinds += [(c, T.ArrayType(T.BinaryType())) for c in ("points", "orders", "trees")]
    return rows.mapInArrow(run, T.StructType([T.StructField(c, t) for c, t in kinds]))


def _unpacked(points: bytes, order: bytes, tree: bytes, width: int):
    order = np.frombuffer(order, np.int32)
    nodes = np.frombuffer(tree, np.dtype([("start", "<i4"), ("stop", "<i4"), ("left", "<i4"), ("right", "<i4"), ("radius", "<f8"), ("sum", "<i8", (width,))]))
    points = np.frombuffer(points, np.int32 if len(points) == 4 * width * len(order) else np.int64)
    return points.reshape(len(order), width).astype(np.int64), order, nodes


def _round(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one assignment of all blocks: floored means, unused entries as they were."""
    parts, (k, width) = len(books), books[0].shape

    def run(batches):
        sums, counts = np.zeros((parts, k, width), object), np.zeros((parts, k), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                for p in range(parts):
                    held = [batch.column(c)[row][p].as_py() for c in ("points", "orders", "trees")]
                    points, _, nodes = _unpacked(*held, width)
                    s, c, _, _ = walk(nodes, points, books[p])
                    sums[p] += s
                    counts[p] += c
        part, entry, at = (x.ravel().astype(np.int32) for x in np.indices(sums.shape))
        columns = [pa.array(part), pa.array(entry), pa.array(at), pa.array(np.repeat(counts.ravel(), width)), decimals(sums.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "at", "count", "total"])

    found = blocks.select("points", "orders", "trees").mapInArrow(run, "part int, entry int, at int, count long, total decimal(38,0)")
    found = found.groupBy("part", "entry", "at").agg(F.sum("count").alias("n"), F.sum("total").alias("t"))
    out = [b.copy() for b in books]
    for r in found.where("n > 0").collect():
        out[r["part"]][r["entry"], r["at"]] = int(r["t"]) // r["n"]
    return out


def _coded(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(id, label, code, error) of every row."""
    parts, width = len(books), books[0].shape[1]

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids, labels = (batch.column(c)[row].values for c in ("ids", "labels"))
                codes, error = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), object)
                for p in range(parts):
                    held = [batch.column(c)[row][p].as_py() for c in ("points", "orders", "trees")]
                    points, order, nodes = _unpacked(*held, width)
                    owner = walk(nodes, points, books[p])[2]
                    apart = widened(points, (2 * span(points, books[p])) ** 2 * max(1, width)) - books[p][owner]
                    codes[order, p] = owner
                    error[order] += (apart * apart).sum(axis=1)
                text = [bytes(c).hex() for c in codes]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text), pa.array(error.tolist(), pa.int64())], names=["id", "label", "code", "error"])

    kinds = [("id", blocks.schema["ids"].dataType.elementType), ("label", blocks.schema["labels"].dataType.elementType)]
    kinds += [("code", T.StringType()), ("error", T.LongType())]
    return blocks.mapInArrow(run, T.StructType([T.StructField(c, t) for c, t in kinds]))


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' decimal components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    scale: int = 4096,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    block: int = BLOCK,
    leaf: int = LEAF,
) -> tuple[DataFrame, list[np.ndarray]]:
    """One row per whole vector (id, label, code, error), and the codebooks of the part positions."""
    if not 0 < entries <= 256:
        raise ValueError("a code digit holds 1 to 256 entries")
    rows = finite(vectors, vec_col, {"id": id_col, "label": label_col})
    dims = rows.agg(F.max(F.size("v")).alias("d")).first()["d"]
    width = max(1, -(-(dims or 0) // parts))
    first = rows.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    start = np.zeros((len(first), parts * width))
    for i, r in enumerate(first):
        start[i, : len(r["v"])] = r["v"]
    books = [scaled(start[:, p * width : (p + 1) * width], scale) for p in range(parts)]
    if not first:
        return rows.select(F.col("id").alias(id_col), F.col("label").alias(label_col), F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), books
    blocks = write_read(pack(rows, scale, parts, width, block, leaf), "vector-blocks")
    for _ in range(rounds):
        books = _round(blocks, books)
    return _coded(blocks, books).select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error"), books


def with_label_errors(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """``coded`` and ``label_error``: the error summed over the rows of equal label, nulls together."""
    coded = write_read(coded, "vector-codes")
    totals = coded.groupBy(F.col(label_col).alias("__label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col(label_col).eqNullSafe(F.col("__label")), "left").drop("__label")
