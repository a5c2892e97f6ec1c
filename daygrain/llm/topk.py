"""Exact top-k search by block-at-a-time pruning.

Vectors become integers (``floor(scale * x)``) and are packed, in ranges of
ids, into blocks: a forward index (the block's matrix) and, per dimension,
the largest and smallest value.  A query's score with any vector of a block
is at most the sum over dimensions of the larger of ``q * max`` and
``q * min``.  Each query takes the blocks of a shard in the order of these
bounds, and stops where the bound falls below its k-th score so far; that
score starts from a small pilot set, so most shards begin with a threshold.

Queries are packed into chunks of bounded size.  Chunks first meet the
blocks' extremes alone (a stated query set against all rows, in blocks); a
chunk and a shard travel to a task only where some query's bound reaches its
threshold.  One task holds one chunk and one shard, both of fixed size.  At
most k rows per query and shard leave a task, and a ranked window with
Spark's partial limit merges them.

Defined cases: a vector that is null, or holds a null or non-finite
component, takes no part; every other row is a candidate of every query but
its own, also where rows share an id or are equal, and every query row is
ranked on its own; a row without id is a candidate with a null id, which
comes last in ties (as does the id ``2**63 - 1``, which stands for none);
shorter vectors count as padded with zeros; components and scores are exact,
and raise where a component does not fit 62 bits or a score met does not;
ties go to the smaller id; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import write_read
from .vectors import finite, matrix, scaled, span

BLOCK = 512
BLOCKS_PER_SHARD = 8
SHARDS_PER_CELL = 128
CHUNK = 2048
CHUNKS_PER_TASK = 8
PILOT_BLOCKS = 2
#: Scores lie strictly within plus and minus this; bounds are cut to it.
LIMIT = 1 << 62
NONE = -LIMIT
NO_ID = (1 << 63) - 1
_PACKED = "part long, seq long, n long, dims long, places binary, ids binary, matrix binary"


def _pieces(parts, size: int):
    """Tuples of arrays, the last a matrix, joined and cut into ``size`` rows."""
    held = None
    for part in parts:
        if held is not None:
            dims = max(held[-1].shape[1], part[-1].shape[1])
            wide = (_padded(held[-1], dims), _padded(part[-1], dims))
            part = [np.concatenate(x) for x in [*zip(held[:-1], part[:-1], strict=True), wide]]
        at = 0
        while len(part[0]) - at >= size:
            yield [x[at : at + size] for x in part]
            at += size
        held = [x[at:] for x in part]
    if held is not None and len(held[0]):
        yield held


def _packed(part: int, seq: int, places, ids, matrix, **more) -> pa.RecordBatch:
    """One packed row; the matrix takes 32 bits a component where that is enough."""
    matrix = matrix.astype(np.int32 if span(matrix) < 1 << 31 else np.int64)
    values = {"part": part, "seq": seq, "n": len(ids), "dims": matrix.shape[1], "places": places.tobytes(), "ids": ids.tobytes(), "matrix": matrix.tobytes(), **more}
    return pa.RecordBatch.from_pylist([values])


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (a number of its own for every row), ids and the matrix of integers."""
    cells = row["n"] * row["dims"]
    kind = np.int64 if cells and len(row["matrix"]) == 8 * cells else np.int32
    return np.frombuffer(row["places"], np.int64), np.frombuffer(row["ids"], np.int64), np.frombuffer(row["matrix"], kind).reshape(row["n"], row["dims"])


def pack_blocks(vectors: DataFrame, ask: Column, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """Blocks of rows in ranges of ids, with their extremes and the rows that ask (``asks``)."""
    plain = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(ask, F.lit(False)).alias("ask"), F.col(f"`{vec_col}`").alias("vec"))
    # The vectors travel in their own type and become doubles in the tasks.
    rows = finite(plain, "vec", {"id": "id", "ask": "ask", "vec": "vec"}).drop("v").withColumn("id", F.coalesce("id", F.lit(NO_ID)))
    # The second key spreads an id that many rows share.
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    size = BLOCK

    def run(batches):
        part = TaskContext.get().partitionId()
        arrays = ([b.column("id").to_numpy(), b.column("ask").to_numpy(zero_copy_only=False), scaled(matrix(b.column("vec")).astype(np.float64), scale)] for b in batches)
        for seq, (ids, asks, m) in enumerate(_pieces(arrays, size)):
            places = (part << 36) + seq * size + np.arange(len(ids))
            extremes = {"high": m.max(axis=0).tobytes(), "low": m.min(axis=0).tobytes()}
            yield _packed(part, seq, places, ids, m, asks=np.asarray(asks, bool).tobytes(), asking=int(asks.sum()), **extremes)

    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    return ordered.select("id", "ask", "vec").mapInArrow(run, _PACKED + ", asks binary, asking long, high binary, low binary")


def _padded(m: np.ndarray, dims: int) -> np.ndarray:
    return m if m.shape[1] == dims else np.pad(m, ((0, 0), (0, dims - m.shape[1])))


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products: by floating point where every partial sum fits 53 bits, as Python integers beyond 62."""
    dims = max(a.shape[1], b.shape[1])
    a, b = _padded(a, dims), _padded(b, dims)
    top = span(a) * span(b) * max(1, dims)
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    kind = np.int64 if top < LIMIT else object
    return a.astype(kind) @ b.astype(kind).T


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; raises where one does not fit 62 bits."""
    out = _exact(a, b)
    if out.dtype == object and span(out) >= LIMIT:
        raise ValueError("an inner product does not fit 62 bits")
    return out.astype(np.int64)


def _merge(best, scores, ids, k):
    """Top k of the rows of ``best`` (scores, ids) and the new columns, ties to the smaller id."""
    s = np.concatenate([best[0], scores], axis=1)
    i = np.concatenate([best[1], ids], axis=1)
    order = np.lexsort((i, -s), axis=1)[:, :k]
    return np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def _block_top(q, q_places, m, places, ids, k):
    """Scores and ids of the k best of one block per query (the block's ids ascend)."""
    scores = products(q, m)
    scores[q_places[:, None] == places[None, :]] = NONE
    order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(scores, order, 1), ids[order]


def bounds(q: np.ndarray, extremes: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Upper bounds of any score, queries x blocks, from the blocks' largest and smallest components."""
    dims = max([q.shape[1], *(len(high) for high, _ in extremes)])
    q = _padded(q, dims).astype(np.int64)
    # What a shorter vector lacks counts as zero.
    high = np.array([np.pad(h, (0, dims - len(h))) for h, _ in extremes], np.int64).reshape(len(extremes), dims)
    low = np.array([np.pad(x, (0, dims - len(x))) for _, x in extremes], np.int64).reshape(len(extremes), dims)
    most = _exact(np.maximum(q, 0), high) + _exact(np.minimum(q, 0), low)
    return np.clip(most, -LIMIT, LIMIT).astype(np.int64)


def search(q_places, q, floor, blocks, k):
    """Per query the k best of ``blocks`` [(places, ids, matrix)], none surely below ``floor``."""
    limit = bounds(q, [(m.max(axis=0), m.min(axis=0)) for _, _, m in blocks])
    order = np.argsort(-limit, axis=1, kind="stable")
    best = (np.full((len(q), k), NONE, np.int64), np.full((len(q), k), NO_ID, np.int64))
    scored = 0
    for r in range(len(blocks)):
        turn = order[:, r]
        live = np.take_along_axis(limit, turn[:, None], 1)[:, 0] >= np.maximum(best[0][:, k - 1], floor)
        if not live.any():
            break
        for j in np.unique(turn[live]):
            who = np.flatnonzero(live & (turn == j))
            places, ids, m = blocks[j]
            got = _block_top(q[who], q_places[who], m, places, ids, k)
            best[0][who], best[1][who] = _merge((best[0][who], best[1][who]), *got, k)
            scored += len(who)
    return best, scored


def _chunks(packed: DataFrame, pilot: list, k: int) -> DataFrame:
    """The asking rows of the blocks in chunks, each row with the k-th score that the pilot blocks give it.

    Only asking rows are dealt again, to as many tasks as fill ``CHUNKS_PER_TASK`` chunks each.
    """
    size = CHUNK
    asked = packed.where(F.col("asking") > 0)
    total = asked.agg(F.sum("asking")).first()[0] or 0
    tasks = max(1, -(-total // (size * CHUNKS_PER_TASK)))

    def pick(batches):
        for batch in batches:
            for row in batch.to_pylist():
                asks = np.frombuffer(row["asks"], bool)
                yield _packed(row["part"], row["seq"], *[x[asks] for x in unpack(row)])

    def run(batches):
        part = TaskContext.get().partitionId()
        asking = (unpack(row) for batch in batches for row in batch.to_pylist())
        for seq, (places, ids, q) in enumerate(_pieces(asking, size)):
            nothing = np.full(len(q), NONE, np.int64)
            floor = search(places, q, nothing, pilot, k)[0][0][:, k - 1] if pilot else nothing
            yield _packed(part, seq, places, ids, q, floor=floor.tobytes())

    picked = asked.select("part", "seq", "n", "dims", "places", "ids", "matrix", "asks").mapInArrow(pick, _PACKED)
    return picked.repartition(tasks, "part", "seq").mapInArrow(run, _PACKED + ", floor binary")


def _numbered(packed: DataFrame, per: int) -> tuple[DataFrame, int]:
    """Rows with dense numbers ``no``, ``per`` rows a number, from the rows per part (one row per partition)."""
    counts = packed.groupBy("part").agg((F.max("seq") + 1).alias("rows")).orderBy("part").collect()
    base, total = [], 0
    for c in counts:
        base.append((c["part"], total))
        total += -(-c["rows"] // per)
    table = packed.sparkSession.createDataFrame(base or [(0, 0)], "part long, base long")
    return packed.join(F.broadcast(table), "part").withColumn("no", F.col("base") + F.floor(F.col("seq") / per)).drop("base"), total


def _each(df: DataFrame, name: str, count: int) -> DataFrame:
    """Every row once for each ``name`` from 0 to ``count`` - 1."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))


def _wanted(asks: DataFrame, shards: DataFrame, n_chunks: int, n_shards: int) -> DataFrame:
    """(chunk, shard) where the bound of a block of the shard reaches the threshold of a query of the chunk."""
    per_cell = SHARDS_PER_CELL
    questions = _each(asks.select("chunk", "n", "dims", "places", "ids", "matrix", "floor"), "cell", -(-n_shards // per_cell))
    extremes = _each(shards.select("shard", F.floor(F.col("shard") / per_cell).alias("cell"), "high", "low"), "chunk", n_chunks)

    def meet(asked, held):
        out = []
        blocks = [(r["shard"], np.frombuffer(r["high"], np.int64), np.frombuffer(r["low"], np.int64)) for r in held.to_pylist()]
        for row in asked.to_pylist() if blocks else []:
            _, _, q = unpack(row)
            reach = (bounds(q, [b[1:] for b in blocks]) >= np.frombuffer(row["floor"], np.int64)[:, None]).any(axis=0)
            out += [(row["chunk"], shard) for shard in sorted({b[0] for b, good in zip(blocks, reach, strict=True) if good})]
        return pa.table({"chunk": pa.array([x for x, _ in out], pa.int64()), "shard": pa.array([x for _, x in out], pa.int64())})

    return questions.groupBy("chunk", "cell").cogroup(extremes.groupBy("chunk", "cell")).applyInArrow(meet, "chunk long, shard long")


def top_k(vectors: DataFrame, ask: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every row for which ``ask`` is true."""
    spark = vectors.sparkSession
    packed = write_read(pack_blocks(vectors, ask, id_col, vec_col, scale), "blocks")
    pilot = [unpack(r.asDict()) for r in packed.where(F.col("n") > k).orderBy(F.xxhash64("part", "seq"), "part", "seq").limit(PILOT_BLOCKS).collect()]
    shards, n_shards = _numbered(packed, BLOCKS_PER_SHARD)
    asks, n_chunks = _numbered(write_read(_chunks(packed, pilot, k), "chunks"), 1)
    if not n_shards or not n_chunks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asks, shards = asks.withColumnRenamed("no", "chunk"), shards.withColumnRenamed("no", "shard")
    wanted = write_read(_wanted(asks, shards, n_chunks, n_shards), "wanted")
    left = asks.join(wanted, "chunk")
    right = shards.drop("asks", "asking", "high", "low").join(wanted, "shard")

    def meet(asked, held):
        asked = asked.to_pylist()
        blocks = [unpack(r) for r in sorted(held.to_pylist(), key=lambda r: (r["part"], r["seq"]))]
        out = [[], [], [], []]
        for row in asked if blocks else []:
            places, q_ids, q = unpack(row)
            floor = np.frombuffer(row["floor"], np.int64)
            (scores, ids), _ = search(places, q, floor, blocks, k)
            good = (scores != NONE) & (scores >= floor[:, None])
            wide = [np.repeat(x, k).reshape(-1, k)[good] for x in (places, q_ids)]
            for part, values in zip(out, (*wide, ids[good], scores[good]), strict=True):
                part.append(values)
        return pa.table({n: np.concatenate(v) if v else np.empty(0, np.int64) for n, v in zip(("place", "query_id", "vec_id", "score"), out, strict=True)})

    scored = left.groupBy("chunk", "shard").cogroup(right.groupBy("chunk", "shard")).applyInArrow(meet, "place long, query_id long, vec_id long, score long")
    order = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    known = lambda c: F.nullif(F.col(c), F.lit(NO_ID)).alias(c)
    return ranked.select(known("query_id"), "rank", known("vec_id"), "score")


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c AS (
  SELECT place, vec_id, unnest(q) AS x, unnest(range(len(q))) AS d FROM v),
s AS (
  SELECT a.place, a.vec_id AS query_id, b.place AS other, b.vec_id AS vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM c a JOIN c b ON a.d = b.d AND a.place <> b.place AND a.vec_id % 50 = 0 GROUP BY ALL),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
