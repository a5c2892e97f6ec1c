"""Mixing sources to target weights by min-cost flow.

1. Documents are aggregated by membership pattern (the set of sources a
   document belongs to) to the words each pattern holds.
2. Targets: sources share a budget by weight, none above ``max_epochs``
   times the words it can reach; what is over goes to the others by weight.
3. A min-cost flow routes the patterns' words to the sources' targets.  The
   first use of a pattern's words is free, the second costs 1, the third 2:
   convex repetition costs, so nothing is repeated while fresh words are left.
   The network has a node per pattern and source, whatever the corpus holds.
4. Each (pattern, source) flow picks documents in seeded hash order: by a
   hash of id, sources and text, and where those are equal by a hash of the
   row's own number.  The order's prefix sums are taken over hash bins, in
   ``LEVELS`` levels of 4,096, so no task holds a source and a group of equal
   rows is divided too; one more row closes most of the gap.

Driver-side state is one row per pattern and per source; ``max_patterns``
bounds it (beyond, the operator raises: it drops nothing).

Defined cases: null text has no words and is never taken; a null source is
the last source; sources without words get target 0; rows without id, with
an id that stands elsewhere too, and repeated rows are each decided alone;
an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import WORD, numbered, write_read

BINS, BIN_BITS, LEVELS = 4096, 12, 4


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict, weights: dict, budget: float, max_epochs: float) -> dict:
    """Shares of ``budget`` by weight, none above ``max_epochs`` times its size."""
    out: dict = {}
    open_ = [s for s in sizes if sizes[s] > 0 and weights[s] > 0]
    left = float(budget)
    while open_:
        total = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / total > max_epochs * sizes[s]]
        if not over:
            out |= {s: left * weights[s] / total for s in open_}
            break
        for s in over:
            out[s] = float(max_epochs * sizes[s])
        left -= sum(out[s] for s in over)
        open_ = [s for s in open_ if s not in out]
    return {s: out.get(s, 0.0) for s in sizes}


def min_cost_flow(capacity: dict, members: dict, quota: dict, epochs: int) -> dict:
    """Words to take: {(pattern, source): words}.

    ``capacity[p]`` words per epoch of pattern ``p``, usable by the sources
    in ``members[p]``, at cost ``e`` in epoch ``e``; ``quota[s]`` words wanted
    by ``s``.  Successive shortest paths with potentials: every augmentation
    fills an epoch of a pattern, a quota, or empties a flow.
    """
    nodes = {"S": 0, "T": 1}
    for p in capacity:
        nodes["p", p] = len(nodes)
    for s in quota:
        nodes["s", s] = len(nodes)
    graph: list[list[int]] = [[] for _ in nodes]
    to, cap, cost = [], [], []

    def edge(a, b, c, w):
        for x, y, cc, ww in ((a, b, c, w), (b, a, 0, -w)):
            graph[x].append(len(to))
            to.append(y)
            cap.append(cc)
            cost.append(ww)
        return len(to) - 2

    routes = {}
    for p, words in capacity.items():
        for e in range(epochs):
            edge(0, nodes["p", p], words, e)
        for s in members[p]:
            if s in quota:
                routes[p, s] = edge(nodes["p", p], nodes["s", s], words * epochs, 0)
    for s, words in quota.items():
        edge(nodes["s", s], 1, words, 0)
    price = [0] * len(nodes)
    while True:
        far = {0: 0}
        done, via = set(), {}
        queue = [(0, 0)]
        while queue:
            d, x = heapq.heappop(queue)
            if x in done:
                continue
            done.add(x)
            for i in graph[x]:
                if cap[i] > 0 and to[i] not in done:
                    nd = d + cost[i] + price[x] - price[to[i]]
                    if nd < far.get(to[i], 1 << 62):
                        far[to[i]] = nd
                        via[to[i]] = i
                        heapq.heappush(queue, (nd, to[i]))
        if 1 not in far:
            break
        for x in range(len(nodes)):
            price[x] += min(far.get(x, far[1]), far[1])
        path, x = [], 1
        while x != 0:
            path.append(via[x])
            x = to[via[x] ^ 1]
        push = min(cap[i] for i in path)
        for i in path:
            cap[i] -= push
            cap[i ^ 1] += push
    return {k: cap[i ^ 1] for k, i in routes.items() if cap[i ^ 1] > 0}


def cuts(rows: DataFrame, wants: dict[str, int]) -> dict[str, tuple[int, int]]:
    """Per pick the position below which its rows together hold at most ``wants`` words, and the words still missing.

    ``rows`` has (pick, size, pos), with positions of ``LEVELS`` digits of
    ``BIN_BITS`` bits.  Each level sums the words per bin of the one bin that
    the level before could not take whole: at most ``BINS`` rows per pick
    reach a task, one row per pick the driver.
    """
    spark, done, open_ = rows.sparkSession, {}, {p: (0, w) for p, w in wants.items()}
    for level in range(LEVELS):
        if not open_:
            break
        below = BIN_BITS * (LEVELS - 1 - level)
        at = spark.createDataFrame([(p, start, left) for p, (start, left) in open_.items()], "pick string, start long, left long")
        inside = rows.join(F.broadcast(at), "pick").where(F.shiftright("pos", below + BIN_BITS) == F.shiftright("start", below + BIN_BITS))
        words = inside.groupBy("pick", "left", F.shiftright("pos", below).alias("bin")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("pick").orderBy("bin"))
        edges = words.withColumn("upto", upto).where(F.col("upto") > F.col("left"))
        found = edges.groupBy("pick").agg(F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("before"))).alias("edge")).collect()
        reached = {r["pick"]: (r["edge"]["bin"] << below, open_[r["pick"]][1] - r["edge"]["before"]) for r in found}
        # a pick without an edge takes all that is left of it
        done |= {p: (1 << (BIN_BITS * LEVELS), 0) for p in open_ if p not in reached}
        open_ = reached
    return done | open_


def mix(
    docs: DataFrame,
    members: Column,
    weights,
    id_col: str = "doc_id",
    text_col: str = "text",
    budget_ratio: float = 1.5,
    max_epochs: int = 2,
    seed: int = 20,
    max_patterns: int = 200_000,
    carry=(),
    number_col: str | None = None,
) -> tuple[DataFrame, dict, dict]:
    """One row per document: id, pattern, size, taken, ``carry``; plus targets and sizes per source.

    ``members`` is the array of sources a document belongs to; ``weights``
    maps the sorted list of sources to a weight each.  ``number_col`` names a
    long of its own for every row (``text.numbered``); without it, rows are
    numbered here.
    """
    if number_col is None:
        number_col = "__mix_row"
        docs = numbered(docs, number_col)
    names = F.transform(F.array_sort(F.array_distinct(members)), lambda x: x.cast("string"))
    base = write_read(
        docs.select(
            F.col(id_col).alias("id"),
            word_count(F.col(text_col)).alias("size"),
            F.to_json(names).alias("pattern"),
            # two digits by what the row holds, two by its number
            (
                F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), names, F.col(text_col)), 40).bitwiseAND(F.lit((1 << 24) - 1)) * (1 << 24)
                + F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(number_col)), 40)
            ).alias("pos"),
            F.col(number_col).alias("no"),
            *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)],
        ),
        "mix-sizes",
    )
    found = base.groupBy("pattern").agg(F.sum("size").alias("words")).limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns: raise max_patterns")
    capacity = {r["pattern"]: int(r["words"] or 0) for r in found}
    belongs = {p: json.loads(p) for p in capacity}
    sizes: dict = {}
    for p, words in capacity.items():
        for s in belongs[p]:
            sizes[s] = sizes.get(s, 0) + words
    goal = targets(sizes, weights(list(sizes)), budget_ratio * sum(capacity.values()), max_epochs)
    flow = min_cost_flow(capacity, belongs, {s: round(t) for s, t in goal.items()}, max_epochs)
    taken_by = {}
    for (p, _), words in flow.items():
        taken_by[p] = taken_by.get(p, 0) + words
    spark = docs.sparkSession
    shares = {p: divmod(total, capacity[p]) for p, total in taken_by.items() if capacity[p] > 0}
    rows = base.withColumnRenamed("pattern", "pick")
    limits = cuts(rows.select("pick", "size", "pos"), {p: want for p, (_, want) in shares.items() if want})
    plan = [(p, epochs, *limits.get(p, (0, 0))) for p, (epochs, _) in shares.items()]
    plan = spark.createDataFrame(plan or [("", 0, 0, 0)], "pick string, whole long, cut long, rest long")
    marked = rows.join(F.broadcast(plan), "pick", "left").na.fill(0, ["whole", "cut", "rest"])
    marked = marked.withColumn("chosen", F.col("pos") < F.col("cut"))
    gap = F.abs(F.col("rest") - F.col("size"))
    closing = (
        marked.where(~F.col("chosen") & (F.col("size") > 0) & (gap < F.col("rest")))
        .groupBy("pick")
        .agg(F.min(F.struct(gap.alias("gap"), F.col("pos"), F.col("no"))).alias("best"))
        .select("pick", F.col("best.no").alias("closing_no"))
    )
    out = marked.join(F.broadcast(closing), "pick", "left")
    extra = F.col("chosen") | F.coalesce(F.col("no") == F.col("closing_no"), F.lit(False))
    copies = F.col("whole") + F.when(extra, 1).otherwise(0)
    result = out.select(
        F.col("id").alias(id_col),
        F.col("pick").alias("pattern"),
        "size",
        (F.col("size") * copies).alias("taken"),
        copies.alias("copies"),
        *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)],
    )
    return result, goal, sizes
