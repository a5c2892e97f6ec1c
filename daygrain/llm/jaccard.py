"""N-gram Jaccard join: a grouped prefix join over word shingles.

Documents link when ``100 * intersection >= percent * union`` of their
distinct shingle sets.  The result is the connected components: one row per
document.  No pairs within a group are spelled out, and no link between
different texts is lost:

1. ``frequent``: shingles seen often come last in the global order, the most
   frequent at its end, others by hash.  Any fixed order gives right results;
   this one keeps the lists of step 4 short.  The list of frequent shingles
   has a fixed bound.
2. ``sketch``: per document its set's size and digest, its prefix (the first
   ``n - ceil(percent * n / 100) + 1`` shingles: linked sets share one of
   them) and parity bits, about one per shingle and their fold to 256.
   Equal sets fold into one class.
3. Classes with identical prefix and size fold into one group.
4. Each prefix shingle lists its groups.  Only shingles of two or more groups
   matter; a fixed-size bit filter drops most others before the shuffle.
5. First round: all pairs of groups in lists of up to ``LONG_LIST``; in
   longer ones each group meets pivots, the least groups of its list and size
   band in ``PIVOTS`` orders by hash (and each class the least class of its
   group).  The orders are the same in all lists, so a group of near copies
   meets few different pivots, and a pivot links a share of them as large as
   that of the pairs that link.  Pairs pass the size and parity bounds (those
   of short lists the position bound too), are expanded to members, pass the
   bound of the whole parity sketches and are verified on the whole sets.
6. Second round: where a long list still holds more than one component, the
   groups outside its commonest component meet all groups of the list that
   are in another component.  A row brings the first ``EARLIER`` listed
   shingles before its own, and a pair that shares one of those is left to
   that shingle's list.  (A pair that shares others meets again, which costs
   a row.)  So each pair of a list is within one component or verified.
7. Components of the verified links, joined back to every document.

Bounds: a parity bit differs for an odd number of elements, so the number of
differing bits never exceeds the size of the symmetric difference.

Defined cases: words are runs outside ``[\\x20\\x09-\\x0D]`` with A-Z in lower
case; with fewer words than ``width`` the whole sequence is the one shingle;
without words (or null text) the set is empty and links with nothing; rows
that repeat an id are one document; rows without id keep a null component;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .text import bit_filter, distinct, encode, gram_hashes, hash_words, small_batches, write_read

FREQUENT = 1 << 15
LONG_LIST = 16
PIVOTS = 4
EARLIER = 8
_BITS = [f"b{i}" for i in range(4)]


def shingles(text, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text."""
    h = hash_words(encode(text).lower().split())
    return distinct(gram_hashes(h, min(width, len(h)))) if len(h) else np.empty(0, np.uint64)


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n) // 100 + 1


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def frequent(docs: DataFrame, width: int, percent: int, counted: int = 3, limit: int = FREQUENT) -> np.ndarray:
    """At most ``limit`` shingles that are often among the least hashes of a document, the rarest first.

    Of a document the least hashes count, ``counted`` times its prefix length:
    they are the ones its prefix would hold.

    Each task keeps a summary of what it has seen more than once (singles
    are forgotten when the summary is full) and sends what it saw four times
    or more.  A miss costs speed, never a result.
    """

    def run(batches):
        tokens, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in small_batches(batches):
            found = [tokens]
            for text in batch.column("text").to_pylist():
                s = shingles(text, width)
                found.append(s[: counted * prefix_length(len(s), percent)])
            weights = np.concatenate([counts, np.ones(sum(map(len, found[1:])), np.int64)])
            tokens, where = np.unique(np.concatenate(found), return_inverse=True)
            counts = np.bincount(where, weights=weights, minlength=len(tokens)).astype(np.int64)
            if len(tokens) > 1 << 19:
                tokens, counts = tokens[counts > 1], counts[counts > 1]
        often = counts >= 4
        yield pa.RecordBatch.from_arrays([pa.array(_signed(tokens[often])), pa.array(counts[often])], names=["token", "seen"])

    seen = docs.mapInArrow(run, "token long, seen long").groupBy("token").agg(F.sum("seen").alias("seen"))
    top = seen.orderBy(F.desc("seen"), "token").limit(limit).select("token").toPandas()["token"].to_numpy(np.int64)
    return top[::-1].copy().view(np.uint64)


def parity(s: np.ndarray) -> np.ndarray:
    """Parity bits of a set: about as many as elements, a power of two, at least 256."""
    size = max(256, 1 << (max(1, len(s)) - 1).bit_length())
    odd = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def differing(x: bytes, y: bytes) -> int:
    """Differing parity bits, the longer sketch folded to the length of the shorter."""
    a, b = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    return int(np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)).sum())


def sketch(docs: DataFrame, width: int, percent: int, last: np.ndarray) -> DataFrame:
    """Per document: id, n, set digest d0 d1, group digest g0 g1, parity bits b0-b3 and parity sketch, prefix.

    The shingles of ``last`` stand after all others, in its order.
    """
    place = np.argsort(last)
    ascending = last[place]

    def run(batches):
        for batch in small_batches(batches):
            n, wide, sketches, prefixes = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, width)
                n.append(len(s))
                if len(last):
                    at = np.minimum(np.searchsorted(ascending, s), len(last) - 1)
                    late = ascending[at] == s
                    ordered = np.concatenate([s[~late], last[np.sort(place[at[late]])]])
                else:
                    ordered = s
                prefix = ordered[: prefix_length(len(s), percent)].tobytes() if len(s) else b""
                bits = parity(s)
                digest = xxhash.xxh3_128_digest(s.tobytes()) + xxhash.xxh3_128_digest(prefix, len(s))
                wide.append(digest + np.bitwise_xor.reduce(bits.reshape(-1, 32), axis=0).tobytes())
                sketches.append(bits.tobytes())
                prefixes.append(prefix)
            longs = np.frombuffer(b"".join(wide), np.int64).reshape(len(wide), 8) if wide else np.empty((0, 8), np.int64)
            columns = [batch.column("id"), pa.array(n, pa.int64()), *[pa.array(longs[:, i]) for i in range(8)], pa.array(sketches, pa.binary()), pa.array(prefixes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "d0", "d1", "g0", "g1", *_BITS, "parity", "prefix"])

    return docs.mapInArrow(run, "id long, n long, d0 long, d1 long, g0 long, g1 long, b0 long, b1 long, b2 long, b3 long, parity binary, prefix binary")


def _postings(groups: DataFrame, keep=None, known=None) -> DataFrame:
    """One row per prefix shingle of each group; ``keep`` filters shingles.

    With ``known`` a row also brings ``earlier``: the first ``EARLIER``
    shingles of the prefix that pass ``known`` and stand before its own.
    """

    def run(batches):
        for batch in small_batches(batches, "prefix"):
            found = [np.frombuffer(p, np.uint64) for p in batch.column("prefix").to_pylist()]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            tokens = np.concatenate(found) if found else np.empty(0, np.uint64)
            if keep is None:
                yield pa.RecordBatch.from_arrays([pa.array(_signed(tokens))], names=["token"])
                continue
            row = np.repeat(np.arange(len(found)), lengths)
            starts = np.cumsum(lengths) - lengths
            pos = np.arange(len(tokens)) - starts[row]
            good = keep.test(tokens)
            arrays = [pa.array(_signed(tokens[good])), pa.array(pos[good])]
            arrays += [batch.column(c).take(pa.array(row[good])) for c in names[2:8]]
            if known is not None:
                hit = known.test(tokens)
                before = np.concatenate([[0], np.cumsum(hit)])
                first = before[starts][row[good]]
                count = np.minimum(before[:-1][good] - first, EARLIER)
                offsets = np.concatenate([[0], np.cumsum(count)])
                at = np.arange(offsets[-1]) + np.repeat(first - offsets[:-1], count)
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(_signed(tokens[hit][at]))))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["token", "pos", "gid", "n", *_BITS] + (["earlier"] if known is not None else [])
    schema = ", ".join(f"{c} {'array<long>' if c == 'earlier' else 'long'}" for c in names)
    return groups.mapInArrow(run, schema if keep is not None else "token long")


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _position_fits(n: Column, i: Column, m: Column, j: Column, percent: int) -> Column:
    """Holds at the first shared shingle of every linked pair."""
    return (100 + percent) * F.least(n - i, m - j) >= percent * (n + m)


def _parity_fits(x: str, y: str, n: Column, m: Column, percent: int) -> Column:
    differ = sum((F.bit_count(F.col(f"{x}.{b}").bitwiseXOR(F.col(f"{y}.{b}"))) for b in _BITS), F.lit(0))
    return F.coalesce((100 + percent) * differ <= (100 - percent) * (n + m), F.lit(True))


def _near(pairs: DataFrame, light: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that the whole parity sketches allow: a sixty-fourth of the sets' bytes."""

    def compare(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("x", "y", "n", "m")), strict=True)
            keep = pa.array([(100 + percent) * differing(x, y) <= (100 - percent) * (n + m) for x, y, n, m in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    own = light.where(F.col("n") > 0)
    left = pairs.join(own.select(F.col("id").alias("a"), "n", F.col("parity").alias("x")), "a")
    both = left.join(own.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("parity").alias("y")), "b")
    return both.select("a", "b", "x", "y", "n", "m").mapInArrow(compare, "a long, b long").distinct()


def _verified(pairs: DataFrame, light: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The linked ones of ``pairs`` (a, b), compared on whole shingle sets."""
    pairs = write_read(_near(pairs, light, percent), "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().select(F.xxhash64("id").alias("h"))
    wanted = bit_filter(ids, "h")

    def sets(batches):
        for batch in small_batches(batches):
            hit = wanted.test(batch.column("h").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            part = batch.filter(pa.array(hit))
            found = [shingles(t, width).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, pa.binary())], names=["id", "items"])

    def compare(batches):
        for batch in small_batches(batches, "x"):
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    with_hash = docs.where(F.col("id").isNotNull()).select("id", "text", F.xxhash64("id").alias("h"))
    items = write_read(with_hash.mapInArrow(sets, "id long, items binary"), "sets")
    left = pairs.join(items.select(F.col("id").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(items.select(F.col("id").alias("b"), F.col("items").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long").distinct()


def cluster(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90, counted: int = 3) -> DataFrame:
    """One row per document: ``id_col``, n_shingles, component_id.

    ``counted`` is how many prefixes' worth of each set ``frequent`` counts; no result depends on it.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    last = frequent(docs.select("text"), width, percent, counted)
    light = write_read(sketch(docs, width, percent, last), "sketch")
    full = light.where((F.col("n") > 0) & F.col("id").isNotNull())

    classes = full.groupBy("d0", "d1", "n", "g0", "g1", *_BITS).agg(F.min("id").alias("cid"))
    single = (F.min("d0") == F.max("d0")) & (F.min("d1") == F.max("d1"))
    groups = write_read(
        full.groupBy("g0", "g1", "n", "prefix").agg(F.min("id").alias("gid"), *[F.when(single, F.min(b)).alias(b) for b in _BITS]),
        "groups",
    )
    members = write_read(
        classes.join(groups.select("g0", "g1", "n", "gid"), ["g0", "g1", "n"]).select("cid", "gid", "n", "d0", "d1", *_BITS),
        "members",
    )
    shared = _postings(groups).groupBy("token").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1)
    several = bit_filter(shared, "token")
    lists = write_read(_postings(groups, several), "lists")

    # First round: every pair of a short list; in a long one, against the pivots of its size band.
    length = lists.groupBy("token").agg(F.count(F.lit(1)).alias("length")).where(F.col("length") > 1)
    sized = write_read(lists.join(length, "token"), "sized")
    short, long_ = sized.where(F.col("length") <= LONG_LIST), sized.where(F.col("length") > LONG_LIST)
    banded = long_.withColumn("band", F.floor(F.log("n") / np.log(100 / percent)) if percent < 100 else F.col("n"))
    least = [F.min(F.struct(F.xxhash64("gid", F.lit(i)).alias("h"), "gid", "n", *_BITS)) for i in range(PIVOTS)]
    pivots = banded.groupBy("token", "band").agg(F.array_distinct(F.transform(F.array(*least), lambda p: p.dropFields("h"))).alias("p"))
    pivots = pivots.select("token", "band", F.explode("p").alias("p")).select("token", "band", "p.*")

    def fits(x, p):
        return (
            (F.col(f"{x}.token") == F.col(f"{p}.token"))
            & _sizes_fit(F.col(f"{x}.n"), F.col(f"{p}.n"), percent)
            & _parity_fits(x, p, F.col(f"{x}.n"), F.col(f"{p}.n"), percent)
        )

    def pairs_of(joined, whole):
        return joined.select(F.col("x.gid").alias("gid"), F.col("p.gid").alias("to"), F.lit(whole).alias("whole"))

    met = banded.alias("x").join(pivots.alias("p"), fits("x", "p") & (F.col("x.band") == F.col("p.band")) & (F.col("x.gid") != F.col("p.gid")))
    placed_well = _position_fits(F.col("x.n"), F.col("x.pos"), F.col("p.n"), F.col("p.pos"), percent)
    every = short.alias("x").join(short.alias("p"), fits("x", "p") & placed_well & (F.col("x.gid") > F.col("p.gid")))
    met = write_read(pairs_of(met, False).union(pairs_of(every, True)).distinct(), "met")
    own = members.where(F.col("cid") != F.col("gid")).select("cid", F.col("gid").alias("to"), "n", *_BITS)
    # A short list's pair stands for all members of both groups, a pivot for its least class.
    chosen = members.join(met, "gid").select("cid", "to", "n", *_BITS, "whole").union(own.withColumn("whole", F.lit(False)).select("cid", "to", "n", *_BITS, "whole")).alias("x")
    others = members.alias("y")
    first = (
        chosen.join(
            others,
            (F.col("x.to") == F.col("y.gid"))
            & (F.col("x.whole") | (F.col("y.cid") == F.col("y.gid")))
            & (F.col("x.cid") != F.col("y.cid"))
            & _sizes_fit(F.col("x.n"), F.col("y.n"), percent)
            & _parity_fits("x", "y", F.col("x.n"), F.col("y.n"), percent),
        )
        .select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b"))
        .distinct()
    )
    found = components(_verified(first, light, docs, width, percent))

    # Second round: what a long list still holds besides its commonest component.
    placed = write_read(
        members.join(found.withColumnRenamed("id", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid")).drop("d0", "d1"),
        "placed",
    )
    span = placed.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    spread = long_.select("token", "gid").join(span, "gid")
    uniform = F.col("lo") == F.col("hi")
    # A group of several components counts for none.
    held = spread.groupBy("token", F.when(uniform, F.col("lo")).alias("comp")).agg(F.count(F.lit(1)).alias("c"))
    commonest = F.max(F.when(F.col("comp").isNotNull(), F.struct("c", "comp")))
    main = held.groupBy("token").agg(commonest.alias("m"), F.count(F.lit(1)).alias("several"), F.max(F.isnull("comp")).alias("torn"))
    main = main.where((F.col("several") > 1) | F.col("torn")).select("token", F.col("m.comp").alias("main"))
    main = write_read(main, "main")
    # A pair meets once: where neither group has an earlier shingle of the other.
    mixed = _postings(groups, bit_filter(main, "token"), several).join(main, "token").join(span, "gid")
    outside = ~F.coalesce(uniform & (F.col("lo") == F.col("main")), F.lit(False))
    listed = write_read(mixed.withColumn("outside", outside).drop("main"), "listed")
    r, a = listed.where("outside").alias("r"), listed.alias("a")
    apart = (
        (F.col("r.gid") != F.col("a.gid"))
        & (~F.col("a.outside") | (F.col("r.gid") < F.col("a.gid")))
        & ~((F.col("r.lo") == F.col("r.hi")) & (F.col("a.lo") == F.col("a.hi")) & (F.col("r.lo") == F.col("a.lo")))
        & _sizes_fit(F.col("r.n"), F.col("a.n"), percent)
        & _position_fits(F.col("r.n"), F.col("r.pos"), F.col("a.n"), F.col("a.pos"), percent)
        & _parity_fits("r", "a", F.col("r.n"), F.col("a.n"), percent)
        & ~F.arrays_overlap("r.earlier", "a.earlier")
    )
    meet = r.join(a, (F.col("r.token") == F.col("a.token")) & apart).select(F.col("r.gid").alias("g"), F.col("a.gid").alias("to")).distinct()
    torn = span.where(~uniform).select(F.col("gid").alias("g"), F.col("gid").alias("to"))
    meet = meet.union(torn)
    y = placed.select(F.col("gid").alias("to"), F.col("cid").alias("other"), F.col("comp").alias("other_comp"), F.col("n").alias("m"), *_BITS).alias("y")
    z = placed.withColumnRenamed("gid", "g").join(meet, "g").alias("z")
    second = (
        z.join(
            y,
            (F.col("z.to") == F.col("y.to"))
            & (F.col("z.comp") != F.col("y.other_comp"))
            & ((F.col("z.g") != F.col("z.to")) | (F.col("z.cid") < F.col("y.other")))
            & _sizes_fit(F.col("z.n"), F.col("y.m"), percent)
            & _parity_fits("z", "y", F.col("z.n"), F.col("y.m"), percent),
        )
        .select(F.col("z.cid").alias("a"), F.col("y.other").alias("b"))
        .distinct()
    )
    more = _verified(second, light, docs, width, percent)
    final = components(more.union(found.select(F.col("id").alias("a"), F.col("comp").alias("b"))))

    ids = members.select("d0", "d1", "n", "cid").join(final.withColumnRenamed("id", "cid"), "cid", "left")
    ids = ids.select("d0", "d1", "n", F.coalesce("comp", "cid").alias("component_id"))
    linked = light.select("id", "n", "d0", "d1").join(ids, ["d0", "d1", "n"], "left")
    whole = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return linked.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), whole.alias("component_id"))
