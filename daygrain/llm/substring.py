"""Substring dedup by super-k-mer partitioning.

A window is ``width`` consecutive words; a word goes when some window over it
has a word sequence that starts anywhere else too.  Per window the least
hash of its ``width - 31`` word grams is its minimiser; equal windows have
equal minimisers.  Consecutive windows that share one travel together as one
packed string (their words joined by a space) to the minimiser's bucket:

1. ``_minimisers``: minimisers that occur once in the corpus cannot hold a
   repeated window, and only the rest travel.  A fixed-size bit filter
   carries them to the second scan (a full filter sends more, never less).
2. ``_super_kmers``: packed strings, each text and string as a 128-bit digest;
   equal strings fold into one with a count, combined map-side, so a passage
   that a third of all documents repeat is one row in its bucket.
3. ``_counted``: buckets are dealt by minimiser; sorting a bucket's windows
   brings equal ones together, and neighbours are compared word by word.  A
   bucket of more than ``spread`` different strings (near copies of one
   passage) is dealt in parts: what repeats within a part is decided there,
   and single windows meet across the parts under 128-bit digests.
4. Runs of repeated windows go back to the texts that hold the strings.  Texts
   without any take no part in that shuffle.

Defined cases: null text has no words; words are runs outside
``[\\x20\\x09-\\x0D]``, unchanged; texts shorter than a window lose nothing;
repeated rows are different places, so all their full windows go; null ids
stay null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import bit_filter, encode, gram_hashes, hash_words, mix64, small_batches, write_read

WIDTH = 35
SPAN = 32  # grams per window: a power of two, so a sliding minimum is five steps
SPREAD = 1024


def window_minima(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The minimiser of every window, and the gram hashes."""
    grams = gram_hashes(h, width - SPAN + 1)
    least, step = grams, 1
    while step < SPAN:
        if len(least) <= step:
            return np.empty(0, np.uint64), grams
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    return least, grams


def runs(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal neighbours, and the end of the last."""
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])


def _minimisers(texts: DataFrame, width: int) -> DataFrame:
    """One row per super-k-mer; two if its minimiser occurs again in the same text."""

    def run(batches):
        for batch in small_batches(batches):
            found = []
            for text in batch.column("text").to_pylist():
                least, grams = window_minima(hash_words(encode(text).split()), width)
                if len(least):
                    heads = least[runs(least)[:-1]]
                    ordered = np.sort(grams)
                    again = ordered[1:][ordered[1:] == ordered[:-1]]
                    found.append(heads)
                    if len(again):
                        found.append(heads[np.isin(heads, again)])
            out = np.concatenate(found) if found else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], names=["bucket"])

    return texts.mapInArrow(run, "bucket long")


_KMER = "bucket long, p0 long, p1 long, t0 long, t1 long, at long, packed binary"


def _super_kmers(texts: DataFrame, width: int, keep) -> DataFrame:
    """Occurrences of super-k-mers; the packed words stand in the first row of each string in a task."""

    def run(batches):
        seen: set[bytes] = set()
        for batch in small_batches(batches):
            if len(seen) > 200_000:
                seen.clear()
            heads, digests, starts, packed = [], [], [], []
            for text in batch.column("text").to_pylist():
                raw = encode(text)
                words = raw.split()
                least, _ = window_minima(hash_words(words), width)
                if not len(least):
                    continue
                edges = runs(least)
                good = np.flatnonzero(keep.test(least[edges[:-1]]))
                if not len(good):
                    continue
                own = xxhash.xxh3_128_digest(raw)
                for i in good.tolist():
                    a, b = int(edges[i]), int(edges[i + 1])
                    string = b" ".join(words[a : b + width - 1])
                    digest = xxhash.xxh3_128_digest(string)
                    heads.append(least[a])
                    digests.append(digest + own)
                    starts.append(a)
                    packed.append(None if digest in seen else string)
                    seen.add(digest)
            longs = np.frombuffer(b"".join(digests), np.int64).reshape(len(digests), 4) if digests else np.empty((0, 4), np.int64)
            first = pa.array(np.array(heads, np.uint64).view(np.int64))
            columns = [first, *[pa.array(longs[:, i]) for i in range(4)], pa.array(starts, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "p0", "p1", "t0", "t1", "at", "packed"])

    return texts.mapInArrow(run, _KMER)


def _equal_neighbours(ids: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Whether windows ``starts[i]`` and ``starts[i + 1]`` hold the same words."""
    out = np.ones(max(0, len(starts) - 1), bool)
    for i in range(width):
        column = ids[starts + i]
        out &= column[1:] == column[:-1]
    return out


def repeated_windows(strings: list[bytes], times: np.ndarray, width: int) -> list[np.ndarray]:
    """For each packed string the run bounds of windows whose total count is two or more."""
    numbers: dict[bytes, int] = {}
    parts = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in s.split(b" ")), np.int64) for s in strings]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ids = np.concatenate(parts) if parts else np.empty(0, np.int64)
    windows = np.maximum(lengths - width + 1, 0)
    owner = np.repeat(np.arange(len(parts)), windows)
    first = np.cumsum(windows) - windows
    starts = np.arange(len(owner)) - first[owner] + (np.cumsum(lengths) - lengths)[owner]
    if not len(starts):
        return [np.empty(0, np.int64) for _ in strings]
    h = gram_hashes(mix64(ids.astype(np.uint64) + np.uint64(1)), width)[starts]
    order = np.argsort(h, kind="stable")
    same = _equal_neighbours(ids, starts[order], width)
    clash = (h[order][1:] == h[order][:-1]) & ~same
    if clash.any():  # different windows under one hash: order those by their words
        order = np.array(sorted(range(len(starts)), key=lambda i: (int(h[i]), ids[starts[i] : starts[i] + width].tobytes())))
        same = _equal_neighbours(ids, starts[order], width)
    group = np.concatenate([[0], np.cumsum(~same)])
    total = np.bincount(group, weights=times[owner[order]])
    repeated = np.empty(len(starts), bool)
    repeated[order] = total[group] >= 2
    out = []
    for i in range(len(strings)):
        flags = np.concatenate([[False], repeated[first[i] : first[i] + windows[i]], [False]])
        out.append(np.flatnonzero(flags[1:] != flags[:-1]))
    return out


def _counted(strings: DataFrame, width: int) -> DataFrame:
    """Count windows in parts of buckets: strings (bucket, part, parts, p0, p1, times, packed), dealt and sorted.

    Rows with ``marks``: runs of windows repeated within the part, per string
    (p0, p1).  Rows with a window digest (w0, w1), for buckets of several
    parts: each window that the part holds repeatedly, once with its count,
    and each it holds once, with its string and place.
    """

    def count(table):
        packed, times = table.column("packed").to_pylist(), table.column("times").to_numpy()
        p = [table.column(c).to_numpy() for c in ("p0", "p1")]
        marks = repeated_windows(packed, times, width)
        good = [i for i, m in enumerate(marks) if len(m)]
        empty = pa.nulls(len(good), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(p[0][good]), pa.array(p[1][good]), pa.array([marks[i] for i in good], pa.list_(pa.int64())), empty, empty, empty, empty], names=_COUNTED)
        wide = np.flatnonzero(table.column("parts").to_numpy() > 1)
        if not len(wide):
            return
        words = [packed[i].split(b" ") for i in wide]
        digests = [np.concatenate([gram_hashes(hash_words(w, seed), width) for w in words]) for seed in (1, 2)]
        windows = np.fromiter((len(w) - width + 1 for w in words), np.int64, len(words))
        owner = np.repeat(wide, windows)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        order = np.lexsort(digests[::-1])
        a, b = (d[order] for d in digests)
        heads = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        total = np.add.reduceat(times[owner[order]], heads)
        first = order[heads]
        # Null where repeated: that is decided here, and only lends its count to other parts.
        place = [pa.array(v, mask=total > 1) for v in (p[0][owner[first]], p[1][owner[first]], at[first])]
        none = pa.nulls(len(heads), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([place[0], place[1], none, pa.array(a[heads].view(np.int64)), pa.array(b[heads].view(np.int64)), pa.array(total), place[2]], names=_COUNTED)

    def run(batches):
        held = None
        for batch in small_batches(batches, "packed", 1 << 20):
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            bucket, part = table.column("bucket").to_numpy(), table.column("part").to_numpy()
            last = np.flatnonzero((bucket != bucket[-1]) | (part != part[-1])) if len(bucket) else np.empty(0, np.int64)
            cut = int(last[-1]) + 1 if len(last) else 0
            held = table.slice(cut)
            if cut:
                yield from count_groups(table.slice(0, cut))
        if held is not None and held.num_rows:
            yield from count_groups(held)

    def count_groups(table):
        """Parts of wide buckets are counted one by one, all other buckets at once."""
        parts = table.column("parts").to_numpy()
        if (parts == 1).any():
            yield from count(table.filter(pa.array(parts == 1)))
        wide = table.filter(pa.array(parts > 1))
        if wide.num_rows:
            bucket, part = wide.column("bucket").to_numpy(), wide.column("part").to_numpy()
            edges = [0, *(np.flatnonzero((bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])) + 1).tolist(), wide.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                yield from count(wide.slice(a, b - a))

    dealt = strings.select("bucket", "part", "parts", "p0", "p1", "times", "packed").repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    return dealt.mapInArrow(run, "p0 long, p1 long, marks array<long>, w0 long, w1 long, times long, w long")


_COUNTED = ["p0", "p1", "marks", "w0", "w1", "times", "w"]


def _marks(texts: DataFrame, width: int, spread: int) -> DataFrame:
    """(t0, t1, marks): per text the flat bounds of its runs of repeated windows."""
    often = _minimisers(texts, width).groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1)
    found = write_read(_super_kmers(texts, width, bit_filter(often, "bucket")), "super-kmers")
    strings = write_read(
        found.groupBy("bucket", "p0", "p1").agg(F.count(F.lit(1)).alias("times"), F.first("packed", ignorenulls=True).alias("packed")),
        "strings",
    )
    load = strings.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"))
    dealt = strings.join(load, "bucket").withColumn("parts", F.ceil(F.col("c") / spread))
    counted = write_read(_counted(dealt.withColumn("part", F.pmod("p0", "parts")), width), "counted")
    few = counted.where(F.col("w0").isNull()).select("p0", "p1", "marks")
    single = counted.where(F.col("w0").isNotNull())
    twice = single.groupBy("w0", "w1").agg(F.sum("times").alias("c")).where(F.col("c") > 1).select("w0", "w1")
    # Each window on its own: the bounds [w, w + 1) need no merging here.
    many = single.where(F.col("p0").isNotNull()).join(twice, ["w0", "w1"]).groupBy("p0", "p1").agg(F.collect_list("w").alias("w"))
    many = many.select("p0", "p1", F.flatten(F.transform("w", lambda w: F.array(w, w + 1))).alias("marks"))
    places = found.select("t0", "t1", "at", "p0", "p1").distinct().join(few.union(many), ["p0", "p1"])
    shifted = F.transform("marks", lambda m: m + F.col("at"))
    return places.groupBy("t0", "t1").agg(F.flatten(F.collect_list(shifted)).alias("marks"))


def covered(n: int, marks, width: int) -> np.ndarray:
    """Which of ``n`` words lie in a marked window (flat bounds of window runs)."""
    bounds = np.asarray(marks, np.int64).reshape(-1, 2)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, bounds[:, 0], 1)
    np.add.at(change, bounds[:, 1] + width - 1, -1)
    return np.cumsum(change[:n]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, spread: int = SPREAD) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256, kept (the words left, joined by a space; null if nothing was removed)."""
    if width < SPAN:
        raise ValueError(f"windows have at least {SPAN} words")
    texts = docs.select(F.col(text_col).alias("text"))
    marks = write_read(_marks(texts, width, spread), "marks")
    touched = bit_filter(marks.select(F.col("t0").alias("h")), "h")
    id_type = docs.schema[id_col].dataType.simpleString()
    result = f"id {id_type}, n_words long, n_removed long, kept_sha256 string, kept string"

    def split(batches):
        for batch in small_batches(batches):
            raws = [encode(t) for t in batch.column("text").to_pylist()]
            digests = b"".join(xxhash.xxh3_128_digest(r) for r in raws)
            longs = np.frombuffer(digests, np.int64).reshape(len(raws), 2) if raws else np.empty((0, 2), np.int64)
            hit = touched.test(np.ascontiguousarray(longs[:, 0]).view(np.uint64))
            words = [r.split() for r in raws]
            sums = [None if hit[i] else hashlib.sha256(b" ".join(w)).hexdigest() for i, w in enumerate(words)]
            texts_ = [raws[i] if hit[i] else None for i in range(len(raws))]
            columns = [batch.column("id"), pa.array(longs[:, 0]), pa.array(longs[:, 1]), pa.array([len(w) for w in words], pa.int64()), pa.array(sums, pa.string()), pa.array(texts_, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "t0", "t1", "n_words", "sum", "raw"])

    def finish(batches):
        for batch in small_batches(batches, "raw"):
            removed, sums, kept = [], [], []
            for raw, done, marks_ in zip(batch.column("raw").to_pylist(), batch.column("sum").to_pylist(), batch.column("marks").to_pylist(), strict=True):
                words = (raw or b"").split() if done is None else []
                gone = covered(len(words), marks_ or [], width)
                left = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                removed.append(int(gone.sum()))
                sums.append(done or hashlib.sha256(left).hexdigest())
                kept.append(left.decode("utf-8", "replace") if gone.any() else None)
            columns = [batch.column("id"), batch.column("n_words"), pa.array(removed, pa.int64()), pa.array(sums, pa.string()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_removed", "kept_sha256", "kept"])

    first = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    first = first.mapInArrow(split, f"id {id_type}, t0 long, t1 long, n_words long, sum string, raw binary")
    both = first.join(marks, ["t0", "t1"], "left").select("id", "n_words", "sum", "raw", "marks")
    return both.mapInArrow(finish, result).withColumnRenamed("id", id_col)
