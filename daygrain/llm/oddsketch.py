"""MinHash near-dedup with odd sketches.

Documents link when ``100 * intersection >= percent * union`` of their
distinct shingle sets.  The result is the connected components, one row per
document:

1. ``sketch``: per document the set's size and digest, ``BANDS * ROWS``
   MinHash samples, one key per band of samples, and the odd sketch: every
   sample (its number and value) flips one of ``BITS`` bits.  A second odd
   sketch folds in the whole set.  Equal sets fold into one class.
2. Two sketches differ in at most two bits for each sample that differs, and
   linked sets differ in a binomial number of samples, so ``most_differing``
   bounds the XOR population count of linked pairs; ``similarity`` turns the
   count into an estimate, which is precise where similarities are high.  The
   whole sets' sketches differ in no more bits than the sets in elements,
   which decides small sets without risk.
3. Bands: classes under one key are candidates.  Short lists give all pairs;
   in longer ones each class meets the least class, and of those the
   ``PIVOTS`` least.  Pairs that sizes and odd sketches allow are verified on
   their full shingle sets.
4. Where a long list still holds several components, the classes outside its
   least class's component meet all classes of the list, in blocks of
   ``BLOCK`` by ``BLOCK`` sketches: a task holds two blocks, compares their
   sketches and returns only the pairs that pass, each from the first list
   that holds both; these are verified too.
5. Components of the verified links, joined back to every document.

Bands miss a pair of similarity s with probability ``(1 - s ** ROWS) **
BANDS``: 5e-8 at 0.8 and less above; the sketch bound drops a linked pair
with probability ``RISK``.  Nothing else is lost, and no list is cut.

Defined cases: words are runs outside ``[\\x20\\x09-\\x0D]`` with A-Z in lower
case; with fewer words than ``width`` the whole sequence is the one shingle;
without words (or null text) the set is empty and links with nothing; rows
that repeat an id and a text are one document; under an id that stands on
several texts each row is linked by its own text; rows without id take no
part: they keep a null component and are ``kept``; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .text import bit_filter, distinct, encode, gram_hashes, hash_words, mix64, small_batches, write_read

BANDS, ROWS = 32, 4
BITS = 1024
RISK = 1e-9
#: Lists up to this length give all their pairs at once.
LONG_LIST = 16
#: Least classes of long lists that a class meets first.
PIVOTS = 4
#: Sketches a task holds from each side of a long list.
BLOCK = 2048


def shingles(text, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text."""
    h = hash_words(encode(text).lower().split(), seed=11)
    return distinct(gram_hashes(h, min(width, len(h)))) if len(h) else np.empty(0, np.uint64)


@cache
def _factors(count: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.arange(1, count + 1, dtype=np.uint64)
    return mix64(base * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1), mix64(base + np.uint64(1 << 32))


def minhashes(sets: list[np.ndarray], count: int) -> np.ndarray:
    """The samples of every set, sets x count; an empty set has all bits set."""
    out = np.full((len(sets), count), ~np.uint64(0))
    full = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    if not len(full):
        return out
    factors, offsets = _factors(count)
    # sets in runs of bounded length, longer sets in steps of their own
    run, held = [], 0
    for i in [*full.tolist(), -1]:
        if run and (i < 0 or held + len(sets[i]) > 1 << 17):
            x = np.concatenate([sets[j] for j in run])
            starts = np.cumsum([0, *(len(sets[j]) for j in run[:-1])])
            for c in range(count):
                out[run, c] = np.minimum.reduceat((x ^ offsets[c]) * factors[c], starts)
            run, held = [], 0
        if i >= 0:
            run.append(i)
            held += len(sets[i])
    return out


def odd_sketches(samples: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Parity bitmaps of the samples (bytes, rows x bits / 8): sample c of value v flips bit ``hash(c, v)``."""
    rows, count = samples.shape
    at = (mix64(samples + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount((np.arange(rows)[:, None] * bits + at).ravel(), minlength=rows * bits) & 1
    return np.packbits(odd.reshape(rows, bits).astype(np.uint8), axis=1, bitorder="little")


def set_sketches(sets: list[np.ndarray], bits: int = BITS) -> np.ndarray:
    """Parity bitmaps of whole sets (bytes, rows x bits / 8)."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = (np.concatenate([np.empty(0, np.uint64), *sets]) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(row * bits + at, minlength=len(sets) * bits) & 1
    return np.packbits(odd.reshape(len(sets), bits).astype(np.uint8), axis=1, bitorder="little")


def similarity(differing, samples: int, bits: int = BITS):
    """Estimated Jaccard similarity from the differing bits of two odd sketches of ``samples`` samples."""
    part = np.minimum(2 * np.asarray(differing, float) / bits, 1 - 1e-9)
    return 1 + bits / (4 * samples) * np.log1p(-part)


@cache
def most_differing(samples: int, percent: int, risk: float = RISK) -> int:
    """Differing bits that a pair at ``percent`` exceeds with probability ``risk`` at most."""
    p, above = 1 - percent / 100, 1.0
    for m in range(samples + 1):
        above -= math.comb(samples, m) * p**m * (1 - p) ** (samples - m)
        if above <= risk:
            return 2 * m
    return 2 * samples


def sketch(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """Per document (id, text): id, n, set digest d0 d1, odd sketches (of the samples, then of the set), band keys."""

    def run(batches):
        for batch in small_batches(batches):
            sets = [shingles(t, width) for t in batch.column("text").to_pylist()]
            samples = minhashes(sets, bands * rows)
            digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)
            grouped = samples.reshape(len(sets), bands, rows)
            keys = np.zeros((len(sets), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
            for r in range(rows):
                keys = mix64(keys ^ grouped[:, :, r])
            odd = np.concatenate([odd_sketches(samples), set_sketches(sets)], axis=1)
            columns = [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1])]
            columns += [pa.array([x.tobytes() for x in odd], pa.binary()), pa.array([x.tobytes() for x in keys], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "d0", "d1", "odd", "keys"])

    return docs.mapInArrow(run, "id long, n long, d0 long, d1 long, odd binary, keys binary")


def _postings(classes: DataFrame, keep=None) -> DataFrame:
    """One row per class and band key; with ``keep`` (a bit filter) those of its keys, with the class and its size."""
    names = ["key"] if keep is None else ["key", "cid", "n"]

    def run(batches):
        for batch in batches:
            keys = [np.frombuffer(k, np.uint64) for k in batch.column("keys").to_pylist()]
            flat = np.concatenate(keys) if keys else np.empty(0, np.uint64)
            if keep is None:
                yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], names=names)
                continue
            good = keep.test(flat)
            row = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys])[good])
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64)[good]), batch.column("cid").take(row), batch.column("n").take(row)], names=names)

    return classes.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _sizes_fit(n: str, m: str, percent: int):
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _rows(column, kind=np.uint64) -> np.ndarray:
    """A column of equally long binaries as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def allowed(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, percent: int, most: int) -> np.ndarray:
    """Whether pairs of sketches, of sets with ``sizes`` elements in all, may be linked."""
    differ = np.bitwise_count(x ^ y)
    half = differ.shape[1] // 2
    whole = (100 + percent) * differ[:, half:].sum(axis=1, dtype=np.int64) <= (100 - percent) * sizes
    return whole & (differ[:, :half].sum(axis=1, dtype=np.int64) <= most)


def _by_sketch(pairs: DataFrame, classes: DataFrame, percent: int, most: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that the odd sketches allow."""

    def compare(batches):
        for batch in batches:
            sizes = batch.column("n").to_numpy() + batch.column("m").to_numpy()
            near = pa.array(allowed(_rows(batch.column("x")), _rows(batch.column("y")), sizes, percent, most))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(near), batch.column("b").filter(near)], names=["a", "b"])

    left = pairs.join(classes.select(F.col("cid").alias("a"), F.col("odd").alias("x"), "n"), "a")
    both = left.join(classes.select(F.col("cid").alias("b"), F.col("odd").alias("y"), F.col("n").alias("m")), "b")
    return both.select("a", "b", "x", "y", "n", "m").mapInArrow(compare, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The linked ones of ``pairs`` (a, b), confirmed on full shingle sets."""
    pairs = write_read(pairs, "odd-pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().select(F.xxhash64("id").alias("h"))
    wanted = bit_filter(ids, "h")

    def sets(batches):
        for batch in small_batches(batches):
            hit = wanted.test(batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64))
            part = batch.filter(pa.array(hit))
            found = [shingles(t, width).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, pa.binary())], names=["id", "items"])

    def compare(batches):
        for batch in small_batches(batches, "x"):
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                either = np.sort(np.concatenate([x, y]))
                both = int((either[1:] == either[:-1]).sum())
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    hashed = docs.where(F.col("id").isNotNull()).select("id", "text", F.xxhash64("id").alias("h"))
    items = write_read(hashed.mapInArrow(sets, "id long, items binary"), "odd-sets")
    left = pairs.join(items.select(F.col("id").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(items.select(F.col("id").alias("b"), F.col("items").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long").distinct()


def _apart(lists: DataFrame, classes: DataFrame, found: DataFrame, percent: int, most: int, block: int) -> DataFrame:
    """Pairs (a, b) of long lists in different components that sizes and odd sketches allow.

    Classes outside the component of the list's least class (``asked``) meet
    all classes of the list (``held``), in numbered blocks.  A pair counts in
    the first band whose key both have: that band's list is short, so the
    pair has met, or long, with both in different components there as well.
    """
    comp = found.select(F.col("id").alias("cid"), "comp")
    placed = lists.join(comp, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    heads = placed.groupBy("key").agg(F.min(F.struct("cid", "comp")).alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("held"))
    heads = heads.where("lo != hi").select("key", F.col("m.comp").alias("main"), "held")
    mixed = write_read(placed.join(heads, "key"), "odd-mixed")
    asked = mixed.where("comp != main")
    counts = asked.groupBy("key").agg(F.count(F.lit(1)).alias("asked"))
    rows = mixed.join(counts, "key").join(classes.select("cid", "odd", "keys"), "cid")
    # about ``block`` rows to a block: numbers by hash, so no list is sorted in one task
    number = lambda total: F.pmod(F.xxhash64("cid"), F.ceil(F.col(total) / block))
    every = lambda total: F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(total) / block) - 1))
    columns = ["key", "cid", "n", "comp", "odd", "keys"]
    left = rows.where("comp != main").withColumn("i", number("asked")).withColumn("j", every("held")).select("i", "j", *columns)
    right = rows.withColumn("main_row", F.expr("comp = main")).withColumn("j", number("held")).withColumn("i", every("asked")).select("i", "j", "main_row", *columns)

    def meet(asked, held):
        out = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if asked.num_rows and held.num_rows:
            (x, kx, a, n, p), (y, ky, b, m, q) = (
                [_rows(side.column(c)) for c in ("odd", "keys")] + [side.column(c).to_numpy() for c in ("cid", "n", "comp")] for side in (asked, held)
            )
            main = held.column("main_row").to_numpy()
            band = int(np.flatnonzero(kx[0].view(np.int64) == asked.column("key")[0].as_py())[0])
            for r in range(len(x)):
                # both sides hold the pairs of two asked classes: the smaller one asks
                fits = (q != p[r]) & (100 * np.minimum(m, n[r]) >= percent * np.maximum(m, n[r])) & (main | (a[r] < b))
                fits = np.flatnonzero(fits)
                fits = fits[(ky[fits] == kx[r]).argmax(axis=1) == band]
                near = fits[allowed(y[fits], x[r], m[fits] + n[r], percent, most)]
                out[0].append(np.full(len(near), a[r]))
                out[1].append(b[near])
        return pa.table({"a": np.concatenate(out[0]), "b": np.concatenate(out[1])})

    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # attributes of their own
    return left.groupBy("key", "i", "j").cogroup(right.groupBy("key", "i", "j")).applyInArrow(meet, "a long, b long").distinct()


def cluster(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    long_list: int = LONG_LIST,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: ``id_col``, n_shingles, component_id, kept."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    most = most_differing(bands * rows, percent)
    light = write_read(sketch(docs, width, bands, rows), "odd-sketches")
    full = light.where((F.col("n") > 0) & F.col("id").isNotNull())
    # a class's first document stands for it; the sketches of equal sets are equal
    names = full.groupBy("d0", "d1", "n").agg(F.min("id").alias("cid"))
    own = full.join(names, ["d0", "d1", "n"]).where("id = cid")
    classes = write_read(own.groupBy("d0", "d1", "n", "cid").agg(F.min("odd").alias("odd"), F.min("keys").alias("keys")), "odd-classes")
    shared = _postings(classes).groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    postings = write_read(_postings(classes, bit_filter(shared, "key")), "odd-lists")
    heads = postings.groupBy("key").agg(F.min(F.struct("cid", "n")).alias("p"), F.count(F.lit(1)).alias("length")).where("length > 1")
    sized = write_read(postings.join(heads, "key"), "odd-sized")

    met = sized.where((F.col("length") > long_list) & (F.col("cid") != F.col("p.cid")) & _sizes_fit("n", "p.n", percent))
    least = F.slice(F.array_sort(F.collect_set("p.cid")), 1, PIVOTS)  # of at most a pivot per band
    met = met.groupBy(F.col("cid").alias("a")).agg(least.alias("least")).select("a", F.explode("least").alias("b"))
    short = sized.where(F.col("length") <= long_list)
    x, y = (short.select("key", F.col("cid").alias(c), F.col("n").alias(n)) for c, n in (("a", "n"), ("b", "m")))
    every = x.join(y, "key").where((F.col("a") > F.col("b")) & _sizes_fit("n", "m", percent)).select("a", "b")
    candidates = write_read(met.union(every).distinct(), "odd-met")
    found = components(_verified(_by_sketch(candidates, classes, percent, most), docs, width, percent))

    lists = sized.where(F.col("length") > long_list).select("key", "cid", "n")
    rest = _apart(lists, classes, found, percent, most, block)
    more = _verified(rest, docs, width, percent)
    final = components(more.union(found.select(F.col("id").alias("a"), F.col("comp").alias("b"))))

    ids = classes.select("d0", "d1", "n", "cid").join(final.withColumnRenamed("id", "cid"), "cid", "left")
    ids = ids.select("d0", "d1", "n", F.coalesce("comp", "cid").alias("component_id"))
    linked = light.select("id", "n", "d0", "d1").join(ids, ["d0", "d1", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return linked.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
