"""Language ID by cross-parsing entropy.

A bounded sample of labelled text per language is turned into a suffix
automaton.  A text is cross-parsed against each: starting at the automaton's
root it takes the longest match with the sample, then starts again, and so
on; the number of phrases times ``log2`` of the sample's length, per symbol,
estimates the cross entropy (Ziv-Merhav).  The language that needs the
fewest normalised phrases wins, ties to the smaller name.

Text becomes symbols first: letters are lower-cased, runs of other
characters become one gap, letters that stand in no sample one "other"
symbol that no sample holds.  Every letter of the samples is a symbol,
whatever the script: transitions are kept in a sparse table whose size is
that of the automaton's edges.  Every symbol of every text is parsed; to
parse many texts at once, texts are cut into lanes of ``LANE`` symbols and
all lanes step through one table together (a phrase ends with its lane).

Sample bound (parameters): the first ``docs_per_lang`` documents per language
that hold a letter, in seeded hash order, and ``total_symbols`` symbols over
all languages, shared equally between languages and, within one, between its
documents: all of them take part, each with its first symbols, and what short
ones leave goes to the longer.  The sample (at most four times as many symbols
travel) is all that reaches the driver; every task builds the automata (well
below a second of work) and drops them at its end, so that the workers' memory
is free for what runs after it.

Defined cases: null text, or text without a letter, is ``und`` with score 0;
languages are the non-null labels of the training rows; without any, every
text is ``und``; one language alone scores 1; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import random
import sys
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import first_by_hash, release, small_batches

UND = "und"
LANE = 256
GAP, OTHER = 0, 1
FIRST_LETTER = 2
LANES_AT_ONCE = 1 << 12


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: its lower-case code point if it is a letter, else 0."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for cp in range(sys.maxunicode + 1):
        ch = chr(cp)
        if ch.isalpha():
            low = ch.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


def fold(text: str) -> np.ndarray:
    """Lower-cased letters as code points, one 0 per run of other characters."""
    points = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if len(points) < 2:
        return points
    keep = points != 0
    keep[1:] |= points[:-1] != 0
    keep[0] = True
    return points[keep]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``symbols``; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class _Steps:
    """The automaton's transitions in a sparse table (rows displaced over one another).

    A state is a place of its own, and its edge by symbol ``c`` lies at
    ``state + c``, marked with the state; about four cells an edge.  ``value``
    and ``start`` hold ``2 * next state + phrase starts here``: where no edge
    is marked, a phrase starts and goes where the root goes.  ``closed`` is
    "no phrase open"; it has no edges.  Symbols from ``width`` on break
    matches: no text holds them.
    """

    def __init__(self, symbols: list[int], width: int):
        nxt = [[(c, to) for c, to in edges.items() if c < width] for edges in suffix_automaton(symbols)]
        cells = 4 * (sum(map(len, nxt)) + len(nxt)) + 1024
        taken, used, base = bytearray(cells + width), bytearray(cells), [0] * (len(nxt) + 1)
        pick = random.Random(1)
        # States with many edges first, while there is room everywhere.
        for state in [*sorted(range(len(nxt)), key=lambda i: -len(nxt[i])), len(nxt)]:
            edges = nxt[state] if state < len(nxt) else ()
            while True:
                at = int(pick.random() * cells)
                if not used[at] and not any(taken[at + c] for c, _ in edges):
                    break
            used[at], base[state] = 1, at
            for c, _ in edges:
                taken[at + c] = 1
        self.closed = base[-1]
        self.mark = np.full(cells + width, -1, np.int32)
        self.value = np.zeros(cells + width, np.int32)
        for state, edges in enumerate(nxt):
            for c, to in edges:
                self.mark[base[state] + c] = base[state]
                self.value[base[state] + c] = 2 * base[to]
        self.start = np.full(width, 2 * self.closed + 1, np.int32)
        for c, to in nxt[0]:
            self.start[c] = 2 * base[to] + 1

    def step(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        at = state + symbols
        return np.where(self.mark[at] == state, self.value[at], self.start[symbols])


def shares(sizes: list[int], total: int) -> list[int]:
    """``total`` dealt to ``sizes`` equally; what small ones leave goes to the larger."""
    out, left = [0] * len(sizes), total
    order = sorted(range(len(sizes)), key=lambda i: sizes[i])
    for done, i in enumerate(order):
        out[i] = min(sizes[i], left // (len(sizes) - done))
        left -= out[i]
    return out


class Model:
    """Per language the steps of its automaton; ``samples`` maps language to its folded sample documents."""

    def __init__(self, samples: dict[str, list[np.ndarray]], total_symbols: int = 1 << 16):
        self.langs = sorted(k for k, v in samples.items() if any(len(x) for x in v))
        share = max(1, total_symbols // max(1, len(self.langs)))
        used = {k: [doc[:n] for doc, n in zip(samples[k], shares([len(d) for d in samples[k]], share), strict=True)] for k in self.langs}
        points = np.unique(np.concatenate([d for v in used.values() for d in v] or [np.zeros(0, np.uint32)]))
        letters = points[points != 0]
        self.width = FIRST_LETTER + len(letters)
        self.symbol = np.full(sys.maxunicode + 1, OTHER, np.int32)
        self.symbol[0] = GAP
        self.symbol[letters] = FIRST_LETTER + np.arange(len(letters))
        self.steps, self.bits = [], []
        for lang in self.langs:
            joined: list[int] = []
            for doc in used[lang]:
                joined += [*self.symbol[doc].tolist(), self.width]  # the last is never read: breaks a match
            self.steps.append(_Steps(joined, self.width))
            self.bits.append(math.log2(max(2, len(joined))))

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrase counts (texts x languages) of folded texts, whole, in blocks of lanes."""
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        lanes, owner = [], []
        for i, points in enumerate(texts):
            codes = self.symbol[points]
            for at in range(0, len(codes), LANE):
                lanes.append(codes[at : at + LANE])
                owner.append(i)
                if len(lanes) == LANES_AT_ONCE:
                    self._step(lanes, owner, out)
                    lanes, owner = [], []
        if lanes:
            self._step(lanes, owner, out)
        return out

    def _step(self, lanes, owner, out) -> None:
        sizes = np.fromiter(map(len, lanes), np.int64, len(lanes))
        order = np.argsort(-sizes, kind="stable")  # long lanes first: each step touches a prefix
        grid = np.zeros((len(lanes), LANE), np.int32)
        for row, i in enumerate(order):
            grid[row, : sizes[i]] = lanes[i]
        grid = np.ascontiguousarray(grid.T)
        alive = np.searchsorted(-sizes[order], -np.arange(LANE), side="left")
        who = np.asarray(owner)[order]
        for k, steps in enumerate(self.steps):
            state = np.full(len(lanes), steps.closed, np.int32)
            count = np.zeros(len(lanes), np.int32)
            for t in range(LANE):
                n = alive[t]
                if n == 0:
                    break
                got = steps.step(state[:n], grid[t, :n])
                count[:n] += got & 1
                state[:n] = got >> 1
            out[:, k] += np.bincount(who, weights=count, minlength=len(out)).astype(np.int64)

    def predict(self, texts: list) -> tuple[list[str], list[float]]:
        return self.judge(texts)[:2]

    def judge(self, texts: list) -> tuple[list[str], list[float], list[bool]]:
        """Languages, scores, and whether the text holds a letter (whatever was learned)."""
        folded = [fold(t) if isinstance(t, str) and t else np.zeros(0, np.uint32) for t in texts]
        langs, scores = [UND] * len(texts), [0.0] * len(texts)
        letters = [bool(points.any()) for points in folded]
        if not self.langs:
            return langs, scores, letters
        costs = self.phrases(folded) * np.array(self.bits)
        best = costs.argmin(axis=1)
        for i in range(len(folded)):
            if not letters[i]:
                continue
            langs[i] = self.langs[best[i]]
            rest = np.delete(costs[i], best[i])
            scores[i] = 1.0 if not len(rest) else float(min(1.0, max(0.0, 1.0 - costs[i, best[i]] / rest.min())))
        return langs, scores, letters


def has_letter(text: Column) -> Column:
    """True where a text holds a letter, so that ``predict_table`` gives it a language; false for null."""
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def held_out(id_col: str) -> Column:
    """True for a fifth of the ids, by the CRC-32 of their decimal form (null: as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, docs_per_lang: int = 96, total_symbols: int = 1 << 16) -> dict[str, list[np.ndarray]]:
    """The training sample: per language the first documents in hash order that hold a letter.

    ``first_by_hash`` finds their ids without a hot task, also where a language
    holds most rows; a last pass folds their texts and cuts them, in tasks, to
    four equal shares of a document.
    """
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & has_letter(F.col(text_col)))
    lang = F.col(lang_col).cast("string")
    ids = first_by_hash(known.select(lang.alias("grp"), F.col(id_col).alias("id"), F.xxhash64(F.lit(17), F.col(id_col)).alias("h")), docs_per_lang)
    if not ids:
        return {}
    wanted = sorted({r["id"] for r in ids})
    rank = {(r["grp"], r["id"]): r["r"] for r in ids}
    limit = max(1, 4 * total_symbols // (len({r["grp"] for r in ids}) * docs_per_lang))

    def cut(batches):
        for batch in small_batches(batches, "text"):
            folded = [fold(t)[:limit].astype(np.uint32).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("key"), pa.array(folded, pa.binary())], names=["lang", "key", "points"])

    # Ids travel as their place in ``wanted``, whatever their type.
    key = F.array_position(F.array(*[F.lit(i) for i in wanted]), F.col(id_col)).cast("long")
    rows = known.where(F.col(id_col).isin(wanted)).select(lang.alias("lang"), key.alias("key"), F.col(text_col).alias("text"))
    texts = rows.mapInArrow(cut, "lang string, key long, points binary").distinct().collect()
    out: dict[str, list] = {}
    found = [(r["lang"], rank.get((r["lang"], wanted[r["key"] - 1])), bytes(r["points"])) for r in texts]
    for name, _, points in sorted(x for x in found if x[1] is not None):
        out.setdefault(name, []).append(np.frombuffer(points, np.uint32))
    return out


def predict_table(docs: DataFrame, samples: dict, text_col: str = "text", keep=("doc_id",), total_symbols: int = 1 << 16, names=("lang_pred", "score")) -> DataFrame:
    """``keep`` columns plus the language, its score and (given a third name) whether the text holds a letter; one pass, no shuffle."""
    keep, names = list(keep), list(names)
    kinds = [(T.StringType(), pa.string()), (T.DoubleType(), pa.float64()), (T.BooleanType(), pa.bool_())][: len(names)]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, kind) for n, (kind, _) in zip(names, kinds, strict=True)])
    text = text_col if text_col in keep else "__text"

    def run(batches):
        model, batch, found, arrays = Model(samples, total_symbols), None, None, None
        for batch in small_batches(batches, text):
            found = model.judge(batch.column(text).to_pylist())
            arrays = [pa.array(values, kind) for values, (_, kind) in zip(found, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + arrays, names=[*keep, *names])
        del model, batch, found, arrays
        _letters.cache_clear()
        release()

    rows = docs.select(*keep) if text in keep else docs.select(*keep, F.col(text_col).alias(text))
    return rows.mapInArrow(run, schema)
