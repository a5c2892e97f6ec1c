"""BPE round trips, language ID on held-out rows, and mixing."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from daygrain.llm import bpe, langid, mix
from daygrain.llm.queries import RANKS, cycled_weights

from . import brute
from .fixtures import documents, empty, frame, sentence

PATH, PATTERN = public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def plain_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_round_trips(spark):
    enc = plain_encoding()
    rows = documents() + [(500, "<|endoftext|> a", "en", "a")]
    got = bpe.encode_table(frame(spark, rows), PATH, PATTERN, keep=("doc_id", "text"), outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256")).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = enc.encode_ordinary(r.text or "")
        assert (r.n_tokens, r.ids) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    back = bpe.decode_table(spark.createDataFrame([(1, enc.encode_ordinary("héé")[:1]), (2, None)], "doc_id long, ids array<int>"), PATH, PATTERN)
    assert {r.doc_id: bytes(r.decoded) for r in back.collect()} == {1: enc.decode_bytes(enc.encode_ordinary("héé")[:1]), 2: b""}
    assert bpe.encode_table(empty(spark), PATH, PATTERN).count() == 0


@pytest.mark.parametrize("size", [1, 2, 5, 17])
def test_cutting_at_safe_boundaries_changes_nothing(size):
    enc = plain_encoding()
    r = random.Random(size)
    for _ in range(300):
        text = "".join(r.choice(["a", "Z", "é", " ", "  ", "\n", "\t", "'s", "'", "9", "!", " ", "　", "你", "\x1c", "\x85", " x"]) for _ in range(60))
        assert "".join(bpe.pieces(text, size)) == text
        assert bpe.encode_text(text, enc, size) == enc.encode_ordinary(text)


def test_long_run_without_boundary():
    enc = plain_encoding()
    text = "ab" * 100_000
    assert bpe.decode_ids(bpe.encode_text(text, enc), enc) == text.encode()


@pytest.mark.parametrize("run", [2, 3, 9])
def test_cutting_at_runs_of_white_space_changes_nothing(run):
    enc = plain_encoding()
    r = random.Random(run)
    for _ in range(300):
        text = "".join(r.choice([" ", "  ", "\n", "\t \n", "\u3000", "\x85", "\xa0", "a", "é9", "!", "'s", "\x1c", "\u200b"]) for _ in range(60))
        assert bpe.encode_text(text, enc, 1, run) == enc.encode_ordinary(text)


@pytest.mark.parametrize("unit", [" ", "\n", "\t", " \n", "\u3000 ", "\r\n "])
def test_long_runs_of_white_space(unit):
    """100,000 characters as the library encodes them uncut; five million, at both ends and between, encode and decode."""
    enc = plain_encoding()
    middle = unit * (100_000 // len(unit))
    for text in (f"x{middle}y z", f"{middle}1", f"!{middle}"):
        assert bpe.encode_text(text, enc) == enc.encode_ordinary(text)
    huge = unit * (5_000_000 // len(unit))
    for text in (f"x{huge}y", huge, f"{huge}'s a{huge}"):
        assert bpe.decode_ids(bpe.encode_text(text, enc), enc) == text.encode()
    short, long_ = (bpe.encode_text(f"x{unit * n}y", enc) for n in (5000, 10_000))
    assert long_[: len(short) // 2] == short[: len(short) // 2] and long_[-3:] == short[-3:]


def test_long_white_space_in_spark(spark):
    rows = [(1, "x" + " " * 1_000_000 + "y", "en", "a"), (2, "\n" * 1_000_000, "en", "a"), (3, "1" * 1_000_000, "en", "a")]
    got = bpe.encode_table(frame(spark, rows), PATH, PATTERN, outputs=("n_tokens", "decoded_sha256")).collect()
    assert {r.doc_id: r.decoded_sha256 for r in got} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t, *_ in rows}


def test_runs_are_left_alone_under_other_patterns():
    enc = tiktoken.Encoding("other", pat_str=r"\s|\S+", mergeable_ranks=plain_encoding()._mergeable_ranks, special_tokens={})
    text = "a" + " " * 70_000 + "b"
    assert bpe.encode_text(text, enc) == enc.encode_ordinary(text)


def test_suffix_automaton_holds_exactly_the_substrings():
    r = random.Random(4)
    word = [r.randint(3, 5) for _ in range(60)]
    nxt = langid.suffix_automaton(word)

    def holds(w):
        state = 0
        for c in w:
            if c not in nxt[state]:
                return False
            state = nxt[state][c]
        return True

    subs = {tuple(word[i:j]) for i in range(60) for j in range(i, 61)}
    for _ in range(2000):
        w = tuple(r.randint(3, 6) for _ in range(r.randint(1, 6)))
        assert holds(w) == (w in subs)


def phrase_count(text, sample):
    """Plain cross-parsing of one lane."""
    n, at = 0, 0
    while at < len(text):
        length = 1
        while at + length < len(text) and text[at : at + length + 1] in sample and text[at : at + length] in sample:
            length += 1
        n, at = n + 1, at + length
    return n


def test_phrases_match_plain_cross_parsing():
    r = random.Random(5)
    samples = {"x": "abcabdabeaab" * 3, "y": "zyxzywzyv"}
    model = langid.Model({k: [langid.fold(v)] for k, v in samples.items()})
    texts = ["".join(r.choice("abcdezyxwq ") for _ in range(r.randint(1, 700))) for _ in range(50)]
    got = model.phrases([langid.fold(t) for t in texts])
    for t, counts in zip(texts, got, strict=True):
        folded = "".join(chr(c) if c else " " for c in langid.fold(t).tolist())
        lanes = [folded[i : i + langid.LANE] for i in range(0, len(folded), langid.LANE)]
        assert counts.tolist() == [sum(phrase_count(x, samples[k]) for x in lanes) for k in ("x", "y")]


def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    samples = langid.fit(docs.where(~langid.held_out("doc_id")), "doc_id", "text", "lang")
    assert sum(len(d) for v in samples.values() for d in v) < 8 << 16
    got = langid.predict_table(docs, samples, keep=("doc_id", "lang")).where(langid.held_out("doc_id")).collect()
    assert len(got) > 150 and np.mean([r.lang == r.lang_pred for r in got]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def letters_of(first, n):
    return [chr(first + i) for i in range(n)]


def test_language_id_of_scripts_with_many_letters(spark):
    """Short held-out texts of two languages that share 3,000 letters and differ in their pairs of letters."""
    r = random.Random(9)
    han = letters_of(0x4E00, 3000)
    words = {k: ["".join(r.choices(han, k=2)) for _ in range(900)] for k in ("zh", "ja")}
    words["ko"] = ["".join(r.choices(letters_of(0xAC00, 2000), k=2)) for _ in range(900)]
    words["el"] = ["".join(r.choices(letters_of(0x3B1, 17), k=5)) for _ in range(300)]
    rows = [(i, lang, " ".join(r.choices(words[lang], k=120 if i < 480 else 8))) for i, lang in enumerate(sorted(words) * 180)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    samples = langid.fit(docs.where("doc_id < 480"), "doc_id", "text", "lang")
    model = langid.Model(samples)
    assert model.width > 3000 and (model.symbol[[0x4E00 - 1, 0x61]] == langid.OTHER).all()
    late = [x for x in rows if x[0] >= 480]
    found = [x.lang_pred for x in langid.predict_table(docs.where("doc_id >= 480"), samples, keep=("doc_id",)).orderBy("doc_id").collect()]
    assert np.mean([f == lang for f, (_, lang, _) in zip(found, late, strict=True)]) > 0.97


def test_every_sample_document_takes_part(spark):
    letters = "abcdefghij"
    rows = [(i, "xx", " " * 5000 + chr(0x5000 + i) + letters * 900) for i in range(120)] + [(500 + i, "xx", "  12 ") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    samples = langid.fit(docs, "doc_id", "text", "lang", docs_per_lang=40, total_symbols=4000)
    assert len(samples["xx"]) == 40 and {len(d) for d in samples["xx"]} == {400}
    model = langid.Model(samples, 4000)
    assert model.width == langid.FIRST_LETTER + len(letters) + 40
    assert langid.shares([5, 100, 2, 100], 60) == [5, 26, 2, 27] and langid.shares([1, 2], 60) == [1, 2] and langid.shares([], 5) == []


def test_language_id_cases(spark):
    docs = frame(spark, documents())
    samples = langid.fit(docs, "doc_id", "text", "lang")
    got = {r.doc_id: r for r in langid.predict_table(docs, samples).collect()}
    assert len(got) == len({i for i, *_ in documents()})
    for i in (90, 91, 92, 98):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[97].lang_pred in {"en", "de", "fr"} and set(samples) <= {"en", "de", "fr"}
    assert langid.fit(empty(spark), "doc_id", "text", "lang") == {}
    assert {r.lang_pred for r in langid.predict_table(docs, {}).collect()} == {"und"}
    assert langid.predict_table(empty(spark), samples).count() == 0


def test_has_letter_agrees_with_the_judge(spark):
    texts = [t for _, t, *_ in documents()] + ["١٢٣", "你", "ª", "ʰ", "🙂", "_", "\u0301", "Ⅷ", "𝒳", "ꙮ"]
    model = langid.Model({"en": [langid.fold("some plain english words")]})
    want = model.judge(texts)[2]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.has for r in rows.select("i", langid.has_letter(rows["t"]).alias("has")).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_held_out_is_the_crc_of_the_decimal_id(spark):
    import zlib

    got = spark.range(300).select("id", langid.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_mix_hits_targets_and_keeps_the_limits(spark):
    r = random.Random(8)
    rows = [(i, sentence(r, r.randint(1, 60)), "en", r.choice(["s1", "s1", "s1", "s2", "s3", None])) for i in range(900)]
    rows += [(1000, None, "en", "s1"), (1001, "", "en", "s9"), (1002, "x", "en", "ß")]
    docs = frame(spark, rows)
    taken, goal, sizes = mix.mix(docs, mix.F.array("source"), cycled_weights, carry=("source", "n"))
    got = taken.collect()
    assert len(got) == len(rows) and {x.n for x in got} == {7}
    by_id = {i: (len(brute.words(t)), s) for i, t, _, s in rows}
    for x in got:
        assert x.size == by_id[x.doc_id][0] and x.taken in (0, x.size, 2 * x.size)
    want = brute.mix_targets(sizes, cycled_weights(list(sizes)))
    assert goal == pytest.approx(want)
    for s, target in goal.items():
        assert abs(sum(x.taken for x in got if x.source == s) - target) <= 3
    again = mix.mix(docs.repartition(3), mix.F.array("source"), cycled_weights)[0].collect()
    assert {(x.doc_id, x.taken) for x in again} == {(x.doc_id, x.taken) for x in got}


def test_mix_of_null_and_shared_ids_and_of_repeated_rows(spark):
    """Half the ids null, one id for a whole source, one row a thousand times: targets within a document, limits kept."""
    r = random.Random(11)
    rows = [(None if i % 2 else i, sentence(r, r.randint(5, 60)), "en", "a") for i in range(600)]
    rows += [(7, sentence(r, r.randint(5, 60)), "en", "b") for _ in range(300)]
    rows += [(None, "one row of six words here", "en", "c")] * 1000
    docs = frame(spark, rows)
    taken, goal, _ = mix.mix(docs, mix.F.array("source"), cycled_weights, carry=("source", "text"))
    got = taken.collect()
    assert len(got) == len(rows) and all(x.taken <= 2 * x.size for x in got)
    for s, target in goal.items():
        assert abs(sum(x.taken for x in got if x.source == s) - target) <= 6, s
    again = mix.mix(docs.repartition(3), mix.F.array("source"), cycled_weights, carry=("source", "text"))[0].collect()
    words = lambda found: {s: sum(x.taken for x in found if x.source == s) for s in "abc"}
    assert {(x.doc_id, x.text, x.taken) for x in again if x.source == "a"} == {(x.doc_id, x.text, x.taken) for x in got if x.source == "a"}
    assert words(again)["c"] == pytest.approx(words(got)["c"], abs=6)


def test_mix_overlapping_sources_use_fresh_words_first(spark):
    rows = [(i, "one two three four five", "en", "a") for i in range(100)]
    docs = frame(spark, rows)
    member = mix.F.when(mix.F.col("doc_id") < 50, mix.F.array(mix.F.lit("a"), mix.F.lit("b"))).otherwise(mix.F.array(mix.F.lit("b")))
    taken, goal, _ = mix.mix(docs, member, lambda names: {s: 1 for s in names}, budget_ratio=1.0)
    assert goal == {"a": 250.0, "b": 250.0}
    assert {x.copies for x in taken.collect()} == {1}


def test_min_cost_flow_is_optimal_on_small_networks():
    import itertools

    r = random.Random(2)
    for _ in range(60):
        cap = {p: r.randint(1, 3) for p in "pq"}
        members = {"p": ["a", "b"], "q": r.choice([["a"], ["b"]])}
        quota = {"a": r.randint(0, 4), "b": r.randint(0, 4)}
        flow = mix.min_cost_flow(cap, members, quota, 2)
        best = None
        edges = [(p, s) for p in members for s in members[p]]
        for values in itertools.product(range(7), repeat=len(edges)):
            use = {p: sum(v for e, v in zip(edges, values, strict=True) if e[0] == p) for p in cap}
            fill = {s: sum(v for e, v in zip(edges, values, strict=True) if e[1] == s) for s in quota}
            if all(use[p] <= 2 * cap[p] for p in cap) and all(fill[s] <= quota[s] for s in quota):
                key = (-sum(values), sum(max(0, use[p] - cap[p]) for p in cap))
                best = key if best is None else min(best, key)
        use = {p: sum(v for e, v in flow.items() if e[0] == p) for p in cap}
        assert (-sum(flow.values()), sum(max(0, use[p] - cap[p]) for p in cap)) == best


def test_mix_empty_table_and_too_many_patterns(spark):
    assert mix.mix(empty(spark), mix.F.array("source"), cycled_weights)[0].count() == 0
    with pytest.raises(ValueError, match="patterns"):
        mix.mix(frame(spark, documents()), mix.F.array("source"), cycled_weights, max_patterns=2)
