"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import copy
import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

import corpus_pipeline
from ledgerline.llm import (
    common, embedding_dup, encoding, graph, id_files, licenses, mixing, near_dup, neighbours, packing, periodic,
    quality, repeats, slack, trie, warc,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def _words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghij", k=draw.randint(2, 7))) for _ in range(n))


def _rows() -> list[tuple]:
    long = _words(1, 30_000)
    near = _words(2, 200).split()
    texts = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "Alpha beta"), (6, "alpha BETA"), (7, long), (8, " ".join(near)),
        (9, " ".join([*near[:100], "changed", *near[101:]])), (10, _words(3, 150) + " é" * 40), (10, _words(3, 150) + " é" * 40),
        (None, _words(4, 120)), (12, "é" * 500 + "è" * 500), (13, "licensed under CC-BY 4.0; all rights reserved"),
        (14, "-" * 1500),
    ]
    return [(i, t, "en", s, None if t is None else len(t)) for (i, t), s in zip(texts, ["a", "b", None, "c", "a"] * 3)]


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def clashing(spark, docs):
    from pyspark.sql import functions as F

    extra = "n_bytes kept score row id size times words label fold part spans node __c0 start sequence_id block __row __times __time ___row".split()
    return docs.withColumns({c: F.lit("x") for c in extra})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module", autouse=True)
def cleared(spark):
    yield
    common.release(spark)


def _labels(spark):
    return spark.createDataFrame([(1, 0, 0), (5, 1, 0), (5, 1, 0), (8, 1, None), (None, 1, 0), (9, None, 0), (7, 1, 1)],
                                 "doc_id long, quality int, toxic int")


def test_repeats(docs, clashing, empty, rows):
    texts = [(t or "").encode() for _, t, *_ in rows]
    small = [(r, t) for r, t in zip(rows, texts) if len(t) < 100_000]
    expected = Counter(
        (r[0], *e) for (r, _), e in zip(small, brute.without_repeats([t for _, t in small], 400)))
    for table in (docs, clashing):
        got = repeats.without_repeats(table).drop("spans").collect()
        assert Counter(tuple(r) for r in got if r.n_bytes < 100_000) == expected
    assert repeats.without_repeats(empty).count() == 0


@pytest.mark.parametrize("bound", [1, 4096])
def test_repeats_of_crowded_groups(spark, monkeypatch, bound):
    monkeypatch.setattr(repeats, "FEWEST", bound)
    monkeypatch.setattr(repeats, "MOST", bound)
    draw = random.Random(5)
    parts = ["".join(draw.choices("ab", k=draw.randint(20, 90))) for _ in range(12)]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 8))) for _ in range(60)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = repeats.without_repeats(table, length=100, gram=24).orderBy("doc_id").collect()
    plain = brute.without_repeats([t.encode() for t in texts], 100)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == plain
    assert any(0 < e[1] < e[0] for e in plain)


@pytest.mark.parametrize("most", [3, 4096])
def test_common_repeats_are_no_row_for_each_anchor(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "COMMON", 5)
    monkeypatch.setattr(repeats, "MOST_COMMON", most)
    passage, other = _words(80, 300), _words(81, 60)
    texts = [f"{_words(100 + i, 40)} {passage if i % 4 else other} {_words(200 + i, 30)}" for i in range(40)] + [passage] * 9
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = repeats.without_repeats(table, length=100, gram=24).orderBy("doc_id").collect()
    plain = brute.without_repeats([t.encode() for t in texts], 100)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == plain
    if most > 3:
        stored = common.bucketed(repeats._anchored(table, ["doc_id"], 100, 24, False), "__row")
        # before, each of some 30 anchors of the passage was a row in each text
        assert repeats._spans(stored, 100, 24).count() < 8 * len(texts)


def test_prefix_tree_of_a_sorted_list():
    assert sorted(repeats.intervals([3, 5, 1])) == [(1, 0, 3), (3, 0, 2), (5, 1, 2)]
    assert sorted(repeats.intervals([2, 2])) == [(2, 0, 2)]
    assert list(repeats.intervals([])) == []
    raw = "aéb".encode()
    assert repeats.whole_characters(raw, [(0, 2)]) == [(0, 1)] and repeats.whole_characters(raw, [(2, 4)]) == [(3, 4)]


def test_pipeline_passages_of_over_50_words(spark):
    for words in (51, 50):
        passage = " ".join(_words(60, words).split())
        assert len(passage) < 400
        texts = [f"{_words(61 + i, 70)} {passage if i != 2 else passage.replace(' ', chr(10))} {_words(71 + i, 70)}" for i in range(3)]
        table = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], DOCS)
        got = {r.doc_id: r for r in corpus_pipeline.repeats(spark, table, "").collect()}
        for i, text in enumerate(texts):
            expected = f"{_words(61 + i, 70)}  {_words(71 + i, 70)}" if words == 51 else text
            assert got[i].text == expected and got[i].n_chars == len(expected)


def test_words_are_found_where_they_stand():
    for raw in (b"", b" ", b"a", b"\x0b a\x0c\x1c\x85b \xc2\xa0\tc\r\n", bytes(range(256)) * 2):
        starts, ends = repeats.word_edges(raw)
        assert [raw[a:b] for a, b in zip(starts, ends)] == raw.split() == re.findall(rb"[^\x20\x09-\x0d]+", raw)


def test_text_without_passages_beside_the_400_bytes(spark, tmp_path):
    passage, long = _words(60, 51), _words(63, 90)
    assert len(passage) < 400 <= len(long)
    ends = [(f"{_words(61 + i, 70)} ", f" é{_words(71 + i, 70)}") for i in range(4)]
    middles = [passage, passage.replace(" ", "\n"), long, long + " " + " ".join(passage.split()[1:])]
    texts = [a + m + b for (a, b), m in zip(ends, middles)] + [None, ""]
    table = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)
    table.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    rows = repeats.op1_repeat_removal(spark, str(tmp_path)).orderBy("doc_id").collect()
    plain = brute.without_repeats([(t or "").encode() for t in texts], 400)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == plain
    # the contract's columns keep the short passage, the text does not
    assert [r.n_removed for r in rows[:2]] == [0, 0] and [r.kept_text for r in rows[:2]] == texts[:2]
    assert [r.text for r in rows[:2]] == [a + b for a, b in ends[:2]]
    assert [r.text for r in rows] == brute.without_passages([t or "" for t in texts], 400, 51)
    assert all(0 < r.n_removed for r in rows[2:4]) and [r.text for r in rows[4:]] == ["", ""]
    with pytest.raises(ValueError):
        repeats.without_repeats(table, words=51, text_words=51)


def test_shuffle_files_go_with_queries_of_intermediate_tables(spark, docs):
    seen, conf = [], spark.conf
    with common.brief_shuffles(spark):
        seen.append(conf.get(common._CLEANUP))
    stage = corpus_pipeline._stage(lambda spark, docs, _: seen.append(conf.get(common._CLEANUP)) or docs.repartition(2, "doc_id"))
    made = stage(spark, docs, "")
    assert seen == ["true", "true"] and conf.get(common._CLEANUP, None) is None
    assert len(made.collect()) == len(made.collect()) == docs.count()


def test_near_duplicates(docs, clashing, empty):
    for table in (docs, clashing):
        got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dup.near_duplicates(table, shingle=2).collect()}
        assert got[1, 0] == (1, True) and got[2, 0] == (2, True) and got[3, 0] == (3, True)
        assert got[5, 1] == (5, True) and got[6, 1] == (5, False)
        assert got[8, 199] == (8, True) and got[9, 199] == (8, False)
        assert [k for k in got if k[0] is None] and got[4, 1] == (4, True)
    assert near_dup.near_duplicates(empty).count() == 0


def test_stages_choose_rows_without_moving_their_texts_again(spark, docs):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as on large tables
    try:
        for stage in (corpus_pipeline.near_dup, corpus_pipeline.mixing):
            made = stage(spark, docs, "")
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Join") == 1 and plan.count("Exchange") == 1
            assert {(r.doc_id, r.text) for r in made.collect()} <= {(r.doc_id, r.text) for r in docs.collect()}
    finally:
        spark.conf.set(key, before)


def test_near_duplicates_of_a_chain_and_a_crowd(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    base = _words(7, 120).split()
    texts = []
    for i in range(60):  # neighbours are alike, the ends are not
        words = list(base)
        for k in range(i):
            words[2 * k] = f"x{k}"
        texts.append((i, " ".join(words)))
    texts += [(100 + i, " ".join(base[:100] + [f"y{i}z{k}" for k in range(14)])) for i in range(40)]
    got = near_dup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), shingle=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute.near_duplicates(texts, 2)


def test_near_duplicates_move_few_sets(spark, monkeypatch):
    """Only rows with a pair that is still open take their sets to a tile, and the others
    are compared where the sets of the second nodes lie."""
    made = {}

    def cut(df, name):
        made[name] = common.cut(df, name)
        if name == "links":
            made.setdefault("plan", df._jdf.queryExecution().executedPlan().toString())
        return made[name]

    monkeypatch.setattr(near_dup, "cut", cut)
    base = _words(7, 120).split()
    texts = [(i, " ".join(base[: 100 + i % 2] + [f"y{i}z{k}" for k in range(14 + 6 * (i % 3))])) for i in range(60)]
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as on large tables
    try:
        got = near_dup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), shingle=2).collect()
    finally:
        spark.conf.set(key, before)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute.near_duplicates(texts, 2)
    assert 0 < made["compared"].count() < made["open"].count()
    assert made["plan"].count("Exchange hashpartitioning") == 3  # pairs, sets of first nodes, both


@pytest.mark.parametrize("path, dropped", [(BYTE, False), (WORD, True)])
def test_new_words_of_letters_take_the_short_way(monkeypatch, path, dropped):
    made = encoding.Encoder(path, dropped)
    latin = [chr(c) for c in range(0xC0, 0x250)] + ["Éclair", "naïve", "Straße", "łódź", "ªb", "µm", "日本", "Жук"]
    for text in (*latin, " ".join(latin), "\n".join(latin)):
        assert made.encode(text) == made._plain(text)
    monkeypatch.setattr(encoding, "_LETTERS", None)  # plain letters need no patterns
    monkeypatch.setattr(encoding, "_STEM", None)
    text = "Plain words\nof letters alone XYZ q"
    assert made.encode(text) == made._plain(text)


@pytest.mark.parametrize("path, dropped", [(BYTE, False), (WORD, True)])
def test_texts_encoded_together_have_the_same_ids(monkeypatch, path, dropped):
    draw = random.Random(4)
    texts = ["", " ", "\n", "a  b", "a\n\nb", "a\n b", "it's 'll don't", "x\x0b y", "a\tb c", "  a", "a ", "É ́x", "ª, µ. º!",
             "a\r\nb", "a.b!! c,", "...", "İ Σς,", "a\n", "日本 語。 日本,", "a<|endoftext|> b", "b" * 90 + ", c", "plain words, plain"]
    texts += ["".join(draw.choices("ab .,\n\t'é　\x85\x1f!", k=30)) for _ in range(300)]
    texts += ["\n".join(_words(i, 30) + "." for i in range(k, k + 3)) for k in range(40)] + [t or "" for _, t, *_ in _rows()]
    whole, tokenizer = encoding.Encoder(path, dropped, special=True), Tokenizer.from_file(path)
    for words, long in ((encoding.MAX_WORDS, encoding.LONG_TEXT), (40, 150)):
        monkeypatch.setattr(encoding, "LONG_TEXT", long)
        made = encoding.Encoder(path, dropped, special=True, words=words)
        for _ in range(2):  # new words, then known ones
            assert made.encode_all(texts) == [whole.encode(t) for t in texts]
        assert len(made.units) + len(made.units.old) < words + 8192
    ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert made.encode_all(texts) == [struct.pack(f"<{len(i)}I", *i) for i in ids]
    assert made.encode_all([]) == [] and made.encode_all([""]) == [b""]


def test_new_words_are_asked_for_together(monkeypatch):
    made, asked = encoding.Encoder(BYTE, False, special=True), []
    assert made.opens is not None and encoding.Encoder(WORD, True).opens is None

    class Model:
        def tokenize(self, characters, model=made.model):
            asked.append(characters)
            return model.tokenize(characters)

    made.model = Model()
    words = ["q" + "".join(chr(97 + ord(c) - 48) for c in str(i)) for i in range(1000)]
    texts = ["\n".join(["On", *words]), "On " + " ".join(w + "," for w in words), "On " + " ".join(words)]
    assert made.encode_all(texts[1:] * 3) == [made._plain(t) for t in texts[1:] * 3]
    assert len(asked) < 200  # a word at a time before
    made.encode_all(texts[1:])
    assert len(asked) < 200


def test_words_are_not_merged_with_each_other(tmp_path):
    vocabulary = {c: i for i, c in enumerate(["a", "b", "Ġ", "Ċ", "aĠ", "Ġa", "Ġb"])}
    merges = [("a", "Ġ"), ("Ġ", "a"), ("Ġ", "b")]
    tokenizer = Tokenizer(models.BPE(vocabulary, merges))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tokenizer.save(f"{tmp_path}/crossing.json")
    made = encoding.Encoder(f"{tmp_path}/crossing.json", False)
    assert made.encode_all(["a a b ab", "b a"]) == [struct.pack("<5I", 0, 5, 6, 5, 1), struct.pack("<2I", 1, 5)]


def test_rows_are_taken_together_by_the_bytes_of_their_texts():
    texts = ["a" * n for n in (3, 0, 4, 30, 1, 1, 8, 0, 9, 12)]
    batch = pa.record_batch([list(range(10)), texts], names=["doc_id", "text"])
    parts = [p.column("doc_id").to_pylist() for p in encoding.together(iter([batch, batch.slice(0, 0), batch.slice(8)]), "text", 10)]
    assert parts == [[0, 1, 2], [3], [4, 5, 6, 7], [8], [9], [8], [9]]


def test_components(spark):
    links = [(5, 4), (4, 3), (9, 9), (7, 8), (3, 5)] + [(100 + i, 101 + i) for i in range(50)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got[5] == got[4] == got[3] == 3 and got[8] == 7 and got[150] == 100
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("path, dropped", [(WORD, True), (BYTE, False)])
def test_ids_are_the_tokenizers(path, dropped):
    tokenizer = Tokenizer.from_file(path)
    own = encoding.Encoder(path, dropped)
    texts = ["", " ", "\n", "a  b", "a\n\nb", "it's 'll don't", "x\x0b y", "a\x1c b", "  a", "<|endoftext|> a", "É ́x",
             "a \t b\r\n", "a.b!! c,", "İ Σς", "a\n", "日本 語。", *[t or "" for _, t, *_ in _rows()]]
    draw = random.Random(3)
    texts += ["".join(draw.choices("ab .\n\t'é　\x85\x1f!", k=30)) for _ in range(300)]
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids), repr(text)


@pytest.mark.parametrize("path, dropped", [(WORD, True), (BYTE, False)])
def test_special_tokens_are_the_tokenizers(path, dropped):
    tokenizer = Tokenizer.from_file(path)
    own = encoding.encoder(path, dropped)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    texts = ["<|endoftext|>", "a b<|endoftext|> c\n", "x <|startoftext|>y", "<|ENDOFTEXT|> a", "a b. c", "<|endof text|>"]
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids), repr(text)
    assert any(tokenizer.encode(t, add_special_tokens=False).ids != plain.encode(t, add_special_tokens=False).ids for t in texts)


def test_packing(docs, clashing, empty, rows):
    for table in (docs, clashing):
        got = packing.pack(table, WORD, keep_ids=True)
        pieces = got.collect()
        assert Counter(r.doc_id for r in pieces if r.piece == 0) == Counter(r[0] for r in rows)
        assert [r.length for r in pieces if r.doc_id == 1] == [1]
        assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in pieces)
        whole = {r.sequence_id: r for r in packing.sequences(got).collect()}
        for r in pieces:
            assert whole[r.sequence_id].ids[4 * r.offset : 4 * (r.offset + r.length)] == r.ids
        assert all(len(s.ids) == 4 * s.length <= 4 * 4096 for s in whole.values())
    assert packing.pack(empty, WORD).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plans_hold_every_piece_once(seed):
    draw = random.Random(seed)
    top = [60, 4096, 4095, 2048][seed]
    counts = Counter(draw.randint(1, top) for _ in range(3000))
    plan = packing.best_plan(counts)
    assert plan.taken == counts
    filled = Counter()
    lengths, firsts, sequences, offsets = (x.tolist() for x in plan.arrays())
    for k, n in enumerate(lengths):
        last = firsts[k + 1] if k + 1 < len(lengths) and lengths[k + 1] == n else counts[n]
        for s in range(last - firsts[k]):
            filled[sequences[k] + s] += n
    assert max(filled.values()) <= 4096 and len(filled) == plan.sequences
    gaps: list[int] = []  # best fit, document by document
    for n in sorted(counts.elements(), reverse=True):
        fitting = [g for g in gaps if g >= n]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - n)
        else:
            gaps.append(4096 - n)
    assert plan.sequences <= len(gaps)


def test_rows_come_from_groups_of_several_pieces(monkeypatch):
    draw = random.Random(6)
    drawn = (int(draw.lognormvariate(6.5, 1.2)) + 1 for _ in range(3000))
    counts = Counter(n for n in drawn if n < 4096)
    made = []
    linear_groups = packing.linear_groups
    monkeypatch.setattr(packing, "linear_groups", lambda c, n: made.append(copy.deepcopy(linear_groups(c, n))) or linear_groups(c, n))
    plan = packing.best_plan(dict(counts))
    for groups in made:
        sizes = [sum(c for _, c in g) for g in groups]
        # equal cardinality, but for the last one, and never one piece for itself
        assert len(set(sizes[:-1])) <= 1 and sum(sizes) / len(sizes) >= 3.9 and max(sizes) >= 4
        # rounding has an effect: the lengths of a group differ
        assert sum(len(g) > 1 for g in groups) >= 0.9 * len(groups)
    total = sum(n * c for n, c in counts.items())
    assert plan.sequences <= -(-total // 4096) * 1.005 + 1


def test_quality(spark, docs, clashing, empty, rows):
    for table in (docs, clashing):
        got = quality.classify(table, _labels(spark)).collect()
        assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
        assert all(0 <= r.score <= 1 for r in got)
    nothing = quality.classify(docs, _labels(spark).where("false")).collect()
    assert all(abs(r.score - 0.5) < 0.01 for r in nothing)
    assert quality.classify(empty, _labels(spark)).count() == 0
    assert quality.good_documents(empty, _labels(spark)).columns == empty.columns
    assert quality.pool_adjacent([0.1, 0.5, 0.3, 0.9], [1, 1, 1, 1]) == [0.1, 0.4, 0.4, 0.9]


def test_id_files(spark, docs, clashing, empty, rows):
    for table, width in ((docs, 2), (clashing, 4)):
        path = common.new_path(spark, "ids")
        id_files.write(table, path, BYTE, width=width)
        got = id_files.read(spark, path).collect()
        assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
        order = sorted(got, key=lambda r: r.start)
        ids = [r.doc_id for r in order]
        assert ids[0] is None and ids[1:] == sorted(ids[1:])
        assert [r.start for r in order] == [sum(x.n_tokens for x in order[:k]) for k in range(len(order))]
        texts = {r[0]: r[1] or "" for r in rows}
        own = encoding.Encoder(BYTE, False)
        assert all(r.ids == own.encode(texts[r.doc_id]) + bytes(4) and r.ids_crc32 == zlib.crc32(r.ids) for r in got)
        assert sorted(r.doc_id for r in id_files.read(spark, path, only=[4, 10, 99]).collect()) == [4, 10, 10]
    path = common.new_path(spark, "ids")
    id_files.write(empty, path, BYTE)
    assert id_files.read(spark, path).count() == 0


def _vectors(spark):
    a = [1.0, 0.0, 0.5]
    return spark.createDataFrame(
        [(1, a), (2, [2 * x for x in a]), (3, a), (3, a), (4, None), (5, [0.0] * 3), (6, [1.0, None, 0.0]),
         (7, [float("nan"), 1.0, 0.0]), (8, [float("inf"), 1.0, 0.0]), (9, [0.0, 1.0, 0.0]), (None, [0.0, 0.0, -1.0]), (10, [])],
        "vec_id long, embedding array<double>")


def test_dictionary_collects_no_long_texts(spark, monkeypatch):
    from pyspark.sql import DataFrame

    seen = []
    collect = type(spark.range(1)).collect

    def spied(df: DataFrame) -> list:
        rows = collect(df)
        seen.extend(len(r.text) for r in rows if "text" in r)
        return rows

    monkeypatch.setattr(type(spark.range(1)), "collect", spied)
    table = spark.createDataFrame([(1, "a b c " * 50), (2, "long " * 20_000)], "doc_id long, text string")
    id_files.write(table, common.new_path(spark, "ids"), BYTE)
    assert seen == [300]


def test_embedding_near_duplicates(spark):
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dup.near_duplicate_vectors(_vectors(spark)).collect()}
    assert got[1] == (3, 1, True) and got[2] == (3, 1, False) and got[3] == (3, 1, False)
    assert got[None] == (0, None, True)
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10))
    assert embedding_dup.near_duplicate_vectors(_vectors(spark).where("false")).count() == 0


def test_embedding_lists_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(embedding_dup, "BLOCK", 32)
    draw = np.random.default_rng(2)
    around = draw.normal(size=(6, 16))
    rows = around[draw.integers(0, 6, 400)] + draw.normal(size=(400, 16)) * draw.choice([0.1, 0.35], 400)[:, None]
    units = rows / np.linalg.norm(rows, axis=1)[:, None]
    near = units @ units.T >= 0.9
    np.fill_diagonal(near, False)
    groups = brute.components(list(range(400)), list(zip(*np.nonzero(near))))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dup.near_duplicate_vectors(table).collect()}
    assert got == {i: (int(near[i].sum()), groups[i]) for i in range(400)} and near.sum() > 1000


def test_embedding_links_of_a_dense_third(spark):
    n = 10_000
    draw = np.random.default_rng(4)
    rows = draw.normal(size=(n, 64))
    centre = draw.normal(size=64)
    rows[: n // 3] = centre / np.linalg.norm(centre) + draw.normal(size=(n // 3, 64)) * draw.choice([0.02, 0.035], (n // 3, 1))
    units = rows / np.linalg.norm(rows, axis=1)[:, None]
    links = (units @ units.T >= 0.9).sum(axis=1) - 1
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embedding_dup.near_duplicate_vectors(table).collect()}
    assert got == dict(enumerate(links.tolist())) and links.sum() > n * n // 30


def test_nearest_neighbours(spark, monkeypatch):
    vectors = _vectors(spark)
    got = sorted(map(tuple, neighbours.nearest(vectors, vectors.where("vec_id IN (1, 4, 9)"), k=3).collect()))
    assert [r[:3] for r in got if r[0] == 1] == [(1, 1, 2), (1, 2, 3), (1, 3, 3)]
    assert [r[:3] for r in got if r[0] == 9] == [(9, 1, 1), (9, 2, 2), (9, 3, 3)]
    assert not [r for r in got if r[0] == 4]
    assert neighbours.nearest(vectors.where("false"), vectors).count() == 0
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    monkeypatch.setattr(neighbours, "VECTOR_BLOCK", 50)
    rows = np.random.default_rng(4).integers(-3, 4, (300, 5)).astype(float)  # many ties
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(table, table.where("vec_id % 10 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    alive = [i for i in range(300) if rows[i].any()]
    for q, found in got.items():
        best = sorted(((-(rows[i] @ rows[q]) / np.sqrt((rows[i] @ rows[i]) * (rows[q] @ rows[q])), i) for i in alive if i != q))[:5]
        assert [(v, -s) for s, v in best] == [(v, s) for _, v, s in sorted(found)]
    assert set(got) == {i for i in alive if i % 10 == 0}


def test_license_scan(docs, clashing, empty, rows):
    for table in (docs, clashing):
        got = {r.doc_id: r for r in licenses.scan(table).collect()}
        assert got[13].n_base == 2 and got[13].base_labels == "cc-by,reserved" and (got[13].first_word, got[13].last_word) == (2, 6)
        assert got[1].n_words == 0 and got[1].labels == "" and got[1].score == 0 and got[1].first_word is None
        assert Counter(r.doc_id for r in licenses.scan(table).collect()) == Counter(r[0] for r in rows)
    assert licenses.scan(empty).count() == 0


def test_license_passage_with_changed_words(spark):
    passage = next(iter(licenses.PASSAGES)).split()
    texts = [(1, " ".join(["x", *passage[:9], "really", *passage[9:]])), (2, " ".join(passage[:8])), (3, "cc by cc by, CC/BY")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[1].labels == "apache" and got[1].n_base == 0 and got[1].spans[0]["first"] == 1
    assert got[2].labels == "" and 0 < got[2].score < 0.8
    assert got[3].n_base == 3 and got[3].labels == "cc-by" and got[3].score == 1


def test_license_pairs_must_stand_in_order(spark):
    passage = next(iter(licenses.PASSAGES)).split()
    pairs = [f"{a} {b}" for a, b in zip(passage, passage[1:])]
    texts = [
        (1, " ".join(reversed(pairs))), (2, " of it ".join(pairs)), (3, " ".join([*pairs[10:], *pairs[:10]])),
        # in order, with one word put in, one left out and one changed
        (4, " ".join([*passage[:5], "new", *passage[5:9], *passage[10:15], "other", *passage[16:]])),
        (5, " ".join([*passage, "and", *passage])),
        # every second word of the passage is from another template
        (6, " ".join(w for both in zip(passage, list(licenses.PASSAGES)[1].split()) for w in both)),
    ]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(1, 7)] == ["", "", "", "", "apache", ""]
    assert all(got[i].score < 0.5 for i in (1, 2, 3, 6)) and 0.5 < got[4].score < 0.8 and got[5].score == 1
    assert len(got[5].spans) == 2 and [x["first"] for x in got[5].spans] == [0, len(passage) + 1]


def test_license_templates_from_a_table(spark):
    templates = spark.createDataFrame(
        [("The Quick, brown fox!", "fox", False), ("all rights", "some", True), ("one", "none", True), ("The Quick, brown fox!", "fox", False)],
        "text string, label string, exact boolean")
    texts = [(1, "see the quick brown fox, all rights reserved"), (2, "a fox"), (3, None)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"), templates=templates).collect()}
    assert got[1].labels == "fox,reserved,some" and got[1].base_labels == "reserved,some" and got[1].n_base == 2
    assert got[2].labels == "" == got[3].labels


def test_mixing(docs, clashing, empty, rows):
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len((t or "").encode().split())
    for table in (docs, clashing):
        got = mixing.mix(table).collect()
        assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
        assert all(r.taken <= 3 * r["size"] and r.source_size == sizes[r.source] for r in got)
    assert mixing.mix(empty).count() == 0
    assert mixing.targets({}) == {}
    found = mixing.targets({"a": 10, "b": 1000, None: 0})
    assert found == {"a": 30.0, "b": 980.0, None: 0.0}


def test_fitted_lengths_against_all_choices():
    draw = random.Random(9)
    for _ in range(40):
        counts = Counter(draw.randint(1, 30) for _ in range(draw.randint(1, 6)))
        lengths = sorted(counts)
        budget = draw.randint(0, 60)
        sums = {0}
        for n in counts.elements():
            sums |= {s + n for s in sums}
        use = mixing.fit_lengths(lengths, [counts[n] for n in lengths], budget)
        assert all(u <= counts[n] for n, u in zip(lengths, use))
        assert sum(n * u for n, u in zip(lengths, use)) == max(s for s in sums if s <= budget)


def test_few_long_documents_meet_their_target():
    for lengths, target in (([50_000, 60_000], 100_000), ([40_000, 60_000, 70_000], 100_000),
                            ([33_000, 41_001, 52_003, 90_007, 400_000], 175_010)):
        base, more = mixing.fit_target(lengths, [1] * len(lengths), target, 3)
        assert sum(n * (base + m) for n, m in zip(lengths, more)) == target


def test_very_long_documents_are_fitted_in_bounded_memory():
    import tracemalloc

    lengths, counts = [*range(1, 3001), 10_000_000], [10] * 3000 + [1]
    for budget in (4_000_000, 10_000_123):
        tracemalloc.start()
        use = mixing.fit_lengths(lengths, counts, budget)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert all(0 <= u <= c for u, c in zip(use, counts)) and sum(n * u for n, u in zip(lengths, use)) == budget
        assert peak < 300 << 20
    # the long one takes part
    assert mixing.fit_lengths([10_000_000, 7], [1, 1], 10_000_000) == [1, 0]


def test_warc_references(spark):
    import html

    texts = ["&copy; 2024 &middot; A&amp;B &#169;&#xA9;&#XE9; &amp;lt; &unknown; & &; &#; &#x; R&D; caf&eacute;;x", "&hearts;&#128512;&#x1F600;&frac12;",
             "&quot;&apos;&#39;&lt;b&gt;", "a;b;c", "", "&Alpha;&alpha;&euro;&nbsp;x&#160;y&#xa0;z", "&#0;&#xD800;&#x110000;&#999999999;"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", warc.html_to_text("t").alias("t")).collect()
    got = {r.i: r.t for r in rows}
    for i, text in enumerate(texts[:-1]):
        expected = html.unescape(text).replace("\u00a0", " ").strip()
        assert got[i] == expected.replace("R&D;", "R&D;"), text
    assert got[len(texts) - 1] == "\ufffd" * 4


def test_warc_source_records(spark):
    responses = spark.createDataFrame(
        [(1, "<urn:uuid:1>", "http://x", "2024-01-01T00:00:00Z", "HTTP/1.1 404 Not Found\r\nServer: s", "<p>no</p>"), (2, "<urn:uuid:2>", None, None, None, None)],
        "source_id long, record_id string, target_uri string, date string, http_headers string, payload string")
    found = {r.source_id: r for r in warc.source_records(responses).collect()}
    assert found[1].record_type == "response" and found[1].block == "HTTP/1.1 404 Not Found\r\nServer: s\r\n\r\n<p>no</p>"
    assert found[2].record_type == "resource" and found[2].block == "" and "WARC-Target-URI" not in found[2].record
    derived = warc.derive(responses).collect()
    assert {r.refers_to for r in derived} == {r.record_id for r in found.values()}
    assert {r.source_id: r.source_digest for r in derived} == {i: r.source_digest for i, r in found.items()}
    metadata = {r.source_id: r.block for r in derived if r.record_type == "metadata"}
    assert "source-http-status: HTTP/1.1 404 Not Found\r\nsource-http-header: Server: s\r\n" in metadata[1]
    assert "http" not in metadata[2]
    assert warc.source_records(responses).columns == warc.derive(responses).columns


def test_quality_scores_against_a_plain_fit(spark):
    draw = random.Random(12)
    texts = [(i, _words(i, draw.randint(5, 120)) if i % 3 else " ".join(["spam!!"] * draw.randint(1, 60))) for i in range(240)]
    labels = [(i, int(i % 3 > 0) if draw.random() < 0.95 else 0) for i in range(240)]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in texts], DOCS)
    given = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.classify(docs.repartition(7), given).collect()}
    assert got == pytest.approx(brute.quality(texts, dict(labels)), abs=1e-5)


def test_sums_of_many_partitions_are_added_in_levels(spark, monkeypatch):
    monkeypatch.setattr(quality, "ADDED", 3)
    draw = np.random.default_rng(1)
    values = [(int(i % 4), float(i % 2), draw.normal(size=quality.STATISTICS).tolist()) for i in range(200) if i % 4 != 2]
    rows = spark.createDataFrame(values, "fold int, label double, statistics array<double>").repartition(23)
    rows = common.cut(rows, "many")
    assert rows.rdd.getNumPartitions() > 3
    model = quality.Model(np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS))
    sums = quality.normal_equations(rows, model)
    assert sorted(sums) == [0, 1, 3]
    for fold, (products, target, n) in sums.items():
        own = [v for v in values if v[0] == fold]
        z = model.features(np.array([v[2] for v in own]))
        assert n == len(own) and np.allclose(products, z.T @ z) and np.allclose(target, z.T @ np.array([v[1] for v in own]))


def test_warc(spark):
    pages = spark.createDataFrame(
        [(1, "http://x/\r\ny", "<p>a &amp;lt; b</p><script>no</script><!-- no --><br>c  d"), (2, None, None), (3, "u", ""), (3, "u", "")],
        "page_id long, url string, html string")
    got = warc.derive(warc.responses_from_pages(pages)).collect()
    assert len(got) == 8
    one = {r.record_type: r for r in got if r.source_id == 1}
    assert one["conversion"].block == "a &lt; b\nc d" and one["conversion"].refers_to == one["metadata"].refers_to
    assert one["conversion"].record_id in one["metadata"].block and one["conversion"].target_uri == "http://x/ y"
    block = one["conversion"].block.encode()
    assert one["conversion"].block_digest == "sha256:" + hashlib.sha256(block).hexdigest()
    assert one["conversion"].content_length == len(block)
    head, _, rest = one["metadata"].record.partition("\r\n\r\n")
    assert head.startswith("WARC/1.1\r\nWARC-Type: metadata") and rest == one["metadata"].block + "\r\n\r\n"
    two = [r for r in got if r.source_id == 2]
    assert all("WARC-Target-URI" not in r.record for r in two) and {r.block for r in two} >= {""}
    assert len({r.record_id for r in got if r.source_id == 3}) == 2
    assert warc.derive(warc.responses_from_pages(pages.where("false"))).count() == 0
    path = common.new_path(spark, "warc")
    warc.write_files(warc.derive(warc.responses_from_pages(pages)), path)
    text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    assert len(text) == sum(len(r.record) for r in got) and all(r.record in text for r in got)


def test_pipeline_stages(spark, docs, clashing, empty, tmp_path):
    _labels(spark).coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    for table in (docs, clashing):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, table, str(tmp_path)).count() >= 0
            assert name == "packing" or stage(spark, empty, str(tmp_path)).columns == empty.columns
    first = corpus_pipeline.near_dup(spark, docs, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in first)[10] == 1 and len(first) == 14 - 2
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_lyndon_words_and_runs_of_small_texts():
    draw = random.Random(5)
    for _ in range(600):
        letters = [draw.randrange(draw.randint(1, 4)) for _ in range(draw.randint(1, 40))]
        if draw.random() < 0.5:
            letters = (letters[: draw.randint(1, 8)] * 40)[: len(letters)]
        assert periodic.lyndon_lengths(letters) == brute.lyndon_lengths(letters)
        assert periodic.lyndon_lengths(letters, True) == brute.lyndon_lengths([-x for x in letters])
        words = [bytes([97 + x]) for x in letters]
        for least in (2, 5, 12):
            # the second document must not meet the first
            assert periodic.find_runs([words, words], least) == [brute.runs(words, least)] * 2


def test_periodic_runs(spark, docs, clashing, empty, rows):
    more = [(20, "a b " * 9), (21, "x " + "c\td\u00a0e\n" * 6 + "y"), (22, "z " * 40_000), (23, "Fib " * 5)]
    given = docs.unionByName(spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in more], DOCS))
    expected = Counter()
    for i, t in [*[(r[0], r[1]) for r in rows], *more]:
        words = (t or "").encode().split()
        if i != 22:
            runs = brute.runs(words, 12) if len(words) < 1000 else []
        else:
            runs = [(0, 40_000, 1)]
        gone = {k for a, n, p in runs for k in range(a + p, a + n)}
        expected[i, tuple(runs), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()] += 1
    got = periodic.periodic_runs(given).collect()
    assert Counter((r.doc_id, tuple(tuple(x) for x in r.runs), r.collapsed) for r in got) == expected
    assert [r.runs[0].period for r in got if r.doc_id in (20, 21, 22)] == [2, 2, 1]
    assert periodic.periodic_runs(clashing).count() == len(rows)
    assert periodic.periodic_runs(empty).collect() == []


def test_made_periodic():
    words = [b"%d" % i for i in range(50)]
    for i in (*range(200), -7, 10**18):
        assert periodic.made_periodic(i, words) == brute.made_periodic(i, words)
    assert periodic.made_periodic(None, words) == words and periodic.made_periodic(3, []) == []


def _plan_parts(counts: dict, capacity: int) -> tuple[int, int]:
    """Check a plan; how many windows it has and how many cuts."""
    plan = slack.SlackPlan(dict(counts), capacity)
    parts, windows = {}, {}
    for length, first, start, size, window, offset, count in plan.slots:
        for k in range(count):
            parts.setdefault((length, first + k), []).append((start, size))
            windows.setdefault(window + k, []).append((offset, size))
    assert set(parts) == {(n, i) for n, c in counts.items() for i in range(c)}
    for places, whole in [*[(p, n) for (n, _), p in parts.items()], *[(p, None) for p in windows.values()]]:
        end = 0
        for start, size in sorted(places):
            assert start == end
            end += size
        assert end == whole if whole else end == capacity or end & (end - 1) == 0
    assert sum(sum(s for _, s in p) < capacity for p in windows.values()) == bin(
        sum(n * c for n, c in counts.items()) % capacity).count("1")
    return len(windows), sum(len(p) - 1 for p in parts.values())


def test_ids_that_do_not_fit_their_width_are_an_error(spark, docs):
    with pytest.raises(ValueError, match="width"):
        id_files.write(docs, common.new_path(spark, "ids"), BYTE, end_id=70_000, width=2)


def test_slack_plans():
    draw = random.Random(3)
    for _ in range(300):
        capacity = 2 ** draw.randint(1, 8)
        counts = {draw.randint(1, capacity - 1): draw.randint(1, draw.choice([1, 3, 30])) for _ in range(draw.randint(0, 20))}
        _plan_parts(counts, capacity)
    # exact fillings are found where there are any
    assert _plan_parts({n: 1 for n in range(1, 1024)}, 1024) == (512, 0)
    assert _plan_parts({600: 1000, 300: 1000, 124: 1000}, 1024) == (1000, 0)
    # and everything else is cut: no two of 700 fit
    windows, cuts = _plan_parts({700: 1024}, 1024)
    assert windows == 700 and cuts >= 600


def test_least_slack_is_least():
    draw = random.Random(4)
    for _ in range(200):
        room = draw.randint(1, 40)
        counts = {draw.randint(1, 30): draw.randint(1, 3) for _ in range(draw.randint(0, 5))}
        used = slack.least_slack(counts, room)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        assert all(k <= counts[n] for n, k in used.items())
        assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= room)


def test_slack_packing(spark, docs, clashing, empty, rows):
    from test_queries import _check_slack

    more = [(30 + i, _words(40 + i, 30 + 17 * i), "en", "a", 1) for i in range(40)]
    given = docs.unionByName(spark.createDataFrame(more, DOCS))
    texts = Counter((r[0], r[1]) for r in [*rows, *more])
    _check_slack(slack.pack_with_least_slack(given, BYTE).collect(), texts)
    small = slack.pack_with_least_slack(given, BYTE, capacity=64).collect()
    _check_slack(small, texts, 64)
    assert slack.pack_with_least_slack(clashing, BYTE).count() >= len(rows)
    assert slack.pack_with_least_slack(empty, BYTE).collect() == []
    with pytest.raises(ValueError):
        slack.pack_with_least_slack(docs, BYTE, capacity=1000)


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def _trie(spark, rows, schema=CONVERSATIONS, more=()):
    given = spark.createDataFrame(rows, schema)
    for c in more:
        given = given.withColumn(c, spark.range(1).selectExpr("'x'").scalar())
    turns = trie.numbered_turns(given)
    got = trie.prefix_trie(turns, turns.select("conv_id").distinct()).collect()
    return sorted(tuple(r) for r in got)


def test_prefix_trie(spark):
    draw = random.Random(9)
    rows = [
        (1, None, "u", "a"), (1, 1, None, None), (1, 1, "", "b"), (2, 5, "u", "a"), (2, 5, "u", "a"),
        (3, 0, "u", "a"), (3, 1, "", ""), (3, 2, "", "b"), (4, 0, "ua", ""), (None, 0, "u", "a"), (-5, 0, "u", "a"),
        (6, 0, "u", "\U0001f600" * 3), (7, 0, "u", "\U0001f600" * 3),
    ]
    for conv in range(10, 60):
        rows += [(conv, t, "r", draw.choice("aab")) for t in range(draw.randint(1, 9))]
    # a deep one, twice, and turn numbers far apart
    rows += [(c, t * 3000, "r", "aab"[t % 3]) for c in (70, 71) for t in range(70 + c % 2)]
    # copies
    rows += [(100 + c, t, "r", "copied") for c in range(300) for t in range(2)]
    assert _trie(spark, rows) == brute.trie(brute.conversations(rows))
    assert _trie(spark, rows[:9], more=("depth", "name", "position", "place", "of")) == brute.trie(brute.conversations(rows[:9]))
    assert _trie(spark, rows[:1]) == brute.trie(brute.conversations(rows[:1]))
    assert _trie(spark, []) == [] == _trie(spark, rows[9:10])


def test_ends_of_many_conversations_are_hashed_in_order(spark):
    rows = [(c, 0, "u", "same") for c in range(9000, -1, -1)]
    got = _trie(spark, rows)
    assert got == brute.trie(brute.conversations(rows)) and len(got) == 2


def test_rebuilt_conversations(spark):
    draw = random.Random(10)
    rows = [(c, t, "r", f"{c}-{t}") for c in [*range(0, 30), *range(100, 103), *range(250, 280)] for t in range(draw.randint(1, 8))]
    turns = trie.numbered_turns(spark.createDataFrame(rows, CONVERSATIONS))
    got = trie.rebuilt(turns, turns.select("conv_id").distinct()).collect()
    expected = brute.rebuilt(brute.conversations(rows))
    assert Counter((r.conv_id, r.position, r.role, r.text) for r in got) == Counter(
        (c, i, *turn) for c, own in expected.items() for i, turn in enumerate(own, 1))


def test_stages_drop_what_earlier_ones_left(spark, docs):
    import os

    app = spark.sparkContext.applicationId
    common.release(spark)
    first = common.cut(corpus_pipeline.near_dup(spark, docs, ""), "first")
    left = list(common._LEFT[app])
    assert left and all(os.path.exists(p) for p in left)
    # not written: the next stage reads what this one left, which therefore stays
    lazy = corpus_pipeline.repeats(spark, first, "")
    tables = {t for t in common._TABLES.values() if spark.catalog.tableExists(t)}
    assert tables and not any(os.path.exists(p) for p in left) and os.path.exists(first.inputFiles()[0][7:])
    mixed = corpus_pipeline.mixing(spark, lazy, "")
    assert mixed.count() >= 1 and any(os.path.exists(p) for p in common._LEFT[app])
    common.release(spark)
    assert not any(spark.catalog.tableExists(t) for t in tables)
