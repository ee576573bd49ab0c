"""Every query over whole small tables, against SQL or a plain answer."""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import oracle
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerline.llm import common
from ledgerline.llm.catalog import ORACLE_SQL, QUERIES

FOLDER = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module", autouse=True)
def cleared(spark):
    yield
    common.release(spark)


@pytest.fixture(scope="module")
def duck():
    con = oracle.connect(FOLDER)
    yield con
    con.close()


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def test_all_are_registered():
    from __spark_entry__ import oracle_sql, queries

    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_result_as_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    assert not oracle.differences(df, duck, ORACLE_SQL[name])
    if name.startswith("op8"):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_repeats(spark, documents):
    rows = QUERIES["op1_repeat_removal"](spark, FOLDER).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    expected = brute.without_repeats([(t or "").encode() for _, t in documents], 400)
    assert got == {i: e for (i, _), e in zip(documents, expected)}
    assert sum(e[1] for e in expected) > 0
    texts = dict(documents)
    for r in rows:
        # parts of characters at the ends of a run stay in the text
        size = len(r.kept_text.encode())
        assert r.n_bytes - r.n_removed <= size <= r.n_bytes - r.n_removed + 6 * r.n_spans
        assert r.n_removed or r.kept_text == (texts[r.doc_id] or "")


def test_repeated_passages_in_the_text(spark, documents):
    got = {r.doc_id: r.text for r in QUERIES["op1_repeat_removal"](spark, FOLDER).collect()}
    assert got == dict(zip([i for i, _ in documents], brute.without_passages([t or "" for _, t in documents], 400, 51)))


def test_near_duplicates(spark, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op2_minhash_near_dup"](spark, FOLDER).collect()}
    assert got == brute.near_duplicates(documents, 2)


def _check_packing(rows, texts: Counter):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    total = 0
    for (doc_id, text), n in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        total += len(ids) * n
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected[doc_id, piece, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += n
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    return len(sequences), total


def test_packing(spark, documents):
    rows = QUERIES["op3_best_fit_packing"](spark, FOLDER).collect()
    sequences, total = _check_packing(rows, Counter(documents))
    assert sequences <= -(-total // 4096) + 1


def test_quality(spark, duck):
    folder = FOLDER.replace("sf0.001", "sf0.01")
    rows = QUERIES["op4_quality"](spark, folder).collect()
    con = oracle.connect(folder)
    truth = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    assert len(rows) == con.execute("SELECT count(*) FROM documents").fetchone()[0]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in held) >= 0.95 * len(held) > 0


def test_id_files(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, start = {}, 0
    for doc_id, text in documents:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        expected[doc_id] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    rows = QUERIES["op5_id_files"](spark, FOLDER).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == expected and len(rows) == len(expected)


@pytest.fixture(scope="module")
def vectors(duck):
    rows = duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    units = np.array([v for _, v in rows], dtype=float)
    return np.array([i for i, _ in rows]), units / np.linalg.norm(units, axis=1)[:, None]


def test_embedding_near_duplicates(spark, vectors):
    ids, units = vectors
    near = units @ units.T >= 0.9
    np.fill_diagonal(near, False)
    groups = brute.components(ids.tolist(), [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in QUERIES["op6_embedding_near_dup"](spark, FOLDER).collect()}
    assert got == {i: (int(n), groups[i], groups[i] == i) for i, n in zip(ids.tolist(), near.sum(axis=1))}


def test_nearest_neighbours(spark, vectors):
    ids, units = vectors
    got = defaultdict(list)
    for r in QUERIES["op7_nearest_neighbours"](spark, FOLDER).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in ids.tolist() if i % 50 == 0}
    for q, found in got.items():
        at = ids.tolist().index(q)
        scores = units @ units[at]
        scores[at] = -2
        best = np.lexsort((ids, -scores))[:5]
        assert [v for _, v, _ in sorted(found)] == ids[best].tolist()
        assert [s for _, _, s in sorted(found)] == pytest.approx(scores[best].tolist(), abs=1e-12)


def test_mixing(spark, documents):
    rows = QUERIES["op9_mixing"](spark, FOLDER).collect()
    sizes = {i: len((t or "").encode().split()) for i, t in documents}
    assert {r.doc_id: r["size"] for r in rows} == sizes
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
        assert r.taken <= 3 * r["size"] and r.taken == r.times * r["size"]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(by_source))}
    for source, own in by_source.items():
        words = sum(r["size"] for r in own)
        assert {r.source_size for r in own} == {words}
        (target,) = {r.target for r in own}
        assert target <= 3 * words + 1e-6
        assert abs(sum(r.taken for r in own) - target) <= max(10, 0.02 * target)
    free = {s: by_source[s][0].target / weights[s] for s in by_source
            if by_source[s][0].target < 3 * by_source[s][0].source_size - 1e-6}
    assert max(free.values()) == pytest.approx(min(free.values()))
    assert sum(own[0].target for own in by_source.values()) == pytest.approx(sum(sizes.values()))
    again = {r.doc_id: r.taken for r in QUERIES["op9_mixing"](spark, FOLDER).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_periodic_runs(spark, documents):
    expected = {}
    for doc_id, text in documents:
        words = brute.made_periodic(doc_id, (text or "").encode().split())
        runs = brute.runs(words, 12)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        gone = {i for start, length, period in runs for i in range(start + period, start + length)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        expected[doc_id] = (len(runs), *figures, *(hashlib.sha256(x).hexdigest() for x in (lines.encode(), kept)))
    rows = QUERIES["op11_periodic_runs"](spark, FOLDER).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == expected and len(rows) == len(expected)
    assert sum(e[0] > 0 for e in expected.values()) >= len(expected) // 20


def _check_slack(rows, texts: Counter, capacity: int = 1024):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {key: [*tokenizer.encode(key[1] or "", add_special_tokens=False).ids, 0] for key in texts}
    covered, found, sequences = defaultdict(Counter), Counter(), defaultdict(list)
    by_id = defaultdict(list)
    for doc_id, text in texts:
        by_id[doc_id].append(ids[doc_id, text])
    for r in rows:
        part = [x[r.start : r.start + r.length] for x in by_id[r.doc_id] if len(x) == r.doc_tokens]
        assert r.length > 0
        assert r.ids_crc32 in [zlib.crc32(struct.pack(f"<{len(p)}I", *p)) for p in part if len(p) == r.length]
        covered[r.doc_id, r.doc_tokens][r.start] += 1
        covered[r.doc_id, r.doc_tokens][r.start + r.length] -= 1
        found[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    sizes, expected = Counter(), Counter()
    for (doc_id, text), n in texts.items():
        sizes[doc_id, len(ids[doc_id, text])] += n
        expected[doc_id] += n * len(ids[doc_id, text])
    assert found == expected
    for (doc_id, size), n in sizes.items():
        assert {k: v for k, v in covered[doc_id, size].items() if v} == {0: n, size: -n}
    lengths = Counter()
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        lengths[end] += 1
    total = sum(expected.values())
    # nothing is padded: whole windows, and the rest in powers of two
    assert lengths == Counter({capacity: total // capacity} if total >= capacity else {}) + Counter(
        1 << k for k in range(capacity.bit_length()) if total % capacity >> k & 1
    )
    return len(sequences)


def test_slack_packing(spark, documents):
    rows = QUERIES["op13_slack_packing"](spark, FOLDER).collect()
    _check_slack(rows, Counter(documents))
    # most documents are cut at whole windows at most
    assert sum(r.start % 1024 > 0 for r in rows) < len(documents) / 2


def test_pipeline(spark, documents):
    texts = dict(documents)
    docs = common.table(spark, FOLDER, "documents")
    columns = docs.columns
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.cut(stage(spark, docs, FOLDER), f"test-{name}")
        found[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    good = {r.doc_id: r.text for r in found["quality"]}
    assert 0.7 * len(texts) < len(good) < len(texts) and all(texts[i] == t for i, t in good.items())
    groups = brute.near_duplicates(sorted(good.items()), 5)
    assert sorted(r.doc_id for r in found["near_dup"]) == [i for i in sorted(good) if groups[i][2] or not groups[i][0]]
    distinct = sorted(found["near_dup"], key=lambda r: r.doc_id)
    after = {r.doc_id: r for r in found["repeats"]}
    expected = brute.without_passages([r.text for r in distinct], 400, 51)
    assert {r.doc_id: r.text for r in found["repeats"]} == {r.doc_id: t for r, t in zip(distinct, expected)}
    assert all(r.n_chars == len(r.text) for r in found["repeats"])
    assert any(t != r.text for r, t in zip(distinct, expected))
    times = Counter(r.doc_id for r in found["mixing"])
    assert max(times.values()) <= 3 and all(r.text == after[r.doc_id].text for r in found["mixing"])
    _check_packing(found["packing"], Counter((r.doc_id, r.text) for r in found["mixing"]))
    assert corpus_pipeline.run(spark, FOLDER).count() == len(found["packing"])
