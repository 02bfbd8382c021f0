"""Registered queries of the operators: against their SQL, or against plain models on the whole table."""

import hashlib
import os
from collections import Counter, defaultdict

import pytest
from oracle import TESTDATA, compare, connect

import __spark_entry__ as entry
import corpus_pipeline
from helpers import awkward, docs
from tidegate.llm import queries

SF_DIR = f"{TESTDATA}/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_all_are_registered():
    found = entry.queries()
    assert all(any(name.startswith(f"op{n}_") for name in found) for n in range(1, 14)) and "pipeline" in found


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    assert compare(spark, connect(SF_DIR), entry.queries()[name], queries.ORACLES[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES) - {"op13_whitened_components"}))
def test_each_document_answered(spark, name):
    ids = Counter(r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect())
    found = entry.queries()[name](spark, SF_DIR)
    rows = found.filter("piece = 0") if "piece" in found.columns else found
    assert Counter(r.doc_id for r in rows.select("doc_id").collect()) == ids


def test_near_copies_of_the_table(spark):
    from test_near_dedup import model

    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = entry.queries()["op4_prob_min_hash"](spark, SF_DIR).select("doc_id", "class_id", "class_size")
    assert Counter(map(tuple, found.collect())) == model(rows)


def test_runs_of_the_table(spark):
    from test_runs import answer

    rows = [r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect() if len(r.text or "") < 8000]
    want = {r.doc_id: answer(r.doc_id, r.text) for r in rows}
    found = {r.doc_id: tuple(r) for r in entry.queries()["op12_dyadic_runs"](spark, SF_DIR).collect()}
    assert {i: found[i] for i in want} == want


def test_languages_of_the_table(spark):
    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = [r for r in entry.queries()["op11_viterbi_spans"](spark, SF_DIR).collect() if r.held_out]
    assert sum(labels[r.doc_id] == r.lang_pred for r in found) >= 0.95 * len(found)


def test_components_of_the_table(spark):
    import numpy as np
    from test_whitening import model

    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    rows = [r for r in rows if r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding)]
    n, deviation, whitened, explained = model([r.embedding for r in rows])
    at = {r.vec_id: i for i, r in enumerate(rows)}
    found = entry.queries()["op13_whitened_components"](spark, SF_DIR).collect()
    assert len(found) == 8 * len(rows) and max(r.identity_error for r in found) < 1e-9
    for r in found:
        assert (r.n, r.deviation) == (n, deviation[at[r.vec_id]])
        assert abs(abs(r.whitened) - abs(whitened[at[r.vec_id], r.component - 1])) < 1e-6
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9


def stage_rows(docs):
    return Counter((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())


def pieces_are_packed(pieces, rows):
    """Every document's ids, cut as they must be, in sequences without gaps, few of them."""
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_padding()
    tokenizer.no_truncation()
    want, total = Counter(), 0
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        total += len(ids)
        cuts = [0, *range(len(ids) % 1024 or min(1024, len(ids)), len(ids) + 1, 1024)]
        want.update((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces) == want
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(parts[-1]) <= 1024
    assert len(sequences) <= 1.02 * -(-total // 1024) + 1


def test_pipeline_stages(spark, tmp_path):
    """Each stage against what its operator decides, on what the stage before kept."""
    from test_near_dedup import model as near_model
    from test_exact_dedup import model as exact_model
    from test_substring import model as substring_model

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF_DIR)
        after.write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert after.columns == docs.columns
        rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
        if name == "toxicity":
            judged = queries.op1_factorization_machine(spark, SF_DIR).filter("predicted = 0").select("doc_id").collect()
            assert Counter(r.doc_id for r in after.select("doc_id").collect()) == Counter(r.doc_id for r in judged)
        elif name == "exact_dedup":
            assert {r.doc_id for r in after.collect()} == {k for _, k, _, _ in exact_model(rows)}
        elif name == "near_dedup":
            assert {r.doc_id for r in after.collect()} == {c for _, c, _ in near_model(rows)}
        elif name == "substring_dedup":
            assert all(r.n_chars == len(r.text) for r in after.collect())
            split = Counter((i, len(t.split()), hashlib.sha256(" ".join(t.split()).encode()).hexdigest()) for i, t in after.select("doc_id", "text").collect())
            want = Counter({(i, n - gone, digest): times for (i, n, gone, digest), times in substring_model(rows, 13).items()})
            assert split == want
        else:
            pieces_are_packed(after.collect(), rows)
        before = after
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in whole.collect()) == Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in before.collect())


def test_stages_on_awkward_rows(spark, tmp_path):
    rows = awkward()
    before = docs(spark, rows).withColumnRenamed("kept", "N_words")
    columns = before.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "exact_dedup":
            texts = [r.text for r in after.collect()]
            assert len(texts) == len({" ".join((t or "").split(" ")) for t in texts})
        if k < 4:
            assert after.columns == columns
        before = after


def test_two_pipelines_built_before_either_runs(spark):
    """Stages own their tables: what one of them writes and removes is nothing to another."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "n_chars")
    halves = [docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")]
    for name, stage in corpus_pipeline.STAGES:
        built = [stage(spark, half, SF_DIR) for half in halves]
        counts = [b.count() for b in reversed(built)][::-1]
        assert [stage(spark, half, SF_DIR).count() for half in halves] == counts, name


def test_a_run_leaves_only_its_result(spark, tmp_path, monkeypatch):
    from tidegate import session

    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["packed"]


def test_stages_on_no_rows(spark, tmp_path):
    before = docs(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        before = spark.read.parquet(f"{tmp_path}/{name}")
        assert before.count() == 0
