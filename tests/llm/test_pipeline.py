import random

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from lagloom.llm.queries import ORACLES, QUERIES
from tests.llm.fixtures import SCHEMA, edge_rows, frame, prose
from tests.llm.test_bpe import want
from tests.llm.test_decontaminate import ITEMS
from tests.llm.test_jaccard import brute
from tests.llm.test_toxicity import BAD, LABELS, corpus


def test_every_operator_and_the_pipeline_are_registered():
    names = [name.split("_")[0] for name in QUERIES]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_stages_against_brute_force(spark, tmp_path):
    rows, labels = corpus(500, seed=8)
    pick = random.Random(1)
    clean = [(1_000 + i, prose(4_000 + i), "en", "s", None) for i in range(30)]
    copies = [(2_000 + i, " ".join(text.split()[:-2] + [f"new{i}"]), "en", "s", None) for i, (_, text, *_) in enumerate(clean[:10])]
    leaks = [(3_000 + i, f"{prose(6_000 + i)} {ITEMS[i][1]} {prose(7_000 + i)}", "en", "s", None) for i in range(5)]
    secret = [(4_000, f'{prose(8_000)} token="abcdefgh12345" end', "en", "s", 9)]
    toxic = [(5_000 + i, " ".join(pick.choice(BAD) if k % 9 == 0 else f"anb{k}o" for k in range(60)), "en", "s", None) for i in range(5)]
    edge = [(None if i is None else 6_000 + i, *rest) for i, *rest in edge_rows()]
    documents = rows + clean + copies + leaks + secret + toxic + edge
    frame(spark, documents).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    frame(spark, ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    first = stages["toxicity"](spark, docs, str(tmp_path))
    kept = {r.doc_id: r.text for r in first.collect()}
    assert first.columns == docs.columns
    marked = {i for i, _, t in labels if t}
    assert not any(5_000 <= (i or 0) < 5_010 for i in kept)
    assert len(marked & set(kept)) <= 0.1 * len(marked)
    assert {r[0] for r in clean + leaks + secret + edge} <= set(kept)
    assert len([i for i, _, t in labels if not t and i not in kept]) <= 0.01 * len(labels)

    left = [r for r in documents if r[0] in kept]
    second = stages["ngram_jaccard_join"](spark, frame(spark, left), str(tmp_path))
    found = sorted((r.doc_id is not None, r.doc_id or 0) for r in second.collect())
    stays = {(True, i) for i, _, component, _ in brute(left, 5, 80) if i == component} | {(False, 0)}
    assert found == sorted(stays) and second.schema == frame(spark, left).schema

    third = stages["benchmark_decontamination"](spark, frame(spark, left), str(tmp_path))
    assert sorted(r[0] or -1 for r in third.collect()) == sorted(r[0] or -1 for r in left if not 3_000 <= (r[0] or 0) < 3_010)
    fourth = {r.doc_id: r.text for r in stages["secret_scans"](spark, frame(spark, left), str(tmp_path)).collect()}
    assert fourth[4_000].endswith('[assign]" end')
    assert {i: t for i, t in fourth.items() if i != 4_000} == {r[0]: r[1] for r in left if r[0] != 4_000}

    result = corpus_pipeline.run(spark, str(tmp_path))
    assert [c for c in result.columns if c not in ("n_tokens", "ids_sha256", "decoded_sha256")] == ["doc_id", "lang", "source", "n_chars"]
    for row in result.collect():
        if row.doc_id in (1_029, 6_004):
            assert row.n_tokens == len(want(kept[row.doc_id]))


def test_extra_columns_come_out_unchanged(spark, tmp_path):
    extra = {"score": "42", "_score": "7", "n_tokens": "'x'", "_before": "1", "_part": "2", "nth": "3", "_row": "4", "_ids": "5"}
    rows = [(i, prose(i), "en", "s", 1) for i in range(20)] + [(20, None, "en", "s", 1)] * 2 + [(3, prose(3), "en", "s", 1)]
    found = frame(spark, rows).selectExpr("*", *[f"{value} as {name}" for name, value in extra.items()])
    found.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, 1), (2, 0, 0)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    frame(spark, ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path))
    want_columns = [*[c for c in found.columns if c != "text"], "_n_tokens", "ids_sha256", "decoded_sha256"]
    assert result.columns == want_columns
    kept = result.collect()
    assert len({r.doc_id for r in kept}) == len(kept)  # repeated rows, also without a text, stay once
    for row in kept:
        assert {name: getattr(row, name) for name in extra} == {n: (v.strip("'") if v[0] == "'" else int(v)) for n, v in extra.items()}


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
