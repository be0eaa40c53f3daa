"""The pipeline's stages, one after the other, against brute force; and the registered queries."""

import brute
import corpus_pipeline
import pytest

from tableload.llm import pfair_mix

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's output over the smallest tables, as lists of rows."""
    root = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out.append((name, docs))
    return out


def test_stages_in_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "mix", "encode"]
    columns = stages[0][1].columns
    assert all(df.columns == columns for _, df in stages[:-1])


def test_stage_results(spark, stages):
    rows = [{r["doc_id"]: r.asDict() for r in df.collect()} for _, df in stages]
    raw, good, lines, single, mixed, coded = rows
    kept = {d for d, r in raw.items() if brute.counts(r["text"])[0] >= 50}
    assert set(good) <= kept and len(good) > 0.8 * len(kept)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [d for d in kept if labels.get(d) == 1]
    assert sum(d in good for d in clean) >= 0.95 * len(clean)
    expected = brute.kept_lines({d: r["text"] for d, r in good.items()})
    assert {d: r["text"] for d, r in lines.items()} == {d: t for d, (_, _, t) in expected.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in lines.values())
    groups = brute.components({d: r["text"] for d, r in lines.items()})
    assert set(single) == {d for d, (_, c) in groups.items() if c == d}
    assert mixed == single
    assert set(coded) == set(mixed)
    assert all(coded[d]["decoded_sha256"] == brute.sha(r["text"].encode()) for d, r in mixed.items())


def test_output_carries_the_mix(stages):
    """Rows ordered by slot and place follow the weights to within a block, until a source has run out."""
    mixed, coded = stages[-2][1], stages[-1][1]
    rows = sorted((r["slot"], r["place"], r["doc_id"], r["source"] or "") for r in coded.collect())
    assert len({r[:2] for r in rows}) == len(rows)
    planned = pfair_mix.mix_schedule(mixed).collect()
    assert rows == sorted((r["slot"], r["place"], r["doc_id"], r["source"]) for r in planned)
    parts = {r["source"]: r["parts"] for r in pfair_mix.source_parts(mixed).collect()}
    total, had = sum(parts.values()), dict.fromkeys(parts, 0)
    turns = {slot: source for slot, _, _, source in rows}
    t = 0
    while t in turns:
        had[turns[t]] += 1
        t += 1
        assert all(abs(had[s] - t * parts[s] / total) < 1 for s in parts)
    assert t >= len(parts)


def test_run_equals_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    last = stages[-1][1]
    assert got.columns == last.columns
    assert got.exceptAll(last).count() == 0 and last.exceptAll(got).count() == 0


def test_stages_take_odd_tables(spark, empty, repeated):
    for docs in (empty, repeated):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() <= docs.count()


def test_entry_has_all_queries():
    from __spark_entry__ import oracle_sql, queries

    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries() and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", ["op2_line_dedup", "op5_merkle_audit", "op9_jaccard_join", "op10_pfair_mix", "op11_hard_negatives"])
def test_queries_match_sql(spark, name):
    import duckdb
    from tools.oracle_check import TABLES, rows_of_duck, rows_of_spark

    from __spark_entry__ import oracle_sql, queries

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert rows_of_spark(queries()[name](spark, SF)) == rows_of_duck(con, oracle_sql()[name])
