import random

import corpus_pipeline
import duckdb
import pytest
from reference_forms import jaccard_components, plain_words
from reference_forms import contamination as brute_contamination

from tidelog.llm import catalog, toxicity

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found = catalog.QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    shown = ", ".join(f'"{c}"' for c in columns)
    want = db.execute(f"SELECT {shown} FROM ({catalog.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, found.select(columns).collect()), key=repr) == sorted(want, key=repr)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))


def test_entry_has_the_queries():
    import __spark_entry__

    assert {*catalog.QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert set(catalog.ORACLE_SQL) <= set(__spark_entry__.oracle_sql())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op4_decontamination", "op5_preference_pairs", "op7_url_filter"])
def test_native_queries_run_no_python(spark, sf_dir, name):
    plan = plan_of(catalog.QUERIES[name](spark, sf_dir))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))


@pytest.fixture(scope="module")
def corpus(spark, sf_dir):
    """Documents with extra columns whose names the stages use themselves."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = spark.createDataFrame(
        [(100000, None), (100001, ""), (None, "a text without id"), (100002, "x y z w"), (100002, "x y z w")],
        "doc_id long, text string",
    ).selectExpr("doc_id", "text", "'xx' AS lang", "'more' AS source", "CAST(length(text) AS BIGINT) AS n_chars")
    return docs.union(more.select(docs.columns)).selectExpr("*", "1 AS __score", "doc_id AS component_id", "'t' AS n_words")


def test_toxic_stage(spark, corpus, sf_dir):
    kept = corpus_pipeline.drop_toxic(spark, corpus, sf_dir)
    assert kept.columns == corpus.columns
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.judge(spark, corpus, labels).select("doc_id", "predicted").collect()
    gone = {r.doc_id for r in scored if r.predicted}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored} - gone
    assert kept.count() == sum(r.predicted == 0 for r in scored)


def test_near_duplicate_stage(spark, corpus, sf_dir):
    kept = corpus_pipeline.drop_near_duplicates(spark, corpus, sf_dir)
    assert kept.columns == corpus.columns
    rows = [(r.doc_id, r.text) for r in corpus.collect() if r.doc_id is not None]
    want = sorted({d for d, _, c in jaccard_components(rows, 80, 5) if d == c})
    found = [r.doc_id for r in kept.collect()]
    assert sorted(d for d in found if d is not None) == want and found.count(None) == 1


def test_near_duplicates_are_rows_not_ids(spark, sf_dir):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choices([f"w{i}" for i in range(300)], k=80))
    near = lambda t: t + " tail"
    a, b, c, d, e, f, g = (text() for _ in range(7))
    rows = [
        (1, a), (5, near(a)),  # 5 goes as a copy of 1 ...
        (5, b), (6, near(b)), (7, b),  # ... but stays as the first of b
        (5, c),  # ... and as the only one of c
        (9, d), (9, near(d)),  # one of two copies with one id
        (None, e), (None, e), (None, near(e)),  # one of three without id
        (None, near(f)), (20, f),  # the one with an id
        (None, g), (None, None), (30, None), (31, ""), (31, ""),
    ]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    sure = [(1, a), (5, b), (5, c), (20, f), (None, g), (None, None), (30, None), (31, "")]
    assert all(found.count(x) == 1 for x in sure)
    rest = sorted((x for x in found if x not in sure), key=repr)
    assert len(rest) == 2 and rest[0] in [(9, d), (9, near(d))] and rest[1] in [(None, e), (None, near(e))]


def test_contaminated_stage(spark, corpus, sf_dir):
    kept = corpus_pipeline.drop_contaminated(spark, corpus, sf_dir)
    assert kept.columns == corpus.columns
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    assert any(plain_words(t) for _, t in items)
    want = [d for d, *_, bad in brute_contamination(rows, items) if not bad]
    assert sorted(map(str, want)) == sorted(str(r.doc_id) for r in kept.collect())


def test_stages_take_empty_tables(spark, corpus, sf_dir):
    docs = corpus.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).collect() == []


def test_whole_pipeline(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = [r.doc_id for r in found]
    assert len(ids) == len(set(ids)) and set(ids) < set(docs)
    assert all(len(r.ids) == 4 * r.n_tokens for r in found)
