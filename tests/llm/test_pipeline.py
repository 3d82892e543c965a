import corpus_pipeline
from stratagrid.llm import queries


def test_stages_keep_the_columns(spark, tmp_path):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, None, None, None), (None, "the of and in", "en", "src1", 3), (10**6 + 1, "", "en", "s", 0), (10**6 + 2, "password=hunter22 the of and that", "en", "s", 5)], base.schema)
    docs = base.union(base.limit(5)).union(odd).selectExpr("*", "1 as rep", "2 as __source", "3 as __lang_pred", "4 as row_of_docs", "5 as key_of_gone", "6 as mix_topic", "7 as text_id", "8 as __row")
    sizes = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "/root/testdata/sf0.001")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
        assert docs.where(f"doc_id = {10**6}").count() == 0
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < sizes[0]
    assert docs.where(f"doc_id = {10**6 + 2}").count() == 0


def test_run_and_registry(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    again = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in again.collect()) and out.count() > 50
    assert sum(n.startswith("op") for n in queries.queries()) == 10 and "pipeline" in queries.queries()


def test_secrets_keep_clean_documents(spark):
    """Links of long paths, rules, slugs and identifiers drop nothing; random tokens beside a name or an endpoint do."""
    url, key, low = "https://h.example", "Zq9x7Lm2Kd0PwT5vRb8NcY3sHf6JgA1e", "k3j9x8q2m5z7w1p4t6v0b8n2c5h9d3g7"
    clean = [
        f"see {url}/2024/01/how-we-built-a-search-engine-in-30-days and {url}/docs/guide/getting-started/installation-on-linux",
        f"{'-' * 60} {url}/a",
        f"{'_' * 60} user=alice",
        f"{url}/a then How-I-Built-A-Search-Engine-In-30-Days-Or-Less",
        "user=alice 550e8400-e29b-41d4-a716-446655440000",
        f"just {key}",
    ]
    leaks = [f"user=alice then {key}", f"{url}/a {key}", f"é😀 client_id: abc9 {low}", f"user=bob1 {url}/p?sig={key}", "password=hunter22"]
    docs = spark.createDataFrame(list(enumerate(clean + leaks)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.secrets(spark, docs, "").collect()) == list(range(len(clean)))


def test_empty(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0


def test_against_brute_force(spark, tmp_path):
    """Each stage's rows against plain Python for languages, and DuckDB over that stage's own input for the others."""
    import duckdb

    from stratagrid.llm import langid

    data = "/root/testdata/sf0.01"
    base = spark.read.parquet(f"{data}/documents.parquet").where("doc_id < 500")
    bench = [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").orderBy("item_id").limit(3).collect()]
    odd = [(10**6 + i, t, "en", "src0", 1) for i, t in enumerate(["", "!!", bench[0], f"{bench[1]} and more of the same", "api_key: abcdefgh1 and that", "the of and to in that is"])]
    docs = base.union(spark.createDataFrame(odd, base.schema))
    sql = queries.oracle_sql()
    rules = {
        "minhash_near_dedup": f"select doc_id from ({sql['op1_minhash_near_dedup']}) where kept",
        "benchmark_decontamination": f"select doc_id from ({sql['op5_benchmark_decontamination']}) where not contaminated",
        "secret_scan": f"select doc_id from ({sql['op10_secret_scan']}) where spans = ''",
        "mixing": f"select doc_id from ({sql['op4_source_mixing']}) where sampled",
    }
    gone = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = str(tmp_path / f"in{i}")
        docs.write.parquet(before)
        docs = spark.read.parquet(before)
        if name == "language_id":
            scorer = langid.Scorer(langid.fit(docs))
            rows = docs.collect()
            found = dict(zip([r.doc_id for r in rows], scorer([r.text for r in rows])))
            want = {d for d, (lang, score) in found.items() if lang != "und" and score >= corpus_pipeline.LEAST_LANGUAGE_SCORE}
        else:
            duck = duckdb.connect()
            duck.execute(f"create view documents as select * from read_parquet('{before}/*.parquet')")
            duck.execute(f"create view benchmark as select * from read_parquet('{data}/benchmark.parquet')")
            want = {r[0] for r in duck.execute(rules[name]).fetchall()}
        n = docs.count()
        docs = stage(spark, docs, data)
        assert {r.doc_id for r in docs.select("doc_id").collect()} == want, name
        gone.append(n - len(want))
    assert all(n > 0 for n in gone)
