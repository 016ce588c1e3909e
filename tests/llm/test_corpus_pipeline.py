import re

import corpus_pipeline as P
from censusflow.llm.tokenize import tokenizer_path

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_run_is_the_stages_in_order(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    d = spark.read.parquet(f"{DATA}/documents.parquet")
    left = d.count()
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, d, DATA)
        assert out.columns == d.columns and out.dtypes == d.dtypes, name
        d = P.materialize(out, "test")
        assert 0 < d.count() <= left, name
        left = d.count()
    ids = {r.doc_id for r in d.collect()}
    packed = P.run(spark, DATA)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids
    assert P.ORACLE_SQL is None


def test_toxic_documents_go(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    d = d.unionByName(spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "", "en", "s", 0), (10**6 + 1, "", "en", "s", 0)], d.schema))
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    kept = set(texts(P.drop_toxic(spark, d, "/root/testdata/sf0.01")))
    toxic, clean = [i for i, y in labels.items() if y], [i for i, y in labels.items() if not y]
    assert sum(i in kept for i in toxic) <= 0.2 * len(toxic)
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)


PASSAGE = " ".join(f"passage{k}" for k in range(60))


def test_repeated_passages_stay_once(spark):
    rows = [(i, f"Document {i} begins here with words of its own.\n{PASSAGE}\nAnd document {i} ends with {i * 7919} and more.") for i in range(30)]
    rows += [(100, "A clean document.\nIt has lines of its own that nobody else has at all."), (101, None), (102, ""), (103, PASSAGE + "x")]
    out = P.drop_repeated_lines(spark, docs(spark, rows), DATA).collect()
    assert sum(PASSAGE in (r.text or "") for r in out) == 1
    got = {r.doc_id: r for r in out}
    assert got[100].text == rows[30][1] and got[101].text is None and 103 not in got
    assert all(r.n_chars == len(r.text or "") for r in out)


def test_one_of_a_group_stays(spark):
    base = [f"w{k * 31 % 997}" for k in range(200)]
    near = [" ".join(base[:k] + ["changed"] + base[k + 1:]) for k in range(0, 50, 10)]
    rows = [(10 + k, t) for k, t in enumerate(near)] + [(5, " ".join(base))] + [(50, "another text altogether"), (51, None), (52, ""), (53, None)]
    assert set(texts(P.drop_near_copies(spark, docs(spark, rows), DATA))) == {5, 50, 51, 52, 53}


def test_contaminated_documents_go(spark):
    item = max((r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()), key=len)
    words = re.findall(r"\S+", item)
    rows = [(1, "Own words. " + item), (2, " ".join(words[:12])), (3, "own " * 300 + " ".join(words[:13])), (4, None), (5, "clean"), (6, "own " * 246 + " ".join(words[:13]))]
    assert set(texts(P.drop_contaminated(spark, docs(spark, rows), DATA))) == {2, 3, 4, 5}


def test_packing_keeps_all_ids(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = [(i, "some words " * (i * 50)) for i in range(20)] + [(99, None)]
    out = P.packed(spark, docs(spark, rows), DATA).collect()
    assert sum(r.length for r in out) == sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)


def test_a_row_is_its_id_and_its_text(spark):
    """Of equal rows one stays; another text under a copy's id stays; ids of copies may repeat."""
    base = [f"w{k * 31 % 997}" for k in range(200)]
    text, near, other = " ".join(base), " ".join(base[:-1] + ["changed"]), "a text of its own that nobody else has written down"
    rows = [(1, text), (1, text), (5, near), (5, other), (7, other + " but longer by quite a few words than the one before it"), (None, text), (None, text), (8, None), (8, None)]
    out = sorted(((r.doc_id, r.text) for r in P.drop_near_copies(spark, docs(spark, rows), DATA).collect()), key=repr)
    assert out == sorted([(1, text), (5, other), rows[4], (None, text), (None, text), (8, None), (8, None)], key=repr)


def test_empty_tables_and_own_columns(spark):
    none = docs(spark, []).withColumn("_row", P.F.lit(1)).withColumn("score", P.F.lit("x"))
    for name, stage in P.STAGES[1:-1]:
        out = stage(spark, none, DATA)
        assert out.columns == none.columns and out.count() == 0, name
