"""Readers on small files: JSON arrays, word lists, both stop-word paths."""

from dailywire.sources import readers as R


def test_explode_json_records(spark):
    df = spark.createDataFrame([(1, '{"articles": [{"title": "a", "url": "u1"}, {"title": "b", "url": "u2"}]}')], "id int, j string")
    out = R.explode_json_records(df, "j", "struct<title: string, url: string>", array_field="articles").collect()
    assert [(r.id, r.title, r.url) for r in out] == [(1, "a", "u1"), (1, "b", "u2")]
    a = spark.createDataFrame([(1, "x")], "id int, t string")
    b = spark.createDataFrame([(2, 3.0)], "id int, v double")
    assert R.append_records([a, b]).columns == ["id", "t", "v"]


def test_wordlist_keeps_the_order_of_its_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# list\nzeta\nbeta\n")
    (tmp_path / "b.txt").write_text("# more\nalpha\n" + "\n".join(f"w{i}" for i in range(50)))
    words = R.read_wordlist(spark, str(tmp_path))
    assert R.wordlist_terms(words, limit=4) == ["zeta", "beta", "alpha", "w0"] and words.count() == 53


def test_stopword_table_path_equals_literal_path(spark, tmp_path):
    from dailywire.functions import text as TX
    from dailywire.operators import text as TO
    from tests.conftest import SF_SMALL

    (tmp_path / "words.txt").write_text("# list\nabout\nabove\nthe\nabout\nde\nder\n")
    words = R.read_wordlist(spark, str(tmp_path))
    terms = R.wordlist_terms(words, limit=6)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10**9, "about above"), (10**9 + 1, ""), (10**9 + 2, "Alpha  beta about")], "doc_id long, text string")
    docs = docs.unionByName(extra)
    lit = {r.doc_id: r.c for r in docs.select("doc_id", TX.remove_stopwords("text", terms).alias("c")).collect()}
    tab = {r.doc_id: r.cleaned for r in TO.remove_stopwords_table(docs, "doc_id", "text", words).collect()}
    assert lit == tab
    assert tab[10**9] == "about above" and tab[10**9 + 1] == "" and tab[10**9 + 2] == "alpha  beta"

