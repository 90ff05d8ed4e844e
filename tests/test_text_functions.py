
from dailywire.functions import lexicons as L
from dailywire.functions import text as TX
from tests import rules

RAW = [
    "can't we're HK's 'the x y z é AT&T a\nb covid-19",
    "é x ü ab",
    "  (Hello) world... 12 3/4 “quoted” … end  ",
    "",
    "ab x\n",
    "Harbour’s police  say | “Explainer” — %E2%80%98ok%E2%80%99 a-b",
    "tiny",
    "abcdef about above",
    "abcde about",
    "a b c d e f g",
    "The covid pandemic, and the ban! Death; arrest? accident.",
    "double  blanks  stay",
    "x",
]


def _df(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(RAW)], "id int, text string")


def test_contractions_and_special_match_rules(spark):
    out = _df(spark).select("id", "text", TX.expand_contractions("text").alias("t1"),
                            TX.strip_special(TX.expand_contractions("text")).alias("t2")).collect()
    for r in out:
        assert r.t1 == rules.contractions(r.text)
        assert r.t2 == rules.special(rules.contractions(r.text)), r.text


def test_contraction_rules_are_not_word_bounded(spark):
    r = spark.createDataFrame([("'the",)], "t string").select(TX.expand_contractions("t").alias("o")).first()
    assert r.o == " not he"


def test_stopwords_fall_back_to_input_when_short(spark):
    words = list(L.STOPWORDS_FIRST_100)
    out = _df(spark).select("text", TX.remove_stopwords("text", words).alias("o"),
                            TX.remove_stopwords("text", words, lower=False, limit=10).alias("o10")).collect()
    for r in out:
        assert r.o == rules.stopwords(r.text, words)
        assert r.o10 == rules.stopwords(r.text, words[:10], lower=False)
        if len(r.text) > 5 and r.o != r.text:
            assert len(r.o) > 5  # never empties a long text without falling back


def test_stopwords_keep_empty_tokens(spark):
    r = spark.createDataFrame([("alpha  beta about",)], "t string").select(TX.remove_stopwords("t", L.STOPWORDS_FIRST_100).alias("o")).first()
    assert r.o == "alpha  beta"


def test_html_text_chain(spark):
    out = _df(spark).select("text", TX.clean_html_text("text").alias("o")).collect()
    for r in out:
        assert r.o == rules.html_text(r.text)


def test_keyterm_and_negative_counts(spark):
    df = _df(spark).select("text", TX.preprocess_text("text", L.STOPWORDS_FIRST_100).alias("p"))
    out = df.select("p", TX.keyterm_flag("p").alias("k"), TX.term_occurrences("p").alias("n")).collect()
    for r in out:
        assert r.k == rules.keyterm(r.p, L.COVID_TERMS)
        assert r.n == sum(1 for t in r.p.split(" ") if t in L.NEGATIVE_TERMS)
    # covid-19 cannot survive T2, but covid does
    flagged = [r for r in out if r.k == 1]
    assert flagged


def test_polarity_label_and_conditional_label(spark):
    df = spark.createDataFrame([(-0.5, 1), (0.0, None), (0.3, 0)], "p double, f int")
    out = df.select(TX.polarity_label("p").alias("l"), TX.conditional_label("f").alias("c")).collect()
    assert [r.l for r in out] == ["negative", "neutral", "positive"]
    assert [r.c for r in out] == ["negative", "positive", "positive"]


def test_whitespace_token_count_and_grouped_number(spark):
    df = spark.createDataFrame([("  a  b c ", "16,914.58"), ("", "junk"), ("one", "1,000")], "t string, n string")
    out = df.select(TX.whitespace_token_count("t").alias("c"), TX.parse_grouped_number("n").alias("v")).collect()
    assert [r.c for r in out] == [3, 0, 1]
    assert [r.v for r in out] == [16914.58, None, 1000.0]


def test_topic_tokens_strip_accents(spark):
    r = spark.createDataFrame([("Élan d'été à_b 2024 ab1 x",)], "t string").select(TX.topic_tokens("t").alias("o")).first()
    assert r.o == ["elan", "ete", "a_b", "ab"]


def test_bounded_contractions_only_rewrite_word_ends(spark):
    df = spark.createDataFrame([("can't 'the we're",)], "t string")
    r = df.select(TX.expand_contractions("t", bounded=True).alias("b"), TX.expand_contractions("t").alias("u")).first()
    assert r.u == "ca not   not he we are "
    assert r.b == "ca not  'the we are "


def test_five_character_result_falls_back(spark):
    r = spark.createDataFrame([("abcde about",), ("abcdef about",)], "t string").select(TX.remove_stopwords("t", L.STOPWORDS_FIRST_100).alias("o")).collect()
    assert [x.o for x in r] == ["abcde about", "abcdef"]


def test_strip_special_at_the_edges(spark):
    texts = ["a b c d", "a", "a\n", "a\nb", " a b", "x&y", "&&", "a. & -b", "ab  cd  ef", "12 ab3٣c", "\U0001d400 bc", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.o for r in df.select("i", TX.strip_special("t").alias("o")).orderBy("i").collect()]
    assert got == ["b d", "", "", "a b", "b", "x and y", " and and ", "a and b", "ab cd ef", " ab c", "bc", ""]
    # one pass for the characters that are dropped and the blanks
    assert df.select(TX.strip_special("t"))._jdf.queryExecution().optimizedPlan().toString().count("{2,}") == 0
