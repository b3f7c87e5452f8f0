"""Steps that many rule sets share: counts of characters, and texts that an expression names once."""

from pyspark.sql import functions as F

from qirtas.functions import metrics, text
from qirtas.functions import rulesets as R


def test_characters_are_counted_without_their_matches(spark):
    texts = ["", None, "ab 12 ٣ ②", "محضر 7\n\n x", "😀a�ØÙ[]"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for p in ("[A-Za-z]", R.AR, "(?U)" + R.DIGIT, r"[\[\]{}]", r"\p{L}", "[ØÙ�]", "[^\\x00-\\x7f]"):
        assert "regexp_count" not in str(metrics.count_of(F.col("t"), p))
        rows = d.select(metrics.count_of(F.col("t"), p).alias("n"), F.regexp_count("t", F.lit(p)).alias("m")).collect()
        assert all(r.n == r.m for r in rows), p
    rows = d.select(R.digits_of(F.col("t")).alias("n"), F.regexp_count("t", F.lit("(?U)" + R.DIGIT)).alias("m")).collect()
    assert all(r.n == r.m for r in rows)


def test_words_are_looked_for_where_one_is(spark):
    d = spark.createDataFrame([("المحكمة محكمة الدعوى",), ("none",), ("",)], "t string")
    plain = sum((R.occurrences(F.col("t"), w) for w in R.DISPUTE_WORDS), F.lit(0))
    assert all(r.n == r.m for r in d.select(R.word_hits(F.col("t"), R.DISPUTE_WORDS).alias("n"), plain.alias("m")).collect())


def test_the_class_of_unsettled_characters_is_the_one_without_a_short_cut(spark):
    d = spark.createDataFrame([(chr(i),) for i in (*range(0xD800), *range(0xE000, 0x10000))], "t string")
    plain = f"[[^\\x00-\\x7f]&&[^{text.SETTLED}]]"
    assert d.filter(F.col("t").rlike(text.UNSETTLED) != F.col("t").rlike(plain)).count() == 0


def test_what_is_beyond_ascii_is_not_looked_for_in_ascii(spark):
    d = spark.createDataFrame([("",), ("plain text",), ("é",), ("a é\n b",), (None,), ("😀",)], "t string")
    rows = d.select(text.beyond(F.col("t")).alias("n"), F.regexp_replace("t", r"[\x00-\x7f]+", " ").alias("m")).collect()
    assert all(r.n == r.m for r in rows) and "octet_length" in str(text.beyond(F.col("t")))


TEXTS = ["", " ", "a", " a b ", "ab c 12 x\x85\x0b\n é İd", "Name  to\tKD 1,250.500 filſ KD dinars DINAR", "محضر ab٣ c �ØÙ {}", "x1 22abc (2024) word 2024x", "Final Settlement id ID From:to date İD ıd", "\n\n aaaaaaa   b"]


def test_the_short_form_keeps_what_is_counted_in_it(spark):
    d = spark.createDataFrame([(x,) for x in TEXTS], "t string")
    t, short = F.col("t"), R._short(F.col("t"))
    words = text.tokens(t)
    same = [
        (R._token_counts(short)["all"], F.size(words)), (R._token_counts(short)["one"], F.size(F.filter(words, lambda w: F.length(w) == 1))), (R._filled(short), R._filled(t)),
        (R.statement_tokens(short), R.statement_tokens(t)), (R._shares(short, F.length(t))["latin"], F.regexp_count(t, F.lit("[A-Za-z]"))),
        (R._shares(short, F.length(t))["digits"], R.digits_of(t)), (R._shares(short, F.length(t))["arabic"], F.regexp_count(t, F.lit(R.AR))),
    ]
    for i, (a, b) in enumerate(same):
        assert all(r.a == r.b for r in d.select(a.alias("a"), b.alias("b")).collect()), i


def test_currencies_and_words_of_forms_are_counted_as_by_the_plain_pattern(spark):
    d = spark.createDataFrame([(x,) for x in TEXTS], "t string")
    form = rf"(?U)(?i){R.BEFORE}(ID|Name|Date|Amount|Total|Salary|Bonus|Signature|Subject|From|To){R.AFTER}"
    kinds = d.select(F.regexp_count("t", F.lit(R.form_words())).alias("a"), F.regexp_count("t", F.lit(form)).alias("b")).collect()
    assert all(r.a == r.b for r in kinds) and max(r.a for r in kinds) > 4
    currency = rf"(?U)(?i){R.BEFORE}(?:KD|KWD|Dinars?|fils){R.AFTER}"
    low = F.lower("t")
    rows = d.select(R.currencies(F.col("t"), low, text.beyond(F.col("t"))).alias("a"), F.regexp_count("t", F.lit(currency)).alias("b")).collect()
    assert all(r.a == r.b for r in rows) and max(r.a for r in rows) >= 4
