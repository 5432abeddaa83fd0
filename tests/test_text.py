"""The cleaner against a restatement with Python regular expressions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from reviewloom.functions.text import clean_text, has_text
from reviewloom.operators.filters import prepare_reviews, rejection_report

# Rules in their order.
RULES = [
    (r"https?://\S+|www\.\S+", "[URL]"),
    (r"@\w+", "[USER]"),
    (r"\b[A-Z0-9]{10,}\b", "[PRODUCT]"),
    (r"\s+", " "),
]

ADVERSARIAL = [
    None,
    "",
    " ",
    "\n",
    "  \t padded \r\n",
    "HTTPS://EXAMPLE.COM/Path?q=1 and WWW.Example.com, done",
    "www.",
    "www. x",
    "http:// x",
    "httpx://www.a.b",
    "see(https://a.b/c)and more",
    "mail a@b.com or @user_1!",
    "@ alone",
    "@@twice @x@y",
    "123456789",
    "1234567890",
    "12345678901234567890",
    "a1234567890 _1234567890 1234567890_ é1234567890 1234567890é",
    "1234567890,1234567890 1234567890",
    "(1234567890)",
    "C12AB345XY and B000000000",
    "nbsp and em space",
    "unit\u001cseparator\u0085next line",
    "zero​width stays",
    " ",
    "full-width １２３４５６７８９０",
    "@namé mark",
    "İSTANBUL",
    "ΟΔΟΣ ΟΔΟΣ.",
    "great 😀 👍🏽 @😀",
    "\U0001d4b41234567890 \U0001d4b4",
    "two  spaces   three",
    "line\n\n\nbreaks\n",
    "tab\tnew\nline",
    "\x00nul and \x7f del",
    "mixed http://x y",
    "@user next",
    "-1234567890-",
    "x\x0b\x0cy",
]


def restated(text):
    if not text:
        return ""
    text = text.lower()
    for pattern, token in RULES:
        text = re.sub(pattern, token, text)
    return text.strip()


def random_texts(count, seed=7):
    rng = random.Random(seed)
    pieces = [
        "http://", "https://", "www.", "@", "\n", "  ", " ", "\t", " ", "\u0085", "\u001f", "_", "-", ".",
        "0123456789", "12345", "ABCDEFGHIJ", "word", "É", "ß", "İ", "Σ", "漢字", "１", "\U0001d4b4", "😀", "́",
    ]
    return ["".join(rng.choices(pieces, k=rng.randint(1, 12))) for _ in range(count)]


@pytest.mark.parametrize("texts", [ADVERSARIAL, random_texts(3000)], ids=["adversarial", "random"])
def test_cleaner_equals_restatement(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for row in df.select("text", clean_text("text").alias("clean")).collect():
        assert row["clean"] == restated(row["text"]), repr(row["text"])


def test_codes_before_lower_case(spark):
    texts = ["ASIN C12AB345XY!", "c12ab345xy", "@ABCDEFGHIJ hi", "WWW.X.COM/ABCDEFGHIJ", "1234567890", "AB"]
    texts += ["icon \ue000 HERE", "[PRODUCT] C12AB345XY", "C12AB345XY"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    cleaned = [r[0] for r in df.select(clean_text("text", mask_codes_before_lower=True)).collect()]
    assert cleaned == ["asin [PRODUCT]!", "c12ab345xy", "[USER] hi", "[URL]", "[PRODUCT]", "ab"] + [
        "icon \ue000 here",
        "[product] [PRODUCT]",
        "[PRODUCT]",
    ]


def test_blank_filter_keeps_newline_only_text(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",), ("\n",), (" ",), (" x ",)], "text string")
    assert [r[0] for r in df.select(has_text("text")).collect()] == [False, False, False, True, True, True]
    prepared = prepare_reviews(df).collect()
    assert [(r["text_length"], r["preprocessed_text"]) for r in prepared] == [(1, ""), (1, ""), (3, "x")]
    assert rejection_report(df).first() == (6, 3, 3, 50.0)


def test_rejection_rate_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "text string")
    assert rejection_report(empty).first() == (0, 0, 0, None)


def test_cleaning_needs_no_shuffle_and_no_python(spark, plan_of):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = plan_of(prepare_reviews(source).select("preprocessed_text"))
    assert "Exchange" not in plan and "EvalPython" not in plan
    assert "PushedFilters: [IsNotNull(text)]" in plan
    assert "ReadSchema: struct<text:string>" in plan


def test_cleaning_accepts_a_stream(spark, tmp_path):
    from reviewloom.operators.scoring import LexiconScorer, score
    from reviewloom.schemas import REVIEW_SCHEMA

    source = spark.createDataFrame([("Great  @you", "a"), ("bad", "b"), (" ", "c")], "text string, asin string")
    source.write.json(str(tmp_path / "in"))

    def scored(df):
        return score(prepare_reviews(df), LexiconScorer()).select("asin", "preprocessed_text", "sentiment")

    stream = spark.readStream.schema(REVIEW_SCHEMA).json(str(tmp_path / "in"))
    query = scored(stream).writeStream.format("memory").queryName("scored_stream").start()
    query.processAllAvailable()
    query.stop()
    batch = scored(spark.read.schema(REVIEW_SCHEMA).json(str(tmp_path / "in")))
    assert sorted(spark.table("scored_stream").collect()) == sorted(batch.collect())
    assert batch.filter(F.col("sentiment") == "POS").count() == 1 or batch.count() == 2
