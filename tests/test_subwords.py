import random
import re

import pytest

from reviewloom.functions.lexicon import OPINION_WORDS
from reviewloom.operators.scoring import LexiconScorer, score
from reviewloom.operators.subwords import subword_counter

PIECES = ["un", "u", "##n", "##ab", "##able", "##a", "able", "b", "!", "ü", "##𝒴"]


def cut(word, pieces):
    """Longest match, the plain way."""
    at, n = 0, 0
    while at < len(word):
        fits = [e for e in range(len(word), at, -1) if ("##" if at else "") + word[at:e] in pieces]
        if not fits:
            return 1
        at, n = fits[0], n + 1
    return 1 if len(word) > 100 else n


def brute(text, pieces):
    return sum(cut(word, pieces) for word in re.findall(r"[!.,?😀]|[^!.,?😀\s]+", text))


def test_counts_equal_brute_force(spark):
    draw = random.Random(1)
    texts = ["".join(draw.choice(["un", "able", "ab", "a", "n", " ", "!", "\n", "ü𝒴", "😀", "zz"]) for _ in range(draw.randrange(12))) for _ in range(300)]
    texts += ["", " ", None, "u" + "n" * 99, "u" + "n" * 100, "unable " * 20_000, "un able", "unablex"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").repartition(3)
    got = {r["id"]: r["n"] for r in df.select("id", subword_counter(PIECES)(df.text).alias("n")).collect()}
    assert got == {i: None if t is None else brute(t, set(PIECES)) for i, t in enumerate(texts)}


def test_scorer_counts_subwords(spark):
    df = spark.createDataFrame([(1, "unable great!"), (2, ""), (3, None)], "id int, text string")
    rows = score(df, LexiconScorer(OPINION_WORDS, subword_counter(PIECES)), "text").orderBy("id").collect()
    assert [(r["token_count"], r["sentiment"]) for r in rows] == [(6, "POS"), (2, "NEU"), (0, "ERROR")]
    assert score(df.limit(0), LexiconScorer(OPINION_WORDS, subword_counter(PIECES)), "text").count() == 0


def test_empty_pieces_are_refused():
    for piece in ("", "##"):
        with pytest.raises(ValueError, match="character"):
            subword_counter(["a", piece])
