"""Sampling, shuffling and head rows."""

from pyspark.sql import functions as F

from reviewloom.operators.sampling import (
    head_rows,
    order_hash,
    sample_ratio,
    sample_rows,
    shuffle_rows,
    take_random,
)
from reviewloom.queries.tables import REVIEWS_SQL, reviews, table

SEED = 42
KEYS = ["asin"]
RATIO = 0.3
COUNT = 150
HEAD = 100


def ratio_sample(spark, sf_dir):
    return sample_ratio(reviews(spark, sf_dir), RATIO, SEED, KEYS)


def count_sample(spark, sf_dir):
    return take_random(reviews(spark, sf_dir), COUNT, SEED, KEYS)


def ratio_then_count(spark, sf_dir):
    return sample_rows(reviews(spark, sf_dir), RATIO, COUNT, SEED, KEYS)


def count_sample_by_content(spark, sf_dir):
    """No key: whole rows are hashed. The texts hold exact copies."""
    return take_random(table(spark, sf_dir, "documents").select("text", "lang"), COUNT, SEED)


def whole_sample(spark, sf_dir):
    """A ratio of 1 and a count of 0 keep every row."""
    return sample_rows(reviews(spark, sf_dir), 1.0, 0, SEED, KEYS)


def shuffled(spark, sf_dir):
    source = reviews(spark, sf_dir)
    ordered = shuffle_rows(source, SEED, KEYS)
    return ordered.select("asin", "rating", order_hash(source, SEED, KEYS).alias("order_hash"))


def first_turns(spark, sf_dir):
    return head_rows(table(spark, sf_dir, "conversations"), HEAD, ["conv_id", "turn"])


def many_first_turns(spark, sf_dir):
    return head_rows(table(spark, sf_dir, "conversations"), 5000, ["conv_id", "turn"])


def count_sample_of_events(spark, sf_dir):
    """No key, and values that may differ below the millisecond."""
    return take_random(_events(spark, sf_dir), COUNT, SEED)


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")


QUERIES = {
    "sample_ratio": ratio_sample,
    "sample_count": count_sample,
    "sample_ratio_then_count": ratio_then_count,
    "sample_count_by_content": count_sample_by_content,
    "sample_everything": whole_sample,
    "shuffled_rows": shuffled,
    "head_n": first_turns,
    "head_n_large": many_first_turns,
    "sample_count_exact_values": count_sample_of_events,
}

_COLUMNS = "text, asin, user_id, rating, title"
_HASH = f"md5('{SEED}:' || asin)"
_BELOW = f"CAST('0x' || substr({_HASH}, 1, 8) AS BIGINT) < {RATIO} * 4294967296"

ORACLES = {
    "sample_ratio": f"WITH {REVIEWS_SQL} SELECT {_COLUMNS} FROM reviews WHERE {_BELOW}",
    "sample_count": f"WITH {REVIEWS_SQL} SELECT {_COLUMNS} FROM reviews ORDER BY {_HASH}, asin LIMIT {COUNT}",
    "sample_ratio_then_count": f"""
WITH {REVIEWS_SQL} SELECT {_COLUMNS} FROM reviews WHERE {_BELOW} ORDER BY {_HASH}, asin LIMIT {COUNT}""",
    "sample_count_by_content": f"""
SELECT text, lang FROM documents
ORDER BY md5('{SEED}:' || CAST(to_json({{'text': text, 'lang': lang}}) AS VARCHAR)) LIMIT {COUNT}""",
    "sample_count_exact_values": f"""
SELECT ts, user_id, event_type, value FROM events
ORDER BY md5('{SEED}:' || CAST(to_json({{'ts': CAST(ts AS VARCHAR), 'user_id': user_id, 'event_type': event_type,
                                       'value': CAST(value AS VARCHAR)}}) AS VARCHAR)) LIMIT {COUNT}""",
    "head_n_large": "SELECT conv_id, turn, role, text FROM conversations ORDER BY conv_id, turn LIMIT 5000",
    "sample_everything": f"WITH {REVIEWS_SQL} SELECT {_COLUMNS} FROM reviews",
    "shuffled_rows": f"WITH {REVIEWS_SQL} SELECT asin, rating, {_HASH} AS order_hash FROM reviews",
    "head_n": f"SELECT conv_id, turn, role, text FROM conversations ORDER BY conv_id, turn LIMIT {HEAD}",
}
