"""The registered queries of the pipeline operators, each over its whole table, and SQL where SQL can say it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import (
    archive,
    collision_search,
    compression_quality,
    exact_dedup,
    language_model,
    licenses,
    mixing,
    near_duplicates,
    packing,
    phrases,
    piece_counts,
    ranked_search,
    toxicity,
)
from reviewloom.llm.staging import shared_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _fold(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5


def op1_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows, by inner product, of every 20th row: collision counting in widening windows."""
    return collision_search.nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a text is good, by how well dictionaries of good and bad text compress it."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").filter(_fold() != 0)
    scored = compression_quality.quality_scores(documents, compression_quality.fit(documents, labels))
    return scored.select(
        "doc_id",
        (_fold() == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text by the piece model: rank-synchronous merging of arrays."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = piece_counts.token_counts(documents, _vocabulary("piece_bpe_32k.model"))
    return counted.select(
        "doc_id",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 4096).alias("over_limit"),
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of equal texts stays: composable polynomial fingerprints, then chunkwise comparison."""
    found = exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_token_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written as independent zstandard frames with a seek table, and read back."""
    path = shared_path(spark, "archive")
    read = archive.archive_of(spark, _table(spark, sf_dir, "documents"), path, _vocabulary("word_bpe_49k.json"), 2)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles are similar to 0.8 or more."""
    found = near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"), carry=["doc_id"], words=2, percent=80)
    return found.select("row.doc_id", "n_shingles", "component_id", "kept")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 ids: one stream, cut at every multiple."""
    pieces = packing.pack(
        _table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), 0, carry=["doc_id"], with_ids=False
    )
    return pieces.select("row.*", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of the sources takes of each document: Sainte-Lague seats, one for each word."""
    mixture = mixing.mix(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixture.select("row.doc_id", "size", "source_size", "target", "taken")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document: how many lines are one, and the families they name."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", F.monotonically_increasing_id().alias("number"))
    found = licenses.license_paragraphs(documents, carry=["number"]).groupBy("row.number").agg(
        F.count(F.lit(1)).alias("n_paragraphs"),
        F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"),
    )
    return documents.select("doc_id", "number").join(found, "number", "left").select(
        "doc_id", F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"), F.coalesce("families", F.lit("")).alias("families")
    )


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every text under a trigram automaton with failure arcs, learned from four fifths of them."""
    scored = language_model.language_scores(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), _fold() != 1, carry=["doc_id"]
    )
    return scored.select(
        "row.doc_id",
        (_fold("row.doc_id") == 1).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of two or three words of each language: an FM-index of words for each shard."""
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a text is toxic, by its character n-grams scaled by naive Bayes ratios."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    labels = _table(spark, sf_dir, "labels").filter(~held_out)
    scored = toxicity.toxicity_scores(documents, toxicity.fit(documents, labels))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item: term at a time with a limit on accumulators."""
    found = ranked_search.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("query_id", "item_id")


QUERIES = {
    "op1_collision_search": op1_collision_search,
    "op2_compression_quality": op2_compression_quality,
    "op3_token_counts": op3_token_counts,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_token_archive": op5_token_archive,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_packing": op7_packing,
    "op8_mixing": op8_mixing,
    "op9_license_scan": op9_license_scan,
    "op10_language_model": op10_language_model,
    "op11_phrases": op11_phrases,
    "op12_toxicity": op12_toxicity,
    "op13_ranked_search": op13_ranked_search,
}

_SIZED_SQL = r"""
sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || doc_id), 1, 15))::BIGINT AS place
  FROM documents)"""

_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op11_phrases": rf"""
WITH texts AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
         string_split_regex({_LOWER_SQL}, '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
pieces AS (SELECT doc, lang, unnest(pieces) AS piece FROM texts),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
grams AS (
  SELECT lang, size, words[i:i + size - 1] AS gram FROM (
    SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM listed, (SELECT unnest([1, 2, 3]) AS size) WHERE len(words) >= size)),
counted AS (SELECT lang, size, gram, count(*) AS f FROM grams GROUP BY lang, size, gram),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang),
candidates AS (SELECT * FROM counted WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.gram, c.f AS a, k, x.f AS l, y.f AS r,
         (1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN counted x ON x.lang = c.lang AND x.gram = c.gram[1:k]
  JOIN counted y ON y.lang = c.lang AND y.gram = c.gram[k + 1:]),
lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) AS place FROM cuts) WHERE place = 1),
longer AS (
  SELECT lang, part, max(f) AS f FROM (
    SELECT lang, f, unnest([gram[1:2], gram[2:3]]) AS part FROM candidates WHERE size = 3) GROUP BY lang, part),
ranked AS (
  SELECT c.*, array_to_string(gram, ' ') AS phrase FROM lowest c LEFT JOIN longer o ON o.lang = c.lang AND o.part = c.gram
  WHERE o.f IS NULL OR 100 * o.f < 50 * c.a)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM ranked JOIN sizes USING (lang)) WHERE rank <= 2000""",
    "op13_ranked_search": rf"""
WITH texts AS (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all({_LOWER_SQL}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM texts WHERE len(terms) > 0),
held AS (SELECT doc, doc_id, n, term, count(*) AS tf
         FROM (SELECT doc, doc_id, len(terms) AS n, unnest(terms) AS term FROM texts) GROUP BY doc, doc_id, n, term),
weighed AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM held, corpus GROUP BY term, n_docs),
asked AS (SELECT item, item_id, term, count(*) AS times FROM (
            SELECT row_number() OVER () AS item, item_id,
                   unnest(regexp_extract_all({_LOWER_SQL}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark) GROUP BY item, item_id, term),
scored AS (
  SELECT item, item_id, doc, doc_id,
         sum(times * w * (1000000000::BIGINT * tf // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weighed USING (term) JOIN held USING (term), corpus GROUP BY item, item_id, doc, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id))::INTEGER AS rank FROM scored WHERE score > 0)
WHERE rank <= 10""",
    "op4_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op8_mixing": f"""
WITH {_SIZED_SQL},
sources AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_rows FROM sized GROUP BY source),
weighed AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS turn,
         (ARRAY[1.0, 2.0, 3.0])[CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS weight
  FROM sources),
levelled AS (
  SELECT *, 3.0::DOUBLE * source_size / weight AS full_at,
         ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(3.0::DOUBLE * source_size) OVER filling, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER filling, 0)) AS level
  FROM weighed
  WINDOW filling AS (ORDER BY 3.0::DOUBLE * source_size / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, n_rows, least(3.0::DOUBLE * source_size, weight * (
           SELECT level FROM levelled WHERE full_at >= level ORDER BY full_at, turn LIMIT 1)) AS target,
         (SELECT sum(source_size) FROM sources)::BIGINT AS blocks
  FROM levelled),
source_seats AS (
  SELECT source, unnest(range(1, ceil(target)::BIGINT + 2)) AS seat, target, blocks FROM targets),
source_won AS (
  SELECT source, count(*) AS quota
  FROM (SELECT *, row_number() OVER (ORDER BY target / (2 * seat - 1) DESC, source IS NULL, source) AS place FROM source_seats)
  WHERE place <= blocks GROUP BY source),
per_source AS (
  SELECT t.*, least(coalesce(w.quota, 0), 3 * source_size) AS seats, ceil(n_rows / 2000)::BIGINT AS shards
  FROM targets t LEFT JOIN source_won w ON t.source IS NOT DISTINCT FROM w.source),
dealt AS (
  SELECT s.*, p.source_size, p.target, p.seats, place % p.shards AS shard
  FROM sized s JOIN per_source p ON s.source IS NOT DISTINCT FROM p.source),
shards AS (SELECT source, shard, sum(size)::BIGINT AS shard_size, any_value(seats) AS seats FROM dealt GROUP BY source, shard),
shard_seats AS (
  SELECT *, unnest(range(1, (seats * shard_size::DOUBLE
           / greatest(sum(shard_size) OVER (PARTITION BY source), 1))::BIGINT + 3)) AS seat FROM shards),
shard_won AS (
  SELECT source, shard, count(*) AS quota
  FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY shard_size::DOUBLE / (2 * seat - 1) DESC, shard) AS place FROM shard_seats)
  WHERE place <= seats GROUP BY source, shard),
rings AS (
  SELECT h.source, h.shard, shard_size, least(coalesce(quota, 0), 3 * shard_size) AS words,
         ('0x' || substr(md5('mix:start:' || coalesce(h.source, '') || ':' || h.shard), 1, 15))::BIGINT
           % greatest(shard_size, 1) AS start
  FROM shards h LEFT JOIN shard_won w ON h.source IS NOT DISTINCT FROM w.source AND h.shard = w.shard),
placed AS (
  SELECT d.doc_id, size, source_size, target, shard_size, start, words,
         (sum(size) OVER (PARTITION BY d.source, d.shard ORDER BY place, doc_id::VARCHAR, size ROWS UNBOUNDED PRECEDING))::BIGINT - size AS pos,
         CASE WHEN shard_size > 0 THEN words // shard_size ELSE 0 END AS passes
  FROM dealt d JOIN rings r ON d.source IS NOT DISTINCT FROM r.source AND d.shard = r.shard)
SELECT doc_id, size, source_size, target,
       CAST(passes * size
         + greatest(least(start + words - passes * shard_size, shard_size, pos + size) - greatest(start, pos), 0)
         + greatest(least(start + words - passes * shard_size - shard_size, pos + size) - pos, 0) AS BIGINT) AS taken
FROM placed""",
}
