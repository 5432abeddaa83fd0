"""Projection, filtering and cleaning."""

from pyspark.sql import functions as F

from reviewloom.functions.text import (
    CODE_TOKEN,
    MENTION_TOKEN,
    URL_TOKEN,
    clean_text,
    mask_codes,
    mask_mentions,
    mask_urls,
    squeeze_blanks,
    text_length,
)
from reviewloom.operators.filters import drop_blank, prepare_reviews, rejection_report
from reviewloom.queries.tables import (
    CLEANED_SQL,
    HAS_TEXT_SQL,
    PATCHY_SQL,
    REVIEWS_SQL,
    clean_sql,
    patchy_reviews,
    reviews,
    spread_reviews,
    spread_table,
)


def reviews_projection(spark, sf_dir):
    return reviews(spark, sf_dir)


def blank_filter(spark, sf_dir):
    return drop_blank(patchy_reviews(spark, sf_dir)).select("asin", "text")


def rejections(spark, sf_dir):
    return rejection_report(patchy_reviews(spark, sf_dir))


def text_lengths(spark, sf_dir):
    return reviews(spark, sf_dir).select("asin", text_length("text").alias("text_length"))


def cleaned_reviews(spark, sf_dir):
    return prepare_reviews(spread_reviews(spark, sf_dir))


def cleaned_patchy_reviews(spark, sf_dir):
    return prepare_reviews(patchy_reviews(spark, sf_dir)).select("asin", "text_length", "preprocessed_text")


def cleaned_pages(spark, sf_dir):
    """URLs are masked here: every page has one, and its HTML has more."""
    return spread_table(spark, sf_dir, "pages").select(
        "page_id", clean_text("url").alias("clean_url"), clean_text("html").alias("clean_html")
    )


def cleaning_steps(spark, sf_dir):
    """Each rule on its own, on the text as it is."""
    return spread_table(spark, sf_dir, "pages").select(
        "page_id",
        F.lower("html").alias("lowered"),
        mask_urls("html").alias("urls_masked"),
        mask_mentions("html").alias("mentions_masked"),
        mask_codes("html").alias("codes_masked"),
        squeeze_blanks("html").alias("blanks_squeezed"),
    )


def mask_counts(spark, sf_dir):
    """Rows of each table that hold each mask token after cleaning."""
    documents = spread_table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("source_table"), clean_text("text").alias("clean")
    )
    pages = spread_table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("source_table"),
        clean_text(F.concat_ws(" ", "url", "html")).alias("clean"),
    )

    def rows_with(token):
        return F.count_if(F.contains(F.col("clean"), F.lit(token)))

    return (
        documents.unionByName(pages)
        .groupBy("source_table")
        .agg(
            rows_with(URL_TOKEN).alias("url_rows"),
            rows_with(MENTION_TOKEN).alias("mention_rows"),
            rows_with(CODE_TOKEN).alias("code_rows"),
        )
    )


def codes_before_lower(spark, sf_dir):
    """With a private-use character and the token itself in every text."""
    text = F.concat("text", F.lit(" \ue000 [PRODUCT]"))
    return spread_reviews(spark, sf_dir).select(
        "asin", clean_text(text, mask_codes_before_lower=True).alias("preprocessed_text")
    )


QUERIES = {
    "reviews_projection": reviews_projection,
    "blank_filter": blank_filter,
    "rejection_report": rejections,
    "text_length": text_lengths,
    "clean_text": cleaned_reviews,
    "clean_text_patchy": cleaned_patchy_reviews,
    "clean_text_pages": cleaned_pages,
    "clean_steps": cleaning_steps,
    "clean_mask_counts": mask_counts,
    "clean_codes_before_lower": codes_before_lower,
}

_WORD = r"\p{L}\p{N}_"
_URL = (
    r"https?://[^\t\n\r\f\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000} ]+"
    r"|www\.[^\t\n\r\f\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000} ]+"
)
_BLANK_RUN = r"[\t\n\r\f\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000} ]+"


def _mask_codes_sql(text, before="", token="[PRODUCT]"):
    pattern = f"(^|[^{_WORD}{before}])[A-Z0-9]{{10,}}($|[^{_WORD}])"
    once = f"regexp_replace({text}, '{pattern}', '\\1{token}\\2', 'g')"
    return f"regexp_replace({once}, '{pattern}', '\\1{token}\\2', 'g')"


# A private-use character, and the token itself, as parts of the input.
_MARKED_SQL = "replace(text || ' ' || chr(57344) || ' [PRODUCT]', '[PRODUCT]', '[product]')"


def _lower_between(text):
    return f"array_to_string(list_transform(string_split({text}, '[PRODUCT]'), lambda t: lower(t)), '[PRODUCT]')"


ORACLES = {
    "reviews_projection": f"WITH {REVIEWS_SQL} SELECT text, asin, user_id, rating, title FROM reviews",
    "blank_filter": f"WITH {PATCHY_SQL} SELECT asin, text FROM reviews WHERE {HAS_TEXT_SQL}",
    "rejection_report": f"""
WITH {PATCHY_SQL},
counts AS (
  SELECT count(*) AS original_count,
         count(*) FILTER (WHERE {HAS_TEXT_SQL}) AS retained_count
  FROM reviews)
SELECT original_count, retained_count, original_count - retained_count AS rejected_count,
       round(100.0::DOUBLE * (original_count - retained_count) / original_count, 2) AS rejection_rate
FROM counts""",
    "text_length": f"WITH {REVIEWS_SQL} SELECT asin, CAST(length(text) AS INTEGER) AS text_length FROM reviews",
    "clean_text": f"WITH {REVIEWS_SQL}, {CLEANED_SQL} SELECT * FROM cleaned",
    "clean_text_patchy": f"""
WITH {PATCHY_SQL}, {CLEANED_SQL} SELECT asin, text_length, preprocessed_text FROM cleaned""",
    "clean_text_pages": f"""
SELECT page_id, {clean_sql("url")} AS clean_url, {clean_sql("html")} AS clean_html FROM pages""",
    "clean_steps": f"""
SELECT page_id, lower(html) AS lowered,
       regexp_replace(html, '{_URL}', '[URL]', 'g') AS urls_masked,
       regexp_replace(html, '@[{_WORD}]+', '[USER]', 'g') AS mentions_masked,
       {_mask_codes_sql("html")} AS codes_masked,
       trim(regexp_replace(html, '{_BLANK_RUN}', ' ', 'g'), ' ') AS blanks_squeezed
FROM pages""",
    "clean_mask_counts": f"""
WITH texts AS (
  SELECT 'documents' AS source_table, text AS t FROM documents
  UNION ALL SELECT 'pages', concat_ws(' ', url, html) FROM pages),
masked AS (SELECT source_table, {clean_sql("t")} AS clean FROM texts)
SELECT source_table,
       count(*) FILTER (WHERE contains(clean, '[URL]')) AS url_rows,
       count(*) FILTER (WHERE contains(clean, '[USER]')) AS mention_rows,
       count(*) FILTER (WHERE contains(clean, '[PRODUCT]')) AS code_rows
FROM masked GROUP BY source_table""",
    "clean_codes_before_lower": f"""
WITH {REVIEWS_SQL}
SELECT asin, {clean_sql(_lower_between(_mask_codes_sql(_MARKED_SQL, "@")), lowered=True)} AS preprocessed_text
FROM reviews""",
}
