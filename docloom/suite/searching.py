"""Search over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.model import IndexSet
from docloom.operators import search as se
from docloom.suite import base as b

suite = b.Suite()

QUERY = "The tion; ENT when"

TERMS = ("the", "tion", "ent", "when")


def scored_sql(body: str) -> str:
    """Words, matches and score of the query per document, from the same formula."""
    counts = ", ".join(f"len(list_filter(words, lambda w: w = '{term}')) AS n{at}" for at, term in enumerate(TERMS))
    rarity = [f"ln(1 + (n - d{at} + 0.5) / (d{at} + 0.5))" for at in range(len(TERMS))]
    norm = "1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * size / mean)"
    score = " + ".join(f"{rarity[at]} * 2.2::DOUBLE * n{at} / (n{at} + {norm})" for at in range(len(TERMS)))
    held = ", ".join(f"count(*) FILTER (WHERE n{at} > 0) AS d{at}" for at in range(len(TERMS)))
    matched = " + ".join(f"(n{at} > 0)::BIGINT" for at in range(len(TERMS)))
    total = " + ".join(f"n{at}" for at in range(len(TERMS)))
    return f"""(WITH cut AS (
        SELECT doc_id, string_split_regex(lower(coalesce({body}, '')), '[^\\p{{L}}\\p{{N}}]+') AS words
        FROM documents WHERE doc_id % 4 = 1),
      counted AS (SELECT doc_id, len(list_filter(words, lambda w: w <> '')) AS size, {counts} FROM cut),
      known AS (SELECT count(*) AS n, avg(size) AS mean, {held} FROM counted)
      SELECT doc_id, {matched} AS matched_terms, CAST({total} AS BIGINT) AS total_matches, round({score}, 6) AS score
      FROM counted, known WHERE {total} > 0)"""


def counted(hits):
    return hits.select(
        "doc_id",
        F.col("matched_terms").cast("bigint").alias("matched_terms"),
        F.col("total_matches").cast("bigint").alias("total_matches"),
        "score",
    )


@suite.add(
    "search_documents",
    f"""SELECT 'tenant1_document_' || doc_id AS doc_id, matched_terms, total_matches, score
        FROM {scored_sql("concat_ws(' ', text, lang)")} s""",
)
def search_documents(spark, folder):
    """The stored table, searched over its declared text fields."""
    jobs = b.indexer(spark, folder, IndexSet((b.DOCUMENT,)))
    jobs.full(run_ts=1)
    return counted(se.ranked(jobs.index.table("document").documents(), QUERY, tenant="tenant1"))


@suite.add(
    "search_page",
    f"""SELECT * FROM {scored_sql("text")} s ORDER BY score DESC, matched_terms DESC, total_matches DESC, doc_id
        LIMIT 20 OFFSET 10""",
)
def search_page(spark, folder):
    rows = b.rows_of(spark, folder, b.DOCUMENT, "documents")
    return se.search_page(counted(se.ranked(rows, QUERY, text=F.col("text"), tenant="tenant1")), 10, 20)


@suite.add(
    "match_all",
    f"SELECT tenant, doc_id FROM {b.ALL_DOCS_SQL} d WHERE document_type = 'customer'",
)
def match_all(spark, folder):
    return se.match_all(b.all_documents(spark, folder), "customer").select("tenant", "doc_id")


@suite.add(
    "term_query",
    f"""SELECT doc_id FROM {b.ALL_DOCS_SQL} d WHERE tenant = 'tenant2' AND document_type = 'order'""",
)
def term_query(spark, folder):
    terms = {"tenant": "tenant2", "document_type": "order"}
    return se.term_query(b.all_documents(spark, folder), terms).select("doc_id")
