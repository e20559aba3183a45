"""Batch search over documents: match, score, page."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD_BREAK = r"[^\p{L}\p{N}]+"
#: How fast further matches of a word count for less, and how much the length of a text weighs.
SATURATION, LENGTH_WEIGHT = 1.2, 0.75
#: Decimals that scores are kept to, so that equal ones are ties wherever they are computed.
DECIMALS = 6


def query_terms(search_text: str) -> list[str]:
    """Distinct lower-case words of the query, in order."""
    words = (word for word in re.split(r"[\W_]+", search_text.lower()) if word)
    return list(dict.fromkeys(words))


def words(text: Column) -> Column:
    """Lower-case words of a text."""
    return F.split(F.lower(text), WORD_BREAK)


def search(
    documents: DataFrame,
    search_text: str,
    text: Column | None = None,
    tenant: str | None = None,
) -> DataFrame:
    """Documents that hold any query word, with ``matched_terms`` and ``total_matches``.

    Each document is scored where it lies: its words are compared with the few query
    words, so nothing is exploded or shuffled.  ``text`` defaults to all declared text
    fields.
    """
    if tenant is not None:
        documents = documents.where(F.col("tenant") == tenant)
    body = text if text is not None else text_fields(documents)
    terms = query_terms(search_text)
    if not terms:
        none = documents.where(F.lit(False))
        return none.withColumns(
            {"matched_terms": F.lit(0), "total_matches": F.lit(0)}
        )
    wanted = F.array(*[F.lit(term) for term in terms])
    any_term = F.lit(False)
    for term in terms:
        any_term = any_term | F.contains(F.lower(body), F.lit(term))
    hits = F.filter(words(body), lambda word: F.array_contains(wanted, word))
    return (
        documents.where(any_term)
        .withColumn("_hits", hits)
        .withColumn("matched_terms", F.size(F.array_distinct("_hits")))
        .withColumn("total_matches", F.size("_hits"))
        .drop("_hits")
        .where("matched_terms > 0")
    )


def ranked(
    documents: DataFrame,
    search_text: str,
    text: Column | None = None,
    tenant: str | None = None,
) -> DataFrame:
    """The hits of a search with a ``score`` that grows with the rarity of the matched words.

    One aggregate pass over the searched documents counts them, their mean length, and those that hold each
    query word; one row reaches the driver.  A word then weighs by the logarithm of its rarity, and its
    matches by a saturating share that is smaller in long texts.  A null text is empty.
    """
    if tenant is not None:
        documents = documents.where(F.col("tenant") == tenant)
    body = F.coalesce(text if text is not None else text_fields(documents), F.lit(""))
    hits, terms = search(documents, search_text, body), query_terms(search_text)
    if not terms:
        return hits.withColumn("score", F.lit(0.0))
    length = F.size(F.filter(words(body), lambda word: word != ""))
    holding = [F.count_if(F.array_contains(words(body), term)).alias(f"_{at}") for at, term in enumerate(terms)]
    known = documents.agg(F.count(F.lit(1)).alias("n"), F.avg(length).alias("mean"), *holding).first()
    norm = SATURATION * (1 - LENGTH_WEIGHT + LENGTH_WEIGHT * F.col("_length") / F.lit(max(known.mean or 0.0, 1e-9)))
    score = F.lit(0.0)
    for at, term in enumerate(terms):
        found = known[f"_{at}"]
        rarity = math.log(1 + (known.n - found + 0.5) / (found + 0.5))
        matches = F.size("_words") - F.size(F.array_remove("_words", term))
        score = score + F.lit(rarity * (SATURATION + 1)) * matches / (matches + norm)
    return (
        hits.withColumn("_words", words(body))
        .withColumn("_length", length)
        .withColumn("score", F.round(score, DECIMALS))
        .drop("_words", "_length")
    )


def text_fields(documents: DataFrame) -> Column:
    """The declared string fields of a document as one text."""
    fields = documents.schema["doc"].dataType.fields
    names = [field.name for field in fields if isinstance(field.dataType, T.StringType)]
    return F.concat_ws(" ", *[F.col("doc")[name] for name in names])


def ranking(key: str = "doc_id") -> list[Column]:
    """More distinct words first, then more matches, then the id."""
    return [F.col("matched_terms").desc(), F.col("total_matches").desc(), F.col(key).asc()]


def search_page(hits: DataFrame, start: int, size: int, key: str = "doc_id") -> DataFrame:
    """``size`` hits from position ``start`` of the ranking, by score if they have one: a top-k, not a full sort."""
    first = [F.col("score").desc()] if "score" in hits.columns else []
    return hits.orderBy(*first, *ranking(key)).offset(start).limit(size)


def match_all(documents: DataFrame, document_type: str) -> DataFrame:
    return documents.where(F.col("document_type") == document_type)


def term_query(documents: DataFrame, terms: dict[str, object]) -> DataFrame:
    """Exact match on every given column."""
    for column, value in terms.items():
        documents = documents.where(F.col(column) == value)
    return documents


def stored_ids(documents: DataFrame, types: Sequence[str], tenant: str) -> DataFrame:
    """Ids only, of one tenant and some types."""
    return documents.where(
        (F.col("tenant") == tenant) & F.col("document_type").isin(*types)
    ).select("doc_id")
