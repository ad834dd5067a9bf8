"""The whole way from page records to an annotated corpus.

Text is shuffled once, for the language filter, and stored by document; the
positions of first-seen paragraphs are then brought to it.  Everything else
moves keys, positions and sums only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.operators import annotate, html, langid
from corpusloom.operators.dedup import first_copies, keep_paragraphs, reassemble
from corpusloom.operators.tokens import CHUNK, paragraph_hash
from corpusloom.staging import stage, stage_by


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, text, n_par, n_dup``: documents without repeated paragraphs."""
    return reassemble(docs, paragraph_hash(docs, id, text), id, text)


def articles(pages: DataFrame, content_type: str | None = "content_type") -> DataFrame:
    """``doc_id, uri, title, text`` of the HTML records of a crawl."""
    records = html.filter_html(pages, "payload", content_type)
    records = html.extract_title(records, "payload")
    return html.article_text(records, "doc_id", "payload", keep=("uri", "title"))


def in_languages(
    docs: DataFrame, profile: DataFrame, allowed: tuple[str, ...] = ("en",), id: str = "doc_id"
) -> DataFrame:
    """Documents whose best language is allowed."""
    langs = langid.filter_lang(langid.langid_predict(docs, profile, id), allowed=allowed)
    return docs.join(langs.select(id), id, "left_semi")


def clean_corpus(
    pages: DataFrame,
    profile: DataFrame,
    allowed: tuple[str, ...] = ("en",),
    content_type: str | None = "content_type",
) -> DataFrame:
    """``doc_id, uri, title, text, n_par, n_dup`` from page records.

    Articles and the documents in allowed languages are stored, because each is
    read twice and costs more to make than to read; the latter by document, so
    that re-assembly does not shuffle them again.
    """
    found = stage(articles(pages, content_type), "articles")
    kept = stage_by(in_languages(found, profile, allowed), "language", "doc_id")
    firsts = first_copies(paragraph_hash(kept))
    return keep_paragraphs(kept, firsts)


def annotated(
    docs: DataFrame, lexicon: DataFrame, together: bool = False, suffixes: DataFrame | None = None
) -> DataFrame:
    """Marked-up tokens with ``pos`` and ``lemma``.

    Documents are placed in chunks before they are cut into tokens when the
    lexicon is large; tokens then have the number of their chunk.
    ``together`` places documents by id before they are cut into tokens, for a
    caller that puts them together again: raw text is shuffled then, not the
    many times larger annotated tokens.
    """
    placed = annotate.placed(docs, lexicon)
    if together and CHUNK not in placed.columns:
        placed = docs.repartition("doc_id")
    return annotate.annotate_tokens(annotate.token_markup(placed), lexicon, suffixes=suffixes)


def vertical_corpus(docs: DataFrame, lexicon: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """``doc_id, vertical``; a document left with neither title nor text has none."""
    return annotate.vertical_text(annotated(docs, lexicon, together=True, suffixes=suffixes))


def conll_corpus(docs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``doc_id, conll`` of the paragraphs, without titles."""
    toks = annotated(docs, lexicon, together=True).where(F.col("par_pos") >= 0)
    return annotate.conll_document(annotate.conll_rows(toks))
