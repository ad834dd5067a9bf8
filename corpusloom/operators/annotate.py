"""Token annotation, markup columns and vertical / CoNLL lines."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.functions import text as tx
from corpusloom.operators.lookup import BROADCAST_BYTES, fits_broadcast, salted_lookup
from corpusloom.operators.tokens import CHUNK, UNKNOWN, chunk_of, explode_tokens, in_chunks, to_chunks
from corpusloom.staging import stage

LONGEST_SUFFIX = 4
UNKNOWN_POS = "UNK"
LEXICON_ROW_BYTES = 96
HEAD = -1


def lexicon_fit(tagged: DataFrame) -> DataFrame:
    """``form, pos, lemma``: the most frequent reading of each form.

    ``tagged`` has ``form, pos, lemma`` per token.  Ties go to the first name.
    """
    readings = tagged.groupBy("form", "pos", "lemma").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("order"), "pos", "lemma"))
    return readings.groupBy("form").agg(best.alias("best")).select("form", "best.pos", "best.lemma")


def suffix_table(lexicon: DataFrame) -> DataFrame:
    """``suffix, pos``: the most frequent tag among forms with that ending."""
    lower = F.lower("form")
    endings = F.array(*[
        F.when(F.length(lower) > n, F.right(lower, F.lit(n))) for n in range(1, LONGEST_SUFFIX + 1)
    ])
    rows = lexicon.select("pos", F.explode(endings).alias("suffix")).where(F.col("suffix").isNotNull())
    counts = rows.groupBy("suffix", "pos").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("order"), "pos"))
    return counts.groupBy("suffix").agg(best.alias("best")).select("suffix", "best.pos")


def _endings(rows: DataFrame, suffixes: DataFrame, form: str, small: bool) -> DataFrame:
    """Add ``_pos4`` to ``_pos1``: tags by ending, for rows without ``_pos``."""
    for n in range(LONGEST_SUFFIX, 0, -1):
        lower = F.lower(form)
        wanted = F.length(lower) > n
        if small:
            # A null key is not looked up at all.
            tags = ["_pos", *[f"_pos{m}" for m in range(LONGEST_SUFFIX, n, -1)]]
            wanted = wanted & F.coalesce(*tags).isNull()
        key = f"_end{n}"
        rows = rows.withColumn(key, F.when(wanted, F.right(lower, F.lit(n))))
        table = suffixes.select(F.col("suffix").alias(key), F.col("pos").alias(f"_pos{n}"))
        rows = rows.join(F.broadcast(table), key, "left") if small else salted_lookup(rows, table, [key])
    return rows


def _resolve(
    words: DataFrame, lexicon: DataFrame, suffixes: DataFrame, form: str, small: bool, small_endings: bool
) -> DataFrame:
    """Add ``pos, lemma`` by form, lower-cased form, longest known ending."""
    side = F.broadcast if small else (lambda table: table)
    exact = lexicon.select(
        F.col("form").alias(form), F.col("pos").alias("_pos0"), F.col("lemma").alias("_lemma0")
    )
    rows = words.join(side(exact), form, "left")
    lower = F.lower(form)
    if small:
        lower = F.when(F.col("_pos0").isNull(), lower)
    folded = lexicon.select(
        F.col("form").alias("_low"), F.col("pos").alias("_posl"), F.col("lemma").alias("_lemmal")
    )
    rows = rows.withColumn("_low", lower).join(side(folded), "_low", "left")
    rows = rows.withColumn("_pos", F.coalesce("_pos0", "_posl"))
    rows = _endings(rows, suffixes, form, small_endings)
    tags = ["_pos", *[f"_pos{n}" for n in range(LONGEST_SUFFIX, 0, -1)]]
    return rows.select(
        *words.columns,
        F.coalesce(*tags, F.lit(UNKNOWN_POS)).alias("pos"),
        F.coalesce("_lemma0", "_lemmal", form).alias("lemma"),
    )


def placed(docs: DataFrame, lexicon: DataFrame, id: str = "doc_id", limit: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` ready to be cut into tokens: in chunks, unless ``lexicon`` is small enough to be broadcast."""
    return docs if fits_broadcast(lexicon, LEXICON_ROW_BYTES, limit) else in_chunks(docs, id)


def annotate_tokens(
    tokens: DataFrame, lexicon: DataFrame, form: str = "tok", limit: int = BROADCAST_BYTES,
    suffixes: DataFrame | None = None,
) -> DataFrame:
    """Add ``pos, lemma`` from a lexicon; ``lexicon`` should be a stored table.

    A lexicon of checked size is broadcast, tokens stay where they are and most
    need one probe.  For a larger one, tokens cut from documents that were
    :func:`placed` stay where they are too: the distinct forms of each chunk are
    looked up and brought back to it.  A form is looked up once for each chunk
    at most, so a very frequent word is no load.  Other tokens are joined on a
    salted form with the result of one look-up per distinct form.  ``suffixes``
    is the stored :func:`suffix_table` of the lexicon, for callers that annotate
    many tables; without it the table is made here.
    """
    suffixes = stage(suffix_table(lexicon), "suffixes") if suffixes is None else suffixes
    small_endings = fits_broadcast(suffixes, LEXICON_ROW_BYTES, limit)
    if fits_broadcast(lexicon, LEXICON_ROW_BYTES, limit):
        return _resolve(tokens, lexicon, suffixes, form, True, small_endings)
    if chunk_of(tokens):
        pairs = tokens.select(CHUNK, form).distinct()
        found = to_chunks(_resolve(pairs, lexicon, suffixes, form, False, small_endings))
        return tokens.join(found.hint("shuffle_hash"), [CHUNK, form], "left").select(*tokens.columns, "pos", "lemma")
    forms = _resolve(tokens.select(form).distinct(), lexicon, suffixes, form, False, small_endings)
    return salted_lookup(tokens, forms, [form]).select(*tokens.columns, "pos", "lemma")


def annotate_with(
    df: DataFrame,
    make: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    schema: str,
) -> DataFrame:
    """Run a user's model over Arrow batches.

    ``make`` is called once per task and returns the function applied to every
    batch, so a model is loaded once, not per batch.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for batch in batches:
            yield model(batch)

    return df.mapInPandas(run, schema)


def _attribute(col: Column) -> Column:
    return F.regexp_replace(F.coalesce(col, F.lit(UNKNOWN)), r"[\t\r\n]+", " ")


def token_markup(
    docs: DataFrame, id: str = "doc_id", uri: str = "uri", title: str = "title", text: str = "text"
) -> DataFrame:
    """``id, par_pos, sent_pos, tok_pos, tok, glue, before, after``.

    One row per token of the title (``par_pos`` = -1) and of the text, with the
    structure marks that open before and close after it.  Title and paragraphs
    are laid out in one array of the document row, so first and last tokens
    are known from positions and nothing is shuffled.
    """
    name = F.coalesce(F.col(title), F.lit(UNKNOWN))
    opening = F.concat(
        F.lit('<doc id="'), F.col(id).cast("string"), F.lit('" uri="'), _attribute(F.col(uri)),
        F.lit('" title="'), _attribute(name), F.lit('">'),
    )
    head = tx.segmented(F.translate(name, "\r\n", "  "), sentences=False)
    chunk = chunk_of(docs)
    laid = docs.select(
        *chunk, id, opening.alias("open"),
        F.when(name != UNKNOWN, head).otherwise(F.lit("")).alias("head"),
        tx.paragraphs(tx.segmented(F.col(text))).alias("pars"),
    )
    has_head = F.col("head") != ""
    pars = F.when(F.get("pars", F.lit(0)) == "", F.array().cast("array<string>")).otherwise(F.col("pars"))
    laid = laid.select(
        *chunk, id, "open", has_head.alias("headed"),
        F.concat(F.when(has_head, F.array("head")).otherwise(F.array().cast("array<string>")), pars).alias("units"),
    )
    units = laid.select(
        *chunk, id, "open", "headed", F.size("units").alias("n_unit"),
        F.posexplode_outer("units").alias("unit", "seg"),
    ).where(F.col("seg").isNotNull())
    toks = explode_tokens(units, [*chunk, id, "open", "headed", "n_unit", "unit"])

    in_head = F.col("headed") & (F.col("unit") == 0)
    first_tok, last_tok = F.col("tok_pos") == 0, F.col("tok_pos") == F.col("n_tok") - 1
    first_sent, last_sent = F.col("sent_pos") == 0, F.col("sent_pos") == F.col("n_sent") - 1
    first_unit, last_unit = F.col("unit") == 0, F.col("unit") == F.col("n_unit") - 1

    def mark(condition: Column, value) -> Column:
        value = F.lit(value) if isinstance(value, str) else value
        return F.when(condition, value).otherwise(F.lit(""))

    before = F.concat(
        mark(first_tok & first_sent & first_unit, F.col("open")),
        mark(first_tok & in_head, "<head>"),
        mark(first_tok & first_sent & ~in_head, "<p>"),
        mark(first_tok & ~in_head, "<s>"),
    )
    after = F.concat(
        mark(last_tok & in_head, "</head>"),
        mark(last_tok & ~in_head, "</s>"),
        mark(last_tok & last_sent & ~in_head, "</p>"),
        mark(last_tok & last_sent & last_unit, "</doc>"),
    )
    return toks.select(
        *chunk, id, (F.col("unit") - F.col("headed").cast("int")).alias("par_pos"),
        "sent_pos", "tok_pos", "tok", "glue", before.alias("before"), after.alias("after"),
    )


POSITION = ["par_pos", "sent_pos", "tok_pos"]


def _line() -> Column:
    """Five tab-separated columns; ``_`` twice when a token has no markup."""
    bare = (F.col("before") == "") & (F.col("after") == "")
    return F.concat_ws(
        "\t", "lemma", "tok",
        F.when(bare, "_").otherwise(F.col("before")),
        F.when(bare, "_").otherwise(F.col("after")),
        "pos",
    )


def _ends_block() -> Column:
    return F.contains("after", F.lit("</s>")) | F.contains("after", F.lit("</head>"))


def vertical_lines(tokens: DataFrame, id: str = "doc_id") -> DataFrame:
    """``id, line_pos, line`` of annotated, marked-up tokens.

    Sentences and the title are followed by an empty line.
    """
    chunk = chunk_of(tokens)
    doc = Window.partitionBy(*chunk, id).orderBy(*POSITION)
    ends = F.sum(_ends_block().cast("int")).over(doc.rowsBetween(Window.unboundedPreceding, -1))
    numbered = tokens.select(
        *chunk, id, (F.row_number().over(doc) - 1 + F.coalesce(ends, F.lit(0))).cast("long").alias("at"),
        _line().alias("line"), _ends_block().alias("ends"),
    )
    lines = F.when(F.col("ends"), F.array("line", F.lit(""))).otherwise(F.array("line"))
    rows = numbered.select(*chunk, id, "at", F.posexplode(lines).alias("extra", "line"))
    return rows.select(*chunk, id, (F.col("at") + F.col("extra")).alias("line_pos"), "line")


def vertical_document(lines: DataFrame, id: str = "doc_id") -> DataFrame:
    """``id, vertical``: the lines of each document, every one ended by a newline."""
    ordered = F.sort_array(F.collect_list(F.struct("line_pos", "line")))
    grouped = lines.groupBy(*chunk_of(lines), id).agg(ordered.alias("lines"))
    return grouped.select(id, F.concat(F.array_join("lines.line", "\n"), F.lit("\n")).alias("vertical"))


def vertical_text(tokens: DataFrame, id: str = "doc_id") -> DataFrame:
    """``id, vertical`` straight from annotated tokens.

    The same text as :func:`vertical_document` over :func:`vertical_lines`
    without numbering the lines.  When ``tokens`` comes from documents that
    were partitioned by ``id`` or placed in chunks, nothing is shuffled.
    """
    line = F.concat(_line(), F.when(_ends_block(), "\n").otherwise(""))
    ordered = F.sort_array(F.collect_list(F.struct(*POSITION, line.alias("line"))))
    grouped = tokens.groupBy(*chunk_of(tokens), id).agg(ordered.alias("lines"))
    return grouped.select(id, F.concat(F.array_join("lines.line", "\n"), F.lit("\n")).alias("vertical"))


def conll_rows(tokens: DataFrame, id: str = "doc_id") -> DataFrame:
    """``id, par_pos, sent_pos, tok_pos, line``: ten CoNLL columns per token.

    Heads and relations are ``_``: there is no parser.  The token number
    restarts in every sentence.
    """
    empty = F.lit("_")
    line = F.concat_ws(
        "\t", (F.col("tok_pos") + 1).cast("string"), "tok", "lemma", "pos", "pos",
        empty, empty, empty, empty, empty,
    )
    return tokens.select(*chunk_of(tokens), id, *POSITION, line.alias("line"))


def conll_document(rows: DataFrame, id: str = "doc_id") -> DataFrame:
    """``id, conll``: sentences of each document, an empty line after each."""
    body = F.when(
        (F.col("tok_pos") == 0), F.concat(F.lit("\n"), F.col("line"))
    ).otherwise(F.col("line"))
    ordered = F.sort_array(F.collect_list(F.struct(*POSITION, body.alias("line"))))
    grouped = rows.groupBy(*chunk_of(rows), id).agg(ordered.alias("lines"))
    text = F.btrim(F.array_join("lines.line", "\n"), F.lit("\n"))
    return grouped.select(id, F.concat(text, F.lit("\n\n")).alias("conll"))
