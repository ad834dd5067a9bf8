"""The whole way from WARC records to vertical text, as a stream.

Each micro-batch becomes text files in a folder of its own, named by run and
batch; a replayed batch overwrites it.  Models are prepared once: ``profile``,
``lexicon`` and its ``suffixes`` are stored tables.  Records of a batch with
fewer archives than cores are dealt to all cores before any work on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusloom.operators.annotate import suffix_table
from corpusloom.operators.dedup import keep_paragraphs
from corpusloom.plans import corpus
from corpusloom.sources import sinks
from corpusloom.sources.tables import spread
from corpusloom.staging import stage
from corpusloom.streaming.dedup import _new_firsts, _open_seen, _store_seen, part, run_of


def corpus_batch(
    batch: DataFrame, run: str, batch_id: int, seen: str, out: str, profile: DataFrame, lexicon: DataFrame,
    allowed: tuple[str, ...] = ("en",), docs_per_file: int = 10_000, suffixes: DataFrame | None = None,
) -> None:
    """One micro-batch of ``doc_id, uri, content_type, payload``: text files first, then the seen keys."""
    work = f"{seen}-work/{run}"
    found = stage(corpus.articles(spread(batch)), "articles", f"{work}/articles")
    kept = stage(corpus.in_languages(found, profile, allowed), "language", f"{work}/language")
    _, new = _new_firsts(kept, run, batch_id, seen, "doc_id", "text")
    docs = stage(keep_paragraphs(kept, new), "clean", f"{work}/clean")
    sinks.write_vertical(corpus.vertical_corpus(docs, lexicon, suffixes), part(out, run, batch_id), docs_per_file, "overwrite")
    _store_seen(new, seen, run, batch_id)


def stream_corpus(
    records: DataFrame, profile: DataFrame, lexicon: DataFrame, seen: str, out: str, checkpoint: str,
    allowed: tuple[str, ...] = ("en",), docs_per_file: int = 10_000, suffixes: DataFrame | None = None,
):
    """Start a query writing vertical text of deduplicated documents in allowed languages.

    ``records`` is a stream as :func:`corpusloom.sources.warc.read_warc_stream`
    gives it.  Of a paragraph the copy of the first batch stays, inside a batch
    that with the lowest document id.  ``suffixes`` is the stored suffix table
    of the lexicon, for callers that start more than one stream; without it the
    table is made once here.
    """
    suffixes = stage(suffix_table(lexicon), "suffixes") if suffixes is None else suffixes
    _open_seen(records.sparkSession, seen)
    run = run_of(checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        corpus_batch(batch, run, batch_id, seen, out, profile, lexicon, allowed, docs_per_file, suffixes)

    return (
        records.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
