"""Every operator as a query over the supplied tables, whole and uncapped."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.functions import text as tx
from corpusloom.operators import annotate, bloom, dedup, html, langid, profile, tokens
from corpusloom.plans import corpus
from corpusloom.sources import sinks, warc
from corpusloom.sources.tables import read_table
from corpusloom.staging import new_path, stage
from corpusloom.streaming import dedup as streaming
from corpusloom.streaming.corpus import stream_corpus as start_corpus

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MEDIA_TYPE = "text/html; charset=UTF-8"
MICRO_BATCHES = 3


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# ---------------------------------------------------------------- inputs

def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return read_table(spark, f"{sf}/documents.parquet", list(columns or ("doc_id", "text")))


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/pages.parquet", ["page_id", "url", "html"])


def benchmark_keys(spark: SparkSession, sf: str) -> DataFrame:
    items = read_table(spark, f"{sf}/benchmark.parquet", ["item_id", "text"])
    return tokens.paragraph_hash(items, "item_id")


def turn_keys(spark: SparkSession, sf: str) -> DataFrame:
    turns = read_table(spark, f"{sf}/conversations.parquet", ["conv_id", "text"])
    return tokens.paragraph_hash(turns, "conv_id")


def document_keys(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.paragraph_hash(documents(spark, sf))


def page_articles(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, uri, title, text`` of the page table."""
    records = pages(spark, sf).toDF("doc_id", "uri", "payload")
    return corpus.articles(records, content_type=None)


def stand_in_tag(tok: Column) -> Column:
    """A tag from the shape of a token; a stand-in, not a linguistic resource."""
    return (
        F.when(tok.rlike(r"^\p{N}"), "NUM")
        .when(~tok.rlike(r"[\p{L}\p{N}]"), "PUNCT")
        .when(tok.rlike("ing$"), "VBG")
        .when(tok.rlike("ed$"), "VBD")
        .when(tok.rlike("ly$"), "RB")
        .when(tok.rlike(r"^\p{Lu}"), "NNP")
        .otherwise("NN")
    )


def tagged_turns(spark: SparkSession, sf: str) -> DataFrame:
    """``form, pos, lemma`` per token of the conversations."""
    turns = read_table(spark, f"{sf}/conversations.parquet", ["conv_id", "turn", "text"])
    toks = tokens.token_table(turns.select(F.concat_ws("-", "conv_id", "turn").alias("doc_id"), "text"))
    return toks.select(
        F.col("tok").alias("form"), stand_in_tag(F.col("tok")).alias("pos"), F.lower("tok").alias("lemma")
    )


def lexicon(spark: SparkSession, sf: str) -> DataFrame:
    return stage(annotate.lexicon_fit(tagged_turns(spark, sf)), "lexicon")


def profile_of_documents(spark: SparkSession, sf: str) -> DataFrame:
    return stage(langid.langid_fit(documents(spark, sf, "text", "lang")), "profile")


def events_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The events table read as profiling rows, ten events to a block."""
    events = read_table(spark, f"{sf}/events.parquet", ["event_id", "ts", "user_id", "event_type", "value"])
    return events.select(
        F.concat(F.lit("run-"), F.expr("event_id % 2")).alias("deployment_id"),
        F.col("event_type").alias("bolt_type"),
        F.expr("event_id div 10").cast("string").alias("tuple_uuid"),
        F.lit(1).cast("long").alias("num_elements"),
        F.col("user_id").cast("string").alias("hostname"),
        F.col("ts").alias("timestamp"),
        F.round(F.col("value") * 1_000_000).cast("long").alias("time"),
    )


# ---------------------------------------------------------------- sources, HTML

def write_archives(records: DataFrame, path: str) -> None:
    """``page_id, url, html`` as gzipped WARC archives in a folder."""
    body = F.concat(F.lit(f"HTTP/1.1 200 OK\r\nContent-Type: {MEDIA_TYPE}\r\n\r\n"), F.col("html"))
    record = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Record-ID: <urn:uuid:page-"), F.col("page_id"),
        F.lit(">\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(body), F.lit("\r\n\r\n"), body,
    )
    writer = records.select(record.alias("value")).write.option("compression", "gzip")
    writer.option("lineSep", "\r\n\r\n").text(path)


def write_page_archives(spark: SparkSession, sf: str) -> str:
    """The page table as archives; returns their folder."""
    path = new_path(spark, "archives")
    write_archives(pages(spark, sf), path)
    return path


@query
def src_warc(spark, sf):
    return warc.read_warc(spark, write_page_archives(spark, sf), framing="separator", check=True)


@query
def src_warc_manifest(spark, sf):
    """Archives named by a manifest, of two versions, whose bodies hold what parts records."""
    base = new_path(spark, "crawl")
    docs = documents(spark, sf)
    body = F.concat(F.lit("first\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\n"), F.coalesce("text", F.lit("")))
    record = F.concat(
        F.lit("WARC/1."), F.expr("doc_id % 2"), F.lit("\r\nWARC-Type: resource\r\nWARC-Target-URI: urn:doc:"), F.col("doc_id"),
        F.lit("\r\nWARC-Record-ID: <urn:uuid:doc-"), F.col("doc_id"), F.lit(">\r\nContent-Length: "),
        F.octet_length(body), F.lit("\r\n\r\n"), body)
    archives = docs.select(record.alias("value")).write.option("compression", "gzip").option("lineSep", "\r\n\r\n")
    archives.text(f"{base}/warcfiles")
    names = spark.read.format("binaryFile").load(f"{base}/warcfiles").select(F.regexp_extract("path", "[^/]*$", 0).alias("value"))
    names.coalesce(1).write.text(f"{base}/manifest")  # one short line for each archive
    manifest = spark.read.format("binaryFile").load(f"{base}/manifest").select("path").first().path
    listed = warc.read_manifests(spark, manifest, folder="../warcfiles")
    return warc.read_warc(spark, listed, check=True)

@query
def filter_html(spark, sf):
    """Pages among plain-text records."""
    html_records = pages(spark, sf).select(
        F.concat(F.lit("p"), "page_id").alias("rec_id"), F.lit(None).cast("string").alias("content_type"),
        F.col("html").alias("payload"),
    )
    text_records = documents(spark, sf).select(
        F.concat(F.lit("d"), "doc_id").alias("rec_id"), F.lit("text/plain").alias("content_type"),
        F.col("text").alias("payload"),
    )
    return html.filter_html(html_records.unionByName(text_records))


@query
def extract_title(spark, sf):
    return html.extract_title(pages(spark, sf)).select("page_id", "url", "title")


@query
def html_blocks(spark, sf):
    return html.html_blocks(pages(spark, sf))


@query
def block_classify(spark, sf):
    return html.block_classify(html.html_blocks(pages(spark, sf)))


@query
def article_text(spark, sf):
    return html.article_text(pages(spark, sf))


# ---------------------------------------------------------------- language

@query
def langid_fit(spark, sf):
    return langid.langid_fit(documents(spark, sf, "text", "lang"))


@query
def langid_predict(spark, sf):
    return langid.langid_predict(documents(spark, sf), profile_of_documents(spark, sf))


@query
def filter_lang(spark, sf):
    return langid.filter_lang(documents(spark, sf, "doc_id", "text", "lang", "source"))


# ---------------------------------------------------------------- tokens

@query
def paragraph_split(spark, sf):
    return tokens.paragraph_split(documents(spark, sf))


@query
def token_table(spark, sf):
    return tokens.token_table(documents(spark, sf))


@query
def head_tokens(spark, sf):
    return tokens.head_tokens(html.extract_title(pages(spark, sf)), "page_id")


@query
def vertical_paragraph(spark, sf):
    return tokens.vertical_paragraph(documents(spark, sf))


@query
def paragraph_hash(spark, sf):
    return document_keys(spark, sf)


# ---------------------------------------------------------------- deduplication

@query
def dedup_first_seen(spark, sf):
    return dedup.dedup_first_seen(document_keys(spark, sf))


@query
def dedup_against_earlier(spark, sf):
    """Paragraphs of the benchmark count as seen before."""
    return dedup.dedup_first_seen(document_keys(spark, sf), seen=benchmark_keys(spark, sf))


@query
def dedup_keep_unique(spark, sf):
    docs = documents(spark, sf)
    pars = tokens.segment_paragraphs(docs).select(
        "doc_id", "par_pos", tx.paragraph_key(F.col("seg")).alias("key"),
        tx.vertical(F.col("seg")).alias("par"),
    )
    return dedup.dedup_keep_unique(pars)


@query
def dup_stats(spark, sf):
    return dedup.dup_stats(dedup.dedup_first_seen(document_keys(spark, sf)))


@query
def doc_verdict_join(spark, sf):
    verdicts = dedup.dedup_first_seen(document_keys(spark, sf))
    return dedup.doc_verdict_join(documents(spark, sf), verdicts)


@query
def reassemble(spark, sf):
    """Flagship: English documents without paragraphs seen before."""
    docs = langid.filter_lang(documents(spark, sf, "doc_id", "text", "lang"))
    return corpus.deduplicate(docs)


@query
def clean_corpus(spark, sf):
    """Pages to deduplicated English articles."""
    records = pages(spark, sf).toDF("doc_id", "uri", "payload")
    return corpus.clean_corpus(records, profile_of_documents(spark, sf), content_type=None)


# ---------------------------------------------------------------- Bloom filter

def _bloom_of(keys: DataFrame, **options) -> DataFrame:
    return stage(bloom.bloom_build(keys, **options), "bloom")


@query
def bloom_build(spark, sf):
    built = bloom.bloom_build(document_keys(spark, sf))
    return built.withColumn("bitmap", F.lower(F.hex("bitmap")))


@query
def bloom_probe(spark, sf):
    built = _bloom_of(benchmark_keys(spark, sf))
    return bloom.bloom_probe(document_keys(spark, sf), built)


@query
def bloom_merge(spark, sf):
    """Two corpora in filters of one size, merged."""
    docs, turns = stage(document_keys(spark, sf), "keys"), stage(turn_keys(spark, sf), "keys")
    expected = docs.select("key").unionByName(turns.select("key")).distinct().count()
    merged = bloom.bloom_merge(_bloom_of(docs, n=expected), _bloom_of(turns, n=expected))
    return merged.withColumn("bitmap", F.lower(F.hex("bitmap")))


@query
def bloom_stats(spark, sf):
    return bloom.bloom_stats(_bloom_of(document_keys(spark, sf)))


@query
def dedup_bloom(spark, sf):
    built = _bloom_of(benchmark_keys(spark, sf))
    return bloom.dedup_bloom(document_keys(spark, sf), built)


# ---------------------------------------------------------------- annotation, sinks

@query
def lexicon_fit(spark, sf):
    return annotate.lexicon_fit(tagged_turns(spark, sf))


@query
def annotate_tokens(spark, sf):
    found = lexicon(spark, sf)
    toks = tokens.token_table(annotate.placed(documents(spark, sf), found))
    return annotate.annotate_tokens(toks, found).drop(tokens.CHUNK)


def _shape_model():
    """A user model: the shape of a token, over a whole batch at once."""
    def run(batch: pd.DataFrame) -> pd.DataFrame:
        tok = batch["tok"]
        return pd.DataFrame({
            "doc_id": batch["doc_id"], "par_pos": batch["par_pos"], "sent_pos": batch["sent_pos"],
            "tok_pos": batch["tok_pos"], "n_chars": tok.str.len(),
            "numeric": tok.str.match(r"^[0-9]").astype(bool),
        })

    return run


@query
def annotate_hook(spark, sf):
    return annotate.annotate_with(
        tokens.token_table(documents(spark, sf)).select("doc_id", "par_pos", "sent_pos", "tok_pos", "tok"),
        _shape_model,
        "doc_id bigint, par_pos int, sent_pos int, tok_pos int, n_chars bigint, numeric boolean",
    )


@query
def token_markup(spark, sf):
    return annotate.token_markup(page_articles(spark, sf))


def annotated_pages(spark, sf, together=False):
    return corpus.annotated(page_articles(spark, sf), lexicon(spark, sf), together)


@query
def vertical_lines(spark, sf):
    return annotate.vertical_lines(annotated_pages(spark, sf, together=True)).drop(tokens.CHUNK)


@query
def vertical_document(spark, sf):
    return corpus.vertical_corpus(page_articles(spark, sf), lexicon(spark, sf))


@query
def conll_document(spark, sf):
    return corpus.conll_corpus(page_articles(spark, sf), lexicon(spark, sf))


@query
def corpus_vertical(spark, sf):
    """Pages to vertical text of deduplicated English articles."""
    return corpus.vertical_corpus(stage(clean_corpus(spark, sf), "clean"), lexicon(spark, sf))


@query
def corpus_conll(spark, sf):
    """Pages to CoNLL text of deduplicated English articles."""
    return corpus.conll_corpus(stage(clean_corpus(spark, sf), "clean"), lexicon(spark, sf))


@query
def conll_rows(spark, sf):
    toks = annotated_pages(spark, sf).where(F.col("par_pos") >= 0)
    return annotate.conll_rows(toks).drop(tokens.CHUNK)


@query
def sink_conll(spark, sf):
    """Lines read back from the written CoNLL files, with their number."""
    path = new_path(spark, "conll")
    sinks.write_conll(conll_document(spark, sf), path)
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query
def sink_vertical(spark, sf):
    """Lines read back from the written files, with their number."""
    path = new_path(spark, "vertical")
    sinks.write_vertical(vertical_document(spark, sf), path)
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- profiling

def _stage_conditions() -> dict[str, Column]:
    return {
        "read": F.lit(True),
        "text": F.col("text").rlike(tx.VISIBLE_PATTERN),
        "english": F.col("lang") == "en",
        "labelled": F.col("source") == "web",
    }


@query
def stage_counts(spark, sf):
    return profile.stage_counts(documents(spark, sf, "text", "lang", "source"), _stage_conditions())


@query
def profile_rows(spark, sf):
    """Counts observed while the documents pass three stages."""
    watch = profile.StageProfiler("check")
    docs = watch.watch("read", documents(spark, sf, "doc_id", "text", "lang"))
    kept = watch.watch("language", langid.filter_lang(docs))
    pars = watch.watch("paragraphs", tokens.paragraph_hash(kept))
    pars.write.format("noop").mode("overwrite").save()
    return watch.rows(spark).select("deployment_id", "bolt_type", "tuple_uuid", "num_elements")


@query
def profile_by_stage(spark, sf):
    return profile.profile_by_stage(events_profile(spark, sf))


@query
def profile_by_host(spark, sf):
    return profile.profile_by_host(events_profile(spark, sf))


@query
def profile_by_time(spark, sf):
    return profile.profile_by_time(events_profile(spark, sf))


@query
def profile_trace(spark, sf):
    return profile.profile_trace(events_profile(spark, sf))


# ---------------------------------------------------------------- streaming

def in_order(df: DataFrame, id: str) -> list[DataFrame]:
    """Equal ranges of ids, one for each micro-batch."""
    low, high = df.agg(F.min(id), F.max(id)).first()
    step = (high - low) // MICRO_BATCHES + 1
    starts = [low + n * step for n in range(MICRO_BATCHES)]
    return [df.where((F.col(id) >= start) & (F.col(id) < start + step)) for start in starts]


def document_chunks(spark: SparkSession, sf: str):
    """The documents in the order of their ids, as folders of files arriving one after the other.

    Yields the glob of all folders so far each time one more is written; a
    stream over it run until nothing is left takes the new folder as one
    micro-batch.  Chunks are written as they lie, by as many tasks as they have.
    """
    docs = documents(spark, sf)
    folder = new_path(spark, "stream")
    for n, chunk in enumerate(in_order(docs, "doc_id")):
        chunk.write.mode("overwrite").parquet(f"{folder}/{n}")
        yield docs.schema, f"{folder}/*"


@query
def stream_corpus(spark, sf):
    """Archives to vertical text in three micro-batches, the last under a new checkpoint; lines with their number."""
    profile_, lexicon_ = profile_of_documents(spark, sf), lexicon(spark, sf)
    suffixes = stage(annotate.suffix_table(lexicon_), "suffixes")
    seen, out = new_path(spark, "seen"), new_path(spark, "vertical")
    table = pages(spark, sf).withColumn("page_id", F.col("page_id").cast("long"))
    folders = [new_path(spark, "archives"), new_path(spark, "archives")]
    checkpoints = [new_path(spark, "checkpoint"), new_path(spark, "checkpoint")]
    # A range of ids lies in a few partitions of the table: each chunk is dealt to as many archives as the table or the cluster has parts.
    archives = max(spark.sparkContext.defaultParallelism, table.rdd.getNumPartitions())
    for n, chunk in enumerate(in_order(table, "page_id")):
        run = int(n == MICRO_BATCHES - 1)
        # Ids of one width, whose order as text is that of the numbers.
        padded = chunk.withColumn("page_id", F.lpad(F.col("page_id").cast("string"), 12, "0"))
        write_archives(padded.repartition(archives, "page_id"), f"{folders[run]}/{n}")
        records = warc.read_warc_stream(spark, f"{folders[run]}/*")
        start_corpus(records, profile_, lexicon_, seen, out, checkpoints[run], suffixes=suffixes).awaitTermination()
    lines = spark.read.option("lineSep", "\n").text(out)
    line = F.regexp_replace("value", r'^(.*<doc id=")page-0*([0-9])', "$1$2")
    return lines.groupBy(line.alias("line")).agg(F.count("*").alias("n"))


@query
def stream_first_seen(spark, sf):
    out, checkpoint = new_path(spark, "first-seen"), new_path(spark, "checkpoint")
    for schema, files in document_chunks(spark, sf):
        firsts = streaming.stream_first_seen(spark.readStream.schema(schema).parquet(files))
        firsts.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint) \
            .trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("key string").parquet(out)


def _run_stream(spark, sf, start, schema):
    out, seen, checkpoint = new_path(spark, "out"), new_path(spark, "seen"), new_path(spark, "checkpoint")
    for kind, files in document_chunks(spark, sf):
        start(spark.readStream.schema(kind).parquet(files), seen, out, checkpoint).awaitTermination()
    return spark.read.schema(schema).parquet(out).drop("run", "batch_id")


@query
def stream_dedup(spark, sf):
    return _run_stream(spark, sf, streaming.stream_dedup, "doc_id bigint, par_pos int, key string, dup boolean")


@query
def stream_documents(spark, sf):
    return _run_stream(spark, sf, streaming.stream_documents, "doc_id bigint, text string, n_par int, n_dup int")
