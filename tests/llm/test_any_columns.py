"""Tables with extra columns of every name that the package uses somewhere: nothing crashes, no own column is lost."""

import re
from pathlib import Path

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from rosterline import llm
from rosterline.llm import (
    chat_tools, decontamination, licenses, line_dedup, manifest, packing, repeats, simhash, spectra, syncmers, token_counts, toxicity, url_filters,
)
from rosterline.llm.queries import table

NAMES = sorted({
    name.lower() for path in Path(llm.__file__).parent.glob("*.py") for name in re.findall(r'"([A-Za-z_]\w{0,30})"', path.read_text())
})


def with_names(df):
    own = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in NAMES if n not in own])


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    some = table(spark, sf_dir, "documents").where("doc_id < 25 AND n_chars < 4000")
    path = f"{line_dedup.fresh_dir(spark, 'any-columns')}"
    with_names(some).write.parquet(path)
    return spark.read.parquet(path)


def test_there_are_names_to_clash_with():
    assert {"drops", "toxic", "row_id", "items", "n_hit", "__row", "text_hash", "spans", "edited_text"} <= set(NAMES)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_the_documents_columns(spark, sf_dir, docs, name, stage):
    kept = stage(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    rows, before = kept.collect(), {r["doc_id"]: r for r in docs.collect()}
    changing = {"text", "n_chars"}
    assert rows and all(r[c] == before[r["doc_id"]][c] for r in rows for c in docs.columns if c not in changing)


def test_packing_stage(spark, sf_dir, docs):
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).select("doc_id").distinct().count() == docs.count()


OPERATORS = {
    "simhash": lambda spark, docs, sf_dir, tok: simhash.near_duplicates(docs, words=3, max_distance=3),
    "toxicity": lambda spark, docs, sf_dir, tok: toxicity.scored(docs, toxicity.fit(docs, with_names(table(spark, sf_dir, "labels")))),
    "licenses": lambda spark, docs, sf_dir, tok: licenses.scan_licenses(docs),
    "syncmers": lambda spark, docs, sf_dir, tok: syncmers.with_edited(docs),
    "anchors": lambda spark, docs, sf_dir, tok: syncmers.anchors(docs),
    "line_dedup": lambda spark, docs, sf_dir, tok: line_dedup.deduplicate_lines(docs),
    "decontamination": lambda spark, docs, sf_dir, tok: decontamination.locate(docs, with_names(table(spark, sf_dir, "benchmark")), block_bytes=3000),
    "packing": lambda spark, docs, sf_dir, tok: packing.pack_documents(docs, tok, 2, with_ids=True),
    "token_counts": lambda spark, docs, sf_dir, tok: token_counts.document_lengths(with_names(token_counts.write_flat_files(docs, tok, 49407)), 49407),
    "repeats": lambda spark, docs, sf_dir, tok: repeats.without_repeats(docs),
    "manifest": lambda spark, docs, sf_dir, tok: manifest.manifest(docs, tampered={"n_chars": F.col("n_chars") + 1}, when=F.col("doc_id") == 3),
    "spectra": lambda spark, docs, sf_dir, tok: spectra.whiten(with_names(table(spark, sf_dir, "embeddings").limit(30))),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operators_take_any_columns(spark, sf_dir, docs, tokenizer, name):
    result = OPERATORS[name](spark, docs, sf_dir, tokenizer)
    plain = OPERATORS[name](spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), sf_dir, tokenizer)
    assert result.count() == plain.count()


def test_lists_and_calls_take_any_columns(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.current_date().alias("fetched_at")).limit(20)
    entries = spark.createDataFrame([("example.com", "ads", "add", None)], "domain STRING, category STRING, action STRING, at DATE")
    assert url_filters.filter_captures(with_names(pages), url_filters.validity(with_names(entries))).count() == pages.count()
    calls = spark.createDataFrame([(1, "a", 1, "f", "{}", ["b"]), (1, "b", 2, "f", "{}", [])], "conv_id INT, call_id STRING, position INT, name STRING, arguments STRING, needs ARRAY<STRING>")
    results = spark.createDataFrame([(1, "a", 1, "x")], "conv_id INT, call_id STRING, position INT, content STRING")
    assert chat_tools.format_calls(with_names(calls), with_names(results), {"f": {}}).count() == 2
