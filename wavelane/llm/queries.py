"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelane.llm import bpe_rounds, conversations, html_text, mixing, multi_index, near_dedup, packing, periodic, quality_rules, repeats, toxicity, url_filter, warc
from wavelane.llm.common import read, store

# The mix of the registered query and of the pipeline. The tables have no domain: sources are dealt to three
# by the last character of their name.


def domain_of_source():
    return F.concat(F.lit("d"), (F.ascii(F.substring("source", -1, 1)) % 3).cast("string"))


WEIGHTS = {"domain": {"d0": 3, "d1": 2, "d2": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 1}}


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rules = quality_rules.fit_from_labels(docs, read(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules)


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def labelled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and their right text: the number at the end of a url's path names the document the page shows."""
    number = F.regexp_extract("url", r"^[^?#]*/([0-9]+)", 1).try_cast("long")
    pages = read(spark, sf_dir, "pages").select("page_id", "html", number.alias("doc_id"))
    few = store(html_text.one_of_each(pages.where("doc_id is not null and html is not null"), 300, "doc_id"), "html-few")
    # About 300 short rows at most: the bound of this broadcast. Their html, of any length, is joined without one.
    known = read(spark, sf_dir, "documents").select("doc_id", "text").join(F.broadcast(few.select("doc_id").distinct()), "doc_id", "left_semi")
    return known.distinct().join(few, "doc_id")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(read(spark, sf_dir, "pages"), html_text.fit(labelled_pages(spark, sf_dir)))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), domain_of_source(), WEIGHTS, share=0.6, max_epochs=3)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, sf_dir, "pages"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(read(spark, sf_dir, "documents"), ["doc_id"])
    return cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read(spark, sf_dir, "pages"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_rounds.digests(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.find_runs(read(spark, sf_dir, "documents"), periodic.looped))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(conversations.turns(read(spark, sf_dir, "conversations"))))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_multi_index": op2_multi_index,
    "op3_html_text": op3_html_text,
    "op4_mixing": op4_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_url_filter": op6_url_filter,
    "op7_packing": op7_packing,
    "op8_near_dedup": op8_near_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_warc": op10_warc,
    "op11_bpe": op11_bpe,
    "op12_periodic": op12_periodic,
    "op13_conversations": op13_conversations,
}
