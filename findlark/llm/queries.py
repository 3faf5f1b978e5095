"""The registered queries of this folder over the driver's tables, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from findlark.llm import (
    decontaminate,
    langid,
    lines,
    mixing,
    passages,
    periods,
    pii,
    prefixes,
    quality,
    regions,
    simhash,
    substrings,
    warc,
)
from findlark.llm.common import table
from findlark.workload.common import Catalogue

QUERIES = Catalogue()


@QUERIES.add(substrings.SQL)
def op1_substrings(spark, sf_dir):
    """All documents without bytes of 100-byte strings that start earlier."""
    return substrings.deduplicate(table(spark, sf_dir, "documents")).drop("kept")


@QUERIES.add()
def op2_pii(spark, sf_dir):
    """Personal data in all documents."""
    return pii.personal_data(table(spark, sf_dir, "documents")).drop("found")


@QUERIES.add()
def op3_decontaminate(spark, sf_dir):
    """Documents that hold a benchmark item, as it is or filled in anew."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@QUERIES.add()
def op4_langid(spark, sf_dir):
    """Languages of all documents, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows = langid.identify(docs.withColumn("held_out", langid.is_held_out()))
    return rows.select("doc_id", "held_out", "lang_pred", "score")


@QUERIES.add()
def op5_simhash(spark, sf_dir):
    """Fingerprints of all documents and the components they link in."""
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@QUERIES.add()
def op6_passages(spark, sf_dir):
    """Documents that share near-duplicate passages of 50 words or more, and their classes."""
    return passages.near_passages(table(spark, sf_dir, "documents"))


@QUERIES.add()
def op7_lines(spark, sf_dir):
    """All documents without repeated chunks of lines."""
    rows = lines.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "lines_before", "lines_removed", F.sha2("text", 256).alias("kept_sha256"), "text"
    )


@QUERIES.add(warc.SQL)
def op8_warc(spark, sf_dir):
    """All pages written as archives and read back."""
    uri, manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    rows = warc.read_archives(spark, uri, manifest)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@QUERIES.add(mixing.SQL)
def op9_mixing(spark, sf_dir):
    """All documents mixed at one and a half times their size."""
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


@QUERIES.add(quality.sql())
def op10_quality(spark, sf_dir):
    """Counts and verdict of all documents."""
    rows = quality.judge(table(spark, sf_dir, "documents"))
    return rows.drop("character_distance", "word_distance")


@QUERIES.add()
def op11_periods(spark, sf_dir):
    """Periodic runs of words in all documents, some of which are made periodic before."""
    docs = periods.rewritten(table(spark, sf_dir, "documents"))
    return periods.digests(periods.periodic_runs(docs))


@QUERIES.add(prefixes.SQL)
def op12_prefixes(spark, sf_dir):
    """Prefix trie of all conversations, rebuilt to share first turns."""
    return prefixes.rebuilt_trie(table(spark, sf_dir, "conversations"))


@QUERIES.add()
def op13_regions(spark, sf_dir):
    """Main texts of all pages."""
    return regions.main_texts(table(spark, sf_dir, "pages"))
