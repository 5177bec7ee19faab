"""One query per operator, on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareloom.llm.common import documents
from fareloom.llm.context_mixing import scores
from fareloom.llm.jaccard_join import jaccard_components
from fareloom.llm.labelled import labelled_sample
from fareloom.llm.lexical_search import ranked_search
from fareloom.llm.oracle import ORACLE
from fareloom.llm.packing import pack
from fareloom.llm.piece_sampling import decoded, encode_sampled
from fareloom.llm.repetition import repetition_coverage
from fareloom.llm.site_quality import fit_quality, quality
from fareloom.llm.spelling import spelling_variants
from fareloom.llm.token_counts import token_counts
from fareloom.llm.token_files import read_token_files, write_token_files
from fareloom.llm.topk_search import top_k
from fareloom.llm.toxicity import fit_severity, severity
from fareloom.llm.warc_revisits import resolve_revisits, visits
from fareloom.session import scratch_path


def op1_token_counts(spark, sf_dir):
    return token_counts(documents(spark, sf_dir))


def op2_repetition_coverage(spark, sf_dir):
    return repetition_coverage(documents(spark, sf_dir))


def op3_site_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    sample = labelled_sample(docs, documents(spark, sf_dir, "labels"), "quality")
    return quality(docs, fit_quality(sample))


def op4_piece_sampling(spark, sf_dir):
    """Digest of the drawn segmentations and whether they decode to the text."""
    rows = decoded(encode_sampled(documents(spark, sf_dir)))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "ids_crc32",
        "log_prob",
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


def op5_context_mixing(spark, sf_dir):
    return scores(documents(spark, sf_dir))


def op6_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir))


def op7_exact_topk(spark, sf_dir):
    return top_k(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op8_jaccard_join(spark, sf_dir):
    return jaccard_components(documents(spark, sf_dir))


def op9_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    sample = labelled_sample(docs, documents(spark, sf_dir, "labels"), "toxic")
    return severity(docs, fit_severity(sample))


def op10_warc_revisits(spark, sf_dir):
    """Every revisit of a crawl of ``pages``; header maps as one column per header."""
    found = resolve_revisits(visits(documents(spark, sf_dir, "pages")))
    names = ("etag", "last-modified", "date", "expires", "content-type")
    return found.select(
        "record_id",
        "url",
        "fetched_at",
        "response_id",
        "status",
        "digest",
        *(F.col("headers")[n].alias(n.replace("-", "_")) for n in names),
    )


def op11_spelling_variants(spark, sf_dir):
    return spelling_variants(documents(spark, sf_dir))


def op12_token_files(spark, sf_dir):
    """Digest of all documents, from the files that were written."""
    path = scratch_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path)
    return read_token_files(spark, path, "digest")


def op13_ranked_search(spark, sf_dir):
    return ranked_search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_repetition_coverage": op2_repetition_coverage,
    "op3_site_quality": op3_site_quality,
    "op4_piece_sampling": op4_piece_sampling,
    "op5_context_mixing": op5_context_mixing,
    "op6_packing": op6_packing,
    "op7_exact_topk": op7_exact_topk,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_toxicity": op9_toxicity,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_files": op12_token_files,
    "op13_ranked_search": op13_ranked_search,
}

__all__ = ["ORACLE", "QUERIES"]
