"""The registered queries of this subpackage, and SQL where SQL can say the same."""

from __future__ import annotations

import os

from tidemark.llm import (
    alignment,
    decontaminate,
    kneser_ney,
    langid,
    licenses,
    main_text,
    ngram_join,
    periodic_runs,
    pieces,
    quality,
    token_files,
    toxicity,
    warc,
)

# Where the files of public tokenizers are, on every machine.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def vocabulary(name: str) -> str:
    return os.path.join(TOKENIZERS, name)


def _table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_main_text(spark, sf_dir):
    return main_text.extract(_table(spark, sf_dir, "pages"))


def op2_kneser_ney(spark, sf_dir):
    return kneser_ney.lm_scores(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark, sf_dir):
    return ngram_join.classes(_table(spark, sf_dir, "documents"))


def op4_warc(spark, sf_dir):
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op5_license_digests(spark, sf_dir):
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark, sf_dir):
    return quality.quality_report(_table(spark, sf_dir, "documents"))


def op7_pieces(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return pieces.digests(docs, vocabulary("piece_bpe_32k.model"))


def op8_language_mixture(spark, sf_dir):
    return langid.predicted_languages(_table(spark, sf_dir, "documents"))


def op9_token_files(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return token_files.round_trip(docs, vocabulary("byte_bpe_50k.json"))


def op10_benchmark_leaks(spark, sf_dir):
    docs, items = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.leaks(docs, items)


def op11_periodic_runs(spark, sf_dir):
    return periodic_runs.run_report(_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    files = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    return alignment.alignment_report(docs, *files)


def op13_toxicity(spark, sf_dir):
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return toxicity.toxicity(docs, labels)


QUERIES = {
    f.__name__: f
    for f in (
        op1_main_text,
        op2_kneser_ney,
        op3_ngram_jaccard,
        op4_warc,
        op5_license_digests,
        op6_quality_rules,
        op7_pieces,
        op8_language_mixture,
        op9_token_files,
        op10_benchmark_leaks,
        op11_periodic_runs,
        op12_token_alignment,
        op13_toxicity,
    )
}

SQL: dict[str, str] = {
    "op3_ngram_jaccard": ngram_join.sql(),
    "op4_warc": warc.sql(),
    "op5_license_digests": licenses.sql(),
}
