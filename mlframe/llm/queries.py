"""The registered queries of the corpus operators over the driver tables, and their SQL."""

from __future__ import annotations

from mlframe.llm import decontam, langid, lattice, merkle, mixing, phrases, pieces, pii, quality, simhash, substrings, tokens, warc
from mlframe.llm.common import table


def _over(name, query):
    return lambda spark, sf_dir: query(table(spark, sf_dir, name))


QUERIES = {
    "op1_simhash_near_dedup": _over("documents", simhash.query),
    "op2_source_mixing": _over("documents", mixing.query),
    "op3_warc_round_trip": _over("pages", warc.query),
    "op4_lattice_scores": _over("documents", lattice.query),
    "op5_language_id": _over("documents", langid.query),
    "op6_decontamination": lambda spark, sf_dir: decontam.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op7_quality_rules": _over("documents", quality.query),
    "op8_token_shards": _over("documents", tokens.query),
    "op9_repeated_passages": _over("documents", substrings.query),
    "op10_personal_data": _over("documents", pii.query),
    "op11_merkle_proofs": _over("documents", merkle.query),
    "op12_collocations": _over("documents", phrases.query),
    "op13_sentence_pieces": _over("documents", pieces.query),
}

SQL = {"op2_source_mixing": mixing.SQL, "op3_warc_round_trip": warc.SQL, "op11_merkle_proofs": merkle.SQL,
       "op12_collocations": phrases.SQL}
