"""Queries of the operators with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import bpe, linededup, minhash, negatives, neighbours, packing, quality, sharding, spelling, suffixes, tokenids, topk, toxicity
from tickloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": lambda s, d: minhash.near_duplicates(table(s, d, "documents")),
    "op2_token_ids": lambda s, d: tokenids.round_trip(table(s, d, "documents")),
    "op3_repeats": lambda s, d: suffixes.digest(table(s, d, "documents")),
    "op4_sharding": lambda s, d: sharding.place(table(s, d, "documents")),
    "op5_toxicity": lambda s, d: toxicity.classify(table(s, d, "documents"), table(s, d, "labels")),
    "op6_line_dedup": lambda s, d: linededup.report(table(s, d, "documents")),
    "op7_neighbours": lambda s, d: neighbours.search(table(s, d, "embeddings"), F.col("vec_id") % 50 == 0),
    "op8_byte_bpe": lambda s, d: bpe.encode_documents(table(s, d, "documents")),
    "op9_quality": lambda s, d: quality.judge(table(s, d, "documents")),
    "op10_packing": lambda s, d: packing.pack(table(s, d, "documents")).drop("ids"),
    "op11_exact_top_k": lambda s, d: topk.search(table(s, d, "embeddings"), F.col("vec_id") % 50 == 0),
    "op12_hard_negatives": lambda s, d: negatives.mine(table(s, d, "embeddings"), F.col("vec_id") % 100 == 0, label=F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))),
    "op13_spelling_variants": lambda s, d: spelling.group_spellings(table(s, d, "documents"), typo_every=97),
}

_INTEGERS = """
    v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS g
        FROM embeddings WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    )"""

ORACLES: dict[str, str] = {
    "op11_exact_top_k": f"""
        WITH {_INTEGERS},
        pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.g, c.g) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
        ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs)
        SELECT * FROM ranked WHERE rank <= 5""",
    "op12_hard_negatives": f"""
        WITH {_INTEGERS},
        pairs AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.g, c.g) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id WHERE a.label IS NOT NULL AND c.label IS NOT NULL
        ),
        positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        ranked AS (
            SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
            FROM positives JOIN pairs USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        )
        SELECT * FROM ranked WHERE rank <= 10""",
}
