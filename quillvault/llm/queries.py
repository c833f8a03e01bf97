"""Registered queries of this package and their equivalent SQL, where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillvault.llm.bpe import encoding_digests
from quillvault.llm.decontaminate import contaminated
from quillvault.llm.embeddings import near_duplicates
from quillvault.llm.licences import licence_scan
from quillvault.llm.phrases import collocations
from quillvault.llm.pieces import piece_digests
from quillvault.llm.pii import personal_data
from quillvault.llm.quality import quality_scores
from quillvault.llm.repeats import remove_repeats
from quillvault.llm.simhash import near_copies
from quillvault.llm.tables import read as read_table
from quillvault.llm.tables import session_for_texts
from quillvault.llm.token_counts import count_tokens
from quillvault.llm.vector_codes import vector_codes
from quillvault.llm.warc import archived


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(session_for_texts(spark), sf_dir, name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(read(spark, sf_dir, "documents"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(read(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(spark, read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP4_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
     f AS (SELECT payload_digest, min(page_id) AS first_id FROM p
           WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        words=400_000,  # nothing else is in the workers' memory
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512
    )


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read(spark, sf_dir, "documents"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"), least=10, explained=50, most=2000)


OP11_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
runs AS (
  SELECT lang, unnest(list_concat(
           w,
           list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
           list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
         )) AS phrase
  FROM words),
f AS MATERIALIZED (
  SELECT lang, phrase, lang || chr(9) || phrase AS named, string_split(phrase, ' ') AS w,
         count(*) AS f
  FROM runs GROUP BY lang, phrase),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(w) = 1 GROUP BY lang),
candidate AS MATERIALIZED (SELECT * FROM f WHERE f >= 10 AND len(w) > 1),
cut AS (
  SELECT c.lang, c.phrase, c.f AS a, k,
         lang || chr(9) || array_to_string(c.w[1:k], ' ') AS first_part,
         lang || chr(9) || array_to_string(c.w[k + 1:], ' ') AS rest
  FROM candidate c, range(1, 3) t(k) WHERE k < len(c.w)),
scored AS (
  SELECT cut.*, p.f AS l, q.f AS r,
         ((1000000::HUGEINT * a * a) // (p.f::HUGEINT * q.f))::BIGINT AS score
  FROM cut JOIN f p ON p.named = first_part JOIN f q ON q.named = rest),
weakest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, part, max(f) AS longer FROM (
    SELECT lang, f, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part
    FROM candidate WHERE len(w) = 3) GROUP BY lang, part),
kept AS (
  SELECT s.* FROM weakest s LEFT JOIN inside i ON i.lang = s.lang AND i.part = s.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * s.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(read(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4)


def _op12_sql(rounds: int = 4) -> str:
    """Codebooks by position (p, e, i, x) and one pair of tables a round."""
    nearest = """
near{k} AS MATERIALIZED (
  SELECT vec_id, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT v.vec_id, v.p, b.e, list_sum(list_transform(list_zip(v.part, b.part),
             lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM vec v JOIN book{k} b USING (p)) GROUP BY vec_id, p)"""
    moved = """
book{n} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.part, b.part) AS part
  FROM book{k} b LEFT JOIN (
    SELECT p, e, list(x ORDER BY i) AS part FROM (
      SELECT p, e, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
      FROM near{k} JOIN (SELECT vec_id, p, unnest(part) AS x, generate_subscripts(part, 1) AS i
                         FROM vec) USING (vec_id, p)
      GROUP BY p, e, i) GROUP BY p, e) m USING (p, e))"""
    steps = [(nearest + "," + moved).format(k=k, n=k + 1) for k in range(rounds)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
vec AS MATERIALIZED (
  SELECT vec_id, p, w[p * (len(w) // 4) + 1 : (p + 1) * (len(w) // 4)] AS part
  FROM kept, range(4) t(p)),
book0 AS MATERIALIZED (
  SELECT p, e, part FROM vec JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept
    ORDER BY vec_id LIMIT 256) USING (vec_id)),
{",".join(steps)},
{nearest.format(k=rounds)},
coded AS (
  SELECT vec_id, string_agg(lower(printf('%02x', e::INT)), '' ORDER BY p) AS code,
         sum(d)::BIGINT AS error
  FROM near{rounds} GROUP BY vec_id),
digest AS (
  SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, e)) AS codebooks_sha256
  FROM book{rounds})
SELECT vec_id, code, error,
       (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
"""


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(
        read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), words=400_000
    )


#: name -> (query, equivalent SQL or None)
QUERIES = {
    "op1_quality": (op1_quality, None),
    "op2_simhash": (op2_simhash, None),
    "op3_licences": (op3_licences, None),
    "op4_warc": (op4_warc, OP4_SQL),
    "op5_bpe_codec": (op5_bpe_codec, None),
    "op6_decontamination": (op6_decontamination, None),
    "op7_embeddings": (op7_embeddings, None),
    "op8_token_counts": (op8_token_counts, None),
    "op9_personal_data": (op9_personal_data, None),
    "op10_repeats": (op10_repeats, None),
    "op11_collocations": (op11_collocations, OP11_SQL),
    "op12_vector_codes": (op12_vector_codes, _op12_sql()),
    "op13_pieces": (op13_pieces, None),
}
