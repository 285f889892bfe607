"""The corpus operators as named queries over whole tables, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headgate.llm.decontaminate import contamination
from headgate.llm.language import identify
from headgate.llm.lattice import score
from headgate.llm.licences import scan
from headgate.llm.mainpage import extract
from headgate.llm.mixing import domain_labels, mix
from headgate.llm.permutation import nearest_neighbours
from headgate.llm.personal import find_personal
from headgate.llm.repair import damage, repair, reports
from headgate.llm.repeats import without_repeats
from headgate.llm.resample import resample
from headgate.llm.simhash import near_duplicates
from headgate.llm.tables import read
from headgate.llm.warc import archived

Query = Callable[[SparkSession, str], DataFrame]


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP1_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(ws, s, s + size - 1), ' ') AS key
  FROM (SELECT item_id, ws, least(len(ws), 13) AS size, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS s FROM b WHERE len(ws) > 0)
), places AS (
  SELECT doc_id, s, size, array_to_string(list_slice(ws, s, s + size - 1), ' ') AS key
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS s
        FROM w, (SELECT DISTINCT size FROM win) WHERE len(ws) >= size)
), found AS (
  SELECT DISTINCT doc_id, s, p.size, item_id FROM places p JOIN win USING (key)
), hits AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + size)) AS pos FROM (SELECT DISTINCT doc_id, s, size FROM found)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM found GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(read(spark, sf_dir, "pages"))


OP2_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, html,
         array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + CAST((CAST('0x' || substr(hex, CAST(1 + 5 * i AS INT), 5) AS BIGINT) // power(2, s)::BIGINT) % 32 AS INT), 1)), '')), '') AS payload_digest
  FROM p
), f AS (
  SELECT html, min(page_id) AS first FROM p GROUP BY html
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d JOIN f USING (html)
"""


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op4_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"))


def op5_mix_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"), domain_labels(read(spark, sf_dir, "labels")))


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files of a tree: a folder per source, one per language below it."""
    documents = read(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.col("doc_id").cast("string"))
    return scan(documents.select(path.alias("path"), "text"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read(spark, sf_dir, "embeddings"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal(read(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    return reports(repair(damage(conversations)), conversations)


def _edited(candidates: list[tuple[str, int, str, str]]) -> str:
    """SQL of the least of some audits, each an audit so far, a cost to add, a letter and the turn that it leaves.

    An audit is one text, compared as such: nine digits of cost, the letters, a mark, the turns.
    """
    cells = [f"CASE WHEN {when} THEN lpad(CAST(CAST(substr({x}, 1, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || substr({x}, 10, strpos({x}, chr(1)) - 10) || '{letter}' || substr({x}, strpos({x}, chr(1))) || {turn} END"
             if letter else x for x, cost, letter, turn, when in ((*c, "true") if len(c) == 4 else c for c in candidates)]  # fmt: skip
    return f"list_min([{', '.join(cells)}])"


def _inserted(rows: str) -> str:
    """SQL of audits `n, s, u, a` (states nothing, system, user, assistant) after the inserts that may follow them."""
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    first = _edited([("u", 0, "", ""), *((x, 3, "I", user) for x in ("n", "s", "a"))])
    second = _edited([("a", 0, "", ""), ("u", 3, "I", assistant)])
    third = _edited([("u", 0, "", ""), ("a", 3, "I", user)])
    return f"SELECT * REPLACE ({third} AS u) FROM (SELECT * REPLACE ({second} AS a) FROM (SELECT * REPLACE ({first} AS u) FROM ({rows})))"


_SAID = "chr(10) || role || ':' || text"
_STAYS = "coalesce(fault, '') NOT IN ('b', 'd')"
_SHORT = "CASE WHEN fault = 't' THEN 3 ELSE 0 END"


def _rerole(x: str, role: str) -> tuple:
    return (x, f"3 + {_SHORT}", "R", f"chr(10) || '{role}:' || text", _STAYS)


def _keep(x: str, initial: str) -> tuple:
    return (x, _SHORT, "K", _SAID, f"{_STAYS} AND left(role, 1) = '{initial}'")


OP11_SQL = rf"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i, range(0, 8)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')) AS key
  FROM conversations
), m AS (
  SELECT k.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, CAST(octet_length(key) AS BIGINT)),
                    lambda i: CAST('0x' || substr(hex(key), CAST(1 + 2 * i AS INT), 2) AS BIGINT))),
                lambda c, x: xor(c >> 8, crc[xor(c % 256, x) + 1])), 4294967295) % 20 AS kind
  FROM k, tab
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM m
), placed AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM damaged
), f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN NOT regexp_matches(text, '[.!?][ 	-]*\z') THEN 't' END AS fault,
         left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair
  FROM placed
), walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000000' || chr(1) AS n, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a
  FROM f WHERE f.i = 1
  UNION ALL
  SELECT conv_id, i,
         {_edited([("n", 4, "D", "''")])} AS n,
         {_edited([("s", 4, "D", "''"), _keep("n", "s")])} AS s,
         {_edited([("u", 4, "D", "''"), *(_keep(x, "u") for x in "nsa"), *(_rerole(x, "user") for x in "nsa")])} AS u,
         {_edited([("a", 4, "D", "''"), _keep("u", "a"), _rerole("u", "assistant")])} AS a
  FROM ({_inserted("SELECT w.conv_id, f.i, w.n, w.s, w.u, w.a, f.role, f.text, f.fault FROM walk w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1")})
), ended AS (
  SELECT conv_id, least(n, a) AS best FROM ({_inserted("SELECT w.* FROM walk w JOIN (SELECT conv_id, max(i) AS i FROM f GROUP BY conv_id) z ON z.conv_id IS NOT DISTINCT FROM w.conv_id AND z.i = w.i")})
), told AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id
)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(substr(best, 1, 9), '0') AS BIGINT) AS cost, coalesce(substr(best, 10, strpos(best, chr(1)) - 10), '') AS audit,
       sha256(coalesce(substr(best, strpos(best, chr(1)) + 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH tab AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i, range(0, 8)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), dw AS (
  SELECT doc_id, unnest(ws) AS w FROM d
), bw AS (
  SELECT unnest(ws) AS w FROM b
), hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, CAST(octet_length(encode(w)) AS BIGINT)),
                  lambda i: CAST('0x' || substr(hex(encode(w)), CAST(1 + 2 * i AS INT), 2) AS BIGINT))),
              lambda c, x: xor(c >> 8, crc[xor(c % 256, x) + 1])), 4294967295) % 10000 AS k
  FROM (SELECT w FROM dw UNION SELECT w FROM bw), tab
), s AS (
  SELECT k, count(*) AS n FROM dw JOIN hashed USING (w) GROUP BY k
), t AS (
  SELECT k, count(*) AS n FROM bw JOIN hashed USING (w) GROUP BY k
), gain AS (
  SELECT k, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1) * CAST((SELECT count(*) FROM dw) + 10000 AS DOUBLE)
                             / ((s.n + 1) * CAST((SELECT count(*) FROM bw) + 10000 AS DOUBLE)))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (k)
), weighed AS (
  SELECT doc_id, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight FROM dw JOIN hashed USING (w) JOIN gain USING (k) GROUP BY doc_id
), scored AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weighed USING (doc_id)
), drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM drawn) * 10 // 100 THEN rank END AS rank
FROM scored s LEFT JOIN drawn USING (doc_id)
"""


QUERIES: dict[str, Query] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_warc_archive": op2_warc_archive,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_lattice_scores": op4_lattice_scores,
    "op5_mix_to_targets": op5_mix_to_targets,
    "op6_licence_scan": op6_licence_scan,
    "op7_language_id": op7_language_id,
    "op8_permutation_index": op8_permutation_index,
    "op9_personal_data": op9_personal_data,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_main_text": op12_main_text,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE_SQL: dict[str, str] = {
    "op1_benchmark_decontamination": OP1_SQL,
    "op2_warc_archive": OP2_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op13_importance_resampling": OP13_SQL,
}
