"""The queries of this package's operators, each over its whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shardloom.llm import cooccurrence, leakage, packing, pairs, repetition, residue, termstats, tokenise, truncation
from shardloom.sources import table

Query = Callable[[SparkSession, str], DataFrame]

_TAG = """CASE WHEN length(t) > 3 THEN regexp_replace(replace(t, '_', ' '), ' +', ' ', 'g') ELSE t END"""
_USED = f"""used AS (
  SELECT repo, item, {_TAG} AS tag FROM (SELECT repo, item, lower(trim(unnest(tags), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(32) || chr(160) || chr(12288))) AS t FROM item_tags)
  WHERE t IS NOT NULL AND t <> '' AND {_TAG} <> ' '),
held AS (SELECT DISTINCT repo, item, tag FROM used),
total AS (SELECT count(*)::BIGINT AS n FROM (SELECT DISTINCT repo, item FROM held)),
single AS (SELECT tag, count(*)::BIGINT AS n FROM held GROUP BY tag),
pair AS (
  SELECT a.tag AS tag_a, b.tag AS tag_b, count(*)::BIGINT AS n_ab
  FROM held a JOIN held b ON a.repo IS NOT DISTINCT FROM b.repo AND a.item IS NOT DISTINCT FROM b.item AND a.tag < b.tag GROUP BY ALL)"""


def _plain(path: str) -> str:
    """SQL of a path's plain segments; a '..' removes the segment before it, up to eight in a row."""
    out = f"'/' || array_to_string(list_filter(string_split(replace(nfc_normalize({path}), '\\', '/'), '/'), lambda s: s <> '' AND s <> '.'), '/')"
    for _ in range(8):
        out = f"regexp_replace({out}, '/([^/.][^/]*|\\.[^/.][^/]*|\\.\\.[^/]+)/\\.\\.(/|$)', '\\2')"
    return out


_KANA = "\\x{3040}-\\x{30FF}\\x{3400}-\\x{9FFF}々"
_REPEATED = f"""w AS (
  SELECT caption_id, regexp_extract_all(regexp_replace(lower(coalesce(caption, '')), '([{_KANA}])', ' \\1 ', 'g'), '[{_KANA}]|[\\p{{L}}\\p{{N}}]+') AS ws FROM caption),
g AS (SELECT caption_id, unnest(list_transform(range(1, len(ws) - 2), lambda i: {{'i': i, 'g': array_to_string(ws[i:i + 3], chr(0))}})) AS x FROM w WHERE len(ws) >= 4),
r AS (SELECT caption_id, x.i AS i FROM g QUALIFY row_number() OVER (PARTITION BY caption_id, x.g ORDER BY x.i) > 1),
c AS (SELECT caption_id, count(DISTINCT p) AS repeated FROM (SELECT caption_id, unnest([i, i + 1, i + 2, i + 3]) AS p FROM r) GROUP BY caption_id)"""


def queries() -> dict[str, Query]:
    """Name to query."""
    return {
        "p1_found": lambda s, d: cooccurrence.companions(table(s, d, "item_tags")),
        "p1_pairs": lambda s, d: cooccurrence.pair_counts(table(s, d, "item_tags")).drop("conviction"),
        "p1_conviction": lambda s, d: cooccurrence.pair_counts(table(s, d, "item_tags"), 5, 500).select("tag_a", "tag_b", "n_ab", "conviction"),
        "p2_found": lambda s, d: repetition.repetitive(table(s, d, "caption"), table(s, d, "eval_item")),
        "p2_shares": lambda s, d: repetition.repetition(table(s, d, "caption"), table(s, d, "eval_item")).select("caption_id", "words", "repeated", "share"),
        "p4_found": lambda s, d: pairs.defects(table(s, d, "caption"), table(s, d, "request_map")),
        "p4_counts": lambda s, d: pairs.defect_counts(table(s, d, "caption"), table(s, d, "request_map")),
        "p5_found": lambda s, d: packing.oversized(table(s, d, "packing_input")),
        "p5_shards": lambda s, d: packing.pack(table(s, d, "packing_input")),
        "p5_fill": lambda s, d: packing.shard_fill(table(s, d, "packing_input")),
        "p6_found": lambda s, d: termstats.term_counts(table(s, d, "item_tags")).where("mark is not null").select("tag", "mark"),
        "p6_terms": lambda s, d: termstats.term_counts(table(s, d, "item_tags")),
        "p7_found": lambda s, d: truncation.truncated(table(s, d, "caption"), table(s, d, "request_map")),
        "p7_rates": lambda s, d: truncation.truncation_rates(table(s, d, "caption"), table(s, d, "request_map"), table(s, d, "batch_state")),
        "p8_ids": lambda s, d: tokenise.encode_corpus(table(s, d, "documents")),
        "p8_decoded": lambda s, d: tokenise.decode_corpus(tokenise.encode_corpus(table(s, d, "documents"))),
        "p9_found": lambda s, d: leakage.leaks(table(s, d, "documents"), table(s, d, "eval_item")).select("doc_id", "item_id"),
        "p9_items": lambda s, d: leakage.leaked_items(table(s, d, "documents"), table(s, d, "eval_item")),
        "p10_found": lambda s, d: residue.excluded(table(s, d, "documents")),
        "p10_residue": lambda s, d: residue.residues(table(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    """The same in SQL where SQL can say it."""
    return {
        "p1_found": f"""WITH {_USED} SELECT tag_a, tag_b FROM pair JOIN single a ON tag_a = a.tag JOIN single b ON tag_b = b.tag, total
            WHERE n_ab >= 5 AND n_ab * 500 >= total.n AND n_ab * total.n >= 4 * a.n * b.n""",
        "p1_pairs": f"""WITH {_USED} SELECT tag_a, tag_b, a.n AS n_a, b.n AS n_b, n_ab, total.n AS n, (n_ab * total.n)::DOUBLE / (a.n * b.n) AS lift
            FROM pair JOIN single a ON tag_a = a.tag JOIN single b ON tag_b = b.tag, total""",
        "p1_conviction": f"""WITH {_USED} SELECT tag_a, tag_b, n_ab, (1 - b.n::DOUBLE / total.n) / nullif(1 - n_ab::DOUBLE / a.n, 0) AS conviction
            FROM pair JOIN single a ON tag_a = a.tag JOIN single b ON tag_b = b.tag, total WHERE n_ab >= 5 AND n_ab * 500 >= total.n""",
        "p2_found": f"WITH {_REPEATED} SELECT caption_id FROM c JOIN w USING (caption_id) WHERE len(ws) >= 12 AND repeated * 100 >= 40 * len(ws)",
        "p2_shares": f"""WITH {_REPEATED} SELECT caption_id, len(ws)::INT AS words, coalesce(repeated, 0)::INT AS repeated,
            CASE WHEN len(ws) > 0 THEN coalesce(repeated, 0)::DOUBLE / len(ws) ELSE 0 END::DOUBLE AS share FROM w LEFT JOIN c USING (caption_id)""",
        "p5_found": f"""WITH e AS (SELECT repo, substr({_plain("rel")}, 2) AS rel, size, listed_at FROM packing_input WHERE rel IS NOT NULL),
            n AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY repo, rel ORDER BY listed_at DESC NULLS LAST, size DESC NULLS LAST) = 1)
            SELECT repo, rel FROM n WHERE size > 268435456""",
        "p6_found": f"""WITH {_USED} SELECT tag, CASE WHEN single.n < 3 THEN 'rare' ELSE 'common' END AS mark FROM single, total
            WHERE single.n < 3 OR single.n * 10 > 3 * total.n""",
        "p6_terms": f"""WITH {_USED} SELECT tag, uses, single.n AS items, total.n AS n, CASE WHEN single.n < 3 THEN 'rare' WHEN single.n * 10 > 3 * total.n THEN 'common' END AS mark
            FROM single JOIN (SELECT tag, count(*)::BIGINT AS uses FROM used GROUP BY tag) USING (tag), total""",
        "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    }
