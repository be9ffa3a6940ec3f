"""Queries of the text operators, as registered for the driver; every one runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chain_dedup import repeated_passages
from .decontaminate import find_items
from .filter_audit import audit_filters
from .hamming_join import near_duplicates
from .language_id import held_out, identify_languages, train_languages
from .license_scan import find_notices
from .piece_codec import encode_pieces
from .pitman_yor import score_texts
from .prefix_trie import conversation_trie
from .suffix_dedup import remove_repeats
from .syncmers import fingerprint_edits
from .trie_join import jaccard_components
from .url_filter import judge_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> str:
    """The installed SentencePiece model that query op5 encodes with."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 400-byte strings that occur elsewhere too."""
    kept = remove_repeats(_table(spark, sf_dir, "documents"), 400)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "longest_shared")


def op2_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited copies, and how near these are."""
    return fingerprint_edits(_table(spark, sf_dir, "documents"))


#: Rules of query op3: verdict, and domain with the start of the path.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on the url of every page."""
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document."""
    return find_notices(_table(spark, sf_dir, "documents"))


def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under a model of six sevenths of them."""
    out = held_out("doc_id", 7, 2)
    scored = score_texts(_table(spark, sf_dir, "documents"), ~out)
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; digests of the ids and of the decoded text."""
    coded = encode_pieces(_table(spark, sf_dir, "documents"), piece_model())
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the two folds that aren't held out."""
    docs = _table(spark, sf_dir, "documents")
    out = held_out("doc_id", 3, 1)
    model = train_languages(docs.where(~out))
    return identify_languages(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op7_chain_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat an earlier one, with the document that has it first."""
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents contain."""
    return find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 5-word shingles are similar to 0.75 or more."""
    return jaccard_components(_table(spark, sf_dir, "documents"), k=5, percent=75)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt so that families share their first turns."""
    return conversation_trie(_table(spark, sf_dir, "conversations"))


def op12_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles are similar to 0.8 or more, and the documents that stay."""
    return near_duplicates(_table(spark, sf_dir, "documents"), k=4, percent=80)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters do to the documents of each language in all 120 orders."""
    return audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_suffix_dedup, op2_syncmers, op3_url_filter, op4_pitman_yor, op5_piece_codec, op6_language_id, op7_chain_dedup, op8_license_scan, op9_trie_join, op10_decontaminate, op11_prefix_trie, op12_hamming_join, op13_filter_audit)}

_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _grams(table: str, key: str, k: int = 5) -> str:
    """SQL for the distinct k-word shingles (g) of a table's texts; fewer words make one."""
    words = f"regexp_extract_all(translate(text, '{_AZ}', '{_AZ.lower()}'), '[^\\x20\\x09-\\x0D]+')"
    return f"""(WITH w AS (SELECT {key}, {words} AS t FROM {table} WHERE text IS NOT NULL)
      SELECT DISTINCT {key}, array_to_string(t[i:i + {k - 1}], ' ') AS g FROM (SELECT {key}, t, unnest(range(1, len(t) - {k - 2})) AS i FROM w WHERE len(t) >= {k})
      UNION ALL SELECT {key}, '|' || array_to_string(t, ' ') FROM w WHERE len(t) BETWEEN 1 AND {k - 1})"""


def _linked(k: int, percent: int) -> str:
    """SQL for the components of documents whose sets of k-word shingles are similar to ``percent`` hundredths or more."""
    return f"""WITH RECURSIVE g AS MATERIALIZED (SELECT * FROM {_grams("documents", "doc_id", k)}), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
      c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
      l AS MATERIALIZED (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= {percent} * (na.n + nb.n - c)),
      r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other)
      SELECT doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(other) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY 1"""


ORACLES: dict[str, str] = {
    "op9_trie_join": _linked(5, 75),
    "op12_hamming_join": f"SELECT *, doc_id = component_id AS kept FROM ({_linked(4, 80)})",
    "op10_decontaminate": f"""WITH d AS (SELECT * FROM {_grams("documents", "doc_id")}), b AS (SELECT * FROM {_grams("benchmark", "item_id")}), n AS (SELECT item_id, count(*) AS n FROM b GROUP BY 1)
      SELECT doc_id, item_id, any_value(n) AS n_shingles, count(*) / any_value(n)::DOUBLE AS containment FROM b JOIN d USING (g) JOIN n USING (item_id) GROUP BY 1, 2 HAVING count(*) >= 0.75 * any_value(n)""",
    "op11_prefix_trie": """WITH RECURSIVE t AS MATERIALIZED (
        SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL),
      k AS (SELECT c, c - c % 20 AS base, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, b: list_reduce([xor(a, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 4 AS h FROM (SELECT DISTINCT c FROM t)),
      u AS (SELECT k.c, 0 AS kind, p, role, text FROM k JOIN t ON t.c = k.base AND p < h UNION ALL SELECT k.c, 1, p, role, text FROM k JOIN t ON t.c = k.c AND p >= h),
      d AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY kind, p) AS depth, sha256(role || chr(1) || text) AS s, text FROM u),
      e AS MATERIALIZED (SELECT c, depth, sha256(string_agg(s, '' ORDER BY depth) OVER (PARTITION BY c ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS node, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM d
        UNION ALL SELECT c, 0, '', 0 FROM k),
      n AS MATERIALIZED (SELECT node, min(c) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(words) AS words FROM e GROUP BY 1),
      g AS MATERIALIZED (SELECT n.*, e.node AS parent FROM n LEFT JOIN e ON e.c = n.conv_id AND e.depth = n.depth - 1),
      h AS MATERIALIZED (SELECT g.*, (SELECT count(*) FROM g x WHERE x.parent = g.node) AS n_children FROM g),
      s AS (SELECT e.node, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * h.words) AS saved_tokens FROM h JOIN e ON e.c = h.conv_id AND e.depth <= h.depth GROUP BY 1),
      l AS (SELECT node, string_agg(c::VARCHAR, ',' ORDER BY c) AS ends FROM (SELECT *, max(depth) OVER (PARTITION BY c) AS last FROM e) WHERE depth = last GROUP BY 1)
      SELECT h.conv_id, h.depth, g.conv_id AS parent_conv_id, h.n_convs, h.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
      FROM h JOIN s USING (node) LEFT JOIN l USING (node) LEFT JOIN g ON g.node = h.parent""",
    "op13_filter_audit": """WITH f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
      o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
      w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS t FROM documents),
      m AS (SELECT *, min(doc_id) OVER (PARTITION BY text) AS low FROM w),
      q AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
      b AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, concat(CASE WHEN len(t) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(t)) < 80 * len(t) THEN 'B' END,
        CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * len(text) THEN 'C' END, CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > low THEN 'E' END) AS fails
        FROM m LEFT JOIN q USING (doc_id)),
      c AS (SELECT part, good, toxic, fails, count(*) AS n FROM b GROUP BY ALL),
      s AS (SELECT filter_order, i AS step, filter_order[i] AS x, filter_order[1:i - 1] AS before FROM o, range(1, 6) r(i)),
      j AS (SELECT c.*, filter_order, step, x, contains(fails, x) AS hit, len(regexp_replace(fails, '[' || before || '_]', '', 'g')) < len(fails) AS gone FROM c, s),
      a AS (SELECT part, filter_order, step::INT AS step, any_value(x) AS x, sum(n) FILTER (NOT hit AND NOT gone) AS kept, sum(n) FILTER (hit AND NOT gone) AS removed, sum(n) FILTER (hit AND gone) AS redundant,
        sum(n) FILTER (fails = x) AS unique_fails, sum(n) FILTER (hit AND NOT gone AND good) AS good_lost, sum(n) FILTER (hit AND NOT gone AND toxic) AS toxic_lost FROM j GROUP BY 1, 2, 3)
      SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
        coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, (sum(coalesce(removed, 0)) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM a""",
}
