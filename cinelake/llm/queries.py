"""Queries of the training-data operators, as the driver's tables need them, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cinelake.llm.licenses import scan_licenses

    return scan_licenses(_read(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cinelake.llm.secrets import scan_secrets

    return scan_secrets(_read(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cinelake.llm.decontam import decontaminate

    return decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).drop("key")


def benchmark_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proximity search of the same index."""
    from cinelake.llm.decontam import proximity_matches

    return proximity_matches(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cinelake.llm.linededup import ALL_LINES, dedup_lines

    return dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"), exact_chars=ALL_LINES)


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cinelake.llm.neardup import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cinelake.llm.html import extract_main_text

    return extract_main_text(_read(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cinelake.llm.langid import language_id

    return language_id(_read(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cinelake.llm.mixing import mix_sources

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cinelake.llm.urls import judge_urls

    return judge_urls(_read(spark, sf_dir, "pages"))


def op10_media_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cinelake.llm.media import media_columns

    return media_columns(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_secret_scan, op3_benchmark_decontamination, op4_line_dedup, op5_minhash_near_dedup,
        op6_html_extraction, op7_language_id, op8_source_mixing, op9_url_filter, op10_media_fingerprints, benchmark_proximity,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _url_sql() -> str:
    from cinelake.llm import urls

    letter = r"a-z\x{80}-\x{10FFFF}"

    def count(terms: tuple[str, ...]) -> str:
        return " + ".join(f"regexp_matches(low, '(^|[^{letter}]){t}($|[^{letter}])')::BIGINT" for t in terms)

    def case(value: str) -> str:
        whens = []
        for verdict, host, path in sorted(urls.RULES, key=lambda r: -len(r[1] + r[2])):
            then = host + path if value == "rule" else verdict
            whens.append(f"WHEN (host = '{host}' OR suffix(host, '.{host}')) AND starts_with(path, '{path}') THEN '{then}'")
        return " ".join(whens)

    return f"""WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low FROM pages),
n AS (SELECT *, {count(urls.STRICT)} AS n_strict, {count(urls.SOFT)} AS n_soft FROM p)
SELECT page_id, host, path, n_strict, n_soft, CASE {case("rule")} END AS rule,
  CASE {case("verdict")} WHEN n_strict > 0 OR n_soft >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict FROM n"""


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_CONTAMINATION_SQL = f"""WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, least(13, len(w)) AS n, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM bw),
sizes AS (SELECT DISTINCT n FROM grams), d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN grams ON grams.n = dw.n AND grams.g = array_to_string(w[i:i + dw.n - 1], ' ')),
places AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits),
nh AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY 1),
ni AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN nh ON nh.doc_id = d.doc_id LEFT JOIN ni ON ni.doc_id = d.doc_id"""


def oracle_sql() -> dict[str, str]:
    """The others use hashed draws, trained models, signatures, parsers or media codecs: tests hold them to brute force."""
    return {"op3_benchmark_decontamination": _CONTAMINATION_SQL, "op9_url_filter": _url_sql()}
