"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import contamination
from .exact_dedup import exact_duplicates
from .html_text import extract_text
from .lexical_search import search
from .license_scan import COPYRIGHT_LINE, GAPS, KNOWN, MARKS, SPELLINGS, scan_licenses
from .lm import score_texts
from .mixing import mix
from .near_dedup import near_duplicates
from .quality import fold, quality_model, with_quality
from .spelling_variants import spelling_variants
from .token_counts import token_counts
from .toxicity import toxicity_model, with_toxicity
from .url_filter import judge_urls


def _scored(docs: DataFrame, held_out: Column) -> DataFrame:
    return docs.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(docs, table(spark, sf_dir, "labels"), usable=fold(F.col("id"), 3) != 1)
    return _scored(with_quality(docs, model), fold(F.col("doc_id"), 3) == 1)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity_model(docs, table(spark, sf_dir, "labels"), usable=fold(F.col("id"), 5) != 0)
    return _scored(with_toxicity(docs, lexicon), fold(F.col("doc_id"), 5) == 0)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = extract_text(table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("bigint"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words to take of each document so that sources meet their targets."""
    return mix(table(spark, sf_dir, "documents"))


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 1
    scored = score_texts(docs, training=~held_out)
    return scored.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences in every document."""
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("licenses").cast("bigint").alias("n_licenses"),
        F.concat_ws(",", "licenses").alias("licenses"),
        F.col("whole").alias("whole_text"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in each document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("key")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts and the row of each that stays."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL."""
    return judge_urls(table(spark, sf_dir, "pages"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text, and how much of it fits into 2048 tokens."""
    counted = token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), budgets=(LIMIT,))
    return counted.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
        F.col(f"fit_{LIMIT}").alias("fit_chars"),
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, their near words, forms and roots over all documents."""
    return spelling_variants(table(spark, sf_dir, "documents"))


#: The token limit of op11.
LIMIT = 2048


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_toxicity,
        op3_html_text,
        op4_mixing,
        op5_lm_scores,
        op6_license_scan,
        op7_decontamination,
        op8_near_dedup,
        op9_exact_dedup,
        op10_url_filter,
        op11_token_counts,
        op12_lexical_search,
        op13_spelling_variants,
    )
}

ORACLES = {
    "op4_mixing": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [3.0, 1.0, 2.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)]::DOUBLE AS wt,
         source_size * 2.0::DOUBLE AS most, sum(source_size) OVER () * 1.5::DOUBLE AS total
  FROM s
), f AS (
  SELECT *, (total - coalesce(sum(most) OVER (ORDER BY most / wt, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(wt) OVER (ORDER BY most / wt, source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), t AS (
  SELECT source, source_size, least(most, wt * coalesce(
           (SELECT arg_min(level, most / wt) FROM f WHERE most / wt >= level), 1e308)) AS target
  FROM f
), r AS (
  SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM r
)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM e
""",
    "op7_decontamination": r"""
WITH iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item, w[s : s + 9] AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM iw WHERE len(w) > 0)
), dw AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), lens AS (SELECT DISTINCT len(win) AS n FROM win),
firsts AS (SELECT DISTINCT win[1] AS first FROM win),
dp AS (
  SELECT k, s, w[s] AS first FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS s FROM dw)
), cand AS (
  SELECT dp.k, dp.s, lens.n, dw.w[dp.s : dp.s + lens.n - 1] AS win
  FROM dp SEMI JOIN firsts ON dp.first = firsts.first
  JOIN dw ON dw.k = dp.k CROSS JOIN lens
  WHERE dp.s + lens.n - 1 <= len(dw.w)
), hit AS (
  SELECT k, s, n, item FROM cand JOIN win ON cand.win = win.win
), cov AS (
  SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(s, s + n)) AS p FROM hit) GROUP BY k
), its AS (
  SELECT k, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (k) LEFT JOIN its USING (k)
""",
    "op9_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
""",
}


def _license_sql() -> str:
    """The licence scan in SQL, from the same fixed values."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    lines = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    lines = f"regexp_replace({lines}, {quoted(COPYRIGHT_LINE)}, '', 'g')"
    for other, one in SPELLINGS:
        lines = f"replace({lines}, {quoted(other)}, {quoted(one)})"
    lines = f"regexp_replace({lines}, {quoted(MARKS)}, ' ', 'g')"
    known = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in KNOWN)
    return rf"""
WITH k AS (
  SELECT DISTINCT name, trim(regexp_replace({lines}, '[ \n]+', ' ', 'g')) AS unit FROM (VALUES {known}) AS v(name, text)
), d AS (
  SELECT row_number() OVER () AS id, doc_id, {lines} AS lines FROM documents
), u AS (
  SELECT id, true AS whole, trim(regexp_replace(lines, '[ \n]+', ' ', 'g')) AS unit FROM d
  UNION ALL
  SELECT id, false, trim(regexp_replace(unnest(regexp_split_to_array(lines, '{GAPS}')), '[ \n]+', ' ', 'g')) FROM d
  UNION ALL
  SELECT id, false, trim(unnest(regexp_split_to_array(lines, '\n'))) FROM d
), h AS (
  SELECT id, count(DISTINCT name) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names, bool_or(whole) AS whole
  FROM u JOIN k USING (unit) WHERE unit <> '' GROUP BY id
)
SELECT doc_id, coalesce(n, 0) AS n_licenses, coalesce(names, '') AS licenses, coalesce(whole, false) AS whole_text
FROM d LEFT JOIN h USING (id)
"""


ORACLES["op6_license_scan"] = _license_sql()

_TERMS = r"regexp_extract_all(translate(coalesce({col}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES["op12_lexical_search"] = f"""
WITH d AS (
  SELECT doc_id, {_TERMS.format(col='text')} AS t FROM documents
), g AS (
  SELECT count(*) FILTER (WHERE len(t) > 0) AS nn, CAST(sum(len(t)) AS BIGINT) AS ll FROM d
), tf AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY doc_id, n, term
), q AS (
  SELECT DISTINCT item_id, unnest({_TERMS.format(col='text')}) AS term FROM benchmark
), df AS (
  SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM q) GROUP BY term
), w AS (
  SELECT q.item_id, q.term, CAST(floor(1000.0 * ln((2.0 * nn + 2.0) / (2.0 * df + 1.0))) AS BIGINT) AS w
  FROM q JOIN df USING (term), g
), s AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll)))) AS BIGINT) AS score
  FROM w JOIN tf USING (term), g GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0
) WHERE rank <= 10
"""
