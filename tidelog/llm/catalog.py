"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import (
    alignment,
    bpe,
    decontaminate,
    embedding,
    jaccard,
    language_id,
    language_model,
    lexical,
    preference,
    token_counts,
    toxicity,
    url_filter,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, normalised and read back."""
    return warc.round_trip(spark, _table(spark, sf_dir, "pages")).drop("url")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded again."""
    coded = bpe.encode(_table(spark, sf_dir, "documents"), ["doc_id"], decode_too=True)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under a shingle similarity of 0.9."""
    return jaccard.jaccard_components(spark, _table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark text in every whole document."""
    found = decontaminate.contamination(
        spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def _joined_spans(spans: str):
    parts = F.transform(spans, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string")))
    return F.array_join(parts, ",").alias(spans)


def op5_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with another last answer."""
    convs = preference.conversations(_table(spark, sf_dir, "conversations"))
    pairs = preference.format_pairs(preference.swapped_answers(convs))
    return pairs.select(
        "pair_id",
        "prompt_turns",
        "prompt",
        "chosen",
        "rejected",
        _joined_spans("chosen_spans"),
        _joined_spans("rejected_spans"),
        "tied",
    )


def op6_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every whole document."""
    return language_model.score_documents(spark, _table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


# the rules that the query is asked for: (host, path, verdict)
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url, by rule or else by its path template."""
    judged = url_filter.judge_urls(spark, _table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at a cosine of 0.95."""
    return embedding.embedding_components(spark, _table(spark, sf_dir, "embeddings"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every whole document; a token across lines belongs to the first of them."""
    counted = token_counts.section_token_counts(_table(spark, sf_dir, "documents"), ["doc_id"], ["text"], "start")
    return counted.select(
        "doc_id", "section", "first_char", "end_char", F.col("n_tokens").cast("long").alias("n_tokens")
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole document."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return toxicity.judge(spark, docs, labels).select("doc_id", "held_out", "score", "predicted")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item."""
    return lexical.ranked_search(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document."""
    told = language_id.identify(spark, _table(spark, sf_dir, "documents"))
    return told.select("doc_id", "held_out", "lang_pred", "score")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers on every whole document."""
    return alignment.align_documents(spark, _table(spark, sf_dir, "documents"))[0]


QUERIES = {
    "op1_warc": op1_warc,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_decontamination": op4_decontamination,
    "op5_preference_pairs": op5_preference_pairs,
    "op6_recurrent_lm": op6_recurrent_lm,
    "op7_url_filter": op7_url_filter,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": op10_toxicity,
    "op11_lexical_search": op11_lexical_search,
    "op12_language_id": op12_language_id,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

# words as in the operator: ASCII letters lowered, other ASCII but digits separates
DECONTAMINATION_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS t
    FROM b, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS u(s) WHERE len(w) > 0
), occ AS (
    SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS t
    FROM d, (SELECT DISTINCT size FROM win), unnest(range(1, len(w) - size + 2)) AS u(s)
), hit AS (
    SELECT DISTINCT doc_id, p FROM occ SEMI JOIN win USING (size, t), unnest(range(s, s + size)) AS u(p)
), items AS (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ JOIN win USING (size, t)
), listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM items GROUP BY doc_id
), counted AS (SELECT doc_id, count(*) AS n_hit FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN listed USING (doc_id)
"""



def _merge_sql() -> str:
    """Siblings from the leaves up, five segments deep; groups settle in fewer than eight rounds on the given tables."""
    out = """merged7 AS MATERIALIZED (
        SELECT host, template, string_split(template || '/', '/') AS steps, template AS branch,
            sum(labels)::DOUBLE AS labels, sum(blocked)::DOUBLE AS blocked FROM grown5 GROUP BY host, template
    )"""
    for depth in range(7, 1, -1):
        out += f""", kids{depth} AS (
            SELECT host, steps[1:{depth - 1}] AS node, steps[1:{depth}] AS kid, min(branch) AS branch,
                sum(labels) AS labels, sum(blocked) AS blocked, '' AS mark
            FROM merged{depth} WHERE len(steps) >= {depth} GROUP BY ALL HAVING min(branch) = max(branch)
        )"""
        groups = f"SELECT * FROM kids{depth}"
        for _ in range(8):
            groups = f"""SELECT host, node, kid, branch, labels, blocked, mark || CASE
                WHEN (blocked * (n - labels) - (b - blocked) * labels) ** 2 * n <= 3.84::DOUBLE * labels * (n - labels) * b * (n - b)
                THEN '0' WHEN blocked * n > b * labels THEN '+' ELSE '-' END AS mark
                FROM (SELECT *, sum(labels) OVER g AS n, sum(blocked) OVER g AS b FROM ({groups})
                    WINDOW g AS (PARTITION BY host, node, mark))"""
        out += f""", groups{depth} AS (
            SELECT host, kid, min(branch) OVER (PARTITION BY host, node, mark) AS least FROM ({groups})
        ), merged{depth - 1} AS MATERIALIZED (
            SELECT m.host, template, steps, coalesce(least, branch) AS branch, labels, blocked
            FROM merged{depth} m LEFT JOIN groups{depth} g ON m.host = g.host AND m.steps[1:{depth}] = g.kid
        )"""
    return out


def _url_sql() -> str:
    """The tree level by level; constants as in the operator."""
    u = "coalesce(url, '')"
    paths = """paths0 AS (
        SELECT host, path, count(*) AS urls, any_value(verdict) AS verdict, '' AS template,
            list_filter(string_split(regexp_replace(path, '[0-9]+', '*', 'g'), '/'), lambda s: s <> '') AS parts
        FROM u GROUP BY host, path
    ), grown0 AS (
        SELECT host, path, template, CASE WHEN verdict IS NULL THEN 0 ELSE urls END AS labels,
            CASE WHEN verdict = 'block' THEN urls ELSE 0 END AS blocked, urls,
            CASE WHEN len(parts) > 4 THEN list_append(parts[1:4], '**') ELSE parts END AS segments
        FROM paths0
    )"""
    for i in range(5):
        paths += f""", varied{i} AS (
            SELECT host, template FROM (
                SELECT host, template, segments[{i + 1}] AS part, sum(urls) AS urls FROM grown{i}
                WHERE len(segments) > {i} GROUP BY ALL
            ) GROUP BY host, template HAVING count(*) >= 8 AND 2 * count(*) > sum(urls)
        ), grown{i + 1} AS (
            SELECT g.* EXCLUDE (template), g.template || CASE WHEN len(segments) <= {i} THEN ''
                WHEN v.host IS NOT NULL THEN '/*' ELSE '/' || segments[{i + 1}] END AS template
            FROM grown{i} g LEFT JOIN varied{i} v ON g.host = v.host AND g.template = v.template
        )"""
    return f"""
    WITH h AS (
        SELECT page_id, translate(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract({u}, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
    ), u AS (
        SELECT *, CASE rule WHEN 'net/' THEN 'block' WHEN 'example.net/en/' THEN 'allow'
            WHEN 'example.com/de/' THEN 'block' WHEN 'org/fr/' THEN 'allow' END AS verdict
        FROM (SELECT *, CASE
            WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM h)
    ), {paths}, overall AS (
        SELECT (coalesce(sum(blocked), 0)::DOUBLE + 2.0::DOUBLE) / (coalesce(sum(labels), 0)::DOUBLE + 4.0::DOUBLE) AS share FROM grown5
    ), hosts AS (
        SELECT host, (sum(blocked)::DOUBLE + any_value(share) * 4.0::DOUBLE) / (sum(labels)::DOUBLE + 4.0::DOUBLE) AS of_host
        FROM grown5, overall GROUP BY host
    ), {_merge_sql()}, branches AS (
        SELECT host, branch, 1 - (sum(blocked)::DOUBLE + any_value(of_host) * 4.0::DOUBLE) / (sum(labels)::DOUBLE + 4.0::DOUBLE) AS purity
        FROM merged1 JOIN hosts USING (host) GROUP BY host, branch
    )
    SELECT page_id, host, path, rule,
        coalesce(u.verdict, CASE WHEN purity < 0.5 THEN 'block' ELSE 'allow' END) AS verdict
    FROM u JOIN grown5 g USING (host, path) JOIN merged1 USING (host, template) JOIN branches USING (host, branch)
    """


# base32 of a SHA-1: five hexadecimal digits make four characters
WARC_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), answer AS (SELECT h, max(page_id) AS answer FROM p GROUP BY h)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((CAST('0x' || substr(h, i // 4 * 5 + 1, 5) AS INTEGER) >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31 AS INTEGER) + 1, 1)
        for i in range(32)], '') AS payload_digest,
    CASE WHEN page_id = answer THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> answer THEN answer END AS refers_to
FROM p JOIN answer USING (h)
"""


PREFERENCE_SQL = """
WITH t AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i
    FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)
), ending AS (SELECT conv_id, max(i) AS i FROM t WHERE role = 'assistant' GROUP BY conv_id
), answer AS (SELECT xor(conv_id, 1) AS conv_id, t.role, t.text FROM t JOIN ending USING (conv_id, i)
), kept AS (
    SELECT t.conv_id, t.i, CASE WHEN t.i = l.i THEN a.role ELSE t.role END AS role,
        CASE WHEN t.i = l.i THEN a.text ELSE t.text END AS text
    FROM t LEFT JOIN ending l ON t.conv_id = l.conv_id LEFT JOIN answer a ON t.conv_id = a.conv_id
    WHERE t.i IS DISTINCT FROM l.i OR a.conv_id IS NOT NULL
), r AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS i FROM kept
), sides AS (
    SELECT 'c' AS side, * FROM t UNION ALL SELECT 'r' AS side, conv_id, role, text, i FROM r
), differs AS (
    SELECT coalesce(t.conv_id, r.conv_id) AS conv_id, min(coalesce(t.i, r.i)) AS i
    FROM t FULL JOIN r ON t.conv_id = r.conv_id AND t.i = r.i
    WHERE t.i IS NULL OR r.i IS NULL OR t.role IS DISTINCT FROM r.role OR t.text IS DISTINCT FROM r.text
    GROUP BY 1
), shown AS (
    SELECT b.*, d.i AS cut, '<|im_start|>' || replace(coalesce(role, ''), '<|', '< |') || chr(10)
        || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10) AS s
    FROM sides b LEFT JOIN differs d USING (conv_id)
), placed AS (
    SELECT *, i >= coalesce(cut, 1e9) AS late,
        coalesce(sum(length(s)) OVER (PARTITION BY side, conv_id, i >= coalesce(cut, 1e9) ORDER BY i
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
    FROM shown
)
SELECT conv_id AS pair_id, CAST(count(*) FILTER (WHERE side = 'c' AND NOT late) AS INTEGER) AS prompt_turns,
    coalesce(string_agg(s, '' ORDER BY i) FILTER (WHERE side = 'c' AND NOT late), '') AS prompt,
    coalesce(string_agg(s, '' ORDER BY i) FILTER (WHERE side = 'c' AND late), '') AS chosen,
    coalesce(string_agg(s, '' ORDER BY i) FILTER (WHERE side = 'r' AND late), '') AS rejected,
    coalesce(string_agg((pos + 22)::BIGINT || '-' || (pos + length(s) - 1)::BIGINT, ',' ORDER BY i)
        FILTER (WHERE side = 'c' AND late AND role = 'assistant'), '') AS chosen_spans,
    coalesce(string_agg((pos + 22)::BIGINT || '-' || (pos + length(s) - 1)::BIGINT, ',' ORDER BY i)
        FILTER (WHERE side = 'r' AND late AND role = 'assistant'), '') AS rejected_spans,
    NOT bool_or(late) AS tied
FROM placed GROUP BY conv_id
"""


# every document scored; sums of whole numbers, `//` rounding down
LEXICAL_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), total AS (
    SELECT count(*) FILTER (WHERE len(w) > 0)::BIGINT AS n, coalesce(sum(len(w)), 0)::BIGINT AS l FROM d
), q AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM benchmark WHERE item_id IS NOT NULL
), p AS (
    SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t
), weights AS (
    SELECT t, floor(1000 * ln((2.0::DOUBLE * n + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS weight FROM p, total GROUP BY t, n
), scores AS (
    SELECT item_id, r, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(w) * n) // l))))::BIGINT AS score
    FROM q JOIN weights USING (t) JOIN p USING (t) JOIN d USING (r), total GROUP BY item_id, r
), ranked AS (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scores JOIN d USING (r) WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


ORACLE_SQL: dict[str, str] = {
    "op5_preference_pairs": PREFERENCE_SQL,
    "op1_warc": WARC_SQL,
    "op7_url_filter": _url_sql(),
    "op4_decontamination": DECONTAMINATION_SQL,
    "op11_lexical_search": LEXICAL_SQL,
}
