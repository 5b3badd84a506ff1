"""One registered query per operator of the subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm import alignment, bpe, chat, exact_dedup, labelled, language, lm, ngram_join, packing, quality, runs, spotsigs, toxicity, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and their edited texts; the tests check a plain version."""
    return spotsigs.edited_likeness(table(spark, sf_dir, "documents"))


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; the tests check held-out accuracy."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.classify(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (labelled.fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; the tests check neighbours and held-out accuracy."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.classify(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (labelled.fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted", "evidence"
    )


@query(
    r"""
    WITH split AS (
        SELECT doc_id, list_filter(
            regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
        FROM documents
    ), counts AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM split) GROUP BY word),
    named AS (SELECT word, n, row_number() OVER (ORDER BY word) AS id FROM counts),
    totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM counts) AS words, (SELECT count(*) FROM documents) AS texts),
    single AS (SELECT id, n FROM named UNION ALL SELECT 0, texts FROM totals),
    placed AS (
        SELECT doc_id, i, k.id
        FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split) JOIN named k USING (word)
        UNION ALL SELECT doc_id, 0, 0 FROM split UNION ALL SELECT doc_id, len(words) + 1, 0 FROM split
    ), moves AS (
        SELECT doc_id, h, w FROM (
            SELECT doc_id, i, lag(id) OVER (PARTITION BY doc_id ORDER BY i) AS h, id AS w FROM placed
        ) WHERE i > 0
    ), pairs AS (SELECT h, w, count(*) AS n FROM moves GROUP BY h, w),
    logs AS (
        SELECT h, w, p.n >= 2 AS seen, CAST(CASE WHEN p.n >= 2
            THEN floor(ln(p.n) * 1e6 + 0.5) - floor(ln(a.n) * 1e6 + 0.5)
            ELSE floor(ln(b.n) * 1e6 + 0.5) - floor(ln(t.words + t.texts) * 1e6 + 0.5) + floor(ln(0.4) * 1e6 + 0.5) END AS BIGINT) AS log
        FROM pairs p JOIN single a ON a.id = p.h JOIN single b ON b.id = p.w, totals t
    ), sums AS (
        SELECT doc_id, count(*) AS n_transitions, count(*) FILTER (seen) AS n_seen, CAST(sum(log) AS BIGINT) AS score
        FROM moves JOIN logs USING (h, w) GROUP BY doc_id
    )
    SELECT doc_id, n_transitions, n_seen, score / 1e6::DOUBLE AS log_score, score / 1e6::DOUBLE / n_transitions AS mean_log_score
    FROM sums
    """
)
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


@query()
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded; no SQL can do it, see the library comparison in the tests."""
    return bpe.digests(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH turns AS (
        SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    ), plain AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n
        FROM turns
    ), coded AS (
        SELECT *, replace(replace(replace(text, '\', '\b'), '#', '\h'), '</turn>', '\t/turn>') AS code,
               replace(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '</turn>', '\t/turn>'),
                       ':', '\c'), chr(10), '\n') AS name
        FROM plain
    ), said AS (
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
               coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '') AS loss,
               sum(length('### ' || name || ': ' || code || ' </turn>' || chr(10))) AS formatted_chars
        FROM coded GROUP BY conv_id
    )
    SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
           CAST(formatted_chars AS BIGINT) AS formatted_chars
    FROM said
    """
)
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings, streamed, folded, rendered and read back."""
    odd = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role, odd.alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    messages = chat.fold_events(chat.turns_as_streams(turns))
    return chat.digests(chat.render(messages))


@query(
    r"""
    WITH RECURSIVE split AS (
        SELECT doc_id, list_filter(
            regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
        FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
            ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
        FROM split
    ), exploded AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
    links AS (
        SELECT a.doc_id AS x, b.doc_id AS y FROM exploded a JOIN exploded b USING (shingle) WHERE a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
    ), reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
    SELECT s.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.least_id, s.doc_id)) AS component_id
    FROM sets s LEFT JOIN (SELECT x, min(y) AS least_id FROM reach GROUP BY x) m ON m.x = s.doc_id
    """
)
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), 4, 85, 100)


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query(
    r"""
    WITH rules(host, path, verdict) AS (VALUES
        ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')
    ), rest AS (
        SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ), parsed AS (
        SELECT page_id,
               translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM rest
    ), ranked AS (
        SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
               row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS nth
        FROM parsed p LEFT JOIN rules r
          ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    )
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM ranked WHERE nth = 1
    """
)
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


@query()
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; the tests check it against the library and a plain packer."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH plain AS (
        SELECT doc_id, length(coalesce(text, '')) AS chars,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
        FROM documents
    ), placed AS (
        SELECT doc_id, content,
               first_value(doc_id) OVER (PARTITION BY content ORDER BY chars DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY content) AS group_size
        FROM plain
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM placed
    """
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup.mark_copies(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all texts; the tests check the network's gradient, a plain reader and held-out accuracy."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(labelled.fold("doc_id", 4) != 2))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (labelled.fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query()
def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all texts; SQL would compare all periods, the tests do so on a small table."""
    return runs.digests(table(spark, sf_dir, "documents"))


@query()
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned in all texts; the tests align whole texts token by token."""
    return alignment.digests(table(spark, sf_dir, "documents"))
