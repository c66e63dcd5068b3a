"""Named queries over the language-model operators, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import (
    articles,
    exact,
    langid,
    licenses,
    mixing,
    negatives,
    packing,
    quality,
    simhash,
    tokencounts,
    tokenfiles,
    trie,
    vectors,
)
from larder.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLE_SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    "op8_exact_dedup",
    """
    WITH normal AS (
        SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
        FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        doc_id = max(doc_id) OVER same AS kept, text_sha256
    FROM normal WINDOW same AS (PARTITION BY text_sha256)
    """,
)
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_dedup(table(spark, folder, "documents"))


@query(
    "op5_mixing",
    f"""
    WITH sized AS (
        SELECT doc_id, source, md5('{mixing.Settings().seed}' || doc_id) AS place,
            coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
        FROM documents),
    sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
            (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
        FROM sized GROUP BY source),
    steps AS (
        SELECT *, row_number() OVER steps AS step,
            (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (steps
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (steps ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
        FROM sources WINDOW steps AS (
            ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST)),
    open AS (
        SELECT min_by(share, step) AS share FROM steps WHERE weight * share <= 3 * source_size),
    targets AS (
        SELECT source, source_size, CASE WHEN weight * steps.share > 3 * source_size
            THEN (3 * source_size)::DOUBLE ELSE weight * open.share END AS target
        FROM steps, open),
    placed AS (
        SELECT doc_id, size, source_size, target, sum(size) OVER (
            PARTITION BY sized.source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) - size AS start
        FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
    SELECT doc_id, size, source_size, target, (size * (
        (2 * start + size <= 2 * target)::INT
        + (2 * (source_size + start) + size <= 2 * target)::INT
        + (2 * (2 * source_size + start) + size <= 2 * target)::INT))::BIGINT AS taken
    FROM placed
    """,
)
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_sizes(table(spark, folder, "documents"))


# Fixed vocabulary of the query contracts; operators take any path.
def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op2_packing")
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.pack_documents(docs, vocabulary(), end_id=1, with_ids=False)


@query("op7_token_files")
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = fresh_path(spark, "sequences")
    docs = table(spark, folder, "documents")
    manifest = tokenfiles.write_sequences(docs, target, vocabulary(), end_id=2)
    return tokenfiles.document_digests(spark, target, manifest)


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    target = fresh_path(spark, "tokens")
    docs = table(spark, folder, "documents")
    return tokencounts.token_counts(docs, target, vocabulary(), end_id=49407)


@query("op6_simhash_dedup")
def op6_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query(
    "op1_vector_dedup",
    """
    WITH RECURSIVE rows AS MATERIALIZED (
        SELECT vec_id, embedding::DOUBLE[] AS v, coalesce(len(embedding) > 0 AND list_bool_and(
            list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
            AND list_bool_or(list_transform(embedding, lambda x: x <> 0)), FALSE) AS usable
        FROM embeddings),
    links AS MATERIALIZED (
        SELECT a.vec_id AS a, b.vec_id AS b FROM rows a JOIN rows b
        ON a.usable AND b.usable AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            AND list_cosine_similarity(a.v, b.v) >= 0.95),
    reached AS (
        SELECT vec_id AS node, vec_id AS low FROM rows
        UNION
        SELECT links.b, reached.low FROM reached JOIN links ON links.a = reached.node
        WHERE reached.low < links.b),
    lowest AS (SELECT node, min(low) AS component_id FROM reached GROUP BY node),
    counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM rows JOIN lowest ON node = vec_id LEFT JOIN counted ON a = vec_id
    """,
)
def op1_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicate_vectors(table(spark, folder, "embeddings"))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


@query("op4_main_text")
def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return articles.main_text(table(spark, folder, "pages"))


def _license_sql() -> str:
    """Every template against every window, without bands."""
    quoted = [(n, t.replace("'", "''")) for n, t in licenses.TEMPLATES.items()]
    values = ", ".join(f"('{name}', '{text}')" for name, text in quoted)
    shingles = """
        SELECT {key}, list_transform(range(0, greatest(len(w) - 4, 1)),
            lambda i: array_to_string(w[i + 1 : i + 5], ' ')) AS shingles
        FROM (SELECT {key}, list_filter(regexp_split_to_array(lower(text),
            '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {table}) WHERE len(w) > 0"""
    return f"""
    WITH templates AS (SELECT * FROM (VALUES {values}) AS t(license, text)),
    template_shingles AS (
        SELECT license, list_distinct(shingles) AS distinct_shingles,
            (2 ** ceil(log2(len(shingles))))::INT AS size
        FROM ({shingles.format(key="license", table="templates")})),
    wanted AS (
        SELECT license, size, greatest(size // 2, 1) AS stride,
            size + greatest(size // 2, 1) - 1 AS span, len(distinct_shingles) AS n,
            unnest(distinct_shingles) AS shingle
        FROM template_shingles),
    placed AS (
        SELECT doc_id, unnest(shingles) AS shingle, unnest(range(len(shingles))) AS place
        FROM ({shingles.format(key="doc_id", table="documents")})),
    hits AS (
        SELECT doc_id, license, shingle, place, n, unnest(range(
            greatest(ceil((place - span + 1) / stride::DOUBLE), 0)::BIGINT, place // stride + 1)) AS win
        FROM placed JOIN wanted USING (shingle)),
    windows AS (
        SELECT doc_id, license, win, count(DISTINCT shingle) / any_value(n)::DOUBLE AS containment,
            min(place) AS first_word
        FROM hits GROUP BY doc_id, license, win)
    SELECT doc_id, license, max(containment) AS containment, min(first_word) AS first_word
    FROM windows WHERE containment >= 0.8 GROUP BY doc_id, license"""


@query("op9_license_scan", _license_sql())
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    steps = f"""flatten(list_transform(string_split({text}, ''),
        lambda c: [ascii(c)::BIGINT + 256, -1, -1, -1, -1, -1, -1, -1, -1]))"""
    return f"""(4294967295 - list_reduce(list_prepend(4294967295::BIGINT, {steps}),
        lambda a, b: CASE WHEN b >= 0 THEN xor(a, b - 256) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""


@query(
    "op11_conversation_trie",
    f"""
    WITH own AS MATERIALIZED (
        SELECT conv_id AS c, {_crc32_sql("conv_id::VARCHAR")} % 9 AS h,
            list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
                ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':'
                    || coalesce(role, '') || coalesce(text, ''))) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    rebuilt AS MATERIALIZED (
        SELECT own.c, list_concat(coalesce(first.turns, [])[:own.h], own.turns[own.h + 1:]) AS s
        FROM own LEFT JOIN own first ON first.c = own.c - own.c % 5),
    members AS (
        SELECT c, d, s[:d] AS p, len(s) = d AS ends
        FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
    nodes AS MATERIALIZED (
        SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(
            string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
        FROM members GROUP BY p, d),
    children AS (
        SELECT p[:d - 1] AS p, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
    valued AS MATERIALIZED (
        SELECT nodes.*, coalesce(children.n, 0) AS n_children,
            CASE WHEN nodes.d = 0 THEN 0 ELSE (n_convs - 1) * strlen(nodes.p[nodes.d].t) END AS saved
        FROM nodes LEFT JOIN children ON children.p = nodes.p AND children.d = nodes.d),
    sums AS (
        SELECT a.p, a.d, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves,
            sum(b.saved)::BIGINT AS saved_tokens
        FROM valued a JOIN valued b ON b.d >= a.d AND b.p[:a.d] = a.p GROUP BY a.p, a.d)
    SELECT v.conv_id, v.d AS depth, above.conv_id AS parent_conv_id, v.n_convs, v.n_children,
        n_leaves, saved_tokens, v.ends_sha256
    FROM valued v JOIN sums ON sums.p = v.p AND sums.d = v.d
    LEFT JOIN nodes above ON above.d = v.d - 1 AND above.p = v.p[:v.d - 1]
    """,
)
def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.conversation_trie(table(spark, folder, "conversations"))


@query(
    "op12_hard_negatives",
    """
    WITH rows AS MATERIALIZED (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND coalesce(list_bool_and(
            list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), TRUE)),
    scored AS MATERIALIZED (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
            list_dot_product(a.v, b.v)::BIGINT AS score
        FROM rows a JOIN rows b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT p.anchor_id, positive_id, row_number() OVER nearest::INTEGER AS rank,
        other_id AS negative_id, positive_score, score AS negative_score
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
        AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
    WINDOW nearest AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
    QUALIFY row_number() OVER nearest <= 10
    """,
)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.hard_negatives(
        table(spark, folder, "embeddings"),
        is_anchor=lambda id_: id_ % 100 == 0,
        relabel=lambda id_, label: F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label),
    )


@query("op13_quality")
def op13_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality.score_quality(docs, labels, metadata=("n_chars",))
