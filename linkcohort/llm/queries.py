"""The operators as queries on the whole given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkcohort.llm.bpe import encode_documents
from linkcohort.llm.credentials import find_secrets
from linkcohort.llm.decontaminate import find_contamination
from linkcohort.llm.dialogue import repair_conversations
from linkcohort.llm.fingerprint import compare_neighbours
from linkcohort.llm.lm import score_documents as score_language
from linkcohort.llm.neardup import Settings, near_duplicates
from linkcohort.llm.pii import find_personal
from linkcohort.llm.quality import score_documents
from linkcohort.llm.sharding import shard_documents, tree
from linkcohort.llm.spelling import group_variants
from linkcohort.llm.urls import Rule, UrlFilter, labelled_by_rules
from linkcohort.llm.warc import read_warc, write_warc

Query = Callable[[SparkSession, str], DataFrame]

RULES = (
    Rule("org", "/", True), Rule("example.org", "/es/", False), Rule("example.org", "/en/1", False),
    Rule("com", "/fr/", True), Rule("com", "/de/", False),
)
LINKED = Settings(words=3, percent=85, bands=25, rows=5)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return find_contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"), LINKED).drop("text_key")


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return find_secrets(_table(spark, folder, "documents"))


def op4_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(_table(spark, folder, "documents"), tree(8), tree(9))


def op5_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return UrlFilter.fit(labelled_by_rules(pages, RULES), RULES).judge(pages)


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encode_documents(_table(spark, folder, "documents"), vocabulary())


def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return compare_neighbours(_table(spark, folder, "documents"))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = write_warc(_table(spark, folder, "pages"))
    return read_warc(spark, path).filter("kind = 'record'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal(_table(spark, folder, "documents"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(_table(spark, folder, "documents"), _table(spark, folder, "labels")).drop("text_key")


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return repair_conversations(_table(spark, folder, "conversations"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return group_variants(_table(spark, folder, "documents"))


def op13_language(spark: SparkSession, folder: str) -> DataFrame:
    return score_language(_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_near_duplicates, op3_secrets, op4_shards, op5_urls,
        op6_bpe, op7_fingerprints, op8_warc, op9_personal_data, op10_quality,
        op11_conversations, op12_spelling, op13_language,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP1_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP2_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

_CRC_TABLE = """
    SELECT list(c ORDER BY i) AS tab FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
        FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)
    )"""
_BYTES = "flatten(list_transform(string_split({0}, ''), lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)] END))"
_CRC = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {_BYTES}), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"

SQL: dict[str, str] = {
    "op1_decontaminate": f"""
        WITH words AS (SELECT doc_id, {_OP1_WORDS} AS w FROM documents),
        items AS (SELECT item_id, w, least(len(w), 10) AS size FROM (SELECT item_id, {_OP1_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
        grams AS (
            SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS gram
            FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM items)
        ),
        places AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, (SELECT DISTINCT size FROM grams)),
        hits AS (
            SELECT p.doc_id, p.i, p.size, g.item_id
            FROM (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram FROM places) p
            JOIN grams g ON p.size = g.size AND p.gram = g.gram
        ),
        hit AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
        found AS (
            SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
        )
        SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
            CAST(coalesce(f.n, 0) AS BIGINT) AS n_items, sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
        FROM words w LEFT JOIN hit h ON w.doc_id = h.doc_id LEFT JOIN found f ON w.doc_id = f.doc_id
    """,
    "op2_near_duplicates": f"""
        WITH RECURSIVE words AS (SELECT doc_id, {_OP2_WORDS} AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
        ),
        links AS (
            SELECT x, y FROM shared s JOIN sizes a ON a.doc_id = s.x JOIN sizes b ON b.doc_id = s.y
            WHERE 100 * s.n >= 85 * (a.n + b.n - s.n)
        ),
        both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach(doc_id, reached) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT r.doc_id, b.y FROM reach r JOIN both_ways b ON r.reached = b.x
        )
        SELECT d.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
        FROM documents d LEFT JOIN sizes z ON d.doc_id = z.doc_id
        JOIN (SELECT doc_id, min(reached) AS c FROM reach GROUP BY doc_id) m ON d.doc_id = m.doc_id
    """,
    "op8_warc": """
        WITH payloads AS (
            SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha1(coalesce(html, '')) AS d FROM pages
        ),
        firsts AS (SELECT d, max(page_id) AS f FROM payloads WHERE n >= 1000 GROUP BY d)
        SELECT p.page_id, p.n AS payload_bytes, p.d AS payload_digest,
            CASE WHEN f.f IS NOT NULL AND f.f <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN f.f <> p.page_id THEN f.f END AS refers_to
        FROM payloads p LEFT JOIN firsts f ON p.d = f.d AND p.n >= 1000
    """,
    "op12_spelling": f"""
        WITH RECURSIVE crc AS ({_CRC_TABLE}),
        runs AS (
            SELECT doc_id, run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\u00C0-\u00FF]+')) AS run FROM documents)
            WHERE length(run) >= 6 GROUP BY doc_id, run
        ),
        hashed AS (SELECT run, n, {_CRC.format("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs, crc),
        damaged AS (
            SELECT n, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
        ),
        words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        gaps AS (SELECT word, n, i, left(word, i - 1) AS front, substr(word, i + 1) AS back FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        near AS (
            SELECT a.word, b.word AS other, b.n FROM gaps a JOIN gaps b ON a.i = b.i AND a.front = b.front AND a.back = b.back AND a.word <> b.word
            UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON g.front || g.back = w.word
            UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON g.front || g.back = w.word
        ),
        ranked AS (
            SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS k FROM near
        ),
        forms AS (
            SELECT w.word, w.n, CAST(coalesce(r.n_near, 0) AS BIGINT) AS n_near,
                CASE WHEN r.n >= 5 * w.n THEN r.other END AS form, CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
            FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1
        ),
        ways(word, here) AS (SELECT word, word FROM words UNION ALL SELECT y.word, f.form FROM ways y JOIN forms f ON y.here = f.word WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, y.here AS root, f.n, f.n_near, f.form_n
        FROM forms f JOIN ways y ON y.word = f.word JOIN forms e ON e.word = y.here AND e.form IS NULL
    """,
}
