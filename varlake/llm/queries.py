"""The registered queries ``opN_<name>`` and their DuckDB statements.

Each reads whole tables, calls its operator with production parameters and
derives the columns that the query returns from the operator's own.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The rules for pages.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    from varlake.llm.url_filter import judge_urls

    return judge_urls(_table(spark, sf_dir, "pages"), RULES).drop("weight")


def _oracle_1() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    strict = "adult|casino|escort|porn|spam|viagra|warez|xxx"
    soft = ["ads", "bet", "bets", "bonus", "cheap", "click", "discount", "free", "loan", "pill",
            "pills", "poker", "promo", "track", "win"]

    def holds(term: str) -> str:
        return f"regexp_matches(low, '(^|[^a-z0-9])({term})([^a-z0-9]|$)')"

    def fits(rule: str) -> str:
        host, path = rule.split("/", 1)
        return (f"(host = '{host}' OR ends_with(host, '.{host}')) "
                f"AND starts_with(path, '/{path}')")

    ordered = sorted(RULES, key=lambda r: -len(r[1]))
    rule = " ".join(f"WHEN {fits(r)} THEN '{r}'" for _, r in ordered)
    verdict = " ".join(f"WHEN {fits(r)} THEN '{v}'" for v, r in ordered)
    hits = " + ".join(f"CAST({holds(t)} AS INTEGER)" for t in soft)
    return f"""
WITH u AS (
    SELECT page_id, translate(coalesce(url, ''), '{upper}', '{lower}') AS low,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                     '{upper}', '{lower}') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict}
            WHEN {holds(strict)} OR {hits} >= 2 THEN 'block' ELSE 'allow' END AS verdict
FROM u
"""


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 4096 tokens."""
    from varlake.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path(), digest=True)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    from varlake.llm.toxicity import toxicity

    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    from varlake.llm.ngram_join import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 40, of nearly equal sizes."""
    from varlake.llm.sharding import shard_by_size

    return shard_by_size(_table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item."""
    from varlake.llm.decontaminate import contamination

    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    from varlake.llm.quality import quality

    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's capture, read back from the archives written."""
    from varlake.llm.warc import archive_pages

    return archive_pages(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of repeated three-line windows."""
    from varlake.llm.line_dedup import dedup_lines

    return dedup_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("__kept_text").alias("kept_text"), F.col("__n_lines").alias("n_lines"),
        F.col("__n_removed").alias("n_removed"))


def op10_permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    from varlake.llm.ann import search

    return search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_pair_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents that score highest for each benchmark item."""
    from varlake.llm.pair_maxscore import search_items

    return search_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def planted_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words whose runs are wanted: every tenth document, by a hash of its
    id, becomes periodic from some word on.  A null id plants nothing."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, and its words without them."""
    from varlake.llm.periodic import find_runs

    found = find_runs(_table(spark, sf_dir, "documents"), rewrite=planted_words)
    # The greatest length; of these the smallest start, then period.
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    found = found.withColumn("__longest", longest)
    length, period = F.col("__longest.length"), -F.col("__longest.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("__longest.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        digest(F.array_join(lines, "")).alias("runs_sha256"),
        digest(F.col("kept_text")).alias("collapsed_sha256"))


def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    from varlake.llm.winnowing import fingerprint_neighbours

    return fingerprint_neighbours(_table(spark, sf_dir, "documents"))


ORACLE_4 = """
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), sets AS (
    SELECT r, doc_id, CASE WHEN len(w) > 0 THEN list_sort(list_distinct(list_transform(
        range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s
    FROM words
), nodes AS (
    SELECT s, row_number() OVER (ORDER BY s) AS node, count(*) AS copies, min(doc_id) AS least
    FROM sets WHERE s IS NOT NULL GROUP BY s
), shingles AS (
    SELECT node, len(s) AS n, unnest(s) AS shingle FROM nodes
), pairs AS (
    SELECT a.node AS a, b.node AS b FROM shingles a JOIN shingles b
        ON a.shingle = b.shingle AND a.node < b.node AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
    GROUP BY a.node, b.node, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))
), links AS (
    SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), met(node, other) AS (
    SELECT node, node FROM nodes
    UNION SELECT m.node, l.b FROM met m JOIN links l ON m.other = l.a
), classes AS (
    SELECT m.node, min(n.least) AS class_id FROM met m JOIN nodes n ON m.other = n.node GROUP BY m.node
), linked AS (
    SELECT l.a AS node, sum(n.copies) AS links FROM links l JOIN nodes n ON l.b = n.node GROUP BY l.a
)
SELECT t.doc_id, CASE WHEN n.node IS NULL THEN t.doc_id ELSE c.class_id END AS class_id,
       CAST(CASE WHEN n.node IS NULL THEN 0 ELSE n.copies - 1 + coalesce(k.links, 0) END AS BIGINT) AS n_links
FROM sets t LEFT JOIN nodes n ON t.s = n.s LEFT JOIN classes c ON n.node = c.node
LEFT JOIN linked k ON n.node = k.node
"""

ORACLE_6 = """
WITH words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark
), item_windows AS (
    SELECT item_id, least(len(w), 10) AS k,
           unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
                                 lambda i: array_to_string(w[i:i + 9], ' '))) AS phrase
    FROM items WHERE len(w) > 0
), sizes AS (SELECT DISTINCT k FROM item_windows
), doc_windows AS (
    SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS pos,
           unnest(list_transform(range(1, len(w) - k + 2),
                                 lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM words, sizes WHERE len(w) >= k
), hits AS (
    SELECT d.doc_id, d.pos, d.k, i.item_id
    FROM doc_windows d JOIN item_windows i ON d.k = i.k AND d.phrase = i.phrase
), hit_words AS (
    SELECT doc_id, count(*) AS n_hit FROM (
        SELECT DISTINCT doc_id, unnest(range(pos, pos + k)) AS pos FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit_words h ON w.doc_id = h.doc_id
LEFT JOIN hit_items i ON w.doc_id = i.doc_id
"""

# Base 32 of the digest: four digits for every five of its hexadecimal ones.
ORACLE_8 = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p
), digits AS (
    SELECT hex, array_to_string(list_transform(range(0, 32), lambda i: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((CAST('0x' || substr(hex, (i // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1,
        1)), '') AS payload_digest
    FROM (SELECT DISTINCT hex FROM d)
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts JOIN digits USING (hex)
"""

ORACLE_9 = """
WITH lines AS (
    SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line, len(l) AS n
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)
), windows AS (
    SELECT doc_id, pos, n, least(n, 3) AS k,
           line AS a,
           lead(line, 1) OVER (PARTITION BY doc_id ORDER BY pos) AS b,
           lead(line, 2) OVER (PARTITION BY doc_id ORDER BY pos) AS c
    FROM lines
), numbered AS (
    SELECT doc_id, pos, k,
           row_number() OVER (PARTITION BY k, a, b, c ORDER BY doc_id NULLS FIRST, pos) AS nth
    FROM windows WHERE pos <= greatest(n - 2, 1)
), gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + k - 1)) AS pos
    FROM numbered WHERE nth > 1
), kept AS (
    SELECT l.doc_id, count(*) AS n_lines,
           count(g.pos) AS n_removed,
           coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '')
               AS kept_text
    FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
    GROUP BY l.doc_id
)
SELECT d.doc_id, k.kept_text,
       CAST(coalesce(k.n_lines, 0) AS INTEGER) AS n_lines,
       CAST(coalesce(k.n_removed, 0) AS INTEGER) AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


ORACLE_11 = """
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
    FROM documents WHERE text IS NOT NULL
), sizes AS (
    SELECT doc_id, r, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0
), total AS (
    SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes
), wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
    FROM benchmark WHERE text IS NOT NULL
), posts AS (
    SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS t FROM d)
    WHERE t IN (SELECT t FROM wanted) GROUP BY r, t
), weights AS (
    SELECT t, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM posts, total GROUP BY t
), scores AS (
    SELECT item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) //
        (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words)))) AS BIGINT) AS score
    FROM wanted JOIN posts USING (t) JOIN weights USING (t) JOIN sizes USING (r), total
    GROUP BY item_id, doc_id, r
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS nth
    FROM scores WHERE score > 0
)
SELECT item_id, CAST(nth AS INTEGER) AS rank, doc_id, score FROM ranked WHERE nth <= 50
"""


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_url_filter": (op1_url_filter, _oracle_1()),
    "op2_packing": (op2_packing, None),
    "op3_toxicity": (op3_toxicity, None),
    "op4_ngram_join": (op4_ngram_join, ORACLE_4),
    "op5_sharding": (op5_sharding, None),
    "op6_decontamination": (op6_decontamination, ORACLE_6),
    "op7_quality": (op7_quality, None),
    "op8_warc": (op8_warc, ORACLE_8),
    "op9_line_dedup": (op9_line_dedup, ORACLE_9),
    "op10_permutation_search": (op10_permutation_search, None),
    "op11_pair_maxscore": (op11_pair_maxscore, ORACLE_11),
    "op12_periodic_runs": (op12_periodic_runs, None),
    "op13_winnowing": (op13_winnowing, None),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for name, (q, _) in QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
