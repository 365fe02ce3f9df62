"""The registered queries of this subpackage: thin digests of its operators over
whole tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.session import run_dir

from . import chat, decontam, exact, packing, phrases, quality, search, secrets, simhash, substrings, tokens, toxicity, warc

WINDOW = 2048


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack_documents(_texts(spark, sf_dir), tokenizer_path(), WINDOW))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_texts(spark, sf_dir)).select("doc_id", "quality.*")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_texts(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    score = F.col("toxicity.score")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= 0.7).cast("int").alias("predicted"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = chat.render(chat.collapse(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))
    return kept.select("conv_id", "position", "n_turns", "copies", "rendered")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_texts(spark, sf_dir), 35, kept_text=False).drop("kept")


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontam.decontaminate(_texts(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", "bench.n_words", "bench.n_hit", F.size("bench.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("bench.items", ","), 256).alias("items_sha256"), "bench.contaminated",
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_texts(spark, sf_dir))
    base = F.col("secrets.base")
    counts = [F.size(F.filter(base, _is_kind(n))).cast("long").alias(f"n_{k}") for n, k in enumerate(secrets.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("secrets.spans")).alias("spans"))


def _is_kind(n: int):
    return lambda x: x["kind"] == n


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(_texts(spark, sf_dir), tokenizer_path())
    return counted.select("doc_id", "tokens.n_bytes", "tokens.n_tokens", (F.col("tokens.n_tokens") > WINDOW).alias("over_limit"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))
    return found.withColumn("rank", F.col("rank").cast("long"))


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(_texts(spark, sf_dir)).select("doc_id", "dedup.*")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_texts(spark, sf_dir), table(spark, sf_dir, "benchmark").select("item_id", "text"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing, op2_quality, op3_simhash, op4_toxicity, op5_chat, op6_warc, op7_substrings, op8_decontam, op9_secrets, op10_tokens,
        op11_phrases, op12_exact, op13_search,
    )
}

# Conversations: prefixes as strings of digests instead of rolling hashes.
_OP5 = """
WITH t AS (
  SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
p AS (
  SELECT *, row_number() OVER w - 1 AS position, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         string_agg(md5(role || chr(31) || text), '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
whole AS (
  SELECT prefix, min(conv_id) AS conv_id, count(*) AS copies FROM p WHERE position = n_turns - 1 GROUP BY prefix),
kept AS (
  SELECT conv_id, copies FROM whole
  WHERE prefix NOT IN (SELECT prefix FROM p WHERE position < n_turns - 1))
SELECT conv_id, position, n_turns, copies,
       '<|im_start|>' || role || chr(10) || trim(text, ' ') || '<|im_end|>' || chr(10) AS rendered
FROM p JOIN kept USING (conv_id)
"""

# Pages: digests and roles from the table itself; base 32 five bits at a time.
_OP6 = """
WITH d AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
  SELECT DISTINCT hex,
         array_to_string(list_transform(range(40), lambda i: lpad(bin(strpos('0123456789abcdef', hex[i + 1]) - 1), 4, '0')), '') AS bits
  FROM d),
s AS (
  SELECT hex, array_to_string(list_transform(range(32), lambda i:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + 16 * bits[5 * i + 1]::INT + 8 * bits[5 * i + 2]::INT + 4 * bits[5 * i + 3]::INT
                                            + 2 * bits[5 * i + 4]::INT + bits[5 * i + 5]::INT]), '') AS payload_digest
  FROM b),
k AS (SELECT hex, max(page_id) AS keep FROM d GROUP BY hex)
SELECT d.page_id, CAST(strlen(d.html) AS BIGINT) AS payload_bytes, s.payload_digest,
       CASE WHEN d.page_id IS NOT DISTINCT FROM k.keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN d.page_id IS NOT DISTINCT FROM k.keep THEN NULL ELSE k.keep END AS refers_to
FROM d JOIN s USING (hex) JOIN k USING (hex)
"""

_OP7 = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, CASE WHEN l = [''] THEN [] ELSE l END AS l
  FROM (SELECT doc_id, string_split(trim(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ') AS l FROM documents)),
g AS (
  SELECT rid, i, md5(array_to_string(list_slice(l, i, i + 34), ' ')) AS h
  FROM (SELECT rid, l, unnest(range(1, len(l) - 33)) AS i FROM d)),
r AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS i FROM g JOIN r USING (h)),
m AS (SELECT rid, list(i) AS gone FROM c GROUP BY rid),
k AS (
  SELECT doc_id, l, CASE WHEN gone IS NULL THEN l ELSE list_filter(l, lambda x, j: NOT list_contains(gone, j)) END AS kept
  FROM d LEFT JOIN m USING (rid))
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_words, CAST(len(l) - len(kept) AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM k
"""

# Phrases: every run of 1 to 3 words of a piece counted by its words.
_OP11 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS l FROM p),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(l) - k + 2), lambda i: l[i:i + k - 1])) AS g
  FROM w, (VALUES (1), (2), (3)) s(k) WHERE len(l) >= k),
f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.g, c.f AS a, cut, l.f AS l, r.f AS r,
         CAST((1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM c, (VALUES (1), (2)) s(cut)
  JOIN f l ON l.lang = c.lang AND l.g = c.g[1:cut]
  JOIN f r ON r.lang = c.lang AND r.g = c.g[cut + 1:]
  WHERE cut < c.k),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
inner_ AS (
  SELECT lang, g[1:2] AS g, f FROM c WHERE k = 3 UNION ALL SELECT lang, g[2:3], f FROM c WHERE k = 3),
longer AS (SELECT lang, g, max(f) AS f FROM inner_ GROUP BY ALL),
kept AS (
  SELECT worst.*, array_to_string(worst.g, ' ') AS phrase FROM worst LEFT JOIN longer USING (lang, g)
  WHERE longer.f IS NULL OR 100 * longer.f < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang)
QUALIFY rank <= 2000
"""

_OP12 = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""

# Lexical search: every document that shares a term with an item is scored.
_OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS l
  FROM documents),
i AS (
  SELECT row_number() OVER () AS item, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS l
  FROM benchmark),
q AS (SELECT item, term, count(*) AS times FROM (SELECT item, unnest(l) AS term FROM i) GROUP BY ALL),
s AS (SELECT count(*) AS big_n, CAST(sum(len(l)) AS BIGINT) AS big_l FROM d WHERE len(l) > 0),
m AS (SELECT row, doc_id, 25 + (75 * len(l) * big_n) // big_l AS m FROM d, s WHERE len(l) > 0),
v AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(l) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM v GROUP BY term), s),
r AS (
  SELECT item, row, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN v USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM r JOIN i USING (item) JOIN m USING (row) WHERE score > 0
QUALIFY rank <= 10
"""

ORACLE = {"op5_chat": _OP5, "op6_warc": _OP6, "op7_substrings": _OP7, "op11_phrases": _OP11, "op12_exact": _OP12, "op13_search": _OP13}
