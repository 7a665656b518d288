"""Registered queries of the operators, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.catalog.registry import Query, table
from podium.llm import (
    alignment, byte_bpe, decontaminate, exact_dedup, jaccard_join, language, line_dedup, paragraph_dedup, periodic_runs,
    quality, secret_scan, url_filter, warc,
)
from podium.llm.work import ship, stored
from podium.session import utc, work_folder

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; its Python workers get the package."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = lambda spark, sf_dir: function(ship(utc(spark)), sf_dir)
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def fold(modulus: int) -> Column:
    """The fold of a document: a checksum of its id as text."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def _digest(kinds: tuple[str, ...]) -> Column:
    chosen = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query()
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    kinds = secret_scan.KINDS

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in kinds),
        F.sha2(_digest(kinds[:3]), 256).alias("base_sha256"),
        _digest(kinds).alias("spans"),
    )


@query()
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated_lines(table(spark, sf_dir, "documents"))


@query()
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), ranks_path(), split_pattern()).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "well_formed",
    )


_URL_FILTER = r"""
WITH p AS (
    SELECT page_id, TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * ((page_id * 7919) % 2592000) AS fetched_at,
           nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '') AS host,
           regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), h AS (SELECT DISTINCT host FROM p WHERE host IS NOT NULL),
pat AS (
    SELECT host AS pattern, (length(host) * 7 + ascii(substr(host, 3, 1))) % 100 AS u FROM h
    UNION SELECT host || '/en', (length(host) * 5 + ascii(substr(host, 4, 1))) % 100 FROM h
    UNION SELECT regexp_extract(host, '[^.]+[.][^.]+$'), length(host) % 100 FROM h
), ch AS (
    SELECT pattern, ts, min(event_type = 'error') AS added FROM pat JOIN events ON user_id = u
    WHERE event_type IN ('error', 'view') GROUP BY pattern, ts
), iv AS (
    SELECT pattern, regexp_extract(pattern, '^[^/]+') AS on_host, regexp_replace(pattern, '^[^/]+', '') AS on_path,
           ts AS valid_from, lead(ts) OVER (PARTITION BY pattern ORDER BY ts) AS valid_to, added
    FROM ch
), met AS (
    SELECT DISTINCT page_id, pattern FROM p JOIN iv
    ON added AND fetched_at >= valid_from AND (valid_to IS NULL OR fetched_at < valid_to)
       AND (host = on_host OR ends_with(host, '.' || on_host))
       AND (on_path = '' OR path = on_path OR starts_with(path, on_path || '/'))
), found AS (SELECT page_id, string_agg(pattern, ',' ORDER BY pattern) AS entries FROM met GROUP BY page_id)
SELECT page_id, host, coalesce(entries, '') AS entries, entries IS NOT NULL AS listed FROM p LEFT JOIN found USING (page_id)
"""


@query(_URL_FILTER)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, fetched at a time that follows from its id, against lists whose changes are events of users.

    An ``error`` of a user puts the patterns that fall to the user on the list, a ``view`` takes them off.
    """
    seconds = F.lit(1_704_067_200) + (F.col("page_id") * 7919) % 2_592_000
    captures = table(spark, sf_dir, "pages").select("page_id", "url", F.timestamp_seconds(seconds).alias("fetched_at"))
    hosts = captures.select(url_filter.host_of("url").alias("host")).where("host is not null").distinct()

    def letter(place: int) -> Column:
        return F.ascii(F.substring("host", place, 1))

    size = F.length("host")
    patterns = hosts.select(F.col("host").alias("pattern"), ((size * 7 + letter(3)) % 100).alias("user_id"))
    patterns = patterns.union(hosts.select(F.concat("host", F.lit("/en")), (size * 5 + letter(4)) % 100))
    patterns = patterns.union(hosts.select(F.regexp_extract("host", r"[^.]+[.][^.]+$", 0), size % 100)).distinct()
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("error", "view"))
    events = events.select("user_id", F.col("ts").cast("timestamp").alias("at"), (F.col("event_type") == "error").alias("added"))
    changes = events.join(patterns.withColumn("user_id", F.col("user_id").cast("long")), "user_id")
    found = url_filter.listed(captures, changes)
    return found.withColumn("entries", F.array_join("entries", ","))


_URL_DEPTHS = r"""
WITH p AS (
    SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '') AS h,
           '/p/q/r/' || (page_id % 3) || '/t' AS path
    FROM pages
), c AS (SELECT page_id, 'a.b.c.d.e.f.' || h AS host, path FROM p),
e AS (
    SELECT DISTINCT 'b.c.d.e.f.' || h AS on_host, '' AS on_path FROM p WHERE length(h) % 2 = 0
    UNION SELECT 'a.b.c.d.e.f.' || h, '/p/q/r' FROM p WHERE length(h) % 3 = 0
    UNION SELECT 'f.' || h, '/p/q/r/1/t' FROM p
), found AS (
    SELECT page_id, string_agg(on_host || on_path, ',' ORDER BY on_host || on_path) AS entries
    FROM c JOIN e ON (host = on_host OR ends_with(host, '.' || on_host))
       AND (on_path = '' OR path = on_path OR starts_with(path, on_path || '/'))
    WHERE on_host IS NOT NULL GROUP BY page_id
)
SELECT page_id, host, coalesce(entries, '') AS entries, entries IS NOT NULL AS listed FROM c LEFT JOIN found USING (page_id)
"""


@query(_URL_DEPTHS)
def url_filter_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages moved to long hosts and deep paths, against entries of as many labels and path parts."""
    pages = table(spark, sf_dir, "pages").select("page_id", url_filter.host_of("url").alias("h"))
    path = F.concat(F.lit("/p/q/r/"), (F.col("page_id") % 3).cast("string"), F.lit("/t"))
    captures = pages.select(
        "page_id", F.concat(F.lit("https://a.b.c.d.e.f."), "h", path).alias("url"), F.lit("2024-01-10 00:00:00").alias("fetched_at")
    )
    size = F.length("h")
    patterns = pages.where(size % 2 == 0).select(F.concat(F.lit("b.c.d.e.f."), "h").alias("pattern"))
    patterns = patterns.union(pages.where(size % 3 == 0).select(F.concat(F.lit("a.b.c.d.e.f."), "h", F.lit("/p/q/r"))))
    patterns = patterns.union(pages.select(F.concat(F.lit("f."), "h", F.lit("/p/q/r/1/t")))).distinct()
    found = url_filter.listed(captures, patterns.select("pattern", F.lit("2024-01-01 00:00:00").alias("at"), F.lit(True).alias("added")))
    return found.withColumn("entries", F.array_join("entries", ","))


@query()
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_classes(table(spark, sf_dir, "documents"))


_EXACT = r"""
WITH t AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""


@query(_EXACT)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS size, w[p : p + least(10, len(w)) - 1] AS win
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (
    SELECT doc_id, size, p, w[p : p + size - 1] AS win
    FROM (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size)
),
hit AS (SELECT doc_id, item_id, p, dw.size FROM dw JOIN iw ON dw.win = iw.win),
marked AS (
    SELECT doc_id, count(DISTINCT q) AS n_hit
    FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hit) GROUP BY doc_id
),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query(_DECONTAMINATION)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate(F.zip_with("hit_to", "hit_from", lambda e, b: e - b), F.lit(0), lambda a, x: a + x)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
    )


@query()
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(fold(3) != 1))
    scored = quality.score(docs, model)
    return scored.select("doc_id", (fold(3) == 1).alias("held_out"), "score", "predicted")


@query()
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs, fold(4) != 2)
    found = language.predict(docs, model)
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score", "accepted")


@query()
def op10_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.repeated_passages(table(spark, sf_dir, "documents"))


_WARC = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


@query(_WARC)
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, and what the records read back say."""
    folder = work_folder(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    records = stored(warc.read_archives(spark, folder, with_payload=False, strict=True), "records")

    def page(headers: str) -> Column:
        return F.element_at(headers, warc.PAGE_ID).cast("long")

    return warc.resolved(records).select(
        page("headers").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )


def alignment_models() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.aligned(table(spark, sf_dir, "documents"), *alignment_models())
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256")
    )


def rearranged(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the words of a tenth of the documents, picked by a checksum of the id, are made periodic."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    rows = rows.withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    begin = F.slice("w", F.lit(1), F.col("a").cast("int"))
    unit = F.slice("w", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    # The period is at most a third of the rest and one more, so a few copies of it fill the rest.
    rest = F.flatten(F.array_repeat(unit, F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    rest = F.slice(rest, F.lit(1), (F.col("n") - F.col("a")).cast("int"))
    made = F.array_join(F.concat(begin, rest), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(rearranged(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    longest = F.array_min(order)
    start, length, period = longest["s"], -longest["l"], longest["p"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
