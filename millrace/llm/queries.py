"""The registered query of each operator: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import new_folder, table
from millrace.llm.cotraining import quality_scores
from millrace.llm.html_content import extracted, train
from millrace.llm.manifest import verified_manifest
from millrace.llm.mixing import mixed_rates
from millrace.llm.near_duplicates import near_duplicates
from millrace.llm.nearest import nearest
from millrace.llm.packing import packed
from millrace.llm.phrases import mined
from millrace.llm.pii import personal_data
from millrace.llm.quality import quality_rules
from millrace.llm.substrings import without_repeats
from millrace.llm.url_lists import host_of, path_of, temporal_list_join
from millrace.llm.warc import read_archives, write_archives


def op1_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"), train(spark))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "log_ppl", "low", "high"
    )


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents")).drop("found")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures, fetched when the event of their number happened.

    The list is made of events as well: an error adds, a sign-up removes, and the page
    numbered like the user gives the pattern: its host, its domain, or its first folder.
    """
    pages, events = table(spark, sf_dir, "pages"), table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    times = events.select(F.col("event_id").alias("page_id"), at.alias("fetched_us"))
    captures = pages.select("page_id", "url").join(times, "page_id", "left")
    host, kind = host_of(F.col("url")), F.col("event_id") % 3
    folder = F.element_at(F.split(path_of(F.col("url")), "/"), 2)
    pattern = F.when(kind == 0, F.concat(F.lit("host="), host)).when(kind == 1, F.concat(F.lit("domain="), F.regexp_replace(host, r"^[^.]+\.", ""))).otherwise(F.concat(F.lit("prefix="), host, F.lit("/"), folder))
    named = events.filter("event_type in ('error', 'signup')").join(pages.select(F.col("page_id").alias("user_id"), "url"), "user_id")
    entries = named.select(pattern.alias("pattern"), at.alias("at"), F.when(F.col("event_type") == "error", "add").otherwise("remove").alias("action"))
    return temporal_list_join(captures, entries, at="fetched_us")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: Domains of the labelled table, and the shares of tokens that training should see.
DOMAIN = "case when toxic = 1 then 'toxic' when quality = 1 then 'clean' when quality = 0 then 'junk' end"
TARGETS = {"clean": 0.95, "junk": 0.05, "toxic": 0.0}


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = mixed_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.expr(DOMAIN), TARGETS)
    shares = [F.col("posterior")[k].alias(f"p_{name}") for k, name in enumerate(TARGETS)]
    left = [F.col("left")[k].alias(f"left_{name}") for k, name in enumerate(TARGETS)]
    return rates.select("doc_id", "n_tokens", *shares, "rate", *left)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), good)
    return scores.withColumn("kept", F.col("score") >= 0.5)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = without_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(table(spark, sf_dir, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return verified_manifest(table(spark, sf_dir, "documents"), tampered)


def op13_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), folder)
    records = read_archives(spark, folder, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_content": op1_html_content,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_quality_rules": op3_quality_rules,
    "op4_personal_data": op4_personal_data,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_url_filters": op6_url_filters,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_source_mixing": op8_source_mixing,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_warc_archives": op13_warc_archives,
}

def _manifest_sql(levels: int = 5, fanout: int = 16) -> str:
    """Trees level by level: up to ``fanout ** levels`` rows a source, and as many sources."""
    fields = ("doc_id", "source", "lang", "n_chars", "text")

    def leaf(text: str) -> str:
        values = [text if f == "text" else f"{f}::VARCHAR" for f in fields]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    # CRC-32, bit by bit, of the digits of an id.
    step = "CASE WHEN {c} & 1 = 1 THEN xor({c} >> 1, 3988292384) ELSE {c} >> 1 END"
    folded = "c0"
    ctes = ["crc0 AS (SELECT range AS byte, range::BIGINT AS c0 FROM range(256))"]
    for k in range(8):
        ctes.append(f"crc{k + 1} AS (SELECT byte, {step.format(c=folded)} AS c{k + 1} FROM crc{k})")
        folded = f"c{k + 1}"
    ctes.append("crcs AS (SELECT list(c8 ORDER BY byte) AS t FROM crc8)")
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)), "
        "lambda c, d: xor(c >> 8, t[(xor(c, d) & 255) + 1])), 4294967295)"
    )
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes.append(
        f"leaves AS (SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf('text')} AS digest, "
        f"CASE WHEN text IS NOT NULL AND {crc} % 5 = 0 THEN {leaf(lowered)} END AS changed FROM documents, crcs)"
    )
    ctes.append("d0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos FROM leaves)")

    def climb(first: str, name: str) -> None:
        ctes.append(f"{name}0 AS (SELECT tree, pos, digest FROM {first})")
        for k in range(levels):
            ctes.append(
                f"{name}s{k} AS (SELECT *, count(*) OVER (PARTITION BY tree) = 1 AS lone, "
                f"coalesce(string_agg(digest, '') OVER (PARTITION BY tree, pos // {fanout} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                f"coalesce(string_agg(digest, '') OVER (PARTITION BY tree, pos // {fanout} ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"
            )
            ctes.append(
                f"{name}{k + 1} AS (SELECT tree, pos // {fanout} AS pos, CASE WHEN any_value(lone) THEN any_value(digest) "
                f"ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest FROM {name}s{k} GROUP BY tree, pos // {fanout})"
            )

    climb("d0", "a")
    ctes.append(f"tops AS (SELECT tree AS source, '' AS tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos FROM a{levels})")
    climb("tops", "b")
    ctes.append("w0 AS (SELECT doc_id, d0.tree, d0.pos, d0.digest AS leaf, coalesce(changed, d0.digest) AS fold, '' AS proof, tops.pos AS top, tops.digest AS subroot FROM d0 JOIN tops ON d0.tree = tops.source)")
    for k in range(2 * levels):
        name, level = ("a", k) if k < levels else ("b", k - levels)
        place, tree = ("w.pos", "w.tree") if k < levels else ("w.top", "''")
        ctes.append(
            f"w{k + 1} AS (SELECT w.* REPLACE (CASE WHEN lone THEN fold ELSE sha256(l || fold || r) END AS fold, "
            f"proof || CASE WHEN lone THEN '' ELSE l || r END AS proof) FROM w{k} w JOIN {name}s{level} s "
            f"ON s.tree = {tree} AND s.pos = {place} // {fanout**level})"
        )
    return (
        "WITH " + ",\n".join(ctes) + f" SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, "
        f"fold AS folded_root, fold = digest AS verified FROM w{2 * levels}, b{levels}"
    )


_DIGEST = "sha1(coalesce(html, ''))"

#: Where SQL says the same.
ORACLE_SQL: dict[str, str] = {
    "op6_url_filters": r"""
WITH captures AS (
    SELECT page_id, url, epoch_us(ts) AS fetched_us FROM pages LEFT JOIN events ON page_id = event_id
), named AS (
    SELECT event_id % 3 AS kind, event_type, epoch_us(ts) AS dated,
        regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1) AS host,
        split_part(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/', 2) AS folder
    FROM events JOIN pages ON page_id = user_id WHERE event_type IN ('error', 'signup')
), entries AS (
    SELECT DISTINCT CASE kind WHEN 0 THEN 'host=' || host
            WHEN 1 THEN 'domain=' || regexp_replace(host, '^[^.]+\.', '') ELSE 'prefix=' || host || '/' || folder END AS pattern,
        dated, CASE event_type WHEN 'error' THEN 'add' ELSE 'remove' END AS action
    FROM named
), ordered AS (
    SELECT *, lead(dated) OVER (PARTITION BY pattern ORDER BY dated, action) AS until FROM entries
), intervals AS (
    SELECT * FROM ordered WHERE action = 'add' AND (until IS NULL OR until > dated)
), parts AS (
    SELECT DISTINCT url, fetched_us, regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1) AS host,
        list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS steps
    FROM captures WHERE url IS NOT NULL AND fetched_us IS NOT NULL
), looked AS (
    SELECT url, fetched_us, 'host=' || host AS pattern FROM parts WHERE host <> ''
    UNION ALL
    SELECT url, fetched_us, 'domain=' || array_to_string(labels[k:], '.') FROM (
        SELECT *, unnest(range(1, len(labels))) AS k FROM (SELECT *, string_split(host, '.') AS labels FROM parts WHERE host <> ''))
    UNION ALL
    SELECT url, fetched_us, 'prefix=' || host || '/' || array_to_string(steps[:k], '/') FROM (
        SELECT *, unnest(range(1, len(steps) + 1)) AS k FROM parts WHERE host <> '')
), found AS (
    SELECT url, fetched_us, count(*) AS n, string_agg(pattern, ',' ORDER BY pattern) AS patterns FROM (
        SELECT DISTINCT url, fetched_us, pattern FROM looked JOIN intervals USING (pattern)
        WHERE dated <= fetched_us AND (until IS NULL OR fetched_us < until)) GROUP BY ALL
)
SELECT page_id, c.url, c.fetched_us, coalesce(n, 0) AS n_active, coalesce(patterns, '') AS patterns, coalesce(n, 0) > 0 AS blocked
FROM captures c LEFT JOIN found f ON c.url = f.url AND c.fetched_us = f.fetched_us
""",
    "op11_phrase_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), places AS (
    SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM worded, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m
), f AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS n FROM places GROUP BY ALL
), totals AS (
    SELECT lang, sum(n) AS n FROM f WHERE m = 1 GROUP BY lang
), candidates AS (
    SELECT lang, m, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND n >= 100
), taken AS (
    SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN (
        SELECT lang, a, array_to_string(w[1:m - 1], ' ') AS phrase FROM candidates UNION ALL
        SELECT lang, a, array_to_string(w[2:m], ' ') FROM candidates) x ON x.lang = c.lang AND x.phrase = c.phrase AND x.a >= c.a
), cuts AS (
    SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:m], ' ') AS rest
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates ANTI JOIN taken USING (lang, phrase))
), scored AS (
    SELECT c.lang, c.phrase, a, h.n AS l, r.n AS r, t.n::BIGINT AS n, (1000::HUGEINT * a * t.n // (h.n::HUGEINT * r.n))::BIGINT AS score
    FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = head JOIN f r ON r.lang = c.lang AND r.phrase = rest JOIN totals t ON t.lang = c.lang
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM scored QUALIFY rank <= 2000
""",
    "op12_merkle_manifest": _manifest_sql(),
    "op13_warc_archives": f"""
WITH digested AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, {_DIGEST} AS hex, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS kept FROM pages
)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (((('0x' || substr(hex, (k // 4)::INTEGER * 5 + 1, 5))::BIGINT >> (5 * (3 - k % 4))::INTEGER) & 31) + 1), 1)), '') AS payload_digest,
    CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM digested
""",
}

#: Words of documents, upper-case ASCII letters as they are or in lower case.
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL["op7_near_duplicates"] = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS shingles
    FROM words
),
single AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reached(doc_id, node) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.node = links.a
),
components AS (SELECT doc_id, min(node) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, len(shingles) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN components USING (doc_id)
"""

ORACLE_SQL["op10_substring_dedup"] = f"""
WITH words AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS head FROM words),
windows AS (SELECT doc_id, head, row_number() OVER (PARTITION BY array_to_string(w[head:head + 19], ' ') ORDER BY doc_id, head) AS turn FROM starts),
removed AS (SELECT DISTINCT doc_id, head + k AS place FROM windows, range(20) AS t(k) WHERE turn > 1),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words),
left_over AS (
    SELECT doc_id, count(removed.place) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (removed.place IS NULL) AS kept
    FROM placed LEFT JOIN removed USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN left_over USING (doc_id)
"""
