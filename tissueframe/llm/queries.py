"""One query per operator over the given tables, and SQL checks where SQL can say the same.

A query reads whole tables, calls its operator with production parameters and
derives the digest columns of its contract from what the operator returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tissueframe.llm import decontaminate, language, linedup, packing, periods, personal, prefixes, quality, rules, secrets, sharding, simhash, substrings
from tissueframe.llm.textops import WORD, held_out


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    """The tokenizer file the contract names."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), tokenizer_path())


def op2_walk_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op3_trie_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op4_anchor_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.drop_repeated_passages(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op5_interleaved_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def op6_backoff_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = language.train(docs)
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op7_attention_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, folder, "labels"))
    return quality.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op8_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return linedup.drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op9_owned_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(_table(spark, folder, "documents"))


def op10_divergence_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    return rules.apply_rules(docs.select("doc_id", "text"), rules.references(docs)).drop("text")


def _grafted(rows: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Conversations that begin with the first turns of the one at the next lower multiple of ``every``."""
    base = F.col("conv_id") - F.col("conv_id") % every
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    donor = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, most))).over(Window.partitionBy("base"))
    rows = rows.withColumns({"base": base, "h": h})
    first = F.coalesce(donor, F.slice("turns", 1, 0))
    # Two steps: a window inside of slice would be evaluated beside it.
    return rows.withColumn("first", first).select(
        "conv_id", F.concat(F.slice("first", F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns")
    )


def op11_radix_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.prefix_trie(_grafted(prefixes.conversation_rows(_table(spark, folder, "conversations"))))


def op12_validated_personal(spark: SparkSession, folder: str) -> DataFrame:
    return personal.find_personal(_table(spark, folder, "documents"))


def _repeating(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by its id's CRC-32, goes on with a stretch of its own words from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h")).withColumn("g", F.floor(F.col("h") / 10))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("words", words).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.expr("if(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + floor((n - a) / (3 + g % 8))"))
    changed = "array_join(transform(sequence(0, n - 1), i -> get(words, cast(if(i < a, i, a + (i - a) % p) as int))), ' ')"
    return rows.select("doc_id", F.expr(f"if(n > 0, {changed}, text)").alias("text"))


def op13_synchronised_periods(spark: SparkSession, folder: str) -> DataFrame:
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return periods.collapse_runs(_repeating(_table(spark, folder, "documents"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.*",
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {f.__name__: f for f in (
    op1_harmonic_packing, op2_walk_decontamination, op3_trie_simhash, op4_anchor_substrings, op5_interleaved_shards,
    op6_backoff_language, op7_attention_quality, op8_line_runs, op9_owned_secrets, op10_divergence_rules,
    op11_radix_conversations, op12_validated_personal, op13_synchronised_periods,
)}

CHECKS = {
    # Every shortest run of min_words words from or to each line, spelt out as text; its first place decides.
    "op8_line_runs": """
        WITH docs AS (SELECT doc_id, text FROM documents WHERE text <> ''),
        lines AS (
            SELECT doc_id, generate_subscripts(a, 1) AS pos, unnest(a) AS line
            FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM docs)),
        shared AS (SELECT line FROM lines GROUP BY line HAVING count(*) > 1),
        counted AS (
            SELECT l.doc_id, l.pos, l.line, len(regexp_extract_all(l.line, '[^\\x20\\x09-\\x0D]+')) AS words,
                   l.line IN (SELECT line FROM shared) AS again
            FROM lines l),
        summed AS (
            SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM counted),
        spans AS (
            SELECT s.doc_id, s.pos AS a, min(e.pos) AS b
            FROM summed s JOIN summed e ON e.doc_id = s.doc_id AND e.pos >= s.pos
            WHERE s.again AND e.upto - s.upto + s.words >= 5 GROUP BY ALL
            UNION
            SELECT e.doc_id, max(s.pos) AS a, e.pos AS b
            FROM summed e JOIN summed s ON e.doc_id = s.doc_id AND e.pos >= s.pos
            WHERE e.again AND e.upto - s.upto + s.words >= 5 GROUP BY ALL),
        runs AS (
            SELECT p.doc_id, p.a, p.b, string_agg(l.line, chr(10) ORDER BY l.pos) AS run
            FROM spans p JOIN counted l ON l.doc_id = p.doc_id AND l.pos BETWEEN p.a AND p.b
            GROUP BY ALL),
        firsts AS (SELECT *, min((doc_id, a)) OVER (PARTITION BY run) AS f FROM runs),
        gone AS (
            SELECT DISTINCT l.doc_id, l.pos FROM firsts r
            JOIN lines l ON l.doc_id = r.doc_id AND l.pos BETWEEN r.a AND r.b
            WHERE r.f < (r.doc_id, r.a)),
        kept AS (
            SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
                   coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL), '') AS kept
            FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id)
        SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id""",
    # Windows spelt out as text; the smallest document of each keeps it.
    "op4_anchor_substrings": """
        WITH words AS (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS pos FROM words),
        windows AS (SELECT doc_id, pos, array_to_string(list_slice(w, pos, pos + 12), ' ') AS text FROM starts),
        firsts AS (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY text) AS first FROM windows),
        gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos FROM firsts WHERE first < doc_id),
        every AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM words),
        kept AS (
            SELECT e.doc_id, count(*) AS n_words, count(g.pos) AS n_removed,
                   string_agg(e.word, ' ' ORDER BY e.pos) FILTER (g.pos IS NULL) AS kept
            FROM every e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.pos = e.pos GROUP BY e.doc_id)
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id""",
    "op9_owned_secrets": """
        WITH kinds(kind, name, pattern, grp) AS (VALUES
            (0, 'assign', '(?i:(password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2),
            (1, 'access', 'AKIA[A-Z0-9]+', 0), (2, 'hex', '[0-9a-f]+', 0), (3, 'owned', '[A-Za-z0-9+/_-]{20,}', 0)),
        found AS (
            SELECT doc_id, source, kind, name, string_split_regex(text, pattern) AS gaps, regexp_extract_all(text, pattern, 0) AS hits,
                   CASE grp WHEN 2 THEN regexp_extract_all(text, pattern, 2) ELSE regexp_extract_all(text, pattern, 0) END AS vals
            FROM documents, kinds),
        parts AS (
            SELECT doc_id, source, kind, name, unnest(range(1, len(hits) + 1)) AS pos, length(unnest(list_slice(gaps, 1, len(hits)))) AS gap,
                   length(unnest(hits)) AS size, unnest(vals) AS val FROM found),
        placed AS (SELECT *, CAST(sum(gap + size) OVER (PARTITION BY doc_id, kind ORDER BY pos) AS BIGINT) AS stop FROM parts),
        spans AS (
            SELECT doc_id, source, kind, name, stop - size AS start, stop, val FROM placed
            WHERE CASE kind WHEN 0 THEN length(val) >= 8 WHEN 1 THEN length(val) >= 16 WHEN 2 THEN length(val) >= 32
                  ELSE regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Za-z]') END),
        owners AS (
            SELECT val, count(*) AS n, CAST(sum(docs) AS BIGINT) AS repos, count(*) >= 2 AND 100 * max(docs) < 90 * sum(docs) AS copied
            FROM (SELECT val, coalesce(source, '') AS owner, count(DISTINCT doc_id) AS docs FROM spans GROUP BY ALL) GROUP BY val),
        judged AS (
            SELECT s.*, o.n, o.repos, o.copied FROM spans s JOIN owners o ON o.val = s.val
            WHERE s.kind < 3 OR (NOT o.copied AND NOT EXISTS (
                SELECT 1 FROM spans b WHERE b.doc_id = s.doc_id AND b.kind < 3 AND b.start < s.stop AND s.start < b.stop))),
        listed AS (
            SELECT doc_id, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h,
                   count(*) FILTER (kind = 3) AS o, count(*) FILTER (NOT copied) AS live, count(*) FILTER (copied) AS copied,
                   string_agg(CAST(repos AS VARCHAR), ',' ORDER BY start, kind) AS repositories, string_agg(CAST(n AS VARCHAR), ',' ORDER BY start, kind) AS owners,
                   string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans,
                   string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < 3) AS base
            FROM judged GROUP BY doc_id)
        SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex, coalesce(o, 0) AS n_owned,
               coalesce(live, 0) AS n_live, coalesce(copied, 0) AS n_copied, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
               coalesce(repositories, '') AS repositories, coalesce(owners, '') AS owners
        FROM documents d LEFT JOIN listed l ON l.doc_id = d.doc_id""",
    # CRC-32 bit by bit; nodes by the list of turns spelt out.
    "op11_radix_conversations": """
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        steps AS (
            SELECT conv_id, list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))) AS s
            FROM (SELECT DISTINCT conv_id FROM turns)),
        convs AS (
            SELECT conv_id, xor(list_reduce(s, lambda r, x: CASE WHEN x >= 0 THEN xor(r, x)
                ELSE xor(r >> 1, 3988292384 * (r & 1)) END), 4294967295) % 4 AS h FROM steps),
        grafted AS (
            SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.pos <= c.h
            UNION ALL
            SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS d FROM grafted),
        paths AS (
            SELECT conv_id, d, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY d) AS path, text FROM placed
            UNION ALL SELECT conv_id, 0, [], '' FROM convs),
        lengths AS (SELECT conv_id, max(d) AS n FROM paths GROUP BY conv_id),
        nodes AS (
            SELECT p.path, p.d, min(p.conv_id) AS conv_id, count(*) AS n_convs, len(regexp_extract_all(min(p.text), '[^\\x20\\x09-\\x0D]+')) AS words,
                   string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (l.n = p.d) AS ends
            FROM paths p JOIN lengths l ON l.conv_id = p.conv_id GROUP BY p.path, p.d),
        children AS (SELECT list_slice(path, 1, d - 1) AS path, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
        whole AS (
            SELECT n.*, coalesce(c.n, 0) AS n_children, u.conv_id AS parent_conv_id
            FROM nodes n LEFT JOIN children c ON c.path = n.path AND c.d = n.d
            LEFT JOIN nodes u ON u.d = n.d - 1 AND u.path = list_slice(n.path, 1, n.d - 1)),
        above AS (SELECT *, unnest(range(0, d + 1)) AS up FROM whole),
        sums AS (
            SELECT list_slice(path, 1, up) AS path, up AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
            FROM above GROUP BY ALL)
        SELECT w.conv_id, w.d AS depth, w.parent_conv_id, w.n_convs, w.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
               sha256(coalesce(w.ends, '')) AS ends_sha256
        FROM whole w JOIN sums s ON s.d = w.d AND s.path = w.path""",
    "op12_validated_personal": """
        WITH kinds(kind, name, pattern, worth, named) AS (VALUES
            (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+', 80, 'e-?mail|contact|write to|courriel'),
            (1, 'ip', '[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)', 55, 'ip|host|address|server|login'),
            (2, 'card', '[0-9]([\\x20-]?[0-9])+', 75, 'card|visa|mastercard|amex|credit|debit|karte|carte'),
            (3, 'phone', '\\+[0-9][\\x20().0-9-]+[0-9]', 60, 'phone|tel|mobile|cell|call|fax|whatsapp|telefon|téléphone'),
            (4, 'iban', '[A-Z]{2}[0-9]{2}(\\x20?[A-Z0-9]{4}){2,7}(\\x20?[A-Z0-9]{1,3})?', 90, 'iban|account|bank|konto|compte'),
            (5, 'ssn', '[0-9]{3}-[0-9]{2}-[0-9]{4}', 35, 'ssn|social security|taxpayer'),
            (6, 'local', '\\(?[0-9][\\x20().0-9-]*[0-9]', 30, 'phone|tel|mobile|cell|call|fax|whatsapp|telefon|téléphone')),
        found AS (
            SELECT d.rowid AS row, k.*, string_split_regex(text, pattern) AS gaps, regexp_extract_all(text, pattern, 0) AS hits
            FROM (SELECT *, row_number() OVER () AS rowid FROM documents) d, kinds k),
        parts AS (
            SELECT row, kind, name, worth, named, unnest(range(1, len(hits) + 1)) AS pos, unnest(hits) AS val,
                   unnest(list_slice(gaps, 1, len(hits))) AS gap, unnest(list_slice(gaps, 2, len(hits) + 1)) AS next FROM found),
        placed AS (
            SELECT *, CAST(sum(length(gap) + length(val)) OVER (PARTITION BY row, kind ORDER BY pos) AS BIGINT) AS stop,
                   right(gap, 40) AS before, left(next, 40) AS behind, regexp_replace(val, '[^0-9]', '', 'g') AS digits,
                   regexp_replace(val, ' ', '', 'g') AS account FROM parts),
        judged AS (
            SELECT *, stop - length(val) AS start, NOT regexp_matches(before, '[\\p{L}0-9_+]$') AND NOT regexp_matches(behind, '^[\\p{L}0-9_]') AS alone,
                   least(100, worth
                     + CASE WHEN regexp_matches(before || ' ' || behind, '(?i)(^|[^\\p{L}0-9])(' || named || ')($|[^\\p{L}0-9])') THEN 35 ELSE 0 END
                     - CASE WHEN regexp_matches(before || ' ' || behind,
                         '(?i)(^|[^\\p{L}0-9])(version|isbn|issn|order|invoice|serial|build|release|chapter|section)($|[^\\p{L}0-9])') THEN 30 ELSE 0 END) AS score
            FROM placed),
        spans AS (
            SELECT * FROM judged WHERE CASE kind WHEN 0 THEN true
                WHEN 1 THEN len(list_filter(string_split(val, '.'), lambda p: coalesce(TRY_CAST(p AS HUGEINT), 256) > 255)) = 0
                WHEN 2 THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
                    CASE WHEN i % 2 = 1 THEN CAST(substr(digits, length(digits) - i + 1, 1) AS INT)
                    ELSE CAST(substr('0246813579', 1 + CAST(substr(digits, length(digits) - i + 1, 1) AS INT), 1) AS INT) END)) % 10 = 0
                WHEN 3 THEN length(digits) BETWEEN 10 AND 15
                WHEN 4 THEN alone AND length(account) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(string_split(
                    array_to_string(list_transform(string_split(substr(account, 5) || left(account, 4), ''),
                        lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE CAST(ascii(c) - 55 AS VARCHAR) END), ''), ''),
                    lambda c: CAST(c AS INT))), lambda r, c: (r * 10 + c) % 97) = 1
                WHEN 5 THEN alone AND left(val, 3) NOT IN ('000', '666') AND left(val, 3) < '900' AND substr(val, 5, 2) <> '00' AND right(val, 4) <> '0000'
                ELSE alone AND NOT regexp_matches(before, '[.,:/#-]$') AND NOT regexp_matches(behind, '^[-/:]|^[.,][0-9]')
                    AND length(digits) BETWEEN 7 AND 11
                    AND NOT regexp_matches(val, '^([0-9]{4}[.-][0-9]{1,2}[.-][0-9]{1,2}|[0-9]{1,2}[.-][0-9]{1,2}[.-][0-9]{4})$') END
            AND (kind < 4 OR score >= 60)),
        free AS (
            SELECT * FROM spans s WHERE kind < 4 OR NOT EXISTS (
                SELECT 1 FROM spans b WHERE b.row = s.row AND b.kind < s.kind AND b.start < s.stop AND s.start < b.stop)),
        listed AS (
            SELECT row, count(*) FILTER (kind = 0) AS k0, count(*) FILTER (kind = 1) AS k1, count(*) FILTER (kind = 2) AS k2, count(*) FILTER (kind = 3) AS k3,
                   count(*) FILTER (kind = 4) AS k4, count(*) FILTER (kind = 5) AS k5, count(*) FILTER (kind = 6) AS k6, count(*) FILTER (score >= 60) AS sure,
                   string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans,
                   string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < 4) AS base,
                   string_agg(CAST(score AS VARCHAR), ',' ORDER BY start, kind) AS scores
            FROM free GROUP BY row)
        SELECT d.doc_id, coalesce(k0, 0) AS n_email, coalesce(k1, 0) AS n_ip, coalesce(k2, 0) AS n_card, coalesce(k3, 0) AS n_phone,
               coalesce(k4, 0) AS n_iban, coalesce(k5, 0) AS n_ssn, coalesce(k6, 0) AS n_local, coalesce(sure, 0) AS n_sure,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
        FROM (SELECT *, row_number() OVER () AS rowid FROM documents) d LEFT JOIN listed l ON l.row = d.rowid""",
}
