"""Registered queries: thin digests of what the operators return, with SQL where it can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from statloom.llm import bpe, conversation_trie, exact_dedup, lm, near_dedup, packing, phrases, pii, quality, repeats, secret_scan, sharding, toxicity
from statloom.llm.text import documents

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


def _folded(text: str) -> str:
    """SQL for white space runs as one blank."""
    return f"regexp_replace(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')"


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenise(documents(spark, sf_dir), WORD_BPE)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


@query("op2_string_kernel_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, model).select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query(
    "op3_unit_hash_repeats",
    rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    p AS (SELECT doc_id, regexp_extract_all(text, '[^\n.!?]*[.!?]*\n?') AS parts FROM d),
    u AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM p),
    o AS (SELECT doc_id, sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i) AS stop, length(part) AS n,
                 trim(regexp_replace(lower(part), '[\x20\x09-\x0D]+', ' ', 'g')) AS flat
          FROM u WHERE part <> ''),
    c AS (SELECT doc_id, stop - n AS start, stop, flat, length(flat) - length(replace(flat, ' ', '')) + 1 AS words,
                 row_number() OVER (PARTITION BY doc_id ORDER BY stop) AS place
          FROM o WHERE flat <> ''),
    r AS (SELECT *, row_number() OVER (PARTITION BY flat ORDER BY doc_id, start) AS rank FROM c),
    l AS (SELECT *, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM r WHERE rank > 1),
    q AS (SELECT *, sum(words) OVER (PARTITION BY doc_id, run) AS run_words FROM l),
    x AS (SELECT doc_id, count(*) AS n_removed, sum(stop - start) AS chars_removed,
                 string_agg(CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start) AS removed
          FROM q WHERE run_words >= {repeats.LEAST_RUN} GROUP BY doc_id),
    n AS (SELECT doc_id, count(*) AS n_units FROM o GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed,
           CAST(coalesce(chars_removed, 0) AS BIGINT) AS chars_removed, coalesce(removed, '') AS removed
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN x USING (doc_id)""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = repeats.repeated_spans(documents(spark, sf_dir))
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    listed = F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return spans.select(
        "doc_id",
        F.col("n_units").cast("long").alias("n_units"),
        F.size("removed").cast("long").alias("n_removed"),
        length.alias("chars_removed"),
        F.array_join(listed, ",").alias("removed"),
    )


@query("op4_pair_index_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), WORD_BPE, decoded="decoded")
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return ids.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op5_dart_minhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, sf_dir))


@query(
    "op6_stupid_backoff",
    rf"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
    p AS (SELECT *, lag(word) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM w),
    one AS (SELECT word, count(*) AS n FROM w GROUP BY word),
    two AS (SELECT before, word, count(*) AS n FROM p WHERE before IS NOT NULL GROUP BY before, word),
    s AS (SELECT p.doc_id, CASE WHEN p.before IS NULL THEN ln(o.n / (SELECT count(*) FROM w))
                                WHEN t.n >= {lm.LEAST} THEN ln(t.n / b.n)
                                ELSE ln({lm.BACKOFF}) + ln(o.n / (SELECT count(*) FROM w)) END AS score
          FROM p JOIN one o ON o.word = p.word LEFT JOIN one b ON b.word = p.before
                 LEFT JOIN two t ON t.before = p.before AND t.word = p.word)
    SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, round(coalesce(sum(score), 0), 4) + 0.0 AS log_score,
           round(sum(score) / nullif(len(words), 0), 6) AS mean_log
    FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id, words""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm.scored(documents(spark, sf_dir))
    return scores.withColumns({"log_score": F.round("log_score", 4) + F.lit(0.0), "mean_log": F.round("mean_log", 6)})


@query(
    "op7_chunk_recipe_dedup",
    f"""WITH d AS (SELECT doc_id, sha256({_folded("text")}) AS text_sha256 FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256)""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


@query("op8_crf_personal_data")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir))
    kinds = F.transform("base", lambda s: s["kind"])
    return found.select(
        "doc_id",
        *[(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.concat("base", "added")).alias("spans"),
    )


_MEASURED = r"""
    d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
    w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i
          FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d)),
    g AS (SELECT doc_id, i, word, lead(word) OVER o AS word2, lead(word, 2) OVER o AS word3
          FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    t AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, word2, word3) AS n FROM g WHERE word3 IS NOT NULL),
    h AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
          FROM t, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id),
    ln AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
           FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
           WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
    n AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY doc_id),
    m AS (SELECT d.doc_id, lang, source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
                 length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                 coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
                 coalesce(n_repeat_words, 0) AS n_repeat_words
          FROM d LEFT JOIN n USING (doc_id) LEFT JOIN ln USING (doc_id) LEFT JOIN h USING (doc_id)),
    f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                 n_symbols / greatest(word_chars, 1) AS symbol_share, n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
                 n_repeat_words / greatest(n_words, 1) AS repeat_share, word_chars / greatest(n_words, 1) AS long_words
          FROM m)"""


def _quality_sql() -> str:
    """Quartiles of the bucketed values at three levels, then the same fences."""
    names = list(quality.MEASURES)
    bucket = f"CASE WHEN value > 0 THEN ceil(ln(value) / ln({quality.GROWTH}) - 1e-9) END"
    values = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {m} AS value FROM f WHERE NOT base_failed" for m in names)
    levels, joins = [], []
    for level, keys in (("source", ["lang", "source"]), ("lang", ["lang"]), ("everything", [])):
        by = ", ".join([*keys, "measure"])
        width = "CASE WHEN q3 > q1 THEN q3 - q1 ELSE d9 - q1 END"
        cuts = ", ".join(f"max(CASE WHEN measure = '{m}' THEN q3 + 3 * greatest({width}, {quality.WIDTHS[m]}) END) AS {m}_cut" for m in names)
        levels.append(
            f"""{level}_q AS (SELECT {by}, count(*) AS rows,
                    quantile_disc(coalesce(pow({quality.GROWTH}, bucket), 0), 0.25) AS q1,
                    quantile_disc(coalesce(pow({quality.GROWTH}, bucket), 0), 0.75) AS q3,
                    quantile_disc(coalesce(pow({quality.GROWTH}, bucket), 0), 0.9) AS d9 FROM b GROUP BY {by}),
                {level}_t AS (SELECT {"".join(k + ", " for k in keys)}max(rows) AS rows, {cuts} FROM {level}_q {"GROUP BY " + ", ".join(keys) if keys else ""})"""
        )
        on = " AND ".join(f"f.{k} IS NOT DISTINCT FROM {level}_t.{k}" for k in keys) or "TRUE"
        joins.append(f"LEFT JOIN {level}_t ON {on}")
    least = quality.LEAST_ROWS
    limit = lambda m: (
        f"CASE WHEN source_t.rows >= {least} THEN source_t.{m}_cut WHEN lang_t.rows >= {least} THEN lang_t.{m}_cut "
        f"WHEN everything_t.rows >= {least} THEN everything_t.{m}_cut ELSE {quality.MEASURES[m]} END"
    )
    good = " AND ".join(f"f.{m} <= {limit(m)}" for m in names)
    return f"""WITH {_MEASURED},
    v AS ({values}), b AS (SELECT *, {bucket} AS bucket FROM v), {", ".join(levels)}
    SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND {good} AS kept
    FROM f {" ".join(joins)}"""


@query("op9_adaptive_quality", _quality_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir), own=True).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op10_two_pass_shuffle")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shuffled_shards(documents(spark, sf_dir)).select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: Unsigned crc32 of a decimal number, by the polynomial, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({id} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda x, step: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295::BIGINT)"""


@query(
    "op11_peeled_prefix_trie",
    f"""WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id
                     ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
          FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC32.format(id="conv_id")} % 6 AS h
          FROM (SELECT DISTINCT conv_id FROM t)),
    r AS (SELECT c.conv_id, t.pos, role, text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
          UNION ALL SELECT c.conv_id, t.pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h
          UNION ALL SELECT conv_id, 0, '', '' FROM c),
    s AS (SELECT conv_id, row_number() OVER w - 1 AS depth, length(text) AS length, lead(pos) OVER w IS NULL AS ends,
                 md5(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER w) AS node
          FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
    m AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM s),
    n AS (SELECT depth, node, parent, min(conv_id) AS conv_id, count(*) AS n_convs, max(length) AS length,
                 coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ids
          FROM m GROUP BY depth, node, parent),
    k AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
    f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (depth, node)),
    x AS (SELECT a.depth, a.node, count(*) FILTER (f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.length) AS saved_tokens
          FROM f JOIN m a ON a.conv_id = f.conv_id AND a.depth <= f.depth GROUP BY a.depth, a.node)
    SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, x.n_leaves,
           CAST(x.saved_tokens AS BIGINT) AS saved_tokens, sha256(f.ids) AS ends_sha256
    FROM f JOIN x USING (depth, node) LEFT JOIN f p ON p.node = f.parent AND p.depth = f.depth - 1""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.turn_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversation_trie.prefix_trie(conversation_trie.shared_openings(turns)).drop("node")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@query(
    "op12_de_bruijn_phrases",
    rf"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
                               translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS text FROM documents),
    p AS (SELECT doc, lang, unnest(parts) AS part, generate_subscripts(parts, 1) AS piece
          FROM (SELECT doc, lang, regexp_split_to_array(text, '[.,;:!?
-
]') AS parts FROM d)),
    w AS (SELECT doc, piece, lang, unnest(words) AS w1, generate_subscripts(words, 1) AS i
          FROM (SELECT doc, piece, lang, regexp_extract_all(part, '[^ 	]+') AS words FROM p)),
    g AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY doc, piece ORDER BY i)),
    f AS (SELECT lang, w1 AS phrase, 1 AS size, count(*) AS f, NULL AS h, NULL AS t FROM g GROUP BY ALL
          UNION ALL SELECT lang, w1 || ' ' || w2, 2, count(*), w1, w2 FROM g WHERE w2 IS NOT NULL GROUP BY ALL
          UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*), w1 || ' ' || w2, w2 || ' ' || w3
                    FROM g WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3),
    c AS (SELECT lang, phrase, size, f AS a, h, t, split_part(phrase, ' ', 1) AS x, split_part(phrase, ' ', size) AS z
          FROM f WHERE size > 1 AND f >= 10),
    k AS (SELECT c.lang, c.phrase, c.size, a, 1 AS cut, l.f AS l, r.f AS r
          FROM c JOIN f l ON l.lang = c.lang AND l.phrase = c.x JOIN f r ON r.lang = c.lang AND r.phrase = c.t
          UNION ALL SELECT c.lang, c.phrase, c.size, a, 2, l.f, r.f
          FROM c JOIN f l ON l.lang = c.lang AND l.phrase = c.h JOIN f r ON r.lang = c.lang AND r.phrase = c.z WHERE c.size = 3),
    s AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM k),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    v AS (SELECT lang, part, max(a) AS most FROM (SELECT lang, a, unnest([h, t]) AS part FROM c WHERE size = 3) GROUP BY ALL),
    o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
          FROM b LEFT JOIN v ON v.lang = b.lang AND v.part = b.phrase WHERE most IS NULL OR 100 * most < 50 * a),
    u AS (SELECT e.lang, e.phrase AS one, x.phrase AS two
          FROM c e JOIN c x ON x.lang = e.lang AND x.h = e.t AND x.a = e.a JOIN f ON f.lang = e.lang AND f.phrase = e.t AND f.f = e.a
          WHERE e.size = 3 AND x.size = 3),
    y AS (SELECT lang, one AS head, one AS phrase, 3 AS words FROM u WHERE (lang, one) NOT IN (SELECT (lang, two) FROM u)
          UNION ALL SELECT y.lang, y.head, u.two, y.words + 1 FROM y JOIN u ON u.lang = y.lang AND u.one = y.phrase),
    q AS (SELECT lang, phrase, max(words) OVER (PARTITION BY lang, head) AS words FROM y),
    n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang)
    SELECT o.lang, rank, o.phrase, a, l, r, n, score, CAST(coalesce(q.words, o.size) AS BIGINT) AS path_words
    FROM o JOIN n USING (lang) LEFT JOIN q ON q.lang = o.lang AND q.phrase = o.phrase WHERE rank <= 2000""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def _secret_sql() -> str:
    """Matches with places from the gaps between them, then the same lists."""
    parts = []
    for order, (kind, rule) in enumerate(secret_scan.RULES.items()):
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        parts.append(
            f"""SELECT doc, '{kind}' AS kind, {order} AS place, unnest(hits) AS hit, unnest(subs) AS sub, unnest(gaps[:len(hits)]) AS gap,
                generate_subscripts(hits, 1) AS i, {rule.least} AS least
            FROM (SELECT doc, regexp_extract_all(text, {pattern}) AS hits, regexp_extract_all(text, {pattern}, {rule.group}) AS subs,
                         regexp_split_to_array(text, {pattern}) AS gaps FROM d WHERE regexp_matches(text, {pattern}))"""
        )
    base = ", ".join(f"'{k}'" for k in secret_scan.BASE)
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secret_scan.BASE)
    zeros = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secret_scan.BASE)
    listed = "string_agg(kind || ':' || CAST(stop - length(hit) AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY stop - length(hit), place)"
    return f"""WITH d AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS text FROM documents),
    h AS ({" UNION ALL ".join(parts)}),
    s AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc, kind ORDER BY i) AS stop FROM h),
    r AS (SELECT doc, {counts}, coalesce({listed} FILTER (kind IN ({base})), '') AS base, {listed} AS spans
          FROM s WHERE length(sub) >= least GROUP BY doc)
    SELECT doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN r USING (doc)"""


@query("op13_blob_ledger_secrets", _secret_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find(documents(spark, sf_dir))
    kinds = F.transform("findings", lambda f: f["kind"])
    base = F.filter("findings", lambda f: f["kind"].isin(*secret_scan.BASE))
    return found.select(
        "doc_id",
        *[(F.size("findings") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in secret_scan.BASE],
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("findings")).alias("spans"),
    )
