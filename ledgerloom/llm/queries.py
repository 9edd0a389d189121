"""Registered queries: thin contracts over the operators of this folder."""

import public_tokenizers
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe,
    chat,
    decontamination,
    exact_dedup,
    licenses,
    packing,
    periodicity,
    quality,
    sharding,
    simhash,
    toxicity,
    warc,
    whitening,
)
from ledgerloom.llm.common import held_out, table
from ledgerloom.llm.registry import ORACLES, QUERIES, query  # noqa: F401

VOCABULARY = "byte_bpe_50k.json"


@query("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.with_score(documents.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op10_simhash")
def op10_simhash(spark, sf_dir):
    return simhash.groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@query(
    "op7_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER copies AS keep_id, count(*) OVER copies AS group_size,
        doc_id = max(doc_id) OVER copies AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW copies AS (PARTITION BY coalesce(text, ''))
    """,
)
def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query("op3_quality")
def op3_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = quality.train(documents, table(spark, sf_dir, "labels"))
    scored = quality.with_score(documents.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query("op4_bpe")
def op4_bpe(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encoded_documents(documents, public_tokenizers.path(VOCABULARY)).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op5_decontamination",
    r"""
    WITH cut AS (
        SELECT 'd' AS kind, doc_id AS id,
            regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        UNION ALL
        SELECT 'b', item_id,
            regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
    ), items AS (SELECT id, w, least(5, len(w)) AS n FROM cut WHERE kind = 'b' AND len(w) > 0),
    own AS (
        SELECT DISTINCT id, n, unnest(list_transform(range(1, len(w) - n + 2),
            lambda i: array_to_string(w[i : i + n - 1], ' '))) AS s
        FROM items
    ), lengths AS (SELECT DISTINCT n FROM items), shingles AS (
        SELECT DISTINCT id, n, unnest(list_transform(range(1, len(w) - n + 2),
            lambda i: array_to_string(w[i : i + n - 1], ' '))) AS s
        FROM cut, lengths WHERE kind = 'd' AND len(w) >= n
    ), sizes AS (SELECT id, count(*) AS n FROM own GROUP BY id)
    SELECT d.id AS doc_id, b.id AS item_id, CAST(any_value(sizes.n) AS INTEGER) AS n_shingles,
        CAST(count(*) AS INTEGER) AS n_shared, count(*) / any_value(sizes.n) AS containment
    FROM shingles d JOIN own b ON d.s = b.s AND d.n = b.n JOIN sizes ON sizes.id = b.id
    GROUP BY d.id, b.id HAVING count(*) >= 0.8 * any_value(sizes.n)
    """,
)
def op5_decontamination(spark, sf_dir):
    return decontamination.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


def _rows(pairs):
    return "VALUES " + ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in pairs.items())


_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query(
    "op6_licenses",
    rf"""
    WITH phrases AS (
        SELECT regexp_extract_all(p, {_WORDS}) AS p, label
        FROM ({_rows(licenses.PHRASES)}) AS v(p, label)
    ), templates AS (
        SELECT row_number() OVER () AS id, regexp_extract_all(translate(t, {_LOWER}), {_WORDS}) AS t, label
        FROM ({_rows(licenses.TEMPLATES | licenses.NOTICES)}) AS v(t, label)
    ), cut AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORDS}) AS w
        FROM documents
    ), places AS (
        SELECT doc_id, label, unnest(list_filter(
            range(1, len(w) + 1), lambda i: w[i : i + len(p) - 1] = p)) - 1 AS word
        FROM cut, phrases
    ), own AS (
        SELECT id, label, len(list_distinct(t)) AS n, (len(t) * 5 + 3) // 4 AS span,
            unnest(list_distinct(t)) AS word
        FROM templates
    ), hits AS (
        SELECT doc_id, place, own.* FROM (
            SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM cut
        ) JOIN own USING (word)
    ), shares AS (
        SELECT doc_id, label, count(DISTINCT word) OVER (
            PARTITION BY doc_id, id ORDER BY place RANGE BETWEEN CURRENT ROW AND span - 1 FOLLOWING) / n AS share
        FROM hits
    ), found AS (
        SELECT doc_id, label, max(share) AS share FROM shares WHERE share >= 0.8 GROUP BY 1, 2
    ), based AS (
        SELECT doc_id, count(*) AS n, min(word) AS low, max(word) AS high,
            string_agg(DISTINCT label, ',' ORDER BY label) AS labels
        FROM places GROUP BY 1
    ), named AS (
        SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
            SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM found) GROUP BY 1
    ), best AS (SELECT doc_id, max(share) AS share FROM found GROUP BY 1)
    SELECT doc_id, len(w) AS n_words, coalesce(based.n, 0) AS n_base, based.low AS first_word,
        based.high AS last_word, coalesce(based.labels, '') AS base_labels,
        coalesce(named.labels, '') AS labels,
        CASE WHEN based.n > 0 THEN CAST(1 AS DOUBLE) ELSE coalesce(best.share, 0) END AS score
    FROM cut LEFT JOIN based USING (doc_id) LEFT JOIN named USING (doc_id)
    LEFT JOIN best USING (doc_id)
    """,
)
def op6_licenses(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    templates = licenses.prepare_templates(documents, licenses.template_table(spark))
    marked = licenses.with_licenses(documents, templates)
    base, found = F.col("licenses.base"), F.col("licenses.found")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = F.coalesce(F.array_max(found["containment"]), F.lit(0.0))
    return marked.select(
        "doc_id",
        F.col("licenses.n_words").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["word"]).alias("first_word"),
        F.array_max(base["word"]).alias("last_word"),
        joined(base["label"]).alias("base_labels"),
        joined(F.concat(base["label"], found["label"])).alias("labels"),
        F.when(F.size(base) > 0, 1.0).otherwise(best).alias("score"),
    )


@query(
    "op2_warc",
    """
    WITH hashed AS (
        SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
    ), bits AS (
        SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
            lpad(bin(strpos('0123456789abcdef', substr(h, i, 1)) - 1), 4, '0')), '') AS b
        FROM hashed
    ), firsts AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM bits)
    SELECT page_id, strlen(html) AS payload_bytes,
        array_to_string(list_transform(range(0, 32), lambda j: substr(
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
            + 16 * CAST(substr(b, 5 * j + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * j + 2, 1) AS INT)
            + 4 * CAST(substr(b, 5 * j + 3, 1) AS INT) + 2 * CAST(substr(b, 5 * j + 4, 1) AS INT)
            + CAST(substr(b, 5 * j + 5, 1) AS INT), 1)), '') AS payload_digest,
        CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to
    FROM firsts
    """,
)
def op2_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def _escaped_sql(text):
    """Text with doubled backslashes and one inside every control string."""
    out = rf"replace({text}, '\', '\\')"
    for control in chat.CONTROLS:
        out = f"replace({out}, '{control}', '<\\{control[1:]}')"
    return out


@query(
    "op8_chat",
    rf"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    ), apart AS (
        SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone FROM turns
    ), said AS (
        SELECT conv_id, count(*) AS n_turns,
            string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS whole,
            coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss,
            CAST(sum(length({_escaped_sql("role")}) + length({_escaped_sql("text")})
                + {len(chat.TURN + chat.SAYS + chat.END)}) AS BIGINT) AS formatted_chars
        FROM apart GROUP BY conv_id, alone
    )
    SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars,
        sha256(loss) AS loss_sha256, formatted_chars
    FROM said
    """,
)
def op8_chat(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = r"\### Assistant: </turn> ok"
    rows = F.array(
        *(F.struct(F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role")) for k, role in enumerate(("user", "assistant")))
    )
    extra = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.explode(rows).alias("r"))
    extra = extra.select("conv_id", "r.turn", "r.role", F.lit(probe).alias("text"))
    formatted = chat.format_conversations(
        conversations.unionByName(extra), public_tokenizers.path(VOCABULARY)
    )
    return formatted.select("conv_id", "read_back.*")


@query("op9_sharding")
def op9_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op13_periodicity")
def op13_periodicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # Of one document in ten the words from a on repeat the first p of them.
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    words = F.when(hashed % 10 == 0, words)
    g, n = F.floor(hashed / 10), F.size(words)
    changed = documents.select("doc_id", "text", words.alias("words"), g.alias("g"), n.alias("n"))
    changed = changed.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    changed = changed.withColumn("p", period)
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    places = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: place(i).cast("int"))
    repeated = F.array_join(F.transform(places, lambda i: F.get("words", i)), " ")
    text = F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text"))
    found = periodicity.with_runs(changed.select("doc_id", text.alias("text")))
    runs = F.col("periodicity.runs")
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    best = best.cast("struct<length:long,start:long,period:long>")
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.select("doc_id", "periodicity", best.alias("best"), lines.alias("lines"))
    text = F.concat(F.array_join("lines", "\n"), F.when(F.size("lines") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("periodicity.collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_packing")
def op12_packing(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack(table(spark, sf_dir, "documents"), path, end=2)
    crc = F.crc32("ids").alias("ids_crc32")
    return packed.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


@query("op11_whitening")
def op11_whitening(spark, sf_dir):
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.train(embeddings)
    rows = whitening.whiten(embeddings, model)
    rows = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    n, error, explained = (model.n, model.identity_error, model.explained) if model else (0, 0.0, [0.0])
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*map(F.lit, explained)), F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
