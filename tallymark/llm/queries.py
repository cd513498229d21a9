"""The registered queries of this package, with production parameters over whole tables."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import (
    exact,
    fill_middle,
    html_text,
    language,
    lattice,
    lexical,
    mixing,
    neighbours,
    packing,
    pii,
    simhash,
    token_counts,
    toxicity,
)
from tallymark.llm.frames import held_out, importable, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Shares of the mix, in blocks of a round; other sources get ``DEFAULT_WEIGHT``.
MIX_WEIGHTS = {"src0": 12, "src1": 9, "src2": 8}
DEFAULT_WEIGHT, BLOCK_ROWS = 5, 16


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file: in the folder named by ``TALLYMARK_TOKENIZERS``, or of the installed package."""
    folder = os.environ.get("TALLYMARK_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def query(function: Query) -> Query:
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, MIX_WEIGHTS, default_weight=DEFAULT_WEIGHT, block_rows=BLOCK_ROWS)


@query
def op6_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = packing.pack(docs, vocabulary("word_bpe_49k.json"), with_ids=False)
    columns = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded")
    return packed.select("doc_id", *(F.col("piece")[c].alias(c) for c in columns))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(
        docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")),
        vocabulary("byte_bpe_50k.json"),
        keep_text=False,
    )
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    grouped = simhash.group(docs)
    return grouped.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def toxicity_model(docs: DataFrame, labels: DataFrame, settings: toxicity.Settings):
    """Trained on the labelled documents that are not held out."""
    learned = labels.where(~held_out(F.col("doc_id")))
    return toxicity.train(
        toxicity.sample(docs, learned, settings, key="doc_id", text="text", label="toxic"), settings
    )


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    settings = toxicity.Settings()
    leans, bias = toxicity_model(docs, table(spark, sf_dir, "labels"), settings)
    scored = toxicity.score(docs, leans, bias, settings, name="score", keep_text=False)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op8_host_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return extracted.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op2_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    filters = language.fit(docs.where(~held_out(F.col("doc_id"))))
    found = language.detect(docs.select("doc_id", "text"), filters, keep_text=False)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op3_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.detect(docs, pii.fit(docs), keep_text=False)
    base, further = F.col("pii.base"), F.col("pii.further")
    kinds = F.transform(base, lambda span: span["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.joined(base).cast("binary"), 256).alias("base_sha256"),
        pii.joined(F.concat(base, further)).alias("spans"),
    )


@query
def op10_lattice_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.link(table(spark, sf_dir, "embeddings"), 0.93)


@query
def op5_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(neighbours.build(rows), rows.where("vec_id % 20 = 0"), 20)


@query
def op11_polynomial_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.group(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op12_range_maximum_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.search(docs, table(spark, sf_dir, "benchmark"), 10)


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fim = {c: F.col("fim").getField(c) for c in ("n", "form", "prefix_chars", "middle_chars", "output")}
    output = fim.pop("output")
    return fill_middle.transform(docs, keep_text=False).select(
        "doc_id",
        *(column.alias(name) for name, column in fim.items()),
        F.sha2(output.cast("binary"), 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(output, fim["form"]).cast("binary"), 256).alias("restored_sha256"),
    )


_WEIGHT_SQL = "".join(f" WHEN '={source}' THEN {weight}" for source, weight in sorted(MIX_WEIGHTS.items()))

SQL["op1_pfair_mix"] = f"""
WITH RECURSIVE plain AS (
    SELECT doc_id, source, coalesce('=' || source, 'null') AS key FROM documents
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS i FROM plain
), sizes AS (
    SELECT key, CAST(CASE key{_WEIGHT_SQL} ELSE {DEFAULT_WEIGHT} END AS BIGINT) AS weight,
        CAST((count(*) + {BLOCK_ROWS - 1}) // {BLOCK_ROWS} AS BIGINT) AS n_blocks
    FROM plain GROUP BY key
), rounds AS (
    SELECT DISTINCT r FROM (
        SELECT CAST(0 AS BIGINT) AS r UNION ALL SELECT n_blocks // weight FROM sizes
        UNION ALL SELECT n_blocks // weight + 1 FROM sizes)
    WHERE EXISTS (SELECT 1 FROM sizes WHERE r * weight < n_blocks)
), shares AS (
    SELECT r, key, least(weight, n_blocks - r * weight) AS n, least(n_blocks, r * weight) AS earlier FROM rounds, sizes
), allotted AS (
    SELECT r, list(key ORDER BY key) FILTER (n > 0) AS keys, list(n ORDER BY key) FILTER (n > 0) AS ns,
        CAST(sum(n) FILTER (n > 0) AS BIGINT) AS total, CAST(sum(earlier) AS BIGINT) AS first_slot
    FROM shares GROUP BY r
), placed AS (
    SELECT r, keys, ns, total, first_slot, CAST(0 AS BIGINT) AS t, list_transform(ns, lambda x: CAST(0 AS BIGINT)) AS done,
        CAST(0 AS BIGINT) AS p, CAST(0 AS BIGINT) AS j
    FROM allotted
    UNION ALL
    SELECT r, keys, ns, total, first_slot, t + 1, list_transform(done, lambda d, x: d + CASE WHEN x = q THEN 1 ELSE 0 END),
        q, done[q]
    FROM (
        SELECT *, list_min(list_transform(
            list_filter(range(1, len(ns) + 1), lambda x: done[x] < ns[x] AND done[x] * total // ns[x] <= t),
            lambda x: ((done[x] + 1) * total + ns[x] - 1) // ns[x] * 1000000 + x)) % 1000000 AS q
        FROM placed WHERE t < total)
), places AS (
    SELECT r, keys[p] AS key, j, total, first_slot, t - 1 AS spot, j * total // ns[p] AS released,
        ((j + 1) * total + ns[p] - 1) // ns[p] AS due
    FROM placed WHERE t > 0
), turns AS (
    SELECT doc_id, source, key, weight, i, i // {BLOCK_ROWS} AS block, i // {BLOCK_ROWS} // weight AS turn
    FROM numbered JOIN sizes USING (key)
), since AS (
    SELECT *, (SELECT max(r) FROM rounds WHERE r <= turn) AS r FROM turns
)
SELECT doc_id, source, CAST(block AS BIGINT) AS block, CAST(first_slot + (turn - r) * total + spot AS BIGINT) AS slot,
    CAST(first_slot + (turn - r) * total + released AS BIGINT) AS release,
    CAST(first_slot + (turn - r) * total + due AS BIGINT) AS deadline, CAST(i % {BLOCK_ROWS} AS INTEGER) AS place
FROM since JOIN places USING (r, key) WHERE block % weight = j
"""

SQL["op10_lattice_near_duplicates"] = """
WITH RECURSIVE rows_ AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), sound AS (
    SELECT * FROM rows_ WHERE label IS NOT NULL AND len(e) > 0
        AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_inner_product(e, e) > 0
), links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM sound a JOIN sound b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
    SELECT vec_id, vec_id AS r FROM rows_ UNION SELECT reach.vec_id, y FROM reach JOIN links ON r = x
), found AS (
    SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id
)
SELECT vec_id, (SELECT COUNT(*) FROM links WHERE x = vec_id) AS n_links, component_id, component_id = vec_id AS kept
FROM found
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL["op11_polynomial_dedup"] = f"""
WITH lowered AS (
    SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
    doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM lowered
"""

_TERMS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_TERMS = _TERMS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")

SQL["op12_range_maximum_search"] = f"""
WITH listed AS (
    SELECT doc_id, {_TERMS} AS terms FROM documents
), sized AS (
    SELECT doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM listed WHERE len(terms) > 0
), whole AS (
    SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized
), held AS (
    SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM sized) GROUP BY doc_id, n, term
), weighed AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, whole GROUP BY term
), asked AS (
    SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT)
        AS score
    FROM asked JOIN held USING (term) JOIN weighed USING (term), whole GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

SQL["op13_fill_in_middle"] = r"""
WITH parts AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS words
    FROM documents
), drawn AS (
    SELECT doc_id, t, words, CAST(len(words) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(words) + 1) AS x,
        CAST('0x' || h[9:16] AS BIGINT) % (len(words) + 1) AS y, CAST('0x' || h[17:24] AS BIGINT) % 100 AS odds,
        CAST('0x' || h[25:32] AS BIGINT) % 100 AS turn
    FROM parts
), cut AS (
    SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR odds >= 50
        THEN 'plain' WHEN turn < 80 THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(words[1:least(x, y)], '') AS p, array_to_string(words[least(x, y) + 1:greatest(x, y)], '') AS m,
        array_to_string(words[greatest(x, y) + 1:], '') AS s
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
        WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE t END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM cut
"""
