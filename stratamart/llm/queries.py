"""Registered queries of the operators over whole tables, and the SQL that they must equal."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.session import new_work_folder

from . import warc
from .chats import format_chats
from .common import table
from .decontaminate import contaminations
from .interactions import audit_filters
from .jaccard import near_classes
from .language import predict_languages
from .licenses import scan_licenses
from .mixing import mix
from .phrases import phrase_fingerprints
from .pieces import encode_pieces
from .secret_scan import scan_secrets
from .suffixes import without_repeats
from .whitening import whitened_components


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return predict_languages(table(spark, folder, "documents"))


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents")).drop("spans")


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(table(spark, folder, "documents"))


def op4_repeated_windows(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents"))


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return format_chats(table(spark, folder, "conversations"))


def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_classes(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_phrase_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_fingerprints(table(spark, folder, "documents"))


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return contaminations(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    path, pages = new_work_folder(spark, "warc"), table(spark, folder, "pages")
    warc.write_archives(pages, f"{path}/archives")
    warc.write_index(spark, f"{path}/archives", f"{path}/index")
    # All pages are looked up; a null url was written as an empty one.
    urls = pages.select(F.coalesce("url", F.lit("")).alias("url"))
    rows = warc.look_up(urls, f"{path}/archives", f"{path}/index", payloads=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_filter_interaction(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("filter")


def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    rows = encode_pieces(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened_components(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_license_scan, op3_secret_scan, op4_repeated_windows, op5_chat_format, op6_ngram_jaccard,
        op7_source_mix, op8_phrase_fingerprint, op9_decontaminate, op10_warc_index, op11_filter_interaction,
        op12_sentencepiece, op13_whitening,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op4_repeated_windows": """
        WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) h FROM documents),
        s AS (SELECT doc_id, h, length(h) // 2 n FROM d),
        w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 400)) k FROM (SELECT doc_id, h, unnest(range(0, n - 199)) p FROM s WHERE n >= 200)),
        r AS (SELECT doc_id, p FROM w SEMI JOIN (SELECT k FROM w GROUP BY k HAVING count(*) > 1) USING (k)),
        g AS (SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200, true)::INT new FROM r),
        i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) run FROM g),
        runs AS (SELECT doc_id, run, min(p) a, max(p) + 200 b FROM i GROUP BY doc_id, run),
        pieces AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) before FROM runs),
        kept AS (
            SELECT doc_id, sum(b - a) n_removed, count(*) n_spans, max(b) tail,
                string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) head
            FROM pieces JOIN s USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, n::BIGINT n_bytes, coalesce(n_removed, 0)::BIGINT n_removed, coalesce(n_spans, 0)::BIGINT n_spans,
            sha256(unhex(coalesce(head || substr(h, 2 * tail + 1), h))) kept_sha256
        FROM s LEFT JOIN kept USING (doc_id)""",
    "op5_chat_format": """
        WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
        c AS (SELECT conv_id, count(*) n_turns, list([role, text] ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) parts FROM t GROUP BY conv_id),
        u AS (SELECT min(conv_id) conv_id, n_turns, parts, count(*) n_equal FROM c GROUP BY n_turns, parts),
        begun AS (SELECT DISTINCT parts[1:k] parts FROM (SELECT parts, unnest(range(1, n_turns)) k FROM u)),
        f AS (SELECT conv_id, n_turns, n_equal, array_to_string(list_transform(parts,
            lambda p: '<|im_start|>' || coalesce(p[1], '') || chr(10) || coalesce(p[2], '') || '<|im_end|>' || chr(10)), '') rendered
            FROM u ANTI JOIN begun USING (parts))
        SELECT conv_id, n_turns, n_equal, length(rendered) n_chars, rendered FROM f""",
    "op6_ngram_jaccard": """
        WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') ws FROM documents),
        s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
            ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) ss FROM w),
        n AS (SELECT doc_id, len(ss) n FROM s),
        e AS (SELECT doc_id, unnest(ss) x FROM s),
        p AS (SELECT a.doc_id u, b.doc_id v, count(*) c FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 80 * (a.n + b.n - c)),
        r AS (SELECT doc_id, doc_id reached FROM n UNION SELECT r.doc_id, l.v FROM r JOIN l ON l.u = r.reached)
        SELECT doc_id, n n_shingles, component_id
        FROM n JOIN (SELECT doc_id, min(reached) component_id FROM r GROUP BY doc_id) USING (doc_id)""",
    "op7_source_mix": """
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) size,
            ':' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) h FROM documents),
        s AS (SELECT source, sum(size)::BIGINT source_size FROM d GROUP BY source),
        w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] w FROM s),
        o AS (SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) i FROM w),
        q AS (SELECT *, 3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) rest,
            2 * sum(w) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) per FROM o),
        c AS (SELECT *, 2 * source_size * per < w * rest AS stops FROM q),
        f AS (SELECT coalesce(min(i) FILTER (NOT stops), 0) first FROM c),
        t AS (SELECT source, source_size, CASE WHEN i < first THEN (2 * source_size)::DOUBLE
            ELSE w::DOUBLE * (SELECT rest FROM c WHERE i = first)::DOUBLE / (SELECT per FROM c WHERE i = first)::DOUBLE END target FROM c, f),
        r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END rate FROM t),
        k AS (SELECT d.*, source_size, target, j,
            floor(rate)::BIGINT + (('0x' || substr(md5(j || h), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < rate - floor(rate))::INT copies
            FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source, range(8) x(j)),
        best AS (SELECT source, arg_min(j, [off, j]) j FROM (SELECT source, j, abs(sum(size * copies)::DOUBLE - any_value(target)) off FROM k GROUP BY source, j) GROUP BY source)
        SELECT doc_id, size, source_size, target, (size * copies)::BIGINT taken FROM k JOIN best ON k.source IS NOT DISTINCT FROM best.source AND k.j = best.j""",
    "op10_warc_index": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) n, sha256(coalesce(html, '')) d FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY d) first FROM p)
        SELECT page_id, n::BIGINT payload_bytes, d payload_digest,
            CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END record_type,
            CASE WHEN n >= 100 AND first <> page_id THEN first END refers_to
        FROM f""",
    "op11_filter_interaction": """
        WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') part, coalesce(text, '') t FROM documents),
        e AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') w, min(doc_id) OVER (PARTITION BY t) least FROM d),
        l AS (SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) good, max((toxic IS NOT DISTINCT FROM 1)::INT) toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        m AS (SELECT part, coalesce(good, 0) good, coalesce(toxic, 0) toxic, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
            100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > least, false)] fails
            FROM e LEFT JOIN l USING (doc_id)),
        o AS (SELECT '' f UNION ALL SELECT f || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) x) WHERE NOT contains(f, x)),
        s AS (SELECT f filter_order, step, substr(f, step, 1) x, substr(f, 1, step - 1) earlier FROM o, (SELECT unnest([1, 2, 3, 4, 5]) step) WHERE length(f) = 5),
        c AS (SELECT part, good, toxic, fails, count(*) n FROM m GROUP BY ALL),
        g AS (SELECT part, filter_order, step, n, good, toxic, fails[ascii(x) - 64] fails, len(list_filter(range(1, 6), lambda i: fails[i])) failed,
            len(list_filter(range(1, 6), lambda i: fails[i] AND contains(earlier, chr((64 + i)::INT)))) > 0 gone FROM c, s)
        SELECT part, filter_order, step::INT step,
            coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT removed,
            coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT redundant, coalesce(sum(n) FILTER (fails AND failed = 1), 0)::BIGINT unique_fails,
            coalesce(sum(n) FILTER (fails AND NOT gone AND good = 1), 0)::BIGINT good_lost, coalesce(sum(n) FILTER (fails AND NOT gone AND toxic = 1), 0)::BIGINT toxic_lost,
            coalesce(sum(n * 120 // greatest(failed, 1)) FILTER (fails), 0)::BIGINT shapley
        FROM g GROUP BY part, filter_order, step""",
}
