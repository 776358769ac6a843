"""The registered queries of the text operators: each reads its whole table,
runs its operator with production parameters and returns every row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.chat_format import format_conversations, read_conversations
from strandline.llm.common import read, stored, word_count
from strandline.llm.decontaminate import leaks
from strandline.llm.lang_id import held_out, identify, train
from strandline.llm.lexical_search import search
from strandline.llm.line_dedup import line_report
from strandline.llm.mixing import mix
from strandline.llm.near_dup import near_duplicates
from strandline.llm.quality_rules import judge
from strandline.llm.rule_ensemble import classify
from strandline.llm.secret_scan import find_secrets, joined
from strandline.llm.spelling_groups import spelling_groups
from strandline.llm.token_files import token_digests
from strandline.llm.warc import read_archives, write_archives


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = find_secrets(read(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return d.select("doc_id", *[count(k) for k in ("assign", "access", "hex")],
                    F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                    joined(F.sort_array(F.concat("base", "added"))).alias("spans"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    learned = train(docs.filter(~held_out("doc_id")))
    return identify(docs, learned).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score",
                                          "accepted")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    written = stored(format_conversations(turns.unionByName(hard)), "op3-formatted")
    d = read_conversations(written)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return d.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                    F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archives(spark, write_archives(read(spark, sf_dir, "pages")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = stored(read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "source", word_count(F.col("text")).alias("size")),
        "op6-sizes")
    return mix(sized).select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                             (F.col("copies") * F.col("size")).alias("taken"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), width=2)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read(spark, sf_dir, "documents"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_language_id": op2_language_id,
    "op3_chat_format": op3_chat_format,
    "op4_warc": op4_warc,
    "op5_quality_rules": op5_quality_rules,
    "op6_mix_sources": op6_mix_sources,
    "op7_token_files": op7_token_files,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_decontaminate": op9_decontaminate,
    "op10_line_dedup": op10_line_dedup,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_lexical_search": op12_lexical_search,
    "op13_spelling_groups": op13_spelling_groups,
}

ORACLES: dict[str, str] = {
    "op3_chat_format": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
     e AS (SELECT *, contains(text, '<s>') OR contains(text, '</s>') OR contains(text, '[INST]')
                     OR contains(text, '[/INST]') AS hard,
                  replace(replace(replace(replace(replace(text, '\', '\\'), '<s>', '\ls>'), '</s>', '\l/s>'),
                          '[INST]', '\bINST]'), '[/INST]', '\b/INST]') AS esc,
                  replace(replace(replace(replace(role, '\', '\\'), '<', '\l'), '[', '\b'), '!', '\x') AS r
           FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                         ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       sum(20 + length(r) + CASE WHEN hard THEN 1 + length(esc) ELSE length(text) END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op4_warc": """
WITH h AS (SELECT page_id, coalesce(html, '') AS p, sha1(coalesce(html, '')) AS x FROM pages),
     f AS (SELECT x, min(page_id) AS first FROM h GROUP BY x),
     v AS (SELECT *, [list_reduce([0] || [strpos('0123456789abcdef', substr(x, 5 * k + j, 1)) - 1
                      FOR j IN range(1, 6)], lambda a, b: a * 16 + b) FOR k IN range(0, 8)] AS v
           FROM h JOIN f USING (x))
SELECT page_id, octet_length(encode(p)) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                        (v[i // 4 + 1] >> (15 - 5 * (i % 4))) % 32 + 1, 1) FOR i IN range(0, 32)], '')
           AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM v""",
    "op8_near_duplicates": r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
             ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
f AS (SELECT g, count(*) AS df FROM g GROUP BY 1),
-- sets that are linked share one of their n - 0.8 n + 1 rarest shingles
p AS (SELECT doc_id, g, n FROM (SELECT doc_id, g, n, row_number() OVER (PARTITION BY doc_id ORDER BY df, g) AS k
                                FROM g JOIN f USING (g) JOIN n USING (doc_id))
      WHERE k <= n - (8 * n + 9) // 10 + 1),
near AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM p AS x JOIN p AS y
         ON x.g = y.g AND x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
pairs AS (SELECT a, b, count(*) AS c FROM near JOIN g AS x ON x.doc_id = a
          JOIN g AS y ON y.doc_id = b AND y.g = x.g GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
          WHERE 100 * c >= 80 * (x.n + y.n - c)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS id, doc_id AS r FROM documents
          UNION SELECT reach.id, sides.b FROM reach JOIN sides ON sides.a = reach.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.c AS component_id, d.doc_id = r.c AS kept
FROM documents AS d LEFT JOIN n USING (doc_id)
JOIN (SELECT id, min(r) AS c FROM reach GROUP BY 1) AS r ON r.id = d.doc_id""",
    "op9_decontaminate": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
     i AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w
           FROM benchmark),
     iw AS (SELECT item_id, w, least(5, len(w)) AS k FROM i WHERE len(w) > 0),
     ig AS (SELECT DISTINCT item_id, k,
                   unnest([array_to_string(w[j:j + k - 1], ' ') FOR j IN range(1, len(w) - k + 2)]) AS g
            FROM iw),
     n AS (SELECT item_id, count(*) AS item_shingles FROM ig GROUP BY 1),
     dg AS (SELECT DISTINCT doc_id, k,
                   unnest([array_to_string(w[j:j + k - 1], ' ') FOR j IN range(1, len(w) - k + 2)]) AS g
            FROM d, (SELECT DISTINCT k FROM iw))
SELECT doc_id, item_id, item_shingles, count(*) AS common, count(*) / item_shingles AS containment
FROM dg JOIN ig USING (k, g) JOIN n USING (item_id)
GROUP BY doc_id, item_id, item_shingles HAVING 10 * count(*) >= 8 * item_shingles""",
    "op12_lexical_search": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
     q AS (SELECT item_id, term, count(*) AS times
           FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY 1, 2),
     c AS (SELECT count(*) FILTER (WHERE len(t) > 0) AS n_docs, sum(len(t))::BIGINT AS total FROM d),
     p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d)
           WHERE term IN (SELECT term FROM q) GROUP BY 1, 2, 3, 4),
     w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
           FROM p, c GROUP BY term, n_docs),
     s AS (SELECT q.item_id, p.r, p.doc_id,
                  sum(q.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * p.n * c.n_docs) // c.total))))
                  ::BIGINT AS score
           FROM q JOIN p USING (term) JOIN w USING (term), c GROUP BY 1, 2, 3),
     k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
                  doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20""",
}
