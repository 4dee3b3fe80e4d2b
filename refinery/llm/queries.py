"""One query per operator of this subpackage, over the whole of its table, and the SQL that checks it where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm import alignment, bpe, fim, licences, lines, mixing, packing, ppm, quality, reputation, sigtree, token_files, vafile
from refinery.llm.encoder import encoder
from refinery.operators.storage import new_folder

END_ID = 2
PACKING_END_ID = 1
RULES = reputation.rules_by_text([
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def _byte_model() -> str:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def op1_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    token_files.write(_documents(spark, sf_dir), path, _byte_model(), public_tokenizers.PATTERN, END_ID)
    return token_files.read(spark, path, with_ids=False)


def op2_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    held_out = F.crc32(name.cast("binary")) % 7 == 2
    scores = ppm.scored(_documents(spark, sf_dir), ~held_out)
    return scores.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_documents(spark, sf_dir)).drop("source")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = _documents(spark, sf_dir).select("doc_id", bpe.encode(F.col("text"), ranks).alias("ids"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids"), ranks), 256).alias("decoded_sha256"),
    )


def op6_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.judged(_table(spark, sf_dir, "pages"), RULES)


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(_documents(spark, sf_dir))


def op8_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sigtree.classified(_documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated(_documents(spark, sf_dir)).select("doc_id", "n_lines", "n_cut", "text")


def op10_vector_approximation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        pieces = file.read()
    return alignment.aligned(_documents(spark, sf_dir), _byte_model(), public_tokenizers.PATTERN, pieces)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.transformed(_documents(spark, sf_dir))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def op13_tournament_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _byte_model()
    pieces = packing.packed(_documents(spark, sf_dir), model, public_tokenizers.PATTERN, PACKING_END_ID)
    kind = encoder(model, public_tokenizers.PATTERN).kind
    sums = packing.checksums(F.col("ids"), kind).alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", sums, "doc_tokens", "sequence_id", "offset")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # a script beside the package, which the package itself does not need

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "pipeline": pipeline,
        "op1_rans_token_files": op1_rans_token_files,
        "op2_ppm_scores": op2_ppm_scores,
        "op3_robust_outliers": op3_robust_outliers,
        "op4_pivotal_mix": op4_pivotal_mix,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_host_reputation": op6_host_reputation,
        "op7_licences": op7_licences,
        "op8_signature_trees": op8_signature_trees,
        "op9_fuzzy_lines": op9_fuzzy_lines,
        "op10_vector_approximation": op10_vector_approximation,
        "op11_alignment": op11_alignment,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_tournament_packing": op13_tournament_packing,
    }


OP6_SQL = """
WITH parts AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages),
rules(verdict, rule_host, rule_path) AS (VALUES
    ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
labelled AS (
    SELECT page_id, host, path,
           (SELECT max_by(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
            WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
           (SELECT max_by(verdict, length(rule_host || rule_path)) FROM rules
            WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS label
    FROM parts),
hosts AS (
    SELECT host, string_split(host, '.') AS p, count(label) AS n, count(*) FILTER (label = 'block') AS k FROM labelled GROUP BY host),
named AS (
    SELECT host, n, k,
           array_to_string(p[-2:], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.in', 'co.nz') AS two,
           CASE WHEN two THEN array_to_string(p[-3:], '.') ELSE array_to_string(p[-2:], '.') END AS domain,
           CASE WHEN two THEN array_to_string(p[-2:], '.') ELSE p[-1] END AS suffix
    FROM hosts),
levels AS (
    SELECT 1 AS level, suffix AS name, suffix AS parent, sum(n) AS n, sum(k) AS k FROM named GROUP BY suffix
    UNION ALL SELECT 2, domain, suffix, sum(n), sum(k) FROM named GROUP BY domain, suffix
    UNION ALL SELECT 3, host, domain, n, k FROM named),
moments AS (
    SELECT level, count(*) FILTER (n > 0) AS g, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k, sum(n::DOUBLE * n) AS nn,
           coalesce(sum(k::DOUBLE * k / n) FILTER (n > 0), 0) AS kk
    FROM levels GROUP BY level),
alike AS (
    SELECT level, k / nullif(n, 0) AS m,
           (kk - k * m - (g - 1) * (m * (1 - m))) / nullif(m * (1 - m) * (n - nn / nullif(n, 0) - (g - 1)), 0) AS r
    FROM moments),
strengths AS (
    SELECT level, round(least(greatest(CASE WHEN r > 0 THEN 1 / r - 1 ELSE 1000.0 END, 0.5), 1000.0), 6) AS s FROM alike),
everything AS (SELECT (sum(k) + 0.5) / (sum(n) + 1.0) AS share FROM named),
suffixes AS (
    SELECT name, (k + s * share) / (n + s) AS share FROM levels JOIN strengths USING (level), everything WHERE level = 1),
domains AS (
    SELECT l.name, (k + s * u.share) / (n + s) AS share
    FROM levels l JOIN strengths USING (level) JOIN suffixes u ON l.parent = u.name WHERE level = 2),
bounds AS (
    SELECT l.name AS host, (k + s * u.share) / (n + s) AS p,
           round(p - 1.645 * sqrt(greatest(p * (1 - p), 0) / (n + s + 1)), 9) AS bound
    FROM levels l JOIN strengths USING (level) JOIN domains u ON l.parent = u.name WHERE level = 3)
SELECT page_id, host, path, rule, coalesce(label, CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM labelled JOIN bounds USING (host)
"""

def _op7_sql() -> str:
    """Passages and templates by plain lists; templates have no bigram twice, so a passage's matching ones are counted once."""
    names = ", ".join(f"('{name}', {licences.template_bigrams(text)})" for name, text in licences.TEMPLATES.items())
    return f"""
WITH templates(licence, b) AS (VALUES {names}),
lines AS (SELECT doc_id, string_split(text, chr(10)) AS l, text FROM documents WHERE text IS NOT NULL),
passages AS (
    SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS p FROM lines
    UNION ALL SELECT doc_id, -1, text FROM lines WHERE len(l) > 1),
words AS (SELECT doc_id, line_no, regexp_extract_all(lower(p), '[a-z0-9]+') AS w FROM passages),
bigrams AS (
    SELECT doc_id, line_no, CASE WHEN len(w) = 1 THEN w ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END AS a
    FROM words WHERE len(w) > 0 AND len(w) < 100),
scored AS (
    SELECT doc_id, line_no, licence, len(list_intersect(a, b)) AS common, len(a) + len(b) AS bigrams FROM bigrams, templates)
SELECT doc_id, line_no::INT AS line_no, licence, common::INT AS common, bigrams::INT AS bigrams FROM scored WHERE 200 * common >= 80 * bigrams
"""


OP8_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                        ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
    FROM words WHERE w IS NOT NULL),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
rare AS (SELECT s FROM shingles GROUP BY s HAVING count(*) > 1),
shared AS (SELECT doc_id, s FROM shingles SEMI JOIN rare USING (s)),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shared a JOIN shared b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r USING (doc_id) GROUP BY d.doc_id
"""

OP10_SQL = """
WITH vectors AS (
    SELECT DISTINCT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum([x[1] * x[2] FOR x IN list_zip(q.v, c.v)])::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP12_SQL = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, length(t) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d,
           [('0x' || d[1 + 8 * i : 8 + 8 * i])::BIGINT FOR i IN range(4)] AS h
    FROM documents),
formed AS (
    SELECT *, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                   WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
           least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b
    FROM drawn),
cut AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1, n - b) AS s FROM formed)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_fill_in_middle": OP12_SQL, "op7_licences": _op7_sql(), "op6_host_reputation": OP6_SQL, "op8_signature_trees": OP8_SQL, "op10_vector_approximation": OP10_SQL}
