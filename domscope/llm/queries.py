"""The queries opN_* over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, langid, lexical_search, lm_score, mixing, near_dedup, pii_crf, quality_net, quality_rules, spelling,
    substring_dedup, suffix_dedup, topk_search,
)

#: The vocabulary of op4.
VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each text that 200-byte strings at two places or more cover, and the hash of the rest.

    One row for each row of documents. Null, empty and short texts lose nothing; repeated rows and null ids
    are documents of their own; ids that many rows share don't mix their texts.
    """
    found = suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of each vector whose vec_id is divisible by 20.

    Ties go to the smaller vec_id; a repeated row is a candidate of its copies; null vectors, those with a
    null or non-finite component, and null ids take no part; only vectors of equal length are compared.
    """
    return topk_search.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 20)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each text that windows of 13 words with an earlier doc_id cover, and the hash of the rest.

    One row for each row of documents. Null and short texts lose nothing; rows of one id never remove each
    other's words; null ids come last.
    """
    found = substring_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and hash of each text's ids, and the hash of what they decode to.

    Null and empty texts have no ids and decode to the empty text; repeated rows give repeated results.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = bpe.encode(docs, vocabulary_path(), decoded="decoded")
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff scores of each document under the bigrams of all others.

    Wordless texts have sum 0 and a null mean; repeated rows are other documents to each other.
    """
    found = lm_score.scores(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        F.round("log_sum", 4).alias("log_sum"),
        F.round("log_mean", 6).alias("log_mean"),
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest language of each text, learned from the documents that are not held out.

    Null texts and those without a letter are und with score 0; without a known trigram the most frequent
    language with score 0; ties go to the first language by code point.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs, langid.train(docs))


def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix by weights 1, 2, 3 takes of each document.

    Wordless texts have size 0 and are taken 0 words; null sources are one source, the last; equal rows may
    be taken different numbers of times.
    """
    sized = mixing.sizes(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    mixed = mixing.mix_sized(sized, "doc_id", "text", without=("text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "draws")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of each text, the base verdict and that of the learned decision list.

    Null and wordless texts fail the base rules; repeated rows have one verdict; rule tells which rule decided
    (0 the base, null none).
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    return quality_rules.apply(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule",
    )


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of each document under links of similarity 0.85 or more.

    Wordless texts have an empty set and are linked with nothing; repeated rows are linked; null ids take
    part, and a component without any id has a null one.
    """
    return near_dedup.dedup(
        table(spark, sf_dir, "documents").select("doc_id", "text")
    ).select("doc_id", "n_shingles", "component_id", "kept")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each text: counts of the base kinds, their hash, and all spans.

    Null and empty texts have none; repeated rows give repeated results; offsets are code points.
    """
    found = pii_crf.detect(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in pii_crf.KINDS),
        F.sha2(pii_crf.joined("spans", pii_crf.KINDS), 256).alias("base_sha256"),
        pii_crf.joined("spans").alias("spans"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 documents of highest score for each item of benchmark.

    Null texts and those without a term take no part; an item whose terms are in no document has no rows; of
    equal scores the smaller doc_id comes first, a null one last; repeated rows are ranked one by one.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.rank(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), 10)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each word of all texts with its number of near words, its form and the root of its forms.

    Null and wordless texts have no words; a null id is an empty one in the checksum; repeated rows count
    again; of equally frequent near words the smallest is the form.
    """
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability that labels would call each text good, learned from the rows that are not held out.

    Null and empty texts have a score, too; a null id counts as in the training part; without labels every
    score is 0.5; repeated rows have one score.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_net.score(docs, quality_net.train(docs, table(spark, sf_dir, "labels")))


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            op1_suffix_dedup, op2_top_k, op3_substring_dedup, op4_bpe_round_trip, op5_lm_scores, op6_language,
            op7_mixture, op8_quality_rules, op9_near_duplicates, op10_personal_data, op11_lexical_search,
            op12_spelling_variants, op13_quality_scores,
        )
    }


#: Words of documents in order, one row each.
_WORDS = """
words AS (
  SELECT doc_id, i, list_extract(ws, i) AS w, len(ws) AS n
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents), unnest(range(1, len(ws) + 1)) AS t(i)
)"""

SQL_SUBSTRINGS = f"""
WITH {_WORDS.strip()},
windows AS (
  SELECT doc_id, i, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS k, i + 12 <= n AS whole FROM words
),
least AS (SELECT k, min(doc_id) AS first FROM windows WHERE whole GROUP BY k HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT x.doc_id, x.i FROM windows x JOIN least l ON x.k = l.k AND x.whole AND x.doc_id > l.first),
marked AS (
  SELECT w.doc_id, w.i, w.w, max(CASE WHEN h.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
  FROM words w LEFT JOIN hits h ON w.doc_id = h.doc_id AND w.i = h.i
),
per AS (
  SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed, coalesce(string_agg(w, ' ' ORDER BY i) FILTER (WHERE gone = 0), '') AS kept FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(p.n_words, 0)::BIGINT AS n_words, coalesce(p.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(p.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN per p ON d.doc_id = p.doc_id
"""

SQL_NEAR = """
WITH RECURSIVE lists AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s FROM lists, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * common >= 85 * (p.n + q.n - common)
),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, l.c AS component_id, d.doc_id = l.c AS kept
FROM documents d JOIN least l ON l.x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""


SQL_TOP_K = """
WITH used AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM used q JOIN used c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 20
"""

SQL_LM = f"""
WITH {_WORDS.strip()},
lowered AS (SELECT doc_id, i, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM words),
pairs AS (SELECT doc_id, i, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS v FROM lowered),
one AS (SELECT w, count(*) AS c FROM lowered GROUP BY w),
own_one AS (SELECT doc_id, w, count(*) AS c FROM lowered GROUP BY doc_id, w),
two AS (SELECT v, w, count(*) AS c FROM pairs WHERE v IS NOT NULL GROUP BY v, w),
own_two AS (SELECT doc_id, v, w, count(*) AS c FROM pairs WHERE v IS NOT NULL GROUP BY doc_id, v, w),
size AS (SELECT doc_id, count(*) AS n FROM lowered GROUP BY doc_id),
rest AS (SELECT doc_id, n, greatest((SELECT count(*) FROM lowered) - n, 1) AS m FROM size),
terms AS (
  SELECT p.doc_id, p.i, p.v, r.m, a.c - ao.c AS cw, b.c - bo.c AS cv, t.c - o.c AS cvw
  FROM pairs p JOIN rest r ON r.doc_id = p.doc_id JOIN one a ON a.w = p.w JOIN own_one ao ON ao.doc_id = p.doc_id AND ao.w = p.w
  LEFT JOIN one b ON b.w = p.v LEFT JOIN own_one bo ON bo.doc_id = p.doc_id AND bo.w = p.v
  LEFT JOIN two t ON t.v = p.v AND t.w = p.w LEFT JOIN own_two o ON o.doc_id = p.doc_id AND o.v = p.v AND o.w = p.w
),
logs AS (
  SELECT doc_id, i, CASE WHEN v IS NULL THEN log10(greatest(cw, 1) / m::DOUBLE) WHEN cvw > 0 THEN log10(cvw / greatest(cv, 1)::DOUBLE) ELSE log10(0.4::DOUBLE) + log10(greatest(cw, 1) / m::DOUBLE) END AS s FROM terms
),
sums AS (SELECT doc_id, sum(s ORDER BY i) AS s FROM logs GROUP BY doc_id)
SELECT d.doc_id, coalesce(r.n, 0)::BIGINT AS n_words, round(coalesce(x.s, 0.0), 4) AS log_sum, round(x.s / r.n, 6) AS log_mean
FROM documents d LEFT JOIN rest r ON r.doc_id = d.doc_id LEFT JOIN sums x ON x.doc_id = d.doc_id
"""


_LEXICAL_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL_LEXICAL = f"""
WITH found AS (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '{_LEXICAL_TERM}')) AS term FROM documents),
asked AS (SELECT item_id, unnest(regexp_extract_all({_LOWERED}, '{_LEXICAL_TERM}')) AS term FROM benchmark),
counts AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY doc_id, term),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM counts, whole GROUP BY term, docs
),
lengths AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM sizes, whole),
scored AS (
  SELECT a.item_id, c.doc_id, sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * l.m)))::BIGINT AS score
  FROM asked a JOIN counts c ON a.term = c.term JOIN weights w ON w.term = a.term JOIN lengths l ON l.doc_id = c.doc_id
  GROUP BY a.item_id, c.doc_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scored WHERE score > 0)
SELECT item_id, r::INTEGER AS rank, doc_id, score FROM ranked WHERE r <= 10
"""


SQL_SPELLING = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
runs AS (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
counts AS (SELECT doc_id, run, count(*) AS c FROM runs GROUP BY doc_id, run),
bytes AS (
  SELECT run, c, list_transform(range(1, strlen(doc_id || ':' || run) + 1), lambda k: ('0x' || substr(hex(doc_id || ':' || run), (2 * k - 1)::BIGINT, 2))::BIGINT) AS b FROM counts
),
checked AS (
  SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda h, x: xor(h >> 8, t[(xor(h, x) & 255) + 1])), 4294967295::BIGINT) AS h FROM bytes, crc_table
),
made AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM checked),
words AS (SELECT word, sum(c)::BIGINT AS n FROM made WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
gaps AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
pairs AS (
  SELECT a.word AS x, b.word AS y FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT g.word, w.word FROM gaps g JOIN words w ON g.rest = w.word
  UNION SELECT w.word, g.word FROM gaps g JOIN words w ON g.rest = w.word
),
ranked AS (
  SELECT p.x, p.y, w.n, count(*) OVER (PARTITION BY p.x) AS n_near, row_number() OVER (PARTITION BY p.x ORDER BY w.n DESC, p.y) AS r
  FROM pairs p JOIN words w ON w.word = p.y
),
found AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 2 * w.n THEN r.y END AS form, CASE WHEN r.n >= 2 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.x = w.word AND r.r = 1
),
chain AS (SELECT word, word AS at FROM found UNION ALL SELECT c.word, f.form FROM chain c JOIN found f ON f.word = c.at WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.at AS root FROM chain c JOIN found f ON f.word = c.at WHERE f.form IS NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n FROM found f JOIN roots r ON r.word = f.word
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_top_k": SQL_TOP_K,
        "op5_lm_scores": SQL_LM,
        "op3_substring_dedup": SQL_SUBSTRINGS,
        "op9_near_duplicates": SQL_NEAR,
        "op11_lexical_search": SQL_LEXICAL,
        "op12_spelling_variants": SQL_SPELLING,
    }
