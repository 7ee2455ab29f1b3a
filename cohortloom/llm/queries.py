"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.exact_dedup import DigestIndex
from cohortloom.llm.line_dedup import dedup_lines
from cohortloom.llm.merkle import fold, leaf_digest, merkle_manifest, proof_digest
from cohortloom.llm.mixing import plan_mix, word_count
from cohortloom.llm import language_id, toxicity
from cohortloom.llm.bpe_codec import decode_ids, encode_texts
from cohortloom.llm.collocations import collocations
from cohortloom.llm.decontamination import find_contained
from cohortloom.llm.near_dedup import near_duplicates
from cohortloom.llm.substring_dedup import remove_repeats
from cohortloom.llm.token_files import read_token_files, write_token_files
from cohortloom.llm.url_filter import judge_urls
from cohortloom.llm.workspace import Workspace, read_table
from cohortloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


#: Folder of the public tokenizers; a session may name another.
TOKENIZER_CONF = "spark.cohortloom.tokenizers"
#: The id op1 appends to each document, as its contract fixes.
END_ID = 2


def tokenizer_path(spark: SparkSession, name: str) -> str:
    """Place of a vocabulary file, which must be the same on all nodes."""
    folder = spark.conf.get(TOKENIZER_CONF, None)
    if folder:
        return f"{folder.rstrip('/')}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, and what is read back from them."""
    with Workspace(spark, "tokens") as work:
        path = tokenizer_path(spark, "word_bpe_49k.json")
        return read_token_files(write_token_files(work, read_table(spark, sf_dir, "documents"), path, END_ID))


#: What op2 learns from.
LANGUAGE_LEARN_FROM = "crc32(cast(doc_id AS string)) % 4 <> 2"


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, vocabulary = read_table(spark, sf_dir, "documents"), tokenizer_path(spark, "piece_bpe_32k.model")
    model = language_id.fit(docs, vocabulary, LANGUAGE_LEARN_FROM)
    return language_id.predict(docs, model, vocabulary).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"), "lang_pred", "score"
    )


@query("""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one batch into a new index."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = DigestIndex(spark, scratch_path(spark, "digests"), buckets)
    decisions = index.add(read_table(spark, sf_dir, "documents"))
    index.close()
    return decisions.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


@query(r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
                                 WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
                                 ELSE list_transform(range(1, len(w) - 3),
                                        lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) END) AS s
  FROM split),
sizes AS (SELECT d.doc_id, count(s) AS n FROM documents d LEFT JOIN shingles USING (doc_id) GROUP BY d.doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
arcs AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, arcs.b FROM reach r JOIN arcs ON r.other = arcs.a)
SELECT r.doc_id, any_value(n) AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM reach r JOIN sizes USING (doc_id) GROUP BY r.doc_id
""")
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Workspace(spark, "near") as work:
        return near_duplicates(work, read_table(spark, sf_dir, "documents"), percent=85)


@query()
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Workspace(spark, "repeats") as work:
        return remove_repeats(work, read_table(spark, sf_dir, "documents"))


@query(r"""
WITH lines AS (
  SELECT doc_id, n AS line_no, l[n] AS line,
         list_filter(string_split_regex(l[n], '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
       unnest(range(1, len(l) + 1)) AS r(n)),
firsts AS (SELECT w, min((doc_id, line_no)) AS place FROM lines WHERE len(w) > 0 GROUP BY w),
variants AS (
  SELECT w, place, i, list_concat(w[:i - 1], w[i + 1:]) AS v
  FROM firsts, unnest(range(1, len(w) + 1)) AS r(i) WHERE len(w) >= 8),
near AS (
  SELECT a.w FROM variants a JOIN (SELECT v, i, min(place) AS p FROM variants GROUP BY v, i) b
    ON a.v = b.v AND a.i = b.i WHERE b.p < a.place
  UNION
  SELECT a.w FROM variants a JOIN firsts f ON a.v = f.w AND len(f.w) >= 8 WHERE f.place < a.place
  UNION
  SELECT f.w FROM firsts f JOIN variants a ON a.v = f.w WHERE len(f.w) >= 8 AND a.place < f.place),
judged AS (
  SELECT l.*, len(l.w) = 0 OR ((l.doc_id, l.line_no) = f.place AND n.w IS NULL) AS stays
  FROM lines l LEFT JOIN firsts f ON l.w = f.w LEFT JOIN near n ON l.w = n.w)
SELECT d.doc_id, count(j.line) AS n_lines, count(*) FILTER (NOT j.stays) AS n_dropped,
       sha256(coalesce(string_agg(j.line, chr(10) ORDER BY j.line_no) FILTER (j.stays), '')) AS kept_sha256
FROM documents d LEFT JOIN judged j ON d.doc_id = j.doc_id GROUP BY d.doc_id
""")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that an earlier line repeats but for a word."""
    with Workspace(spark, "lines") as work:
        cleaned = dedup_lines(work, read_table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256")
    )


@query(r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0
         ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size
  FROM documents),
totals AS (SELECT source, sum(size)::HUGEINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 3 * source_size AS cap,
         (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1 AS weight
  FROM totals),
ranked AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(cap) OVER before, 0) AS caps_before,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, source COLLATE "C" NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flagged AS (SELECT *, (total - caps_before) * weight > cap * weight_left AS capped FROM ranked),
targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE ((total - coalesce(sum(cap) FILTER (capped) OVER (), 0)) * weight)::DOUBLE
                   / (sum(weight) FILTER (NOT capped) OVER ())::DOUBLE END AS target
  FROM flagged),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0 END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (size * (floor(rate) + CASE WHEN ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT
                                        / 4503599627370496.0::DOUBLE < rate - floor(rate)
                                   THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
""")
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are sized once; the narrow table of sizes is what gets read twice."""
    docs = read_table(spark, sf_dir, "documents")
    with Workspace(spark, "mix") as work:
        sized = work.result(docs.select("doc_id", "source", word_count().alias("size")))
    planned = plan_mix(sized, size=F.col("size"))
    return planned.select(
        "doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


#: Seeds of op9: what its contract fixes.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


@query()
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Workspace(spark, "urls") as work:
        return judge_urls(work, read_table(spark, sf_dir, "pages"), URL_RULES)


#: What op5 learns from, and the score from which a document counts as toxic.
TOXIC_LEARN_FROM = "crc32(cast(doc_id AS string)) % 3 <> 1"
TOXIC_FROM = 0.7


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    settings = toxicity.FtrlSettings()
    model = toxicity.fit(toxicity.training_rows(docs, labels, TOXIC_LEARN_FROM, settings.max_rows), settings)
    return toxicity.score(docs, model).select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"),
    )


@query(r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'i', item_id, text FROM benchmark),
split AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM texts),
shingles AS (
  SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) = 0 THEN []
                                   WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
                                   ELSE list_transform(range(1, len(w) - 3),
                                          lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) END) AS s
  FROM split),
items AS (SELECT id, count(*) AS n FROM shingles WHERE kind = 'i' GROUP BY id),
shared AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared
  FROM shingles d JOIN shingles i ON d.s = i.s WHERE d.kind = 'd' AND i.kind = 'i' GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n AS n_item
FROM shared JOIN items ON item_id = items.id WHERE 100 * n_shared >= 80 * n
""")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents contain at least four fifths of a benchmark item."""
    with Workspace(spark, "leaks") as work:
        return find_contained(work, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query()
def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all documents' ids, and of the texts that are decoded from these."""
    path = tokenizer_path(spark, "byte_bpe_50k.json")
    coded = decode_ids(encode_texts(read_table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query(r"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('=' || source, '') AS tree,
         list_transform([text, CASE WHEN list_reduce(string_split(doc_id::VARCHAR, ''),
             lambda c, d: list_reduce(range(8),
               lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END,
               xor(c, ord(d)::BIGINT)),
             4294967295::BIGINT) % 2 = 1 THEN replace(text, chr(10), '') ELSE text END],
           lambda t: sha256(array_to_string(list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR, t],
                       lambda v: coalesce(strlen(v)::VARCHAR || ':' || v, '-')), ''))) AS digests
  FROM (SELECT doc_id, source, lang, n_chars, text FROM documents)),
placed AS (
  SELECT *, digests[1] AS leaf, count(*) OVER (PARTITION BY tree) AS n,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digests[1]) - 1 AS place
  FROM leaves),
up AS (
  SELECT tree, 0 AS level, place, n, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
  FROM up WHERE n > 1 GROUP BY tree, level, place // 3, n),
subroots AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT '#' AS tree, 0 AS level, place, n, digest FROM subroots
  UNION ALL
  SELECT tree, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
  FROM top WHERE n > 1 GROUP BY tree, level, place // 3, n),
runs AS (
  SELECT tree, level, place // 3 AS parent, list(digest ORDER BY place) AS d
  FROM (SELECT * FROM up UNION ALL SELECT * FROM top) WHERE n > 1 GROUP BY ALL),
walk AS (
  SELECT row, tree, 0 AS level, place, n, digests[2] AS node, '' AS proof FROM placed
  UNION ALL
  SELECT w.row, CASE WHEN w.n > 1 THEN w.tree ELSE '#' END, CASE WHEN w.n > 1 THEN w.level + 1 ELSE 0 END,
         CASE WHEN w.n > 1 THEN w.place // 3 ELSE s.place END, CASE WHEN w.n > 1 THEN (w.n + 2) // 3 ELSE s.n END,
         CASE WHEN w.n > 1 THEN sha256(array_to_string(r.d[:w.place % 3], '') || w.node
                                       || array_to_string(r.d[w.place % 3 + 2:], '')) ELSE w.node END,
         CASE WHEN w.n > 1 THEN w.proof || array_to_string(r.d[:w.place % 3], '')
                                || array_to_string(r.d[w.place % 3 + 2:], '') ELSE w.proof END
  FROM walk w LEFT JOIN runs r ON r.tree = w.tree AND r.level = w.level AND r.parent = w.place // 3
       LEFT JOIN subroots s ON s.tree = w.tree
  WHERE w.n > 1 OR w.tree <> '#')
SELECT p.doc_id, p.leaf, s.digest AS subroot, t.digest AS root, sha256(w.proof) AS proof_sha256,
       w.node AS folded_root, w.node = t.digest AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree JOIN walk w ON w.row = p.row AND w.tree = '#' AND w.n = 1
     JOIN top t ON t.n = 1
""")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of all documents; of some documents the line breaks are taken out and told by it."""
    docs = read_table(spark, sf_dir, "documents")
    bare = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    tampered = leaf_digest(*map(F.col, ("doc_id", "source", "lang", "n_chars")), F.coalesce(bare, "text"))
    with Workspace(spark, "merkle") as work:
        rows = merkle_manifest(work, docs, carry={"tampered": tampered})
    folded = rows.withColumn("folded_root", fold(F.col("tampered"), F.col("path")))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query(r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, w[i:i + m - 1] AS g, count(*) AS f
  FROM pieces, unnest(range(1, 6)) AS x(m), unnest(range(1, len(w) - m + 2)) AS y(i)
  GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r, t.n,
         (1000 * c.f::HUGEINT * t.n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS score
  FROM grams c, unnest(range(1, len(c.g))) AS x(k)
       JOIN grams l ON l.lang = c.lang AND l.g = c.g[:k] JOIN grams r ON r.lang = c.lang AND r.g = c.g[k + 1:]
       JOIN totals t ON t.lang = c.lang),
best AS (SELECT lang, g, a, n, min((score, k, l, r)) AS cut FROM cuts GROUP BY ALL),
inner_ones AS (
  SELECT lang, g[i:i + m - 1] AS g, max(f) AS longer
  FROM grams, unnest(range(2, len(g))) AS x(m), unnest(range(1, len(g) - m + 2)) AS y(i) GROUP BY ALL),
ranked AS (
  SELECT b.lang, array_to_string(g, ' ') AS phrase, a, cut[3] AS l, cut[4] AS r, n, cut[1] AS score
  FROM best b LEFT JOIN inner_ones i USING (lang, g) WHERE 100 * coalesce(i.longer, 0) < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked QUALIFY rank <= 2000
""")
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language that occur 100 times."""
    with Workspace(spark, "phrases") as work:
        return collocations(work, read_table(spark, sf_dir, "documents"), least=100, top=2000)
