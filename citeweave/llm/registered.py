"""Registered queries over the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from citeweave.llm import collocations, embedding_dedup, kd_shards, language, line_dedup, minhash, packing, secrets, sentence_pieces, simhash, spelling, token_counts, token_files
from citeweave.llm.common import documents
from citeweave.staging import Staging


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of vectors linked by a cosine of 0.9 or more."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return embedding_dedup.near_duplicates(vectors, Staging(spark, "embeddings"))


OP1_SQL = """
WITH RECURSIVE sound AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
parts AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degrees AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM parts LEFT JOIN degrees USING (vec_id)
"""


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text; class_id and n_links come from the block tables.

    class_id is the smallest doc_id with an equal fingerprint, n_links the number of other documents
    whose fingerprints differ in at most 3 of 64 bits.
    """
    staging = Staging(spark, "simhash")
    marks = staging.write(simhash.fingerprint_documents(documents(spark, sf_dir).select("doc_id", "text")), "marks")
    prints = marks.select("doc_id", F.col("own").alias("fingerprint"))
    near = simhash.neighbour_counts(prints, staging)
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id"))
    links = staging.write(near.join(classes, "fingerprint"), "links").withColumnRenamed("fingerprint", "own")
    return marks.join(links, "own").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        simhash.as_text(F.col("own")).alias("fingerprint"),
        simhash.as_text(F.col("edited")).alias("edited_fingerprint"),
        simhash.likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        simhash.likeness(F.col("own"), F.coalesce("following", "own")).alias("near_next"),
        "class_id",
        (F.col("docs") - 1 + F.col("near")).alias("n_links"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of the labelled ones."""
    docs = documents(spark, sf_dir).withColumn("held_out", language.held_out("doc_id"))
    model = language.train(docs.where(~F.col("held_out")))
    found = language.predict(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", F.array_join("languages", ",").alias("languages"))


def op3_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    placed = kd_shards.kd_shards(documents(spark, sf_dir), Staging(spark, "shards"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentencepiece ids of every document with the end id, and the text they decode to, as digests."""
    found = sentence_pieces.encode_and_decode(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 code points and more in at least 5 documents stay in the largest doc_id only."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    cleaned = line_dedup.drop_repeated_lines(docs, Staging(spark, "lines"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH raw AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts, row_number() OVER () AS rid
  FROM documents),
lines AS (
  SELECT rid, doc_id, pos, parts[pos] AS line,
         translate(trim(parts[pos], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT *, unnest(generate_series(1, len(parts))) AS pos FROM raw)),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT rid, l.doc_id, pos, line, coalesce(l.doc_id <> f.keeper, false) AS dropped
  FROM lines l LEFT JOIN frequent f ON l.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY rid, doc_id
"""


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a ledger that is new with each call, so that all blobs are unseen."""
    staging = Staging(spark, "secrets")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = secrets.scan_versions(docs, staging.path("ledger"), staging)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    joined = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined, 256).alias("base_sha256"),
        joined.alias("spans"),
    )


def _spans_sql(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
  SELECT rid, {rank} AS rank, '{kind}' AS kind,
         list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda m: length(m))), 0) AS start,
         length(found[i]) AS width, length(vals[i]) >= {least} AS fits
  FROM (SELECT rid, gaps, found, vals, unnest(generate_series(1, len(found))) AS i
        FROM (SELECT rid, regexp_split_to_array(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS found,
                     regexp_extract_all(text, '{pattern}', {group}) AS vals
              FROM raw WHERE regexp_matches(text, '{pattern}')))"""


OP8_SQL = (
    "WITH raw AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents), spans AS ("
    + " UNION ALL ".join(_spans_sql(r.kind, k, r.pattern, r.group, r.least) for k, r in enumerate(secrets.RULES))
    + """),
joined AS (
  SELECT rid, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(concat(kind, ':', CAST(start AS BIGINT), ':', CAST(start + width AS BIGINT)), ',' ORDER BY start, rank) AS spans
  FROM spans WHERE fits GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM raw LEFT JOIN joined USING (rid)
"""
)

def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word runs have a similarity of 0.8 or more."""
    return minhash.near_duplicates(documents(spark, sf_dir), Staging(spark, "minhash"), words=4, percent=80)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in pieces whose lengths are powers of two, each a sequence of its own."""
    cut = packing.pieces(documents(spark, sf_dir)).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    numbered = packing.number_sequences(cut, Staging(spark, "packing"))
    return numbered.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, through a cache that is new with each call, so that all texts are misses."""
    staging = Staging(spark, "token-counts")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    counted = token_counts.count_tokens(docs, staging.path("cache"), staging)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words of every frequent word, and the form that each variant leads to."""
    return spelling.spelling_variants(documents(spark, sf_dir), Staging(spark, "spelling"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to entropy-coded files and read back from them."""
    staging = Staging(spark, "token-files")
    folder = staging.path("files")
    token_files.write_ids(documents(spark, sf_dir).select("doc_id", "text"), folder, staging)
    return token_files.read_ids(spark, folder)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language by their lowest-scoring cut."""
    return collocations.collocations(documents(spark, sf_dir), Staging(spark, "collocations"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM words, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size)),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE size = 1 GROUP BY lang),
f AS (SELECT lang, size, phrase, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT lang, phrase, size, c AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[k + 1:size], ' ') AS tail
  FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM f WHERE size > 1)),
scores AS (
  SELECT cuts.lang, cuts.phrase, cuts.size, a, k, x.c AS l, y.c AS r,
         CAST((CAST(a AS HUGEINT) * 2000000) // (CAST(x.c AS HUGEINT) + y.c) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = tail),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
spans AS (
  SELECT lang, a, array_to_string(w[i:i + many - 1], ' ') AS phrase
  FROM (SELECT lang, a, w, many, unnest(generate_series(1, size - many + 1)) AS i
        FROM (SELECT lang, a, size, string_split(phrase, ' ') AS w, unnest(generate_series(2, size - 1)) AS many FROM lowest WHERE size > 2))),
covers AS (SELECT lang, phrase, max(a) AS most FROM spans GROUP BY lang, phrase),
kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN covers USING (lang, phrase)
  WHERE most IS NULL OR CAST(most AS HUGEINT) * 100 < CAST(a AS HUGEINT) * 80)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py over all documents; ids as their CRC beside their bytes."""
    return corpus_pipeline.run(spark, sf_dir).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


QUERIES = {
    "pipeline": pipeline,
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_simhash": op2_simhash,
    "op6_language_id": op6_language_id,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op9_packing": op9_packing,
    "op10_token_counts": op10_token_counts,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_files": op12_token_files,
    "op13_collocations": op13_collocations,
    "op3_kd_shards": op3_kd_shards,
    "op4_sentence_pieces": op4_sentence_pieces,
    "op5_line_dedup": op5_line_dedup,
    "op8_secret_scan": op8_secret_scan,
}
ORACLES = {"op1_embedding_dedup": OP1_SQL, "op5_line_dedup": OP5_SQL, "op8_secret_scan": OP8_SQL, "op13_collocations": OP13_SQL}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
