"""Every operator as a query over the test tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credit_marts.llm import (
    byte_bpe,
    cell_dedup,
    content_sort,
    curve_pack,
    edit_counts,
    jump_hash,
    lang_masks,
    lattice_lm,
    minhash,
    permuterm,
    secret_crf,
    target_resampling,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _doc_id(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("id", "doc_id")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again."""
    return _doc_id(byte_bpe.digests(table(spark, sf_dir, "documents"), RANKS, PATTERN))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share 80 of 100 four-word shingles."""
    return _doc_id(minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets by patterns and by the random field."""
    return _doc_id(secret_crf.scanned(table(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return _doc_id(toxicity.scored(docs, labels))


def op5_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts before and after four edits made of each document's own columns."""
    size = F.coalesce(F.char_length("text"), F.lit(0))
    third = F.floor(size / 3).cast("bigint")

    def edit(start, stop, replacement):
        return F.struct(start.alias("start"), stop.alias("stop"), replacement.alias("replacement"))

    edits = F.array(
        edit(third, third + 5, F.col("source")),
        edit(2 * third, 2 * third, F.concat(F.lit(" "), F.col("lang"))),
        edit(size - 7, size, F.lit(None).cast("string")),
        edit(F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), F.substring("text", 1, 20)),
    )
    docs = table(spark, sf_dir, "documents")
    return _doc_id(edit_counts.edit_texts(docs, edits, RANKS, PATTERN, with_text=False))


def op6_curve_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, neighbours on the curve together."""
    return _doc_id(curve_pack.pack(table(spark, sf_dir, "documents"), RANKS, PATTERN, with_ids=False))


def op7_cell_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors of one label with a cosine of 0.98 or more."""
    return cell_dedup.near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op8_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents equal up to the case of A-Z."""
    return _doc_id(content_sort.content_groups(table(spark, sf_dir, "documents")))


def op9_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in eight shards by their id."""
    return _doc_id(jump_hash.sharded(table(spark, sf_dir, "documents"), shards=8))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return _doc_id(lang_masks.predicted(table(spark, sf_dir, "documents")))


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn towards the word distribution of the benchmark."""
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return _doc_id(target_resampling.resampled(docs, target))


def op12_permuterm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their stronger spellings."""
    return permuterm.variants(table(spark, sf_dir, "documents"))


def op13_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log probability of every document over all its segmentations."""
    vocabulary = lattice_lm.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return _doc_id(lattice_lm.scored(table(spark, sf_dir, "documents"), vocabulary))


def queries() -> dict[str, Query]:
    found = (
        op1_byte_bpe, op2_minhash_dedup, op3_secret_scan, op4_toxicity, op5_edit_counts, op6_curve_pack,
        op7_cell_dedup, op8_content_sort, op9_jump_shards, op10_language_id, op11_target_resampling,
        op12_permuterm, op13_lattice_lm,
    )
    return {query.__name__: query for query in found}


# crc32 of UTF-8 bytes in SQL: the table of the reflected polynomial, then one step per byte. A word's bytes are
# read from its hexadecimal form.
_CRC_TABLE = """
    crc_bits AS (
        SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)
            ORDER BY b) AS steps
        FROM range(256) AS t(b)
    )"""


def _crc(data: str) -> str:
    """The crc32 of a text column, where ``crc_bits`` is joined."""
    octets = f"list_transform(range(1, octet_length(encode({data})) + 1), lambda i: ('0x' || substr(hex(encode({data})), 2 * i - 1, 2))::BIGINT)"
    step = "lambda c, b: xor(c // 256, steps[(xor(c % 256, b) + 1)::BIGINT])"
    return f"xor(list_reduce({octets}, {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def oracle_sql() -> dict[str, str]:
    return {
        "op8_content_sort": f"""
            WITH plain AS (SELECT doc_id, {_NORMAL} AS body FROM documents),
            grouped AS (
                SELECT doc_id, body, max(doc_id) OVER (PARTITION BY body) AS keep_id,
                    count(*) OVER (PARTITION BY body) AS group_size
                FROM plain
            )
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM grouped""",
        "op11_target_resampling": f"""
            WITH {_CRC_TABLE},
            words AS (
                SELECT doc_id, unnest(regexp_extract_all({_NORMAL}, {_WORD})) AS word FROM documents
            ),
            wanted AS (SELECT unnest(regexp_extract_all({_NORMAL}, {_WORD})) AS word FROM benchmark),
            used AS (SELECT DISTINCT word FROM (SELECT word FROM words UNION ALL SELECT word FROM wanted)),
            placed AS (SELECT word, {_crc("word")} % 10000 AS bucket FROM used, crc_bits),
            source AS (SELECT bucket, count(*) AS s FROM words JOIN placed USING (word) GROUP BY bucket),
            target AS (SELECT bucket, count(*) AS t FROM wanted JOIN placed USING (word) GROUP BY bucket),
            gains AS (
                SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM source) + 10000)::DOUBLE
                    / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM target), 0) + 10000)::DOUBLE)))::BIGINT AS gain
                FROM source LEFT JOIN target USING (bucket)
            ),
            weights AS (
                SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight
                FROM words JOIN placed USING (word) JOIN gains USING (bucket) GROUP BY doc_id
            ),
            scored AS (
                SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                    coalesce(weight, 0) + floor(-1000 * ln(-ln(
                        (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE
                    )))::BIGINT AS score
                FROM documents LEFT JOIN weights USING (doc_id)
            ),
            places AS (
                SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
                FROM scored WHERE n_features >= 20
            )
            SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
            FROM scored LEFT JOIN places USING (doc_id)""",
            "op12_permuterm": f"""
            WITH RECURSIVE {_CRC_TABLE},
            runs AS MATERIALIZED (
                SELECT doc_id, run, count(*) AS n
                FROM (SELECT doc_id, unnest(regexp_extract_all({_NORMAL}, '[a-zÀ-ÿ]+')) AS run FROM documents)
                GROUP BY doc_id, run
            ),
            hashed AS MATERIALIZED (SELECT run, n, {_crc("(doc_id || ':' || run)")} AS h FROM runs, crc_bits),
            written AS MATERIALIZED (
                SELECT n AS times, CASE WHEN h % 97 = 0
                    THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
                FROM hashed
            ),
            words AS MATERIALIZED (
                SELECT word, sum(times)::BIGINT AS n FROM written WHERE length(word) >= 5
                GROUP BY word HAVING sum(times) >= 3
            ),
            shorter AS MATERIALIZED (
                SELECT word, n, i, left(word, i::INT) || substr(word, i::INT + 2) AS rest
                FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
            ),
            pairs AS (
                SELECT a.word, a.n, b.word AS other, b.n AS other_n
                FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
                UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
                UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
            ),
            near AS (
                SELECT word, count(*) AS n_near, max(other_n) AS best_n, arg_min(other, (-other_n, other)) AS best
                FROM pairs GROUP BY word
            ),
            formed AS MATERIALIZED (
                SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form,
                    CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
                FROM words LEFT JOIN near USING (word)
            ),
            paths AS (
                SELECT word, word AS ending FROM formed
                UNION ALL SELECT p.word, f.form FROM paths p JOIN formed f ON p.ending = f.word WHERE f.form IS NOT NULL
            )
            SELECT formed.word, formed.n, formed.n_near, formed.form, formed.form_n, ending AS root
            FROM formed JOIN paths USING (word) JOIN formed AS tops ON tops.word = ending WHERE tops.form IS NULL""",
    }
