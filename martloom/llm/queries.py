"""One query per operator, with the parameters of production, over its whole table.

A query takes (spark, folder of the tables). Where SQL can say the same, its text stands beside it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import (
    langmix,
    lines,
    merkle,
    mixing,
    orderminhash,
    pieces,
    quality,
    sharding,
    simhash,
    styletree,
    toxicity,
    wordruns,
    wumanber,
)
from martloom.llm.tables import LOWER, UPPER, lower_ascii, read, remainder

SHARDS = 16


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    third = remainder(F.col("doc_id"), 3)
    predicted = langmix.languages(docs.select("doc_id", "text"), docs.where(third != 1))
    return predicted.select(
        "doc_id", F.coalesce(third == 1, F.lit(False)).alias("held_out"), "lang_pred", "score",
        "langs", "shares",
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's site is its source, and its path there its language."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality.site_quality(docs, labels, F.col("source"), F.col("lang"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return styletree.extract(pages).select("page_id", "url", "text", "n_chars")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = wumanber.find_passages(docs, read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", wumanber.n_hit().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
).format(upper=UPPER, lower=LOWER)

OP4_SQL = f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
p AS MATERIALIZED (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[pos:pos + 9], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM i
          WHERE len(w) > 0)),
g AS (
    SELECT r, pos, n, array_to_string(w[pos:pos + n - 1], ' ') AS win
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS pos
          FROM d, (SELECT DISTINCT n FROM p))),
h AS MATERIALIZED (SELECT DISTINCT r, pos, n, item_id FROM g JOIN p USING (n, win)),
words AS (SELECT r, count(DISTINCT word) AS n_hit
          FROM (SELECT r, unnest(range(pos, pos + n)) AS word FROM h) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, coalesce(cast(item_id AS varchar), 'null') AS id FROM h)
          GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderminhash.edited_fingerprints(read(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_positions(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mixed_sizes(docs).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("times")).cast("bigint").alias("taken"),
    )


OP7_SQL = r"""
WITH sized AS MATERIALIZED (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           ('0x' || substr(md5(coalesce(cast(doc_id AS varchar), '') || ':' || coalesce(text, '')),
                           1, 9))::BIGINT AS hash
    FROM documents),
s AS (
    SELECT *, 2.0::DOUBLE * source_size AS lim,
           row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, k) AS o
    FROM (SELECT source, sum(size)::BIGINT AS source_size,
                 row_number() OVER (ORDER BY source NULLS LAST) AS k,
                 ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE
                     AS w
          FROM sized GROUP BY source)),
l AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
               - coalesce(sum(lim) OVER (ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING
                                         AND 1 PRECEDING), 0))
              / (sum(w) OVER () - coalesce(sum(w) OVER (
                     ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
    FROM s),
t AS (
    SELECT source, source_size,
           CASE WHEN level * w >= lim THEN lim
                ELSE w * min_by(level, o) FILTER (level * w < lim) OVER () END AS target
    FROM l),
b AS (
    SELECT source, hash, sum(size) AS here,
           sum(sum(size)) OVER (PARTITION BY source ORDER BY hash) AS upto
    FROM sized GROUP BY source, hash),
c AS (
    SELECT b.source, hash, source_size, target,
           CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS repeats,
           CASE WHEN source_size > 0 THEN target % source_size ELSE 0 END AS budget, here, upto
    FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * (repeats + CASE WHEN upto <= budget
                                 OR upto - here < budget AND upto - budget < budget - (upto - here)
                               THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized JOIN c ON sized.hash = c.hash AND sized.source IS NOT DISTINCT FROM c.source"""


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.without_common_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


OP8_SQL = f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls
    FROM documents),
x AS MATERIALIZED (
    SELECT r, pos, line, trim(translate(line, '{UPPER}', '{LOWER}'),
                             chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
    FROM (SELECT r, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS line FROM d)),
common AS (SELECT key FROM x WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS t
         FROM x ANTI JOIN common USING (key) GROUP BY r)
SELECT doc_id, len(ls)::BIGINT AS n_lines, (len(ls) - coalesce(n, 0))::BIGINT AS n_dropped,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


def op9_near_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    groups = simhash.near_groups(docs, words=4, radius=4, blocks=3)
    return groups.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    fifth = remainder(F.col("doc_id"), 5)
    sample = toxicity.labelled_sample(docs.select("doc_id", "text"), labels.where(fifth != 0))
    judged = toxicity.with_toxicity(docs.select("doc_id", "text"), toxicity.fit(sample))
    return judged.select(
        "doc_id", F.coalesce(fifth == 0, F.lit(False)).alias("held_out"),
        F.col("toxicity.score").alias("score"), F.col("toxicity.predicted").alias("predicted"),
        F.col("toxicity.worst").alias("worst"), F.col("toxicity.worst_score").alias("worst_score"),
    )


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.PieceModel.load(public_tokenizers.path("piece_bpe_32k.model"))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return pieces.encoded(docs, model, decode=True).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
        F.xxhash64("begins", "ends").alias("spans_xxh64"),
    )


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rest = ["doc_id", "source", "lang", "n_chars"]
    tampered = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    lowered = merkle.leaf(*map(F.col, rest), lower_ascii(F.col("text")))
    leaves = docs.select(
        F.col("source").alias("grouped"), F.col("doc_id").alias("id"),
        merkle.leaf(*map(F.col, rest), F.col("text")).alias("digest"),
        F.when(tampered, lowered).alias("tampered"),
    )
    proved, root = merkle.manifest(leaves)
    folded = merkle.fold(F.coalesce("tampered", "digest"), F.col("path"))
    return proved.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), F.col("top").alias("subroot"),
        F.lit(root).alias("root"), F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


_FIELD = "coalesce(strlen({0}) || ':' || {0}, '-')"
_LEAF = "sha256(" + " || ".join(
    _FIELD.format(f"cast({c} AS varchar)") for c in ("doc_id", "source", "lang", "n_chars")
) + " || {0})"
# crc32 of the decimal id: eight steps of the reflected polynomial for each byte
_CRC = (
    "xor(4294967295, list_reduce([4294967295] || list_transform(string_split("
    "cast(doc_id AS varchar), ''), lambda c: ascii(c)::BIGINT), lambda r, b: list_reduce("
    "[xor(r, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"
)

OP12_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (
    SELECT doc_id, source, {_LEAF.format(_FIELD.format("text"))} AS leaf,
           CASE WHEN {_CRC} % 5 = 0
                THEN {_LEAF.format(_FIELD.format(f"translate(text, '{UPPER}', '{LOWER}')"))} END
               AS tampered
    FROM documents),
p AS MATERIALIZED (
    SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS r,
           row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           count(*) OVER (PARTITION BY tree) AS n
    FROM (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM d)),
up(tree, lvl, pos, n, digest) AS (
    SELECT tree, 0, pos, n, leaf FROM p
    UNION ALL
    SELECT tree, lvl + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
    FROM up WHERE n > 1 GROUP BY tree, lvl, pos // 16),
top AS MATERIALIZED (SELECT tree, lvl, digest FROM up WHERE n = 1),
gup(lvl, pos, n, digest) AS (
    SELECT 0, tree, (SELECT count(*) FROM top), digest FROM top
    UNION ALL
    SELECT lvl + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
    FROM gup WHERE n > 1 GROUP BY lvl, pos // 16),
node AS MATERIALIZED (
    SELECT tree, lvl, pos, digest FROM up WHERE n > 1
    UNION ALL
    SELECT t.tree, t.lvl + g.lvl, g.pos, g.digest FROM top t, gup g WHERE g.n > 1),
sib AS MATERIALIZED (
    SELECT tree, lvl, pos // 16 AS run, list(digest ORDER BY pos) AS ds FROM node GROUP BY ALL),
way(r, tree, lvl, pos, top, proof, acc) AS (
    SELECT r, p.tree, 0, CASE WHEN n = 1 THEN p.tree ELSE pos END, top.lvl, '',
           coalesce(tampered, leaf)
    FROM p JOIN top USING (tree)
    UNION ALL
    SELECT r, way.tree, way.lvl + 1,
           CASE WHEN way.lvl + 1 = top THEN way.tree ELSE pos // 16 END, top,
           proof || array_to_string(ds[:pos % 16] || ds[pos % 16 + 2:], ''),
           sha256(array_to_string(ds[:pos % 16] || [acc] || ds[pos % 16 + 2:], ''))
    FROM way JOIN sib ON way.tree = sib.tree AND way.lvl = sib.lvl AND pos // 16 = run),
ends AS (SELECT r, max_by(proof, lvl) AS proof, max_by(acc, lvl) AS folded FROM way GROUP BY r)
SELECT doc_id, leaf, top.digest AS subroot, gup.digest AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = gup.digest AS verified
FROM p JOIN ends USING (r) JOIN top USING (tree), gup WHERE gup.n = 1"""


def _with_repeats(docs: DataFrame) -> DataFrame:
    """`docs(doc_id, text)`; where the id's crc32 is a multiple of ten the words from a place on are
    replaced by repeats of the first of them."""
    mark = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(mark / 10)
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(w, a + 1, p), times))
        both = F.concat(F.slice(w, F.lit(1), a), F.slice(tail, F.lit(1), n - a))
        return F.when(n > 0, F.array_join(both, " "))

    # inside transform the words are found once, however often they are named
    planted = F.transform(F.array(words), repeated)[0]
    return docs.select("doc_id", F.when(mark % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _with_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    found = wordruns.periodic_runs(docs, times=4, least=6)
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("least"), r["start"], r["period"]))
    )
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.least")).alias("length"), F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.least") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256)
        .alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


CHECKS = {
    "op1_language": (op1_language, None),
    "op2_quality": (op2_quality, None),
    "op3_html": (op3_html, None),
    "op4_decontamination": (op4_decontamination, OP4_SQL),
    "op5_fingerprints": (op5_fingerprints, None),
    "op6_sharding": (op6_sharding, None),
    "op7_mixing": (op7_mixing, OP7_SQL),
    "op8_lines": (op8_lines, OP8_SQL),
    "op9_near_groups": (op9_near_groups, None),
    "op10_toxicity": (op10_toxicity, None),
    "op11_pieces": (op11_pieces, None),
    "op12_manifest": (op12_manifest, OP12_SQL),
    "op13_runs": (op13_runs, None),
}
