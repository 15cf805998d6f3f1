"""One query per operator, over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import conversations, fingerprints, licenses, minhash, mixing, negatives, neighbours, packing, pii, sentencepieces, sharding, toxicity, urls
from caseloom.llm.common import SEED, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op10_dart_minhash")
def op10_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate class, its rows and its different texts."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_string_kernel")
def op5_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_personal_data")
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule spans and added spans of personal data in every document."""
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


#: The hot source gets twice the weight of any other one, whatever its size.
MIX_WEIGHTS, OTHER_WEIGHT = {"src0": 2.0}, 1.0

#: Draws, copies and places of the Poisson mix, from md5 digests.
OP1_SQL = f"""
WITH sizes AS (
  SELECT coalesce(source, '{mixing.ABSENT}') AS name, sum(length(coalesce(text, ''))) AS size,
         CASE WHEN source = 'src0' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM documents GROUP BY ALL),
sums AS (SELECT sum(size) AS size, sum(weight) AS weight FROM sizes WHERE size > 0),
rates AS (
  SELECT name, CASE WHEN sizes.size > 0 THEN sizes.weight * sums.size::DOUBLE / (sums.weight * sizes.size) ELSE 1.0 END AS rate
  FROM sizes, sums),
parts AS (
  SELECT d.*, coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, ''))) AS key, greatest(ceil(rate / 16), 1)::BIGINT AS parts,
         rate / greatest(ceil(rate / 16), 1) AS part
  FROM documents d JOIN rates ON coalesce(source, '{mixing.ABSENT}') = name),
draws AS (
  SELECT *, list_sum(list_transform(generate_series(1, parts), lambda i:
    list_reduce(list_prepend({{'k': 0, 'n': 0, 'term': exp(-part), 'sum': exp(-part), 'u':
        ('0x' || substr(md5(concat_ws('|', 'copies {SEED}', key || '|' || i)), 1, 13))::BIGINT / {mixing.UNIT}.0::DOUBLE, 'part': part}},
      list_transform(generate_series(1, 96), lambda k: {{'k': k, 'n': 0, 'term': 0.0::DOUBLE, 'sum': 0.0::DOUBLE, 'u': 0.0::DOUBLE, 'part': 0.0::DOUBLE}})),
      lambda a, b: CASE WHEN a.sum <= a.u
        THEN {{'k': b.k, 'n': a.n + 1, 'term': a.term * a.part / b.k, 'sum': a.sum + a.term * a.part / b.k, 'u': a.u, 'part': a.part}}
        ELSE a END).n))::INT AS copies
  FROM parts)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy, md5(concat_ws('|', 'place {SEED}', key, copy)) AS place
FROM (SELECT *, unnest(generate_series(1, copies)) AS copy FROM draws WHERE copies > 0)"""


@query("op1_poisson_mix", OP1_SQL)
def op1_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole mix: every copy of every document, shuffled."""
    mix = mixing.replicate(table(spark, sf_dir, "documents"), MIX_WEIGHTS, OTHER_WEIGHT)
    return mixing.shuffled(mix).select("doc.*", "copy", "place")


@query("op2_two_pass_shuffle")
def op2_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.placements(table(spark, sf_dir, "documents"))


@query("op6_mixture_packing")
def op6_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows that keep the sources' shares."""
    return packing.pack_windows(table(spark, sf_dir, "documents"))


@query("op4_spot_signatures")
def op4_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.compare_with_following(table(spark, sf_dir, "documents"))


@query("op7_block_matrix_join")
def op7_block_matrix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % neighbours.QUERY_STEP == 0)


@query("op9_url_trees")
def op9_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op8_license_dice", licenses.oracle_sql())
def op8_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences found in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op13_sentencepiece")
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text that they decode to, as digests."""
    return sentencepieces.encode(table(spark, sf_dir, "documents"))


@query("op12_path_ranking")
def op12_path_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every conversation after damage."""
    chats = table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damage(chats), chats)


#: Every hundredth vector is an anchor; every seventh has the label after its own.
ANCHOR_STEP, SHIFTED_STEP, LABELS = 100, 7, 10

OP11_SQL = f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % {SHIFTED_STEP} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM rows a JOIN rows c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % {ANCHOR_STEP} = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {negatives.POSITIVES})
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND {negatives.LOW} * positive_score <= 100 * score AND 100 * score <= {negatives.HIGH} * positive_score
QUALIFY rank <= {negatives.NEGATIVES}"""


@query("op11_cover_tree", OP11_SQL)
def op11_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every hundredth vector."""
    shifted = F.when(F.col("vec_id") % SHIFTED_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % ANCHOR_STEP == 0, shifted)
