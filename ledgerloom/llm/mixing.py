"""Operator 3: mixing sources to target weights by hierarchical budgets.

Weights go down a domain - language - source tree.  A node's budget is dealt to its children in proportion to
their weights; a child that can't use its share (its documents, read at most ``max_epochs`` times) is capped
and its shortage goes to its siblings.  Only what a whole subtree can't use moves up to its ancestors'
siblings.  A leaf reads its documents in whole epochs and then a token-prefix of the next one, in the order of
a seeded hash, so a larger budget extends a smaller one's selection.

Prefixes need no sort of a whole leaf: hashes are cut into buckets, bucket sums give the bucket in which the
budget ends, and only that bucket is sorted.  The document at which it ends is read in part, so no budget is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, stored, table

LEAF = ["domain", "lang", "source"]
#: Whole-number weights of the registered query; names not listed have weight OTHER.
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 4, "de": 2, "fr": 2, "es": 2}
OTHER = 1
SEED = "mix-1"
#: Rows of a leaf's hash bucket are at most about this many.
BUCKET_ROWS = 4096


def weight(name: Column, weights: dict[str, int]) -> Column:
    out = F.lit(OTHER)
    for k, w in weights.items():
        out = F.when(name == k, w).otherwise(out)
    return out.cast("long")


def filled(children: DataFrame, parent: list[str]) -> DataFrame:
    """Column ``share`` for children with budget (of the parent), weight, cap: proportional, capped, whole.

    Ordered by cap / weight the capped children come first; ``level`` is the share per weight that is left
    after those before a child took their caps, and the first child below its cap sets it for all after it.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.col("cap") / F.col("weight"), *[c for c in LEAF if c in children.columns])
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    out = children.withColumn("level", (F.col("budget") - before) / rest).withColumn("nth", F.row_number().over(order))
    out = out.withColumn("first", F.min(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.struct("nth", "level"))).over(by))
    share = F.when(F.col("first").isNull() | (F.col("nth") < F.col("first.nth")), F.col("cap")).otherwise(
        F.floor(F.col("first.level") * F.col("weight")))
    return out.withColumn("share", F.least(share, F.col("cap")).cast("long")).drop("level", "nth", "first")


def leaf_budgets(leaves: DataFrame, percent: int, max_epochs: int, domains: dict[str, int], langs: dict[str, int]) -> DataFrame:
    """Leaves (LEAF, supply, rows) with budget in tokens: ``percent`` of all tokens dealt down the tree."""
    caps = leaves.withColumn("cap", F.col("supply") * max_epochs)
    lang = caps.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"), F.sum("supply").alias("supply"))
    domain = lang.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("supply").alias("supply"))
    # one row per domain: as many as the tree has first children
    total = F.sum("supply").over(Window.partitionBy(F.lit(0)))
    budget = F.floor(total * percent / 100).cast("long")
    top = filled(domain.withColumns({"budget": budget, "weight": weight(F.col("domain"), domains)}), [])
    mid = lang.join(top.select("domain", F.col("share").alias("budget")), "domain").withColumn("weight", weight(F.col("lang"), langs))
    mid = filled(mid, ["domain"]).select("domain", "lang", F.col("share").alias("budget"))
    low = filled(caps.join(mid, ["domain", "lang"]).withColumn("weight", F.lit(1).cast("long")), ["domain", "lang"])
    return low.select(*LEAF, "supply", "rows", F.col("share").alias("budget"))


def mixed(docs: DataFrame, domain: Column, tokens: Column, percent: int, max_epochs: int, domains: dict[str, int],
          langs: dict[str, int], seed: str = SEED) -> DataFrame:
    """Rows of ``docs`` that are read, with ``mix_domain``, ``mix_copies`` (times read whole) and ``mix_tokens``
    (tokens of its beginning that are read once more: the document at which a leaf's budget ends).

    Uses doc_id, lang, source and what ``domain`` and ``tokens`` name; null names count as empty ones, a null
    doc_id as an empty text.  Repeated rows of one doc_id are read alike: where the budget ends among them each gives
    the same number of its first tokens.  Leaves without tokens give nothing, an empty table gives an empty result.
    Columns of ``docs`` that have the names of the three new ones are replaced.
    """
    mine = ("mix_domain", "mix_copies", "mix_tokens")
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in mine]).alias("row"), F.coalesce(domain, F.lit("")).alias("domain"),
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), tokens.cast("long").alias("tokens"))
    slim = stored(named.drop("row"), "tokens")
    leaves = slim.groupBy(*LEAF).agg(F.sum("tokens").alias("supply"), F.count("*").alias("rows"))
    digits = F.greatest(F.ceil(F.log(16.0, F.col("rows") / BUCKET_ROWS)), F.lit(0)).cast("int")
    plan = stored(
        leaf_budgets(leaves, percent, max_epochs, domains, langs).where("supply > 0")
        .withColumn("epochs", F.floor(F.col("budget") / F.col("supply")).cast("long"))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("supply")).withColumn("digits", digits)
        .select(*LEAF, "epochs", "rest", "digits"), "budgets")
    keyed = slim.join(plan, LEAF).withColumn("h", _order(seed, F.col("epochs"), F.col("id"))).withColumn("bucket", F.expr("substring(h, 1, digits)"))
    sums = keyed.groupBy(*LEAF, "rest", "bucket").agg(F.sum("tokens").alias("tokens"))
    upto = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("bucket"))
    edge = stored(sums.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("tokens"))
                  .where("before <= rest AND upto > rest").select(*LEAF, "bucket", "before"), "edges")
    # rows of one id are one row here, so a bucket's window holds as many rows as it has ids
    ids = keyed.join(edge, [*LEAF, "bucket"]).groupBy(*LEAF, "rest", "before", "h").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("copies"))
    within = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("h")) + F.col("before")
    over = F.col("upto") > F.col("rest")
    begin = F.struct("h", F.floor((F.col("rest") - F.col("upto") + F.col("tokens")) / F.col("copies")).cast("long").alias("tokens"))
    last = ids.withColumn("upto", within).groupBy(*LEAF).agg(F.max(F.when(~over, F.col("h"))).alias("last"), F.min(F.when(over, begin)).alias("begun"))
    cut = stored(plan.join(edge.drop("before"), LEAF, "left").join(last, LEAF, "left").select(*LEAF, "epochs", "bucket", "last", "begun"), "cuts")
    out = named.join(cut, LEAF).withColumn("h", _order(seed, F.col("epochs"), F.col("id")))
    more = F.coalesce((F.col("h") < F.col("bucket")) | (F.col("h") <= F.col("last")), F.lit(False))
    begun = F.when(F.col("h") == F.col("begun.h"), F.least("begun.tokens", "tokens")).otherwise(0)
    out = out.select("row", F.col("domain").alias("mix_domain"), (F.col("epochs") + F.when(more, 1).otherwise(0)).alias("mix_copies"), F.coalesce(begun, F.lit(0)).alias("mix_tokens"))
    return out.where("mix_copies > 0 OR mix_tokens > 0").select("row.*", *mine)


def first_words(text: Column, n: Column) -> Column:
    """The beginning of a text up to its ``n``-th word, spacing kept; the whole text if it has no more words."""
    parts = F.split(F.coalesce(text, F.lit("")), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    blank = F.rlike(parts[0], F.lit(r"^[\x20\x09-\x0D]*$")).cast("int")  # what comes before the first word
    return F.regexp_replace(F.array_join(F.slice(parts, F.lit(1), n.cast("int") + blank), ""), r"[\x20\x09-\x0D]+$", "")


def _order(seed: str, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), doc_id).cast("binary"))


def domain_of(source: Column) -> Column:
    """Domains of the registered query: four, by the name of the source."""
    first = F.substring(F.md5(F.coalesce(source, F.lit("")).cast("binary")), 1, 1)
    return F.concat(F.lit("d"), ((F.instr(F.lit("0123456789abcdef"), first) - 1) % 4).cast("string"))


def query(spark, sf_dir):
    """As many tokens as the corpus has, at most four epochs of a source: the documents read, how often, and tokens of the last one begun."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", n_words(F.col("text")).alias("n_tokens"))
    out = mixed(docs, domain_of(F.col("source")), F.col("n_tokens"), 100, 4, DOMAIN_WEIGHTS, LANG_WEIGHTS)
    return out.select("doc_id", F.col("mix_domain").alias("domain"), "lang", "source", "n_tokens", F.col("mix_copies").alias("copies"), F.col("mix_tokens").alias("begun_tokens"))


def stage(spark, docs, sf_dir):
    """Each source's share of the target weights, every document at most once; 80 % of the tokens that came in.

    The document at which a source's budget ends is cut after its last word that is read.
    """
    out = mixed(docs, domain_of(F.col("source")), n_words(F.col("text")), 80, 1, DOMAIN_WEIGHTS, LANG_WEIGHTS)
    cut = F.col("mix_copies") == 0
    text = F.when(cut, first_words(F.col("text"), F.col("mix_tokens"))).otherwise(F.col("text"))
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def _fill_sql(name: str, children: str, parent: list[str], order: list[str]) -> str:
    by = f"PARTITION BY {', '.join(parent) or '0'}"
    ordered = f"{by} ORDER BY cap / weight, {', '.join(order)}"
    return f"""
{name}_level AS (SELECT *, (budget - coalesce(sum(cap) OVER ({ordered} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER ({ordered} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, row_number() OVER ({ordered}) AS nth FROM ({children})),
{name}_first AS (SELECT *, min(CASE WHEN cap > level * weight THEN nth END) OVER ({by}) AS first FROM {name}_level),
{name}_set AS (SELECT *, max(CASE WHEN nth = first THEN level END) OVER ({by}) AS set_by FROM {name}_first),
{name} AS (SELECT *, least(CASE WHEN first IS NULL OR nth < first THEN cap ELSE floor(set_by * weight) END, cap)::BIGINT AS share FROM {name}_set)"""


def _weight_sql(col: str, weights: dict[str, int]) -> str:
    return f"CASE {col} {' '.join(f"WHEN '{k}' THEN {w}" for k, w in weights.items())} ELSE {OTHER} END"


ORACLE_SQL = f"""
WITH t AS (
  SELECT doc_id, lang AS given_lang, source AS given_source, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    'd' || (strpos('0123456789abcdef', substr(md5(coalesce(source, '')), 1, 1)) - 1) % 4 AS domain,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS n_tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS supply, sum(n_tokens)::BIGINT * 4 AS cap FROM t GROUP BY ALL),
langs AS (SELECT domain, lang, sum(cap)::BIGINT AS cap FROM leaf GROUP BY ALL),
domains AS (SELECT domain, sum(cap)::BIGINT AS cap FROM langs GROUP BY ALL),
{_fill_sql("top", f"SELECT *, {_weight_sql('domain', DOMAIN_WEIGHTS)} AS weight, (SELECT sum(supply)::BIGINT FROM leaf) AS budget FROM domains", [], ["domain"])},
{_fill_sql("mid", f"SELECT l.*, {_weight_sql('lang', LANG_WEIGHTS)} AS weight, d.share AS budget FROM langs l JOIN top d USING (domain)", ["domain"], ["domain", "lang"])},
{_fill_sql("low", f"SELECT l.*, {OTHER} AS weight, m.share AS budget FROM leaf l JOIN mid m USING (domain, lang)", ["domain", "lang"], ["domain", "lang", "source"])},
plan AS (SELECT domain, lang, source, (share // supply)::BIGINT AS epochs, share - (share // supply) * supply AS rest FROM low WHERE supply > 0),
keyed AS (SELECT t.*, p.epochs, p.rest, md5('{SEED}:' || p.epochs || ':' || coalesce(t.doc_id::VARCHAR, '')) AS h
  FROM t JOIN plan p USING (domain, lang, source)),
upto AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY h) AS upto,
  sum(n_tokens) OVER (PARTITION BY domain, lang, source, h) AS own, count(*) OVER (PARTITION BY domain, lang, source, h) AS alike FROM keyed),
read AS (SELECT *, epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS copies,
  CASE WHEN upto > rest AND upto - own <= rest THEN least((rest - upto + own) // alike, n_tokens) ELSE 0 END AS begun_tokens FROM upto)
SELECT doc_id, domain, given_lang AS lang, given_source AS source, n_tokens::BIGINT AS n_tokens, copies, begun_tokens::BIGINT AS begun_tokens
FROM read WHERE copies > 0 OR begun_tokens > 0
"""
